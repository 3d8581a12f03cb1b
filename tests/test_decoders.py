from __future__ import annotations

import datetime
import html
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal, InvalidOperation, localcontext
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulary.functions import dates, numbers, records, text, urls
from tabulary.functions.decoded import with_decoded


def outcomes(spark, cells, make):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, v string")
    out = with_decoded(df, {"x": make(F.col("v"))})
    return [(r["x"], bool(r["bad_fields"])) for r in out.orderBy("i").collect()]


def test_percent_is_exact_or_fails(spark):
    cells = ["3.69", "3.690000000000000001", "", " . ", "N/A", "abc", "-1", "1001", "1000", "1e2", "+1.5", ".5", "NaN", None, "5.", "1e-20"]
    expected = [(369, False), (None, True), (None, False), (None, False), (None, False), (None, True), (None, True), (None, True),
                (100000, False), (10000, False), (150, False), (50, False), (None, True), (None, False), (500, False), (None, True)]
    assert outcomes(spark, cells, numbers.percent_basis_points) == expected


def test_other_scales(spark):
    assert outcomes(spark, ["-3.5", "-1001"], numbers.signed_percent_basis_points) == [(-350, False), (None, True)]
    assert outcomes(spark, ["1.81000", "1.123456"], numbers.percent_basis_points_thousandths) == [(181000, False), (None, True)]
    assert outcomes(spark, ["1.00012345", "1.24721652"], numbers.index_hundred_millionths) == [(100012345, False), (124721652, False)]
    assert outcomes(spark, ["825", "1e3", "10000001"], numbers.count_value) == [(825, False), (None, True), (None, True)]
    assert outcomes(spark, ["15,000,000", "0"], numbers.currency_amount) == [(15000000, False), (None, True)]
    assert outcomes(spark, ["2.22`", "2.2%", ""], lambda c: numbers.required_percent(c, True)) == [(222, False), (220, False), (None, True)]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.from_regex(r"\A[+-]?[0-9]{1,4}(\.[0-9]{0,22})?\Z"), min_size=150, max_size=150))
def test_percent_against_exact_decimals(spark, cells):
    def exact(cell):
        try:
            scaled = Decimal(cell) * 100
        except InvalidOperation:
            return (None, True)
        if scaled != scaled.to_integral_value() or not 0 <= scaled <= 100000:
            return (None, True)
        return (int(scaled), False)

    # Longer fractions are refused even when only zeros follow.
    expected = [(None, True) if len(c.partition(".")[2]) > 18 else exact(c) for c in cells]
    assert outcomes(spark, cells, numbers.percent_basis_points) == expected


@settings(max_examples=1, deadline=None)
@given(st.lists(st.from_regex(r"\A[0-9]{1,6}\.[0-9]{1,30}\Z"), min_size=150, max_size=150))
def test_millionths_round_half_up(spark, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(numbers.millionths(F.col("v"))).collect()]
    assert got == [int((Decimal(c) * 1000000).quantize(Decimal(1), ROUND_HALF_UP)) for c in cells]


def test_cell_rate(spark):
    df = spark.createDataFrame(
        [(0, "0.2%", False), (1, "Interest Rate of 20.0 Percent", False), (2, "not a rate", False), (3, "0.05", True), (4, "0.2", False), (5, "Interest at 7%", False)],
        "i int, v string, n boolean",
    )
    assert [r[0] for r in df.orderBy("i").select(numbers.cell_rate(F.col("v"), F.col("n"))).collect()] == [20, 2000, None, 500, None, None]


def test_dates(spark):
    june, none = datetime.date(2026, 6, 1), (None, True)
    assert outcomes(spark, ["6/1/2026", "06/01/2026", "02/30/2026"], dates.slash_date) == [(june, False), (june, False), none]
    assert outcomes(spark, ["6/1/2026", "06/01/2026", "02/30/2026"], dates.padded_slash_date) == [none, (june, False), none]
    assert outcomes(spark, ["2026-06-01", "2026-02-30", "20260601"], dates.iso_date) == [(june, False), none, none]
    assert outcomes(spark, ["October 2014", "Oct 2014"], dates.month_name_year) == [("2014-10", False), none]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_text(spark):
    assert one(spark, text.text_lines(F.lit("  │ a  b ┘\f\n\n c\u0002d e\r\nx"))) == ["a b", "c-d e", "x"]
    assert one(spark, text.collapse(F.lit(" a \n b c "))) == "a b c"
    assert one(spark, text.ruling_citation(F.lit("see rev. rul. 2026–09."))) == "Rev. Rul. 2026-9"
    assert one(spark, text.ruling_label(F.lit("Rev. Rul 2014-26")).value) == "Rev. Rul. 2014-26"
    assert one(spark, text.unescape(F.lit("a &amp; &#39;x&#x41; &copy; &foo; &amp;lt;"))) == "a & 'x' &foo; &lt;".replace("'x'", "'xA ©")
    assert one(spark, text.archive_name(F.array(F.lit("1998-08")), F.array(F.lit("section-7520-rates"), F.lit("afr")),
                                        F.lit("Rev. Rul. 98-36, I.R.B. 1998-31"), F.lit("https://x/pub/irb98-31.pdf"))) \
        == "1998-08_afr-7520_rev-rul-98-36-i-r-b-1998-31_irb98-31.pdf"


@pytest.mark.parametrize(
    "base,reference",
    [("https://w.org/a/b/c?x=1", "../d.pdf"), ("https://w.org/a/b", "/pub/x.pdf?y=2#z"), ("https://w.org", "q.pdf"), ("https://h/a", "https://o/z"),
     ("https://h/a/b", "//o/z"), ("https://h/a/b?q=1", "#f"), ("https://h/a/b?q=1", "?z=2"), ("https://h/a/b", "./c/./d/..")],
)
def test_join_url(spark, base, reference):
    assert one(spark, urls.join_url(F.lit(base), F.lit(reference))) == urljoin(base, reference)


def test_url_rules(spark):
    good = "https://home.treasury.gov/resource-center/data-chart-center/interest-rates/daily-treasury-rates.csv/2026/all?type=daily_treasury_yield_curve&page=&_format=csv"
    assert one(spark, urls.curve_feed_allowed(F.lit(good)))
    assert not one(spark, urls.curve_feed_allowed(F.lit(good.replace("_format=csv", "_format=xml"))))
    feed = "https://markets.newyorkfed.org/x?startDate={}&endDate={}"
    assert one(spark, urls.overnight_feed_allowed(F.lit(feed.format("2000-07-03", "2001-01-01")), "/x", "2000-07-03"))
    assert not one(spark, urls.overnight_feed_allowed(F.lit(feed.format("2000-07-02", "2001-01-01")), "/x", "2000-07-03"))
    assert not one(spark, urls.ruling_document_allowed(F.lit("http://www.irs.gov/pub/irs-drop/rr-1.pdf")))


def test_classify(spark):
    kind = records.classify_table(F.lit("2015_vbt_relative_risk_tables__2015_male_non_smoker_rr100_anb"), F.lit("2015 VBT Relative Risk Tables"))
    assert tuple(one(spark, kind)) == ("relative_risk", "male", "non_smoker", "anb", 100)
    assert one(spark, records.classify_table(F.lit("2015_x_alb"), F.lit("2015 VBT Unismoke Tables"))) is None


def test_numbers_of_any_length_decode_exactly(spark):
    """Exponents, long fractions and many digits, against Python's decimals."""
    cells = [
        "5.0000000000000003E-2", "9.9382280000000006E-2", "1.0000000E-2", "9.9382280000000006E4", "123456789012345.5", "0.1234567890123456789",
        "1e2", "-1E+2", "12.345678901234567890123", "0.00000049999999999999999999", "0.0000005000000000000000000", "3.65", "1E-400", "1e99999999999",
        "0e99", "-0", "000000000000000000000012.5", "12345678901234567", ".5e1", "5.e-1", "1.00000000000000000000000000", "0.00005", "0.00015",
        "0.000050000000000000001", "0.00025000000000000000", "7.000000000000000000000000001",
    ]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    text = F.col("c")
    rows = df.select(
        "c", numbers.percent_basis_points(text).value.alias("points"), numbers.millionths(text).alias("millionths"), numbers.cell_factor(text).alias("factor"),
        numbers.cell_integer(text, numbers.cell_is_number(text)).alias("whole"), numbers.cell_rate(text, numbers.cell_is_number(text)).alias("rate"),
    ).collect()
    with localcontext() as context:
        context.prec, context.Emax, context.Emin = 500, 10**15, -(10**15)
        for r in rows:
            if r.c == "1e99999999999":
                assert (r.points, r.millionths, r.whole, r.rate, r.factor) == (None, None, None, None, r.c)
                continue
            x = Decimal(r.c)
            points, scaled = x.scaleb(2), x.scaleb(6)
            assert r.points == (int(points) if points == points.to_integral_value() and 0 <= points <= 100_000 else None), r.c
            half_up = int(scaled.to_integral_value(rounding=ROUND_HALF_UP))
            assert r.millionths == (half_up if not (x.is_signed() and x) and half_up < 10**18 else None), r.c
            assert r.whole == (int(x) if x == x.to_integral_value() and abs(x) < 10**18 else None), r.c
            even = int(x.scaleb(4).to_integral_value(rounding=ROUND_HALF_EVEN))
            assert r.rate == (even if abs(even) < 2**31 else None), r.c
            assert r.factor == r.c


def test_character_references_follow_html5(spark):
    cells = [
        "a &amp; &#39;x&#x41; &copy; &foo; &amp;lt;", "&lbrack;&lpar;&percnt;&ApplyFunction;", "&amp x &notit; &notin; &not", "&copy2 &ampamp", "&#0; &#xD800; &#x110000; &#99999999999;",
        "&#128;&#150;&#x9d;", "&#1;&#xFFFE;&#11;x", "&", "&&amp;&", "&#; &#x; &# 1", "&fjlig; &NotEqualTilde;", "&AMP;&AMP &LT&gt", "plain", "&#0000000065; &#13;",
    ]
    df = spark.createDataFrame([(c,) for c in cells], "c string").select("c", text.unescape(F.col("c")).alias("t"))
    assert {r.c: r.t for r in df.collect()} == {c: html.unescape(c) for c in cells}

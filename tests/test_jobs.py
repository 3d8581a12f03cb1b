from __future__ import annotations

import datetime
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tabulary.errors import ContractError
from tabulary.operators.generate import term_unitrust_table
from tabulary.plans import artifacts, lookup, updates
from tabulary.plans.store import ShardStore, commit_together
from tabulary.registry import DATASETS, dataset
from tabulary.sources import documents, feeds, files, grids, migrate, rulings, seeds, shards
from tabulary.streaming.feed import stream_feed

CURVE = """Date,1 Mo,1.5 Month,2 Mo,3 Mo,4 Mo,6 Mo,1 Yr,2 Yr,3 Yr,5 Yr,7 Yr,10 Yr,20 Yr,30 Yr
03/04/2031,2.11,2.15,2.18,2.20,2.24,2.31,2.40,2.58,2.66,2.81,2.93,3.07,3.44,3.49
03/03/2031,2.10,2.14,2.17,2.21,2.25,2.30,2.42,2.57,2.64,2.80,2.95,3.06,3.43,3.50
03/02/2031,2.09,2.13,2.19,2.22,2.23,2.32,2.41,2.56,2.65,2.79,2.94,3.05,,3.52
"""
OLD_CURVE = """﻿Date, 3 Mo,6 Mo,1 Yr,2 Yr,3 Yr,5 Yr,7 Yr,10 Yr,30 Yr
10/05/1992,2.72,2.80,2.95,3.64,4.18,5.19,5.79,6.23,7.32
,,,,,,,,,
10/02/1992,2.69,2.78,2.93,3.66,4.21,5.22,5.81,6.25,7.34
"""
OVERNIGHT = ",".join(feeds.OVERNIGHT_HEADERS) + """
02/08/2005,EFFR,2.47,,,,,,2.50,,2.20,2.62,0.09,,,,,,
02/04/2005,EFFR,2.51,,,,,,2.50,,2.31,2.75,0.11,,,,,,
02/07/2005,EFFR,,,,,,,,,,,,,,,,,
"""
MIXED = ",".join(feeds.OVERNIGHT_HEADERS) + """
05/07/2019,SOFRAI,,,,,,,,,,,,2.46000,2.45100,2.44200,1.02512345,,
05/07/2019,SOFR,2.43,2.30,2.41,2.50,2.60,901,,,,,,,,,,,
05/06/2019,SOFRAI,,,,,,,,,,,,2.45000,2.45000,2.44000,1.02000000,,
05/06/2019,SOFR,2.41,2.05,2.40,2.48,2.71,933,,,,,,,,,,,
05/06/2019,BGCR,2.40,,,,,,,,,,,,,,,,
"""


@pytest.fixture
def land(tmp_path):
    def write(name, text):
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_curve_feeds_with_different_headers(spark, land, tmp_path):
    land("curve/a.csv", CURVE)
    land("curve/b.csv", OLD_CURVE)
    root = str(tmp_path / "store")
    assert updates.update_curve(spark, root, str(tmp_path / "landing/curve")) == updates.RunMetrics(5, 0, 5, True)
    assert updates.update_curve(spark, root, str(tmp_path / "landing/curve")) == updates.RunMetrics(5, 5, 5, False)
    store = ShardStore.of(spark, root, dataset("treasury-yield-curve"))
    first = lookup.by_date(store, "2031-03-02").first()["par_yields_basis_points"]
    assert (first[0], first[1], first[11], first[12], first[13]) == (209, 213, 305, None, 352)
    old = lookup.by_date(store, "1992-10-02").first()["par_yields_basis_points"]
    assert (old[0], old[3], old[12], old[13]) == (None, 269, None, 734)
    bad = land("bad.csv", CURVE.replace("3.07", "9.99"))
    with pytest.raises(ContractError, match="conflicting_record"):
        updates.update_curve(spark, root, bad)


@pytest.mark.parametrize(
    "old,new,code",
    [("Date,1 Mo", "Date,9 Mo", "invalid_csv"), ("03/03/2031", "03/04/2031", "duplicate_source_record"), ("3.07", "3.075", "invalid_csv"),
     ("03/03/2031", "02/31/2031", "invalid_csv"), (",3.49", ",3.49,1", "invalid_csv")],
)
def test_curve_feed_fails_closed(spark, land, old, new, code):
    with pytest.raises(ContractError, match=code):
        feeds.read_curve(spark, land("x.csv", CURVE.replace(old, new)))


def test_overnight_update_and_lookup(spark, land, tmp_path):
    path, root = land("o.csv", OVERNIGHT), str(tmp_path / "store")
    assert updates.update_overnight(spark, root, path) == updates.RunMetrics(3, 0, 3, True)
    assert updates.update_overnight(spark, root, path) == updates.RunMetrics(3, 3, 3, False)
    store = ShardStore.of(spark, root, dataset("federal-funds"))
    assert lookup.by_date(store, "2005-02-08").first()["rate_basis_points"] == 247
    assert lookup.by_date(store, "2005-02-07").first()["rate_basis_points"] is None
    later = land("later.csv", OVERNIGHT.replace("02/07/2005,EFFR,,", "02/07/2005,EFFR,2.49,"))
    assert updates.update_overnight(spark, root, later) == updates.RunMetrics(3, 3, 3, True)
    assert lookup.by_date(store, "2005-02-07").first()["rate_basis_points"] == 249
    with pytest.raises(ContractError, match="invalid_csv"):
        feeds.read_overnight(spark, land("f.csv", OVERNIGHT.replace("02/04/2005,EFFR", "02/04/2005,OBFR")))


def _days(spark, *pairs):
    return spark.createDataFrame(pairs, "day string, rate_basis_points int").selectExpr("CAST(day AS DATE) AS date", "rate_basis_points")


def test_stale_versions_go(spark, tmp_path, rows):
    store = ShardStore.of(spark, str(tmp_path), dataset("federal-funds"))
    runs = []
    for days in ((("2001-01-05", 1), ("2002-01-04", 2)), (("2001-01-05", 1), ("2002-01-04", 3)), (("2002-01-04", 4),)):
        store.publish(_days(spark, *days))
        runs.append({line["written"] for line in store.lines().values()})
    assert store.versions() == [1, 2, 3] and store.remove_stale(3).count() == 0
    gone = sorted(r["path"].rsplit("/shard=")[-1] for r in store.remove_stale(1).where("path like 'data/%'").collect())
    assert gone == ["2001", "2002", "2002"]
    assert store.versions() == [3] and [r[1] for r in rows(store.read())] == [4]
    assert {p.parent.name for p in Path(store.root).glob("data/run=*/shard=*")} == {f"run={r}" for r in runs[-1]}


def test_of_two_writers_one_is_refused(spark, tmp_path, rows):
    store = ShardStore.of(spark, str(tmp_path), dataset("federal-funds"))
    base = store.publish(_days(spark, ("2001-01-05", 1), ("2002-01-04", 2))).version
    first = store.prepare(_days(spark, ("2001-01-05", 5)), ["2001"], base)
    second = store.prepare(_days(spark, ("2001-01-05", 6)), ["2001"], base)
    other = store.prepare(_days(spark, ("2002-01-04", 7)), ["2002"], base)
    assert commit_together([(store, first)], base)[0].version == 2
    with pytest.raises(ContractError, match="conflicting_version"):
        commit_together([(store, second)], base)
    assert commit_together([(store, other)], base)[0].version == 3
    assert [r[1] for r in rows(store.read())] == [5, 7] and [r[1] for r in rows(store.read(lines=store.lines(1)))] == [1, 2]


def test_of_writers_of_one_commit_one_takes_the_name(spark, tmp_path):
    import concurrent.futures

    path = str(tmp_path / "commits/00000001.json")
    with concurrent.futures.ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda i: files.create_once(spark, path, f"writer {i}"), range(4)))
    assert sum(taken) == 1 and files.read_small(spark, path) == f"writer {taken.index(True)}"
    assert not files.create_once(spark, path, "late") and [p.name for p in (tmp_path / "commits").glob("*.draft")] == []


def test_secured_update_is_a_no_op_when_repeated(spark, land, tmp_path, rows):
    path, root = land("s.csv", MIXED), str(tmp_path / "store")
    assert updates.update_secured(spark, root, path) == updates.RunMetrics(2, 0, 2, True)
    assert updates.update_secured(spark, root, path) == updates.RunMetrics(2, 2, 2, False)
    day = lookup.by_date(ShardStore.of(spark, root, dataset("sofr")), "2019-05-06").first()
    assert (day["rate_basis_points"], day["percentile_1_basis_points"], day["volume_billions"]) == (241, 205, 933)
    index = ShardStore.of(spark, root, dataset("sofr-index"))
    assert [r[1] for r in rows(index.read())] == [102000000, 102512345]
    average = ShardStore.of(spark, root, dataset("sofr-30d-average"))
    assert lookup.latest(average).first()[1] == 246000


def test_statutory_history_and_overlap(spark, tmp_path):
    root, name = str(tmp_path / "store"), "estate-gift-tax-exemption"
    store = ShardStore.of(spark, root, dataset(name))
    store.publish(spark.sql("SELECT DATE'1987-01-01' AS period_start_date, DATE'1997-12-31' AS period_end_date, 600000L AS basic_exclusion_amount_usd"))
    text = "Rev. Proc. 2026-40 In the estate of any decedent dying in\ncalendar year 2027, the basic\nexclusion amount is $15,400,000 for"
    docs = spark.createDataFrame([("u", text)], "url string, text string")
    assert updates.update_statutory(spark, root, name, docs, "url", "text", with_history=True) == updates.RunMetrics(52, 1, 52, True)
    assert updates.update_statutory(spark, root, name, docs, "url", "text", target_year=2025) == updates.RunMetrics(0, 52, 52, False)
    assert lookup.by_year(store, 1977).count() == 2
    assert lookup.by_year(store, 1988).count() == 1
    assert lookup.latest(store).first()["basic_exclusion_amount_usd"] == 15400000


def test_seeds(spark):
    assert seeds.gift_history(spark).count() == 72
    assert seeds.estate_history(spark).count() == 51
    assert seeds.gst_history(spark).count() == 40
    assert seeds.spouse_history(spark).count() == 29
    assert seeds.monthly_1996(spark).count() == 12
    assert str(seeds.gst_history(spark).agg(F.min("period_start_date")).first()[0]) == "1986-10-22"


def test_gst_skips_and_refuses_repeats(spark, tmp_path):
    sentence = "Rev. Proc. 2026-40\n\nFor calendar year 2027, the generation-skipping transfer exemption amount under\n§ 2631(c) is equal to $15,400,000."
    docs = spark.createDataFrame([("a", sentence), ("b", "Rev. Proc. 2025-1 other"), ("c", sentence.replace("15,400,000", "0"))], "url string, text string")
    assert updates.update_statutory(spark, str(tmp_path / "a"), "gst-exemption", docs, "url", "text") == updates.RunMetrics(1, 0, 1, True)
    again = spark.createDataFrame([("a", sentence.replace("2027", "2025").replace("15,400,000", "13,990,000"))], "url string, text string")
    with pytest.raises(ContractError, match="duplicate_source_record"):
        updates.update_statutory(spark, str(tmp_path / "b"), "gst-exemption", again, "url", "text", with_history=True)


PAGE = """<script>x</script><table><tr><th>Valuation month<th>120% of applicable federal midterm rate<th>Section 7520 interest rate<th>Revenue ruling
<tr><td>October 2014<td>2.22<td>2.22<td>Rev. Rul. 2014-26<tr><td>March&nbsp;2019<td>3.11%<td>3.2`<td>Rev. Rul 2019-7</table>For prior years"""


def test_monthly_page_with_correction(spark, tmp_path, rows):
    page = spark.createDataFrame([(seeds.PRIOR_YEARS_PAGE, PAGE)], "url string, html string")
    root = str(tmp_path / "store")
    assert updates.update_monthly(spark, root, page, "url", "html", with_history=True) == updates.RunMetrics(14, 0, 14, True)
    store = ShardStore.of(spark, root, dataset("section-7520-rates"))
    assert tuple(lookup.by_month(store, "2014-10").first()) == ("2014-10", 222, 220)
    assert tuple(lookup.by_month(store, "2019-03").first()) == ("2019-03", 311, 320)
    elsewhere = page.withColumn("url", F.lit("u"))
    other = str(tmp_path / "other")
    updates.update_monthly(spark, other, elsewhere, "url", "html")
    stored = ShardStore.of(spark, other, dataset("section-7520-rates"))
    assert tuple(lookup.by_month(stored, "2014-10").first()) == ("2014-10", 222, 222)
    march = page.withColumn("html", F.regexp_replace("html", "<tr><td>October.*?14-26", ""))
    updates.update_monthly(spark, other, march, "url", "html")
    assert tuple(lookup.by_month(stored, "2014-10").first()) == ("2014-10", 222, 220)
    header = F.regexp_replace("html", "<tr><td>.*</table>", "</table>")
    for html in (F.lit("<p>none"), header):
        bad = page.unionByName(page.select(F.lit("v").alias("url"), html.alias("html")))
        with pytest.raises(ContractError, match="html_table_not_found"):
            updates.update_monthly(spark, root, bad, "url", "html")


def ruling_text(lead="TABLE 1\n", month="Applicable Federal Rates (AFR) for May 1997"):
    lines = [f"Rev. Rul. 97-021\n{lead}{month}"]
    for heading, labels in (("Short-term", 4), ("Mid‑term", 6), ("Long-term", 4)):
        lines.append(f"│ {heading} │")
        for label in ("AFR", "110$ AFR", "120% AFR", "130% AFR", "150% AFR", "175% AFR")[:labels]:
            lines.append(f"{label} 5.20% 5.13% 5.10% 5.08%")
    lines += ["TABLE 2", "Adjusted AFR for May 1997", "Short-term adjusted", "Short-term 3.00% 2.98% 2.97% 2.96%", "Mid-term", "adjusted AFR 3.10% 3.08% 3.07% 3.06%",
              "Long-term", "adjusted AFR 3.20% 3.18% 3.17% 3.16%", "TABLE 3"]
    return "\n".join(lines)


def test_ruling_layouts(spark):
    texts = {
        "plain": ruling_text(), "unmarked": ruling_text(lead=""), "wrong year": ruling_text(month="Applicable Federal Rates (AFR) for May 1996"),
        "late end": ruling_text().replace("TABLE 3", "TABLE X"), "gap": ruling_text().replace("175% AFR", "176 AFR"),
    }
    parsed = rulings.parse_rulings(spark.createDataFrame(list(texts.items()), "url string, text string"), "url", "text")
    got = {r["source_url"]: r for r in parsed.collect()}
    assert [got[k]["problem"] for k in texts] == [None, None, None, "missing_field", "missing_field"]
    assert got["plain"]["revenue_ruling"] == "Rev. Rul. 97-21"
    assert [got[k]["effective_month"] for k in ("plain", "unmarked", "wrong year")] == ["1997-05", "1997-05", "1996-05"]
    assert got["plain"]["applicable_federal_rates"]["mid_term"]["afr_175"].asDict() == {"annual": 520, "semiannual": 513, "quarterly": 510, "monthly": 508}
    assert got["plain"]["adjusted_applicable_federal_rates"]["short_term"]["annual"] == 300


def test_ruling_update(spark, tmp_path):
    docs = spark.createDataFrame([("u", ruling_text()), ("v", "no table")], "url string, text string")
    root = str(tmp_path / "store")
    assert updates.update_rulings(spark, root, docs, "url", "text") == updates.RunMetrics(1, 0, 1, True)
    assert updates.update_rulings(spark, root, docs, "url", "text") == updates.RunMetrics(1, 1, 1, False)
    raw = ShardStore.of(spark, root, dataset("applicable-federal-rates")).read().select(F.to_json(F.struct("*")).alias("json"))
    records, problems = migrate.migrate_nested(raw)
    assert records.count() == 1 and problems.count() == 0


def grid(spark, lines):
    cells = [("w", 1, r, c, v) for r, line in enumerate(lines) for c, v in enumerate(line.split(",")) if v]
    return spark.createDataFrame(cells, "workbook string, sheet int, row int, col int, value string")


def test_grids(spark, rows):
    mortality = grid(spark, [",0,100000,,,40,9.5321070000000006E4,,,80,55210.4", ",1,99510.5,,,41,95111.9,,,81,52001.25"])
    got = dict(rows(grids.mortality_rows(mortality).drop("workbook")))
    assert sorted(got) == [0, 1, 40, 41, 80, 81] and got[40] == 95321070000
    single = grid(spark, ["Interest at 4.2 Percent", "60,1.5,.5,.5,,,,", "x", "Interest at 5.0 Percent,,,", "61,1,2,3,62,4,5,6"])
    assert rows(grids.single_life_rows(single)) == [(420, 60, 1500000, 500000, 500000), (500, 61, 1000000, 2000000, 3000000), (500, 62, 4000000, 5000000, 6000000)]


def test_actuarial_update(spark, tmp_path):
    cells = {"mortality-table-2010cm": grid(spark, [",0,200,,,1,150,,,2,0"])}
    done = updates.update_actuarial(spark, str(tmp_path), cells)
    assert all(p.changed for p in done.values()) and len(done) == 3
    store = ShardStore.of(spark, str(tmp_path), dataset("life-expectancy-by-age"))
    assert tuple(store.read().filter("age = 0").first())[1:] == (750000, 1250000)
    table_d = ShardStore.of(spark, str(tmp_path), dataset("actuarial-table-d"))
    assert lookup.factor(table_d, 100, term_years=2).first()["unitrust_remainder_factor_scaled_1e6"] == 980100
    assert not any(p.changed for p in updates.update_actuarial(spark, str(tmp_path), cells).values())
    twice = {"mortality-table-2010cm": grid(spark, [",0,200,,,0,150,,,2,0"])}
    with pytest.raises(ContractError, match="duplicate_record"):
        updates.update_actuarial(spark, str(tmp_path), twice)


def test_table_d_is_exact(spark):
    from decimal import ROUND_HALF_UP, Decimal

    got = {(r[0], r[1]): r[2] for r in term_unitrust_table(spark).collect()}
    assert len(got) == 2000
    for (rate, years), value in got.items():
        exact = ((1 - Decimal(rate) / 10000) ** years).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        assert value == int(exact * 1000000)


def test_import_tables(spark, tmp_path, rows):
    source = "2015 VBT Relative Risk Tables"
    def table(risk, rate=41):
        return (f"2015_vbt_relative_risk_tables__2015_male_non_smoker_rr{risk}_anb.json", source, "t", 9001, {"18": {"1": rate, "2": 45}}, {"18": 41, "19": 38})

    schema = "file_name string, source string, table string, table_identity bigint, select_rates map<string,map<string,bigint>>, ultimate_rates map<string,bigint>"
    raw = spark.createDataFrame([table(100), table(50)], schema)
    done = updates.import_tables(spark, str(tmp_path), raw, expected=2)
    assert all(p.changed for p in done.values())
    stores = updates.table_stores(spark, str(tmp_path))
    name = "2015_vbt_relative_risk_tables__2015_male_non_smoker_rr100_anb"
    assert lookup.select_rate(stores["select"], name, 18, 2).first()["rate"] == 45
    assert lookup.ultimate_rate(stores["ultimate"], name, 19).first()["rate"] == 38
    for bad, expected in ((raw, 68), (spark.createDataFrame([table(100, 100001)], schema), 1), (spark.createDataFrame([table("x")], schema), 1)):
        with pytest.raises(ContractError, match="invalid"):
            updates.import_tables(spark, str(tmp_path / "n"), bad, expected=expected)


def test_legacy_shapes(spark, land, rows):
    old = {"valuation_month": "2019-04", "applicable_federal_midterm_120_percent_basis_points": 305, "section_7520_rate_basis_points": 300, "revenue_ruling": "Rev. Rul. 2019-8"}
    new = {"effective_month": "2019-03", "midterm_afr_120_basis_points": 311, "section_7520_rate_basis_points": 320}
    raw = shards.read_raw_records(spark, land("m.json", json.dumps([old, new])))
    records, problems = migrate.migrate_monthly(raw)
    assert rows(records) == [("2019-03", 311, 320), ("2019-04", 305, 300)] and problems.count() == 0
    extra = shards.read_raw_records(spark, land("n.json", json.dumps([{**new, "x": 1}])))
    assert [r["rule"] for r in migrate.migrate_monthly(extra)[1].collect()] == ["keys"]
    repeated = shards.read_raw_records(spark, land("r.json", '[{"a": 1, "a": 2}]'))
    assert repeated.first()["repeated_key"]
    sofr = {"date": "2019-05-06", "rate_type": "SOFR", "rate_basis_points": 241, "percentiles_basis_points": {"1": -5, "25": 240, "75": 248, "99": 271}, "volume_billions": 933,
            **{m: None for m in feeds.AVERAGED}, "revision_indicator": None, "footnote_id": None}
    wide, found = migrate.migrate_overnight(shards.read_raw_records(spark, land("s.json", json.dumps([sofr]))), "sofr")
    assert found.count() == 0 and wide.first()["percentile_1_basis_points"] == -5
    for field, value in (("rate_basis_points", True), ("volume_billions", 10_000_001), ("rate_type", "EFFR")):
        bad = shards.read_raw_records(spark, land(f"b-{field}.json", json.dumps([{**sofr, field: value}])))
        assert migrate.migrate_overnight(bad, "sofr")[1].count() == 1
    from tabulary.functions.records import TENOR_KEYS
    curve = [{"date": "2031-03-02", "par_yields_basis_points": {k: i for i, k in enumerate(TENOR_KEYS)}}, {"date": "2031-03-03", "par_yields_basis_points": [None] * 14},
             {"date": "2031-03-04", "par_yields_basis_points": [1]}]
    good, wrong = migrate.migrate_curve(shards.read_raw_records(spark, land("c.json", json.dumps(curve))))
    assert [r["rule"] for r in wrong.collect()] == ["tenors"]
    assert good.filter("date = '2031-03-02'").first()["par_yields_basis_points"] == list(range(14))


def canonical(records):
    return json.dumps(records, indent=2, ensure_ascii=False) + "\n"


def test_shard_readers(spark, land, tmp_path, rows):
    data = dataset("federal-funds")
    land("ff/by-year/2000-fed-funds.json", canonical([{"date": "2000-03-03", "rate_basis_points": 411}, {"date": "2000-03-06", "rate_basis_points": None}]))
    land("ff/by-year/2001.json", canonical([{"date": "2001-02-02", "rate_basis_points": 398}]))
    land("ff/by-year/2003.json", canonical([]))
    folder = str(tmp_path / "landing/ff")
    assert len(rows(shards.read_year_shards(spark, folder, data))) == 3
    for name, text, rule in (
        ("2002", canonical([{"date": "2001-01-03", "rate_basis_points": 1}]), "shard year"),
        ("2004", json.dumps([{"date": "2004-01-03", "rate_basis_points": 1}]), "record layout"),
        ("2005", '[\n  {\n    "date": "2005-01-03",\n    "date": "2005-01-04",\n    "rate_basis_points": 1\n  }\n]\n', "record layout"),
        ("2006", canonical([{"date": "2006-01-03"}]), "record keys"),
        ("2007", canonical([{"date": "2007-01-03", "rate_basis_points": 1}])[:-8], "record layout"),
        ("2008", canonical([{"date": "2008-01-03", "rate_basis_points": 1}]) * 2, "record layout"),
    ):
        found = shards.year_shard_rows(spark, land(f"bad-{name}/by-year/{name}.json", text), data)[1]
        assert rule in [r["rule"] for r in found.collect()]
        with pytest.raises(ContractError, match="invalid"):
            shards.read_year_shards(spark, str(tmp_path / f"landing/bad-{name}"), data)
    assert shards.read_single(spark, folder + "/none.json", data).count() == 0
    land("d/by-interest-rate/00020-basis-points.json", canonical([{"term_years": 1, "unitrust_remainder_factor_scaled_1e6": 998000}]))
    assert rows(shards.read_rate_shards(spark, str(tmp_path / "landing/d"), dataset("actuarial-table-d"))) == [(20, 1, 998000)]
    record = {"schema_id": "s", "schema_version": 1, "dataset_id": "federal-funds", "record_key": "2000-03-03", "record": {"date": "2000-03-03", "rate_basis_points": 411}}
    land("api/2000-03-03.json", json.dumps(record))
    got = shards.read_lookups(spark, str(tmp_path / "landing/api"), data).first()
    assert (str(got["date"]), got["rate_basis_points"]) == ("2000-03-03", 411)


def test_large_shard_is_read_by_several_tasks(spark, land):
    days = [{"date": str(datetime.date(2000, 1, 1) + datetime.timedelta(days=i % 366)), "rate_basis_points": i} for i in range(20_000)]
    path = land("big/by-year/2000-fed-funds.json", canonical(days))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        found, broken = shards.year_shard_rows(spark, path, dataset("federal-funds"))
        assert found.rdd.getNumPartitions() > 4
        assert found.count() == 20_000 and found.agg({"rate_basis_points": "sum"}).first()[0] == sum(range(20_000)) and broken.isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_published_layout(spark, tmp_path):
    root = str(tmp_path / "root")
    rows = lambda *days: spark.createDataFrame([(datetime.date.fromisoformat(d), r) for d, r in days], dataset("federal-funds").schema)
    first = {r["path"]: r for r in artifacts.publish(spark, root, {"federal-funds": rows(("2001-02-03", 5), ("2000-01-02", None), ("2000-01-01", 7))}).collect()}
    assert all(r["changed"] for r in first.values())
    text = (tmp_path / "root/fed-funds/by-year/2000-fed-funds.json").read_text()
    assert text == canonical([{"date": "2000-01-01", "rate_basis_points": 7}, {"date": "2000-01-02", "rate_basis_points": None}])
    for path, r in first.items():
        content = (tmp_path / "root" / path).read_bytes()
        assert (len(content), hashlib.sha256(content).hexdigest()) == (r["bytes"], r["sha256"])
        assert json.loads(content) is not None
    manifest = json.loads((tmp_path / "root/fed-funds/manifest.json").read_text())
    assert [(y["path"], y["shard"], y["record_count"], y["first_key"]) for y in manifest["years"]] == [
        ("by-year/2000-fed-funds.json", "2000", 2, "2000-01-01"), ("by-year/2001-fed-funds.json", "2001", 1, "2001-02-03")]
    api = json.loads((tmp_path / "root/api/v1/index.json").read_text())["datasets"][0]
    assert api["latest"]["record_key"] == "2001-02-03" and api["lookup"] == {"file_count": 3, "first_key": "2000-01-01", "last_key": "2001-02-03"}
    again = artifacts.publish(spark, root, {"federal-funds": rows(("2000-01-01", 8), ("2000-01-02", None))})
    assert {r["path"]: r["changed"] for r in again.where("not contains(path, 'index')").collect()} == {
        "fed-funds/by-year/2000-fed-funds.json": True, "fed-funds/manifest.json": True, "api/v1/datasets/federal-funds/latest.json": True,
        "api/v1/datasets/federal-funds/by-date/2000-01-01.json": True, "api/v1/datasets/federal-funds/by-date/2000-01-02.json": False}
    left = {str(p.relative_to(tmp_path / "root")) for p in (tmp_path / "root").rglob("*.json")}
    assert left == {r["path"] for r in again.collect()}
    with pytest.raises(ContractError, match="duplicate_key"):
        artifacts.publish(spark, root, {"federal-funds": rows(("2000-01-01", 8), ("2000-01-01", 9))})
    empty = artifacts.publish(spark, str(tmp_path / "empty"), {"federal-funds": rows()}).collect()
    assert sorted(r["path"] for r in empty) == ["api/v1/index.json", "fed-funds/manifest.json", "index.json"]


def entry(path, **changes):
    return {"year": "1998", "periods": ["1998-08"], "subjects": ["afr"], "path": path, "source_url": "https://www.irs.gov/pub/irs-drop/rr-1.pdf", "title": "Rev. Rul. 98-36",
            "retrieved_date": "2026-01-05", "bytes": 3, "sha256": "0" * 64, **changes}


def test_register(spark, land, rows):
    path = land("register.json", json.dumps({"archive_id": "irs-revenue-rulings", "entries": [entry("p"), entry("q", periods=["1998-09"])]}))
    entries = documents.read_register(spark, path)
    assert entries.count() == 2
    for bad in (entry("p", extra=1), entry("p", sha256="x"), entry("p", periods=[]), entry("p", source_url="http://x/a.pdf")):
        with pytest.raises(ContractError):
            documents.read_register(spark, land("bad.json", json.dumps({"archive_id": "irs-revenue-rulings", "entries": [bad]})))
    new = spark.createDataFrame([entry("p", title="other")], documents.ENTRY)
    assert [r["title"] for r in documents.register_entries(entries, new).checked().orderBy("path").collect()] == ["other", "Rev. Rul. 98-36"]
    with pytest.raises(ContractError, match="conflicting_record"):
        documents.register_entries(entries, spark.createDataFrame([entry("p", bytes=4)], documents.ENTRY)).checked()
    index = land("index.md", "| Rate month | Rates covered | Revenue ruling | Link |\n| --- | --- | --- | --- |\n| 1998-08 | AFR | x | [Link](https://e) |\n"
                             "| 1985-04 | AFR | y | [Link](https://e) |\n| 1998-09 | AFR | z | [PDF](by-year/z) |\n")
    built = [tuple(r) for r in documents.build_index(entries, documents.read_index(spark, index)).collect()]
    assert built == [("1998-09", "AFR", "Rev. Rul. 98-36", "[PDF](q)"), ("1998-08", "AFR", "Rev. Rul. 98-36", "[PDF](p)"), ("1985-04", "AFR", "y", "[Link](https://e)")]


def test_stream(spark, land, tmp_path, rows):
    store = ShardStore.of(spark, str(tmp_path / "store"), dataset("federal-funds"))
    def decode(cells):
        return feeds.decode_overnight(cells, "EFFR").select("date", "rate_basis_points")

    def run():
        stream_feed(spark, str(tmp_path / "landing/s"), ", ".join(f"`{h}` string" for h in feeds.OVERNIGHT_HEADERS), decode, store,
                    ["date"], ["rate_basis_points"], str(tmp_path / "checkpoint")).awaitTermination()
        return [r[1] for r in rows(store.read())]

    land("s/1.csv", OVERNIGHT)
    assert run() == [251, None, 247]
    version = max(line["version"] for line in store.lines().values())
    land("s/2.csv", OVERNIGHT)
    assert run() == [251, None, 247]
    assert max(line["version"] for line in store.lines().values()) == version
    land("s/3.csv", OVERNIGHT.replace("02/07/2005,EFFR,,", "02/07/2005,EFFR,2.49,"))
    assert run() == [251, 249, 247]


def test_registry():
    assert len(DATASETS) == 25
    assert sum(d.route is not None for d in DATASETS.values()) == 13
    assert {d.layout for d in DATASETS.values()} == {"by_year", "single", "by_rate", "by_table"}

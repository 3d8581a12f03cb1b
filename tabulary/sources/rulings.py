"""Ruling texts: two text tables become one nested record per document.

A document is one row. Lines live in an array inside it, and the sections, months
and rate rows are found with array functions, so documents need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTH_WORD, month_key
from ..functions.decoded import let
from ..functions.numbers import MAX_BASIS_POINTS, bare_percent, scale_exactly
from ..functions.records import COMPOUNDING, FAMILIES
from ..functions.text import rate_label, ruling_citation, term_label, text_lines

# Shapes of month lines and of the two kinds of rate rows.
MONTH_LINE = rf"Applicable Federal Rates \(AFR\) for {MONTH_WORD} ([0-9]{{4}})"
ADJUSTED_MONTH_LINE = rf"Adjusted AFR for {MONTH_WORD} ([0-9]{{4}})"
_FOUR = r"\s+([0-9.]+%)\s+([0-9.]+%)\s+([0-9.]+%)\s+([0-9.]+%)$"
LABEL_ROW = r"(?i)^((?:[0-9]{3}[%$] )?AFR|adjusted AFR)" + _FOUR
TERM_ROW = r"(?i)^(Short-term|Mid-term|Long-term)" + _FOUR
PLACES = "map<string,struct<annual:int,semiannual:int,quarterly:int,monthly:int>>"
ENTRY = "struct<term:string,family:string,cells:array<string>,whole_term:boolean>"


def line_month(line: Column, shape: str = MONTH_LINE) -> Column:
    return let(
        F.regexp_substr(line, F.lit(shape)),
        lambda found: month_key(F.regexp_extract(found, shape, 1), F.regexp_extract(found, shape, 2)),
    )


def described_lines(lines: Column) -> Column:
    """The lines that can matter, each looked at once.

    Position, markers, months, and the term, family and cells of rate rows. Plain
    searches decide which patterns a line is worth.
    """
    def worth(line: Column) -> Column:
        small = F.lower(line)
        return F.contains(line, F.lit("TABLE")) | F.contains(small, F.lit("afr")) | F.contains(small, F.lit("term"))

    def describe(line: Column) -> Column:
        dated = F.contains(line, F.lit("AFR")) & F.contains(line, F.lit(" for "))
        # White space is collapsed, so a rate row is its label and four last words.
        tail = F.substring_index(line, " ", -4)
        label = F.left(line, F.length(line) - F.length(tail) - 1)
        rated = line.endswith("%")
        return F.struct(
            *[F.contains(line, F.lit(f"TABLE {n}")).alias(f"table_{n}") for n in (1, 2, 3)],
            F.contains(line, F.lit("Applicable Federal Rates (AFR)")).alias("titled"),
            F.when(dated, line_month(line)).alias("month"),
            F.when(dated, line_month(line, ADJUSTED_MONTH_LINE)).alias("adjusted_month"),
            F.when(~rated, term_label(line)).alias("heading"),
            F.when(rated & line.rlike(TERM_ROW), term_label(label)).alias("row_term"),
            F.when(rated & line.rlike(LABEL_ROW), rate_label(label)).alias("family"),
            F.when(rated, F.split(tail, " ")).alias("cells"),
        )

    numbered = F.transform(lines, lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    kept = F.filter(numbered, lambda x: worth(x["line"]))
    return F.transform(kept, lambda x: F.struct(x["at"].alias("at"), describe(x["line"]).alias("is")))


def _month_after(described: Column, marker: str, stop: str) -> Column:
    """First month line after a marker line, unless the stop marker comes first.

    A later marker line starts the search again, so the search is a fold.
    """
    start = F.struct(F.lit(False).alias("searching"), F.lit(None).cast("string").alias("month"))

    def step(state: Column, x: Column) -> Column:
        line = x["is"]
        going = state["searching"] & ~line[stop]
        hit = F.when(state["searching"], F.coalesce(line["month"], line["adjusted_month"]))
        return F.when(state["month"].isNotNull(), state).otherwise(
            F.struct((going | line[marker]).alias("searching"), hit.alias("month"))
        )

    return F.aggregate(described, start, step)["month"]


def month_after(lines: Column, marker: str, stop: str) -> Column:
    return let(described_lines(lines), lambda d: _month_after(d, _field(marker), _field(stop)))


def _field(marker: str) -> str:
    return {"Applicable Federal Rates (AFR)": "titled"}.get(marker, marker.lower().replace(" ", "_"))


def _first(described: Column, field: str, start: Column | None = None) -> Column:
    """Position of the first line with a marker, at or after ``start``; null if none."""
    def has(x: Column) -> Column:
        return x["is"][field] if start is None else x["is"][field] & (x["at"] >= start)

    return F.try_element_at(F.filter(described, has), F.lit(1))["at"]


def _unmarked_month(described: Column) -> Column:
    """First month line before any table 2 marker."""
    found = F.try_element_at(
        F.filter(described, lambda x: x["is"]["table_2"] | x["is"]["month"].isNotNull()), F.lit(1)
    )
    return let(found, lambda x: F.when(~x["is"]["table_2"], x["is"]["month"]))


def _effective_month(described: Column, ruling_year: Column) -> Column:
    """Month of table 1; table 2 wins when table 1's year is not the ruling's."""
    first = F.coalesce(_month_after(described, "table_1", "table_2"), _unmarked_month(described))
    second = _month_after(described, "table_2", "table_3")

    def choose(a: Column, b: Column) -> Column:
        swap = (F.substring(a, 1, 4) != ruling_year) & (F.substring(b, 1, 4) == ruling_year)
        return F.when(F.coalesce(swap, F.lit(False)), b).otherwise(a)

    return let(first, lambda a: let(second, lambda b: choose(a, b)))


def effective_month(lines: Column, ruling_year: Column) -> Column:
    return let(described_lines(lines), lambda d: _effective_month(d, ruling_year))


def _between(described: Column, start: str, end: str) -> Column:
    """Lines after the first start marker and before the end marker; null if either lacks.

    The end marker is looked for from the second line after the start.
    """
    def cut(begin: Column) -> Column:
        return let(
            _first(described, end, begin + 2),
            lambda finish: F.when(
                finish.isNotNull(), F.filter(described, lambda x: (x["at"] > begin) & (x["at"] < finish))
            ),
        )

    return let(_first(described, start), cut)


def _entries(section: Column) -> Column:
    """Rate rows with the term in force: array of (term, family, cells, whole_term)."""
    rows = F.filter(
        F.transform(section, lambda x: x["is"]),
        lambda r: r["row_term"].isNotNull() | r["heading"].isNotNull() | r["family"].isNotNull(),
    )
    start = F.struct(F.lit(None).cast("string").alias("term"), F.array().cast(f"array<{ENTRY}>").alias("entries"))

    def step(state: Column, row: Column) -> Column:
        term = F.coalesce(row["row_term"], row["heading"], state["term"])
        whole = row["row_term"].isNotNull()
        usable = whole | (row["heading"].isNull() & row["family"].isNotNull() & state["term"].isNotNull())
        entry = F.struct(
            term.alias("term"), F.when(~whole, row["family"]).alias("family"), row["cells"].alias("cells"),
            whole.alias("whole_term"),
        ).cast(ENTRY)
        return F.struct(
            term.alias("term"),
            F.when(usable, F.array_append(state["entries"], entry)).otherwise(state["entries"]).alias("entries"),
        )

    return F.aggregate(rows, start, step)["entries"]


def _decoded_cells(entry: Column) -> Column:
    """Four decoded cells; a bad cell is null."""
    def decoded(cell: Column) -> Column:
        return let(bare_percent(cell), lambda x: scale_exactly(x, 2, 0, MAX_BASIS_POINTS)).cast("int")

    return F.struct(*[decoded(entry["cells"][i]).alias(name) for i, name in enumerate(COMPOUNDING)])


def _by_place(entries: Column, adjusted: bool) -> Column:
    """Map from place (``term.family`` or term) to its cells; the last row of a place wins."""
    def place(e: Column) -> Column:
        return e["term"] if adjusted else F.concat_ws(".", e["term"], e["family"])

    wanted = entries
    if adjusted:
        wanted = F.filter(entries, lambda e: e["whole_term"] | (e["family"] == "adjusted_afr"))
    pairs = F.transform(wanted, lambda e: F.struct(place(e).alias("key"), _decoded_cells(e).alias("value")))
    return F.aggregate(
        pairs,
        F.create_map().cast(PLACES),
        lambda done, pair: F.map_concat(
            F.map_filter(done, lambda k, v: k != pair["key"]), F.create_map(pair["key"], pair["value"])
        ).cast(PLACES),
    )


FIRST_PLACES = [f"{t}.{f}" for t, fs in FAMILIES.items() for f in fs]


def _record(citation: Column, described: Column) -> Column:
    """Struct of month, both maps and whether all places are there."""
    year = F.regexp_extract(citation, r"Rev\. Rul\. ([0-9]+)-", 1)
    first = let(
        F.coalesce(_between(described, "table_1", "table_2"), _between(described, "titled", "table_2")),
        lambda lines: _by_place(_entries(lines), adjusted=False),
    )
    second = let(_between(described, "table_2", "table_3"), lambda lines: _by_place(_entries(lines), adjusted=True))
    return F.struct(
        citation.alias("revenue_ruling"), _effective_month(described, year).alias("effective_month"),
        first.alias("first"), second.alias("second"),
    )


def parse_rulings(documents: DataFrame, url: str, text: str) -> DataFrame:
    """One row per document: month, citation, both tables, and ``problem`` when unusable."""
    record = let(
        text_lines(F.col(text)),
        lambda lines: let(
            ruling_citation(F.array_join(lines, "\n")),
            lambda citation: let(described_lines(lines), lambda described: _record(citation, described)),
        ),
    )
    parsed = documents.select(F.col(url).alias("source_url"), record.alias("r"))

    def cell(side: str, place: str, name: str) -> Column:
        return F.try_element_at(F.col(f"r.{side}"), F.lit(place))[name]

    percentages = F.struct(
        *[
            F.struct(
                *[
                    F.struct(*[cell("first", f"{t}.{f}", c).alias(c) for c in COMPOUNDING]).alias(f) for f in families
                ]
            ).alias(t)
            for t, families in FAMILIES.items()
        ]
    )
    adjusted = F.struct(
        *[F.struct(*[cell("second", t, c).alias(c) for c in COMPOUNDING]).alias(t) for t in FAMILIES]
    )

    def exactly(side: str, places: list[str]) -> Column:
        keys = F.array_sort(F.map_keys(F.col(f"r.{side}")))
        whole = F.forall(
            F.map_values(F.col(f"r.{side}")),
            lambda v: v["annual"].isNotNull() & v["semiannual"].isNotNull() & v["quarterly"].isNotNull() & v["monthly"].isNotNull(),
        )
        return F.coalesce((keys == F.array(*[F.lit(p) for p in sorted(places)])) & whole, F.lit(False))

    complete = (
        F.col("r.revenue_ruling").isNotNull() & F.col("r.effective_month").isNotNull()
        & exactly("first", FIRST_PLACES) & exactly("second", list(FAMILIES))
    )
    return parsed.select(
        "source_url", "r.revenue_ruling", "r.effective_month",
        percentages.alias("applicable_federal_rates"), adjusted.alias("adjusted_applicable_federal_rates"),
        F.when(~complete, "missing_field").alias("problem"),
    )

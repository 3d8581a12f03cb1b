"""The 25 published datasets: schema, natural key, layout and lookup route."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .functions.records import COMPOUNDING, FAMILIES


@dataclass(frozen=True)
class Dataset:
    """One published dataset. ``provenance`` columns never count as a change."""

    name: str
    folder: str
    layout: str  # by_year, single, by_rate or by_table
    keys: tuple[str, ...]
    schema: T.StructType
    route: str | None = None  # by-date, by-month or by-year
    rate_column: str | None = None
    provenance: tuple[str, ...] = field(default=("source_url",))

    @property
    def schema_id(self) -> str:
        # Fixed value: the published naming scheme for schemas.
        return f"tabulary.{self.name.replace('-', '_')}.v1"

    @property
    def schema_version(self) -> int:
        return 1

    @property
    def values(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name not in self.keys]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_DATE, _TEXT, _INT, _LONG = T.DateType(), T.StringType(), T.IntegerType(), T.LongType()
_COMPOUNDED = _schema(*[(name, _INT, False) for name in COMPOUNDING])
_TERMS = T.StructType(
    [
        T.StructField(term, _schema(*[(name, _COMPOUNDED, False) for name in names]), False)
        for term, names in FAMILIES.items()
    ]
)
_ADJUSTED = _schema(*[(term, _COMPOUNDED, False) for term in FAMILIES])


def _period(amount: str) -> T.StructType:
    return _schema(
        ("period_start_date", _DATE, False), ("period_end_date", _DATE, False), (amount, _LONG, False)
    )


def _series(*values: tuple[str, T.DataType, bool]) -> T.StructType:
    return _schema(("date", _DATE, False), *values)


def _factors(rate: str, keys: tuple[str, ...], names: tuple[str, ...]) -> T.StructType:
    return _schema(
        (rate, _INT, False),
        *[(key, _INT, False) for key in keys],
        *[(f"{name}_scaled_1e6", _LONG, False) for name in names],
    )


_INTEREST, _PAYOUT = "interest_rate_basis_points", "adjusted_payout_rate_basis_points"
_PERIOD_KEYS = ("period_start_date", "period_end_date")


def _year(name: str, folder: str, route: str, schema: T.StructType) -> Dataset:
    return Dataset(name, folder, "by_year", (schema.fields[0].name,), schema, route)


def _statutory(name: str, amount: str) -> Dataset:
    return Dataset(name, name, "single", _PERIOD_KEYS, _period(amount), "by-year")


def _rated(name: str, rate: str, keys: tuple[str, ...], factors: tuple[str, ...]) -> Dataset:
    return Dataset(
        f"actuarial-table-{name}", f"actuarial/table-{name}", "by_rate", (rate, *keys),
        _factors(rate, keys, factors), rate_column=rate,
    )


def _aged(name: str, values: tuple[str, ...]) -> Dataset:
    schema = _schema(("age", _INT, False), *[(f"{v}_scaled_1e6", _LONG, False) for v in values])
    return Dataset(name, f"actuarial/{name}", "single", ("age",), schema)


TABLE_SCHEMA = _schema(
    ("table_id", _TEXT, False), ("table_identity", _LONG, False), ("source", _TEXT, False),
    ("table", _TEXT, False), ("family", _TEXT, False), ("table_set", _TEXT, False),
    ("basis", _TEXT, False), ("structure", _TEXT, False), ("sex", _TEXT, False),
    ("smoker", _TEXT, False), ("age_basis", _TEXT, False), ("shape", _TEXT, False),
    ("year", _INT, False), ("relative_risk_percent", _INT, False),
    ("select_rates", T.MapType(_TEXT, T.MapType(_TEXT, _LONG)), False),
    ("ultimate_rates", T.MapType(_TEXT, _LONG), False),
)

# Dataset names, folders, keys and routes.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        _year(
            "section-7520-rates", "7520", "by-month",
            _schema(
                ("effective_month", _TEXT, False), ("midterm_afr_120_basis_points", _INT, False),
                ("section_7520_rate_basis_points", _INT, False),
            ),
        ),
        _year(
            "applicable-federal-rates", "afr", "by-month",
            _schema(
                ("effective_month", _TEXT, False), ("applicable_federal_rates", _TERMS, False),
                ("adjusted_applicable_federal_rates", _ADJUSTED, False),
            ),
        ),
        _statutory("annual-gift-exclusion", "annual_exclusion_amount_usd"),
        _statutory("estate-gift-tax-exemption", "basic_exclusion_amount_usd"),
        _statutory("gst-exemption", "exemption_amount_usd"),
        _statutory("noncitizen-spouse-gift-exclusion", "annual_exclusion_amount_usd"),
        _year(
            "treasury-yield-curve", "treasury/treasury-yield-curve", "by-date",
            _series(("par_yields_basis_points", T.ArrayType(_INT, True), False)),
        ),
        _year("federal-funds", "fed-funds", "by-date", _series(("rate_basis_points", _INT, True))),
        _year(
            "sofr", "sofr", "by-date",
            _series(
                ("rate_basis_points", _INT, True), ("percentile_1_basis_points", _INT, True),
                ("percentile_25_basis_points", _INT, True), ("percentile_75_basis_points", _INT, True),
                ("percentile_99_basis_points", _INT, True), ("volume_billions", _LONG, True),
            ),
        ),
        *[
            _year(
                f"sofr-{days}d-average", f"sofr/sofr-{days}d-average", "by-date",
                _series((f"average_{days}_day_basis_points_scaled_1000", _LONG, False)),
            )
            for days in (30, 90, 180)
        ],
        _year("sofr-index", "sofr/sofr-index", "by-date", _series(("sofr_index_scaled_100000000", _LONG, False))),
        _aged("mortality-table-2000cm", ("survivors_per_100000",)),
        _aged("mortality-table-2010cm", ("survivors_per_100000",)),
        _aged("life-expectancy-by-age", ("curtate_life_expectancy_years", "complete_life_expectancy_years")),
        _rated("b", _INTEREST, ("term_years",), ("annuity_factor", "income_interest_factor", "remainder_factor")),
        _rated("d", _PAYOUT, ("term_years",), ("unitrust_remainder_factor",)),
        _rated("h", _INTEREST, ("age",), ("dx", "nx", "mx")),
        _rated("r2", _INTEREST, ("older_age", "younger_age"), ("remainder_factor",)),
        _rated("s", _INTEREST, ("age",), ("annuity_factor", "life_estate_factor", "remainder_factor")),
        _rated("u1", _PAYOUT, ("age",), ("unitrust_remainder_factor",)),
        _rated("u2", _PAYOUT, ("older_age", "younger_age"), ("unitrust_remainder_factor",)),
        _rated("z", _PAYOUT, ("age",), ("udx", "unx", "umx")),
        Dataset(
            "valuation-basic-table-2015", "actuarial/2015-vbt", "by_table", ("table_id",), TABLE_SCHEMA,
            provenance=(),
        ),
    )
}


def dataset(name: str) -> Dataset:
    return DATASETS[name]

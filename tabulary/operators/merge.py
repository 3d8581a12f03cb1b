"""Merging a feed into history. Three dialects that differ on repeated rows.

All of them put both sides into one grouping by key instead of joining two grouped
inputs: one shuffle finds repeated keys, conflicts and the surviving row, and the
map-side half of the aggregate collapses copies of a hot key before they travel.
Only keys that occur in the feed can change, so callers that know the feed's
shards pass only those shards of the history (see ``plans.updates``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ContractError

# Outcome of one key.
KEPT, INSERTED, SAME, ENRICHED = "kept", "inserted", "same", "enriched"
# Outcomes that stop a run.
REPEATED_HISTORY, REPEATED_SOURCE, CONFLICT = (
    "duplicate_json_record", "duplicate_source_record", "conflicting_record",
)
FAILURES = (REPEATED_HISTORY, REPEATED_SOURCE, CONFLICT)


@dataclass(frozen=True)
class MergeResult:
    """Every key with its outcome; ``records`` is only meaningful when clean."""

    outcomes: DataFrame
    columns: list[str]

    @property
    def records(self) -> DataFrame:
        return self.outcomes.select(*self.columns)

    @property
    def violations(self) -> DataFrame:
        return self.outcomes.filter(F.col("outcome").isin(*FAILURES)).select(
            F.lit("merge").alias("rule"),
            F.col("merge_key").alias("key"),
            F.col("outcome").alias("code"),
        )

    def metrics(self) -> DataFrame:
        """Source, existing and final counts, and whether anything changed."""
        changed = F.col("outcome").isin(INSERTED, ENRICHED)
        return self.outcomes.agg(
            F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source"),
            F.coalesce(F.sum("history_rows"), F.lit(0)).alias("existing"),
            F.count(F.lit(1)).alias("final"),
            F.coalesce(F.max(changed.cast("int")), F.lit(0)).alias("changed"),
        )

    def checked(self) -> DataFrame:
        """The merged records, after an action that proves them clean."""
        sample = self.violations.limit(3).collect()
        if sample:
            raise ContractError(sample[0]["code"], ", ".join(row["key"] for row in sample))
        return self.records


def _both_sides(
    history: DataFrame, source: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """History and feed rows in one frame, ``side`` 0 and 1."""
    left = history.select(F.lit(0).alias("side"), *columns)
    right = source.select(F.lit(1).alias("side"), *columns)
    return left.unionByName(right)


def _merge_key(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("merge_key")


def _same(values: list[str]) -> Column:
    """Equal in all published values; two nulls are equal."""
    equal = F.lit(True)
    for name in values:
        equal = equal & F.col(f"h.{name}").eqNullSafe(F.col(f"s.{name}"))
    return equal


def _outcome(strict: bool, enrich: list[str] | None, values: list[str]) -> Column:
    both = (F.col("history_rows") > 0) & (F.col("source_rows") > 0)
    result = F.when(F.lit(False), F.lit(""))
    if strict:
        result = result.when(F.col("history_rows") > 1, F.lit(REPEATED_HISTORY))
        result = result.when(F.col("source_rows") > 1, F.lit(REPEATED_SOURCE))
    else:
        result = result.when(F.col("history_distinct") > 1, F.lit(CONFLICT))
        result = result.when(F.col("source_distinct") > 1, F.lit(REPEATED_SOURCE))
    result = result.when(~both & (F.col("history_rows") > 0), F.lit(KEPT))
    result = result.when(~both, F.lit(INSERTED))
    result = result.when(_same(values), F.lit(SAME))
    if enrich is not None:
        fills, fits = F.lit(False), F.lit(True)
        for name in values:
            old, new = F.col(f"h.{name}"), F.col(f"s.{name}")
            if name in enrich:
                fills = fills | (old.isNull() & new.isNotNull())
                fits = fits & (old.isNull() | old.eqNullSafe(new))
            else:
                fits = fits & old.eqNullSafe(new)
        result = result.when(fits & fills, F.lit(ENRICHED))
    return result.otherwise(F.lit(CONFLICT))


def _one_row_per_key(
    history: DataFrame, source: DataFrame, keys: list[str], values: list[str],
    provenance: list[str], enrich: list[str] | None,
) -> MergeResult:
    columns = [*keys, *values, *provenance]
    body = F.struct(*values, *provenance)
    grouped = (
        _both_sides(history, source, keys, columns)
        .groupBy(*keys)
        .agg(
            F.count(F.when(F.col("side") == 0, 1)).alias("history_rows"),
            F.count(F.when(F.col("side") == 1, 1)).alias("source_rows"),
            F.max(F.when(F.col("side") == 0, body)).alias("h"),
            F.max(F.when(F.col("side") == 1, body)).alias("s"),
        )
        .withColumn("outcome", _outcome(True, enrich, values))
    )
    take_source = F.col("outcome").isin(INSERTED, ENRICHED)
    outcomes = grouped.select(
        *keys,
        *[F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in [*values, *provenance]],
        "outcome", "history_rows", "source_rows", _merge_key(keys),
    )
    return MergeResult(outcomes, columns)


def strict_merge(
    history: DataFrame, source: DataFrame, keys: list[str], values: list[str], provenance: list[str] = (),
) -> MergeResult:
    """Any repeated key fails, even with equal values; a changed value fails."""
    return _one_row_per_key(history, source, keys, values, list(provenance), None)


def enriching_merge(
    history: DataFrame, source: DataFrame, keys: list[str], values: list[str],
    provenance: list[str] = (), fillable: list[str] | None = None,
) -> MergeResult:
    """As strict, but a source row that only fills nulls replaces the whole old row."""
    return _one_row_per_key(
        history, source, keys, values, list(provenance), list(values if fillable is None else fillable)
    )


def tolerant_merge(
    history: DataFrame, source: DataFrame, keys: list[str], values: list[str],
    provenance: list[str] = (), order: list[str] = (), repeated_source_fails: bool = False,
) -> MergeResult:
    """Equal copies are fine: the last history copy and the first source copy stay.

    ``order`` decides first and last; it matters for provenance only, as the
    published values of tolerated copies are equal. ``repeated_source_fails``
    makes any second source row of a key an error.
    """
    provenance, order = list(provenance), list(order) or list(provenance)
    columns = [*keys, *values, *provenance]
    published = F.struct(*values)
    body = F.struct(*[F.col(o).alias(f"order_{i}") for i, o in enumerate(order)], *values, *provenance)
    at_history, at_source = F.col("side") == 0, F.col("side") == 1
    needed = list(dict.fromkeys([*columns, *order]))
    grouped = (
        _both_sides(history, source, keys, needed)
        .groupBy(*keys)
        .agg(
            F.count(F.when(at_history, 1)).alias("history_rows"),
            F.count(F.when(at_source, 1)).alias("source_rows"),
            F.min(F.when(at_history, published)).alias("h_low"),
            F.max(F.when(at_history, published)).alias("h_high"),
            F.min(F.when(at_source, published)).alias("s_low"),
            F.max(F.when(at_source, published)).alias("s_high"),
            F.max(F.when(at_history, body)).alias("h"),
            F.min(F.when(at_source, body)).alias("s"),
        )
    )

    def spread(side: str) -> Column:
        return F.when(F.col(f"{side}_low").eqNullSafe(F.col(f"{side}_high")), 1).otherwise(2)

    source_spread = F.greatest(spread("s"), F.col("source_rows")) if repeated_source_fails else spread("s")
    grouped = grouped.withColumns(
        {"history_distinct": spread("h"), "source_distinct": source_spread}
    ).withColumn("outcome", _outcome(False, None, values))
    from_source = F.col("history_rows") == 0
    outcomes = grouped.select(
        *keys,
        *[F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in [*values, *provenance]],
        "outcome", "history_rows", "source_rows", _merge_key(keys),
    )
    return MergeResult(outcomes, columns)


def upsert(
    existing: DataFrame, new: DataFrame, key: str, fixed: list[str], columns: list[str]
) -> MergeResult:
    """Registry upsert: the new entry replaces the old unless a fixed field differs."""
    columns = [key, *[c for c in columns if c != key]]
    body = F.struct(*columns[1:])
    grouped = (
        _both_sides(existing, new, [key], columns)
        .groupBy(key)
        .agg(
            F.count(F.when(F.col("side") == 0, 1)).alias("history_rows"),
            F.count(F.when(F.col("side") == 1, 1)).alias("source_rows"),
            F.max(F.when(F.col("side") == 0, body)).alias("h"),
            F.max(F.when(F.col("side") == 1, body)).alias("s"),
        )
    )
    both = (F.col("history_rows") > 0) & (F.col("source_rows") > 0)
    outcome = (
        F.when(both & ~_same(fixed), F.lit(CONFLICT))
        .when(F.col("source_rows") == 0, F.lit(KEPT))
        .when(F.col("history_rows") == 0, F.lit(INSERTED))
        .when(_same(columns[1:]), F.lit(SAME))
        .otherwise(F.lit(ENRICHED))
    )
    old = F.col("source_rows") == 0
    outcomes = grouped.select(
        key,
        *[F.when(old, F.col(f"h.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in columns[1:]],
        outcome.alias("outcome"), "history_rows", "source_rows", _merge_key([key]),
    )
    return MergeResult(outcomes, columns)


def combine_partial(df: DataFrame, keys: list[str], values: list[str]) -> MergeResult:
    """Partial rows of one key combine column by column; unequal values conflict."""
    clash = F.lit(False)
    aggregates = []
    for name in values:
        aggregates += [F.min(name).alias(f"low_{name}"), F.max(name).alias(f"high_{name}")]
        clash = clash | F.coalesce(F.col(f"low_{name}") != F.col(f"high_{name}"), F.lit(False))
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"), *aggregates)
    outcomes = grouped.select(
        *keys,
        *[F.col(f"low_{name}").alias(name) for name in values],
        F.when(clash, F.lit(CONFLICT)).otherwise(F.lit(INSERTED)).alias("outcome"),
        F.lit(0).cast("bigint").alias("history_rows"), "source_rows", _merge_key(keys),
    )
    return MergeResult(outcomes, [*keys, *values])

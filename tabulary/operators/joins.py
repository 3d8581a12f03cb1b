"""Joins behind corrections, overlaps, containment and integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

def apply_corrections(
    df: DataFrame, corrections: DataFrame, match: list[str], column: str, fixed: str
) -> DataFrame:
    """Replace ``column`` where all ``match`` columns equal a known-wrong row."""
    known = corrections.select(*[F.col(m).alias(f"fix_{m}") for m in match], F.col(fixed).alias("fix_value"))
    condition = F.lit(True)
    for m in match:
        condition = condition & F.col(m).eqNullSafe(F.col(f"fix_{m}"))
    return df.join(known, condition, "left").select(
        *[F.coalesce("fix_value", column).alias(c) if c == column else F.col(c) for c in df.columns]
    )


def drop_overlapped(
    existing: DataFrame, source: DataFrame, start: str, end: str, by: list[str] = (), keep_equal: bool = True
) -> DataFrame:
    """Drop existing periods that overlap a source period without being equal to one.

    Whether [s, e] meets any source period is a lookup, not a pairing: it does when
    the latest end among the source periods that start on or before e is on or after
    s. That running maximum is kept per day, so a day stands for all periods that
    share it: within a year in one small window, and across years in another. No
    pair of periods is ever formed, whatever the number of periods per day.
    """
    by = list(by)
    day, year = F.col("day"), F.year("day")
    starts = source.groupBy(*by, F.col(start).alias("day")).agg(F.max(end).alias("last_end"))
    asked = existing.select(*by, F.col(end).alias("day")).distinct().withColumn("last_end", F.lit(None).cast("date"))
    days = (
        starts.unionByName(asked)
        .groupBy(*by, "day")
        .agg(F.max("last_end").alias("last_end"))
        .withColumn("year", year)
    )
    earlier = (
        days.groupBy(*by, "year")
        .agg(F.max("last_end").alias("year_end"))
        .withColumn(
            "earlier_end",
            F.max("year_end").over(
                _over(by).orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(*by, "year", "earlier_end")
    )
    reach = (
        days.join(earlier, [*by, "year"])
        .withColumn(
            "reach",
            F.greatest(
                F.max("last_end").over(
                    Window.partitionBy(*by, "year").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
                ),
                "earlier_end",
            ),
        )
        .select(*by, day.alias(end), "reach")
    )
    marked = existing.join(reach, [*by, end], "left")
    if keep_equal:
        equal = source.select(*by, start, end).distinct().withColumn("is_equal", F.lit(True))
        marked = marked.join(equal, [*by, start, end], "left")
    else:
        marked = marked.withColumn("is_equal", F.lit(None).cast("boolean"))
    overlapped = F.coalesce(F.col("reach") >= F.col(start), F.lit(False))
    return marked.filter(F.col("is_equal").isNotNull() | ~overlapped).select(*existing.columns)


def _over(by: list[str]):
    # Without a partition column this window holds one row per calendar year only.
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


PART_MEMBERS = 1000


def _member_rows(df: DataFrame, url: str, sets: list[str], prefix: str) -> DataFrame:
    """One row for each member of each set, as (url, set, member); a null member is told apart from every text."""
    def marked(name: str) -> Column:
        of_set = F.lit(name).alias("set")
        return F.transform(F.col(f"{prefix}{name}").cast("array<string>"), lambda m: F.struct(of_set, F.coalesce(F.concat(F.lit("="), m), F.lit("")).alias("member")))

    return df.withColumn("at", F.explode(F.array_distinct(F.concat(*[marked(n) for n in sets])))).select(
        F.col(url).alias("url"), "at.set", "at.member", *[c for c in df.columns if c != url])


def contains_all(
    wanted: DataFrame, registry: DataFrame, url: str, sets: dict[str, tuple[str, str]]
) -> DataFrame:
    """Wanted rows for which one registry entry of the url holds all wanted members.

    ``sets`` maps a name to (wanted array, registry array). Equal questions and equal entries are asked once. A question
    probes an inverted index with that member of its sets which the fewest entries of the url hold; a member that no entry
    holds answers it at once. A member held by many entries, or asked for by many questions, is cut into a grid of parts of
    about PART_MEMBERS each, so a busy url spreads over tasks. A question without members is answered by any entry
    of its url. Null urls and null arrays, wanted or held, never match; a null member is a member like others.
    """
    names = list(sets)
    questions = wanted.select(
        F.col(url).alias("q_url"), *[F.col(w).alias(f"q_{n}") for n, (w, _) in sets.items()]
    ).dropna().distinct()
    entries = registry.select(
        F.col(url).alias("e_url"), *[F.array_sort(F.array_distinct(h)).alias(f"e_{n}") for n, (_, h) in sets.items()]
    ).dropna().distinct()
    asked = [f"q_{n}" for n in names]
    key = ["url", "set", "member"]
    index = _member_rows(entries, "e_url", names, "e_")
    held = index.groupBy(*key).agg(F.count(F.lit(1)).alias("entries"))
    least = F.min_by(F.struct("set", "member", "entries"), F.struct(F.coalesce("entries", F.lit(0)), "set", "member"))
    probes = (
        _member_rows(questions, "q_url", names, "q_").join(held, key, "left").groupBy("url", *asked).agg(least.alias("probe"))
        .where("probe.entries is not null").select("url", "probe.*", *asked)
    )
    parts = probes.groupBy(*key).agg(
        F.ceil(F.first("entries") / PART_MEMBERS).cast("int").alias("rows"), F.ceil(F.count(F.lit(1)) / PART_MEMBERS).cast("int").alias("columns"))

    def placed(df: DataFrame, own: str, other: str, by: list[str]) -> DataFrame:
        spread = df.join(parts, key).withColumn(f"{own}_part", F.pmod(F.xxhash64(*by), F.col(own)))
        return spread.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("rows", "columns")

    holding = [F.size(F.array_except(f"q_{n}", f"e_{n}")) == 0 for n in names]
    left = placed(probes, "columns", "rows", asked).withColumn("rows_part", F.col("rows_part").cast("long")).alias("l")
    right = placed(index, "rows", "columns", [f"e_{n}" for n in names]).withColumn("columns_part", F.col("columns_part").cast("long")).alias("r")
    met = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in (*key, "rows_part", "columns_part")]
    found = left.join(right, [*met, *holding], "left_semi").select(F.col("url").alias("q_url"), *asked)
    bare = questions.where(" and ".join(f"size({c}) = 0" for c in asked)).join(
        entries.select(F.col("e_url").alias("q_url")).distinct(), "q_url", "left_semi")
    answered = found.unionByName(bare).distinct().select(F.col("q_url").alias(url), *[F.col(f"q_{n}").alias(w) for n, (w, _) in sets.items()])
    return wanted.join(answered, [url, *[w for w, _ in sets.values()]], "left_semi").select(*wanted.columns)


def archived_periods(registry: DataFrame, url: str, periods: str, subjects: str, required: list[str]) -> DataFrame:
    """Distinct (url, period) of entries that cover the required subjects."""
    covered = F.size(F.array_except(F.array(*[F.lit(r) for r in required]), F.col(subjects))) == 0
    return registry.filter(covered).select(url, F.explode(periods).alias("period")).distinct()


def not_yet_archived(urls: DataFrame, url: str, periods: DataFrame, months: DataFrame, month: str) -> DataFrame:
    """Urls that still need work: no archived period, or one that history lacks."""
    known = months.select(F.col(month).alias("period")).distinct().withColumn("known", F.lit(True))
    complete = (
        periods.join(known, "period", "left")
        .groupBy(url)
        .agg(F.bool_and(F.col("known").isNotNull()).alias("complete"))
        .filter("complete")
    )
    return urls.join(complete, url, "left_anti")


def reference_gaps(manifest: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Entries without a file, and files without an entry, in one grouping."""
    return (
        manifest.select(key, F.lit(1).alias("m"), F.lit(0).alias("f"))
        .unionByName(files.select(key, F.lit(0).alias("m"), F.lit(1).alias("f")))
        .groupBy(key)
        .agg(F.max("m").alias("m"), F.max("f").alias("f"))
        .filter(F.col("m") != F.col("f"))
        .select(
            key,
            F.when(F.col("m") == 1, F.lit("missing_file")).otherwise(F.lit("unreferenced_file")).alias("gap"),
        )
    )


def keep_unarchived_rows(rows: DataFrame, period: str, entries: DataFrame, entry_rows: DataFrame, periods: str) -> DataFrame:
    """Archived entries plus the preserved rows for periods no entry covers."""
    held = entries.select(F.explode(periods).alias(period)).distinct()
    return rows.join(held, period, "left_anti").select(*entry_rows.columns).unionByName(entry_rows)


def catalog_mismatches(index: DataFrame, manifests: DataFrame, metadata: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Datasets on which index, manifest and metadata disagree or one is missing."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*fields).alias(name))

    joined = side(index, "i").join(side(manifests, "m"), key, "full_outer").join(side(metadata, "d"), key, "full_outer")
    reasons = [
        F.when(F.col("i").isNull(), F.lit("index missing")),
        F.when(F.col("m").isNull(), F.lit("manifest missing")),
        F.when(F.col("d").isNull(), F.lit("metadata missing")),
    ]
    for name in fields:
        i, m, d = F.col(f"i.{name}"), F.col(f"m.{name}"), F.col(f"d.{name}")
        present = F.col("i").isNotNull() & F.col("m").isNotNull() & F.col("d").isNotNull()
        reasons.append(F.when(present & ~(i.eqNullSafe(m) & m.eqNullSafe(d)), F.lit(f"{name} mismatch")))
    return joined.select(key, F.explode(F.array_compact(F.array(*reasons))).alias("reason"))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between the two sides, in one shuffle."""
    columns = left.columns
    return (
        left.select(*columns, F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(*columns, F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy(*columns)
        .agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
        .filter(F.col("left_rows") != F.col("right_rows"))
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    return row_differences(left, right).isEmpty()


def count_condition(column: Column) -> Column:
    return F.count(F.when(column, 1))

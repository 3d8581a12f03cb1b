"""The shape shared by all strict decoders, and white space."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space plus the information separators: as a set, and as a pattern.
SPACES = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"(?U)[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with its argument bound to ``value``, which is evaluated once.

    For values that are dear to compute and looked at several times inside one row, such
    as the lines of a document. Whole-stage code shares repeated parts of cheap
    expressions by itself, so cell decoders do without.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


@dataclass(frozen=True)
class Decoded:
    """``value`` is null for an absent or a bad cell; ``present`` tells the two apart."""

    value: Column
    present: Column

    @property
    def bad(self) -> Column:
        return self.value.isNull() & F.coalesce(self.present, F.lit(False))


def required(value: Column) -> Decoded:
    """A cell that may not be absent."""
    return Decoded(value, F.lit(True))


def with_decoded(df: DataFrame, columns: dict[str, Decoded], bad: str = "bad_fields") -> DataFrame:
    """Add every decoded value and one array naming the fields that failed.

    Values come first, so whether a cell was present is only asked where its value is
    null.
    """
    valued = df.withColumns({f"value of {name}": d.value for name, d in columns.items()})
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    failed = [
        F.when(F.col(f"`value of {name}`").isNull() & F.coalesce(d.present, F.lit(False)), F.lit(name))
        for name, d in columns.items()
    ]
    return valued.select(
        *kept, *[F.col(f"`value of {name}`").alias(name) for name in columns],
        F.array_compact(F.array(*failed)).alias(bad),
    )

"""Unicode-safe string helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that count as blank, for use within a character class (Java's \s leaves the wide ones out).
BLANKS = r"\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u0085\u001c-\u001f"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{BLANKS}]+|[{BLANKS}]+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"[{BLANKS}]+$", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{BLANKS}]+", "")


def split_lines(c: Column) -> Column:
    """Lines by any line break, without an empty last one."""
    ends = F.regexp_replace(c, r"\r\n|[\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]", "\n")
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(ends, r"\n$", ""), "\n"))


def let(value: Column, body) -> Column:  # noqa: ANN001
    """Evaluates `value` once and uses it many times in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row however often they are used later: the generator keeps the optimizer from repeating them in every use."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))

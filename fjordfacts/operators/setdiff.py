"""Differences between two copies of a table by set reconciliation (problem 6).

Rows are hashed into GF(2^61 - 1) and spread over buckets by their key, so both copies of a row
meet in one bucket. Each side reduces a bucket to the values of its characteristic polynomial
prod(z - h) at a few points. Buckets follow the hash that a shuffle by key uses, so those of rows
aggregated by key lie whole in one partition, and a few numbers a bucket and side are all that moves. The ratio of both sides' values is a rational
function whose numerator and denominator vanish exactly at the hashes that only one side has;
it is interpolated for a bound on the number of differences and checked at further points.
Buckets that fail go on with twice the bound. Each side then keeps the rows that are roots of
its polynomial, where they are if the polynomials are few enough to be broadcast, and only those are joined and compared field by field.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordfacts.functions.text import let
from fjordfacts.session import cores, cut, measured_broadcast

P = (1 << 61) - 1
CHECKS = 2
#: Rows of the larger side a bucket holds on average, and the first bound on its differences: a system of equations costs the cube of it.
ROWS_A_BUCKET, FIRST_BOUND = 48, 16
#: Buckets solved together in one task.
BUCKETS_A_TASK = 20_000
#: Rows that are multiplied at once.
CHUNK = 1 << 16
_P, _LOW = np.uint64(P), np.uint64((1 << 32) - 1)
_U = np.uint64


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = a + b
    return np.where(c >= _P, c - _P, c)


def sub(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + _P - b)


def mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product modulo 2^61 - 1 of uint64 arrays, in 32-bit halves: 2^61 = 1, so 2^64 = 8."""
    a1, a0, b1, b0 = a >> _U(32), a & _LOW, b >> _U(32), b & _LOW
    mid = a1 * b0 + a0 * b1  # under 2^62
    low = a0 * b0
    out = (low & _P) + (low >> _U(61))
    out = out + ((mid >> _U(29)) + ((mid & _U((1 << 29) - 1)) << _U(32)))
    out = (out & _P) + (out >> _U(61))
    out = out + ((a1 * b1) << _U(3))
    out = (out & _P) + (out >> _U(61))
    return np.where(out >= _P, out - _P, out)


def power(a: np.ndarray, e: int) -> np.ndarray:
    out, base = np.ones_like(a), a
    while e:
        if e & 1:
            out = mul(out, base)
        base, e = mul(base, base), e >> 1
    return out


def inverse(a: np.ndarray) -> np.ndarray:
    return power(a, P - 2)


def points(n: int) -> np.ndarray:
    """Sample points, below any row hash (those lie above 2^20)."""
    return np.arange(1, n + 1, dtype=np.uint64) * _U(7919)


def product_by(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of the rows of `values` by key, halving each group in every round."""
    order = np.argsort(key, kind="stable")
    key, values = key[order], values[order]
    while len(key) > 1:
        first = np.r_[True, key[1:] != key[:-1]]
        start = np.flatnonzero(first)
        rank = np.arange(len(key)) - np.repeat(start, np.diff(np.r_[start, len(key)]))
        odd = np.flatnonzero(rank & 1)
        if not len(odd):
            break
        values[odd - 1] = mul(values[odd - 1], values[odd])
        keep = (rank & 1) == 0
        key, values = key[keep], values[keep]
    return key, values


def solve(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Jordan over the field for many systems at once: (solutions, consistent). Free unknowns are 0."""
    m = matrix.copy()
    n, rows, width = m.shape
    unknowns = width - 1
    rank, pivot_of = np.zeros(n, int), np.full((n, unknowns), -1)
    each = np.arange(n)
    for c in range(unknowns):
        usable = (m[:, :, c] != 0) & (np.arange(rows)[None, :] >= rank[:, None])
        has = usable.any(1)
        at = np.where(has, usable.argmax(1), 0)
        who = each[has]
        r = rank[has]
        top, low = m[who, r].copy(), m[who, at[has]].copy()
        m[who, at[has]], m[who, r] = top, low
        lead = mul(m[who, r], inverse(m[who, r, c])[:, None])
        m[who, r] = lead
        factor = m[who, :, c].copy()
        factor[np.arange(len(who)), r] = 0
        m[who] = sub(m[who], mul(factor[:, :, None], lead[:, None, :]))
        pivot_of[who, c] = r
        rank[has] += 1
    left = np.arange(rows)[None, :] >= rank[:, None]
    good = ~((m[:, :, -1] != 0) & left).any(1)
    out = np.where(pivot_of >= 0, np.take_along_axis(m[:, :, -1], np.maximum(pivot_of, 0), 1), _U(0))
    return out, good


def evaluate(coefficients: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Monic polynomials (coefficients from low to high, the leading 1 left out) at x; one row of x for each polynomial."""
    out = np.ones_like(x)
    for k in range(coefficients.shape[1] - 1, -1, -1):
        out = add(mul(out, x), coefficients[:, k : k + 1])
    return out


def interpolate(ratio: np.ndarray, z: np.ndarray, surplus: int, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numerators and denominators of degree a - b = surplus, a + b <= bound, from ratios at bound + CHECKS points, and which are verified."""
    a = max(0, (bound + surplus) // 2)
    b = a - surplus
    use, n = a + b, len(ratio)
    powers = np.stack([power(z, k) for k in range(max(a, b) + 1)], 1)
    f, rows = ratio[:, :use], powers[:use]
    matrix = np.empty((n, use, use + 1), np.uint64)
    matrix[:, :, :a] = rows[None, :, :a]
    shape = (n, use, b)
    matrix[:, :, a:use] = sub(np.zeros(shape, np.uint64), mul(np.broadcast_to(f[:, :, None], shape), np.broadcast_to(rows[None, :, :b], shape)))
    matrix[:, :, use] = sub(mul(f, rows[None, :, b]), np.broadcast_to(rows[None, :, a], f.shape))
    found, good = solve(matrix)
    top, low = found[:, :a], found[:, a:]
    rest = np.broadcast_to(z[None, use:], (n, len(z) - use))
    good &= (evaluate(top, rest) == mul(ratio[:, use:], evaluate(low, rest))).all(1)
    return top, low, good


def _hashes(df: DataFrame, key: list[str], fields: list[str], buckets: int) -> DataFrame:
    """key, fields, _bucket and _hash in [2^20, P)."""
    text = F.to_json(F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("\u0001null")).alias(f"c{i}") for i, c in enumerate([*key, *fields]))))
    h = F.pmod(F.xxhash64(text), F.lit(P - (1 << 20))) + F.lit(1 << 20)
    return df.withColumns({"_bucket": F.pmod(F.hash(*key), F.lit(buckets)).cast("bigint"), "_hash": h})


def _evaluations(both: DataFrame, n_points: int) -> DataFrame:
    """(_bucket, _side, n, v): row count and polynomial values of a side at the first points; more than one row where a bucket lies in several partitions."""
    z = points(n_points)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(pdf["_bucket"].to_numpy(), pdf["_side"].to_numpy(), pdf["_hash"].to_numpy().astype(np.uint64)) for pdf in batches if len(pdf)]
        if not parts:
            return
        bucket, side, h = (np.concatenate(c) for c in zip(*parts, strict=True))
        group = bucket * 2 + side
        order = np.argsort(group, kind="stable")
        group, h = group[order], h[order]
        found = [product_by(group[x : x + CHUNK], sub(np.broadcast_to(z[None, :], (len(h[x : x + CHUNK]), len(z))), h[x : x + CHUNK, None])) for x in range(0, len(h), CHUNK)]
        # a group that two chunks share comes twice
        key, prod = product_by(np.concatenate([k for k, _ in found]), np.concatenate([v for _, v in found]))
        n = np.searchsorted(group, key, "right") - np.searchsorted(group, key)
        yield pd.DataFrame({"_bucket": key // 2, "_side": (key % 2).astype(np.int32), "n": n, "v": list(prod.astype(np.int64))})

    return both.select("_bucket", "_side", "_hash").mapInPandas(partial, "_bucket long, _side int, n long, v array<long>")


def _solved(evaluations: DataFrame, bound: int, n_tasks: int) -> DataFrame:
    """(_bucket, ok, top, low): the polynomials of each bucket whose bound was enough. All buckets of a task are solved together."""
    z = points(bound + CHECKS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [pdf for pdf in batches if len(pdf)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True)
        bucket, place = np.unique(pdf["_bucket"].to_numpy(), return_inverse=True)
        side = pdf["_side"].to_numpy()
        n, values = np.zeros((2, len(bucket)), np.int64), np.ones((2, len(bucket), len(z)), np.uint64)
        for s in (0, 1):
            at = np.flatnonzero(side == s)
            if len(at):
                np.add.at(n[s], place[at], pdf["n"].to_numpy()[at])
                key, product = product_by(place[at], np.stack(pdf["v"].to_numpy()[at]).astype(np.uint64))
                values[s][key] = product
        surplus = n[0] - n[1]
        top_of, low_of, ok = np.full(len(bucket), None, object), np.full(len(bucket), None, object), np.zeros(len(bucket), bool)
        for s in np.unique(surplus[np.abs(surplus) <= bound]):
            at = np.flatnonzero(surplus == s)
            even = bound - ((bound - abs(int(s))) & 1)
            top, low, good = interpolate(mul(values[0][at], inverse(values[1][at])), z, int(s), even)
            for i, t, w in zip(at[good], top[good].astype(np.int64), low[good].astype(np.int64), strict=True):
                ok[i], top_of[i], low_of[i] = True, t, w
        yield pd.DataFrame({"_bucket": bucket, "ok": ok, "top": top_of, "low": low_of})

    return evaluations.repartition(n_tasks, "_bucket").mapInPandas(run, "_bucket long, ok boolean, top array<long>, low array<long>")


def _roots(both: DataFrame, solved: DataFrame) -> DataFrame:
    """The rows of either side that are roots of their side's polynomial. `solved` should be cut."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf.reset_index(drop=True)
            hit = np.zeros(len(pdf), bool)
            degree = pdf["poly"].map(len).to_numpy()
            h = pdf["_hash"].to_numpy().astype(np.uint64)
            for d in np.unique(degree):
                if d:
                    at = np.flatnonzero(degree == d)
                    hit[at] = evaluate(np.stack(pdf["poly"].to_numpy()[at]).astype(np.uint64), h[at][:, None])[:, 0] == 0
            yield pdf.loc[hit].drop(columns="poly")

    # one row for each bucket and side that has differences
    polynomials = solved.select("_bucket", F.inline(F.array(F.struct(F.lit(0).alias("_side"), F.col("top").alias("poly")), F.struct(F.lit(1).alias("_side"), F.col("low").alias("poly"))))).where("size(poly) > 0")
    joined = both.join(measured_broadcast(polynomials, 32 + 8 * F.size("poly")), ["_bucket", "_side"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.drop("poly").schema)
    return joined.mapInPandas(run, schema)


def differing_rows(left: DataFrame, right: DataFrame, key: list[str], fields: list[str], rows_a_bucket: int = ROWS_A_BUCKET, first_bound: int = FIRST_BOUND) -> DataFrame:
    """key, fields, _side (0 left, 1 right): the rows that only one side has. Keys must be unique on each side.

    Null fields equal null; a row whose key is null is kept on its side like any other. Either
    side may be empty. The number of buckets follows the row count of the larger side.
    """
    cols = [*key, *fields]
    spark = left.sparkSession
    a, b = cut(left.select(*cols)), cut(right.select(*cols))
    size, partitions = max(a.count(), b.count()), int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a multiple of the shuffle's partitions: each bucket is part of one of them
    buckets = partitions * max(1, -(-size // (rows_a_bucket * partitions)))
    rows = [_hashes(side, key, fields, buckets).withColumn("_side", F.lit(i)) for i, side in enumerate((a, b))]
    open_rows, bound, out = rows[0].unionByName(rows[1]), first_bound, None
    while True:
        solved = cut(_solved(_evaluations(open_rows, bound + CHECKS), bound, max(cores(spark), -(-buckets // BUCKETS_A_TASK))))
        found = _roots(open_rows, solved.where("ok"))
        out = found if out is None else out.unionByName(found)
        failed = solved.where("not ok").select("_bucket")
        if failed.isEmpty():
            return out.select(*cols, "_side")
        open_rows = cut(open_rows.join(measured_broadcast(failed, 16), "_bucket", "left_semi"))
        bound *= 2


def field_differences(left: DataFrame, right: DataFrame, key: list[str], fields: list[str], names: tuple[str, str], **options: int) -> DataFrame:
    """key, what: missing_in_<right> or missing_in_<left> for rows on one side only, else the name of each field that differs."""
    rows = cut(differing_rows(left, right, key, fields, **options))
    sides = [rows.where(F.col("_side") == s).select(*(F.col(c).alias(f"k_{c}") for c in key), *(F.col(c).alias(f"{c}_{s}") for c in fields), F.lit(True).alias(f"in_{s}")) for s in (0, 1)]
    on = [f"k_{c}" for c in key]
    both = sides[0].join(sides[1], on, "full_outer")
    differs: list[Column] = [F.when(~F.col(f"{c}_0").eqNullSafe(F.col(f"{c}_1")), c) for c in fields]
    what = F.when(F.col("in_1").isNull(), F.array(F.lit(f"missing_in_{names[1]}"))).when(F.col("in_0").isNull(), F.array(F.lit(f"missing_in_{names[0]}"))).otherwise(F.array_compact(F.array(*differs)))
    return both.select(*(F.col(f"k_{c}").alias(c) for c in key), F.explode(what).alias("what"))


# ---- the statement values of this project ----

_BLANK = "[\\s\\u00a0\\u2009\\u202f]+"


def plain_number(text: Column) -> Column:
    """A number written in any of the usual notations as DOUBLE: blanks or points group thousands, a lone comma is decimal, brackets or a sign negate, kr or NOK may stand at either end.

    Digits alone or grouped by plain blanks, the usual case, are read at once.
    """
    ends = "^(kr\\.?|nok)|(kr\\.?|nok)$"

    def read(t: Column) -> Column:
        negative = t.rlike("^\\(.*\\)$|^[-\\u2212]|-$")
        bare = F.regexp_replace(F.regexp_replace(t, "[()\\u2212+]|^-|-$", ""), ends, "")

        def value(u: Column) -> Column:
            local = u.rlike("^\\d{1,3}(\\.\\d{3})+(,\\d*)?$|^\\d+,\\d+$")
            digits = F.when(local, F.translate(F.replace(u, F.lit("."), F.lit("")), ",", ".")).otherwise(F.replace(u, F.lit(","), F.lit("")))
            number = F.when(u.rlike("^[0-9.,]+(e[+-]?\\d+)?$"), digits).try_cast("double")
            return F.when(negative, -number).otherwise(number)

        return let(bare, value)

    usual = F.when(text.rlike("^-?\\d{1,3}(?: \\d{3})*$|^-?\\d+$"), F.replace(text, F.lit(" "), F.lit("")).try_cast("double"))
    return F.coalesce(usual, let(F.regexp_replace(F.regexp_replace(F.lower(text), _BLANK, ""), ends, ""), read)) + F.lit(0.0)


def plain_label(text: Column) -> Column:
    t = F.lower(F.regexp_replace(text, _BLANK, " "))
    return F.trim(F.regexp_replace(F.trim(t), "(\\s*:)+$", ""))


FIELDS = ["value", "value_prev", "page_idx", "label_matched"]


def latest(df: DataFrame, key: list[str], columns: list[str], at: str) -> DataFrame:
    """The row with the latest `at` of each key; ties go to the greatest row, so repeated rows count once. Combines map-side."""
    best = F.max(F.struct(F.coalesce(F.col(at), F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00"))).alias("_at"), *columns)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *(F.col(f"_best.{c}").alias(c) for c in columns))


def statement_sides(field_hits: DataFrame, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both stores' copies in one notation: doc_id, field and FIELDS."""
    hits = field_hits.select("doc_id", F.col("canonical").alias("field"), *((F.when(~F.isnan(c), F.col(c)) + F.lit(0.0)).alias(c) for c in ("value", "value_prev")), "page_idx", plain_label(F.col("label_matched")).alias("label_matched"), "loaded_at")
    # read before the shuffle, numbers are smaller than their texts
    plain = checks.select("doc_id", "field", (F.coalesce(F.col("missing") == "extracted", F.lit(False))).alias("gone"), plain_number(F.col("extracted")).alias("value"), plain_number(F.col("extracted_prev")).alias("value_prev"), "page_idx", plain_label(F.col("label_matched")).alias("label_matched"), "loaded_at")
    copies = latest(plain, ["doc_id", "field"], ["gone", *FIELDS], "loaded_at").where("not gone").drop("gone")
    return latest(hits, ["doc_id", "field"], FIELDS, "loaded_at"), copies


def statement_differences(field_hits: DataFrame, checks: DataFrame) -> DataFrame:
    left, right = statement_sides(field_hits, checks)
    return field_differences(left, right, ["doc_id", "field"], FIELDS, ("field_hits", "checks"))

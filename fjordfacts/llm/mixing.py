"""Sources mixed to target shares of a token budget (problem 8).

1. Every document's exact token length is counted once.
2. Documents become counts by (source, length); all further choices are made on these counts.
3. A source's target is met by whole passes over it, then by a share of the documents once more:
   the same share of each length, rounded down, and a bounded-knapsack dynamic program over the
   remaining counts for what is left of the budget. The reachable sums are the bits of one
   integer, an item's step is a shift and an or.
4. The counts turn into documents by a seeded order within each length. Only the one hash range
   in which the cut falls is ranked, so no length, however frequent, meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.llm import tokens
from fjordfacts.session import sized_broadcast

#: Budget, in tokens, that is left to the dynamic program at first.
WINDOW = 1 << 16
#: Hash ranges of the seeded order within a length.
RANGES = 4096


def plain_source(column: str) -> F.Column:
    """A source compared without case and outer blanks."""
    return F.lower(F.regexp_replace(F.col(column), r"^[\s ]+|[\s ]+$", ""))


def lengths(documents: DataFrame, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """(doc_id, source, n_tokens); without ids repeated lengths of a batch come as (source, n_tokens, n). Null texts have no tokens."""
    src = documents.select("doc_id", plain_source("source").alias("source"), F.coalesce("text", F.lit("")).alias("_text"))

    def one_each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "n_tokens": tokens.counter(path).count(list(pdf["_text"]))})

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = tokens.counter(path).count(list(pdf["_text"]))
            yield pd.DataFrame({"source": pdf["source"], "n_tokens": n}).groupby(["source", "n_tokens"], dropna=False).size().rename("n").reset_index()

    if keep_ids:
        return src.mapInPandas(one_each, "doc_id bigint, source string, n_tokens bigint")
    return src.select("source", "_text").mapInPandas(counted, "source string, n_tokens bigint, n bigint")


def histogram(counted: DataFrame) -> DataFrame:
    """(source, n_tokens, n): documents by source and exact length."""
    return counted.groupBy("source", "n_tokens").agg((F.sum("n") if "n" in counted.columns else F.count(F.lit(1))).alias("n"))


def targets(mix: DataFrame) -> DataFrame:
    """Targets by plain source; repeated rows count once, of differing ones for a source the largest share counts."""
    best = mix.where("source is not null").groupBy(plain_source("source").alias("source")).agg(F.max(F.struct("target_share", "max_repeats")).alias("t"))
    return best.select("source", F.coalesce("t.target_share", F.lit(0.0)).alias("target_share"), F.coalesce("t.max_repeats", F.lit(1)).alias("max_repeats"))


def capacity(counts: DataFrame, mix: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, total, target, reachable) of each target source. The total counts all documents, those of other sources included."""
    own = counts.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n")).alias("tokens"))
    total = own.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    t = targets(mix).join(own, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    t = t.join(F.broadcast(total), how="cross")  # one row
    return t.withColumn("target", F.col("target_share") * F.col("total")).withColumn("reachable", F.col("tokens") * F.col("max_repeats") >= F.col("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many items of each size to take so that their sum comes as near below the budget as the items allow.

    An even share of every size, single items from the most frequent sizes while more than the window is open, then the
    exact dynamic program over what remains. If that misses what divisibility allows, the window doubles, up to
    the whole budget, where the program alone decides: the result is the best there is.
    """
    total = int((sizes * counts).sum())
    if total <= budget:
        return counts.copy()
    some = sizes[(counts > 0) & (sizes > 0)]
    reachable = budget - budget % int(np.gcd.reduce(some)) if len(some) else 0
    while True:
        take = _fit_within(sizes, counts, budget, total, window)
        if window >= budget or int((sizes * take).sum()) == reachable:
            return take
        window *= 2


def _fit_within(sizes: np.ndarray, counts: np.ndarray, budget: int, total: int, window: int) -> np.ndarray:
    take = np.floor(counts * (max(0, budget - window) / total)).astype(np.int64) if window < budget else np.zeros(len(counts), np.int64)
    rest = budget - int((sizes * take).sum())
    left = counts - take
    for i in np.argsort(-counts, kind="stable"):
        if rest <= window:
            break
        if sizes[i] > 0:
            k = int(min(left[i], max(0, (rest - window // 2) // sizes[i])))
            take[i], left[i], rest = take[i] + k, left[i] - k, rest - k * int(sizes[i])
    take[sizes == 0] = counts[sizes == 0]
    parts: list[tuple[int, int]] = []
    for i in np.flatnonzero((left > 0) & (sizes > 0) & (sizes <= rest)):
        n, k = min(int(left[i]), rest // int(sizes[i])), 1
        while n:
            k = min(k, n)
            parts.append((int(i), k))
            n, k = n - k, 2 * k
    mask, sums = (1 << rest + 1) - 1, [1]
    for i, k in parts:
        sums.append((sums[-1] | sums[-1] << k * int(sizes[i])) & mask)
        if sums[-1] >> rest & 1:
            break
    at = sums[-1].bit_length() - 1
    for j in range(len(sums) - 1, 0, -1):
        if not sums[j - 1] >> at & 1:
            i, k = parts[j - 1]
            take[i] += k
            at -= k * int(sizes[i])
    return take


def plan(counts: DataFrame, mix: DataFrame) -> DataFrame:
    """(source, n_tokens, n, passes, extra): each document of that length is used `passes` times, `extra` of them once more.

    Grouped by source, but over lengths and not over documents: a group holds at most as many rows
    as there are distinct lengths.
    """

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n_tokens").reset_index(drop=True)
        sizes, n = pdf["n_tokens"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        own, target, most = int((sizes * n).sum()), int(pdf["target"].iloc[0]), int(pdf["max_repeats"].iloc[0])
        passes = min(most, target // own) if own else most
        extra = fit(sizes, n, target - passes * own) if passes < most else np.zeros(len(n), np.int64)
        return pd.DataFrame({"source": pdf["source"], "n_tokens": sizes, "n": n, "passes": passes, "extra": extra})

    own = counts.join(sized_broadcast(capacity(counts, mix).select("source", "max_repeats", F.floor("target").alias("target"))), "source")
    return own.groupBy("source").applyInPandas(choose, "source string, n_tokens bigint, n bigint, passes int, extra bigint")


def mixture(measured: DataFrame, planned: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, source, n_tokens, uses) of every document used at least once. `measured` and `planned` are read twice and should be cut."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    docs = measured.withColumn("_order", order).withColumn("_range", F.pmod(order, F.lit(RANGES)))
    group = ["source", "n_tokens"]
    ranges = docs.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_in"))
    before = F.coalesce(F.sum("_in").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumn("_before", before).join(planned.select(*group, "passes", "extra"), group)
    ranges = ranges.withColumn("_of_range", F.greatest(F.lit(0), F.least(F.col("extra") - F.col("_before"), F.col("_in"))))
    joined = docs.join(ranges, [*group, "_range"])
    settled = joined.where("_of_range = 0 or _of_range = _in").withColumn("uses", F.col("passes") + (F.col("_of_range") > 0).cast("int"))
    rank = F.row_number().over(Window.partitionBy(*group, "_range").orderBy("_order", "doc_id"))
    ranked = joined.where("_of_range > 0 and _of_range < _in").withColumn("uses", F.col("passes") + (rank <= F.col("_of_range")).cast("int"))
    return settled.unionByName(ranked).where("uses > 0").select("doc_id", "source", "n_tokens", "uses")


def shares(planned: DataFrame, counts: DataFrame, mix: DataFrame) -> DataFrame:
    """(source, target_share, tokens, mixed_tokens, actual_share, reachable): what the plan reaches."""
    used = planned.groupBy("source").agg(F.sum(F.col("n_tokens") * (F.col("passes") * F.col("n") + F.col("extra"))).alias("mixed_tokens"))
    out = capacity(counts, mix).join(used, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    whole = out.agg(F.sum("mixed_tokens").alias("_whole"))
    out = out.join(F.broadcast(whole), how="cross")  # one row
    return out.select("source", "target_share", "tokens", "mixed_tokens", F.when(F.col("_whole") > 0, F.col("mixed_tokens") / F.col("_whole")).alias("actual_share"), "reachable")


def short_sources(planned: DataFrame, counts: DataFrame, mix: DataFrame) -> DataFrame:
    """(source): sources whose plan uses every document as often as it may and still stays below the target, and those without documents that have one."""
    used = planned.groupBy("source").agg(F.sum(F.col("n_tokens") * (F.col("passes") * F.col("n") + F.col("extra"))).alias("mixed_tokens"), F.min("passes").alias("passes"))
    out = capacity(counts, mix).join(used, "source", "left")
    spent = F.coalesce(F.col("passes") >= F.col("max_repeats"), F.lit(True))
    return out.where(spent & (F.coalesce("mixed_tokens", F.lit(0)) < F.col("target"))).select("source").distinct()

"""The surviving record of each group of duplicates, chosen value by value (problem 5).

`discover` alternates between weighing the claims for every value by the reliability of
their sources and estimating the reliability of every source from the values that won, until the
reliabilities stand still. `survivors` takes the winners by a fixed order of trust and age,
which the stated result needs: it names one supplying record however the votes fall.
Both work on claims, one row for each (group, key, record, value), with aggregates that combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.session import cut, cut_by, measured_broadcast, sized_broadcast, tasks

#: Most rounds before non-convergence is an error, and the movement that counts as none.
ROUNDS, STILL = 1000, 1e-4


def plain_orgnr(column: str) -> F.Column:
    """The nine digits of an organisation number in any notation, null if there aren't nine."""
    digits = F.regexp_replace(F.col(column), r"[^0-9]", "")
    return F.when(F.length(digits) == 9, digits)


def filings(records: DataFrame) -> DataFrame:
    """(doc_id, orgnr, year, prompt_name, extracted_at), one row per record. A null year is read from the period's end."""
    year = F.coalesce("year", F.expr("try_cast(substring(regnskapsperiode_til, 1, 4) as int)"))
    own = records.select("doc_id", plain_orgnr("orgnr").alias("orgnr"), year.alias("year"), F.lower(F.trim("prompt_name")).alias("prompt_name"), "extracted_at")
    return own.where("doc_id is not null and orgnr is not null and year is not null").distinct()


def claims(records: DataFrame, noter: DataFrame, kilder: DataFrame) -> DataFrame:
    """(orgnr, year, nr, amount_key, doc_id, source, trust_rank, extracted_at, value) of filings with two or more records.

    A source without a trust rank is trusted least; of differing ranks for one source the best counts.
    """
    one = filings(records)
    several = one.groupBy("orgnr", "year").agg(F.count_distinct("doc_id").alias("_n")).where("_n > 1").drop("_n")
    rank = kilder.groupBy(F.lower(F.trim("prompt_name")).alias("prompt_name")).agg(F.min("trust_rank").alias("trust_rank"))
    own = one.join(several, ["orgnr", "year"], "left_semi").join(sized_broadcast(rank), "prompt_name", "left")
    values = noter.where("raw_amounts is not null").select("doc_id", "nr", F.explode("raw_amounts").alias("amount_key", "value")).where("value is not null and not isnan(value)")
    joined = own.join(values, "doc_id")
    return joined.select("orgnr", "year", "nr", "amount_key", "doc_id", F.col("prompt_name").alias("source"), F.coalesce("trust_rank", F.lit(2**31 - 1)).alias("trust_rank"), "extracted_at", "value")


GROUP = ["orgnr", "year", "nr", "amount_key"]


def survivors(all_claims: DataFrame) -> DataFrame:
    """GROUP, doc_id, value: the best trusted, then latest, then greatest record that has a value. A null time is the earliest."""
    at = F.coalesce("extracted_at", F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00")))
    best = F.max(F.struct((-F.col("trust_rank")).alias("trust"), at.alias("at"), "doc_id", "value"))
    return all_claims.groupBy(*GROUP).agg(best.alias("best")).select(*GROUP, "best.doc_id", "best.value")


def discover(all_claims: DataFrame, rounds: int = ROUNDS, still: float = STILL) -> tuple[DataFrame, DataFrame]:
    """(truths, reliabilities). truths: GROUP, value, support (its share of the weighted votes), n_claims and doc_id, the supplier.

    Claims of one source for one value of a group count once a record. A source's reliability is
    the mean support of the values it claimed; a claim's vote is -log(1 - reliability). Ties go to the
    value with more claims, then the better trusted, then the smaller one. Only the count of sources that moved reaches the driver.
    """
    at = F.coalesce("extracted_at", F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00")))
    supplier = F.max(F.struct((-F.col("trust_rank")).alias("trust"), at.alias("at"), "doc_id"))
    votes = all_claims.distinct().groupBy(*GROUP, "value", "source").agg(F.count(F.lit(1)).alias("n"), supplier.alias("supplier"))
    # one shuffle by group serves all rounds: the windows below need no other, and only sums by source move
    votes = cut_by(votes, GROUP, min(4096, tasks(all_claims)))
    reliability = cut(votes.groupBy("source").agg(F.lit(0.8).alias("reliability")))

    def weighed(now: DataFrame) -> DataFrame:
        weight = -F.log(1.0 - F.least(F.col("reliability"), F.lit(0.999)))
        each = votes.join(measured_broadcast(now, 64 + F.length("source")), "source").withColumn("vote", weight * F.col("n"))
        share = F.sum("vote").over(Window.partitionBy(*GROUP, "value")) / F.sum("vote").over(Window.partitionBy(*GROUP))
        return each.withColumn("support", share)

    for _ in range(rounds):
        after = cut(weighed(reliability).groupBy("source").agg((F.sum(F.col("support") * F.col("n")) / F.sum("n")).alias("reliability")))
        moved = after.alias("a").join(reliability.alias("b"), "source").where(F.abs(F.col("a.reliability") - F.col("b.reliability")) > still)
        done = moved.isEmpty()
        reliability = after
        if done:
            break
    else:
        raise RuntimeError(f"reliabilities still move by more than {still} after {rounds} rounds")
    values = weighed(reliability).groupBy(*GROUP, "value").agg(F.max("support").alias("support"), F.sum("n").alias("n"), F.max("supplier").alias("supplier"))
    best = F.max(F.struct(F.round("support", 9).alias("support"), "n", "supplier", (-F.col("value")).alias("less")))
    truths = values.groupBy(*GROUP).agg(best.alias("b"), F.sum("n").alias("n_claims"))
    return truths.select(*GROUP, (-F.col("b.less")).alias("value"), F.col("b.support").alias("support"), "n_claims", F.col("b.supplier.doc_id").alias("doc_id")), reliability

"""Extracted values against registry values: tolerances, the vote over re-readings, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.functions.amounts import normalize_amount
from fjordfacts.functions.text import once, strip

FLOOR, SHARE = 1000.0, 0.01


def tolerance(c: Column) -> Column:
    return F.greatest(F.abs(c) * SHARE, F.lit(FLOOR))


def compare(extracted: Column, api: Column, kind: Column) -> Column:
    """struct(ok, diff) of two values given as text. A null on either side, or text where pct1 wants a number, is not ok and has no difference."""
    e, a = extracted.try_cast("double"), api.try_cast("double")
    numeric = e.isNotNull() & a.isNotNull()
    truth = lambda c: ~F.lower(strip(c)).isin("", "0", "0.0", "false")
    diff = F.abs(e - a)
    missing = extracted.isNull() | api.isNull()
    same_text = strip(extracted) == strip(api)
    ok = F.when(missing, False).when(kind == "exact", F.when(numeric, e == a).otherwise(same_text)).when(kind == "pct1", F.coalesce(diff <= tolerance(a), F.lit(False))).when(kind == "bool_match", truth(extracted) == truth(api)).when(kind == "str_match", F.lower(strip(extracted)) == F.lower(strip(api))).otherwise(False)
    out = F.when(missing, None).when((kind == "pct1") | ((kind == "exact") & numeric), diff).when(kind.isin("exact", "bool_match", "str_match"), 0.0)
    return F.struct(ok.alias("ok"), out.cast("double").alias("diff"))


def validate(extracted: DataFrame, api: DataFrame, spec: DataFrame) -> DataFrame:
    """(doc_id, field, field_ord, layout, extracted, api, diff, tolerance_ok, tolerance_class, missing) by a full outer join of (doc_id, field, value) on both sides; null on both sides is no check. The 34-row dimension is broadcast."""
    left = extracted.where("value is not null").select("doc_id", "field", F.col("value").cast("string").alias("extracted"))
    right = api.where("value is not null").select("doc_id", "field", F.col("value").cast("string").alias("api"))
    both = left.join(right, ["doc_id", "field"], "full_outer").join(F.broadcast(spec.select(F.col("canonical").alias("field"), "layout", F.col("tolerance").alias("tolerance_class"), F.col("ord").alias("field_ord"))), "field")
    missing = F.when(F.col("api").isNull(), "api").when(F.col("extracted").isNull(), "extracted")
    both = both.withColumns({"missing": missing, "c": compare(F.col("extracted"), F.col("api"), F.col("tolerance_class"))})
    ok = F.when(F.col("missing") == "api", None).otherwise(F.col("c.ok"))
    return both.select("doc_id", "field", "field_ord", "layout", "extracted", "api", F.when(F.col("missing").isNull(), F.col("c.diff")).alias("diff"), ok.alias("tolerance_ok"), "tolerance_class", "missing")


def validation_summary(checks: DataFrame) -> DataFrame:
    """(doc_id, n_pass, n_fail, n_missing_extract, n_missing_api, disagreements): statement fields that fail or are missing, in the order of the fields."""
    plain = F.col("missing").isNull()
    wrong = F.col("layout").isin("resultat", "balanse") & ((plain & ~F.col("tolerance_ok")) | (F.col("missing") == "extracted"))
    return checks.groupBy("doc_id").agg(
        F.count_if(plain & F.col("tolerance_ok")).alias("n_pass"), F.count_if(plain & ~F.col("tolerance_ok")).alias("n_fail"), F.count_if(F.col("missing") == "extracted").alias("n_missing_extract"),
        F.count_if(F.col("missing") == "api").alias("n_missing_api"), F.transform(F.array_sort(F.collect_list(F.when(wrong, F.struct("field_ord", "field")))), lambda x: x["field"]).alias("disagreements"),
    )


def vote(votes: DataFrame, key: tuple[str, ...] = ("doc_id", "field")) -> DataFrame:
    """key, reconciled_value, diagnosis from (key, strategy_ord, value, v1_value, api_value).

    The registry's or the first reading's value wins by the number of re-readings near it; with equal, positive numbers
    the registry's. Else the most frequent re-reading, the first in order on ties, null values left out.
    """
    near = lambda c: F.abs(F.col("value") - F.col(c)) <= tolerance(F.col(c))
    each = votes.groupBy(*key, "value").agg(F.count(F.lit(1)).alias("n"), F.min("strategy_ord").alias("first"), F.first("v1_value").alias("v1_value"), F.first("api_value").alias("api_value"))
    one = each.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(near("api_value"), F.col("n"))), F.lit(0)).alias("a"), F.coalesce(F.sum(F.when(near("v1_value"), F.col("n"))), F.lit(0)).alias("t"),
        F.max("v1_value").alias("v1"), F.max("api_value").alias("api"),
        F.max(F.when(F.col("value").isNotNull(), F.struct("n", (-F.col("first")).alias("o"), "value")))["value"].alias("mode"),
    )
    a, t, mode = F.col("a"), F.col("t"), F.col("mode")
    for_api, for_v1, tie = (a >= 2) & (a > t), (t >= 2) & (t > a), (a == t) & (a > 0)
    value = F.when(for_api | tie, F.col("api")).when(for_v1, F.col("v1")).otherwise(mode)
    close = F.coalesce(F.abs(mode - F.col("api")) <= tolerance(F.col("api")), F.lit(False))
    why = F.when(for_api, "ocr_misread_corrected").when(for_v1, "api_disagrees_with_pdf").when(tie, "ambiguous_default_api").when(mode.isNull(), "all_strategies_failed").when(close, "ocr_misread_corrected").otherwise("ambiguous_consensus_disagrees_api")
    return one.select(*key, value.alias("reconciled_value"), why.alias("diagnosis"))


def disagreements(checks: DataFrame, hits: DataFrame, limit: int | None = 6, missing: bool = False) -> DataFrame:
    """(doc_id, field, field_ord, api_value, v1_value, page_idx, label): the values to be read again.

    Of a document's disagreements, in the order of the fields, the first `limit` are taken (all if it is None); of these, fields without an extracted value or a
    registry value are then passed over. With `missing`, missing values are sought too: on page 1, under the field's first label.
    hits: (doc_id, canonical, value, page_idx, label_matched); checks as of `validate`, with first_label where `missing` is set.
    """
    plain = F.col("missing").isNull()
    wrong = F.col("layout").isin("resultat", "balanse") & ((plain & ~F.col("tolerance_ok")) | (F.col("missing") == "extracted"))
    rows = checks.where(wrong)
    if limit is not None:
        rows = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("field_ord"))).where(F.col("_rn") <= limit).drop("_rn")
    own = hits.select("doc_id", F.col("canonical").alias("field"), F.col("value").alias("v1_value"), (F.col("page_idx") + 1).alias("page_idx"), F.col("label_matched").alias("label"))
    out = rows.join(own, ["doc_id", "field"], "left" if missing else "inner").withColumn("api_value", F.col("api").try_cast("double").cast("bigint").cast("double")).where("api_value is not null")
    if missing:
        out = out.withColumns({"page_idx": F.coalesce("page_idx", F.lit(1)), "label": F.coalesce("label", "first_label"), "v1_value": F.col("v1_value").cast("bigint").cast("double")})
    else:
        out = out.where("v1_value is not null")
    return out.select("doc_id", "field", "field_ord", "api_value", "v1_value", "page_idx", "label")


def apply_corrections(hits: DataFrame, voted: DataFrame, overwrite: bool = True) -> DataFrame:
    """Hits with reconciled_value and diagnosis of the disagreements that were read again; `overwrite` replaces the value where a misreading was corrected. Without it, fields that were missing come as new rows."""
    out = hits.join(voted.withColumnRenamed("field", "canonical").select("doc_id", "canonical", "reconciled_value", "diagnosis"), ["doc_id", "canonical"], "left" if overwrite else "full_outer")
    if overwrite:
        out = out.withColumn("value", F.when(F.col("value").isNotNull() & (F.col("diagnosis") == "ocr_misread_corrected") & F.col("reconciled_value").isNotNull(), F.col("reconciled_value")).otherwise(F.col("value")))
    return out


def recovered(voted: DataFrame, api: DataFrame, spec: DataFrame) -> DataFrame:
    """(doc_id, n_recovered): reconciled values within the tolerance of the registry's."""
    rows = voted.where("reconciled_value is not null").join(api.select("doc_id", "field", F.col("value").cast("string").alias("_api")), ["doc_id", "field"])
    rows = rows.join(F.broadcast(spec.select(F.col("canonical").alias("field"), F.col("tolerance").alias("_kind"))), "field")
    ok = compare(F.col("reconciled_value").cast("string"), F.col("_api"), F.col("_kind"))["ok"]
    return rows.groupBy("doc_id").agg(F.count_if(ok).alias("n_recovered"))


LINE = ["doc_id", "page_no", "block_id", "par_id", "line_id"]


def label_lines(words: DataFrame, labels: DataFrame, on: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """`on`, field, first, ws: the lines whose first six words hold every part of the label, each with its words by their left edge; `first` is the order in which lines appear.

    labels: (`on`, field, label), few for a page: they are joined to its lines. A label without words is on every line.
    """
    word = F.struct("left", "word_id", "text", "top", "width", "height")
    lines = words.groupBy(*LINE).agg(F.array_sort(F.collect_list(word)).alias("ws"), F.min(F.struct("block_id", "par_id", "line_id", "word_id")).alias("first"))
    opening = F.array_join(F.transform(F.slice("ws", 1, 6), lambda w: F.lower(w["text"])), " ")
    parts = F.filter(F.split(F.lower("label"), r"\s+"), lambda p: p != "")
    joined = lines.withColumn("_open", opening).join(labels.withColumn("_parts", parts), list(on))
    return joined.where(F.forall("_parts", lambda p: F.contains(F.col("_open"), p))).select(*on, "field", "label", "first", "ws")


def _clusters(ws: Column, gap: int) -> Column:
    """Runs of number-like words: parted by other words and by wide gaps."""
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("done"), F.lit(None).cast("string").alias("open"), F.lit(None).cast("int").alias("right"))

    def step(s: Column, w: Column) -> Column:
        like = w["text"].rlike(r"[\d\-l]")
        closed = F.when(s["open"].isNotNull(), F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"])
        apart = s["right"].isNotNull() & (w["left"] - s["right"] > gap)
        goes_on = s["open"].isNotNull() & ~F.coalesce(apart, F.lit(False))
        grown = F.struct(F.when(goes_on, s["done"]).otherwise(closed).alias("done"), F.when(goes_on, F.concat_ws(" ", s["open"], w["text"])).otherwise(w["text"]).alias("open"), (w["left"] + w["width"]).cast("int").alias("right"))
        other = F.struct(closed.alias("done"), F.lit(None).cast("string").alias("open"), F.lit(None).cast("int").alias("right"))
        return F.when(like, grown).otherwise(other)

    return F.aggregate(ws, start, step, lambda s: F.when(s["open"].isNotNull(), F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))


def walked_values(words: DataFrame, labels: DataFrame, on: tuple[str, ...] = ("doc_id", "page_no"), gap: int = 80) -> DataFrame:
    """`on`, field, value, confidence: of the first line that has the label and a number, the last number but one (high) or the only one (med), whole. Runs that are no number are dropped first."""
    rows = label_lines(words, labels, on)
    found = once(rows.withColumn("_runs", _clusters(F.col("ws"), gap)), nums=F.filter(F.transform("_runs", lambda r: normalize_amount(r)), lambda v: v.isNotNull())).where("size(nums) > 0")
    value = F.when(F.size("nums") >= 2, F.try_element_at("nums", F.lit(-2))).otherwise(F.get("nums", F.lit(0))).cast("bigint")
    best = F.min_by(F.struct(value.alias("value"), F.when(F.size("nums") >= 2, "high").otherwise("med").alias("confidence")), "first").alias("b")
    return found.groupBy(*on, "field").agg(best).select(*on, "field", "b.value", "b.confidence")


def value_boxes(words: DataFrame, labels: DataFrame, on: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """`on`, field, x0, y0, x1, y1: where the value stands on the first line that has the label, for a recogniser to read again.

    Of the line's last eight words with digits, those left of the widest gap (the first of equal ones) are the value. Fewer than two such words give no box.
    """
    first = label_lines(words, labels.where(F.trim("label") != ""), on).groupBy(*on, "field").agg(F.min_by("ws", "first").alias("ws"))
    digits = F.filter("ws", lambda w: w["text"].rlike(r"\d"))
    rows = first.withColumn("d", F.slice(digits, F.greatest(F.lit(1), F.size(digits) - 7), F.lit(8))).where("size(d) >= 2")
    gaps = F.transform(F.sequence(F.lit(1), F.size("d") - 1), lambda i: F.struct((F.get("d", i)["left"] - F.get("d", i - 1)["left"] - F.get("d", i - 1)["width"]).alias("gap"), (-i).alias("at")))
    rows = rows.withColumn("v", F.slice("d", F.lit(1), -F.array_max(gaps)["at"]))
    least = lambda f: F.array_min(F.transform("v", f))
    most = lambda f: F.array_max(F.transform("v", f))
    zero = F.lit(0)
    return rows.select(*on, "field", F.greatest(zero, least(lambda w: w["left"]) - 5).alias("x0"), F.greatest(zero, least(lambda w: w["top"]) - 5).alias("y0"), (most(lambda w: w["left"] + w["width"]) + 10).alias("x1"), (most(lambda w: w["top"] + w["height"]) + 10).alias("y1"))


def deep_dive(asked: DataFrame, readings: list[DataFrame]) -> DataFrame:
    """asked with reconciled_value and diagnosis, from (doc_id, field, value) of every strategy in the order they count; a strategy without a row failed."""
    votes = None
    for i, r in enumerate(readings):
        own = asked.join(r.select("doc_id", "field", F.col("value").cast("double").alias("value")), ["doc_id", "field"], "left").withColumn("strategy_ord", F.lit(i))
        votes = own if votes is None else votes.unionByName(own)
    voted = vote(votes.select("doc_id", "field", "strategy_ord", "value", "v1_value", "api_value"))
    return asked.join(voted, ["doc_id", "field"])


def api_entry(entries: DataFrame, suffixes: tuple[str, ...] = ("", "_v2", "_v3"), first_else: bool = True) -> DataFrame:
    """The registry entry of each (orgnr, year) from (orgnr, year, suffix, idx, period_end, json).

    With `first_else` only the first existing suffix counts, and its first entry if none ends in the year; without, all
    suffixes in order and only entries that end in the year.
    """
    order = F.coalesce(*(F.when(F.col("suffix") == s, i) for i, s in enumerate(suffixes)))
    df = entries.withColumns({"_s": order, "_hit": F.coalesce(F.startswith("period_end", F.concat(F.col("year").cast("string"), F.lit("-"))), F.lit(False))}).where("_s is not null")
    key = Window.partitionBy("orgnr", "year")
    if first_else:
        df = df.withColumn("_first", F.min("_s").over(key)).where("_s = _first").drop("_first")
    else:
        df = df.where("_hit")
    rn = F.row_number().over(key.orderBy(F.desc("_hit"), "_s", "idx"))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn", "_s", "_hit")

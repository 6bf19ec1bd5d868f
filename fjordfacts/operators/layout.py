"""Word boxes to lines and page text, set-based.

A line's words stand by their left edge; a gap wider than twice the line's upper median gap, and
than 30, becomes a tab. Lines stand by their least top edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["doc_id", "page_no", "block_id", "par_id", "line_id"]
MIN_TAB = 30


def text_lines(words: DataFrame) -> DataFrame:
    """KEY, top, first_word, text. Empty words are left out; equal left edges keep the order of word_id."""
    word = F.struct(F.col("left").alias("x"), F.col("word_id").alias("w"), (F.col("left") + F.col("width")).alias("r"), F.col("text").alias("t"))
    rows = words.where(F.length(F.trim("text")) > 0).groupBy(*KEY).agg(F.min("top").alias("top"), F.min("word_id").alias("first_word"), F.array_sort(F.collect_list(word)).alias("ws"))
    gaps = F.transform(F.slice("ws", 2, F.size("ws")), lambda w, i: F.greatest(F.lit(0), w["x"] - F.element_at("ws", i + 1)["r"]))
    rows = rows.withColumn("gaps", F.when(F.size("ws") > 1, gaps).otherwise(F.array().cast("array<int>")))
    median = F.element_at(F.array_sort("gaps"), (F.size("gaps") / 2).cast("int") + 1)
    rows = rows.withColumn("limit", F.when(F.size("gaps") > 0, F.greatest(2 * median, F.lit(MIN_TAB))))
    parts = F.transform("ws", lambda w, i: F.concat(F.when(i == 0, "").when(F.get("gaps", i - 1) > F.col("limit"), "\t").otherwise(" "), w["t"]))
    return rows.select(*KEY, "top", "first_word", F.array_join(parts, "").alias("text"))


def page_text(words: DataFrame) -> DataFrame:
    """(doc_id, page_no, text): one shuffle by page serves the lines and the pages. Lines with equal tops stand by their first word."""
    line = F.struct("top", "block_id", "par_id", "line_id", "text")
    rows = text_lines(words.repartition("doc_id", "page_no")).groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(line)).alias("ls"))
    return rows.select("doc_id", "page_no", F.array_join(F.transform("ls", lambda x: x["text"]), "\n").alias("text"))

"""Pages of text to notes.

Headers are marked in the joined text by sentinel characters with one regular expression, and the
text is cut at the sentinels; page breaks are counted, so no character offsets are needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.functions.amounts import detect_scale
from fjordfacts.functions.text import strip

BREAK = "\n<<<PAGE_BREAK>>>\n"
#: What opens a note: the word, a number that may have a letter. Patterns are read with Unicode classes, without regard to case, line by line.
_FLAGS, _OPEN = "(?dimU)", r"Note\s+(\d+[a-z]?)"
_HEADER = rf"{_FLAGS}^\s*{_OPEN}[\s:.\-]+([^\n]+?)\s*$"
#: Within a header whose title is itself a bare header: the next line that isn't blank is that one's title.
_NESTED = rf"{_FLAGS}(\u0002{_OPEN}\u0002[^\u0003]*\u0003)\s*\n[ \t]*([^\n\u0001]{{1,99}}?)[ \t]*$"


def segment(pages: DataFrame) -> DataFrame:
    """(doc_id, nr, tittel, raw_text, page_refs) from (doc_id, page_no, text).

    Null page texts are empty pages. A number that comes again stays within the note before. Text before the first
    header belongs to no note; documents without headers give no rows.
    """
    joined = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text")))).alias("ps"))
    joined = joined.select("doc_id", F.array_join(F.transform("ps", lambda p: p["text"]), BREAK).alias("text"))
    marked = F.regexp_replace("text", _HEADER, "\u0001$1\u0002$2\u0002$0\u0003")
    # a bare header follows whose title is the next line that isn't blank
    marked = F.regexp_replace(marked, _NESTED, "$1\u0001$2\u0002$3\u0002\u0003")
    parts = joined.select("doc_id", F.posexplode(F.split(marked, "\u0001")).alias("pos", "part"))
    breaks = F.regexp_count("part", F.lit("<<<PAGE_BREAK>>>"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    head = F.split("part", "[\u0002\u0003]")
    rows = parts.withColumns({"nr": F.when(F.col("pos") > 0, head[0]), "tittel": F.when(F.col("pos") > 0, strip(head[1])), "body": F.when(F.col("pos") > 0, F.regexp_replace("part", r"(?s)^[^\u0003]*\u0003", "")).otherwise(F.col("part")), "page": 1 + F.coalesce(F.sum(breaks).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "upto": 1 + F.sum(breaks).over(order)})
    rows = rows.withColumn("kept", (F.col("pos") > 0) & (F.row_number().over(Window.partitionBy("doc_id", "nr").orderBy("pos")) == 1))
    rows = rows.withColumn("note", F.sum(F.col("kept").cast("int")).over(order)).where("note > 0")
    whole = F.when(F.col("kept"), F.col("body")).otherwise(F.concat(head[2], "body"))
    piece = F.struct("pos", whole.alias("t"))
    out = rows.groupBy("doc_id", "note").agg(F.min_by("nr", "pos").alias("nr"), F.min_by("tittel", "pos").alias("tittel"), F.array_sort(F.collect_list(piece)).alias("ts"), F.min("page").alias("p0"), F.max("upto").alias("p1"))
    text = F.replace(strip(F.array_join(F.transform("ts", lambda t: t["t"]), "")), F.lit(BREAK), F.lit("\n"))
    return out.select("doc_id", "nr", "tittel", text.alias("raw_text"), F.sequence(F.col("p0").cast("int"), F.col("p1").cast("int")).alias("page_refs"))


def enrich(notes: DataFrame, amounts: str = "raw_amounts", head: int | None = 300) -> DataFrame:
    """Adds scale_inferred (from the first `head` characters, or the whole text), scaled amounts, note_type and has_table."""
    scale = detect_scale(F.col("raw_text") if head is None else F.substring("raw_text", 1, head))
    table = F.size(amounts) > 0
    return notes.withColumn("scale_inferred", scale).withColumns({amounts: F.transform_values(amounts, lambda k, v: v * F.col("scale_inferred")), "note_type": F.when(table, "table").otherwise("narrative"), "has_table": table})

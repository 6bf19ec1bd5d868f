"""Readers and writers. Rendering and character recognition stay outside, behind a batch function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordfacts.functions.text import strip

#: Reads a batch of pages (doc_id, page_no, content) into (doc_id, page_no, text).
OcrBackend = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_BOX = ("level", "page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height")


def read_binary(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """(path, name, orgnr, year, content, pdf_sha256_prefix) of files {orgnr}/…_{year}….pdf."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return df.select("path", name.alias("name"), F.regexp_extract("path", r"(\d{9})", 1).alias("orgnr"), F.regexp_extract(name, r"_(\d{4})", 1).try_cast("int").alias("year"), "content", file_hash(F.col("content")).alias("pdf_sha256_prefix"))


def file_hash(c: F.Column) -> F.Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def page_count(info: F.Column) -> F.Column:
    """Pages as stated by a document information text, 0 if it states none."""
    return F.coalesce(F.regexp_extract(info, r"(?m)^Pages:\s*(\d+)", 1).try_cast("int"), F.lit(0))


def unquoted(c: F.Column) -> F.Column:
    """A field of quoted text as a reader with '"' as quote character takes it: outer quotes go, doubled ones inside count once. Fields that aren't quoted stay as they are."""
    inner = F.replace(F.regexp_extract(c, '^"(.*)"$', 1), F.lit('""'), F.lit('"'))
    return F.when(c.rlike('^".*"$'), inner).otherwise(c)


def decode_tsv(rows: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Word boxes from lines of recognition TSV: level 5, text not blank, all numbers whole; anything else is dropped. No filter on confidence.

    One row is one line of the file: a quote that is opened and not closed takes in the rest of its own field only, never the next line.
    """
    cells = F.split(F.col(column), "\t")
    text = F.regexp_replace(unquoted(F.get(cells, F.lit(11))), '^"', "")
    df = rows.select(*keep, *(F.get(cells, F.lit(i)).try_cast("int").alias(n) for i, n in enumerate(_BOX)), F.get(cells, F.lit(10)).try_cast("double").alias("conf"), strip(text).alias("text"))
    good = F.col("level") == 5
    for n in _BOX:
        good = good & F.col(n).isNotNull()
    names = dict(zip(_BOX[1:6], ("page_no", "block_id", "par_id", "line_id", "word_id"), strict=True))
    return df.where(good & F.col("conf").isNotNull() & (F.length("text") > 0)).drop("level").withColumnsRenamed(names)


def recognise(pages: DataFrame, backend: OcrBackend) -> DataFrame:
    """(doc_id, page_no, text) by a backend, one Arrow batch at a time."""
    return pages.select("doc_id", "page_no", "content").mapInArrow(backend, "doc_id bigint, page_no int, text string")


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    """(orgnr, year) from lines `orgnr year`; comments and shorter lines are passed over."""
    return parse_spec(spark.read.text(path))


def parse_spec(lines: DataFrame, column: str = "value") -> DataFrame:
    parts = F.split(F.trim(F.col(column)), r"\s+")
    rows = lines.where(~F.startswith(F.trim(F.col(column)), F.lit("#"))).withColumn("_p", parts).where("size(_p) >= 2")
    return rows.select(F.get("_p", F.lit(0)).alias("orgnr"), F.get("_p", F.lit(1)).try_cast("int").alias("year"))


def read_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def write_records(df: DataFrame, path: str, key: tuple[str, ...] = ("orgnr", "year"), mode: str = "append") -> None:
    """JSON, one directory for each year and as many files as there are tasks, not one for each record."""
    df.write.mode(mode).partitionBy(*key[1:]).json(path)


def flat_for_csv(parts: list[DataFrame]) -> DataFrame:
    """The union of ragged tables, columns in name order, nested values as JSON."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    nested = ("array", "map", "struct")
    return out.select(*(F.to_json(c).alias(c) if out.schema[c].dataType.typeName() in nested else F.col(c) for c in sorted(out.columns)))


def write_csv(parts: list[DataFrame], path: str, mode: str = "overwrite") -> None:
    flat_for_csv(parts).write.mode(mode).option("header", "true").csv(path)

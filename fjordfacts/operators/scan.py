"""Statement fields found on page lines: one pattern of all labels reads the label that opens a line, an equi-join names its field, then the first hit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.functions.amounts import normalize_amount, two_number_split
from fjordfacts.functions.text import BLANKS, let, lstrip, once, split_lines, strip
from fjordfacts.operators.schema import FIELDS, scan_labels

_NUMS = "array<struct<v:double,at:int>>"


#: What may follow a label: its end, a mark, a number; no word.
_END = rf"$|[\t:.\u00a0,\d-]|[ ][{BLANKS}]*(?:$|[\d-])"


def anchored(line: Column, label: Column) -> Column:
    """Whether the label opens the line and no word goes on after it."""
    low, want = F.lower(lstrip(line)), F.lower(strip(label))
    return F.startswith(low, want) & F.substring(low, F.length(want) + 1, F.length(low)).rlike(f"^(?:{_END})")


def opening_label(line: Column, labels: list[str]) -> Column:
    """The label, in lower case, that opens the line as `anchored` has it, '' if none does. Labels of letters and blanks: of two that open a line only the longer can be anchored."""
    any_label = "|".join(sorted({x.lower() for x in labels}, key=lambda x: (-len(x), x)))
    return F.regexp_extract(F.lower(lstrip(line)), f"^({any_label})(?:{_END})", 1)


def _number(v: Column, at: Column | int) -> Column:
    return F.struct(v.alias("v"), (at if isinstance(at, Column) else F.lit(at)).alias("at"))


def _two(s: Column, first_at: Column | int) -> Column:
    both = F.array(_number(s["first"], first_at), _number(s["second"], 0))
    return F.filter(both, lambda x: x["v"].isNotNull()).cast(_NUMS)


def columns(tail: Column) -> Column:
    """Array of (v, at): the numbers after a label with the column (from 1) each stands in, 0 if it was cut out of a longer run. Columns of at most three digits are references and dropped."""
    cells = F.filter(F.transform(F.split(tail, "\t"), strip), lambda c: c != "")
    tabbed = F.contains(tail, F.lit("\t"))

    def read(c: Column, i: Column) -> Column:
        bare = F.translate(F.regexp_replace(c, r"[ \u00a0,-]", ""), "lOo", "100")
        whole = normalize_amount(c)
        cut = let(two_number_split(c), lambda s: F.when(~tabbed & s["second"].isNull(), F.when(s["first"].isNotNull(), F.array(_number(s["first"], 0)).cast(_NUMS)).otherwise(F.array().cast(_NUMS))).when(~tabbed, _two(s, 0)).otherwise(_two(s, i + 1)))
        none = F.array().cast(_NUMS)
        return F.when(bare.rlike(r"^\d{1,3}$"), none).when(tabbed & whole.isNotNull(), F.array(_number(whole, i + 1)).cast(_NUMS)).otherwise(cut)

    found = F.flatten(F.transform(cells, read))

    def resplit(nums: Column) -> Column:
        parts = two_number_split(F.get(cells, F.lit(0)))
        n_tokens = F.size(F.filter(F.split(F.get(cells, F.lit(0)), r"\s+"), lambda t: t != ""))
        digits = lambda v: F.length(F.floor(F.abs(v)).cast("string"))
        good = lambda s: (s["first"] != 0) & (s["second"] != 0) & (F.least(digits(s["first"]), digits(s["second"])) >= 3) & (F.least(F.abs(s["first"]), F.abs(s["second"])) / F.greatest(F.abs(s["first"]), F.abs(s["second"])) > 0.05)
        lone = let(parts, lambda s: F.when(s["second"].isNotNull() & ((F.size(nums) == 0) | ((n_tokens >= 4) & good(s))), _two(s, 0)).otherwise(nums))
        return F.when((F.size(cells) == 1) & (F.size(nums) < 2), lone).otherwise(nums)

    return let(found, resplit)


def group_columns(tail: Column) -> Column:
    """As `columns` for statements with a parent company: columns of at most four digits are dropped and nothing is cut in two."""
    cells = F.filter(F.transform(F.split(tail, "\t"), strip), lambda c: c != "")
    kept = F.filter(cells, lambda c: ~F.translate(F.regexp_replace(c, r"[ \u00a0,]", ""), "lOo", "100").rlike(r"^\d{1,4}$"))
    return F.filter(F.transform(kept, lambda c: normalize_amount(c)), lambda v: v.isNotNull())


def _tail(line: Column, label: Column) -> Column:
    return F.substring(line, F.position(F.lower(label), F.lower(line)) + F.length(label), F.length(line))


def page_lines(pages: DataFrame) -> DataFrame:
    """(doc_id, page_idx, line_idx, line, next_line); page_idx counts a document's pages from 0."""
    idx = F.row_number().over(Window.partitionBy("doc_id").orderBy("page_no")) - 1
    lines = pages.withColumn("page_idx", idx).withColumn("_ls", split_lines(F.coalesce("text", F.lit(""))))
    rows = lines.select("doc_id", "page_idx", "_ls", F.posexplode("_ls").alias("line_idx", "line"))
    return rows.select("doc_id", "page_idx", "line_idx", "line", F.get("_ls", F.col("line_idx") + 1).alias("next_line"))


def _matches(pages: DataFrame) -> DataFrame:
    lines = page_lines(pages).where(F.length("line") > 0)
    found = once(lines, _low=opening_label(F.col("line"), [x for f in FIELDS if f[3] != "generell" for x in f[4]])).where("_low <> ''")
    labels = F.broadcast(scan_labels(pages.sparkSession).withColumn("_low", F.lower("label")))  # 32 rows
    return found.join(labels, "_low").drop("_low")


def _first(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("doc_id", "canonical").orderBy("page_idx", "line_idx", "label_ord")
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def scan_fields(pages: DataFrame) -> DataFrame:
    """The first hit of each statement field in each document, with how it was read.

    Two or more numbers: the last two are this and last year. One number that isn't in the first column:
    this year's was lost. Else the next line is asked: two numbers there (wrapped), or one on each line (wrapped_value).
    """
    rows = once(_matches(pages), nums=columns(_tail(F.col("line"), F.col("label"))))
    # the next line is only read where this one doesn't settle it
    rows = once(rows, more=F.when(F.col("next_line").isNotNull() & (F.size("nums") < 2), columns(F.col("next_line"))))
    n, m = F.size("nums"), F.coalesce(F.size("more"), F.lit(0))
    kind = F.when(n >= 2, "two").when((n == 1) & (F.get("nums", F.lit(0))["at"] >= 2), "lost").when((n == 0) & (m >= 2), "wrapped").when((n == 1) & (m == 1), "wrapped_value")
    hits = _first(rows.withColumn("how", kind).where("how is not null"))
    at = lambda c, i: F.try_element_at(c, F.lit(i))["v"]
    how = F.col("how")
    value = F.when(how == "two", at("nums", -2)).when(how == "wrapped", at("more", -2)).when(how == "wrapped_value", at("nums", 1))
    prev = F.when(how == "two", at("nums", -1)).when(how == "lost", at("nums", 1)).when(how == "wrapped", at("more", -1)).otherwise(at("more", 1))
    raw = F.when(how.isin("wrapped", "wrapped_value"), F.concat("line", F.lit(" | "), "next_line")).otherwise(F.col("line"))
    return hits.select("doc_id", "canonical", value.alias("value"), prev.alias("value_prev"), "page_idx", "line_idx", raw.alias("raw_line"), F.col("label").alias("label_matched"), F.when(how == "wrapped", m).when(how == "wrapped_value", 2).otherwise(n).alias("n_numbers"), (how == "lost").alias("year_column_failed_ocr"), (how == "wrapped").alias("wrapped"), (how == "wrapped_value").alias("wrapped_value"))


def scan_group_fields(pages: DataFrame) -> DataFrame:
    """As `scan_fields` for group statements: with four numbers the last two are the group's and the two before the parent's."""
    rows = once(_matches(pages), nums=group_columns(_tail(F.col("line"), F.col("label")))).where("size(nums) >= 2")
    four = F.size("nums") >= 4
    at = lambda i: F.try_element_at("nums", F.lit(i))
    return _first(rows).select("doc_id", "canonical", at(-2).alias("value"), at(-1).alias("value_prev"), F.when(four, at(-4)).alias("morselskap_value"), F.when(four, at(-3)).alias("morselskap_value_prev"), "page_idx", "line_idx", F.col("line").alias("raw_line"), F.col("label").alias("label_matched"), F.size("nums").alias("n_numbers"), F.when(four, "4col").otherwise("2col_fallback").alias("layout"))


def loose_value(pages: DataFrame, labels: DataFrame, on: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """`on`, field, value, raw: of the first line that opens with the label, longer labels included, the last number but one, or the only one, cut to a whole number; null if that line has none.

    labels: (`on`, field, label). Columns of at most four digits don't count.
    """
    lines = pages.select(*on, F.posexplode(split_lines(F.col("text"))).alias("line_idx", "line")).join(labels, list(on))
    want = F.lower(strip(F.col("label")))
    low = F.lower(lstrip(F.col("line")))
    hit = lines.where(F.startswith(low, want) & F.substring(low, F.length(want) + 1, F.length(low)).rlike(r"^($|[\t :.\u00a0,\d-])"))
    first = hit.groupBy(*on, "field").agg(F.min_by(F.struct("line", "label"), "line_idx").alias("x")).select(*on, "field", F.col("x.line").alias("raw"), "x.label")
    cells = F.filter(F.transform(F.split(F.substring(F.col("raw"), F.length("label") + 1, F.length("raw")), "\t"), strip), lambda c: (c != "") & ~F.regexp_replace(c, r"[ \u00a0,]", "").rlike(r"^\d{1,4}$"))
    rows = once(first, nums=F.filter(F.transform(cells, lambda c: normalize_amount(c)), lambda v: v.isNotNull()))
    return rows.select(*on, "field", F.coalesce(F.try_element_at("nums", F.lit(-2)), F.try_element_at("nums", F.lit(1))).cast("bigint").alias("value"), "raw")

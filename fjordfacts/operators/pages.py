"""Pages by their sizes and ink: registry and company part, page types, zones, signs of group accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.operators import fingerprint

# Width of the registry's pages; heights of auditors' pages.
REGISTRY_WIDTH = 1728
AUDIT_HEIGHTS = (2140, 2337)
#: Ink and white as mean grey of a row; blank rows that end a block; shortest block; narrowest column gap.
INK, LINE_INK, MIN_GAP, MIN_BLOCK, COLUMN_GAP = 245, 240, 40, 15, 40


def split_pages(dims: DataFrame) -> DataFrame:
    """Adds brreg_last (pages of the leading run of registry width), source and nested_wrapper to (doc_id, page, img_w, img_h)."""
    doc = Window.partitionBy("doc_id")
    first_other = F.min(F.when(F.coalesce(F.col("img_w") != REGISTRY_WIDTH, F.lit(True)), F.col("page"))).over(doc)
    last = F.coalesce(first_other - 1, F.max("page").over(doc)).cast("int")
    df = dims.withColumns({"brreg_last": last, "n_pages": F.max("page").over(doc).cast("int")})
    registry = F.col("page") <= F.col("brreg_last")
    return df.withColumns({"source": F.when(registry, "brreg").otherwise("company"), "nested_wrapper": ~registry & F.coalesce(F.col("img_w") == REGISTRY_WIDTH, F.lit(False))})


def page_type(page: Column, source: Column, brreg_last: Column, height: Column) -> Column:
    """A registry page's type by its place, a company page's by its height."""
    balance = (page == 3) | ((page == 4) & (brreg_last >= 5)) | ((page == 5) & (brreg_last >= 10))
    place = F.when(page == 1, "generell_info").when(page == 2, "resultatregnskap").when(balance, "balanse").otherwise("noter")
    return F.when(source == "brreg", place).when(height.isin(*AUDIT_HEIGHTS), "revisjonsberetning")


def typed_pages(dims: DataFrame) -> DataFrame:
    return split_pages(dims).withColumn("page_type", page_type(F.col("page"), F.col("source"), F.col("brreg_last"), F.col("img_h")))


def height_groups(dims: DataFrame) -> DataFrame:
    """(doc_id, groups): company pages by height, pages in order."""
    rows = split_pages(dims).where("source = 'company'").groupBy("doc_id", "img_h").agg(F.array_sort(F.collect_list("page")).alias("pages"))
    return rows.groupBy("doc_id").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("img_h", "pages"))), lambda g: F.struct(g["img_h"].cast("string"), g["pages"]))).alias("groups"))


def ink_blocks(profile: DataFrame, key: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """(key, y0, y1, height, n_lines) from (key, row, mean), one row for each row of a page.

    A block is a run of ink rows with at most MIN_GAP blank rows between them. Its last ink row is left out of it; a
    block with no more than MIN_GAP rows below it goes on to the page's last row. Gaps and islands in one window.
    """
    w = Window.partitionBy(*key).orderBy("row")
    rows = profile.withColumn("bottom", F.max("row").over(Window.partitionBy(*key)))
    ink = rows.where(F.col("mean") < INK).withColumns({"_above": F.lag("row").over(w), "_dark_above": F.lag(F.col("mean") < LINE_INK).over(w), "dark": F.col("mean") < LINE_INK})
    blocks = ink.withColumn("block", F.sum(F.coalesce((F.col("row") - F.col("_above") - 1 > MIN_GAP).cast("int"), F.lit(0))).over(w))
    # a line begins where a dark row follows one that isn't
    starts = F.col("dark") & ~F.coalesce((F.col("_above") == F.col("row") - 1) & F.col("_dark_above"), F.lit(False))
    found = blocks.groupBy(*key, "block").agg(F.min("row").alias("y0"), F.max("row").alias("last"), F.max("bottom").alias("bottom"), F.count_if(starts).alias("starts"), F.min_by(starts, "row").alias("first_starts"), F.max_by(starts, "row").alias("last_starts"))
    y1 = F.when(F.col("bottom") - F.col("last") <= MIN_GAP, F.col("bottom")).otherwise(F.col("last"))
    found = found.withColumn("y1", y1)
    outside = F.col("first_starts").cast("int") + (F.col("last_starts") & (F.col("last") > F.col("y0")) & (F.col("y1") == F.col("last"))).cast("int")
    return found.select(*key, "y0", "y1", (F.col("y1") - F.col("y0")).alias("height"), (F.col("starts") - outside).alias("n_lines")).where(F.col("height") >= MIN_BLOCK)


def column_gaps(profile: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """(key, n_col_gaps, widest) from (key, col, width, mean) of a block's columns: white runs, closed by ink, of COLUMN_GAP or more whose middle lies between a tenth and nine tenths of the interior."""
    left, right = F.floor(F.col("width") * 0.05), F.floor(F.col("width") * 0.95)
    interior = profile.where((F.col("col") >= left) & (F.col("col") < right))
    w = Window.partitionBy(*key).orderBy("col")
    ink = interior.where("mean <= 248").withColumn("before", F.coalesce(F.lag("col").over(w), left - 1))
    gap = F.col("col") - F.col("before") - 1
    middle = ((F.col("before") + 1 + F.col("col")) / 2 - left) / (right - left)
    good = (gap >= COLUMN_GAP) & (middle > 0.1) & (middle < 0.9)
    return ink.groupBy(*key).agg(F.count_if(good).alias("n_col_gaps"), F.max(F.when(good, gap)).alias("widest"))


def zone_label(n_gaps: Column, widest: Column, height: Column, n_lines: Column) -> Column:
    return F.when((n_gaps >= 2) | ((n_gaps == 1) & (widest > 100)), "table").when((height < 50) & (n_gaps == 0) & (n_lines <= 2), "title").otherwise("text")


def page_zones(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """(doc_id, page, y0, y1, label, height, n_col_gaps, n_lines) from row means and, for each block by its y0, column means."""
    gaps = column_gaps(columns, ("doc_id", "page", "y0"))
    joined = ink_blocks(rows).join(gaps, ["doc_id", "page", "y0"], "left").withColumn("n_col_gaps", F.coalesce("n_col_gaps", F.lit(0)))
    return joined.select("doc_id", "page", "y0", "y1", zone_label(F.col("n_col_gaps"), F.col("widest"), F.col("height"), F.col("n_lines")).alias("label"), "height", "n_col_gaps", "n_lines")


def classified_pages(dims: DataFrame, zones: DataFrame) -> DataFrame:
    """typed_pages with has_table, max_col_gaps and zones. A registry page but the first holds a table by its place, a company page if one of its zones is one, an auditor's page never."""
    zone = F.struct("y0", "y1", "label", "height", "n_col_gaps", "n_lines")
    own = zones.groupBy("doc_id", "page").agg(F.max(F.col("label") == "table").alias("_table"), F.max("n_col_gaps").alias("max_col_gaps"), F.array_sort(F.collect_list(zone)).alias("zones"))
    df = typed_pages(dims).join(own, ["doc_id", "page"], "left")
    table = F.when(F.col("source") == "brreg", F.col("page") > 1).when(F.col("page_type").isNotNull(), F.lit(False)).otherwise(F.coalesce("_table", F.lit(False)))
    return df.withColumns({"has_table": table, "max_col_gaps": F.coalesce("max_col_gaps", F.lit(0)), "zones": F.coalesce("zones", F.array().cast(df.schema["zones"].dataType))}).drop("_table")


def group_evidence(classified: DataFrame) -> DataFrame:
    """(doc_id, evidence, detected): company pages with four or more column gaps; five of them make group accounts."""
    sign = F.when((F.col("source") == "company") & (F.col("max_col_gaps") >= 4), F.struct("page", F.lit("high_col_gap_page").alias("signal"), "max_col_gaps"))
    found = classified.groupBy("doc_id").agg(F.array_sort(F.collect_list(sign)).alias("evidence"))
    return found.withColumn("detected", F.size("evidence") >= 5)


def footers(classified: DataFrame, hashes: DataFrame) -> DataFrame:
    """(doc_id, footer_hash, platform, detection_method): the footer of the second company page from (doc_id, page, hash), what stands for it where there is none."""
    rank = F.sum((F.col("source") == "company").cast("int")).over(Window.partitionBy("doc_id").orderBy("page"))
    ranked = classified.select("doc_id", "page", F.when(F.col("source") == "company", rank).alias("company_rank"))
    own = ranked.where("company_rank = 2").join(hashes, ["doc_id", "page"], "left").select("doc_id", "hash")
    n = ranked.groupBy("doc_id").agg(F.max("company_rank").alias("n_company"))
    named = fingerprint.platform(n.join(own, "doc_id", "left"))
    special = F.when(F.col("n_company").isNull(), "brreg_only").when(F.col("n_company") == 1, "single_page_company")
    text = fingerprint.to_hex(F.col("hash"))
    return named.select("doc_id", text.alias("footer_hash"), F.coalesce(special, "platform").alias("platform"), F.when(F.col("hash").isNotNull(), "footer_avg_hash_hamming5").otherwise("structural").alias("detection_method"))


def manifest(files: DataFrame, dims: DataFrame, zones: DataFrame, hashes: DataFrame) -> DataFrame:
    """One nested row for each document: document, split, platform, konsern, company_height_groups, pages, created_at.

    files: (doc_id, orgnr, year, content); dims: (doc_id, page, img_w, img_h); zones as of `page_zones`; hashes: (doc_id, page, hash) of
    footers. A file without pages keeps its row, with no pages and nothing found.
    """
    pages = classified_pages(dims, zones)
    page = F.struct("page", "source", F.col("page_type").alias("type"), "has_table", "img_w", "img_h", "max_col_gaps", "zones")
    head = pages.groupBy("doc_id").agg(F.max("brreg_last").alias("last"), F.max("n_pages").alias("n"), F.array_sort(F.collect_list(page)).alias("pages"), F.array_sort(F.collect_list(F.when(F.col("nested_wrapper"), F.col("page")))).alias("nested"))
    df = files.join(head, "doc_id", "left").join(group_evidence(pages), "doc_id", "left").join(footers(pages, hashes), "doc_id", "left").join(height_groups(dims), "doc_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return df.select(
        "doc_id", F.struct("orgnr", "year", fingerprint.content_hash(F.col("content")).alias("pdf_sha256_prefix"), F.octet_length("content").alias("file_size_bytes"), zero("n").alias("total_pages")).alias("document"),
        F.struct(zero("last").alias("brreg_last_page"), zero("last").alias("n_brreg"), (zero("n") - zero("last")).alias("n_company"), F.col("nested").alias("nested_wrapper_pages")).alias("split"),
        F.struct(F.coalesce("platform", F.lit("brreg_only")).alias("id"), "footer_hash", F.coalesce("detection_method", F.lit("structural")).alias("detection_method")).alias("platform"),
        F.struct(F.coalesce("detected", F.lit(False)).alias("detected"), "evidence").alias("konsern"), F.col("groups").alias("company_height_groups"), "pages", F.current_timestamp().alias("created_at"),
    )


def is_modern(n_brreg: Column) -> Column:
    """Whether a filing has the registry's own pages, which the statement flow reads."""
    return n_brreg >= 1

"""Page fingerprints: 64-bit hashes, platform by Hamming distance, supplier by text, leader clusters."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjordfacts.session import cut

# Footer hashes of known platforms, in the order they are tried.
PLATFORMS = (
    ("0000000000000000", "fiken_tripletex_conta"), ("fdfff8f8ffffffff", "orgnr_footer"), ("000001000000ffff", "pipe_orgnr"),
    ("ffff3c3cffffffff", "visma_finale_a"), ("ffff0000ffffffff", "visma_finale_b"), ("ffff1c9fffffffff", "visma_finale_c"),
)
MAX_DISTANCE = 5
#: Width of the registry's pages.
REGISTRY_WIDTH = 1728


def from_hex(c: Column) -> Column:
    """16 hex digits as a signed 64-bit number."""
    return F.conv(c, 16, -10).cast("bigint")


def to_hex(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def average_hash(values: Column) -> Column:
    """Bit i (from the left) says whether value i is above the mean of all 64."""
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(values)
    return F.aggregate(F.transform(values, lambda x: (x.cast("double") > mean).cast("bigint")), F.lit(0).cast("bigint"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))


def difference_hash(values: Column, width: int = 9) -> Column:
    """Bit i (from the left) says whether a value is above its left neighbour in a raster of rows of `width` values."""
    n = F.size(values)
    inner = F.filter(F.sequence(F.lit(1), n - 1), lambda i: i % width != 0)
    return F.aggregate(F.transform(inner, lambda i: (F.get(values, i) > F.get(values, i - 1)).cast("bigint")), F.lit(0).cast("bigint"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))


def perceptual_hash(df: DataFrame, values: str, out: str = "phash", side: int = 32, low: int = 8) -> DataFrame:
    """Adds the hash of the low frequencies of a side x side raster: bit i says whether coefficient i of the cosine transform is above their median. A raster of another size gives null."""
    k, x = np.arange(low)[:, None], np.arange(side)[None, :]
    basis = 2 * np.cos(np.pi * k * (2 * x + 1) / (2 * side))

    @F.pandas_udf("bigint")
    def hashed(rasters: pd.Series) -> pd.Series:
        good = rasters.map(lambda r: r is not None and len(r) == side * side).to_numpy(bool)
        result = pd.Series(pd.array([None] * len(rasters), "Int64"))
        if good.any():
            stack = np.stack(rasters[good].to_numpy()).astype(float).reshape(-1, side, side)
            coefficients = (basis @ stack @ basis.T).reshape(-1, low * low)
            bits = coefficients > np.median(coefficients, axis=1, keepdims=True)
            packed = np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64).view(np.int64)
            result[np.flatnonzero(good)] = packed
        return result

    return df.withColumn(out, hashed(F.col(values)))


def content_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def fallback_hash(c: Column) -> Column:
    """Stands for all three image hashes where none can be computed."""
    return F.substring(F.md5(c), 1, 16)


def crop(rows: Column, zone: str) -> Column:
    """Header (top 15 %) or footer (from 88 % down) of a page given as an array of rows."""
    n = F.size(rows)
    if zone == "header":
        return F.slice(rows, F.lit(1), F.floor(n * 0.15).cast("int"))
    return F.slice(rows, (F.floor(n * 0.88) + 1).cast("int"), n)


def platform(hashes: DataFrame, column: str = "hash") -> DataFrame:
    """Adds platform: the first template within MAX_DISTANCE in list order, else unknown_<hash>; null hashes give no_image. The templates are a fixed list."""
    chain = F.when(F.col(column).isNull(), "no_image")
    for text, name in PLATFORMS:
        value = int(text, 16)
        signed = value - (1 << 64) if value >= 1 << 63 else value
        chain = chain.when(hamming(F.col(column), F.lit(signed).cast("bigint")) <= MAX_DISTANCE, name)
    return hashes.withColumn("platform", chain.otherwise(F.concat(F.lit("unknown_"), to_hex(F.col(column)))))


def supplier(header: Column, footer: Column) -> Column:
    """struct(leverandor, confidence, match_type) by the first rule that holds."""
    h, f = F.coalesce(header, F.lit("")), F.coalesce(footer, F.lit(""))
    says = lambda name, level, where: F.struct(F.lit(name).alias("leverandor"), F.lit(level).alias("confidence"), F.lit(where).alias("match_type"))
    return (
        F.when(f.rlike(r"(?i)side\s+\d+"), says("visma_finale", "high", "footer_regex")).when(h.rlike(r"(?i)noter\s+\d{4}\s*\n"), says("fiken_tripletex", "high", "header_regex"))
        .when(f.rlike(r"(?i)poweroffice"), says("poweroffice", "high", "footer_regex")).when(f.rlike(r"(?i)conta\.no|conta as"), says("conta", "medium", "footer_regex"))
        .when(f.rlike(r"(?i)24seven"), says("24sevenoffice", "medium", "footer_regex")).otherwise(says("unknown", "none", "none"))
    )


def sampled_pages(pages: DataFrame, max_company_pages: int = 5) -> DataFrame:
    """Of (doc_id, page_idx from 0, width, height, …) the first three pages and `max_company_pages` from the first page that isn't of registry width on.

    Adds source by the page's own width, page_type of the first three registry pages, n_pages, boundary (null if
    all pages are of registry width; the company part then begins at the first) and is_target: the second company page, or the only one.
    """
    doc = Window.partitionBy("doc_id")
    company = F.coalesce(F.col("width") != REGISTRY_WIDTH, F.lit(True))
    df = pages.withColumns({"source": F.when(company, "company").otherwise("brreg"), "n_pages": F.count(F.lit(1)).over(doc), "boundary": F.min(F.when(company, F.col("page_idx"))).over(doc)})
    start = F.coalesce("boundary", F.lit(0))
    df = df.where((F.col("page_idx") < 3) | ((F.col("page_idx") >= start) & (F.col("page_idx") < start + max_company_pages)))
    own = F.sum((F.col("source") == "company").cast("int"))
    df = df.withColumns({"_rank": F.when(F.col("source") == "company", own.over(doc.orderBy("page_idx"))), "_most": own.over(doc)})
    kind = F.when(F.col("source") == "brreg", F.when(F.col("page_idx") == 0, "generell_info").when(F.col("page_idx") == 1, "resultatregnskap").when(F.col("page_idx") == 2, "balanse"))
    return df.withColumns({"page_type": kind, "is_target": F.coalesce(F.col("_rank") == F.least(F.lit(2), F.col("_most")), F.lit(False))}).drop("_rank", "_most")


def fingerprint_pages(pages: DataFrame) -> DataFrame:
    """Adds hex hashes to (…, footer, header): rasters as flat arrays of 64 grey values (phash apart, see `perceptual_hash`), null where a zone has none."""
    at = lambda c: F.when(F.size(c) > 0, to_hex(average_hash(F.col(c))))
    return pages.withColumns({"ahash_footer": at("footer"), "ahash_header": at("header"), "dhash_footer": F.when(F.size("footer") > 0, to_hex(difference_hash(F.col("footer"), 8)))})


def fingerprint_files(pages: DataFrame, max_company_pages: int = 5) -> DataFrame:
    """(doc_id, n_pages, boundary, leverandor, confidence, match_type, pages): each file's sampled pages and its supplier by the target page's texts.

    pages: (doc_id, page_idx, width, height, header_text, footer_text, error). A file with an error on any page gives the supplier `error`
    and nothing else, instead of ending the run; one without company pages is unknown.
    """
    failed = F.max("error").over(Window.partitionBy("doc_id"))
    df = sampled_pages(pages.withColumn("_error", failed), max_company_pages)
    says = supplier(F.col("header_text"), F.col("footer_text"))
    page = F.struct("page_idx", "source", "page_type", "width", "height")
    rows = df.groupBy("doc_id").agg(F.max("_error").alias("error"), F.max("n_pages").alias("n_pages"), F.max("boundary").alias("boundary"), F.max(F.when(F.col("is_target"), says)).alias("s"), F.array_sort(F.collect_list(page)).alias("pages"))
    good = F.col("error").isNull()
    return rows.select(
        "doc_id", F.when(good, F.col("n_pages")).otherwise(0).alias("n_pages"), F.when(good, F.col("boundary")).alias("boundary"), F.when(good, F.coalesce("s.leverandor", F.lit("unknown"))).otherwise("error").alias("leverandor"),
        F.when(good, F.coalesce("s.confidence", F.lit("none"))).otherwise("none").alias("confidence"), F.when(good, F.col("s.match_type")).alias("match_type"), F.when(good, F.col("pages")).otherwise(F.array().cast(rows.schema["pages"].dataType)).alias("pages"), "error",
    )


#: Bands of eight bits of a hash. Two hashes that differ in five bits agree in three bands at least.
BANDS, AGREE = 8, 3


def near_pairs(hashes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b), structs of (ord, hash): distinct hashes at most `max_distance` (5 or less) bits apart, a before b. Candidates agree in three bands, 24 bits."""
    if max_distance > BANDS - AGREE:
        raise ValueError(f"bands find distances up to {BANDS - AGREE} only")
    band = lambda c, i: F.shiftrightunsigned(c, 8 * i).bitwiseAND(F.lit(255).cast("bigint"))
    keys = F.array(*(F.struct(F.array(*map(F.lit, some)).alias("which"), F.array(*(band(F.col("hash"), i) for i in some)).alias("bits")) for some in combinations(range(BANDS), AGREE)))
    rows = hashes.select("hash", "ord", F.inline(keys))
    one, two = (rows.select("which", "bits", F.struct("ord", "hash").alias(n)) for n in ("a", "b"))
    pairs = one.join(two, ["which", "bits"]).where((F.col("a.ord") < F.col("b.ord")) & (hamming(F.col("a.hash"), F.col("b.hash")) <= max_distance))
    # a pair that agrees in more bands counts for the first three
    same = F.array_compact(F.array(*(F.when(band(F.col("a.hash"), i) == band(F.col("b.hash"), i), F.lit(i)) for i in range(BANDS))))
    return pairs.where(F.slice(same, 1, AGREE) == F.col("which")).select("a", "b")


def leader_clusters(hashes: DataFrame, max_distance: int = MAX_DISTANCE, order: str = "ord", column: str = "hash") -> DataFrame:
    """(hash, cluster): every distinct hash with its leader, the first hash in order within `max_distance` (at most 5) bits that is a leader itself.

    Only pairs within the distance matter, found by bands of bits. A hash is settled once all near ones before it
    are: it joins the first leader among them, else it leads. Each round settles all that can be settled; rounds go on
    until none is open, as many as the longest chain of near hashes is long. Null hashes are left out.
    """
    rows = cut(hashes.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("hash")).agg(F.min(order).alias("ord")))
    # ordinals may tie: the hash decides then
    near = cut(near_pairs(rows.select("hash", F.struct("ord", "hash").alias("ord")), max_distance).select(F.col("a.hash").alias("before"), F.col("a.ord").alias("before_ord"), F.col("b.hash").alias("hash")))
    done = cut(rows.join(near, "hash", "left_anti").select("hash", F.col("hash").alias("cluster")))
    open_rows = cut(rows.join(done, "hash", "left_anti").select("hash"))
    while not open_rows.isEmpty():
        known = near.join(open_rows, "hash", "left_semi").join(done.select(F.col("hash").alias("before"), (F.col("hash") == F.col("cluster")).alias("leads")), "before", "left")
        state = known.groupBy("hash").agg(F.min(F.when(F.col("leads"), F.struct("before_ord", "before"))).alias("leader"), F.min(F.when(F.col("leads").isNull(), F.col("before_ord"))).alias("unknown"))
        sure = F.col("unknown").isNull() | (F.col("leader.before_ord") < F.col("unknown"))
        settled = cut(state.where(sure).select("hash", F.coalesce("leader.before", "hash").alias("cluster")))
        done = cut(done.unionByName(settled))
        open_rows = cut(open_rows.join(settled, "hash", "left_anti"))
    return done


def seeded_sample(keys: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n distinct keys by the order of md5(key, seed): the same on every run and every partitioning."""
    rank = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return keys.select(key).where(F.col(key).isNotNull()).distinct().orderBy(rank, key).limit(n)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """(column, n, pct): counts and shares of all rows."""
    rows = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 2))  # a row per value, not per record


def top_clusters(clusters: DataFrame, n: int = 20) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "cluster").limit(n)

"""Queries of the problems on training text: each runs over its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordfacts.llm import chunking, leaks, mixing, ocr_text, survivors
from fjordfacts.session import cut, table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr_text.pages(table(spark, sf_dir, "noter"), table(spark, sf_dir, "generell_info"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr_text.found_lines(ocr_text.lines(_pages(spark, sf_dir)))


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_rows = cut(_pages(spark, sf_dir))
    line_rows = cut(ocr_text.lines(page_rows, with_words=True))
    counts = cut(ocr_text.word_counts(line_rows))
    return ocr_text.repaired(page_rows, cut(ocr_text.misread_words(counts, cut(ocr_text.bigrams(line_rows)))))


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.claims(table(spark, sf_dir, "records"), table(spark, sf_dir, "noter"), table(spark, sf_dir, "kilder"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.survivors(_claims(spark, sf_dir)).drop("value")


def p5_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.discover(_claims(spark, sf_dir))[0]


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_leaks(spark, sf_dir).select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = table(spark, sf_dir, "mix_targets")
    counts = cut(mixing.histogram(mixing.lengths(table(spark, sf_dir, "documents"), keep_ids=False)))
    return mixing.short_sources(mixing.plan(counts, mix), counts, mix)


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    mix = table(spark, sf_dir, "mix_targets")
    measured = cut(mixing.lengths(table(spark, sf_dir, "documents")))
    counts = cut(mixing.histogram(measured))
    return measured, counts, cut(mixing.plan(counts, mix)), mix


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured, _, planned, _ = _mixed(spark, sf_dir)
    return mixing.mixture(measured, planned)


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts, planned, mix = _mixed(spark, sf_dir)
    return mixing.shares(planned, counts, mix)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut_texts = chunking.pieces(table(spark, sf_dir, "documents"), with_text=False, only_cut=True)
    return cut_texts.where(F.col("piece") == 1).select("doc_id").distinct()


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.pieces(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_repaired, p5_found, p5_truth, p7_found, p7_leaks, p8_found, p8_mixture, p8_shares, p9_found, p9_pieces)}

ORACLE = {
    "p5_found": """
with r as (
  select distinct doc_id, regexp_replace(orgnr, '[^0-9]', '', 'g') as orgnr, coalesce(year, try_cast(substr(regnskapsperiode_til, 1, 4) as int)) as year,
    lower(trim(prompt_name)) as prompt_name, extracted_at from records),
s as (select orgnr, year from r group by 1, 2 having count(distinct doc_id) > 1),
v as (select distinct doc_id, nr, unnest(map_entries(raw_amounts)) as e from noter),
c as (
  select r.orgnr, r.year, v.nr, v.e.key as amount_key, r.doc_id, k.trust_rank, r.extracted_at
  from r join s on r.orgnr = s.orgnr and r.year = s.year join v on v.doc_id = r.doc_id left join kilder k on k.prompt_name = r.prompt_name
  where v.e.value is not null)
select orgnr, year, nr, amount_key, doc_id from c
qualify row_number() over (partition by orgnr, year, nr, amount_key order by trust_rank nulls last, extracted_at desc nulls last, doc_id desc) = 1""",
}

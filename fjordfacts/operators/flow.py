"""The two flows end to end: pages to notes and their payload, registry pages to checked statement values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordfacts.operators import metadata, pages, reconcile, scan
from fjordfacts.session import cut


def notes_payload(notes: DataFrame, page_texts: DataFrame, files: DataFrame, made_by: dict[str, str]) -> DataFrame:
    """One row of 18 keys for each document with pages: who read it and how, its pages, its notes.

    notes: (doc_id, nr, tittel, raw_text, page_refs, scale_inferred, raw_amounts, note_type, has_table); page_texts: (doc_id, page_no); files: (doc_id,
    orgnr, year, pdf_hash); made_by: prompt_name, model, input_mode, media_resolution.
    """
    note = F.struct(F.col("page_refs")[0].alias("first_page"), "nr", "tittel", "raw_text", "page_refs", "scale_inferred", "raw_amounts", F.col("note_type").alias("type"), "has_table")
    keys = ("nr", "tittel", "raw_text", "page_refs", "scale_inferred", "raw_amounts", "type", "has_table")
    # maps can't be compared, so the notes are put in order by their places alone
    order = F.struct(F.col("page_refs")[0].alias("first_page"), "nr")
    own = notes.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(order, note))).alias("m"), F.array_sort(F.collect_list(order)).alias("o"))
    own = own.select("doc_id", F.transform("o", lambda k: F.struct(*(F.try_element_at("m", k)[c].alias(c) for c in keys))).alias("noter"))
    sent = page_texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages_sent"))
    df = sent.join(own, "doc_id", "left").join(files, "doc_id", "left")
    noter = F.coalesce("noter", F.array().cast(own.schema["noter"].dataType))
    return df.select(
        "doc_id", "orgnr", "year", "pdf_hash", *(F.lit(made_by.get(k)).alias(k) for k in ("prompt_name", "model", "input_mode", "media_resolution")), F.current_timestamp().alias("timestamp"), "n_pages_sent",
        F.sequence(F.lit(1), F.col("n_pages_sent").cast("int")).alias("page_numbers"), F.lit(None).cast("bigint").alias("input_tokens"), F.lit(None).cast("bigint").alias("output_tokens"), F.lit(0.0).alias("cost_usd"), F.lit(None).cast("double").alias("elapsed_s"),
        F.lit("STOP").alias("finish_reason"), F.lit("ok").alias("status"), noter.alias("noter"), F.size(noter).alias("n_notes"),
    )


def statement_flow(dims: DataFrame, page_texts: DataFrame, api: DataFrame, spec: DataFrame, rereads: list[DataFrame] | None = None) -> DataFrame:
    """(doc_id, status, setup, n_brreg, n_company, n_pass, n_fail, n_missing_extract, n_missing_api, disagreements, n_recovered) of every document with pages.

    dims: (doc_id, page, img_w, img_h); page_texts: (doc_id, page_no, text); api: (doc_id, field, value as text); rereads: (doc_id, field, value) of
    further recognisers. A document without registry pages is skipped as of the old format. The first page tells the setup, which decides
    how the other registry pages are read; page_idx counts from the second. Every disagreement and every missing value is read
    again: once more on its page with the looser label rule, then by the recognisers given, and put to the vote.
    """
    split = cut(pages.split_pages(dims).groupBy("doc_id").agg(F.max("brreg_last").alias("n_brreg"), (F.max("n_pages") - F.max("brreg_last")).alias("n_company")))
    modern = split.where(pages.is_modern(F.col("n_brreg")))
    texts = page_texts.join(modern.select("doc_id", "n_brreg"), "doc_id").where(F.col("page_no") <= F.col("n_brreg"))
    none = F.lit(None)
    first = metadata.first_page(modern.select("doc_id").join(texts.where("page_no = 1").select("doc_id", "text"), "doc_id", "left"))
    page = {"found": F.lit(True), "avvikling": F.col("avviklingsregnskap"), "smaa": F.col("smaa_foretak"), "type": F.col("regnskapstype")}
    no_entry = {"found": F.lit(False), "avvikling": none.cast("boolean"), "smaa": none.cast("boolean"), "type": none.cast("string"), "plan": none.cast("string")}
    kinds = cut(first.select("doc_id", metadata.setup(no_entry, page, F.lit(False)).alias("setup")))
    rest = texts.where("page_no > 1").join(kinds, "doc_id")
    group = F.col("setup").isin("store_konsern", "smaa_konsern")
    one, two = scan.scan_group_fields(rest.where(group)), scan.scan_fields(rest.where(~group))
    hits = cut(one.select("doc_id", "canonical", "value", "page_idx", "label_matched").unionByName(two.select("doc_id", "canonical", "value", "page_idx", "label_matched")))

    own = hits.select("doc_id", F.col("canonical").alias("field"), "value")
    known = api.join(modern.select("doc_id"), "doc_id", "left_semi")
    checks = cut(reconcile.validate(own, known, spec).join(F.broadcast(spec.select(F.col("canonical").alias("field"), F.get("labels", F.lit(0)).alias("first_label"))), "field"))  # 34 rows
    asked = cut(reconcile.disagreements(checks, hits, limit=None, missing=True))
    again = scan.loose_value(rest.withColumn("page_idx", F.col("page_no") - 1).select("doc_id", "page_idx", "text"), asked.select("doc_id", "page_idx", "field", "label"), ("doc_id", "page_idx"))
    voted = reconcile.deep_dive(asked, [again, *(rereads or [])])
    out = split.join(kinds, "doc_id", "left").join(reconcile.validation_summary(checks), "doc_id", "left").join(reconcile.recovered(voted, known, spec), "doc_id", "left")
    skipped = ~pages.is_modern(F.col("n_brreg"))
    zero = lambda c: F.when(~skipped, F.coalesce(F.col(c), F.lit(0))).alias(c)
    nothing = F.array().cast("array<string>")
    return out.select("doc_id", F.when(skipped, "skipped_legacy_format").otherwise("ok").alias("status"), "setup", "n_brreg", "n_company", *map(zero, ("n_pass", "n_fail", "n_missing_extract", "n_missing_api")), F.when(~skipped, F.coalesce("disagreements", nothing)).alias("disagreements"), zero("n_recovered"))

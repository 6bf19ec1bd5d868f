"""Runs over many filings: which inputs count, what is already done, and summaries of what came out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_file(files: DataFrame) -> DataFrame:
    """Of (orgnr, year, name) the exact name aarsregnskap_{year}.pdf, else the last name with that prefix; keys without either give no row."""
    exact = F.col("name") == F.format_string("aarsregnskap_%d.pdf", "year")
    rows = files.where(exact | F.startswith("name", F.format_string("aarsregnskap_%d_", "year")))
    best = F.max(F.struct(exact.cast("int").alias("e"), F.when(~exact, F.col("name")).alias("n"), "name")).alias("b")
    return rows.groupBy("orgnr", "year").agg(best).select("orgnr", "year", "b.name")


def pending(inputs: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Inputs whose output doesn't exist yet."""
    return inputs.join(done.select(*key).distinct(), key, "left_anti")


#: What becomes of a filing in a resumable run; the last two count as errors.
STATUSES = ("ok", "already_exists", "skipped_legacy", "no_pdf", "no_nokkeltall", "error", "uncaught")


def progress(runs: DataFrame) -> DataFrame:
    """One row: n_processed and a count for each status; `error` includes uncaught ones. Other statuses count in n_processed only."""
    s = F.col("status")
    return runs.agg(F.count(F.lit(1)).alias("n_processed"), *(F.count_if(s == name).alias(name) for name in STATUSES[:5]), F.count_if(s.isin(*STATUSES[5:])).alias("error"))


def run_status(asked: DataFrame, done: DataFrame, files: DataFrame, api: DataFrame, outcome: DataFrame, key: list[str]) -> DataFrame:
    """key, status, reason of every filing asked for: what is done already, what lacks a file or a registry record, else the outcome (key, status, error).

    A filing without an outcome failed unseen. The reason keeps the end of an error's text, where the cause stands.
    """
    flag = lambda df, name: df.select(*key).distinct().withColumn(name, F.lit(True))
    rows = asked.select(*key).distinct().join(flag(done, "_done"), key, "left").join(flag(files, "_file"), key, "left").join(flag(api, "_api"), key, "left")
    rows = rows.join(outcome.select(*key, F.col("status").alias("_status"), F.col("error").alias("_error")), key, "left")
    status = F.when(F.col("_done"), "already_exists").when(F.col("_file").isNull(), "no_pdf").when(F.col("_api").isNull(), "no_nokkeltall").when(F.col("_error").isNotNull(), "error").otherwise(F.coalesce("_status", F.lit("uncaught")))
    return rows.select(*key, status.alias("status"), F.when(status == "error", F.substring("_error", F.greatest(F.lit(1), F.length("_error") - 1499), F.lit(1500))).alias("reason"))


def setup_distribution(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'ok'").groupBy("setup").agg(F.count(F.lit(1)).alias("n"))


def top_disagreements(checks: DataFrame, n: int = 20) -> DataFrame:
    """The statement fields that fail most often. Without a layout column all fields count as such."""
    bad = checks.where("missing = 'extracted' or (missing is null and not tolerance_ok)")
    if "layout" in checks.columns:
        bad = bad.where("layout in ('resultat', 'balanse')")
    return bad.groupBy("field").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field").limit(n)


def field_rates(checks: DataFrame) -> DataFrame:
    """(field, n_pass, n_fail, n_missing, pass_pct): missing counts before failing, rows without a verdict not at all."""
    missing = F.coalesce(F.col("missing") == "extracted", F.lit(False))
    ok = F.col("tolerance_ok")
    out = checks.groupBy("field").agg(F.count_if(~missing & ok).alias("n_pass"), F.count_if(~missing & ~ok).alias("n_fail"), F.count_if(missing).alias("n_missing"))
    return out.withColumn("pass_pct", F.round(100.0 * F.col("n_pass") / F.greatest(F.lit(1), F.col("n_pass") + F.col("n_fail") + F.col("n_missing")), 4))


def pass_rate(checks: DataFrame) -> DataFrame:
    """One row: n_pass, n_fail, n_missing and the rate of all fields."""
    t = field_rates(checks).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_pass", "n_fail", "n_missing")))
    return t.withColumn("field_pass_rate", F.round(F.col("n_pass") / F.greatest(F.lit(1), F.col("n_pass") + F.col("n_fail") + F.col("n_missing")), 9))


def diagnosis_counts(voted: DataFrame) -> DataFrame:
    """(diagnosis, n, n_resolved): only a corrected misreading is resolved."""
    return voted.groupBy("diagnosis").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("diagnosis") == "ocr_misread_corrected").alias("n_resolved"))


def mean_elapsed(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'ok'").agg(F.round(F.avg("elapsed"), 6).alias("mean_elapsed"), F.count("elapsed").alias("n"))


def audit_flags(notes: DataFrame, min_notes: int = 3, min_amounts: int = 20) -> DataFrame:
    """(doc_id, n_notes, total_amounts, thin_extraction, few_amounts)."""
    own = extract_summary(notes)
    return own.withColumns({"thin_extraction": F.col("n_notes") < min_notes, "few_amounts": F.col("total_amounts") < min_amounts})


def extract_summary(notes: DataFrame) -> DataFrame:
    return notes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_notes"), F.sum(F.coalesce(F.when(F.col("raw_amounts").isNotNull(), F.size("raw_amounts")), F.lit(0))).alias("total_amounts"))


def suspects(voted: DataFrame, n: int = 50) -> DataFrame:
    """The report's list of values the registry may have wrong: corrections with that diagnosis, which the vote never gives."""
    return voted.where("diagnosis = 'nokkeltall_suspect'").orderBy("doc_id", "field").limit(n)


def raster_pages(hits: DataFrame, pages: DataFrame, summary: DataFrame) -> DataFrame:
    """(doc_id, page), pages counted from 0: pages with a disagreeing hit, and the registry pages after the first of documents that miss a value.

    summary as of `validation_summary`; hits: (doc_id, canonical, page_idx), page_idx counting from the second page; pages: (doc_id, page from 1, source).
    """
    wrong = summary.select("doc_id", F.explode("disagreements").alias("canonical"))
    some = hits.join(wrong, ["doc_id", "canonical"], "left_semi").select("doc_id", (F.col("page_idx") + 1).cast("int").alias("page"))
    short = summary.where("size(disagreements) > 0 and n_missing_extract > 0").select("doc_id")
    rest = pages.where("source = 'brreg' and page > 1").join(short, "doc_id", "left_semi").select("doc_id", (F.col("page") - 1).cast("int").alias("page"))
    return some.unionByName(rest).distinct()


def run_totals(status: DataFrame, summary: DataFrame, corrections: DataFrame) -> DataFrame:
    """(metric, n): filings by status, field totals, corrections attempted and resolved.

    status: (doc_id, status); summary as of `validation_summary`; corrections: (doc_id, diagnosis).
    """
    s = F.col("status")
    counts = {"n_total": F.count(F.lit(1)), **{alias: F.count_if(s == name) for name, alias in (("ok", "n_ok"), ("no_pdf", "n_no_pdf"), ("no_api", "n_no_api"), ("skipped_legacy_format", "n_skipped_legacy"))}, "n_extract_failed": F.count_if(s.isin("extract_failed", "uncaught_exception"))}
    fields = {alias: F.coalesce(F.sum(c), F.lit(0)) for c, alias in (("n_pass", "field_pass_total"), ("n_fail", "field_fail_total"), ("n_missing_extract", "field_missing_total"))}
    fixed = {"n_corrections_attempted": F.count(F.lit(1)), "n_corrections_resolved": F.count_if(F.col("diagnosis") == "ocr_misread_corrected")}
    rows = [df.agg(F.array(*(F.struct(F.lit(k).alias("metric"), v.cast("bigint").alias("n")) for k, v in each.items())).alias("a")).select(F.inline("a")) for df, each in ((status, counts), (summary, fields), (corrections, fixed))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def per_filing(status: DataFrame, summary: DataFrame, corrections: DataFrame) -> DataFrame:
    """A run's table: one row for each filing with status, counts, disagreements joined by commas and corrections, nulls where it didn't get so far."""
    fixed = corrections.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_corrections"), F.count_if(F.col("diagnosis") == "ocr_misread_corrected").alias("n_corrections_resolved"))
    out = status.join(summary, "doc_id", "left").join(fixed, "doc_id", "left")
    return out.withColumn("disagreements", F.coalesce(F.array_join("disagreements", ","), F.lit("")))


def report(title: str, status: DataFrame, setups: DataFrame, rates: DataFrame, diagnoses: DataFrame, elapsed: DataFrame, doubted: DataFrame) -> str:
    """Markdown of small, already aggregated results: status and setup counts, field rates, corrections, suspects."""
    counts = {r["status"]: r["n"] for r in status.collect()}
    fields = rates.orderBy("field").collect()
    passed, failed, missing = (sum(r[c] for r in fields) for c in ("n_pass", "n_fail", "n_missing"))
    total = passed + failed + missing
    mean = elapsed.first()["mean_elapsed"]

    def grid(head: list[str], rows: list[list]) -> list[str]:
        return ["| " + " | ".join(head) + " |", "|" + " - |" * len(head), *("| " + " | ".join(map(str, r)) + " |" for r in rows), ""]

    cover = [["Records", sum(counts.values())], ["Status `ok`", counts.get("ok", 0)], *([f"Status `{s}`", n] for s, n in sorted(counts.items(), key=lambda x: (-x[1], str(x[0]))) if s != "ok"), ["Field checks", total]]
    if total:
        cover += [["Pass rate", f"{passed / total:.1%}"], ["Pass", passed], ["Fail", failed], ["Missing", missing]]
    if mean is not None:
        cover.append(["Mean seconds", f"{mean:.1f}"])
    found = diagnoses.orderBy(F.desc("n"), "diagnosis").collect()
    out = [f"# {title}", "", "## Coverage", "", *grid(["metric", "value"], cover), "## Setups", "", *grid(["setup", "n"], [[r["setup"], r["n"]] for r in setups.orderBy(F.desc("n"), "setup").collect()])]
    out += ["## Fields", "", *grid(["field", "pass", "fail", "missing", "%"], [[r["field"], r["n_pass"], r["n_fail"], r["n_missing"], f"{r['pass_pct']:.0f}"] for r in fields])]
    out += ["## Corrections", "", f"Attempted {sum(r['n'] for r in found)}, resolved {sum(r['n_resolved'] for r in found)}", "", *grid(["diagnosis", "n"], [[r["diagnosis"], r["n"]] for r in found])]
    doubts = doubted.collect()
    if doubts:
        out += ["## Suspects", "", *grid(list(doubted.columns), [list(r) for r in doubts])]
    return "\n".join(out)

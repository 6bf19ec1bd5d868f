"""Hand-traced goldens of layout, notes, tables, first page, statement scan, pages, fingerprints and reconciliation."""

import random

import numpy as np
from pyspark.sql import functions as F

from fjordfacts.operators import fingerprint, kv, layout, metadata, notes, pages, reconcile, runs, scan
from fjordfacts.operators.schema import FIELDS, WORDS, field_spec
from fjordfacts.sources import io


def _word(i, left, text, line=1, width=10):
    return (1, 1, 1, 1, line, i, left, 5 * line, width, 5, 0.9, text)


def test_tabs_by_upper_median_gap(spark):
    near = [_word(0, 0, "a"), _word(1, 20, "b"), _word(2, 40, "c"), _word(3, 150, "d"), _word(0, 0, "z", 2), _word(1, 50, " ", 2)]
    assert layout.page_text(spark.createDataFrame(near, WORDS)).first().text == "a b c\td\nz"
    two = [_word(0, 0, "a"), _word(1, 20, "b"), _word(2, 70, "c")]
    assert layout.page_text(spark.createDataFrame(two, WORDS)).first().text == "a b c"
    assert layout.page_text(spark.createDataFrame([], WORDS)).count() == 0


def test_segment_notes(spark):
    rows = [(1, 1, "x\nNote 3\nLønn\ntekst"), (2, 1, "Note 1\nNote 2\nTittel\nx"), (3, 1, "Note\t2024\t2023\nfoo"), (4, 1, "Note 3 A\nbody1\nNote 3 A\nbody2"), (5, 1, "intro\nNote 1: Lønn\na\nb"), (5, 2, "c\nNote 2 - Skatt\nd"), (6, 1, None), (7, 1, "")]
    got = {(r.doc_id, r.nr): (r.tittel, r.raw_text, r.page_refs) for r in notes.segment(spark.createDataFrame(rows, "doc_id long, page_no int, text string")).collect()}
    assert got == {
        (1, "3"): ("Lønn", "tekst", [1]), (2, "1"): ("Note 2", "", [1]), (2, "2"): ("Tittel", "x", [1]), (3, "2024"): ("2023", "foo", [1]), (4, "3"): ("A", "body1\nNote 3 A\nbody2", [1]),
        (5, "1"): ("Lønn", "a\nb\nc", [1, 2]), (5, "2"): ("Skatt", "d", [2]),
    }


def test_facts(spark):
    rows = [
        ("a", "Rad\t2024\t2023\nLønn\t100\t90"), ("b", "Rad\t2024\t2023\nLønn\t100\t-"), ("c", "Rad\t2024\t2023\nLønn\t-\t90"), ("d", "Aksjekapital\tAnnen innskutt\negenkapital\tegenkapital\tSum\nEK\t10\t20\t30"),
        ("e", "Bankinnskudd kr 2 910 050"), ("f", ""), ("g", None), ("h", "Rad\t2024\nDocuSign id\t5\nAB\t1\nAB\t2"),
    ]
    found = kv.facts(spark.createDataFrame(rows, "doc_id string, raw_text string"), keep=("doc_id",))
    got = {}
    for r in found.orderBy("doc_id", "line_idx", "pos").collect():
        got.setdefault(r.doc_id, []).append((r.label, r.col, r.value))
    assert got == {
        "a": [("Lønn", "2024", 100.0), ("Lønn", "2023", 90.0)], "c": [("Lønn -", "2024", 90.0)], "d": [("EK", "Aksjekapital egenkapital", 10.0), ("EK", "Annen innskutt egenkapital", 20.0), ("EK", "Sum", 30.0)],
        "e": [("Bankinnskudd kr", "", 2910050.0)], "h": [("AB", "2024", 1.0), ("AB", "2024", 2.0)],
    }
    assert {(r.doc_id, r.amount_key): r.value for r in kv.key_values(found, ("doc_id",)).collect()}[("h", "AB 2024")] == 2.0


def test_first_page(spark):
    text = "Organisasjonsnummer: 912 345 678\nForetaksnavn: Test AS\nOrganisasjonsform: Aksjeselskap\nÅrsregnskapets periode: 01.01.2023 - 31.12.2023\nJournalnummer: 2024 123456\nMorselskap i konsern: Ja\nRegler for små foretak benyttet: Nei\nFravalg av revisjon: Nei"
    r = metadata.first_page(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert (r[0].orgnr, r[0].foretaksnavn, r[0].organisasjonsform, r[0].regnskapsperiode_til, r[0].journalnr, r[0].morselskap, r[0].smaa_foretak) == ("912345678", "Test AS", "AS", "2023-12-31", "2024123456", True, False)
    assert (r[0].fravalg_revisjon, r[0].regnskapstype) == (True, "KONSERN")
    assert r[1].orgnr is None and r[1].regnskapstype == "SELSKAP"


def test_scan_fields(spark):
    text = "Sum egenkapital og gjeld\t1 000\nSum gjeld\t5\t12 000\t11 000\nÅrsresultat\t5\t13 000\nTotalresultat\n14 000\t15 000\nDriftsresultat 522 504 331 492 928 614"
    got = {r.canonical: r for r in scan.scan_fields(spark.createDataFrame([(1, 1, text), (2, 1, None)], "doc_id long, page_no int, text string")).collect()}
    assert (got["sum_gjeld"].value, got["sum_gjeld"].value_prev) == (12000.0, 11000.0)
    assert got["aarsresultat"].value is None and got["aarsresultat"].value_prev == 13000.0 and got["aarsresultat"].year_column_failed_ocr
    assert (got["totalresultat"].value, got["totalresultat"].value_prev, got["totalresultat"].wrapped) == (14000.0, 15000.0, True)
    assert (got["driftsresultat"].value, got["driftsresultat"].value_prev) == (522504331.0, 492928614.0)
    assert "sum_egenkapital" not in got
    group = scan.scan_group_fields(spark.createDataFrame([(1, 1, "Sum gjeld\t40 000\t30 000\t20 000\t10 000")], "doc_id long, page_no int, text string")).first()
    assert (group.value, group.value_prev, group.morselskap_value, group.morselskap_value_prev, group.layout) == (20000.0, 10000.0, 40000.0, 30000.0, "4col")


def test_pages(spark):
    dims = spark.createDataFrame([(1, 1, 1728, 10), (1, 2, 1728, 10), (1, 3, 1653, 2140), (1, 4, 1728, 10)], "doc_id long, page int, img_w int, img_h int")
    got = {r.page: r for r in pages.typed_pages(dims).collect()}
    assert got[1].brreg_last == 2 and got[4].nested_wrapper and not got[3].nested_wrapper and got[3].page_type == "revisjonsberetning" and got[2].page_type == "resultatregnskap"
    ink = [(1, 1, r, 200.0 if r < 20 or 70 <= r < 90 or 100 <= r < 105 else 255.0) for r in range(120)]
    blocks = sorted((r.y0, r.y1, r.n_lines) for r in pages.ink_blocks(spark.createDataFrame(ink, "doc_id long, page int, row int, mean double")).collect())
    assert blocks == [(0, 19, 0), (70, 119, 1)]


def test_fingerprints(spark):
    one = spark.createDataFrame([("ffff1c9fffffffff",), (None,)], "h string").select(fingerprint.from_hex(F.col("h")).alias("hash"))
    assert [r.platform for r in fingerprint.platform(one).collect()] == ["visma_finale_a", "no_image"]
    rows = spark.createDataFrame([(0x0, 1), (0x1F, 2), (0x3F, 3), (0x3F, 4)], "hash long, ord long")
    assert {r.hash: r.cluster for r in fingerprint.leader_clusters(rows, 5).collect()} == {0: 0, 0x1F: 0, 0x3F: 0x3F}
    assert fingerprint.leader_clusters(rows.limit(0)).count() == 0


def test_leader_clusters_equal_the_fold(spark):
    r = random.Random(3)
    centres = [r.getrandbits(64) for _ in range(6)]
    hashes = []
    for _ in range(400):
        h = r.choice(centres)
        for _ in range(r.randrange(9)):
            h ^= 1 << r.randrange(64)
        hashes.append(h - (1 << 64) if h >= 1 << 63 else h)
    leaders, want = [], {}
    for h in hashes:
        if h not in want:
            want[h] = next((x for x in leaders if bin((x ^ h) & (1 << 64) - 1).count("1") <= 5), h)
            if want[h] == h:
                leaders.append(h)
    df = spark.createDataFrame(list(enumerate(hashes)), "ord long, hash long").selectExpr("*", "1 as a", "2 as cluster")
    assert {x.hash: x.cluster for x in fingerprint.leader_clusters(df).collect()} == want


def test_perceptual_hash(spark):
    rng = np.random.default_rng(0)
    raster = rng.integers(0, 255, (32, 32)).astype(float)
    k, x = np.arange(32)[:, None], np.arange(32)[None, :]
    basis = 2 * np.cos(np.pi * k * (2 * x + 1) / 64)
    low = (basis @ raster @ basis.T)[:8, :8].ravel()
    bits = "".join("1" if v > np.median(low) else "0" for v in low)
    df = spark.createDataFrame([(1, [float(v) for v in raster.ravel()]), (2, [1.0]), (3, None)], "n int, v array<double>")
    got = {r.n: r.h for r in fingerprint.perceptual_hash(df, "v").select("n", fingerprint.to_hex(F.col("phash")).alias("h")).collect()}
    assert got == {1: f"{int(bits, 2):016x}", 2: None, 3: None}


def test_reconcile(spark):
    assert len(FIELDS) == 34 and field_spec(spark).where("layout = 'generell'").count() == 15
    rows = [("1009000", "1000000", "pct1", True), ("900", "0", "pct1", True), ("x", "1", "pct1", False), ("a ", "A", "str_match", True), ("1.0", "1", "exact", True), (None, "1", "exact", False), ("False", "false", "bool_match", True)]
    df = spark.createDataFrame(rows, "e string, a string, k string, ok boolean").withColumn("c", reconcile.compare(F.col("e"), F.col("a"), F.col("k")))
    assert all(r.c.ok == r.ok for r in df.collect())
    votes = [(1, "f", 0, 100000, 50000, 100000), (1, "f", 1, 100000, 50000, 100000), (1, "f", 2, 50000, 50000, 100000), (2, "f", 0, 100000, 50000, 100000), (2, "f", 1, 50000, 50000, 100000), (3, "f", 0, None, 50000, 100000)]
    got = {r.doc_id: (r.reconciled_value, r.diagnosis) for r in reconcile.vote(spark.createDataFrame(votes, "doc_id long, field string, strategy_ord int, value long, v1_value long, api_value long")).collect()}
    assert got == {1: (100000, "ocr_misread_corrected"), 2: (100000, "ambiguous_default_api"), 3: (None, "all_strategies_failed")}
    both = reconcile.validate(spark.createDataFrame([(1, "sum_gjeld", 5.0)], "doc_id long, field string, value double"), spark.createDataFrame([(1, "sum_eiendeler", 5.0)], "doc_id long, field string, value double"), field_spec(spark))
    assert {(r.field, r.missing, r.tolerance_ok) for r in both.collect()} == {("sum_gjeld", "api", None), ("sum_eiendeler", "extracted", False)}


def test_runs_and_sources(spark, tmp_path):
    files = spark.createDataFrame([("1", 2023, "aarsregnskap_2023_a.pdf"), ("1", 2023, "aarsregnskap_2023_b.pdf"), ("2", 2023, "aarsregnskap_2023.pdf"), ("2", 2023, "aarsregnskap_2023_z.pdf"), ("3", 2023, "x.pdf")], "orgnr string, year int, name string")
    assert {(r.orgnr, r.name) for r in runs.latest_file(files).collect()} == {("1", "aarsregnskap_2023_b.pdf"), ("2", "aarsregnskap_2023.pdf")}
    lines = spark.createDataFrame([("5\t1\t1\t1\t1\t1\t10\t20\t30\t40\t-1\tord",), ("4\t1\t1\t1\t1\t0\t1\t1\t1\t1\t-1\t",), ("5\tx\t1\t1\t1\t1\t1\t1\t1\t1\t5\ta",), ("",), (None,)], "value string")
    assert [(r.left, r.text) for r in io.decode_tsv(lines).collect()] == [(10, "ord")]
    io.write_csv([files, spark.createDataFrame([(1, [1, 2])], "zz int, extra array<int>")], str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).columns == ["extra", "name", "orgnr", "year", "zz"]
    io.write_records(files, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 5


def test_streaming_runner_resumes(spark, tmp_path):
    from fjordfacts.streaming import runner

    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.range(5).write.parquet(src)
    for _ in range(2):
        runner.run_available(runner.stream_table(spark, src, "id long"), lambda b: b, out, check, ["id"]).awaitTermination()
    spark.range(3, 8).write.mode("append").parquet(src)
    runner.run_available(runner.stream_table(spark, src, "id long"), lambda b: b, out, check, ["id"]).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(8))


def test_flows_take_whole_notes_and_all_disagreements(spark, tmp_path):
    from fjordfacts.plans import reference

    text = "Noten viser lønn. " * 25 + "\nBeløp i TNOK\n\t2020\t2019\nLønn\t1 200\t300"
    spark.createDataFrame([(1, "1", "Lønn", text)], "doc_id long, nr string, tittel string, raw_text string").write.parquet(f"{tmp_path}/noter.parquet")
    found = {r.amount for r in reference.k12_notes_flow(spark, str(tmp_path)).collect()}
    assert {1200000.0, 300000.0} <= found
    names = [r.canonical for r in field_spec(spark).where("tolerance = 'pct1'").limit(9).collect()]
    assert len(names) == 9
    spark.createDataFrame([(1, n, 1e6) for n in names], "doc_id long, canonical string, value double").write.parquet(f"{tmp_path}/field_hits.parquet")
    spark.createDataFrame([(1, n, "5000000") for n in names], "doc_id long, field string, api string").write.parquet(f"{tmp_path}/checks.parquet")
    assert [r.reconciled_value for r in reference.j10_corrections(spark, str(tmp_path)).collect()] == [5e6] * 9


def test_disagreements_are_the_first_in_field_order_then_those_with_values(spark):
    names = [f[1] for f in FIELDS if f[3] != "generell"]
    hits = spark.createDataFrame([(1, n, 1e6 if i % 2 else None, i, "L") for i, n in enumerate(names)], "doc_id long, canonical string, value double, page_idx int, label_matched string")
    api = spark.createDataFrame([(1, n, "5000000") for n in names] + [(2, names[0], "7")], "doc_id long, field string, value string")
    checks = reconcile.validate(hits.select("doc_id", F.col("canonical").alias("field"), "value"), api, field_spec(spark)).withColumn("first_label", F.lit("F"))
    assert [r.field for r in reconcile.disagreements(checks, hits).orderBy("field_ord").collect()] == names[1:6:2]
    everything = {(r.doc_id, r.field): (r.page_idx, r.label) for r in reconcile.disagreements(checks, hits, limit=None, missing=True).collect()}
    assert len(everything) == 20 and everything[(2, names[0])] == (1, "F") and everything[(1, names[2])] == (3, "L")


def test_report(spark):
    rows = lambda schema, *r: spark.createDataFrame(list(r), schema)
    text = runs.report(
        "Run", rows("status string, n long", ("ok", 3), ("no_pdf", 1)), rows("setup string, n long", ("smaa_selskap", 3)), rows("field string, n_pass long, n_fail long, n_missing long, pass_pct double", ("a", 3, 1, 0, 75.0)),
        rows("diagnosis string, n long, n_resolved long", ("ocr_misread_corrected", 2, 2)), rows("mean_elapsed double", (1.25,)), rows("doc_id long, field string", (1, "a")),
    )
    assert "| Pass rate | 75.0% |" in text and "Attempted 2, resolved 2" in text and "| a | 3 | 1 | 0 | 75 |" in text and "| Mean seconds | 1.2 |" in text and "## Suspects" in text
    table = runs.per_filing(rows("doc_id long, status string", (1, "ok"), (2, "no_pdf")), rows("doc_id long, n_pass int, disagreements array<string>", (1, 2, ["a", "b"])), rows("doc_id long, diagnosis string", (1, "ocr_misread_corrected")))
    assert {r.doc_id: (r.disagreements, r.n_corrections_resolved) for r in table.collect()} == {1: ("a,b", 1), 2: ("", None)}


def test_statement_flow_survives_empty_tables(spark):
    from fjordfacts.operators import flow

    dims = spark.createDataFrame([(1, 1, 1653, 10), (2, 1, 1728, 10)], "doc_id long, page int, img_w int, img_h int")
    texts = spark.createDataFrame([], "doc_id long, page_no int, text string")
    api = spark.createDataFrame([(2, "sum_gjeld", "5")], "doc_id long, field string, value string")
    got = {r.doc_id: (r.status, r.setup, r.n_missing_extract) for r in flow.statement_flow(dims, texts, api, field_spec(spark)).collect()}
    assert got == {1: ("skipped_legacy_format", None, None), 2: ("ok", "unknown", 1)}


def test_time_boxed_run_goes_on_where_it_stopped(spark, tmp_path):
    import time

    from fjordfacts.streaming import runner

    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(src)

    def slow(batch):
        time.sleep(4)
        return batch

    start = lambda f: runner.run_available(runner.stream_table(spark, src, "id long", files_per_trigger=1), f, out, check, ["id"])
    assert not runner.boxed(start(slow), 1.0)
    assert runner.boxed(start(lambda b: b), 120.0)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(30))


def test_status_counts_by_event_time(spark):
    from fjordfacts.streaming import runner

    rows = spark.createDataFrame([("2024-01-01 10:05:00", "ok"), ("2024-01-01 10:55:00", "ok"), ("2024-01-01 11:05:00", "error")], "ts string, status string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted((r.window.start.hour, r.status, r.n) for r in runner.windowed_status(rows).collect()) == [(10, "ok", 2), (11, "error", 1)]


def test_readers_and_recogniser(spark, tmp_path):
    import pyarrow as pa

    folder = tmp_path / "912345678"
    folder.mkdir()
    (folder / "aarsregnskap_2023.pdf").write_bytes(b"abc")
    (folder / "note.txt").write_bytes(b"x")
    r = io.read_binary(spark, str(tmp_path)).collect()
    assert [(x.orgnr, x.year, x.name, bytes(x.content), x.pdf_sha256_prefix) for x in r] == [("912345678", 2023, "aarsregnskap_2023.pdf", b"abc", "ba7816bf8f01cfea")]

    def backend(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.as_py().decode().upper() for c in b.column(2)])], names=["doc_id", "page_no", "text"])

    pages_ = spark.createDataFrame([(1, 1, bytearray(b"side en")), (1, 2, bytearray(b"side to"))], "doc_id long, page_no int, content binary")
    assert {r.page_no: r.text for r in io.recognise(pages_, backend).collect()} == {1: "SIDE EN", 2: "SIDE TO"}
    (tmp_path / "spec.txt").write_text("# kommentar\n912345678 2023 x\n\n1\n987654321  2022\n")
    assert {(r.orgnr, r.year) for r in io.read_spec(spark, str(tmp_path / "spec.txt")).collect()} == {("912345678", 2023), ("987654321", 2022)}
    (tmp_path / "rec").mkdir()
    (tmp_path / "rec" / "a.json").write_text('{\n"orgnr": "9",\n"year": 2023}')
    assert [tuple(r) for r in io.read_records(spark, str(tmp_path / "rec"), "orgnr string, year int").collect()] == [("9", 2023)]

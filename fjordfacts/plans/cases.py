"""Truth tables of the document operators: small inputs run through the operators, with the rows they must give as SQL.

The inputs are the odd cases that whole tables don't hold; what they must give was traced by hand. A
group of cases is one query; its SQL is the list of expected rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordfacts.functions import amounts
from fjordfacts.operators import fingerprint, kv, layout, metadata, notes, pages, reconcile, runs, scan
from fjordfacts.operators.schema import WORDS, by_layout, field, field_spec
from fjordfacts.sources import io

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _sql(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, list):
        return "[" + ", ".join(map(_sql, v)) + "]"
    if isinstance(v, str):
        return "E'" + v.replace("\\", "\\\\").replace("'", "''").replace("\n", "\\n").replace("\t", "\\t") + "'"
    return repr(v)


def cases(columns: str, expected: list[tuple]):  # noqa: ANN201
    """Registers a query whose SQL is these rows; `columns` lists names and DuckDB types."""
    names, types = zip(*(c.strip().split(" ", 1) for c in columns.split(",")), strict=True)

    def add(f: Callable[[SparkSession], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, d: f(spark)
        rows = ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in expected)
        ORACLE[f.__name__] = f"select {', '.join(f'cast({n} as {t}) as {n}' for n, t in zip(names, types, strict=True))} from (values {rows}) v({', '.join(names)})"
        return f

    return add


# ---- numbers ----

_B1 = [
    ("1234", 1234.0), ("145,65", 145.65), ("1 234 567", 1234567.0), ("1\u00a0234\u00a0567", 1234567.0), ("1 234,56", 1234.56), ("145.650", 145650.0), ("1.234.567", 1234567.0), ("1,234.56", 1234.56), ("1,234,567", 1234567.0),
    ("(1 234)", -1234.0), ("(1 234,56)", -1234.56), ("-1234", -1234.0), ("-1 234,56", -1234.56), ("-", None), ("—", None), ("", None), ("N/A", None), ("   ", None), ("1 234 kr", 1234.0), ("1 234,56 NOK", 1234.56), ("3,9 %", 3.9), (None, None),
    ("1.234", 1234.0), ("1.23", 1.23), ("0", 0.0), ("0,00", 0.0), ("foo bar", None), ("1 234 kr 56", None), ("+1234", 1234.0), ("1,234", 1.234), ("0.500", 500.0), ("1234.567", 1234.567), ("123.456", 123456.0), ("1 234.567", None), ("1.234,56", 1234.56),
    ("12 34", None), ("1016 792 573", 1016792573.0), ("- 1234", None), ("1234-", None), ("(1234", 1234.0), ("1234)", 1234.0), ("-1234)", -1234.0), ("\u22121234", None), ("NOK100", None), ("kr. 100", 100.0), ("5 tkr", None), ("5 MNOK", 5.0), ("I", 1.0), ("lO", 10.0), ("l23 O00", 123000.0), (" 7 ", 7.0), ("kr 5", 5.0), (".", None), ("-:", None),
]


@cases("n INTEGER, value DOUBLE, scaled DOUBLE", [(i, v, None if v is None else v * 1000) for i, (_, v) in enumerate(_B1)])
def b1_cases(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_B1)], "n int, t string")
    return df.select("n", amounts.normalize_amount(F.col("t")).alias("value"), amounts.normalize_amount(F.col("t"), 1000.0).alias("scaled"))


_B3 = [("1", True), ("1.234", True), ("1.234.567", True), ("1234.567", False), ("1.23", False), ("12.3456", False), ("0.500", True)]


@cases("n INTEGER, grouped BOOLEAN", [(i, v) for i, (_, v) in enumerate(_B3)])
def b3_cases(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_B3)], "n int, t string")
    return df.select("n", amounts.thousands_by_dots(F.col("t")).alias("grouped"))


_B4 = [("Beløp i 1000 NOK", 1e3), ("Tall i hele tusen", 1e3), ("Note 5 - Driftsinntekter (tNOK)", 1e3), ("Note 5 (MNOK)", 1e6), ("Tall i millioner kr", 1e6), ("Note 4 Pensjonskostnader", 1.0), ("", 1.0), (None, 1.0), ("tap på 2 millioner og 1 tusen", 1e6), ("i 1000 kroner", 1.0), ("beløp i 1000 kroner", 1e3), ("i 1.000 kr", 1e3), ("i 1 000 nok", 1e3), ("i tusen", 1e3), ("tusen", 1.0)]


@cases("n INTEGER, scale DOUBLE", [(i, v) for i, (_, v) in enumerate(_B4)])
def b4_cases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_B4)], "n int, t string").select("n", amounts.detect_scale(F.col("t")).alias("scale"))


@cases("n INTEGER, pos INTEGER, start INTEGER, value DOUBLE", [(0, 0, 7, 31.0), (0, 1, 10, 12202.0), (0, 2, 16, 4449542025.0), (1, 0, 4, 7.0), (1, 1, 9, -1234.5), (2, 0, 0, 5.0), (4, 0, 5, 12.0), (4, 1, 8, 3.5)])
def b5_cases(spark: SparkSession) -> DataFrame:
    rows = ["EK pr. 31.12.2024 449 542 025", "Lån 7 og (1 234,5) til", "5", "ingen", "Sum  12 3,5", None]
    df = spark.createDataFrame(list(enumerate(rows)), "n int, t string")
    return df.select("n", F.posexplode(amounts.find_amounts(F.col("t"))).alias("pos", "a")).select("n", "pos", "a.start", "a.value")


@cases("n INTEGER, first DOUBLE, second DOUBLE", [(0, 522504331.0, 492928614.0), (1, 12.0, None), (2, 1.0, 1.0), (3, 0.0, 0.0), (4, 100.0, 100.0), (5, None, None), (6, 1234.0, 5678.0)])
def b6_cases(spark: SparkSession) -> DataFrame:
    rows = ["522 504 331 492 928 614", "12", "1 1", "0 0", "100 100", "abc", "1 234 5 678"]
    return spark.createDataFrame(list(enumerate(rows)), "n int, t string").select("n", amounts.two_number_split(F.col("t")).alias("s")).select("n", "s.first", "s.second")


# ---- sources and layout ----


@cases("n INTEGER, word_left INTEGER, text VARCHAR", [(0, 10, "ord"), (4, 10, "sier \"ja\""), (5, 10, "åpen"), (6, 10, "a\u00a0b"), (7, 10, "x")])
def a6_cases(spark: SparkSession) -> DataFrame:
    box = "5\t1\t1\t1\t1\t1\t10\t20\t30\t40\t-1\t"
    rows = [box + "ord", box.replace("5\t1", "4\t1", 1) + "x", box.replace("\t20\t", "\tz\t") + "x", box + " ", box + '"sier ""ja"""', box + '"åpen', box + "\u00a0a\u00a0b ", box + "x", "", None]
    df = spark.createDataFrame(list(enumerate(rows)), "n int, value string")
    return io.decode_tsv(df, keep=("n",)).select("n", F.col("left").alias("word_left"), "text")


@cases("n INTEGER, pages INTEGER", [(0, 46), (1, 0), (2, 0), (3, 0)])
def a3_cases(spark: SparkSession) -> DataFrame:
    rows = ["Title: x\nPages:          46\nFile size: 1", "Title: x", "", None]
    return spark.createDataFrame(list(enumerate(rows)), "n int, info string").select("n", io.page_count(F.col("info")).alias("pages"))


def _word(doc: int, block: int, line: int, i: int, left: int, top: int, text: str, width: int = 10) -> tuple:
    return (doc, 1, block, 1, line, i, left, top, width, 5, 0.9, text)


_C = [
    # gaps 10, 10, 100: a tab before the fourth word
    _word(1, 1, 1, 0, 0, 5, "a"), _word(1, 1, 1, 1, 20, 5, "b"), _word(1, 1, 1, 2, 40, 5, "c"), _word(1, 1, 1, 3, 150, 5, "d"),
    # gaps 10, 40: the upper median is 40, so no tab
    _word(2, 1, 1, 0, 0, 5, "a"), _word(2, 1, 1, 1, 20, 5, "b"), _word(2, 1, 1, 2, 70, 5, "c"),
    # lines stand by their least top, whatever their numbers; equal tops by number; words by their left edge
    _word(3, 1, 1, 0, 0, 90, "sist"), _word(3, 2, 1, 1, 30, 12, "ord"), _word(3, 2, 1, 0, 0, 10, "Blåbær"), _word(3, 3, 2, 0, 0, 50, "b"), _word(3, 3, 1, 0, 0, 50, "æ"), _word(3, 3, 1, 1, 500, 50, " "),
    # overlapping boxes have no gap; the upper of two gaps never makes a tab
    _word(4, 1, 1, 0, 0, 5, "x", 100), _word(4, 1, 1, 1, 50, 5, "y", 100), _word(4, 1, 1, 2, 181, 5, "z"),
]


@cases("doc_id BIGINT, text VARCHAR", [(1, "a b c\td"), (2, "a b c"), (3, "Blåbær ord\næ\nb\nsist"), (4, "x y z")])
def c1_cases(spark: SparkSession) -> DataFrame:
    return layout.page_text(spark.createDataFrame(_C, WORDS)).select("doc_id", "text")


# ---- notes and tables ----


@cases("doc_id BIGINT, nr VARCHAR, tittel VARCHAR, raw_text VARCHAR, page_refs INTEGER[]", [
    (1, "3", "Lønn", "tekst", [1]), (2, "1", "Note 2", "", [1]), (2, "2", "Tittel", "x", [1]), (3, "2024", "2023", "foo", [1]), (4, "3", "A", "body1\nNote 3 A\nbody2", [1]),
    (5, "1", "Lønn", "a\nb\nc", [1, 2]), (5, "2", "Skatt", "d", [2]), (8, "1a", "Varer", "x", [1]), (8, "1A", "Lager", "y\n\nz", [1, 2, 3]), (9, "4", "Årets", "æ", [1]),
])
def d1_cases(spark: SparkSession) -> DataFrame:
    rows = [
        (1, 1, "x\nNote 3\nLønn\ntekst"), (2, 1, "Note 1\nNote 2\nTittel\nx"), (3, 1, "Note\t2024\t2023\nfoo"), (4, 1, "Note 3 A\nbody1\nNote 3 A\nbody2"), (5, 1, "intro\nNote 1: Lønn\na\nb"), (5, 2, "c\nNote 2 - Skatt\nd"), (6, 1, None), (7, 1, ""),
        (8, 1, "NOTE 1a. Varer\nx\nnote 1A - Lager\ny"), (8, 2, None), (8, 3, "z"), (9, 1, "  Note 4\u00a0Årets\næ"),
    ]
    return notes.segment(spark.createDataFrame(rows, "doc_id long, page_no int, text string"))


@cases("doc_id BIGINT, scale DOUBLE, amount DOUBLE, note_type VARCHAR, has_table BOOLEAN", [(1, 1000.0, 5000.0, "table", True), (2, 1.0, None, "narrative", False), (3, 1.0, 5.0, "table", True), (4, 1e6, 5e6, "table", True)])
def d7_cases(spark: SparkSession) -> DataFrame:
    rows = [(1, "Beløp i TNOK\nA\t5", {"A": 5.0}), (2, "bare tekst", {}), (3, "x" * 300 + " TNOK", {"A": 5.0}), (4, "tap på 2 millioner", {"A": 5.0})]
    out = notes.enrich(spark.createDataFrame(rows, "doc_id long, raw_text string, raw_amounts map<string,double>"))
    return out.select("doc_id", F.col("scale_inferred").alias("scale"), F.try_element_at("raw_amounts", F.lit("A")).alias("amount"), "note_type", "has_table")


_E = [
    ("Rad\t2024\t2023\nLønn\t100\t90", [(1, "Lønn", "2024", 100.0), (1, "Lønn", "2023", 90.0)]), ("Rad\t2024\t2023\nLønn\t100\t-", []), ("Rad\t2024\t2023\nLønn\t-\t90", [(1, "Lønn -", "2024", 90.0)]),
    ("Aksjekapital\tAnnen innskutt\negenkapital\tegenkapital\tSum\nEK\t10\t20\t30", [(2, "EK", "Aksjekapital egenkapital", 10.0), (2, "EK", "Annen innskutt egenkapital", 20.0), (2, "EK", "Sum", 30.0)]),
    ("Bankinnskudd kr 2 910 050", [(0, "Bankinnskudd kr", "", 2910050.0)]), ("", []), (None, []), ("Rad\t2024\nDocuSign id\t5\nAB\t1\nAB\t2", [(2, "AB", "2024", 1.0), (3, "AB", "2024", 2.0)]),
    # years without tabs are a header; a row without tabs is read by its amounts
    ("Tall for 2021 2020\nVarer 1 200 300,5", [(1, "Varer", "2021", 1200300.5)]),
    # a line before the first header is passed over; a digit label gives no row; surplus values are dropped
    ("Varer\t5\nRad\t2024\n12\t7\nHus\t1\t2", [(3, "Hus", "2024", 1.0)]),
    # the last header above a line counts; a sentence with a year and another long number is none, nor a row under a label of one letter
    ("Rad\t2024\nA1\t1\nRad\t2010\nBB\t2\nI 2019 kom 12345 inn", [(1, "A1", "2024", 1.0), (3, "BB", "2010", 2.0)]),
    ("Note x\n5 tapt\nTo 3 og 4", [(2, "To", "", 3.0)]),
]


@cases("n INTEGER, line_idx INTEGER, label VARCHAR, col VARCHAR, value DOUBLE", [(i, *r) for i, (_, rows) in enumerate(_E) for r in rows])
def e1_cases(spark: SparkSession) -> DataFrame:
    return kv.facts(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_E)], "n int, raw_text string"), keep=("n",)).select("n", "line_idx", "label", "col", "value")


@cases("n INTEGER, amount_key VARCHAR, value DOUBLE", [(0, "Lønn 2024", 100.0), (0, "Lønn 2023", 90.0), (1, "AB 2024", 2.0), (2, "Bankinnskudd kr", 2910050.0)])
def e10_cases(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(list(enumerate([_E[0][0], _E[7][0], _E[4][0]])), "n int, raw_text string")
    return kv.key_values(kv.facts(df, keep=("n",)), keep=("n",))


@cases("n INTEGER, label BOOLEAN", [(0, True), (1, False), (2, False), (3, False), (4, True), (5, False), (6, True)])
def e5_cases(spark: SparkSession) -> DataFrame:
    rows = ["Lønn", "x", "12 000", "ab12345", "Note 5 lønn", "y" * 61, "y" * 60]
    return spark.createDataFrame(list(enumerate(rows)), "n int, t string").select("n", kv.is_label(F.col("t")).alias("label"))


# ---- first page ----

_PAGE = "Organisasjonsnummer: 912 345 678\nForetaksnavn: Test AS\nOrganisasjonsform: Aksjeselskap\nÅrsregnskapets periode: 01.01.2023 – 31.12.2023\nJournalnummer: 2024 123456\nMorselskap i konsern: Ja\nRegler for små foretak benyttet: Nei\nFravalg av revisjon: Nei\nDato for fastsettelse av årsregnskapet 30.06.2024"
_F1 = ("orgnr", "foretaksnavn", "organisasjonsform", "regnskapsperiode_fra", "regnskapsperiode_til", "journalnr", "morselskap", "smaa_foretak", "regnskapsregler", "dato_fastsettelse", "avviklingsregnskap", "ikke_revidert", "fravalg_revisjon", "regnskapstype")


@cases("doc_id BIGINT, orgnr VARCHAR, foretaksnavn VARCHAR, organisasjonsform VARCHAR, regnskapsperiode_fra VARCHAR, regnskapsperiode_til VARCHAR, journalnr VARCHAR, morselskap BOOLEAN, smaa_foretak BOOLEAN, regnskapsregler VARCHAR, dato_fastsettelse VARCHAR, avviklingsregnskap BOOLEAN, ikke_revidert BOOLEAN, fravalg_revisjon BOOLEAN, regnskapstype VARCHAR", [
    (1, "912345678", "Test AS", "AS", "2023-01-01", "2023-12-31", "2024123456", True, False, "regnskapslovenAlminneligRegler", "2024-06-30", False, False, True, "KONSERN"),
    (2, None, None, None, None, None, None, None, None, "regnskapslovenAlminneligRegler", None, False, False, False, "SELSKAP"),
    (3, None, "Blåbær ANS", "ANS", "2022-02-31", "2022-12-31", None, False, True, "regnskapslovenSmaaForetak", None, True, True, True, "SELSKAP"),
    (4, None, None, "KOMMUNE", None, None, None, None, None, "regnskapslovenAlminneligRegler", None, False, False, True, "KONSERN"),
])
def f1_cases(spark: SparkSession) -> DataFrame:
    rows = [
        (1, _PAGE), (2, None),
        # a label without a value passes on to its next line; dates aren't asked of the calendar; a flag is set even where it says no
        (3, "Foretaksnavn\nforetaksnavn Blåbær ANS\nOrganisasjonsform: Ansvarlig selskap\nÅrsregnskapets periode: 31.02.2022-31.12.2022\nMorselskap: nei.\nSmaa foretak: ja\nAvviklingsregnskap: Nei\nIkke-revidert\nrevisjon er fravalgt"),
        # an empty value after a colon ends the search
        (4, "Foretaksnavn:\nForetaksnavn: Sent AS\nOrganisasjonsform: Kommune\nkonsernregnskap etter alminnelige regler\nskal ikke revideres: ja"),
    ]
    return metadata.first_page(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", *_F1)


@cases("layout VARCHAR, n BIGINT, first VARCHAR, api_path VARCHAR", [("generell", 15, "orgnr", "virksomhet.organisasjonsnummer"), ("resultat", 9, "sum_driftsinntekter", "resultatregnskapResultat.driftsresultat.driftsinntekter.sumDriftsinntekter"), ("balanse", 10, "sum_anleggsmidler", "eiendeler.anleggsmidler.sumAnleggsmidler")])
def f9_cases(spark: SparkSession) -> DataFrame:
    spec, out = field_spec(spark), None
    for name in ("generell", "resultat", "balanse"):
        own = by_layout(spec, name).agg(F.lit(name).alias("layout"), F.count(F.lit(1)).alias("n"), F.min_by("canonical", "ord").alias("first"))
        out = own if out is None else out.unionByName(own)
    named = field(spec, "orgnr").unionByName(field(spec, "sum_driftsinntekter")).unionByName(field(spec, "sum_anleggsmidler")).unionByName(field(spec, "finnes_ikke"))
    return out.join(named.select(F.col("canonical").alias("first"), "api_path"), "first")


@cases("doc_id BIGINT, orgnr VARCHAR, smaa_foretak VARCHAR, sum_innskutt_egenkapital VARCHAR, aarsresultat VARCHAR, journalnr VARCHAR", [(1, "9", "true", "5", "-7", None), (2, None, None, None, None, None), (3, None, None, None, None, None), (4, None, None, None, None, None)])
def f7_cases(spark: SparkSession) -> DataFrame:
    rows = [(1, '{"virksomhet": {"organisasjonsnummer": "9"}, "regnkapsprinsipper": {"smaaForetak": true}, "egenkapitalGjeld": {"egenkapital": {"innskuttEgenkapital": {"sumInnskuttEgenkaptial": 5}}}, "resultatregnskapResultat": {"aarsresultat": -7}, "journalnr": null}'), (2, "{bad"), (3, None), (4, '{"virksomhet": null, "resultatregnskapResultat": 5}')]
    return metadata.flatten_api(spark.createDataFrame(rows, "doc_id long, json string")).select("doc_id", "orgnr", "smaa_foretak", "sum_innskutt_egenkapital", "aarsresultat", "journalnr")


# ---- statement scan ----

_G = "Sum egenkapital og gjeld\t1 000\nSum gjeld\t5\t12 000\t11 000\nÅrsresultat\t5\t13 000\nTotalresultat\n14 000\t15 000\nDriftsresultat 522 504 331 492 928 614\nSum inntekter\t7 000\n\t6 500\nSUM EIENDELER:\t-1 000\t(2 000)\n  sum  finansinntekter\t9 000\t8 000"


@cases("canonical VARCHAR, value DOUBLE, value_prev DOUBLE, page_idx INTEGER, line_idx INTEGER, raw_line VARCHAR, label_matched VARCHAR, n_numbers INTEGER, lost BOOLEAN, wrapped BOOLEAN, wrapped_value BOOLEAN", [
    ("sum_gjeld", 12000.0, 11000.0, 0, 1, "Sum gjeld\t5\t12 000\t11 000", "Sum gjeld", 2, False, False, False), ("aarsresultat", None, 13000.0, 0, 2, "Årsresultat\t5\t13 000", "Årsresultat", 1, True, False, False),
    ("totalresultat", 14000.0, 15000.0, 0, 3, "Totalresultat | 14 000\t15 000", "Totalresultat", 2, False, True, False), ("driftsresultat", 522504331.0, 492928614.0, 0, 5, "Driftsresultat 522 504 331 492 928 614", "Driftsresultat", 2, False, False, False),
    ("sum_driftsinntekter", 7000.0, 6500.0, 0, 6, "Sum inntekter\t7 000 | \t6 500", "Sum inntekter", 2, False, False, True), ("sum_eiendeler", -1000.0, -2000.0, 0, 8, "SUM EIENDELER:\t-1 000\t(2 000)", "Sum eiendeler", 2, False, False, False),
    ("sum_egenkapital", 4000.0, 3000.0, 1, 0, "Sum egenkapital\t4 000\t3 000", "Sum egenkapital", 2, False, False, False),
])
def g3_cases(spark: SparkSession) -> DataFrame:
    out = scan.scan_fields(spark.createDataFrame([(1, 1, _G), (1, 2, "Sum egenkapital\t4 000\t3 000\nSum gjeld\t1 111\t2 222"), (2, 1, None), (3, 1, "")], "doc_id long, page_no int, text string"))
    return out.drop("doc_id").withColumnRenamed("year_column_failed_ocr", "lost")


@cases("n INTEGER, hit BOOLEAN", [(0, False), (1, True), (2, True), (3, True), (4, True), (5, True), (6, False), (7, True), (8, True), (9, False)])
def g1_cases(spark: SparkSession) -> DataFrame:
    rows = ["Sum egenkapital og gjeld\t1", "Sum egenkapital\t1", "  SUM EGENKAPITAL: 1", "Sum egenkapital", "Sum egenkapital 12", "Sum egenkapital  -5", "Sum egenkapitaler", "Sum egenkapital.", "Sum egenkapital ", "x Sum egenkapital"]
    return spark.createDataFrame(list(enumerate(rows)), "n int, t string").select("n", scan.anchored(F.col("t"), F.lit("Sum egenkapital")).alias("hit"))


@cases("doc_id BIGINT, canonical VARCHAR, value DOUBLE, value_prev DOUBLE, morselskap_value DOUBLE, morselskap_value_prev DOUBLE, n_numbers INTEGER, layout VARCHAR", [
    (1, "sum_gjeld", 20000.0, 10000.0, 40000.0, 30000.0, 4, "4col"), (2, "sum_gjeld", 11000.0, -12000.0, None, None, 2, "2col_fallback"), (3, "aarsresultat", 22000.0, 23000.0, None, None, 3, "2col_fallback"),
])
def g6_cases(spark: SparkSession) -> DataFrame:
    rows = [(1, 1, "Sum gjeld\t40 000\t30 000\t20 000\t10 000"), (2, 1, "Sum gjeld\t5\t9 999\t11 000\t-12 000"), (3, 1, "Årsresultat\t12 000\nÅrsresultat\t21 000\t22 000\t23 000"), (4, 1, "Sum gjeld 40 000 30 000")]
    out = scan.scan_group_fields(spark.createDataFrame(rows, "doc_id long, page_no int, text string"))
    return out.select("doc_id", "canonical", "value", "value_prev", "morselskap_value", "morselskap_value_prev", "n_numbers", "layout")


# ---- pages ----


@cases("page INTEGER, y0 INTEGER, y1 INTEGER, label VARCHAR, height INTEGER, n_col_gaps BIGINT, n_lines BIGINT", [(1, 0, 19, "title", 19, 0, 0), (1, 80, 119, "title", 39, 0, 0), (2, 5, 98, "table", 93, 2, 2), (3, 0, 60, "table", 60, 1, 0), (4, 0, 60, "text", 60, 1, 0)])
def h6_cases(spark: SparkSession) -> DataFrame:
    ink = {1: lambda r: r < 20 or 80 <= r < 105, 2: lambda r: 5 <= r < 30 or 65 <= r < 99, 3: lambda r: r <= 60, 4: lambda r: r <= 60}
    # page 1 ends within its second block, which goes on to its last row; page 2 has a line that begins in the middle; grey rows are ink but no lines
    grey = {(2, 5)}
    height = {1: 120, 2: 200, 3: 150, 4: 150}
    rows = [(1, p, r, (242.0 if (p, r) in grey else 200.0) if ink[p](r) else 255.0) for p in ink for r in range(height[p])]
    white = {(2, 5): [(20, 60), (70, 120), (180, 199)], (3, 0): [(40, 145)], (4, 0): [(40, 100), (150, 189)]}
    columns = [(1, p, y, c, 200, 255.0 if any(a <= c < b for a, b in gaps) else 100.0) for (p, y), gaps in white.items() for c in range(200)]
    out = pages.page_zones(spark.createDataFrame(rows, "doc_id long, page int, row int, mean double"), spark.createDataFrame(columns, "doc_id long, page int, y0 int, col int, width int, mean double"))
    return out.drop("doc_id")


@cases("doc_id BIGINT, n_brreg INTEGER, n_company INTEGER, total_pages INTEGER, nested INTEGER[], platform VARCHAR, method VARCHAR, detected BOOLEAN, types VARCHAR, tables VARCHAR, heights VARCHAR", [
    (1, 2, 3, 5, [5], "visma_finale_a", "footer_avg_hash_hamming5", False, "generell_info,resultatregnskap,-,revisjonsberetning,-", "false,true,true,false,false", '{"10":[3,5],"2140":[4]}'),
    (2, 1, 0, 1, [], "brreg_only", "structural", False, "generell_info", "false", None), (3, 0, 1, 1, [], "single_page_company", "structural", False, "-", "false", '{"10":[1]}'),
    (4, 10, 6, 16, [], "unknown_00000000ffffffff", "footer_avg_hash_hamming5", True, "generell_info,resultatregnskap,balanse,balanse,balanse,noter,noter,noter,noter,noter,-,-,-,-,-,-", "false,true,true,true,true,true,true,true,true,true,false,false,false,false,false,false", '{"10":[11,12,13,14,15,16]}'),
    (5, 0, 0, 0, None, "brreg_only", "structural", False, None, None, None), (6, 0, 2, 2, [2], "no_image", "structural", False, "-,-", "false,false", '{"10":[1,2]}'),
])
def h1_cases(spark: SparkSession) -> DataFrame:
    width = {1: [1728, 1728, 1653, 1653, 1728], 2: [1728], 3: [1653], 4: [1728] * 10 + [1653] * 6, 6: [1653, 1728]}
    dims = [(d, i + 1, w, 2140 if (d, i) == (1, 3) else 10) for d, ws in width.items() for i, w in enumerate(ws)]
    # registry pages with many gaps are no sign of group accounts, five company pages are
    zones = [(1, 3, 0, 20, "table", 20, 2, 1), (1, 3, 60, 80, "text", 20, 0, 1), (1, 4, 0, 20, "table", 20, 3, 1), *((4, p, 0, 20, "text", 20, 4 if p != 16 else 1, 0) for p in range(1, 17))]
    hashes = [(1, 4, "ffff1c9fffffffff"), (4, 12, "00000000ffffffff")]
    made = pages.manifest(
        spark.createDataFrame([(d, "9", 2024, bytearray(b"x")) for d in range(1, 7)], "doc_id long, orgnr string, year int, content binary"), spark.createDataFrame(dims, "doc_id long, page int, img_w int, img_h int"),
        spark.createDataFrame(zones, "doc_id long, page int, y0 int, y1 int, label string, height int, n_col_gaps int, n_lines int"), spark.createDataFrame(hashes, "doc_id long, page int, h string").select("doc_id", "page", fingerprint.from_hex(F.col("h")).alias("hash")),
    )
    text = lambda f: F.array_join(F.transform("pages", f), ",")
    return made.select("doc_id", "split.n_brreg", "split.n_company", "document.total_pages", F.col("split.nested_wrapper_pages").alias("nested"), F.col("platform.id").alias("platform"), F.col("platform.detection_method").alias("method"), "konsern.detected", text(lambda p: F.coalesce(p["type"], F.lit("-"))).alias("types"), text(lambda p: p["has_table"].cast("string")).alias("tables"), F.to_json("company_height_groups").alias("heights"))


# ---- fingerprints ----


@cases("n INTEGER, leverandor VARCHAR, confidence VARCHAR, match_type VARCHAR", [(0, "visma_finale", "high", "footer_regex"), (1, "fiken_tripletex", "high", "header_regex"), (2, "poweroffice", "high", "footer_regex"), (3, "conta", "medium", "footer_regex"), (4, "24sevenoffice", "medium", "footer_regex"), (5, "unknown", "none", "none"), (6, "visma_finale", "high", "footer_regex"), (7, "unknown", "none", "none")])
def i5_cases(spark: SparkSession) -> DataFrame:
    rows = [("", "SIDE 12"), ("noter 2023 \nx", "conta.no"), ("", "Powered by PowerOffice"), ("", "Conta AS"), ("", "24seven"), ("Noter 2023", "side x"), ("Noter 2023\n", "side 3 conta.no"), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, h string, f string")
    return df.select("n", fingerprint.supplier(F.col("h"), F.col("f")).alias("s")).select("n", "s.*")


@cases("hash BIGINT, cluster BIGINT", [(0x0, 0x0), (0x1F, 0x0), (0x3F, 0x3F), (0x7F, 0x3F), (-1, -1), (-8, -1), (0x7FFF, 0x7FFF), (0x3FF, 0x3F)])
def i8_cases(spark: SparkSession) -> DataFrame:
    # 0x3F is six bits from the first leader; 0x7F, 0x3FF follow it; 0x7FFF is nine bits from it
    rows = [(0x0, 1), (0x1F, 2), (0x3F, 3), (0x3F, 4), (0x7F, 5), (-1, 6), (-8, 7), (0x3FF, 8), (0x7FFF, 9), (None, 10)]
    return fingerprint.leader_clusters(spark.createDataFrame(rows, "hash long, ord long"))


@cases("doc_id BIGINT, n_pages BIGINT, boundary INTEGER, leverandor VARCHAR, confidence VARCHAR, match_type VARCHAR, sampled VARCHAR", [
    (1, 12, 2, "conta", "medium", "footer_regex", "0:brreg:generell_info,1:brreg:resultatregnskap,2:company:,3:company:,4:company:,5:company:,6:company:"),
    (2, 2, None, "unknown", "none", None, "0:brreg:generell_info,1:brreg:resultatregnskap"), (3, 0, None, "error", "none", None, ""), (4, 1, 0, "visma_finale", "high", "footer_regex", "0:company:"),
])
def i7_cases(spark: SparkSession) -> DataFrame:
    rows = [(1, i, 1728 if i < 2 else 1653, 10, "", "www.conta.no" if i == 3 else "Side 1", None) for i in range(12)]
    rows += [(2, 0, 1728, 10, "", "", None), (2, 1, 1728, 10, "", "", None), (3, 0, 1653, 10, None, None, None), (3, 1, 1653, 10, None, None, "unreadable"), (4, 0, 1653, 10, "", "Side 9", None)]
    out = fingerprint.fingerprint_files(spark.createDataFrame(rows, "doc_id long, page_idx int, width int, height int, header_text string, footer_text string, error string"))
    page = lambda p: F.concat_ws(":", p["page_idx"].cast("string"), p["source"], F.coalesce(p["page_type"], F.lit("")))
    return out.select("doc_id", "n_pages", "boundary", "leverandor", "confidence", "match_type", F.array_join(F.transform("pages", page), ",").alias("sampled"))


@cases("n INTEGER, ahash VARCHAR, dhash VARCHAR", [(0, "ffffffff00000000", "0000000000000000"), (1, "5555555555555555", f"{int('1010101' * 8, 2):016x}"), (2, None, None)])
def i6_cases(spark: SparkSession) -> DataFrame:
    rows = [(0, [9] * 32 + [1] * 32), (1, [0, 9] * 32), (2, [])]
    df = spark.createDataFrame(rows, "n int, footer array<int>").withColumn("header", F.col("footer"))
    return fingerprint.fingerprint_pages(df).select("n", F.col("ahash_footer").alias("ahash"), F.col("dhash_footer").alias("dhash"))


@cases("zone VARCHAR, rows INTEGER[]", [("header", [0, 1, 2]), ("footer", [17, 18, 19])])
def i1_cases(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame([(list(range(20)),)], "r array<int>")
    return df.select(F.lit("header").alias("zone"), fingerprint.crop(F.col("r"), "header").alias("rows")).unionByName(df.select(F.lit("footer").alias("zone"), fingerprint.crop(F.col("r"), "footer").alias("rows")))


# ---- reconciliation ----


@cases("n INTEGER, ok BOOLEAN, diff DOUBLE", [(0, True, 9000.0), (1, True, 900.0), (2, False, None), (3, True, 0.0), (4, True, 0.0), (5, False, None), (6, True, 0.0), (7, False, 20000.0), (8, False, 1.0), (9, False, None)])
def j1_cases(spark: SparkSession) -> DataFrame:
    rows = [("1009000", "1000000", "pct1"), ("900", "0", "pct1"), ("x", "1", "pct1"), ("a ", "A", "str_match"), ("1.0", "1", "exact"), (None, "1", "exact"), ("true", "true", "bool_match"), ("1020000", "1000000", "pct1"), ("2", "1", "exact"), ("1", "1", "other")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, e string, a string, k string")
    return df.select("n", reconcile.compare(F.col("e"), F.col("a"), F.col("k")).alias("c")).select("n", "c.*")


_LABELS = "doc_id long, page_no int, field string, label string"


def _line(doc: int, line: int, words: list[tuple[int, str]], width: int = 40) -> list[tuple]:
    return [(doc, 1, 1, 1, line, i, left, 100 * line, width, 10, 0.9, t) for i, (left, t) in enumerate(words)]


_J = [
    # a reference, a value and last year's
    *_line(1, 1, [(0, "Sum"), (50, "gjeld"), (300, "5"), (500, "12"), (545, "000"), (800, "11"), (845, "000")]), *_line(1, 2, [(0, "Andre"), (50, "gjeld"), (300, "77")]),
    # one number; a run of letters with an l in it is no number
    *_line(2, 1, [(0, "Årsresultat"), (300, "helt"), (600, "13"), (645, "000")]),
    # the label is there, but no number on the first line
    *_line(3, 1, [(0, "Sum"), (50, "gjeld")]), *_line(3, 2, [(0, "Sum"), (50, "gjeld"), (500, "(900)"), (700, "800")]),
    # the label only after the first six words
    *_line(4, 1, [(50 * i, "x") for i in range(6)] + [(400, "Sum"), (450, "gjeld"), (600, "5000")]),
]
_ASKED = [(1, 1, "sum_gjeld", "Sum gjeld"), (2, 1, "aarsresultat", "Årsresultat"), (3, 1, "sum_gjeld", "Sum gjeld"), (4, 1, "sum_gjeld", "Sum gjeld")]


@cases("doc_id BIGINT, field VARCHAR, value BIGINT, confidence VARCHAR", [(1, "sum_gjeld", 12000, "high"), (2, "aarsresultat", 13000, "med"), (3, "sum_gjeld", -900, "high")])
def j9_cases(spark: SparkSession) -> DataFrame:
    return reconcile.walked_values(spark.createDataFrame(_J, WORDS), spark.createDataFrame(_ASKED, _LABELS)).drop("page_no")


@cases("doc_id BIGINT, field VARCHAR, x0 INTEGER, y0 INTEGER, x1 INTEGER, y1 INTEGER", [(1, "sum_gjeld", 495, 95, 595, 120), (2, "aarsresultat", 595, 95, 650, 120)])
def j8_cases(spark: SparkSession) -> DataFrame:
    # the reference is too far off to be part of the value, so it would be the value: leave it out of this line
    words = [w for w in _J if w[11] != "5"]
    return reconcile.value_boxes(spark.createDataFrame(words, WORDS), spark.createDataFrame(_ASKED[:2], _LABELS)).drop("page_no")


@cases("n INTEGER, field VARCHAR, value BIGINT, raw VARCHAR", [(0, "f", 12000, "Sum gjeld\t5\t12 000\t11 000"), (1, "f", 13000, "SUM GJELD\t13 000,9"), (2, "f", None, "Sum gjeld og mer\t5")])
def j6_cases(spark: SparkSession) -> DataFrame:
    rows = [(0, "x\nSum gjeld\t5\t12 000\t11 000\nSum gjeld\t1\t99 000"), (1, " \nSUM GJELD\t13 000,9"), (2, "Sum gjeld og mer\t5\nSum gjeld\t50 000\t60 000"), (3, "Sum gjelder\t12 000"), (4, None)]
    df = spark.createDataFrame(rows, "n int, text string")
    return scan.loose_value(df, df.select("n", F.lit("f").alias("field"), F.lit("Sum gjeld").alias("label")), ("n",))


_VOTES = [
    (1, [100000, 100000, 50000], 50000, 100000, 100000, "ocr_misread_corrected"), (2, [100000, 50000], 50000, 100000, 100000, "ambiguous_default_api"), (3, [None], 50000, 100000, None, "all_strategies_failed"), (4, [50000, 50100, 100000], 50000, 100000, 50000, "api_disagrees_with_pdf"),
    (5, [7000, 9000, 9000], None, 100000, 9000, "ambiguous_consensus_disagrees_api"), (6, [7000, 9000, None], 50000, 100000, 7000, "ambiguous_consensus_disagrees_api"), (7, [100500], None, 100000, 100500, "ocr_misread_corrected"), (8, [50000], 50000, 100000, 50000, "ambiguous_consensus_disagrees_api"),
]


@cases("doc_id BIGINT, field VARCHAR, reconciled_value DOUBLE, diagnosis VARCHAR", [(d, "f", v, why) for d, _, _, _, v, why in _VOTES])
def j4_cases(spark: SparkSession) -> DataFrame:
    asked = spark.createDataFrame([(d, "f", float(api), None if v1 is None else float(v1)) for d, _, v1, api, *_ in _VOTES], "doc_id long, field string, api_value double, v1_value double")
    readings = [spark.createDataFrame([(d, "f", values[i]) for d, values, *_ in _VOTES if len(values) > i], "doc_id long, field string, value long") for i in range(3)]
    return reconcile.deep_dive(asked, readings).select("doc_id", "field", "reconciled_value", "diagnosis")


@cases("doc_id BIGINT, n_pass BIGINT, n_fail BIGINT, n_missing_extract BIGINT, n_missing_api BIGINT, disagreements VARCHAR", [(1, 1, 1, 2, 1, "sum_driftsinntekter,sum_gjeld"), (2, 1, 0, 0, 0, "")])
def j2_cases(spark: SparkSession) -> DataFrame:
    # fields stand in the order of the schema, page-one fields are no disagreements
    e = [(1, "sum_gjeld", "100000"), (1, "aarsresultat", "5000"), (1, "sum_eiendeler", "7"), (2, "valuta", "nok")]
    a = [(1, "sum_gjeld", "900000"), (1, "aarsresultat", "5900"), (1, "sum_driftsinntekter", "1"), (1, "valuta", "NOK"), (2, "valuta", "NOK "), (2, "orgnr", None)]
    schema = "doc_id long, field string, value string"
    out = reconcile.validation_summary(reconcile.validate(spark.createDataFrame(e, schema), spark.createDataFrame(a, schema), field_spec(spark)))
    return out.withColumn("disagreements", F.array_join("disagreements", ","))


@cases("orgnr INTEGER, idx INTEGER, suffix VARCHAR", [(1, 2, "_v2"), (3, 1, "_v4")])
def j3_cases(spark: SparkSession) -> DataFrame:
    # all suffixes are searched and only entries that end in the year count
    rows = [(1, 2020, "", 1, "2019-12-31"), (1, 2020, "_v2", 1, "2019-12-31"), (1, 2020, "_v2", 2, "2020-06-30"), (1, 2020, "_v3", 1, "2020-12-31"), (2, 2020, "", 1, "2019-12-31"), (3, 2020, "_v4", 1, "2020-12-31"), (3, 2020, "_v9", 1, "2020-12-31"), (4, 2020, "", 1, None)]
    df = spark.createDataFrame(rows, "orgnr int, year int, suffix string, idx int, period_end string")
    return reconcile.api_entry(df, ("", "_v2", "_v3", "_v4"), first_else=False).select("orgnr", "idx", "suffix")


# ---- runs ----


@cases("k INTEGER, status VARCHAR, reason_length INTEGER", [(1, "already_exists", None), (2, "no_pdf", None), (3, "no_nokkeltall", None), (4, "ok", None), (5, "error", 1500), (6, "uncaught", None), (7, "skipped_legacy", None)])
def k2_cases(spark: SparkSession) -> DataFrame:
    keys = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k int")
    outcome = spark.createDataFrame([(4, "ok", None), (5, None, "x" * 2000), (7, "skipped_legacy", None)], "k int, status string, error string")
    out = runs.run_status(keys(1, 2, 3, 4, 5, 6, 7, 7), keys(1), keys(1, 3, 4, 5, 6, 7), keys(4, 5, 6, 7), outcome, ["k"])
    return out.select("k", "status", F.length("reason").alias("reason_length"))


@cases("field VARCHAR, n BIGINT", [("a", 2)])
def k14_cases(spark: SparkSession) -> DataFrame:
    # the vote never gives this diagnosis; rows that carry it from elsewhere are listed
    rows = [(1, "a", "nokkeltall_suspect"), (2, "a", "nokkeltall_suspect"), (3, "b", "api_disagrees_with_pdf")]
    return runs.suspects(spark.createDataFrame(rows, "doc_id long, field string, diagnosis string")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@cases("doc_id BIGINT, page INTEGER", [(1, 3), (2, 1), (2, 2), (2, 5)])
def a14_cases(spark: SparkSession) -> DataFrame:
    hits = spark.createDataFrame([(1, "a", 2), (1, "b", 0), (2, "a", 4), (3, "a", 1)], "doc_id long, canonical string, page_idx int")
    own = spark.createDataFrame([(d, p, "brreg" if p <= 3 else "company") for d in (1, 2, 3) for p in range(1, 6)], "doc_id long, page int, source string")
    summary = spark.createDataFrame([(1, ["a"], 0), (2, ["a", "z"], 1), (3, [], 1)], "doc_id long, disagreements array<string>, n_missing_extract int")
    return runs.raster_pages(hits, own, summary)


@cases("metric VARCHAR, n BIGINT", [("n_total", 6), ("n_ok", 2), ("n_no_pdf", 1), ("n_no_api", 0), ("n_skipped_legacy", 1), ("n_extract_failed", 2), ("field_pass_total", 7), ("field_fail_total", 2), ("field_missing_total", 1), ("n_corrections_attempted", 3), ("n_corrections_resolved", 2)])
def k4_totals(spark: SparkSession) -> DataFrame:
    status = spark.createDataFrame(list(enumerate(["ok", "ok", "no_pdf", "skipped_legacy_format", "extract_failed", "uncaught_exception"])), "doc_id long, status string")
    summary = spark.createDataFrame([(0, 4, 2, 0), (1, 3, 0, 1)], "doc_id long, n_pass int, n_fail int, n_missing_extract int")
    fixed = spark.createDataFrame([(0, "ocr_misread_corrected"), (0, "ocr_misread_corrected"), (1, "all_strategies_failed")], "doc_id long, diagnosis string")
    return runs.run_totals(status, summary, fixed)

"""Queries for the document-to-facts operators, over whole tables, each with SQL where SQL can express it.

Inputs that the tables don't hold (word boxes, page sizes, registry records) are made from them by
the same arithmetic here and in the SQL. Odd cases are in `plans.cases`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordfacts.functions import amounts
from fjordfacts.functions.text import once
from fjordfacts.operators import fingerprint, flow, kv, layout, metadata, notes, pages, reconcile, runs, scan
from fjordfacts.operators.schema import FIELDS, field_spec
from fjordfacts.session import cut, spread, table, tasks
from fjordfacts.sources import io

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- sources ----


@query("""
select o_custkey as orgnr, year(o_orderdate) as year,
  coalesce(max(case when o_orderkey % 5 = 0 then 'aarsregnskap_' || year(o_orderdate) || '.pdf' end), max(case when o_orderkey % 5 <> 0 then 'aarsregnskap_' || year(o_orderdate) || '_' || o_orderkey || '.pdf' end)) as name
from orders group by all""")
def a1_latest_file(spark: SparkSession, d: str) -> DataFrame:
    year = F.year("o_orderdate")
    name = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("aarsregnskap_"), year, F.lit(".pdf"))).otherwise(F.concat(F.lit("aarsregnskap_"), year, F.lit("_"), "o_orderkey", F.lit(".pdf")))
    return runs.latest_file(table(spark, d, "orders").select(F.col("o_custkey").alias("orgnr"), year.alias("year"), name.alias("name")))


@query("""
select l_orderkey as doc_id, 1 as page_no, l_linenumber as line_id, cast(l_partkey % 2000 as int) as "left", 'w' || l_suppkey as text
from lineitem where l_linenumber % 3 <> 0 and l_suppkey % 4 <> 0""")
def a6_decode_tsv(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat_ws("\t", F.when(F.col("l_linenumber") % 3 == 0, 4).otherwise(5), F.lit(1), F.lit(1), F.lit(1), "l_linenumber", F.lit(1), F.col("l_partkey") % 2000, F.lit(10), F.lit(30), F.lit(12), F.lit("91.5"), F.when(F.col("l_suppkey") % 4 == 0, "  ").otherwise(F.concat(F.lit("w"), "l_suppkey")))
    return io.decode_tsv(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), line.alias("value")), keep=("doc_id",)).select("doc_id", "page_no", "line_id", "left", "text")


@query("select r_regionkey, r_name, null::int as n_nationkey from region union all select n_regionkey, null, n_nationkey from nation")
def a10_ragged_union(spark: SparkSession, d: str) -> DataFrame:
    return io.flat_for_csv([table(spark, d, "region"), table(spark, d, "nation").select(F.col("n_regionkey").alias("r_regionkey"), "n_nationkey")])


@query("select regexp_replace(orgnr, '[^0-9]', '', 'g') as orgnr, year from records where doc_id % 7 <> 0")
def a12_parse_spec(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "records").select(F.concat(F.when(F.col("doc_id") % 7 == 0, "# ").otherwise(""), F.regexp_replace("orgnr", "[^0-9]", ""), F.lit("  "), F.coalesce(F.col("year").cast("string"), F.lit("-")), F.lit(" x")).alias("value"))
    return io.parse_spec(lines)


@query("select doc_id, substr(sha256(text), 1, 16) as hash from documents where text is not null")
def a15_content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", fingerprint.content_hash(F.col("text")).alias("hash"))


# ---- numbers ----

_CENTS = "cast(round(l_extendedprice * 100) as bigint)"


@query(f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey % 8 as style,
  case l_orderkey % 8 when 4 then -({_CENTS} // 100) when 5 then {_CENTS} / 100.0 when 7 then null else case when l_orderkey % 8 in (2, 6) then {_CENTS} / 100.0 else {_CENTS} // 100 end end::double as amount
from lineitem""")
def b1_normalize_amount(spark: SparkSession, d: str) -> DataFrame:
    df = spread(table(spark, d, "lineitem")).withColumn("c", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    whole, part = F.floor(F.col("c") / 100).cast("bigint"), F.lpad((F.col("c") % 100).cast("string"), 2, "0")
    grouped = F.format_number(whole, 0)
    style = F.col("l_orderkey") % 8
    by = [
        F.replace(grouped, F.lit(","), F.lit(" ")), F.concat(F.replace(grouped, F.lit(","), F.lit(" ")), F.lit(" kr")), F.concat(F.replace(grouped, F.lit(","), F.lit(".")), F.lit(","), part),
        F.translate(whole.cast("string"), "10", "lO"), F.concat(F.lit("("), F.replace(grouped, F.lit(","), F.lit(" ")), F.lit(")")), F.concat(grouped, F.lit("."), part), F.concat(F.lit("kr. "), whole, F.lit(","), part, F.lit(" %")), F.concat(whole, F.lit(" stk")),
    ]
    text = F.coalesce(*(F.when(style == i, t) for i, t in enumerate(by)))
    rows = once(df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", style.alias("style"), "c"), t=text).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "style", "t")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "style", amounts.normalize_amount(F.col("t")).alias("amount"))


_MILL = r"\b(mnok|i\s+millioner|million(er)?(\s+(kr|nok))?|tall i million(er)?)\b"
_THOU = r"\b(tnok|i\s+1[\s.]?000\s*(nok|kr)|i\s+tusen|hele\s+tusen|beløp\s+i\s+1\s*000)\b"


@query(f"""
select distinct doc_id, nr, case when regexp_matches(lower(t), '{_MILL}') then 1e6 when regexp_matches(lower(t), '{_THOU}') then 1e3 else 1.0 end::double as scale
from (select doc_id, nr, tittel || ' ' || raw_text as t from noter)""")
def b4_detect_scale(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "noter").select("doc_id", "nr", amounts.detect_scale(F.concat("tittel", F.lit(" "), "raw_text")).alias("scale")).distinct()


@query("""
select o_orderkey, 0 as pos, 4 as start, floor(o_totalprice)::double as value from orders
union all select o_orderkey, 1, 4 + length(format('{:,}', floor(o_totalprice)::bigint)) + 4, (o_custkey % 900 + 100)::double from orders""")
def b5_find_amounts(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("Sum "), F.replace(F.format_number(F.floor("o_totalprice"), 0), F.lit(","), F.lit(" ")), F.lit(" og "), (F.col("o_custkey") % 900 + 100).cast("string"), F.lit(" x"))
    rows = table(spark, d, "orders").select("o_orderkey", F.posexplode(amounts.find_amounts(line)).alias("pos", "a"))
    return rows.select("o_orderkey", "pos", "a.start", "a.value")


@query("""
select o_orderkey, a::double as first, b::double as second from (
  select o_orderkey, floor(o_totalprice)::bigint * 100 + 100000000 as a, floor(o_totalprice)::bigint * 100 + 100000000 + o_custkey as b from orders)""")
def b6_two_number_split(spark: SparkSession, d: str) -> DataFrame:
    a = F.floor("o_totalprice") * 100 + 100000000
    text = F.replace(F.concat_ws(" ", F.format_number(a, 0), F.format_number(a + F.col("o_custkey"), 0)), F.lit(","), F.lit(" "))
    return table(spark, d, "orders").select("o_orderkey", amounts.two_number_split(text).alias("s")).select("o_orderkey", "s.first", "s.second")


@query("select p_partkey, length(regexp_replace(p_name || p_partkey, '[^0-9]', '', 'g')) > length(p_name || p_partkey) * 0.4 as numeric from part")
def b7_looks_numeric(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", amounts.looks_numeric(F.concat("p_name", F.col("p_partkey").cast("string"))).alias("numeric"))


# ---- layout ----


def _words(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.trim(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")), " ")).alias("pos", "text")).where("text <> ''")
    return w.select("doc_id", F.lit(1).alias("page_no"), F.lit(1).alias("block_id"), F.lit(1).alias("par_id"), F.floor(F.col("pos") / 8).cast("int").alias("line_id"), (F.col("pos") % 8).alias("word_id"), ((F.col("pos") % 8) * 160 + (F.col("doc_id") * 31 + F.col("pos") * 17) % 5 * 25).cast("int").alias("left"), F.floor(F.col("pos") / 8).cast("int").alias("top"), F.lit(40).alias("width"), F.lit(10).alias("height"), F.lit(90.0).alias("conf"), "text")


@query("""
with w as (
  select doc_id, unnest(string_split(trim(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')) as t, generate_subscripts(string_split(trim(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), 1) - 1 as pos from documents),
b as (select doc_id, pos // 8 as line_id, pos, t, (pos % 8) * 160 + (doc_id * 31 + pos * 17) % 5 * 25 as x from w where t <> ''),
g as (select *, case when lag(x) over (partition by doc_id, line_id order by x, pos) is not null then greatest(0, x - lag(x + 40) over (partition by doc_id, line_id order by x, pos)) end as gap from b),
m as (select doc_id, line_id, list_sort(list(gap) filter (gap is not null)) as gs from g group by all),
l as (select g.doc_id, g.line_id, string_agg(case when gap is null then '' when gap > greatest(2 * gs[len(gs) // 2 + 1], 30) then chr(9) else ' ' end || t, '' order by x, pos) as text from g join m on g.doc_id = m.doc_id and g.line_id = m.line_id group by all)
select doc_id, 1 as page_no, string_agg(text, chr(10) order by line_id) as text from l group by doc_id""")
def c1_page_text(spark: SparkSession, d: str) -> DataFrame:
    return layout.page_text(_words(spark, d))


# ---- notes and facts ----


def _note_pages(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "noter").where("doc_id is not null and nr is not null and raw_text is not null").select("doc_id", "nr", "tittel", "raw_text").distinct()
    return n.select("doc_id", F.regexp_extract("nr", r"^(\d+)", 1).cast("int").alias("page_no"), F.concat(F.lit("Note "), "nr", F.lit(" "), "tittel", F.lit("\n"), "raw_text").alias("text"))


@query("""
with n as (select distinct doc_id, nr, tittel, raw_text, cast(regexp_extract(nr, '^([0-9]+)', 1) as int) as p from noter where raw_text is not null),
r as (select *, row_number() over (partition by doc_id order by p, 'Note ' || nr || ' ' || tittel || chr(10) || raw_text) as k, count(*) over (partition by doc_id) as m from n)
select doc_id, nr, trim(tittel) as tittel, regexp_replace(raw_text || case when k < m then chr(10) || '<<<PAGE_BREAK>>>' else '' end, '^[\\s\u00a0]+|[\\s\u00a0]+$', '', 'g') as raw_text, case when k < m then [k, k + 1] else [k] end as page_refs from r""")
def d1_segment_notes(spark: SparkSession, d: str) -> DataFrame:
    """A note that ends with its page keeps the mark of the break, since the text is trimmed before whole marks are taken out."""
    return notes.segment(_note_pages(spark, d)).select("doc_id", "nr", "tittel", "raw_text", F.col("page_refs").cast("array<bigint>").alias("page_refs"))


@query("""
select doc_id, nr, case when regexp_matches(lower(left(raw_text, 300)), '""" + _MILL + """') then 1e6 when regexp_matches(lower(left(raw_text, 300)), '""" + _THOU + """') then 1e3 else 1.0 end::double as scale, cardinality(raw_amounts) > 0 as has_table
from (select distinct doc_id, nr, raw_text, raw_amounts from noter)""")
def d7_enrich(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "noter").groupBy("doc_id", "nr").agg(F.min_by("raw_amounts", "raw_text").alias("raw_amounts"), F.min("raw_text").alias("raw_text"))
    return notes.enrich(n).select("doc_id", "nr", F.col("scale_inferred").alias("scale"), "has_table")


@query("""
select o_orderkey as doc_id, 'Sum ordre' as label, '2021' as col, floor(o_totalprice)::double as value from orders
union all select o_orderkey, 'Sum ordre', '2020', (o_custkey + 3000)::double from orders""")
def e1_known_facts(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("\t2021\t2020\nSum ordre\t"), F.replace(F.format_number(F.floor("o_totalprice"), 0), F.lit(","), F.lit(" ")), F.lit("\t"), (F.col("o_custkey") + 3000).cast("string"))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), text.alias("raw_text"))
    return kv.facts(rows, keep=("doc_id",)).select("doc_id", "label", "col", "value")


def _note_texts(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "noter").select("doc_id", "nr", "raw_text")
    # one shuffle serves the distinct and spreads the work
    return n.repartition(tasks(n), "doc_id", "nr").distinct()


@query()
def e1_facts(spark: SparkSession, d: str) -> DataFrame:
    return kv.facts(_note_texts(spark, d))


@query()
def e10_key_values(spark: SparkSession, d: str) -> DataFrame:
    return kv.key_values(kv.facts(_note_texts(spark, d)))


# ---- first page and setup ----


_BLANK_ENDS = "'^[\\s\u00a0]+|[\\s\u00a0]+$'"


def _after(label: str) -> str:
    """SQL of the value after a label in the lines `ls`."""
    low = label.lower()
    strip = lambda x: f"regexp_replace({x}, {_BLANK_ENDS}, '', 'g')"
    read = f"case when contains(x, ':') then {strip(chr(115) + 'ubstr(x, strpos(x, chr(58)) + 1)')} else nullif({strip(f'substr(x, strpos(lower(x), {low!r}) + {len(low)})')}, '') end"
    return f"list_filter(list_transform(list_filter(ls, lambda x: contains(lower(x), '{low}')), lambda x: {read}), lambda v: v is not null)[1]"


def _yes_no(x: str) -> str:
    return f"case when lower({x}) in ('ja', 'ja.', 'true', 'yes') then true when lower({x}) in ('nei', 'nei.', 'false', 'no') then false end"


_DATES = r"([0-9]{2})\.([0-9]{2})\.([0-9]{4})\s*[-–]\s*([0-9]{2})\.([0-9]{2})\.([0-9]{4})"


def _date(x: str, *groups: int) -> str:
    return f"case when regexp_matches({x}, '{_DATES}') then " + " || '-' || ".join(f"regexp_extract({x}, '{_DATES}', {g})" for g in groups) + " end"


@query(f"""
with l as (select doc_id, lower(coalesce(_ocr_text, '')) as t, string_split(coalesce(_ocr_text, ''), chr(10)) as ls from generell_info),
v as (select *, {_after("Organisasjonsnummer")} as o, {_after("Foretaksnavn")} as n, {_after("Organisasjonsform")} as f, {_after("Årsregnskapets periode")} as p, {_after("Journalnummer")} as j,
  coalesce({_after("Morselskap i konsern")}, {_after("Morselskap")}) as m, coalesce({_after("Regler for små foretak")}, {_after("Smaa foretak")}) as s, coalesce({_after("Dato for fastsettelse")}, {_after("fastsettelse av årsregnskapet")}) as d from l),
w as (select *, {_yes_no("m")} as morselskap, {_yes_no("s")} as smaa_foretak, upper(regexp_extract(f, '^(\\S+)', 1)) as g from v)
select doc_id, nullif(regexp_replace(regexp_extract(o, '([0-9]{{3}}\\s*[0-9]{{3}}\\s*[0-9]{{3}})', 1), '\\s', '', 'g'), '') as orgnr, nullif(n, '') as foretaksnavn,
  case g when 'AKSJESELSKAP' then 'AS' when 'ALLMENNAKSJESELSKAP' then 'ASA' when 'ANSVARLIG' then 'ANS' when 'STIFTELSE' then 'STI' when '' then null else g end as organisasjonsform,
  {_date("p", 3, 2, 1)} as regnskapsperiode_fra, {_date("p", 6, 5, 4)} as regnskapsperiode_til, nullif(replace(regexp_extract(j, '([0-9][0-9\\s]{{6,}})', 1), ' ', ''), '') as journalnr, morselskap, smaa_foretak,
  case when contains(t, 'alminnelige regler') or contains(t, 'alminnelig regler') or contains(t, 'alminnelige regnskapsregler') or contains(t, 'regnskapslovens alminnelige') or contains(t, 'reqgnskapslovens alminnelige') then 'regnskapslovenAlminneligRegler'
    when contains(t, 'regler for små foretak benyttet: ja') or coalesce(smaa_foretak, false) then 'regnskapslovenSmaaForetak' else 'regnskapslovenAlminneligRegler' end as regnskapsregler, 'store' as oppstillingsplan,
  case when regexp_matches(d, '[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{4}}') then regexp_extract(d, '([0-9]{{2}})\\.([0-9]{{2}})\\.([0-9]{{4}})', 3) || '-' || regexp_extract(d, '([0-9]{{2}})\\.([0-9]{{2}})\\.([0-9]{{4}})', 2) || '-' || regexp_extract(d, '([0-9]{{2}})\\.([0-9]{{2}})\\.([0-9]{{4}})', 1) end as dato_fastsettelse,
  regexp_matches(t, '(^|[^a-zæøå0-9_])avviklingsregnskap($|[^a-zæøå0-9_])') as avviklingsregnskap, contains(t, 'ikke revidert') or contains(t, 'ikke-revidert') as ikke_revidert,
  contains(t, 'fravalg av revisjon') or contains(t, 'fravalg revisjon') or contains(t, 'ikke skal revideres: ja') or contains(t, 'ikke revideres: ja') or regexp_matches(t, 'valgt\\s+bort\\s+revisjon|revisjon\\s+er\\s+fravalgt') as fravalg_revisjon,
  case when contains(t, 'konsernregnskap') or contains(t, 'morselskap i konsern: ja') then 'KONSERN' else 'SELSKAP' end as regnskapstype, 'NOK' as valuta from w""")
def f1_all_fields(spark: SparkSession, d: str) -> DataFrame:
    return metadata.first_page(table(spark, d, "generell_info").select("doc_id", F.col("_ocr_text").alias("text")))


@query("select distinct doc_id, orgnr, case when doc_id % 2 = 0 then 'KONSERN' end as regnskapstype, regnskapsperiode_til, cast(n_noter as varchar) as sum_gjeld from records")
def f7_flatten_api(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "records").select("doc_id", "orgnr", "regnskapsperiode_til", "n_noter").distinct()
    body = F.to_json(F.struct(F.struct(F.col("orgnr").alias("organisasjonsnummer")).alias("virksomhet"), F.when(F.col("doc_id") % 2 == 0, "KONSERN").alias("regnskapstype"), F.struct(F.col("regnskapsperiode_til").alias("tilDato")).alias("regnskapsperiode"), F.struct(F.struct(F.col("n_noter").alias("sumGjeld")).alias("gjeldOversikt")).alias("egenkapitalGjeld")))
    return metadata.flatten_api(r.select("doc_id", body.alias("json"))).select("doc_id", "orgnr", "regnskapstype", "regnskapsperiode_til", "sum_gjeld")



@query("""
with r as (select distinct doc_id, doc_id % 2 = 0 as api, doc_id % 3 > 0 as page, doc_id % 11 = 0 as aa, doc_id % 13 = 0 as pa, case doc_id % 5 when 0 then null when 1 then true else false end as asm, case doc_id % 7 when 0 then 'KONSERN' when 1 then null else 'SELSKAP' end as aty,
  case doc_id % 4 when 0 then 'smaa' when 1 then 'store' end as plan, case doc_id % 9 when 0 then null when 1 then true else false end as psm, doc_id % 8 = 0 as pk, doc_id % 17 = 0 as det from records),
s as (select *, case when api then case plan when 'smaa' then true when 'store' then coalesce(asm, false) else asm end end as s1 from r),
t as (select *, coalesce(s1, case when page then psm end) as small, case when api then coalesce(aty = 'KONSERN', false) when page then pk else det end as grp from s)
select doc_id, case when (api and aa) or (page and pa) then 'avviklingsregnskap' when grp then case when small then 'smaa_konsern' else 'store_konsern' end when small then 'smaa_selskap' when not small then 'store_selskap' else 'unknown' end as setup from t""")
def f8_setup(spark: SparkSession, d: str) -> DataFrame:
    m = lambda k: F.col("doc_id") % k
    api, page = m(2) == 0, m(3) > 0
    known = {"found": api, "avvikling": api & (m(11) == 0), "smaa": F.when(m(5) == 1, True).when(m(5) > 1, False), "type": F.when(m(7) == 0, "KONSERN").when(m(7) > 1, "SELSKAP"), "plan": F.when(m(4) == 0, "smaa").when(m(4) == 1, "store")}
    read = {"found": page, "avvikling": page & (m(13) == 0), "smaa": F.when(m(9) == 1, True).when(m(9) > 1, False), "type": F.when(m(8) == 0, "KONSERN").otherwise("SELSKAP")}
    return table(spark, d, "records").select("doc_id").distinct().select("doc_id", metadata.setup(known, read, m(17) == 0).alias("setup"))


# ---- statement scan ----

#: Canonical name and first label of the statement fields, for the SQL.
_LABELS = ", ".join(f"('{f[1]}', '{f[4][0]}', {f[0]})" for f in FIELDS if f[3] != "generell")
_SHORT = "length(cast(abs({0})::bigint as varchar)) <= 3"
_HITS = "select doc_id, canonical, trunc(max(case when not isnan(value) then value end)) as v, trunc(max(case when not isnan(value_prev) then value_prev end)) as p from field_hits where doc_id is not null group by all"


def _statement_values(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, canonical, label, v, p): whole numbers, null where no row has one."""
    known = lambda c: F.max(F.when(~F.isnan(c), F.col(c))).cast("bigint")
    hits = table(spark, d, "field_hits").where("doc_id is not null").groupBy("doc_id", "canonical").agg(known("value").alias("v"), known("value_prev").alias("p"))
    return hits.join(F.broadcast(field_spec(spark).select("canonical", F.get("labels", F.lit(0)).alias("label"))), "canonical")


def _statement_pages(values: DataFrame, cells: list, page_no: int = 1) -> DataFrame:
    """One page for each document: a line for each field, blank lines between; a null cell is an empty one."""
    line = F.concat_ws("\t", "label", *(F.coalesce(c.cast("string"), F.lit("")) for c in cells))
    rows = values.repartition(tasks(values), "doc_id").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n\n").alias("text"))
    return rows.withColumn("page_no", F.lit(page_no))


@query(f"""
with s as (select *, v is not null and not {_SHORT.format("v")} as bv, p is not null and not {_SHORT.format("p")} as bp from ({_HITS}))
select doc_id, canonical, case when bv then v end as value, p as value_prev, case when bv then 2 else 1 end as n_numbers, not bv as lost from s where bp and v is not null""")
def g3_scan_fields(spark: SparkSession, d: str) -> DataFrame:
    values = _statement_values(spark, d)
    return scan.scan_fields(_statement_pages(values, [F.col("v"), F.col("p")])).select("doc_id", "canonical", "value", "value_prev", "n_numbers", F.col("year_column_failed_ocr").alias("lost"))


@query(f"""
with s as (select doc_id, canonical, list_filter([v * 30, p * 40, v * 10, p * 10], lambda x: x is not null and (x < 0 or x >= 10000)) as k from ({_HITS}))
select doc_id, canonical, k[-2] as value, k[-1] as value_prev, case when len(k) = 4 then k[1] end as morselskap_value, case when len(k) = 4 then k[2] end as morselskap_value_prev, case when len(k) = 4 then '4col' else '2col_fallback' end as layout from s where len(k) >= 2""")
def g6_scan_group_fields(spark: SparkSession, d: str) -> DataFrame:
    v, p = F.col("v"), F.col("p")
    pages_ = _statement_pages(_statement_values(spark, d), [v * 30, p * 40, v * 10, p * 10])
    return scan.scan_group_fields(pages_).select("doc_id", "canonical", "value", "value_prev", "morselskap_value", "morselskap_value_prev", "layout")


# ---- pages ----


def _dims(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.explode(F.sequence(F.lit(1), (3 + F.col("o_orderkey") % 6).cast("int"))).alias("page"))
    w = F.when(F.col("page") <= F.col("doc_id") % 4, 1728).when((F.col("doc_id") + F.col("page")) % 5 == 0, 1728).otherwise(1653)
    h = F.when((F.col("doc_id") + F.col("page")) % 7 == 0, 2140).otherwise(2339)
    return p.withColumns({"img_w": w, "img_h": h})


@query("""
with p as (select o_orderkey as doc_id, unnest(generate_series(1, 3 + o_orderkey % 6))::int as page from orders),
dm as (select *, case when page <= doc_id % 4 then 1728 when (doc_id + page) % 5 = 0 then 1728 else 1653 end as w, case when (doc_id + page) % 7 = 0 then 2140 else 2339 end as h from p),
b as (select *, coalesce(min(case when w <> 1728 then page end) over (partition by doc_id) - 1, max(page) over (partition by doc_id)) as last from dm)
select doc_id, page, last as brreg_last, case when page <= last then 'brreg' else 'company' end as source, page > last and w = 1728 as nested_wrapper,
  case when page <= last then case when page = 1 then 'generell_info' when page = 2 then 'resultatregnskap' when page = 3 then 'balanse' when page = 4 and last >= 5 then 'balanse' when page = 5 and last >= 10 then 'balanse' else 'noter' end when h in (2140, 2337) then 'revisjonsberetning' end as page_type
from b""")
def h3_typed_pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.typed_pages(_dims(spark, d)).select("doc_id", "page", "brreg_last", "source", "nested_wrapper", "page_type")


_PROFILE = "select c_custkey as doc_id, 1 as page, unnest(generate_series(0, 400))::int as row from customer"


@query(f"""
with p as (select *, case when (row * (doc_id % 5 + 1) + doc_id) % 120 < 45 then 200.0 when (row + doc_id) % 120 < 50 then 242.0 else 255.0 end as mean from ({_PROFILE})),
i as (select *, case when row - lag(row) over (partition by doc_id order by row) - 1 > 40 then 1 else 0 end as j from p where mean < 245),
b as (select *, sum(j) over (partition by doc_id order by row) as block from i),
z as (select doc_id, block, min(row) as y0, case when 400 - max(row) <= 40 then 400 else max(row) end as y1 from b group by doc_id, block),
n as (select z.doc_id, z.y0, z.y1, count(*) filter (p.row > z.y0 and p.row < z.y1 and p.mean < 240 and q.mean >= 240) as n_lines from z join p on p.doc_id = z.doc_id and p.row between z.y0 and z.y1 left join p q on q.doc_id = p.doc_id and q.row = p.row - 1 group by all)
select doc_id, y0, y1, y1 - y0 as height, n_lines from n where y1 - y0 >= 15""")
def h6_ink_blocks(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), F.lit(1).alias("page"), F.explode(F.sequence(F.lit(0), F.lit(400))).alias("row"))
    mean = F.when((F.col("row") * (F.col("doc_id") % 5 + 1) + F.col("doc_id")) % 120 < 45, 200.0).when((F.col("row") + F.col("doc_id")) % 120 < 50, 242.0).otherwise(255.0)
    return pages.ink_blocks(p.withColumn("mean", mean)).select("doc_id", "y0", "y1", "height", "n_lines")


_DIMS = """
with p as (select o_orderkey as doc_id, unnest(generate_series(1, 3 + o_orderkey % 6))::int as page from orders),
dm as (select *, case when page <= doc_id % 4 then 1728 when (doc_id + page) % 5 = 0 then 1728 else 1653 end as w, case when (doc_id + page) % 7 = 0 then 2140 else 2339 end as h, (doc_id * 7 + page) % 6 as g from p),
b as (select *, coalesce(min(case when w <> 1728 then page end) over (partition by doc_id) - 1, max(page) over (partition by doc_id)) as last from dm)"""


def _page_zones(spark: SparkSession, d: str) -> DataFrame:
    g = ((F.col("doc_id") * 7 + F.col("page")) % 6).cast("int")
    return _dims(spark, d).select("doc_id", "page", F.lit(0).alias("y0"), F.lit(60).alias("y1"), F.when(g >= 2, "table").otherwise("text").alias("label"), F.lit(60).alias("height"), g.alias("n_col_gaps"), F.lit(1).alias("n_lines"))


@query(_DIMS + """
select doc_id, coalesce(list_sort(list(page) filter (page > last and g >= 4)), []) as evidence, count(*) filter (page > last and g >= 4) >= 5 as detected from b group by doc_id""")
def h7_group_evidence(spark: SparkSession, d: str) -> DataFrame:
    found = pages.group_evidence(pages.classified_pages(_dims(spark, d), _page_zones(spark, d)))
    return found.select("doc_id", F.transform("evidence", lambda e: e["page"]).alias("evidence"), "detected")


@query(_DIMS + """
select doc_id, page, case when page <= last then page > 1 when h in (2140, 2337) then false else g >= 2 end as has_table, g::int as max_col_gaps from b""")
def h9_has_table(spark: SparkSession, d: str) -> DataFrame:
    return pages.classified_pages(_dims(spark, d), _page_zones(spark, d)).select("doc_id", "page", "has_table", "max_col_gaps")


@query(_DIMS + """
, c as (select *, row_number() over (partition by doc_id order by page) as k, count(*) over (partition by doc_id) as m from b where page > last)
select b.doc_id, max(last)::int as n_brreg, (count(*) - max(last))::int as n_company, count(*)::int as total_pages, coalesce(list_sort(list(b.page) filter (b.page > last and w = 1728)), []) as nested_wrapper_pages,
  case when count(*) = max(last) then 'brreg_only' when count(*) - max(last) = 1 then 'single_page_company' when b.doc_id % 3 = 0 then 'visma_finale_b' when b.doc_id % 3 = 1 then 'no_image' else 'unknown_00ff00ff00ff00ff' end as platform,
  count(*) filter (b.page > last and h = 2140) as n_audit_height, count(*) filter (b.page > last and g >= 4) >= 5 as detected
from b group by b.doc_id""")
def h1_manifest(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 3
    hashes = _dims(spark, d).where(k != 1).select("doc_id", "page", fingerprint.from_hex(F.when(k == 0, "ffff0000ffffffff").otherwise("00ff00ff00ff00ff")).alias("hash"))
    files = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").cast("string").alias("orgnr"), F.year("o_orderdate").alias("year"), F.lit(b"pdf").alias("content"))
    made = pages.manifest(files, _dims(spark, d), _page_zones(spark, d), hashes)
    audit = F.coalesce(F.size(F.try_element_at("company_height_groups", F.lit("2140"))).cast("bigint"), F.lit(0))
    return made.select("doc_id", "split.n_brreg", "split.n_company", "document.total_pages", "split.nested_wrapper_pages", F.col("platform.id").alias("platform"), F.greatest(audit, F.lit(0)).alias("n_audit_height"), "konsern.detected")


# ---- fingerprints ----


_I2 = """
select vec_id, case when h >= 9223372036854775808::hugeint then h - 18446744073709551616::hugeint else h end::bigint as hash
from (select vec_id, list_sum(list_transform(embedding, lambda x, i: case when x::double > m then power(2::hugeint, 64 - i)::hugeint else 0::hugeint end))::hugeint as h from (select vec_id, embedding, list_sum(list_transform(embedding, lambda x: x::double)) / len(embedding) as m from embeddings))""".replace("power(2::hugeint, 64 - i)::hugeint", "(1::hugeint << (64 - i)::int)")


@query(_I2)
def i2_average_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", fingerprint.average_hash(F.col("embedding")).alias("hash"))


@query("""
select o_orderkey, case o_orderkey % 6 when 0 then 'visma_finale' when 1 then 'fiken_tripletex' when 2 then 'poweroffice' when 3 then 'conta' when 4 then '24sevenoffice' else 'unknown' end as leverandor,
  case o_orderkey % 6 when 3 then 'medium' when 4 then 'medium' when 5 then 'none' else 'high' end as confidence, case o_orderkey % 6 when 1 then 'header_regex' when 5 then 'none' else 'footer_regex' end as match_type from orders""")
def i5_supplier(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 6
    footer = F.when(k == 0, "Side 3").when(k == 2, "Powered by PowerOffice").when(k == 3, "www.conta.no").when(k == 4, "24SevenOffice").otherwise("")
    return table(spark, d, "orders").select("o_orderkey", fingerprint.supplier(F.when(k == 1, "Noter 2023\nx"), footer).alias("s")).select("o_orderkey", "s.leverandor", "s.confidence", "s.match_type")


def _near_sql(column: str) -> str:
    """SQL of the first platform within five bits."""
    signed = lambda h: int(h, 16) - (1 << 64 if int(h, 16) >= 1 << 63 else 0)
    return "case " + " ".join(f"when bit_count(xor({column}, ({signed(h)})::bigint)) <= 5 then '{name}'" for h, name in fingerprint.PLATFORMS) + f" else 'unknown_' || lpad(lower(to_hex({column})), 16, '0') end"


_H5 = "select vec_id, case vec_id % 3 when 0 then hash when 1 then xor((-281474976710656)::bigint, (1::bigint << (vec_id % 7)::int) - 1) else xor((-1)::bigint, (1::bigint << (vec_id % 50)::int) - 1) end as hash from (" + _I2 + ")"


@query(f"select vec_id, hash, {_near_sql('hash')} as platform from ({_H5})")
def h5_platform(spark: SparkSession, d: str) -> DataFrame:
    low = lambda n: F.expr(f"shiftleft(1L, cast(vec_id % {n} as int)) - 1")
    k = F.col("vec_id") % 3
    made = F.when(k == 0, F.col("hash")).when(k == 1, F.lit(-281474976710656).bitwiseXOR(low(7))).otherwise(F.lit(-1).cast("bigint").bitwiseXOR(low(50)))
    return fingerprint.platform(i2_average_hash(spark, d).withColumn("hash", made.cast("bigint")))


_I8 = "select min(p_partkey) as ord, hash from (select p_partkey, xor((p_partkey % 13) * 1152921504606846, (p_partkey * 7) % 64)::bigint as hash from part) group by hash"


@query(f"""
with recursive h as (select hash, row_number() over (order by ord) as rn from ({_I8})),
f as (select rn, hash, hash as cluster, [hash] as leaders from h where rn = 1
  union all select h.rn, h.hash, coalesce(list_filter(f.leaders, lambda x: bit_count(xor(x, h.hash)) <= 5)[1], h.hash), case when len(list_filter(f.leaders, lambda x: bit_count(xor(x, h.hash)) <= 5)) = 0 then list_append(f.leaders, h.hash) else f.leaders end from f join h on h.rn = f.rn + 1)
select hash, cluster from f""")
def i8_leader_clusters(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    return fingerprint.leader_clusters(table(spark, d, "part").select(key.alias("ord"), ((key % 13) * F.lit(1152921504606846)).bitwiseXOR((key * 7) % 64).cast("bigint").alias("hash")))


@query("select c_custkey from customer order by md5(c_custkey || ':42'), c_custkey limit 200")
def i11_seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return fingerprint.seeded_sample(table(spark, d, "customer"), 200, 42, "c_custkey")


@query("select status, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 2) as pct from records group by status")
def i12_distribution(spark: SparkSession, d: str) -> DataFrame:
    return fingerprint.distribution(table(spark, d, "records"), "status")


# ---- reconciliation ----


_CHECKED = """
e as (select doc_id, canonical as field, max(value) as v from field_hits where value is not null group by all),
a as (select doc_id, field, max(api) as api from checks where api is not null group by all),
c as (select coalesce(e.doc_id, a.doc_id) as doc_id, coalesce(e.field, a.field) as field, v, api, try_cast(api as double) as w from e full outer join a on e.doc_id = a.doc_id and e.field = a.field),
k as (select *, case when api is null then 'api' when v is null then 'extracted' end as missing, case when api is null then null when v is null then false else coalesce(abs(v - w) <= greatest(abs(w) * 0.01, 1000), false) end as tolerance_ok, abs(v - w) as diff from c)"""


@query(f"with {_CHECKED} select doc_id, field, missing, tolerance_ok, diff, 'pct1' as tolerance_class from k")
def j2_validate(spark: SparkSession, d: str) -> DataFrame:
    return _validated(spark, d).select("doc_id", "field", "missing", "tolerance_ok", "diff", "tolerance_class")


def _registry(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "checks").where("api is not null").groupBy("doc_id", "field").agg(F.max("api").alias("value"))


def _validated(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "field_hits").where("value is not null").groupBy("doc_id", F.col("canonical").alias("field")).agg(F.max("value").alias("value"))
    return reconcile.validate(e, _registry(spark, d), field_spec(spark))


_SUMMARY = f"""select k.doc_id, count(*) filter (missing is null and tolerance_ok) as n_pass, count(*) filter (missing is null and not tolerance_ok) as n_fail, count(*) filter (missing = 'extracted') as n_missing_extract, count(*) filter (missing = 'api') as n_missing_api,
  coalesce(list(k.field order by s.ord) filter ((missing is null and not tolerance_ok) or missing = 'extracted'), []) as disagreements from k join (values {_LABELS}) s(field, label, ord) on s.field = k.field group by k.doc_id"""


@query(f"with {_CHECKED} {_SUMMARY}")
def j2_summary(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.validation_summary(_validated(spark, d))


@query("""
with x as (select o_custkey as orgnr, year(o_orderdate) as year, case o_orderkey % 4 when 0 then '_v2' when 1 then '_v3' when 2 then '' else '_v9' end as suffix, o_orderkey as idx, case when o_orderkey % 3 = 0 then year(o_orderdate) || '-12-31' else '1999-12-31' end as period_end from orders),
y as (select *, case suffix when '' then 0 when '_v2' then 1 when '_v3' then 2 end as s from x where suffix <> '_v9'),
z as (select * from y qualify s = min(s) over (partition by orgnr, year))
select orgnr, year, idx from z qualify row_number() over (partition by orgnr, year order by (period_end like year || '-%') desc, idx) = 1""")
def j3_api_entry(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    year = F.year("o_orderdate")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("orgnr"), year.alias("year"), F.when(k % 4 == 0, "_v2").when(k % 4 == 1, "_v3").when(k % 4 == 2, "").otherwise("_v9").alias("suffix"), k.alias("idx"), F.when(k % 3 == 0, F.concat(year.cast("string"), F.lit("-12-31"))).otherwise("1999-12-31").alias("period_end"))
    return reconcile.api_entry(rows).select("orgnr", "year", "idx")


_VOTES = """
select l_orderkey as doc_id, 'f' as field, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) as strategy_ord,
  case when l_suppkey % 5 = 0 then null else (l_partkey % 3 + 1) * 100000 end as value, (l_orderkey % 3 + 1) * 100000 as v1_value, (l_orderkey % 2 + 1) * 100000 as api_value from lineitem"""


@query(f"""
with v as ({_VOTES}),
c as (select doc_id, field, max(v1_value) as v1, max(api_value) as api, count(*) filter (abs(value - api_value) <= greatest(abs(api_value) * 0.01, 1000)) as a, count(*) filter (abs(value - v1_value) <= greatest(abs(v1_value) * 0.01, 1000)) as t from v group by all),
g as (select doc_id, field, value, count(*) as n, min(strategy_ord) as o from v where value is not null group by doc_id, field, value qualify row_number() over (partition by doc_id, field order by n desc, o) = 1)
select c.doc_id, c.field, case when (a >= 2 and a > t) or (a = t and a > 0) then api when t >= 2 and t > a then v1 else g.value end as reconciled_value,
  case when a >= 2 and a > t then 'ocr_misread_corrected' when t >= 2 and t > a then 'api_disagrees_with_pdf' when a = t and a > 0 then 'ambiguous_default_api' when g.value is null then 'all_strategies_failed'
    when abs(g.value - api) <= greatest(abs(api) * 0.01, 1000) then 'ocr_misread_corrected' else 'ambiguous_consensus_disagrees_api' end as diagnosis
from c left join g on c.doc_id = g.doc_id and c.field = g.field""")
def j5_vote(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "lineitem").createOrReplaceTempView("_votes_lineitem")
    return reconcile.vote(spark.sql(_VOTES.replace("from lineitem", "from _votes_lineitem")))


@query("select o_orderkey as doc_id, floor(o_totalprice)::bigint as value, case when o_orderkey % 3 = 0 then 'med' else 'high' end as confidence from orders")
def j9_walked_values(spark: SparkSession, d: str) -> DataFrame:
    """A line of each order: label, value, and last year's value unless the key is a multiple of three."""
    groups = lambda v, at: F.transform(F.split(F.format_number(v, 0), ","), lambda t, i: F.struct((i * 45 + at).cast("int").alias("left"), t.alias("text")))
    label = F.array(F.struct(F.lit(0).alias("left"), F.lit("Sum").alias("text")), F.struct(F.lit(50).alias("left"), F.lit("ordre").alias("text")))
    last = F.when(F.col("o_orderkey") % 3 == 0, F.array().cast("array<struct<left:int,text:string>>")).otherwise(groups(F.col("o_custkey") + 1000, 900))
    words = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.posexplode(F.concat(label, groups(F.floor("o_totalprice"), 500), last)).alias("word_id", "w"))
    words = words.select("doc_id", F.lit(1).alias("page_no"), *(F.lit(1).alias(c) for c in ("block_id", "par_id", "line_id")), "word_id", "w.left", F.lit(10).alias("top"), F.lit(40).alias("width"), F.lit(10).alias("height"), F.lit(0.9).alias("conf"), "w.text")
    labels = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit(1).alias("page_no"), F.lit("f").alias("field"), F.lit("Sum ordre").alias("label"))
    return reconcile.walked_values(words, labels).select("doc_id", "value", "confidence")


_NEAR_V1 = "abs(trunc(w) - v) <= greatest(abs(v) * 0.01, 1000)"


@query(f"""
with {_CHECKED}, r as (select doc_id, field, v, trunc(w) as w from k where missing is null and not tolerance_ok and w is not null)
select h.doc_id, h.canonical, case when r.doc_id is not null and not {_NEAR_V1} then r.w else h.value end as value, case when r.doc_id is null then null when {_NEAR_V1} then v else r.w end as reconciled_value,
  case when r.doc_id is null then null when {_NEAR_V1} then 'api_disagrees_with_pdf' else 'ocr_misread_corrected' end as diagnosis
from (select doc_id, canonical, max(value) as value from field_hits group by all) h left join r on r.doc_id = h.doc_id and r.field = h.canonical""")
def j10_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Every disagreement is read again three times: twice as the registry has it, once as before."""
    hits = table(spark, d, "field_hits").groupBy("doc_id", "canonical").agg(F.max("value").alias("value"), F.lit(0).alias("page_idx"), F.lit("x").alias("label_matched"))
    asked = cut(reconcile.disagreements(_validated(spark, d), hits, limit=None))
    readings = [asked.select("doc_id", "field", F.when((F.col("doc_id") + i) % 3 > 0, F.col("api_value")).otherwise(F.col("v1_value")).alias("value")) for i in range(3)]
    return reconcile.apply_corrections(hits, reconcile.deep_dive(asked, readings)).select("doc_id", "canonical", "value", "reconciled_value", "diagnosis")


# ---- runs ----


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def k1_pending(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return runs.pending(table(spark, d, "orders").select("o_orderkey"), done, ["o_orderkey"])


_STATUS = "case doc_id % 9 when 0 then 'already_exists' when 1 then 'skipped_legacy' when 2 then 'no_pdf' when 3 then 'no_nokkeltall' when 4 then 'error' when 5 then 'uncaught' else status end"


@query(f"select count(*) as n_processed, count(*) filter (s = 'ok') as ok, count(*) filter (s = 'already_exists') as already_exists, count(*) filter (s = 'skipped_legacy') as skipped_legacy, count(*) filter (s = 'no_pdf') as no_pdf, count(*) filter (s = 'no_nokkeltall') as no_nokkeltall, count(*) filter (s in ('error', 'uncaught')) as error from (select {_STATUS} as s from records)")
def k3_progress(spark: SparkSession, d: str) -> DataFrame:
    return runs.progress(table(spark, d, "records").select(F.expr(_STATUS).alias("status")))


@query("select setup, count(*) as n from records where status = 'ok' group by setup")
def k4_setup_distribution(spark: SparkSession, d: str) -> DataFrame:
    return runs.setup_distribution(table(spark, d, "records"))


@query("select field, count(*) as n from checks where missing = 'extracted' or (missing is null and not tolerance_ok) group by field order by n desc, field limit 20")
def k4_top_disagreements(spark: SparkSession, d: str) -> DataFrame:
    return runs.top_disagreements(table(spark, d, "checks"))


_RATE = "select field, count(*) filter (coalesce(missing, '') <> 'extracted' and tolerance_ok) as n_pass, count(*) filter (coalesce(missing, '') <> 'extracted' and not tolerance_ok) as n_fail, count(*) filter (missing = 'extracted') as n_missing from checks group by field"


@query(f"select n_pass, n_fail, n_missing, round(n_pass / greatest(1, n_pass + n_fail + n_missing), 9) as field_pass_rate from (select sum(n_pass)::bigint as n_pass, sum(n_fail)::bigint as n_fail, sum(n_missing)::bigint as n_missing from ({_RATE}))")
def k5_pass_rate(spark: SparkSession, d: str) -> DataFrame:
    return runs.pass_rate(table(spark, d, "checks"))


@query(f"select *, round(100.0 * n_pass / greatest(1, n_pass + n_fail + n_missing), 4) as pass_pct from ({_RATE})")
def k6_field_rates(spark: SparkSession, d: str) -> DataFrame:
    return runs.field_rates(table(spark, d, "checks"))


@query(f"select diagnosis, count(*) as n, count(*) filter (diagnosis = 'ocr_misread_corrected') as n_resolved from ({ORACLE['j5_vote']}) group by diagnosis")
def k7_diagnosis_counts(spark: SparkSession, d: str) -> DataFrame:
    return runs.diagnosis_counts(j5_vote(spark, d))


@query("select round(avg(o_totalprice), 6) as mean_elapsed, count(*) as n from orders where o_orderstatus = 'F'")
def k8_mean_elapsed(spark: SparkSession, d: str) -> DataFrame:
    return runs.mean_elapsed(table(spark, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "ok").otherwise("x").alias("status"), F.col("o_totalprice").alias("elapsed")))


@query("""
select doc_id, count(*) as n_notes, sum(cardinality(raw_amounts))::bigint as total_amounts, count(*) < 3 as thin_extraction, sum(cardinality(raw_amounts)) < 20 as few_amounts
from (select distinct doc_id, nr, raw_amounts from noter) group by doc_id""")
def k10_audit_flags(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "noter").groupBy("doc_id", "nr").agg(F.min_by("raw_amounts", "raw_text").alias("raw_amounts"))
    return runs.audit_flags(n)


@query()
def k12_notes_flow(spark: SparkSession, d: str) -> DataFrame:
    """Pages to notes to scaled facts, end to end."""
    found = notes.segment(_note_pages(spark, d))
    found = found.repartition(tasks(table(spark, d, "noter")), "doc_id", "nr").withColumn("scale", amounts.detect_scale(F.col("raw_text")))
    values = kv.key_values(kv.facts(found, keep=("doc_id", "nr", "scale")), keep=("doc_id", "nr", "scale"))
    return values.select("doc_id", "nr", "amount_key", (F.col("value") * F.col("scale")).alias("amount"))


@query("""
with n as (select distinct doc_id, nr, tittel, raw_text from noter where raw_text is not null)
select n.doc_id, count(*)::int as n_pages_sent, count(distinct nr)::int as n_notes, 'ok' as status, 0.0::double as cost_usd, max(r.orgnr) as orgnr from n left join (select doc_id, max(orgnr) as orgnr from records group by doc_id) r on r.doc_id = n.doc_id group by n.doc_id""")
def k12_payload(spark: SparkSession, d: str) -> DataFrame:
    """Pages to the nested payload of a document's notes."""
    texts = cut(_note_pages(spark, d))
    found = cut(notes.segment(texts))
    values = kv.key_values(kv.facts(found)).groupBy("doc_id", "nr").agg(F.map_from_entries(F.collect_list(F.struct("amount_key", "value"))).alias("raw_amounts"))
    full = notes.enrich(found.join(values, ["doc_id", "nr"], "left").withColumn("raw_amounts", F.coalesce("raw_amounts", F.create_map().cast("map<string,double>"))), head=None)
    files = table(spark, d, "records").groupBy("doc_id").agg(F.max("orgnr").alias("orgnr"), F.max("year").alias("year"), F.max("pdf_sha256_prefix").alias("pdf_hash"))
    made = flow.notes_payload(full, texts, files, {"prompt_name": "boxes", "input_mode": "text"})
    return made.select("doc_id", F.col("n_pages_sent").cast("int").alias("n_pages_sent"), "n_notes", "status", "cost_usd", "orgnr")


_TOL = "greatest(abs({0}) * 0.01, 1000)"


@query(f"""
with h as ({_HITS}), f as (select h.doc_id, h.canonical as field, s.label, v, p, h.doc_id % 4 = 1 as grp from h join (values {_LABELS}) s(field, label, ord) on s.field = h.canonical where h.doc_id % 10 <> 0),
l as (select *, label || chr(9) || array_to_string(list_transform(case when grp then [v * 30, p * 40, v, p] else [v, p] end, lambda x: coalesce(cast(x::bigint as varchar), '')), chr(9)) as line, case when grp then [v * 30, p * 40, v, p] else [v, p] end as cells from f),
m as (select *, list_filter(cells, lambda x: x is not null and (x < 0 or x >= 10000)) as big from l),
e as (select doc_id, field, case when grp then big[-2] when not {_SHORT.format("v")} then v end as v from m where case when grp then len(big) >= 2 else p is not null and not {_SHORT.format("p")} and v is not null end),
a as (select doc_id, field, max(api) as api from checks where api is not null and doc_id % 10 <> 0 and doc_id in (select doc_id from field_hits) group by all),
ev as (select * from e where v is not null),
c as (select coalesce(ev.doc_id, a.doc_id) as doc_id, coalesce(ev.field, a.field) as field, v, api, try_cast(api as double) as w from ev full outer join a on ev.doc_id = a.doc_id and ev.field = a.field),
k as (select *, case when api is null then 'api' when v is null then 'extracted' end as missing, case when api is null then null when v is null then false else coalesce(abs(v - w) <= {_TOL.format("w")}, false) end as tolerance_ok from c),
sm as ({_SUMMARY}),
q as (select k.doc_id, k.field, k.v, trunc(w) as w, s.label from k join (values {_LABELS}) s(field, label, ord) on s.field = k.field where ((missing is null and not tolerance_ok) or missing = 'extracted') and w is not null),
o as (select q.doc_id, q.field, min(struct_pack(line := m.line, big := m.big)) as first from q join m on m.doc_id = q.doc_id and starts_with(lower(m.line), lower(q.label)) and regexp_matches(substr(m.line, length(q.label) + 1), '^($|[\\t :.,0-9-])') group by all),
r as (select q.*, case when len(first.big) >= 2 then trunc(first.big[-2]) else trunc(first.big[1]) end as again, q.doc_id % 2 = 0 as even from q left join o on o.doc_id = q.doc_id and o.field = q.field),
t as (select *, (coalesce(abs(again - w) <= {_TOL.format("w")}, false))::int + (case when even then 2 else 0 end) as na, coalesce((abs(again - v) <= {_TOL.format("v")})::int, 0) + coalesce((case when even and abs(w - v) <= {_TOL.format("v")} then 2 else 0 end), 0) as nt from r),
g as (select *, case when (na >= 2 and na > nt) or (na = nt and na > 0) then w when nt >= 2 and nt > na then v when even then w else again end as x from t),
n as (select g.doc_id, count(*) filter (abs(x - try_cast(a.api as double)) <= {_TOL.format("try_cast(a.api as double)")}) as n_recovered from g join a on a.doc_id = g.doc_id and a.field = g.field where x is not null group by g.doc_id),
d as (select distinct doc_id from field_hits where doc_id is not null)
select d.doc_id, case when d.doc_id % 10 = 0 then 'skipped_legacy_format' else 'ok' end as status, case when d.doc_id % 10 = 0 then null else coalesce((case d.doc_id % 3 when 0 then 'smaa' when 1 then 'store' else case when d.doc_id % 4 = 1 then 'store' end end) || (case when d.doc_id % 4 = 1 then '_konsern' else '_selskap' end), 'unknown') end as setup,
  case when d.doc_id % 10 = 0 then 0 else 2 end as n_brreg, case when d.doc_id % 10 = 0 then 3 else 1 end as n_company, case when d.doc_id % 10 <> 0 then coalesce(n_pass, 0) end as n_pass, case when d.doc_id % 10 <> 0 then coalesce(n_fail, 0) end as n_fail,
  case when d.doc_id % 10 <> 0 then coalesce(n_missing_extract, 0) end as n_missing_extract, case when d.doc_id % 10 <> 0 then coalesce(n_missing_api, 0) end as n_missing_api, case when d.doc_id % 10 <> 0 then coalesce(disagreements, []) end as disagreements, case when d.doc_id % 10 <> 0 then coalesce(n_recovered, 0) end as n_recovered
from d left join sm on sm.doc_id = d.doc_id left join n on n.doc_id = d.doc_id""")
def k13_statement_flow(spark: SparkSession, d: str) -> DataFrame:
    """Page sizes, first pages and statement pages of every filing to checked values. Filings divisible by ten have no registry pages; of the others a quarter are groups."""
    values = _statement_values(spark, d)
    docs = table(spark, d, "field_hits").where("doc_id is not null").select("doc_id").distinct()
    k = lambda n: F.col("doc_id") % n
    dims = docs.select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("page")).select("doc_id", "page", F.when((F.col("page") < 3) & (k(10) != 0), 1728).otherwise(1653).alias("img_w"), F.lit(2339).alias("img_h"))
    said = F.concat_ws("\n", F.when(k(3) == 0, "Regler for små foretak benyttet: Ja").when(k(3) == 1, "Regler for små foretak benyttet: Nei"), F.when(k(4) == 1, "Morselskap i konsern: Ja").otherwise("Morselskap i konsern: Nei"))
    first = docs.select("doc_id", F.lit(1).alias("page_no"), said.alias("text"))
    v, p = F.col("v"), F.col("p")
    group = k(4) == 1
    rest = _statement_pages(values.where(group), [v * 30, p * 40, v, p], 2).unionByName(_statement_pages(values.where(~group), [v, p], 2))
    api = _registry(spark, d).join(docs, "doc_id", "left_semi")
    even = api.where(k(2) == 0).select("doc_id", "field", F.col("value").try_cast("double").cast("bigint").alias("value"))
    return flow.statement_flow(dims, first.unionByName(rest), api, field_spec(spark), [even, even])

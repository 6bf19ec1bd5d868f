"""Queries of the general data problems: each runs over its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordfacts.operators import drift, nested, setdiff, units
from fjordfacts.session import cut, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = units.missing_exponents(table(spark, sf_dir, "noter"))
    return found.where("exp10 <> 0").select("doc_id", "nr", "amount_key", "exp10")


def p2_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.common_amounts(table(spark, sf_dir, "noter"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten(table(spark, sf_dir, "raw_records"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = cut(drift.profiles(drift.members(table(spark, sf_dir, "raw_records"))))
    return drift.changes(profile).select("run_tag", "file_seq", "change", "field_old", "field_new")


def p4_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent table: one row per record, with its fields under the first name and the common type each has in its run."""
    members = cut(drift.members(table(spark, sf_dir, "raw_records"), keep="raw_id"))
    profile = cut(drift.profiles(members))
    return drift.unified(members, drift.changes(profile))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setdiff.statement_differences(table(spark, sf_dir, "field_hits"), table(spark, sf_dir, "checks"))


QUERIES = {f.__name__: f for f in (p2_found, p2_amounts, p3_found, p4_found, p4_unified, p6_found)}

_NUM = """
    (case when {0} is null then null else
      (case when regexp_matches({0}, '^\\s*(\\(|-)|-\\s*$') then -1 else 1 end) *
      try_cast(case when regexp_matches(regexp_replace(lower({0}), '[^0-9.,e+-]', '', 'g'), '^-?[0-9]{{1,3}}(\\.[0-9]{{3}})+(,[0-9]*)?$|,')
        then replace(replace(regexp_replace(lower({0}), '[^0-9.,]', '', 'g'), '.', ''), ',', '.')
        else ltrim(regexp_replace(replace(lower({0}), 'kr', ''), '[^0-9.e+]', '', 'g'), '-') end as double) end)"""
_LABEL = "regexp_replace(trim(regexp_replace(lower({0}), '[\\s\\x{{00A0}}]+', ' ', 'g')), '\\s*:$', '')"

ORACLE = {
    "p6_found": f"""
with h as (
  select doc_id, canonical as field, value, value_prev, page_idx, {_LABEL.format("label_matched")} as label_matched
  from (select distinct * exclude (raw_line) from field_hits)
  qualify row_number() over (partition by doc_id, canonical order by loaded_at desc, value desc, value_prev desc, page_idx desc) = 1),
c as (
  select doc_id, field, {_NUM.format("extracted")} as value, {_NUM.format("extracted_prev")} as value_prev, page_idx, {_LABEL.format("label_matched")} as label_matched
  from (select * from (select distinct * from checks)
        qualify row_number() over (partition by doc_id, field order by loaded_at desc, extracted desc, extracted_prev desc) = 1)
  where missing is distinct from 'extracted'),
j as (select coalesce(h.doc_id, c.doc_id) as doc_id, coalesce(h.field, c.field) as field, h.doc_id is null as no_h, c.doc_id is null as no_c,
  h.value as v1, c.value as v2, h.value_prev as p1, c.value_prev as p2, h.page_idx as i1, c.page_idx as i2, h.label_matched as l1, c.label_matched as l2
  from h full outer join c on h.doc_id = c.doc_id and h.field = c.field)
select doc_id, field, 'missing_in_checks' as what from j where no_c
union all select doc_id, field, 'missing_in_field_hits' from j where no_h
union all select doc_id, field, 'value' from j where not no_c and not no_h and v1 is distinct from v2
union all select doc_id, field, 'value_prev' from j where not no_c and not no_h and p1 is distinct from p2
union all select doc_id, field, 'page_idx' from j where not no_c and not no_h and i1 is distinct from i2
union all select doc_id, field, 'label_matched' from j where not no_c and not no_h and l1 is distinct from l2""",
    "p3_found": """
with recursive u(j) as (select null),
j as (select distinct raw_id, cast(payload as json) as p from raw_records where json_valid(payload)),
top as (select raw_id, p->'manifest' as m, p->'noter' as n, p->'validation' as v from j),
w as (select raw_id,
  case when json_type(m) = 'VARCHAR' then cast(m->>'$' as json) else m end as m,
  case when json_type(n) = 'VARCHAR' then cast(n->>'$' as json) else n end as n,
  case when json_type(v) = 'VARCHAR' then cast(v->>'$' as json) else v end as v from top),
pl as (select raw_id, case when json_type(m->'pages') = 'VARCHAR' then cast(m->>'pages' as json) else m->'pages' end as a from w),
pages as (
  select raw_id, unnest(cast(a as json[])) as e from pl where json_type(a) = 'ARRAY'
  union all select raw_id, a from pl where json_type(a) = 'OBJECT'),
pg as (select raw_id, case when json_type(e) = 'VARCHAR' then cast(e->>'$' as json) else e end as e from pages where json_type(e) <> 'NULL'),
zl as (select raw_id, e->>'page' as pk, case when json_type(e->'zones') = 'VARCHAR' then cast(e->>'zones' as json) else e->'zones' end as a from pg),
zones as (
  select raw_id, pk, unnest(cast(a as json[])) as e from zl where json_type(a) = 'ARRAY'
  union all select raw_id, pk, a from zl where json_type(a) = 'OBJECT'),
notes as (
  select raw_id, null as given, unnest(cast(n as json[])) as e from w where json_type(n) = 'ARRAY'
  union all select raw_id, null, n from w where json_type(n) = 'OBJECT' and json_exists(n, '$.nr')
  union all select raw_id, k, json_extract(n, '$."' || k || '"') from (select raw_id, n, unnest(json_keys(n)) as k from w where json_type(n) = 'OBJECT' and not json_exists(n, '$.nr'))),
nn as (select raw_id, coalesce(e->>'nr', given) as nr, case when json_type(e->'raw_amounts') = 'VARCHAR' then cast(e->>'raw_amounts' as json) else e->'raw_amounts' end as a from notes where json_type(e) = 'OBJECT'),
am as (
  select raw_id, nr, unnest(json_keys(a)) as label from nn where json_type(a) = 'OBJECT'
  union all select raw_id, nr, e->>'label' from (select raw_id, nr, unnest(cast(a as json[])) as e from nn where json_type(a) = 'ARRAY')),
cl as (select raw_id, case when json_type(v->'checks') = 'VARCHAR' then cast(v->>'checks' as json) else v->'checks' end as a from w),
checks as (
  select raw_id, null as given, unnest(cast(a as json[])) as e from cl where json_type(a) = 'ARRAY'
  union all select raw_id, null, a from cl where json_type(a) = 'OBJECT' and json_exists(a, '$.field')
  union all select raw_id, k, json_extract(a, '$."' || k || '"') from (select raw_id, a, unnest(json_keys(a)) as k from cl where json_type(a) = 'OBJECT' and not json_exists(a, '$.field')))
select distinct * from (
select raw_id, 'page' as child, '' as parent_key, e->>'page' as item_key from pg
union all select raw_id, 'zone', pk, e->>'y0' from zones where json_type(e) = 'OBJECT'
union all select raw_id, 'note', '', nr from nn
union all select raw_id, 'amount', nr, label from am
union all select raw_id, 'check', '', coalesce(e->>'field', given) from checks where json_type(e) = 'OBJECT')
where item_key is not null""".replace("with recursive u(j) as (select null),\nj as", "with j as"),
}

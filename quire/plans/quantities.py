"""Queries on amounts in different units (problem 1) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import units
from quire.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return units.misread_amounts(table(spark, d, "facts"), table(spark, d, "unit_reference"))


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per family: how many facts state an amount, and the least and greatest amount in the common unit."""
    df = units.to_common_units(table(spark, d, "facts").select("value_raw", "value_num", "unit", "context"), table(spark, d, "unit_reference"))
    return df.where("common_amount is not null").groupBy("unit_family", "common_unit").agg(
        F.count("*").alias("n_amounts"), F.round(F.min("common_amount"), 2).alias("least"), F.round(F.max("common_amount"), 2).alias("most"))


def p1_unread(spark: SparkSession, d: str) -> DataFrame:
    """What is printed beside numbers and not known as a unit or scale; percentages are among it."""
    return units.unread_spellings(table(spark, d, "facts").select("value_raw", "unit"), table(spark, d, "unit_reference"))


def p1_defaulted(spark: SparkSession, d: str) -> DataFrame:
    """Amounts of facts with no unit anywhere, by the default of their document: the unit that most of its facts print."""
    facts, reference = table(spark, d, "facts").select("fact_id", "document", "value_raw", "unit", "context"), table(spark, d, "unit_reference")
    df = units.to_common_units(facts, reference, units.source_defaults(facts, reference))
    plain = units.to_common_units(facts, reference).where("common_amount is null").select("fact_id")
    return df.where("common_amount is not null").join(plain, "fact_id", "left_semi").select("fact_id", "common_unit", F.round("common_amount").cast("bigint").alias("common_value"))


def _words(spellings: dict) -> str:
    def split(text: str) -> list[str]:
        return [a for part in text.split("|") for a in ([part] if " " in part and part.split()[0] in units.PHRASES else part.split())]

    return ", ".join(f"('{a}', '{u}')" for u, text in spellings.items() for a in split(text))


def _amounts_sql() -> str:
    quoted = lambda s: s.replace("'", "''")
    scales = ", ".join(f"('{quoted(a)}', {f:.1f}::double)" for f, text in units.SCALE_SPELLINGS.items() for a in text.split("|"))
    space = r"[\s\x{A0}\x{202F}\x{2009}]"
    clean = lambda x: rf"trim(regexp_replace(lower(regexp_replace({x}, '(^|\s)M(\s|$)', '\1million\2', 'g')), '{space}+', ' ', 'g'))"
    num = "regexp_extract(value_raw, pat, 3) || '#'"
    for _ in range(3):
        num = rf"regexp_replace({num}, '[.,\s\x{{A0}}\x{{202F}}\x{{2009}}]([0-9]{{3}})([^0-9])', '\1\2', 'g')"
    return rf"""
with u(a, unit_name) as (values {_words(units.UNIT_SPELLINGS)}), s(w, f) as (values {scales}),
pairs as (select w || x.of_word as spelling, f, null as unit_name, 1 as rank from s, (values (''), (' de'), (' of')) x(of_word)
  union all select replace(replace(p, 'S', w), 'U', a), f, unit_name, 2 from s, u, (values ('S U'), ('S de U'), ('S of U'), ('U S'), ('U in S'), ('U S de'), ('U S of')) t(p)
  union all select a, 1.0, unit_name, 0 from u),
names as (select p.spelling, arg_min(p.f, p.rank) f, arg_min(coalesce(p.unit_name, ''), p.rank) unit_name from pairs p group by 1),
named as (select spelling, f, family, common_unit, factor, r.unit_name from names left join unit_reference r using (unit_name)),
cut as (select *, '{quoted(units.CELL)}' as pat, '{quoted(units.HEADING)}' as hpat from facts),
parts as (select *, regexp_extract(value_raw, pat, 2) sg, regexp_extract(value_raw, pat, 4) cl,
  try_cast(regexp_replace(replace({num}, '#', ''), '[,\s\x{{A0}}\x{{202F}}\x{{2009}}]', '.', 'g') as double) as n,
  {clean("trim(regexp_extract(value_raw, pat, 1)) || ' ' || regexp_extract(value_raw, pat, 5)")} as cell, {clean("coalesce(unit, '')")} as field,
  {clean("regexp_replace(regexp_replace(trim(regexp_extract(coalesce(context,''), hpat, 1) || regexp_extract(coalesce(context,''), hpat, 2) || regexp_extract(coalesce(context,''), hpat, 3) || regexp_extract(coalesce(context,''), hpat, 4)), '^(in|en|em) ', ''), '^በ', '')")} as head from cut),
looked as (select p.*, c.spelling cs, w.spelling ws, h.family hfam, h.common_unit hcu, h.factor hf, h.f hscale,
  case when cell = 'm' and coalesce(h.family = 'money', false) then null else c.family end cfam, c.common_unit ccu, c.factor cf,
  case when cell = 'm' and coalesce(h.family = 'money', false) then 1e6 else c.f end cscale,
  case when field = 'm' and coalesce(h.family = 'money', false) then null else w.family end wfam, w.common_unit wcu, w.factor wf,
  case when field = 'm' and coalesce(h.family = 'money', false) then 1e6 else w.f end wscale
  from parts p left join named c on p.cell = c.spelling left join named w on p.field = w.spelling left join named h on p.head = h.spelling),
amounts as (select fact_id, document, n, cell, field, sg, cl, coalesce(nullif(cscale, 1), nullif(wscale, 1), nullif(hscale, 1), 1)::double as free_scale, value_num, case when cfam is not null then cfam when wfam is not null then wfam else hfam end as unit_family,
  case when cfam is not null then ccu when wfam is not null then wcu else hcu end as common_unit,
  case when sg like '%(%' then case when cl = ')' then -1.0 end when sg <> '' then -1.0 else 1.0 end::double * n
  * (case when cfam is not null then cscale else coalesce(nullif(cscale, 1), nullif(wscale, 1), nullif(hscale, 1), 1) end)::double
  * case when cfam is not null then cf when wfam is not null then wf else hf end as amount
  from looked where (cell = '' or cs is not null) and (field = '' or ws is not null))
"""


QUERIES = {"p1_found": p1_found, "p1_totals": p1_totals, "p1_unread": p1_unread, "p1_defaulted": p1_defaulted}
SQL = {
    "p1_found": _amounts_sql() + "select distinct fact_id, common_unit, round(amount)::bigint as common_value from amounts where amount is not null and common_unit is not null and not coalesce(round(value_num) = round(amount), false)",
    "p1_totals": _amounts_sql() + "select unit_family, common_unit, count(*) as n_amounts, round(min(amount), 2) as least, round(max(amount), 2) as most from amounts where amount is not null group by 1, 2",
    "p1_defaulted": _amounts_sql() + """, said as (select p.document, coalesce(c.unit_name, w.unit_name, h.unit_name) as unit_name from parts p left join named c on p.cell = c.spelling and c.family is not null left join named w on p.field = w.spelling and w.family is not null left join named h on p.head = h.spelling and h.family is not null),
usual as (select document, arg_min(unit_name, (-n, unit_name)) as unit_name from (select document, unit_name, count(*) as n from said where unit_name is not null and document is not null group by 1, 2) group by 1)
select fact_id, r.common_unit, round(case when sg like '%(%' then case when cl = ')' then -1.0 end when sg <> '' then -1.0 else 1.0 end::double * n * free_scale * r.factor)::bigint as common_value
from amounts a join usual using (document) join unit_reference r using (unit_name) where a.unit_family is null and n is not null and not (sg like '%(%' and cl <> ')')""",
}

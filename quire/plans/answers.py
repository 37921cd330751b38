"""Queries on tables, facts, claims and questions, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import answers, tables
from quire.session import table


def table_checks(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "elements").where("kind = 'table'")
    return t.select("element_id", F.array_join(tables.failed_checks(F.col("table_data.headers"), F.col("table_data.rows")), ",").alias("failed"), tables.period_major(F.col("table_data.headers"), F.col("table_data.rows")).alias("down"))


def table_contexts(spark: SparkSession, d: str) -> DataFrame:
    return tables.contexts(table(spark, d, "elements"))


def table_facts(spark: SparkSession, d: str) -> DataFrame:
    f = tables.unpivoted(table(spark, d, "elements"), table(spark, d, "page_profiles"))
    return f.select("doc_id", "element_id", "key", "period", "value_raw", F.round("value", 4).alias("value"), "unit", "context", "document", "page", "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1", "content_hash", "skipped")


def table_parts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "elements").where("kind = 'table'")
    return t.select("element_id", F.posexplode(tables.split_parts(F.col("table_data.headers"), F.col("table_data.rows"), 40)).alias("part", "content")).select("element_id", "part", F.md5("content").alias("content_md5"), X.token_estimate(F.col("content")).alias("tokens"))


def captions_single(spark: SparkSession, d: str) -> DataFrame:
    """Captions and headings welded to themselves, and cleaned again."""
    c = table(spark, d, "facts").where("context is not null").select("context").distinct()
    welded = F.concat("context", "context")
    return c.select("context", tables.single_caption(welded).alias("halved"), tables.single_caption(F.concat("context", F.lit(" "), "context")).alias("last_sign"))


def table_repair(spark: SparkSession, d: str) -> DataFrame:
    t = tables.repair(table(spark, d, "elements"))
    return t.select("element_id", F.array_join("headers", "|").alias("headers"), F.size("rows").alias("rows"), F.array_join(F.flatten("rows"), "|").alias("cells"), F.array_join("row_periods", "|", "-").alias("periods"), "context")


def table_repair_padded(spark: SparkSession, d: str) -> DataFrame:
    """The same of each table as a grid detector may report it: every row shifted by empty cells, a row with a period above each, its last words on a row of their own."""
    t = table(spark, d, "elements").where("kind = 'table' and size(table_data.rows) > 0 and size(table_data.headers) > 1")
    blank = F.array(*[F.lit("")] * 9)
    shift = lambda r: F.concat(F.slice(blank, 1, 2), F.flatten(F.transform(r, lambda c: F.array(F.coalesce(c, F.lit("")), F.lit("")))), blank)
    rows = F.flatten(F.transform("table_data.rows", lambda r, i: F.array(F.concat(F.array(F.concat((F.lit(2000) + i % 20).cast("string"), F.lit("/21"))), blank), shift(r), F.concat(F.array(F.lit(""), F.lit("in all")), blank))))
    data = F.struct(F.concat(F.array(F.lit("")), shift("table_data.headers")).alias("headers"), rows.alias("rows"), F.lit(None).cast("array<string>").alias("row_periods"), F.lit(None).cast("string").alias("context"))
    r = tables.repair(t.withColumn("table_data", data))
    return r.select("element_id", F.array_join("headers", "|").alias("headers"), F.size("rows").alias("rows"), F.array_join(F.flatten("rows"), "|").alias("cells"), F.array_join("row_periods", "|", "-").alias("periods"))


def facts_listing(spark: SparkSession, d: str) -> DataFrame:
    """The first rows of each document in order of entry (as many as a listing shows)."""
    f = table(spark, d, "facts")
    first = f.agg(F.min("document").alias("m")).first()["m"]
    return answers.rows_for(f, first)


def facts_lookup(spark: SparkSession, d: str) -> DataFrame:
    return answers.lookup(table(spark, d, "facts"), ["fuel", "stock"]).select("fact_id", "key", "value_raw")


def sql_scoped(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "facts")
    name = f.agg(F.max("document").alias("m")).first()["m"]
    return answers.scoped_query(f, "SELECT unit, COUNT(*) AS n, COUNT(DISTINCT key) AS n_keys, MAX(value_num) AS most FROM facts GROUP BY unit ORDER BY n DESC, unit", [name])


def sql_any(spark: SparkSession, d: str) -> DataFrame:
    """A statement with a derived table, a window and a self-join, over all documents."""
    return answers.scoped_query(table(spark, d, "facts"), """SELECT document, n, n_pages, CAST(rank() OVER (ORDER BY n DESC, document) AS BIGINT) AS place FROM (SELECT document, COUNT(*) AS n, COUNT(DISTINCT page) AS n_pages FROM facts WHERE value_num IS NOT NULL AND lower(key) LIKE '%e%' GROUP BY document HAVING COUNT(*) > 5) ORDER BY place""", None, 0)


def sql_statements(spark: SparkSession, d: str) -> DataFrame:
    """Statements in the habits of their users: LIKE whatever the case, row ids, patterns, quoted names and texts."""
    f, out = table(spark, d, "facts"), None
    for n, sql in enumerate(STATEMENTS):
        one = answers.scoped_query(f, sql, None, 0)
        one = one.select(F.lit(n).alias("statement"), one.columns[0], F.col(one.columns[1]).cast("string").alias("value")).withColumnRenamed(one.columns[0], "id")
        out = one if out is None else out.unionByName(one)
    return out


STATEMENTS = [
    "SELECT rowid, key FROM facts WHERE key LIKE '%FUEL%'", "SELECT rowid, \"value_raw\" FROM facts WHERE key GLOB '*[Ff]uel*stock*' AND value_num > 5", "select f.rowid, f.key from facts f where f.key = \"Fuel stock\" -- like this",
    "SELECT MIN(rowid) AS first, printf('%d of %s', COUNT(*), unit) AS line FROM facts WHERE unit LIKE 'b%' GROUP BY unit", "SELECT rowid, context FROM facts WHERE context LIKE '%table 1%' AND value_raw NOT LIKE '%''%'",
]


def audit_routed(spark: SparkSession, d: str) -> DataFrame:
    """Each claim against three documents in order of rank: one that follows its own in the alphabet, its own, and one of no facts."""
    f = table(spark, d, "facts")
    c = _claims(spark, d).where("claim_id % 7 = 0")
    names = f.where("document is not null").select("document").distinct().select("document", F.lead("document").over(Window.orderBy("document")).alias("next"))
    c = c.join(F.broadcast(names), "document").select("claim_id", "claim", F.array_compact(F.array("next", "document", F.lit("no such file"))).alias("documents"))
    r = answers.audited_in(c, f)
    return r.select("claim_id", "status", "document", "fact_id", "printed_value", "page", "x0", F.array_join("elsewhere", "; ").alias("elsewhere"))


def _claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims made from the facts: one in three as printed, one with a wrong value, one with unknown words."""
    f = table(spark, d, "facts").where("value_num is not null and period is not null and key is not null")
    value = F.regexp_replace(F.format_string("%.2f", F.when(F.col("fact_id") % 3 == 1, F.col("value_num") + 7.25).otherwise(F.col("value_num"))), r"\.?0+$", "")
    key = F.when(F.col("fact_id") % 3 == 2, F.lit("Unheard entries")).otherwise(F.col("key"))
    return f.select(F.col("fact_id").alias("claim_id"), "document", F.concat(key, F.lit(" was "), value, F.lit(" in "), "period").alias("claim"))


def claim_parts(spark: SparkSession, d: str) -> DataFrame:
    c = _claims(spark, d)
    return c.select("claim_id", F.round(X.claim_value(F.col("claim")), 4).alias("value"), F.array_join(X.claim_words(F.col("claim")), " ").alias("words"))


def audit_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Every claim, judged against all facts of its document."""
    return answers.audited(_claims(spark, d), table(spark, d, "facts")).select(*VERDICT)


VERDICT = ["claim_id", "status", "document", "fact_id", "printed_value"]


_TABLES = "t as (select element_id, doc_id, idx, table_data.headers as h, table_data.rows as r, table_data.row_periods as b, table_data.context as cx from elements where kind = 'table')"
_PERIOD = lambda c: "coalesce(" + " or ".join(f"regexp_matches({c}, '{p}')" for p in X.PERIODS) + ", false)"
_FILLED = "coalesce(trim(c) <> '', false)"
_SHARE = lambda a: f"case when len(list_filter({a}, lambda c: {_FILLED})) > 0 then len(list_filter({a}, lambda c: {_FILLED} and {_PERIOD('c')}))::double / len(list_filter({a}, lambda c: {_FILLED})) else 0 end"
_DOWN = f"({_SHARE('list_transform(list_filter(r, lambda x: len(x) > 0), lambda x: x[1])')} > {_SHARE('h[2:]')})"
_FILL = lambda a: f"(case when len({a}) > 0 then len(list_filter({a}, lambda c: {_FILLED}))::double / len({a}) else 0 end)"
_CLEAN = r"coalesce(trim(regexp_replace(c, '\s+', ' ', 'g')), '')"
_LINE = lambda a: f"array_to_string(list_transform({a}, lambda c: {_CLEAN}), ' | ')"
_RENDER = lambda h, r: f"array_to_string(list_concat([{_LINE(h)}], list_transform({r}, lambda x: {_LINE('x')})), chr(10))"
_TOK = lambda x: f"greatest(1, ceil(length({x}) / 4))::bigint"
_PARSE = lambda raw: rf"""(case when regexp_matches({raw}, '(?i)^\(?-?[0-9,]+(?:\.[0-9]+)?\)?\s*(%|bn|billion|m|million|k|thousand)?$') then case when regexp_matches({raw}, '^\(.*\)') then -1.0 when regexp_matches({raw}, '[()]') then null else 1.0 end::double
  * try_cast(regexp_replace(regexp_replace({raw}, '(?i)\s*(%|bn|billion|m|million|k|thousand)$', ''), '[(),]', '', 'g') as double) * case lower(regexp_extract({raw}, '(?i)(bn|billion|m|million|k|thousand)$', 1)) when 'bn' then 1e9 when 'billion' then 1e9 when 'm' then 1e6 when 'million' then 1e6 when 'k' then 1e3 when 'thousand' then 1e3 else 1.0 end end)"""  # noqa: E731
# Written out apart from the operators: patterns and rules of its own.
_NUM = r"(?i)^\(?-?[\d,]+(?:\.\d+)?\)?\s*(?:%|bn|billion|m|million|k|thousand|birr|br)?$"
_IS_DATE = lambda c: f"regexp_matches(coalesce({c}, ''), '(?i)\\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)|\\befy\\s*-?\\s*\\d{{2,4}}|\\b(19|20)\\d\\d\\b|\\d{{4}}\\s*[-–/]\\s*\\d{{2,4}}|\\bq[1-4]\\b')"
_FLAT = lambda c: f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
_DATES = lambda a: f"coalesce(len(list_filter({a}, lambda c: trim(c) <> '' and {_IS_DATE('c')}))::double / nullif(len(list_filter({a}, lambda c: trim(c) <> '')), 0), 0)"
_CTX = r"""cz as (with t as (select element_id, doc_id, bbox.page as page, bbox.y0 as y0, bbox.y1 as y1, nullif(table_data.context, '') as own, substr(trim(regexp_replace(nullif(caption, ''), '\s+', ' ', 'g')), 1, 300) as cap from elements where kind = 'table'),
  c as (select doc_id, bbox.page as page, idx, bbox.y0 as a0, bbox.y1 as a1, substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 300) as words from elements where kind = 'text' and regexp_matches(trim(text), '(?i)^table\s*\d+\b')),
  n as (select element_id, arg_min(words, (gap, idx)) as near from (select element_id, words, idx, least(abs(y0 - a1), abs(a0 - y1)) as gap from t join c using (doc_id, page) where own is null and cap is null) where gap < 73 group by 1),
  one as (select element_id, own, cap, near from t left join n using (element_id)) select element_id, coalesce(""" + ", ".join(f"case when length({x}) % 2 = 0 and left({x}, length({x}) // 2) = right({x}, length({x}) // 2) then left({x}, length({x}) // 2) when len(regexp_extract_all({x}, '(?i)table\\s*\\d+\\s*:')) > 1 then regexp_extract({x}, '(?is)^.*(table\\s*\\d+\\s*:.*)$', 1) else {x} end" for x in ("own", "cap")) + """, near) as context from one)"""
_FACTS = rf"""with {_TABLES}, {_CTX}, bx as (select element_id, bbox from elements), o as (select *, {_DATES('list_transform(list_filter(r, lambda x: len(x) > 0), lambda x: x[1])')} > {_DATES('h[2:]')} as down from t where len(h) >= 2), rw as (select * exclude (r), unnest(r) as cells, generate_subscripts(r, 1) as row_no from o), lb as (select *, {_FLAT('cells[1]')} as label, nullif(b[row_no], '') as block from rw where {_FLAT('cells[1]')} <> ''),
ce as (select * exclude (cells), unnest(cells[2:len(h)]) as cell, generate_subscripts(cells[2:len(h)], 1) as cn from lb), kv as (select doc_id, element_id, idx, row_no, cn, case when down and block is null then coalesce({_FLAT('h[cn + 1]')}, '') else label end as key, coalesce(block, case when down then label else coalesce({_FLAT('h[cn + 1]')}, '') end) as period, trim(cell) as value_raw from ce where trim(cell) <> ''),
nz as (select doc_id, min(source_name) as sn from page_profiles group by 1), kd as (select kv.*, coalesce(sn, doc_id) as document from kv left join nz using (doc_id)),
g as (select document, key, period, value_raw, arg_min(element_id, (idx, row_no, cn, element_id)) as element_id, count(*) - 1 as skipped from kd where key <> '' group by 1, 2, 3, 4)"""
_CLAIM = r"""cl as (select fact_id as claim_id, document, case when fact_id % 3 = 2 then 'Unheard entries' else key end || ' was ' || regexp_replace(printf('%.2f', case when fact_id % 3 = 1 then value_num + 7.25 else value_num end), '\.?0+$', '') || ' in ' || period as claim
  from facts where value_num is not null and period is not null and key is not null),
cv as (select *, list_filter(list_transform(regexp_extract_all(lower(claim), '[a-z]{3,}'), lambda w: w), lambda w: w not in (""" + ", ".join(f"'{w}'" for w in X.CLAIM_STOP) + r""")) as words, list_filter(list_transform(regexp_extract_all(claim, '(?i)-?\$?[0-9,]+(?:\.[0-9]+)?\s*(?:%|bn|billion|m|million|k|thousand)?'), lambda x: """ + _PARSE("trim(replace(x, '$', ''))") + r"""), lambda v: v is not null) as vs from {src}),
cp as (select * exclude (vs), coalesce(list_filter(vs, lambda v: not (v = floor(v) and v between 1900 and 2100))[1], vs[1]) as value from cv)"""

QUERIES = {f.__name__: f for f in (table_checks, table_contexts, table_facts, table_parts, captions_single, table_repair, table_repair_padded, facts_listing, facts_lookup, sql_scoped, sql_any, sql_statements, claim_parts, audit_verdicts, audit_routed)}
SQL = {
    "table_checks": f"with {_TABLES} select element_id, array_to_string(list_filter([case when len(h) < 2 then 'too_few_columns' end, case when len(r) = 0 then 'no_rows' end, case when len(h) > 0 and {_FILL('h')} < 0.5 then 'empty_headers' end, case when len(r) > 0 and {_FILL('flatten(r)')} < 0.4 then 'mostly_empty_cells' end], lambda x: x is not null), ',') as failed, {_DOWN} as down from t",
    "table_contexts": f"with {_CTX} select element_id, context from cz",
    "table_facts": _FACTS + r" select t.doc_id, element_id, key, nullif(period, '') as period, value_raw, round(" + _PARSE("replace(value_raw, '$', '')") + r", 4) as value, case when " + _PARSE("replace(value_raw, '$', '')") + r" is not null then nullif(lower(regexp_extract(value_raw, '(?i)(%|bn|billion|m|million|k|thousand)$', 1)), '') end as unit, context, document, bbox.page as page, bbox.x0 as x0, bbox.y0 as y0, bbox.x1 as x1, bbox.y1 as y1, left(sha256(trim(regexp_replace(nfc_normalize(document || '|' || key || '|' || period || '|' || value_raw), '\s+', ' ', 'g'))), 16) as content_hash, skipped from g join t using (element_id) join cz using (element_id) join bx using (element_id)",
    "table_repair": f"with {_TABLES}, c as (select element_id, array_to_string(list_transform(h, lambda x: coalesce({_FLAT('x')}, '')), '|') as headers, len(r) as rows, list_transform(flatten(r), lambda x: coalesce({_FLAT('x')}, '')) as cells, b, cx from t where len(list_filter(flatten(r), lambda x: coalesce({_FLAT('x')}, '') = '')) <= 0.4 * len(flatten(r)) and len(list_filter(flatten(r), lambda x: regexp_matches(x, '\\S\\s*\\n\\s*\\S'))) = 0) select element_id, headers, rows, array_to_string(cells, '|') as cells, array_to_string(list_transform(b, lambda x: coalesce(x, '-')), '|') as periods, cx as context from c",
    "table_repair_padded": rf"""with {_TABLES}, q as (select element_id, list_filter(list_transform(h, lambda x: coalesce({_FLAT('x')}, '')), lambda x: x <> '') as m, r from t where len(h) > 1 and len(r) > 0), w as (select element_id, m, i, list_filter(list_transform(r[i], lambda x: coalesce({_FLAT('x')}, '')), lambda x: x <> '') as ws from q, unnest(range(1, len(r) + 1)) u(i)),
v as (select *, list_position(list_transform(ws, lambda x: regexp_matches(replace(x, '$', ''), '{_NUM}') and not regexp_matches(x, '(?i)(birr|br)$') and regexp_matches(x, '\d')), true) as vp from w), p as (select *, sum((vp is not null)::int) over (partition by element_id order by i) as no from v),
y as (select element_id, m, no, min(i) as i, first(vp order by i) as vp, first(ws order by i) as ws, string_agg(case when vp is null then array_to_string(ws, ' ') || case when len(ws) > 0 then ' ' else '' end else '' end || 'in all', ' ' order by i) as below from p where no > 0 group by 1, 2, 3),
z as (select *, regexp_matches(ws[1], '(?i)^((19|20)\d\d(\s*[-–/]\s*\d{{2,4}})?|efy\s*-?\s*\d{{2,4}}|q[1-4](\s*(19|20)\d\d)?|(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?(\s*(19|20)\d\d)?)$') and vp > 1 as dated from y),
x as (select element_id, m, i, list_concat([trim(array_to_string(ws[case when dated then 2 else 1 end : vp - 1], ' ') || ' ' || below)], ws[vp:]) as cells, case when dated then ws[1] else (2000 + (i - 1) % 20) || '/21' end as period from z),
k as (select element_id, any_value(m) as m, greatest(len(any_value(m)) + 1, max(len(cells))) as width, list(cells order by i) as cs, list(period order by i) as ps from x group by 1)
select element_id, array_to_string(list_resize(list_concat([''], m), width, ''), '|') as headers, len(cs) as rows, array_to_string(flatten(list_transform(cs, lambda c: list_resize(c, width, ''))), '|') as cells, array_to_string(ps, '|') as periods from k""",
    "table_parts": f"with {_TABLES}, w as (select element_id, h, r, {_RENDER('h', 'r')} as whole, {_TOK(_RENDER('h', 'r'))} as n, {_TOK(_LINE('h'))} as hd from t), e as (select *, greatest(1, floor((40 - hd) / greatest(1, floor(n / greatest(len(r), 1)))))::int as each from w), p as (select *, greatest(ceil(len(r) / each), 1)::int as parts from e), x as (select element_id, unnest(case when n <= 40 then [whole] else list_transform(range(1, parts + 1), lambda i: '[part ' || i || '/' || parts || ']' || chr(10) || {_RENDER('h', 'r[(i - 1) * each + 1 : i * each]')}) end) as content, unnest(range(case when n <= 40 then 1 else parts end)) as part from p) select element_id, part::int as part, md5(content) as content_md5, {_TOK('content')} as tokens from x",
    "captions_single": r"select context, context as halved, case when regexp_matches(context, '(?i)table\s*[0-9]+\s*:') then regexp_extract(context, '(?is)^.*(table\s*[0-9]+\s*:.*)$', 1) else context || ' ' || context end as last_sign from (select distinct context from facts where context is not null)",
    "facts_listing": "select key, period, value_raw, value_num, unit, page from facts where document = (select min(document) from facts) order by fact_id limit 1000",
    "facts_lookup": "select fact_id, key, value_raw from facts where contains(lower(key), 'fuel') and contains(lower(key), 'stock') order by fact_id limit 25",
    "sql_scoped": "select unit, count(*) as n, count(distinct key) as n_keys, max(value_num) as most from facts where document = (select max(document) from facts) group by unit order by n desc, unit nulls first limit 50",
    "sql_any": "select document, n, n_pages, rank() over (order by n desc, document) as place from (select document, count(*) as n, count(distinct page) as n_pages from facts where value_num is not null and lower(key) like '%e%' group by document having count(*) > 5)",
    "sql_statements": """select 0 as statement, fact_id as id, key as value from facts where key ilike '%fuel%' union all select 1, fact_id, value_raw from facts where regexp_full_match(key, '(?s).*[Ff]uel.*stock.*') and value_num > 5 union all select 2, fact_id, key from facts where key = 'Fuel stock'
  union all select 3, min(fact_id), count(*) || ' of ' || unit from facts where unit ilike 'b%' group by unit union all select 4, fact_id, context from facts where context ilike '%table 1%' and not contains(value_raw, chr(39))""",
    "claim_parts": "with " + _CLAIM.replace("{src}", "cl") + " select claim_id, round(value, 4) as value, array_to_string(words, ' ') as words from cp",
    "audit_routed": "with " + _CLAIM.replace("{src}", "ask").replace("cv as (", """nm as (select document, lead(document) over (order by document) as follow from (select distinct document from facts where document is not null)),
ask as (select claim_id, claim, unnest(list_filter([follow, cl.document], lambda x: x is not null)) as document, generate_subscripts(list_filter([follow, cl.document], lambda x: x is not null), 1) as rank from cl join nm using (document) where claim_id % 7 = 0), cv as (""", 1) + r""",
h as (select claim_id, claim, words, value, rank, fact_id, f.document, key, period, value_raw, value_num, page, x0, len(list_filter(range(1, len(words) + 1), lambda i: len(list_filter(words[1:i], lambda w: not contains(lower(key), w))) = 0)) as size from cp join facts f using (document) where value is not null and len(words) > 0 and contains(lower(key), words[1])),
b as (select *, row_number() over (partition by claim_id, document order by fact_id) as nth from (select *, max(size) over (partition by claim_id, document) as best from h) where size = best), k as (select *, coalesce(abs(value_num - value) <= 1e-9, false) as same, len(list_filter(list_distinct(list_concat(words, regexp_extract_all(claim, '\b(?:19|20)[0-9]{2}\b'))), lambda w: contains(lower(concat_ws(' ', key, period)), w))) as shared from b where nth <= 25),
j as (select claim_id, document, rank, bool_or(same) as ok, arg_min({'f': fact_id, 'v': value_raw, 'p': page, 'x': x0}, nth) filter (same) as proof, arg_min({'f': fact_id, 'v': value_raw, 'p': page, 'x': x0}, (-shared, nth)) as near from k group by 1, 2, 3),
z as (select claim_id, arg_min({'d': document, 'ok': ok, 'r': case when ok then proof else near end}, rank) as t from j group by 1), el as (select j.claim_id, string_agg(j.document, '; ' order by rank) as elsewhere from j join z using (claim_id) where j.ok and not z.t.ok group by 1)
select a.claim_id, case when t is null then 'UNVERIFIABLE' when t.ok then 'VERIFIED' else 'REFUTED' end as status, t.d as document, t.r.f as fact_id, t.r.v as printed_value, t.r.p as page, t.r.x as x0, coalesce(elsewhere, '') as elsewhere from (select distinct claim_id from ask) a left join z using (claim_id) left join el using (claim_id)""",
    "audit_verdicts": "with " + _CLAIM.replace("{src}", "cl") + r""",
h as (select claim_id, claim, words, value, fact_id, f.document, key, period, value_raw, value_num, len(list_filter(range(1, len(words) + 1), lambda i: len(list_filter(words[1:i], lambda w: not contains(lower(key), w))) = 0)) as size from cp join facts f using (document) where value is not null and len(words) > 0 and contains(lower(key), words[1])),
b as (select *, row_number() over (partition by claim_id order by fact_id) as nth from (select *, max(size) over (partition by claim_id) as best from h) where size = best), k as (select *, coalesce(abs(value_num - value) <= 1e-9, false) as same, len(list_filter(list_distinct(list_concat(words, regexp_extract_all(claim, '\b(?:19|20)[0-9]{2}\b'))), lambda w: contains(lower(concat_ws(' ', key, period)), w))) as shared from b where nth <= 25),
j as (select claim_id, bool_or(same) as ok, arg_min({'f': fact_id, 'd': document, 'v': value_raw}, nth) filter (same) as proof, arg_min({'f': fact_id, 'd': document, 'v': value_raw}, (-shared, nth)) as near from k group by 1),
z as (select claim_id, ok, case when ok then proof else near end as r from cp left join j using (claim_id)) select claim_id, case when ok is null then 'UNVERIFIABLE' when ok then 'VERIFIED' else 'REFUTED' end as status, r.d as document, r.f as fact_id, r.v as printed_value from z""",
}

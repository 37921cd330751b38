"""Queries on pages, labels and the ledger, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import ledgers, triage
from quire.sources import stores
from quire.session import table

_SIGNAL = lambda k: F.col("signals")[k]


def parsed_cells(spark: SparkSession, d: str) -> DataFrame:
    value, unit = X.parse_number(F.col("value_raw"))
    return table(spark, d, "facts").select("fact_id", F.round(value, 4).alias("value"), unit.alias("cell_unit"))


def period_cells(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "facts").select("key", "period", X.is_period(F.col("key")).alias("key_reads_as_period"), X.is_period(F.col("period")).alias("period_reads_as_period"))
    return df.groupBy("key_reads_as_period", "period_reads_as_period").agg(F.count("*").alias("n"), F.count_distinct("key").alias("n_keys"))


def content_hash_groups(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "chunks").select("chunk_id", "doc_id", X.content_hash(F.col("content")).alias("hash"))
    return h.groupBy("hash").agg(F.count("*").alias("copies"), F.count_distinct("doc_id").alias("docs"), F.min("chunk_id").alias("first_chunk")).where("copies > 1")


def page_signals(spark: SparkSession, d: str) -> DataFrame:
    p = triage.page_text(table(spark, d, "elements"))
    return p.select("doc_id", "page", "n_chars", triage.density(F.col("n_chars")).alias("char_density"), "ethiopic_chars", "latin_chars", triage.language(F.col("ethiopic_chars"), F.col("latin_chars")).alias("language"),
                    triage.domain({x: F.col(f"votes_{x}") for x in triage.DOMAINS}).alias("domain_hint"))


def page_rules(spark: SparkSession, d: str) -> DataFrame:
    """The labels of each profile from its signals, its page's columns, and its lines (flat boxes of elements stand for the strokes of rules)."""
    p = table(spark, d, "page_profiles").select("profile_id", "doc_id", "page", F.coalesce(_SIGNAL("char_density"), F.lit(0.0)).alias("d"), F.coalesce(_SIGNAL("image_area_ratio"), F.lit(0.0)).alias("i"))
    p = p.join(page_columns(spark, d), ["doc_id", "page"], "left").join(triage.ruled_lines(table(spark, d, "elements"), 100.0, 12.0), ["doc_id", "page"], "left")
    o = triage.origin(F.col("d"), F.col("i"))
    layout = triage.layout(o, F.coalesce("ruled", F.lit(0)), F.coalesce("columns", F.lit(0)), F.col("i"))
    return p.select("profile_id", o.alias("origin"), layout.alias("layout"), triage.rung(o).alias("rung"), triage.confidence(o, F.col("d"), F.col("i")).alias("confidence"))


def page_texts(spark: SparkSession, d: str) -> DataFrame:
    return triage.page_texts(table(spark, d, "elements")).select("doc_id", "page", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def value_formats(spark: SparkSession, d: str) -> DataFrame:
    """Values as a verdict prints them."""
    return table(spark, d, "facts").where("value_num is not null").select("fact_id", X.general(F.col("value_num")).alias("printed"), X.general(F.col("value_num") / 1e9).alias("billions"))


def prompts_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Questions made of the facts, by the unit they ask for, and how many are about files that were never profiled."""
    q = table(spark, d, "facts").where("unit is not null").select(F.lower("unit").alias("group"), "key", "document")
    return stores.prompts_listed(q, table(spark, d, "page_profiles"))


def language_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose label is missing or unknown, with the language their text shows."""
    p = table(spark, d, "page_profiles").where("language is null or trim(lower(language)) in ('', 'unknown', 'und', 'n/a')").select("profile_id", "doc_id", "page")
    t = triage.page_text(table(spark, d, "elements"))
    lang = F.when(F.col("ethiopic_chars") > F.col("latin_chars"), "am").when(F.col("latin_chars") > 20, "en")
    return p.join(t, ["doc_id", "page"]).select("profile_id", lang.alias("language")).where("language is not null")


def dominant_origin(spark: SparkSession, d: str) -> DataFrame:
    return triage.dominant_origin(table(spark, d, "page_profiles"))


def triage_counters(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "page_profiles").createOrReplaceTempView("__profiles")
    return spark.sql("select case grouping_id() when 3 then 'origin' when 5 then 'rung' else 'language' end as counter, coalesce(origin_type, recommended_rung, language) as label, count(*) as pages from __profiles group by grouping sets ((origin_type), (recommended_rung), (language))")


def page_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of each page by the starts of its elements' boxes (an element stands for its words here)."""
    e = table(spark, d, "elements").groupBy("doc_id", F.col("bbox.page").alias("page")).agg(F.collect_list("bbox.x0").alias("xs"))
    return e.select("doc_id", "page", triage.column_starts(F.col("xs"), least=3).alias("columns"))


def doc_medians(spark: SparkSession, d: str) -> DataFrame:
    p = triage.page_text(table(spark, d, "elements"))
    return p.groupBy("doc_id").agg(F.median("n_chars").alias("median_chars"), F.count("*").alias("pages"))


def ledger_latest_page(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.latest_per_page(table(spark, d, "ledger")).select("doc_id", "page", "entry_id", "run_id", "strategy_used")


def ledger_latest_run(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.latest_run(table(spark, d, "ledger")).select("doc_id", "page", "entry_id", "run_id")


def ledger_replays(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.without_replays(table(spark, d, "ledger").select("run_id", "run_seq", "entry_id", "arrived_at", "doc_id")).select("run_id", "run_seq", "entry_id", "doc_id")


def ledger_rollup(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.rollup(ledgers.latest_per_page(table(spark, d, "ledger")))


def ledger_repair(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.duplicates(table(spark, d, "ledger"))


def ledger_trace(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.trace(table(spark, d, "page_profiles"), table(spark, d, "ledger"))


def budget_cutoff(spark: SparkSession, d: str) -> DataFrame:
    kept = ledgers.within_budget(table(spark, d, "ledger").select("doc_id", "run_id", "run_seq", "entry_id", "cost_estimate_usd"), 0.002)
    return kept.groupBy("doc_id", "run_id").agg(F.count("*").alias("kept"), F.max("spent_before").alias("spent_before_last"))


def pending_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the profiles that the ledger has no row of: what a resumed run still has to do."""
    return table(spark, d, "page_profiles").select("doc_id").distinct().join(table(spark, d, "ledger").select("doc_id").distinct(), "doc_id", "left_anti")


def documents_listing(spark: SparkSession, d: str) -> DataFrame:
    """Each profiled document with pages, main origin, spend and vision pages; those with chunks first, then by name."""
    p = table(spark, d, "page_profiles")
    names = p.groupBy("doc_id").agg(F.min("source_name").alias("source_name"), F.count_distinct("page").alias("pages"))
    spent = ledgers.rollup(ledgers.latest_per_page(table(spark, d, "ledger"))).select("doc_id", "spend", "vision_pages")
    has = table(spark, d, "chunks").select("doc_id").distinct().withColumn("ingested", F.lit(True))
    out = names.join(triage.dominant_origin(p).select("doc_id", "dominant_origin"), "doc_id").join(spent, "doc_id", "left").join(has, "doc_id", "left").fillna({"ingested": False})
    return out.orderBy(F.desc("ingested"), "source_name")


_PARSE = r"""with c as (select fact_id, replace(trim(value_raw), '$', '') as s from facts),
e as (select *, lower(regexp_extract(s, '(?i)^\(?-?[0-9,]+(?:\.[0-9]+)?\)?\s*(%|bn|billion|m|million|k|thousand|birr|br)?$', 1)) as suf, regexp_matches(s, '(?i)^\(?-?[0-9,]+(?:\.[0-9]+)?\)?\s*(%|bn|billion|m|million|k|thousand|birr|br)?$') as ok,
  trim(regexp_replace(s, '(?i)\s*(%|bn|billion|m|million|k|thousand)$', '')) as body from c),
v as (select fact_id, suf, case when ok and suf not in ('birr', 'br') then case when body like '(%' and body like '%)' then -1.0 when body like '%(%' or body like '%)%' then null else 1.0 end::double
  * try_cast(regexp_replace(body, '[(),]', '', 'g') as double) * case suf when 'bn' then 1e9 when 'billion' then 1e9 when 'm' then 1e6 when 'million' then 1e6 when 'k' then 1e3 when 'thousand' then 1e3 else 1.0 end end as value from e)
select fact_id, round(value, 4) as value, case when value is not null and suf <> '' then suf end as cell_unit from v"""
_IS_PERIOD = lambda c: "coalesce(" + " or ".join(f"regexp_matches({c}, '{p}')" for p in X.PERIODS) + ", false)"
_VOTES = ", ".join(f"sum(len(regexp_extract_all(lower(coalesce(text, '')), '\\b({'|'.join(ws)})\\b'))) as votes_{d}" for d, ws in triage.DOMAINS.items())
_PAGES = rf"""pg as (select doc_id, bbox.page as page, sum(length(regexp_replace(coalesce(text, ''), '[\s\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{85}}\x{{0B}}]', '', 'g')))::bigint as n_chars,
 sum(length(regexp_replace(coalesce(text, ''), '[^ሀ-፿ᎀ-᎟ⶀ-⷟꬀-꬯]', '', 'g')))::bigint as ethiopic_chars, sum(length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')))::bigint as latin_chars, {_VOTES} from (select * replace (nfc_normalize(text) as text) from elements) where kind in ('text', 'furniture') group by 1, 2)"""
_BEST = "greatest(" + ", ".join(f"votes_{d}" for d in triage.DOMAINS) + ")"
_LATEST = "lp as (select * from ledger qualify row_number() over (partition by doc_id, page order by arrived_at desc, entry_id desc) = 1)"
_ROLLUP = "rl as (select doc_id, count(*) as pages, round(sum(case when not isnan(coverage_residual) and coverage_residual >= 0 then 1 - coverage_residual end), 4) / nullif(count(*) filter (not isnan(coverage_residual) and coverage_residual >= 0), 0) as coverage, round(sum(cost_estimate_usd), 6) as spend, count(*) filter (strategy_used like '%→%') as escalated, count(*) filter (strategy_used like '%C%') as vision_pages, coalesce(bool_or(contains(strategy_used, '!budget')), false) as budget_hit from lp group by 1)"
_DOMINANT = "dm as (select doc_id, case when n / a >= 0.7 then origin_type else 'mixed' end as dominant_origin, round(n / a, 4) as share from (select *, sum(n) over (partition by doc_id) as a, row_number() over (partition by doc_id order by n desc, f, origin_type) as k from (select doc_id, origin_type, count(*) as n, min(page) as f from page_profiles group by 1, 2)) where k = 1)"

_COLUMNS = "with w as (select doc_id, bbox.page as page, bbox.x0 as x0, count(*) over (partition by doc_id, bbox.page) as n from elements), b as (select doc_id, page, n, floor(x0 / 20)::bigint as bin, count(*) as c from w group by 1, 2, 3, 4), s as (select doc_id, page, n, list(bin * 20.0 order by bin) filter (c >= 0.2 * n) as l from b group by 1, 2, 3) select doc_id, page, case when n < 3 then 0 else len(list_reduce(coalesce(l, []), lambda a, x: case when x - a[-1] >= 100 then list_append(a, x) else a end, [-1e9::double])) - 1 end::bigint as columns from (select doc_id, page, n, list_transform(l, lambda x: x::double) as l from s)"
QUERIES = {f.__name__: f for f in (parsed_cells, period_cells, page_texts, value_formats, prompts_by_group, content_hash_groups, page_signals, page_rules, language_backfill, dominant_origin, triage_counters, page_columns, doc_medians, ledger_latest_page, ledger_latest_run, ledger_replays, ledger_rollup, ledger_repair, ledger_trace, budget_cutoff, pending_documents, documents_listing)}
SQL = {
    "parsed_cells": _PARSE,
    "period_cells": f"select {_IS_PERIOD('key')} as key_reads_as_period, {_IS_PERIOD('period')} as period_reads_as_period, count(*) as n, count(distinct key) as n_keys from facts group by 1, 2",
    "content_hash_groups": r"select substr(sha256(trim(regexp_replace(nfc_normalize(content), '[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{85}\x{0B}]+', ' ', 'g'))), 1, 16) as hash, count(*) as copies, count(distinct doc_id) as docs, min(chunk_id) as first_chunk from chunks group by 1 having count(*) > 1",
    "page_texts": "with t as (select doc_id, bbox.page as page, string_agg(text, chr(10) order by idx, element_id) as t from elements where kind = 'text' and trim(text) <> '' group by 1, 2) select doc_id, page, length(t)::int as n_chars, md5(t) as text_md5 from t",
    "value_formats": "select fact_id, printf('%g', value_num) as printed, printf('%g', value_num / 1e9) as billions from facts where value_num is not null",
    "prompts_by_group": "select lower(unit) as \"group\", count(*) as prompts, count(*) filter (document is not null and document not in (select source_name from page_profiles where source_name is not null)) as missing from facts where unit is not null group by 1",
    "page_signals": f"with {_PAGES} select doc_id, page, n_chars, round(n_chars / (595.0::double * 842.0) * 1000, 3) as char_density, ethiopic_chars, latin_chars, case when ethiopic_chars > latin_chars then 'am' when latin_chars > 20 then 'en' else 'unknown' end as language, case when {_BEST} < 3 then 'general' " + " ".join(f"when votes_{d} = {_BEST} then '{d}'" for d in triage.DOMAINS) + " end as domain_hint from pg",
    "page_rules": f"with cl as ({_COLUMNS}), rl as (select doc_id, bbox.page as page, count(*) filter ((bbox.x1 - bbox.x0 >= 100 and bbox.y1 - bbox.y0 <= 12) or (bbox.y1 - bbox.y0 >= 100 and bbox.x1 - bbox.x0 <= 12)) as ruled from elements group by 1, 2), s as (select profile_id, coalesce(ruled, 0) as ruled, coalesce(columns, 0) as columns, coalesce(signals['char_density'], 0.0::double) as d, coalesce(signals['image_area_ratio'], 0.0::double) as i from page_profiles left join cl using (doc_id, page) left join rl using (doc_id, page)), o as (select *, case when d < 0.5 and i > 0.5 then 'scanned_image' when d >= 0.5 and i <= 0.5 then 'native_digital' else 'mixed' end as origin from s) select profile_id, origin, case when origin = 'scanned_image' then 'mixed' when ruled >= 10 then 'table_heavy' when columns >= 2 then 'multi_column' when i >= 0.15 then 'figure_heavy' else 'single_column' end as layout, case origin when 'native_digital' then 'A' when 'mixed' then 'B' else 'C' end as rung, case when origin = 'mixed' then 0.5 else floor((0.5::double + 0.5::double * least(least(abs(d - 0.5::double) / 2, 1.0), least(abs(i - 0.5::double) / 0.5::double, 1.0))) * 1000 + 0.5::double + 1e-9::double) / 1000 end as confidence from o",
    "language_backfill": f"with {_PAGES} select profile_id, language from (select profile_id, case when ethiopic_chars > latin_chars then 'am' when latin_chars > 20 then 'en' end as language from page_profiles p join pg using (doc_id, page) where p.language is null or trim(lower(p.language)) in ('', 'unknown', 'und', 'n/a')) where language is not null",
    "dominant_origin": f"with {_DOMINANT} select doc_id, dominant_origin, share from dm",
    "triage_counters": "select case grouping(origin_type, recommended_rung, language) when 3 then 'origin' when 5 then 'rung' else 'language' end as counter, coalesce(origin_type, recommended_rung, language) as label, count(*) as pages from page_profiles group by grouping sets ((origin_type), (recommended_rung), (language))",
    "page_columns": _COLUMNS,
    "doc_medians": f"with {_PAGES} select doc_id, median(n_chars) as median_chars, count(*) as pages from pg group by 1",
    "ledger_latest_page": f"with {_LATEST} select doc_id, page, entry_id, run_id, strategy_used from lp",
    "ledger_latest_run": "with l as (select doc_id, arg_max(run_id, (arrived_at, entry_id)) as run_id from ledger group by 1) select doc_id, page, entry_id, run_id from ledger semi join l using (doc_id, run_id)",
    "ledger_replays": "select run_id, run_seq, entry_id, doc_id from ledger qualify row_number() over (partition by run_id, run_seq order by arrived_at, entry_id) = 1",
    "ledger_rollup": f"with {_LATEST}, {_ROLLUP} select * from rl",
    "ledger_repair": "select doc_id, page, arg_max(entry_id, (arrived_at, entry_id)) as kept, count(*) - 1 as removed from ledger group by 1, 2 having count(*) > 1",
    "ledger_trace": f"with {_LATEST} select profile_id, p.doc_id, p.page, origin_type, strategy_used, cost_estimate_usd from page_profiles p left join lp using (doc_id, page)",
    "budget_cutoff": "with s as (select *, round(coalesce(sum(cost_estimate_usd) over (partition by doc_id, run_id order by run_seq, entry_id rows between unbounded preceding and 1 preceding), 0), 6) as spent_before from ledger) select doc_id, run_id, count(*) as kept, max(spent_before) as spent_before_last from s where spent_before < 0.002 group by 1, 2",
    "pending_documents": "select distinct doc_id from page_profiles where doc_id not in (select doc_id from ledger where doc_id is not null)",
    "documents_listing": f"with {_LATEST}, {_ROLLUP}, {_DOMINANT}, nm as (select doc_id, min(source_name) as source_name, count(distinct page) as pages from page_profiles group by 1) select nm.doc_id, source_name, nm.pages, dominant_origin, spend, vision_pages, nm.doc_id in (select doc_id from chunks) as ingested from nm join dm using (doc_id) left join rl on rl.doc_id = nm.doc_id",
}

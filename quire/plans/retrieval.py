"""Queries on vectors, coverage, citations, streams and general SQL, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import agent, coverage, navigation, vectors
from quire.sources import stores
from quire.streaming import ledger as streams
from quire.session import table

W, H = 595.0, 842.0
ROWS, COLS = 211, 149


def hash_embedding(spark: SparkSession, d: str) -> DataFrame:
    """The embedding of every chunk, whatever its type."""
    v = vectors.hash_buckets(table(spark, d, "chunks"), "chunk_id", "content")
    return v.withColumn("weight", F.round("weight", 6))


def _points(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").select("chunk_id", "doc_id", "chunk_no", "content", "chunk_type", "page_refs", "bbox", "parent_section", "content_hash", "created_at")
    return vectors.points(c)


def search_scoped(spark: SparkSession, d: str) -> DataFrame:
    """One question asked of a section, of a document and of a set of documents."""
    p = _points(spark, d)
    names = [r["doc_id"] for r in p.select("doc_id").distinct().orderBy("doc_id").limit(3).collect()]
    out = None
    for how, where in (("section", vectors.scope(section="Findings")), ("document", vectors.scope(doc_id=names[0] if names else "-")), ("documents", vectors.scope(doc_ids=names or ["-"]))):
        one = vectors.search_texts(p, "annual price index of the second quarter", 5, where).select(F.lit(how).alias("how"), "doc_id", "content_hash", "score")
        out = one if out is None else out.unionByName(one)
    return out


def vision_budget(spark: SparkSession, d: str) -> DataFrame:
    """The elements of the vision rung as regions that cost a cent each, under a budget of a quarter a document."""
    e = table(spark, d, "elements").where("source_rung = 'C'")
    r = e.select("doc_id", F.col("bbox.page").alias("page"), F.col("idx").alias("region_no"), F.lit(0.01).alias("cost"), F.when(F.length("text") > 0, 1).otherwise(0).alias("gained"))
    return coverage.budgeted(r, 0.25)


def contexts_salvaged(spark: SparkSession, d: str) -> DataFrame:
    return coverage.salvaged(table(spark, d, "elements"))


def receipts_reread(spark: SparkSession, d: str) -> DataFrame:
    """Whether each fact's value still stands where the fact says."""
    names = table(spark, d, "page_profiles").select("doc_id", F.col("source_name").alias("document")).distinct()
    return navigation.reread(table(spark, d, "facts"), names, table(spark, d, "elements"))


def _first_vector(e: DataFrame) -> list[float]:
    """The vector with id 0 as the question; zeros, which are near to nothing, where there is none."""
    r = e.where("vec_id = 0").select("embedding").first()
    return r["embedding"] if r else [0.0]


def knn_one(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return vectors.nearest(e, _first_vector(e)).select("vec_id", "score")


def knn_filtered(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return vectors.nearest(e, _first_vector(e), 6, F.col("label").isin(1, 2)).select("vec_id", "label", "score")


def knn_queries(spark: SparkSession, d: str) -> DataFrame:
    """Every vector whose id is divisible by 100, against all."""
    e = table(spark, d, "embeddings")
    return vectors.nearest_all(e, e.where("vec_id % 100 = 0"), 6)


def knn_hits(spark: SparkSession, d: str) -> DataFrame:
    """For the same queries, whether a neighbour of their own label is among the first k."""
    e = table(spark, d, "embeddings").select("vec_id", "label")
    n = knn_queries(spark, d).join(e, "vec_id").join(e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own")), "query_id")
    h = n.groupBy("query_id").agg(F.bool_or(F.col("label") == F.col("own")).alias("hit"))
    return h.agg(F.count("*").alias("queries"), F.count_if("hit").alias("hits"))


def vector_points(spark: SparkSession, d: str) -> DataFrame:
    return _points(spark, d).select("point_id", "doc_id", "content_hash", "chunk_id", F.array_join("ancestors", "/").alias("ancestors"))


def cache_missing(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").select("content_hash", F.col("content").alias("text"), "chunk_type")
    cache = c.where("chunk_type = 'text'").select("content_hash").distinct().withColumn("model", F.lit("hash-256"))
    return stores.not_cached(c, cache, "hash-256").select("content_hash")


def claims_valid(spark: SparkSession, d: str) -> DataFrame:
    return coverage.valid_claims(table(spark, d, "elements"), W * H).select("element_id", "valid")


def _grid(spark: SparkSession, d: str) -> DataFrame:
    """All elements as a page's ink, its text elements as what is claimed."""
    e = table(spark, d, "elements").select("doc_id", F.col("bbox.page").alias("page"), "bbox", "kind")
    return coverage.box_rows(e, ["doc_id", "page"], W, H, ROWS, COLS, {"ink": F.lit(True), "claimed": F.col("kind") == "text"})


def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    """How much of the area of all elements of a page its text elements claim."""
    return coverage.assessed(_grid(spark, d), ["doc_id", "page"])


def residual_regions(spark: SparkSession, d: str) -> DataFrame:
    return coverage.residual_regions(_grid(spark, d), ["doc_id", "page"], W / COLS, H / ROWS)


def pages_judged(spark: SparkSession, d: str) -> DataFrame:
    """Every profiled page: how much its text claims, and what a look at the rest would cost in area."""
    j = coverage.judged_pages(table(spark, d, "page_profiles"), _grid(spark, d), ["doc_id", "page"], W, H, W / COLS, H / ROWS)
    return j.withColumn("regions", F.col("regions") > 0).withColumn("area_escalated_pct", F.col("area_escalated_pct") > 0)


def figures_drawn(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of boxes on the coarse grid, figures and tables standing for drawings."""
    return coverage.drawn_figures(table(spark, d, "elements").where("kind in ('figure', 'table')"), W, H).select("doc_id", "page", "region", F.round("x0", 3).alias("x0"), F.round("y0", 3).alias("y0"), F.round("x1", 3).alias("x1"), F.round("y1", 3).alias("y1"), "cells")


def elements_merged(spark: SparkSession, d: str) -> DataFrame:
    """The vision rung's elements laid beside those of the other rungs."""
    e = table(spark, d, "elements")
    return coverage.merged(e.where("source_rung <> 'C'"), e.where("source_rung = 'C'")).groupBy("source_rung", "kind").agg(F.count("*").alias("n"))


def rung_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Per page with elements of two rungs: what share of the page's ink the fast rung (A) and the others account for."""
    e = table(spark, d, "elements").select("doc_id", F.col("bbox.page").alias("page"), "bbox", "source_rung")
    g = coverage.box_rows(e, ["doc_id", "page"], W, H, ROWS, COLS, {"ink": F.lit(True), "claimed": F.col("source_rung") == "A"})
    other = coverage.box_rows(e, ["doc_id", "page"], W, H, ROWS, COLS, {"ink": F.lit(True), "claimed": F.col("source_rung") != "A"})
    a, b = (coverage.assessed(x, ["doc_id", "page"]).select("doc_id", "page", F.col("coverage").alias(n)) for x, n in ((g, "fast"), (other, "others")))
    return a.join(b, ["doc_id", "page"]).where("fast > 0 and others > 0")


def otsu_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The split of each document's text lengths into short and long ones (bins of eight characters)."""
    e = table(spark, d, "elements").where("kind = 'text' and text is not null").select("doc_id", F.least(F.floor(F.length("text") / 8), F.lit(255)).alias("bin"))
    return coverage.otsu(e, ["doc_id"])


def text_outside_tables(spark: SparkSession, d: str) -> DataFrame:
    return coverage.outside_tables(table(spark, d, "elements"))


def tables_without_twins(spark: SparkSession, d: str) -> DataFrame:
    return coverage.without_twins(table(spark, d, "elements"))


def escalation(spark: SparkSession, d: str) -> DataFrame:
    """The ladder over profiled pages, with the coverage that the last ledger row of each rung gives."""
    p = table(spark, d, "page_profiles").groupBy("doc_id", "page").agg(F.min("recommended_rung").alias("start"))
    led = table(spark, d, "ledger").where("not isnan(coverage_residual) and coverage_residual between 0 and 1")
    got = lambda s: led.where(F.col("strategy_used").startswith(s)).groupBy("doc_id", "page").agg(F.round(1 - F.max_by("coverage_residual", F.struct("arrived_at", "entry_id")), 4).alias("coverage"))
    a, b = got("A").withColumn("insane", F.lit(False)), got("B").withColumn("insane", F.lit(False))
    return coverage.escalated(p, a, b, got("C(").withColumn("regions", F.lit(1)))


def citations_resolved(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "facts")
    c = f.select(F.col("fact_id").alias("answer_id"), F.when(F.col("fact_id") % 7 == 0, F.reverse("content_hash")).otherwise(F.col("content_hash")).alias("content_hash"))
    return agent.resolved(c, f).groupBy("found", "document").agg(F.count("*").alias("n"))


def answers_judged(spark: SparkSession, d: str) -> DataFrame:
    """Answers made from facts, one in four wrong in some way, judged."""
    f = table(spark, d, "facts").where("value_raw is not null")
    m = F.col("fact_id") % 4
    a = f.select(F.col("fact_id").alias("question_id"), F.when(m == 3, "adversarial").otherwise("answerable").alias("kind"), F.when(F.col("fact_id") % 8 == 3, "not_found").otherwise("answered").alias("status"), F.concat(F.lit("It was "), "value_raw").alias("answer"), F.when(m == 2, F.concat("value_raw", F.lit("?"))).otherwise(F.col("value_raw")).alias("expect"), "document",
                 F.when(F.col("fact_id") % 8 == 3, F.array().cast("array<string>")).when(F.col("fact_id") % 8 == 1, F.array(F.lit("other"))).otherwise(F.array("document")).alias("documents"))
    return agent.judged(a).groupBy("kind", "ok").agg(F.count("*").alias("n"))


def ledger_stream_latest(spark: SparkSession, d: str) -> DataFrame:
    return streams.latest_of_files(spark, os.path.join(d, "ledger.parquet")).select("doc_id", "page", "entry_id", "strategy_used")


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    w = streams.windowed(table(spark, d, "events"))
    return w.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def corpus_split(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_profiles")
    m = p.agg(F.min("source_name").alias("a"), F.max("source_name").alias("z")).first()
    return stores.split_corpus(p, [m["a"], "No such file.pdf"], [m["z"]])


def _sql(spark: SparkSession, d: str, *names: str) -> None:
    for n in names:
        table(spark, d, n).createOrReplaceTempView(n)


SHARED = {
    "sql_join_agg": (("region", "nation", "customer", "orders", "lineitem"), "select n_name, count(*) as n_lines, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where o_orderdate >= timestamp '1996-01-01 00:00:00' and o_orderdate < timestamp '1998-01-01 00:00:00' group by n_name"),
    "sql_semi_anti": (("customer", "orders"), "select c_mktsegment, count(*) as n_customers from customer c where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o_orderpriority = '1-URGENT') and not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o_orderstatus = 'P') group by c_mktsegment"),
    "sql_window_rank": (("orders",), "select * from (select o_custkey, o_orderkey, cast(row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as bigint) as place, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 2 preceding and current row), 2) as last_three from orders) t where place <= 3"),
    "sql_setops": (("customer", "supplier"), "(select c_nationkey as k from customer except select s_nationkey from supplier where s_acctbal > 5000) union (select s_nationkey from supplier intersect select c_nationkey from customer where c_acctbal < 0)"),
    "sql_rollup": (("lineitem",), "select l_returnflag, l_linestatus, cast(grouping(l_linestatus) as bigint) as level, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem group by rollup (l_returnflag, l_linestatus)"),
    "sql_subquery": (("part", "lineitem"), "select p_brand, count(*) as n, round(avg(l_extendedprice), 4) as mean from lineitem join part on l_partkey = p_partkey where l_quantity < (select avg(l_quantity) from lineitem) group by p_brand having count(*) > 1"),
    "sql_topk": (("orders", "customer"), "select c_name, o_orderkey, o_totalprice from orders join customer on o_custkey = c_custkey order by o_totalprice desc, o_orderkey limit 25"),
}


def _shared(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        _sql(spark, d, *SHARED[name][0])
        return spark.sql(SHARED[name][1])

    return query


_CELLS = lambda name, where: f"{name} as (select distinct doc_id, page, r, c from (select doc_id, page, unnest(range(r0, r1)) as r, c0, c1 from (select doc_id, bbox.page as page, least(greatest(floor(bbox.y0 / 842.0::double * {ROWS}), 0), {ROWS})::int as r0, least(greatest(ceil(bbox.y1 / 842.0::double * {ROWS}), 0), {ROWS})::int as r1, least(greatest(floor(bbox.x0 / 595.0::double * {COLS}), 0), {COLS})::int as c0, least(greatest(ceil(bbox.x1 / 595.0::double * {COLS}), 0), {COLS})::int as c1 from elements where {where})), lateral (select unnest(range(c0, c1)) as c))"
_COS = "round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 4)"
_GOT = lambda n, s: f"{n} as (select doc_id, page, round(1 - arg_max(coverage_residual, (arrived_at, entry_id)), 4) as coverage from ledger where not isnan(coverage_residual) and coverage_residual between 0 and 1 and starts_with(strategy_used, '{s}') group by 1, 2)"

_TWINLESS = "with p as (select a.element_id, least(a.bbox.x1, b.bbox.x1) - greatest(a.bbox.x0, b.bbox.x0) as w, least(a.bbox.y1, b.bbox.y1) - greatest(a.bbox.y0, b.bbox.y0) as h, least((a.bbox.x1 - a.bbox.x0) * (a.bbox.y1 - a.bbox.y0), (b.bbox.x1 - b.bbox.x0) * (b.bbox.y1 - b.bbox.y0)) as s from elements a join elements b on a.doc_id = b.doc_id and a.bbox.page = b.bbox.page where a.kind = 'table' and b.kind = 'table' and a.source_rung = 'C' and b.source_rung <> 'C' and len(b.table_data.headers) >= 2 and len(b.table_data.rows) > 0 and len(list_filter(b.table_data.headers, lambda c: trim(c) <> '')) >= 0.5 * len(b.table_data.headers) and len(list_filter(flatten(b.table_data.rows), lambda c: trim(c) <> '')) >= 0.4 * len(flatten(b.table_data.rows))) select element_id from elements where kind = 'table' and source_rung = 'C' and element_id not in (select element_id from p where w > 0 and h > 0 and w * h / s >= 0.5)"
_SHA = "sha1(unhex('6ba7b8129dad11d180b400c04fd430c8') || encode(doc_id || content_hash))"
_UUID = f"concat_ws('-', substr({_SHA}, 1, 8), substr({_SHA}, 9, 4), '5' || substr({_SHA}, 14, 3), printf('%02x', (('0x' || substr({_SHA}, 17, 2))::int & 63) | 128) || substr({_SHA}, 19, 2), substr({_SHA}, 21, 12))"
QUERIES = {f.__name__: f for f in (hash_embedding, search_scoped, vision_budget, contexts_salvaged, receipts_reread, knn_one, knn_filtered, knn_queries, knn_hits, vector_points, cache_missing, claims_valid, coverage_ratio, residual_regions, pages_judged, figures_drawn, elements_merged, rung_comparison, otsu_threshold, text_outside_tables, tables_without_twins, escalation, citations_resolved, answers_judged, ledger_stream_latest, event_windows, corpus_split)} | {n: _shared(n) for n in SHARED}
SQL = {n: s for n, (_, s) in SHARED.items()} | {
    "hash_embedding": r"with t as (select chunk_id, trim(regexp_replace(lower(content), '\s+', ' ', 'g')) as t from chunks), g as (select chunk_id, substr(t, i, k) as g from t, (values (3), (5)) v(k), lateral (select unnest(range(1, length(t) - k + 2)) as i)), b as (select chunk_id, (('0x' || right(md5(g), 4))::int % 256)::int as bucket, count(*) as c from g group by 1, 2) select chunk_id, bucket, round(c / sqrt(sum(c * c) over (partition by chunk_id)::double), 6) as weight from b",
    "search_scoped": r"""with p as (select doc_id, content_hash, arg_max(content, (created_at, chunk_id)) as content, list_transform(string_split(coalesce(arg_max_null(parent_section, (created_at, chunk_id)), ''), '>'), lambda x: trim(x)) as up from chunks group by 1, 2), n as (select distinct doc_id from p order by 1 limit 3),
s as (select 'section' as how, * from p where list_contains(up, 'Findings') union all select 'document', * from p where doc_id = (select min(doc_id) from n) union all select 'documents', * from p where doc_id in (from n)), t as (select how, doc_id, content_hash, trim(regexp_replace(lower(content), '\s+', ' ', 'g')) as t from s union all select 'query', '', '', 'annual price index of the second quarter'),
g as (select how, doc_id, content_hash, substr(t, i, k) as g from t, (values (3), (5)) v(k), lateral (select unnest(range(1, length(t) - k + 2)) as i)), b as (select how, doc_id, content_hash, (('0x' || right(md5(g), 4))::int % 256)::int as bucket, count(*) as c from g group by all), w as (select *, c / sqrt(sum(c * c) over (partition by how, doc_id, content_hash)::double) as weight from b),
r as (select w.how, w.doc_id, w.content_hash, round(sum(w.weight * q.weight), 4) as score from w join w q on q.how = 'query' and q.bucket = w.bucket where w.how <> 'query' group by all)
select how, doc_id, content_hash, score from r qualify row_number() over (partition by how order by score desc, """ + _UUID + r""") <= 5""",
    "vision_budget": """with r as (select doc_id, bbox.page as page, idx, 0.01 as cost, (coalesce(length(text), 0) > 0)::int as gained from elements where source_rung = 'C'), x as (select *, row_number() over (partition by doc_id order by page, idx) <= 25 as ok from r)
select doc_id, page, case when bool_and(ok) then 'C(' || count(*) || ')' else 'C(' || coalesce(sum(gained) filter (ok), 0) || ')!budget' end as label, (count(*) filter (ok) * 0.01)::double as cost, coalesce(sum(gained) filter (ok), 0)::bigint as gained, count(*) as regions from x group by 1, 2""",
    "contexts_salvaged": "with t as (select element_id, doc_id, bbox.page as page, idx, source_rung, nullif(table_data.context, '') as own from elements where kind = 'table') select t.element_id, coalesce(own, (select arg_min(own, idx) from t a where a.doc_id = t.doc_id and a.page = t.page and a.source_rung = 'A' and a.own is not null)) as context from t",
    "receipts_reread": r"""with n as (select distinct doc_id, source_name from page_profiles), e as (select source_name as document, bbox.page as page, bbox as b, trim(regexp_replace(case when kind = 'table' then array_to_string(list_concat([array_to_string(table_data.headers, ' | ')], list_transform(table_data.rows, lambda x: array_to_string(x, ' | '))), ' ') else coalesce(text, caption) end, '\s+', ' ', 'g')) as w from elements join n using (doc_id)),
h as (select distinct fact_id from facts f join e using (document, page) where b.x0 < f.x1 and b.x1 > f.x0 and b.y0 < f.y1 and b.y1 > f.y0 and contains(w, trim(regexp_replace(value_raw, '\s+', ' ', 'g')))) select distinct fact_id, fact_id in (from h) as printed from facts""",
    "elements_merged": "with t as (" + _TWINLESS + ") select source_rung, kind, count(*) as n from elements where source_rung is not null and not (kind = 'table' and source_rung = 'C' and element_id not in (from t)) group by 1, 2",
    "knn_one": f"select b.vec_id, {_COS} as score from embeddings a, embeddings b where a.vec_id = 0 order by score desc, b.vec_id limit 6",
    "knn_filtered": f"select b.vec_id, b.label, {_COS} as score from embeddings a, embeddings b where a.vec_id = 0 and b.label in (1, 2) order by score desc, b.vec_id limit 6",
    "knn_queries": f"select query_id, vec_id, score, rank from (select a.vec_id as query_id, b.vec_id, {_COS} as score, row_number() over (partition by a.vec_id order by {_COS} desc, b.vec_id) as rank from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0) where rank <= 6",
    "knn_hits": f"select count(*) as queries, count(*) filter (hit) as hits from (select q, bool_or(own = label) as hit from (select a.vec_id as q, a.label as own, b.label, row_number() over (partition by a.vec_id order by {_COS} desc, b.vec_id) as rank from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0) where rank <= 6 group by q)",
    "vector_points": f"select {_UUID} as point_id, * from (select doc_id, content_hash, arg_max(chunk_id, (created_at, chunk_id)) as chunk_id, array_to_string(list_transform(string_split(coalesce(arg_max_null(parent_section, (created_at, chunk_id)), ''), '>'), lambda x: trim(x)), '/') as ancestors from chunks group by 1, 2)",
    "cache_missing": "select distinct content_hash from chunks where content_hash not in (select content_hash from chunks where chunk_type = 'text')",
    "claims_valid": "select element_id, (bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0) / (595.0::double * 842.0) <= 0.6 or coalesce(source_rung, '') = 'C' or (kind = 'figure' and exists (select 1 from elements t where t.kind = 'text' and t.doc_id = e.doc_id and t.bbox.page = e.bbox.page)) as valid from elements e",
    "coverage_ratio": f"with {_CELLS('ink', 'true')}, {_CELLS('cl', chr(39).join(['kind = ', 'text', '']))} select i.doc_id, i.page, count(*) as inked, count(cl.r) as covered, round(count(cl.r) / count(*), 4) as coverage, count(cl.r) / count(*) < 0.85 as escalate from ink i left join cl on cl.doc_id = i.doc_id and cl.page = i.page and cl.r = i.r and cl.c = i.c group by 1, 2",
    "rung_comparison": f"with {_CELLS('ink', 'true')}, {_CELLS('ca', chr(39).join(['source_rung = ', 'A', '']))}, {_CELLS('cb', chr(39).join(['source_rung <> ', 'A', '']))} select i.doc_id, i.page, round(count(ca.r) / count(*), 4) as fast, round(count(cb.r) / count(*), 4) as others from ink i left join ca on ca.doc_id = i.doc_id and ca.page = i.page and ca.r = i.r and ca.c = i.c left join cb on cb.doc_id = i.doc_id and cb.page = i.page and cb.r = i.r and cb.c = i.c group by 1, 2 having count(ca.r) > 0 and count(cb.r) > 0",
    "otsu_threshold": "with h as (select doc_id, least(floor(length(text) / 8), 255)::bigint as bin, count(*) as n from elements where kind = 'text' and text is not null group by 1, 2), c as (select doc_id, bin, sum(n) over e as a, sum(n * bin) over e as t, sum(n) over w as w, sum(n * bin) over w as m from h window e as (partition by doc_id), w as (partition by doc_id order by bin)), v as (select doc_id, bin, round((t / a * (w / a) - m / a) * (t / a * (w / a) - m / a) / nullif(w / a * (1 - w / a), 0), 9) as var from c) select doc_id, case when coalesce(max(var) > 1e-9, false) then arg_max(bin, (coalesce(var, -1), -bin)) else -1 end as threshold from v group by 1",
    "text_outside_tables": "select element_id from elements t where kind = 'text' and not exists (select 1 from elements g where g.kind = 'table' and g.doc_id = t.doc_id and g.bbox.page = t.bbox.page and t.bbox.x0 >= g.bbox.x0 and t.bbox.y0 >= g.bbox.y0 and t.bbox.x1 <= g.bbox.x1 and t.bbox.y1 <= g.bbox.y1)",
    "tables_without_twins": _TWINLESS,
    "escalation": f"with p as (select doc_id, page, min(recommended_rung) as start from page_profiles group by 1, 2), {_GOT('a', 'A')}, {_GOT('b', 'B')}, {_GOT('c', 'C(')}, j as (select p.*, a.coverage as ca, b.coverage as cb, c.coverage as cc from p left join a using (doc_id, page) left join b using (doc_id, page) left join c using (doc_id, page)), s as (select *, start = 'A' as da, (start = 'A' and coalesce(ca < 0.85, true)) or start = 'B' as tb from j), u as (select *, tb and cb is not null as db, start = 'C' or (tb and cb is not null and coalesce(cb < 0.85, true)) or (tb and cb is null and coalesce(ca < 0.85, true)) as tc from s), v as (select *, tc and cc is not null as dc from u) select doc_id, page, coalesce(nullif(concat_ws('→', case when da then 'A' end, case when db then 'B' end, case when dc then 'C(1)' end, case when tc and not dc then 'C-unavailable' end), ''), 'none') as label, coalesce(case when dc then cc when db then cb else ca end, 0) as coverage from v",
    "citations_resolved": "with c as (select fact_id, case when fact_id % 7 = 0 then reverse(content_hash) else content_hash end as h from facts), p as (select content_hash as h, arg_min(document, fact_id) as document from facts group by 1) select p.h is not null as found, document, count(*) as n from c left join p using (h) group by 1, 2",
    "answers_judged": "select kind, ok, count(*) as n from (select case when fact_id % 4 = 3 then 'adversarial' else 'answerable' end as kind, case when fact_id % 4 = 3 then fact_id % 8 = 3 else fact_id % 4 <> 2 and fact_id % 8 <> 1 end as ok from facts where value_raw is not null) group by 1, 2",
    "ledger_stream_latest": "select doc_id, page, entry_id, strategy_used from ledger qualify row_number() over (partition by doc_id, page order by arrived_at desc, entry_id desc) = 1",
    "event_windows": "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "corpus_split": "with n as (select distinct source_name from page_profiles) select source_name, case when source_name = (select min(source_name) from n) then 'holdout' when source_name = (select max(source_name) from n) then 'dropped' else 'tune' end as part from n union all select 'No such file.pdf', 'missing'",
}

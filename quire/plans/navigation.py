"""Queries on the tree, captions, sibling documents and tallies, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import answers, navigation, sections
from quire.plans import answers as claims
from quire.plans import sections as tree
from quire.plans.retrieval import _first_vector
from quire.session import cut, table


def sections_found(spark: SparkSession, d: str) -> DataFrame:
    t = tree.full_tree(spark, d)
    wanted = t.select("doc_id").distinct().select("doc_id", F.explode(F.array(F.lit("annex a"), F.lit("findings"), F.lit("procurement"))).alias("wanted"))
    return navigation.found_sections(t, wanted)


def section_descendants(spark: SparkSession, d: str) -> DataFrame:
    return navigation.descendants(tree.full_tree(spark, d))


def search_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    """The same vector looked for under a label that there is and under one that there is not."""
    e = table(spark, d, "embeddings")
    found = [navigation.search(e, _first_vector(e), 4, F.col("label") == x).select(F.lit(x).alias("wanted"), "vec_id", "score", "note") for x in (3, 99)]
    return found[0].unionByName(found[1])


def figures_captioned(spark: SparkSession, d: str) -> DataFrame:
    """Figures without captions and the caption texts bound to them, section by section (this corpus prints no caption lines, so the lines under its figures stand for them)."""
    e = sections.with_sections(table(spark, d, "elements").where("kind <> 'furniture'"))
    e = e.select("element_id", "doc_id", "section_no", "page", "idx", "kind", F.lit(None).cast("string").alias("caption"), F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"), F.concat(F.lit("Chart: "), "text").alias("text"))
    return sections.bound_captions(e).select("figure_id", "caption_id")


def claims_elsewhere(spark: SparkSession, d: str) -> DataFrame:
    return navigation.printed_elsewhere(claims._claims(spark, d), table(spark, d, "facts"))


def cell_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Labels in another spelling (in parentheses, dashes for spaces) held against the facts of their document."""
    f = table(spark, d, "facts").where("value_num is not null and key is not null")
    truth = f.select("document", F.when(F.col("fact_id") % 3 == 0, F.concat(F.lit("("), F.replace("key", F.lit(" "), F.lit("-")), F.lit(")"))).otherwise(F.col("key")).alias("label"), F.when(F.col("fact_id") % 5 == 0, F.col("value_num") + 0.5).otherwise(F.col("value_num")).alias("value")).distinct()
    m = navigation.matched_labels(truth, table(spark, d, "facts"))
    return m.groupBy("document").agg(F.count("*").alias("cells"), F.count_if("found").alias("found"), F.count_if("ok").alias("correct"))


def routing_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Each key and period that the facts have, with none where they have none, asked once and held against every document that prints it."""
    f = table(spark, d, "facts")
    asked = cut(f.groupBy("key", "period").agg(F.min("fact_id").alias("question_id")))  # routed, and joined again
    q = asked.select("question_id", F.concat(F.lit("What was "), "key", F.coalesce(F.concat(F.lit(" in "), "period"), F.lit("")), F.lit("?")).alias("question"))
    a, f = asked.alias("a"), f.select("key", "period", "document").distinct().alias("f")
    truth = f.join(a, F.col("f.key").eqNullSafe(F.col("a.key")) & F.col("f.period").eqNullSafe(F.col("a.period")))
    truth = truth.select("question_id", "document", F.when(X.is_period(F.col("f.period")), "dated").otherwise("other").alias("kind"))
    return navigation.routing_tally(answers.routed(q, tree.whole_cards(spark, d)), truth)


_NORM = lambda c: f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"
# Routing over cards: every token of each field with its weight, questions by key and period, ranks, and the documents that print each.
_WEIGH = {"source_name": "2.0", "fact_keys": "2.0", "periods": "3.0", "table_contexts": "2.0", "sections": "1.0", "summary": "1.0", "opening": "1.0", "frequent_terms": "1.5"}
_LISTS = {c: f"(select doc_id, string_agg(distinct {x}, ' ') as {c} from ff group by 1)" for c, x in (("fact_keys", "key"), ("periods", "period"), ("table_contexts", "context"))}
_FIELD = lambda c, src: f"select doc_id, {_WEIGH[c]}::double as w, unnest(list_distinct({tree._TOKENS(c)})) as token from {src}"
_ROUTED = lambda fields: "wt as (" + " union all ".join(_FIELD(c, src) for c, src in fields.items()) + f"""), df as (select token, ln((1 + (select count(*) from nm)::double) / (1 + count(distinct doc_id))) as idf from wt group by 1),
gq as (select key, period, min(fact_id) as question_id from facts group by 1, 2), qt as (select question_id, unnest(list_distinct({tree._TOKENS("'What was ' || key || coalesce(' in ' || period, '') || '?'")})) as token from gq), cw as (select doc_id, token, sum(w * idf) as worth from wt join df using (token) where idf > 0 group by 1, 2),
sr as (select question_id, doc_id, round(sum(worth), 4) as score from qt join cw using (token) group by 1, 2 having round(sum(worth), 4) > 0), rk as (select question_id, source_name as document, row_number() over (partition by question_id order by score desc, source_name, doc_id) as rank from sr join nm using (doc_id) qualify rank <= 3),
tg as (select distinct question_id, f.document, case when {claims._PERIOD("f.period")} then 'dated' else 'other' end as kind from facts f join gq on gq.key is not distinct from f.key and gq.period is not distinct from f.period),
ht as (select tg.question_id, tg.document, kind, min(rank) as rank from tg left join rk on rk.question_id = tg.question_id and rk.document = tg.document group by 1, 2, 3) select coalesce(kind, 'ALL') as kind, count(*) as questions, count(*) filter (rank = 1) as first, count(rank) as among from ht group by rollup (kind)"""  # noqa: E731
QUERIES = {f.__name__: f for f in (sections_found, section_descendants, search_with_fallback, figures_captioned, claims_elsewhere, cell_accuracy, routing_accuracy)}
SQL = {
    "figures_captioned": f"""with {tree._HEAD.replace("from elements e left", "from (select * from elements where kind <> 'furniture') e left")}, f as (select doc_id, section_no, page, idx, element_id, bbox.y0 as y0, bbox.y1 as y1 from lv where kind = 'figure'), t as (select doc_id, section_no, page, idx as ti, element_id as te, bbox.y0 as a0, bbox.y1 as a1 from lv where kind = 'text' and text is not null),
p as (select doc_id, section_no, page, list({{'f': element_id, 't': te}} order by idx, ti) as ps from f join t using (doc_id, section_no, page) where least(abs(a0 - y1), abs(y0 - a1)) <= 40 group by all),
g as (select unnest(list_reduce(list_transform(ps, lambda y: [y]), lambda got, x: case when len(list_filter(got, lambda y: y.f = x[1].f or y.t = x[1].t)) = 0 then got || x else got end, [])) as x from p) select x.f as figure_id, x.t as caption_id from g""",
    "sections_found": f"with recursive {tree._HEAD}, {tree._BELOW}, w as (select distinct doc_id, x as wanted from sc, (values ('annex a'), ('findings'), ('procurement')) v(x)), j as (select w.doc_id, wanted, section_no, title, case when lower(trim(title)) = wanted then 0 else 1 end as how, depth from w join sc using (doc_id) join below using (doc_id, section_no) where contains(lower(trim(title)), wanted)) select doc_id, wanted, section_no, title, case when how = 0 then 'exact' else 'contains' end as how from j qualify row_number() over (partition by doc_id, wanted order by how, depth, section_no) = 1",
    "section_descendants": f"with recursive {tree._HEAD}, {tree._BELOW} select * from below",
    "search_with_fallback": "with s as (select b.vec_id, b.label, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 4) as score from embeddings a, embeddings b where a.vec_id = 0) (select 3 as wanted, vec_id, score, null as note from s where label = 3 order by score desc, vec_id limit 4) union all (select 99, vec_id, score, 'nothing in the section; searched everywhere' from s order by score desc, vec_id limit 4)",
    "claims_elsewhere": "with " + claims._CLAIM.replace("{src}", "cl") + """, f as (select fact_id, document, lower(key) as k, value_num from facts), p as (select distinct claim_id, f.document, value, words from cp join f on round(value, 9) = round(value_num, 9) where cp.document <> f.document and value is not null and len(words) > 0 and contains(k, words[1])),
h as (select claim_id, p.document, value, value_num, fact_id, len(list_filter(range(1, len(words) + 1), lambda i: len(list_filter(words[1:i], lambda w: not contains(k, w))) = 0)) as depth from p join f on f.document = p.document where contains(k, words[1])),
b as (select *, row_number() over (partition by claim_id, document order by fact_id) as nth from (select *, max(depth) over (partition by claim_id, document) as best from h) where depth = best) select distinct claim_id, document from b where nth <= 25 and round(value_num, 9) = round(value, 9)""",
    "cell_accuracy": f"with t as (select distinct document, case when fact_id % 3 = 0 then '(' || replace(key, ' ', '-') || ')' else key end as label, case when fact_id % 5 = 0 then value_num + 0.5 else value_num end as value from facts where value_num is not null and key is not null), k as (select distinct document, key, {_NORM('key')} as n from facts where key is not null), o as (select document, n, min(key) as by_form from k group by 1, 2 having count(*) = 1), m as (select t.*, case when k.key is not null then label else by_form end as key from t left join k on k.document = t.document and k.key = label left join o on o.document = t.document and o.n = {_NORM('label')}) select document, count(*) as cells, count(key) as found, count(*) filter (exists (select 1 from facts f where f.document = m.document and f.key = m.key and f.value_num = m.value)) as correct from m group by 1",
    "routing_accuracy": "with nm as (select doc_id, min(source_name) as source_name from page_profiles group by 1), dn as (select distinct doc_id, source_name as document from page_profiles), ff as (select doc_id, key, period, context from facts join dn using (document)), " + _ROUTED({"source_name": "nm", **_LISTS}),
}
#: SQL["routing_accuracy"] reads facts and names alone, as the query does in a folder without elements or chunks. This is its SQL where they are.
WHOLE_SQL = {
    "routing_accuracy": f"with {tree._CARD}, sm as (" + tree.SQL["card_summaries"].removeprefix(f"with {tree._CARD} ") + "), tm as (select doc_id, array_to_string(frequent_terms, ' ') as frequent_terms from r_frequent_terms), "
    + _ROUTED({"source_name": "nm", **_LISTS, "sections": "(select doc_id, string_agg(title, ' ') as sections from pr where parent_no is null group by 1)", "summary": "sm", "opening": "op", "frequent_terms": "tm"}),
}

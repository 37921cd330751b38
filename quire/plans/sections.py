"""Queries on reading order, sections, chunks, the tree, cards and routing, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import answers, navigation, sections, triage
from quire.session import cut, stored, table


def element_order(spark: SparkSession, d: str) -> DataFrame:
    return sections.reading_order(table(spark, d, "elements"))


def furniture_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Furniture by position, looked for among all printed lines, those already marked as furniture taken as text."""
    e = table(spark, d, "elements")
    return sections.furniture(e.withColumn("kind", F.when(F.col("kind") == "furniture", "text").otherwise(F.col("kind"))))


def body_sizes(spark: SparkSession, d: str) -> DataFrame:
    return sections.body_size(table(spark, d, "elements"))


def section_list(spark: SparkSession, d: str) -> DataFrame:
    return sections.sections(table(spark, d, "elements"))


def full_tree(spark: SparkSession, d: str) -> DataFrame:
    return sections.parents(sections.sections(table(spark, d, "elements")))


def section_tree(spark: SparkSession, d: str) -> DataFrame:
    return full_tree(spark, d).select("doc_id", "section_no", "title", "level", "parent_no", "page_start", "page_end")


def section_children(spark: SparkSession, d: str) -> DataFrame:
    """Navigation: each section with the number and pages of its children."""
    t = section_tree(spark, d)
    kids = t.groupBy("doc_id", "parent_no").agg(F.count("*").alias("children"), F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page")).where("parent_no is not null").withColumnRenamed("parent_no", "section_no")
    return t.select("doc_id", "section_no", "title").join(kids, ["doc_id", "section_no"], "left")


def corpus_root(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "elements").where("kind <> 'furniture'")
    r = navigation.corpus_root(sections.nodes(sections.chunk_elements(e, 120), sections.parents(sections.sections(e))))
    return r.withColumn("data_types", F.array_join("data_types", ","))


def page_buckets(spark: SparkSession, d: str) -> DataFrame:
    return sections.page_buckets(table(spark, d, "elements"))


def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    c = sections.chunk_elements(table(spark, d, "elements"), 120)
    return c.select("doc_id", "section_no", "chunk_no", "chunk_type", "tokens", F.size("elements").alias("n_elements"), F.md5("content").alias("content_md5"), F.array_join("page_refs", ",").alias("pages"), "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1", "parent_section")


def tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The sections with names, summary and types of what was packed from them."""
    e = table(spark, d, "elements").where("kind <> 'furniture'")
    n = sections.nodes(sections.chunk_elements(e, 120), sections.parents(sections.sections(e)))
    return n.select("doc_id", "section_no", "parent_no", "title", "page_start", "page_end", F.array_join("key_entities", "; ").alias("key_entities"), "summary", F.array_join("data_types", ",").alias("data_types"))


def chunk_rules(spark: SparkSession, d: str) -> DataFrame:
    return sections.violations(table(spark, d, "chunks"))


def chunk_references(spark: SparkSession, d: str) -> DataFrame:
    return sections.references(table(spark, d, "chunks"))


def stored_references(spark: SparkSession, d: str) -> DataFrame:
    """Stored references whose target is in another document or nowhere."""
    c = table(spark, d, "chunks")
    r = c.select("chunk_id", "doc_id", F.explode("relationships").alias("r")).select("chunk_id", "doc_id", "r.label", F.col("r.target_hash").alias("content_hash"))
    own = c.select("doc_id", "content_hash").distinct().withColumn("own", F.lit(True))
    somewhere = c.select("content_hash").distinct().withColumn("known", F.lit(True))
    j = r.join(own, ["doc_id", "content_hash"], "left").join(somewhere, "content_hash", "left")
    return j.groupBy(F.when(F.col("own"), "same document").when(F.col("known"), "another document").otherwise("nowhere").alias("target")).agg(F.count("*").alias("n"))


def chunk_entities(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").where("chunk_type = 'text'").select("doc_id", "chunk_no", "chunk_id", F.posexplode(sections.entities(F.col("content"))).alias("i", "entity"))
    return sections.most_frequent(c, "doc_id", "entity", ["chunk_no", "chunk_id", "i"], 5)


def chunk_summaries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").where("chunk_type = 'text'").select("chunk_id", sections.summary(F.col("content")).alias("summary"))


def _cards(spark: SparkSession, d: str) -> DataFrame:
    return sections.cards(table(spark, d, "page_profiles"), table(spark, d, "facts"), table(spark, d, "chunks"), full_tree(spark, d))


def doc_cards(spark: SparkSession, d: str) -> DataFrame:
    c = _cards(spark, d)
    lists = [F.array_join(x, "; ").alias(x) for x in ("sections", "periods", "fact_keys", "table_contexts", "frequent_terms")]
    return c.select("doc_id", "source_name", "pages", "origin", "domain", *lists, "opening")


def token_frequency(spark: SparkSession, d: str) -> DataFrame:
    c = _cards(spark, d)
    return answers.card_tokens(c).select("doc_id", "token").distinct().groupBy("token").agg(F.count("*").alias("df"))


def route_questions(spark: SparkSession, d: str) -> DataFrame:
    """A question per fact key and period, routed over cards of name, keys, periods and headings."""
    f = table(spark, d, "facts").where("period is not null").groupBy("key", "period").agg(F.min("fact_id").alias("question_id"))
    q = f.select("question_id", F.concat(F.lit("What was "), "key", F.lit(" in "), "period", F.lit("?")).alias("question"))
    return answers.routed(q, _plain_cards(spark, d))


def _plain_cards(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_profiles").groupBy("doc_id").agg(F.min("source_name").alias("source_name"))
    f = table(spark, d, "facts").groupBy(F.col("document").alias("source_name")).agg(F.sort_array(F.collect_set("key")).alias("fact_keys"), F.sort_array(F.collect_set("period")).alias("periods"))
    return p.join(f, "source_name", "left")


def whole_cards(spark: SparkSession, d: str) -> DataFrame:
    """Cards of every field that routing weighs, with all keys, periods, captions and top headings of a document instead of the first of its card.

    A card's list of names is empty, as in the source. A folder without elements or chunks has cards of names and facts.
    """
    p, facts = table(spark, d, "page_profiles"), table(spark, d, "facts")
    lists = {"key": "fact_keys", "period": "periods", "context": "table_contexts"}
    f = facts.groupBy("document").agg(*[F.collect_set(c).alias(x) for c, x in lists.items()]).join(p.select("doc_id", F.col("source_name").alias("document")).distinct(), "document")
    f = f.groupBy("doc_id").agg(*[F.sort_array(F.array_distinct(F.flatten(F.collect_list(x)))).alias(x) for x in lists.values()])
    if not (stored(spark, d, "elements") and stored(spark, d, "chunks")):
        return p.groupBy("doc_id").agg(F.min("source_name").alias("source_name")).join(f, "doc_id", "left")
    t = cut(full_tree(spark, d).where("parent_no is null").select("doc_id", "section_no", "parent_no", "title"))
    c = cut(sections.cards(p, facts, table(spark, d, "chunks"), t))
    heads = t.groupBy("doc_id").agg(F.sort_array(F.collect_set("title")).alias("sections"))
    return c.select("doc_id", "source_name", "opening", "frequent_terms").join(sections.summarised(c), "doc_id").join(f, "doc_id", "left").join(heads, "doc_id", "left")


def section_paths(spark: SparkSession, d: str) -> DataFrame:
    return sections.paths(full_tree(spark, d))


def card_summaries(spark: SparkSession, d: str) -> DataFrame:
    return sections.summarised(_cards(spark, d))


def chunk_bookkeeping(spark: SparkSession, d: str) -> DataFrame:
    """Problems of the packing by kind: there must be none."""
    e = table(spark, d, "elements")
    b = sections.bookkeeping(e, sections.chunk_elements(e, 120))
    return b.agg(F.count_if(F.col("problem") == "orphan").alias("orphans"), F.count_if(F.col("problem") == "phantom").alias("phantoms"))


def image_ratio(spark: SparkSession, d: str) -> DataFrame:
    """The share of each page that its figures cover, at most the whole."""
    return triage.image_area(table(spark, d, "elements").where("kind = 'figure'"), 595.0, 842.0)


def chunks_by_section(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of each section of a document in order, and their types."""
    c = table(spark, d, "chunks").groupBy("doc_id", "parent_section").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("chunk_type")).alias("types"), F.array_sort(F.collect_list(F.struct("chunk_no", "chunk_id"))).alias("c"))
    return c.select("doc_id", "parent_section", "n", F.array_join("types", ",").alias("types"), F.array_join(F.transform("c", lambda x: x["chunk_id"].cast("string")), ",").alias("chunk_ids"))


_ORDER = "select element_id, doc_id, row_number() over (partition by doc_id order by bbox.page, bbox.y0, bbox.x0, idx) - 1 as place from elements"
_BODY = "bd as (select doc_id, arg_max(s, (n, -s)) as body from (select doc_id, round(font_size, 1) as s, count(*) as n from elements where kind = 'text' and font_size is not null group by 1, 2) group by 1)"
_HEAD = _BODY + r""", hd as (select e.*, body, bbox.page as page, kind = 'text' and coalesce(regexp_matches(text, '\S'), false) and (coalesce(label in ('section_header', 'title'), false) or coalesce(font_size >= 1.2 * body and length(text) <= 120 and not regexp_matches(text, '\.\s*$'), false)) as heading from elements e left join bd using (doc_id)),
lv as (select *, case when heading then case when regexp_matches(text, '^[0-9]+(?:\.[0-9]+)*\s+\S') then len(regexp_extract_all(regexp_extract(text, '^([0-9]+(?:\.[0-9]+)*)\s', 1), '\.')) + 1 when coalesce(font_size >= 1.5 * body, false) then 1 else 2 end end as level, sum(heading::int) over (partition by doc_id) = 0 as bucketed, max(page) over (partition by doc_id) as last_page, case when sum(heading::int) over (partition by doc_id) = 0 then (page - 1) // 10 else sum(heading::int) over (partition by doc_id order by page, idx rows unbounded preceding) end::bigint as section_no from hd),
sc as (select doc_id, section_no, case when bool_or(bucketed) then 'Pages ' || (section_no * 10 + 1) || '-' || least(section_no * 10 + 10, max(last_page)) else coalesce(max(case when heading then trim(text) end), 'Preamble') end as title, coalesce(max(level), 1)::int as level, (case when bool_or(bucketed) then section_no * 10 + 1 else min(page) end)::int as page_start, (case when bool_or(bucketed) then least(section_no * 10 + 10, max(last_page)) else max(page) end)::int as page_end, count(*) as n_elements from lv group by 1, 2),
pr as (select a.*, (select max(b.section_no) from sc b where b.doc_id = a.doc_id and b.section_no < a.section_no and b.level < a.level) as parent_no from sc a)"""
_BELOW = "below(doc_id, root_no, section_no, depth) as (select doc_id, section_no, section_no, 0 from pr where parent_no is null union all select t.doc_id, b.root_no, t.section_no, b.depth + 1 from below b join pr t on t.doc_id = b.doc_id and t.parent_no = b.section_no)"
_CARD = _HEAD + f""", dm as (select doc_id, coalesce(arg_min(hint, (-n, hint)) filter (hint is not null), 'general') as domain from (select doc_id, nullif(domain_hint, '') as hint, count(*) as n from page_profiles group by 1, 2) group by 1),
r_sections as (select doc_id, list(title order by section_no)[1:12] as sections from pr where parent_no is null group by 1), nm as (select doc_id, min(source_name) as source_name, count(distinct page) as pages from page_profiles group by 1), dn as (select distinct doc_id, source_name as document from page_profiles),
og as (select doc_id, case when n / a >= 0.7 then origin_type else 'mixed' end as origin from (select *, sum(n) over (partition by doc_id) as a, row_number() over (partition by doc_id order by n desc, f, origin_type) as k from (select doc_id, origin_type, count(*) as n, min(page) as f from page_profiles group by 1, 2)) where k = 1),
ff as (select doc_id, fact_id, key, period, context from facts join dn using (document)), cc as (select * from chunks),
wd as (select doc_id, chunk_no, unnest(regexp_extract_all(lower(content), '[a-z][a-z0-9]{{2,}}')) as term, generate_subscripts(regexp_extract_all(lower(content), '[a-z][a-z0-9]{{2,}}'), 1) as i, chunk_id from chunks where trim(content) <> ''),
""" + ", ".join(f"r_{n} as (select doc_id, list(v order by k)[1:{top}] as {n} from (select doc_id, v, row_number() over (partition by doc_id order by n desc, f, v) as k from (select doc_id, {v} as v, count(*) as n, min({o}) as f from {t} where trim({v}) <> '' group by 1, 2) where n > 1 or '{v}' <> 'term') group by 1)" for n, v, o, t, top in (
    ("periods", "period", "fact_id", "ff", 12), ("fact_keys", "key", "fact_id", "ff", 12), ("table_contexts", "context", "fact_id", "ff", 8),
    ("frequent_terms", "term", "(chunk_no, chunk_id, i)", "(select * from wd where term not in (" + ", ".join(f"'{w}'" for w in sections.STOPWORDS) + "))", 15))) + f""",
op as (select doc_id, substr(trim(regexp_replace(arg_min(content, (chunk_no, chunk_id)), '\\s+', ' ', 'g')), 1, 300) as opening from chunks where chunk_type in ('text', 'figure') and trim(content) <> '' group by 1),
cd as (select * from nm join og using (doc_id) join dm using (doc_id) left join r_sections using (doc_id) left join r_periods using (doc_id) left join r_fact_keys using (doc_id) left join r_table_contexts using (doc_id) left join op using (doc_id) left join r_frequent_terms using (doc_id))"""
_TOKENS = lambda x: f"regexp_extract_all(lower(coalesce({x}, '')), '[a-z0-9]+')"
_JOINED = lambda x: f"array_to_string({x}, ' ')"

QUERIES = {f.__name__: f for f in (element_order, furniture_repeats, body_sizes, section_list, section_tree, section_children, page_buckets, chunk_pack, tree_nodes, corpus_root, chunk_rules, chunk_references, stored_references, chunk_entities, chunk_summaries, doc_cards, token_frequency, route_questions, section_paths, card_summaries, chunk_bookkeeping, image_ratio, chunks_by_section)}
# The packing, written out again: elements without furniture by section, captions bound, rows numbered, and a walk from row to row.
_PACK = "recursive " + _HEAD.replace("from elements e left", "from (select * from elements where kind <> 'furniture') e left") + r""", pth(doc_id, section_no, path) as (select doc_id, section_no, title from pr where parent_no is null union all select t.doc_id, t.section_no, d.path || ' > ' || t.title from pth d join pr t on t.doc_id = d.doc_id and t.parent_no = d.section_no),
el as (select doc_id, section_no, idx, element_id, page, bbox, kind, text, caption, heading, table_data.headers as h, table_data.rows as r from lv),
fg as (select doc_id, section_no, page, idx, element_id, bbox from el where kind = 'figure' and coalesce(caption, '') = ''), cp as (select doc_id, section_no, page, idx as ti, element_id as te, bbox as tb, trim(text) as words from el where kind = 'text' and regexp_matches(text, '(?i)^(figure|fig\.|table|chart)\b')),
pp as (select doc_id, section_no, page, list({'f': element_id, 't': te, 'w': words} order by idx, ti) as ps from fg join cp using (doc_id, section_no, page) where least(abs(tb.y0 - bbox.y1), abs(bbox.y0 - tb.y1)) <= 40 group by all),
cb as (select unnest(list_reduce(list_transform(ps, lambda y: [y]), lambda got, x: case when len(list_filter(got, lambda y: y.f = x[1].f or y.t = x[1].t)) = 0 then got || x else got end, [])) as b from pp),
ln as (select el.*, b.w as words, array_to_string(list_transform(h, lambda c: coalesce(trim(regexp_replace(c, '\s+', ' ', 'g')), '')), ' | ') as hl, list_transform(r, lambda x: array_to_string(list_transform(x, lambda c: coalesce(trim(regexp_replace(c, '\s+', ' ', 'g')), '')), ' | ')) as rl,
  len(h) >= 2 and len(r) > 0 and len(list_filter(h, lambda c: trim(c) <> '')) >= 0.5 * len(h) and len(list_filter(flatten(r), lambda c: trim(c) <> '')) >= 0.4 * len(flatten(r)) as sane from el left join cb on cb.b.f = el.element_id where not heading and element_id not in (select b.t from cb)),
rn as (select *, array_to_string(list_concat([hl], rl), chr(10)) as whole, greatest(1, ceil(length(hl) / 4))::int as hd from ln), sz as (select *, greatest(1, ceil(length(whole) / 4))::int as wt from rn),
ea as (select *, greatest(1, (LIMIT - hd) // greatest(1, wt // greatest(len(rl), 1))) as each from sz),
pt as (select *, case when kind = 'table' and sane and wt > LIMIT and len(rl) > 0 then list_transform(range(1, ceil(len(rl) / each)::int + 1), lambda i: '[part ' || i || '/' || ceil(len(rl) / each)::int || ']' || chr(10) || array_to_string(list_concat([hl], rl[(i - 1) * each + 1 : i * each]), chr(10))) when kind = 'table' then [whole] when kind = 'figure' then [coalesce(nullif(caption, ''), words, 'figure')] else [text] end as parts from ea),
ok as (select *, greatest(1, ceil(length(parts[1]) / 4))::int as n, row_number() over (partition by doc_id, section_no order by idx, element_id) as k from pt where trim(parts[1]) <> ''),
wk(doc_id, section_no, k, no, size, next) as (select doc_id, section_no, k, 0::bigint, case when kind = 'text' then n end, len(parts) from ok where k = 1 union all
  select o.doc_id, o.section_no, o.k, case when o.kind = 'text' and w.size + o.n <= LIMIT then w.no else w.no + w.next end, case when o.kind = 'text' then o.n + case when w.size + o.n <= LIMIT then w.size else 0 end end, len(o.parts) from wk w join ok o on o.doc_id = w.doc_id and o.section_no = w.section_no and o.k = w.k + 1),
un as (select o.doc_id, o.section_no, w.no + generate_subscripts(parts, 1) - 1 as no, case when kind = 'table' and not sane then 'text' else kind end as chunk_type, unnest(parts) as part, idx, o.element_id, page, bbox from wk w join ok o using (doc_id, section_no, k)),
ch as (select doc_id, section_no, no::int as chunk_no, min(chunk_type) as chunk_type, string_agg(part, chr(10) order by idx, element_id) as content, count(*)::int as n_elements, array_to_string(list_sort(list(distinct page)), ',') as pages, min(bbox.x0) as x0, min(bbox.y0) as y0, max(bbox.x1) as x1, max(bbox.y1) as y1 from un group by 1, 2, 3)""".replace("LIMIT", "120")
SQL = {
    "chunk_pack": f"with {_PACK} select doc_id, section_no, chunk_no, chunk_type, greatest(1, ceil(length(content) / 4))::bigint as tokens, n_elements, md5(content) as content_md5, pages, x0, y0, x1, y1, path as parent_section from ch join pth using (doc_id, section_no)",
    "tree_nodes": f"""with {_PACK}, cx as (select ch.*, path from ch join pth using (doc_id, section_no)), ty as (select doc_id, path, array_to_string(list_sort(list(distinct chunk_type)), ',') as data_types from cx group by 1, 2),
tx as (select doc_id, path, string_agg(content, ' ' order by section_no, chunk_no) as t from cx where chunk_type = 'text' group by 1, 2), sm as (select doc_id, path, substr(array_to_string(string_split_regex(regexp_replace(trim(regexp_replace(t, '\\s+', ' ', 'g')), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))[1:2], ' '), 1, 240) as summary from tx),
en as (select doc_id, path, section_no, chunk_no, unnest(l) as x, generate_subscripts(l, 1) as i from (select *, regexp_extract_all(content, '\\b[A-Z][a-z]+(?:\\s+[A-Z][a-z]+)+') as l from cx where chunk_type = 'text')), eg as (select doc_id, path, regexp_replace(regexp_replace(x, '\\s+', ' ', 'g'), '^The ', '') as name, count(*) as n, min((section_no, chunk_no, i)) as f from en group by 1, 2, 3),
es as (select doc_id, path, array_to_string(list(name order by n desc, f, name)[1:5], '; ') as key_entities from eg group by 1, 2)
select doc_id, section_no, parent_no, title, page_start, page_end, coalesce(key_entities, '') as key_entities, coalesce(summary, '') as summary, coalesce(data_types, '') as data_types from pr join pth using (doc_id, section_no) left join ty using (doc_id, path) left join sm using (doc_id, path) left join es using (doc_id, path)""",
    "corpus_root": f"with {_PACK} select 'corpus' as title, 1 as page_start, (select max(page_end) from pr) as page_end, (select count(distinct doc_id) from pr) as children, (select count(distinct doc_id) from pr) || ' ingested documents' as summary, (select array_to_string(list_sort(list(distinct chunk_type)), ',') from ch) as data_types",
    "element_order": _ORDER,
    "furniture_repeats": "with e as (select * replace (case when kind = 'furniture' then 'text' else kind end as kind) from elements), q as (select element_id, doc_id, bbox.page as page, round_even(bbox.x0 / 6, 0)::bigint as a, round_even(bbox.y0 / 6, 0)::bigint as b, round_even(bbox.x1 / 6, 0)::bigint as c, round_even(bbox.y1 / 6, 0)::bigint as f from e where kind = 'text'), p as (select doc_id, count(distinct bbox.page) as pages from elements group by 1), s as (select doc_id, a, b, c, f from q join p using (doc_id) group by all having max(pages) >= 3 and count(distinct page) / max(pages) > 0.6) select element_id, doc_id from q semi join s using (doc_id, a, b, c, f)",
    "body_sizes": f"with {_BODY} select * from bd",
    "section_list": f"with {_HEAD} select doc_id, section_no, title, level, page_start, page_end, n_elements from sc",
    "section_tree": f"with {_HEAD} select doc_id, section_no, title, level, parent_no, page_start, page_end from pr",
    "section_children": f"with {_HEAD} select p.doc_id, p.section_no, p.title, children, first_page, last_page from pr p left join (select doc_id, parent_no, count(*) as children, min(page_start) as first_page, max(page_end) as last_page from pr where parent_no is not null group by 1, 2) k on k.doc_id = p.doc_id and k.parent_no = p.section_no",
    "page_buckets": "select doc_id, 'Pages ' || (b * 10 + 1) || '-' || least(b * 10 + 10, l) as title, count(*) as n_elements from (select doc_id, (bbox.page - 1) // 10 as b, max(bbox.page) over (partition by doc_id) as l from elements) group by doc_id, b, l",
    "chunk_rules": r"with r as (select chunk_id, unnest([case when not coalesce(trim(content) <> '', false) then 'empty_content' end, case when not coalesce(trim(parent_section) <> '', false) then 'no_parent_section' end, case when chunk_type = 'table' and not coalesce(contains(content, '|'), false) then 'table_without_headers' end, case when greatest(1, ceil(length(coalesce(content, '')) / 4)) > 1125 then 'over_limit' end, case when coalesce(len(page_refs), 0) < 1 then 'no_page' end]) as rule from chunks) select * from r where rule is not null",
    "chunk_references": r"with k as (select chunk_id, doc_id, chunk_no, chunk_type, content, list_transform(regexp_extract_all(content, '(?i)\b(?:Table|Figure)\s+[0-9]+\b'), lambda m: upper(m[1]) || lower(regexp_replace(m[2:], '\s+', ' ', 'g'))) as ls from chunks), g as (select doc_id, chunk_id, chunk_no, unnest(ls) as label, 0 as how from k where chunk_type in ('table', 'figure') union all select doc_id, chunk_id, chunk_no, upper(chunk_type[1]) || chunk_type[2:] || ' ' || row_number() over (partition by doc_id, chunk_type order by chunk_no, chunk_id), 1 from k where chunk_type in ('table', 'figure') and not starts_with(content, '[part')), r as (select doc_id, label, arg_min(chunk_id, (how, chunk_no, chunk_id)) as target from g group by 1, 2) select chunk_id, label, target from (select chunk_id, doc_id, unnest(ls) as label from k where chunk_type = 'text') join r using (doc_id, label) where target <> chunk_id",
    "stored_references": "with r as (select doc_id, unnest(relationships) as x from chunks) select case when exists (select 1 from chunks c where c.doc_id = r.doc_id and c.content_hash = x.target_hash) then 'same document' when exists (select 1 from chunks c where c.content_hash = x.target_hash) then 'another document' else 'nowhere' end as target, count(*) as n from r group by 1",
    "chunk_entities": r"with e as (select doc_id, chunk_no, chunk_id, unnest(l) as x, generate_subscripts(l, 1) as i from (select doc_id, chunk_no, chunk_id, regexp_extract_all(content, '\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+') as l from chunks where chunk_type = 'text')), g as (select doc_id, regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '^The ', '') as entity, count(*) as n, min((chunk_no, chunk_id, i)) as f from e group by 1, 2) select doc_id, row_number() over (partition by doc_id order by n desc, f, entity) as rank, entity, n from g qualify rank <= 5",
    "chunk_summaries": r"select chunk_id, substr(array_to_string(string_split_regex(regexp_replace(trim(regexp_replace(content, '\s+', ' ', 'g')), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))[1:2], ' '), 1, 240) as summary from chunks where chunk_type = 'text'",
    "doc_cards": f"with {_CARD} select doc_id, source_name, pages, origin, domain, " + ", ".join(f"array_to_string({x}, '; ') as {x}" for x in ("sections", "periods", "fact_keys", "table_contexts", "frequent_terms")) + ", opening from cd",
    "token_frequency": f"with {_CARD}, tk as (select doc_id, unnest(list_distinct(list_concat({_TOKENS('source_name')}, {_TOKENS('opening')}, " + ", ".join(_TOKENS(_JOINED(x)) for x in ("sections", "periods", "fact_keys", "table_contexts", "frequent_terms")) + "))) as token from cd) select token, count(*) as df from tk group by 1",
    "route_questions": f"""with c as (select doc_id, min(source_name) as source_name from page_profiles group by 1), f as (select document as source_name, list_sort(list(distinct key)) as ks, list_sort(list(distinct period) filter (period is not null)) as ps from facts group by 1), cd as (select * from c left join f using (source_name)),
t as (select doc_id, 2.0::double as w, unnest(list_distinct({_TOKENS('source_name')})) as token from cd union all select doc_id, 2.0, unnest(list_distinct({_TOKENS(_JOINED('ks'))})) from cd union all select doc_id, 3.0, unnest(list_distinct({_TOKENS(_JOINED('ps'))})) from cd),
d as (select token, ln((1 + (select count(*) from cd)::double) / (1 + count(distinct doc_id))) as idf from t group by 1), q as (select min(fact_id) as question_id, unnest(list_distinct({_TOKENS("'What was ' || key || ' in ' || period || '?'")})) as token from facts where period is not null group by key, period),
s as (select question_id, doc_id, round(sum(w * idf), 4) as score from q join t using (token) join d using (token) group by 1, 2 having round(sum(w * idf), 4) > 0) select question_id, doc_id, score, source_name, row_number() over (partition by question_id order by score desc, source_name, doc_id) as rank from s join cd using (doc_id) qualify rank <= 3""",
    "section_paths": f"with recursive {_HEAD}, down(doc_id, section_no, path) as (select doc_id, section_no, title from pr where parent_no is null union all select t.doc_id, t.section_no, d.path || ' > ' || t.title from down d join pr t on t.doc_id = d.doc_id and t.parent_no = d.section_no) select * from down",
    "card_summaries": f"with {_CARD} select doc_id, substr(concat_ws('. ', replace(origin, '_', ' ') || ' ' || domain || ' document, ' || pages || ' pages', case when coalesce(opening, '') <> '' then 'opens: ' || substr(opening, 1, 160) end, " + ", ".join(f"case when len({c}) > 0 then '{h}: ' || array_to_string({x}, '{j}') end" for c, h, x, j in (
        ("frequent_terms", "about", "frequent_terms[1:8]", ", "), ("sections", "sections", "sections[1:5]", "; "), ("table_contexts", "tables", "list_transform(table_contexts[1:3], lambda x: substr(x, 1, 80))", "; "), ("fact_keys", "measures", "fact_keys[1:6]", ", "), ("periods", "periods", "periods[1:6]", ", "))) + "), 1, 700) as summary from cd",
    "chunk_bookkeeping": "select 0::bigint as orphans, 0::bigint as phantoms",
    "chunks_by_section": "select doc_id, parent_section, count(*) as n, array_to_string(list_sort(list(distinct chunk_type)), ',') as types, string_agg(chunk_id::varchar, ',' order by chunk_no, chunk_id) as chunk_ids from chunks group by 1, 2",
    "image_ratio": "select doc_id, page, least(floor(a / (595.0::double * 842.0) * 10000 + 0.5::double) / 10000, 1.0) as image_area_ratio from (select doc_id, bbox.page as page, round(sum(greatest(least(greatest(bbox.x1, 0), 595) - least(greatest(bbox.x0, 0), 595), 0) * greatest(least(greatest(bbox.y1, 0), 842) - least(greatest(bbox.y0, 0), 842), 0)), 2) as a from elements where kind = 'figure' group by 1, 2)",
}

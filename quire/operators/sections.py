"""From elements to sections, chunks, a navigation tree and document cards."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quire.functions import text as X
from quire.operators import tables
from quire.session import cut

# Limits of headings, furniture, captions, chunks and cards.
HEADING_RATIO, HEADING_CHARS, LEVEL1_RATIO, BUCKET = 1.2, 120, 1.5, 10
QUANTUM, REPEAT, MIN_PAGES, CAPTION_PT = 6.0, 0.60, 3, 40.0
MAX_TOKENS, QUARANTINE = 900, 1.25
TERMS, LISTED, CONTEXTS, OPENING, SUMMARY = 15, 12, 8, 300, 240
#: How a caption begins.
CAPTION_START = r"(?i)^(figure|fig\.|table|chart)\b"
# Words that say nothing about a document.
STOPWORDS = "the and for with from that this are was were has have had been being not its their our your his her they them will would could should than then there where which while about into over under between during per each other more most some such only also may can must shall any all both these those out off but nor did does doing done who whom whose what when how birr etb page table figure report year years month months total".split()


def reading_order(elements: DataFrame) -> DataFrame:
    """element_id, place: elements by page, top and left edge within their document, ties by their given index.

    A document of any size is numbered without being sorted in one task: counts per page add up, and only pages are put in order.
    """
    e = elements.select("element_id", "doc_id", F.col("bbox.page").alias("page"), F.col("bbox.y0").alias("y0"), F.col("bbox.x0").alias("x0"), "idx")
    n = e.groupBy("doc_id", "page").agg(F.count("*").alias("n"))
    n = n.withColumn("before", F.sum("n").over(Window.partitionBy("doc_id").orderBy("page")) - F.col("n")).drop("n")
    w = Window.partitionBy("doc_id", "page").orderBy("y0", "x0", "idx")
    return e.join(n, ["doc_id", "page"]).select("element_id", "doc_id", (F.col("before") + F.row_number().over(w) - 1).alias("place"))


def furniture(elements: DataFrame) -> DataFrame:
    """element_id of text elements whose quantised position repeats on more than REPEAT of a document's pages (3 pages at least)."""
    q = lambda c: F.rint(F.col(c) / QUANTUM).cast("bigint")
    pages = elements.groupBy("doc_id").agg(F.count_distinct("bbox.page").alias("pages"))
    t = elements.where("kind = 'text'").select("element_id", "doc_id", F.col("bbox.page").alias("page"), *[q(f"bbox.{c}").alias(f"q{c}") for c in ("x0", "y0", "x1", "y1")])
    key = ["doc_id", "qx0", "qy0", "qx1", "qy1"]
    seen = t.groupBy(*key).agg(F.count_distinct("page").alias("on")).join(pages, "doc_id").where((F.col("pages") >= MIN_PAGES) & (F.col("on") / F.col("pages") > REPEAT))
    return t.join(seen, key, "left_semi").select("element_id", "doc_id")


def body_size(elements: DataFrame) -> DataFrame:
    """doc_id, body: the most frequent font size (one decimal), the smallest of equals."""
    n = elements.where("kind = 'text' and font_size is not null").groupBy("doc_id", F.round("font_size", 1).alias("s")).agg(F.count("*").alias("n"))
    return n.groupBy("doc_id").agg(F.max_by("s", F.struct("n", (-F.col("s")).alias("m"))).alias("body"))


def is_heading(label: Column, size: Column, body: Column, text: Column) -> Column:
    big = (size >= HEADING_RATIO * body) & (F.length(text) <= HEADING_CHARS) & ~text.rlike(r"\.\s*$")
    return F.coalesce(text.rlike(r"\S"), F.lit(False)) & (F.coalesce(label.isin("section_header", "title"), F.lit(False)) | F.coalesce(big, F.lit(False)))


def level(text: Column, size: Column, body: Column) -> Column:
    """Depth by the number in front ("2.3 Stock" is 2), else by size."""
    number = F.regexp_extract(text, r"^([0-9]+(?:\.[0-9]+)*)\s+\S", 1)
    return F.when(number != "", F.regexp_count(number, F.lit(r"\.")) + 1).when(F.coalesce(size >= LEVEL1_RATIO * body, F.lit(False)), 1).otherwise(2)


def with_sections(elements: DataFrame) -> DataFrame:
    """Elements with section_no (running count of headings before them in their document; ten pages each where it has none) and what makes a heading of them."""
    e = elements.join(body_size(elements), "doc_id", "left")
    e = e.withColumn("heading", (F.col("kind") == "text") & is_heading(F.col("label"), F.col("font_size"), F.col("body"), F.col("text")))
    e = e.withColumn("level", F.when(F.col("heading"), level(F.col("text"), F.col("font_size"), F.col("body"))))
    # Running counts over a document go by pages first, so a hot document is counted in pieces.
    page = F.col("bbox.page")
    per = e.groupBy("doc_id", page.alias("page")).agg(F.count_if("heading").alias("h"))
    whole = Window.partitionBy("doc_id")
    per = per.withColumns({"before": F.sum("h").over(Window.partitionBy("doc_id").orderBy("page")) - F.col("h"), "bucketed": F.sum("h").over(whole) == 0, "last_page": F.max("page").over(whole)}).drop("h")
    e = e.withColumn("page", page).join(per, ["doc_id", "page"])
    w = Window.partitionBy("doc_id", "page").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    count = F.col("before") + F.sum(F.col("heading").cast("int")).over(w)
    return e.withColumn("section_no", F.when(F.col("bucketed"), F.floor((F.col("page") - 1) / BUCKET)).otherwise(count)).drop("before")


def sections(elements: DataFrame) -> DataFrame:
    """doc_id, section_no, title, level, page_start, page_end, n_elements; what stands before the first heading is the Preamble, a document without any heading has ten-page sections, the last one up to its last page."""
    e = with_sections(elements)
    s = e.groupBy("doc_id", "section_no").agg(F.max(F.when(F.col("heading"), F.trim("text"))).alias("title"), F.max("level").alias("level"), F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.count("*").alias("n_elements"), F.first("bucketed").alias("bucketed"), F.first("last_page").alias("last_page"))
    first = (F.col("section_no") * BUCKET + 1).cast("int")
    last = F.least(first + BUCKET - 1, "last_page")
    own = lambda a, b: F.when(F.col("bucketed"), a).otherwise(b)
    return s.select("doc_id", "section_no", own(F.format_string("Pages %d-%d", first, last), F.coalesce("title", F.lit("Preamble"))).alias("title"), F.coalesce("level", F.lit(1)).alias("level"), own(first, F.col("page_start")).alias("page_start"), own(last, F.col("page_end")).alias("page_end"), "n_elements")


def page_buckets(elements: DataFrame) -> DataFrame:
    """doc_id, title, n_elements: ten-page sections as for documents without any heading; the last ends with the document."""
    e = elements.groupBy("doc_id", F.floor((F.col("bbox.page") - 1) / BUCKET).alias("bucket")).agg(F.count("*").alias("n_elements"), F.max("bbox.page").alias("to"))
    e = e.withColumn("last", F.least(F.col("bucket") * BUCKET + BUCKET, F.max("to").over(Window.partitionBy("doc_id"))))
    return e.select("doc_id", F.format_string("Pages %d-%d", F.col("bucket") * BUCKET + 1, F.col("last")).alias("title"), "n_elements")


def parents(secs: DataFrame) -> DataFrame:
    """The sections with parent_no (the last section before it of a smaller level; null: the document), root_no, depth and path (titles from
    the top-level section down, joined by " > ").

    A document's sections are folded in order: a stack holds those that are still open, so depth has no bound, nothing is
    recursive, and the sections of a document need not come together.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stack = None, []
        for b in batches:
            found: list[tuple] = []
            for d, no, level, title in zip(*(b.column(c).to_pylist() for c in ("doc_id", "section_no", "level", "title"))):
                if d != here:
                    here, stack = d, []
                while stack and level is not None and stack[-1][0] >= level:
                    stack.pop()
                above = stack[-1] if stack and level is not None else None
                path = title if above is None else None if title is None or above[3] is None else f"{above[3]} > {title}"
                found.append((above and above[1], above[2] if above else no, len(stack) if above else 0, path))
                if no is not None and level is not None:
                    stack.append((level, no, found[-1][1], path))
            types = [b.schema.field("section_no").type] * 2 + [pa.int32(), pa.string()]
            cols = [pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 4, types)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, "parent_no", "root_no", "depth", "path"])

    no = secs.schema["section_no"].dataType
    schema = T.StructType([*secs.schema.fields, T.StructField("parent_no", no), T.StructField("root_no", no), T.StructField("depth", T.IntegerType()), T.StructField("path", T.StringType())])
    return secs.repartition("doc_id").sortWithinPartitions("doc_id", "section_no").mapInArrow(fold, schema)


def bound_captions(e: DataFrame) -> DataFrame:
    """figure_id, caption_id, words: for figures without a caption (element_id, doc_id, section_no, page, idx, kind, y0, y1, text, caption of e), in order, the first
    caption text of their section and page within CAPTION_PT that no figure before took."""
    at = ["doc_id", "section_no", "page"]
    f = e.where("kind = 'figure' and coalesce(caption, '') = ''").select(*at, F.col("idx").alias("fi"), F.col("element_id").alias("figure_id"), F.col("y0").alias("f0"), F.col("y1").alias("f1"))
    t = e.where("kind = 'text'").where(F.col("text").rlike(CAPTION_START)).select(*at, F.col("idx").alias("ti"), F.col("element_id").alias("caption_id"), "y0", "y1", F.trim("text").alias("words"))
    near = f.join(t, at).where(F.least(F.abs(F.col("y0") - F.col("f1")), F.abs(F.col("f0") - F.col("y1"))) <= CAPTION_PT)
    pairs = near.groupBy(*at).agg(F.array_sort(F.collect_list(F.struct("fi", "ti", "figure_id", "caption_id", "words"))).alias("pairs"))
    taken = F.slice("pairs", 1, 0)  # none yet, of the pairs' type
    free = lambda got, p: ~F.exists(got, lambda g: (g["figure_id"] == p["figure_id"]) | (g["caption_id"] == p["caption_id"]))
    return pairs.select(F.explode(F.aggregate("pairs", taken, lambda got, p: F.when(free(got, p), F.concat(got, F.array(p))).otherwise(got))).alias("p")).select("p.figure_id", "p.caption_id", "p.words")


CHUNKS = "doc_id string, section_no bigint, chunk_no int, chunk_type string, content string, tokens bigint, page_refs array<int>, x0 double, y0 double, x1 double, y1 double, elements array<bigint>"


def chunk_elements(elements: DataFrame, limit: int = MAX_TOKENS) -> DataFrame:
    """doc_id, section_no, chunk_no, chunk_type, content, tokens, page_refs, bbox (its page the first element's), parent_section, elements: sections packed to chunks in given order.

    Text is packed, a line for each element, until the next would break the limit; a table or figure closes the packing and stands
    alone, a sane table in parts under the limit, one that fails its checks as text. Captions near a figure without one go with it
    (bound_captions()); headings and furniture are consumed without content, as are elements without text. The packing reads each
    section as it comes, sorted, and holds one chunk, so a section may be of any length.
    """
    e = with_sections(elements.where("kind <> 'furniture'"))
    e = e.select("doc_id", "section_no", "idx", "element_id", "page", "kind", "heading", "text", "caption", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"), F.col("table_data.headers").alias("h"), F.col("table_data.rows").alias("r"))
    bound = cut(bound_captions(e))
    e = e.join(bound.select(F.col("figure_id").alias("element_id"), "words"), "element_id", "left").join(bound.select(F.col("caption_id").alias("element_id")), "element_id", "left_anti").where("not heading")
    sane = F.size(tables.failed_checks(F.col("h"), F.col("r"))) == 0
    parts = F.when((F.col("kind") == "table") & sane, tables.split_parts(F.col("h"), F.col("r"), limit)).when(F.col("kind") == "table", F.array(tables.rendered(F.coalesce("h", F.array().cast("array<string>")), F.coalesce("r", F.array().cast("array<array<string>>")))))
    parts = parts.when(F.col("kind") == "figure", F.array(F.coalesce(F.when(F.col("caption") != "", F.col("caption")), F.col("words"), F.lit("figure")))).otherwise(F.array("text"))
    kind = F.when((F.col("kind") == "table") & ~sane, "debris").otherwise(F.col("kind"))
    rows = e.select("doc_id", "section_no", "idx", "element_id", "page", kind.alias("kind"), "x0", "y0", "x1", "y1", parts.alias("parts")).where(X.filled(F.get("parts", F.lit(0))))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, no, held, size = None, 0, [], 0
        out: list[tuple] = []

        def add(kind: str, text: str, of: list[dict]) -> None:
            nonlocal no
            box = [f([x[c] for x in of]) for f, c in ((min, "x0"), (min, "y0"), (max, "x1"), (max, "y1"))]
            # The first page comes first; the box is of that page.
            out.append((*here, no, kind, text, max(1, -(-len(text) // 4)), sorted({x["page"] for x in of}), *box, [x["element_id"] for x in of]))
            no += 1

        def close() -> None:
            nonlocal held, size
            if held:
                add("text", "\n".join(x["parts"][0] for x in held), held)
            held, size = [], 0

        def batch() -> pa.RecordBatch:
            nonlocal out
            got, out = out, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got) if got else [()] * len(arrow), arrow)], schema=arrow)

        for b in batches:
            for x in b.to_pylist():
                if (x["doc_id"], x["section_no"]) != here:
                    close()
                    here, no = (x["doc_id"], x["section_no"]), 0
                if x["kind"] != "text":
                    close()
                    for p in x["parts"]:
                        add("text" if x["kind"] == "debris" else x["kind"], p, [x])
                    continue
                n = max(1, -(-len(x["parts"][0]) // 4))
                if held and size + n > limit:
                    close()
                held.append(x)
                size += n
            yield batch()
        close()
        yield batch()

    schema = T._parse_datatype_string(CHUNKS)
    arrow = to_arrow_schema(schema)
    packed = rows.repartition("doc_id", "section_no").sortWithinPartitions("doc_id", "section_no", "idx", "element_id").mapInArrow(fold, schema)
    named = parents(sections(elements.where("kind <> 'furniture'"))).select("doc_id", "section_no", F.col("path").alias("parent_section"))
    box = F.struct("x0", "y0", "x1", "y1", F.get("page_refs", F.lit(0)).alias("page")).alias("bbox")
    return packed.join(named, ["doc_id", "section_no"], "left").select("doc_id", "section_no", "chunk_no", "chunk_type", "content", "tokens", "page_refs", box, "parent_section", "elements")


def nodes(chunks: DataFrame, tree: DataFrame) -> DataFrame:
    """doc_id, section_no, parent_no, depth, title, page_start, page_end, key_entities, summary, data_types: the tree's nodes (of parents()) with what the chunks say
    whose parent_section is the node's path: the five most frequent names and the first two sentences of their text in order, and their types.

    Sections of one path share their chunks. A node without text has an empty summary and no names.
    """
    c = chunks.select("doc_id", F.col("parent_section").alias("path"), "chunk_type", "content", "section_no", "chunk_no")
    own = c.groupBy("doc_id", "path").agg(F.array_sort(F.collect_set("chunk_type")).alias("data_types"))
    text = c.where("chunk_type = 'text'")
    # Two sentences need the first chunks only, as far as a summary can reach; their order is the section's.
    place = Window.partitionBy("doc_id", "path").orderBy("section_no", "chunk_no").rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    heads = text.withColumn("before", F.coalesce(F.sum(F.length(X.collapsed(F.col("content")))).over(place), F.lit(0)))
    heads = heads.where(F.col("before") <= SUMMARY).groupBy("doc_id", "path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_no", "chunk_no", "content"))), lambda x: x["content"]), " ").alias("head"))
    names = text.select("doc_id", "path", "section_no", "chunk_no", F.posexplode(entities(F.col("content"))).alias("i", "name")).withColumn("at", F.struct("doc_id", "path"))
    names = most_frequent(names, "at", "name", ["section_no", "chunk_no", "i"], 5).groupBy("at").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda x: x["name"]).alias("key_entities")).select("at.*", "key_entities")
    at = ["doc_id", "path"]
    out = tree.join(own, at, "left").join(heads, at, "left").join(names, at, "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "section_no", "parent_no", "depth", "title", "page_start", "page_end", F.coalesce("key_entities", none).alias("key_entities"), F.coalesce(summary(F.col("head")), F.lit("")).alias("summary"), F.coalesce("data_types", none).alias("data_types"))


def violations(chunks: DataFrame, limit: int = MAX_TOKENS) -> DataFrame:
    """chunk_id, rule: each rule of the stored chunks that one breaks."""
    c = chunks.select("chunk_id", F.explode(F.array_compact(F.array(
        F.when(~F.coalesce(X.filled(F.col("content")), F.lit(False)), "empty_content"), F.when(~F.coalesce(X.filled(F.col("parent_section")), F.lit(False)), "no_parent_section"),
        F.when((F.col("chunk_type") == "table") & ~F.coalesce(F.col("content").contains("|"), F.lit(False)), "table_without_headers"),
        F.when(X.token_estimate(F.coalesce("content", F.lit(""))) > QUARANTINE * limit, "over_limit"), F.when(F.coalesce(F.size("page_refs"), F.lit(0)) < 1, "no_page")))).alias("rule"))
    return c


def references(chunks: DataFrame) -> DataFrame:
    """chunk_id, label, target: mentions of tables and figures in text, with the chunk of the document that carries the label.

    A label is carried by the first table or figure chunk that spells it; else by the chunk of that ordinal among its document's
    unsplit tables (or figures). A chunk is no target of its own.
    """
    c = chunks.select("chunk_id", "doc_id", "chunk_no", "chunk_type", "content")
    spell = F.transform(F.regexp_extract_all("content", F.lit(r"(?i)\b(Table|Figure)\s+([0-9]+)\b"), F.lit(0)), lambda m: F.initcap(F.regexp_replace(m, r"\s+", " ")))
    kinds = c.where("chunk_type in ('table', 'figure')")
    named = kinds.select("doc_id", "chunk_id", "chunk_no", F.explode(spell).alias("label"), F.lit(0).alias("how"))
    w = Window.partitionBy("doc_id", "chunk_type").orderBy("chunk_no", "chunk_id")
    counted = kinds.where(~F.col("content").startswith("[part")).withColumn("n", F.row_number().over(w)).select("doc_id", "chunk_id", "chunk_no", F.concat(F.initcap("chunk_type"), F.lit(" "), F.col("n")).alias("label"), F.lit(1).alias("how"))
    registry = named.unionByName(counted).groupBy("doc_id", "label").agg(F.min(F.struct("how", "chunk_no", "chunk_id")).alias("t")).select("doc_id", "label", F.col("t.chunk_id").alias("target"))
    said = c.where("chunk_type = 'text'").select("chunk_id", "doc_id", F.explode(spell).alias("label"))
    return said.join(registry, ["doc_id", "label"]).where("target <> chunk_id").select("chunk_id", "label", "target")


def entities(text: Column) -> Column:
    """Runs of two capitalised words or more, without a leading The."""
    found = F.regexp_extract_all(text, F.lit(r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+"), F.lit(0))
    return F.transform(found, lambda x: F.regexp_replace(X.collapsed(x), "^The ", ""))


def summary(text: Column) -> Column:
    """The first two sentences, 240 characters at most."""
    return F.substring(F.array_join(F.slice(F.split(X.collapsed(text), r"(?<=[.!?])\s+"), 1, 2), " "), 1, SUMMARY)


def most_frequent(rows: DataFrame, key: str, value: str, order: list[str], top: int) -> DataFrame:
    """key, rank, value, n: the most frequent values of each key, equals by first appearance."""
    n = rows.groupBy(key, value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
    w = Window.partitionBy(key).orderBy(F.desc("n"), "first", value)
    return n.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= top).select(key, "rank", value, "n")


def dominant_domain(profiles: DataFrame) -> DataFrame:
    """doc_id, domain: the most frequent domain hint of its pages, the first in the alphabet of equals; "general" without any."""
    n = profiles.groupBy("doc_id", F.when(F.col("domain_hint") != "", F.col("domain_hint")).alias("hint")).agg(F.count("*").alias("n"))
    return n.groupBy("doc_id").agg(F.coalesce(F.min_by("hint", F.when(F.col("hint").isNotNull(), F.struct((-F.col("n")).alias("n"), "hint"))), F.lit("general")).alias("domain"))


def top_sections(tree: DataFrame, top: int = LISTED) -> DataFrame:
    """doc_id, sections: the titles of the first top-level sections, in order (tree of parents())."""
    s = tree.where("parent_no is null").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section_no", "title"))).alias("s"))
    return s.select("doc_id", F.transform(F.slice("s", 1, top), lambda x: x["title"]).alias("sections"))


def cards(profiles: DataFrame, facts: DataFrame, chunks: DataFrame, tree: DataFrame) -> DataFrame:
    """One row per document: name, pages, origin, domain, sections, periods, fact_keys, table_contexts, opening, frequent_terms.

    Lists go from the most frequent value to the least, blank ones left out; sections stand in order. Terms are words of any chunk that
    occur more than once. The opening is the first text or figure chunk with content, its white space collapsed before the clip.
    """
    from quire.operators import triage

    p = profiles.groupBy("doc_id").agg(F.min("source_name").alias("source_name"), F.count_distinct("page").alias("pages")).join(triage.dominant_origin(profiles).select("doc_id", F.col("dominant_origin").alias("origin")), "doc_id").join(dominant_domain(profiles), "doc_id")
    names = profiles.select("doc_id", F.col("source_name").alias("document")).distinct()
    f = facts.select("document", "fact_id", "key", "period", "context").join(names, "document")

    def listed(rows: DataFrame, value: str, order: list[str], name: str, top: int = LISTED, least: int = 1) -> DataFrame:
        t = most_frequent(rows.where(X.filled(F.col(value))), "doc_id", value, order, top).where(F.col("n") >= least)
        return t.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", value))), lambda s: s[value]).alias(name))

    c = chunks.select("doc_id", "chunk_id", "chunk_no", "chunk_type", "content").where(X.filled(F.col("content")))
    opening = c.where("chunk_type in ('text', 'figure')").groupBy("doc_id").agg(F.substring(X.collapsed(F.min_by("content", F.struct("chunk_no", "chunk_id"))), 1, OPENING).alias("opening"))
    words = c.select("doc_id", "chunk_no", "chunk_id", F.posexplode(F.regexp_extract_all(F.lower("content"), F.lit("[a-z][a-z0-9]{2,}"), F.lit(0))).alias("i", "term")).where(~F.col("term").isin(STOPWORDS))
    out = p
    for part in (top_sections(tree), listed(f, "period", ["fact_id"], "periods"), listed(f, "key", ["fact_id"], "fact_keys"), listed(f, "context", ["fact_id"], "table_contexts", CONTEXTS), opening, listed(words, "term", ["chunk_no", "chunk_id", "i"], "frequent_terms", TERMS, 2)):
        out = out.join(part, "doc_id", "left")
    return out


def paths(tree: DataFrame) -> DataFrame:
    """doc_id, section_no, path of parents()."""
    return tree.select("doc_id", "section_no", "path")


def summarised(cards: DataFrame) -> DataFrame:
    """doc_id, summary: the card in a sentence of its filled parts, 700 characters at most."""
    some = lambda c, n: F.slice(c, 1, n)
    part = lambda c, head, text: F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.concat(F.lit(head), text))
    pieces = [
        F.concat(F.replace("origin", F.lit("_"), F.lit(" ")), F.lit(" "), F.col("domain"), F.lit(" document, "), F.col("pages").cast("string"), F.lit(" pages")),
        F.when(F.coalesce("opening", F.lit("")) != "", F.concat(F.lit("opens: "), F.substring("opening", 1, 160))),
        part("frequent_terms", "about: ", F.array_join(some("frequent_terms", 8), ", ")), part("sections", "sections: ", F.array_join(some("sections", 5), "; ")),
        part("table_contexts", "tables: ", F.array_join(F.transform(some("table_contexts", 3), lambda x: F.substring(x, 1, 80)), "; ")), part("fact_keys", "measures: ", F.array_join(some("fact_keys", 6), ", ")), part("periods", "periods: ", F.array_join(some("periods", 6), ", ")),
    ]
    return cards.select("doc_id", F.substring(F.concat_ws(". ", *pieces), 1, 700).alias("summary"))


def bookkeeping(elements: DataFrame, chunks: DataFrame) -> DataFrame:
    """element_id, problem: elements that no chunk took (orphan) and ids in chunks that no element has (phantom); headings, furniture and bound captions are taken silently."""
    taken = chunks.select(F.explode("elements").alias("element_id")).distinct()
    e = with_sections(elements.where("kind <> 'furniture'")).select("element_id", "doc_id", "section_no", "page", "idx", "kind", "heading", "text", "caption", F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"))
    expected = e.where("not heading").where((F.col("kind") != "text") | X.filled(F.col("text"))).select("element_id").join(bound_captions(e).select(F.col("caption_id").alias("element_id")), "element_id", "left_anti")
    return expected.join(taken, "element_id", "left_anti").select("element_id", F.lit("orphan").alias("problem")).unionByName(taken.join(elements.select("element_id"), "element_id", "left_anti").select("element_id", F.lit("phantom").alias("problem")))

"""Walking the section tree, searching with a fallback, and tallies of what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import vectors
from quire.operators.answers import LOOKUP_LIMIT, prefix_depth

def found_sections(tree: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, wanted, section_no, title, how: for each wanted title (doc_id, wanted) the first section of that title, whatever the
    case; else the first whose title contains it; the shallowest goes first. Not listed where neither is there."""
    t = tree.select("doc_id", "section_no", "depth", "title", F.lower(F.trim("title")).alias("t"))
    j = wanted.select("doc_id", "wanted", F.lower(F.trim("wanted")).alias("w")).join(t, "doc_id").where(F.col("t").contains(F.col("w")))
    how = F.when(F.col("t") == F.col("w"), 0).otherwise(1)
    best = j.groupBy("doc_id", "wanted").agg(F.min(F.struct(how.alias("how"), "depth", "section_no", "title")).alias("b"))
    return best.select("doc_id", "wanted", F.col("b.section_no").alias("section_no"), F.col("b.title").alias("title"), F.when(F.col("b.how") == 0, "exact").otherwise("contains").alias("how"))


def descendants(tree: DataFrame) -> DataFrame:
    """doc_id, root_no, section_no, depth: every section below each top-level section (tree of sections.parents())."""
    return tree.select("doc_id", "root_no", "section_no", "depth")


def search(points: DataFrame, query: list[float], k: int, scope: Column | None) -> DataFrame:
    """The nearest points of the scope; where it holds none, of all, and a note says so."""
    if scope is None:
        return vectors.nearest(points, query, k).withColumn("note", F.lit(None).cast("string"))
    inside = vectors.nearest(points, query, k, scope).withColumn("note", F.lit(None).cast("string"))
    some = points.where(scope).limit(1).select(F.lit(True).alias("any"))
    # One plan for both cases: the wider search is dropped by an anti-join with the one row that says the scope isn't empty.
    wide = vectors.nearest(points, query, k).withColumn("note", F.lit("nothing in the section; searched everywhere")).withColumn("any", F.lit(True)).join(some, "any", "left_anti").drop("any")
    return inside.unionByName(wide)


def printed_elsewhere(claims: DataFrame, facts: DataFrame, limit: int = LOOKUP_LIMIT, digits: int = 9) -> DataFrame:
    """claim_id, document: other documents in which the claim's value stands under the longest prefix of its words that the document has."""
    c = claims.select("claim_id", F.col("document").alias("own"), X.claim_value(F.col("claim")).alias("value"), X.claim_words(F.col("claim")).alias("words")).where("value is not null and size(words) > 0")
    f = facts.select("fact_id", "document", F.lower("key").alias("k"), "value_num")
    same = c.withColumn("v", F.round("value", digits)).join(f.where("value_num is not null").withColumn("v", F.round("value_num", digits)), "v").where("own <> document")
    pairs = same.where(F.col("k").contains(F.col("words")[0])).select("claim_id", "document", "value", "words").distinct()
    keys = facts.where("key is not null").select("document", "key").distinct().withColumn("k", F.lower("key"))
    hit = pairs.join(keys, "document").where(F.col("k").contains(F.col("words")[0])).withColumn("depth", prefix_depth(F.col("words"), F.col("k")))
    w = Window.partitionBy("claim_id", "document")
    hit = hit.withColumn("best", F.max("depth").over(w)).where("depth = best").join(facts.select("document", "key", "fact_id", "value_num"), ["document", "key"]).withColumn("nth", F.row_number().over(w.orderBy("fact_id"))).where(F.col("nth") <= limit)
    return hit.where(F.round("value_num", digits) == F.round("value", digits)).select("claim_id", "document").distinct()


def matched_labels(truth: DataFrame, facts: DataFrame) -> DataFrame:
    """truth (document, label, value) with ok: the label's facts hold the value. A label meets a key letter by letter, else in normalised form if only one key has it."""
    norm = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    keys = facts.where("key is not null").select("document", "key").distinct().withColumn("n", norm(F.col("key")))
    one = keys.groupBy("document", "n").agg(F.min("key").alias("by_form"), F.count("*").alias("c")).where("c = 1").drop("c")
    t = truth.withColumn("n", norm(F.col("label"))).join(keys.select("document", F.col("key").alias("label"), F.lit(True).alias("literal")), ["document", "label"], "left").join(one, ["document", "n"], "left")
    t = t.withColumn("key", F.when(F.col("literal"), F.col("label")).otherwise(F.col("by_form")))
    have = facts.where("value_num is not null and key is not null").select("document", "key", F.col("value_num").alias("value")).distinct().withColumn("ok", F.lit(True))
    return t.join(have, ["document", "key", "value"], "left").select("document", "label", "value", F.col("key").isNotNull().alias("found"), F.coalesce("ok", F.lit(False)).alias("ok"))


def routing_tally(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """kind, questions, first, among: how often the right document ranks first and among the listed, per kind and for ALL. A question counts once for each document."""
    hit = truth.join(ranked.select("question_id", F.col("source_name").alias("document"), "rank"), ["question_id", "document"], "left")
    t = hit.groupBy("question_id", "document", "kind").agg(F.min("rank").alias("rank")).rollup("kind").agg(F.count("*").alias("questions"), F.count_if(F.col("rank") == 1).alias("first"), F.count_if(F.col("rank").isNotNull()).alias("among"))
    return t.withColumn("kind", F.coalesce("kind", F.lit("ALL")))


def ink_cells(pixels: DataFrame, keys: list[str], k: int, least: float = 0.02) -> DataFrame:
    """keys, r, c: cells of k x k pixels of which at least the share is darker than the page's threshold; pixels has keys, y, x, gray (0 to 255).

    Cells that the page's edge cuts are left out. A page of one shade has no ink.
    """
    from quire.operators import coverage

    t = coverage.otsu(pixels.select(*keys, F.col("gray").alias("bin")), keys).where("threshold >= 0")
    p = pixels.join(t, keys).select(*keys, F.floor(F.col("y") / k).cast("int").alias("r"), F.floor(F.col("x") / k).cast("int").alias("c"), (F.col("gray") <= F.col("threshold")).alias("dark"))
    return p.groupBy(*keys, "r", "c").agg(F.count("*").alias("n"), F.count_if("dark").alias("d")).where((F.col("n") == k * k) & (F.col("d") >= least * k * k)).select(*keys, "r", "c")


def corpus_root(nodes: DataFrame) -> DataFrame:
    """title, page_start, page_end, children, summary, data_types: the one root above all documents' trees (nodes of sections.nodes()); of no documents, one without children."""
    per = nodes.groupBy("doc_id").agg(F.max("page_end").alias("to"), F.flatten(F.collect_set("data_types")).alias("types"))
    one = per.agg(F.coalesce(F.max("to"), F.lit(1)).alias("page_end"), F.count("*").alias("children"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("data_types"))
    return one.select(F.lit("corpus").alias("title"), F.lit(1).alias("page_start"), "page_end", "children", F.format_string("%d ingested documents", "children").alias("summary"), "data_types")


def reread(facts: DataFrame, names: DataFrame, elements: DataFrame) -> DataFrame:
    """fact_id, printed: whether some element of the fact's page that its box touches still prints the fact's value (names: doc_id, document).

    A fact without a box, or of a file that no page is known of, is not printed. Texts and table cells are read with collapsed white space.
    """
    from quire.operators import tables

    h, r = F.col("table_data.headers"), F.col("table_data.rows")
    text = F.when(F.col("kind") == "table", tables.rendered(h, r)).otherwise(F.coalesce("text", "caption"))
    e = elements.join(names, "doc_id").select("document", F.col("bbox.page").alias("page"), F.col("bbox").alias("b"), X.collapsed(text).alias("words"))
    f = facts.where("value_raw is not null").select("fact_id", "document", "page", "x0", "y0", "x1", "y1", X.collapsed(F.col("value_raw")).alias("raw"))
    hit = f.join(e, ["document", "page"]).where("b.x0 < x1 and b.x1 > x0 and b.y0 < y1 and b.y1 > y0").where(F.col("words").contains(F.col("raw"))).select("fact_id").distinct()
    return facts.select("fact_id").distinct().join(hit.withColumn("printed", F.lit(True)), "fact_id", "left").fillna({"printed": False})

"""All queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import languages, lookalikes, mixing, nearduplicates, packing, percentiles, pii, scannoise, splitting, tokens
from quire.session import cut, shared_folder, table

METRICS = ["coverage_residual", "processing_time_s"]
QS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "ledger").select("entry_id", "strategy_used", *METRICS)
    return percentiles.above_percentile(df, "strategy_used", "entry_id", METRICS, 99)


def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Sketches of single days, merged, against the exact ranks of their answers."""
    df = table(spark, d, "ledger").select("strategy_used", "logged_at", *METRICS)
    days = percentiles.sketches(df, ["strategy_used", F.to_date("logged_at").alias("day")], METRICS)
    answers = percentiles.quantiles(percentiles.merged(days, ["strategy_used"], METRICS), ["strategy_used"], METRICS, QS)
    answers = answers.groupBy("strategy_used", "metric", "n").agg(F.map_from_entries(F.collect_list(F.struct("q", "value"))).alias("at"))
    j = percentiles._beside(percentiles.values(df, ["strategy_used"], METRICS), cut(answers.withColumnsRenamed({"strategy_used": "__key", "metric": "__metric"})), "strategy_used")
    sums = [f(q) for q in QS for f in (lambda q: F.count_if(F.col("value") < F.col("at")[F.lit(q)]).alias(f"b{QS.index(q)}"), lambda q: F.count_if(F.col("value") <= F.col("at")[F.lit(q)]).alias(f"a{QS.index(q)}"))]
    got = j.groupBy("strategy_used", "metric", "n").agg(*sums)
    e = percentiles.rank_error()
    rows = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), ((F.col(f"b{i}") <= (q + e) * F.col("n") + 1) & (F.col(f"a{i}") >= (q - e) * F.col("n") - 1)).alias("within_bound")) for i, q in enumerate(QS)]))
    return got.select("strategy_used", "metric", "n", rows.alias("r")).select("strategy_used", "metric", "n", "r.*")


_LEDGER = """with v as (select entry_id, strategy_used, 'coverage_residual' as metric, coverage_residual as value from ledger
  union all select entry_id, strategy_used, 'processing_time_s', processing_time_s from ledger),
ok as (select * from v where value is not null and not isnan(value) and value >= 0)"""

QUERIES = {"p5_found": p5_found, "p5_percentiles": p5_percentiles}
SQL = {
    "p5_found": _LEDGER + """, r as (select strategy_used, metric, value, row_number() over (partition by strategy_used, metric order by value) i, count(*) over (partition by strategy_used, metric) n from ok),
l as (select strategy_used, metric, value as lim from r where i = (99 * n + 99) // 100)
select distinct ok.metric, entry_id from ok join l on ok.metric = l.metric and ok.strategy_used is not distinct from l.strategy_used where value > lim""",
    "p5_percentiles": _LEDGER + """ select strategy_used, metric, count(*) as n, q, true as within_bound from ok, (values (0.1::double), (0.25), (0.5), (0.75), (0.9), (0.95), (0.99)) t(q) group by 1, 2, 4""",
}


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "facts").select("fact_id", "key", "document", "page", "period")
    e = table(spark, d, "elements").where("kind = 'text'").select("element_id", "text", "doc_id", F.col("bbox.page").alias("page"))
    col = F.col
    a = lookalikes.same_looking(f, "fact_id", "key", [col("document"), col("page"), col("period")])
    b = lookalikes.same_looking(e, "element_id", "text", [col("doc_id"), col("page")])
    return a.select(F.lit("facts").alias("source"), "*").unionByName(b.select(F.lit("elements").alias("source"), "*"))


def p3_canonical_keys(spark: SparkSession, d: str) -> DataFrame:
    """Each consistent form of a key, with the number of spellings and rows it brings together."""
    keys = table(spark, d, "facts").groupBy("key").agg(F.count("*").alias("n"))
    return keys.withColumn("form", lookalikes.canonical(F.col("key"))).groupBy("form").agg(F.count("*").alias("spellings"), F.sum("n").alias("n_rows"))


QUERIES |= {"p3_found": p3_found, "p3_canonical_keys": p3_canonical_keys}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.finest_needed(table(spark, d, "chunks"), "chunk_id", "content")


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All chunks in pieces, and whether each piece keeps the limit."""
    return splitting.split(table(spark, d, "chunks"), "chunk_id", "content", ["parent_section"]).select("chunk_id", "parent_section", "piece_no", "piece_start", "boundary", "piece_tokens", F.md5("piece").alias("piece_md5"))


def p4_file(spark: SparkSession, d: str) -> DataFrame:
    """All documents written as one file, in pieces cut by byte ranges of it."""
    folder = f"{shared_folder(spark).removesuffix('/')}/p4-{uuid.uuid4().hex}"
    table(spark, d, "documents").where("text is not null").orderBy("doc_id").select("text").coalesce(1).write.text(folder)
    where, name = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
    names = [f.path for f in where.get_file_info(fs.FileSelector(name))]
    path = next((n for n in names if "/part-" in n), next(n for n in names if n.endswith("/_SUCCESS")))  # no row, no part
    scheme = folder[: folder.index(name)] if name in folder else ""
    pieces = splitting.split_file(spark, scheme + path).where("piece <> ''").select("piece_no", "piece_start", "boundary", splitting.tokens(F.col("piece")).alias("piece_tokens"), F.md5("piece").alias("piece_md5"))
    pieces = cut(pieces)
    where.delete_dir(name)
    return pieces


def p4_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Per chunk: its pieces without their overlaps put together again, and whether each keeps the limit and repeats the end of the one before."""
    p = splitting.split(table(spark, d, "chunks"), "chunk_id", "content", [])
    p = p.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "piece_start", "piece"))).alias("p"), F.max("piece_tokens").alias("most"))
    over = splitting.OVERLAP * splitting.CHARS
    joined = F.array_join(F.transform("p", lambda x, i: F.when(i == 0, x["piece"]).otherwise(F.substring(x["piece"], F.lit(over + 1), F.length(x["piece"])))), "")
    follows = F.forall(F.sequence(F.lit(1), F.size("p")), lambda i: (i == F.size("p")) | (F.substring(F.get("p", i)["piece"], 1, over) == F.substring(F.get("p", i - 1)["piece"], -over, over)))
    return p.select("chunk_id", F.md5(joined).alias("rejoined"), (F.col("most") <= splitting.LIMIT).alias("within_limit"), follows.alias("overlaps"))


_ABBREVIATED = "|".join(sorted(x.replace(".", r"\.") for x in splitting.ABBREVIATIONS))
_P4_SQL = rf"""with c as (select chunk_id, content, regexp_replace(regexp_replace(content, '(^|[\s(\[;,])((?i:{_ABBREVIATED}|\pL))\.([^\S\n]+)', '\1\2_\3', 'g'), '(^|[\s(\[;,])((?i:{_ABBREVIATED}|\pL))\.([^\S\n]+)', '\1\2_\3', 'g') as hidden
  from chunks where ceil(length(content) / 4) > 900),
s as (select chunk_id, list_max(list_transform(string_split_regex(content, '\n[^\S\n]*\n\s*'), lambda x: length(x))) as p,
  list_max(list_transform(string_split_regex(content, '\n+'), lambda x: length(x))) as l,
  list_max(list_transform(string_split_regex(regexp_replace(hidden, '([.!?።]["''”’»)\]]*)\s+', '\1' || chr(10), 'g'), '\n+'), lambda x: length(x))) as t,
  list_max(list_transform(string_split_regex(content, '\s+'), lambda x: length(x))) as w from c)
select chunk_id, case when p <= 3600 then 'paragraph' when l <= 3600 then 'line' when t <= 3600 then 'sentence' when w <= 3600 then 'word' else 'none' end as boundary from s"""
QUERIES |= {"p4_found": p4_found, "p4_pieces": p4_pieces, "p4_file": p4_file, "p4_rejoined": p4_rejoined}
SQL |= {"p4_found": _P4_SQL, "p4_rejoined": "select chunk_id, md5(content) as rejoined, true as within_limit, true as overlaps from chunks where content is not null"}


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    items = tokens.sized(table(spark, d, "documents"), "text", ["doc_id"])
    return packing.pack(items, "doc_id", "n_tokens", table(spark, d, "pack_specs")).withColumnRenamed("id", "doc_id")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Per specification: containers, texts, and how full the containers are."""
    boxes = p8_packed(spark, d).where("container >= 0").groupBy("spec_name", "capacity", "shard", "container").agg(F.sum("n_tokens").alias("fill"), F.count("*").alias("parts"))
    return boxes.groupBy("spec_name", "capacity").agg(F.count("*").alias("containers"), F.sum("parts").alias("parts"), F.sum("fill").alias("n_tokens"), F.max("fill").alias("fullest"), F.round(F.avg(F.col("fill") / F.col("capacity")), 4).alias("mean_fill"))


def p8_checked(spark: SparkSession, d: str) -> DataFrame:
    """Per specification: texts placed, texts not placed token by token exactly once, cut texts that would have fitted, overfull containers, and whether
    there are at most 3 % more containers than the tokens need."""
    items = cut(tokens.sized(table(spark, d, "documents"), "text", ["doc_id"]))
    parts = cut(packing.pack(items, "doc_id", "n_tokens", table(spark, d, "pack_specs")))
    w = Window.partitionBy("spec_name", "id").orderBy("start_token", "n_tokens")
    placed = parts.withColumn("due", F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = placed.groupBy("spec_name", "capacity", "id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("got"), F.bool_and(F.col("due") == F.col("start_token")).alias("joined")).join(items.withColumnRenamed("doc_id", "id"), "id")
    per = per.groupBy("spec_name").agg(F.count("*").alias("texts"), F.count_if(~F.col("joined") | (F.col("got") != F.col("n_tokens"))).alias("misplaced"), F.count_if((F.col("parts") > 1) & (F.col("n_tokens") <= F.col("capacity"))).alias("cut_needlessly"))
    boxes = parts.where("container >= 0").groupBy("spec_name", "capacity", "shard", "container").agg(F.sum("n_tokens").alias("fill"))
    boxes = boxes.groupBy("spec_name").agg(F.count_if(F.col("fill") > F.col("capacity")).alias("overfull"), (F.count("*") <= 1.03 * F.ceil(F.sum("fill") / F.first("capacity")) + 1).alias("near_least"))
    return per.join(boxes, "spec_name")


#: The domains of the publishers of this corpus: the tree that the mixing takes as its input.
PUBLISHERS = {
    "finance": "development_bank insurance_corp revenue_office audit_bureau",
    "utilities": "water_board power_utility telecom_fund",
    "transport": "roads_authority rail_enterprise port_services",
    "production": "grain_enterprise sugar_corp",
    "administration": "city_council court_registry land_bureau housing_agency health_office school_board statistics_office",
    "publishing": "national_gazette_feed tender_portal parliament_library museum_archive union_newsletter",
}


def _mixed(spark: SparkSession, d: str, **how) -> tuple[DataFrame, DataFrame]:
    docs = tokens.sized(table(spark, d, "documents"), "text", [F.col("doc_id").alias("id"), "source", F.col("lang").alias("language")])
    tree = spark.createDataFrame([(s, k) for k, names in PUBLISHERS.items() for s in names.split()], "source string, domain string")
    return mixing.mix(docs, table(spark, d, "mix_targets"), tree, **how)


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0].withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def p9_shares_exact(spark: SparkSession, d: str) -> DataFrame:
    """The largest mix in which every source that has documents can reach its target."""
    return _mixed(spark, d, exact=True)[1]


def p9_checked(spark: SparkSession, d: str) -> DataFrame:
    """Per source with a target: documents chosen more often than allowed, chosen documents of other sources, and whether the report adds up to the choice."""
    chosen, report = (cut(x) for x in _mixed(spark, d))
    per = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("sum"), F.max("repeats").alias("top"), F.count("*").alias("rows"), F.count_distinct("id").alias("ids"))
    j = report.join(per, "source", "left")
    sound = (F.coalesce("sum", F.lit(0)) == F.col("used")) & (F.coalesce("top", F.lit(0)) <= F.col("max_repeats")) & (F.coalesce("rows", F.lit(0)) == F.coalesce("ids", F.lit(0))) & (F.col("used") <= F.col("available") * F.col("max_repeats"))
    whole = F.abs(F.sum("share").over(Window.partitionBy()) - 1) < 1e-6
    # What a source lacks went to others only where it has no more to give.
    spent = (F.col("share") >= F.col("target_share") - 0.01) | (F.col("used") >= 0.98 * F.col("available") * F.col("max_repeats"))
    return j.select("source", sound.alias("sound"), whole.alias("adds_up"), spent.alias("spent"))


QUERIES |= {"p8_packed": p8_packed, "p8_fill": p8_fill, "p8_checked": p8_checked, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_shares_exact": p9_shares_exact, "p9_checked": p9_checked}
SQL |= {
    "p8_checked": "select spec_name, (select count(*) from documents) as texts, 0::bigint as misplaced, 0::bigint as cut_needlessly, 0::bigint as overfull, true as near_least from pack_specs",
    "p9_checked": "select source, true as sound, true as adds_up, true as spent from mix_targets",
}


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    pairs, members = nearduplicates.similar_texts(table(spark, d, "chunks").select("chunk_id", "content"), "chunk_id", "content", 0.8)
    text = nearduplicates.expand(pairs, members).select(F.col("id_a").cast("string").alias("a"), F.col("id_b").cast("string").alias("b"))
    text = text.select(F.lit("chunk").alias("level"), F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    files = nearduplicates.similar_sets(table(spark, d, "facts"), "document", ["key", "period", "value_raw"], 0.7, 10)
    files = nearduplicates.expand(*files)
    return text.unionByName(files.select(F.lit("document").alias("level"), "id_a", "id_b"))


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    pairs, members = nearduplicates.similar_texts(table(spark, d, "chunks").select("chunk_id", "content"), "chunk_id", "content", 0.8)
    return nearduplicates.groups(cut(pairs), members).withColumnRenamed("id", "chunk_id")


QUERIES |= {"p7_found": p7_found, "p7_groups": p7_groups}


def _segments(spark: SparkSession, d: str) -> DataFrame:
    contents = languages.fit(table(spark, d, "documents"), "doc_id", "text", "lang")
    e = table(spark, d, "elements").where("kind = 'text'").select("element_id", "doc_id", F.col("bbox.page").alias("page"), "text")
    return languages.segments(e, ["element_id", "doc_id", "page"], "text", contents)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.unstated(table(spark, d, "page_profiles"), languages.pages(_segments(spark, d)))


def p2_segments(spark: SparkSession, d: str) -> DataFrame:
    return _segments(spark, d)


def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    return languages.pages(_segments(spark, d))


QUERIES |= {"p2_found": p2_found, "p2_segments": p2_segments, "p2_pages": p2_pages}


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return scannoise.noise(table(spark, d, "elements"), table(spark, d, "page_profiles"))


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scannoise.repaired(table(spark, d, "elements"), table(spark, d, "page_profiles"))


QUERIES |= {"p6_found": p6_found, "p6_repaired": p6_repaired}


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found(table(spark, d, "documents"), "doc_id", "text").distinct()


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(table(spark, d, "documents"), "doc_id", "text")


QUERIES |= {"p10_found": p10_found, "p10_redacted": p10_redacted}

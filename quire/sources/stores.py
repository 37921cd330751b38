"""Where rows come from and go to: files by digest, payloads of the vision rung, artifacts, facts by document, caches, run history."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import cut

PAYLOAD = "struct<elements: array<struct<kind: string, text: string, headers: array<string>, rows: array<array<string>>, caption: string>>>"


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """doc_id (16 hex digits of the file's SHA-256), source_name, length: files of a folder, read by the workers."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return f.select(F.substring(F.sha2("content", 256), 1, 16).alias("doc_id"), F.element_at(F.split("path", "/"), -1).alias("source_name"), "length")


def vision_elements(payloads: DataFrame) -> DataFrame:
    """Elements of JSON replies (region_id, payload), anchored to their region: blank text, unknown kinds, and tables that are ragged or without header are dropped."""
    text = F.regexp_extract("payload", r"(?s)(\{.*\})", 1)
    e = payloads.select("region_id", F.posexplode(F.from_json(text, PAYLOAD)["elements"]).alias("n", "e")).select("region_id", "n", "e.*")
    table = (F.col("kind") == "table") & (F.size("headers") > 0) & F.forall("rows", lambda r: F.size(r) == F.size("headers"))
    words = F.col("kind").isin("text", "figure") & ((F.col("kind") == "figure") | F.coalesce(F.trim("text") != "", F.lit(False)))
    return e.where(F.coalesce(table, F.lit(False)) | F.coalesce(words, F.lit(False)))


def vision_cost(tokens_in: Column, tokens_out: Column, price_in: float = 1.0, price_out: float = 5.0) -> Column:
    return (tokens_in * price_in + tokens_out * price_out) / 1e6


def load_env(path: str) -> int:
    """KEY=VALUE lines into the environment, without replacing what is set; returns how many were set."""
    n = 0
    if not os.path.exists(path):
        return n
    for line in open(path, encoding="utf-8"):
        key, eq, value = line.strip().partition("=")
        if eq and key and not key.startswith("#") and key.strip() not in os.environ:
            os.environ[key.strip()] = value.strip().strip("'\"")
            n += 1
    return n


def questions(groups: dict) -> list[dict]:
    """A nested set (part: kind: list of questions) as flat rows."""
    return [{"part": part, "kind": kind, **q} for part, kinds in groups.items() for kind, qs in (kinds or {}).items() for q in qs or []]


def csv_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with empty and None cells as null."""
    df = spark.read.schema(schema).option("header", True).option("nullValue", "None").csv(path)
    return df.replace("", None)


class Artifacts:
    """JSON artifacts by (kind, doc_id) in a folder: put replaces, get gives None where nothing is, ids are sorted."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def put(self, rows: DataFrame) -> None:
        """rows: kind, doc_id, body. Only the partitions they touch are written anew."""
        rows.repartition("kind", "doc_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "doc_id").parquet(self.folder)

    def all(self, kind: str) -> DataFrame:
        schema = T.StructType([T.StructField("body", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("doc_id", T.StringType())])
        try:
            return self.spark.read.schema(schema).parquet(self.folder).where(F.col("kind") == kind)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def get(self, kind: str, doc_id: str) -> dict | None:
        r = self.all(kind).where(F.col("doc_id") == doc_id).select("body").first()
        return json.loads(r["body"]) if r else None

    def ids(self, kind: str) -> list[str]:
        return [r["doc_id"] for r in self.all(kind).select("doc_id").distinct().orderBy("doc_id").collect()]


def _held(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What a folder holds, or no rows of the schema where nothing is yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def replace_documents(rows: DataFrame, folder: str, by: str = "document", same: tuple[str, ...] = ("key", "period", "value_raw"), order: str = "fact_id") -> DataFrame:
    """document, inserted, duplicates_skipped, replaced: documents in `rows` (facts; or ledger rows, by doc_id) are replaced whole, others stay; null documents are left out.

    Of rows that agree in the document and in `same` the one of the least `order` is kept; rows without these columns are all kept.
    """
    rows = cut(rows.where(F.col(by).isNotNull()))
    if {*same, order} <= set(rows.columns):
        key = [by, *same]
        rest = [c for c in rows.columns if c not in key]
        one = cut(rows.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("r"), F.count("*").alias("n")).select(*key, "r.*", "n"))
    else:
        one = rows.withColumn("n", F.lit(1))
    old = _held(rows.sparkSession, folder, rows.schema).groupBy(by).agg(F.count("*").alias("replaced"))
    counts = one.groupBy(by).agg(F.count("*").alias("inserted"), F.sum(F.col("n") - 1).alias("duplicates_skipped"))
    counts = cut(counts.join(old, by, "left").fillna(0, ["replaced"]))  # before the old rows go
    one.select(*rows.columns).repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)
    return counts


def append_run(rows: DataFrame, folder: str, run_id: str, order: list[str]) -> DataFrame:
    """Ledger rows of one run, numbered by `order` (run_seq from 1) and added to the history; a run that it holds already is left as it is. Returns what was added.

    Pages are numbered, then rows within pages, so a document of any size is no single task.
    """
    n = rows.groupBy("doc_id", "page").agg(F.count("*").alias("c"))
    n = n.withColumn("before", F.sum("c").over(Window.orderBy("doc_id", "page").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).drop("c")
    within = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(*order))
    numbered = rows.join(n, ["doc_id", "page"]).withColumn("run_seq", (F.col("before") + within).cast("int")).drop("before").withColumn("run_id", F.lit(run_id))
    numbered = cut(numbered)
    schema = T.StructType([*numbered.drop("run_id").schema.fields, T.StructField("run_id", T.StringType())])
    if _held(rows.sparkSession, folder, schema).where(F.col("run_id") == run_id).limit(1).count():
        return numbered.limit(0)
    # The run's own partition is written whole, so a writer that is run again leaves one copy.
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(folder)
    return numbered


def not_cached(texts: DataFrame, cache: DataFrame, model: str) -> DataFrame:
    """content_hash, text: what the embedding cache of the model lacks, each content once."""
    have = cache.where(F.col("model") == model).select("content_hash")
    return texts.groupBy("content_hash").agg(F.min("text").alias("text")).join(have, "content_hash", "left_anti")


def embedded(texts: DataFrame, folder: str, model: str, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """content_hash, embedding of all texts (content_hash, text; null hashes are left out): what the cache of the model lacks is embedded once and written through.

    `embed` is the seam to a model: from (content_hash, text) it makes (content_hash, embedding), each content once.
    """
    schema = T.StructType([T.StructField("content_hash", T.StringType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("model", T.StringType())])
    texts = texts.where("content_hash is not null")
    cache = _held(texts.sparkSession, folder, schema).where(F.col("model") == model)
    have = cut(cache.join(texts.select("content_hash").distinct(), "content_hash", "left_semi").select("content_hash", "embedding"))  # before the folder grows
    new = cut(embed(not_cached(texts, cache, model)).select("content_hash", F.col("embedding").cast("array<double>").alias("embedding")))
    new.withColumn("model", F.lit(model)).write.mode("append").partitionBy("model").parquet(folder)
    return have.unionByName(new)


def split_corpus(documents: DataFrame, holdout: list[str], dropped: list[str]) -> DataFrame:
    """source_name, part: tune is what is neither held out nor dropped; wanted names that don't exist are listed as missing."""
    named = F.col("source_name")
    part = F.when(named.isin(holdout), "holdout").when(named.isin(dropped), "dropped").otherwise("tune")
    have = documents.select("source_name").distinct()
    wanted = documents.sparkSession.createDataFrame([(x,) for x in dict.fromkeys([*holdout, *dropped])] or [(None,)], "source_name string").where("source_name is not null")
    return have.select("source_name", part.alias("part")).unionByName(wanted.join(have, "source_name", "left_anti").select("source_name", F.lit("missing").alias("part")))


def model_folder(model: Column) -> Column:
    """A model's name as the name of a folder."""
    return F.replace(model, F.lit("/"), F.lit("_"))


def located(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """source_name, path: for each wanted name its file of the least rank (files: source_name, rank, path; equals by path), null where there is none."""
    best = files.groupBy("source_name").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))
    return wanted.select("source_name").distinct().join(best, "source_name", "left")


def prompts_listed(prompts: DataFrame, documents: DataFrame) -> DataFrame:
    """group, prompts, missing: prompts (group, prompt, document) by group, and how many name a document that is not held; one without a document misses none."""
    have = documents.select(F.col("source_name").alias("document")).distinct().withColumn("held", F.lit(True))
    j = prompts.join(have, "document", "left")
    return j.groupBy("group").agg(F.count("*").alias("prompts"), F.count_if(F.col("document").isNotNull() & F.col("held").isNull()).alias("missing"))

"""Vectors: hash embeddings, filtered cosine search, and the upsert of points."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.session import parallelism

DIM = 256


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def hash_buckets(df: DataFrame, id_col: str, text_col: str, dim: int = DIM) -> DataFrame:
    """id, bucket, weight: character 3- and 5-grams of the collapsed lower-case text, hashed by md5 to `dim` (a power of two up to 65536) buckets, L2-normalised. Texts without a gram have no bucket.

    A text has two grams a character, most of them seen before, so they are looked up in Python and never become rows.
    """
    import numpy as np
    import pyarrow as pa

    def count(batches):
        known: dict[str, int] = {}
        for b in batches:
            rows, buckets, weights = [], [], []
            for i, texts in enumerate(b.column("texts").to_pylist()):
                n = np.zeros(dim, np.int64)
                for t in texts:
                    for k in (3, 5):
                        for s in range(0, len(t) - k + 1, 65_536):
                            grams = [t[j : j + k] for j in range(s, min(s + 65_536, len(t) - k + 1))]
                            for g in set(grams).difference(known):
                                known[g] = int.from_bytes(hashlib.md5(g.encode()).digest()[-2:], "big") % dim
                            n += np.bincount([known[g] for g in grams], minlength=dim)
                            if len(known) > 500_000:
                                known.clear()
                at = np.flatnonzero(n)
                rows.append(np.full(len(at), i))
                buckets.append(at)
                weights.append(n[at] / np.sqrt(float((n * n).sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(np.concatenate(rows), pa.int64())), pa.array(np.concatenate(buckets), pa.int32()), pa.array(np.concatenate(weights), pa.float64())], names=["id", "bucket", "weight"])

    src = df.select(F.col(id_col).alias("id"), X.collapsed(F.lower(F.col(text_col))).alias("text")).where("text is not null")
    src = src.groupBy("id").agg(F.collect_list("text").alias("texts")).repartition(parallelism(df.sparkSession))
    return src.mapInArrow(count, f"id {dict(df.dtypes)[id_col]}, bucket int, weight double").withColumnRenamed("id", id_col)


def nearest(points: DataFrame, query: list[float], k: int = 6, where: Column | None = None) -> DataFrame:
    """The k points with the highest cosine, exactly, after the filter; equals by id. The plan is TakeOrderedAndProject, so each task keeps k rows."""
    p = points if where is None else points.where(where)
    q = F.array(*[F.lit(float(x)) for x in query])
    return p.withColumn("score", F.round(cosine(F.col("embedding"), q), 4)).orderBy(F.desc("score"), "vec_id").limit(k)


def nearest_all(points: DataFrame, queries: DataFrame, k: int = 6, block: int = 2000, pack: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score for a set of queries against all points.

    Queries are packed into blocks of about `block`, points into packs of at most `pack`; each block meets each pack once, and
    only k rows per query and pack go on to be ranked.
    """
    import numpy as np
    import pandas as pd

    # Points without a vector are near to nothing.
    points, queries = (x.where("vec_id is not null and size(embedding) > 0 and not exists(embedding, x -> x is null)") for x in (points, queries))
    blocks = max(1, -(-queries.count() // block))
    packed = queries.select(F.col("vec_id").alias("query_id"), "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).groupBy("block").agg(F.collect_list(F.struct("query_id", "embedding")).alias("qs"))
    pts = points.select("vec_id", "embedding", F.floor(F.monotonically_increasing_id() / pack).alias("part")).withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    pts = pts.groupBy("block", "part").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("ps"))

    def score(batches):
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                q, p = np.array([x["embedding"] for x in r.qs], dtype=float), np.array([x["embedding"] for x in r.ps], dtype=float)
                ids = np.array([x["vec_id"] for x in r.ps])
                s = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (p / np.linalg.norm(p, axis=1, keepdims=True)).T
                s = np.round(s, 4)
                for i, x in enumerate(r.qs):
                    best = np.lexsort((ids, -s[i]))[: k + 1]
                    out += [(x["query_id"], int(ids[j]), float(s[i, j])) for j in best if ids[j] != x["query_id"]]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    # A block goes to each of a fixed number of slices of the points, so that few blocks are not few tasks.
    slices = parallelism(points.sparkSession)
    pts = pts.withColumn("slice", F.pmod("part", F.lit(slices)))
    packed = packed.withColumn("slice", F.explode(F.expr(f"sequence(0L, {slices - 1}L)")))
    near = pts.join(packed, ["block", "slice"]).select("qs", "ps").mapInPandas(score, "query_id bigint, vec_id bigint, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def upserted(points: DataFrame) -> DataFrame:
    """One point per (doc_id, content_hash): the last stored."""
    cols = [c for c in points.columns if c not in ("doc_id", "content_hash")]
    return points.groupBy("doc_id", "content_hash").agg(F.max_by(F.struct(*cols), F.struct("created_at", "chunk_id")).alias("p")).select("doc_id", "content_hash", *[F.col(f"p.{c}").alias(c) for c in cols])


class OtherModel(ValueError):
    """A store holds vectors of another model than the one offered."""


def guarded(held: dict | None, model: str, dim: int) -> dict:
    """What a store is to remember of its model; raises OtherModel where it remembers another."""
    offered = {"model": model, "dim": dim}
    if held is not None and held != offered:
        raise OtherModel(f"the store holds {held}, not {offered}")
    return offered


def points(chunks: DataFrame) -> DataFrame:
    """point_id, doc_id, content_hash, ...: the last stored chunk of each (doc_id, content_hash), under a name-based UUID of the two, with the titles of its section path (ancestors)."""
    p = upserted(chunks)
    # A version-5 UUID: SHA-1 over the name space and the name, with the version and variant bits set.
    name = F.concat(F.unhex(F.lit("6ba7b8129dad11d180b400c04fd430c8")), F.encode(F.concat("doc_id", "content_hash"), "UTF-8"))
    h = F.sha1(name)
    part = lambda a, n: F.substring(h, a, n)
    variant = F.lower(F.hex(F.conv(part(17, 2), 16, 10).cast("int").bitwiseAND(F.lit(0x3F)).bitwiseOR(F.lit(0x80))))
    uuid5 = F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(19, 2)), part(21, 12))
    ancestors = F.transform(F.split(F.coalesce("parent_section", F.lit("")), ">"), lambda x: F.trim(x))
    return p.select(uuid5.alias("point_id"), *p.columns, ancestors.alias("ancestors"))


def scope(section: str | None = None, document: str | None = None, doc_id: str | None = None, doc_ids: list[str] | None = None) -> Column:
    """The filter of a search: a title among the point's ancestors, a source name, one document, or else one of several; all that are given hold."""
    c = F.lit(True)
    if section:
        c &= F.array_contains("ancestors", section)
    if document:
        c &= F.col("document") == document
    if doc_id:
        c &= F.col("doc_id") == doc_id
    elif doc_ids:
        c &= F.col("doc_id").isin(*doc_ids)
    return c


def search_texts(pts: DataFrame, query: str, k: int = 6, where: Column | None = None, dim: int = DIM) -> DataFrame:
    """The k points (of points(), with content) whose hash embeddings are nearest to the query's, exactly, after the filter, with score; equals by id. Points that share no gram with it are not listed."""
    p = pts if where is None else pts.where(where)
    q = {r["bucket"]: r["weight"] for r in hash_buckets(pts.sparkSession.createDataFrame([(0, query)], "id int, t string"), "id", "t", dim).collect()}
    if not q:
        return p.limit(0).withColumn("score", F.lit(0.0))
    weights = F.create_map(*[F.lit(x) for kv in sorted(q.items()) for x in kv])  # at most `dim` entries
    score = hash_buckets(p, "point_id", "content", dim).withColumn("w", F.col("weight") * weights[F.col("bucket")]).where("w is not null").groupBy("point_id").agg(F.round(F.sum("w"), 4).alias("score"))
    best = score.orderBy(F.desc("score"), "point_id").limit(k)
    return p.join(F.broadcast(best), "point_id").orderBy(F.desc("score"), "point_id")  # k rows

"""The ledger as a stream: files arrive, the latest row per page is kept up to date in a folder, replays have no effect."""

from __future__ import annotations

import json
import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators import ledgers
from quire.session import cut, shared_folder


#: Runs of one level that are merged into one of the next.
FAN = 8


def windowed(events: DataFrame, delay: str = "2 days", length: str = "1 day") -> DataFrame:
    """Counts and sums per event time window and type, with a watermark for late rows."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def latest_into(stream: DataFrame, target: str, checkpoint: str, fan: int = FAN):
    """Keep `target` as the latest row per (doc_id, page), in runs: each batch writes the latest rows of its own as one run, and `fan` runs of
    a level become one run of the next. So a row is written once per level, whatever number of batches touch its document.

    Runs are written beside each other and named with their levels in a manifest by batch, so a batch that is run again writes the
    same run and readers never see half of one.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        rows, level, runs = batch, 0, _runs(spark, target, batch_id)
        while len(same := [n for n, k in runs if k == level]) >= max(fan - 1, 1):
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(*[f"{target}/v{n}" for n in same]))
            runs, level = [r for r in runs if r[1] != level], level + 1
        ledgers.latest_per_page(rows).write.mode("overwrite").parquet(f"{target}/v{batch_id}")
        _write(spark, f"{target}/manifest-{batch_id:09d}.json", json.dumps([*runs, [batch_id, level]]))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _runs(spark: SparkSession, target: str, before: int | None = None) -> list[list[int]]:
    """The batch and level of each run that the last manifest names (before a batch, if one is given)."""
    fs, p = _fs(spark, target)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("manifest-"))
    names = [n for n in names if before is None or int(n[9:18]) < before]
    if not names:
        return []
    runs = json.loads(spark.read.text(f"{target}/{names[-1]}", wholetext=True).first()[0])
    if isinstance(runs, dict):
        raise ValueError(f"{target} is kept in buckets, not in runs: run its stream again into another folder")
    return runs


def read_latest(spark: SparkSession, target: str, empty: DataFrame | None = None) -> DataFrame:
    """The latest rows of the runs that the last manifest names; `empty` where no batch has brought a row yet."""
    runs = _runs(spark, target)
    if not runs and empty is not None:
        return empty.limit(0)
    rows = spark.read.parquet(*[f"{target}/v{n}" for n, _ in runs])
    return ledgers.latest_per_page(rows) if len(runs) > 1 else rows


def latest_of_files(spark: SparkSession, path: str) -> DataFrame:
    """Run the stream over what a folder (or file) holds now, and read the result."""
    base = f"{shared_folder(spark)}/ledger-{os.urandom(6).hex()}"
    src = spark.read.parquet(path)
    where = path if os.path.isdir(urlparse(path).path) else os.path.join(os.path.dirname(path), os.path.basename(path))
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 4).parquet(where if where.endswith("/") or os.path.isdir(urlparse(where).path) else where.replace(".parquet", ".parque[t]"))
    latest_into(stream, f"{base}/latest", f"{base}/checkpoint").awaitTermination()
    out = cut(read_latest(spark, f"{base}/latest", src))
    fs, p = _fs(spark, base)
    fs.delete(p, True)
    return out


def latest_by_window(rows: DataFrame) -> DataFrame:
    """The same by one window in batch, for checks."""
    w = Window.partitionBy("doc_id", "page").orderBy(F.desc("arrived_at"), F.desc("entry_id"))
    return rows.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")

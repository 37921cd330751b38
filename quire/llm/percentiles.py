"""Problem 5: percentiles of very large columns from sketches that can be combined.

A sketch is a randomised compactor hierarchy: full levels are sorted and every other value moves up one level with twice the
weight. Spark's KLL aggregates are this structure inside the JVM (partial sketches per task, merged level by level), so one
sketch per group and day is a column of a table, and days, runs or partitions are combined by merging columns.

With `k` items at the lowest capacity the error of a rank is at most RANK_ERROR(k) * n, with probability 99 %.
exact_percentile() turns the guarantee into the exact value: the sketch brackets the percentile, one pass counts what lies below
and inside the bracket, and only values inside are put in order; a bracket that misses (the sketch's 1 %) widens to the whole range.

Values that are null, NaN or negative are no measurements and are left out everywhere. A group without measurements has no
percentile and gives no row. Ties and repeated rows count as they stand. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut, hinted

K = 2048
#: Values that a bracket may hold before it is narrowed by another sketch.
BRACKET_ROWS = 2_000_000


def rank_error(k: int = K) -> float:
    """Normalised two-sided rank error of a sketch at 99 % confidence (the published fit for this compactor scheme)."""
    return 2.446 / k**0.9433


def measured(c: Column) -> Column:
    """The value, or null where it can't be a measurement."""
    return F.when(~F.isnan(c) & (c >= 0), c)


def sketches(df: DataFrame, keys: list, metrics: list[str], k: int = K) -> DataFrame:
    """One row per combination of keys: for each metric a sketch (<metric>__kll) and the number of its values (<metric>__n)."""
    aggs = [a for m in metrics for a in (F.kll_sketch_agg_double(measured(F.col(m)), F.lit(k)).alias(f"{m}__kll"), F.count(measured(F.col(m))).alias(f"{m}__n"))]
    return df.groupBy(*keys).agg(*aggs)


def merged(parts: DataFrame, keys: list, metrics: list[str]) -> DataFrame:
    """Sketches of parts (days, runs) combined to the coarser keys."""
    return parts.groupBy(*keys).agg(*[a for m in metrics for a in (F.kll_merge_agg_double(f"{m}__kll").alias(f"{m}__kll"), F.sum(f"{m}__n").alias(f"{m}__n"))])


def long(sk: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """keys, metric, kll, n: one row per metric that has values."""
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}__kll").alias("kll"), F.col(f"{m}__n").alias("n")) for m in metrics]))
    return sk.select(*keys, rows.alias("r")).select(*keys, "r.*").where("n > 0")


def at_ranks(ranks: list[float]) -> Column:
    """The sketch's values at the ranks, as an array."""
    return F.expr(f"kll_sketch_get_quantile_double(kll, array({', '.join(f'{min(1.0, max(0.0, r))}D' for r in ranks)}))")


def quantiles(sk: DataFrame, keys: list[str], metrics: list[str], qs: list[float]) -> DataFrame:
    """keys, metric, n, q, value: percentiles of sketches() or merged(), each within rank_error() of its rank."""
    rows = F.arrays_zip(F.array(*map(F.lit, qs)).alias("q"), at_ranks(qs).alias("value"))
    return long(sk, keys, metrics).select(*keys, "metric", "n", F.explode(rows).alias("r")).select(*keys, "metric", "n", "r.*")


def values(df: DataFrame, keep: list[str], metrics: list[str]) -> DataFrame:
    """keep, metric, value: the measurements one below the other."""
    return df.select(*keep, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), measured(F.col(m)).alias("value")) for m in metrics])).alias("v")).select(*keep, "v.*").where("value is not null")


def _beside(v: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Each measurement with its group's row of `small` (whose key and metric are __key and __metric)."""
    s = hinted(small)
    return v.join(s, v[key].eqNullSafe(s["__key"]) & (v["metric"] == s["__metric"]))


def exact_percentile(df: DataFrame, key: str, metrics: list[str], percent: int, k: int = K, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """__key, __metric, exact: the value at place ceil(percent / 100 * n) in ascending order, for each key (null is a key) and metric."""
    away, q, group = 2 * rank_error(k), percent / 100, ["__key", "__metric", "place"]
    v = values(df, [key], metrics)
    ends = at_ranks([q - away, q + away])
    bounds = long(sketches(df, [key], metrics, k), [key], metrics).select(F.col(key).alias("__key"), F.col("metric").alias("__metric"), F.expr(f"(n * {percent}L + 99) div 100").alias("place"), ends.alias("e"))
    bounds = cut(bounds.select(*group, F.col("e")[0].alias("lo"), F.col("e")[1].alias("hi")))
    while True:
        # Rows up to the bracket's end; those below it only add up, those inside are counted by value before they are shuffled.
        upto = _beside(v, bounds, key).where("value <= hi").select(*group, "lo", "hi", F.expr("case when value >= lo then value end").alias("value"))
        counts = cut(upto.groupBy(*group, "lo", "hi", "value").agg(F.count("*").alias("c")))
        state = counts.groupBy(*group, "lo", "hi").agg(
            F.sum(F.expr("case when value is null then c else 0 end")).alias("below"), F.sum(F.expr("case when value is null then 0 else c end")).alias("within"), F.count("value").alias("different"))
        state = cut(state.withColumn("held", F.expr("below < place and below + within >= place")))
        missed, wide = state.agg(F.coalesce(F.count_if(~F.col("held")), F.lit(0)), F.coalesce(F.count_if(F.col("different") > bracket_rows), F.lit(0))).first()
        if missed:
            bounds = cut(state.select(*group, F.expr("case when held then lo else 0D end").alias("lo"), F.expr("case when held then hi else double('inf') end").alias("hi")))
        elif wide:
            steps = 1000
            sk = _beside(v, state, key).where("value between lo and hi").groupBy(*group, "lo", "hi", "below", "within", "different").agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("kll"))
            sk = sk.withColumns({"grid": at_ranks([i / steps for i in range(steps + 1)]), "f": F.expr("(place - below) / within")})
            slot = lambda x: F.greatest(F.lit(0), F.least(F.lit(steps), x.cast("int")))
            narrow = F.col("different") > bracket_rows
            bounds = cut(sk.select(*group, F.when(narrow, F.get("grid", slot(F.floor((F.col("f") - away) * steps)))).otherwise(F.col("lo")).alias("lo"), F.when(narrow, F.get("grid", slot(F.ceil((F.col("f") + away) * steps)))).otherwise(F.col("hi")).alias("hi")))
        else:
            order = Window.partitionBy("__key", "__metric").orderBy(F.col("value").asc_nulls_first())
            ranked = counts.select("__key", "__metric", "place", "value", F.sum("c").over(order).alias("upto"))
            return ranked.where("upto >= place and value is not null").groupBy("__key", "__metric").agg(F.min("value").alias("exact"))


def above_percentile(df: DataFrame, key: str, id_col: str, metrics: list[str], percent: int, k: int = K) -> DataFrame:
    """metric and id of the rows whose value exceeds the exact percentile of their key."""
    limits = cut(exact_percentile(df, key, metrics, percent, k))
    return _beside(values(df, [key, id_col], metrics), limits, key).where("value > exact").select("metric", id_col).distinct()

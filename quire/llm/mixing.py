"""Problem 9: a mix of sources at target weights.

The targets are spread over a tree domain - language - source: a source's weight goes to its leaves (one for each language it
has) by their tokens, and inner nodes weigh the sum of their leaves. The budget goes down the tree; a child that can't use its part (its
tokens times the most repeats) leaves the rest to its siblings by weight, and only what a whole branch can't use goes to the
branch's own siblings. A leaf's budget is filled from seeded epochs: whole epochs take every document once, the last one takes
the prefix, in that epoch's own order, that comes nearest to the budget.

The order of an epoch is a hash of (seed, epoch, id). Prefix sums go by ranges of the hash: sums per range are added up
first, and only the range in which the budget ends is put in order, so a leaf of any size is never sorted in one task.

Sources without a target, and null sources, take no part. Texts without tokens can be chosen but add nothing. Targets need not
sum to 1; a null share is none, a null limit of repeats is 1. An empty corpus gives an empty mix. A null or unreadable language counts as "und".
The tree is a table of sources and their domains; a source that is not in it is of the domain "other".
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut, hinted

SLOTS_BITS = 12
LEVELS = ["domain", "language", "source"]


def budgets(leaves: pd.DataFrame, total: float, levels: list[str]) -> np.ndarray:
    """Budget of each leaf (columns levels, weight, capacity): water-filling from the root, so shortages stay among siblings first."""
    out = np.zeros(len(leaves))

    def share(idx: np.ndarray, amount: float, depth: int) -> None:
        if depth == len(levels):
            out[idx] += amount * leaves["capacity"].to_numpy()[idx] / max(leaves["capacity"].to_numpy()[idx].sum(), 1e-9)
            return
        groups = [g.to_numpy() for _, g in pd.Series(idx).groupby(leaves[levels[depth]].to_numpy()[idx])]
        weight = np.array([leaves["weight"].to_numpy()[g].sum() for g in groups])
        room = np.array([leaves["capacity"].to_numpy()[g].sum() for g in groups])
        given, open_ = np.zeros(len(groups)), weight > 0
        left = min(amount, room[open_].sum())
        while left > 1e-9 and open_.any():
            part = left * np.where(open_, weight, 0) / weight[open_].sum()
            full = open_ & (given + part >= room - 1e-9)
            if not full.any():
                given += part
                break
            given[full] = room[full]
            open_ &= ~full
            left = min(amount, room[weight > 0].sum()) - given[~open_].sum() - given[open_].sum()
        for g, x in zip(groups, given):
            if x > 0:
                share(g, float(x), depth + 1)

    if len(leaves):
        share(np.arange(len(leaves)), total, 0)
    return out


def mix(docs: DataFrame, targets: DataFrame, tree: DataFrame | None = None, seed: int = 1, total: int | None = None, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """Chosen (id, source, domain, language, n_tokens, repeats) and the report (source, target_share, available, used, most_repeats, share, reachable).

    docs has id, source, language, n_tokens; tree has source, domain. total is the size of the mix in tokens: by default all tokens of
    the corpus; with `exact` the largest size at which every source that has any tokens can reach its target. A source is reachable if
    its tokens, at most repeated, make up its target in a mix of that size; one without tokens never is, and its share goes to the others. Whole
    documents are chosen, so a leaf's use differs from its budget by up to half a document.
    """
    spark = docs.sparkSession
    code = F.regexp_extract(F.lower("language"), "^([a-z]{2})([-_ ].*)?$", 1)
    if tree is None:
        docs = docs.withColumn("domain", F.lit("other"))
    else:
        known = tree.where("source is not null").groupBy("source").agg(F.min("domain").alias("domain"))
        docs = docs.drop("domain").join(hinted(cut(known)), "source", "left")
    docs = docs.select("id", "source", F.coalesce("domain", F.lit("other")).alias("domain"), F.when(code != "", code).otherwise("und").alias("language"), "n_tokens")
    targets = targets.withColumns({"target_share": F.coalesce("target_share", F.lit(0.0)), "max_repeats": F.coalesce("max_repeats", F.lit(1))})
    docs = cut(docs.join(hinted(targets.select("source", "target_share", "max_repeats")), "source"))
    # One row per leaf: at most the listed sources times two-letter codes.
    leaves = docs.groupBy(*LEVELS, "target_share", "max_repeats").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0").toPandas().sort_values(LEVELS, ignore_index=True)
    if leaves.empty:
        leaves = leaves.assign(weight=[], capacity=[])
    else:
        leaves["weight"] = leaves["target_share"] * leaves["tokens"] / leaves.groupby("source")["tokens"].transform("sum")
        leaves["capacity"] = (leaves["tokens"] * leaves["max_repeats"]).astype(float)
    size = float(total if total is not None else leaves["tokens"].sum())
    if exact and len(leaves):
        by = leaves.groupby("source").agg(c=("capacity", "sum"), w=("weight", "sum"))
        size = float((by["c"] / (by["w"] / by["w"].sum()))[by["w"] > 0].min())
    leaves["budget"] = budgets(leaves, size, LEVELS)
    leaves["epochs"] = np.floor(leaves["budget"] / leaves["tokens"] + 1e-9).astype("int64") if len(leaves) else []
    leaves["rest"] = (leaves["budget"] - leaves["epochs"] * leaves["tokens"]).clip(lower=0.0) if len(leaves) else []
    plan = spark.createDataFrame([(*[getattr(r, c) for c in LEVELS], int(r.epochs), float(r.rest)) for r in leaves.itertuples()], "domain string, language string, source string, epochs bigint, rest double")
    rows = docs.join(hinted(plan), LEVELS).withColumn("h", F.xxhash64(F.lit(seed), F.col("epochs"), F.col("id")))
    rows = rows.withColumn("slot", F.shiftrightunsigned("h", 64 - SLOTS_BITS))
    slots = rows.groupBy(*LEVELS, "slot").agg(F.sum("n_tokens").alias("in_slot"))
    slots = slots.withColumn("before", F.sum("in_slot").over(Window.partitionBy(*LEVELS).orderBy("slot")) - F.col("in_slot"))
    rows = rows.join(hinted(cut(slots), 200_000), [*LEVELS, "slot"])
    last = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("in_slot") >= F.col("rest"))
    cum = F.sum("n_tokens").over(Window.partitionBy(*LEVELS, "slot").orderBy("h", "id")) + F.col("before")
    keep = ["id", *LEVELS, "n_tokens"]
    inside = rows.where(last).select(*keep, "epochs", F.when(cum - F.col("n_tokens") / 2 <= F.col("rest"), 1).otherwise(0).alias("more"))
    others = rows.where(~last).select(*keep, "epochs", F.when(F.col("before") < F.col("rest"), 1).otherwise(0).alias("more"))
    chosen = others.unionByName(inside).select(*keep, (F.col("epochs") + F.col("more")).alias("repeats")).where("repeats > 0")
    used = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("used"), F.max("repeats").alias("most_repeats"))
    have = docs.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    report = targets.select("source", "target_share", "max_repeats").join(have, "source", "left").join(used, "source", "left").fillna(0, ["available", "used", "most_repeats"])
    report = report.withColumn("share", F.coalesce(F.try_divide(F.col("used"), F.sum("used").over(Window.partitionBy())), F.lit(0.0)))
    return chosen, report.withColumn("reachable", F.col("available") * F.col("max_repeats") >= F.col("target_share") * size - 1e-6)

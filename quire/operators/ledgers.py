"""The processing ledger: latest rows and runs, repair, rollups, budgets, and the incremental view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUDGET_USD = 0.50


def latest_per_page(ledger: DataFrame) -> DataFrame:
    """The last row of each (doc_id, page): by arrival, then entry_id. A group is aggregated, not sorted, so a hot document costs no more."""
    cols = [c for c in ledger.columns if c not in ("doc_id", "page")]
    last = F.max_by(F.struct(*cols), F.struct("arrived_at", "entry_id")).alias("r")
    return ledger.groupBy("doc_id", "page").agg(last).select("doc_id", "page", *[F.col(f"r.{c}").alias(c) for c in cols])


def latest_run(ledger: DataFrame) -> DataFrame:
    """The rows of each document's last run (the run of its last row)."""
    last = ledger.groupBy("doc_id").agg(F.max_by("run_id", F.struct("arrived_at", "entry_id")).alias("run_id"))
    return ledger.join(last, ["doc_id", "run_id"], "left_semi")


def without_replays(ledger: DataFrame) -> DataFrame:
    """One row per natural key (run_id, run_seq): the first that arrived."""
    cols = [c for c in ledger.columns if c not in ("run_id", "run_seq")]
    return ledger.groupBy("run_id", "run_seq").agg(F.min_by(F.struct(*cols), F.struct("arrived_at", "entry_id")).alias("r")).select("run_id", "run_seq", *[F.col(f"r.{c}").alias(c) for c in cols])


def rollup(rows: DataFrame) -> DataFrame:
    """doc_id, pages, mean coverage, spend, escalated pages, vision pages, whether the budget was hit."""
    ok = ~F.isnan("coverage_residual") & (F.col("coverage_residual") >= 0)
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("pages"), F.try_divide(F.round(F.sum(F.when(ok, 1 - F.col("coverage_residual"))), 4), F.count_if(ok)).alias("coverage"), F.round(F.sum("cost_estimate_usd"), 6).alias("spend"),
        F.count_if(F.col("strategy_used").contains("→")).alias("escalated"), F.count_if(F.col("strategy_used").contains("C")).alias("vision_pages"), F.coalesce(F.bool_or(F.col("strategy_used").contains("!budget")), F.lit(False)).alias("budget_hit"))


def within_budget(ledger: DataFrame, cap: float = BUDGET_USD) -> DataFrame:
    """Per run of a document, the rows that start before the run has spent the cap; a start is allowed while anything is left."""
    w = Window.partitionBy("doc_id", "run_id").orderBy("run_seq", "entry_id").rowsBetween(Window.unboundedPreceding, -1)
    return ledger.withColumn("spent_before", F.round(F.coalesce(F.sum("cost_estimate_usd").over(w), F.lit(0.0)), 6)).where(F.col("spent_before") < cap)


def duplicates(ledger: DataFrame) -> DataFrame:
    """doc_id, page, kept entry, removed: what a repair to the newest row per page would remove."""
    return ledger.groupBy("doc_id", "page").agg(F.max_by("entry_id", F.struct("arrived_at", "entry_id")).alias("kept"), (F.count("*") - 1).alias("removed")).where("removed > 0")


def trace(profiles: DataFrame, ledger: DataFrame) -> DataFrame:
    """Profile pages with the last ledger row of each."""
    last = latest_per_page(ledger).select("doc_id", "page", "strategy_used", "cost_estimate_usd")
    return profiles.select("profile_id", "doc_id", "page", "origin_type").join(last, ["doc_id", "page"], "left")

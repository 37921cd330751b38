"""Files of rules and of truth: thresholds by section and name, and hand-read cells of printed tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What rules may set: the limits that operators take as arguments, with the range a value must be in.
KNOWN = {
    "triage.density": (0, 1e3), "triage.image_ratio": (0, 1), "triage.ruled_lines": (0, 1e6), "triage.figure_ratio": (0, 1), "triage.majority": (0, 1),
    "coverage.tau": (0, 1), "coverage.claim_ratio": (0, 1), "coverage.min_region_pt2": (0, 1e9), "routing.table_overlap_ratio": (0, 1), "routing.top": (1, 1e3),
    "budget.per_document": (0, 1e9), "writeoffs.repeat_ratio": (0, 1), "writeoffs.min_pages": (1, 1e6), "chunking.max_tokens": (1, 1e9), "chunking.caption_proximity": (0, 1e4), "embeddings.dim": (1, 1e6),
}


class BadRules(ValueError):
    """A rules file says something that is not known or not possible."""


def read_rules(path: str) -> dict[str, float]:
    """"section.name" to value, of a file of indented `name: value` lines; comments and blank lines count for nothing.

    Unknown names, values that are no numbers and values out of range raise BadRules, so a misspelt rule is never passed over.
    """
    out: dict[str, float] = {}
    section = ""
    with open(path, encoding="utf-8") as f:
        for no, line in enumerate(f, 1):
            body = re.sub(r"(^|\s)#.*$", "", line).rstrip()
            if not body.strip():
                continue
            m = re.fullmatch(r"(\s*)([A-Za-z_]\w*):\s*(.*)", body)
            if not m:
                raise BadRules(f"line {no} is no `name: value`")
            indent, name, value = m.groups()
            if not value:
                section = name
                continue
            full = f"{section}.{name}" if indent else name
            if full not in KNOWN:
                raise BadRules(f"line {no}: unknown rule {full}")
            try:
                number = float(value)
            except ValueError:
                raise BadRules(f"line {no}: {full} is no number") from None
            low, high = KNOWN[full]
            if not low <= number <= high:
                raise BadRules(f"line {no}: {full} must be between {low:g} and {high:g}")
            out[full] = number
    return out


def truth_cells(spark: SparkSession, path: str) -> DataFrame:
    """document, page, label, position, value of a folder of JSON files {document, page, columns, rows: {label: [values]}}; a file that is no such thing gives nothing."""
    t = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(F.from_json("value", "document string, page int, rows map<string, array<double>>").alias("t"))
    rows = t.select("t.document", "t.page", F.explode("t.rows").alias("label", "values"))
    return rows.select("document", "page", "label", F.posexplode("values").alias("position", "value")).where("document is not null")


def measured_cells(truth: DataFrame, facts: DataFrame) -> DataFrame:
    """document, page, cells, correct, missing_rows: each label's values, by position, against those of its page's facts under that key or period, in order of entry.

    A label that is no key or period as it stands is looked up by its letters and digits, if only one key or period has them.
    """
    f = facts.where("value_num is not null").select("document", "page", "fact_id", "value_num", F.explode(F.array_distinct(F.array_compact(F.array("key", "period")))).alias("literal")).where("literal <> ''")
    plain = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    have = f.groupBy("document", "page", "literal").agg(F.transform(F.array_sort(F.collect_list(F.struct("fact_id", "value_num"))), lambda x: x["value_num"]).alias("actual")).withColumn("form", plain("literal"))
    labels = truth.groupBy("document", "page", "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "value"))), lambda x: x["value"]).alias("wanted")).withColumn("form", plain("label"))
    at = ["document", "page"]
    exact = labels.join(have.select(*at, F.col("literal").alias("label"), "actual"), [*at, "label"], "left")
    loose = have.groupBy(*at, "form").agg(F.count("*").alias("n"), F.first("actual").alias("other")).where("n = 1").drop("n")
    m = exact.join(loose, [*at, "form"], "left").withColumn("actual", F.coalesce("actual", "other"))
    hits = F.size(F.filter(F.sequence(F.lit(0), F.size("wanted") - 1), lambda i: F.coalesce(F.abs(F.get("actual", i) - F.get("wanted", i)) < 1e-9, F.lit(False))))
    return m.groupBy(*at).agg(F.sum(F.size("wanted")).alias("cells"), F.sum(hits).alias("correct"), F.count_if(F.col("actual").isNull()).alias("missing_rows"))

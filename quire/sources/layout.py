"""Rows of a layout model's result as elements: boxes the right way up, furniture by label, grids as repaired tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators import tables

# Labels of what is no part of the text.
FURNITURE = ("page_header", "page_footer", "page_number")


def adapted(items: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, idx, kind, source_rung, bbox, text, table_data, caption, label of items (doc_id, n, kind: text, table or picture, label, text, grid, caption, left, top, right, bottom, origin, page).

    pages has doc_id, page, height. A box that counts from the bottom is turned by its page's height. Left out are items without a
    box of some width and height, texts that are blank, and tables without a grid or with rows of other lengths than the first, which is the header.
    Empty captions are none. Elements stand by page, top and left edge, equals by their number.
    """
    i = items.join(pages.select("doc_id", "page", "height"), ["doc_id", "page"])
    up = F.upper(F.coalesce("origin", F.lit(""))) == "BOTTOMLEFT"
    i = i.withColumns({"y0": F.when(up, F.col("height") - F.col("top")).otherwise(F.col("top")), "y1": F.when(up, F.col("height") - F.col("bottom")).otherwise(F.col("bottom"))})
    words = (F.col("kind") == "text") & (F.trim("text") != "")
    width = F.size(F.get("grid", F.lit(0)))
    grid = (F.col("kind") == "table") & (width > 0) & F.forall("grid", lambda r: F.size(r) == width)
    i = i.where((F.col("right") > F.col("left")) & (F.col("y1") > F.col("y0"))).where(F.coalesce(words, F.lit(False)) | F.coalesce(grid, F.lit(False)) | (F.col("kind") == "picture"))
    filled = lambda r: F.transform(r, lambda c: F.coalesce(c, F.lit("")))
    raw = F.struct(filled(F.get("grid", F.lit(0))).alias("headers"), F.transform(F.slice("grid", 2, F.greatest(F.size("grid") - 1, F.lit(0))), filled).alias("rows"), F.lit(None).cast("array<string>").alias("row_periods"), F.lit(None).cast("string").alias("context"))
    kind = F.when(F.col("kind") == "picture", "figure").when((F.col("kind") == "text") & F.coalesce(F.col("label").isin(*FURNITURE), F.lit(False)), "furniture").otherwise(F.col("kind"))
    place = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("y0", "left", "n"))
    # Places within the page and the pages before add up, so no document is put in order in one task.
    i = i.select("doc_id", "page", "n", kind.alias("kind"), F.lit("B").alias("source_rung"), F.struct(F.col("left").alias("x0"), "y0", F.col("right").alias("x1"), "y1", F.col("page")).alias("bbox"), F.when(F.col("kind") == "text", F.trim("text")).alias("text"), F.when(F.col("kind") == "table", raw).alias("table_data"), F.when((F.col("kind") != "text") & (F.col("caption") != ""), F.col("caption")).alias("caption"), F.when(F.col("kind") == "text", F.col("label")).alias("label"), place.alias("place"))
    n = i.groupBy("doc_id", "page").agg(F.count("*").alias("c"))
    n = n.withColumn("before", F.sum("c").over(Window.partitionBy("doc_id").orderBy("page")) - F.col("c")).drop("c")
    i = i.join(n, ["doc_id", "page"]).withColumn("idx", (F.col("before") + F.col("place") - 1).cast("int"))
    key = F.struct("doc_id", "idx").alias("element_id")
    done = tables.repair(i.withColumn("element_id", key)).select("element_id.doc_id", "element_id.idx", F.struct("headers", "rows", "row_periods", "context").alias("table_data"))
    return i.drop("table_data", "page", "n", "place", "before").join(done, ["doc_id", "idx"], "left").select("doc_id", "idx", "kind", "source_rung", "bbox", "text", "table_data", "caption", "label")

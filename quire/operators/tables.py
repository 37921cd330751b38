"""Printed tables: checks, captions, repair, splitting, and the unpivot into facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X

# Limits of the table checks, the repair and the splitting.
COLUMNS, HEADER_FILL, CELL_FILL, PADDING, NEAR_PT, CONTEXT = 2, 0.5, 0.4, 0.4, 73.0, 300
MAX_TOKENS = 900
PERIOD_TOKEN = r"(?i)^(?:(?:19|20)[0-9]{2}(?:\s*[-–/]\s*[0-9]{2,4})?|efy\s*-?\s*[0-9]{2,4}|q[1-4](?:\s*(?:19|20)[0-9]{2})?|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?(?:\s*(?:19|20)[0-9]{2})?)$"
TABLE_SIGN = r"(?i)^table\s*[0-9]+\s*:"


def _share(cells: Column) -> Column:
    return F.when(F.size(cells) > 0, F.size(F.filter(cells, X.filled)) / F.size(cells)).otherwise(0.0)


def failed_checks(headers: Column, rows: Column) -> Column:
    """Names of the checks a table fails, in order; none for a sane one. Null headers or rows count as empty ones."""
    h, r = F.coalesce(headers, F.array().cast("array<string>")), F.coalesce(rows, F.array().cast("array<array<string>>"))
    return F.array_compact(F.array(
        F.when(F.size(h) < COLUMNS, "too_few_columns"), F.when(F.size(r) == 0, "no_rows"), F.when((F.size(h) > 0) & (_share(h) < HEADER_FILL), "empty_headers"), F.when((F.size(r) > 0) & (_share(F.flatten(r)) < CELL_FILL), "mostly_empty_cells")))


def period_major(headers: Column, rows: Column) -> Column:
    """Whether periods run down the first column rather than across the header; a tie says no."""
    first = F.transform(F.filter(rows, lambda r: F.size(r) > 0), lambda r: r[0])
    return X.period_share(first) > X.period_share(F.slice(headers, 2, F.greatest(F.size(headers), F.lit(1))))


def rendered(headers: Column, rows: Column) -> Column:
    """A table as text: one line for the header and for each row."""
    line = lambda cells: F.array_join(F.transform(cells, lambda c: F.coalesce(X.collapsed(c), F.lit(""))), " | ")
    return F.array_join(F.concat(F.array(line(headers)), F.transform(rows, line)), "\n")


def single_caption(caption: Column) -> Column:
    """A caption without its welded copies: the half of an exact doubling, or what stands from the last of several `Table n:`."""
    half = (F.length(caption) / 2).cast("int")
    doubled = (F.length(caption) > 0) & (F.length(caption) % 2 == 0) & (F.substring(caption, F.lit(1), half) == F.substring(caption, half + 1, half))
    last = F.regexp_extract(caption, r"(?is)^.*(table\s*[0-9]+\s*:.*)$", 1)
    several = F.regexp_count(caption, F.lit(r"(?i)table\s*[0-9]+\s*:")) >= 2
    return F.when(doubled, F.substring(caption, F.lit(1), half)).when(several, last).otherwise(caption)


def contexts(elements: DataFrame) -> DataFrame:
    """element_id, context of each table: its own, its caption, or the nearest caption text on the page, the first of equals.

    An empty one counts as none. Captions and caption texts are collapsed and clipped to CONTEXT characters; own contexts and captions
    lose their welded copies.
    """
    some = lambda c: F.when(c != "", c)
    clip = lambda c: F.substring(X.collapsed(c), 1, CONTEXT)
    t = elements.where("kind = 'table'").select("element_id", "doc_id", F.col("bbox.page").alias("page"), F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"), single_caption(some(F.col("table_data.context"))).alias("own"), single_caption(clip(some(F.col("caption")))).alias("caption"))
    c = elements.where("kind = 'text'").where(F.trim("text").rlike(X.CAPTION)).select("doc_id", F.col("bbox.page").alias("page"), "idx", F.col("bbox.y0").alias("a0"), F.col("bbox.y1").alias("a1"), clip(F.col("text")).alias("words"))
    lacking = t.where("own is null and caption is null")
    gap = F.least(F.abs(F.col("y0") - F.col("a1")), F.abs(F.col("a0") - F.col("y1")))
    near = lacking.join(c, ["doc_id", "page"]).withColumn("gap", gap).where(F.col("gap") < NEAR_PT).groupBy("element_id").agg(F.min_by("words", F.struct("gap", "idx")).alias("near"))
    return t.join(near, "element_id", "left").select("element_id", F.coalesce("own", "caption", "near").alias("context"))


def unpivoted(elements: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """One row per filled cell of each table with two columns or more: doc_id, element_id, key, period, value_raw, value, unit, context,
    document, page, bbox, content_hash, skipped.

    Rows are keys and headers periods, or the other way round where periods run down; under a block period the row is the key. Of
    equal (document, key, period, value_raw) the first in reading order stays, and `skipped` counts the others. White space in keys
    and periods is collapsed; an empty period is null. A document is called by the name that its profiles give, else by its id.
    """
    t = elements.where("kind = 'table' and size(table_data.headers) >= 2").select("element_id", "doc_id", "idx", "bbox", F.col("table_data.headers").alias("headers"), F.col("table_data.rows").alias("rows"), F.col("table_data.row_periods").alias("blocks"))
    t = t.withColumn("down", period_major(F.col("headers"), F.col("rows")))
    r = t.select("element_id", "doc_id", "idx", "bbox", "headers", "blocks", "down", F.posexplode("rows").alias("row_no", "cells"))
    r = r.select("*", X.collapsed(F.get("cells", F.lit(0))).alias("label"), F.get("blocks", F.col("row_no")).alias("block")).where("label <> ''")
    cells = F.slice("cells", 2, F.greatest(F.least(F.size("cells"), F.size("headers")) - 1, F.lit(0)))
    c = r.select("element_id", "doc_id", "idx", "bbox", "row_no", "label", F.when(F.col("block") != "", F.col("block")).alias("block"), "down", "headers", F.posexplode(cells).alias("at", "cell"))
    head = F.coalesce(X.collapsed(F.get("headers", F.col("at") + 1)), F.lit(""))
    key = F.when(F.col("block").isNotNull() | ~F.col("down"), F.col("label")).otherwise(head)
    period = F.coalesce("block", F.when(F.col("down"), F.col("label")).otherwise(head))
    c = c.where(X.filled(F.col("cell"))).select("element_id", "doc_id", "idx", "bbox", "row_no", "at", key.alias("key"), period.alias("period"), F.trim("cell").alias("value_raw"))
    if profiles is None:
        c = c.withColumn("document", F.col("doc_id"))
    else:
        names = profiles.groupBy("doc_id").agg(F.min("source_name").alias("name"))
        c = c.join(names, "doc_id", "left").withColumn("document", F.coalesce("name", "doc_id")).drop("name")
    first = c.where("key <> ''").groupBy("document", "key", "period", "value_raw").agg(F.min(F.struct("idx", "row_no", "at", "element_id", "doc_id", "bbox")).alias("f"), F.count("*").alias("copies"))
    first = first.join(contexts(elements).withColumnRenamed("element_id", "__element"), F.col("f.element_id") == F.col("__element"), "left")
    value, unit = X.parse_number(F.col("value_raw"))
    return first.select(F.col("f.doc_id").alias("doc_id"), F.col("f.element_id").alias("element_id"), "key", F.when(F.col("period") != "", F.col("period")).alias("period"), "value_raw", value.alias("value"), unit.alias("unit"), "context",
        "document", F.col("f.bbox.page").alias("page"), F.col("f.bbox").alias("bbox"), X.content_hash(F.concat_ws("|", "document", "key", "period", "value_raw")).alias("content_hash"), (F.col("copies") - 1).alias("skipped"))


def split_parts(headers: Column, rows: Column, limit: int = MAX_TOKENS) -> Column:
    """Parts of a table under the token limit, each with the header again and, where there are several, its number in front."""
    whole, head = X.token_estimate(rendered(headers, rows)), X.token_estimate(rendered(headers, F.array().cast("array<array<string>>")))
    n = F.size(rows)
    per_row = F.greatest(F.lit(1), F.floor(whole / F.greatest(n, F.lit(1))))
    each = F.greatest(F.lit(1), F.floor((F.lit(limit) - head) / per_row)).cast("int")
    parts = F.greatest(F.ceil(n / each), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(1), parts), lambda i: F.concat(F.format_string("[part %d/%d]\n", i, parts), rendered(headers, F.slice(rows, (i - 1) * each + 1, each))))
    return F.when(whole <= limit, F.array(rendered(headers, rows))).otherwise(cut)


def from_grid(names: Column, grid: Column, outside: Column) -> tuple[Column, Column]:
    """(headers, rows) of a detected grid: its names where it has a list of them, else its first row; the rows go on from there, or are all where the header stands `outside`. Both are null where a row has another length than the header."""
    fill = lambda r: F.transform(r, lambda c: F.coalesce(c, F.lit("")))
    given = F.coalesce(F.size(names) > 0, F.lit(False))
    headers = F.when(given, fill(names)).otherwise(fill(F.get(grid, F.lit(0))))
    rows = F.transform(F.when(outside, grid).otherwise(F.slice(grid, 2, F.greatest(F.size(grid) - 1, F.lit(0)))), fill)
    even = (F.size(grid) > 0) & F.forall(rows, lambda r: F.size(r) == F.size(headers))
    return F.when(even, headers), F.when(even, rows)


def repair(elements: DataFrame) -> DataFrame:
    """element_id, headers, rows, row_periods, context: each table with fused captions taken out of its cells and padding taken out of its grid.

    A cell of several lines that holds a value keeps the first one; one that holds the sign of a caption keeps what stands before it. The
    other lines, joined as they were sliced, are the context, before the table's own. A grid with more than PADDING of its cells
    empty is packed: every row with a value begins a new row of its label and values; rows without values go on with the label before
    them, or, where they are periods only, name the block of the rows that follow, as does a period in front of a label. Null
    headers, rows and cells count as empty; a table without cells stays as it is. All steps are column expressions over one table.
    """
    strings, grid = "array<string>", "array<array<string>>"
    value = lambda c: X.parse_number(c)[0].isNotNull()
    period = lambda c: F.trim(c).rlike(PERIOD_TOKEN)
    t = elements.where("kind = 'table'").select("element_id", F.transform(F.coalesce("table_data.headers", F.array().cast(strings)), lambda h: F.coalesce(X.collapsed(h), F.lit(""))).alias("headers"), F.coalesce("table_data.rows", F.array().cast(grid)).alias("rows"), F.col("table_data.row_periods").alias("blocks"), F.col("table_data.context").alias("own"))

    # Cells by lines; which line of a cell to keep, by kind: a value in place `at`, or a caption from place `at` on.
    lines = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    t = t.withColumn("lines", F.transform("rows", lambda r: F.transform(r, lines)))
    place = lambda ls, test: F.coalesce(F.array_position(F.transform(ls, test), F.lit(True)), F.lit(0)).cast("int")
    t = t.withColumn("places", F.transform("lines", lambda r: F.transform(r, lambda ls: F.struct(ls.alias("ls"), F.when(F.size(ls) > 1, place(ls, value)).otherwise(0).alias("v"), F.when(F.size(ls) > 1, place(ls, lambda x: x.rlike(TABLE_SIGN))).otherwise(0).alias("sign")))))
    kept = lambda p: F.when(p["v"] > 0, F.get(p["ls"], p["v"] - 1)).when(p["sign"] > 0, F.array_join(F.slice(p["ls"], F.lit(1), p["sign"] - 1), " ")).otherwise(F.array_join(p["ls"], " "))
    freed = lambda p: F.when(p["v"] > 0, F.array_join(F.filter(p["ls"], lambda x, i: i != p["v"] - 1), "")).when(p["sign"] > 0, F.array_join(F.slice(p["ls"], p["sign"], F.size(p["ls"])), "")).otherwise("")
    caption = X.collapsed(F.array_join(F.transform(F.flatten("places"), freed), ""))
    t = t.select("element_id", "headers", "blocks", F.coalesce(F.when(caption != "", F.substring(caption, 1, CONTEXT)), F.col("own")).alias("context"), F.transform("places", lambda r: F.transform(r, lambda p: X.collapsed(kept(p)))).alias("grid"))
    cells = F.flatten("grid")
    t = t.withColumn("padded", (F.size(cells) > 0) & (F.size(F.filter(cells, lambda c: c == "")) > PADDING * F.size(cells)))

    # Rows by what they are: words, and the place of the first value among them (0: none).
    words = F.transform("grid", lambda r: F.filter(r, lambda c: c != ""))
    t = t.withColumn("words", F.when(F.col("padded"), words))
    t = t.withColumn("rows", F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"), place(w, value).alias("v"), period(F.get(w, F.lit(0))).alias("dated"), F.forall(w, period).alias("periods"))))
    data = F.filter("rows", lambda r: r["v"] > 0)
    # A period in front of the label, which is no value itself, names a block like a row of periods does.
    marks = F.transform(F.filter("rows", lambda r: F.when(r["v"] > 0, r["dated"] & (r["v"] > 1)).otherwise((F.size(r["w"]) > 0) & r["periods"])), lambda r: F.struct(r["i"].alias("i"), F.when(r["v"] > 0, F.get(r["w"], F.lit(0))).otherwise(F.array_join(r["w"], " ")).alias("name")))
    t = t.withColumns({"data": data, "marks": marks})
    t = t.withColumn("periods", F.transform("data", lambda r: F.try_element_at(F.filter("marks", lambda m: m["i"] <= r["i"]), F.lit(-1))["name"]))

    def packed(r: Column, n: Column) -> Column:
        upto = F.coalesce(F.get("data", n + 1)["i"], F.size("rows"))
        below = F.flatten(F.transform(F.filter(F.slice("rows", r["i"] + 2, F.greatest(upto - r["i"] - 1, F.lit(0))), lambda m: ~m["periods"]), lambda m: m["w"]))
        begin = F.when(r["dated"] & (r["v"] > 1), 2).otherwise(1)
        label = F.array_join(F.concat(F.slice(r["w"], begin, r["v"] - begin), below), " ")
        return F.concat(F.array(label), F.slice(r["w"], r["v"], F.size("words") + F.size(r["w"])))

    t = t.withColumn("packed", F.transform("data", packed))
    measures = F.filter("headers", lambda h: h != "")
    t = t.withColumn("width", F.greatest(F.size(measures) + 1, F.coalesce(F.array_max(F.transform("packed", F.size)), F.lit(0))))
    wide = lambda a: F.concat(a, F.array_repeat(F.lit(""), F.col("width") - F.size(a)))
    return t.select("element_id", F.when(F.col("padded"), wide(F.concat(F.array(F.lit("")), measures))).otherwise(F.col("headers")).alias("headers"), F.when(F.col("padded"), F.transform("packed", wide)).otherwise(F.col("grid")).alias("rows"),
        F.when(~F.col("padded"), F.col("blocks")).when(F.exists("periods", lambda p: p.isNotNull()), F.col("periods")).alias("row_periods"), "context")

"""How much of a page's ink the extracted elements account for: grids, thresholds, regions, overlaps, escalation.

Boxes become rows of a page's grid with a bit mask of the columns they touch; pages are assessed by bit counts. Only the
components of what is left need a function over a page's rows, which are bounded by its grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators import tables

# Threshold of coverage, largest share of a page one element may claim, smallest region, overlap of twins.
TAU, CLAIM, REGION, TWIN = 0.85, 0.60, 900.0, 0.5
#: Columns that one word of a mask holds.
BITS = 60


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def overlap_ratio(a: Column, b: Column) -> Column:
    """Intersection over the smaller area; 0 where they don't meet."""
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.when((w > 0) & (h > 0), w * h / F.least(area(a), area(b))).otherwise(0.0)


def flipped(b: Column, height: Column) -> Column:
    """A box with the origin below, in coordinates from the top."""
    return F.struct(b["x0"].alias("x0"), (height - b["y1"]).alias("y0"), b["x1"].alias("x1"), (height - b["y0"]).alias("y1"), b["page"].alias("page"))


def box_rows(boxes: DataFrame, keys: list[str], width: float, height: float, rows: int, cols: int, sets: dict[str, Column]) -> DataFrame:
    """keys, r, and for each named set the mask of columns that its boxes touch in row r: <set>0, <set>1, ... of BITS columns each.

    A box becomes one row per grid row it spans, and boxes of a page are united by bit_or inside the partial aggregation, so
    cells are never rows of their own.
    """
    clip = lambda x, n: F.least(F.greatest(x, F.lit(0)), F.lit(n)).cast("int")
    r0, r1 = clip(F.floor(F.col("bbox.y0") / height * rows), rows), clip(F.ceil(F.col("bbox.y1") / height * rows), rows)
    c0, c1 = clip(F.floor(F.col("bbox.x0") / width * cols), cols), clip(F.ceil(F.col("bbox.x1") / width * cols), cols)
    b = boxes.select(*keys, r0.alias("r0"), r1.alias("r1"), c0.alias("c0"), c1.alias("c1"), *[c.alias(f"in_{n}") for n, c in sets.items()]).where("r1 > r0 and c1 > c0")
    words = range(-(-cols // BITS))
    at = lambda c, k: F.least(F.greatest(F.col(c) - k * BITS, F.lit(0)), F.lit(BITS))
    bit = lambda c, k: F.call_function("shiftleft", F.lit(1).cast("bigint"), at(c, k).cast("int"))
    mask = lambda k: bit("c1", k) - bit("c0", k)
    b = b.select(*keys, *[F.col(f"in_{n}") for n in sets], *[mask(k).alias(f"m{k}") for k in words], F.explode(F.sequence(F.col("r0"), F.col("r1") - 1)).alias("r"))
    return b.groupBy(*keys, "r").agg(*[F.coalesce(F.bit_or(F.when(F.col(f"in_{n}"), F.col(f"m{k}"))), F.lit(0).cast("bigint")).alias(f"{n}{k}") for n in sets for k in words])


def valid_claims(elements: DataFrame, page_area: float) -> DataFrame:
    """Elements with `valid`: none may claim more than CLAIM of its page, but for rung C and a figure beside text."""
    page = F.col("bbox.page")
    has_text = elements.where("kind = 'text'").select("doc_id", page.alias("page")).distinct().withColumn("beside", F.lit(True))
    e = elements.withColumn("page", page).join(has_text, ["doc_id", "page"], "left")
    fits = area(F.col("bbox")) / page_area <= CLAIM
    return e.withColumn("valid", fits | (F.coalesce(F.col("source_rung"), F.lit("")) == "C") | ((F.col("kind") == "figure") & F.coalesce("beside", F.lit(False)))).drop("beside")


def assessed(grid: DataFrame, keys: list[str], tau: float = TAU) -> DataFrame:
    """keys, inked, covered, coverage, escalate, of box_rows() with the sets ink and claimed; a blank page is not listed."""
    words = sum(c.startswith("ink") for c in grid.columns)
    total = lambda f: sum((F.bit_count(f(k)) for k in range(1, words)), F.bit_count(f(0)))
    a = grid.groupBy(*keys).agg(F.sum(total(lambda k: F.col(f"ink{k}"))).alias("inked"), F.sum(total(lambda k: F.col(f"ink{k}").bitwiseAND(F.col(f"claimed{k}")))).alias("covered")).where("inked > 0")
    return a.withColumn("coverage", F.round(F.col("covered") / F.col("inked"), 4)).withColumn("escalate", F.col("covered") / F.col("inked") < tau)


def runs(mask: int) -> list[tuple[int, int]]:
    """The stretches of set bits, as [start, end)."""
    out = []
    while mask:
        a = (mask & -mask).bit_length() - 1
        n = (~(mask >> a) & (mask >> a) + 1).bit_length() - 1
        out.append((a, a + n))
        mask &= ~(((1 << n) - 1) << a)
    return out


def components(rows: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(r0, c0, r1, c1, cells) of the 4-connected components of rows (r, mask), in order of their first cell: runs of a row that touch runs of the row above are united."""
    root: list[int] = []
    cells: list[tuple[int, int, int]] = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    above: list[int] = []
    last = None
    for r, mask in sorted(rows):
        here = []
        for a, z in runs(mask):
            i = len(root)
            root.append(i)
            cells.append((r, a, z))
            here.append(i)
            for j in above if last == r - 1 else ():
                if cells[j][1] < z and a < cells[j][2]:
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
        above, last = here, r
    boxes: dict[int, list[int]] = {}
    for i, (r, a, z) in enumerate(cells):
        k = find(i)
        b = boxes.setdefault(k, [r, a, r + 1, z, 0])
        b[0], b[1], b[2], b[3], b[4] = min(b[0], r), min(b[1], a), max(b[2], r + 1), max(b[3], z), b[4] + z - a
    return [tuple(boxes[k]) for k in sorted(boxes)]


def residual_regions(grid: DataFrame, keys: list[str], cell_w: float, cell_h: float, least: float = REGION) -> DataFrame:
    """keys, region, x0, y0, x1, y1, cells: components whose own cells have at least the area, in the ink that nothing claims, of box_rows() with the sets ink and claimed."""
    words = sum(c.startswith("ink") for c in grid.columns)
    left = grid.select(*keys, "r", *[F.col(f"ink{k}").bitwiseAND(F.bitwise_not(F.col(f"claimed{k}"))).alias(f"m{k}") for k in range(words)])
    left = left.where(" or ".join(f"m{k} <> 0" for k in range(words)))
    pages = left.groupBy(*keys).agg(F.collect_list(F.struct("r", *[f"m{k}" for k in range(words)])).alias("rows"))  # as many as the grid has rows
    schema = ", ".join(f"{k} {t}" for k, t in grid.select(*keys).dtypes) + ", region int, x0 double, y0 double, x1 double, y1 double, cells int"

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for p in b.itertuples(index=False):
                n = 0
                for r0, c0, r1, c1, size in components([(x["r"], sum(x[f"m{k}"] << (BITS * k) for k in range(words))) for x in p.rows]):
                    box = (c0 * cell_w, r0 * cell_h, c1 * cell_w, r1 * cell_h)
                    if size * cell_w * cell_h >= least:
                        out.append((*p[: len(keys)], n, *map(float, box), size))
                        n += 1
            yield pd.DataFrame(out, columns=[*keys, "region", "x0", "y0", "x1", "y1", "cells"])

    return pages.mapInPandas(find, schema)


def otsu(levels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, threshold: of rows (keys, bin), the first bin that separates best (largest variance between classes); -1 where nothing separates."""
    h = levels.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy("bin")
    every = Window.partitionBy(*keys)
    h = h.withColumns({"all": F.sum("n").over(every), "total": F.sum(F.col("n") * F.col("bin")).over(every), "w": F.sum("n").over(w), "m": F.sum(F.col("n") * F.col("bin")).over(w)})
    omega, mu = F.col("w") / F.col("all"), F.col("m") / F.col("all")
    var = F.try_divide((F.col("total") / F.col("all") * omega - mu) ** 2, F.nullif(omega * (1 - omega), F.lit(0.0)))
    h = h.withColumn("var", F.round(var, 9))
    return h.groupBy(*keys).agg(F.max("var").alias("best"), F.max_by("bin", F.struct(F.coalesce("var", F.lit(-1.0)), (-F.col("bin")).alias("b"))).alias("t")).select(*keys, F.when(F.coalesce(F.col("best") > 1e-9, F.lit(False)), F.col("t")).otherwise(-1).alias("threshold"))


def outside_tables(elements: DataFrame) -> DataFrame:
    """element_id of text elements that no table of their page contains."""
    page = F.col("bbox.page").alias("page")
    t = elements.where("kind = 'text'").select("element_id", "doc_id", page, F.col("bbox").alias("b"))
    g = elements.where("kind = 'table'").select("doc_id", page, F.col("bbox").alias("g"))
    inside = t.join(g, ["doc_id", "page"]).where("b.x0 >= g.x0 and b.y0 >= g.y0 and b.x1 <= g.x1 and b.y1 <= g.y1").select("element_id").distinct()
    return t.join(inside, "element_id", "left_anti").select("element_id")


def without_twins(elements: DataFrame, ratio: float = TWIN) -> DataFrame:
    """element_id of rung-C tables that overlap no sane table of another rung on their page by the ratio or more."""
    page = F.col("bbox.page").alias("page")
    v = elements.where("kind = 'table' and source_rung = 'C'").select("element_id", "doc_id", page, F.col("bbox").alias("b"))
    sane = F.size(tables.failed_checks(F.col("table_data.headers"), F.col("table_data.rows"))) == 0
    h = elements.where("kind = 'table' and source_rung <> 'C'").where(sane).select("doc_id", page, F.col("bbox").alias("g"))
    twin = v.join(h, ["doc_id", "page"]).where(overlap_ratio(F.col("b"), F.col("g")) >= ratio).select("element_id").distinct()
    return v.join(twin, "element_id", "left_anti").select("element_id")


def budgeted(regions: DataFrame, cap: float) -> DataFrame:
    """doc_id, page, label, cost, gained, regions for regions (doc_id, page, region_no, cost, gained): what the vision rung reads of each page before its document's money is spent.

    Regions are read in order of page and number while less than `cap` is spent. A page of which all regions were read is C(regions); one that
    the budget ends is C(elements gained)!budget. A null cost or gain (a failed call) counts as 0.
    """
    r = regions.select("doc_id", "page", "region_no", F.coalesce("cost", F.lit(0.0)).alias("cost"), F.coalesce("gained", F.lit(0)).alias("gained"))
    pages = r.groupBy("doc_id", "page").agg(F.sum("cost").alias("c"))
    pages = pages.withColumn("before", F.coalesce(F.sum("c").over(Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).drop("c")
    inside = F.coalesce(F.sum("cost").over(Window.partitionBy("doc_id", "page").orderBy("region_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    r = r.join(pages, ["doc_id", "page"]).withColumn("read", F.round(F.col("before") + inside, 9) < cap)
    got = r.groupBy("doc_id", "page").agg(F.count("*").alias("regions"), F.count_if("read").alias("n"), F.round(F.sum(F.when(F.col("read"), F.col("cost")).otherwise(0.0)), 9).alias("cost"), F.sum(F.when(F.col("read"), F.col("gained")).otherwise(0)).alias("gained"))
    label = F.when(F.col("n") == F.col("regions"), F.format_string("C(%d)", "regions")).otherwise(F.format_string("C(%d)!budget", "gained"))
    return got.select("doc_id", "page", label.alias("label"), "cost", "gained", "regions")


def salvaged(elements: DataFrame) -> DataFrame:
    """element_id, context of all tables: tables without one of their own take that of the first table of the fast rung (A) on their page that has one."""
    t = elements.where("kind = 'table'").select("element_id", "doc_id", F.col("bbox.page").alias("page"), "idx", "source_rung", F.when(F.col("table_data.context") != "", F.col("table_data.context")).alias("own"))
    first = t.where("source_rung = 'A' and own is not null").groupBy("doc_id", "page").agg(F.min_by("own", "idx").alias("saved"))
    return t.join(first, ["doc_id", "page"], "left").select("element_id", F.coalesce("own", "saved").alias("context"))


def merged(elements: DataFrame, gained: DataFrame, ratio: float = TWIN) -> DataFrame:
    """The elements and what the vision rung gained beside them, without gained tables that repeat a sane one (both of the same columns)."""
    both = elements.unionByName(gained.withColumn("source_rung", F.lit("C")))
    kept = without_twins(both, ratio)
    tables_gained = (F.col("kind") == "table") & (F.col("source_rung") == "C")
    return both.where(~tables_gained).unionByName(both.where(tables_gained).join(kept, "element_id", "left_semi").select(*both.columns))


def judged_pages(pages: DataFrame, grid: DataFrame, keys: list[str], width: float, height: float, cell_w: float, cell_h: float, tau: float = TAU, least: float = REGION) -> DataFrame:
    """keys, coverage, escalate, regions, area_escalated_pct of all pages (keys): a page without ink is covered wholly; regions count only where the page escalates."""
    r = residual_regions(grid, keys, cell_w, cell_h, least).groupBy(*keys).agg(F.count("*").alias("regions"), F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("a"))
    j = pages.select(*keys).distinct().join(assessed(grid, keys, tau), keys, "left").join(r, keys, "left")
    up = F.coalesce("escalate", F.lit(False))
    return j.select(*keys, F.coalesce("coverage", F.lit(1.0)).alias("coverage"), up.alias("escalate"), F.when(up, F.coalesce("regions", F.lit(0))).otherwise(0).alias("regions"), F.when(up, F.round(F.coalesce("a", F.lit(0.0)) / (width * height) * 100, 2)).otherwise(0.0).alias("area_escalated_pct"))


def drawn_figures(drawings: DataFrame, width: float, height: float, cell: float = 8.0, least: float = 2000.0) -> DataFrame:
    """doc_id, page, region, x0, y0, x1, y1, cells: clusters of drawings (doc_id, bbox) on a grid of about `cell` points that cover at least `least` square points."""
    rows, cols = max(1, int(height / cell)), max(1, int(width / cell))
    g = box_rows(drawings.select("doc_id", F.col("bbox.page").alias("page"), "bbox"), ["doc_id", "page"], width, height, rows, cols, {"ink": F.lit(True), "claimed": F.lit(False)})
    return residual_regions(g, ["doc_id", "page"], width / cols, height / rows, least)


def escalated(pages: DataFrame, a: DataFrame, b: DataFrame, c: DataFrame, tau: float = TAU) -> DataFrame:
    """doc_id, page, label, coverage: the ladder of rungs. pages has the start rung; a and b (doc_id, page, coverage, insane) what each
    rung gave; c (doc_id, page, regions, coverage) the vision rung. Each stage takes only pages that the stage before left open.
    """
    j = pages.select("doc_id", "page", "start").join(a.withColumnsRenamed({"coverage": "ca", "insane": "ia"}), ["doc_id", "page"], "left").join(b.withColumnsRenamed({"coverage": "cb", "insane": "ib"}), ["doc_id", "page"], "left").join(c.withColumnsRenamed({"coverage": "cc"}), ["doc_id", "page"], "left")
    open_ = lambda cov, bad: F.coalesce(F.col(cov) < tau, F.lit(True)) | F.coalesce(F.col(bad), F.lit(False))
    did_a = F.col("start") == "A"
    to_b = (did_a & open_("ca", "ia")) | (F.col("start") == "B")
    did_b = to_b & F.col("cb").isNotNull()
    to_c = (F.col("start") == "C") | (did_b & open_("cb", "ib")) | (to_b & ~did_b & open_("ca", "ia"))
    did_c = to_c & F.col("regions").isNotNull()
    steps = F.array_compact(F.array(F.when(did_a, "A"), F.when(did_b, "B"), F.when(did_c, F.concat(F.lit("C("), F.col("regions").cast("string"), F.lit(")"))), F.when(to_c & ~did_c, "C-unavailable")))
    cov = F.when(did_c, F.col("cc")).when(did_b, F.col("cb")).otherwise(F.col("ca"))
    return j.select("doc_id", "page", F.when(F.size(steps) > 0, F.array_join(steps, "→")).otherwise("none").alias("label"), F.coalesce(cov, F.lit(0.0)).alias("coverage"))

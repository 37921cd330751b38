"""Page signals and the rules that label a page: origin, layout, language, domain, rung and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X

# Thresholds and word lists of the page rules.
DENSITY, IMAGE, RULED, FIGURE = 0.5, 0.5, 10, 0.15
DOMAINS = {
    "financial": ["revenue", "audit", "balance sheet", "birr", "assets", "liabilities", "profit", "fiscal", "tax"],
    "legal": ["hereby", "pursuant", "regulation", "article", "proclamation", "whereas"],
    "technical": ["voltage", "specification", "interface", "gpio", "protocol", "vulnerability"],
    "medical": ["patient", "clinical", "dosage", "pharmaceutical"],
}
VOTES, MAJORITY = 3, 0.7
START_RUNG = {"native_digital": "A", "mixed": "B", "scanned_image": "C", "form_fillable": "B"}
PAGE_AREA = 595.0 * 842.0


def page_text(elements: DataFrame) -> DataFrame:
    """doc_id, page and sums over the page's text elements; the texts themselves are not brought together."""
    t = F.coalesce("text", F.lit(""))
    # Composed forms count: a letter and its accent are one character.
    e = elements.where("kind in ('text', 'furniture')").withColumn("text", X.nfc(t)).select("doc_id", F.col("bbox.page").alias("page"), F.length(F.regexp_replace(t, r"(?U)\s", "")).alias("n"), X.ethiopic(t).alias("eth"), X.latin(t).alias("lat"), F.struct(*[_votes(t, ws).alias(d) for d, ws in DOMAINS.items()]).alias("v"))
    return e.groupBy("doc_id", "page").agg(F.sum("n").alias("n_chars"), F.sum("eth").alias("ethiopic_chars"), F.sum("lat").alias("latin_chars"), *[F.sum(f"v.{d}").alias(f"votes_{d}") for d in DOMAINS])


def _votes(text: Column, words: list[str]) -> Column:
    return F.regexp_count(F.lower(text), F.lit(r"\b(" + "|".join(words) + r")\b"))


def density(n_chars: Column, area: float = PAGE_AREA) -> Column:
    return F.round(n_chars / area * 1000, 3)


def origin(density: Column, image: Column, widgets: Column | None = None) -> Column:
    form = F.coalesce(widgets > 0, F.lit(False)) if widgets is not None else F.lit(False)
    return F.when(form, "form_fillable").when((density < DENSITY) & (image > IMAGE), "scanned_image").when((density >= DENSITY) & (image <= IMAGE), "native_digital").otherwise("mixed")


def layout(origin: Column, ruled: Column, columns: Column, image: Column) -> Column:
    return F.when(origin == "scanned_image", "mixed").when(ruled >= RULED, "table_heavy").when(columns >= 2, "multi_column").when(image >= FIGURE, "figure_heavy").otherwise("single_column")


def language(eth: Column, lat: Column) -> Column:
    return F.when(eth > lat, "am").when(lat > 20, "en").otherwise("unknown")


def domain(votes: dict[str, Column]) -> Column:
    """The domain with most votes, the first listed of equals, if it has enough of them."""
    best = F.greatest(*votes.values())
    out = F.lit("general")
    for d in reversed(votes):
        out = F.when(votes[d] == best, d).otherwise(out)
    return F.when(best >= VOTES, out).otherwise("general")


def rung(origin: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in START_RUNG.items() for x in kv]), origin)


def confidence(origin: Column, density: Column, image: Column) -> Column:
    near = F.least(F.least(F.abs(density - 0.5) / 2, F.lit(1.0)), F.least(F.abs(image - 0.5) / 0.5, F.lit(1.0)))
    # Three decimals by floor, so results don't hang on how an engine rounds a half.
    return F.when(origin == "mixed", 0.5).otherwise(F.floor((0.5 + 0.5 * near) * 1000 + 0.5 + 1e-9) / 1000)


def dominant_origin(profiles: DataFrame) -> DataFrame:
    """doc_id, dominant_origin, share: the origin of most pages, the first seen of equals, if it has the majority asked for."""
    n = profiles.groupBy("doc_id", "origin_type").agg(F.count("*").alias("n"), F.min("page").alias("first"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("n"), "first", "origin_type")
    top = n.withColumns({"all": F.sum("n").over(Window.partitionBy("doc_id")), "k": F.row_number().over(w)}).where("k = 1")
    share = F.col("n") / F.col("all")
    return top.select("doc_id", F.when(share >= MAJORITY, F.col("origin_type")).otherwise("mixed").alias("dominant_origin"), F.round(share, 4).alias("share"))


def column_starts(x0: Column, width: float = 20.0, share: float = 0.2, apart: float = 100.0, least: int = 10) -> Column:
    """How many columns an array of word starts shows: bins that hold enough words, merged greedily while closer than `apart`."""
    bins = F.transform(x0, lambda x: F.floor(x / width))
    strong = F.filter(F.array_sort(F.array_distinct(bins)), lambda b: F.size(F.filter(bins, lambda c: c == b)) >= share * F.size(x0))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1e9).alias("last"))
    fold = F.aggregate(strong, start, lambda s, b: F.when(b * width - s["last"] >= apart, F.struct((s["n"] + 1).alias("n"), (b * width).cast("double").alias("last"))).otherwise(s), lambda s: s["n"])
    return F.when(F.size(x0) < least, F.lit(0).cast("bigint")).otherwise(fold)


def ruled_lines(strokes: DataFrame, long: float = 100.0, thick: float = 3.0) -> DataFrame:
    """doc_id, page, ruled: strokes (doc_id, bbox) that are at least `long` in one direction and at most `thick` in the other. Pages without strokes are not listed."""
    w, h = F.col("bbox.x1") - F.col("bbox.x0"), F.col("bbox.y1") - F.col("bbox.y0")
    return strokes.groupBy("doc_id", F.col("bbox.page").alias("page")).agg(F.count_if(((w >= long) & (h <= thick)) | ((h >= long) & (w <= thick))).alias("ruled"))


def image_area(figures: DataFrame, width: float, height: float) -> DataFrame:
    """doc_id, page, image_area_ratio: the share of the page that images (doc_id, bbox) cover, each clipped to the page, at most the whole."""
    inside = lambda c, most: F.least(F.greatest(F.col(f"bbox.{c}"), F.lit(0.0)), F.lit(most))
    a = F.greatest(inside("x1", width) - inside("x0", width), F.lit(0.0)) * F.greatest(inside("y1", height) - inside("y0", height), F.lit(0.0))
    f = figures.groupBy("doc_id", F.col("bbox.page").alias("page")).agg(F.round(F.sum(a), 2).alias("a"))
    # Four decimals by floor, so results don't hang on how an engine rounds a half.
    return f.select("doc_id", "page", F.least(F.floor(F.col("a") / (width * height) * 10000 + 0.5) / 10000, F.lit(1.0)).alias("image_area_ratio"))


def page_texts(elements: DataFrame) -> DataFrame:
    """doc_id, page, text: the texts of each page in their order, a line for each; blank ones left out."""
    e = elements.where("kind = 'text'").where(X.filled(F.col("text")))
    g = e.groupBy("doc_id", F.col("bbox.page").alias("page")).agg(F.array_sort(F.collect_list(F.struct("idx", "element_id", "text"))).alias("t"))  # one page's texts
    return g.select("doc_id", "page", F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("text"))

"""Problem 4: items above a size limit, cut at natural boundaries with an overlap.

An oversized text is never handled as a whole. It is cut into ranges; each range, with a halo of its neighbours' text on both
sides, is searched for boundaries by some worker (boundaries()). A halo on the right that is white space goes on to the end of the
white space, so every boundary that starts in a range is seen whole. The boundary tables are stitched by the prefix sum of the
ranges' lengths, and chosen() picks the cut offsets range by range, from the offsets alone. Pieces are then taken out by offset. Giant files are
read the same way: file_ranges() has workers seek to their bytes, whole characters only, so no worker holds a file; any file system
that pyarrow opens by its URI will do (local and mounted folders, HDFS, object stores).

Sizes are characters (code points); a token is CHARS characters, a part of one counting as one. A text of up to `limit` tokens
is one piece. A null text gives no piece, an empty one an empty piece. Text without any boundary is cut at the limit. Pieces
put together without their overlaps are the text again, character by character. Ids must be unique; ids that repeat are kept
apart by nothing, so give another id. The overlap must stay under half the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import parallelism

CHARS, LIMIT, OVERLAP = 4, 900, 40
RANGE, HALO = 65_536, 256
LEVELS = ("paragraph", "line", "sentence", "word")
# Words whose dot ends no sentence.
ABBREVIATIONS = set("no nos nr nrs art arts vol vols incl approx ca cf etc e.g i.e eg ie vs viz fig figs tab pp p para paras sec sect ch chap ed eds rev dr mr mrs ms prof hon gov gen st ltd co corp inc dept est max min avg tel ext ref add cap ann resp núm num pág págs sr sra srta dr dra ing lic av avda aprox ud uds env mme mm mlle bd réf réfs chap z.b bzw usw inkl zzgl ggf abs bspw vgl evtl str hr fr jan feb apr jun jul aug sep sept oct nov dec ref encl excl".split())
PARAGRAPH, LINE, WORD = re.compile(r"\n[^\S\n]*\n\s*"), re.compile(r"\n+"), re.compile(r"\s+")
SENTENCE = re.compile(r"[.!?።][\"'”’»)\]]*(\s+)|(\n+)")
LAST_WORD = re.compile(r"[^\s(\[;,]+$")


def tokens(text: Column) -> Column:
    return F.ceil(F.length(text) / CHARS)


def _sentence_ends(text: str) -> Iterator[tuple[int, int]]:
    for m in SENTENCE.finditer(text):
        g = 1 if m.group(1) is not None else 2
        if g == 1 and text[m.start()] == "." and "\n" not in m.group(1):
            w = LAST_WORD.search(text, max(0, m.start() - 24), m.start())
            w = w.group().lower() if w else ""
            if w in ABBREVIATIONS or (len(w) == 1 and w.isalpha()):
                continue
        yield m.span(g)


def spans(text: str, level: str) -> np.ndarray:
    """Start and end of each boundary's white space, in characters."""
    found = _sentence_ends(text) if level == "sentence" else (m.span() for m in {"paragraph": PARAGRAPH, "line": LINE, "word": WORD}[level].finditer(text))
    return np.array(list(found), dtype=np.int64).reshape(-1, 2)


def ranges(df: DataFrame, id_col: str, text_col: str, size: int = RANGE, halo: int = HALO) -> DataFrame:
    """id, range_no, before, part, n_chars, at (the offset of its first character): the text's ranges; `before` is how much of the part is the halo on the left."""
    text, n, halo_ = F.col(text_col), F.length(text_col), F.lit(halo)

    def one(i: Column) -> Column:
        a, z = i * size, F.least(i * size + size, n)
        tail = F.substring(text, z + 1, halo_)
        # Only a halo of nothing but white space is followed further.
        rest = F.when((F.length(tail) == halo) & ~tail.rlike(r"(?U)\S"), F.length(F.regexp_extract(F.substring(text, z + 1, n), r"(?U)^\s*", 0))).otherwise(halo_)
        left = F.least(a, halo_)
        return F.struct(i.alias("range_no"), a.cast("bigint").alias("at"), left.alias("before"), F.substring(text, a - left + 1, left + (z - a) + rest + 1).alias("part"), (z - a).alias("n_chars"))

    return df.where(n > 0).select(F.col(id_col).alias("id"), F.explode(F.transform(F.sequence(F.lit(0), F.expr(f"cast((length({text_col}) - 1) div {size} as int)")), one)).alias("r")).select("id", "r.*")


def opened(path: str):
    """The file, for reading anywhere in it."""
    where, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return where.open_input_file(name)


def _ranges_of(path: str, size: int) -> int:
    with opened(path) as f:
        return max(1, -(-f.size() // size))


def file_offsets(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """range_no, n_chars, at: how many characters begin in each range of bytes, and in those before it. Only these rows are summed up."""
    n = _ranges_of(path, size)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with opened(path) as f:
            for b in batches:
                rows = []
                for i in b["range_no"]:
                    f.seek(i * size)
                    rows.append((int(i), int(((np.frombuffer(f.read(size), np.uint8) & 0xC0) != 0x80).sum())))
                yield pd.DataFrame(rows, columns=["range_no", "n_chars"])

    numbers = spark.range(n).select(F.col("id").cast("int").alias("range_no")).repartition(min(n, parallelism(spark)))
    lengths = numbers.mapInPandas(count, "range_no int, n_chars bigint")
    return lengths.withColumn("at", F.sum("n_chars").over(Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_chars"))


def file_ranges(spark: SparkSession, path: str, size: int = RANGE, halo: int = HALO) -> DataFrame:
    """ranges() of one file that all workers see, by bytes; a range holds the characters that begin in its bytes."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with opened(path) as f:
            for b in batches:
                rows = []
                for i, first in zip(b["range_no"], b["at"]):
                    at, more = max(0, i * size - 4 * halo), 4 * halo
                    while True:
                        f.seek(at)
                        raw = f.read(i * size - at + size + more)
                        starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                        a, z = np.searchsorted(starts, [i * size - at, i * size - at + size])
                        edge = [*starts, len(raw)]
                        # The last character may be cut; it counts only at the file's end.
                        whole = len(starts) if at + len(raw) >= f.size() else max(z, len(starts) - 1)
                        tail = raw[edge[z] : edge[whole]].decode("utf-8", "replace")
                        if tail.strip() or at + len(raw) >= f.size():
                            break
                        more *= 4
                    left = max(0, a - halo)
                    right = z + max(halo, len(tail) - len(tail.lstrip()) + 1)
                    text = raw[edge[left] : edge[z]].decode("utf-8", "replace") + tail[: right - z]
                    rows.append((path, int(i), int(a - left), text, int(z - a), first))
                yield pd.DataFrame(rows, columns=["id", "range_no", "before", "part", "n_chars", "at"])

    spread = file_offsets(spark, path, size).select("range_no", "at").repartition(min(_ranges_of(path, size), parallelism(spark)))
    return spread.mapInPandas(read, "id string, range_no int, before int, part string, n_chars int, at bigint")


def useful_words(ends: np.ndarray, coarse: np.ndarray, half: int) -> np.ndarray:
    """Word ends at which a piece can end: not those with a coarser boundary so near before them that it goes first wherever the piece begins.

    A cut falls on word end w only if the piece's limit lies before the next word end; a coarser boundary within `half` characters (half the
    limit) before that next end is then in the upper half of the piece, and preferred.
    """
    if not len(ends) or not len(coarse):
        return ends
    i = np.searchsorted(coarse, ends, "right") - 1
    near = np.where(i >= 0, coarse[i], -1)
    onward = np.append(ends[1:], np.iinfo(np.int64).max)  # the next word end is unknown for the range's last
    return ends[(near < 0) | (near < onward - half)]


def boundaries(parts: DataFrame, id_type: str, limit: int = LIMIT) -> DataFrame:
    """id, range_no, n_chars, at, and per level in the range: first start, last end, longest segment between, and cut offsets, counted from the start of the text."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                coarse = np.array([], dtype=np.int64)
                for level in LEVELS:
                    s = spans(r.part, level) - r.before
                    s = s[(s[:, 0] >= 0) & (s[:, 0] < r.n_chars)]  # those that start here; the halos only show them whole
                    if len(s):
                        # A boundary inside another's white space, seen without what came before it, ends no earlier for that.
                        ends = np.maximum.accumulate(s[:, 1])
                        cut = np.unique(ends) if level != "word" else useful_words(np.unique(ends), coarse, limit * CHARS // 2)
                        coarse = np.union1d(coarse, cut)
                        rows.append((r.id, r.range_no, r.n_chars, r.at, level, s[0, 0] + r.at, ends[-1] + r.at, int((s[1:, 0] - ends[:-1]).max(initial=0)), cut + r.at))
                rows.append((r.id, r.range_no, r.n_chars, r.at, "length", None, None, 0, None))
            yield pd.DataFrame(rows, columns=["id", "range_no", "n_chars", "at", "level", "first", "last", "longest", "cuts"])

    return parts.repartition(parallelism(parts.sparkSession), "id", "range_no").mapInPandas(search, f"id {id_type}, range_no int, n_chars bigint, at bigint, level string, first bigint, last bigint, longest bigint, cuts array<bigint>")


def finest_needed(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT) -> DataFrame:
    """id, boundary: for each text above the limit the first of LEVELS whose segments all keep it, else none."""
    big = df.where(tokens(F.col(text_col)) > limit).select(id_col, text_col)
    b = boundaries(ranges(big, id_col, text_col), dict(df.dtypes)[id_col], limit).drop("cuts")
    w = Window.partitionBy("id", "level").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("gap", F.col("first") - F.coalesce(F.max("last").over(w), F.lit(0)))
    per = b.groupBy("id", "level").agg(F.max(F.greatest("longest", F.coalesce("gap", F.lit(0)))).alias("inner"), F.max("last").alias("last"), F.sum("n_chars").alias("n"))
    # A level's last segment reaches from its last boundary to the end of the text, which the rows "length" give.
    total = F.max(F.expr("case when level = 'length' then n end"))
    kept = lambda level: F.max(F.expr(f"case when level = '{level}' then inner end"))
    end = lambda level: F.max(F.expr(f"case when level = '{level}' then last end"))
    wide = per.groupBy("id").agg(total.alias("n"), *[kept(x).alias(f"i_{x}") for x in LEVELS], *[end(x).alias(f"e_{x}") for x in LEVELS])
    most = lambda x: F.greatest(F.coalesce(f"i_{x}", F.lit(0)), F.col("n") - F.coalesce(f"e_{x}", F.lit(0)))
    choice = F.lit("none")
    for x in reversed(LEVELS):
        choice = F.when(most(x) <= limit * CHARS, x).otherwise(choice)
    return wide.select(F.col("id").alias(id_col), choice.alias("boundary"))


def _next_cut(by_level: list[np.ndarray], s: int, limit: int, overlap: int) -> tuple[int, str]:
    """End and boundary of the piece that begins at s: the coarsest boundary in the upper half of what fits, or anywhere in it."""
    for low in (s + limit // 2, s + overlap + 1):
        for level, cuts in zip(LEVELS, by_level):
            i = np.searchsorted(cuts, s + limit, "right") - 1
            if i >= 0 and cuts[i] >= low:
                return int(cuts[i]), level
    return s + limit, "none"


def cut_offsets(by_level: list[np.ndarray], n: int, limit: int = LIMIT * CHARS, overlap: int = OVERLAP * CHARS) -> list[tuple[int, int, str]]:
    """(start, end, boundary) of the pieces of a text of n characters."""
    out, s = [], 0
    while n - s > limit:
        end, how = _next_cut(by_level, s, limit, overlap)
        out.append((s, end, how))
        s = end - overlap
    return [*out, (s, n, "end")]


def chosen(b: DataFrame, id_type: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """id, piece_no, start, end, boundary: cut_offsets() of the stitched boundary tables, read range by range.

    The ranges of a text come in order, and only where its next piece begins, and the offsets from there on, go from one to
    the next; so a text of any length needs the memory of a range and a batch.
    """
    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, no, s, n = None, 0, 0, 0
        held = {x: np.array([], dtype=np.int64) for x in LEVELS}
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                if r.id != here:
                    if here is not None:
                        out.append((here, no, s, n, "end"))
                    here, no, s = r.id, 0, 0
                    held = {x: np.array([], dtype=np.int64) for x in LEVELS}
                if r.level != "length":
                    held[r.level] = np.concatenate([held[r.level], r.cuts])
                    continue
                n = r.at + r.n_chars
                by = list(held.values())
                while n - s > limit * CHARS:  # every boundary up to n is known
                    end, how = _next_cut(by, s, limit * CHARS, overlap * CHARS)
                    out.append((here, no, s, end, how))
                    no, s = no + 1, end - overlap * CHARS
                held = {x: c[np.searchsorted(c, s) :] for x, c in held.items()}
            yield pd.DataFrame(out, columns=["id", "piece_no", "start", "end", "boundary"])
        if here is not None:
            yield pd.DataFrame([(here, no, s, n, "end")], columns=["id", "piece_no", "start", "end", "boundary"])

    rows = b.where("id is not null").select("id", "range_no", "n_chars", "at", "level", "cuts").repartition(parallelism(b.sparkSession), "id").sortWithinPartitions("id", "range_no", F.col("level") == "length")
    return rows.mapInPandas(choose, f"id {id_type}, piece_no int, start bigint, end bigint, boundary string")


def cuts(b: DataFrame, id_type: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """id, pieces (start, end, boundary in order): chosen() for texts that are columns, a row each."""
    pieces = F.array_sort(F.collect_list(F.struct("piece_no", "start", "end", "boundary")))
    return chosen(b, id_type, limit, overlap).groupBy("id").agg(F.transform(pieces, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["boundary"].alias("boundary"))).alias("pieces"))


def split(df: DataFrame, id_col: str, text_col: str, keep: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """id, keep..., piece_no, piece_start, boundary, piece_tokens, piece: every text in pieces of at most `limit` tokens."""
    src = df.where(F.col(text_col).isNotNull()).select(id_col, *keep, text_col)
    over = tokens(F.col(text_col)) > limit
    id_type = dict(df.dtypes)[id_col]
    found = cuts(boundaries(ranges(src.where(over), id_col, text_col), id_type, limit), id_type, limit, overlap)
    small = src.where(~over).select(id_col, *keep, F.lit(0).alias("piece_no"), F.lit(0).cast("bigint").alias("piece_start"), F.lit("whole").alias("boundary"), tokens(F.col(text_col)).alias("piece_tokens"), F.col(text_col).alias("piece"))
    big = src.where(over).join(found.withColumnRenamed("id", id_col), id_col)
    texts = F.transform("pieces", lambda p: F.struct(p["start"].alias("piece_start"), p["boundary"].alias("boundary"), F.substring(F.col(text_col), (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")).alias("piece")))
    big = big.select(id_col, *keep, F.posexplode(texts).alias("piece_no", "p")).select(id_col, *keep, "piece_no", "p.piece_start", "p.boundary", tokens(F.col("p.piece")).alias("piece_tokens"), "p.piece")
    return small.unionByName(big)


def split_file(spark: SparkSession, path: str, limit: int = LIMIT, overlap: int = OVERLAP, size: int = RANGE, halo: int = HALO) -> DataFrame:
    """piece_no, piece_start, boundary, piece of one file: no worker reads more than a range and a piece of it at a time.

    The prefix sums of the ranges' lengths say in which range a piece begins; its worker seeks there and reads on to its end.
    """
    pieces = chosen(boundaries(file_ranges(spark, path, size, halo), "string", limit), "string", limit, overlap).drop("id")
    at = file_offsets(spark, path, size)
    # A range holds at most `size` characters, so it lies in at most two of the equally long buckets that pieces are looked up by.
    at = at.select("*", F.explode(F.expr(f"sequence(at div {size}, (at + greatest(n_chars, 1) - 1) div {size})")).alias("bucket"))
    placed = pieces.withColumn("bucket", F.expr(f"start div {size}")).join(at, "bucket").where("start >= at and start < at + n_chars").select("piece_no", "start", "end", "boundary", "range_no", (F.col("start") - F.col("at")).alias("skip"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with opened(path) as f:
            for b in batches:
                rows = []
                for r in b.itertuples(index=False):
                    f.seek(int(r.range_no) * size)
                    raw = f.read(4 * int(r.skip + r.end - r.start + 2))
                    lead = int(np.argmax((np.frombuffer(raw[:4], np.uint8) & 0xC0) != 0x80)) if raw else 0
                    text = raw[lead:].decode("utf-8", "ignore")[r.skip : r.skip + r.end - r.start]
                    rows.append((r.piece_no, r.start, r.boundary, text))
                yield pd.DataFrame(rows, columns=["piece_no", "piece_start", "boundary", "piece"])

    return placed.repartition(parallelism(spark), "range_no").mapInPandas(read, "piece_no int, piece_start bigint, boundary string, piece string")

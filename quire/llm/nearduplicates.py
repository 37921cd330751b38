"""Problem 7: records that share most of their content, in a collection too large to compare in pairs.

An item is a multiset (a text's words) or a set (a file's facts); its elements are hashed, equal elements numbered, so both are
sets of 64-bit values and similarity is that of Jaccard. The pivot distance table holds, for each item, its Hamming distances to
reference items: the number of elements that one of the two has and the other has not. The references are items of the
collection, drawn by a hash of their ids, for texts as many from each octave of length; an item near one of them is far from
most others in that coordinate. Two items of similarity t and sizes n and m differ by at most (n + m)(1 - t)/(1 + t) elements, and so
in each coordinate: a pair with a larger difference in any is discarded for certain. What survives meets the same bound with its
own fingerprints (parity of the elements in BITS positions), and then is verified on the full contents, so no reported pair is wrong.

Distances alone give no keys to join on, so the pairs put to
the table come from equality joins: texts that share one of BANDS hashes of ROWS minima over their words (a pair of similarity 0.8
is missed with probability (1 - 0.8^ROWS)^BANDS = 0.7 %, one of 0.9 with 3e-8), and files that share one of their rarest
facts, which loses nothing: of two files above the threshold, the rarest 1 - t of the one always meets that of the other. The join
itself discards by the first coordinates, and a key of many items is met in blocks (meeting()).

Exact copies are one class, represented by their smallest id; only representatives are compared, so a third of the rows being
copies of one text costs one comparison; expand() lists the pairs of all members. Items without elements (null, empty, no letters or digits) are similar to none.
Repeated rows of a file's fact count once. Very long texts are hashed word by word and verified one pair at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut, hinted, parallelism

BITS, BANDS, ROWS, SEED = 1024, 34, 9, 7
#: References for texts (of REFERENCE_CHARS characters at most, so that all of them are small) and for files (of REFERENCE_PARTS parts
#: at most), and how many coordinates go into the join.
PIVOTS, FILE_PIVOTS, INSIDE, REFERENCE_CHARS, REFERENCE_PARTS = 64, 16, 8, 65_536, 2_000
#: Keys (of 16 bytes each with their counts) that may be broadcast to their rows.
SHARED_ROWS = 200_000
#: Items of one key, or members of one class, that are paired in one block.
BLOCK = 1000
WORDS = re.compile(r"[^\W_]+")
_MASK = (1 << 64) - 1


def words(text: str) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return WORDS.findall(text.lower())


class Hashes:
    """64-bit values of a text's words; the second and later occurrence of a word are elements of their own."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        out, known = [], self.known
        if len(known) > 500_000:
            known.clear()
        for w, c in Counter(words(text)).items():
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
            out += [(h + k * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93 & _MASK for k in range(1, c)]
        return np.array(out, dtype=np.uint64)


def fingerprint(h: np.ndarray) -> np.ndarray:
    """BITS bits, each the parity of the elements that hash to it."""
    odd = np.bincount((h >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def drawn(df: DataFrame, kind: Column, most: int) -> list:
    """Ids of at most `most` rows of df (id), as many of each kind as there are, drawn by the hash of the id."""
    h = F.xxhash64(F.lit(SEED), "id")
    found = df.where("id is not null").select("id", kind.alias("kind"), h.alias("h")).groupBy("kind", F.pmod("h", F.lit(most)).alias("slot")).agg(F.min(F.struct("h", "id")).alias("m")).select("kind", "m.h", "m.id").orderBy("h").collect()
    kinds = sorted({r["kind"] for r in found})
    each = max(1, most // max(1, len(kinds)))
    return [r["id"] for k in kinds for r in [x for x in found if x["kind"] == k][:each]][:most]


class References:
    """Hamming distances to reference sets, looked up element by element."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(x) for x in sets] + [0] * (PIVOTS - len(sets)), np.int64)
        self.elements, inverse = np.unique(np.concatenate(sets) if sets else np.array([], np.uint64), return_inverse=True)
        # For each element a byte for each reference, 1 where it has the element, eight to a number; the last row is for elements of none.
        lanes = np.zeros((len(self.elements) + 1, PIVOTS), np.uint8)
        at = 0
        for k, x in enumerate(sets):
            lanes[inverse[at : at + len(x)], k] = 1
            at += len(x)
        self.lanes = lanes.view(np.uint64)

    def distances(self, sets: list[np.ndarray], block: int = 100_000) -> np.ndarray:
        """(sets, references); sets must not be empty."""
        n = np.array([len(h) for h in sets], np.int64)
        out = n[:, None] + self.size
        if not len(self.elements):
            return out
        a = 0
        while a < len(sets):
            # As many sets at once as have `block` elements, or one larger set.
            z = a + max(1, int(np.searchsorted(np.cumsum(n[a:]), block, "right")))
            h = np.concatenate(sets[a:z])
            at = np.minimum(np.searchsorted(self.elements, h), len(self.elements) - 1)
            at[self.elements[at] != h] = len(self.elements)
            # Bytes count to 255, so a set is added up in pieces of so many elements, and then its pieces.
            pieces = -(-n[a:z] // 255)
            first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
            begin = np.concatenate([[0], np.cumsum(n[a:z])[:-1]])
            starts = np.repeat(begin, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
            some = np.add.reduceat(self.lanes[at], starts, axis=0).view(np.uint8).reshape(-1, PIVOTS)
            out[a:z] -= 2 * np.add.reduceat(some, first, axis=0, dtype=np.int64)
            a = z
        return out


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED + 1)
    return r.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1), r.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """(texts, BANDS) of minima (texts, BANDS * ROWS): one 64-bit hash of each band's minima and its number."""
    r = np.random.default_rng(SEED + 2)
    odd, salt = r.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 2**63, BANDS, dtype=np.uint64)
    x = (least.reshape(-1, BANDS, ROWS).astype(np.uint64) * odd).sum(axis=2, dtype=np.uint64) ^ salt
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def most_apart(n: Column, m: Column, threshold: float) -> Column:
    """The most elements by which two items of these sizes can differ and still be similar."""
    return (n + m) * ((1 - threshold) / (1 + threshold)) + 1e-9


def far_apart(a: str, b: str, threshold: float, coordinates: int) -> Column:
    """True where the packed coordinates (d0.., four to a number) or the sizes (n) of sides a and b rule a similarity of `threshold` out."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    at = lambda s, i: F.shiftright(F.col(f"{s}.d{i // 4}"), 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF))
    gaps = [F.abs(at(a, i) - at(b, i)) for i in range(coordinates)]
    return (F.greatest(*gaps) > most_apart(n, m, threshold)) | (F.least(n, m) < F.greatest(n, m) * threshold - 1e-9)


def meeting(rows: DataFrame, key: str, apart: Column) -> DataFrame:
    """id_a < id_b: the pairs of rows (key, id and more; a and b in `apart`) that share a key and are not apart.

    Keys of one row go first. The rows of a key that more than BLOCK share are dealt to blocks, and each block meets each in a key of its own.
    """
    shared = cut(rows.groupBy(key).agg(F.count("*").alias("c")).where("c > 1"))
    r = rows.join(hinted(shared, SHARED_ROWS), key).withColumn("blocks", F.ceil(F.col("c") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("c")
    a = r.withColumn("i", F.col("own")).withColumn("j", F.explode(F.expr("sequence(own, blocks - 1)"))).alias("a")
    b = r.withColumn("j", F.col("own")).withColumn("i", F.explode(F.expr("sequence(0L, own)"))).alias("b")
    one = (F.col("a.i") < F.col("a.j")) | (F.col("a.id") < F.col("b.id"))
    met = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j")) & one & (F.col("a.id") != F.col("b.id")) & ~apart)
    return met.select(F.least("a.id", "b.id").alias("id_a"), F.greatest("a.id", "b.id").alias("id_b")).distinct()


def text_signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, content (an order-free hash), n (words), d0.. (the coordinates for the join, four to a number), distances (all), bands, bits (the fingerprint): one row per text with words."""
    id_type = dict(df.dtypes)[id_col]
    packed, inside = INSIDE // 4, [k * PIVOTS // INSIDE for k in range(INSIDE)]
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    short = src.where(F.length("text").between(1, REFERENCE_CHARS))
    names = drawn(short, F.floor(F.log2(F.length("text"))), PIVOTS)
    texts = {r["id"]: r["text"] for r in short.where(F.col("id").isin(names)).collect()} if names else {}
    references = References([np.unique(Hashes().of(texts[i])) for i in names if i in texts])

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = (x.astype(np.uint32) for x in _permutations())
        hashes = Hashes()
        for batch in batches:
            rows = []
            some = [(i, h) for i, t in zip(batch["id"], batch["text"]) if t and len(h := hashes.of(t))]
            far = np.minimum(references.distances([h for _, h in some]), 0x7FFF) if some else ()  # a clipped difference is no larger than the true one
            packs = [sum(far[:, inside[4 * j + k]] << (16 * k) for k in range(4)) for j in range(packed)] if some else ()
            minima = np.full((len(some), len(a)), 0xFFFFFFFF, np.uint32)
            for x, (_, h) in enumerate(some):
                low = (h >> np.uint64(7)).astype(np.uint32)
                for s in range(0, len(low), 256):
                    np.minimum(minima[x], (low[s : s + 256, None] * a + b).min(axis=0), out=minima[x])
            bands = band_keys(minima)
            for x, (i, h) in enumerate(some):
                total = int(np.bitwise_xor.reduce(h * np.uint64(0x9E3779B97F4A7C15))) ^ (int(h.sum(dtype=np.uint64)) * 31 & _MASK)
                rows.append((i, total - (1 << 63), len(h), *[int(d[x]) for d in packs], far[x].astype(np.int16), bands[x], fingerprint(h).view(np.int64)))
            yield pd.DataFrame(rows, columns=["id", "content", "n", *[f"d{j}" for j in range(packed)], "distances", "bands", "bits"])

    return src.repartition(parallelism(df.sparkSession)).mapInPandas(sign, f"id {id_type}, content bigint, n int, {', '.join(f'd{j} bigint' for j in range(packed))}, distances array<smallint>, bands array<bigint>, bits array<bigint>")


def similar_texts(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(rep_a, rep_b) of similar classes, and the members (id, rep, copies): similarity counts words with repetition."""
    sig = cut(text_signatures(df, id_col, text_col))
    classes = sig.groupBy("content", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    members = sig.select("id", "content", "n").join(classes, ["content", "n"]).select("id", "rep", "copies")
    reps = sig.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    keys = reps.select("id", "n", *[f"d{j}" for j in range(INSIDE // 4)], F.explode("bands").alias("key"))
    pairs = meeting(keys, "key", far_apart("a", "b", threshold, INSIDE)).withColumnsRenamed({"id_a": "rep_a", "id_b": "rep_b"})
    whole = sig.select("id", F.struct("n", "distances", "bits").alias("s"))
    pairs = pairs.join(whole.withColumnsRenamed({"id": "rep_a", "s": "a"}), "rep_a").join(whole.withColumnsRenamed({"id": "rep_b", "s": "b"}), "rep_b")
    most = most_apart(F.col("a.n"), F.col("b.n"), threshold)
    widest = F.array_max(F.zip_with("a.distances", "b.distances", lambda x, y: F.abs(x - y)))
    apart = F.aggregate(F.zip_with("a.bits", "b.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    pairs = cut(pairs.where((widest <= most) & (apart <= most)).select("rep_a", "rep_b"))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    both = pairs.join(texts.withColumnsRenamed({"id": "rep_a", "text": "text_a"}), "rep_a").join(texts.withColumnsRenamed({"id": "rep_b", "text": "text_b"}), "rep_b")
    id_type = dict(df.dtypes)[id_col]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            keep = []
            for x, y in zip(p["text_a"], p["text_b"]):
                x, y = Counter(words(x)), Counter(words(y))
                shared = sum((x & y).values())
                keep.append(shared >= threshold * (x.total() + y.total() - shared) - 1e-9)
            yield p.loc[keep, ["rep_a", "rep_b"]]

    return both.mapInPandas(verify, f"rep_a {id_type}, rep_b {id_type}"), members


def similar_sets(df: DataFrame, id_col: str, parts: list[str], threshold: float, least: int) -> tuple[DataFrame, DataFrame]:
    """(rep_a, rep_b) of similar classes, and the members (id, rep, copies): items with at least `least` distinct parts that share the threshold of their union."""
    item = F.col(id_col)
    rows = df.where(item.isNotNull()).select(item.alias("id"), F.xxhash64(*[F.coalesce(F.col(c), F.lit("\x00")) for c in parts], F.concat(*[F.col(c).isNull().cast("string") for c in parts])).alias("h")).distinct()
    rows = cut(rows)
    size = cut(rows.groupBy("id").agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.bit_xor(F.xxhash64("h")).alias("y")).where(F.col("n") >= least))
    # Items of the same parts are one class; its smallest id stands for all.
    classes = size.groupBy("n", "x", "y").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    members = size.join(classes, ["n", "x", "y"]).select("id", "rep", "copies")
    rows = rows.join(hinted(cut(classes.select(F.col("rep").alias("id"), "n"))), "id")
    # The pivot table by sums over the shared parts: each part knows the references that have it.
    few = classes.where(F.col("n") <= REFERENCE_PARTS).select(F.col("rep").alias("id"))
    names = drawn(few, F.lit(0), FILE_PIVOTS)
    number = df.sparkSession.createDataFrame([(i, k) for k, i in enumerate(names)], f"id {dict(df.dtypes)[id_col]}, k int")
    owned = rows.join(F.broadcast(number), "id")  # FILE_PIVOTS rows
    masks = owned.groupBy("h").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("mask"))
    sizes = {r["k"]: r["n"] for r in owned.groupBy("k").agg(F.count("*").alias("n")).collect()}
    have = [F.sum(F.shiftright(F.coalesce("mask", F.lit(0)), k).bitwiseAND(F.lit(1))).alias(f"s{k}") for k in range(FILE_PIVOTS)]
    dist = rows.join(hinted(cut(masks), FILE_PIVOTS * REFERENCE_PARTS), "h", "left").groupBy("id", "n").agg(*have)
    coordinate = lambda k: F.least(F.col("n") + F.lit(sizes.get(k, 0)) - 2 * F.col(f"s{k}"), F.lit(0x7FFF)).cast("bigint")
    dist = cut(dist.select("id", "n", *[sum((F.shiftleft(coordinate(4 * j + k), 16 * k) for k in range(1, 4)), coordinate(4 * j)).alias(f"d{j}") for j in range(FILE_PIVOTS // 4)]))
    # The rarest parts of each item, enough that two similar items must share one. Parts of equal rarity come in whole, so a file
    # of any size is cut by counts per rarity and never sorted.
    seen = rows.groupBy("h").agg(F.count("*").alias("df"))
    rarity = rows.join(seen, "h")
    upto = rarity.groupBy("id", "n", "df").agg(F.count("*").alias("c"))
    upto = upto.withColumn("before", F.sum("c").over(Window.partitionBy("id").orderBy("df")) - F.col("c"))
    levels = upto.where((F.col("before") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9)) & (F.col("df") > 1)).select("id", "df")
    prefix = rarity.join(levels, ["id", "df"], "left_semi").select("id", "h")
    near = cut(meeting(prefix.join(hinted(dist), "id"), "h", far_apart("a", "b", threshold, FILE_PIVOTS)))
    size = dist.select("id", "n")
    near = near.join(hinted(size).withColumnsRenamed({"id": "id_a", "n": "n_a"}), "id_a").join(hinted(size).withColumnsRenamed({"id": "id_b", "n": "n_b"}), "id_b")
    left = near.join(rows.select(F.col("id").alias("id_a"), "h"), "id_a")
    shared = left.join(rows.select(F.col("id").alias("id_b"), "h"), ["id_b", "h"]).groupBy("id_a", "id_b", "n_a", "n_b").agg(F.count("*").alias("c"))
    return shared.where(F.col("c") >= threshold * (F.col("n_a") + F.col("n_b") - F.col("c")) - 1e-9).select(F.col("id_a").alias("rep_a"), F.col("id_b").alias("rep_b")), members


def expand(pairs: DataFrame, members: DataFrame, block: int = BLOCK) -> DataFrame:
    """id_a, id_b: all pairs of members, of similar classes and of each class with itself, whatever its size.

    Members are dealt to blocks of about `block`, and each block meets each block of the other class in a key of its own, so
    a class that holds a third of all rows is no single task.
    """
    m = members.select("id", "rep", F.pmod(F.xxhash64("id"), F.ceil(F.col("copies") / block)).alias("block"), "copies").distinct()
    m = cut(m)
    sizes = m.where("id = rep").select("rep", F.ceil(F.col("copies") / block).alias("blocks"), "copies")
    both = pairs.join(sizes.select(F.col("rep").alias("rep_a"), F.col("blocks").alias("n_a")), "rep_a").join(sizes.select(F.col("rep").alias("rep_b"), F.col("blocks").alias("n_b")), "rep_b").select("rep_a", "rep_b", "n_a", "n_b")
    both = both.unionByName(sizes.where("copies > 1").select(F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b"), F.col("blocks").alias("n_a"), F.col("blocks").alias("n_b")))
    both = both.withColumn("i", F.explode(F.expr("sequence(0L, n_a - 1)"))).withColumn("j", F.explode(F.expr("sequence(0L, n_b - 1)"))).where("rep_a <> rep_b or i <= j")
    a, b = m.select(F.col("id").alias("x"), F.col("rep").alias("rep_a"), F.col("block").alias("i")), m.select(F.col("id").alias("y"), F.col("rep").alias("rep_b"), F.col("block").alias("j"))
    met = both.join(a, ["rep_a", "i"]).join(b, ["rep_b", "j"]).where("rep_a <> rep_b or i < j or x < y")
    return met.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def groups(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """id, group, links: each item's connected group (named by its smallest id) and its class's similar classes.

    Labels fall to the smallest of a class and its neighbours, and jump to their label's label, so rounds grow with the logarithm
    of a group's diameter; each round is cut from the one before.
    """
    links = cut(pairs.select(F.col("rep_a").alias("x"), F.col("rep_b").alias("y")).unionByName(pairs.select(F.col("rep_b").alias("x"), F.col("rep_a").alias("y"))).distinct())
    label = cut(links.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")))
    while True:
        low = links.join(label.select(F.col("x").alias("y"), F.col("label").alias("theirs")), "y").groupBy("x").agg(F.min("theirs").alias("theirs"))
        step = label.join(low, "x").select("x", "label", F.least("label", "theirs").alias("near"))
        jump = step.join(label.select(F.col("x").alias("near"), F.col("label").alias("far")), "near", "left").select("x", "label", F.least("near", F.coalesce("far", "near")).alias("new"))
        jump = cut(jump)
        label = jump.select("x", F.col("new").alias("label"))
        if not jump.where("label <> new").limit(1).count():
            break
    per = links.groupBy("x").agg(F.count("*").alias("links"))
    return members.join(label.join(per, "x").withColumnRenamed("x", "rep"), "rep", "left").select("id", F.coalesce("label", "rep").alias("group"), "copies", F.coalesce("links", F.lit(0)).alias("links"))

"""Problem 8: texts of varying length in containers of fixed capacity with little unused space.

Exact complements: the lengths at hand are kept as counts, with an index of the lengths that exist (single sums), the sums of
two, and through both the sums of three. The longest item opens a container; a single item, a pair or a triple whose sum is
exactly the gap closes it, as far as the counts hold; else the longest item that fits goes in and the search goes on with the
smaller gap (best fit). Items are dealt to shards of about SHARD items by a hash of their id, and each shard is packed
by itself: only lengths and ids come together, and a shard leaves its last containers partly empty, which is 1 in some thousands.

A text above the capacity is cut into full containers and one rest, which is packed like any other; others are never cut. Texts
of no tokens (null or empty) need no space: they are listed with container -1. Equal ids are packed as separate items.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut, parallelism

#: Items that a shard holds about, whatever the number of items.
SHARD = 20_000
#: Containers after which the index of pair sums is made anew; entries that have lapsed are noticed when used.
REFRESH = 200
#: Lapsed entries met in one search after which the index is made anew at once.
STALE = 8


class Complements:
    """Counts of lengths 1..capacity with the index of their pair sums."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.age = counts, REFRESH
        self.top = len(counts) - 1

    def _pair_sums(self) -> np.ndarray:
        if self.age >= REFRESH:
            have = (self.counts > 0).astype(np.float64)
            n = 2 * len(have)
            self.pairs, self.age = np.fft.irfft(np.fft.rfft(have, n) ** 2, n)[: len(have)] > 0.5, 0
        return self.pairs

    def pair(self, gap: int) -> tuple[int, ...]:
        """Two lengths at hand that sum to the gap, the longer one as long as possible."""
        c = self.counts
        long = np.arange(gap - 1, (gap - 1) // 2, -1)
        ok = (c[long] > 0) & (c[gap - long] > (long == gap - long))
        i = int(ok.argmax()) if len(ok) else 0
        return (int(long[i]), int(gap - long[i])) if len(ok) and ok[i] else ()

    def fill(self, gap: int) -> tuple[int, ...]:
        """One, two or three lengths at hand whose sum is exactly the gap."""
        if self.counts[gap]:
            return (gap,)
        if two := self.pair(gap):
            return two
        # Lengths only go, so the index has every pair sum that there is, and some that were used up since; where many of those are met, it is made anew.
        first = np.arange(gap - 2, 0, -1)
        missed = 0
        for a in first[(self.counts[first] > 0) & self._pair_sums()[gap - first]]:
            if missed == STALE and self.age:
                self.age = REFRESH
            if missed >= STALE and not self._pair_sums()[gap - a]:
                continue
            self.counts[a] -= 1
            two = self.pair(int(gap - a))
            self.counts[a] += 1
            if two:
                return (int(a), *two)
            missed += 1
        return ()

    def longest(self, upto: int) -> int:
        """The longest length at hand that fits, or 0."""
        have = np.flatnonzero(self.counts[1 : upto + 1])
        return int(have[-1]) + 1 if len(have) else 0

    def take(self, lengths: tuple[int, ...]) -> None:
        for x in lengths:
            self.counts[x] -= 1


def pack_lengths(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Containers of lengths (1..capacity), each a list."""
    index = Complements(np.bincount(lengths, minlength=capacity + 1))
    out, top = [], capacity
    while top := index.longest(top):
        index.take((top,))
        box, gap = [top], capacity - top
        while gap:
            got = index.fill(gap) or ((x,) if (x := index.longest(gap)) else ())
            if not got:
                break
            index.take(got)
            box += got
            gap -= sum(got)
        index.age += 1
        out.append(box)
    return out


def pack(items: DataFrame, id_col: str, size_col: str, specs: DataFrame, shard_items: int = SHARD) -> DataFrame:
    """spec_name, capacity, shard, container, id, start_token, n_tokens: where each text, or each part of an oversized one, went."""
    items = cut(items.select(F.col(id_col).alias("id"), F.coalesce(F.col(size_col), F.lit(0)).cast("bigint").alias("size")))
    shards = max(1, -(-items.count() // shard_items))
    id_type = dict(items.dtypes)["id"]
    # The specifications are a fixed list of a few rows, repeated for each item.
    known = [F.struct(F.lit(r["spec_name"]).alias("spec_name"), F.lit(int(r["capacity_tokens"])).cast("bigint").alias("capacity")) for r in specs.where("capacity_tokens > 0").orderBy("spec_name").collect()]

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "id"], ascending=False, kind="stable")
        capacity = int(rows["capacity"].iloc[0])
        size, ids = rows["size"].to_numpy(), rows["id"].to_numpy()
        whole, rest = np.divmod(size, capacity)
        cols: list[tuple] = []
        # Full parts of oversized texts, then the rests and the other texts by length.
        for i in np.flatnonzero(whole):
            cols += [(-1, i, p * capacity, capacity) for p in range(whole[i])]
        cols = [(n, *c[1:]) for n, c in enumerate(cols)]
        at = len(cols)
        stacks: dict[int, list[int]] = {}
        for i in np.flatnonzero(rest):
            stacks.setdefault(int(rest[i]), []).append(i)
        for box in pack_lengths(rest[rest > 0], capacity):
            for n in box:
                i = stacks[n].pop()
                cols.append((at, i, int(whole[i]) * capacity, n))
            at += 1
        cols += [(-1, i, 0, 0) for i in np.flatnonzero(size == 0)]
        out = pd.DataFrame(cols, columns=["container", "i", "start_token", "n_tokens"])
        out["id"] = ids[out.pop("i").to_numpy(dtype=np.int64)]
        out["spec_name"], out["shard"] = key
        out["capacity"] = capacity
        return out[["spec_name", "capacity", "shard", "container", "id", "start_token", "n_tokens"]]

    known = known or [F.struct(F.lit("").alias("spec_name"), F.lit(0).cast("bigint").alias("capacity"))]
    dealt = items.select("id", "size", F.explode(F.array(*known)).alias("s")).select("id", "size", "s.*").where("capacity > 0").withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    # A number of tasks of our own keeps few rows that take long from being put into few tasks.
    return dealt.repartition(parallelism(items.sparkSession), "spec_name", "shard").groupBy("spec_name", "shard").applyInPandas(
        pack_shard, f"spec_name string, capacity bigint, shard int, container bigint, id {id_type}, start_token bigint, n_tokens bigint")

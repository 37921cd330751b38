"""The best cards of a block of questions, from the worth of tokens that lies in the shared folder by packs of cards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs

#: Places whose greatest score is taken at once.
CHUNK = 64


class Held:
    """What one token is worth on the cards of a pack: by place, and on demand as an array of all places."""

    __slots__ = ("place", "value", "n", "most", "size", "_whole")

    def __init__(self, place: np.ndarray, value: np.ndarray, size: int):
        self.place, self.value, self.n, self.most, self.size, self._whole = place, value, len(place), float(value.max()), size, None

    @property
    def whole(self) -> np.ndarray:
        if self._whole is None:
            self._whole = np.zeros(self.size)
            self._whole[self.place] = self.value
        return self._whole


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The same rows, so many at once."""
    have: list[pa.RecordBatch] = []
    for b in batches:
        while sum(map(len, have)) + len(b) >= size:
            n = size - sum(map(len, have))
            yield pa.Table.from_batches([*have, b.slice(0, n)])
            have, b = [], b.slice(n)
        have.append(b)
    if sum(map(len, have)):
        yield pa.Table.from_batches(have)


def packs(folder: str, asked: set[str]) -> Iterator[tuple[int, int, dict[str, Held]]]:
    """Number, size and tokens (those asked for) of each pack in order."""
    where, path = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
    found = [x.path for x in where.get_file_info(fs.FileSelector(path)) if "pack=" in x.base_name]
    for p in sorted(found, key=lambda x: int(x.rpartition("=")[2])):
        files = [x.path for x in where.get_file_info(fs.FileSelector(p)) if x.path.endswith(".parquet")]
        t = pa.concat_tables(pq.ParquetFile(where.open_input_file(x)).read(["token", "held"]) for x in files)
        lists = t.column("held").combine_chunks()
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        place, value = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        size = -(-int(place.max() + 1) // CHUNK) * CHUNK
        yield int(p.rpartition("=")[2]), size, {w: Held(place[i:j], value[i:j], size) for w, i, j in zip(t.column("token").to_pylist(), [0, *ends[:-1]], ends, strict=True) if w in asked}


def scored(words: list[Held], total: np.ndarray, best: list[tuple[int, int]], pack: int, top: int) -> list[tuple[int, int]]:
    """The best (score in ten-thousandths below zero, card) of those given, from packs before, and of a pack, for one question. total is scratch.

    Only cards that can be among the best are rounded and ordered, as cards before win equal scores.
    """
    least = (-best[-1][0] if len(best) == top else 0) + 1
    if sum(w.most for w in words) * 1e4 + 0.6 < least:
        return best
    total[:] = 0
    for w in words:
        if w.n * 16 > len(total):
            total += w.whole
        else:
            total[w.place] += w.value
    least = (least - 0.6) / 1e4
    if len(best) < top < len(total) // CHUNK:  # so many runs of places have a card of at least that
        least = max(least, np.partition(total.reshape(-1, CHUNK).max(axis=1), -top)[-top] - 1e-4)
    at = np.flatnonzero(total >= least)
    rounded = np.floor(total[at] * 1e4 + 0.5)
    if len(at) > top:
        pick = np.argpartition(rounded * len(total) - at, -top)[-top:]
        at, rounded = at[pick], rounded[pick]
    return sorted([*best, *((-int(r), pack << 33 | int(x)) for r, x in zip(rounded, at, strict=True) if r > 0)])[:top]


def best_of(asking: pa.Table, folder: str, top: int) -> pa.Table:
    """question_id, card, score, rank for question_id, tokens."""
    words = asking.column("tokens").to_pylist()
    best: list[list[tuple[int, int]]] = [[] for _ in words]
    for pack, size, held in packs(folder, {w for x in words for w in x}):
        total = np.empty(size)
        for i, x in enumerate(words):
            if mine := [held[w] for w in x if w in held]:
                best[i] = scored(mine, total, best[i], pack, top)
    of = [i for i, x in enumerate(best) for _ in x]
    flat = [x for b in best for x in b]
    return pa.table({
        "question_id": asking.column("question_id").take(pa.array(of, pa.int64())),
        "card": pa.array([c for _, c in flat], pa.int64()),
        "score": pa.array([-r / 1e4 for r, _ in flat], pa.float64()),
        "rank": pa.array([k + 1 for b in best for k in range(len(b))], pa.int64()),
    })

"""Problem 10: personal information in free text, found by a character-level BiLSTM with a CRF and replaced by placeholders.

Every character of every text is read twice. First by a screen, a linear model over the character n-grams around each place, which
says where nothing personal can begin or go on; it was fitted to the network's own answers and is set SCREEN below even odds, far under
the least score that any of them has (see README). Then, around the places that remain, HALO characters to each side, by the
network: windows of WINDOW characters that overlap by OVERLAP give emissions, each character's taken from the window that shows most of
its surroundings; Viterbi decodes the joined emissions of a passage in overlapping stretches, which are reconciled where both see
no span. A passage at whose edge a span stands is read again with more around it. What is found is brought to
word boundaries and must have the least that makes its kind (digits in a number, an @ or its spelling in an address).

The weights are in pii_weights.npz and pii_screen.npz, fitted by train_pii.py. Null and empty texts contain nothing and stay as they
are. Repeated rows are read again. A string that stands several times in a text is reported once. Texts of any length are cut to windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.charmodel import KINDS, SIZE, TAGS, Model, encode
from quire.session import parallelism

WEIGHTS, SCREEN_WEIGHTS = Path(__file__).with_name("pii_weights.npz"), Path(__file__).with_name("pii_screen.npz")
WINDOW, OVERLAP, ROWS = 256, 64, 384
STRETCH, SEAM = 512, 128
#: The screen: entries of a table of n-grams (bits), characters that it sums before and after a place, log odds of no interest before the
#: sum, log odds from which the network reads on, characters read around such a place, and how near to their end a span asks for more.
BITS, BEFORE, AFTER, PRIOR, SCREEN, HALO, EDGE = 16, 24, 16, -3.0, -3.0, 64, 8
#: Empty places between texts, so that none sees another.
GAP = BEFORE + AFTER
# Titles that are no part of a name (a lone M. may be an initial).
TITLE = re.compile(r"(?:Mr|Ms|Mrs|Dr|Ato|W/ro|W/rt|Eng|Prof|Mme|Frau|Herrn?|Sra?|አቶ|ወ/ሮ|ዶ/ር|ኣይተ|ኢንጂነር)\.? ")
#: Characters whose emissions are held at a time.
HELD = 1_000_000
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}
LEAST = {"email": re.compile(r"\w ?(@|[\[(]at[\])]) ?\w"), "phone": re.compile(r"(\d\D*){7}"), "id_number": re.compile(r"(\d\D*){5}"), "address": re.compile(r"(?=.*\d).{8}", re.S), "name": re.compile(r"^(?!The )[^\W\d_][^\d\n@]+$")}


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    with np.load(path) as f:
        return Model(params={k: f[k] for k in f.files})


@lru_cache(maxsize=2)
def screen_tables(path: str) -> list[np.ndarray]:
    with np.load(path) as f:
        return [f[k].astype(np.float32) for k in ("three", "six", "shape")]


def _shapes() -> np.ndarray:
    """For each id: space, digit, capital, small letter, stop, other mark or Ethiopic letter."""
    out = np.full(SIZE, 4, np.uint32)
    for i in range(1, 96):
        c = chr(i + 31)
        out[i] = 1 if c == " " else 2 if c.isdigit() else 3 if c.isupper() else 4 if c.islower() else 5 if c in ".,;" else 6
    out[0], out[96], out[97:149] = 0, 5, 7
    return out


SHAPE = _shapes()


def features(ids: np.ndarray) -> list[np.ndarray]:
    """For each place, the table entries of the three and six characters that end there and of the shapes of eight."""
    def back(a: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros_like(a)
        out[k:] = a[:-k]
        return out

    x, m1, m2, down = ids.astype(np.uint32), np.uint32(2654435761), np.uint32(2246822519), np.uint32(32 - BITS)
    three = (x + np.uint32(SIZE) * back(x, 1) + np.uint32(SIZE * SIZE) * back(x, 2)) * m1
    six = (three ^ (back(three * m1, 3) + m2)) * m2
    s = SHAPE[ids]
    s |= back(s, 1) << np.uint32(3)
    s |= back(s, 2) << np.uint32(6)
    s = (s | (back(s, 4) << np.uint32(12))) * m1
    return [a >> down for a in (three, six, s)]


def windowed(a: np.ndarray, before: int, after: int) -> np.ndarray:
    """For each place i the sum over [i - before, i + after)."""
    c = np.concatenate([np.zeros(before + 1), np.cumsum(a, dtype=np.float64)])
    c = np.concatenate([c, np.full(after, c[-1])])
    return c[before + after :][: len(a)] - c[: len(a)]


def screen_scores(ids: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Log odds, by the screen, that a place belongs to something personal."""
    one = np.zeros(len(ids), np.float32)
    for f, t in zip(features(ids), tables):
        one += np.take(t, f)
    return windowed(one, BEFORE, AFTER) + PRIOR


def emissions(m: Model, parts: list[np.ndarray]) -> np.ndarray:
    """(characters of all parts, tags)."""
    step, wins = WINDOW - OVERLAP, []
    base = 0
    for x in parts:
        n = len(x)
        for s in range(0, max(1, n - OVERLAP), step):
            z = min(n, s + WINDOW)
            a = s if s == 0 else s + OVERLAP // 2
            wins.append((x[s:z], base + a, a - s, (z if z == n else z - OVERLAP // 2) - s))
        base += n
    out = np.zeros((base, len(TAGS)), np.float32)
    wins.sort(key=lambda w: len(w[0]))
    for i in range(0, len(wins), ROWS):
        part = wins[i : i + ROWS]
        x = np.zeros((len(part), len(part[-1][0])), np.int16)
        for k, w in enumerate(part):
            x[k, : len(w[0])] = w[0]
        e = m.emissions(x)[0]
        for k, (_, at, a, z) in enumerate(part):
            out[at : at + z - a] = e[a:z, k]
    return out


def viterbi(m: Model, e: np.ndarray, ends: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Tags of all characters of the parts that end at `ends`; heads and tails say whether a part begins or ends its text.

    Stretches of STRETCH characters, which overlap by SEAM, are decoded side by side. Two neighbours are joined at the character of
    their overlap, nearest its middle, that both hold for O, so no span is cut; only a span as long as the overlap could leave none,
    and then the middle is taken.
    """
    tags, trans = np.zeros(len(e), np.int8), m.p["trans"] + m.bad
    rows, a = [], 0
    for k, z in enumerate(ends.tolist()):
        for s in range(a, max(a + 1, z - SEAM), STRETCH - SEAM):
            if z > a:
                t = min(z, s + STRETCH)
                rows.append((s, t, s == a, s == a and heads[k], t == z and tails[k]))
        a = z
    got = {}
    order = sorted(range(len(rows)), key=lambda k: rows[k][1] - rows[k][0])
    for i in range(0, len(order), ROWS):
        part = order[i : i + ROWS]
        n, b = rows[part[-1]][1] - rows[part[-1]][0], len(part)
        x, size = np.zeros((n, len(TAGS), b), np.float32), np.zeros(b, int)
        for k, r in enumerate(part):
            size[k] = rows[r][1] - rows[r][0]
            x[: size[k], :, k] = e[rows[r][0] : rows[r][1]]
        first, last = (np.array([rows[r][c] for r in part]) for c in (3, 4))
        # x becomes the score of the best path to each tag; the way back is found from it afterwards.
        x[0] += np.where(first, (m.p["start"] + m.bad_start)[:, None], trans[0][:, None])
        for t in range(1, n):
            x[t] += (x[t - 1][:, None, :] + trans[:, :, None]).max(axis=0)
        path, cur, onward, end = np.zeros((n, b), np.int8), np.zeros(b, np.int64), np.ascontiguousarray(trans.T), last[:, None] * m.p["end"]
        for t in range(n - 1, -1, -1):
            cur = (x[t].T + np.where((size == t + 1)[:, None], end, onward[cur])).argmax(axis=1)
            path[t] = cur
        for k, r in enumerate(part):
            got[r] = path[: size[k], k]
    for r, (a, z, begins, *_) in enumerate(rows):
        mine, at = got.pop(r), a
        if not begins:
            both = np.flatnonzero((tags[a : a + SEAM] == 0) & (mine[:SEAM] == 0))
            at = a + (int(both[np.abs(both - SEAM // 2).argmin()]) if len(both) else SEAM // 2)
        tags[at:z] = mine[at - a :]
    return tags


def runs(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    d = np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def tagged(m: Model, ids: list[np.ndarray], tables: list[np.ndarray] | None) -> list[np.ndarray]:
    """Tags of the texts; without tables the network reads everything."""
    size = np.array([len(x) for x in ids], np.int64)
    ends = np.cumsum(size + GAP)
    starts = ends - size
    flat = np.zeros(int(ends[-1]) if len(ids) else 0, np.int16)
    for x, a in zip(ids, starts):
        flat[a : a + len(x)] = x
    tags = np.zeros(len(flat), np.int8)
    a = np.flatnonzero(flat > 0) if tables is None else np.flatnonzero((screen_scores(flat, tables) > SCREEN) & (flat > 0))
    halo = HALO
    while len(a):
        # Passages: the places with their surroundings, within their text.
        owner = np.searchsorted(ends, a, side="right")
        mark = np.zeros(len(flat) + 1, np.int32)
        np.add.at(mark, np.maximum(a - halo, starts[owner]), 1)
        np.add.at(mark, np.minimum(a + 1 + halo, ends[owner]), -1)
        s, z = runs(np.cumsum(mark[:-1]) > 0)
        owner = np.searchsorted(ends, s, side="right")
        heads, tails = s == starts[owner], z == ends[owner]
        got = viterbi(m, emissions(m, [flat[b:c] for b, c in zip(s, z)]), np.cumsum(z - s), heads, tails)
        again, at = [], 0
        for b, c, h, t in zip(s.tolist(), z.tolist(), heads, tails):
            tags[b:c] = mine = got[at : at + c - b]
            at += c - b
            if (not h and mine[:EDGE].any()) or (not t and mine[-EDGE:].any()):
                again.append(np.arange(b, c))
        a, halo = np.concatenate(again) if again else a[:0], halo * 4
    return [tags[a : a + n] for a, n in zip(starts, size)]


def bounded(text: str, a: int, z: int, kind: str) -> tuple[int, int] | None:
    """The span on word boundaries without marks around it, or None if it lacks what makes its kind."""
    letter = lambda c: c.isalnum() or c == "_"
    while a > 0 and letter(text[a]) and letter(text[a - 1]):
        a -= 1
    while z < len(text) and letter(text[z - 1]) and letter(text[z]):
        z += 1
    open_ = "+(" if kind == "phone" else ""
    while a < z and not (letter(text[a]) or text[a] in open_):
        a += 1
    while a < z and not letter(text[z - 1]):
        z -= 1
    if kind == "name" and (t := TITLE.match(text, a, z)):
        a = t.end()
    if kind == "name" and text[z - 2 : z] in ("'s", "’s"):
        z -= 2
    return (a, z) if z > a and LEAST[kind].search(text[a:z]) else None


def find(m: Model, texts: list[str], tables: list[np.ndarray] | None = None) -> list[list[tuple[int, int, str]]]:
    """Spans (start, end, kind) of each text, in order."""
    out = []
    for t, y in zip(texts, tagged(m, [encode(t) for t in texts], tables)):
        spans, k = [], 0
        hot = np.flatnonzero(y)
        while k < len(hot):
            a = int(hot[k])
            kind, z = (int(y[a]) - 1) // 2, a + 1
            while z < len(y) and y[z] == 2 * kind + 2:
                z += 1
            got = bounded(t, a, z, KINDS[kind])
            if got and (not spans or got[0] >= spans[-1][1]):
                spans.append((*got, KINDS[kind]))
            k = int(np.searchsorted(hot, z))
        out.append(spans)
    return out


def _each(batches: Iterator[pd.DataFrame], path: str | None) -> Iterator[tuple[pd.DataFrame, list[list[tuple[int, int, str]]]]]:
    # Where this worker has the package; the screen knows the answers of its own network only.
    m, tables = model(path or str(WEIGHTS)), None if path else screen_tables(str(SCREEN_WEIGHTS))
    for b in batches:
        at, size = 0, 0
        texts = [t or "" for t in b["text"]]
        for i, t in enumerate(texts):
            size += len(t)
            if size >= HELD or i == len(texts) - 1:
                yield b.iloc[at : i + 1], find(m, texts[at : i + 1], tables)
                at, size = i + 1, 0


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).repartition(parallelism(df.sparkSession))


def found(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """id, kind, found: each distinct string of personal information in each text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, spans in _each(batches, path):
            rows = sorted({(i, k, t[a:z]) for i, t, s in zip(b["id"], b["text"], spans) for a, z, k in s})
            yield pd.DataFrame(rows, columns=["id", "kind", "found"])

    return _texts(df.where(F.length(text_col) > 0), id_col, text_col).mapInPandas(run, f"id {dict(df.dtypes)[id_col]}, kind string, found string").withColumnRenamed("id", id_col)


def redacted(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """id, text with a typed placeholder for each span, otherwise unchanged; n_found."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, spans in _each(batches, path):
            rows = []
            for i, t, s in zip(b["id"], b["text"], spans):
                parts, at = [], 0
                for a, z, k in s:
                    parts += [t[at:a], PLACEHOLDER[k]]
                    at = z
                rows.append((i, None if t is None else "".join(parts) + t[at:], len(s)))
            yield pd.DataFrame(rows, columns=["id", "text", "n_found"])

    return _texts(df, id_col, text_col).mapInPandas(run, f"id {dict(df.dtypes)[id_col]}, text string, n_found int").withColumnsRenamed({"id": id_col, "text": text_col})

"""python -m quire.llm.train_pii DOCUMENTS.parquet OUT.npz SCREEN.npz: fits the model of personal information on a bounded sample of documents.

An existing OUT.npz is kept, and only the screen is fitted to it.

The labelled spans come from rules for contexts that leave no doubt (a title before a name, a label before a number), applied
to at most DOCUMENTS texts. They label the training sample only; the operator runs the model. In a part of the windows the names are
replaced by made-up ones, so the model learns contexts rather than a list of names.
"""

from __future__ import annotations

import re
import sys
import time
from pathlib import Path

import numpy as np

from quire.llm import pii
from quire.llm.charmodel import KINDS, SIZE, TAGS, Adam, Model, encode

DOCUMENTS, WINDOW, BATCH, STEPS, SEED = 8000, 160, 64, 2600, 11

_G = r"[A-ZÀ-Þ][a-zà-ÿ]+"
_SUR = rf"{_G}(?:-{_G})?"
_UP = r"[A-ZÀ-Þ]{4,}(?:-[A-ZÀ-Þ]{4,})?"
_FULL = rf"(?:{_UP} {_G}|(?:{_G}|[A-Z]\.) (?:[A-Z]\. )?(?:{_SUR}))"
_TITLE = r"(?:Mr\.?|Ms\.?|Mrs\.?|Dr\.?|Ato|W/ro|W/rt|Eng\.|Prof\.|Obbo|Aadde|Frau|Herrn?|Mme|M\.|Sra?\.|Sr\.)"
_ETH = r"[ሀ-፟]+"
EMAIL = re.compile(r"[A-Za-z0-9](?:[\w.+-]*\w)?(?: ?@ ?| ?[\[(]at[\])] ?)\w[\w-]*(?:(?:\.| ?[\[(]dot[\])] ?)\w[\w-]*)+", re.A)
PHONE = re.compile(r"(?<![\w/])(?:(?:\+|00)\d{2,3}[ .-]?(?:\d[ .-]?){8,11}|\(0\d{1,3}\) ?\d{3}[- ]?\d{4}|0\d{2}/\d{7}|011 \d{3} \d{4}|06\d{2}[ .-]?\d{3}[ .-]?\d{3})(?<=\d)(?: (?:ext\.|poste|Durchwahl) ?\d+)?(?!\w)")
NUMBER = r"(?:\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{3}[ -]\d{3}|E[PQ] ?\d{7}|[A-Z]{2}/\d{5}/\d{2}|\d{10,12})"
ID = re.compile(rf"(?:holder of [\w .:]*? |released to [\w .:]*? |Numéro d'identité : |Documento de identidad |Documento de identificação |Ausweisnummer |identifica\w+ |(?:ቁጥር|መንነት|ግብሪ|ፓስፖርት|lakkoofsa \w+) )({NUMBER})(?!\w)")
WITNESS = re.compile(rf"(?:1\)|2\)) ({_FULL}), ({NUMBER})")
TOWN = rf"{_G}(?: {_G})?"
ADDRESS = re.compile(rf"(?:(?:Block [A-Z]|House No\. ?\d+|H\.No ?[\d/]+), (?:\d+ {TOWN} (?:Street|Road|Avenue)|Kebele \d+, {TOWN} Sub-city|Woreda \d+), {TOWN}|\d+ {TOWN} (?:Street|Road|Avenue), (?:Flat \d+, )?{TOWN}|\d+, rue de {TOWN}, \d+ {TOWN}|(?:Calle|Rua|Rua de) {TOWN},? \d+, \d+ {TOWN}|[A-ZÄÖÜ]\w+straße \d+, \d+ {TOWN})")
NAMES = [re.compile(x) for x in (
    rf"(?:Prepared by: |checked by: |Contact person: |Present: |According to |The claimant, |The cashier |handed to |Préparé par |Elaborado por |Elaborado por |Geprüft durch |Preparado por |Revisto por )(?:{_TITLE} )?({_FULL})",
    rf"\b{_TITLE} ({_FULL}|{_SUR})(?= signed the|,|;|\.| later| répond| con |\n|:|'s| \()",
    rf"({_FULL})(?: signed the minutes|'s claim over)",
    rf"(?:signé par M\. |firmada por la Sra\. |firmada por el Sr\. |von Frau |von Herrn |Mme |assinada por \w+\.? |pela Sra\. |pelo Sr\. )({_FULL})",
    rf"({_UP} {_G})(?=[,;. ]|'s|$)",
    rf"(?:ያዘጋጀው|ዘዳለዎ)፦ ({_ETH} {_ETH})(?=።)", rf"(?:ወ/ሮ|ዶ/ር|አቶ|ኣይተ|ኢንጂነር|ወይዘሮ|ወ/ሪት) ({_ETH} {_ETH})",
)]
PRESENT = re.compile(rf"Present: ({_FULL}), ({_FULL}) and ({_FULL})")
LATER = re.compile(rf"{_TITLE} ({_SUR}) later")


def spans(text: str) -> list[tuple[int, int, str]]:
    """The labelled spans of a text: start, end, kind; earlier kinds win where they overlap."""
    found: list[tuple[int, int, str]] = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    found += [(*m.span(1), "id_number") for m in ID.finditer(text)] + [(*m.span(2), "id_number") for m in WITNESS.finditer(text)]
    found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text)]
    found += [(m.start(), m.end(), "address") for m in ADDRESS.finditer(text)]
    found += [(*m.span(1), "name") for m in WITNESS.finditer(text)] + [(*m.span(i), "name") for m in PRESENT.finditer(text) for i in (1, 2, 3)]
    found += [(*m.span(1), "name") for p in [*NAMES, LATER] for m in p.finditer(text) if not re.match(r"Dear\b", m.group(1))]
    out: list[tuple[int, int, str]] = []
    for a, z, k in found:
        if k == "name" and text[a:z].split()[0] in ("The", "In", "No", "Both", "A"):
            continue
        if all(z <= b or a >= y for b, y, _ in out):
            out.append((a, z, k))
    return sorted(out)


def tags(text: str, found: list[tuple[int, int, str]]) -> np.ndarray:
    y = np.zeros(len(text), np.int8)
    for a, z, k in found:
        i = TAGS.index("B-" + k)
        y[a], y[a + 1 : z] = i, i + 1
    return y


def made_up(r: np.random.Generator, like: str) -> str:
    """A name of the same shape with other letters."""
    heads, tails = "b d g k l m n r s t v z ch sh th w y h f j".split(), "a e i o u ai ee ia or an el in us".split()

    def word(w: str) -> str:
        if len(w) <= 2 or not w[0].isascii():
            return w
        x = "".join(r.choice(heads) + r.choice(tails) for _ in range(int(r.integers(2, 5)))).capitalize()
        return x.upper() if w.isupper() else x

    return re.sub(r"[^\W\d_]+", lambda m: word(m.group()), like)


def varied(text: str, found: list[tuple[int, int, str]], r: np.random.Generator) -> tuple[str, list[tuple[int, int, str]]]:
    parts, at, new = [], 0, []
    size = 0
    for a, z, k in found:
        s = made_up(r, text[a:z]) if k == "name" else text[a:z]
        parts += [text[at:a], s]
        size += a - at
        new.append((size, size + len(s), k))
        size += len(s)
        at = z
    return "".join(parts) + text[at:], new


def windows(texts: list[str], r: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for t in texts:
        found = spans(t)
        if found and r.random() < 0.35:
            t, found = varied(t, found, r)
        ids, tg = encode(t), tags(t, found)
        starts = [max(0, a - int(r.integers(0, WINDOW - 30))) for a, _, _ in found] + ([int(r.integers(0, max(1, len(t) - WINDOW)))] if t else [])
        for s in starts:
            # A window must not begin inside a span: the tags would be ones no decoder can give.
            while s > 0 and TAGS[tg[s]][0] == "I":
                s -= 1
            a, b = np.zeros(WINDOW, np.int16), np.zeros(WINDOW, np.int8)
            n = min(WINDOW, len(t) - s)
            if n <= 0:
                continue
            a[:n], b[:n] = ids[s : s + n], tg[s : s + n]
            x.append(a)
            y.append(b)
    return np.array(x), np.array(y)


def fit_screen(model: Model, texts: list[str], out: str, rounds: int = 15, block: int = 400_000) -> None:
    """Fits the screen of pii.py to the tags that the network gives the texts: logistic regression over sums of n-gram weights, by AdaGrad.

    Places near a span but outside it are left out. Prints the least score that a span of the sample reaches.
    """
    ids, tg = [], []
    for i in range(0, len(texts), 300):
        some = [encode(t) for t in texts[i : i + 300]]
        for x, y in zip(some, pii.tagged(model, some, None)):
            ids += [np.zeros(pii.GAP, np.int16), x]
            tg += [np.zeros(pii.GAP, np.int8), y]
    x, y = np.concatenate(ids), np.concatenate(tg)
    yes, n = (y > 0).astype(np.float32), 1 << pii.BITS
    care = (x > 0) & ((yes > 0) | (pii.windowed(yes, 20, 20) == 0))
    feats, r = pii.features(x), np.random.default_rng(SEED)
    tables, sums = [np.zeros(n, np.float32) for _ in feats], [np.full(n, 1e-3) for _ in feats]
    for k in range(rounds):
        for a in r.permutation(max(1, len(x) // block)) * block:
            at = slice(a, a + block)
            p = 1 / (1 + np.exp(-pii.screen_scores(x[at], tables)))
            error = (p - yes[at]) * care[at] * np.where(yes[at] > 0, 4.0, 1.0)
            # A place's error belongs to the n-grams that its sum takes in.
            d = pii.windowed(error, pii.AFTER - 1, pii.BEFORE + 1) * (1000 / block)
            for f, t, g in zip(feats, tables, sums):
                grad = np.bincount(f[at], weights=d, minlength=n)
                g += grad * grad
                t -= (0.03 * grad / np.sqrt(g)).astype(np.float32)
        score = pii.screen_scores(x, tables)
        a, z = pii.runs(yes > 0)
        print("screen", k, "least span", round(float(min(score[b:c].max() for b, c in zip(a, z))), 2), "read on", round(float((score[x > 0] > pii.SCREEN).mean()), 4), flush=True)
    np.savez_compressed(out, **{k: t.astype(np.float16) for k, t in zip(("three", "six", "shape"), tables)})


def train(texts: list[str], held: list[str], out: str) -> None:
    r = np.random.default_rng(SEED)
    model = Model(hidden=40, dim=20, seed=SEED)
    opt, t0 = Adam(model.p), time.time()
    step = 0
    while step < STEPS:
        x, y = windows([texts[i] for i in r.permutation(len(texts))[:2500]], r)
        order = r.permutation(len(x))
        for i in range(0, len(order) - BATCH + 1, BATCH):
            k = order[i : i + BATCH]
            opt.rate = 4e-3 * min(1.0, (step + 1) / 50) * (1.0 if step < 0.5 * STEPS else max(0.03, 2 * (1 - step / STEPS)))
            loss, g = model.gradients(x[k], y[k].astype(np.int64))
            opt.step(model.p, g)
            step += 1
            if step % 50 == 0:
                print(step, round(loss, 3), round(time.time() - t0), flush=True)
            if step % 300 == 0 or step == STEPS:
                np.savez_compressed(out, **{k: v.astype(np.float16) for k, v in model.p.items()})
            if step >= STEPS:
                break
    x, y = windows(held, r)
    got = np.concatenate([model.decode(x[i : i + 256]) for i in range(0, len(x), 256)])
    real = x > 0
    for j, k in enumerate(KINDS):
        a, b = np.isin(got, (2 * j + 1, 2 * j + 2)) & real, np.isin(y, (2 * j + 1, 2 * j + 2)) & real
        print(k, "characters: precision", (a & b).sum() / max(1, a.sum()), "recall", (a & b).sum() / max(1, b.sum()), flush=True)
    assert SIZE == len(model.p["emb"])


def main(path: str, out: str, screen: str) -> None:
    import pyarrow.parquet as pq

    t = pq.read_table(path, columns=["doc_id", "text"]).to_pandas().sort_values("doc_id")
    texts = [x for x in t["text"].head(DOCUMENTS) if x]
    held = [x for x in t["text"].tail(600) if x]
    if not Path(out).exists():
        train(texts, held, out)
    fit_screen(pii.model(out), texts, screen)


if __name__ == "__main__":
    main(*sys.argv[1:])

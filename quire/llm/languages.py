"""Problem 2: the languages of pages and of their segments, by compression.

A language is known by a zstandard dictionary of raw content: sentences of documents that carry its label. A sentence is
compressed with each dictionary (of its script) and belongs to the language that makes it smallest; where the runner-up comes within MARGIN
of it, the sentence gets no language. The confidence is the part by which the runner-up is larger, scaled so CERTAIN is 1.

The dictionaries are fitted on at most DOCUMENTS documents of each language, of FIT_CHARS characters at most and whole, drawn by the hashes
of their ids: the only texts that reach the driver, 20 MB at most.
Labels are sometimes wrong and documents mixed, so a sentence enters the dictionary of its document's label only if its words are
used by more of that label's documents than of any other's. Everything else covers all rows and whole texts.

Null and empty texts have no segments. A segment is a run of sentences of one language; sentences without a language (too narrow,
or no letters) stay with the segment before them. Repeated elements give repeated segments. A language without labelled documents
is never assigned. Texts of any length go sentence by sentence; a sentence is compared by its first SENTENCE characters' blocks in turn.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.lookalikes import canonical_text
from quire.session import parallelism

LANGUAGES = ("en", "am", "ti", "om", "fr", "es", "de", "pt")
ETHIOPIC = ("am", "ti")
# Codes and names by which a label states a language, lower case.
STATED = {
    "en": "en eng english anglais inglés englisch inglês እንግሊዝኛ",
    "am": "am amh amharic amharique amárico amharisch amarico አማርኛ",
    "ti": "ti tir tigrinya tigrigna tigriña ትግርኛ",
    "om": "om orm gaz oromo oromoo oromiffa oromiffaa ኦሮምኛ",
    "fr": "fr fra fre french français francais französisch francés francês",
    "es": "es spa spanish español espanol castellano espagnol spanisch espanhol",
    "de": "de deu ger german deutsch allemand alemán alemão",
    "pt": "pt por portuguese português portugues portugais portugués portugiesisch",
}
#: Documents of each language the dictionaries are fitted on, at most, and bytes of each dictionary.
DOCUMENTS, FIT_CHARS, DICTIONARY, LEVEL = 120, 20_000, 48_000, 12
MARGIN, CERTAIN, LEAST_WORDS = 0.04, 0.5, 4
SENTENCE = re.compile(r"[^.!?።\n]*(?:[.!?](?!\s|$)[^.!?።\n]*)*[.!?።]+|[^.!?።\n]+")
HYPHEN = re.compile(r"(?<=\w)-\n(?=\w)")
DIGITS = re.compile(r"[\d.,/%()]*\d[\d.,/%()]*")
ETH, LATIN = re.compile(r"[ሀ-፟ᎀ-ᎏⶀ-ⷞ]"), re.compile(r"[A-Za-zÀ-ɏ]")


def stated(label: Column) -> Column:
    """The languages that a label states, as an array of codes."""
    plain = F.lower(F.regexp_replace(label, r"\b([A-Za-z]{2,3})[-_][A-Z]{2}\b", "$1"))
    has = lambda names: plain.rlike(r"(^|[^\p{L}])(" + "|".join(names.split()) + r")([^\p{L}]|$)")
    return F.array_compact(F.array(*[F.when(F.coalesce(has(names), F.lit(False)), F.lit(code)) for code, names in STATED.items()]))


def sentences(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, ended) in a text with its lines joined; `ended` where a full stop, mark or ። closes it."""
    out = []
    for m in SENTENCE.finditer(text):
        s = m.group()
        if s.strip():
            out.append((m.start(), m.end(), s.rstrip()[-1] in ".!?።"))
    return out


def flat(text: str) -> str:
    """One form of characters, lines joined, words mended at line ends."""
    return HYPHEN.sub("", canonical_text(text)).replace("\n", " ")


def bare(sentence: str) -> str:
    """What tells languages apart: no numbers, single spaces, a leading space so words match at the start."""
    return " " + " ".join(DIGITS.sub(" ", sentence).split()).lower()


class Classifier:
    """Languages of sentences by the sizes that the dictionaries compress them to."""

    def __init__(self, texts: dict[str, str]):
        self.packers = {}
        for lang in LANGUAGES:
            raw = texts.get(lang, "").encode()[:DICTIONARY]
            if raw:
                d = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self.packers[lang] = zstd.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.known: dict[str, tuple[str | None, float]] = {}

    def __call__(self, sentence: str) -> tuple[str | None, float]:
        s = bare(sentence)
        got = self.known.get(s)
        if got is None:
            if len(self.known) > 300_000:
                self.known.clear()
            got = self.known[s] = self._best(s)
        return got

    def _best(self, s: str) -> tuple[str | None, float]:
        eth, lat = len(ETH.findall(s)), len(LATIN.findall(s))
        if not eth and not lat:
            return None, 0.0
        raw = s.encode()
        among = [x for x in self.packers if (x in ETHIOPIC) == (eth > lat)]
        if not among:
            return None, 0.0
        sizes = sorted((len(self.packers[x].compress(raw)), x) for x in among)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        gap = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        return (sizes[0][1], min(1.0, gap / CERTAIN)) if gap >= MARGIN else (None, gap)


def fit(docs: DataFrame, id_col: str, text_col: str, label_col: str, documents: int = DOCUMENTS) -> dict[str, str]:
    """The dictionaries' contents, by language, from labelled documents (see above)."""
    labelled = docs.where(F.length(text_col).between(1, FIT_CHARS)).select(F.col(id_col).alias("id"), F.get(stated(F.col(label_col)), F.lit(0)).alias("l"), F.size(stated(F.col(label_col))).alias("k")).where("k = 1")
    # One scan: the least hash in each of a fixed number of slots, and of those the least ones of each language.
    h = F.xxhash64("id")
    slots = labelled.groupBy("l", F.pmod(h, F.lit(8 * documents)).alias("slot")).agg(F.min(F.struct(h.alias("h"), "id")).alias("m")).select("l", "m.h", "m.id").collect()
    labels = {r["id"]: lang for lang in LANGUAGES for r in sorted((x for x in slots if x["l"] == lang), key=lambda x: x["h"])[:documents]}
    rows = [(labels[r["id"]], r["id"], flat(r["t"])) for r in docs.where(F.col(id_col).isin(list(labels)) & F.length(text_col).between(1, FIT_CHARS)).select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).collect()]
    rows.sort(key=lambda r: (r[0], str(r[1])))

    lists = [(lang, [bare(t[a:z]) for a, z, ended in sentences(t) if ended]) for lang, _, t in rows]
    own = _own_words(lists)
    out: dict[str, str] = {}
    for lang in LANGUAGES:
        # Each document gives in turn one sentence, so no long document fills a dictionary by itself.
        mine = [[x for x in xs if own(x) == lang] for k, xs in lists if k == lang]
        seen: dict[str, None] = {}
        for i in range(max(map(len, mine), default=0)):
            for x in mine:
                if i < len(x):
                    seen.setdefault(x[i])
        out[lang] = "".join(seen)
    return out


def _own_words(lists: list[tuple[str, list[str]]]):
    """The label whose documents use a sentence's words most: wrong labels and mixed documents are few, so words stay with their language."""
    uses: dict[str, Counter] = {x: Counter() for x in LANGUAGES}
    for lang, xs in lists:
        uses[lang].update({w for x in xs for w in x.split()})
    docs = Counter(lang for lang, _ in lists)

    def best(sentence: str) -> str:
        score = {x: sum(math.log((uses[x][w] + 0.05) / (docs[x] + 1)) for w in sentence.split()) for x in LANGUAGES if docs[x]}
        return max(score, key=score.get)

    return best


def segments(elements: DataFrame, keys: list[str], text_col: str, contents: dict[str, str]) -> DataFrame:
    """keys..., seg_no, language, confidence, n_sentences, full: the runs of one language in each text; `full` where it holds a full sentence."""
    schema = ", ".join(f"{k} {t}" for k, t in elements.select(*keys).dtypes) + ", seg_no int, language string, confidence double, n_sentences int, full boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = Classifier(contents)
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                t, found = flat(r[-1]), []
                for a, z, ended in sentences(t):
                    s = t[a:z]
                    lang, sure = classify(s)
                    full = ended and lang is not None and len(s.split()) >= LEAST_WORDS
                    if found and (lang is None or found[-1][0] == lang):
                        last = found[-1]
                        last[1].append(sure if lang else 0.0)
                        last[2] |= full
                    else:
                        found.append([lang, [sure], full])
                rows += [(*r[:-1], i, lang, sum(sure) / len(sure), len(sure), full) for i, (lang, sure, full) in enumerate(found)]
            yield pd.DataFrame(rows, columns=[*keys, "seg_no", "language", "confidence", "n_sentences", "full"])

    return elements.select(*keys, F.col(text_col).alias("__text")).where("__text is not null and __text <> ''").repartition(parallelism(elements.sparkSession)).mapInPandas(run, schema)


def pages(seg: DataFrame) -> DataFrame:
    """doc_id, page, language, confidence, n_sentences, full: each language of each page, by all its segments."""
    return seg.where("language is not null").groupBy("doc_id", "page", "language").agg(
        (F.sum(F.col("confidence") * F.col("n_sentences")) / F.sum("n_sentences")).alias("confidence"), F.sum("n_sentences").alias("n_sentences"), F.bool_or("full").alias("full"))


def unstated(profiles: DataFrame, by_page: DataFrame) -> DataFrame:
    """profile_id, language: languages with a full sentence on the page that the profile's label doesn't state."""
    p = profiles.select("profile_id", "doc_id", "page", stated(F.col("language")).alias("__stated"))
    return p.join(by_page.where("full").select("doc_id", "page", "language"), ["doc_id", "page"]).where(~F.array_contains("__stated", F.col("language"))).select("profile_id", "language").distinct()

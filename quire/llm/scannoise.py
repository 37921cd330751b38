"""Problem 6: text of scanned pages, repaired by a noisy channel.

Three steps. (1) Lines that are no prose go: page numbers by their form, running headers because they spell the title or issuer that
the document's name or its furniture gives. What remains is joined to one paragraph, and words broken at line ends are marked.
(2) Words never seen in text that was not scanned are looked up in the channel: every way to read them back through up to EDITS
character confusions is spelled out and joined with the lexicon, so the search is an equality join whatever the lexicon's size. Only
words too long to become any word of the lexicon are spared.
(3) Viterbi over each run of words picks the reading with the best product of confusion probabilities and bigram likelihood;
a word stays as it is where no reading is in the lexicon. A broken word is mended unless it is usually written with a hyphen.

Lexicon and bigrams are counts over all text of clean elements (rung A); words seen there once are not enough to correct
by. Null and empty texts give nothing; texts without scan noise come back with their lines joined. Elements of pages with
several profiles count as scanned if one profile says so. Repeated elements are each repaired. Very long lines are decoded in
runs around unknown words, so a run is as long as its neighbouring unknown words, not as the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.lookalikes import canonical_text
from quire.session import cut, hinted, parallelism

# Fixed values: (as read, as printed, probability that the print is read so).
CONFUSIONS = [
    ("f", "t", .02), ("t", "f", .004), ("c", "e", .02), ("e", "c", .006), ("1", "l", .02), ("1", "i", .02), ("l", "i", .006), ("i", "l", .006), ("0", "o", .02), ("o", "0", .002),
    ("5", "s", .02), ("s", "5", .002), ("8", "b", .006), ("6", "b", .01), ("b", "6", .002), ("9", "g", .01), ("q", "g", .02), ("g", "q", .004), ("b", "h", .02), ("h", "b", .006), ("rn", "m", .02), ("m", "rn", .02),
    ("ri", "n", .02), ("n", "ri", .01), ("ii", "u", .02), ("ii", "n", .01), ("u", "ii", .004), ("li", "h", .01), ("h", "li", .02), ("cl", "d", .02), ("d", "cl", .02), ("vv", "w", .02), ("w", "vv", .004),
    ("nn", "m", .006), ("m", "nn", .006), ("in", "m", .006), ("m", "in", .01), ("iii", "m", .004), ("ni", "m", .006), ("u", "n", .004), ("n", "u", .004), ("a", "o", .002), ("o", "a", .002), ("c", "o", .004), ("o", "c", .004), ("o", "e", .004), ("e", "o", .004), ("a", "e", .004), ("e", "a", .004), ("y", "v", .004), ("v", "y", .004), ("lc", "k", .01), ("tt", "ll", .002), ("z", "2", .004), ("2", "z", .01), ("@", "a", .02),
]
CHANNEL = [(seen, printed, math.log(q)) for seen, printed, q in CONFUSIONS]
EDITS, LEAST_SEEN = 3, 2
#: Letters by which one confusion can shorten a word.
SHORTER = max(len(seen) - len(printed) for seen, printed, _ in CONFUSIONS)
TOKEN = re.compile(r"(?:[^\W_]|@)+(?:[-'’\x01](?:[^\W_]|@)+)*")
JVM_TOKEN = r"[\p{L}\p{N}]+(?:[-'’][\p{L}\p{N}]+)*"
LETTER = re.compile(r"[^\W\d_]")
BREAK = re.compile(r"(?<=[^\W\d_])-[^\S\n]*\n[^\S\n]*(?=[^\W\d_])")
PAGE_WORD = r"(?:p[aàeo]g[ecs]?\.?|pg\.?|p\.|seite|p[áà]gina|pagina|fuula|ገጽ)"
PAGE_NUMBER = re.compile(rf"[-–—\[(|.·\s]*(?:{PAGE_WORD}\s*)?(?:\d{{1,5}}|[ivxlc]{{1,7}})(?:\s*(?:of|/|de|von|sur|ከ)\s*\d{{1,5}})?\s*(?:\|\s*p\s*a\s*g\s*e)?[-–—\])|.·\s]*", re.I)
IN_HEADER = re.compile(rf"(?:{PAGE_WORD}\s*)(\d+)(?:\s*(?:of|/)\s*\d+)?|\d+\s*\|\s*p\s*a\s*g\s*e", re.I)
NOISE = ("hyphenation", "misread", "running_header", "page_number")
_FOLD = [("rn", "m"), ("vv", "w"), ("cl", "d"), ("ii", "u"), ("ri", "n"), ("li", "h"), ("0", "o"), ("1", "l"), ("5", "s"), ("6", "b"), ("9", "g")]
_FOLD_ONE = str.maketrans("fcqbi", "teghl")


def folded(text: str) -> str:
    """Letters only, in a form that misreadings don't change."""
    t = text.lower()
    for a, b in _FOLD:
        t = t.replace(a, b)
    return "".join(c for c in t if c.isalpha()).translate(_FOLD_ONE)


def named(source_name: str | None) -> str:
    """Issuer and title as a file name gives them."""
    t = re.sub(r"\.\w{2,4}$", "", source_name or "")
    return re.sub(r"[_\-]+|\bNo\b.*$|^Copy of ", " ", re.sub(r"[_\-]+", " ", t))


def _spelled(line: str) -> tuple[set[str], set[str]]:
    """The words of a line in folded form, and its numbers."""
    tokens = re.findall(r"[^\W_]+", line)
    return {f for w in tokens if not w.isdigit() and (f := folded(w))}, {w for w in tokens if w.isdigit()}


def clear_lines(text: str, known: list[tuple[frozenset, frozenset]]) -> tuple[str, bool, bool]:
    """The prose (lines joined, \\x01 where a line end breaks a word), and whether a running header and a page number were in it.

    `known` has the words of the document's names, as folded() spells them, and the numbers that belong to each.
    """
    lines, header, page = canonical_text(text).split("\n"), False, False
    keep = []
    for line in lines:
        s = line.strip()
        if s and PAGE_NUMBER.fullmatch(s) and not s.endswith(".") and (len(lines) > 1 or not s.isalpha()):
            page = True
            continue
        if s and len(lines) > 1 and s[-1] not in ".,;:" and all(w[0].isupper() or w[0].isdigit() for w in re.findall(r"[^\W_]+", IN_HEADER.sub(" ", s))):
            plain = IN_HEADER.sub(" ", s)
            mine, numbers = _spelled(plain)
            hit = [years for theirs, years in known if mine <= theirs] if len(mine) > 1 and sum(map(len, mine)) >= 8 else []
            if hit:
                header = True
                page |= plain != s or bool(numbers - set().union(*hit))
                continue
        keep.append(line)
    joined = "\n".join(keep)
    if "-" in joined:
        joined = BREAK.sub("\x01", joined)
    return " ".join(filter(None, map(str.strip, joined.split("\n")))), header, page


def tokens_of(clear: str) -> list[str]:
    """The tokens in lower case."""
    low = clear.lower()
    return TOKEN.findall(low) if len(low) == len(clear) else [w.lower() for w in TOKEN.findall(clear)]


def readings(word: str, edits: int = EDITS) -> dict[str, float]:
    """All prints the word may be a misreading of, with their log probability."""
    out, edge = {word: 0.0}, {word: 0.0}
    for _ in range(edits):
        new: dict[str, float] = {}
        for w, p in edge.items():
            for seen, printed, lp1 in CHANNEL:
                at = w.find(seen)
                while at >= 0:
                    v = w[:at] + printed + w[at + len(seen) :]
                    lp = p + lp1
                    if lp > out.get(v, -99.0) and lp > new.get(v, -99.0):
                        new[v] = lp
                    at = w.find(seen, at + 1)
        out |= {k: v for k, v in new.items() if v > out.get(k, -99.0)}
        edge = new
    out.pop(word, None)
    return out


def clean_words(elements: DataFrame) -> DataFrame:
    """words: the tokens of each clean element, in order, lower case."""
    return elements.where("kind = 'text' and source_rung = 'A' and text is not null").select(F.regexp_extract_all(F.lower(F.regexp_replace("text", r"[­​‌‍⁠﻿]", "")), F.lit(JVM_TOKEN), F.lit(0)).alias("words"))


def bigrams(elements: DataFrame) -> DataFrame:
    """a, b, together: how often word b follows word a in clean text; b is null where a is an element's last word."""
    pairs = F.transform("words", lambda w, i: F.struct(w.alias("a"), F.get("words", i + 1).alias("b")))
    return clean_words(elements).select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("together"))


def lexicon(pairs: DataFrame) -> DataFrame:
    """word, seen: words with a letter that clean text has more than once."""
    return pairs.where(r"a rlike '\\p{L}'").groupBy(F.col("a").alias("word")).agg(F.sum("together").alias("seen")).where(F.col("seen") >= LEAST_SEEN)


def document_names(elements: DataFrame, profiles: DataFrame) -> DataFrame:
    """doc_id, known: what a document's file name and its furniture spell, each set of words once, as "words|numbers" lines.

    A number belongs to a name if at least half of the name's occurrences have it, so page numbers in furniture do not.
    """
    letters = r"length(regexp_replace(h, '[^\\p{L}]', '')) >= 8"
    files = profiles.select("doc_id", F.col("source_name").alias("h"), F.lit(True).alias("file")).where(letters).distinct().withColumn("n", F.lit(1).cast("bigint"))
    fixtures = elements.where("kind = 'furniture' and text is not null").select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("h")).where(letters).groupBy("doc_id", "h").agg(F.count("*").alias("n")).select("doc_id", "h", F.lit(False).alias("file"), "n")

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [_spelled(named(h) if f else h) for h, f in zip(b["h"], b["file"])]
            yield pd.DataFrame({"doc_id": b["doc_id"], "words": [" ".join(sorted(w)) for w, _ in got], "numbers": [sorted(x) for _, x in got], "n": b["n"]})

    spelled = files.unionByName(fixtures).mapInPandas(spell, "doc_id string, words string, numbers array<string>, n bigint").where("words <> ''")
    times = spelled.select("doc_id", "words", "n", F.explode_outer("numbers").alias("number")).groupBy("doc_id", "words", "number").agg(F.sum("n").alias("n"))
    whole = spelled.groupBy("doc_id", "words").agg(F.sum("n").alias("whole"))
    kept = times.join(whole, ["doc_id", "words"]).groupBy("doc_id", "words").agg(F.array_join(F.sort_array(F.collect_list(F.when(2 * F.col("n") >= F.col("whole"), F.col("number")))), " ").alias("numbers"))
    return kept.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("|", "words", "numbers"))), "\n").alias("known"))


@lru_cache(maxsize=256)
def _known(names: str) -> list[tuple[frozenset, frozenset]]:
    return [(frozenset(w.split()), frozenset(n.split())) for w, n in (line.split("|") for line in names.split("\n"))]


def prose(elements: DataFrame, profiles: DataFrame) -> DataFrame:
    """element_id, clear, header, page_number, words (of the prose, mended) and breaks (mended, hyphenated): the scanned elements."""
    scanned_pages = profiles.where("origin_type in ('scanned_image', 'mixed')").select("doc_id", "page").distinct().withColumn("marked", F.lit(True))
    e = elements.where("kind = 'text' and text is not null").select("element_id", "doc_id", F.col("bbox.page").alias("page"), "source_rung", "text")
    e = e.join(scanned_pages, ["doc_id", "page"], "left").where("marked or source_rung in ('B', 'C')")
    e = e.drop("page", "source_rung", "marked").join(hinted(cut(document_names(elements, profiles))), "doc_id", "left").repartition(parallelism(elements.sparkSession))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, text, names in zip(b["element_id"], b["text"], b["known"]):
                clear, header, page = clear_lines(text, _known(names) if names else [])
                tokens, broken = tokens_of(clear), []
                if "\x01" in clear:
                    broken = [{"joined": t.replace("\x01", ""), "hyphened": t.replace("\x01", "-")} for t in tokens if "\x01" in t]
                    tokens = [t.replace("\x01", "") for t in tokens]
                rows.append((i, clear, header, page, tokens, broken))
            yield pd.DataFrame(rows, columns=["element_id", "clear", "header", "page_number", "words", "breaks"])

    return e.select("element_id", "text", "known").mapInPandas(read, "element_id bigint, clear string, header boolean, page_number boolean, words array<string>, breaks array<struct<joined: string, hyphened: string>>")


def corrections(text: DataFrame, pairs: DataFrame, lex: DataFrame) -> DataFrame:
    """element_id, i, word, printed: the words (by their place) that the channel reads as others."""
    seen = text.select(F.explode("words").alias("word")).where("word rlike '[a-zà-ÿ]' and length(word) > 1 and 2 * length(regexp_replace(word, '[^0-9]', '')) <= length(word)").distinct()
    # What is longer than the lexicon's longest word even after all its confusions has no reading.
    longest = lex.agg(F.coalesce(F.max(F.length("word")), F.lit(0))).first()[0] + SHORTER * EDITS
    unknown = seen.where(F.length("word") <= longest).join(hinted(lex, 500_000), "word", "left_anti").repartition(parallelism(text.sparkSession))

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 64):
                rows = [(w, v, p) for w in b["word"][i : i + 64] for v, p in readings(w).items()]
                yield pd.DataFrame(rows, columns=["word", "printed", "channel"])

    found = unknown.mapInPandas(spell, "word string, printed string, channel double").join(lex.withColumnRenamed("word", "printed"), "printed")
    best = F.sort_array(F.collect_list(F.struct((F.col("channel") + F.log("seen")).alias("score"), "printed", "channel")), asc=False)
    table = cut(found.groupBy("word").agg(best.alias("readings")))
    place = text.select("element_id", "words", F.posexplode("words").alias("i", "word")).join(hinted(table), "word")
    near = lambda k: F.get("words", F.col("i") + k)
    hits = cut(place.select("element_id", "i", "word", "readings", near(-1).alias("before"), near(1).alias("after")))
    # Words at each place of a run: the readings of an unknown word; its neighbours stand for themselves unless they are unknown too.
    states = hits.select("element_id", "i", F.explode("readings").alias("r")).select("element_id", "i", F.col("r.printed").alias("w"), F.col("r.channel").alias("channel"))
    sides = hits.select("element_id", F.explode(F.array(F.struct((F.col("i") - 1).alias("i"), F.col("before").alias("w")), F.struct((F.col("i") + 1).alias("i"), F.col("after").alias("w")))).alias("s")).select("element_id", "s.*").where("w is not null").distinct()
    states = states.unionByName(sides.join(hits.select("element_id", "i"), ["element_id", "i"], "left_anti").withColumn("channel", F.lit(0.0)))
    states = cut(states)
    a, b = states.withColumnsRenamed({"w": "a", "channel": "ca"}), states.withColumnsRenamed({"w": "b", "channel": "cb"}).withColumn("i", F.col("i") - 1)
    steps = a.join(b, ["element_id", "i"])
    known = steps.select("a", "b").distinct().join(pairs, ["a", "b"])
    single = lex.select(F.col("word").alias("b"), "seen")
    steps = steps.join(hinted(cut(known)), ["a", "b"], "left").join(hinted(single, 500_000), "b", "left").join(hinted(lex.select(F.col("word").alias("a"), F.col("seen").alias("seen_a")), 500_000), "a", "left")
    runs = steps.groupBy("element_id").agg(F.collect_list(F.struct("i", "a", "ca", "b", "cb", F.coalesce("together", F.lit(0)).alias("n"), F.coalesce("seen", F.lit(0)).alias("sb"), F.coalesce("seen_a", F.lit(0)).alias("sa"))).alias("steps"))
    alone = states.join(steps.select("element_id").distinct(), "element_id", "left_anti").groupBy("element_id").agg(F.max_by("w", "channel").alias("w"), F.first("i").alias("i"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(r.element_id, i, w) for r in b.itertuples(index=False) for i, w in viterbi(r.steps)]
            yield pd.DataFrame(rows, columns=["element_id", "i", "printed"])

    chosen = runs.mapInPandas(decode, "element_id bigint, i int, printed string").unionByName(alone.select("element_id", "i", F.col("w").alias("printed")))
    return hits.select("element_id", "i", "word").join(chosen, ["element_id", "i"]).where("word <> printed")


def viterbi(steps: list) -> list[tuple[int, str]]:
    """The best word at each place; steps lists the pairs of neighbouring states (i, a, ca, b, cb, n = count of the pair, sa and sb = counts of the words)."""
    by: dict[int, list] = {}
    for s in steps:
        by.setdefault(s["i"], []).append(s)
    out: list[tuple[int, str]] = []
    score: dict[str, float] = {}
    back: list[dict[str, str]] = []
    last = None

    def close() -> None:
        if last is None:
            return
        w = max(score, key=lambda k: (score[k], k))
        path = [w]
        for prev in reversed(back):
            path.append(prev[path[-1]])
        out.extend((last + 1 - k, x) for k, x in enumerate(path))

    for i in sorted(by):
        if last is None or i != last + 1:
            close()
            score, back = {s["a"]: s["ca"] + math.log(s["sa"] + 0.5) for s in by[i]}, []
        best: dict[str, tuple[float, str]] = {}
        for s in by[i]:
            # Bigram likelihood, smoothed by the single word's count.
            p = score.get(s["a"], -1e9) + s["cb"] + math.log((s["n"] + 0.1 * math.sqrt(s["sb"] + 0.01)) / (s["sa"] + 1.0))
            if s["b"] not in best or (p, s["a"]) > best[s["b"]]:
                best[s["b"]] = (p, s["a"])
        score = {w: p for w, (p, _) in best.items()}
        back.append({w: a for w, (_, a) in best.items()})
        last = i
    close()
    return out


def hyphenations(text: DataFrame, lex: DataFrame) -> DataFrame:
    """element_id, joined, hyphened, mend: each broken word, and whether it is usually written without the hyphen."""
    b = text.select("element_id", F.explode("breaks").alias("b")).select("element_id", "b.*")
    known = hinted(lex, 500_000)
    one, two = known.select(F.col("word").alias("joined"), F.col("seen").alias("whole")), known.select(F.col("word").alias("hyphened"), F.col("seen").alias("parts"))
    b = b.join(one, "joined", "left").join(two, "hyphened", "left")
    return b.select("element_id", "joined", "hyphened", (F.coalesce("whole", F.lit(0)) >= F.coalesce("parts", F.lit(0))).alias("mend"))


def noise(elements: DataFrame, profiles: DataFrame) -> DataFrame:
    """element_id, noise: the sorts of scan noise in each scanned text."""
    pairs = cut(bigrams(elements))
    lex, text = cut(lexicon(pairs)), cut(prose(elements, profiles))
    parts = [hyphenations(text, lex).where("mend").select("element_id", F.lit("hyphenation").alias("noise")), corrections(text, pairs, lex).select("element_id", F.lit("misread").alias("noise")), text.where("header").select("element_id", F.lit("running_header").alias("noise")), text.where("page_number").select("element_id", F.lit("page_number").alias("noise"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def repaired(elements: DataFrame, profiles: DataFrame) -> DataFrame:
    """element_id, repaired: the scanned texts as continuous paragraphs."""
    pairs = cut(bigrams(elements))
    lex, text = cut(lexicon(pairs)), cut(prose(elements, profiles))
    fixes = corrections(text, pairs, lex).groupBy("element_id").agg(F.collect_list(F.struct("i", "printed")).alias("fixes"))
    keep = hyphenations(text, lex).where("not mend").groupBy("element_id").agg(F.collect_set("joined").alias("hyphened"))

    def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                fix = {} if r.fixes is None else {x["i"]: x["printed"] for x in r.fixes}
                with_hyphen, out, at = set() if r.hyphened is None else set(r.hyphened), [], 0
                for i, m in enumerate(TOKEN.finditer(r.clear)):
                    w = m.group()
                    plain = w.replace("\x01", "")
                    new = fix.get(i)
                    if new is not None:
                        new = new.upper() if plain.isupper() and len(plain) > 1 else new.capitalize() if plain[0].isupper() else new
                    elif plain.lower() in with_hyphen:
                        new = w.replace("\x01", "-")
                    else:
                        new = plain
                    out += [r.clear[at : m.start()], new]
                    at = m.end()
                rows.append((r.element_id, "".join(out) + r.clear[at:]))
            yield pd.DataFrame(rows, columns=["element_id", "repaired"])

    return text.select("element_id", "clear").join(fixes, "element_id", "left").join(keep, "element_id", "left").mapInPandas(mend, "element_id bigint, repaired string")

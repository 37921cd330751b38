"""Problem 3: one consistent form for texts that look the same but are stored with other characters.

canonical() works token by token. Each letter has the scripts in which its shape exists (its own, and those of its look-alikes);
the intersection over the token says in which scripts the whole token can be spelled. A token that can be spelled in one script
is respelled in it: the first of SCRIPTS, so mixed tokens ("Flοοd" with Greek o) and whole-script ones ("ТОР" in Cyrillic) meet
in the same form; a token that no single script spells keeps its letters. Around that, characters of zero width are removed,
spaces of any width become one plain space, full-width forms, ligatures, letter-like signs, Roman numeral signs and mathematical letters
become plain letters, and accents are composed (NFC). Case, accents, raised digits and line breaks are kept: texts that differ in them look different.

Null stays null and equals only null; an empty text stays empty. same_looking() never pairs rows of equal characters, however often
they repeat, and needs no more of a text than two digests of 128 bits in the shuffle, so very long texts are no special case.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import cut

#: Scripts in order of preference for respelling.
SCRIPTS = ("latin", "cyrillic", "greek", "armenian")
# Letters of one shape in (Latin, Cyrillic, Greek, Armenian); a space where a script has none.
SHAPES = """
AАΑ 
BВΒ 
CСϹ 
EЕΕ 
HНΗ 
IІΙ 
JЈͿ 
KКΚ 
MМΜ 
N Ν 
OОΟՕ
PРΡ 
QԚ  
SЅ Տ
TТΤ 
UՍ ՍՍ
WԜ  
XХΧ 
YҮΥ 
Z Ζ 
aаα 
cсϲ 
dԁ  
eе  
gԍ ց
hһ հ
iіι 
jјϳյ
kкκ 
lӏ  
n  ո
oоοօ
pрρ 
qԛ զ
sѕ  
u υս
vѵν 
wԝ  
xх  
yуγ 
z   
ГГΓ 
ПППΠ
ФФΦ 
"""
# Other letters that share a Latin shape: Latin and Cyrillic ones, Cherokee, Lisu.
ALSO = {"ɡ": "g", "ɑ": "a", "ı": "i", "ſ": "f", "К": "K", "ℓ": "l"}
ALSO |= dict(zip("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEHJKLMPRSTVWZ"))
ALSO |= dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
#: Zero-width and invisible characters, but for combining marks.
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")
SPACES = re.compile("[^\\S\n\r]+")


def _shapes() -> tuple[dict[str, dict[str, str]], dict[str, frozenset]]:
    """to[script][letter] is the letter's spelling in the script; has[letter] the scripts of its shape."""
    to: dict[str, dict[str, str]] = {s: {} for s in SCRIPTS}
    for line in SHAPES.strip("\n").split("\n"):
        cells = {s: c for s, c in zip(SCRIPTS, line.ljust(4)) if c != " " and _script(c) == s}
        for c in cells.values():
            for s, own in cells.items():
                to[s][c] = own
    for c, latin in ALSO.items():
        to["latin"][c] = latin
    return to, {c: frozenset(s for s in SCRIPTS if c in to[s]) for t in to.values() for c in t}


def _script(c: str) -> str:
    o = ord(c)
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "greek"
    if 0x400 <= o < 0x530:
        return "cyrillic"
    if 0x530 <= o < 0x590:
        return "armenian"
    return "latin" if unicodedata.name(c, "").startswith("LATIN") else "other"


TO, HAS = _shapes()
#: Letters after which a token needs a look at its scripts.
FOREIGN = re.compile("[ıɑɡſℓͰ-ϿЀ-֏Ꭰ-᏿ꓐ-꓿]")
#: White space that is not kept as it stands: anything but single plain spaces and line breaks.
ODD_SPACE = re.compile("[^\\S \n\r]|  ")


def respell(token: str) -> str:
    """The token in the first script that has the shapes of all its letters, or as it is."""
    scripts = frozenset(SCRIPTS)
    for c in unicodedata.normalize("NFD", token):
        if c.isalpha():
            own = _script(c)
            scripts &= HAS.get(c, frozenset()) | ({own} if own in SCRIPTS else frozenset())
            if not scripts:
                return token
    for s in SCRIPTS:
        if s in scripts:
            return "".join(TO[s].get(c, c) for c in unicodedata.normalize("NFD", token))
    return token


def _plain(c: str) -> str:
    """Full-width, half-width and mathematical forms, ligatures and Roman numeral signs as plain letters; anything else, raised digits among it, as it is."""
    d, o = unicodedata.decomposition(c), ord(c)
    if d.startswith(("<wide>", "<narrow>", "<font>")) or (d.startswith("<compat>") and (0xFB00 <= o <= 0xFB06 or 0x2160 <= o < 0x2180)):
        return unicodedata.normalize("NFKC", c)
    return c


COMPAT = {o: p for o in [*range(0x2100, 0x2180), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFFEF), *range(0x1D400, 0x1D800)] if (p := _plain(chr(o))) != chr(o)} | {0x2010: "-", 0x2011: "-", 0x3000: " "}
#: Ranges that hold all of them.
COMPATIBLE = re.compile("[\u2010\u2011\u2100-\u217f\u3000\ufb00-\ufb06\uff01-\uffee\U0001d400-\U0001d7ff]")


def canonical_text(text: str | None) -> str | None:
    if text is None or (text.isascii() and not ODD_SPACE.search(text)):
        return text
    t = INVISIBLE.sub("", text)
    # Each step is asked for first: most texts need none.
    if ODD_SPACE.search(t):
        t = SPACES.sub(" ", t)
    if COMPATIBLE.search(t):
        t = t.translate(COMPAT)
    t = unicodedata.normalize("NFC", t)
    if FOREIGN.search(t):
        t = unicodedata.normalize("NFC", "".join(respell(x) if FOREIGN.search(x) else x for x in re.split(r"(\W+)", t)))
    return t


@F.pandas_udf(T.StringType())
def _canonical(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(canonical_text, na_action="ignore")


def canonical(text: Column) -> Column:
    return _canonical(text)


def same_looking(df: DataFrame, id_col: str, text_col: str, within: list[Column]) -> DataFrame:
    """id_a < id_b: rows that agree in all columns `within` (null equals null) and whose texts look the same but differ in characters."""
    def digest(name: str, *parts: Column) -> list[Column]:
        return [F.xxhash64(F.lit(seed), *parts).alias(f"{name}{seed}") for seed in (1, 2)]

    place, raw = ["place1", "place2"], ["raw1", "raw2"]
    rows = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), canonical(F.col(text_col)).alias("look"), *[c.alias(f"k{i}") for i, c in enumerate(within)])
    # A hash passes nulls over, so each column says whether it is one.
    keys = [x for i in range(len(within)) for x in (F.isnull(f"k{i}"), F.col(f"k{i}"))]
    rows = cut(rows.select("id", *digest("place", *keys, F.col("look")), *digest("raw", F.col("text"))))
    # Groups of rows that all have the same characters are most of them; they go before any row meets another.
    mixed = rows.groupBy(*place).agg(F.min("raw1").alias("lo"), F.max("raw1").alias("hi")).where("lo <> hi").select(*place)
    rows = cut(rows.join(mixed, place, "left_semi"))
    # Spellings meet before rows do, so that rows of equal characters are never compared.
    kinds = rows.select(*place, *raw).distinct()
    a, b = (kinds.withColumnsRenamed({c: f"{c}{side}" for c in raw}) for side in "ab")
    pairs = a.join(b, place).where("(raw1a, raw2a) < (raw1b, raw2b)")
    first, second = (rows.select(*place, *[F.col(c).alias(f"{c}{side}") for c in raw], F.col("id").alias(f"id_{side}")) for side in "ab")
    met = pairs.join(first, [*place, "raw1a", "raw2a"]).join(second, [*place, "raw1b", "raw2b"]).where("id_a <> id_b")
    return met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()

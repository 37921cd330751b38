"""Column functions over cells, labels and texts. All stay in the JVM but nfc(), which has no built-in."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns of a printed number, of periods, and of captions.
NUMBER = r"(?i)^\(?-?[0-9,]+(?:\.[0-9]+)?\)?\s*(%|bn|billion|m|million|k|thousand|birr|br)?$"
CLAIM_NUMBER = r"(?i)-?\$?[0-9,]+(?:\.[0-9]+)?\s*(?:%|bn|billion|m|million|k|thousand)?"
PERIODS = [r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", r"(?i)\befy\s*-?\s*[0-9]{2,4}", r"\b(19|20)[0-9]{2}\b", r"[0-9]{4}\s*[-–/]\s*[0-9]{2,4}", r"(?i)\bq[1-4]\b"]
CAPTION = r"(?i)^table\s*[0-9]+\b"
SCALE = {"bn": 1e9, "billion": 1e9, "m": 1e6, "million": 1e6, "k": 1e3, "thousand": 1e3}
# Words that carry no meaning in a claim.
CLAIM_STOP = "the was were for and that this states report according billion million thousand percent".split()


def parse_number(raw: Column) -> tuple[Column, Column]:
    """(value, unit) of a printed cell: signs by parentheses or minus, thousands by commas, a scale or percent sign behind.

    Currency words are part of the pattern but make no number; null, blank and other texts give (null, null).
    """
    s = F.replace(F.trim(raw), F.lit("$"), F.lit(""))
    suffix = F.lower(F.regexp_extract(s, NUMBER, 1))
    ok = s.rlike(NUMBER) & ~suffix.isin("birr", "br")
    body = F.trim(F.regexp_replace(s, r"(?i)\s*(%|bn|billion|m|million|k|thousand)$", ""))
    inner = F.regexp_replace(body, "[(),]", "")
    size = inner.try_cast("double")
    sign = F.when(body.startswith("(") & body.endswith(")"), -1.0).when(body.contains("(") | body.contains(")"), None).otherwise(1.0)
    scale = F.lit(1.0)
    for word, f in SCALE.items():
        scale = F.when(suffix == word, f).otherwise(scale)
    value = F.when(ok, sign * size * scale)
    return value, F.when(value.isNotNull() & (suffix != ""), suffix)


def is_period(text: Column) -> Column:
    """Whether a cell reads as a month, year, range, quarter or fiscal year; a null does not."""
    hit = F.lit(False)
    for p in PERIODS:
        hit = hit | text.rlike(p)
    return F.coalesce(hit, F.lit(False))


def filled(cell: Column) -> Column:
    return cell.isNotNull() & (F.trim(cell) != "")


def period_share(cells: Column) -> Column:
    """The share of an array's filled cells that read as periods; 0 where none is filled."""
    n = F.size(F.filter(cells, filled))
    return F.when(n > 0, F.size(F.filter(cells, lambda c: filled(c) & is_period(c))) / n).otherwise(0.0)


def collapsed(text: Column) -> Column:
    """White space of any kind as single spaces."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


@F.pandas_udf(T.StringType())
def nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t), na_action="ignore")


def content_hash(text: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of a text in NFC with collapsed white space."""
    return F.substring(F.sha2(collapsed(nfc(text)), 256), 1, 16)


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(text) / 4)).cast("bigint")


def claim_words(claim: Column) -> Column:
    words = F.transform(F.regexp_extract_all(claim, F.lit("[A-Za-z]{3,}"), F.lit(0)), lambda w: F.lower(w))
    return F.filter(words, lambda w: ~w.isin(CLAIM_STOP))


def claim_values(claim: Column) -> Column:
    """The numbers of a claim, in order."""
    found = F.transform(F.regexp_extract_all(claim, F.lit(CLAIM_NUMBER), F.lit(0)), lambda c: parse_number(c)[0])
    return F.filter(found, lambda v: v.isNotNull())


def claim_value(claim: Column) -> Column:
    """The first number that is no year, else the first number."""
    values = claim_values(claim)
    year = lambda v: (v == F.floor(v)) & v.between(1900, 2100)
    return F.coalesce(F.get(F.filter(values, lambda v: ~year(v)), F.lit(0)), F.get(values, F.lit(0)))


def ethiopic(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^ሀ-፿ᎀ-᎟ⶀ-⷟꬀-꬯]", ""))


def latin(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^A-Za-z]", ""))


def general(value: Column) -> Column:
    """A number in at most six significant digits, without trailing zeros: plain from 0.0001 up to a million, else with an exponent of two digits or more; nan and inf as such."""
    v = value.cast("double")
    size = F.abs(v)
    ten = lambda e: F.pow(F.lit(10.0), e)
    e0 = F.floor(F.log10(size))
    # Six digits may round up to the next power of ten.
    up = F.when(F.rint(size / ten(e0 - 5)) >= 1e6, e0 + 1).otherwise(e0)
    digits = F.rint(size / ten(up - 5)).cast("bigint").cast("string")  # six digits, the point after the first
    bare = F.regexp_replace(digits, "0+$", "")
    sign = F.when(v < 0, "-").otherwise("")
    whole, n = up + 1, F.length(bare)
    plain = F.when(up < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), (-up - 1).cast("int")), bare)).when(n <= whole, F.rpad(bare, whole.cast("int"), "0")).otherwise(F.concat(F.substring(bare, F.lit(1), whole.cast("int")), F.lit("."), F.substring(bare, (whole + 1).cast("int"), n)))
    mantissa = F.when(n > 1, F.concat(F.substring(bare, 1, 1), F.lit("."), F.substring(bare, F.lit(2), n))).otherwise(bare)
    power = F.concat(F.lit("e"), F.when(up < 0, "-").otherwise("+"), F.when(F.abs(up) < 10, "0").otherwise(""), F.abs(up).cast("string"))
    return F.when(v.isNull(), None).when(F.isnan(v), "nan").when(size == float("inf"), F.concat(sign, F.lit("inf"))).when(v == 0, "0").when((up >= -4) & (up < 6), F.concat(sign, plain)).otherwise(F.concat(sign, mantissa, power))

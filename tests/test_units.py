"""Problem 1 and the scalar functions."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import units

UNITS = [("birr", "money", "birr", 1.0), ("kilogram", "mass", "kilogram", 1.0), ("quintal", "mass", "kilogram", 100.0), ("tonne", "mass", "kilogram", 1000.0), ("metre", "length", "metre", 1.0), ("foot", "length", "metre", 0.3048), ("square_metre", "area", "square_metre", 1.0), ("megawatt_hour", "energy", "kilowatt_hour", 1000.0), ("mile", "length", "metre", 1609.344)]
# value_raw, unit, context -> amount in the common unit (None: no amount)
CASES = [
    ("1,234.5", "qtl", None, 123450.0), ("(12)", None, "Table 3 (birr): Summary", -12.0), ("3 424,7", None, "Planned - all amounts in tonnes unless noted", 3424700.0), ("1.337,5", "m birr", None, 1337.5e6),
    ("12.5 m", "m", "Table 1 (birr): Results", 12.5e6), ("12.5 m", "m", "Table 1: Length of lines and canals", 12.5), ("12.5 m", "m", "Table 1 (feet): Results", 12.5), ("7M", "m", "Results, in ETB", 7e6), ("4.2k", "thousand", "Table 2 (mn birr)", 4200.0),
    ("5 kg", None, "Table 2: Results (tonnes '000)", 5.0), ("birr -3 thousand", None, None, -3000.0), ("birres 8,322 milhões de", None, None, 8322e6), ("2 miles de birres", None, None, 2000.0), ("2 miles", None, None, 3218.688), ("9.1 ሺህ ብር", None, None, 9100.0), ("7", None, "ሠንጠረዥ 1: ውጤቶች, በሺህ ብር", 7000.0),
    ("7,406.5 '000 m", None, None, 7406500.0), ("40.1%", "%", "Table 2 (birr)", None), ("55", None, "Price index (base = 100)", None), ("n/a", None, "Table 2 (birr)", None), ("55", None, None, None), (None, "birr", None, None), ("", "birr", None, None), ("12", "no such unit", "Table 2 (birr)", None), ("964\xa0460", "MWh", None, 964460000.0), ("3 sq m", None, None, 3.0),
]


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame(UNITS, "unit_name string, family string, common_unit string, factor double")


def test_common_amounts(spark, reference):
    rows = [(i, r, None, u, c, "clash") for i, (r, u, c, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "fact_id long, value_raw string, value_num double, unit string, context string, spelling string")
    got = {r["fact_id"]: r["common_amount"] for r in units.to_common_units(df, reference).collect()}
    assert len(got) == len(CASES)
    for i, (*_, want) in enumerate(CASES):
        assert got[i] == (None if want is None else pytest.approx(want)), CASES[i]


def test_misread_amounts(spark, reference):
    df = spark.createDataFrame([(1, "12 qtl", 12.0, None, None), (2, "12 kg", 12.0, None, None), (3, "12 qtl", 1200.2, None, None), (4, "12 kg", None, None, None), (4, "12 kg", None, None, None), (5, "x" * 100_000, None, "kg", "y" * 100_000)], "fact_id long, value_raw string, value_num double, unit string, context string")
    assert {tuple(r) for r in units.misread_amounts(df, reference).collect()} == {(1, "kilogram", 1200), (4, "kilogram", 12)}
    assert units.misread_amounts(df.limit(0), reference).count() == 0


def test_spanish_and_portuguese_billions(spark, reference):
    want = {"birres 82,1 miles de millones de": 82.1e9, "99.5 miles de millones de birres": 99.5e9, "3 miles de millones": 3e9, "2 milhares de milhões de birres": 2e9, "1,5 bilhão": 1.5e9, "4 bilhões de birres": 4e9, "4 bilhoes": 4e9}
    df = spark.createDataFrame([(k, "Table 1 (birr)") for k in want], "value_raw string, context string").selectExpr("value_raw", "cast(null as double) value_num", "cast(null as string) unit", "context")
    assert {r["value_raw"]: r["common_amount"] for r in units.to_common_units(df, reference).collect()} == {k: pytest.approx(v) for k, v in want.items()}


def test_unread_spellings(spark, reference):
    df = spark.createDataFrame([("5 zillion birr", None), ("6 zillion birr", "kg"), ("7 kg", "stones"), ("8", None), ("n/a zillion", "kg"), (None, None), ("9%", None)], "value_raw string, unit string")
    assert {tuple(r) for r in units.unread_spellings(df, reference).collect()} == {("cell", "zillion birr", 2), ("unit", "stones", 1), ("cell", "%", 1)}


def test_any_number_of_thousands_marks(spark):
    want = {"1,234,567,890": 1234567890.0, "12.345.678.901,50": 12345678901.5, "1 234 567 890 123": 1234567890123.0, "1,234,567,890,123.25": 1234567890123.25, "1,234,567": 1234567.0, "1.234,5": 1234.5, "1234.5678": 1234.5678, "1,23": 1.23, "7": 7.0}
    df = spark.createDataFrame([(k,) for k in want], "d string")
    assert {r["d"]: r["n"] for r in df.select("d", units.printed_number(F.col("d")).alias("n")).collect()} == want


def test_parse_number(spark):
    want = {"4,200": (4200, None), "12.5%": (12.5, "%"), "(300)": (-300, None), "4.2 billion": (4.2e9, "billion"), "n/a": (None, None), "12 birr": (None, None), ",": (None, None), ".5": (None, None), "$5": (5, None), "(4.2) m": (-4.2e6, "m"), "": (None, None), None: (None, None), "3k": (3000, "k")}
    v, u = X.parse_number(F.col("raw"))
    got = {r["raw"]: (r["v"], r["u"]) for r in spark.createDataFrame([(k,) for k in want], "raw string").select("raw", v.alias("v"), u.alias("u")).collect()}
    assert got == want


def test_claims_and_periods(spark):
    df = spark.createDataFrame([("Revenue was 4,200 in 2023",), ("2023 rose",), ("no number at all",), (None,)], "c string")
    rows = df.select(X.claim_value(F.col("c")).alias("v"), X.claim_words(F.col("c")).alias("w")).collect()
    assert [r["v"] for r in rows] == [4200.0, 2023.0, None, None]
    assert rows[0]["w"] == ["revenue"] and rows[3]["w"] is None
    words = {"March": True, "Margin": True, "EFY 2013": True, "2018/19": True, "Q3": True, "Revenue": False, "": False, None: False}
    got = {r["t"]: r["p"] for r in spark.createDataFrame([(k,) for k in words], "t string").select("t", X.is_period(F.col("t")).alias("p")).collect()}
    assert got == words


def test_content_hash_ignores_form(spark):
    rows = [("é  x",), ("é x",), (" é\nx ",)]
    assert spark.createDataFrame(rows, "t string").select(X.content_hash(F.col("t")).alias("h")).distinct().count() == 1


def test_offsets_and_source_defaults(spark):
    """Degrees by factor and offset; a source's default only where cell, unit and heading are silent; a nearer scale beats the default's."""
    reference = spark.createDataFrame([("birr", "money", "birr", 1.0, None), ("kilogram", "mass", "tonne", 0.001, None), ("acre", "temperature", "degree C", 5 / 9, -160 / 9)], "unit_name string, family string, common_unit string, factor double, offset double")
    rows = [(1, "212 acres", None, None, "a"), (2, "-40", "acre", None, "a"), (3, "5", None, None, "a"), (4, "5", None, None, "b"), (5, "5 million", None, None, "a"), (6, "5 kg", None, None, "a"), (7, "5", None, None, None), (8, "5 zillion", None, None, "a"), (9, None, None, None, "a")]
    df = spark.createDataFrame(rows, "fact_id long, value_raw string, unit string, context string, document string")
    defaults = spark.createDataFrame([("a", "thousand birr"), (None, "kg"), ("c", "kg")], "document string, spelling string")
    got = {r["fact_id"]: r["common_amount"] for r in units.to_common_units(df, reference, defaults).collect()}
    assert got == {1: pytest.approx(100.0), 2: pytest.approx(-40.0), 3: 5000.0, 4: None, 5: 5e6, 6: pytest.approx(0.005), 7: None, 8: None, 9: None}
    got = {tuple(r) for r in units.source_defaults(df.union(df.limit(0)), reference).collect()}
    assert got == {("a", "ac")}

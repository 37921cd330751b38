"""Problem 1: amounts printed in any unit and scale, brought to the common unit of their family.

Everything is column expressions and joins on a fixed table of unit spellings. A cell is cut by one regular expression into
prefix, sign, number and suffix; what is not the number is looked up as a spelling of a unit, a scale, or both in either order.
The cell's spelling comes first, then the one of the column `unit`, then the one the table heading (`context`) prints, then, where
defaults are given, that of the source. Units with an offset (degrees) are converted by factor and offset.

Cases: null or non-numeric `value_raw`, percentages, and rows with no unit anywhere give no row (to_common_units keeps them
with a null amount). Empty tables give empty results; repeated rows are judged each for itself; other columns pass through.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import cut, hinted

# Spellings of the units of unit_reference, lower case.
UNIT_SPELLINGS = {
    "birr": "birr birrs birres br br. etb ብር",
    "santim": "santim santims|cents of birr|cent of birr|santims of birr",
    "kilogram": "kg kgs kg. kilo kilos kilogram kilograms kilogrammes kilogramos kilogramm quilogramas|ኪሎ ግራም|ኪሎግራም",
    "gram": "g gm gms gram grams grammes gramos gramm gramas|ግራም",
    "quintal": "quintal quintals qt qts qtl qtls qtl. qtls. quintaux quintales quintais doppelzentner dz ኩንታል",
    "tonne": "t mt ton tons tonne tonnes toneladas tonelada tonnen|metric ton|metric tons|metric tonne|metric tonnes|ቶን",
    "pound": "lb lbs lb. lbs. pound pounds livres libras pfund",
    "litre": "l lt ltr ltrs litre litres liter liters litro litros ሊትር",
    "hectolitre": "hl hectolitre hectolitres hectoliter hectoliters hektoliter hectolitros",
    "cubic_metre": "m3 m³ cbm|cubic metre|cubic metres|cubic meter|cubic meters|cu. m|cu m|cu.m|cu. m.|mètres cubes|metros cúbicos|kubikmeter|ሜትር ኩብ",
    "us_gallon": "gal gal. gals gallon gallons|us gal|us gallon|us gallons|u.s. gallons|galones|galões",
    "kilowatt_hour": "kwh kilowatt-hour kilowatt-hours kilowattheures kilowattstunden|kilowatt hour|kilowatt hours|ኪሎዋት ሰዓት|ኪሎ ዋት ሰዓት",
    "megawatt_hour": "mwh megawatt-hour megawatt-hours|megawatt hour|megawatt hours|ሜጋዋት ሰዓት|ሜጋ ዋት ሰዓት",
    "gigawatt_hour": "gwh gigawatt-hour gigawatt-hours|gigawatt hour|gigawatt hours|ጊጋዋት ሰዓት|ጊጋ ዋት ሰዓት",
    "metre": "m mtr mtrs metre metres meter meters mètres metros ሜትር",
    "kilometre": "km kms km. kilometre kilometres kilometer kilometers kilomètre kilomètres kilómetro kilómetros quilómetro quilómetros quilômetros|ኪሎ ሜትር|ኪሎሜትር",
    "mile": "mi mile miles milles millas meilen",
    "foot": "ft ft. foot feet pieds pies",
    "square_metre": "m2 m² sqm|sq m|sq. m|sq.m|sq. m.|square metre|square metres|square meter|square meters|mètres carrés|metros cuadrados|metros quadrados|quadratmeter|ካሬ ሜትር",
    "hectare": "ha ha. hectare hectares hectárea hectáreas hektar ሄክታር",
    "square_kilometre": "km2 km² sqkm|sq km|sq. km|square kilometre|square kilometres|square kilometer|square kilometers|kilomètres carrés|quadratkilometer|ካሬ ኪሎ ሜትር",
    "acre": "ac acre acres acres",
}
# Spellings of scales, lower case.
SCALE_SPELLINGS = {
    1e3: "'000|'000s|000s|000's|k|thousand|thousands|thou|tausend|tsd.|millier|milliers|mil|miles|milhar|milhares|ሺህ",
    1e6: "m|mn|mln|mio|mio.|million|millions|millionen|millones|millón|milhão|milhões|ሚሊዮን",
    1e9: "b|bn|bln|mrd|mrd.|billion|billions|milliard|milliards|milliarden|mil millones|miles de millones|mil milhões|milhares de milhões|bilhão|bilhões|bilhao|bilhoes|ቢሊዮን",
}
#: Groups of the cell pattern: prefix, sign, number, closing parenthesis, suffix.
CELL = r"^([^0-9(\-−–]*)([(\-−–]*)\s*([0-9][0-9.,\s\x{A0}\x{202F}\x{2009}]*[0-9]|[0-9])\s*(\)?)(.*)$"
#: The printed unit of a table heading.
HEADING = r"\(([^)]*)\)|, (?:in|en|em) ([^,]*)$|, (በ[^,]*)$|all amounts in (.*) unless noted"


def unit_spellings() -> list[tuple[str, float, str | None]]:
    """(spelling, scale, unit_name): every unit, scale, and scale with unit in the orders that print."""
    names = [(a, u) for u, words in UNIT_SPELLINGS.items() for part in words.split("|") for a in ([part] if part.count(" ") and part.split()[0] in PHRASES else part.split())]
    scales = [(a, f) for f, words in SCALE_SPELLINGS.items() for a in words.split("|")]
    out: dict[str, tuple[float, str | None]] = {}
    for s, f in scales:
        for of in ("", " de", " of"):
            out[s + of] = (f, None)
        for a, u in names:
            for text in (f"{s} {a}", f"{s} de {a}", f"{s} of {a}", f"{a} {s}", f"{a} in {s}", f"{a} {s} de", f"{a} {s} of"):
                out.setdefault(text, (f, u))
    for a, u in names:
        out[a] = (1.0, u)
    return [(k, *v) for k, v in out.items()]


#: Words that begin a spelling of several words.
PHRASES = {"cents", "cent", "santims", "metric", "cubic", "cu.", "cu", "mètres", "metros", "us", "u.s.", "kilowatt", "megawatt", "gigawatt", "sq", "sq.", "square", "kilomètres", "ኪሎ", "ሜትር", "ሜጋ", "ጊጋ", "ኪሎዋት", "ሜጋዋት", "ጊጋዋት", "ካሬ"}


def spelled(text: Column) -> Column:
    """A unit text in the form of the spelling table: a lone M is a million, everything else ignores case."""
    t = F.regexp_replace(text, "[’‘`´]", "'")
    t = F.regexp_replace(t, r"(^|\s)M(\s|$)", "$1million$2")
    t = F.regexp_replace(F.lower(t), r"[\s\x{A0}\x{202F}\x{2009}]+", " ")
    return F.trim(t)


def heading_unit(context: Column) -> Column:
    """The unit text that a table heading prints, or the empty string."""
    found = F.concat(*[F.regexp_extract(context, HEADING, g) for g in (1, 2, 3, 4)])
    return spelled(F.regexp_replace(F.regexp_replace(F.trim(found), r"^(in|en|em) ", ""), "^በ", ""))


def printed_number(digits: Column) -> Column:
    """A dot, comma or space before exactly three digits groups thousands; another one is the decimal mark."""
    t = F.regexp_replace(digits, r"[.,\s\x{A0}\x{202F}\x{2009}](?=[0-9]{3}(?![0-9]))", "")
    return F.regexp_replace(t, r"[,\s\x{A0}\x{202F}\x{2009}]", ".").try_cast("double")


def spelling_table(spark: SparkSession, units: DataFrame) -> DataFrame:
    """The spellings with what unit_reference says of their units; its size is fixed by this module. A table without `offset` has none: amount * factor + offset is in the common unit."""
    words, scales, names = zip(*unit_spellings())
    known = spark.createDataFrame(pa.table({"spelling": pa.array(words, pa.string()), "scale": pa.array(scales, pa.float64()), "unit_name": pa.array(names, pa.string())}))
    offset = F.coalesce(F.col("offset").cast("double"), F.lit(0.0)) if "offset" in units.columns else F.lit(0.0)
    return known.join(F.broadcast(units.select("unit_name", "family", "common_unit", F.col("factor").cast("double"), offset.alias("offset"))), "unit_name", "left").where("unit_name is null or family is not null")


def to_common_units(facts: DataFrame, units: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    """All rows of facts with unit_family, common_unit and common_amount (null where the row states no amount of a family).

    The unit is what the cell prints, else what `unit` says, else the table heading, else the default of the source (`defaults`: document
    and spelling, one row each; none by default). A default scales an amount only where nothing nearer does.
    """
    names = spelling_table(facts.sparkSession, units)

    def of(prefix: str) -> DataFrame:
        return F.broadcast(names.select(*[F.col(c).alias(f"__{prefix}_{c}") for c in names.columns]))

    part = lambda g: F.regexp_extract("value_raw", CELL, g)
    df = facts.withColumns({
        "__sign": F.when(part(2).contains("("), F.when(part(4) == ")", -1.0)).when(part(2) != "", -1.0).otherwise(1.0),
        "__number": printed_number(part(3)),
        "__cell": spelled(F.concat_ws(" ", part(1), part(5))),
        "__field": spelled(F.coalesce("unit", F.lit(""))),
        "__head": heading_unit(F.coalesce("context", F.lit(""))),
    })
    sides = ["cell", "field", "head"]
    if defaults is not None:
        named = hinted(cut(defaults.select(F.col("document").alias("__source"), spelled(F.col("spelling")).alias("__default")).where("__source is not null")))
        df = df.join(named, F.col("document") == F.col("__source"), "left")
        sides.append("default")
    for side in sides:
        df = df.join(of(side), F.col(f"__{side}") == F.col(f"__{side}_spelling"), "left")
    # A lone m is metres, unless the amounts are money: then it is a million.
    money = F.coalesce(F.col("__head_family") == "money", F.lit(False))
    for side in ("cell", "field"):
        lone = (F.col(f"__{side}") == "m") & money
        df = df.withColumns({f"__{side}_unit_name": F.when(~lone, F.col(f"__{side}_unit_name")), f"__{side}_scale": F.when(lone, 1e6).otherwise(F.col(f"__{side}_scale"))})
    own = F.col("__cell_unit_name").isNotNull()
    field_has = F.col("__field_unit_name").isNotNull()
    scaled = lambda side: F.when(F.coalesce(F.col(f"__{side}_scale"), F.lit(1.0)) != 1.0, F.col(f"__{side}_scale"))
    head_has = F.col("__head_unit_name").isNotNull()
    last = (lambda c: F.col(f"__default_{c}")) if defaults is not None else (lambda c: F.lit(None))
    chosen = lambda c: F.when(own, F.col(f"__cell_{c}")).when(field_has, F.col(f"__field_{c}")).when(head_has, F.col(f"__head_{c}")).otherwise(last(c))
    # A default's own scale goes with its unit only.
    far = scaled("default") if defaults is not None else F.lit(None)
    scale = F.when(own, F.col("__cell_scale")).otherwise(F.coalesce(scaled("cell"), scaled("field"), scaled("head"), F.when(~own & ~field_has & ~head_has, far), F.lit(1.0)))
    readable = ((F.col("__cell") == "") | F.col("__cell_spelling").isNotNull()) & ((F.col("__field") == "") | F.col("__field_spelling").isNotNull())
    df = df.withColumns({
        "unit_family": F.when(readable, chosen("family")),
        "common_unit": F.when(readable, chosen("common_unit")),
        "common_amount": F.when(readable, F.col("__sign") * F.col("__number") * scale * chosen("factor") + chosen("offset")),
    })
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def source_defaults(facts: DataFrame, units: DataFrame) -> DataFrame:
    """document, spelling: the unit that most of a document's facts with one print (cell, field or heading; the first in the alphabet of equals)."""
    names = spelling_table(facts.sparkSession, units).where("unit_name is not null")
    part = lambda g: F.regexp_extract("value_raw", CELL, g)
    texts = facts.where("document is not null").select("document", spelled(F.concat_ws(" ", part(1), part(5))).alias("cell"), spelled(F.coalesce("unit", F.lit(""))).alias("field"), heading_unit(F.coalesce("context", F.lit(""))).alias("head"))
    for side in ("cell", "field", "head"):
        texts = texts.join(F.broadcast(names.select(F.col("spelling").alias(side), F.col("unit_name").alias(f"{side}_name"))), side, "left")
    n = texts.select("document", F.coalesce("cell_name", "field_name", "head_name").alias("unit_name")).where("unit_name is not null").groupBy("document", "unit_name").agg(F.count("*").alias("n"))
    first = {u: next(w for w in part.split("|")[0].split() if len(w) > 1) for u, part in UNIT_SPELLINGS.items()}
    word = F.create_map(*[F.lit(x) for kv in first.items() for x in kv])
    return n.groupBy("document").agg(F.min_by("unit_name", F.struct((-F.col("n")).alias("n"), "unit_name")).alias("u")).select("document", word[F.col("u")].alias("spelling"))


def unread_spellings(facts: DataFrame, units: DataFrame) -> DataFrame:
    """side (cell, unit), spelling, n_facts: what stands beside a number and is no spelling of the table, so that its facts give no amount."""
    part = lambda g: F.regexp_extract("value_raw", CELL, g)
    sides = F.explode(F.array(F.struct(F.lit("cell").alias("side"), spelled(F.concat_ws(" ", part(1), part(5))).alias("spelling")), F.struct(F.lit("unit").alias("side"), spelled(F.coalesce("unit", F.lit(""))).alias("spelling")))).alias("s")
    seen = facts.where(part(3) != "").select(sides).select("s.*").where("spelling <> ''").groupBy("side", "spelling").agg(F.count("*").alias("n_facts"))
    return seen.join(F.broadcast(spelling_table(facts.sparkSession, units).select("spelling")), "spelling", "left_anti").select("side", "spelling", "n_facts")


def misread_amounts(facts: DataFrame, units: DataFrame) -> DataFrame:
    """fact_id, common_unit, common_value of the facts whose value_num is not their amount in the common unit."""
    df = to_common_units(facts.select("fact_id", "value_raw", "value_num", "unit", "context"), units)
    whole = F.round("common_amount")
    return df.where(whole.isNotNull() & ~F.coalesce(F.round("value_num") == whole, F.lit(False))).select("fact_id", "common_unit", whole.cast("bigint").alias("common_value")).distinct()

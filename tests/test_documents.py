"""Tables, facts, claims, sections, coverage, vectors, the agent loop, stores and the stream."""

import collections
import datetime
import hashlib
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import agent, answers, coverage, ledgers, navigation, sections, tables, triage, vectors
from quire.sources import stores
from quire.streaming import ledger as streams

BBOX = "bbox struct<x0: double, y0: double, x1: double, y1: double, page: int>"
TABLE = "table_data struct<headers: array<string>, rows: array<array<string>>, row_periods: array<string>, context: string>"
ELEMENT = f"element_id long, doc_id string, idx int, kind string, source_rung string, {BBOX}, text string, {TABLE}, caption string, font_size double, label string"
FACT = "fact_id long, key string, period string, value_raw string, value_num double, unit string, context string, document string, page int, x0 double, y0 double, x1 double, y1 double, content_hash string"


def element(i, kind="text", text=None, table=None, page=1, y0=0.0, y1=10.0, x0=72.0, x1=500.0, size=10.0, label=None, caption=None, rung="A", doc="d"):
    return (i, doc, i, kind, rung, (x0, y0, x1, y1, page), text, table, caption, size, label)


def fact(i, key, period, raw, num, doc="report.pdf", page=1):
    return (i, key, period, raw, num, None, None, doc, page, 0.0, 0.0, 1.0, 1.0, f"h{i}")


@pytest.fixture(scope="module")
def facts(spark):
    rows = [fact(1, "Revenue", "2023", "4,200", 4200.0), fact(2, "Revenue", "2024", "5,100", 5100.0), fact(3, "Costs", "2023", "2,000", 2000.0), fact(4, "Costs", "2024", "2,300", 2300.0), fact(5, "Revenue", "2023", "3,300", 3300.0, "other.pdf"), fact(6, None, None, None, None)]
    return spark.createDataFrame(rows, FACT)


# ---- tables ----

def test_unpivot_both_ways_and_dedupe(spark):
    across = (["Metric", "2023", "2024"], [["Revenue", "4,200", "5,100"], ["Margin", "12.5%", ""]], None, None)
    down = (["Month", "General", "Food"], [["March", "13.5", "11.7"], ["July EFY2013 - July EFY2014", "33.7", "40.3"]], None, None)
    blocks = (["Item", "Imports"], [["Capital", "2,065.91"]], ["2018/19"], None)
    e = spark.createDataFrame([element(1, "table", table=across), element(2, "table", table=across), element(3, "table", table=down), element(4, "table", table=blocks), element(5, "table", table=(["one"], [["x"]], None, None)), element(6)], ELEMENT)
    got = {(r["key"], r["period"]): (r["value"], r["unit"], r["skipped"]) for r in tables.unpivoted(e).collect()}
    assert got[("Revenue", "2023")] == (4200.0, None, 1) and got[("Margin", "2023")] == (12.5, "%", 1)
    assert got[("Food", "March")] == (11.7, None, 0) and got[("Food", "July EFY2013 - July EFY2014")] == (40.3, None, 0)
    assert got[("Capital", "2018/19")] == (2065.91, None, 0) and len(got) == 8


def test_checks(spark):
    rows = [(1, ["a"], [["x"]]), (2, ["", "", "2024"], [["a", "b", "c"]]), (3, ["a", "b", "c"], [["x", "", ""], ["", "", ""], ["", "", ""]]), (4, ["a", "b"], []), (5, None, None), (6, ["a", "b"], [["x", "y"]])]
    df = spark.createDataFrame(rows, "id int, h array<string>, r array<array<string>>")
    got = {r["id"]: r["f"] for r in df.select("id", tables.failed_checks(F.col("h"), F.col("r")).alias("f")).collect()}
    assert got == {1: ["too_few_columns"], 2: ["empty_headers"], 3: ["mostly_empty_cells"], 4: ["no_rows"], 5: ["too_few_columns", "no_rows"], 6: []}


def repaired(spark, *grids):
    e = spark.createDataFrame([element(i, "table", table=g) for i, g in enumerate(grids)], ELEMENT)
    return [(r["headers"], r["rows"], r["row_periods"], r["context"]) for r in tables.repair(e).orderBy("element_id").collect()]


def test_repair_packs_padded_grids_and_is_stable(spark):
    headers = ["", "", "Imports (CIF value)", "", "", "Total expenditure", "", ""]
    rows = [["2018/19", "", "", "", "", "", "", ""], ["", "Capital", "", "2065.91", "", "", "711.02", ""], ["", "investment", "", "", "", "", "", ""], ["July", "Second schedule", "", "1", "", "", "2", ""], ["2019/20", "", "2020/21", "", "", "", "", ""], ["", "", "", "3", "", "", "", ""], ["", "", "of", "", "the rest", "", "", ""]]
    fused = (["a", "b"], [["x\nYear-on-Year\n12.6", "  y  z "], ["Label\nTable 3: Infla", "tion\n7"]], None, "own")
    one, two, none, plain = repaired(spark, (headers, rows, None, "kept"), fused, ([], [], None, None), (["a"], [["x\ny", None, "z"]], ["b"], "own"))
    assert one[0] == ["", "Imports (CIF value)", "Total expenditure"] and one[1][0] == ["Capital investment", "2065.91", "711.02"] and one[3] == "kept"
    assert one[1][1:] == [["Second schedule", "1", "2"], ["of the rest", "3", ""]] and one[2] == ["2018/19", "July", "2019/20 2020/21"]
    assert repaired(spark, one)[0] == one
    assert two[1] == [["12.6", "y z"], ["Label", "7"]] and two[3] == "xYear-on-YearTable 3: Inflation"
    assert none == ([], [], None, None) and plain == (["a"], [["x y", "", "z"]], ["b"], "own")


def test_facts_carry_where_they_stand(spark):
    """A block period makes the row the key even where periods run down; white space collapses; an empty period is null; names come from profiles."""
    down = (["Month", "General  index"], [["March", "13.5"], [" ", "9"], ["April", "14"]], [None, None, "2018/19"], "Table 1: aTable 1: a")
    across = (["Item", ""], [["Cash \n in hand", "(300)"], ["", "1"]], None, None)
    e = spark.createDataFrame([element(1, "table", table=down, page=4), element(2, "table", table=across, caption="  Two   words ")], ELEMENT)
    p = spark.createDataFrame([("d", "report.pdf")], "doc_id string, source_name string")
    got = {(r["key"], r["period"]): r for r in tables.unpivoted(e, p).collect()}
    assert set(got) == {("General index", "March"), ("April", "2018/19"), ("Cash in hand", None)}
    assert got["General index", "March"]["context"] == "Table 1: a" and got["General index", "March"]["page"] == 4 and got["Cash in hand", None]["context"] == "Two words"
    assert got["Cash in hand", None]["value"] == -300.0 and got["Cash in hand", None]["document"] == "report.pdf" and got["Cash in hand", None]["bbox"]["x0"] == 72.0
    assert got["April", "2018/19"]["content_hash"] == hashlib.sha256(b"report.pdf|April|2018/19|14").hexdigest()[:16]
    assert got["Cash in hand", None]["content_hash"] == hashlib.sha256(b"report.pdf|Cash in hand||(300)").hexdigest()[:16]


def test_captions(spark):
    df = spark.createDataFrame([("StrengtheningStrengthening",), ("Table 1: a Table 1: a b",), ("clean",), (None,), ("",)], "c string")
    assert [r["o"] for r in df.select(tables.single_caption(F.col("c")).alias("o")).collect()] == ["Strengthening", "Table 1: a b", "clean", None, ""]
    t = (["a", "b"], [["x", "1"]], None, None)
    e = spark.createDataFrame([element(1, "table", table=t, y0=200.0, y1=300.0), element(2, text="Table 7: Prices", y0=170.0, y1=190.0), element(3, "table", table=t, page=2, y0=200.0, y1=300.0), element(4, text="Table 8: far", page=2, y0=20.0, y1=40.0), element(5, "table", table=t, caption="Own", page=3)], ELEMENT)
    assert {r["element_id"]: r["context"] for r in tables.contexts(e).collect()} == {1: "Table 7: Prices", 3: None, 5: "Own"}


def test_split_parts(spark):
    df = spark.createDataFrame([(["Item", "Value"], [[f"row {i}", str(i)] for i in range(60)])], "h array<string>, r array<array<string>>")
    parts = df.select(tables.split_parts(F.col("h"), F.col("r"), 60).alias("p")).first()["p"]
    assert len(parts) > 1 and all(p.split("\n")[0].startswith("[part") and p.split("\n")[1] == "Item | Value" for p in parts)
    assert sum(len(p.split("\n")) - 2 for p in parts) == 60


# ---- questions ----

def test_scoped_sql(facts):
    q = "SELECT key, period, value_num FROM facts ORDER BY value_num DESC LIMIT 1"
    assert answers.scoped_query(facts, q, ["report.pdf"]).first()["period"] == "2024"
    assert answers.scoped_query(facts, "SELECT COUNT(*) AS n FROM facts", ["other.pdf"]).first()["n"] == 1
    assert answers.scoped_query(facts, "SELECT COUNT(*) AS n FROM facts", []).first()["n"] == 0
    for bad in ("DELETE FROM facts", "WITH x AS (SELECT 1) SELECT * FROM x", "SELECT * FROM parquet.`/root/testdata/sf0.01/facts.parquet`", "SELECT * FROM global_temp.other"):
        with pytest.raises(answers.NotASelect):
            answers.scoped_query(facts, bad)
    views = [t.name for t in facts.sparkSession.catalog.listTables("global_temp") if t.name.startswith("facts_")]
    assert views == []
    got = answers.structured(facts, "SELECT * FROM facts WHERE key LIKE 'REVENUE'")
    assert len(got["rows"]) == 3 and "note" not in got and all(map(answers.citable, got["rows"]))
    assert "note" in answers.structured(facts, "SELECT key, value_num, content_hash FROM facts") and answers.structured(facts, "SELECT * FROM facts WHERE key = 'x'") == {"rows": []}
    assert "error" in answers.structured(facts, "DROP TABLE facts") and "error" in answers.structured(facts, "SELECT nothing FROM facts")


def test_statements_of_the_other_dialect(spark, facts):
    ask = lambda q: [tuple(r) for r in answers.scoped_query(facts, q).collect()]
    assert ask("SELECT rowid, key FROM facts WHERE key LIKE '%cost%' ORDER BY rowid") == [(3, "Costs"), (4, "Costs")] and answers.scoped_query(facts, "SELECT rowid FROM facts").columns == ["rowid"]
    assert ask("SELECT COUNT(*) FROM facts WHERE key GLOB 'r*'") == [(0,)] and ask("SELECT COUNT(*) FROM facts WHERE key GLOB 'R*[tu]?'") == [(3,)]
    assert ask("SELECT \"key\" FROM facts WHERE period = \"2024\" AND key = 'Costs' -- LIKE rowid") == [("Costs",)]
    assert ask("SELECT printf('%s', 'it''s LIKE a \\n rowid') FROM facts LIMIT 1") == [("it's LIKE a \\n rowid",)]
    assert ask("SELECT group_concat(period) FROM (SELECT period FROM facts WHERE key = 'Costs' ORDER BY rowid)") in ([("2023,2024",)], [("2024,2023",)])
    assert ask("SELECT MAX(rowid) AS rowid FROM facts WHERE (rowid > 2)") == [(6,)]
    assert [r["fact_id"] for r in answers.lookup(facts, ["REV"], ["report.pdf"]).collect()] == [1, 2]


def test_audit(spark, facts):
    claims = [(1, "revenue was 4,200 in 2023", "report.pdf"), (2, "revenue was 4,300 in 2023", "report.pdf"), (3, "headcount was 12", "report.pdf"), (4, "revenue rose", "report.pdf"), (5, "costs was 2,000", "other.pdf"), (6, None, "report.pdf"), (7, "revenue was 3,300", "other.pdf")]
    got = {r["claim_id"]: (r["status"], r["printed_value"]) for r in answers.audited(spark.createDataFrame(claims, "claim_id long, claim string, document string"), facts).collect()}
    assert got == {1: ("VERIFIED", "4,200"), 2: ("REFUTED", "4,200"), 3: ("UNVERIFIABLE", None), 4: ("UNVERIFIABLE", None), 5: ("UNVERIFIABLE", None), 6: ("UNVERIFIABLE", None), 7: ("VERIFIED", "3,300")}


def test_audit_in_order_of_rank(spark):
    """The first document that speaks of it decides; others that print the claimed value are named."""
    rows = [fact(1, "Revenue", "2023", "4,200", 4200.0, "alpha", 3), fact(2, "Revenue", "2023", "4,200", 4200.0, "beta"), fact(3, "Revenue", "2023", "3,300", 3300.0, "gamma"), fact(4, "Costs", "2023", "9", 9.0, "gamma")]
    f = spark.createDataFrame(rows, FACT)
    claims = [(1, "revenue was 4,200 in 2023", ["beta", "alpha"]), (2, "revenue was 3,300 in 2023", ["alpha", "gamma", "alpha"]), (3, "revenue was 9,999 in 2023", ["alpha", "beta", "gamma"]), (4, "costs was 9 in 2023", ["alpha"]), (5, "costs was 9 in 2023", ["alpha", None, "gamma"]), (6, "costs was 9", []), (7, "costs was 9", None), (8, None, ["alpha"])]
    c = spark.createDataFrame(claims, "claim_id long, claim string, documents array<string>")
    got = {r["claim_id"]: r for r in answers.audited_in(c, f).collect()}
    assert {k: (r["status"], r["document"], r["elsewhere"]) for k, r in got.items()} == {1: ("VERIFIED", "beta", []), 2: ("REFUTED", "alpha", ["gamma"]), 3: ("REFUTED", "alpha", []), 4: ("UNVERIFIABLE", None, []), 5: ("VERIFIED", "gamma", []), 6: ("UNVERIFIABLE", None, []), 7: ("UNVERIFIABLE", None, []), 8: ("UNVERIFIABLE", None, [])}
    assert got[2]["page"] == 3 and got[2]["x1"] == 1.0 and "4,200" in got[2]["detail"]
    q = spark.createDataFrame([(1, "Costs of gamma?"), (2, "nothing"), (3, None)], "question_id long, question string")
    cards = spark.createDataFrame([("a", "alpha", ["Revenue"]), ("g", "gamma", ["Revenue", "Costs"])], "doc_id string, source_name string, fact_keys array<string>")
    assert {r["question_id"]: (r["doc_ids"], r["documents"]) for r in answers.bound(q, cards).collect()} == {1: (["g"], ["gamma"]), 2: ([], []), 3: ([], [])}


def brute_audit(claim, document, facts):
    stop, numbers = set(X.CLAIM_STOP), re.findall(r"-?[0-9,]+(?:\.[0-9]+)?", claim)
    values = [float(x.replace(",", "")) for x in numbers if x.strip(",")]
    value = next((v for v in values if not (v == int(v) and 1900 <= v <= 2100)), values[0])
    words = [w for w in re.findall("[a-z]{3,}", claim.lower()) if w not in stop]
    depth = lambda key: next((i for i, w in enumerate(words) if w not in key.lower()), len(words))
    own = sorted((f for f in facts if f["document"] == document and f["key"] is not None and words and depth(f["key"])), key=lambda f: f["fact_id"])
    best = [f for f in own if depth(f["key"]) == max(depth(g["key"]) for g in own)][:25]
    same = [f for f in best if f["value_num"] is not None and abs(f["value_num"] - value) <= 1e-9]
    said = set(words) | set(re.findall(r"\b(?:19|20)[0-9]{2}\b", claim))
    near = sorted(best, key=lambda f: -sum(w in f"{f['key']} {f['period'] or ''}".lower() for w in said))
    return ("VERIFIED", same[0]["fact_id"]) if same else ("REFUTED", near[0]["fact_id"]) if near else ("UNVERIFIABLE", None)


def test_all_claims_are_audited(spark, tmp_path):
    from quire.plans import answers as plans

    keys, r = ["Net revenue", "Net official transfers", "Fuel stock", "Fuel stock at port", "Costs"], random.Random(4)
    facts = [(i, r.choice(keys), f"{2018 + i % 5}", str(v := r.randint(3000, 3040)), None if i % 11 == 0 else float(v), "hot.pdf" if i % 3 else f"d{i % 4}.pdf") for i in range(240)]
    schema = "fact_id long, key string, period string, value_raw string, value_num double, document string"
    spark.createDataFrame(facts, schema).write.parquet(str(tmp_path / "facts.parquet"))
    rows = spark.createDataFrame(facts, schema).collect()
    claims = plans._claims(spark, str(tmp_path)).collect()
    got = {x["claim_id"]: (x["status"], x["fact_id"]) for x in plans.audit_verdicts(spark, str(tmp_path)).collect()}
    assert len(claims) == len(got) == sum(x[4] is not None for x in facts)
    assert got == {c["claim_id"]: brute_audit(c["claim"], c["document"], rows) for c in claims}


def test_routing(spark):
    cards = spark.createDataFrame([("a", "bulletin-june", ["June EFY 2017"]), ("b", "bulletin-july", ["July EFY 2017"]), ("c", "other", ["2019"])], "doc_id string, source_name string, periods array<string>")
    q = spark.createDataFrame([(1, "What was inflation in July EFY 2017?"), (2, ""), (3, None)], "question_id long, question string")
    got = answers.routed(q, cards).orderBy("question_id", "rank").collect()
    assert [(r["question_id"], r["doc_id"]) for r in got][0] == (1, "b") and got[0]["score"] > got[1]["score"] and {r["question_id"] for r in got} == {1}


def most_rows(df):
    """The most rows that any step of the plan put out when df was collected."""
    def walk(p):
        kind = p.getClass().getSimpleName()
        inner = [p.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [p.plan()] if kind.endswith("QueryStageExec") else []
        m = p.metrics().get("numOutputRows")
        children = p.children()
        return max([m.get().value() if m.isDefined() else 0, *map(walk, inner), *(walk(children.apply(i)) for i in range(children.size()))])

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_routing_in_packs(spark, monkeypatch):
    """Against brute force over several packs and blocks: equal scores go by name, then key, and missing names first."""
    monkeypatch.setattr(answers, "CARD_PACK", 9)
    monkeypatch.setattr(answers, "QUESTION_BLOCK", 6)
    rng = random.Random(3)
    words = ["flour", "wheat", "rent", "2019", "2020", "depot", "the"]
    cards = [(f"k{i:02}", None if i % 11 == 5 else f"file {rng.randrange(6)}", rng.sample(words[:6], rng.randrange(4)) + ["the"], rng.sample(words[3:5], rng.randrange(3))) for i in range(50)]
    asked = [(i, None if i == 7 else " ".join(rng.sample(words, rng.randrange(5)))) for i in range(40)]
    got = answers.routed(spark.createDataFrame(asked, "question_id long, question string"), spark.createDataFrame(cards, "doc_id string, source_name string, fact_keys array<string>, periods array<string>"))
    worth = collections.defaultdict(float)
    for k, name, *lists in cards:
        for field, xs in zip(("source_name", "fact_keys", "periods"), ((name or "").split(), *lists), strict=True):
            for x in set(xs):
                worth[k, x] += answers.WEIGHTS[field]
    df = collections.Counter(x for _, x in worth)
    want = set()
    for i, text in asked:
        scores = [(-round(sum(worth.get((k, x), 0) * math.log((1 + len(cards)) / (1 + df[x])) for x in (text or "").split()), 4), name is not None, name or "", k, name) for k, name, *_ in cards]
        want |= {(i, r + 1, x[3], x[4], -x[0]) for r, x in enumerate(sorted(scores)[:3]) if x[0] < 0}
    assert {(r["question_id"], r["rank"], r["doc_id"], r["source_name"], r["score"]) for r in got.collect()} == want and len(want) > 60


def test_routing_makes_no_row_per_pair(spark):
    cards = spark.range(300).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("report "), "id").alias("source_name"), F.array(F.lit("2019"), F.when(F.col("id") % 50 > 0, "2020").otherwise("2021")).alias("periods"))
    q = spark.range(400).select(F.col("id").alias("question_id"), F.concat(F.lit("What was in report "), "id", F.lit(" of 2020?")).alias("question"))
    got = answers.routed(q, cards)
    assert most_rows(got) < 10_000 and got.count() == 1200  # of 120,000 pairs


def test_routing_accuracy_makes_no_row_per_pair(spark, tmp_path):
    """400 questions over 200 documents of common words, against the SQL."""
    import duckdb

    from quire.plans import navigation as plans

    facts = [fact(i, f"Net item {i % 200} of part {i % 7}", f"{2019 + i // 200 % 2}" if i % 3 else f"Q{1 + i % 4} 2020", str(i), float(i), doc=f"Report {i * 7 % 190}.pdf") for i in range(400)] + [fact(900, "Net item", None, None, None)]
    spark.createDataFrame(facts, FACT).coalesce(1).write.parquet(str(tmp_path / "facts.parquet"))
    spark.createDataFrame([(f"d{i:03}", f"Report {i}.pdf") for i in range(200)], "doc_id string, source_name string").coalesce(1).write.parquet(str(tmp_path / "page_profiles.parquet"))
    got = plans.routing_accuracy(spark, str(tmp_path))
    assert most_rows(got) < 10_000  # of 80,000 pairs
    con = duckdb.connect()
    for t in ("facts", "page_profiles"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    assert {tuple(r) for r in got.select("kind", "questions", "first", "among").collect()} == set(con.execute(plans.SQL["routing_accuracy"]).fetchall())


def records_sent(spark, run):
    """The rows that all stages of run() wrote for a shuffle."""
    sc = spark.sparkContext._jsc.sc()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def stages():
        sc.listenerBus().waitUntilEmpty()
        found = sc.statusStore().stageList(None, False, False, none, None)
        return {(x.stageId(), x.attemptId()): x.shuffleWriteRecords() for x in (found.apply(i) for i in range(found.size()))}

    before = stages().keys()
    run()
    return sum(n for k, n in stages().items() if k not in before)


def test_routing_accuracy_sends_neither_side_once_per_pack(spark, tmp_path, monkeypatch):
    """400 questions in 40 blocks over 190 cards in 19 packs: questions are not sent to each pack, nor packs to each block; against the SQL."""
    import duckdb

    from quire.plans import navigation as plans

    monkeypatch.setattr(answers, "CARD_PACK", 10)
    monkeypatch.setattr(answers, "QUESTION_BLOCK", 10)
    facts = [fact(i, f"Net item {i % 200} of part {i % 7}", f"{2019 + i // 200 % 2}" if i % 3 else f"Q{1 + i % 4} 2020", str(i), float(i), doc=f"Report {i * 7 % 190}.pdf") for i in range(400)] + [fact(900, "Net item", None, None, None)]
    spark.createDataFrame(facts, FACT).coalesce(1).write.parquet(str(tmp_path / "facts.parquet"))
    spark.createDataFrame([(f"d{i:03}", f"Report {i}.pdf") for i in range(190)], "doc_id string, source_name string").coalesce(1).write.parquet(str(tmp_path / "page_profiles.parquet"))
    got = []
    sent = records_sent(spark, lambda: got.extend(plans.routing_accuracy(spark, str(tmp_path)).select("kind", "questions", "first", "among").collect()))
    assert 0 < sent < 14_000
    con = duckdb.connect()
    for t in ("facts", "page_profiles"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    assert {tuple(r) for r in got} == set(con.execute(plans.SQL["routing_accuracy"]).fetchall())


def test_routing_accuracy_asks_every_question_of_every_document(spark, tmp_path):
    """Five documents print one key and period: words of a chunk, a caption and a heading decide among them. Facts without a period ask too."""
    import duckdb

    from quire.plans import navigation as plans

    captioned = lambda f, text: (*f[:6], text, *f[7:])
    facts = [fact(i, "Barley stock", "2023", "1", 1.0, f"n{i}.pdf") for i in (1, 2, 3, 5)] + [captioned(fact(4, "Barley stock", "2023", "1", 1.0, "n4.pdf"), "Table 2: Barley by region")]
    facts += [fact(i, "Rent", "2020", "1", 1.0, f"n{i}.pdf") for i in (6, 7, 8, 9)] + [fact(10, "Oats", None, "1", 1.0, "n2.pdf")]
    made = {
        "facts": (facts, FACT),
        "page_profiles": ([(f"d{i}", f"n{i}.pdf", 1, "native_digital", "") for i in range(1, 10)], "doc_id string, source_name string, page int, origin_type string, domain_hint string"),
        "elements": ([element(i, text="Barley" if i == 5 else "Findings", label="section_header", doc=f"d{i}") for i in range(1, 10)], ELEMENT),
        "chunks": ([(i, f"d{i}", 1, "Barley, barley and barley." if i == 3 else "Nothing.", "text") for i in range(1, 10)], "chunk_id long, doc_id string, chunk_no int, content string, chunk_type string"),
    }
    con = duckdb.connect()
    for t, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    got = {tuple(r) for r in plans.routing_accuracy(spark, str(tmp_path)).select("kind", "questions", "first", "among").collect()}
    assert got == {("dated", 9, 2, 6), ("other", 1, 1, 1), ("ALL", 10, 3, 7)}
    assert got == set(con.execute(plans.WHOLE_SQL["routing_accuracy"]).fetchall())
    ranked = answers.routed(spark.createDataFrame([(1, "What was Barley stock in 2023?")], "question_id long, question string"), plans.tree.whole_cards(spark, str(tmp_path)))
    assert [r["source_name"] for r in ranked.orderBy("rank").collect()] == ["n3.pdf", "n4.pdf", "n5.pdf"]


def test_best_of_a_pack():
    """Against all scores ordered, over three packs of rare and common tokens, with equal scores."""
    import numpy as np

    from quire.operators import routing

    rng = np.random.default_rng(5)
    for size, top in ((3, 3), (64, 1), (700, 5), (3000, 3)):
        packs = []
        for _ in range(3):
            places = {t: np.flatnonzero(rng.random(size) < rng.choice([0.002, 0.05, 0.3, 0.9])).astype(np.int32) for t in range(30)}
            packs.append({t: (x, rng.choice([1.0, 2.5, 4.0], len(x)) * (1 + t % 4)) for t, x in places.items() if len(x)})
        for _ in range(40):
            words = rng.choice(30, rng.integers(1, 9)).tolist()
            best, every = [], []
            for k, held in enumerate(packs):
                total, full = np.empty(-(-size // routing.CHUNK) * routing.CHUNK), np.zeros(size)
                best = routing.scored([routing.Held(*held[w], len(total)) for w in words if w in held], total, best, k, top)
                for w in words:
                    if w in held:
                        full[held[w][0]] += held[w][1]
                every += [(-int(x), k << 33 | i) for i, x in enumerate(np.floor(full * 1e4 + 0.5)) if x > 0]
            assert best == sorted(every)[:top]


# ---- sections ----

def test_parents_at_any_depth(spark):
    levels = [1, 2, 3, 4, 5, 6, 7, 8, 9, 8, 7, 12, 11, 3, 13]
    df = spark.createDataFrame([("d", i, x, f"t{i}") for i, x in enumerate(levels)] + [("e", 0, 9, "x"), ("e", 1, 10, None), (None, 0, 1, "y")], "doc_id string, section_no long, level int, title string")
    got = {(r["doc_id"], r["section_no"]): r["parent_no"] for r in sections.parents(df).collect()}
    want = {("d", i): max((j for j in range(i) if levels[j] < x), default=None) for i, x in enumerate(levels)}
    assert got == want | {("e", 0): None, ("e", 1): 0, (None, 0): None}


def test_sections_and_chunks(spark):
    t = (["Item", "Value"], [["Revenue", "4.2"]], None, None)
    rows = [element(0, text="Opening words of the report."), element(1, text="1 Finance", size=18.0), element(2, text="Body one. " * 8), element(3, text="1.1 Revenue", size=14.0), element(4, "table", table=t), element(5, text="Body two. " * 8), element(6, text="2 Operations", size=18.0), element(7, "figure", caption="Figure 3: Trend"), element(8, "furniture", text="Page 1"), element(9, text="Body three. " * 20)]
    e = spark.createDataFrame(rows, ELEMENT)
    s = {r["title"]: r for r in sections.parents(sections.sections(e)).collect()}
    assert set(s) == {"Preamble", "1 Finance", "1.1 Revenue", "2 Operations"} and s["1.1 Revenue"]["parent_no"] == s["1 Finance"]["section_no"] and s["2 Operations"]["parent_no"] is None
    c = sections.chunk_elements(e, 40).collect()
    assert "\n\n" not in c[0]["content"] and {r["parent_section"] for r in c} == {"Preamble", "1 Finance", "1 Finance > 1.1 Revenue", "2 Operations"} and all(r["page_refs"] == [1] and r["bbox"]["page"] == 1 for r in c)
    used = sorted(i for r in c for i in r["elements"])
    assert used == [0, 2, 4, 5, 7, 9]
    assert {r["chunk_type"] for r in c} == {"text", "table", "figure"} and any(r["content"].startswith("Item | Value") for r in c)


def test_headless_documents_have_page_sections(spark):
    e = spark.createDataFrame([element(i, text="Plain paragraph.", page=p) for i, p in enumerate((1, 10, 11, 25))], ELEMENT)
    assert sorted(r["title"] for r in sections.sections(e).collect()) == ["Pages 1-10", "Pages 11-20", "Pages 21-25"]


def test_tables_split_and_captions_bind(spark):
    """An oversized table in parts with its header, debris alone as text, captions with the nearest figures in order, each once."""
    big = (["Item", "Value"], [[f"row {i}", str(i)] for i in range(60)], None, None)
    debris = (["one"], [["x"]], None, None)
    rows = [element(0, text="1 Heading", size=18.0), element(1, text="Words."), element(2, "table", table=big), element(3, "table", table=debris), element(4, text="After."), element(5, "figure", y0=100.0, y1=180.0), element(6, text="Figure 3: Trend ", y0=190.0, y1=200.0), element(7, "figure", y0=205.0, y1=260.0), element(8, "figure", y0=400.0, y1=480.0, caption=""), element(9, text="Words.", page=2)]
    c = sorted(sections.chunk_elements(spark.createDataFrame(rows, ELEMENT), 60).collect(), key=lambda r: r["chunk_no"])
    parts = [r for r in c if r["content"].startswith("[part ")]
    assert [r["chunk_no"] for r in c] == list(range(len(c))) and len(parts) == 3 and all(r["content"].split("\n")[1] == "Item | Value" and r["tokens"] <= 90 for r in parts)
    assert sum(r["content"].count("\nrow ") for r in parts) == 60
    rest = [(r["chunk_type"], r["content"], r["elements"]) for r in c if r not in parts]
    assert rest == [("text", "Words.", [1]), ("text", "one\nx", [3]), ("text", "After.", [4]), ("figure", "Figure 3: Trend", [5]), ("figure", "figure", [7]), ("figure", "figure", [8]), ("text", "Words.", [9])]
    e = spark.createDataFrame(rows, ELEMENT)
    assert sections.bookkeeping(e, sections.chunk_elements(e, 60)).count() == 0
    assert sections.chunk_elements(e.limit(0)).count() == 0


def test_nodes_and_paths(spark):
    rows = [element(0, text="Opening by Audit Services Corporation. Two. Three."), element(1, text="1 A", size=18.0), element(2, text="The Audit  Services Corporation met Abebe Bikila. Yes."), element(3, text="1.1 B", size=14.0), element(4, "table", table=(["a", "b"], [["c", "1"]], None, None))]
    e = spark.createDataFrame(rows, ELEMENT)
    tree = sections.parents(sections.sections(e))
    n = {r["title"]: r for r in sections.nodes(sections.chunk_elements(e), tree).collect()}
    assert n["Preamble"]["summary"] == "Opening by Audit Services Corporation. Two." and n["1 A"]["key_entities"] == ["Audit Services Corporation", "Abebe Bikila"]
    assert n["1.1 B"]["summary"] == "" and n["1.1 B"]["data_types"] == ["table"] and n["1.1 B"]["key_entities"] == []
    assert {(r["path"], r["depth"]) for r in tree.collect()} == {("Preamble", 0), ("1 A", 0), ("1 A > 1.1 B", 1)}


def test_furniture(spark):
    rows = [element(p, text="Header", page=p, y0=20.0, y1=34.0) for p in range(1, 11)] + [element(100 + p, text="Body", page=p, y0=100.0 + 7 * p, y1=120.0 + 7 * p) for p in range(1, 11)] + [element(200 + p, text="Header", page=p, doc="two") for p in (1, 2)]
    assert sorted(r["element_id"] for r in sections.furniture(spark.createDataFrame(rows, ELEMENT)).collect()) == list(range(1, 11))


def test_chunk_rules_and_references(spark):
    rows = [(1, "d", 0, "text", "as Table 1 and Figure 2 show", "s", [1]), (2, "d", 1, "table", "Table 1: a | b", " ", [1]), (3, "d", 2, "figure", "x", None, []), (4, "d", 3, "figure", "y", "s", [2]), (5, "d", 4, "text", "z" * 5000, "s", [1]), (6, "d", 5, "text", None, "s", None)]
    c = spark.createDataFrame(rows, "chunk_id long, doc_id string, chunk_no int, chunk_type string, content string, parent_section string, page_refs array<int>")
    assert {tuple(r) for r in sections.violations(c).collect()} == {(2, "no_parent_section"), (3, "no_parent_section"), (3, "no_page"), (5, "over_limit"), (6, "empty_content"), (6, "no_page")}
    assert {tuple(r) for r in sections.references(c).collect()} == {(1, "Table 1", 2), (1, "Figure 2", 4)}
    df = spark.createDataFrame([("The Audit Services Corporation met. One here. Two here. Three.",)], "t string")
    r = df.select(sections.entities(F.col("t")).alias("e"), sections.summary(F.col("t")).alias("s")).first()
    assert r["e"] == ["Audit Services Corporation"] and r["s"] == "The Audit Services Corporation met. One here."


# ---- coverage ----

def test_regions_and_otsu(spark):
    cells = [(1, r, c) for r in range(10, 40) for c in range(10, 40)] + [(1, r, c) for r in (60, 61) for c in (60, 61)]
    masks = {}
    for _, r, c in cells:
        masks[r] = masks.get(r, 0) | 1 << c
    assert coverage.components(list(masks.items())) == [(10, 10, 40, 40, 900), (60, 60, 62, 62, 4)]
    u = {1: 0b101, 2: 0b101, 3: 0b111, 5: 0b1}
    assert coverage.components(list(u.items())) == [(1, 0, 4, 3, 7), (5, 0, 6, 1, 1)] and coverage.runs(0b1011000110) == [(1, 3), (6, 8), (9, 10)]
    boxes = [((40.0, 40.0, 160.0, 160.0, 1), False), ((40.0, 40.0, 160.0, 80.0, 1), True), ((300.0, 300.0, 304.0, 304.0, 1), False)]
    grid = coverage.box_rows(spark.createDataFrame([(1, *b) for b in boxes], f"page int, {BBOX}, claims boolean"), ["page"], 400.0, 400.0, 100, 100, {"ink": F.lit(True), "claimed": F.col("claims")})
    a = coverage.assessed(grid, ["page"]).first()
    assert (a["inked"], a["covered"], a["escalate"]) == (901, 300, True)
    got = coverage.residual_regions(grid, ["page"], 4.0, 4.0, 1000.0).collect()
    assert len(got) == 1 and (got[0]["x0"], got[0]["y0"], got[0]["x1"], got[0]["y1"], got[0]["cells"]) == (40.0, 80.0, 160.0, 160.0, 600)
    # An L whose box is large enough and whose cells are not.
    l_shape = [((0.0, 0.0, 80.0, 4.0, 1), False), ((0.0, 0.0, 4.0, 80.0, 1), False)]
    grid = coverage.box_rows(spark.createDataFrame([(1, *b) for b in l_shape], f"page int, {BBOX}, claims boolean"), ["page"], 400.0, 400.0, 100, 100, {"ink": F.lit(True), "claimed": F.col("claims")})
    assert coverage.residual_regions(grid, ["page"], 4.0, 4.0, 900.0).count() == 0 and coverage.residual_regions(grid, ["page"], 4.0, 4.0, 600.0).count() == 1
    levels = [("p", 10)] * 50 + [("p", 200)] * 50 + [("flat", 7)] * 9
    t = {r["k"]: r["threshold"] for r in coverage.otsu(spark.createDataFrame(levels, "k string, bin int"), ["k"]).collect()}
    assert t == {"p": 10, "flat": -1}


def test_claims_and_twins(spark):
    full = dict(x0=0.0, y0=0.0, x1=612.0, y1=792.0)
    t = (["a", "b"], [["1", "2"]], None, None)
    rows = [element(1, text="all", **full), element(2, "figure", page=2, **full), element(3, "figure", page=3, **full), element(4, text="beside", page=3)]
    got = {r["element_id"]: r["valid"] for r in coverage.valid_claims(spark.createDataFrame(rows, ELEMENT), 612.0 * 792.0).collect()}
    assert got == {1: False, 2: False, 3: True, 4: True}
    rows = [element(1, "table", table=t, x0=50.0, y0=100.0, x1=550.0, y1=700.0), element(2, "table", table=t, x0=55.0, y0=110.0, x1=545.0, y1=690.0, rung="C"), element(3, "table", table=t, x0=50.0, y0=710.0, x1=550.0, y1=780.0, rung="C"), element(4, text="in", x0=60.0, y0=120.0, x1=100.0, y1=130.0), element(5, text="out", x0=60.0, y0=10.0, x1=100.0, y1=30.0)]
    e = spark.createDataFrame(rows, ELEMENT)
    assert [r["element_id"] for r in coverage.without_twins(e).collect()] == [3] and [r["element_id"] for r in coverage.outside_tables(e).collect()] == [5]


def test_escalation_labels(spark):
    pages = spark.createDataFrame([("d", 1, "A"), ("d", 2, "A"), ("d", 3, "C"), ("d", 4, "C")], "doc_id string, page int, start string")
    a = spark.createDataFrame([("d", 1, 0.95, False), ("d", 2, 0.2, False)], "doc_id string, page int, coverage double, insane boolean")
    b = spark.createDataFrame([("d", 2, 0.9, False)], "doc_id string, page int, coverage double, insane boolean")
    c = spark.createDataFrame([("d", 3, 2, 0.9)], "doc_id string, page int, regions int, coverage double")
    assert {r["page"]: r["label"] for r in coverage.escalated(pages, a, b, c).collect()} == {1: "A", 2: "A→B", 3: "C(2)", 4: "C-unavailable"}


# ---- pages and ledger ----

def test_page_rules(spark):
    p = spark.createDataFrame([("a", 1, "scanned_image"), ("a", 2, "native_digital"), ("b", 1, "scanned_image"), ("c", 1, None)], "doc_id string, page int, origin_type string")
    assert {r["doc_id"]: r["dominant_origin"] for r in triage.dominant_origin(p).collect()} == {"a": "mixed", "b": "scanned_image", "c": None}
    df = spark.createDataFrame([(0.1, 0.9), (3.0, 0.1), (0.2, 0.2)], "d double, i double")
    assert [r["o"] for r in df.select(triage.origin(F.col("d"), F.col("i")).alias("o")).collect()] == ["scanned_image", "native_digital", "mixed"]
    xs = spark.createDataFrame([([10.0] * 6 + [300.0] * 6,), ([10.0] * 6 + [60.0] * 6,), ([1.0],)], "x array<double>")
    assert [r["n"] for r in xs.select(triage.column_starts(F.col("x")).alias("n")).collect()] == [2, 1, 0]


LEDGER = "entry_id long, run_id string, run_seq int, doc_id string, page int, strategy_used string, coverage_residual double, cost_estimate_usd double, arrived_at timestamp"


def rows_of_ledger():
    t = lambda h: datetime.datetime(2024, 1, 1, h)
    return [(1, "r1", 1, "d1", 1, "A", 0.5, 0.3, t(1)), (2, "r1", 2, "d1", 2, "C(1)", 0.5, 0.3, t(2)), (3, "r2", 1, "d1", 1, "A→B", 0.1, 0.3, t(3)), (4, "r2", 2, "d1", 2, "C(2)!budget", float("nan"), None, t(4)), (5, "r2", 1, "d1", 1, "A→B", 0.1, 0.3, t(5))]


def test_ledger(spark):
    df = spark.createDataFrame(rows_of_ledger(), LEDGER)
    assert {r["page"]: r["entry_id"] for r in ledgers.latest_per_page(df).collect()} == {1: 5, 2: 4}
    assert {r["entry_id"] for r in ledgers.latest_run(df).collect()} == {3, 4, 5}
    assert {r["entry_id"] for r in ledgers.without_replays(df).collect()} == {1, 2, 3, 4}
    r = ledgers.rollup(ledgers.latest_per_page(df)).first()
    assert (r["pages"], r["coverage"], r["spend"], r["budget_hit"], r["vision_pages"]) == (2, 0.9, 0.3, True, 1)
    assert {r["entry_id"] for r in ledgers.within_budget(df, 0.3).where("run_id = 'r1'").collect()} == {1}


def test_stream_keeps_the_latest(spark, tmp_path):
    df = spark.createDataFrame(rows_of_ledger(), LEDGER)
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for part in (df.where("entry_id <= 2"), df.where("entry_id > 2")):
        part.coalesce(1).write.mode("append").parquet(src)
        streams.latest_into(spark.readStream.schema(df.schema).parquet(src), out, ck).awaitTermination()
    got = {(r["page"], r["entry_id"]) for r in streams.read_latest(spark, out).collect()}
    assert got == {(r["page"], r["entry_id"]) for r in streams.latest_by_window(df).collect()} == {(1, 5), (2, 4)}


def test_stream_writes_few_files(spark, tmp_path):
    """Batches over many documents: runs are merged, no file per document or bucket, and a batch that is run again changes nothing."""
    rng = random.Random(7)
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    base, rows = datetime.datetime(2024, 1, 1), []
    for i in range(12):
        new = [(i * 1000 + k, f"d{rng.randrange(120)}", rng.randrange(1, 4), base + datetime.timedelta(minutes=rng.randrange(2000)), f"r{i}") for k in range(200)]
        rows += new
        spark.createDataFrame(new, "entry_id long, doc_id string, page int, arrived_at timestamp, run_id string").coalesce(1).write.mode("append").parquet(src)
    df = spark.read.parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    want = {(r["doc_id"], r["page"], r["entry_id"]) for r in streams.latest_by_window(spark.createDataFrame(rows, df.schema)).collect()}
    for lost in ((), ("11", ".11.crc")):  # as it ended, and with the last batch run again
        for f in lost:
            (tmp_path / "ck" / "commits" / f).unlink()
        streams.latest_into(stream, out, ck).awaitTermination()
        got = [(r["doc_id"], r["page"], r["entry_id"]) for r in streams.read_latest(spark, out).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert len(list((tmp_path / "out").glob("v*/**/*.parquet"))) <= 12 * 4
    assert len(json.loads(sorted((tmp_path / "out").glob("manifest-*.json"))[-1].read_text())) < 8


# ---- vectors, stores, agent ----

def test_vectors(spark):
    df = spark.createDataFrame([(1, "Net official transfers"), (2, "net  official TRANSFERS"), (3, ""), (4, None)], "id long, t string")
    v = vectors.hash_buckets(df, "id", "t", 64).collect()
    one = {r["bucket"]: r["weight"] for r in v if r["id"] == 1}
    assert one == {r["bucket"]: r["weight"] for r in v if r["id"] == 2} and abs(sum(w * w for w in one.values()) - 1) < 1e-9 and {r["id"] for r in v} == {1, 2}
    e = spark.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(5)], "vec_id long, embedding array<float>, label int")
    assert [r["vec_id"] for r in vectors.nearest(e, [1.0, 4.0], 2).collect()] == [4, 3]
    assert [r["vec_id"] for r in vectors.nearest(e, [1.0, 4.0], 2, F.col("label") == 1).collect()] == [3, 1]
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in vectors.nearest_all(e, e.where("vec_id = 4"), 2, pack=2).collect()}
    assert got == {(4, 1): 3, (4, 2): 2}


def test_all_chunks_are_embedded(spark, tmp_path):
    from quire.plans import retrieval

    rows = [(1, "figure", "Figure 1:  Trend"), (2, "text", "ሰላም ለዓለም 😀 abc"), (3, "table", "a | b\nc | d"), (4, "list", "- one\n- two " * 9000), (5, "text", "ab"), (6, "text", None)]
    spark.createDataFrame(rows, "chunk_id long, chunk_type string, content string").write.parquet(str(tmp_path / "chunks.parquet"))
    want = {}
    for i, _, t in rows:
        t = re.sub(r"\s+", " ", (t or "").lower()).strip()
        c = collections.Counter(int(hashlib.md5(t[j : j + k].encode()).hexdigest()[-4:], 16) % 256 for k in (3, 5) for j in range(len(t) - k + 1))
        norm = sum(x * x for x in c.values()) ** 0.5
        want |= {(i, b): pytest.approx(x / norm, abs=1e-6) for b, x in c.items()}
    assert {(r["chunk_id"], r["bucket"]): r["weight"] for r in retrieval.hash_embedding(spark, str(tmp_path)).collect()} == want


def test_stores(spark, tmp_path, monkeypatch):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.txt").write_text("x")
    assert stores.files(spark, str(tmp_path / "f")).first()["doc_id"] == "2d711642b726b044"
    store = stores.Artifacts(spark, str(tmp_path / "art"))
    assert store.ids("tree") == [] and store.get("tree", "d1") is None
    row = lambda d, n: spark.createDataFrame([("tree", d, json.dumps({"pages": n}))], "kind string, doc_id string, body string")
    store.put(row("d2", 3))
    store.put(row("d1", 3))
    store.put(row("d1", 4))
    assert store.ids("tree") == ["d1", "d2"] and store.get("tree", "d1") == {"pages": 4}
    reply = 'Here: {"elements": [{"kind": "text", "text": "ok"}, {"kind": "text", "text": " "}, {"kind": "table", "headers": ["a", "b"], "rows": [["1", "2"]]}, {"kind": "table", "headers": ["a"], "rows": [["1", "2"]]}, {"kind": "odd"}]} done'
    got = stores.vision_elements(spark.createDataFrame([(1, reply), (2, "no json"), (3, None)], "region_id long, payload string")).collect()
    assert [(r["region_id"], r["kind"]) for r in got] == [(1, "text"), (1, "table")]
    env = tmp_path / ".env"
    env.write_text("A_Q=1\nB_Q='two'\n# c\nbad\n")
    monkeypatch.setenv("A_Q", "kept")
    assert stores.load_env(str(env)) == 1
    assert len(stores.questions({"tuning": {"answerable": [{"q": 1}], "adversarial": None}})) == 1
    for docs in (["a"], ["b"], ["a"]):
        stores.replace_documents(spark.createDataFrame([(d, i) for d in docs for i in range(3)], "document string, v int"), str(tmp_path / "facts"))
    assert spark.read.parquet(str(tmp_path / "facts")).count() == 6
    (tmp_path / "m.csv").write_text("doc,v\na,1.5\nb,None\nc,\n")
    assert stores.csv_metrics(spark, str(tmp_path / "m.csv"), "doc string, v double").where("v is null").count() == 2


def test_agent_outcomes():
    rows = [{"content_hash": "h1", "value": 1}]
    say = lambda **k: {"final": "text " + json.dumps(k)}
    tools = {"find": lambda: rows, "broken": lambda: 1 / 0}

    def script(*steps):
        it = iter(steps)
        return lambda q, log: next(it)

    ok = agent.run(script({"tool": "broken"}, {"tool": "find"}, say(answer="It is 1 [1]", citations=["h1"])), tools, "q")
    assert ok.status == "answered" and ok.citations == ["h1"] and "error" in ok.log[0][2]
    assert agent.run(script({"tool": "find"}, say(answer="x", citations=["bad"]), say(answer="x", citations=["h1"])), tools, "q").status == "answered"
    assert agent.run(script({"tool": "find"}, say(answer="x", citations=["bad"]), say(answer="x", citations=["bad"])), tools, "q").status == "citation_error"
    none = agent.run(script(say(status="not_found", answer="no [1]", citations=["h1"])), tools, "q")
    assert none.status == "not_found" and none.answer == "no" and none.dropped == 1
    assert agent.run(lambda q, log: {"tool": "find"}, tools, "q", 3).status == "no_convergence"
    assert agent.run(script({"final": "no json"}), tools, "q").status == "not_found"


def test_citations(spark, facts):
    c = spark.createDataFrame([(1, "h1"), (2, "zz")], "answer_id long, content_hash string")
    assert {r["answer_id"]: r["found"] for r in agent.resolved(c, facts).collect()} == {1: True, 2: False}
    df = spark.createDataFrame([("a [1]", ["x"]), ("a [2]", ["x"]), ("a", [])], "t string, c array<string>")
    assert [r["ok"] for r in df.select(agent.markers_ok(F.col("t"), F.col("c")).alias("ok")).collect()] == [True, False, True]


# ---- navigation ----

def test_navigation(spark):
    tree = sections.parents(spark.createDataFrame([("d", 0, "Preamble", 1), ("d", 1, "4. Finance", 1), ("d", 2, "4.1 Tax", 2), ("d", 3, "Finance", 3), ("d", 4, "Tax", 3), ("d", 5, "finance ", 1)], "doc_id string, section_no long, title string, level int"))
    wanted = spark.createDataFrame([("d", " finance "), ("d", "tax"), ("d", "none")], "doc_id string, wanted string")
    assert {r["wanted"]: (r["section_no"], r["how"]) for r in navigation.found_sections(tree, wanted).collect()} == {" finance ": (5, "exact"), "tax": (4, "exact")}
    assert {(r["root_no"], r["section_no"], r["depth"]) for r in navigation.descendants(tree).collect()} == {(0, 0, 0), (1, 1, 0), (1, 2, 1), (1, 3, 2), (1, 4, 2), (5, 5, 0)}
    e = spark.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(5)], "vec_id long, embedding array<float>, label int")
    inside, wide = (navigation.search(e, [1.0, 4.0], 1, F.col("label") == x).first() for x in (1, 9))
    assert (inside["vec_id"], inside["note"]) == (3, None) and wide["vec_id"] == 4 and wide["note"]


def test_captions_are_taken_once(spark):
    rows = [element(1, "figure", y0=300.0, y1=380.0), element(2, "figure", y0=300.0, y1=380.0), element(3, text="Figure 3: a", y0=390.0, y1=400.0), element(4, text="Fig.4 b", y0=385.0, y1=395.0), element(5, text="prose", y0=381.0, y1=385.0)]
    e = spark.createDataFrame(rows, ELEMENT).selectExpr("*", "0 as section_no", "bbox.page", "bbox.y0", "bbox.y1")
    assert {tuple(r) for r in sections.bound_captions(e).collect()} == {(1, 3, "Figure 3: a"), (2, 4, "Fig.4 b")}


def test_siblings_labels_and_tallies(spark, facts):
    c = spark.createDataFrame([(1, "revenue was 3,300", "report.pdf"), (2, "revenue was 9,999", "report.pdf"), (3, None, "report.pdf")], "claim_id long, claim string, document string")
    assert [tuple(r) for r in navigation.printed_elsewhere(c, facts).collect()] == [(1, "other.pdf")]
    t = spark.createDataFrame([("report.pdf", "RE-VENUE", 4200.0), ("report.pdf", "Costs", 1.0), ("report.pdf", "Nothing", 1.0)], "document string, label string, value double")
    assert {r["label"]: (r["found"], r["ok"]) for r in navigation.matched_labels(t, facts).collect()} == {"RE-VENUE": (True, True), "Costs": (True, False), "Nothing": (False, False)}
    ranked = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (2, "b", 2)], "question_id long, source_name string, rank int")
    truth = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "y")], "question_id long, document string, kind string")
    assert {r["kind"]: (r["questions"], r["first"], r["among"]) for r in navigation.routing_tally(ranked, truth).collect()} == {"x": (1, 1, 1), "y": (2, 0, 1), "ALL": (3, 1, 2)}


def test_ink(spark):
    px = [(1, y, x, 20 if y < 4 and x < 4 else 240) for y in range(10) for x in range(10)] + [(2, y, x, 255) for y in range(8) for x in range(8)]
    assert [tuple(r) for r in navigation.ink_cells(spark.createDataFrame(px, "page int, y int, x int, gray int"), ["page"], 4).collect()] == [(1, 0, 0)]

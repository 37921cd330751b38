"""Sources and sinks: layout rows, rules, truth files, facts by document, runs, points, the bound tools and their events."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import agent, coverage, navigation, sections, tables, triage, vectors
from quire.sources import layout, rules, stores

FACT = "fact_id long, key string, period string, value_raw string, value_num double, unit string, context string, document string, page int, x0 double, y0 double, x1 double, y1 double, content_hash string"
CHUNK = "chunk_id long, doc_id string, chunk_no int, content string, chunk_type string, page_refs array<int>, bbox struct<x0: double, y0: double, x1: double, y1: double, page: int>, parent_section string, content_hash string, created_at timestamp"


def test_layout_rows(spark):
    item = "doc_id string, n int, kind string, label string, text string, grid array<array<string>>, caption string, left double, top double, right double, bottom double, origin string, page int"
    grid = [["Item", "Value"], ["Revenue", "4.2"]]
    rows = [("d", 1, "text", "text", " Low ", None, None, 72.0, 640.0, 500.0, 600.0, "BOTTOMLEFT", 1), ("d", 2, "text", "page_header", "Head", None, "x", 72.0, 20.0, 300.0, 34.0, "TOPLEFT", 1), ("d", 3, "text", "text", "  ", None, None, 1.0, 1.0, 2.0, 2.0, None, 1),
            ("d", 4, "table", None, None, grid, "", 72.0, 300.0, 500.0, 400.0, None, 1), ("d", 5, "table", None, None, [["a", "b"], ["c"]], None, 72.0, 300.0, 500.0, 400.0, None, 1), ("d", 6, "table", None, None, [], None, 1.0, 1.0, 2.0, 2.0, None, 1), ("d", 7, "picture", None, None, None, "Figure 1", 72.0, 500.0, 500.0, 600.0, None, 1),
            ("d", 8, "picture", None, None, None, None, 500.0, 1.0, 72.0, 2.0, None, 1), ("d", 9, "text", None, "flat", None, None, 1.0, 5.0, 2.0, 9.0, "BOTTOMLEFT", 1), ("d", 10, "text", None, "two", None, None, 1.0, 5.0, 2.0, 9.0, None, 2), ("d", 11, None, None, None, None, None, None, None, None, None, None, 2)]
    pages = spark.createDataFrame([("d", 1, 792.0), ("d", 2, 792.0)], "doc_id string, page int, height double")
    got = layout.adapted(spark.createDataFrame(rows, item), pages).orderBy("idx").collect()
    assert [(r["idx"], r["kind"], r["text"], r["caption"]) for r in got] == [(0, "furniture", "Head", None), (1, "text", "Low", None), (2, "table", None, None), (3, "figure", None, "Figure 1"), (4, "text", "two", None)]
    assert (got[1]["bbox"]["y0"], got[1]["bbox"]["y1"]) == (152.0, 192.0) and got[2]["table_data"]["headers"] == ["Item", "Value"] and got[2]["table_data"]["rows"] == [["Revenue", "4.2"]]
    assert layout.adapted(spark.createDataFrame([], item), pages).count() == 0


def test_rules(tmp_path):
    f = tmp_path / "rules.yaml"
    f.write_text("# limits\ncoverage:\n  tau: 0.85  # share\n\nbudget:\n  per_document: 0.5\n")
    assert rules.read_rules(str(f)) == {"coverage.tau": 0.85, "budget.per_document": 0.5}
    for bad in ("coverage:\n  tao: 1\n", "coverage:\n  tau: high\n", "coverage:\n  tau: 2\n", "- list\n"):
        f.write_text(bad)
        with pytest.raises(rules.BadRules):
            rules.read_rules(str(f))


def test_truth_and_measure(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"document": "cpi.pdf", "page": 2, "columns": ["General", "Food"], "rows": {"March": [13.5, 11.7], "July-EFY 2016": [18.6], "Gone": [1.0]}}))
    (tmp_path / "b.json").write_text("[]")
    truth = rules.truth_cells(spark, str(tmp_path))
    assert {tuple(r) for r in truth.collect()} == {("cpi.pdf", 2, "March", 0, 13.5), ("cpi.pdf", 2, "March", 1, 11.7), ("cpi.pdf", 2, "July-EFY 2016", 0, 18.6), ("cpi.pdf", 2, "Gone", 0, 1.0)}
    facts = [(1, "General", "March", "13.5", 13.5), (2, "Food", "March", "11.9", 11.9), (3, "General", "July EFY 2016", "18.6", 18.6), (4, "Food", None, "x", None)]
    f = spark.createDataFrame([(*r, None, None, "cpi.pdf", 2, None, None, None, None, None) for r in facts], FACT)
    assert [tuple(r) for r in rules.measured_cells(truth, f).collect()] == [("cpi.pdf", 2, 4, 2, 1)]


def test_documents_are_replaced_with_counts(spark, tmp_path):
    folder = str(tmp_path / "facts")
    row = lambda i, doc, key: (i, key, None, "1", 1.0, None, None, doc, 1, 0.0, 0.0, 1.0, 1.0, "h")
    one = spark.createDataFrame([row(1, "a", "k"), row(2, "a", "k"), row(3, "b", "k"), row(4, None, "k")], FACT)
    assert {tuple(r) for r in stores.replace_documents(one, folder).collect()} == {("a", 1, 1, 0), ("b", 1, 0, 0)}
    assert {tuple(r) for r in stores.replace_documents(spark.createDataFrame([row(5, "a", "x"), row(6, "a", "y")], FACT), folder).collect()} == {("a", 2, 0, 1)}
    assert {(r["document"], r["key"]) for r in spark.read.parquet(folder).collect()} == {("a", "x"), ("a", "y"), ("b", "k")}


def test_runs_are_numbered_and_added_once(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    df = spark.createDataFrame([("d", 2, 9), ("d", 1, 8), ("d", 1, 7), ("c", 5, 6)], "doc_id string, page int, entry_id long")
    assert {(r["entry_id"], r["run_seq"]) for r in stores.append_run(df, folder, "r1", ["entry_id"]).collect()} == {(6, 1), (7, 2), (8, 3), (9, 4)}
    assert stores.append_run(df, folder, "r1", ["entry_id"]).count() == 0 and stores.append_run(df, folder, "r2", ["entry_id"]).count() == 4
    assert spark.read.parquet(folder).groupBy("run_id").count().count() == 2 and spark.read.parquet(folder).count() == 8


def test_budget_and_salvage(spark):
    rows = [("d", 1, 0, 0.2, 3), ("d", 1, 1, 0.2, 1), ("d", 2, 0, 0.2, 5), ("d", 2, 1, 0.2, 7), ("d", 3, 0, None, None), ("e", 1, 0, None, None), ("e", 1, 1, 9.0, 1)]
    df = spark.createDataFrame(rows, "doc_id string, page int, region_no int, cost double, gained int")
    assert {(r["doc_id"], r["page"]): (r["label"], r["cost"]) for r in coverage.budgeted(df, 0.5).collect()} == {("d", 1): ("C(2)", 0.4), ("d", 2): ("C(5)!budget", 0.2), ("d", 3): ("C(0)!budget", 0.0), ("e", 1): ("C(2)", 9.0)}
    t = "element_id long, doc_id string, idx int, kind string, source_rung string, bbox struct<page: int>, table_data struct<context: string>"
    e = spark.createDataFrame([(1, "d", 0, "table", "A", (1,), ("",)), (2, "d", 1, "table", "A", (1,), ("saved",)), (3, "d", 2, "table", "C", (1,), (None,)), (4, "d", 3, "table", "C", (2,), None), (5, "d", 4, "table", "B", (1,), ("own",))], t)
    assert {r["element_id"]: r["context"] for r in coverage.salvaged(e).collect()} == {1: "saved", 2: "saved", 3: "saved", 4: None, 5: "own"}


@pytest.fixture(scope="module")
def corpus(spark):
    box = (1.0, 2.0, 3.0, 4.0, 1)
    rows = [(1, "d", 0, "Revenue rose in the fiscal year.", "text", [1], box, "4. Finance", "h1", None), (2, "d", 1, "A chart of the prices.", "figure", [2], box, "4. Finance > 4.1 Tax", "h2", None), (3, "e", 0, "Revenue rose in the fiscal year too.", "text", [1], None, "4. Finance", "h3", None), (4, "d", 0, "Revenue rose in the fiscal year.", "text", [1], box, "4. Finance", "h1", None)]
    return vectors.points(spark.createDataFrame(rows, CHUNK))


def test_points_and_scopes(spark, corpus):
    p = {r["content_hash"]: r for r in corpus.collect()}
    assert len(p) == 3 and all(r["point_id"] == str(uuid.uuid5(uuid.NAMESPACE_OID, r["doc_id"] + r["content_hash"])) for r in p.values()) and p["h2"]["ancestors"] == ["4. Finance", "4.1 Tax"]
    find = lambda **how: {r["content_hash"] for r in vectors.search_texts(corpus, "revenue", 6, vectors.scope(**how)).collect()}
    assert find() == {"h1", "h3"} and find(doc_id="d") == {"h1"} and find(section="4.1 Tax") == set() and find(doc_ids=["e"], section="4. Finance") == {"h3"} and find(doc_id="d", doc_ids=["e"]) == {"h1"}
    assert vectors.search_texts(corpus, "", 6).count() == 0 and vectors.search_texts(corpus.limit(0), "revenue").count() == 0
    meta = vectors.guarded(None, "hash", 256)
    assert vectors.guarded(meta, "hash", 256) == meta
    with pytest.raises(vectors.OtherModel):
        vectors.guarded(meta, "hash", 64)


def test_tools_reach_one_document(spark, corpus):
    s = [("d", 1, "4. Finance", 1), ("d", 2, "4.1 Tax", 2), ("e", 1, "Other", 1)]
    tree = sections.parents(spark.createDataFrame([(*x, 1, 3) for x in s], "doc_id string, section_no long, title string, level int, page_start int, page_end int"))
    chunks = spark.createDataFrame([("d", "4. Finance", "text", "Revenue rose. It fell. End.", 1, 0)], "doc_id string, parent_section string, chunk_type string, content string, section_no long, chunk_no int")
    nodes = sections.nodes(chunks, tree)
    facts = spark.createDataFrame([(1, "Revenue", "2023", "4", 4.0, None, None, "d.pdf", 1, 0.0, 0.0, 1.0, 1.0, "f1"), (2, "Revenue", "2023", "5", 5.0, None, None, "e.pdf", 1, 0.0, 0.0, 1.0, 1.0, "f2")], FACT)
    t = agent.tools(nodes, corpus, facts, "d", "d.pdf", lambda r, focus: {"description": r["content"] + focus, "readings": [1]})
    assert t["navigate"]() == {"section": "d.pdf", "pages": [1, 3], "children": [{"title": "4. Finance", "summary": "Revenue rose. It fell.", "pages": [1, 3], "contains": ["text"]}]}
    assert t["navigate"]("4. finance")["children"][0]["title"] == "4.1 Tax" and "error" in t["navigate"]("Finance") and "error" in t["navigate"]("Other")
    loose, gone = t["search"]("revenue", "Finance"), t["search"]("revenue", "Nowhere")
    assert [h["content_hash"] for h in loose["hits"]] == ["h1"] and "4. Finance" in loose["note"] and [h["content_hash"] for h in gone["hits"]] == ["h1"] and "whole document" in gone["note"]
    assert [r["fact_id"] for r in t["query"]("SELECT * FROM facts")["rows"]] == [1] and "error" in t["query"]("DROP TABLE facts")
    seen = t["inspect"]("h2", "!")
    assert seen["estimates"] and seen["description"].endswith("!") and seen["hits"][0]["document"] == "d.pdf" and "error" in t["inspect"]("h1") and "error" in agent.tools(nodes, corpus, facts, "d", "d.pdf")["inspect"]("h2")
    steps = iter([{"tool": "query", "args": {"sql": "SELECT * FROM facts"}}, {"final": json.dumps({"status": "answered", "answer": "4 [1]", "citations": ["f1"]})}])
    a = agent.run(lambda q, log: next(steps), t, "revenue?")
    assert (a.status, a.citations) == ("answered", ["f1"])
    lines = [json.loads(x) for x in agent.events("revenue?", a)]
    assert [x["event"] for x in lines] == ["question", "tool", "answer"] and lines[1]["rows"] == 1
    root = navigation.corpus_root(nodes).first()
    assert (root["children"], root["page_end"], root["summary"], root["data_types"]) == (2, 3, "2 ingested documents", ["text"]) and navigation.corpus_root(nodes.limit(0)).first()["children"] == 0


def test_corpus_search(corpus):
    names = {"d": "d.pdf", "e": "e.pdf"}
    ask = lambda *a, **k: (lambda r: ({h["content_hash"] for h in r["hits"]}, r.get("note")))(agent.corpus_search(corpus, names, "revenue", *a, **k))
    assert ask() == ({"h1", "h3"}, None) and ask("4. Finance") == ({"h1", "h3"}, None) and ask("", doc_ids=["e"]) == ({"h3"}, None)
    assert ask(" E.PDF ")[0] == {"h3"} and "document" in ask("E.pdf")[1] and ask("Nowhere")[0] == {"h1", "h3"} and "all documents" in ask("Nowhere")[1]


def test_receipts_are_read_again(spark):
    e = spark.createDataFrame([("d", "text", (0.0, 0.0, 10.0, 10.0, 1), "was 4,200 birr", None, None), ("d", "table", (20.0, 20.0, 30.0, 30.0, 1), None, (["a"], [["5\n1"]], None, None), None)], "doc_id string, kind string, bbox struct<x0: double, y0: double, x1: double, y1: double, page: int>, text string, table_data struct<headers: array<string>, rows: array<array<string>>, row_periods: array<string>, context: string>, caption string")
    f = [(1, "4,200", 1, 5.0), (2, "4,300", 1, 5.0), (3, "5 1", 1, 25.0), (4, "4,200", 2, 5.0), (5, "4,200", 1, None), (6, None, 1, 5.0), (7, "4,200", 1, 15.0)]
    facts = spark.createDataFrame([(i, None, None, raw, None, None, None, "d.pdf", p, x, x, x and x + 1, x and x + 1, None) for i, raw, p, x in f], FACT)
    names = spark.createDataFrame([("d", "d.pdf")], "doc_id string, document string")
    assert {r["fact_id"]: r["printed"] for r in navigation.reread(facts, names, e).collect()} == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False, 7: False}
    assert facts.select(F.count("*")).first()[0] == 7


def test_general_numbers(spark):
    values = [0.0, 1.0, -2.5, 13.7, 4200.0, 123456.0, 1234567.0, 999999.5, 0.0001, 0.00001234, -0.5, 1e9, 2.5e-7, 1e100, 99999.95, 0.1 + 0.2, 33.0, float("inf"), float("nan"), None]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", X.general(F.col("v")).alias("g")).orderBy("i").collect()
    assert [r["g"] for r in got] == [None if v is None else f"{v:g}" for v in values]


def test_grids_and_lines(spark):
    rows = [(1, ["a", None], [["x", "y"], ["1", "2"]], False), (2, [], [["x", "y"], ["1", None]], False), (3, None, [["x", "y"]], False), (4, ["a", "b"], [["1", "2"]], True), (5, ["a"], [["x", "y"], ["1", "2"]], False), (6, ["a"], [], False)]
    h, r = tables.from_grid(F.col("n"), F.col("g"), F.col("o"))
    got = {x["i"]: (x["h"], x["r"]) for x in spark.createDataFrame(rows, "i int, n array<string>, g array<array<string>>, o boolean").select("i", h.alias("h"), r.alias("r")).collect()}
    assert got == {1: (["a", ""], [["1", "2"]]), 2: (["x", "y"], [["1", ""]]), 3: (["x", "y"], []), 4: (["a", "b"], [["1", "2"]]), 5: (None, None), 6: (None, None)}
    box = "doc_id string, bbox struct<x0: double, y0: double, x1: double, y1: double, page: int>"
    b = spark.createDataFrame([("d", (0.0, 0.0, 100.0, 3.0, 1)), ("d", (0.0, 0.0, 2.0, 300.0, 1)), ("d", (0.0, 0.0, 99.0, 1.0, 1)), ("d", (0.0, 0.0, 200.0, 4.0, 2)), ("d", None)], box)
    assert {(x["page"], x["ruled"]) for x in triage.ruled_lines(b).collect()} == {(1, 2), (2, 0), (None, 0)}
    f = spark.createDataFrame([("d", (-50.0, -50.0, 50.0, 50.0, 1)), ("d", (0.0, 0.0, 900.0, 900.0, 2)), ("d", (50.0, 50.0, 40.0, 60.0, 3))], box)
    assert {x["page"]: x["image_area_ratio"] for x in triage.image_area(f, 100.0, 100.0).collect()} == {1: 0.25, 2: 1.0, 3: 0.0}
    d = spark.createDataFrame([("d", (0.0, 0.0, 40.0, 40.0, 1)), ("d", (40.0, 0.0, 80.0, 40.0, 1)), ("d", (200.0, 200.0, 216.0, 216.0, 1))], box)
    assert [(x["x0"], x["x1"], x["cells"]) for x in coverage.drawn_figures(d, 400.0, 400.0).collect()] == [(0.0, 80.0, 50)]


def test_pages_judged_and_merged(spark):
    box = "page int, bbox struct<x0: double, y0: double, x1: double, y1: double, page: int>, claims boolean"
    rows = [(1, (0.0, 0.0, 100.0, 100.0, 1), False), (1, (0.0, 0.0, 100.0, 20.0, 1), True), (2, (0.0, 0.0, 40.0, 40.0, 2), True)]
    grid = coverage.box_rows(spark.createDataFrame(rows, box), ["page"], 200.0, 200.0, 50, 50, {"ink": F.lit(True), "claimed": F.col("claims")})
    pages = spark.createDataFrame([(1,), (2,), (3,), (3,)], "page int")
    got = {r["page"]: (r["coverage"], r["escalate"], r["regions"], r["area_escalated_pct"]) for r in coverage.judged_pages(pages, grid, ["page"], 200.0, 200.0, 4.0, 4.0).collect()}
    assert got == {1: (0.2, True, 1, 20.0), 2: (1.0, False, 0, 0.0), 3: (1.0, False, 0, 0.0)}
    e = "element_id long, doc_id string, kind string, source_rung string, bbox struct<x0: double, y0: double, x1: double, y1: double, page: int>, text string, table_data struct<headers: array<string>, rows: array<array<string>>>"
    sane, debris = (["a", "b"], [["x", "1"]]), (["a"], [["x"]])
    held = spark.createDataFrame([(1, "d", "table", "A", (50.0, 100.0, 550.0, 700.0, 1), None, sane), (2, "d", "table", "B", (50.0, 100.0, 550.0, 700.0, 2), None, debris)], e)
    gained = spark.createDataFrame([(3, "d", "table", "C", (55.0, 110.0, 545.0, 690.0, 1), None, sane), (4, "d", "table", "C", (50.0, 710.0, 550.0, 780.0, 1), None, sane), (5, "d", "text", "C", (55.0, 110.0, 545.0, 690.0, 1), "t", None), (6, "d", "table", "C", (55.0, 110.0, 545.0, 690.0, 2), None, sane)], e)
    assert {r["element_id"] for r in coverage.merged(held, gained).collect()} == {1, 2, 4, 5, 6}


def test_files_and_prompts(spark):
    wanted = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("a.pdf",)], "source_name string")
    files = spark.createDataFrame([("a.pdf", 2, "/y/a.pdf"), ("a.pdf", 1, "/x/a.pdf"), ("c.pdf", 1, "/x/c.pdf")], "source_name string, rank int, path string")
    assert {tuple(r) for r in stores.located(wanted, files).collect()} == {("a.pdf", "/x/a.pdf"), ("b.pdf", None)}
    p = spark.createDataFrame([("g", "q1", "a.pdf"), ("g", "q2", "z.pdf"), ("h", "q3", None)], "group string, prompt string, document string")
    assert {tuple(r) for r in stores.prompts_listed(p, wanted).collect()} == {("g", 2, 1), ("h", 1, 0)}
    assert spark.range(1).select(stores.model_folder(F.lit("a/b/c")).alias("m")).first()["m"] == "a_b_c"


def test_embeddings_are_made_once(spark, tmp_path):
    folder, asked = str(tmp_path / "cache"), []

    def embed(df):
        asked.append(sorted(r["content_hash"] for r in df.collect()))
        return df.select("content_hash", F.array(F.length("text")).alias("embedding"))

    t = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "yy"), (None, "z")], "content_hash string, text string")
    assert {(r["content_hash"], r["embedding"][0]) for r in stores.embedded(t, folder, "m/1", embed).collect()} == {("a", 1.0), ("b", 2.0)}
    more = t.unionByName(spark.createDataFrame([("c", "zzz")], t.schema)).where("content_hash <> 'b'")
    assert {(r["content_hash"], r["embedding"][0]) for r in stores.embedded(more, folder, "m/1", embed).collect()} == {("a", 1.0), ("c", 3.0)}
    assert stores.embedded(t, folder, "m/2", embed).count() == 2 and asked == [["a", "b"], ["c"], ["a", "b"]]

"""The question loop on the driver: tools over tables, a policy that picks them, citations checked against what was gathered."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 9
MARKER = re.compile(r"\[(\d+)\]")


def outermost_json(text: str) -> dict | None:
    a, z = text.find("{"), text.rfind("}")
    try:
        got = json.loads(text[a : z + 1]) if 0 <= a < z else None
    except ValueError:
        return None
    return got if isinstance(got, dict) else None


def markers_ok(answer: Column, citations: Column) -> Column:
    """Whether all [n] of an answer are within its citations."""
    found = F.transform(F.regexp_extract_all(answer, F.lit(r"\[([0-9]+)\]"), F.lit(1)), lambda m: m.try_cast("int"))
    return F.forall(found, lambda m: F.coalesce((m >= 1) & (m <= F.size(citations)), F.lit(False)))


def without_markers(answer: Column) -> Column:
    return F.trim(F.regexp_replace(answer, r"\s*\[[0-9]+\]", ""))


def resolved(citations: DataFrame, pool: DataFrame) -> DataFrame:
    """Citations (answer_id, content_hash) with document, page and box from the gathered pool, and whether each was found."""
    one = pool.groupBy("content_hash").agg(F.min_by(F.struct("document", "page", "x0", "y0", "x1", "y1"), "fact_id").alias("p"))
    j = citations.join(one, "content_hash", "left")
    return j.select("answer_id", "content_hash", F.col("p").isNotNull().alias("found"), F.col("p.document").alias("document"), F.col("p.page").alias("page"))


def judged(answers: DataFrame) -> DataFrame:
    """question_id, ok: an answerable question needs an answer with the expected text and citations of its document only; an adversarial one none at all."""
    cited = F.size("documents")
    good = (F.col("status") == "answered") & F.coalesce(F.lower("answer").contains(F.lower("expect")), F.lit(False)) & (cited >= 1) & F.forall("documents", lambda x: x == F.col("document"))
    none = (F.col("status") == "not_found") & (cited == 0)
    return answers.select("question_id", "kind", F.when(F.col("kind") == "answerable", good).otherwise(none).alias("ok"))


@dataclass
class Answer:
    answer: str
    status: str
    citations: list[str] = field(default_factory=list)
    log: list[tuple[str, dict, object]] = field(default_factory=list)
    dropped: int = 0


def run(policy: Callable[[str, list], dict], tools: dict[str, Callable[..., object]], question: str, rounds: int = ROUNDS) -> Answer:
    """Ask the policy for a tool call ({"tool", "args"}) or a final text ({"final"}) until it ends or the rounds are used up.

    Rows a tool returns with a content_hash may be cited. One unknown citation or marker is sent back for correction; a second
    ends in citation_error. not_found drops citations. In the last round but one the policy is told to conclude.
    """
    log: list[tuple[str, dict, object]] = []
    known: set[str] = set()
    notes: list[str] = []
    corrected = False
    for n in range(rounds + 1):
        if n == rounds - 1:
            notes.append("conclude now")
        step = policy(question, [*log, *notes])
        if "final" in step:
            got = outermost_json(step["final"])
            if got is None or got.get("status") == "not_found":
                text = MARKER.sub("", (got or {}).get("answer", "")).strip()
                return Answer(text, "not_found", [], log, len((got or {}).get("citations", [])))
            cites = list(got.get("citations", []))
            bad = [c for c in cites if c not in known] or [m for m in MARKER.findall(got.get("answer", "")) if not 1 <= int(m) <= len(cites)]
            if not bad:
                return Answer(got.get("answer", ""), "answered", cites, log)
            if corrected:
                return Answer("", "citation_error", [], log)
            corrected = True
            notes.append(f"unknown citations: {bad}")
            continue
        if n == rounds:
            break
        try:
            result = tools[step["tool"]](**step.get("args", {}))
        except Exception as e:  # a failing tool is an answer to the policy, not an end
            result = {"error": str(e)}
        rows = result if isinstance(result, list) else (result.get("rows") or result.get("hits") or []) if isinstance(result, dict) else []
        known |= {r["content_hash"] for r in rows if isinstance(r, dict) and r.get("content_hash")}
        log.append((step["tool"], step.get("args", {}), result))
    return Answer("", "no_convergence")


#: What a policy is told of the tools: their names and what they take.
TOOLS = {
    "navigate": {"about": "children of a section, or of the whole document where no section is named", "takes": {"path": "a section's title"}, "needs": []},
    "search": {"about": "passages near a text, in a section or in the whole document", "takes": {"query": "the text", "section": "a section's title"}, "needs": ["query"]},
    "query": {"about": "one SELECT over the facts of the document; rows with all columns can be cited", "takes": {"sql": "the statement"}, "needs": ["sql"]},
    "inspect": {"about": "a figure looked at; its readings are estimates", "takes": {"content_hash": "a figure's hash", "focus": "what to look for"}, "needs": ["content_hash"]},
}


def tools(nodes: DataFrame, points: DataFrame, facts: DataFrame, doc_id: str, document: str, look: Callable[[dict, str], dict] | None = None) -> dict[str, Callable[..., dict]]:
    """The four tools, bound to one document: nodes of sections.nodes() (with depth), points of vectors.points(), and the facts.

    Whatever they are asked, they reach that document only. An unknown section falls back to the whole document and says so; a
    title given loosely is named as it stands. `look` describes a figure chunk; without it there is no inspection, and the tool says that.
    """
    from quire.operators import answers, navigation, vectors

    spark = nodes.sparkSession
    mine = nodes.where(F.col("doc_id") == doc_id)
    scoped = points.where(F.col("doc_id") == doc_id)

    def named(title: str) -> dict | None:
        wanted = spark.createDataFrame([(doc_id, title)], "doc_id string, wanted string")
        r = navigation.found_sections(mine, wanted).first()
        return r.asDict() if r else None

    def navigate(path: str = "") -> dict:
        if path.strip():
            at = named(path)
            if at is None or at["how"] != "exact":
                return {"error": f"no section titled {path!r}"}
            own = mine.where(F.col("section_no") == at["section_no"]).first()
            title, pages, kids = own["title"], [own["page_start"], own["page_end"]], mine.where(F.col("parent_no") == at["section_no"])
        else:
            last = mine.agg(F.coalesce(F.max("page_end"), F.lit(1)).alias("p")).first()["p"]
            title, pages, kids = document, [1, last], mine.where("parent_no is null")
        return {"section": title, "pages": pages, "children": [{"title": r["title"], "summary": r["summary"], "pages": [r["page_start"], r["page_end"]], "contains": r["data_types"]} for r in kids.orderBy("section_no").collect()]}

    def shaped(hits: DataFrame) -> list[dict]:
        return [{"content": r["content"][:400], "content_hash": r["content_hash"], "document": document, "pages": r["page_refs"], "bbox": r["bbox"] and [r["bbox"][c] for c in ("x0", "y0", "x1", "y1")], "score": r["score"]} for r in hits.collect()]

    def search(query: str, section: str = "") -> dict:
        at = named(section) if section.strip() else None
        hits = shaped(vectors.search_texts(scoped, query, 6, vectors.scope(section=at["title"] if at else section or None)))
        if not hits and section.strip():
            return {"hits": shaped(vectors.search_texts(scoped, query, 6)), "note": f"nothing in a section {section!r}; the whole document was searched"}
        return {"hits": hits} | ({"note": f"section {section!r} is {at['title']!r}"} if at and at["title"] != section else {})

    def query(sql: str) -> dict:
        return answers.structured(facts, sql, [document])

    def inspect(content_hash: str, focus: str = "") -> dict:
        if look is None:
            return {"error": "figures can't be inspected here"}
        r = scoped.where((F.col("content_hash") == content_hash) & (F.col("chunk_type") == "figure")).first()
        if r is None:
            return {"error": f"{content_hash!r} is no figure of this document"}
        try:
            seen = look(r.asDict(True), focus)
        except Exception as e:
            return {"error": str(e)}
        box = r["bbox"]
        hit = {"content_hash": content_hash, "content": json.dumps(seen)[:400], "document": document, "pages": r["page_refs"], "bbox": box and [box[c] for c in ("x0", "y0", "x1", "y1")]}
        return {"description": seen.get("description", ""), "readings": seen.get("readings", []), "estimates": True, "hits": [hit]}

    return {"navigate": navigate, "search": search, "query": query, "inspect": inspect}


def corpus_search(points: DataFrame, names: dict[str, str], query: str, section: str = "", doc_ids: list[str] | None = None) -> dict:
    """search() over all documents, or over those a question is bound to: a document's name given as the section is that document, said in a note; an unknown section falls back to all of them."""
    from quire.operators import vectors

    def hits(where: Column) -> list[dict]:
        rows = vectors.search_texts(points, query, 6, where).collect()
        return [{"content": r["content"][:400], "content_hash": r["content_hash"], "document": names.get(r["doc_id"], r["doc_id"]), "pages": r["page_refs"], "bbox": r["bbox"] and [r["bbox"][c] for c in ("x0", "y0", "x1", "y1")], "score": r["score"]} for r in rows]

    wanted = section.strip().lower()
    if not wanted:
        return {"hits": hits(vectors.scope(doc_ids=doc_ids))}
    own = [i for i, name in names.items() if name.lower() == wanted and (not doc_ids or i in doc_ids)]
    if own:
        return {"hits": hits(vectors.scope(doc_ids=own)), "note": f"{section!r} is a document; it was searched as a whole"}
    found = hits(vectors.scope(section=section, doc_ids=doc_ids))
    return {"hits": found} if found else {"hits": hits(vectors.scope(doc_ids=doc_ids)), "note": f"nothing in a section {section!r}; all documents were searched"}


def events(question: str, answer: Answer) -> Iterator[str]:
    """A run as lines of JSON, one event each: the question, every tool call with what came of it, and the outcome."""
    def size(result: object) -> int:
        rows = result.get("rows", result.get("hits", result.get("children", []))) if isinstance(result, dict) else result
        return len(rows) if isinstance(rows, list) else 0

    yield json.dumps({"event": "question", "text": question}, ensure_ascii=False)
    for n, (tool, args, result) in enumerate(answer.log, 1):
        failed = result.get("error") if isinstance(result, dict) else None
        yield json.dumps({"event": "tool", "n": n, "tool": tool, "args": args, "rows": size(result)} | ({"error": failed} if failed else {}), ensure_ascii=False, default=str)
    yield json.dumps({"event": "answer", "status": answer.status, "answer": answer.answer, "citations": answer.citations, "dropped": answer.dropped}, ensure_ascii=False)

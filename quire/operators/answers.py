"""Questions over facts: scoped SQL, word lookup, claim audit, and routing of questions to documents."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import dialect
from quire.functions import text as X
from quire.operators import routing
from quire.session import BROADCAST_ROWS, cut, parallelism, shared_folder

ROW_LIMIT, LOOKUP_LIMIT, LISTING_LIMIT, TOP = 50, 25, 1000, 3
#: Columns by which a result row can be cited.
CITED = ("document", "page", "x0", "y0", "x1", "y1", "content_hash")
# How much a token of each field counts in routing.
WEIGHTS = {"periods": 3.0, "fact_keys": 2.0, "table_contexts": 2.0, "sections": 1.0, "key_entities": 1.0, "summary": 1.0, "source_name": 2.0, "frequent_terms": 1.5, "opening": 1.0}

#: Cards that are read together, and questions that read them.
CARD_PACK, QUESTION_BLOCK = 8_192, 20_000


class NotASelect(ValueError):
    """The text is no single SELECT over the facts."""


def guarded(sql: str) -> str:
    if not sql.lstrip().lower().startswith("select"):
        raise NotASelect("only SELECT statements are allowed")
    return sql


def scoped_query(facts: DataFrame, sql: str, documents: list[str] | None = None, limit: int = ROW_LIMIT) -> DataFrame:
    """The statement over a view `facts` that holds only the given documents (None: all; an empty list: none).

    It is read as the dialect that dialect.to_spark() knows, `rowid` being the fact_id. The view is the only relation of a session
    of its own; a statement that reaches for anything else is refused. No view outlives the call: the rows are bound when it returns.
    """
    guarded(sql)
    spark = facts.sparkSession
    sql = dialect.to_spark(sql, facts.columns, "fact_id")
    rows = facts if documents is None else facts.where(F.col("document").isin(documents)) if documents else facts.limit(0)
    own = spark.newSession()
    plan = own._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    reached = set(re.findall(r"UnresolvedRelation \[([^\]]*)\]", plan))
    if reached - {"facts"}:
        raise NotASelect(f"only facts can be queried, not {', '.join(sorted(reached - {'facts'}))}")
    name = "facts_" + uuid.uuid4().hex
    rows.createOrReplaceGlobalTempView(name)
    try:
        own.sql(f"create temporary view facts as select * from global_temp.{name}")
        out = own.sql(sql)
        return out.limit(limit) if limit else out
    finally:
        spark.catalog.dropGlobalTempView(name)


def citable(row: dict) -> bool:
    """Whether a result row says all of where it stands."""
    return all(row.get(c) is not None for c in CITED)


UNCITABLE = "no row says where it stands (" + ", ".join(CITED) + "), so none can be cited; select all columns to answer from them"


def structured(facts: DataFrame, sql: str, documents: list[str] | None = None, limit: int = ROW_LIMIT) -> dict:
    """{"rows": ...} of scoped_query(), with a note where none of them can be cited; {"error": ...} for a statement that can't be run."""
    try:
        rows = [r.asDict() for r in scoped_query(facts, sql, documents, limit).collect()]
    except Exception as e:
        return {"error": str(e)}
    return {"rows": rows} | ({"note": UNCITABLE} if rows and not any(map(citable, rows)) else {})


def rows_for(facts: DataFrame, document: str, limit: int = LISTING_LIMIT) -> DataFrame:
    return facts.where(F.col("document") == document).orderBy("fact_id").limit(limit).select("key", "period", "value_raw", "value_num", "unit", "page")


def lookup(facts: DataFrame, words: list[str], documents: list[str] | None = None, limit: int = LOOKUP_LIMIT) -> DataFrame:
    """Facts whose key contains all words, whatever the case, in order of entry."""
    cond = F.lit(True)
    for w in words:
        cond = cond & F.lower("key").contains(w.lower())
    rows = facts if documents is None else facts.where(F.col("document").isin(documents))
    return rows.where(cond).orderBy("fact_id").limit(limit)


def prefix_depth(words: Column, key: Column) -> Column:
    """How many words, from the first on, the key contains all of."""
    return F.size(F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.forall(F.slice(words, F.lit(1), i), lambda w: key.contains(w))))


def audited(claims: DataFrame, facts: DataFrame, limit: int = LOOKUP_LIMIT, tolerance: float = 1e-9) -> DataFrame:
    """claim_id, status, document, fact_id, printed_value, page, x0, y0, x1, y1, detail for claims (claim_id, claim, document).

    The longest prefix of the claim's words that some key of the document contains names the candidates (the first `limit`
    in order of entry). One with the claimed value verifies the claim; else it is refuted by the candidate that shares
    most words and years with it; without candidates or a value it can't be verified. Many claims are judged in one plan: words
    meet keys in an equality join on the document, and nothing is looped over.
    """
    c = claims.select("claim_id", "claim", "document", X.claim_value(F.col("claim")).alias("value"), X.claim_words(F.col("claim")).alias("words"))
    # Words meet each key of a document once, however many claims say them and facts have it; facts join only under the keys that are
    # kept, and are ranked once for all claims of the same words.
    keys = facts.where("key is not null").select("document", "key").distinct().withColumn("k", F.lower("key"))
    asked = c.where("value is not null and size(words) > 0").select("document", "words").distinct()
    hit = asked.join(keys, "document").where(F.col("k").contains(F.col("words")[0]))
    hit = hit.withColumn("size", prefix_depth(F.col("words"), F.col("k")))
    hit = hit.withColumn("best", F.max("size").over(Window.partitionBy("document", "words"))).where("size = best").drop("k")
    place = [x for x in ("page", "x0", "y0", "x1", "y1") if x in facts.columns]
    hit = hit.join(facts.select("fact_id", "document", "key", "period", "value_raw", "value_num", *place), ["document", "key"])
    hit = hit.withColumn("nth", F.row_number().over(Window.partitionBy("document", "words").orderBy("fact_id"))).where(F.col("nth") <= limit)
    hit = c.where("value is not null").join(hit, ["document", "words"])
    same = F.coalesce(F.abs(F.col("value_num") - F.col("value")) <= tolerance, F.lit(False))
    years = F.regexp_extract_all("claim", F.lit(r"\b(?:19|20)[0-9]{2}\b"), F.lit(0))
    said = F.lower(F.concat_ws(" ", "key", "period"))
    shared = F.size(F.filter(F.array_distinct(F.concat("words", years)), lambda w: said.contains(w)))
    hit = hit.withColumns({"same": same, "shared": shared})
    receipt = F.struct("fact_id", "document", "value_raw", "key", "period", *place)
    at = ["claim_id", "document"]
    judged = hit.groupBy(*at).agg(F.bool_or("same").alias("ok"), F.min_by(receipt, F.when(F.col("same"), F.col("nth"))).alias("proof"), F.min_by(receipt, F.struct((-F.col("shared")).alias("s"), "nth")).alias("near"))
    judged = judged.withColumnsRenamed({"claim_id": "__claim", "document": "__of"})
    out = c.join(judged, (F.col("claim_id") == F.col("__claim")) & (F.col("document") == F.col("__of")), "left")
    status = F.when(F.col("ok").isNull(), "UNVERIFIABLE").when(F.col("ok"), "VERIFIED").otherwise("REFUTED")
    r = F.when(F.col("ok"), F.col("proof")).otherwise(F.col("near"))
    what = F.concat_ws(", ", r["key"], r["period"])
    detail = F.when(F.col("value").isNull(), "the claim states no value").when(F.col("ok").isNull(), "no entry carries its words").when(F.col("ok"), F.concat(F.lit("printed for "), what)).otherwise(F.concat(F.lit("printed is "), r["value_raw"], F.lit(" for "), what))
    return out.select("claim_id", F.col("document").alias("asked"), status.alias("status"), r["document"].alias("document"), r["fact_id"].alias("fact_id"), r["value_raw"].alias("printed_value"), *[r[x].alias(x) for x in place], detail.alias("detail"))


def audited_in(claims: DataFrame, facts: DataFrame, others: bool = True) -> DataFrame:
    """claim_id, status, document, fact_id, printed_value, ..., elsewhere for claims (claim_id, claim, documents), whose documents are in order of rank.

    The first document with an entry for the claim's words decides: what it prints verifies or refutes the claim. `elsewhere` lists, in
    order, the other documents among them that print the claimed value where the deciding one refutes it. A claim without documents, or
    with none that has an entry, can't be verified. Documents listed twice count once, at their first place.
    """
    ranked = claims.select("claim_id", "claim", F.posexplode(F.array_distinct(F.coalesce("documents", F.array().cast("array<string>")))).alias("rank", "document")).where("document is not null")
    a = audited(ranked, facts).join(ranked.select("claim_id", F.col("document").alias("asked"), "rank"), ["claim_id", "asked"])
    fields = [x for x in a.columns if x not in ("claim_id", "asked", "rank")]
    best = a.groupBy("claim_id").agg(F.min_by(F.struct("rank", *fields), F.when(F.col("status") != "UNVERIFIABLE", F.col("rank"))).alias("b"), F.array_sort(F.collect_list(F.when(F.col("status") == "VERIFIED", F.struct("rank", "asked")))).alias("v"))
    out = claims.select("claim_id").join(best, "claim_id", "left")
    note = F.when(F.col("b.status") == "REFUTED", F.transform(F.filter("v", lambda x: x["rank"] != F.col("b.rank")), lambda x: x["asked"]))
    return out.select("claim_id", F.coalesce("b.status", F.lit("UNVERIFIABLE")).alias("status"), *[F.col(f"b.{x}").alias(x) for x in fields if x != "status"], F.coalesce(note, F.array().cast("array<string>")).alias("elsewhere"))


def bound(questions: DataFrame, cards: DataFrame, key: str = "doc_id", name: str = "source_name", top: int = TOP) -> DataFrame:
    """question_id, doc_ids, documents: the documents that a question is bound to, in order of rank; empty where no card shares a token with it."""
    r = routed(questions, cards, key, name, top)
    g = r.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col(key).alias("id"), F.col(name).alias("name")))).alias("r"))
    none = F.array().cast("array<string>")
    out = questions.select("question_id").join(g, "question_id", "left")
    return out.select("question_id", F.coalesce(F.transform("r", lambda x: x["id"].cast("string")), none).alias("doc_ids"), F.coalesce(F.transform("r", lambda x: x["name"]), none).alias("documents"))


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))


def card_tokens(cards: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, field, token of cards: each token once for each field that has it. Array fields are joined, missing ones skipped."""
    have = [c for c in WEIGHTS if c in cards.columns]
    kinds = dict(cards.dtypes)
    text = lambda c: F.array_join(F.col(c), " ") if kinds[c].startswith("array") else F.col(c)
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), tokens(F.coalesce(text(c), F.lit(""))).alias("t")) for c in have])).alias("f")
    return cards.select(key, fields).select(key, "f.field", F.explode("f.t").alias("token"))


def routed(questions: DataFrame, cards: DataFrame, key: str = "doc_id", name: str = "source_name", top: int = TOP) -> DataFrame:
    """question_id, rank, key, name, score: the cards that share the rarest tokens with each question, weighted by field.

    Common tokens give nearly every question a score with nearly every card, so these pairs are no rows. What the tokens are worth lies once
    in the shared folder, by packs of cards; each block of questions reads pack after pack and keeps its best cards, so neither side is
    sent more than once.
    """
    spark = questions.sparkSession
    cards = cut(cards)  # counted, tokenised and joined again
    n, tasks = cards.count(), parallelism(spark)
    df = card_tokens(cards, key).select(key, "token").distinct().groupBy("token").agg(F.count("*").alias("df"))
    df = df.where(F.col("df") < n)  # a token of every card weighs nothing
    idf = F.log((1 + F.lit(float(n))) / (1 + F.col("df")))
    weight = F.element_at(F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv]), F.col("field"))
    # Places follow the order in which equal scores are ranked; their high bits are the pack.
    placed = cards.where(F.col(key).isNotNull()).repartitionByRange(max(1, -(-n // CARD_PACK)), name, key).sortWithinPartitions(name, key)
    placed = cut(placed.withColumn("card", F.monotonically_increasing_id()))
    worth = card_tokens(placed, "card").join(df, "token").groupBy("token", "card").agg(F.sum(weight * idf).alias("worth"))  # fields added up once
    worth = worth.groupBy("token", F.shiftright("card", 33).cast("int").alias("pack")).agg(F.array_sort(F.collect_list(F.struct(F.col("card").bitwiseAND(2**33 - 1).cast("int").alias("place"), "worth"))).alias("held"))

    q = questions.select("question_id", tokens(F.col("question")).alias("tokens")).repartition(tasks, "question_id").groupBy("question_id").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    folder, block = f"{shared_folder(spark).removesuffix('/')}/routing-{uuid.uuid4().hex}", QUESTION_BLOCK

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for asking in routing.blocks(batches, block):
            yield from routing.best_of(asking, folder, top).to_batches()

    try:
        worth.repartition(tasks, "pack").write.partitionBy("pack").parquet(folder)
        near = cut(q.mapInArrow(best, f"question_id {dict(questions.dtypes)['question_id']}, card long, score double, rank long"))
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    named = placed.select("card", key, name)
    return near.join(F.broadcast(named) if n <= BROADCAST_ROWS else named, "card").select(key, "question_id", "score", name, "rank")

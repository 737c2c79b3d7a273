"""Keyword retrieval: BM25, phrases, fuzzy terms, fields with boosts, snippets."""

from __future__ import annotations

from lectern.functions.edits import PREFIX, alignment, word_variants
from lectern.functions.highlights import highlight  # noqa: F401
from lectern.functions.text import col
from lectern.operators.index import MOST_EDITS, Index
from lectern.sources.store import table_path
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K1, B = 1.2, 0.75


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_weight(tf: Column, dl: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    return tf / (tf + k1 * (1 - b + b * dl / avgdl))


def query_terms(queries: DataFrame) -> DataFrame:
    """(qid, term, qtf) of queries (qid, terms array); a term given twice counts twice."""
    return queries.select("qid", F.explode("terms").alias("term")).groupBy("qid", "term").agg(F.count("*").alias("qtf"))


def _scored(index: Index, wanted: DataFrame) -> DataFrame:
    """(qid, doc_id, score) by BM25 of wanted (qid, term, weight), a term's weight multiplying its score.

    Postings of the wanted terms alone are read or made; their statistics come by joins. Partial scores are added up in
    each task before they are shuffled. Spark broadcasts the weights where it finds them small.
    """
    terms = wanted.select("term").distinct()
    weighted = wanted.join(index.term_stats(terms), "term").join(F.broadcast(index.corpus_stats()))  # statistics are one row
    weighted = weighted.select("qid", "term", "avgdl", (F.col("weight") * idf(F.col("n_docs"), F.col("df"))).alias("weight"))
    part = F.col("weight") * bm25_weight(F.col("tf"), F.col("dl"), F.col("avgdl"))
    return index.postings(terms).join(weighted, "term").withColumn("part", part).groupBy("qid", "doc_id").agg(F.sum("part").alias("score"))


def bm25_scores(index: Index, queries: DataFrame) -> DataFrame:
    """(qid, doc_id, score) of documents that hold any term of a query (qid, terms).

    Queries are a table, so that a batch is one plan; one query is a row.
    """
    return _scored(index, query_terms(queries).withColumnRenamed("qtf", "weight"))


def top_k(scores: DataFrame, k: int, by: str = "score", per: str = "qid", key: str = "doc_id", rank: str = "rank") -> DataFrame:
    """The k best of each group, ranked from 1; ties go to the smaller key. Spark cuts each task's rows to k first."""
    w = Window.partitionBy(per).orderBy(F.col(by).desc(), F.col(key).asc())
    return scores.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def phrase_scores(index: Index, queries: DataFrame) -> DataFrame:
    """(qid, doc_id, score) of documents that hold every phrase of a query (qid, phrases), its words next to one another
    and in order. The score is BM25 with each phrase as one term; a phrase that stands twice in a query counts once.

    phrases are of analysed words, as parse_query gives them. Each word of a phrase brings the places at which the
    phrase would start; a document holds it where all words agree. Queries without a phrase have no row.
    """
    each = queries.select("qid", F.explode(F.array_distinct("phrases")).alias("phrase"))
    listed = each.select("phrase").distinct().withColumn("words", F.split("phrase", " "))
    words = listed.select("phrase", F.size("words").alias("n"), F.posexplode("words").alias("i", "term"))
    places = index.places(words.select("term").distinct()).join(words, "term")
    starts = places.select("phrase", "n", "doc_id", "dl", F.transform("positions", lambda p: p - F.col("i")).alias("starts"))
    found = starts.groupBy("phrase", "n", "doc_id", "dl").agg(F.collect_list("starts").alias("s")).filter(F.size("s") == F.col("n"))
    agreed = F.aggregate(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(1))), F.get("s", F.lit(0)), lambda a, x: F.array_intersect(a, x))
    found = found.select("phrase", "doc_id", "dl", F.size(agreed).alias("tf")).filter("tf > 0")
    stats = found.groupBy("phrase").agg(F.count("*").alias("df")).join(F.broadcast(index.corpus_stats()))  # statistics are one row
    scored = found.join(stats, "phrase").withColumn("part", idf(F.col("n_docs"), F.col("df")) * bm25_weight(F.col("tf"), F.col("dl"), F.col("avgdl")))
    sizes = each.groupBy("qid").agg(F.count("*").alias("phrases"))
    out = scored.join(each, "phrase").groupBy("qid", "doc_id").agg(F.sum("part").alias("score"), F.count("*").alias("held"))
    return out.join(sizes, "qid").filter("held = phrases").select("qid", "doc_id", "score")


def phrase_search(index: Index, phrases: list[str]) -> DataFrame:
    """(doc_id, score) of documents that hold every phrase, as phrase_scores of one query."""
    one = index.docs.sparkSession.createDataFrame([(0, phrases)], "qid int, phrases array<string>")
    return phrase_scores(index, one).select("doc_id", "score")


def edits_allowed(term: Column) -> Column:
    """0 for terms of up to two letters, 1 up to five, else 2."""
    return F.when(F.length(term) <= 2, 0).when(F.length(term) <= 5, 1).otherwise(2)


def fuzzy_terms(index: Index, queries: DataFrame) -> DataFrame:
    """(qid, term, query_term, edits): index terms near to each query term, where a swap of neighbours is one edit.

    Both sides meet by their variants with letters deleted: those of the index's terms are stored, so that a query term
    reads a few dozen ranges of them, and only terms that share one are compared.
    """
    wanted = query_terms(queries).select("qid", F.col("term").alias("query_term"))
    each = wanted.select("query_term").distinct().withColumn("most", edits_allowed(F.col("query_term")))
    shared = F.when(F.col("most") == 0, F.array(F.substring("query_term", 1, PREFIX)))
    for n in range(1, MOST_EDITS + 1):
        shared = shared.when(F.col("most") == n, word_variants(F.col("query_term"), n))
    asked = each.select("query_term", "most", F.explode(shared).alias("variant"))
    met = index.variants(asked.select("variant").distinct()).join(asked, "variant").select("query_term", "most", "term").distinct()
    apart = F.abs(F.length("term") - F.length("query_term")) <= F.col("most")
    near = met.filter(apart).withColumn("edits", alignment(F.col("term"), F.col("query_term"))).filter("edits <= most")
    if index.stored:  # variants may be of terms that no document has any more
        near = near.join(index.term_stats(near.select("term").distinct()).select("term"), "term", "left_semi")
    return wanted.join(near, "query_term").select("qid", "term", "query_term", "edits")


def fuzzy_scores(index: Index, queries: DataFrame) -> DataFrame:
    """(qid, doc_id, score): BM25 over near terms, each weighted by 1 - edits / its query term's length.

    Near terms are written once, as both their statistics and their postings ask for them.
    """
    near = fuzzy_terms(index, queries)
    weight = 1 - F.col("edits") / F.length("query_term")
    path = table_path(index.docs.sparkSession, "near")
    near.groupBy("qid", "term").agg(F.max(weight).alias("weight")).write.parquet(path)
    return _scored(index, index.docs.sparkSession.read.parquet(path))


def with_fuzzy_fallback(index: Index, queries: DataFrame) -> DataFrame:
    """Exact BM25 hits; queries without any get fuzzy hits. One plan: the fuzzy side sees only those queries."""
    exact = bm25_scores(index, queries)
    missed = queries.join(exact.select("qid").distinct(), "qid", "left_anti")
    fuzzy = fuzzy_scores(index, missed).withColumn("fuzzy", F.lit(True))
    return exact.withColumn("fuzzy", F.lit(False)).unionByName(fuzzy)


def best_field(indexes: dict[str, tuple[Index, float]], queries: DataFrame, fuzzy: bool = True) -> DataFrame:
    """(qid, doc_id, score): the best of several fields' boosted scores."""
    parts = []
    for index, boost in indexes.values():
        found = fuzzy_scores(index, queries) if fuzzy else bm25_scores(index, queries)
        parts.append(found.withColumn("score", F.col("score") * boost))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("qid", "doc_id").agg(F.max("score").alias("score"))


def id_search(df: DataFrame, doc_id: str, digits: str, exact_boost: float = 100.0, prefix_boost: float = 10.0) -> DataFrame:
    """(doc_id, score) of rows whose identifier is, or begins with, these digits."""
    key = F.col(doc_id).cast("string")
    score = F.when(key == digits, exact_boost + prefix_boost).otherwise(prefix_boost)
    return df.filter(key.startswith(digits)).select(F.col(doc_id).alias("doc_id"), score.alias("score"))


def contains_text(c: Column | str, text: str) -> Column:
    """Case-insensitive substring, with no wildcards."""
    return F.lower(col(c)).contains(text.lower())


def snippet(text: Column | str, size: int = 300) -> Column:
    return F.substring(col(text), 1, size)

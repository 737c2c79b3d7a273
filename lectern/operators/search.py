"""Whole searches: each type of document by keywords and vectors, merged; and searches refined by several queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from lectern.operators import fusion, keyword, rerank, vector
from lectern.operators.index import Index
from lectern.operators.query import SearchParams, keyword_enabled, parse_query, similarity_floor, skips_semantic
from lectern.operators.vector_index import VectorIndex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows fetched by each side, kept of each type, and weights of a refined search.
FETCH, PER_TYPE, REFINE_CUTOFF = 50, 30, 0.25
CAPS = {"verse": 60, "narration": 75}


class Embedder(Protocol):
    """An external model: texts to vectors."""

    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class Expander(Protocol):
    """An external model: a query to other wordings with weights; the query itself comes first."""

    def __call__(self, query: str) -> list[tuple[str, float]]: ...


def no_expansion(query: str) -> list[tuple[str, float]]:
    return [(query, 1.0)]


@dataclass(frozen=True)
class Corpus:
    """Documents of one type: their index, and their vectors (doc_id, embedding) if they have any.

    excluded: documents never found. condition: on the index's and the vectors' columns, for every search. cells: a
    stored index of the vectors, of which a search reads `probes` cells, or as many as it was measured to need.
    """

    index: Index
    vectors: DataFrame | None = None
    excluded: list = field(default_factory=list)
    condition: str | None = None
    least: float = 0.0
    cells: VectorIndex | None = None
    probes: int | None = None


def keyword_side(corpus: Corpus, queries: DataFrame, k: int, fuzzy: bool) -> DataFrame:
    """(qid, doc_id, bm25_score, keyword_rank) of queries (qid, terms, phrases): BM25 of terms, among documents that hold
    every phrase of the query, if it has any.

    Fuzzy terms are tried for queries without a hit. Ranks follow exclusions.
    """
    scores = keyword.with_fuzzy_fallback(corpus.index, queries) if fuzzy else keyword.bm25_scores(corpus.index, queries)
    held = keyword.phrase_scores(corpus.index, queries).withColumnRenamed("score", "_phrase")
    phrased = queries.filter(F.size("phrases") > 0).select("qid")
    both = held.join(scores.select("qid", "doc_id", "score"), ["qid", "doc_id"], "left")
    both = both.select("qid", "doc_id", (F.col("_phrase") + F.coalesce("score", F.lit(0.0))).alias("score"))
    scores = scores.select("qid", "doc_id", "score").join(phrased, "qid", "left_anti").unionByName(both)
    if corpus.condition:
        scores = scores.join(corpus.index.docs.filter(corpus.condition).select("doc_id"), "doc_id", "left_semi")
    if corpus.excluded:
        scores = scores.filter(~F.col("doc_id").isin(corpus.excluded))
    best = keyword.top_k(scores, k)
    return best.select("qid", "doc_id", F.col("score").alias("bm25_score"), F.col("rank").alias("keyword_rank"))


def semantic_side(corpus: Corpus, queries: DataFrame, k: int, least: float) -> DataFrame:
    """(qid, doc_id, semantic_score, semantic_rank) of queries (qid, qvec)."""
    if corpus.cells is not None:
        found = corpus.cells.nearest(queries, k, corpus.probes, corpus.condition, corpus.excluded, max(least, corpus.least))
        return found.select("qid", F.col(corpus.cells.vec_id).alias("doc_id"), F.col("score").alias("semantic_score"), F.col("rank").alias("semantic_rank"))
    rows = corpus.vectors if corpus.condition is None else corpus.vectors.filter(corpus.condition)
    if corpus.excluded:
        rows = rows.filter(~F.col("doc_id").isin(corpus.excluded))
    found = vector.nearest_batch(rows, queries, k, vec_id="doc_id", least=max(least, corpus.least))
    return found.select("qid", "doc_id", F.col("score").alias("semantic_score"), F.col("rank").alias("semantic_rank"))


class Searcher:
    """Searches over several types of documents, with external models behind callables."""

    def __init__(self, corpora: dict[str, Corpus], embed: Embedder | None = None, expand: Expander = no_expansion):
        self.corpora, self.embed, self.expand = corpora, embed, expand

    def _sides(self, corpus: Corpus, texts: list[str], params: SearchParams, cutoff: float) -> tuple[DataFrame, DataFrame]:
        spark = corpus.index.docs.sparkSession
        parsed = [parse_query(t) for t in texts]
        rows = [(i, p.terms, p.phrases) for i, p in enumerate(parsed)]
        queries = spark.createDataFrame(rows, "qid int, terms array<string>, phrases array<string>")
        words = keyword_side(corpus, queries, FETCH, params.fuzzy)
        if params.mode == "semantic" or not keyword_enabled(texts[0], params.keyword_gate):
            words = words.limit(0)
        if self.embed is None or (corpus.vectors is None and corpus.cells is None) or params.mode == "keyword" or skips_semantic(texts[0]):
            none = "qid int, doc_id long, semantic_score double, semantic_rank int"
            return spark.createDataFrame([], none).withColumn("doc_id", F.col("doc_id").cast(dict(words.dtypes)["doc_id"])), words
        vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(self.embed(texts))], "qid int, qvec array<double>")
        return semantic_side(corpus, vectors, FETCH, similarity_floor(texts[0], cutoff)), words

    def standard(self, params: SearchParams) -> dict[str, DataFrame]:
        """Per type: doc_id, scores and ranks of either side, fused_score, rrf_score, match_type, rank."""
        out = {}
        for name, corpus in self.corpora.items():
            semantic, words = self._sides(corpus, [params.query], params, params.similarity_cutoff)
            merged = fusion.merge(semantic.drop("qid"), words.drop("qid"), ["doc_id"])
            limit = params.book_limit if name == "page" else params.limit
            order = [F.col("fused_score").desc(), F.col("rrf_score").desc(), "doc_id"]
            out[name] = rerank.ranked(fusion.ordered(merged, ["doc_id"], limit), order)
        return out

    def refined(self, params: SearchParams, ranking: Callable[[dict[str, DataFrame]], list[tuple[str, str]] | None] = lambda parts: None) -> DataFrame:
        """(type, doc_key, score, rank) over all types: each wording is searched, results are merged by weighted RRF,
        and a ranking of the merged results, if the callable gives one, orders them and drops what it leaves out.

        Whether keywords are used is decided by the query itself, not by its other wordings. All wordings of a type are
        one plan.
        """
        wordings = self.expand(params.query)
        parts = {}
        for name, corpus in self.corpora.items():
            semantic, words = self._sides(corpus, [t for t, _ in wordings], params, REFINE_CUTOFF)
            merged = fusion.merge(semantic, words, ["qid", "doc_id"])
            order = [F.col("fused_score").desc(), F.col("rrf_score").desc(), "doc_id"]
            each = rerank.ranked(merged, order, ["qid"]).filter(F.col("rank") <= CAPS.get(name, FETCH))
            weights = F.create_map(*(F.lit(x) for i, (_, w) in enumerate(wordings) for x in (i, float(w))))
            results = each.select("doc_id", "qid", weights[F.col("qid")].alias("weight"), "rank", "semantic_score", "bm25_score")
            best = fusion.merge_queries(results, ["doc_id"])
            parts[name] = best.orderBy(F.col("weighted_rrf").desc(), "doc_id").limit(PER_TYPE).select(F.col("doc_id").alias("doc_key"), F.col("weighted_rrf").alias("score"))
        return rerank.unified(parts, ranking(parts), {"page": params.book_limit})

    def search(self, params: SearchParams) -> dict[str, DataFrame] | DataFrame:
        return self.refined(params) if params.refines else self.standard(params)


def formatted(results: DataFrame, mode: str, text: str = "text", terms: list[str] | None = None) -> DataFrame:
    """Results with score (of the mode's side, or fused), snippet and highlighted snippet, in order of rank: the fragment
    in which analysed terms are marked, if terms are given and found, or the snippet."""
    score = {"semantic": F.col("semantic_score"), "keyword": fusion.normalize_bm25(F.col("bm25_score"), fusion.BM25_NORM_K)}.get(mode, F.col("fused_score"))
    marked = F.col("highlighted_snippet") if "highlighted_snippet" in results.columns else keyword.snippet(text)
    marked = F.coalesce(keyword.highlight(text, terms), marked) if terms else marked
    return results.select("rank", "doc_id", F.coalesce(score, F.lit(0.0)).alias("score"), "match_type", keyword.snippet(text).alias("text_snippet"), marked.alias("highlighted_snippet")).orderBy("rank")


def with_translations(results: DataFrame, translations: DataFrame, keys: list[str], language: str | None = None, edition: str | None = None) -> DataFrame:
    """Results with the translation of their keys: an edition's, or a language's; of several the last by edition."""
    rows = translations.filter(F.col("edition") == edition) if edition else translations.filter(F.col("language") == language)
    picked = rows.groupBy(*keys).agg(F.max_by("text", "edition").alias("translation"), F.max("edition").alias("translation_edition"))
    return results.join(picked, keys, "left")


def graph_boosted(results: DataFrame, refs: DataFrame, keys: list[str], apply: bool = False, expand: bool = True) -> DataFrame:
    """Results with `confirmed`, whether the graph names them; their scores are raised only if asked.

    refs (ref) are references to verses; ranges count for each of their verses if expand is set, or not at all.
    """
    from lectern.operators.graph import expand_ranges

    found = expand_ranges(refs if expand else refs.filter(~F.col("ref").contains("-")))
    named = found.select(F.col("chapter").alias(keys[0]), F.col("verse").alias(keys[1])).distinct()
    return rerank.boost(results, named, keys, 0.05 if apply else 0.0)


def authors_by_name(authors: DataFrame, books: DataFrame, text: str, limit: int, name: str = "name") -> DataFrame:
    """Authors whose name contains a text, those of most books first."""
    from lectern.operators.catalog import with_child_counts

    found = with_child_counts(authors.filter(keyword.contains_text(name, text)), books, "id", "author_id", "n_books")
    return found.orderBy(F.col("n_books").desc(), "id").limit(limit)

"""Fusion of semantic and keyword results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the fusion rules.
RRF_K = 60
SEMANTIC_WEIGHT, KEYWORD_WEIGHT = 0.4, 0.7
BM25_NORM_K = 3


def normalize_bm25(score: Column, k: float = 5) -> Column:
    """score / (score + k); 0 for scores of 0 or less."""
    return F.when(score > 0, score / (score + k)).otherwise(0.0)


def rrf(*ranks: Column) -> Column:
    """Reciprocal rank fusion: the sum of 1 / (60 + rank) over ranks that are not null."""
    return sum((F.coalesce(1.0 / (RRF_K + r), F.lit(0.0)) for r in ranks), F.lit(0.0))


def fused_score(semantic_rank: Column, keyword_rank: Column, semantic_score: Column, bm25: Column, keyword_score: Column | None = None) -> Column:
    """Both signals are weighted; one alone counts as it is. A weak keyword hit can lower a semantic one."""
    semantic = F.coalesce(semantic_score, F.lit(0.0))
    own = F.coalesce(bm25, *([] if keyword_score is None else [keyword_score]), F.lit(0.0))
    both = SEMANTIC_WEIGHT * semantic + KEYWORD_WEIGHT * normalize_bm25(F.coalesce(bm25, F.lit(0.0)), BM25_NORM_K)
    return F.when(semantic_rank.isNotNull() & keyword_rank.isNotNull(), both).when(semantic_rank.isNotNull(), semantic).otherwise(normalize_bm25(own, BM25_NORM_K))


def match_type(semantic_rank: Column, keyword_rank: Column) -> Column:
    return F.when(semantic_rank.isNotNull() & keyword_rank.isNotNull(), "both").when(semantic_rank.isNotNull(), "semantic").otherwise("keyword")


def merge(semantic: DataFrame, keyword: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge of semantic (keys, semantic_rank, semantic_score, ...) and keyword results (keys, keyword_rank,
    bm25_score, ...): fused_score, rrf_score, match_type. Other columns of the semantic side win over the keyword's,
    but for highlighted_snippet, which the keyword side knows better.

    Order them by fused_score, then rrf_score, both falling, then keys: a total order, whatever the input's.
    """
    shared = [c for c in semantic.columns if c in keyword.columns and c not in keys]
    k = keyword.select(*keys, *(F.col(c).alias(f"_k_{c}" if c in shared else c) for c in keyword.columns if c not in keys))
    joined = semantic.join(k, keys, "full")
    for c in shared:
        first, second = (f"_k_{c}", c) if c == "highlighted_snippet" else (c, f"_k_{c}")
        joined = joined.withColumn(c, F.coalesce(first, second)).drop(f"_k_{c}")
    sr, kr = F.col("semantic_rank"), F.col("keyword_rank")
    return joined.withColumns(
        {
            "fused_score": fused_score(sr, kr, F.col("semantic_score"), F.col("bm25_score")),
            "rrf_score": rrf(sr, kr),
            "match_type": match_type(sr, kr),
        }
    )


def ordered(merged: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    out = merged.orderBy(F.col("fused_score").desc(), F.col("rrf_score").desc(), *keys)
    return out.limit(limit) if limit else out


def merge_queries(results: DataFrame, keys: list[str], best: list[str] | None = None) -> DataFrame:
    """Weighted RRF over several queries' results (keys, qid, weight, rank, ...): weighted_rrf and best scores.

    Each score column of `best` keeps its highest value; highlighted_snippet, if there, is the last query's that
    differs from text_snippet, or else the first query's. One aggregation by key.
    """
    best = best if best is not None else [c for c in ("semantic_score", "keyword_score", "bm25_score") if c in results.columns]
    aggs = [F.sum(F.col("weight") / (RRF_K + F.col("rank"))).alias("weighted_rrf"), *(F.max(c).alias(c) for c in best)]
    others = [c for c in results.columns if c not in [*keys, "qid", "weight", "rank", *best, "highlighted_snippet"]]
    aggs += [F.min_by(c, "qid").alias(c) for c in others]
    if "highlighted_snippet" in results.columns:
        told = F.col("highlighted_snippet").isNotNull() & (F.col("highlighted_snippet") != F.coalesce("text_snippet", F.lit("")))
        aggs.append(F.coalesce(F.max_by("highlighted_snippet", F.when(told, F.col("qid"))), F.min_by("highlighted_snippet", "qid")).alias("highlighted_snippet"))
    return results.groupBy(*keys).agg(*aggs)


def by_mode(mode: str, semantic: DataFrame, keyword: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Results of one mode: 'semantic' and 'keyword' are one side's best, 'hybrid' is the merge; at most `limit`."""
    if mode == "semantic":
        keyword = keyword.limit(0)
    elif mode == "keyword":
        semantic = semantic.limit(0)
    return ordered(merge(semantic, keyword, keys), keys, limit)


def hybrid_with_rerank(semantic: DataFrame, keyword: DataFrame, keys: list[str], limit: int, reranker=None, cap: int = 60) -> DataFrame:
    """Merge, cut to the cap, rerank if a reranker (DataFrame to DataFrame with new `rank`) is given, cut to the limit."""
    from lectern.operators.rerank import ranked

    found = ranked(ordered(merge(semantic, keyword, keys), keys, cap), [F.col("fused_score").desc(), F.col("rrf_score").desc(), *keys])
    return (reranker(found) if reranker else found).filter(F.col("rank") <= limit)

"""Evaluation of retrieval: metrics of each query, their means, overlap, latency."""

from __future__ import annotations

from lectern.operators.ranks import ranged
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def query_metrics(retrieved: DataFrame, relevant: DataFrame, depths: tuple[int, ...] = (1, 5, 10, 20)) -> DataFrame:
    """Per query of relevant (qid, doc_id): recall@k, precision@5 and @10, reciprocal rank, NDCG@10, first rank, hit.

    retrieved has (qid, doc_id, rank from 1). Precision divides by the number retrieved, up to k. Relevance is binary;
    a query that retrieved nothing scores 0. One join by query and document, one aggregation by query.
    """
    gold = relevant.select("qid", "doc_id").distinct()
    sizes = gold.groupBy("qid").agg(F.count("*").alias("n_relevant"))
    hits = retrieved.select("qid", "doc_id", "rank").join(gold.withColumn("_hit", F.lit(1)), ["qid", "doc_id"], "left")
    hit = F.coalesce(F.col("_hit"), F.lit(0))
    gain = F.when((F.col("rank") <= 10) & (hit == 1), 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    aggs = [F.countDistinct(F.when((F.col("rank") <= k) & (hit == 1), F.col("doc_id"))).alias(f"_in_{k}") for k in depths]
    aggs += [F.sum(F.when(F.col("rank") <= k, hit).otherwise(0)).alias(f"_good_{k}") for k in (5, 10)]
    aggs += [F.count_if(F.col("rank") <= k).alias(f"_got_{k}") for k in (5, 10)]
    found = hits.groupBy("qid").agg(*aggs, F.sum(gain).alias("_dcg"), F.min(F.when(hit == 1, F.col("rank"))).alias("first_relevant_rank"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_relevant"), F.lit(10)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = sizes.join(found, "qid", "left")
    return out.select(
        "qid",
        *(zero(F.col(f"_in_{k}") / F.col("n_relevant")).alias(f"recall_at_{k}") for k in depths),
        *(zero(F.when(F.col(f"_got_{k}") > 0, F.col(f"_good_{k}") / F.col(f"_got_{k}"))).alias(f"precision_at_{k}") for k in (5, 10)),
        zero(1 / F.col("first_relevant_rank")).alias("reciprocal_rank"),
        zero(F.col("_dcg") / ideal).alias("ndcg_at_10"),
        "first_relevant_rank",
        F.col("first_relevant_rank").isNotNull().alias("hit"),
    )


def mean_metrics(metrics: DataFrame, *groups: str) -> DataFrame:
    """Means over all queries, and over each value of each group, in one pass (GROUPING SETS by expansion)."""
    names = [c for c in metrics.columns if c.startswith(("recall", "precision", "reciprocal", "ndcg"))]
    rows = metrics.withColumn("_g", F.explode(F.array(F.struct(F.lit("all").alias("k"), F.lit("all").alias("v")), *(F.struct(F.lit(g).alias("k"), F.col(g).cast("string").alias("v")) for g in groups))))
    return rows.groupBy(F.col("_g.k").alias("grouped_by"), F.col("_g.v").alias("value")).agg(F.count("*").alias("queries"), *(F.avg(c).alias(c) for c in names), F.avg(F.col("hit").cast("double")).alias("hit_rate"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def latency(df: DataFrame, per: str, value: str, share: float = 0.95) -> DataFrame:
    """Mean of each group, and the element at floor(share * n) of its ordered values, from 0.

    Equal values are counted first, in each task; then values are added up in parts of a group.
    """
    counted = ranged(df.groupBy(per, value).agg(F.count("*").alias("_c")), [per], [value])
    sizes = counted.groupBy(per, "_part").agg(F.sum("_c").alias("_n"))
    group = Window.partitionBy(per)
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col(per).alias("_of"), F.col("_part").alias("_of_part"), before.alias("_before"), F.sum("_n").over(group).alias("_total"))
    upto = F.sum("_c").over(Window.partitionBy(per, "_part").orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    found = counted.withColumn("_upto", upto).join(sizes, F.col(per).eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_of_part")))
    reached = F.col("_before") + F.col("_upto") > F.floor(F.col("_total") * share)
    mean = F.sum(F.col(value) * F.col("_c")) / F.sum(F.when(F.col(value).isNotNull(), F.col("_c")))
    return found.groupBy(per).agg(mean.alias(f"avg_{value}"), F.min(F.when(reached, F.col(value))).alias(f"p95_{value}"))

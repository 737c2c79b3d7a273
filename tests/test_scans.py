"""Ordered scans of groups in parts equal those by one window; near ids by segments and rare grams equal brute force."""

from __future__ import annotations

import datetime
import random

from lectern.operators import etl, graph, ranks
from pyspark.sql import Window
from pyspark.sql import functions as F


def lines(spark, n=4000):
    r = random.Random(1)
    rows = []
    for i in range(n):
        book = "hot" if i % 3 else r.choice(["a", "b", None])
        kind = r.random()
        text = f"KITAB {i}" if kind < 0.004 else f"BAB {i}" if kind < 0.01 else "x " * r.randrange(1, 12)
        rows.append((book, i, text.strip(), datetime.date(2020, 1, 1) + datetime.timedelta(days=i)))
    return spark.createDataFrame(rows, "book string, line int, text string, day date").repartition(9)


def parted(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")


def whole(spark):
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_headings_are_carried_over_parts(spark):
    df = lines(spark)
    outer, inner = F.when(F.col("text").startswith("KITAB"), F.col("text")), F.when(F.col("text").startswith("BAB"), F.col("text"))
    w = Window.partitionBy("book").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    one = df.withColumn("outer_heading", F.last(outer, ignorenulls=True).over(w)).withColumn("_s", F.count(outer).over(w))
    inside = Window.partitionBy("book", "_s").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    one = one.withColumn("inner_heading", F.last(F.when(outer.isNull(), inner), ignorenulls=True).over(inside)).drop("_s")
    want = sorted(map(tuple, one.collect()), key=repr)
    parted(spark)
    try:
        found = etl.carry_forward(df, ["book"], "line", outer, inner)
        assert sorted(map(tuple, found.collect()), key=repr) == want
        assert ranks.ranged(df, ["book"], ["line"]).filter("book = 'hot'").select("_part").distinct().count() > 5
    finally:
        whole(spark)


def test_short_rows_join_over_parts(spark):
    df = lines(spark)
    words = F.size(F.split("text", " "))
    every = Window.partitionBy("book")
    closes = ((words > 5) | (F.col("line") == F.max("line").over(every))).cast("int")
    before = every.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    one = df.withColumn("_c", closes).withColumn("group_id", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    want = sorted(map(tuple, one.collect()), key=repr)
    parted(spark)
    try:
        assert sorted(map(tuple, etl.group_short(df, ["book"], "line", words).collect()), key=repr) == want
    finally:
        whole(spark)


def test_entries_run_on_over_parts(spark):
    df = lines(spark)
    heads = F.when(F.col("text").rlike("^(KITAB|BAB)"), F.col("text"))
    want = {}
    for r in sorted(df.collect(), key=lambda r: r["line"]):
        opened = want.setdefault(r["book"], [])
        if r["text"].startswith(("KITAB", "BAB")):
            opened.append([r["text"]])
        elif opened:
            opened[-1].append(r["text"])
    parted(spark)
    try:
        found = etl.entries_from_lines(df, ["book"], "line", "text", heads).collect()
    finally:
        whole(spark)
    assert sorted((repr(r["book"]), r["entry"], r["text"]) for r in found) == sorted((repr(b), i, "\n".join(t)) for b, e in want.items() for i, t in enumerate(e, 1))


def test_numbers_by_any_type_and_ties(spark):
    df = lines(spark, 1500).withColumn("same", F.lit(1)).withColumn("_part", F.lit("x"))
    parted(spark)
    try:
        for order in (["day"], ["text", "line"], ["line"]):
            found = ranks.numbered(df, ["book"], order, "n", "of")
            want = df.withColumn("n", F.row_number().over(Window.partitionBy("book").orderBy(*order))).withColumn("of", F.count("*").over(Window.partitionBy("book")))
            assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        tied = ranks.numbered(df, ["book"], ["same"], "n")
        got = tied.groupBy("book").agg(F.count("*").alias("c"), F.countDistinct("n").alias("d"), F.max("n").alias("m")).collect()
        assert all(r["c"] == r["d"] == r["m"] for r in got)
        assert ranks.ranged(df, ["book"], ["same"]).filter("book = 'hot'").select("_part").distinct().count() > 3
    finally:
        whole(spark)
    assert ranks.numbered(df.limit(0), ["book"], ["line"], "n").count() == 0


def test_chunks_by_budget_over_parts(spark):
    for seed, sizes in enumerate(([0, 1, 3, 8, 12, 40, None], [0], [1], [25], [7, 0, 0, 0])):
        r = random.Random(seed)
        rows = [(None if i % 9 == 0 else "hot", i, r.choice(sizes)) for i in range(1500)]
        df = spark.createDataFrame(rows, "g string, i int, tokens long").repartition(5)
        parted(spark)
        try:
            found = {x["i"]: x["chunk"] for x in etl.budget_chunks(df, ["g"], "i", "tokens", 20).collect()}
        finally:
            whole(spark)
        for g in ("hot", None):
            chunk, used, opened = 0, 0, False
            for _, i, n in (x for x in rows if x[0] == g):
                if opened and used + (n or 0) > 20:
                    chunk, used = chunk + 1, 0
                used, opened = used + (n or 0), True
                assert found[i] == chunk, (seed, g, i)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_near_ids_equal_brute_force(spark):
    r = random.Random(3)
    slugs = {"".join(r.choice("abc") for _ in range(r.randrange(0, 9))) for _ in range(120)} | {"", "a", "ab", "omar-ibn-x", "omar-ibn-y", "mar-ibn", "omarr-ibn-yz"}
    ids = [f"{p}:{s}" for s in sorted(slugs) for p in ("person", "place") if r.random() < 0.7]
    found = {(x["a"], x["b"]) for x in graph.near_duplicate_ids(spark.createDataFrame([(i,) for i in [*ids, ids[0]]], "id string")).collect()}
    want = set()
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            (p, s), (q, t) = a.split(":"), b.split(":")
            if p == q and (s in t or t in s or levenshtein(s, t) <= 2):
                want.add((min(a, b), max(a, b)))
    assert found == want


def test_near_ids_of_long_slugs(spark):
    r = random.Random(4)
    base = ["".join(r.choice("abcdefgh") for _ in range(5000)) for _ in range(40)]
    ids = [f"x:{s}" for s in base]
    ids += [f"x:{base[0][:100]}zz{base[0][102:]}", f"x:{base[1][:-1]}", f"x:{base[2][50:900]}", f"x:{base[3][:10]}zzz{base[3][13:]}"]
    found = {(x["a"], x["b"]) for x in graph.near_duplicate_ids(spark.createDataFrame([(i,) for i in ids], "id string")).collect()}
    assert found == {tuple(sorted(p)) for p in ((ids[0], ids[40]), (ids[1], ids[41]), (ids[2], ids[42]))}

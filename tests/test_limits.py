"""What must hold at any size: trees of any depth, numbers with any count of repeats, markup that is never closed."""

from __future__ import annotations

import random
import re
import time

from lectern.functions import text
from lectern.operators import etl, graph
from pyspark.sql import functions as F


def test_categories_of_any_depth(spark):
    rows = [(i, i - 1 if i else None, f"c{i}") for i in range(1000)] + [(5000, 4999, "orphan"), (5001, 5000, "child"), (5002, None, "root")]
    nodes = spark.createDataFrame(rows, "id int, parent_id int, name string")
    found = {r["id"]: (r["depth"], r["path"]) for r in graph.category_paths(nodes).collect()}
    assert found[999] == (999, " / ".join(f"c{i}" for i in range(1000))) and len(found) == len(rows)
    assert found[5000] == (0, "orphan") and found[5001] == (1, "orphan / child") and found[5002] == (0, "root")
    assert {r["id"] for r in graph.category_paths(nodes, levels=2).collect()} == {0, 1, 5000, 5001, 5002}
    assert graph.category_cycles(nodes).count() == 0


def test_cycles_are_reported(spark):
    rows = [(1, 2, "a"), (2, 3, "b"), (3, 1, "c"), (4, 1, "below"), (5, 4, "lower"), (6, 6, "self"), (7, None, "root"), (8, 7, "leaf"), (9, 6, "of self")]
    nodes = spark.createDataFrame(rows, "id int, parent_id int, name string")
    assert {r["id"]: r["on_cycle"] for r in graph.category_cycles(nodes).collect()} == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True, 9: False}
    assert {r["path"] for r in graph.category_paths(nodes).collect()} == {"root", "root / leaf"}
    assert graph.category_paths(nodes.limit(0)).count() == 0


def suffix(n):
    out = ""
    while n > 0:
        out, n = chr(97 + (n - 1) % 26) + out, (n - 1) // 26
    return out


def test_suffixes_of_any_number(spark):
    numbers = [*range(60), 701, 702, 703, 704, 18_277, 18_278, 18_279, 475_254, 475_255, 2**40, 2**62]
    found = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", etl.letter_suffix(F.col("n")).alias("s")).collect()
    assert all(r["s"] == suffix(r["n"]) for r in found)


def test_repeats_of_one_number_stay_unique(spark):
    df = spark.range(20_000).select(F.lit(1).alias("book"), F.lit(8).alias("number"), "id")
    found = etl.unique_numbers(df, ["book"], "number", "id")
    assert found.select("unique_number").distinct().count() == 20_000
    assert {r["id"]: r["unique_number"] for r in found.filter("id in (0, 1, 27, 19999)").collect()} == {0: "8", 1: "8a", 27: "8aa", 19_999: "8" + suffix(19_999)}


def timed(spark, markup, f):
    df = spark.createDataFrame([(markup,)], "html string").select(f("html").alias("x"))
    began = time.time()
    return df.first()["x"], time.time() - began


def test_markup_that_is_never_closed_takes_linear_time(spark):
    for unit in ("<script>", "<script", "<style><", "<", "<p>", "<p", "< p", "\n", "</script>", "<span data-type='title'>\n", "<span data-type='title'"):
        markup = "head " + unit * (1_000_000 // len(unit))
        for f in (text.html_to_text, text.paragraph_texts, lambda c: text.paragraphs(c, "[a-z]"), text.text_with_breaks):
            _, took = timed(spark, markup, f)
            assert took < 15, (unit, took)


def spans_joined(html):
    return re.sub(r"<span\s+data-type=['\"]title['\"][^>]*>[\s\S]*?</span>", lambda m: m[0].replace("\n", " "), html)


def test_title_spans_of_any_length(spark):
    long = "<span data-type='title' id=x>" + "word\n" * 1000 + "end</span>\nnext line"
    found = timed(spark, long, lambda c: text.paragraphs(c, "[a-z]"))[0]
    assert [(p["index"], len(p["text"])) for p in found] == [(0, 5003), (1, 9)]
    r = random.Random(4)
    pieces = ["<span data-type='title'>", '<span  data-type="title" a=b>', "</span>", "\n", "a", "<b>", "</b>", "<span>", "\n\n"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(1, 25))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [tuple(x) for x in df.select("t", text.titles_on_one_line(F.col("t"))).collect()] == [(t, spans_joined(t)) for t in texts]


def test_elements_equal_patterns_on_closed_markup(spark):
    r = random.Random(5)
    pieces = ["<p>", "<p class='x'>", "</p>", "</P>", "a", " b\n", "<br>", "<i>", "</i>", "<SCRIPT a=1>", "</script>", "<style>", "</style>", "&amp;", "x > y"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(1, 25))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", text.elements(F.col("t"), "p").alias("p"), text.without_elements(F.col("t"), "script").alias("s")).collect()
    for x in found:
        assert x["p"] == re.findall(r"(?is)<p[^>]*>(.*?)</p>", x["t"])
        # A closing tag that stands alone is written in lower case.
        assert x["s"] == re.sub(r"(?is)<script[^>]*>.*?</script>", "", x["t"])

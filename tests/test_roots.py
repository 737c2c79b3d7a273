"""Roots and stems: of distinct words, and of whole texts."""

import pytest
from lectern.functions import morphology as M
from lectern.functions.text import normalize_lexical
from lectern.plans import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["resolved_roots", "root_families"])
def test_roots_are_read_off_written_words(spark, name):
    """Else each condition on a root is evaluated for every occurrence of a word, and each step reads the texts again."""
    assert not [f for f in QUERIES[name](spark, SF).inputFiles() if "documents.parquet" in f]


def test_one_expression_equals_patterns_in_turn(spark):
    def root(word):
        for p in (p for p in M.ROOT_PATTERNS if len(p) == len(word)):
            seen = {}
            if all(seen.setdefault(c, x) == x if c.isdigit() else x in M.IMPERFECT_PREFIXES if c == "P" else x == c for c, x in zip(p, word)):
                return "".join(seen[d] for d in sorted(seen))
        return None

    letters = dict(zip("1234P", "كتبر" + "ي"))
    words = {"".join(letters.get(c, c) for c in p) for p in M.ROOT_PATTERNS}
    words |= {w[:i] + x + w[i + 1 :] for w in words for i in range(len(w)) for x in "اميتنوهس"} | {"", "ا", "كت", "كتبرتبر", "1234567890"}
    found = spark.createDataFrame([(w,) for w in sorted(words)], "word string").select("word", M.extract_root("word")).collect()
    assert [r for r in found if r[1] != root(r[0])] == []
    assert sum(r[1] is not None for r in found) > 100


def test_texts_equal_their_words(spark):
    """Roots and stems by passes over a text are those of its words; white space beyond blanks included."""
    words = ["الكتاب", "مكتوب", "وكتابهم", " كتب", "كاتب ", " ", "مستكتبوون", "ab", "ال", " طويلجدااا", "يكتب", "كَتَبَ", "بالمدرسة", "ككا", "12", "　كك ", "ستكتب"]
    texts = [" ".join(words), "\n".join(words), "\t ".join(reversed(words)) + " ", "", " ", " ", *words, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    each = lambda c, f: F.array_join(F.transform(F.split(c, r"\s+"), f), " ")
    lexical = normalize_lexical("t")
    rows = df.select(
        "t", M.roots_of_text("t"), each(lexical, lambda w: F.coalesce(M.extract_root(w), w)), M.light_text("t"), each(lexical, M.light_stem),
        M.light10_text("t"), each(F.col("t"), M.light10_stem),
    ).collect()
    assert [r for r in rows if r[1] != r[2] or r[3] != r[4] or r[5] != r[6]] == []


def test_techniques_take_whole_texts(spark):
    """No word is a value of its own: functions of array elements are interpreted, pattern by pattern."""
    plan = QUERIES["text_techniques"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp_replace" in plan and "lambda" not in plan

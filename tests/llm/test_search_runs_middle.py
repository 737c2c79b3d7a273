"""Top-k search, periodic runs and fill-in-middle documents against brute force, with nulls, ties, repeats and blanks."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from lectern.llm import fill_middle, periodic_runs, top_search
from lectern.llm._words import words
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
CLASHING = ("block", "of", "some", "runs", "period", "first", "rank", "score", "n", "form", "island", "_id", "query_id", "text_hash")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11 top-k search ---


def top_brute(rows, k, every):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(1024 * x) for x in v]

    usable = [(i, v, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    asking = {}
    for i, v, w in usable:
        if i % every == 0 and (i not in asking or v < asking[i][0]):
            asking[i] = (v, w)
    out = []
    for q, (_, w) in asking.items():
        scores = sorted((max(min(sum(a * b for a, b in zip(w, u, strict=False)), 2**63 - 1), -(2**63)), -i) for i, _, u in usable if i != q)[::-1][:k]
        out += [(q, n, -i, s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def vectors(seed, n, width, spread=1.0):
    r = random.Random(seed)
    return [[r.gauss(0, spread) for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize(("lists", "query_bytes"), [(2, 1 << 20), (1, 1 << 20), (5, 2_000)])
def test_top_search_equals_brute_force(spark, lists, query_bytes):
    rows = list(enumerate(vectors(1, 240, 12)))
    rows += [(300 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(400, None), (500, [1.0, None]), (600, [float("nan")]), (700, [float("inf"), 1.0]), (None, [9.0] * 12), (800, []), (810, [1.0, 2.0])]
    rows += [(20, rows[20][1]), (20, rows[3][1]), (21, rows[21][1])]  # repeated rows, and another vector of one identifier
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in CLASHING}).repartition(5)
    got = sorted(tuple(r) for r in top_search.search(df, k=4, every=10, lists=lists, query_bytes=query_bytes).collect())
    assert got == top_brute(rows, 4, 10)


def test_top_search_of_few_empty_and_huge(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [2.0]), (100, [-3.0])], [(0, [1e300, -1.0]), (1, [1e300, 5.0]), (2, [-1e300, 5.0]), (3, [1e15, 2.5])], [(5, [1.0])], [(0, None)]):
        got = sorted(tuple(r) for r in top_search.search(spark.createDataFrame(rows, schema)).collect())
        assert got == top_brute(rows, 10, 100)


def test_cutoffs_are_safe_and_leave_most_entries_out(spark):
    v = np.floor(np.random.default_rng(0).standard_normal((4000, 32)) * 300)
    queries = v[:20]
    scores = top_search.inner_products(queries, v)
    own = np.arange(4000)[None, :] == np.arange(20)[:, None]
    cutoff = top_search.local_scores(queries, own, v, 10, 2).min(axis=1)
    kth = np.sort(np.where(own, top_search.LEAST, scores), axis=1)[:, -10]
    assert (cutoff <= kth).all()
    enough = np.logical_or.reduce([p >= (cutoff // 2)[:, None] for p in top_search.partial_scores(queries, v, 2)])
    assert enough[scores >= cutoff[:, None]].all() and enough.mean() < 0.2


def test_float_vectors_are_taken_as_doubles(spark):
    rows = [(i, v) for i, v in enumerate(vectors(3, 130, 8, 0.2))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    single = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(tuple(r) for r in top_search.search(df).collect()) == top_brute(single, 10, 100)


# --- 12 periodic runs ---


def runs_brute(ws):
    n, found = len(ws), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted((s, q, length) for (s, length), q in found.items())


def described_brute(doc_id, text):
    ws = WORD.findall(text or "")
    n = len(ws)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = runs_brute(ws)
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{length},{q}\n" for s, q, length in runs)), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def periodic(r, size):
    ws = []
    while len(ws) < size:
        if r.random() < 0.5:
            u = [r.choice("abc") for _ in range(r.randrange(1, 30))]
            ws += (u * r.randrange(1, 9))[: r.randrange(1, 200)]
        else:
            ws += [r.choice("ab") for _ in range(r.randrange(6))]
    return " ".join(ws)


@pytest.mark.parametrize("step", [1, 7, 64, 1 << 20])
def test_fragments_cover_all_runs(monkeypatch, step):
    monkeypatch.setattr(periodic_runs, "STEP", step)
    r = random.Random(step)
    for _ in range(15):
        texts = [periodic(r, r.choice([3, 8, 30, 150, 400])) for _ in range(8)]
        held = {}
        for text, q, first, last in periodic_runs.fragments(words(pa.array(texts))):
            ws = texts[text].split()
            assert all(ws[i] == ws[i + q] for i in range(first, last))
            held.setdefault(text, set()).update((q, i) for i in range(first, last))
        for i, t in enumerate(texts):
            for s, q, length in runs_brute(t.split()):
                assert {(q, at) for at in range(s, s + length - q)} <= held[i]


def test_z_function():
    r = random.Random(2)
    for _ in range(200):
        x = [r.randrange(2) for _ in range(r.randrange(1, 30))]
        assert periodic_runs.z_function(x) == [next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i) for i in range(len(x))]


def run_rows():
    r = random.Random(8)
    texts = [None, "", " \n", "one", "a a a a a", "a a a a a a", "a\x1ca a\x1ca a\x1ca", "x " * 3000, "p q " * 500, "u v w x y z " * 4 + "u", " ".join(f"w{i % 257}" for i in range(1500))]
    texts += [periodic(r, r.choice([20, 90, 300])) for _ in range(60)] + [" ".join(f"w{r.randrange(90)}" for _ in range(120)) for _ in range(60)]
    rows = list(enumerate(texts))
    return [*rows, rows[7], rows[20], (None, texts[7]), (None, texts[7]), (None, None), (10**15, texts[30])]


def test_runs_equal_brute_force(spark):
    rows = run_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASHING}).repartition(4)
    key = lambda x: (x[0] is None, x[0] or 0, x[7])
    got = sorted((tuple(r) for r in periodic_runs.collapse_runs(df, tails=True).collect()), key=key)
    assert got == sorted((described_brute(i, t) for i, t in rows), key=key)
    plain = {(r["doc_id"], r["start"], r["period"], r["length"]) for r in periodic_runs.find_runs(df).collect()}
    assert plain == {(i, *x) for i, t in rows for x in runs_brute(WORD.findall(t or ""))}
    assert periodic_runs.collapse_runs(df.filter("doc_id < 0"), tails=True).count() == 0


def test_one_long_text_of_one_word_takes_linear_time(spark):
    df = spark.createDataFrame([(1, "word " * 60_000), (2, " ".join(str(i) for i in range(60_000)))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs.collapse_runs(df).collect()}
    assert (got[1]["n_runs"], got[1]["length"], got[1]["period"], got[2]["n_runs"]) == (1, 60_000, 1, 0) and got[1]["collapsed_sha256"] == sha("word")


# --- 13 fill-in-middle ---


def middle_brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    out = f"<S>{z}<P>{x}<M>{y}" if h4 % 100 < 80 else f"<P>{x}<S>{z}<M>{y}"
    return (doc_id, n, "spm" if h4 % 100 < 80 else "psm", len(x), len(y), sha(out), sha(text))


def test_middles_equal_brute_force(spark, monkeypatch):
    r = random.Random(6)
    texts = [None, "", " ", "\n\n", "one", " one", "one ", " é ", "a\x1cb c\x85d", "has <P> in it", "<M>", "< P>", "<P", "end <S", "a <", "é" * 70 + " 漢字 🙂 x"]
    texts += ["".join(r.choice(["a", "b ", " ", "\n", "é", "漢", "🙂", "<", "<S", ">", "\t\x0b"]) for _ in range(r.randrange(1, 200))) for _ in range(400)]
    texts += ["word " * 50_000, "x" * 300_000]
    rows = [*enumerate(texts), (3, texts[3]), (None, "some text of no identifier"), (-5, "minus five")]
    for limit in (200, 4 << 20):
        monkeypatch.setattr(fill_middle, "MATRIX_BYTES", limit)
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)
        got = sorted((tuple(x) for x in fill_middle.digests(fill_middle.fill_in_middle(df)).collect()), key=repr)
        assert got == sorted((middle_brute(i, t) for i, t in rows), key=repr)
    assert {x[2] for x in got} == {"plain", "spm", "psm"}
    assert fill_middle.digests(fill_middle.fill_in_middle(df.filter("doc_id < -9"))).count() == 0


def test_outputs_can_be_restored(spark):
    rows = [(i, f"<S one <P two{i} <M three <") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in fill_middle.fill_in_middle(df, rearranged=100, suffix_first=50).collect():
        assert r["form"] != "plain" and fill_middle.restored(r["output"], r["form"]) == rows[r["doc_id"]][1]


def test_wavelet_ranks():
    r = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        x = r.integers(0, 8, n).astype(np.uint8)
        m = fill_middle.WaveletMatrix(x, 3)
        at = np.arange(n + 1)
        for v in range(8):
            assert (m.rank(v, at) == np.append(0, np.cumsum(x == v))).all()
        assert (m.rank_any(2, at) == np.append(0, np.cumsum((x & 2) > 0))).all()

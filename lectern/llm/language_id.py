"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Fitted with follow-the-regularised-leader (FTRL-proximal) under an elastic net, then calibrated by a temperature.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm._counters import parts, summed
from lectern.llm._store import release, written
from lectern.llm._words import slices

UNKNOWN = "und"
#: Hashed features, and the lengths of the n-grams that fall into them.
FEATURES, ORDERS = 1 << 15, (1, 2, 3)
#: Labelled documents that the classifier is fitted on, of each language, as expected: the documented bound of the
#: sample. A fifth of them sets the temperature. Document frequencies come from all training documents.
FIT_DOCUMENTS = 1000
#: What the sample's features may take on the driver, about; beyond it fewer documents of each language are drawn.
FIT_BYTES = 256 << 20
#: Text bytes of a step; its arrays take about 25 times as much.
STEP_BYTES = 1 << 20
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.1

_LETTER = re.compile(r"[^\W\d_]")
_K = np.uint32(0x9E3779B1)


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, counts) of each text's hashed n-grams of code points, lower-cased, with a space at either end."""
    padded = [f" {t.lower()} " if t else "" for t in texts]
    code = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    gram, hashed = np.zeros(len(code), np.uint32), []
    for k in ORDERS:
        # The hash of k code points that end here; those that begin in the text before are cut off below.
        gram = (np.append(np.uint32(0), gram[:-1]) if k > 1 else np.zeros_like(gram)) + code + np.uint32(k)
        gram = (gram ^ (gram >> np.uint32(15))) * _K
        hashed.append((gram >> np.uint32(17)).astype(np.uint16))
    end = 0
    for t in padded:
        start, end = end, end + len(t)
        count = np.zeros(FEATURES, np.int64)
        for k, h in zip(ORDERS, hashed, strict=True):
            if end - start >= k:
                count += np.bincount(h[start + k - 1 : end], minlength=FEATURES)
        at = np.flatnonzero(count)
        yield at, count[at]


def weighted(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(count)) * idf[at]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # features by languages; most are 0
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        logits = np.zeros((len(texts), len(self.languages)))
        for i, (at, count) in enumerate(features(texts)):
            if len(at):
                logits[i] = weighted(at, count, self.idf) @ self.weights[at]
        return softmax((logits + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by FTRL-proximal: per-coordinate rates, L1 and L2 penalties on the weights alone."""
    z = np.zeros((FEATURES + 1, n_classes))
    n = np.zeros_like(z)
    l1 = np.full((FEATURES + 1, 1), L1)
    l1[FEATURES] = 0  # the bias

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x = np.append(rows[i][0], FEATURES), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y[i]] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:FEATURES], w[FEATURES]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean() + 1e-4 * t * t

    a, b, r = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Model | None:
    """A model of all documents (doc_id, text, lang) whose lang is known and whose crc32(doc_id) mod 5 is not 0.

    Document frequencies count every such document, in Spark. The weights are fitted on about fit_documents of each
    language, or FIT_BYTES of feature counts in all, chosen by a hash of doc_id, which reach the driver. None if there is
    nothing to learn.
    """
    known = docs.filter("lang is not null").filter(~held_out()).select("doc_id", "text", "lang")
    # A document has a feature of six bytes for each n-gram at most, and no more than there are features.
    taken = F.sum(F.least(F.coalesce(F.length("text"), F.lit(0)) * len(ORDERS), F.lit(FEATURES)) * 6)
    told = {r["lang"]: r for r in known.groupBy("lang").agg(F.count("*").alias("n"), taken.alias("bytes")).collect()}
    if not told:
        return None
    sizes = {lang: r["n"] for lang, r in told.items()}
    share = {lang: min(1.0, fit_documents / r["n"], FIT_BYTES / len(told) / max(r["bytes"], 1)) for lang, r in told.items()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)).cast("long").alias("draw")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(FEATURES, np.int64)
        for batch in slices(batches, limit=STEP_BYTES):
            langs, draws = batch.column("lang").to_pylist(), batch.column("draw").to_pylist()
            out: list[tuple] = []
            for lang, u, (at, n) in zip(langs, draws, features(batch.column("text").to_pylist()), strict=True):
                df[at] += 1
                if u < share[lang] * (1 << 20) and len(at):
                    out.append((None, None, lang, u % 5 == 0, at.astype(np.uint16).tobytes(), n.astype(np.uint32).tobytes()))
            yield _rows(out)
        yield _rows([(p, b, None, None, None, None) for p, b in parts(df)])

    counted = written(known.select("text", "lang", draw).mapInArrow(count, _COUNTED), "ngrams")
    n_docs = sum(sizes.values())
    idf = np.log((1 + n_docs) / (1 + summed(counted.filter("part is not null"), FEATURES))) + 1
    sample = sorted(counted.filter("lang is not null").select("lang", "calibrates", "at", "n").collect())
    release(counted)
    languages = sorted(sizes)
    number = {x: i for i, x in enumerate(languages)}
    rows = []
    for r in sample:
        at = np.frombuffer(r["at"], np.uint16).astype(np.int64)
        rows.append((at, weighted(at, np.frombuffer(r["n"], np.uint32), idf)))
    y = np.array([number[r["lang"]] for r in sample], np.int64)
    later = np.array([r["calibrates"] for r in sample], bool)
    fitted = np.flatnonzero(~later)
    w, bias = fit_ftrl([rows[i] for i in fitted], y[fitted], len(languages))
    logits = np.array([rows[i][1] @ w[rows[i][0]] + bias for i in np.flatnonzero(later)]).reshape(-1, len(languages))
    return Model(languages, w, bias, idf, fit_temperature(logits, y[later]))


_COUNTED = "part int, counts binary, lang string, calibrates boolean, at binary, n binary"
_COUNTED_ARROW = pa.schema([("part", pa.int32()), ("counts", pa.binary()), ("lang", pa.string()), ("calibrates", pa.bool_()), ("at", pa.binary()), ("n", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(_COUNTED_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _COUNTED_ARROW, strict=True)], schema=_COUNTED_ARROW)


def predict(docs: DataFrame, model: Model | None, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with two more columns: the language of each whole text, and its calibrated probability.

    A null text, a text without a letter, and any text if there is no model, get 'und' and 0.0. Only text is read.
    """
    # Features by languages; as a plain tuple, which any Python can read.
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else tuple(model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None if shared.value is None else Model(*shared.value)
        for batch in slices(batches, limit=STEP_BYTES):
            texts = batch.column("text").to_pylist()
            some = np.array([m is not None and t is not None and bool(_LETTER.search(t)) for t in texts], bool)
            names, p = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if some.any():
                found = m.probabilities([t for t, s in zip(texts, some, strict=True) if s])
                names[some] = np.array(m.languages, object)[found.argmax(axis=1)]
                p[some] = found.max(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(p)], [*batch.schema.names, lang_pred, score])

    # Arrow functions take no column whose name has a dot.
    named = docs.toDF(*(f"_dotted{i}" if "." in c else c for i, c in enumerate(docs.columns)))
    schema = T.StructType([*named.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return named.mapInArrow(run, schema).toDF(*docs.columns, lang_pred, score)


def identify_language(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score, by a model trained on docs.

    Rows with a null lang are predicted, not learned from; rows with a null doc_id are held out from learning. Repeated
    rows get equal results. Other columns are ignored. An empty table gives an empty result.
    """
    model = train(docs, fit_documents)
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")

"""Substring de-duplication: Rabin-Karp hashes of every 35-word window, counted over the whole corpus."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lectern.llm._blocks import BLOCK_BYTES, Distinct, answers, counted, deal, in_order
from lectern.llm._words import covered, per_text, rolling, words
from lectern.llm._words import hashes as word_hashes

WIDTH = 35


class _Windows:
    """The words of a block and its windows' hashes, in an order fixed by the block's rows."""

    def __init__(self, block: pa.Table, width: int):
        rows = in_order(block, "doc_id", "text")
        self.doc_id, text = rows["doc_id"].chunk(0), rows["text"].chunk(0)
        self.words = words(text)
        h, self.at = rolling(word_hashes(self.words.vocab)[self.words.ids], self.words.starts, width)
        self.distinct = Distinct(h)


def dedup_substrings(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, with_text: bool = False) -> DataFrame:
    """Remove each word that a repeated window covers; per row: doc_id, n_words, n_removed, kept_sha256.

    A window is `width` consecutive words of one text. It is repeated if its word sequence also starts anywhere else,
    in the same text or another. kept_sha256 is the hash of the kept words, joined by one space; with_text adds them as
    kept_text. A null text has no words. A row repeated with the same doc_id counts as another place. Other columns are
    ignored; an empty table gives an empty result.

    Documents are dealt into blocks by a hash of doc_id and text. A block sends each distinct hash once, with its count, to the hash's
    bucket. A bucket adds up the counts and answers each block: repeated or not. The blocks, whose shuffle is used
    again, then cut the words. Hashes have 64 bits: among n windows, about n * n / 2**65 pairs of different windows
    are taken for equal.
    """
    dealt, n = deal(docs.select("doc_id", "text"), block_bytes)

    def cut(block: pa.Table, found: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        x = _Windows(block, width)
        flags = answers(found).astype(bool)[x.distinct.at]
        w = x.words
        gone = covered(x.at[flags], width, len(w.ids))
        kept = np.zeros(len(w.ids) + 1, np.int64)
        np.cumsum(~gone, out=kept[1:])
        chosen = w.vocab.take(pa.array(w.ids[~gone]))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept[w.starts], pa.int32()), chosen), " ")
        out = {
            "doc_id": x.doc_id,
            "n_words": np.diff(w.starts),
            "n_removed": per_text(gone, w.starts),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts.cast(pa.binary()).to_pylist()], pa.string()),
        }
        return pa.table(out | ({"kept_text": texts} if with_text else {}))

    repeated = counted(dealt, n, lambda block: _Windows(block, width).distinct, lambda count: count > 1)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return dealt.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(cut, schema)


SQL = """
WITH w AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents
), p AS (
    SELECT doc_id, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM w
), h AS (
    SELECT p.doc_id, p.i, list_aggregate(ws[p.i : p.i + 34], 'string_agg', ' ') AS s FROM p JOIN w USING (doc_id)
), r AS (
    SELECT doc_id, i FROM h WHERE s IN (SELECT s FROM h GROUP BY s HAVING count(*) > 1)
), g AS (
    SELECT DISTINCT doc_id, i + k AS pos FROM r, range(35) t(k)
), a AS (
    SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w
), k AS (
    SELECT a.doc_id, count(*) AS n_kept, string_agg(a.word, ' ' ORDER BY a.pos) AS kept
    FROM a LEFT JOIN g ON a.doc_id = g.doc_id AND a.pos = g.pos WHERE g.pos IS NULL GROUP BY a.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""

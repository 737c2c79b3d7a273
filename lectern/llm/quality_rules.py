"""Quality rules from within-document repetition, found with a suffix array over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lectern.llm._words import Words, covered, per_text, slices, words

#: Words of a repeat that counts, the share of words that repeats may cover, the longest repeat allowed.
MIN_REPEAT, MAX_COVERED, MAX_REPEAT = 10, 0.30, 100

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, repeat_covered_words long, longest_repeat_words long, n_maximal_repeats long"
)


def suffix_array(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of all texts at once, and each entry's common prefix with the entry before it.

    Prefix doubling: suffixes are grouped by their first 1, 2, 4, ... words, and only groups of two or more are
    sorted again. The text's number is part of the first key, so that no prefix spans two texts. The ranks of each
    round then give the common prefixes of neighbours, largest power first.
    """
    n = len(w.ids)
    lengths = np.diff(w.starts)
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(w.starts[1:], lengths)
    key = text * np.int64(len(w.vocab) + 1) + w.ids
    order = np.argsort(key)
    slots, active, rank = np.arange(n), order, np.empty(n + 1, np.int64)
    rank[n] = -1
    key, levels, width = key[order], [], 1
    while True:
        new = np.ones(len(active), bool)
        new[1:] = key[1:] != key[:-1]
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        order[slots] = active
        rank[active] = first
        levels.append(rank.astype(np.int32))
        many = ~new
        many[:-1] |= ~new[1:]
        slots, active = slots[many], active[many]
        if not len(active):
            break
        after = active + width
        key = rank[active] * (n + 1) + np.where(after < ends[active], rank[np.minimum(after, n)] + 1, 0)
        by = np.argsort(key)
        active, key, width = active[by], key[by], 2 * width
    common = np.zeros(n + 1, np.int64)
    pair = np.arange(1, n)
    pair = pair[levels[0][order[pair]] == levels[0][order[pair - 1]]]
    a, b, got = order[pair - 1], order[pair], np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(a + got, n)] == levels[k][np.minimum(b + got, n)]
        got[same] += 1 << k
    common[pair] = got
    return order, common


def repeats(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Of each word position, the words of the longest repeat within the text that starts there."""
    out = np.zeros(len(order), np.int64)
    out[order] = np.maximum(common[:-1], common[1:]) if len(order) else 0
    return out


def prefix_intervals(common: np.ndarray, least: int) -> np.ndarray:
    """Rows (length, first, last) of the intervals of suffixes that share a prefix of `length` words, `least` or more,
    and no longer one: each is a repeat that no word to its right extends in all of its places."""
    found, stack, before = [], [], -2
    for i in [*np.flatnonzero(common >= least).tolist(), -1]:
        length = int(common[i]) if i == before + 1 else -1
        left = i
        while stack and stack[-1][0] > length:
            top, start = stack.pop()
            found.append((top, start - 1, before))
            left = start if length >= 0 else i
        if i < 0:
            break
        length = int(common[i])
        if not stack or stack[-1][0] < length:
            stack.append((length, left))
        before = i
    return np.array(found, np.int64).reshape(-1, 3)


def maximal_repeats(w: Words, order: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """A row (position of one place, length) of each maximal repeat: one that no word to either side extends in all of
    its places."""
    intervals = prefix_intervals(common, least)
    previous = -2 - np.arange(len(w.ids), dtype=np.int64)  # where a text starts there is no word, and none is shared
    inside = np.ones(len(w.ids), bool)
    inside[w.starts[:-1][np.diff(w.starts) > 0]] = False
    previous[1:] = np.where(inside[1:], w.ids[:-1], previous[1:])
    ranked = previous[order]
    changes = np.append(0, np.cumsum(ranked[1:] != ranked[:-1])) if len(order) else np.zeros(0, np.int64)
    length, first, last = intervals.T
    open_left = changes[last] > changes[first] if len(intervals) else np.zeros(0, bool)
    return np.stack([order[first[open_left]], length[open_left]], axis=1) if len(intervals) else np.zeros((0, 2), np.int64)


def measured(texts: pa.Array, min_repeat: int) -> dict[str, np.ndarray]:
    texts = pc.fill_null(texts, "")
    w = words(texts)
    n, starts = len(w.ids), w.starts
    order, common = suffix_array(w)
    longest = repeats(order, common)
    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    text = np.repeat(np.arange(len(texts)), np.diff(lines.offsets.to_numpy()))
    full = pc.not_equal(pc.ascii_trim_whitespace(flat), "").to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(flat)
    line = np.sort((text * np.int64(len(coded.dictionary) + 1) + coded.indices.to_numpy())[full])
    again = np.zeros(len(line), bool)
    again[1:] = line[1:] == line[:-1]
    dup = np.bincount(line[again] // (len(coded.dictionary) + 1), minlength=len(texts))
    size = pc.utf8_length(w.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    three, long = np.flatnonzero(longest >= 3), np.flatnonzero(longest >= min_repeat)
    maximal = np.searchsorted(starts, maximal_repeats(w, order, common, min_repeat)[:, 0], side="right") - 1
    most = np.zeros(len(texts), np.int64)
    some = np.diff(starts) > 0
    if n:
        most[some] = np.maximum.reduceat(longest, starts[:-1][some])
    return {
        "n_words": np.diff(starts),
        "word_chars": per_text(size[w.ids] if n else np.zeros(0, np.int64), starts),
        "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": dup,
        "n_repeat_words": per_text(covered(three, 3, n), starts),
        "repeat_covered_words": per_text(covered(long, longest[long], n), starts),
        "longest_repeat_words": most,
        "n_maximal_repeats": np.bincount(maximal, minlength=len(texts)),
    }


def score_repetition(
    docs: DataFrame,
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """Counts and verdict of each document: one row for each row of docs (doc_id, text).

    kept is false if the base rule fails (under 50 words, or over half of them in repeated 3-word windows), if
    repeats of min_repeat words or more cover over max_covered of the words, or if one has over max_repeat words.
    A null or empty text has no words and fails. Repeated rows are judged one by one; other columns are ignored.
    No shuffle: a document is judged on its own, in steps of some megabytes of text.
    """

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = measured(batch.column("text"), min_repeat)
            failed = (x["n_words"] < 50) | (100 * x["n_repeat_words"] > 50 * x["n_words"])
            kept = ~failed & (x["repeat_covered_words"] <= max_covered * x["n_words"]) & (x["longest_repeat_words"] <= max_repeat)
            cols = {"doc_id": batch.column("doc_id"), **x, "base_failed": failed, "kept": kept}
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(cols[c]) for c in names], names)

    return docs.select("doc_id", "text").mapInArrow(score, SCHEMA)

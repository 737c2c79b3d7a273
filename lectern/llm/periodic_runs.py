"""Periodic runs of words: tiles for each octave of periods are solved by Z-functions at their boundaries, and the
fragments found are stitched by document and period."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm._filter import bit_filter, with_match
from lectern.llm._store import written
from lectern.llm._words import BASE, INVERSE, Words, covered, mixed, powers, slices, words

#: A run has so many words at least, and so many times its period.
MIN_WORDS, MIN_PERIODS = 6, 4

FRAGMENTS = "doc_id long, text_hash long, period long, first long, last long"
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def tailed(n: int, doc_id: int) -> np.ndarray | None:
    """Places of the n words of a document whose tail is made periodic, one in ten by identifier; None for the others."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def periodic_tails(w: Words, ids: list[int | None]) -> Words:
    """Some texts with the tail of one in ten made periodic, as chosen by doc_id; texts without one stay as they are."""
    out = w.ids.copy()
    for i, doc_id in enumerate(ids):
        a, b = int(w.starts[i]), int(w.starts[i + 1])
        at = None if doc_id is None else tailed(b - a, doc_id)
        if at is not None:
            out[a:b] = w.ids[a:b][at]
    return w._replace(ids=out)


def z_function(x: list[int]) -> list[int]:
    """Of each place of x, how many values from there on equal those at its beginning."""
    n = len(x)
    z = [n] + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


def solve_tile(before: list[int], after: list[int], periods: list[int], reach: int) -> list[tuple[int, int, int]]:
    """(period, back, ahead) of the periods that hold around a boundary: words `period` apart are equal from `back`
    words before the boundary, len(before) at most, to `ahead` words after it.

    Two Z-functions give all periods at once: one of the words after the boundary, and one of those before it,
    reversed, with the tile reversed. Of periods that hold for `reach` words after the boundary, only those stay that
    are no multiple of another, by the word's first block.
    """
    ahead = z_function(after)
    held = [q for q in periods if q < len(after) and ahead[q] >= reach]
    primitive = [q for q in held if not any(ahead[q // r] >= q - q // r for r in prime_factors(q))]
    if not primitive:
        return []
    turned = before[::-1]
    back = z_function([*turned, -1, *reversed(before + after[: max(primitive)])])
    middle = len(turned) + 1 + max(primitive)
    return [(q, back[middle - q] if before else 0, ahead[q]) for q in primitive]


#: Pairs of a boundary and a period that one step compares.
STEP = 1 << 20


def fragments(w: Words) -> Iterator[tuple[int, int, int, int]]:
    """(text, period, first, last): words from first to last, exclusive, of a text equal those `period` further on.

    For periods of an octave [k, 2 k), a tile stands at each k-th word of a text: k words before that boundary, and
    5 k after it. A run of four periods has a boundary among its first k words, from where it goes on for over 2 k
    words; so tiles are left out in which no window of 2 k words at the boundary comes again within the octave, which
    hashes of all windows tell, or only inside a run of an octave before, whose period such a one is a multiple of.
    Tiles overlap by so much that the fragments of a run cover it.
    """
    n, starts = len(w.ids), w.starts
    lengths = np.diff(starts)
    values = mixed(np.arange(1, len(w.vocab) + 1, dtype=np.uint64))[w.ids] if n else np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(INVERSE, n), out=sums[1:])
    power, k, known = powers(BASE, n), 1, Known()
    while len(texts := np.flatnonzero(lengths >= MIN_PERIODS * k)):
        width = 2 * k
        windows = (sums[width:] - sums[:-width]) * power[: n - width + 1]
        each = (lengths[texts] - width) // k  # boundaries with a window, and another one k words on
        text = np.repeat(texts, each)
        boundary = starts[text] + k * (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each))
        for tile, periods in _repeating(windows, boundary, starts[text + 1] - width, known.end(boundary) - width, k):
            i, place = int(text[tile]), int(boundary[tile])
            low, high = int(starts[i]), int(starts[i + 1])
            before, after = w.ids[max(low, place - k) : place].tolist(), w.ids[place : min(high, place + 5 * k)].tolist()
            for q, back, ahead in solve_tile(before, after, periods, width):
                known.add(q, place - back, place + ahead)
                yield i, q, place - back - low, place + ahead - low
        k *= 2


class Known:
    """Stretches with a period that tiles have shown so far."""

    def __init__(self) -> None:
        self.fragments: list[tuple[int, int, int]] = []

    def add(self, period: int, first: int, last: int) -> None:
        self.fragments.append((period, first, last))

    def end(self, places: np.ndarray) -> np.ndarray:
        """Of each place, the end of the stretch with one period around it that goes on longest; 0 if there is none."""
        if not self.fragments:
            return np.zeros(len(places), np.int64)
        period, first, last = np.array(sorted(self.fragments), np.int64).T
        size = int(last.max()) + 2
        reached = np.maximum.accumulate(period * size + last)  # periods ascend: what came before has its own stretches
        new = np.append(True, (period * size + first)[1:] > reached[:-1])
        begin = first[new]
        end = np.maximum.reduceat(last, np.flatnonzero(new)) + period[new]
        order = np.argsort(begin)
        at = np.searchsorted(begin[order], places, side="right")
        return np.append(0, np.maximum.accumulate(end[order]))[at]


def _repeating(windows: np.ndarray, boundary: np.ndarray, last: np.ndarray, known: np.ndarray, k: int) -> Iterator[tuple[int, list[int]]]:
    """(tile, its periods in [k, 2 k) after which the window at its boundary seems to come again), where there are any.

    Windows are looked for in places after `known` and up to `last`, the last of the tile's text."""
    rows = max(1, STEP // k)
    for r in range(0, len(boundary), rows):
        b, end, start = boundary[r : r + rows], last[r : r + rows, None], known[r : r + rows, None]
        hit = np.zeros((len(b), k), bool)
        columns = max(1, STEP // len(b))
        for c in range(0, k, columns):
            at = b[:, None] + np.arange(k + c, k + min(c + columns, k))
            hit[:, c : c + columns] = (windows[np.minimum(at, end)] == windows[b][:, None]) & (at <= end) & (at > start)
        for i in np.flatnonzero(hit.any(axis=1)).tolist():
            yield r + i, (k + np.flatnonzero(hit[i])).tolist()


def _keyed(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with a hash of the text: rows that are equal in both are one document."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))


def find_fragments(keyed: DataFrame, tails: bool) -> DataFrame:
    """FRAGMENTS of documents (doc_id, text, text_hash), as they are found in tiles; no shuffle."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = words(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            found = np.array(list(fragments(periodic_tails(w, ids) if tails else w)), np.int64).reshape(-1, 4)
            text, period, first, last = (pa.array(x) for x in found.T)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(text), batch.column("text_hash").take(text), period, first, last], [c.split()[0] for c in FRAGMENTS.split(", ")])

    return keyed.mapInArrow(find, FRAGMENTS)


def stitched(found: DataFrame) -> DataFrame:
    """Runs (doc_id, text_hash, start, length, period) of fragments: those of a document and period that meet or overlap
    are one, and stay if long enough."""
    key = ["doc_id", "text_hash", "period"]
    order = Window.partitionBy(*key).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > reached, F.lit(True)).cast("int")
    island = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = found.distinct().withColumn("opens", opens).withColumn("island", island)
    runs = numbered.groupBy(*key, "island").agg(F.min("first").alias("start"), (F.max("last") + F.col("period") - F.min("first")).alias("length"))
    return runs.filter((F.col("length") >= MIN_WORDS) & (F.col("length") >= MIN_PERIODS * F.col("period"))).drop("island")


def find_runs(docs: DataFrame, tails: bool = False) -> DataFrame:
    """The maximal periodic runs of docs (doc_id, text): rows (doc_id, text_hash, start, length, period), in words from 0.

    A run is a stretch of consecutive words of which those `period`, its smallest, apart are identical, which no word to
    either side goes on with, and which has 6 words and 4 periods at least. A null or empty text has none. Rows that
    are equal in doc_id and text give their runs once; a null doc_id is one as any other; other columns are ignored.
    tails: of one document in ten, chosen by doc_id, the last words are first made periodic; one without doc_id isn't.

    Fragments alone are shuffled, by document and period; a document's are as many as its tiles at most, up to a factor.
    """
    return stitched(find_fragments(_keyed(docs), tails))


def _described(batch: pa.RecordBatch, tails: bool) -> pa.RecordBatch:
    """SCHEMA of documents (doc_id, text, runs): runs are structs of start, period and length, in that order, or null."""
    w = words(batch.column("text"))
    ids = batch.column("doc_id").to_pylist()
    w = periodic_tails(w, ids) if tails else w
    listed = batch.column("runs").to_pylist()
    gone = np.zeros(len(w.ids), bool)
    best, rows = [], []
    for i, runs in enumerate(listed):
        low, n, runs = int(w.starts[i]), int(w.starts[i + 1] - w.starts[i]), runs or []
        rows.append(hashlib.sha256("".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs).encode()).hexdigest())
        top = None
        for r in runs:  # by start, then period: the first of equals is the right one
            if top is None or r["length"] * top["period"] > top["length"] * r["period"]:
                top = r
        best.append(top)
        if runs:
            start, length, period = (np.array([r[c] for r in runs]) for c in ("start", "length", "period"))
            gone[low : low + n] = covered(start + period, length - period, n)
    kept = np.append(0, np.cumsum(~gone))[w.starts]
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), w.vocab.take(pa.array(w.ids[~gone]))), " ")
    collapsed = [hashlib.sha256(x.encode()).hexdigest() for x in texts.to_pylist()]
    columns = {
        "doc_id": batch.column("doc_id").cast(pa.int64()),
        "n_runs": pa.array([len(r or []) for r in listed], pa.int64()),
        **{c: pa.array([b and b[c] for b in best], pa.int64()) for c in ("start", "length", "period")},
        "exponent_milli": pa.array([b and 1000 * b["length"] // b["period"] for b in best], pa.int64()),
        "runs_sha256": pa.array(rows, pa.string()),
        "collapsed_sha256": pa.array(collapsed, pa.string()),
    }
    return pa.RecordBatch.from_pydict(columns)


def collapse_runs(docs: DataFrame, tails: bool = False) -> DataFrame:
    """One row for each row of docs (doc_id, text): its number of runs, as find_runs has them, the one of most periods
    (ties: least start, then period), and hashes of the list of runs and of the text without a run's words after its
    first period.

    A document without runs has four nulls, and the hash of its words; repeated rows are described alike.

    Only texts that may have runs, by a bit filter, are shuffled to meet them.
    """
    keyed = _keyed(docs)
    runs = find_runs(docs, tails).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    found = written(runs, "runs")
    of = F.xxhash64("doc_id", "text_hash").alias("of")
    flagged = with_match(keyed.select("*", of), "of", bit_filter(found.select(of), "of"), "some")
    asked = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "runs")
    some = flagged.filter("some").join(asked, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = flagged.filter("not some").withColumn("runs", F.lit(None).cast(found.schema["runs"].dataType))
    columns = ["doc_id", "text", "runs"]

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield _described(batch, tails)

    return none.select(*columns).unionByName(some.select(*columns)).mapInArrow(describe, SCHEMA)

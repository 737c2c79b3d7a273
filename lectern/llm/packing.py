"""Packing of token sequences into windows: non-negative least squares over a histogram of piece lengths."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm._ranks import ranked
from lectern.llm._store import written
from lectern.llm._words import slices

WINDOW, TOKENIZER, END_ID = 1024, "byte_bpe_50k", 0
#: Triples are enumerated with a smallest length on this grid; all pairs are. Rounds of the least-squares solver.
GRID, ROUNDS = 32, 400
#: Pieces of one length are ranked in parts of about so many rows.
PART_ROWS = 1 << 20
#: Successive pieces that are packed together where the order of documents counts; rows of one file are numbered in
#: parts of so many.
STRETCH, PART_OF_FILE = 1 << 13, 1 << 14

# What the fast tokenizer would not split as the reference one does, or only slowly.
_ODD = re.compile(r"<\||\S{2000}|\s{2000}")


def encoder(path: Callable[[str], str] = public_tokenizers.path, name: str = TOKENIZER) -> Callable[[str], np.ndarray]:
    """Text to ids of a byte-level BPE vocabulary, given as {name}.json and as ranks in {name}.tiktoken.

    Both files hold one vocabulary, and give the same ids; the ranks' library is the faster. Texts with special tokens
    or very long runs go to the library of the .json file, which is loaded when the first such text comes.
    """
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    with open(path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if not _ODD.search(text):
            return fast.encode_to_numpy(text)
        if not slow:
            slow.append(Tokenizer.from_file(path(f"{name}.json")))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def cut_pieces(docs: DataFrame, window: int = WINDOW, with_ids: bool = False, carried: str = "") -> DataFrame:
    """Pieces of each document's ids and end id: full windows, and one remainder that may be full as well. carried: names
    and types of columns of docs that its pieces keep."""
    kept = [c.split() for c in carried.split(", ") if c]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()  # in a twentieth of a second
        for batch in slices(batches):
            out: list[tuple] = []
            sizes: list[int] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text or ""), END_ID).astype("<u4")
                sizes.append(-(-len(ids) // window))
                for s in range(0, len(ids), window):
                    piece = ids[s : s + window]
                    out.append((doc_id, s, len(piece), zlib.crc32(piece.tobytes()), len(ids), *([piece.astype(np.int32)] if with_ids else [])))
            cols = list(zip(*out, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(c, pa.list_(pa.int32())) for c in cols[5:]]
            row_of = np.repeat(np.arange(len(sizes)), sizes)
            arrays += [batch.column(c).take(pa.array(row_of)) for c, _ in kept]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids, *(c for c, _ in kept)])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids + "".join(f", {c} {t}" for c, t in kept)
    return docs.select("doc_id", "text", *(c for c, _ in kept)).mapInArrow(run, schema)


def combinations(present: np.ndarray, window: int = WINDOW, grid: int = GRID) -> np.ndarray:
    """Shallow combinations that fill a window: rows of three ascending lengths; 0 stands for none."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    has[0] = True
    out = []
    for a in [0, *(x for x in present if x % grid == 0 and 3 * x <= window)]:
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        c = window - a - b
        good = has[b] & has[c]
        out.append(np.stack([np.full(good.sum(), a), b[good], c[good]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def least_squares(columns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 of each combination that bring A x near to counts, by multiplicative updates.

    Column j of A holds how often combination j has each length. Entry 0 of counts is not a length.
    """
    h = counts.astype(float).copy()
    h[0] = 0
    real = columns > 0
    x = np.full(len(columns), h.sum() / max(1, 3 * len(columns)))
    target = (h[columns] * real).sum(axis=1)
    for _ in range(rounds):
        filled = np.bincount(columns[real], weights=np.repeat(x, 3).reshape(-1, 3)[real], minlength=len(h))
        x *= target / np.maximum((filled[columns] * real).sum(axis=1), 1e-12)
    return x


def plan_windows(counts: np.ndarray, window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: how many}, windows) that use up a histogram of lengths 1 ... window.

    Full pieces stand alone. Solved repeats are rounded down, largest first, to what is left; the rest is packed
    greedily, the longest piece with the longest that still fit. Work depends on the window's length, not on counts.
    """
    left = counts.astype(np.int64).copy()
    plan: list[tuple[dict[int, int], int]] = []

    def take(pattern: dict[int, int], times: int) -> None:
        for length, k in pattern.items():
            left[length] -= k * times
        plan.append((pattern, times))

    if left[window]:
        take({window: 1}, int(left[window]))
    columns = combinations(np.flatnonzero(left[1:window]) + 1, window)
    if len(columns):
        x = np.floor(least_squares(columns, left) + 1e-9).astype(np.int64)
        for j in np.argsort(-x, kind="stable"):
            lengths, k = np.unique(columns[j][columns[j] > 0], return_counts=True)
            times = min(int(x[j]), int((left[lengths] // k).min()))
            if times > 0:
                take({int(a): int(b) for a, b in zip(lengths, k, strict=True)}, times)
    while left.any():
        pattern: dict[int, int] = {}
        room = window
        while room and (fits := np.flatnonzero(left[1 : room + 1])).size:
            length = int(fits[-1]) + 1
            k = min(room // length, int(left[length]) - pattern.get(length, 0))
            if k < 1:
                smaller = np.flatnonzero(left[1:length])
                smaller = [s + 1 for s in smaller if left[s + 1] > pattern.get(s + 1, 0)]
                if not smaller:
                    break
                length = int(smaller[-1])
                k = min(room // length, int(left[length]) - pattern.get(length, 0))
            pattern[length] = pattern.get(length, 0) + k
            room -= k * length
        take(pattern, min(int(left[a]) // k for a, k in pattern.items()))
    return plan


class Layout:
    """A plan's place for each piece, by its length and its rank within that length."""

    def __init__(self, counts: np.ndarray, window: int):
        rows, first, sequence = [], np.zeros(window + 1, np.int64), 0
        for pattern, times in plan_windows(counts, window):
            offset = 0
            for length, k in sorted(pattern.items(), reverse=True):
                rows.append((length, first[length], k, sequence, offset))
                first[length] += k * times
                offset += k * length
            sequence += times
        self.plan = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.keys = (self.plan[:, 0] << 48) | self.plan[:, 1]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        at = np.searchsorted(self.keys, (length << 48) | rank, side="right") - 1
        _, start, k, base, offset = self.plan[at].T
        return base + (rank - start) // k, offset + (rank - start) % k * length


def pack(docs: DataFrame, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, text), placed in windows; one row for each piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null text is empty, and so is one
    piece: the end id. Documents are cut only at multiples of the window. Rows repeated with the same doc_id are packed
    like any other; other columns are ignored; an empty table gives an empty result.

    The texts are read once: pieces are written before they are counted, ranked and placed. The driver sees the
    histogram of lengths, and sends back the plan: both are bounded by the window's length. Pieces are ranked within
    their length in parts of bounded size, so that one frequent length is shared among tasks.
    """
    pieces = written(cut_pieces(docs, window, with_ids), "pieces")
    counts = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[r["length"]] = r["n"]
    layout = Layout(counts, window)

    n_parts = max(16, -(-int(counts.max()) // PART_ROWS))
    ranked_pieces = ranked(pieces, "length", F.xxhash64("doc_id", "start"), ["doc_id", "start"], n_parts)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = layout.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    types = ", ".join(f"{c} {'array<int>' if c == 'ids' else 'long'}" for c in [*names, "sequence_id", "offset"])
    return ranked_pieces.select(*names, "rank").mapInArrow(place, types)


def in_file_order(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with _file and _at: where each row stands. Of tables that were just read, the file, in the
    order that Spark numbers those it writes, and the row there; of others, the partition and the row there."""
    try:
        told = docs.metadataColumn("_metadata")
    except AnalysisException:  # not a table as it was read
        rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
        part = F.lpad(F.shiftright("_row", 33).cast("string"), 12, "0")
        return rows.select("doc_id", "text", part.alias("_file"), F.col("_row").bitwiseAND((1 << 33) - 1).alias("_at"))
    name = told["file_name"]
    number = F.lpad(F.regexp_extract(name, r"^part-(\d+)", 1), 12, "0")
    return docs.select("doc_id", "text", F.concat(number, name).alias("_file"), told["row_index"].alias("_at"))


def pack_in_order(docs: DataFrame, window: int = WINDOW, stretch: int | None = None) -> DataFrame:
    """As pack, but windows follow the order of the rows of docs, as far as packing lets them.

    Pieces are numbered in that order, and STRETCH successive ones are packed among themselves. Windows of a stretch
    come after those of the stretches before it, and are ordered by the earliest piece that they hold. So any share that
    holds for each stretch of rows holds for the windows as they are read, and a window holds rows that stand near.

    A stretch is bounded, whatever the table; no task sees more than one at a time. Numbers are made in parts of files.
    """
    pieces = written(cut_pieces(in_file_order(docs), window, carried="_file string, _at long"), "pieces")
    parted = pieces.withColumn("_part", F.floor(F.col("_at") / PART_OF_FILE))
    before = F.sum("_n").over(Window.orderBy("_file", "_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = parted.groupBy("_file", "_part").agg(F.count("*").alias("_n")).select("_file", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    row = F.row_number().over(Window.partitionBy("_file", "_part").orderBy("_at", "start"))
    n = (F.col("_before") + F.col("_own") - 1).alias("n")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    numbered = parted.withColumn("_own", row).join(sizes, ["_file", "_part"]).select(*names, n)

    def place(found: pa.Table) -> pa.Table:
        found = found.sort_by("n")
        length = found["length"].to_numpy()
        counts = np.bincount(length, minlength=window + 1)
        by_length, rank = np.argsort(length, kind="stable"), np.empty(len(length), np.int64)
        rank[by_length] = np.arange(len(length)) - (np.cumsum(counts) - counts)[length[by_length]]
        sequence, offset = Layout(counts, window).place(length, rank)
        _, first, of = np.unique(sequence, return_index=True, return_inverse=True)
        order = np.empty(len(first), np.int64)
        order[np.argsort(first)] = np.arange(len(first))
        return found.drop_columns(["n"]).append_column("sequence_id", pa.array(order[of])).append_column("offset", pa.array(offset))

    types = ", ".join(f"{c} long" for c in ["stretch", *names, "sequence_id", "offset"])
    placed = numbered.select(F.floor(F.col("n") / (stretch or STRETCH)).alias("stretch"), *names, "n").groupBy("stretch").applyInArrow(place, types)
    placed = written(placed, "placed")
    before = F.sum("_n").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    sizes = placed.groupBy("stretch").agg((F.max("sequence_id") + 1).alias("_n")).select("stretch", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(sizes, "stretch").select(*names, (F.col("_before") + F.col("sequence_id")).alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """Whole windows of a result of pack(with_ids=True): sequence_id, ids without padding."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))

"""Fill-in-middle documents: both cuts are found by ranks in a wavelet matrix over the classes of a text's bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lectern.llm._words import slices

#: Marks before the three parts, shares in per cent of rearranged documents and of suffix-first ones among them.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
REARRANGED, SUFFIX_FIRST, SEED = 50, 80, 42

#: Text bytes in one wavelet matrix, which takes some 10 bytes for each; a longer text has one of its own.
MATRIX_BYTES = 4 << 20

#: Flags that make up a byte's class: it ends a unit, it is white space, it begins a code point.
END, SPACE, LEAD = 1, 2, 4
CLASSES = 8

TEXT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Bits:
    """A sequence of bits with the number of ones before each 64th, so that a rank adds up one word at most."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros(-(-(self.n + 1) // 64) * 64, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first `at` bits."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    """Ranks of small numbers in a sequence: one row of bits for each binary digit, highest first; each row stands in
    the order that the rows before it give, zeros in front."""

    def __init__(self, values: np.ndarray, digits: int):
        self.rows: list[tuple[Bits, int]] = []
        for digit in reversed(range(digits)):
            bit = (values >> digit) & 1
            self.rows.append((Bits(bit), int(len(bit) - np.count_nonzero(bit))))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, value: int, at: np.ndarray) -> np.ndarray:
        """How often value occurs among the first `at` numbers."""
        first = np.zeros_like(at)
        for i, (bits, zeros) in enumerate(self.rows):
            one = value >> (len(self.rows) - 1 - i) & 1
            first, at = (zeros + bits.rank(first), zeros + bits.rank(at)) if one else (first - bits.rank(first), at - bits.rank(at))
        return at - first

    def rank_any(self, flag: int, at: np.ndarray) -> np.ndarray:
        """How many of the first `at` numbers have the flag: the ranks of all values with it, added up."""
        return sum((self.rank(v, at) for v in range(1 << len(self.rows)) if v & flag), np.zeros_like(at))


def byte_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte of some texts; text i is data[starts[i]:starts[i + 1]].

    A unit is a word with the white space before it, or the white space at a text's end: it ends where a word does, and
    where a text does.
    """
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    end = np.zeros(len(data), bool)
    end[:-1] = ~space[:-1] & space[1:]
    end[starts[1:][np.diff(starts) > 0] - 1] = True
    return END * end.astype(np.uint8) + SPACE * space.astype(np.uint8) + LEAD * ((data & 0xC0) != 0x80).astype(np.uint8)


def located(matrix: WaveletMatrix, starts: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Where the first units[i] units of text i end, in bytes of all texts: bisection on the rank of boundaries."""
    wanted = matrix.rank_any(END, starts[:-1]) + units
    low, high = starts[:-1].copy(), starts[1:].copy()
    while (low < high).any():
        middle = (low + high) >> 1
        enough = matrix.rank_any(END, middle) >= wanted
        low, high = np.where(enough, low, np.minimum(middle + 1, high)), np.where(enough, middle, high)
    return low


def drawn(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers that the identifier draws; one that is null draws as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def restored(output: str, form: str) -> str:
    """The text that an output was made of. No mark is in a text that was cut, so that the first ones found are ours."""
    if form == "plain":
        return output
    if form == "psm":
        prefix, _, rest = output.removeprefix(PREFIX).partition(SUFFIX)
        suffix, _, middle = rest.partition(MIDDLE)
    else:
        suffix, _, rest = output.removeprefix(SUFFIX).partition(PREFIX)
        prefix, _, middle = rest.partition(MIDDLE)
    return prefix + middle + suffix


def _transformed(batch: pa.RecordBatch, seed: int, rearranged: int, suffix_first: int) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
    ids = batch.column("doc_id").to_pylist()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2] or pa.py_buffer(b"")
    raw = memoryview(buffer)[int(offsets[0]) : int(offsets[-1])]
    starts = offsets - offsets[0]
    matrix = WaveletMatrix(byte_classes(np.frombuffer(raw, np.uint8), starts), CLASSES.bit_length() - 1)
    ends = matrix.rank_any(END, starts)
    n = np.diff(ends)
    draws = np.array([drawn(i, seed) for i in ids], np.int64).reshape(-1, 4)
    a, b = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
    first, second = located(matrix, starts, np.minimum(a, b)), located(matrix, starts, np.maximum(a, b))
    lead = [matrix.rank_any(LEAD, at) for at in (starts[:-1], first, second)]
    marked = pc.match_substring_regex(texts.cast(pa.large_string()), "<[PSM]>").to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (draws[:, 2] % 100 >= rearranged)
    spm = draws[:, 3] % 100 < suffix_first
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    out = []
    for i in range(len(ids)):
        x, y, z, e = (int(v) for v in (starts[i], first[i], second[i], starts[i + 1]))
        if plain[i]:
            out.append(bytes(raw[x:e]))
        else:
            prefix, middle, suffix = raw[x:y], raw[y:z], raw[z:e]
            out.append(b"".join((s, suffix, p, prefix, m, middle) if spm[i] else (p, prefix, s, suffix, m, middle)))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id").cast(pa.int64()),
            "n": pa.array(n, pa.int64()),
            "form": pa.array(form.tolist(), pa.string()),
            "prefix_chars": pa.array(lead[1] - lead[0], pa.int64(), mask=plain),
            "middle_chars": pa.array(lead[2] - lead[1], pa.int64(), mask=plain),
            "output": pa.array(out, pa.binary()).cast(pa.string()),
        }
    )


def fill_in_middle(docs: DataFrame, seed: int = SEED, rearranged: int = REARRANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Each document (doc_id, text) as text for training to fill in a middle: one row for each row of docs, with its
    number of units n, its form, the code points before and in the middle part, and the output.

    Of all documents, `rearranged` per cent are cut at two unit ends drawn by doc_id and seed; of those, `suffix_first`
    per cent start with the suffix. The others are plain, as are texts that hold a mark. A null text is an empty one,
    and has no units; repeated rows are cut alike; other columns are ignored. No shuffle: texts are cut in steps of
    some megabytes, and none is held more than a few times.
    """

    def transform(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=MATRIX_BYTES):
            yield _transformed(batch, seed, rearranged, suffix_first)

    return docs.select("doc_id", "text").mapInArrow(transform, TEXT_SCHEMA)


DIGEST_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def digests(found: DataFrame) -> DataFrame:
    """Transformed documents with hashes of the output, and of the text rebuilt from output and form."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            outputs, forms = batch.column("output").to_pylist(), batch.column("form").to_pylist()
            made = [hashlib.sha256(x.encode()).hexdigest() for x in outputs]
            back = [hashlib.sha256(restored(x, f).encode()).hexdigest() for x, f in zip(outputs, forms, strict=True)]
            kept = [batch.column(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.string()), pa.array(back, pa.string())], [c.split()[0] for c in DIGEST_SCHEMA.split(", ")])

    return found.mapInArrow(digest, DIGEST_SCHEMA)


_WS = r"[\x20\x09-\x0D]"
_UNIT = rf"{_WS}*[^\x20\x09-\x0D]+|{_WS}+"

SQL = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), units AS (
    SELECT doc_id, t, regexp_extract_all(t, '{_UNIT}') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM texts
), cuts AS (
    SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM units
), parts AS (
    SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix,
        CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= {REARRANGED} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM cuts
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
        ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""

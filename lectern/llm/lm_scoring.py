"""Language-model scoring: a causal self-attention model, trained in numpy on subword ids of the corpus itself."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm._blocks import MOST_BUCKETS, Distinct, bucketed, deal, in_order
from lectern.llm._counters import parts, summed
from lectern.llm._store import written
from lectern.llm._words import Words, hashes, keep_freed_memory, per_text, per_worker, sums, words

TOKENIZER = "byte_bpe_50k"
#: Positions of a window, and how many of them, at its start, only give context to those after them.
SPAN, OVERLAP = 32, 8
#: Width of embedding and attention, and the output's clusters of ids by falling frequency: how many there are of each
#: size. As many ids are told apart, on either side.
WIDTH = 16
SIZES = np.repeat([16, 32, 64, 128, 512], [4, 6, 4, 4, 2])
INPUTS, CLUSTERS, FIRST = int(SIZES.sum()), len(SIZES), np.cumsum(SIZES) - SIZES
CLUSTER_OF = np.append(np.repeat(np.arange(CLUSTERS, dtype=np.uint8), SIZES), np.uint8(CLUSTERS))  # no target, -1: the last
#: Rounds of training; windows in a step; rate of the steps, and what it is multiplied by in each further round.
ROUNDS, BATCH, RATE, DECAY = 8, 512, 0.08, 0.7
#: Steps that a small block is cut into, by smaller ones at a lower rate; a full block has more.
LEAST_STEPS = 64
#: Share of the attention model in the mixture with the base that scores a text.
MIXED = 0.5
#: Text bytes of a block of documents. Each block of training documents is the share of one local run.
BLOCK_BYTES = 4 << 20
#: Parameters travel in parts of so many, and are added up in groups of so many blocks.
PART, FAN = 1 << 14, 64
#: Words whose subwords a worker remembers at most, and bytes of the longest of them: some 50 MB.
KNOWN, KNOWN_BYTES = 1 << 20, 32


class Subwords:
    """Ids of words, each as if after a space, by the ranks of a byte-level BPE vocabulary. Each worker reads its own, and
    remembers words: a block shares most of its own with the blocks before it."""

    def __init__(self, path: Callable[[str], str] = public_tokenizers.path, name: str = TOKENIZER):
        import tiktoken

        with open(path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.begins = np.zeros(self.size, bool)
        self.begins[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self.words, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, np.uint16), np.zeros(1, np.int64)
        self.hashes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # of the words, by ascending hash

    def __call__(self, vocab: pa.Array, distinct: Distinct) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids; where among them those of each word start, and how many these are. distinct: the words' hashes.

        A hash finds a word that is remembered; it is taken only if it is the same."""
        at = np.full(len(vocab), -1)
        if len(self.words):
            near = self.place[np.minimum(np.searchsorted(self.hashes, distinct.values), len(self.hashes) - 1)][distinct.at]
            at = np.where(pc.equal(self.words.take(pa.array(near)), vocab).to_numpy(zero_copy_only=False), near, -1)
        new = np.flatnonzero(at < 0)
        short = pc.less_equal(pc.binary_length(vocab.take(pa.array(new))), KNOWN_BYTES).to_numpy(zero_copy_only=False)
        new = np.append(new[short], new[~short])  # those to remember come first
        fresh, n = vocab.take(pa.array(new)), len(self.words)
        kept = min(int(short.sum()), KNOWN - n)
        found, first = self.encode(fresh)
        at[new] = np.arange(n, n + len(new))
        ids, ends = np.append(self.ids, found.astype(np.uint16)), np.append(self.ends, self.ends[-1] + first[1:])
        if kept:
            h = distinct.values[distinct.at[new[:kept]]]
            order = np.argsort(h)
            to = np.searchsorted(self.hashes, h[order])
            self.hashes, self.place = np.insert(self.hashes, to, h[order]), np.insert(self.place, to, n + order)
            self.words, self.ends = pa.concat_arrays([self.words, fresh[:kept]]), ends[: n + kept + 1].copy()
            self.ids = ids[: self.ends[-1]].copy()
        return ids, ends[at], ends[at + 1] - ends[at]

    def encode(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids, and where those of each word start (one more than words)."""
        if not len(vocab):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(vocab)], pa.int32()), vocab), " ")[0].as_py()
        ids = self.encoding.encode_to_numpy(" " + joined)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(vocab):  # white space beyond ASCII inside words can join them
            each = [self.encoding.encode_ordinary(" " + w) for w in vocab.to_pylist()]
            ids = np.concatenate(each).astype(np.int64)
            starts = np.cumsum([0, *map(len, each[:-1])])
        return ids, np.append(starts, len(ids))


class Coding(NamedTuple):
    """What ids are to the model: a row of its input tables, a slot of its output, and their share of that slot."""

    row: np.ndarray
    slot: np.ndarray
    log_share: np.ndarray
    log_prior: np.ndarray  # of the slots

    @classmethod
    def of(cls, counts: np.ndarray, ends: int) -> Coding:
        """From counts of all ids. INPUTS - 2 frequent ids have a row and a slot each, in order of frequency.

        The others share a row, and a slot within which they are told apart by their counts. The last row is for what
        stands before a text; the last slot is for its end, which is the last id.
        """
        n = len(counts)
        order = np.argsort(-counts, kind="stable")
        row = np.full(n + 1, INPUTS - 2)
        row[order[: INPUTS - 2]] = np.arange(min(n, INPUTS - 2))
        slot = row.copy()
        slot[n] = INPUTS - 1
        weight = np.append(counts + 0.5, ends + 0.5)
        total = np.bincount(slot, weights=weight, minlength=INPUTS)
        return cls(row.astype(np.int16), slot.astype(np.int16), np.log(weight / total[slot]), np.log((total + 0.5) / (total + 0.5).sum()))


Parameters = dict[str, np.ndarray]


def initial(coding: Coding, seed: int = 0) -> Parameters:
    """Small random weights around the slots' prior, which an untrained model gives for any context."""
    r = np.random.default_rng(seed)
    cluster = np.log(np.add.reduceat(np.exp(coding.log_prior), FIRST))
    draw = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    return {
        "embed": draw(INPUTS, WIDTH, scale=0.5),
        "key": draw(WIDTH, WIDTH, scale=WIDTH**-0.5),
        "query": draw(WIDTH, WIDTH, scale=1 / WIDTH),
        "self": draw(WIDTH, WIDTH, scale=WIDTH**-0.5),
        "distance": np.maximum(-0.5 * np.arange(SPAN), -3).astype(np.float32),
        "cluster": draw(WIDTH, CLUSTERS, scale=0.05),
        "cluster_bias": cluster.astype(np.float32),
        "slot": draw(WIDTH, INPUTS, scale=0.05),
        "slot_bias": (coding.log_prior - np.repeat(cluster, SIZES)).astype(np.float32),
    }


_STEP = SPAN - OVERLAP
#: Of each scored position of a window, how far back each position lies; what lies ahead is masked.
_DISTANCE = np.arange(OVERLAP, SPAN)[:, None] - np.arange(SPAN)
_AHEAD = np.where(_DISTANCE < 0, -np.inf, 0).astype(np.float32)
_DISTANCE = np.maximum(_DISTANCE, 0)
#: Exponents are kept within these limits, for content, distance and output, so that sums stay finite and above zero.
_CONTENT, _FAR, _OUTPUT = 50, 30, 60


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, as a product with ones."""
    return x @ np.ones(x.shape[-1], x.dtype)


def _scores(u: np.ndarray, weights: np.ndarray, bias: np.ndarray, far: bool) -> np.ndarray:
    """Exponents of the output, (outputs, positions), for u, which lies within -1 and 1; weights that could pass the limit
    (far) are rare. Outputs come first so that what is done to each position runs along many of them."""
    z = weights.T @ u.T
    z += bias[:, None]
    return np.clip(z, -_OUTPUT, _OUTPUT, out=z) if far else z


def _totals(z: np.ndarray) -> np.ndarray:
    """Sums over the first axis, as a product with ones."""
    return np.ones(len(z), z.dtype) @ z


def _far(weights: np.ndarray, bias: np.ndarray, first: np.ndarray) -> list[bool]:
    """Of ranges of outputs that start there, which could pass the limit."""
    return (np.maximum.reduceat(np.abs(weights).sum(axis=0) + np.abs(bias), first) > _OUTPUT).tolist()


def _late(p: Parameters) -> np.ndarray:
    """What makes an embedding a query, as its keys would meet it, and what it adds to its own position: (WIDTH, 2 WIDTH).

    A query meets keys as late @ query @ (e @ key).T, so that both are one product, and keys are the embeddings.
    """
    return np.hstack([p["query"] @ p["key"].T, p["self"]])


def attend(p: Parameters, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Masked attention of the scored positions over windows of rows x: (batch, SPAN). Keys and values are the embeddings.

    Returns these, both as rows and turned, with a row of ones below; queries, exponentials, one over their sums, what
    was read, and the result.
    """
    asked, own = (np.ascontiguousarray(v) for v in np.hsplit(p["embed"] @ _late(p), 2))  # of each row, once
    e, q, own = np.take(p["embed"], x, axis=0), np.take(asked, x[:, OVERLAP:], axis=0), np.take(own, x[:, OVERLAP:], axis=0)
    turned = np.empty((len(x), WIDTH + 1, SPAN), e.dtype)  # in one piece, which halves the time of its products
    turned[:, :WIDTH], turned[:, WIDTH] = e.transpose(0, 2, 1), 1
    a = np.matmul(q, turned[:, :WIDTH])
    if len(x) and float(np.abs(asked).max() * np.abs(p["embed"]).max()) * WIDTH > _CONTENT:
        np.clip(a, -_CONTENT, _CONTENT, out=a)
    a += np.clip(p["distance"], -_FAR, _FAR)[_DISTANCE] + _AHEAD
    np.exp(a, out=a)
    part = (1 / _sums(a))[..., None]
    read = np.matmul(a, e)
    read *= part
    h = np.add(read, own, out=own)
    return (e, turned), q, a, part, read, np.tanh(h, out=h)


def _by_cluster(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The positions with a target, by its cluster; the clusters; and each cluster's range among them."""
    cluster = CLUSTER_OF[y.ravel()]
    n = np.bincount(cluster, minlength=CLUSTERS)[:CLUSTERS]
    ends = np.cumsum(n)
    order = np.argsort(cluster, kind="stable")[: ends[-1]]
    return order, np.repeat(np.arange(CLUSTERS), n), [(c, int(b - k), int(b)) for c, (b, k) in enumerate(zip(ends, n, strict=True)) if k]


def log_probabilities(p: Parameters, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probability of slot y at each scored position of windows x; y = -1: 0.

    A slot's probability is its cluster's times its own within the cluster; both depend on what was read.
    """
    real, cluster, ranges = _by_cluster(y)
    target = y.ravel()[real]
    u = np.take(attend(p, x)[-1].reshape(-1, WIDTH), real, axis=0)
    z = _scores(u, p["cluster"], p["cluster_bias"], *_far(p["cluster"], p["cluster_bias"], FIRST[:1]))
    found = z[cluster, np.arange(len(real))]
    total, inner = _totals(np.exp(z, out=z)), np.empty(len(real), z.dtype)
    far = _far(p["slot"], p["slot_bias"], FIRST)
    for c, i, j in ranges:
        a, b = FIRST[c], FIRST[c] + SIZES[c]
        z = _scores(u[i:j], p["slot"][:, a:b], p["slot_bias"][a:b], far[c])
        found[i:j] += z[target[i:j] - a, np.arange(j - i)]
        inner[i:j] = _totals(np.exp(z, out=z))
    out = np.zeros(y.size)
    out[real] = found - np.log(total) - np.log(inner)
    return out.reshape(y.shape)


def _by_row(x: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sums of each of some values, one for each entry of x, over the entries with the same row."""
    at = x.ravel().astype(np.uint16)
    order = np.argsort(at, kind="stable")
    ranked = at[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    found = []
    for v in values:
        out = np.zeros((INPUTS, v.shape[-1]), v.dtype)
        pairs = np.result_type(v.dtype, 1j)  # two numbers are added at a time, as parts of a complex one
        out.view(pairs)[ranked[first]] = np.add.reduceat(np.take(v.reshape(at.size, -1).view(pairs), order, axis=0), first, axis=0)
        found.append(out)
    return found


def gradients(p: Parameters, x: np.ndarray, y: np.ndarray) -> Parameters:
    """Of the mean loss over scored positions with y other than -1."""
    (e, turned), q, a, part, read, h = attend(p, x)
    real, cluster, ranges = _by_cluster(y)
    target = y.ravel()[real]
    u = np.take(h.reshape(-1, WIDTH), real, axis=0)
    scale = h.dtype.type(1 / max(1, len(target)))

    def of_scores(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        np.exp(z, out=z)
        z *= scale / _totals(z)
        z[at, np.arange(len(at))] -= scale
        return z

    dz = of_scores(_scores(u, p["cluster"], p["cluster_bias"], *_far(p["cluster"], p["cluster_bias"], FIRST[:1])), cluster)
    grads = {"cluster": u.T @ dz.T, "cluster_bias": _sums(dz), "slot": np.zeros_like(p["slot"]), "slot_bias": np.zeros_like(p["slot_bias"])}
    du = dz.T @ p["cluster"].T
    far = _far(p["slot"], p["slot_bias"], FIRST)
    for c, i, j in ranges:
        s, t = FIRST[c], FIRST[c] + SIZES[c]
        weights = p["slot"][:, s:t]
        dz = of_scores(_scores(u[i:j], weights, p["slot_bias"][s:t], far[c]), target[i:j] - s)
        grads["slot"][:, s:t], grads["slot_bias"][s:t] = u[i:j].T @ dz.T, _sums(dz)
        du[i:j] += dz.T @ weights.T
    u *= u
    du *= np.subtract(1, u, out=u)
    place = np.full(y.size, len(real))
    place[real] = np.arange(len(real))
    du = np.take(np.vstack([du, np.zeros((1, WIDTH), du.dtype)]), place, axis=0).reshape(h.shape)
    dh = np.empty((*h.shape[:2], WIDTH + 1), h.dtype)  # beside gradients, what the row of ones takes away
    np.multiply(du, part, out=dh[..., :WIDTH])
    np.negative(np.einsum("bij,bij->bi", dh[..., :WIDTH], read), out=dh[..., WIDTH])
    ds = np.matmul(dh, turned)
    ds *= a
    grads["distance"] = np.bincount(_DISTANCE.ravel(), weights=_totals(ds.reshape(len(ds), -1)), minlength=SPAN).astype(h.dtype)
    de = np.matmul(a.transpose(0, 2, 1), dh[..., :WIDTH])
    de += np.matmul(ds.transpose(0, 2, 1), q)
    late = np.hstack(_by_row(x[:, OVERLAP:], np.matmul(ds, e), du))  # gradients of q and, beside them, of h
    grads["embed"] = _by_row(x, de)[0] + late @ _late(p).T
    both, grads["self"] = np.hsplit(p["embed"].T @ late, 2)
    grads["query"], grads["key"] = both @ p["key"], both.T @ p["query"]
    return grads


class Adam:
    """Steps of parameters, which become views of one array."""

    def __init__(self, p: Parameters, rate: float = RATE):
        self.flat, self.names, self.rate, self.t = np.concatenate([v.ravel() for v in p.values()]), list(p), rate, 0
        self.m, self.v, self.at = np.zeros_like(self.flat), np.zeros_like(self.flat), np.empty_like(self.flat)
        ends = np.cumsum([v.size for v in p.values()])
        p.update({k: x.reshape(p[k].shape) for k, x in zip(p, np.split(self.flat, ends[:-1]), strict=True)})

    def step(self, grads: Parameters) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        g, at = np.concatenate([grads[k].ravel() for k in self.names]), self.at
        self.m += np.multiply(np.subtract(g, self.m, out=at), np.float32(0.1), out=at)
        g *= g
        self.v += np.multiply(np.subtract(g, self.v, out=at), np.float32(0.01), out=at)
        np.sqrt(self.v, out=at)
        at += np.float32(1e-8)
        np.divide(self.m, at, out=at)
        at *= np.float32(scale)
        self.flat -= at


class Encoded(NamedTuple):
    """Subword ids of some texts: text i has ids[starts[i]:starts[i + 1]]."""

    ids: np.ndarray
    starts: np.ndarray


def encoded(w: Words, subwords: Subwords, distinct: Distinct | None = None) -> Encoded:
    ids, first, length = subwords(w.vocab, distinct or Distinct(hashes(w.vocab)))
    length = length[w.ids]
    ends = np.cumsum(length)
    flat = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(first[w.ids] - (ends - length), length)
    return Encoded(ids[flat], np.append(0, ends)[w.starts])


def windows(e: Encoded, a: int, b: int, coding: Coding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of texts a ... b - 1: rows (n, SPAN), target slots (n, SPAN - OVERLAP) or -1, and the text of
    each window, counted from a. Each id and each end of text is the target of one position."""
    size = np.diff(e.starts[a : b + 1])
    flat = e.ids[e.starts[a] : e.starts[b]]
    count = -(-(size + 1) // _STEP)
    room = OVERLAP + count * _STEP
    base = np.cumsum(room) - room
    x, y = np.full(room.sum() + SPAN, INPUTS - 1, np.int16), np.full(room.sum() + SPAN, -1, np.int16)
    at = np.arange(len(flat)) + np.repeat(base + OVERLAP - (e.starts[a:b] - e.starts[a]), size)
    y[at] = coding.slot[flat]
    y[base + OVERLAP + size] = INPUTS - 1
    x[1:][at] = coding.row[flat]  # what was the target is the input of the next position; the first has none
    of = np.repeat(np.arange(len(size)), count)
    first = base[of] + (np.arange(len(of)) - (np.cumsum(count) - count)[of]) * _STEP
    return sliding_window_view(x, SPAN)[first], sliding_window_view(y[OVERLAP:], _STEP)[first], of


def steps(starts: np.ndarray, size: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` ids, or one text."""
    cut = np.flatnonzero(np.diff((starts[:-1] - starts[0]) // size)) + 1
    if len(starts) > 1:
        yield from zip([0, *cut], [*cut, len(starts) - 1], strict=True)


def _in_training() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(False))


class _Block:
    """The words of a block of documents, in an order that does not depend on how its rows arrived."""

    def __init__(self, block: pa.Table):
        self.table = in_order(block, "doc_id", "text", "held_out")
        self.words = words(self.table["text"].chunk(0), lower=True)
        self.distinct = Distinct(hashes(self.words.vocab))
        self.held_out = self.table["held_out"].to_numpy()

    def training_counts(self) -> np.ndarray:
        """How often each distinct word occurs in training documents."""
        told = np.repeat(~self.held_out, np.diff(self.words.starts))
        c = np.bincount(self.words.ids[told], minlength=len(self.words.vocab))
        return np.bincount(self.distinct.at, weights=c, minlength=len(self.distinct.values)).astype(np.int64)


class Telling(NamedTuple):
    """The words of a block's documents, as places among the block's distinct hashes, and what goes with each document."""

    doc_id: np.ndarray
    known_id: np.ndarray  # false where doc_id is null
    held_out: np.ndarray
    words: np.ndarray
    n_words: np.ndarray

    @classmethod
    def of(cls, x: _Block) -> Telling:
        doc_id = x.table["doc_id"].chunk(0)
        number = pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        known = doc_id.is_valid().to_numpy(zero_copy_only=False)
        return cls(number, known, x.held_out, x.distinct.at[x.words.ids].astype(np.uint32), np.diff(x.words.starts).astype(np.uint32))

    @classmethod
    def read(cls, fields: Iterable[pa.BinaryScalar]) -> Telling:
        types = (np.int64, np.bool_, np.bool_, np.uint32, np.uint32)
        return cls(*(np.frombuffer(f.as_buffer(), t) for f, t in zip(fields, types, strict=True)))


class Spelling(NamedTuple):
    """The subword ids of a block's documents."""

    held_out: np.ndarray
    ids: np.ndarray
    n_ids: np.ndarray

    @classmethod
    def read(cls, fields: Iterable[pa.BinaryScalar]) -> Spelling:
        return cls(*(np.frombuffer(f.as_buffer(), t) for f, t in zip(fields, (np.bool_, np.uint16, np.uint32), strict=True)))

    def all(self) -> Encoded:
        return Encoded(self.ids, np.append(0, np.cumsum(self.n_ids, dtype=np.int64)))

    def training(self) -> Encoded:
        told = ~self.held_out
        return Encoded(self.ids[np.repeat(told, self.n_ids)], np.append(0, np.cumsum(self.n_ids[told], dtype=np.int64)))


_FIELDS = list(dict.fromkeys(Telling._fields + Spelling._fields))


def read_blocks(dealt: DataFrame, n_blocks: int) -> DataFrame:
    """What blocks of documents hold, written: texts are read, cut and encoded once.

    kind 'words' and 'ids': a block's Telling and Spelling, in a row each. kind 'hashes': for a bucket of hashes (at), a
    block's distinct words that fall there and their counts in training documents. kind 'subwords': a part (at) of the
    array of counts of subword ids in training documents. Rows of one training round lie in files of their own.
    """

    def run(block: pa.Table) -> pa.Table:
        keep_freed_memory()
        x, subwords, number = _Block(block), per_worker(Subwords), block["block"][0].as_py()
        counts, e = x.training_counts().astype(np.int32), encoded(x.words, subwords, x.distinct)
        telling, spelling = Telling.of(x), Spelling(x.held_out, e.ids, np.diff(e.starts).astype(np.uint32))
        rows = [{"kind": "hashes", "at": b, "hashes": x.distinct.values[i:j], "counts": counts[i:j]} for b, i, j in bucketed(x.distinct.values, min(n_blocks, MOST_BUCKETS))]
        rows += [{"kind": "subwords", "at": part, "counts": b} for part, b in parts(np.bincount(spelling.training().ids, minlength=subwords.size))]
        rows += [{"kind": "words", **telling._asdict()}, {"kind": "ids", **spelling._asdict()}]
        binary = lambda v: v.tobytes() if isinstance(v, np.ndarray) else v
        columns = {"block": pa.array([number] * len(rows), pa.int32()), "at": pa.array([r.get("at") for r in rows], pa.int32())}
        for name in ["hashes", "counts", *_FIELDS]:
            columns[name] = pa.array([binary(r.get(name)) for r in rows], pa.binary())
        return pa.table(columns | {"kind": pa.array([r["kind"] for r in rows], pa.string()), "round": pa.array([number % ROUNDS] * len(rows), pa.int32())})

    schema = f"block int, at int, hashes binary, counts binary, {', '.join(f'{f} binary' for f in _FIELDS)}, kind string, round int"
    return written(dealt.groupBy("block").applyInArrow(run, schema), "blocks", partition_by=["kind", "round"], compression="zstd")


def count_words(read: DataFrame) -> DataFrame:
    """(block, bucket, counts): of each distinct word of a block, in order, its count in all training documents; and of
    the bucket, once, how many words occur there (distinct) and how often (total)."""

    def run(bucket: pa.Table) -> pa.Table:
        found = [np.frombuffer(x, np.uint64) for x in bucket["hashes"].to_pylist()]
        d = Distinct(np.concatenate(found))
        counts = np.concatenate([np.frombuffer(x, np.int32) for x in bucket["counts"].to_pylist()])
        total = np.bincount(d.at, weights=counts).astype(np.int64)
        wide = np.int64 if total.max(initial=0) >= 1 << 32 else np.uint32
        answers = np.split(total[d.at], np.cumsum([len(x) for x in found])[:-1])
        once = np.arange(len(found)) == 0
        return pa.table(
            {
                "block": bucket["block"],
                "bucket": bucket["at"],
                "counts": pa.array([x.astype(wide).tobytes() for x in answers], pa.binary()),
                "wide": np.full(len(found), wide is np.int64),
                "distinct": once * int((total > 0).sum()),
                "total": once * int(total.sum()),
            }
        )

    told = read.filter("kind = 'hashes'").select("block", "at", "hashes", "counts")
    return written(told.groupBy("at").applyInArrow(run, "block int, bucket int, counts binary, wide boolean, distinct long, total long"), "word-counts")


def add_up(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Sums of float64 arrays, by part, of rows (part, at, sums) with at below n: a tree of groups of FAN, each added
    up in the order of at, so that the result does not depend on partitions."""

    def add(found: pa.Table) -> pa.Table:
        found = found.sort_by("at")
        total = np.zeros(len(found["sums"][0].as_py()) // 8)
        for b in found["sums"]:
            total += np.frombuffer(b.as_buffer())
        return pa.table({"part": found["part"][:1], "at": found["to"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    while True:
        to = F.floor(F.col("at") / FAN).cast("int").alias("to")
        rows = rows.select("part", "at", "sums", to).groupBy("part", "to").applyInArrow(add, "part int, at int, sums binary")
        n = -(-n // FAN)
        if n <= 1:
            return {r["part"]: np.frombuffer(r["sums"]) for r in rows.select("part", "sums").collect()}


def train_locally(p: Parameters, coding: Coding, e: Encoded, seed: int) -> int:
    """Adam steps over the windows of texts, in a random order; p is changed. Returns the number of targets."""
    x, y, _ = windows(e, 0, len(e.starts) - 1, coding)
    size = min(BATCH, max(16, len(x) // LEAST_STEPS))
    adam, order = Adam(p, RATE * DECAY**seed * (size / BATCH) ** 0.5), np.random.default_rng(seed).permutation(len(x))
    for i in range(0, len(x), size):
        at = order[i : i + size]
        adam.step(gradients(p, x[at], y[at]))
    return int((y >= 0).sum())


def train(read: DataFrame, n_blocks: int, coding: Coding) -> Parameters:
    """Parameters after ROUNDS rounds of local training and averaging, in which each training document takes part once.

    In a round, the training documents of every ROUNDS-th block are used. Each block starts from the same parameters,
    takes Adam steps over all its windows, and gives back what it reached; the mean of this, weighted by targets,
    starts the next round. Blocks hold the same documents however the input was partitioned, and so the result is the
    same. The work grows with the corpus; what reaches the driver does not.
    """
    spark = read.sparkSession
    p = initial(coding)
    shape = {k: v.shape for k, v in p.items()}
    ends = np.cumsum([v.size for v in p.values()])
    texts = read.filter("kind = 'ids'")

    for seed in range(ROUNDS):
        sent: Broadcast = spark.sparkContext.broadcast((p, tuple(coding)))  # about 2 MB

        def run(batches: Iterable[pa.RecordBatch], seed: int = seed, sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            keep_freed_memory()
            coding = Coding(*sent.value[1])
            for batch in batches:
                for block, *fields in zip(*batch.columns, strict=True):
                    e = Spelling.read(fields).training()
                    if len(e.starts) == 1:
                        continue
                    own = {k: v.copy() for k, v in sent.value[0].items()}
                    n = train_locally(own, coding, e, seed)
                    flat = np.append(np.concatenate([own[k].ravel() for k in shape]).astype(np.float64) * n, n)
                    blobs = [flat[i : i + PART].tobytes() for i in range(0, len(flat), PART)]
                    at = pa.array([block.as_py() // ROUNDS] * len(blobs), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(range(len(blobs)), pa.int32()), at, pa.array(blobs, pa.binary())], ["part", "at", "sums"])

        chosen = texts.filter(F.col("round") == seed).select("block", *Spelling._fields)
        found = add_up(chosen.mapInArrow(run, "part int, at int, sums binary"), -(-n_blocks // ROUNDS))
        if found:
            flat = np.concatenate([found[k] for k in sorted(found)])
            flat = (flat[:-1] / flat[-1]).astype(np.float32)
            p = {k: x.reshape(shape[k]) for k, x in zip(shape, np.split(flat, ends[:-1]), strict=True)}
    return p


def score_texts(e: Encoded, p: Parameters, coding: Coding, step: int = BATCH) -> np.ndarray:
    """log10 probability of each whole text's subword ids and end, each given up to SPAN - 1 ids before it."""
    out = sums(coding.log_share[e.ids], e.starts) + coding.log_share[-1]
    for a, b in steps(e.starts):
        x, y, of = windows(e, a, b, coding)
        for i in range(0, len(x), step):
            found = log_probabilities(p, x[i : i + step], y[i : i + step])
            out[a:b] += np.bincount(of[i : i + step], weights=found.sum(axis=1), minlength=b - a)
    return out / np.log(10)


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, attention_score.

    Learns from all rows whose crc32(doc_id) mod 5 is not 1; a null doc_id is held out. Tokens are the words of the
    text, A-Z in lower case, and one end. base_score is their smoothed unigram log10 probability by counts over all
    training rows. attention_score is the attention model's log10 probability of the text, as the subword ids of its
    words and an end. score is that of the mixture of both, MIXED to the attention model, at every size of the corpus:
    where that model has had too little text to learn from, a text loses 0.3 at most against the base. A null text is empty. Repeated rows each count and get equal scores; other columns are ignored; an empty table
    gives an empty result, and one without training rows is scored by the untrained model.

    Documents are dealt into blocks by a hash of doc_id and text. A block sends the 64-bit hashes of its distinct words,
    with their counts, to buckets, which answer with the counts over all blocks: among n distinct words, about
    n * n / 2**65 pairs are taken for equal. Texts are shuffled once and cut once; a block's words and subword ids are
    written as numbers, which train the model, round by round, and are scored.
    """
    spark = docs.sparkSession
    told = docs.select("doc_id", "text", (~_in_training()).alias("held_out"))
    dealt, n_blocks = deal(told, block_bytes, least=ROUNDS)
    read = read_blocks(dealt, n_blocks)
    counted = count_words(read)
    r = counted.agg(F.sum("distinct"), F.sum("total")).first()
    n_ends = told.filter("not held_out").count()
    n_words, n_tokens = (r[0] or 0) + (n_ends > 0), (r[1] or 0) + n_ends
    coding = Coding.of(summed(read.filter("kind = 'subwords'").select(F.col("at").alias("part"), "counts"), Subwords().size), n_ends)
    model: Broadcast = spark.sparkContext.broadcast((train(read, n_blocks, coding), tuple(coding)))  # about 2 MB

    def base(block: pa.Table, found: pa.Table) -> pa.Table:
        t = Telling.read(block[name][0] for name in Telling._fields)
        found = found.sort_by("bucket")
        told = zip(found["counts"].to_pylist(), found["wide"].to_pylist(), strict=True)
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(c, np.int64 if wide else np.uint32) for c, wide in told)])
        each = np.log10((np.append(counts, n_ends) + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
        starts = np.append(0, np.cumsum(t.n_words, dtype=np.int64))
        return pa.table(
            {
                "block": pa.array(np.full(len(t.doc_id), block["block"][0].as_py()), pa.int32()),
                "n": pa.array(np.arange(len(t.doc_id)), pa.int32()),
                "doc_id": pa.array(t.doc_id, mask=~t.known_id),
                "held_out": t.held_out,
                "n_tokens": np.diff(starts) + 1,
                "n_known": per_text((counts > 0)[t.words], starts) + (n_ends > 0),
                "train_tokens": np.full(len(t.doc_id), n_tokens),
                "base_score": sums(each[t.words], starts) + each[-1],
            }
        )

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        p, coding = model.value[0], Coding(*model.value[1])
        for batch in batches:
            for block, *fields in zip(*batch.columns, strict=True):
                found = score_texts(Spelling.read(fields).all(), p, coding)
                columns = [pa.array(np.full(len(found), block.as_py()), pa.int32()), pa.array(np.arange(len(found)), pa.int32()), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "n", "score"])

    schema = "block int, n int, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double"
    told = read.filter("kind = 'words'").select("block", *Telling._fields).groupBy("block")
    based = told.cogroup(counted.select("block", "bucket", "counts", "wide").groupBy("block")).applyInArrow(base, schema)
    modelled = read.filter("kind = 'ids'").select("block", *Spelling._fields).mapInArrow(score, "block int, n int, score double")
    both = based.join(modelled, ["block", "n"]).drop("block", "n").withColumnRenamed("score", "attention_score")
    apart = F.col("attention_score") - F.col("base_score")
    return both.withColumn("score", F.greatest("attention_score", "base_score") + F.log10(F.when(apart > 0, MIXED + (1 - MIXED) * F.pow(F.lit(10.0), -apart)).otherwise(MIXED * F.pow(F.lit(10.0), apart) + 1 - MIXED)))

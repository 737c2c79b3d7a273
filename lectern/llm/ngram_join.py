"""Near-duplicate join on 5-word shingles: adaptive multi-match prefixes, then exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm._blocks import Distinct, answers, counted, deal, in_order
from lectern.llm._components import components
from lectern.llm._filter import bit_filter, may_match
from lectern.llm._store import release, written
from lectern.llm._words import hashes, mixed, rolling, slices, words

#: Prefixes are lengthened by up to so many tokens, less one; what it costs to verify one pair, in posting entries.
MAX_MATCH, VERIFY_COST = 8, 50


class Sets:
    """Distinct shingle hashes of each text of a slice: text i has values[starts[i]:starts[i + 1]], ascending."""

    def __init__(self, texts: pa.Array, width: int):
        w = words(texts, lower=True)
        code, n = hashes(w.vocab)[w.ids], np.diff(w.starts)
        self.n_words = n
        h, at = rolling(code, w.starts, width)
        text = np.repeat(np.arange(len(n)), np.maximum(n - width + 1, 0))
        ends = w.starts[1:]
        self.nodes = np.zeros(len(n), np.int64)
        for i in np.flatnonzero(n):
            self.nodes[i] = np.int64(np.uint64(xxhash.xxh3_64_intdigest(code[w.starts[i] : ends[i]])).view(np.int64))
        short = np.flatnonzero((n > 0) & (n < width))
        h, text = np.append(h, self.nodes[short].view(np.uint64)), np.append(text, short)
        order = np.argsort(h)
        order = order[np.argsort(text[order].astype(np.uint16 if len(n) <= 1 << 16 else np.int64), kind="stable")]
        h, text = h[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        self.values, self.text = h[new], text[new]
        self.starts = np.searchsorted(self.text, np.arange(len(n) + 1))
        self.sizes = np.diff(self.starts)


def _least_overlap(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of n shares at least with any set it links with."""
    return -(-4 * n // 5)


class _Block:
    """The shingle sets of a block; copies of a word sequence count once."""

    def __init__(self, block: pa.Table, width: int):
        rows = in_order(block, "doc_id", "text", "key")
        self.doc_id, self.key, text = rows["doc_id"], rows["key"], rows["text"].chunk(0)
        self.sets = s = Sets(text, width)
        first = np.zeros(len(s.nodes), bool)
        first[np.unique(s.nodes, return_index=True)[1]] = True
        self.chosen = first[s.text]
        self.distinct = Distinct(s.values[self.chosen])


def _level(count: np.ndarray) -> np.ndarray:
    """Class of frequency: 0 for a shingle of one document alone, then 1 + floor(log2)."""
    return np.where(count > 1, 1 + np.log2(np.maximum(count, 1)).astype(np.int64), 0)


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with a hash of doc_id and text, by which a node's text is found again."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def _prefixes(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, key, node, n_shingles) of all documents, and posting entries (token, node, meta) of their prefixes.

    node is a 64-bit hash of the lower-cased word sequence: copies share one, and are joined as one document. The
    global order of tokens is by class of document frequency, counted over the whole corpus, then by hash. A pair that
    links shares at least L of the tokens in prefixes of n - ceil(0.8 n) + L tokens. L is chosen for each document by
    estimated cost: entries that its prefix reads, and pairs to verify if at least L entries must agree. Tokens of one
    document alone take their place in the prefix but are not sent. meta packs position, n and L; before is the token sent before.
    """
    dealt, n_blocks = deal(_keyed(docs).select("doc_id", "text", "key"))

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        x = _Block(block, width)
        s, n, k = x.sets, x.sets.sizes, len(x.doc_id)
        level = np.zeros(len(s.values), np.uint8)
        level[x.chosen] = answers(found)[x.distinct.at]
        order = np.argsort(level, kind="stable")
        order = order[np.argsort(s.text[order].astype(np.uint16 if k <= 1 << 16 else np.int64), kind="stable")]
        token, level, text = s.values[order], level[order], s.text
        others = np.where(level > 0, 1.5 * 2.0 ** (level.astype(np.int64) - 1) - 1, 0)
        cost = np.zeros(len(token) + 1)
        np.cumsum(others, out=cost[1:])
        slack = n - _least_overlap(n)
        best, match = np.full(k, np.inf), np.ones(k, np.int64)
        for m in range(1, MAX_MATCH + 1):
            partners = cost[s.starts[:-1] + np.minimum(slack + m, n)] - cost[s.starts[:-1]]
            price = np.where(m <= _least_overlap(n), slack + m + partners + VERIFY_COST * partners / m, np.inf)
            match[price < best] = m
            best = np.minimum(best, price)
        position = np.arange(len(token)) - s.starts[text] + 1
        sent = x.chosen & (level > 0) & (position <= (slack + match)[text])
        text, position = text[sent], position[sent]
        most = (1 << 28) - 1
        meta = (np.minimum(position, most) << 32) | (np.minimum(n[text], most) << 4) | match[text]
        token = token[sent].view(np.int64)
        before = np.zeros(len(token), np.int64)
        before[1:] = np.where(text[1:] == text[:-1], token[:-1], 0)
        entries = pa.table({"token": token, "node": s.nodes[text], "meta": meta, "before": before})
        members = pa.table({"doc_id": x.doc_id, "key": x.key, "node": s.nodes, "n_shingles": n})
        names = ["doc_id", "key", "node", "n_shingles", "token", "meta", "before"]
        return pa.concat_tables([members, entries], promote_options="default").select(names)

    levels = counted(dealt, n_blocks, lambda block: _Block(block, width).distinct, _level)
    schema = "doc_id long, key long, node long, n_shingles long, token long, meta long, before long"
    return dealt.groupBy("block").cogroup(levels.groupBy("block")).applyInArrow(run, schema)


def _field(meta: str, name: str) -> F.Column:
    shift, bits = {"pos": (32, 28), "n": (4, 28), "match": (0, 4)}[name]
    return F.shiftrightunsigned(meta, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _may_link(a: str, b: str) -> F.Column:
    """Whether sets whose first common token has these positions can link: by their sizes, and by what may follow."""
    na, nb = _field(a, "n"), _field(b, "n")
    rest = F.least(na - _field(a, "pos"), nb - _field(b, "pos"))
    return (5 * F.least(na, nb) >= 4 * F.greatest(na, nb)) & (1 + rest >= F.ceil((na + nb) * 4 / 9))


#: Sizes are compared by cells of their logarithm; so many cells make a factor of 5 / 4.
CELLS = 4


def _sharing(entries: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of nodes in different components that share a token, and by its places can link.

    A node of n shingles, r of them from the token on, can link with one of m only if 4 (n + m) <= 9 r: m is at most
    9 / 4 r - n. Of two nodes that link, each thus reaches the other's size. The larger stands in the cell of its size;
    the smaller, if it reaches that far, in all cells from its own size to its reach. Where a token comes late in all
    nodes that hold it, as one of a passage that many documents share, no node reaches another, and no row is made.
    """
    n = _field("meta", "n")
    width = math.log(1.25) / CELLS
    cell = lambda x: F.floor(F.log(x) / width + 1e-9).cast("int")
    reach = 9 * (n - _field("meta", "pos") + 1) / 4 - n
    entries = entries.select("token", "node", "meta", "before", "component", n.alias("n"), reach.alias("reach"))
    larger = entries.select("token", cell(F.col("n")).alias("cell"), F.struct("node", "meta", "before", "component", "n").alias("x"))
    cells = F.explode(F.sequence(cell(F.col("n")), F.greatest(cell(F.col("n")), cell(F.col("reach")))))
    smaller = entries.filter("reach >= n").select("token", cells.alias("cell"), F.struct("node", "meta", "before", "component", "n").alias("y"))
    # Where the tokens before agree as well, that token has made the pair.
    both = larger.join(smaller, ["token", "cell"]).filter("x.node <> y.node and x.component <> y.component and x.n >= y.n and (x.before <> y.before or x.before = 0)")
    return both.filter(_may_link("x.meta", "y.meta")).select(*_pairs("x.node", "y.node")).distinct()


def _pairs(a: str, b: str) -> list[F.Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _agreeing(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """Pairs of nodes (a, b) whose prefixes agree in as many tokens as the pair asks for, and that can still link.

    The last token that both prefixes hold is the k-th of the two sets' common tokens; after it each set has as many
    tokens left as it has positions, so k and the smaller rest bound the overlap.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    listed = entries.join(ends, "node", "left_semi").select("node", "token", "meta").distinct()
    listed = listed.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("meta", "token"))).alias("t"), F.min("meta").alias("meta"))
    listed = listed.select("node", F.col("t.token").alias("tokens"), F.transform("t", lambda x: F.shiftrightunsigned(x["meta"], 32)).alias("at"), "meta")

    def side(x: str) -> DataFrame:
        return listed.select(*(F.col(c).alias(x if c == "node" else f"{c}_{x}") for c in listed.columns))

    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("common", F.array_intersect("tokens_a", "tokens_b"))
    both = both.filter(F.size("common") >= F.least(_field("meta_a", "match"), _field("meta_b", "match")))
    last = F.element_at("common", -1)
    rest = [_field(f"meta_{x}", "n") - F.element_at(f"at_{x}", F.array_position(f"tokens_{x}", last).cast("int")) for x in ("a", "b")]
    need = F.ceil((_field("meta_a", "n") + _field("meta_b", "n")) * 4 / 9)
    return both.filter(F.size("common") + F.least(*rest) >= need).select("a", "b")


def _node(width: int):
    @F.pandas_udf("long")
    def node(text: pd.Series) -> pd.Series:
        return pd.Series(Sets(pa.array(text, pa.string()), width).nodes)

    return node


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The pairs of nodes (a, b) of which 100 * intersection >= 80 * union, by their whole texts' shingle sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            x, y = Sets(batch.column("text_a"), width), Sets(batch.column("text_b"), width)
            row = np.append(x.text, y.text)
            key = mixed(np.append(x.values, y.values) + mixed(row.astype(np.uint64) + np.uint64(1)))
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            both = np.bincount(row[order[1:][same]], minlength=batch.num_rows)
            good = 100 * both >= 80 * (x.sizes + y.sizes - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good))

    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(nodes.join(ends, "node").select("key", "node"), "wanted")
    texts = may_match(_keyed(docs).select("key", "text"), "key", bit_filter(wanted, "key")).join(wanted, "key")
    # Texts that share a key by chance are told apart by their nodes.
    texts = written(texts.filter(_node(width)("text") == F.col("node")).select("node", "text").dropDuplicates(["node"]), "texts")
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    links = written(joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "links")
    release(wanted, texts)
    return links


def join_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """Classes of documents linked by Jaccard similarity of 0.8 or more; per row: doc_id, n_shingles, component_id.

    A document's set is its distinct shingles of `width` lower-cased (A-Z) words, or its whole word sequence if that is
    shorter. A null, empty or blank text has no shingle and is linked with nothing. component_id is the smallest doc_id
    that links reach; it is null where no row that they reach has one. Rows repeated with the same doc_id are linked like
    copies; other columns are ignored; an empty table gives an empty result.

    Copies of a word sequence are one node. Nodes that share tokens of their prefixes are joined in two rounds. In the
    first, each token pairs its nodes with one pivot, the node in which it stands first: as many pairs as entries at
    most. The second makes the other pairs, of tokens whose nodes are still in different components, and leaves out
    those within one component: they cannot change the result. It joins by token and by what sizes may follow from the
    token's place in each node, so that a frequent token pairs nodes that can link, not all that hold it. Pairs whose prefixes agree in enough tokens are verified
    by their whole texts. Aggregations
    combine in each task before they shuffle, and joins on a hot token or node can be split by AQE.
    """
    rows = written(_prefixes(docs, width), "prefixes")
    members = rows.filter("n_shingles is not null").select("doc_id", "key", "node", "n_shingles")
    nodes = written(members.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("key").alias("key")), "nodes")
    entries = rows.filter("token is not null").select("token", "node", "meta", "before")

    tokens = entries.groupBy("token").agg(F.count("*").alias("entries"), F.min_by("node", "meta").alias("pivot"), F.min("meta").alias("pivot_meta"))
    shared = written(entries.join(tokens.filter("entries > 1"), "token"), "shared")
    near = shared.filter("node <> pivot").filter(_may_link("meta", "pivot_meta")).select(*_pairs("node", "pivot")).distinct()
    near = written(_agreeing(near, shared), "pairs")
    links = _verified(near, docs, nodes, width)
    classes = components(links)

    # Tokens of two nodes are settled by the first round.
    labelled = shared.filter("entries > 2").join(classes, "node", "left")
    labelled = written(labelled.select("token", "node", "meta", "before", F.coalesce("component", "node").alias("component")).distinct(), "labelled")
    open_tokens = labelled.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("token")
    left = labelled.join(open_tokens, "token", "left_semi")

    rest = _sharing(left).join(near, ["a", "b"], "left_anti")
    rest = written(_agreeing(rest, shared), "pairs")
    more = _verified(rest, docs, nodes, width)
    release(near, rest, shared, labelled)
    if not more.isEmpty():
        release(classes)
        classes = components(links.unionByName(more))
    release(links, more)

    labelled = nodes.join(classes, "node", "left").select("node", "first_id", F.coalesce("component", "node").alias("component"))
    least_id = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(least_id, "component").select("node", "component_id")
    out = members.join(named, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS ws
    FROM documents
), e AS (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0
), s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle FROM e
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)
), d AS (
    SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, reached) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, d.b FROM r JOIN d ON d.a = r.reached
)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.reached) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

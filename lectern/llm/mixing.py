"""Mixing sources to target weights by Pfair scheduling of blocks."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm._ranks import ranked
from lectern.llm._store import written

#: Rows in a block, the unit that is scheduled; blocks that one task schedules at most, about a minute's work. Tables of
#: more rows than both make have larger blocks.
BLOCK_ROWS, MAX_BLOCKS = 16, 1 << 24
#: Weight of a source without a given one: its rows to this power. 1 keeps proportions, 0 makes sources equal.
TEMPERATURE = 0.7
#: Rows of a source are ranked in parts of about so many.
PART_ROWS = 1 << 20


def shares(weights: dict[str, float], period: int = 1000) -> dict[str, int]:
    """Whole shares that sum to the period, by largest remainder; each source has one at least."""
    total = sum(weights.values())
    period = max(period, len(weights))
    exact = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: period - sum(out.values())]:
        out[s] += 1
    return out


def period_slots(share: dict[str, int]) -> dict[str, list[int]]:
    """The slots that each source's blocks get in one period of whole shares."""
    slots: dict[str, list[int]] = {s: [] for s in sorted(share)}
    for s, _, _, slot in schedule(share, share):
        slots[s].append(slot)
    return slots


def whole(weights: dict[str, float]) -> dict[str, int]:
    """Integers in exactly the proportions of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * unit) for s, x in exact.items()}


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int, int, int]]:
    """(source, block, phase, slot) of all blocks, by slot: in each phase, the sources with blocks left share by weight.

    With whole weights q that sum to Q, block j of a phase is released at floor(j Q / q) and due at ceil((j + 1) Q / q)
    slots after its start, earliest deadline first. The weights fill all slots, so every block meets its deadline, and
    after any t slots of a phase a source has had more than t q / Q - 1 and less than t q / Q + 1 blocks. A phase ends
    at the first slot whose source has run out; in the next, the weights of what is left are scaled to one.

    Memory grows with sources, work with blocks: a source is touched in a phase only when its first block is placed,
    and first blocks are due in the order of weights.
    """
    q = whole({s: weights[s] for s, n in blocks.items() if n > 0})
    names = sorted(q, key=lambda s: (-q[s], s))
    share, left, done = [q[s] for s in names], [blocks[s] for s in names], [0] * len(names)
    after = [*range(1, len(names) + 1), 0]  # the next source that is left, in the order of weights; the last starts it
    before = [*range(-1, len(names))]
    total, start, phase = sum(share), 0, 0
    while total:
        release: list[tuple[int, int, int]] = []
        due: list[tuple[int, int, int]] = []
        out: list[int] = []
        fresh, t = after[-1], 0
        while True:
            while release and release[0][0] <= t:
                _, i, j = heapq.heappop(release)
                heapq.heappush(due, (-(-(j + 1) * total // share[i]), i, j))
            if fresh < len(names) and (not due or (-(-total // share[fresh]), fresh, 0) <= due[0]):
                i, j, fresh = fresh, 0, after[fresh]
            elif due:
                _, i, j = heapq.heappop(due)
            else:
                break
            if not left[i]:
                break
            yield names[i], done[i], phase, start + t
            done[i] += 1
            left[i] -= 1
            if not left[i]:
                out.append(i)
            heapq.heappush(release, ((j + 1) * total // share[i], i, j + 1))
            t += 1
        for i in out:
            total -= share[i]
            after[before[i]], before[after[i]] = after[i], before[i]
        start, phase = start + t, phase + 1


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int | None = None, temperature: float = TEMPERATURE, period: int | None = None) -> DataFrame:
    """The place of each row of docs (doc_id, source) in a mix: doc_id, source, block, phase, slot, position.

    weights: of sources; one that is not given, or all if none are, has rows ** temperature. A source with weight 0
    or less is refused. Rows of a source are put in blocks in the order of a hash of doc_id; the last may be short.
    Slots are filled by Pfair's earliest deadline first with the exact weights, so that at any slot of phase 0 each
    source has had its share of blocks, but for less than one, however long the phase is. Phase 0 ends when a source
    has run out; the rest follows in later phases, so that no row is lost. position orders the rows: slot times
    block_rows, plus the row's place in its block. A period, if given, rounds the weights to shares of so many slots.

    block_rows is BLOCK_ROWS, or what keeps the schedule within MAX_BLOCKS, unless given.

    A null source is a source. Repeated rows are rows like others, in any order among themselves. Other columns are
    ignored; an empty table gives an empty result. One task goes through the blocks, with memory for the sources.
    """
    source = F.col("source").cast("string")
    rows = docs.select("doc_id", F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("_source"))
    sizes = written(rows.groupBy("_source").agg(F.count("*").alias("n")), "sources")
    given = {f"={s}": w for s, w in (weights or {}).items()}
    if bad := [s for s, w in given.items() if not w > 0]:
        if found := [r["_source"][1:] for r in sizes.filter(F.col("_source").isin(bad)).collect()]:
            raise ValueError(f"weights must be above 0: {sorted(found)}")

    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    if block_rows is None:
        block_rows = max(BLOCK_ROWS, -(-(total or 0) // MAX_BLOCKS))

    def plan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {s: k for batch in batches for s, k in zip(batch.column("_source").to_pylist(), batch.column("n").to_pylist(), strict=True)}
        weight = {s: given.get(s, k**temperature) for s, k in n.items()}
        placed = schedule({s: -(-k // block_rows) for s, k in n.items()}, shares(weight, period) if period and n else weight)
        while some := list(islice(placed, 1 << 14)):
            cols = zip(*some, strict=True)
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["_source", "block", "phase", "slot"])

    places = sizes.coalesce(1).mapInArrow(plan, "_source string, block long, phase int, slot long")
    key = F.xxhash64("doc_id", F.lit("mix"))
    parts = max(16, -(-(most or 0) // PART_ROWS))
    numbered = ranked(rows.withColumn("_key", key), "_source", F.col("_key"), ["_key", "doc_id"], parts)
    numbered = numbered.select("doc_id", "_source", F.floor(F.col("rank") / block_rows).alias("block"), (F.col("rank") % block_rows).alias("_at"))
    return numbered.join(places.hint("merge"), ["_source", "block"]).select(
        "doc_id",
        F.when(F.col("_source") != "", F.expr("substring(_source, 2)")).alias("source"),
        "block",
        "phase",
        "slot",
        (F.col("slot") * block_rows + F.col("_at")).alias("position"),
    )

"""Batch preparation: best rows of duplicates, numbering, carrying forward, grouping, chunks, incremental loads."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from lectern.functions.parsing import split_footnotes, strip_footnote_marks, strip_trailing_headings
from lectern.functions.text import fold_letters, strip_diacritics, to_western_digits
from lectern.operators.catalog import first_per_group
from lectern.operators.ranks import before_part, joined_by_part, numbered, ranged
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_best(df: DataFrame, key: list[str], text: str, position: Column, middle: Column, tie: str) -> DataFrame:
    """Of rows with one key the longest text, then the one nearest the middle of its chunk, then the smallest tie."""
    return first_per_group(df, key, [F.length(text).desc(), F.abs(position - middle), tie])


def first_wins(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    return first_per_group(df, key, [F.col(ordinal).asc()])


def latest_wins(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    return first_per_group(df, key, [F.col(ordinal).desc()])


def longest_wins(df: DataFrame, key: list[str], text: str, ordinal: str) -> DataFrame:
    return first_per_group(df, key, [F.length(text).desc(), F.col(ordinal).asc()])


def letter_suffix(n: Column) -> Column:
    """Bijective base 26: 0 is empty, 1 a, 26 z, 27 aa, 703 aaa, and so on for any number."""
    start = F.struct(n.cast("long").alias("left"), F.lit("").alias("letters"))

    def letter(state: Column, _: Column) -> Column:
        left = state["left"] - 1
        added = F.concat(F.chr(F.lit(97) + left % 26), state["letters"])
        more = F.struct(F.call_function("div", left, F.lit(26)).alias("left"), added.alias("letters"))
        return F.when(left < 0, state).otherwise(more)

    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, letter, lambda state: state["letters"])


def unique_numbers(df: DataFrame, per: list[str], number: str, ordinal: str, name: str = "unique_number") -> DataFrame:
    """Repeats of a number get letters: 8, 8a, 8b. Rows of one number are counted in parts, however many there are."""
    counted = numbered(df, [*per, number], [ordinal], "_repeat")
    return counted.withColumn(name, F.concat(F.col(number).cast("string"), letter_suffix(F.col("_repeat") - 1))).drop("_repeat")


def carry_forward(df: DataFrame, per: list[str], order: str, outer: Column, inner: Column) -> DataFrame:
    """df with the last heading of each level at or before a row; a new outer heading clears the inner one.

    A group is scanned in parts: each is summed up by the headings that it leaves behind, which are carried over the
    parts after it; then rows take what their own part has, or what was carried into it.
    """
    rows = ranged(df.withColumn("_outer", outer).withColumn("_inner", F.when(outer.isNull(), inner)), per, [order])
    part = Window.partitionBy(*per, "_part").orderBy(order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_section", F.count("_outer").over(part)).withColumn("_own_outer", F.last("_outer", ignorenulls=True).over(part))
    section = Window.partitionBy(*per, "_part", "_section").orderBy(order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own_inner", F.last("_inner", ignorenulls=True).over(section))
    place = F.struct(order, "_tie")
    left = rows.groupBy(*per, "_part").agg(F.max_by("_own_outer", place).alias("_left_outer"), F.max_by("_own_inner", place).alias("_left_inner"))
    left = left.withColumn("_run", F.count("_left_outer").over(Window.partitionBy(*per).orderBy("_part")))
    into = before_part(left, per, _in_outer=lambda w: F.last("_left_outer", ignorenulls=True).over(w))
    # The inner heading that comes in is the last one since the part with the last outer heading.
    inner_of = left.groupBy(*per, "_run", "_part").agg(F.first("_left_inner").alias("_left_inner"))
    upto = Window.partitionBy(*per, "_run").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    inner_of = inner_of.withColumn("_run_inner", F.last("_left_inner", ignorenulls=True).over(upto))
    last_inner = before_part(inner_of, per, _in_inner=lambda w: F.last("_run_inner").over(w))
    rows = joined_by_part(joined_by_part(rows, into, per, ["_in_outer"]), last_inner, per, ["_in_inner"])
    out = rows.withColumn("outer_heading", F.coalesce("_own_outer", "_in_outer"))
    out = out.withColumn("inner_heading", F.when(F.col("_section") > 0, F.col("_own_inner")).otherwise(F.coalesce("_own_inner", "_in_inner")))
    return out.select(*df.columns, "outer_heading", "inner_heading")


def group_short(df: DataFrame, per: list[str], order: str, words: Column, most: int = 5) -> DataFrame:
    """df with group_id: a row of at most so many words joins the rows after it, up to the first longer one. Groups are
    scanned in parts: a row's number is what its part closes before it, and what earlier parts close."""
    rows = ranged(df.withColumn("_long", (words > most).cast("int")), per, [order])
    # The last row of a group closes as well.
    last = rows.groupBy(*per).agg(F.max(order).alias("_last")).select(*(F.col(c).alias(f"_g_{c}") for c in per), "_last")
    rows = rows.join(last, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in per], "left").withColumn("_closes", F.when(F.col(order) == F.col("_last"), 1).otherwise(F.col("_long")))
    into = before_part(rows.groupBy(*per, "_part").agg(F.sum("_closes").alias("_closed")), per, _before=lambda w: F.sum("_closed").over(w))
    part = Window.partitionBy(*per, "_part").orderBy(order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    out = joined_by_part(rows.withColumn("_own", F.sum("_closes").over(part)), into, per, ["_before"])
    return out.select(*df.columns, (F.coalesce("_own", F.lit(0)) + F.coalesce("_before", F.lit(0))).alias("group_id"))


def entries_from_lines(lines: DataFrame, per: list[str], order: str, line: str, heads: Column, least: int = 3) -> DataFrame:
    """(per, entry, headword, text, last): a line with a headword opens an entry, which later lines continue.

    heads: the headword of a line, or null; groups are scanned in parts. Lines before the first headword, and entries under `least` characters, go.
    """
    rows = ranged(lines.withColumn("_head", heads), per, [order])
    into = before_part(rows.groupBy(*per, "_part").agg(F.count("_head").alias("_heads")), per, _before=lambda w: F.sum("_heads").over(w))
    part = Window.partitionBy(*per, "_part").orderBy(order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    counted = joined_by_part(rows.withColumn("_own", F.count("_head").over(part)), into, per, ["_before"])
    numbered = counted.withColumn("entry", F.col("_own") + F.coalesce("_before", F.lit(0))).filter("entry > 0")
    rows = F.array_sort(F.collect_list(F.struct(order, line)))
    out = numbered.groupBy(*per, "entry").agg(F.max("_head").alias("headword"), F.array_join(F.transform(rows, lambda r: r[line]), "\n").alias("text"), F.max(order).alias("last"))
    return out.filter(F.length("text") >= least)


def segments_between(text: Column, pattern: str) -> Column:
    """Array of (number, body): each match's first group, and the text up to the next match."""
    parts = F.slice(F.split(F.regexp_replace(text, pattern, "\u0001$1\u0002"), "\u0001"), 2, 1 << 30)
    return F.transform(parts, lambda p: F.struct(F.split_part(p, F.lit("\u0002"), F.lit(1)).alias("number"), F.trim(F.split_part(p, F.lit("\u0002"), F.lit(2))).alias("body")))


def page_at(positions: DataFrame, breaks: DataFrame, per: list[str]) -> DataFrame:
    """positions (per, pos) with the page of the last break (per, start, page) at or before them: an as-of join by
    ordering both sides together, in one shuffle."""
    both = breaks.select(*per, F.col("start").alias("pos"), "page", F.lit(0).alias("_kind")).unionByName(positions.select(*per, "pos", F.lit(None).cast(dict(breaks.dtypes)["page"]).alias("page"), F.lit(1).alias("_kind")))
    w = Window.partitionBy(*per).orderBy("pos", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("page", F.last("page", ignorenulls=True).over(w)).filter("_kind = 1").drop("_kind")


def _chunk_starts(sums: np.ndarray, budget: int) -> np.ndarray:
    """Of each row, where the next chunk starts if one starts there; sums: of the sizes before each row, and of all."""
    return np.maximum(np.arange(1, len(sums)), np.searchsorted(sums, sums[:-1] + budget, side="right") - 1)


def _part_summary(sizes: np.ndarray, budget: int) -> tuple[list[int], list[int], list[int], list[int], int]:
    """What a part does to the chunk that comes into it: (row, size before it, chunks from there on, size of the last) of
    each row at which that chunk may have to close, by what it has used so far; and the size of all rows.

    There are at most as many such rows as the budget has units, and the first row.
    """
    sums = np.append(0, np.cumsum(sizes))
    m = len(sizes)
    after, count, last = _chunk_starts(sums, budget), np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for i in range(m - 1, -1, -1):
        j = after[i]
        count[i], last[i] = (1 + count[j], last[j]) if j < m else (1, sums[m] - sums[i])
    rows = np.flatnonzero((sums <= budget) & (np.append(sums[1:], sums[-1] + 1) > sums))
    rows = np.union1d([0], rows)
    return rows.tolist(), sums[rows].tolist(), count[rows].tolist(), last[rows].tolist(), int(sums[m])


def _composed(parts: list[tuple], budget: int) -> list[tuple[int, int]]:
    """(chunk, size so far) that come into each part of a group, from those of the parts before it; the first starts."""
    into, chunk, used = [], 0, None
    for _, before, count, last, total in parts:
        into.append((chunk, used))
        if used is None:
            chunk, used = count[0] - 1, last[0]
            continue
        at = max(0, int(np.searchsorted(before, budget - used, side="right")) - 1)
        if count[at]:
            chunk, used = chunk + count[at], last[at]
        else:
            used += total
    return into


def _cut_groups(rows: DataFrame, per: list[str], tokens: str, budget: int) -> DataFrame:
    """(per, _part, _chunk, _used): what comes into the parts of those groups that lie in several.

    Parts are ranges of the whole order, so that these are two for each part at most, besides those that one group fills.
    """
    sizes = rows.groupBy(*per, "_part").agg(F.count("*").alias("_n"))
    several = sizes.withColumn("_parts", F.count("*").over(Window.partitionBy(*per))).filter("_parts > 1")
    asked = joined_by_part(rows.select(*per, "_part", "_tie", "_order", F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("_size")), several, per, ["_parts"]).filter("_parts is not null").drop("_parts")
    types = ", ".join(f"`{n}` {t}" for n, t in asked.dtypes if n in per)
    keys = [*per, "_part"]

    def summary(part: pa.Table) -> pa.Table:
        sizes = part.sort_by([("_order", "ascending"), ("_tie", "ascending")])["_size"].to_numpy()
        found = _part_summary(sizes, budget)
        return pa.table({**{c: part[c][:1] for c in keys}, **{c: pa.array([x], pa.list_(pa.int64())) for c, x in zip(("_rows", "_before", "_count", "_last"), found, strict=False)}, "_total": [found[-1]]})

    def compose(group: pa.Table) -> pa.Table:
        group = group.sort_by("_part")
        parts = list(zip(*(group[c].to_pylist() for c in ("_rows", "_before", "_count", "_last", "_total")), strict=True))
        into = _composed(parts, budget)
        return pa.table({**{c: group[c] for c in keys}, "_chunk": pa.array([c for c, _ in into], pa.int64()), "_used": pa.array([u for _, u in into], pa.int64())})

    lists = ", ".join(f"{c} array<long>" for c in ("_rows", "_before", "_count", "_last"))
    summaries = asked.groupBy(*keys).applyInArrow(summary, f"{types}, _part int, {lists}, _total long")
    return summaries.groupBy(*per).applyInArrow(compose, f"{types}, _part int, _chunk long, _used long")


def budget_chunks(df: DataFrame, per: list[str], order: str, tokens: str, budget: int) -> DataFrame:
    """df with chunk, from 0: a chunk closes before the row that would take it over the budget.

    What a row does depends on all before it, which no window expresses. Groups are scanned in parts. Of a group that
    lies in several, each part is summed up by what it does to any chunk that may come into it, and these are composed;
    then rows pass through tasks in order, each part from what comes into it.
    """
    rows = ranged(df.withColumn("_order", F.col(order)), per, [order])
    rows = joined_by_part(rows, _cut_groups(rows, per, tokens, budget), per, ["_chunk", "_used"])
    names, keys = [c.name for c in df.schema], [*per, "_part"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk, used = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sizes = pc.fill_null(batch.column(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.append(0, np.cumsum(sizes))
            new = np.zeros(n, bool)
            for c in keys:
                x = batch.column(c)
                same = pc.fill_null(pc.equal(x[1:], x[:-1]), False).to_numpy(zero_copy_only=False) | (x.is_null()[1:].to_numpy(zero_copy_only=False) & x.is_null()[:-1].to_numpy(zero_copy_only=False))
                new[1:] |= ~same
            new[0] = tuple(batch.column(c)[0].as_py() for c in keys) != key
            out, ends = np.empty(n, np.int64), [*np.flatnonzero(new[1:]) + 1, n]
            i = 0
            for end in ends:
                opened = True
                if new[i]:
                    chunk, used = batch.column("_chunk")[i].as_py() or 0, batch.column("_used")[i].as_py()
                    opened, used = used is not None, used or 0
                while i < end:
                    # Rows up to j fit into the open chunk; a chunk takes one row at least.
                    j = int(np.searchsorted(sums[: end + 1], sums[i] + budget - used, side="right")) - 1
                    if j <= i and opened:
                        chunk, used, opened = chunk + 1, 0, False
                        continue
                    j = max(j, i + 1)
                    out[i:j] = chunk
                    used, opened, i = used + int(sums[j] - sums[i]), True, j
            key = tuple(batch.column(c)[n - 1].as_py() for c in keys)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out)], [*names, "chunk"])

    grouped = rows.repartition(*keys).sortWithinPartitions(*keys, "_order", "_tie")
    return grouped.mapInArrow(run, df.withColumn("chunk", F.lit(0).cast("long")).schema)


def overlapping_chunks(df: DataFrame, per: list[str], order: str, size: int, overlap: int) -> DataFrame:
    """df with a row for each chunk, from 1, that holds it: chunks of `size` rows start every size - overlap rows.

    Groups are numbered in parts.
    """
    step, row = size - overlap, F.col("_number") - 1
    first = F.greatest(F.floor((row - size) / step) + 1, F.lit(0))
    return numbered(df, per, [order], "_number").withColumn("chunk", F.explode(F.sequence(first + 1, F.floor(row / step) + 1))).drop("_number")


def renumber(first: DataFrame, second: DataFrame, per: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Two sources of words as one, numbered from 1 in each line."""
    both = first.unionByName(second)
    return both.withColumn(name, F.row_number().over(Window.partitionBy(*per).orderBy(*order)))


def relative_timing(segments: Column, start: Column) -> Column:
    """Segments (word from 1, start, end) of an array as (word from 0, start, end), counted from their verse's start."""
    return F.transform(segments, lambda s: F.struct((s["word"] - 1).alias("word"), (s["start"] - start).alias("start"), (s["end"] - start).alias("end")))


def insert_new(new: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new whose key does not exist yet, the first of each key by its other columns."""
    others = [c for c in new.columns if c not in key]
    return first_per_group(new.join(existing.select(*key), key, "left_anti"), key, [F.col(c).asc_nulls_last() for c in others] or key)


def upsert(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """existing with new's rows in place of those of the same key, and the rest of new's."""
    return existing.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def changed_only(existing: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Rows of new that exist with another value in any column; nulls compare as values."""
    old = existing.select(*key, *(F.col(c).alias(f"_old_{c}") for c in columns))
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in columns))
    return new.join(old, key).filter(differs).drop(*(f"_old_{c}" for c in columns))


def updated(df: DataFrame, patch: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """df with the patch's values where it has any."""
    p = patch.select(*key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    out = df.join(p, key, "left")
    return out.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}).drop(*(f"_new_{c}" for c in columns))


def validated(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with errors: the names of the rules that a row breaks (a rule says what is wrong)."""
    return df.withColumn("errors", F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules.items()))))


def reject_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(reason, n): rows by the first rule that they break; 'ok' for those that break none."""
    reason = reduce(lambda acc, kv: acc.when(F.coalesce(kv[1], F.lit(False)), kv[0]), rules.items(), F.when(F.lit(False), ""))
    return df.groupBy(reason.otherwise("ok").alias("reason")).agg(F.count("*").alias("n"))


def segment_numbered(pages: DataFrame, per: list[str], page: str, text: str, number: str, heading: str, start: str | None = None) -> DataFrame:
    """Narrations of numbered pages: (per, entry, number, text, page_start, page_end, outer_heading, inner_heading).

    number: a pattern for the start of a line, whose first group is the number. A numbered line is a heading, not a
    narration, if what follows matches `heading` (diacritics aside), or, with `start` given, does not match that
    (alef forms folded). Headings before a narration are carried to it; lines run on over pages, in order.
    """
    lines = pages.select(*per, page, F.posexplode(F.split(_above_footnotes(text), "\n")).alias("_i", "_line"))
    after = F.regexp_replace("_line", f"^\\s*{number}", "")
    numbered, plain = F.col("_line").rlike(f"^\\s*{number}"), strip_diacritics(after)
    opens = numbered & ~plain.rlike(heading)
    if start:
        opens = opens & fold_letters(plain).rlike(start)
    is_heading = ~opens & strip_diacritics(F.when(numbered, after).otherwise(F.col("_line"))).rlike(heading)
    outer = F.when(is_heading & strip_diacritics(after).rlike("^\\[?كتاب"), F.trim(after))
    inner = F.when(is_heading & outer.isNull(), F.trim(after))
    w = Window.partitionBy(*per).orderBy(page, "_i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("_opens", opens).withColumn("_outer", outer).withColumn("_inner", inner)
    marked = marked.withColumn("entry", F.count_if("_opens").over(upto)).withColumn("_o", F.last("_outer", ignorenulls=True).over(upto)).withColumn("_section", F.count("_outer").over(upto))
    marked = marked.withColumn("_n", F.last("_inner", ignorenulls=True).over(Window.partitionBy(*per, "_section").orderBy(page, "_i").rowsBetween(Window.unboundedPreceding, 0)))
    body = F.when(F.col("_opens"), F.regexp_replace("_line", f"^\\s*{number}", "")).otherwise(F.col("_line"))
    number_text = F.max(F.when(F.col("_opens"), F.regexp_extract("_line", f"^\\s*{number}", 1)))
    parts = F.array_sort(F.collect_list(F.struct(page, "_i", body.alias("t"))))
    out = marked.filter("entry > 0").groupBy(*per, "entry").agg(
        to_western_digits(number_text).alias("number"),
        F.trim(strip_trailing_headings(F.array_join(F.transform(parts, lambda x: x["t"]), "\n"))).alias("text"),
        F.min(page).alias("page_start"),
        F.max(page).alias("page_end"),
        F.max(F.when(F.col("_opens"), F.col("_o"))).alias("outer_heading"),
        F.max(F.when(F.col("_opens"), F.col("_n"))).alias("inner_heading"),
    )
    return out


def _above_footnotes(text: str) -> Column:
    """Text of a page above its footnotes, with footnote marks gone from each line."""
    return F.array_join(F.transform(F.split(split_footnotes(text)["main"], "\n"), strip_footnote_marks), "\n")

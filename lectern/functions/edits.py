"""Edit distance with transpositions, and the variants of a word by which near words are found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of a word, from its beginning, that variants are made of: however long a word is, it has few.
PREFIX = 7


def characters(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def alignment(a: Column, b: Column) -> Column:
    """Fewest edits that turn a into b, where an edit inserts, deletes or replaces a character or swaps two neighbours,
    and none touches what another has changed (optimal string alignment)."""
    x, y, m = characters(a), characters(b), F.length(b)
    first = F.sequence(F.lit(0), m)

    def row(state: Column, i: Column) -> Column:
        last, before = state["last"], state["before"]

        def cell(done: Column, j: Column) -> Column:
            own, other = F.get(x, i - 1), F.get(y, j - 1)
            swapped = (i > 1) & (j > 1) & (own == F.get(y, j - 2)) & (other == F.get(x, i - 2))
            least = F.least(F.get(done, j - 1) + 1, F.get(last, j) + 1, F.get(last, j - 1) + (own != other).cast("int"), F.when(swapped, F.get(before, j - 2) + 1))
            return F.concat(done, F.array(least))

        return F.struct(F.aggregate(F.sequence(F.lit(1), m), F.array(i), cell).alias("last"), last.alias("before"))

    start = F.struct(first.alias("last"), first.alias("before"))
    whole = F.aggregate(F.sequence(F.lit(1), F.length(a)), start, row, lambda s: F.element_at(s["last"], -1))
    return F.when(F.length(a) == 0, m).when(m == 0, F.length(a)).otherwise(whole)


def without_one(s: Column) -> Column:
    """A string's variants with one character deleted."""
    places = F.sequence(F.lit(1), F.length(s))
    return F.when(F.length(s) > 0, F.transform(places, lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))).otherwise(F.array().cast("array<string>"))


def variants(s: Column, deletes: int) -> Column:
    """Distinct strings that remain of s with at most so many characters deleted, itself included."""
    out, last = F.array(s), F.array(s)
    for _ in range(deletes):
        last = F.array_distinct(F.flatten(F.transform(last, without_one)))
        out = F.array_union(out, last)
    return out


def word_variants(word: Column, deletes: int) -> Column:
    """Variants of a word's first letters. Two words within `deletes` edits, swaps included, share one, as each edit
    takes one letter at most from either beginning. Of those with under two letters the word itself alone stays: no
    word that may differ has one."""
    return F.filter(variants(F.substring(word, 1, PREFIX), deletes), lambda v: (F.length(v) > 1) | (v == word))

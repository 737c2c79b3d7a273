"""Fragments of texts in which search terms are marked, found by the tokens that the index is made of."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pandas as pd
import regex
from lectern.functions.text import ALEF, ALEF_FORMS, ALEF_MAKSURA, HAMZA, HEH, TEH_MARBUTA, YEH, col
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TOKEN = regex.compile(r"[A-Za-z0-9_\p{L}\p{M}\p{N}]+")
_FOLD = {ord(c): ALEF for c in ALEF_FORMS} | {ord(ALEF_MAKSURA): YEH, ord(TEH_MARBUTA): HEH, ord(HAMZA): None} | dict.fromkeys([*range(0x64B, 0x660), 0x670])


def hits(text: str, terms: set[str]) -> list[tuple[int, int, str]]:
    """(start, end, term) of the tokens of a text that the index would have as one of the terms."""
    found = []
    for m in _TOKEN.finditer(text):
        term = m.group().translate(_FOLD).lower()
        if term in terms:
            found.append((m.start(), m.end(), term))
    return found


def fragment(text: str, terms: set[str], size: int, mark: tuple[str, str] = ("<mark>", "</mark>")) -> str | None:
    """The `size` characters with most different terms, then most hits, then first, with hits marked; None without any.

    Fragments begin a quarter of their size before a hit. A hit counts, and is marked, if it lies wholly inside.
    """
    found = hits(text, terms)
    starts, best, last, inside = [h[0] for h in found], None, 0, Counter()
    first = 0
    for start, _, _ in found:
        low = max(0, start - size // 4)
        while last < len(found) and found[last][1] <= low + size:
            inside[found[last][2]] += 1
            last += 1
        while first < len(found) and found[first][0] < low:
            if first < last:
                inside[found[first][2]] -= 1
            first += 1
        last = max(last, first)
        score = (sum(n > 0 for n in inside.values()), sum(inside.values()))
        if best is None or score > best[0]:
            best = (score, low)
    if best is None:
        return None
    low, high, out, at = best[1], best[1] + size, [], best[1]
    for start, end, _ in found[bisect_left(starts, low) :]:
        if end > high:
            break
        out += [text[at:start], mark[0], text[start:end], mark[1]]
        at = end
    return "".join([*out, text[at:high]])


@F.pandas_udf(StringType())
def _fragments(texts: pd.Series, terms: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([None if t is None or w is None else fragment(t, set(w), int(n)) for t, w, n in zip(texts, terms, sizes, strict=True)], dtype=object)


def highlight(text: Column | str, terms: list[str] | Column, size: int = 200) -> Column:
    """The best fragment of a text for analysed terms, a list or a column of arrays; null if no token is one of them."""
    words = terms if isinstance(terms, Column) else F.array(*(F.lit(t) for t in terms)).cast("array<string>")
    return _fragments(col(text), words, F.lit(size))

"""Search queries: parsed on the driver where a query is a literal, as columns where queries are a table."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from lectern.functions import text
from pyspark.sql import Column
from pyspark.sql import functions as F

# Quotation marks, script ranges and thresholds of the query rules.
_QUOTES = "\"\u00AB\u00BB\u201E\u201C\u201D"
_QUOTED = re.compile(f"[{_QUOTES}]([^\n\r\u2028\u2029]*?)[{_QUOTES}]")
_ARABIC = re.compile("[\u0600-\u06FF\u0750-\u077F]")
_NOT_WORD = re.compile("[^\u0600-\u06FFA-Za-z0-9_]")
_DIACRITICS = re.compile("[\u064B-\u065F\u0670]")
MIN_CHARS_FOR_SEMANTIC = 4
SIMILARITY_FLOORS = [(3, 0.55), (6, 0.40), (12, 0.30)]


def normalize(query: str) -> str:
    """The driver's counterpart of functions.text.normalize_search."""
    folded = _DIACRITICS.sub("", query).translate(str.maketrans("آأإٱىة", "اااايه", "ء"))
    return " ".join(folded.split())


def _terms(query: str) -> list[str]:
    return [t for w in normalize(query).split() if (t := _NOT_WORD.sub("", w))]


@dataclass(frozen=True)
class ParsedQuery:
    phrases: list[str] = field(default_factory=list)
    terms: list[str] = field(default_factory=list)


def parse_query(query: str) -> ParsedQuery:
    """Quoted text of two words or more is a phrase; all else, one quoted word included, are terms."""
    phrases, terms, end = [], [], 0
    for m in _QUOTED.finditer(query):
        terms += _terms(query[end : m.start()])
        quoted = _terms(m[1])
        if len(quoted) > 1:
            phrases.append(" ".join(quoted))
        else:
            terms += quoted
        end = m.end()
    return ParsedQuery(phrases, terms + _terms(query[end:]))


def is_arabic(query: str) -> bool:
    return bool(_ARABIC.search(query))


def strategy(query: str) -> str:
    return "hybrid" if is_arabic(query) else "semantic_only"


def keyword_enabled(query: str, gate: str = "arabic") -> bool:
    """Whether keyword search runs: gate 'arabic' asks for Arabic letters, 'none' for nothing."""
    return gate == "none" or is_arabic(query)


def has_quotes(query: str) -> bool:
    return bool(_QUOTED.search(query))


def skips_semantic(query: str) -> bool:
    """Quoted queries want exact matches; very short ones mean too little."""
    return has_quotes(query) or len(normalize(query).replace(" ", "")) < MIN_CHARS_FOR_SEMANTIC


def similarity_floor(query: str, base: float) -> float:
    """The least similarity of a hit: higher for short queries, never below base."""
    words = normalize(query).split()
    chars = sum(map(len, words))
    if len(words) == 1:
        chars = min(chars, 6)
    return next((max(base, floor) for most, floor in SIMILARITY_FLOORS if chars <= most), base)


def parse_range_list(listed: str | None, least: int = 1, most: int | None = None) -> list[int]:
    """Whole numbers of a comma-separated list that lie in a range; others are left out."""
    found = [int(p) for p in (listed or "").split(",") if re.fullmatch(r"\s*\d+\s*", p)]
    return [n for n in found if n >= least and (most is None or n <= most)]


def edition_or_language(value: str) -> dict[str, str]:
    """A value with a hyphen names an edition, any other a language."""
    return {"edition": value} if "-" in value else {"language": value}


# --- the same rules for queries that are rows of a table ----------------------------------------------------------


def query_parts(c: Column | str) -> Column:
    """Struct (phrases, terms) of a query, as parse_query gives them; terms in the order of the query."""
    marked = F.regexp_replace(text.col(c), f"[{_QUOTES}]([^\n\r\u2028\u2029]*?)[{_QUOTES}]", "\u0001\u0002$1\u0001")
    words = lambda t: F.filter(F.transform(F.split(text.normalize_search(t), " "), lambda w: F.regexp_replace(w, _NOT_WORD.pattern, "")), lambda w: w != "")
    parts = F.transform(F.split(marked, "\u0001"), lambda p: F.struct(p.startswith("\u0002").alias("quoted"), words(F.replace(p, F.lit("\u0002"))).alias("words")))
    phrase = lambda p: p["quoted"] & (F.size(p["words"]) > 1)
    phrases = F.transform(F.filter(parts, phrase), lambda p: F.array_join(p["words"], " "))
    return F.struct(phrases.alias("phrases"), F.flatten(F.transform(F.filter(parts, lambda p: ~phrase(p)), lambda p: p["words"])).alias("terms"))


def query_rules(c: Column | str, base: float) -> Column:
    """Struct of a query's rules: is_arabic, strategy, has_quotes, skips_semantic, similarity_floor."""
    q, plain = text.col(c), text.normalize_search(c)
    arabic, quoted = q.rlike(_ARABIC.pattern), q.rlike(f"[{_QUOTES}][^\n\r\u2028\u2029]*?[{_QUOTES}]")
    chars = F.length(F.replace(plain, F.lit(" ")))
    counted = F.when(~plain.contains(" ") & (plain != ""), F.least(chars, F.lit(6))).otherwise(chars)
    floor = reduce(lambda acc, x: acc.when(counted <= x[0], F.lit(max(base, x[1]))), SIMILARITY_FLOORS, F.when(F.lit(False), 0.0)).otherwise(base)
    return F.struct(
        arabic.alias("is_arabic"),
        F.when(arabic, "hybrid").otherwise("semantic_only").alias("strategy"),
        quoted.alias("has_quotes"),
        (quoted | (chars < MIN_CHARS_FOR_SEMANTIC)).alias("skips_semantic"),
        floor.alias("similarity_floor"),
    )


@dataclass(frozen=True)
class SearchParams:
    """Validated parameters of a search."""

    query: str
    mode: str = "hybrid"
    limit: int = 20
    book_limit: int = 10
    similarity_cutoff: float = 0.6
    fuzzy: bool = True
    refine: bool = False
    book_id: str | None = None
    apply_graph_boost: bool = False
    semantic_books: bool = False
    keyword_gate: str = "arabic"

    def __post_init__(self):
        if self.mode not in ("hybrid", "semantic", "keyword"):
            raise ValueError(f"mode: {self.mode!r}")
        if not 1 <= self.limit <= 100 or not 5 <= self.book_limit <= 50:
            raise ValueError("limit is 1 to 100, book_limit 5 to 50")
        if not self.query or len(self.query) > 500:
            raise ValueError("query has 1 to 500 characters")
        if not 0 <= self.similarity_cutoff <= 1:
            raise ValueError("similarity_cutoff is 0 to 1")

    @property
    def refines(self) -> bool:
        return self.refine and self.mode == "hybrid" and not self.book_id

"""Arabic morphology as Column expressions: affixes, light stems, roots by pattern, derived forms."""

from __future__ import annotations

from collections.abc import Callable

from lectern.functions.text import ALEF, SPACE, col, normalize_lexical
from pyspark.sql import Column
from pyspark.sql import functions as F

# Affixes, longest first where only one is stripped.
ARTICLES = ["بال", "فال", "وال", "كال", "لل", "ال"]
PREFIXES = ["وال", "فال", "بال", "كال", "لل", "ال", "و", "ف", "ب", "ك", "ل"]
SUFFIXES = ["ات", "ون", "ين", "ها", "هم", "كم", "نا", "ه", "ك", "ي"]
IMPERFECT_PREFIXES = ["ي", "ت", "ا", "ن"]
IMPERFECT_SUFFIXES = ["ون", "ان", "ين", "وا", "ن"]
LIGHT10_PREFIXES = ["وال", "بال", "كال", "فال", "لل", "ال", "وب", "وك", "ول", "وف", "و", "ب", "ك", "ل", "ف"]
LIGHT10_SUFFIXES = ["هما", "كما", "هم", "هن", "كم", "كن", "نا", "ها", "ية", "ات", "ون", "ين", "ان", "تم", "تن", "وا", "ة", "ه", "ي", "و", "ا"]

# Word patterns, tried in order among those of the word's length. 1, 2, 3, 4 are the letters of the root,
# equal where a digit recurs; P is one of the imperfect prefixes; other letters stand for themselves.
ROOT_PATTERNS = [
    "123",
    "12ا3", "12ي3", "1ا23", "12و3", "ا123", "م123", "ت123",
    "ا12ا3", "ت1223", "ت12ي3", "م12و3", "م12ا3", "ت1ا23", "122ا3", "123ان", "12ا3ه", "م123ه", "م1223", "12ي3ه", "ا1233", "ست123",
    "P1ت23", "Pن123", "P1223", "P1ا23",
    "مست123", "Pست123", "Pت1223", "Pت1ا23", "ان12ا3", "ا1ت2ا3", "م12و3ه", "ت12ي3ه", "ت1234ه",
    "است12ا3", "ا12ي3ا3",
    "است12ا3ه",
]


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that f names many times, evaluated once: a large CASE over it stays small in generated code."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _letter(word: Column, i: int) -> Column:
    return F.substring(word, i + 1, 1)


def strip_prefix(word: Column, prefixes: list[str], least: int) -> Column:
    """Without the first prefix of the list that leaves `least` letters."""
    return F.regexp_replace(word, f"^(?:{'|'.join(prefixes)})(?=.{{{least}}})", "")


def strip_suffix(word: Column, suffixes: list[str], least: int) -> Column:
    """Without the longest suffix of the list that leaves `least` letters."""
    return F.regexp_replace(word, f"^(.{{{least},}}?)(?:{'|'.join(suffixes)})$", "$1")


def strip_article(word: Column | str) -> Column:
    return strip_prefix(normalize_lexical(word), ARTICLES, 3)


def light_stem(word: Column | str) -> Column:
    """One prefix and one suffix less, three letters left."""
    return strip_suffix(strip_prefix(normalize_lexical(word), PREFIXES, 3), SUFFIXES, 3)


def light10_stem(word: Column | str) -> Column:
    """One prefix and one suffix less, two letters left; no normalisation."""
    return strip_suffix(strip_prefix(col(word), LIGHT10_PREFIXES, 2), LIGHT10_SUFFIXES, 2)


def _words_replaced(text: Column, regex: str, by: str) -> Column:
    """A text whose words are parted by single blanks, with words that match replaced. Each is found by the blank before
    it, which costs less than to look behind every character."""
    return F.substr(F.regexp_replace(F.concat(F.lit(" "), text), f" {regex}", f" {by}"), F.lit(2))


def _any_of(affixes: list[str]) -> str:
    """Affixes as a regular expression, by their first letters: as what a word ends with they need no order."""
    return "|".join(f"{c}(?:{'|'.join(a[1:] for a in affixes if a[0] == c)})" for c in dict.fromkeys(a[0] for a in affixes))


def _stems_of_text(text: Column, prefixes: list[str], suffixes: list[str], least: int) -> Column:
    """strip_prefix and strip_suffix of each word of a text, in one pass over it."""
    stem = rf"(?:(?:{'|'.join(prefixes)})(?=\S{{{least}}}))?+(\S{{{least},}}?)(?:{_any_of(suffixes)})?(?!\S)"
    return _words_replaced(text, stem, "$1")


def light_text(text: Column | str) -> Column:
    """light_stem of each word of a text, by passes over the whole text: no word is a value of its own."""
    spaced = F.regexp_replace(normalize_lexical(text), r"\s+", " ")
    trimmed = F.regexp_replace(spaced, rf"(?={SPACE})(?:{SPACE}+(?!\S)|(?<!\S){SPACE}+)", "")
    return _stems_of_text(trimmed, PREFIXES, SUFFIXES, 3)


def light10_text(text: Column | str) -> Column:
    """light10_stem of each word of a text."""
    return _stems_of_text(F.regexp_replace(col(text), r"\s+", " "), LIGHT10_PREFIXES, LIGHT10_SUFFIXES, 2)


def imperfect_stems(word: Column | str) -> Column:
    """Array of what is left without an imperfect prefix, then without a suffix as well; three letters at least."""
    return once(normalize_lexical(word), _imperfect_stems)


def _imperfect_stems(w: Column) -> Column:
    found = []
    for p in IMPERFECT_PREFIXES:
        rest = F.substring(w, F.lit(len(p) + 1), F.length(w))
        good = w.startswith(p) & (F.length(rest) >= 3)
        found.append(F.when(good, rest))
        for s in IMPERFECT_SUFFIXES:
            found.append(F.when(good & rest.endswith(s) & (F.length(rest) - len(s) >= 3), F.substring(rest, F.lit(1), F.length(rest) - len(s))))
    return F.array_distinct(F.array_compact(F.array(*found)))


def root_regex(letter: str, end: str) -> tuple[str, str]:
    """All word patterns as one regular expression, and a word's root as a replacement: the first pattern that fits wins.

    letter matches a letter, end what follows the word. Alternatives are tried among patterns of the word's length;
    letters of the root become groups, of which only the fitting pattern's are not empty.
    """
    groups, by_length = 0, []
    for n in sorted({len(p) for p in ROOT_PATTERNS}):
        fits = []
        for pattern in (p for p in ROOT_PATTERNS if len(p) == n):
            out, seen, last = "", {}, ""
            for p in pattern:
                if not p.isdigit():
                    out += f"[{''.join(IMPERFECT_PREFIXES)}]" if p == "P" else p
                elif p in seen:
                    out += f"\\{seen[p]}"
                elif last.isdigit() and pattern.count(p) == pattern.count(last) == 1:  # letters in a row are one group
                    out, seen[p] = f"{out[:-1]}{letter})", groups
                else:
                    groups += 1
                    out, seen[p] = f"{out}({letter})", groups
                last = p
            assert list(seen) == sorted(seen)  # groups stand in the order of the root's letters
            fits.append(out)
        by_length.append(f"(?={letter}{{{n}}}{end})(?:{'|'.join(fits)})")
    return f"(?:{'|'.join(by_length)}){end}", "".join(f"${i + 1}" for i in range(groups))


def extract_root(word: Column | str) -> Column:
    """Root letters by the first pattern that fits, or null: one regular expression, no Python at run time."""
    regex, root = root_regex(".", "$")
    w = normalize_lexical(word)
    return F.when(w.rlike(f"^{regex}"), F.regexp_replace(w, f"^{regex}", root))


def roots_of_text(text: Column | str) -> Column:
    """Each word of a text as its root, or as it is where no pattern fits, by passes over the whole text.

    Words of three characters are their own roots, and are passed over.
    """
    regex, root = root_regex(r"\S", rf"(?<!{SPACE}){SPACE}*+(?!\S)")
    spaced = F.regexp_replace(normalize_lexical(text), r"\s+", " ")
    return _words_replaced(spaced, rf"(?=\S{{4}}){SPACE}*+{regex}", root)


def weak_roots(root: Column | str) -> Column:
    """The root, then what it may stand for if a letter is weak: array without repeats. Null stays null."""
    return once(col(root), _weak_roots)


def _weak_roots(r: Column) -> Column:
    n, waw, yeh = F.length(r), F.lit("و"), F.lit("ي")
    head, tail = _letter(r, 0), F.substring(r, F.lit(3), n)
    body, rest = F.substring(r, F.lit(1), n - 1), F.substring(r, F.lit(2), n)
    middle = _letter(r, 1)
    found = [
        r,
        F.when(middle == ALEF, F.concat(head, waw, tail)),
        F.when(middle == ALEF, F.concat(head, yeh, tail)),
        F.when(middle == "ي", F.concat(head, waw, tail)),
        F.when(middle == "و", F.concat(head, yeh, tail)),
        F.when(r.endswith(ALEF), F.concat(body, waw)),
        F.when(r.endswith(ALEF), F.concat(body, yeh)),
        F.when(r.endswith("ي"), F.concat(body, waw)),
        F.when(head == ALEF, F.concat(waw, rest)),
        F.when(head == ALEF, F.concat(yeh, rest)),
    ]
    return F.when(r.isNull(), F.lit(None)).when(n < 3, F.array(r)).otherwise(F.array_distinct(F.array_compact(F.array(*found))))


def apply_template(root: Column | str, template: str) -> Column:
    """A word of a root: digits of the template are the root's letters."""
    r = col(root)
    return F.concat(*(_letter(r, int(t) - 1) if t.isdigit() else F.lit(t) for t in template))

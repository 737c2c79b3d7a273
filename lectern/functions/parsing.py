"""Parsers of catalog fields, dictionary lines and narration texts, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from lectern.functions import morphology as M
from lectern.functions.text import DIACRITICS, col, normalize_lexical, normalize_search, squeeze, strip_diacritics, to_western_digits, trim, truncate_at_sentence
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"[\u0600-\u06FF]"
_D = "[٠-٩0-9]"


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, trimmed; null without a match."""
    return F.when(c.rlike(pattern), trim(F.regexp_extract(c, pattern, group)))


# --- books --------------------------------------------------------------------------------------------------------


def info_block(info: Column | str) -> Column:
    """Struct of the `key: value` lines that describe an edition; what is absent is null."""
    t = col(info)
    western = to_western_digits(t)
    line = lambda key: _found(t, rf"(?m)^\s*{key}\s*:\s*(.+)$")
    publisher, edition = line("الناشر"), line("الطبعة")
    split = r"^(.+?)\s*[-،,]\s+(.+)$"
    edition_w = to_western_digits(edition)
    author = _found(western, r"(?m)^\s*المؤلف\s*:\s*(.+)$")
    both = r"\((\d{1,4})\s*[-–]\s*(\d{1,4})\s*هـ?\)"
    note = _found(t, r"\[([^\]]*(?:ترقيم|مرقم|موافق)[^\]]*)\]")
    return F.struct(
        line("المحقق").alias("editor"),
        line("المحقق").isNotNull().alias("is_verified"),
        F.coalesce(_found(publisher, split, 1), publisher).alias("publisher"),
        _found(publisher, split, 2).alias("publisher_location"),
        edition.alias("edition"),
        _found(edition_w, r"(\d{3,4})\s*هـ").alias("year_hijri"),
        _found(edition_w, r"(\d{4})\s*م").alias("year_gregorian"),
        note.alias("page_alignment_note"),
        _found(author, both, 1).alias("author_birth_hijri"),
        F.coalesce(_found(author, both, 2), _found(author, r"\(ت\s*(\d{1,4})\s*هـ?\)")).alias("author_death_hijri"),
    )


def volume_number(label: Column | str, labels: Column) -> Column:
    """Number of a volume label among a book's labels: its digits; a name counts by its place, the first as 0."""
    c = col(label)
    number = lambda x: F.nullif(F.regexp_extract(x, r"^\s*(\d+)", 1), F.lit("")).cast("int")
    place = F.array_position(labels, c).cast("int") - 1
    return F.coalesce(number(c), F.when(place >= 0, place), F.lit(1))


def pdf_url(root: Column, files: Column, volume: Column, host: str) -> Column:
    """Address of a volume's file: the last file serves later volumes, labels after | go, relative roots get a host."""
    file = F.split_part(F.get(files, F.least(volume, F.size(files) - 1)), F.lit("|"), F.lit(1))
    base = F.when(root.endswith("/"), root).otherwise(F.concat(root, F.lit("/")))
    relative = F.regexp_replace(F.regexp_replace(F.url_encode(F.concat(base, file)), r"\+", "%20"), "%2F", "/")
    return F.when(F.size(files) < 1, None).when(root.isNull(), F.when(file.startswith("http"), file)).when(root.startswith("http"), F.concat(base, file)).otherwise(F.concat(F.lit(host), relative))


def url(template: str, **parts: Column) -> Column:
    """An address of a template with {name} parts."""
    return reduce(lambda acc, kv: F.replace(acc, F.lit("{" + kv[0] + "}"), kv[1].cast("string")), parts.items(), F.lit(template))


# --- dictionaries -------------------------------------------------------------------------------------------------

# How dictionaries set off a headword at the start of a line. Group 1 is the headword.
ENTRY_STYLES = {
    "standard": rf"^({_WORD}{{2,}}):\s",
    "spaced": rf"^((?:{_WORD}\s){{2,}}{_WORD}):\s",
    "parens": rf"^\(((?:{_WORD}|\s)+)\):\s",
    "short_root": rf"^\s*({_WORD}{{2,6}})\s*$",
    "brackets": rf"^\[((?:{_WORD}|\s)+)\]",
    "leading_parens": rf"^\(({_WORD}+)\)",
    "spaced_line": rf"^\s*((?:{_WORD}\s){{2,}}{_WORD})\s*$",
    "title_span": r"(?s)<span[^>]*data-type=\"title\"[^>]*>(.*?)</span>",
    "phrase": rf"^({_WORD}(?:{_WORD}|\s){{2,}}):\s",
}


def headword(line: Column | str, style: str) -> Column:
    """The headword that a line opens with in a style, or null."""
    found = _found(col(line), ENTRY_STYLES[style])
    if style in ("spaced", "spaced_line"):
        return F.regexp_replace(found, r"\s", "")
    if style == "short_root":
        return F.when(F.length(strip_diacritics(found)).between(2, 3), found)
    if style == "title_span":
        plain = trim(F.regexp_replace(found, r"<[^>]+>", ""))
        return F.when(plain.rlike(_WORD), plain)
    if style == "phrase":
        return F.when((F.regexp_count(found, F.lit(_WORD)) >= 2) & (F.length(found) <= 60), found)
    return found


def definition_after(line: Column | str, style: str) -> Column:
    """What follows the headword on its line."""
    return F.regexp_replace(col(line), ENTRY_STYLES[style], "")


def clean_headword(c: Column | str) -> Column:
    """Without footnote marks, scripture brackets, a leading conjunction and citation words."""
    for pattern in (rf"\(\^?{_D}+\)", "[﴿﴾]", r"^\s*و\s+", r"^\s*(?:في المثل|يقال|ويقال)\s*:?\s*"):
        c = trim(F.regexp_replace(col(c), pattern, ""))
    return c


def clean_definition(c: Column | str) -> Column:
    return trim(F.regexp_replace(col(c), rf"\(\^?{_D}+\)", ""))


def _letters(c: Column) -> Column:
    return F.when(F.length(c).between(3, 4) & c.rlike("^[ء-ي]+$"), c)


def headword_root(word: Column | str) -> Column:
    """Root of a headword by its pattern, without its article first; short words are roots themselves. Or empty."""
    bare = M.strip_article(word)
    return F.coalesce(_letters(F.coalesce(M.extract_root(bare), M.extract_root(normalize_lexical(word)))), _letters(bare), F.lit(""))


def validated_root(root: Column | str) -> Column:
    """A root from elsewhere without article, normalised, of three or four letters; else empty."""
    return F.coalesce(_letters(normalize_lexical(F.regexp_replace(trim(root), "^ال", ""))), F.lit(""))


def definition_faults(head: Column, definition: Column, page: Column) -> dict[str, Column]:
    """Ordered reasons to reject an extracted definition, for etl.reject_reasons."""
    h, d = trim(head), trim(definition)
    return {
        "empty": (F.coalesce(h, F.lit("")) == "") | (F.coalesce(d, F.lit("")) == ""),
        "page_zero": page == 0,
        "number_headword": h.rlike(rf"^[{_D[1:-1]}\s().\-]+$"),
        "footnote_as_headword": h.startswith("(^") | h.rlike(rf"\(\^?{_D}+\)"),
        "headword_too_long": F.length(h) > 40,
        "section_header": h.rlike(r"^(?:باب|كتاب|فصل|حرف)\s"),
        "page_ref_only": d.rlike(rf"^[{_D[1:-1]}\s,،/\-]+$"),
        "definition_too_short": F.length(F.regexp_replace(d, r"\s", "")) < 3,
    }


# --- narrations ---------------------------------------------------------------------------------------------------

# Phrases that mark headings, chains of transmission, and the start of what was said.
HEADING = rf"^(?:\({_D}+\)\s*(?:\({_D}+\)\s*)?-?\s*باب|{_D}+ - (?:كتاب|باب)|(?:كتاب|باب|أبواب|ذكر)\s|\[كتاب)"
TRANSMISSION = r"حدثنا|أخبرنا|عن|سمعت|أنبأنا|حدثني|أخبرني|(?:ثنا|أنا)(?![\p{L}\p{M}])"
CHAIN_START = r"^-?\s*(?:اخبرنا|حدثنا|حدثني|انبانا|انا |اخبرني|قال:?\s|عن |سمعت |بمثله|نحوه|مثله)"
_M = f"{DIACRITICS}*"


def _loose(phrase: str) -> str:
    """A phrase as a pattern that tolerates diacritics after each letter, and any white space."""
    return r"\s+".join("".join(ch + _M for ch in word) for word in phrase.split())


_SPEAKERS = "(?:" + "|".join(_loose(p) for p in ("رسول الله", "النبي", "نبي الله")) + ")"
_VERBS = "(?:" + "|".join(_loose(p) for p in ("سمعت", "أن", "إن")) + "|[فو]?" + _M + "(?:" + "|".join(_loose(p) for p in ("قال له", "قال لها", "قال", "كان", "أمر", "نهى")) + "))"
BODY_START = rf"(?<![\p{{L}}\p{{M}}])(?:{_VERBS}\s+{_SPEAKERS}|{_SPEAKERS}(?=\s*\S*\s*{_loose('يقول')}))"


def strip_page_marks(c: Column | str) -> Column:
    return squeeze(F.regexp_replace(col(c), rf"\s*⦗{_D}+⦘\s*", " "))


def strip_footnote_marks(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(col(c), rf"\(\^{_D}+\)", ""), r"\s{2,}", " ")


def split_footnotes(c: Column | str) -> Column:
    """Struct (main, footnotes) at the first rule of nine underscores; no footnotes are null."""
    at = F.instr(col(c), "_________")
    notes = F.nullif(trim(F.regexp_replace(F.substring(col(c), at, F.length(col(c))), r"^_+\s*", "")), F.lit(""))
    return F.struct(F.when(at > 0, trim(F.substring(col(c), F.lit(1), at - 1))).otherwise(col(c)).alias("main"), F.when(at > 0, notes).alias("footnotes"))


def remove_inline_footnotes(c: Column | str) -> Column:
    """Struct (main, footnotes): after each rule, lines that begin with a number in brackets are notes, others text."""
    sections = F.split(col(c), r"_________+")
    is_note = lambda x: trim(x).rlike(rf"^\({_D}+\)")
    later = F.flatten(F.transform(F.slice(sections, 2, 1 << 30), lambda s: F.filter(F.split(s, "\n"), lambda x: trim(x) != "")))
    notes, text = F.filter(later, is_note), F.filter(later, lambda x: ~is_note(x))
    main = trim(F.array_join(F.concat(F.slice(sections, 1, 1), text), "\n"))
    return F.struct(F.when(F.size(sections) > 1, main).otherwise(col(c)).alias("main"), F.when(F.size(notes) > 0, F.array_join(F.transform(notes, trim), "\n")).alias("footnotes"))


def strip_trailing_headings(c: Column | str, more: str = "") -> Column:
    """Without headings and blank lines at the end. more: further patterns of a heading line."""
    heading = HEADING + (f"|{more}" if more else "")
    lines = F.split(col(c), "\n")
    last = F.aggregate(F.transform(lines, lambda x, i: F.when((trim(x) != "") & ~strip_diacritics(trim(x)).rlike(heading), i + 1).otherwise(0)), F.lit(0), lambda a, x: F.greatest(a, x))
    return F.array_join(F.slice(lines, F.lit(1), last), "\n")


def clean_book_heading(c: Column | str) -> Column:
    """A heading without its number, what follows from the invocation on, and a full stop at the end."""
    invocation = _loose("بسم الله الرحمن الرحيم")
    t = F.regexp_replace(col(c), rf"^{_D}+ - ", "")
    t = trim(F.regexp_replace(t, rf"(?s){invocation}.*$", ""))
    return trim(F.regexp_replace(F.regexp_replace(t, r"\s*﷽\s*", ""), r"\.\s*$", ""))


def is_body_only(c: Column | str) -> Column:
    """Whether no verb of transmission occurs."""
    return ~F.regexp_replace(col(c), rf"\({_D}+\)", "").rlike(TRANSMISSION)


def reconstructs(chain: Column, body: Column, whole: Column) -> Column:
    """Whether chain and body, white space aside, are the whole."""
    return squeeze(F.concat_ws(" ", F.coalesce(chain, F.lit("")), F.coalesce(body, F.lit("")))) == squeeze(whole)


def move_body_start(chain: Column | str, body: Column | str) -> Column:
    """Struct (chain, body, moved): the chain is cut at the last phrase that starts a body, which goes to the body."""
    t = col(chain)
    cut = F.regexp_replace(t, rf"(?s)^(.*)({BODY_START}.*)$", "$1\u0001$2")
    moved = cut.contains("\u0001")
    head = F.regexp_replace(F.split_part(cut, F.lit("\u0001"), F.lit(1)), r"[,،:\s]+$", "")
    tail = trim(F.regexp_replace(F.concat_ws(" ", trim(F.split_part(cut, F.lit("\u0001"), F.lit(2))), col(body)), " {2,}", " "))
    return F.struct(F.when(moved, trim(head)).otherwise(t).alias("chain"), F.when(moved, tail).otherwise(col(body)).alias("body"), moved.alias("moved"))


def split_quoted(c: Column | str, style: str = "quotes", share: float = 0.7) -> Column:
    """Struct (chain, body) of a narration with quotation marks.

    'quotes': the body lies between the outermost ASCII or curly marks. 'guillemets': all lies within guillemets, and
    the body follows the last 'said:' that ends within the first `share` of the letters.
    """
    t = col(c)
    if style == "quotes":
        parts = r'(?s)^([^"]*)"(.*)"[^"]*$', r"(?s)^([^“]*)“(.*)”[^”]*$"
        chain = F.coalesce(*(F.when(t.rlike(p), trim(F.regexp_extract(t, p, 1))) for p in parts), t)
        body = F.coalesce(*(F.when(t.rlike(p), trim(F.regexp_extract(t, p, 2))) for p in parts), F.lit(""))
        return F.struct(chain.alias("chain"), body.alias("body"))
    inside = trim(F.regexp_extract(t, r"(?s)«(.*)»", 1))
    said = "(?:" + "|".join(_loose(p) + ":" for p in ("قال", "يقول", "قالت")) + r")\s"
    limit = F.length(strip_diacritics(inside)) * share
    pieces = F.split(F.regexp_replace(inside, said, "$0\u0001"), "\u0001")
    # Ends of the pieces, in letters without diacritics: the last that lies within the limit starts the body.
    ends = F.transform(F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))), lambda k: F.length(strip_diacritics(F.array_join(F.slice(pieces, F.lit(1), k), ""))))
    k = F.when(F.size(pieces) > 1, F.size(F.filter(ends, lambda e: e <= limit))).otherwise(0)
    head = trim(F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), k), ""), f"{said}$", ""))
    body = trim(F.array_join(F.slice(pieces, k + 1, F.greatest(F.size(pieces) - k, F.lit(0))), ""))
    has = t.rlike(r"(?s)«.*»")
    return F.struct(F.when(~has, t).otherwise(head).alias("chain"), F.when(~has, "").otherwise(body).alias("body"))


# Ligatures of honorific phrases, written out.
LIGATURES = {"ﷲ": "الله", "ﷴ": "محمد", "ﷺ": "صلى الله عليه وسلم", "ﷻ": "جل جلاله", "﷽": "بسم الله الرحمن الرحيم"}


def expand_ligatures(c: Column | str) -> Column:
    """Known ligatures written out; others of their blocks go."""
    t = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), LIGATURES.items(), col(c))
    return F.regexp_replace(t, r"[﵀-﵏ﷰ-﷿]", "")


def split_at(text: Column | str, start: Column | str) -> Column:
    """Position, from 0, at which a text begins with `start`, diacritics, ligatures and white space aside; or -1.

    The normalised position is mapped back by the shortest head of the text that normalises to more characters. Heads
    normalise to ever more, so it is found by halving, in as many steps as the length has binary digits.
    """
    t, s = col(text), col(start)
    exact = F.instr(t, s) - 1
    norm = lambda x: squeeze(strip_diacritics(expand_ligatures(x)))
    at = F.instr(norm(t), norm(s)) - 1

    def halve(r: Column, _: Column) -> Column:
        middle = F.floor((r["low"] + r["high"]) / 2).cast("int")
        beyond = F.length(norm(F.substring(t, F.lit(1), middle))) > at
        return F.when(r["low"] >= r["high"], r).when(beyond, F.struct(r["low"].alias("low"), middle.alias("high"))).otherwise(F.struct((middle + 1).alias("low"), r["high"].alias("high")))

    whole = F.struct(F.lit(1).alias("low"), F.length(t).alias("high"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(31)), whole, halve)["low"]
    return F.when(exact > 0, exact).when(at > 0, first - 1).otherwise(-1)


# --- languages and model answers ----------------------------------------------------------------------------------

# Languages by name, and those that are written from right to left.
LANGUAGE_CODES = {
    "arabic": "ar", "english": "en", "french": "fr", "german": "de", "spanish": "es", "italian": "it", "portuguese": "pt", "russian": "ru",
    "turkish": "tr", "urdu": "ur", "persian": "fa", "farsi": "fa", "indonesian": "id", "malay": "ms", "bengali": "bn", "hindi": "hi",
    "chinese": "zh", "japanese": "ja", "korean": "ko", "dutch": "nl", "swedish": "sv", "swahili": "sw", "tajik": "tg", "tamil": "ta",
    "tatar": "tt", "telugu": "te", "thai": "th", "uighur": "ug", "uyghur": "ug", "ukrainian": "uk", "uzbek": "uz", "vietnamese": "vi",
    "yoruba": "yo", "pashto": "ps", "sindhi": "sd", "kurdish": "ku", "hebrew": "he", "divehi": "dv",
}
RTL = ["ar", "ur", "fa", "he", "ps", "sd", "dv", "ku", "ug"]


def language_code(name: Column | str) -> Column:
    """Code of the first of comma-separated language names that is known; else its first two letters."""
    known = F.create_map(*(F.lit(x) for kv in LANGUAGE_CODES.items() for x in kv))
    codes = F.array_compact(F.transform(F.split(F.lower(col(name)), ","), lambda x: F.try_element_at(known, F.trim(x))))
    return F.when(F.coalesce(col(name), F.lit("")) == "", "unknown").otherwise(F.coalesce(F.get(codes, F.lit(0)), F.lower(F.substring(F.trim(col(name)), 1, 2))))


def is_rtl(code: Column | str) -> Column:
    return col(code).isin(RTL)


def unfenced(c: Column | str) -> Column:
    """A model's answer without the fence around it."""
    return trim(F.regexp_replace(trim(c), r"^```(?:json)?|```$", ""))


def json_array_in(c: Column | str) -> Column:
    """The outermost JSON array in an answer, as text; null without one."""
    return _found(unfenced(c), r"(?s)(\[.*\])")


# --- texts to embed -----------------------------------------------------------------------------------------------


def with_prefix(prefix: Column, text: Column | str) -> Column:
    """A source's name before its normalised text, cut at a sentence."""
    return truncate_at_sentence(F.concat_ws(" ", prefix, normalize_search(text)))


def remove_stop_words(c: Column | str, stop_words: list[str], least: float = 0.2) -> Column:
    """Without stop words; the text itself if under `least` of its words would be left."""
    words = F.split(col(c), r"\s+")
    kept = F.filter(words, lambda w: ~w.isin(stop_words))
    return F.when(F.size(kept) < F.size(words) * least, col(c)).otherwise(F.array_join(kept, " "))


#: Ways to prepare a text for retrieval, by name: Column in, Column out. What takes a model is the caller's.
TECHNIQUES: dict[str, Callable[[Column], Column]] = {
    "baseline": normalize_search,
    "no_diacritics": strip_diacritics,
    "lexical": normalize_lexical,
    "roots": M.roots_of_text,
    "light_stem": M.light_text,
    "light10_stem": lambda c: M.light10_text(normalize_search(c)),
    "first_sentences": lambda c: truncate_at_sentence(normalize_search(c)),
}


def best_paragraph(snippet: Column | str, paragraphs: Column) -> Column:
    """Index of the paragraph that contains a snippet, or lies in it; else of the one that shares most of its words.

    Words over two characters count, each time that they occur; the first of equals wins.
    """
    clean = squeeze(F.regexp_replace(col(snippet), r"(?i)</?mark>", ""))
    long_words = lambda t: F.filter(F.split(t, r"\s+"), lambda w: F.length(w) > 2)
    wanted = long_words(clean)
    inside = F.transform(paragraphs, lambda p: squeeze(p).contains(clean) | clean.contains(squeeze(p)))
    shared = F.transform(paragraphs, lambda p: F.size(F.filter(long_words(p), lambda w: F.array_contains(wanted, w))))
    first = F.array_position(inside, F.lit(True)).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.array_position(shared, F.array_max(shared)).cast("int") - 1)

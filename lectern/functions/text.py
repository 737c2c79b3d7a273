"""Text functions: Column in, Column out. All are built-in expressions that Catalyst can compile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points and patterns that define Arabic-script normalisation.
DIACRITICS = r"[\u064B-\u065F\u0670]"
ALEF_FORMS = "آأإٱ"
HAMZA_FORMS = "ءآأؤإئٱ"
ALEF, HAMZA, ALEF_MAKSURA, YEH, TEH_MARBUTA, HEH = "ا", "ء", "ى", "ي", "ة", "ه"
ARABIC_SCRIPT = r"[\u0600-\u06FF\u0750-\u077F]"
ARABIC_ANY = r"[\u0600-\u06FF\u0750-\u077F\u08A0-\u08FF\uFB50-\uFDFF\uFE70-\uFEFF]"
ARABIC_DIGITS, WESTERN_DIGITS = "٠١٢٣٤٥٦٧٨٩", "0123456789"
#: White space beyond what \\s matches, as the inside of a class.
SPACES = r"\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
#: White space, Unicode's included, as characters.
WHITE = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
#: One such character; letters of most scripts fail by two comparisons, before the long class is asked.
_WHITE = rf"[\x00-\x20\u00A0\u1680-\uFEFF&&[\s{SPACES}]]"
SPACE = rf"[\u00A0\u1680-\uFEFF&&[{SPACES}]]"
#: White space that is not a single space: what squeezing has to change.
_UNEVEN = rf" {_WHITE}+|(?! ){_WHITE}+|[\x1C-\x1F]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim(c: Column | str) -> Column:
    """Without white space, Unicode's included, at either end."""
    return F.btrim(col(c), F.lit(WHITE))


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one space; none at either end."""
    return F.trim(F.regexp_replace(col(c), _UNEVEN, " "))


def fold_letters(c: Column | str, drop_hamza: bool = False) -> Column:
    """Alef forms to bare alef, alef maksura to yeh, teh marbuta to heh; the lone hamza goes if asked."""
    source = ALEF_FORMS + ALEF_MAKSURA + TEH_MARBUTA + (HAMZA if drop_hamza else "")
    return F.translate(col(c), source, ALEF * len(ALEF_FORMS) + YEH + HEH)


def strip_diacritics(c: Column | str) -> Column:
    return F.regexp_replace(col(c), DIACRITICS, "")


def fold_for_search(c: Column | str) -> Column:
    """No diacritics, folded letters, no hamza: one pass over texts with any Arabic letter, none over others."""
    marks = "".join(map(chr, [*range(0x64B, 0x660), 0x670]))
    source = ALEF_FORMS + ALEF_MAKSURA + TEH_MARBUTA + HAMZA + marks
    return F.when(col(c).rlike(ARABIC_SCRIPT), F.translate(col(c), source, ALEF * len(ALEF_FORMS) + YEH + HEH)).otherwise(col(c))


def normalize_search(c: Column | str) -> Column:
    """What search and embeddings compare: no diacritics, folded letters, no hamza, single spaces."""
    return squeeze(fold_for_search(c))


def normalize_lexical(c: Column | str) -> Column:
    """What dictionaries compare: no diacritics, folded letters; hamza and inner white space stay."""
    return trim(fold_letters(strip_diacritics(c)))


def normalize_vocalized(c: Column | str) -> Column:
    """Folded letters with their diacritics."""
    return trim(fold_letters(c))


def has_diacritics(c: Column | str) -> Column:
    return col(c).rlike(DIACRITICS)


def fold_hamza(c: Column | str) -> Column:
    """Every carrier of hamza becomes bare alef, as roots need."""
    return F.translate(col(c), HAMZA_FORMS, ALEF * len(HAMZA_FORMS))


def has_arabic(c: Column | str) -> Column:
    return col(c).rlike(ARABIC_SCRIPT)


def to_western_digits(c: Column | str) -> Column:
    return F.translate(col(c), ARABIC_DIGITS, WESTERN_DIGITS)


def to_arabic_digits(c: Column | str) -> Column:
    return F.translate(col(c), WESTERN_DIGITS, ARABIC_DIGITS)


def first_number(c: Column | str) -> Column:
    """The first run of digits, in Western digits; null if there is none."""
    found = F.regexp_extract(to_western_digits(c), r"(\d+)", 1)
    return F.when(found != "", found)


def century(year: Column | str) -> Column:
    """ceil(year / 100) of an all-digit year, else null."""
    return F.when(col(year).rlike(r"^\d+$"), F.ceil(col(year).try_cast("long") / 100)).cast("int")


# --- HTML -------------------------------------------------------------------------------------------------------

_NAMED = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]


def resolve_entities(c: Column | str) -> Column:
    out = col(c)
    for entity, char in _NAMED:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def _opened(part: Column, opener: str) -> tuple[Column, Column]:
    """Where the first tag that begins as `opener` starts in a part of markup, and where it ends; 0 where there is none."""
    start = F.regexp_instr(part, F.lit(opener))
    return start, F.when(start > 0, F.position(F.lit(">"), part, start)).otherwise(0)


def _pieces(markup: Column, closer: str) -> tuple[Column, Column]:
    """The parts of markup that end with a closing tag, without it, and the rest after the last: what an opening tag may
    belong to is its part, so that one pass finds all elements, however many tags are never closed."""
    parts = F.split(markup, closer)
    return F.slice(parts, 1, F.size(parts) - 1), F.element_at(parts, -1)


def without_elements(markup: Column, tag: str) -> Column:
    """Markup without the elements of a tag: from the first opening tag to the next closing one."""
    parts, rest = _pieces(markup, f"(?i)</{tag}>")

    def kept(part: Column) -> Column:
        start, end = _opened(part, f"(?i)<{tag}")
        return F.when(end > 0, F.substring(part, F.lit(1), start - 1)).otherwise(F.concat(part, F.lit(f"</{tag}>")))

    return F.concat(F.array_join(F.transform(parts, kept), ""), rest)


def elements(markup: Column, tag: str) -> Column:
    """What stands in the elements of a tag, in order."""
    parts, _ = _pieces(markup, f"(?i)</{tag}>")

    def content(part: Column) -> Column:
        _, end = _opened(part, f"(?i)<{tag}")
        return F.when(end > 0, F.substring(part, end + 1, F.length(part)))

    return F.array_compact(F.transform(parts, content))


def _tags_replaced(markup: Column, *replaced: tuple[str, str]) -> Column:
    """Patterns of whole tags replaced, up to the last end of a tag: what follows has none, and is not searched for one."""
    last = F.length(markup) - F.instr(F.reverse(markup), ">") + 1
    last = F.when(F.contains(markup, F.lit(">")), last).otherwise(0)
    head = F.substring(markup, F.lit(1), last)
    for pattern, by in replaced:
        head = F.regexp_replace(head, pattern, by)
    return F.concat(head, F.substring(markup, last + 1, F.length(markup)))


def html_to_text(html: Column | str) -> Column:
    """Plain text of markup: scripts and styles go, blocks and breaks part lines, lines are trimmed and not empty."""
    t = resolve_entities(without_elements(without_elements(col(html), "script"), "style"))
    t = _tags_replaced(t, (r"(?i)</?(p|div|br|h[1-6]|li|tr)[^>]*>", "\n"), (r"<[^>]+>", ""))
    return F.array_join(F.filter(F.transform(F.split(F.regexp_replace(t, r"[ \t]+", " "), "\n"), trim), lambda x: x != ""), "\n")


def inline_text(html: Column | str) -> Column:
    """Text of inline markup on one line."""
    return squeeze(resolve_entities(_tags_replaced(col(html), (r"<[^>]+>", ""))))


def text_with_breaks(html: Column | str) -> Column:
    """Text of markup whose breaks, paragraphs and divisions end lines; at most one empty line in a row is kept."""
    t = _tags_replaced(F.regexp_replace(col(html), r"(?i)<br\s*/?>|</p>|</div>", "\n"), (r"<[^>]+>", ""))
    return trim(F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"[ \t]+", " "))


def paragraph_texts(html: Column | str) -> Column:
    """Texts of <p> elements, over one character long, in order."""
    plain = F.transform(elements(col(html), "p"), lambda x: squeeze(F.replace(_tags_replaced(x, (r"<[^>]+>", "")), F.lit("&nbsp;"), F.lit(" "))))
    return F.filter(plain, lambda x: F.length(x) > 1)


def is_meaningful(c: Column | str, script: str = ARABIC_ANY) -> Column:
    """Two characters or more, some of the script, and not numbers and marks alone."""
    return (F.length(c) >= 2) & col(c).rlike(script) & col(c).rlike(r"[\p{L}\p{M}]")


def paragraphs(html: Column | str, script: str = ARABIC_ANY) -> Column:
    """Array of (index, text): meaningful <p> elements under their original index, or lines where there are none.

    Lines inside a title span count as one. script: what a paragraph must hold some of.
    """

    def kept(parts: Column) -> Column:
        all_parts = F.transform(parts, lambda x, i: F.struct(i.alias("index"), inline_text(x).alias("text")))
        return F.filter(all_parts, lambda p: is_meaningful(p["text"], script))

    found = kept(elements(col(html), "p"))
    return F.when(F.size(found) > 0, found).otherwise(kept(F.split(titles_on_one_line(col(html)), "\n")))


def titles_on_one_line(markup: Column) -> Column:
    """Markup in which line ends inside title spans, from the opening tag to the next closing one, are spaces."""
    parts, rest = _pieces(markup, "</span>")

    def joined(part: Column) -> Column:
        start, end = _opened(part, r"<span\s+data-type=['\"]title['\"]")
        inside = F.replace(F.substring(part, start, F.length(part)), F.lit("\n"), F.lit(" "))
        return F.concat(F.when(end > 0, F.concat(F.substring(part, F.lit(1), start - 1), inside)).otherwise(part), F.lit("</span>"))

    return F.concat(F.array_join(F.transform(parts, joined), ""), rest)


# --- language and content flags ----------------------------------------------------------------------------------


def latin_share(c: Column | str) -> Column:
    """Share of letters that are Latin; null without letters."""
    letters = F.regexp_count(col(c), F.lit(r"\p{L}"))
    return F.when(letters > 0, F.regexp_count(col(c), F.lit(r"[a-zA-Z]")) / letters)


def wrong_language(c: Column | str, target_is_latin: Column | bool, share: float = 0.7, least: int = 10) -> Column:
    """Whether a text for a non-Latin target has over `share` Latin letters among `least` letters or more."""
    target = F.lit(target_is_latin) if isinstance(target_is_latin, bool) else target_is_latin
    letters = F.regexp_count(col(c), F.lit(r"\p{L}"))
    return ~target & (letters >= least) & (F.regexp_count(col(c), F.lit(r"[a-zA-Z]")) > share * letters)


def content_flags(c: Column | str, patterns: dict[str, str]) -> Column:
    """Struct of booleans: whether each pattern occurs."""
    return F.struct(*(F.coalesce(col(c).rlike(p), F.lit(False)).alias(name) for name, p in patterns.items()))


# What marks poetry, narrations, quoted scripture and dialogue in a page of a book.
PAGE_FLAGS = {
    "has_poetry": r"\d+\s*-\s*[^\d]|ـ{2,}",
    "has_narration": r"قال رسول الله|صلى الله عليه وسلم|حدثنا|أخبرنا",
    "has_scripture": r"\{[^}]+\}|﴿[^﴾]+﴾|قال تعالى",
    "has_dialogue": r"قال:|قلت:|فقال:|قالوا:|قالت:",
}
# What marks a text that only refers to the chain of another.
CHAIN_PHRASES = r"بمثله|بنحوه|مثله|نحوه|بمثل ذلك|بنحو حديثهم|بنحو حديث|بهذا الإسناد"


def is_chain_variation(c: Column | str) -> Column:
    """Under 60 characters without diacritics, or under 200 with a phrase that refers to another text."""
    plain = strip_diacritics(c)
    return (F.length(plain) < 60) | ((F.length(plain) < 200) & plain.rlike(CHAIN_PHRASES))


def truncate_at_sentence(c: Column | str, most: int = 6000, share: float = 0.7) -> Column:
    """The first `most` characters, cut after their last full stop if that lies beyond `share` of them."""
    head = F.substring(col(c), 1, most)
    stop = F.greatest(*(F.when(F.instr(F.reverse(head), m) > 0, most - F.instr(F.reverse(head), m)).otherwise(-1) for m in (".", "۔")))
    return F.when(F.length(col(c)) <= most, col(c)).when(stop > share * most, F.substring(head, F.lit(1), stop + 1)).otherwise(head)


def joined_fields(*parts: Column, sep: str = " ") -> Column:
    """Parts that are neither null nor empty, joined."""
    return F.concat_ws(sep, *(F.when(p != "", p) for p in parts))


def token_estimate(c: Column | str, chars_per_token: int = 3) -> Column:
    return F.ceil(F.length(col(c)) / chars_per_token).cast("long")

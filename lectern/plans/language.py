"""Normalisers, stems, parsers of catalog fields, dictionary lines and narrations, over texts of the given tables.

Latin letters are written in Arabic ones, marks included, so that the script's rules have something to work on. Where a
parser takes composed lines, the SQL states from the columns what it must find.
"""

from __future__ import annotations

from lectern.functions import morphology, parsing, text
from lectern.operators import etl
from lectern.plans.registry import query, table
from lectern.plans.texts import _WORDS, _affix_sql, _root_sql, arabic_words
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LATIN = "abcdefghijklmnopqrstuvwxyzéèñäöüßç"
_ARABIC = "ابجدهوزحطيكلمنسعفصقرشتثخذضًَِأئةىء"
_AR = f"translate(lower(text), '{_LATIN}', '{_ARABIC}')"
_MARKS = r"[\x{064B}-\x{065F}\x{0670}]"
_NL = "chr(10)"


def _ar(c: str = "text") -> Column:
    return F.translate(F.lower(c), _LATIN, _ARABIC)


def _stripped(x: str) -> str:
    return f"regexp_replace({x}, '{_MARKS}', '', 'g')"


def _folded(x: str) -> str:
    return f"translate({x}, 'آأإٱىة', 'اااايه')"


def _trimmed(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _squeezed(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


_LEXICAL = _trimmed(_folded(_stripped("ar")))
_SEARCH = _squeezed(f"replace({_folded(_stripped('ar'))}, 'ء', '')")


@query(
    f"""WITH d AS (SELECT doc_id, {_AR} AS ar, translate(text, '0123456789', '٠١٢٣٤٥٦٧٨٩') AS digits FROM documents)
SELECT doc_id, md5({_LEXICAL}) AS lexical, md5({_trimmed(_folded("ar"))}) AS vocalized, regexp_matches(ar, '{_MARKS}') AS has_diacritics,
md5(translate(ar, 'ءآأؤإئٱ', 'ااااااا')) AS hamza_folded, md5(digits) AS arabic_digits,
nullif(regexp_extract(translate(digits, '٠١٢٣٤٥٦٧٨٩', '0123456789'), '(\\d+)', 1), '') AS first_number FROM d"""
)
def text_normalizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = text.to_arabic_digits("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text.normalize_lexical(_ar())).alias("lexical"),
        F.md5(text.normalize_vocalized(_ar())).alias("vocalized"),
        text.has_diacritics(_ar()).alias("has_diacritics"),
        F.md5(text.fold_hamza(_ar())).alias("hamza_folded"),
        F.md5(digits).alias("arabic_digits"),
        text.first_number(digits).alias("first_number"),
    )


def _listed(items: list[str]) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL))), ' ')"


def _imperfect_sql() -> str:
    items = []
    for p in morphology.IMPERFECT_PREFIXES:
        good = f"starts_with(word, '{p}') AND length(word) >= 4"
        items.append(f"CASE WHEN {good} THEN substr(word, 2) END")
        items += [f"CASE WHEN {good} AND ends_with(word, '{s}') AND length(word) - {1 + len(s)} >= 3 THEN substr(word, 2, length(word) - {1 + len(s)}) END" for s in morphology.IMPERFECT_SUFFIXES]
    return _listed(items)


def _weak_sql(r: str) -> str:
    second, body = f"substr({r}, 2, 1)", f"substr({r}, 1, length({r}) - 1)"
    with_middle = lambda letter: f"substr({r}, 1, 1) || '{letter}' || substr({r}, 3)"
    items = [r, f"CASE WHEN {second} = 'ا' THEN {with_middle('و')} END", f"CASE WHEN {second} = 'ا' THEN {with_middle('ي')} END"]
    items += [f"CASE WHEN {second} = 'ي' THEN {with_middle('و')} END", f"CASE WHEN {second} = 'و' THEN {with_middle('ي')} END"]
    items += [f"CASE WHEN ends_with({r}, 'ا') THEN {body} || '{x}' END" for x in "وي"] + [f"CASE WHEN ends_with({r}, 'ي') THEN {body} || 'و' END"]
    items += [f"CASE WHEN starts_with({r}, 'ا') THEN '{x}' || substr({r}, 2) END" for x in "وي"]
    return f"CASE WHEN length({r}) < 3 THEN {r} ELSE {_listed(items)} END"


@query(f"WITH w AS {_WORDS} SELECT word, {_imperfect_sql()} AS stems, {_weak_sql('word')} AS weak FROM w")
def affix_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda c: F.array_join(F.array_sort(c), " ")
    return arabic_words(spark, sf_dir).select("word", joined(morphology.imperfect_stems("word")).alias("stems"), joined(morphology.weak_roots("word")).alias("weak"))


_STOP = ["the", "and", "of", "ing", "der", "die", "und", "les", "des", "que", "los"]


@query(
    f"""WITH d AS (SELECT doc_id, source, lang, text, string_split_regex(lower(text), '\\s+') AS ws, substr(text, 1, 400) AS head FROM documents),
k AS (SELECT *, list_filter(ws, lambda w: w NOT IN ({", ".join(map(repr, _STOP))})) AS kept, CASE WHEN contains(head, '.') THEN 400 - instr(reverse(head), '.') ELSE -1 END AS stop FROM d)
SELECT doc_id, md5(CASE WHEN len(kept) < len(ws) * 0.2::DOUBLE THEN lower(text) ELSE array_to_string(kept, ' ') END) AS without_stop_words,
md5(CASE WHEN length(text) <= 400 THEN text WHEN stop > 280 THEN substr(head, 1, stop + 1) ELSE head END) AS truncated,
md5(concat_ws(' ', nullif(lang, ''), nullif(source, ''), nullif(text, ''))) AS joined FROM k"""
)
def prepared_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(parsing.remove_stop_words(F.lower("text"), _STOP)).alias("without_stop_words"),
        F.md5(text.truncate_at_sentence("text", 400)).alias("truncated"),
        F.md5(text.joined_fields(F.col("lang"), F.col("source"), F.col("text"))).alias("joined"),
    )


def _each_word(x: str, f: str) -> str:
    return f"md5(array_to_string(list_transform(string_split_regex({x}, '\\s+'), lambda w: {f}), ' '))"


def _stem_sql(prefixes: list[str], suffixes: list[str], least: int) -> str:
    return _affix_sql(f"({_affix_sql('w', prefixes, least, True)})", suffixes, least, False)


@query(
    f"""WITH d AS (SELECT doc_id, {_AR} AS ar, source FROM documents),
n AS (SELECT *, {_LEXICAL} AS lex, {_SEARCH} AS plain, {_stripped("ar")} AS bare FROM d)
SELECT doc_id, md5(plain) AS baseline, md5(bare) AS no_diacritics, md5(lex) AS lexical, {_each_word("lex", f"coalesce({_root_sql('w')}, w)")} AS roots,
{_each_word("lex", _stem_sql(morphology.PREFIXES, morphology.SUFFIXES, 3))} AS light_stem,
{_each_word("plain", _stem_sql(morphology.LIGHT10_PREFIXES, morphology.LIGHT10_SUFFIXES, 2))} AS light10_stem FROM n"""
)
def text_techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _ar().alias("ar"))
    return docs.select("doc_id", *(F.md5(f(F.col("ar"))).alias(name) for name, f in parsing.TECHNIQUES.items() if name != "first_sentences"))


_PLAIN = "regexp_replace(x, '<[^>]+>', '', 'g')"
for _entity, _char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")):
    _PLAIN = f"replace({_PLAIN}, '{_entity}', '{_char}')"


@query(
    f"""WITH b AS (SELECT page_id, html AS x FROM pages),
p AS (SELECT page_id, regexp_extract_all(x, '(?is)<p[^>]*>(.*?)</p>', 1) AS ps, string_split(x, chr(10)) AS ls FROM b),
u AS (SELECT page_id, 1 AS kind, unnest(ps) AS x, unnest(range(len(ps))) AS i FROM p UNION ALL SELECT page_id, 2, unnest(ls), unnest(range(len(ls))) FROM p),
t AS (SELECT page_id, kind, i, {_squeezed(_PLAIN)} AS x FROM u),
k AS (SELECT *, min(kind) OVER (PARTITION BY page_id) AS best FROM t WHERE length(x) >= 2 AND regexp_matches(x, '[A-Za-z]')),
g AS (SELECT page_id, count(*) AS n_paragraphs, min(i) AS first_index, md5(string_agg(x, '|' ORDER BY i)) AS paragraphs FROM k WHERE kind = best GROUP BY page_id)
SELECT b.page_id, coalesce(n_paragraphs, 0) AS n_paragraphs, first_index, coalesce(paragraphs, md5('')) AS paragraphs, md5({_squeezed(_PLAIN)}) AS one_line,
md5({_trimmed("regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '(?i)<br\\s*/?>|</p>|</div>', chr(10), 'g'), '<[^>]+>', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')")}) AS with_breaks
FROM b LEFT JOIN g USING (page_id)"""
)
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("p", text.paragraphs("html", "[A-Za-z]"))
    return pages.select(
        "page_id",
        F.size("p").cast("long").alias("n_paragraphs"),
        F.get("p.index", F.lit(0)).cast("long").alias("first_index"),
        F.md5(F.array_join("p.text", "|")).alias("paragraphs"),
        F.md5(text.inline_text("html")).alias("one_line"),
        F.md5(text.text_with_breaks("html")).alias("with_breaks"),
    )


@query(
    f"""WITH d AS (SELECT conv_id, turn, {_stripped(_AR)} AS ar FROM conversations)
SELECT conv_id, turn, length(ar) < 60 OR (length(ar) < 200 AND regexp_matches(ar, '{text.CHAIN_PHRASES}')) AS plain,
length(ar) + 6 < 60 OR length(ar) + 6 < 200 AS with_phrase FROM d"""
)
def chain_variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", text.is_chain_variation(_ar()).alias("plain"), text.is_chain_variation(F.concat(_ar(), F.lit(" بمثله"))).alias("with_phrase"))


#: Whole texts, after a phrase that one flag asks for in most of them.
_FLAG_TEXT = "CASE doc_id % 5 WHEN 0 THEN 'قال: ' WHEN 1 THEN '{آية} ' WHEN 2 THEN 'حدثنا ' ELSE '' END || coalesce(text, '')"


@query(f"WITH d AS (SELECT doc_id, {_FLAG_TEXT} AS t FROM documents) SELECT doc_id, {', '.join(f"regexp_matches(t, '{p}') AS {name}" for name, p in text.PAGE_FLAGS.items())} FROM d")
def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("t", F.expr(_FLAG_TEXT))
    return docs.select("doc_id", text.content_flags("t", text.PAGE_FLAGS).alias("f")).select("doc_id", "f.*")


# --- catalog fields -----------------------------------------------------------------------------------------------


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS editor, c_custkey % 3 = 0 AS is_verified, 'دار ' || c_mktsegment AS publisher,
CASE WHEN c_custkey % 2 = 0 THEN c_name END AS publisher_location, CAST(1300 + c_custkey % 140 AS VARCHAR) AS year_hijri, CAST(1900 + c_custkey % 120 AS VARCHAR) AS year_gregorian,
CASE WHEN c_custkey % 5 = 0 THEN 'ترقيم الكتاب موافق للمطبوع' END AS page_alignment_note,
CAST(100 + c_nationkey AS VARCHAR) AS author_birth_hijri, CAST(200 + c_custkey % 700 AS VARCHAR) AS author_death_hijri FROM customer"""
)
def info_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = text.to_arabic_digits((1300 + F.col("c_custkey") % 140).cast("string"))
    info = F.concat(
        F.lit("المؤلف: "), "c_name", F.lit(" ("), 100 + F.col("c_nationkey"), F.lit(" - "), 200 + F.col("c_custkey") % 700, F.lit("هـ)\n"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("المحقق: "), "c_mktsegment", F.lit("\n"))).otherwise(""),
        F.lit("الناشر: دار "), "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" - "), "c_name")).otherwise(""),
        F.lit("\nالطبعة: الأولى، "), year, F.lit(" هـ / "), 1900 + F.col("c_custkey") % 120, F.lit(" م\n"),
        F.when(F.col("c_custkey") % 5 == 0, "[ترقيم الكتاب موافق للمطبوع]").otherwise(""),
    )
    found = table(spark, sf_dir, "customer").select("c_custkey", parsing.info_block(info).alias("i")).select("c_custkey", "i.*")
    return found.drop("edition")


@query(
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS volume,
CASE p_size % 3 WHEN 0 THEN 'https://files.example.org/books/' || p_partkey || '.pdf' WHEN 1 THEN 'http://host/' || p_partkey || '.pdf' ELSE NULL END AS pdf,
'https://example.org/' || p_partkey || '/page/' || p_size AS page_url FROM part"""
)
def catalog_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(F.lit("المقدمة"), F.lit("2"), F.lit(" 3 الفهارس"))
    label = F.expr("CASE p_size % 4 WHEN 0 THEN 'المقدمة' WHEN 1 THEN '2' WHEN 2 THEN ' 3 الفهارس' ELSE 'غير معروف' END")
    root = F.expr("CASE p_size % 3 WHEN 0 THEN 'books' WHEN 1 THEN 'http://host/' END")
    files = F.array(F.concat("p_partkey", F.lit(".pdf|نسخة")))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        parsing.volume_number(label, labels).alias("volume"),
        parsing.pdf_url(root, files, F.lit(3), "https://files.example.org/").alias("pdf"),
        parsing.url("https://example.org/{book}/page/{page}", book=F.col("p_partkey"), page=F.col("p_size")).alias("page_url"),
    )


@query(
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'ur' WHEN 1 THEN 'fr' WHEN 2 THEN 'unknown' WHEN 3 THEN 'kl' ELSE 'he' END AS code, doc_id % 5 IN (0, 4) AS rtl,
'[' || doc_id || ', 2]' AS answer, '[' || doc_id || ', {"a": [1]}]' AS listed FROM documents"""
)
def languages_and_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr("CASE doc_id % 5 WHEN 0 THEN 'Urdu' WHEN 1 THEN 'Old Norse, French' WHEN 2 THEN '' WHEN 3 THEN ' Klingon' ELSE 'hebrew' END")
    fenced = F.concat(F.lit("```json\n["), "doc_id", F.lit(", 2]\n```"))
    talk = F.concat(F.lit("Here it is:\n["), "doc_id", F.lit(', {"a": [1]}]\nBest wishes'))
    docs = table(spark, sf_dir, "documents").withColumn("code", parsing.language_code(name))
    return docs.select("doc_id", "code", parsing.is_rtl("code").alias("rtl"), parsing.unfenced(fenced).alias("answer"), parsing.json_array_in(talk).alias("listed"))


# --- dictionaries -------------------------------------------------------------------------------------------------


def _letters_sql(x: str) -> str:
    return f"CASE WHEN length({x}) BETWEEN 3 AND 4 THEN {x} END"


@query(
    f"""WITH w AS {_WORDS}, b AS (SELECT word, {_affix_sql("word", morphology.ARTICLES, 3, True)} AS bare FROM w),
r AS (SELECT word, bare, coalesce({_root_sql("bare")}, {_root_sql("word")}) AS root FROM b)
SELECT word, CASE WHEN length(word) >= 2 THEN word END AS standard, word AS parens, CASE WHEN length(word) >= 3 THEN word END AS spaced, CASE WHEN length(word) BETWEEN 2 AND 3 THEN word END AS short_root,
word AS brackets, word AS leading_parens, word AS title_span, CASE WHEN length(word) >= 3 AND length(word) <= 60 THEN word END AS phrase, 'معنى' AS definition, word AS cleaned,
coalesce({_letters_sql("root")}, {_letters_sql("bare")}, '') AS guessed, coalesce({_letters_sql("word")}, '') AS told FROM r"""
)
def headwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("word")
    line = {
        "standard": F.concat(w, F.lit(": معنى")),
        "parens": F.concat(F.lit("("), w, F.lit("): معنى")),
        "spaced": F.concat(F.array_join(F.filter(F.split(w, ""), lambda x: x != ""), " "), F.lit(": معنى")),
        "short_root": F.concat(F.lit("  "), w, F.lit(" ")),
        "brackets": F.concat(F.lit("["), w, F.lit("] معنى")),
        "leading_parens": F.concat(F.lit("("), w, F.lit(") معنى")),
        "title_span": F.concat(F.lit('<span data-type="title"><b>'), w, F.lit("</b></span>")),
        "phrase": F.concat(w, F.lit(": معنى")),
    }
    return arabic_words(spark, sf_dir).select(
        "word",
        *(parsing.headword(c, style).alias(style) for style, c in line.items()),
        parsing.definition_after(F.concat(F.lit("("), w, F.lit(") معنى")), "leading_parens").substr(2, 4).alias("definition"),
        parsing.clean_headword(F.concat(F.lit("﴿(^1) و "), w, F.lit("﴾ (٢)"))).alias("cleaned"),
        parsing.headword_root(w).alias("guessed"),
        parsing.validated_root(F.concat(F.lit(" ال"), w)).alias("told"),
    )


@query(
    f"""WITH w AS {_WORDS}, e AS (SELECT length(word) % 7 AS k, length(word) + CASE WHEN length(word) % 7 = 4 THEN 4 ELSE 0 END > 40 AS long FROM w)
SELECT CASE WHEN long AND k >= 4 THEN 'headword_too_long' ELSE ['empty', 'page_zero', 'number_headword', 'footnote_as_headword', 'section_header', 'page_ref_only', 'ok'][k + 1] END AS reason, count(*) AS n FROM e GROUP BY ALL"""
)
def definition_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = arabic_words(spark, sf_dir).withColumn("k", F.length("word") % 7)
    head = F.expr("CASE k WHEN 2 THEN '١٢ - 3' WHEN 3 THEN concat(word, ' (^1)') WHEN 4 THEN concat('باب ', word) ELSE word END")
    definition = F.expr("CASE k WHEN 0 THEN ' ' WHEN 5 THEN '12, ١٣' ELSE concat('معنى ', word) END")
    faults = parsing.definition_faults(head, parsing.clean_definition(definition), F.expr("if(k = 1, 0, 7)"))
    return etl.reject_reasons(words, faults)


# --- narrations ---------------------------------------------------------------------------------------------------

#: A line of Arabic letters for each turn, without marks of any kind.
_LINE = f"trim(regexp_replace({_AR}, '[^ا-ي]+', ' ', 'g'))"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", F.trim(F.regexp_replace(_ar(), "[^ا-ي]+", " ")).alias("x"))


_TRANSMITTED = "حدثنا|أخبرنا|عن|سمعت|أنبأنا|حدثني|أخبرني|(ثنا|أنا)([^\\p{L}\\p{M}]|$)"


@query(
    f"""WITH d AS (SELECT conv_id, turn, {_LINE} AS x FROM conversations)
SELECT conv_id, turn, x AS main, '(١) ' || conv_id AS footnotes, x || chr(10) || chr(10) || 'تتمة' AS inline_main, '(١) حاشية' AS inline_notes, 'قبل ' || x || ' بعد' AS marked, x AS headed,
NOT regexp_matches(x, '{_TRANSMITTED}') AS body_only, true AS rebuilt, x = '' AS other, x AS heading, 'صلى الله عليه وسلم ' || x AS expanded FROM d"""
)
def narration_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, x = _lines(spark, sf_dir), F.col("x")
    split = parsing.split_footnotes(F.concat(x, F.lit("\n_________\n(١) "), "conv_id"))
    inline = parsing.remove_inline_footnotes(F.concat(x, F.lit("\n__________\n(١) حاشية\nتتمة")))
    return lines.select(
        "conv_id",
        "turn",
        split["main"].alias("main"),
        split["footnotes"].alias("footnotes"),
        inline["main"].alias("inline_main"),
        inline["footnotes"].alias("inline_notes"),
        parsing.strip_page_marks(parsing.strip_footnote_marks(F.concat(F.lit("قبل ⦗١٢⦘ "), x, F.lit("(^٣)  بعد")))).alias("marked"),
        parsing.strip_trailing_headings(F.concat(x, F.lit("\nباب في شيء\n\n"))).alias("headed"),
        parsing.is_body_only(x).alias("body_only"),
        parsing.reconstructs(F.split_part(x, F.lit(" "), F.lit(1)), F.regexp_replace(x, "^[^ ]*", " "), x).alias("rebuilt"),
        parsing.reconstructs(x, x, F.concat(x, F.lit(" "))).alias("other"),
        parsing.clean_book_heading(F.concat(F.lit("١٢ - "), x, F.lit(" بسم الله الرحمن الرحيم وبعد."))).alias("heading"),
        parsing.expand_ligatures(F.concat(F.lit("ﷺ "), x)).alias("expanded"),
    )


@query(
    f"""WITH d AS (SELECT conv_id, turn, {_LINE} AS x FROM conversations WHERE length({_LINE}) > 3)
SELECT conv_id, turn, 'حدثنا ' || conv_id AS chain, 'قال رسول الله ' || x AS body, true AS moved, x AS quoted_chain, x AS quoted_body, length(x) + 1 AS cut,
CASE WHEN length('حدثنا قال:') <= 0.7 * length('حدثنا قال: ' || x) THEN 'حدثنا' ELSE '' END AS said_chain FROM d"""
)
def narration_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, x = _lines(spark, sf_dir).filter("length(x) > 3"), F.col("x")
    moved = parsing.move_body_start(F.concat(F.lit("حدثنا "), "conv_id", F.lit("، قال رسول الله "), x), F.lit(""))
    quoted = parsing.split_quoted(F.concat(x, F.lit(' "'), x, F.lit('"')))
    said = parsing.split_quoted(F.concat(F.lit("«حدثنا قال: "), x, F.lit("»")), "guillemets")
    return lines.select(
        "conv_id",
        "turn",
        moved["chain"].alias("chain"),
        moved["body"].alias("body"),
        moved["moved"].alias("moved"),
        quoted["chain"].alias("quoted_chain"),
        quoted["body"].alias("quoted_body"),
        parsing.split_at(F.concat(x, F.lit(" قَالَ  شيئا")), F.lit("قال شيئا")).cast("long").alias("cut"),
        said["chain"].alias("said_chain"),
    )


_NUMBERED = f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag = 'R' AS heads, row_number() OVER w AS i FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
m AS (SELECT *, count(*) FILTER (NOT heads) OVER (PARTITION BY l_orderkey ORDER BY i) AS entry, last_value(CASE WHEN heads THEN 'باب ' || l_partkey END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY i) AS heading FROM l)"""


@query(
    _NUMBERED
    + """SELECT l_orderkey, entry, CAST(l_linenumber AS VARCHAR) AS number, 'حدثنا ' || l_partkey AS text, ((i - 1) // 3)::INTEGER AS page_start, (max(i - 1) OVER (PARTITION BY l_orderkey, entry) // 3)::INTEGER AS page_end, heading AS inner_heading FROM m QUALIFY NOT heads"""
)
def numbered_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order, three to a page: numbered narrations, and headings, which are numbered too."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"))).alias("ls"))
    line = lambda x: F.concat(text.to_arabic_digits(x["l_linenumber"].cast("string")), F.when(x["l_returnflag"] == "R", " - باب ").otherwise(" - حدثنا "), x["l_partkey"])
    paged = lines.select("l_orderkey", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.size("ls") - 1) / 3).cast("int")), lambda p: F.array_join(F.transform(F.slice("ls", p * 3 + 1, 3), line), "\n"))).alias("page", "t"))
    found = etl.segment_numbered(paged, ["l_orderkey"], "page", "t", r"([٠-٩]+)\s*-\s*", r"^\s*باب", parsing.CHAIN_START)
    return found.drop("outer_heading").withColumn("inner_heading", F.trim("inner_heading"))


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem)
SELECT l_orderkey, i - 1 AS place, CAST(l_linenumber AS VARCHAR) AS number, 'part ' || l_partkey AS body FROM l"""
)
def text_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("ls"))
    joined = F.concat(F.lit("preface "), F.array_join(F.transform("ls", lambda x: F.concat(F.lit("<"), x["l_linenumber"], F.lit("> part "), x["l_partkey"])), " "))
    each = lines.select("l_orderkey", F.posexplode(etl.segments_between(joined, r"<(\d+)>")).alias("place", "s"))
    return each.select("l_orderkey", F.col("place").cast("long").alias("place"), "s.number", "s.body")

"""Parsers of catalog fields, dictionary lines and narrations."""

import pytest
from lectern.functions import parsing as P
from lectern.operators import etl
from pyspark.sql import functions as F


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_info_block(spark):
    info = "المحقق: أحمد\nالناشر: دار الفكر - بيروت\nالطبعة: الأولى، ١٤٢٠ هـ - ١٩٩٩ م\nالمؤلف: فلان (٧٧٣ - ٨٥٢ هـ)\n[ترقيم الكتاب موافق للمطبوع]"
    got = value(spark, P.info_block(F.lit(info))).asDict()
    assert got == {
        "editor": "أحمد", "is_verified": True, "publisher": "دار الفكر", "publisher_location": "بيروت", "edition": "الأولى، ١٤٢٠ هـ - ١٩٩٩ م",
        "year_hijri": "1420", "year_gregorian": "1999", "page_alignment_note": "ترقيم الكتاب موافق للمطبوع", "author_birth_hijri": "773", "author_death_hijri": "852",
    }
    assert value(spark, P.info_block(F.lit("المؤلف: فلان (ت ٣٨٥ هـ)")))["author_death_hijri"] == "385"


def test_volumes_and_addresses(spark):
    labels = F.array(F.lit("المقدمة"), F.lit("1"), F.lit("الفهارس"))
    assert [value(spark, P.volume_number(F.lit(x), labels)) for x in ("المقدمة", "1", "الفهارس", "7", "?")] == [0, 1, 2, 7, 1]
    files = F.array(F.lit("a.pdf|x"), F.lit("b c.pdf"))
    assert value(spark, P.pdf_url(F.lit("http://h/r"), files, F.lit(0), "http://x/")) == "http://h/r/a.pdf"
    assert value(spark, P.pdf_url(F.lit("r"), files, F.lit(5), "http://x/")) == "http://x/r/b%20c.pdf"
    assert value(spark, P.url("/reader/{b}?pn={p}", b=F.lit("7"), p=F.lit(3))) == "/reader/7?pn=3"


@pytest.mark.parametrize(
    ("style", "line", "head"),
    [
        ("standard", "كتاب: شرح", "كتاب"), ("spaced", "ك ت ب: شرح", "كتب"), ("parens", "(كتب): شرح", "كتب"), ("short_root", " كَتَب ", "كَتَب"),
        ("short_root", "كتابة", None), ("brackets", "[كتاب] شرح", "كتاب"), ("leading_parens", "(كتب) شرح", "كتب"), ("spaced_line", "ك ت ب", "كتب"),
        ("title_span", '<span data-type="title">ك<b>تب</b></span> x', "كتب"), ("phrase", "عبد الله: شرح", "عبد الله"), ("standard", "plain: x", None),
    ],
)
def test_headwords(spark, style, line, head):
    assert value(spark, P.headword(F.lit(line), style)) == head


def test_dictionary_cleaning(spark):
    assert value(spark, P.clean_headword(F.lit("و كتاب (^٢٣)﴿"))) == "كتاب"
    assert value(spark, P.clean_definition(F.lit("شرح (12)"))) == "شرح"
    assert value(spark, P.headword_root(F.lit("الكتاب"))) == "كتب" and value(spark, P.headword_root(F.lit("في"))) == ""
    assert value(spark, P.validated_root(F.lit("الكتب"))) == "كتب" and value(spark, P.validated_root(F.lit("كاتبون"))) == ""
    df = spark.createDataFrame([("", "x", 1), ("كلمة", "شرح طويل", 0), ("كلمة", "12", 3), ("كلمة", "شرح طويل", 3)], "h string, d string, p int")
    got = {r["reason"]: r["n"] for r in etl.reject_reasons(df, P.definition_faults(F.col("h"), F.col("d"), F.col("p"))).collect()}
    assert got == {"empty": 1, "page_zero": 1, "page_ref_only": 1, "ok": 1}


def test_footnotes_and_headings(spark):
    got = value(spark, P.split_footnotes(F.lit("text\n_________\n(١) note")))
    assert (got["main"], got["footnotes"]) == ("text", "(١) note")
    inline = value(spark, P.remove_inline_footnotes(F.lit("a\n_________\n(١) note\nb\n_________\n(٢) more")))
    assert (inline["main"], inline["footnotes"]) == ("a\n\nb", "(١) note\n(٢) more")
    assert value(spark, P.strip_trailing_headings(F.lit("نص\nبَاب الصلاة\n\n"))) == "نص"
    assert value(spark, P.clean_book_heading(F.lit("٧ - كتاب الصلاة بِسْمِ اللَّهِ الرَّحْمَنِ الرَّحِيمِ."))) == "كتاب الصلاة"
    assert value(spark, P.strip_page_marks(F.lit("a ⦗٣٢⦘ b"))) == "a b"


def test_chain_and_body(spark):
    got = value(spark, P.move_body_start(F.lit("حدثنا فلان، عن فلان قَالَ: قَالَ رَسُولُ اللَّهِ"), F.lit("كذا")))
    assert got["moved"] and got["chain"].endswith("قَالَ") and got["body"] == "قَالَ رَسُولُ اللَّهِ كذا"
    quoted = value(spark, P.split_quoted(F.lit('عن فلان "القول" رواه')))
    assert (quoted["chain"], quoted["body"]) == ("عن فلان", "القول")
    inside = value(spark, P.split_quoted(F.lit("«عن فلان قال: سمعته يقول كلاما طويلا بعد ذلك»"), "guillemets"))
    assert (inside["chain"], inside["body"]) == ("عن فلان", "سمعته يقول كلاما طويلا بعد ذلك")
    assert value(spark, P.is_body_only(F.lit("كلام طيب"))) and not value(spark, P.is_body_only(F.lit("حدثنا فلان")))
    assert value(spark, P.reconstructs(F.lit("a  b"), F.lit("c"), F.lit(" a b c ")))
    assert value(spark, P.split_at(F.lit("حَدَّثَنا فلان ثم قَالَ كذا"), F.lit("قال كذا"))) == len("حَدَّثَنا فلان ثم ")
    assert value(spark, P.expand_ligatures(F.lit("ﷺ﵀"))) == "صلى الله عليه وسلم"


def test_languages_answers_and_embedding_texts(spark):
    assert value(spark, P.language_code(F.lit("Uighur, Uyghur"))) == "ug" and value(spark, P.language_code(F.lit("Klingon"))) == "kl"
    assert value(spark, P.is_rtl(F.lit("ur")))
    assert value(spark, P.json_array_in(F.lit('```json\n[{"a": 1}]\n```'))) == '[{"a": 1}]'
    assert value(spark, P.remove_stop_words(F.lit("a b c"), ["a"])) == "b c" and value(spark, P.remove_stop_words(F.lit("a a"), ["a"])) == "a a"
    assert value(spark, P.with_prefix(F.lit("S1:"), F.lit("مكتبة"))) == "S1: مكتبه"
    paragraphs = F.array(F.lit("first thing here"), F.lit("second words words"), F.lit("third"))
    assert value(spark, P.best_paragraph(F.lit("<mark>third</mark>"), paragraphs)) == 2
    assert value(spark, P.best_paragraph(F.lit("other words"), paragraphs)) == 1


def test_segments_of_numbered_pages(spark):
    pages = [
        (1, 1, "١ - كتاب الإيمان\nباب أول\n١ - حدثنا فلان\nتتمة (^١)\n_________\n(١) note"),
        (1, 2, "بقية\n٢ - أخبرنا آخر\nباب ثان\n٣ - عن ثالث"),
    ]
    df = spark.createDataFrame(pages, "book int, page int, text string")
    got = etl.segment_numbered(df, ["book"], "page", "text", r"([٠-٩]+)\s*-\s*", r"^(?:كتاب|باب|أبواب|ذكر|\[كتاب)", P.CHAIN_START).orderBy("entry").collect()
    assert [(r["number"], r["text"], r["page_start"], r["page_end"]) for r in got] == [("1", "حدثنا فلان\nتتمة \nبقية", 1, 2), ("2", "أخبرنا آخر", 2, 2), ("3", "عن ثالث", 2, 2)]
    assert [(r["outer_heading"], r["inner_heading"]) for r in got] == [("كتاب الإيمان", "باب أول"), ("كتاب الإيمان", "باب أول"), ("كتاب الإيمان", "باب ثان")]

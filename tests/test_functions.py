"""Text, morphology and hash functions."""

import hashlib

import pytest
from lectern.functions import hashing, text
from lectern.functions import morphology as M
from lectern.operators import lexicon
from pyspark.sql import functions as F


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_normalisers(spark):
    assert value(spark, text.normalize_search(F.lit(" إِسْلَام  شَيْء  مكتبة "))) == "اسلام شي مكتبه"
    assert value(spark, text.normalize_lexical(F.lit("شَيْء  ى"))) == "شيء  ي"
    assert value(spark, text.normalize_vocalized(F.lit("أَبة"))) == "اَبه"
    assert value(spark, text.has_diacritics(F.lit("أَب"))) and not value(spark, text.has_diacritics(F.lit("اب")))
    assert value(spark, text.to_western_digits(F.lit("سنة ١٢٣"))) == "سنة 123"
    assert value(spark, text.first_number(F.lit("بعد ٤٥٠ هـ"))) == "450"


def test_normalising_twice_changes_nothing(spark):
    samples = ["إِسْلَام", "  a  b ", "ىةء", "", "آ أ إ ٱ"]
    df = spark.createDataFrame([(s,) for s in samples], "t string").select(text.normalize_search("t").alias("a"))
    assert df.filter(~F.col("a").eqNullSafe(text.normalize_search("a"))).count() == 0


def test_html(spark):
    html = "<style>x</style><p>One&nbsp;&amp; two</p><div>three<br>four</div><script>no()</script>"
    assert value(spark, text.html_to_text(F.lit(html))) == "One & two\nthree\nfour"
    assert value(spark, text.paragraph_texts(F.lit("<p>a</p><p class='x'>two <b>words</b></p>"))) == ["two words"]


def test_paragraphs(spark):
    got = value(spark, text.paragraphs(F.lit("<p>12</p><p>نص أول</p>")))
    assert [(p["index"], p["text"]) for p in got] == [(1, "نص أول")]
    lines = value(spark, text.paragraphs(F.lit("سطر أول\n--\n<span data-type='title' id=1>عنوان\nطويل</span>\nسطر")))
    assert [(p["index"], p["text"]) for p in lines] == [(0, "سطر أول"), (2, "عنوان طويل"), (3, "سطر")]


def test_flags(spark):
    flags = value(spark, text.content_flags(F.lit("حدثنا فقال: {آية}"), text.PAGE_FLAGS))
    assert flags.asDict() == {"has_poetry": False, "has_narration": True, "has_scripture": True, "has_dialogue": True}
    assert value(spark, text.is_chain_variation(F.lit("قصير")))
    assert not value(spark, text.is_chain_variation(F.lit("ا" * 100)))


def test_truncate_and_joined(spark):
    assert value(spark, text.truncate_at_sentence(F.lit("aaaaaaaaa. bbb"), 12)) == "aaaaaaaaa."
    assert value(spark, text.truncate_at_sentence(F.lit("a. bbbbbbbbbbb"), 12)) == "a. bbbbbbbbb"
    assert value(spark, text.joined_fields(F.lit("a"), F.lit(""), F.lit(None).cast("string"), F.lit("b"))) == "a b"
    assert value(spark, text.wrong_language(F.lit("this is english"), False)) and not value(spark, text.wrong_language(F.lit("short"), False))
    assert value(spark, text.century(F.lit("450"))) == 5 and value(spark, text.century(F.lit("c. 450"))) is None


@pytest.mark.parametrize(
    ("word", "root"),
    [
        ("كتاب", "كتب"), ("كبير", "كبر"), ("كاتب", "كتب"), ("دروس", "درس"), ("أكبر", "كبر"), ("مكتب", "كتب"), ("تعلم", "علم"),
        ("إسلام", "سلم"), ("تعليم", "علم"), ("مكتوب", "كتب"), ("مفتاح", "فتح"), ("تعاون", "عون"), ("غفران", "غفر"), ("كتابة", "كتب"), ("مكتبة", "كتب"),
        ("حقيقة", "حقق"), ("ستخدم", "خدم"), ("يكتسب", "كسب"), ("ينكسر", "كسر"), ("يقاتل", "قتل"), ("مستخدم", "خدم"), ("يستقيم", "قيم"),
        ("انكسار", "كسر"), ("اجتهاد", "جهد"), ("مكتوبة", "كتب"), ("استخدم", "خدم"), ("تدحرجة", "دحرج"), ("استخدام", "خدم"), ("احميرار", "حمر"),
        ("استخدامة", "خدم"), ("كتب", "كتب"), ("من", None),
    ],
)
def test_roots_by_pattern(spark, word, root):
    assert value(spark, M.extract_root(F.lit(word))) == root


def test_affixes(spark):
    assert value(spark, M.strip_article(F.lit("والكتاب"))) == "كتاب"
    assert value(spark, M.light_stem(F.lit("والكاتبون"))) == "كاتب"
    assert value(spark, M.light10_stem(F.lit("الكتابها"))) == "كتاب"
    assert value(spark, M.imperfect_stems(F.lit("يكتبون"))) == ["كتبون", "كتب", "كتبو"]
    assert value(spark, M.weak_roots(F.lit("قال"))) == ["قال", "قول", "قيل"]
    assert value(spark, M.weak_roots(F.lit("قيم"))) == ["قيم", "قوم"]
    assert value(spark, M.apply_template(F.lit("كتب"), "است123")) == "استكتب"


def test_resolve_roots(spark):
    words = spark.createDataFrame([("الكتاب",), ("يستقيم",), ("كتب",), ("مجهوول",), ("تؤمنون",)], "word string")
    known = spark.createDataFrame([("كتب", "كتب"), ("كتاب", "كتب")], "word string, root string")
    roots = spark.createDataFrame([("كتب",), ("قوم",), ("امن",)], "root string")
    got = {(r["word"], r["root"]): (r["tier"], r["confidence"]) for r in lexicon.resolve_roots(words, known, roots).collect()}
    assert got[("الكتاب", "كتب")] == ("stripped", "high")
    assert got[("كتب", "كتب")] == ("direct", "high")
    assert got[("يستقيم", "قوم")] == ("verb_stem", "medium")
    assert got[("تؤمنون", "امن")] == ("verb_stem", "medium")


def test_lookup_tiers(spark):
    schema = "entry_id long, source string, headword string, root string, definition string"
    entries = spark.createDataFrame([(1, "s1", "كتاب", "كتب", "book"), (2, "s2", "كتب", "كتب", "write")], schema)
    subs = spark.createDataFrame([(3, "s1", "مكتب", "كتب", "desk")], schema)
    words = spark.createDataFrame([("الكتاب",), ("مكتب",), ("كاتب",)], "word string")
    resolved = spark.createDataFrame([("كاتب", "كتب")], "word string, root string")
    got = {(r["word"], r["entry_id"]): r["matched"] for r in lexicon.lookup(words, entries, subs, resolved).collect()}
    assert got == {("الكتاب", 1): "stripped", ("مكتب", 3): "exact", ("كاتب", 3): "root"}
    family = {r["entry_id"] for r in lexicon.root_family("كتب", entries, subs).collect()}
    assert family == {3, 2}
    assert lexicon.derived_forms(spark.createDataFrame([("كتب",)], "root string")).count() == len(lexicon.ALL_FORMS) == 40


def test_excerpt(spark):
    definition = "ا ب " * 20 + "تَحْرِير الكلام " + "ج د " * 100
    got = value(spark, lexicon.excerpt(F.lit(definition), F.lit("تحرير"), 100))
    assert got.startswith("...") and got.endswith("...") and "تَحْرِير" in got and len(got) < 120
    assert value(spark, lexicon.excerpt(F.lit("تحرير الكلام"), F.lit("تحرير"))) is None


def test_hashes(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert value(spark, hashing.verse_hash(F.lit(2), F.lit(255), F.lit("نص"))) == sha("ayah:2:255:نص")
    assert value(spark, hashing.page_hash(F.lit("7"), F.lit(3), F.lit(""))) == sha("page:7:3:")
    paragraphs = F.array(F.struct(F.lit(0).alias("index"), F.lit('a "b"').alias("translation")))
    expected = sha('page-translation:7:3:en:[{"index":0,"translation":"a \\"b\\""}]')
    assert value(spark, hashing.page_translation_hash(F.lit("7"), F.lit(3), F.lit("en"), paragraphs)) == expected
    assert value(spark, hashing.point_id(F.lit("a"), F.lit(1))) == hashlib.md5(b"a_1").hexdigest()

"""Dictionary lookup in tiers, roots of words, families of roots, derived forms."""

from __future__ import annotations

from lectern.functions import morphology as M
from lectern.functions.text import DIACRITICS, fold_hamza, has_diacritics, normalize_lexical, normalize_vocalized
from lectern.sources.store import table_path
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values: (name, part of speech, template); digits are the letters of the root.
VERB_FORMS = [
    ("Form I", "verb", "123"), ("Form II", "verb", "1223"), ("Form III", "verb", "1ا23"), ("Form IV", "verb", "ا123"), ("Form V", "verb", "ت1223"),
    ("Form VI", "verb", "ت1ا23"), ("Form VII", "verb", "ان123"), ("Form VIII", "verb", "ا1ت23"), ("Form IX", "verb", "ا1233"), ("Form X", "verb", "است123"),
]

NOUN_FORMS = [
    ("active participle", "noun", "1ا23"), ("passive participle", "noun", "م12و3"), ("verbal noun", "noun", "12ا3"), ("profession", "noun", "12ا3ه"),
    ("place noun", "noun", "م123"), ("place noun feminine", "noun", "م123ه"), ("Form II masdar", "noun", "ت12ي3"), ("intensive", "noun", "122ا3"),
    ("adjective", "noun", "12ي3"), ("plural", "noun", "12و3"), ("instrument", "noun", "م12ا3"), ("Form II active participle", "noun", "م1223"),
    ("Form X active participle", "noun", "مست123"), ("Form IV masdar", "noun", "ا12ا3"), ("Form VII masdar", "noun", "ان12ا3"),
    ("Form VIII masdar", "noun", "ا1ت2ا3"), ("Form X masdar", "noun", "است12ا3"), ("verbal noun in -an", "noun", "123ان"),
    ("feminine adjective", "noun", "12ي3ه"), ("feminine passive participle", "noun", "م12و3ه"), ("elative", "noun", "ا123"),
]
IMPERFECT_FORMS = [
    ("Form I imperfect", "verb", "ي123"), ("Form II imperfect", "verb", "ي1223"), ("Form III imperfect", "verb", "ي1ا23"),
    ("Form IV imperfect", "verb", "ي123"), ("Form V imperfect", "verb", "يت1223"), ("Form VI imperfect", "verb", "يت1ا23"),
    ("Form VII imperfect", "verb", "ين123"), ("Form VIII imperfect", "verb", "ي1ت23"), ("Form X imperfect", "verb", "يست123"),
]
ALL_FORMS = VERB_FORMS + NOUN_FORMS + IMPERFECT_FORMS


def _step(tier: str, confidence: str, mode: str, form: Column, condition: Column | None = None) -> Column:
    """A step that tries a form: as a known word, as what its own letters may stand for, by its pattern, or as a guess."""
    tried = form if condition is None else F.when(condition, form)
    return F.struct(F.lit(tier).alias("tier"), F.lit(confidence).alias("confidence"), F.lit(mode).alias("mode"), tried.alias("form"))


def _verb_steps(stems: Column, with_patterns: bool) -> Column:
    """Steps of each imperfect stem in turn: as a root if it has three letters, as a word, and as a pattern."""

    def steps(stem: Column) -> Column:
        found = [_step("verb_stem", "medium", "letters", stem, F.length(stem) == 3), _step("verb_stem", "medium", "word", stem)]
        return F.array(*found, *([_step("verb_stem", "medium", "pattern", stem)] if with_patterns else []))

    return F.flatten(F.transform(stems, steps))


def resolve_roots(words: DataFrame, word_roots: DataFrame, roots: DataFrame) -> DataFrame:
    """(word, root, confidence, tier) of words (word), by the first step that finds any root.

    word_roots (word, root) lists known words' roots; roots (root) is what counts as a root. The steps are those of a
    careful reader: the word itself, then without article, stemmed, as a verb, by its pattern, stemmed and by pattern;
    a carrier of hamza is tried as alef first. If none is known, the pattern's guess is given with low confidence.

    Steps name forms alone. All words' distinct forms are written, and each is read by its letters and by its pattern
    once, however many words and steps name it; then steps meet what their forms may be.
    """
    spark = words.sparkSession
    w = words.select("word").distinct()
    bare = fold_hamza(normalize_lexical("word"))
    w = w.select("word", normalize_lexical("word").alias("n"), bare.alias("h"), M.strip_article("word").alias("s"), M.light_stem("word").alias("m"), M.light_stem(bare).alias("hm"))
    n, h, s, m, hm = (F.col(c) for c in ("n", "h", "s", "m", "hm"))
    hamza, no_step = h != n, F.array().cast("array<struct<tier:string,confidence:string,mode:string,form:string>>")
    steps = F.concat(
        F.array(_step("direct", "high", "word", n), _step("stripped", "high", "word", s, s != n)),
        F.when(hamza, _verb_steps(M.imperfect_stems(h), False)).otherwise(no_step),
        F.array(_step("stemmed", "medium", "word", hm, hamza & (hm != n)), _step("stemmed", "medium", "word", m, (m != n) & (m != s))),
        _verb_steps(M.imperfect_stems(n), True),
        F.array(
            _step("pattern", "medium", "pattern", n),
            _step("pattern", "medium", "pattern", s),
            _step("pattern", "medium", "pattern", h, hamza),
            _step("stem_pattern", "low", "pattern", m, m != n),
            *(_step("pattern", "low", "guess", x) for x in (n, s, m)),
        ),
    )
    path = table_path(spark, "steps")
    w.select("word", F.posexplode(steps).alias("step", "s")).select("word", "step", "s.*").filter("form is not null").write.parquet(path)
    tried = spark.read.parquet(path)
    forms, known = tried.filter("mode <> 'word'").select("form").distinct(), roots.select(F.col("root").alias("candidate")).distinct()
    by_pattern = table_path(spark, "forms")
    forms.withColumn("root", M.extract_root("form")).write.parquet(by_pattern)
    read = spark.read.parquet(by_pattern)
    letters = tried.filter("mode = 'letters'").select("form").distinct().select("form", F.lit("letters").alias("mode"), F.explode(M.weak_roots("form")).alias("candidate"))
    patterns = read.filter("root is not null").select("form", F.lit("pattern").alias("mode"), F.explode(M.weak_roots("root")).alias("candidate"))
    held = letters.unionByName(patterns).join(known, "candidate", "left_semi").withColumnRenamed("candidate", "root")
    held = held.unionByName(word_roots.select(F.col("word").alias("form"), F.lit("word").alias("mode"), "root"))
    held = held.unionByName(read.filter("root is not null").select("form", F.lit("guess").alias("mode"), "root"))
    found = tried.join(held, ["form", "mode"]).select("word", "step", "tier", "confidence", "root")
    first = found.groupBy("word").agg(F.min("step").alias("step"))
    return found.join(first, ["word", "step"]).select("word", "root", "confidence", "tier").distinct()


def lookup(words: DataFrame, entries: DataFrame, sub_entries: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Tiered dictionary lookup of words (word): the best tier's matches, one for each source.

    entries (entry_id, source, headword, root, definition) and sub_entries, with parent_id, are matched vocalised (if
    the word has diacritics), then normalised, then without article, then by the word's roots (resolved: word, root).
    In a tier sub-entries come before entries. Of a source's matches a sub-entry wins, then the smaller id.
    """

    def prepared(df: DataFrame, kind: str, precision: int) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.lit(precision).alias("precision"), "entry_id", "source", "headword", normalize_lexical("root").alias("root"), "definition", normalize_lexical("headword").alias("plain"), normalize_vocalized("headword").alias("vocalized"))

    all_entries = prepared(sub_entries, "sub_entry", 0).unionByName(prepared(entries, "full", 1))
    w = words.select("word", normalize_lexical("word").alias("n"), normalize_vocalized("word").alias("v"), M.strip_article("word").alias("s"), has_diacritics("word").alias("d")).distinct()
    keys = F.array(
        F.struct(F.lit(0).alias("tier"), F.lit("vocalized").alias("how"), F.when(F.col("d"), F.col("v")).alias("key")),
        F.struct(F.lit(1).alias("tier"), F.lit("exact").alias("how"), F.col("n").alias("key")),
        F.struct(F.lit(2).alias("tier"), F.lit("stripped").alias("how"), F.when(F.col("s") != F.col("n"), F.col("s")).alias("key")),
    )
    tried = w.select("word", F.explode(keys).alias("k")).select("word", "k.*").filter("key is not null")
    if resolved is not None:
        tried = tried.unionByName(resolved.select("word", F.lit(3).alias("tier"), F.lit("root").alias("how"), F.col("root").alias("key")).distinct())
    by = F.when(F.col("how") == "stripped", "exact").otherwise(F.col("how"))
    ways = F.array(*(F.struct(F.lit(how).alias("by"), F.col(c).alias("key")) for how, c in (("vocalized", "vocalized"), ("exact", "plain"), ("root", "root"))))
    keyed = all_entries.withColumn("w", F.explode(ways)).select("kind", "precision", "entry_id", "source", "headword", "definition", F.col("w.by").alias("by"), F.col("w.key").alias("key"))
    hits = tried.withColumn("by", by).join(keyed, ["by", "key"]).drop("by")
    order = F.struct("tier", "precision")
    best = hits.withColumn("_best", F.min(order).over(Window.partitionBy("word"))).filter(order == F.col("_best"))
    one = Window.partitionBy("word", "source").orderBy("precision", "entry_id")
    return best.withColumn("_row", F.row_number().over(one)).filter("_row = 1").select("word", F.col("how").alias("matched"), "kind", "entry_id", "source", "headword", "definition")


def root_family(root: str, entries: DataFrame, sub_entries: DataFrame) -> DataFrame:
    """Sub-entries of a root, and full entries of those sources that have no sub-entry of it."""
    of = lambda df: df.filter(normalize_lexical("root") == root)
    subs = of(sub_entries).select("entry_id", "source", "headword", F.lit("sub_entry").alias("kind"))
    full = of(entries).join(subs.select("source").distinct(), "source", "left_anti")
    return subs.unionByName(full.select("entry_id", "source", "headword", F.lit("full").alias("kind")))


def derived_forms(roots: DataFrame, templates: list[tuple[str, str, str]] = ALL_FORMS) -> DataFrame:
    """(root, form, part_of_speech, word) of three-letter roots: every template of every root."""
    made = F.array(*(F.struct(F.lit(n).alias("form"), F.lit(p).alias("part_of_speech"), M.apply_template("root", t).alias("word")) for n, p, t in templates))
    return roots.filter(F.length("root") == 3).select("root", F.explode(made).alias("m")).select("root", "m.*")


def excerpt(definition: Column | str, word: Column | str, size: int = 300) -> Column:
    """About `size` characters of a definition around a word, its stem first, with diacritics tolerated.

    Null if nothing is found, or within the first 40 characters. Ends are moved to spaces within 30 characters.
    """
    text, optional = F.col(definition) if isinstance(definition, str) else definition, f"{DIACRITICS}*"
    pattern = lambda t: F.array_join(F.filter(F.split(t, ""), lambda x: x != ""), optional)
    terms = [M.light_stem(word), M.strip_article(word), normalize_lexical(word)]
    at = F.coalesce(*(F.nullif(F.when(F.length(t) >= 3, F.regexp_instr(text, pattern(t))), F.lit(0)) for t in terms)) - 1
    n, half = F.length(text), size // 2
    start, end = F.greatest(F.lit(0), at - half), F.least(n, at + half)
    space = F.locate(" ", F.substring(text, start + 1, F.lit(30)))
    start = F.when((start > 0) & (space > 0), start + space).otherwise(start)
    tail = F.locate(" ", F.reverse(F.substring(text, F.greatest(end - 28, F.lit(1)), F.least(end, F.lit(30)))))
    end = F.when((end < n) & (tail > 0), end + 1 - tail).otherwise(end)
    cut = F.concat(F.when(start > 0, "...").otherwise(""), F.substring(text, start + 1, end - start), F.when(end < n, "...").otherwise(""))
    return F.when(at >= 40, cut)

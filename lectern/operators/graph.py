"""Entity graph: nodes, edges and mentions as tables; one hop is a join."""

from __future__ import annotations

from lectern.functions.text import to_western_digits
from lectern.operators.index import Index
from lectern.operators.keyword import bm25_scores, top_k
from lectern.sources.store import delete_table, table_path
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The kinds of source that a reference may name.
SOURCE_TYPES = ["quran", "hadith", "tafsir", "book"]


def parse_sources(raw: Column | str) -> Column:
    """Array of (type, ref) of a JSON array in a string: known types with both fields; empty if it is not one."""
    text = F.col(raw) if isinstance(raw, str) else raw
    parsed = F.from_json(text, "array<struct<type:string,ref:string>>")
    return F.coalesce(F.filter(parsed, lambda s: s["type"].isin(SOURCE_TYPES) & s["ref"].isNotNull()), F.array().cast("array<struct<type:string,ref:string>>"))


def distinct_refs(sources: DataFrame, column: str = "sources") -> DataFrame:
    """(type, ref) of all rows, each once."""
    return sources.select(F.explode(column).alias("s")).select("s.*").distinct()


def verse_range(ref: Column | str) -> Column:
    """Struct (chapter, first, last) of a reference such as 28:7 or 28:36-37; null for others."""
    text = F.col(ref) if isinstance(ref, str) else ref
    m = lambda i: F.regexp_extract(text, r"^\s*(\d+)[^:]*:\s*(\d+)[^-:]*(?:-\s*(\d+)[^:]*)?$", i)
    last = F.when(m(3) != "", m(3)).otherwise(m(2))
    return F.when(m(1) != "", F.struct(m(1).cast("int").alias("chapter"), m(2).cast("int").alias("first"), last.cast("int").alias("last")))


def expand_ranges(refs: DataFrame, ref: str = "ref") -> DataFrame:
    """refs with a row for each verse: chapter, verse. References that are none, or run backwards, have no row."""
    r = refs.withColumn("_r", verse_range(ref)).filter("_r is not null and _r.first <= _r.last")
    return r.withColumn("verse", F.explode(F.sequence("_r.first", "_r.last"))).withColumn("chapter", F.col("_r.chapter")).drop("_r")


def verses_of_ranges(refs: DataFrame, verses: DataFrame, ref: str = "ref") -> DataFrame:
    """(ref, text, n_verses): the texts of each reference's verses (chapter, verse, text), in order."""
    found = expand_ranges(refs.select(ref).distinct(), ref).join(verses, ["chapter", "verse"])
    parts = F.array_sort(F.collect_list(F.struct("verse", "text")))
    return found.groupBy(ref).agg(parts.alias("p")).select(ref, F.array_join(F.col("p.text"), " ").alias("text"), F.size("p").alias("n_verses"))


def resolve_refs(refs: DataFrame, tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(type, ref, title) of refs (type, ref): each type meets its own table (table, key column, title column)."""
    out = None
    for kind, (table, key, title) in tables.items():
        right = table.select(F.col(key).cast("string").alias("ref"), F.col(title).cast("string").alias("title"))
        part = refs.filter(F.col("type") == kind).select("type", "ref").join(right, "ref", "left").select("type", "ref", "title")
        out = part if out is None else out.unionByName(part)
    return out


def edge_type(c: Column | str) -> Column:
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[^A-Za-z0-9_]", "_")


def one_hop(entities: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """entities (id, ...) with relationships: sorted array of (type, target_id, target_name, description), each once."""
    named = edges.join(nodes.select(F.col("id").alias("dst"), F.col("name").alias("target_name")), "dst")
    item = F.struct("type", F.col("dst").alias("target_id"), "target_name", F.coalesce("description", F.lit("")).alias("description"))
    gathered = named.join(entities.select(F.col("id").alias("src")), "src", "left_semi").groupBy(F.col("src").alias("id")).agg(F.array_sort(F.collect_set(item)).alias("relationships"))
    empty = F.array().cast("array<struct<type:string,target_id:string,target_name:string,description:string>>")
    return entities.join(gathered, "id", "left").withColumn("relationships", F.coalesce("relationships", empty))


def search_entities(nodes: DataFrame, names: list[str], queries: DataFrame, k: int = 5, least: float = 0.5) -> DataFrame:
    """(qid, id, score, rank): best entities by BM25 over each of their names, the best name counting."""
    out = None
    for name in names:
        found = bm25_scores(Index.build(nodes, "id", name), queries)
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("qid", F.col("doc_id").alias("id")).agg(F.max("score").alias("score")).filter(F.col("score") > least)
    return top_k(best, k, key="id")


def mentions_of(entities: DataFrame, mentions: DataFrame) -> DataFrame:
    """entities (id) with mentioned_in: sorted array of (group_id, role, context), each once."""
    item = F.struct("group_id", F.coalesce("role", F.lit("referenced")).alias("role"), F.coalesce("context", F.lit("")).alias("context"))
    return entities.join(mentions.groupBy("id").agg(F.array_sort(F.collect_set(item)).alias("mentioned_in")), "id", "left")


#: Letters of the grams by which a slug is looked for in others.
GRAM = 3


def _grams(s: Column, sizes: list[int]) -> Column:
    """Distinct substrings of so many letters."""

    def of_size(n: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substring(s, i, F.lit(n)))
        return F.when(F.length(s) >= n, cut).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*(of_size(n) for n in sizes)))


def containing(parts: DataFrame) -> DataFrame:
    """(a, b) of rows (id, prefix, slug) of which a's slug contains b's, under one prefix.

    A slug is looked for by the one of its grams that fewest others have: only those that hold it are searched. Work
    grows with the slugs' lengths and with what their rarest grams share. Slugs shorter than a gram are grams of their
    own length; an empty one is in all.
    """
    held = parts.select("id", "prefix", "slug", F.explode(F.array_union(F.array(F.lit("")), _grams(F.col("slug"), list(range(1, GRAM + 1))))).alias("gram"))
    spread = held.groupBy("prefix", "gram").agg(F.count("*").alias("n"))
    own = F.when(F.length("slug") >= GRAM, _grams(F.col("slug"), [GRAM])).otherwise(F.array("slug"))
    needles = parts.select("id", "prefix", "slug", F.explode(own).alias("gram")).join(spread, ["prefix", "gram"])
    needles = needles.groupBy("id", "prefix", "slug").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    needles = needles.select(F.col("id").alias("b"), "prefix", F.col("slug").alias("inner"), "gram")
    found = held.select(F.col("id").alias("a"), "prefix", F.col("slug").alias("outer"), "gram").join(needles, ["prefix", "gram"])
    return found.filter(F.col("a") != F.col("b")).filter(F.contains("outer", "inner")).select("a", "b")


def within_edits(parts: DataFrame, edits: int = 2) -> DataFrame:
    """(a, b), each twice, of rows (id, prefix, slug) whose slugs are within `edits` of one another, under one prefix.

    A slug is cut into edits + 1 segments: one of them stands unchanged in any slug so near, at most `edits` places from
    its own. Each slug thus has edits + 1 rows as one of the pair, and some dozens as the other, however long it is.
    """
    size, n = F.length("slug"), edits + 1

    def segment(length: Column, i: int) -> tuple[Column, Column]:
        """Where the i-th segment of a slug of some length begins, and its length: later ones take what is left over."""
        base, more = F.call_function("div", length, F.lit(n)), F.greatest(length % n - (n - i), F.lit(0))
        return (base * i + more).cast("int"), (base + (length % n >= n - i).cast("int")).cast("int")

    listed = []
    for i in range(n):
        start, long = segment(size, i)
        listed.append(F.struct(F.lit(i).alias("i"), F.substring("slug", start + 1, long).alias("text")))
    cut = parts.select(F.col("id").alias("a"), "prefix", F.col("slug").alias("_a"), size.alias("size"), F.explode(F.array(*listed)).alias("s")).select("a", "prefix", "_a", "size", "s.*")
    lengths = parts.select("id", "prefix", "slug", F.explode(F.sequence(F.greatest(size - edits, F.lit(0)), size)).alias("size"))
    tried = []
    for i in range(n):
        start, long = segment(F.col("size"), i)
        for shift in range(-edits, edits + 1):
            inside = (start + shift >= 0) & (start + shift + long <= size)
            tried.append(F.when(inside, F.struct(F.lit(i).alias("i"), F.substring("slug", start + shift + 1, long).alias("text"))))
    probes = lengths.select(F.col("id").alias("b"), "prefix", F.col("slug").alias("_b"), "size", F.explode(F.array_distinct(F.array_compact(F.array(*tried)))).alias("s")).select("b", "prefix", "_b", "size", "s.*")
    met = cut.join(probes, ["prefix", "size", "i", "text"]).filter(F.col("a") != F.col("b")).select("a", "b", "_a", "_b").distinct()
    near = met.filter(F.levenshtein("_a", "_b", edits) >= 0)
    return near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def near_duplicate_ids(ids: DataFrame, id_column: str = "id", edits: int = 2) -> DataFrame:
    """(a, b) of ids prefix:slug with one prefix whose slugs contain one another or are within `edits`.

    No prefix is paired with itself: slugs meet by segments and by rare grams, however many ids have a prefix.
    """
    parts = ids.select(F.col(id_column).alias("id"), F.split_part(id_column, F.lit(":"), F.lit(1)).alias("prefix"), F.split_part(id_column, F.lit(":"), F.lit(2)).alias("slug")).distinct()
    both = within_edits(parts, edits).unionByName(containing(parts))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def missing_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src, dst, type, missing): edges whose source or target is no node."""
    ids = nodes.select("id").distinct()
    lost = lambda side: edges.join(ids, F.col(side) == F.col("id"), "left_anti").withColumn("missing", F.lit(side))
    return lost("src").unionByName(lost("dst"))


def merge_entities(entities: DataFrame) -> DataFrame:
    """One row for each id: the first row's columns (by ordinal), and the union of all rows' sources."""
    sources = F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources"))))
    others = [c for c in entities.columns if c not in ("id", "sources", "ordinal")]
    return entities.groupBy("id").agg(*(F.min_by(c, "ordinal").alias(c) for c in others), sources.alias("sources"))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, n_out, n_in) of each node; loops count on both sides."""
    ends = edges.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    counted = ends.groupBy("id").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))
    return nodes.select("id").distinct().join(counted, "id", "left").select("id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_out", "n_in")))


def in_many_files(mentions: DataFrame, least: int = 3) -> DataFrame:
    """(id, n_files) of entities of mentions (id, file) that stand in `least` files or more."""
    return mentions.groupBy("id").agg(F.countDistinct("file").alias("n_files")).filter(F.col("n_files") >= least)


def _climbed(categories: DataFrame, paths: bool) -> DataFrame:
    """(id, up, n, path) of categories (id, parent_id, name): the ancestor that was reached, null above a root, how many
    levels lie below it, and, if asked for, their names.

    Each round doubles the levels that are climbed: a category goes on from where its ancestor has come. After as many
    rounds as the logarithm of their number only those in a cycle, or below one, have not reached a root. Rounds are
    written, as each reads the one before twice.
    """
    spark = categories.sparkSession
    known = categories.select(F.col("id").alias("_id")).distinct()
    path = F.col("name") if paths else F.lit(None).cast("string")
    state = categories.join(known, F.col("parent_id") == F.col("_id"), "left").select("id", F.col("_id").alias("up"), F.lit(1).cast("long").alias("n"), path.alias("path"))
    most, read = 1, None
    while True:
        out = table_path(spark, "climbed")
        state.write.parquet(out)
        if read:
            delete_table(spark, read)
        read, climbed = out, spark.read.parquet(out)
        left, rows = climbed.agg(F.count("up"), F.count("*")).first()
        if not left or most > rows:
            return climbed
        most *= 2
        upper = climbed.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("n").alias("_n"), F.col("path").alias("_path"))
        named = F.concat_ws(" / ", "_path", "path") if paths else F.col("path")
        higher = climbed.filter("up is not null").join(upper, F.col("up") == F.col("_id")).select("id", F.col("_up").alias("up"), (F.col("n") + F.col("_n")).alias("n"), named.alias("path"))
        state = climbed.filter("up is null").unionByName(higher)


def category_paths(categories: DataFrame, levels: int | None = None) -> DataFrame:
    """(id, depth, path) of categories (id, parent_id, name), as deep as they go: names from the root down; orphans are
    roots. Categories in a cycle or below one have no root and no row: category_cycles reports them. levels: only those
    of so many upper levels."""
    rooted = _climbed(categories, paths=False).filter("up is null").select(F.col("id").alias("_id"), F.col("n").alias("_n")).distinct()
    rooted = rooted if levels is None else rooted.filter(F.col("_n") <= levels)
    inside = categories.join(rooted, F.col("id") == F.col("_id"), "left_semi")
    found = _climbed(inside, paths=True)
    return found.select("id", (F.col("n") - 1).cast("int").alias("depth"), "path")


def category_cycles(categories: DataFrame) -> DataFrame:
    """(id, on_cycle) of categories that no root is above: those on a cycle, and those below one."""
    lost = _climbed(categories, paths=False).filter("up is not null")
    # A walk of more steps than there are categories ends on a cycle, and from its own categories on any of them.
    ends = lost.select(F.col("up").alias("_end"), F.lit(True).alias("_hit")).distinct()
    return lost.join(ends, F.col("id") == F.col("_end"), "left").select("id", F.coalesce("_hit", F.lit(False)).alias("on_cycle"))


def substitute_markers(texts: DataFrame, verses: DataFrame, key: str, text: str = "text") -> DataFrame:
    """texts with markers {{Q:chapter:verse}} or {{Q:chapter:a-b}} replaced by verses; unknown markers stay."""
    marks = texts.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\{\{Q:([0-9:\-]+)\}\}"), F.lit(1)))).alias("ref"))
    found = marks.join(verses_of_ranges(marks, verses.withColumnRenamed("text", "text")), "ref")
    pairs = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("{{Q:"), "ref", F.lit("}}")).alias("mark"), F.col("text").alias("quote")))).alias("_pairs"))
    joined = texts.join(pairs, key, "left")
    done = F.aggregate("_pairs", F.col(text), lambda acc, p: F.replace(acc, p["mark"], p["quote"]))
    return joined.withColumn(text, F.coalesce(done, text)).drop("_pairs")


def number_verses(counts: DataFrame) -> DataFrame:
    """(chapter, verses, offset): sequential number of a verse is offset + its number."""
    w = Window.orderBy("chapter").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum("verses").over(w), F.lit(0)))


def western_ref(c: Column | str) -> Column:
    return to_western_digits(c)

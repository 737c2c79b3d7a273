"""Loads, merges, graph steps and lookups over the star schema, through the library's operators."""

from __future__ import annotations

from lectern.functions.morphology import extract_root
from lectern.functions.parsing import best_paragraph
from lectern.operators import catalog, etl, fusion, graph, lexicon, rerank, search
from lectern.operators.query import edition_or_language, parse_range_list
from lectern.plans.registry import query, table
from lectern.plans.texts import _WORDS, _root_sql, arabic_words, rooted_words
from lectern.sources import readers, writers
from lectern.sources.store import table_path
from lectern.streaming import events as ev
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- loads --------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0")
def insert_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return etl.insert_new(orders.filter("o_orderkey % 3 = 0"), orders.filter("o_orderkey % 2 = 0"), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 = 0 AND o_orderstatus <> 'X'")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = orders.withColumn("o_orderstatus", F.expr("if(o_orderkey % 5 = 0, 'X', o_orderstatus)"))
    return etl.changed_only(orders, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("SELECT o_orderstatus, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_orderkey END) AS BIGINT) AS keys FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0 GROUP BY o_orderstatus")
def replaced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions are written, one of them is replaced by half of its rows, with keys of 0, and all are read again."""
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), table_path(spark, "orders")
    writers.replace_partitions(orders, path, ["o_orderstatus"])
    half = orders.filter("o_orderstatus = 'F' and o_orderkey % 2 = 0").withColumn("o_orderkey", F.lit(0).cast("long"))
    writers.replace_partitions(half, path, ["o_orderstatus"])
    return readers.read_table(spark, path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def appended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "events"), table_path(spark, "events")
    ev.appended(rows.filter("event_id % 2 = 0"), path)
    ev.appended(rows.filter("event_id % 2 = 1"), path)
    return readers.read_table(spark, path, ["event_type"]).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def text_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tab-separated text, as a SQL dump and as JSON documents, written, read, and joined by key."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("nation"))
    tsv, dump, docs = (table_path(spark, n) for n in ("tsv", "dump", "json"))
    rows.select("c_custkey", "c_name").write.csv(tsv, sep="\t", header=True, quote="")
    value = F.concat(F.lit("INSERT INTO `customer` VALUES ("), "c_custkey", F.lit(",'"), F.replace("c_name", F.lit("'"), F.lit("''")), F.lit("');"))
    rows.select(value.alias("value")).write.text(dump)
    rows.select("c_custkey", "nation").write.json(docs)
    named = readers.read_tsv(spark, tsv).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name")
    dumped = readers.read_sql_dump(spark, dump, "customer", ["k", "n"]).select(F.col("k").cast("long").alias("c_custkey"), F.col("n").alias("c_name"))
    nations = spark.read.schema("c_custkey long, nation string").json(docs)
    return named.join(dumped, ["c_custkey", "c_name"]).join(nations, "c_custkey")


@query(
    """SELECT i.item_id AS qid, count(*) AS n_relevant, CAST(sum(d.doc_id) AS BIGINT) AS relevant FROM benchmark i JOIN documents d ON d.doc_id % 40 = i.item_id GROUP BY i.item_id"""
)
def gold_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold queries written as JSON lines, ids or objects by turns, and read again."""
    docs, path = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 40).alias("item_id")), table_path(spark, "gold")
    gold = docs.groupBy("item_id").agg(F.collect_list(F.col("doc_id").cast("string")).alias("ids")).join(table(spark, sf_dir, "benchmark").select("item_id"), "item_id")
    listed = F.when(F.col("item_id") % 2 == 0, F.to_json("ids")).otherwise(F.to_json(F.transform("ids", lambda i: F.struct(i.alias("id")))))
    line = F.concat(F.lit('{"query": "'), "item_id", F.lit('", "relevant": '), listed, F.lit("}"))
    gold.select(line.alias("value")).write.text(path)
    each = readers.read_gold_queries(spark, path).select(F.col("query").cast("long").alias("qid"), F.explode("relevant").alias("doc"))
    return each.groupBy("qid").agg(F.count("*").alias("n_relevant"), F.sum(F.col("doc").cast("long")).alias("relevant"))


@query("SELECT count(*) AS n FROM documents WHERE lang IN ('en', 'fr') AND n_chars > 500")
def filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readers.read_table(spark, f"{sf_dir}/documents.parquet", ["doc_id"], "lang in ('en', 'fr') and n_chars > 500")
    return found.agg(F.count("*").alias("n"))


@query("SELECT p_brand, count(*) AS n, CAST(min(p_partkey) AS BIGINT) AS first_part FROM part WHERE p_size > 20 AND p_type LIKE '%BRASS' OR p_size > 20 AND p_type LIKE 'ECONOMY%' GROUP BY p_brand")
def named_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("lectern_part")
    sql = "SELECT p_brand, count(*) AS n, min(p_partkey) AS first_part FROM lectern_part WHERE p_size > :least AND (p_type LIKE :a OR p_type LIKE :b) GROUP BY p_brand"
    return readers.query(spark, sql, least=20, a="%BRASS", b="ECONOMY%")


# --- filters, pages, joins ----------------------------------------------------------------------------------------


@query(
    """SELECT p_partkey, p_size, p_type FROM part WHERE p_size IN (3, 14) AND p_type NOT LIKE '%STEEL' AND list_contains(string_split(p_name, ' '), 'ring')
AND ((p_brand = 'Brand#1' AND p_size = 3) OR (p_brand = 'Brand#2' AND p_size = 14) OR (p_brand = 'Brand#4' AND p_size = 14))"""
)
def catalog_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of sizes with what lies out of range left out, an element of an array, a negated flag, and pairs of keys."""
    parts = table(spark, sf_dir, "part").withColumn("names", F.split("p_name", " ")).withColumn("steel", F.col("p_type").endswith("STEEL"))
    sizes = parse_range_list("3, 99,x, 14,0", 1, 50)
    pairs = spark.createDataFrame([("Brand#1", 3), ("Brand#2", 14), ("Brand#4", 14)], "p_brand string, p_size int")
    where = catalog.all_of(F.col("p_size").isin(sizes), F.array_contains("names", "ring"), ~F.col("steel"))
    return catalog.keys_in(parts.filter(where), pairs, ["p_brand", "p_size"]).select("p_partkey", "p_size", "p_type")


@query("SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS total FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50")
def page_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_totalprice")
    return catalog.page_with_total(urgent, [F.col("o_totalprice").desc(), "o_orderkey"], 25, 50)


@query("SELECT c_custkey AS id, c_name AS name, count(o_orderkey) AS n_books FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE contains(lower(c_name), '#00000001') GROUP BY 1, 2 ORDER BY n_books DESC, id LIMIT 15")
def authors_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    authors = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    books = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("author_id"))
    return search.authors_by_name(authors, books, "#00000001", 15)


@query("SELECT c_custkey AS doc_id, CASE WHEN c_custkey = 12 THEN 110.0 ELSE 10.0 END::DOUBLE AS score FROM customer WHERE starts_with(CAST(c_custkey AS VARCHAR), '12')")
def ids_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.operators.keyword import id_search

    return id_search(table(spark, sf_dir, "customer"), "c_custkey", "12").withColumn("score", F.col("score").cast("double"))


@query(
    """WITH t AS (SELECT l_partkey AS k, l_linenumber AS e, 'line ' || max(l_orderkey) AS text FROM lineitem GROUP BY 1, 2),
b AS (SELECT k, max(e) AS e FROM t GROUP BY k)
SELECT p_partkey AS k, t.text AS translation, t.e AS translation_edition, o.text AS of_edition FROM part LEFT JOIN b ON b.k = p_partkey LEFT JOIN t ON t.k = b.k AND t.e = b.e LEFT JOIN t AS o ON o.k = p_partkey AND o.e = 2"""
)
def translations_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last edition's translation of a language, and that of one edition: a selector with a hyphen names one."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k"), F.col("l_linenumber").alias("number"))
    told = lines.agg(F.concat(F.lit("line "), F.max("l_orderkey")).alias("text"))
    told = told.select("k", "text", F.concat(F.lit("en-"), "number").alias("edition"), F.lit("en").alias("language"))
    results = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    last = search.with_translations(results, told, ["k"], **edition_or_language("en"))
    one = search.with_translations(results, told, ["k"], **edition_or_language("en-2")).select("k", F.col("translation").alias("of_edition"))
    return last.join(one, "k").withColumn("translation_edition", F.substring("translation_edition", 4, 9).cast("int"))


@query("SELECT c_custkey, c_name, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2")
def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's current order, found again by a key that stays."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    return catalog.last_wins(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), orders, ["c_custkey"], "at", ["last_order"])


@query(
    """SELECT p_partkey, concat_ws(',', CASE WHEN p_size > 45 THEN 'large' END, CASE WHEN p_type LIKE '%STEEL' THEN 'steel' END, CASE WHEN p_retailprice > 1500 THEN 'dear' END) AS errors FROM part"""
)
def row_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"large": F.col("p_size") > 45, "steel": F.col("p_type").endswith("STEEL"), "dear": F.col("p_retailprice") > 1500}
    return etl.validated(table(spark, sf_dir, "part"), rules).select("p_partkey", F.array_join("errors", ",").alias("errors"))


# --- groups and windows -------------------------------------------------------------------------------------------


@query(
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS f, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS l,
row_number() OVER (PARTITION BY o_custkey ORDER BY length(o_orderpriority) DESC, o_orderkey) AS s FROM orders)
SELECT o_custkey, max(o_orderkey) FILTER (f = 1) AS first_key, max(o_orderkey) FILTER (l = 1) AS latest_key, max(o_orderkey) FILTER (s = 1) AS longest_key FROM r GROUP BY o_custkey"""
)
def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    pick = lambda df, name: df.select("o_custkey", F.col("o_orderkey").alias(name))
    first, latest = pick(etl.first_wins(orders, ["o_custkey"], "o_orderkey"), "first_key"), pick(etl.latest_wins(orders, ["o_custkey"], "o_orderkey"), "latest_key")
    longest = pick(etl.longest_wins(orders, ["o_custkey"], "o_orderpriority", "o_orderkey"), "longest_key")
    return first.join(latest, "o_custkey").join(longest, "o_custkey")


@query('SELECT r_regionkey AS chapter, count(*) AS verses, CAST(coalesce(sum(count(*)) OVER (ORDER BY r_regionkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey')
def verse_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("chapter")).agg(F.count("*").alias("verses"))
    return graph.number_verses(counts)


@query(
    """WITH b AS (SELECT l_orderkey AS line, l_linenumber AS word, l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT l_orderkey, l_linenumber, -l_partkey FROM lineitem WHERE l_returnflag <> 'R')
SELECT line, word, k, row_number() OVER (PARTITION BY line ORDER BY word, k) AS position FROM b"""
)
def renumbered_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    word = lambda where, sign: rows.filter(where).select(F.col("l_orderkey").alias("line"), F.col("l_linenumber").alias("word"), (sign * F.col("l_partkey")).alias("k"))
    return etl.renumber(word("l_returnflag = 'R'", 1), word("l_returnflag <> 'R'", -1), ["line"], ["word", "k"])


@query(
    """WITH s AS (SELECT user_id, min(epoch_us(ts)) AS start FROM events GROUP BY user_id)
SELECT e.user_id, count(*) AS words, CAST(sum(epoch_us(e.ts) - s.start) AS BIGINT) AS starts, CAST(sum(e.event_id - 1) AS BIGINT) AS places FROM events e JOIN s USING (user_id) GROUP BY e.user_id"""
)
def relative_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as timed words of one recording: words from 0, times from its start."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = table(spark, sf_dir, "events").select("user_id", F.struct(F.col("event_id").alias("word"), at.alias("start"), (at + 5).alias("end")).alias("s"))
    verses = rows.groupBy("user_id").agg(F.collect_list("s").alias("segments"), F.min("s.start").alias("start"))
    timed = verses.select("user_id", F.explode(etl.relative_timing(F.col("segments"), F.col("start"))).alias("s"))
    return timed.groupBy("user_id").agg(F.count("*").alias("words"), F.sum("s.start").alias("starts"), F.sum("s.word").alias("places"))


# --- graph --------------------------------------------------------------------------------------------------------

_EDGES = "SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem WHERE l_quantity > 45"
_NODES = "SELECT 's' || s_suppkey AS id FROM supplier UNION ALL SELECT 'p' || p_partkey FROM part"


@query(f"WITH e AS ({_EDGES}), n AS ({_NODES}) SELECT id, (SELECT count(*) FROM e WHERE src = id) AS n_out, (SELECT count(*) FROM e WHERE dst = id) AS n_in FROM n")
def node_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst")).distinct()
    nodes = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id")).unionByName(table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id")))
    out = graph.degrees(nodes, edges)
    return out.select("id", F.col("n_out").cast("long").alias("n_out"), F.col("n_in").cast("long").alias("n_in"))


@query("SELECT l_partkey AS id, count(DISTINCT l_suppkey % 7) AS n_files FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey % 7) >= 5")
def entities_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.in_many_files(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), (F.col("l_suppkey") % 7).alias("file")), 5)


@query(
    """WITH r AS (SELECT l_partkey AS id, min_by(l_shipdate, (l_orderkey, l_linenumber, l_suppkey)) AS first_date FROM lineitem GROUP BY 1)
SELECT id, first_date, (SELECT array_to_string(list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR))), ',') FROM lineitem WHERE l_partkey = id) AS sources FROM r"""
)
def merged_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_shipdate").alias("first_date"), F.array(F.col("l_suppkey").cast("string")).alias("sources"), F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("ordinal"))
    return graph.merge_entities(rows).select("id", "first_date", F.array_join("sources", ",").alias("sources"))


@query(
    """WITH m AS (SELECT DISTINCT l_partkey AS id, CAST(l_suppkey AS VARCHAR) || ':' || coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, 'referenced') AS x FROM lineitem)
SELECT p_partkey AS id, (SELECT array_to_string(list_sort(list(x)), ',') FROM m WHERE m.id = p_partkey) AS mentioned_in FROM part"""
)
def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_suppkey").cast("string").alias("group_id"), F.expr("if(l_returnflag <> 'N', l_returnflag, null)").alias("role"), F.lit(None).cast("string").alias("context"))
    found = graph.mentions_of(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")), mentions)
    return found.select("id", F.array_join(F.array_sort(F.transform("mentioned_in", lambda m: F.concat(m["group_id"], F.lit(":"), m["role"]))), ",").alias("mentioned_in"))


_VERSES = "SELECT l_orderkey AS chapter, l_linenumber AS verse, string_agg('w' || l_partkey, ' ' ORDER BY l_partkey) AS text FROM lineitem GROUP BY 1, 2"


def _verses(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.transform(F.array_sort(F.collect_list("l_partkey")), lambda p: F.concat(F.lit("w"), p))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("int").alias("chapter"), F.col("l_linenumber").alias("verse")).agg(F.array_join(words, " ").alias("text"))


@query(
    f"""WITH v AS ({_VERSES}), q AS (SELECT o_orderkey, string_agg(text, ' ' ORDER BY verse) AS quote, count(*) AS n FROM orders JOIN v ON chapter = o_orderkey AND verse BETWEEN 2 AND 3 GROUP BY o_orderkey)
SELECT o_orderkey, 'see ' || coalesce(quote, '{{{{Q:' || o_orderkey || ':2-3}}}}') || ' and {{{{Q:x}}}}' AS text FROM orders LEFT JOIN q USING (o_orderkey)"""
)
def marked_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("see {{Q:"), "o_orderkey", F.lit(":2-3}} and {{Q:x}}")).alias("text"))
    return graph.substitute_markers(texts, _verses(spark, sf_dir), "o_orderkey")


@query(f"WITH v AS ({_VERSES}) SELECT o_orderkey || ':1-4' AS ref, string_agg(text, ' ' ORDER BY verse) AS text, CAST(count(*) AS INTEGER) AS n_verses FROM orders JOIN v ON chapter = o_orderkey AND verse BETWEEN 1 AND 4 GROUP BY 1")
def quoted_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "orders").select(F.concat("o_orderkey", F.lit(":1-4")).alias("ref"))
    return graph.verses_of_ranges(refs, _verses(spark, sf_dir))


@query("SELECT DISTINCT ['quran', 'book', 'hadith'][CAST(l_suppkey % 4 AS INTEGER) + 1] AS type, l_partkey || ':1' AS ref FROM lineitem WHERE l_suppkey % 4 <> 3")
def parsed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*(F.lit(x) for x in ("quran", "book", "hadith", "film"))), (F.col("l_suppkey") % 4 + 1).cast("int"))
    raw = F.to_json(F.array(F.struct(kind.alias("type"), F.concat("l_partkey", F.lit(":1")).alias("ref")), F.struct(F.lit("quran").alias("type"), F.lit(None).cast("string").alias("ref"))))
    return graph.distinct_refs(table(spark, sf_dir, "lineitem").select(graph.parse_sources(raw).alias("sources")))


# --- results ------------------------------------------------------------------------------------------------------


@query("SELECT CAST(c_custkey AS INTEGER) AS chapter, c_nationkey AS verse, round(CASE WHEN c_nationkey BETWEEN 3 AND 5 THEN least(1.0, c_custkey % 100 / 100.0 + 0.05) ELSE c_custkey % 100 / 100.0 END::DOUBLE, 6) AS score, c_nationkey BETWEEN 3 AND 5 AS confirmed FROM customer")
def boosted_by_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("chapter"), F.col("c_nationkey").alias("verse"), (F.col("c_custkey") % 100 / 100.0).alias("score"))
    refs = table(spark, sf_dir, "customer").select(F.concat("c_custkey", F.lit(":3-5")).alias("ref"))
    return search.graph_boosted(rows, refs, ["chapter", "verse"], apply=True).withColumn("score", F.round("score", 6))


_RESULTS = """o AS (SELECT o_orderkey AS k, round(o_totalprice / 1e6, 9) AS score FROM orders ORDER BY score DESC, k LIMIT 20),
p AS (SELECT p_partkey AS k, round(p_retailprice / 1e4, 9) AS score FROM part ORDER BY score DESC, k LIMIT 20)"""


def _results(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    best = lambda t, key, value: table(spark, sf_dir, t).select(F.col(key).alias("doc_key"), F.round(value, 9).alias("score")).orderBy(F.col("score").desc(), "doc_key").limit(20)
    return {"order": best("orders", "o_orderkey", F.col("o_totalprice") / 1e6), "page": best("part", "p_partkey", F.col("p_retailprice") / 1e4)}


@query(
    f"""WITH {_RESULTS}, u AS (SELECT 'order' AS type, CAST(k AS VARCHAR) AS doc_key, score FROM o UNION ALL SELECT 'page', CAST(k AS VARCHAR), score FROM p)
SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY score DESC, doc_key) AS INTEGER) AS rank FROM u QUALIFY type <> 'page' OR rank <= 5"""
)
def unified_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank.unified(_results(spark, sf_dir), None, {"page": 5})


@query(
    f"""WITH {_RESULTS}, u AS (SELECT 'order' AS type, CAST(k AS VARCHAR) AS doc_key, score FROM o UNION ALL SELECT 'page', CAST(k AS VARCHAR), score FROM p)
SELECT *, CAST(row_number() OVER (ORDER BY score DESC, type, doc_key) AS INTEGER) AS rank FROM u ORDER BY score DESC, type, doc_key LIMIT 5"""
)
def top_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank.top_breakdown(_results(spark, sf_dir))


@query(
    """WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents ORDER BY n_chars DESC, doc_id LIMIT 30)
SELECT doc_id, CAST(rank AS INTEGER) AS old_rank, CAST(CASE rank WHEN 7 THEN 1 WHEN 2 THEN 2 WHEN 30 THEN 3 WHEN 1 THEN 4 ELSE rank + CASE WHEN rank < 7 THEN 2 ELSE 1 END END AS INTEGER) AS rank FROM d WHERE rank IN (7, 2, 30, 1) OR rank < 7 OR rank + 1 <= 12"""
)
def reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest documents in the order that a model's answer gives; what it leaves out follows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text").orderBy(F.col("n_chars").desc(), "doc_id").limit(30)
    listed = rerank.ranked(docs, [F.col("n_chars").desc(), "doc_id"])
    found = rerank.rerank(listed, "which is best?", lambda df: F.substring("text", 1, 50), lambda q, texts: rerank.parse_ranking("Best: [7, 2, 99, 30, 7, 1]", len(texts)), 12)
    return found.select("doc_id", "old_rank", "rank")


@query(
    """WITH p AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS x FROM documents WHERE text IS NOT NULL),
q AS (SELECT doc_id, i, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS x FROM p), m AS (SELECT doc_id, max(i) AS last FROM q GROUP BY doc_id),
s AS (SELECT q.doc_id, q.x AS clean FROM q JOIN m ON m.doc_id = q.doc_id AND i = last)
SELECT doc_id, CAST(min(i) AS INTEGER) AS best FROM q JOIN s USING (doc_id) WHERE contains(x, clean) OR contains(clean, x) GROUP BY doc_id"""
)
def best_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paragraph of a document that its last line stands in, marked up."""
    docs = table(spark, sf_dir, "documents").filter("text is not null").withColumn("ps", F.split("text", "\n"))
    snippet = F.concat(F.lit("<mark>"), F.element_at("ps", -1), F.lit("</mark>"))
    return docs.select("doc_id", best_paragraph(snippet, F.col("ps")).alias("best"))


@query(
    """WITH m AS (SELECT d.doc_id, row_number() OVER (ORDER BY n_chars DESC, d.doc_id) AS semantic_rank FROM documents d QUALIFY semantic_rank <= 40),
k AS (SELECT doc_id, row_number() OVER (ORDER BY length(source) DESC, doc_id DESC) AS keyword_rank FROM documents QUALIFY keyword_rank <= 40),
j AS (SELECT coalesce(m.doc_id, k.doc_id) AS doc_id, semantic_rank, keyword_rank, 1.0::DOUBLE / semantic_rank AS s, 10.0::DOUBLE / keyword_rank AS b FROM m FULL JOIN k ON m.doc_id = k.doc_id),
f AS (SELECT doc_id, CASE WHEN s IS NOT NULL AND b IS NOT NULL THEN 0.4 * s + 0.7 * b / (b + 3) WHEN s IS NOT NULL THEN s ELSE b / (b + 3) END AS fused, coalesce(1.0::DOUBLE / (60 + semantic_rank), 0) + coalesce(1.0::DOUBLE / (60 + keyword_rank), 0) AS rrf FROM j)
SELECT doc_id, round(fused, 6) AS fused_score, round(rrf, 6) AS rrf_score, CAST(row_number() OVER (ORDER BY fused DESC, rrf DESC, doc_id) AS INTEGER) AS rank FROM f QUALIFY rank <= 20"""
)
def merged_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    first = docs.orderBy(F.col("n_chars").desc(), "doc_id").limit(40)
    semantic = rerank.ranked(first, [F.col("n_chars").desc(), "doc_id"], rank="semantic_rank").select("doc_id", "semantic_rank", (1.0 / F.col("semantic_rank")).alias("semantic_score"))
    last = docs.orderBy(F.length("source").desc(), F.col("doc_id").desc()).limit(40)
    words = rerank.ranked(last, [F.length("source").desc(), F.col("doc_id").desc()], rank="keyword_rank").select("doc_id", "keyword_rank", (10.0 / F.col("keyword_rank")).alias("bm25_score"))
    found = fusion.hybrid_with_rerank(semantic, words, ["doc_id"], 20)
    return found.select("doc_id", F.round("fused_score", 6).alias("fused_score"), F.round("rrf_score", 6).alias("rrf_score"), "rank")


# --- dictionary ---------------------------------------------------------------------------------------------------


def _entries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Words of the documents as two kinds of entries: short ones have full entries, longer ones are sub-entries."""
    words = rooted_words(spark, sf_dir)
    entry = words.select(F.crc32("word").alias("entry_id"), F.concat(F.lit("s"), F.length("word") % 3).alias("source"), F.col("word").alias("headword"), F.coalesce("root", F.lit("")).alias("root"), F.lit("d").alias("definition"))
    return entry.filter("length(headword) <= 4"), entry.filter("length(headword) > 4")


_ENTRIES = f"""w AS {_WORDS}, e AS (SELECT word, 's' || length(word) % 3 AS source, coalesce({_root_sql("word")}, '') AS root, CASE WHEN length(word) <= 4 THEN 'full' ELSE 'sub_entry' END AS kind FROM w)"""


@query(
    f"""WITH w AS MATERIALIZED {_WORDS}, q AS (SELECT 'ال' || word AS word, word AS n FROM w WHERE length(word) >= 3)
SELECT q.word, 'stripped' AS matched, CASE WHEN length(n) <= 4 THEN 'full' ELSE 'sub_entry' END AS kind, 's' || length(n) % 3 AS source, n AS headword FROM q ANTI JOIN w ON w.word = q.word"""
)
def dictionary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with an article before them, which no entry has: found by the tier that strips it."""
    entries, subs = _entries(spark, sf_dir)
    words = arabic_words(spark, sf_dir)
    asked = words.filter("length(word) >= 3").select(F.concat(F.lit("ال"), "word").alias("word")).join(words, "word", "left_anti")
    return lexicon.lookup(asked, entries, subs).select("word", "matched", "kind", "source", "headword")


@query(
    f"""WITH {_ENTRIES}, r AS (SELECT root FROM e WHERE length(root) = 3 GROUP BY root ORDER BY count(*) DESC, root LIMIT 1), f AS (SELECT e.* FROM e JOIN r USING (root))
SELECT source, word AS headword, kind FROM f WHERE kind = 'sub_entry' OR source NOT IN (SELECT source FROM f WHERE kind = 'sub_entry')"""
)
def root_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, subs = _entries(spark, sf_dir)
    best = entries.unionByName(subs).filter("length(root) = 3").groupBy("root").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "root").first()
    return lexicon.root_family(best["root"] if best else "", entries, subs).select("source", "headword", "kind")


@query(f"WITH {_ENTRIES}, k AS (SELECT word AS w, root FROM e WHERE root <> '') SELECT DISTINCT w AS word, root, 'high' AS confidence, 'direct' AS tier FROM k UNION ALL SELECT DISTINCT 'ال' || w, root, 'high', 'stripped' FROM k WHERE length(w) >= 3 AND 'ال' || w NOT IN (SELECT w FROM k)")
def resolved_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a list knows, and the same with an article before them."""
    known = rooted_words(spark, sf_dir).filter("root is not null")
    articled = known.filter("length(word) >= 3").select(F.concat(F.lit("ال"), "word").alias("word"))
    return lexicon.resolve_roots(known.select("word").union(articled), known, known.select("root").distinct())


def _form_sql(template: str) -> str:
    return " || ".join(f"substr(root, {c}, 1)" if c.isdigit() else f"'{c}'" for c in template)


@query(
    f"WITH w AS {_WORDS}, r AS (SELECT DISTINCT {_root_sql('word')} AS root FROM w) "
    + " UNION ALL ".join(f"SELECT root, '{n}' AS form, '{p}' AS part_of_speech, {_form_sql(t)} AS word FROM r WHERE length(root) = 3" for n, p, t in lexicon.ALL_FORMS)
)
def all_derived_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.derived_forms(arabic_words(spark, sf_dir).select(extract_root("word").alias("root")).distinct())


@query(
    """WITH d AS (SELECT conv_id, turn, trim(regexp_replace(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'ابجدهوزحطيكلمنسعفصقرشتثخذض'), '[^ا-ي]+', ' ', 'g')) AS x FROM conversations),
e AS (SELECT conv_id, turn, length(x) AS n FROM d WHERE NOT contains(x, 'قققق'))
SELECT conv_id, turn, CASE WHEN n + 1 >= 40 THEN n ELSE -1 END AS place FROM e"""
)
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where an excerpt is cut around a word that stands at the end of each turn: none if it comes early."""
    turns = table(spark, sf_dir, "conversations")
    x = F.trim(F.regexp_replace(F.translate(F.lower("text"), "abcdefghijklmnopqrstuvwxyz", "ابجدهوزحطيكلمنسعفصقرشتثخذض"), "[^ا-ي]+", " "))
    found = turns.select("conv_id", "turn", x.alias("x")).filter("not contains(x, 'قققق')")
    cut = lexicon.excerpt(F.concat("x", F.lit(" قَققق")), F.lit("قققق"))
    return found.select("conv_id", "turn", F.when(cut.endswith("قَققق"), F.length("x")).otherwise(-1).cast("long").alias("place"))

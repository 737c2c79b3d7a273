"""Catalog, batch preparation, graph, evaluation and event queries over the star schema."""

from __future__ import annotations

from lectern.operators import catalog, etl, evaluate, graph
from lectern.plans.registry import query, table
from lectern.streaming import events as ev
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BANDS = "CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END"


@query(
    f"""WITH p AS (SELECT p_brand, p_type, {_BANDS} AS band, p_retailprice FROM part)
SELECT 'brand' AS facet, p_brand AS value, count(*) AS n FROM p WHERE band = 'medium' AND p_retailprice > 910 GROUP BY p_brand
UNION ALL SELECT 'band', band, count(*) FROM p WHERE p_brand = 'Brand#4' AND p_retailprice > 910 GROUP BY band
UNION ALL SELECT 'type', p_type, count(*) FROM p WHERE p_brand = 'Brand#4' AND band = 'medium' AND p_retailprice > 910 GROUP BY p_type"""
)
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = F.expr(_BANDS)
    filters = {"brand": F.col("p_brand") == "Brand#4", "band": band == "medium", "price": F.col("p_retailprice") > 910}
    return catalog.facets(table(spark, sf_dir, "part"), filters, {"brand": F.col("p_brand"), "band": band, "type": F.col("p_type")})


@query(
    """SELECT count(*) FILTER (p_retailprice > 910 AND p_size > 20) AS big, count(*) FILTER (p_size > 20 AND p_retailprice > 910) AS dear,
count(*) FILTER (p_size > 20 AND p_retailprice > 910 AND p_name IS NOT NULL) AS named FROM part"""
)
def facet_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    big, dear = F.col("p_size") > 20, F.col("p_retailprice") > 910
    return catalog.feature_counts(table(spark, sf_dir, "part"), {"big": big, "dear": dear}, {"big": big, "dear": dear, "named": F.col("p_name").isNotNull()})


@query(
    """SELECT b.bucket, count(c.c_custkey) AS n FROM (SELECT CAST(range AS BIGINT) AS bucket FROM range(-2, 13)) b
LEFT JOIN customer c ON CAST(floor(c.c_acctbal / 1000) AS BIGINT) = b.bucket AND c.c_mktsegment = 'BUILDING' GROUP BY b.bucket"""
)
def facet_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    return catalog.histogram(rows, F.floor(F.col("c_acctbal") / 1000), spark.range(-2, 13).withColumnRenamed("id", "bucket"))


@query(
    """SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_acctbal > 0 GROUP BY n_name, r_name"""
)
def histogram_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").filter("c_acctbal > 0").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("n_name", "r_name").agg(F.count("*").alias("n"))


@query(
    """SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND lower(c_name) LIKE '%1%' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 20"""
)
def catalog_list_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    where = catalog.all_of(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lower("c_name").contains("1"), None)
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).filter(where).select("o_orderkey", "c_name", "o_totalprice")
    return catalog.page(rows, [F.col("o_totalprice").desc(), "o_orderkey"], 20, 20)


@query(
    """SELECT o_orderkey, coalesce(string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey), '') AS lines, count(l_orderkey) AS n_lines
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def nested_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = catalog.with_children(parents, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey", ["l_linenumber", "l_partkey"], ["l_linenumber", "l_partkey"])
    joined = F.array_join(F.transform("children", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"])), ",")
    return lines.select("o_orderkey", F.coalesce(joined, F.lit("")).alias("lines"), F.coalesce(F.size("children"), F.lit(0)).cast("long").alias("n_lines"))


@query(
    """WITH m AS (SELECT o_custkey, o_orderpriority, max(o_orderkey) AS v FROM orders GROUP BY ALL)
SELECT o_custkey, string_agg(o_orderpriority || '=' || v, ';' ORDER BY o_orderpriority) AS latest FROM m GROUP BY o_custkey"""
)
def map_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalog.map_of(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", F.max("o_orderkey"))
    text = F.array_join(F.transform(F.map_entries("map"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return found.select("o_custkey", text.alias("latest"))


@query(
    """WITH t AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY l_orderkey),
c AS (SELECT l_orderkey, l_returnflag, count(DISTINCT l_linenumber) AS c FROM lineitem GROUP BY ALL)
SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM c JOIN t USING (l_orderkey) WHERE c = n GROUP BY l_orderkey"""
)
def array_agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    total = lines.groupBy("l_orderkey").agg(F.countDistinct("l_linenumber").alias("n"))
    found = catalog.complete_values(lines, "l_orderkey", "l_returnflag", "l_linenumber", total)
    return found.select("l_orderkey", F.array_join("values", ",").alias("flags"))


@query(
    """SELECT o_orderkey, coalesce((SELECT arg_max(l_partkey, l_linenumber * 1000000 + l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey), -1) AS l_partkey FROM orders"""
)
def left_map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("ordinal"))
    found = catalog.last_wins(table(spark, sf_dir, "orders").select("o_orderkey"), lines, ["o_orderkey"], "ordinal", ["l_partkey"])
    return found.select("o_orderkey", F.coalesce("l_partkey", F.lit(-1)).alias("l_partkey"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT o_orderkey, 1 FROM orders WHERE o_orderstatus = 'F')")
def row_value_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    return catalog.keys_in(table(spark, sf_dir, "lineitem"), keys, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.keys_in(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"], exclude=True).select("doc_id", "source")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000) AS has_large FROM customer")
def exists_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_x", F.lit(True))
    return table(spark, sf_dir, "customer").join(large, "c_custkey", "left").select("c_custkey", F.col("_x").isNotNull().alias("has_large"))


@query("SELECT n_nationkey, n_name, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers FROM nation")
def child_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalog.with_child_counts(table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier"), "n_nationkey", "s_nationkey", "n_suppliers")
    return found.select("n_nationkey", "n_name", "n_suppliers")


@query(
    """SELECT source, lang, doc_id FROM documents
QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, abs(doc_id % 100 - 50), doc_id) = 1"""
)
def dedupe_keep_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = etl.keep_best(table(spark, sf_dir, "documents"), ["source", "lang"], "text", F.col("doc_id") % 100, F.lit(50), "doc_id")
    return best.select("source", "lang", "doc_id")


@query(
    """WITH r AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS n FROM conversations)
SELECT conv_id, turn, role || CASE WHEN n > 26 THEN chr(CAST(97 + (n - 27) // 26 AS INTEGER)) ELSE '' END
    || CASE WHEN n > 0 THEN chr(CAST(97 + (n - 1) % 26 AS INTEGER)) ELSE '' END AS unique_number FROM r"""
)
def suffix_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.unique_numbers(table(spark, sf_dir, "conversations"), ["conv_id"], "role", "turn").select("conv_id", "turn", "unique_number")


@query(
    """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT source, doc_id FROM r WHERE (i - 1) % CAST(ceil(n / 10) AS BIGINT) = 0"""
)
def sample_every_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.every_nth(table(spark, sf_dir, "documents"), ["doc_id"], ["source"], 10).select("source", "doc_id")


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3")
def first_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"]
    return catalog.first_per_group(table(spark, sf_dir, "lineitem"), ["l_suppkey"], order, 3).select("l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'events', count(*) FROM events")
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.counts(**{t: table(spark, sf_dir, t) for t in ("orders", "documents", "events")})


@query("SELECT count(*) AS rows, count(text) AS text, count(lang) AS lang, count(source) AS source FROM documents")
def column_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.coverage(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query(
    """WITH s AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), i AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT o_custkey FROM s JOIN i USING (o_custkey) WHERE i.n >= s.n UNION SELECT CAST(1 AS BIGINT)"""
)
def indexed_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda df: df.groupBy("o_custkey").agg(F.count("*").alias("n"))
    o = table(spark, sf_dir, "orders")
    part = count(o.filter("o_orderstatus <> 'P'"))
    return catalog.indexed_everywhere(count(o), part, part, "o_custkey", [1])


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY try_cast(replace(s_name, 'Supplier#', '') AS BIGINT) NULLS LAST, s_name")
def numeric_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").withColumn("id", F.replace("s_name", F.lit("Supplier#"), F.lit("")))
    return rows.orderBy(*catalog.numeric_order("id")).select("s_suppkey", "s_name")


# --- batch preparation --------------------------------------------------------------------------------------------


@query(
    """WITH s AS (SELECT *, count(CASE WHEN role = 'user' THEN text END) OVER w AS sec FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, substr(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn), 1, 40) AS outer_heading,
substr(last_value(CASE WHEN role <> 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id, sec ORDER BY turn), 1, 40) AS inner_heading FROM s"""
)
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    out = etl.carry_forward(rows, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") != "user", F.col("text")))
    return out.select("conv_id", "turn", F.substring("outer_heading", 1, 40).alias("outer_heading"), F.substring("inner_heading", 1, 40).alias("inner_heading"))


@query(
    """WITH c AS (SELECT conv_id, turn, CASE WHEN len(regexp_extract_all(text, '\\S+')) > 20 OR turn = max(turn) OVER (PARTITION BY conv_id) THEN 1 ELSE 0 END AS closes FROM conversations)
SELECT conv_id, turn, CAST(coalesce(sum(closes) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS group_id FROM c"""
)
def merge_short_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return etl.group_short(rows, ["conv_id"], "turn", F.regexp_count("text", F.lit(r"\S+")), 20).select("conv_id", "turn", "group_id")


@query(
    """WITH RECURSIVE t AS (SELECT conv_id, turn, CAST(ceil(length(text) / 3) AS BIGINT) AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
r AS (
    SELECT conv_id, turn, i, CAST(0 AS BIGINT) AS chunk, k AS total FROM t WHERE i = 1
    UNION ALL
    SELECT t.conv_id, t.turn, t.i, CASE WHEN r.total + t.k > 200 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.total + t.k > 200 THEN t.k ELSE r.total + t.k END
    FROM r JOIN t ON t.conv_id = r.conv_id AND t.i = r.i + 1
)
SELECT conv_id, turn, chunk FROM r"""
)
def chunk_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.ceil(F.length("text") / 3).cast("long").alias("tokens"))
    return etl.budget_chunks(rows, ["conv_id"], "turn", "tokens", 200).select("conv_id", "turn", "chunk")


@query(
    """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents)
SELECT source, doc_id, unnest(range(greatest(CAST(floor((i - 8) / 6) AS BIGINT) + 1, 0), i // 6 + 1)) + 1 AS chunk FROM r"""
)
def overlapping_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.overlapping_chunks(table(spark, sf_dir, "documents"), ["source"], "doc_id", 8, 2).select("source", "doc_id", "chunk")


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
h AS (SELECT *, CASE WHEN length(line) <= 60 THEN line END AS head FROM l),
e AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY i) AS entry FROM h)
SELECT doc_id, entry, max(i)::BIGINT AS last, length(string_agg(line, chr(10) ORDER BY i))::BIGINT AS size FROM e WHERE entry > 0 GROUP BY doc_id, entry
HAVING length(string_agg(line, chr(10) ORDER BY i)) >= 3"""
)
def entry_accumulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    found = etl.entries_from_lines(lines, ["doc_id"], "i", "line", F.when(F.length("line") <= 60, F.col("line")))
    return found.select("doc_id", "entry", F.col("last").cast("long").alias("last"), F.length("text").cast("long").alias("size"))


@query(
    """SELECT e.event_id, coalesce((SELECT max(o.o_orderkey) FROM orders o WHERE o.o_custkey = e.user_id AND o.o_orderkey <= e.event_id), -1) AS page FROM events e"""
)
def page_at_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("pos"))
    breaks = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("start"), F.col("o_orderkey").alias("page"))
    return etl.page_at(positions, breaks, ["user_id"]).select(F.col("pos").alias("event_id"), F.coalesce("page", F.lit(-1)).alias("page"))


@query(
    """SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_mktsegment = 'BUILDING' THEN 'segment' ELSE 'ok' END AS reason, count(*) AS n FROM customer GROUP BY 1"""
)
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.reject_reasons(table(spark, sf_dir, "customer"), {"negative": F.col("c_acctbal") < 0, "segment": F.col("c_mktsegment") == "BUILDING"})


@query(
    """SELECT o_orderkey, coalesce(l.p, o_totalprice) AS o_totalprice FROM orders LEFT JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) l ON l_orderkey = o_orderkey"""
)
def patched_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    patch = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("o_totalprice"))
    return etl.updated(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), patch, ["o_orderkey"], ["o_totalprice"])


@query("SELECT doc_id, quality FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).alias("quality"))
    return etl.upsert(existing, table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id", "quality"), ["doc_id"])


# --- graph --------------------------------------------------------------------------------------------------------


@query(
    """WITH n AS (SELECT DISTINCT p_name AS x FROM part UNION SELECT p_type FROM part UNION SELECT replace(p_brand, '#', ' ') FROM part),
c AS (SELECT string_split(x, ' ')[1] AS prefix, substr(x, length(string_split(x, ' ')[1]) + 2) AS slug FROM n)
SELECT a.prefix || ':' || a.slug AS a, b.prefix || ':' || b.slug AS b FROM c a JOIN c b ON a.prefix = b.prefix AND a.slug < b.slug
WHERE contains(a.slug, b.slug) OR contains(b.slug, a.slug) OR levenshtein(a.slug, b.slug) <= 2"""
)
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, types and brands of parts: the first word is the prefix."""
    part = table(spark, sf_dir, "part")
    names = part.select(F.explode(F.array("p_name", "p_type", F.replace("p_brand", F.lit("#"), F.lit(" ")))).alias("x"))
    first = F.substring_index("x", " ", 1)
    ids = names.distinct().select(F.concat(first, F.lit(":"), F.substring(F.col("x"), F.length(first) + 2, F.length("x"))).alias("id"))
    return graph.near_duplicate_ids(ids)


@query(
    """WITH r AS (SELECT o_orderkey, o_orderkey || ':1-' || (1 + o_orderkey % 4) AS ref FROM orders)
SELECT ref, l_linenumber AS verse, l_partkey FROM r JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber BETWEEN 1 AND 1 + o_orderkey % 4"""
)
def range_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "orders").select(F.concat("o_orderkey", F.lit(":1-"), 1 + F.col("o_orderkey") % 4).alias("ref"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("verse"), "l_partkey")
    return graph.expand_ranges(refs).join(lines, ["chapter", "verse"]).select("ref", "verse", "l_partkey")


@query(
    """SELECT 'customer' AS type, CAST(c_custkey AS VARCHAR) AS ref, c_name AS title FROM customer
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation
UNION ALL SELECT 'supplier', CAST(c_custkey AS VARCHAR), s_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""
)
def ref_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {name: table(spark, sf_dir, name) for name in ("customer", "nation", "supplier")}
    ref = lambda df, kind, key: df.select(F.lit(kind).alias("type"), F.col(key).cast("string").alias("ref"))
    refs = ref(t["customer"], "customer", "c_custkey").unionByName(ref(t["nation"], "nation", "n_nationkey")).unionByName(ref(t["customer"], "supplier", "c_custkey"))
    return graph.resolve_refs(refs, {"customer": (t["customer"], "c_custkey", "c_name"), "nation": (t["nation"], "n_nationkey", "n_name"), "supplier": (t["supplier"], "s_suppkey", "s_name")})


@query(
    """SELECT n_name AS id, coalesce(string_agg(s_name, ',' ORDER BY s_name), '') AS related, count(s_name) AS degree
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name"""
)
def one_hop_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    edges = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("src"), F.col("s_name").alias("dst"), F.lit("HAS").alias("type"), F.lit(None).cast("string").alias("description"))
    found = graph.one_hop(nation.select(F.col("n_name").alias("id")), edges, supplier.select(F.col("s_name").alias("id"), F.col("s_name").alias("name")))
    names = F.transform("relationships", lambda r: r["target_name"])
    return found.select("id", F.array_join(names, ",").alias("related"), F.size("relationships").cast("long").alias("degree"))


@query(
    """SELECT r_name AS path, 0 AS depth FROM region UNION ALL SELECT r_name || ' / ' || n_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT r_name || ' / ' || n_name || ' / ' || s_name, 2 FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name"))
    nation = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("name"))
    supplier = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.concat(F.lit("n"), "s_nationkey").alias("parent_id"), F.col("s_name").alias("name"))
    return graph.category_paths(region.unionByName(nation).unionByName(supplier), 3).select("path", "depth")


@query(
    """SELECT c_custkey AS id, CAST(c_custkey % 1000 AS INTEGER) AS depth,
md5(string_agg(c_name, ' / ') OVER (PARTITION BY c_custkey // 1000 ORDER BY c_custkey)) AS path_md5 FROM customer"""
)
def deep_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in chains of a thousand, each below the one before."""
    key = F.col("c_custkey")
    chains = table(spark, sf_dir, "customer").select(key.alias("id"), F.when(key % 1000 > 0, key - 1).alias("parent_id"), F.col("c_name").alias("name"))
    return graph.category_paths(chains).select("id", "depth", F.md5("path").alias("path_md5"))


@query("SELECT c_custkey AS id, c_custkey % 50 < 5 AS on_cycle FROM customer WHERE c_custkey // 50 % 2 = 1 AND c_custkey // 50 < (SELECT max(c_custkey) // 50 FROM customer)")
def category_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in blocks of fifty: in every other block the first five stand in a cycle, and the others below it."""
    key, nth = F.col("c_custkey"), F.col("c_custkey") % 50
    whole = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(1).alias("one"))
    last = whole.agg(F.floor(F.max("c_custkey") / 50).alias("last"))
    cyclic = (F.floor(key / 50) % 2 == 1) & (F.floor(key / 50) < F.col("last"))
    parent = F.when(cyclic & (nth < 5), key - nth + (nth + 1) % 5).when(nth > 0, key - 1)
    nodes = whole.join(F.broadcast(last)).select(key.alias("id"), parent.alias("parent_id"), F.col("c_name").alias("name"))
    return graph.category_cycles(nodes)


@query("SELECT l_orderkey AS src, l_suppkey AS dst FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def missing_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"), F.lit("SUPPLIED").alias("type"))
    nodes = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"))
    return graph.missing_endpoints(edges, nodes).filter("missing = 'dst'").select("src", "dst")


# --- evaluation ---------------------------------------------------------------------------------------------------

_RANKED = """
WITH g AS (SELECT d.lang || d.source AS qid, l.doc_id FROM labels l JOIN documents d USING (doc_id) WHERE l.quality = 1),
r AS (SELECT lang || source AS qid, lang, doc_id, row_number() OVER (PARTITION BY lang || source ORDER BY n_chars DESC, doc_id) AS rank FROM documents),
h AS (SELECT r.qid, r.rank, CASE WHEN g.doc_id IS NULL THEN 0 ELSE 1 END AS hit FROM r LEFT JOIN g ON r.qid = g.qid AND r.doc_id = g.doc_id WHERE rank <= 20),
s AS (SELECT qid, count(*) AS n FROM g GROUP BY qid),
m AS (
    SELECT s.qid, n, sum(CASE WHEN rank <= 5 THEN hit ELSE 0 END) AS h5, sum(hit) AS h20, count(*) FILTER (rank <= 5) AS got5,
        sum(CASE WHEN rank <= 10 THEN hit / log2(rank + 1) ELSE 0 END) AS dcg, min(CASE WHEN hit = 1 THEN rank END) AS first_rank
    FROM s JOIN h USING (qid) GROUP BY s.qid, n
),
o AS (
    SELECT qid, h5 / n AS recall_at_5, h20 / n AS recall_at_20, h5 / got5 AS precision_at_5,
        coalesce(1.0::DOUBLE / first_rank, 0) AS reciprocal_rank, dcg / (SELECT sum(1 / log2(i + 1)) FROM range(1, 11) t(i) WHERE i <= n) AS ndcg_at_10 FROM m
)
"""


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("qid", F.concat("lang", "source"))
    w = Window.partitionBy("qid").orderBy(F.col("n_chars").desc(), "doc_id")
    ranked = docs.select("qid", "doc_id", F.row_number().over(w).alias("rank")).filter("rank <= 20")
    gold = table(spark, sf_dir, "labels").filter("quality = 1").join(docs.select("doc_id", "qid"), "doc_id")
    return evaluate.query_metrics(ranked, gold)


@query(
    _RANKED
    + """SELECT qid, round(recall_at_5, 6) AS recall_at_5, round(recall_at_20, 6) AS recall_at_20, round(precision_at_5, 6) AS precision_at_5,
    round(reciprocal_rank, 6) AS reciprocal_rank, round(ndcg_at_10, 6) AS ndcg_at_10 FROM o"""
)
def ir_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("recall_at_5", "recall_at_20", "precision_at_5", "reciprocal_rank", "ndcg_at_10")
    return _metrics(spark, sf_dir).select("qid", *(F.round(c, 6).alias(c) for c in names))


@query(
    _RANKED
    + """SELECT 'all' AS grouped_by, 'all' AS value, count(*) AS queries, round(avg(reciprocal_rank), 4) AS reciprocal_rank, round(avg(ndcg_at_10), 4) AS ndcg_at_10 FROM o
UNION ALL SELECT 'lang', substr(qid, 1, 2), count(*), round(avg(reciprocal_rank), 4), round(avg(ndcg_at_10), 4) FROM o GROUP BY 2"""
)
def ir_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.mean_metrics(_metrics(spark, sf_dir).withColumn("lang", F.substring("qid", 1, 2)), "lang")
    return found.select("grouped_by", "value", "queries", F.round("reciprocal_rank", 4).alias("reciprocal_rank"), F.round("ndcg_at_10", 4).alias("ndcg_at_10"))


@query(
    """WITH a AS (SELECT c_nationkey AS k, list_distinct(list(c_mktsegment)) AS s FROM customer WHERE c_acctbal > 5000 GROUP BY 1),
b AS (SELECT c_nationkey AS k, list_distinct(list(c_mktsegment)) AS s FROM customer WHERE c_acctbal <= 5000 GROUP BY 1)
SELECT k, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 6) AS jaccard FROM a JOIN b USING (k)"""
)
def jaccard_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    a, b = (c.filter(x).groupBy(F.col("c_nationkey").alias("k")).agg(F.collect_set("c_mktsegment").alias(n)) for x, n in (("c_acctbal > 5000", "a"), ("c_acctbal <= 5000", "b")))
    return a.join(b, "k").select("k", F.round(evaluate.jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"))


@query(
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, round(avg(value), 6) AS avg_value, max(CASE WHEN i = floor(n * 0.95::DOUBLE) + 1 THEN value END) AS p95_value FROM r GROUP BY event_type"""
)
def latency_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.latency(table(spark, sf_dir, "events"), "event_type", "value")
    return found.select("event_type", F.round("avg_value", 6).alias("avg_value"), "p95_value")


# --- events -------------------------------------------------------------------------------------------------------


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, k) <= 5")
def search_events_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"))
    return catalog.first_per_group(counts, ["event_type"], [F.col("n").desc(), "k"], 5)


@query(
    """WITH c AS (SELECT user_id AS search_id, min(CAST(value AS INTEGER)) AS rank FROM events WHERE event_type = 'click' GROUP BY 1),
s AS (SELECT DISTINCT user_id AS search_id, CASE WHEN user_id % 2 = 0 THEN 'hybrid' ELSE 'keyword' END AS mode FROM events)
SELECT mode, count(*) AS searches, count(rank) AS clicked, round(count(rank) / count(*), 6) AS rate, round(avg(rank), 6) AS mean_rank FROM s LEFT JOIN c USING (search_id) GROUP BY mode""".replace("CAST(value AS INTEGER)", "CAST(floor(value) AS INTEGER)")
)
def click_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "search_id")
    searches = e.select("search_id", F.when(F.col("search_id") % 2 == 0, "hybrid").otherwise("keyword").alias("mode")).distinct()
    clicks = e.filter("event_type = 'click'").select("search_id", F.floor("value").cast("int").alias("rank"))
    found = ev.click_through(searches, clicks)
    return found.select("mode", "searches", "clicked", F.round("rate", 6).alias("rate"), F.round("mean_rank", 6).alias("mean_rank"))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 600000000 THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
x AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n FROM x GROUP BY user_id, session"""
)
def session_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.sessions(table(spark, sf_dir, "events"), "user_id", "ts", 600).groupBy("user_id", "session").agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.windowed_counts(table(spark, sf_dir, "events"), "ts", ["event_type"], "1 hour").select("start", "event_type", "n")

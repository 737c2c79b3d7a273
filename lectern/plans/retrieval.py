"""Retrieval over documents and embeddings."""

from __future__ import annotations

from lectern.operators import fusion, graph, keyword, search, vector
from lectern.operators.index import Index
from lectern.operators.query import SearchParams, parse_query, query_parts, query_rules
from lectern.operators.segments import SegmentedIndex
from lectern.operators.vector_index import VectorIndex
from lectern.plans.registry import query, table
from lectern.sources.store import fingerprint, table_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKENS = """
tok AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{M}\\p{N}_]+') AS terms FROM documents
)"""
_BM25 = f"""
WITH {_TOKENS},
q AS (SELECT * FROM (VALUES @queries) t(qid, term)),
st AS (SELECT count(*) AS n, avg(len(terms)) AS avgdl FROM tok),
ex AS (SELECT doc_id, len(terms) AS dl, unnest(terms) AS term FROM tok),
tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM ex WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (
    SELECT qid, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))), 9) AS score
    FROM tf JOIN q USING (term) JOIN df USING (term) CROSS JOIN st GROUP BY qid, doc_id
),
rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM sc)
"""

QUERY = "the and which dans"
QUERIES = {"q1": "the and which", "q2": "dans les pour", "q3": "und der nicht", "q4": "que los para"}


def _values(queries: dict[str, str]) -> str:
    return ", ".join(f"('{q}', '{t}')" for q, text in queries.items() for t in text.split())


def bm25_best(spark: SparkSession, sf_dir: str, queries: dict[str, str], k: int) -> DataFrame:
    """The k best documents of each query; scores are rounded before they are ranked, so that ties are ties."""
    scores = keyword.bm25_scores(stored_index(spark, sf_dir), queries_table(spark, queries))
    return keyword.top_k(scores.withColumn("score", F.round("score", 9)), k)


def _bm25(queries: dict[str, str]) -> str:
    return _BM25.replace("@queries", _values(queries))


#: Stored indexes by session and table, with the fingerprint of the documents that they hold, and their last version.
_stored: dict[tuple[str, str], tuple[SegmentedIndex, tuple, Index]] = {}


def documents_index(spark: SparkSession, sf_dir: str) -> Index:
    return Index.build(table(spark, sf_dir, "documents"), "doc_id", "text", ["lang"])


def stored_index(spark: SparkSession, sf_dir: str) -> Index:
    """The documents' index as tables, which stays for the session: the first query that asks for it writes it, and one
    that finds the documents' files changed brings it up to date."""
    key = (spark.sparkContext.applicationId, sf_dir)
    found = fingerprint(spark, f"{sf_dir}/documents.parquet")
    index, held, last = _stored.get(key) or (SegmentedIndex(spark, table_path(spark, "index"), keep=["lang"]), None, None)
    if held != found:
        index.sync(table(spark, sf_dir, "documents"))
        last = index.index()
        _stored[key] = index, found, last
    return last


def queries_table(spark: SparkSession, queries: dict[str, str]) -> DataFrame:
    return spark.createDataFrame([(q, parse_query(t).terms) for q, t in queries.items()], "qid string, terms array<string>")


@query(f"WITH {_TOKENS} SELECT doc_id, CAST(len(terms) AS BIGINT) AS n_terms, CAST(len(list_distinct(terms)) AS BIGINT) AS n_distinct FROM tok")
def tokenize_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_index(spark, sf_dir).docs
    return docs.select("doc_id", F.col("dl").cast("long").alias("n_terms"), F.size(F.array_distinct("terms")).cast("long").alias("n_distinct"))


@query(f"WITH {_TOKENS} SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(terms)) AS term FROM tok) GROUP BY term")
def term_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_index(spark, sf_dir).term_stats()


@query(f"WITH {_TOKENS} SELECT count(*) AS n_docs, round(avg(len(terms)), 6) AS avgdl FROM tok")
def doc_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_index(spark, sf_dir).corpus_stats().select("n_docs", F.round("avgdl", 6).alias("avgdl"))


@query(f"WITH {_TOKENS} SELECT term, doc_id, len(terms) AS dl, count(*) AS tf FROM (SELECT doc_id, terms, unnest(terms) AS term FROM tok) GROUP BY term, doc_id, len(terms)".replace("len(terms) AS dl", "CAST(len(terms) AS INTEGER) AS dl"))
def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_index(spark, sf_dir).postings()


@query(_bm25({"q": QUERY}) + "SELECT doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 50")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bm25_best(spark, sf_dir, {"q": QUERY}, 50)
    return found.select("doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(_bm25(QUERIES) + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 20")
def bm25_multi_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bm25_best(spark, sf_dir, QUERIES, 20)
    return found.select("qid", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(
    f"""WITH {_TOKENS},
m AS (SELECT doc_id, len(terms) AS dl, (SELECT count(*) FROM range(1, len(terms)) r(i) WHERE terms[i] = 'of' AND terms[i + 1] = 'the') AS tf FROM tok),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (tf > 0) AS df FROM m)
SELECT doc_id, round(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl)), 6) AS score FROM m CROSS JOIN st WHERE tf > 0"""
)
def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = parse_query('"of the"').phrases
    return keyword.phrase_search(stored_index(spark, sf_dir), phrases).select("doc_id", F.round("score", 6).alias("score"))


@query(
    f"""WITH {_TOKENS}, v AS (SELECT DISTINCT unnest(terms) AS term FROM tok),
q AS (SELECT * FROM (VALUES ('quelle'), ('wher'), ('the'), ('whcih'), ('teh'), ('al'), ('pcoa'), ('dnas')) t(query_term)),
d AS (SELECT term, query_term, CAST(damerau_levenshtein(translate(term, 'éèêçüöäßñóíáú', 'ABCDEFGHIJKLM'), query_term) AS INTEGER) AS edits FROM v, q)
SELECT term, query_term, edits FROM d WHERE edits <= CASE WHEN length(query_term) <= 2 THEN 0 WHEN length(query_term) <= 5 THEN 1 ELSE 2 END"""
)
def fuzzy_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index terms near to words, some of them with two letters swapped."""
    asked = queries_table(spark, {"q": "quelle wher the whcih teh al pcoa dnas"})
    return keyword.fuzzy_terms(stored_index(spark, sf_dir), asked).select("term", "query_term", "edits")


@query("SELECT doc_id, substr(text, 1, 300) AS snippet, regexp_replace(substr(text, 1, 300), '\\b(the|and)\\b', '<mark>\\1</mark>', 'g') AS marked FROM documents")
def keyword_snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = keyword.snippet("text")
    return table(spark, sf_dir, "documents").select("doc_id", s.alias("snippet"), F.regexp_replace(s, r"\b(the|and)\b", "<mark>$1</mark>").alias("marked"))


_COSINE = """
WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 0),
s AS (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], qv) AS score FROM embeddings, q)
"""


def _first_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return list(table(spark, sf_dir, "embeddings").filter("vec_id = 0").first()["embedding"])


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(_COSINE + "SELECT vec_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM s ORDER BY score DESC, vec_id LIMIT 50")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vector.nearest(table(spark, sf_dir, "embeddings"), _first_vector(spark, sf_dir), 50))


@query(_COSINE + "SELECT vec_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM s WHERE label = 2 ORDER BY score DESC, vec_id LIMIT 20")
def cosine_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vector.nearest(table(spark, sf_dir, "embeddings"), _first_vector(spark, sf_dir), 20, condition="label = 2"))


@query(_COSINE + "SELECT vec_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM s WHERE score >= 0.3 AND vec_id NOT IN (0) ORDER BY score DESC, vec_id LIMIT 100")
def cosine_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vector.nearest(table(spark, sf_dir, "embeddings"), _first_vector(spark, sf_dir), 100, least=0.3, excluded=[0]))


@query(
    """WITH s AS (
    SELECT q.vec_id AS qid, e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
    FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT qid, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10"""
)
def cosine_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    return vector.nearest_batch(vectors, queries, 10).select("qid", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


_HYBRID = f"""{_bm25({"q": QUERY})},
k AS (SELECT doc_id, score AS bm25_score, rank AS keyword_rank FROM rk WHERE rank <= 50),
qv AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 0),
cs AS (SELECT vec_id AS doc_id, list_cosine_similarity(embedding::DOUBLE[], qv) AS semantic_score FROM embeddings, qv),
s AS (SELECT *, row_number() OVER (ORDER BY semantic_score DESC, doc_id) AS semantic_rank FROM cs ORDER BY semantic_score DESC, doc_id LIMIT 50),
j AS (
    SELECT coalesce(s.doc_id, k.doc_id) AS doc_id, semantic_score, semantic_rank, bm25_score, keyword_rank
    FROM @semantic AS s FULL JOIN @keyword AS k ON s.doc_id = k.doc_id
),
f AS (
    SELECT doc_id,
        CASE WHEN semantic_rank IS NOT NULL AND keyword_rank IS NOT NULL THEN 0.4 * semantic_score + 0.7 * bm25_score / (bm25_score + 3)
             WHEN semantic_rank IS NOT NULL THEN semantic_score ELSE bm25_score / (bm25_score + 3) END AS fused_score,
        coalesce(1.0::DOUBLE / (60 + semantic_rank), 0) + coalesce(1.0::DOUBLE / (60 + keyword_rank), 0) AS rrf_score,
        CASE WHEN semantic_rank IS NOT NULL AND keyword_rank IS NOT NULL THEN 'both' WHEN semantic_rank IS NOT NULL THEN 'semantic' ELSE 'keyword' END AS match_type
    FROM j
)
SELECT doc_id, round(fused_score, 6) AS fused_score, round(rrf_score, 6) AS rrf_score, match_type
FROM f ORDER BY f.fused_score DESC, f.rrf_score DESC, doc_id LIMIT 20
"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents and vectors of the same number stand for one another."""
    found = vector.nearest(table(spark, sf_dir, "embeddings"), _first_vector(spark, sf_dir), 50)
    semantic = found.select(F.col("vec_id").alias("doc_id"), F.col("score").alias("semantic_score"), F.col("rank").alias("semantic_rank"))
    hits = bm25_best(spark, sf_dir, {"q": QUERY}, 50)
    return semantic, hits.select("doc_id", F.col("score").alias("bm25_score"), F.col("rank").alias("keyword_rank"))


def _mode(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    found = fusion.by_mode(mode, *_sides(spark, sf_dir), ["doc_id"], 20)
    return found.select("doc_id", F.round("fused_score", 6).alias("fused_score"), F.round("rrf_score", 6).alias("rrf_score"), "match_type")


@query(_HYBRID.replace("@semantic", "s").replace("@keyword", "k"))
def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mode(spark, sf_dir, "hybrid")


@query(_HYBRID.replace("@semantic", "s").replace("@keyword", "(SELECT * FROM k WHERE false)"))
def mode_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mode(spark, sf_dir, "semantic")


@query(_HYBRID.replace("@semantic", "(SELECT * FROM s WHERE false)").replace("@keyword", "k"))
def mode_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mode(spark, sf_dir, "keyword")


@query(
    _bm25(QUERIES)
    + """, w AS (SELECT * FROM (VALUES ('q1', 1.0), ('q2', 0.5), ('q3', 0.5), ('q4', 0.1)) t(qid, weight))
SELECT doc_id, round(sum(weight::DOUBLE / (60 + rank)), 6) AS weighted_rrf, round(max(score), 6) AS bm25_score
FROM rk JOIN w USING (qid) WHERE rank <= 50 GROUP BY doc_id"""
)
def multi_query_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = bm25_best(spark, sf_dir, QUERIES, 50)
    weights = spark.createDataFrame([("q1", 1.0), ("q2", 0.5), ("q3", 0.5), ("q4", 0.1)], "qid string, weight double")
    merged = fusion.merge_queries(hits.withColumnRenamed("score", "bm25_score").join(weights, "qid"), ["doc_id"])
    return merged.select("doc_id", F.round("weighted_rrf", 6).alias("weighted_rrf"), F.round("bm25_score", 6).alias("bm25_score"))


# --- queries as rows, highlights, fields, whole searches ----------------------------------------------------------

_QUERY_TEXT = "CASE conv_id % 3 WHEN 0 THEN '\"' || regexp_replace(text, '[\"\\r\\n]', ' ', 'g') || '\" قول' WHEN 1 THEN '\"one\" ' || text ELSE substr(text, 1, CAST(turn + 1 AS INTEGER)) END"
_NORMAL = "trim(regexp_replace(translate(regexp_replace(@, '[\\x{064B}-\\x{065F}\\x{0670}]', '', 'g'), 'آأإٱىةء', 'اااايه'), '\\s+', ' ', 'g'))"
_WORDS_OF = "list_filter(list_transform(string_split(" + _NORMAL + ", ' '), lambda w: regexp_replace(w, '[^\\x{0600}-\\x{06FF}A-Za-z0-9_]', '', 'g')), lambda w: w <> '')"


@query(
    f"""WITH q AS (SELECT conv_id, turn, {_QUERY_TEXT} AS q, regexp_replace(text, '["\\r\\n]', ' ', 'g') AS line, text FROM conversations WHERE NOT regexp_matches(text, '["«»„“”]')),
w AS (SELECT *, {_WORDS_OF.replace("@", "line")} AS inner_words, {_WORDS_OF.replace("@", "text")} AS all_words, {_WORDS_OF.replace("@", "q")} AS q_words, {_NORMAL.replace("@", "q")} AS plain FROM q),
c AS (SELECT *, length(replace(plain, ' ', '')) AS chars, CASE WHEN NOT contains(plain, ' ') AND plain <> '' THEN least(length(plain), 6) ELSE length(replace(plain, ' ', '')) END AS counted FROM w)
SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 AND len(inner_words) > 1 THEN array_to_string(inner_words, ' ') ELSE '' END AS phrases,
array_to_string(CASE conv_id % 3 WHEN 0 THEN CASE WHEN len(inner_words) > 1 THEN [] ELSE inner_words END || ['قول'] WHEN 1 THEN ['one'] || all_words ELSE q_words END, ' ') AS terms,
conv_id % 3 = 0 AS is_arabic, CASE WHEN conv_id % 3 = 0 THEN 'hybrid' ELSE 'semantic_only' END AS strategy, conv_id % 3 < 2 AS has_quotes, conv_id % 3 < 2 OR chars < 4 AS skips_semantic,
CASE WHEN counted <= 3 THEN 0.55 WHEN counted <= 6 THEN 0.4 WHEN counted <= 12 THEN 0.3 ELSE 0.25 END::DOUBLE AS similarity_floor FROM c"""
)
def parsed_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as queries: quoted, with a quoted word, or cut short."""
    turns = table(spark, sf_dir, "conversations").filter(~F.col("text").rlike('["«»„“”]'))
    line = F.regexp_replace("text", '["\r\n]', " ")
    q = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit('"'), line, F.lit('" قول'))).when(F.col("conv_id") % 3 == 1, F.concat(F.lit('"one" '), "text"))
    asked = turns.select("conv_id", "turn", q.otherwise(F.substring("text", F.lit(1), (F.col("turn") + 1).cast("int"))).alias("q"))
    found = asked.select("conv_id", "turn", query_parts("q").alias("p"), query_rules("q", 0.25).alias("r"))
    return found.select("conv_id", "turn", F.array_join("p.phrases", "|").alias("phrases"), F.array_join("p.terms", " ").alias("terms"), "r.*")


_WORD_CHARS = "A-Za-z0-9_\\p{L}\\p{M}\\p{N}"
_FRAGMENTS = f"""WITH d AS (SELECT doc_id, @text AS text FROM documents),
t AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(text, '[{_WORD_CHARS}]+|[^{_WORD_CHARS}]+'), lambda x: x <> '')) AS piece,
    generate_subscripts(list_filter(regexp_extract_all(text, '[{_WORD_CHARS}]+|[^{_WORD_CHARS}]+'), lambda x: x <> ''), 1) AS i FROM d),
p AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    CASE WHEN @term IN (@terms) THEN @term END AS term FROM t),
h AS (SELECT doc_id, start, start + length(piece) AS stop, term FROM p WHERE term IS NOT NULL),
w AS (SELECT a.doc_id, greatest(a.start - 50, 0) AS low, count(DISTINCT b.term) AS n_terms, count(*) AS n_hits FROM h a JOIN h b ON a.doc_id = b.doc_id AND b.start >= greatest(a.start - 50, 0)
    AND b.stop <= greatest(a.start - 50, 0) + 200 GROUP BY a.doc_id, a.start),
best AS (SELECT doc_id, low FROM w QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n_terms DESC, n_hits DESC, low) = 1),
out AS (SELECT doc_id, string_agg(CASE WHEN term IS NOT NULL AND start >= low AND start + length(piece) <= low + 200 THEN '<mark>' || piece || '</mark>'
    ELSE substr(piece, CAST(greatest(low - start, 0) + 1 AS BIGINT), CAST(least(start + length(piece), low + 200) - greatest(start, low) AS BIGINT)) END, '' ORDER BY i) AS highlighted
    FROM p JOIN best USING (doc_id) WHERE start < low + 200 AND start + length(piece) > low GROUP BY doc_id)
SELECT doc_id, highlighted FROM d LEFT JOIN out USING (doc_id)"""


def _fragment_sql(text: str, terms: list[str]) -> str:
    return _FRAGMENTS.replace("@text", text).replace("@terms", ", ".join(f"'{t}'" for t in terms)).replace("@term", "lower(piece)")


@query(_fragment_sql("text", ["the", "and"]))
def highlighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", keyword.highlight("text", ["the", "and"]).alias("highlighted"))


@query(_fragment_sql("CASE WHEN doc_id % 2 = 0 THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE text END", ["of", "which", "pour", "dans", "der", "nicht", "para", "que"]))
def highlighted_in_capitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other text in capitals: the terms are met as the index has them, and marked as the text has them."""
    shown = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", keyword.highlight(shown, ["of", "which", "pour", "dans", "der", "nicht", "para", "que"]).alias("highlighted"))


_FIELDS = f"""
WITH {_TOKENS}, src AS (SELECT doc_id, regexp_extract_all(lower(coalesce(source, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+') AS terms FROM documents),
f AS (SELECT 'text' AS field, 1.0::DOUBLE AS boost, * FROM tok UNION ALL SELECT 'source', 3.0::DOUBLE, * FROM src),
st AS (SELECT field, count(*) AS n, avg(len(terms)) AS avgdl FROM f GROUP BY field),
q AS (SELECT * FROM (VALUES ('src1'), ('which')) t(term)),
ex AS (SELECT field, boost, doc_id, len(terms) AS dl, unnest(terms) AS term FROM f),
tf AS (SELECT field, boost, doc_id, dl, term, count(*) AS tf FROM ex WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY field, term),
sc AS (SELECT field, doc_id, boost * sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))) AS score FROM tf JOIN df USING (field, term) JOIN st USING (field) GROUP BY field, doc_id, boost)
SELECT doc_id, round(max(score), 6) AS score FROM sc GROUP BY doc_id"""


@query(_FIELDS)
def best_of_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text and source as fields, the source counting three times: the better of a document's two scores."""
    fields = {"text": (stored_index(spark, sf_dir), 1.0), "source": (Index.build(table(spark, sf_dir, "documents"), "doc_id", "source"), 3.0)}
    found = keyword.best_field(fields, queries_table(spark, {"q": "src1 which"}), fuzzy=False)
    return found.select("doc_id", F.round("score", 6).alias("score"))


@query(
    f"""WITH {_TOKENS}, st AS (SELECT count(*) AS n, avg(len(terms)) AS avgdl FROM tok), ex AS (SELECT doc_id, len(terms) AS dl, unnest(terms) AS term FROM tok),
v AS (SELECT term, translate(term, 'éèêçüöäßñóíáú', 'ABCDEFGHIJKLM') AS t FROM (SELECT DISTINCT term FROM ex)),
near AS (SELECT term, 1 - damerau_levenshtein(t, 'quellezq') / 8.0::DOUBLE AS weight FROM v WHERE damerau_levenshtein(t, 'quellezq') <= 2),
tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM ex JOIN near USING (term) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
bf AS (SELECT doc_id, dl, count(*) AS tf FROM ex WHERE term = 'que' GROUP BY ALL)
SELECT 'far' AS qid, doc_id, round(sum(weight * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score, true AS fuzzy FROM tf JOIN df USING (term) JOIN near USING (term) CROSS JOIN st GROUP BY doc_id
UNION ALL SELECT 'near', doc_id, round(ln(1 + (n - (SELECT count(*) FROM bf) + 0.5) / ((SELECT count(*) FROM bf) + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl)), 6), false FROM bf CROSS JOIN st"""
)
def fuzzy_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word that stands in the texts is met exactly; one that does not, by terms within two edits."""
    found = keyword.with_fuzzy_fallback(stored_index(spark, sf_dir), queries_table(spark, {"near": "que", "far": "quellezq"}))
    return found.select("qid", "doc_id", F.round("score", 6).alias("score"), "fuzzy")


def _searcher(spark: SparkSession, sf_dir: str, **expand) -> search.Searcher:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    first = _first_vector(spark, sf_dir)
    return search.Searcher({"page": search.Corpus(stored_index(spark, sf_dir), vectors)}, lambda texts: [first] * len(texts), **expand)


_STANDARD = _HYBRID.replace("@semantic", "(SELECT * FROM s WHERE semantic_score >= 0.3)").replace("@keyword", "k")


@query(f"WITH r AS ({_STANDARD}) SELECT *, CAST(row_number() OVER (ORDER BY fused_score DESC, rrf_score DESC, doc_id) AS INTEGER) AS rank FROM r")
def standard_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = SearchParams(QUERY, book_limit=20, similarity_cutoff=0.3, fuzzy=False, keyword_gate="none")
    found = _searcher(spark, sf_dir).standard(params)["page"]
    return found.select("doc_id", F.round("fused_score", 6).alias("fused_score"), F.round("rrf_score", 6).alias("rrf_score"), "match_type", "rank")


_WORDINGS = {"0": "the and which", "1": "dans les pour"}
_REFINED = f"""{_bm25(_WORDINGS)},
k AS (SELECT qid, doc_id, score AS bm25_score, rank AS keyword_rank FROM rk WHERE rank <= 50),
qv AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 0),
cs AS (SELECT vec_id AS doc_id, list_cosine_similarity(embedding::DOUBLE[], qv) AS semantic_score FROM embeddings, qv),
s1 AS (SELECT *, row_number() OVER (ORDER BY semantic_score DESC, doc_id) AS semantic_rank FROM cs WHERE semantic_score >= 0.3 ORDER BY semantic_score DESC, doc_id LIMIT 50),
s AS (SELECT * FROM s1 CROSS JOIN (VALUES ('0'), ('1')) t(qid)),
j AS (SELECT coalesce(s.qid, k.qid) AS qid, coalesce(s.doc_id, k.doc_id) AS doc_id, semantic_score, semantic_rank, bm25_score, keyword_rank FROM s FULL JOIN k ON s.doc_id = k.doc_id AND s.qid = k.qid),
f AS (SELECT *, CASE WHEN semantic_rank IS NOT NULL AND keyword_rank IS NOT NULL THEN 0.4 * semantic_score + 0.7 * bm25_score / (bm25_score + 3)
    WHEN semantic_rank IS NOT NULL THEN semantic_score ELSE bm25_score / (bm25_score + 3) END AS fused_score, coalesce(1.0::DOUBLE / (60 + semantic_rank), 0) + coalesce(1.0::DOUBLE / (60 + keyword_rank), 0) AS rrf_score FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY fused_score DESC, rrf_score DESC, doc_id) AS place FROM f QUALIFY place <= 50),
m AS (SELECT doc_id, sum(CASE qid WHEN '0' THEN 1.0 ELSE 0.5 END::DOUBLE / (60 + place)) AS score FROM r GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 30)
SELECT 'page' AS type, CAST(doc_id AS VARCHAR) AS doc_key, round(score, 6) AS score FROM m ORDER BY m.score DESC, doc_key LIMIT 10"""


@query(_REFINED)
def refined_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query and one other wording of it, merged by weight."""
    expand = lambda q: [(q, 1.0), (_WORDINGS["1"], 0.5)]
    params = SearchParams(_WORDINGS["0"], refine=True, fuzzy=False, keyword_gate="none")
    return _searcher(spark, sf_dir, expand=expand).refined(params).select("type", "doc_key", F.round("score", 6).alias("score"))


@query(
    f"""WITH r AS (SELECT *, CAST(row_number() OVER (ORDER BY fused_score DESC, rrf_score DESC, doc_id) AS INTEGER) AS rank FROM ({_STANDARD})) SELECT rank, doc_id, fused_score AS score, match_type,
substr(text, 1, 300) AS text_snippet, substr(text, 1, 300) AS highlighted_snippet FROM r JOIN documents USING (doc_id)"""
)
def formatted_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = SearchParams(QUERY, book_limit=20, similarity_cutoff=0.3, fuzzy=False, keyword_gate="none")
    found = _searcher(spark, sf_dir).standard(params)["page"].join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return search.formatted(found, "hybrid").withColumn("score", F.round("score", 6))


@query(
    f"""WITH p AS (SELECT DISTINCT 'p' || p_partkey AS id, regexp_extract_all(lower(p_name), '[a-z]+') AS n, regexp_extract_all(lower(p_type), '[a-z]+') AS t FROM part),
f AS (SELECT 'n' AS field, id, n AS terms FROM p UNION ALL SELECT 't', id, t FROM p), st AS (SELECT field, count(*) AS n, avg(len(terms)) AS avgdl FROM f GROUP BY field),
tf AS (SELECT field, id, len(terms) AS dl, term, count(*) AS tf FROM (SELECT field, id, terms, unnest(terms) AS term FROM f) WHERE term IN ('ring', 'brass') GROUP BY ALL),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL),
sc AS (SELECT field, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))), 9) AS score FROM tf JOIN df USING (field, term) JOIN st USING (field) GROUP BY field, id),
m AS (SELECT id, max(score) AS score FROM sc GROUP BY id HAVING max(score) > 0.5)
SELECT 'q' AS qid, id, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY round(score, 6) DESC, id) AS INTEGER) AS rank FROM m QUALIFY rank <= 5"""
)
def entity_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by their names and types: of each part the better name counts."""
    nodes = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), "p_name", "p_type")
    found = graph.search_entities(nodes, ["p_name", "p_type"], queries_table(spark, {"q": "ring brass"}), k=100_000)
    return keyword.top_k(found.withColumn("score", F.round("score", 6)), 5, key="id")


_BATCH = """WITH s AS (
    SELECT q.vec_id AS qid, e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
    FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0 @and
), r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT qid, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10"""


def _every_fiftieth(vectors: DataFrame) -> DataFrame:
    return vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))


def _vector_index(spark: SparkSession, sf_dir: str) -> tuple[VectorIndex, DataFrame]:
    vectors = table(spark, sf_dir, "embeddings")
    return VectorIndex.build(vectors, table_path(spark, "vectors"), keep=["label"]), _every_fiftieth(vectors)


def _found(df: DataFrame) -> DataFrame:
    return df.select("qid", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(_BATCH.replace("@and", ""))
def indexed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index with all cells read: as exact as without one."""
    index, queries = _vector_index(spark, sf_dir)
    return _found(index.nearest(queries, 10, probes=len(index.centres())))


@query(_BATCH.replace("@and", "AND e.label <> 1 AND e.vec_id NOT IN (0, 7) AND list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) >= 0.1"))
def indexed_vectors_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition, exclusions and a threshold, on the stored index."""
    index, queries = _vector_index(spark, sf_dir)
    return _found(index.nearest(queries, 10, probes=len(index.centres()), condition="label <> 1", excluded=[0, 7], least=0.1))


@query()
def approximate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index as it is meant to be used; tests hold its recall to 0.9."""
    index, queries = _vector_index(spark, sf_dir)
    return _found(index.nearest(queries, 10))


_CHANGED = _BM25.replace(
    _TOKENS,
    """
tok AS (
    SELECT doc_id, regexp_extract_all(lower(CASE WHEN doc_id % 4 = 2 THEN coalesce(text, '') || ' the which' ELSE coalesce(text, '') END), '[\\p{L}\\p{M}\\p{N}_]+') AS terms
    FROM documents WHERE doc_id % 8 <> 7
)""",
).replace("@queries", _values(QUERIES))


def _changed_index(spark: SparkSession, sf_dir: str) -> SegmentedIndex:
    """An index of three quarters of the documents; then the others are added, a quarter is changed, an eighth goes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    index = SegmentedIndex(spark, table_path(spark, "segments"), keep=["lang"])
    index.upsert(docs.filter("doc_id % 4 <> 1"))
    index.upsert(docs.filter("doc_id % 4 = 1"))
    index.upsert(docs.filter("doc_id % 4 = 2").withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" the which"))))
    index.delete(docs.filter("doc_id % 8 = 7"))
    return index


def _bm25_of(index: Index, spark: SparkSession) -> DataFrame:
    scores = keyword.bm25_scores(index, queries_table(spark, QUERIES))
    found = keyword.top_k(scores.withColumn("score", F.round("score", 9)), 20)
    return found.select("qid", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(_CHANGED + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 20")
def bm25_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores over segments and deletions equal those of an index made anew."""
    return _bm25_of(_changed_index(spark, sf_dir).index(), spark)


@query(_CHANGED + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 20")
def bm25_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, once small segments are merged and what nothing names any more is deleted."""
    index = _changed_index(spark, sf_dir)
    index.compact()
    index.vacuum()
    return _bm25_of(index.index(), spark)


@query(_BM25.replace("@queries", _values(QUERIES)) + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 20")
def bm25_after_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index brought back to what the documents are: changes, additions and deletions are found by comparison."""
    index = _changed_index(spark, sf_dir)
    index.sync(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return _bm25_of(index.index(), spark)


@query(f"WITH r AS ({_STANDARD}) SELECT *, CAST(row_number() OVER (ORDER BY fused_score DESC, rrf_score DESC, doc_id) AS INTEGER) AS rank FROM r")
def standard_search_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole search whose vectors come from the stored index, all cells read."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    cells = VectorIndex.build(vectors, table_path(spark, "vectors"), vec_id="doc_id")
    first = _first_vector(spark, sf_dir)
    corpus = search.Corpus(stored_index(spark, sf_dir), cells=cells, probes=len(cells.centres()))
    searcher = search.Searcher({"page": corpus}, lambda texts: [first] * len(texts))
    found = searcher.standard(SearchParams(QUERY, book_limit=20, similarity_cutoff=0.3, fuzzy=False, keyword_gate="none"))["page"]
    return found.select("doc_id", F.round("fused_score", 6).alias("fused_score"), F.round("rrf_score", 6).alias("rrf_score"), "match_type", "rank")


@query(
    f"""WITH r AS (SELECT *, CAST(row_number() OVER (ORDER BY fused_score DESC, rrf_score DESC, doc_id) AS INTEGER) AS rank FROM ({_STANDARD})), m AS ({_fragment_sql("text", QUERY.split())})
SELECT rank, doc_id, fused_score AS score, match_type, substr(text, 1, 300) AS text_snippet, coalesce(highlighted, substr(text, 1, 300)) AS highlighted_snippet
FROM r JOIN documents USING (doc_id) JOIN m USING (doc_id)"""
)
def formatted_with_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with the best fragment of their text, in which the query's terms are marked."""
    params = SearchParams(QUERY, book_limit=20, similarity_cutoff=0.3, fuzzy=False, keyword_gate="none")
    found = _searcher(spark, sf_dir).standard(params)["page"].join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return search.formatted(found, "hybrid", terms=parse_query(QUERY).terms).withColumn("score", F.round("score", 6))

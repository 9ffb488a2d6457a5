"""The queries of the corpus operators and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm import decontaminate, embeddings, html, langid, lines, lm, mixing, quality, search, simhash, tokencount, urls, whitening
from monthmill.llm.tables import remainder

QUERIES = {}
ORACLES = {}


def query(oracle: str | None = None):
    """Register a function under its own name."""

    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document: shingles of 3 words, links at 3 bits."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, bits=3)
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


_LINES_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, line, nr, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query(_LINES_SQL)
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's lines, without the long lines that 5 or more documents share."""
    found = lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"), least=40, documents=5)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_MIX_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat_ws('|', '0', doc_id::VARCHAR, text)) AS k FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM sized GROUP BY source
), fill AS (
  SELECT 0 AS round, source, source_size, w::DOUBLE AS w, 0::DOUBLE AS target, false AS full_ FROM sources
  UNION ALL
  SELECT round + 1, source, source_size, w,
    CASE WHEN full_ THEN target ELSE least(2.0 * source_size, w * level) END,
    full_ OR w * level >= 2.0 * source_size
  FROM (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(target) FILTER (full_) OVER (), 0)) / coalesce(sum(w) FILTER (NOT full_) OVER (), 1) AS level FROM fill)
  WHERE round <= (SELECT count(*) FROM sources)
), targets AS (
  SELECT source, source_size, target FROM fill WHERE round = (SELECT max(round) FROM fill)
), summed AS (
  SELECT doc_id, size, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM sized JOIN targets USING (source)
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  ((whole + CASE WHEN before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM summed
"""


@query(_MIX_SQL)
def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of every document."""
    found = mixing.mix(table(spark, folder, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    return found.select("doc_id", "size", "source_size", "target", "taken")


_LEAKS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
), dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM d, (SELECT DISTINCT n FROM bw) AS l, unnest(range(1, len(w) - n + 2)) AS t(i)
), hit AS (
  SELECT r, i, n, item_id FROM dw JOIN bw USING (n, p)
), words AS (
  SELECT r, count(DISTINCT nr) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS nr FROM hit) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN listed USING (r)
"""


@query(_LEAKS_SQL)
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The words of every document that stand in windows of 10 words of benchmark items."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), length=10)
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels of three quarters of them."""
    docs = table(spark, folder, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, folder, "documents")
    found = langid.identify(docs, langid.fit(docs))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected")


#: The rules of the URL filter.
RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/")]


@query()
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict for the URL of every page: by rule, else by the model."""
    found = urls.judge(table(spark, folder, "pages"), RULES, urls.default_model())
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


@query()
def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, folder, "pages"))


@query()
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Difference of a target and a background model's loss per token, for every document."""
    docs = table(spark, folder, "documents")
    return lm.score(docs, lm.fit(docs, table(spark, folder, "labels").filter("quality = 1")))


@query()
def op10_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings"), least=0.95)


_SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark
), total AS (
  SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), damped AS (
  SELECT r, doc_id, 100 - 90 + (90 * len(w)::BIGINT * n_docs) // n_terms AS m FROM d, total WHERE len(w) > 0
), scored AS (
  SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM (SELECT q, item_id, unnest(w) AS term FROM b) JOIN tf USING (term) JOIN weights USING (term) JOIN damped USING (r) GROUP BY q, r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query(_SEARCH_SQL)
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


@query()
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All complete embeddings on their 32 leading components, scaled to variance 1."""
    found = whitening.whiten(table(spark, folder, "embeddings"), components=32)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


@query()
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds 2,048 tokens."""
    import public_tokenizers

    found = tokencount.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)

"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM d
),
windows AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 4], ' ') AS g FROM w, unnest(range(1, len(ws) - 3)) AS u(p)
),
twice AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
),
repeated AS (
  SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS x FROM twice) GROUP BY doc_id
),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals,
         len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN repeated USING (doc_id)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_capitals > word_chars
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM b
"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.quality import assess

    found = assess(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def token_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.packing import pack, pieces

    cut = pieces(table(spark, sf_dir, "documents"), token_file(), with_ids=False, most_words=1_000_000)
    return pack(cut).withColumnRenamed("id", "doc_id")


@query("op7_sampled_splitters")
def op7_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.sharding import shard

    found = shard(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
),
i AS (
  SELECT item_id, ws, least(13, len(ws)) AS k FROM (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark)
  WHERE len(ws) > 0
),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS g FROM i, unnest(range(1, len(ws) - k + 2)) AS u(p)
),
dw AS (
  SELECT doc_id, p, k, array_to_string(ws[p:p + k - 1], ' ') AS g
  FROM d, (SELECT DISTINCT k FROM iw) AS s, unnest(range(1, len(ws) - k + 2)) AS u(p)
),
hits AS (SELECT doc_id, p, k, item_id FROM dw JOIN iw USING (k, g)),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM hits) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op8_benchmark_passages", OP8_SQL)
def op8_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_text=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.jaccard import jaccard_components

    found = jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.withColumnRenamed("id", "doc_id")


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.lines import dedup_lines

    found = dedup_lines(table(spark, sf_dir, "documents"), min_words=1, max_bits=None)
    return found.select("doc_id", "text", "dropped_lines")


@query("op10_token_attribution")
def op10_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.offsets import section_tokens

    found = section_tokens(table(spark, sf_dir, "documents"), token_file())
    return found.withColumnRenamed("id", "doc_id")


@query("op3_page_text")
def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.pages import extract

    return extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query("op5_warc_derivatives")
def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.warc import derive, responses_of

    found = derive(responses_of(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"))
    return found.withColumn("text", F.when(F.col("type") == "conversion", F.decode("block", "UTF-8"))).drop("block")


@query("op4_kneser_ney")
def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.ngrams import classify

    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


OP11_SQL = r"""
WITH bytes AS (
  SELECT list(c::BIGINT ORDER BY b) AS crc_of FROM (
    WITH RECURSIVE steps(b, k, c) AS (
      SELECT b, 0, b FROM range(256) AS r(b)
      UNION ALL
      SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM steps WHERE k < 8
    )
    SELECT b, c FROM steps WHERE k = 8)
),
texts AS (
  SELECT kind, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark)
),
runs AS (
  SELECT kind, id, array_to_string(ws[p:p + k], ' ') AS feature
  FROM texts, range(3) AS o(k), unnest(range(1, len(ws) - k + 1)) AS u(p)
),
counted AS (SELECT kind, id, feature, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM counted)),
buckets AS (
  SELECT feature, xor(list_reduce(
      list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT),
      lambda a, x: xor(a // 256, crc_of[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM hexed, bytes
),
f AS (SELECT kind, id, bucket, sum(n)::BIGINT AS n FROM counted JOIN buckets USING (feature) GROUP BY ALL),
totals AS (SELECT sum(n) FILTER (kind = 'd')::DOUBLE AS s_all, sum(n) FILTER (kind = 't')::DOUBLE AS t_all FROM f),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s,
               coalesce(sum(n) FILTER (kind = 't'), 0)::DOUBLE AS t FROM f GROUP BY bucket), totals
),
weighed AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM f JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM texts LEFT JOIN weighed USING (id) WHERE kind = 'd'
),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, rank FROM scored
LEFT JOIN (SELECT * FROM drawn WHERE rank <= (SELECT 5 * count(*) // 100 FROM drawn)) USING (doc_id)
"""


@query("op11_importance_resampling", OP11_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.resampling import importance_resample

    found = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: Rules of the query (host, path, verdict): fixed values.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Names of sites that the query lists wherever pages have one of them.
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

OP13_SQL = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
fits AS (
  SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM parts AS p JOIN rules AS r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY n
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN list_has_any(
         CASE WHEN len(string_split(host, '.')) > 2 THEN string_split(host, '.')[-3:-3] ELSE [] END,
         ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (n)
"""


@query("op13_bloom_cascade", OP13_SQL)
def op13_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed keys are the sites (three labels) that any page has under one of the listed names."""
    from docsettle.llm.urls import judge_urls, url_parts

    pages = table(spark, sf_dir, "pages")
    site = F.substring_index(url_parts(F.col("url"))[0], ".", -3)
    sites = pages.select(site.alias("host"), F.lit("").alias("path")).distinct()
    parts = F.split("host", r"\.")
    listed = sites.where((F.size(parts) > 2) & parts[0].isin(LISTED_SITES))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules, listed).withColumnRenamed("id", "page_id")


OP12_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * v.q[i]))::BIGINT AS score
  FROM v AS a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op12_four_russians", OP12_SQL)
def op12_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docsettle.llm.negatives import hard_negatives

    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)

"""One query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm.catalog import query, table
from rillmark.llm.centroids import centroid_clusters
from rillmark.llm.collocations import collocations
from rillmark.llm.decontaminate import decontaminate
from rillmark.llm.exact_dedup import exact_dedup
from rillmark.llm.html_text import extract_text
from rillmark.llm.language_model import language_model_scores
from rillmark.llm.license_scan import license_scan
from rillmark.llm.near_dedup import near_dedup
from rillmark.llm.packing import pack_documents
from rillmark.llm.suffix_dedup import suffix_dedup
from rillmark.llm.token_files import read_token_files, write_token_files
from rillmark.llm.toxicity import toxicity, train
from rillmark.llm.url_filter import RULES, url_filter


@query(
    "op1_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
    FROM d
    """,
)
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"), digest_all=True)


@query(
    "op3_url_filter",
    r"""
    WITH u AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
        FROM pages),
    r(rule, rule_host, rule_path, verdict) AS (VALUES
        ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
        ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
    m AS (
        SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
        FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (page_id)
    """,
)
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages")
    return url_filter(pages, rules, id_col="page_id").select("page_id", "host", "path", "rule", "verdict")


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = write_token_files(table(spark, folder, "documents"), "word_bpe_49k.json", spaces="drop", end_id=1)
    return read_token_files(files)


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), "byte_bpe_50k.json")


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(table(spark, folder, "documents"), words=3, percent=85)


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity(docs, train(docs, table(spark, folder, "labels")))


@query("op7_html_text")
def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(table(spark, folder, "documents"))


PIECE_WORDS = r"""
    SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS ws
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents)"""


@query(
    "op12_collocations",
    rf"""
    WITH w AS ({PIECE_WORDS}),
    g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
          FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(ws) >= k),
    f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
    p AS (SELECT *, string_split(phrase, ' ') AS x FROM f WHERE k > 1),
    held AS (SELECT lang, phrase, max(f) AS longer FROM (
                 SELECT lang, array_to_string(x[1:2], ' ') AS phrase, f FROM p WHERE k = 3
                 UNION ALL SELECT lang, array_to_string(x[2:3], ' '), f FROM p WHERE k = 3) GROUP BY ALL),
    c AS (SELECT lang, phrase, f AS a, x, k, unnest(range(1, k)) AS cut FROM p LEFT JOIN held USING (lang, phrase)
          WHERE longer IS NULL OR 100 * longer < 50 * f),
    s AS (SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, 1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS score
          FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(x[1:cut], ' ')
          JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(x[cut + 1:c.k], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank, phrase, a, l, r, n,
           CAST(score AS BIGINT) AS score
    FROM b JOIN t USING (lang) QUALIFY rank <= 2000
    """,
)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def lloyd_rounds(rounds: int) -> str:
    """Steps of the clustering: assigned vectors and the next centroids, again and again."""
    step = """
    a{n} AS (SELECT vec_id, x, min({{'d': d, 'c': c}}) AS m FROM (
        SELECT vec_id, x, c, CAST(list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{n})
        GROUP BY vec_id, x),"""
    move = """
    u{n} AS (SELECT c, list(v ORDER BY col) AS y FROM (
        SELECT c, col, CAST((s - ((s % n + n) % n)) // n AS BIGINT) AS v FROM (
            SELECT m.c AS c, col, sum(x[col]) AS s, count(*) AS n FROM a{n}, range(1, 65) r(col) GROUP BY ALL)) GROUP BY c),
    c{next} AS (SELECT c, coalesce(u{n}.y, c{n}.y) AS y FROM c{n} LEFT JOIN u{n} USING (c)),"""
    return "".join(step.format(n=n) + (move.format(n=n, next=n + 1) if n < rounds else "") for n in range(rounds + 1))


@query(
    "op13_centroids",
    f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(64 * e::DOUBLE) AS BIGINT)) AS x FROM embeddings
               WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
    c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x AS y
           FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT 16)),
    {lloyd_rounds(3)}
    z AS (SELECT a3.vec_id, a3.m.c AS cluster, a3.m.d AS distance, y FROM a3 JOIN c3 ON c3.c = a3.m.c)
    SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(y, ',')) AS centroid_sha256
    FROM z
    """,
)
def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters(table(spark, folder, "embeddings"))


@query("op11_lm_scores")
def op11_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_model_scores(table(spark, folder, "documents"))

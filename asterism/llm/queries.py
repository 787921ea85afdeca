"""The registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, covertree, decontaminate, fingerprints, htmltext, importance, langid, lines, quality, simhash, substrings, trie, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """The vocabulary file the queries use; ``ASTERISM_VOCABULARY`` names another one."""
    import os

    import public_tokenizers

    return os.environ.get("ASTERISM_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")


@_query
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprinted(_table(spark, folder, "documents"))


@_query
def op2_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_classes(_table(spark, folder, "documents"))


@_query
def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(_table(spark, folder, "documents"), texts_too=False)


ORACLES["op3_substrings"] = """
    WITH words AS (
      SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
    ), runs AS (
      SELECT doc_id, i, list_slice(w, i, i + 12) AS r
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
    ), firsts AS (
      SELECT doc_id, i, min(doc_id) OVER (PARTITION BY r) AS f FROM runs
    ), gone AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM firsts WHERE f < doc_id
    ), placed AS (
      SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
    ), kept AS (
      SELECT p.doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE g.i IS NULL) AS k
      FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY 1
    )
    SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
    FROM words w LEFT JOIN kept USING (doc_id)
"""


@_query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


@_query
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


#: The rules of the query for ``pages``.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@_query
def op6_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    # A page is labelled by the document that its path names; bad is low quality or toxic.
    document = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://[^/?#]*[^?#]*?/(\d{1,18})(?:[./?#]|$)", 1)
    pages = _table(spark, folder, "pages").select("page_id", "url", document.try_cast("long").alias("doc_id"))
    labels = _table(spark, folder, "labels").groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long")).alias("bad")
    )
    found = urls.judged(pages.join(labels, "doc_id", "left"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@_query
def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.with_main_text(_table(spark, folder, "pages").select("page_id", "url", "html")).drop("html")


@_query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return bpe.with_encoding(documents.select("doc_id", "text"), vocabulary()).drop("text")


@_query
def op10_langid(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").withColumn("held_out", langid.held_out())
    model = langid.fit(documents.where("not held_out and doc_id is not null"))
    found = langid.with_language(documents.select("doc_id", "held_out", "text"), model)
    return found.drop("text")


#: CRC-32 has no function in SQL: its table of 256 numbers, made bit by bit, and the checksum of a list of bytes.
CRC_TABLE_SQL = """crcs AS (
      SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
        ELSE c >> 1 END, i)) AS crc
    )"""
CRC_SQL = "xor(list_reduce({bytes}, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


@_query
def op11_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.importance(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")).drop("n_words")


ORACLES["op11_importance"] = f"""
    WITH {CRC_TABLE_SQL}, texts AS (
      SELECT 'd' AS side, doc_id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 'b', NULL, coalesce(text, '') FROM benchmark
    ), words AS (
      SELECT side, doc_id, row_number() OVER () AS n, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
    ), runs AS (
      SELECT side, n, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS run FROM words
    ), counted AS (
      SELECT side, n, run, count(*) AS c FROM runs GROUP BY ALL
    ), coded AS (
      SELECT run, hex(encode(run)) AS code FROM counted GROUP BY run
    ), buckets AS (
      SELECT run, {CRC_SQL.format(bytes="list_transform(range(len(code) // 2), lambda i: ('0x' || code[2 * i + 1:2 * i + 2])::BIGINT)")} % 10000 AS bucket
      FROM coded, crcs
    ), sums AS (
      SELECT bucket, coalesce(sum(c) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (WHERE side = 'b'), 0)::DOUBLE AS t
      FROM counted JOIN buckets USING (run) GROUP BY 1
    ), totals AS (
      SELECT sum(s) AS ss, sum(t) AS tt FROM sums
    ), gains AS (
      SELECT bucket, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS gain FROM sums, totals
    ), means AS (
      SELECT n, sum(c)::BIGINT AS n_features, floor(sum(c * gain)::DOUBLE / sum(c))::BIGINT AS weight
      FROM counted JOIN buckets USING (run) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY 1
    ), scored AS (
      SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM words LEFT JOIN means USING (n) WHERE side = 'd'
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS r,
        count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= 25 * n // 100 THEN r END AS rank FROM ranked
"""


@_query
def op12_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.near_vectors(_table(spark, folder, "embeddings"))


ORACLES["op12_near_vectors"] = """
    WITH RECURSIVE rows AS (
      SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v,
        label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0 AS valid FROM embeddings
    ), links AS (
      SELECT a.r AS a, b.r AS b FROM rows a JOIN rows b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
      WHERE a.valid AND b.valid AND list_cosine_similarity(a.v, b.v) >= 0.98
    ), reach AS (
      SELECT r AS a, r AS b FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), classes AS (
      SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.b GROUP BY 1
    ), degrees AS (
      SELECT a AS r, count(*) AS n FROM links GROUP BY 1
    )
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM rows JOIN classes USING (r) LEFT JOIN degrees USING (r)
"""


@_query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(_table(spark, folder, "conversations"))


ORACLES["op13_prefix_trie"] = f"""
    WITH {CRC_TABLE_SQL}, turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    ), own AS (
      SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || strlen(text) || ':' || text)) AS s
      FROM turns GROUP BY 1
    ), firsts AS (
      SELECT conv_id, s, {CRC_SQL.format(bytes="list_transform(string_split(conv_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)")} % 9 AS h
      FROM own, crcs
    ), made AS (
      SELECT c.conv_id, list_concat(coalesce(b.s, [])[1:c.h], c.s[c.h + 1:]) AS s FROM firsts c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
    ), starts AS (
      SELECT conv_id, s[1:d] AS p, d, len(s) AS n FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM made)
    ), nodes AS (
      SELECT p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256,
        (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(p[d].text) END AS saved FROM starts GROUP BY p, d
    ), children AS (
      SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
    ), counted AS (
      SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)
    ), totals AS (
      SELECT p[1:a] AS p, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(depth + 1)) AS a FROM counted) GROUP BY 1
    )
    SELECT x.conv_id, x.depth::BIGINT AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children::BIGINT AS n_children,
      t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
    FROM counted x JOIN totals t USING (p) LEFT JOIN nodes y ON x.depth > 0 AND y.p = x.p[1:x.depth - 1]
"""

"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    classifier, decontaminate, fingerprints, neardup, packing, pii, quality_rules, secrets, token_files, tokens, vector_codes,
    warc, whitening,
)
from .common import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokens.vocabulary())


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_decode(_documents(spark, sf_dir), tokens.vocabulary())


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(_documents(spark, sf_dir))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_read(table(spark, sf_dir, "pages"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(_documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_read(_documents(spark, sf_dir), tokens.vocabulary())


def op10_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.quantize(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_packing, op2_pii, op3_bpe, op4_fingerprints, op5_secrets, op6_warc, op7_neardup,
        op8_quality_rules, op9_token_files, op10_classifier, op11_decontaminate, op12_vector_codes,
        op13_whitening,
    )
}

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), '{_WORD}')"


def _round(n: int) -> str:
    """Assignments to the codebook c{n}, and the codebook after them."""
    return f"""
a{n} AS (SELECT p.vec_id, p.part, any_value(p.x) AS x, min({{'d': list_sum(list_transform(list_zip(p.x, c.c),
    lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': c.entry}}) AS best
  FROM p JOIN c{n} c ON p.part = c.part GROUP BY p.vec_id, p.part),
s{n} AS (SELECT part, best.e AS entry, k, sum(x[k + 1])::BIGINT AS s, count(*) AS m
  FROM a{n}, range((SELECT w FROM width)) r(k) GROUP BY ALL),
c{n + 1} AS (SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM c{n} c LEFT JOIN (SELECT part, entry,
    list((s - ((s % m) + m) % m) // m ORDER BY k) AS c FROM s{n} GROUP BY part, entry) m
  ON c.part = m.part AND c.entry = m.entry)"""


#: SQL can't express tokenizers, trained models, signatures, places of matches or
#: eigenvectors.
ORACLE_SQL: dict[str, str] = {
    "op6_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
  max(page_id) OVER (PARTITION BY h) AS largest FROM p),
r AS (SELECT *, payload_bytes >= 1000 AND page_id <> largest AS again FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN largest END AS refers_to FROM r""",
    "op11_decontaminate": f"""WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
g AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS n
  FROM b, range(1, greatest(len(w) - 9, 1) + 1) r(i) WHERE len(w) > 0),
t AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM g),
  range(1, len(w) - n + 2) r(i)),
h AS (SELECT doc_id, i, t.n, item FROM t JOIN g ON t.g = g.g AND t.n = g.n),
k AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM h, range(i, i + n) r(j) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN m ON d.doc_id = m.doc_id""",
    "op12_vector_codes": f"""WITH v AS (SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
width AS (SELECT max(len(v)) // 16 AS w FROM v),
p AS (SELECT vec_id, part, list_transform(v[part * w + 1:(part + 1) * w],
    lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM v, width, range(16) r(part)),
c0 AS (SELECT part, entry, x AS c FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry
  FROM p) WHERE entry < 64),{_round(0)},{_round(1)},{_round(2)},
r AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a2 GROUP BY vec_id)
SELECT r.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c2) AS codebooks_sha256
FROM r JOIN v ON r.vec_id = v.vec_id""",
}

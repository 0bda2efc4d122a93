"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.anchors import vector_codes
from tablewright.llm.byte_bpe import encode_decode
from tablewright.llm.common import id_remainder
from tablewright.llm.context_mixing import score_texts
from tablewright.llm.hypervectors import held_out_languages
from tablewright.llm.licenses import scan_licenses
from tablewright.llm.mtree import top_k
from tablewright.llm.packing import pack
from tablewright.llm import secrets
from tablewright.llm.projections import near_duplicate_vectors
from tablewright.llm.secrets import STRONG, find_secrets
from tablewright.llm.simhash import near_duplicates
from tablewright.llm.token_counts import count_tokens
from tablewright.llm.toxicity import THRESHOLD, score_toxicity
from tablewright.llm.whitening import whiten

TOKEN_LIMIT = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, kinds = F.col("findings"), F.array(*map(F.lit, STRONG))
    base = F.filter(found, lambda x: F.array_contains(kinds, x["kind"]))

    def listed(findings):
        return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def number(kind):
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", *map(number, STRONG), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(found).alias("spans")
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), bigrams=True)
    return scored.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score is 1 where a phrase or mention stands, else the best notice's share of letters that are not edited."""
    exact, fuzzy, mentioned = F.col("exact"), F.col("fuzzy"), F.col("mentioned")

    def labels(*found):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*(x["label"] for x in found)))), ",")

    similar = F.array_max(F.transform(fuzzy, lambda x: 1 - x["edits"] / x["letters"]))
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(exact).cast("long").alias("n_base"),
        F.array_min(exact["first"]).alias("first_word"),
        F.array_max(exact["first"]).alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(exact, fuzzy, mentioned).alias("labels"),
        F.when(F.size(exact) + F.size(mentioned) > 0, 1.0).otherwise(F.coalesce(similar, F.lit(0.0))).alias("score"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_languages(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_toxicity": op4_toxicity,
    "op5_license_scans": op5_license_scans,
    "op6_token_counts": op6_token_counts,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_language_id": op13_language_id,
}


def _sql_pattern(pattern: str) -> str:
    """A pattern as a SQL literal; its letters in either case are written out, as (?i) would fold others, too."""
    folded, pattern = pattern.startswith("(?i)"), pattern.removeprefix("(?i)")
    if folded:
        letters = re.compile(r"\\x[0-9a-fA-F]{2}|\[[^]]*\]|[A-Za-z]")
        pattern = letters.sub(lambda m: f"[{m[0].upper()}{m[0].lower()}]" if len(m[0]) == 1 else m[0], pattern)
    return "'" + pattern.replace("'", "''") + "'"


def _scan_sql(scan: str, pattern: str) -> str:
    literal = _sql_pattern(pattern)
    return f"""SELECT rid, '{scan}' AS scan, regexp_extract_all(t, {literal}) AS found,
      regexp_split_to_array(t, {literal}) AS gaps FROM docs"""


ASSIGN_VALUE_SQL = f"length(regexp_extract(match, {_sql_pattern(secrets.SCANS['assign'])}, 2))"

#: Plain pairs of a candidate and its complements, where the operator joins stretches.
SECRETS_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
scans AS ({" UNION ALL ".join(_scan_sql(*scan) for scan in secrets.SCANS.items())}),
numbered AS (
  SELECT rid, scan, unnest(found) AS match, unnest(gaps[1:len(found)]) AS gap, unnest(range(len(found))) AS place
  FROM scans WHERE len(found) > 0),
placed AS (
  SELECT rid, scan, match,
    CAST(sum(length(gap) + length(match)) OVER (PARTITION BY rid, scan ORDER BY place) AS BIGINT) AS stop
  FROM numbered),
kinds AS (
  SELECT rid, stop - length(match) AS start, stop, CASE
      WHEN scan = 'assign' AND {ASSIGN_VALUE_SQL} >= {secrets.ASSIGN_LENGTH} THEN 'assign'
      WHEN scan = 'assign' AND {ASSIGN_VALUE_SQL} >= {secrets.SHORT_LENGTH} THEN 'key'
      WHEN scan = 'bare' AND length(match) <= {secrets.BARE_LENGTH} AND regexp_matches(match, '[0-9]')
        AND regexp_matches(match, '[A-Z]') AND regexp_matches(match, '[a-z]') THEN 'key'
      WHEN scan NOT IN ('assign', 'bare') THEN scan END AS kind
  FROM placed),
spans AS (
  SELECT DISTINCT rid, start, stop, kind, list_position({list(secrets.ROLES)}, kind) AS place,
    {list(secrets.ROLES.values())}[list_position({list(secrets.ROLES)}, kind)] AS part
  FROM kinds WHERE kind IS NOT NULL),
complements AS (
  SELECT s.rid, s.start, s.stop, s.kind, s.place, s.part, count(DISTINCT o.part) AS n
  FROM spans s JOIN spans o ON o.rid = s.rid AND abs(o.start - s.start) <= {secrets.SCOPE} AND CASE s.part
      WHEN 'secret' THEN o.part = 'account' WHEN 'account' THEN o.part = 'secret' ELSE o.part <> 'endpoint' END
  GROUP BY ALL),
reported AS (
  SELECT rid, start, stop, kind, place FROM spans WHERE kind IN ('assign', 'access', 'hex')
  UNION
  SELECT rid, start, stop, kind, place FROM complements
  WHERE kind NOT IN ('assign', 'access', 'hex') AND n >= CASE part WHEN 'endpoint' THEN 2 ELSE 1 END),
lists AS (
  SELECT rid, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop) AS spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop)
      FILTER (kind IN ('assign', 'access', 'hex')) AS base,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex
  FROM reported GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (rid)
"""

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""



def _round_sql(k: int) -> str:
    """Round ``k``: the nearest entry of every part, and the codebook that follows from the parts."""
    return f"""
near{k} AS (
  SELECT rid, part, arg_min(entry, (error, entry)) AS entry, min(error) AS error
  FROM (SELECT rid, part, entry, sum((x - c) * (x - c)) AS error FROM cells JOIN book{k} USING (part, place) GROUP BY ALL)
  GROUP BY ALL),
means{k} AS (
  SELECT part, entry, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS c
  FROM near{k} JOIN cells USING (rid, part) GROUP BY ALL),
book{k + 1} AS (
  SELECT b.part, b.entry, b.place, coalesce(m.c, b.c) AS c
  FROM book{k} b LEFT JOIN means{k} m USING (part, entry, place))"""


#: Every part against every entry, where the operator asks balls.
VECTOR_CODES_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (
  SELECT rid, d // (len(v) // 16) AS part, d % (len(v) // 16) AS place, v[d + 1] AS x
  FROM (SELECT rid, v, unnest(range(len(v))) AS d FROM kept)),
seeds AS (SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM kept ORDER BY vec_id, v LIMIT 64),
book0 AS (SELECT part, entry, place, x AS c FROM cells JOIN seeds USING (rid)),{_round_sql(0)},{_round_sql(1)},{_round_sql(2)},
digest AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book2),
codes AS (
  SELECT rid, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM near2 GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (rid) CROSS JOIN digest
"""

SQL: dict[str, str] = {
    "op1_secret_scans": SECRETS_SQL,
    "op7_exact_top_k": TOP_K_SQL,
    "op12_vector_codes": VECTOR_CODES_SQL,
}

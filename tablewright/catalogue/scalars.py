"""String, arithmetic and cast functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.functions import arithmetic as M
from tablewright.functions import text as S
from tablewright.functions.chance import seeded_uniform
from tablewright.operators.names import named


@query(
    "str_remove_non_word",
    r"""
    SELECT doc_id, md5(regexp_replace(text, '[^\w\s]+', '', 'g')) AS clean_md5,
           CAST(length(regexp_replace(text, '[^\w\s]+', '', 'g')) AS INTEGER) AS clean_length
    FROM documents
    """,
)
def remove_non_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = S.remove_non_word_characters(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(clean).alias("clean_md5"), F.length(clean).alias("clean_length")
    )


@query(
    "str_concat_ws",
    """
    SELECT c_custkey,
           concat_ws(' ', c_name, nullif(c_mktsegment, 'BUILDING')) AS label,
           concat_ws(' ', nullif(c_mktsegment, 'BUILDING')) AS segment
    FROM customer
    """,
)
def concat_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        S.join_text(F.col("c_name"), segment).alias("label"),
        S.join_text(segment).alias("segment"),
    )


@query("str_upper", "SELECT p_partkey, upper(p_name) AS name FROM part")
def upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("name"))


@query(
    "str_split",
    """
    SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS INTEGER) AS pieces,
           string_split(text, ' ')[1] AS first_piece, string_split(text, ' ')[-1] AS last_piece
    FROM conversations
    """,
)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = S.split_fields(F.col("text"), " ")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.size(pieces).alias("pieces"),
        F.get(pieces, F.lit(0)).alias("first_piece"),
        F.element_at(pieces, -1).alias("last_piece"),
    )


@query(
    "str_title",
    """
    SELECT p_partkey,
           list_aggregate(list_transform(string_split(p_name, ' '),
                          lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS title
    FROM part
    """,
)
def title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", S.title(F.col("p_name")).alias("title"))


@query("math_multiply", "SELECT c_custkey, c_nationkey * 21 AS steps FROM customer")
def multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", M.multiply(F.col("c_nationkey"), 21).alias("steps")
    )


@query("math_divide", "SELECT c_custkey, c_nationkey / 3 AS third FROM customer")
def divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", M.divide_by_three(F.col("c_nationkey")).alias("third")
    )


@query(
    "math_safe_divide",
    """
    SELECT c_custkey, CAST(NULL AS DOUBLE) AS by_zero,
           c_acctbal / nullif(c_nationkey, 0) AS by_nation
    FROM customer
    """,
)
def safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        M.divide_by_zero(F.col("c_acctbal")).alias("by_zero"),
        M.divide(F.col("c_acctbal"), F.col("c_nationkey")).alias("by_nation"),
    )


@query(
    "cast_array_int",
    """
    SELECT o_orderkey, numbers[1] AS first_number, numbers[2] AS second_number,
           CAST(len(numbers) AS INTEGER) AS size
    FROM (SELECT o_orderkey,
                 list_transform(string_split(o_orderpriority, '-'), lambda x: TRY_CAST(x AS INTEGER))
                     AS numbers
          FROM orders)
    """,
)
def cast_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    # "1-URGENT" gives [1, NULL]: a bad element spoils neither its array nor the job.
    numbers = table(spark, sf_dir, "orders").select(
        "o_orderkey", M.cast_array(S.split_fields(F.col("o_orderpriority"), "-")).alias("numbers")
    )
    return numbers.select(
        "o_orderkey",
        F.get("numbers", F.lit(0)).alias("first_number"),
        F.get("numbers", F.lit(1)).alias("second_number"),
        F.size("numbers").alias("size"),
    )


@query(
    "math_seeded_uniform",
    """
    SELECT o_orderkey,
           CAST(('0x' || substr(md5('42-' || o_orderkey), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE
               AS uniform
    FROM orders
    """,
)
def uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", seeded_uniform(42, named("o_orderkey")).alias("uniform")
    )

"""Array functions and words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.catalogue.registry import query, table
from tablewright.functions import arrays as A
from tablewright.functions.arithmetic import cast_array
from tablewright.functions.text import split_fields
from tablewright.operators.aggregates import group_count
from tablewright.operators.words import explode_array, words_of

SEED = 42
STATUSES = ("F", "O", "P")
# Topics of keywords, and the SQL lists of the same words.
TOPICS = (("the", "and", "of"), ("is", "are"), ("la", "le", "un", "que"))


@query(
    "array_build",
    """
    SELECT o_orderkey, concat_ws('|', o_orderstatus, coalesce(nullif(o_orderpriority, '5-LOW'), '?'),
                                 'lit') AS parts
    FROM orders
    """,
)
def build(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.array(
        F.col("o_orderstatus"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("lit")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.array_join(parts, "|", "?").alias("parts")
    )


@query(
    "array_choice_seeded",
    """
    SELECT doc_id,
           words[CAST(('0x' || substr(md5('42-' || doc_id), 1, 8)) AS BIGINT) % len(words) + 1]
               AS word
    FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
    """,
)
def choice_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = split_fields(F.col("text"), " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id", A.array_choice(words, F.col("doc_id"), seed=SEED).alias("word")
    )


@query(
    "array_choice_columns",
    """
    SELECT o_orderkey,
           [o_orderstatus, o_orderpriority, nullif(o_orderstatus, 'F')]
           [CAST(('0x' || substr(md5('42-' || o_orderkey), 1, 8)) AS BIGINT) % 3 + 1] AS pick
    FROM orders
    """,
)
def choice_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = [
        F.col("o_orderstatus"),
        F.col("o_orderpriority"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")),
    ]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", A.choice_of_columns(candidates, F.col("o_orderkey"), seed=SEED).alias("pick")
    )


@query(
    "array_choice_literals",
    """
    SELECT o_orderkey,
           ['F', 'O', 'P']
           [CAST(('0x' || substr(md5('42-' || coalesce(nullif(o_custkey, 7)::VARCHAR, '')), 1, 8))
            AS BIGINT) % 3 + 1] AS status
    FROM orders
    """,
)
def choice_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A row whose key is NULL gets one, too.
    key = F.nullif(F.col("o_custkey"), F.lit(7))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", A.choice_of_values(STATUSES, key, seed=SEED).alias("status")
    )


@query(
    "array_mean",
    """
    SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding), 4)
               AS mean
    FROM embeddings
    """,
)
def mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(A.array_mean(F.col("embedding")), 4).alias("mean")
    )


@query(
    "array_forall",
    """
    SELECT vec_id, len(list_filter(embedding, lambda x: x >= -0.25)) = len(embedding) AS above
    FROM embeddings
    """,
)
def forall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", A.array_all_at_least(F.col("embedding"), -0.25).alias("above")
    )


@query(
    "array_explode",
    """
    SELECT label, count(*) AS elements, max(x)::DOUBLE AS greatest
    FROM (SELECT label, unnest(embedding) AS x FROM embeddings)
    GROUP BY label
    """,
)
def explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "embeddings")
        .transform(lambda df: explode_array(df.select("label", "embedding"), "embedding", "x"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("elements"), F.max("x").cast("double").alias("greatest"))
    )


@query(
    "array_keyword_hits",
    """
    SELECT doc_id,
           len(list_filter(words, lambda w: w IN ('the', 'and', 'of')))::INTEGER AS articles,
           len(list_filter(words, lambda w: w IN ('is', 'are')))::INTEGER AS verbs,
           len(list_filter(words, lambda w: w IN ('la', 'le', 'un', 'que')))::INTEGER AS romance
    FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
    """,
)
def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "documents").select(
        "doc_id", A.keyword_hits(split_fields(F.col("text"), " "), TOPICS).alias("hits")
    )
    return counted.select(
        "doc_id",
        *(F.col("hits")[i].alias(t) for i, t in enumerate(("articles", "verbs", "romance"))),
    )


@query(
    "text_flatmap_words",
    """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY word
    """,
)
def flatmap_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(words_of(table(spark, sf_dir, "documents"), "text"), ["word"], "n")


@query(
    "array_cast_numbers",
    """
    SELECT vec_id, list_sum(list_transform(embedding, lambda x: trunc(x * 100::FLOAT)::BIGINT))::BIGINT AS total
    FROM embeddings
    """,
)
def cast_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Floats to whole numbers, cut off towards zero.
    hundredfold = F.transform("embedding", lambda x: x * F.lit(100).cast("float"))
    total = F.aggregate(cast_array(hundredfold, "int"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return table(spark, sf_dir, "embeddings").select("vec_id", total.alias("total"))


SYLLABLES = "an th er in re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve the ing".split()
#: A thousand topics of one to three words, most of them made of two syllables.
MANY_TOPICS = [
    [
        SYLLABLES[n % 32] + SYLLABLES[n // 32],
        SYLLABLES[n * 7 % 32] + SYLLABLES[n * 3 % 31],
        SYLLABLES[n // 40],
    ][: 1 + n % 3]
    for n in range(1000)
]


def _many_topics_sql() -> str:
    pairs = sorted({(word, n) for n, words in enumerate(MANY_TOPICS) for word in words})
    return f"""
    WITH topics(word, topic) AS (VALUES {", ".join(f"('{w}', {n})" for w, n in pairs)}),
    words AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
    hits AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL),
    counts AS (SELECT doc_id, topic, sum(n) AS n FROM hits JOIN topics USING (word) GROUP BY ALL)
    SELECT doc_id, CAST(count(topic) AS INTEGER) AS topics, CAST(coalesce(sum(n), 0) AS BIGINT) AS hits,
           CAST(coalesce(sum(n * (topic + 1)), 0) AS BIGINT) AS weighted
    FROM documents LEFT JOIN counts USING (doc_id) GROUP BY doc_id
    """


@query("array_keyword_hits_many", _many_topics_sql())
def keyword_hits_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    # How many of a thousand topics a document hits, how often, and a sum that knows which.
    counted = table(spark, sf_dir, "documents").select(
        "doc_id", A.keyword_hits(split_fields(F.col("text"), " "), MANY_TOPICS).alias("hits")
    )

    def total(values):
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return counted.select(
        "doc_id",
        F.size(F.filter("hits", lambda x: x > 0)).alias("topics"),
        total(F.col("hits")).alias("hits"),
        total(F.transform("hits", lambda x, i: x * (i + 1))).alias("weighted"),
    )

"""Inputs of the package derived from the driver's tables: corpus, stop words, ratings, postings, texts, vectors.

Every view takes all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.sources.text_files import tagged_corpora

STOP_WORDS = [
    "and", "be", "for", "in", "is", "it", "of", "that", "the", "to", "with",
    "das", "den", "der", "die", "ein", "ist", "und",
    "a", "de", "el", "en", "la", "los", "que", "una", "y",
    "dans", "et", "le", "les", "qui", "un", "une",
]

# Tag of a question by order priority and status; 5-LOW has none, 4-NOT SPECIFIED one outside the domain list.
TAGS = {
    ("1-URGENT", "F"): "Security",
    ("1-URGENT", "O"): "Algorithm",
    ("1-URGENT", "P"): "Architecture",
    ("2-HIGH", "F"): "Machine-Learning",
    ("2-HIGH", "O"): "Silicon Valley",
    ("2-HIGH", "P"): "Embedded-System",
    ("3-MEDIUM", "F"): "Programming-Language",
    ("3-MEDIUM", "O"): "Cloud-services",
    ("3-MEDIUM", "P"): "Deep-learning",
    ("4-NOT SPECIFIED", None): "Quantum",
}

SEED = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, text)``: documents against conversations."""
    return tagged_corpora(
        table(spark, sf_dir, "documents").select("text"), table(spark, sf_dir, "conversations").select("text")
    )


def stop_words(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.lit(STOP_WORDS)).alias("word"))


# Lines of a partition, from 16 times as many lines on.
ROWS = 1 << 18


def _with_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """``lines`` joined with ``orders``. Many are dealt to as many partitions as give each some ``ROWS`` lines, so that later
    steps in the task of the join do not grow with the table."""
    parts = -(-lines.count() // ROWS)
    if parts > 16:
        lines, orders = lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is a customer's rating of a brand by quantity; customers rate brands repeatedly."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        _with_orders(lines, orders)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").cast("int").alias("user"),
            F.substring_index("p_brand", "#", -1).cast("int").alias("item"),
            F.col("l_quantity").alias("score"),
        )
    )


def part_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of single parts, whose numbers are spread out: many items, most of them rated by few.

    Items are ``int`` unless the largest is none: numbers of many parts need ``bigint``.
    """
    item = F.col("l_partkey").cast("bigint") * 5003
    ends = table(spark, sf_dir, "lineitem").agg(F.min(item), F.max(item)).first()
    fits = all(-(2**31) <= (end or 0) < 2**31 for end in ends)
    return _line_ratings(spark, sf_dir, item, "int" if fits else "bigint")


def supplier_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of suppliers."""
    return _line_ratings(spark, sf_dir, F.col("l_suppkey"))


def _line_ratings(spark: SparkSession, sf_dir: str, item: Column, kind: str = "int") -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", item.cast(kind).alias("item"), F.col("l_quantity").alias("score"))
    joined = _with_orders(lines, orders)
    return joined.select(F.col("o_custkey").cast("int").alias("user"), "item", "score")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are questions, their line items answers."""
    tag = F.lit(None).cast("string")
    for (priority, status), name in TAGS.items():
        match = F.col("o_orderpriority") == priority
        tag = F.when(match if status is None else match & (F.col("o_orderstatus") == status), name).otherwise(tag)
    questions = table(spark, sf_dir, "orders").select(
        F.lit(1).alias("posting_type"),
        F.col("o_orderkey").cast("int").alias("id"),
        F.lit(None).cast("int").alias("parent_id"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("score"),
        tag.alias("tags"),
    )
    answers = table(spark, sf_dir, "lineitem").select(
        F.lit(2).alias("posting_type"),
        F.col("l_partkey").cast("int").alias("id"),
        F.col("l_orderkey").cast("int").alias("parent_id"),
        (F.floor(F.col("l_extendedprice") / 100) - 500).cast("int").alias("score"),
        F.lit(None).cast("string").alias("tags"),
    )
    return questions.unionByName(answers)


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings as ``user,item,score`` lines."""
    return ratings(spark, sf_dir).select(
        F.concat_ws(",", *[F.col(c).cast("string") for c in ("user", "item", "score")]).alias("value")
    )


def timed_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings as ``user,item,score,time`` lines; the time is the day of the order with its number and that of the line."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = _with_orders(lines, orders).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    time = F.concat_ws("-", F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lpad(F.col("l_linenumber").cast("string"), 4, "0"))
    return joined.select(F.concat_ws(",", "o_custkey", F.substring_index("p_brand", "#", -1), "l_quantity", time).alias("value"))


def mixed_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating lines among lines that are none: orders (a word for the item), customers (a name for the user), suppliers (too short)."""
    bad = [("orders", "o_custkey", "o_orderpriority", "o_orderkey"), ("customer", "c_name", "c_custkey", "c_nationkey"), ("supplier", "s_suppkey", "s_nationkey")]
    lines = rating_lines(spark, sf_dir)
    for name, *columns in bad:
        lines = lines.unionByName(table(spark, sf_dir, name).select(F.concat_ws(",", *columns).alias("value")))
    return lines


def posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings as ``type,id,[parent],score[,tag]`` lines; untagged questions end in an empty field."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("posting_type", "id", "parent_id", "score")]
    tag = F.when(F.col("posting_type") == 1, F.concat(F.lit(","), F.coalesce("tags", F.lit("")))).otherwise("")
    return postings(spark, sf_dir).select(F.concat(F.concat_ws(",", *parts), tag).alias("value"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")

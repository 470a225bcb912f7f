"""Plain text: corpora, stop words, headerless CSV texts, and key/value text out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line."""
    return spark.read.text(path)


def read_corpora(spark: SparkSession, path1: str, path2: str) -> DataFrame:
    """Lines of two corpora as ``(source, text)``, source 0 and 1."""
    return tagged_corpora(read_lines(spark, path1), read_lines(spark, path2))


def tagged_corpora(texts1: DataFrame, texts2: DataFrame) -> DataFrame:
    """Two one-column DataFrames of texts as one ``(source, text)``."""

    def tagged(texts: DataFrame, source: int) -> DataFrame:
        return texts.select(F.lit(source).alias("source"), F.col(texts.columns[0]).alias("text"))

    return tagged(texts1, 0).unionByName(tagged(texts2, 1))


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One ``word`` per line, as it stands; a missing file fails the query."""
    return read_lines(spark, path).select(F.col("value").alias("word"))


def read_csv_texts(spark: SparkSession, path: str, position: int = 5) -> DataFrame:
    """The column at ``position`` of a headerless CSV file, named ``text``."""
    schema = ", ".join(f"_c{i} string" for i in range(position + 1))
    return spark.read.csv(path, schema=schema, header=False).select(F.col(f"_c{position}").alias("text"))


def write_key_values(df: DataFrame, path: str, key: str, *values: str, order_by: Column | None = None) -> None:
    """Write ``key<TAB>value[,value…]`` lines, an empty string for NULL.

    ``order_by`` sorts across all part files by range partitioning.
    """
    if order_by is not None:
        df = df.orderBy(order_by)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *values)]
    df.select(F.concat(parts[0], F.lit("\t"), F.concat_ws(",", *parts[1:])).alias("value")).write.text(path)

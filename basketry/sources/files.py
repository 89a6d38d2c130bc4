"""File and table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.functions import parse_rating_fields


def delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    """Raw string fields of an unquoted delimited file; a short row has NULL fields at its end."""
    return spark.read.schema(schema).option("sep", sep).option("quote", "").csv(path)


def typed_products(raw: DataFrame) -> DataFrame:
    """Product rows from raw file fields; an unusable id becomes NULL."""
    return raw.select(
        F.trim("id").try_cast("int").alias("productId"),
        *[F.trim(c).alias(c) for c in ("name", "imageUrl", "categories", "tags")],
    )


def typed_ratings(raw: DataFrame) -> DataFrame:
    """Rating rows from raw file fields; an unusable field becomes NULL."""
    return raw.select(
        F.trim("userId").try_cast("int").alias("userId"),
        F.trim("productId").try_cast("int").alias("productId"),
        F.trim("score").try_cast("double").alias("score"),
        F.trim("timestamp").try_cast("bigint").alias("timestamp"),
    )


def accepted(df: DataFrame) -> DataFrame:
    """Rows with every field present."""
    return df.dropna("any")


def quarantined(df: DataFrame) -> DataFrame:
    """Rows with at least one missing field: the complement of :func:`accepted`."""
    missing = F.lit(False)
    for name in df.columns:
        missing = missing | F.col(name).isNull()
    return df.where(missing)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return accepted(typed_products(delimited(spark, path, schemas.PRODUCT_FILE, "^")))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return accepted(typed_ratings(delimited(spark, path, schemas.RATING_FILE, ",")))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with its known schema, so no footer has to be opened to plan the query."""
    return spark.read.schema(schema).parquet(path)


def parse_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed rating columns of ``userId|productId|score|timestamp`` messages."""
    return lines.select(*parse_rating_fields(F.col(column)))

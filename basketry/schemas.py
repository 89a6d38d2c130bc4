"""Table schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT_FILE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("categoryIds", T.StringType()),
        T.StructField("amazonId", T.StringType()),
        T.StructField("imageUrl", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("tags", T.StringType()),
    ]
)

RATING_FILE = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("productId", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

PRODUCT = T.StructType(
    [
        T.StructField("productId", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("imageUrl", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("tags", T.StringType()),
    ]
)

RATING = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("productId", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

RECOMMENDATION = T.StructType(
    [
        T.StructField("productId", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)

RECENT_LISTS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("recents", T.ArrayType(T.StructType(RATING.fields[1:]))),
    ]
)

USER_RECS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("recs", T.ArrayType(RECOMMENDATION)),
    ]
)

PRODUCT_RECS = T.StructType(
    [
        T.StructField("productId", T.IntegerType()),
        T.StructField("recs", T.ArrayType(RECOMMENDATION)),
    ]
)

USER = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("username", T.StringType()),
        T.StructField("first", T.BooleanType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("prefGenres", T.ArrayType(T.StringType())),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns; an int column out of range fails the job (ANSI cast)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

"""Text formats: log lines, rating messages, recent-rating entries, tag lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker that precedes a rating in the application log.
LOG_MARKER = "PRODUCT_RATING_PREFIX:"


def has_marker(line: Column, marker: str = LOG_MARKER) -> Column:
    return F.contains(line, F.lit(marker))


def after_marker(line: Column, marker: str = LOG_MARKER) -> Column:
    """Trimmed text between the first marker and the next one or the end; '' if there is none."""
    return F.trim(F.get(F.split(line, rf"\Q{marker}\E"), F.lit(1)))


def parse_rating_fields(message: Column) -> list[Column]:
    """``userId|productId|score|timestamp`` as typed columns; a bad field is NULL."""
    parts = F.split(message, r"\|")

    def part(i: int) -> Column:
        return F.trim(F.get(parts, F.lit(i)))

    return [
        part(0).try_cast("int").alias("userId"),
        part(1).try_cast("int").alias("productId"),
        part(2).try_cast("double").alias("score"),
        part(3).try_cast("bigint").alias("timestamp"),
    ]


def log_line(user: Column, product: Column, score: Column, timestamp: Column) -> Column:
    """The marked line the web tier writes for one rating."""
    fields = F.concat_ws("|", *[c.cast("string") for c in (user, product, score, timestamp)])
    return F.concat(F.lit(LOG_MARKER), fields)


def recent_entry(product: Column, score: Column) -> Column:
    return F.concat_ws(":", product.cast("string"), score.cast("string"))


def parse_recent_entry(entry: Column) -> Column:
    parts = F.split(entry, ":")
    return F.struct(
        F.trim(F.get(parts, F.lit(0))).try_cast("int").alias("productId"),
        F.trim(F.get(parts, F.lit(1))).try_cast("double").alias("score"),
    )


def split_list(text: Column) -> Column:
    """A ``|``-separated list without blank members."""
    return F.filter(F.transform(F.split(text, r"\|"), lambda t: F.trim(t)), lambda t: t != "")

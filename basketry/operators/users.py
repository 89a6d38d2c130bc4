"""User registration and profile updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import java_string_hash


def register(users: DataFrame, requests: DataFrame, now_millis: int | None = None) -> DataFrame:
    """New user rows for the requested names that no user has yet; a name asked for twice gives one.

    They are stamped with the time of the query unless another one is given.
    """
    now = F.unix_millis(F.current_timestamp()) if now_millis is None else F.lit(now_millis)
    names = requests.select("username").distinct()
    unknown = names.join(users.select("username"), "username", "left_anti")
    return schemas.conform(
        unknown.select(
            java_string_hash(F.col("username")).alias("userId"),
            "username",
            F.lit(True).alias("first"),
            now.alias("timestamp"),
            F.expr("CAST(array() AS array<string>)").alias("prefGenres"),
        ),
        schemas.USER,
    )


def update_profile(users: DataFrame, changes: DataFrame) -> DataFrame:
    """Users with ``first`` and ``prefGenres`` replaced where a change row exists for the userId."""
    c = changes.select(
        "userId", F.col("first").alias("newFirst"), F.col("prefGenres").alias("newGenres")
    )
    return users.join(c, "userId", "left").select(
        "userId",
        "username",
        F.coalesce("newFirst", "first").alias("first"),
        "timestamp",
        F.coalesce("newGenres", "prefGenres").alias("prefGenres"),
    )

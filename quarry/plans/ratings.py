"""Rating questions: mean per user, per user group, best items, users below a mark.

``ratings(user_id, item_id, rating)``, ``users(user_id, segment)``, ``items(item_id, title)``.

Ratings are reduced to an exact partial state (state of the sum, count) per
user or item **before** any join: the fact table is shuffled as partial sums,
a user with a third of all ratings is one row per task, and the join touches one
row per user instead of every rating. The mean is finished after the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.money import mean_from_parts, mean_parts, merged_state
from quarry.operators.relational import top_n


def rating_parts(ratings: DataFrame, key: str) -> DataFrame:
    """(key, __s, __n): exact partial state of the mean rating per ``key``.

    Shared by several questions; a job answering them can compute it once.
    """
    s, n = mean_parts("rating")
    return ratings.groupBy(key).agg(s.alias("__s"), n.alias("__n"))


def mean_by_user(ratings: DataFrame, users: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """(user_id, mean_rating) of users that exist and have ratings."""
    parts = parts if parts is not None else rating_parts(ratings, "user_id")
    return users.select("user_id").join(parts, "user_id", "inner").select(
        "user_id", mean_from_parts("__s", "__n").alias("mean_rating")
    )


def mean_by_segment(ratings: DataFrame, users: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """(segment, mean_rating): the mean over all ratings of the segment's users."""
    parts = parts if parts is not None else rating_parts(ratings, "user_id")
    return (
        users.join(parts, "user_id", "inner")
        .groupBy("segment")
        .agg(merged_state("__s").alias("__s"), F.sum("__n").alias("__n"))
        .select("segment", mean_from_parts("__s", "__n").alias("mean_rating"))
    )


def top_items(ratings: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """(item_id, title, mean_rating) of the ``n`` items with the best rounded mean, ties by item."""
    parts = rating_parts(ratings, "item_id")
    means = items.join(parts, "item_id", "inner").select(
        "item_id", "title", mean_from_parts("__s", "__n").alias("mean_rating")
    )
    return top_n(means, n, [F.desc_nulls_last("mean_rating")], ["item_id"])


def below_threshold(spark: SparkSession, means: DataFrame, threshold: float) -> DataFrame:
    """SQL over a named result, with a bound parameter (no string pasting); registers no view."""
    return spark.sql("SELECT * FROM {means} WHERE mean_rating < :t", args={"t": threshold}, means=means)

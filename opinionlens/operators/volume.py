"""Where and when posts were written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.functions.values import class_counts


def geo_distribution(posts: DataFrame) -> DataFrame:
    """Posts and distinct users per (state, city).

    Spark groups by (state, city, user) before it counts, so neither a hot city nor
    a hot user ends up in one task.
    """
    return posts.groupBy("state", "city").agg(
        F.count("*").alias("tweet_count"), F.count_distinct("user_id").alias("unique_users")
    )


def temporal_evolution(posts: DataFrame) -> DataFrame:
    """Posts per (date, state) and class; posts without a date form their own group."""
    return posts.groupBy("date", "state").agg(F.count("*").alias("tweet_count"), *class_counts())


def _user_places(posts: DataFrame) -> DataFrame:
    """Posts per user and place: small enough to count users and places from."""
    return posts.groupBy("state", "city", "user_id").agg(F.count("*").alias("n"))


def overview_kpis(posts: DataFrame) -> DataFrame:
    """Posts, users and cities in one row.

    ``unique_users_by_city_sum`` adds up the users of each city, so a user seen in
    two cities counts twice; ``unique_users`` counts each user once.
    """
    return _user_places(posts).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tweet_count"),
        F.count("user_id").alias("unique_users_by_city_sum"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("state", "city").alias("active_cities"),
    )


def state_volume(posts: DataFrame) -> DataFrame:
    """Posts and users per state, users both added up by city and counted once."""
    users = (
        _user_places(posts)
        .groupBy("state", "user_id")
        .agg(F.sum("n").alias("n"), F.count("user_id").alias("places"))
    )
    return users.groupBy("state").agg(
        F.sum("n").alias("tweet_count"),
        F.sum("places").alias("unique_users_by_city_sum"),
        F.count("user_id").alias("unique_users"),
    )

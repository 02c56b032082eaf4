"""Orientation of users and polarization of places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import values as v
from opinionlens.operators.posts import labelled


def user_orientation(posts: DataFrame) -> DataFrame:
    """Majority class of each known user in each city they posted from."""
    return (
        labelled(posts)
        .filter(F.col("user_id").isNotNull())
        .groupBy("state", "city", "user_id")
        .agg(
            F.count("*").alias("classified_tweets"),
            F.count_if(F.col("binary_label") == 1).alias("pos_tweets"),
            F.count_if(F.col("binary_label") == 0).alias("neg_tweets"),
        )
        .withColumn("user_orientation", v.orientation("pos_tweets", "neg_tweets"))
    )


def polarization_city(posts: DataFrame, min_users: int = K.MIN_CITY_USERS) -> DataFrame:
    """How far the users of each (state, city) lean to one side."""
    side = F.col("user_orientation")
    return (
        user_orientation(posts)
        .groupBy("state", "city")
        .agg(
            F.count("*").alias("classified_users"),
            F.count_if(side == K.POS).alias("pos_users"),
            F.count_if(side == K.NEG).alias("neg_users"),
            F.count_if(side == K.BALANCED).alias("balanced_users"),
            F.sum("classified_tweets").alias("classified_tweets"),
            F.sum("pos_tweets").alias("pos_tweets"),
            F.sum("neg_tweets").alias("neg_tweets"),
        )
        .filter(F.col("classified_users") >= min_users)
        .withColumns(
            {
                **{f"{side}_user_share": v.share(f"{side}_users", "classified_users") for side in ("pos", "neg", "balanced")},
                "user_polarization_score": v.share(
                    F.abs(F.col("pos_users") - F.col("neg_users")), "classified_users"
                ),
                "dominant_user_orientation": v.orientation("pos_users", "neg_users"),
            }
        )
    )


def polarization_state(cities: DataFrame) -> DataFrame:
    """State totals of the city table with an unrounded score."""
    users = ["classified_users", "pos_users", "neg_users", "balanced_users"]
    lean = F.abs(F.col("pos_users") - F.col("neg_users"))
    return (
        cities.groupBy("state")
        .agg(*[F.sum(c).alias(c) for c in users])
        .withColumn("user_polarization_score", v.safe_divide(lean, "classified_users"))
    )


def polarization_unpivot(states: DataFrame) -> DataFrame:
    """One row per state and orientation."""
    return states.unpivot("state", ["pos_users", "neg_users", "balanced_users"], "orientation", "users")


def polarized_cities(cities: DataFrame, min_users: int = 1, n: int = 25) -> DataFrame:
    """The ``n`` most polarized cities with enough classified users, named for display."""
    return (
        cities.filter(F.col("classified_users") >= min_users)
        .orderBy(F.desc("user_polarization_score"), F.desc("classified_users"), "state", "city")
        .limit(n)
        .withColumn("area", v.area())
    )


def label_bounds(cities: DataFrame) -> DataFrame:
    """Largest number of classified users and largest score of any city."""
    return cities.agg(
        F.max("classified_users").alias("max_classified_users"),
        F.max("user_polarization_score").alias("max_score"),
    )

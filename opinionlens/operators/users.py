"""Users of places as exact bitmaps, which add up over any places without counting one twice.

Users get dense numbers in the order of their first place, so that those of one city lie
side by side and its bitmaps are few. A bitmap covers 32,768 numbers; a place has a row for
each one that it has users in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinionlens.operators.models import stored_in_ranges

PLACE = ("state", "city")


def user_numbers(posts: DataFrame, place: Sequence[str] = PLACE, user: str = "user_id") -> DataFrame:
    """``user`` and its ``number``, from 0 on without gaps.

    Users are sorted in ranges that are stored; only the sizes of the ranges meet in one place.
    """
    users = posts.filter(F.col(user).isNotNull()).groupBy(user).agg(F.min(F.struct(*place)).alias("home"))
    stored = stored_in_ranges(users, "home", user)
    sizes = stored.groupBy("range").agg(F.min("at").alias("first"), F.count("*").alias("users"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", (F.coalesce(F.sum("users").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return stored.join(starts, "range").select(user, (F.col("at") + F.col("shift")).alias("number"))


def user_bitmaps(posts: DataFrame, place: Sequence[str] = PLACE, user: str = "user_id") -> DataFrame:
    """The ``place`` columns, the ``bucket`` of numbers and the bitmap ``users`` of those that posted there."""
    there = posts.filter(F.col(user).isNotNull()).select(*place, user).distinct()
    numbered = there.join(user_numbers(posts, place, user), user)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    return numbered.groupBy(*place, F.bitmap_bucket_number("number").alias("bucket")).agg(bits)


def united_users(bitmaps: DataFrame, by: Sequence[str] = ("state",)) -> DataFrame:
    """Users of larger places, each counted once: ``by`` and ``unique_users``. No ``by`` counts them all."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("unique_users"))

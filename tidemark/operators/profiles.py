"""Profile completeness and the most followed / most following users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import percent
from tidemark.functions.text import is_present
from tidemark.operators.hours import stamp_hour

# Profile fields reported as "filled in" and as "not zero".
TEXT_FIELDS = ("email", "company", "location", "bio", "blog", "hireable", "twitter_username")
NUMBER_FIELDS = ("followers", "following", "public_repos", "public_gists")


def profile_ratios(users: DataFrame, hour: DataFrame) -> DataFrame:
    """Share of users with each profile field, in percent, in one scan."""
    tests = {f"{name}_ratio": is_present(F.col(name), ("null",)) for name in TEXT_FIELDS}
    tests |= {f"{name}_ratio": F.col(name) != 0 for name in NUMBER_FIELDS}
    tests["followers_following_ratio"] = F.try_divide(F.col("followers"), F.col("following")) > 1
    shares = users.agg(
        *[percent(F.count_if(test), F.count("*")).alias(name) for name, test in tests.items()]
    )
    return stamp_hour(shares, hour)


def top_users(users: DataFrame, measure: str, k: int = 20) -> DataFrame:
    """The ``k`` users with the highest ``measure``; equal values go by id."""
    return users.orderBy(F.col(measure).desc_nulls_last(), "id").limit(k).select("id", "login", measure)

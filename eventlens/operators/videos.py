"""Trending-video models (P04 staging, P05 mart)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STG_COLUMNS = ("video_id", "trending_date", "title", "channel_title", "category_id", "publish_time",
               "tags", "views", "likes", "dislikes", "comment_count", "thumbnail_link",
               "comments_disabled", "ratings_disabled", "video_error_or_removed", "description")

# Two-digit years at or above this pivot are 19xx, below it 20xx (the
# warehouse's YY rule).
YEAR_PIVOT = 70


def parse_yy_dd_mm(c) -> Column:
    """``YY.DD.MM`` text -> date with the century pivot (ruling C12); bad
    text gives null instead of failing the job."""
    s = F.col(c) if isinstance(c, str) else c
    yy = F.substring(s, 1, 2)
    century = F.when(yy.try_cast("int") >= YEAR_PIVOT, F.lit("19")).otherwise(F.lit("20"))
    return F.try_to_date(F.concat(century, s), "yyyy.dd.MM")


def stg_videos(raw: DataFrame) -> DataFrame:
    """Staging model: typed trending date, the 16 modelled columns."""
    return raw.select(*[parse_yy_dd_mm("trending_date").alias(c) if c == "trending_date" else F.col(c)
                        for c in STG_COLUMNS])


def fct_video_trends(stg: DataFrame) -> DataFrame:
    """Mart: engagement rate as a double ((likes + dislikes +
    comments) / views) and the English weekday name; rows with views > 0."""
    return stg.where(F.col("views") > 0).select(
        "video_id", "trending_date", "title", "channel_title", "category_id", "views", "likes",
        "dislikes", "comment_count",
        ((F.col("likes") + F.col("dislikes") + F.col("comment_count")).cast("double")
         / F.col("views").cast("double")).alias("engagement_rate"),
        F.date_format("trending_date", "EEEE").alias("trending_day_of_week"))

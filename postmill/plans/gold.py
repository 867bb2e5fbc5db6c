"""Gold: tag ranking and one wide row per post with its author."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import author_status
from postmill.operators import left_join_dimension, project, top_n

TOP_TAGS = 100


def tag_counts(stg_posts: DataFrame, unique_posts: bool = False) -> DataFrame:
    """Distinct posts per tag.

    A tag repeated inside one post is dropped in the row, before anything is shuffled.
    The exact distinct count then shuffles (tag, post) pairs, which spreads a hot tag
    over all tasks. ``unique_posts=True`` is for input already checked to hold each
    ``post_id`` once: rows can then be counted, and only one partial count per tag
    and task is shuffled.
    """
    tagged = stg_posts.where(F.col("tags_array").isNotNull()).select(
        "post_id", F.explode(F.array_distinct("tags_array")).alias("tag")
    )
    posts = F.count("post_id") if unique_posts else F.count_distinct("post_id")
    return tagged.groupBy("tag").agg(posts.alias("post_count"))


def top_tags(
    stg_posts: DataFrame, limit: int = TOP_TAGS, unique_posts: bool = False
) -> DataFrame:
    """The most used tags, most used first, ties in tag order."""
    counts = tag_counts(stg_posts, unique_posts)
    return top_n(counts, limit, F.desc("post_count"), F.asc("tag"))


def posts_users(stg_posts: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Every post once, with its author's columns where the author is known."""
    p, u = stg_posts.alias("p"), stg_users.alias("u")
    joined = left_join_dimension(
        p, u, F.col("p.owner_user_id"), F.col("u.user_id"), spread_by=F.col("p.post_id")
    )
    return project(
        joined,
        # Column names and their order.
        {
            "post_id": "p.post_id",
            "post_type": "p.post_type",
            "parent_id": "p.parent_id",
            "title": "p.title",
            "tags_array": "p.tags_array",
            "score": "p.score",
            "view_count": "p.view_count",
            "answer_count": "p.answer_count",
            "comment_count": "p.comment_count",
            "post_creation_date": "p.creation_date",
            "owner_user_id": "p.owner_user_id",
            "user_id": "u.user_id",
            "display_name": "u.display_name",
            "reputation": "u.reputation",
            "up_votes": "u.up_votes",
            "down_votes": "u.down_votes",
            "user_profile_views": "u.profile_views",
            "user_location": "u.location",
            "user_website_url": "u.website_url",
            "user_creation_date": "u.creation_date",
            "user_last_access_date": "u.last_access_date",
            "author_status": author_status(F.col("p.owner_user_id"), F.col("u.user_id")),
        },
    )

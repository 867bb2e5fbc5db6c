"""Silver: cleaned, typed, enriched posts and users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import blank_to_null, tag_list
from postmill.operators import label_lookup, project


def normalize_tags(df: DataFrame, column: str = "Tags", name: str = "tags_array") -> DataFrame:
    """Replace the delimited tags text by an array of tags."""
    return df.withColumn(name, tag_list(F.col(column))).drop(column)


def map_post_type(df: DataFrame, types: DataFrame) -> DataFrame:
    """Add the label of ``PostTypeId``."""
    return label_lookup(df, types, "PostTypeId", "post_type_id", "post_type")


def stg_posts(posts: DataFrame, types: DataFrame) -> DataFrame:
    """One row per post: all bronze columns, tags as an array, the post type labelled."""
    enriched = posts.transform(normalize_tags).transform(map_post_type, types)
    return project(
        enriched,
        # Column names and their order.
        {
            "post_id": "Id",
            "post_type_id": "PostTypeId",
            "post_type": "post_type",
            "parent_id": "ParentId",
            "accepted_answer_id": "AcceptedAnswerId",
            "owner_user_id": "OwnerUserId",
            "owner_display_name": "OwnerDisplayName",
            "last_editor_user_id": "LastEditorUserId",
            "last_editor_display_name": "LastEditorDisplayName",
            "title": "Title",
            "body": "Body",
            "tags_array": "tags_array",
            "score": "Score",
            "view_count": "ViewCount",
            "answer_count": "AnswerCount",
            "comment_count": "CommentCount",
            "favorite_count": "FavoriteCount",
            "content_license": "ContentLicense",
            "creation_date": "CreationDate",
            "last_activity_date": "LastActivityDate",
            "last_edit_date": "LastEditDate",
            "closed_date": "ClosedDate",
            "community_owned_date": "CommunityOwnedDate",
        },
    )


def stg_users(users: DataFrame) -> DataFrame:
    """One row per account, without the profile text; no account is filtered out."""
    return project(
        users,
        # Column names and their order.
        {
            "user_id": "Id",
            "account_id": "AccountId",
            "display_name": "DisplayName",
            "reputation": "Reputation",
            "up_votes": "UpVotes",
            "down_votes": "DownVotes",
            "profile_views": "Views",
            "location": blank_to_null(F.col("Location")),
            "website_url": blank_to_null(F.col("WebsiteUrl")),
            "creation_date": "CreationDate",
            "last_access_date": "LastAccessDate",
        },
    )

"""Table contracts.

Names, order and types below are fixed values: a reader of the tables depends on
them. Every column is nullable, because an absent attribute is data.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The reader puts this in front of a name that comes from an XML attribute.
ATTRIBUTE_PREFIX = "_"


def contract(columns: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


def attribute_schema(schema: StructType) -> StructType:
    """The same contract as the XML reader sees it, with prefixed attribute names."""
    return StructType(
        [StructField(ATTRIBUTE_PREFIX + f.name, f.dataType, True) for f in schema]
    )


# Bronze.posts
POSTS = contract(
    {
        "AcceptedAnswerId": LongType(),
        "AnswerCount": LongType(),
        "Body": StringType(),
        "ClosedDate": TimestampType(),
        "CommentCount": LongType(),
        "CommunityOwnedDate": TimestampType(),
        "ContentLicense": StringType(),
        "CreationDate": TimestampType(),
        "FavoriteCount": LongType(),
        "Id": LongType(),
        "LastActivityDate": TimestampType(),
        "LastEditDate": TimestampType(),
        "LastEditorDisplayName": StringType(),
        "LastEditorUserId": LongType(),
        "OwnerDisplayName": StringType(),
        "OwnerUserId": LongType(),
        "ParentId": LongType(),
        "PostTypeId": LongType(),
        "Score": LongType(),
        "Tags": StringType(),
        "Title": StringType(),
        "ViewCount": LongType(),
    }
)

# Bronze.users
USERS = contract(
    {
        "AboutMe": StringType(),
        "AccountId": LongType(),
        "CreationDate": TimestampType(),
        "DisplayName": StringType(),
        "DownVotes": LongType(),
        "Id": LongType(),
        "LastAccessDate": TimestampType(),
        "Location": StringType(),
        "Reputation": LongType(),
        "UpVotes": LongType(),
        "Views": LongType(),
        "WebsiteUrl": StringType(),
    }
)

# Post type labels. Ids 11 and 16 have no documented meaning.
POST_TYPES = [
    (1, "Question"),
    (2, "Answer"),
    (3, "Orphaned tag wiki"),
    (4, "Tag wiki excerpt"),
    (5, "Tag wiki"),
    (6, "Moderator nomination"),
    (7, "Wiki placeholder"),
    (8, "Privilege wiki"),
    (9, "Article"),
    (10, "HelpArticle"),
    (12, "Collection"),
    (13, "ModeratorQuestionnaireResponse"),
    (14, "Announcement"),
    (15, "CollectiveDiscussion"),
    (17, "CollectiveCollection"),
]
UNKNOWN_LABEL = "Unknown"

# How a post relates to its author row.
ANONYMOUS = "anonymous"
UNRESOLVED = "unresolved"
RESOLVED = "resolved"
AUTHOR_STATUSES = [RESOLVED, UNRESOLVED, ANONYMOUS]

# Score bands in report order; the last one is open-ended.
SCORE_BANDS = ["negative", "zero", "1-4", "5-19", "20+"]

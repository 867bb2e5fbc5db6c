"""Delimited text to arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_DELIMITER = "|"


def split_literal(text: Column, delimiter: str) -> Column:
    """Split on a literal delimiter; NULL stays NULL.

    Spark's ``split`` takes a regular expression. A single escaped character keeps
    to the JVM's split fast path, where a quoted block compiles a pattern per row.
    """
    if not delimiter:
        raise ValueError("the delimiter must not be empty")
    if len(delimiter) > 1:
        pattern = r"\Q" + delimiter.replace(r"\E", r"\E\\E\Q") + r"\E"
    elif delimiter.isalnum() or delimiter.isspace():
        pattern = delimiter
    else:
        pattern = "\\" + delimiter
    return F.split(text, pattern)


def drop_blank(items: Column) -> Column:
    """Remove ``''`` elements; a NULL array stays NULL.

    Unlike a filter with a lambda, this is compiled into the stage.
    """
    return F.array_remove(items, "")


def tag_list(tags: Column, delimiter: str = TAG_DELIMITER) -> Column:
    """``'|a|b|'`` to ``['a', 'b']``, keeping order and repeats; NULL stays NULL."""
    return drop_blank(split_literal(tags, delimiter))

"""Labels, dates and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.schemas import ANONYMOUS, RESOLVED, SCORE_BANDS, UNRESOLVED

# Fixed value: the dump's own timestamp format.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def blank_to_null(text: Column) -> Column:
    """``''`` becomes NULL. Text is not trimmed first."""
    return F.nullif(text, F.lit(""))


def author_status(owner_id: Column, user_id: Column) -> Column:
    """Whether a post names no author, one without a user row, or one that was found.

    The order of the tests matters: a post without an owner never matches a user.
    """
    return (
        F.when(owner_id.isNull(), ANONYMOUS)
        .when(user_id.isNull(), UNRESOLVED)
        .otherwise(RESOLVED)
    )


def score_band(score: Column, null_band: str | None = None) -> Column:
    """Band of a score. A NULL score counts as the open-ended band unless named."""
    negative, zero, low, middle, high = SCORE_BANDS
    band = (
        F.when(score < 0, negative)
        .when(score == 0, zero)
        .when(score.between(1, 4), low)
        .when(score.between(5, 19), middle)
    )
    if null_band is not None:
        band = band.when(score.isNull(), null_band)
    return band.otherwise(high)


def year_of(moment: Column) -> Column:
    return F.year(moment)


def date_text(moment: Column) -> Column:
    return moment.cast("date").cast("string")


def timestamp_text(moment: Column) -> Column:
    """Timestamp in the session zone, formatted inside Spark."""
    return F.date_format(moment, TIMESTAMP_FORMAT)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; NULL when there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100).cast("double")

"""Reports over the gold tables. Each returns a small result table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import date_text, percent, ratio, score_band, year_of
from postmill.operators import count_by, top_n
from postmill.schemas import SCORE_BANDS

REPORT_TAGS = 15
REPORT_AUTHORS = 10

_IS_QUESTION = "post_type = 'Question'"
_IS_ANSWER = "post_type = 'Answer'"
_IS_UNANSWERED = f"{_IS_QUESTION} and coalesce(answer_count, 0) = 0"


def gold_kpis(gold: DataFrame, tags: DataFrame) -> DataFrame:
    """One row of headline figures, from one pass over the posts."""
    totals = gold.agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_if(F.expr(_IS_QUESTION)).alias("questions"),
        F.count_if(F.expr(_IS_ANSWER)).alias("answers"),
        F.count_distinct("owner_user_id").alias("authors"),
        date_text(F.min("post_creation_date")).alias("first_post"),
        date_text(F.max("post_creation_date")).alias("last_post"),
        F.count_if(F.expr(_IS_UNANSWERED)).alias("unanswered"),
    )
    answered = F.col("questions") - F.col("unanswered")
    return totals.select(
        "*",
        answered.alias("answered"),
        percent(answered, F.col("questions")).alias("answered_pct"),
        ratio(F.col("answers"), F.col("questions")).alias("answers_per_question"),
        F.substring("first_post", 1, 4).alias("first_year"),
        F.substring("last_post", 1, 4).alias("last_year"),
        tags.agg(F.count(F.lit(1))).scalar().alias("tags_ranked"),
    )


def posts_by_year(gold: DataFrame) -> DataFrame:
    """Questions, answers and all posts per year, earliest first; posts without a date last."""
    return (
        gold.groupBy(year_of(F.col("post_creation_date")).alias("year"))
        .agg(
            F.count_if(F.expr(_IS_QUESTION)).alias("questions"),
            F.count_if(F.expr(_IS_ANSWER)).alias("answers"),
            F.count(F.lit(1)).alias("posts"),
        )
        .orderBy(F.asc_nulls_last("year"))
    )


def peak_year(by_year: DataFrame) -> DataFrame:
    """The year with most posts, the earliest of them on a tie."""
    order = F.struct(F.col("posts"), (-F.col("year")).alias("earlier"))
    row = F.struct("year", "questions", "answers", "posts")
    peak = by_year.agg(F.max_by(row, order).alias("peak"))
    return peak.where(F.col("peak").isNotNull()).select("peak.*")


def score_bands(gold: DataFrame, null_band: str | None = None) -> DataFrame:
    """Posts per score band in fixed order; a band no post falls in shows zero.

    All bands are counted as columns of one aggregate row and then turned into rows, so
    empty bands need no join and each task sends a single row.
    """
    bands = [*SCORE_BANDS, *([null_band] if null_band is not None else [])]
    band = score_band(F.col("score"), null_band)
    counted = gold.select(band.alias("band")).agg(
        *[F.count_if(F.col("band") == name).alias(name) for name in bands]
    )
    return _band_rows(counted, bands)


def _band_rows(counted: DataFrame, bands: list[str]) -> DataFrame:
    """One row a band from one row of all counts."""
    rows = [
        F.struct(
            F.lit(order).alias("band_order"),
            F.lit(name).alias("band"),
            F.col(f"`{name}`").alias("posts"),
        )
        for order, name in enumerate(bands)
    ]
    return counted.select(F.inline(F.array(*rows))).orderBy("band_order")


def unanswered(gold: DataFrame) -> DataFrame:
    """Questions without any answer (not: without an accepted one)."""
    return gold.where(_IS_UNANSWERED).agg(F.count(F.lit(1)).alias("unanswered"))


def author_status_counts(gold: DataFrame) -> DataFrame:
    """Posts per author status, most first."""
    return count_by(gold, "author_status", "posts").orderBy(
        F.desc("posts"), F.asc("author_status")
    )


def top_authors(gold: DataFrame, limit: int = REPORT_AUTHORS) -> DataFrame:
    """Most active display names. People sharing a name count as one; ties by name."""
    named = gold.where(F.col("display_name").isNotNull())
    return _most_posts(named, ["display_name"], limit, F.asc("display_name"))


def top_author_accounts(gold: DataFrame, limit: int = REPORT_AUTHORS) -> DataFrame:
    """Most active accounts: as :func:`top_authors`, but namesakes stay apart."""
    named = gold.where(F.col("display_name").isNotNull())
    return _most_posts(named, ["user_id", "display_name"], limit, F.asc("user_id"))


def report_tags(tags: DataFrame, limit: int = REPORT_TAGS) -> DataFrame:
    """The head of the gold tag ranking."""
    return top_n(tags, limit, F.desc("post_count"), F.asc("tag"))


def status_by_band(gold: DataFrame) -> DataFrame:
    """Posts by author status and score band: at most some twenty rows."""
    return gold.groupBy("author_status", score_band(F.col("score"), None).alias("band")).agg(
        F.count(F.lit(1)).alias("posts")
    )


def bands_of(counts: DataFrame) -> DataFrame:
    """As :func:`score_bands`, from :func:`status_by_band`."""
    summed = counts.agg(
        *[F.coalesce(F.sum(F.when(F.col("band") == b, F.col("posts"))), F.lit(0)).alias(b) for b in SCORE_BANDS]
    )
    return _band_rows(summed, SCORE_BANDS)


def status_of(counts: DataFrame) -> DataFrame:
    """As :func:`author_status_counts`, from :func:`status_by_band`."""
    summed = counts.groupBy("author_status").agg(F.sum("posts").alias("posts"))
    return summed.orderBy(F.desc("posts"), F.asc("author_status"))


def require_reportable(kpis: DataFrame) -> None:
    """Refuse to report on an empty table, or on one without a question."""
    seen = kpis.select("posts", "questions").first()
    if seen["posts"] == 0:
        raise ValueError("the gold table of posts is empty: build it before reporting")
    if seen["questions"] == 0:
        raise ValueError("the gold table holds no questions: ratios would divide by zero")


SOURCES = ("report_kpis", "report_posts_by_year", "report_status_by_band")
REPORTS = (
    "report_kpis",
    "report_posts_by_year",
    "report_peak_year",
    "report_tags",
    "report_score_bands",
    "report_unanswered",
    "report_author_status",
    "report_top_authors",
)


def base_reports(gold: DataFrame, tags: DataFrame) -> dict[str, DataFrame]:
    """Reports that read the gold tables, each of them once, besides the headline figures."""
    return {
        "report_posts_by_year": posts_by_year(gold),
        "report_status_by_band": status_by_band(gold),
        "report_top_authors": top_authors(gold),
        "report_tags": report_tags(tags),
    }


def derived_reports(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Reports that follow from stored ones (``SOURCES``)."""
    counts = stored["report_status_by_band"]
    return {
        "report_peak_year": peak_year(stored["report_posts_by_year"]),
        "report_score_bands": bands_of(counts),
        "report_author_status": status_of(counts),
        "report_unanswered": stored["report_kpis"].select("unanswered"),
    }


def _most_posts(gold: DataFrame, keys: list[str], limit: int, tie: Column) -> DataFrame:
    activity = gold.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("posts"), F.max("reputation").alias("reputation")
    )
    return top_n(activity, limit, F.desc("posts"), tie)

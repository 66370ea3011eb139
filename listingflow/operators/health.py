"""Source health from poll results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .aggregates import last_when, success_rate
from .ordering import top_distinct

# Fixed value: how many polls the report looks back.
RECENT_POLLS = 30


def recent_polls(polls: DataFrame, n: int = RECENT_POLLS) -> DataFrame:
    """The rows of the n newest polls (a poll is a distinct ``time_checked``)."""
    return polls.join(top_distinct(polls, "time_checked", n), "time_checked", "left_semi")


def health_report(polls: DataFrame, n: int = RECENT_POLLS, weight: str | None = None) -> DataFrame:
    """Per source: successes in the last n polls, their rate, last failure and last success.

    One pass: the n newest poll stamps are joined as a flag; Spark knows how many there are and sends a short list.  Sources not polled lately are left
    out.  The rate is over n even when fewer polls exist.  ``weight`` names a column telling how often a row counts.
    """
    stamps = top_distinct(polls, "time_checked", n).withColumn("_recent", F.lit(True))
    flagged = polls.join(stamps, "time_checked", "left")
    successes = F.col("result") * F.col(weight) if weight else F.col("result")
    per_source = flagged.groupBy("source").agg(
        F.sum(F.when(F.col("_recent"), successes)).alias("result"),
        F.count(F.when(F.col("_recent"), 1)).alias("_polled"),
        last_when(F.col("result") == 0, "time_checked").alias("most_recent_failure"),
        last_when(F.col("result") == 1, "time_checked").alias("most_recent_success"),
    )
    return per_source.where("_polled > 0").select(
        "source",
        "result",
        success_rate(F.col("result"), n).alias("recent_success_rate"),
        "most_recent_failure",
        "most_recent_success",
    )


def worst_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("result").asc(), F.col("source").asc())

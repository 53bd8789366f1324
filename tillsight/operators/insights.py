"""Table-to-text part of the insights: segment texts, request texts, response handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .segments import SUMMARY, two_decimals

# Instruction and messages.
PROMPT = """
You are a business analyst.
Analyze the following informations from customer profile and provide:

1. Key insights
2. Reason
3. Business Risk
4. Recommended Action
Keep it concise.
"""
NO_TEXT = "Error: Customer_Text column is missing."
NO_KEY = "Error: no access key is set."
BAD_KEY = (
    "Error: the access key is invalid or expired. Renew it."
)
FALLBACK = (
    "Key insights: Segment shows mixed engagement.\n"
    "Reason: Based on average recency, order frequency, and order value.\n"
    "Business Risk: Medium.\n"
    "Recommended Action: Run targeted retention and upsell campaign.\n"
    "Note: quota exceeded, showing fallback insight."
)
NOTHING = "Error: Could not generate insights."


def segment_profile(customers: DataFrame, segment: str | None = None) -> DataFrame:
    """Mean KPIs of one segment, or of every segment."""
    chosen = customers if segment is None else customers.where(F.col("segment") == segment)
    return chosen.groupBy("segment").agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in SUMMARY])


def segment_text(profile: DataFrame) -> DataFrame:
    text = F.concat(
        F.lit("\nSegment: "), F.col("segment"),
        F.lit("\nAverage Recency: "), two_decimals("Recency"),
        F.lit("\nAverage Orders: "), two_decimals("TotalOrders"),
        F.lit("\nAverage Frequency: "), two_decimals("PurchaseFrequency"),
        F.lit("\nAverage Order Value: "), two_decimals("AvgOrderValue"),
        F.lit("\n"),
    )
    return profile.select("segment", text.alias("Customer_Text"))


def insight_requests(texts: DataFrame, has_key: bool = True) -> DataFrame:
    """Add the request text, or the message that explains why there is none."""
    if "Customer_Text" not in texts.columns:
        return texts.withColumn("insights", F.lit(NO_TEXT))
    if not has_key:
        return texts.withColumn("insights", F.lit(NO_KEY))
    return texts.withColumn("request", F.concat(F.lit(PROMPT + "\n\n"), F.coalesce("Customer_Text", F.lit("None"))))


def _contains(*words: str, lower: bool = False) -> Column:
    text = F.lower("error") if lower else F.col("error")
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return F.coalesce(hit, F.lit(False))


def attempt_outcome() -> Column:
    """Result of one attempt; NULL means that the next candidate is tried."""
    error = F.when(F.col("error") != "", F.concat(F.lit("Error: "), F.col("error"))).otherwise(F.lit(NOTHING))
    return (
        F.when(F.col("error").isNull(), F.coalesce("response", F.lit(NOTHING)))
        .when(_contains("API_KEY_INVALID", "API key expired"), BAD_KEY)
        .when(_contains("404") | _contains("not found", lower=True), F.lit(None).cast("string"))
        .when(_contains("429") | _contains("quota", lower=True), FALLBACK)
        .otherwise(error)
    )


def resolve_insights(attempts: DataFrame) -> DataFrame:
    """One insight per request from (request_id, candidate, response, error).

    Candidates are tried in order until one is not "not found"; if all are, the
    last error is reported.
    """
    tried = attempts.withColumn("outcome", attempt_outcome())
    last = F.max_by("error", "candidate")
    settled = F.min_by("outcome", F.when(F.col("outcome").isNotNull(), F.col("candidate")))
    return tried.groupBy("request_id").agg(
        F.coalesce(settled, F.concat(F.lit("Error: "), last), F.lit(NOTHING)).alias("insights")
    )

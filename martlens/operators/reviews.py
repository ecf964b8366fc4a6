"""Review text to scores, extracts, themes and summaries.

Per-review results are array expressions over the whole text: one scan, no
shuffle, no Python. Only term counts explode tokens, and those are reduced
map-side before they move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.money import ratio
from martlens.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS, count_in, mentions, raw_tokens, sentences
from martlens.operators.spine import rows_before

# The tiers a campaign can be given.
PERFORMANCE_TIERS = ("Top Performer", "Solid Performer", "Average", "Underperformer", "Needs Review")

# Default cue words of the three extracted answers.
FEEDBACK_WORDS = (
    "battery", "broke", "broken", "color", "comfort", "comfortable", "durable", "fabric", "fit", "fits", "leaked",
    "light", "material", "pockets", "quality", "size", "sizing", "stitching", "strap", "waterproof", "warm", "zipper",
)
COMPETITOR_WORDS = ("competitor", "competitors", "rival", "elsewhere")
RECOMMEND_WORDS = ("recommend", "recommended", "love", "buy", "again", "perfect")
DISCOURAGE_WORDS = ("avoid", "return", "returned", "refund", "regret", "disappointed", "never")


def review_sentiment(
    reviews: DataFrame, positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS
) -> DataFrame:
    """Score in [-1, 1]: balance of opinion words in the whole text, 0 without any."""
    up, down = F.col("_up").cast("double"), F.col("_down").cast("double")
    score = F.coalesce(F.try_divide(up - down, up + down), F.lit(0.0))
    return (
        reviews.withColumn("_tokens", raw_tokens("review_text"))
        .withColumns({"_up": count_in(F.col("_tokens"), positive), "_down": count_in(F.col("_tokens"), negative)})
        .select(
            "review_id",
            "review_text",
            "channel",
            "product_category",
            "product_name",
            "rating",
            # as generator output the score is computed once, also under a filter on it,
            # which would otherwise be pushed down with a copy of the whole expression
            F.inline(F.array(F.struct(score.alias("sentiment_score")))),
        )
    )


def sentiment_by_channel(scored: DataFrame, by: str = "channel") -> DataFrame:
    return scored.groupBy(by).agg(
        F.round(F.avg("sentiment_score"), 4).alias("avg_sentiment"),
        F.count("review_id").alias("review_count"),
        ratio(F.sum("rating"), F.count("rating"), 4).alias("avg_rating"),
    )


def sentiment_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Reviews per score bin and channel; score 1 belongs to the last bin."""
    bucket = F.least(F.width_bucket(F.col("sentiment_score"), F.lit(-1.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return scored.groupBy(bucket.cast("int").alias("bin"), "channel").agg(F.count(F.lit(1)).alias("reviews"))


def review_extract(
    reviews: DataFrame,
    feedback: Sequence[str] = FEEDBACK_WORDS,
    competitors: Sequence[str] = COMPETITOR_WORDS,
    recommend: Sequence[str] = RECOMMEND_WORDS,
    discourage: Sequence[str] = DISCOURAGE_WORDS,
) -> DataFrame:
    """Product feedback, competitor mention and recommendation found in each review.

    Feedback is the first sentence that mentions one of its cue words, with the
    share of sentences that do.
    """
    share = F.try_divide(F.size("_hits").cast("double"), F.size("_sentences").cast("double"))
    brand = F.get(F.filter("_tokens", lambda t: t.isin(*competitors)), F.lit(0))
    lean = F.col("_lean")
    return (
        reviews.withColumns({"_sentences": sentences("review_text"), "_tokens": raw_tokens("review_text")})
        .withColumns({
            "_hits": F.filter("_sentences", lambda s: mentions(s, feedback)),
            "_lean": count_in(F.col("_tokens"), recommend) - count_in(F.col("_tokens"), discourage),
        })
        .select(
            "review_id",
            "product_category",
            "product_name",
            "channel",
            "rating",
            "review_text",
            F.get("_hits", F.lit(0)).alias("product_feedback"),
            F.coalesce(share, F.lit(0.0)).alias("feedback_score"),
            brand.alias("competitor_mention"),
            F.when(lean > 0, "yes").when(lean < 0, "no").otherwise("unclear").alias("recommendation"),
        )
    )


def term_counts(reviews: DataFrame, by: str) -> DataFrame:
    """Occurrences of each term per group, and in how many reviews it occurs.

    A text is split once; its words and its distinct words are exploded together
    and counted in one hash aggregate, map-side before anything moves. ``explode_outer``
    and not ``explode``: for the latter the optimizer adds a filter that evaluates
    the word expression a second time.
    """
    lists = F.array(
        F.struct(F.lit(1).alias("_tf"), F.lit(0).alias("_df"), F.col("_w").alias("_terms")),
        F.struct(F.lit(0).alias("_tf"), F.lit(1).alias("_df"), F.array_distinct("_w").alias("_terms")),
    )
    rows = reviews.select(by, F.explode_outer(F.array(raw_tokens("review_text"))).alias("_w"))
    return (
        rows.select(by, F.inline_outer(lists))
        .select(by, "_tf", "_df", F.explode_outer("_terms").alias("term"))
        .where(F.col("term") != "")
        .groupBy(by, "term")
        .agg(F.sum("_tf").alias("tf"), F.sum("_df").alias("df"))
    )


def theme_terms(reviews: DataFrame, by: str = "channel", k: int = 10) -> DataFrame:
    """The ``k`` terms with the highest TF-IDF per group.

    The rank filter is applied per partition before the shuffle, so a group with
    a very large vocabulary sends at most ``k`` rows per task.
    """
    n = reviews.agg(F.count(F.lit(1))).scalar()
    everywhere = Window.partitionBy("term")  # one row per group
    scored = (
        term_counts(reviews, by)
        .withColumn("_df", F.sum("df").over(everywhere))
        .select(by, "term", "tf", F.round(F.col("tf") * F.log(n / F.col("_df")), 4).alias("score"))
    )
    best = Window.partitionBy(by).orderBy(F.desc("score"), F.asc("term"))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def channel_themes(reviews: DataFrame, by: str = "channel", k: int = 10) -> DataFrame:
    """One row per group with its theme terms, best first."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return theme_terms(reviews, by, k).groupBy(by).agg(
        F.array_join(F.transform(ranked, lambda r: r["term"]), ", ").alias("themes")
    )


def top_terms(
    scored: DataFrame,
    n: int = 25,
    min_length: int = 4,
    ratings: tuple[int, int] = (1, 5),
    scores: tuple[float, float] = (-1.0, 1.0),
) -> DataFrame:
    """Most common terms of the reviews inside a rating and a score range."""
    kept = scored.where(F.col("rating").between(*ratings) & F.col("sentiment_score").between(*scores))
    return (
        kept.select(F.explode_outer(raw_tokens("review_text")).alias("term"))
        .where(F.length("term") >= min_length)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("term"))
        .limit(n)
    )


def campaign_tiers(metrics: DataFrame) -> DataFrame:
    """Tier of each campaign by the quartile of its ROAS; no ROAS gives 'Needs Review'.

    Ranks are worked out on the distinct ROAS values (two decimals) with their
    counts, in ranges of values whose counts are added up; they are stored once.
    """
    values = metrics.where(F.col("roas").isNotNull()).groupBy("roas").agg(F.count(F.lit(1)).alias("_n"))
    ranked = rows_before(values, "roas", "_n", "_above")
    rated = ranked.agg(F.sum("_n")).scalar()
    ranks = ranked.select("roas", F.coalesce(F.try_divide(F.col("_above"), rated - 1), F.lit(0.0)).alias("_pr"))
    top, solid, average, under, review = PERFORMANCE_TIERS
    tier = (
        F.when(F.col("_pr").isNull(), review).when(F.col("_pr") < 0.25, top).when(F.col("_pr") < 0.5, solid)
        .when(F.col("_pr") < 0.75, average).otherwise(under)
    )
    return metrics.join(ranks, "roas", "left").select(
        "campaign_id", "campaign_name", "channel", "sub_channel", "roas", tier.alias("performance_tier")
    )


def tier_counts(tiers: DataFrame) -> DataFrame:
    return tiers.groupBy("performance_tier").agg(F.count(F.lit(1)).alias("campaigns"))


def _money(name: str) -> Column:
    return F.format_string("%.2f", F.col(name))


def campaign_summary_text(metrics: DataFrame) -> DataFrame:
    """A short account of each campaign built from its indicators."""
    parts = [
        F.col("campaign_name"), F.lit(" ran on "), F.col("channel"), F.lit("/"), F.col("sub_channel"),
        F.lit(" with $"), _money("budget"), F.lit(" planned and $"), F.coalesce(_money("total_spend"), F.lit("0")), F.lit(" spent; "),
        F.coalesce(F.col("total_conversions").cast("string"), F.lit("0")), F.lit(" conversions, $"),
        F.coalesce(_money("campaign_revenue"), F.lit("0")), F.lit(" earned"),
        F.when(F.col("roas").isNull(), "").otherwise(F.format_string(", %.2f back per dollar", "roas")),
        F.when(F.col("cpa").isNull(), "").otherwise(F.format_string(", $%.2f per conversion", "cpa")),
    ]
    return metrics.select(
        "campaign_id", "campaign_name", "channel", "sub_channel", F.concat(*parts).alias("executive_summary")
    )


def geo_state_text(rollup: DataFrame) -> DataFrame:
    """Recommendation per state from its roll-up."""
    advice = (
        F.when(F.col("targeting_score") >= 0.5, "Raise spend and keep the current channels.")
        .when(F.col("customer_count") >= 50, "Grow order value with loyalty offers.")
        .otherwise("Test small regional campaigns first.")
    )
    parts = [
        F.col("customer_count").cast("string"), F.lit(" buyers in "), F.col("state"),
        F.lit(" brought $"), _money("total_revenue"),
        F.when(F.col("avg_ltv").isNull(), "").otherwise(F.format_string(", each worth $%.2f", "avg_ltv")), F.lit(". "), advice,
    ]
    return rollup.select(
        "state", "customer_count", "avg_ltv", "total_revenue", F.concat(*parts).alias("recommendation")
    )

"""Opinion words learned from ratings, with negation, and the scores they give.

A word in the scope of a negation counts as a word of its own. The weight of a
word is the log odds of high against low ratings under a prior of its share in
all reviews, in standard errors. Learning and scoring are aggregates over
exploded words and one equi join; the text is split once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.text import raw_tokens

# Default negations.
NEGATIONS = ("not", "no", "never", "cannot", "without", "hardly")

#: How many following words of the same sentence a negation reaches.
SCOPE = 3
#: Put before a negated word; upper case, which lower-cased text has none of.
MARK = "NOT"
#: Ratings up to the first count as low, from the second on as high.
LOW, HIGH = 2, 4


def negation_pattern(negations: Sequence[str], scope: int = SCOPE) -> str:
    """Pattern of a negation and the words it reaches, each in a group of its own.

    Leftmost, not overlapping: a negation inside the scope of another one is a negated word.
    """
    word = r"[^\p{L}.!?\n]+(\p{L}+)"
    return rf"(^|[^\p{{L}}])({'|'.join(negations)}){word}" + f"(?:{word})?" * (scope - 1)


def negation_marks(scope: int = SCOPE, sign: str = "$") -> str:
    """Replacement for :func:`negation_pattern` that marks the words reached; ``sign`` precedes a group's number."""
    return f"{sign}1{sign}2" + "".join(f" {MARK}{sign}{i}" for i in range(3, 3 + scope))


def opinion_tokens(text: Column | str, negations: Sequence[str] = NEGATIONS, scope: int = SCOPE) -> Column:
    """Lower-cased words of the whole text, negated ones marked; some pieces are empty or a bare mark."""
    if not negations:
        return raw_tokens(text)
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    marked = F.regexp_replace(lowered, F.lit(negation_pattern(negations, scope)), F.lit(negation_marks(scope)))
    return F.split(marked, r"[^\p{L}]+")


def _words(reviews: DataFrame, *keep: Column | str, negations: Sequence[str], scope: int) -> DataFrame:
    tokens = opinion_tokens("review_text", negations, scope)
    return reviews.select(*keep, F.explode_outer(tokens).alias("term")).where((F.col("term") != "") & (F.col("term") != MARK))


def opinion_words(
    reviews: DataFrame,
    negations: Sequence[str] = NEGATIONS,
    scope: int = SCOPE,
    prior: float = 500.0,
    min_count: int = 5,
) -> DataFrame:
    """Each word of the rated reviews with its counts in low and high ones and its weight.

    ``prior`` is the number of words that the prior stands for, shared out by the word's
    share in the low, middle and high reviews together. Words under ``min_count`` occurrences
    get no row. A null rating teaches nothing.
    """
    rated = reviews.where(F.col("rating").isNotNull())
    counts = _words(rated, "rating", negations=negations, scope=scope).groupBy("term").agg(
        F.count_if(F.col("rating") <= LOW).alias("low"),
        F.count_if(F.col("rating") >= HIGH).alias("high"),
        F.count(F.lit(1)).alias("n"),
    )
    total = counts.agg(F.struct(F.sum("low").alias("low"), F.sum("high").alias("high"), F.sum("n").alias("n"))).scalar()
    share = F.col("n") * F.lit(float(prior)) / F.col("_t.n")

    def odds(count: str) -> Column:
        mine = F.col(count) + F.col("_a")
        return F.log(mine / (F.col(f"_t.{count}") + F.lit(float(prior)) - mine))

    spread = F.sqrt(F.lit(1.0) / (F.col("high") + F.col("_a")) + F.lit(1.0) / (F.col("low") + F.col("_a")))
    return (
        counts.where(F.col("n") >= min_count)
        .withColumn("_t", total)
        .withColumn("_a", share)
        .select("term", "low", "high", "n", F.round((odds("high") - odds("low")) / spread, 3).alias("weight"))
    )


def learned_sentiment(
    reviews: DataFrame,
    words: DataFrame,
    threshold: float = 1.96,
    negations: Sequence[str] = NEGATIONS,
    scope: int = SCOPE,
) -> DataFrame:
    """Score in [-1, 1] per review: the balance of the weights of its opinion words, 0 without any.

    Words within ``threshold`` standard errors of neutral have no say. Weights are summed as
    whole thousandths, so the order of partial sums does not matter. Review ids must be unique.
    """
    telling = words.where(F.abs("weight") >= threshold).select("term", F.rint(F.col("weight") * 1000).cast("bigint").alias("_w"))
    used = _words(reviews, "review_id", negations=negations, scope=scope).groupBy("review_id", "term").agg(F.count(F.lit(1)).alias("_n"))
    sums = used.join(telling, "term").groupBy("review_id").agg(
        F.sum(F.col("_n") * F.col("_w")).alias("_net"), F.sum(F.col("_n") * F.abs("_w")).alias("_all"), F.sum("_n").alias("opinion_words"))
    score = F.coalesce(F.try_divide(F.col("_net").cast("double"), F.col("_all").cast("double")), F.lit(0.0))
    return reviews.select("review_id", "channel", "product_category", "rating").join(sums, "review_id", "left").select(
        "review_id", "channel", "product_category", "rating",
        F.coalesce("opinion_words", F.lit(0).cast("bigint")).alias("opinion_words"), F.round(score, 6).alias("sentiment_score"))


def rating_order(scored: DataFrame, score: str = "sentiment_score") -> DataFrame:
    """How well a score orders low before high ratings: the share of such pairs in the right order, ties half.

    Worked out from the counts per score value: no pair is built. One row, null without low or high ratings.
    """
    values = scored.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col("rating") <= LOW).alias("low"), F.count_if(F.col("rating") >= HIGH).alias("high"))
    coarse = values.groupBy(F.round("s", 3).alias("c")).agg(
        F.sum("low").alias("low"), F.sum("high").alias("high"))
    # at most 2,001 rounded scores, whatever the number of reviews
    cells = coarse.agg(F.sort_array(F.collect_list(F.struct("c", "low", "high"))).alias("cells"))
    start = F.struct(F.lit(0).cast("bigint").alias("below"), F.lit(0.0).alias("right"), F.lit(0).cast("bigint").alias("high"))
    summed = F.aggregate("cells", start, lambda a, x: F.struct(
        (a["below"] + x["low"]).alias("below"),
        (a["right"] + x["high"] * (a["below"] + x["low"] / 2.0)).alias("right"),
        (a["high"] + x["high"]).alias("high")))
    return cells.select(summed.alias("r")).select(
        F.col("r.below").alias("low_reviews"), F.col("r.high").alias("high_reviews"),
        F.round(F.try_divide(F.col("r.right"), (F.col("r.below") * F.col("r.high")).cast("double")), 4).alias("pairs_in_order"))

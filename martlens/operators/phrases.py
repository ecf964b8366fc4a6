"""Two-word phrases as themes: neighbours that meet more often than chance.

Words are counted first; pairs are then emitted only where both words are
frequent. The frequent words are those with at least a given share of all
words, so there are at most 1 / share of them, and only they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.text import raw_tokens


def _sentence_words(reviews: DataFrame, by: str) -> DataFrame:
    """One row per sentence with its words; sentences of one word have no neighbours and are left out."""
    sentence = F.explode_outer(F.split("review_text", r"[.!?\n]+"))
    words = F.array_remove(raw_tokens("_s"), "")
    # outer generators, so that the expressions before them are evaluated once
    return reviews.select(by, sentence.alias("_s")).select(by, F.explode_outer(F.array(words)).alias("_w")).where(F.size("_w") > 1)


def likelihood_ratio(both: Column, first: Column, second: Column, total: Column) -> Column:
    """Dunning's G2 of a pair from its count, those of its first and second word, and of all pairs."""
    def term(seen: Column, row: Column, column: Column) -> Column:
        o, r, c, n = (x.cast("double") for x in (seen, row, column, total))
        return F.when(o > 0, o * F.log(o * n / (r * c))).otherwise(F.lit(0.0))

    return F.lit(2.0) * (
        term(both, first, second) + term(first - both, first, total - second)
        + term(second - both, total - first, second) + term(total - first - second + both, total - first, total - second))


def phrase_counts(reviews: DataFrame, by: str = "channel", min_share: float = 1e-4) -> DataFrame:
    """Neighbouring words of one sentence with their counts and G2, per group.

    Only pairs of two words that each make up ``min_share`` of all words of the table have a row;
    margins and totals count all pairs. Groups that are null are a group of their own.
    """
    spoken = _sentence_words(reviews, by)
    # Every reader of ``words`` is to find the same shuffle: the place in the sentence is a key and not three sums, of
    # which each reader would count its own, and the filter, which drops nothing, is the one that joins on terms add.
    placed = spoken.select(by, F.size("_w").alias("_len"), F.posexplode_outer("_w").alias("_i", "term")).where(F.col("term").isNotNull())
    place = F.when(F.col("_i") == 0, "first").when(F.col("_i") + 1 == F.col("_len"), "last").otherwise("inside")
    words = placed.groupBy(by, "term", place.alias("_place")).agg(F.count(F.lit(1)).alias("n"))
    total = words.agg(F.sum("n")).scalar()
    frequent = words.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= total * F.lit(min_share)).select("term")
    pairs = F.arrays_zip(
        F.slice("_w", F.lit(1), F.size("_w") - 1).alias("first_word"), F.slice("_w", F.lit(2), F.size("_w") - 1).alias("second_word"))
    met = (
        spoken.select(by, F.inline_outer(pairs))
        # at most 1 / min_share words each
        .join(F.broadcast(frequent.withColumnRenamed("term", "first_word")), "first_word", "left_semi")
        .join(F.broadcast(frequent.withColumnRenamed("term", "second_word")), "second_word", "left_semi")
        .groupBy(by, "first_word", "second_word").agg(F.count(F.lit(1)).alias("n"))
    )
    starts, follows = F.col("_place") != "last", F.col("_place") != "first"
    # sums over frequent words only, hence small; all pairs of a group are one row
    sizes = words.groupBy(by).agg(F.sum(F.when(starts, F.col("n"))).alias("_total"))
    # an inner join: a semi-join would move below the sums and make them another shuffle of the whole text
    margin = words.join(F.broadcast(frequent), "term").groupBy(by, "term").agg(
        F.sum(F.when(starts, F.col("n")).otherwise(0)).alias("as_first"), F.sum(F.when(follows, F.col("n")).otherwise(0)).alias("as_second"))
    first = margin.select(F.col(by).alias("_g1"), F.col("term").alias("_t1"), F.col("as_first").alias("_first"))
    second = margin.select(F.col(by).alias("_g2"), F.col("term").alias("_t2"), F.col("as_second").alias("_second"))
    whole = sizes.withColumnRenamed(by, "_g3")
    return (
        met.join(first, (F.col("first_word") == F.col("_t1")) & F.col(by).eqNullSafe(F.col("_g1")))
        .join(second, (F.col("second_word") == F.col("_t2")) & F.col(by).eqNullSafe(F.col("_g2")))
        .join(whole, F.col(by).eqNullSafe(F.col("_g3")))
        .select(
            by, "first_word", "second_word", "n",
            F.round(likelihood_ratio(F.col("n"), F.col("_first"), F.col("_second"), F.col("_total")), 2).alias("g2"),
            (F.col("n") * F.col("_total") > F.col("_first") * F.col("_second")).alias("attracted"))
    )


def theme_phrases(reviews: DataFrame, by: str = "channel", k: int = 10, min_share: float = 1e-4, min_count: int = 3) -> DataFrame:
    """The ``k`` phrases of each group that most exceed chance; ties by the words."""
    best = Window.partitionBy(by).orderBy(F.desc("g2"), F.asc("first_word"), F.asc("second_word"))
    kept = phrase_counts(reviews, by, min_share).where(F.col("attracted") & (F.col("n") >= min_count))
    return kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        by, "rank", F.concat_ws(" ", "first_word", "second_word").alias("phrase"), "n", "g2")

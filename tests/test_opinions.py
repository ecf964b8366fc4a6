"""Learned opinion words, negation, rating order and phrases against plain versions."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martlens.operators import opinions, phrases
from martlens.operators import reviews as listed
from martlens.sources import testdata as td

NEGATIONS = ("not", "no")


def _reviews(spark, rows):
    return spark.createDataFrame(
        [(i, "web", "c", "p", r, t) for i, (r, t) in enumerate(rows)],
        "review_id bigint, channel string, product_category string, product_name string, rating int, review_text string")


def _plain_tokens(text):
    """Marked words by walking over the words of each sentence."""
    out = []
    for sentence in re.split(r"[.!?\n]", text.lower()):
        left = 0
        words = re.findall(r"[^\W\d_]+", sentence)
        for k, word in enumerate(words):
            if left:
                out.append("NOT" + word)
                left -= 1
            else:
                out.append(word)
                left = opinions.SCOPE if word in NEGATIONS and k + 1 < len(words) else 0
    return [w for w in out if w]


TEXTS = [
    "Not a good tent. Good!", "no no no no no no", "not. good", "It is NOT very, very good at all", "knot good", "", "...", "not",
    "nothing not\nbad", "I do not, not like it. No doubt: no-good zip", "not " * 50, "ÉTÉ not été",
]


def test_negation_reaches_the_next_words_of_the_sentence(spark):
    frame = _reviews(spark, [(3, t) for t in TEXTS] + [(3, None)])
    rows = frame.select("review_text", opinions.opinion_tokens("review_text", NEGATIONS).alias("w")).collect()
    for text, words in rows:
        found = None if words is None else [w for w in words if w not in ("", "NOT")]
        assert found == (None if text is None else _plain_tokens(text)), text


def test_very_long_text(spark):
    frame = _reviews(spark, [(5, "not good " * 50_000), (1, "not" + " " * 200_000), (1, "x" * 200_000)])
    found = opinions._words(frame, "rating", negations=NEGATIONS, scope=3).groupBy("term").count()
    assert sum(r["count"] for r in found.collect()) == 100_002


def test_weights_equal_a_plain_version(spark):
    rows = [(5, "good good warm tent"), (5, "good tent"), (1, "not good tent"), (2, "bad bad tent"), (3, "tent good"), (None, "bad bad bad")]
    got = {r.term: r for r in opinions.opinion_words(_reviews(spark, rows), NEGATIONS, prior=10.0, min_count=1).collect()}
    low, high, every = Counter(), Counter(), Counter()
    for rating, text in rows:
        if rating is not None:
            for w in _plain_tokens(text):
                every[w] += 1
                low[w] += rating <= 2
                high[w] += rating >= 4
    nl, nh, n = sum(low.values()), sum(high.values()), sum(every.values())
    assert set(got) == set(every)
    for w in every:
        a = 10.0 * every[w] / n
        h, m = high[w] + a, low[w] + a
        z = (math.log(h / (nh + 10 - h)) - math.log(m / (nl + 10 - m))) / math.sqrt(1 / h + 1 / m)
        assert got[w].weight == pytest.approx(z, abs=0.0006) and (got[w].low, got[w].high) == (low[w], high[w])
    assert got["good"].weight > 0 > got["NOTgood"].weight


def test_held_out_order_beats_the_lists(spark):
    """Reviews that praise by negated complaints: lists read them the wrong way round."""
    good = ["not a bad tent", "warm and never broken", "not broken not bad", "sturdy and warm"]
    bad = ["not a good tent", "no warm nights", "broken and bad", "not sturdy"]
    rows = [(5, good[i % 4] + f". item {i % 7}") if i % 2 else (1, bad[i // 2 % 4] + f". item {i % 5}") for i in range(400)]
    frame = _reviews(spark, rows)
    held = F.col("review_id") % 5 == 0
    words = opinions.opinion_words(frame.where(~held), opinions.NEGATIONS, prior=50.0)
    learned = opinions.rating_order(opinions.learned_sentiment(frame.where(held), words)).first()
    by_list = opinions.rating_order(listed.review_sentiment(frame.where(held))).first()
    assert learned.pairs_in_order > 0.99 and learned.pairs_in_order > by_list.pairs_in_order + 0.1


def test_held_out_order_on_the_test_tables(spark):
    """On the largest test folder (813 held-out ratings); the 76 of sf0.01 are too few, see README."""
    frame = td.reviews(spark, "/root/testdata/sf0.1")
    held = F.col("review_id") % 5 == 0
    words = opinions.opinion_words(frame.where(~held), td.TEST_NEGATIONS)
    learned = opinions.rating_order(opinions.learned_sentiment(frame.where(held), words, negations=td.TEST_NEGATIONS)).first()
    by_list = opinions.rating_order(listed.review_sentiment(frame.where(held), td.TEST_POSITIVE, td.TEST_NEGATIVE)).first()
    assert learned.pairs_in_order > by_list.pairs_in_order + 0.03


def test_nothing_to_learn_from(spark):
    empty = _reviews(spark, [])
    assert opinions.opinion_words(empty, NEGATIONS).count() == 0
    unrated = _reviews(spark, [(None, "good"), (None, None)])
    scored = opinions.learned_sentiment(unrated, opinions.opinion_words(unrated, NEGATIONS), negations=NEGATIONS)
    assert [(r.sentiment_score, r.opinion_words) for r in scored.collect()] == [(0.0, 0)] * 2
    order = opinions.rating_order(scored).first()
    assert (order.low_reviews, order.high_reviews, order.pairs_in_order) in ((0, 0, None),)


def test_phrases_equal_a_plain_version(spark):
    texts = ["Rain cover leaks. Rain cover, torn!", "the rain cover", "cover the rain\nthe tent", "", None, "one", "rain. cover"] * 3
    frame = _reviews(spark, [(3, t) for t in texts])
    got = {(r.first_word, r.second_word): r for r in phrases.phrase_counts(frame, min_share=0.0).collect()}
    pairs = Counter()
    for t in texts:
        for sentence in re.split(r"[.!?\n]+", t or ""):
            w = re.findall(r"[^\W\d_]+", sentence.lower())
            pairs.update(zip(w, w[1:]))
    n = sum(pairs.values())
    assert {k: r.n for k, r in got.items()} == dict(pairs)
    for (a, b), o in pairs.items():
        r, c = sum(v for k, v in pairs.items() if k[0] == a), sum(v for k, v in pairs.items() if k[1] == b)
        cells = [(o, r, c), (r - o, r, n - c), (c - o, n - r, c), (n - r - c + o, n - r, n - c)]
        g2 = 2 * sum(x * math.log(x * n / (y * z)) for x, y, z in cells if x)
        assert got[a, b].g2 == pytest.approx(g2, abs=0.006) and got[a, b].attracted == (o * n > r * c)


def test_phrases_need_frequent_words_and_a_null_group_is_a_group(spark):
    frame = _reviews(spark, [(3, "rain cover rain cover rain cover odd word")]).withColumn("channel", F.lit(None).cast("string"))
    rows = phrases.theme_phrases(frame, min_share=0.2, min_count=3).collect()
    assert [(r.channel, r.phrase, r.n) for r in rows] == [(None, "rain cover", 3)]
    assert phrases.theme_phrases(_reviews(spark, [])).count() == 0


def test_phrases_read_the_text_twice(spark):
    rows = [(3, "rain cover leaks. the rain cover, torn"), (4, "cover the rain. odd tent")] * 5
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = _reviews(spark, rows)
    assert phrases.phrase_counts(frame.mapInArrow(counted, frame.schema), min_share=0.01).collect()
    assert seen.value == 2 * len(rows)

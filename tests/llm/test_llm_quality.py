import itertools
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tallyward.llm import common, ordinal, quality_rules

TEXT = st.text(st.sampled_from(list("ab \n\t\x0b\x1c é#")), max_size=60)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


@settings(deadline=None, max_examples=300)
@given(TEXT)
def test_base_counts_match_brute_force(text):
    assert quality_rules.base_counts(text) == brute_counts(text)


def test_repeats_in_a_long_text():
    words = ["a", "b", "c", "d", "e"] * 3 + [f"w{i}" for i in range(100)]
    assert quality_rules.base_counts(" ".join(words)) == brute_counts(" ".join(words))
    assert quality_rules.base_counts("x " * 200_000)[4] == 200_000


def test_viterbi_finds_the_best_of_all_sequences():
    rng = np.random.default_rng(1)
    for lines in range(1, 7):
        chain = quality_rules.LineChain(rng.normal(size=(quality_rules.FEATURES, 2)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(lines, quality_rules.FEATURES))
        emit = x @ chain.weights

        def total(path):
            return sum(emit[i, s] for i, s in enumerate(path)) + sum(chain.moves[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=lines), key=total)
        assert tuple(chain.decode(x)) == best


def test_gradient_of_the_chain():
    rng = np.random.default_rng(2)
    chain = quality_rules.LineChain(rng.normal(size=(quality_rules.FEATURES, 2)), rng.normal(size=(2, 2)))
    x, y = rng.normal(size=(3, 4, quality_rules.FEATURES)), rng.integers(0, 2, (3, 4))
    real = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)
    _, by_weight, by_move = chain.gradient(x, y, real)
    for array, grad in ((chain.weights, by_weight), (chain.moves, by_move)):
        for at in [(0, 0), (1, 1)]:
            kept = array[at]
            array[at] = kept + 1e-5
            up = chain.gradient(x, y, real)[0]
            array[at] = kept - 1e-5
            down = chain.gradient(x, y, real)[0]
            array[at] = kept
            assert grad[at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


LOUD = "BUY!! NOW!! ALL!! THE!! NEW!! WARES!! FOR!! LESS!! THAN!! ONE!! COIN!! TODAY!!"
CALM = "the river runs past the old mill and children play near its quiet banks"


def labelled(spark):
    other = "at noon some boats come up from town and stay until the evening bell rings"
    texts = [f"{CALM} on day {i}\n{other} again {i}" if i % 2 else f"{LOUD} {i}\nNO!! {LOUD[::-1]} A{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_trained_chain_keeps_calm_documents(spark):
    docs, labels = labelled(spark)
    chain = quality_rules.train(docs, labels)
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, chain).collect()}
    assert got == {i: i % 2 == 1 for i in range(60)}
    stays = quality_rules.keep_good(docs, chain)
    assert stays.columns == docs.columns
    assert {r.doc_id for r in stays.collect()} == {i for i in range(60) if i % 2}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, CALM), (5, CALM), (5, CALM), (6, "word " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(docs, quality_rules.train(docs, none)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if r.kept} == {None, 5}
    assert quality_rules.judge(docs.limit(0), quality_rules.train(docs.limit(0), none)).count() == 0


def test_ordinal_regression_orders_grades(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        grade = i % 3
        rows.append((i, " ".join(rng.choice([["bad", "dull"], ["fair", "plain"], ["fine", "rich"]][grade], 20)), grade))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, grade int")
    model = ordinal.train(docs, ratings, ratings["grade"])
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in ordinal.rate(docs, model).collect()}
    assert sum(got[i].grade == g for i, _, g in rows) >= 295
    mean = [np.mean([got[i].expected_grade for i, _, g in rows if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert all(got[i].kept == (g >= 1) for i, _, g in rows if got[i].grade == g)


def test_ordinal_without_ratings_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (4, "a " * 100_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    got = ordinal.rate(docs, ordinal.train(docs, none, none["grade"])).collect()
    assert [(r.expected_grade, r.grade, r.p_tail, r.kept) for r in got] == [(0.0, 0, 0.0, False)] * 4


def test_sample_is_the_smallest_hashes(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 3 as double) as y")
    got = {r.doc_id for r in common.smallest_hashes(rows, 500).collect()}
    order = rows.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("h")).toPandas().sort_values("h")
    assert got == set(order["doc_id"][:500])
    assert common.smallest_hashes(rows.limit(0), 5).count() == 0 and common.smallest_hashes(rows, 10**6).count() == 20_000


def test_sample_of_more_rows_than_long_products_hold(spark, monkeypatch):
    """The number of rows is stubbed: 2^24 places of 40 bits do not fit in 63."""
    rows = spark.range(2_000).selectExpr("id as doc_id", "cast(id % 3 as double) as y")
    monkeypatch.setattr(common.F, "count", lambda _: F.max(F.lit(1 << 24)))
    assert len(common.smallest_hashes(rows, 1 << 23).collect()) == 2_000
    few = {r.doc_id for r in common.smallest_hashes(rows, 1 << 19).collect()}
    place = rows.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("h")).collect()
    assert few == {r.doc_id for r in place if r.h * (1 << 24) <= (1 << 40) * (2 * (1 << 19) + 100)}

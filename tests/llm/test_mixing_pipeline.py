import math
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyward.llm import common, mixing, pii, quality_rules, simhash

FOLDER = "/root/testdata/sf0.01"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def weights(tokens, alpha):
    total = sum(tokens.values())
    raw = {s: (t / total) ** alpha for s, t in tokens.items()}
    return {s: w / sum(raw.values()) for s, w in raw.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def brute_alpha(tokens, target):
    """Plain bisection on each condition."""
    total = sum(tokens.values())

    def repeats(alpha):
        w = weights(tokens, alpha)
        turns = {s: w[s] / tokens[s] for s in tokens}
        scale = target.budget if target.budget is not None else 1 / min(turns.values())
        return max(turns.values()) * scale

    def last(good):
        if good(1.0):
            return 1.0
        if not good(0.0):
            return None
        low, high = 0.0, 1.0
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if good(mid) else (low, mid)
        return low

    a = last(lambda x: entropy(weights(tokens, x)) >= target.entropy * math.log(len(tokens)) - 1e-12) or 0.0
    b = last(lambda x: repeats(x) > target.repeats * (1 + 1e-12))
    return a if b is None else max(a, b)


def corpus(spark):
    rows = [(i, "word " * (1 + i % 7), ["big", "mid", "small"][min(2, (i % 20) // 12 + (i % 20) // 18)]) for i in range(400)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("target", [
    mixing.Target(entropy=0.95, repeats=50.0, budget=1_000), mixing.Target(entropy=1.0, repeats=1.5, budget=1_600),
    mixing.Target(entropy=0.9, repeats=2.0), mixing.Target(entropy=1.0, repeats=100.0),
])
def test_mixture_matches_brute_force(spark, target):
    rows, docs = corpus(spark)
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split())
    alpha = brute_alpha(tokens, target)
    want = weights(tokens, alpha)
    got = mixing.mixture(docs, target).collect()
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
        assert r.weight == pytest.approx(want[r.source], abs=1e-9)
    spent = {s: sum(r.n_tokens for r in rs) for s, rs in by_source.items()}
    least = min(w / tokens[s] for s, w in want.items())
    for s, rs in by_source.items():
        budget = want[s] * target.budget if target.budget is not None else want[s] / least
        assert budget - 8 <= spent[s] <= budget + 1e-6
        per_doc = Counter(r.doc_id for r in rs)
        whole = int(spent[s] // tokens[s])
        assert set(per_doc.values()) <= {whole, whole + 1}
        # the last epoch is a prefix of its permutation
        last = [r for r in rs if r.epoch == whole]
        if last:
            chosen = {r.doc_id for r in last}
            order = sorted(
                (r.place, r.doc_id) for r in docs.where(F.col("source") == s).select(
                    "doc_id", mixing._place(F.col("doc_id"), F.lit(whole).cast("long")).alias("place")).collect()
            )
            assert {i for _, i in order[: len(chosen)]} == chosen
    assert all(0 <= r.mix_key < 1.5 for r in got)
    assert Counter(r[0] for r in rows_of(mixing.mix(docs, target).select("doc_id"))) == Counter(r.doc_id for r in got)


def test_mixing_odd_rows(spark):
    rows = [
        (1, "a b c", None, 1), (2, None, "x", 1), (3, "", "x", 1), (None, "d e", "x", 1), (4, "f", "y", 1), (4, "f", "y", 1),
        (5, "long " * 30_000, "y", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")
    everything = mixing.mix(docs, mixing.Target(entropy=0.0, repeats=1.0))
    assert everything.columns == docs.columns
    assert sorted(map(str, rows_of(everything))) == sorted(map(str, rows))
    none = spark.createDataFrame([(1, None, "x"), (2, " ", "y")], "doc_id long, text string, source string")
    assert mixing.mix(none, mixing.Target()).count() == 2
    assert mixing.mixture(docs.limit(0), mixing.Target(budget=5)).count() == 0
    assert {r.source for r in mixing.mixture(docs, mixing.Target(budget=0)).collect()} == {"x"}  # only texts without words


def test_pipeline_matches_its_operators_one_by_one(spark, tmp_path):
    """The stages on collected rows, with plain Python around the per-text functions."""
    docs = common.table(spark, FOLDER, "documents")
    chain = quality_rules.train(docs, common.table(spark, FOLDER, "labels"))
    left = [r for r in docs.collect() if quality_rules.verdict(chain, r.text)]
    prints = [simhash.fingerprint(r.text) for r in left]
    order = sorted(range(len(left)), key=lambda i: left[i].doc_id)
    root = {i: i for i in order}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, i in enumerate(order):
        for j in order[:a]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                x, y = find(i), find(j)
                if x != y:
                    first, second = sorted((x, y), key=lambda k: left[k].doc_id)
                    root[second] = first
    left = [left[i] for i in order if find(i) == i]
    model = pii.SpanClassifier(Counter(
        pii.pattern(k, said) for r in left for k, _, _, _, said in pii.spans_with_votes(r.text)
    ))
    texts = {r.doc_id: (pii.masked(r.text, model), r.source) for r in left}
    tokens = Counter()
    for t, s in texts.values():
        tokens[s] += len(t.split())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {i: len(library.encode(t, add_special_tokens=False).ids) for i, (t, _) in texts.items()}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(texts)
    assert all(r.n_tokens == sizes[r.doc_id] for r in got)
    times = Counter(r.doc_id for r in got)
    spent = Counter()
    for i, n in times.items():
        spent[texts[i][1]] += n * len(texts[i][0].split())
    target = mixing.Target(entropy=0.97, repeats=2.0)
    want = weights(tokens, brute_alpha(tokens, target))
    least = min(w / tokens[s] for s, w in want.items())
    assert all(0 <= want[s] / least - spent[s] < 3_000 or spent[s] == tokens[s] for s in tokens)


def test_stages_keep_the_columns_of_documents(spark):
    docs = common.table(spark, FOLDER, "documents").limit(60).withColumn("component_id", F.lit("mine"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.where("component_id = 'mine'").count() == out.count()
    empty = docs.limit(0)
    assert all(stage(spark, empty, FOLDER).count() == 0 for _, stage in corpus_pipeline.STAGES)

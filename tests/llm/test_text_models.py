import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import common, langid, queries, toxicity

FOLDER = "/root/testdata/sf0.1"


def test_backpropagation_through_time():
    rng = np.random.default_rng(3)
    net = langid.ByteNetwork(["a", "b", "c"], hidden=3)
    x, y = rng.integers(0, 256, (7, 4)), np.array([0, 1, 2, 1])
    real = np.ones((7, 4), np.float32)
    real[5:, 1] = 0
    _, grads = net.step(x, y, real)
    for w, g in zip([*net.ahead.weights, *net.behind.weights, net.out, net.bias], grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = w[at]
        w[at] = kept + 1e-2
        up = net.step(x, y, real)[0]
        w[at] = kept - 1e-2
        down = net.step(x, y, real)[0]
        w[at] = kept
        assert g[at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=1e-4)


def test_batched_windows_equal_one_text_at_a_time():
    net = langid.ByteNetwork(["a", "b"], hidden=4)
    texts = ["x" * 200, "kurz", "ä" * 77, "z" * 64]
    alone = [net.predict([t])[1][0] for t in texts]
    assert net.predict(texts)[1] == pytest.approx(alone, rel=1e-4)
    assert len(net.label_positions("abc" * 50)) == 150


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "en"), (2, "", "en"), (3, "12 34 !", None), (None, "the cat and the dog", "en"), (5, "le chat est noir", "fr")],
        "doc_id long, text string, lang string",
    )
    held = common.fold(F.col("doc_id"), 4) == 2
    got = langid.identify(docs, langid.train(docs, F.lit(True), epochs=1), held).collect()
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert all(r.lang_pred in ("en", "fr") and 0 <= r.score <= 1 for r in got[3:]) and got[3].held_out is False
    nothing = langid.identify(docs, langid.train(docs.limit(0), F.lit(True)), held).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_language_held_out_accuracy(spark):
    got = queries.op3_language_id(spark, FOLDER).join(
        common.table(spark, FOLDER, "documents").select("doc_id", "lang"), "doc_id"
    )
    right = got.groupBy("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).collect()
    assert len(right) == 2 and all(r[1] > 0.985 for r in right)


def test_restoring_disguised_words(spark):
    texts = ["you idiot and moron, what a stupid clown", "worthless trash and scum", "the plain words of a plain text"] * 50
    model = toxicity.LetterModel(toxicity.letter_counts(texts))
    reader = toxicity.Reader(model)
    assert [model.restore(w) for w in ("1d10t", "m0r0n", "5tup1d", "idiiiiot", "$cum", "tr@sh")] == [
        "idiot", "moron", "stupid", "idiot", "scum", "trash"
    ]
    assert reader.words("an i d i o t, a m.o.r.o.n and W0RTHL355!!") >= {"idiot", "moron", "worthless"}
    assert reader.words("Plain*** words!! of 1999") == {"plain", "words", "of", "1999"}
    assert reader.restored(None) == "" and "idiot" in reader.restored("what an 1d1ot")


def test_restoring_long_and_spaced_words():
    texts = ["you are an idiot and a moron, what a clown", "go and die now", "some long glued phrase for a token"] * 50
    reader = toxicity.Reader(toxicity.LetterModel(toxicity.letter_counts(texts)))
    assert reader.restored("i" * 60 + "diot") == "idiot"
    assert "idiot" in reader.words("some_long_glued_phrase_for_a_token_which_is_long_1d1ot")
    assert {"are", "an", "idiot"} <= reader.words("y o u a r e a n i d i o t")
    assert reader.restored("go d i e now") == "go die now" and "die" in reader.words("d i e")
    assert [reader.restored(t) for t in ("you id iot", "i d  i o t", "1 2 3 4")] == ["you idiot", "idiot", "1 2 3 4"]
    spaced = " ".join("idiot" * 30)
    assert reader.restored(spaced).replace(" ", "") == "idiot" * 30


def test_viterbi_reading_is_the_best_of_all(spark):
    texts = ["sell bell less see bee bees cell"] * 20
    model = toxicity.LetterModel(toxicity.letter_counts(texts))

    def readings(token):
        """All readings with the score of the channel and the letters."""
        out = [("", 0.0, "")]
        for c in token:
            options = [(c, 0.0)] if c.isalpha() else []
            options += [(x, toxicity.REPLACED) for x in toxicity.IMITATED.get(c, "")]
            grown = []
            for text, cost, last in out:
                if not options:
                    grown.append((text, cost + toxicity.DROPPED, last))
                for x, k in options:
                    grown.append((text + x, cost + k, x))
                    if x == last:
                        grown.append((text, cost + k + toxicity.DROPPED, last))
            out = grown

        def letters(text):
            codes = [0, 0, *(toxicity._INDEX[c] for c in text), 0]
            return sum(float(model.log[a, b, c]) for a, b, c in zip(codes, codes[1:], codes[2:]))

        return max((cost + letters(text), text) for text, cost, _ in out)[1]

    for token in ("5e11", "b33", "lll355", "s33s5", "c3!l"):
        assert model.restore(token) == readings(token)


def test_toxicity_held_out_and_disguised(spark):
    docs = common.documents(spark, FOLDER)
    held = common.fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, common.table(spark, FOLDER, "labels"), ~held)
    got = toxicity.score(docs, model, held).join(common.table(spark, FOLDER, "labels"), "doc_id").where("held_out").toPandas()
    assert got[got.toxic == 1].predicted.mean() > 0.85 and got[got.toxic == 0].predicted.mean() < 0.03
    plain = spark.createDataFrame(
        [(1, "the of 1d10t and m0r0n with s c u m here"), (2, "the of and with here"), (3, None), (4, ""), (None, "the")],
        "doc_id long, text string",
    )
    by_id = {r.doc_id: r.score for r in toxicity.score(plain, model, F.lit(False)).collect()}
    assert by_id[1] > 0.5 > by_id[2] and by_id[3] == by_id[4] < 0.5 and len(by_id) == 5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none, F.lit(True))
    assert [(r.score, r.predicted) for r in toxicity.score(docs, model, F.lit(False)).collect()] == [(0.0, 0)] * 2
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none, F.lit(True)), F.lit(False)).count() == 0

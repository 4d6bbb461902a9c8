from pyspark.sql import functions as F

from tallyward.llm import common, langid, ordinal, quality_rules, toxicity

DOCS = "doc_id long, text string, lang string"


def test_rare_values_are_in_the_sample(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 1000 == 7).cast("int").alias("toxic"))
    plain = common.labelled(docs, labels, F.col("toxic"), 40).toPandas()
    kept = common.labelled(docs, labels, F.col("toxic"), 40, least=4).toPandas()
    assert len(plain) == 40 and set(plain["doc_id"]) <= set(kept["doc_id"])
    assert (kept["y"] == 1).sum() >= 4 and len(kept) <= 48
    assert common.labelled(docs.limit(0), labels, F.col("toxic"), 40, least=4).count() == 0


def test_a_repeated_id_adds_one_row(spark):
    many = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 3).alias("text"))
    docs = many.unionByName(spark.createDataFrame([(2, "other"), (3, None)], "doc_id long, text string"))
    labels = docs.select("doc_id", F.lit(1).alias("y1"))
    got = sorted(tuple(r) for r in common.labelled(docs, labels, F.col("y1"), 5, least=2).collect())
    assert got == [(1, "t0", 1.0), (2, "other", 1.0), (3, None, 1.0)]


def test_a_rare_language_is_learned(spark):
    """One row in two thousand: fewer than the sample of a common language holds."""
    common_ = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("the cat and the dog are in the house").alias("text"), F.lit("en").alias("lang"))
    rare = spark.range(6000, 6003).select(F.col("id").alias("doc_id"), F.lit("щука и рыба живут в большой воде").alias("text"), F.lit("ru").alias("lang"))
    docs = common_.unionByName(rare)
    model = langid.train(docs, F.lit(True), epochs=6, per_language=20)
    assert model.languages == ["en", "ru"]
    asked = spark.createDataFrame([(1, "рыба в воде"), (2, "the dog in the house")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(asked, model, F.lit(False)).orderBy("doc_id").collect()] == ["ru", "en"]


def test_stretches_cover_or_spread_over_all_lines():
    assert quality_rules.stretches(130, 8, 64) == [(0, 64), (64, 128), (128, 130)]
    far = quality_rules.stretches(10_000, 8, 64)
    assert len(far) == 8 and far[0] == (0, 64) and far[-1] == (9936, 10_000) and quality_rules.stretches(0, 8, 64) == []


def test_late_lines_change_the_chain(spark):
    """What stands after many lines is learned from: the documents differ only there."""
    head = "\n".join(f"a plain sentence number {k} of some length here" for k in range(70))
    junk, prose = "$$$ BUY | NOW | !!! ###\n" * 300, "\n".join(f"one more sentence with the number {k} in it" for k in range(300))
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(20)], "doc_id long, quality int")

    def chain(tail):
        rows = [(i, f"{head}\n{prose if i < 10 else tail}") for i in range(20)]
        return quality_rules.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)

    told, same = chain(junk), chain(prose)
    x, _ = quality_rules.line_features(junk)
    assert told.decode(x).mean() < 0.1 and told.content_share(prose) > 0.9
    assert abs(told.weights - same.weights).max() > 0.1


def test_words_of_any_length_have_a_shape():
    assert ordinal.shape("a" * 100 + "9!") == "a9!" and ordinal.shape("Ab9" * 200) == "Aa9" * 200


def test_plain_sentences_come_back_unchanged():
    texts = [
        "I am in an old inn and we go to it", "the cat is on the mat in the sun", "we all see the book on the 3rd of May at 10am",
        "see https://ai.example.com/x1 or the B2B part 2 of it", "he is 55 and so am I", "do as you are told, Ann and Bob",
    ] * 60
    reader = toxicity.Reader(toxicity.LetterModel(toxicity.letter_counts(texts)))
    assert [t for t in texts[:6] if reader.restored(t) != t] == []


def test_stretches_are_read_by_the_best_of_all_readings():
    """Every way to skip the gaps of short stretches, with its price."""
    import itertools

    texts = ["you are an idiot and a moron, go and die now", "the id of an old io set is odd", "mo and ron see it"] * 40
    model = toxicity.LetterModel(toxicity.letter_counts(texts))

    def score(words):
        return model.plain(" ".join(words))

    def best(parts):
        found = []
        for skipped in itertools.product((False, True), repeat=len(parts) - 1):
            words, price, on = [parts[0]], 0.0, False
            for left, right, skip in zip(parts, parts[1:], skipped):
                if skip:
                    short = len(left) == len(right) == 1
                    more = toxicity.JOINED * (len(left) + len(right) - 1)
                    price += more if on else toxicity.FIRST_SHORT if short else toxicity.FIRST
                    words[-1] += right
                else:
                    words.append(right)
                on = skip
            found.append((score(words) + price, words))
        return max(found)[1]

    for stretch in ("i d i o t", "go d i e now", "id iot", "an old id", "mo ron", "a mo r on is", "i o s e t", "see it go", "d i e d"):
        assert model.join(stretch.split()) == best(stretch.split()), stretch

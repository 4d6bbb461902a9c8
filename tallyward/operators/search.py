"""Vector index upkeep, exact similarity search and prompt context.

Search is exact for any number of questions. Questions are dealt into blocks
and the index into shards, each of a bounded number of rows, by hash; every
block meets every shard in one task, which makes one matrix product at a time
and keeps the k best per question. So the shuffle carries the index once per
block and ``shards x questions x k`` hits, never pairs, and nothing passes
through the driver. All questions meet all rows, which is quadratic where both
grow; blocks of bounded size keep memory bounded, and large ones the shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyward.functions import prompts
from tallyward.functions.fixed_values import INDEX_MIN_ROWS, TOP_K

#: Questions of a block and rows of a shard, at most. Fewer questions than ``SPREAD`` blocks of this size hold are dealt
#: to as many blocks, but to none of under ``FEW`` questions.
BLOCK_QUESTIONS, SHARD_ROWS, SPREAD, FEW = 50_000, 25_000, 24, 2_000
#: Questions and rows of one matrix product; pairs that are scored in double precision at once, and so many for each question.
ASKED_AT_ONCE, ROWS_AT_ONCE, PAIRS_AT_ONCE, PAIRS_EACH = 2_048, 1_024, 100_000, 20
SCORE_DIGITS = 9


def unit_rows(vectors) -> np.ndarray:
    """Vectors of one length as rows of length one; a zero stays a zero."""
    if isinstance(vectors, np.ndarray) and vectors.ndim == 2:
        x = vectors.astype(np.float64)
    else:
        x = np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), -1)
    length = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def without_copies(x: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of equal rows, in order: with rows ordered by key no other copy can be a hit."""
    if not x.size:
        return np.arange(len(x))
    _, group = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0])
    place = np.arange(len(x)) - np.repeat(first, np.diff(np.r_[first, len(x)]))
    return np.sort(order[place < k])


class Nearest:
    """The ``k`` best rows of some questions, from rows offered one stretch after another.

    Products are made in single precision and only leave out what is worse
    than the k-th best so far by more than their error; what remains is scored
    in double precision. ``rank`` orders rows of equal score; ``bar`` is a
    score below which nothing is wanted.
    """

    def __init__(self, questions: np.ndarray, rows: np.ndarray, rows32: np.ndarray, rank: np.ndarray, k: int, bar: np.ndarray | None = None):
        self.questions, self.rows, self.rows32, self.rank, self.k = questions, rows, rows32, rank, k
        self.asked32 = questions.astype(np.float32)
        self.error = (questions.shape[1] + 16) * 2.0**-23
        self.bar = np.full(len(questions), -np.inf) if bar is None else bar - self.error
        self.held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def offer(self, low: int, high: int, some: np.ndarray | None = None) -> None:
        """Compare ``some`` questions (or all) with the rows of a stretch."""
        rough = (self.asked32 if some is None else self.asked32[some]) @ self.rows32[low:high].T
        bar = self.bar if some is None else self.bar[some]
        unset = np.flatnonzero(np.isneginf(bar))
        if len(unset) and high - low > self.k:
            at = high - low - self.k
            bar = bar.copy()
            bar[unset] = np.partition(rough[unset], at, axis=1)[:, at].astype(np.float64) - 2 * self.error
            self.bar[slice(None) if some is None else some] = bar
        q, row = divmod(np.flatnonzero(rough >= bar.astype(np.float32)[:, None]), high - low)
        if len(q):
            self.new.append((q if some is None else some[q], row + low))
            self.waiting += len(q)
            if self.waiting > min(PAIRS_AT_ONCE, PAIRS_EACH * len(self.questions)):
                self._settle()

    def _settle(self) -> None:
        q, row = (np.concatenate(c) for c in zip(*self.new))
        score = np.empty(len(q))
        for at in range(0, len(q), PAIRS_AT_ONCE):
            here = slice(at, at + PAIRS_AT_ONCE)
            score[here] = np.einsum("ij,ij->i", self.questions[q[here]], self.rows[row[here]])
        # Rounded before ranking, so equal vectors tie and the key decides.
        score = np.round(score, SCORE_DIGITS) + 0.0
        q, row, score = (np.concatenate(c) for c in zip(self.held, (q, row, score)))
        order = np.lexsort((self.rank[row], -score, q))
        q, row, score = q[order], row[order], score[order]
        first = np.flatnonzero(np.r_[True, np.diff(q) > 0])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        last = place == self.k - 1
        self.bar[q[last]] = np.maximum(self.bar[q[last]], score[last] - self.error - 10.0**-SCORE_DIGITS)
        self.held = tuple(c[place < self.k] for c in (q, row, score))
        self.new, self.waiting = [], 0

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, row, score) of the best, by question."""
        if self.new:
            self._settle()
        return self.held


def _dealt(df: DataFrame, key: str, vector: str, own: str, rows: int, other: DataFrame, other_name: str, other_rows: int) -> DataFrame:
    """Rows with a sound vector, by hash into parts of about ``rows`` rows, once for each part of the other side.

    The numbers of parts are subqueries of the same plan. Vectors travel in the type they have."""
    def parts(d: DataFrame, most: int, name: str):
        n = F.count(F.lit(1))
        spread = F.least(F.ceil(n / FEW), F.lit(SPREAD)) if name == "_block" else F.lit(1)
        return d.agg(F.greatest(F.ceil(n / most), spread, F.lit(1)).cast("bigint")).scalar()

    sound = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    narrow = df.schema[vector].dataType.simpleString() in ("array<float>", "array<double>")
    value = F.col(vector) if narrow else F.col(vector).cast("array<double>")
    return df.select(key, value.alias("_vector")).withColumnRenamed("_vector", vector).filter(sound).select(
        F.col(key),
        F.col(vector),
        F.size(vector).alias("_dim"),
        F.pmod(F.xxhash64(key), parts(df, rows, own)).alias(own),
        F.explode(F.sequence(F.lit(0).cast("bigint"), parts(other, other_rows, other_name) - 1)).alias(other_name),
    )


def similarity_topk(
    index: DataFrame,
    key: str,
    vector: str,
    questions: DataFrame,
    question: str,
    question_vector: str,
    k: int = TOP_K,
    block_questions: int = BLOCK_QUESTIONS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` index rows nearest to each question by cosine, with rank.

    Filters on index metadata go on ``index`` beforehand and reach its scan.
    NULL vectors, and vectors with NULL, NaN or infinity, give no hits on either side;
    vectors are compared with those of their own length.
    """
    schema = StructType([questions.schema[question], index.schema[key], StructField("score", DoubleType())])
    shards = _dealt(index, key, vector, "_shard", shard_rows, questions, "_block", block_questions)
    blocks = _dealt(questions, question, question_vector, "_block", block_questions, index, "_shard", shard_rows)

    def best(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame()
        held = held.sort_values(key, kind="stable", ignore_index=True)
        x = unit_rows(held[vector])
        kept = without_copies(x, k)
        x, keys, ids, wanted = x[kept], held[key].to_numpy()[kept], asked[question].to_numpy(), unit_rows(asked[question_vector])
        rows32, rank, out = x.astype(np.float32), np.arange(len(x)), []
        for at in range(0, len(ids), ASKED_AT_ONCE):
            near = Nearest(wanted[at : at + ASKED_AT_ONCE], x, rows32, rank, k)
            for low in range(0, len(x), ROWS_AT_ONCE):
                near.offer(low, min(low + ROWS_AT_ONCE, len(x)))
            q, row, score = near.found()
            out.append(pd.DataFrame({question: ids[q + at], key: keys[row], "score": score}))
        return pd.concat(out, ignore_index=True)

    together = ["_shard", "_block", "_dim"]
    found = shards.groupBy(*together).cogroup(blocks.groupBy(*together)).applyInPandas(best, schema)
    order = Window.partitionBy(question).orderBy(F.col("score").desc(), F.col(key))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ready_to_index(dim: DataFrame, minimum: int = INDEX_MIN_ROWS) -> DataFrame:
    rows = dim.agg(F.count("ai_description").alias("enriched"))
    return rows.withColumn("ready", F.col("enriched") >= minimum)


def vector_coverage(dim: DataFrame, vector: str, text: str) -> DataFrame:
    """Rows with and without a vector, and those with a text but no vector: the ones still to be embedded."""
    there = F.col(vector).isNotNull()
    return dim.agg(
        F.count(F.lit(1)).alias("codes"), F.count_if(there).alias("with_vector"), F.count_if(~there).alias("without_vector"),
        F.count_if(~there & F.col(text).isNotNull()).alias("described_without_vector"),
    )


def sync_plan(index: DataFrame, source: DataFrame, key: str, text: str) -> DataFrame:
    """What an index needs to follow its source: ``insert`` and ``update`` rows
    carry the text to embed, ``delete`` rows only the key. Texts are compared
    by hash, so the stored texts are not read."""
    new = source.filter(F.col(text).isNotNull()).select(key, F.col(text).alias("_text"), F.md5(text).alias("_hash"))
    old = index.select(key, F.col("text_hash"))
    action = (
        F.when(F.col("text_hash").isNull(), "insert")
        .when(F.col("_hash").isNull(), "delete")
        .when(F.col("_hash") != F.col("text_hash"), "update")
    )
    return (
        old.join(new, key, "full_outer")
        .withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .select(key, "action", F.col("_text").alias(text), F.col("_hash").alias("text_hash"))
    )


def apply_sync(index: DataFrame, embedded: DataFrame, key: str) -> DataFrame:
    """The index after a sync; ``embedded`` is the plan with its vectors."""
    kept = index.join(embedded.select(key), key, "left_anti")
    return kept.unionByName(embedded.filter("action <> 'delete'").select(*index.columns))


def term_counts(docs: DataFrame, key: str, text: str, dims: int = 256) -> DataFrame:
    """(key, dim, tf): terms of each text, hashed by md5 to ``dims`` dimensions.
    The hash is one that any engine has, so vectors can be checked elsewhere."""
    terms = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    dim = F.conv(F.substring(F.md5("_term"), 1, 8), 16, 10).cast("bigint") % dims
    return (
        docs.select(key, F.explode(terms).alias("_term"))
        .filter("_term <> ''")
        .groupBy(key, dim.cast("int").alias("dim"))
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def dimension_weights(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """(dim, idf): inverse document frequency of each dimension, over all of ``docs``."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    return counts.groupBy("dim").agg(F.log((n + 1) / (F.count(F.lit(1)) + 1)).alias("idf"))


def hashed_vectors(counts: DataFrame, weights: DataFrame, key: str, dims: int = 256) -> DataFrame:
    """(key, embedding): TF-IDF vectors of ``dims`` numbers; their length does not matter to a cosine."""
    @F.pandas_udf("array<double>")
    def dense(places: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([np.bincount(at, weights=x, minlength=dims) for at, x in zip(places, values)], dtype=object)

    # filled in one pass: a map looked up dim by dim is built again for each of them
    weighed = counts.join(weights, "dim").select(key, "dim", (F.col("tf") * F.col("idf")).alias("x"))
    listed = weighed.groupBy(key).agg(F.collect_list(F.struct("dim", "x")).alias("_by_dim"))
    return listed.select(key, dense("_by_dim.dim", "_by_dim.x").alias("embedding"))


def fit_text_vectors(docs: DataFrame, text: str, dims: int = 256):
    """A TF-IDF text embedder as a Spark ML pipeline: hashed terms, weighted
    and scaled to length one. Fitting is one aggregate of ``dims`` counters."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_terms", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=dims),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(inputCol="_tfidf", outputCol="_unit"),
        ]
    ).fit(docs)


def embed_text(model, docs: DataFrame, out: str = "embedding") -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    done = model.transform(docs).withColumn(out, vector_to_array("_unit", "float32"))
    return done.drop("_terms", "_tf", "_tfidf", "_unit")


def context_prompts(
    hits: DataFrame,
    docs: DataFrame,
    key: str,
    label: Column,
    questions: DataFrame,
    question: str,
    question_text: str,
    stats: DataFrame | None = None,
    stats_line: Column | None = None,
) -> DataFrame:
    """One prompt per question: its hits in rank order, optional statistics of
    their codes, and the question. A question has at most k hits, so the
    collected lists are short; a question without hits has an empty context."""
    rows = hits.join(docs.select(key, label.alias("_line")), key)
    if stats is None:
        rows = rows.withColumn("_stat", F.lit(None).cast("string"))
    else:
        rows = rows.join(stats.select(key, stats_line.alias("_stat")), key, "left")
    line = F.struct("rank", "_line", "_stat")
    grouped = rows.groupBy(question).agg(F.array_sort(F.collect_list(line)).alias("_found"))
    texts = questions.select(question, F.col(question_text).alias("_q"))
    joined = texts.join(grouped, question, "left")
    context = F.concat_ws("\n", F.transform("_found", lambda h: F.concat(F.lit("- "), h["_line"])))
    claims = F.concat_ws("\n", F.filter(F.transform("_found", lambda h: h["_stat"]), lambda s: s.isNotNull()))
    return joined.select(
        question,
        F.coalesce(F.array_size("_found"), F.lit(0)).alias("context_docs"),
        F.format_string(prompts.ANSWER, context, claims, F.col("_q")).alias("prompt"),
    )

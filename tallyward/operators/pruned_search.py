"""Exact nearest-neighbour search that leaves out what cannot be near.

An inverted file: centroids are fitted on a bounded sample, every vector goes to
the cell of its nearest centroid, stored by cell with its distance ``r`` to it.
Cells that lie side by side make parts of bounded size, which are searched by
one task or, for many questions, by one task a block of them; a cell that is too
large for a part is several parts. A question first goes to the part of its
nearest cell and searches its nearest cells there that hold k vectors; the k-th
best score found bounds all better ones. By the triangle inequality a vector at
distance r from a centroid is at least |d - r| away from a question at distance
d, so other cells, and in the cells that remain all vectors outside a band of
r, are left out where that exceeds the bound. With the bound of its whole first
part it then goes, once each, to the other parts that it still wants. Nothing is
approximate: the answer is that of comparing all. How much is left out depends on
the data: vectors in groups prune well, vectors spread evenly over many
dimensions do not, as all of them are about equally far from every centroid.

Where nothing is left out a question travels once to each part, and the index
once to each block of questions. Both are as large as a task has memory for, and
vectors travel in their own type, as what is shuffled is questions x rows
divided by these sizes. Neither meets the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from tallyward.functions.fixed_values import TOP_K
from tallyward.operators.search import FEW, SCORE_DIGITS, SPREAD, Nearest, unit_rows, without_copies
from tallyward.session import shared_folder, stored_copy

#: Vectors that shape the cells, at most; cells, at most; vectors of a part and questions of a block that meet in a task, at
#: most, where a vector has up to ``WIDTH`` bytes: fewer of wider ones.
SAMPLE, CELLS, ROWS, ASKS, WIDTH = 20_000, 2_048, 200_000, 200_000, 256
#: Questions and rows of one matrix product; above the share of questions that want a cell, all of them are compared with it.
_SPAN, _AT_ONCE, _ROWS_AT_ONCE, _MOST = 1 << 40, 1_000, 512, 0.75


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (centroids * centroids).sum(1) - 2 * x @ centroids.T
    return np.sqrt(np.maximum(square, 0.0))


def _nearest_cell(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, distance) of each row, a bounded number of rows at once."""
    cell, distance = np.zeros(len(x), np.int32), np.zeros(len(x))
    for at in range(0, len(x), _AT_ONCE):
        here = slice(at, at + _AT_ONCE)
        d = _distances(x[here], centroids)
        cell[here] = d.argmin(1)
        distance[here] = d.min(1)
    return cell, distance


def _sound(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with a key and a vector of finite numbers, which keeps its type if that is FLOAT or DOUBLE."""
    narrow = df.schema[vector].dataType.simpleString() in ("array<float>", "array<double>")
    value = F.col(vector) if narrow else F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & finite
    return df.filter(good).select(F.col(key), value.alias("_v"))


def _matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """Vectors of one length as rows, in their own type."""
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()
    if (pc.list_value_length(column).to_numpy(zero_copy_only=False) != length).any():
        raise ValueError(f"an index holds vectors of one length, not others than {length}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


class _UnitRows:
    """Chosen rows of a matrix as rows of length one, made when they are asked for."""

    def __init__(self, x: np.ndarray, chosen: np.ndarray):
        self.x, self.chosen = x, chosen

    def __getitem__(self, at) -> np.ndarray:
        return unit_rows(self.x[self.chosen[at]])

    def single(self) -> np.ndarray:
        """All of them in single precision."""
        out = np.empty((len(self.chosen), self.x.shape[1]), np.float32)
        for at in range(0, len(out), _AT_ONCE):
            out[at : at + _AT_ONCE] = self[at : at + _AT_ONCE]
        return out


def _bound(score: np.ndarray) -> np.ndarray:
    """The distance that a vector with a better score is within: a score is right to the last digit kept, and a
    distance near zero to the seventh."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * (score - 2 * 10.0**-SCORE_DIGITS))) + 1e-7


def _kth(q: np.ndarray, score: np.ndarray, asked: int, k: int) -> np.ndarray:
    """The k-th best score of each question from its hits in order; minus infinity if there are fewer."""
    n = np.bincount(q, minlength=asked)
    out = np.full(asked, -np.inf)
    out[n >= k] = score[np.cumsum(n)[n >= k] - 1]
    return out


def _fit(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's iterations from evenly spaced rows of the sample; cells without a row keep their place."""
    centroids = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        own, _ = _nearest_cell(sample, centroids)
        sums, n = np.zeros_like(centroids), np.bincount(own, minlength=cells)
        np.add.at(sums, own, sample)
        centroids[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centroids


@dataclass
class InvertedFile:
    """An index of one vector length. ``n``, ``low``, ``high``: rows of each cell, least and largest r."""

    folder: str
    key: str
    centroids: np.ndarray
    n: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def build(cls, index: DataFrame, key: str, vector: str, cells: int | None = None, sample: int = SAMPLE) -> InvertedFile:
        """Fit and store. The driver gets at most ``sample`` vectors and one row per cell."""
        rows = _sound(index, key, vector)
        total = rows.count()
        place = F.pmod(F.xxhash64(key), F.lit(_SPAN))
        near = rows.filter(place.cast("double") * total <= F.lit(float(_SPAN)) * (2 * sample + 100))
        chosen = near.orderBy(place, key, "_v").limit(sample).toPandas()
        dims = {len(v) for v in chosen["_v"]}
        if len(dims) > 1:
            raise ValueError(f"an index holds vectors of one length, not of {sorted(dims)}")
        if not len(chosen):
            folder = shared_folder(index.sparkSession, "inverted-file")
            rows.write.parquet(folder)
            return cls(folder, key, np.zeros((0, 0)), *[np.zeros(0)] * 3)
        want = min(cells or max(1, int(2 * total**0.5)), CELLS, len(chosen))
        centroids = _fit(unit_rows(chosen["_v"]), want)

        def assign(batches):
            for batch in batches:
                cell, distance = _nearest_cell(unit_rows(_matrix(batch.column("_v"), centroids.shape[1])), centroids)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(distance), pa.array(cell)], [*batch.schema.names, "_r", "_cell"])

        schema = StructType([*rows.schema.fields, StructField("_r", DoubleType()), StructField("_cell", IntegerType())])
        folder = shared_folder(index.sparkSession, "inverted-file")
        rows.mapInArrow(assign, schema).hint("rebalance", "_cell").write.partitionBy("_cell").parquet(folder)
        stats = index.sparkSession.read.parquet(folder).groupBy("_cell").agg(
            F.count("*").alias("n"), F.min("_r").alias("low"), F.max("_r").alias("high")
        ).toPandas().set_index("_cell").reindex(range(want))
        return cls(folder, key, centroids, stats["n"].fillna(0).to_numpy(), stats["low"].to_numpy(), stats["high"].to_numpy())

    def _with_cell(self, asked: DataFrame) -> DataFrame:
        """Questions with their nearest cell that holds a vector."""
        cells = np.flatnonzero(self.n > 0).astype(np.int32)

        def add(batches):
            for batch in batches:
                cell, _ = _nearest_cell(unit_rows(_matrix(batch.column("_v"), self.centroids.shape[1])), self.centroids[cells])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[cell])], [*batch.schema.names, "_cell"])

        return asked.mapInArrow(add, StructType([*asked.schema.fields, StructField("_cell", IntegerType())]))

    def _fitting(self, most: int, vector: DataType) -> int:
        """So many vectors of this type need no more memory than ``most`` of ``WIDTH`` bytes."""
        size = self.centroids.shape[1] * (4 if isinstance(vector.elementType, FloatType) else 8)
        return max(1, most * WIDTH // max(WIDTH, size))

    def _stretches(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells along the direction in which the centroids differ most, where stretches of cells with at most ``most``
        vectors begin, and the number of parts of each stretch: several only for a cell that is larger by itself."""
        shifted = self.centroids - self.centroids.mean(0)
        order = np.argsort(shifted @ np.linalg.svd(shifted, full_matrices=False)[2][0], kind="stable")
        starts, held, even = [], 0.0, self.n.sum() / np.ceil(self.n.sum() / most)
        for i, n in enumerate(self.n[order]):
            if not i or held + n > most or held >= even:
                starts.append(i)
                held = 0.0
            held += n
        sums = np.add.reduceat(self.n[order], starts)
        return order, np.array(starts), np.maximum(1, np.ceil(sums / most)).astype(np.int64)

    def _best(self, question: str, k: int, place: np.ndarray, wants=None):
        """The task of a part and a block of questions. With ``wants`` it is the first part of these questions: they
        are returned with their bounds and the other parts that they want."""
        key, length = self.key, self.centroids.shape[1]

        def best(rows: pa.Table, asked: pa.Table) -> pa.Table:
            x, r, cell = _matrix(rows["_v"], length), rows["_r"].to_numpy(), rows["_cell"].to_numpy()
            by_key = pc.sort_indices(rows[key]).to_numpy()
            by_key = by_key[without_copies(x[by_key], k)]
            rank = np.lexsort((r[by_key], place[cell[by_key]]))
            chosen = by_key[rank]
            r, cell, units = r[chosen], cell[chosen], _UnitRows(x, chosen)
            begin = np.flatnonzero(np.diff(cell, prepend=-1))
            end = np.append(begin[1:], len(cell)).astype(np.int64)
            cells, held, low, high = cell[begin], end - begin, r[begin], r[end - 1] if len(end) else r
            x32, names, out = units.single(), rows[key].combine_chunks(), []

            def compared(piece: pa.Table) -> pa.Table:
                n = len(piece)
                q = unit_rows(_matrix(piece["_v"], length))
                everywhere = _distances(q, self.centroids if wants else self.centroids[cells])
                d = everywhere[:, cells] if wants else everywhere
                bound = np.full(n, np.inf) if wants else piece["_bound"].to_numpy()
                # a vector nearer than the bound has at least this score
                near = Nearest(q, units, x32, rank, k, 1 - np.square(bound) / 2 - 1e-9)
                scored, first = np.zeros(n, np.int64), np.zeros(d.shape, bool)

                def offer(low: int, high: int, some: np.ndarray | None) -> None:
                    for at in range(low, high, _ROWS_AT_ONCE):
                        near.offer(at, min(at + _ROWS_AT_ONCE, high), some)
                    scored[slice(None) if some is None else some] += high - low

                if wants and len(cells):
                    nearest = d.argmin(1)
                    first[np.arange(n), nearest] = True
                    few = np.flatnonzero(held[nearest] < k)
                    order = np.argsort(d[few], axis=1, kind="stable")
                    first[few[:, None], order] = np.cumsum(held[order], axis=1) - held[order] < k
                    for c in np.flatnonzero(first.any(0)):
                        offer(begin[c], end[c], np.flatnonzero(first[:, c]))
                    hits, _, score = near.found()
                    bound = _bound(_kth(hits, score, n, k))
                wanted = ~first & (np.maximum(d - high, low - d) <= bound[:, None])
                inner = np.where(wanted, d - bound[:, None], np.inf).min(0, initial=np.inf)
                outer = np.where(wanted, d + bound[:, None] + 1e-9, -np.inf).max(0, initial=-np.inf)
                share = np.where(first.any(0), 0, wanted.sum(0))
                at = to = 0
                for c in np.flatnonzero(wanted.any(0)):
                    band = r[begin[c] : end[c]]
                    if share[c] > _MOST * n:
                        since, until = begin[c] + np.searchsorted(band, [inner[c], outer[c]])
                        if since < until:
                            if since != to:
                                offer(at, to, None)
                                at = since
                            to = until
                        continue
                    some = np.flatnonzero(wanted[:, c])
                    since = np.searchsorted(band, d[some, c] - bound[some])
                    until = np.searchsorted(band, d[some, c] + bound[some] + 1e-9)
                    some, since, until = (a[until > since] for a in (some, since, until))
                    if len(some):
                        offer(begin[c] + since.min(), begin[c] + until.max(), some)
                offer(at, to, None)
                hits, row, score = near.found()
                found = pa.StructArray.from_arrays([names.take(pa.array(chosen[row])), pa.array(score)], ["key", "score"])
                starts = np.searchsorted(hits, np.arange(n + 1)).astype(np.int32)
                made = {question: piece[question], "_found": pa.ListArray.from_arrays(starts, found), "scored": scored}
                if wants:
                    bound = _bound(_kth(hits, score, n, k))
                    of, part = np.nonzero(wants(everywhere, bound, piece["_part"].to_numpy()))
                    starts = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
                    # a question that wants no other part has been answered
                    vector = pc.if_else(pa.array(np.diff(starts) > 0), piece["_v"], pa.scalar(None, piece["_v"].type))
                    made |= {"_wants": pa.ListArray.from_arrays(starts, part.astype(np.int32)), "_v": vector, "_cell": piece["_cell"], "_bound": bound}
                return pa.table(made)

            # questions of a cell want about the same cells
            order = np.argsort(place[asked["_cell"].to_numpy()], kind="stable")
            for at in range(0, max(1, len(order)), _AT_ONCE):
                out.append(compared(asked.take(pa.array(order[at : at + _AT_ONCE]))))
            return pa.concat_tables(out)

        return best

    def _meet(self, parts: DataFrame, asked: DataFrame, question: str, most: int, best, schema: StructType) -> DataFrame:
        """Questions, each with a ``_part``, dealt to blocks that meet their part of the index in a task each."""
        spark = asked.sparkSession
        n = asked.groupBy("_part").count().toPandas()  # one row per part
        spread = -(-SPREAD // max(1, len(n)))
        sizes = F.broadcast(spark.createDataFrame(
            [(int(p), int(max(-(-c // most), min(-(-c // FEW), spread)))) for p, c in zip(n["_part"], n["count"])], "_part int, _blocks int"
        ))
        dealt = asked.join(sizes, "_part").withColumn("_block", F.pmod(F.xxhash64(question, F.lit("block")), "_blocks").cast("int")).drop("_blocks")
        rows = spark.read.parquet(self.folder).join(parts, "_cell")
        rows = rows.withColumn("_part", F.col("_base") + F.pmod(F.xxhash64(self.key), "_parts").cast("int")).join(sizes, "_part")
        rows = rows.select(self.key, "_v", "_r", "_cell", "_part", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
        together = ["_part", "_block"]
        return rows.groupBy(*together).cogroup(dealt.groupBy(*together)).applyInArrow(best, schema)

    def search(self, questions: DataFrame, question: str, vector: str, k: int = TOP_K) -> DataFrame:
        """(question, key, score, rank, scored): the k best of each question, and how many rows were compared."""
        spark = questions.sparkSession
        stored = spark.read.parquet(self.folder).schema
        asked = _sound(questions, question, vector).filter(F.size("_v") == int(self.centroids.shape[1]))
        if not self.n.sum():
            kinds = [asked.schema[question], stored[self.key], StructField("score", DoubleType())]
            return spark.createDataFrame([], StructType([*kinds, StructField("rank", IntegerType()), StructField("scored", LongType())]))
        order, starts, subs = self._stretches(self._fitting(ROWS, stored["_v"].dataType))
        base, stretch = np.cumsum(subs) - subs, np.repeat(np.arange(len(starts)), np.diff([*starts, len(order)]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        parts = F.broadcast(spark.createDataFrame(  # one row per cell
            [(int(c), int(base[s]), int(subs[s])) for c, s in zip(order, stretch)], "_cell int, _base int, _parts int"
        ))

        def wants(d: np.ndarray, bound: np.ndarray, part: np.ndarray) -> np.ndarray:
            near = (self.n > 0) & (np.maximum(d - self.high, self.low - d) <= bound[:, None])
            out = np.repeat(np.logical_or.reduceat(near[:, order], starts, axis=1), subs, axis=1)
            out[np.arange(len(out)), part] = False
            return out

        most = self._fitting(ASKS, asked.schema["_v"].dataType)
        asked = self._with_cell(asked).join(parts, "_cell")
        asked = asked.withColumn("_part", F.col("_base") + F.pmod(F.xxhash64(question), "_parts").cast("int")).drop("_base", "_parts")
        asked = stored_copy(asked, "pruned-questions")
        hit = StructType([StructField("key", stored[self.key].dataType), StructField("score", DoubleType())])
        hits = StructType([asked.schema[question], StructField("_found", ArrayType(hit)), StructField("scored", LongType())])
        kept = [StructField("_wants", ArrayType(IntegerType())), asked.schema["_v"], asked.schema["_cell"], StructField("_bound", DoubleType())]
        first = stored_copy(
            self._meet(parts, asked, question, most, self._best(question, k, place, wants), StructType([*hits.fields, *kept])), "pruned-first"
        )
        others = first.select(question, "_v", "_cell", "_bound", F.explode("_wants").alias("_part"))
        found = first.select(*hits.names).unionByName(self._meet(parts, others, question, most, self._best(question, k, place), hits))
        # a row for each hit, and one with a NULL key where a question had none in a part
        scored = F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("scored")).otherwise(0).alias("scored")
        found = found.select(question, "scored", F.posexplode_outer("_found").alias("_at", "_hit"))
        found = found.select(question, F.col("_hit.key").alias(self.key), "_hit.score", scored)
        found = stored_copy(found, "pruned-found")
        whole = Window.partitionBy(question)
        ranked = found.withColumns({
            "rank": F.row_number().over(whole.orderBy(F.col("score").desc_nulls_last(), F.col(self.key))), "scored": F.sum("scored").over(whole),
        })
        return ranked.filter(F.col(self.key).isNotNull() & (F.col("rank") <= k)).select(question, self.key, "score", "rank", "scored")

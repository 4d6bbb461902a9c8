"""Gold tables kept up from change batches, without reading the facts again.

A batch holds images of changed rows: rows that came or are new count plus
one, rows that went or are old count minus one. Counts and exact sums add up
over batches. A distinct count needs more: how often each member stands in its
group. These numbers are stored by a hash of group and member. A batch looks
up the members it touches, in the partitions it touches, and adds one to a
distinct count where a member comes up from nothing, and takes one where it
goes down to nothing. Largest values are found again from the numbers of the
touched groups, as the one before may have gone.

Every batch writes its own folders, numbered by the batch, and reads those of
earlier batches only. So a batch that failed is run again without counting
twice. ``fold`` sums the folders up to a batch into one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.expressions import MONEY, month_of, percent
from tallyward.functions.fixed_values import APPROVED, DENIED, PENDING
from tallyward.operators import changelog
from tallyward.operators.keyed import latest_per_key
from tallyward.plans import gold
from tallyward.streaming import sinks

PART, ROWS, MEMBER, N, WAS = "_part", "_rows", "_member", "_n", "_was"


@dataclass(frozen=True)
class Measures:
    """What a gold table takes from the facts. ``sums`` are whole numbers or
    decimals, and NULL counts as zero; NULL members are not counted."""

    group: dict[str, Column]
    sums: dict[str, Column]
    distinct: dict[str, Column] = field(default_factory=dict)
    largest: dict[str, Column] = field(default_factory=dict)
    where: Column | None = None


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


@dataclass(frozen=True)
class IncrementalTable:
    folder: str
    measures: Measures
    parts: int = 64
    #: Batches of at most as many changes look their members up; larger ones meet the stored numbers in one shuffle.
    lookup_rows: int = 100_000

    @property
    def _groups(self) -> list[str]:
        return list(self.measures.group)

    def _stored(self, spark: SparkSession, name: str, before: int | None = None) -> DataFrame | None:
        try:
            rows = sinks.stored(spark, f"{self.folder}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        return rows if before is None else rows.filter(F.col(sinks.BATCH) < before)

    def _write(self, rows: DataFrame, name: str, number: int) -> DataFrame:
        own = f"{self.folder}/{name}/{sinks.BATCH}={number}"
        parted = [PART] if PART in rows.columns else []
        rows.write.mode("overwrite").partitionBy(*parted).parquet(own)
        return rows.sparkSession.read.schema(rows.schema).parquet(own)

    def apply(self, changes: DataFrame, number: int) -> None:
        """Take in one batch of changes (rows with ``_change_type``, from storage)."""
        m, groups = self.measures, self._groups
        rows = changes if m.where is None else changes.filter(m.where)
        sign = F.when(F.col(changelog.TYPE).isin(changelog.INSERT, changelog.POST), 1).otherwise(-1)
        signed = rows.select(
            *[e.alias(g) for g, e in m.group.items()], sign.alias("_sign"), *[e.alias(s) for s, e in m.sums.items()],
            *[e.alias(d) for d, e in (m.distinct | m.largest).items()],
        )
        few = changes.count() <= self.lookup_rows
        parts = [
            signed.groupBy(*groups).agg(
                F.sum("_sign").alias(ROWS), *[F.sum(F.coalesce(F.col(s) * F.col("_sign"), F.lit(0))).alias(s) for s in m.sums]
            )
        ]
        for name in [*m.distinct, *m.largest]:
            moved = self._move_members(signed, name, number, few)
            if name in m.largest:
                self._renew_largest(moved, name, number)
                continue
            now = F.col(WAS) + F.col(N)
            step = F.when((F.col(WAS) <= 0) & (now > 0), 1).when((F.col(WAS) > 0) & (now <= 0), -1).otherwise(0)
            parts.append(moved.groupBy(*groups).agg(F.sum(step).alias(name)))
        totals = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        numbers = [ROWS, *m.sums, *m.distinct]
        self._write(totals.groupBy(*groups).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers]), "totals", number)

    def _move_members(self, signed: DataFrame, name: str, number: int, few: bool) -> DataFrame:
        """Store by how much the number of each touched member changed, and what it was.

        The stored numbers of a member and its changes are summed together. Members that did not change drop out
        there, so only a batch of few changes looks for its members before."""
        groups, whole = self._groups, name in self.measures.largest
        keys = [*groups, MEMBER]
        place = F.pmod(F.xxhash64(*(groups if whole else keys)), F.lit(self.parts)).cast("int")
        none = F.lit(0).cast("bigint")
        changed = (
            signed.select(*groups, F.col(name).alias(MEMBER), F.col("_sign").cast("bigint").alias(N), none.alias(WAS))
            .filter(F.col(MEMBER).isNotNull()).withColumn(PART, place)
        )
        earlier = self._stored(signed.sparkSession, name, number)
        if earlier is not None:
            near = self._touched(earlier, changed, keys) if few else self._near(earlier, changed)
            changed = changed.unionByName(near.select(*keys, none.alias(N), F.col(N).alias(WAS), PART))
        summed = changed.groupBy(*keys, PART).agg(F.sum(N).alias(N), F.sum(WAS).alias(WAS)).filter(F.col(N) != 0)
        return self._write(summed.select(*keys, N, PART, WAS), name, number)

    def _near(self, stored: DataFrame, moved: DataFrame) -> DataFrame:
        """Stored rows of the partitions with moved keys: at most ``parts`` numbers are broadcast and prune the scan."""
        parts = moved.select(PART).filter(F.col(PART) >= 0).distinct()
        return stored.join(F.broadcast(parts), PART, "left_semi")

    def _touched(self, stored: DataFrame, moved: DataFrame, keys: list[str]) -> DataFrame:
        """Stored rows of the moved keys, matched by whatever join fits their number."""
        near, wanted = self._near(stored, moved), moved.select(PART, *keys).distinct()
        return near.join(wanted, _same(near, wanted, [PART, *keys]), "left_semi")

    def _renew_largest(self, moved: DataFrame, name: str, number: int) -> None:
        groups = self._groups
        stored = self._stored(moved.sparkSession, name)
        if stored is None:  # no batch so far has had a member
            rows = moved
        else:
            rows = self._touched(stored.filter(F.col(sinks.BATCH) <= number), moved, groups)
        there = rows.groupBy(*groups, MEMBER).agg(F.sum(N).alias(N)).withColumn(
            MEMBER, F.when(F.col(N) > 0, F.col(MEMBER))
        )
        self._write(there.groupBy(*groups).agg(F.max(MEMBER).alias(name)), f"{name}_largest", number)

    def state(self, spark: SparkSession) -> DataFrame:
        """Groups that still have rows: group columns, sums, distinct counts, largest values."""
        m, groups = self.measures, self._groups
        totals = self._stored(spark, "totals").groupBy(*groups).agg(
            *[F.sum(c).alias(c) for c in [ROWS, *m.sums, *m.distinct]]
        ).filter(F.col(ROWS) > 0)
        for name in m.largest:
            newest = latest_per_key(self._stored(spark, f"{name}_largest"), groups, [F.col(sinks.BATCH).desc()])
            newest = newest.select(*[F.col(g).alias(f"_g_{g}") for g in groups], name)
            on = reduce(lambda a, b: a & b, [totals[g].eqNullSafe(newest[f"_g_{g}"]) for g in groups])
            totals = totals.join(newest, on, "left").drop(*[f"_g_{g}" for g in groups])
        return totals.drop(ROWS)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Sum the stored batches up to one into one folder each. Members that are gone leave it."""
        m, groups = self.measures, self._groups

        def one(rows: DataFrame) -> DataFrame:
            return rows.withColumn(sinks.BATCH, F.lit(upto))

        totals = [F.sum(c).alias(c) for c in [ROWS, *m.sums, *m.distinct]]
        sinks.fold(spark, f"{self.folder}/totals", upto, lambda rows: one(rows.groupBy(*groups).agg(*totals)))
        for name in [*m.distinct, *m.largest]:
            keys = [*groups, MEMBER, PART]
            counted = lambda rows, keys=keys: rows.groupBy(*keys).agg(F.sum(N).alias(N)).filter(F.col(N) != 0)
            sinks.fold(
                spark, f"{self.folder}/{name}", upto,
                lambda rows, counted=counted: one(counted(rows).withColumn(WAS, F.lit(0).cast("bigint"))), [PART],
            )
        for name in m.largest:
            sinks.fold(
                spark, f"{self.folder}/{name}_largest", upto, lambda rows: latest_per_key(rows, groups, [F.col(sinks.BATCH).desc()])
            )


# The gold tables over claims -------------------------------------------------------------------


def _one(where: Column) -> Column:
    return F.when(where, 1).otherwise(0)


def _status(value: str) -> Column:
    return F.col("claim_status") == value


def _money(where: Column | None = None) -> Column:
    amount = F.col("claim_amount").cast(MONEY)
    return amount if where is None else F.when(where, amount)


def _amounts() -> dict[str, Column]:
    return {"_amount": _money(), "_amounts": _one(F.col("claim_amount").isNotNull())}


def _with_amounts(df: DataFrame, total: str, mean: str) -> DataFrame:
    """Sum and mean of money as the plain gold tables give them: NULL without any amount."""
    money = F.when(F.col("_amounts") > 0, F.col("_amount").cast("double"))
    return df.withColumn(total, money).withColumn(mean, F.try_divide(total, F.col("_amounts"))).drop("_amount", "_amounts")


def monthly_measures() -> Measures:
    return Measures(
        {"claim_month": month_of("claim_date"), "payer_id": F.col("payer_id")},
        {"total_claims": _one(F.col("claim_id").isNotNull()), **_amounts(), "approved_count": _one(_status(APPROVED)),
         "denied_count": _one(_status(DENIED)), "pending_count": _one(_status(PENDING))},
        {"unique_patients": F.col("patient_id"), "unique_providers": F.col("provider_id")},
        where=F.col("claim_id").isNotNull(),
    )


def monthly_claims_summary(state: DataFrame) -> DataFrame:
    return _with_amounts(state, "total_amount", "avg_claim_amount").withColumn(
        "approval_rate_pct", percent("approved_count", "total_claims")
    )


def provider_measures() -> Measures:
    return Measures(
        {"provider_id": F.col("provider_id")},
        {"total_claims": _one(F.col("claim_id").isNotNull()), **_amounts(), "approved_claims": _one(_status(APPROVED)),
         "denied_claims": _one(_status(DENIED))},
        {"unique_patients": F.col("patient_id")},
    )


def provider_performance(state: DataFrame, providers: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    return gold.describe_providers(_with_amounts(state, "total_billed", "avg_claim_amount"), providers, hot)


def patient_measures() -> Measures:
    return Measures(
        {"patient_id": F.col("patient_id")},
        {"total_claims": _one(F.col("claim_id").isNotNull()), **_amounts()},
        {"unique_diagnoses": F.col("diagnosis_code"), "unique_providers_seen": F.col("provider_id")},
        {"last_claim_date": F.col("claim_date")},
    )


def patient_risk_scores(state: DataFrame, patients: DataFrame) -> DataFrame:
    return gold.describe_patients(_with_amounts(state, "total_spend", "avg_claim_amount"), patients)


def denial_measures() -> Measures:
    return Measures(
        {"claim_month": month_of("claim_date"), "payer_id": F.col("payer_id")},
        {"total_claims": _one(F.col("claim_id").isNotNull()), "denied_count": _one(_status(DENIED)),
         "denied_amount": _money(_status(DENIED)), "approved_amount": _money(_status(APPROVED))},
        {"patients_with_denials": F.when(_status(DENIED), F.col("patient_id"))},
    )


def payer_denial_analysis(state: DataFrame) -> DataFrame:
    return gold.rank_denials(state.withColumns({c: F.col(c).cast("double") for c in ("denied_amount", "approved_amount")}))

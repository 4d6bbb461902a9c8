"""Named data-quality rules with warn, drop and fail actions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyward.functions.fixed_values import ADMISSION_RULES, CLAIMS_RULES

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = "warn"

    @property
    def passes(self) -> Column:
        """An unknown outcome is a violation."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


class RuleSet:
    """Rules by name. Of several entries for a name, the strictest action holds."""

    def __init__(self, rules: Iterable[Rule]):
        by_name: dict[str, Rule] = {}
        for rule in rules:
            if rule.action not in ACTIONS or not rule.predicate.strip():
                raise ValueError(f"bad rule {rule}")
            known = by_name.get(rule.name)
            if known and known.predicate != rule.predicate:
                raise ValueError(f"two predicates for {rule.name}")
            if not known or ACTIONS.index(rule.action) > ACTIONS.index(known.action):
                by_name[rule.name] = rule
        if not by_name:
            raise ValueError("a rule set needs rules")
        self.rules = tuple(by_name.values())

    def having(self, action: str) -> list[Rule]:
        return [r for r in self.rules if r.action == action]

    @classmethod
    def claims(cls, as_of: str = "current_date()") -> "RuleSet":
        """``as_of`` is the SQL date that claim dates may not exceed."""
        return cls(Rule(n, p.replace("{as_of}", as_of), a) for n, p, a in CLAIMS_RULES)

    @classmethod
    def admissions(cls) -> "RuleSet":
        return cls(Rule(*r) for r in ADMISSION_RULES)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def keep_passing(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.filter(_all([r.passes for r in rules])) if rules else df


def halt_on_violation(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Raise from inside a filter, which no optimizer rule can prune away."""
    for rule in rules:
        message = F.concat(F.lit(f"rule {rule.name} violated by "), F.to_json(F.struct("*")))
        df = df.filter(F.when(rule.passes, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return df


def apply_rules(df: DataFrame, rule_set: RuleSet, observe: Observation | None = None) -> DataFrame:
    """Rows that go on: drop rules filter, fail rules halt, warn rules count.

    The drop rules run first, so a dropped row cannot halt the job. Works on
    streams. ``observe`` collects the violations of every rule in the same
    pass over the input.
    """
    if observe is not None:
        df = df.observe(observe, *[F.count_if(~r.passes).alias(r.name) for r in rule_set.rules])
    return halt_on_violation(keep_passing(df, rule_set.having("drop")), rule_set.having("fail"))


def quarantine(df: DataFrame, rule_set: RuleSet, key: str, failed_at: Column | None = None) -> DataFrame:
    """One row per dropped record and failing drop rule, with the full record.

    Reads the input before any rule is applied. Narrow: no shuffle.
    """
    rules = rule_set.having("drop")
    failing = F.filter(F.array(*[F.when(~r.passes, F.lit(r.name)) for r in rules]), lambda n: n.isNotNull())
    source = F.col("_source_file") if "_source_file" in df.columns else F.lit(None).cast("string")
    return (
        df.filter(~_all([r.passes for r in rules]))  # few rows are listed with their rules
        .withColumn("_failing", failing)
        .select(
            F.col(key),
            F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("raw_record"),
            F.explode("_failing").alias("dq_rule"),
            (F.current_timestamp() if failed_at is None else failed_at).alias("failed_at"),
            source.alias("_source_file"),
        )
    )


def split(df: DataFrame, rule_set: RuleSet, key: str) -> tuple[DataFrame, DataFrame]:
    """Passing rows and quarantine of one input; together they cover it."""
    return keep_passing(df, rule_set.having("drop")), quarantine(df, rule_set, key)


def violations(df: DataFrame, rule_set: RuleSet) -> DataFrame:
    """Checked and violating rows per rule, in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(~r.passes).alias(r.name) for r in rule_set.rules]
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.col("_n").alias("checked"),
            F.col(r.name).alias("violations"),
        )
        for r in rule_set.rules
    ]
    return counts.select(F.inline(F.array(*lines)))

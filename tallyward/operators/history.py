"""Slowly changing dimensions and point-in-time lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.operators import hotkeys
from tallyward.operators.keyed import latest_per_key, newest_first, not_null

START, END, CURRENT = "__START_AT", "__END_AT", "__IS_CURRENT"


def scd1_apply(
    target: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence: list[str],
    ignore_nulls: bool = False,
) -> DataFrame:
    """Keep the newest row per key, whatever order the changes arrive in.

    ``ignore_nulls`` keeps a stored value where the newer row has NULL.
    """
    changes = not_null(changes, keys)
    values = [c for c in changes.columns if c not in keys and c not in sequence]
    if ignore_nulls:
        place = F.struct(*sequence)
        settled = lambda v: F.struct(*sequence, v)  # noqa: E731 - of equal times the largest value
        newest = changes.groupBy(*keys).agg(
            F.max(place).alias("_seq"),
            *[
                F.max(F.when(F.col(v).isNotNull(), settled(v)))[v].alias(v)
                for v in values
            ],
        ).select(*keys, *values, "_seq.*")
    else:
        newest = latest_per_key(changes, keys, newest_first(sequence, changes, keys))
    if target is None:
        return newest.select(*changes.columns)
    names = target.columns
    s = newest.select(*keys, F.struct(*[c for c in newest.columns if c not in keys]).alias("_s"))
    t = target.select(*keys, F.struct(*[c for c in names if c not in keys]).alias("_t"))
    stored, fresh = (F.struct(*[F.col(f"{side}.{c}") for c in sequence]) for side in ("_t", "_s"))
    newer = F.col("_s").isNotNull() & (F.col("_t").isNull() | (fresh >= stored))

    def choose(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in newest.columns:
            return F.col(f"_t.{name}").alias(name)
        mine, theirs = F.col(f"_t.{name}"), F.col(f"_s.{name}")
        if ignore_nulls and name not in sequence:
            return F.when(newer, F.coalesce(theirs, mine)).otherwise(F.coalesce(mine, theirs)).alias(name)
        return F.when(newer, theirs).otherwise(mine).alias(name)

    return t.join(s, keys, "full_outer").select(*[choose(c) for c in names])


def scd2_versions(
    events: DataFrame,
    keys: list[str],
    sequence: list[str],
    track: list[str],
    hot: DataFrame | None = None,
    closing: str | None = None,
) -> DataFrame:
    """Versions of each key: a new one only when a tracked column changes.

    Untracked columns hold the last value of the version. ``sequence[0]`` is
    the event time and becomes ``__START_AT``; the remaining sequence columns
    break ties and keep the value of the opening event. ``hot`` lists busy keys
    (see ``hotkeys``). ``closing`` names a column for the sequence of the last
    event of each version.

    Two neighbour passes on one shuffle: the first marks where a run of equal
    tracked values opens and closes, the second pairs the marks.
    """
    when = sequence[0]
    plain = [c for c in events.columns if c not in keys and c not in sequence]
    cut = hotkeys.cut_hot_keys(not_null(events, [*keys, when]), keys, sequence, hot)
    look = hotkeys.neighbours(cut, keys, sequence, track, before="_before", after="_after")
    mine = F.struct(*track)
    marks = (
        look.withColumn("_opens", F.col("_before").isNull() | ~F.col("_before").eqNullSafe(mine))
        .withColumn("_closes", F.col("_after").isNull() | ~F.col("_after").eqNullSafe(mine))
        .filter("_opens OR _closes")
        .drop("_before", "_after")
    )
    paired = hotkeys.neighbours(marks, keys, sequence, sequence, before="_prior", after="_next")
    opening = F.when(F.col("_opens"), F.struct(*sequence)).otherwise(F.col("_prior"))
    return (
        paired.filter("_closes")
        .withColumn("_open", opening)
        .select(
            *keys,
            *plain,
            *[F.col(f"_open.{c}").alias(c) for c in sequence[1:]],
            F.col(f"_open.{when}").alias(START),
            F.col(f"_next.{when}").alias(END),
            F.col("_next").isNull().alias(CURRENT),
            *([F.struct(*sequence).alias(closing)] if closing else []),
        )
    )


def scd2_apply(
    target: DataFrame | None,
    earlier: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence: list[str],
    track: list[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Fold change events into a versioned table.

    ``earlier`` are the events behind ``target`` (the stored feed). Only the keys
    of new events are derived again, from all their events; all other keys
    pass through unread by any window. A version alone cannot take a late
    event: what its untracked columns held before its last event is only in
    the feed. So loads may come in any order, with the result of one load.
    """
    if target is None or earlier is None:
        return scd2_versions(changes, keys, sequence, track, hot)
    changes = not_null(changes, [*keys, sequence[0]])
    touched = changes.select(*keys).distinct()
    again = earlier.join(touched, keys, "left_semi").select(*changes.columns)
    renewed = scd2_versions(again.unionByName(changes), keys, sequence, track, hot)
    kept = target.join(touched, keys, "left_anti")
    return kept.unionByName(renewed.select(*kept.columns))


def current_rows(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col(CURRENT))


def version_history(versions: DataFrame, key_filter: Column | None = None) -> DataFrame:
    rows = versions if key_filter is None else versions.filter(key_filter)
    return rows.orderBy(START)


def version_at(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    at: str,
    attach: list[str],
    tie: list[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Attach to each fact the version valid at its time.

    Facts and version starts are merged into one ordered stream per key and
    the last start is carried forward. That is linear in the input: no pair of
    fact and version is ever formed, even for a key with many of both. Facts
    without a key or time have no version and are kept apart.
    """
    keyed = F.lit(True)
    for c in [*keys, at]:
        keyed = keyed & F.col(c).isNotNull()
    unkeyed, facts, versions = facts.filter(~keyed), facts.filter(keyed), not_null(versions, keys)
    payload = F.struct(*[F.col(c) for c in attach])
    carried = [c for c in facts.columns if c not in keys and c != at]
    empty = F.lit(None)
    opens = versions.select(
        *keys,
        F.col(START).alias(at),
        F.lit(0).alias("_kind"),
        *[F.col(t).alias(f"_tie_{i}") for i, t in enumerate(tie)],
        payload.alias("_version"),
        empty.cast(facts.select(F.struct(*carried).alias("x")).schema["x"].dataType).alias("_fact"),
    )
    asks = facts.select(
        *keys,
        F.col(at).cast(versions.schema[START].dataType).alias(at),
        F.lit(1).alias("_kind"),
        *[empty.cast(versions.schema[t].dataType).alias(f"_tie_{i}") for i, t in enumerate(tie)],
        empty.cast(versions.select(payload.alias("x")).schema["x"].dataType).alias("_version"),
        F.struct(*carried).alias("_fact"),
    )
    order = [at, "_kind", *[f"_tie_{i}" for i in range(len(tie))]]
    if hot is not None:  # places of many facts at one time differ by their content
        order = [*order, "_spread"]
    merged = opens.unionByName(asks)
    if hot is not None:
        merged = merged.withColumn("_spread", F.xxhash64("_fact"))
    cut = hotkeys.cut_hot_keys(merged, keys, order, hot)
    filled = hotkeys.last_known(cut, keys, order, "_version", "_valid")
    found = filled.filter("_kind = 1").select(
        *keys,
        F.col(at).cast(facts.schema[at].dataType).alias(at),
        *[F.col(f"_fact.{c}").alias(c) for c in carried],
        *[F.col(f"_valid.{c}").alias(c) for c in attach],
    )
    return found.unionByName(unkeyed.withColumns(
        {c: F.lit(None).cast(found.schema[c].dataType) for c in attach}
    ).select(*found.columns))

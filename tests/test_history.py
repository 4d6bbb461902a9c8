from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.operators import history, hotkeys

# Type 1 -----------------------------------------------------------------------

SITE = "site STRING, name STRING, beds INT, seq INT"
change = st.tuples(st.sampled_from("ab"), st.sampled_from(["north", "south", None]), st.sampled_from([3, 7, None]), st.integers(0, 4))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=12), st.integers(0, 12), st.booleans())
def test_type1_keeps_the_newest_in_any_order(spark, rows, drawn, at, ignore_nulls):
    """Two loads, cut anywhere: the later event of a key wins, and with
    ``ignore_nulls`` the latest value that is not NULL, column by column."""
    state = None
    distinct = list({(r[0], r[3]): r for r in drawn}.values())  # one event per key and time
    for part in (distinct[at:], distinct[:at]):
        if part:
            state = history.scd1_apply(state, spark.createDataFrame(part, SITE), ["site"], ["seq"], ignore_nulls)
    want = []
    for key in {r[0] for r in distinct}:
        own = sorted((r for r in distinct if r[0] == key), key=lambda r: r[3])
        newest = list(own[-1])
        if ignore_nulls:
            early, late = [r for r in distinct[:at] if r[0] == key], [r for r in distinct[at:] if r[0] == key]
            for i in (1, 2):
                newest[i] = next((r[i] for r in reversed(own) if r[i] is not None), None)
            if not (early and late):
                want.append(tuple(newest))
                continue
        want.append(tuple(newest))
    if not ignore_nulls:
        assert rows(state) == sorted(want, key=repr)
    else:
        got = {r[0]: r for r in rows(state)}
        for r in want:
            assert got[r[0]][3] == r[3] and all((x is None) == (y is None) for x, y in zip(got[r[0]], r))


def test_type1_settles_equal_times_alike(spark, rows):
    a, b = ("k", "north", 3, 1), ("k", "south", None, 1)
    for keep in (False, True):
        run = lambda *r: rows(history.scd1_apply(None, spark.createDataFrame(list(r), SITE), ["site"], ["seq"], keep))
        assert run(a, b) == run(b, a)


# Type 2 -----------------------------------------------------------------------


def busy(df, keys, rows):
    """Keys of at least ``rows`` rows; none at all is no table."""
    return None if rows == 10**6 else hotkeys.hot_keys(df, keys, rows)


EVENTS = "k STRING, plan STRING, extra INT, day DATE, no INT"


def versions_by_hand(events):
    out = []
    for key in {e[0] for e in events}:
        run = []
        for e in sorted((e for e in events if e[0] == key), key=lambda e: (e[3], e[4])):
            if run and run[-1]["plan"] == e[1]:
                run[-1]["extra"] = e[2]
            else:
                run.append({"plan": e[1], "extra": e[2], "start": e[3], "no": e[4]})
        for v, after in zip(run, [*run[1:], None], strict=True):
            out.append((key, v["plan"], v["extra"], v["no"], v["start"], after and after["start"], after is None))
    return sorted(out, key=repr)


event = st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", None]), st.integers(0, 5), st.integers(0, 6))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=25), st.sampled_from([1, 5, 10**6]))
def test_type2_matches_brute_force_with_and_without_hot_keys(spark, rows, drawn, hot_rows):
    events = [(k, plan, extra, date(2024, 1, 1) + timedelta(days=d), i) for i, (k, plan, extra, d) in enumerate(drawn)]
    got = history.scd2_versions(spark.createDataFrame(events, EVENTS), ["k"], ["day", "no"], ["plan"], hot=busy(spark.createDataFrame(events, EVENTS), ["k"], hot_rows))
    assert rows(got) == versions_by_hand(events)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=3, max_size=20), st.lists(st.integers(0, 2), min_size=20, max_size=20))
def test_three_loads_in_any_order_give_the_versions_of_one(spark, rows, drawn, load):
    """All columns, the untracked ones too; loads interleave in time."""
    events = [(k, plan, extra, date(2024, 1, 1) + timedelta(days=d), i) for i, (k, plan, extra, d) in enumerate(drawn)]
    state, seen = None, []
    for n in range(3):
        part = [e for e, own in zip(events, load) if own == n]
        if part:
            before = spark.createDataFrame(seen, EVENTS)
            state = history.scd2_apply(state, before, spark.createDataFrame(part, EVENTS), ["k"], ["day", "no"], ["plan"])
            seen = seen + part
    assert rows(state) == versions_by_hand(events)


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_version_at_matches_brute_force(spark, rows, hot_rows):
    """Facts without a key or a day have no version."""
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    starts = [("a", day(2), 1), ("a", day(2), 2), ("a", day(9), 3), ("b", day(5), 4)]
    asks = [(k, day(n), f"{k}{n}") for k in "abc" for n in range(12)] + [(None, day(3), "none"), ("a", None, "never")]
    versions = spark.createDataFrame(starts, "k STRING, `__START_AT` DATE, no INT")
    facts = spark.createDataFrame(asks, "k STRING, at DATE, id STRING")
    got = history.version_at(facts, versions.withColumn("v", F.col("no")), ["k"], "at", ["v"], ["no"], busy(facts, ["k"], hot_rows))

    def expected(k, at):
        before = [(s, n) for key, s, n in starts if key == k and at and s <= at]
        return max(before)[1] if before else None

    assert rows(got, "id", "v") == sorted(((i, expected(k, at)) for k, at, i in asks), key=repr)


# Hot keys ---------------------------------------------------------------------


@pytest.mark.parametrize("hot_rows", [1, 40, 10**6])
def test_sliced_lookups_match_plain_windows(spark, rows, hot_rows):
    """Hot keys with NULL days, one crowded day, and equal places."""
    day = lambda i: None if i % 5 == 0 else date(2024, 1, 1) if i % 5 < 4 else date(2024, 1, 2 + i % 20)
    data = [("hot" if i % 3 else f"k{i % 7}", day(i), i, None if i % 4 else i) for i in range(240)]
    df = spark.createDataFrame(data, "k STRING, day DATE, n INT, v INT")
    cut = hotkeys.cut_hot_keys(df, ["k"], ["day", "n"], busy(df, ["k"], hot_rows), slices=12)
    near = hotkeys.neighbours(cut, ["k"], ["day", "n"], ["n"], before="b", after="a")
    number = hotkeys.numbered(cut, ["k"], ["day", "n"])
    known = hotkeys.last_known(cut, ["k"], ["day", "n"], "v", "kv")
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy("day", "n")
    plain = df.select(
        "k", "n", F.lag("n").over(w).alias("b"), F.lead("n").over(w).alias("a"), F.row_number().over(w).alias("r"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("kv"),
    )
    assert rows(near, "k", "n", "b.n", "a.n") == rows(plain, "k", "n", "b", "a")
    assert rows(number, "k", "n", "_n") == rows(plain, "k", "n", "r")
    assert rows(known, "k", "n", "kv") == rows(plain, "k", "n", "kv")


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_banded_rank_matches_plain_rank(spark, rows, hot_rows):
    from pyspark.sql import Window

    df = spark.createDataFrame([(f"g{i % 2}", None if i % 11 == 0 else float(i * 37 % 50)) for i in range(80)], "g STRING, m DOUBLE")
    got = hotkeys.ranked_descending(df, "g", "m", "r", busy(df, ["g"], hot_rows))
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("m").desc_nulls_last())))
    assert rows(got, "g", "m", "r") == rows(plain, "g", "m", "r")

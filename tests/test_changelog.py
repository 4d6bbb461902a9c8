from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.operators import changelog

TABLE = "k STRING, v INT"
snapshot = st.dictionaries(st.sampled_from("abcde"), st.sampled_from([1, 2, None]), max_size=5)


def build(spark, snapshots):
    """The log of a table that took these states one after the other."""
    log, before = None, spark.createDataFrame([], TABLE)
    for n, state in enumerate(snapshots):
        after = spark.createDataFrame(list(state.items()), TABLE)
        step = changelog.commit(changelog.snapshot_diff(before, after, ["k"]), n, F.lit(datetime(2024, 1, 1 + n)))
        log, before = step if log is None else log.unionByName(step), after
    return log


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(snapshot, min_size=3, max_size=3))
def test_log_laws(spark, rows, states):
    log = build(spark, states).cache()
    want = lambda n: sorted(states[n].items(), key=repr)
    for n in range(3):
        assert rows(changelog.as_of(log, ["k"], version=n)) == want(n)
    assert rows(changelog.as_of(log, ["k"], timestamp=F.lit(datetime(2024, 1, 2, 12)))) == want(1)
    undo = changelog.restore(log, ["k"], 0, 3, F.lit(datetime(2024, 1, 9)))
    assert rows(changelog.as_of(log.unionByName(undo), ["k"])) == want(0)
    assert rows(changelog.as_of(log.unionByName(undo), ["k"], version=2)) == want(2)
    cut = F.lit(datetime(2024, 1, 3))
    folded = changelog.fold_before(log, ["k"], cut)
    assert rows(changelog.as_of(folded, ["k"])) == want(2)
    assert rows(changelog.as_of(folded, ["k"], version=1)) == want(1)
    plan = changelog.fold_dry_run(log, ["k"], cut).first()
    assert plan["rows_removed"] == log.count() - folded.count()
    counted = changelog.net_new_rows(log, 0, 2).first()
    assert (counted["rows_before"], counted["rows_after"]) == (len(states[0]), len(states[2]))
    log.unpersist()


def test_equal_rows_yield_no_change(spark):
    t = spark.createDataFrame([("a", None), ("b", 1)], TABLE)
    assert changelog.snapshot_diff(t, t, ["k"]).count() == 0


def test_update_gives_both_images(spark, rows):
    old = spark.createDataFrame([("a", None)], TABLE)
    new = spark.createDataFrame([("a", 1)], TABLE)
    assert rows(changelog.snapshot_diff(old, new, ["k"])) == [("a", 1, "update_postimage"), ("a", None, "update_preimage")]


def test_commits_become_a_log(spark, rows):
    steps = [("a", 1, 0), ("a", 1, 1), ("a", 9, 2), ("a", 3, 3), ("b", 9, 0)]
    data = spark.createDataFrame(steps, "k STRING, v INT, version BIGINT").withColumn("stamp", F.lit(datetime(2024, 1, 1)))
    log = changelog.log_commits(data, ["k"], "version", "stamp", [F.col("v").desc()], F.col("v") == 9)
    assert rows(log, "_commit_version", "_change_type", "k", "v") == [
        (0, "insert", "a", 1),
        (2, "delete", "a", 1),
        (3, "insert", "a", 3),
    ]
    assert rows(changelog.history(log), "_commit_version", "rows_inserted", "rows_updated", "rows_deleted") == [
        (0, 1, 0, 0), (2, 0, 0, 1), (3, 1, 0, 0),
    ]

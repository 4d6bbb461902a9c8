from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyward.operators import changelog, keyed

LOANS = "loan STRING, branch STRING, due DOUBLE, state STRING, seen TIMESTAMP"
DAY = lambda n: datetime(2031, 5, n)
OPEN = ("l1", "quay", 40.0, "open", DAY(1))
LATE = ("l2", "mill", 15.5, "late", DAY(2))
PAID = ("l1", "moved", 0.0, "paid", DAY(9))
FRESH = ("l7", "quay", 99.0, "open", DAY(9))


@pytest.fixture
def table(spark):
    return lambda *r: spark.createDataFrame(list(r), LOANS)


def merge(target, source):
    return keyed.merge_upsert(target, source, ["loan"], ["due", "state", "seen"])


def test_upsert_takes_listed_columns_and_inserts_whole_rows(table, rows):
    got = merge(table(OPEN, LATE), table(PAID, FRESH))
    assert rows(got) == sorted([("l1", "quay", 0.0, "paid", DAY(9)), LATE, FRESH], key=repr)


def test_upsert_of_the_same_source_again_changes_nothing(table, rows):
    once = merge(table(OPEN, LATE), table(PAID, FRESH))
    assert changelog.same_table(once, merge(once, table(PAID, FRESH))).count() == 0
    stored = table(OPEN, LATE)
    assert rows(merge(stored, stored)) == rows(stored)


def test_upsert_takes_nulls(table):
    assert merge(table(OPEN), table((*PAID[:3], None, DAY(9)))).first()["state"] is None


def test_upsert_refuses_two_rows_for_a_key(table):
    with pytest.raises(Exception, match="several rows"):
        merge(table(OPEN), table(PAID, (*PAID[:3], "late", DAY(9)))).collect()


def test_null_keys_are_filtered(table):
    some = table(OPEN, (None, *LATE[1:]), ("l3", None, 1.0, "open", DAY(3)))
    assert keyed.not_null(some, ["loan"]).count() == 2
    assert keyed.any_null(some, ["loan", "branch"]).count() == 2


def test_dedup_keeps_the_latest(table):
    got = keyed.dedup_latest(table(OPEN, PAID, LATE), ["loan"], ["seen"]).collect()
    assert {(r["loan"], r["state"]) for r in got} == {("l1", "paid"), ("l2", "late")}


def test_dedup_settles_equal_times_by_the_other_columns(table, rows):
    a, b = OPEN, (*OPEN[:3], "late", OPEN[4])
    pick = lambda *r: rows(keyed.dedup_latest(table(*r), ["loan"], ["seen"]))
    assert pick(a, b) == pick(b, a)


def test_conditional_update_protects_and_never_inserts(spark, rows):
    dim = spark.createDataFrame([("a", None), ("b", "kept"), ("c", None)], "k STRING, v STRING")
    news = spark.createDataFrame([("a", "new"), ("b", "new"), ("z", "new")], "k STRING, v STRING")
    got = keyed.merge_update_if(dim, news, ["k"], ["v"], F.col("v").isNull())
    assert rows(got) == [("a", "new"), ("b", "kept"), ("c", None)]


def test_hot_key_shrinks_before_the_shuffle(spark):
    """All rows share a key: each task sends on one row of it."""
    df = spark.range(0, 20000, 1, 4).select((F.col("id") % 1).alias("k"), "id")
    plan = keyed.latest_per_key(df, ["k"], [F.col("id").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
    assert [r["id"] for r in plan.collect()] == [19999]

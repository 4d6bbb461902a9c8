import random

from pyspark.sql import functions as F

from tallyward.operators import history, hotkeys
from tallyward.operators.versions import VersionTable
from tallyward.streaming import sinks
from tallyward.streaming.sources import table_stream

EVENTS = "site STRING, plan STRING, beds INT, day INT, no INT"
KEY, SEQUENCE, TRACKED = ["site"], ["day", "no"], ["plan"]
COLUMNS = ["site", "plan", "beds", "no", history.START, history.END, history.CURRENT]


def drawn(seed, n=60, sites="abcd"):
    rng = random.Random(seed)
    return [(rng.choice(sites), rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.randint(0, 15), i) for i in range(n)]


def whole(spark, events):
    return history.scd2_versions(spark.createDataFrame(events, EVENTS), KEY, SEQUENCE, TRACKED).select(*COLUMNS)


def test_loads_in_any_order_equal_one_load(spark, rows, tmp_path):
    """Events cut into loads at random: late ones extend, precede and split versions."""
    for seed in range(3):
        events = drawn(seed)
        random.Random(seed).shuffle(events)
        table = VersionTable(str(tmp_path / f"t{seed}"), KEY, SEQUENCE, TRACKED, parts=3)
        for number, at in enumerate(range(0, 60, 15)):
            table.load(spark.createDataFrame(events[at : at + 15], EVENTS), number)
            assert rows(table.state(spark).select(*COLUMNS)) == rows(whole(spark, events[: at + 15]))
        # newer events are worked in without being written
        more = [("a", "x", 9, 7, 100), ("z", "y", 1, 3, 101), (None, "y", 1, 3, 102), ("b", "y", 1, None, 103)]
        want = rows(whole(spark, events + more))
        assert rows(table.state(spark, spark.createDataFrame(more, EVENTS)).select(*COLUMNS)) == want
        # a load that is run again changes nothing
        table.load(spark.createDataFrame(events[45:], EVENTS), 3)
        assert rows(table.state(spark).select(*COLUMNS)) == rows(whole(spark, events))


def test_split_of_a_run_takes_the_values_before_the_cut(spark, rows, tmp_path):
    table = VersionTable(str(tmp_path / "t"), KEY, SEQUENCE, TRACKED, parts=4)
    run = [("a", "x", beds, day, day) for day, beds in ((1, 10), (3, 30), (5, 50), (9, 90))]
    table.load(spark.createDataFrame(run, EVENTS), 0)
    table.load(spark.createDataFrame([("a", "y", 40, 4, 4)], EVENTS), 1)
    assert rows(table.state(spark).select("plan", "beds", history.START, history.END)) == [
        ("x", 30, 1, 4), ("x", 90, 5, None), ("y", 40, 4, 5)
    ]


def test_busy_keys_are_cut(spark, rows, tmp_path):
    events = drawn(5, 80, "ab")
    table = VersionTable(str(tmp_path / "t"), KEY, SEQUENCE, TRACKED, parts=2)
    hot = hotkeys.hot_keys(spark.createDataFrame(events, EVENTS), KEY, 5)
    for number, at in enumerate((0, 40)):
        table.load(spark.createDataFrame(events[at : at + 40], EVENTS), number, hot)
    assert rows(table.state(spark).select(*COLUMNS)) == rows(whole(spark, events))


def test_a_load_of_one_key_touches_one_partition(spark, tmp_path):
    table = VersionTable(str(tmp_path / "t"), KEY, SEQUENCE, TRACKED, parts=8)
    table.load(spark.createDataFrame(drawn(1, 200, "abcdefghijkl"), EVENTS), 0)
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t/versions").rglob("*.parquet")}
    one = spark.createDataFrame([("a", "q", 1, 3, 999)], EVENTS)
    touched = table.placed(one).select("_part", "site").distinct()
    plan = table.in_parts(table.events(spark), touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dynamicpruning" in plan
    table.load(one, 1)
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t/versions").rglob("*.parquet")}
    part = table.placed(one).first()["_part"]
    gone = {p for p in before if after.get(p) != before[p]}
    assert gone and all(f"_part={part}/" in p for p in gone | (set(after) - set(before)))


def test_stream_reads_the_loaded_versions_and_newer_batches_only(spark, rows, tmp_path):
    events = drawn(3, 100)
    random.Random(3).shuffle(events)
    for at in range(0, 100, 20):
        spark.createDataFrame(events[at : at + 20], EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
    table = VersionTable(str(tmp_path / "table"), KEY, SEQUENCE, TRACKED, parts=3)
    source = table_stream(spark, str(tmp_path / "landing"), files_per_batch=1)
    sinks.versioned_stream(source, str(tmp_path / "t"), str(tmp_path / "c"), table, load_every=2).awaitTermination()
    want = rows(whole(spark, events))
    assert rows(sinks.versioned_state(spark, str(tmp_path / "t"), table).select(*COLUMNS)) == want
    for batch in range(4):  # loaded by now: their rows must not matter
        folder = str(tmp_path / f"t/_batch={batch}")
        spark.createDataFrame([("a", "wrong", 0, 0, 0)], EVENTS).write.mode("overwrite").parquet(folder)
    assert rows(sinks.versioned_state(spark, str(tmp_path / "t"), table).select(*COLUMNS)) == want

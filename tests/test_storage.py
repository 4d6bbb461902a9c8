import time

import pytest
from pyspark.sql import functions as F

from tallyward.operators import changelog, evolution, layout, retention, skipping
from tallyward.streaming import sinks
from tallyward.streaming.sources import table_stream

LOG = "k STRING, v INT, _change_type STRING, _commit_version BIGINT, _commit_timestamp TIMESTAMP_NTZ"


def stored_log(spark, folder):
    rows = [
        ("a", 1, "insert", 1), ("b", 1, "insert", 1), ("c", 1, "insert", 1),
        ("a", 1, "update_preimage", 2), ("a", 2, "update_postimage", 2), ("b", 1, "update_preimage", 2), ("b", 2, "update_postimage", 2),
        ("c", 1, "delete", 3),
        ("a", 2, "update_preimage", 4), ("a", 4, "update_postimage", 4),
    ]
    log = spark.createDataFrame(rows, "k STRING, v INT, _change_type STRING, _commit_version BIGINT").withColumn(
        "_commit_timestamp", F.make_date(F.lit(2020), F.col("_commit_version").cast("int"), F.lit(1)).cast("timestamp_ntz")
    )
    log.write.partitionBy("_commit_version").parquet(folder)


def test_folding_a_stored_log_frees_old_folders_and_keeps_newer_files(spark, rows, tmp_path):
    folder = str(tmp_path / "log")
    stored_log(spark, folder)
    files = lambda n: sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / f"log/_commit_version={n}").glob("*.parquet"))
    newest, cut = files(4), F.lit("2020-04-01").cast("timestamp_ntz")
    dry = rows(retention.fold_stored_log(spark, folder, ["k"], cut, dry_run=True))
    assert dry == [(1, "delete", 3, 0), (2, "replace", 4, 2), (3, "delete", 1, 0), (4, "keep", 2, 2)] and files(1)
    assert rows(retention.fold_stored_log(spark, folder, ["k"], cut)) == dry
    assert not (tmp_path / "log/_commit_version=1").exists() and files(4) == newest
    again = spark.read.parquet(folder)
    assert rows(changelog.as_of(again, ["k"]), "k", "v") == [("a", 4), ("b", 2)]
    assert rows(changelog.as_of(again, ["k"], version=3), "k", "v") == [("a", 2), ("b", 2)]


def test_folded_batches_and_old_working_folders_are_deleted(spark, rows, tmp_path):
    for n in range(4):
        spark.createDataFrame([("a", n)], "k STRING, n INT").coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        time.sleep(0.01)
    folder = str(tmp_path / "t")
    source = table_stream(spark, str(tmp_path / "landing"), files_per_batch=1)
    sinks.scd1_stream(source, folder, str(tmp_path / "c"), ["k"], ["n"], fold_every=2).awaitTermination()
    state = rows(sinks.scd1_state(spark, folder, ["k"], ["n"]))
    listed = retention.expire_batches(spark, folder, sinks._last_fold(spark, folder), dry_run=True)
    assert len(listed) == 5 and (tmp_path / "t/_batch=0").exists()
    assert retention.expire_batches(spark, folder, sinks._last_fold(spark, folder)) == listed
    assert not (tmp_path / "t/_batch=0").exists() and retention.expire_batches(spark, folder, None) == []
    for name in ("terms-0af", "terms-zz", "other-0af"):
        (tmp_path / "shared" / name).mkdir(parents=True)
    later = int(time.time() * 1000) + 60_000
    gone = retention.expire_scratch(spark, str(tmp_path / "shared"), later, ("terms",), dry_run=False)
    assert [g.rsplit("/", 1)[1] for g in gone] == ["terms-0af"] and (tmp_path / "shared/other-0af").exists()
    assert state == [("a", 3)]


def test_state_is_read_after_folded_batches_are_gone(spark, rows, tmp_path):
    for n in range(3):
        spark.createDataFrame([("a", n), (f"b{n}", n)], "k STRING, n INT").coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
    source = table_stream(spark, str(tmp_path / "landing"), files_per_batch=1)
    folder = str(tmp_path / "t")
    sinks.scd1_stream(source, folder, str(tmp_path / "c"), ["k"], ["n"], fold_every=2).awaitTermination()
    before = rows(sinks.scd1_state(spark, folder, ["k"], ["n"]))
    retention.expire_batches(spark, folder, sinks._last_fold(spark, folder))
    assert rows(sinks.scd1_state(spark, folder, ["k"], ["n"])) == before and len(before) == 4


def test_a_lookup_opens_only_files_that_can_hold_the_key(spark, rows, tmp_path):
    folder = str(tmp_path / "t")
    busy = spark.range(3000).select(F.lit("m").alias("k"), F.col("id").alias("v"))
    df = spark.range(0, 4000, 2).select(F.col("id").cast("string").alias("k"), "id").toDF("k", "v").unionByName(busy)
    df = df.unionByName(spark.createDataFrame([(None, 1)], "k STRING, v BIGINT"))
    skipping.write_for_lookup(df, folder, "k", 6, 600)
    assert rows(skipping.lookup(spark, folder, "k", "1000")) == [("1000", 1000)]
    assert skipping.lookup(spark, folder, "k", "m").count() == 3000 and skipping.files_with(spark, folder, "1000").count() == 1
    assert sum(skipping.files_with(spark, folder, str(n)).count() for n in range(1, 60, 2)) <= 2  # in range, but absent
    assert skipping.lookup(spark, folder, "k", "zz").collect() == []
    # files that are not listed are not opened: emptied, they do not matter
    keep = {r["file_path"] for r in skipping.files_with(spark, folder, "1000").collect()}
    for path in (tmp_path / "t").glob("*.parquet"):
        if path.name not in {k.rsplit("/", 1)[1] for k in keep}:
            path.write_bytes(b"")
            (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    assert rows(skipping.lookup(spark, folder, "k", "1000")) == [("1000", 1000)]


def test_z_order_expression_does_not_grow_with_the_files(spark, rows):
    df = spark.range(2000).select((F.col("id") % 50).alias("a"), F.col("id").alias("b"), F.when(F.col("id") > 9, F.col("id")).alias("c"))
    size = lambda files: len(layout.with_z_value(df, ["a", "b"], files)._jdf.queryExecution().optimizedPlan().toString().split("CASE"))
    assert size(100_000) == size(16)
    cuts = [3, 7, 7, 20, 41]
    ranks = df.select("a", layout._cell(F.col("a"), sorted(set(cuts)), "bigint").alias("rank")).distinct().collect()
    assert all(r["rank"] == sum(c <= r["a"] for c in set(cuts)) for r in ranks) and len(ranks) == 50
    assert layout.with_z_value(df, ["a", "b", "c"], 64).agg(F.max("_z")).first()[0] < 2**9
    with pytest.raises(ValueError):
        layout.with_z_value(df, ["a", "b"], 2**61)


def test_loads_with_other_columns_and_types(spark, rows, tmp_path):
    loads = [("id INT, x INT", [(1, 2)]), ("id BIGINT, y STRING", [(2**40, "t")]), ("x DOUBLE, id INT", [(0.5, 3)])]
    paths = [str(tmp_path / f"l{i}") for i in range(3)]
    for path, (schema, data) in zip(paths, loads):
        spark.createDataFrame(data, schema).write.parquet(path)
    assert rows(evolution.read_loads(spark, paths), "id", "x", "y") == [(1, 2.0, None), (2**40, None, "t"), (3, 0.5, None)]
    spark.createDataFrame([("a",)], "id STRING").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(TypeError, match="column id"):
        evolution.read_loads(spark, [paths[0], str(tmp_path / "bad")])


def test_changes_as_a_table_function_prune_commits(spark, rows, tmp_path):
    stored_log(spark, str(tmp_path / "log"))
    changelog.table_function(spark.read.parquet(str(tmp_path / "log")), "feed_of_test")
    got = spark.sql("SELECT k, _change_type FROM feed_of_test(3, 4)")
    assert len(got.collect()) == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_commit_version" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]

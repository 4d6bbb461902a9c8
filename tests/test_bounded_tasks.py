from datetime import date

from pyspark.sql import functions as F

from tallyward.operators import hotkeys, layout


def test_files_of_many_splits_are_put_together_without_a_shuffle(spark, tmp_path, monkeypatch):
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    spark.range(0, 4000, 1, 4).repartition(16, "id").write.parquet(plain)
    def shuffled(*args):
        raise AssertionError("rows are shuffled")

    with monkeypatch.context() as m:
        m.setattr(layout, "spread", shuffled)
        layout.compact(spark, plain, packed)
    assert layout.folder_bytes(spark, packed).first()["files"] == 1
    size = layout.folder_bytes(spark, plain).first()["bytes"]
    layout.compact(spark, plain, packed, size // 20)  # smaller than a split
    assert layout.folder_bytes(spark, packed).first()["files"] >= 20
    assert [r.id for r in spark.read.parquet(packed).orderBy("id").collect()] == list(range(4000))


def test_statistics_of_files_add_up(spark, tmp_path):
    out = str(tmp_path / "t")
    rows = spark.range(100).select((F.col("id") % 2).alias("year"), "id", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    rows.repartition(3).write.partitionBy("year").parquet(out)
    stats = layout.file_stats(spark.read.parquet(out), ["id", "d"]).withColumn("label", F.regexp_extract("file_path", "year=(\\d)", 1))
    assert stats.count() > 2
    got = layout.merged_stats(stats, ["id", "d"], "label").orderBy("label").collect()
    assert [(r.label, r.row_count, r.min_id, r.max_id, r.max_d) for r in got] == [
        ("0", 50, 0, 98, date(2024, 4, 8)), ("1", 50, 1, 99, date(2024, 4, 9)),
    ]


def test_a_key_is_cut_by_its_rows(spark):
    """Forty rows need no 64 slices; a key of many rows has them."""
    rows = spark.range(40_000).select(F.when(F.col("id") < 400, F.col("id") % 10).otherwise(99).alias("k"), "id")
    cut = hotkeys.cut_hot_keys(rows, ["k"], ["id"], hotkeys.hot_keys(rows, ["k"], 30))
    slices = {r.k: r.n for r in cut.groupBy("k").agg(F.countDistinct("_slice").alias("n")).collect()}
    assert slices[99] > 20 and sum(slices[k] for k in range(10)) <= 100


def test_more_lines_land_in_more_files_and_still_in_two_batches(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from tallyward.queries import stream_queries

    given, out = str(tmp_path / "in"), tmp_path / "out"
    spark.range(300).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
        F.lit(2.5).alias("l_extendedprice"), F.lit("A").alias("l_returnflag"), F.lit("2000-01-02").cast("timestamp_ntz").alias("l_shipdate"),
    ).coalesce(1).write.parquet(f"{given}/lineitem.parquet")
    spark.range(300).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 30).alias("o_custkey"), F.lit("p").alias("o_orderpriority"),
        F.lit("1999-01-02").cast("timestamp_ntz").alias("o_orderdate"),
    ).coalesce(1).write.parquet(f"{given}/orders.parquet")
    monkeypatch.setattr(stream_queries, "LANDED_BYTES", 500, raising=False)
    monkeypatch.setattr(stream_queries, "shared_folder", lambda spark, name: str(out))
    got = {r.part: r.rows_stored for r in stream_queries.stream_quarantine(spark, given).collect()}
    spoiled = [i for i in range(300) if (i % 30 * 7 + i * 4) % 50 in (0, 1, 2)]
    assert got["passed"] == 300 - len(spoiled)
    assert len(list(Path(out, "landing").glob("part-*"))) > 4
    assert sorted(p.name for p in Path(out, "passed").glob("_batch=*")) == ["_batch=0", "_batch=1"]


def test_z_order_places_rows_by_counts_and_not_by_a_sample_of_them(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    plain, placed = str(tmp_path / "plain"), str(tmp_path / "z")
    spark.range(4000).select((F.col("id") % 40).alias("a"), (F.col("id") * 7 % 4000).alias("b"), "id").write.parquet(plain)

    def sampled(*args):
        raise AssertionError("rows are sampled")

    with monkeypatch.context() as m:
        m.setattr(DataFrame, "repartitionByRange", sampled)
        layout.z_order(spark, plain, placed, ["a", "b"], 8)
    stored = spark.read.parquet(placed)
    assert sorted(r.id for r in stored.collect()) == list(range(4000))
    counts = [r.row_count for r in layout.file_stats(stored, ["a"]).collect()]
    assert len(counts) == 8 and max(counts) < 700  # 500 each, but for rows of one cell that are dealt by their hash


def test_z_order_of_equal_and_of_no_rows(spark, tmp_path):
    for n in (0, 1000):
        plain, placed = str(tmp_path / f"plain{n}"), str(tmp_path / f"z{n}")
        spark.range(n).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"), "id").write.parquet(plain)
        layout.z_order(spark, plain, placed, ["a", "b"], 4)
        assert spark.read.parquet(placed).count() == n
    assert layout.file_stats(spark.read.parquet(placed), ["a"]).count() == 4


def test_a_split_stream_keeps_no_copy_of_its_batch(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    from tallyward.operators.quality import Rule, RuleSet
    from tallyward.streaming import sinks

    landing = str(tmp_path / "in")
    spark.range(10).write.parquet(landing)
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda df, *args: kept.append(df) or df)
    rules = RuleSet([Rule("small", "id < 7", "drop")])
    stream = spark.readStream.schema("id BIGINT").parquet(landing)
    sinks.split_stream(stream, rules, "id", str(tmp_path / "p"), str(tmp_path / "h"), str(tmp_path / "c")).awaitTermination()
    assert not kept and sinks.stored(spark, str(tmp_path / "p")).count() == 7
    held = sinks.stored(spark, str(tmp_path / "h"))
    assert sorted((r.id, r.raw_record, r.dq_rule) for r in held.collect()) == [(i, f'{{"id":{i}}}', "small") for i in (7, 8, 9)]

import random

from pyspark.sql import functions as F

from tallyward.operators import changelog
from tallyward.plans.incremental import IncrementalTable, Measures

ROW = "id INT, shop STRING, buyer STRING, day INT, cents BIGINT"


def measures():
    return Measures(
        {"shop": F.col("shop")},
        {"sales": F.when(F.col("id").isNotNull(), 1), "cents": F.col("cents")},
        {"buyers": F.col("buyer")},
        {"last_day": F.col("day")},
    )


def recomputed(rows):
    out = {}
    for _, shop, buyer, day, cents in rows.values():
        got = out.setdefault(shop, [0, 0, set(), []])
        got[0] += 1
        got[1] += cents or 0
        got[2] |= {buyer} - {None}
        got[3] += [] if day is None else [day]
    return sorted(((s, n, c, len(b), max(d, default=None)) for s, (n, c, b, d) in out.items()), key=repr)


def batches(seed, n=3):
    """Change images of inserts, updates and deletes, and the table after each batch."""
    rng, table, out = random.Random(seed), {}, []
    draw = lambda i: (i, rng.choice(["a", "b", None]), rng.choice(["u", "v", "w", None]), rng.choice([1, 2, 3, None]), rng.choice([5, -7, None]))
    for _ in range(n):
        changes = []
        for i in rng.sample(range(12), 8):
            old = table.pop(i, None)
            if old is not None and rng.random() < 0.4:
                changes.append((*old, changelog.DELETE))
                continue
            table[i] = draw(i)
            if old is None:
                changes.append((*table[i], changelog.INSERT))
            elif old != table[i]:
                changes += [(*old, changelog.PRE), (*table[i], changelog.POST)]
        out.append((changes, recomputed(table)))
    return out


def test_batches_equal_the_recomputed_table(spark, rows, tmp_path):
    for seed in range(2):
        table = IncrementalTable(str(tmp_path / f"t{seed}"), measures(), parts=3)
        for number, (changes, want) in enumerate(batches(seed)):
            frame = spark.createDataFrame(changes, f"{ROW}, _change_type STRING")
            table.apply(frame, number)
            if number == 1:  # a batch that is run again counts once, also before a fold
                table.apply(frame, number)
                table.fold(spark, 1)
            assert rows(table.state(spark)) == want


def test_a_large_batch_meets_the_stored_numbers_without_a_lookup(spark, rows, tmp_path, monkeypatch):
    found = measures()
    table = IncrementalTable(str(tmp_path / "t"), Measures(found.group, found.sums, found.distinct), parts=3, lookup_rows=0)

    def looked_up(*args):
        raise AssertionError("members are looked up")

    monkeypatch.setattr(IncrementalTable, "_touched", looked_up)
    for number, (changes, want) in enumerate(batches(5)):
        table.apply(spark.createDataFrame(changes, f"{ROW}, _change_type STRING"), number)
        assert rows(table.state(spark)) == [w[:-1] for w in want]


def test_the_largest_value_of_large_batches(spark, rows, tmp_path):
    table = IncrementalTable(str(tmp_path / "t"), measures(), parts=3, lookup_rows=0)
    for number, (changes, want) in enumerate(batches(6)):
        table.apply(spark.createDataFrame(changes, f"{ROW}, _change_type STRING"), number)
        assert rows(table.state(spark)) == want


def test_joined_claims_are_not_shuffled_again_for_their_log(spark, tmp_path, monkeypatch):
    from tallyward.queries import gold_queries

    given, logs = str(tmp_path / "in"), []
    line = "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, l_shipdate STRING"
    lines = [(1, 1, 5, 6, 1.0, 10.0, "A", "1997-02-03"), (1, 1, 5, 6, 1.0, 12.0, "A", "1998-02-03"), (1, 1, 5, 6, 50.0, 12.0, "A", "2000-02-03"),
             (1, None, 5, 6, 1.0, 7.0, "R", "1999-02-03"), (2, 1, 5, 6, 1.0, 7.0, "R", "1999-02-03")]
    spark.createDataFrame(lines, line).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).write.parquet(f"{given}/lineitem.parquet")
    orders = spark.createDataFrame([(1, 3, "p", "1997-01-01"), (1, 3, "p", "1997-01-01"), (2, 4, "p", "1997-01-01")],
                                   "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING, o_orderdate STRING")
    orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{given}/orders.parquet")
    true_log = changelog.log_commits
    monkeypatch.setattr(changelog, "log_commits", lambda *args: logs.append(true_log(*args)) or logs[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gold_queries.claim_commits(spark, given)
        plan = logs[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3  # lines, lines by order, orders
    told = sorted((r.claim_id, r._commit_version, r._change_type, r.claim_amount) for r in got.collect())
    assert told == [("1", 1, "insert", 7.0), ("1-1", 0, "insert", 10.0), ("1-1", 1, "update_postimage", 12.0),
                    ("1-1", 1, "update_preimage", 10.0), ("1-1", 2, "delete", 12.0), ("2-1", 1, "insert", 7.0)]


def test_everything_withdrawn_leaves_no_group(spark, tmp_path):
    table = IncrementalTable(str(tmp_path / "t"), measures(), parts=2)
    one = (1, "a", "u", 3, 5)
    for number, kind in enumerate((changelog.INSERT, changelog.DELETE)):
        table.apply(spark.createDataFrame([(*one, kind)], f"{ROW}, _change_type STRING"), number)
    assert table.state(spark).count() == 0


def test_a_batch_reads_the_partitions_of_its_members(spark, tmp_path):
    table = IncrementalTable(str(tmp_path / "t"), measures(), parts=8)
    many = [(i, f"s{i % 5}", f"b{i}", 1, 1, changelog.INSERT) for i in range(60)]
    table.apply(spark.createDataFrame(many, f"{ROW}, _change_type STRING"), 0)
    stored = table._stored(spark, "buyers", 1)
    near = table._touched(stored, stored.filter("_member = 'b7'"), ["shop", "_member"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and [r["_member"] for r in near.collect()] == ["b7"]

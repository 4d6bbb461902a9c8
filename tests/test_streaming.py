import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyward.operators import quality
from tallyward.operators.quality import RuleSet
from tallyward.sources.tables import csv_with_rejects, inferred_schema
from tallyward.streaming import admissions, sinks
from tallyward.streaming.sources import csv_stream, table_stream

COLUMNS = ["admission_id", "patient_id", "department", "severity", "admitted_at", "discharged_at", "provider_id", "diagnosis_code"]


class Landing:
    """A folder that receives one CSV file per batch, in order."""

    def __init__(self, root):
        self.folder = root / "landing"
        self.folder.mkdir(parents=True)
        self.files, self.rows = 0, 0

    def add(self, *rows):
        lines = [",".join(COLUMNS)]
        for r in rows:
            self.rows += 1
            line = {"admission_id": f"A{self.rows}", "patient_id": "P1", "department": "ICU", "severity": 3,
                    "admitted_at": "", "discharged_at": "", "provider_id": "V", "diagnosis_code": "D", **r}
            lines.append(",".join(str(line[c]) for c in COLUMNS))
        path = self.folder / f"{self.files:03}.csv"
        path.write_text("\n".join(lines) + "\n")
        import os

        stamp = 1_700_000_000 + self.files
        os.utime(path, (stamp, stamp))
        self.files += 1


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path)


TEXT = ", ".join(f"{c} STRING" for c in COLUMNS)


def silver(spark, landing):
    from pyspark.sql.types import StructType

    return admissions.cleanse(csv_stream(spark, str(landing.folder), StructType.fromDDL(TEXT), files_per_batch=1))


def at(*times):
    return [{"admitted_at": f"2024-01-01 {t}:00"} for t in times]


def hourly(spark, landing, tmp_path):
    query = sinks.append_table(admissions.hourly_departments(silver(spark, landing)), str(tmp_path / "t"), str(tmp_path / "c"))
    query.awaitTermination()
    dropped = sum(
        s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in json.loads(p.json)["stateOperators"]
    )
    got = spark.read.parquet(str(tmp_path / "t")).select(F.hour("window_start"), "admission_count").collect()
    return sorted(map(tuple, got)), dropped


def test_late_row_right_after_the_advance_still_counts(spark, landing, tmp_path):
    for batch in (["10:05", "10:59"], ["12:30", "10:10"], ["16:00"], ["10:20", "14:30"]):
        landing.add(*at(*batch))
    assert hourly(spark, landing, tmp_path) == ([(10, 4), (12, 1)], 0)


def test_late_row_one_batch_later_is_dropped(spark, landing, tmp_path):
    for batch in (["10:05", "10:59"], ["12:30", "10:10"], ["16:00"], ["16:01"], ["10:20", "14:30"]):
        landing.add(*at(*batch))
    assert hourly(spark, landing, tmp_path) == ([(10, 3), (12, 1)], 1)


def test_stream_restarts_at_its_checkpoint(spark, landing, tmp_path):
    landing.add(*at("10:05", "11:00"))
    run = lambda: sinks.append_table(silver(spark, landing), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    run()
    landing.add(*at("12:00"))
    run()
    run()
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(r["admission_id"] for r in stored.collect()) == ["A1", "A2", "A3"]
    assert stored.filter("_source_file NOT LIKE '%.csv'").count() == 0


def test_cleanse_types_and_stay(spark, landing, tmp_path):
    landing.add(
        {"admitted_at": "2024-01-01 10:00:00", "discharged_at": "2024-01-01 13:30:00", "severity": "4"},
        {"admitted_at": "2024-01-01 10:00:00", "severity": "bad"},
    )
    sinks.append_table(silver(spark, landing), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "t")).orderBy("admission_id").collect()
    assert [(r["severity"], r["los_hours"]) for r in got] == [(4, 3.5), (None, None)]


def test_alerts(spark):
    rows = [(str(s), "P", "ICU", s, datetime(2024, 1, 1), "V", "D") for s in range(1, 6)]
    df = spark.createDataFrame(rows, "admission_id STRING, patient_id STRING, department STRING, severity INT, admitted_at TIMESTAMP, provider_id STRING, diagnosis_code STRING")
    assert [(r["severity"], r["alert_level"]) for r in admissions.alerts(df).collect()] == [(4, "HIGH"), (5, "CRITICAL")]


def test_fail_rule_stops_a_stream(spark, landing, tmp_path):
    landing.add({"admitted_at": "2024-01-01 10:00:00", "severity": 9})
    checked = quality.apply_rules(silver(spark, landing), RuleSet.admissions())
    with pytest.raises(Exception, match="severity_range"):
        sinks.append_table(checked, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()


def test_gold_upsert_follows_every_batch(spark, landing, tmp_path, rows):
    keys = ["_w", "department", "patient_id"]
    landing.add(*at("10:05"))
    landing.add({**at("10:15")[0], "patient_id": "P2"}, *at("11:00"))
    landing.add(*at("10:30"))
    partials = admissions.hourly_patients(silver(spark, landing))
    sinks.gold_upsert_stream(partials, str(tmp_path / "t"), str(tmp_path / "c"), keys).awaitTermination()
    got = admissions.departments_from_patients(sinks.gold_state(spark, str(tmp_path / "t"), keys))
    assert rows(got.select(F.hour("window_start"), "admission_count", "unique_patients")) == [(10, 3, 2), (11, 1, 1)]


CHANGES = "k STRING, plan STRING, day DATE, no BIGINT"


@pytest.fixture
def change_table(spark, tmp_path):
    """Change events in several files, later files holding earlier events."""
    import datetime as dt
    import os

    day = dt.date(2024, 1, 1)
    events = [("a" if i % 3 else "b", "xyyxz"[i % 5], day + timedelta(days=i), i) for i in range(30)]
    folder = tmp_path / "changes.parquet"
    for n, part in enumerate((events[20:], events[:10], events[10:20])):
        spark.createDataFrame(part, CHANGES).coalesce(1).write.mode("append").parquet(str(folder))
    for n, f in enumerate(sorted(folder.glob("*.parquet"))):
        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder), events


def test_type1_and_type2_streams_match_batch(spark, change_table, tmp_path, rows):
    from tallyward.operators import history

    folder, events = change_table
    batch = spark.createDataFrame(events, CHANGES)
    stream = lambda: table_stream(spark, folder, files_per_batch=1)
    sinks.scd1_stream(stream(), str(tmp_path / "t1"), str(tmp_path / "c1"), ["k"], ["day", "no"]).awaitTermination()
    sinks.scd2_stream(stream(), str(tmp_path / "t2"), str(tmp_path / "c2"), ["k"]).awaitTermination()
    assert sinks.stored(spark, str(tmp_path / "t1")).select(sinks.BATCH).distinct().count() >= 2
    one = sinks.scd1_state(spark, str(tmp_path / "t1"), ["k"], ["day", "no"])
    assert rows(one) == rows(history.scd1_apply(None, batch, ["k"], ["day", "no"]))
    two = sinks.scd2_state(spark, str(tmp_path / "t2"), ["k"], ["day", "no"], ["plan"])
    assert rows(two) == rows(history.scd2_versions(batch, ["k"], ["day", "no"], ["plan"]))
    keep = str(tmp_path / "t3")
    sinks.scd1_stream(stream(), keep, str(tmp_path / "c3"), ["k"], ["day", "no"], fold_every=2).awaitTermination()
    assert rows(sinks.scd1_state(spark, keep, ["k"], ["day", "no"])) == rows(one)
    assert sinks.stored(spark, keep).count() < spark.read.parquet(keep).count()


def test_retried_batch_counts_once(spark, change_table, tmp_path):
    folder, events = change_table
    run = lambda c: sinks.scd2_stream(table_stream(spark, folder), str(tmp_path / "t"), str(tmp_path / c), ["k"]).awaitTermination()
    run("c1")
    run("c2")  # a lost checkpoint replays batch 0 over the stored one
    assert sinks.stored(spark, str(tmp_path / "t")).count() == len(events)


def test_stream_dedup(spark, landing, tmp_path):
    landing.add(*at("10:00"))
    landing.add({**at("10:00")[0], "admission_id": "A1"}, *at("10:05"))
    single = admissions.first_within_watermark(silver(spark, landing), "admitted_at", ["admission_id"])
    sinks.append_table(single, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r["admission_id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["A1", "A3"]


def test_schema_is_inferred_once_and_kept(spark, landing, tmp_path):
    landing.add({"admitted_at": "2024-01-01 10:00:00", "severity": 4})
    keep = str(tmp_path / "schema")
    first = inferred_schema(spark, str(landing.folder), keep)
    assert dict((f.name, f.dataType.simpleString()) for f in first)["severity"] == "int"
    landing.add({"severity": "text now"})
    assert inferred_schema(spark, str(landing.folder), keep) == first


def test_malformed_rows_keep_their_line(spark, landing):
    from pyspark.sql.types import StructType

    landing.add({"severity": 4}, {"severity": "bad"})
    schema = StructType.fromDDL(TEXT.replace("severity STRING", "severity INT"))
    got = csv_with_rejects(spark, str(landing.folder), schema).cache()
    assert [("bad" in r["_bad"]) for r in got.filter("_bad IS NOT NULL").collect()] == [True]
    assert got.filter("_bad IS NULL").count() == 1
    got.unpersist()


def test_approximate_patients_keep_small_state(spark):
    rows = [(str(i), str(i % 9), "ICU", 3, datetime(2024, 1, 1), datetime(2024, 1, 1, 5)) for i in range(50)]
    df = spark.createDataFrame(rows, "admission_id STRING, patient_id STRING, department STRING, severity INT, admitted_at TIMESTAMP, discharged_at TIMESTAMP")
    exact = admissions.hourly_departments(df).first()
    rough = admissions.hourly_departments(df, exact=False).first()
    assert exact["unique_patients"] == rough["unique_patients"] == 9
    assert (exact["long_stay_count"], exact["avg_los_hours"]) == (50, 5.0)

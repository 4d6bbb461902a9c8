from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyward.operators import layout, masking
from tallyward.operators.masking import Viewer
from tallyward.session import shared_folder
from tallyward.sources import generate


@pytest.fixture
def numbers(spark):
    ids = spark.range(0, 4000, 1, 4)
    return ids.select((F.col("id") * 37 % 500).alias("a"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") * 11 % 300).cast("int")).alias("d"), "id")


def test_layouts_keep_every_row(spark, numbers, rows, tmp_path):
    want = rows(numbers)
    plain = str(tmp_path / "plain")
    numbers.repartition(16).write.parquet(plain)
    z = layout.z_order(spark, plain, str(tmp_path / "z"), ["a", "d"], 16)
    c = layout.write_clustered(numbers, str(tmp_path / "c"), ["a"], files=4)
    packed = layout.compact(spark, plain, str(tmp_path / "packed"))
    even = layout.rewrite_rebalanced(numbers, str(tmp_path / "even"), ["a"])
    for folder in (z, c, packed, even):
        assert rows(spark.read.parquet(folder)) == want
    assert layout.folder_bytes(spark, plain).first()["files"] == 16
    assert layout.folder_bytes(spark, packed).first()["files"] == 1


def test_z_order_narrows_lookups_on_both_columns(spark, numbers, tmp_path):
    plain, z = str(tmp_path / "plain"), str(tmp_path / "z")
    numbers.repartition(16).write.parquet(plain)
    layout.z_order(spark, plain, z, ["a", "d"], 16)
    opened = {}
    for name, folder in (("plain", plain), ("z", z)):
        stats = layout.file_stats(spark.read.parquet(folder), ["a", "d"])
        assert stats.agg(F.sum("row_count")).first()[0] == 4000
        opened[name] = [layout.files_to_read(stats, c, v).first()["files_read"] for c, v in (("a", 250), ("d", date(2024, 5, 1)))]
    assert opened["plain"] == [16, 16] and all(n <= 8 for n in opened["z"])


def test_clustering_splits_a_hot_value_over_files(spark, tmp_path):
    df = spark.range(0, 8000, 1, 4).select(F.when(F.col("id") < 7000, 1).otherwise(F.col("id")).alias("k"), "id")
    folder = layout.write_clustered(df, str(tmp_path / "t"), ["k"], files=8)
    biggest = layout.file_stats(spark.read.parquet(folder), ["k"]).agg(F.max("row_count")).first()[0]
    assert biggest < 3000


def test_column_statistics(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "n INT, s STRING")
    assert sorted(map(tuple, layout.column_statistics(df, ["n", "s"]).collect())) == [("n", 1, 1, "1", "1"), ("s", 0, 2, "a", "b")]


CLAIMS = "claim_id STRING, provider_id STRING, dob DATE, patient_address STRING"


@pytest.fixture
def claims(spark):
    return spark.createDataFrame([("1", "v1", date(1970, 5, 15), "12 Oak St"), ("2", "v2", None, None)], CLAIMS)


def test_masks_hide_from_all_but_stewards(claims, rows):
    seen = masking.mask(claims, ["dob", "patient_address"], Viewer("x", frozenset({"admins"})))
    assert {(r["dob"], r["patient_address"]) for r in seen.collect()} == {(date(1900, 1, 1), "REDACTED")}
    assert seen.columns == claims.columns
    assert rows(masking.mask(claims, ["dob"], Viewer("x", frozenset({"data_stewards"})))) == rows(claims)


def test_row_filters(spark, claims, rows):
    assert rows(masking.own_rows(claims, "provider_id", Viewer("v2")), "claim_id") == [("2",)]
    for group in ("admins", "care_managers"):
        assert masking.own_rows(claims, "provider_id", Viewer("nobody", frozenset({group}))).count() == 2
    grants = spark.createDataFrame([("v1", "team"), ("v2", "team"), ("v2", "other")], "provider_id STRING, viewer STRING")
    assert masking.rows_by_access(claims, "provider_id", grants, Viewer("team")).count() == 2
    assert masking.rows_by_access(claims, "provider_id", grants, Viewer("other")).count() == 1


def test_secured_view_and_sql_masks(spark, claims, rows):
    masking.secured_view(claims, "secured", ["dob", "patient_address"], "provider_id", Viewer("v1"))
    assert [tuple(r) for r in spark.sql("SELECT * FROM secured").collect()] == [("1", "v1", date(1900, 1, 1), "REDACTED")]
    masking.create_mask_functions(spark, Viewer("s", frozenset({"data_stewards"})))
    assert spark.sql("SELECT mask_text('a') AS m").first()["m"] == "a"
    masking.create_mask_functions(spark, Viewer("s"))
    assert tuple(spark.sql("SELECT mask_text('a'), mask_date(DATE'2020-01-01')").first()) == ("REDACTED", date(1900, 1, 1))


def test_generators_do_not_depend_on_partitioning(spark, rows):
    a, b = spark.range(0, 300, 1, 1), spark.range(0, 300, 1, 9)
    for make in (generate.providers, generate.patients, lambda i: generate.claims(i, 50, 20), lambda i: generate.admissions(i, 50, 20)):
        assert rows(make(a)) == rows(make(b))


def test_inflation_gives_unique_ids(spark):
    big = generate.inflate(generate.claims(spark.range(100), 50, 20), 30)
    assert (big.count(), big.select("claim_id").distinct().count()) == (3000, 3000)


def test_claim_mix(spark):
    share = generate.claims(spark.range(10_000), 50, 20).groupBy("claim_status").count().collect()
    assert {r["claim_status"]: r["count"] for r in share} == {"APPROVED": 7800, "DENIED": 1500, "PENDING": 700}
    spread = generate.claims(spark.range(20_000), 50, 20).agg(F.min("claim_amount"), F.avg("claim_amount")).first()
    assert spread[0] >= 200 and abs(spread[1] - (200 + 5000 * 0.798)) < 100
    assert generate.diagnoses(spark).count() == 15


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark, "x")
    assert folder.startswith(base) if base else folder.startswith("/tmp/run-")
    assert folder != shared_folder(spark, "x")


def test_catalog_statistics_and_declared_table(spark, numbers, tmp_path):
    from tallyward.schemas import create_table

    numbers.write.mode("overwrite").option("path", str(tmp_path / "managed")).saveAsTable("layout_numbers")
    layout.analyze(spark, "layout_numbers")
    told = {r["info_name"]: r["info_value"] for r in spark.sql("DESCRIBE EXTENDED layout_numbers a").collect()}
    assert (told["min"], told["max"], told["num_nulls"]) == ("0", "499", "0")
    spark.sql("DROP TABLE layout_numbers")
    create_table(spark, "provider_dim", "declared_providers", str(tmp_path / "providers"))
    create_table(spark, "provider_dim", "declared_providers", str(tmp_path / "providers"))
    assert "hospital_affil" in spark.table("declared_providers").columns
    spark.sql("DROP TABLE declared_providers")

from datetime import date, datetime

import pytest

from tallyward.operators import hotkeys
from tallyward.plans import gold, reporting, star
from tallyward.schemas import SCHEMAS, conform, empty_table, schema

CLAIMS = (
    "claim_id STRING, patient_id STRING, provider_id STRING, diagnosis_code STRING, procedure_code STRING, "
    "claim_date DATE, claim_amount DOUBLE, claim_status STRING, payer_id STRING, _ingest_ts TIMESTAMP"
)


@pytest.fixture
def claims(spark):
    def make(*rows):
        full = [
            (f"c{i}", p, v, d, "99213", day, amount, status, "PAYER1", datetime(2024, 6, 1))
            for i, (p, v, d, day, amount, status) in enumerate(rows)
        ]
        return spark.createDataFrame(full, CLAIMS)

    return make


JAN, MAR = date(2024, 1, 5), date(2024, 3, 5)


def test_only_pending_claims_give_no_amount_share(claims):
    row = gold.payer_denial_analysis(claims(("p", "v", "d", JAN, 10.0, "PENDING"))).first()
    assert row["denied_amount_pct"] is None and row["denial_rate_pct"] == 0.0 and row["denied_amount"] == 0.0


def test_unknown_provider_ranks_in_a_group_of_its_own(spark, claims, rows):
    dim = spark.createDataFrame([("v1", "A", "Cardiology", "IN_NETWORK", "TX")],
                                "provider_id STRING, provider_name STRING, specialty STRING, network_status STRING, state STRING")
    data = claims(("p", "v1", "d", JAN, 1.0, "APPROVED"), ("p", "v2", "d", JAN, 5.0, "DENIED"), ("p", "v3", "d", JAN, 9.0, "DENIED"))
    got = gold.provider_performance(data, dim)
    assert rows(got, "provider_id", "specialty", "specialty_rank") == [("v1", "Cardiology", 1), ("v2", None, 2), ("v3", None, 1)]


@pytest.mark.parametrize(
    ("spend", "chronic", "tier"),
    [(10_000.0, 0, "HIGH"), (1.0, 3, "HIGH"), (5_000.0, 0, "MEDIUM"), (1.0, 1, "MEDIUM"), (1.0, 0, "LOW"),
     (1.0, None, "LOW"), (20_000.0, None, "HIGH")],
)
def test_risk_tiers(spark, spend, chronic, tier):
    df = spark.createDataFrame([(spend, chronic)], "s DOUBLE, c INT")
    assert df.select(gold.risk_tier("s", "c").alias("t")).first()["t"] == tier


def test_risk_score_takes_the_current_version_only(spark, claims):
    versions = spark.createDataFrame(
        [("p", "F", "L", "old", 0, False), ("p", "F", "L", "new", 4, True)],
        "patient_id STRING, first_name STRING, last_name STRING, insurance_plan STRING, chronic_conditions INT, `__IS_CURRENT` BOOLEAN",
    )
    got = gold.patient_risk_scores(claims(("p", "v", "d", JAN, 1.0, "APPROVED"), ("q", "v", "d", JAN, 1.0, "APPROVED")), versions)
    assert sorted((r["patient_id"], r["insurance_plan"], r["risk_tier"]) for r in got.collect()) == [("p", "new", "HIGH"), ("q", None, "LOW")]


def test_trend_compares_with_the_previous_month_present(spark, claims, rows):
    dim = spark.createDataFrame([("d", "text", "cat", True)], "icd10_code STRING, description STRING, category STRING, chronic_flag BOOLEAN")
    data = claims(*[("p", "v", "d", JAN, 1.0, "APPROVED")] * 2, ("p", "v", "d", MAR, 1.0, "APPROVED"))
    got = gold.diagnosis_trends(data, dim)
    assert rows(got, "claim_month", "claim_count", "prev_month_count", "mom_change_pct") == [
        (date(2024, 1, 1), 2, None, None), (date(2024, 3, 1), 1, 2, -50.0),
    ]


def test_money_sums_are_exact_in_any_order(spark, claims):
    rows = [("p", "v", "d", JAN, 0.1 * (i % 7) + 1e9, "APPROVED") for i in range(200)]
    a, b = claims(*rows), claims(*reversed(rows)).repartition(7)
    total = lambda df: gold.monthly_claims_summary(df).first()["total_amount"]
    assert total(a) == total(b)


def test_department_summary_counts_open_stays(spark):
    rows = [("1", "p", "ICU", 5, datetime(2024, 1, 1), None), ("2", "p", "ICU", 1, datetime(2024, 1, 1), datetime(2024, 1, 2, 6))]
    df = spark.createDataFrame(rows, "admission_id STRING, patient_id STRING, department STRING, severity INT, admitted_at TIMESTAMP, discharged_at TIMESTAMP")
    r = gold.er_dept_summary(df).first()
    assert (r["still_admitted"], r["avg_los_hours"], r["max_los_hours"], r["long_stay_over_24h"], r["high_severity_pct"]) == (1, 30.0, 30.0, 1, 50.0)


def test_row_counts_flag_a_shortfall(spark):
    got = gold.row_counts({"a": spark.range(99), "b": spark.range(98)}, {"a": 100, "b": 100})
    assert sorted((r["table_name"], r["status"]) for r in got.collect()) == [("a", "OK"), ("b", "LOW")]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_readmission_needs_thirty_days(spark, hot_rows):
    day = lambda n: datetime(2024, 1, 1) + __import__("datetime").timedelta(days=n)
    rows = [("p", "1", day(0), day(1)), ("p", "2", day(31), day(32)), ("p", "3", day(63), None), ("p", "4", day(64), day(65))]
    df = spark.createDataFrame(rows, "patient_id STRING, admission_id STRING, admitted_at TIMESTAMP, discharged_at TIMESTAMP")
    got = reporting.readmissions(df, hotkeys.hot_keys(df, ["patient_id"], hot_rows)).collect()
    assert {r["admission_id"]: r["readmitted"] for r in got} == {"1": True, "2": False, "3": False, "4": False}


def test_year_over_year_uses_the_calendar(spark, claims):
    dim = spark.createDataFrame([("d", "cat")], "icd10_code STRING, category STRING")
    er = spark.createDataFrame([], "diagnosis_code STRING, severity INT, admitted_at TIMESTAMP")
    data = claims(("p", "v", "d", date(2022, 1, 1), 10.0, "APPROVED"), ("p", "v", "d", date(2023, 1, 1), 15.0, "APPROVED"),
                  ("p", "v", "d", date(2024, 4, 1), 1.0, "APPROVED"))
    got = reporting.cost_by_diagnosis(data, dim, er).collect()
    assert {r["quarter"]: r["yoy_cost_change_pct"] for r in got} == {"2022-Q1": None, "2023-Q1": 50.0, "2024-Q2": None}


def test_flag_dimension_has_eight_rows(spark):
    flags = star.all_claim_flags(spark).collect()
    assert len({tuple(r)[1:] for r in flags}) == 8
    assert [r["flag_key"] for r in flags if r["is_denied"] and not r["is_high_cost"] and not r["is_out_of_network"]] == [4]


def test_declared_schemas(spark):
    for name in SCHEMAS:
        assert empty_table(spark, name).count() == 0
    shaped = conform(spark.createDataFrame([("1", "c")], "claim_amount STRING, claim_id STRING"), "claims_fact")
    assert shaped.columns == schema("claims_fact").names and shaped.first()["claim_amount"] == 1.0

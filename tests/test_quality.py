import json
from datetime import date

import pytest
from pyspark.sql import Observation

from tallyward.functions.fixed_values import ADMISSION_RULES, CLAIMS_RULES
from tallyward.operators import quality
from tallyward.operators.quality import Rule, RuleSet

SCHEMA = (
    "claim_id STRING, patient_id STRING, provider_id STRING, diagnosis_code STRING, claim_date DATE, claim_amount DOUBLE, "
    "claim_status STRING, _source_file STRING"
)
GOOD = ("c", "p", "v", "d", date(2024, 1, 1), 1.0, "PENDING", "f.csv")


def with_(**change):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return tuple(change.get(n, v) for n, v in zip(names, GOOD, strict=True))


@pytest.fixture
def claims(spark):
    return lambda *r: spark.createDataFrame(list(r), SCHEMA)


RULES = RuleSet.claims("DATE'2024-12-31'")


def test_rule_lists_are_consistent():
    for rules in (CLAIMS_RULES, ADMISSION_RULES):
        names = [n for n, _, _ in rules]
        assert len(set(names)) == len(names)
        assert all(p and a in quality.ACTIONS for _, p, a in rules)
    by_name = {n: a for n, _, a in CLAIMS_RULES + ADMISSION_RULES}
    assert {by_name[f"{k}_not_null"] for k in ("claim_id", "patient_id", "provider_id", "admission_id")} == {"drop"}
    assert by_name["claim_status_valid"] == by_name["severity_range"] == "fail"
    assert by_name["discharge_after_admit"] == "warn"


def test_strictest_action_holds():
    merged = RuleSet([Rule("a", "x > 0", "warn"), Rule("a", "x > 0", "fail"), Rule("a", "x > 0", "drop")])
    assert [r.action for r in merged.rules] == ["fail"]
    with pytest.raises(ValueError, match="two predicates"):
        RuleSet([Rule("a", "x > 0"), Rule("a", "x > 1")])
    with pytest.raises(ValueError, match="bad rule"):
        RuleSet([Rule("a", "x > 0", "explode")])


def test_pass_and_quarantine_cover_the_input(claims, rows):
    data = claims(GOOD, with_(claim_id=None), with_(patient_id=None, provider_id=None), with_(claim_amount=-1.0))
    passing, held = quality.split(data, RULES, "claim_id")
    assert passing.count() == 2
    assert rows(held, "dq_rule") == [("claim_id_not_null",), ("patient_id_not_null",), ("provider_id_not_null",)]
    record = json.loads(held.filter("dq_rule = 'claim_id_not_null'").first()["raw_record"])
    assert record["claim_id"] is None and record["claim_amount"] == 1.0 and record["claim_date"] == "2024-01-01"
    assert {r["_source_file"] for r in held.collect()} == {"f.csv"}


def test_warn_rules_keep_rows_and_are_counted(claims, rows):
    data = claims(GOOD, with_(claim_amount=-1.0), with_(claim_date=date(2014, 1, 1)), with_(diagnosis_code=None))
    seen = Observation("warn")
    assert quality.apply_rules(data, RULES, seen).count() == 4
    assert {k: v for k, v in seen.get.items() if v} == {
        "claim_amount_positive": 1, "claim_date_valid": 1, "diagnosis_code_not_null": 1,
    }
    counted = {r["rule"]: r["violations"] for r in quality.violations(data, RULES).collect() if r["violations"]}
    assert counted == {k: 1 for k in ("claim_amount_positive", "claim_date_valid", "diagnosis_code_not_null")}


@pytest.mark.parametrize("status", ["REJECTED", None])
def test_fail_rule_halts_even_when_its_column_is_unused(claims, status):
    checked = quality.apply_rules(claims(GOOD, with_(claim_status=status)), RULES)
    with pytest.raises(Exception, match="claim_status_valid"):
        checked.select("claim_id").collect()


def test_dropped_rows_do_not_halt(claims):
    assert quality.apply_rules(claims(GOOD, with_(claim_id=None, claim_status="x")), RULES).count() == 1


def test_severity_bounds(spark):
    rules = RuleSet.admissions()
    schema = "admission_id STRING, patient_id STRING, severity INT, admitted_at TIMESTAMP, discharged_at TIMESTAMP"
    from datetime import datetime

    ok = ("a", "p", 5, datetime(2024, 1, 1), None)
    assert quality.apply_rules(spark.createDataFrame([ok], schema), rules).count() == 1
    with pytest.raises(Exception, match="severity_range"):
        quality.apply_rules(spark.createDataFrame([(*ok[:2], 6, *ok[3:])], schema), rules).collect()

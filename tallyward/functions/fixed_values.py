"""Fixed values.

Everything in this file is data, kept as plain text because results depend on
the exact values: code lists, statuses, thresholds and rule predicates.
"""

# Claim and network states
APPROVED, DENIED, PENDING = "APPROVED", "DENIED", "PENDING"
IN_NETWORK, OUT_OF_NETWORK = "IN_NETWORK", "OUT_OF_NETWORK"

# Data-quality predicates: name, SQL predicate, action
CLAIMS_RULES = [
    ("claim_id_not_null", "claim_id IS NOT NULL", "drop"),
    ("patient_id_not_null", "patient_id IS NOT NULL", "drop"),
    ("provider_id_not_null", "provider_id IS NOT NULL", "drop"),
    ("claim_amount_positive", "claim_amount > 0", "warn"),
    ("claim_date_valid", "claim_date >= DATE'2015-01-01' AND claim_date <= {as_of}", "warn"),
    ("claim_status_valid", "claim_status IN ('APPROVED', 'DENIED', 'PENDING')", "fail"),
    ("diagnosis_code_not_null", "diagnosis_code IS NOT NULL", "warn"),
]
ADMISSION_RULES = [
    ("admission_id_not_null", "admission_id IS NOT NULL", "drop"),
    ("patient_id_not_null", "patient_id IS NOT NULL", "drop"),
    ("severity_range", "severity BETWEEN 1 AND 5", "fail"),
    ("admitted_at_not_null", "admitted_at IS NOT NULL", "drop"),
    ("discharge_after_admit", "discharged_at IS NULL OR discharged_at > admitted_at", "warn"),
]

# Risk tiers of the computed patient table: spend or chronic count reaching a bound
HIGH_SPEND, HIGH_CHRONIC = 10_000, 3
MEDIUM_SPEND, MEDIUM_CHRONIC = 5_000, 1

# Admissions
ALERT_SEVERITY, CRITICAL_SEVERITY = 4, 5
LONG_STAY_HOURS, HOURLY_LONG_STAY_HOURS = 24, 4
LATENESS, WINDOW = "2 hours", "1 hour"
TRIAGE_MIN_SEVERITY = 3
TRIAGE_LEVELS = ["IMMEDIATE", "URGENT", "LESS_URGENT", "NON_URGENT"]

# Masked stand-ins
MASKED_DATE, MASKED_TEXT = "1900-01-01", "REDACTED"

# Text enrichment
MODEL_BATCH, MODEL_TRIES = 10, 3
PREVIEW_CHARS, INDEX_MIN_ROWS, TOP_K = 100, 10, 5

# Maintenance
COMPACT_BYTES, RETENTION_HOURS = 1 << 30, 168

# Synthetic data lists
SPECIALTIES = [
    "Internal Medicine", "Family Medicine", "Cardiology", "Orthopedics", "Pulmonology",
    "Nephrology", "Psychiatry", "Oncology", "Neurology", "Emergency Medicine",
]
STATES = [
    "TX", "CA", "FL", "NY", "PA", "OH", "IL", "NC", "GA", "MI",
    "NJ", "VA", "WA", "AZ", "MA", "TN", "IN", "MO", "MD", "WI",
]
INSURANCE_PLANS = [
    "Medicare Part A", "Medicare Part B", "Medicare Advantage",
    "Medicaid", "UHC Choice Plus", "Aetna PPO",
]
PROCEDURE_CODES = [
    "99213", "99214", "99215", "99232", "99283", "71046", "93000", "80053",
    "85025", "36415", "27447", "43239", "45378", "70553", "93306",
]
DEPARTMENTS = ["Emergency", "ICU", "Cardiology", "Trauma", "Pediatrics", "Neurology"]
DIAGNOSES = [
    ("E11.9", "Type 2 diabetes mellitus without complications", "Endocrine"),
    ("I10", "Essential (primary) hypertension", "Circulatory"),
    ("J44.1", "Chronic obstructive pulmonary disease with exacerbation", "Respiratory"),
    ("M54.5", "Low back pain", "Musculoskeletal"),
    ("F32.9", "Major depressive disorder, single episode", "Mental Health"),
    ("N18.3", "Chronic kidney disease, stage 3", "Genitourinary"),
    ("Z00.00", "Encounter for general adult medical examination", "Preventive"),
    ("I25.10", "Atherosclerotic heart disease", "Circulatory"),
    ("E78.5", "Hyperlipidemia, unspecified", "Endocrine"),
    ("J18.9", "Pneumonia, unspecified organism", "Respiratory"),
    ("S72.001A", "Fracture of femur", "Musculoskeletal"),
    ("C34.10", "Malignant neoplasm of upper lobe bronchus", "Neoplasms"),
    ("G30.9", "Alzheimer's disease, unspecified", "Neurological"),
    ("K21.0", "Gastro-esophageal reflux disease with esophagitis", "Digestive"),
    ("Z79.4", "Long-term (current) use of insulin", "Endocrine"),
]

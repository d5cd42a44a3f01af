"""Word lists, codes, thresholds and contracts that results must agree on.

Nothing here is logic; the functions and plans read these tables.
"""

# Null tokens (compared upper-case and trimmed).
BLANK_TOKENS = ("", "NAN", "(NULL)")
BLANK_BOROUGH_TOKENS = ("", "UNSPECIFIED", "NAN", "(NULL)")
STRICT_TOKENS = ("", "NAN", "NONE", "NULL", "(NULL)")
REDACTED = "(null)"

# Borough codes: full name, police letter, building-department digit.
BOROUGH_CODES = {
    "MANHATTAN": ("MANHATTAN", "M", "1"),
    "BRONX": ("BRONX", "B", "2"),
    "BROOKLYN": ("BROOKLYN", "K", "3"),
    "QUEENS": ("QUEENS", "Q", "4"),
    "STATEN ISLAND": ("STATEN ISLAND", "STATEN IS", "S", "5"),
}
BOROUGH_ORDER = ("MANHATTAN", "BROOKLYN", "QUEENS", "BRONX", "STATEN ISLAND")

# Complaint statuses.
STATUS_CODES = {
    "Open": ("OPEN",),
    "Closed": ("CLOSED",),
    "Pending": ("PENDING",),
    "Started": ("STARTED",),
    "Assigned": ("ASSIGNED",),
    "In Progress": ("IN PROGRESS", "IN_PROGRESS"),
    "Draft": ("DRAFT",),
}
STATUS_DEFAULT = "Unspecified"

# Grades and law categories.
GRADE_NUMBERS = {"A": 1, "B": 2, "C": 3}
GRADE_VALUES = ("A", "B", "C", "Z", "P", "N")
LAW_CATEGORIES = ("F", "M", "V", "9", "I")
CRITICAL_FLAGS = ("Critical", "Not Critical", "Not Applicable")
CRITICAL = "Critical"

# Complaint category rules, first match wins; words are matched case-sensitively anywhere.
CATEGORY_RULES = (
    ("Noise", ("Noise",)),
    ("Food", ("Food",)),
    ("Construction", ("Construction", "Building")),
    ("Housing", ("Heat", "Hot Water")),
    ("Infrastructure", ("Water", "Sewer")),
    ("Streets", ("Street", "Sidewalk")),
    ("Sanitation", ("Sanit", "Trash", "Dirty")),
)
CATEGORY_DEFAULT = "Other"

# Work category by job type.
WORK_CATEGORIES = {
    "New Building": ("NB",),
    "Alteration": ("A1", "A2", "A3"),
    "Demolition": ("DM",),
    "Sign": ("SG",),
    "Foundation": ("FO",),
}
WORK_DEFAULT = "Other"

# Spatial labels.
ZIP_UNKNOWN = "UNKNOWN"
ZIP_FROM_POLYGON = "spatial"
ZIP_FALLBACK = "borough_fallback"

# Lookback in days, and the first month of the date dimension.
LOOKBACK_DAYS = 90
ARREST_LOOKBACK_DAYS = 200
FIRST_MONTH = "2006-01"

# Score: (measure, rows per point, weight); grade share carries the last weight.
SCORE_PARTS = (
    ("total_complaints", 100, "0.25"),
    ("total_arrests", 50, "0.25"),
    ("active_permit_count", 20, "0.20"),
)
SCORE_GRADE_WEIGHT = "0.30"

# Health tiers: lower bound of the score, label.
HEALTH_TIERS = ((75, "excellent"), (50, "good"), (25, "fair"))
CITY_TIERS = ((70, "excellent"), (50, "good"), (30, "fair"))
TIER_DEFAULT = "poor"
TIER_MISSING = "unknown"

# Report sizes.
TOP_TYPES = 15
TOP_CHART_TYPES = 10
TOP_SCORES = 30
RECENT_MONTHS = 24

# Lineage columns.
INGEST_COLUMNS = (
    "_row_hash",
    "_ingested_at",
    "_source_file",
    "_ingest_date",
    "_job_run_id",
    "_notebook_path",
    "_source_system",
)
CARRIED_COLUMNS = ("_row_hash", "_ingested_at", "_source_file", "_ingest_date")
GOLD_AUDIT_COLUMNS = ("_gold_loaded_at", "_gold_model_name", "_gold_run_id")

# Freshness: hours until a warning, hours until an error.
FRESHNESS_HOURS = {
    "service_requests": (25, 49),
    "permits": (25, 49),
    "inspections": (25, 49),
    "arrests": (100 * 24, 200 * 24),
}

# Extract sources: cursor column, key columns, first watermark (None = 1 January of the year).
EXTRACT_SOURCES = {
    "service_requests": ("created_date", ("unique_key",), "2020-01-01T00:00:00.000"),
    "arrests_historic": ("arrest_date", ("arrest_key",), "2006-01-01T00:00:00.000"),
    "arrests_current": ("arrest_date", ("arrest_key",), None),
    "permits": ("issuance_date", ("job__", "permit_sequence__"), "2020-01-01T00:00:00.000"),
    "inspections": (
        "inspection_date",
        ("camis", "violation_code", "inspection_type"),
        "2015-01-01T00:00:00.000",
    ),
}

# Feeds that fill each raw table.
RAW_FEEDS = {
    "complaints": ("service_requests",),
    "arrests": ("arrests_historic", "arrests_current"),
    "permits": ("permits",),
    "inspections": ("inspections",),
}

# Fixed values. Export contracts: grain keys, required columns, size ceiling.
MAX_EXPORT_BYTES = 10 * 1024 * 1024
EXPORT_KEYS = {
    "neighborhood_pulse_summary": ("zip_code", "year_month"),
    "borough_monthly_trends": ("borough", "year_month"),
    "safety_infrastructure_corr": ("zip_code", "year_month"),
    "food_compliance_overview": ("zip_code", "year_month"),
    "complaint_type_rankings": ("borough", "year_month", "complaint_type"),
}
EXPORT_REQUIRED = {
    "neighborhood_pulse_summary": (
        "zip_code",
        "year_month",
        "borough",
        "neighborhood_name",
        "neighborhood_pulse_score",
        "is_complete_month",
        "borough_avg_pulse_score",
        "city_avg_pulse_score",
        "pulse_score_prev_month",
        "pulse_score_mom_delta",
        "borough_pulse_rank",
        "borough_zip_count",
    ),
    "borough_monthly_trends": (
        "borough",
        "year_month",
        "year",
        "quarter",
        "month_name",
        "is_complete_month",
        "total_complaints",
        "total_arrests",
        "total_permits_issued",
        "total_inspections",
        "avg_pulse_score",
        "noise_complaint_count",
        "food_complaint_count",
        "construction_complaint_count",
        "felony_count",
        "misdemeanor_count",
        "critical_violation_count",
        "zip_code_count",
    ),
    "safety_infrastructure_corr": (
        "zip_code",
        "year_month",
        "total_arrests",
        "total_permits_issued",
        "arrests_per_permit",
        "felony_pct",
        "log_arrests",
        "log_permits",
    ),
    "food_compliance_overview": (
        "zip_code",
        "year_month",
        "total_inspections",
        "food_complaint_count",
        "food_complaints_per_inspection",
    ),
    "complaint_type_rankings": (
        "borough",
        "year_month",
        "complaint_type",
        "complaint_count",
        "borough_rank",
        "pct_of_borough_total",
    ),
}

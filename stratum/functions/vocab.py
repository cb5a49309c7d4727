"""Vocabularies, cut tables and thresholds.

Everything in this module is data: the operators in ``derive`` and ``clean``
turn these tables into ``CASE WHEN`` chains, so a site can pass its own
tables as arguments instead of editing code.
"""

# ---------------------------------------------------------------------------
# Labels, cuts and constants that results must match exactly.
# Each band table is ordered; the first matching row wins.  A row is
# (operator, cut, label); operator "between" takes a (low, high) pair and is
# inclusive at both ends.
# ---------------------------------------------------------------------------

VALID_TEST_NAMES = ["PH", "STERILITY", "POTENCY", "ENDOTOXIN"]
VALID_ORDER_STATUS = ["PLANNED", "IN PROGRESS", "DONE", "CLOSED", "CANCELLED"]
VALID_ORDER_PRIORITY = ["HIGH", "MEDIUM", "LOW"]
VALID_ARMS = ["TREATMENT", "PLACEBO", "CONTROL", "LOW DOSE", "HIGH DOSE", "ACTIVE COMPARATOR"]

SEX_CODES = {"M": "Male", "F": "Female"}
SEX_OTHER = "Other"

AGE_BANDS = [
    ("<", 18, "Under 18"),
    ("between", (18, 44), "18-44"),
    ("between", (45, 64), "45-64"),
    ("between", (65, 74), "65-74"),
    ("between", (75, 89), "75-89"),
    (">=", 90, "90+"),
]
AGE_ELSE = "Unknown"

HEART_RATE_BANDS = [
    ("<", 40, "Severe Bradycardia"),
    ("<", 60, "Bradycardia"),
    ("<=", 100, "Normal"),
    ("<=", 150, "Tachycardia"),
]
HEART_RATE_ELSE = "Severe Tachycardia"

TEMPERATURE_BANDS = [
    ("<", 35.0, "Hypothermia"),
    ("<=", 37.2, "Normal"),
    ("<=", 38.0, "Low Grade Fever"),
    ("<=", 40.0, "High Fever"),
]
TEMPERATURE_ELSE = "Hyperpyrexia"

RESPIRATORY_BANDS = [
    ("<", 8, "Severe Bradypnea"),
    ("<", 12, "Bradypnea"),
    ("<=", 20, "Normal"),
    ("<=", 30, "Tachypnea"),
]
RESPIRATORY_ELSE = "Severe Tachypnea"

VITALS_UNKNOWN = "Unknown"

# Blood pressure: (systolic op, systolic cut, "and"/"or", diastolic op,
# diastolic cut, label), first match wins; either reading NULL -> Unknown.
BP_RULES = [
    ("<", 70, "or", "<", 40, "Hypotensive"),
    ("<", 120, "and", "<", 80, "Normal"),
    ("<", 130, "and", "<", 80, "Elevated"),
    ("<", 140, "or", "<", 90, "HTN Stage 1"),
    (">=", 140, "or", ">=", 90, "HTN Stage 2"),
]
BP_ELSE = "HTN Crisis"

YIELD_BANDS = [
    (">=", 95, "High"),
    (">=", 80, "Normal"),
]
YIELD_ELSE = "Low"
YIELD_UNKNOWN = "Unknown"

DURATION_BANDS = [
    ("<", 60, "SHORT"),
    ("<=", 480, "MEDIUM"),
]
DURATION_ELSE = "LONG"
DURATION_ONGOING = "ONGOING"

SHIFT_BANDS = [
    ("between", (6, 13), "Morning"),
    ("between", (14, 21), "Afternoon"),
]
SHIFT_ELSE = "Night"

SLA_DAYS = {"CRITICAL": 3, "MAJOR": 15, "MINOR": 30}
SLA_DEFAULT = 30

# Risk grade of a CAPA group: (measure, operator, threshold, label).
CAPA_RISK_RULES = [
    ("critical_open_count", ">", 0, "Critical"),
    ("sla_breach_rate_pct", ">", 30, "High"),
    ("sla_breach_rate_pct", ">", 15, "Medium"),
]
CAPA_RISK_ELSE = "Low"

# Subject safety thresholds (percent): lab abnormal rate, vitals concern rate.
LAB_ABNORMAL_RATE_LIMIT = 20
VS_CONCERN_RATE_LIMIT = 30

# Lab labels that count as "normal" in gold (silver keeps NORMAL, the
# source feeds may send N).
LAB_NORMAL_LABELS = ["N", "NORMAL"]

# Fill labels for missing values.
QC_ANALYST_UNKNOWN = "UNKNOWN"
QC_RESULT_PENDING = "PENDING"
UNKNOWN = "UNKNOWN"

# Calendar gate decisions.
GATE_SKIP = "SKIP"
GATE_RUN = "RUN_MAIN"
CALENDAR_DATE_FORMATS = ["dd-MM-yyyy", "yyyy-MM-dd"]

# Holiday calendar shipped with the gate (Date in dd-MM-yyyy, Holiday Name).
HOLIDAYS_2024 = [
    ("26-01-2024", "Republic Day"),
    ("08-03-2024", "Maha Shivaratri"),
    ("25-03-2024", "Holi"),
    ("29-03-2024", "Good Friday"),
    ("11-04-2024", "Eid-ul-Fitr"),
    ("17-04-2024", "Ram Navami"),
    ("21-04-2024", "Mahavir Jayanti"),
    ("23-05-2024", "Buddha Purnima"),
    ("17-06-2024", "Bakrid (Eid-ul-Adha)"),
    ("17-07-2024", "Muharram"),
    ("15-08-2024", "Independence Day"),
    ("26-08-2024", "Janmashtami"),
    ("02-10-2024", "Gandhi Jayanti"),
    ("12-10-2024", "Dussehra"),
    ("01-11-2024", "Diwali"),
    ("15-11-2024", "Guru Nanak Jayanti"),
    ("25-12-2024", "Christmas"),
]

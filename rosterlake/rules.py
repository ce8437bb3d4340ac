"""Fixed business values, all in one place.

These numbers, names and limits define the results and have no other source.
"""

# --- fixed values: staff -------------------------------------------------
ROLES = [
    "Nurse", "Doctor", "Admin", "Surgeon",
    "Radiologist", "Pharmacist", "Physiotherapist", "Technician",
]
EXPERIENCE_LEVELS = ["Junior", "Senior", "Experienced"]
DEPARTMENTS = [
    "ICU", "ER", "General Ward", "Pediatrics",
    "Oncology", "Cardiology", "Radiology", "Pathology",
]
BASE_HOURLY_RATE = {
    "Nurse": 350, "Doctor": 800, "Admin": 250, "Surgeon": 1200,
    "Radiologist": 900, "Pharmacist": 600, "Physiotherapist": 400, "Technician": 300,
}
EXPERIENCE_MULTIPLIER = {"Junior": "1.0", "Senior": "1.4", "Experienced": "1.8"}
UNKNOWN_EXPERIENCE_MULTIPLIER = "1.0"
DEFAULT_HOURLY_RATE = 300
WORK_HOURS_PER_YEAR = 40 * 52
# upper limits, not included
SALARY_BANDS = {"Band A": 400_000, "Band B": 700_000, "Band C": 1_100_000, "Band D": 1_600_000}
TOP_SALARY_BAND = "Band E"

# --- fixed values: shifts ------------------------------------------------
SHIFT_START_HOUR = {"Day": 7, "Night": 19}
STANDARD_SHIFT_HOURS = 8
SURGE_SHIFT_HOURS = (10, 12)
NORMAL_SHIFT_HOURS = (8, 12)
# overtime hours up to and including -> pay multiplier
OVERTIME_TIERS = {0: 0.0, 2: 1.5, 4: 2.0}
TOP_OVERTIME_MULTIPLIER = 2.5
# a run of more days than this counts as consecutive working
STREAK_LIMIT_DAYS = 4
LONG_SHIFT_HOURS = 12
BACK_TO_BACK_GAP_HOURS = 24
# (month, day) of the first and of the last day, both included
SURGE_PERIODS = [
    ((1, 15), (1, 25)),
    ((3, 1), (3, 10)),
    ((5, 5), (5, 15)),
    ((7, 20), (7, 30)),
    ((9, 10), (9, 20)),
]

# --- fixed values: assignments -------------------------------------------
CASE_TYPES = ["Emergency", "Routine", "Surgery", "Consultation", "Follow-up"]
# expected shares in the order of CASE_TYPES
CASE_SHARES = {
    "ICU": [0.45, 0.20, 0.20, 0.10, 0.05],
    "ER": [0.55, 0.20, 0.10, 0.10, 0.05],
    "General Ward": [0.10, 0.55, 0.10, 0.15, 0.10],
    "Pediatrics": [0.18, 0.45, 0.07, 0.20, 0.10],
    "Oncology": [0.12, 0.35, 0.10, 0.18, 0.25],
    "Cardiology": [0.25, 0.35, 0.18, 0.12, 0.10],
    "Radiology": [0.05, 0.30, 0.10, 0.40, 0.15],
    "Pathology": [0.03, 0.32, 0.05, 0.45, 0.15],
}
DEFAULT_CASE_SHARES = [0.20, 0.40, 0.12, 0.18, 0.10]
ASSIGNMENTS_PER_SHIFT = {1: 0.65, 2: 0.25, 3: 0.10}

# --- fixed values: burnout -----------------------------------------------
SCORE_WEIGHTS = {
    "overtime_hours": 2,
    "critical_cases": 3,
    "night_flag": 5,
    "consecutive_days_flag": 4,
    "emergency_cases": 3,
}
MAX_SCORE = 100
# highest score of each label
RISK_LABELS = {"Low": 30, "Medium": 55, "High": 75}
TOP_RISK_LABEL = "Critical"
RISK_ORDER = ["Low", "Medium", "High", "Critical"]
HIGH_BURNOUT_SCORE = 76
ROLE_WEIGHT = {
    "Nurse": "1.0", "Doctor": "0.8", "Surgeon": "1.1", "Radiologist": "0.7",
    "Pharmacist": "0.6", "Physiotherapist": "0.6", "Technician": "0.7", "Admin": "0.4",
}
DEFAULT_ROLE_WEIGHT = "0.6"
DEPARTMENT_WEIGHT = {
    "ICU": "1.1", "ER": "1.1", "Oncology": "0.9", "Cardiology": "0.8",
    "General Ward": "0.6", "Pediatrics": "0.6", "Radiology": "0.4", "Pathology": "0.4",
}
DEFAULT_DEPARTMENT_WEIGHT = "0.5"
EXPERIENCE_WEIGHT = {"Junior": "0.9", "Senior": "0.7", "Experienced": "0.6"}
DEFAULT_EXPERIENCE_WEIGHT = "0.7"
SUSCEPTIBILITY_SHARES = {"role": "0.4", "department": "0.4", "experience": "0.2"}
LOAD_WEIGHTS = {
    "overtime_hours": "0.20",
    "night_flag": "0.70",
    "surge_period_flag": "0.80",
    "consecutive_days_flag": "0.90",
}
CHRONIC_BASE = "0.01"
CHRONIC_SUSCEPTIBILITY = "0.06"
CHRONIC_LOAD = "0.03"
CHRONIC_LIMIT = "0.45"
CHRONIC_UPLIFT = (8, 22)
DRAW_SEED = 42

# --- fixed values: leave -------------------------------------------------
LEAVE_TYPES = ["Sick", "Vacation", "Personal", "Maternity/Paternity", "Study", "Bereavement"]
MAX_LEAVE_MOVES = 120
LONG_LEAVE_DAYS = 10

# --- fixed values: dimensions and ids ------------------------------------
RISK_CATEGORY = {
    "ICU": "Very High", "ER": "Very High", "Oncology": "High", "Cardiology": "High",
    "General Ward": "Medium", "Pediatrics": "Medium", "Radiology": "Low", "Pathology": "Low",
}
CRITICAL_CATEGORIES = ["Very High", "High"]
# id, name, start hour, burnout weight, description (the texts have no dash between the hours)
SHIFT_TYPES = [
    (1, "Day", 7, 1.0, "Standard Daytime Shift (07:0019:00)"),
    (2, "Night", 19, 1.5, "Night / On-call Shift   (19:0007:00)"),
]
# prefix -> digits
ID_FORMATS = {
    "STF_": 7, "TS_": 8, "ASN_": 8, "LV_": 8, "DEPT_": 2,
    "BF_": 8, "OT_": 8, "LF_": 8, "PAT_": 6,
}

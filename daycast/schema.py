"""Column names, labels and constants shared by the whole library.

Column names are parameters everywhere; the defaults below describe the visit
data the library was built for (French headers) and the daily series it derives.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# They must equal the source data's headers, labels and the
# forecasting rules' constants for results to line up.
# ---------------------------------------------------------------------------
VISIT_COLUMNS = {
    "patient": "Patient",
    "arrival": "Date d'arrivée",
    "departure": "Date de départ",
    "waiting": "Durée d'attente",
    "occupancy": "Taux d'occupation (lit)",
    "admission_type": "Type d'admissions",
    "icu": "Soins intensifs",
    "bed": "Lit",
}
EMERGENCY_LABEL = "Urgences"
YES_LABEL = "Oui"
# Tried after ISO text, in order (the visit files' day-first habit).
DATE_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy", "dd-MM-yyyy")
DATE_NAME_PATTERNS = ("date", "arrivée", "départ")

SEASON_MONTHS = {
    "Hiver": (12, 1, 2),
    "Printemps": (3, 4, 5),
    "Été": (6, 7, 8),
    "Automne": (9, 10, 11),
}
SUMMER_MONTHS = (6, 7, 8)
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
FALL_MONTHS = (9, 10, 11)

ADMISSION_ALERT_MESSAGE = "⚠️ Pic d'admissions prévu: %.1f admissions"
OCCUPANCY_ALERT_MESSAGE = "⚠️ Taux d'occupation critique prévu: %.1f%%"
OCCUPANCY_THRESHOLD = 90.0
IQR_FACTOR = 1.5
LAGS = (1, 3, 7)
MA_WINDOW = 7

# Defaults for features a forecast step does not produce.
DEFAULT_CALENDAR_VALUE = 1
DEFAULT_FLAG_VALUE = 0
DEFAULT_OCCUPANCY_VALUE = 75.0
DEFAULT_OTHER_VALUE = 80.0
DEFAULT_HISTORY_OCCUPANCY = 75.0
DEFAULT_HISTORY_ADMISSIONS = 50.0

# ---------------------------------------------------------------------------
# Names of the daily series produced by the library.
# ---------------------------------------------------------------------------
DATE = "date"
ADMISSIONS = "totalAdmissions"
OCCUPANCY = "avgOccupancyRate"
TARGETS = (ADMISSIONS, OCCUPANCY)

CALENDAR_COLUMNS = ("month", "dayOfMonth", "dayOfWeek", "year")
FLAG_COLUMNS = ("isWeekend", "isSummer", "isWinter", "isSpring", "isFall")
COUNT_COLUMNS = (ADMISSIONS, "isEmergency", "needsICU")
FFILL_COLUMNS = (OCCUPANCY, "waitingHours", "stayDuration")
SAME_DAY_COLUMNS = ("isEmergency", "needsICU", "waitingHours", "stayDuration")

# The target a lag or moving average is made of.
LAG_TARGETS = {f"{name}{kind}": target for name, target in (("admissions", ADMISSIONS), ("occupancy", OCCUPANCY))
               for kind in [*(f"Lag{n}" for n in LAGS), "MA7", "MA7Prev"]}
ADMISSION_LAGS = tuple(f"admissionsLag{n}" for n in LAGS)
OCCUPANCY_LAGS = tuple(f"occupancyLag{n}" for n in LAGS)
MA_COLUMNS = ("admissionsMA7", "occupancyMA7")
MA_PREV_COLUMNS = ("admissionsMA7Prev", "occupancyMA7Prev")

NUMERIC_COLUMNS = (
    COUNT_COLUMNS + FFILL_COLUMNS + CALENDAR_COLUMNS + FLAG_COLUMNS
    + ADMISSION_LAGS + OCCUPANCY_LAGS + MA_COLUMNS + MA_PREV_COLUMNS
)

# Model inputs by default: calendar, flags, lags and the past-only moving
# averages. Same-day measures and the current-day moving average are kept in
# the table but left out, since a forecast cannot know them.
DEFAULT_FEATURES = (
    CALENDAR_COLUMNS
    + FLAG_COLUMNS
    + ADMISSION_LAGS
    + OCCUPANCY_LAGS
    + MA_PREV_COLUMNS
)

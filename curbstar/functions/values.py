"""Values that fix the results. They are data, not tuning: changing one changes the star."""

# --- Fixed values -------------------------------------------------------------------------

# Defaults for what is missing or not in a lookup.
UNKNOWN = "Unknown"
OTHER_VIOLATION_CODE = 99
MISSING_PRECINCT = -1

# Codes that stand for "missing" in the raw file.
ZERO_CODE = 0
ZERO_DATE = "0"

# Oldest vehicle model year, and how far ahead of the current year models are sold.
OLDEST_MODEL_YEAR = 1884
MODEL_YEARS_AHEAD = 2

# Raw time of day: HHMM and a letter, matched without regard to case.
RAW_TIME_PATTERN = r"^((2[0-3])|[0-1][0-9])[0-5][0-9][AP]$"
# Four digits outside this range can only be 24-hour notation.
FIRST_12_HOUR_TIME = 100
LAST_12_HOUR_TIME = 1259
# Letters stripped from both ends before a 24-hour parse.
MERIDIEM_LETTERS = "AaPp"

# First-observed dates: written with commas, eight digits without them.
COMMA_DATE_PATTERN = r"^\d{2},\d{3},\d{3}$"
EIGHT_DIGITS_PATTERN = r"^[0-9]{8}$"

# Date layouts of the raw file: issue date, expiration date, and ISO.
ISSUE_DATE_FORMAT = "MM/dd/yyyy"
COMPACT_DATE_FORMAT = "yyyyMMdd"
ISO_DATE_FORMAT = "yyyy-MM-dd"
# Further layouts that a loader detects by itself. Of two readings the month comes first.
FURTHER_DATE_FORMATS = (
    "M/d/yyyy",
    "MM/dd/yyyy hh:mm:ss a",
    "MM-dd-yyyy",
    "yyyy/MM/dd",
    "dd-MMM-yyyy",
)

# Side of the street.
FRONT_OR_OPPOSITE = {"I": "InFront", "F": "InFront", "O": "Opposite"}

# Gate on raw data, in percent of rows that must not be null.
MIN_PLATE_PERCENTAGE = 85
MIN_ISSUE_DATE_PERCENTAGE = 100

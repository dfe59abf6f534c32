"""Values that are part of the data contract and therefore cannot be derived.

Everything in this file is a fixed value: codes, tokens, sentinels and formats
written by the devices and forms that produce the raw files.
"""

# Device status codes (code, label, category, is failure, needs maintenance).
STATUS_CODES = [
    (0, "OK / Standby", "OK", False, False),
    (6, "Producing", "Running", False, False),
    (14, "Error", "Error", True, True),
]
FAILURE_STATUS_CODE = 14

# The member that stands for a status code nobody documented.
UNKNOWN_STATUS = (99, "Unknown", "Unknown", False, False)
UNKNOWN_STATUS_KEY = 99

# Attributes given to a unit that appears for the first time.
NEW_UNIT_RATED_KWP = "6.0000"
NEW_UNIT_STRINGS = 2

# Measure names inside one repeated column group of the device log.
DEVICE_LOG_GROUP = ["inv", "pac", "daysum", "status", "error", "pdc1", "pdc2", "udc1", "udc2", "temp", "uac"]
DEVICE_LOG_UNITS = 5

# Forecast codes (code, name, category, unit, drives production).
FORECAST_MEASURES = [
    ("PRED_GLOB_ctrl", "Horizontal global irradiance", "Solar", "Watt/m2", True),
    ("PRED_T_2M_ctrl", "Air temperature at 2 m", "Temperature", "°C", False),
    ("PRED_RELHUM_2M_ctrl", "Relative humidity at 2 m", "Humidity", "Percent", False),
    ("PRED_TOT_PREC_ctrl", "Total precipitation", "Precipitation", "Kg/m2", False),
]

# Feature column for each forecast code.
FORECAST_FEATURES = {
    "PRED_GLOB_ctrl": "irradiance_wm2",
    "PRED_T_2M_ctrl": "temp_c",
    "PRED_RELHUM_2M_ctrl": "humidity_pct",
    "PRED_TOT_PREC_ctrl": "precipitation_kgm2",
}

# Fixed values: "no data" markers of the forecast feed.
FORECAST_SENTINELS = [99999.0, -99999.0]

# Month tokens of the booking export and their numbers.
FRENCH_MONTHS = {
    "janv.": 1,
    "févr.": 2,
    "mars": 3,
    "avr.": 4,
    "mai": 5,
    "juin": 6,
    "juil.": 7,
    "août": 8,
    "sept.": 9,
    "oct.": 10,
    "nov.": 11,
    "déc.": 12,
}

# Raw text patterns of the sensor exports.
SENSOR_DATE_PATTERN = r"\d{2}\.\d{2}\.\d{2,4}"
ISO_DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
SENSOR_TIME_PATTERN = r"\d{2}:\d{2}(?::\d{2})?"
NUMBER_PATTERN = r"-?\d+\.?\d*"
PREDICTION_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Target folder by a token in the file name, first match wins.
FILE_ROUTES = [("cons", "consumption"), ("temp", "temperature"), ("humi", "humidity")]
OTHER_ROUTE = "others"

# Booking export headers that are repeated, by column position.
BOOKING_REPEATED_HEADERS = {
    3: "Heure_Debut",
    4: "Heure_Fin",
    11: "Date_Recurrence_Debut",
    12: "Date_Recurrence_Fin",
}

# Price and bands used by the reports.
DEFAULT_PRICE_PER_KWH = "0.1500"
BOOKABLE_MINUTES_PER_DAY = 720
GREEN_FROM = 85
ORANGE_FROM = 75

# Boosted-tree settings of the two forecasts.
GBT_TREES = 100
GBT_LEARNING_RATE = 0.1
GBT_DEPTH = 5

# Description of a measure type that nobody has described yet.
MEASURE_DESCRIPTION = "New code found in the data."

# Country of a weather site whose metadata names none.
DEFAULT_COUNTRY = "CH"

# Name Spark and Hive give the partition of NULL keys.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

"""Fixed values.

These values must equal the rules the pipeline reproduces (tax rate, band
limits, flag words, patterns, thresholds, labels).  They are kept together
here, in natural order, and every operator reads them from this module.
"""

# --- fixed values: business rules -------------------------------------------
VAT_RATE = 1.20
DAYS_PER_YEAR = 365.25
MIN_AGE = 18
MAX_AGE = 120
# age band: upper bound (exclusive) -> label; anything else (incl. null age)
AGE_BANDS = [(26, "18-25"), (36, "26-35"), (51, "36-50"), (66, "51-65")]
AGE_BAND_OTHER = "65+"
# loyalty: tenure days at least -> level; anything else (incl. null tenure)
LOYALTY_LEVELS = [(365 * 3, "GOLD"), (365, "SILVER")]
LOYALTY_OTHER = "BRONZE"
# active flag words (compared lower-cased); anything else -> true
TRUE_WORDS = ["true", "1", "oui", "yes"]
FALSE_WORDS = ["false", "0", "non", "no"]
EMAIL_PATTERN = r"^[\w.+-]+@[\w-]+\.[a-z]{2,}$"
PHONE_DROP_PATTERN = r"[^\d+]"
# null defaults
PRODUCT_DEFAULT = "INCONNU"
CLIENT_DEFAULT = "UNKNOWN"
SEGMENT_DEFAULT = "STANDARD"
REGION_DEFAULT = "INCONNU"
ETL_VERSION = "1.0"
PII_COLUMNS = ["email", "phone", "last_name", "first_name", "birth_date"]

# --- fixed values: data quality -----------------------------------------------
DIM_COMPLETENESS = "Complétude"
DIM_UNIQUENESS = "Unicité"
DIM_VALIDITY = "Validité"
DIM_TIMELINESS = "Actualité"
COMPLETENESS_PASS = 95.0
VALIDITY_PASS = 98.0
TIMELINESS_MAX_AGE_DAYS = 1
TIMELINESS_LATE_SCORE = 50.0
VALIDITY_CHECK_LABEL = "montants valides et positifs"
GLOBAL_CRITICAL_BELOW = 70.0
GLOBAL_WARNING_BELOW = 85.0
RECOMMENDATION_CRITICAL = "❌ CRÍTICO - Investir na qualidade"
RECOMMENDATION_WARNING = "⚠️  A MELHORAR"
RECOMMENDATION_OK = "✅ BOM - Pronto"
RECOMMENDATION_NO_DATA = "❌ NO DATA"

# --- fixed values: alerts -------------------------------------------------------
SEVERITY_COLOURS = {"CRITICAL": "#FF0000", "WARNING": "#FFA500", "INFO": "#0000FF"}
SEVERITY_COLOUR_OTHER = "#808080"
STATUS_COLOUR_FAIL = "#FF0000"
STATUS_COLOUR_OTHER = "#FFA500"
ALERT_MESSAGE_MAX = 500
DEFAULT_SEVERITY = "WARNING"

# --- fixed values: maintenance --------------------------------------------------
RETENTION_DAYS = 30
SALES_LAYOUT = {"partition_cols": ["year", "month", "day"], "default_files": 20, "target_file_mb": 256}
CUSTOMERS_LAYOUT = {"partition_cols": ["region", "segment"], "default_files": 10, "target_file_mb": 128}

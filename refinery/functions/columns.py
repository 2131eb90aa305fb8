"""Column expressions (all JVM built-ins, codegen-friendly; no Python UDFs).

Each helper takes a column name or ``Column`` and returns a ``Column``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from refinery.functions import fixed

# plain decimal number with optional sign/exponent; rejects Java-only forms
# such as '1.0d', '0x1p3' or '1_000' that a bare cast would accept.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
BLANK_PATTERN = r"(?U)^\s*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_lit(value) -> Column:
    """A DATE literal from a ``date`` or ``'yyyy-MM-dd'`` string."""
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.lit(value).cast("date")


# --- text ----------------------------------------------------------------------

def upper_trim(col) -> Column:
    return F.trim(F.upper(_c(col)))


def lower_trim(col) -> Column:
    return F.trim(F.lower(_c(col)))


def initcap_trim(col) -> Column:
    return F.trim(F.initcap(_c(col)))


def is_blank(col) -> Column:
    """Null, empty, or white space only (Unicode white space)."""
    c = _c(col)
    return c.isNull() | c.rlike(BLANK_PATTERN)


def valid_email(col, pattern: str = fixed.EMAIL_PATTERN) -> Column:
    """The value when it matches the e-mail pattern, else null."""
    c = _c(col)
    return F.when(c.rlike(pattern), c)


def clean_phone(col, pattern: str = fixed.PHONE_DROP_PATTERN) -> Column:
    """Keep digits and '+' only."""
    return F.regexp_replace(_c(col), pattern, "")


def parse_flag(col, default: bool | None = True) -> Column:
    """Yes/no words -> boolean; anything else (null included) -> ``default``."""
    low = F.lower(_c(col))
    return (F.when(low.isin(*fixed.TRUE_WORDS), F.lit(True))
             .when(low.isin(*fixed.FALSE_WORDS), F.lit(False))
             .otherwise(F.lit(default).cast("boolean")))


def truncate(col, n: int = fixed.ALERT_MESSAGE_MAX) -> Column:
    return F.substring(_c(col), 1, n)


def lookup(col, mapping: dict, default) -> Column:
    """Literal map lookup with a default for unknown keys."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[_c(col)], F.lit(default))


# --- numbers ---------------------------------------------------------------------

def to_double(col) -> Column:
    """Guarded string -> double: null for anything that is not a plain number."""
    c = _c(col)
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def to_int(col) -> Column:
    c = _c(col)
    return F.when(c.cast("string").rlike(NUMBER_PATTERN), c.try_cast("double").try_cast("int"))


def is_valid_amount(col) -> Column:
    """Parses as a number, is not NaN and is >= 0 (missing value -> false)."""
    x = to_double(col)
    return F.coalesce(x.isNotNull() & ~F.isnan(x) & (x >= 0), F.lit(False))


def money_sum(col) -> Column:
    """Order-independent sum of 2-decimal amounts (exact decimal, then double)."""
    return F.sum(_c(col).cast("decimal(18,2)")).cast("double")


# --- dates ------------------------------------------------------------------------

def parse_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_c(col), fmt)


def age_years(birth, as_of) -> Column:
    """Whole years between birth and ``as_of``: floor(days / 365.25)."""
    return F.floor(F.datediff(date_lit(as_of), _c(birth)) / fixed.DAYS_PER_YEAR).cast("int")


def tenure_days(since, as_of) -> Column:
    return F.datediff(date_lit(as_of), _c(since)).cast("int")


def year_str(col) -> Column:
    return F.year(_c(col)).cast("string")


def month_str(col) -> Column:
    return F.lpad(F.month(_c(col)).cast("string"), 2, "0")


def day_str(col) -> Column:
    return F.lpad(F.dayofmonth(_c(col)).cast("string"), 2, "0")


def ntz_date_text(col) -> Column:
    """``yyyy-MM-dd`` of a date or a zone-less timestamp, independent of the session time zone."""
    return F.to_date(_c(col)).cast("string")


def ntz_iso_text(col) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of a zone-less timestamp, independent of the session time zone."""
    return F.regexp_replace(F.substring(_c(col).cast("timestamp_ntz").cast("string"), 1, 19), " ", "T")


def timestamp_str(ts) -> str:
    """Clock value as the ISO text written to metadata columns."""
    if isinstance(ts, str):
        return ts
    return ts.isoformat()


# --- business rules -----------------------------------------------------------------

def age_band(age) -> Column:
    a = _c(age)
    expr = None
    for bound, label in fixed.AGE_BANDS:
        expr = F.when(a < bound, F.lit(label)) if expr is None else expr.when(a < bound, F.lit(label))
    return expr.otherwise(F.lit(fixed.AGE_BAND_OTHER))


def loyalty(tenure) -> Column:
    t = _c(tenure)
    expr = None
    for at_least, label in fixed.LOYALTY_LEVELS:
        expr = F.when(t >= at_least, F.lit(label)) if expr is None else expr.when(t >= at_least, F.lit(label))
    return expr.otherwise(F.lit(fixed.LOYALTY_OTHER))


def with_tax(amount, rate: float = fixed.VAT_RATE) -> Column:
    return F.round(_c(amount) * F.lit(float(rate)), 2)


def line_total(amount, quantity) -> Column:
    return F.round(_c(amount) * _c(quantity), 2)

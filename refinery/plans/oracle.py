"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is one ANSI/DuckDB SQL statement over the driver's tables
(pre-registered views).  The dirty samples are rebuilt here with the same
deterministic rules as ``refinery.plans.samples``.  Spark's ``round`` on a
double rounds the shortest decimal text HALF_UP; ``sround`` reproduces that
in DuckDB through a decimal cast.
"""

from __future__ import annotations

from types import SimpleNamespace

from refinery.plans.queries import AS_OF, CLOCK, SOURCE_DATE, TIMELINESS_AS_OF

ORACLE: dict[str, str] = {}

#: the rules' values, written out here once more so that a wrong one in the package can't pass on both sides
fixed = SimpleNamespace(
    VAT_RATE=1.2, DAYS_PER_YEAR=365.25, MIN_AGE=18, MAX_AGE=120,
    AGE_BANDS=[(26, "18-25"), (36, "26-35"), (51, "36-50"), (66, "51-65")], AGE_BAND_OTHER="65+",
    LOYALTY_LEVELS=[(1095, "GOLD"), (365, "SILVER")], LOYALTY_OTHER="BRONZE",
    TRUE_WORDS=["true", "1", "oui", "yes"], FALSE_WORDS=["false", "0", "non", "no"],
    EMAIL_PATTERN=r"^[\w.+-]+@[\w-]+\.[a-z]{2,}$", PHONE_DROP_PATTERN=r"[^\d+]",
    PRODUCT_DEFAULT="INCONNU", CLIENT_DEFAULT="UNKNOWN", SEGMENT_DEFAULT="STANDARD", REGION_DEFAULT="INCONNU", ETL_VERSION="1.0",
    DIM_COMPLETENESS="Complétude", DIM_UNIQUENESS="Unicité", DIM_VALIDITY="Validité", DIM_TIMELINESS="Actualité",
    COMPLETENESS_PASS=95.0, VALIDITY_PASS=98.0, TIMELINESS_MAX_AGE_DAYS=1, TIMELINESS_LATE_SCORE=50.0,
    VALIDITY_CHECK_LABEL="montants valides et positifs", GLOBAL_CRITICAL_BELOW=70.0, GLOBAL_WARNING_BELOW=85.0,
    RECOMMENDATION_CRITICAL="❌ CRÍTICO - Investir na qualidade", RECOMMENDATION_WARNING="⚠️  A MELHORAR",
    RECOMMENDATION_OK="✅ BOM - Pronto", RECOMMENDATION_NO_DATA="❌ NO DATA",
    SEVERITY_COLOURS={"CRITICAL": "#FF0000", "WARNING": "#FFA500", "INFO": "#0000FF"}, SEVERITY_COLOUR_OTHER="#808080",
    STATUS_COLOUR_FAIL="#FF0000", STATUS_COLOUR_OTHER="#FFA500", ALERT_MESSAGE_MAX=500)
RE_NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
RE_BLANK = r"^\s*$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sround(expr: str, n: int = 2) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def dedup_sql(src: str, keys: str, order_cols: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in order_cols)
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1")


def to_double(col: str) -> str:
    return f"CASE WHEN regexp_matches({col}, {q(RE_NUM)}) THEN TRY_CAST({col} AS DOUBLE) END"


def _sale(amount: str, seq: int) -> str:
    k = "o_orderkey"
    return f"""SELECT CASE WHEN {k} % 97 = 0 THEN NULL WHEN {k} % 89 = 0 THEN '' ELSE CAST({k} AS VARCHAR) END AS id,
  CASE WHEN {k} % 67 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sale_date,
  {amount} AS amount,
  CASE WHEN {k} % 71 = 0 THEN NULL ELSE '  ' || lower(o_orderpriority) || ' ' END AS product,
  CASE WHEN {k} % 29 = 0 THEN NULL WHEN {k} % 3 = 0 THEN ' 7 ' ELSE ' ' || CAST(o_custkey AS VARCHAR) || ' ' END AS client_id,
  {seq} AS seq"""


RAW_SALES = (_sale("CASE WHEN o_orderkey % 53 = 0 THEN 'abc' WHEN o_orderkey % 59 = 0 THEN '-5' "
                   "WHEN o_orderkey % 61 = 0 THEN NULL ELSE printf('%.2f', o_totalprice) END", 0)
             + " FROM orders UNION ALL "
             + _sale("printf('%.2f', o_totalprice + 1)", 1) + " FROM orders WHERE o_orderkey % 41 = 0")

SALES_ORDER = ["seq", "sale_date", "amount", "product", "client_id"]
SALES_DEDUP = dedup_sql("raw_sales", "id", SALES_ORDER)

CLEAN_SALES = f"""SELECT id, CAST(try_strptime(sale_date, '%Y-%m-%d') AS DATE) AS sale_date, amt AS amount,
  coalesce(trim(upper(product)), {q(fixed.PRODUCT_DEFAULT)}) AS product,
  coalesce(trim(client_id), {q(fixed.CLIENT_DEFAULT)}) AS client_id, seq, 1 AS quantity
FROM (SELECT *, {to_double('amount')} AS amt FROM sales_dedup WHERE id IS NOT NULL AND id <> '')
WHERE amt IS NOT NULL AND NOT isnan(amt) AND amt > 0"""

_CUSTOMERS = """SELECT CAST(c_custkey AS VARCHAR) AS id,
  {lead} || lower(c_name) || ' ' AS last_name,
  ' ' || CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END || ' ' AS first_name,
  CASE WHEN c_custkey % 11 = 0 THEN 'bad@x.co.uk' ELSE ' User' || CAST(c_custkey AS VARCHAR) || '@Mail.com ' END AS email,
  '+33 (6) ' || CAST(c_custkey AS VARCHAR) AS phone,
  CASE WHEN c_custkey % 17 = 0 THEN NULL
       ELSE strftime(DATE '1870-01-01' + CAST((c_custkey * 7919) % 52000 AS INTEGER), '%Y-%m-%d') END AS birth_date,
  strftime(DATE '1995-01-01' + CAST((c_custkey * 31) % 2500 AS INTEGER), '%Y-%m-%d') AS signup_date,
  {segment} AS segment,
  lower(r_name) || ' ' AS region,
  CASE c_custkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN 'oui' WHEN 3 THEN 'no' WHEN 4 THEN '0'
       ELSE NULL END AS active,
  ' ' || lpad(CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR), 5, '0') || ' ' AS postcode
FROM customer LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
  ON c_nationkey = n_nationkey {where}"""

RAW_CUSTOMERS = (
    _CUSTOMERS.format(lead="' '", segment="CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE ' ' || lower(c_mktsegment) END", where="")
    + " UNION ALL " + _CUSTOMERS.format(lead="' z'", segment="' vip'", where="WHERE c_custkey % 23 = 0"))

CUSTOMERS_ORDER = ["last_name", "first_name", "email", "phone", "birth_date", "signup_date", "segment",
                   "region", "active", "postcode"]


def _flag(col: str) -> str:
    t = ", ".join(q(w) for w in fixed.TRUE_WORDS)
    f = ", ".join(q(w) for w in fixed.FALSE_WORDS)
    return f"CASE WHEN lower({col}) IN ({t}) THEN true WHEN lower({col}) IN ({f}) THEN false ELSE true END"


CLEAN_CUSTOMERS = f"""SELECT id, trim(upper(last_name)) AS last_name,
  upper(substr(trim(first_name), 1, 1)) || lower(substr(trim(first_name), 2)) AS first_name,
  CASE WHEN regexp_matches(trim(lower(email)), {q(fixed.EMAIL_PATTERN)}) THEN trim(lower(email)) END AS email,
  regexp_replace(phone, {q(fixed.PHONE_DROP_PATTERN)}, '', 'g') AS phone,
  bd AS birth_date, sd AS signup_date,
  coalesce(trim(upper(segment)), {q(fixed.SEGMENT_DEFAULT)}) AS segment,
  coalesce(trim(upper(region)), {q(fixed.REGION_DEFAULT)}) AS region,
  {_flag('active')} AS active, trim(postcode) AS postcode, age
FROM (SELECT *, CAST(floor(date_diff('day', bd, DATE '{AS_OF}') / {fixed.DAYS_PER_YEAR}) AS INTEGER) AS age
      FROM (SELECT *, CAST(try_strptime(birth_date, '%Y-%m-%d') AS DATE) AS bd,
                   CAST(try_strptime(signup_date, '%Y-%m-%d') AS DATE) AS sd
            FROM ({dedup_sql('raw_customers', 'id', CUSTOMERS_ORDER)}) d
            WHERE id IS NOT NULL AND id <> '') p) a
WHERE bd IS NULL OR (age BETWEEN {fixed.MIN_AGE} AND {fixed.MAX_AGE})"""


def _band(col: str) -> str:
    arms = " ".join(f"WHEN {col} < {b} THEN {q(lbl)}" for b, lbl in fixed.AGE_BANDS)
    return f"CASE {arms} ELSE {q(fixed.AGE_BAND_OTHER)} END"


def _loyalty(col: str) -> str:
    arms = " ".join(f"WHEN {col} >= {b} THEN {q(lbl)}" for b, lbl in fixed.LOYALTY_LEVELS)
    return f"CASE {arms} ELSE {q(fixed.LOYALTY_OTHER)} END"


CURATED_CUSTOMERS = f"""SELECT *, {_band('age')} AS age_band, {_loyalty('tenure_days')} AS loyalty,
  CAST(year(signup_date) AS VARCHAR) AS signup_year, lpad(CAST(month(signup_date) AS VARCHAR), 2, '0') AS signup_month
FROM (SELECT *, CAST(date_diff('day', signup_date, DATE '{AS_OF}') AS INTEGER) AS tenure_days FROM clean_customers) t"""

TTC = sround(f"amount * {fixed.VAT_RATE}")
ENRICHED_SALES = f"""SELECT *, {sround(f'amount_ttc * quantity')} AS total_ttc FROM (
  SELECT s.*, c.segment, c.region, {TTC} AS amount_ttc, {sround('amount * quantity')} AS total,
    CAST(year(sale_date) AS VARCHAR) AS year, lpad(CAST(month(sale_date) AS VARCHAR), 2, '0') AS month,
    lpad(CAST(day(sale_date) AS VARCHAR), 2, '0') AS day
  FROM clean_sales s LEFT JOIN (SELECT id, segment, region FROM clean_customers) c ON s.client_id = c.id) e"""

WITH_SALES = f"WITH raw_sales AS ({RAW_SALES}), sales_dedup AS ({SALES_DEDUP}), clean_sales AS ({CLEAN_SALES})"
WITH_CUSTOMERS = (f"WITH raw_customers AS ({RAW_CUSTOMERS}), clean_customers AS ({CLEAN_CUSTOMERS}), "
                  f"curated_customers AS ({CURATED_CUSTOMERS})")
WITH_BOTH = (WITH_SALES + f", raw_customers AS ({RAW_CUSTOMERS}), clean_customers AS ({CLEAN_CUSTOMERS}), "
             f"enriched_sales AS ({ENRICHED_SALES})")


def money_sum(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql


add("sales_dedup", WITH_SALES + " SELECT * FROM sales_dedup WHERE id IS NOT NULL AND id <> ''")
add("sales_dedup_stats", WITH_SALES + """ SELECT rows_before, rows_after, rows_before - rows_after AS duplicates_removed
FROM (SELECT count(*) AS rows_before,
             count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS rows_after FROM raw_sales) t""")
add("lineitem_dedup", "SELECT * FROM (" + dedup_sql(
    "(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem)",
    "l_orderkey, l_linenumber", ["l_quantity", "l_extendedprice"]) + ") t")
add("sales_latest", WITH_SALES + " SELECT id, amount FROM sales_dedup WHERE id IS NOT NULL AND id <> ''")
add("user_last_event", "SELECT user_id, event_id, event_type, props FROM ("
    + dedup_sql("events", "user_id", ["event_id"]) + ") t")
add("sales_positive", WITH_SALES + " SELECT id, amount FROM clean_sales")
add("sales_defaults", WITH_SALES + " SELECT id, product, client_id, quantity FROM clean_sales")
add("sales_amounts", f"""SELECT l_orderkey, l_linenumber, amount, quantity, amount_ttc, total,
  {sround('amount_ttc * quantity')} AS total_ttc
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS amount, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
             {sround(f'l_extendedprice * {fixed.VAT_RATE}')} AS amount_ttc,
             {sround('l_extendedprice * CAST(trunc(l_quantity) AS INTEGER)')} AS total FROM lineitem) t""")
add("sales_date_parts", WITH_SALES + """ SELECT id, strftime(sale_date, '%Y-%m-%d') AS sale_date,
  CAST(year(sale_date) AS VARCHAR) AS year, lpad(CAST(month(sale_date) AS VARCHAR), 2, '0') AS month,
  lpad(CAST(day(sale_date) AS VARCHAR), 2, '0') AS day FROM clean_sales""")
add("sales_enriched", WITH_BOTH + """ SELECT id, client_id, segment, region, amount, amount_ttc, total, total_ttc
FROM enriched_sales""")
add("sales_merge_join", WITH_BOTH + " SELECT id, client_id, segment, region, total_ttc FROM enriched_sales")
add("hot_clients", f"""WITH c AS (SELECT coalesce(trim(client_id), {q(fixed.CLIENT_DEFAULT)}) AS client_id FROM ({RAW_SALES}) t)
SELECT client_id, count(*) AS rows, (SELECT count(*) FROM c) AS total FROM c GROUP BY client_id
HAVING count(*) > 0.002 * (SELECT count(*) FROM c)""")
add("hot_event_users", """SELECT event_type, user_id, rows, CAST(total AS BIGINT) AS total
FROM (SELECT event_type, user_id, count(*) AS rows, sum(count(*)) OVER (PARTITION BY event_type) AS total
      FROM events WHERE user_id IS NOT NULL GROUP BY event_type, user_id) t WHERE rows > 0.01 * total""")
add("sales_missing_dim", WITH_SALES + f""" SELECT id, client_id, CAST(NULL AS VARCHAR) AS segment,
  CAST(NULL AS VARCHAR) AS region, {sround(f"{TTC} * quantity")} AS total_ttc FROM clean_sales""")
add("revenue_by_region", WITH_BOTH + f""" SELECT region, {sround(money_sum('total_ttc'))} AS revenue
FROM enriched_sales GROUP BY region""")
add("sales_by_month", WITH_BOTH + " SELECT year, month, count(*) AS cnt FROM enriched_sales GROUP BY year, month")
add("top_regions", WITH_BOTH + f""" SELECT region, segment, {sround(money_sum('total_ttc'))} AS revenue
FROM enriched_sales GROUP BY region, segment
ORDER BY revenue DESC, region ASC NULLS FIRST, segment ASC NULLS FIRST LIMIT 20""")
add("sales_stamped", WITH_BOTH + f""" SELECT id, {q(CLOCK)} AS _last_transformed, {q(fixed.ETL_VERSION)} AS _etl_version,
  {q(SOURCE_DATE)} AS _source_date FROM enriched_sales""")
add("sales_totals_sql", WITH_BOTH + """ SELECT count(*) AS total_rows, count(*) FILTER (WHERE id IS NULL) AS null_keys,
  count(*) FILTER (WHERE region IS NULL) AS rows_without_region FROM enriched_sales""")
add("stage_totals", WITH_SALES + """ SELECT (SELECT count(*) FROM raw_sales) AS rows_read,
  (SELECT count(*) FROM raw_sales WHERE id IS NULL) AS null_keys,
  (SELECT count(*) FROM sales_dedup) AS rows_after_dedup,
  (SELECT count(*) FROM clean_sales) AS rows_after_cleaning""")

add("customers_text", WITH_CUSTOMERS + """ SELECT id, last_name, first_name, region, segment, postcode
FROM clean_customers""")
add("customers_email", WITH_CUSTOMERS + " SELECT id, email FROM clean_customers")
add("customers_phone", WITH_CUSTOMERS + " SELECT id, phone FROM clean_customers")
add("customers_flag", WITH_CUSTOMERS + " SELECT id, active FROM clean_customers")
add("customers_age", WITH_CUSTOMERS + """ SELECT id, strftime(birth_date, '%Y-%m-%d') AS birth_date, age, age_band
FROM curated_customers""")
add("customers_loyalty", WITH_CUSTOMERS + """ SELECT id, strftime(signup_date, '%Y-%m-%d') AS signup_date,
  tenure_days, loyalty, signup_year, signup_month FROM curated_customers""")
add("customers_masked", WITH_CUSTOMERS + """ SELECT id, sha256(email) AS email, sha256(phone) AS phone,
  sha256(last_name) AS last_name, sha256(first_name) AS first_name,
  sha256(CAST(birth_date AS VARCHAR)) AS birth_date, age FROM curated_customers""")
add("customers_by_segment", WITH_CUSTOMERS + " SELECT segment, count(*) AS cnt FROM curated_customers GROUP BY segment")
add("customers_by_loyalty", WITH_CUSTOMERS + " SELECT loyalty, count(*) AS cnt FROM curated_customers GROUP BY loyalty")
add("customers_by_age_band", WITH_CUSTOMERS + " SELECT age_band, count(*) AS cnt FROM curated_customers GROUP BY age_band")
add("customers_by_active", WITH_CUSTOMERS + " SELECT active, count(*) AS cnt FROM curated_customers GROUP BY active")

SALES_COLS = ["id", "sale_date", "amount", "product", "client_id", "seq"]
CUSTOMER_COLS = ["id", "last_name", "first_name", "email", "phone", "birth_date", "signup_date", "segment",
                 "region", "active", "postcode"]


def _nonblank(col: str) -> str:
    c = f"CAST({col} AS VARCHAR)"
    return f"count(*) FILTER (WHERE NOT ({c} IS NULL OR regexp_matches({c}, {q(RE_BLANK)})))"


def _completeness_rows(entity: str, src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"SELECT {q(entity)} AS entity, {q(c)} AS column_name, count(*) AS rows, "
                     f"{_nonblank(c)} AS non_blank FROM {src}")
    return " UNION ALL ".join(parts)


add("dq_completeness", WITH_SALES + f", raw_customers AS ({RAW_CUSTOMERS}) "
    + "SELECT entity, column_name, rows, non_blank, CASE WHEN rows > 0 THEN non_blank / rows * 100.0 END AS completeness "
    + "FROM (" + _completeness_rows("sales", "raw_sales", SALES_COLS) + " UNION ALL "
    + _completeness_rows("customers", "raw_customers", CUSTOMER_COLS) + ") t")


def _uniq(entity: str, src: str, key: str) -> str:
    return (f"SELECT {q(entity)} AS entity, count(*) AS total, count(DISTINCT {key}) + "
            f"max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END) AS \"unique\" FROM {src}")


add("dq_uniqueness", WITH_SALES + f", raw_customers AS ({RAW_CUSTOMERS}) "
    + f"""SELECT entity, CASE WHEN total - "unique" = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  {sround('"unique" / total * 100.0')} AS score, total, "unique", total - "unique" AS duplicates FROM ("""
    + _uniq("sales", "raw_sales", "id") + " UNION ALL " + _uniq("customers", "raw_customers", "id")
    + " UNION ALL " + _uniq("documents", "documents", "text") + ") t")

VALID = f"coalesce(({to_double('amount')}) IS NOT NULL AND NOT isnan({to_double('amount')}) AND ({to_double('amount')}) >= 0, false)"
add("dq_validity", WITH_SALES + f", raw_customers AS ({RAW_CUSTOMERS}) "
    + f"""SELECT 'sales' AS entity, CASE WHEN rate >= {fixed.VALIDITY_PASS} THEN 'PASS' ELSE 'WARNING' END AS status,
  {sround('rate')} AS score, {q(fixed.VALIDITY_CHECK_LABEL)} AS "check"
FROM (SELECT count(*) FILTER (WHERE {VALID}) / count(*) * 100.0 AS rate FROM raw_sales) s
UNION ALL SELECT 'customers', 'PASS', 100.0::DOUBLE, NULL FROM (SELECT count(*) AS n FROM raw_customers) c WHERE n > 0""")

add("dq_timeliness", WITH_SALES + f""" SELECT sale_date,
  CASE WHEN d IS NULL THEN 'FAIL' WHEN age <= {fixed.TIMELINESS_MAX_AGE_DAYS} THEN 'PASS' ELSE 'WARNING' END AS status,
  CASE WHEN d IS NULL THEN 0.0 WHEN age <= {fixed.TIMELINESS_MAX_AGE_DAYS} THEN 100.0
       ELSE {fixed.TIMELINESS_LATE_SCORE} END::DOUBLE AS score,
  CASE WHEN d IS NULL THEN NULL ELSE age END::INTEGER AS age_days
FROM (SELECT sale_date, d, date_diff('day', d, DATE '{TIMELINESS_AS_OF}') AS age
      FROM (SELECT DISTINCT sale_date, CAST(try_strptime(sale_date, '%Y-%m-%d') AS DATE) AS d FROM raw_sales) x) y""")


def _completeness_mean(src: str, cols: list[str]) -> str:
    shares = [f"({_nonblank(c)} / count(*) * 100.0)" for c in cols]
    return f"SELECT count(*) AS rows, ({' + '.join(shares)}) / {float(len(cols))} AS mean FROM {src}"


def _dims_sql(entity: str, src: str, cols: list[str], key: str, amount: str | None) -> str:
    comp = (f"SELECT {q(entity)} AS entity, rows, {q(fixed.DIM_COMPLETENESS)} AS dimension, "
            f"CASE WHEN mean >= {fixed.COMPLETENESS_PASS} THEN 'PASS' ELSE 'WARNING' END AS status, "
            f"{sround('mean')} AS score FROM ({_completeness_mean(src, cols)}) c")
    uniq = (f"SELECT {q(entity)}, total, {q(fixed.DIM_UNIQUENESS)}, "
            f"CASE WHEN total - u = 0 THEN 'PASS' ELSE 'FAIL' END, {sround('u / total * 100.0')} "
            f"FROM (SELECT count(*) AS total, count(DISTINCT {key}) + max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END) AS u "
            f"FROM {src}) x")
    if amount:
        valid = (f"SELECT {q(entity)}, n, {q(fixed.DIM_VALIDITY)}, "
                 f"CASE WHEN rate >= {fixed.VALIDITY_PASS} THEN 'PASS' ELSE 'WARNING' END, {sround('rate')} "
                 f"FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {VALID}) / count(*) * 100.0 AS rate FROM {src}) v")
    else:
        valid = f"SELECT {q(entity)}, count(*), {q(fixed.DIM_VALIDITY)}, 'PASS', 100.0 FROM {src}"
    timely = f"SELECT {q(entity)}, count(*), {q(fixed.DIM_TIMELINESS)}, 'PASS', 100.0 FROM {src}"
    return " UNION ALL ".join([comp, uniq, valid, timely])


add("dq_report", WITH_SALES + f", raw_customers AS ({RAW_CUSTOMERS}), dims AS ("
    + _dims_sql("sales", "raw_sales", SALES_COLS, "id", "amount") + " UNION ALL "
    + _dims_sql("customers", "raw_customers", CUSTOMER_COLS, "id", None) + ")"
    + f""" SELECT 'raw' AS zone, d.entity, d.rows, d.dimension, d.status, CAST(d.score AS DOUBLE) AS score,
  {sround('g.m')} AS global_score,
  CASE WHEN g.m < {fixed.GLOBAL_CRITICAL_BELOW} THEN 'CRITICAL' WHEN g.m < {fixed.GLOBAL_WARNING_BELOW} THEN 'WARNING'
       ELSE 'OK' END AS global_status,
  CASE WHEN g.m < {fixed.GLOBAL_CRITICAL_BELOW} THEN {q(fixed.RECOMMENDATION_CRITICAL)}
       WHEN g.m < {fixed.GLOBAL_WARNING_BELOW} THEN {q(fixed.RECOMMENDATION_WARNING)}
       ELSE {q(fixed.RECOMMENDATION_OK)} END AS recommendation
FROM dims d JOIN (SELECT entity, avg(CASE WHEN score > 0 THEN CAST(score AS DOUBLE) END) AS m FROM dims GROUP BY entity) g
  ON d.entity = g.entity""")


# the same over the landed rows, where '' has become null and the lineage columns (never blank) count as columns
LANDED_SALES = """SELECT NULLIF(id, '') AS id, sale_date, amount, product, client_id, CAST(seq AS VARCHAR) AS seq,
  'x' AS source_system, 'x' AS ingestion_timestamp, 'x' AS file_name FROM raw_sales"""
LANDED_CUSTOMERS = "SELECT *, 'x' AS source_system, 'x' AS ingestion_timestamp, 'x' AS file_name FROM raw_customers"
LINEAGE = ["source_system", "ingestion_timestamp", "file_name"]
add("daily_missing_input", WITH_SALES + f", ls AS ({LANDED_SALES}), dims AS ("
    + _dims_sql("sales", "ls", SALES_COLS + LINEAGE, "id", "amount") + ")"
    + f""" SELECT 'raw' AS zone, 'sales' AS entity, n AS dimensions, {sround('m')} AS global_score,
  CASE WHEN m < {fixed.GLOBAL_CRITICAL_BELOW} THEN 'CRITICAL' WHEN m < {fixed.GLOBAL_WARNING_BELOW} THEN 'WARNING'
       ELSE 'OK' END AS global_status,
  CASE WHEN m < {fixed.GLOBAL_CRITICAL_BELOW} THEN {q(fixed.RECOMMENDATION_CRITICAL)}
       WHEN m < {fixed.GLOBAL_WARNING_BELOW} THEN {q(fixed.RECOMMENDATION_WARNING)}
       ELSE {q(fixed.RECOMMENDATION_OK)} END AS recommendation
FROM (SELECT CAST(count(*) AS INTEGER) AS n, avg(CASE WHEN score > 0 THEN CAST(score AS DOUBLE) END) AS m FROM dims) t
UNION ALL SELECT 'raw', 'customers', 0, 0.0, 'CRITICAL', {q(fixed.RECOMMENDATION_NO_DATA)}""")
add("daily_reports", WITH_SALES + f", raw_customers AS ({RAW_CUSTOMERS}), ls AS ({LANDED_SALES}), lc AS ({LANDED_CUSTOMERS}), dims AS ("
    + _dims_sql("sales", "ls", SALES_COLS + LINEAGE, "id", "amount") + " UNION ALL "
    + _dims_sql("customers", "lc", CUSTOMER_COLS + LINEAGE, "id", None) + ")"
    + f""" SELECT 'raw' AS zone, d.entity, {q(SOURCE_DATE)} AS run_date, {sround('g.m')} AS global_score, d.dimension, d.status
FROM dims d JOIN (SELECT entity, avg(CASE WHEN score > 0 THEN CAST(score AS DOUBLE) END) AS m FROM dims GROUP BY entity) g
  ON d.entity = g.entity""")


# --- storage-backed queries ------------------------------------------------------------

SALES_OUT = """SELECT id, strftime(sale_date, '%Y-%m-%d') AS sale_date, amount, product, client_id, segment, region,
  amount_ttc, total, total_ttc, year, month, day FROM enriched_sales"""

# CSV has no null: an empty field (quoted or not) reads back as null, so '' lands as null.
LANDED_AT = q(CLOCK.replace("T", " ")[:19])
add("land_roundtrip", WITH_SALES + f""" SELECT NULLIF(id, '') AS id, NULLIF(sale_date, '') AS sale_date,
  NULLIF(amount, '') AS amount, NULLIF(product, '') AS product, NULLIF(client_id, '') AS client_id,
  CAST(seq AS VARCHAR) AS seq, 'sales' AS source_system, {LANDED_AT} AS ingestion_timestamp,
  'sales_' || CAST(coalesce(length(amount), 0) AS VARCHAR) || '.csv' AS file_name, {q(SOURCE_DATE)} AS ingest_date
FROM raw_sales""")
add("land_nothing_new", WITH_SALES + """ SELECT NULLIF(id, '') AS id, NULLIF(amount, '') AS amount, CAST(seq AS VARCHAR) AS seq,
  true AS no_op FROM raw_sales""")
add("land_mixed_headers", """SELECT CAST(o_orderkey AS VARCHAR) AS id, printf('%.2f', o_totalprice) AS amount,
  CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS note,
  CASE o_orderkey % 3 WHEN 0 THEN 'sales_a' WHEN 1 THEN 'sales_b' ELSE 'sales_c' END AS file_name FROM orders""")
add("land_quoted_text", r"""SELECT CAST(doc_id AS VARCHAR) AS id, 'say "hi", \n\ ' || text || ' "' AS text FROM documents""")
add("land_one_file", f"""SELECT CAST(doc_id AS VARCHAR) AS id, '"quoted",' || chr(10) || text || chr(10) || '"" end' AS text,
  {q(SOURCE_DATE)} AS ingest_date FROM documents""")
add("land_customers", f"WITH raw_customers AS ({RAW_CUSTOMERS}) " + f"""SELECT *, 'customers' AS source_system,
  {LANDED_AT} AS ingestion_timestamp, 'customers_all.csv' AS file_name, {q(SOURCE_DATE)} AS ingest_date FROM raw_customers""")
add("curated_roundtrip", WITH_BOTH + " " + SALES_OUT)
add("catalog_scan", WITH_BOTH + " " + SALES_OUT)
add("overwrite_partitions", WITH_BOTH + f""", b1 AS (
  SELECT id, amount, total_ttc, {q(SOURCE_DATE)} AS _source_date, year, month, day FROM enriched_sales),
b2 AS (SELECT id, amount, total_ttc, '2002-01-01' AS _source_date, year, month, day FROM enriched_sales
       WHERE year = '1995' AND amount >= 50000)
SELECT * FROM b1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.year = b1.year AND b2.month = b1.month AND b2.day = b1.day)
UNION ALL SELECT * FROM b2""")
CUSTOMERS_OUT = """ SELECT id, sha256(last_name) AS last_name, sha256(first_name) AS first_name,
  sha256(email) AS email, sha256(phone) AS phone, sha256(CAST(birth_date AS VARCHAR)) AS birth_date,
  strftime(signup_date, '%Y-%m-%d') AS signup_date, active, postcode, age, age_band, tenure_days, loyalty,
  region, segment FROM curated_customers"""
for _name in ("compaction", "catalog_customers", "daily_customers"):
    add(_name, WITH_CUSTOMERS + CUSTOMERS_OUT)

add("catalog_late", WITH_CUSTOMERS + CUSTOMERS_OUT.replace(
    "region, segment FROM", "region, concat_ws('-', segment, CAST(CAST(id AS BIGINT) % 4 AS VARCHAR)) AS segment FROM")
    + " WHERE CAST(id AS BIGINT) % 4 < 3")
WITH_ALL = WITH_BOTH + f", curated_customers AS ({CURATED_CUSTOMERS})"
add("compaction_swap", WITH_ALL + """ SELECT entity, id, value, 'OK' AS status, count(*) OVER (PARTITION BY entity) AS rows_checked,
  0 AS backups
FROM (SELECT 'sales' AS entity, id, CAST(total_ttc AS VARCHAR) AS value FROM enriched_sales
      UNION ALL SELECT 'customers', id, sha256(email) FROM curated_customers) t""")
add("retention", WITH_SALES + f""" SELECT NULLIF(id, '') AS id, NULLIF(amount, '') AS amount, CAST(seq AS VARCHAR) AS seq,
  {q(SOURCE_DATE)} AS ingest_date, true AS purged FROM raw_sales""")


def _count_lines(entity: str, src: str, name: str, key: str, key2: str = "NULL") -> str:
    by = key if key2 == "NULL" else f"{key}, {key2}"
    return (f"SELECT {q(entity)}, {q(name)}, CAST({key} AS VARCHAR), CAST({key2} AS VARCHAR), CAST(count(*) AS DOUBLE) "
            f"FROM {src} GROUP BY {by}")


add("daily_sales", WITH_ALL + """ SELECT 'sales' AS entity, 'row' AS summary, id AS key, concat_ws('|', segment, region) AS key2,
  total_ttc AS value FROM enriched_sales
UNION ALL SELECT 'sales', 'total', NULL, NULL, CAST(count(*) AS DOUBLE) FROM enriched_sales
UNION ALL SELECT 'sales', 'raw_null_keys', NULL, NULL, CAST(count(*) FILTER (WHERE NULLIF(id, '') IS NULL) AS DOUBLE) FROM raw_sales
UNION ALL SELECT 'customers', 'total', NULL, NULL, CAST(count(*) AS DOUBLE) FROM curated_customers
UNION ALL SELECT 'customers', 'raw_null_keys', NULL, NULL, CAST(count(*) FILTER (WHERE id IS NULL) AS DOUBLE) FROM raw_customers
UNION ALL """ + " UNION ALL ".join([
    _count_lines("sales", "enriched_sales", "by_month", "year", "month"),
    f"SELECT 'sales', 'revenue_by_region', region, NULL, {sround(money_sum('total_ttc'))} FROM enriched_sales GROUP BY region",
    *[_count_lines("customers", "curated_customers", f"by_{c}", c) for c in ("segment", "loyalty", "age_band", "active")]]))


# curated rows as the quality job reads them: stamps and lineage are never blank
_STAMPS = ["source_system", "ingestion_timestamp", "file_name", "_last_transformed", "_etl_version", "_source_date"]
_X = ", ".join(f"'x' AS {c}" for c in _STAMPS)
_CS_COLS = ["id", "sale_date", "product", "client_id", "quantity", "segment", "region", "amount_ttc", "total", "total_ttc",
            "year", "month", "day", "seq"]
_CC_COLS = CUSTOMER_COLS + ["age", "age_band", "tenure_days", "loyalty", "signup_year", "signup_month"]
add("daily_run", WITH_ALL + f""", ls AS ({LANDED_SALES}), lc AS ({LANDED_CUSTOMERS}),
cs AS (SELECT {', '.join(_CS_COLS)}, CAST(amount AS VARCHAR) AS amount, {_X} FROM enriched_sales),
cc AS (SELECT {', '.join(_CC_COLS)}, {_X} FROM curated_customers),
raw_dims AS (""" + _dims_sql("sales", "ls", SALES_COLS + LINEAGE, "id", "amount") + " UNION ALL "
    + _dims_sql("customers", "lc", CUSTOMER_COLS + LINEAGE, "id", None) + "), curated_dims AS ("
    + _dims_sql("sales", "cs", _CS_COLS + ["amount"] + _STAMPS, "id", "amount") + " UNION ALL "
    + _dims_sql("customers", "cc", _CC_COLS + _STAMPS, "id", None) + ")"
    + f""" SELECT 'curated' AS what, 'sales' AS entity, id AS key, CAST(total_ttc AS VARCHAR) AS value FROM enriched_sales
UNION ALL SELECT 'curated', 'customers', id, sha256(email) FROM curated_customers
UNION ALL SELECT 'report', 'raw:' || entity, dimension, status FROM raw_dims
UNION ALL SELECT 'report', 'curated:' || entity, dimension, status FROM curated_dims
UNION ALL SELECT 'alert', 'data_lake', 'DATA_LAKE_SUCCESS', 'Pipeline completed successfully'
UNION ALL SELECT 'raw', 'sales', {q(SOURCE_DATE)}, CAST(count(*) AS VARCHAR) FROM ls
UNION ALL SELECT 'raw', 'customers', {q(SOURCE_DATE)}, CAST(count(*) AS VARCHAR) FROM lc""")

add("compaction_incremental", WITH_CUSTOMERS + """, f AS (
  SELECT region, segment, count(*) AS n, count(DISTINCT CAST(id AS BIGINT) % 3) AS files,
         count(*) FILTER (WHERE loyalty = 'GOLD' AND region = 'ASIA') AS late
  FROM curated_customers GROUP BY region, segment)
SELECT 'first' AS run, CASE WHEN count(*) = 0 THEN 'UNCHANGED' ELSE 'OK' END AS status, CAST(count(*) AS INTEGER) AS folders,
       CAST(coalesce(sum(files), 0) AS INTEGER) AS files_before, CAST(count(*) AS INTEGER) AS files_after,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM f WHERE files > 1
UNION ALL SELECT 'second', 'UNCHANGED', 0, 0, 0, 0
UNION ALL SELECT 'third', CASE WHEN count(*) = 0 THEN 'UNCHANGED' ELSE 'OK' END, CAST(count(*) AS INTEGER),
       CAST(2 * count(*) AS INTEGER), CAST(count(*) AS INTEGER), CAST(coalesce(sum(n + late), 0) AS BIGINT) FROM f WHERE late > 0
UNION ALL SELECT 'left/' || region || '/' || segment, 'TABLE', NULL, NULL, NULL, n + late FROM f""")
add("compaction_versions", WITH_CUSTOMERS + f", c AS ({CUSTOMERS_OUT}) SELECT *, 1 AS version FROM c UNION ALL SELECT *, 2 FROM c")
add("alert_rerun", """SELECT CASE WHEN timestamp >= '2024-01-15' THEN 'day-2' ELSE 'day-1' END AS run, substr(timestamp, 1, 10) AS alert_date,
  status, task_id, timestamp
FROM (SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, 'user_' || CAST(user_id AS VARCHAR) AS task_id,
        CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'signup' THEN 'SUCCESS' ELSE 'WARNING' END AS status FROM events) e
WHERE timestamp < '2024-01-15' OR status = 'FAIL'""")
add("compaction_report", WITH_CUSTOMERS + """ SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(files) AS INTEGER) AS files_before,
  1 AS target_files, true AS files_counted, true AS sizes_agree, true AS reduction_agrees
FROM (SELECT count(*) AS n, count(DISTINCT CAST(id AS BIGINT) % 4) AS files FROM curated_customers GROUP BY region, segment) t""")


def _colour(col: str) -> str:
    arms = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in fixed.SEVERITY_COLOURS.items())
    return f"CASE {arms} ELSE {q(fixed.SEVERITY_COLOUR_OTHER)} END"


DOC_DIMS = _dims_sql("documents", "(SELECT doc_id, text FROM documents)", ["doc_id", "text"], "text", None)
add("alerts_from_quality", WITH_SALES + f", raw_customers AS ({RAW_CUSTOMERS}), dims AS ("
    + _dims_sql("sales", "raw_sales", SALES_COLS, "id", "amount") + " UNION ALL "
    + _dims_sql("customers", "raw_customers", CUSTOMER_COLS, "id", None) + " UNION ALL " + DOC_DIMS + "), "
    + f"""g AS (SELECT entity, avg(CASE WHEN score > 0 THEN CAST(score AS DOUBLE) END) AS m FROM dims GROUP BY entity),
gs AS (SELECT entity, {sround('m')} AS global_score,
         CASE WHEN m < {fixed.GLOBAL_CRITICAL_BELOW} THEN 'CRITICAL' WHEN m < {fixed.GLOBAL_WARNING_BELOW} THEN 'WARNING'
              ELSE 'OK' END AS global_status,
         CASE WHEN m < {fixed.GLOBAL_CRITICAL_BELOW} THEN {q(fixed.RECOMMENDATION_CRITICAL)}
              WHEN m < {fixed.GLOBAL_WARNING_BELOW} THEN {q(fixed.RECOMMENDATION_WARNING)}
              ELSE {q(fixed.RECOMMENDATION_OK)} END AS recommendation FROM g),
a AS (SELECT entity, 'raw' AS zone, 'DATA_QUALITY' AS type,
        CASE WHEN status = 'FAIL' THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
        dimension || ' ' || status || ' score=' || CAST(CAST(score AS DOUBLE) AS VARCHAR) AS message
      FROM dims WHERE status IN ('FAIL', 'WARNING')
      UNION ALL
      SELECT entity, 'raw', 'DATA_QUALITY_GLOBAL', global_status,
        'global score ' || CAST(global_score AS VARCHAR) || ' - ' || recommendation FROM gs WHERE global_status <> 'OK')
SELECT {q(CLOCK)} AS timestamp, type, entity, zone, severity, message,
  {_colour('severity')} AS colour, substr(message, 1, {fixed.ALERT_MESSAGE_MAX}) AS display FROM a""")
add("alert_log", f"""SELECT *, CASE WHEN status = 'FAIL' THEN {q(fixed.STATUS_COLOUR_FAIL)} ELSE {q(fixed.STATUS_COLOUR_OTHER)} END AS colour,
  substr(error_message, 1, {fixed.ALERT_MESSAGE_MAX}) AS display
FROM (SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, 'events' AS dag_id, 'user_' || CAST(user_id AS VARCHAR) AS task_id,
        CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'signup' THEN 'SUCCESS' ELSE 'WARNING' END AS status,
        CASE event_type WHEN 'error' THEN repeat(props, 70) WHEN 'signup' THEN NULL ELSE props END AS error_message,
        strftime(ts, '%Y-%m-%d') AS execution_date, CAST(event_id % 3 + 1 AS INTEGER) AS try_number,
        strftime(ts, '%Y-%m-%d') AS alert_date FROM events) e""")
for _name in ("alert_stream", "alert_counts_stream"):
    add(_name, """SELECT CASE WHEN event_type = 'error' THEN 'CRITICAL' WHEN event_type = 'signup' THEN 'INFO'
  ELSE 'WARNING' END AS severity, 'user_' || CAST(user_id AS VARCHAR) AS entity, count(*) AS alerts
FROM events GROUP BY 1, 2""")

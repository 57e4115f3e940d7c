"""Clinical roles played by the driver's test tables.

No clinical CSV is available, so the operators run on views of the TPC-H-like
test tables renamed into the clinical column names the operators default to.
Each role is defined twice, side by side: as a Spark DataFrame (what the
queries run) and as a DuckDB SQL view (what the oracle runs).  Both are plain
projections / aggregates of the given tables, so every query's work grows with
the tables.

| role          | test source              | notes                                           |
| ------------- | ------------------------ | ----------------------------------------------- |
| PATIENTS      | customer                 | GENDER = segment, DOB derived from the balance  |
| ICUSTAYS      | orders                   | one stay per order, LOS = totalprice / 15000    |
| ADMISSIONS    | orders                   | HADM_ID = order key                             |
| DIAGNOSES_ICD | lineitem                 | code derived from the part key                  |
| D_ICD_DIAG.   | part                     | min(name) per derived code                      |
| CHARTEVENTS   | events                   | stay = user, item = event type                  |
| event stays   | events                   | INTIME = first event of the user                |
| LABEVENTS     | lineitem                 | item = part, time = ship date, value = quantity |
| order events  | lineitem                 | chart events of the order stays, item = flag    |
| D_ITEMS       | part                     | item = part, DBSOURCE = part type               |
| age pairs     | lineitem x orders        | ADMITTIME = ship date, DOB = order date         |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the test mapping: which event types play the vital signs.
TEST_VITALS = {"heart_rate": ["click"], "respiratory_rate": ["view"], "spo2": ["purchase"]}
TEST_HEART_RATE_ITEMS = ["click", "error"]
# Line items play chart events of the order-keyed stays: the return flag is the item.
TEST_ORDER_VITALS = {"heart_rate": ["A"], "respiratory_rate": ["N"], "spo2": ["R"]}
TEST_ORDER_HEART_RATE_ITEMS = ["A", "N"]
# Lab window on the lineitem role: 180 days after the order date.
TEST_LAB_WINDOW_HOURS = 180 * 24
# Keyword classes on the part names that play diagnosis titles (first match wins);
# '%red%gear%' plays the two-word pattern of the clinical list.
TEST_KEYWORDS = [
    ("cardiac", ["%ring%", "%red%gear%"]),
    ("respiratory", ["%widget%", "%gear%"]),
    ("renal", ["%bolt%"]),
    ("infectious", ["%gizmo%"]),
    ("diabetes", ["%plate%"]),
    ("stroke", ["%anvil%"]),
    ("trauma", ["%hot%"]),
]


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def icd9_code_of(key: Column) -> Column:
    """Deterministic ICD-9-like code of a part key (NULL, E, V and numeric codes)."""
    k = key
    return (
        F.when(k % 50 == 49, F.lit(None).cast("string"))
        .when(k % 20 == 0, F.concat(F.lit("E"), F.lpad(((k * 7) % 1000).cast("string"), 3, "0")))
        .when(k % 20 == 1, F.concat(F.lit("V"), F.lpad(((k * 7) % 100).cast("string"), 2, "0")))
        .otherwise(F.concat(F.lpad(((k * 7) % 1000).cast("string"), 3, "0"), F.lit("0")))
    )


ICD9_CODE_SQL = (
    "CASE WHEN {k} % 50 = 49 THEN NULL "
    "WHEN {k} % 20 = 0 THEN 'E' || lpad(CAST(({k} * 7) % 1000 AS VARCHAR), 3, '0') "
    "WHEN {k} % 20 = 1 THEN 'V' || lpad(CAST(({k} * 7) % 100 AS VARCHAR), 2, '0') "
    "ELSE lpad(CAST(({k} * 7) % 1000 AS VARCHAR), 3, '0') || '0' END"
)


def _hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"), F.lit(0), F.lit(0))


# ---------------------------------------------------------------- Spark roles

def patients(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    days = F.floor((c.c_acctbal + F.lit(1000.0)) * F.lit(2.4)).cast("int")
    return c.select(
        F.col("c_custkey").alias("SUBJECT_ID"),
        F.col("c_mktsegment").alias("GENDER"),
        F.date_add(F.lit("1920-01-01").cast("date"), days).cast("timestamp_ntz").alias("DOB"),
        F.when(c.c_acctbal < 0, 1).otherwise(0).alias("EXPIRE_FLAG"),
    )


def icustays(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("SUBJECT_ID"),
        F.col("o_orderkey").alias("HADM_ID"),
        F.col("o_orderkey").alias("ICUSTAY_ID"),
        F.when(o.o_orderstatus == "O", "metavision").otherwise("carevue").alias("DBSOURCE"),
        F.col("o_orderpriority").alias("FIRST_CAREUNIT"),
        F.when(o.o_orderstatus == "F", "5-LOW").otherwise(o.o_orderpriority).alias("LAST_CAREUNIT"),
        F.col("o_orderdate").alias("INTIME"),
        _hours(o.o_orderdate, F.floor(o.o_totalprice / 625)).alias("OUTTIME"),
        (o.o_totalprice / 15000).alias("LOS"),
    )


def admissions(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("SUBJECT_ID"),
        F.col("o_orderkey").alias("HADM_ID"),
        F.col("o_orderdate").alias("ADMITTIME"),
        _hours(o.o_orderdate, F.floor(o.o_totalprice / 500)).alias("DISCHTIME"),
        F.col("o_orderpriority").alias("ADMISSION_TYPE"),
        F.col("o_orderstatus").alias("INSURANCE"),
        F.when(o.o_orderstatus == "F", "MARRIED").when(o.o_orderstatus == "O", "SINGLE").alias("MARITAL_STATUS"),
        F.when(o.o_orderstatus == "F", 1).otherwise(0).alias("HOSPITAL_EXPIRE_FLAG"),
    )


def diagnoses_icd(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("HADM_ID"),
        F.col("l_linenumber").alias("SEQ_NUM"),
        icd9_code_of(F.col("l_partkey")).alias("ICD9_CODE"),
    )


def d_icd_diagnoses(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return (
        p.select(icd9_code_of(F.col("p_partkey")).alias("ICD9_CODE"), "p_name", "p_type")
        .filter(F.col("ICD9_CODE").isNotNull())
        .groupBy("ICD9_CODE")
        .agg(F.min("p_name").alias("SHORT_TITLE"),
             F.min(F.concat_ws(" ", "p_type", "p_name")).alias("LONG_TITLE"))
    )


def chartevents(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("SUBJECT_ID"),
        F.col("user_id").alias("HADM_ID"),
        F.col("user_id").alias("ICUSTAY_ID"),
        F.col("event_type").alias("ITEMID"),
        F.col("ts").alias("CHARTTIME"),
        F.col("value").alias("VALUENUM"),
    )


def event_stays(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return (e.groupBy("user_id").agg(F.min("ts").alias("INTIME"))
            .select(F.col("user_id").alias("ICUSTAY_ID"), F.col("user_id").alias("HADM_ID"),
                    F.col("user_id").alias("SUBJECT_ID"), "INTIME"))


def labevents(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("HADM_ID"),
        F.col("l_partkey").alias("ITEMID"),
        F.col("l_shipdate").alias("CHARTTIME"),
        F.col("l_quantity").alias("VALUENUM"),
    )


def d_items(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ITEMID"), F.col("p_name").alias("LABEL"),
                    F.col("p_type").alias("DBSOURCE"))


def order_events(spark, sf_dir) -> DataFrame:
    """Line items as chart events of the order-keyed stays (item = return flag)."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("ICUSTAY_ID"),
        F.col("l_orderkey").alias("HADM_ID"),
        F.col("l_returnflag").alias("ITEMID"),
        F.col("l_shipdate").alias("CHARTTIME"),
        F.col("l_quantity").alias("VALUENUM"),
    )


def age_pairs(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("HADM_ID"), F.col("l_linenumber").alias("SEQ_NUM"),
        F.col("l_shipdate").alias("ADMITTIME"), F.col("o_orderdate").alias("DOB"))


ROLES = {
    "patients": patients, "icustays": icustays, "admissions": admissions,
    "diagnoses_icd": diagnoses_icd, "d_icd_diagnoses": d_icd_diagnoses,
    "chartevents": chartevents, "event_stays": event_stays, "labevents": labevents,
    "d_items": d_items, "order_events": order_events, "age_pairs": age_pairs,
}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ROLES[name](spark, sf_dir)


# ---------------------------------------------------------------- DuckDB roles

ROLE_SQL: dict[str, str] = {
    "r_patients": """
        SELECT c_custkey AS SUBJECT_ID, c_mktsegment AS GENDER,
               CAST(DATE '1920-01-01' + CAST(floor((c_acctbal + 1000.0) * 2.4) AS INTEGER) AS TIMESTAMP) AS DOB,
               CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS EXPIRE_FLAG
        FROM customer""",
    "r_icustays": """
        SELECT o_custkey AS SUBJECT_ID, o_orderkey AS HADM_ID, o_orderkey AS ICUSTAY_ID,
               CASE WHEN o_orderstatus = 'O' THEN 'metavision' ELSE 'carevue' END AS DBSOURCE,
               o_orderpriority AS FIRST_CAREUNIT,
               CASE WHEN o_orderstatus = 'F' THEN '5-LOW' ELSE o_orderpriority END AS LAST_CAREUNIT,
               o_orderdate AS INTIME,
               o_orderdate + to_hours(CAST(floor(o_totalprice / 625) AS BIGINT)) AS OUTTIME,
               o_totalprice / 15000 AS LOS
        FROM orders""",
    "r_admissions": """
        SELECT o_custkey AS SUBJECT_ID, o_orderkey AS HADM_ID, o_orderdate AS ADMITTIME,
               o_orderdate + to_hours(CAST(floor(o_totalprice / 500) AS BIGINT)) AS DISCHTIME,
               o_orderpriority AS ADMISSION_TYPE, o_orderstatus AS INSURANCE,
               CASE WHEN o_orderstatus = 'F' THEN 'MARRIED' WHEN o_orderstatus = 'O' THEN 'SINGLE' END
                   AS MARITAL_STATUS,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS HOSPITAL_EXPIRE_FLAG
        FROM orders""",
    "r_diagnoses_icd": f"""
        SELECT l_orderkey AS HADM_ID, l_linenumber AS SEQ_NUM,
               {ICD9_CODE_SQL.format(k='l_partkey')} AS ICD9_CODE
        FROM lineitem""",
    "r_d_icd_diagnoses": f"""
        SELECT ICD9_CODE, min(p_name) AS SHORT_TITLE, min(p_type || ' ' || p_name) AS LONG_TITLE
        FROM (SELECT {ICD9_CODE_SQL.format(k='p_partkey')} AS ICD9_CODE, p_name, p_type FROM part)
        WHERE ICD9_CODE IS NOT NULL GROUP BY ICD9_CODE""",
    "r_chartevents": """
        SELECT user_id AS SUBJECT_ID, user_id AS HADM_ID, user_id AS ICUSTAY_ID, event_type AS ITEMID,
               ts AS CHARTTIME, value AS VALUENUM
        FROM events""",
    "r_event_stays": """
        SELECT user_id AS ICUSTAY_ID, user_id AS HADM_ID, user_id AS SUBJECT_ID, min(ts) AS INTIME
        FROM events GROUP BY user_id""",
    "r_labevents": """
        SELECT l_orderkey AS HADM_ID, l_partkey AS ITEMID, l_shipdate AS CHARTTIME, l_quantity AS VALUENUM
        FROM lineitem""",
    "r_d_items": "SELECT p_partkey AS ITEMID, p_name AS LABEL, p_type AS DBSOURCE FROM part",
    "r_order_events": """
        SELECT l_orderkey AS ICUSTAY_ID, l_orderkey AS HADM_ID, l_returnflag AS ITEMID, l_shipdate AS CHARTTIME,
               l_quantity AS VALUENUM
        FROM lineitem""",
    "r_age_pairs": """
        SELECT l_orderkey AS HADM_ID, l_linenumber AS SEQ_NUM, l_shipdate AS ADMITTIME, o_orderdate AS DOB
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


# Columns of the role views that stand for declared tables.
ROLE_COLUMNS: dict[str, list[str]] = {
    "PATIENTS": ["SUBJECT_ID", "GENDER", "DOB", "EXPIRE_FLAG"],
    "ADMISSIONS": ["SUBJECT_ID", "HADM_ID", "ADMITTIME", "DISCHTIME", "ADMISSION_TYPE", "INSURANCE", "MARITAL_STATUS",
                   "HOSPITAL_EXPIRE_FLAG"],
    "ICUSTAYS": ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "DBSOURCE", "FIRST_CAREUNIT", "LAST_CAREUNIT", "INTIME", "OUTTIME", "LOS"],
    "DIAGNOSES_ICD": ["HADM_ID", "SEQ_NUM", "ICD9_CODE"],
    "D_ICD_DIAGNOSES": ["ICD9_CODE", "SHORT_TITLE", "LONG_TITLE"],
    "D_ITEMS": ["ITEMID", "LABEL", "DBSOURCE"],
    "LABEVENTS": ["HADM_ID", "ITEMID", "CHARTTIME", "VALUENUM"],
    "CHARTEVENTS": ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "ITEMID", "CHARTTIME", "VALUENUM"],
}


def with_roles(sql: str) -> str:
    """Prefix ``sql`` with the role views it mentions (as CTEs)."""
    used = [name for name in ROLE_SQL if name in sql]
    if not used:
        return sql
    ctes = ",\n".join(f"{name} AS ({ROLE_SQL[name]})" for name in used)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"

"""Registered queries: scans, sinks, layouts and constraint checks (survey 2.1, 2.2).

File operators are checked by a round trip: a role table is written to a fresh
folder under the shared ``spark.checkpoint.dir`` and read back; the read-back frame
is the query result, compared with the source in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stayflow.catalog import query
from stayflow.catalog.features import BASE_SQL
from stayflow.operators import quality as Q
from stayflow.plans.stays import base_stay_features
from stayflow.sources import io
from stayflow.sources import testmap as tm
from stayflow.sources.schemas import schema_of, table_spec

TS_WRITE = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _icustays_csv_frame(spark, d):
    """The ICUSTAYS role in the declared column order and types (+ ROW_ID)."""
    s = tm.icustays(spark, d)
    ward = F.substring("FIRST_CAREUNIT", 1, 1).cast("smallint")
    return s.select(
        (F.col("ICUSTAY_ID") + 1).cast("int").alias("ROW_ID"), F.col("SUBJECT_ID").cast("int").alias("SUBJECT_ID"),
        F.col("HADM_ID").cast("int").alias("HADM_ID"), F.col("ICUSTAY_ID").cast("int").alias("ICUSTAY_ID"),
        "DBSOURCE", "FIRST_CAREUNIT", "LAST_CAREUNIT", ward.alias("FIRST_WARDID"), ward.alias("LAST_WARDID"),
        "INTIME", "OUTTIME", "LOS")


ICUSTAYS_SQL = """
SELECT CAST(SUBJECT_ID AS INTEGER) AS SUBJECT_ID, CAST(HADM_ID AS INTEGER) AS HADM_ID,
       CAST(ICUSTAY_ID AS INTEGER) AS ICUSTAY_ID, DBSOURCE, FIRST_CAREUNIT, LAST_CAREUNIT,
       CAST(substr(FIRST_CAREUNIT, 1, 1) AS SMALLINT) AS FIRST_WARDID,
       CAST(substr(FIRST_CAREUNIT, 1, 1) AS SMALLINT) AS LAST_WARDID, INTIME, OUTTIME, LOS
FROM r_icustays"""


@query("csv_scan", dbl="LOS", sql=ICUSTAYS_SQL)
def csv_scan(spark, d):
    """ICUSTAYS written as ICUSTAYS.csv (header) and loaded with the declared schema; ROW_ID dropped."""
    folder = io.scratch_path(spark, "csv_scan")
    (_icustays_csv_frame(spark, d).write.mode("overwrite").option("header", True)
     .option("timestampFormat", TS_WRITE).option("timestampNTZFormat", TS_WRITE).csv(f"{folder}/ICUSTAYS.csv"))
    return io.load_csv_table(spark, folder, "icustays")


def _sampled_infer(spark, d):
    """Customers written as CSV and read with inferred types; a value that does not fit them fails the read."""
    folder = io.scratch_path(spark, "csv_infer")
    tm.read(spark, d, "customer").write.mode("overwrite").option("header", True).csv(folder)
    return io.load_csv_sampled_infer(spark, folder, 0.1, "FAILFAST")


@query("csv_scan_sampled_infer", sql="""
SELECT * FROM (VALUES ('c_custkey', 'int'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'),
                      ('c_mktsegment', 'string')) t("column", inferred), (SELECT count(*) AS rows FROM customer)""")
def csv_scan_sampled_infer(spark, d):
    """Column types that a 10 % sample of the CSV rows gives, and the rows read with them; every value is parsed."""
    df = _sampled_infer(spark, d)
    types = ", ".join(f"'{c}', '{t}'" for c, t in df.dtypes)
    # a count of rows alone would leave the columns unread
    rows = F.greatest(F.count(F.lit(1)), *[F.count(c) for c in df.columns])
    return df.agg(rows.alias("rows")).selectExpr(f"stack({len(df.columns)}, {types}) AS (column, inferred)", "rows")


@query("csv_sampled_infer_rows", dbl="c_acctbal", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_sampled_infer_rows(spark, d):
    """Every CSV row, read with the types that a 10 % sample gives."""
    return _sampled_infer(spark, d)


@query("typed_event_scan", dbl="VALUENUM", sql="""
SELECT event_id AS ROW_ID, CAST(user_id AS INTEGER) AS SUBJECT_ID,
       CAST(user_id AS INTEGER) AS ICUSTAY_ID, event_type AS ITEMID, ts AS CHARTTIME, value AS VALUENUM,
       (SELECT count(value) FROM events) AS values_read
FROM events""")
def typed_event_scan(spark, d):
    """Events written as CHARTEVENTS-shaped CSV and read with the declared schema plus a
    per-column override (ITEMID holds text here); with the number of values read."""
    e = tm.read(spark, d, "events")
    schema = schema_of("CHARTEVENTS")
    cols = []
    for f in schema.fields:
        src = {"ROW_ID": "event_id", "SUBJECT_ID": "user_id", "ICUSTAY_ID": "user_id", "ITEMID": "event_type",
               "CHARTTIME": "ts", "VALUENUM": "value"}.get(f.name)
        cols.append((F.col(src) if src else F.lit(None)).cast("string" if f.name == "ITEMID" else
                                                               f.dataType.simpleString()).alias(f.name))
    folder = io.scratch_path(spark, "typed_scan")
    (e.select(*cols).write.mode("overwrite").option("header", True).option("timestampFormat", TS_WRITE)
     .option("timestampNTZFormat", TS_WRITE).csv(folder))
    df = io.typed_event_scan(spark, folder, schema, {"ITEMID": "string"}, timestamp_format=TS_WRITE)
    values = df.select(F.count("VALUENUM")).scalar()
    return df.select("ROW_ID", "SUBJECT_ID", "ICUSTAY_ID", "ITEMID", "CHARTTIME", "VALUENUM", values.alias("values_read"))


@query("sql_view_scan", dbl="longest_los", sql="""
SELECT s.FIRST_CAREUNIT, p.GENDER, count(*) AS stays, count(DISTINCT s.SUBJECT_ID) AS patients, max(s.LOS) AS longest_los
FROM r_icustays s INNER JOIN r_patients p USING (SUBJECT_ID) GROUP BY ALL""")
def sql_view_scan(spark, d):
    """Role tables registered as temp views and summarised by SQL over them."""
    views = {"stay_view": tm.icustays(spark, d), "person_view": tm.patients(spark, d)}
    return io.sql_view_scan(spark, views, """
    WITH per_patient AS (
      SELECT SUBJECT_ID, FIRST_CAREUNIT, count(*) AS n, max(LOS) AS los
      FROM stay_view GROUP BY SUBJECT_ID, FIRST_CAREUNIT)
    SELECT FIRST_CAREUNIT, GENDER, sum(n) AS stays, count(*) AS patients, max(los) AS longest_los
    FROM per_patient JOIN person_view USING (SUBJECT_ID) GROUP BY FIRST_CAREUNIT, GENDER""")


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
           "pages", "benchmark", "labels", "conversations"]


_MANIFEST_SQL = "\nUNION ALL\n".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _TABLES)


@query("load_manifest", sql=f"""
WITH m AS ({_MANIFEST_SQL})
SELECT "table", rows FROM m UNION ALL SELECT 'TOTAL', CAST(sum(rows) AS BIGINT) FROM m""")
def load_manifest(spark, d):
    return io.load_manifest({t: tm.read(spark, d, t) for t in _TABLES})


@query("load_manifest_footers", sql=f"""
WITH m AS ({_MANIFEST_SQL})
SELECT "table", rows FROM m UNION ALL SELECT 'TOTAL', CAST(sum(rows) AS BIGINT) FROM m""")
def load_manifest_footers(spark, d):
    """The same from the files' footers."""
    return io.footer_manifest(spark, {t: tm.path(d, t) for t in _TABLES})


def _base(spark, d):
    return base_stay_features(tm.icustays(spark, d), tm.patients(spark, d), tm.admissions(spark, d), 24,
                              emergency_pattern="%urgent%")


@query("csv_sink", dbl="AGE TOTAL_LOS REMAINING_LOS", sql=BASE_SQL.format(w=24))
def csv_sink(spark, d):
    """Base features saved as CSV with header (overwrite) and read back with their schema."""
    df = _base(spark, d)
    folder = io.scratch_path(spark, "csv_sink")
    io.csv_sink(df, folder)
    return io.read_csv_back(spark, folder, df.schema)


@query("sample_sink", dbl="AGE TOTAL_LOS REMAINING_LOS", sql=f"""
SELECT * FROM ({BASE_SQL.format(w=24)}) ORDER BY ICUSTAY_ID LIMIT 1000""")
def sample_sink(spark, d):
    """First 1,000 rows by key written next to the full output, read back."""
    df = _base(spark, d)
    folder = io.scratch_path(spark, "features")
    paths = io.save_features(df, folder, sample_rows=1000)
    return io.read_csv_back(spark, paths["sample"], df.schema)


@query("parquet_sink", dbl="AGE TOTAL_LOS REMAINING_LOS", sql=BASE_SQL.format(w=24))
def parquet_sink(spark, d):
    folder = io.scratch_path(spark, "parquet_sink")
    io.parquet_sink(_base(spark, d), folder)
    return spark.read.parquet(folder)


def _bucket_sql(col: str, ranges, closed: bool) -> str:
    conds = " ".join(f"WHEN {col} >= {lo} AND {col} {'<=' if closed else '<'} {hi} THEN '{n}'"
                     for n, lo, hi in ranges)
    return f"CASE {conds} ELSE 'other' END"


@query("range_partitioned_layout", sql=f"""
SELECT 'chart_items' AS layout, {_bucket_sql('ITEMID', io.CHART_ITEM_RANGES, False)} AS bucket,
       count(*) AS rows, min(ITEMID) AS min_key, max(ITEMID) AS max_key
FROM r_labevents GROUP BY 2
UNION ALL
SELECT 'lab_years', {_bucket_sql('year(CHARTTIME)', io.LAB_YEAR_RANGES, True)}, count(*),
       min(CAST(year(CHARTTIME) AS BIGINT)), max(CAST(year(CHARTTIME) AS BIGINT))
FROM r_labevents GROUP BY 2""")
def range_partitioned_layout(spark, d):
    """Events written partitioned by item-id range and by year range, read back per
    bucket (partition column from the folder names)."""
    lab = tm.labevents(spark, d)
    a = io.scratch_path(spark, "layout_items")
    io.write_range_layout(lab, a, io.range_bucket(F.col("ITEMID"), io.CHART_ITEM_RANGES))
    b = io.scratch_path(spark, "layout_years")
    io.write_range_layout(lab.withColumn("YEAR", F.year("CHARTTIME").cast("long")), b,
                          io.range_bucket(F.year("CHARTTIME"), io.LAB_YEAR_RANGES, closed_high=True))
    items = (io.read_range_layout(spark, a).groupBy("bucket")
             .agg(F.count(F.lit(1)).alias("rows"), F.min("ITEMID").alias("min_key"), F.max("ITEMID").alias("max_key"))
             .select(F.lit("chart_items").alias("layout"), "bucket", "rows", "min_key", "max_key"))
    years = (io.read_range_layout(spark, b).groupBy("bucket")
             .agg(F.count(F.lit(1)).alias("rows"), F.min("YEAR").alias("min_key"), F.max("YEAR").alias("max_key"))
             .select(F.lit("lab_years").alias("layout"), "bucket", "rows", "min_key", "max_key"))
    return items.unionByName(years)


# ------------------------------------------------------------------ 2.2 constraint checks

# Role tables that stand for declared tables: (declared name, frame, role view).
_DECLARED = {
    "PATIENTS": (tm.patients, "r_patients"), "ADMISSIONS": (tm.admissions, "r_admissions"),
    "ICUSTAYS": (tm.icustays, "r_icustays"), "DIAGNOSES_ICD": (tm.diagnoses_icd, "r_diagnoses_icd"),
    "D_ICD_DIAGNOSES": (tm.d_icd_diagnoses, "r_d_icd_diagnoses"), "D_ITEMS": (tm.d_items, "r_d_items"),
    "LABEVENTS": (tm.labevents, "r_labevents"), "CHARTEVENTS": (tm.chartevents, "r_chartevents"),
}


def _shown(cols) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)


def _keys(columns: dict[str, list[str]]):
    """Checkable primary keys: those whose columns the role table has."""
    for t, (frame, view) in _DECLARED.items():
        key = table_spec(t).primary_key
        if key and all(c in columns[t] for c in key):
            yield t, frame, view, key


def _references(columns: dict[str, list[str]]):
    """Checkable foreign keys: both tables are role tables and have the columns (the chart
    events' role has text for its item ids, so those are not compared)."""
    for t, (frame, view) in _DECLARED.items():
        for cols, parent, parent_cols in table_spec(t).foreign_keys:
            if (t, parent) != ("CHARTEVENTS", "D_ITEMS") and parent in _DECLARED and all(c in columns[t] for c in cols) and all(c in columns[parent] for c in parent_cols):
                yield t, frame, view, cols, parent, parent_cols


# The columns that the role tables have of those declared (see testmap).
_COLUMNS = tm.ROLE_COLUMNS

_PK_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", {_shown(key)} AS key, count(*) AS count FROM {view} GROUP BY {', '.join(key)} "
    f"HAVING count(*) > 1 OR {' OR '.join(f'{c} IS NULL' for c in key)}" for t, _, view, key in _keys(_COLUMNS))
# (admission, sequence number) is declared nowhere, but meant to be unique
_PK_SQL += ("\nUNION ALL\nSELECT 'DIAGNOSES_ICD (HADM_ID, SEQ_NUM)', " + _shown(["HADM_ID", "SEQ_NUM"])
            + ", count(*) FROM r_diagnoses_icd GROUP BY HADM_ID, SEQ_NUM HAVING count(*) > 1 OR HADM_ID IS NULL OR SEQ_NUM IS NULL")


def _key_text(cols):
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


@query("pk_violations", sql=_PK_SQL)
def pk_violations(spark, d):
    """Repeated or NULL keys of every role table's declared primary key."""
    checks = [(t, frame(spark, d), list(key)) for t, frame, _, key in _keys(_COLUMNS)]
    checks.append(("DIAGNOSES_ICD (HADM_ID, SEQ_NUM)", tm.diagnoses_icd(spark, d), ["HADM_ID", "SEQ_NUM"]))
    out = None
    for t, df, key in checks:
        part = Q.pk_violations(df, key).select(F.lit(t).alias("table"), _key_text(key).alias("key"), "count")
        out = part if out is None else out.unionByName(part)
    return out


_FK_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", '{'|'.join(cols)}' AS columns, '{parent}' AS parent, "
    f"(SELECT count(*) FROM {view} c WHERE {' AND '.join(f'c.{x} IS NOT NULL' for x in cols)} AND NOT EXISTS (SELECT 1 FROM "
    f"{_DECLARED[parent][1]} p WHERE {' AND '.join(f'p.{y} = c.{x}' for x, y in zip(cols, ys, strict=True))})) AS orphans"
    for t, _, view, cols, parent, ys in _references(_COLUMNS))
_FK_SQL += ("\nUNION ALL\nSELECT 'DIAGNOSES_ICD', 'HADM_ID', 'ADMISSIONS with deaths', (SELECT count(*) FROM r_diagnoses_icd c "
            "WHERE HADM_ID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r_admissions p WHERE p.HADM_ID = c.HADM_ID "
            "AND p.HOSPITAL_EXPIRE_FLAG = 1))")


@query("fk_orphans", sql=_FK_SQL)
def fk_orphans(spark, d):
    """Orphans of every declared foreign key between role tables, and of a filtered parent."""
    checks = [(t, frame(spark, d), list(cols), parent, _DECLARED[parent][0](spark, d), list(ys))
              for t, frame, _, cols, parent, ys in _references(_COLUMNS)]
    checks.append(("DIAGNOSES_ICD", tm.diagnoses_icd(spark, d), ["HADM_ID"], "ADMISSIONS with deaths",
                   tm.admissions(spark, d).filter(F.col("HOSPITAL_EXPIRE_FLAG") == 1), ["HADM_ID"]))
    out = None
    for t, df, cols, name, parent, ys in checks:
        part = Q.fk_orphans(df, parent, cols, ys).agg(F.count(F.lit(1)).alias("orphans")).select(
            F.lit(t).alias("table"), F.lit("|".join(cols)).alias("columns"), F.lit(name).alias("parent"), "orphans")
        out = part if out is None else out.unionByName(part)
    return out


def _nn_cols(table: str) -> list[str]:
    return [c for c in table_spec(table).not_null_columns() if c in _COLUMNS[table]]


@query("not_null_violations", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM {v}"
    for t, (_, v) in _DECLARED.items() for c in _nn_cols(t)))
def not_null_violations(spark, d):
    """Null count of every declared NOT NULL column of each role table."""
    out = None
    for t, (frame, _) in _DECLARED.items():
        if cols := _nn_cols(t):
            part = Q.not_null_violations(frame(spark, d), cols).select(F.lit(t).alias("table"), "*")
            out = part if out is None else out.unionByName(part)
    return out


_REGISTRY_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS declared, {str(f.nullable).lower()} AS nullable, "
    f"{str(f.name in _COLUMNS[t]).lower()} AS present, (SELECT count({f.name if f.name in _COLUMNS[t] else 'NULL'}) FROM {v}) AS filled"
    for t, (_, v) in _DECLARED.items() for f in schema_of(t).fields)


@query("schema_registry", sql=_REGISTRY_SQL)
def schema_registry(spark, d):
    """Declared columns of every role table against the columns read, with their non-null counts."""
    out = None
    for t, (frame, _) in _DECLARED.items():
        df, fields = frame(spark, d), schema_of(t).fields
        one = df.agg(*[(F.count(F.col(f.name)) if f.name in df.columns else F.lit(0).cast("long")).alias(f"c{i}") for i, f in enumerate(fields)])
        rows = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', {str(f.nullable).lower()}, {str(f.name in df.columns).lower()}, c{i}"
                         for i, f in enumerate(fields))
        part = one.selectExpr(f"'{t}' AS table", f"stack({len(fields)}, {rows}) AS (column, declared, nullable, present, filled)")
        out = part if out is None else out.unionByName(part)
    return out


@query("join_row_audit", sql="""
SELECT 0 AS step, 'icustays' AS stage, count(*) AS rows FROM r_icustays
UNION ALL SELECT 1, 'joined_admissions', count(*) FROM r_icustays s LEFT JOIN r_admissions a
  ON s.SUBJECT_ID = a.SUBJECT_ID AND s.HADM_ID = a.HADM_ID
UNION ALL SELECT 2, 'joined_patients', count(*) FROM r_icustays s LEFT JOIN r_admissions a
  ON s.SUBJECT_ID = a.SUBJECT_ID AND s.HADM_ID = a.HADM_ID LEFT JOIN r_patients p ON s.SUBJECT_ID = p.SUBJECT_ID""")
def join_row_audit(spark, d):
    from stayflow.operators.relational import join_patient, join_stay_admission
    s = tm.icustays(spark, d)
    sa = join_stay_admission(s, tm.admissions(spark, d))
    return Q.join_row_audit({"icustays": s, "joined_admissions": sa,
                             "joined_patients": join_patient(sa, tm.patients(spark, d))})

"""Projections, filters and joins (survey sections 2.3 and 2.4).

Every operator is ``DataFrame(s) -> DataFrame`` with column names as arguments
(defaulting to the clinical names).  Nothing here collects data to the driver.
Broadcast policy: no ``broadcast`` hint on a side that grows with the data.
Dimension joins are left to the planner and AQE, which broadcast a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
split the partitions of hot keys.  Joins whose hot keys AQE cannot split are salted
in proportion to the rows of those keys (:func:`salted`).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.timefn import hours_between


# ------------------------------------------------------------------ helpers

def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# ------------------------------------------------------------------ projections

def project_columns(df: DataFrame, columns: Sequence[str] | None = None,
                    exclude: Sequence[str] = ()) -> DataFrame:
    """``select`` by name list, or all-but ``exclude``."""
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in set(exclude)]
    return df.select(*cols)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


def select_available(df: DataFrame, wanted: Sequence[str], target: str | None = None) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist (+ target); return (frame, missing names).
    Raises when the target column is absent."""
    present = [c for c in wanted if c in df.columns]
    missing = [c for c in wanted if c not in df.columns]
    if target is not None:
        if target not in df.columns:
            raise ValueError(f"Target column '{target}' not found")
        present = present + [target]
    return df.select(*present), missing


# ------------------------------------------------------------------ filters

def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = None
    for c in _as_list(columns):
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond) if cond is not None else df


def filter_item_set(df: DataFrame, items: Sequence, item_col: str = "ITEMID") -> DataFrame:
    """``item IN (...)`` -- pushed into the Parquet scan as an ``In`` filter."""
    return df.filter(F.col(item_col).isin(list(items)))


def filter_value_bounds(df: DataFrame, col: str, low: float | None = None, high: float | None = None,
                        low_inclusive: bool = False, high_inclusive: bool = False) -> DataFrame:
    """``low < col < high`` (each bound optional, open by default)."""
    c = F.col(col)
    cond = c.isNotNull()
    if low is not None:
        cond = cond & ((c >= low) if low_inclusive else (c > low))
    if high is not None:
        cond = cond & ((c <= high) if high_inclusive else (c < high))
    return df.filter(cond)


def filter_time_window(df: DataFrame, time_col: str, start_col: str, hours: float = 24,
                       out_col: str | None = "hours_from_intime") -> DataFrame:
    """Keep rows with 0 <= (time - start) in hours <= ``hours`` (both ends inclusive)."""
    h = hours_between(F.col(time_col), F.col(start_col))
    if out_col:
        return df.withColumn(out_col, h).filter(F.col(out_col).between(0, hours))
    return df.filter(h.between(0, hours))


def filter_source_system(df: DataFrame, source: str = "carevue", col: str = "DBSOURCE") -> DataFrame:
    return df.filter(F.col(col) == F.lit(source))


def filter_sql_expression(df: DataFrame, predicate: str) -> DataFrame:
    """String predicate such as ``"icu_stays_count > 1"``."""
    return df.filter(predicate)


def filter_like_ci(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """``lower(col) LIKE pattern`` (pattern given in lower case)."""
    return df.filter(F.lower(F.col(col)).like(pattern))


def filter_regex_prefix(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """``col RLIKE pattern`` (anchor with ``^`` for a prefix)."""
    return df.filter(F.col(col).rlike(pattern))


def fill_null_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=[c for c in columns if c in df.columns])


def clip_floor(col: Column, floor_value: float = 0.0) -> Column:
    """``greatest(col, floor)`` (NULL stays NULL)."""
    return F.when(col.isNull(), F.lit(None)).otherwise(F.greatest(col, F.lit(floor_value)))


# ------------------------------------------------------------------ joins

def join_stay_admission(stays: DataFrame, admissions: DataFrame,
                        keys: Sequence[str] = ("SUBJECT_ID", "HADM_ID")) -> DataFrame:
    """Stays left-joined to admissions (USING semantics: one copy of each key)."""
    return stays.join(admissions, list(keys), "left")


def join_patient(df: DataFrame, patients: DataFrame, key: str = "SUBJECT_ID",
                 drop: Sequence[str] = ("DOD_HOSP", "DOD_SSN")) -> DataFrame:
    """... left-joined to patients; redundant death-date columns dropped."""
    return drop_columns(df.join(patients, key, "left"), drop)


def join_code_dictionary(diagnoses: DataFrame, dictionary: DataFrame, key: str = "ICD9_CODE",
                         drop: Sequence[str] = ("SHORT_TITLE",)) -> DataFrame:
    """Diagnoses left-joined to the code dictionary; short title dropped."""
    return drop_columns(diagnoses.join(dictionary, key, "left"), drop)


def join_fanout_diagnoses(stays: DataFrame, diagnoses: DataFrame,
                          keys: Sequence[str] = ("SUBJECT_ID", "HADM_ID")) -> DataFrame:
    """Stay x diagnoses (1:N) left join: stays without a diagnosis are kept once.
    Built as a salted inner join plus an anti join (:func:`salted_left_join`), so an
    admission with a large share of all diagnoses is spread over several tasks."""
    return salted_left_join(stays, diagnoses, list(keys))


def join_item_dictionary(events: DataFrame, items: DataFrame, key: str = "ITEMID") -> DataFrame:
    """Events left-joined to the item dictionary (AQE splits the few items that carry
    most chart events when the dictionary is too large to broadcast)."""
    return events.join(items, key, "left")


def join_inner_chain(stays: DataFrame, patients: DataFrame, admissions: DataFrame,
                     patient_key: str = "SUBJECT_ID", admission_key: str = "HADM_ID") -> DataFrame:
    """stays JOIN patients JOIN admissions (inner).  Only the key columns are shared."""
    a = admissions.drop(*[c for c in admissions.columns if c in stays.columns and c != admission_key])
    p = patients.drop(*[c for c in patients.columns if c in stays.columns and c != patient_key])
    return stays.join(p, patient_key, "inner").join(a, admission_key, "inner")


def join_events_to_stay(events: DataFrame, stays: DataFrame, stay_col: str = "ICUSTAY_ID",
                        intime_col: str = "INTIME") -> DataFrame:
    """Events inner-joined to (stay, INTIME); the stay side is projected first and the
    join is salted (:func:`salted_join`), so a hot stay is spread over several tasks."""
    return salted_join(events, stays.select(stay_col, intime_col), stay_col,
                       [c for c in events.columns if c != stay_col])


def join_semi_examples(stays: DataFrame, entities: DataFrame, n: int = 3, key: str = "SUBJECT_ID",
                       order: Sequence[str] = ("SUBJECT_ID", "INTIME"),
                       columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the first ``n`` entities (by key) -- a bounded ``limit`` semi-joined back."""
    first = entities.select(key).orderBy(key).limit(n)
    out = stays.join(F.broadcast(first), key, "left_semi")  # bounded: n rows
    if columns is not None:
        out = out.select(*columns)
    return out.orderBy(*order)


def join_feature_blocks(base: DataFrame, blocks: Sequence[DataFrame], key: str = "ICUSTAY_ID") -> DataFrame:
    """base LEFT JOIN block1 LEFT JOIN block2 ... on one key."""
    out = base
    for b in blocks:
        out = out.join(b, key, "left")
    return out


def interval_join(events: DataFrame, stays: DataFrame, key: str, time_col: str, start_col: str,
                  window_hours: float, parts: int | None = None) -> DataFrame:
    """Events joined to every stay with the same ``key`` whose window
    ``[start, start + window_hours]`` (hour-exact, both ends inclusive) holds the event.

    A bucketed range join: the time axis is cut into buckets of the window width;
    an event carries its one bucket, a stay is exploded into the (at most two)
    buckets its window spans, and the equi-join runs on (key, bucket) before the
    exact window filter.  An event therefore only meets stays whose window overlaps
    its bucket -- not every stay of a key with many stays -- and each matching pair
    is produced exactly once.
    """
    width = max(1, int(round(window_hours * 3600)))
    ev = events.withColumn("_bucket", F.floor(F.unix_timestamp(F.col(time_col)) / F.lit(width)))
    end = F.unix_timestamp(F.col(start_col)) + F.lit(width)
    first = F.floor(F.unix_timestamp(F.col(start_col)) / F.lit(width))
    st = stays.withColumn("_bucket", F.explode(F.sequence(first, F.floor(end / F.lit(width)))))
    # a key whose events share one bucket is still spread over several tasks
    joined = salted_join(ev, st, [key, "_bucket"], events.columns, parts).drop("_bucket")
    t, s = F.col(time_col), F.col(start_col)
    return joined.filter((t >= s) & (t <= s + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(width))))


# A key with more than 1 / HEAVY_PARTS of the rows is heavy; so at most HEAVY_PARTS keys are.
HEAVY_PARTS = 1024


#: Rows that one task groups or joins by key.
TASK_ROWS = 1 << 20


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as keep about :data:`TASK_ROWS` of ``rows`` in each, so that the
    memory of a task does not grow with the table; small tables stay as they are.  A following
    grouping or join on the keys needs no other exchange."""
    if rows <= TASK_ROWS:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *keys)


def heavy_keys(rows: DataFrame, keys: Sequence[str], parts: int | None = None) -> list[tuple]:
    """(key values .., salts) of the heavy keys: into how many parts each is cut, so that a part
    has about ``1 / parts`` of all rows.  At most ``parts`` entries, whatever the data."""
    parts = HEAVY_PARTS if parts is None else parts
    count = dealt(rows.select(*keys), keys, rows.count()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, most = count.agg(F.sum("_n"), F.max("_n")).first()
    if not total or most * parts <= total:
        return []
    return [(*r[:-1], -(-r["_n"] * parts // total)) for r in count.filter(F.col("_n") * parts > total).collect()]


def salted(many: DataFrame, one: DataFrame, keys: Sequence[str], hash_cols: Sequence[str],
           parts: int | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the columns to join them on: the keys, and ``_salt`` where keys are heavy.

    Rows of a heavy key on the ``many`` side get a salt from a hash of their own columns
    (a retried task rebuilds the same rows), and the ``one`` side repeats that key once per
    salt.  All other keys have salt 0 on both sides, so nothing else is repeated.
    """
    keys = list(keys)
    found = [h for h in heavy_keys(many, keys, parts) if None not in h]
    if not found:
        return many, one, keys
    names = [f"_h{i}" for i in range(len(keys))]
    fields = ", ".join([f"{n} {many.schema[k].dataType.simpleString()}" for n, k in zip(names, keys, strict=True)] + ["_salts int"])
    heavy = F.broadcast(many.sparkSession.createDataFrame(found, fields))  # at most ``parts`` rows

    def marked(df):
        on = None
        for n, k in zip(names, keys, strict=True):
            c = df[k] == heavy[n]
            on = c if on is None else on & c
        return df.join(heavy, on, "left").drop(*names)

    salts = F.coalesce("_salts", F.lit(1))
    return (marked(many).withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in hash_cols]), salts).cast("int")).drop("_salts"),
            marked(one).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"), [*keys, "_salt"])


def salted_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` for a right side with heavy keys.

    Spark can neither broadcast the preserved side of a left join nor split skew on
    its right side, so the result is built from two parts: a salted inner join, and the
    left rows whose key has no right row (``left_anti`` against the distinct right keys),
    padded with NULL right columns.
    """
    keys = list(keys)
    rcols = [c for c in right.columns if c not in keys]
    r, l, on = salted(right, left, keys, right.columns, parts)
    rows = max(left.count(), right.count())
    matched = dealt(l, on, rows).join(dealt(r, on, rows), on, "inner").drop("_salt")
    unmatched = dealt(left, keys, rows).join(dealt(right.select(*keys), keys, rows).distinct(), keys, "left_anti")
    rtypes = {f.name: f.dataType for f in right.schema.fields}
    unmatched = unmatched.select("*", *[F.lit(None).cast(rtypes[c]).alias(c) for c in rcols])
    return matched.unionByName(unmatched.select(*matched.columns))


def salted_join(events: DataFrame, stays: DataFrame, key: str | Sequence[str], hash_cols: Sequence[str],
                parts: int | None = None) -> DataFrame:
    """Inner join of many events to few rows per key, robust to keys that hold a large share
    of the events (:func:`salted`).  A following ``groupBy(key)`` aggregates partially in
    the salted tasks before its own shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    ev, st, on = salted(events, stays, keys, hash_cols, parts)
    return ev.join(st, on, "inner").drop("_salt")

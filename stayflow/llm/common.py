"""Columns and tables that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.session import apply_runtime_conf, ensure_checkpoint_dir

#: A word is a maximal run of other code points than space and \t \n \v \f \r.
SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"
#: Sort key of a null document id: before every other id.
NULL_ID = -(1 << 63)


#: Rows of an Arrow batch: whole documents are long, and a batch is held twice by the JVM and twice by Python.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators on whole texts."""
    apply_runtime_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Folders of the tables staged inside :func:`passing`.
_PASSING: ContextVar[list | None] = ContextVar("passing", default=None)


def staged(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """``df`` written once as Parquet under the cluster's shared checkpoint folder and
    read back: cuts the lineage, so lost executors cost no recomputation of it.  Inside
    :func:`passing` it is deleted at the end, unless it is ``lasting``."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base}/stayflow-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if not lasting and (own := _PASSING.get()) is not None:
        own.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end; for steps whose result is written by then."""
    token = _PASSING.set(own := [])
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in own:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def words(text: Column) -> Column:
    """Words of ``text`` (null: none)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATOR_RUN))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other code point as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text (null: of the empty text) modulo ``k``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(k)).cast("int")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``_id`` (a null id sorts first), ``_tie`` and ``_text`` for operators on whole texts.

    Rows that share an id are told apart, and ordered, by ``_tie``, a hash of the
    text; rows equal in id and text share the key and are judged as one document.
    Other columns are left out, so clashing names cannot matter; those in ``keep`` come
    as ``_keep_<name>``.
    """
    i, t = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(i.alias("doc_id"), F.coalesce(i, F.lit(NULL_ID)).alias("_id"),
                       F.xxhash64(t, i.isNull()).alias("_tie"), t.alias("_text"),
                       *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep])


#: A blocked Bloom filter is a table of at most BLOOM_BLOCKS rows of eight 64-bit words, so
#: its broadcast has a fixed bound (2.4 MB); more keys only let more false hits through.
BLOOM_BLOCKS = 1 << 15
LANES = 8


def place(df: DataFrame, keys: Sequence[str], blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """``df`` plus ``_block`` (of the keys' hash) and ``_m0`` .. ``_m7``, a one-bit mask for each word of the block."""
    k = ", ".join(f"`{c}`" for c in keys)
    df = df.withColumn("_block", F.expr(f"cast(pmod(xxhash64({k}), {blocks}) AS int)"))
    df = df.withColumn("_bits", F.expr(f"xxhash64({k}, 'bits')"))
    for j in range(LANES):
        df = df.withColumn(f"_m{j}", F.expr(f"shiftleft(1L, cast(shiftright(_bits, {6 * j}) & 63 AS int))"))
    return df.drop("_bits")


def bloom_blocks(listed: DataFrame, keys: Sequence[str], blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """Rows (``_block``, ``_b0`` .. ``_b7``), at most ``blocks`` of them, pre-combined before the shuffle."""
    return place(listed, keys, blocks).groupBy("_block").agg(*[F.bit_or(f"_m{j}").alias(f"_b{j}") for j in range(LANES)])


def maybe_listed(df: DataFrame, keys: Sequence[str], listed: DataFrame, listed_keys: Sequence[str] | None = None,
                 blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """Rows of ``df`` whose keys may be in ``listed``: all that are, and few others.  An exact join must follow."""
    bits = " AND ".join(f"(_m{j} & _b{j}) = _m{j}" for j in range(LANES))
    table = bloom_blocks(listed, listed_keys or keys, blocks)
    return place(df, keys, blocks).join(F.broadcast(table), "_block").filter(bits).select(*df.columns)


def most_frequent(counts: DataFrame, limit: int):
    """At most ``limit`` rows, those with the largest ``n`` (all of one ``n`` or none), most frequent first.

    The smallest ``n`` that counts is read from the number of words of each ``n``, so the
    words themselves are not sorted.
    """
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(limit).toPandas()
    enough = sizes[sizes["words"].cumsum() <= limit]["n"]
    if not len(enough):
        return counts.limit(0).toPandas()
    return counts.filter(F.col("n") >= int(enough.min())).toPandas().sort_values(["n", "word"], ascending=[False, True], ignore_index=True)

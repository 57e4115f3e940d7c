"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate (target characters / available characters);
a hash-seeded uniform number per document is inverted through the Poisson
distribution of that mean, the document is exploded by the resulting count, and the
copies are shuffled globally by a hash key.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import staged

#: Exponent of the default target weights: a source weighs its characters to this power.
TEMPERATURE = 0.5
#: Target size over available size.
EPOCHS = 1.0
SEED = "mix-1"
#: Hash digits that make a uniform number (52 bits, exact in a double).
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts joined by ``|``."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS), 16, 10).cast("double") / float(16 ** DIGITS)


def poisson_count(u: Column, rate: Column) -> Column:
    """Smallest n with u < P(X <= n), X Poisson with mean ``rate``.

    Terms are summed as exponents, so large means do not underflow; the sum runs to
    ten deviations above the mean, beyond what 52 bits can tell from 1.  ``u`` is read at
    every step: give a column of a frame below, not the expression that computes it.
    """
    top = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct((-rate).alias("lp"), F.exp(-rate).alias("cdf"), (u >= F.exp(-rate)).cast("int").alias("n"))

    def step(s, k):
        lp = s["lp"] + F.ln(rate) - F.ln(k.cast("double"))
        cdf = s["cdf"] + F.exp(lp)
        return F.struct(lp.alias("lp"), cdf.alias("cdf"), (s["n"] + (u >= cdf).cast("int")).alias("n"))

    n = F.aggregate(F.sequence(F.lit(1), top), start, step, lambda s: s["n"])
    return F.when(rate > 0, n).otherwise(F.lit(0))


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, epochs: float = EPOCHS,
                 temperature: float = TEMPERATURE, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per source: ``_src``, ``_chars`` and ``_rate``.

    ``weights`` names targets (others weigh 0); without it a source weighs its
    characters to the power ``temperature``.  Null sources are a source of their own.
    Sources without characters have rate 0.
    """
    sizes = docs.groupBy(F.col(f"`{source_col}`").alias("_src")).agg(
        F.coalesce(F.sum(F.length(F.col(f"`{text_col}`"))), F.lit(0)).cast("double").alias("_chars"))
    if weights is None:
        weight = F.pow(F.col("_chars"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("_src").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    sizes = sizes.withColumn("_weight", F.when(F.col("_chars") > 0, weight).otherwise(F.lit(0.0)))
    total, weights_sum = (sizes.select(F.sum(c)).scalar() for c in ("_chars", "_weight"))
    sizes = sizes.withColumns({"_all": total, "_weights": weights_sum})
    return sizes.select(
        "_src", "_chars", F.when((F.col("_chars") > 0) & (F.col("_weights") > 0),
                                 F.lit(float(epochs)) * F.col("_all") * F.col("_weight") / F.col("_weights") / F.col("_chars"))
        .otherwise(F.lit(0.0)).alias("_rate"))


def mix_sources(docs: DataFrame, weights: Mapping[str | None, float] | None = None, epochs: float = EPOCHS,
                temperature: float = TEMPERATURE, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", shuffle: bool = True) -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, plus ``_copy`` (from 1), ``_rate``
    and ``_key`` (the shuffle key, by which the result is globally ordered).

    The draw depends on seed, id and a hash of the text alone: repeated rows get equal
    counts, and any partitioning gives the same result.  Null ids and texts draw as empty
    ones (a null text adds no size to its source but is drawn at its rate).  The join to
    the rates is left to the planner: it broadcasts them only under Spark's own
    size limit, else AQE splits a hot source.  Other columns of ``docs`` may have any name;
    ``_copy``, ``_rate`` and ``_key`` of its own are replaced.  An empty table gives an empty result.
    """
    docs = docs.drop("_copy", "_rate", "_key")  # added ones replace these
    # inside, the columns of docs have names of their own, so none can clash with those made here
    given, names = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    own = dict(zip(given, names, strict=True))
    id_col, source_col, text_col = own[id_col], own[source_col], own[text_col]
    docs = docs.toDF(*names)
    # written first, so the planner knows its size when it plans the join
    rates = staged(source_rates(docs, weights, epochs, temperature, source_col, text_col).select("_src", "_rate"), "mix-rates")
    out = docs.join(rates, F.col(source_col).eqNullSafe(F.col("_src")))
    # every text is hashed once; the draw and the keys are made of that hash
    out = out.withColumn("_hash", F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    ident = [F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("_hash")]
    out = out.withColumn("_draw", uniform(*ident))
    # an array of the length of the count: rows that draw 0 leave at the explode, without a filter that repeats the draw
    copies = F.array_repeat(F.lit(1), poisson_count(F.col("_draw"), F.col("_rate")).cast("int"))
    out = out.select(*names, "_rate", "_hash", F.posexplode(copies).alias("_at", "_one"))
    out = out.select(*names, "_rate", (F.col("_at") + 1).cast("long").alias("_copy"), "_hash")
    out = out.withColumn("_key", F.md5(F.concat_ws("|", *ident, F.col("_copy").cast("string")))).select(
        *[F.col(n).alias(c) for n, c in zip(names, given, strict=True)], "_rate", "_copy", "_key")
    if not shuffle:
        return out
    # keys are uniform hashes, so equal ranges of their leading digits are equal parts and need no sample
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.lit(parts)
    return out.repartitionById(parts, F.shiftright(part, 32).cast("int")).sortWithinPartitions("_key", "_copy")


def oracle_sql(source: str = "documents", epochs: float = EPOCHS, temperature: float = TEMPERATURE, seed: str = SEED) -> str:
    """DuckDB CTEs ending in ``mixed``: the rows of ``source`` with rate, copy and shuffle_key."""
    ident = f"'{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))"
    return f"""sizes AS (SELECT source AS src, coalesce(sum(length(text)), 0)::DOUBLE AS chars FROM {source} GROUP BY 1),
weighted AS (SELECT *, CASE WHEN chars > 0 THEN pow(chars, {temperature!r}) ELSE 0 END AS weight FROM sizes),
rates AS MATERIALIZED (SELECT src, CASE WHEN chars > 0 THEN {epochs!r}::DOUBLE * (SELECT sum(chars) FROM weighted) * weight
  / (SELECT sum(weight) FROM weighted) / chars ELSE 0 END AS rate FROM weighted),
steps AS (SELECT src, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM rates WHERE rate > 0),
cdfs AS MATERIALIZED (SELECT src, rate, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY src ORDER BY k) AS cdf FROM steps),
drawn AS MATERIALIZED (SELECT row_number() OVER () AS rid, *, {ident} AS ident FROM {source}),
uni AS (SELECT rid, source, ('0x' || substr(md5(ident), 1, {DIGITS}))::BIGINT / {float(16 ** DIGITS)!r}::DOUBLE AS u FROM drawn),
counts AS (SELECT rid, rate, count(*) FILTER (u >= cdf) AS n FROM uni JOIN cdfs ON source IS NOT DISTINCT FROM src GROUP BY rid, rate),
mixed AS (SELECT drawn.* EXCLUDE (rid, ident), rate, copy, md5(ident || '|' || copy::VARCHAR) AS shuffle_key
  FROM (SELECT rid, rate, unnest(range(1, n + 1)) AS copy FROM counts) JOIN drawn USING (rid))"""

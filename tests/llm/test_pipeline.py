"""The pipeline against a plain Python version of its five stages."""

import hashlib
import math
import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stayflow.llm import mixing

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])


def corpus():
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(900)]

    def text(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))
    passage, item = text(40), text(30)
    docs = [text(rnd.randint(30, 90)) for _ in range(70)]
    docs += [docs[3], docs[4] + " " + vocab[0], docs[5].upper()]           # copies and a near copy
    docs += [text(30) + " " + passage + " " + text(5 + i) for i in range(4)]  # a shared passage
    half = item.split()
    docs += [text(20) + " " + item, " ".join(half[15:]) + " " + text(15) + " " + " ".join(half[:15])]
    docs += ["ab cd", "", None, "spam!! " * 40, *[" ".join(w + "###" for w in vocab[50 * i:50 * i + 60]) for i in range(8)]]
    rows = [(i, t, "en", f"s{i % 3}" if i % 10 else None, len(t or "")) for i, t in enumerate(docs)]
    return rows, [(1, item), (2, None)]


def near(rows):
    sets = {}
    for r in rows:
        w = r[1].lower().split()
        sets[r[0]] = {tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root[a], root[b]))
                root = {k: x if v == y else v for k, v in root.items()}
    return [r for r in rows if root[r[0]] == r[0]]


def covered(a, b, least=5):
    """Tokens of ``a`` under greedy tiles, trying every pair of positions again for each tile."""
    x, y, total = [False] * len(a), [False] * len(b), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not x[i + k] and not y[j + k]:
                    k += 1
                best = max(best, (k, -i, -j)) if k > best[0] else best
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return total
        x[i:i + k], y[j:j + k], total = [True] * k, [True] * k, total + k


def suffix(rows, k=100):
    seen, out = set(), []
    for r in sorted(rows):
        b = r[1].encode()
        gone = [False] * len(b)
        for p in range(len(b) - k + 1):
            if b[p:p + k] in seen:
                gone[p:p + k] = [True] * k
            seen.add(b[p:p + k])
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode()
        if left:
            out.append((r[0], left, r[2], r[3], len(left)))
    return out


def poisson(u, rate):
    n, lp, cdf = 0, -rate, math.exp(-rate)
    while u >= cdf and n < rate + 10 * math.sqrt(rate) + 20:
        n += 1
        lp += math.log(rate) - math.log(n)
        cdf += math.exp(lp)
    return n


def mix(rows):
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(r[1])
    weight = {s: c ** mixing.TEMPERATURE for s, c in size.items()}
    out = []
    for r in rows:
        rate = sum(size.values()) * weight[r[3]] / sum(weight.values()) / size[r[3]]
        ident = f"{mixing.SEED}|{r[0]}|{hashlib.md5(r[1].encode()).hexdigest()}"
        u = int(hashlib.md5(ident.encode()).hexdigest()[:13], 16) / 16 ** 13
        out += [(hashlib.md5(f"{ident}|{c}".encode()).hexdigest(), c, *r) for c in range(1, poisson(u, rate) + 1)]
    return [x[2:] for x in sorted(out)]


def test_against_plain_python(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "text", "lang", "source", "n_chars").collect()
    ids = len(rows)
    junk = set(range(ids - 12, ids))
    kept = suffix(near([r for r in rows if r[0] not in junk]))
    clean = [r for r in kept if covered(items[0][1].split(), r[1].replace("#", " ").lower().split()) < 0.5 * len(items[0][1].split())]
    assert ids - 14 not in {r[0] for r in clean} and len(kept) - len(clean) in (1, 2)
    assert [tuple(r) for r in got] == mix(clean)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clash = {c: F.lit("x") for c in ("_id", "_text", "_kept", "_bad", "_new", "_rate", "ranges", "new")}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumns(clash)
    some = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs away from it", "en", None, 65)], DOCS).withColumns(clash)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert out.collect() == []
        assert stage(spark, some, str(tmp_path)).collect() == some.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, some, str(tmp_path)).count() >= 0
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("rate", [0.01, 0.7, 3.0, 900.0])
def test_poisson_counts(spark, rate):
    df = spark.range(4000).select(mixing.poisson_count(mixing.uniform(F.lit("t"), F.col("id").cast("string")), F.lit(rate)).alias("n"))
    mean, var = df.agg(F.avg("n"), F.variance("n")).first()
    assert abs(mean - rate) < 5 * math.sqrt(rate / 4000) and abs(var - rate) < 0.2 * rate + 0.01

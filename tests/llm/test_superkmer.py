import hashlib
import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

from stayflow.llm.superkmer import dedup_substrings

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("_id", StringType())])


def brute(rows, k):
    docs = sorted({(i, t or "") for i, t in rows})
    seen, out = set(), {}
    for i, t in docs:
        w = t.encode().split()
        gone = set()
        mine = []
        for p in range(len(w) - k + 1):
            g = tuple(w[p:p + k])
            if g in seen:
                gone.update(range(p, p + k))
            seen.add(g)
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
        del mine
    return out


def corpus(seed=3, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}é" for i in range(12)]
    passage = [rnd.choice(vocab) for _ in range(40)]
    rows = []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([0, 3, 5, 30, 80]))]
        if i % 3 == 0:
            at = rnd.randint(0, len(w))
            w[at:at] = passage[rnd.randint(0, 10):rnd.randint(25, 40)]
        if i % 7 == 0:
            w = w + w
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(w)))
    rows.append((n, rows[3][1]))
    rows.append((n + 1, " the" * 3000))
    return rows


def test_against_brute_force(spark):
    rows = [*corpus(), (900, None), (901, ""), (902, " \n ")]
    for k, seed in ((5, 2), (20, 5)):
        df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(7)
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in dedup_substrings(df, k, seed).collect()}
        assert got == brute(rows, k)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(None, text), (1, text), (1, text), (2, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["n_removed"]) for r in dedup_substrings(df).collect())
    assert got == [(False, None, 0), (True, 1, 30), (True, 1, 30), (True, 2, 0)]
    assert dedup_substrings(spark.createDataFrame([], SCHEMA)).collect() == []

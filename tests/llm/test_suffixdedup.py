import hashlib
import random

import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stayflow.llm import induced
from stayflow.llm.suffixdedup import dedup_bytes, without_repeats

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("_id", StringType())])


@pytest.mark.parametrize("small,batch,memory", [(512, 48, 1 << 20), (0, 10 ** 9, 1 << 20), (512, 1, 3), (0, 10 ** 9, 3)])
def test_suffix_arrays(monkeypatch, small, batch, memory):
    monkeypatch.setattr(induced, "SMALL", small)
    monkeypatch.setattr(induced, "BATCH", batch)
    monkeypatch.setattr(induced.SuffixQueue.__init__, "__defaults__", (memory,))
    monkeypatch.setattr(induced.array, "__defaults__", (memory,))
    rnd = np.random.default_rng(5)
    for n in [1, 2, 3, *rnd.integers(4, 120, 60)]:
        t = rnd.integers(1, rnd.integers(2, 6), n)
        t = np.concatenate([t, t, t[:n // 2], [0]]).astype(np.uint16)
        whole = t.tolist()
        want = sorted(range(len(whole)), key=lambda i: whole[i:])
        agree = [0] + [next(k for k in range(len(whole)) if whole[a + k] != whole[b + k]) for a, b in zip(want, want[1:], strict=False)]
        for cap in (4, 10 ** 6):
            sa, lcp = induced.suffix_array(t, cap)
            assert sa.tolist() == want
            assert lcp.tolist() == [min(x, cap) for x in agree]


def brute(rows, k):
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows}):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - k + 1):
            g = b[p:p + k]
            if g in seen:
                gone[p:p + k] = True
            seen.add(g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def corpus(seed=1, n=50):
    rnd = random.Random(seed)
    def words(k):
        return " ".join("".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 6))) for _ in range(k))
    passage, rows = words(60), []
    for i in range(n):
        t = words(rnd.choice([0, 2, 20, 60]))
        if i % 3 == 0:
            cut = rnd.randint(0, 80)
            t = t[:20] + passage[cut:cut + rnd.randint(60, 200)] + t[20:]
        if i % 8 == 0:
            t = t + t[: len(t) // 2] + "x" + t
        rows.append((i, t))
    return [*rows, (n, rows[3][1]), (n + 1, rows[6][1] + "!"), (n + 2, "ab" * 400), (n + 3, None), (n + 4, "")]


def test_against_brute_force(spark):
    rows = corpus()
    for k, seed in ((20, 8), (100, 50)):
        df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(6)
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
               for r in dedup_bytes(df, k, seed).collect()}
        assert got == brute(rows, k)


def test_repeated_rows_null_ids_empty_table_and_stage(spark):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    rows = [(None, text), (1, text), (1, text), (2, None), (3, "short")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in dedup_bytes(df).collect())
    n = len(text)
    assert got == [(0, 0), (1, n), (1, n), (2, 0), (3, 0)]
    left = {r["doc_id"]: r["text"] for r in without_repeats(df).collect()}
    assert left == {None: text, 2: None, 3: "short"}
    assert without_repeats(df).columns == df.columns
    assert dedup_bytes(spark.createDataFrame([], SCHEMA)).collect() == []

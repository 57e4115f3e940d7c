"""The toxicity classifier's counts, scores and ties against plain Python."""

import math
import random

import numpy as np

from stayflow.llm import toxicity


def plain_bucket(gram):
    h = 0x9E3779B1 * len(gram) & 0xFFFFFFFF
    for c in gram:
        h = (h + ord(c)) * 0x85EBCA6B & 0xFFFFFFFF
        h ^= h >> 15
    return h & (toxicity.BUCKETS - 1)


def plain_buckets(text):
    folded = " ".join((text or "").lower().split())
    if not folded:
        return set()
    folded = f" {folded} "
    return {plain_bucket(folded[i:i + n]) for n in (3, 4, 5) for i in range(len(folded) - n + 1)}


def corpus():
    rnd = random.Random(6)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7)))
    rows = [(i, " ".join(word("abcdé中" if i % 3 else "xyzXYZ") for _ in range(rnd.randint(0, 30))), int(i % 3 == 0)) for i in range(150)]
    return [*rows, (500, None, 0), (501, "", 1), (502, rows[0][1], rows[0][2]), (503, "a\n\tb", 0), (504, "unlabelled", None), (505, "odd", 7)]


def test_ngrams_and_counts(spark):
    rows = corpus()
    for _, t, _ in rows:
        assert set(toxicity.ngram_ids(t or "").tolist()) == plain_buckets(t)
    known = [(i, t, y) for i, t, y in rows if y in (0, 1)]
    df = spark.createDataFrame(known, "doc_id long, text string, toxic long").repartition(5)
    want = {(-1, y): sum(k == y for _, _, k in known) for y in (0, 1)}
    for _, t, y in known:
        for b in plain_buckets(t):
            want[b, y] = want.get((b, y), 0) + 1
    got = {(r["bucket"], r["label"]): r["n"] for r in toxicity.count_table(df, "text", "toxic").collect()}
    assert got == want


def test_chunks_of_long_texts_overlap(monkeypatch):
    text = corpus()[3][1] * 3
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    assert set(toxicity.ngram_ids(text).tolist()) == plain_buckets(text)


def test_scores_and_ties(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, toxic long, score string").repartition(5)
    weights, intercept = toxicity.train(df)
    assert np.count_nonzero(weights) > 10
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, weights, intercept).collect()}
    for i, t, _ in rows:
        z = sum(float(weights[b]) for b in plain_buckets(t)) + intercept
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-9
    assert got[500] == got[501]  # null and empty: the intercept alone
    again = toxicity.train(df.repartition(2))
    assert np.array_equal(again[0], weights) and again[1] == intercept
    tie = toxicity.score(df, np.zeros(toxicity.BUCKETS, np.float32), 0.0).select("score").distinct().collect()
    assert [r["score"] for r in tie] == [0.5]  # exactly 0.5: predicted as 1 by the contract's >=

import math
import random
import uuid
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stayflow.llm import lm
from stayflow.llm.common import keyed

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("score", StringType())])


def vocabulary():
    return lm.Vocabulary([b"a", b"b", b"c"], np.array([9, 5, 2]), 4, 30, 9)


def random_net(scale=0.5):
    net = lm.Net.start(vocabulary())
    rnd = np.random.default_rng(3)
    return lm.Net({k: (x.astype(np.float64) + (rnd.standard_normal(x.shape) * scale if k not in ("bc", "bw") else 0)) for k, x in net.p.items()})


def test_gradient_matches_differences():
    net = random_net()
    rnd = np.random.default_rng(1)
    target = rnd.choice([0, 1, 2, 3, lm.VOCAB], (3, 6))
    start = rnd.random((3, 6)) < 0.3
    ids = np.where(start, lm.VOCAB + 1, np.roll(target, 1, 1))
    mask = np.ones((3, 6), bool)
    mask[2, 4:] = False
    h = rnd.standard_normal((3, lm.HIDDEN)) * 0.1

    def loss(p):
        return lm.Net(p).gradient(ids, target, start, mask, h)[2] / mask.sum()

    g, _, _ = net.gradient(ids, target, start, mask, h)
    for k in net.p:
        flat = np.abs(g[k]).ravel()
        for at in np.argsort(-flat)[:4]:
            up, down = ({n: x.copy() for n, x in net.p.items()} for _ in range(2))
            up[k].ravel()[at] += 1e-4
            down[k].ravel()[at] -= 1e-4
            want = (loss(up) - loss(down)) / 2e-4
            assert abs(want - g[k].ravel()[at]) < 2e-3 * max(0.05, abs(want)), k


def test_probabilities_sum_to_one_and_state_is_carried():
    net = random_net()
    states = np.random.default_rng(2).standard_normal((5, lm.HIDDEN))
    total = sum(np.exp(net.log_probs(states, np.full(5, y))) for y in (0, 1, 2, 3, lm.VOCAB))
    assert np.allclose(total, 1, atol=1e-5)
    rnd = np.random.default_rng(4)
    texts = [rnd.integers(0, 4, n) for n in (70, 3, 1, 40, 8)]
    alone = []
    for t in texts:
        ids = np.concatenate([[lm.VOCAB + 1], t[:-1]])[None]
        start = np.zeros(ids.shape, bool)
        start[0, 0] = True
        states, _ = net.steps(ids, start, np.zeros((1, lm.HIDDEN)))
        alone.append(net.log_probs(states[0], t).sum())
    lanes, got, h = lm.Lanes(texts, 2), np.zeros(5), np.zeros((2, lm.HIDDEN))
    for n, at, mask in lanes.windows(7):
        states, h = net.steps(lanes.ids[at], lanes.start[at] & mask, h[:n])
        got += np.bincount(lanes.text[at[mask]], net.log_probs(states[mask], lanes.target[at[mask]]), 5)
    assert np.allclose(got, alone, atol=1e-4)


def test_counts_and_base_score(spark, monkeypatch):
    monkeypatch.setattr(lm.learn_vocabulary, "__defaults__", (3,))
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("the The of xé q0 q1 q2 q3 q4".split()) for _ in range(rnd.choice([0, 1, 9, 60])))) for i in range(80)]
    rows += [(900, None), (901, ""), (902, "never seen \n words"), (5, rows[5][1]), (None, "the of")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(4)
    train = df.filter(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) != 2)
    tokens = [((t or "").lower().split() + ["\n"], i) for i, t in rows]
    count = Counter(w for t, i in tokens if zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2 for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted(((i is None, i), len(t), sum(w in count for w in t), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 8))
                  for t, i in tokens)
    out = lm.score(df, train).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 8)) for r in out) == want
    assert {r["train_tokens"] for r in out} == {n}
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    empty = lm.score(df.limit(3), train.limit(0)).collect()
    assert len(empty) == 3 and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in empty)
    assert lm.score(df.limit(0), train).collect() == []


def test_every_training_document_is_learned_once(spark, monkeypatch, tmp_path):
    inner = lm._train

    def watched(shared_vocabulary, shared_net):
        run = inner(shared_vocabulary, shared_net)

        def watch(batches):
            def seen():
                for b in batches:
                    (tmp_path / uuid.uuid4().hex).write_text("\n".join(b.column(0).to_pylist()))
                    yield b
            yield from run(seen())

        return watch

    monkeypatch.setattr(lm, "_train", watched)
    texts = [f"q{i} the of q{i}" for i in range(120)]
    docs = keyed(spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3), "doc_id", "text")
    lm.train(docs, vocabulary())
    assert sorted(t for p in tmp_path.iterdir() for t in p.read_text().split("\n")) == sorted(texts)

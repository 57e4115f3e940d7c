"""Language-model scoring: a gated recurrent network with a class-factored output.

Counts of every token of every training document come from one shuffle.  The network
predicts the VOCAB most frequent tokens (class by class) and, as one further class, the
rest; a token of the rest gets its smoothed share of the rest's counts, so a text's
probability is that of the whole text.  Training is truncated backpropagation in numpy
inside tasks, once over every training document; each round takes its share of them, and
after it the tasks' weights are averaged by Spark.  Scoring carries the state
across windows through whole documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import keyed, most_frequent, staged
from stayflow.llm.vec import PART, Words, expand, pieces

#: Tokens that the network tells apart, in classes of CLASS; the end token is one of them.
VOCAB = 2048
CLASS = 32
#: Words whose counts are looked up in memory (their broadcast is bounded by this); others are joined.
FREQUENT = 1 << 16
EMBED, HIDDEN = 16, 24
#: Rounds of training; each takes its hash slice of the training documents, together they take all.
ROUNDS = 3
TRAIN_LANES, TRAIN_WINDOW = 32, 16
SCORE_LANES, SCORE_WINDOW = 512, 32
#: Bytes of text that are scored together.
SCORE_BYTES = 24 << 20
RATE = 0.01
SEED = 7


@dataclass
class Vocabulary:
    """``words``: frequent words, most frequent first; ``counts`` theirs; totals over all training tokens."""
    words: list[bytes]
    counts: np.ndarray
    ends: int
    tokens: int
    distinct: int

    @property
    def known(self) -> int:
        """Words that the network tells apart."""
        return min(VOCAB - 1, len(self.words))

    @property
    def rest(self) -> tuple[int, int]:
        """(tokens, distinct tokens) outside the network's words."""
        inside = int(self.counts[:self.known].sum()) + self.ends
        return self.tokens - inside, self.distinct - self.known - (self.ends > 0)


class Net:
    """Parameters and passes.  Token ids: 0 the end, 1.. words by rank, VOCAB the rest, VOCAB + 1 before a text."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @staticmethod
    def start(v: Vocabulary) -> Net:
        rnd = np.random.default_rng(SEED)
        classes = VOCAB // CLASS
        count = np.zeros(VOCAB)
        count[0] = v.ends
        count[1:1 + v.known] = v.counts[:v.known]
        used = (np.arange(VOCAB) <= v.known).reshape(classes, CLASS)
        by_word = count.reshape(classes, CLASS) + 0.5
        by_class = np.concatenate([(by_word * used).sum(1), [v.rest[0] + 0.5]])
        empty = np.concatenate([~used.any(1), [False]])

        def init(*shape):
            return (rnd.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        return Net({
            "emb": (rnd.standard_normal((VOCAB + 2, EMBED)) * 0.3).astype(np.float32), "wx": init(EMBED, 3 * HIDDEN),
            "b": np.zeros(3 * HIDDEN, np.float32), "u": init(HIDDEN, 3 * HIDDEN),
            "wc": np.zeros((HIDDEN, classes + 1), np.float32),
            "bc": np.where(empty, -1e9, np.log(np.maximum(by_class, 0.5) / by_class.sum())).astype(np.float32),
            "ww": np.zeros((classes, CLASS, HIDDEN), np.float32),
            "bw": np.where(used, np.log(by_word), -1e9).astype(np.float32)})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def from_flat(self, x: np.ndarray) -> Net:
        out, at = {}, 0
        for k in sorted(self.p):
            out[k] = x[at:at + self.p[k].size].reshape(self.p[k].shape).astype(np.float32)
            at += self.p[k].size
        return Net(out)

    def steps(self, ids: np.ndarray, start: np.ndarray, h: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States (lanes, time, HIDDEN) before each target, and the last one; ``start`` marks first tokens of texts."""
        p, n = self.p, HIDDEN
        inputs = p["emb"][ids.T] @ p["wx"] + p["b"]
        out = np.empty((*ids.shape, n), inputs.dtype)
        for t in range(ids.shape[1]):
            h = np.where(start[:, t, None], h.dtype.type(0), h)
            g, r = inputs[t], h @ p["u"]
            gate = 1 / (1 + np.exp(-(g[:, :2 * n] + r[:, :2 * n])))
            z, reset = gate[:, :n], gate[:, n:]
            new = np.tanh(g[:, 2 * n:] + reset * r[:, 2 * n:])
            if keep is not None:
                keep.append((h, z, reset, new, r[:, 2 * n:]))
            h = new + z * (h - new)
            out[:, t] = h
        return out, h

    def log_probs(self, states: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of P(target), of the class alone for the rest; one row per token."""
        p = self.p
        classes = VOCAB // CLASS
        cls = np.minimum(target // CLASS, classes)
        a = states @ p["wc"] + p["bc"]
        a -= a.max(1, keepdims=True)
        out = a[np.arange(len(a)), cls] - np.log(np.exp(a).sum(1))
        order = np.argsort(cls, kind="stable")
        cut = np.searchsorted(cls[order], np.arange(classes + 1))
        for c in range(classes):
            rows = order[cut[c]:cut[c + 1]]
            if len(rows):
                b = states[rows] @ p["ww"][c].T + p["bw"][c]
                b -= b.max(1, keepdims=True)
                out[rows] += b[np.arange(len(rows)), target[rows] % CLASS] - np.log(np.exp(b).sum(1))
        return out

    def gradient(self, ids, target, start, mask, h) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradient of the mean negative log-likelihood of a window (the state that enters is constant)."""
        p, n, keep = self.p, HIDDEN, []
        lanes, time = ids.shape
        states, last = self.steps(ids, start, h, keep)
        flat, y, on = states.reshape(-1, n), target.ravel(), mask.ravel()
        live = max(1, int(on.sum()))
        classes = VOCAB // CLASS
        cls = np.minimum(y // CLASS, classes)
        a = flat @ p["wc"] + p["bc"]
        a = np.exp(a - a.max(1, keepdims=True))
        a /= a.sum(1, keepdims=True)
        loss = -np.log(a[np.arange(len(y)), cls] + 1e-30)
        a[np.arange(len(y)), cls] -= 1
        a *= (on / live)[:, None].astype(np.float32)
        g = {"wc": flat.T @ a, "bc": a.sum(0)}
        d = a @ p["wc"].T
        rows = np.flatnonzero((cls < classes) & on)
        rows = rows[np.argsort(cls[rows], kind="stable")]
        g["ww"], g["bw"] = np.zeros_like(p["ww"]), np.zeros_like(p["bw"])
        if len(rows):
            c = cls[rows]
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            groups = list(zip(c[first].tolist(), first.tolist(), [*first[1:].tolist(), len(c)], strict=True))
            x, b = flat[rows], p["bw"][c].copy()
            for k, lo, hi in groups:
                b[lo:hi] += x[lo:hi] @ p["ww"][k].T
            b = np.exp(b - b.max(1, keepdims=True))
            b /= b.sum(1, keepdims=True)
            at = np.arange(len(rows))
            loss[rows] -= np.log(b[at, y[rows] % CLASS] + 1e-30)
            b[at, y[rows] % CLASS] -= 1
            b /= live
            for k, lo, hi in groups:
                d[rows[lo:hi]] += b[lo:hi] @ p["ww"][k]
                g["ww"][k] = b[lo:hi].T @ x[lo:hi]
            g["bw"][c[first]] = np.add.reduceat(b, first)
        d = d.reshape(lanes, time, n)
        g["u"], dg = np.zeros_like(p["u"]), np.empty((lanes, time, 3 * n), np.float32)
        dh = np.zeros((lanes, n), np.float32)
        for t in range(time - 1, -1, -1):
            before, z, reset, new, rn = keep[t]
            dh = dh + d[:, t]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (before - new) * z * (1 - z)
            dr = dn * rn * reset * (1 - reset)
            dg[:, t] = np.concatenate([dz, dr, dn], 1)
            dr3 = np.concatenate([dz, dr, dn * reset], 1)
            g["u"] += before.T @ dr3
            dh = (dh * z + dr3 @ p["u"].T) * ~start[:, t, None]
        rows_g = dg.reshape(-1, 3 * n)
        x = p["emb"][ids.ravel()]
        g["wx"], g["b"] = x.T @ rows_g, rows_g.sum(0)
        g["emb"] = np.zeros_like(p["emb"])
        np.add.at(g["emb"], ids.ravel(), rows_g @ p["wx"].T)
        return g, last, float((loss * on).sum())


class Lanes:
    """Texts laid end to end on parallel lanes of about equal length, longest lane first."""

    def __init__(self, texts: list[np.ndarray], lanes: int):
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        heap = [(0, k) for k in range(min(lanes, max(1, len(texts))))]
        on: list[list[int]] = [[] for _ in heap]
        for i in order:
            size, k = heapq.heappop(heap)
            on[k].append(i)
            heapq.heappush(heap, (size + len(texts[i]), k))
        on.sort(key=lambda k: -sum(len(texts[i]) for i in k))
        seq = [i for k in on for i in k]
        length = np.array([len(texts[i]) for i in seq], np.int64)
        self.target = np.concatenate([texts[i] for i in seq]) if seq else np.empty(0, np.int64)
        self.text = np.repeat(np.array(seq, np.int64), length)
        self.start = np.zeros(len(self.target), bool)
        self.start[np.cumsum(length) - length] = True
        self.ids = np.where(self.start, VOCAB + 1, np.concatenate([[0], self.target[:-1]]))
        self.size = np.array([sum(len(texts[i]) for i in k) for k in on], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def windows(self, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(lanes still running, positions, mask) of each window, a prefix of the lanes."""
        for t in range(0, int(self.size.max(initial=0)), width):
            n = int(np.count_nonzero(self.size > t))
            at = t + np.arange(width)
            mask = at[None, :] < self.size[:n, None]
            yield n, np.where(mask, self.first[:n, None] + at[None, :], 0), mask


def token_ids(texts: pa.Array, frequent: pa.Array, known: int) -> tuple[list[np.ndarray], np.ndarray, Words]:
    """Network ids of each text (the end last), and the rank of every word in ``frequent`` (-1: not there)."""
    w = Words(texts, lower=True)
    rank = pc.index_in(w.strings(), value_set=frequent).fill_null(-1).to_numpy().astype(np.int64)
    ids = np.where((rank >= 0) & (rank < known), rank + 1, VOCAB)
    zero = np.zeros(1, np.int64)
    return [np.concatenate([ids[a:b], zero]) for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)], rank, w


def _value_set(v: Vocabulary) -> pa.Array:
    return pa.array(v.words, pa.large_binary())


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; each task sums its parts before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(lo, hi - lo) for x in batches for lo, hi in pieces(x.column(0), PART)):
            parts = [Words(b.column(0).slice(lo, hi - lo), lower=True).strings().dictionary_encode() for lo, hi in pieces(b.column(0))]
            c = pc.value_counts(pa.chunked_array(parts, type=parts[0].type).unify_dictionaries().combine_chunks().cast(pa.large_binary()))
            yield pa.RecordBatch.from_arrays([c.field("values").cast(pa.binary()), c.field("counts").cast(pa.int64())], names=["word", "n"])

    return texts.select("_text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learn_vocabulary(train: DataFrame, frequent: int = FREQUENT) -> tuple[Vocabulary, DataFrame]:
    """The frequent words with totals, and the table of all counts."""
    counts = staged(count_words(train), "lm-counts")
    ends = train.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = most_frequent(counts, frequent)
    return Vocabulary([bytes(x) for x in top["word"]], top["n"].to_numpy().astype(np.int64), ends, total[0] + ends,
                      total[1] + (ends > 0)), counts


def _train(shared_vocabulary, shared_net):
    """One task's round: the batches' texts on lanes, windows in order with the state carried, Adam."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, net = Vocabulary(**shared_vocabulary.value), Net(shared_net.value)
        frequent, seen = _value_set(v), 0
        x = net.flat()
        m, s, step = np.zeros_like(x), np.zeros_like(x), 0
        for b in (y.slice(lo, hi - lo) for y in batches for lo, hi in pieces(y.column(0), PART)):
            lanes = Lanes(token_ids(b.column(0), frequent, v.known)[0], TRAIN_LANES)
            h = np.zeros((TRAIN_LANES, HIDDEN), np.float32)
            for n, at, mask in lanes.windows(TRAIN_WINDOW):
                g, h, _ = net.gradient(lanes.ids[at], lanes.target[at], lanes.start[at] & mask, mask, h[:n])
                flat = np.concatenate([g[k].ravel() for k in sorted(g)])
                norm = float(np.sqrt((flat * flat).sum()))
                flat *= min(1.0, 5.0 / max(norm, 1e-9))
                step += 1
                m += 0.1 * (flat - m)
                s += 0.01 * (flat * flat - s)
                # the last windows hold a few long texts only: they count by their tokens
                share = float(mask.sum()) / (TRAIN_LANES * TRAIN_WINDOW)
                x = x - RATE * share * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
                net = net.from_flat(x)
                seen += int(mask.sum())
        if seen:
            size = 4096
            cut = range(0, len(x), size)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(cut), dtype=np.int32)), pa.array([seen % 64] * len(cut), pa.int32()),
                pa.array([float(seen)] * len(cut)), pa.array([x[i:i + size].astype(np.float64).tobytes() for i in cut], pa.binary())],
                names=["block", "salt", "weight", "x"])

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted mean of the arrays of a group, one batch in memory at a time."""
    total, weight, block, salt = 0.0, 0.0, 0, 0
    for b in batches:
        block, salt = b.column("block")[0].as_py(), b.column("salt")[0].as_py()
        for w, x in zip(b.column("weight").to_pylist(), b.column("x").to_pylist(), strict=True):
            total, weight = total + w * np.frombuffer(x), weight + w
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([weight]),
                                      pa.array([(total / weight).tobytes()], pa.binary())], names=["block", "salt", "weight", "x"])


def train(docs: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> Net:
    """Rounds of local training and averaging; every document is in exactly one round, by its hash."""
    spark, net = docs.sparkSession, Net.start(v)
    shared = spark.sparkContext.broadcast(vars(v))
    schema = "block int, salt int, weight double, x binary"
    for r in range(rounds):
        part = docs.filter(F.pmod(F.xxhash64("_id", "_tie", F.lit(SEED)), F.lit(rounds)) == r).select("_text")
        found = part.mapInArrow(_train(shared, spark.sparkContext.broadcast(net.p)), schema)
        for keys in (("block", "salt"), ("block",)):
            found = found.groupBy(*keys).applyInArrow(_average, schema)
        rows = {x["block"]: np.frombuffer(x["x"]) for x in found.select("block", "x").collect()}  # one network
        if rows:
            net = net.from_flat(np.concatenate([rows[k] for k in sorted(rows)]))
    return net


def _gathered(batches: Iterator[pa.RecordBatch], column: int, limit: int = SCORE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about ``limit`` bytes of text, so that long texts share their lanes' steps with others."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _score(shared_vocabulary, shared_net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, net = Vocabulary(**shared_vocabulary.value), Net(shared_net.value)
        frequent = _value_set(v)
        logs = np.log10(np.concatenate([v.counts, [0]]) + 1.0)
        for b in _gathered(batches, 3):
            texts, cols = [], [[] for _ in range(5)]
            for lo, hi in pieces(b.column(3)):
                ids, rank, w = token_ids(b.column(3).slice(lo, hi - lo), frequent, v.known)
                texts += [x.astype(np.int16) for x in ids]
                value = np.where(rank >= 0, logs[rank], 0.0)
                out = [np.diff(w.first) + 1, np.ones(hi - lo), np.full(hi - lo, np.log10(v.ends + 1.0)), np.zeros(hi - lo), np.zeros(hi - lo)]
                doc = np.repeat(np.arange(hi - lo), np.diff(w.first))
                other = (rank < 0) | (rank >= v.known)
                out[1] = np.bincount(doc, rank >= 0, hi - lo) + (v.ends > 0)
                out[2] = out[2] + np.bincount(doc, value, hi - lo)
                out[3] = np.bincount(doc, other, hi - lo)
                out[4] = np.bincount(doc, value * other, hi - lo)
                for c, x in zip(cols, out, strict=True):
                    c.append(x)
            lanes = Lanes(texts, SCORE_LANES)
            total, h = np.zeros(len(texts)), np.zeros((SCORE_LANES, HIDDEN), np.float32)
            for n, at, mask in lanes.windows(SCORE_WINDOW):
                states, h = net.steps(lanes.ids[at], lanes.start[at] & mask, h[:n])
                here = at[mask]
                found = net.log_probs(states[mask], lanes.target[here].astype(np.int64))
                total += np.bincount(lanes.text[here], found.astype(np.float64), len(texts))
            n, known, base, rest, of_rest = (np.concatenate(c) if c else np.empty(0) for c in cols)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *[
                pa.array(x.astype(np.int64)) for x in (n, known, rest)], *[pa.array(x.astype(np.float64)) for x in (base, of_rest, total / np.log(10))]],
                names=["doc_id", "_id", "_tie", "n_tokens", "known", "rest", "base", "of_rest", "model"])

    return run


def _rare(shared_vocabulary):
    """Words outside the frequent ones, per document: (_id, _tie, word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _value_set(Vocabulary(**shared_vocabulary.value))
        for batch in batches:
            for lo, hi in pieces(batch.column(2)):
                b = batch.slice(lo, hi - lo)
                w = Words(b.column(2), lower=True)
                strings = w.strings()
                at = np.flatnonzero(pc.index_in(strings, value_set=frequent).is_null().to_numpy(zero_copy_only=False))
                if not len(at):
                    continue
                codes = strings.take(pa.array(at)).dictionary_encode()
                doc = np.searchsorted(w.first, at, "right") - 1
                pair, n = np.unique(doc * len(codes.dictionary) + codes.indices.to_numpy(), return_counts=True)
                doc = pa.array(pair // len(codes.dictionary))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(doc), b.column(1).take(doc),
                    codes.dictionary.take(pa.array(pair % len(codes.dictionary))).cast(pa.binary()), pa.array(n.astype(np.int64))],
                    names=["_id", "_tie", "word", "n"])

    return run


def score(docs: DataFrame, train_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10).

    Null and empty texts are one end token.  Rows with one id and other texts are
    documents of their own, rows equal in both give equal rows, null ids pass through.
    Without training documents every count is 0.  Only the id and the text are read.
    """
    spark = docs.sparkSession
    k, t = keyed(docs, id_col, text_col), keyed(train_docs, id_col, text_col)
    v, counts = learn_vocabulary(t)
    net = train(t, v)
    shared = spark.sparkContext.broadcast(vars(v))
    base = k.select("doc_id", "_id", "_tie", "_text").mapInArrow(
        _score(shared, spark.sparkContext.broadcast(net.p)),
        "doc_id long, _id long, _tie long, n_tokens long, known long, rest long, base double, of_rest double, model double")
    # rows equal in id and text are looked up once
    rare = k.select("_id", "_tie", "_text").mapInArrow(_rare(shared), "_id long, _tie long, word binary, n long")
    found = rare.groupBy("_id", "_tie", "word").agg(F.max("n").alias("n")).join(
        counts.withColumnRenamed("n", "c"), "word", "left").groupBy("_id", "_tie").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_sum"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    out = base.join(found, ["_id", "_tie"], "left")
    extra = F.coalesce("rare_sum", F.lit(0.0))
    per_token = float(np.log10(v.tokens + v.distinct + 1))
    in_rest = float(np.log10(v.rest[0] + v.rest[1] + 1))
    return out.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("model") + F.col("of_rest") + extra - F.col("rest") * in_rest).alias("score"))

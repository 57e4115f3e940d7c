"""Substring deduplication over words by super-k-mer partitioning.

A window is ``window`` consecutive words of a document.  Consecutive windows that share
a minimiser (the smallest hash among their ``seed``-word sequences) form a super-k-mer:
their words travel as one packed string to the bucket of the minimiser.  Equal windows
have equal minimisers, so a bucket sees every occurrence of its windows and finds, by
sorting them, the first one exactly.

Before the shuffle each part of an Arrow batch settles super-k-mers that repeat within
it: only the first copy travels as text.  A passage that a third of all documents share
is therefore one packed string per part in its bucket, not one per document.

Exchanges: packed strings by bucket; removed ranges and documents by document.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import keyed
from stayflow.llm.vec import PART, Spans, Words, expand, mix, pieces, runs_of, super_kmers

WINDOW = 20
SEED = 5
#: Buckets for each shuffle partition: a task holds one bucket at a time.
BUCKETS_PER_PARTITION = 8


def _bytes(a: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones, and so on: like bytes compress well."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def _numbers(b: bytes, kind, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8, n * size, at).reshape(size, n).T).view(kind)[:, 0]


_LAYOUT = (np.int64, np.int64, np.int32)  # per document: id, tie, super-k-mers
_RUNS = (np.int32, np.int32, np.uint8)  # per super-k-mer: start, windows, whether its words follow


def _pack(key: np.ndarray, tie: np.ndarray, start: np.ndarray, count: np.ndarray, strings: list[bytes | None]) -> bytes:
    """Super-k-mers in document order and, for those not settled, their words."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (tie[1:] != tie[:-1])
    first = np.flatnonzero(new)
    per = np.diff(np.concatenate([first, [len(key)]]))
    sent = np.array([s is not None for s in strings])
    cols = [*zip((key[first], tie[first], per), _LAYOUT, strict=True), *zip((start, count, sent), _RUNS, strict=True)]
    body = b"".join(_bytes(c.astype(k)) for c, k in cols) + b"\n".join(s for s in strings if s is not None)
    return zstandard.ZstdCompressor(level=6).compress(struct.pack("<qq", len(first), len(key)) + body)


def _unpack(blob: bytes):
    b = zstandard.ZstdDecompressor().decompress(blob)
    docs, runs = struct.unpack_from("<qq", b)
    at, cols = 16, []
    for kind, n in [*((k, docs) for k in _LAYOUT), *((k, runs) for k in _RUNS)]:
        cols.append(_numbers(b, kind, n, at) if n else np.empty(0, kind))
        at += cols[-1].nbytes
    key, tie, per, start, count, sent = cols
    return np.repeat(key, per), np.repeat(tie, per), start, count, sent, b[at:].split(b"\n") if sent.any() else []


def _split(window: int, seed: int, buckets: int):
    """Batches of (_id, _tie, _text) to packed super-k-mers (bucket, blob)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, hi - lo) for b in batches for lo, hi in pieces(b.column(2), PART)):
            key, tie = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            order = np.lexsort((tie, key))
            fresh = np.ones(len(order), bool)  # rows equal in id and text are one document
            fresh[1:] = (key[order[1:]] != key[order[:-1]]) | (tie[order[1:]] != tie[order[:-1]])
            order = order[fresh]
            texts = batch.column(2).take(pa.array(order))
            seen: set[bytes] = set()
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            strings: list[bytes | None] = []
            for lo, hi in pieces(texts):
                w = Words(texts.slice(lo, hi - lo))
                text, start, count, value, _ = super_kmers(w.hashes(), w.first, window, seed)
                word = w.first[text] + start
                data = w.data.tobytes()
                # in document order, so the first copy met is the earliest
                for a, b in zip(w.start[word].tolist(), w.end[word + count + window - 2].tolist(), strict=True):
                    s = data[a:b]
                    if s in seen:
                        strings.append(None)
                    else:
                        seen.add(s)
                        strings.append(s)
                doc = order[lo + text]
                for c, x in zip(cols, (key[doc], tie[doc], start, count, (mix(value) % np.uint64(buckets)).astype(np.int64)), strict=True):
                    c.append(x)
            k, t, s, c, bucket = (np.concatenate(x) for x in cols)
            by = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by])) + 1
            groups = [g for g in np.split(by, cuts) if len(g)]
            for part in range(0, len(groups), 256):
                some = groups[part:part + 256]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(bucket[g[0]]) for g in some], pa.int32()),
                    pa.array([_pack(k[g], t[g], s[g], c[g], [strings[i] for i in g]) for g in some], pa.binary())],
                    names=["bucket", "blob"])

    return run


def _first_windows(codes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Whether each window, given in document order by its first code, is the first of its kind."""
    h = Spans(mix(codes.astype(np.uint64) + np.uint64(1)))(at, at + window)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    equal = np.ones(len(a), bool)
    for k in range(window):  # a hash never decides: equal hashes are compared word by word
        equal &= codes[a + k] == codes[b + k]
    first = np.ones(len(at), bool)
    first[order[1:][same]] = False
    if not equal.all():
        odd = np.isin(h, h[order[1:][same][~equal]])
        known: set[bytes] = set()
        for i in np.flatnonzero(odd):
            content = codes[at[i]:at[i] + window].tobytes()
            first[i] = content not in known
            known.add(content)
    return first


def _resolve(window: int):
    """All packed super-k-mers of one bucket to the ranges of window starts that are not first."""

    def run(table: pa.Table) -> pa.Table:
        got = [_unpack(b.as_py()) for c in table.column("blob").chunks for b in c]
        key, tie, start, count, sent = (np.concatenate([g[i] for g in got]) for i in range(5))
        settled = sent == 0
        out = [[key[settled], tie[settled], start[settled], count[settled]]]
        words = [s for g in got for s in g[5]]
        key, tie, start, count = (x[~settled] for x in (key, tie, start, count))
        order = np.lexsort((start, tie, key))
        seen: dict[bytes, tuple] = {}
        whole = np.zeros(len(order), bool)
        fresh = np.zeros(len(order), bool)
        for j, i in enumerate(order.tolist()):
            at = (key[i], tie[i], start[i])
            if seen.setdefault(words[i], at) is at:
                fresh[j] = True
            elif seen[words[i]] != at:  # the same place again if a row came twice
                whole[j] = True
        gone = order[whole]
        out.append([key[gone], tie[gone], start[gone], count[gone]])
        kept = order[fresh]
        if len(kept):
            w = Words(pa.array([words[i] for i in kept.tolist()], pa.large_binary()))
            codes = w.strings().dictionary_encode().indices.to_numpy()
            n = count[kept].astype(np.int64)
            run_of, at = np.repeat(np.arange(len(kept)), n), expand(w.first[:-1], n)
            offset = at - w.first[run_of]
            i, length = runs_of(~_first_windows(codes, at, window), run_of, offset)
            r = kept[run_of[i]]
            out.append([key[r], tie[r], start[r] + offset[i], length])
        cols = [np.concatenate([o[k] for o in out]) for k in range(4)]
        return pa.table([pa.array(c.astype(np.int64)) for c in cols[:2]] + [pa.array(c.astype(np.int32)) for c in cols[2:]],
                        names=["_id", "_tie", "start", "n"])

    return run


def repeated_ranges(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(_id, _tie, start, n): window starts whose words also start earlier, as ranges.

    ``docs`` has the columns of :func:`~stayflow.llm.common.keyed`.
    """
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = docs.select("_id", "_tie", "_text").mapInArrow(_split(window, seed, buckets), "bucket int, blob binary")
    return packed.groupBy("bucket").applyInArrow(_resolve(window), "_id long, _tie long, start int, n int")


def _kept_words(text: bytes, ranges: list, window: int) -> tuple[int, int, bytes]:
    words = text.split()
    if not ranges:
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int32)
    for r in ranges:
        edge[r["start"]] += 1
        edge[r["start"] + r["n"] + window - 1] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return len(words), int(len(words) - keep.sum()), b" ".join(compress(words, keep.tolist()))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, seed: int = SEED, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept (the words left, joined by one space).

    A word goes if a window that covers it has the words of a window that starts
    earlier (smaller id, then earlier start), judged on the input.  Null text has no
    words; a null id sorts first; rows with one id and other texts are ordered by a
    hash of the text; rows equal in id and text are one document and get the same
    result.  An empty table gives an empty result; other columns are not read.
    """
    k = keyed(docs, id_col, text_col)
    ranges = repeated_ranges(k, window, seed).groupBy("_id", "_tie").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            got = [_kept_words(t.as_py(), r or [], window) for t, r in zip(texts, b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                pa.array([g[2] for g in got], pa.binary()).cast(pa.string()),
                pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return (k.join(ranges, ["_id", "_tie"], "left").select("doc_id", "_text", "ranges")
            .mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"))

"""Suffix-array deduplication over bytes.

A byte goes if a ``window``-byte string that covers it also starts earlier.  Repeated
strings share a minimiser (the smallest hash of their ``seed``-byte sequences), so the
text around minimisers that occur once never needs sorting:

1. Runs of windows with one minimiser are described by hashes (no text) and meet in the
   minimiser's bucket.  A run equal to an earlier run is removed whole.
2. Runs that share a minimiser but differ, and runs that hold it twice, are contested:
   their bytes are fetched from the documents and gathered in shards by minimiser.
3. Each shard is a text of its own, without the windows whose hash is unique in it: external induced sorting (:mod:`~stayflow.llm.induced`)
   gives its suffix array with common-prefix values; neighbours with a common prefix of
   at least ``window`` bytes are equal windows, and all but the earliest are removed.

Passages that many documents share are settled per part of an Arrow batch before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import keyed, staged
from stayflow.llm.induced import Shard
from stayflow.llm.vec import _BYTES, PART, SECOND, Spans, buffers, mix, pieces, runs_of, super_kmers

WINDOW = 100
SEED = 50
BUCKETS_PER_PARTITION = 8
RANGE = "_id long, _tie long, start int, n int"

_COLUMNS = (np.uint64, np.uint64, np.int64, np.int64, np.int32, np.int32, np.bool_)


def _pack(cols: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(
        np.int64(len(cols[0])).tobytes() + b"".join(np.ascontiguousarray(c, k).tobytes() for c, k in zip(cols, _COLUMNS, strict=True)))


def _unpack(blob: bytes) -> list[np.ndarray]:
    b = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(b, np.int64, 1)[0]), 8, []
    for k in _COLUMNS:
        out.append(np.frombuffer(b, k, n, at))
        at += out[-1].nbytes
    return out


def _earliest(anchor, run, key, tie, start):
    """Order by content, then place; marks of the first of each content and of repeats of one place."""
    order = np.lexsort((start, tie, key, run, anchor))
    a, r = anchor[order], run[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    # the place of the first copy, for every copy
    head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    same = (key[order] == key[head]) & (tie[order] == tie[head]) & (start[order] == start[head])
    return order, fresh, same


def _runs(window: int, seed: int, buckets: int):
    """Batches of (_id, _tie, _text) to packed run descriptions (bucket, blob); bucket -1 has settled runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, hi - lo) for b in batches for lo, hi in pieces(b.column(2), PART)):
            key, tie = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cols: list[list[np.ndarray]] = [[] for _ in _COLUMNS]
            for lo, hi in pieces(batch.column(2)):
                raw, off = buffers(batch.column(2).slice(lo, hi - lo))
                values = _BYTES[raw]
                text, start, count, least, twin = super_kmers(values, off, window, seed)
                at = off[text] + start
                whole = Spans(mix(values), SECOND)(at, at + count + window - 1)
                for c, x in zip(cols, (least, whole, key[lo + text], tie[lo + text], start, count, twin), strict=True):
                    c.append(x)
            anchor, whole, k, t, s, n, twin = (np.concatenate(c) for c in cols)
            order, fresh, same = _earliest(anchor, whole, k, t, s)
            bucket = (mix(anchor) % np.uint64(buckets)).astype(np.int64)
            settled = order[~fresh & ~same]
            bucket[settled] = -1
            go = np.concatenate([order[fresh], settled])
            go = go[np.argsort(bucket[go], kind="stable")]
            groups = [g for g in np.split(go, np.flatnonzero(np.diff(bucket[go])) + 1) if len(g)]
            for part in range(0, len(groups), 256):
                some = groups[part:part + 256]
                yield pa.RecordBatch.from_arrays([
                    # settled runs need no bucket; they are spread by batch
                    pa.array([int(bucket[g[0]]) if bucket[g[0]] >= 0 else int(key[0] % buckets) for g in some], pa.int32()),
                    pa.array([bool(bucket[g[0]] < 0) for g in some]),
                    pa.array([_pack([c[g] for c in (anchor, whole, k, t, s, n, twin)]) for g in some], pa.binary())],
                    names=["bucket", "settled", "blob"])

    return run


def _resolve(shards: int):
    """The runs of one bucket to removed (shard null) and contested ranges."""

    def run(table: pa.Table) -> pa.Table:
        done = [_unpack(b.as_py()) for b, d in zip(table.column("blob"), table.column("settled"), strict=True) if d.as_py()]
        got = [_unpack(b.as_py()) for b, d in zip(table.column("blob"), table.column("settled"), strict=True) if not d.as_py()]
        out = [[d[2], d[3], d[4], d[5], np.full(len(d[0]), -1)] for d in done]
        if got:
            anchor, whole, key, tie, start, n, twin = (np.concatenate([g[i] for g in got]) for i in range(7))
            order, fresh, same = _earliest(anchor, whole, key, tie, start)
            gone = order[~fresh & ~same]
            out.append([key[gone], tie[gone], start[gone], n[gone], np.full(len(gone), -1)])
            kept = order[fresh]  # distinct runs, by minimiser
            a = anchor[kept]
            shared = np.zeros(len(a) + 1, bool)
            shared[1:-1] = a[1:] == a[:-1]
            c = kept[shared[1:] | shared[:-1] | twin[kept]]
            out.append([key[c], tie[c], start[c], n[c], (mix(anchor[c] + np.uint64(1)) % np.uint64(shards)).astype(np.int64)])
        cols = [np.concatenate([o[i] for o in out]) if out else np.empty(0) for i in range(5)]
        shard = cols[4].astype(np.int64)
        return pa.table([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.int32)),
                         pa.array(cols[3].astype(np.int32)), pa.array(shard.astype(np.int32), mask=shard < 0)],
                        names=["_id", "_tie", "start", "n", "shard"])

    return run


def _fetch(window: int):
    """Documents with their contested ranges to the bytes of each (shard, place, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for key, tie, text, ranges in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                              b.column(2).cast(pa.large_binary()), b.column(3).to_pylist(), strict=True):
                data = text.as_py()
                for r in ranges:
                    for out, x in zip(rows, (r["shard"], key, tie, r["start"], r["n"],
                                             data[r["start"]:r["start"] + r["n"] + window - 1]), strict=True):
                        out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(
                rows, (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                names=["shard", "_id", "_tie", "start", "n", "bytes"])

    return run


def _sorted_shard(window: int):
    """The strings of one shard to the ranges of windows that also start earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for b in batches:
            col = {name: b.column(name) for name in ("_id", "_tie", "start", "n", "bytes")}
            key, tie, start, n = (col[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_id", "_tie", "start", "n"))
            shard.add(col["bytes"], n, key, tie, start)
        again, of, offset, key, tie, start = shard.repeated(window)
        i, length = runs_of(again, of, offset)
        r = of[i]
        yield pa.RecordBatch.from_arrays([pa.array(key[r]), pa.array(tie[r]), pa.array((start[r] + offset[i]).astype(np.int32)),
                                          pa.array(length.astype(np.int32))], names=["_id", "_tie", "start", "n"])

    run.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def _cut(data: bytes, ranges: list, window: int) -> tuple[int, int, int, bytes]:
    """(bytes, removed bytes, maximal removed runs, bytes left)"""
    if not ranges:
        return len(data), 0, 0, data
    edge = np.zeros(len(data) + 1, np.int32)
    start = np.array([r["start"] for r in ranges])
    np.add.at(edge, start, 1)
    np.add.at(edge, start + np.array([r["n"] for r in ranges]) + window - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()


def removed_ranges(k: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(_id, _tie, start, n): starts of windows that also start earlier, as ranges.

    ``k`` has the columns of :func:`~stayflow.llm.common.keyed`.
    """
    parts = max(64, int(k.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    described = k.select("_id", "_tie", "_text").mapInArrow(_runs(window, seed, BUCKETS_PER_PARTITION * parts),
                                                            "bucket int, settled boolean, blob binary")
    found = described.groupBy("bucket").applyInArrow(_resolve(parts), f"{RANGE}, shard int")
    found = staged(found, "suffix-runs")  # read by both branches
    contested = found.filter("shard IS NOT NULL").groupBy("_id", "_tie").agg(
        F.collect_list(F.struct("start", "n", "shard")).alias("ranges"))
    # the documents are dealt by key with all their columns, as in the last join, which reuses that exchange
    others = [c for c in k.columns if c not in ("_id", "_tie", "_text")]
    strings = k.join(contested, ["_id", "_tie"]).select("_id", "_tie", "_text", "ranges", *others).mapInArrow(
        _fetch(window), "shard int, _id long, _tie long, start int, n int, bytes binary")
    ranked = strings.groupBy("shard").applyInArrow(_sorted_shard(window), RANGE)
    return found.filter("shard IS NULL").drop("shard").unionByName(ranked)


def dedup_bytes(docs: DataFrame, window: int = WINDOW, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) and
    kept_sha256, plus the columns ``keep`` of ``docs`` under their names with ``_`` before.

    A byte goes if a ``window``-byte string that covers it also starts earlier (smaller
    id, then earlier start), judged on the input.  Null text has no bytes; a null id
    sorts first; rows with one id and other texts are ordered by a hash of the text;
    rows equal in both are one document and get the same result.  An empty table gives
    an empty result.
    """
    k = keyed(docs, id_col, text_col, keep)
    ranges = removed_ranges(k, window, seed).groupBy("_id", "_tie").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_cut(t.as_py(), r or [], window)
                   for t, r in zip(b.column(1).cast(pa.large_binary()), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), *[pa.array([g[i] for g in got], pa.int64()) for i in range(3)],
                pa.array([g[3] for g in got], pa.binary()),
                pa.array([hashlib.sha256(g[3]).hexdigest() for g in got], pa.string()), *b.columns[3:]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", *[f"_{c}" for c in keep]])

    types = dict(docs.dtypes)
    return k.join(ranges, ["_id", "_tie"], "left").select(
        "doc_id", "_text", "ranges", *[F.col(f"`_keep_{c}`") for c in keep]).mapInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
        + "".join(f", `_{c}` {types[c]}" for c in keep))


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, text_col: str = "text") -> DataFrame:
    """``docs`` (same columns) with repeated bytes cut from the texts; ``n_chars``, where
    there, counts what is left.  A character that loses a byte goes whole; documents of
    which nothing is left go; null texts stay null."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", text_col))
    out = dedup_bytes(docs.withColumn("__null", F.col(f"`{text_col}`").isNull()), window, seed, text_col=text_col,
                      keep=(*others, "__null"))
    # make_valid_utf8 puts U+FFFD for broken bytes; a text of its own U+FFFD keeps them if nothing was cut
    valid = F.make_valid_utf8(F.col("kept").cast("string"))
    out = out.filter("n_removed < n_bytes OR n_bytes = 0").withColumn(
        "kept_text", F.when(F.col("n_removed") > 0, F.translate(valid, "\ufffd", "")).otherwise(valid))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.when(F.col("___null"), F.lit(None)).otherwise(F.col("kept_text")).alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("_n_chars"))
                        .cast(docs.schema["n_chars"].dataType).alias(c))
        else:
            cols.append(F.col(f"`{c}`" if c == "doc_id" else f"`_{c}`").alias(c))
    return out.select(*cols)

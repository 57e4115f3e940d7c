"""Benchmark decontamination by greedy string tiling.

Documents are joined to benchmark items by shared seeds (sequences of SEED tokens).  For
a pair whose seeds could cover enough of the item, running Karp-Rabin finds the longest
common token sequences, which are marked as tiles, longest first and without overlap,
until none of SEED tokens is left.  The share of the item under tiles does not depend on
their order, so reordered passages count in full.

The benchmark is a query set: it is broadcast in blocks of at most BLOCK_TOKENS tokens
(or one longer item), and every block meets all documents in one pass without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import staged, words
from stayflow.llm.vec import Spans, Words, expand, pieces

SEED = 5
#: Share of an item's tokens under tiles from which a document is contaminated.
COVERAGE = 0.5
BLOCK_TOKENS = 1 << 20


class Items:
    """Tokens of some benchmark items and the sorted index of their seeds."""

    def __init__(self, ids: list, texts: list[str], seed: int):
        w = Words(pa.array(texts, pa.string()), plain=True)
        self.ids, self.seed, self.first, self.tokens = ids, seed, w.first, w.hashes()
        windows = np.maximum(0, np.diff(w.first) - seed + 1)
        at = expand(w.first[:-1], windows)
        item = np.repeat(np.arange(len(ids)), windows)
        rolled = Spans(self.tokens).rolling(seed)[at] if len(at) else np.empty(0, np.uint64)
        order = np.argsort(rolled, kind="stable")
        self.grams, self.item, self.place = rolled[order], item[order], (at - w.first[item])[order]

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.first[i]:self.first[i + 1]]


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Starts of unmarked windows."""
    if len(marked) < length:
        return np.empty(0, np.int64)
    total = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(total[length:] == total[:-length])


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token sequences: (start in item, start in text, tokens)."""
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    item_spans, text_spans = Spans(item), Spans(text)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), len(text)))
    while length >= least:
        a, b = _free(in_item, length), _free(in_text, length)
        ha, hb = item_spans(a, a + length), text_spans(b, b + length)
        order = np.argsort(ha, kind="stable")
        lo, hi = np.searchsorted(ha[order], hb, "left"), np.searchsorted(ha[order], hb, "right")
        p, q = a[order[expand(lo, hi - lo)]], np.repeat(b, hi - lo)
        # maximal matches start where the tokens before differ, are marked or are missing
        inner = (p > 0) & (q > 0)
        inner[inner] = (item[p[inner] - 1] == text[q[inner] - 1]) & ~in_item[p[inner] - 1] & ~in_text[q[inner] - 1]
        found: dict[int, list[tuple[int, int]]] = {}
        for i, j in zip(p[~inner].tolist(), q[~inner].tolist(), strict=True):
            size = _extent(item, text, in_item, in_text, i, j)
            if size >= length:
                found.setdefault(size, []).append((i, j))
        if found and max(found) > 2 * length:
            length = max(found)
            continue
        while found:  # longest first, then by place
            size = max(found)
            for i, j in sorted(found.pop(size)):
                x, y = in_item[i:i + size], in_text[j:j + size]
                if not x.any() and not y.any():
                    x[:], y[:] = True, True
                    out.append((i, j, size))
                    continue
                taken = np.concatenate([[True], x | y, [True]])
                edge = np.flatnonzero(np.diff(taken.astype(np.int8)))
                for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    if e - s >= length:
                        found.setdefault(e - s, []).append((i + s, j + s))
        length = max(least, length // 2) if length > least else 0
    return out


def _extent(item, text, in_item, in_text, i: int, j: int) -> int:
    """Tokens that agree and are unmarked from (i, j) on."""
    n = min(len(item) - i, len(text) - j)
    stop = (item[i:i + n] != text[j:j + n]) | in_item[i:i + n] | in_text[j:j + n]
    at = int(stop.argmax()) if n else 0
    return at if n and stop[at] else n


def _match(shared, coverage: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        seed = items.seed
        length = np.diff(items.first)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            ids = batch.column(0).to_pylist()
            for lo, hi in pieces(batch.column(1)):
                w = Words(batch.column(1).slice(lo, hi - lo), plain=True)
                tokens = w.hashes()
                rolled = Spans(tokens).rolling(seed)
                if not len(rolled) or not len(items.grams):
                    continue
                left = np.searchsorted(items.grams, rolled)
                hit = np.flatnonzero(items.grams[np.minimum(left, len(items.grams) - 1)] == rolled)
                doc = np.searchsorted(w.first, hit, "right") - 1
                inside = hit + seed <= w.first[doc + 1]
                hit, doc = hit[inside], doc[inside]
                n = np.searchsorted(items.grams, rolled[hit], "right") - left[hit]
                at = expand(left[hit], n)
                pair = np.unique(np.stack([np.repeat(doc, n), items.item[at], items.place[at]]), axis=1)
                new = np.ones(pair.shape[1], bool)
                new[1:] = (pair[:2, 1:] != pair[:2, :-1]).any(0)
                edges = [*np.flatnonzero(new).tolist(), pair.shape[1]]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    d, i = int(pair[0, a]), int(pair[1, a])
                    # tokens of the item in any shared seed bound the tokens under tiles
                    place = pair[2, a:b]
                    if seed + int(np.minimum(np.diff(place), seed).sum()) < coverage * length[i]:
                        continue
                    found = tiles(items.of(i), tokens[w.first[d]:w.first[d + 1]], seed)
                    covered = sum(t[2] for t in found)
                    if covered >= coverage * length[i]:
                        for out, x in zip(rows, (ids[lo + d], items.ids[i], int(length[i]), covered, covered / float(length[i]),
                                                 len(found)), strict=True):
                            out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)], names=names)

    return run


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED,
                       id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
                       block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, item_id, n_tokens, n_covered, coverage, n_tiles) of the pairs at or above ``coverage``.

    Tokens are runs of letters, digits and other non-ASCII characters, A-Z in lower case.
    Null or empty texts match nothing; items of fewer than ``seed`` tokens cannot be
    tested and match nothing.  Repeated rows give repeated pairs, null ids pass through.
    Empty tables give an empty result; only ids and texts are read.
    """
    texts = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.size(words(F.col("text"))))).first()[0] or 0
    n_blocks = max(1, math.ceil(2 * total / block_tokens))  # half full on average
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    names = ["doc_id", "item_id", "n_tokens", "n_covered", "coverage", "n_tiles"]
    schema = "doc_id long, item_id long, n_tokens long, n_covered long, coverage double, n_tiles long"
    out = None
    for i in range(n_blocks):
        rows = texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == i).collect()
        shared = docs.sparkSession.sparkContext.broadcast(([r["item"] for r in rows], [r["text"] for r in rows], seed))
        part = base.mapInArrow(_match(shared, coverage, names), schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` (same columns) without contaminated documents.  Documents without an id stay
    unless a row without an id is contaminated."""
    # written first, so the planner knows its size when it plans the join
    bad = staged(contaminated_pairs(docs, benchmark, **options).select(F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")

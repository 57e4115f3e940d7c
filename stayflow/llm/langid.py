"""Language identification by compression.

Every learned language has a raw-content zstandard dictionary, made from equal shares of a
bounded, hash-ordered sample of its training documents.  A text is cut into segments (so the
dictionary counts throughout a long text), each segment is compressed with every
dictionary, and the language with the smallest total wins; a narrow margin is rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.common import staged

#: Training documents per language and bytes of their text that make its dictionary.
SAMPLE_DOCS = 400
SALTS = 64
DICT_BYTES = 1 << 17
#: Bytes of each place that a text longer than its share gives.
EXCERPT = 96
SEGMENT = 4096
LEVEL = 3
#: Relative margin under which a prediction is rejected.
MARGIN = 0.02
UNDETERMINED = "und"


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str) -> bytes:
    """Letters in lower case with single spaces: what dictionaries and texts are compressed as."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def level_share(sizes: list[int], total: int) -> int:
    """The largest equal share of ``total`` bytes; what short texts leave goes to the longer ones."""
    for j, size in enumerate(sorted(sizes)):
        share = total // (len(sizes) - j)
        if size > share:
            return share
        total -= size
    return max(sizes, default=0)


def excerpt(data: bytes, share: int, seed: int) -> bytes:
    """``share`` bytes from hash-chosen places all over ``data``, in its order; all of it if it fits."""
    if len(data) <= share:
        return data
    places = -(-len(data) // EXCERPT)
    # one more than needed: the last place may be short
    chosen = np.random.default_rng(seed % (1 << 64)).choice(places, min(places, share // EXCERPT + 2), replace=False)
    return b"".join(data[i * EXCERPT:(i + 1) * EXCERPT] for i in sorted(chosen.tolist()))[:share]


def _folded_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data = [folded(t) for t in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([len(x) + 1 for x in data], pa.int64()), pa.array(data, pa.binary())],
                                         names=["_lang", "_n", "_h", "_size", "_data"])


def _excerpts(shares: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, h, data = (b.column(i).to_pylist() for i in (0, 2, 4))
            parts = [excerpt(x, shares[k] - 1, seed) for k, seed, x in zip(lang, h, data, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(parts, pa.binary())], names=["_lang", "_n", "_part"])

    return run


def learn_dictionaries(train: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
                       dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """One dictionary per language value.

    The sample of a language is the ``sample_docs`` distinct training texts with the smallest
    hashes.  They are chosen by hashes alone: distinct ones are dealt by language and salt,
    then at most SALTS * sample_docs of a language meet; the texts of the chosen ones are
    combined before their shuffle, so neither a hot language nor a hot text fills a task.
    Whole texts are folded, and each gives an equal share of the dictionary
    from hash-chosen places all over it; what short texts leave goes to the longer ones.
    At most languages * dict_bytes reach the driver, and the sampled texts' sizes.  Null
    languages and texts without a letter teach nothing; a repeated text counts once.
    """
    t, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    rows = train.filter(lang.isNotNull() & t.rlike(r"\p{L}")).select(lang.alias("_lang"), F.xxhash64(t).alias("_h"), t.alias("_text"))
    least = rows.select("_lang", "_h").distinct()
    for group in (["_lang", F.pmod("_h", F.lit(SALTS))], ["_lang"]):
        least = least.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy("_h"))).filter(F.col("_n") <= sample_docs)
    least = staged(least, "langid-hashes")
    rows = rows.join(least, ["_lang", "_h"]).groupBy("_lang", "_n", "_h").agg(F.min("_text").alias("_text"))
    sample = staged(rows.mapInArrow(_folded_texts, "_lang string, _n int, _h long, _size long, _data binary"), "langid")
    sizes: dict[str, list[int]] = {}
    for r in sample.select("_lang", "_size").toLocalIterator():
        sizes.setdefault(r["_lang"], []).append(r["_size"])
    shares = {k: max(1, level_share(v, dict_bytes)) for k, v in sizes.items()}
    out: dict[str, bytearray] = {}
    for r in sample.mapInArrow(_excerpts(shares), "_lang string, _n int, _part binary").orderBy("_lang", "_n").toLocalIterator():
        out.setdefault(r["_lang"], bytearray()).extend(r["_part"] + b"\n")
    return {k: bytes(v[:dict_bytes]) for k, v in sorted(out.items())}


class Classifier:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL, segment: int = SEGMENT):
        self.langs, self.segment = sorted(dictionaries), segment
        self.coders = []
        for k in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                                        write_checksum=False, write_dict_id=False))

    def sizes(self, data: bytes) -> list[int]:
        parts = [data[i:i + self.segment] for i in range(0, len(data), self.segment)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.coders]

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, relative margin); ``und`` without a letter or a learned language."""
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0
        sizes = self.sizes(folded(text))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0, 1.0
        margin = (sizes[order[1]] - sizes[order[0]]) / max(1, sizes[order[1]])
        return self.langs[order[0]], 1 / (1 + math.exp(-margin / MARGIN)), margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             level: int = LEVEL, min_margin: float = MARGIN) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred (the smallest code), score (0.5 to 1 by margin; 0
    for ``und``), margin, rejected (margin under ``min_margin``, or ``und``).

    Null texts and texts without a letter are ``und``; without any dictionary all are.
    Ties go to the language first in order.  Repeated rows and null ids pass through;
    only the id and the text are read, so other columns cannot clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value, level)
        for b in batches:
            found = [model.classify(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.float64()),
                pa.array(np.array([f[0] == UNDETERMINED or f[2] < min_margin for f in found], dtype=bool))],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, margin double, rejected boolean")

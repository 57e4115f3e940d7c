"""Cross-tokenizer alignment: where two tokenizers' tokens of one text end together.

Both token sequences cut the same bytes.  Every token points to its farthest-right
overlapping token (of two that end together, the second tokenizer's); doubling the
pointers leads each token to the terminal one of its component, so all labels of a part
come from a few gathers (``component_labels``).  Components are the groups between bytes
where both sequences end.  Ids that overlap are linked; how many documents link a pair
of ids is counted over the corpus in one shuffle, after counting in every task.

Neither tokenizer can put a token across a single space between other characters (checked
for the second vocabulary).  So both sequences end there, and a text is a row of words whose
groups never reach further: words are aligned once in a task and remembered up to a bound.
Texts longer than ``PART`` go through in runs of words, so they need little more memory.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import staged

#: Characters of text that are encoded at once.
PART = 1 << 20
#: Characters of words (and about as many bytes of tables) that a task remembers before it starts anew.
CACHE_BYTES = 1 << 26
#: Entries of pair lists that are sorted at once when documents are counted.
COUNT_AT_ONCE = 1 << 22
#: Pairs of ids that every task holds with their counts (12 bytes each); the others are joined.
FREQUENT = 1 << 19
#: Vocabulary files are sent to every task and must be smaller.
VOCABULARY_BYTES = 1 << 26
#: Bits of an id; a pair is the first tokenizer's id above the second's.
ID_BITS = 24
# Fixed value: how byte-level BPE cuts a text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizers(NamedTuple):
    """Contents of the two vocabulary files: byte-level BPE (JSON) and pieces with byte fallback."""
    a: bytes
    b: bytes

    @staticmethod
    def read(path_a: str, path_b: str) -> Tokenizers:
        out = Tokenizers(open(path_a, "rb").read(), open(path_b, "rb").read())
        if max(map(len, out)) > VOCABULARY_BYTES:
            raise ValueError(f"a vocabulary file has more than {VOCABULARY_BYTES} bytes")
        return out


class Encoder(NamedTuple):
    """Both tokenizers in a task: encoders of one text, and the bytes of every id."""
    encode_a: Callable[[str], np.ndarray]
    encode_b: Callable[[str], list]
    bytes_a: list
    bytes_b: list
    size_a: np.ndarray
    size_b: np.ndarray
    names: list
    cuts: bool


def byte_of_character() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(files: Tokenizers) -> Encoder:
    import sentencepiece
    import tiktoken
    import tokenizers

    spec = json.loads(files.a)
    special = {t["content"] for t in spec.get("added_tokens", ()) if t.get("special")}
    letters = byte_of_character()
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    a = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    bytes_a = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        bytes_a[i] = token
    slow = []

    def encode_a(text: str) -> np.ndarray:
        try:
            return a.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:  # very long runs of white space: its expressions give up
            if not slow:
                slow.append(tokenizers.Tokenizer.from_buffer(files.a))
                slow[0].encode_special_tokens = True
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.int64)

    b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
    pieces = [b.id_to_piece(i) for i in range(b.vocab_size())]
    bytes_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    if max(len(bytes_a), len(bytes_b)) >= 1 << ID_BITS:
        raise ValueError("a vocabulary has too many ids")
    names = lambda n: [f"{sep}{i}" for sep in ",;|" for i in range(n)]  # noqa: E731  every id after each separator
    return Encoder(encode_a, b.encode, bytes_a, bytes_b,
                   np.array([len(x) for x in bytes_a]), np.array([len(x) for x in bytes_b]), [*names(len(bytes_a)), *names(len(bytes_b)), "\n"],
                   not any("▁" in p.lstrip("▁") for p in pieces))


#: A space where neither tokenizer puts one token across: alone, between other characters.
GAP = re.compile(r"(?<=\S) (?=\S)")


def component_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every token of two sequences that end together, by pointer jumping."""
    n = len(ends_a)
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)  # the token that holds the last byte
    own = np.arange(len(ends_b))
    further = ends_a[over_b] > ends_b
    to = np.concatenate([n + over_a, np.where(further, over_b, n + own)])
    while True:
        jump = to[to]
        if np.array_equal(jump, to):
            break
        to = jump
    terminal = to[n:] == n + own
    label = np.cumsum(terminal) - 1
    return label[to[:n] - n], label[to[n:] - n]


class Tokens(NamedTuple):
    """Both token sequences of a text: ids and the byte where each token ends."""
    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


def tokens(runs: list[str], enc: Encoder) -> Tokens | None:
    """Tokens of runs of words, a space before each; None where either tokenizer changes their bytes."""
    spaced = [" " + r for r in runs]
    a, b = np.concatenate([enc.encode_a(r) for r in spaced]), list(itertools.chain.from_iterable(map(enc.encode_b, runs)))
    whole = "".join(spaced).encode()
    if not b or b"".join(map(enc.bytes_b.__getitem__, b)) != whole or b"".join(map(enc.bytes_a.__getitem__, a.tolist())) != whole:
        return None
    b = np.array(b, np.int64)
    return Tokens(a, b, np.cumsum(enc.size_a[a]), np.cumsum(enc.size_b[b]))


def links(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping pairs, as indexes in a and b: one for each byte where a token of either sequence ends."""
    over_a, over_b = np.searchsorted(t.ends_b, t.ends_a), np.searchsorted(t.ends_a, t.ends_b)
    alone = np.flatnonzero(t.ends_a[over_b] != t.ends_b)  # ends of b inside a token of a
    return np.concatenate([np.arange(len(t.a)), over_b[alone]]), np.concatenate([over_a, alone])


def _at_edge(word: str) -> bool:
    """White space at an end, which only a text's first and last words have: it could run into another word's space."""
    return word[0].isspace() or word[-1].isspace()


class Words:
    """Aligned words that a task has seen: a text is the row of its words, each with its own groups.

    New words are encoded together, one space apart (those with white space at an end alone).  When a vocabulary can put a token across
    such a space, every text is one word.
    """

    def __init__(self, enc: Encoder) -> None:
        self.enc = enc
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.held = 0
        self.sizes = np.empty((0, 4), np.int64)  # tokens of a and b, groups, links; tokens 0: changed by a tokenizer
        self.pairs, self.at = np.empty(0, np.int64), np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        return GAP.split(text) if self.enc.cuts else [text]

    def learn(self, words: Iterator[str]) -> None:
        """Knows ``words`` afterwards, and maybe no others."""
        distinct = dict.fromkeys(words)
        new = [w for w in distinct if w not in self.index]
        if self.held > CACHE_BYTES:
            self.clear()
            new = list(distinct)
        if not new:
            return
        new.sort(key=_at_edge)
        done = [self._aligned(ws, t) for ws, t in self._encoded(new)]
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.texts.extend(itertools.chain.from_iterable(x[0] for x in done))
        sizes = np.concatenate([x[1] for x in done])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pairs = np.concatenate([self.pairs, *(x[2] for x in done)])
        self.at = np.concatenate([[0], np.cumsum(self.sizes[:, 3])])
        self.held += sum(map(len, new)) + 200 * len(new)

    def _encoded(self, words: list[str]) -> Iterator[tuple[list[str], Tokens | None]]:
        """Words with their tokens, together (in runs of some kilobytes, which the second tokenizer does
        faster), and halved until those that a tokenizer changes stand alone."""
        inner = sum(1 for w in words if not _at_edge(w)) if self.enc.cuts else 0
        runs = [" ".join(words[lo:min(lo + 256, inner)]) for lo in range(0, inner, 256)] + words[inner:]
        t = tokens(runs, self.enc) if self.enc.cuts or len(words) == 1 else None
        if t or len(words) == 1:
            yield words, t
        else:
            yield from self._encoded(words[:len(words) // 2])
            yield from self._encoded(words[len(words) // 2:])

    def _aligned(self, words: list[str], t: Tokens | None) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Groups as text (each after a semicolon), sizes and pairs of the words that ``t`` has the tokens of."""
        if t is None:
            return [""], np.zeros((1, 4), np.int64), np.empty(0, np.int64)
        ga, gb = component_labels(t.ends_a, t.ends_b)
        first_a, first_b = (np.concatenate([[True], g[1:] != g[:-1]]) for g in (ga, gb))
        upto_a, upto_b = (np.bincount(g).cumsum() for g in (ga, gb))
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        cut_a, cut_b = (np.searchsorted(e, ends) + 1 for e in (t.ends_a, t.ends_b))
        named = np.empty(len(ga) + len(gb), np.int64)  # a's tokens of a group, then b's
        width_a, width_b = len(self.enc.bytes_a), len(self.enc.bytes_b)
        named[np.arange(len(ga)) + (upto_b - np.bincount(gb))[ga]] = t.a + first_a * width_a
        named[np.arange(len(gb)) + upto_a[gb]] = 3 * width_a + t.b + first_b * 2 * width_b
        named = np.insert(named, cut_a + cut_b, len(self.enc.names) - 1)  # the last name ends a word
        text = "".join(map(self.enc.names.__getitem__, named.tolist())).split("\n")[:-1]
        i, j = links(t)
        word = np.searchsorted(cut_a, i, "right")
        order = np.argsort(word, kind="stable")
        pairs = ((t.a[i] << ID_BITS) | t.b[j])[order]
        starts = lambda cut: np.diff(cut, prepend=0)
        groups = starts(np.cumsum(first_b)[cut_b - 1])
        return text, np.stack([starts(cut_a), starts(cut_b), groups, np.bincount(word, minlength=len(words))], 1), pairs


def packed_pairs(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs and how often each occurs: differences and counts byte by byte, compressed."""
    raw = np.concatenate([np.diff(pairs, prepend=0), counts]).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(raw).tobytes(), 1)


def unpacked_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1).T
    both = np.ascontiguousarray(raw).view("<i8").ravel()
    n = len(both) // 2
    return np.cumsum(both[:n]), both[n:]


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def _counted(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    both, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return both, np.bincount(at, weights=np.concatenate(counts), minlength=len(both)).astype(np.int64)


NO_TOKENS = (0, 0, 0, 0, "", b"")


def aligned_text(words: list[str], known: Words, step: int) -> tuple:
    """Numbers of tokens, groups and links, digest and packed pairs of one text, ``step`` words at a time."""
    n, digest, lists = np.zeros(4, np.int64), hashlib.sha256(), []
    for lo in range(0, len(words), step):
        some = words[lo:lo + step]
        if len(words) > step:
            known.learn(some)
        at = np.fromiter(map(known.index.__getitem__, some), np.int64, len(some))
        sizes = known.sizes[at]
        if not sizes[:, 0].all():
            return NO_TOKENS
        digest.update("".join(map(known.texts.__getitem__, at.tolist())).encode()[0 if lo else 1:])
        n += sizes.sum(0)
        stop = np.cumsum(sizes[:, 3])
        where = np.repeat(known.at[at] - stop + sizes[:, 3], sizes[:, 3]) + np.arange(stop[-1])
        lists.append(np.unique(known.pairs[where], return_counts=True))
    return *map(int, n), digest.hexdigest(), packed_pairs(*(lists[0] if len(lists) == 1 else _counted(*zip(*lists, strict=True))))


def aligned_texts(texts: list[str | None], known: Words, size: int) -> Iterator[tuple]:
    """:func:`aligned_text` of every text; about ``size`` characters of new words are learned together."""
    step = max(1, size // 8)
    rows = iter(texts)
    while group := list(itertools.islice(rows, 1)):
        held = len(group[0] or "")
        while held < size and (more := list(itertools.islice(rows, 1))):
            group += more
            held += len(more[0] or "")
        split = [known.split(t) if t else [] for t in group]
        known.learn(itertools.chain.from_iterable(w for w in split if len(w) <= step))
        for words in split:
            yield aligned_text(words, known, step) if words else NO_TOKENS


def aligned(docs: DataFrame, files: Tokenizers, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """One row per row of ``docs``: numbers of tokens, groups and links, the digest of the groups, and
    the packed list of linked pairs (:func:`unpacked_pairs`).  Null and empty texts, and texts whose
    bytes a tokenizer changes, have zeros, an empty digest and an empty list.  ``row`` numbers the rows."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(files))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = None, TaskContext.get().partitionId() << 33
        names = [x.split()[0] for x in ALIGNED.split(", ")]
        for batch in batches:
            known = known or Words(encoder(Tokenizers(*sent.value)))
            ids, texts = (c.to_pylist() for c in batch.columns)
            rows = [(row + k, i, *out) for k, (i, out) in enumerate(zip(ids, aligned_texts(texts, known, part), strict=True))]
            row += len(texts)
            kinds = [pa.int64()] * 6 + [pa.string(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows
                                  else [pa.array([], k) for k in kinds], names)

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(task, ALIGNED)


def group_spans(docs: DataFrame, files: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The groups themselves: (doc_id, group, start, end, a_ids, b_ids), bytes counted in space + text."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(files))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for batch in batches:
            enc = enc or encoder(Tokenizers(*sent.value))
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                p = tokens([text], enc) if text else None
                if p is None:
                    continue
                ga, gb = component_labels(p.ends_a, p.ends_b)
                stop_a, stop_b = (np.flatnonzero(np.diff(g, append=-1)) + 1 for g in (ga, gb))
                ends = p.ends_a[stop_a - 1]
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], s]), pa.int32()), pa.array(ids, pa.int64()))
                         for s, ids in ((stop_a, p.a), (stop_b, p.b))]
                n = len(ends)
                yield pa.record_batch([pa.array([doc] * n, pa.int64()), pa.array(np.arange(n)), pa.array(np.concatenate([[0], ends[:-1]])),
                                       pa.array(ends), *lists], ["doc_id", "group", "start", "end", "a_ids", "b_ids"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        task, "doc_id long, group long, start long, end long, a_ids array<long>, b_ids array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents of :func:`aligned` that link the pair, and whether no other pair of its
    first id has more.  Every task counts before the shuffle."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, lists, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged():
            own, n = np.unique(np.concatenate(lists), return_counts=True)
            return _counted([pairs, own], [counts, n])

        for batch in batches:
            for blob in batch.column(0).to_pylist():
                if blob:
                    lists.append(unpacked_pairs(blob)[0])
                    held += len(lists[-1])
                    if held >= COUNT_AT_ONCE + len(pairs):
                        pairs, counts = merged()
                        lists, held = [], 0
        if lists:
            pairs, counts = merged()
        for lo in range(0, len(pairs), 1 << 16):
            yield pa.record_batch([pa.array(pairs[lo:lo + (1 << 16)]), pa.array(counts[lo:lo + (1 << 16)])], ["pair", "n"])

    n = rows.select("pairs").mapInArrow(task, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = staged(n, "pairs").withColumn("a", F.shiftright("pair", ID_BITS))
    most = n.groupBy("a").agg(F.max("n").alias("most"))
    return n.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, limit: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that more documents link than a bound, at most ``limit`` of them, and that bound."""
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("n")).limit(limit).toPandas()
    enough = sizes[sizes["pairs"].cumsum() <= limit]["n"]
    if not len(enough):
        return 1 << 62, *(np.empty(0, np.int64) for _ in range(3))
    bound = int(enough.min())
    rows = counts.filter(F.col("n") >= bound).toPandas().sort_values("pair")
    return bound, rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["best"].to_numpy(np.int64)


def align_documents(docs: DataFrame, files: Tokenizers, id_col: str = "doc_id", text_col: str = "text",
                    frequent: int = FREQUENT, part: int = PART) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    Null, empty and changed texts (see :func:`aligned`) have zeros and an empty digest.  Repeated
    rows are documents of their own.  Ties for the highest count are all best.  Other columns
    are left out.  The ``frequent`` most linked pairs are looked up in the tasks; entries of the
    others are joined, and no pair of those is linked by many documents.
    """
    rows = staged(aligned(docs, files, id_col, text_col, part), "aligned")
    counts = staged(pair_counts(rows), "pair_counts")
    bound, *table = _frequent(counts, frequent)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent.value
        for batch in batches:
            out = []
            for row, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, times = unpacked_pairs(blob) if blob else (np.empty(0, np.int64),) * 2
                at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
                known = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
                k, t = at[known], times[known]
                out.append((np.array([row]), np.array([-1]), np.array([0]), np.array([t @ best[k]]), np.array([t @ n[k]])))
                if rest := int((~known).sum()):
                    zero = np.zeros(rest, np.int64)
                    out.append((zero + row, own[~known], times[~known], zero, zero))
            yield pa.record_batch([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out, strict=True)] if out
                                  else [pa.array([], pa.int64())] * 5, ["row", "pair", "times", "n_best", "count_sum"])

    looked = staged(rows.select("row", "pairs").mapInArrow(task, "row long, pair long, times long, n_best long, count_sum long"), "looked_up")
    rest = looked.filter("pair >= 0").select("row", "pair", "times").join(counts.filter(F.col("n") < bound), "pair")
    summed = looked.filter("pair < 0").select("row", "n_best", "count_sum").unionAll(
        rest.select("row", F.expr("times * cast(best AS long)"), F.col("times") * F.col("n")))
    sums = summed.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs").join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

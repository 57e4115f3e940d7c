import random

import numpy as np
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stayflow.llm.tiling import clean_documents, contaminated_pairs, tiles

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("item_id", StringType())])
ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType()), StructField("doc_id", StringType())])


def greedy(a, b, least):
    """Greedy string tiling by trying every pair of positions again for each tile."""
    x, y, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not x[i + k] and not y[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return out
        k, i, j = best
        x[i:i + k], y[j:j + k] = [True] * k, [True] * k
        out.append((i, j, k))


def test_tiles_are_greedy_and_disjoint():
    rnd = random.Random(4)
    for _ in range(150):
        a = [rnd.randrange(4) for _ in range(rnd.randint(0, 30))]
        b = [rnd.randrange(4) for _ in range(rnd.randint(0, 40))]
        if len(a) > 6:
            b[3:3] = a[len(a) // 2:] + [9] + a[:len(a) // 2]
        got = tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        want = greedy(a, b, 3)
        for i, j, k in got:
            assert a[i:i + k] == b[j:j + k]
        for side in (0, 1):
            used = [p for t in got for p in range(t[side], t[side] + t[2])]
            assert len(used) == len(set(used))
        assert [t[2] for t in got][:1] == [t[2] for t in want][:1]
        assert all(t[2] >= 3 for t in got)
        # nothing of three tokens is left
        x, y = {p for t in got for p in range(t[0], t[0] + t[2])}, {p for t in got for p in range(t[1], t[1] + t[2])}
        for i in range(len(a) - 2):
            for j in range(len(b) - 2):
                assert a[i:i + 3] != b[j:j + 3] or x & set(range(i, i + 3)) or y & set(range(j, j + 3))


def test_reordered_partial_and_clean(spark):
    rnd = random.Random(1)
    word = lambda k: [f"t{rnd.randrange(10 ** 6)}" for _ in range(k)]
    item = word(40)
    other = word(30)
    docs = [(1, " ".join(word(50) + item + word(20))),
            (2, " ".join(word(9) + item[25:] + word(3) + item[:25]).upper()),
            (3, " ".join(word(80))),
            (4, " ".join(word(10) + item[:15] + word(10))),
            (5, ", ".join(item[:30]) + "."),
            (6, None), (7, ""), (1, " ".join(item)), (None, " ".join(other))]
    bench = [(10, " ".join(item)), (11, " ".join(other)), (12, None), (13, "too short"), (14, "")]
    d, b = spark.createDataFrame([(*r, "x") for r in docs], DOCS).repartition(4), spark.createDataFrame([(*r, "y") for r in bench], ITEMS)
    for block in (1 << 20, 40):
        got = sorted((r["doc_id"] or 0, r["item_id"], r["n_covered"]) for r in contaminated_pairs(d, b, block_tokens=block).collect())
        assert got == [(0, 11, 30), (1, 10, 40), (1, 10, 40), (2, 10, 40), (5, 10, 30)]
    left = clean_documents(d, b)
    assert left.columns == d.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 6, 7]
    assert contaminated_pairs(d.limit(0), b).collect() == []
    assert contaminated_pairs(d, b.limit(0)).collect() == []

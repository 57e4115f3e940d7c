"""Greedy string tiling and the contaminated pairs against plain Python."""

import random

import numpy as np

from stayflow.llm.tiling import COVERAGE, SEED, contaminated_pairs, tiles


def plain_tiles(item, text, least):
    """Rescans for the longest unmarked match after every mark; ties by place in the item, then in the text."""
    in_item, in_text, out = [False] * len(item), [False] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]
                       and not in_item[i + n] and not in_text[j + n]):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        in_item[i:i + n], in_text[j:j + n] = [True] * n, [True] * n
        out.append((i, j, n))


def test_tiles_equal_a_plain_greedy_tiling():
    rnd = random.Random(11)
    for round_ in range(150):
        size = rnd.choice([2, 3, 6, 30])
        item = [rnd.randrange(size) for _ in range(rnd.randint(0, 40))]
        text = [rnd.randrange(size) for _ in range(rnd.randint(0, 40))]
        if round_ % 3 == 0:  # a reordered passage
            cut = len(item) // 2
            text = text[:10] + item[cut:] + text[10:] + item[:cut]
        got = tiles(np.array(item, np.uint64), np.array(text, np.uint64), 4)
        assert sorted(got) == sorted(plain_tiles(item, text, 4)), (item, text)


def test_pairs_equal_a_plain_search(spark):
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([4, 8, 25, 40])))) for i in range(12)] + [(50, ""), (51, None)]
    docs = []
    for d in range(60):
        w = rnd.choices(vocabulary, k=rnd.randint(0, 80))
        if d % 2:
            source = items[d % 12][1].split()
            cut = rnd.randint(0, len(source))
            piece = source[cut:] + w[:3] + source[:cut]
            if d % 3 == 0:
                piece = piece[:len(piece) // 2]
            w = w[:20] + piece + w[20:]
        docs.append((d, " ".join(w).upper() if d % 5 == 0 else ", ".join(w)))
    docs += [(100, None), (101, ""), (102, docs[1][1]), (102, docs[1][1])]
    want = []
    for d, t in docs:
        for i, b in items:
            text, item = (t or "").lower().replace(",", " ").split(), (b or "").split()
            if len(item) < SEED:
                continue
            found = plain_tiles(item, text, SEED)
            covered = sum(x[2] for x in found)
            if covered >= COVERAGE * len(item):
                want.append((d, i, len(item), covered, covered / len(item), len(found)))
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len({r[0] for r in want}) > 10
    for block in (1 << 20, 60):
        assert sorted(tuple(r) for r in contaminated_pairs(df, bench, block_tokens=block).collect()) == sorted(want)

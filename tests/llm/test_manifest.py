"""Hash trees against a plain version, places against the log, edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stayflow.llm import manifest as m
from stayflow.llm.common import fold, staged

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, leaf string, _hash long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """(root, siblings of every leaf, whether each stands after) level by level."""
    paths = [[] for _ in nodes]
    at, level = list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            other = i ^ 1
            paths[k].append(None if other >= len(level) else (level[other], other > i))
            at[k] = i // 2
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[g] = own, *plain_tree([leaf(r) for r in own])
    root, up = plain_tree([subs[g][1] for g in names])
    out = []
    for k, g in enumerate(names):
        own, sub, paths = subs[g]
        for r, p in zip(own, paths):
            path = p + up[k]
            changed = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 0
            x = leaf(r, int(changed))
            for s in path:
                x = h(x) if s is None else h(x, s[0]) if s[1] else h(s[0], x)
            out.append((r[0], leaf(r), sub, root, h(*[s[0] for s in path if s]), x, x == root))
    return sorted(out, key=str)


def result(spark, rows, levels):
    df = spark.createDataFrame([(*r, "mine", 5) for r in rows], SCHEMA).repartition(3)
    out = m.manifest(df, fold(F.col("doc_id"), 7) == 0, levels=levels)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in out.select(*cols).collect()], key=str)


def rows_of(sizes):
    out = []
    for g, n in sizes.items():
        out += [(len(out) * 3 + k * 2, None if k % 5 == 4 else f"s{k}", g, None if k % 6 == 5 else k * 7, None if k % 7 == 6 else f"tëxt {k}\n")
                for k in range(n)]
    return out


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_equal_to_a_plain_version(spark, levels):
    rows = rows_of({"en": 37, None: 8, "de": 1, "Ä": 5, "": 2})
    assert result(spark, rows, levels) == brute(rows)


def test_null_ids_repeated_rows_and_a_lone_leaf(spark):
    rows = [(None, "a", "en", 1, "x"), (None, None, None, None, None), (4, "a", "en", 1, "x"), (4, "a", "en", 1, "x"), (4, "b", "en", 2, "long " * 20000)]
    assert result(spark, rows, 2) == brute(rows)
    lone = [(9, "a", "en", 1, "x")]
    got = result(spark, lone, 2)
    assert got == brute(lone) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")


def test_empty_table(spark):
    assert result(spark, [], 2) == []


def test_tampered_rows_fail_unless_the_number_is_null(spark):
    rows = rows_of({"en": 60})
    for r, got in zip(sorted(rows), sorted(result(spark, rows, 3))):
        changed = zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
        assert got[6] == (not changed)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 13, 64, 100])
def test_places_are_the_order_of_completion(n):
    height = len(m.widths(n)) - 1
    nodes = [h(str(k)) for k in range(n)]
    log = m.built(nodes, height)
    level, seen = nodes, set()
    for k, width in enumerate(m.widths(n)):
        for i in range(width):
            at = m.place(k, i, n)
            assert log[at] == level[i]
            if k:  # postorder: children before their parent
                assert all(m.place(k - 1, c, n) < at for c in (2 * i, 2 * i + 1) if c < m.widths(n)[k - 1])
            seen.add(at)
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
    assert seen == set(range(len(log)))


def test_log_of_many_builders_is_one_postorder_log(spark):
    n = 45
    leaves = spark.createDataFrame([("=g", i, n, h(str(i))) for i in range(n)], "_group string, _index long, _size long, _hash string")
    rounds, root = m.trees(staged(leaves, "leaves"), 2, "log")
    got = m.log_entries(rounds, 2).collect()
    whole = m.built([h(str(i)) for i in range(n)], len(m.widths(n)) - 1)
    assert len(rounds) == 3 and len(got) == len(whole)
    assert {r["place"]: r["digest"] for r in got} == dict(enumerate(whole))
    assert root.first()["_hash"] == whole[-1]

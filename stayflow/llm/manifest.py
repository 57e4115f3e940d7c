"""Merkle manifest: hash trees over the documents of every language, as postorder append logs.

Leaves of a group stand in order.  Aligned builders each take ``2 ** LEVELS`` neighbouring
nodes of one level, and write the nodes above them in the order in which they become
complete.  That is postorder, so a node's place in its group's log follows from sizes of
complete subtrees (``place``), and a proof finds its siblings by address: inside its
builder's segment by the difference of two places, above it in the segment of the next
builders.  A group of n leaves takes log(n) / LEVELS rounds, and no task sees more than
``2 ** LEVELS`` nodes of a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.common import staged

#: Levels that one builder adds.
LEVELS = 10
HEX = 64


def joined_hash(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def complete_before(leaves: int) -> int:
    """Nodes that are complete when ``leaves`` leaves are appended: 2 * leaves less the ones in its binary form."""
    return 2 * leaves - leaves.bit_count()


def widths(leaves: int) -> list[int]:
    """Nodes on every level of a tree, leaves first: halved and rounded up until one is left."""
    out = [leaves]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out


def place(level: int, index: int, leaves: int) -> int:
    """Postorder place of a node of a tree of so many leaves: a full subtree is complete with its last
    leaf, the others, at the right edge, are closed level by level at the end."""
    last = (index + 1) << level
    if last <= leaves:
        return complete_before(last - 1) + level
    full = sum(1 for k in range(1, level) if ((leaves + (1 << k) - 1) >> k) << k != leaves)
    return complete_before(leaves) + full


def built(nodes: list[str], height: int) -> list[str]:
    """Log of a builder over ``nodes``: appended in order of completion, then closed up to ``height``."""
    log, open_at = [], [[] for _ in range(height + 1)]  # nodes of each level that wait for a sibling

    def put(level: int, digest: str) -> None:
        log.append(digest)
        if level < height:
            open_at[level].append(digest)
            if len(open_at[level]) == 2:
                pair, open_at[level] = open_at[level], []
                put(level + 1, joined_hash(*pair))

    for digest in nodes:
        put(0, digest)
    for level in range(height):
        if open_at[level]:
            rest, open_at[level] = open_at[level], []
            put(level + 1, joined_hash(*rest))
    return log


def siblings(index: int, leaves: int, height: int) -> list[int]:
    """Places of the siblings of a leaf in a log of ``height`` levels, bottom up: -1 where it has none."""
    out, width = [], widths(leaves) + [1] * height
    for level in range(height):
        other = (index >> level) ^ 1
        out.append(place(level, other, leaves) if other < width[level] else -1)
    return out


def numbered(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``_index`` (place in its group, in ``order``) and ``_size`` of the group.

    Rows are dealt by ranges of group and order, and counted per range, so a group of any size is
    numbered by many tasks.
    """
    g = F.col(group)
    rows = df.repartitionByRange(g.asc_nulls_first(), *order).sortWithinPartitions(g.asc_nulls_first(), *order)
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_range", F.shiftright("_row", 33)).withColumn("_group", F.coalesce(F.concat(F.lit("="), g), F.lit("")))
    of = rows.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy("_group")  # a row for each range that the group has
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    of = of.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_size", F.sum("_n").over(whole))
    out = rows.join(of.select("_group", "_range", "_first", "_before", "_size"), ["_group", "_range"])
    return out.withColumn("_index", F.col("_row") - F.col("_first") + F.col("_before")).drop("_range", "_row", "_first", "_before")


def _segments(nodes: DataFrame, levels: int, name: str) -> DataFrame:
    """Builders over (_group, _index, _size, _hash): (_group, _block, _size, _height, _log), digests in postorder."""
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("_index")
        size = table["_size"][0].as_py()
        height = min(levels, len(widths(size)) - 1)
        log = "".join(built(table["_hash"].to_pylist(), height))
        return pa.table([table["_group"][:1], table["_block"][:1], table["_size"][:1], pa.array([height], pa.int32()), pa.array([log])],
                        names=["_group", "_block", "_size", "_height", "_log"])

    blocks = nodes.select("_group", "_index", "_size", "_hash").withColumn("_block", F.shiftright("_index", levels))
    return staged(blocks.groupBy("_group", "_block").applyInArrow(
        build, "_group string, _block long, _size long, _height int, _log string"), name)


def _above(segments: DataFrame) -> DataFrame:
    """The top nodes of builders as nodes of the next round."""
    width = F.ceil(F.col("_size") / F.pow(F.lit(2.0), F.col("_height"))).cast("long")
    return segments.select("_group", F.col("_block").alias("_index"), width.alias("_size"),
                           F.substring("_log", -HEX, HEX).alias("_hash"))


def trees(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All builders of the trees over (_group, _index, _size, _hash), round by round, and the roots (_group, _hash)."""
    rounds = []
    while True:
        rounds.append(_segments(nodes, levels, f"{name}{len(rounds)}"))
        nodes = _above(rounds[-1])
        if not nodes.filter("_size > 1").limit(1).count():
            return rounds, nodes.select("_group", "_hash")


def log_entries(rounds: list[DataFrame], levels: int) -> DataFrame:
    """The logs themselves: (_group, level, index, place, digest) of every node, by its place in its group's log."""
    sizes = rounds[0].groupBy("_group").agg(F.max("_size").alias("_leaves"))
    out = None
    for k, segments in enumerate(rounds):
        def entries(batches: Iterator[pa.RecordBatch], base: int = k * levels) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    leaves = min(r["_size"] - (r["_block"] << levels), 1 << levels)
                    width = widths(leaves) + [1] * r["_height"]
                    own = [(level, i) for level in range(min(base, 1), r["_height"] + 1) for i in range(width[level])]
                    rows = [(base + level, (r["_block"] << (levels - level)) + i, place(level, i, leaves)) for level, i in own]
                    yield pa.record_batch([
                        pa.array([r["_group"]] * len(rows), pa.string()), pa.array([x[0] for x in rows], pa.int64()),
                        pa.array([x[1] for x in rows], pa.int64()),
                        pa.array([place(level, i, r["_leaves"]) for level, i, _ in rows], pa.int64()),
                        pa.array([r["_log"][at * HEX:(at + 1) * HEX] for _, _, at in rows], pa.string())],
                        ["_group", "level", "index", "place", "digest"])

        one = segments.join(sizes, "_group").mapInArrow(entries, "_group string, level long, index long, place long, digest string")
        out = one if out is None else out.unionAll(one)
    return out


def _extend(nodes: DataFrame, segments: DataFrame, above: DataFrame | None, levels: int, keep: list[str], rest: str) -> DataFrame:
    """Proofs of nodes (_group, _index, _size, keep columns) of one round.

    ``above`` has the ``_proof`` of every segment's top node: pairs of a side and a digest, bottom up.
    Each segment meets the nodes it was built from, at most ``2 ** levels`` of them.
    """
    if above is not None:
        segments = segments.join(above.select("_group", F.col("_index").alias("_block"), F.col("_proof")), ["_group", "_block"])
    else:
        segments = segments.withColumn("_proof", F.lit(""))

    def extend(mine: pa.Table, segment: pa.Table) -> pa.Table:
        log, rest, height = (segment[c][0].as_py() for c in ("_log", "_proof", "_height"))
        first = segment["_block"][0].as_py() << levels
        leaves = min(segment["_size"][0].as_py() - first, 1 << levels)
        out = []
        for index in mine["_index"].to_pylist():
            own = index - first
            steps = []
            for level, at in enumerate(siblings(own, leaves, height)):
                steps.append("." if at < 0 else ("l" if own >> level & 1 else "r") + log[at * HEX:(at + 1) * HEX])
            out.append("".join(steps) + rest)
        return mine.drop_columns(["_block"]).append_column("_proof", pa.array(out, pa.string()))

    cols = ["_group", "_index", *keep]
    blocks = nodes.select(*cols).withColumn("_block", F.shiftright("_index", levels))
    return blocks.groupBy("_group", "_block").cogroup(segments.groupBy("_group", "_block")).applyInArrow(
        extend, f"_group string, _index long{rest}, _proof string")


def with_proofs(nodes: DataFrame, rounds: list[DataFrame], levels: int, above: DataFrame | None, keep: list[str], types: str) -> DataFrame:
    """``nodes`` with the ``_proof`` up to the top of ``above`` (proofs of the groups' roots), from the top round down."""
    proofs = None if above is None else above.select("_group", F.lit(0).cast("long").alias("_index"), "_proof")
    for k in range(len(rounds) - 1, 0, -1):  # a group whose tree ended before has a lone node in the later rounds
        proofs = _extend(_above(rounds[k - 1]), rounds[k], proofs, levels, [], "")
    return _extend(nodes, rounds[0], proofs, levels, keep, types)


def folded(leaf: str, proof: str) -> str:
    """Root that a leaf and its proof give."""
    at = 0
    while at < len(proof):
        side = proof[at]
        if side == ".":
            leaf, at = joined_hash(leaf), at + 1
        else:
            other, at = proof[at + 1:at + 1 + HEX], at + 1 + HEX
            leaf = joined_hash(other, leaf) if side == "l" else joined_hash(leaf, other)
    return leaf


def only_siblings(proof: str) -> str:
    """The digests of a proof, without sides and levels that have no sibling."""
    return proof.replace(".", "").replace("l", "").replace("r", "")


def leaf_hash(*columns: Column) -> Column:
    """Digest of a row: of every column its length in bytes, a colon and the value, or - for null."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def manifest(docs: DataFrame, changed: Column, group_col: str = "lang", id_col: str = "doc_id", columns: tuple[str, ...] = (
        "doc_id", "source", "lang", "n_chars", "text"), number_col: str = "n_chars", levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (sides and digests), checked against a tampered copy: folded_root, verified.

    One tree over the leaves of each value of ``group_col`` (null is a group of its own, the first), in
    order of the id (null first; rows that share an id by their digest; equal rows are leaves of
    their own), and one over the subroots in the groups' bytewise order.  Where ``changed``,
    ``number_col`` is one higher in the tampered copy (null stays).  An empty table has no rows.
    """
    def value(c: str) -> Column:
        return F.col(f"`{c}`")

    other = [F.when(changed, value(c) + 1).otherwise(value(c)) if c == number_col else value(c) for c in columns]
    leaves = staged(docs.select(value(id_col).cast("long").alias("doc_id"), value(group_col).cast("string").alias("_g"),
                                leaf_hash(*map(value, columns)).alias("_hash"),
                                F.when(changed & value(number_col).isNotNull(), leaf_hash(*other)).alias("_tampered")), "leaves")
    nodes = staged(numbered(leaves, "_g", [F.col("doc_id").asc_nulls_first(), F.col("_hash").asc()], "ordered").drop("_g"), "nodes")
    low, subroots = trees(nodes, levels, "log")
    tops = numbered(subroots.withColumn("_g", F.lit("")).withColumnRenamed("_group", "_of"), "_g", [F.col("_of").asc()], "subroots")
    tops = staged(tops.drop("_g"), "tops")
    high, root = trees(tops, levels, "top_log")
    up = with_proofs(tops, high, levels, None, ["_of", "_hash"], ", _of string, _hash string")
    up = staged(up.select(F.col("_of").alias("_group"), F.col("_hash").alias("subroot"), "_proof"), "subroot_proofs")
    own = with_proofs(nodes, low, levels, up, ["doc_id", "_hash", "_tampered"], ", doc_id long, _hash string, _tampered string")

    def fold_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proofs = batch["_proof"].to_pylist()
            given = [t or h for t, h in zip(batch["_tampered"].to_pylist(), batch["_hash"].to_pylist(), strict=True)]
            yield pa.record_batch([batch["_group"], batch["doc_id"], batch["_hash"], batch["_proof"],
                                   pa.array([hashlib.sha256(only_siblings(p).encode()).hexdigest() for p in proofs], pa.string()),
                                   pa.array([folded(h, p) for h, p in zip(given, proofs, strict=True)], pa.string())],
                                  ["_group", "doc_id", "leaf", "proof", "proof_sha256", "folded_root"])

    out = own.select("_group", "doc_id", "_hash", "_tampered", "_proof").mapInArrow(
        fold_up, "_group string, doc_id long, leaf string, proof string, proof_sha256 string, folded_root string")
    out = out.join(up.select("_group", "subroot"), "_group").withColumn("root", root.select("_hash").scalar())
    return out.select("doc_id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql() -> str:
    """The same for ``documents`` in DuckDB: levels by recursion, proofs by joins, crc32 bit by bit."""
    def leaf(n_chars: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
        return f"sha256({' || '.join(parts)})"

    def tree(name: str, leaves: str) -> str:
        return f"""{name} AS (
  SELECT 0 AS level, g, i, n, h FROM {leaves}
  UNION ALL
  SELECT level + 1, g, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY level, g, i // 2)"""

    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))), lambda c, b: {bits}), 4294967295)"
    return f"""WITH RECURSIVE d AS (
  SELECT doc_id, lang, {leaf('n_chars')} AS h, CASE WHEN {crc} % 7 = 0 THEN {leaf('n_chars + 1')} ELSE {leaf('n_chars')} END AS other,
         coalesce('=' || lang, '') AS g FROM documents),
low0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
{tree('low', 'low0')},
high0 AS (SELECT '' AS g, g AS lang, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h FROM low WHERE n = 1),
{tree('high', 'high0')},
steps AS (
  SELECT s.g, s.doc_id, low.level, low.h AS sibling, low.i > (s.i >> low.level) AS after FROM low0 s
  LEFT JOIN low ON low.g = s.g AND low.n > 1 AND low.i = xor(s.i >> low.level, 1)
  UNION ALL
  SELECT s.g, s.doc_id, 100 + high.level, high.h, high.i > (t.i >> high.level) FROM low0 s JOIN high0 t ON t.lang = s.g
  JOIN high ON high.n > 1 AND high.i = xor(t.i >> high.level, 1)),
proofs AS (SELECT doc_id, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY doc_id),
heights AS (SELECT g, max(level) AS top FROM low GROUP BY g),
folds AS (
  SELECT s.doc_id, s.g, 0 AS level, s.other AS h FROM low0 s
  UNION ALL
  SELECT f.doc_id, f.g, CASE WHEN f.level < 100 AND f.level + 1 >= k.top THEN 100 ELSE f.level + 1 END,
         CASE WHEN f.level < 100 AND k.top = 0 THEN f.h
              WHEN t.sibling IS NULL THEN sha256(f.h) WHEN t.after THEN sha256(f.h || t.sibling) ELSE sha256(t.sibling || f.h) END
  FROM folds f JOIN heights k ON k.g = f.g LEFT JOIN steps t ON t.doc_id = f.doc_id AND t.level = f.level
  WHERE f.level < 100 + (SELECT max(level) FROM high)),
ends AS (SELECT doc_id, max_by(h, level) AS folded_root FROM folds GROUP BY doc_id),
subroots AS (SELECT g, h AS subroot FROM low WHERE n = 1), top AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, h AS leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM low0 JOIN subroots USING (g) JOIN proofs USING (doc_id) JOIN ends USING (doc_id), top"""

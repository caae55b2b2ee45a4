"""Trie of conversation prefixes, by fixed-length blocks of turns.

A node at depth d is a distinct sequence of first d turns; conversations that start with it
are its members. Conversations are cut into blocks of ``BLOCK`` turns. Those with equal
digests of all turns before a block and of the block itself are grouped first: one row per
distinct block, copies of a conversation meeting within each task. Where a block has no
sibling (another block after the same turns), all its turn boundaries have the block's
members and nothing more is compared. Only where siblings diverge, the digests at the turn
boundaries inside the blocks are grouped once more. A digest of a sequence is the XOR of the
hashes of its (position, turn), so that blocks combine in any order.

Sums over subtrees need no walk down or up: a node belongs to its smallest member, so every
conversation owns a chain of nodes, the last part of its path. The subtree of a node holds
the whole chains of its members, but for its own owner's chain above the node. So the chains'
totals are grouped over the blocks as the counts were, and a running total along the owner's
chain is taken off.

Nothing grows with one conversation or one node in a task: turns are numbered by a global
sort, running values are taken piece by piece over ``WIDTH`` rows with the pieces' totals
running on a level above, lookups on hot keys are salted. The list of conversations that end
at a node is hashed as a stream of pieces made in parallel.

Fixed cases: null roles and texts count as empty; null turn numbers come first, and turns with one number in
the order of their digests; rows without a conversation id are left out; repeated rows are
turns of their own; a conversation without turns ends at the root; an empty table has no
nodes, not even a root; other columns are not looked at. Very long texts are only hashed and
counted, very long conversations cut as above. Digests have 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import crc32_sql, only
from terrace.operators.joins import balanced_join
from terrace.operators.keys import dense_key
from terrace.sources.tables import materialise

BLOCK = 4
WIDTH = 4096

NODE = ["depth", "p1", "p2"]
_EDGE = ["block", "u1", "u2", "x1", "x2"]


def numbered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, pos, a, b, size): every turn's place from 1, two hashes of role and text, and the text's code points."""
    turns = only(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).filter("conv IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = turns.select(
        F.struct("conv", "turn", F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("b"), text, role).alias("b")).alias("order"),
        F.length(text).cast("long").alias("size"),
    )
    placed = dense_key(narrow, "order", "at").select("at", "order.conv", "order.a", "order.b", "size")
    first = placed.groupBy("conv").agg(F.min("at").alias("first"))
    return balanced_join(placed, first, "conv", "inner").select("conv", (F.col("at") - F.col("first") + 1).alias("pos"), "a", "b", "size")


def with_shared_openings(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) of rebuilt conversations: the first h turns come from the group's first conversation.

    Of conversation c the first h = crc32(c) % ``most`` turns are replaced by the first h of conversation
    c - c % ``group``, as many as it has. ``convs`` (conv) also lists conversations left without turns.
    """
    h = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % most
    openings = turns.filter((F.col("conv") % group == 0) & (F.col("pos") < most)).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("opening")
    )
    convs = turns.select("conv").distinct().withColumn("base", F.col("conv") - F.col("conv") % group)
    convs = convs.join(openings, "base", "left").select(
        "conv", F.slice(F.coalesce("opening", F.array().cast("array<struct<pos:bigint,a:bigint,b:bigint,size:bigint>>")), F.lit(1), h.cast("int")).alias("opening")
    )
    convs = materialise(convs, "rebuilt-convs")
    lengths = convs.select("conv", F.size("opening").alias("shared"))
    own = balanced_join(turns.filter(F.col("pos") > h), lengths, "conv", "inner").select(
        "conv", (F.col("pos") - h + F.col("shared")).alias("pos"), "a", "b", "size"
    )
    shared = convs.select("conv", F.explode("opening").alias("turn")).select("conv", "turn.*")
    return own.unionByName(shared), convs.select("conv")


def running(
    rows: DataFrame, key: str, at: str, values: dict[str, str],
    combine: Callable[[str], Column], merge: Callable[[Column, Column], Column],
) -> DataFrame:
    """Adds, under the names in ``values``, what earlier rows of the key combine to; nothing before counts as 0.

    ``at`` (from 0) orders the rows of a key. Long keys are cut into pieces of ``WIDTH``; the pieces' totals
    run on a level above.
    """
    top = rows.agg(F.max(at).alias("top")).first()["top"]
    piece = f"{at}_piece"
    earlier = Window.partitionBy(key, piece).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.withColumn(piece, F.floor(F.col(at) / WIDTH).cast("long"))
    inner = cut.withColumns({name: F.coalesce(combine(value).over(earlier), F.lit(0)) for name, value in values.items()})
    if top is None or top < WIDTH:
        return inner.drop(piece)
    totals = cut.groupBy(key, piece).agg(*[combine(value).alias(value) for value in values.values()])
    above = {f"{name}_above": value for name, value in values.items()}
    before = running(totals, key, piece, above, combine, merge).drop(*values.values())
    met = balanced_join(inner, materialise(before, "pieces"), [key, piece], "inner")
    return met.withColumns({name: merge(F.col(name), F.col(f"{name}_above")) for name in values}).drop(piece, *above)


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node; ``turns`` (conv, pos from 1, a, b, size), ``convs`` all conversations."""
    salted = turns.select(
        "conv", "pos", F.xxhash64(F.lit(1), "pos", "a", "b").alias("x1"), F.xxhash64(F.lit(2), "pos", "b", "a").alias("x2"), "size"
    )
    cut = salted.groupBy("conv", F.floor((F.col("pos") - 1) / BLOCK).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "x1", "x2", "size"))).alias("turns"),
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
    )
    blocks = materialise(running(materialise(cut, "cut"), "conv", "block", {"u1": "x1", "u2": "x2"}, F.bit_xor, Column.bitwiseXOR), "blocks")
    ends = blocks.groupBy("conv").agg(
        F.max(F.get("turns", F.size("turns") - 1)["pos"]).alias("depth"), F.bit_xor("x1").alias("p1"), F.bit_xor("x2").alias("p2")
    )
    ends = materialise(convs.join(ends, "conv", "left").select(
        "conv", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in NODE]
    ), "ends")

    # Blocks without a sibling, and the rest.
    edges = materialise(blocks.groupBy(*_EDGE).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.first("turns").alias("turns")
    ), "edges")
    after = edges.groupBy("block", "u1", "u2").agg(
        F.count(F.lit(1)).alias("siblings"), *[F.first(c).alias(c) for c in ("x1", "x2", "n", "conv", "turns")]
    )
    lone = materialise(after.filter("siblings = 1").drop("siblings"), "lone")
    crowded = materialise(edges.join(lone.select(*_EDGE), _EDGE, "left_anti"), "crowded")

    carried = ["n", "conv", "size", "q1", "q2"]
    alone = _boundaries(lone, ["n", "conv"]).select(*NODE, *carried)
    refined = _boundaries(crowded, ["n", "conv"]).groupBy(*NODE).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), *[F.first(c).alias(c) for c in ("size", "q1", "q2")]
    )
    nothing = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).filter("n > 0").select(
        *[nothing.alias(c) for c in NODE], "n", "conv", *[nothing.alias(c) for c in ("size", "q1", "q2")]
    )
    nodes = materialise(alone.unionByName(refined.select(*NODE, *carried)).unionByName(root), "nodes")

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = materialise(
        nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", nothing))
        .withColumn("weight", (F.col("n") - 1) * F.col("size")), "with-children",
    )

    # What every conversation's own chain adds to the subtrees it lies in.
    chains = materialise(nodes.groupBy("conv").agg(
        F.sum("weight").alias("weight"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves")
    ).filter("weight <> 0 OR leaves <> 0"), "chains")
    sums = ["weight", "leaves"]
    laden = balanced_join(blocks.select("conv", *_EDGE), chains, "conv", "inner").groupBy(*_EDGE).agg(*[F.sum(c).alias(c) for c in sums])
    laden = materialise(laden, "laden")
    of_alone = _boundaries(lone.join(laden, _EDGE), sums).select(*NODE, *sums)
    of_refined = _boundaries(crowded.join(laden, _EDGE), sums).groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in sums])
    of_root = chains.agg(*[F.sum(c).alias(c) for c in sums]).select(*[nothing.alias(c) for c in NODE], *sums)
    totals = of_alone.unionByName(of_refined).unionByName(of_root).withColumnRenamed("weight", "total")

    above = running(nodes, "conv", "depth", {"above": "weight"}, F.sum, Column.__add__)
    done = above.join(totals, NODE).withColumn("saved_tokens", F.col("total") - F.col("above"))
    done = done.join(_end_hashes(ends), NODE, "left")
    # The children of the root know their parent: its conversation is the smallest of all.
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent")
    )
    below = balanced_join(done.filter("depth > 1"), parents.filter("depth > 1"), ["depth", "q1", "q2"], "inner")
    top = nodes.filter("depth = 0").select(F.col("conv").alias("parent"))
    near = done.filter("depth <= 1").join(F.broadcast(top), F.col("depth") == 1, "left")
    return below.unionByName(near).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _boundaries(edges: DataFrame, carried: list[str]) -> DataFrame:
    """A row per turn of every block: its node, the node above, the turn's size and the carried columns."""

    def up_to(i: Column, lane: str) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), i), F.col(f"u{lane}"), lambda x, turn: x.bitwiseXOR(turn[f"x{lane}"]))

    def boundary(turn: Column, i: Column) -> Column:
        return F.struct(
            turn["pos"].alias("depth"), turn["size"].alias("size"),
            *[up_to(i + 1, lane).alias(f"p{lane}") for lane in "12"], *[up_to(i, lane).alias(f"q{lane}") for lane in "12"],
        )

    return edges.select(*carried, F.explode(F.transform("turns", boundary)).alias("node")).select(*carried, "node.*")


_IDS_PER_PIECE = 4096


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): of the conversations that end at each node, in ascending order, comma-joined."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held: list[str] = []
            last = None
            for depth, p1, p2, conv in zip(*[batch.column(c).to_pylist() for c in (*NODE, "conv")], strict=True):
                if (depth, p1, p2) != last or len(held) == _IDS_PER_PIECE:
                    held = []
                    last = (depth, p1, p2)
                    out.append((*last, conv, held))
                held.append(str(conv))
            columns = list(zip(*[(*row[:4], ",".join(row[4])) for row in out], strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())], names=[*NODE, "first", "ids"]
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for depth, p1, p2, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")], strict=True):
                if (depth, p1, p2) == last:
                    state.update(b",")
                else:
                    if last is not None:
                        out.append((*last, state.hexdigest()))
                    last, state = (depth, p1, p2), hashlib.sha256()
                state.update(ids.encode())
            yield _hash_rows(out)
        if last is not None:
            yield _hash_rows([(*last, state.hexdigest())])

    ordered = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    parts = ordered.mapInArrow(listed, "depth long, p1 long, p2 long, first long, ids string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        hashed, "depth long, p1 long, p2 long, ends_sha256 string"
    )


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"]
    )


# The query in SQL for a table conversations(conv_id, turn, role, text) with distinct turn numbers.
ORACLE_SQL = rf"""
WITH numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    sha256(coalesce(role, '') || chr(1) || coalesce(text, '')) AS t, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc32_sql("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM numbered)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, n.pos, n.t, n.size FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 100 AND n.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, n.pos, n.t, n.size FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos > c.h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, t, size FROM rebuilt
), paths AS (
  SELECT conv_id, depth, size, sha256(string_agg(t, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS path FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), lengths AS (
  SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id
), nodes AS (
  SELECT p.depth, p.path, min(p.conv_id) AS conv_id, count(*) AS n, any_value(p.size) AS size,
    string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (p.depth = l.depth) AS ends
  FROM paths p JOIN lengths l ON p.conv_id = l.conv_id GROUP BY p.depth, p.path
), above AS (
  SELECT x.depth, x.path, y.path AS parent, z.conv_id AS parent_conv_id
  FROM nodes x JOIN paths y ON y.conv_id = x.conv_id AND y.depth = x.depth - 1 JOIN nodes z ON z.depth = y.depth AND z.path = y.path
), children AS (
  SELECT depth - 1 AS depth, parent AS path, count(*) AS n FROM above GROUP BY depth, parent
), weighed AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, (n.n - 1) * n.size AS weight FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
), subtrees AS (
  SELECT p.depth, p.path, count(*) FILTER (w.n_children = 0) AS n_leaves, sum(w.weight) AS saved
  FROM paths p JOIN weighed w ON w.conv_id = p.conv_id AND w.depth >= p.depth GROUP BY p.depth, p.path
)
SELECT w.conv_id, w.depth::BIGINT AS depth, a.parent_conv_id, w.n::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM weighed w JOIN subtrees s ON s.depth = w.depth AND s.path = w.path LEFT JOIN above a ON a.depth = w.depth AND a.path = w.path
"""

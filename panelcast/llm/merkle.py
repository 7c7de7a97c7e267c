"""Merkle dataset manifest: a hash tree per partition of a table, one over the partitions, and a proof for every row.

The proofs come from pointer jumping: every node starts with its sibling and a pointer to its parent, and
self-joins append the segment of the node pointed at, doubling the distance, until every leaf reaches its root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.llm.common import col, stored

#: Levels that one grouped pass builds; a group holds 2 ** PASS nodes at most.
PASS = 8
#: Sides up to this many bytes are broadcast, others shuffle.
BROADCAST_BYTES = 16 << 20
#: Bytes of a digest and of a row around it, for that check.
DIGEST, ROW = 32, 64
NODES = "tree long, size long, level int, pos long, digest binary, sibling binary"


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_hash(fields: Iterable[Column]) -> Column:
    """Lowercase hex sha256 of the fields' texts, one after the other."""
    return F.sha2(F.concat(*[field_text(f) for f in fields]).cast("binary"), 256)


def levels_above(size: Column) -> Column:
    """How many levels of pairs lead from ``size`` leaves to one node."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0).cast("int")


def positions(rows: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, without gaps) and ``size`` of their ``tree``, in the order given (nulls first).

    Rows are range-partitioned on tree and order, so a tree with any share of the rows lies on many tasks; within a task
    they are numbered, and the numbers of the tasks before are added from one count per task and tree.
    """
    keys = [F.col(tree).asc_nulls_first(), *order]
    partitions = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = rows.repartitionByRange(int(partitions), *keys).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "ranged")
    counts = dealt.groupBy(tree, "part").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        F.col(tree).alias("_tree"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("first"),
        F.sum("n").over(Window.partitionBy(tree)).alias("size"),
    )
    nth = F.row_number().over(Window.partitionBy("part", tree).orderBy(*order))
    out = dealt.withColumn("nth", nth).join(firsts, F.col("part").eqNullSafe(F.col("_part")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return out.withColumn("pos", F.col("first") + F.col("nth") - 1).drop("first", "nth", "part", "_tree", "_part")


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def _grow(group: pd.DataFrame) -> pd.DataFrame:
    """The nodes above one run of 2 ** PASS nodes of a level, and the siblings of those below its last level."""
    group = group.sort_values("pos")
    tree, size, level, pos = (group[c].iloc[0] for c in ("tree", "size", "level", "pos"))
    nodes, out = list(group["digest"]), []
    tree, size, level, pos = int(tree), int(size), int(level), int(pos)
    top = max(size - 1, 0).bit_length()  # level of the tree's root
    for _ in range(PASS):
        if level == top:
            break
        above = []
        for i in range(0, len(nodes), 2):
            pair = nodes[i : i + 2]
            out.append((tree, size, level, pos + i, pair[0], pair[1] if len(pair) > 1 else b""))
            if len(pair) > 1:
                out.append((tree, size, level, pos + i + 1, pair[1], pair[0]))
            above.append(_digest(*pair))
        nodes, level, pos = above, level + 1, pos // 2
    # the last level reached has its siblings in other groups: the next pass adds them; a root has none
    out.append((tree, size, level, pos, nodes[0], None))
    return pd.DataFrame(out, columns=["tree", "size", "level", "pos", "digest", "sibling"])


def build(leaves: DataFrame) -> DataFrame:
    """All nodes (NODES) above ``leaves`` (tree, size, pos, digest): sibling is empty where a node is alone in its run
    and null at the root."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    top = max(most - 1, 0).bit_length()
    current = leaves.select("tree", "size", F.lit(0).alias("level"), "pos", "digest")
    done = None
    for base in range(0, max(top, 1), PASS):
        run = F.shiftright("pos", PASS)
        grown = current.groupBy("tree", run.alias("run")).applyInPandas(_grow, NODES)
        grown = stored(grown, "nodes")
        last = F.col("sibling").isNull()
        above = levels_above(F.col("size"))
        ready = grown.where(~last | (F.col("level") == above))
        done = ready if done is None else done.unionByName(ready)
        current = grown.where(last & (F.col("level") < above)).select("tree", "size", "level", "pos", "digest")
    return done


def jump(nodes: DataFrame) -> DataFrame:
    """(tree, pos, digest, size, segment) of every leaf: its siblings (empty: none) from the leaf to its tree's root.

    In round r, nodes of levels that 2 ** r divides hold the siblings of the next 2 ** r levels, or of all that there are,
    and point at the ancestor there; those of levels that 2 ** (r + 1) divides append their ancestor's segment. The others
    have been used and are dropped, so a round moves the leaves once and ever fewer ancestors.
    """
    above = levels_above(F.col("size"))
    segment = F.when(F.col("sibling").isNull(), F.array().cast("array<binary>")).otherwise(F.array("sibling"))
    current = nodes.select("tree", "size", "level", "pos", "digest", segment.alias("segment"), above.alias("top"))
    most = nodes.agg(F.max("level")).first()[0] or 0
    step = 1
    while step < most:
        down = current.where(F.col("level") % (2 * step) == 0)
        going = down.where(F.col("level") + step < F.col("top"))
        resting = down.where(F.col("level") + step >= F.col("top"))
        met = current.where((F.col("level") % (2 * step) == step) & (F.col("level") < F.col("top"))).select(
            "tree", (F.col("level") - step).alias("level"), F.col("pos").alias("ancestor"), F.col("segment").alias("upper")
        )
        if met.count() * (step * DIGEST + ROW) <= BROADCAST_BYTES:
            met = F.broadcast(met)
        going = going.withColumn("ancestor", F.shiftright("pos", step)).join(met, ["tree", "level", "ancestor"])
        going = going.withColumn("segment", F.concat("segment", "upper")).drop("ancestor", "upper")
        current = stored(going.select(*current.columns).unionByName(resting), "segments")
        step *= 2
    return current.where("level = 0").select("tree", "size", "pos", "digest", "segment")


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def siblings_hash(segment: Column) -> Column:
    """Sha256 of the siblings' hex texts, in order; of the empty text if there are none."""
    return F.sha2(F.array_join(F.transform(segment, _text), "").cast("binary"), 256)


def fold_up(leaf: Column, pos: Column, segment: Column) -> Column:
    """The root (hex) that ``leaf`` (hex) at ``pos`` and its siblings give."""
    path = F.transform(segment, lambda s, i: F.struct(s.alias("s"), (F.call_function("shiftright", pos, i) % 2).alias("right")))

    def step(node: Column, at: Column) -> Column:
        other = _text(at["s"])
        return F.sha2(F.when(at["right"] == 1, F.concat(other, node)).otherwise(F.concat(node, other)).cast("binary"), 256)

    return F.aggregate(path, leaf, step)


def manifest(
    docs: DataFrame, fields: list[str], tree_col: str, order_col: str, changed: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row of ``docs``: the order column, tree value, leaf, subroot, root, proof_sha256, folded_root, verified.

    Each row is a leaf: the hash of its ``fields`` (see ``row_hash``). The rows of each value of ``tree_col`` ascend
    by ``order_col`` (nulls first; of equal values, by leaf; rows equal in that too are interchangeable). While there are
    several nodes, every two neighbours become the hash of their hex texts, a last one alone the hash of its own. The last node is the
    subroot, and the subroots by tree value (null first, by bytes) lead to the root likewise. ``changed`` gives fields other
    values, from which folded_root is computed with the original siblings: verified tells whether it is still the root.
    Null fields count as ``-``; empty and very long texts are hashed whole; repeated rows are leaves of their own. An empty
    table gives an empty result; other columns are not read.

    Texts are read once, for their hashes; all else moves digests. No task holds more than 2 ** PASS nodes of a tree.
    """
    names = {f"f{i}": col(f) for i, f in enumerate(fields)}
    changed = changed or {}
    after = [changed.get(f, col(f)) for f in fields]
    differs = F.lit(False)
    for f in changed:
        differs = differs | ~changed[f].eqNullSafe(col(f))
    leaf = row_hash(names.values())
    rows = docs.select(
        col(order_col).alias("key"),
        col(tree_col).cast("string").alias("lang"),
        F.monotonically_increasing_id().alias("row"),
        leaf.alias("leaf"),
        F.when(differs, row_hash(after)).alias("other"),
    )
    rows = stored(rows, "leaves")
    order = [F.col("key").asc_nulls_first(), F.col("leaf").asc(), F.col("row").asc()]
    placed = positions(rows, "lang", order)
    # trees are numbered in the order of their values; the tree over them has number -1
    trees = rows.select("lang").distinct().withColumn("tree", F.lit(-1).cast("long"))
    trees = positions(trees, "tree", [F.col("lang").asc_nulls_first()])
    trees = stored(trees.select(F.col("lang").alias("of"), F.col("pos").alias("tree")), "trees")
    n_trees, of_bytes = trees.agg(F.count("*"), F.sum(F.coalesce(F.octet_length("of"), F.lit(0)) + ROW)).first()
    if (of_bytes or 0) <= BROADCAST_BYTES:
        trees = F.broadcast(trees)
    placed = placed.join(trees, F.col("lang").eqNullSafe(F.col("of"))).drop("of")
    placed = stored(placed.withColumn("digest", F.unhex("leaf")), "placed")

    # the trees first, then the one over their roots
    nodes = build(placed.select("tree", "size", "pos", "digest"))
    subroots = nodes.where(F.col("level") == levels_above(F.col("size"))).select("tree", "digest")
    tops = subroots.select(F.lit(-1).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("size"), F.col("tree").alias("pos"), "digest")
    over = build(tops)
    paths = stored(jump(nodes).select("tree", "pos", "segment"), "paths")
    upper = jump(over).select(F.col("pos").alias("tree"), F.col("digest").alias("subroot"), F.col("segment").alias("upper"))
    root = over.where(F.col("level") == levels_above(F.col("size"))).select(_text(F.col("digest"))).first()
    root = F.lit(root[0] if root else None)

    upper = stored(upper, "upper")
    if n_trees * (n_trees.bit_length() * DIGEST + ROW) <= BROADCAST_BYTES:
        upper = F.broadcast(upper)
    proofs = placed.select("key", "lang", "tree", "pos", "leaf", "other").join(paths, ["tree", "pos"]).join(upper, "tree")
    subroot = fold_up(F.coalesce("other", "leaf"), F.col("pos"), F.col("segment"))
    proofs = proofs.withColumn("folded", subroot)
    folded = fold_up(F.col("folded"), F.col("tree"), F.col("upper"))
    return proofs.select(
        F.col("key").alias(order_col),
        F.col("lang").alias(tree_col),
        "leaf",
        _text(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        siblings_hash(F.concat("segment", "upper")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

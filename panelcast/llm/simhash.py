"""SimHash near-deduplication: shards of fingerprints searched by distance to vantage points."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, col, fresh, join_groups, stored, without

WIDTH = 64
#: Shingles whose bits are summed at once; bounds the memory of a very long text.
BLOCK = 1 << 15


def simhash(raw: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """Fingerprint of a UTF-8 text: a bit is set if over half of the shingles' XXH64 have it.

    A-Z are lower-cased; words are runs of characters other than space and x09-x0D; shingles are
    ``shingle`` words joined by spaces, repeats included. Fewer words make one shingle, none (or null) give 0.
    """
    words = (raw or b"").lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], seed) for a, b in zip(starts, stops)], dtype=np.uint64)
    counts = np.zeros(WIDTH, dtype=np.int64)
    for at in range(0, n, BLOCK):
        part = hashes[at : at + BLOCK]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    @F.pandas_udf("long")
    def fingerprint(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for raw in parts:
            codes = np.fromiter((simhash(b, shingle) for b in raw), dtype=np.uint64, count=len(raw))
            yield pd.Series(codes.view(np.int64))

    return fingerprint


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def projections(rows: int, radius: int, width: int = WIDTH, crowd: int = 256) -> list[int]:
    """Bit masks such that any two fingerprints within ``radius`` agree on all bits of one of them.

    The bits are cut into b blocks; two fingerprints differ in at most ``radius`` of them, so they agree on
    some b - radius blocks. b is the least for which ``rows`` spread evenly leave at most ``crowd`` to a value.
    """
    for blocks in range(radius + 1, width + 1):
        same = blocks - radius
        cuts = [round(i * width / blocks) for i in range(blocks + 1)]
        parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
        masks = [sum(parts[i] for i in pick) for pick in combinations(range(blocks), same)]
        if rows <= crowd << (width * same // blocks) or len(masks) > 100:
            return masks
    return masks


def near_links(points: np.ndarray, radius: int, leaf: int = 48) -> np.ndarray:
    """Links (pairs of points) that connect all distinct ``points`` lying within ``radius`` of one another;
    a spanning set, not every pair.

    A vantage point takes in all points within ``radius`` of it; each point taken in searches those still
    apart in turn. The search of a point keeps to those whose distance to the first vantage point
    differs from its own by at most ``radius``: the triangle bound rules out all others. Points
    are held in order of that distance, so the bound is a slice.
    """
    links = []
    order = distance(points, points[0])
    rank = np.argsort(order, kind="stable")
    points, order = points[rank], order[rank].astype(np.int64)
    apart = np.ones(len(points), dtype=bool)
    if len(points) > leaf:
        low, high = np.searchsorted(order, order - radius), np.searchsorted(order, order + radius, side="right")
    else:
        low, high = np.zeros(len(points), dtype=np.int64), np.full(len(points), len(points))
    for first in range(len(points)):
        if not apart[first]:
            continue
        apart[first] = False
        queue = [first]
        while queue:
            i = queue.pop()
            a, b = low[i], high[i]
            found = a + np.flatnonzero(apart[a:b] & (distance(points[a:b], points[i]) <= radius))
            if len(found):
                apart[found] = False
                queue.extend(found.tolist())
                links.append(np.column_stack([np.full(len(found), points[i]), points[found]]))
    return np.concatenate(links) if links else np.zeros((0, 2), dtype=points.dtype)


def _search(masks: list[int], radius: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def search(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["tree", "key", "cell"], kind="stable")
        points = shard["fp"].to_numpy().view(np.uint64)
        tree, key, cell = (shard[c].to_numpy() for c in ("tree", "key", "cell"))
        new = np.flatnonzero((tree[1:] != tree[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
        starts, stops = np.concatenate(([0], new)), np.concatenate((new, [len(points)]))
        sizes, out = stops - starts, []
        # values with few fingerprints: neighbours at each offset, for all values at once
        few = np.repeat(sizes <= 64, sizes)
        last = np.repeat(stops, sizes)
        at = np.flatnonzero(few)
        for step in range(1, int(sizes[sizes <= 64].max(initial=0))):
            at = at[at + step < last[at]]
            hit = at[distance(points[at], points[at + step]) <= radius]
            out.append(np.column_stack([points[hit], points[hit + step]]))
        for a, b in zip(starts[sizes > 64], stops[sizes > 64]):
            out.append(near_links(points[a:b], radius))
        pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), dtype=np.uint64)
        pairs = pairs.astype(np.uint64).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return search


def fingerprint_links(points: DataFrame, rows: int, radius: int = 4, task_rows: int = 200_000, hot: int = 100_000) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``, ``rows`` in number) that connect exactly
    those within ``radius`` bits of one another, directly or through others.

    Every fingerprint goes to one shard for each projection on which linked pairs must agree; there a ball of
    radius 0 never crosses a boundary, while on all 64 bits two thirds of the balls of radius 4 cross each
    median. Within a shard ``near_links`` prunes by the triangle bound. A value of a projection with
    over ``hot`` fingerprints is cut into pieces, and each pair of pieces is searched as a shard of its own.
    """
    masks = projections(rows, radius)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    trees = F.explode(
        F.array(*[F.struct(F.lit(i).alias("tree"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    ).alias("t")
    keyed = points.select("fp", trees).select("fp", "t.tree", "t.key")
    crowded = stored(
        keyed.groupBy("tree", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot)
        .withColumn("pieces", F.ceil(F.col("n") / (hot / 2)).cast("int")).drop("n"),
        "crowded",
    )
    # fewer than rows x projections / hot values can be that crowded
    keyed = keyed.join(F.broadcast(crowded), ["tree", "key"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp", F.lit("piece")), F.col("pieces")).cast("int")
    keyed = keyed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    # pieces (i, i) are searched with every other piece, so alone only if there is no other
    keyed = keyed.where("pieces = 1 or mine <> other")
    cell = F.least("mine", "other") * F.col("pieces") + F.greatest("mine", "other")
    shards = max(1, -(-rows * len(masks) // task_rows))
    shard = F.pmod(F.xxhash64("tree", "key", "cell"), F.lit(shards))
    keyed = keyed.select("fp", "tree", "key", cell.cast("long").alias("cell")).withColumn("shard", shard)
    return keyed.groupBy("shard").applyInPandas(_search(masks, radius), "a long, b long").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node of its component.

    Large-star and small-star steps in turn until nothing changes, some log n rounds; each round is a
    table in the shared folder. Nodes with a great share of the links are joined by broadcast.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    for _ in range(most_rounds):
        if not before[0]:
            break
        # large star: every larger neighbour links to the smallest one known
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"), F.count("*").alias("n"))
        large = join_groups(both, least, "u", "n", 2 * before[0]).where("v > u")
        large = stored(large.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct(), "large")
        # small star: smaller neighbours and the node itself link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n"))
        small = join_groups(large, least, "u", "n", before[0]).select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(least.select("u", F.col("low").alias("v"))).where("u <> v").distinct()
        edges = stored(small, "small")
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def with_components(rows: DataFrame, points: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` (id, fp) with ``component``: the smallest id of all rows whose fp is linked to theirs, their own included.

    ``points`` has each distinct fp with its smallest id (least) and number of rows (n); ``links`` are pairs (a, b) of fp.
    """
    n, total = points.count(), rows.count()
    of = stored(components(links), "components")
    members = points.join(of, points["fp"] == of["node"]).select("fp", "root", "least")
    heads = members.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("members"))
    met = stored(join_groups(members, heads, "root", "members", max(n, 1)).select(F.col("fp").alias("met"), "component"), "met")
    points = points.join(met, points["fp"] == met["met"], "left").select(
        "fp", "n", F.when(F.col("met").isNotNull(), F.col("component")).otherwise(F.col("least")).alias("component")
    )
    return join_groups(rows, stored(points, "ids"), "fp", "n", max(total, 1))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    Fingerprints (see ``simhash``) link at ``radius`` or fewer differing bits; component_id is the smallest
    id reachable by links, the row's own included. Null and blank texts have fingerprint 0 and link like any
    other. A null id counts for nothing; a component of null ids has a null component_id. Repeated rows
    stay repeated. An empty table gives an empty result; other columns are not read.

    Texts are read once, for their fingerprints. All later steps move fixed-width rows: each distinct
    fingerprint once, so copies cost nothing but their row.
    """
    raw = col(text_col).cast("binary")
    rows = stored(bounded_batches(docs).select(col(id_col).alias("id"), _fingerprints(shingle)(raw).alias("fp")), "simhash")
    points = stored(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "points")
    out = with_components(rows, points, fingerprint_links(points.select("fp"), points.count(), radius))
    return out.select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one with the smallest id.

    Rows that share an id count as one document, of which one row stays. Rows with a null id have no
    identity to be dropped by: they stay.
    """
    found = near_duplicates(docs.select(col(id_col), col(text_col)), id_col, text_col, shingle, radius)
    return keep_least(docs, found.select(col(id_col).alias("id"), "component_id"), id_col)


def keep_least(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with one row of each component in ``found`` (id, component_id): the one whose id names it; null ids stay."""
    found = stored(found.where("id is not null"), "found")
    out = without(docs, found.where("id <> component_id").select("id"), id_col)
    again = stored(found.where("id = component_id").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "again")
    if again.isEmpty():
        return out
    key = fresh(out, "again")
    twice = out.join(again.withColumnRenamed("id", key), col(id_col) == F.col(key), "left_semi").dropDuplicates([id_col])
    return without(out, again, id_col).unionByName(twice)

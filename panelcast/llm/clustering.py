"""Centroid clustering (Lloyd rounds) with distance bounds that are loosened by geometry rather than by full drift."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import col, stored
from panelcast.llm.topk import usable

#: Scaled components end at this size: squared distances of 64 of them stay below 2^60.
LIMIT = 1 << 26
#: Bounds are moved by this share of their size, far above the rounding of their arithmetic.
SLACK = 1e-9
#: Rows whose distances to all centroids are held at once.
BLOCK = 4096


def whole(v: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; beyond LIMIT it ends there."""
    bounded = lambda x: F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))
    return F.transform(v, lambda x: F.floor(bounded(x)))


def loosening(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """(i, j): by how much the distance to centroid j can have shrunk at most, for any point of the sphere of
    ``radius[i]`` around ``before[i]``, when j moved from ``before[j]`` to ``after[j]``; never above j's drift.

    Only the plane through the centre and the line of the move matters. With the middle of the move as origin, x
    along it and h away from it, the shrinkage D of a point grows with x and, for x > 0, falls with h; its level sets are
    hyperbolas with foci at the ends of the move. Two bounds over the disc of the sphere are combined:
    the corner (largest x, least h) of its bounding box, and drift * cos(angle) at its tangent from the
    origin nearest to the axis, since a hyperbola lies within its asymptotes. A disc with x <= 0 loses nothing.
    """
    before, after = before.astype(float), after.astype(float)
    move = after - before
    drift = np.sqrt((move**2).sum(axis=1))
    half = drift / 2
    axis = np.divide(move, drift[:, None], out=np.zeros_like(move), where=drift[:, None] > 0)
    offset = before[:, None, :] - ((before + after) / 2)[None, :, :]  # (i, j, component)
    x = np.einsum("ijc,jc->ij", offset, axis)
    away = np.sqrt((offset**2).sum(axis=2))
    h = np.sqrt(np.maximum(away**2 - x**2, 0.0))
    r = radius[:, None] * (1 + SLACK)
    right, near = x + r, np.maximum(h - r, 0.0)
    corner = np.hypot(right + half, near) - np.hypot(right - half, near)
    corner = np.where(right > 0, corner, 0.0)
    outside = away > r
    angle = np.arctan2(h, x) - np.arcsin(np.where(outside, r / np.where(outside, away, 1.0), 1.0))
    cone = np.where(outside, drift * np.cos(np.clip(angle, 0.0, np.pi)), drift)
    tight = np.minimum(np.minimum(corner, np.maximum(cone, 0.0)) + SLACK * (drift + away + r), drift * (1 + SLACK))
    return np.where(drift > 0, tight, 0.0)


def _squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, centroids). Below 2^22 a product of 64 components is exact in doubles, which are faster."""
    small = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < 1 << 22 and x.shape[1] <= 64
    a, b = (x.astype(float), centroids.astype(float)) if small else (x, centroids)
    out = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    return out.astype(np.int64)


def assign(
    x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray | None, upper: np.ndarray, lower: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper, lower, scanned): the nearest centroid of each row, the smaller number of equals, with bounds on the distance
    to it and to any other. A row keeps its cluster if its upper bound, or its exact distance, is below its lower
    bound; all others are ambiguous, and measured against every centroid."""
    if cluster is None:
        cluster, upper, lower = np.zeros(len(x), dtype=np.int32), np.full(len(x), np.inf), np.zeros(len(x))
    else:
        cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    doubt = np.flatnonzero(upper >= lower)
    if len(doubt):
        gap = x[doubt] - centroids[cluster[doubt]]
        upper[doubt] = np.sqrt((gap * gap).sum(axis=1).astype(float)) * (1 + SLACK)
        doubt = doubt[upper[doubt] >= lower[doubt]]
    for at in range(0, len(doubt), BLOCK):
        rows = doubt[at : at + BLOCK]
        squared = _squared(x[rows], centroids)
        best = squared.argmin(axis=1)  # the first of equals
        every = np.arange(len(rows))
        upper[rows] = np.sqrt(squared[every, best].astype(float)) * (1 + SLACK)
        cluster[rows] = best
        squared[every, best] = np.iinfo(np.int64).max
        second = squared.min(axis=1)
        lower[rows] = np.where(second == np.iinfo(np.int64).max, np.inf, np.sqrt(second.astype(float)) * (1 - SLACK))
    return cluster, upper, lower, np.isin(np.arange(len(x)), doubt)


def _assigned(state: DataFrame, centroids: np.ndarray, drift: np.ndarray, loose: np.ndarray, first: bool) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            x = np.stack(part["v"].to_numpy())
            before = None if first else part["cluster"].to_numpy()
            upper, lower = part["upper"].to_numpy(), part["lower"].to_numpy()
            if not first:
                upper, lower = upper + drift[before], lower - loose[before]
            cluster, upper, lower, scanned = assign(x, centroids, before, upper, lower)
            yield part.assign(cluster=cluster, upper=upper, lower=lower, scanned=scanned)

    return state.mapInPandas(run, state.schema)


def centroid_text(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    seed: str = "2",
) -> DataFrame:
    """One row per usable vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, scanned.

    Vectors with exactly ``dims`` components, none null, NaN or infinite, are kept; component x becomes floor(scale * x), which ends
    at LIMIT. Centroids start as the ``k`` vectors with the smallest sha256 of ``seed:id`` (fewer vectors: all; a null id
    comes last; of repeated ids, the smaller vector), in that order. Each round assigns every vector to its nearest centroid (the smaller number of equals) and moves
    each centroid that has vectors to the floor of their mean; the others stay. A last assignment follows. Null
    ids stay, repeated rows count each. An empty table gives an empty result; other columns are not read. scanned is the number of vectors
    that the last assignment measured against all centroids.

    Each assignment is one pass over a stored table that carries, per vector, an upper bound on the distance to its
    centroid and a lower one on that to all others. Sums, counts and radii of the clusters are one aggregate with map-side
    combination; the driver holds k x dims centroids and the k x k table of ``loosening``.
    """
    v = col(vector_col)
    rows = vectors.select(col(id_col).alias("id"), F.when(usable(v) & (F.size(v) == dims), whole(v, scale)).alias("v"))
    nothing = [F.lit(0).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"), F.lit(False).alias("scanned")]
    state = stored(rows.where("v is not null").select("*", *nothing), "kept")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    starts = state.select("v", name.alias("name")).orderBy(F.asc_nulls_last("name"), "v").limit(k).collect()
    centroids = np.array([r["v"] for r in starts], dtype=np.int64).reshape(len(starts), dims)
    k = len(centroids)
    drift, loose = np.zeros(k), np.zeros(k)
    for done in range(rounds + 1 if k else 0):
        state = stored(_assigned(state, centroids, drift, loose, first=done == 0), "clusters")
        if done == rounds:
            break
        sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)]
        found = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("upper").alias("radius"), *sums).collect()
        moved, radius = centroids.copy(), np.zeros(k)
        for r in found:
            moved[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
            radius[r["cluster"]] = r["radius"]
        drift = np.sqrt(((moved - centroids).astype(float) ** 2).sum(axis=1)) * (1 + SLACK)
        table = loosening(centroids, moved, radius)
        np.fill_diagonal(table, 0.0)
        loose, centroids = table.max(axis=1), moved

    fixed = state.sparkSession.createDataFrame(
        [(i, [int(a) for a in c], centroid_text(c)) for i, c in enumerate(centroids)],
        "cluster int, centre array<bigint>, centroid_sha256 string",
    )
    gap = F.aggregate(
        F.zip_with("v", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda total, s: total + s
    )
    found = state.join(F.broadcast(fixed), "cluster").select("id", "cluster", gap.alias("distance"), "centroid_sha256", "scanned")
    totals = found.groupBy("cluster").agg(
        F.sum("distance").alias("cluster_inertia"), F.count_if("scanned").alias("scanned")
    ).collect()
    inertia, scanned = sum(r["cluster_inertia"] for r in totals), sum(r["scanned"] for r in totals)
    sums = state.sparkSession.createDataFrame(
        [(r["cluster"], r["cluster_inertia"]) for r in totals], "cluster int, cluster_inertia bigint"
    )
    return found.drop("scanned").join(F.broadcast(sums), "cluster").select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(inertia).cast("long").alias("inertia"),
        "centroid_sha256",
        F.lit(scanned).cast("long").alias("scanned"),
    )

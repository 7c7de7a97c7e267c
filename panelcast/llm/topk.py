"""Exact top-k search by inner product: vectors in buckets of similar length, pruned by local cosine thresholds."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelcast.llm.common import col, stored

#: The lengths of a bucket lie within this ratio of one another.
RATIO = 0.95
#: Bounds are widened by this share, far above the rounding of their arithmetic.
SLACK = 1e-9
#: Scaled components end at this size, so that lengths are finite and number some 900 ranges.
LIMIT = float(1 << 60)
#: Tables of dimensions and length ranges up to this many rows are broadcast; longer ones shuffle.
SMALL_ROWS = 100_000
#: Number of the last range, of vectors without length.
NO_LENGTH = 1 << 20
#: Buckets that one task joins with a block of queries.
SHELF = 256
HITS = T.StructType(
    [
        T.StructField("q_row", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("query_null", T.BooleanType()),
        T.StructField("row", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("vec_null", T.BooleanType()),
        T.StructField("score", T.LongType()),
    ]
)
_LONG = float(1 << 63)


def usable(v: Column) -> Column:
    """True for an array without null, NaN or infinite components."""
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(fine, F.lit(False))


def scaled(v: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as doubles; beyond LIMIT it ends there."""
    return F.transform(v, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-LIMIT)), F.lit(LIMIT))).cast("double"))


def _length(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def _range(length: Column, longest: Column) -> Column:
    """Number of the length range: 0 for the longest vectors, each next one shorter by RATIO, NO_LENGTH for
    length 0; null stays null."""
    steps = F.floor(F.log(longest / length) / -math.log(RATIO))
    return F.when(length > 0, F.greatest(steps, F.lit(0))).when(length == 0, NO_LENGTH).cast("int")


def switch_point(local: np.ndarray, spans: np.ndarray, prefix: np.ndarray, gain: float = 0.5) -> float:
    """The local cosine threshold from which on a bucket is pruned by coordinates.

    ``local`` are the thresholds of some queries, ``spans`` the rows that coordinates would leave for each and
    ``prefix`` those that length leaves. The least threshold is taken from which on coordinates leave, over all
    queries above it, under ``gain`` times as many rows; infinity if there is none.
    """
    order = np.argsort(-local, kind="stable")
    better = np.cumsum(spans[order]) < gain * np.cumsum(prefix[order])
    return float(local[order][np.flatnonzero(better).max()]) if better.any() else math.inf


def feasible(unit_q: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds on each coordinate of a unit vector whose cosine with ``unit_q`` (rows) is at least ``local``."""
    t = np.clip(local, -1.0, 1.0)[:, None]
    wide = np.sqrt(np.maximum(0.0, 1.0 - unit_q**2)) * np.sqrt(1.0 - t**2)
    low, high = unit_q * t - wide, unit_q * t + wide
    # the end of the axis itself may lie inside the cap around the query
    low, high = np.where(unit_q <= -t, -1.0, low), np.where(unit_q >= t, 1.0, high)
    return low - SLACK, high + SLACK


def search_bucket(
    q: np.ndarray, q_len: np.ndarray, theta: np.ndarray, p: np.ndarray, p_len: np.ndarray, focus: int = 6, probe: int = 64
) -> list[tuple[int, np.ndarray]]:
    """For each query with candidates: (its number, rows of the bucket whose product may reach ``theta``).

    ``p`` is sorted by descending length. A query's local threshold is theta / (its length x the longest
    length): beyond 1 the bucket is skipped; from the bucket's switch point on the ``focus`` coordinates where
    the query is largest cut the candidates, below it the least length theta / |q| does.
    """
    top = p_len[0] if len(p_len) else 0.0
    reach = q_len * top
    # products are at least -|q||p|: with no or a negative threshold nothing is excluded by length
    local = np.where(reach > 0, theta / np.where(reach > 0, reach, 1.0), np.where(theta > 0, np.inf, -np.inf))
    need = np.where((theta > 0) & (q_len > 0), theta / np.where(q_len > 0, q_len, 1.0) * (1 - SLACK), -np.inf)
    prefix = np.searchsorted(-p_len, -need, side="right")
    live = np.flatnonzero((local <= 1 + SLACK) & (prefix > 0))
    if not len(live):
        return []
    positive = live[(local[live] > 0) & (q_len[live] > 0)]
    found: list[tuple[int, np.ndarray]] = []
    by_coordinate = np.zeros(len(q), dtype=bool)
    if len(positive) and p.shape[1]:
        unit_q, unit_p = q[positive] / q_len[positive, None], p / np.where(p_len > 0, p_len, 1.0)[:, None]
        low, high = feasible(unit_q, local[positive])
        axes = np.argsort(-np.abs(unit_q), axis=1, kind="stable")[:, :focus]
        ordered = np.sort(unit_p, axis=0)
        tested = np.unique(np.linspace(0, len(positive) - 1, min(probe, len(positive))).astype(int))
        spans = np.array(
            [
                min(
                    np.searchsorted(ordered[:, f], high[i, f], side="right") - np.searchsorted(ordered[:, f], low[i, f])
                    for f in axes[i]
                )
                for i in tested
            ]
        )
        switch = switch_point(local[positive[tested]], spans, prefix[positive[tested]])
        for i, at in enumerate(positive):
            if local[at] >= switch:
                by_coordinate[at] = True
                rows = np.arange(prefix[at])
                for f in axes[i]:
                    x = unit_p[rows, f]
                    rows = rows[(x >= low[i, f]) & (x <= high[i, f])]
                if len(rows):
                    found.append((int(at), rows))
    found += [(int(at), np.arange(prefix[at])) for at in live if not by_coordinate[at]]
    return found


def _search(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(queries: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(bucket):
            return pd.DataFrame({f.name: [] for f in HITS.fields})
        bucket = bucket.sort_values("length", ascending=False, kind="stable").reset_index(drop=True)
        q, p = np.stack(queries["v"].to_numpy()), np.stack(bucket["v"].to_numpy())
        theta = queries["theta"].to_numpy()
        q_row, rows = queries["q_row"].to_numpy(), bucket["row"].to_numpy()
        found = search_bucket(q, queries["length"].to_numpy(), theta, p, bucket["length"].to_numpy())
        # queries that keep most of the bucket share one product of matrices
        whole = [f for f in found if 2 * len(f[1]) > len(p)]
        verified = [(i, rest, p[rest] @ q[i]) for i, rest in found if 2 * len(rest) <= len(p)]
        best = []
        for at in range(0, max(len(whole), 1), 256):
            part = whole[at : at + 256]
            if part:
                products = q[[i for i, _ in part]] @ p.T
                verified += [(i, rest, product[rest]) for (i, rest), product in zip(part, products)]
            for i, rest, score in verified:
                keep = (score >= theta[i]) & (rows[rest] != q_row[i])
                rest, score = rest[keep], score[keep]
                if len(score) > k:
                    # the k best and all that tie with the last of them
                    keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                    rest, score = rest[keep], score[keep]
                best.append(np.column_stack([np.full(len(rest), i), rest]))
                best[-1] = best[-1][_ranked(bucket, rest, score)[:k]]
            verified = []
        picked = np.concatenate(best) if best else np.zeros((0, 2), dtype=np.int64)
        asked, got = queries.iloc[picked[:, 0]], bucket.iloc[picked[:, 1]]
        score = np.einsum("ij,ij->i", q[picked[:, 0]], p[picked[:, 1]])
        high = np.nextafter(_LONG, 0)
        return pd.DataFrame(
            {
                "q_row": asked["q_row"].to_numpy(),
                "query_id": asked["query_id"].to_numpy(),
                "query_null": asked["query_null"].to_numpy(),
                "row": got["row"].to_numpy(),
                "vec_id": got["vec_id"].to_numpy(),
                "vec_null": got["vec_null"].to_numpy(),
                "score": np.clip(score, -_LONG, high).astype(np.int64),
            }
        )

    return search


def _ranked(bucket: pd.DataFrame, rest: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Order by score, then id (none last), then row."""
    part = bucket.iloc[rest]
    return np.lexsort((part["row"], part["vec_id"], part["vec_null"], -score))


def _attached(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of a stored table of one row per key; broadcast if it is small."""
    return rows.join(F.broadcast(table) if table.count() <= SMALL_ROWS else table, on)


def _pieces(most: int) -> Column:
    """In how many pieces of about ``most`` rows a group is cut."""
    return F.ceil(F.count("*") / most).cast("int").alias("pieces")


def _block(by: list[str], nth: Column) -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in by], nth.cast("string"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    bucket_rows: int = 1024,
    block_rows: int = 2048,
) -> DataFrame:
    """The ``k`` highest inner products of each query row with every other row: query_id, rank, vec_id, score.

    Components x become floor(scale * x). Queries are the rows where ``is_query`` (over the columns of
    ``vectors``) is true. Ties go to the smaller id (null ids last), then to either of the rows that share it. Vectors that are
    null, or hold null, NaN or infinite components, take no part; vectors of different dimensions have no product, so
    a query meets those of its own. A row is not its own candidate, but repeated rows are one another's,
    and a repeated query is answered as often as it occurs. An empty table gives an empty result; other
    columns are not read. Products are exact below 2^53 in size, rounded to 53 bits beyond, and end at the long range;
    scaled components end at LIMIT.

    Vectors are grouped by length, in ranges of RATIO cut into buckets of about ``bucket_rows``: one length may have any share of the
    rows. Each query first meets one bucket of the longest range; its k-th best product there is a threshold that
    only better products pass. It then meets the buckets whose longest vector can reach the threshold, as
    one of a block of queries with similar needs; the others are never read. Within a bucket, see
    ``search_bucket``. What is left is verified by its product, and each bucket returns k rows a query at most.
    """
    v = col(vector_col)
    vec_id = col(id_col).cast("long")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(vec_id, F.lit(0)).alias("vec_id"),
        vec_id.isNull().alias("vec_null"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.when(usable(v), scaled(v, scale)).alias("v"),
    ).where("v is not null")
    rows = stored(rows.withColumn("dim", F.size("v")).withColumn("length", _length(F.col("v"))), "vectors")
    longest = stored(rows.groupBy("dim").agg(F.max("length").alias("longest")), "longest")
    ranged = _attached(rows, longest, ["dim"]).withColumn("range", _range(F.col("length"), F.col("longest"))).drop("longest")
    ranges = stored(ranged.groupBy("dim", "range").agg(_pieces(bucket_rows)), "ranges")
    piece = F.pmod(F.xxhash64("row", F.lit("piece")), F.col("pieces")).cast("int")
    buckets = stored(_attached(ranged, ranges, ["dim", "range"]).withColumn("piece", piece).drop("pieces"), "buckets")
    queries = buckets.where("asks").select(
        "dim", F.col("row").alias("q_row"), F.col("vec_id").alias("query_id"), F.col("vec_null").alias("query_null"), "v", "length"
    )
    shelves = -(-(ranges.agg(F.sum("pieces")).first()[0] or 1) // SHELF)
    shelf = F.pmod(F.xxhash64("range", "piece"), F.lit(shelves)).cast("int").alias("shelf")

    def meet(asking: DataFrame, pairs: DataFrame) -> DataFrame:
        """``asking`` (with dim and block) against the buckets that ``pairs`` (dim, block, range, piece) names."""
        keys = ["dim", "block", "range", "piece"]
        left = asking.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
        left = left.join(pairs.select("*", shelf), ["dim", "block", "shelf"])
        left = left.select(*keys, "q_row", "query_id", "query_null", "v", "length", "theta")
        right = buckets.join(pairs, ["dim", "range", "piece"]).select(*keys, "row", "vec_id", "vec_null", "v", "length")
        right = right.toDF(*right.columns)  # both sides stem from one table
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(k), HITS)

    def blocks(asking: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
        nth = F.pmod(F.xxhash64("q_row", F.lit("block")), F.col("pieces"))
        return _attached(asking, sizes, by).withColumn("block", _block(by, nth)).drop("pieces")

    # thresholds: the k-th best product with one bucket of the longest range, one after the other by block
    sizes = stored(queries.groupBy("dim").agg(_pieces(block_rows)), "queries")
    first = ranges.groupBy("dim").agg(F.min_by(F.struct("range", "pieces"), "range").alias("f"))
    nth = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("nth")
    probes = sizes.select("dim", nth).join(first, "dim").select(
        "dim", _block(["dim"], F.col("nth")).alias("block"), "f.range", F.pmod("nth", F.col("f.pieces")).cast("int").alias("piece")
    )
    asking = blocks(queries.withColumn("theta", F.lit(float("-inf"))), sizes, ["dim"])
    seeds = meet(asking, stored(probes, "probes"))
    kth = seeds.groupBy("q_row").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("kth"))

    # blocks of queries that need the same ranges: all down to the length theta / |q|
    theta = F.coalesce("kth", F.lit(float("-inf")))
    need = F.when((theta > 0) & (F.col("length") > 0), theta / F.col("length") * (1 - SLACK))
    bounded = _attached(queries.join(kth, "q_row", "left"), longest, ["dim"]).select(
        *queries.columns, theta.alias("theta"), F.coalesce(_range(need, F.col("longest")), F.lit(NO_LENGTH)).alias("last")
    )
    bounded = stored(bounded, "bounded")
    sizes = stored(bounded.groupBy("dim", "last").agg(_pieces(block_rows)), "blocks")
    listed = ranges.groupBy("dim").agg(F.collect_list(F.struct("range", "pieces")).alias("listed"))
    pairs = (
        sizes.select("dim", "last", nth)
        .join(listed, "dim")
        .select("dim", "last", _block(["dim", "last"], F.col("nth")).alias("block"), F.inline("listed"))
        .where("range <= last")
        .repartition("dim", "block", "range")
        .select("dim", "block", "range", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    )
    hits = meet(blocks(bounded, sizes, ["dim", "last"]), stored(pairs, "pairs"))

    # buckets of the first pass are met again, so the second alone is complete
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_null", "vec_id", "row")
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(
        F.when(~F.col("query_null"), F.col("query_id")).alias("query_id"),
        "rank",
        F.when(~F.col("vec_null"), F.col("vec_id")).alias("vec_id"),
        "score",
    )

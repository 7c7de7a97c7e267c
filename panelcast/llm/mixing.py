"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import bounded_batches, col, stored, unit, word_count


#: How much the length balance gives way to unlike sources, see ``entropy_balance``.
GIVE = 0.05


def source_targets(sizes: Sequence[float], weights: Sequence[float], most: float) -> np.ndarray:
    """Shares of the sum of ``sizes`` by weight, none above ``most`` times its source's size.

    The excess of a source at its limit is shared among the others by weight, until none is above.
    """
    sizes, weights = np.asarray(sizes, dtype=float), np.asarray(weights, dtype=float)
    limit = most * sizes
    out, open_, rest = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), sizes.sum()
    while open_.any():
        part = rest * weights / weights[open_].sum()
        over = open_ & (part > limit)
        if not over.any():
            out[open_] = part[open_]
            break
        out[over] = limit[over]
        rest -= limit[over].sum()
        open_ &= ~over
    return out


def bounded_rate(tilt, most: float, exp=np.exp):
    """The exponentially tilted rate between 0 and ``most``; tilt 0 is rate 1. The odds of the rate
    against what is left of ``most`` are multiplied by exp(tilt), so no rate can pass its bound."""
    return most / (1.0 + (most - 1.0) * exp(-tilt))


def entropy_balance(
    rows: DataFrame,
    targets: dict[int, float],
    covariates: dict[str, float] | None = None,
    most: float = 3.0,
    tolerance: float = 1e-9,
    iterations: int = 50,
    give: float = 0.0,
) -> tuple[dict[int, float], dict[str, float]]:
    """Multipliers of the document rates ``bounded_rate(source's + sum of covariate x its)``, closest in
    relative entropy by token to taking every token once, that meet the constraints.

    ``rows`` has ``source_no``, ``size`` and the covariates (null: 0). Constraints: each source's
    tokens (``targets``, by source number), and for each covariate the mean over the tokens taken. Each
    Newton step is one distributed aggregation of the dual's gradient and Hessian, a bounded
    number of sums for each source; a step that does not shorten the gradient is halved. Without
    covariates the solution is one rate for each source. With ``give`` above 0 covariates are balanced as far as a
    penalty of give / 2 x the square of their multipliers, by token, lets them be: there is a solution
    even where sources and covariates contradict one another. Sources are always met.
    """
    names, means = list(covariates or {}), np.array(list((covariates or {}).values()), dtype=float)
    sources = sorted(s for s, t in targets.items() if t > 0)
    at = {s: i for i, s in enumerate(sources)}
    goal, k, j = np.array([targets[s] for s in sources]), len(sources), len(names)
    lam, mu = np.zeros(k), np.zeros(j)
    if not k:
        return {}, dict.fromkeys(names, 0.0)
    spark = rows.sparkSession
    schema = T.StructType([T.StructField("source_no", T.IntegerType()), T.StructField("lam", T.DoubleType())])
    # z: how far a covariate lies from the mean asked for
    z = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)) - float(m) for n, m in zip(names, means)]

    def sums(lam: np.ndarray, mu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        side = spark.createDataFrame([(s, float(lam[i])) for s, i in at.items()], schema)
        tilt = F.col("lam")
        for m, x in zip(mu, z):
            tilt = tilt + float(m) * x
        rate = bounded_rate(tilt, float(most), F.exp)
        kept = F.col("size") * rate
        free = kept * (1.0 - rate / float(most))
        cols = [F.sum(kept), F.sum(free)]
        cols += [F.sum(kept * x) for x in z] + [F.sum(free * x) for x in z]
        cols += [F.sum(free * z[a] * z[b]) for a in range(j) for b in range(j)]
        cols = [c.alias(f"s{i}") for i, c in enumerate(cols)]
        grad, hess = np.concatenate([-goal, np.zeros(j)]), np.zeros((k + j, k + j))
        for r in rows.join(F.broadcast(side), "source_no").groupBy("source_no").agg(*cols).collect():
            i, v = at[r[0]], np.array(r[1:], dtype=float)
            grad[i] += v[0]
            grad[k:] += v[2 : 2 + j]
            hess[i, i] += v[1]
            hess[i, k:] += v[2 + j : 2 + 2 * j]
            hess[k:, i] += v[2 + j : 2 + 2 * j]
            hess[k:, k:] += v[2 + 2 * j :].reshape(j, j)
        grad[k:] += give * scale * mu
        hess[k:, k:] += give * scale * np.eye(j)
        return grad, hess

    scale = goal.sum()
    grad, hess = sums(lam, mu)
    for _ in range(iterations):
        if np.abs(grad).max() <= tolerance * scale:
            break
        step = np.linalg.solve(hess + 1e-12 * scale * np.eye(k + j), -grad)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-300))
        for _ in range(8):
            new_grad, new_hess = sums(lam + step[:k], mu + step[k:])
            if np.linalg.norm(new_grad) < np.linalg.norm(grad):
                break
            step = step / 2
        lam, mu, grad, hess = lam + step[:k], mu + step[k:], new_grad, new_hess
    return {s: float(lam[i]) for s, i in at.items()}, dict(zip(names, map(float, mu)))


def length(size):
    """The covariate that the mix keeps: the binary logarithm of a document's words."""
    return F.log2(F.greatest(size, F.lit(1)).cast("double"))


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more) -> DataFrame:
    text = col(text_col)
    return bounded_batches(docs).select(
        col(id_col).alias("id"),
        col(source_col).cast("string").alias("source"),
        word_count(text.cast("binary")).alias("size"),
        F.xxhash64(col(id_col).cast("string"), text, F.lit("mix")).alias("key"),
        *more,
    ).withColumn("size_class", F.length(F.bin("size")))


@dataclass
class MixPlan:
    """What decides a row's copies: facts of its source and size class, and the copies of the reserved keys."""

    classes: DataFrame
    fixed: DataFrame | None
    most: int
    pull: float
    middle: float

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` (see ``_measured``) with source_no, source_size, target, rate, held and copies. Both tables
        are bounded by sources x size classes and broadcast: rows stay where they are."""
        known = F.col("source").eqNullSafe(F.col("source_")) & (F.col("size_class") == F.col("class_"))
        rows = rows.join(F.broadcast(self.classes), known).drop("source_", "class_")
        tilted = bounded_rate(F.col("lam") + F.lit(self.pull) * (length(F.col("size")) - F.lit(self.middle)), float(self.most), F.exp)
        rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("lam").isNull(), F.lit(float(self.most))).otherwise(tilted)
        rows = rows.withColumn("rate", rate).drop("lam")
        rows = rows.withColumn("held", (unit(F.col("key")) < F.col("reserved")) & (F.col("size") > 0)).drop("reserved")
        up = unit(F.xxhash64("key", F.lit("round"))) < F.col("rate") - F.floor("rate")
        rows = rows.withColumn("copies", F.least((F.floor("rate") + up.cast("int")).cast("int"), F.lit(self.most)))
        if self.fixed is None:
            return rows
        same = (F.col("source_no") == F.col("source_no_")) & (F.col("key") == F.col("key_")) & F.col("held")
        rows = rows.join(F.broadcast(self.fixed), same, "left")
        return rows.withColumn("copies", F.coalesce("copies_", "copies")).drop("copies_", "key_", "source_no_")


def plan_mix(rows: DataFrame, weights: Sequence[float], most: int, reserve: int) -> MixPlan:
    """Targets, rates and reserved copies for stored ``rows`` (see ``_measured``)."""
    spark = rows.sparkSession
    classes = rows.groupBy("source", "size_class").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    names = sorted({r["source"] for r in classes}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    sizes = np.zeros(len(names))
    for r in classes:
        sizes[number[r["source"]]] += r["size"]
    turn = [weights[i % len(weights)] for i in range(len(names))]
    targets = source_targets(sizes, turn, most)

    numbers = spark.createDataFrame([(s, i) for s, i in number.items()], "source_ string, source_no int")
    numbered = rows.where("size > 0").join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("source_")))
    numbered = numbered.select("source_no", "size", length(F.col("size")).alias("length"))
    # a source that must give all it may has no room for an exponential rate
    inside = {i: float(t) for i, t in enumerate(targets) if 0 < t < most * sizes[i] * (1 - 1e-12)}
    mean = numbered.agg(F.try_divide(F.sum(F.col("size") * F.col("length")), F.sum("size"))).first()[0]
    middle = float(mean or 0.0)
    lam, pull = entropy_balance(numbered, inside, {"length": middle}, most, give=GIVE)

    side = [
        (r["source"], r["size_class"], i, int(sizes[i]), float(targets[i]), lam.get(i), reserve / r["n"])
        for r in classes
        for i in (number[r["source"]],)
    ]
    fields = "source_ string, class_ int, source_no int, source_size long, target double, lam double, reserved double"
    plan = MixPlan(spark.createDataFrame(side, fields), None, most, pull["length"], middle)
    first = plan.apply(rows).where("size > 0")
    owed = {i: float(t) for i, t in enumerate(targets)}
    for r in first.where("not held").groupBy("source_no").agg(F.sum(F.col("size") * F.col("copies"))).collect():
        owed[r[0]] -= r[1]
    copies = settle(first.where("held").select("source_no", "key", "size").collect(), owed, most)
    fixed = [(s, k, c) for (s, k), c in copies.items()]
    return MixPlan(plan.classes, spark.createDataFrame(fixed, "source_no_ int, key_ long, copies_ int"), most, plan.pull, plan.middle)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    reserve: int = 64,
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, rate, copies, taken.

    Size is the number of words (runs of characters other than space and x09-x0D; null: 0). Sources in
    code point order, null last, get ``weights`` in turn; see ``source_targets``. Rates solve the
    entropy balance: every source's tokens, and over all of them the mean log length of a document by token, which mixing by
    source alone would shift to the long or short documents of the favoured sources (as far as GIVE lets it). They are rounded to copies by a hash of the id and text, at most ``most``.
    Documents without words get one copy. Repeated rows (equal ids and texts) get equal copies; reruns
    agree. An empty table gives an empty result; other columns are not read.

    Rounding errors are made good per source: about ``reserve`` documents of each size class (sizes within a
    factor of two), chosen by hash, are rounded last, largest first, each so that the source comes closest to
    its target. They are bounded in number by sources x classes, however large the corpus is.
    """
    rows = stored(_measured(docs, id_col, text_col, source_col), "words")
    out = plan_mix(rows, weights, most, reserve).apply(rows)
    return out.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def repeat_by_copies(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    reserve: int = 64,
) -> DataFrame:
    """The mix itself: the rows and columns of ``docs``, each row as often as ``mix`` has copies of it.
    Texts are read twice and never shuffled."""
    rows = stored(_measured(docs, id_col, text_col, source_col), "words")
    plan = plan_mix(rows, weights, most, reserve)
    whole = _measured(docs, id_col, text_col, source_col, F.struct(*map(col, docs.columns)).alias("row"))
    return plan.apply(whole).where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


def settle(rows: Sequence, owed: dict[int, float], most: int) -> dict:
    """Copies of the reserved documents by (source number, key), so that each source comes closest to what
    it still owes. Rows with one key (repeats of a document) get the same number of copies.

    Largest first. What is owed, spread evenly over the documents still ahead, is the rate that a document
    is rounded from: by its hash as long as much is ahead, so that length has no say, then to the nearer.
    """
    groups: dict[int, dict[int, list]] = {}
    for r in rows:
        groups.setdefault(r["source_no"], {}).setdefault(r["key"], []).append(r["size"])
    out = {}
    for s, by_key in groups.items():
        items = sorted(((sum(sizes), k) for k, sizes in by_key.items()), reverse=True)
        ahead, due = sum(size for size, _ in items), owed[s]
        for size, key in items:
            wish = min(max(due / ahead, 0.0), float(most))
            ahead -= size
            at = (key & 0xFFFFFFFF) / 2.0**32 if ahead > 8 * size else 0.5
            copies = min(int(np.floor(wish + at)), most)
            due -= copies * size
            out[(s, key)] = copies
    return out

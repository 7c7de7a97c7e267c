"""Toxicity scores by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, col, fresh, stored, unit

WORD = re.compile(r"[^\W\d_]+")


#: Lengths of the word beginnings that count as features of their own (stems of inflected words).
STEMS = (4, 5, 6)
#: A beginning is frequent in a text where it occurs at least twice and in one of this many words.
FREQUENT = 150


def features(text: str | None) -> set[str]:
    """The distinct lower-case words of the whole text, their beginnings (marked by a hyphen) and the frequent
    beginnings (marked by two: one chance occurrence in a long text says less than several); null has none."""
    # one word at a time: a list of all words of a very long text is many times its size
    words = Counter(m[0] for m in WORD.finditer(text.lower())) if text else Counter()
    found, total = set(words), words.total()
    for n in STEMS:
        stems: Counter[str] = Counter()
        for word, times in words.items():
            if len(word) > n:
                stems[word[:n]] += times
        found.update(f"{stem}-" for stem in stems)
        found.update(f"{stem}--" for stem, times in stems.items() if times > 1 and times * FREQUENT >= total)
    return found


@dataclass
class ToxicityModel:
    """Weights and a bias; the logistic of their sum over a text's distinct features is its score."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        weights = self.weights
        total = self.bias + sum(weights[w] for w in sorted(features(text) & weights.keys()))
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -60, 60))))


def fit_nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05, decay: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier that minimise the non-negative risk

    ``prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])``, l the logistic loss.

    The negative part is estimated without a single negative label. Once it falls below zero the model
    fits its positives too closely: the step then ascends that part instead. Adam on all rows; deterministic.
    """
    p, u = positive.astype(np.float32), unlabelled.astype(np.float32)
    theta = np.zeros(p.shape[1] + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def grad(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(slope @ x, slope.sum())

    for t in range(1, steps + 1):
        gp, gu = p @ theta[:-1].astype(np.float32) + theta[-1], u @ theta[:-1].astype(np.float32) + theta[-1]
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        of_negative = grad(u, su / len(su)) - prior * grad(p, sp / len(sp))
        if negative >= 0:
            g = prior * grad(p, (sp - 1) / len(sp)) + of_negative
        else:
            g = -of_negative
        g[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    learn: Column | None = None,
    max_positive: int = 2000,
    max_unlabelled: int = 6000,
    max_features: int = 512,
    least_z: float = 4.5,
) -> ToxicityModel | None:
    """A model from confirmed toxic documents and unlabelled ones, or None without a toxic example.

    ``labels`` has ``id_col`` and ``toxic`` (nulls are skipped, of repeated rows 1 wins); only labels of rows that meet
    ``learn`` (a condition on the id) are read. The class prior is the toxic share of those labels.
    Samples: about ``max_positive`` toxic documents and ``max_unlabelled`` of all documents,
    by a hash of the id, whole texts. Their features are counted in Spark; up to ``max_features`` of them by which
    the two samples differ most, by at least ``least_z`` standard errors, take part.
    """
    marks = labels.where(col(id_col).isNotNull() & F.col("toxic").isNotNull())
    marks = marks.where(learn) if learn is not None else marks
    marks = marks.groupBy(col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    known, toxic = marks.agg(F.count("*"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).first()
    if not toxic:
        return None
    prior = min(max(toxic / known, 1e-3), 0.9)
    draw = unit(F.xxhash64("id", F.lit("toxic")))
    chosen = marks.where((F.col("toxic") == 1) & (draw < max_positive / toxic)).select("id", F.lit(True).alias("positive"))
    docs = bounded_batches(docs, size="8m")
    source = docs.where(learn) if learn is not None else docs
    rows = source.select(col(id_col).alias("id"), col(text_col).alias("text")).where("id is not null and text is not null")
    total = rows.count()
    rows = rows.join(F.broadcast(chosen), "id", "left").withColumn("unlabelled", unit(F.xxhash64("id", F.lit("any"))) < max_unlabelled / max(total, 1))
    rows = rows.where("positive or unlabelled")

    @F.pandas_udf("array<string>")
    def distinct(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([sorted(features(t)) for t in texts], dtype=object)

    rows = stored(rows.select("id", F.coalesce("positive", F.lit(False)).alias("positive"), "unlabelled", distinct("text").alias("features")), "toxicity")
    n_pos, n_any = rows.agg(F.sum(F.col("positive").cast("int")), F.sum(F.col("unlabelled").cast("int"))).first()
    if not n_pos or not n_any:
        return None
    p, q = F.sum(F.col("positive").cast("int")), F.sum(F.col("unlabelled").cast("int"))
    counts = rows.select("positive", "unlabelled", F.explode("features").alias("feature")).groupBy("feature").agg(p.alias("p"), q.alias("q"))
    share_p, share_q = F.col("p") / n_pos, F.col("q") / n_any
    pooled = (F.col("p") + F.col("q") + 1) / (n_pos + n_any + 2)
    differ = F.abs(share_p - share_q) / F.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_any) + 1e-12)
    vocabulary = [r[0] for r in counts.select("feature", differ.alias("z")).where(F.col("z") >= least_z).orderBy(F.desc("z"), "feature").limit(max_features).collect()]
    at = {w: i for i, w in enumerate(vocabulary)}

    @F.pandas_udf("array<int>")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in parts:
            yield pd.Series([[at[w] for w in ws if w in at] for ws in lists], dtype=object)

    table = rows.select("id", "positive", "unlabelled", found("features").alias("found")).orderBy("id").toPandas()
    x = np.zeros((len(table), len(vocabulary)), dtype=np.uint8)
    for i, slots in enumerate(table["found"]):
        x[i, np.asarray(slots, dtype=np.int64)] = 1
    weights, bias = fit_nnpu(x[table["positive"].to_numpy()], x[table["unlabelled"].to_numpy()], prior)
    return ToxicityModel(dict(zip(vocabulary, map(float, weights))), bias)


def toxicity_score(model: ToxicityModel | None, text: Column) -> Column:
    """The score of each whole text between 0 and 1; null and empty texts get the bias alone, and
    everything gets 0 without a model."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([model.score(t) if model else 0.0 for t in texts], dtype="float64")

    return score(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **how) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    model = train(docs, labels, id_col, text_col, **how)
    name = fresh(docs, "toxicity")
    return docs.withColumn(name, toxicity_score(model, col(text_col))).where(F.col(name) < threshold).drop(name)

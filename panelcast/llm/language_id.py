"""Language identification by error-correcting output codes over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, col, unit

DIMENSIONS = 4096
#: Odd multipliers of the n-gram hash, by position of the character.
MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def features(text: str | None) -> np.ndarray | None:
    """Square roots of the shares of hashed 1- to 3-grams of the whole text (a unit vector), or None
    without a letter. Letters are lower-cased; every run of other characters is one boundary."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate((np.array([32], dtype=np.uint32), codes[keep], np.array([32], dtype=np.uint32)))
    counts = np.zeros(DIMENSIONS)
    hashed = np.zeros(len(codes), dtype=np.uint32)
    for n, multiplier in enumerate(MULTIPLIERS, start=1):
        if len(codes) < n:
            break
        hashed = hashed[: len(codes) - n + 1] * np.uint32(31) + codes[n - 1 :] * multiplier
        slot = ((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
        counts += np.bincount(slot, minlength=DIMENSIONS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """Rows of +1 and -1, one for each class: the exhaustive code for up to 5 classes, beyond that the best
    of some random codes by least distance between two rows. No column is constant."""
    if classes < 2:
        return np.ones((classes, 0), dtype=np.int8)
    if classes <= 5:
        rest = [bits for bits in product((1, -1), repeat=classes - 1) if -1 in bits]
        return np.array([[1, *bits] for bits in rest], dtype=np.int8).T
    length, rng, best, reach = 4 * int(np.ceil(np.log2(classes))) + 11, np.random.default_rng(seed), None, -1
    for _ in range(300):
        code = rng.choice(np.array([1, -1], dtype=np.int8), size=(classes, length))
        if (np.abs(code.sum(axis=0)) == classes).any():
            continue
        apart = (length - code.astype(int) @ code.T.astype(int)) // 2 + length * np.eye(classes, dtype=int)
        if apart.min() > reach:
            best, reach = code, apart.min()
    return best


@dataclass
class LanguageModel:
    """Languages with their codewords, and for each bit a linear classifier, its slope and its weight."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class numbers, scores and runner-up classes of feature rows: the codeword with the least sum of the
        bits' logistic losses, each weighted by its classifier's trust; the score is its softmax share."""
        margin = (x @ self.weights + self.bias) * self.slope
        loss = np.logaddexp(0.0, -margin[:, None, :] * self.code[None, :, :]) @ self.trust
        order = np.argsort(loss, axis=1, kind="stable")
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        score = share.max(axis=1) / share.sum(axis=1)
        return order[:, 0], score, order[:, min(1, order.shape[1] - 1)]


def fit(x: np.ndarray, labels: list[str], ridge: float = 1e-3) -> LanguageModel:
    """One ridge classifier for each bit of the codewords, all in closed form. Their leave-one-out
    predictions, a by-product of the solution, give each bit's slope and trust."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    of = {name: i for i, name in enumerate(languages)}
    y = code[[of[name] for name in labels]].astype(float)
    if not code.shape[1]:
        empty = np.zeros(0)
        return LanguageModel(languages, code, np.zeros((DIMENSIONS, 0)), empty, empty, empty)
    mean = x.mean(axis=0, dtype=float)
    z = x - mean.astype(np.float32)
    # equal say for every language, however many examples it has
    share = np.bincount([of[name] for name in labels], minlength=len(languages))
    w = np.sqrt(len(labels) / (len(languages) * share[[of[name] for name in labels]]))
    zw = np.column_stack([z, np.ones(len(z), dtype=np.float32)]) * w[:, None].astype(np.float32)
    yw = y * w[:, None]
    gram = (zw @ zw.T).astype(float)
    gram[np.diag_indices(len(z))] += ridge * len(z) * gram.diagonal().mean() / 10
    inverse = np.linalg.inv(gram)
    del gram, z
    dual = inverse @ yw
    held_out = (yw - dual / inverse.diagonal()[:, None]) / w[:, None]
    full = zw.T @ dual.astype(np.float32)
    weights, bias = full[:-1], full[-1] - mean @ full[:-1]
    right = ((held_out * y) > 0).mean(axis=0)
    trust = np.clip(2 * right - 1, 0.02, None)
    spread = np.maximum((held_out * y).std(axis=0), 0.05)
    slope = 2.0 * np.maximum((held_out * y).mean(axis=0), 0.05) / spread**2
    return LanguageModel(languages, code, weights.astype(np.float32), bias, np.clip(slope, 1, 12), trust / trust.sum() * len(trust))


def train(docs: DataFrame, text_col: str, lang_col: str, key: Column, max_rows: int = 2400) -> LanguageModel | None:
    """A model of whole texts and their languages, from about ``max_rows`` rows shared evenly among the languages and
    chosen by a hash of ``key`` (null and letterless texts teach nothing). None without any language."""
    rows = bounded_batches(docs).where(col(lang_col).isNotNull() & col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(col(lang_col)).count().collect()}
    if not counts:
        return None
    each = max_rows / len(counts)
    wanted = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, each / n))])

    @F.pandas_udf("binary")
    def vector(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            found = map(features, texts)
            yield pd.Series([None if v is None else v.astype(np.float16).tobytes() for v in found], dtype=object)

    sample = (
        rows.where(unit(F.xxhash64(key.cast("string"), F.lit("lang"))) < F.element_at(wanted, col(lang_col)))
        .select(col(lang_col).alias("lang"), vector(col(text_col)).alias("x"), F.xxhash64(key.cast("string")).alias("k"))
        .where("x is not null")
        .orderBy("k", "lang", "x")
        .drop("k")
        .toPandas()
    )
    if sample.empty:
        return None
    x = np.stack([np.frombuffer(b, dtype=np.float16) for b in sample["x"]]).astype(np.float32)
    return fit(x, sample["lang"].tolist())


def predict_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", certain: float = 0.6) -> Column:
    """A struct for each whole text: lang_pred, score (0 to 1), second (the runner-up) and ambiguous.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything without a model.
    ``ambiguous`` is true below the score ``certain``. Ties go to the first language in order.
    """

    @F.pandas_udf("lang_pred string, score double, second string, ambiguous boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            second: list[str | None] = [None] * len(texts)
            for at in range(0, len(texts) if model else 0, 256):
                vectors = {i: v for i, t in enumerate(texts.iloc[at : at + 256], at) if (v := features(t)) is not None}
                if not vectors:
                    continue
                known = list(vectors)
                best, share, other = model.decode(np.stack(list(vectors.values())))
                score[known] = share
                for i, b, o in zip(known, best, other):
                    lang[i], second[i] = model.languages[b], model.languages[o] if o != b else None
            yield pd.DataFrame(
                {"lang_pred": lang, "score": score, "second": second, "ambiguous": score < certain},
                columns=["lang_pred", "score", "second", "ambiguous"],
            )

    bounded_batches(docs)
    return predict(col(text_col))

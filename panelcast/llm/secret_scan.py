"""Secret scans: known forms by pattern, unknown ones by sliding-window entropy."""

from __future__ import annotations

from collections.abc import Sequence
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import col

#: The forms of the base scan, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LENGTH = 8
#: Candidate strings of the entropy scan.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Character classes of candidates, first that fits: name, pattern, alphabet, least entropy in bits of a window.
CLASSES: tuple[tuple[str, str, str, float], ...] = (
    ("digits", r"^[0-9]+$", "0123456789", 2.8),
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdefABCDEF", 3.0),
    ("lower", r"^(?:[a-z]+|[A-Z]+|[A-Z][a-z]+)$", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 4.0),
    ("alnum", r"^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 3.7),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.7),
)
#: Patterns of harmless candidates: separators and paths, words with separators, placeholders, UUIDs.
#: Repeated groups are possessive: others recurse once for each repetition and overflow on long candidates.
ALLOW = (
    r"^(.)\1*$",
    r"^[-_=+/]+$",
    r"^/?(?:[a-z]++[-_/])++[a-z]*+$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^(?:0123456789|abcdefghijklm|ABCDEFGHIJKLM)",
)

#: Words that mark an example, by pattern and length: what they cover is no part of a candidate.
ALLOW_WORDS: tuple[tuple[str, int], ...] = (
    ("example", 7), ("sample", 6), ("placeholder", 11), ("changeme", 8), ("xxxx", 4), ("test[-_]key", 8), ("testkey", 7),
)


def spans_of(text: Column, pattern: str) -> Column:
    """Structs (start, end, match) of all leftmost matches, in code points.

    What lies between the matches comes from splitting at them; running sums of the lengths of gaps
    and matches give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.greatest(F.size(found), F.lit(1)))
    both = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), found.alias("match"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("spans"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(s["spans"], F.array(span)).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.when(F.size(found) > 0, F.aggregate(both, state, step, lambda s: s["spans"])).otherwise(none)


def window_entropy(chars: Column, alphabet: str, least: float, window: int = WINDOW) -> Column:
    """Struct (low, high, best) of a candidate's characters: the first character of the first window and the one
    after the last window whose Shannon entropy is ``least`` or more (both -1 if none), and the highest entropy.

    Counts are kept for each character; when the window moves, one count goes up and one down, and the
    sum of count x log2(count) changes by these two terms alone.
    """
    # what a count of n adds when it grows to n + 1
    gain = F.array(*[F.lit(_nlog(n + 1) - _nlog(n)) for n in range(window + 1)])
    size = F.size(chars)
    zero = F.transform(F.sequence(F.lit(1), F.lit(len(alphabet))), lambda _: F.lit(0))
    state = F.struct(
        zero.alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1).alias("low"), F.lit(-1).alias("high"), F.lit(0.0).alias("best"), F.lit(0).alias("at")
    )
    log_window = _nlog(window) / window

    def place(c: Column) -> Column:
        return F.instr(F.lit(alphabet), c)

    def step(s: Column, c: Column) -> Column:
        coming = place(c)
        going = F.when(s["at"] >= window, place(F.get(chars, s["at"] - window))).otherwise(F.lit(0))
        same = coming == going
        up, down = F.get(s["counts"], coming - 1), F.get(s["counts"], going - 1)
        total = s["sum"] + F.when(same, F.lit(0.0)).otherwise(
            F.get(gain, up) - F.when(going > 0, F.get(gain, down - 1)).otherwise(F.lit(0.0))
        )
        counts = F.when(same, s["counts"]).otherwise(
            F.transform(s["counts"], lambda n, i: n + F.when(i == coming - 1, 1).when(i == going - 1, -1).otherwise(0))
        )
        entropy = F.lit(log_window) - total / window
        hot = (s["at"] >= window - 1) & (entropy >= least - 1e-9)
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(hot & (s["low"] < 0), s["at"] - (window - 1)).otherwise(s["low"]).alias("low"),
            F.when(hot, s["at"] + 1).otherwise(s["high"]).alias("high"),
            F.when(s["at"] >= window - 1, F.greatest(s["best"], entropy)).otherwise(s["best"]).alias("best"),
            (s["at"] + 1).alias("at"),
        )

    done = F.aggregate(chars, state, step, lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high"), s["best"].alias("best")))
    return F.when(size >= window, done).otherwise(F.struct(F.lit(-1).alias("low"), F.lit(-1).alias("high"), F.lit(0.0).alias("best")))


def _nlog(n: int) -> float:
    return n * log2(n) if n else 0.0


def masked(text: Column, spans: Column, words: Sequence[tuple[str, int]] = ALLOW_WORDS) -> Column:
    """``text`` with blanks for the characters of ``spans`` (sorted by start; they may overlap) and of allow-listed words."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        gap = F.greatest(span["start"] - s["at"], F.lit(0))
        end = F.greatest(span["end"], s["at"])
        kept = F.substring(text, s["at"] + 1, gap)
        return F.struct(end.alias("at"), F.concat(s["out"], kept, F.repeat(F.lit(" "), end - s["at"] - gap)).alias("out"))

    cut = F.aggregate(spans, state, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    out = F.when(F.size(spans) > 0, cut).otherwise(text)
    for word, n in words:
        out = F.regexp_replace(out, f"(?i){word}", " " * n)
    return out


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    allow: Sequence[str] = ALLOW,
    classes: Sequence[tuple[str, str, str, float]] = CLASSES,
) -> DataFrame:
    """One row per row of ``docs``: id, base and added: arrays of spans (kind, start, end, entropy).

    Base spans are matches of the known forms: ``assign`` (value of ASSIGN_LENGTH characters or more),
    ``access`` and ``hex``, leftmost and non-overlapping for each kind, in whole texts (null: empty), ordered by start,
    then kind as listed here. Positions are code points, the end exclusive.

    Added spans (``entropy``) come from candidate strings in what base spans and allow-listed words leave of the text, so that a
    second secret beside a known one is found: a candidate belongs to the
    first character class it fits; where windows of its characters reach the class's entropy, the span
    from the first to the last of them is added, unless the whole candidate is on the allow-list. Base spans
    are never suppressed. Repeated rows stay; other columns are not read. Everything is a row-wise
    expression on built-in functions: no shuffle.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    kinds = ("assign", "access", "hex")
    rows = docs.select(col(id_col).alias("id"), text.alias("text"))
    # a text without these marks has no match; most texts skip the patterns
    lower = F.lower("text")
    may_assign = F.lit(False)
    for word in ("passw", "secret", "token", "api"):
        may_assign = may_assign | F.contains(lower, F.lit(word))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    rows = rows.select(
        "id",
        "text",
        F.when(may_assign, spans_of(F.col("text"), ASSIGN)).otherwise(none).alias("assign"),
        F.when(F.contains("text", F.lit("AKIA")), spans_of(F.col("text"), ACCESS)).otherwise(none).alias("access"),
        F.when(F.rlike("text", F.lit(HEX)), spans_of(F.col("text"), HEX)).otherwise(none).alias("hex"),
        F.rlike("text", F.lit(CANDIDATE)).alias("may"),
    )
    rows = rows.withColumn(
        "assign", F.filter("assign", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LENGTH)
    )

    def listed(kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(kinds.index(kind)).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end"),
                F.lit(None).cast("double").alias("entropy"),
            ),
        )

    rows = rows.withColumn("base", F.array_sort(F.concat(*[listed(k) for k in kinds])))
    rows = rows.withColumn("rest", F.when(F.col("may"), masked(F.col("text"), F.col("base"))))
    rows = rows.withColumn("candidates", F.when(F.rlike("rest", F.lit(CANDIDATE)), spans_of(F.col("rest"), CANDIDATE)).otherwise(none))
    rows = rows.withColumn("candidates", F.filter("candidates", lambda c: ~_allowed(c["match"], allow)))
    rows = rows.withColumn(
        "candidates", F.transform("candidates", lambda c: F.struct(c["start"].alias("start"), c["match"].alias("match"), F.split(c["match"], "").alias("chars")))
    )

    def measured(c: Column) -> Column:
        found = F.lit(None)
        for _, pattern, alphabet, least in reversed(classes):
            found = F.when(F.rlike(c["match"], F.lit(pattern)), window_entropy(c["chars"], alphabet, least)).otherwise(found)
        return F.struct(c["start"].alias("at"), found.alias("found"))

    rows = rows.withColumn("added", F.filter(F.transform("candidates", measured), lambda m: m["found"]["low"] >= 0))
    return rows.select(
        F.col("id").alias(id_col),
        F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"), b["entropy"].alias("entropy"))).alias("base"),
        F.transform(
            "added",
            lambda m: F.struct(
                F.lit("entropy").alias("kind"),
                (m["at"] + m["found"]["low"]).alias("start"),
                (m["at"] + m["found"]["high"]).alias("end"),
                m["found"]["best"].alias("entropy"),
            ),
        ).alias("added"),
    )


def _allowed(candidate: Column, allow: Sequence[str]) -> Column:
    out = F.lit(False)
    for pattern in allow:
        out = out | F.rlike(candidate, F.lit(pattern))
    return out


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

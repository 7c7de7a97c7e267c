"""Benchmark decontamination by canonical templates: numbers, names and units become typed slots."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import BROADCAST_ROWS, bounded_batches, col, stored, without

#: Words that are units when they follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs "
    "pound pounds oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min "
    "minute minutes h hr hour hours day days week weeks month months year years percent dollar dollars cent cents "
    "euro euros usd eur gbp mph kmh hz khz mhz ghz kb mb gb tb w kw v a k c f degree degrees".split()
)
#: English number words below ten, below twenty, tens, and multipliers.
ONES, TEENS, TENS, SCALES = 1, 2, 3, 4
NUMBER_WORDS = {
    ONES: "zero one two three four five six seven eight nine".split(),
    TEENS: "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(),
    TENS: "twenty thirty forty fifty sixty seventy eighty ninety".split(),
    SCALES: "hundred thousand million billion trillion".split(),
}
#: Signs next to a number that stand for its unit.
SIGNS = np.array([ord(c) for c in "$%£¥€"], dtype=np.uint32)
NUMBER, NAME, UNIT = 1, 2, 3
SLOT_NAMES = {NUMBER: "number", NAME: "name", UNIT: "unit"}
LETTER, DIGIT, UPPER, STOP, PARTS, SIGN = 1, 2, 4, 8, 16, 32
#: Space, tab, hyphen and apostrophes: the words of one name may have these between them.
JOINTS = np.array([0x20, 0x09, 0xA0, 0x2D, 0x27, 0x2019], dtype=np.uint32)
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
WINDOW = len(MULTIPLIERS)


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: flags (letter, digit, upper case, end of a sentence or line, parting words, sign) and a hash of the
    lower-case form."""
    size = 0x110000
    flags = np.full(size, PARTS, dtype=np.uint8)
    lower = np.arange(size, dtype=np.uint64)
    for c in map(chr, range(size)):
        if c.isalnum():
            at = ord(c)
            flags[at] = DIGIT if c.isdecimal() else LETTER
            if c.isupper():
                flags[at] |= UPPER
                lower[at] = ord(c.lower()[0])
    flags[JOINTS] = 0
    flags[[ord(c) for c in ".!?:\n"]] |= STOP
    flags[SIGNS] |= SIGN
    return flags, _mixed(lower + np.uint64(1))


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(size, 0x9E3779B97F4A7C15, dtype=np.uint64))


@lru_cache(maxsize=1)
def _number_words() -> tuple[dict[int, int], int, np.ndarray]:
    """Class of each number word by code, the code of "and", and a table of the codes' bits that finds candidates."""
    hashes = _characters()[1]

    def code(word: str) -> int:
        points = np.array([ord(c) for c in word])
        return int(_mixed((hashes[points] * _powers(64)[: len(word)]).sum(dtype=np.uint64, keepdims=True))[0] | np.uint64(8))

    classes = {code(word): kind for kind, words in NUMBER_WORDS.items() for word in words}
    likely = np.zeros(1 << 12, dtype=bool)
    likely[[c >> 52 for c in classes]] = True
    return classes, code("and"), likely


def _numbers_in_words(codes: np.ndarray, digits: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are number words, and which words go on with the number before them: ones after tens, a multiplier after
    any number, ones to tens after a multiplier or its "and"."""
    classes, link, likely = _number_words()
    word, on = np.zeros(len(codes), dtype=bool), np.zeros(len(codes), dtype=bool)
    found = {i: classes[c] for i in np.flatnonzero(likely[codes >> np.uint64(52)]).tolist() if (c := int(codes[i])) in classes}
    word[list(found)] = True
    for i, kind in found.items():
        if i and not apart[i]:
            before = found.get(i - 1, 0)
            linked = kind != SCALES and i > 1 and not apart[i - 1] and int(codes[i - 1]) == link and found.get(i - 2) == SCALES
            on[i] = linked or (kind == SCALES and (before or digits[i - 1])) or (kind == ONES and before == TENS) or (kind != SCALES and before == SCALES)
            if linked:
                word[i - 1] = on[i - 1] = True
    return word, on


def plain(text: str | None) -> str:
    """The text with the one common letter that capitals spell otherwise in their spelling."""
    return text.replace("ß", "ss").replace("ẞ", "SS") if text else ""


def tokens(text: str, names: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, starts and ends of a text's tokens: runs of letters, and numbers with their points and commas.

    Slots have the codes NUMBER (digits, or English number words that make one number), UNIT (a unit word next after a number,
    or a currency or percent sign beside one, which comes after the number wherever it is written) and, if ``names``, NAME (capitalised words next to
    each other that neither begin a sentence or line nor stand beside another one wholly in capitals, being so themselves);
    the code of any other word is a hash of its lower-case letters.
    """
    read = readings(text)
    starts, ends = read[1:3]
    codes, first = read[3 if names else 0]
    if not len(codes):
        return codes, starts, ends
    return codes, starts[first], ends[np.concatenate((first[1:], [len(starts)])) - 1]


def readings(text: str) -> tuple:
    """((codes, first) without names, starts, ends, (codes, first) with names, (codes, first) with names also
    where a capitalised word begins a sentence or line). ``first`` is the word with which a token begins;
    names run over words with nothing but spaces, hyphens or apostrophes between them, but not into a new sentence.
    """
    none = np.zeros(0, dtype=np.int64)
    empty = (none.astype(np.uint64), none)
    if not text:
        return empty, none, none, empty, empty
    table, hashes = _characters()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    flags = table[points]
    digit = (flags & DIGIT) > 0
    if len(points) > 2 and digit.any():
        inside = np.flatnonzero(digit[:-2] & digit[2:] & ((points[1:-1] == 44) | (points[1:-1] == 46))) + 1
        flags[inside] = DIGIT
    kind = flags & (LETTER | DIGIT)
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(points)]))
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return empty, none, none, empty, empty
    lengths = ends - starts
    # the characters of all tokens, one behind the other, and each one's place in its token
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    power = _powers(1 << max(6, int(lengths.max()).bit_length()))
    inner = kind > 0
    codes = np.add.reduceat(hashes[points[inner]] * power[place], first)
    codes = _mixed(codes) | np.uint64(8)

    def after_any(flag: int) -> np.ndarray:
        """Whether a character with the flag stands between a word and the one before."""
        count = np.searchsorted(np.flatnonzero(flags & flag), starts)
        return np.concatenate(([True], count[1:] > count[:-1]))

    begins = after_any(STOP)
    number = kind[starts] == DIGIT
    capitals = np.bitwise_and.reduceat(flags[inner], first) & UPPER > 0
    beside = np.zeros(len(starts), dtype=bool)
    beside[1:] = capitals[:-1]
    beside[:-1] |= capitals[1:]
    apart = begins | after_any(PARTS)
    word, on = _numbers_in_words(codes, number, apart)
    named = ((flags[starts] & UPPER) > 0) & ~(capitals & beside) & ~number & ~word
    digits, number = number, number | word
    codes[number] = NUMBER
    after = np.flatnonzero(number[:-1] & ~number[1:]) + 1
    units = [i for i in after.tolist() if lengths[i] <= 10 and text[starts[i] : ends[i]].lower() in UNITS]
    codes[units] = UNIT
    named[units] = False
    signs = np.flatnonzero(flags & SIGN) if digits.any() else ()
    if len(signs):
        # the word with each sign's number: the one that begins behind it, else the one that ends before it or a space
        behind = np.searchsorted(starts, signs)
        leads = (behind < len(starts)) & digits[np.minimum(behind, len(starts) - 1)] & (starts[np.minimum(behind, len(starts) - 1)] == signs + 1)
        gap = signs - ends[behind - 1]
        trails = (behind > 0) & digits[behind - 1] & ((gap == 0) | ((gap == 1) & (points[signs - 1] == 0x20))) & ~leads
        at = np.where(leads, behind, behind - 1)[leads | trails] + 1
        signs = signs[leads | trails]
        order = np.argsort(at, kind="stable")
        at, signs = at[order], signs[order]
        starts, ends = np.insert(starts, at, signs), np.insert(ends, at, signs + 1)
        codes = np.insert(codes, at, np.uint64(UNIT))
        begins, named, apart, on = (np.insert(x, at, False) for x in (begins, named, apart, on))

    def read(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined = on.copy()
        joined[1:] |= names[1:] & names[:-1] & ~apart[1:]
        at = np.flatnonzero(~joined)
        return np.where(names, np.uint64(NAME), codes)[at], at

    return read(np.zeros(len(codes), dtype=bool)), starts, ends, read(named & ~begins), read(named)


def window_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all windows of five tokens; of the whole sequence if it is shorter, none if it is empty."""
    n = len(codes)
    if n < WINDOW:
        if not n:
            return np.zeros(0, dtype=np.uint64)
        whole = (codes * MULTIPLIERS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
        return _mixed(whole)
    total = codes[: n - WINDOW + 1] * MULTIPLIERS[0]
    for i in range(1, WINDOW):
        total = total + codes[i : n - WINDOW + 1 + i] * MULTIPLIERS[i]
    return _mixed(total)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _spans(codes: np.ndarray, first: np.ndarray, words: int, at: int) -> list[tuple[int, int]]:
    """First word and number of words of the slots of the window at token ``at``."""
    last = min(at + WINDOW, len(codes))
    return [(int(first[i]), int((first[i + 1] if i + 1 < len(first) else words) - first[i])) for i in range(at, last) if codes[i] <= UNIT]


def _words(text: str, starts: np.ndarray, ends: np.ndarray, at: int = 0, n: int | None = None) -> list[str]:
    """``n`` words from word ``at`` on, or all."""
    n = len(starts) if n is None else n
    return [text[a:b].lower() for a, b in zip(starts[at : at + n].tolist(), ends[at : at + n].tolist())]


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(item, template, shape, words) of every item, and (shape, at, to, line, hash, slots, windows) of every window;
    rows without id or token have none.

    Items have one template if they read alike with names as slots, and one shape if moreover their names have as many words.
    Windows come from three readings: with names, with names where a sentence or line begins too (any of
    its words may stand inside a sentence of a document), and, for documents wholly in capitals or lower case, without. Each
    counts for the words that its first token has (``at`` up to ``to``), and the last one for those left. ``windows`` is the number
    of words that windows of words begin with; ``line`` counts tokens of the reading with most names.
    ``slots`` are first word, number of words, and whether only the second reading has the slot.
    """

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for item, text in zip(part["item"], map(plain, part["text"])):
                spelt, starts, ends, inner, every = readings(text)
                n = len(starts)
                if not n:
                    continue
                windows = max(1, n - WINDOW + 1)
                template = xxhash.xxh64_intdigest(inner[0].tobytes()) - (1 << 63)
                shape = xxhash.xxh64_intdigest(b"".join(x.tobytes() for x in (*inner, *every))) - (1 << 63)
                line = np.searchsorted(every[1], np.arange(n), side="right") - 1
                known, seen = set(zip(inner[1][inner[0] <= UNIT].tolist(), inner[0][inner[0] <= UNIT].tolist())), {}
                for codes, first in (inner, every, spelt):
                    hashes = window_hashes(codes).view(np.int64).tolist()
                    for i, h in enumerate(hashes):
                        at = int(first[i])
                        to = windows if i + 1 == len(hashes) else min(windows, int(first[i + 1]))
                        kinds = [int(c) for c in codes[i : i + WINDOW] if c <= UNIT]
                        slots = [(p, k, (p, c) not in known) for (p, k), c in zip(_spans(codes, first, n, i), kinds)]
                        seen.setdefault((at, h), (at, max(to, at + 1), int(line[at]), h, slots))
                rows.append((item, template, shape, _words(text, starts, ends), windows, list(seen.values())))
            yield pd.DataFrame(rows, columns=["item", "template", "shape", "words", "windows", "found"])

    rows = bounded_batches(benchmark).select(col(id_col).cast("long").alias("item"), col(text_col).alias("text"))
    slot = "struct<at:int,n:int,initial:boolean>"
    found = f"array<struct<at:int,to:int,line:int,hash:long,slots:array<{slot}>>>"
    rows = rows.where("item is not null and text is not null").mapInPandas(
        of, f"item long, template long, shape long, words array<string>, windows int, found {found}"
    )
    rows = stored(rows, "benchmark")
    return rows.select("item", "template", "shape", "words"), rows.select("shape", "windows", F.explode("found").alias("w")).select("shape", "windows", "w.*").distinct()


def _filter(windows: DataFrame, total: int, max_filter_bytes: int) -> np.ndarray:
    """A bitmap over hashes of the benchmark's windows, 16 bits for each up to ``max_filter_bytes``."""
    bits = 1 << 15
    while bits < 16 * total and bits < 8 * max_filter_bytes:
        bits *= 2
    bit = F.pmod("hash", F.lit(bits))
    blocks = windows.groupBy(F.floor(bit / 32768).alias("block")).agg(F.bitmap_construct_agg(bit % 32768).alias("bitmap"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for block, bitmap in blocks.toLocalIterator():
        out[block * 4096 : (block + 1) * 4096] = np.frombuffer(bytes(bitmap), dtype=np.uint8)
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = 0.8,
    max_filter_bytes: int = 32 << 20,
) -> DataFrame:
    """Pairs of a document and a benchmark template it contains: id, item_id, items, windows, matched,
    containment, start, slots, consistency, kind.

    Benchmark items with the same template form a class: ``item_id`` is its smallest item, ``items``
    their number. A pair is found if at least ``threshold`` of the template's five-word windows occur in the
    document (items below five tokens: if they are all of the document), and if the slots agree: along the alignment with most
    windows, at least ``threshold`` of the item's slot values each stand for one value of the document
    throughout. ``kind`` is ``exact`` if all values are the item's own and ``reworded`` otherwise.
    Null texts, texts without a token and null ids match nothing; rows that share an id count as one document.
    Empty tables give an empty result.

    Documents are read once, whole. A bitmap of bounded size drops windows that are no item's; the others
    meet the items' windows in an equi-join on the hash, broadcast while the items' windows number at most
    BROADCAST_ROWS.
    """
    items, windows = benchmark_windows(benchmark, item_col, item_text_col)
    classes = items.groupBy("template").agg(F.min("item").alias("item"), F.countDistinct("item").alias("items"))
    variants = stored(items.select("template", "shape", "words").distinct().join(classes, "template").drop("template"), "variants")
    windows = stored(windows.withColumnRenamed("line", "theirs_line"), "templates")
    total = windows.count()
    bitmap = docs.sparkSession.sparkContext.broadcast(_filter(windows, total, max_filter_bytes))

    def candidates(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = bitmap.value
        mask = np.uint64(len(seen) * 8 - 1)
        for part in parts:
            rows = []
            for doc, text in zip(part["id"], map(plain, part["text"])):
                spelt, starts, ends, inner, every = readings(text)
                n = len(starts)
                for codes, first in (inner, every) if n else ():
                    hashes = window_hashes(codes)
                    at = first[: len(hashes)]
                    if codes is every[0]:  # only what reads otherwise than before
                        other = before[at] != hashes
                        hashes, at, place = hashes[other], at[other], np.flatnonzero(other)
                    else:
                        before = np.zeros(n, dtype=np.uint64)
                        before[at] = hashes
                        place = np.arange(len(hashes))
                    bit = hashes & mask
                    hit = np.flatnonzero((seen[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
                    line = np.searchsorted(every[1], at[hit], side="right") - 1
                    for i, at_line in zip(hit.tolist(), line.tolist()):
                        ours = [" ".join(_words(text, starts, ends, *span)) for span in _spans(codes, first, n, int(place[i]))]
                        rows.append((doc, int(at[i]), at_line, int(hashes[i].view(np.int64)), ours))
            yield pd.DataFrame(rows, columns=["id", "start", "line", "hash", "ours"])

    texts = bounded_batches(docs).select(col(id_col).cast("long").alias("id"), col(text_col).alias("text")).where("id is not null and text is not null")
    found = texts.mapInPandas(candidates, "id long, start int, line int, hash long, ours array<string>")
    side = F.broadcast(windows) if total <= BROADCAST_ROWS else windows
    met = found.join(side, "hash").select(
        "id", "shape", "windows", "at", "to", (F.col("line") - F.col("theirs_line")).alias("shift"), "start", F.arrays_zip("slots", "ours").alias("slots")
    )
    alignment = met.groupBy("id", "shape", "shift").agg(
        F.first("windows").alias("windows"),
        F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("to") - 1)))).alias("ats"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
        F.min("start").alias("start"),
    )
    pairs = alignment.groupBy("id", "shape").agg(
        F.first("windows").alias("windows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("matched"),
        F.max(F.size("ats")).alias("most"),
        F.collect_list(F.struct(F.size("ats").alias("own"), "slots", "start")).alias("alignments"),
    )
    pairs = pairs.withColumn("containment", F.col("matched") / F.col("windows")).where(F.col("containment") >= threshold)
    full = F.filter("alignments", lambda a: (a["own"] == F.col("most")) | (a["own"] >= threshold * F.col("windows")))
    pairs = pairs.withColumn("found", F.explode(full)).drop("alignments")
    def read(s: Column) -> Column:
        theirs = F.array_join(F.slice("words", s["slots"]["at"] + 1, s["slots"]["n"]), " ")
        return F.struct(
            (s["slots"]["at"] + s["slots"]["n"]).alias("end"), (theirs != s["ours"]).alias("other"), (-s["slots"]["n"]).alias("n"),
            (-F.length(s["ours"])).alias("length"), theirs.alias("theirs"), s["ours"].alias("ours"), s["slots"]["initial"].alias("initial"),
        )

    # readings may cut a name at a sentence's first word: of one slot the reading that is the item's own counts, else the longest
    judged = pairs.join(variants, "shape").withColumn("read", F.transform("found.slots", read))
    ends = F.array_distinct(F.transform("read", lambda s: s["end"]))
    judged = judged.withColumn("pairs", F.transform(ends, lambda end: F.array_min(F.filter("read", lambda s: s["end"] == end))))
    # a word that begins a sentence and stays is no evidence that slots agree
    values = F.array_distinct(F.transform(F.filter("pairs", lambda s: ~s["initial"] | (s["theirs"] != s["ours"])), lambda s: s["theirs"]))
    judged = judged.withColumn("values", values)
    steady = F.filter(
        "values", lambda v: F.size(F.array_distinct(F.transform(F.filter("pairs", lambda s: s["theirs"] == v), lambda s: s["ours"]))) == 1
    )
    consistency = F.when(F.size("values") == 0, F.lit(1.0)).otherwise(F.size(steady) / F.size("values"))
    judged = judged.withColumn("consistency", consistency).withColumn("same", F.forall("pairs", lambda s: s["theirs"] == s["ours"]))
    rank = F.struct("same", "consistency", "containment", F.col("found.own"), -F.col("found.start"))
    row = F.struct("items", "windows", "matched", "containment", F.col("found.start").alias("start"), F.size("values").alias("slots"), "consistency", "same")
    best = judged.where(F.col("consistency") >= threshold).groupBy("id", "item").agg(F.max_by(row, rank).alias("best"))
    return best.select(
        F.col("id").alias(id_col),
        F.col("item").alias("item_id"),
        "best.items",
        "best.windows",
        "best.matched",
        "best.containment",
        "best.start",
        "best.slots",
        "best.consistency",
        F.when(F.col("best.same"), "exact").otherwise("reworded").alias("kind"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; null ids stay."""
    found = find_contamination(docs.select(col(id_col), col(text_col)), benchmark, id_col, text_col, **how)
    return without(docs, stored(found.select(col(id_col)).distinct(), "contaminated"), id_col)

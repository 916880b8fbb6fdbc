"""Spelling variants: words one edit apart, found through pivotal bigrams, each led to its most frequent form.

Bigrams are ordered from rare to frequent. A word's prefix is its three first bigrams in that order; among them, dynamic
programming picks two that share no character and are rarest together, its pivots. One edit destroys one of two disjoint
bigrams at most, so of two words one edit apart, the one whose prefix ends earlier in the order has a pivot that stands in the other's
prefix, no more than one place away. Pivots are therefore looked up in an index of prefix bigrams, by bigram and place.

The lookup also says what has to be equal around the surviving bigram: an edit right of the left pivot leaves all to the left
of it alone, and half of what lies to the right; an edit left of the right pivot likewise. Bigram, place, the equal side and the equal half are
one 64-bit key of an equality join, so that a word meets few others however many share its bigram; the edit distance is then verified.

Words travel as rows, joins and minima only; a word's own rows (at most 5 x 2 x 4 in the index, 12 lookups) don't depend on the vocabulary.
All joins are merges by hint, as both sides grow with the vocabulary: Spark sizes a side by its compressed files, also after an explode that makes
many rows of each, and would else send millions of rows through the driver whenever the files are below the broadcast threshold.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .text import raw

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs this many times as often as the words it stands for.
RATIO = 5
#: One run in so many loses a character, chosen by its checksum: a known share of misspellings.
DAMAGED = 199
#: Bytes of text taken apart at a time; cuts lie between runs.
WINDOW = 4 << 20
#: Runs of more bytes get their checksum one by one.
LONG_RUN = 64

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to A-Z, a-z or U+00C0 to U+00FF; the latter are the two-byte signs that begin with C3."""
    lead = data == 0xC3
    out = _LETTER[data] | lead
    out[1:] |= lead[:-1]
    return out


def _checksums(data: np.ndarray, begin: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each run, continued from the checksum of what stands before it."""
    crc = ~state.astype(np.uint32)
    short = np.flatnonzero(size <= LONG_RUN)
    for j in range(LONG_RUN):
        short = short[size[short] > j]
        if not len(short):
            break
        now = crc[short]
        crc[short] = _CRC[(now ^ data[begin[short] + j]) & 0xFF] ^ now >> 8
    out = ~crc
    for i in np.flatnonzero(size > LONG_RUN):
        out[i] = zlib.crc32(data[begin[i]:begin[i] + size[i]].tobytes(), int(state[i]))
    return out


def _counted(data: np.ndarray, starts: np.ndarray, base: int, before: np.ndarray) -> pa.Array:
    """Value counts of the words in one window of bytes, which begins ``base`` bytes into the batch."""
    inside = letters(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = starts[(starts > base) & (starts < base + len(data))] - base
    first[cuts] |= inside[cuts]  # a text's first run doesn't continue the text before
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] |= inside[cuts - 1]
    begin, size = np.flatnonzero(first), np.flatnonzero(last) + 1
    size -= begin
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = points[begin + size] - points[begin]
    long = length >= MIN_LENGTH
    begin, size, length = begin[long], size[long], length[long]
    data = _LOWER[data]
    doc = np.searchsorted(starts, begin + base, "right") - 1
    crc = _checksums(data, begin, size, before[doc])
    hit = crc % DAMAGED == 0
    odd = []
    for b, s, n, h in zip(begin[hit], size[hit], length[hit], crc[hit]):
        run = data[b:b + s].tobytes().decode()
        at = int(h) % int(n)
        odd.append(run[:at] + run[at + 1:])
    begin, size = begin[~hit], size[~hit]
    keep = np.zeros(len(data) + 1, np.int8)
    keep[begin], keep[begin + size] = 1, -1  # runs that touch (texts side by side) end in the next one's start
    touching = np.flatnonzero(np.isin(begin + size, begin))
    keep[(begin + size)[touching]] = 0
    flat = data[np.cumsum(keep[:-1], dtype=np.int8) > 0]
    ends = np.concatenate([[0], np.cumsum(size)])
    plain = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat)))
    every = pa.concat_arrays([plain, pa.array([w for w in odd if len(w) >= MIN_LENGTH], pa.large_string())])
    return every.value_counts()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): every run's result of at least ``MIN_LENGTH`` code points and how often it occurs in all texts.

    A null text has no words; a null key reads as empty in the checksum; repeated rows count again. Texts are read whole, in windows.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = raw(pc.fill_null(batch.column(1), ""))
            before = np.array([zlib.crc32(k.encode() + b":") for k in batch.column(0).to_pylist()], np.uint32)
            lo = 0
            while lo < len(data):
                hi = min(lo + WINDOW, len(data))
                while hi < len(data) and len(gap := np.flatnonzero(~letters(data[hi - 1:hi + WINDOW])[1:])) == 0:
                    hi = min(hi + WINDOW, len(data))
                if hi < len(data):
                    hi += int(gap[0])
                found = _counted(data[lo:hi], starts[:-1], lo, before)
                lo = hi
                if len(found):
                    yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def disjoint_pair(grams: list[tuple[int, int]]) -> tuple[int, int]:
    """The places of the two bigrams (place, cost) without a common character whose costs add up to least; ties to the left.

    Dynamic programming along the places: the cheapest single bigram that ends before one begins is carried along.
    """
    grams = sorted(grams)
    best, single, j = None, None, 0
    for place, cost in grams:
        while grams[j][0] <= place - 2:
            if single is None or grams[j][1] < single[1]:
                single = grams[j]
            j += 1
        if single is not None and (best is None or single[1] + cost < best[0]):
            best = (single[1] + cost, single[0], place)
    return best[1], best[2]


def pivots(words: DataFrame, frequency: Mapping[str, int]) -> DataFrame:
    """(word, n, last, prefix, left, right): the order of the prefix's last bigram, the prefix bigrams' places, the pivots' places.

    The third bigram in the order closes the prefix; where its bigram occurs again, up to five bigrams belong to it, for
    an edit puts two new ones before a word's own at most.
    """
    order = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, prefix, left, right = [], [], [], []
            for word in batch.column(0).to_pylist():
                first = nsmallest(5, ((order[word[i:i + 2]], i) for i in range(len(word) - 1)))
                last.append(first[2][0])
                prefix.append([i for o, i in first if o <= first[2][0]])
                a, b = disjoint_pair([(i, frequency[word[i:i + 2]]) for _, i in first[:3]])
                left.append(a)
                right.append(b)
            more = [pa.array(last, pa.int32()), pa.array(prefix, pa.list_(pa.int32())), pa.array(left, pa.int32()), pa.array(right, pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *more], ["word", "n", "last", "prefix", "left", "right"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, last int, prefix array<int>, left int, right int")


def _key(equal: Column, rest: Column, side: Column, half: Column, other: Column, h: Column) -> Column:
    """Bigram with the equal side, and the equal half of the rest (its first or last ``h`` code points), in a word of ``other`` code points."""
    part = F.when(half == 0, F.substring(rest, F.lit(1), h)).otherwise(F.right(rest, h))
    return F.xxhash64(side, half, other, h, equal, part)


def candidates(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): words a with a pivot that stands in the prefix of another word b, with one side and half of the other equal.

    Holds every pair one edit apart, in one direction at least; a pair may come several times.
    """
    signs = F.split("word", "")
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.concat(F.element_at(signs, i), F.element_at(signs, i + 1)))).alias("gram"))
    # At most 90 x 90 bigrams: 26 + 64 letters.
    frequency = {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = staged(pivots(words, frequency)).withColumn("size", F.char_length("word"))
    sides = F.col("side")

    def around(df: DataFrame) -> DataFrame:
        """What an edit beyond the bigram leaves alone (with the bigram), and the side that the edit lies in. Side 0: the left is equal."""
        got = df.withColumns({
            "equal": F.when(sides == 0, F.substring("word", F.lit(1), F.col("at") + 2)).otherwise(F.substring("word", F.col("at") + 1, F.col("size"))),
            "rest": F.when(sides == 0, F.substring("word", F.col("at") + 3, F.col("size"))).otherwise(F.substring("word", F.lit(1), F.col("at")))})
        return got.withColumn("left_over", F.when(sides == 0, F.col("size") - F.col("at") - 2).otherwise(F.col("at")))

    halves = F.explode(F.array(F.lit(0), F.lit(1)))
    index = around(chosen.select("word", "n", "last", "size", F.explode("prefix").alias("at")).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))))
    index = index.withColumn("h", F.explode(F.array_distinct(F.array(F.expr("left_over div 2").cast("int"), F.expr("greatest(left_over - 1, 0) div 2").cast("int"))))).withColumn("half", halves)
    index = index.select(_key(F.col("equal"), F.col("rest"), sides, F.col("half"), F.col("size"), F.col("h")).alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("last").alias("last_b"))

    both = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("at")), F.struct(F.lit(1).alias("side"), F.col("right").alias("at"))))
    asked = around(chosen.select("word", "n", "last", "size", both.alias("p")).select("word", "n", "last", "size", "p.side", "p.at"))
    # The other word is one shorter, as long, or one longer.
    asked = asked.withColumn("longer", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).where("left_over >= longer").withColumn("half", halves)
    h = F.expr("least(left_over, left_over - longer) div 2").cast("int")
    asked = asked.select(_key(F.col("equal"), F.col("rest"), sides, F.col("half"), F.col("size") - F.col("longer"), h).alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"))

    met = asked.join(index.hint("merge"), "key").where((F.col("last_a") <= F.col("last_b")) & (F.col("a") != F.col("b")))
    return met.select("a", "n_a", "b", "n_b")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): pairs of words (a < b) that one inserted, deleted or replaced code point tells apart, each once."""
    met = candidates(words).where(F.levenshtein("a", "b", 1) == 1)  # part of the join's condition: only true pairs leave it
    swap = F.col("a") > F.col("b")
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"), F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from links (word, form): where following forms ends. Paths double each round.

    Counts grow fivefold along a path, so there is no circle and few rounds.
    """
    now = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        new = staged(now.join(step.hint("merge"), F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that occurs ``MIN_COUNT`` times or more.

    Its form is the near word of largest n (ties: smallest in code-point order) if that is ``RATIO`` times its own n; else null. Root: where forms
    lead from it, or itself. Nulls, empty texts and repeated rows as in ``word_counts``; an empty table gives no rows; other columns don't matter.
    """
    words = staged(word_counts(docs, key, text).where(F.col("n") >= MIN_COUNT))
    pairs = near_pairs(words)
    ends = F.array(F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("m")),
                   F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("m")))
    sides = pairs.select(F.explode(ends).alias("e")).select("e.*")
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near"))).alias("best"), F.max("n").alias("n"))
    most = -F.col("best.m")
    fits = most >= RATIO * F.col("n")
    near = staged(best.select("word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, most).alias("form_n")))
    led = roots(near.where("form is not null"))
    out = words.join(near.hint("merge"), "word", "left").join(led.hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")

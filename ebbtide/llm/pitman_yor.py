"""A hierarchical Pitman-Yor language model over words.

Restaurants: one for each two words that come before a word (the end token also stands before a text's first word); their parent is the restaurant of the
word before alone, whose parent is the root, whose base is the smoothed unigram. Restaurants and dishes (a word in a context, with a count) grow with the corpus.

Layout: words get numbers, frequent ones small numbers. Everything behind one middle word v (all contexts u v, and v alone) lies in one bucket, so all totals
of these restaurants are at hand there. A middle word with more than half a bucket's tokens is shared: its contexts u v go to several buckets by u, and its own
restaurant is held where its dishes' words are. The root is held in parts by word. In each sweep a bucket tells the parts its tables, and each part answers with the
root's customers and tables of the bucket's words, and with those of the shared restaurants' dishes. Only the totals of the root and of the shared
restaurants (at most ``SHARED``) reach the driver.

Seating: given the sweep before's parents and totals, the tables of one dish are drawn in one block from their conditional,
p(t) ~ S_d(c, t) a^t, with S_d the generalised Stirling numbers and a the weight of a new table (concentration plus discount times tables, times the
parent's probability); the tables drawn are the customers of the parent, and so up to the root. Dishes with more than ``EXACT`` customers use the
conditional's limit for many customers (one table plus a Poisson number). Draws are
seeded by bucket and sweep, so a task that runs again draws the same. A sweep leaves the tables of dishes that could have several; predictive probabilities are averaged over the last sweeps,
each with its own sweep's totals, under which they sum to one.

Traffic: documents are held in chunks of coded words. A chunk sends each bucket its distinct (context, word) entries once and gets each
entry's probability back; tokens never travel one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .text import coded, mixed, ranges, raw, segment_sums, string_hashes, words

#: Discount and concentration of the root, of the restaurants of one word, and of those of two.
DISCOUNT, CONCENTRATION = (0.5, 0.7, 0.8), (1.0, 1.0, 1.0)
SWEEPS, KEPT_SWEEPS = 3, 2
#: Customers of a dish up to which its tables are drawn from the exact conditional.
EXACT = 192
CHUNK_TOKENS = 3_000_000
#: Entries sent to a bucket, about.
BUCKET_ENTRIES = 1_500_000
#: Middle words shared between buckets, at most; any other word has at most this part of all tokens.
SHARED = 4096
#: The hash of the end token; no word's bytes are hashed to it but by chance (1 in 2^64).
END_HASH = np.uint64(0x0E0D0E0D0E0D0E0D)
#: Buckets to a part of the root.
ROOT_SHARE = 8
#: Tokens of a chunk whose entries are looked for at once, about.
GROUP_TOKENS = 1_000_000
#: Bytes of text behind a partition of chunks, about.
PARTITION_BYTES = 16_000_000
CHUNK = "chunk long, doc_ids array<long>, sizes binary, held binary, end long, stream binary, words binary, total binary, train binary"
ASKED = "bucket int, chunk long, group int, v binary, u binary, fan binary, words binary, seen binary"
FOUND = "bucket int, v binary, u binary, fan binary, words binary, word binary, seen binary"


_shrink, _grow = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(x: np.ndarray) -> bytes:
    """An array of numbers from 0 on, as few bytes each as the largest needs, byte planes apart and compressed; floats keep theirs."""
    if x.dtype.kind != "f":
        x = x.astype(np.min_scalar_type(x.max() if len(x) else 0))
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T)
    return x.dtype.str.encode()[1:] + _shrink.compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    """What was packed, numbers as 64-bit integers (hashes keep their bits)."""
    kind = np.dtype(data[:2].decode())
    planes = np.frombuffer(_grow.decompress(data[2:]), np.uint8)
    out = np.ascontiguousarray(planes.reshape(kind.itemsize, len(planes) // kind.itemsize).T).reshape(-1).view(kind)
    return out if kind.kind == "f" else out.astype(np.int64)


def steps(x: np.ndarray) -> np.ndarray:
    """Ascending numbers as the first and the differences."""
    return np.diff(x, prepend=0)


def _same(key: int) -> int:
    return key


def _spread(key: int) -> int:
    """The place of a chunk, or of a range of hashes (below 2^32)."""
    return (key >> 32) + (key & 0xFFFFFFFF) * 7919 if key >> 32 else key


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, ascending, each key's place among them in 32 bits)."""
    most = int(keys.max()) if len(keys) else 0
    if keys.dtype == np.int64 and most < 4 * len(keys):  # words' numbers lie close together
        seen = np.zeros(most + 1, bool)
        seen[keys] = True
        return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - np.int32(1))[keys]
    order = np.argsort(keys)
    first = np.empty(len(keys), bool)
    if len(keys):
        ordered = keys[order]
        first[:1] = True
        np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
        values = ordered[first]
        del ordered
    else:
        values = keys
    at = np.empty(len(keys), np.int32)
    at[order] = np.cumsum(first, dtype=np.int32) - np.int32(1)
    return values, at


def held_out(doc_id: str) -> Column:
    """Whether a row is never learned from: the CRC-32 of its id's digits leaves no remainder by 10; rows without an id are learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _coded_batch(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of distinct words, each token's place among them, tokens per text); the end token comes last among the words."""
    flat, ends = words(texts, lower=True)
    own, ids = coded(flat)
    n = len(ends) - 1
    stream = np.full(len(ids) + n, len(own), np.int32)
    keep = np.ones(len(stream), bool)
    keep[ends[1:] + np.arange(n)] = False
    stream[keep] = ids
    return np.append(string_hashes(*raw(own)), END_HASH), stream, np.diff(ends) + 1


def chunk_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> RDD:
    """Documents as chunks of coded words, with the words' hashes and how often they occur, in all rows and in those to learn from."""

    def run(partition: int, rows: Iterator) -> Iterator[tuple]:
        number = (1 + partition) << 32
        parts, waiting = [], 0

        def flush():
            nonlocal parts, waiting, number
            hashes, place = distinct(np.concatenate([p[0] for p in parts]))
            streams, at = [], 0
            for p in parts:
                streams.append(place[at:at + len(p[0])][p[1]])
                at += len(p[0])
            stream, sizes, held = np.concatenate(streams), np.concatenate([p[2] for p in parts]), np.concatenate([p[4] for p in parts])
            total, train = np.bincount(stream, minlength=len(hashes)), np.bincount(stream[~np.repeat(held, sizes)], minlength=len(hashes))
            row = number, [x for p in parts for x in p[3]], packed(sizes), packed(held.astype("u1")), int(np.searchsorted(hashes, END_HASH)), packed(stream), packed(hashes), packed(total), packed(train)
            number, parts, waiting = number + 1, [], 0
            pa.default_memory_pool().release_unused()
            return row

        while some := list(islice(rows, 1000)):
            got = _coded_batch(pa.array([r[1] for r in some], pa.large_string()))
            parts.append((*got, [r[0] for r in some], np.array([r[2] for r in some], bool)))
            waiting += len(got[1])
            if waiting >= CHUNK_TOKENS:
                yield flush()
        if parts:
            yield flush()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out(key).alias("held")).rdd.mapPartitionsWithIndex(run)


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``chunk_rows`` as a table."""
    return docs.sparkSession.createDataFrame(chunk_rows(docs, key, text), CHUNK, verifySchema=False)


@dataclass
class Numbered:
    """Chunks, and for each the numbers and training counts of its words, both by chunk; the number of tokens, and middle words that are shared."""

    chunks: RDD
    ids: RDD
    tokens: int
    shared: np.ndarray  # numbers, ascending
    several: np.ndarray  # the buckets each goes to
    group: int  # GROUP_TOKENS

    @property
    def parts(self) -> int:
        return self.chunks.getNumPartitions()

    def with_ids(self, *more: RDD) -> RDD:
        """Chunks and what belongs to them side by side; all are laid out alike, so nothing is sent again."""
        return self.chunks.context.union([self.chunks, self.ids, *more])


def numbered(kept: RDD, parts: int = 1) -> Numbered:
    """Words' numbers: a range of hashes ranks its words by count, ranges take turns. Equal words get one number, whatever chunk they are in."""
    edges = _edges(parts)

    def apart(row):
        chunk, *payload, hashes, total, train = row
        yield chunk, ("chunk", tuple(payload))
        w, *counts = unpacked(hashes).astype(np.uint64), unpacked(total), unpacked(train)
        at = [0, *np.searchsorted(w, edges).tolist(), len(w)]
        for k in range(parts):
            if at[k] < at[k + 1]:
                yield k, ("words", chunk, *(packed(x[at[k]:at[k + 1]]) for x in (w, *counts)))

    def slices(rows):
        return grouped((k, r[1:]) for k, r in rows if r[0] == "words").items()

    def ranked(k: int, rows: list) -> tuple:
        got = [(chunk, *(unpacked(x) for x in xs)) for chunk, *xs in rows]
        w, place = distinct(np.concatenate([g[1].astype(np.uint64) for g in got]))
        total, train = (np.bincount(place, np.concatenate([g[c] for g in got]), len(w)).astype(np.int64) for c in (2, 3))
        ids = np.empty(len(w), np.int64)
        ids[np.argsort(-total, kind="stable")] = np.arange(len(w)) * parts + k
        return ids, total, train, place, got

    def replies(rows):
        for k, own in slices(rows):
            ids, _, train, place, got = ranked(k, own)
            at = 0
            for chunk, w, *_ in got:
                own = place[at:at + len(w)]
                at += len(w)
                yield chunk, ("ids", k, packed(ids[own]), packed(train[own]))

    def counts(rows):
        for k, own in slices(rows):
            ids, total, *_ = ranked(k, own)
            top = np.argsort(-total, kind="stable")[:SHARED]
            top = top[total[top] > BUCKET_ENTRIES // 2]
            yield int(total.sum()), list(zip(ids[top].tolist(), total[top].tolist(), strict=True))

    laid = kept.flatMap(apart).partitionBy(parts, _spread)
    got = laid.mapPartitions(counts).collect()
    tokens = sum(n for n, _ in got)
    most = sorted((i, n) for _, top in got for i, n in top if n * SHARED > tokens)
    return Numbered(laid, laid.mapPartitions(replies).partitionBy(laid.getNumPartitions(), _spread), tokens, np.array([i for i, _ in most], np.int64), np.array([-(-n // max(1, BUCKET_ENTRIES // 2)) for _, n in most], np.int64), GROUP_TOKENS)


def _edges(parts: int) -> np.ndarray:
    return np.array([(1 << 64) * k // parts for k in range(1, parts)], np.uint64)


def grouped(rows: Iterable) -> dict:
    out = {}
    for k, v in rows:
        out.setdefault(k, []).append(v)
    return out


def by_chunk(rows: Iterable) -> Iterator[tuple]:
    """(chunk, its payload, its words' numbers and training counts, what else came) of each chunk of a partition."""
    for chunk, own in grouped((k, r) for k, r in rows if r[0] != "words").items():
        got = sorted((r for r in own if r[0] == "ids"), key=lambda r: r[1])
        ids, train = (np.concatenate([unpacked(r[c]) for r in got]) for c in (2, 3))
        yield chunk, next(r[1] for r in own if r[0] == "chunk"), ids, train, [r for r in own if r[0] == "p"]


def entries_of(pair: np.ndarray, third: np.ndarray, pairs: int, thirds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs, how many distinct thirds each has, these thirds, each given entry's place among them), in ascending order."""
    if pairs * thirds < 1 << 62:
        keys, at = distinct(pair * np.int64(thirds) + third)
        own = keys // thirds
        begin = np.flatnonzero(np.diff(own, prepend=-1))
        return own[begin], np.diff(np.append(begin, len(own))), (keys - own * thirds).astype(np.int32), at
    values, at = distinct(pair)
    keys, at = distinct(at * np.int64(thirds) + third)
    return values, np.bincount(keys // thirds, minlength=len(values)), (keys % thirds).astype(np.int32), at


def placed(number: np.ndarray, parts: int) -> np.ndarray:
    """Where rows of part 0 stand, then those of part 1 and so on, in their order."""
    return np.argsort(number.astype(np.uint16) if parts <= 1 << 16 else number, kind="stable")


class Chunk:
    """A chunk's tokens, each with the two words before it in its text, in groups by the word before."""

    def __init__(self, payload: tuple, ids: np.ndarray):
        _, sizes, held, end, stream = payload
        self.sizes, self.held = unpacked(sizes), unpacked(held).astype(bool)
        order = np.argsort(ids)
        self.numbers = ids[order]
        rank = np.empty(len(ids), np.int32)
        rank[order] = np.arange(len(ids), dtype=np.int32)
        self.stream = unpacked(stream).astype(np.int32)
        self.word, end = rank[self.stream], rank[end]
        begin = np.cumsum(self.sizes) - self.sizes
        self.v = np.roll(self.word, 1)
        self.v[begin] = end
        self.u = np.roll(self.v, 1)
        self.u[begin] = end

    def groups(self, number: Numbered, buckets: int) -> Iterator[Entries]:
        upto = np.cumsum(np.bincount(self.v, minlength=len(self.numbers)))
        group = ((upto - 1) // number.group).astype(np.int32)[self.v]
        for k in range(int(group.max()) + 1):
            rows = np.flatnonzero(group == k).astype(np.int32)
            if len(rows):
                yield Entries(self, rows, number, buckets)


class Entries:
    """The distinct (middle word, word before it, word) entries of a chunk's tokens ``rows``, by bucket and then by these words' numbers."""

    def __init__(self, chunk: Chunk, rows: np.ndarray, number: Numbered, buckets: int):
        n, self.numbers, self.rows = len(chunk.numbers), chunk.numbers, rows
        pairs, fan, word, self.at = entries_of(chunk.v[rows] * np.int64(n) + chunk.u[rows], chunk.word[rows], n * n, n)
        v, u = self.numbers[pairs // n], self.numbers[pairs % n]
        bucket = bucket_of(v, u, number, buckets)
        order = placed(bucket, buckets)
        self.order = ranges((np.cumsum(fan) - fan)[order], fan[order])
        self.v, self.u, self.fan, self.word = v[order], u[order], fan[order], word[self.order]
        self.pairs_at = np.searchsorted(bucket[order], np.arange(buckets + 1))
        self.at_entry = np.concatenate([[0], np.cumsum(self.fan)])[self.pairs_at]

    def messages(self, learn: np.ndarray) -> Iterator[tuple[int, tuple]]:
        """For each bucket its contexts, words, and how often they occur in tokens to learn from."""
        seen = np.bincount(self.at[learn[self.rows]], minlength=len(self.order))[self.order]
        for k in np.flatnonzero(np.diff(self.pairs_at)).tolist():
            c, w = slice(*self.pairs_at[k:k + 2]), slice(*self.at_entry[k:k + 2])
            yield k, (packed(steps(self.v[c])), packed(self.u[c]), packed(self.fan[c]), packed(self.numbers[self.word[w]]), packed(seen[w]))


def bucket_of(v: np.ndarray, u: np.ndarray, number: Numbered, buckets: int) -> np.ndarray:
    """Middle words' buckets; contexts of a shared one go to several by the word before it."""
    at, hit = find(number.shared, v)
    several = np.where(hit, np.append(number.several, 1)[at], 1).astype(np.uint64)
    return ((mixed(v.astype(np.uint64)) % np.uint64(buckets) + mixed(mixed(u.astype(np.uint64)) + np.uint64(1)) % several) % np.uint64(buckets)).astype(np.int64)


def asked_of(number: Numbered, buckets: int) -> RDD:
    """(bucket, ("ask", (chunk, group, v, u, fan, words, seen))): what each chunk has for each bucket."""
    light = replace(number, chunks=None, ids=None)

    def run(rows):
        for chunk, payload, ids, *_ in by_chunk(rows):
            tokens = Chunk(payload, ids)
            learn = ~np.repeat(tokens.held, tokens.sizes)
            for i, e in enumerate(tokens.groups(light, buckets)):
                yield from ((k, ("ask", (chunk, i, *what))) for k, what in e.messages(learn))
                del e
            del tokens, learn

    return number.with_ids().mapPartitions(run)


def requests(kept: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, group, v, u, fan, words, seen): what each chunk has for each bucket."""
    return kept.sparkSession.createDataFrame(asked_of(numbered(kept.rdd, kept.rdd.getNumPartitions() or 1), buckets).map(lambda r: (r[0], *r[1][1])), ASKED, verifySchema=False)


def merged(asks: list[tuple]) -> tuple[tuple, np.ndarray]:
    """(a bucket's contexts, words, and entries with their training counts, ordered by number; each request's entries' places among them)."""
    got = [[unpacked(x) for x in a[2:]] for a in asks]
    fan = np.concatenate([g[2] for g in got])
    vs, v = distinct(np.concatenate([np.cumsum(g[0]) for g in got]))
    us, u = distinct(np.concatenate([g[1] for g in got]))
    words, w = distinct(np.concatenate([g[3] for g in got]))
    contexts, fan, word, at = entries_of(np.repeat(v * np.int64(len(us)) + u, fan), w, len(vs) * len(us), len(words))
    seen = np.bincount(at, np.concatenate([g[4] for g in got]), len(word)).astype(np.int64)
    return (vs[contexts // len(us)], us[contexts % len(us)], fan, words, word.astype(np.int64), seen), at


def dishes_of(asked: RDD) -> RDD:
    """One row per bucket, from requests laid out by bucket."""

    def run(rows):
        for k, own in by_bucket(rows, "ask"):
            v, u, fan, words, word, seen = merged([r[1] for r in own])[0]
            yield k, ("found", *(packed(x) for x in (steps(v), u, fan, steps(words), word, seen)))

    return asked.mapPartitions(run, preservesPartitioning=True)


def dishes(asked: DataFrame) -> DataFrame:
    """One row per bucket: its contexts, the words asked for in them and how often they were seen in rows to learn from."""
    rows = asked.rdd.map(lambda r: (r[0], ("ask", tuple(r)[1:]))).partitionBy(asked.rdd.getNumPartitions() or 1, _same)
    return asked.sparkSession.createDataFrame(dishes_of(rows).map(lambda r: (r[0], *r[1][1:])), FOUND, verifySchema=False)


_stirling: dict[float, np.ndarray] = {}


def log_stirling(d: float, n: int = EXACT) -> np.ndarray:
    """log S_d(c, t) for c and t up to n: the total weight of all seatings of c customers at t tables, new tables' weights aside."""
    if (d, n) not in _stirling:
        out = np.full((n + 1, n + 1), -np.inf)
        out[1, 1] = 0.0
        t = np.arange(n + 1)
        for c in range(1, n):
            stay = out[c] + np.log(np.maximum(c - t * d, 1e-300))
            stay[t > c] = -np.inf
            out[c + 1] = np.logaddexp(stay, np.concatenate([[-np.inf], out[c, :-1]]))
        _stirling[(d, n)] = out
    return _stirling[(d, n)]


def draw_tables(count: np.ndarray, weight: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """A number of tables for each dish of ``count`` customers, where a new table weighs ``weight``."""
    out = np.ones(len(count), np.int64)
    u = rng.random(len(count))
    many = np.flatnonzero(count > EXACT)
    if len(many):
        mean = np.minimum(weight[many] / d, weight[many] * np.log1p(count[many] / weight[many]))
        out[many] = np.minimum(1 + rng.poisson(mean), count[many])
    table = log_stirling(d)
    some = np.flatnonzero((count > 1) & (count <= EXACT))
    some = some[np.argsort(count[some], kind="stable")]
    sizes, first = np.unique(count[some], return_index=True)
    for c, lo, hi in zip(sizes.tolist(), first.tolist(), np.append(first, len(some))[1:].tolist(), strict=True):
        for at in range(lo, hi, 100_000):
            rows = some[at:min(hi, at + 100_000)]
            logits = table[c, 1:c + 1] + np.log(weight[rows])[:, None] * np.arange(1, c + 1)
            p = np.exp(logits - logits.max(1, keepdims=True)).cumsum(1)
            out[rows] = 1 + (p < u[rows][:, None] * p[:, -1:]).sum(1)
    return out


def drawn(count: np.ndarray, weight: Callable[[np.ndarray], np.ndarray], d: float, rng: np.random.Generator) -> np.ndarray:
    """As ``draw_tables``, where ``weight`` gives the weights at places; dishes of one customer have one table, of none none."""
    out = (count > 0).astype(np.int64)
    some = np.flatnonzero(count > 1)
    out[some] = draw_tables(count[some], weight(some), d, rng)
    return out


def summed(at: np.ndarray, what: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, what, n).astype(np.int64) if len(at) else np.zeros(n, np.int64)


@dataclass
class Bucket:
    """The seating of a bucket's contexts of two words and of their middle words; of the root and of shared middle words what their parts last told."""

    hashes: np.ndarray  # the words' numbers
    v: np.ndarray  # of each context
    ctx: np.ndarray  # of each dish
    word: np.ndarray
    count: np.ndarray
    number: int
    shared: np.ndarray

    def __post_init__(self):
        n = len(self.hashes)
        self.middles, self.middle_of = distinct(self.v)
        self.pair, self.up = distinct(self.middle_of[self.ctx] * np.int64(n) + self.word)
        self.pair_v, self.pair_word = self.pair // n, self.pair % n
        at, hit = find(self.shared, self.middles)
        self.shared_at, self.is_shared = np.where(hit, at, 0), hit
        self.told = np.flatnonzero(hit[self.pair_v])
        self.kept = np.flatnonzero(~hit[self.pair_v])
        self.c2 = summed(self.ctx, self.count, len(self.v))
        self.own_count = self.of_word = summed(self.word, self.count, n)
        self.t2 = (self.count > 0).astype(np.int64)
        self.m0 = self.t0 = np.zeros(n, np.int64)
        self._customers()
        self.t1 = (self.m1 > 0).astype(np.int64)

    def _customers(self) -> None:
        self.own_m1 = summed(self.up, self.t2, len(self.pair))
        self.m1 = self.own_m1.copy()

    def sweep(self, number: int, totals: np.ndarray, base: np.ndarray) -> None:
        """Draw this bucket's tables anew, those of two words before first, given the sweep before's parents and totals."""
        rng = np.random.default_rng([97, self.number, number])
        p0, p1 = self.parents(totals, base)
        _, t1 = self._of_middles(totals)
        tables = summed(self.ctx, self.t2, len(self.v))
        self.t2 = drawn(self.count, lambda at: (CONCENTRATION[2] + DISCOUNT[2] * tables[self.ctx[at]]) * p1[self.up[at]], DISCOUNT[2], rng)
        self._customers()
        self.t1 = drawn(np.where(self.is_shared[self.pair_v], 0, self.m1), lambda at: (CONCENTRATION[1] + DISCOUNT[1] * t1[self.pair_v[at]]) * p0[self.pair_word[at]], DISCOUNT[1], rng)

    def state(self) -> tuple[bytes, bytes]:
        """The tables drawn here, of dishes that could have several."""
        return packed(self.t2[self.count > 1]), packed(self.t1[self._open()])

    def back_at(self, state: tuple[bytes, bytes]) -> None:
        self.t2 = (self.count > 0).astype(np.int64)
        self.t2[self.count > 1] = unpacked(state[0])
        self._customers()
        self.t1 = (self.m1 > 0).astype(np.int64)
        self.t1[self._open()] = unpacked(state[1])

    def _open(self) -> np.ndarray:
        return (self.m1 > 1) & ~self.is_shared[self.pair_v]

    def tells(self, parts: int) -> Iterator[tuple[int, tuple]]:
        """For each part of the root its words here, their tables here in restaurants of one word, and what a shared restaurant's dishes get from here."""
        part = (mixed(self.hashes.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        tables = summed(self.pair_word[self.kept], self.t1[self.kept], len(self.hashes))
        for k, w, rows in self._by_part(part, parts):
            place = np.searchsorted(w, self.pair_word[rows])
            yield k, (self.number, *(packed(x) for x in (steps(self.hashes[w]), tables[w], self.own_count[w], self.m0[w], self.t0[w], self.shared_at[self.pair_v[rows]], place, self.own_m1[rows])))

    def hears(self, parts: int, told: dict[int, tuple]) -> None:
        """Take over what the parts of the root told of this bucket's words and shared dishes."""
        part = (mixed(self.hashes.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        self.m0, self.t0, self.of_word = (np.zeros(len(self.hashes), np.int64) for _ in range(3))
        self.m1, self.t1 = self.m1.copy(), self.t1.copy()
        for k, w, rows in self._by_part(part, parts):
            self.m0[w], self.t0[w], self.of_word[w], self.m1[rows], self.t1[rows] = (unpacked(x) for x in told[k])

    def _by_part(self, part: np.ndarray, parts: int) -> Iterator[tuple]:
        words, rows = placed(part, parts), self.told[placed(part[self.pair_word[self.told]], parts)]
        a, b = (np.searchsorted(x, np.arange(parts + 1)) for x in (part[words], part[self.pair_word[rows]]))
        for k in np.flatnonzero(np.diff(a)).tolist():
            yield k, words[a[k]:a[k + 1]], rows[b[k]:b[k + 1]]

    def _of_middles(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of the restaurants of one word."""
        n = len(self.shared)
        c1, t1 = (summed(self.pair_v, x, len(self.middles)) for x in (self.m1, self.t1))
        if n:
            c1, t1 = (np.where(self.is_shared, x, y) for x, y in ((totals[:n][self.shared_at], c1), (totals[n:2 * n][self.shared_at], t1)))
        return c1, t1

    def parents(self, totals: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's probability at the root, and each (middle word, word)'s at its restaurant."""
        p0 = at_root(self.m0, self.t0, totals, base)
        c1, t1 = self._of_middles(totals)
        rest = (CONCENTRATION[1] + DISCOUNT[1] * t1) / (CONCENTRATION[1] + c1)
        return p0, (self.m1 - DISCOUNT[1] * self.t1) / (CONCENTRATION[1] + c1)[self.pair_v] + rest[self.pair_v] * p0[self.pair_word]

    def predict(self, word: np.ndarray, ctx: np.ndarray, totals: np.ndarray, base: np.ndarray, unknown: float) -> np.ndarray:
        """Probabilities of words (place, -1: unknown) in contexts (place; beyond the last: two words never met)."""
        p0, p1 = self.parents(totals, base)
        root = np.append(p0, at_root(0, 0, totals, unknown))[word]
        c1, t1 = self._of_middles(totals)
        rest1 = (CONCENTRATION[1] + DISCOUNT[1] * t1) / (CONCENTRATION[1] + c1)
        n, known = len(self.hashes), ctx < len(self.v)
        ctx = np.where(known, ctx, 0)
        at, hit = find(self.pair, np.where(word >= 0, self.middle_of[ctx] * np.int64(n) + word, -1))
        middle = np.where(known, np.where(hit, np.append(p1, 0)[at], rest1[self.middle_of[ctx]] * root), root)
        rest2 = (CONCENTRATION[2] + DISCOUNT[2] * summed(self.ctx, self.t2, len(self.v))) / (CONCENTRATION[2] + self.c2)
        at, hit = find(self.ctx * n + self.word, np.where(word >= 0, ctx * n + word, -1))
        own = np.append((self.count - DISCOUNT[2] * self.t2) / (CONCENTRATION[2] + self.c2[self.ctx]), 0)
        return np.where(known, np.where(hit, own[at], 0) + rest2[ctx] * middle, root)

    def entries(self, totals: np.ndarray, base: np.ndarray) -> np.ndarray:
        """The probability of every entry: what ``predict`` says of each word in its context."""
        _, p1 = self.parents(totals, base)
        c2, t2 = self.c2[self.ctx], summed(self.ctx, self.t2, len(self.v))[self.ctx]
        return (self.count - DISCOUNT[2] * self.t2 + (CONCENTRATION[2] + DISCOUNT[2] * t2) * p1[self.up]) / (CONCENTRATION[2] + c2)


def at_root(m, t, totals: np.ndarray, base):
    """Probability at the root of a word with ``m`` customers at ``t`` tables there."""
    return (m - DISCOUNT[0] * t + (CONCENTRATION[0] + DISCOUNT[0] * totals[-1]) * base) / (CONCENTRATION[0] + totals[-2])


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each wanted value among the sorted keys, whether it is there)."""
    at = np.searchsorted(keys, wanted)
    if not len(keys):
        return at, np.zeros(len(wanted), bool)
    return at, keys[np.minimum(at, len(keys) - 1)] == wanted


@dataclass
class Model:
    """What all tasks need: per sweep the totals of shared restaurants (customers, tables), training tokens and words, and the root's customers and tables."""

    parts: int
    shared: np.ndarray
    history: list[np.ndarray] = field(default_factory=list)

    @property
    def tokens(self) -> int:
        return int(self.history[0][-4])

    @property
    def words(self) -> int:
        return int(self.history[0][-3])

    @property
    def unknown(self) -> float:
        return 0.1 / (self.tokens + 0.1 * (self.words + 1))

    def base(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.1) / (self.tokens + 0.1 * (self.words + 1))

    def bucket(self, row: dict) -> Bucket:
        v, u, fan, words, word, seen = (unpacked(row[c]) for c in ROW)
        return self.seated((np.cumsum(v), u, fan, np.cumsum(words), word, seen), row["bucket"])

    def seated(self, found: tuple, number: int) -> Bucket:
        """A bucket of ``merged`` requests before the first sweep."""
        v, _, fan, words, word, seen = found
        return Bucket(words, v, np.repeat(np.arange(len(fan)), fan), word, seen, number, self.shared)

    def root(self, part: int, tells: list[tuple], s: int) -> tuple[np.ndarray, list[tuple]]:
        """A part of the root in sweep ``s``: (its share of the totals, what it tells each bucket)."""
        n = len(self.shared)
        tells = sorted(tells, key=lambda t: t[0])
        if not tells:
            return np.zeros(2 * n + 4, np.int64), []
        got = [[unpacked(x) for x in t[1:]] for t in tells]
        words, place = np.unique(np.concatenate([np.cumsum(g[0]) for g in got]), return_inverse=True)
        from_buckets, count = (summed(place, np.concatenate([g[c] for g in got]), len(words)) for c in (1, 2))
        m0, t0 = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        m0[place], t0[place] = (np.concatenate([g[c] for g in got]) for c in (3, 4))
        begin = np.cumsum([0, *(len(g[0]) for g in got)])
        keys, at = np.unique(np.concatenate([g[5] * len(words) + place[b:][g[6]] for g, b in zip(got, begin)]), return_inverse=True)
        v, w = keys // len(words), keys % len(words)
        m1 = summed(at, np.concatenate([g[7] for g in got]), len(keys))
        if s:
            rng, totals, base = np.random.default_rng([98, part, s]), self.history[s - 1], self.base(count)
            before = at_root(m0, t0, totals, base)
            t1 = drawn(m1, lambda at: (CONCENTRATION[1] + DISCOUNT[1] * totals[n:2 * n][v[at]]) * before[w[at]], DISCOUNT[1], rng)
            m0 = from_buckets + summed(w, t1, len(words))
            t0 = drawn(m0, lambda at: (CONCENTRATION[0] + DISCOUNT[0] * totals[-1]) * base[at], DISCOUNT[0], rng)
        else:
            t1 = (m1 > 0).astype(np.int64)
            m0 = from_buckets + summed(w, t1, len(words))
            t0 = (m0 > 0).astype(np.int64)
        told, shared_at = [], np.cumsum([0, *(len(g[5]) for g in got)])
        for i, t in enumerate(tells):
            own, rows = place[begin[i]:begin[i + 1]], at[shared_at[i]:shared_at[i + 1]]
            told.append((t[0], tuple(packed(x) for x in (m0[own], t0[own], count[own], m1[rows], t1[rows]))))
        return np.concatenate([summed(v, m1, n), summed(v, t1, n), [count.sum(), (count > 0).sum(), m0.sum(), t0.sum()]]), told

    def replay(self, bucket: Bucket, sweeps: int):
        """Sweep by sweep from the first, for a bucket that is all there is; yields the number of the sweep done."""
        for s in range(sweeps + 1):
            if s:
                bucket.sweep(s, self.history[s - 1], self.base(bucket.of_word))
            bucket.hears(self.parts, {k: self.root(k, [t], s)[1][0][1] for k, t in bucket.tells(self.parts)})
            yield s

    def back(self, bucket: Bucket, rows: list[tuple], s: int) -> None:
        """Put a bucket back where sweep ``s`` left it and its root."""
        bucket.back_at(next(r[2] for r in rows if r[0] == "state" and r[1] == s))
        bucket.hears(self.parts, {r[2]: r[3] for r in rows if r[0] == "told" and r[1] == s})


ROW = "v", "u", "fan", "words", "word", "seen"


def by_bucket(rows: Iterable, *kinds: str) -> Iterator[tuple[int, list]]:
    return iter(grouped((k, r) for k, r in rows if r[0] in kinds).items())


def learned(found: RDD, shared: np.ndarray, sweeps: int) -> tuple[Model, list[RDD]]:
    """(totals of every sweep, what it left and the root told each bucket) from buckets, or requests to them, laid out by number. Of all this only the totals reach the driver."""
    parts = found.getNumPartitions()
    model, left = Model(-(-parts // ROOT_SHARE), shared), []
    for s in range(sweeps + 1):
        now = replace(model, history=list(model.history))

        def up(rows, s=s, now=now):
            for k, own in by_bucket(rows, "found", "ask", "state", "told"):
                if asks := [r[1] for r in own if r[0] == "ask"]:
                    bucket = now.seated(merged(asks)[0], k)
                else:
                    bucket = now.bucket(dict(zip(ROW, next(r for r in own if r[0] == "found")[1:]), bucket=k))
                if s:
                    now.back(bucket, own, s - 1)
                    bucket.sweep(s, now.history[s - 1], now.base(bucket.of_word))
                yield k, ("state", s, bucket.state())
                for part, what in bucket.tells(now.parts):
                    yield part * ROOT_SHARE, ("tells", what)

        def root(rows, s=s, now=now):
            for k, own in by_bucket(rows, "tells"):
                yield k // ROOT_SHARE, now.root(k // ROOT_SHARE, [r[1] for r in own], s)

        def down(rows, s=s, root=root):
            for k, (_, told) in root(rows):
                for bucket, what in told:
                    yield bucket, ("told", s, k, what)

        ups = found.context.union([found, *left[-2:]]).mapPartitions(up).partitionBy(parts, _same)
        model.history.append(ups.mapPartitions(root).map(lambda r: r[1][0]).treeAggregate(np.zeros(2 * len(shared) + 4, np.int64), np.add, np.add))
        left += [ups, ups.mapPartitions(down).partitionBy(parts, _same)]
    return model, left


def fit(found: DataFrame, sweeps: int = SWEEPS) -> Model:
    """Totals of every sweep, without shared restaurants."""
    rows = found.rdd.map(lambda r: (r[0], ("found", *tuple(r)[1:]))).partitionBy(found.rdd.getNumPartitions() or 1, _same)
    return learned(rows, np.zeros(0, np.int64), sweeps)[0]


def answers(asked: RDD, left: list[RDD], model: Model) -> RDD:
    """(chunk, ("p", group, bucket, p)): for each chunk's entries in a bucket their log10 probabilities, as 32-bit floats."""
    last = len(model.history) - 1
    kept = range(max(0, last + 1 - KEPT_SWEEPS), last + 1)

    def run(rows):
        for k, own in by_bucket(rows, "ask", "state", "told"):
            asks = [r[1] for r in own if r[0] == "ask"]
            found, at = merged(asks)
            bucket, p = model.seated(found, k), 0
            for s in kept:
                model.back(bucket, own, s)
                p = p + bucket.entries(model.history[s], model.base(bucket.of_word))
            p, begin = np.log10(p / len(kept)).astype("<f4"), 0
            del bucket, found
            for ask in asks:
                n = len(unpacked(ask[5]))
                yield ask[0], ("p", ask[1], k, packed(p[at[begin:begin + n]]))
                begin += n

    return asked.context.union([asked, *left[2 * kept[0]:]]).mapPartitions(run)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", sweeps: int = SWEEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, learned from the rows not held out.

    Texts are lower-cased (A-Z); a null text is empty: its one token is the end. Rows of equal id are rows of their own. Without any row to
    learn from every token is unknown and has probability 1.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    number = numbered(chunk_rows(docs, key, text), max(8, -(-size // PARTITION_BYTES)))
    buckets = max(8, -(-number.tokens // BUCKET_ENTRIES))
    asked = asked_of(number, buckets).partitionBy(buckets, _same)
    model, left = learned(asked, number.shared, sweeps)
    replies = answers(asked, left, model).partitionBy(number.parts, _spread)
    light, tokens, vocabulary = replace(number, chunks=None, ids=None), model.tokens, model.words

    def run(rows):
        for _, payload, ids, train, replies in by_chunk(rows):
            c = Chunk(payload, ids)
            logs = np.empty(len(c.stream))
            told = {i: [] for i in {r[1] for r in replies}}
            for r in sorted(replies, key=lambda r: r[2]):
                told[r[1]].append(r[3])
            for i, e in enumerate(c.groups(light, buckets)):
                p = np.empty(len(e.order), np.float32)
                p[e.order] = np.concatenate([unpacked(x) for x in told[i]])
                logs[e.rows] = p[e.at]
                del e, p
            base = np.log10((train + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
            ends = np.concatenate([[0], np.cumsum(c.sizes)])
            columns = c.held, c.sizes, segment_sums((train > 0)[c.stream].astype(np.int64), ends), np.full(len(c.sizes), tokens), segment_sums(base[c.stream], ends), segment_sums(logs, ends)
            del c, logs, base, told, replies
            yield from zip(payload[0], *(x.tolist() for x in columns), strict=True)

    rows = number.with_ids(replies).mapPartitions(run)
    return staged(docs.sparkSession.createDataFrame(rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", verifySchema=False))


def perplexity(scored: DataFrame) -> DataFrame:
    """Per held-out flag: documents, tokens, and ten to the minus mean log10 probability, of the model and of the unigram base."""
    return scored.groupBy("held_out").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"),
        F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"))

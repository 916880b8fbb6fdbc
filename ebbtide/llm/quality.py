"""Supervised subword embeddings for document quality.

Every word, every pair of neighbouring words and every run of three or four bytes of a word (with its borders) is hashed
to a row of a table of learned vectors. A document is the mean of its words' vectors, where a word counts as its own
vector, the pair vector with the word before, and the mean of its runs; a softmax layer gives the two classes' shares.
The vectors and the layer are learned together by stochastic gradient descent in numpy, on the driver, from a bounded
sample of labelled documents (``SAMPLE`` in expectation). A pair of equal words has one row whatever the word, so that
plain repetition can be learned. Scoring needs one number per row: the row's vector times the difference of the softmax layer's columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import coded, extended, mixed, ranges, raw, segment_sums, shielded, string_hashes, unshielded, words

#: Labelled documents that the classifier is fitted on, in expectation.
SAMPLE = 4000
ROWS = 1 << 18
DIM = 8
EPOCHS = 6
BATCH = 32
RATE = 0.25
THRESHOLD = 0.3
RUNS = (3, 4)
#: Texts that are scored at a time.
SLICE = 1000


def _word_rows(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(each distinct word's hash, the table rows of all words' byte runs, where each word's runs begin plus the end)."""
    data, starts = raw(distinct)
    sizes = np.diff(starts)
    hashes = string_hashes(data, starts)
    n = len(sizes)
    framed = np.empty(len(data) + 2 * n, np.uint64)
    begin = starts[:-1] + 2 * np.arange(n)
    framed[begin], framed[begin + sizes + 1] = 60, 62  # < and >
    framed[ranges(begin + 1, sizes)] = data
    rows, counts = [], []
    for k in RUNS:
        each = np.maximum(sizes + 2 - k + 1, 0)
        at = ranges(begin, each)
        h = np.full(len(at), k, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x100000001B3) + framed[at + j]
        rows.append((mixed(h) & np.uint64(ROWS - 1)).astype(np.int64))
        counts.append(each)
    total = counts[0] + counts[1]
    ends = np.concatenate([[0], np.cumsum(total)])
    out = np.empty(int(ends[-1]), np.int64)
    out[ranges(ends[:-1], counts[0])] = rows[0]
    out[ranges(ends[:-1] + counts[0], counts[1])] = rows[1]
    return hashes, out, ends


def _pair_rows(hashes: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The table row of each word's pair with the word before it; a text's first word pairs with nothing."""
    if len(ids) == 0:
        return np.zeros(0, np.int64)
    h = hashes[ids]
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
    before[ends[:-1][ends[:-1] < len(ids)]] = 0
    same = before == h
    pair = mixed(before * np.uint64(3) + h + np.uint64(0x51ED27))
    pair[same] = np.uint64(0x5A5A5A)
    return (pair & np.uint64(ROWS - 1)).astype(np.int64)


@dataclass
class QualityModel:
    """One number per table row, and the bias; class 1's log odds are their mean plus the bias."""

    table: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """Class 1's share for each text; an empty text gets the bias's. Texts are taken a thousand at a time."""
        return np.concatenate([self._score(texts.slice(lo, SLICE)) for lo in range(0, len(texts), SLICE)]) if len(texts) else np.zeros(0)

    def _score(self, texts: pa.Array) -> np.ndarray:
        flat, ends = words(texts)
        distinct, ids = coded(flat)
        hashes, runs, run_ends = _word_rows(distinct)
        own = self.table[(hashes & np.uint64(ROWS - 1)).astype(np.int64)].astype(np.float64)
        own += segment_sums(self.table[runs].astype(np.float64), run_ends) / np.maximum(np.diff(run_ends), 1)
        each = own[ids] + self.table[_pair_rows(hashes, ids, ends)] if len(ids) else np.zeros(0)
        mean = segment_sums(each, ends) / np.maximum(3 * np.diff(ends), 1)
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -50, 50)))


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table rows, weights, where each text begins plus the end), rows distinct within a text; weights sum to 1."""
    rows, weights, ends = [], [], [0]
    for lo in range(0, len(texts), 128):
        flat, e = words(texts.slice(lo, 128))
        distinct, ids = coded(flat)
        hashes, runs, run_ends = _word_rows(distinct)
        n = np.diff(e)
        doc = np.repeat(np.arange(len(n)), n)
        sizes = np.diff(run_ends)[ids] if len(ids) else np.zeros(0, np.int64)
        all_rows = np.concatenate([(hashes & np.uint64(ROWS - 1)).astype(np.int64)[ids], _pair_rows(hashes, ids, e), runs[ranges(run_ends[ids], sizes)] if len(ids) else runs])
        all_docs = np.concatenate([doc, doc, np.repeat(doc, sizes)])
        w = np.concatenate([np.ones(2 * len(ids)), np.repeat(1 / np.maximum(sizes, 1), sizes)])
        key, place = np.unique(all_docs * ROWS + all_rows, return_inverse=True)
        rows.append(key % ROWS)
        found = key // ROWS
        weights.append(np.bincount(place, w, len(key)) / np.maximum(3 * n, 1)[found])
        ends.extend((ends[-1] + np.cumsum(np.bincount(found, minlength=len(n)))).tolist())
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.concatenate(weights) if weights else np.zeros(0), np.array(ends)


def fit(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> QualityModel:
    """Vectors, layer and bias from labelled texts. Without both classes the score is the (smoothed) share of class 1 everywhere."""
    labels = np.asarray(labels, np.int64)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    if len(labels) == 0 or labels.min() == labels.max():
        return QualityModel(np.zeros(ROWS, np.float32), float(np.log(prior / (1 - prior))))
    rng = np.random.default_rng(seed)
    rows, weights, ends = _features(texts)
    used, local = np.unique(rows, return_inverse=True)
    vectors = rng.uniform(-1, 1, (len(used), DIM)) / DIM
    layer, bias = rng.normal(0, 0.3, (DIM, 2)), np.log(np.array([1 - prior, prior]))
    seen_v, seen_l, seen_b = np.full(len(used), 1e-8), 1e-8, 1e-8  # running squared gradients set each row's step
    target = np.eye(2)[labels]
    for epoch in range(EPOCHS):
        order, step = rng.permutation(len(labels)), RATE * (1 - epoch / EPOCHS)
        for lo in range(0, len(order), BATCH):
            docs = order[lo:lo + BATCH]
            sizes = ends[docs + 1] - ends[docs]
            at = ranges(ends[docs], sizes)
            r, w = local[at], weights[at][:, None]
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            full = np.flatnonzero(sizes > 0)
            hidden = np.zeros((len(docs), DIM))
            if len(full):
                hidden[full] = np.add.reduceat(vectors[r] * w, bounds[:-1][full], axis=0)
            logits = hidden @ layer + bias
            shares = np.exp(logits - logits.max(1, keepdims=True))
            shares /= shares.sum(1, keepdims=True)
            error = shares - target[docs]
            g_layer, g_bias, g_hidden = hidden.T @ error, error.sum(0), error @ layer.T
            touched, place = np.unique(r, return_inverse=True)
            spread = w * np.repeat(g_hidden, sizes, axis=0)
            g = np.stack([np.bincount(place, spread[:, k], len(touched)) for k in range(DIM)], 1)
            seen_v[touched] += (g * g).mean(1)
            vectors[touched] -= step * g / np.sqrt(seen_v[touched])[:, None]
            seen_l, seen_b = seen_l + (g_layer**2).mean(), seen_b + (g_bias**2).mean()
            layer -= step * g_layer / np.sqrt(seen_l)
            bias = bias - step * g_bias / np.sqrt(seen_b)
    table = np.zeros(ROWS, np.float32)
    table[used] = vectors @ (layer[:, 1] - layer[:, 0])
    return QualityModel(table, float(bias[1] - bias[0]))


def held_out(doc_id: str) -> Column:
    """Whether a document is never learned from: the CRC-32 of its id's digits leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """A model from the labelled documents that aren't held out, at most ``sample`` of them, chosen by a hash of the id, then of id and text.

    Rows without an id, label 0 or 1, are left out; a null text is an empty one. Rows of equal id and text are one.
    """
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.where(~held_out("doc_id") & F.col("doc_id").isNotNull())
    share = min(1.0, sample / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "quality").distinct()
    got = found.orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(sample).toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    text = got.column("text").combine_chunks() if got.num_rows else pa.array([], pa.string())
    return fit(text, got.column("quality").to_numpy())


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` plus score and predicted (which replace columns of these names). The model is one array of a fixed size, whatever the tables' size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner, at = shielded(docs)
    schema, body = extended(inner.schema.fields, score="double", predicted="int"), at[text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = shared.value.score(b.column(b.schema.get_field_index(body)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=[*b.schema.names, "score", "predicted"])

    return unshielded(inner.mapInArrow(run, schema), at, ["score", "predicted"])

"""Order-preserving packing of token ids into windows, cut by dynamic programming.

A partition holds a range of documents in id order; its ids are one long row. Cuts may fall at document ends (free), at sentence ends or, only in
stretches without any, every ``FILL`` ids, at a penalty each. The best cuts minimise padding plus penalties:
cost(j) = min over i with pos(j) - pos(i) <= window of cost(i) + window - (pos(j) - pos(i)) + penalty(j). What depends on i is
cost(i) + pos(i), so a monotone queue gives each minimum in constant time. Ids are cut block by block; the last window of a
block goes on into the next block, so only a partition's last window is left short.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import default_path, loaded
from .ordered import in_order

WINDOW = 4096
#: Penalties in ids of padding: a cut inside a document at a sentence's end, and one inside a sentence.
SENTENCE_CUT, INNER_CUT = 6, 60
FILL = 256
#: Ids that are cut together.
BLOCK = 2_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(positions: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """The best cut positions, first and last included. Neighbouring positions must be at most a window apart; the first is 0."""
    pos, pen = positions.tolist(), penalties.tolist()
    best, back = [0] * len(pos), [0] * len(pos)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + position, place), costs rising
    for j in range(1, len(pos)):
        p = pos[j]
        while p - pos[queue[0][1]] > window:
            queue.popleft()
        base, i = queue[0]
        back[j] = i
        cost = base + window - p + pen[j]
        best[j] = cost
        cost += p
        while queue and queue[-1][0] >= cost:
            queue.pop()
        queue.append((cost, j))
    out, j = [pos[-1]], len(pos) - 1
    while j:
        j = back[j]
        out.append(pos[j])
    return out[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions where a cut may fall, their penalties): document ends, sentence ends, and fillers in long stretches."""
    total = int(doc_ends[-1])
    at = np.flatnonzero(np.isin(ids, sentence)) + 1
    pos = np.unique(np.concatenate([[0], doc_ends, at]))
    gaps = np.diff(pos)
    long = np.flatnonzero(gaps > FILL)
    fill = [np.arange(pos[k] + FILL, pos[k + 1], FILL) for k in long]
    inner = np.concatenate(fill) if fill else np.zeros(0, np.int64)
    pos = np.unique(np.concatenate([pos, inner]))
    pen = np.full(len(pos), SENTENCE_CUT, np.int64)
    pen[np.isin(pos, inner)] = INNER_CUT
    pen[np.isin(pos, doc_ends)] = 0
    pen[(pos == 0) | (pos == total)] = 0
    return pos, pen


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document in a window: where it starts in the document and in the window, and its ids' checksum.

    Null texts are empty: their one id is the end id. Rows of equal id are documents of their own. A sequence's id names its partition and its place there.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        stops = {i for s in (".", "!", "?", "...", "。") for i in coder.tokenizer.encode(s, add_special_tokens=False).ids[-1:]}
        sentence = np.array(sorted(stops), np.int64)
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        # What waits: ids, and per document its id, its ids that went before, its ids in all, and its ids here.
        held_ids: list[np.ndarray] = []
        held: list[tuple[list, np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0

        def cut(last: bool):
            nonlocal sequence, held, held_ids, waiting
            ids = np.concatenate(held_ids)
            names = [x for h in held for x in h[0]]
            gone, whole, here = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
            doc_ends = np.concatenate([[0], np.cumsum(here)])
            at = np.array(cuts(*candidates(ids, doc_ends, sentence), window), np.int64)
            if not last and len(at) > 2:
                at = at[:-1]
            until = int(at[-1])
            begin = np.unique(np.concatenate([doc_ends[doc_ends < until], at[:-1]]))
            size = np.diff(np.concatenate([begin, [until]]))
            doc = np.searchsorted(doc_ends, begin, "right") - 1
            window_of = np.searchsorted(at, begin, "right") - 1
            raw = np.ascontiguousarray(ids, "<u4")
            crc = np.fromiter((zlib.crc32(raw[b:b + s]) for b, s in zip(begin.tolist(), size.tolist(), strict=True)), np.int64, len(begin))
            out = pa.RecordBatch.from_arrays([
                pa.array([names[k] for k in doc.tolist()], pa.int64()), pa.array(gone[doc] + begin - doc_ends[doc]), pa.array(size), pa.array(crc),
                pa.array(whole[doc]), pa.array(sequence + window_of), pa.array(begin - at[window_of]),
            ], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            sequence += len(at) - 1
            held, held_ids, waiting = [], [], 0
            if until < len(ids):
                k = int(np.searchsorted(doc_ends, until, "right") - 1)
                part = until - int(doc_ends[k])
                gone, here = gone[k:].copy(), here[k:].copy()
                gone[0] += part
                here[0] -= part
                held, held_ids, waiting = [(names[k:], gone, whole[k:], here)], [ids[until:]], len(ids) - until
            return out

        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                ids, ends = coder.encode(part.column("text"))
                size = np.diff(ends)
                held_ids.append(ids)
                held.append((part.column("doc_id").to_pylist(), np.zeros(len(size), np.int64), size, size))
                waiting += len(ids)
                if waiting >= BLOCK:
                    yield cut(False)
        if waiting:
            yield cut(True)

    return in_order(docs, key, text).mapInArrow(run, SCHEMA)

"""Token ids as directly addressable codes.

An id is split into chunks of eight bits. Level 0 holds every id's low chunk; a bit per id says whether it goes on; level 1 holds the next
chunk of those that do, with bits of its own, and so on. The place on the next level is the count of set bits before (rank), which two
directories give in constant time: counts before each 512 bits, and before each 64-bit word within its 512. So any id is reached
by itself, without decoding what stands before it.

Files: Parquet rows of (part, block, before, doc_ids, doc_ends, code), written by Spark, as only Spark's writers reach
every store; ``code`` is the binary layout below, little-endian: "DAC1", levels (1 byte), then per level its length (8 bytes), chunks, and, but
for the last level, bits as 64-bit words, counts per 512 bits (4 bytes each) and counts per word (2 bytes each).
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir, staged
from .bpe import default_path, loaded
from .ordered import in_order
from .text import id_crc

MAGIC = b"DAC1"
#: Ids of a block; a longer document is a block of its own.
BLOCK = 2_000_000


def _words_of(n: int) -> int:
    return -(-n // 64)


def encode(ids: np.ndarray) -> bytes:
    """The code of unsigned ids below 2^64."""
    rest = np.asarray(ids).astype(np.uint64)
    levels = max(1, -(-int(rest.max()).bit_length() // 8)) if len(rest) else 1
    out = [MAGIC, bytes([levels])]
    for level in range(levels):
        out += [struct.pack("<q", len(rest)), (rest & np.uint64(255)).astype(np.uint8).tobytes()]
        rest = rest >> np.uint64(8)
        if level + 1 < levels:
            more = rest > 0
            bits = np.zeros(64 * _words_of(len(rest)), np.uint8)
            bits[:len(rest)] = more
            words = np.packbits(bits, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            before = np.cumsum(ones) - ones
            heads = before[::8]
            out += [words.tobytes(), heads.astype("<u4").tobytes(), (before - np.repeat(heads, 8)[:len(before)]).astype("<u2").tobytes()]
            rest = rest[more]
    return b"".join(out)


class Codes:
    """Random access to what ``encode`` made."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a code of this format")
        self.levels, at = [], 5
        for level in range(data[4]):
            (n,) = struct.unpack_from("<q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n
            if level + 1 < data[4]:
                w = _words_of(n)
                bits = np.frombuffer(data, "<u8", w, at)
                heads = np.frombuffer(data, "<u4", -(-w // 8), at + 8 * w)
                steps = np.frombuffer(data, "<u2", w, at + 8 * w + 4 * len(heads))
                at += 10 * w + 4 * len(heads)
                self.levels.append((chunks, bits, heads, steps))
            else:
                self.levels.append((chunks, None, None, None))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions, in any order."""
        at = np.asarray(positions, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= len(self)):
            raise IndexError("position outside the code")
        out = np.zeros(len(at), np.uint64)
        rows: np.ndarray | None = None
        for level, (chunks, bits, heads, steps) in enumerate(self.levels):
            part = chunks[at].astype(np.uint64) << np.uint64(8 * level)
            if rows is None:
                out |= part
            else:
                out[rows] |= part
            if bits is None or not len(at):
                break
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            on = np.flatnonzero((word >> bit) & np.uint64(1))
            word, bit, at = word[on], bit[on], at[on]
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            at = heads[at >> 9].astype(np.int64) + steps[at >> 6] + below
            rows = on if rows is None else rows[on]
        return out


def write(docs: DataFrame, folder: str | None = None, key: str = "doc_id", text: str = "text", path: str | None = None) -> str:
    """Encode all texts in id order and write them; returns the folder. Null texts are empty, every document closes with the end id."""
    path = path or default_path()
    folder = folder or f"{shared_dir(docs.sparkSession).rstrip('/')}/codes-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        block = before = waiting = 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def row():
            nonlocal block, before, held, waiting
            ids = np.concatenate([h[1] for h in held])
            ends = np.cumsum(np.concatenate([h[2] for h in held]))
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([[x for h in held for x in h[0]]], pa.list_(pa.int64())),
                pa.array([ends], pa.list_(pa.int64())), pa.array([encode(ids)], pa.binary()),
            ], names=["part", "block", "before", "doc_ids", "doc_ends", "code"])
            block, before, held, waiting = block + 1, before + len(ids), [], 0
            return out

        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                some = b.slice(lo, 2000)
                ids, ends = coder.encode(some.column("text"))
                held.append((some.column("doc_id").to_pylist(), ids, np.diff(ends)))
                waiting += len(ids)
                if waiting >= BLOCK:
                    yield row()
        if held:
            yield row()

    in_order(docs, key, text).mapInArrow(run, "part int, block int, before long, doc_ids array<long>, doc_ends array<long>, code binary").write.option("compression", "zstd").parquet(folder)
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, its ids fetched by position."""
    rows = spark.read.parquet(folder)
    # One row per written partition, of which there is a bounded number; their running sum is a small table, and Spark sizes the join.
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.element_at("doc_ends", -1)).alias("n"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                codes = Codes(b.column("code")[r].as_py())
                ends = np.concatenate([[0], b.column("doc_ends")[r].values.to_numpy()])
                crc = [id_crc(codes.get(np.arange(s, e))) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                start = b.column("first")[r].as_py() + b.column("before")[r].as_py() + ends[:-1]
                yield pa.RecordBatch.from_arrays([b.column("doc_ids")[r].values, pa.array(start), pa.array(np.diff(ends)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    joined = rows.join(offsets, F.col("part") == F.col("_part")).select("first", "before", "doc_ids", "doc_ends", "code")
    return joined.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")

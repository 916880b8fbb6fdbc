"""Words of Arrow text columns as flat arrays, without one Python object per word."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

#: What separates words: space and the control characters 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]+"


def words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """(all words, where each text's words begin, plus the end). Null reads as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if texts.offset or lower:  # ascii_lower misreads slices, so the bytes are laid out from their start
        data, starts = raw(texts)
        texts = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(starts)), pa.py_buffer(data))
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
        flat = flat.filter(pa.array(full))
    return flat.cast(pa.large_string()), ends


def coded(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct words, each word's place among them)."""
    found = flat.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def raw(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings in a row, and where each begins, plus the end."""
    strings = strings.cast(pa.large_string())
    n = len(strings)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(strings.buffers()[1], np.int64, n + 1, strings.offset * 8)
    data = strings.buffers()[2]
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[offsets[0]:offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, all in one array."""
    sizes = sizes.astype(np.int64)
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.repeat(starts.astype(np.int64) - (ends - sizes), sizes) + np.arange(total, dtype=np.int64)


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``ends``; 0 where there is nothing between them."""
    out = np.zeros(len(ends) - 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(ends) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, ends[:-1][full], dtype=out.dtype)
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def string_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string of ``raw``: a polynomial of its bytes and its length, mixed."""
    sizes = np.diff(starts)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes > 0)
    if len(full):
        power = np.ones(int(sizes.max()), np.uint64)
        power[1:] = np.uint64(0x100000001B3F)
        power = np.multiply.accumulate(power)
        place = np.arange(len(data), dtype=np.int64) - np.repeat(starts[:-1], sizes)
        out[full] = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[place], starts[:-1][full])
    return mixed(mixed(out) + sizes.astype(np.uint64))


def id_crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """(``df`` with its columns renamed by place, new name of each): operators can add columns of any name to it. ``toDF`` with the old names undoes it."""
    inner = df.toDF(*[f"__in{i}" for i in range(len(df.columns))])
    return inner, dict(zip(df.columns, inner.columns))


def unshielded(df: DataFrame, at: dict[str, str], made: Sequence[str]) -> DataFrame:
    """The old columns under their old names, then those ``made``, which replace old ones of the same name."""
    return df.select(*[F.col(new).alias(old) for old, new in at.items() if old not in made], *made)


def extended(fields, **types: str) -> StructType:
    """A new schema: ``fields``, then columns of the types named."""
    simple = {"int": IntegerType(), "long": LongType(), "double": DoubleType(), "string": StringType(), "binary": BinaryType(), "boolean": BooleanType()}
    return StructType([*fields, *[StructField(k, simple[v]) for k, v in types.items()]])

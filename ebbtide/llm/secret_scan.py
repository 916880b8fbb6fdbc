"""Secrets in whole texts: keyword automaton, anchored expressions at its hits, embedded checksums.

One Aho-Corasick automaton reads each text once, in lower case, and says where a keyword lies; an expression runs only
there, anchored to the hit. A hit inside the match before it (of its kind) is passed over, which gives the leftmost matches that don't
overlap. Long runs of hexadecimal digits have no keyword of letters; their keyword is a run of digits after every digit is read as one sign.
Tokens whose format holds a checksum count only if it is right.

Rows are independent, so nothing is shuffled, and a lost task is repeated alone. A task holds one Arrow batch and the matches of one text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

MIN_VALUE = 6
MIN_ACCESS = 20
MIN_HEX = 24

# Alphabets and constants of the public token formats.
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_suffix(token: bytes) -> bool:
    """The last six characters are the CRC-32 of the thirty before them, in base 62."""
    number = 0
    for c in token[-6:]:
        number = number * 62 + BASE62.index(c)
    return number == zlib.crc32(token[-36:-6])


def base58_check(token: bytes) -> bool:
    """The last four bytes are the first four of the doubled SHA-256 of the rest."""
    number = 0
    for c in token:
        number = number * 58 + BASE58.index(c)
    size = (number.bit_length() + 7) // 8
    raw = number.to_bytes(size, "big")
    return size == 82 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_check(token: bytes) -> bool:
    """The checksum polynomial over prefix and data leaves one; upper and lower case don't mix."""
    if token != token.lower() and token != token.upper():
        return False
    prefix, _, data = token.lower().rpartition(b"1")
    state = 1
    for v in [*[c >> 5 for c in prefix], 0, *[c & 31 for c in prefix], *[BECH32.index(c) for c in data]]:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ v
        for i, step in enumerate(BECH32_STEPS):
            state ^= step if top >> i & 1 else 0
    return state == 1


class Kind:
    """Keywords (lower case), the expression tried where one begins, and what a match has to pass."""

    def __init__(self, name: str, keywords: list[str], pattern: bytes, passes: Callable[[re.Match], bool], flags: int = 0):
        self.name, self.keywords, self.pattern, self.passes = name, keywords, re.compile(pattern, flags), passes


_ALONE = rb"(?<![A-Za-z0-9_])"
_ENDS = rb"(?![A-Za-z0-9_])"

#: In this order where two begin at the same place. The first three are the base; the others carry checksums.
KINDS = [
    Kind("assign", ["password", "passwd", "secret", "token", "apikey", "api_key"],
         rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= MIN_VALUE, re.IGNORECASE),
    Kind("access", ["akia"], rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= MIN_ACCESS),
    Kind("hex", [], rb"[0-9a-f]+", lambda m: len(m[0]) >= MIN_HEX),
    Kind("github", ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], _ALONE + rb"gh[pousr]_[A-Za-z0-9]{36}" + _ENDS, lambda m: crc_suffix(m[0])),
    Kind("npm", ["npm_"], _ALONE + rb"npm_[A-Za-z0-9]{36}" + _ENDS, lambda m: crc_suffix(m[0])),
    Kind("wallet", ["xprv", "yprv", "zprv", "tprv"], _ALONE + rb"[xyzt]prv[1-9A-HJ-NP-Za-km-z]{107}" + _ENDS, lambda m: base58_check(m[0])),
    Kind("bech32", ["nsec1", "age-secret-key-1"], _ALONE + rb"(?:nsec1|age-secret-key-1)[02-9ac-hj-np-z]{58}" + _ENDS, lambda m: bech32_check(m[0]), re.IGNORECASE),
]
BASE = ("assign", "access", "hex")

_HEX_SIGNS = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = b"h" * MIN_HEX
_CONTINUED = bytes(range(0x80, 0xC0))


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    owners: dict[str, list[int]] = {}
    for k, kind in enumerate(KINDS):
        for word in kind.keywords:
            owners.setdefault(word, []).append(k)
    for word, kinds in owners.items():
        found.add_word(word, (len(word), kinds))
    found.make_automaton()
    return found


def hits(data: bytes) -> Iterator[tuple[int, int]]:
    """(place, kind) where a keyword begins, in bytes; of one kind in ascending order of place."""
    # One character per byte, so that places are byte places; only A-Z change their case.
    starts = [(end - size + 1, k) for end, (size, kinds) in automaton().iter(data.lower().decode("latin-1")) for k in kinds]
    yield from sorted(starts)
    signs = data.translate(_HEX_SIGNS)
    at = signs.find(_HEX_RUN)
    while at >= 0:
        yield at, 2
        end = signs.find(b" ", at)
        at = signs.find(_HEX_RUN, end) if end >= 0 else -1


def find(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all matches that pass, by start, then kind; in code points of the UTF-8 text."""
    last, found = [0] * len(KINDS), []
    for at, k in hits(data):
        kind = KINDS[k]
        if at >= last[k] and (m := kind.pattern.match(data, at)):
            last[k] = m.end()
            if kind.passes(m):
                found.append((at, k, m.end()))
    if found and not data.isascii():
        place, before, points = {}, 0, 0
        for b in sorted({b for s, _, e in found for b in (s, e)}):
            points += len(data[before:b].translate(None, _CONTINUED))
            place[b], before = points, b
        found = [(place[s], k, place[e]) for s, k, e in found]
    return sorted(found)


SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", found: str = "found") -> DataFrame:
    """(key, found): each row's matches as kind, start, end (code points, end exclusive), by start and then kind.

    A null text counts as empty, and has an empty list as any clean text. Repeated rows and null keys give a row each; an empty table
    gives none. Other columns are left out, whatever their names.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([k.name for k in KINDS])
        for batch in batches:
            got, sizes = [], []
            for value in batch.column(1):
                data = value.as_py()
                own = find(data) if data else []
                got += own
                sizes.append(len(own))
            flat = np.array(got, np.int64).reshape(-1, 3)
            spans = pa.StructArray.from_arrays([pa.array(names[flat[:, 1]], pa.string()), pa.array(flat[:, 0]), pa.array(flat[:, 2])], ["kind", "start", "end"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [key, found])

    schema = StructType([StructField(key, rows.schema["key"].dataType), StructField(found, ArrayType(SPAN))])
    return rows.mapInArrow(run, schema)


def listed(found: Column | str, kinds: tuple[str, ...] | None = None) -> Column:
    """Matches (of these kinds) as kind:start:end, joined by commas; nothing gives the empty string."""
    spans = F.col(found) if isinstance(found, str) else found
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column | str, found: Column | str, mark: str = "*") -> Column:
    """The text with every code point of every match replaced by ``mark`` (one code point); a null text stays null."""
    body = F.col(text) if isinstance(text, str) else text
    spans = F.col(found) if isinstance(found, str) else found

    def cover(done: Column, s: Column) -> Column:
        size = s["end"] - s["start"]
        return F.concat(F.substring(done, F.lit(1), s["start"].cast("int")), F.repeat(F.lit(mark), size.cast("int")), F.substring(done, (s["end"] + 1).cast("int"), F.char_length(done)))

    return F.aggregate(spans, body, cover)

"""SentencePiece merges with seeded dropout, and their decoding.

A text becomes segments: a run of spaces and what follows up to the next space; no piece reaches over a segment's end. In a segment the
candidate merges form an agenda ordered by the merged piece's score, then from left to right; a candidate (start, middle, end) is skipped for good
if a hash of the seed, the document's id, the segment's number in it and the candidate's place is below the dropout: every occurrence has draws of its own.
Short segments are merged side by side in numpy (one merge per segment and round); equal ones are merged as one for as long as their draws have skipped
the same candidates. Long ones have a heap of their own. Without dropout the result is the library's own. Characters without a piece become byte pieces; so does a literal U+2581, which stands for the space, and hence decoding gives back
every text exactly.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import coded, extended, id_crc, mixed, ranges, raw, string_hashes

#: Share of candidate merges that are skipped.
DROPOUT, SEED = 0.1, 1
#: Segments up to this many characters are processed side by side.
SHORT = 64
#: Characters of the segments that are merged at a time.
CELLS = 1_000_000
NEVER = np.int64(1 << 40)
SPACE = 0x2581

_models: dict[str, Pieces] = {}


class Pieces:
    """A model file's pieces as tables: characters, mergeable pairs, bytes."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        at = {names[i]: i for i in plain}
        self.unknown = n
        self.bytes_of = np.zeros(256, np.int64)
        spelled = [b""] * (n + 1)
        for i in range(n):
            if sp.is_byte(i):
                value = int(names[i][1:-1], 16)
                self.bytes_of[value] = i
                spelled[i] = bytes([value])
        for i in plain:
            spelled[i] = names[i].replace("▁", " ").encode()
        order = sorted((i for i in plain), key=lambda i: (-sp.get_score(i), i))
        rank = {i: k for k, i in enumerate(order)}
        chars = sorted((ord(names[i]), i) for i in plain if len(names[i]) == 1)
        self.chars = np.array([c for c, _ in chars], np.int64)
        self.char_ids = np.array([i for _, i in chars], np.int64)
        pairs = sorted((at[s[:k]] * (n + 1) + at[s[k:]], rank[i], i) for s, i in at.items() for k in range(1, len(s)) if s[:k] in at and s[k:] in at)
        self.pairs = np.array([p for p, _, _ in pairs], np.int64)
        self.pair_rank = np.array([*[r for _, r, _ in pairs], NEVER], np.int64)
        self.rank_id = np.array(order, np.int64)
        self.width = n + 1
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged piece's place in the agenda's order; NEVER where the two don't merge."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NEVER)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, where each begins plus the end) from their ids; the space put before each text is taken off."""
        sizes = self.lengths[ids]
        data = self.data[ranges(self.starts[ids], sizes)]
        bounds = np.concatenate([[0], np.cumsum(sizes)])[ends]
        full = np.diff(bounds) > 0
        keep = np.ones(len(data), bool)
        keep[bounds[:-1][full]] = False
        return data[keep], bounds - np.concatenate([[0], np.cumsum(full)])


def loaded(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def skipped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidate that joins [start, middle) and [middle, end) of the segment with this key is left out."""
    if dropout <= 0:
        return np.zeros(np.broadcast(key, start).shape, bool)
    h = mixed(key + mixed(start.astype(np.uint64) * np.uint64(0x1000003) + middle.astype(np.uint64)) * np.uint64(3) + end.astype(np.uint64) * np.uint64(0x9E3779B1))
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53) < dropout


def _side_by_side(model: Pieces, symbols: np.ndarray, of: np.ndarray, key: np.ndarray, dropout: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Merge rows of equal length until nothing merges, for units that each have a row (``of``) and a key.

    A row stands for all units whose keys have skipped the same candidates so far, and is split where they part.
    (units, their places among the rows that follow, the rows' first numbers, symbols and starts) as rows finish.
    """
    n, width = symbols.shape
    base, units, done = np.arange(n), np.arange(len(of)), []
    starts = np.tile(np.arange(width + 1), (n, 1))
    rank = model.ranks(symbols[:, :-1], symbols[:, 1:])
    if width > 1 and dropout > 0:
        line = np.arange(width + 1)
        out = (rank < NEVER)[of] & skipped(key[:, None], line[:-2], line[1:-1], line[2:], dropout)
        masks, mask = np.unique(out @ (np.uint64(1) << np.arange(width - 1, dtype=np.uint64)), return_inverse=True)
        pairs, of = np.unique(of * len(masks) + mask, return_inverse=True)
        base = pairs // len(masks)
        symbols, starts, rank = symbols[base], starts[base], rank[base]
        rank[(masks[pairs % len(masks)][:, None] >> np.arange(width - 1, dtype=np.uint64)) & np.uint64(1) == 1] = NEVER
    while len(base):
        if symbols.shape[1] < 2:
            done.append((units, of, base, symbols, starts[:, :-1]))
            break
        at = rank.argmin(1)
        best = rank[np.arange(len(base)), at]
        over = best == NEVER
        if over.any():
            ended, go = over[of], ~over
            done.append((units[ended], (np.cumsum(over) - 1)[of[ended]], base[over], symbols[over], starts[over, :-1]))
            units, of = units[~ended], (np.cumsum(go) - 1)[of[~ended]]
            base, symbols, starts, rank, at, best = base[go], symbols[go], starts[go], rank[go], at[go], best[go]
            if not len(base):
                break
        symbols[np.arange(len(base)), at] = model.rank_id[best]
        width = symbols.shape[1] - 1
        gap = np.arange(width)[None, :]
        symbols = np.take_along_axis(symbols, gap + (gap > at[:, None]), 1)
        gap = np.arange(width + 1)[None, :]
        starts = np.take_along_axis(starts, gap + (gap > at[:, None]), 1)
        if width < 2:
            continue
        gap = np.arange(width - 1)[None, :]
        rank = np.take_along_axis(rank, np.minimum(gap + (gap >= at[:, None]), rank.shape[1] - 1), 1)
        drop = np.zeros(len(units), np.int64)
        for bit, side in ((1, -1), (2, 0)):
            p = at + side
            ok = np.flatnonzero((p >= 0) & (p < width - 1))
            r = model.ranks(symbols[ok, p[ok]], symbols[ok, p[ok] + 1])
            rank[ok, p[ok]] = r
            if dropout > 0:
                offered = np.zeros(len(base), bool)
                offered[ok[r < NEVER]] = True
                some = np.flatnonzero(offered[of])
                row = of[some]
                q = p[row]
                drop[some] |= bit * skipped(key[units[some]], starts[row, q], starts[row, q + 1], starts[row, q + 2], dropout)
        if drop.any():
            code = of * 4 + drop
            used = np.zeros(4 * len(base), bool)
            used[code] = True
            of, met = (np.cumsum(used) - 1)[code], np.flatnonzero(used)
            row = met // 4
            base, symbols, starts, rank, at = base[row], symbols[row], starts[row], rank[row], at[row]
            for bit, side in ((1, -1), (2, 0)):
                hit = np.flatnonzero(met & bit)
                rank[hit, at[hit] + side] = NEVER
    return done


def _alone(model: Pieces, symbols: np.ndarray, key: np.uint64, dropout: float) -> tuple[list[int], list[int]]:
    """One long segment by a heap: (symbols, starts)."""
    sym, n = symbols.tolist(), len(symbols)
    after, before, stop = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int]] = []

    def offer(places: list[int]) -> None:
        i = np.array(places, np.int64)
        j = np.array([after[p] for p in places], np.int64)
        e = np.array([stop[p] for p in j.tolist()], np.int64)
        r = model.ranks(np.array([sym[p] for p in places], np.int64), np.array([sym[p] for p in j.tolist()], np.int64))
        out = skipped(np.full(len(i), key, np.uint64), i, j, e, dropout)
        for a, b, c, d, x in zip(r.tolist(), places, j.tolist(), e.tolist(), out.tolist(), strict=True):
            if a < NEVER and not x:
                heapq.heappush(agenda, (a, b, c, d))

    if n > 1:
        offer(list(range(n - 1)))
    while agenda:
        r, i, j, e = heapq.heappop(agenda)
        if sym[i] < 0 or after[i] != j or stop[j] != e or stop[i] != j or (j < n and sym[j] < 0):
            continue
        sym[i], sym[j] = int(model.rank_id[r]), -1
        stop[i], after[i] = e, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer([p for p in (before[i], i) if p >= 0 and after[p] < n])
    left = [i for i in range(n) if sym[i] >= 0]
    return [sym[i] for i in left], left


def segment_keys(docs: np.ndarray, numbers: np.ndarray, seed: int) -> np.ndarray:
    """The dropout key of each segment from its document's key and its number in the document."""
    return mixed(mixed(docs.astype(np.uint64) + np.uint64(seed) * np.uint64(0x2545F4914F6CDD1D)) + numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def encode(model: Pieces, texts: pa.Array, docs: np.ndarray, dropout: float = DROPOUT, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, where each begins plus the end). ``docs``: the documents' keys for dropout. Null and empty texts have none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    empty = pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0
    lists = pc.split_pattern(texts, " ")
    parts, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    count = np.diff(ends)
    doc = np.repeat(np.arange(len(count)), count)
    size = pc.binary_length(parts).to_numpy(zero_copy_only=False)
    # A segment ends with each part that isn't empty, or with a text's last part; its spaces are the parts since the segment before.
    closing = size > 0
    closing[ends[1:][count > 0] - 1] = True
    closing &= ~empty[doc] if len(doc) else closing
    segments = np.flatnonzero(closing)
    owner = doc[segments]
    first = np.ones(len(segments), bool)
    first[1:] = owner[1:] != owner[:-1]
    lead = segments - np.where(first, ends[owner] - 1, np.concatenate([[0], segments[:-1]]))
    distinct, place = coded(parts)
    data, starts = raw(distinct)
    body = string_hashes(data, starts)
    place = place[segments]
    widest = int(lead.max()) + 1 if len(lead) else 1
    cases, at = np.unique(place * widest + lead, return_inverse=True)
    case_lead, case_word = cases % widest, cases // widest
    # What is merged: every segment by its own key; without dropout each distinct segment once.
    if dropout > 0:
        number = np.arange(len(owner)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(owner) else owner
        unit_case, key = at, segment_keys(docs[owner], number, seed)
    else:
        unit_case, key = np.arange(len(cases)), np.zeros(len(cases), np.uint64)
    points = np.frombuffer("".join(distinct.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    found = np.minimum(np.searchsorted(model.chars, points), len(model.chars) - 1)
    symbol = np.where((model.chars[found] == points) & (points != SPACE), model.char_ids[found], model.unknown)
    space = model.char_ids[np.searchsorted(model.chars, SPACE)]
    total = case_lead + lengths[case_word]

    def start_symbols(rows: np.ndarray, width: int) -> np.ndarray:
        col = np.arange(width)[None, :] - case_lead[rows][:, None]
        if not len(symbol):
            return np.full((len(rows), width), space)
        return np.where(col < 0, space, symbol[np.clip(begins[case_word[rows]][:, None] + col, 0, len(symbol) - 1)])

    way = np.zeros(len(unit_case), np.int64)
    case_of, order, ids, way_case, ways = [], [], [], [], 0
    unit_total = total[unit_case]
    short = np.flatnonzero(unit_total <= SHORT)
    short = short[np.argsort(unit_total[short] * max(1, len(cases)) + unit_case[short], kind="stable")]
    bounds = np.flatnonzero(np.diff(unit_total[short])) + 1
    for group in np.split(short, bounds) if len(short) else []:
        width = int(unit_total[group[0]])
        step = max(1, CELLS // width)
        for lo in range(0, len(group), step):
            some = group[lo:lo + step]
            rows, of = np.unique(unit_case[some], return_inverse=True)
            for units, line, base, s, b in _side_by_side(model, start_symbols(rows, width), of, key[some], dropout):
                way[some[units]] = ways + line
                case_of.append(np.repeat(ways + np.arange(len(base)), s.shape[1]))
                order.append(b.ravel())
                ids.append(s.ravel())
                way_case.append(rows[base])
                ways += len(base)
    for unit in np.flatnonzero(unit_total > SHORT).tolist():
        row = unit_case[unit]
        s, b = _alone(model, start_symbols(np.array([row]), int(total[row]))[0], key[unit], dropout)
        way[unit] = ways
        case_of.append(np.full(len(s), ways))
        order.append(np.array(b))
        ids.append(np.array(s))
        way_case.append(np.array([row]))
        ways += 1
    case_of, order, ids, way_case = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (case_of, order, ids, way_case))
    case_lead, case_word = case_lead[way_case], case_word[way_case]
    at = way if dropout > 0 else way[at]
    # Characters without a piece, as the bytes of their UTF-8.
    odd = np.flatnonzero(ids == model.unknown)
    if len(odd):
        spelled = [chr(p).encode() for p in points[begins[case_word[case_of[odd]]] + order[odd] - case_lead[case_of[odd]]].tolist()]
        sizes = np.ones(len(ids), np.int64)
        sizes[odd] = [len(x) for x in spelled]
        case_of, wide = np.repeat(case_of, sizes), np.repeat(ids, sizes)
        wide[wide == model.unknown] = model.bytes_of[np.frombuffer(b"".join(spelled), np.uint8)]
        ids = wide
    per_case = np.bincount(case_of, minlength=ways)
    first_id = np.cumsum(per_case) - per_case
    sizes = per_case[at]
    out = ids[ranges(first_id[at], sizes)]
    seg_ends = np.concatenate([[0], np.cumsum(sizes)])
    per_doc = np.bincount(owner, minlength=len(count)) if len(owner) else np.zeros(len(count), np.int64)
    return out, seg_ends[np.concatenate([[0], np.cumsum(per_doc)])]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def keys_of(ids: pa.Array, seed: int) -> np.ndarray:
    """Documents' keys for dropout: a 64-bit hash of seed and id."""
    return np.array([xxhash.xxh64_intdigest(f"{seed}:{x}") for x in ids.to_pylist()], np.uint64)


def with_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, dropout: float = DROPOUT, seed: int = SEED, ids: str = "ids") -> DataFrame:
    """``docs`` plus its ids (array<int>; a column of that name is replaced). Null texts have none. The document's key and a segment's number in it decide what is skipped."""
    docs = docs.drop(ids)
    path, schema = path or default_path(), docs.withColumn(ids, F.array().cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for b in batches:
            if not b.num_rows:
                continue
            at = b.schema.get_field_index
            got, ends = encode(model, b.column(at(text)), keys_of(b.column(at(key)), seed), dropout, seed)
            column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(got.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, column], names=[*b.schema.names, ids])

    return docs.mapInArrow(run, schema)


def with_text(rows: DataFrame, ids: str = "ids", path: str | None = None, text: str = "decoded") -> DataFrame:
    """``rows`` plus the text that its ids spell (a column of that name is replaced); null ids spell nothing."""
    rows = rows.drop(text)
    path, schema = path or default_path(), extended(rows.schema.fields, **{text: "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for b in batches:
            column = b.column(b.schema.get_field_index(ids))
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            data, ends = model.decode(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            memory = data.tobytes()
            out = [memory[s:e].decode("utf-8", "replace") for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, text])

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(key, n_ids, ids_crc32, decoded_crc32, lossless): every text encoded with dropout and decoded again, in one pass."""
    path = path or default_path()
    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    schema = extended(rows.schema.fields[:1], n_ids="long", ids_crc32="long", decoded_crc32="long", lossless="boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                ids, ends = encode(model, b.column(1), keys_of(b.column(0), seed), dropout, seed)
                data, bounds = model.decode(ids, ends)
                source, at = raw(pc.fill_null(b.column(1).cast(pa.large_string()), ""))
                memory, origin = data.tobytes(), source.tobytes()
                crc, same, sums = [], [], []
                for k in range(b.num_rows):
                    out = memory[bounds[k]:bounds[k + 1]]
                    crc.append(zlib.crc32(out))
                    same.append(out == origin[at[k]:at[k + 1]])
                    sums.append(id_crc(ids[ends[k]:ends[k + 1]]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends)), pa.array(sums, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)], names=[key, "n_ids", "ids_crc32", "decoded_crc32", "lossless"])

    return rows.mapInArrow(run, schema)

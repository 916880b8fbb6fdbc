"""Ids of whole texts by a tokenizer file, with each distinct word encoded once per worker.

The file's normaliser and splitting never join what white space parts, so a text's ids are its words' ids in a row. Words not met
before go through the tokenizer in bulk. What a worker has seen is kept in flat arrays (about 70 bytes a word): sorted hashes, and the words'
bytes, which every hit is compared with. Beyond ``KEPT`` words only those met since the last such moment stay. Results don't depend on it.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import coded, ranges, raw, segment_sums, string_hashes, words

#: Distinct words that one worker keeps.
KEPT = 1_500_000
#: Words joined into one string for the tokenizer.
JOINED = 256
#: Closes every document.
END = 2

_loaded: dict[str, WordIds] = {}


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = next((t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip)), None)
        self.mark, self.mark_id = mark, self.tokenizer.token_to_id(mark) if mark else None
        self.forget()

    def forget(self) -> None:
        self.keys, self.met = np.zeros(0, np.uint64), np.zeros(0, bool)  # one entry per word, by hash
        self.at, self.size, self.text_at, self.text_size = (np.zeros(0, np.int64) for _ in range(4))  # its ids and its bytes
        self.pool, self.text = np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def _age(self) -> None:
        """Words not met since the last time go; if that leaves too many, all do."""
        keep = np.flatnonzero(self.met)
        if len(keep) > KEPT // 2:
            self.forget()
            return
        self.pool, self.text = self.pool[ranges(self.at[keep], self.size[keep])], self.text[ranges(self.text_at[keep], self.text_size[keep])]
        self.keys, self.size, self.text_size = self.keys[keep], self.size[keep], self.text_size[keep]
        self.at, self.text_at, self.met = np.cumsum(self.size) - self.size, np.cumsum(self.text_size) - self.text_size, np.zeros(len(keep), bool)

    def _learn(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each word's begin among them, how many it has)."""
        odd = [i for i, w in enumerate(fresh) if self.mark is None or "<|" in w]
        plain = sorted(set(range(len(fresh))) - set(odd)) if odd else list(range(len(fresh)))
        ids: list[int] = []
        texts = [self.mark.join(fresh[k] for k in plain[i:i + JOINED]) for i in range(0, len(plain), JOINED)]
        for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []:
            ids.extend(found.ids)
            ids.append(self.mark_id)
        flat = np.array(ids, np.int64)
        stops = np.flatnonzero(flat == self.mark_id) if len(flat) else np.zeros(0, np.int64)
        parts, counts = [flat[flat != self.mark_id] if len(flat) else flat], [np.diff(np.concatenate([[-1], stops])) - 1]
        for i in odd:
            one = np.array(self.tokenizer.encode(fresh[i], add_special_tokens=False).ids, np.int64)
            parts.append(one)
            counts.append(np.array([len(one)]))
        made = np.concatenate(counts)
        order, at, size = np.array([*plain, *odd], np.int64), np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        at[order], size[order] = np.cumsum(made) - made, made
        return np.concatenate(parts).astype(np.int32), at, size

    def _find(self, data: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each word in the store, whether it is there): equal hash, equal length and equal bytes."""
        place = np.searchsorted(self.keys, keys)
        sizes, there = np.diff(starts), np.zeros(len(keys), bool)
        maybe = np.flatnonzero(place < len(self.keys))
        maybe = maybe[self.keys[place[maybe]] == keys[maybe]]
        maybe = maybe[self.text_size[place[maybe]] == sizes[maybe]]
        wrong = data[ranges(starts[:-1][maybe], sizes[maybe])] != self.text[ranges(self.text_at[place[maybe]], sizes[maybe])]
        there[maybe] = segment_sums(wrong, np.concatenate([[0], np.cumsum(sizes[maybe])])) == 0
        return place, there

    def _words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(where each word's ids begin in the pool, how many there are)."""
        data, starts = raw(distinct)
        keys = string_hashes(data, starts)
        place, there = self._find(data, starts, keys)
        at, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        self.met[place[there]] = True
        at[there], size[there] = self.at[place[there]], self.size[place[there]]
        new = np.flatnonzero(~there)
        if len(new):
            ids, begin, count = self._learn(distinct.take(pa.array(new)).to_pylist())
            at[new], size[new] = len(self.pool) + begin, count
            self.pool = np.concatenate([self.pool, ids])
            # One word per hash is kept; a second one of the same hash is encoded whenever it is met.
            _, first = np.unique(keys[new], return_index=True)
            kept = new[first]
            into = np.searchsorted(self.keys, keys[kept])
            free = np.ones(len(kept), bool) if not len(self.keys) else self.keys[np.minimum(into, len(self.keys) - 1)] != keys[kept]
            kept, into = kept[free], into[free]
            length = np.diff(starts)[kept]
            more = {"keys": keys[kept], "at": at[kept], "size": size[kept], "text_at": len(self.text) + np.cumsum(length) - length, "text_size": length, "met": np.ones(len(kept), bool)}
            for name, values in more.items():
                setattr(self, name, np.insert(getattr(self, name), into, values))
            self.text = np.concatenate([self.text, data[ranges(starts[:-1][kept], length)]])
        return at, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by ``END``; where each text begins, plus the end). Null reads as empty."""
        flat, ends = words(texts)
        distinct, place = coded(flat)
        # Added tokens match the text's own spelling, so only words that can't hold one are lower-cased.
        distinct, merged = coded(pc.if_else(pc.match_substring(distinct, "<|"), distinct, pc.ascii_lower(distinct)))
        place = merged[place]
        at, size = self._words(distinct)
        sizes = size[place]
        word_ends = np.concatenate([[0], np.cumsum(sizes)])
        n = len(ends) - 1
        doc_ends = word_ends[ends] + np.arange(n + 1)
        out = np.full(int(doc_ends[-1]), END, np.int32)
        keep = np.ones(len(out), bool)
        keep[doc_ends[1:] - 1] = False
        out[keep] = self.pool[ranges(at[place], sizes)]
        if len(self.keys) > KEPT:
            self._age()
        return out, doc_ends


def loaded(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

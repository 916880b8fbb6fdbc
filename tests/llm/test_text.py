import re

import numpy as np
import pyarrow as pa

from ebbtide.llm.text import ranges, raw, segment_sums, string_hashes, words


def test_words_of_slices_and_awkward_texts():
    texts = ["Ünï É à b", None, "", " \x0b\t", "one\x1ctwo\x85x\xa0y Ab,\r\nc  ", "ÀB" * 40, "z"] * 30
    whole = pa.array(texts)
    for lo in (0, 1, 3, 50, 208):
        for lower in (False, True):
            part = whole.slice(lo, 100)
            flat, ends = words(part, lower)
            want = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if lower else t or "") for t in texts[lo:lo + 100]]
            assert flat.to_pylist() == [w for d in want for w in d]
            assert np.diff(ends).tolist() == [len(d) for d in want]
            cased, _ = words(part.cast(pa.large_string()), lower)
            assert cased.equals(flat)


def test_small_helpers():
    assert ranges(np.array([5, 9, 2]), np.array([2, 0, 3])).tolist() == [5, 6, 2, 3, 4]
    assert segment_sums(np.array([1, 2, 3]), np.array([0, 0, 2, 2, 3])).tolist() == [0, 3, 0, 3]
    names = pa.array(["", "a", "aa", "b", "ab", "ba", "a" * 3000])
    assert len(set(string_hashes(*raw(names)).tolist())) == 7
    assert words(pa.array([], pa.string()))[1].tolist() == [0]

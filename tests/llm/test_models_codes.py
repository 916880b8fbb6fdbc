import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import awkward_documents, folder, sentence

import corpus_pipeline
from ebbtide.llm import bpe, codes, licenses, packing, pieces, pitman_yor, quality, queries


def expected_ids(text):
    return [*bpe.loaded(bpe.default_path()).tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_ids_equal_whole_text_ids():
    texts = ["It's  5 o'clock\tnow…", "É ÉÇ é don't", "<|startoftext|>x <|endoftext|> a<|b", None, "", "ΟΔΟΣ ß İ", "你好world 🙂!!", "a\x85b\xa0c"]
    ids, ends = bpe.loaded(bpe.default_path()).encode(pa.array(texts))
    assert [ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:])] == [expected_ids(t) for t in texts]


def test_added_tokens_match_their_own_spelling_only():
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "<|endoftext|> <|StartOfText|>x <|startoftext|>", "The the THE <|X Don't <|x", "É<|ENDOFTEXT|>É"]
    ids, ends = bpe.WordIds(bpe.default_path()).encode(pa.array(texts))
    assert [ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:])] == [expected_ids(t) for t in texts]


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, np.int64), np.array([0]), np.array([255, 256, 65535, 65536, 2**31, 2**40]), rng.integers(0, 49408, 30_000), np.zeros(700, np.int64)):
        c = codes.Codes(codes.encode(ids))
        assert len(c) == len(ids) and (c.get(np.arange(len(ids))) == ids).all()
        if len(ids):
            at = rng.integers(0, len(ids), 500)
            assert (c.get(at) == ids[at]).all()
            with pytest.raises(IndexError):
                c.get(np.array([len(ids)]))
    with pytest.raises(ValueError):
        codes.Codes(b"none of it")


def test_codes_query(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 500)
    docs = awkward_documents(spark)
    got = queries.op10_addressable_codes(spark, folder(spark, documents=docs)).collect()
    want = {(r.doc_id, r.text): expected_ids(r.text) for r in docs.collect()}
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(r.doc_id), len(expected_ids(r.text)), crc(expected_ids(r.text))) for r in docs.collect())
    assert want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert ids == sorted(ids)
    assert codes.read(spark, codes.write(docs.where("false"))).count() == 0


def brute_cost(pos, pen, window):
    best = [0] + [None] * (len(pos) - 1)
    for j in range(1, len(pos)):
        best[j] = min(best[i] + window - (pos[j] - pos[i]) + pen[j] for i in range(j) if best[i] is not None and pos[j] - pos[i] <= window)
    return best[-1]


def test_cuts_are_the_best():
    rng = random.Random(4)
    for _ in range(30):
        pos = [0]
        while len(pos) < 60:
            pos.append(pos[-1] + rng.randint(1, 30))
        pen = [0] + [rng.choice([0, 6, 60]) for _ in pos[1:-1]] + [0]
        at = packing.cuts(np.array(pos), np.array(pen), 64)
        assert at[0] == 0 and at[-1] == pos[-1] and all(0 < b - a <= 64 for a, b in zip(at, at[1:]))
        cost = sum(64 - (b - a) + pen[pos.index(b)] for a, b in zip(at, at[1:]))
        assert cost == brute_cost(pos, pen, 64)


def test_packing_query(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 9000)
    docs = awkward_documents(spark)
    got = queries.op9_window_packing(spark, folder(spark, documents=docs)).collect()
    pool = {}
    for r in docs.collect():
        pool.setdefault(r.doc_id, []).append(expected_ids(r.text))
    for doc in pool:
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: (r.start, r.length))
        assert sum(r.length for r in mine) == sum(map(len, pool[doc]))
        assert all(any(crc(ids[r.start:r.start + r.length]) == r.ids_crc32 and len(ids) == r.doc_tokens for ids in pool[doc]) for r in mine)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert packing.pack(docs.where("false")).count() == 0


def test_merges_without_dropout_equal_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    model = pieces.loaded(pieces.default_path())
    texts = [None, "", " ", "   a  b ", "Hello\n\tworld", "éé 你好🙂" * 20, "x" * 700, " " * 200 + "end", sentence(500), "internationalization " * 5]
    ids, ends = pieces.encode(model, pa.array(texts), np.zeros(len(texts), np.int64), 0.0)
    assert [ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:])] == [sp.encode(t or "") for t in texts]


def test_dropout_varies_and_decodes(spark):
    docs = awkward_documents(spark).union(awkward_documents(spark).selectExpr("doc_id", "'a▁b ▁' as text", "lang", "source", "n_chars"))
    got = queries.op8_merge_dropout(spark, folder(spark, documents=docs)).collect()
    assert len(got) == 90 and all(r.lossless for r in got)
    assert len({r.ids_crc32 for r in got if (r.doc_id or 0) >= 100}) > 1  # equal texts, other variants
    again = queries.op8_merge_dropout(spark, folder(spark, documents=docs)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    back = pieces.with_text(pieces.with_ids(docs, dropout=0.5)).collect()
    assert all(r.decoded == (r.text or "") for r in back)


def test_every_occurrence_has_dropout_of_its_own():
    model = pieces.loaded(pieces.default_path())
    word = "internationalization"
    texts = [" ".join([word] * 300), " ".join([word] * 300), " ".join(["a", "the", "  of", "x" * 90, "你好é"] * 40)]
    docs = pieces.keys_of(pa.array([1, 2, 3]), 1)
    ids, ends = pieces.encode(model, pa.array(texts), docs, 0.3, 1)
    first, second, third = (ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:]))
    assert first != second
    # Each segment by a heap of its own gives the same.
    at = dict(zip(model.chars.tolist(), model.char_ids.tolist(), strict=True))
    ways = set()
    for doc, text, got in ((0, texts[0], first), (1, texts[1], second), (2, texts[2], third)):
        # A segment: a run of spaces (one is put before the text) and what follows.
        segments = re.findall(" +[^ ]+", " " + text)
        keys = pieces.segment_keys(np.full(len(segments), docs[doc]), np.arange(len(segments)), 1)
        want = []
        for segment, key in zip(segments, keys, strict=True):
            points = [ord(c) if c != " " else pieces.SPACE for c in segment]
            syms, _ = pieces._alone(model, np.array([at.get(p, model.unknown) for p in points]), key, 0.3)
            assert model.unknown not in syms
            want.extend(syms)
            ways.add((segment, tuple(syms)))
        assert got == want
    assert len({w for s, w in ways if s == " " + word}) > 40


def test_tables_drawn_from_the_exact_conditional():
    rng = np.random.default_rng(2)
    d, c, a = 0.8, 6, 0.7
    p = np.exp(pitman_yor.log_stirling(d)[c, 1:c + 1] + np.log(a) * np.arange(1, c + 1))
    t = pitman_yor.draw_tables(np.full(40_000, c), np.full(40_000, a), d, rng)
    assert np.abs(np.bincount(t, minlength=c + 1)[1:] / 40_000 - p / p.sum()).max() < 0.01
    # Weights of all seatings of three customers: together, in two ways apart, alone.
    got = np.exp(pitman_yor.log_stirling(d)[3, 1:4])
    assert np.allclose(got, [(1 - d) * (2 - d), 3 * (1 - d), 1])
    large = pitman_yor.draw_tables(np.full(3, 10**9), np.array([0.5, 5.0, 1e6]), d, rng)
    assert (large >= 1).all() and large[2] > large[0]


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 700)
    monkeypatch.setattr(pitman_yor, "BUCKET_ENTRIES", 60)
    docs = awkward_documents(spark).union(spark.createDataFrame([(1000 + i, sentence(50, i), "en", "c", 0) for i in range(60)], awkward_documents(spark).schema))
    got = queries.op2_pitman_yor_scoring(spark, folder(spark, documents=docs)).collect()
    rows = docs.collect()
    import math
    import re
    from collections import Counter

    def tokens(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    held = {r.doc_id: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows}
    assert any(held.values())
    count = Counter(w for r in rows if not held[r.doc_id] for w in tokens(r.text))
    n, v = sum(count.values()), len(count)
    want = sorted((str(r.doc_id), held[r.doc_id], len(tokens(r.text)), sum(count[w] > 0 for w in tokens(r.text)), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(r.text)), 6)) for r in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    best = pitman_yor.perplexity(spark.createDataFrame(got)).collect()
    assert all(r.perplexity < r.base_perplexity for r in best)
    assert pitman_yor.score(docs.where("false")).count() == 0


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, sentence(40, i % 7)) for i in range(40)], "doc_id long, text string")
    kept = pitman_yor.chunks(docs)
    found = pitman_yor.staged(pitman_yor.dishes(pitman_yor.requests(kept, 1)))
    model = pitman_yor.fit(found, 2)
    row = found.toPandas().to_dict("records")[0]
    bucket = model.bucket(row)
    for s in model.replay(bucket, 2):
        pass
    base = model.base(bucket.of_word)
    for ctx in (0, int(bucket.ctx[3]), 700):
        words = np.append(np.arange(len(bucket.hashes)), -1)
        p = bucket.predict(words, np.full(len(words), ctx), model.history[s], base, model.unknown)
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_contexts_are_the_words_before(spark):
    # Words of equal endings stand before different words; a model of classes of contexts can't tell them apart.
    ends = ["left", "right", "up", "down", "in", "out"]
    texts = [f"{'abcdef'[i % 6]}{'xyz'[i % 3]}same go {ends[i % 6]}" for i in range(240)]
    held = [i for i in range(10_000, 11_000) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    asked = [f"{'abcdef'[i % 6]}{'xyz'[i % 3]}same go {ends[(i + i // 6) % 6]}" for i in range(12)]
    docs = spark.createDataFrame([*enumerate(texts), *zip(held, asked)], "doc_id long, text string")
    got = {r.doc_id: r for r in pitman_yor.score(docs).collect()}
    right, wrong = ([got[i].score for i in part] for part in (held[:6], held[6:]))
    assert all(got[i].held_out for i in held) and min(right) > max(wrong) + 1


def test_entries_of_many_words():
    # Where pairs and thirds don't fit one number together, they are told apart in two steps.
    rng = np.random.default_rng(4)
    pair, third = rng.integers(0, 40, 900), rng.integers(0, 30, 900)
    for values, fan, thirds, at in (pitman_yor.entries_of(pair, third, 40, 30), pitman_yor.entries_of(pair, third, 1 << 40, 1 << 30)):
        got = list(zip(np.repeat(values, fan).tolist(), thirds.tolist()))
        assert got == sorted(set(zip(pair.tolist(), third.tolist()))) and [got[i] for i in at] == list(zip(pair.tolist(), third.tolist()))


def spread_out(spark, monkeypatch):
    """Documents, and the buckets of their model after its last sweep: eight words in any order, one of them in every other place."""
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(pitman_yor, "GROUP_TOKENS", 100)
    monkeypatch.setattr(pitman_yor, "BUCKET_ENTRIES", 800)
    rng = random.Random(5)
    names = ["the", "of", "to", "a", "in", "it", "is", "on"]
    every = [" ".join(x) for x in [(), *((a,) for a in names), *((a, b) for a in names for b in names), *((a, b, c) for a in names for b in names for c in names)]]
    ids = [i for i in range(100_000) if zlib.crc32(str(i).encode()) % 10 == 0]
    learn = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 10][:300]
    texts = [" ".join("the" if rng.random() < 0.5 else rng.choice(names[1:7]) for _ in range(12)) for _ in learn]
    docs = spark.createDataFrame([*zip(learn, texts), *zip(ids, every)], "doc_id long, text string").repartition(3)
    number = pitman_yor.numbered(pitman_yor.chunk_rows(docs), 2)
    asked = pitman_yor.asked_of(number, 9).partitionBy(9, pitman_yor._same)
    found = pitman_yor.dishes_of(asked)
    model, left = pitman_yor.learned(found, number.shared, 2)
    rows = pitman_yor.grouped(spark.sparkContext.union([found, *left]).collect())
    buckets = []
    for k, own in rows.items():
        if dish := [r[1:] for r in own if r[0] == "found"]:
            bucket = model.bucket(dict(zip(pitman_yor.ROW, dish[0]), bucket=k))
            model.back(bucket, own, 2)
            buckets.append(bucket)
    return texts, names, number, model, buckets


def test_counts_and_probabilities_over_buckets(spark, monkeypatch):
    texts, names, number, model, buckets = spread_out(spark, monkeypatch)
    homes = [{b.number for b in buckets if v in b.v} for v in number.shared]
    assert len(homes) >= 1 and len(buckets) > 3 and max(len(h) for h in homes) > 1
    # Every entry and its count, by brute force.
    from collections import Counter

    want = Counter()
    for t in texts:
        w = [None, None, *t.split(), None]
        want.update(zip(w, w[1:], w[2:]))
    counts = sorted(int(c) for b in buckets for c in b.count if c)
    assert counts == sorted(want.values()) and sum(counts) == model.tokens and model.words == len({w for t in texts for w in t.split()}) + 1
    contexts = [(int(v), int(c)) for b in buckets for v, c in zip(b.v, b.c2) if c]
    assert sorted(c for _, c in contexts) == sorted(Counter({k: sum(n for e, n in want.items() if e[:2] == k) for k in {e[:2] for e in want}}).values())
    # In each context that all words were asked in, they and the unknown word share the probability one.
    checked = 0
    for b in buckets:
        base = model.base(b.of_word)
        for ctx in range(len(b.v)):
            mine = b.word[b.ctx == ctx]
            if len(mine) == len(names) + 1:
                # The unigram base counts one unknown word, and words asked for but never learned are as unknown as that one.
                never = int((b.of_word[mine] == 0).sum())
                p = b.predict(np.append(mine, -1), np.full(len(mine) + 1, ctx), model.history[2], base, model.unknown)
                assert np.allclose(p[:-1], b.entries(model.history[2], base)[b.ctx == ctx]) and (p > 0).all()
                assert abs(p.sum() - never * p[-1] - 1) < 1e-9
                checked += 1
    assert checked > 40
    # Totals are those of the seatings.
    assert model.history[2][-4] == model.tokens and 0 < model.history[2][-1] <= model.history[2][-2]


def test_quality(spark):
    good = [sentence(60, i) for i in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in sentence(60, i).split()) for i in range(150)]
    docs = spark.createDataFrame([*[(i, t, "s", 0.5) for i, t in enumerate(good + bad)], (900, None, "s", 0.5), (901, "", "s", 0.5), (None, "x", "s", 0.5)], "doc_id long, text string, source string, score_was double")
    labels = spark.createDataFrame([*[(i, int(i < 150), 0) for i in range(300)], (3, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == 303 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(unseen) > 30 and np.mean([r.predicted == int(r.doc_id < 150) for r in unseen]) > 0.95
    none = quality.train(docs, labels.where("false"))
    assert quality.score(docs.where("false"), none).count() == 0 and none.score(pa.array(["a"]))[0] == 0.5


def test_quality_sample_is_bounded_in_rows(spark, monkeypatch):
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda texts, labels: seen.append((texts.to_pylist(), labels)) or fit(texts, labels))
    rows = [(i, f"{i} " + sentence(20, i)) for i in range(200)] + [(7, "same text")] * 500 + [(7, f"other {i % 300}") for i in range(900)] + [(7, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    quality.train(docs, labels, 10_000)
    whole, _ = seen.pop()
    assert whole.count("same text") == 1 and whole.count(None) == 1 and len([t for t in whole if t and t.startswith("other")]) == 300
    quality.train(docs, labels, 250)
    some, marks = seen.pop()
    assert len(some) == len(marks) == 250 and len(set(some)) == 250
    quality.train(docs.repartition(7), labels, 250)
    assert seen.pop()[0] == some


def test_licenses(spark):
    lines = [t for ts in licenses.TEMPLATES.values() for t in ts]
    docs = spark.createDataFrame([*[(i, sentence(30, i) + "\n\n" + t) for i, t in enumerate(lines)], *[(100 + i, sentence(40, i)) for i in range(400)], (900, None), (901, "")], "doc_id long, text string")
    got = licenses.scan(docs, licenses.train(docs)).collect()
    truth = [f for f, ts in licenses.TEMPLATES.items() for _ in ts]
    sure = {r.doc_id: r.family for r in got if r.confirmed}
    assert np.mean([sure.get(i) == f for i, f in enumerate(truth)]) > 0.9
    assert all(r.doc_id < 100 and r.paragraph == 2 for r in got if r.confirmed)
    assert licenses.scan(docs.where("false"), licenses.fit([])).count() == 0


def test_licenses_inside_long_lines(spark):
    lines = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts]
    inside = [(i, sentence(1500, i) + " " + t + " " + sentence(1500, i + 3)) for i, (_, t) in enumerate(lines)]
    both = (200, " ".join([sentence(900, 1), "Released under the MIT License.", sentence(900, 2), "Licensed under CC BY 4.0.", sentence(900, 3)]))
    docs = spark.createDataFrame([*inside, both, *[(300 + i, sentence(40 + 10 * i, i)) for i in range(300)]], "doc_id long, text string")
    got = [r for r in licenses.scan(docs, licenses.train(docs)).collect() if r.confirmed]
    assert np.mean([any(r.doc_id == i and r.family == f for r in got) for i, (f, _) in enumerate(lines)]) > 0.9
    assert {r.family for r in got if r.doc_id == 200} == {"MIT", "CC-BY"}
    assert all(r.doc_id < 300 and r.paragraph == 0 for r in got)
    line, first, last = licenses.windows(np.array([0, 5, 24, 25, 100]))
    assert [(a, b) for k, a, b in zip(line, first, last) if k == 3] == [(0, 24), (1, 25)]
    assert {w for k, a, b in zip(line, first, last) if k == 4 for w in range(a, b)} == set(range(100))


def test_pipeline(spark):
    rows = [(i, sentence(60, i), "en", "a", 0) for i in range(60)] + [(60 + i, sentence(60, 3), "en", "a", 0) for i in range(20)] + [(3, sentence(60, 3), "en", "a", 0), (500, None, None, None, None), (501, "few words", "en", "a", 0)]
    docs = spark.createDataFrame(rows, awkward_documents(spark).schema)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    d = folder(spark, documents=docs, labels=labels)
    now = spark.read.parquet(f"{d}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, now, d)
    assert kept.columns == now.columns and kept.count() == 81
    one = corpus_pipeline.near_duplicates(spark, kept, d)
    assert one.columns == now.columns
    ids = sorted(r.doc_id for r in one.collect())
    assert len(ids) == len(set(ids)) and 3 in ids and not any(60 <= i < 80 for i in ids)
    out = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in out} == set(ids)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "packing"]


def test_word_store_ages_and_tells_equal_hashes_apart(monkeypatch):
    """Ids don't depend on what the store has kept, also when words share a hash or the store is emptied again and again."""
    import numpy as np
    import pyarrow as pa

    from ebbtide.llm import bpe

    rng = np.random.default_rng(5)
    batches = [pa.array([" ".join(f"w{k}x" if k % 7 else f"é{k}<|END|>" for k in rng.zipf(1.3, 40) % 3000) for _ in range(30)] + [None, ""]) for _ in range(12)]
    plain = bpe.WordIds(bpe.default_path())
    want = [plain.encode(b) for b in batches]
    encode = plain.tokenizer.encode
    for b, (ids, ends) in zip(batches[:2], want[:2]):
        for i, text in enumerate(b.to_pylist()):
            assert ids[ends[i]:ends[i + 1]].tolist() == [*encode(text or "", add_special_tokens=False).ids, bpe.END]
    real = bpe.string_hashes
    for kept, hashes in ((50, real), (700, real), (10**6, lambda d, s: real(d, s) % np.uint64(97)), (60, lambda d, s: real(d, s) % np.uint64(97))):
        monkeypatch.setattr(bpe, "KEPT", kept)
        monkeypatch.setattr(bpe, "string_hashes", hashes)
        store = bpe.WordIds(bpe.default_path())
        for b, (ids, ends) in zip(batches, want):
            got = store.encode(b)
            assert np.array_equal(got[0], ids) and np.array_equal(got[1], ends)

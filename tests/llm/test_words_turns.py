"""Spelling variants, secrets and the conversation trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import prefix_trie, queries, secret_scan, spelling

from llm_fixtures import awkward_documents, folder

CLASH = ("word", "n", "key", "text_", "found", "spans", "start", "form", "depth", "conv", "p1", "line", "place", "h", "piece", "kids", "last", "score")


def clashing(df):
    """``df`` with further columns named like columns that the operators make."""
    return df.withColumns({c: F.lit(7) for c in CLASH})



def from_sql(d, name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet/*.parquet'")
    rel = con.execute(queries.ORACLE[name])
    return [c[0] for c in rel.description], rel.fetchall()


def same(df, columns, rows):
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, rows))


# ---- spelling ---------------------------------------------------------------------------------------------------

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(docs):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6}


def brute_variants(docs):
    words = {w: c for w, c in brute_words(docs).items() if c >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def spelled(seed=1, n=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randint(6, 11))) for _ in range(25)] + ["aaaaaaa", "aaaaaa", "aaaaaaaa", "abababab", "bababab", "×÷×÷×÷×"]
    vocabulary = []
    for s in stems:
        vocabulary += [s] * 40
        for _ in range(4):
            i, c = rng.randrange(len(s)), rng.choice("abcdeéÀ")
            vocabulary += [rng.choice([s[:i] + s[i + 1:], s[:i] + c + s[i:], s[:i] + c + s[i + 1:]])] * rng.choice([1, 3, 7])
    path = [(1000, "qwertyab " * 7), (1001, "qwertyabc " * 50), (1002, "qwertyabcd " * 400)]  # forms of forms
    return path + [(i, " ".join(rng.choice(vocabulary).title() if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randint(0, 300)))) for i in range(n)]


def test_variants_equal_brute_force(spark):
    docs = spelled()
    got = spelling.variants(clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))).collect()
    want = brute_variants(docs)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(w[1] is not None for w in want) > 20 and any(w[:3] == ("qwertyab", "qwertyabc", "qwertyabcd") for w in want)


def test_variants_equal_sql(spark):
    d = folder(spark, documents=spark.createDataFrame(spelled(2), "doc_id long, text string"))
    same(queries.op11_pivotal_grams(spark, d), *from_sql(d, "op11_pivotal_grams", "documents"))


@pytest.mark.parametrize("letters", ["ab", "abc", "aé"])
def test_near_pairs_of_few_letters(spark, letters):
    """Every bigram is frequent and occurs again in the same word: ties in the order, shared prefixes, long runs of one letter."""
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(250)} | {"a" * k for k in range(6, 12)})
    got = spelling.near_pairs(spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")).collect()
    at = {w: 5 + i for i, w in enumerate(words)}
    assert sorted(map(tuple, got)) == sorted((a, b, at[a], at[b]) for a in words for b in words if a < b and one_edit(a, b))


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(300):
        grams = [(p, rng.randint(1, 9)) for p in rng.sample(range(12), rng.randint(3, 6))]
        pairs = [(a, b) for a in grams for b in grams if b[0] - a[0] >= 2]
        a, b = spelling.disjoint_pair(grams)
        cost = dict(grams)
        assert b - a >= 2 and cost[a] + cost[b] == min(x[1] + y[1] for x, y in pairs)


def test_candidates_stay_few(spark):
    """Words that share their rare bigram at one place, and little else, don't meet: far fewer than the pairs of the bigram."""
    rng = random.Random(4)
    words = sorted({"zq" + "".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(3000)})
    met = spelling.candidates(spark.createDataFrame([(w, 5) for w in words], "word string, n long"))
    assert met.count() < 20 * len(words)


def test_no_join_of_words_is_broadcast(spark, monkeypatch):
    """Files of a few words are below any threshold; the rows made of them, and those of a large vocabulary, don't pass through the driver."""
    plans, keep = [], spelling.staged

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(spelling, "staged", lambda df: keep(planned(df)))
    docs = spelled(10)
    out = planned(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")))
    got = out.collect()
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_variants(docs)))
    assert sum("SortMergeJoin" in p for p in plans) >= 4  # candidates, a round of paths or more, the result as planned and as run
    assert not [p for p in plans if "Broadcast" in p]


def test_word_counts_of_awkward_texts(spark):
    docs = awkward_documents(spark)
    got = {r.word: r.n for r in spelling.word_counts(clashing(docs)).collect()}
    assert got == brute_words([(r.doc_id, r.text) for r in docs.collect()])


def test_words_are_whole_at_window_and_text_ends(spark):
    import numpy as np
    import pyarrow as pa

    from ebbtide.llm.text import raw

    texts = ["abcdef", "ghijkl", "", "xÀÿé mnopqr", "ü" * 90, "stuvwx"] * 7
    data, starts = raw(pa.array(texts))
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(texts))], np.uint32)
    found = spelling._counted(data, starts[:-1], 0, before)
    assert {r["values"]: r["counts"] for r in found.to_pylist()} == brute_words(list(enumerate(texts)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    code = spelling.word_counts
    old, spelling.WINDOW = spelling.WINDOW, 5
    try:
        assert {r.word: r.n for r in code(df).collect()} == brute_words(list(enumerate(texts)))
    finally:
        spelling.WINDOW = old


def test_no_words(spark):
    none = awkward_documents(spark).where("false")
    assert spelling.variants(none).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (None, ""), (2, "short or rare")], "doc_id long, text string")).count() == 0


# ---- secrets ----------------------------------------------------------------------------------------------------

ASSIGN = re.compile("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)


def brute_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def base_of(text):
    return [x for x in secret_scan.find((text or "").encode()) if x[1] < 3]


def test_base_equals_brute_force_on_random_texts():
    rng = random.Random(5)
    parts = ["token", "Secret", "PASSWORD", "passwd", "api_key", "apikey", "api__key", "=", ":", " ", "  ", "'", '"', "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "abc", "x-1/", "é", "🙂", "\n", "K", "ſecret", "\x00", "g"]
    seen = Counter()
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert base_of(text) == brute_spans(text)
        seen.update(k for _, k, _ in brute_spans(text))
    assert min(seen[k] for k in range(3)) > 100


def test_a_failing_match_hides_what_it_covers():
    assert base_of("token:secret:abcdefgh") == [(0, 0, 12)]
    assert base_of("token:token:abcdefgh") == brute_spans("token:token:abcdefgh") == []
    assert base_of("é AKIA" + "A" * 16) == [(2, 1, 22)]


def base62(n):
    out = ""
    while n:
        n, d = divmod(n, 62)
        out = secret_scan.BASE62.decode()[d] + out
    return out.rjust(6, "0")


def test_checksums_decide():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = body + base62(zlib.crc32(body.encode()))
    # Published test vectors of the formats.
    wallet = "xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"
    key = "nsec1vl029mgpspedva04g90vltkh6fvh240zqtv9k0t9af8935ke9laqsnlfe5"
    names = [k.name for k in secret_scan.KINDS]
    for kind, token in [("github", "ghp_" + good), ("github", "ghs_" + good), ("npm", "npm_" + good), ("wallet", wallet), ("bech32", key), ("bech32", key.upper())]:
        text = f"é see {token}, please"
        assert [(s, names[k], e) for s, k, e in secret_scan.find(text.encode()) if k > 2] == [(6, kind, 6 + len(token))]
        for wrong in (token[:-1] + ("e" if token[-1] != "e" else "f"), "x" + token, token + "a", token[:-1]):
            assert not [1 for _, k, _ in secret_scan.find(wrong.encode()) if k > 2]
    assert [names[k] for _, k, _ in secret_scan.find(f"token={'ghp_' + good}".encode())] == ["assign", "github"]


def test_secret_query_and_awkward_texts(spark):
    docs = clashing(awkward_documents(spark).unionByName(spark.createDataFrame([
        (500, "é token = 'abcdef123' " + "a1" * 20, "en", "a", 0), (None, "AKIA" + "Z" * 20, None, None, None), (501, "password:" * 3000, "en", "a", 0), (502, "secret=" + "q" * 200_000, "en", "a", 0)],
        "doc_id long, text string, lang string, source string, n_chars long")))
    got = queries.op12_secret_scan(spark, folder(spark, documents=docs)).collect()
    want = []
    for r in docs.collect():
        spans = brute_spans(r.text)
        text = ",".join(f"{secret_scan.BASE[k]}:{s}:{e}" for s, k, e in spans)
        want.append((r.doc_id, *[sum(k == i for _, k, _ in spans) for i in range(3)], hashlib.sha256(text.encode()).hexdigest(), text))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert secret_scan.scan(docs.where("false")).count() == 0


def test_masked(spark):
    df = spark.createDataFrame([(1, "é token=abcdef and AKIA" + "B" * 16 + "!"), (2, None), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: r.m for r in df.join(secret_scan.scan(df), "doc_id").select("doc_id", secret_scan.masked("text", "found").alias("m")).collect()}
    assert got == {1: "é " + "*" * 12 + " and " + "*" * 20 + "!", 2: None, 3: "clean"}


# ---- conversations ----------------------------------------------------------------------------------------------

def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own[c].append((role or "", text or ""))
    made = {}
    for c in own:
        h, donor = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(donor, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, path in made.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for node, cs in members.items():
        if node:
            kids[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
    return [(min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), kids[node], leaves[node], saved[node],
             hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(made[c]) == len(node)).encode()).hexdigest()) for node, cs in members.items()]


SCHEMA = "conv_id long, turn long, role string, text string"


def talks(seed=6, n=300, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, ["user", "assistant"][t % 2], rng.choice(["hello", "é", "", "yes", "no" * 3])))
    return rows


def check_trie(spark, rows):
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = prefix_trie.trie(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_trie(rows)))


def test_trie_equals_brute_force(spark):
    check_trie(spark, talks())


def test_trie_of_long_conversations_peels_in_bands(spark, monkeypatch):
    """Bands of eight turns: survivors pass from band to band, past windows of prefix sums, and meet conversations that end there."""
    monkeypatch.setattr(prefix_trie, "BAND_CELLS", 500)
    rows = talks(7, 60, 30)
    for c, n in ((1000, 300), (1001, 300), (1005, 280), (2000, 129), (2001, 17)):
        rows += [(c, t, "user", f"turn {t}" if t % 50 else "pause") for t in range(n)]
    check_trie(spark, rows)


def test_bands_cover_all_depths():
    rng = random.Random(8)
    for _ in range(50):
        lengths = [(n, rng.randint(1, 10**rng.randint(0, 9))) for n in {rng.randint(0, 500) for _ in range(rng.randint(1, 20))}]
        made = prefix_trie.bands(lengths)
        depths = [d for above, below in made for d in range(below, above, -1)]
        assert depths == list(range(max(n for n, _ in lengths), 0, -1))
    assert prefix_trie.bands([]) == [] and prefix_trie.bands([(0, 5)]) == []
    assert len(prefix_trie.bands([(10**9, 1), (5, 10**9)])) < 10**6


def test_many_copies_and_one_first_turn(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(0, 3000, 5) for t in range(4)] + [(c, 0, "user", "same start") for c in range(10_000, 11_000)] + [(c, 1, "user", str(c)) for c in range(10_000, 11_000)]
    check_trie(spark, rows)


def test_awkward_turns(spark):
    rows = [
        (None, 0, "user", "no conversation"), (1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", ""), (2, 0, "", ""), (2, 0, "", ""), (2, 0, "", ""),
        (7, 5, "user", "x" * 300_000), (7, -1, "user", "before"), (-3, 0, "a", "bc"), (-4, 0, "ab", "c"), (-9, 0, "ab", "c"), (9007199254740993, 0, "user", "large"), (14, 0, None, ""),
    ]
    check_trie(spark, rows)
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 0, "a", "b")], SCHEMA)).count() == 0


def test_turnless_conversations(spark):
    """A conversation whose own turns all lie before its head's end, without a first of five, has none left."""
    c = next(c for c in range(11, 2000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 3)
    check_trie(spark, [(c, 0, "user", "gone"), (c, 1, "user", "gone")])


def test_ties_have_one_order(spark):
    rows = [(c, 0, "user", f"{i}") for c in (0, 20, 40) for i in range(8)]
    a, b = ([tuple(r) for r in prefix_trie.trie(spark.createDataFrame(x, SCHEMA).repartition(k)).collect()] for x, k in ((rows, 3), (rows[::-1], 5)))
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_trie_equals_sql(spark):
    d = folder(spark, conversations=spark.createDataFrame(talks(9, 200), SCHEMA))
    same(queries.op13_truncation_peeling(spark, d), *from_sql(d, "op13_truncation_peeling", "conversations"))

"""Near-duplicates and substring dedup against brute force, and their edge cases."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from reachlens.llm import setsketch, substring
from reachlens.llm.common import components, hash_words, salted_join

SCHEMA = "doc_id bigint, text string, lang string, copy int, _chunk string"


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", 1, "x") for i, t in zip(ids, texts)], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = lower(t)
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


def near_copies(rng, groups=12, copies=14):
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = [None, "", "  \n", "one", "One", "one two", "one Two", "é È word", "é È word"]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, 7)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size,percent,block", [(3, 85, 512), (5, 80, 512), (3, 85, 5)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(setsketch, "BLOCK_SETS", block)  # 5: groups over many blocks
    texts = near_copies(random.Random(block + size))
    n, comp = brute_components(texts, size, percent)
    got = {r.doc_id: r for r in setsketch.near_duplicates(frame(spark, texts), size, percent).collect()}
    assert len(got) == len(texts)
    assert [got[i].n_shingles for i in range(len(texts))] == n
    assert [got[i].component_id for i in range(len(texts))] == comp
    assert all(got[i].kept == (comp[i] == i) for i in got)


def test_near_duplicates_keep_every_column_and_row_count(spark):
    long = " ".join(f"v{i}" for i in range(30000))
    docs = frame(spark, ["a b c d e f", "a b c d e f", None, None, "", long, long + " tail"], [5, 3, 7, 8, 9, 1, 2])
    kept = setsketch.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7, 8, 9]


def test_near_duplicates_odd_ids_and_empty_table(spark):
    docs = frame(spark, ["a b c d", "a b c d", "x y z u", "x y z u"], [None, 4, 6, 6])
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in setsketch.near_duplicates(docs).collect())
    assert got == [(-1, 4, False), (4, 4, True), (6, 6, True), (6, 6, True)]
    assert setsketch.near_duplicates(docs.limit(0)).collect() == []


def test_one_of_each_judges_rows_and_the_next_stage_keeps_their_text(spark):
    def words(k, n=60):
        return " ".join(f"{k}{i}" for i in range(n))
    a, b, c, d, e = map(words, "abcde")
    near_d = d.rsplit(" ", 1)[0] + " other"
    rows = [(1, a), (1, a), (1, a),          # ingested three times
            (None, b), (None, b), (7, b),    # the null ids lose to 7
            (None, c), (None, c),            # one of them stays
            (2, d), (9, near_d), (9, e),     # 9 loses one text and keeps the other
            (4, None), (4, None), (5, "")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    kept = setsketch.one_of_each(docs)
    want = Counter([(1, a), (7, b), (None, c), (2, d), (9, e), (4, None), (4, None), (5, "")])
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want and kept.columns == docs.columns
    texts = [t for _, t in want.elements()]
    cut = Counter((r.doc_id, r.text) for r in substring.deduplicated(kept).collect())
    assert cut == want and not any(gone for _, gone, _ in brute_substrings(texts, 35))
    assert setsketch.one_of_each(docs.limit(0)).collect() == []


def test_one_of_each_of_repeated_rows_against_brute_force(spark):
    rng = random.Random(8)
    texts = [t for t in near_copies(rng, 6, 6) for _ in range(rng.randint(1, 3))]
    ids = [rng.choice([None, *range(30)]) for _ in texts]
    _, comp = brute_components(texts, 5, 80)
    want = {}
    for i, t, c in zip(ids, texts, comp):
        best = want.get(c, (True, None, []))
        this = (i is None, i, [])
        if c not in want or (this[0], this[1] or 0) < (best[0], best[1] or 0):
            want[c] = best = this
        if this[:2] == best[:2]:
            best[2].append(t)
    got = setsketch.one_of_each(frame(spark, texts, ids)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for _, i, _ in want.values())
    at = {t: c for t, c in zip(texts, comp) if t and t.split()}
    for r in got:
        if r.text in at:
            assert r.text in want[at[r.text]][2] and want[at[r.text]][1] == r.doc_id
    assert len(got) == len(want)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 2 ** 63, 3000, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:2400], rng.integers(0, 2 ** 63, 600, dtype=np.uint64))))
    ra, rb = setsketch.registers(a), setsketch.registers(b)
    assert (np.maximum(ra, rb) == setsketch.registers(np.union1d(a, b))).all()
    up, same = int((ra > rb).sum()), int((ra == rb).sum())
    est = setsketch.likely_jaccard(np.array([up]), np.array([setsketch.REGISTERS - up - same]), np.array([same]),
                                   np.array([len(a)]), np.array([len(b)]))[0]
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(est - true) < 0.16  # five standard deviations
    for t in (0.8, 0.85):
        bands, rows = setsketch.banding(t)
        assert (1 - t ** rows) ** bands < 1e-5 and bands * rows <= setsketch.REGISTERS


def test_word_hashes_follow_white_space():
    texts = ["a\tb\x0bc\x0cd\re\nf g".encode(), b"", "a b A".encode(), b" a  "]
    h, bounds = hash_words(texts, lower=True)
    assert list(np.diff(bounds)) == [len(t.split()) for t in texts]
    assert h[0] == h[bounds[3]] and h[bounds[2]] != h[0]


def test_components_and_salted_join(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.comp for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 50)], "k bigint, i bigint")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, v string")
    assert Counter(r.v for r in salted_join(left, right, "k", "i").collect()) == {"x": 50, None: 1}


def brute_substrings(texts, window):
    words = [words_of(t) for t in texts]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("seed,window,chunk,part", [(1, 35, 1 << 22, 1 << 24), (2, 35, 4000, 3000), (3, 8, 1500, 500),
                                                    (4, 1, 900, 100), (5, 2, 900, 100)])
def test_substrings_against_brute_force(spark, seed, window, chunk, part):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60 if window > 3 else 3000)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(window, 2 * window + 9))] for _ in range(4)]
    texts = [None, "", "short one", "é " * 50]
    for _ in range(40):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(passages)
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    got = substring.without_repeats(frame(spark, texts), window, chunk, part).collect()
    want = brute_substrings(texts, window)
    assert len(got) == len(texts)
    for r in got:
        n, gone, kept = want[r.doc_id]
        assert (r._n_words, r._n_removed) == (n, gone)
        assert b" ".join(words_of(r.text)) == kept
        assert gone or r.text == texts[r.doc_id]


def test_substrings_columns_repeated_rows_and_empty_table(spark):
    text = " ".join(f"v{i}" for i in range(40))
    docs = frame(spark, [text, text, "tail " + text[4:], " ".join(f"u{i}" for i in range(9000))], [1, 1, 2, 3])
    out = substring.deduplicated(docs.withColumn("n_chars", F.lit(7)))
    rows = sorted((r.doc_id, len(r.text), r.n_chars, r.lang) for r in out.collect())
    assert [r[:2] for r in rows[:2]] == [(1, 0), (1, 0)] and rows[2][0] == 2 and rows[3][2] == 7
    assert out.columns == [*docs.columns, "n_chars"] and out.where("_chunk <> 'x'").count() == 0
    assert substring.without_repeats(docs.limit(0)).collect() == []



@pytest.mark.parametrize("seed,window,size", [(1, 35, 300), (2, 4, 40), (3, 1, 10), (4, 7, 1)])
def test_slices_hold_the_text_and_its_windows(seed, window, size):
    rng = random.Random(seed)
    for _ in range(40):
        raw = "".join(rng.choice(["é", "ab", "word", " ", "\n", "  ", "\t"]) for _ in range(rng.randrange(400))).encode()
        parts = list(substring.slices(raw, size, window))
        assert b"".join(t[b:b + n] for t, _, _, b, n in parts) == raw
        assert sum(own for _, _, own, _, _ in parts) == len(raw.split())
        words, at = raw.split(), 0
        for text, lead, own, _, _ in parts:
            lo, hi = max(0, at - window + 1), min(len(words), at + own + window - 1)
            assert lead == at - lo and text.split() == words[lo:hi]
            at += own


@pytest.mark.parametrize("window,size", [(35, 2000), (6, 150), (1, 60)])
def test_long_texts_in_slices_against_brute_force(spark, window, size):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(400 if window > 3 else 4000)]
    shared = [rng.choice(vocabulary) for _ in range(3 * window + 20)]
    texts = []
    for n in (3000, 2500, 900, 40, 0):
        w = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(4 if n else 0):
            w[rng.randrange(len(w)):0] = shared
            at = rng.randrange(len(w))
            w[at:at] = shared[:window + rng.randrange(20)]
        texts.append(rng.choice([" ", "\n ", "\t"]).join(w))
    texts += [" ".join(f"once{i}" for i in range(2000)) + "  \n", None, texts[0]]
    docs = frame(spark, texts).withColumn("piece", F.lit(5)).withColumn("other", F.lit("x")).withColumn("_kept", F.lit(1))
    got = substring.without_repeats(docs, window, 3000, 2000, slice_bytes=size).collect()
    assert len(got) == len(texts)
    for r, (n, gone, kept) in ((r, brute_substrings(texts, window)[r.doc_id]) for r in got):
        assert (r._n_words, r._n_removed, r.piece, r.other) == (n, gone, 5, "x")
        assert r.text == texts[r.doc_id] if not gone else r.text.encode() == kept


def test_a_third_of_all_rows_is_one_row(spark):
    same = " ".join(f"same{i}" for i in range(50))
    texts = [same] * 900 + [" ".join(f"t{k}w{i}" for i in range(45)) for k in range(1800)]
    docs = frame(spark, texts, [1] * 900 + list(range(2, 1802)))
    names = substring._Names(docs.columns)
    rows, _, size = substring._dealt(docs, names, 35, 20_000, 1 << 20)
    most = rows.where("doc_id = 1").groupBy(names.chunk).count().agg(F.max("count")).head()[0]
    assert size == sum(map(len, texts)) and most < 60  # of 900 in 39 chunks
    got = Counter((r._n_words, r._n_removed) for r in substring.without_repeats(docs, chunk_bytes=20_000).collect())
    assert got == {(50, 50): 900, (45, 0): 1800}


def test_blocks_are_bounded_by_shingles_too(spark, monkeypatch):
    """Long documents of one template: few documents a block, and the same components."""
    monkeypatch.setattr(setsketch, "BLOCK_SHINGLES", 900)
    rng = random.Random(6)
    base = [f"t{i}" for i in range(300)]
    texts = []
    for k in range(24):
        w = [*base]
        for j in rng.sample(range(300), 3 if k % 3 else 25):
            w[j] = f"own{k}x{j}"
        texts.append(" ".join(w))
    _, comp = brute_components(texts, 3, 85)
    sizes = []
    monkeypatch.setattr(setsketch, "_blocks", lambda rows, keys, *rest, real=setsketch._blocks: (
        sizes.append(rows.groupBy(*keys).count().agg(F.max("count")).head()[0]), real(rows, keys, *rest))[1])
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(frame(spark, texts)).collect()}
    assert [got[i] for i in range(24)] == comp and max(sizes) < 24

"""Fingerprints, quality, decontamination, mixing, chat formatting and the pipeline."""

import hashlib
import math
import os
import random
import subprocess
import sys
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from conftest import ROOT
from pyspark.sql import functions as F
from reachlens.llm import chat, decontaminate, merkle, mixing, quality, queries
from reachlens.llm.common import written

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


# -- fingerprints -----------------------------------------------------------

def fingerprint_of(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.f for r in merkle.with_fingerprint(df, "text", "f").orderBy("i").collect()]


def test_roots_test_equality_and_branches_locate_edits(spark):
    lines = [f"line {i} has some words of its own {i * 7}" for i in range(40)]
    edited = [*lines]
    edited[17] = "another line"
    a, b, c = fingerprint_of(spark, "\n".join(lines), "\n".join(edited), "\n".join(lines))
    assert a == c and a.split(":")[0] != b.split(":")[0]
    df = spark.createDataFrame([(a, b)], "a string, b string")
    row = df.select(merkle.changed_paragraphs(F.col("a"), F.col("b")).alias("at"),
                    merkle.likeness(F.col("a"), F.col("b")).alias("near")).head()
    assert row["at"] == [17] and 0.9 < row.near < 1
    changed = sum(x not in b.split(":")[1].split(",") for x in a.split(":")[1].split(","))
    assert 1 <= changed <= 2


def test_runs_are_cut_by_content_and_hashed_into_the_tree(spark):
    rng = random.Random(7)
    words = [f"word{rng.randrange(10_000)}" for _ in range(200)]
    text = " ".join(words)  # one paragraph
    middle = " ".join([*words[:90], "one", "more", *words[90:]])
    first, front, inner, spaced, other = fingerprint_of(
        spark, text, "Yet " + text, middle, text.replace(" ", "  ", 1), " ".join(reversed(words)))
    near = spark.createDataFrame([(first, x) for x in (front, inner, spaced, other)], "a string, b string").select(
        merkle.likeness(F.col("a"), F.col("b")).alias("near")).collect()
    assert all(r.near > 0.8 for r in near[:3]) and near[3].near < 0.2
    assert len({x.split(":")[0] for x in (first, front, inner, spaced, other)}) == 5
    # the paragraph's node comes from its leaves alone
    runs, run = [], ""
    for i, w in enumerate(words):
        run += (" " if i else "") + w
        if hashlib.md5(w.encode()).hexdigest()[0] in "01":
            runs.append(run)
            run = ""
    hashes = [hashlib.sha256(r.encode()).hexdigest() for r in [*runs, *([run] if run else [])]]
    root, sections, paragraphs, leaves = first.split(":")
    assert leaves.split(",") == [h[:8] for h in hashes]
    assert paragraphs == hashlib.sha256("".join(hashes).encode()).hexdigest()[:12]
    section = hashlib.sha256(hashlib.sha256("".join(hashes).encode()).hexdigest().encode()).hexdigest()
    assert sections == section[:12] and root == hashlib.sha256(section.encode()).hexdigest()


def test_edited_texts_follow_the_next_document(spark):
    rows = [(9, "abcdefghi", "s"), (5, None, "s"), (4, "é" * 7, "s"), (2, "xy", "s"), (1, "one two three four", "s")]
    docs = frame(spark, rows)
    text = {i: t or "" for i, t, _ in rows}
    after = {9: 5, 5: 4, 4: 2, 2: 1, 1: 9}
    got = {r.doc_id: r for r in merkle.edited_fingerprints(docs, bounds=3).collect()}
    assert len(got) == len(rows)
    for i in got:
        n = len(text[i])
        want = text[i][:n - n // 3] + (text[after[i]][:n // 3] if n // 3 else "")
        assert got[i].edited == want and got[i].n_chars == n
    fp = {i: got[i].fingerprint for i in got}
    assert all(got[i].next_fingerprint == fp[after[i]] for i in got)


def test_edited_texts_of_odd_tables(spark):
    docs = frame(spark, [(3, "a b c d e f", "s"), (3, "a b c d e f", "s"), (3, "0 other", "s"), (None, "lost text", "s"),
                         (7, "z" * 100000, "s")]).withColumn("fingerprint", F.lit("x"))
    got = merkle.edited_fingerprints(docs).collect()
    assert len(got) == 5
    assert {r.next_fingerprint for r in got if r.doc_id == 7} == set(fingerprint_of(spark, "0 other"))
    one = merkle.edited_fingerprints(docs.where("doc_id = 7")).head()
    assert one.next_fingerprint == one.fingerprint
    assert merkle.edited_fingerprints(docs.limit(0)).collect() == []


def test_likeness_parts_edited_from_next(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op3_merkle(spark, SF).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    long = [r for r in rows if r.n_chars > 400]
    assert np.mean([r.near_edited > 0.4 for r in long]) > 0.95
    assert np.mean([r.near_next for r in long]) < 0.1


# -- quality ----------------------------------------------------------------

def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = (queries.op6_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
            .where("held_out").collect())
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    import zlib
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


def test_quality_never_sees_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.quality_scores(docs, turned).collect()}
    assert a == b


def test_quality_of_odd_tables(spark):
    docs = frame(spark, [(1, None, "s"), (1, "", "s"), (None, "x", "s"), (2, "long " * 60000, "s")])
    labels = spark.createDataFrame([(1, 1, None), (2, None, None), (None, 0, 0)], "doc_id bigint, quality int, score int")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.accepted(docs, labels).columns == docs.columns
    none = labels.limit(0)
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), none).collect() == []


def test_trees_against_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit(x, y, trees=10, depth=3)
    for row, s in zip(x[:50], model.score(x[:50])):
        total = model.base
        for feature, cut, value in zip(model.feature, model.cut, model.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            total += value[node - len(feature)]
        assert abs(1 / (1 + math.exp(-total)) - s) < 1e-12
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def brute_statistics(text):
    """The statistics of a text, one after the other in plain Python."""
    if not text:
        return [0.0] * len(quality.FEATURES)
    kinds = {"stop": ".?;:", "comma": ",", "mark": "!", "bar": "|", "space": " \t\r\x0b\x0c", "line": "\n"}
    share = Counter()
    for byte in text.encode():
        char = chr(byte)
        share["high" if byte > 127 else "lower" if char.islower() else "upper" if char.isupper() else "digit"
              if char.isdigit() else next((k for k, v in kinds.items() if char in v), "other")] += 1
    raw, size = text.encode(), len(text.encode())
    words, lines = raw.split(), raw.split(b"\n")
    row = [share[c] / size for c in ("lower", "upper", "digit", "high", "stop", "comma", "mark", "bar", "other", "space",
                                     "line")] + [math.log1p(size), math.log1p(len(words))]
    if not words:
        return row + [0.0] * (len(quality.FEATURES) - len(row))
    small, lens = [w.lower() for w in words], [len(w) for w in words]

    def repeated(n):
        parts = [tuple(small[i:i + n]) for i in range(len(small) - n + 1)]
        return 1 - len(set(parts)) / max(1, len(parts))
    return row + [sum(lens) / len(words), len(set(small)) / len(words), max(Counter(small).values()) / len(words),
                  repeated(2), repeated(4), size / len(lines), len(set(lines)) / len(lines),
                  max(map(len, lines)) / size, max(lens), sum(n <= 2 for n in lens) / len(words), len(set(raw))]


def test_statistics_against_plain_python():
    rng = random.Random(12)
    texts = ["", " \n\t", "A", "é é É\n|x|! 12.", "one two one two one two\n\nONE two"]
    texts += ["".join(rng.choice(["ab", "Ab", "ß", "the ", " ", "\n", ".", ",", "!", "|", "7", "#", "\t"])
                      for _ in range(rng.randrange(300))) for _ in range(80)]
    got = quality.statistics([t.encode() for t in texts])
    for t, row in zip(texts, got):
        assert np.allclose(row, brute_statistics(t)), t


def brute_boosting(x, y, trees, depth):
    """Scores of boosted trees, with lists and loops."""
    n, width = len(y), len(x[0])
    share = min(max(sum(y) / n, 1e-3), 1 - 1e-3)
    edges = [sorted(set(np.quantile([r[j] for r in x], np.linspace(0, 1, quality.BINS + 1)[1:-1]).tolist()))
             for j in range(width)]
    total = [math.log(share / (1 - share))] * n
    for _ in range(trees):
        g = [1 / (1 + math.exp(-t)) - v for t, v in zip(total, y)]
        h = [max(p * (1 - p), 1e-6) for p in (1 / (1 + math.exp(-t)) for t in total)]

        def value(rows):
            return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + quality.L2)

        def grow(rows, left):
            best = (1e-6, None, None)
            for j in range(width) if left and len(rows) >= 2 else ():
                for cut in edges[j]:
                    low = [i for i in rows if x[i][j] <= cut]
                    high = [i for i in rows if x[i][j] > cut]
                    if min(sum(h[i] for i in low), sum(h[i] for i in high)) >= quality.MIN_WEIGHT * 0.05:
                        gain = value(low) + value(high) - value(rows)
                        if gain > best[0] + 1e-12:
                            best = (gain, low, high)
            if best[1] is None:
                step = -quality.RATE * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + quality.L2) if rows else 0.0
                for i in rows:
                    total[i] += step
            else:
                grow(best[1], left - 1)
                grow(best[2], left - 1)
        grow(list(range(n)), depth)
    return [1 / (1 + math.exp(-t)) for t in total]


def test_boosting_against_plain_python():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.normal(size=120) > 0.3).astype(float)
    model = quality.fit(x, y, trees=4, depth=3)
    assert np.allclose(model.score(x), brute_boosting(x.tolist(), y.tolist(), 4, 3))


# -- decontamination --------------------------------------------------------

def test_decontamination_finds_substituted_passages(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [[rng.choice(vocabulary) for _ in range(n)] for n in (8, 15, 30, 59, 150)] + [["w1", "w2"]]
    rows, want = [(0, None, "s"), (1, "", "s")], set()
    for i in range(2, 90):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            n = rng.randrange(5)
            passage = [*items[n]]
            for j in range(4, len(passage), 5):  # every fifth word replaced
                passage[j] = "other"
            w[5:5] = passage
            want.add((i, n))
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper(), "s"))
    benchmark = spark.createDataFrame([(n, " ".join(w), "x") for n, w in enumerate(items)] + [(9, None, "x")],
                                      "item_id bigint, text string, words string")
    for options in ({}, {"max_seeds": 60}):
        got = {(r.doc_id, n) for r in decontaminate.contaminated(frame(spark, rows), benchmark, **options).collect()
               for n in r.item_ids}
        assert got == want
    clean = decontaminate.decontaminated(frame(spark, rows), benchmark)
    assert clean.columns == frame(spark, rows).columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _, _ in rows} - {i for i, _ in want}


def test_masks_leave_no_allowed_substitution_out():
    """Every way to replace as many tokens as the rule lets pass leaves a mask whole."""
    for n in range(1, decontaminate.WINDOW + 1):
        allowed = next(k for k in range(n, -1, -1) if n - k >= decontaminate.SIMILARITY * n)
        placed = [sum(1 << (at + i) for i, bit in enumerate(mask) if bit == "1")
                  for mask, low, high in decontaminate.SEEDS if low <= n <= high for at in range(n - len(mask) + 1)]
        for gone in combinations(range(n), allowed):
            hole = sum(1 << i for i in gone)
            assert any(not p & hole for p in placed), (n, gone)
    for n in range(1, decontaminate.SEGMENT + 1):  # no item is without a mask
        assert any(low <= n <= high and len(mask) <= n for mask, low, high in decontaminate.SEEDS)


def brute_overlap(words, item):
    width = min(len(item), decontaminate.WINDOW)
    for shift in range(-len(item), len(words)):
        same = [0 <= shift + j < len(words) and words[shift + j] == item[j] for j in range(len(item))]
        if any(sum(same[a:a + width]) >= decontaminate.SIMILARITY * width for a in range(len(item) - width + 1)):
            return True
    return False


@pytest.mark.parametrize("max_seeds", [1 << 18, 10])
def test_decontamination_equals_a_search_without_seeds(spark, max_seeds):
    rng = random.Random(max_seeds)
    items = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(n) for _ in range(n)] for n in range(1, 31)]
    items += [["w"] * 3, [rng.choice("xyz") for _ in range(70)]]
    docs = []
    for i in range(160):
        words = [rng.choice("abcxyzw") for _ in range(rng.randrange(12))]
        for _ in range(2):
            item = [*items[rng.randrange(len(items))]]
            part = item[rng.randrange(max(1, len(item) - 19)):][:rng.choice([len(item), 20, 25])]
            for j in rng.sample(range(len(part)), min(len(part), rng.randint(0, 1 + len(part) // 5))):
                part[j] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((i % 150, " ".join(words), "s"))
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)] + [(99, ""), (98, None)],
                                      "item_id bigint, text string")
    want = {(i, n) for i, text, _ in docs for n, item in enumerate(items) if brute_overlap(text.split(), item)}
    got = {(r.doc_id, n) for r in decontaminate.contaminated(frame(spark, docs), benchmark, max_seeds=max_seeds).collect()
           for n in r.item_ids}
    assert got == want and len({n for _, n in want}) > 25
    with pytest.raises(ValueError):
        decontaminate.hits(frame(spark, docs), benchmark, similarity=0.7)


@pytest.mark.parametrize("max_seeds", [1 << 18, 10])
def test_decontamination_of_documents_of_many_chunks(spark, max_seeds):
    """Passages across every border between chunks, over the ends, and in documents as long as a chunk."""
    rng, step = random.Random(5), decontaminate.CHUNK_STEP
    items = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(n) for _ in range(n)] for n in (1, 3, 5, 8, 20, 33, 90)]
    docs, want = [], set()
    for i in range(60):
        words = ["u"] * rng.choice([decontaminate.CHUNK - 1, decontaminate.CHUNK, decontaminate.CHUNK + 1, 3 * step + i])
        n = rng.randrange(len(items))
        part = items[n][-25:]
        for j in rng.sample(range(len(part)), rng.randint(0, 1 + len(part) // 5)):
            part[j] = "other"
        at = rng.choice([0, step, 2 * step, decontaminate.CHUNK, len(words)]) - rng.randrange(26)
        if i % 10 == 0:
            part, at = part[4:], 0  # what is before the document differs
        at = min(max(at, 0), len(words))
        words[at:at] = part
        docs.append((i, " ".join(words), "s"))
        want |= {(i, k) for k, item in enumerate(items) if brute_overlap(words, item)}
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)], "item_id bigint, text string")
    got = {(r.doc_id, n) for r in decontaminate.contaminated(frame(spark, docs), benchmark, max_seeds=max_seeds).collect()
           for n in r.item_ids}
    assert got == want and len(want) > 20
    exact = frame(spark, [(0, "u " * 1000 + " ".join(items[4]), "s")])
    assert {r.offset for r in decontaminate.hits(exact, benchmark, max_seeds=max_seeds).collect() if r.item_id == 4} == {1000}


#: a document as long as the longest in the test tables that quotes the benchmark all along
QUOTES = """
import sys
from pyspark.sql import SparkSession, functions as F
from reachlens.llm import decontaminate
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).config("spark.sql.shuffle.partitions", "2").getOrCreate())
passage = " ".join(f"word{i}" for i in range(40))
docs = spark.range(2).select(F.col("id").alias("doc_id"), F.repeat(F.lit(passage + " "), 500).alias("text"))
benchmark = spark.createDataFrame([(n, passage) for n in range(3)], "item_id bigint, text string")
found = decontaminate.contaminated(docs, benchmark).collect()
assert sorted((r.doc_id, r.item_ids) for r in found) == [(0, [0, 1, 2]), (1, [0, 1, 2])], found
print("FOUND")
"""


def test_hits_of_a_document_need_no_memory_for_each(scratch):
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--driver-memory 900m pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", QUOTES, scratch], env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND" in run.stdout, run.stderr[-2000:]


def test_decontamination_of_odd_tables(spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id bigint, text string")
    docs = frame(spark, [(4, "x A B C d e f g h i j k l y", "s"), (4, "clean", "s"), (None, "clean too", "s"),
                         (5, "u " * 30000, "s")])
    assert {r.doc_id for r in decontaminate.decontaminated(docs, benchmark).collect()} == {None, 5}
    assert decontaminate.decontaminated(docs, benchmark.limit(0)).count() == 4
    assert decontaminate.decontaminated(docs.limit(0), benchmark).collect() == []


# -- mixing -----------------------------------------------------------------

def poisson(u, mean):
    term = total = math.exp(-mean)
    k = 0
    while total <= u and k < mixing.TERMS:
        k += 1
        term *= mean / k
        total += term
    return k


def test_copies_are_inverted_poisson_numbers(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 50), rng.choice(["big"] * 8 + ["small", None])) for i in range(600)]
    docs = frame(spark, rows)
    weights = {"big": 1.0, "small": 2.0, None: 40.0}
    chars = Counter()
    for _, t, s in rows:
        chars[s] += len(t)
    total = sum(chars.values())
    rate = {s: w / 43.0 * total / chars[s] for s, w in weights.items()}
    assert rate[None] > 5
    out = mixing.mixed(docs, weights).collect()
    got = Counter(r.doc_id for r in out)
    for i, _, s in rows:
        parts = max(1, math.ceil(rate[s] / mixing.PART))
        draws = [int(hashlib.md5(f"{mixing.SEED}|{i}|{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
                 for j in range(1, parts + 1)]
        assert got[i] == sum(poisson(u, rate[s] / parts) for u in draws)
    keys = [r.order_key for r in out]
    assert keys == sorted(keys) and len(set((r.doc_id, r.copy) for r in out)) == len(out)
    share = Counter()
    for r in out:
        share[r.source] += len(r.text)
    assert abs(share[None] / sum(share.values()) - 40 / 43) < 0.1


def test_mixing_of_odd_tables(spark, monkeypatch):
    docs = frame(spark, [(1, None, None), (None, "", "s"), (2, "t" * 100000, "a"), (2, "t" * 100000, "a")])
    docs = docs.withColumn("copy", F.lit("x"))
    a = sorted(map(str, mixing.mixed(docs).collect()))
    rates = {r._source: r.rate for r in mixing.rates(docs).collect()}
    assert rates == {mixing.NULL: 1.0, "s": 1.0, "a": 1.0}
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mixed(docs).collect())) == a
    assert {r.rate for r in mixing.rates(docs, {}).collect()} == {1.0}
    assert mixing.mixed(docs.limit(0)).collect() == []


def test_rows_without_an_id_draw_numbers_of_their_own(spark):
    """2000 rows without a doc_id: the copies are Poisson distributed, whatever the seed."""
    docs = frame(spark, [(None, f"some text {i % 7}", "a") for i in range(2000)] + [(1, "x" * 9, "b")])
    for seed in ("s1", "s2"):
        counts = Counter(r.copy for r in mixing.mixed(docs, {"a": 1.0, "b": 1.0}, 2.0, seed).where("source = 'a'").collect())
        assert 1700 < sum(counts.values()) < 2300 and counts[1] < 1500 and counts[2] > 300
    out = mixing.mixed(docs, {"a": 1.0, "b": 1.0}, 2.0)
    keys = [r.order_key for r in out.collect()]
    assert keys == sorted(keys)  # a global order, range after range



# -- chat -------------------------------------------------------------------

def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, path string")


def test_packs_share_turns_and_read_back(spark):
    rng = random.Random(6)
    nasty = ["<turn>", "</turn>\n", "\\l", "\\", "<", "a\nb", "", None, "é😀", "\\### Assistant: </turn> ok", "n"]
    rows = []
    for c in range(80):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None, "a<\nb\\"]) if t else "user",
                         rng.choice(nasty) if t > 1 else "shared start", "x"))
    packs = written(chat.prefix_tree_packs(conversations(spark, rows), 300, 20), "packs")
    turns = defaultdict(list)
    for c, t, r, x, _ in rows:
        turns[c].append((t, r or "", x or ""))
    got = {r.conv_id: r for r in chat.read_back(packs).collect()}
    assert set(got) == set(turns)
    for c, said in turns.items():
        said.sort()
        loss = "".join(x for _, r, x in said if r == "assistant")
        assert got[c].n_turns == len(said) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in said).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    emitted = 0
    for p in packs.collect():
        emitted += len(p.nodes)
        children = [(n.parent, p.text[n.start:n.end]) for n in p.nodes]
        assert len(set(children)) == len(children)  # each shared turn once a pack
        for k, n in enumerate(p.nodes):
            assert n.parent < k and n.start == (p.nodes[k - 1].end if k else 0)
            seen, up = set(), n.parent
            while up >= 0:
                seen |= set(range(p.nodes[up].start, p.nodes[up].end))
                up = p.nodes[up].parent
            assert seen == {i for a in n.attend for i in range(a.start, a.end)}
            assert n.position == len(seen)
    assert emitted < len(rows)


def test_chat_of_odd_tables(spark):
    rows = [(None, None, None, None, "x"), (1, 0, "user", "same", "x"), (1, 0, "user", "same", "x"),
            (2, 0, "assistant", "y" * 300000, "x")]
    got = {r.conv_id: r for r in chat.read_back(chat.prefix_tree_packs(conversations(spark, rows))).collect()}
    assert got[1].n_turns == 2 and got[None].n_turns == 1 and got[2].loss_chars == 300000
    assert chat.read_back(chat.prefix_tree_packs(conversations(spark, rows).limit(0))).collect() == []


def test_long_conversations_are_cut_into_bounded_runs(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"<turn {t}>", "x") for t in range(20000)]
    rows += [(c, t, *rows[t][2:4], "x") for c in (2, 3) for t in range(150)] + [(3, 150, "user", "other", "x")]
    rows += [(4, t, "assistant", "y" * 40000, "x") for t in range(4)] + [(None, t, "user", "z", "x") for t in range(130)]
    packs = written(chat.prefix_tree_packs(conversations(spark, rows)), "packs")
    held = packs.collect()
    assert max(len(p.nodes) for p in held) < 4000 and len(held) > 4
    runs = defaultdict(list)
    where = {}
    for p in held:
        children = [(n.parent, n.position, p.text[n.start:n.end]) for n in p.nodes]
        for m in p.members:
            spans = chat.conversation_spans(p.asDict(recursive=True), m.leaf)
            assert len(spans) <= chat.RUN_TURNS
            runs[m.conv_id].append((m.run, m.more))
            where[m.conv_id, m.run] = (spans[0]["position"], spans[-1]["position"] + spans[-1]["end"] - spans[-1]["start"])
        assert len(set(children)) == len(children)
    for c, found in runs.items():
        assert sorted(found) == [(i, i < len(found) - 1) for i in range(len(found))]
        assert all(where[c, i][0] == (where[c, i - 1][1] if i else 0) for i in range(len(found)))
    assert len(runs[1]) == -(-20000 // chat.RUN_TURNS) and len(runs[4]) == 4
    turns = defaultdict(list)
    for c, t, r, x, _ in rows:
        turns[c].append((t, r, x))
    got = {r.conv_id: r for r in chat.read_back(packs).collect()}
    assert set(got) == set(turns)
    for c, said in turns.items():
        loss = "".join(x for _, r, x in said if r == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(said), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in said).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


# -- pipeline ---------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        at[name] = (before, docs)
        if name != "mixing":
            assert docs.columns == before.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "benchmark", "mixing"]
    before, after = at["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = after.join(labels, "doc_id")
    assert left.where("quality = 0").count() <= 0.1 * labels.where("quality = 0").count() + 1
    before, after = at["near_duplicates"]
    from test_near_and_substring import brute_components, brute_substrings
    rows = before.orderBy("doc_id").collect()
    _, comp = brute_components([r.text for r in rows], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == [r.doc_id for i, r in enumerate(rows) if comp[i] == i]
    before, after = at["substrings"]
    rows = before.orderBy("doc_id").collect()
    want = {r.doc_id: w for r, w in zip(rows, brute_substrings([r.text for r in rows], 35))}
    for r in after.collect():
        assert b" ".join(r.text.encode().split()) == want[r.doc_id][2] and r.n_chars == len(r.text)
    before, after = at["benchmark"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert gone == {r.doc_id for r in before.collect() if any(i in r.text for i in items)}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_odd_tables(spark, name, stage):
    from test_near_and_substring import brute_substrings
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").head().text
    prose = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, None), (1, "", "s"), (None, "a b c d e f g", None), (3, item, "s"), (None, item, "t"),
            (5, prose, "s"), (5, prose, "s"), (6, "other " + prose, "s")]
    odd = frame(spark, rows).withColumn("copy", F.lit(1)).withColumn("block", F.lit("clash"))
    out = stage(spark, odd, SF)
    got = Counter((r.doc_id, r.text) for r in out.collect())
    given = Counter((i, t) for i, t, _ in rows)
    if name == "quality":  # every row is judged by its text alone
        model = quality.train(quality.features(spark.read.parquet(f"{SF}/documents.parquet")),
                              spark.read.parquet(f"{SF}/labels.parquet"))
        alone = {t: quality.statistics([(t or "").encode()]).astype(np.float32) for _, t, _ in rows}
        assert set(got) <= set(given) and len({t in {u for _, u in got} for t in (None, "")}) == 1
        assert all(0 <= model.score(x)[0] <= 1 for x in alone.values())
    elif name == "near_duplicates":  # one row of each group, rows without words stay
        assert got == Counter([(1, None), (1, ""), (None, "a b c d e f g"), (3, item), (5, prose)])
    elif name == "substrings":
        want = Counter()
        for (i, t, _), (_, gone, kept) in zip(rows, brute_substrings([t for _, t, _ in rows], 35)):
            want[i, kept.decode() if gone else t] += 1
        assert got == want
    elif name == "benchmark":  # also the clean row without an id, as another row without one holds an item
        assert got == Counter((i, t) for i, t, _ in rows if i not in (None, 3))
    else:
        assert out.columns[-2:] == ["copy", "order_key"] and set(got) <= set(given)
    if name != "mixing":
        assert out.columns == odd.columns and set(r.block for r in out.collect()) <= {"clash"}
    assert stage(spark, odd.limit(0), SF).collect() == []

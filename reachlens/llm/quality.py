"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the text alone, counted over byte classes, lines and words
of whole texts.  Training takes a bounded hash sample of the labelled rows
(``sample_rows``; about that many rows of numbers reach the driver), bins each
statistic at quantiles and grows depth-limited trees on gradient histograms with
numpy.  The trees are flattened into arrays (feature, cut, leaf value; complete
binary trees), which are a few kilobytes for any corpus, and every document is
scored by vectorised traversal.

Defined results: null and empty texts are scored by their (zero) statistics;
null labels are left out; without labels, or with one class only, every score
is the share of good labels (0.5 without any); rows repeating a doc_id are
scored one by one; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlens.llm.common import batches_by_size, hash_words, raw_texts, written

SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
TREES, DEPTH, BINS, RATE, L2, MIN_WEIGHT = 60, 4, 64, 0.15, 1.0, 3.0

_CLASSES = ("lower", "upper", "digit", "high", "stop", "comma", "mark", "bar", "other", "space", "line")
_CLASS_OF = np.full(256, _CLASSES.index("other"), np.uint8)
for _name, _bytes in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                      ("high", range(128, 256)), ("stop", b".?;:"), ("comma", b","), ("mark", b"!"),
                      ("bar", b"|"), ("space", b" \t\r\v\f"), ("line", b"\n")):
    _CLASS_OF[list(_bytes)] = _CLASSES.index(_name)

FEATURES = (*(f"share_{c}" for c in _CLASSES), "log_bytes", "log_words", "mean_word", "distinct_words",
            "top_word", "repeated_pairs", "repeated_fours", "mean_line", "distinct_lines", "top_line",
            "longest_word", "short_words", "distinct_bytes")


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    words, bounds = hash_words(texts, lower=True)
    for i, text in enumerate(texts):
        if not text:
            continue
        per_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        classes = np.bincount(_CLASS_OF, weights=per_byte, minlength=len(_CLASSES))
        w = words[bounds[i]:bounds[i + 1]]
        lines = text.split(b"\n")
        row = list(classes / len(text)) + [np.log1p(len(text)), np.log1p(len(w))]
        if len(w):
            counts = np.unique(w, return_counts=True)[1]
            lens = np.array([len(x) for x in text.split()])
            with np.errstate(over="ignore"):
                pairs = w[:-1] * np.uint64(3) + w[1:]
                fours = pairs[:-2] * np.uint64(7) + pairs[2:]
            row += [lens.mean(), len(counts) / len(w), counts.max() / len(w),
                    1 - len(np.unique(pairs)) / max(1, len(pairs)),
                    1 - len(np.unique(fours)) / max(1, len(fours)),
                    len(text) / len(lines), len(set(lines)) / len(lines),
                    max(map(len, lines)) / len(text), lens.max(), (lens <= 2).mean(),
                    np.count_nonzero(per_byte)]
        else:
            row += [0.0] * (len(FEATURES) - len(row))
        out[i] = row
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_size(batches, "text"):
            x = statistics(raw_texts(batch.column("text"))).astype(np.float32)
            flat = pa.array(x.ravel(), pa.float32())
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, x array<float>")


@dataclass
class Trees:
    """Complete binary trees as arrays: inner node k has children 2k+1, 2k+2."""
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray      # go right where x > cut
    value: np.ndarray    # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the logistic loss on rows ``x`` and labels ``y``."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    none = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)),
                 float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    n, total, made = len(y), np.full(len(y), none.base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = (1e-6, None, None)
            gk, hk = g[rows], h[rows]
            sums = gk.sum(), hk.sum()
            if len(rows) >= 2:
                for j, e in enumerate(edges):
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, gk, len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, hk, len(e) + 1))[:-1]
                    gain = gl ** 2 / (hl + L2) + (sums[0] - gl) ** 2 / (sums[1] - hl + L2) \
                        - sums[0] ** 2 / (sums[1] + L2)
                    gain[(hl < MIN_WEIGHT * 0.05) | (sums[1] - hl < MIN_WEIGHT * 0.05)] = -1
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), j, int(gain.argmax()))
            go_right = np.zeros(len(rows), bool)
            if best[1] is not None:
                feature[k], cut[k] = best[1], edges[best[1]][best[2]]
                go_right = binned[rows, best[1]] > best[2]
            node[rows] = 2 * k + 1 + go_right
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + L2)
        total += value[leaf]
        made.append((feature, cut, value))
    return Trees(*(np.array(part) for part in zip(*made)), none.base)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(x: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on about ``sample_rows`` of the labelled documents, those of the smallest hashes
    (of rows that repeat a doc_id the one with the smallest statistics)."""
    learnt = labels.where("quality is not null").where(~held_out(F.col("doc_id")))
    labelled = (x.join(learnt.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id")
                .groupBy("doc_id").agg(F.min("x").alias("x"), F.max("quality").alias("quality")))
    total = labelled.count()
    steps = 1 << 20
    share = min(steps, int(steps * sample_rows / max(1, total)) + 1)
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(steps))
    rows = labelled.where(place < share).orderBy("doc_id").select("x", "quality").toArrow()
    table = np.array(rows.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES)) \
        if rows.num_rows else np.zeros((0, len(FEATURES)))
    return fit(table.astype(np.float32), np.array(rows.column("quality"), dtype=float))


def scored(x: DataFrame, model: Trees) -> DataFrame:
    """doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("x").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(rows))], ["doc_id", "score"])

    return x.mapInArrow(run, "doc_id bigint, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    x = written(features(docs), "statistics")
    return scored(x, train(x, labels, sample_rows)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected; texts are scored where they lie,
    in a second reading, so no text is shuffled."""
    model = train(written(features(docs), "statistics"), labels, sample_rows)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_size(batches, "text"):
            x = statistics(raw_texts(batch.column("text"))).astype(np.float32)
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, schema)

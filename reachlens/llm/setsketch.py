"""Near-duplicate documents by SetSketch registers.

A document's word shingles form a set.  Documents with equal sets are one class,
kept as its smallest doc_id.  For each class a sketch of truncated, exponentially
spaced minima is made: register j holds floor(1 - log_b(h_j)) of the smallest
exponential hash h_j of the set, so sketches merge by taking the larger register
and equal registers grow likelier with similarity.  Registers are banded; classes
that share a band meet in a bucket, and each names the bucket's smallest member.
The groups connected that way hold every candidate pair.

Groups are cut into blocks of bounded size.  Inside a block pairs are estimated
jointly by likelihood from their registers and sizes, and the plausible ones,
best first, are verified on full sets unless already connected.  Where a group
has several blocks, the best linked members of each block meet next, and then
every class outside the group's largest component meets all blocks: no pair of
a group in different components stays unseen.  Links give components.

A pair at the threshold misses all bands with a chance under 1e-5 (``banding``),
and is thrown out by the estimate beyond 5 standard deviations; nothing else is
approximate.

Defined results: null and empty texts have an empty set and are linked with
nothing; a null doc_id is never a candidate, joins only an equal set and is not kept; rows
sharing a doc_id are judged one by one but count as one node; an empty table
gives an empty result; other columns are ignored (``one_of_each`` keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlens.llm.common import (batches_by_size, components, groups, hash_words, mix, partitions,
                                  raw_texts, salted_join, seeds, star_components, written)

REGISTERS = 192
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 20
AMBASSADORS = 8
_A, _B = seeds(REGISTERS, 11) | np.uint64(1), seeds(REGISTERS, 12)


def banding(threshold: float) -> tuple[int, int]:
    """(bands, rows): the longest bands by which a pair at the threshold is
    missed with a chance under 1e-5."""
    best = (REGISTERS, 1)
    for rows in range(1, 17):
        bands = REGISTERS // rows
        if (1 - threshold ** rows) ** bands < 1e-5:
            best = (bands, rows)
    return best


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The distinct 64-bit shingle hashes of each text, sorted; with fewer words
    than ``size`` the whole sequence is the only one."""
    words, bounds = hash_words(texts, lower=True)
    for lo, hi in zip(bounds, bounds[1:]):
        w = words[lo:hi]
        n = max(1, len(w) - size + 1) if len(w) else 0
        h = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(min(size, len(w))):
                h = h * np.uint64(0x9E3779B97F4A7C15) + w[i:i + n]
        yield np.unique(mix(h + np.uint64(min(size, len(w)))))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes; sketches of parts merge by ``maximum``."""
    low = np.full(REGISTERS, np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 1024):
            h = np.multiply.outer(shingles[at:at + 1024], _A)
            h += _B
            np.minimum(low, h.min(0), out=low)
    exponential = -np.log1p(-(low.astype(float) + 1) / (2.0 ** 64 + 2)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, TOP).astype(np.uint16)


def likely_jaccard(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray,
                   n_b: np.ndarray) -> np.ndarray:
    """Maximum likelihood of the Jaccard similarity of pairs (a, b) with set sizes
    n_a, n_b, from how many registers of a are larger, smaller, equal."""
    grid = np.linspace(0, 1, 201)
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    j = np.minimum(grid[None, :], np.minimum(u / v, v / u))

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    fit = (larger[:, None] * np.log(up + tiny) + smaller[:, None] * np.log(down + tiny)
           + equal[:, None] * np.log(np.maximum(1 - up - down, tiny)))
    return j[np.arange(len(j)), fit.argmax(1)]


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n (distinct shingles), h1 and h2 (a hash of the set), bands (a key each)."""
    bands, rows = banding(percent / 100)
    odd = seeds(rows, 13) | np.uint64(1)
    band_seed = seeds(bands, 14)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_size(batches, "text"):
            n, h1, h2, keys = [], [], [], []
            for s in shingle_sets(raw_texts(batch.column("text")), size):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    h1.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                    h2.append(int(mix(s * odd[0]).sum(dtype=np.uint64).astype(np.int64)))
                    if len(s):
                        r = registers(s)[:bands * rows].reshape(bands, rows).astype(np.uint64)
                        keys.append(mix(mix(r + np.uint64(1)) @ odd + band_seed).astype(np.int64))
                    else:
                        keys.append(np.zeros(0, np.int64))
            ends = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys), pa.int64()))],
                ["doc_id", "n", "h1", "h2", "bands"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>")


class _Sets:
    """The sets of a block, and which of them are known to be connected."""

    def __init__(self, table: pa.Table, size: int, percent: int) -> None:
        self.ids = np.array(table.column("doc_id"), np.int64)
        self.sets = list(shingle_sets(raw_texts(table.column("text")), size))
        self.sizes = np.array([len(s) for s in self.sets], float)
        self.regs = np.stack([registers(s) for s in self.sets])
        self.percent = percent
        labels = table.column("label").to_pylist()
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def linked(self, a: int, b: int) -> bool:
        x, y = self.sets[a], self.sets[b]
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
        return 100 * both >= self.percent * (len(x) + len(y) - both)

    def plausible(self, rows: np.ndarray, cols: np.ndarray) -> list[tuple[float, int, int]]:
        """Pairs of ``rows`` x ``cols`` that the likelihood does not rule out."""
        t = self.percent / 100
        slack = 5 * math.sqrt(t * (1 - t) / REGISTERS)
        out = []
        for at in range(0, len(rows), 32):
            some = rows[at:at + 32]
            equal = (self.regs[some][:, None, :] == self.regs[cols][None, :, :]).sum(2)
            ratio = np.minimum.outer(self.sizes[some], self.sizes[cols]) / \
                np.maximum.outer(self.sizes[some], self.sizes[cols])
            i, j = np.nonzero((equal >= REGISTERS * (t - 2 * slack)) & (ratio >= t - 1e-9)
                              & (some[:, None] != cols[None, :]))
            for lo in range(0, len(i), 1 << 13):
                a, b = some[i[lo:lo + (1 << 13)]], cols[j[lo:lo + (1 << 13)]]
                same = equal[i[lo:lo + (1 << 13)], j[lo:lo + (1 << 13)]]
                larger = (self.regs[a] > self.regs[b]).sum(1)
                jac = likely_jaccard(larger, REGISTERS - larger - same, same, self.sizes[a], self.sizes[b])
                good = jac >= t - slack
                out += zip(jac[good].tolist(), a[good].tolist(), b[good].tolist())
        return out

    def links(self, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
        """Verified links that connect all that ``rows`` x ``cols`` can, best first."""
        found = []
        for _, a, b in sorted(self.plausible(rows, cols), reverse=True):
            x, y = self.root(a), self.root(b)
            if x != y and self.linked(a, b):
                self.up[x] = y
                found.append((a, b))
        return found


def _blocks(texts: DataFrame, keys: list[str], schema: str, answer) -> DataFrame:
    """``answer(table)`` (a list of rows) for each group of ``keys``."""
    names = [f.split()[0] for f in schema.split(", ")]
    arrow = pa.schema([(n, pa.bool_() if n == "envoy" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, keys):
            yield pa.RecordBatch.from_pylist(answer(table), schema=arrow)

    return (texts.repartition(partitions(texts.sparkSession), *keys).sortWithinPartitions(*keys, "doc_id")
            .mapInArrow(run, schema))


def _inside(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Each member with ``label``, the smallest member connected to it inside its
    block; ``envoy`` marks the most linked members of blocks that are not alone."""
    def answer(table: pa.Table) -> list[dict]:
        block = _Sets(table, size, percent)
        every = np.arange(len(block.ids))
        degree = np.zeros(len(every), int)
        for pair in block.links(every, every):
            degree[list(pair)] += 1
        low: dict[int, int] = {}
        for i in every:
            low[block.root(i)] = min(low.get(block.root(i), block.ids[i]), block.ids[i])
        envoys = set(np.lexsort((block.ids, -degree))[:AMBASSADORS].tolist())
        group, at, blocks = (table.column(c)[0].as_py() for c in ("group", "block", "blocks"))
        return [{"doc_id": int(block.ids[i]), "n": int(block.sizes[i]), "group": group, "block": at, "blocks": blocks,
                 "label": int(low[block.root(i)]), "envoy": blocks > 1 and int(i) in envoys} for i in every]

    return _blocks(texts.withColumn("label", F.col("doc_id")), ["group", "block"],
                   "doc_id bigint, n bigint, group bigint, block bigint, blocks bigint, label bigint, envoy boolean", answer)


def _between(texts: DataFrame, keys: list[str], size: int, percent: int) -> DataFrame:
    """(a, b): labels that verified links connect; rows ``asked`` meet all others."""
    def answer(table: pa.Table) -> list[dict]:
        block = _Sets(table, size, percent)
        labels = table.column("label").to_pylist()
        asked = np.flatnonzero(np.array(table.column("asked"), bool))
        return [{"a": labels[i], "b": labels[j]} for i, j in block.links(asked, np.arange(len(labels)))]

    return _blocks(texts, keys, "a bigint, b bigint", answer)


def _relabelled(members: DataFrame, edges: DataFrame) -> DataFrame:
    """``members`` with ``label`` replaced by its component over ``edges`` of labels."""
    comps = components(edges).withColumnRenamed("node", "label")
    return salted_join(members, comps, "label", "doc_id").withColumn(
        "label", F.coalesce("comp", "label")).drop("comp")


def _parts() -> Column:
    """The number of bounded blocks that a set of members (with n shingles) needs."""
    return F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES))


def class_components(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, label): the component of each class member (doc_id, n, bands)
    that shares a band with another; the others are alone."""
    rows = classes.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    group = written(star_components(salted_join(rows, buckets.select("key", "hub"), "key", "node", "inner"),
                                    "node", "hub").withColumnRenamed("comp", "group"), "groups")

    sized = group.join(classes.select(F.col("doc_id").alias("node"), "n"), "node")
    blocks = sized.groupBy("group").agg(_parts().alias("blocks"))
    members = written(
        salted_join(group, blocks, "group", "node").select(
            F.col("node").alias("doc_id"), "group", "blocks",
            F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).alias("block"))
        .join(docs.select("doc_id", "text"), "doc_id"), "members")

    inside = written(_inside(members, size, percent), "inside")
    wide = inside.where("blocks > 1").drop("envoy").distinct()
    if wide.isEmpty():
        return inside.select("doc_id", "label")
    texts = members.where("blocks > 1").select("doc_id", "text")

    # the best linked members of each block meet
    sent = inside.where("envoy").drop("envoy").distinct()
    meetings = sent.groupBy("group").agg(_parts().alias("meetings"))
    envoys = (salted_join(sent, meetings, "group", "doc_id", "inner").join(texts, "doc_id")
              .withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit("envoy")), F.col("meetings")))
              .withColumn("asked", F.lit(True)))
    labelled = written(_relabelled(wide, _between(envoys, ["group", "block"], size, percent)), "labelled")

    # all outside the largest component of their group meet every block
    counts = labelled.groupBy("group", "label").agg(F.count("*").alias("c"))
    major = counts.groupBy("group").agg(F.max(F.struct("c", "label")).alias("m")).select(
        "group", F.col("m.label").alias("major"))
    outside = salted_join(labelled, major, "group", "doc_id").where("label <> major")
    parts = written(outside.groupBy("group").agg(_parts().alias("parts")), "parts")
    askers = salted_join(outside, parts, "group", "doc_id").select(
        "group", "doc_id", "label", F.lit(True).alias("asked"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("doc_id", F.lit("part")), F.col("parts")).alias("part"))
    asked = salted_join(labelled, parts, "group", "doc_id", "inner").select(
        "group", "doc_id", "label", F.lit(False).alias("asked"), "block",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    meeting = askers.unionByName(asked).join(texts, "doc_id")
    final = _relabelled(labelled, _between(meeting, ["group", "block", "part"], size, percent))
    return inside.where("blocks = 1").select("doc_id", "label").unionByName(final.select("doc_id", "label"))


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    made = written(sketches(docs, size, percent), "sketches")
    classes = (made.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"))
               .where("doc_id is not null"))
    narrow = written(classes, "classes")
    members = made.join(narrow, ["doc_id", "h1", "h2"]).select("doc_id", "n", "bands").distinct()
    comps = class_components(docs, written(members, "class-members"), size, percent).groupBy(
        F.col("doc_id").alias("rep")).agg(F.min("label").alias("comp"))
    rows = made.select("doc_id", "n", "h1", "h2", F.struct("h1", "h2").alias("same"))
    reps = narrow.select(F.struct("h1", "h2").alias("same"), F.col("doc_id").alias("rep"))
    placed = salted_join(rows, reps, "same", "doc_id").withColumn(
        "rep", F.when(F.col("n") > 0, F.col("rep")))
    out = salted_join(placed, comps, "rep", "doc_id")
    component = F.coalesce("comp", "rep", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but one row of each group: its smallest
    doc_id stays (a null one only if there is no other, of equal ones any row of
    the smallest text hash).  Rows are told apart by a key of this stage's own, so
    neither repeated rows nor a doc_id with several texts blur the groups."""
    row = "_" * (1 + max(map(len, docs.columns)))
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    near = near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text"), size, percent)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col(row).alias("row"))
    groups_of = written(near.select(F.col("doc_id").alias(row), "component_id"), "near")
    named = keyed.select(row, first.alias("first")).join(groups_of, row)
    stay = named.groupBy("component_id").agg(F.min("first").alias("first")).select(
        F.col("first.row").alias(row))
    return keyed.join(written(stay, "stay"), row, "left_semi").select(*docs.columns)

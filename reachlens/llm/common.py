"""Helpers shared by the operators: scratch tables, skew-safe joins, connected
components and vectorised word hashing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reachlens.session import shared_dir

SALTS = 16
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


# -- written tables ---------------------------------------------------------

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the cluster's shared folder (own one only if unset)."""
    base = shared_dir(spark, lambda: tempfile.mkdtemp(prefix="llm-"))
    return f"{base}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps
    neither recompute it nor depend on the executors that made it."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# -- joins ------------------------------------------------------------------

def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "left",
                salts: int = SALTS) -> DataFrame:
    """``left`` join ``right`` on ``key`` where one key may hold a third of
    ``left``: left rows are dealt over ``salts`` parts by a hash of their
    column ``spread``, the (narrow) right rows are repeated for each part."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    a = left.withColumn("_salt", F.pmod(F.xxhash64(spread, F.lit("salt")), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", parts)
    return a.join(b, [key, "_salt"], how).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b) of bigint: one row
    (node, comp) for each node of an edge, comp its smallest reachable node.

    Every round each node takes the smallest of its neighbours' labels and of
    its label's own label (pointer jumping), so long chains shrink
    geometrically, until a round changes nothing: labels only fall, so that comes.
    Labels are written tables, so a lost executor costs at most one round.  Hubs are
    salted; empty edges give no rows."""
    both = written(edges.select("a", "b").where("a <> b")
                   .select(F.explode(F.array(F.struct("a", "b"), F.struct(
                       F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
                   .select("e.a", "e.b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.min("b"), F.col("a")).alias("comp")), "labels")
    while True:
        known = labels.withColumnsRenamed({"node": "key", "comp": "found"})
        near = salted_join(both.select(F.col("a").alias("key"), F.col("b").alias("node")), known,
                           "key", "node", "inner")
        jump = salted_join(labels.withColumnRenamed("comp", "key"), known, "key", "node", "inner")
        none = F.lit(None).cast("bigint").alias("old")
        step = (near.select("node", "found", none).unionByName(jump.select("node", "found", none))
                .unionByName(labels.select("node", F.col("comp").alias("found"), F.col("comp").alias("old")))
                .groupBy("node").agg(F.min("found").alias("comp"), F.max("old").alias("old")))
        seen = Observation()
        labels = written(step.observe(seen, F.count_if(F.col("comp") < F.col("old")).alias("changed"))
                         .select("node", "comp"), "labels")
        if not seen.get["changed"]:
            return labels


def star_components(rows: DataFrame, node: str, hub: str) -> DataFrame:
    """(node, comp) for nodes that name hubs, themselves nodes: a node joins its
    smallest hub, and its hubs are connected through that one, so the graph
    that is walked has hubs only.  A node names a bounded number of hubs."""
    named = rows.groupBy(F.col(node).alias("node")).agg(F.collect_set(hub).alias("hubs"))
    named = written(named.withColumn("first", F.array_min("hubs")), "stars")
    edges = named.select(F.col("first").alias("a"), F.explode("hubs").alias("b")).where("a <> b").distinct()
    comps = components(edges).withColumnRenamed("node", "first")
    return salted_join(named.select("node", "first"), comps, "first", "node").select(
        "node", F.coalesce("comp", "first").alias("comp"))


# -- hashing ----------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seeds(n: int, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                   + np.uint64(key))


#: factors of the places in a word, by the bits of the longest word's length; a plain
#: dict, as functions that travel by value take their globals along
_PLACES: dict[int, np.ndarray] = {}


def _places(bits: int) -> np.ndarray:
    if bits not in _PLACES:
        if len(_PLACES) >= 2:
            _PLACES.clear()
        _PLACES[bits] = seeds(1 << bits, 77)
    return _PLACES[bits]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
WINDOW = 1 << 21


def _hash_window(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a buffer."""
    word = ~_SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    at = np.arange(int(lens.sum())) - np.repeat(first, lens)
    place = _places(max(10, int(lens.max()).bit_length()))
    with np.errstate(over="ignore"):
        h = np.add.reduceat(buf[word].astype(np.uint64) * place[at], first)
        return starts, mix(h + lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def hash_words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, one after the other, and the
    bounds of each text's words in them (len(texts) + 1).  ``lower`` folds A-Z.
    Works in windows of 2 MiB, so a very long text needs 8 bytes a word."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    joined = b"\n".join([*texts, b""])
    buf = np.frombuffer(joined, np.uint8)
    found, hashes, lo = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while lo < len(buf):
        hi, size = min(len(buf), lo + WINDOW), WINDOW
        while hi < len(buf) and not _SPACE[buf[hi - 1]]:  # cut after white space only
            space = np.flatnonzero(_SPACE[buf[lo:hi]])
            if len(space):
                hi = lo + int(space[-1]) + 1
                break
            size *= 2
            hi = min(len(buf), lo + size)
        piece = _LOWER[buf[lo:hi]] if lower else buf[lo:hi]
        starts, h = _hash_window(piece)
        found.append(starts + lo)
        hashes.append(h)
        lo = hi
    return np.concatenate(hashes), np.searchsorted(np.concatenate(found), begins)


def frugal() -> None:
    """Lets this Python worker give freed memory back to the system: arrays over 1 MiB
    are mapped by themselves, and Arrow uses the same allocator.  Workers outlive
    their tasks, and the heap of one big group would stay with the executor."""
    pa.set_memory_pool(pa.system_memory_pool())
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc
    if mallopt:
        mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, which else grows with the arrays


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x.as_py() or b"" for x in column.cast(pa.large_binary())]


def batches_by_size(batches: Iterable[pa.RecordBatch], column: str,
                    limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (a row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys`` of sorted batches, one table a group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        lo = 0
        for i, key in enumerate(rows):
            if last is not None and key != last:
                if i > lo:
                    held.append(batch.slice(lo, i - lo))
                yield pa.Table.from_batches(held)
                held, lo = [], i
            last = key
        held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held)

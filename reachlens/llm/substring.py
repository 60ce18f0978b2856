"""Substring deduplication by fixed-block anchors.

Every repeated window of ``window`` words holds a whole reference block of half
that length, wherever it lies: blocks are non-overlapping, at multiples of
``block`` = (window + 1) // 2 words of a text, and 2 * block - 1 <= window.
So the index is the blocks' hashes, the probes are the hashes of every rolling
window of ``block`` words, and only a window around a hit can be repeated.
Extending the hits to maximal exact repeats marks the positions whose full
window occurs elsewhere; each word of such a window is removed.

Rows are dealt to chunks by a hash of a row number, so equal rows spread.  A text
over ``SLICE`` bytes is cut into slices that are dealt on their own; a slice
carries the window - 1 words before and after it, so that every window that covers its
words is seen in it, but counts only the windows that start in it.

A chunk sends each distinct hash once (a flag says whether it is a block here, another
whether it occurs more than once here), sorted and cut by hash range into parts, to
the parts it has entries for; so a passage in a third of all documents costs one
entry a chunk.  A part merges its entries of all chunks and answers each chunk with
bits, one for each entry.  The same is done for the full windows around the hits.
Chunks and parts have a bounded size: their numbers grow with the corpus, and a task
holds one of them.  The texts are shuffled once; the three passes over the chunks
read the same exchange.

A hit of the first pass (64 bits) only names candidates; a window is removed if all
its 128 bits agree with another's, made of two sums of odd multiples of its words'
64-bit hashes (about n * n / 2**129 chance meetings for n windows, so none).

Defined results: null and empty texts have no words; documents shorter than the
window keep all words; rows repeating a doc_id are documents of their own (whose
windows then occur elsewhere); an empty table gives an empty result; texts
without a removed word are returned unchanged, others as their kept words
joined by one space; other columns are kept, but for inputs named ``_n_words``
and ``_n_removed``, which are replaced.  The table must give its rows in the
same order to every attempt of a task (a stored table does).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachlens.llm.common import frugal, hash_words, mix, raw_texts

WINDOW = 35
CHUNK_BYTES = 4 << 20
PART_BYTES = 12 << 20
SLICE = 1 << 20
_ENTRIES = "chunk int, part int, n int, packed binary"
_BITS = "chunk int, round int, part int, bits binary"
_ODD = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_BLANK = b" \t\n\x0b\x0c\r"


def rolling(words: np.ndarray, width: int, odd: int = _ODD[0]) -> np.ndarray:
    """A 64-bit hash of the ``width`` words from each position."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    step = np.uint64(odd)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(width - 1, step))), dtype=np.uint64)
        out = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            out += words[i:i + len(out)] * power[width - 1 - i]
    return mix(out)


# -- slices of long texts ---------------------------------------------------

def _words_near(raw: bytes, at: int, count: int, forward: bool) -> list[bytes]:
    """The ``count`` words after (or before) a cut that lies between words."""
    reach = 64 * count
    while count:
        lo, hi = (at, min(len(raw), at + reach)) if forward else (max(0, at - reach), at)
        words = raw[lo:hi].split()
        whole = hi == len(raw) if forward else lo == 0
        # a word at the far end may be cut: one more than wanted must be there
        if whole or len(words) > count:
            return words[:count] if forward else words[len(words) - min(count, len(words)):]
        reach *= 4
    return []


def slices(raw: bytes, size: int, window: int) -> Iterator[tuple[bytes, int, int, int, int]]:
    """(bytes, lead, own, begin, length): the parts of a text of about ``size`` bytes
    cut before white space, each within the words around it; ``lead`` words come
    before its ``own`` ones, which are ``length`` bytes from ``begin`` on.  The own
    bytes, one after the other, are the text."""
    lo = 0
    while lo < len(raw):
        hi = min(len(raw), lo + size)
        while hi < len(raw) and raw[hi:hi + 1] not in _BLANK:
            hi += 1
        before = _words_near(raw, lo, window - 1, forward=False) if lo else []
        after = _words_near(raw, hi, window - 1, forward=True)
        own, lead = raw[lo:hi], b"".join(w + b" " for w in before)
        yield lead + own + b" " + b" ".join(after), len(before), len(own.split()), len(lead), len(own)
        lo = hi


# -- the hashes of a chunk --------------------------------------------------

class _Chunk:
    """The rolling hashes of a chunk's texts, in order.  ``lead`` and ``own`` give
    the words of each text that are a slice's own (own < 0: all)."""

    def __init__(self, texts: list[bytes], lead: list[int], own: list[int], window: int) -> None:
        self.window, self.block = window, (window + 1) // 2
        self.words, self.bounds = hash_words(texts, lower=False)
        self.first = self.bounds[:-1] + np.array(lead, np.int64)
        own = np.array(own, np.int64)
        self.last = np.where(own < 0, self.bounds[1:], self.first + own)
        hashes, starts, anchors = [], [0], []
        for lo, hi in zip(self.bounds, self.bounds[1:]):
            h = rolling(self.words[lo:hi], self.block) if hi - lo >= window else np.zeros(0, np.uint64)
            hashes.append(h)
            flag = np.zeros(len(h), bool)
            flag[::self.block] = True
            anchors.append(flag)
            starts.append(starts[-1] + len(h))
        self.starts = starts
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.anchors = np.concatenate(anchors) if anchors else np.zeros(0, bool)

    def blocks(self) -> _Entries:
        """The probes; marked are the reference blocks, and every one counts."""
        return _Entries([self.hashes], self.anchors, np.ones(len(self.hashes), bool))

    def windows(self, hit: np.ndarray) -> tuple[np.ndarray, _Entries]:
        """The full windows around the hit probes: their first words' places among all
        words, and their hashes; marked and counted are those that start in
        a slice's own words."""
        places, hashes = [np.zeros(0, np.int64)], [[np.zeros(0, np.uint64)] for _ in _ODD]
        slack = self.window - self.block
        for d in range(len(self.starts) - 1):
            near = hit[self.starts[d]:self.starts[d + 1]]
            if not near.any():
                continue
            ahead = np.concatenate((np.cumsum(near), np.full(slack, near.sum())))
            before = np.concatenate(([0], np.cumsum(near)))[:len(near)]
            lo, hi = self.bounds[d], self.bounds[d + 1]
            n = hi - lo - self.window + 1
            wanted = np.flatnonzero(ahead[slack:slack + n] - before[:n] > 0)
            places.append(wanted + lo)
            for odd, out in zip(_ODD, hashes):
                out.append(rolling(self.words[lo:hi], self.window, odd)[wanted])
        at = np.concatenate(places)
        text = np.searchsorted(self.bounds, at, side="right") - 1
        mine = (at >= self.first[text]) & (at < self.last[text]) if len(at) else np.zeros(0, bool)
        return at, _Entries([np.concatenate(h) for h in hashes], mine, mine)


class _Entries:
    """Distinct keys (of one or two 64-bit hashes) in order, their flags (1 marked, 2 counted
    more than once) and ``of``, the entry of each position."""

    def __init__(self, keys: list[np.ndarray], marked: np.ndarray, counted: np.ndarray) -> None:
        order, first = _sorted(keys)
        self.keys = [k[order][first] for k in keys]
        group = np.cumsum(first) - 1
        self.of = np.empty(len(order), np.int64)
        self.of[order] = group
        self.flags = np.zeros(len(self.keys[0]), np.uint8)
        self.flags[self.of[marked]] |= 1
        self.flags[np.bincount(self.of[counted], minlength=len(self.flags)) > 1] |= 2

    def top(self, bits: int) -> np.ndarray:
        return self.keys[0] >> np.uint64(64 - bits) if bits else np.zeros(len(self.keys[0]), np.uint64)

    def sent(self, chunk: int, bits: int) -> pa.Table:
        """A row for each part that has entries: they are laid out plane by plane, so
        that the shuffle's compression finds the slowly growing top bytes."""
        parts, starts = np.unique(self.top(bits), return_index=True)
        ends = [*starts[1:].tolist(), len(self.flags)]
        packed = [b"".join([*(np.ascontiguousarray(k[lo:hi].view(np.uint8).reshape(-1, 8).T).tobytes() for k in self.keys),
                            np.packbits(self.flags[lo:hi] & 1).tobytes(), np.packbits(self.flags[lo:hi] >> 1).tobytes()])
                  for lo, hi in zip(starts.tolist(), ends)]
        return pa.table({"chunk": pa.array([chunk] * len(parts), pa.int32()), "part": pa.array(parts.astype(np.int32)),
                         "n": pa.array([hi - lo for lo, hi in zip(starts.tolist(), ends)], pa.int32()),
                         "packed": pa.array(packed, pa.binary())})

    def answered(self, answers: pa.Table, number: int, bits: int) -> np.ndarray:
        """The answered bit of each entry."""
        out, top = np.zeros(len(self.flags), bool), self.top(bits)
        if len(out):
            for r, part, found in zip(*(answers.column(c) for c in ("round", "part", "bits"))):
                if r.as_py() == number:
                    lo, hi = np.searchsorted(top, [np.uint64(part.as_py()), np.uint64(part.as_py() + 1)])
                    out[lo:hi] = np.unpackbits(np.frombuffer(found.as_py(), np.uint8), count=hi - lo).astype(bool)
        return out


def _sorted(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys and, in that order, whether each differs from the one before."""
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = False
        for k in keys:
            k = k[order]
            first[1:] |= k[1:] != k[:-1]
    return order, first


def _unpacked(n: int, packed: bytes, count: int) -> tuple[list[np.ndarray], np.ndarray]:
    raw, bits = np.frombuffer(packed, np.uint8), (n + 7) // 8
    keys = [np.ascontiguousarray(raw[8 * n * i:8 * n * (i + 1)].reshape(8, n).T).view(np.uint64).ravel()
            for i in range(count)]
    at = 8 * n * count
    return keys, np.unpackbits(raw[at:at + bits], count=n) | np.unpackbits(raw[at + bits:], count=n) << 1


def _answers(number: int):
    """The merge of one part.  First round: an entry's bit is set if its hash occurs
    twice or more in all and is a block anywhere; second: if two or more windows count."""
    def merge(table: pa.Table) -> pa.Table:
        frugal()
        chunks, sizes = table.column("chunk").to_pylist(), table.column("n").to_pylist()
        part, count = table.column("part")[0].as_py(), number
        got = [_unpacked(n, p.as_py(), count) for n, p in zip(sizes, table.column("packed"))]
        flags = np.concatenate([f for _, f in got])
        keys = [np.concatenate([k[i] for k, _ in got]) for i in range(count)]
        del got, table
        order, first = _sorted(keys)
        del keys
        starts = np.flatnonzero(first)
        any_flag = np.bitwise_or.reduceat(flags[order], starts)
        seen = np.diff(np.append(starts, len(order))) if number == 1 else np.add.reduceat(
            (flags[order] & 1).astype(np.int64), starts)
        good = (seen > 1) | (any_flag >= 2)
        if number == 1:
            good &= (any_flag & 1) == 1
        bits = np.zeros(len(order), bool)
        bits[order] = np.repeat(good, np.diff(np.append(starts, len(order))))
        ends = np.cumsum(sizes)
        rows = [(c, np.packbits(bits[e - n:e]).tobytes()) for c, n, e in zip(chunks, sizes, ends)
                if bits[e - n:e].any()]
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()),
                         "round": pa.array([number] * len(rows), pa.int32()),
                         "part": pa.array([part] * len(rows), pa.int32()),
                         "bits": pa.array([r[1] for r in rows], pa.binary())})
    return merge


def _two_power(x: float) -> int:
    return max(0, math.ceil(math.log2(max(1.0, x))))


# -- the passes -------------------------------------------------------------

class _Names:
    """Working columns that no input column is called."""

    def __init__(self, columns: list[str]) -> None:
        tail = "_" * max(map(len, columns))
        self.slice = [f"_{n}{tail}" for n in ("piece", "lead", "own", "begin", "length")]
        self.piece, self.lead, self.own, self.begin, self.length = self.slice
        self.chunk, self.row = f"_chunk{tail}", f"_row{tail}"


def _dealt(docs: DataFrame, at: _Names, window: int, chunk_bytes: int,
           slice_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """The rows, and the slices of long ones, with their chunks; the bytes of all texts."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    long = size > slice_bytes
    total, much = docs.agg(F.sum(size), F.sum(F.when(long, size))).head()
    total, much = total or 0, much or 0
    chunks, more = max(1, math.ceil((total - much) / chunk_bytes)), max(1, math.ceil(much / chunk_bytes))
    numbered = docs.withColumn(at.row, F.monotonically_increasing_id())
    whole = numbered.where(~long).withColumns({c: F.lit(-1 if c == at.own else 0) for c in at.slice})
    names = numbered.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                for piece, (text, *rest) in enumerate(slices(raw_texts(row.column("text"))[0], slice_bytes, window)):
                    made = [pa.array([text.decode()], pa.string()) if c == "text" else row.column(c) for c in names]
                    yield pa.RecordBatch.from_arrays([*made, *(pa.array([x], pa.int32()) for x in (piece, *rest))],
                                                     names=[*names, *at.slice])

    numbers = [T.StructField(c, T.IntegerType()) for c in at.slice]
    sliced = numbered.where(long).mapInArrow(cut, T.StructType([*numbered.schema.fields, *numbers]))
    return (whole.withColumn(at.chunk, F.pmod(F.xxhash64(at.row), F.lit(chunks)).cast("int")),
            sliced.withColumn(at.chunk, F.lit(chunks) + F.pmod(F.xxhash64(at.row, at.piece), F.lit(more)).cast("int")),
            total)


def without_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                    part_bytes: int = PART_BYTES, slice_bytes: int = SLICE) -> DataFrame:
    """The rows of ``docs`` with what is kept as ``text``, and _n_words, _n_removed."""
    docs = docs.drop("_n_words", "_n_removed")
    columns, at = docs.columns, _Names(docs.columns)
    texts, sliced, size = _dealt(docs, at, window, chunk_bytes, slice_bytes)
    bits = _two_power(size * 1.4 / part_bytes)  # about 1.4 bytes of entries for one of text

    def chunk_of(table: pa.Table) -> _Chunk:
        frugal()
        if not table.num_rows:
            return _Chunk([], [], [], window)
        return _Chunk(raw_texts(table.column("text")), table.column(at.lead).to_pylist(),
                      table.column(at.own).to_pylist(), window)

    def anchors(table: pa.Table) -> pa.Table:
        return chunk_of(table).blocks().sent(table.column(at.chunk)[0].as_py(), bits)

    def candidates(chunk: _Chunk, answers: pa.Table) -> tuple[np.ndarray, _Entries]:
        probes = chunk.blocks()
        return chunk.windows(probes.answered(answers, 1, bits)[probes.of])

    def extend(left: pa.Table, answers: pa.Table) -> pa.Table:
        if not left.num_rows or not answers.num_rows:
            return _Entries([np.zeros(0, np.uint64)] * 2, np.zeros(0, bool), np.zeros(0, bool)).sent(0, bits)
        return candidates(chunk_of(left), answers)[1].sent(left.column(at.chunk)[0].as_py(), bits)

    def remove(left: pa.Table, answers: pa.Table) -> pa.Table:
        raw = raw_texts(left.column("text")) if left.num_rows else []
        chunk = chunk_of(left)
        gone = np.zeros(len(chunk.words) + 1, np.int64)
        if answers.num_rows and left.num_rows:
            places, found = candidates(chunk, answers)
            repeated = places[found.answered(answers, 2, bits)[found.of]]
            np.add.at(gone, repeated, 1)
            np.add.at(gone, repeated + window, -1)
        covered = np.cumsum(gone[:-1]) > 0
        kept, removed = left.column("text").to_pylist(), []
        parts = zip(raw, *(left.column(c).to_pylist() for c in (at.own, at.begin, at.length)))
        for i, (text, own, begin, length) in enumerate(parts):
            mask = covered[chunk.first[i]:chunk.last[i]]
            text = text if own < 0 else text[begin:begin + length]
            removed.append(int(mask.sum()))
            if removed[-1]:
                words = text.split()
                kept[i] = b" ".join([words[j] for j in np.flatnonzero(~mask)]).decode()
            elif own >= 0:
                kept[i] = text.decode()
        out = [pa.array(kept, pa.string()) if c == "text" else left.column(c) for c in columns]
        extra = [left.column(at.row), left.column(at.piece), pa.array(chunk.last - chunk.first, pa.int64()),
                 pa.array(removed, pa.int64())]
        return pa.table([*out, *extra], names=[*columns, at.row, at.piece, "_n_words", "_n_removed"])

    keyed, long = texts.groupBy(at.chunk), sliced.groupBy(at.chunk)
    first = (keyed.applyInArrow(anchors, _ENTRIES).unionByName(long.applyInArrow(anchors, _ENTRIES))
             .groupBy("part").applyInArrow(_answers(1), _BITS))
    near = first.groupBy("chunk")
    second = (keyed.cogroup(near).applyInArrow(extend, _ENTRIES)
              .unionByName(long.cogroup(near).applyInArrow(extend, _ENTRIES))
              .groupBy("part").applyInArrow(_answers(2), _BITS))
    known = first.union(second).groupBy("chunk")
    counts = [T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType())]
    made = T.StructType([*docs.schema.fields, T.StructField(at.row, T.LongType()),
                         T.StructField(at.piece, T.IntegerType()), *counts])
    done = keyed.cogroup(known).applyInArrow(remove, made)
    parts = long.cogroup(known).applyInArrow(remove, made)
    return done.drop(at.row, at.piece).unionByName(_joined(parts, at, columns))


def _joined(parts: DataFrame, at: _Names, columns: list[str]) -> DataFrame:
    """The rows of long texts, their slices put together: as they were, or if a
    word is gone their words joined by one space."""
    others = [c for c in columns if c != "text"]
    pieces = F.transform(F.array_sort(F.collect_list(F.struct(at.piece, "text"))), lambda p: p["text"])
    rows = parts.groupBy(at.row).agg(
        F.min_by(F.struct(*others), at.piece).alias("other"), pieces.alias("pieces"),
        F.sum("_n_words").alias("_n_words"), F.sum("_n_removed").alias("_n_removed"))
    plain = F.filter(F.transform("pieces", lambda t: F.trim(F.regexp_replace(t, r"[\x20\x09-\x0D]+", " "))),
                     lambda t: t != "")
    text = F.when(F.col("_n_removed") > 0, F.array_join(plain, " ")).otherwise(F.array_join("pieces", ""))
    return rows.select(*(text.alias(c) if c == "text" else F.col("other")[c].alias(c) for c in columns),
                       "_n_words", "_n_removed")


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows and columns of ``docs`` with repeats cut out; n_chars follows the text."""
    docs = docs.drop("_n_words", "_n_removed")
    out = without_repeats(docs, window)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.length("text"))
                             .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

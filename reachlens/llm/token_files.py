"""Token ids in binary files of bit-plane shuffled blocks.

Writing.  Documents are put in order of doc_id by a range exchange and each
sorted partition becomes a shard: its texts are encoded one after the other, the
end id follows each document, and the stream of ids is cut into blocks of a
fixed number of ids, whatever the documents.  A block is stored as a frame: the
little-endian 32-bit ids are transposed into byte planes (or bit planes), each
plane is compressed with zstandard on its own, planes that are zero throughout
at the top are left out, and a header holds the number of ids, their CRC-32 and
the planes' lengths.  The chunk index stands beside the frames, one row a chunk:
shard, chunk, first (position of its first id in the shard), n, and the
documents that have ids in it with their first position.  Frames and index are
the columns of one Parquet table, written by Spark's sink, so retried tasks
commit once, the index is read without the frames, and a range of ids reads its
own chunks only (``ids_between``).

Reading.  Every chunk is decoded by itself: a document's ids inside it give a
piece with its CRC-32; the few pieces of a document that crosses chunks are
combined by the CRC's own arithmetic, so no document is put together again.

Encoding.  The pre-tokenizer of a byte-level tokenizer (without normalizer and
prefix space) always cuts between a visible character and white space, and between a
Latin letter or digit and ASCII punctuation.  So texts are cut there into words,
the library encodes each distinct word, and a bounded memory of words (kept by
the Python worker over its tasks) gives the ids of those that come again; a text's
ids are those of the whole text.  Cutting, finding and putting together are numpy
over a batch of texts; words are told apart by 128 bits.  Texts with white space
beyond ASCII, control characters that the libraries class differently or an added
token's own string, and texts for any other tokenizer, are encoded whole.

Memory: long texts are taken in pieces of ``PIECE`` characters, cut between a word
character and a following space or line feed; a task holds one piece's ids and
one block.  (A text without such a place is encoded whole.)  A hot doc_id spreads
over shards, as the order goes on by a row number.

Defined results: null and empty texts give the end id alone; a null doc_id
comes first; rows that repeat a doc_id are documents of their own, in the
table's order; an empty table gives an archive without chunks; only doc_id and text are read, so other columns,
whatever their names, are ignored.  The table must give its rows in the same order
to every attempt of a task (a stored table does).  A damaged frame raises.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachlens.llm.common import batches_by_size, mix, seeds

BLOCK = 1 << 16
PIECE = 1 << 18
LEVEL = 3
END_ID = 2
#: words whose ids a worker remembers
KNOWN = 1 << 20
MAGIC = b"IDPL"
_HEADER = "<4sBBII"  # magic, bits a plane row (8: bytes), planes, ids, CRC-32
_PLACE = re.compile(r"(?<=[\w!-~])[ \n]")
#: white space beyond ASCII, and control characters that only Python calls white space
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE, _DIGIT_OR_LETTER, _MARK, _TAIL, _LATIN = 1, 2, 4, 8, 16
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = _DIGIT_OR_LETTER
_CLASS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = _MARK
_CLASS[0x80:0xC0] = _TAIL       # of a character of several bytes
_CLASS[0xC3:0xCA] = _LATIN      # first of the two bytes of U+00C0 to U+027F
CHUNKS = ("shard int, chunk int, first bigint, n int, "
          "documents array<struct<doc_id: bigint, ordinal: bigint, start: bigint>>, frame binary")
_DOCUMENTS = pa.list_(pa.struct([("doc_id", pa.int64()), ("ordinal", pa.int64()), ("start", pa.int64())]))
_CHUNKS = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n", pa.int32()),
                     ("documents", _DOCUMENTS), ("frame", pa.binary())])
_PIECES = pa.schema([("shard", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()),
                     ("start", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())])


# -- frames -----------------------------------------------------------------

def planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The ids' byte planes, or their 32 bit planes, lowest first, without the zero ones at the top."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        table = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)
    else:
        table = np.ascontiguousarray(rows.T)
    used = np.flatnonzero(table.any(axis=1))
    return [table[i].tobytes() for i in range(int(used[-1]) + 1 if len(used) else 0)]


def framed(ids: np.ndarray, bits: bool = False, level: int = LEVEL) -> bytes:
    packed = [zstandard.ZstdCompressor(level).compress(p) for p in planes(ids, bits)]
    head = struct.pack(_HEADER, MAGIC, 1 if bits else 8, len(packed), len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
    return b"".join([head, struct.pack(f"<{len(packed)}I", *map(len, packed)), *packed])


def unframed(frame: bytes) -> np.ndarray:
    """The ids of a frame; raises if a length or the CRC does not agree."""
    magic, bits, count, n, crc = struct.unpack_from(_HEADER, frame)
    if magic != MAGIC:
        raise ValueError("not a frame of token ids")
    lengths = struct.unpack_from(f"<{count}I", frame, struct.calcsize(_HEADER))
    ends = np.cumsum([struct.calcsize(_HEADER) + 4 * count, *lengths])
    if ends[-1] != len(frame):
        raise ValueError("a frame's length does not agree with its header")
    size = (n + 7) // 8 if bits == 1 else n
    table = np.zeros((32 if bits == 1 else 4, size), np.uint8)
    for i in range(count):
        table[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(
            frame[ends[i]:ends[i + 1]], max_output_size=size), np.uint8)
    if bits == 1:
        rows = np.packbits(np.unpackbits(table, axis=1, count=n).T, axis=1, bitorder="little")
    else:
        rows = table.T
    ids = np.ascontiguousarray(rows).view("<u4").reshape(-1)
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("a frame's CRC does not agree with its ids")
    return ids


# -- the CRC of a sequence from the CRCs of its parts -----------------------

def _times(a: int, b: int) -> int:
    """The product of two polynomials over GF(2) modulo the CRC's, bits reflected."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, second_bytes: int) -> int:
    """crc32(x + y) of crc32(x), crc32(y) and len(y): crc32(x) * x^(8 len(y)) + crc32(y)."""
    power, square, n = 0x80000000, 0x00800000, second_bytes  # 1 and x^8
    while n:
        if n & 1:
            power = _times(power, square)
        square = _times(square, square)
        n >>= 1
    return _times(first, power) ^ second


# -- writing ----------------------------------------------------------------

def text_pieces(text: str, limit: int = PIECE) -> Iterator[str]:
    """``text`` in pieces of about ``limit`` characters whose encodings, one
    after the other, are the text's."""
    lo = 0
    while len(text) - lo > limit:
        place = _PLACE.search(text, lo + limit)
        if not place:
            break
        yield text[lo:place.start()]
        lo = place.start()
    yield text[lo:]


def encodes_by_word(definition: str) -> bool:
    """Whether a tokenizer's ids of a text are those of its words, one after the other."""
    rules = json.loads(definition)
    first = rules.get("pre_tokenizer") or {}
    return (rules.get("normalizer") is None and first.get("type") == "ByteLevel"
            and not first.get("add_prefix_space") and first.get("use_regex", True))


def word_starts(buf: np.ndarray) -> np.ndarray:
    """Whether a word begins at each byte of UTF-8 text."""
    kind = _CLASS[buf]
    out = np.zeros(len(buf), bool)
    out[:1] = True
    before = kind[:-1]
    out[1:] = (kind[1:] == _SPACE) & (before != _SPACE)
    letter = before == _DIGIT_OR_LETTER
    letter[1:] |= (before[1:] == _TAIL) & (kind[:-2] == _LATIN) & ~(  # but the signs for times and divided by
        (buf[:-2] == 0xC3) & ((buf[1:-1] == 0x97) | (buf[1:-1] == 0xB7)))
    out[1:] |= (kind[1:] == _MARK) & letter
    return out


class _Encoder:
    """Ids of texts by a tokenizer of the library."""

    def __init__(self, definition: str, specials_as_text: bool) -> None:
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(definition)
        self.library.encode_special_tokens = specials_as_text
        self.by_word = encodes_by_word(definition)
        self.added = [t["content"] for t in json.loads(definition).get("added_tokens", [])]
        self.forget()

    @classmethod
    def of_worker(cls, definition: str, specials_as_text: bool) -> _Encoder:
        """The worker process outlives the task: its encoder is kept with the library's module."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        kept, key = vars(tokenizers).setdefault("_encoders_of_tasks", {}), (definition, specials_as_text)
        if key not in kept:
            kept.clear()
            kept[key] = cls(*key)
        return kept[key]

    def forget(self) -> None:
        """No word is known.  A word has a number, by which its ids' place in the
        pool and the second half of its hash are found; numbers are found by the
        first half in a table of open slots."""
        self.size = 0
        self.slot_key, self.slot_number = np.zeros(4 * KNOWN, np.uint64), np.full(4 * KNOWN, -1, np.int32)
        self.begin, self.check = np.zeros(KNOWN + 1, np.int64), np.zeros(KNOWN, np.uint64)
        self.pool = np.zeros(1 << 16, np.uint32)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not known."""
        out, slot, left = np.full(len(keys), -1, np.int64), keys & np.uint64(4 * KNOWN - 1), np.arange(len(keys))
        while len(left):
            at = slot[left]
            number = self.slot_number[at]
            same = (number >= 0) & (self.slot_key[at] == keys[left])
            out[left[same]] = number[same]
            left = left[(number >= 0) & ~same]
            slot[left] = (slot[left] + np.uint64(1)) & np.uint64(4 * KNOWN - 1)
        return out

    def number(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Puts distinct new keys into the table."""
        slot, left = keys & np.uint64(4 * KNOWN - 1), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self.slot_number[at] < 0
            self.slot_number[at[free]] = numbers[left[free]]
            self.slot_key[at[free]] = keys[left[free]]
            left = left[self.slot_number[at] != numbers[left]]  # the last one that took a slot has it
            slot[left] = (slot[left] + np.uint64(1)) & np.uint64(4 * KNOWN - 1)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, words: list[str], keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The numbers of new words."""
        found = self.library.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        cuts = np.searchsorted(np.array(found.word_ids), np.arange(len(words) + 1))
        first, last, used = self.size, self.size + len(words), int(self.begin[self.size])
        if used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool[:used], np.zeros(used + 2 * len(ids), np.uint32)))
        self.pool[used:used + len(ids)] = ids
        self.begin[first:last + 1] = cuts + used
        self.check[first:last] = check
        self.size = last
        out = np.arange(first, last)
        self.number(keys, out)
        return out

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self.by_word and (t.isascii() and not any(c in t for c in "\x1c\x1d\x1e\x1f") or not _ODD_SPACE.search(t))
                 and not any(a in t for a in self.added) for t in texts]
        found = iter(self.by_words([t.encode() for t, p in zip(texts, plain) if p]))
        return [next(found) if p else self.whole(t) for t, p in zip(texts, plain)]

    def by_words(self, texts: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        joined = b"".join(texts)
        if not joined:
            return [np.zeros(0, np.uint32)] * len(texts)
        buf = np.frombuffer(joined, np.uint8)
        cut = word_starts(buf)
        cut[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        lens = np.diff(np.append(starts, len(buf)))
        one, two = _hashes(buf, starts, lens)
        distinct, first, of = np.unique(one, return_index=True, return_inverse=True)
        if (two != two[first][of]).any():  # two words of a batch share one half of their hashes
            return [self.whole(t.decode()) for t in texts]
        if self.size + len(distinct) > KNOWN:
            self.forget()
        number = self.numbers(distinct)
        new = np.flatnonzero(number < 0)
        if len(distinct) > KNOWN or (self.check[number] != two[first])[number >= 0].any():
            return [self.whole(t.decode()) for t in texts]
        if len(new):
            at = first[new]
            words = [joined[a:b].decode() for a, b in zip(starts[at].tolist(), (starts + lens)[at].tolist())]
            number[new] = self.learn(words, distinct[new], two[at])
        number = number[of]
        begin = self.begin[number]
        count = self.begin[number + 1] - begin
        total = np.cumsum(count)
        ids = self.pool[np.repeat(begin - (total - count), count) + np.arange(int(total[-1]))]
        bounds = np.concatenate(([0], total))[np.searchsorted(starts, np.concatenate(([0], ends)))]
        return [ids[lo:hi] for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _hashes(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each word."""
    at = np.arange(len(buf)) - np.repeat(starts, lens)
    longest, wide, out = int(lens.max()), buf.astype(np.uint64) + np.uint64(1), []
    with np.errstate(over="ignore"):
        for key in (21, 22):
            h = np.add.reduceat(wide * seeds(longest, key)[at], starts)
            out.append(mix(h + lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out[0], out[1]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block: int = BLOCK,
                 bits: bool = False, level: int = LEVEL, specials_as_text: bool = False) -> None:
    """Writes the ids of every text as a table of chunks at ``path``.

    ``tokenizer`` is a file of the tokenizers library; its content travels to the
    tasks.  ``specials_as_text`` encodes the special tokens' own strings as
    ordinary text."""
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder.of_worker(definition, specials_as_text)
        end = np.array([end_id], np.uint32)
        number = TaskContext.get().partitionId()
        stream: list[np.ndarray] = []  # ids not yet in a chunk
        waiting, first, chunk, ordinal = 0, 0, 0, 0
        inside: list[dict] = []  # documents that have ids from ``first`` on

        def cut(size: int) -> pa.RecordBatch:
            nonlocal stream, waiting, first, chunk, inside
            ids = np.concatenate(stream)
            now = [d for d in inside if d["start"] < first + size]
            out = pa.RecordBatch.from_pylist([{
                "shard": number, "chunk": chunk, "first": first, "n": size, "documents": now,
                "frame": framed(ids[:size], bits, level)}], schema=_CHUNKS)
            stream, waiting, first, chunk = [ids[size:]], waiting - size, first + size, chunk + 1
            inside = ([now[-1]] if now else []) + inside[len(now):]
            return out

        for batch in batches:
            for small in batches_by_size([batch], "text", PIECE):
                parts = [(i, p) for i, t in zip(small.column("doc_id").to_pylist(), small.column("text").to_pylist())
                         for p in [*((x, False) for x in (text_pieces(t or "") if encode.by_word else [t or ""])),
                                   (None, True)]]
                for lo in range(0, len(parts), 512):
                    some = parts[lo:lo + 512]
                    found = iter(encode([p for _, (p, _) in some if p is not None]))
                    for doc_id, (piece, last) in some:
                        if not inside or inside[-1]["ordinal"] != ordinal:
                            inside.append({"doc_id": doc_id, "ordinal": ordinal, "start": first + waiting})
                        stream.append(end if last else next(found))
                        waiting += len(stream[-1])
                        ordinal += last
                        while waiting > block:  # a full block goes once an id follows it
                            yield cut(block)
        if waiting:
            yield cut(waiting)

    row = "_row"
    ordered = (docs.select("doc_id", "text", F.monotonically_increasing_id().alias(row))
               .orderBy(F.asc_nulls_first("doc_id"), row).select(F.col("doc_id").cast("bigint"), "text"))
    ordered.mapInArrow(shard, CHUNKS).write.option("compression", "uncompressed").parquet(path)


# -- reading ----------------------------------------------------------------

def chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNKS).parquet(path)


def _bases(table: DataFrame) -> DataFrame:
    """(shard, base): the ids in all shards before.  One row a shard, of which
    there are as many as tasks wrote."""
    sizes = table.groupBy("shard").agg(F.sum("n").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32
    (of the ids as little-endian 32-bit integers) of each document in the files."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                raw = memoryview(unframed(row["frame"]).tobytes())
                first, docs = row["first"], row["documents"]
                cuts = [max(d["start"], first) - first for d in docs] + [row["n"]]
                yield pa.RecordBatch.from_pydict({
                    "shard": [row["shard"]] * len(docs), "ordinal": [d["ordinal"] for d in docs],
                    "doc_id": [d["doc_id"] for d in docs], "start": [d["start"] for d in docs],
                    "at": [first + lo for lo in cuts[:-1]], "n": [hi - lo for lo, hi in zip(cuts, cuts[1:])],
                    "crc": [zlib.crc32(raw[4 * lo:4 * hi]) for lo, hi in zip(cuts, cuts[1:])]}, schema=_PIECES)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                crc = parts[0]["crc"]
                for part in parts[1:]:
                    crc = joined_crc(crc, part["crc"], 4 * part["n"])
                out.append(crc)
            kept = [batch.column(c) for c in ("shard", "doc_id", "first", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.int64())],
                                             names=["shard", "doc_id", "first", "n_tokens", "ids_crc32"])

    table = chunks(spark, path)
    found = table.mapInArrow(pieces, "shard int, ordinal bigint, doc_id bigint, start bigint, at bigint, n bigint, "
                             "crc bigint")
    whole = found.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("first"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"))
    crcs = whole.mapInArrow(combine, "shard int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    return crcs.join(_bases(table), "shard").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def ids_between(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """(first, ids): the ids at positions low <= p < high of the whole stream, a
    row a chunk; only those chunks' frames are read."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, frame in zip(batch.column("place").to_pylist(), batch.column("frame")):
                ids = unframed(frame.as_py())
                lo, hi = max(low - first, 0), min(high - first, len(ids))
                yield pa.RecordBatch.from_pydict({"first": pa.array([first + lo], pa.int64()),
                                                  "ids": pa.array([ids[lo:hi]], pa.list_(pa.int64()))})

    table = chunks(spark, path)
    placed = table.join(_bases(table), "shard").withColumn("place", F.col("base") + F.col("first"))
    return (placed.where((F.col("place") < high) & (F.col("place") + F.col("n") > low))
            .select("place", "frame").mapInArrow(decode, "first bigint, ids array<bigint>"))

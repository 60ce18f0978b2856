"""Benchmark decontamination by spaced seeds.

Tokens are runs of letters and digits, lower-cased and hashed.  A mask such as
``111101`` selects tokens of a window and ignores the others, so a replaced word
under a 0 does not hide an overlap.  The masked hashes of every window of every
document are joined with those of the benchmark; on the diagonal of a hit (one
offset of document against benchmark) the tokens are compared position by
position: an overlap is ``window`` consecutive benchmark tokens (all, if there
are fewer) of which at least ``similarity`` are equal.

Nothing is missed.  The masks of ``SEEDS`` are chosen by the item's length, so that
every way to replace as many tokens as ``SIMILARITY`` lets pass leaves one
mask whole (the tests enumerate all of them); up to four tokens must all be equal, so
the mask is the whole item, and a longer item's windows are covered like an item of
``WINDOW`` tokens.  Only masks that some item needs are looked for.  A stricter similarity
is covered, too; a looser one, or a longer window, is refused.

Everything is DataFrame functions.  A benchmark of at most ``max_seeds`` seeds is
broadcast, and the documents are read once and not shuffled to find hits.  For a
larger one the seeds of the documents are shuffled to those of the benchmark (by
parts, as a phrase may stand in a third of all documents), once for the
whole benchmark, and only hits meet the texts again, by a row number.

A document's tokens are cut into chunks of ``CHUNK``, which share ``WINDOW`` - 1, so
every window lies in a chunk.  Generated code keeps all rows that one input row
becomes, each with the tokens it is compared with: a chunk bounds both, and a
broadcast seed has one row with all its places in the benchmark, so a long document
that quotes the benchmark all along takes no more memory than its tokens and a chunk's hits.

Defined results: null and empty texts have no tokens: such documents are clean, such
items never found; rows sharing a doc_id are one document, contaminated if any row is;
an empty table on either side gives no hits; other columns are ignored or kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlens.llm.common import salted_join, written

WINDOW = 20
SIMILARITY = 0.8
MAX_SEEDS = 1 << 18
SEGMENT, STEP = 64, 40  # long items are cut so that every window lies in a segment
CHUNK = 512  # tokens of a document that are looked at together
CHUNK_STEP = CHUNK - (WINDOW - 1)
#: masks and the lengths of the items (or segments) they are for
SEEDS = (("1", 1, 1), ("11", 2, 2), ("111", 3, 3), ("1111", 4, 4), ("111", 5, 7), ("1101", 5, 7),
         ("11111", 8, SEGMENT), ("111101", 8, SEGMENT), ("1101011", 8, SEGMENT), ("11001101", 8, SEGMENT))


def tokens(text: Column) -> Column:
    """Hashes of the letter and digit runs of a text, case folded."""
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))),
                                            F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.xxhash64(w))


def _starts(n: Column, span: int) -> Column:
    return F.greatest(n - (span - 1), F.lit(0))


def seed_hashes(words: str, mask: str, number: int) -> Column:
    """The masked hash of each window of an array of token hashes, in order."""
    picked = [i for i, bit in enumerate(mask) if bit == "1"]
    count = _starts(F.size(words), len(mask))
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: F.xxhash64(F.lit(number), *[F.get(words, p + i) for i in picked]))


def benchmark_segments(benchmark: DataFrame) -> DataFrame:
    """item_id, segment (its number over all) and item, the token hashes."""
    items = benchmark.select("item_id", tokens(F.col("text")).alias("all")).where(F.size("all") > 0)
    last = F.greatest(F.lit(0), F.ceil((F.size("all") - SEGMENT) / STEP).cast("int"))
    return (items.select("item_id", F.explode(F.sequence(F.lit(0), last)).alias("part"), "all")
            .select("item_id", F.xxhash64("item_id", "part", "all").alias("segment"),
                    F.slice("all", F.col("part") * STEP + 1, SEGMENT).alias("item")).distinct())


def benchmark_seeds(segments: DataFrame) -> DataFrame:
    """segment, mask, item_at and seed: the masked hashes of each item by the masks for its length."""
    fits = [F.when(F.size("item").between(lo, hi), seed_hashes("item", mask, m)) for m, (mask, lo, hi) in enumerate(SEEDS)]
    return (segments.select("segment", F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), h.alias("hashes"))
                                                           for m, h in enumerate(fits)])).alias("s"))
            .select("segment", "s.mask", F.posexplode("s.hashes").alias("item_at", "seed")))


def _chunks(docs: DataFrame) -> DataFrame:
    """doc_id, chunk (its number in the document) and words, its token hashes."""
    last = F.greatest(F.lit(0), F.ceil((F.size("all") - CHUNK) / CHUNK_STEP).cast("int"))
    chunks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("all", i * CHUNK_STEP + 1, CHUNK))
    # the outer form: as in _probes
    return (docs.select("doc_id", tokens(F.col("text")).alias("all")).select("doc_id", chunks.alias("chunks"))
            .select("doc_id", F.posexplode_outer("chunks").alias("chunk", "words")))


def _probes(read: DataFrame, masks: list[int], kept: list[str]) -> DataFrame:
    """``kept`` with seed and place, for every window of ``words`` under the masks."""
    probes = read.select(*kept, "words", F.concat(*[
        seed_hashes("words", SEEDS[m][0], m) for m in masks]).alias("probes"))
    # the outer form: an inferred filter on the array's size would make the seeds twice
    return probes.select(*kept, "words", F.posexplode_outer("probes").alias("place", "seed"))


def _doc_at(masks: list[int], size: Column, mask: Column) -> Column:
    """The first word of the window of a probe, from its place among all masks' windows."""
    begin, at = F.lit(0), F.lit(None).cast("int")
    for m in masks:
        at = F.when(mask == m, F.col("place") - begin).otherwise(at)
        begin = begin + _starts(size, len(SEEDS[m][0]))
    return at


def _verified(found: DataFrame, window: int, similarity: float) -> DataFrame:
    """Of hits (words, item, doc_at, item_at) those on whose diagonal tokens agree."""
    width = F.least(F.size("item"), F.lit(window))
    same = F.transform(F.sequence(F.lit(0), F.size("item") - 1), lambda j: F.coalesce(
        (F.get("words", F.col("doc_at") - F.col("item_at") + j) == F.get("item", j)).cast("int"), F.lit(0)))
    enough = F.exists(F.sequence(F.lit(1), F.size("item") - width + 1), lambda a: F.aggregate(
        F.slice("same", a, width), F.lit(0), lambda n, x: n + x) >= F.lit(similarity) * width)
    return found.withColumn("same", same).where(enough)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY,
         max_seeds: int = MAX_SEEDS) -> DataFrame:
    """(doc_id, item_id, offset) of verified overlaps, with repetitions."""
    if window > WINDOW or similarity < SIMILARITY:
        raise ValueError(f"the masks cover windows of up to {WINDOW} tokens and a similarity of {SIMILARITY} or more")
    segments = written(benchmark_segments(benchmark), "benchmark")
    seeds = written(benchmark_seeds(segments), "benchmark-seeds")
    counts = {r["mask"]: r["count"] for r in seeds.groupBy("mask").count().collect()}
    masks = sorted(counts) or [len(SEEDS) - 1]
    read = _chunks(docs)
    offset = (F.col("chunk") * CHUNK_STEP + F.col("doc_at") - F.col("item_at")).alias("offset")
    if sum(counts.values()) > max_seeds:
        return _shuffled_hits(read, segments, seeds, masks, window, similarity).select("doc_id", "item_id", offset)

    def equal(shift: int) -> Column:
        return F.get("words", F.col("doc_at") + shift) == F.get("item", F.col("item_at") + shift)

    # a hit that follows five equal tokens on its diagonal says nothing new: every
    # length that has a token before those has a contiguous mask of at most five
    again = equal(-1)
    for i in range(4):
        again = again & equal(i)
    places = seeds.groupBy("seed").agg(F.collect_list(F.struct("segment", "mask", "item_at")).alias("places"))
    met = (_probes(read, masks, ["doc_id", "chunk"]).join(F.broadcast(places), "seed")
           .select("doc_id", "chunk", "words", F.transform("places", lambda s: F.struct(
               s["segment"].alias("segment"), s["item_at"].alias("item_at"),
               _doc_at(masks, F.size("words"), s["mask"]).alias("doc_at"))).alias("places"))
           .select("doc_id", "chunk", "words", F.explode_outer("places").alias("s"))
           .select("doc_id", "chunk", "words", "s.segment", "s.item_at", "s.doc_at"))
    found = met.join(F.broadcast(segments), "segment").where(F.coalesce(~again, F.lit(True)))
    return _verified(found, window, similarity).select("doc_id", "item_id", offset)


def _shuffled_hits(read: DataFrame, segments: DataFrame, seeds: DataFrame, masks: list[int], window: int,
                   similarity: float) -> DataFrame:
    """The same for a benchmark of any size: seeds meet in a shuffle, one row for each
    diagonal of a document and a segment then meets the words of both."""
    rows = written(read.withColumn("row", F.monotonically_increasing_id()), "tokens")
    probes = (_probes(rows, masks, ["row"]).where("seed IS NOT NULL")
              .select("row", "place", "seed", F.size("words").alias("size")))
    met = (salted_join(probes, seeds, "seed", "row", "inner")
           .withColumn("doc_at", _doc_at(masks, F.col("size"), F.col("mask")))
           .select("row", "segment", (F.col("doc_at") - F.col("item_at")).alias("doc_at"), F.lit(0).alias("item_at"))
           .distinct())
    return _verified(salted_join(met, segments, "segment", "row", "inner").join(rows, "row"), window, similarity)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """(doc_id, item_ids) of the documents with an overlap."""
    return (hits(docs, benchmark, **options).select("doc_id", "item_id").distinct()
            .groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` whose document has no overlap."""
    bad = written(contaminated(docs, benchmark, **options), "contaminated").select(
        F.col("doc_id").alias("_bad"))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad")), "left_anti")

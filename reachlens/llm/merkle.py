"""Document fingerprints: Merkle trees over sections, paragraphs and word runs.

A paragraph is a line of the text, cut into runs of words: a run ends after a word whose
hash begins with 0 or 1 (one in eight), so runs find their bounds again after an
insertion.  The runs are the leaves, and together they are the paragraph, white
space included; a paragraph is hashed from its leaves' hashes.  A section ends
after a paragraph whose hash begins with 0-3 and is hashed from its paragraphs, the
root from the sections.  A fingerprint is one string::

    root ':' sections joined by ',' ':' paragraphs joined by ',' ':' leaves joined by ','

All hashes are SHA-256; below the root they are cut to 12 hex digits, leaves to 8.
Roots test equality, differing sections and paragraphs locate edits, ``likeness``
is Dice's coefficient of the distinct leaves.

Everything is DataFrame functions, row by row; only finding the next document
shuffles.  Defined results: a null text counts as empty and has one empty
paragraph and no leaves; two texts without leaves are alike (1.0) if their
roots are equal, else 0.0; rows repeating a doc_id each get a row, and where
one of them is the next document the smallest text counts; a null doc_id has
no next document (its last third goes, and it is likened to itself); an only document is its own next; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlens.llm.common import written

CUT, LEAF = 12, 8
GAPS = " \t\r\f\x0b"
#: a word with the white space before it (or what there is at the end of a line)
WORD = r"[ \t\r\f\x0B]*[^ \t\r\f\x0B]+|[ \t\r\f\x0B]+"
#: first hex digits of the words that end a run, and of the paragraphs that end a section
LAST_WORDS, LAST_PARAGRAPHS = "01", "0123"
BOUNDS = 256


def _short(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.substring(h, 1, CUT)), ",")


def _runs(paragraph: Column) -> Column:
    """The hashes of the runs of a line."""
    def ended(word: Column) -> Column:
        last = F.substring(F.md5(F.ltrim(word, F.lit(GAPS)).cast("binary")), 1, 1).isin(*LAST_WORDS)
        return F.when(last, F.concat(word, F.lit("\n"))).otherwise(word)

    marked = F.array_join(F.transform(F.regexp_extract_all(paragraph, F.lit(WORD), F.lit(0)), ended), "")
    return F.transform(F.filter(F.split(marked, "\n", -1), lambda r: r != ""), lambda r: F.sha2(r.cast("binary"), 256))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of its column ``text`` (never null) as ``name``."""
    cut = df.withColumn("_runs", F.transform(F.split(text, "\n", -1), _runs))
    hashed = cut.withColumns({
        "_hashes": F.transform("_runs", lambda p: F.sha2(F.array_join(p, "").cast("binary"), 256)),
        "_leaves": F.array_join(F.transform(F.flatten("_runs"), lambda h: F.substring(h, 1, LEAF)), ",")})
    marked = F.array_join(F.transform("_hashes", lambda h: F.when(
        F.substring(h, 1, 1).isin(*LAST_PARAGRAPHS), F.concat(h, F.lit(";"))).otherwise(h)), "")
    sections = F.transform(F.split(F.rtrim(marked, F.lit(";")), ";", -1), lambda s: F.sha2(s.cast("binary"), 256))
    built = hashed.withColumn("_sections", sections)
    root = F.sha2(F.array_join("_sections", "").cast("binary"), 256)
    return built.withColumn(name, F.concat_ws(":", root, _short(F.col("_sections")),
                                              _short(F.col("_hashes")), "_leaves")).drop(
        "_runs", "_hashes", "_leaves", "_sections")


def level(fingerprint: Column, i: int) -> Column:
    """0 root, 1 sections, 2 paragraphs, 3 leaves, as an array of hashes."""
    part = F.split_part(fingerprint, F.lit(":"), F.lit(i + 1))
    return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ","))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: Dice's coefficient of the distinct leaves; 1.0 for equal roots."""
    x, y = level(a, 3), level(b, 3)
    both = F.size(F.array_intersect(x, y))
    total = F.size(F.array_distinct(x)) + F.size(F.array_distinct(y))
    return F.when(level(a, 0)[0] == level(b, 0)[0], 1.0).when(total == 0, 0.0).otherwise(2.0 * both / total)


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``b`` whose hash ``a`` lacks."""
    have = level(a, 2)
    return F.filter(F.transform(level(b, 2), lambda h, i: F.when(~F.array_contains(have, h), i)),
                    lambda i: i.isNotNull())


def next_ids(ids: DataFrame, bounds: int = BOUNDS) -> DataFrame:
    """(doc_id, next_id, want) of ids with ``want``: the largest smaller id, for
    the smallest the largest.  Ids are dealt to ranges by quantiles (at most
    ``bounds`` numbers on the driver); only one row a range meets in the window
    over ranges."""
    distinct = ids.where("doc_id is not null").groupBy("doc_id").agg(F.max("want").alias("want"))
    cuts = distinct.agg(F.percentile_approx("doc_id", [i / bounds for i in range(1, bounds)])
                        .alias("cuts")).head().cuts or []
    cuts = sorted(set(cuts))
    part = (F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("doc_id")))
            if cuts else F.lit(0))
    ranged = distinct.withColumn("part", part)
    inside = ranged.withColumn("next_id", F.lag("doc_id").over(Window.partitionBy("part").orderBy("doc_id")))
    ends = ranged.groupBy("part").agg(F.max("doc_id").alias("top"))
    wrap = Window.orderBy("part")
    before = ends.select("part", F.coalesce(
        F.lag("top").over(wrap),
        F.max("top").over(wrap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .alias("before"))
    return (inside.join(F.broadcast(before), "part")  # at most ``bounds`` rows
            .select("doc_id", F.coalesce("next_id", "before").alias("next_id"), "want"))


def edited_fingerprints(docs: DataFrame, bounds: int = BOUNDS) -> DataFrame:
    """doc_id, n_chars, edited (the last third replaced by the beginning of the
    next document), fingerprint, edited_fingerprint, next_fingerprint."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    third = F.floor(F.length("text") / 3).cast("int")
    steps = written(next_ids(rows.select("doc_id", third.alias("want")), bounds), "next")
    wanted = steps.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("reader"), "want")
    single = (rows.join(wanted, "doc_id").groupBy("doc_id", "reader", "want")
              .agg(F.min("text").alias("text")))
    heads = with_fingerprint(single, "text", "next_fingerprint").select(
        F.col("reader").alias("doc_id"), F.left("text", F.col("want")).alias("head"), "next_fingerprint")
    kept = F.left("text", F.length("text") - third)
    # an inner join, like that of the heads, so that both read one exchange of the texts
    both = rows.join(heads, "doc_id").unionByName(
        rows.where("doc_id is null").withColumns({"head": F.lit(""), "next_fingerprint": F.lit(None).cast("string")}))
    both = with_fingerprint(both, "text", "fingerprint").withColumn("edited", F.concat(kept, F.left("head", third)))
    both = with_fingerprint(both, "edited", "edited_fingerprint")
    return both.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "edited", "fingerprint",
                       "edited_fingerprint", F.coalesce("next_fingerprint", "fingerprint").alias("next_fingerprint"))

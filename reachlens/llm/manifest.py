"""A Merkle manifest of a dataset as a persistent tree with path copying.

The base version.  A row's leaf is the SHA-256 of its columns, each as byte count,
colon and value.  In each source the leaves stand in order of doc_id and every
three consecutive nodes of a level become their parent, until one node is
left; the sources' subroots, in order of the source, make the root in the same way.

Aligned blocks.  A tree is built in blocks of ``BLOCK`` = 3^7 neighbouring nodes:
a block is raised by seven levels in one task (or to its single top where the
whole tree is one block), and the blocks' tops are the nodes of the next stage.  So
a source of any size spreads over its blocks and a stage has a 2187th of the rows of the
one below.  Positions come from a range exchange: a sorted partition counts its
stretch of each source, and the stretches' sizes give the offsets.

Versions.  Tampering with a leaf makes a version of its own that shares every
node with the base but the leaf's ancestors, which are copied: ``copies`` lists
their digests from the changed leaf's parent to the root.  The copies inside a
block need that block only.  Above it, a version goes on in the task of its
leaf's block, not in a task of the upper block, where the versions of half a
source would meet: each stage hands every block below the siblings on its way
to the root (``path``), one row a block, and the block's versions are folded along
it.

Defined results: null columns count as ``-``; a null doc_id or source comes first
(rows without a doc_id are not tampered with); rows that repeat a doc_id are leaves
of their own, ordered by their digest; equal rows are interchangeable; an empty
table gives no rows; columns beyond the five are ignored.  Leaves are made once and
shuffled by a row number that tells equal rows apart; the first table written to the
shared folder is the placed one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlens.llm.common import groups, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
LEVELS = 7
BLOCK = ARITY ** LEVELS
DIGEST = 32
_VERSION = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                      ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()),
                      ("copies", pa.list_(pa.binary()))])
_VERSION_DDL = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                "verified boolean, copies array<binary>")


# -- leaves -----------------------------------------------------------------

def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 (32 bytes) over the columns, each ``-`` or its byte count, ``:`` and value."""
    said = []
    for column in columns.values():
        text = column.cast("string")
        said += [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":")), F.lit("-")),
                 F.coalesce(text, F.lit(""))]
    return F.unhex(F.sha2(F.concat(*said).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, digest and changed: the digest after tampering (the text
    without line feeds, for even CRC-32 of the doc_id), null where it is not
    tampered with.  ``tree`` orders like the source, null first.  Only texts that
    tampering alters are copied and hashed a second time."""
    own, feed = {c: F.col(c) for c in FIELDS}, F.lit("\n")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = docs.select(*FIELDS, leaf_digest(own).alias("digest"), even.alias("even"), F.when(
        even & F.contains("text", feed), F.replace("text", feed, F.lit(""))).alias("cut"))
    other = F.when(F.col("cut").isNotNull(), leaf_digest(own | {"text": F.col("cut")})).otherwise(F.col("digest"))
    return rows.select(
        F.coalesce(F.concat(F.lit(":"), "source"), F.lit("-")).alias("tree"), F.col("doc_id").cast("bigint"),
        "digest", F.when(F.col("even"), other).alias("changed"))


# -- positions --------------------------------------------------------------

def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` (written or just shuffled, with a column ``tree``) with pos, the place in its tree by
    ``order``, and n, the tree's number of rows."""
    kept = [*rows.columns, "part", "at"]

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for tree in batch.column("tree").to_pylist():
                seen = seen + 1 if tree == last else 0
                last = tree
                at.append(seen)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())], names=kept)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part int, at bigint"
    placed = written(rows.orderBy("tree", *order).mapInArrow(stretches, schema), name)
    sizes = placed.groupBy("tree", "part").agg(F.count("*").alias("size"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("tree", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
                           F.sum("size").over(of_tree).alias("n"))
    return placed.join(offsets, ["tree", "part"]).select(
        *rows.columns, (F.col("base") + F.col("at")).alias("pos"), "n")


# -- nodes of a block -------------------------------------------------------

def parent(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def raised(nodes: list[str], whole: bool) -> list[list[str]]:
    """The levels of a block from its nodes up: to a single one if the block is the
    ``whole`` tree, else by ``LEVELS`` levels."""
    levels = [nodes]
    while (len(levels[-1]) > 1) if whole else len(levels) <= LEVELS:
        last = levels[-1]
        levels.append([parent(last[i:i + ARITY]) for i in range(0, len(last), ARITY)])
    return levels


def paths(levels: list[list[str]], above: bytes) -> list[bytes]:
    """The path of each node of the lowest level: for every level on its way to the
    root one byte (place in its run, number of its run) and the run's other
    digests; ``above`` is the block's own path."""
    below = [above]
    for level in reversed(levels[:-1]):
        steps = []
        for i in range(len(level)):
            lo = i - i % ARITY
            run = level[lo:lo + ARITY]
            others = bytes.fromhex("".join(run[:i - lo] + run[i - lo + 1:]))
            steps.append(bytes([(i - lo) * (ARITY + 1) + len(run)]) + others + below[i // ARITY])
        below = steps
    return below


def steps(path: bytes) -> Iterator[tuple[int, list[str]]]:
    """(place in its run, the run's other digests) for each level of a path."""
    at = 0
    while at < len(path):
        place, size = divmod(path[at], ARITY + 1)
        end = at + 1 + DIGEST * (size - 1)
        text = path[at + 1:end].hex()
        yield place, [text[i:i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)]
        at = end


def folded(leaf: str, path: bytes) -> list[str]:
    """The ancestors of ``leaf`` along a path, the root last."""
    out = []
    for place, others in steps(path):
        leaf = parent([*others[:place], leaf, *others[place:]])
        out.append(leaf)
    return out


# -- stages -----------------------------------------------------------------

def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos DIV {BLOCK}L"))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def tops(nodes: DataFrame) -> DataFrame:
    """The next stage: one node (tree, pos, n, digest) a block."""
    def raise_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["tree", "block"]):
            n = table.column("n")[0].as_py()
            top = raised([d.hex() for d in table.column("digest").to_pylist()], n <= BLOCK)[-1][0]
            yield pa.RecordBatch.from_pydict({
                "tree": [table.column("tree")[0].as_py()],
                "pos": pa.array([table.column("block")[0].as_py()], pa.int64()),
                "n": pa.array([-(-n // BLOCK)], pa.int64()), "digest": pa.array([bytes.fromhex(top)], pa.binary())})
    return (_dealt(_blocked(nodes.select("tree", "pos", "n", "digest")))
            .mapInArrow(raise_all, "tree string, pos bigint, n bigint, digest binary"))


def stages(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The nodes of every stage, the given ones first.  A tree is finished at the
    stage where n is 1; the last stage has finished trees only."""
    out, most = [nodes], nodes.agg(F.max("n")).head()[0] or 1
    up = nodes
    while True:
        up = written(tops(up.where("n > 1") if len(out) > 1 else up), name)
        out.append(up)
        most = -(-most // BLOCK)
        if most == 1:
            return out


def _with_headers(nodes: DataFrame, headers: DataFrame) -> DataFrame:
    """The rows of each block after its header (pos -1), dealt by block and in order."""
    return _dealt(_blocked(nodes).unionByName(headers.withColumn("pos", F.lit(-1).cast("bigint")),
                                              allowMissingColumns=True))


def handed_down(nodes: DataFrame, headers: DataFrame) -> DataFrame:
    """The headers of the stage below: tree, block and its path, subroot and root."""
    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["tree", "block"]):
            head, rest = table.slice(0, 1).to_pylist()[0], table.slice(1)
            levels = raised([d.hex() for d in rest.column("digest").to_pylist()], rest.column("n")[0].as_py() <= BLOCK)
            size = rest.num_rows
            yield pa.RecordBatch.from_pydict({
                "tree": [head["tree"]] * size, "block": rest.column("pos").combine_chunks(),
                "path": pa.array(paths(levels, head["path"]), pa.binary()),
                "subroot": pa.array([head["subroot"]] * size, pa.binary()),
                "root": pa.array([head["root"]] * size, pa.binary())})
    return (_with_headers(nodes.select("tree", "pos", "n", "digest"), headers)
            .mapInArrow(hand, "tree string, block bigint, path binary, subroot binary, root binary"))


def descended(steps_up: list[DataFrame], finished: DataFrame) -> DataFrame:
    """The headers of the lowest stage's blocks.  ``finished`` has the path,
    subroot and root of every tree (tree, path, subroot, root)."""
    headers = None
    for stage in range(len(steps_up) - 1, 0, -1):
        nodes = steps_up[stage]
        here = nodes.where("n = 1").join(finished, "tree").select(
            "tree", F.lit(0).cast("bigint").alias("block"), "path", "subroot", "root")
        headers = here if headers is None else handed_down(nodes.where("n > 1"), headers).unionByName(here)
    return headers


def versions(docs: DataFrame) -> DataFrame:
    """One row a document: its leaf, subroot, root and proof in the base version, the
    root folded from its tampered leaf (else its own) along the base's siblings,
    whether that is still the root, and the ancestors its version copies."""
    rows = leaves(docs).withColumn("row", F.monotonically_increasing_id()).repartition("row")
    base = numbered(rows, [F.asc_nulls_first("doc_id"), F.col("digest"), F.col("row")], "placed").drop("row")
    up = stages(base, "tops")
    roots = reduce(DataFrame.unionByName, [s.where("n = 1").select("tree", "digest") for s in up[1:]])
    roots = written(roots, "subroots")
    trees = numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"),
                     [F.col("source")], "sources")
    over = stages(trees, "upper-tops")
    root = over[-1].where("n = 1").select("tree", F.lit(b"").alias("path"), F.col("digest").alias("subroot"),
                                          F.col("digest").alias("root"))
    # the one tree of sources is finished at the last stage: each source gets its path there
    source_headers = descended(over, root)
    finished = _source_paths(trees, source_headers)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["tree", "block"]):
            head, rest = table.slice(0, 1).to_pylist()[0], table.slice(1)
            digests = [d.hex() for d in rest.column("digest").to_pylist()]
            levels = raised(digests, rest.column("n")[0].as_py() <= BLOCK)
            root, out = head["root"].hex(), []
            for doc_id, leaf, changed, path in zip(rest.column("doc_id").to_pylist(), digests,
                                                   rest.column("changed").to_pylist(), paths(levels, head["path"])):
                other = leaf if changed is None else changed.hex()
                above = folded(other, path)
                top = above[-1] if above else other
                proof = "".join(d for _, others in steps(path) for d in others)
                out.append({
                    "doc_id": doc_id, "leaf": leaf, "subroot": head["subroot"].hex(), "root": root,
                    "proof_sha256": hashlib.sha256(proof.encode()).hexdigest(), "folded_root": top,
                    "verified": top == root,
                    "copies": [bytes.fromhex(d) for d in above] if other != leaf else []})
            yield pa.RecordBatch.from_pylist(out, schema=_VERSION)

    return _with_headers(base, descended(up, finished)).mapInArrow(fold, _VERSION_DDL)


def _source_paths(trees: DataFrame, headers: DataFrame) -> DataFrame:
    """tree (a source), its path to the root, subroot and root."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["tree", "block"]):
            head, rest = table.slice(0, 1).to_pylist()[0], table.slice(1)
            levels = raised([d.hex() for d in rest.column("digest").to_pylist()], rest.column("n")[0].as_py() <= BLOCK)
            size = rest.num_rows
            yield pa.RecordBatch.from_pydict({
                "tree": rest.column("source").combine_chunks(),
                "path": pa.array(paths(levels, head["path"]), pa.binary()),
                "subroot": rest.column("digest").combine_chunks(),
                "root": pa.array([head["root"]] * size, pa.binary())})
    return _with_headers(trees, headers).mapInArrow(name, "tree string, path binary, subroot binary, root binary")

"""Conversation structure repair by a square-root checkpointed dynamic programme.

The rows of a conversation, in order, are edited at least cost so that the initials of
their roles read ``(s?(ua)+)?``.  Keep costs 0, Rerole to user or assistant 1,
Delete 2 (the only edit for a blank or a duplicate row), Insert of an empty user
or assistant row 5; a truncated row that stays adds 5.  Of the cheapest edit
sequences the one whose initials (D, I, K, R) are ASCII-least is taken.

The programme.  Four states say what was written last: nothing, s, u, a.  Each row,
with insertions before it, is a 4 x 4 matrix of costs over (min, +).  A
conversation of n rows is cut into blocks of ceil(sqrt(n)) rows.

1. every block multiplies its rows' matrices (all blocks at once);
2. backwards over the at most sqrt(n) blocks of a conversation, the vector of
   costs to the end is kept only at the block's end: its checkpoint;
3. every block recomputes its inner vectors from its checkpoint and walks forward
   along tight edits, the least letter first, from each of the four states it
   may be entered in (all blocks at once again);
4. forwards over the blocks the state left picks the walk of the next, while the
   texts pass by.

So neither vectors nor texts of a whole conversation are held: a task holds a block's
vectors, or a piece of rows.  Rows are put in order by a range exchange, where a
long conversation spreads over tasks, and packed into pieces of at most
``PIECE_ROWS`` rows and about ``PIECE_BYTES`` bytes; only pieces and blocks, not
rows, meet by conversation.  (The hash of a repaired conversation goes in order, so
its pieces are streamed through one task.)

Defined results: null roles and texts count as one space, a null conv_id is a conversation,
null turns come first; rows of one turn are ordered by role, then by the MD5 of
their conversation, role and text; equal rows are interchangeable, but each counts;
a role's initial is its first character, other than s, u and a it is never
kept; a conversation without rows gives zeros, an empty audit and the empty string's
hash; an empty table gives no rows; columns beyond the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlens.llm.common import salted_join, written

PIECE_ROWS = 64
PIECE_BYTES = 1 << 15
BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# states: nothing written, s, u, a.  What may be written next, and the state after
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}
FINAL = (0, 2 * INSERT, INSERT, 0)  # the cost to the end behind the last row
FAR = 1 << 50
# a row's mark: 4 * initial (s, u, a, other) + fault, as a letter from A on
FAULTLESS, BLANK, DUPLICATE, CUT = range(4)
_RESULT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                     ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])
_RESULT_DDL = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
               "cost bigint, audit string, repaired_sha256 string")


# -- damage -----------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the test damage, nulls of role and text as one space."""
    space = F.lit(" ")
    said = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    kind, text = F.crc32(said.cast("binary")) % 20, F.coalesce("text", space)
    return (rows.select("conv_id", "turn", kind.alias("kind"), F.coalesce("role", space).alias("role"), text.alias("text"))
            .where("kind <> 0").select(
                "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                .otherwise(F.col("text")).alias("text"),
                F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                .alias("copy")).drop("copy"))


# -- ordered pieces ---------------------------------------------------------

def _mark(initial: Column, fault: Column) -> Column:
    return F.substring(F.lit("ABCDEFGHIJKLMNOP"), (initial * 4 + fault + 1).cast("int"), F.lit(1))


def marked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, the row's mark (duplicates not yet known) and its
    key, by which equal rows of a conversation are found."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    end = F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)
    initial = F.substring(role, 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(end == "", BLANK).when(end.isin(".", "!", "?"), FAULTLESS).otherwise(CUT)
    said = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.length(role).cast("string"),
                       role, text)
    return rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"),
                       text.alias("text"), _mark(number, fault).alias("mark"),
                       F.unhex(F.md5(said.cast("binary"))).alias("key"))


def _cuts(ids: list, sizes: np.ndarray) -> list[int]:
    """Where pieces begin: at each conversation, and within it by rows and bytes."""
    out, rows, held = [0], 0, 0
    for i in range(len(ids)):
        if i and (ids[i] != ids[i - 1] or rows >= PIECE_ROWS or held + sizes[i] > PIECE_BYTES):
            out.append(i)
            rows, held = 0, 0
        rows, held = rows + 1, held + int(sizes[i])
    return [*out, len(ids)]


def pieces(rows: DataFrame) -> DataFrame:
    """Marked rows in order, packed: conv_id, part and at (the place of the first row
    in the part's rows of the conversation), and the rows' columns as arrays."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_pylist()
            sizes = np.array([len(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()], np.int64)
            cuts, at = _cuts(ids, sizes), []
            for lo, hi in zip(cuts, cuts[1:]):
                seen = seen if (ids[lo],) == last else 0
                at.append(seen)
                last, seen = (ids[lo],), seen + hi - lo
            bounds = pa.array(cuts, pa.int32())
            packed = [pa.ListArray.from_arrays(bounds, pa.concat_arrays([batch.column(c)]))
                      for c in ("turn", "role", "text", "mark", "key")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").take(pa.array(cuts[:-1])), pa.array([part] * len(at), pa.int32()),
                 pa.array(at, pa.int64()), *packed],
                names=["conv_id", "part", "at", "turns", "roles", "texts", "marks", "keys"])

    ordered = rows.withColumn("_row", F.monotonically_increasing_id()).orderBy(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "key", "_row").drop("_row")
    return ordered.mapInArrow(pack, "conv_id bigint, part int, at bigint, turns array<bigint>, roles array<string>, "
                              "texts array<string>, marks array<string>, keys array<binary>")


def placed(packed: DataFrame) -> DataFrame:
    """(conv_id, part, base, n): the rows of the conversation in the parts before, and in all."""
    sizes = packed.groupBy("conv_id", "part").agg(F.sum(F.size("marks")).alias("size"))
    of_conv = Window.partitionBy("conv_id")
    before = of_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("conv_id", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
                        F.sum("size").over(of_conv).alias("n"))


def blocks(packed: DataFrame) -> DataFrame:
    """conv_id, block, n and the marks of the block's rows, duplicates marked.

    A duplicate's key has an earlier row; only keys of several rows are joined."""
    spots = placed(packed).withColumnsRenamed({"conv_id": "_conv", "part": "_part"})
    rows = (packed.select("conv_id", "part", "at", F.posexplode(F.arrays_zip("marks", "keys")))
            .join(spots, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
            .select("conv_id", "n", (F.col("base") + F.col("at") + F.col("pos")).alias("pos"),
                    F.col("col.marks").alias("mark"), F.col("col.keys").alias("key")))
    number = F.ascii("mark") - 65
    repeated = (rows.where(number % 4 != BLANK).groupBy("key").agg(F.min("pos").alias("first"), F.count("*").alias("c"))
                .where("c > 1").select("key", "first"))
    again = (F.col("pos") > F.col("first")) & (number % 4 != BLANK)
    return (salted_join(rows, repeated, "key", "pos")
            .select("conv_id", "n", "pos", F.when(again, _mark(F.floor(number / 4), F.lit(DUPLICATE)))
                    .otherwise(F.col("mark")).alias("mark"), F.ceil(F.sqrt("n")).cast("bigint").alias("size"))
            .groupBy("conv_id", "n", F.expr("pos DIV size").alias("block"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mark"))), lambda x: x["mark"]),
                              "").alias("marks")))


# -- the programme ----------------------------------------------------------

def edits(mark: str, state: int) -> list[tuple[str, int, int]]:
    """The edits (letter, cost, state after) of a row, in ASCII order, without insertions."""
    initial, fault = divmod(ord(mark) - 65, 4)
    out = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED if fault == CUT else 0
    letter = "sua "[initial]
    if letter == NEXT[state] or letter == "s" and state == START:
        out.append(("K", extra, AFTER[letter]))
    return [*out, ("R", REROLE + extra, AFTER[NEXT[state]])]


def with_insertions(vector: list[int]) -> list[int]:
    """Costs to the end where rows may be inserted first."""
    out = list(vector)
    for _ in range(3):
        for state in NEXT:
            out[state] = min(out[state], INSERT + out[AFTER[NEXT[state]]])
    return out


def before(mark: str, vector: list[int]) -> list[int]:
    """The costs to the end in front of a row from those behind it."""
    return with_insertions([min(cost + vector[after] for _, cost, after in edits(mark, state))
                            for state in range(4)])


def matrix(marks: str) -> list[int]:
    """Row by row the costs from each state in front of the block to each behind it."""
    columns = []
    for after in range(4):
        vector = [0 if s == after else FAR for s in range(4)]
        for mark in reversed(marks):
            vector = before(mark, vector)
        columns.append(vector)
    return [columns[e][s] for s in range(4) for e in range(4)]


def walk(marks: str, behind: list[int], last: bool) -> list[tuple[str, int]]:
    """The tight edits (ASCII-least) of a block from each state, and the state
    they leave; the last block inserts what is missing at the end."""
    vectors = [list(behind)]
    for mark in reversed(marks):
        vectors.append(before(mark, vectors[-1]))
    vectors.reverse()
    out = []
    for state in range(4):
        letters, at, here = [], 0, state
        while at < len(marks) or last and vectors[at][here]:
            left = vectors[at][here]
            inserted = AFTER[NEXT[here]]
            choices = [(letter, at + 1, after) for letter, cost, after in (edits(marks[at], here) if at < len(marks) else [])
                       if cost + vectors[at + 1][after] == left]
            if INSERT + vectors[at][inserted] == left:
                choices.append(("I", at, inserted))
            letter, at, here = min(choices)
            letters.append(letter)
        out.append(("".join(letters), here))
    return out


def _remembered(f):
    """``f`` of short arguments computed once a task (most blocks are short and alike)."""
    known: dict = {}

    def call(marks: str, *rest):
        if len(marks) > 16:
            return f(marks, *rest)
        key = (marks, *map(tuple, rest[:1]), *rest[1:])
        if key not in known:
            if len(known) >= 1 << 16:
                known.clear()
            known[key] = f(marks, *rest)
        return known[key]
    return call


def checkpointed(cut: DataFrame) -> DataFrame:
    """The blocks with ``behind``, the vector of costs to the end at each block's end."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = _remembered(matrix)
        for batch in batches:
            costs = [product(m) for m in batch.column("marks").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "costs"])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, vector = (), list(FINAL)
        for batch in batches:
            out = []
            for conv, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist()):
                if (conv,) != last:
                    last, vector = (conv,), list(FINAL)
                out.append(vector)
                vector = [min(costs[4 * s + e] + vector[e] for e in range(4)) for s in range(4)]
            kept = [batch.column(c) for c in ("conv_id", "n", "block", "marks")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.list_(pa.int64()))],
                                             names=["conv_id", "n", "block", "marks", "behind"])

    shape = "conv_id bigint, n bigint, block bigint, marks string"
    return (cut.select("conv_id", "n", "block", "marks").mapInArrow(multiply, f"{shape}, costs array<bigint>")
            .repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
            .mapInArrow(back, f"{shape}, behind array<bigint>"))


def walked(ready: DataFrame) -> DataFrame:
    """The blocks' walks: letters and states left, from each state entered."""
    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = _remembered(walk)
        for batch in batches:
            letters, exits = [], []
            for n, block, marks, behind in zip(*(batch.column(c).to_pylist() for c in ("n", "block", "marks", "behind"))):
                found = path(marks, behind, block * _size(n) + len(marks) == n)
                letters.append([x for x, _ in found])
                exits.append([s for _, s in found])
            kept = [batch.column(c) for c in ("conv_id", "n", "block", "marks")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(letters, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int64()))],
                names=["conv_id", "n", "block", "marks", "letters", "exits"])

    return (ready.repartition("conv_id", "block")
            .mapInArrow(forward, "conv_id bigint, n bigint, block bigint, marks string, letters array<string>, "
                        "exits array<bigint>"))


def _size(n: int) -> int:
    """ceil(sqrt(n)), as the blocks were cut."""
    return int(np.ceil(np.sqrt(float(n))))


class _Conversation:
    """The repair of one conversation, fed its blocks' walks and its pieces in order."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.state, self.hash, self.lines = conv, START, hashlib.sha256(), 0
        self.cost, self.audit, self.counts, self.illegal = 0, [], [0] * 4, 0
        self.rows: deque = deque()     # role and text of rows whose edits are not known yet
        self.letters: deque = deque()  # letter and mark of edits whose rows have not come
        self.initial, self.turn, self.low, self.turns = None, None, None, 0
        self.written = START

    def block(self, marks: str, letters: list[str], exits: list[int]) -> None:
        chosen, at = letters[self.state], 0
        self.state = exits[self.state]
        self.audit.append(chosen)
        for letter in chosen:
            mark = "A" if letter == "I" else marks[at]
            at += letter != "I"
            cut = (ord(mark) - 65) % 4 == CUT and letter in "KR"
            self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter] + TRUNCATED * cut
            self.letters.append(letter)
        for mark in marks:
            self.counts[(ord(mark) - 65) % 4] += 1
        self.edit()

    def piece(self, turns: list, roles: list[str], texts: list[str]) -> None:
        for turn, role in zip(turns, roles):
            initial = role[:1]
            if self.initial is not None and (self.initial + initial) not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = initial
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.turn, self.turns = turn, self.turns + 1
        self.rows.extend(zip(roles, texts))
        self.edit()

    def edit(self) -> None:
        while self.letters and (self.rows or self.letters[0] == "I"):
            letter = self.letters.popleft()
            role, text = ("", "") if letter == "I" else self.rows.popleft()
            if letter == "D":
                continue
            following = role[:1] if letter == "K" else NEXT[self.written]
            self.written = AFTER[following]
            line = f"{role if letter == 'K' else ROLES[following]}:{text}"
            self.hash.update((("\n" if self.lines else "") + line).encode())
            self.lines += 1

    def result(self) -> dict:
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.counts[BLANK], "duplicate": self.counts[DUPLICATE],
                "truncated": self.counts[CUT], "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def repaired(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each distinct conv_id of ``conversations``: the faults of its ``rows``, the
    cost and audit of its repair and the hash of the repaired rows."""
    packed = written(pieces(marked(rows)), "pieces")
    walks = walked(checkpointed(blocks(packed)))
    spots = placed(packed).withColumnsRenamed({"conv_id": "_conv", "part": "_part"})
    zero = F.lit(0).cast("bigint")
    heads = conversations.select(F.col("conv_id").cast("bigint")).distinct().select("conv_id", zero.alias("at"),
                                                                                     F.lit(0).alias("kind"))
    steps = walks.select("conv_id", (F.col("block") * F.ceil(F.sqrt("n")).cast("bigint")).alias("at"),
                         F.lit(1).alias("kind"), "marks", "letters", "exits")
    texts = packed.join(spots, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))).select(
        "conv_id", (F.col("base") + F.col("at")).alias("at"), F.lit(2).alias("kind"), "turns", "roles", "texts")

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for conv, kind, *rest in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "kind", "marks", "letters", "exits", "turns", "roles", "texts"))):
                if kind == 0:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(conv)
                elif kind == 1:
                    now.block(*rest[:3])
                else:
                    now.piece(*rest[3:])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_RESULT)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema=_RESULT)

    together = heads.unionByName(steps, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    return (together.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
            .mapInArrow(repair, _RESULT_DDL))

"""Chat formatting: conversations packed as prefix trees.

A turn is written ``<turn>role\\ntext</turn>\\n``; inside role and text ``\\`` is
written ``\\\\`` and ``<`` is written ``\\l`` (in roles also a line feed ``\\n``),
so no control string can occur in them and the escape is reversible.

The sorted turns of a conversation are streamed, one row a turn, and cut into
runs of at most RUN_TURNS turns and RUN_CHARS characters (or one turn).  Where a
run ends depends on the turns up to there only, so conversations that begin alike
are cut alike.  A run is known by the chain hash of all turns before it and the
chain hashes of its own: ordered by these, runs that continue the same turns are
together, in the depth-first order of their prefix tree.  Tasks get ranges of that
order (conv_id breaks ties, so a common first turn or conversation text spreads).
Each task streams its range into packs of bounded size: a turn shared with the run
before is emitted once.  A node of a pack has its interval [start, end) of the
pack's text, its position id (the offset from the conversation's first character)
and ``attend``: the intervals of its ancestors in the pack, joined where they
touch.  A character of the node attends to these, to what precedes it in the node,
and, where the member continues (run > 0), to the whole of the member with the
same conv_id and the run before, in whichever pack that is.  A pack that is full
begins the tree anew, so shared turns repeat once a pack.

Defined results: null role and text count as empty; rows repeating a turn number
are all kept, ordered by (turn, role, text); a null conv_id is a conversation of
its own; an empty table gives no packs; other columns are ignored.  One
turn is never split and may exceed the pack size.  The turns of one conversation
are read in order by one task, which holds a run at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlens.llm.common import partitions

PACK_CHARS = 1 << 16
PACK_MEMBERS = 1024
RUN_TURNS, RUN_CHARS = 64, 1 << 16
BATCH_CHARS = 1 << 22
OPEN, CLOSE = "<turn>", "</turn>\n"
PACK_SCHEMA = ("text string, nodes array<struct<start:int, end:int, parent:int, position:bigint, "
               "loss_start:int, loss_end:int, attend:array<struct<start:int, end:int>>>>, "
               "members array<struct<conv_id:bigint, run:bigint, more:boolean, leaf:int>>")
_ARROW_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_ARROW_PACK = pa.schema([
    ("text", pa.string()),
    ("nodes", pa.list_(pa.struct([(k, pa.int64() if k == "position" else pa.int32()) for k in (
        "start", "end", "parent", "position", "loss_start", "loss_end")]
        + [("attend", pa.list_(_ARROW_SPAN))]))),
    ("members", pa.list_(pa.struct([("conv_id", pa.int64()), ("run", pa.int64()), ("more", pa.bool_()),
                                    ("leaf", pa.int32())])))])


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")),
                    F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "n": "\n"}.get(m[1], m[1]), text)


RUN_SCHEMA = ("conv_id bigint, run bigint, more boolean, position bigint, before string, path string, "
              "turns array<struct<head:string, body:string, loss:boolean>>")
_ARROW_RUN = pa.schema([
    ("conv_id", pa.int64()), ("run", pa.int64()), ("more", pa.bool_()), ("position", pa.int64()),
    ("before", pa.string()), ("path", pa.string()),
    ("turns", pa.list_(pa.struct([("head", pa.string()), ("body", pa.string()), ("loss", pa.bool_())])))])


def formatted(conversations: DataFrame) -> DataFrame:
    """The runs of each conversation: conv_id, run (0, 1, ...), more (another run
    follows), position (characters before it), before (the chain hash of the turns
    before it, empty for none), path (before and the chain hashes of its turns) and
    turns: head, body and loss (whether the body is learnt) of each turn in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        run, turns, hashes, chars = None, [], [], 0

        def closed(more: bool) -> dict:
            return run | {"more": more, "path": run["before"] + "".join(hashes), "turns": turns}

        for batch in batches:
            for conv_id, head, body, loss in zip(*(batch.column(c) for c in ("conv_id", "head", "body", "loss"))):
                conv_id, head, body = conv_id.as_py(), head.as_py(), body.as_py()
                size = len(head) + len(body) + len(CLOSE)
                same = run is not None and run["conv_id"] == conv_id
                if run is None or not same or len(turns) >= RUN_TURNS or chars + size > RUN_CHARS:
                    if run is not None:
                        out.append(closed(same))
                        held += chars
                    run = {"conv_id": conv_id, "run": run["run"] + 1 if same else 0,
                           "position": run["position"] + chars if same else 0,
                           "before": hashes[-1] if same else ""}
                    turns, hashes, chars = [], [], 0
                    if held > BATCH_CHARS or len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist(out, schema=_ARROW_RUN)
                        out, held = [], 0
                last = hashes[-1] if hashes else run["before"]
                hashes.append(hashlib.md5(f"{last}{head}{body}".encode()).hexdigest()[:16])
                turns.append({"head": head, "body": body, "loss": loss.as_py()})
                chars += size
        if run is not None:
            out.append(closed(False))
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW_RUN)

    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
            .repartition(partitions(conversations.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", F.concat(F.lit(OPEN), escaped(F.col("role"), role=True), F.lit("\n")).alias("head"),
                    escaped(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("loss"))
            .mapInArrow(cut, RUN_SCHEMA))


class _Pack:
    """One pack while it is built: the open branch is the last run's."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.size, self.nodes, self.members = 0, [], []
        self.branch: list[tuple[tuple, int]] = []
        self.before: tuple[str, int] = ("", 0)

    def shared(self, before: tuple[str, int], turns: list[tuple]) -> int:
        n = 0
        if before != self.before:
            return n
        while n < min(len(turns), len(self.branch)) and turns[n] == self.branch[n][0]:
            n += 1
        return n

    def add(self, member: dict, before: tuple[str, int], turns: list[tuple]) -> None:
        keep = self.shared(before, turns)
        self.branch, self.before = self.branch[:keep], before
        for head, body, loss in turns[keep:]:
            parent = self.branch[-1][1] if self.branch else -1
            up = self.nodes[parent] if self.branch else None
            start = self.size
            end = start + len(head) + len(body) + len(CLOSE)
            attend = list(up["attend"]) if up else []
            if up and attend and attend[-1]["end"] == up["start"]:
                attend[-1] = {"start": attend[-1]["start"], "end": up["end"]}
            elif up:
                attend.append({"start": up["start"], "end": up["end"]})
            at = start + len(head)
            self.nodes.append({
                "start": start, "end": end, "parent": parent,
                "position": up["position"] + up["end"] - up["start"] if up else before[1],
                "loss_start": at if loss else start,
                "loss_end": at + len(body) if loss else start, "attend": attend})
            self.text += [head, body, CLOSE]
            self.size = end
            self.branch.append(((head, body, loss), len(self.nodes) - 1))
        self.members.append(member | {"leaf": self.branch[-1][1]})

    def row(self) -> dict:
        return {"text": "".join(self.text), "nodes": self.nodes, "members": self.members}


def prefix_tree_packs(conversations: DataFrame, pack_chars: int = PACK_CHARS,
                      pack_members: int = PACK_MEMBERS) -> DataFrame:
    """One row a pack: text, nodes (depth-first), members (conv_id, run, whether
    another run follows, leaf node)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _Pack()
        for batch in batches:
            for i in range(batch.num_rows):
                run = batch.slice(i, 1).to_pylist()[0]
                before = (run["before"], run["position"])
                rows = [(t["head"], t["body"], t["loss"]) for t in run["turns"]]
                new = sum(len(h) + len(b) + len(CLOSE) for h, b, _ in rows[pack.shared(before, rows):])
                if pack.members and (pack.size + new > pack_chars
                                     or len(pack.members) >= pack_members):
                    yield pa.RecordBatch.from_pylist([pack.row()], schema=_ARROW_PACK)
                    pack = _Pack()
                pack.add({k: run[k] for k in ("conv_id", "run", "more")}, before, rows)
        if pack.members:
            yield pa.RecordBatch.from_pylist([pack.row()], schema=_ARROW_PACK)

    ordered = (formatted(conversations)
               .repartitionByRange(partitions(conversations.sparkSession), "path", "conv_id")
               .sortWithinPartitions("path", "conv_id"))
    return ordered.mapInArrow(build, PACK_SCHEMA)


def conversation_spans(pack: dict, leaf: int) -> list[dict]:
    """The nodes from the root to ``leaf``."""
    out = []
    while leaf >= 0:
        out.append(pack["nodes"][leaf])
        leaf = out[-1]["parent"]
    return out[::-1]


_ARROW_SAID = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                         ("formatted_chars", pa.int64())])
SAID_SCHEMA = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
               "loss_sha256 string, formatted_chars bigint")
_ARROW_PART = pa.schema([*_ARROW_SAID, ("run", pa.int64()), ("said", pa.binary()), ("learnt", pa.binary())])


def read_back(packs: DataFrame) -> DataFrame:
    """Per conversation what the packs hold: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars.  A conversation of one run is judged
    where its pack is; the runs of others are brought together and hashed in order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pack = batch.slice(i, 1).to_pylist()[0]
                text, rows, held = pack["text"], [], 0
                for member in pack["members"]:
                    said, learnt, n_loss, n_all = [], [], 0, 0
                    spans = conversation_spans(pack, member["leaf"])
                    for node in spans:
                        turn = text[node["start"]:node["end"]]
                        role, _, body = turn[len(OPEN):-len(CLOSE)].partition("\n")
                        said.append(f"{unescaped(role)}\n{unescaped(body)}\n".encode())
                        loss = unescaped(text[node["loss_start"]:node["loss_end"]])
                        learnt.append(loss.encode())
                        n_loss, n_all = n_loss + len(loss), n_all + len(turn)
                    all_said, all_learnt = b"".join(said), b"".join(learnt)
                    row = {"conv_id": member["conv_id"], "n_turns": len(spans), "loss_chars": n_loss,
                           "formatted_chars": n_all, "run": member["run"]}
                    if member["run"] or member["more"]:
                        row |= {"said": all_said, "learnt": all_learnt}
                        held += len(all_said) + len(all_learnt)
                    else:
                        row |= {"turns_sha256": hashlib.sha256(all_said).hexdigest(),
                                "loss_sha256": hashlib.sha256(all_learnt).hexdigest()}
                    rows.append(row)
                    if held > BATCH_CHARS:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_PART)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_PART)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, said, learnt = None, None, None

        def done() -> dict:
            return last | {"turns_sha256": said.hexdigest(), "loss_sha256": learnt.hexdigest()}

        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                part = batch.slice(i, 1).to_pylist()[0]
                run, text, loss = (part.pop(k) for k in ("run", "said", "learnt"))
                if last is not None and run == 0:
                    rows.append(done())
                    last = None
                if text is None:
                    rows.append(part)
                    continue
                if run == 0:
                    last, said, learnt = part, hashlib.sha256(), hashlib.sha256()
                else:
                    last |= {k: last[k] + part[k] for k in ("n_turns", "loss_chars", "formatted_chars")}
                said.update(text)
                learnt.update(loss)
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_SAID)
        if last is not None:
            yield pa.RecordBatch.from_pylist([done()], schema=_ARROW_SAID)

    parts = packs.select("text", "nodes", "members").mapInArrow(
        read, f"{SAID_SCHEMA}, run bigint, said binary, learnt binary")
    return (parts.repartition(partitions(packs.sparkSession), "conv_id").sortWithinPartitions("conv_id", "run")
            .mapInArrow(join, SAID_SCHEMA))

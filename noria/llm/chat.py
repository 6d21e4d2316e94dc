"""Chat formatting into a prefix tree of conversations."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noria.llm.common import Scratch, running

START, END = "<|im_start|>", "<|im_end|>"
_OPEN = re.compile(r"<(\\*)\|")
_CLOSED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""No `<|` is left: `<|`, `<\|`, `<\\|`, ... each get one more backslash."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def _role(role: str) -> str:
    """A role on one line."""
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def _unrole(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's text in the template, and where its content starts and ends in it."""
    head, body = f"{START}{_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Turns (role, text, content start, content end) of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line + 1)
        out.append((_unrole(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end]), line + 1, end))
        at = end + len(END) + 1
    return out


#: Bytes of the chained digest that name a node, and those that stand for a turn in a path.
_NODE, _STEP = 16, 10
#: Characters of chunks in a batch that a task gives back.
_FLUSH = 1 << 24


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _steps(tokenizer_path: str | None):
    """Turns in order, conversation by conversation -> a row each; a conversation's last has its path."""

    def run(batches):
        tok = None
        if tokenizer_path:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(tokenizer_path)
        now, held, out, chars = None, None, [], 0
        chain, path, depth, position = b"", bytearray(), 0, 0
        for batch in batches:
            for i in range(len(batch)):
                conv, role, text = (c[i].as_py() for c in batch.columns)
                if conv != now:
                    if held:
                        out.append((*held, bytes(path)))
                    now, chain, path, depth, position = conv, b"", bytearray(), 0, 0
                else:
                    out.append((*held, None))
                chunk, lo, hi = format_turn(role, text)
                chain = hashlib.sha256(chain + chunk.encode()).digest()
                path += chain[:_STEP]
                pieces = (chunk[:lo], chunk[lo:hi], chunk[hi:])
                ids = None if tok is None else [tok.encode(x, add_special_tokens=False).ids for x in pieces]
                n = [len(x) for x in ids or pieces]
                loss = role == "assistant"
                held = (conv, depth, chain[:_NODE], chunk, ids and sum(ids, []), sum(n), position, n[0] if loss else None, n[0] + n[1] if loss else None)
                depth, position, chars = depth + 1, position + sum(n), chars + len(chunk)
                if out and chars > _FLUSH:
                    yield _batch(out, _NAMES, _KINDS)
                    out, chars = [], 0
        if held:
            yield _batch([*out, (*held, bytes(path))], _NAMES, _KINDS)

    return run


_NAMES = ["conv_id", "depth", "node", "chunk", "token_ids", "length", "position", "loss_start", "loss_end", "path"]
_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_SCHEMA = "conv_id long, depth long, node binary, chunk string, token_ids array<int>, length long, position long, loss_start long, loss_end long, path binary"
_SPAN = "array<struct<first:bigint,last:bigint,branch:bigint,start:bigint,end:bigint>>"


def prefix_tree(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", tokenizer_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """-> nodes and leaves of the tree that all conversations share.

    nodes, one row per distinct prefix of turns: node (a digest of the prefix), branch,
    depth, chunk (the last turn in the template), token_ids, start and length (its place
    in the depth-first sequence, in which shared tokens stand once), position (the
    position id of its first token; the others follow by one), loss_start and loss_end
    (the loss mask within it: an assistant's content), and ancestors (start and end of
    the intervals that hold its ancestors: with its own earlier tokens, all that its
    tokens attend to).
    leaves, one row per conversation: conv_id, node, branch, n_turns, and spans (the
    intervals of all its turns, each with the branch and the depths it covers).

    A token is a code point, or what the tokenizer gives for a turn's head, content
    and tail.  `<|` inside contents and roles is escaped reversibly.

    Depth first is the byte order of the conversations' paths (10 bytes of chained
    SHA-256 per turn).  Of equal conversations one stands for all; a node belongs to
    the first conversation in that order that passes it, so what a conversation owns
    is the end of its path: a branch, which is one interval.  A conversation's
    ancestors are one interval per branch that it leaves, never more than its turns,
    so all tables grow in proportion to the input.  A first turn that most
    conversations share is one row.  Turns stream through a task in sorted order; of a
    conversation a task holds one turn and the path.

    Nulls: a null text or role is empty; rows with a null conv_id belong to no
    conversation.  Turns come by turn (null first), then role, then text; repeated rows
    are turns of their own.  Other columns are not read.
    """
    scratch = Scratch(conversations.sparkSession)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), name(role_col).alias("role"), name(text_col).alias("text"))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    turns = scratch.cut(dealt.mapInArrow(_steps(tokenizer_path), _SCHEMA), "turns")
    distinct = turns.where("path is not null").groupBy("path", "node").agg(F.min("conv_id").alias("conv_id"), F.lit(1).cast("long").alias("one"))
    ranked = running(distinct, ["path"], "one", scratch, "ordered", cheap=True).select("node", "conv_id", F.col("run").alias("branch"))
    passed = turns.select("conv_id", "node", "depth", "length", "position").join(ranked.select("conv_id", "branch"), "conv_id")
    least = [F.min(c).alias(c) for c in ("branch", "depth", "length", "position")]
    owned = scratch.cut(passed.groupBy("node").agg(*least, F.count("*").alias("passing")), "owned")
    totals = owned.groupBy("branch").agg(F.sum("length").alias("total"), F.min("position").alias("origin"), F.min("depth").alias("first"), F.max("depth").alias("last"))
    begun = running(totals, ["branch"], "total", scratch, "begun", cheap=True).withColumnRenamed("run", "begin")
    shared = passed.join(owned.where("passing > 1").select("node", F.col("branch").alias("owner")), "node").where("owner <> branch")
    left = shared.groupBy("branch", "owner").agg(F.min("depth").alias("first"), F.max("depth").alias("last"), F.min("position").alias("low"), F.max(F.col("position") + F.col("length")).alias("high"))
    at = begun.select(F.col("branch").alias("owner"), (F.col("begin") - F.col("origin")).alias("shift"))
    span = F.struct("first", "last", F.col("owner").alias("branch"), (F.col("low") + F.col("shift")).alias("start"), (F.col("high") + F.col("shift")).alias("end"))
    above = left.join(at, "owner").groupBy("branch").agg(F.sort_array(F.collect_list(span)).cast(_SPAN).alias("above"))
    begun = begun.join(above, "branch", "left").withColumn("above", F.coalesce("above", F.array().cast(_SPAN)))
    branches = scratch.cut(begun.join(ranked, "branch"), "branches")

    where = owned.select("branch", "depth", "position").join(branches.drop("node"), "branch")
    where = where.select("conv_id", "branch", "depth", "begin", "above", (F.col("begin") + F.col("position") - F.col("origin")).alias("start"))
    before = F.transform("above", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    own = F.when(F.col("start") > F.col("begin"), F.array(F.struct(F.col("begin").alias("start"), F.col("start").alias("end")))).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
    nodes = where.join(turns, ["conv_id", "depth"]).select("node", "branch", "depth", "chunk", "token_ids", "start", "length", "position", "loss_start", "loss_end", F.concat(before, own).alias("ancestors"))
    spans = F.concat("above", F.array(F.struct("first", "last", "branch", F.col("begin").alias("start"), (F.col("begin") + F.col("total")).alias("end"))))
    leaves = turns.where("path is not null").select("conv_id", "node", (F.col("depth") + 1).alias("n_turns")).join(branches.select("node", "branch", spans.alias("spans")), "node")
    return nodes, leaves


class _Digest:
    """Digests of a conversation whose chunks are read one by one."""

    def __init__(self, leaf: int):
        self.leaf, self.turns, self.loss_chars, self.chars = leaf, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, chunk: str, lo: int | None, hi: int | None) -> None:
        for role, text, _, _ in parse(chunk):
            self.said.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        if lo is not None:
            text = unescape(chunk[lo:hi])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(chunk)

    def row(self) -> tuple:
        return self.leaf, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches):
    names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now = None
    for batch in batches:
        out = []
        for i in range(len(batch)):
            leaf, chunk, lo, hi = (c[i].as_py() for c in batch.columns)
            if now is None or leaf != now.leaf:
                if now:
                    out.append(now.row())
                now = _Digest(leaf)
            now.add(chunk, lo, hi)
        if out:
            yield _batch(out, names, kinds)
    if now:
        yield _batch([now.row()], names, kinds)


def read_back(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed from the tree: a leaf's spans name its chunks, the loss masks its loss text.

    -> (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).
    For trees whose tokens are code points.  Equal conversations are read once; chunks
    stream through a task in sorted order.  Null texts and roles come back empty, repeated
    turns each; a tree without nodes gives no rows.
    """
    once = leaves.groupBy("branch").agg(F.any_value("spans").alias("spans"))
    spans = once.select(F.col("branch").alias("leaf"), F.explode("spans").alias("s"))
    wanted = spans.select("leaf", F.col("s.branch").alias("branch"), F.explode(F.sequence("s.first", "s.last")).alias("depth"))
    parts = wanted.join(nodes.select("branch", "depth", "chunk", "loss_start", "loss_end"), ["branch", "depth"])
    dealt = parts.repartition("leaf").sortWithinPartitions("leaf", "depth").select("leaf", "chunk", "loss_start", "loss_end")
    read = dealt.mapInArrow(_digests, "leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return leaves.select("conv_id", F.col("branch").alias("leaf")).join(read, "leaf").drop("leaf")

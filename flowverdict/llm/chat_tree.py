"""Chat formatting as a prefix tree: shared initial turns are emitted once, depth-first.

A turn becomes the segment ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts a
backslash is doubled, ``<|`` becomes ``<\\|`` and a line break in a role ``\\n``, so control
strings occur only where the template puts them, and ``unescape`` gives the text back.

1. Rows are sorted within conversations and streamed; a turn's node is a 128-bit hash of its
   parent node, role and text, so conversations share nodes exactly as far as their initial
   turns are equal.
2. Equal nodes are combined by a grouped aggregate (map-side first, so a first turn that a
   third of all conversations share is no hot group).  A node belongs to the least
   conversation that has it.  The nodes of one owner form a chain, contiguous depth-first;
   chains hang below nodes of other chains.
3. A conversation's own rows tell the chains on its path, hence the sort key of its chain:
   for each chain on the path how deep it hangs (deepest first) and its owner.  Sorting nodes
   by chain key and depth is the depth-first order of the whole forest; a running total of
   token counts gives each node its place ``start``.
4. A node carries its first position id (tokens of its ancestors) and its attention
   intervals: for each chain on its path the places of the tokens it may see, its own chain up
   to its own end included (within its own tokens attention is causal).

Conversation ids are integers (others that cannot be cast are an error).  Null ids are one
conversation, ranked last; null roles and texts count as empty.  Turns are
ordered by turn (nulls first), then role, then text, and repeated rows are turns of their
own.  Extra columns are ignored.  An empty table gives an empty tree.  A conversation is
streamed through one task whatever its length; it is never held as a whole.
"""

from __future__ import annotations

import hashlib
import re
import struct
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowverdict.llm.bpe import encode, encoding
from flowverdict.llm.ordering import running_total
from flowverdict.sources.scratch import stored

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
_SEGMENT = re.compile(r"<\|im_start\|>(.*?)\n(.*)<\|im_end\|>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


# -- the template --------------------------------------------------------------------------

def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The segment and the code points of its text: from, to."""
    header = f"{START}{escape(role)}".replace("\n", "\\n") + "\n"
    body = escape(text)
    return f"{header}{body}{END}\n", len(header), len(header) + len(body)


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    match = _SEGMENT.fullmatch(segment)
    if match is None:
        raise ValueError(f"not a segment: {segment[:80]!r}")
    return unescape(match[1]), unescape(match[2])


# -- nodes ---------------------------------------------------------------------------------

def _node_of(parent: bytes, role: str, text: str) -> bytes:
    role_bytes = role.encode()
    head = parent + struct.pack(">Q", len(role_bytes)) + role_bytes
    return xxhash.xxh3_128_digest(head + text.encode())


def _walk(batches):
    conversation, depth, parent = None, 0, b""
    for batch in batches:
        columns = batch.to_pydict()
        depths, parents, nodes = [], [], []
        rows = zip(*(columns[c] for c in ("no_id", "conv_id", "role", "text")), strict=True)
        for no_id, conv_id, role, text in rows:
            if (no_id, conv_id) != conversation:
                conversation, depth, parent = (no_id, conv_id), 0, b""
            node = _node_of(parent, role, text)
            depths.append(depth)
            parents.append(parent)
            nodes.append(node)
            depth, parent = depth + 1, node
        yield pa.record_batch(
            {
                "no_id": batch.column("no_id"),
                "conv_id": batch.column("conv_id"),
                "depth": pa.array(depths, pa.int64()),
                "parent": pa.array(parents, pa.binary()),
                "node": pa.array(nodes, pa.binary()),
                "role": batch.column("role"),
                "text": batch.column("text"),
            }
        )


def turns_with_nodes(
    conversations: DataFrame, conv_id: str, turn: str, role: str, text: str
) -> DataFrame:
    rows = conversations.select(
        F.col(conv_id).isNull().alias("no_id"),
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    ordered = rows.repartition("no_id", "conv_id").sortWithinPartitions(
        "no_id", "conv_id", "turn", "role", "text"
    )
    schema = (
        "no_id boolean, conv_id long, depth long, parent binary, node binary, "
        "role string, text string"
    )
    return stored(ordered.mapInArrow(_walk, schema), "turns")


def _formatter(tokenizer: str):
    def run(batches):
        base = encoding(tokenizer).max_token_value
        newline = encode(tokenizer, "\n")
        for batch in batches:
            out = {c: [] for c in ("segment", "text_from", "text_to", "ids", "ids_from", "ids_to")}
            columns = batch.to_pydict()
            for role, text in zip(columns["role"], columns["text"], strict=True):
                segment, begin, end = format_turn(role, text)
                head = [base + 1, *encode(tokenizer, segment[len(START) : begin])]
                body = encode(tokenizer, segment[begin:end])
                out["segment"].append(segment)
                out["text_from"].append(begin)
                out["text_to"].append(end)
                out["ids"].append([*head, *body, base + 2, *newline])
                out["ids_from"].append(len(head))
                out["ids_to"].append(len(head) + len(body))
            kept = {c: batch.column(c) for c in ("node", "parent", "owner", "depth", "role")}
            types = {"segment": pa.string(), "ids": pa.list_(pa.int32())}
            made = {c: pa.array(v, types.get(c, pa.int64())) for c, v in out.items()}
            yield pa.record_batch(kept | made)

    return run


def format_nodes(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Stored distinct nodes with segment, ids, and where text and loss lie in either."""
    nodes = turns.groupBy("node").agg(
        F.min(F.struct("no_id", "conv_id")).alias("owner"),
        *[F.any_value(c).alias(c) for c in ("parent", "depth", "role", "text")],
    )
    schema = (
        "node binary, parent binary, owner struct<no_id: boolean, conv_id: bigint>, "
        "depth long, role string, segment string, text_from long, text_to long, "
        "ids array<int>, ids_from long, ids_to long"
    )
    formatted = nodes.mapInArrow(_formatter(tokenizer), schema)
    return stored(formatted.withColumn("n_ids", F.size("ids").cast("long")), "nodes")


# -- depth-first order ---------------------------------------------------------------------

def _owner_key(owner: dict) -> bytes:
    return struct.pack(">BQ", owner["no_id"], (owner["conv_id"] or 0) + (1 << 63))


def _path(batches):
    """For the rows that own their node: chain key, positions, and the chains above."""
    conversation = None
    key, above, chain_owner, position, in_chain, last = b"", [], None, 0, 0, b""
    for batch in batches:
        out = {
            c: []
            for c in ("node", "chain", "depth", "position", "before", "n_ids", "above")
        }
        columns = batch.to_pydict()
        names = ("no_id", "conv_id", "depth", "node", "owner", "n_ids")
        for no_id, conv_id, depth, node, owner, n_ids in zip(
            *(columns[c] for c in names), strict=True
        ):
            if (no_id, conv_id) != conversation:
                conversation = (no_id, conv_id)
                key, above, chain_owner, position, in_chain = b"", [], None, 0, 0
            if owner != chain_owner:
                if chain_owner is not None:
                    above = [*above, {"node": last, "n": in_chain}]
                key += struct.pack(">I", 0xFFFFFFFF - depth) + _owner_key(owner)
                chain_owner, in_chain = owner, 0
            if (owner["no_id"], owner["conv_id"]) == conversation:
                row = (node, key, depth, position, in_chain, n_ids, above)
                for column, cell in zip(out.values(), row, strict=True):
                    column.append(cell)
            position, in_chain, last = position + n_ids, in_chain + n_ids, node
        above_type = pa.list_(pa.struct([("node", pa.binary()), ("n", pa.int64())]))
        types = {"node": pa.binary(), "chain": pa.binary(), "above": above_type}
        yield pa.record_batch(
            {c: pa.array(v, types.get(c, pa.int64())) for c, v in out.items()}
        )


def place_nodes(turns: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, chain, depth, start, position, attention."""
    walked = turns.select("no_id", "conv_id", "depth", "node").join(
        nodes.select("node", "owner", "n_ids"), "node"
    )
    walked = walked.repartition("no_id", "conv_id").sortWithinPartitions(
        "no_id", "conv_id", "depth"
    )
    schema = (
        "node binary, chain binary, depth long, position long, before long, n_ids long, "
        "above array<struct<node: binary, n: bigint>>"
    )
    owned = walked.select("no_id", "conv_id", "depth", "node", "owner", "n_ids").mapInArrow(
        _path, schema
    )
    placed = stored(running_total(owned, ["chain", "depth"], "n_ids", "start"), "placed")
    # The chains above are the same for a whole chain: resolved once, at its head.
    heads = placed.filter("before = 0").select("chain", F.posexplode("above"))
    heads = heads.select("chain", "pos", "col.*")
    ends = placed.select("node", (F.col("start") + F.col("n_ids")).alias("end"))
    seen = heads.join(ends, "node").groupBy("chain").agg(
        F.array_sort(
            F.collect_list(F.struct("pos", (F.col("end") - F.col("n")).alias("start"), "end"))
        ).alias("seen")
    )
    seen = seen.withColumn(
        "seen", F.transform("seen", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    )
    own = F.struct(
        (F.col("start") - F.col("before")).alias("start"),
        (F.col("start") + F.col("n_ids")).alias("end"),
    )
    attention = F.when(F.col("seen").isNull(), F.array(own)).otherwise(
        F.array_append("seen", own)
    )
    return placed.join(seen, "chain", "left").select(
        "node", "chain", "start", "position", attention.alias("attention")
    )


class ChatTree(NamedTuple):
    """``nodes`` in depth-first order by ``start``; ``turns`` says which conversation has which.

    nodes: node, parent, owner, depth, role, segment, text_from, text_to (code points), ids,
    ids_from, ids_to, n_ids, chain, start, position, attention (start, end).  The loss mask is
    the text range of assistant turns.
    turns: no_id, conv_id, depth, node.
    """

    nodes: DataFrame
    turns: DataFrame


def chat_tree(
    conversations: DataFrame,
    tokenizer: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> ChatTree:
    turns = turns_with_nodes(conversations, conv_id, turn, role, text)
    nodes = format_nodes(turns, tokenizer)
    placed = place_nodes(turns, nodes)
    return ChatTree(
        nodes.join(placed, "node"), turns.select("no_id", "conv_id", "depth", "node")
    )


def with_position_ids(nodes: DataFrame) -> DataFrame:
    """Add ``position_ids``, one for each id: places along the path from the root."""
    ids = F.sequence(F.col("position"), F.col("position") + F.col("n_ids") - 1)
    return nodes.withColumn("position_ids", ids)


# -- reading back --------------------------------------------------------------------------

def _read_back(batches):
    state = None

    def finish(rows: list) -> None:
        if state is not None:
            (_, conv_id), n, turns, loss_n, loss, size = state
            rows.append((conv_id, n, turns.hexdigest(), loss_n, loss.hexdigest(), size))

    def table(rows: list) -> pa.RecordBatch:
        names = "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
        types = pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()
        cells = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.record_batch(
            {n: pa.array(c, t) for n, c, t in zip(names, cells, types, strict=True)}
        )

    for batch in batches:
        columns, rows = batch.to_pydict(), []
        names = ("no_id", "conv_id", "segment", "text_from", "text_to")
        for no_id, conv_id, segment, begin, end in zip(*(columns[c] for c in names), strict=True):
            if state is None or state[0] != (no_id, conv_id):
                finish(rows)
                state = [(no_id, conv_id), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_segment(segment)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            if role == ASSISTANT:
                masked = unescape(segment[begin:end])
                state[3] += len(masked)
                state[4].update(masked.encode())
            state[5] += len(segment)
        yield table(rows)
    rows: list = []
    finish(rows)
    yield table(rows)


def read_back(tree: ChatTree) -> DataFrame:
    """One row per conversation from the emitted segments: sizes and digests."""
    segments = tree.nodes.select("node", "segment", "text_from", "text_to")
    rows = tree.turns.join(segments, "node").repartition("no_id", "conv_id")
    rows = rows.sortWithinPartitions("no_id", "conv_id", "depth").drop("node")
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    return rows.mapInArrow(_read_back, schema)

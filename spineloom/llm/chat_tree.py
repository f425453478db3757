"""Chat formatting by a prefix tree: conversations that begin alike share the tokens of their first turns.

``pack`` formats every turn as a segment, ``<|im_start|>role`` line feed ``text<|im_end|>`` line feed, and encodes it by a
byte-level BPE, the control strings as ids of their own. A segment's key is a 128-bit hash chained over the conversation so
far, so equal keys are equal beginnings: a conversation is a path of keys, and the paths in sorted order are the prefix tree
depth first. Each path adds the segments beyond what it shares with the path before it, hence shared tokens are emitted once.

Paths are range-partitioned into shards of about ``shard_tokens`` tokens by (path, conversation): a first turn that a third of all
conversations share, or a conversation that occurs thousands of times, spans shards like any other rows. A shard is a
sequence of its own: where a tree goes on in the next shard, the open path is repeated at its start and marked ``repeated`` (no
loss is to be taken there again). A task walks its shard with a stack of open segments.

Rows of the result, in the order (shard, seq). A segment has ``start`` (its place in the shard), ``position`` (the position id of its
first token, those that follow count up), ``ids``, the tokens under the loss mask (``loss_from`` up to ``loss_to`` within the segment: an
assistant's text), and ``intervals``, the places of all its ancestors' tokens, which it may attend to besides its own earlier ones.
A conversation (``is_conversation``) has ``intervals`` of all its tokens. ``read_back`` gets conversations from these rows alone.

In texts and roles every ``<|`` gets a backslash (and ``<\\|`` another one), so no text holds a control string, and each
escape can be undone; in roles backslash and line feed are escaped as well, as a line feed ends the role.

Defined results: turns are ordered by (turn, role, text), null first; null text and role are empty; rows without a
conversation id are one conversation without id; repeated rows are turns of their own; an empty table gives no rows. Only the four
named columns are read. A conversation's keys (16 bytes a turn) and, when it is read back, its text are one row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spineloom.functions.columns import ref
from spineloom.llm.byte_bpe import Codec, codec
from spineloom.llm.tables import Tables
from spineloom.llm.words import slices

# The template.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

SHARD_TOKENS = 1 << 20
#: Tokens or characters of results that a task gathers before it sends them on.
FLUSH = 1 << 20

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """Segments of turns as tokens, and back. The ids of the control strings follow those of the vocabulary."""

    def __init__(self, own: Codec):
        self.codec = own
        self.start = max(own.bytes_of) + 2
        self.end = self.start + 1
        self.tail = [self.end, *own.encode("\n")]

    def segment(self, role: str, text: str) -> tuple[str, list[int], int, int]:
        """The formatted turn, its ids, and from which up to which of them its text lies."""
        role, text = escape_role(role), escape(text)
        head = [self.start, *self.codec.encode(f"{role}\n")]
        body = self.codec.encode(text)
        return f"{TURN_START}{role}\n{text}{TURN_END}\n", [*head, *body, *self.tail], len(head), len(head) + len(body)

    def decode(self, ids: np.ndarray) -> str:
        """The formatted text of whole segments; a character that tokens split comes out whole."""
        out = []
        at = 0
        for cut in [*np.flatnonzero(ids >= self.start).tolist(), len(ids)]:
            out.append(self.codec.decode(ids[at:cut].tolist()))
            if cut < len(ids):
                out.append(TURN_START if ids[cut] == self.start else TURN_END)
            at = cut + 1
        return "".join(out)


_template: dict[tuple[str, str], Template] = {}


def template(path: str, pattern: str) -> Template:
    """One template in each worker process."""
    if (path, pattern) not in _template:
        _template[path, pattern] = Template(codec(path, pattern))
    return _template[path, pattern]


def turns(conversations: DataFrame, path: str, pattern: str, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each turn as a segment: (conv, idx, key, ids, loss_from, loss_to), ``idx`` counting the turns of a conversation from 0."""
    read = conversations.select(
        ref(conv).alias("conv"),
        ref(turn).alias("turn"),
        F.coalesce(ref(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(ref(text).cast("string"), F.lit("")).alias("text"),
    )
    ordered = read.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    kind = ordered.schema["conv"].dataType
    schema = T.StructType(
        [
            T.StructField("conv", kind),
            T.StructField("idx", T.IntegerType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("loss_from", T.IntegerType()),
            T.StructField("loss_to", T.IntegerType()),
        ]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = template(path, pattern)
        last, idx, key = object(), -1, b""
        for batch in batches:
            for part in slices(batch, "text"):
                out: list[tuple] = []
                for own, role, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if own != last:
                        last, idx, key = own, -1, b""
                    written, ids, begin, end = form.segment(role, text)
                    idx, key = idx + 1, blake2b(key + written.encode(), digest_size=16).digest()
                    out.append((idx, key, ids, *((begin, end) if role == LOSS_ROLE else (0, 0))))
                number, keys, ids, begins, ends = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(number, pa.int32()),
                        pa.array(keys, pa.binary()),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array(begins, pa.int32()),
                        pa.array(ends, pa.int32()),
                    ],
                    schema.names,
                )

    return ordered.mapInArrow(task, schema)


def _coalesced(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _packed_schema(kind: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("seq", T.LongType()),
            T.StructField("is_conversation", T.BooleanType()),
            T.StructField("conv", kind),
            T.StructField("start", T.LongType()),
            T.StructField("position", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("loss_from", T.IntegerType()),
            T.StructField("loss_to", T.IntegerType()),
            T.StructField("repeated", T.BooleanType()),
            T.StructField("intervals", _SPANS),
        ]
    )


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, level, is_conversation, conv, ids, loss_from, loss_to, repeated) in depth-first order, laid out shard by shard."""
    shard, seq, at = None, 0, 0
    stack: list[tuple[int, int]] = []  # of each open segment where it lies

    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        shards, levels, ends, repeats = (columns[i].to_pylist() for i in (0, 1, 2, 7))
        sizes = pa.compute.fill_null(pa.compute.list_value_length(columns[4]), 0).to_pylist()
        starts, positions, spans, numbers = [], [], [], []
        for own, level, end, size in zip(shards, levels, ends, sizes, strict=True):
            if own != shard:
                shard, seq, at, stack = own, 0, 0, []
            del stack[level:]
            spans.append([{"from": a, "to": b} for a, b in _coalesced(stack)])
            starts.append(None if end else at)
            positions.append(None if end else sum(b - a for a, b in stack))
            numbers.append(seq)
            seq += 1
            if not end:
                stack.append((at, at + size))
                at += size
        yield pa.RecordBatch.from_arrays(
            [
                columns[0],
                pa.array(numbers, pa.int64()),
                columns[2],
                columns[3],
                pa.array(starts, pa.int64()),
                pa.array(positions, pa.int64()),
                *columns[4:7],
                pa.array(repeats, pa.bool_()),
                pa.array(spans, _ARROW_SPANS),
            ],
            ["shard", "seq", "is_conversation", "conv", "start", "position", "ids", "loss_from", "loss_to", "repeated", "intervals"],
        )


def pack(
    conversations: DataFrame,
    path: str,
    pattern: str,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """The prefix tree of all conversations as packed shards: one row for each segment and each conversation."""
    store = Tables(conversations.sparkSession, "chat")
    segments = store(turns(conversations, path, pattern, conv, turn, role, text))
    tokens = segments.agg(F.sum(F.size("ids"))).first()[0] or 0
    links = F.array_sort(F.collect_list(F.struct("idx", "key")))
    paths = segments.groupBy("conv").agg(links.alias("links")).select("conv", F.col("links.key").alias("path"))
    # Which rows a shard holds depends on the samples of the shuffle, so it is stored before it is read more than once.
    dealt = paths.repartitionByRange(max(1, -(-tokens // shard_tokens)), "path", "conv")
    placed = store(dealt.withColumn("shard", F.spark_partition_id()))

    order = Window.partitionBy("shard").orderBy("path", "conv")
    n = F.size("path")
    apart = F.array_position(F.zip_with("path", F.lag("path").over(order), lambda a, b: a.eqNullSafe(b)), F.lit(False))
    shared = F.when(F.lag("path").over(order).isNull(), 0).when(apart == 0, n).otherwise(apart - 1).cast("int")
    walked = placed.select("shard", "conv", "path", F.row_number().over(order).alias("row"), shared.alias("shared"), n.alias("n"))
    levels = F.when(F.col("shared") < F.col("n"), F.sequence(F.col("shared"), F.col("n") - 1))
    nodes = walked.select("shard", "row", "conv", "path", F.explode(levels).alias("level"))
    nodes = nodes.select("shard", "row", "conv", "level", F.get("path", F.col("level")).alias("key"))
    # A key occurs once in a shard: the group has as many rows as there are shards that hold it.
    earliest = F.min("shard").over(Window.partitionBy("key"))
    nodes = nodes.select("shard", "row", "conv", "level", (F.col("shard") > earliest).alias("repeated"))

    texts = segments.select(F.col("conv").alias("__conv"), "idx", "ids", "loss_from", "loss_to")
    same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("level") == F.col("idx"))
    opened = nodes.join(texts, same).withColumn("is_conversation", F.lit(False))
    closed = walked.select("shard", "row", "conv", F.col("n").alias("level"), F.lit(True).alias("is_conversation"))
    both = opened.unionByName(closed, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", "row", "level")
    owner = F.when(F.col("is_conversation"), F.col("conv")).alias("conv")
    rows = both.select("shard", "level", "is_conversation", owner, "ids", "loss_from", "loss_to", "repeated")
    return rows.mapInArrow(_pack, _packed_schema(conversations.schema[conv].dataType))


def read_back(packed: DataFrame, path: str, pattern: str) -> DataFrame:
    """(conv, formatted, turns, loss) of each conversation, from the rows of ``pack``: the formatted text, its turns with roles and
    texts unescaped, and all text under the loss mask."""
    kind = packed.schema["conv"].dataType
    turn = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    schema = T.StructType(
        [
            T.StructField("conv", kind),
            T.StructField("formatted", T.StringType()),
            T.StructField("turns", T.ArrayType(turn)),
            T.StructField("loss", T.StringType()),
        ]
    )
    arrow_turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = template(path, pattern)
        shard = None
        starts: list[int] = []
        segments: list[tuple[str, str]] = []  # formatted, text under the mask

        def sent(rows: list[int], owners: pa.Array, found: list[tuple]) -> pa.RecordBatch:
            whole, each, loss = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [owners.take(pa.array(rows)), pa.array(whole, pa.string()), pa.array(each, arrow_turn), pa.array(loss, pa.string())],
                schema.names,
            )

        for batch in batches:
            owners = batch.column(2)
            rows: list[int] = []
            found: list[tuple] = []
            held = 0
            values = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 5, 6, 7)), range(batch.num_rows), strict=True)
            tokens, borders = batch.column(4).flatten(), np.concatenate(([0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(batch.column(4)), 0))))
            tokens = np.asarray(tokens)
            for own, is_conversation, start, begin, end, spans, i in values:
                if own != shard:
                    shard, starts, segments = own, [], []
                if not is_conversation:
                    ids = tokens[borders[i] : borders[i + 1]]
                    starts.append(start)
                    segments.append((form.decode(ids), unescape(form.codec.decode(ids[begin:end].tolist())) if end else ""))
                    continue
                parts = [segments[k] for s in spans for k in range(bisect_left(starts, s["from"]), bisect_left(starts, s["to"]))]
                whole = "".join(p[0] for p in parts)
                each = [_parsed(t) for t in whole.split(TURN_START)[1:]]
                rows.append(i)
                found.append((whole, each, "".join(p[1] for p in parts)))
                held += len(whole)
                if held > FLUSH:
                    yield sent(rows, owners, found)
                    rows, found, held = [], [], 0
            if rows:
                yield sent(rows, owners, found)

    columns = ("shard", "is_conversation", "conv", "start", "ids", "loss_from", "loss_to", "intervals")
    ordered = packed.select(*columns, "seq").repartition("shard").sortWithinPartitions("shard", "seq").select(*columns)
    return ordered.mapInArrow(task, schema)


def _parsed(written: str) -> dict[str, str]:
    """Role and text of a turn, given what follows its start."""
    role, text = written.removesuffix("\n").removesuffix(TURN_END).split("\n", 1)
    return {"role": unescape_role(role), "text": unescape(text)}

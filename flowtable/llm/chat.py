"""Chat formatting by columnar byte assembly.

A turn is written as ``<turn>role\\ntext\\n</turn>\\n``.  In a text, one backslash goes before each ``<turn>`` and
``</turn>`` (after backslashes that stand there already); in a role, backslash, line feed and ``<`` are escaped.
Both are undone exactly.  The loss mask covers the texts of one role.

Turns are range-partitioned by conversation and turn, so a conversation of any length spreads over tasks.  A task
assembles a batch at a time: segment lengths give cumulative offsets, these give scatter indices, and headers,
texts and ends are copied into one preallocated buffer that becomes the Arrow column.  The turns of a conversation
in one batch are one piece; its pieces in order are the formatted conversation.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.llm.common import materialize, table

OPEN, CLOSE = b"<turn>", b"</turn>"
END = b"\n" + CLOSE + b"\n"
SLICE_BYTES = 16 << 20  # texts assembled at once; a longer text stands alone
SCATTER = 1 << 20  # scatter indices held at once
ROWS = 4096  # digests in a batch
KEEP_BYTES = 32 << 20  # of a conversation that may go on in the next task, held before it is passed on

_ROLE_ESCAPES = {b"\\": b"\\\\", b"\n": b"\\n", b"<": b"\\<"}
_TURN = re.compile(rb"<turn>([^\n]*)\n(.*?)\n</turn>\n", re.DOTALL)
_ESCAPED = re.compile(rb"\\(</?turn>)")


def escape_role(role: bytes) -> bytes:
    return re.sub(rb"[\\\n<]", lambda m: _ROLE_ESCAPES[m[0]], role)


def unescape_role(role: bytes) -> bytes:
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], role)


def unescape_text(text: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", text)


def parse_turns(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """``(role, text)`` of every turn of a formatted conversation or piece; anything else is an error."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"not a formatted turn at byte {at}")
        out.append((unescape_role(turn[1]), unescape_text(turn[2])))
        at = turn.end()
    return out


# -- assembly of one batch

def _string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and UTF-8 bytes of a string column; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    large = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if large else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def _control_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of control strings that lie inside one row, ascending."""
    found = [np.zeros(0, dtype=np.int64)]
    starts = np.flatnonzero(data == OPEN[0])
    for control in (OPEN, CLOSE):
        at = starts[starts + len(control) <= len(data)]
        for i, byte in enumerate(control[1:], 1):
            at = at[data[at + i] == byte]
        row = np.searchsorted(offsets, at, side="right") - 1
        found.append(at[at + len(control) <= offsets[row + 1]])
    return np.sort(np.concatenate(found))


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + length - 1`` of all runs in one array."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def assemble(new: np.ndarray, role: pa.Array, text: pa.Array, loss_role: str) -> dict[str, pa.Array]:
    """Pieces of rows that follow each other; ``new`` says which rows begin a piece (the first one must)."""
    offsets, data = _string_bytes(text)
    roles = pc.dictionary_encode(pc.fill_null(role, ""))
    names = [r.encode() for r in roles.dictionary.to_pylist()]
    role_of = roles.indices.to_numpy()
    headers = [OPEN + escape_role(r) + b"\n" for r in names]
    header_length = np.array([len(h) for h in headers], dtype=np.int64)
    header_start = np.cumsum(header_length) - header_length
    # segment lengths and cumulative offsets
    control = _control_starts(data, offsets)
    control_row = np.searchsorted(offsets, control, side="right") - 1
    head = header_length[role_of]
    body = np.diff(offsets) + np.bincount(control_row, minlength=len(role_of))
    turn_end = np.cumsum(head + body + len(END))
    turn_start = turn_end - (head + body + len(END))
    body_start = turn_start + head
    out = np.empty(turn_end[-1], dtype=np.uint8)
    # headers and ends
    header_bytes = np.frombuffer(b"".join(headers), dtype=np.uint8)
    out[_runs(turn_start, head)] = header_bytes[_runs(header_start[role_of], head)]
    out[(turn_end - len(END))[:, None] + np.arange(len(END))] = np.frombuffer(END, dtype=np.uint8)
    # texts: bytes move by a step that changes where a row or a control string begins
    before_row = np.searchsorted(control, offsets[:-1])
    step_at = np.concatenate([offsets[:-1], control])
    step = np.concatenate([body_start - offsets[:-1],
                           body_start[control_row] - offsets[control_row] + np.arange(1, len(control) + 1)
                           - before_row[control_row]])
    order = np.argsort(step_at, kind="stable")  # at one place the row's step comes before its control string's
    step_at, step = step_at[order], step[order]
    for lo in range(0, len(data), SCATTER):
        hi = min(lo + SCATTER, len(data))
        a = np.searchsorted(step_at, lo, side="right") - 1
        b = np.searchsorted(step_at, hi, side="left")
        edges = np.clip(np.append(step_at[a:b], hi), lo, hi)
        out[np.arange(lo, hi) + np.repeat(step[a:b], np.diff(edges))] = data[lo:hi]
    out[control + body_start[control_row] - offsets[control_row] + np.arange(len(control)) - before_row[control_row]] = ord("\\")
    # pieces
    first = np.flatnonzero(new)
    piece_of = np.cumsum(new) - 1
    starts = turn_start[first]
    loss = np.flatnonzero(np.isin(role_of, [i for i, r in enumerate(names) if r == loss_role.encode()]))
    loss_offsets = pa.array(np.append(np.searchsorted(piece_of[loss], np.arange(len(first))), len(loss)).astype(np.int32))
    text_offsets = np.append(starts, len(out)).astype(np.int32)
    return {
        "text": pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(text_offsets), pa.py_buffer(out)]),
        "loss_start": pa.ListArray.from_arrays(loss_offsets, pa.array(body_start[loss] - starts[piece_of[loss]])),
        "loss_length": pa.ListArray.from_arrays(loss_offsets, pa.array(body[loss])),
        "n_turns": pa.array(np.diff(np.append(first, len(new)))),
        "n_chars": pa.array(np.add.reduceat((out & 0xC0) != 0x80, starts, dtype=np.int64)),
    }


def _slices(text: pa.Array):
    """Runs of rows with at most ``SLICE_BYTES`` of text, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield at, upto
        at = upto


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """Pieces ``conv, piece, text, loss_start, loss_length, n_turns, n_chars`` of all conversations.

    The pieces of a conversation joined by ``piece`` are its text; ``loss_start`` and ``loss_length`` are spans of
    UTF-8 bytes of the piece that hold the (escaped) texts of ``loss_role``, empty ones included.  ``n_chars`` counts
    code points.  Turns are in the order of ``turn``; equal turns by role, then a hash of the text; a null turn comes
    first.  Null roles and texts read as empty; rows with a null conversation are one conversation with a null id;
    repeated rows are turns of their own.  Texts are whole, of any length that a string holds.  No rows give no
    rows; other columns are not read.
    """
    kind = df.schema[conv_col].dataType
    turns = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                      F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    turns = turns.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["conv", "turn", "role", "tie", "row"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)

    def pieces(batches):
        piece = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, upto in _slices(batch.column("text")):
                part = batch.slice(at, upto - at)
                conv = part.column("conv")
                codes = pc.dictionary_encode(conv, null_encoding="encode").indices.to_numpy()
                new = np.append(True, codes[1:] != codes[:-1])
                made = assemble(new, part.column("role"), part.column("text"), loss_role)
                n = len(made["text"])
                made = {"conv": conv.take(pa.array(np.flatnonzero(new))), "piece": pa.array(np.arange(piece, piece + n))} | made
                piece += n
                yield pa.RecordBatch.from_pydict(made)

    return dealt.select("conv", "role", "text").mapInArrow(pieces, T.StructType(
        [T.StructField("conv", kind), *T._parse_datatype_string(PIECE).fields]))


PIECE = "piece long, text string, loss_start array<long>, loss_length array<long>, n_turns long, n_chars long"


# -- reading back

class _Digest:
    """Running digests of one conversation, read from its pieces."""

    def __init__(self, conv):
        self.conv, self.n_turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, pieces) -> _Digest:
        for _, _, text, loss_start, loss_length in pieces:
            for role, said in parse_turns(text):
                self.n_turns += 1
                self.turns.update(b"%s\n%s\n" % (role, said))
            for at, length in zip(loss_start, loss_length):
                said = unescape_text(text[at:at + length])
                self.loss.update(said)
                self.loss_chars += len(said.decode("utf-8", "replace"))
            self.chars += len(text.decode("utf-8", "replace"))
        return self

    def row(self) -> dict:
        return {"conv": self.conv, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_OPEN_PIECE = "piece long, text string, loss_start array<long>, loss_length array<long>"
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}


def _piece_rows(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for conv, piece, text, start, length in zip(batch.column("conv"), batch.column("piece"), texts,
                                                    batch.column("loss_start"), batch.column("loss_length")):
            yield conv.as_py(), piece.as_py(), text.as_py(), start.as_py(), length.as_py()


def digest_conversations(pieces: DataFrame) -> DataFrame:
    """``conv`` with the digests of its turns and of the text under its loss mask, read from its pieces.

    ``pieces`` is the result of ``format_conversations``.  A task digests the conversations that lie inside its range;
    those at its edges may go on in another task: their pieces alone are shuffled and read in order, in bounded
    memory.  (A digest of one conversation is a sequential hash; its formatting is spread over tasks all the same.)
    """
    kind = pieces.schema["conv"].dataType
    conv_type = pieces.select("conv").limit(0).toArrow().schema.field("conv").type
    digest_schema = T.StructType([T.StructField("conv", kind), *T._parse_datatype_string(DIGEST).fields])
    both = T.StructType([*digest_schema.fields, *T._parse_datatype_string(_OPEN_PIECE).fields])

    def rows_of(rows, schema):
        columns = [pa.array([r.get(f.name) for r in rows],
                            type=conv_type if f.name == "conv" else _ARROW[f.dataType.simpleString()]) for f in schema]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def passed_on(held):
        return rows_of([{"conv": p[0], "piece": p[1], "text": p[2].decode("utf-8", "replace"), "loss_start": p[3],
                         "loss_length": p[4]} for p in held], both)

    def inner(batches):
        done, held = [], []
        for i, (conv, rows) in enumerate(groupby(_piece_rows(batches), key=itemgetter(0))):
            if held:  # the conversation before, all of it
                done.append(_Digest(held[0][0]).read(held).row())
            if len(done) >= ROWS:
                yield rows_of(done, both)
                done = []
            held, size, whole = [], 0, i > 0  # the first one may have begun in another task
            for row in rows:
                held.append(row)
                size += len(row[2])
                if size > KEEP_BYTES:
                    yield passed_on(held)
                    held, size, whole = [], 0, False
            if held and not whole:
                yield passed_on(held)
                held = []
        if held:  # the last one may go on in another task
            yield passed_on(held)
        if done:
            yield rows_of(done, both)

    def outer(batches):
        done = []
        for conv, rows in groupby(_piece_rows(batches), key=itemgetter(0)):
            done.append(_Digest(conv).read(rows).row())
            if len(done) >= ROWS:
                yield rows_of(done, digest_schema)
                done = []
        if done:
            yield rows_of(done, digest_schema)

    piece = ["conv", "piece", "text", "loss_start", "loss_length"]
    read = materialize(pieces.select(*piece).mapInArrow(inner, both), "chats")
    edges = read.where("piece IS NOT NULL").select(*piece).repartition("conv").sortWithinPartitions("conv", "piece")
    return (read.where("piece IS NULL").select(*digest_schema.names)
            .unionByName(edges.mapInArrow(outer, digest_schema)))


#: A conversation that says control strings; added to the table by the query.
PROBE = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, read back from the formatted text, of all ``conversations`` and conversation -7."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return digest_conversations(format_conversations(rows.unionByName(probe))).withColumnRenamed("conv", "conv_id")


#: DuckDB SQL for the rows of ``op13_chat_format``.
OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
f AS (
  SELECT *, '<turn>' || replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<', '\<') || chr(10)
            || regexp_replace(text, '(</?turn>)', '\\\1', 'g') || chr(10) || '</turn>' || chr(10) AS formatted FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

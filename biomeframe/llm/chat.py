"""Chat formatting by columnar byte assembly.

Turns of a batch are assembled in numpy: lengths of headers, escaped contents and
footers give offsets, offsets give scatter indices, and all bytes are copied into
one preallocated buffer that becomes an Arrow column without another copy.

The template marks turns by role; any other role is spelled out. Inside a text
(and a spelled-out role), a backslash is put after each ``[``, ``<`` and
backslash. Every control string continues its first bracket with something else
than a backslash, so none can occur in a text, and taking the backslashes out
again gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from biomeframe.llm.common import shipped

#: Role: what stands before and after its text.
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s>", "</s>\n"),
}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]\n")
LOSS_ROLE = "assistant"
_SLASH = ord("\\")
_ROWS = 4096


def escaped_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``data`` with a backslash after each special one, and where each
    byte went (one more entry: the end)."""
    special = (data == ord("[")) | (data == ord("<")) | (data == _SLASH)
    place = np.concatenate(([0], np.cumsum(special + np.int64(1))))
    out = np.full(place[-1], _SLASH, dtype=np.uint8)
    out[place[:-1]] = data
    return out, place


def unescaped(text: str) -> str:
    return re.sub(r"([\[<\\])\\", r"\1", text)


def _frame(role: str | None) -> tuple[bytes, bytes]:
    if role in TEMPLATE:
        return tuple(x.encode() for x in TEMPLATE[role])
    name = np.frombuffer((role or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    name = escaped_bytes(name)[0].tobytes()
    return OTHER[0].encode() + name + OTHER[1].encode(), OTHER[2].encode()


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray):
    """Copy segments data[begin : begin + size] to out[at : at + size], all at once."""
    ends = np.cumsum(size)
    step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    out[np.repeat(at, size) + step] = data[np.repeat(begin, size) + step]


def format_turns(roles: list, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted turns, and of each: its code points, where its text starts, the text's
    code points. ``texts`` is a large_string array without nulls."""
    _, offsets, values = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(values or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    body, place = escaped_bytes(raw)
    begin = place[offsets - offsets[0]]
    size = np.diff(begin)
    names = list(dict.fromkeys(roles))
    frames = [_frame(r) for r in names]
    heads = np.frombuffer(b"".join(a for a, _ in frames), dtype=np.uint8)
    tails = np.frombuffer(b"".join(b for _, b in frames), dtype=np.uint8)
    role = np.array([names.index(r) for r in roles], dtype=np.int64)
    head_size = np.array([len(a) for a, _ in frames], dtype=np.int64)
    tail_size = np.array([len(b) for _, b in frames], dtype=np.int64)
    head_at = np.cumsum(head_size) - head_size
    tail_at = np.cumsum(tail_size) - tail_size
    total = head_size[role] + size + tail_size[role]
    start = np.concatenate(([0], np.cumsum(total)))
    out = np.empty(start[-1], dtype=np.uint8)
    _scatter(out, start[:-1], heads, head_at[role], head_size[role])
    _scatter(out, start[:-1] + head_size[role], body, begin[:-1], size)
    _scatter(out, start[1:] - tail_size[role], tails, tail_at[role], tail_size[role])
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    made = pa.Array.from_buffers(
        pa.large_string(), n, [None, pa.py_buffer(start.astype(np.int64)), pa.py_buffer(out)]
    )
    text_from = start[:-1] + head_size[role]
    chars = points[start[1:]] - points[start[:-1]]
    lead = points[text_from] - points[start[:-1]]
    return made, chars, lead, points[text_from + size] - points[text_from]


_SPAN = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def format_conversations(
    rows: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id, text, loss (array of start, end in code points), one row for each conversation.

    Turns are ordered by turn, then role and text; nulls come first. A null text
    is empty, a null role a spelled-out empty one; rows with a null conv_id are
    one conversation. Repeated rows are turns of their own. Extra columns are
    ignored.

    Turns are formatted before the shuffle. After it, each task walks through its
    sorted turns and holds one conversation at a time: a conversation is one
    value, so its task cannot be divided further.
    """
    shipped(rows.sparkSession)
    turns = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    key = turns.schema["conv_id"]
    one = StructType([
        key, turns.schema["turn"], StructField("role", StringType()),
        StructField("plain", StringType()), StructField("text", StringType()),
        *[StructField(c, LongType()) for c in ("chars", "lead", "size")],
    ])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                texts = batch.column(3).cast(pa.large_string())
                made, chars, lead, size = format_turns(batch.column(2).to_pylist(), texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), batch.column(3),
                     made.cast(pa.string()), pa.array(chars), pa.array(lead), pa.array(size)],
                    names=one.names,
                )

    formatted = turns.mapInArrow(each, one).repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "plain"
    ).select("conv_id", "role", "text", "chars", "lead", "size")
    whole_schema = StructType([key, StructField("text", StringType()), StructField("loss", _SPAN)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], span)], names=whole_schema.names,
            )

        kind, span = pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        now, parts, loss, at, done, size = (), [], [], 0, [], 0
        for batch in batches:
            kind = batch.schema.field(0).type
            for key, role, text, chars, lead, length in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (key,):
                    if parts:
                        done.append((now[0], "".join(parts), loss))
                        size += at
                    if size > 1 << 22:
                        yield made(done)
                        done, size = [], 0
                    now, parts, loss, at = (key,), [], [], 0
                parts.append(text)
                if role == LOSS_ROLE:
                    loss.append({"start": at + lead, "end": at + lead + length})
                at += chars
        if parts:
            done.append((now[0], "".join(parts), loss))
        if done:
            yield made(done)

    return formatted.mapInArrow(join, whole_schema)


_CONTROL = re.compile(
    "|".join(
        rf"{re.escape(a)}(?P<{name}>.*?){re.escape(b)}" for name, (a, b) in TEMPLATE.items()
    )
    + rf"|{re.escape(OTHER[0])}(?P<name>.*?){re.escape(OTHER[1])}(?P<other>.*?){re.escape(OTHER[2])}",
    re.DOTALL,
)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation; raises if it is none."""
    out, at = [], 0
    while at < len(text):
        found = _CONTROL.match(text, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        kind = found.lastgroup
        role = unescaped(found["name"]) if kind == "other" else kind
        out.append((role, unescaped(found[kind])))
        at = found.end()
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the
    formatted texts and spans alone."""
    shipped(formatted.sparkSession)
    schema = StructType([
        formatted.schema["conv_id"], StructField("n_turns", LongType()),
        StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
    ])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, loss in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                turns, masked, chars = hashlib.sha256(), hashlib.sha256(), 0
                read = parse(text)
                for role, said in read:
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in loss.as_py():
                    said = unescaped(text[span["start"] : span["end"]])
                    masked.update(said.encode("utf-8", "surrogatepass"))
                    chars += len(said)
                out.append((len(read), turns.hexdigest(), chars, masked.hexdigest(), len(text)))
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=schema.names,
            )

    return formatted.select("conv_id", "text", "loss").mapInArrow(of, schema)

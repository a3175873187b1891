r"""Chat formatting with a grammar round trip.

A turn becomes one segment that starts and ends at the top level of the
grammar, so a conversation's text is the concatenation of its segments:

    segment := "<s>[INST] " text " [/INST]"            user
             | "<s>[ASST] " text "</s>"                assistant (its text is under the loss mask)
             | "<s><<SYS>>" text "<</SYS>>"            system
             | "<s>[ROLE:" role "] " text " [/ROLE]"   any other role

``parse`` is a deterministic parser of that grammar.  A segment is first
rendered with its text as it is, reparsed and compared with its source; if
anything differs, content that looks like a control string gets one more
backslash after its first character, until the round trip is identical.
Unescaping removes one backslash, so text that already looks escaped comes
back unchanged.

Segments are made row by row.  A conversation is put in order by shuffling
on its id and sorting; it is then read as a stream, so no conversation has
to fit into memory; only ``conversations``, whose result is one row per
conversation, gathers its text.

Defined cases: a null text is the empty text, a null role the empty role;
rows stand by turn (null first), then role, then text, so ties and
repeated rows (each is a turn) have one order; a null conversation id is a
conversation of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoria.llm.common import col, partitions

__all__ = ["render", "parse", "segments", "conversations", "digests", "ROLES"]

#: Opening and closing control strings of the named roles.
ROLES = {"user": ("[INST] ", " [/INST]"), "assistant": ("[ASST] ", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
BEGIN = "<s>"
#: A control string, its first character apart, with any number of escapes between.
_CONTROL = re.compile(r"([<\[])(\\*)(s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]|ASST\]|ROLE:|/ROLE\])")
_HEAD = re.compile(r"<s>(\[INST\] |\[ASST\] |<<SYS>>|\[ROLE:)")
_BY_OPEN = {o: (r, c) for r, (o, c) in ROLES.items()}


def _escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def _unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def _escape_role(role: str) -> str:
    return _escape(role).replace("\\", "\\\\").replace("]", "\\)")


def _unescape_role(role: str) -> str:
    return _unescape(re.sub(r"\\(.)", lambda m: "]" if m[1] == ")" else m[1], role, flags=re.S))


def _plain(role: str, text: str) -> str:
    if role in ROLES:
        return BEGIN + ROLES[role][0] + text + ROLES[role][1]
    return f"{BEGIN}[ROLE:{_escape_role(role)}] {text} [/ROLE]"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; start and end enclose the escaped text.  Raises ValueError."""
    out, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        if not head:
            raise ValueError(f"no turn begins at {at}")
        start = head.end()
        if head[1] == "[ROLE:":
            stop = formatted.find("] ", start)
            if stop < 0:
                raise ValueError(f"role not closed at {at}")
            role, close, start = _unescape_role(formatted[start:stop]), " [/ROLE]", stop + 2
        else:
            role, close = _BY_OPEN[head[1]]
        bare = close.lstrip(" ")
        # the first control string without an escape must close the turn
        pos = start
        while True:
            m = _CONTROL.search(formatted, pos)
            if not m:
                raise ValueError(f"turn not closed at {at}")
            if not m[2]:
                break
            pos = m.end()
        end = m.start() - (len(close) - len(bare))
        if end < start or not formatted.startswith(close, end):
            raise ValueError(f"turn closed by another at {m.start()}")
        out.append((role, _unescape(formatted[start:end]), start, end))
        at = end + len(close)
    return out


def loss_spans(turns: list[tuple[str, str, int, int]]) -> list[tuple[int, int]]:
    """The loss mask of parsed turns: where the assistant's escaped texts stand, in order; no other place is under it."""
    return [(start, end) for role, _, start, end in turns if role == "assistant"]


def _round_trip(segment: str, role: str, text: str) -> bool:
    try:
        got = parse(segment)
    except ValueError:
        return False
    return [g[:2] for g in got] == [(role, text)]


def render(role: str, text: str, max_rounds: int = 3) -> str:
    """The segment of one turn, escaped until it reads back identically."""
    content = text
    for _ in range(max_rounds):
        segment = _plain(role, content)
        if _round_trip(segment, role, text):
            return segment
        content = _escape(content)
    raise ValueError("the grammar cannot hold this turn")


def segments(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, segment), one row per turn; no shuffle."""
    def run(role: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([render(r, t) for r, t in zip(role, text)], dtype=object)

    conv = col(conv_col)
    if turns.schema[conv_col].dataType.typeName() != "string":
        conv = conv.cast("long")
    t = turns.select(conv.alias("conv_id"), col(turn_col).alias("turn"),
                     F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    return t.withColumn("segment", F.pandas_udf(run, "string")("role", "text"))


def conversations(segs: DataFrame) -> DataFrame:
    """(conv_id, formatted): one text per conversation, which must fit into a row."""
    parts = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "segment")))
    return segs.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["segment"]), "").alias("formatted"))


def loss_masks(segs: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): the formatted conversations with the spans a training loss is taken over."""
    def run(formatted: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b} for a, b in loss_spans(parse(f))] for f in formatted], dtype=object)

    return conversations(segs).withColumn("loss_spans", F.pandas_udf(run, "array<struct<start: int, end: int>>")("formatted"))


def digests(segs: DataFrame) -> DataFrame:
    """What is read back from the formatted text of each conversation, as a stream over its segments.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn),
    loss_chars and loss_sha256 (the unescaped text under the loss mask: the
    assistant's texts), formatted_chars.
    """
    text_id = segs.schema["conv_id"].dataType.typeName() == "string"
    schema = pa.schema([("conv_id", pa.string() if text_id else pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        done, state, now = [], None, None

        def close():
            n, turns, chars, loss, total = state
            done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for batch in batches:
            for conv, segment in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = parse(segment)
                for role, text, _, _ in turns:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for start, end in loss_spans(turns):
                    text = _unescape(segment[start:end])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(segment)
            if done:
                yield _rows(done, schema)
                done = []
        if state is not None:
            close()
            yield _rows(done, schema)

    placed = segs.repartition(partitions(segs.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = "string" if text_id else "long"
    return placed.select("conv_id", "segment").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _rows(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

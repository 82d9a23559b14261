"""Chat formatting by columnar byte assembly, with a loss mask over assistant texts.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts every ``<``, any
number of backslashes, ``|`` gets one backslash more, so no marker can begin inside a text and taking
one away undoes it; in roles backslashes and line breaks are escaped before. Whole
batches are assembled at once: lengths of all segments, their cumulative offsets, and
scatter indices in numpy fill one preallocated buffer that becomes the Arrow column.

Rows are dealt by conversation and sorted within tasks, then streamed: no conversation is gathered. One that is longer
than a batch comes as several parts, numbered in order, whose texts follow each other.

Edge cases: null roles and texts are empty; null conversation ids are one conversation;
turns are ordered by turn, role, text, nulls first, so ties and repeated rows have one order and all are
kept; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytework import text_array, text_buffer

START, END = "<|im_start|>", "<|im_end|>"
#: The role under the loss mask.
LEARNT_ROLE = "assistant"


def _escaped(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.fill_null(column, ""), r"<(\\*)\|", r"<\\\1|")


def _escaped_role(column: pa.Array) -> pa.Array:
    plain = pc.replace_substring(pc.replace_substring(pc.fill_null(column, ""), "\\", "\\\\"), "\n", "\\n")
    return _escaped(plain)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Copies data[start:start + length] to out[at:] for all segments at once."""
    total = int(lengths.sum())
    inner = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(at, lengths) + inner] = data[np.repeat(starts, lengths) + inner]


def assembled(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns in order, each turn's offset, and its text's start and end."""
    head, mid, tail = (np.frombuffer(s.encode(), dtype=np.uint8) for s in (START, "\n", f"{END}\n"))
    role, role_at = text_buffer(_escaped_role(roles))
    text, text_at = text_buffer(_escaped(texts))
    n = len(role_at) - 1
    role_n, text_n = np.diff(role_at), np.diff(text_at)
    sizes = np.stack([np.full(n, len(head)), role_n, np.full(n, 1), text_n, np.full(n, len(tail))], axis=1)
    ends = np.cumsum(sizes.ravel()).reshape(sizes.shape) if n else sizes
    begins = ends - sizes
    out = np.empty(int(sizes.sum()), dtype=np.uint8)
    for column, constant in ((0, head), (2, mid), (4, tail)):
        out[begins[:, column, None] + np.arange(len(constant))] = constant
    _scatter(out, begins[:, 1], role, role_at[:-1], role_n)
    _scatter(out, begins[:, 3], text, text_at[:-1], text_n)
    return out, np.append(begins[:, 0], len(out)).astype(np.int64), begins[:, 3].astype(np.int64), ends[:, 3].astype(np.int64)


_LISTS = pa.list_(pa.int64())
FORMATTED = "conv_id long, part int, formatted string, loss_start array<long>, loss_end array<long>"


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conv_id, part, formatted, loss_start, loss_end), the spans being byte ranges of the part.

    Parts of a conversation lie in order within one task.
    """
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id")
            same = pc.equal(ids.slice(1), ids.slice(0, batch.num_rows - 1))
            both_null = pc.and_(ids.slice(1).is_null(), ids.slice(0, batch.num_rows - 1).is_null())
            goes_on = pc.or_kleene(pc.fill_null(same, False), both_null).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
            data, at, text_start, text_end = assembled(batch.column("role"), batch.column("text"))
            learnt = pc.fill_null(pc.equal(batch.column("role"), LEARNT_ROLE), False).to_numpy(zero_copy_only=False)
            edges = np.append(first, batch.num_rows)
            begin = at[edges]
            conv_of = np.repeat(np.arange(len(first)), np.diff(edges))
            counts = np.concatenate([[0], np.cumsum(np.bincount(conv_of[learnt], minlength=len(first)))])
            base = begin[conv_of]
            lists = [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array((x - base)[learnt]))
                     for x in (text_start, text_end)]
            convs = ids.take(pa.array(first))
            part = part + 1 if convs[0].as_py() == last else 0
            parts = np.zeros(len(first), dtype=np.int32)
            parts[0] = part
            last, part = convs[-1].as_py(), part if len(first) == 1 else 0
            yield pa.RecordBatch.from_arrays(
                [convs, pa.array(parts), text_array(data, begin).cast(pa.string()), *lists],
                names=["conv_id", "part", "formatted", "loss_start", "loss_end"])

    dealt = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(work, FORMATTED)


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    for piece in formatted.split(f"{END}\n")[:-1]:
        role, _, text = piece.removeprefix(START).partition("\n")
        yield unescaped_role(role), unescaped(text)


def conversation_digests(parts: DataFrame) -> DataFrame:
    """Per conversation, read from its formatted parts alone: turns, text under the loss mask, sizes."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None

        def closed() -> dict:
            return {"conv_id": current, "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2],
                    "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != current or row["part"] == 0:
                    if state is not None:
                        done.append(closed())
                    current, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(row["formatted"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                whole = row["formatted"].encode()
                for start, end in zip(row["loss_start"], row["loss_end"], strict=True):
                    learnt = unescaped(whole[start:end].decode())
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(row["formatted"])
            yield pa.RecordBatch.from_pylist(done, schema=_DIGEST)
        if state is not None:
            yield pa.RecordBatch.from_pylist([closed()], schema=_DIGEST)

    return parts.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                  "formatted_chars long")


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

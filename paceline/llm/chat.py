"""Chat formatting at token level: segments are encoded one by one and reserved ids spliced between them.

A turn becomes START role newline text END newline. START and END are ids that no encoded text can give. Control
strings inside roles and texts are escaped besides, reversibly: a backslash goes between `<` and `|`, after any that
are there. The loss mask is a prefix sum over +1 at the start and -1 at the end of what assistants say.

Edge cases: null texts and roles are empty; rows are ordered by turn, then role, then text, nulls first, so ties and
repeated rows have one order; a null conversation id is a conversation of its own; newlines in roles are escaped; an
empty table gives no rows. A conversation comes out in parts of at most `part` tokens, in order, within one partition,
so that none has to fit in memory. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
START, END = "<|im_start|>", "<|im_end|>"
#: The splitting pattern of this public vocabulary (a fixed value of its format).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_PIECE = 1 << 14
#: A blank after anything else always begins a new piece of the splitting pattern.
_BREAK = re.compile(r"(?<=\S)[ \n]")


@lru_cache(2)
def encoding(path: str):
    """The tokenizer, and the reserved ids of START and END just above its vocabulary."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    top = max(ranks.values()) + 1
    return tiktoken.Encoding(os.path.basename(path), pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}), top, top + 1


def escape(s: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", s)


def unescape(s: str) -> str:
    return _UNESCAPE.sub(r"<\1|", s)


def escape_role(s: str) -> str:
    return escape(s).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(s: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s))


def encode(text: str, enc) -> list[int]:
    """The tokenizer's own ids of the whole text, which is handed to it in parts that end where its pieces do."""
    out, at = [], 0
    while len(text) - at > 2 * _PIECE:
        m = _BREAK.search(text, at + _PIECE)
        if not m:
            break
        out += enc.encode_ordinary(text[at : m.start()])
        at = m.start()
    return out + enc.encode_ordinary(text[at:] if at else text)


@lru_cache(4096)
def _head(role: str, path: str) -> tuple[int, ...]:
    enc, start, _ = encoding(path)
    return (start, *encode(escape_role(role), enc), *enc.encode_ordinary("\n"))


@lru_cache(2)
def _tail(path: str) -> tuple[int, ...]:
    enc, _, end = encoding(path)
    return (end, *enc.encode_ordinary("\n"))


def encode_turn(role: str, text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one turn."""
    head, tail = _head(role, path), _tail(path)
    said = encode(escape(text), encoding(path)[0])
    ids = np.array([*head, *said, *tail], np.int32)
    step = np.zeros(len(ids) + 1, np.int8)
    if role == "assistant":
        step[len(head)] += 1
        step[len(head) + len(said)] -= 1
    return ids, np.cumsum(step[:-1], dtype=np.int8)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists behind each other, and where each begins and ends."""
    return column.values.to_numpy(), column.offsets.to_numpy()


def format_chats(turns: DataFrame, tokenizer: str = TOKENIZER, part: int = 1 << 16) -> DataFrame:
    """conv_id, part, input_ids, loss_mask: the tokens of every conversation, its parts in order in one partition."""
    arrow = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("input_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        conv, n, held, size = None, 0, [], 0
        begun = False

        def flush(conv, n: int) -> None:
            nonlocal size
            ids, mask = (np.concatenate(x) for x in zip(*held, strict=True))
            rows.append((conv, n, ids, mask))
            held.clear()
            size = 0

        def batch() -> pa.RecordBatch:
            edges = pa.array(np.cumsum([0, *(len(r[2]) for r in rows)]), pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate([r[k] for r in rows]), arrow[k].type.value_type)) for k in (2, 3)]
            out = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), *lists], schema=arrow)
            rows.clear()
            return out

        for b in batches:
            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if begun and c != conv and held:
                    flush(conv, n)
                if not begun or c != conv:
                    conv, n, begun = c, 0, True
                ids, mask = encode_turn(role or "", text or "", tokenizer)
                for at in range(0, len(ids), part):
                    some = len(ids[at : at + part])
                    if held and size + some > part:
                        flush(conv, n)
                        n += 1
                    held.append((ids[at : at + part], mask[at : at + part]))
                    size += some
                if len(rows) >= 64:
                    yield batch()
        if held:
            flush(conv, n)
        if rows:
            yield batch()

    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").alias("text"), F.col("turn").alias("turn"))
    dealt = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, part int, input_ids array<int>, loss_mask array<tinyint>")


def digests(parts: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What a reader of the parts gets back: turns, text under the mask, and the length of the formatted text."""
    arrow = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, start, end = encoding(tokenizer)
        rows: list[tuple] = []
        conv, state, begun = None, None, False

        def fresh() -> dict:
            return {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "all": 0, "ids": [], "mask": []}

        def close(s: dict) -> tuple:
            s["all"] += len(text_of(s["ids"]).decode())
            return conv, s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["all"]

        def text_of(parts: list[np.ndarray]) -> bytes:
            return enc.decode_bytes(np.concatenate(parts).tolist()) if sum(map(len, parts)) else b""

        def turn(s: dict) -> None:
            """From one START's next id to its END."""
            whole = text_of(s["ids"])
            head, _, text = whole.partition(b"\n")
            s["n"] += 1
            plain = unescape(text.decode())
            s["turns"].update(f"{unescape_role(head.decode())}\n{plain}\n".encode())
            s["all"] += len(START) + len(whole.decode()) + len(END)
            under = np.concatenate(s["mask"]) if s["mask"] else np.zeros(0, np.int8)
            if under.any():
                said = unescape(enc.decode_bytes(np.concatenate(s["ids"])[under > 0].tolist()).decode())
                s["chars"] += len(said)
                s["loss"].update(said.encode())

        for b in batches:
            (ids, edges), (mask, _) = _lists(b.column(2)), _lists(b.column(3))
            marks = np.flatnonzero((ids == start) | (ids == end))
            bounds = np.searchsorted(marks, edges)
            for row, c in enumerate(b.column(0).to_pylist()):
                if begun and c != conv:
                    rows.append(close(state))
                if not begun or c != conv:
                    conv, state, begun = c, fresh(), True
                at = edges[row]
                for i in marks[bounds[row] : bounds[row + 1]].tolist():
                    state["ids"].append(ids[at:i])
                    state["mask"].append(mask[at:i])
                    if ids[i] == end:
                        turn(state)
                    else:
                        state["all"] += len(text_of(state["ids"]).decode())
                    state["ids"], state["mask"], at = [], [], i + 1
                state["ids"].append(ids[at : edges[row + 1]])
                state["mask"].append(mask[at : edges[row + 1]])
            if len(rows) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)
                rows.clear()
        if begun:
            rows.append(close(state))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op10_chat_tokens(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digests(format_chats(turns.unionByName(probe)))

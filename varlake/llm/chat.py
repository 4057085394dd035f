"""Chat formatting: conversations as training texts with a loss mask, assembled as columns of bytes.

Template: <|im_start|>ROLE \\n TEXT <|im_end|> \\n for each turn. Control strings inside texts and roles get a backslash after
their first character (and one more where there are some already), so a text never holds a control string, and
taking one backslash away gives the text back. The mask covers the assistant's texts.

A batch is put together by lengths of segments, their cumulative offsets, and one scatter of headers and contents into
one buffer. A conversation is cut into parts of bounded size, so that none has to fit in one value.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from varlake.llm.arrays import ranges, slices, strings, text_bytes

OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
#: Control strings: <| of any token, <s> and </s>, [INST] and [/INST].
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_ESCAPED = re.compile(r"([<\[])\\(\\*)(\||/?s>|/?INST\])")
#: Bytes of a part beyond which the next turn begins another.
PART_BYTES = 4 << 20
ASSISTANT = "assistant"


def escape(column: pa.Array) -> pa.Array:
    """Texts whose control strings are broken up. Only texts that hold one are touched."""
    column = column.fill_null("")
    hit = pc.match_substring_regex(column, _CONTROL)
    if not pc.any(hit).as_py():
        return column
    return pc.if_else(hit, pc.replace_substring_regex(column, _CONTROL, r"\1\\\2\3"), column)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _role(column: pa.Array) -> pa.Array:
    """A role on one line: backslashes and line ends are written \\\\ and \\n."""
    column = column.fill_null("")
    return escape(pc.replace_substring(pc.replace_substring(column, "\\", "\\\\"), "\n", "\\n"))


def _read_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns one after another, the n + 1 offsets of turns, and where each turn's content begins and ends."""
    fixed = np.frombuffer((OPEN + BREAK + CLOSE).encode(), np.uint8)
    a, b, c = len(OPEN), len(OPEN) + len(BREAK), len(fixed)
    (role, role_at), (text, text_at) = text_bytes(_role(roles)), text_bytes(escape(texts))
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    size = role_size + text_size + c
    offsets = np.append(0, np.cumsum(size))
    out = np.empty(offsets[-1], np.uint8)
    begin = offsets[:-1]
    head = begin + a + role_size
    content = head + len(BREAK)
    for start, piece in ((begin, fixed[:a]), (head, fixed[a:b]), (content + text_size, fixed[b:])):
        out[start[:, None] + np.arange(len(piece))] = piece
    out[ranges(begin + a, role_size)] = role
    out[ranges(content, text_size)] = text
    return out, offsets, content, content + text_size


def _lengths(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte place."""
    return np.append(0, np.cumsum((data & 0xC0) != 0x80))[at]


FORMATTED = "conv_id long, part int, n_turns int, formatted string, loss array<struct<start: int, end: int>>"


def format_conversations(conversations: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """conversations (conv_id long, turn long, role, text) as rows conv_id, part (from 0), n_turns, formatted and loss (spans
    of formatted in code points that training counts). A conversation of more than part_bytes has several parts.

    Turns are ordered by turn, then role, then text; nulls first, repeated rows are turns of their own. A null text or role is empty; a
    null conv_id is a conversation by itself. Rows come sorted by conv_id and part within each partition."""
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(*order).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the open part: conv_id, part, pieces, sizes
        done: list[tuple] = []

        def close() -> None:
            if held is not None:
                done.append((held[0], held[1], held[2], b"".join(held[3]), held[4]))

        def flush() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(d[3] for d in done), np.uint8)
            at = np.append(0, np.cumsum([len(d[3]) for d in done]))
            batch = pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int32()), pa.array([d[2] for d in done], pa.int32()), strings(data, at), pa.array([[{"start": s, "end": e} for s, e in d[4]] for d in done], span)], names=["conv_id", "part", "n_turns", "formatted", "loss"])
            done.clear()
            return batch

        for batch in slices(batches, "text"):
            data, offsets, content, end = assemble(batch.column("role"), batch.column("text"))
            ids = batch.column("conv_id")
            known, value = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            counted = pc.equal(batch.column("role").fill_null(""), ASSISTANT).to_numpy(zero_copy_only=False)
            new = np.append(True, (value[1:] != value[:-1]) | (known[1:] != known[:-1]))
            # a part ends with its conversation, or with the turn that fills it up
            cuts = []
            for lo, hi in zip(np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(new))):
                while lo < hi:
                    more = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + part_bytes, side="right")) - 1)
                    cuts.append((lo, min(more, hi)))
                    lo = min(more, hi)
            chars = _lengths(data, np.concatenate([offsets[:-1], content, end]))
            chars = chars[: len(new)], chars[len(new) : 2 * len(new)], chars[2 * len(new) :]
            total = _lengths(data, offsets)
            raw = data.tobytes()
            for lo, hi in cuts:
                own = value[lo] if known[lo] else None
                size = int(offsets[hi] - offsets[lo])
                if held is None or held[0] != own or held[5] + size > part_bytes:
                    part = held[1] + 1 if held is not None and held[0] == own else 0
                    close()
                    held = (own, part, 0, [], [], 0, 0)
                shift = held[6] - int(total[lo])
                spans = [(int(chars[1][i]) + shift, int(chars[2][i]) + shift) for i in range(lo, hi) if counted[i]]
                held = (own, held[1], held[2] + hi - lo, [*held[3], raw[offsets[lo] : offsets[hi]]], held[4] + spans, held[5] + size, held[6] + int(total[hi] - total[lo]))
            if done:
                yield flush()
        close()
        if done:
            yield flush()

    return rows.mapInArrow(formatted, FORMATTED)


_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)" + re.escape(BREAK) + r"(.*?)" + re.escape(CLOSE), re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    return [(_read_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def digests(formatted: DataFrame) -> DataFrame:
    """What format_conversations wrote, read back from it: conv_id, n_turns, turns_sha256 (role, \\n, text, \\n of each turn),
    loss_chars, loss_sha256 (all text under the mask), formatted_chars. Parts must stand as they came."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if own is None or r["part"] == 0:
                    if own is not None:
                        rows.append(own)
                    own = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(r["formatted"]):
                    own[1] += 1
                    own[2].update(f"{role}\n{text}\n".encode())
                for span in r["loss"]:
                    text = unescape(r["formatted"][span["start"] : span["end"]])
                    own[3] += len(text)
                    own[4].update(text.encode())
                own[5] += len(r["formatted"])
            if rows:
                yield _digest_rows(rows)
                rows = []
        if own is not None:
            yield _digest_rows([own])

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digest_rows(rows: list[list]) -> pa.RecordBatch:
    columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2].hexdigest() for r in rows], [r[3] for r in rows], [r[4].hexdigest() for r in rows], [r[5] for r in rows]]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

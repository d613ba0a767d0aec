"""Operator 6, chat formatting of typed content parts."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, TURN, END = "<s>", "<|turn|>", "</s>"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
FORMATTED = "formatted string, loss_spans array<struct<start:long,end:long>>, attachments array<struct<no:int,kind:string,ref:string,turn_no:int,position:long,tokens:long>>, n_turns long, attachment_tokens long"
#: The control strings <s> </s> <| |> [INST] [/INST], with any number of backslashes after the first character.
_CONTROLS = (re.compile(r"<(\\*)(/?s>|\|)"), re.compile(r"\|(\\*)(>)"), re.compile(r"\[(\\*)(/?INST\])"))
_ESCAPED = (re.compile(r"<\\(\\*)(/?s>|\|)"), re.compile(r"\|\\(\\*)(>)"), re.compile(r"\[\\(\\*)(/?INST\])"))
_FIRST = "<|["
_PLACE = re.compile(r"<\|(image|audio|document|file):(\d+)\|>")


def escape(text: str) -> str:
    """Breaks control strings by one more backslash after their first character; ``unescape`` takes it out again."""
    for first, control in zip(_FIRST, _CONTROLS, strict=True):
        text = control.sub(rf"{first}\\\1\2", text)
    return text


def unescape(text: str) -> str:
    for first, control in reversed(list(zip(_FIRST, _ESCAPED, strict=True))):
        text = control.sub(rf"{first}\1\2", text)
    return text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Flattener:
    """Visits the typed parts of a conversation in order and writes one string.

    Neighbouring texts are escaped as one, so that no control string arises where they meet; an image, audio or document part becomes a placeholder numbered through the conversation, with
    its reference, its place and the tokens that it expands to: a token for each square of ``patch`` pixels, for each
    1 / ``audio_rate`` seconds, and ``page_tokens`` for each page. Parts of other kinds become files of 0 tokens.
    """

    patch: int = 14
    audio_rate: float = 25.0
    page_tokens: int = 576
    out: list[str] = field(default_factory=lambda: [BEGIN])
    length: int = len(BEGIN)
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    turns: int = 0
    #: Texts since the last part of another kind.
    texts: list[str] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def turn(self, role: str | None, content: list[dict | None] | None) -> None:
        role = role or ""
        self.write(TURN + escape_role(role) + "\n")
        for part in content or []:
            if part is not None:
                kind = part["kind"] or "text"
                if kind != "text":
                    self.flush(role)
                getattr(self, f"visit_{kind}", self.visit_file)(part)
        self.flush(role)
        self.write(END)
        self.turns += 1

    def flush(self, role: str) -> None:
        start = self.length
        self.write(escape("".join(self.texts)))
        self.texts.clear()
        if role == "assistant" and self.length > start:
            self.spans.append((start, self.length))

    def visit_text(self, part: dict) -> None:
        self.texts.append(part["text"] or "")

    def attach(self, kind: str, part: dict, tokens: float) -> None:
        self.attachments.append({"no": len(self.attachments) + 1, "kind": kind, "ref": part["ref"], "turn_no": self.turns, "position": self.length, "tokens": int(tokens)})
        self.write(f"<|{kind}:{len(self.attachments)}|>")

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, math.ceil((part["width"] or 0) / self.patch) * math.ceil((part["height"] or 0) / self.patch))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil((part["seconds"] or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, (part["pages"] or 0) * self.page_tokens)

    def visit_file(self, part: dict) -> None:
        self.attach("file", part, 0)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation; placeholders are left out of the texts."""
    turns = []
    for body in formatted[len(BEGIN) :].split(END)[:-1]:
        role, text = body[len(TURN) :].split("\n", 1)
        turns.append((unescape_role(role), "".join(unescape(t) for t in _PLACE.split(text)[::3])))
    return turns


def digest_of(formatted: str, spans: list[tuple[int, int]]) -> tuple[int, str, int, str, int]:
    """What the contract reads back: turns, their hash, characters and hash under the loss mask, and characters."""
    turns = read_back(formatted)
    said = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest()
    loss = "".join(unescape(formatted[a:b]) for a, b in spans)
    return len(turns), said, len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(formatted)


def text_parts(conversations: DataFrame) -> DataFrame:
    """Rows of plain text as rows of one text part: conv_id, turn, role, content."""
    none = "CAST(NULL AS STRING) AS ref, CAST(NULL AS INT) AS width, CAST(NULL AS INT) AS height, CAST(NULL AS DOUBLE) AS seconds, CAST(NULL AS INT) AS pages"
    part = F.array(F.expr(f"struct('text' AS kind, coalesce(text, '') AS text, {none})"))
    return conversations.select("conv_id", "turn", "role", part.cast(f"array<{PART}>").alias("content"))


def format_conversations(turns: DataFrame, **sizes) -> DataFrame:
    """One row for each conv_id of turns (conv_id, turn, role, content array of parts): formatted, loss_spans (code
    points; the assistant's texts, each once, in order, neighbouring ones as one span), attachments, n_turns and attachment_tokens.

    Turns are ordered by turn, those of one number by role and content, nulls first. Null roles and texts count as
    empty, null parts are left out, turns without parts are empty; repeated rows are turns of their own. A null
    conv_id is a conversation like others. A conversation is one output row and so is made in one task; nothing else is
    brought together. Only these four columns are read.
    """
    fields = ", ".join(f"'{c}', {c}" for c in ("turn", "role", "content"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.expr(f"named_struct({fields})"))).alias("turns"))
    kind = turns.schema["conv_id"].dataType.simpleString()

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        attached = pa.list_(pa.struct([("no", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("turn_no", pa.int32()), ("position", pa.int64()), ("tokens", pa.int64())]))
        for batch in batches:
            made = []
            for rows in batch.column(1):
                f = Flattener(**sizes)
                for row in rows.as_py():
                    f.turn(row["role"], row["content"])
                made.append(f)
            columns = [
                pa.array(["".join(f.out) for f in made], pa.string()), pa.array([[{"start": a, "end": b} for a, b in f.spans] for f in made], span),
                pa.array([f.attachments for f in made], attached), pa.array([f.turns for f in made], pa.int64()), pa.array([sum(a["tokens"] for a in f.attachments) for f in made], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["conv_id", "formatted", "loss_spans", "attachments", "n_turns", "attachment_tokens"])

    return grouped.mapInArrow(formatted, f"conv_id {kind}, {FORMATTED}")


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from ``formatted`` and ``loss_spans``."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [digest_of(t, [(s["start"], s["end"]) for s in spans]) for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(regexp_replace(regexp_replace(text, '<(\\*)(/?s>|\|)', '<\\\1\2', 'g'), '\|(\\*)>', '|\\\1>', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g')) AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(8 + length(role) + 1 + n + 4))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

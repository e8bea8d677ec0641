"""Chat formatting: turns of typed content parts become marked text with a loss mask.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Texts and roles may hold anything: every ``<|`` in them gets a
second bar, so that a marker (``<`` and exactly one bar) never stands inside a text, and reading takes the bar away. A
visitor flattens the parts of a turn in order: text is escaped; an image, audio or document leaves a placeholder and an
attachment (kind, reference, place in the turn, tokens it expands to). Document parts may hold parts of their own.

One output row is one turn, so that a conversation of any length is spread over tasks; (conv_id, turn, part of the order)
says where it belongs, and the text of a conversation is its rows' texts in that order. The loss mask is a span per row.

Defined cases: a null text is an empty one; a null role is an empty role, outside the loss; a null conversation id is a
conversation of its own; turns with equal numbers are ordered by role and text, a null turn first; repeated rows are
repeated turns; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import lean

#: The markers of the template.
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}


def escape(text: str) -> str:
    return text.replace("<|", "<||")


def unescape(text: str) -> str:
    return text.replace("<||", "<|")


class PartVisitor:
    """Walks over the parts of one turn; ``pieces`` and ``attachments`` are the flat result."""

    def __init__(self, patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 256) -> None:
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens
        self.pieces: list[str] = []
        self.attachments: list[tuple[str, str, int, int]] = []
        self.place = 0

    def visit(self, parts: list) -> None:
        for part in parts:
            if isinstance(part, str):
                part = {"type": "text", "text": part}
            method = getattr(self, f"visit_{part.get('type', 'text')}", None)
            if method is None:
                raise ValueError(f"unknown part type {part.get('type')!r}")
            method(part)

    def _write(self, text: str) -> None:
        self.pieces.append(text)
        self.place += len(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append((kind, str(part.get("ref") or ""), self.place, tokens))
        self._write(PLACEHOLDERS[kind])

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(max(0, part.get(k) or 0) / self.patch) for k in ("width", "height"))
        self._attach("image", part, max(1, across * down))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.audio_rate)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, (part.get("pages") or 0) * self.page_tokens))
        self.visit(part.get("parts") or [])


def format_turn(role: str, text: str | None, parts: str | None, loss_roles: tuple[str, ...]) -> tuple:
    """(formatted text, loss start, loss end, attachments); places count signs within the turn, -1 for no loss."""
    visitor = PartVisitor()
    if parts is None:
        visitor.visit_text({"text": text})
    else:
        visitor.visit(json.loads(parts))
    head = f"{START}{escape(role).replace(chr(10), NEWLINE)}\n"
    body = "".join(visitor.pieces)
    loss = (len(head), len(head) + len(body)) if role in loss_roles else (-1, -1)
    return head + body + END + "\n", *loss, [(k, r, len(head) + at, n) for k, r, at, n in visitor.attachments]


def format_chat(turns: DataFrame, parts_col: str | None = None, loss_roles: tuple[str, ...] = ("assistant",),
                conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end, attachments, attachment_tokens) per turn. ``parts_col`` holds a
    JSON list of parts, or null where the text column is the content."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [format_turn(r, t, None if pd.isna(p) else p, loss_roles) for r, t, p in zip(batch["role"], batch["text"], batch["parts"])]
            yield pd.DataFrame({
                "conv_id": batch["conv_id"], "turn": batch["turn"], "formatted": [m[0] for m in made],
                "loss_start": [m[1] for m in made], "loss_end": [m[2] for m in made],
                "attachments": [[dict(zip(("kind", "ref", "at", "tokens"), a)) for a in m[3]] for m in made],
                "attachment_tokens": [sum(a[3] for a in m[3]) for m in made]})

    def text(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"),
                        text(text_col).alias("text"), (F.col(parts_col) if parts_col else F.lit(None)).cast("string").alias("parts"))
    # nullable integers would turn into floats on the way through pandas
    kept = rows.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"), "role", "text", "parts")
    made = kept.mapInPandas(lean(run), "conv_id string, turn string, formatted string, loss_start int, loss_end int, attachments "
                                 "array<struct<kind: string, ref: string, at: int, tokens: int>>, attachment_tokens long")
    return made.withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, content) of one formatted turn; raises if it isn't one."""
    if not formatted.startswith(START) or not formatted.endswith(END + "\n"):
        raise ValueError("not a formatted turn")
    role, _, body = formatted[len(START):-len(END) - 1].partition("\n")
    if END in body or START in body:
        raise ValueError("a marker inside a turn")
    return unescape(role.replace(NEWLINE, "\n")), body


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted turns back: per conversation, digests of its turns and of the text under the loss mask.

    Rows are sorted by conversation within partitions and streamed: one conversation's state is two hash sums."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, out = None, []

        def close() -> None:
            if state:
                out.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        for batch in batches:
            for conv, text, start, end in zip(batch["conv_id"], batch["formatted"], batch["loss_start"].tolist(), batch["loss_end"].tolist()):
                if state is None or conv != state[0]:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = parse_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                if start >= 0:
                    under = unescape(text[start:end])
                    state[3] += len(under)
                    state[4].update(under.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield pd.DataFrame(out, columns=COLUMNS)
            out = []
        close()
        yield pd.DataFrame(out, columns=COLUMNS)

    COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = formatted.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_id"), "turn", "formatted", "loss_start", "loss_end")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    read = ordered.mapInPandas(lean(run), "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return read.withColumn("conv_id", F.when(F.col("conv_id") != "", F.col("conv_id")).cast("long"))

"""Chat formatting at token level.

Each turn is encoded on its own: role and text are separate segments, and reserved ids, which no text can produce, are spliced
between them. The loss mask comes from prefix sums over those ids. Control strings that occur in a role or text are escaped, so
the plain rendering of the ids can be read back as well.

Rendering of a turn: ``### role: text</turn>`` and a newline. In contents a backslash is put before every backslash, ``### ``
and ``</turn>`` (and before ``: `` in a role); removing one backslash before any character restores them.

Defined results: null role or text is empty; rows of one conversation are ordered by turn (null first), ties by the bytes of
their ids, and repeated rows stay; a null conv_id is a conversation of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches
from .tokens import Encoder

#: Reserved ids above the vocabulary and their rendering. SAY ends the role of a turn without loss, REPLY of one with loss.
TURN, SAY, REPLY, END = 50257, 50258, 50259, 50260
RENDERED = {TURN: "### ", SAY: ": ", REPLY: ": ", END: "</turn>\n"}
LOSS_ROLE = "assistant"

_CONTROL = re.compile(r"\\|### |</turn>")
_ROLE_CONTROL = re.compile(r"\\|### |</turn>|: ")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    return (_ROLE_CONTROL if role else _CONTROL).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def spliced(roles: Sequence[str], texts: Sequence[str], encoder: Encoder) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids and loss mask of every turn of a batch."""
    flat, ends = encoder.encode([escape(r, role=True) for r in roles] + [escape(t) for t in texts])
    cut = np.concatenate([[0], ends])
    n = len(roles)
    one = lambda x: np.array([x], "<u4")
    ids = [np.concatenate([one(TURN), flat[cut[k]:cut[k + 1]], one(REPLY if roles[k] == LOSS_ROLE else SAY), flat[cut[n + k]:cut[n + k + 1]], one(END)]) for k in range(n)]
    whole = np.concatenate(ids) if n else np.zeros(0, "<u4")
    # prefix sums: a reply opens the mask after its marker, the end of that turn closes it
    opened = np.cumsum(whole == REPLY)
    turn = np.cumsum(whole == TURN) - 1
    replies = np.bincount(turn[whole == REPLY], minlength=n) > 0 if n else np.zeros(0, bool)
    closed = np.cumsum((whole == END) & replies[turn]) if n else opened
    mask = (opened - closed - (whole == REPLY)).astype(np.uint8)
    return ids, np.split(mask, np.cumsum([len(x) for x in ids])[:-1]) if n else []


def format_turns(turns: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """conv_id, turn, ids (little-endian unsigned 32-bit) and loss (one byte an id) of every row; no shuffle."""
    arrow_batches(turns.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks, pattern)
        for b in batches:
            ids, loss = spliced(list(b.role), list(b.text), encoder)
            yield pd.DataFrame({"conv_id": b.conv_id.astype("Int64").array, "turn": b.turn.astype("Int64").array, "ids": [x.tobytes() for x in ids], "loss": [x.tobytes() for x in loss]})

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    return rows.mapInPandas(run, "conv_id long, turn long, ids binary, loss binary")


def assemble(formatted: DataFrame) -> DataFrame:
    """The formatted turns with ``position`` and ``first_id`` (ids of the conversation before them), a conversation's rows together
    and in order. Rows are streamed, so a conversation may be larger than memory."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, position, offset = None, 0, 0
        for b in batches:
            places, offsets = [], []
            for c, ids in zip(b.conv_id, b.ids):
                key = (pd.isna(c), None if pd.isna(c) else int(c))
                if key != last:
                    last, position, offset = key, 0, 0
                places.append(position)
                offsets.append(offset)
                position, offset = position + 1, offset + len(ids) // 4
            yield b.assign(conv_id=b.conv_id.astype("Int64").array, turn=b.turn.astype("Int64").array, position=places, first_id=offsets)

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return rows.mapInPandas(run, "conv_id long, turn long, ids binary, loss binary, position long, first_id long")


class Reading:
    """What is read back from the ids of one conversation, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray, table: list[bytes]) -> None:
        text = lambda x: b"".join([table[i] for i in x.tolist()]).decode("utf-8")
        middle = int(np.flatnonzero((ids == SAY) | (ids == REPLY))[0])
        role, said = text(ids[1:middle]), text(ids[middle + 1:-1])
        self.turns += 1
        self.all.update(f"{unescape(role)}\n{unescape(said)}\n".encode())
        self.chars += len(role) + len(said) + sum(len(RENDERED[int(ids[k])]) for k in (0, middle, -1))
        under = unescape(text(ids[mask > 0]))
        self.loss.update(under.encode())
        self.loss_chars += len(under)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(assembled: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Digests of every conversation, decoded from the ids and masks of ``assemble``'s rows as they come."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Encoder(ranks, pattern).bytes_of
        now = None

        def rows(found: list[Reading]) -> pd.DataFrame:
            out = pd.DataFrame([r.row() for r in found], columns=names)
            return out.assign(conv_id=pd.array(out.conv_id, "Int64"))

        for b in batches:
            ended = []
            for c, position, ids, loss in zip(b.conv_id, b.position, b.ids, b.loss):
                if position == 0:
                    if now:
                        ended.append(now)
                    now = Reading(None if pd.isna(c) else int(c))
                now.add(np.frombuffer(ids, "<u4"), np.frombuffer(loss, np.uint8), table)
            yield rows(ended)
        if now:
            yield rows([now])

    return assembled.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

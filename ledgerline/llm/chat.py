"""Chat formatting on token level.

Each segment of a turn (role, content) is encoded by itself, so no token spans a boundary, and reserved ids are spliced
between segments. Ordinary text never encodes to a reserved id. Because a rendered conversation is text again, control
strings inside texts are escaped by a backslash, and backslashes by another, which reading back undoes. The loss mask is
the running sum of +1 where an assistant's content starts and -1 where it ends.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

#: How the vocabulary below cuts text before merging (a fixed value of that vocabulary).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@dataclass(frozen=True)
class Template:
    """Reserved strings; their ids follow the vocabulary in this order.

    A turn is OPEN, the marker of its role, content, CLOSE. A role without a marker is spelled out as text between
    ROLE and ROLE_END.
    """

    open: str = "<turn>"
    close: str = "</turn>"
    role: str = "### Role:"
    role_end: str = ":###"
    markers: tuple[tuple[str, str], ...] = (
        ("system", "### System:"), ("user", "### User:"), ("assistant", "### Assistant:"), ("tool", "### Tool:"),
    )
    learn: tuple[str, ...] = ("assistant",)

    @property
    def reserved(self) -> list[str]:
        return [self.open, self.close, self.role, self.role_end, *[m for _, m in self.markers]]


def escape_pattern(template: Template) -> re.Pattern:
    """A backslash, or the place before a control string."""
    return re.compile(r"\\|(?=" + "|".join(map(re.escape, template.reserved)) + ")")


def escape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def load_ranks(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Encodes turns to ids and masks, and reads them back."""

    def __init__(self, ranks: bytes, template: Template):
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.plain = tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=merges, special_tokens={})
        first = self.first = max(merges.values()) + 1
        self.strings = {first + k: s for k, s in enumerate(template.reserved)}
        self.ids = {s: i for i, s in self.strings.items()}
        self.template, self.pattern = template, escape_pattern(template)
        self.marker = dict(template.markers)
        self.role_of = {self.ids[m]: r for r, m in template.markers}
        self.controls = ["\\", *template.reserved]

    def escaped(self, text: str) -> str:
        return escape(text, self.pattern) if any(c in text for c in self.controls) else text

    def encode(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        t, spell = self.template, self.plain.encode_ordinary
        if role in self.marker:
            head = [self.ids[t.open], self.ids[self.marker[role]]]
        else:
            head = [self.ids[t.open], self.ids[t.role], *spell(self.escaped(role)), self.ids[t.role_end]]
        content = spell(self.escaped(text))
        ids = np.array([*head, *content, self.ids[t.close]], dtype=np.int32)
        steps = np.zeros(len(ids) + 1, dtype=np.int8)
        if role in t.learn:
            steps[len(head)] += 1
            steps[len(head) + len(content)] -= 1
        return ids, np.cumsum(steps[:-1], dtype=np.int8)

    def text(self, ids: list[int]) -> str:
        """The rendered text: reserved ids as their strings."""
        return "".join(
            "".join(self.strings[i] for i in run) if special else self.plain.decode_bytes(list(run)).decode("utf-8", "replace")
            for special, run in groupby(ids, lambda i: i in self.strings)
        )

    def decode(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
        """Role, text, text under the mask, and rendered code points of one turn."""
        rendered = lambda part: self.plain.decode_bytes(part.tolist()).decode("utf-8", "replace")
        if int(ids[1]) in self.role_of:
            role, start, head = self.role_of[int(ids[1])], 2, ""
        else:
            start = int(np.flatnonzero(ids == self.ids[self.template.role_end])[0]) + 1
            head = rendered(ids[2 : start - 1])
            role = unescape(head)
        content = ids[start:-1]
        said = rendered(content)
        text = unescape(said)
        learned = ids[mask > 0]
        learned = learned[learned < self.first]
        under = text if np.array_equal(learned, content) else unescape(rendered(learned)) if len(learned) else ""
        marks = sum(len(self.strings[i]) for i in ids[ids >= self.first].tolist())
        return role, text, under, len(said) + len(head) + marks


_TURN = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("ids", pa.list_(pa.int32())),
    ("loss_mask", pa.list_(pa.int8())),
])
_PLACED = _TURN.append(pa.field("position", pa.int64())).append(pa.field("token_start", pa.int64()))
_TURN_SQL = "conv_id long, turn long, role string, ids array<int>, loss_mask array<tinyint>"


def format_conversations(
    df: DataFrame, template: Template = Template(), vocabulary: str = VOCABULARY, conv_id: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per input row: ``conv_id``, ``turn``, ``role``, ``ids``, ``loss_mask``, ``position``, ``token_start``.

    ``position`` counts the turns of a conversation from 0, ``token_start`` the tokens before. Turns come in order of
    ``turn``, null first; ties by role, then by text, so repeated rows stand side by side. Null roles and texts are empty,
    rows of a null conversation form one. Encoding happens before the shuffle, row by row; after it a task holds one
    batch of turns, however long the conversation. The vocabulary (a few hundred kB) is broadcast. Other columns of the
    input are not read. An empty table gives an empty one. A very long turn is one row: its text, ids and mask are held by
    its task, some 40 bytes a character.
    """
    spark = df.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks.value, template)
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for a in range(0, batch.num_rows, 1000):
                pairs = [codec.encode(r or "", t or "") for r, t in zip(roles[a : a + 1000], texts[a : a + 1000], strict=True)]
                part = batch.slice(a, 1000)
                columns = [part.column(0), part.column(1), part.column(2)]
                for k, kind in ((0, pa.int32()), (1, pa.int8())):
                    ends = np.cumsum([0, *[len(p[k]) for p in pairs]], dtype=np.int32)
                    flat = pa.array(np.concatenate([p[k] for p in pairs]) if pairs else [], type=kind)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                columns.append(part.column(3))
                yield pa.RecordBatch.from_arrays(columns, schema=_TURN.append(pa.field("text", pa.string())))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position, tokens, begun = None, 0, 0, False
        for batch in batches:
            positions, starts = [], []
            for conv, count in zip(batch.column(0).to_pylist(), batch.column(3).value_lengths().to_pylist(), strict=True):
                if not begun or conv != current:
                    current, position, tokens, begun = conv, 0, 0, True
                positions.append(position)
                starts.append(tokens)
                position, tokens = position + 1, tokens + count
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(positions, pa.int64()), pa.array(starts, pa.int64())], schema=_PLACED
            )

    rows = df.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    encoded = rows.mapInArrow(encode, _TURN_SQL + ", text string")
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("text")
    return ordered.mapInArrow(place, _TURN_SQL + ", position long, token_start long")


def read_back(formatted: DataFrame, template: Template = Template(), vocabulary: str = VOCABULARY) -> DataFrame:
    """Digests of each conversation from its ids and masks alone: see the columns.

    ``formatted`` comes straight from ``format_conversations``, whose partitions hold conversations whole and in order.
    A digest is fed turn by turn; nothing of a conversation is kept but its state.
    """
    ranks = formatted.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    fields = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, state, done = Codec(ranks.value, template), None, []

        def closed(s):
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6])

        def flush(rows):
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=fields)

        for batch in batches:
            convs, positions = batch.column(0).to_pylist(), batch.column(5).to_pylist()
            tokens, learned = (batch.column(c).flatten().to_numpy() for c in (3, 4))
            ends = np.cumsum([0, *batch.column(3).value_lengths().to_pylist()])
            for k, conv in enumerate(convs):
                ids, mask = tokens[ends[k] : ends[k + 1]], learned[ends[k] : ends[k + 1]]
                if state is None or positions[k] == 0:
                    if state is not None:
                        done.append(closed(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text, under, chars = codec.decode(ids, mask)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[3] += len(under)
                state[4].update(under.encode("utf-8", "surrogatepass"))
                state[5] += chars
                state[6] += len(ids)
            if len(done) >= 1000:
                yield flush(done)
                done = []
        if state is not None:
            done.append(closed(state))
        if done:
            yield flush(done)

    return formatted.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    )


def with_probe(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """The table plus conversation -7, whose two texts hold control strings and a backslash."""
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)

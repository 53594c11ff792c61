"""Chat formatting at the level of tokens.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. The control marks are reserved ids beyond the vocabulary, and only
this module writes them: role and text are encoded by themselves, as ordinary text, and the reserved ids are spliced
between. Segment lengths and their prefix sums over a whole batch say where every segment lies, which gives the
loss mask (the text of assistant turns).

Control strings in contents can't be taken for marks even when the tokens are rendered as text: in contents a
backslash is put between ``<`` and ``|`` (one more where there are some), which is taken out again when read back. In a
role line ends and backslashes are escaped as well, since the first line end closes it.

Defined results: null role or text counts as empty. Turns of a conversation are ordered by turn, then role and text
(nulls first); repeated rows stay. A null conv_id is a conversation of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import keep_named, ready

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_OPEN = re.compile(r"<(\\*)\|")
_CLOSE = re.compile(r"<\\(\\*)\|")
TURNS = "conv_id long, turn long, ids array<int>, loss array<boolean>"


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


class Template:
    """Encoder and decoder of turns over one byte-level vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings of the file are ordinary text in contents
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.start, self.end = size, size + 1
        self.line = np.array(self._encode(["\n"])[0], np.int32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def assemble(self, roles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and loss mask of all turns, flat, and where each turn begins (one more than turns)."""
        n = len(roles)
        heads = [escape_role(r) + "\n" for r in roles]
        known = list(dict.fromkeys(heads))
        head_ids = dict(zip(known, self._encode(known)))
        text_ids = self._encode([escape(t) for t in texts])
        # five segments a turn: mark, head, text, mark, line end
        segments: list = []
        for h, t in zip(heads, text_ids):
            segments += [[self.start], head_ids[h], t, [self.end], self.line]
        size = np.fromiter(map(len, segments), np.int64, 5 * n)
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = np.fromiter((i for s in segments for i in s), np.int32, int(edge[-1]))
        step = np.zeros(int(edge[-1]) + 1, np.int32)
        spoken = np.flatnonzero(np.array([r == LOSS_ROLE for r in roles], bool)) * 5 + 2
        np.add.at(step, edge[spoken], 1)
        np.add.at(step, edge[spoken + 1], -1)
        return ids, np.cumsum(step[:-1]) > 0, edge[::5]

    def render(self, ids: np.ndarray) -> str:
        """The formatted text of ids, marks included."""
        out, at = [], 0
        marks = np.flatnonzero(ids >= self.start)
        for m in [*marks.tolist(), len(ids)]:
            if m > at:
                out.append(self.tokenizer.decode(ids[at:m].tolist(), skip_special_tokens=False))
            if m < len(ids):
                out.append(START if ids[m] == self.start else END)
            at = m + 1
        return "".join(out)

    def read(self, ids: np.ndarray, loss: np.ndarray) -> list[tuple[str, str, str | None, int]]:
        """(role, text, text under the mask, characters formatted) of each turn in ids."""
        out = []
        starts, ends = np.flatnonzero(ids == self.start), np.flatnonzero(ids == self.end)
        if len(starts) != len(ends) or (starts >= ends).any():
            raise ValueError("marks don't pair")
        for a, b, stop in zip(starts, ends, [*starts[1:], len(ids)]):
            head, _, body = self.tokenizer.decode(ids[a + 1:b].tolist(), skip_special_tokens=False).partition("\n")
            tail = self.tokenizer.decode(ids[b + 1:stop].tolist(), skip_special_tokens=False)
            masked = ids[a:stop][loss[a:stop]]
            # an empty text of the loss role has no token under the mask
            spoken = unescape(self.tokenizer.decode(masked.tolist(), skip_special_tokens=False)) if len(masked) else None
            out.append((unescape_role(head), unescape(body), spoken, len(START) + len(head) + 1 + len(body) + len(END) + len(tail)))
        return out


_LOADED: dict[str, Template] = {}


def load(path: str) -> Template:
    if path not in _LOADED:
        _LOADED[path] = Template(path)
    return _LOADED[path]


def format_turns(conversations: DataFrame, path: str) -> DataFrame:
    """Every turn as tokens: conv_id, turn, ids, loss (the mask). The ids
    of a conversation are those of its turns in order. Turns are formatted where they lie; nothing is shuffled, so a
    conversation of any length is formatted by many tasks."""
    ready(conversations.sparkSession)

    def run(batches):
        template = load(path)
        for pdf in batches:
            roles, texts = pdf["role"].fillna("").tolist(), pdf["text"].fillna("").tolist()
            ids, loss, edge = template.assemble(roles, texts)
            yield pd.DataFrame({
                "conv_id": pdf["conv_id"], "turn": pdf["turn"],
                "ids": [ids[a:b] for a, b in zip(edge[:-1], edge[1:])], "loss": [loss[a:b] for a, b in zip(edge[:-1], edge[1:])]})

    rows = keep_named(conversations, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"})
    return rows.mapInPandas(run, TURNS)


def read_turns(turns: DataFrame, path: str) -> DataFrame:
    """What the tokens say: conv_id, turn, role, text, spoken (text under the loss mask; null if none), formatted_chars."""
    ready(turns.sparkSession)

    def run(batches):
        template = load(path)
        for pdf in batches:
            rows = [(c, t, *x) for c, t, ids, loss in zip(pdf["conv_id"], pdf["turn"], pdf["ids"], pdf["loss"])
                    for x in template.read(np.asarray(ids, np.int64), np.asarray(loss, bool))]
            out = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text", "spoken", "formatted_chars"])
            out["conv_id"], out["turn"] = pd.array(out["conv_id"], "Int64"), pd.array(out["turn"], "Int64")
            yield out

    return turns.mapInPandas(run, "conv_id long, turn long, role string, text string, spoken string, formatted_chars long")


def conversation_digests(read: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation of ``read_turns``.

    A digest over a conversation takes its turns one after the other, so a conversation is hashed by one task; that task
    holds one batch of sorted rows and the state of two hashes, whatever the conversation's length. All else
    (encoding, assembly, decoding) is done before, row by row."""
    ready(read.sparkSession)

    def run(batches):
        now, have = None, False
        n = chars = spoken = 0
        turns = loss = None

        def row():
            return {"conv_id": now, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": spoken,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        def frame(rows):
            out = pd.DataFrame(rows)
            out["conv_id"] = pd.array(out["conv_id"], "Int64")
            return out

        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "spoken", "formatted_chars")]
            for conv, role, text, said, formatted in zip(*columns):
                if not have or conv != now:
                    if have:
                        rows.append(row())
                    now, have, n, chars, spoken = conv, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if said is not None:
                    loss.update(said.encode("utf-8", "surrogatepass"))
                    spoken += len(said)
                n, chars = n + 1, chars + formatted
            if rows:
                yield pa.RecordBatch.from_pandas(frame(rows), schema, preserve_index=False)
        if have:
            yield pa.RecordBatch.from_pandas(frame([row()]), schema, preserve_index=False)

    import pyarrow as pa
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    ordered = read.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

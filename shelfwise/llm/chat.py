"""Conversations to training texts by a compiled template, and back.

`TEMPLATE` puts each turn between control strings and marks the texts of the
assistant as generated. Inside texts and role names a backslash is doubled and
a control string gets a backslash after its first character, so that no control
string is left and the text can be read back exactly.

Rows are sorted by (conversation, turn, role, text) within partitions of whole
conversations and printed in parts of `PART_TURNS` turns; a task holds one part
and one Arrow batch, however long the conversation.

Defined results: null texts and roles are empty; null turns come first; rows
that repeat a turn all count, ordered by role and text; rows with a null
conv_id form one conversation of id null; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.template import Output, Template

PART_TURNS = 64
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")
TEMPLATE = (
    "{% for turn in turns %}"
    "{% if turn.role == 'user' %}[INST]{{ ' ' ~ (turn.text | escape) ~ ' ' }}[/INST]"
    "{% elif turn.role == 'assistant' %}<s>{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
    "{% else %}{% if turn.role != 'system' %}<<ROLE>>{{ turn.role | escape }}<</ROLE>>{% endif %}"
    "<<SYS>>{{ turn.text | escape }}<</SYS>>{% endif %}"
    "{% endfor %}")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\|" + _CONTROL.pattern)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def read_back(text: str) -> Iterator[tuple[str, str]]:
    """The (role, text) of each turn of a formatted conversation."""
    at, role = 0, None
    marks = [(m[0], m.start(), m.end()) for m in _CONTROL.finditer(text)]
    for (mark, start, end), (closing, inner_end, after) in zip(marks[::2], marks[1::2], strict=True):
        body = text[end:inner_end]
        if start != at or closing != mark.replace("<<", "<</") and closing != f"{mark[0]}/{mark[1:]}":
            raise ValueError("not a formatted conversation")
        at = after
        if mark == "[INST]":
            yield "user", unescape(body[1:-1])
        elif mark == "<s>":
            yield "assistant", unescape(body)
        elif mark == "<<ROLE>>":
            role = unescape(body)
        else:
            yield ("system" if role is None else role), unescape(body)
            role = None
    if at != len(text):
        raise ValueError("not a formatted conversation")


def chat_template(source: str = TEMPLATE) -> Template:
    return Template(source, {"escape": escape})


def sorted_turns(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _parts(found: Iterator[pa.RecordBatch], size: int):
    """(conv_id, turns before, turns, if the conversation ends) in the order of the rows."""
    nothing = object()
    now, before, turns = nothing, 0, []
    for batch in found:
        columns = (batch.column(c) for c in ("conv_id", "role", "text"))
        for conv, role, text in zip(*(c.to_pylist() for c in columns), strict=True):
            if conv != now or len(turns) == size:
                if now is not nothing:
                    yield now, before, turns, conv != now
                before = before + len(turns) if conv == now else 0
                now, turns = conv, []
            turns.append({"role": role, "text": text})
    if now is not nothing:
        yield now, before, turns, True


def format_conversations(conversations: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """(conv_id, part, text, spans): the training texts, with the spans under the loss mask.

    The parts of a conversation, in order, make up its text; spans are code
    points of the part.
    """

    def batches(found):
        template = chat_template(source)
        for conv, before, turns, _ in _parts(found, PART_TURNS):
            out = template.render(turns, before)
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "part": before // PART_TURNS, "text": out.text(),
                  "spans": [{"start": a, "end": b} for a, b in out.spans]}], schema=kind)

    kind = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
                      ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    rows = sorted_turns(conversations.withColumn("conv_id", F.col("conv_id").cast("long")))
    return rows.mapInArrow(batches, "conv_id long, part long, text string, spans array<struct<start:long,end:long>>")


class _Digest:
    """What is read back from the parts of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.count = self.loss_chars = self.chars = 0

    def add(self, out: Output) -> None:
        text = out.text()
        for role, said in read_back(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.count += 1
        for start, end in out.spans:
            said = unescape(text[start:end])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(text)


def conversation_digests(conversations: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """Format all conversations, read them back, and digest what was read."""

    def batches(found):
        template = chat_template(source)
        rows, digest = [], _Digest()
        for conv, before, turns, last in _parts(found, PART_TURNS):
            digest.add(template.render(turns, before))
            if last:
                rows.append((conv, digest.count, digest.turns.hexdigest(), digest.loss_chars,
                             digest.loss.hexdigest(), digest.chars))
                digest = _Digest()
            if len(rows) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    rows = sorted_turns(conversations.withColumn("conv_id", F.col("conv_id").cast("long")))
    return rows.mapInArrow(batches, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")

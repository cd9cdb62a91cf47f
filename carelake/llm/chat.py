"""Chat formatting: a declarative template, a finite-state machine over roles, text segments with loss flags.

A turn becomes three segments: what opens it, its text with control characters escaped, what closes it;
the first turn of a conversation also opens the conversation. Only the text of roles that the template
trains on is under the loss. A backslash before each control character and backslash makes escaping
reversible, and since every control string contains an unescaped control character, no text can imitate
one. `READER` reads the turns back.

Turns are in the order of turn, then role and text for ties, NULL turns last. Defined results: a NULL text
or role is empty; roles that the template lacks are kept in a turn that names them; a conversation is
valid if each role may follow the one before it and the last may end it, and invalid ones are formatted
all the same; a NULL conv_id is a conversation; repeated rows are turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The template: control strings around each role's text, what opens a conversation, who may follow whom,
#: who may end, and whose text is trained on. START stands for the beginning.
START = ""
TEMPLATE = {
    "control": "\\<[]",
    "begin": "<s>",
    "turns": {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": (" <A>", "</s>"),
    },
    "other": ("[TURN ", "] ", " [/TURN]"),
    "follow": {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    "end": ("assistant",),
    "loss": ("assistant",),
}

_BODY = r"((?:[^\\<\[\]]|\\.)*)"


def _reader() -> re.Pattern:
    parts = [re.escape(a) + _BODY + re.escape(b) for a, b in TEMPLATE["turns"].values()]
    a, b, c = map(re.escape, TEMPLATE["other"])
    return re.compile(f"(?:{re.escape(TEMPLATE['begin'])})?(?:{'|'.join([*parts, a + _BODY + b + _BODY + c])})", re.DOTALL)


READER = _reader()
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text of whole turns."""
    out, at = [], 0
    for m in READER.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        for role, text in zip(TEMPLATE["turns"], m.groups(), strict=False):
            if text is not None:
                out.append((role, unescaped(text)))
        if m.group(len(TEMPLATE["turns"]) + 1) is not None:
            out.append((unescaped(m.group(m.lastindex - 1)), unescaped(m.group(m.lastindex))))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return out


def _order():
    return F.col("turn").asc_nulls_last(), F.col("role").asc(), F.col("text").asc()


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, may_follow, and segments: an array of text and loss, one row for each turn."""
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy(*_order()))
    rows = rows.withColumn("before", before)

    def escaped(c):
        return F.regexp_replace(c, r"([\\<\[\]])", r"\\$1")

    opening, closing = (F.create_map(*[F.lit(x) for r, t in TEMPLATE["turns"].items() for x in (r, t[k])]) for k in (0, 1))
    a, b, c = TEMPLATE["other"]
    opens = F.coalesce(F.try_element_at(opening, F.col("role")), F.concat(F.lit(a), escaped("role"), F.lit(b)))
    closes = F.coalesce(F.try_element_at(closing, F.col("role")), F.lit(c))
    begins = F.when(F.col("before").isNull(), TEMPLATE["begin"]).otherwise("")
    steps = F.array(*(F.lit(f"{x}>{y}") for x, ys in TEMPLATE["follow"].items() for y in ys))
    may = F.array_contains(steps, F.concat(F.coalesce("before", F.lit(START)), F.lit(">"), F.col("role")))
    trained = F.col("role").isin(*TEMPLATE["loss"])
    parts = ((F.concat(begins, opens), F.lit(False)), (escaped("text"), trained), (closes, F.lit(False)))
    segments = F.array(*(F.struct(t.alias("text"), x.alias("loss")) for t, x in parts))
    return rows.select("conv_id", "turn", "role", "text", may.alias("may_follow"), segments.alias("segments"))


def _digests(schema: pa.Schema):
    """One row for each conversation, read back turn by turn; a conversation of any length needs the same memory."""

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def close():
            state["turns_sha256"], state["loss_sha256"] = (state[c].hexdigest() for c in ("turns", "loss"))
            state["valid"] = state["valid"] and state["last"] in TEMPLATE["end"]
            out.append({f.name: state[f.name] for f in schema})

        state: dict = {}
        for batch in batches:
            for conv_id, may, segments in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "may_follow", "segments")), strict=True):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        close()
                    now = (conv_id,)
                    state = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "valid": True}
                    state |= {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "last": None}
                text = "".join(s["text"] for s in segments)
                state["formatted_chars"] += len(text)
                for role, own in read(text):
                    state["n_turns"] += 1
                    state["turns"].update(f"{role}\n{own}\n".encode())
                    state["last"] = role
                for s in segments:
                    if s["loss"]:
                        own = unescaped(s["text"])
                        state["loss_chars"] += len(own)
                        state["loss"].update(own.encode())
                state["valid"] = state["valid"] and may
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if now is not None:
            close()
            yield pa.RecordBatch.from_pylist(out, schema)

    return of


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, read from formatted turns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType([turns.schema["conv_id"]])
    for name, kind in (("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"), ("formatted_chars", "long"), ("valid", "boolean")):
        schema = schema.add(name, kind)
    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    return rows.select("conv_id", "may_follow", "segments").mapInArrow(_digests(to_arrow_schema(schema)), schema)

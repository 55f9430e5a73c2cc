"""Chat records of many layouts to canonical turns, and turns to one formatted text with a loss mask.

A record is a JSON object. The paths of its nested fields (``messages[].role`` and the like) are
sorted and hashed; the hash selects a declared layout, which names the fields that hold the turns.
A layout with optional fields is found under the hash of each of its variants. No code looks into
a record to guess what it is.

The formatted text marks each turn as ``### role: text</turn>`` and a line feed. Inside roles and
texts a backslash is put before a backslash, before a ``#`` that follows a ``#``, before the slash
of ``</`` and, in roles, before a colon; so neither marker can occur inside, and taking away each
backslash that stands before a character gives the original back.

Defined results: a record that is null or no JSON object, that nests deeper than can be parsed, names a key
twice or holds half a surrogate pair has layout "broken", one of an undeclared
shape "unknown"; both have null turns and a null formatted text. A list of turns whose members
aren't all objects is of no declared shape. Null roles and texts count as
empty, other values as their JSON text. A record whose list of turns is empty has no field paths
below the list and is of layout "messages" or "shares" all the same; its formatted text is empty.
Fields with null values count as present.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.llm.frames import small_batches

BROKEN, UNKNOWN = "broken", "unknown"
TURNS = "array<struct<role:string,text:string>>"


#: The path of an empty list, behind the list's own.
EMPTY = "[0]"
_KEY, _ESCAPED_KEY = re.compile(r"([.\[\]\\])"), r"\\\1"

# ---- layouts --------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where a record of one shape holds its turns.

    Either ``turns`` names a list of objects with a role and a text field, or ``fields`` lists
    (role, paths): one turn for each role, its texts joined by an empty line. ``roles`` renames.
    """

    name: str
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)

    def variants(self) -> list[frozenset[str]]:
        """The sets of field paths that a record of this layout can have."""
        if self.turns:
            whole = {f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"}
            return [
                frozenset(paths) | frozenset(some)
                for paths in (whole, {f"{self.turns}{EMPTY}"})
                for n in range(len(self.optional) + 1)
                for some in combinations(self.optional, n)
            ]
        needed = {p for _, paths in self.fields for p in paths} - set(self.optional)
        return [
            frozenset(needed) | frozenset(some)
            for n in range(len(self.optional) + 1)
            for some in combinations(self.optional, n)
        ]


LAYOUTS = (
    Layout("messages", turns="messages", role="role", text="content", optional=("id",)),
    Layout(
        "shares", turns="conversations", role="from", text="value", optional=("id",),
        roles={"human": "user", "gpt": "assistant"},
    ),
    Layout(
        "prompt", fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
        optional=("system", "id"),
    ),
    Layout("completion", fields=(("user", ("prompt",)), ("assistant", ("completion",))), optional=("id",)),
    Layout(
        "instruction", fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
        optional=("system", "input", "id"),
    ),
    Layout(
        "preference", fields=(("user", ("prompt",)), ("assistant", ("chosen",))), optional=("rejected", "id"),
    ),
    Layout("nested", fields=(("user", ("data.question",)), ("assistant", ("data.answer.text",))), optional=("id", "data.id")),
)


def field_paths(value: object) -> set[str]:
    """Paths of all leaves; list members share the path of their list with ``[]``, an empty list is a leaf of its own kind.

    Dots, brackets and backslashes in keys are escaped, so a key never reads as a path.
    """
    found: set[str] = set()
    todo = [(value, "")]
    while todo:
        one, at = todo.pop()
        if isinstance(one, dict) and one:
            todo += [(v, f"{at}.{_KEY.sub(_ESCAPED_KEY, k)}" if at else _KEY.sub(_ESCAPED_KEY, k)) for k, v in one.items()]
        elif isinstance(one, list):
            todo += [(v, f"{at}[]") for v in one]
            if not one:
                found.add(at + EMPTY)
        else:
            found.add(at)
    return found


def fingerprint(paths: set[str] | frozenset[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode(errors="surrogatepass")).hexdigest()


def by_fingerprint(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    found: dict[str, Layout] = {}
    for layout in layouts:
        for paths in layout.variants():
            other = found.setdefault(fingerprint(paths), layout)
            if other is not layout:
                raise ValueError(f"layouts {other.name} and {layout.name} share the paths {sorted(paths)}")
    return found


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def _at(record: dict, path: str) -> object:
    for key in path.split("."):
        if not isinstance(record, dict) or key not in record:
            return None
        record = record[key]
    return record


def turns_of(record: dict, layout: Layout) -> list[tuple[str, str]]:
    if layout.turns:
        pairs = [(_text(t.get(layout.role)), _text(t.get(layout.text))) for t in _at(record, layout.turns)]
        return [(layout.roles.get(role, role), text) for role, text in pairs]
    out = []
    for role, paths in layout.fields:
        given = [p for p in paths if _at(record, p) is not None or p not in layout.optional]
        if given:
            out.append((role, "\n\n".join(_text(_at(record, p)) for p in given)))
    return out


def _once(pairs: list[tuple[str, object]]) -> dict:
    """An object whose keys are told once; of two values under one key one would be lost."""
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a key twice")
    return out


def canonical(record: str | None, layouts: dict[str, Layout]) -> tuple[str, list[tuple[str, str]] | None]:
    """(layout name, turns) of one record."""
    try:
        value = json.loads(record, object_pairs_hook=_once) if record is not None else None
    except (ValueError, RecursionError):
        value = None
    if not isinstance(value, dict):
        return BROKEN, None
    layout = layouts.get(fingerprint(field_paths(value)))
    if layout is None:
        return UNKNOWN, None
    turns = turns_of(value, layout)
    try:
        "".join(part for turn in turns for part in turn).encode()
    except UnicodeEncodeError:
        return BROKEN, None
    return layout.name, turns


# ---- the template ---------------------------------------------------------------------

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    text = re.sub(r"(?<=#)#", r"\\#", text.replace("\\", "\\\\"))
    return text.replace("</", "<\\/")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, spans of its code points that are trained on)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + escape(role).replace(":", "\\:") + MIDDLE
        body = escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        end = formatted.index(CLOSE, head.end())
        turns.append((unescape(head[1]), unescape(formatted[head.end() : end])))
        at = end + len(CLOSE)
    return turns


# ---- tables ---------------------------------------------------------------------------

FORMATTED = "layout string, formatted string, loss_spans array<struct<start:int,end:int>>"


def format_udf(layouts: tuple[Layout, ...] = LAYOUTS):
    named = by_fingerprint(layouts)

    @pandas_udf(FORMATTED)
    def formatted(records: pd.Series) -> pd.DataFrame:
        out = []
        for record in records:
            name, turns = canonical(record, named)
            text, spans = (None, None) if turns is None else render(turns)
            out.append((name, text, None if spans is None else [{"start": a, "end": b} for a, b in spans]))
        return pd.DataFrame(out, columns=["layout", "formatted", "loss_spans"])

    return formatted


def format_records(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with layout, formatted and loss_spans in one struct column ``chat``.

    A column ``chat`` of the input goes on as ``input_chat`` (with more of the prefix where that is taken).
    """
    small_batches(records.sparkSession)
    columns, kept = records.columns, "chat"
    while kept in columns:
        kept = f"input_{kept}"
    if "chat" in columns:
        records = records.withColumnRenamed("chat", kept)
        record = kept if record == "chat" else record
    return records.withColumn("chat", format_udf(layouts)(f"`{record}`"))


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(chat: str):
    """A struct of digests of what the formatted text and loss mask in column ``chat`` hold."""
    names = [c.split()[0] for c in DIGEST.split(", ")]

    @pandas_udf(DIGEST)
    def digested(chats: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text, spans in zip(chats["formatted"], chats["loss_spans"], strict=True):
            if text is None:
                out.append((None,) * len(names))
                continue
            turns = parse(text)
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in (whole, loss)]
            out.append((len(turns), digests[0], len(loss), digests[1], len(text)))
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({"n_turns": "Int64", "loss_chars": "Int64", "formatted_chars": "Int64"})

    return digested(chat)


def as_records(turns: DataFrame) -> DataFrame:
    """(conv_id, record) from rows (conv_id, turn, role, text), in the layouts such chats come in.

    A system, user and assistant turn make a prompt record, other chats a list of messages; where
    all roles are the usual ones, every other chat is written with the names human and gpt. Turns
    are ordered by turn, role and text, nulls first; rows that are alike are turns of their own.
    """
    said = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    shared = F.to_json(
        F.struct(
            F.transform(
                "t",
                lambda t: F.struct(
                    F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"),
                    t["text"].alias("value"),
                ),
            ).alias("conversations")
        )
    )
    messages = F.to_json(
        F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))
    )
    usual = F.forall("t", lambda t: t["role"].isin("user", "assistant", "system"))
    record = (
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), F.to_json(F.struct(
            F.col("t")[0]["text"].alias("prompt"), F.col("t")[1]["text"].alias("response"))))
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), F.to_json(F.struct(
            F.col("t")[0]["text"].alias("system"), F.col("t")[1]["text"].alias("prompt"), F.col("t")[2]["text"].alias("response"))))
        .when(usual & (F.coalesce(F.col("conv_id"), F.lit(0)) % 2 == 1), shared)
        .otherwise(messages)
    )
    return chats.select("conv_id", record.alias("record"))

"""Chat formatting with a template that is only known by what it renders.

``render`` is any function from a list of (role, text) turns to one string. To find where a turn stands in the output, the
prefixes of 1, 2, ... turns are rendered one after another and compared: if the output of k turns begins with the output of
k-1 turns, the k-th turn owns what was added; if not, the template rewrites history and the conversation is flagged (its spans
are then null). Inside an added piece the text is located by rendering the turn once more with a probe text of other letters:
the common prefix and suffix of the two pieces are the template's own marks. That is also where a template that changes the
text (trims it, say) shows.

Every template, the default one too, is taken as a black box: each prefix is rendered whole, and so is the prefix with the probe. The
cost of a conversation is its turns times its characters; conversations are short, and no two meet in a task's memory at once.

The default template writes ``### Role: text </turn>\\n``; a backslash goes before every backslash and every control string
inside a text, so texts that contain marks come back unchanged.

Null texts are empty, null roles are empty. Rows with a null turn come first; rows of the same turn are ordered by role and
text. A conversation without rows does not exist. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
OPEN, CLOSE, END = "### ", ": ", " </turn>\n"
CONTROL = re.compile(r"\\|###|</turn>")
ESCAPED = re.compile(r"\\(\\|###|</turn>)")
TURN = re.compile(r"### ((?:\\.|[^:\\])*): ((?:\\(?:\\|###|</turn>)|[^\\])*?) </turn>\n", re.S)
LEARNED = "assistant"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def _role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def _role_back(role: str) -> str:
    return unescape(role.replace("\\:", ":"))


def _turn(role: str, text: str) -> str:
    return f"{OPEN}{_role(role)}{CLOSE}{escape(text)}{END}"


def render(turns: list[Turn]) -> str:
    return "".join(_turn(*t) for t in turns)


def parse(formatted: str) -> list[Turn]:
    """The turns read back from the default template's output."""
    turns, at = [], 0
    while at < len(formatted):
        if (found := TURN.match(formatted, at)) is None:
            raise ValueError(f"no turn at {at}")
        turns.append((_role_back(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def _probe(text: str) -> str:
    """A text that shares neither its first nor its last character with ``text``, nor with its escaped form."""
    used = set(text[:1] + text[-1:] + "\\")
    mark = next(c for c in "QZXJ" if c not in used)
    return mark * 3


def spans(turns: list[Turn], template: Callable[[list[Turn]], str] = render) -> tuple[str, list[tuple[int, int, int, int]] | None]:
    """The rendered conversation and, per turn, (start, text start, text end, end) in it; None if history was rewritten."""
    found, before = [], ""
    for k, (role, text) in enumerate(turns):
        now = template(turns[:k + 1])
        if not now.startswith(before):
            return template(turns), None
        probed = template([*turns[:k], (role, _probe(text))])
        if not probed.startswith(before):
            return template(turns), None
        at, added, other = len(before), now[len(before):], probed[len(before):]
        head = _common(added, other)
        tail = _common(added[head:][::-1], other[head:][::-1])
        found.append((at, at + head, len(now) - tail, len(now)))
        before = now
    return before, found


def format_conversations(rows: DataFrame, template: Callable[[list[Turn]], str] = render, *, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation: formatted text, loss spans (start, end) of the learned role's texts, and ``rewrites``.

    A conversation is a unit of training and is gathered whole; conversations are dealt over tasks by their id.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = rows.groupBy(F.col(conversation).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def work(frames):
        for frame in frames:
            out = []
            for turns in frame["turns"]:
                said = [(t["role"], t["text"]) for t in turns]
                text, found = spans(said, template)
                loss = [] if found is None else [s for (role, _), s in zip(said, found) if role == LEARNED]
                out.append((text, len(said), [s[1] for s in loss], [s[2] for s in loss], found is None))
            yield pd.DataFrame({
                "conv_id": frame["conv_id"], "formatted": [o[0] for o in out], "n_turns": pd.array([o[1] for o in out], "int64"),
                "loss_starts": [o[2] for o in out], "loss_ends": [o[3] for o in out], "rewrites": pd.array([o[4] for o in out], "bool"),
            })

    kind = rows.schema[conversation].dataType.simpleString()
    return gathered.mapInPandas(work, f"conv_id {kind}, formatted string, n_turns long, loss_starts array<long>, loss_ends array<long>, rewrites boolean")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted text and its loss mask."""

    def work(frames):
        for frame in frames:
            rows = []
            for text, starts, ends in zip(frame["formatted"], frame["loss_starts"], frame["loss_ends"]):
                turns = parse(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[a:b]) for a, b in zip(starts, ends))
                rows.append((len(turns), _sha(whole), len(loss), _sha(loss), len(text)))
            yield pd.DataFrame({"conv_id": frame["conv_id"]}).assign(**{
                name: [r[k] for r in rows] for k, name in enumerate(("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))})

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInPandas(work, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()

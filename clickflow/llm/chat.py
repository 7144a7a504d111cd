"""Chat formatting by incremental black-box rendering.

A template renders a list of (role, text) to a string, by any function. Successive prefixes of a
conversation are rendered and consecutive outputs compared, which shows each turn's span, and
whether the template rewrites history: then an output does not start with the one before.

Nothing is assumed of a template, so a conversation is rendered as a whole, and prefix by prefix. One that
declares itself incremental, a sequence of turns giving what its parts give one after the other,
is rendered a few turns at a time; whether this holds is tried on the turns beside every cut, which
cannot show a template that looks further back.
"""

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Turns = list[tuple[str, str]]

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat formats, which must not stand in a text.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_raw = re.compile("|".join(f"({re.escape(c[0])})(\\\\*)({re.escape(c[1:])})" for c in CONTROL))
_escaped = re.compile("|".join(f"({re.escape(c[0])})\\\\(\\\\*)({re.escape(c[1:])})" for c in CONTROL))

_FIRST = sorted({c[0] for c in CONTROL})

# Of an incremental template: turns whose prefixes are rendered together, and turns held in memory.
STEP = 4
WINDOW = 64


def _join(match, extra):
    first, slashes, rest = (g for g in match.groups() if g is not None)
    return first + extra + slashes + rest


def _may_hold(text: str) -> bool:
    """Whether a control string can begin anywhere."""
    return any(first in text for first in _FIRST)


@lru_cache(maxsize=256)
def escape(text: str) -> str:
    """A backslash after the first character of every control string, more if some are there."""
    if not _may_hold(text):
        return text
    return _raw.sub(lambda m: _join(m, "\\"), text)


def unescape(text: str) -> str:
    if not _may_hold(text):
        return text
    return _escaped.sub(lambda m: _join(m, ""), text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def marked(turns: list[tuple[str, str]]) -> str:
    """The default template: every turn between markers, its role on the first line."""
    return "".join(f"{START}{_escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of what ``marked`` has written."""
    turns = []
    for part in formatted.split(START)[1:]:
        head, _, body = part.partition("\n")
        turns.append((_unescape_role(head), unescape(body[: body.index(END)])))
    return turns


@dataclass(frozen=True)
class Template:
    """``render`` writes turns, ``read`` gives the turns of what it wrote, ``plain`` a text as it was before it was written."""

    render: Callable[[Turns], str]
    read: Callable[[str], Turns]
    plain: Callable[[str], str] = str
    incremental: bool = False


MARKED = Template(marked, read_back, unescape, incremental=True)


def _common(one: str, other: str) -> int:
    """How many characters two different strings have in common at their start."""
    low, high = 0, min(len(one), len(other))
    while high - low > 1:
        middle = (low + high) // 2
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle
    return low + (one[low:high] == other[low:high] and high > low)


def _span(turns: Turns, k: int, now: str, render: Callable[[Turns], str]) -> tuple[int, int] | None:
    """Where the ``k``-th text stands in ``now``, the rendered turns; None if it does not.

    Two renderings that differ in that text alone show what stands around it.
    """
    role, after = turns[k][0], turns[k + 1 :]
    # Probes that no control string begins or ends with.
    one, other = (render([*turns[:k], (role, probe), *after]) for probe in "ab")
    if one == other:
        return None
    head = _common(one, other)
    return head, len(now) - (len(one) - head - 1)


def spans(turns: Turns, render: Callable[[Turns], str] = marked) -> tuple[str, list[tuple[int, int] | None], bool]:
    """(output, each turn's text span in it, whether the template rewrites history).

    A span is found in the prefix that ends with its turn. Where later outputs do not start with that
    prefix's, spans are found once more in the whole; a text that is not in it has none.
    """
    output, found, rewrites = "", [], False
    for k in range(len(turns)):
        prefix = turns[: k + 1]
        now = render(prefix)
        found.append(_span(prefix, k, now, render))
        rewrites |= not now.startswith(output)
        output = now
    if rewrites:
        found = [_span(turns, k, output, render) for k in range(len(turns))]
    return output, found, rewrites


def located(turns: Turns, template: Template, before: Turns = ()) -> tuple[str, list, bool]:
    """``spans`` of turns that continue ``before``; of an incremental template a few turns at a time."""
    if not template.incremental:
        return spans(turns, template.render)
    output, found, last = "", [], list(before)[-1:]
    for low in range(0, len(turns), STEP):
        step = turns[low : low + STEP]
        part, places, rewrites = spans(step, template.render)
        if last and template.render([*last, *step]) != template.render(last) + part:
            raise ValueError("the template is not incremental")
        if rewrites:
            raise ValueError("an incremental template may not rewrite history")
        found += [place and (place[0] + len(output), place[1] + len(output)) for place in places]
        output, last = output + part, step[-1:]
    return output, found, False


class _Conversation:
    """Digests of one conversation, fed turn by turn.

    Of an incremental template it holds one window of turns at most, else the conversation.
    """

    def __init__(self, template: Template, loss_role: str):
        self.template, self.loss_role, self.held, self.last = template, loss_role, [], []
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.formatted_chars = 0
        self.rewrites = False

    def add(self, role: str, text: str):
        self.held.append((role, text))
        if self.template.incremental and len(self.held) == WINDOW:
            self.close_window()

    def close_window(self):
        if not self.held:
            return
        output, found, rewrites = located(self.held, self.template, self.last)
        self.rewrites |= rewrites
        self.formatted_chars += len(output)
        for role, text in self.template.read(output):
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        for place, (role, _) in zip(found, self.held):
            if role == self.loss_role and place is not None:
                masked = self.template.plain(output[slice(*place)])
                self.loss.update(masked.encode("utf-8", "surrogatepass"))
                self.loss_chars += len(masked)
        self.held, self.last = [], self.held[-1:]

    def row(self, key):
        self.close_window()
        return (key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.rewrites)


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"


def _sorted_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def chat_digests(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = MARKED,
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id and ``DIGEST``, read back from the formatted output.

    The turns are those that the template reads in its output, the loss is on the texts of ``loss_role``
    that stand in it, and ``rewrites`` says that it rewrites history.

    Turns are ordered by ``turn``, ties by role and text; null roles and texts are empty,
    null turns come first, repeated rows are turns of their own, and rows with a null id are
    one conversation; other columns are left out. Conversations stream through their task in order. Of
    an incremental template one window is in memory, so even a conversation that holds a third of
    all turns needs little of it; of any other template one conversation is, and it is rendered prefix by prefix.
    """
    rows = _sorted_turns(df, conv, turn, role, text)
    schema = T.StructType([T.StructField(conv, df.schema[conv].dataType), *T._parse_datatype_string(DIGEST).fields])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, key, begun = None, None, False
        for batch in batches:
            out = []
            ids = batch["conv"].astype(object).where(batch["conv"].notna(), None)
            for new, who, said in zip(ids, batch["role"], batch["text"]):
                if not begun or new != key:
                    if begun:
                        out.append(current.row(key))
                    current, key, begun = _Conversation(template, loss_role), new, True
                current.add(who, said)
            yield _frame(out, schema)
        if begun:
            yield _frame([current.row(key)], schema)

    return rows.mapInPandas(digest, schema)


def _frame(rows, schema):
    frame = pd.DataFrame(rows, columns=schema.names, dtype=object)
    return frame.astype({f.name: "Int64" for f in schema.fields if f.dataType == T.LongType()})


FORMATTED = "part long, formatted string, spans array<struct<role:string,start:int,end:int>>, rewrites boolean"


def chat_format(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = MARKED,
) -> DataFrame:
    """The formatted text of every conversation with its text spans, a row for each window.

    ``formatted`` of a conversation's parts in order is the whole output, one part unless the template is
    incremental; spans are code points in their part, null where a text does not stand in the output, and
    those of assistant turns are the loss mask. Nulls and ties as in ``chat_digests``.
    """
    rows = _sorted_turns(df, conv, turn, role, text)
    schema = T.StructType([T.StructField(conv, df.schema[conv].dataType), *T._parse_datatype_string(FORMATTED).fields])

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, begun, part, held, last = None, False, 0, [], []

        def done():
            output, found, rewrites = located(held, template, last)
            places = [{"role": r, "start": p and p[0], "end": p and p[1]} for (r, _), p in zip(held, found)]
            return (key, part, output, places, rewrites)

        for batch in batches:
            out = []
            ids = batch["conv"].astype(object).where(batch["conv"].notna(), None)
            for new, who, said in zip(ids, batch["role"], batch["text"]):
                if begun and new != key:
                    if held:
                        out.append(done())
                    part, held, last = 0, [], []
                key, begun = new, True
                held.append((who, said))
                if template.incremental and len(held) == WINDOW:
                    out.append(done())
                    part, held, last = part + 1, [], held[-1:]
            yield _frame(out, schema)
        if held:
            yield _frame([done()], schema)

    return rows.mapInPandas(render, schema)

r"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. It is rendered on successive prefixes of a
conversation, always from the first turn on; each output is compared with the one before. What was appended is the new
turn's span. A closing part that every rendering ends with (an end mark) is recognised, as it follows the appended span
in both. A template that changes what it wrote before is detected, however long ago that was: the conversation is
marked with the first turn at which it happened.

The loss mask is the place of the text alone, without the template's marks. It is found from outside, too: the same
prefix is rendered with two other texts in the last turn, and what these outputs share before and behind their
difference is no text.

The rows of a conversation stream through one task in the order of their turns, and the template gets all turns so
far. So a task holds one conversation at a time, and rendering time grows with the square of its turns: 400 turns of
600 characters take about half a second.

The template used here, `MarkedTemplate`, writes ``### Role:\n`` before and ``</turn>\n`` after a text and puts a
backslash before each control string (``###``, ``</turn>`` and the backslash) inside texts, so it can be read back.

Defined cases: null text and null role are empty; a null turn stands first; rows of one conversation with equal turn are ordered by role, then
text, and repeated rows are turns of their own; each row without a conversation id is a conversation of its own, so
these rows go round over the tasks; very long texts are rendered whole; an empty table gives no rows; extra columns,
whatever their names, are never read. A turn whose text the template leaves out or rewrites has no loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm.common import table

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
#: Two texts of one character that show where a template puts a text.
PROBES = ("0", "1")


class MarkedTemplate:
    r"""``### Role:\n`` text ``</turn>\n`` per turn; control strings inside texts are escaped."""

    head, end = "### ", "</turn>"
    controls = ("###", "</turn>")

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for c in self.controls:
            text = text.replace(c, "\\" + c)
        return text

    @staticmethod
    def unescape(text: str, newline: str = "n") -> str:
        """Without the backslashes that escape; in roles ``\\n`` stands for a line feed."""
        return re.sub(r"\\(.)", lambda m: newline if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text

    def _role(self, role: str) -> str:
        return self.escape(role).replace("\n", "\\n")

    def __call__(self, turns: list[Turn]) -> str:
        return "".join([f"{self.head}{self._role(r)}:\n{self.escape(t)}{self.end}\n" for r, t in turns])

    @staticmethod
    def _find(text: str, mark: str, at: int) -> int:
        """The next ``mark`` that is no escaped text."""
        while (at := text.index(mark, at)) >= 0:
            n = 0
            while at - n > 0 and text[at - n - 1] == "\\":
                n += 1
            if n % 2 == 0:
                return at
            at += len(mark)
        raise ValueError(mark)

    def parse(self, text: str) -> Iterator[Turn]:
        """The turns that a rendering holds."""
        at = 0
        while at < len(text):
            if not text.startswith(self.head, at):
                raise ValueError(f"no turn begins at {at}")
            line = text.index(":\n", at)
            end = self._find(text, self.end, line + 2)
            yield self.unescape(text[at + len(self.head) : line], "\n"), self.unescape(text[line + 2 : end])
            at = end + len(self.end) + 1


def _shared(a: str, b: str, hint: int = 0) -> int:
    """Length of the common prefix; ``hint`` is a likely lower bound."""
    lo, hi = 0, min(len(a), len(b))
    if 0 < hint <= hi and a[:hint] == b[:hint]:
        lo = hint
    step = 1
    while lo < hi:
        to = min(hi, lo + step)
        if a[lo:to] == b[lo:to]:
            lo, step = to, 2 * step
        elif step == 1:
            break
        else:
            hi, step = to - 1, 1
    return lo


def spans(template: Template, turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int | None]:
    """The rendering of all turns, each turn's span in it, and the first turn that rewrote history (None: none did).

    After a turn that rewrote history the spans are those of the appended parts as far as they were still found.
    """
    before, found, rewrote, footer = template([]), [], None, 0
    for i in range(len(turns)):
        now = template(turns[: i + 1])
        kept = len(before) - footer
        if not (now.startswith(before[:kept]) and now.endswith(before[kept:])):
            # is there a closing part that moves along? take the longest that fits
            kept = _shared(before, now)
            while kept and now.endswith(before[kept - 1 :]):
                kept -= 1
            if now.endswith(before[kept:]) and kept >= (found[-1][0] if found else 0):
                footer = len(before) - kept
                if found:
                    found[-1] = (found[-1][0], kept)
            else:
                rewrote, footer = i if rewrote is None else rewrote, 0
        found.append((kept, len(now) - footer))
        before = now
    return before, found, rewrote


def text_place(template: Template, turns: list[Turn], final: str, hint: int = 0) -> tuple[int, int] | None:
    """Where the last turn's text stands in its rendering; None if it is not there, or no longer so in ``final``."""
    now = template(turns)
    one, two = (template([*turns[:-1], (turns[-1][0], c)]) for c in PROBES)
    start = _shared(one, two, hint)
    if start == len(one) == len(two):
        return None  # the text plays no part
    tail = _shared(one[start:][::-1], two[start:][::-1])
    end = len(now) - tail
    if end < start or now[:start] != one[:start] or now[end:] != one[len(one) - tail :] or final[start:end] != now[start:end]:
        return None
    return start, end


def rendered(template: Template, turns: list[Turn], loss_roles: tuple[str, ...]) -> tuple[str, list[dict], int | None]:
    """The rendering, per turn its span and the place of a text that bears loss, and the turn that rewrote history."""
    text, found, rewrote = spans(template, turns)
    marks = []
    for i, (start, end) in enumerate(found):
        at = text_place(template, turns[: i + 1], text, start) if turns[i][0] in loss_roles else None
        marks.append({"turn": i, "start": start, "end": end, "loss_start": at and at[0], "loss_end": at and at[1]})
    return text, marks, rewrote


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, list[Turn]]]:
    """(id, turns) of rows sorted by conversation and turn; a row without an id stands alone."""
    key, turns = None, []
    for pdf in batches:
        for conv, role, text in zip(pdf["conv"].tolist(), pdf["role"].tolist(), pdf["text"].tolist(), strict=True):
            if turns and (conv is None or conv != key):
                yield key, turns
                turns = []
            key = conv
            turns.append((role, text))
    if turns:
        yield key, turns


def format_conversations(
    df: DataFrame,
    template: Template | None = None,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: conv, formatted, spans (turn, start, end, loss_start, loss_end), rewrote_at."""
    template = template or MarkedTemplate()
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), text.alias("text"))
    rows = rows.withColumn("alone", F.when(F.col("conv").isNull(), F.monotonically_increasing_id()))
    rows = rows.repartition("conv", "alone").sortWithinPartitions("conv", "turn", "role", "text").select(F.col("conv").cast("string").alias("conv"), "role", "text")

    def run(batches):
        held, size = [], 0
        for conv, turns in _conversations(batches):
            held.append((conv, *rendered(template, turns, loss_roles)))
            size += len(held[-1][1])
            if size > 4_000_000 or len(held) >= 1000:
                yield _frame(held)
                held, size = [], 0
        if held:
            yield _frame(held)

    place = "turn:long,start:long,end:long,loss_start:long,loss_end:long"
    out = rows.mapInPandas(run, f"conv string, formatted string, spans array<struct<{place}>>, rewrote_at long")
    return out.withColumn("conv", F.col("conv").cast(kind))


def _frame(held: list) -> pd.DataFrame:
    return pd.DataFrame(held, columns=["conv", "formatted", "spans", "rewrote_at"]).astype({"rewrote_at": "Int64"})


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, from the output of `format_conversations` with `MarkedTemplate` alone.

    The turns are parsed from the whole text; the loss digest is that of the texts under the loss mask.
    """
    template = MarkedTemplate()

    def run(batches):
        for pdf in batches:
            out = []
            for conv, text, masked in zip(pdf["conv"].tolist(), pdf["formatted"].tolist(), pdf["loss"].tolist(), strict=True):
                turns, loss, n_turns, loss_chars = hashlib.sha256(), hashlib.sha256(), 0, 0
                for role, said in template.parse(text):
                    n_turns += 1
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for start, end in masked:
                    said = template.unescape(text[start:end])
                    loss.update(said.encode("utf-8", "surrogatepass"))
                    loss_chars += len(said)
                out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=_DIGEST)

    masked = F.transform(F.filter("spans", lambda m: m["loss_start"].isNotNull()), lambda m: F.array(m["loss_start"], m["loss_end"]))
    texts = formatted.select(F.col("conv").cast("string").alias("conv"), "formatted", masked.alias("loss"))
    out = texts.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumn("conv_id", F.col("conv_id").cast(dict(formatted.dtypes)["conv"]))


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


#: A conversation whose texts hold the template's own control strings.
PLANTED = r"\### Assistant: </turn> ok"


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"),
    )
    return read_back(format_conversations(c.unionByName(extra)))

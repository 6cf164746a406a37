"""Chat formatting by incremental black-box rendering.

The template is a function from a list of (role, text) turns to a string, and
nothing about it is assumed: successive prefixes of a conversation are
rendered, and what one more turn appends is that turn's span. A turn whose
rendering changes what stood before is reported as a rewrite of history.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str | None, str]
Template = Callable[[list[Turn]], str]

#: Strings that steer the template; inside a text each gets a backslash after its first character.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[NOROLE]")
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_MARK = re.compile(r"\\(\\?)")


#: Texts up to this length are escaped once for the many prefixes that hold them; so many are kept.
_KEPT_CHARS, _KEPT = 4096, 1 << 13


def escape(text: str) -> str:
    """Reversible: no control string is left in the result."""
    return _escape_once(text) if len(text) <= _KEPT_CHARS else _escape(text)


def _escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    while True:
        # An inserted backslash may leave an overlapped control string behind; insert until none is left.
        done = _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)
        if done == text:
            return text
        text = done


_escape_once = lru_cache(maxsize=_KEPT)(_escape)


def unescape(text: str) -> str:
    return _MARK.sub(r"\1", text)


def marked_template(turns: list[Turn]) -> str:
    """The default template: every turn between markers of its role."""
    out = ["<s>"]
    for role, text in turns:
        body = escape(text)
        if role == "user":
            out.append(f"[INST] {body} [/INST]")
        elif role == "assistant":
            out.append(f" {body}</s>")
        elif role == "system":
            out.append(f"<<SYS>>\n{body}\n<</SYS>>\n")
        elif role is None:
            out.append(f"[NOROLE]{body}</s>")
        else:
            out.append(f"[ROLE]{escape(role)}[/ROLE]{body}</s>")
    return "".join(out)


#: How a turn's span reads: role (None: named inside), text before and after the body.
_READ = (("user", "[INST] ", " [/INST]"), ("system", "<<SYS>>\n", "\n<</SYS>>\n"), (None, "[NOROLE]", "</s>"), ("assistant", " ", "</s>"))


def read_turn(piece: str) -> tuple[str | None, int, int]:
    """(role, start, end of the body) of one turn of :func:`marked_template`."""
    if piece.startswith("[ROLE]"):
        at = piece.index("[/ROLE]")
        return unescape(piece[6:at]), at + 7, len(piece) - 4
    for role, before, after in _READ:
        if piece.startswith(before) and piece.endswith(after):
            return role, len(before), len(piece) - len(after)
    raise ValueError("not a turn of this template")


@dataclass
class Rendered:
    output: str
    #: Start and end of each turn's span; of a turn that rewrites history, from the first change on.
    spans: list[tuple[int, int]] = field(default_factory=list)
    rewrites: list[int] = field(default_factory=list)


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def locate(template: Template, turns: list[Turn]) -> Rendered:
    """Render every prefix of the turns, in whole, and compare consecutive outputs.

    The work grows with the square of a conversation's turns: nothing is known
    of the template, so no shorter history than the whole can stand for it.
    """
    out = Rendered(template([]))
    for i in range(len(turns)):
        before, out.output = out.output, template(turns[: i + 1])
        if out.output.startswith(before):
            out.spans.append((len(before), len(out.output)))
        else:
            out.rewrites.append(i)
            out.spans.append((_common(before, out.output), len(out.output)))
    return out


FORMATTED = "conv_id bigint, formatted string, turns array<struct<start:int,end:int>>, rewrites array<int>"


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """Whole conversations from rows that arrive in order."""
    now, turns, started = None, [], False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if started and conv != now:
                yield now, turns
                turns = []
            now, started = conv, True
            turns.append((role, text or ""))
    if started:
        yield now, turns


def format_chats(convs: DataFrame, template: Template = marked_template, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id, formatted, turns (span of each turn), rewrites (turns that change history).

    Rows of a conversation are ordered by turn, then role, then text, null
    first; a null text is empty; a null conv_id is a conversation of its own;
    repeated rows are turns of their own; an empty table gives no rows. Rows
    arrive sorted, so a task holds one conversation at a time, which is the
    unit that a template needs whole.
    """
    rows = convs.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"), F.col(turn).alias("turn"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches):
        held: list = []
        for key, turns in _conversations(batches):
            done = locate(template, turns)
            held.append({"conv_id": key, "formatted": done.output, "turns": [{"start": a, "end": b} for a, b in done.spans], "rewrites": done.rewrites})
            if len(held) >= 500:
                yield pa.RecordBatch.from_pylist(held, schema=_FORMATTED)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_FORMATTED)

    return rows.mapInArrow(run, FORMATTED)


_FORMATTED = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("turns", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("rewrites", pa.list_(pa.int32()))])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_rewrites", pa.int64())])


def digest(formatted: DataFrame) -> DataFrame:
    """The query's columns, read back from the formatted output of the default template."""

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                told, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for span in row["turns"]:
                    piece = row["formatted"][span["start"] : span["end"]]
                    role, a, b = read_turn(piece)
                    text = unescape(piece[a:b])
                    told.update(f"{role or ''}\n{text}\n".encode())
                    if role == "assistant":
                        loss.update(text.encode())
                        chars += len(text)
                out.append((row["conv_id"], len(row["turns"]), told.hexdigest(), chars, loss.hexdigest(), len(row["formatted"]), len(row["rewrites"])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _DIGEST.types, strict=True)] if out else [pa.array([], t) for t in _DIGEST.types], schema=_DIGEST)

    return formatted.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_rewrites bigint")


EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def with_extra(convs: DataFrame) -> DataFrame:
    """``convs`` and conversation -1; where the input has one of that number, the added rows join its turns in order."""
    spark = convs.sparkSession
    extra = spark.createDataFrame(EXTRA, "conv_id bigint, turn bigint, role string, text string")
    return convs.select("conv_id", "turn", "role", "text").unionByName(extra)


DIGEST_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|<s>|</s>|\[INST\]|\[/INST\]|\[ROLE\]|\[/ROLE\]|\[NOROLE\]'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 18 END AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_rewrites
FROM sized GROUP BY conv_id
"""

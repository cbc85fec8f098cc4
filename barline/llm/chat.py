"""Chat formatting by a finite-state machine over roles (operator 2).

A template says how a turn of each role is written, which text counts for the loss, and which role may
follow which.  Rows are dealt by conversation, sorted by turn, and streamed: the machine holds one
conversation's state, never a group of conversations.

A turn is written ``### Role: text </turn>``; a role that the template does not name is written
``role=`` and the role.  Inside roles and texts, a backslash goes before each backslash, before ``###``
and before ``</turn>``, and in roles before each colon, so no control string of a text can be taken for
one of the template, and reading back restores every role and text.

A conversation whose turns are out of order is formatted too; ``valid`` is false then and ``error``
names the first turn that no rule allows.

Defined results: a null text is empty; a null role is a role without name that no rule allows; a null
conv_id is a conversation of its own; rows are ordered by turn (nulls first), role and text, and rows
that repeat a turn are all kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END = "<start>", "<end>"
OTHER = "role="
_ESCAPE = re.compile(r"\\|###|</turn>")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>|:)")
# A turn as written: an escaped role up to a colon that is not escaped, then an escaped text.
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?) </turn>\n", re.S)


@dataclass(frozen=True)
class Template:
    """Declares names of roles in the output, roles under the loss, and the machine's moves."""

    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", END)}
    )

    def allows(self, before: str, role: str) -> bool:
        return role in self.follows.get(before, ())

    def role_of(self, head: str) -> str:
        if head.startswith(OTHER):
            return unescape(head.removeprefix(OTHER))
        return next(r for r, n in self.names.items() if n == head)


CHAT = Template()


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


@dataclass
class Formatted:
    """The text of a conversation in segments (text, counts for the loss), and its validity."""

    segments: list[tuple[str, bool]]
    valid: bool
    error: str | None


def format_turns(turns: Iterable[tuple[str | None, str | None]], template: Template = CHAT) -> Formatted:
    """Runs the machine over (role, text); segments joined are the formatted text."""
    state, error, segments, pending = START, None, [], ""
    n = 0
    for n, (role, text) in enumerate(turns, 1):
        role = "" if role is None else role
        if error is None and not template.allows(state, role):
            error = f"turn {n}: {role or 'no role'} after {state}"
        state = role
        name = template.names.get(role)
        head = name if name is not None else OTHER + escape(role).replace(":", "\\:")
        pending += f"### {head}: "
        body = escape(text or "")
        if role in template.loss:
            segments += [(pending, False), (body, True)]
            pending = " </turn>\n"
        else:
            pending += body + " </turn>\n"
    if error is None and not template.allows(state, END):
        error = f"turn {n + 1}: end after {state}"
    if pending:
        segments.append((pending, False))
    return Formatted(segments, error is None, error)


def read_back(text: str, template: Template = CHAT) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"not a turn at {at}")
        out.append((template.role_of(m[1]), unescape(m[2])))
        at = m.end()
    return out


FORMATTED = "conv_id long, n_turns long, segments array<struct<text: string, loss: boolean>>, valid boolean, error string"
_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_conversations(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """(conv_id, n_turns, segments, valid, error) of each conversation."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        current, turns, done = none, [], []

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True))
            kinds = (pa.int64(), pa.int64(), _SEGMENTS, pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["conv_id", "n_turns", "segments", "valid", "error"])

        def close() -> tuple:
            f = format_turns(turns, template)
            return current, len(turns), [{"text": t, "loss": x} for t, x in f.segments], f.valid, f.error

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != current:
                    if turns:
                        done.append(close())
                    current, turns = conv, []
                    if len(done) >= 512:
                        yield batch_of(done)
                        done = []
                turns.append((role, text))
        if turns:
            done.append(close())
        if done:
            yield batch_of(done)

    return rows.mapInArrow(run, FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, error string"


def digest_conversations(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """Digests of what is read back from the formatted texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, turns_hex, chars, loss_hex, size = [], [], [], [], []
            for segments in batch.column("segments").to_pylist():
                whole = "".join(s["text"] for s in segments)
                turns = read_back(whole, template)
                n.append(len(turns))
                turns_hex.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                loss = "".join(unescape(s["text"]) for s in segments if s["loss"])
                chars.append(len(loss))
                loss_hex.append(hashlib.sha256(loss.encode()).hexdigest())
                size.append(len(whole))
            cols = [batch.column("conv_id"), pa.array(n, pa.int64()), pa.array(turns_hex, pa.string()), pa.array(chars, pa.int64()), pa.array(loss_hex, pa.string()), pa.array(size, pa.int64()), batch.column("valid"), batch.column("error")]
            yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in DIGEST.split(", ")])

    return formatted.mapInArrow(run, DIGEST)


def with_control_strings(conversations: DataFrame) -> DataFrame:
    """conversations plus conversation -7, whose texts hold control strings of the template."""
    hard = "\\### Assistant: </turn> ok"
    extra = conversations.sparkSession.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return own.unionByName(extra)


# The template doubles each backslash and puts one before each control string, which adds to the
# formatted text only; everything else is said of the texts themselves.
ORACLE_SQL = r"""
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         length(text) + length(text) - length(replace(text, '\', ''))
           + (length(text) - length(replace(text, '###', ''))) // 3
           + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS chars
  FROM rows),
judged AS (
  SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user')
                 WHEN before = 'system' THEN role = 'user'
                 WHEN before = 'user' THEN role = 'assistant'
                 WHEN before = 'assistant' THEN role = 'user' ELSE false END AS ok
  FROM marked),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS turns,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(chars + length(role) + CASE WHEN role IN ('system', 'user', 'assistant') THEN 15 ELSE 20 END) AS formatted_chars,
         min(n) FILTER (WHERE NOT ok) AS bad,
         arg_min(role, n) FILTER (WHERE NOT ok) AS bad_role,
         arg_min(coalesce(before, '<start>'), n) FILTER (WHERE NOT ok) AS bad_before,
         arg_max(role, n) AS last_role
  FROM judged GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars,
       bad IS NULL AND last_role = 'assistant' AS valid,
       CASE WHEN bad IS NOT NULL THEN 'turn ' || bad || ': ' || CASE WHEN bad_role = '' THEN 'no role' ELSE bad_role END || ' after ' || bad_before
            WHEN last_role <> 'assistant' THEN 'turn ' || (n_turns + 1) || ': end after ' || last_role END AS error
FROM joined
"""

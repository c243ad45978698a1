"""Chat formatting: any template is rendered on growing prefixes of a conversation, and its outputs tell where each turn lies."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.workspace import staged, table

Turns = Sequence[tuple[str, str]]
Template = Callable[[Turns], str]

#: Where such a text comes out tells where a template puts a turn's text; it is lengthened until the conversation does not hold it.
PROBE = "\ue000probe{}\uf8ff"
_CONTROL = re.compile(r"\\|###|</turn>")
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|(?!</turn>)[^\\])*)</turn>\n", re.S)


def escape(text: str) -> str:
    """Puts a backslash before every control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    """Takes the backslashes of ``escape`` away."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def marked_turns(turns: Turns) -> str:
    """The template of the registered query: ``### role: text</turn>`` and a line feed for each turn."""
    return "".join(f"### {escape(r).replace(':', chr(92) + ':')}: {escape(t)}</turn>\n" for r, t in turns)


def parse_marked(formatted: str) -> list[tuple[str, str]]:
    """The turns in an output of ``marked_turns``."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn begins at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def locate(template: Template, turns: Turns) -> tuple[str, list[tuple[int, int, int, int]], list[int]]:
    """Renders growing prefixes and compares neighbours.

    Returns the whole output, for each turn the span (start, end) that it added and the span of its text within
    (-1, -1 where the template does not show it), and the turns at which the template changed what it had said before.
    A turn's text is found by rendering the turn with a probe instead, a text that occurs nowhere in the conversation:
    what stands before and after the probe frames the text. Once history was rewritten, all texts are looked up in the whole output, each by a probe of its own.
    """
    whole = template(turns) + "".join(x for turn in turns for x in turn)
    probe = next(p for p in (PROBE.format("." * k) for k in range(len(whole) + 1)) if p not in whole)
    before, spans, rewrites = "", [], []
    for k in range(1, len(turns) + 1):
        now = template(turns[:k])
        if not now.startswith(before):
            rewrites.append(k - 1)
        same = len(before) if now.startswith(before) else _common(before, now)
        spans.append((same, len(now), *_text_span(template, turns[:k], k - 1, now, probe)))
        before = now
    if rewrites:
        spans = [(a, min(b, len(before)), *_text_span(template, turns, i, before, probe)) for i, (a, b, _, _) in enumerate(spans)]
    return before, spans, rewrites


def _common(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _text_span(template: Template, turns: Turns, i: int, output: str, probe: str) -> tuple[int, int]:
    probed = template([*turns[:i], (turns[i][0], probe), *turns[i + 1 :]])
    at = probed.find(probe)
    tail = len(probed) - at - len(probe)
    if at < 0 or output[:at] != probed[:at] or output[len(output) - tail :] != probed[at + len(probe) :]:
        return -1, -1
    return at, len(output) - tail


_OUTPUT = "conv_id long, formatted string, turn_spans array<struct<start:int,end:int,text_start:int,text_end:int>>, loss_spans array<struct<start:int,end:int>>, rewrites array<int>"


def format_conversations(turns: DataFrame, template: Template, loss_role: str = "assistant") -> DataFrame:
    """Formats whole conversations with a template that is only ever called.

    Returns one row per conversation: ``conv_id``, ``formatted``, ``turn_spans``, ``loss_spans`` (texts of ``loss_role`` turns, in
    order) and ``rewrites`` (turns, from 0, at which the template changed earlier output). Spans count code points. Rows are
    taken by turn (null first), equal turns by role and text; repeated rows are turns of their own; a null role or text is
    empty. Rows without a conv_id are one conversation; other columns are ignored; an empty table gives no rows. A conversation is one
    training example and is held by one task; rendering prefixes costs the square of its number of turns.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                rows = []
                for conv_id, said in batch.iloc[a : a + 256].itertuples(index=False, name=None):
                    talk = [(t["role"] or "", t["text"] or "") for t in said]
                    text, spans, rewrites = locate(template, talk)
                    loss = [s[2:] for s, (role, _) in zip(spans, talk, strict=True) if role == loss_role and s[2] >= 0]
                    rows.append((conv_id, text, spans, loss, rewrites))
                yield pd.DataFrame(rows, columns=["conv_id", "formatted", "turn_spans", "loss_spans", "rewrites"])

    whole = (
        turns.select(F.col("conv_id").cast("long").cast("string").alias("conv_id"), "turn", "role", "text")  # a null among pandas integers would make them floats
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))
    )
    made = whole.mapInPandas(run, _OUTPUT.replace("conv_id long", "conv_id string"))
    return made.withColumn("conv_id", F.col("conv_id").cast("long"))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for conv_id, text, loss in batch[["conv_id", "formatted", "loss_spans"]].itertuples(index=False, name=None):
            turns = parse_marked(text)
            said = "".join(f"{r}\n{t}\n" for r, t in turns)
            learned = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
            rows.append((conv_id, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
        yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-7) that is full of control strings, formatted and read back."""
    hard = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    written = staged(format_conversations(rows, marked_turns), "chats")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    digests = written.select(F.col("conv_id").cast("string").alias("conv_id"), "formatted", "loss_spans").mapInPandas(_digests, schema.replace("conv_id long", "conv_id string"))
    return digests.withColumn("conv_id", F.col("conv_id").cast("long"))


ORACLE = {
    "op9_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
x AS (
  SELECT *, length(role) + (length(role) - length(replace(role, '\', ''))) + (length(role) - length(replace(role, ':', '')))
         + (length(role) - length(replace(role, '###', ''))) // 3 + (length(role) - length(replace(role, '</turn>', ''))) // 7 AS role_chars,
         length(text) + (length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '###', ''))) // 3
         + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS text_chars FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS learned,
         sum(role_chars + text_chars + 14)::BIGINT AS formatted_chars FROM x GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned)::BIGINT AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
"""
}

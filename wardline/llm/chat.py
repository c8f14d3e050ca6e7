"""Chat logs folded into final messages and rendered by a template with a loss mask.

A log is a stream of events. ``message`` begins a message, ``delta`` appends to it, ``edit`` and
``regenerate`` replace what it says so far (deltas may follow), ``delete`` removes it. The fold is
dealt out by conversation *and* message, so one busy conversation is folded by many tasks; only
the finished messages meet to be rendered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, table

# What the template writes around the text of a role, and around any other role's.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[TURN]", "[SAYS]", "[/TURN]")
CONTROL = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[TURN]", "[SAYS]", "[/TURN]")
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    """Double every backslash, then break each control string by one after its first character."""
    ahead = "|".join(re.escape(c[1:]) for c in CONTROL)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])(?=(?:{ahead}))", r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def fold(events: DataFrame) -> DataFrame:
    """``(conv_id, message_id, seq, kind, role, text)`` -> final ``(conv_id, message_id, position, role, text)``.

    Events of a message are taken by ``seq`` (ties: by kind's place in a message's life, then text);
    the text is what was said from the last reset on, the role the last one given, the position
    the first event's. Null texts are empty, unknown kinds append. Deleted messages go; a reset after
    the deletion brings a message back.
    """
    # every reset and deletion has a place in the order of its message's events
    rank = F.when(F.col("kind").isin(*RESETS), 0).when(F.col("kind") == "delete", 2).otherwise(1)
    order = F.struct(F.col("seq").alias("seq"), rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"))
    e = events.withColumn("order", order)
    message = Window.partitionBy("conv_id", "message_id")
    e = e.withColumn("reset", F.max(F.when(F.col("kind").isin(*RESETS), F.col("order"))).over(message))
    e = e.withColumn("gone", F.max(F.when(F.col("kind") == "delete", F.col("order"))).over(message))
    live = F.col("reset").isNull() | (F.col("order") >= F.col("reset"))
    said = F.sort_array(F.collect_list(F.when(live & (F.col("kind") != "delete"), F.col("order"))))
    folded = e.groupBy("conv_id", "message_id").agg(
        F.min("seq").alias("position"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("order", "role")))["role"].alias("role"),
        F.array_join(said["text"], "").alias("text"),
        F.max("reset").alias("reset"),
        F.max("gone").alias("gone"),
    )
    kept = F.col("gone").isNull() | F.coalesce(F.col("reset") > F.col("gone"), F.lit(False))
    return folded.where(kept).select("conv_id", "message_id", "position", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss)``: one row a conversation, ``loss`` spans of code points of assistant texts.

    Messages stand by position, then message id. A null role is the empty one. A conversation is one
    string, so it has to fit one row. No messages give no rows.
    """
    role = F.coalesce("role", F.lit(""))
    before, after = F.lit(OTHER[0]), F.lit(OTHER[2])
    before = F.concat(before, escape(role), F.lit(OTHER[1]))
    for name, (a, b) in MARKS.items():
        before, after = F.when(role == name, F.lit(a)).otherwise(before), F.when(role == name, F.lit(b)).otherwise(after)
    said = escape(F.coalesce("text", F.lit("")))
    m = messages.select("conv_id", "position", "message_id", role.alias("role"), before.alias("before"), said.alias("said"), after.alias("after"))
    m = m.withColumn("piece", F.concat("before", "said", "after"))
    earlier = Window.partitionBy("conv_id").orderBy("position", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0)) + F.length("before")
    m = m.withColumn("begin", begin).withColumn("end", F.col("begin") + F.length("said"))
    turns = F.sort_array(F.collect_list(F.struct("position", "message_id", "piece", "role", "begin", "end")))
    out = m.groupBy("conv_id").agg(turns.alias("turns"))
    spoken = F.filter("turns", lambda t: t["role"] == "assistant")
    return out.select(
        "conv_id",
        F.array_join("turns.piece", "").alias("formatted"),
        F.transform(spoken, lambda t: F.struct(t["begin"].alias("begin"), t["end"].alias("end"))).alias("loss"),
    )


_TURN = re.compile(
    r"<<SYS>> (?P<system>.*?) <</SYS>>|\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>"
    r"|\[TURN\](?P<role>.*?)\[SAYS\](?P<text>.*?)\[/TURN\]",
    re.DOTALL,
)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns ``(role, text)`` of a rendered conversation."""
    turns = []
    for m in _TURN.finditer(formatted):
        if m.lastgroup == "text":
            turns.append((unescape(m["role"]), unescape(m["text"])))
        else:
            turns.append((m.lastgroup, unescape(m[m.lastgroup])))
    return turns


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of each conversation, taken from its rendered string and its loss mask alone."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                turns = parse(text)
                learned = "".join(unescape(text[s["begin"] : s["end"]]) for s in loss)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), sha(whole), len(learned), sha(learned), len(text)))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}
            if rows:
                yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), **columns})

    kind = dict(rendered.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return arrow_map(rendered.select("conv_id", "formatted", "loss"), run, schema)


def events_of(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` as a log: each a message that begins empty, then its text.

    Rows stand by turn (ties: by role, then text); repeated rows are messages of their own.
    """
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    kinds = F.array(
        F.struct(F.lit(0).alias("step"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("says")),
        F.struct(F.lit(1).alias("step"), F.lit("delta").alias("kind"), F.coalesce("text", F.lit("")).alias("says")),
    )
    e = rows.withColumn("message_id", place).select("conv_id", "message_id", "role", F.explode(kinds).alias("e"))
    return e.select(
        "conv_id", "message_id", (F.col("message_id") * 2 + F.col("e.step")).alias("seq"), "e.kind", "role", F.col("e.says").alias("text")
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-1) whose texts are control strings, rendered and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    hard = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return read_back(render(fold(events_of(rows.unionByName(hard)))))


_ESCAPED = "replace(coalesce(text, ''), '\\', '\\\\')"
for _c in CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

OP7_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length({_ESCAPED}) + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
    ELSE 19 + length(role) END AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

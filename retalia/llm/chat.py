"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and
only that reply is trainable (``loss_start`` to ``loss_end``, in code points of ``text``).
Turns behind the last reply, and conversations without one, close with an example that has
no trainable part, so that the examples hold every turn and can be read back.

Template: ``<s>``, then a user turn as ``[INST] text [/INST]``, a reply as `` text</s>``, any
other role as ``[ROLE] role``, a line end, ``text [/ROLE]``.  Inside roles and texts a control
string gets a backslash behind its first character, and one that has backslashes there gets
one more; so no control string is left in a text, and taking one away restores it.

An example repeats its context, so a conversation's output grows with the square of its
turns.  Rows are sorted by conversation and turn and streamed: a task holds one context and
one batch of examples.  Examples of a long conversation are dealt over several tasks by the
characters they will write; each of these tasks gets the turns up to its last example.

Edge cases: a null text is empty; a null role is written as an empty one; rows without a turn
come last; rows with equal turns are all kept, ordered by role and text; rows without a
conversation form one conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retalia.llm.common import table

# The control strings of the template.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"]

_STUFF = r"(<(?=\\*/?s>)|\[(?=\\*/?(?:INST|ROLE)\]))"
_UNSTUFF = re.compile(r"(<(?=\\+/?s>)|\[(?=\\+/?(?:INST|ROLE)\]))\\")
_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|\[ROLE\] (.*?)\n(.*?) \[/ROLE\]| (.*?)</s>", re.S)

REPLY = "assistant"
TASK_CHARS = 64 << 20  # characters of examples that one task writes of one conversation
BATCH_CHARS = 8 << 20

_EXAMPLES = "conv_id long, example int, text string, loss_start long, loss_end long, turns int, whole boolean"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _STUFF, r"$1\\")


def unescape(text: str) -> str:
    return _UNSTUFF.sub(r"\1", text)


def render(role: Column, text: Column) -> Column:
    """One turn in the template."""
    text, role = escape(F.coalesce(text, F.lit(""))), F.coalesce(role, F.lit(""))
    return (
        F.when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
        .when(role == REPLY, F.concat(F.lit(" "), text, F.lit("</s>")))
        # The role ends at the first line end: one inside it is written as a backslash and an n.
        .otherwise(F.concat(F.lit("[ROLE] "), _one_line(escape(role)), F.lit("\n"), text, F.lit(" [/ROLE]")))
    )


def _one_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role(written: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], written))


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of an example."""
    if not text.startswith("<s>"):
        raise ValueError("an example starts with <s>")
    turns, at = [], 3
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        user, role, other, reply = found.groups()
        if user is not None:
            turns.append(("user", unescape(user)))
        elif reply is not None:
            turns.append((REPLY, unescape(reply)))
        else:
            turns.append((_role(role), unescape(other)))
        at = found.end()
    return turns


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns sorted by conversation, task group and place, to examples."""
    names = [f.split()[0] for f in _EXAMPLES.split(", ")]
    now, context, chars, out, size = None, [], 0, [], 0
    for pdf in batches:
        for conv, group, own, place, shown, reply, whole, example in pdf.itertuples(index=False):
            if now != (conv, group):
                now, context, chars = (conv, group), ["<s>"], 3
            context.append(shown)
            chars += len(shown)
            if own and example >= 0:
                loss = (chars - len(shown) + 1, chars - 4) if reply else (chars, chars)
                text = "".join(context)
                context = [text]
                out.append((conv, example, text, *loss, place, whole))
                size += chars
                if size > BATCH_CHARS:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=names)


def format_conversations(conversations: DataFrame, task_chars: int = TASK_CHARS) -> DataFrame:
    """Examples of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    Columns: conv_id, example (from 0), text, loss_start and loss_end (code points, equal
    when nothing is trainable), turns (how many the example holds), whole (it holds all).
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        "role",
        "text",
        render(F.col("role"), F.col("text")).alias("shown"),
        F.coalesce(F.col("role") == REPLY, F.lit(False)).alias("reply"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumns(
        {
            "place": F.row_number().over(order),
            "whole": F.lead(F.lit(1)).over(order).isNull(),
            "chars": F.sum(F.length("shown")).over(so_far),
            "replies": F.count(F.when(F.col("reply"), 1)).over(so_far),
        }
    ).drop("turn", "role", "text")
    target = F.col("reply") | F.col("whole")
    number = F.when(target, F.col("replies") - F.when(F.col("reply"), 1).otherwise(0)).otherwise(-1)
    placed = placed.withColumns({"example": number.cast("int"), "target": target})
    # A task group is a range of examples with about task_chars characters to write.
    by_place = Window.partitionBy("conv_id").orderBy("place")
    until = by_place.rowsBetween(Window.unboundedPreceding, 0)
    written = F.sum(F.when(F.col("target"), F.col("chars")).otherwise(0)).over(until)
    placed = placed.withColumn("range", F.floor(written / task_chars))
    next_ = F.coalesce(F.col("range") != F.lag("range").over(by_place), F.lit(False))
    placed = placed.withColumn("next", next_.cast("int")).withColumn("group", F.sum("next").over(until).cast("int"))
    placed = placed.withColumn("last", F.max("group").over(Window.partitionBy("conv_id")))
    dealt = placed.withColumn("to", F.explode(F.sequence("group", "last")))
    dealt = dealt.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_id"),
        "to",
        (F.col("to") == F.col("group")).alias("own"),
        "place",
        "shown",
        "reply",
        "whole",
        "example",
    )
    sorted_ = dealt.repartition("conv_id", "to").sortWithinPartitions("conv_id", "to", "place")
    schema = _EXAMPLES.replace("conv_id long", "conv_id string")  # pandas would turn longs beside a null into doubles
    out = sorted_.mapInPandas(_expand, schema)
    return out.withColumn("conv_id", F.nullif("conv_id", F.lit("")).cast("long"))


def _turns_of(texts: pd.Series) -> pd.DataFrame:
    """Number and digest of the turns that are read back from an example."""
    out = []
    for text in texts:
        parsed = parse(text) if text else []
        said = "".join(f"{role}\n{what}\n" for role, what in parsed)
        out.append((len(parsed), hashlib.sha256(said.encode()).hexdigest()))
    return pd.DataFrame(out, columns=["n_turns", "turns_sha256"])


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Read-back examples sorted by conversation, to one row for each; replies are hashed as they pass."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    row, sha = None, None
    for pdf in batches:
        out = []
        for conv, _, loss, chars, n, digest in pdf.itertuples(index=False):
            if row is None or row[0] != conv:
                if row is not None:
                    out.append((*row[:4], sha.hexdigest(), row[4]))
                row, sha = [conv, None, None, 0, 0], hashlib.sha256()
            sha.update(loss.encode())
            row[3] += len(loss)
            row[4] += chars
            if n > 0:
                row[1], row[2] = n, digest
        if out:
            yield pd.DataFrame(out, columns=names)
    if row is not None:
        yield pd.DataFrame([(*row[:4], sha.hexdigest(), row[4])], columns=names)


def digests(examples: DataFrame) -> DataFrame:
    """One row for each conversation, read back from the text of its examples."""
    turns_of = F.pandas_udf(_turns_of, "n_turns long, turns_sha256 string")
    masked = F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    read = examples.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_id"),
        "example",
        F.regexp_replace(masked, _UNSTUFF.pattern, "$1").alias("loss"),
        F.length("text").cast("long").alias("chars"),
        turns_of(F.when(F.col("whole"), F.col("text"))).alias("all"),
    ).select("conv_id", "example", "loss", "chars", "all.*")
    sorted_ = read.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return sorted_.mapInPandas(_digest, schema).withColumn("conv_id", F.nullif("conv_id", F.lit("")).cast("long"))


CONTROL_SAMPLE = "</s>[INST] ok [/INST]"  # what both turns of conversation -1 say


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(["user", REPLY])])
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.inline(both), F.lit(CONTROL_SAMPLE).alias("text")
    )
    return digests(format_conversations(given.unionByName(own)))


_STUFFED = r"""regexp_replace(regexp_replace({}, '<(\\*/?s>)', '<\\\1', 'g'),
            '\[(\\*/?(?:INST|ROLE)\])', '[\\\1', 'g')"""

CHAT_SQL = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{CONTROL_SAMPLE}'
    UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_SAMPLE}'
), sized AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS place,
        count(*) OVER (PARTITION BY conv_id) AS turns,
        length({_STUFFED.format('text')})
            + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5
               ELSE 16 + length(replace(replace({_STUFFED.format('role')}, '\\', '\\\\'), chr(10), '\\n')) END AS chars
    FROM given
), running AS (
    SELECT *, 3 + sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM sized
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (role = 'assistant' OR place = turns)::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
"""

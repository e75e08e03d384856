r"""Chat formatting with one training example for every assistant turn.

A turn is written as ``<|im_start|>role<|im_sep|>text<|im_end|>``; a conversation's
*stream* is its turns in order. Every assistant turn becomes an example of its own:
its text is the stream up to the end of that turn, all turns before it are the
context, and only the reply's text is under the loss mask, which is a span of code
points ``(loss_start, loss_end)`` in the text. Examples are written out whole, so they
take the square of a conversation's turns; they are cut from the stream where it has been
put together once, so what is shuffled stays in proportion to the input. A conversation
whose examples have more than ``PART_CHARS`` characters is put together in several tasks.

Inside roles and texts a backslash is doubled, and a control string gets a
backslash after its first character, so none of ``CONTROLS`` is left in them. Going
back, a pair of backslashes is one and a lone one goes.

Everything is SQL functions. A turn is formatted on its own row; places in the
stream are running totals over rows dealt by range, so a conversation with most of
the rows is spread over tasks. The examples and the digests of the query put a conversation's
text together (SHA-256 runs over the whole of it): it must fit one string (2 GB).

Defined results: a null role or text is empty. Turns come by turn (null first), rows
of one turn by role and SHA-256 of the text; repeated rows are turns of their own. Null
ids are one conversation. Turns after the last reply are in the stream and no
example. No rows: no stream, no examples. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import table, written
from importlens.operators.order import running

START, SEP, END, TRAINED = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "assistant"
#: Control strings of public chat templates that must not be read from a text.
CONTROLS = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_BREAK = r"([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)"
PART_CHARS = 1 << 26        # characters of one conversation's examples that one task writes
SAMPLE_ID, SAMPLE_TEXT = -1, "</s>[INST] ok [/INST]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _BREAK, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def stream(conversations: DataFrame) -> DataFrame:
    """Written rows ``(conv_id, position, formatted, loss_start, loss_end, stream_end)``, one a turn.

    Offsets are code points in the conversation's stream; ``loss_*`` are null unless an assistant speaks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), escaped(role), F.lit(SEP))
    rows = conversations.select(
        "conv_id", F.col("turn").alias("__turn"), role.alias("__role"), F.sha2(text, 256).alias("__key"),
        F.concat(head, escaped(text), F.lit(END)).alias("formatted"), F.length(head).alias("__head"))
    placed = running(rows.withColumn("__size", F.length("formatted")), ["__turn", "__role", "__key"], ["conv_id"],
                     totals={"stream_end": "__size"})
    trained = F.col("__role") == TRAINED
    return written(placed.select(
        "conv_id", "position", "formatted",
        F.when(trained, F.col("stream_end") - F.col("__size") + F.col("__head")).alias("loss_start"),
        F.when(trained, F.col("stream_end") - len(END)).alias("loss_end"), "stream_end"), "chat-stream")


def examples(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, context_turns, length, loss_start, loss_end, text)``: one whole example for every assistant turn.

    ``text`` is the first ``length`` code points of the conversation's stream; ``example`` is the reply's position and
    every turn before it is context.
    """
    ends = turns.where("loss_start is not null").groupBy(F.col("conv_id").alias("__conv")).agg(
        F.ceil(F.sum("stream_end") / PART_CHARS).cast("int").alias("__parts"))
    dealt = turns.join(ends.where("__parts > 1"), turns["conv_id"].eqNullSafe(F.col("__conv")), "left").withColumn(
        "__parts", F.coalesce("__parts", F.lit(1)))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"))
    row = F.struct("position", "formatted", "loss_start", "loss_end", "stream_end")
    whole = dealt.groupBy("conv_id", "__part", "__parts").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    replies = F.filter("rows", lambda r: r["loss_start"].isNotNull() & (F.pmod(r["position"], F.col("__parts")) == F.col("__part")))
    each = whole.select("conv_id", F.array_join("rows.formatted", "").alias("stream"), F.explode(replies).alias("r"))
    return each.select(
        "conv_id", F.col("r.position").alias("example"), (F.col("r.position") - 1).alias("context_turns"),
        F.col("r.stream_end").alias("length"), "r.loss_start", "r.loss_end",
        F.substring("stream", F.lit(1), F.col("r.stream_end").cast("int")).alias("text"))


def example_texts(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` examples, or their spans alone, with their whole ``text``."""
    own = chosen.withColumnsRenamed({"conv_id": "__conv"})
    pairs = own.join(turns.select("conv_id", "position", "formatted"),
                     own["__conv"].eqNullSafe(turns["conv_id"]) & (F.col("position") <= F.col("example")))
    text = F.array_join(F.array_sort(F.collect_list(F.struct("position", "formatted")))["formatted"], "")
    return pairs.groupBy(F.col("__conv").alias("conv_id"), "example", "context_turns", "length", "loss_start", "loss_end").agg(text.alias("text"))


def read_back(turns: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``(conv_id, position, part, role, text, trained, stream_end)`` read from the stream's rows and the examples.

    Roles and texts come from the marks; ``trained`` is what the example of the row has under its mask, cut out of the
    example's text by its span in ``found`` (``examples`` of the stream by default; null without one).
    """
    found = examples(turns) if found is None else found
    covered = F.substring("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    own = found.select(F.col("conv_id").alias("__conv"), F.col("example").alias("__example"), unescaped(covered).alias("covered"))
    rows = turns.join(own, turns["conv_id"].eqNullSafe(F.col("__conv")) & (turns["position"] == F.col("__example")), "left")
    parts = rows.select("conv_id", "position", "stream_end", "covered",
                        F.posexplode(F.split("formatted", F.lit(r"<\|im_end\|>"))).alias("part", "turn"))
    pieces = F.split("turn", F.lit(r"<\|im_sep\|>"))
    return parts.where(F.col("turn") != "").select(        # nothing is behind the last mark
        "conv_id", "position", "part", unescaped(F.substring(pieces[0], len(START) + 1, 2 ** 31 - 1)).alias("role"),
        unescaped(pieces[1]).alias("text"), F.when(F.col("part") == 0, F.col("covered")).alias("trained"), "stream_end")


def digests(turns: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """One row a conversation: its turns, their digest, the size and digest of what its examples train, and the stream's size."""
    said = F.concat(F.col("role"), F.lit("\n"), F.col("text"), F.lit("\n"))
    row = F.struct("position", "part", said.alias("said"), F.coalesce("trained", F.lit("")).alias("trained"))
    whole = read_back(turns, found).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.sum(F.length("trained")).alias("loss_chars"),
        F.max("stream_end").alias("formatted_chars"))
    text = {c: F.array_join(F.col(f"rows.{c}"), "") for c in ("said", "trained")}
    return whole.select("conv_id", F.size("rows").cast("long").alias("n_turns"), F.sha2(text["said"], 256).alias("turns_sha256"),
                        F.coalesce("loss_chars", F.lit(0)).cast("long").alias("loss_chars"),
                        F.sha2(text["trained"], 256).alias("loss_sha256"), "formatted_chars")


def with_sample(conversations: DataFrame) -> DataFrame:
    """``conversations`` and the sample one, whose two turns are control strings."""
    kinds = {f.name: f.dataType for f in conversations.schema.fields}
    rows = conversations.sparkSession.sql(
        f"SELECT * FROM VALUES ({SAMPLE_ID}, 0, 'user'), ({SAMPLE_ID}, 1, '{TRAINED}') AS t(conv_id, turn, role)")
    sample = rows.select(*[(F.lit(SAMPLE_TEXT) if c == "text" else F.col(c)).cast(kinds[c]).alias(c) for c in ("conv_id", "turn", "role", "text")])
    return conversations.select("conv_id", "turn", "role", "text").unionByName(sample)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted stream and the loss masks of its written examples."""
    turns = stream(with_sample(table(spark, sf_dir, "conversations")))
    return digests(turns, written(examples(turns), "chat-examples"))


_SQL_BREAK = _BREAK.replace("'", "''")


def _sql_escaped(c: str) -> str:
    return rf"regexp_replace(replace({c}, '\', '\\'), '{_SQL_BREAK}', '\1\\\2', 'g')"


ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT {SAMPLE_ID}, 0, 'user', '{SAMPLE_TEXT}'
  UNION ALL SELECT {SAMPLE_ID}, 1, '{TRAINED}', '{SAMPLE_TEXT}')
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text))) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = '{TRAINED}'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, sha256(text)) FILTER (WHERE role = '{TRAINED}'), '')) AS loss_sha256,
       CAST(SUM({len(START) + len(SEP) + len(END)} + length({_sql_escaped('role')}) + length({_sql_escaped('text')})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""

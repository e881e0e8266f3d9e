"""Chat formatting in Spark expressions: sort turn structs, merge neighbours, concatenate.

The template writes one block for each run of turns of one role::

    <turn:role>text<part/>text</turn>

``<`` begins a mark and nothing else: inside texts and roles it becomes ``\\l``, a backslash ``\\b``
and, in roles, ``>`` ``\\g``. Every escaped text therefore reads back exactly, whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
HEAD, PART, END = "<turn:", "<part/>", "</turn>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, n_blocks, formatted, loss``, one row for each conversation.

    Turns stand in the order of their number (null first), equal numbers in the order of role and
    text; repeated rows are turns of their own. A null role or text counts as empty; rows with a
    null conversation are one conversation. Neighbours of the same role share a block.

    ``loss`` is the loss mask as runs over the code points of ``formatted``: ``n`` code points that
    count or do not. Runs of marks and of texts alternate, a text for each turn between two runs
    of marks; what counts is the text of the assistant, without marks. Texts are escaped after they
    are sorted, since marks would change the order. A conversation is gathered because it is one row
    of the result; all steps over its turns take time in proportion to them.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"),
                 F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("turn"))
    ordered = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("turn")), lambda t: F.struct(
        _escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text"))).alias("turns"))
    ordered = ordered.withColumn("begins", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])))
    ends = F.concat(F.slice("begins", 2, F.size("begins")), F.array(F.size("turns")))
    blocks = ordered.select("conv_id", F.transform(
        F.arrays_zip(F.col("begins").alias("a"), ends.alias("b")),
        lambda s: F.struct(
            F.get("turns", s["a"])["role"].alias("role"),
            F.transform(F.slice("turns", s["a"] + 1, s["b"] - s["a"]),
                        lambda t: t["text"]).alias("texts"))).alias("blocks"))

    def merged(block: Column) -> Column:
        joined = F.aggregate(F.slice(block["texts"], 2, F.size(block["texts"])), F.get(block["texts"], F.lit(0)),
                             lambda whole, text: F.concat(whole, F.lit(PART), text))
        return F.concat(F.lit(HEAD), block["role"], F.lit(">"), joined, F.lit(END))

    def run(n: Column, loss: Column) -> Column:
        return F.struct(n.cast("long").alias("n"), loss.alias("loss"))

    def mask(block: Column, at: Column) -> Column:
        head = F.length(block["role"]) + len(HEAD + ">") + F.when(at == 0, 0).otherwise(len(END))
        return F.flatten(F.transform(block["texts"], lambda text, i: F.array(
            run(F.when(i == 0, head).otherwise(len(PART)), F.lit(False)),
            run(F.length(text), block["role"] == LOSS_ROLE))))

    return blocks.select(
        "conv_id", F.size("blocks").cast("long").alias("n_blocks"),
        F.array_join(F.transform("blocks", merged), "").alias("formatted"),
        F.concat(F.flatten(F.transform("blocks", mask)),
                 F.array(run(F.lit(len(END)), F.lit(False)))).alias("loss"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text, formatted`` as the formatted text and its mask alone give them.

    ``turns`` are structs of role and text, one for each turn that was formatted. ``loss_text`` is
    the text under the mask, unescaped.
    """
    blocks = formatted.select("conv_id", "formatted", "loss", F.transform(
        F.filter(F.split("formatted", END), lambda block: block != ""),
        lambda block: F.struct(
            F.substr(F.substring_index(block, ">", 1), F.lit(len(HEAD) + 1)).alias("role"),
            F.split(F.substr(block, F.instr(block, ">") + 1), PART).alias("texts"))).alias("blocks"))
    texts = F.flatten(F.transform("blocks", lambda block: block["texts"]))
    runs = F.filter("loss", lambda run, i: i % 2 == 1)
    under = F.filter(F.arrays_zip(texts.alias("text"), runs.alias("run")), lambda z: z["run"]["loss"])
    return blocks.select(
        "conv_id",
        F.flatten(F.transform("blocks", lambda block: F.transform(block["texts"], lambda text: F.struct(
            unescape(block["role"]).alias("role"), unescape(text).alias("text"))))).alias("turns"),
        F.array_join(F.transform(under, lambda z: unescape(
            F.substr(z["text"], F.lit(1), z["run"]["n"].cast("int")))), "").alias("loss_text"),
        "formatted")


def with_control_case(turns: DataFrame) -> DataFrame:
    """``turns`` and a conversation -7 whose texts look like control strings."""
    text = r"\### Assistant: </turn> ok"
    spark = turns.sparkSession
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of what reads back."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_chats(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: Blocks open where the role differs from the turn before; marks are the template's.
SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
         replace(replace(text, '\', '\b'), '<', '\l') AS written,
         replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g') AS head
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(written) + CASE WHEN opens THEN length(head) + 14 ELSE 7 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

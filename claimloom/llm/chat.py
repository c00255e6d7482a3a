"""Chat formatting by prefix-target expansion, in DataFrame operations only.

A conversation is written turn by turn as <|turn|>role<|text|>text<|end|>. Control strings in roles and texts get one backslash
behind their first character, and one more if they have some already, so that no text can forge a marker and every text can be read back.

Every assistant turn becomes an example: all turns before it are its context, and only its own text is trainable. expand() gives the pieces that each example adds to the one
before, as all examples of a conversation are prefixes of one string; with_context() writes the examples out. Turns after the last reply form a row without a
target, so that nothing is lost. read_back() takes turns and trainable texts from the written examples.

Null texts and roles count as empty; turns are ordered by (turn, role, text), nulls first; repeated rows are turns of their own; rows without
conv_id form one conversation; empty tables give none; other columns play no part. A conversation is formatted in one task, and its examples add up to the square of its turns: that
is what the expansion is. Where it isn't wanted, expand()'s pieces hold each turn once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What begins like a marker of this or another well-known template: its first character, backslashes, the rest.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2$3"))


def expand(turns: DataFrame) -> DataFrame:
    """(conv_id, example, piece, prefix_chars, target_start, target_chars): one row for each assistant turn, in order from 0, and one without target for what
    follows the last. Offsets count code points; target_start is within piece."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    body = escaped(F.col("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reply = F.col("role") == "assistant"
    rows = rows.withColumn("example", F.coalesce(F.sum(reply.cast("long")).over(before), F.lit(0).cast("long"))).withColumn("at", F.row_number().over(order))
    rows = rows.select("conv_id", "example", "at", reply.alias("reply"), F.concat(head, body, F.lit(END)).alias("segment"), F.length(body).alias("chars"))
    each = rows.groupBy("conv_id", "example").agg(F.sort_array(F.collect_list(F.struct("at", "segment"))).alias("s"), F.max(F.when(F.col("reply"), F.col("chars"))).cast("long").alias("target_chars"))
    piece = F.array_join(F.col("s.segment"), "")
    each = each.select("conv_id", "example", piece.alias("piece"), "target_chars").withColumn("chars", F.length("piece").cast("long"))
    ahead = Window.partitionBy("conv_id").orderBy("example").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("chars") - len(END) - F.col("target_chars")
    return each.select("conv_id", "example", "piece", F.coalesce(F.sum("chars").over(ahead), F.lit(0).cast("long")).alias("prefix_chars"), start.alias("target_start"), "target_chars")


def with_context(pieces: DataFrame) -> DataFrame:
    """(conv_id, example, text, target_start, target_chars): each example with its whole context written out; and, where turns follow the last reply, the whole conversation without a target."""
    so_far = Window.partitionBy("conv_id").orderBy("example").rowsBetween(Window.unboundedPreceding, 0)
    text = F.array_join(F.collect_list("piece").over(so_far), "")
    return pieces.select("conv_id", "example", text.alias("text"), (F.col("prefix_chars") + F.col("target_start")).alias("target_start"), "target_chars")


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, turns, targets, formatted_chars, n_examples, example_chars): from written examples, the turns (role, text) of the longest, the texts under the loss masks in order, the length of the
    formatted conversation, and how many examples there are with how many code points together."""
    mine = F.col("target_chars").isNotNull()
    masked = F.when(mine, unescaped(F.substring("text", F.col("target_start") + 1, F.col("target_chars"))))

    def parsed(x: Column) -> Column:
        inner = F.substring_index(x, END, 1)
        return F.struct(unescaped(F.substring_index(inner, TEXT, 1)).alias("role"), unescaped(F.substring_index(inner, TEXT, -1)).alias("text"))

    rows = examples.select("conv_id", "example", "text", masked.alias("target"), F.length("text").cast("long").alias("n"), mine.alias("mine"))
    out = rows.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"), F.sort_array(F.collect_list(F.struct("example", "target"))).alias("e"), F.max("n").alias("formatted_chars"),
        F.count_if("mine").alias("n_examples"), F.coalesce(F.sum(F.when(F.col("mine"), F.col("n"))), F.lit(0)).alias("example_chars"),
    )
    turns = F.transform(F.slice(F.split("whole", r"<\|turn\|>"), 2, 1 << 30), parsed)
    return out.select("conv_id", turns.alias("turns"), F.filter("e.target", lambda x: x.isNotNull()).alias("targets"), "formatted_chars", "n_examples", "example_chars")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; and n_examples, example_chars; conversation -7 is added."""
    said = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(0, 2, 1, 1).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), said.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(own)
    back = read_back(with_context(expand(turns)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("targets", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", "n_examples", "example_chars")


#: In this SQL, the escapes add one code point to each control string.
ORACLE = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, 23 + length(role) + length(text) + len(regexp_extract_all(role, '[<\[]\\*(\||/?s>|/?INST\]|</?SYS>>)')) + len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\]|</?SYS>>)')) AS n FROM t),
c AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS so_far FROM f)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars, count(*) FILTER (WHERE role = 'assistant') AS n_examples, CAST(sum(CASE WHEN role = 'assistant' THEN so_far ELSE 0 END) AS BIGINT) AS example_chars
FROM c GROUP BY conv_id
"""

"""Chat formatting: snapshots of conversations that a longer one starts with are dropped before rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What a turn is rendered as; {role} and {text} are replaced.
TURN_TEMPLATE = "<|{role}|>\n{text}\n<|end|>\n"


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, n, prefix) for each turn of (conv_id, turn, role, text): the hash of the conversation's first n turns.

    The hash rolls: each turn adds the digest of its place, role and text, split into sixteen 16-bit limbs whose running
    sums are kept apart (no carries, no overflow before 2**47 turns), so one window makes all prefixes of a
    conversation without gathering its texts. Turns are ordered by (turn, role, text), nulls first; repeated rows are
    turns of their own. A null role or text differs from an empty one.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order)
    part = lambda c: F.coalesce(F.concat(F.lit("s"), F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("n"))
    digest = F.sha2(F.concat_ws("|", F.col("n").cast("string"), part("role"), part("text")).cast("binary"), 256)
    numbered = turns.select("conv_id", "turn", "role", "text", place.alias("n")).withColumn("digest", digest).drop("role", "text", "turn")
    running = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    limbs = [F.sum(F.conv(F.substring("digest", 1 + 4 * k, 4), 16, 10).cast("long")).over(running) for k in range(16)]
    summed = numbered.select("conv_id", "n", *[x.alias(f"l{k}") for k, x in enumerate(limbs)])
    return summed.select("conv_id", F.col("n").cast("long").alias("n"), F.sha2(F.concat_ws(",", *[F.col(f"l{k}").cast("string") for k in range(16)]).cast("binary"), 256).alias("prefix"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that no other starts with, one (the smallest id) of equal ones.

    Conversations are compared by the hash of all their turns. Equal ones are counted in the aggregate that keeps the
    smallest id, and prefixes are made distinct (partially before the shuffle) before the anti-join, so a first turn
    or a conversation that a third of all rows share is one row there.
    """
    prefixes = prefix_hashes(turns)
    last = Window.partitionBy("conv_id")
    marked = prefixes.withColumn("n_turns", F.max("n").over(last))
    whole = marked.where("n = n_turns").groupBy("prefix").agg(F.min("conv_id").alias("conv_id"), F.max("n_turns").alias("n_turns"), F.count(F.lit(1)).alias("n_copies"))
    inner = marked.where("n < n_turns").select("prefix").distinct()
    return whole.join(inner, "prefix", "left_anti").select("conv_id", "n_turns", "n_copies")


def collapse_and_render(conversations: DataFrame, *, template: str = TURN_TEMPLATE) -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered) of the maximal conversations of (conv_id, turn, role, text).

    Rows with a null conv_id belong to no conversation and are left out. A null role or text is rendered empty. Other
    columns take no part; an empty table gives no row. Only the texts of conversations that stay are gathered, each
    conversation's by itself.
    """
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    kept = maximal_conversations(turns)
    head, _, rest = template.partition("{role}")
    middle, _, tail = rest.partition("{text}")
    empty = F.lit("")
    one = lambda x: F.concat(F.lit(head), F.coalesce(x["role"], empty), F.lit(middle), F.coalesce(x["text"], empty), F.lit(tail))
    gathered = (
        turns.join(kept, "conv_id")
        .groupBy("conv_id", "n_turns", "n_copies")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("all"))
    )
    return gathered.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("all", one), "").alias("rendered"))

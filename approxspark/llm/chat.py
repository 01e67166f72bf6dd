"""Operator 7: chat formatting after collapsing cumulative snapshots.

Logs often hold a conversation again each time that it grew. Each turn gets the rolling hash of the
turns up to it (the exclusive or of its turns' hashes, which know their position; 128 bits, so the
window needs no arrays). A conversation whose last hash is a longer one's hash at an earlier turn is a
prefix of it; an anti-join leaves the maximal ones, equal ones leave the smallest id, and only these
are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn in the chat template; a text's own marks can't open or close a turn."""
    clean = lambda c, other: F.replace(F.coalesce(c, F.lit(other)), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), clean(role, "unknown"), F.lit("\n"), clean(text, ""), F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_copies (equal conversations, itself included), chat.

    Turns are ordered by turn, then role and text (nulls first); a turn given twice counts twice. A
    conversation is a prefix of another when its turns' roles and texts equal the other's first ones;
    a null differs from the empty text. A turn without a conversation id is a conversation of its own,
    returned with a null id. Null roles are rendered as ``unknown``, null texts as empty. An empty table
    gives no rows; other columns are not read.
    """
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    # a null id stands for as many conversations as it has different turns
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text", F.isnull("role"), F.isnull("text")))
    rows = rows.withColumn("alone", alone)
    key = ["conv_id", "alone"]
    order = Window.partitionBy(*key).orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    placed = rows.withColumn("pos", F.row_number().over(order))
    facts = [F.col("pos"), F.col("role"), F.col("text"), F.isnull("role"), F.isnull("text")]
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashes = placed.select(*key, "turn", "role", "text", "pos", F.xxhash64(F.lit(1), *facts).alias("a"), F.xxhash64(F.lit(2), *facts[::-1]).alias("b"))
    prefixes = hashes.select(*key, "pos", F.lead("pos").over(order).isNull().alias("last"), F.bit_xor("a").over(upto).alias("a"), F.bit_xor("b").over(upto).alias("b"))
    prefixes, _ = store(prefixes, "prefixes")
    # copies meet, and common prefixes are told once, before anything is joined
    full = prefixes.where("last").groupBy("pos", "a", "b").agg(F.min(F.struct(*key)).alias("k"), F.count(F.lit(1)).alias("n_copies"))
    proper = prefixes.where("NOT last").select("pos", "a", "b").distinct()
    kept = full.join(proper, ["pos", "a", "b"], "left_anti").select("k.*", F.col("pos").cast("long").alias("n_turns"), "n_copies")
    kept, _ = store(kept, "maximal")
    name = lambda df: df.withColumn("id", F.to_json(F.struct(*key)))  # noqa: E731  nulls compare as text
    chats = name(placed.select(*key, "pos", rendered_turn(F.col("role"), F.col("text")).alias("said"))).join(name(kept).select("id"), "id", "left_semi")
    chats = chats.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "said"))), lambda t: t["said"]), "").alias("chat"))
    return name(kept).join(chats, "id").select("conv_id", "n_turns", "n_copies", "chat")

"""Chat formatting: logged snapshots of conversations collapse to the longest ones, which are rendered.

A chat client that logs the whole conversation after every turn leaves rows of many conversations of which one opens
the next.  A rolling hash of every opening of every conversation identifies them: a conversation whose whole
sequence of turns is also a shorter opening of another one goes, and of equal conversations the one with the smallest id stays.
The rolling hash adds (by exclusive or) a hash of each turn and its place to that of the turns before; two
such hashes with different seeds, 128 bits together with the length, stand for the sequence.

Only DataFrame functions are used.  Turns are made distinct on the map side and ordered by range, so that a conversation with
many of the rows is spread over tasks; only the rendered string of a conversation is one row.  Texts are shuffled
once, for the conversations that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.shared import pick, stored

# The marks of the rendered form.
OPEN, SHUT, END = "<|", "|>", "<|end|>"
UNKNOWN_ROLE = "unknown"
#: What tells the turns of a conversation apart, in their order.
TURN = ("turn", "role", "h1", "h2")


def _turn_hash(seed: str) -> Column:
    """Hash of role and text in which a null differs from an empty string."""
    parts = [F.lit(seed), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return F.xxhash64(*parts)


def _turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    told = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv_id is not null")
    return told.withColumn("h1", _turn_hash("first")).withColumn("h2", _turn_hash("second"))


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, h1, h2, chunk, place, n: the different turns and their places, in conversations of ``n`` turns.

    The turns of all conversations are dealt to chunks by range, so that a chunk holds a bounded stretch of a long one; places within
    chunks and the totals of the chunks before give those in the conversation.  Chunks are cut by a sample, hence written.
    """
    order = [F.asc_nulls_first(c) for c in ("turn", "role", "tied_text", "h1", "h2")]
    narrow = _with_tied_texts(turns)
    chunks = stored(narrow.repartitionByRange(F.asc("conv_id"), *order).withColumn("chunk", F.spark_partition_id()), "chunks")
    within = Window.partitionBy("chunk", "conv_id").orderBy(*order)
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = chunks.groupBy("chunk", "conv_id").agg(F.count("*").alias("size")).select(
        "chunk", "conv_id", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"), F.sum("size").over(whole).alias("n")
    )
    numbered = chunks.withColumn("at", F.row_number().over(within)).join(sizes, ["chunk", "conv_id"])
    return stored(numbered.select("conv_id", *TURN, "chunk", (F.col("ahead") + F.col("at")).alias("place"), "n"), "placed")


def _with_tied_texts(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, h1, h2 of the different turns, and the text of those whose number and role several turns have."""
    narrow = turns.select("conv_id", *TURN).distinct()
    place = ["conv_id", "turn", "role"]
    several = narrow.groupBy(*place).count().where("count > 1").select(*(F.col(c).alias(f"tied_{c}") for c in place))
    same = [F.col(c).eqNullSafe(F.col(f"tied_{c}")) for c in place]
    tied = turns.join(several, same, "left_semi").groupBy("conv_id", *TURN).agg(F.min("text").alias("tied_text"))
    alone = narrow.join(several, same, "left_anti").withColumn("tied_text", F.lit(None).cast("string"))
    return alone.unionByName(tied)


def openings(turns: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """conv_id, n, place, p1, p2: the rolling hashes of every opening of a conversation of ``n`` turns."""
    hashed = (placed(turns) if places is None else places).select(
        "conv_id", "chunk", "n", "place",
        F.xxhash64("place", "h1", "h2").alias("x1"), F.xxhash64("h2", "place", "h1").alias("x2"),
    )
    so_far = Window.partitionBy("chunk", "conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = hashed.groupBy("chunk", "conv_id").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
    ahead = totals.select(
        "chunk", "conv_id", *(F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(t) for t in ("t1", "t2"))
    )
    rolled = hashed.select("*", *(F.bit_xor(x).over(so_far).alias(p) for x, p in (("x1", "p1"), ("x2", "p2"))))
    return rolled.join(ahead, ["chunk", "conv_id"]).select(
        "conv_id", "n", "place", F.col("p1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("t2")).alias("p2")
    )


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that open no longer one; the smallest id of equal ones."""
    key = ["place", "p1", "p2"]
    whole = rolled.where("place = n").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = rolled.where("place < n").select(*key).distinct()
    return whole.join(inner, key, "left_anti").select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies")


def _shown(role: Column, text: Column) -> Column:
    """A turn between marks; marks within a text are broken up."""
    safe = lambda x: F.replace(x, F.lit(OPEN), F.lit("< |"))
    return F.concat(
        F.lit(OPEN), safe(F.coalesce(role, F.lit(UNKNOWN_ROLE))), F.lit(SHUT + "\n"),
        safe(F.coalesce(text, F.lit(""))), F.lit(END),
    )


def render(turns: DataFrame) -> DataFrame:
    """conv_id, rendered: the turns of each conversation, in order, as one string, so that a row holds the whole conversation."""
    ordered = F.sort_array(F.collect_set(F.struct("turn", "role", "text")))
    whole = F.array_join(F.transform(ordered, lambda t: _shown(t["role"], t["text"])), "\n")
    return turns.groupBy("conv_id").agg(whole.alias("rendered"))


def render_turns(turns: DataFrame, places: DataFrame) -> DataFrame:
    """conv_id, place, rendered: a row for each different turn.

    Repeated turns are combined on the map side and meet their place by all that tells them apart, so no task gets a conversation.
    """
    told = turns.select("conv_id", *TURN, "text", F.lit(True).alias("told"), F.lit(None).cast("long").alias("place"))
    ranks = places.select("conv_id", *TURN, F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("told"), "place")
    met = told.unionByName(ranks).groupBy("conv_id", *TURN).agg(*(F.max(x).alias(x) for x in ("text", "told", "place")))
    return met.where("told").select("conv_id", "place", _shown(F.col("role"), F.col("text")).alias("rendered"))


def _kept(told: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The places of all turns, and the maximal conversations."""
    places = placed(told)
    return places, stored(maximal(stored(openings(told, places), "openings")), "maximal")


def format_chats(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_copies (equal conversations, itself included), rendered.

    Turns are ordered by number, role and text, nulls first; a row that repeats conversation, number, role and text
    counts once; numbers need not be consecutive and do not matter beyond their order.  A null text renders as empty and a null
    role as ``unknown``, yet neither equals an empty one when conversations are compared.  Rows without a conversation
    id are passed over; an empty table gives no rows; other columns are ignored.
    """
    told = _turns(turns, conv_col, turn_col, role_col, text_col)
    kept = _kept(told)[1]
    shown = render(told.join(kept.select("conv_id"), "conv_id", "left_semi"))
    return kept.join(shown, "conv_id")


def format_turns(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn of the maximal conversations: conv_id, place (from 1), rendered; for conversations too long for one string.

    Joined by line feeds in order of their places they are what ``format_chats`` gives, by the same rules.
    """
    told = _turns(turns, conv_col, turn_col, role_col, text_col)
    places, kept = _kept(told)
    return render_turns(told.join(kept.select("conv_id"), "conv_id", "left_semi"), places)

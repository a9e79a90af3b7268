"""Chat formatting from every participant's perspective, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.llm.numbering import in_order
from tickspark.session import stage

# Markers of the rendered form.
START, END = "<|im_start|>", "<|im_end|>\n"
# Roles that give instructions: rendered under their own name, never as a perspective.
SYSTEM = ("system",)
# Turns of one rendered part.
TURNS = 256


def rotate(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    system: tuple[str, ...] = SYSTEM,
    turns: int = TURNS,
) -> DataFrame:
    """One row per conversation, part and participant: ``conv_id``, ``part``, ``perspective``,
    ``n_turns``, ``rendered``, ``n_chars``, ``mask_starts``, ``mask_lengths``, ``n_target``.

    Participants are the distinct roles but those of ``system``. In a rendering the
    perspective speaks as ``assistant``, all others as ``user name=<role>``, and system turns
    under their own name. The mask lists the character spans to learn from: the assistant's
    texts with the closing marker.

    The turns of a conversation, in the order of turn, role and text, are rendered in parts of
    ``turns`` turns, so that one of any length is spread over many rows and tasks; most have
    the single part 0. A perspective appears in every part, also where it is silent. Every part
    but the first starts with the conversation's first system turn before it and, if that is
    another one, its latest, so that it does not lack its instructions; they count in
    ``n_turns``, which is thus ``turns`` + 2 at most.

    Repeated turns stay. A null turn comes first; a null role is the participant ``unknown``; a
    null text is empty; rows of a null conversation form one conversation. Conversations of
    system turns only give no rows, nor does an empty table. Other columns are left aside.
    """
    names = F.coalesce(F.col(role).cast("string"), F.lit("unknown"))
    conv = F.col(conversation)
    rows = df.select(
        conv.alias("conv_id"),
        # The conversation as a text that is never null.
        F.when(conv.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), conv.cast("string"))).alias("tree"),
        F.col(turn).cast("long").alias("turn"),
        names.alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    speakers = rows.filter(~F.col("role").isin(*system)).select("conv_id", F.col("role").alias("perspective")).distinct()
    parts = _parts(rows, system, turns)
    speakers = speakers.withColumnRenamed("conv_id", "own")
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("own")))

    def head(m: Column) -> Column:
        as_system = F.concat(F.lit(START), m["role"], F.lit("\n"))
        as_user = F.concat(F.lit(f"{START}user name="), m["role"], F.lit("\n"))
        name = F.when(m["role"] == F.col("perspective"), F.lit(f"{START}assistant\n"))
        return name.when(m["role"].isin(*system), as_system).otherwise(as_user)

    def render(m: Column) -> Column:
        return F.struct(
            head(m).alias("head"),
            F.concat(m["text"], F.lit(END)).alias("body"),
            (m["role"] == F.col("perspective")).alias("target"),
        )

    seen = seen.withColumn("shown", F.transform("turns", render))
    # Positions: where each message's body starts, carried over the messages of the part.
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["head"])
        size = F.length(m["body"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        spans = F.when(m["target"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((start + size).alias("at"), spans.alias("spans"))

    seen = seen.withColumn("mask", F.aggregate("shown", nothing, step))
    rendered = F.array_join(F.transform("shown", lambda m: F.concat(m["head"], m["body"])), "")
    lengths = F.transform("mask.spans", lambda s: s["length"])
    return seen.select(
        "conv_id",
        "part",
        "perspective",
        F.size("turns").alias("n_turns"),
        rendered.alias("rendered"),
        F.col("mask.at").alias("n_chars"),
        F.transform("mask.spans", lambda s: s["start"]).alias("mask_starts"),
        lengths.alias("mask_lengths"),
        F.aggregate(lengths, F.lit(0), lambda a, x: a + x).alias("n_target"),
    )


def _parts(rows: DataFrame, system: tuple[str, ...], turns: int) -> DataFrame:
    """(conv_id, part, turns): the turns of each part, with what later parts repeat before them.

    Conversations of one part need no numbers. The others' turns are numbered in ranges of
    their order, so that one of any number of turns is handled by many tasks.
    """
    turn = F.struct("turn", "role", "text")
    listed = F.sort_array(F.collect_list(turn)).alias("turns")
    long = stage(rows.groupBy("tree").count().filter(F.col("count") > turns).select("tree"))
    if not long.limit(1).count():
        return rows.groupBy("conv_id").agg(listed).select("conv_id", F.lit(0).cast("long").alias("part"), "turns")
    short = rows.join(long, "tree", "left_anti").groupBy("conv_id").agg(listed)
    short = short.select("conv_id", F.lit(0).cast("long").alias("part"), "turns")

    crowded = rows.join(long, "tree", "left_semi").withColumn("tie", F.monotonically_increasing_id())
    # Written once, so that the numbers of equal turns stay the same.
    crowded = stage(in_order(stage(crowded), ["turn", "role", "text", "tie"]).drop("tie", "n"))
    crowded = crowded.withColumn("part", F.floor(F.col("i") / turns).cast("long"))
    own = crowded.groupBy("conv_id", "tree", "part").agg(listed)
    told = F.when(F.col("role").isin(*system), F.struct("i", "turn", "role", "text"))
    # One row per part, with its first and last system turn.
    told = crowded.groupBy("tree", "part").agg(F.min(told).alias("first"), F.max(told).alias("last"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    told = told.select("tree", "part", F.min("first").over(earlier).alias("first"), F.max("last").over(earlier).alias("last"))

    def again(name: str) -> Column:
        return F.struct(*[F.col(f"{name}.{c}").alias(c) for c in ("turn", "role", "text")])

    other = F.col("first.i") != F.col("last.i")
    head = F.when(other, F.array(again("first"), again("last"))).when(F.col("first").isNotNull(), F.array(again("first")))
    own = own.join(told.select("tree", "part", head.alias("head")), ["tree", "part"])
    whole = F.when(F.col("head").isNull(), F.col("turns")).otherwise(F.concat("head", "turns"))
    return short.unionByName(own.select("conv_id", "part", whole.alias("turns")))

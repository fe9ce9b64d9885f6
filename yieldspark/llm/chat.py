"""Chat formatting from every participant's point of view.

Each speaker of a conversation but the system is in turn the assistant; the
others are users under their names, and the mask covers what the assistant
says (its end mark included). Conversations are laid out in parts of
``TURNS`` consecutive turn numbers, and a part's rows, in the order of turn,
speaker and text, in stretches of ``MAX_ROWS``: ``sub`` is the position of a row
in its part div ``MAX_ROWS``. A stretch is one row per participant, so a
conversation of any length is many bounded rows, never one, and their texts in
the order of part and sub are all of it. So that no stretch loses the
instructions, the conversation's first system turn is repeated at the head of
every stretch behind it (``n_turns`` counts the stretch's own rows).

Plan: a count of rows per part (no texts move); parts of at most ``MAX_ROWS``
are gathered as they are. The rows of longer ones are first counted, equal
ones together before the shuffle, then dealt out by ranges of their order and
numbered there, so a hot part or a row repeated very often is spread over
tasks; a row that is repeated lies in as many stretches as it fills. Parts and
participants are joined by conversation, whose hot keys Spark may split. Only
DataFrame functions.

Defined cases: equal rows (conversation, turn, speaker, text) all count; rows
of the same turn are ordered by speaker, then text; a NULL turn comes before
all others; a NULL speaker is named ``unknown``; a NULL text is empty; NULL
conversation ids are one conversation; a conversation of the system alone has
no participant and no row; control marks inside a text are broken by a space,
line breaks in a name by ``_``; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let, running_sums

#: Turn numbers per part (a power of two), turns per row of a part.
TURNS, MAX_ROWS = 256, 4096
#: Characters of a text by which ranges are chosen: the bounds are sampled on the driver.
RANGE_CHARS = 256
SYSTEM = ("system",)


def cleaned(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, speaker, text."""
    return turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.regexp_replace(F.coalesce(F.col(role).cast("string"), F.lit("unknown")), r"[\r\n]", "_").alias("speaker"),
        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))


def parts(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """conv_id, part, sub, turns: the ordered turns (array<struct<turn, speaker, text>>) of each part."""
    d = cleaned(turns, conv_id, turn, role, text)
    d = d.withColumn("part", F.shiftright("turn", TURNS.bit_length() - 1).cast("long"))
    crowded = cut(d.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MAX_ROWS)
                  .select(F.col("conv_id").alias("c"), F.col("part").alias("p")), "crowded")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("part").eqNullSafe(F.col("p"))
    whole = d.join(crowded, same, "left_anti").withColumns({"sub": F.lit(0).cast("long"), "n": F.lit(1).cast("long")})
    rows = F.sort_array(F.collect_list(F.struct("turn", "speaker", "text", "n")))
    one = F.flatten(F.transform(rows, lambda x: F.array_repeat(F.struct(
        x["turn"].alias("turn"), x["speaker"].alias("speaker"), x["text"].alias("text")), x["n"].cast("int"))))
    return whole.unionByName(numbered(d.join(crowded, same, "left_semi"))).groupBy("conv_id", "part", "sub").agg(one.alias("turns"))


def numbered(d: DataFrame) -> DataFrame:
    """The different rows of ``d`` for each stretch (``sub``) that they reach into, with their number there (``n``)."""
    order = ["conv_id", "part", "turn", "speaker"]
    d = d.groupBy(*order, "text").agg(F.count(F.lit(1)).alias("n"))
    # Written once, since a second run would choose other ranges. The number is the task and the place in its sorted range.
    rows = cut(d.repartitionByRange(*order, F.substring("text", 1, RANGE_CHARS))
               .sortWithinPartitions(*order, "text").withColumn("at", F.monotonically_increasing_id()), "turns")
    rows = rows.withColumn("chunk", F.shiftright("at", 33))
    chunks = rows.groupBy("conv_id", "part", "chunk").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id", "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("chunk").alias("k"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # A chunk is a task's range of one part, so this window is as even as the ranges.
    upto = Window.partitionBy("conv_id", "part", "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("n").over(upto))
    j = rows.join(chunks, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("part").eqNullSafe(F.col("p"))
                  & (F.col("chunk") == F.col("k")))
    end = F.col("before") + F.col("upto")
    j = j.withColumns({"first": end - F.col("n"), "end": end})
    j = j.withColumn("sub", F.explode(F.sequence(F.floor(F.col("first") / MAX_ROWS), F.floor((F.col("end") - 1) / MAX_ROWS))))
    here = F.least("end", (F.col("sub") + 1) * MAX_ROWS) - F.greatest("first", F.col("sub") * MAX_ROWS)
    return j.select("conv_id", "turn", "speaker", "text", "part", "sub", here.alias("n"))


def participants(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """(conv_id, perspective, preamble): the speakers of each conversation without the system, and its first system turn."""
    d = cleaned(turns, conv_id, turn, role, text)
    who = d.select("conv_id", F.col("speaker").alias("perspective")).where(~F.col("perspective").isin(list(system))).distinct()
    first = d.where(F.col("speaker").isin(list(system))).groupBy(F.col("conv_id").alias("c")).agg(
        F.min(F.struct("turn", "speaker", "text")).alias("preamble"))
    return who.join(first, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")


def head(speaker: Column, perspective: Column, system: tuple[str, ...] = SYSTEM) -> Column:
    return F.when(speaker == perspective, F.lit("<|im_start|>assistant\n")).when(
        speaker.isin(list(system)), F.concat(F.lit("<|im_start|>"), speaker, F.lit("\n"))).otherwise(
        F.concat(F.lit("<|im_start|>user name="), speaker, F.lit("\n")))


END = "<|im_end|>\n"


def render(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """A row per part and participant: conv_id, perspective, part, sub, n_turns, text, mask.

    mask: array<struct<start, end>>, the assistant's texts with their end marks, in code points of ``text``.
    """
    p = parts(turns, conv_id, turn, role, text)
    who = participants(turns, conv_id, turn, role, text, system).withColumnRenamed("conv_id", "c")
    j = p.join(who, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    me, pre = F.col("perspective"), F.col("preamble")
    # A stretch that begins behind the first system turn repeats it.
    lead = F.when(F.get("turns", F.lit(0)) > pre, F.concat(head(pre["speaker"], me, system), pre["text"], F.lit(END))).otherwise("")
    j = j.withColumn("lead", F.coalesce(lead, F.lit("")))

    def laid_out(h: Column) -> Column:
        """From heads: the text and the spans of the assistant's bodies."""
        bodies = F.transform("turns", lambda t: F.concat(t["text"], F.lit(END)))
        segments = F.zip_with(h, bodies, lambda a, b: F.concat(a, b))
        ends = running_sums(F.transform(segments, lambda s: F.length(s)))
        spans = F.zip_with(ends, F.zip_with("turns", bodies, lambda t, b: F.struct(
            (t["speaker"] == me).alias("mine"), F.length(b).alias("n"))), lambda e, x: F.struct(
                (e - x["n"]).alias("start"), e.alias("end"), x["mine"].alias("mine")))
        mine = F.transform(F.filter(spans, lambda s: s["mine"]), lambda s: F.struct(
            (s["start"] + F.length("lead")).alias("start"), (s["end"] + F.length("lead")).alias("end")))
        return F.struct(F.concat("lead", F.array_join(segments, "")).alias("text"), mine.alias("mask"))

    heads = F.transform("turns", lambda t: head(t["speaker"], me, system))
    return j.select("conv_id", "perspective", "part", "sub", F.size("turns").cast("long").alias("n_turns"),
                    let(heads, laid_out).alias("x")).select("conv_id", "perspective", "part", "sub", "n_turns", "x.*")


def digest(turns: DataFrame) -> DataFrame:
    """The columns of the registered query, from ``render``."""
    return render(turns).select(
        "conv_id", "perspective", "part", "sub", "n_turns", "text",
        F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("mask"))

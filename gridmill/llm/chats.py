"""Chat formatting: every participant in turn as the assistant."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.session import stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS_PER_PART = 512


def safe(text):
    """Text that cannot forge a marker."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", r"<\\|$1\\|>")


def placed(messages, order, stretch):
    """Messages with `place` from 0 within their conversation; one of count n takes n places.

    Places are summed per stretch of turns first, so a long dialogue is numbered
    in many tasks.
    """
    key = F.struct("conv_id", stretch.alias("stretch"))
    marked = messages.withColumn("key", key)
    before = Window.partitionBy("key.conv_id").orderBy("key.stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy("key").agg(F.sum("n").alias("size")).select(
        "key", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    upto = Window.partitionBy("key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.withColumn("upto", F.sum("n").over(upto)).join(starts, "key")
        .withColumn("place", F.col("start") + F.col("upto") - F.col("n"))
    )


def rotate(conversations, turns_per_part=TURNS_PER_PART):
    """One row per conversation, participant and part.

    The text renders every message in order: those of the participant as the
    assistant, those of the others as users named after their role. `mask`
    holds the [start, end) code points to learn, the participant's own contents
    with their end mark; `n_turns` and `n_own` count messages.

    A dialogue of over `turns_per_part` messages goes on in further parts, so a
    conversation that holds a third of all rows is numbered and rendered in
    many tasks. Messages follow turn, role and text, a null turn last. Repeated
    messages of a turn count once, those without a turn as often as they come:
    they travel as one row with a count. A null role is the participant `unknown`, a
    null text is empty, and rows with a null conv_id form one conversation.
    """
    # Repeated rows meet before the shuffle, so they make no hot group.
    messages = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    messages = stored(messages.withColumn("n", F.when(F.col("turn").isNull(), F.col("n")).otherwise(1)), "messages")
    order = [F.col("turn").isNull(), "turn", "role", "text"]
    stretch = F.coalesce(F.floor(F.col("turn") / 256), F.lit(1 << 62))
    rows = placed(messages, order, stretch)
    # A count that runs over several parts is cut at their ends.
    first, last = F.floor(F.col("place") / turns_per_part), F.floor((F.col("place") + F.col("n") - 1) / turns_per_part)
    rows = rows.withColumn("part", F.explode(F.sequence(first, last)))
    start = F.greatest("place", F.col("part") * turns_per_part)
    end = F.least(F.col("place") + F.col("n"), (F.col("part") + 1) * turns_per_part)
    rows = rows.withColumns({"part": F.col("part").cast("int"), "start": start, "times": (end - start).cast("int")})
    key = F.struct("conv_id").alias("own")
    one = F.struct(F.col("start").alias("place"), "role", safe(F.col("text")).alias("text"), "times")
    parts = (
        rows.groupBy(key, "part").agg(F.array_sort(F.collect_list(one)).alias("turns"))
        .withColumn("turns", F.flatten(F.transform("turns", lambda t: F.array_repeat(t, t["times"]))))
    )
    speakers = messages.select(key, F.col("role").alias("speaker")).distinct()
    both = parts.join(speakers, "own")
    own = lambda t: t["role"] == F.col("speaker")
    head = lambda t: F.when(own(t), F.lit(f"{OPEN}assistant\n")).otherwise(
        F.concat(F.lit(f"{OPEN}user name="), safe(t["role"]), F.lit("\n"))
    )
    body = lambda t: F.concat(t["text"], F.lit(CLOSE))
    pieces = F.transform("turns", lambda t: F.struct(
        own(t).alias("own"), F.length(head(t)).alias("head"), F.length(body(t)).alias("body"),
        F.concat(head(t), body(t), F.lit("\n")).alias("text"),
    ))
    made = both.withColumn("pieces", pieces)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))
    start = lambda a, p: a["at"] + p["head"]
    walk = F.aggregate("pieces", empty, lambda a, p: F.struct(
        (start(a, p) + p["body"] + 1).alias("at"),
        F.when(p["own"], F.concat(a["spans"], F.array(F.struct(
            start(a, p).alias("start"), (start(a, p) + p["body"]).alias("end")
        )))).otherwise(a["spans"]).alias("spans"),
    ))
    return made.select(
        F.col("own.conv_id").alias("conv_id"), "speaker", "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"),
        walk["spans"].alias("mask"),
    )

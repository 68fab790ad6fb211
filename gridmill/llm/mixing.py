"""Mixing sources to target weights by capped water-filling."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.llm.common import ranked
from gridmill.session import stored, stored_alone

WEIGHTS = (5, 2, 1)
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes, weights=WEIGHTS, share=1.5, epochs=2):
    """One row per source: source_size, weight and target (double).

    `sizes` holds source and size per document. Sources by code point, null
    last, take the weights in turn. They share `share` times the total; a
    target stops at `epochs` times the source's size and what is over goes to
    the others by weight. Each round raises the common level to what the
    sources below their cap can take; two sums per round reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    turn = F.array(*[F.lit(w) for w in weights])
    sources = stored(
        ranked(per_source, order).withColumn(
            "weight", turn[F.pmod("position", F.lit(len(weights))).cast("int")]
        ),
        "sources",
    )
    cap = F.col("source_size") * F.lit(epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level, clamped = share * total, 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > cap
        held = sources.agg(
            F.count_if(full), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if held[0] == clamped or not held[2]:
            break
        clamped, level = held[0], (budget - (held[1] or 0)) / held[2]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", "weight", target.alias("target"))


def size_of(text="text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_of(seed):
    """The seeded order of a source. A null id or source hashes like an empty one."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source", "size")]
    return F.md5(F.concat_ws("|", F.lit(seed), *shown).cast("binary"))


def drawn_rows(documents, weights, share, epochs, seed, bucket_digits):
    """One row per different (doc_id, source, size): its mass and its place in the draw, what its source takes,
    and `more`, whether the running sum takes it once more. Per source: the one document to change."""
    docs = documents.select("doc_id", "source", size_of().alias("size"))
    docs = docs.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n_rows"))
    docs = stored(docs.withColumn("draw", draw_of(seed)), "sizes")
    docs = docs.withColumn("mass", F.col("size") * F.col("n_rows"))
    targets = source_targets(docs.select("source", F.col("mass").alias("size")), weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("int")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    own = F.struct("source").alias("own")
    place = F.struct("source", F.substring("draw", 1, bucket_digits)).alias("place")
    rows = docs.select("*", own, place)
    earlier = Window.partitionBy("own").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        rows.groupBy("own", "place").agg(F.sum("mass").alias("_sum"))
        .withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .join(targets.select(own, "source_size", "target", "whole", "rest"), "own")
        .drop("own", "_sum")
    )
    inside = Window.partitionBy("place").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_start") + F.sum("mass").over(inside)
    drawn = rows.join(buckets, "place").withColumn("_upto", upto).withColumn(
        "more", (2 * F.col("_upto") - F.col("mass") <= 2 * F.col("rest")) & (F.col("rest") > 0)
    )
    drawn = stored(drawn.drop("place", "_start", "_upto"), "drawn")
    missing = drawn.groupBy("own").agg(
        (F.first("rest") - F.coalesce(F.sum(F.when(F.col("more"), F.col("mass"))), F.lit(0))).alias("gap")
    )
    # A change must bring the sum closer: less than twice the gap, in its direction.
    gap = F.abs("gap")
    fits = (F.col("mass") > 0) & (F.col("mass") < 2 * gap) & (F.col("more") == (F.col("gap") < 0))
    by_mass = drawn.groupBy("own", "mass", "more").agg(F.min(F.struct("draw", "doc_id")).alias("who"))
    change = (
        by_mass.join(missing, "own").filter(fits)
        .groupBy("own").agg(F.min(F.struct(F.abs(F.col("mass") - gap).alias("off"), "who")).alias("best"))
        .select("own", F.col("best.who.draw").alias("swap"), F.col("best.who.doc_id").alias("swap_id"))
    )
    return drawn, change


def planned(documents, weights=WEIGHTS, share=1.5, epochs=2, seed=SEED, bucket_digits=3):
    """One row per different (doc_id, source, size): how many rows it has (`n_rows`), its source's size and
    target, and `copies`, how often the mix takes each of these rows. See `mix`."""
    drawn, change = drawn_rows(documents, weights, share, epochs, seed, bucket_digits)
    swapped = F.col("swap").isNotNull() & (F.col("draw") == F.col("swap")) & F.col("doc_id").eqNullSafe(F.col("swap_id"))
    return drawn.join(change, "own", "left").select(
        "doc_id", "source", "size", "n_rows", "source_size", "target", "draw",
        (F.col("whole") + (F.col("more") != swapped).cast("int")).cast("long").alias("copies"),
    )


def source_cuts(documents, weights=WEIGHTS, share=1.5, epochs=2, seed=SEED, bucket_digits=3):
    """The plan of `planned` as one row per source: `whole` repetitions of every document, one more up to `last` in
    the order of (draw, doc_id), and `swap`, the one place in that order where it is the other way round.

    Running sums only grow along the order, so the documents taken once more are its first ones.
    """
    drawn, change = drawn_rows(documents, weights, share, epochs, seed, bucket_digits)
    at = F.struct("draw", "doc_id")
    cuts = drawn.groupBy("own").agg(F.first("whole").alias("whole"), F.max(F.when(F.col("more"), at)).alias("last"))
    swap = F.struct(F.col("swap").alias("draw"), F.col("swap_id").alias("doc_id"))
    return cuts.join(change.select("own", swap.alias("swap")), "own", "left")


def mix(documents, **settings):
    """size, source_size, target and `copies` (whole repetitions) per document.

    Every document of a source is taken floor(target / source_size) times. What
    is left of the target is met with one more repetition of some documents: in
    the seeded order of md5(seed, id, source, size) up to the nearest running
    sum, and then the one document is added or left out whose size is nearest
    to the rest. Running sums add up buckets of the hash first, so a source
    with a third of all rows is spread like the others. A null text has size 0
    and a null source is a source of its own. Repeated rows count each; those
    with the same id, source and size are added or left out together.
    """
    rows = F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))
    plan = planned(documents, **settings)
    return plan.withColumn("_row", rows).drop("_row", "n_rows")


def mixed_documents(documents, **settings):
    """The rows of `documents` repeated as the mix takes them; `copy` counts from 1.

    All columns stay as they are, but for one called `copy`, which is replaced.
    Each document's copies follow from its own place in the draw and one row of
    its source, so texts meet a table of sources and are not shuffled as long as
    Spark broadcasts that.
    """
    cuts = stored_alone(documents.sparkSession, lambda: source_cuts(documents, **settings), "cuts")
    documents = documents.drop("copy")
    # The row is one column, so that no name of its own meets one of the plan.
    placed = (
        documents.select(F.struct(*documents.columns).alias("row"), "doc_id", "source", size_of().alias("size"))
        .select("row", F.struct("source").alias("own"), F.struct(draw_of(settings.get("seed", SEED)).alias("draw"), "doc_id").alias("at"))
    )
    more = F.coalesce(F.col("at") <= F.col("last"), F.lit(False)) != F.col("at").eqNullSafe(F.col("swap"))
    copies = (F.col("whole") + more.cast("int")).cast("int")
    taken = placed.join(cuts, "own").select("row", copies.alias("copies")).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*", "copy")

"""Line deduplication by a deletion-neighbourhood join.

Two lines are near copies when one edit (a character put in, left out or
changed) turns one into the other. Such lines share a variant with one
character deleted, or one is a variant of the other. Variants are compared as
hashes that tell the two cases apart:

* changed character: both lines lose the character at the same place, so the
  place is part of the key and every two lines under a key are near copies;
* character put in or left out: the shorter line equals a variant of the
  longer one, so a key has one whole line and any number of longer ones.

So the earliest partner of each line is a minimum per key, and no pairs of a
group are made. Before that, lines that cannot have a partner are left out by
the same idea on a coarser grain: lines one edit apart are equal but for one
block of characters. Halves come first, then blocks of about the square root
of the length, and only blocks whose remainder another line shares emit
variants.
"""

from pyspark.sql import functions as F

from gridmill.llm.common import key_bits, may_hold
from gridmill.session import stored, stored_alone

MIN_CHARS = 16  # shorter lines, like "Yes." and "Yet.", only count as exact copies
KEY = ["k1", "k2"]


def place():
    """Where a line stands; a smaller place is earlier."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "line_no")


def split_lines(documents):
    """uid, doc_id, line_no, line and its 128-bit key for every line that is not blank."""
    return documents.select(
        F.xxhash64("doc_id", "text").alias("uid"), "doc_id",
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    ).filter(F.trim("line") != "").withColumns({
        "k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(1), F.col("line")),
    })


def bounds(size, block, count):
    """Characters before a block and up to its end, of `count` blocks over `size` characters."""
    return F.floor(size * block / count).cast("int"), F.floor(size * (block + 1) / count).cast("int")


def remainder(line, less, block, count):
    """Hash of a line without one of its blocks. With `less` the blocks are those
    of a line one character shorter, and the block taken out is one longer."""
    size = F.length(line) - less
    start, stop = bounds(size, block, count)
    head = F.substring(line, F.lit(1), start)
    return F.xxhash64(block, size, head, F.substring(line, stop + less + 1, size - stop))


def halves(line="line"):
    """Remainders for two blocks: both of the line's own length, then both of one less."""
    return F.array(*[remainder(line, less, F.lit(b), 2) for less in (0, 1) for b in (0, 1)])


def grain(size):
    """Blocks that a line of this size is cut into."""
    return F.greatest(F.ceil(F.sqrt(size)).cast("int"), F.lit(2))


def remainders(line="line"):
    """Array of (key, less, block) over the blocks that the shared halves leave possible."""
    empty = F.array().cast("array<struct<key: bigint, less: int, block: int>>")

    def side(less):
        count = grain(F.length(line) - less)
        return F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.struct(
            remainder(line, less, b, count).alias("key"), F.lit(less).alias("less"), b.alias("block")
        ))

    made = [F.when(F.col(wanted), side(less)).otherwise(empty) for less, wanted in ((0, "own"), (1, "longer"))]
    return F.concat(*made)


def shared(keys):
    """Rows whose key lets two lines be one edit apart, with `changed` where two
    lines of the same length share it. A line as a longer one (`less` = 1) needs
    a shorter one under the key, and the other way round."""
    own = F.when(F.col("less") == 0, F.col("k1"))
    sides = keys.groupBy("key").agg(F.min(own).alias("a"), F.max(own).alias("b"), F.max("less").alias("any_less"))
    sides = sides.filter("a <> b or (a is not null and any_less = 1)").select("key", (F.col("a") != F.col("b")).alias("two"))
    return keys.join(sides, "key").withColumn("changed", F.col("two") & (F.col("less") == 0)).drop("two")


def variants(blocks="blocks", line="line"):
    """Keys of a line: array of (key, role). Role 0 marks a changed character, 1
    a character less, 2 the whole line. `blocks` tells where characters go."""
    size = F.length(line)

    def without(i):
        return F.concat(F.substring(line, F.lit(1), i - 1), F.substring(line, i + 1, size))

    def inside(b):
        own = size - b["less"]
        start, stop = bounds(own, b["block"], grain(own))
        stop = stop + b["less"]
        return F.when(stop > start, F.sequence(start + 1, stop)).otherwise(F.array().cast("array<int>"))

    def key(hashed, role):
        return F.struct(hashed.alias("key"), F.lit(role).alias("role"))

    def places(which):
        return F.array_distinct(F.flatten(F.transform(F.filter(blocks, which), inside)))

    changed = F.transform(places(lambda b: b["changed"]), lambda i: key(F.xxhash64(i, without(i)), 0))
    longer = F.transform(places(lambda b: b["less"] == 1), lambda i: key(F.xxhash64(F.lit(0), without(i)), 1))
    whole = F.array(key(F.xxhash64(F.lit(0), F.col(line)), 2))
    return F.concat(changed, longer, whole)


def near_copies(documents, lines, min_chars=MIN_CHARS):
    """Keys of lines with an earlier line one edit away."""
    halved = lines.filter(F.col("n_chars") >= min_chars).select(*KEY, F.posexplode("halves").alias("kind", "key"))
    halved = shared(halved.withColumn("less", F.when(F.col("kind") < 2, 0).otherwise(1)))
    sides = halved.groupBy(*KEY).agg(F.min("less").alias("least"), F.max("less").alias("most"))
    sides = sides.select(*KEY, (F.col("least") == 0).alias("own"), (F.col("most") == 1).alias("longer"))
    chosen = stored(lines.drop("halves").join(sides, KEY), "line-candidates")
    # Their texts: only documents that may hold the first copy of one are split again.
    bits = key_bits(chosen.select(F.col("first.uid").alias("uid")), "uid")
    texts = split_lines(
        may_hold(documents.withColumn("_uid", F.xxhash64("doc_id", "text")), "_uid", bits).filter("may_hold")
    ).select("uid", "line_no", "line")
    first = [F.col("first.uid") == F.col("uid"), F.col("first.line_no") == F.col("line_no")]
    candidates = stored(
        chosen.join(texts, first).select(*KEY, "first", "own", "longer", "line").dropDuplicates(KEY), "line-texts"
    )
    # Dealt out anew: a stored part of many long lines would be one long task.
    dealt = candidates.repartition(F.col("k1"))
    cut = stored(
        dealt.select(*KEY, F.explode(remainders()).alias("r")).select(*KEY, "r.key", "r.less", "r.block"), "line-blocks"
    )
    blocks = shared(cut).groupBy(*KEY).agg(F.collect_set(F.struct("less", "block", "changed")).alias("blocks"))
    keys = (
        candidates.join(blocks, KEY)
        .select(*KEY, "first", F.explode(variants()).alias("v")).select(*KEY, "first", "v.key", "v.role")
    )
    keys = stored(keys, "line-variants")
    one = F.struct("first", *KEY)
    least = lambda role: F.min(F.when(F.col("role") == role, one))
    groups = keys.groupBy("key").agg(*[least(r).alias(f"least{r}") for r in range(3)])
    partner = F.when(F.col("role") == 0, F.col("least0")).when(F.col("role") == 1, F.col("least2")).otherwise(F.col("least1"))
    found = (
        keys.join(groups, "key").withColumn("partner", partner)
        .filter(F.col("partner.first") < F.col("first"))
        .groupBy(*KEY).agg(F.min("partner").alias("partner"))
    )
    other = candidates.select(F.struct(*KEY).alias("other"), F.col("line").alias("other_line"))
    pairs = (
        found.join(candidates.select(*KEY, "line"), KEY)
        .withColumn("other", F.struct("partner.k1", "partner.k2")).join(other, "other")
    )
    distance = F.levenshtein("line", "other_line", 1)
    return pairs.filter(distance.between(0, 1)).select(*KEY)


def gone_lines(documents, min_chars=MIN_CHARS):
    """uid and the numbers of the lines that go, for documents that lose any. Frames it stores are still to be read."""
    # Documents are read for slim keys first; texts move only where lines go.
    own = F.when(F.length("line") >= min_chars, halves()).otherwise(F.array().cast("array<bigint>"))
    occurrences = split_lines(documents.select("doc_id", "text"))
    slim = occurrences.select(*KEY, place().alias("first"), F.length("line").alias("n_chars"), own.alias("halves"))
    lines = stored(
        slim.groupBy(*KEY).agg(
            F.min("first").alias("first"), F.count(F.lit(1)).alias("n"),
            F.first("n_chars").alias("n_chars"), F.first("halves").alias("halves"),
        ),
        "lines",
    )
    near = near_copies(documents.select("doc_id", "text"), lines, min_chars).withColumn("near", F.lit(True))
    hits = lines.select(*KEY, "first", "n").join(near, KEY, "left").filter("n > 1 or near")
    hits = stored(hits.select(*KEY, "first", F.coalesce("near", F.lit(False)).alias("near")), "line-hits")
    gone = occurrences.select(*KEY, "uid", "line_no").join(hits, KEY).filter(
        F.col("near") | (F.col("first.uid") != F.col("uid")) | (F.col("first.line_no") != F.col("line_no"))
    )
    return gone.groupBy("uid").agg(F.collect_set("line_no").alias("gone"))


def dedup_lines(documents, min_chars=MIN_CHARS):
    """`documents` with the text less its repeated lines, n_lines and n_kept.

    A line goes if an earlier line equals it or, from `min_chars` characters
    on, is one edit away; it goes even where that earlier line goes itself.
    Earlier means a smaller doc_id (null last), then the earlier place in the
    text. Blank lines stay and are not counted; null and blank texts stay as
    they are. Other columns pass through whatever their names are. Rows that repeat id and text are one document and stay alike.
    Columns called n_lines or n_kept are replaced.
    """
    gone = stored_alone(documents.sparkSession, lambda: gone_lines(documents, min_chars), "line-drops")
    columns = [c for c in documents.columns if c not in ("n_lines", "n_kept")]
    whole = documents.select(F.struct(*columns).alias("row"), F.xxhash64("doc_id", "text").alias("uid"))
    rest = may_hold(whole, "uid", key_bits(gone, "uid"), name="touched")
    # A line counts from its first character that is no blank.
    n_lines = F.coalesce(F.regexp_count("row.text", F.lit("[^ \\n][^\\n]*")), F.lit(0)).alias("n_lines")
    same = rest.filter("not touched").select("row", n_lines).select("row.*", "n_lines", F.col("n_lines").alias("n_kept"))
    counted = lambda parts: F.size(F.filter(parts, lambda x: F.trim(x) != ""))
    parts = F.coalesce(F.split("row.text", "\n"), F.array().cast("array<string>"))
    marks = F.coalesce("gone", F.array().cast("array<int>"))
    places = F.when(F.size("parts") > 0, F.sequence(F.lit(0), F.size("parts") - 1)).otherwise(F.array().cast("array<int>"))
    left = F.transform(F.array_except(places, marks), lambda i: F.col("parts")[i])
    cut = (
        rest.filter("touched").join(gone, "uid", "left")
        .withColumn("parts", parts).withColumn("left", left)
        .select(
            *[F.when(F.size(marks) > 0, F.array_join("left", "\n")).otherwise(F.col("row.text")).alias("text")
              if c == "text" else F.col("row")[c].alias(c) for c in columns],
            counted(F.col("parts")).alias("n_lines"), counted(F.col("left")).alias("n_kept"),
        )
    )
    return same.unionByName(cut)

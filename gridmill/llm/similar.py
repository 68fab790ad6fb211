"""N-gram Jaccard join with a MinHash LSH forest."""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.llm.common import key_bits, may_hold, uid, words_of
from gridmill.llm.components import components
from gridmill.session import stored, stored_alone

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 32, 8, 0.999
BLOCK = 256  # texts of a component compared at once
LEADERS = 4096  # texts of a bucket looked at in one task
KEY = ["k1", "k2"]


def node():
    return F.struct(*KEY)


def mixed(x):
    """The splitmix64 finish, on arrays of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of the different word n-grams of texts; a shorter text is one n-gram."""

    def __init__(self, size=SHINGLE):
        self.size, self.known = size, {}

    def __call__(self, text):
        words, known = words_of(text), self.known
        if not words:
            return np.empty(0, np.uint64)
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        values = np.fromiter((known[w] for w in words), np.uint64, len(words))
        if len(known) > 500_000:
            known.clear()
        size = min(self.size, len(values))
        total = np.zeros(len(values) - size + 1, np.uint64)
        for i in range(size):
            total = total * np.uint64(0x9E3779B97F4A7C15) + values[i:len(values) - size + 1 + i]
        return np.unique(mixed(total))


def signature(shingles, factors, shifts):
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        part = shingles[None, i:i + 1024] * factors[:, None] + shifts[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def forest(documents, trees=TREES, depth=DEPTH, size=SHINGLE):
    """Per row with words: key of the text, a label per tree and a sketch.

    A label is a path of `depth` hash values of 4 bytes, so labels that begin
    alike lie below one node of the tree's prefix trie; the sketch keeps a byte
    of every value.
    """
    rng = np.random.default_rng(11)
    factors = rng.integers(0, 1 << 63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, trees * depth, np.uint64)

    def run(batches):
        shingler = Shingler(size)
        for batch in batches:
            out = []
            for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"], strict=True):
                shingles = shingler(text)
                if len(shingles):
                    top = (signature(shingles, factors, shifts) >> np.uint64(32)).astype(">u4")
                    paths = top.reshape(trees, depth)
                    out.append((k1, k2, [p.tobytes() for p in paths], (top & 255).astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["k1", "k2", "labels", "sketch"])

    return documents.mapInPandas(run, "k1 long, k2 long, labels array<binary>, sketch binary")


def met(depths, threshold=THRESHOLD):
    """Probability that a pair just at the threshold shares a node, by the prefix depth of each tree."""
    return 1 - float(np.prod([1 - threshold**d for d in depths]))


def prefix_depth(threshold=THRESHOLD, trees=TREES, depth=DEPTH, recall=RECALL):
    """The depth no tree has to go below: there all trees together reach the recall."""
    while depth > 1 and met([depth] * trees, threshold) < recall:
        depth -= 1
    return depth


def prefix(label, depth):
    return F.substring(label, 1, 4 * depth)


def sorted_tries(members, floor, depth=DEPTH):
    """`members` (tree, label, k1, k2) with `matched`, the values a label shares with its next neighbour.

    All labels are put in one order by tree and value, so a node of a trie is a
    run of rows. Rows are dealt by range and compared inside their partition;
    the ends of a partition are compared with those of the next ones, one row
    per partition, so a node of any size is spread over tasks and none is cut.
    A match below `floor` counts as 0.
    """
    order = ["tree", "label", *KEY]
    dealt = stored(members.repartitionByRange(*order).withColumn("deal", F.spark_partition_id()), "tries")
    at = F.struct("tree", "label")
    ends = dealt.groupBy("deal").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    row = Window.orderBy("deal")
    ends = ends.select("deal", F.lag("high").over(row).alias("before"), F.lead("low").over(row).alias("after"))
    inside = Window.partitionBy("deal").orderBy(*order)
    rows = dealt.withColumns({"up": F.lag(at).over(inside), "down": F.lead(at).over(inside)}).join(ends, "deal")

    def shared(other):
        values = F.lit(0)
        for d in range(floor, depth + 1):
            values = F.when(prefix(other["label"], d) == prefix(F.col("label"), d), d).otherwise(values)
        return F.when(other["tree"] == F.col("tree"), values).otherwise(0)

    up, down = F.coalesce("up", "before"), F.coalesce("down", "after")
    return rows.select(*order, F.greatest(shared(up), shared(down)).alias("matched"))


def shortened(tries, floor, depth=DEPTH, trees=TREES, threshold=THRESHOLD, recall=RECALL):
    """Prefix depth of each tree, shortened step by step until the recall is reached.

    Every tree starts at the full depth. Each step takes one value off the
    prefix of the tree where this brings the fewest new members of shared nodes
    for what it adds to the recall; trees full of look-alikes keep their long
    prefixes. At most one count per tree and depth reaches the driver.
    """
    found = tries.groupBy("tree", "matched").agg(F.count(F.lit(1)).alias("n")).collect()
    new = {(r["tree"], r["matched"]): r["n"] for r in found}
    depths = [depth] * trees

    def price(t):
        d = depths[t] - 1
        gain = np.log((1 - threshold ** (d + 1)) / max(1 - threshold**d, 1e-12))
        return (new.get((t, d), 0) + 1) / gain, t

    while met(depths, threshold) < recall:
        longer = [t for t in range(trees) if depths[t] > floor]
        if not longer:
            break
        depths[min(longer, key=price)] -= 1
    return depths


def distances(sketches, sketch):
    """Estimated Jaccard distances; they keep the triangle inequality."""
    same = (sketches == sketch).sum(axis=1) / sketches.shape[1]
    return 1 - np.clip((same - 1 / 256) / (1 - 1 / 256), 0, 1)


def _leaders(sketches, radius, reach):
    """Leaders among the rows of a bucket, a root per row, and how far each leader's rows are.

    A row farther than `radius` from all leaders becomes one. Rows are tied to
    all leaders within `reach`, and what ties lead to shares a root, the first
    row of it. With reach >= radius + the distance of a link, two linked rows
    have a leader in common (triangle inequality), so no link is cut although
    rows are not compared with each other. A row belongs to its nearest leader;
    the cover of a leader is the largest distance of a row of its own.
    """
    bits = sketches.shape[1]
    table, leaders, root, cover = np.empty((16, bits), np.uint8), [], list(range(len(sketches))), []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, sketch in enumerate(sketches):
        far = np.ones(0)
        if leaders:
            far = distances(table[:len(leaders)], sketch)
            for j in np.flatnonzero(far <= reach):
                low, high = sorted((find(leaders[j]), find(i)))
                root[high] = low
        if far.min(initial=1.0) > radius:
            if len(leaders) == len(table):
                table = np.concatenate([table, np.empty_like(table)])
            table[len(leaders)] = sketch
            leaders.append(i)
            cover.append(0.0)
        else:
            cover[far.argmin()] = max(cover[far.argmin()], far.min())
    return leaders, [find(i) for i in range(len(sketches))], cover


def _led(radius, reach):
    """(k1, k2, r1, r2) of all rows of the buckets of a group; only leaders have a cover."""
    def run(group):
        group = group.sort_values(["bucket", "k1", "k2"], ignore_index=True)
        sketches = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(group), -1)
        cuts = np.flatnonzero(np.diff(group["bucket"].to_numpy())) + 1
        root, cover = np.arange(len(group)), np.full(len(group), -1.0)
        for low, high in zip([0, *cuts], [*cuts, len(group)], strict=True):
            led, roots, covers = _leaders(sketches[low:high], radius, reach)
            root[low:high] = low + np.array(roots)
            cover[low + np.array(led)] = covers
        k1, k2 = group["k1"].to_numpy(), group["k2"].to_numpy()
        return pd.DataFrame({
            "k1": k1, "k2": k2, "r1": k1[root], "r2": k2[root], "cover": cover, "bucket": group["bucket"],
        })

    return run


def _tied(link):
    """(k1, k2, r1, r2) of leaders that may have linked rows: rows of two leaders
    that are linked keep these within both covers and the distance of a link."""
    def run(group):
        sketches = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(group), -1)
        cover = group["cover"].to_numpy()
        root, free = np.arange(len(group)), np.ones(len(group), bool)
        for a in range(len(group)):
            todo = [a] if free[a] else []
            free[a] = False
            while todo:
                i = todo.pop()
                rest = np.flatnonzero(free)
                near = rest[distances(sketches[rest], sketches[i]) <= cover[rest] + cover[i] + link]
                root[near], free[near] = a, False
                todo += near.tolist()
        k1, k2 = group["k1"].to_numpy(), group["k2"].to_numpy()
        return pd.DataFrame({"k1": k1, "k2": k2, "r1": k1[root], "r2": k2[root]})

    return run


def block_pairs(rows, most):
    """Rows of each bucket in blocks of about `most`, once for every two blocks (i, j) that meet."""
    blocks = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(7), *KEY), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # One row for a split bucket, so it goes to all tasks and no bucket is a hot key.
    return rows.join(F.broadcast(blocks), "bucket").withColumn("block", own).withColumn("other", others).filter(
        "blocks = 1 or block <> other"
    ).select(*rows.columns, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def candidate_edges(
    trees_of_texts, floor, depth=DEPTH, trees=TREES, threshold=THRESHOLD, recall=RECALL, leaders=LEADERS, per_task=20_000,
):
    """Edges (u, v) between texts that tie all pairs to be compared together."""
    nodes = trees_of_texts.select(*KEY, F.posexplode("labels").alias("tree", "label")).withColumn(
        "bucket", F.xxhash64("tree", prefix(F.col("label"), floor))
    )
    # All places go through one sum per node at the floor; only labels below
    # nodes with different texts are sorted.
    ends = nodes.groupBy("bucket").agg(F.min("k1").alias("a"), F.max("k1").alias("b"))
    shared = stored(ends.filter("a <> b").select("bucket"), "shared")
    maybe = may_hold(nodes, "bucket", key_bits(shared, "bucket")).filter("may_hold").drop("may_hold")
    tries = sorted_tries(maybe.distinct().join(shared, "bucket", "left_semi").drop("bucket"), floor, depth)
    tries = stored(tries, "matched")
    depths = F.array(*[F.lit(d) for d in shortened(tries, floor, depth, trees, threshold, recall)])[F.col("tree")]
    own = F.xxhash64("tree", F.substring("label", F.lit(1), 4 * depths)).alias("bucket")
    members = stored(tries.filter(F.col("matched") >= depths).select(own, *KEY), "buckets")
    members = members.join(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket")
    named = stored(members.select(*KEY).distinct(), "bucket-texts")
    # Sketches of texts in no shared bucket are not shuffled.
    sketches = may_hold(trees_of_texts.select(*KEY, "sketch"), node(), key_bits(named, node()))
    sketches = sketches.filter("may_hold").drop("may_hold").dropDuplicates(KEY).join(named, KEY, "left_semi")
    sketches = stored(sketches, "sketches")
    # Sketches err by a few hundredths: the radii keep four of them as margin.
    radius, reach = 1 - threshold, min(2 * (1 - threshold) + 0.12, 0.95)
    lead = _led(radius, reach)
    tied = "k1 long, k2 long, r1 long, r2 long"
    salts = F.ceil(F.col("n") / leaders)
    tasks = members.count() // per_task + 1
    # Small buckets share a task, those split over tasks have one for each part.
    task = F.when(salts == 1, F.pmod("bucket", F.lit(tasks))).otherwise(
        F.xxhash64("bucket", F.pmod(F.xxhash64(*KEY), salts))
    )
    rows = members.withColumn("task", task).join(sketches, KEY)
    first = stored(rows.groupBy("task").applyInPandas(lead, tied + ", cover double, bucket long"), "leaders")
    # Leaders of a split bucket meet, two blocks in a task: linked texts of two parts tie their leaders.
    split = members.filter(F.col("n") > leaders).select("bucket").distinct()
    again = first.filter("cover >= 0").join(split, "bucket", "left_semi").select("bucket", *KEY, "cover")
    pairs = block_pairs(again.join(sketches, KEY), leaders)
    second = pairs.groupBy("bucket", "i", "j").applyInPandas(_tied(1 - threshold + 0.12), tied)
    edges = first.select(*second.columns).unionByName(second).filter("k1 <> r1 or k2 <> r2")
    return edges.select(node().alias("u"), F.struct(F.col("r1").alias("k1"), F.col("r2").alias("k2")).alias("v"))


def intersections(sets):
    """Sizes of all pairwise intersections of sorted hash arrays, in blocks of the vocabulary."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], number[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    total = int(shared.sum())
    for low in range(0, total, 4096):
        a, b = np.searchsorted(place, [low, low + 4096])
        dense = np.zeros((len(sets), min(4096, total - low)), np.float32)
        dense[owner[a:b], place[a:b] - low] = 1
        out += dense @ dense.T
    return out


def _compared(threshold, size):
    """Links of the texts of each component (or two blocks of one) in a group."""
    def run(group):
        shingler, out = Shingler(size), []
        for (_, i, j), rows in group.groupby(["component", "i", "j"], sort=False):
            sets = [shingler(t) for t in rows["text"]]
            sizes = np.array([len(s) for s in sets], np.float32)
            both = intersections(sets)
            linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-6
            np.fill_diagonal(linked, False)
            block = rows["block"].to_numpy()
            if i != j:  # pairs inside a block are compared where both blocks are this one
                linked &= block[:, None] != block[None, :]
            root = np.arange(len(rows))
            for a in range(len(rows)):
                if root[a] == a:
                    todo = [a]
                    while todo:
                        near = np.flatnonzero(linked[todo.pop()] & (root != a) & (root >= a))
                        root[near] = a
                        todo += near.tolist()
            k1, k2 = rows["k1"].to_numpy(), rows["k2"].to_numpy()
            out.append(pd.DataFrame({"k1": k1, "k2": k2, "r1": k1[root], "r2": k2[root], "links": linked.sum(axis=1)}))
        return pd.concat(out)

    return run


def members_of(labels):
    """(k1, k2, component, n) of every node of the components, with their sizes."""
    members = labels.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        labels.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    return members.join(sizes, "component").select("node.k1", "node.k2", F.xxhash64("component").alias("component"), "n")


def verified(texts, n_texts, threshold=THRESHOLD, size=SHINGLE, block=BLOCK, per_task=2000):
    """(k1, k2, r1, r2, links) of texts in candidate components, compared exactly.

    `texts` has the text, its key, and the component and size of `members_of`.
    A component of many texts is cut into blocks, and every two blocks meet in
    a task of their own, so texts are sent as often as there are blocks and
    pairs stay inside numpy.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(5), *KEY), blocks).cast("int")
    others = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = texts.withColumn("block", own).withColumn("other", others).select(
        *KEY, "text", "component", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), blocks.alias("blocks"),
    )
    tasks = n_texts // per_task + 1
    task = F.when(F.col("blocks") == 1, F.pmod("component", F.lit(tasks))).otherwise(
        F.xxhash64("component", "i", "j")
    )
    return rows.groupBy(task.alias("task")).applyInPandas(
        _compared(threshold, size), "k1 long, k2 long, r1 long, r2 long, links long"
    )


def has_words():
    return F.regexp_like("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))


def classed(rows, slim, threshold, trees, depth, recall, size):
    """One row per text that has words: its key, first document, copies, links and class. Frames it stores are still to be read."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    trees_of_texts = stored(forest(rows, trees, depth, size), "forest")
    floor = prefix_depth(threshold, trees, depth, recall)
    edges = candidate_edges(trees_of_texts, floor, depth, trees, threshold, recall)
    groups = components(edges)
    firsts = stored(slim.filter("words").groupBy(*KEY).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n_copies")), "texts")
    # One row per text, the first: copies are no hot key, and keys meet before texts move.
    wanted = stored(firsts.select(*KEY, "first.uid").join(members_of(groups), KEY), "wanted")
    row = [*KEY, "uid"]
    picked = may_hold(rows.select(*row, "text"), F.struct(*row), key_bits(wanted, F.struct(*row))).filter("may_hold")
    texts = picked.drop("may_hold").dropDuplicates(row).join(wanted, row)
    found = stored(verified(texts, wanted.count(), threshold, size), "links")
    ties = found.filter("k1 <> r1 or k2 <> r2").select(
        node().alias("u"), F.struct(F.col("r1").alias("k1"), F.col("r2").alias("k2")).alias("v")
    )
    classes = components(ties)
    every = classes.select("u.k1", "u.k2", F.col("v").alias("class"))
    links = found.groupBy(*KEY).agg(F.sum("links").alias("n_links"))
    return firsts.join(every, KEY, "left").join(links, KEY, "left").select(
        *KEY, "first", "n_copies", F.coalesce("class", node()).alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def jaccard_join(documents, threshold=THRESHOLD, trees=TREES, depth=DEPTH, recall=RECALL, size=SHINGLE):
    """doc_id, class_id, n_links and n_copies of every row, its uid and class_key.

    Texts are compared by their sets of `size`-word shingles (letters and
    digits, A-Z lower-cased). `n_links` counts the different texts at
    `threshold` or more, `n_copies` the rows with the same text, and class_id
    is the least doc_id that links and copies lead to. Candidates come from a
    forest of `trees` sorted prefix tries, whose prefixes are shortened until a
    pair at the threshold is met with the wanted recall; they are compared
    exactly, and no group of copies or bucket becomes pairs of rows.

    A text without words has no shingles: each such row is alone, without
    links, and its class is its own id. A null doc_id is the last; a class of
    null ids only has a null id.
    """
    key = {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), F.col("text"))}
    rows = documents.select("doc_id", "text", uid().alias("uid")).withColumns(key)
    slim = rows.select("doc_id", *KEY, has_words().alias("words"), "uid")
    merged = stored_alone(
        documents.sparkSession, lambda: classed(rows, slim, threshold, trees, depth, recall, size), "merged"
    )
    heads = merged.groupBy("class").agg(F.min("first").alias("head"))
    ends = merged.join(heads, "class").select(*KEY, F.col("head.doc_id").alias("class_id"), "n_links", "n_copies", F.xxhash64("class").alias("class_key"))
    alone = ~F.coalesce("words", F.lit(False))
    own = slim.filter(alone).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"), "uid", F.col("uid").alias("class_key"),
    )
    return slim.filter(~alone).join(ends, KEY).select(*own.columns).unionByName(own)


def one_of_each(documents, **settings):
    """The first document of every class, with all its columns.

    Rows that repeat an id and a text are one document; of different texts of
    the first id in a class one stays. Rows without words stay as they are.
    Columns pass through whatever their names are.
    """
    words = F.coalesce(has_words(), F.lit(False))
    classes = stored_alone(
        documents.sparkSession, lambda: jaccard_join(documents.filter(words), **settings), "classes"
    )
    heads = classes.filter("doc_id <=> class_id").groupBy("class_key").agg(F.min("uid").alias("uid"))
    gone = stored(classes.select("uid").distinct().join(heads, "uid", "left_anti"), "copies")
    again = classes.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("uid")
    # Rows that surely go nowhere are not shuffled.
    bits = key_bits(gone.unionByName(again), "uid")
    # The row is one column, so that no name of its own meets a helper's.
    whole = documents.select(F.struct(*documents.columns).alias("row"), uid().alias("uid"), words.alias("words"))
    marked = may_hold(whole, "uid", bits, name="touched").withColumn("touched", F.col("touched") & F.col("words"))
    rest = marked.filter("touched").join(gone, "uid", "left_anti").dropDuplicates(["uid"])
    return marked.filter("not touched").select("row.*").unionByName(rest.select("row.*"))

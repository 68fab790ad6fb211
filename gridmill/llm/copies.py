"""MinHash near-dedup by an inverted join of signature coordinates.

Every distinct shingle set has a signature of minima. It is posted under its
coordinate-value pairs, the tokens. Two sets above the match threshold share at
least `needed` tokens, so, with tokens ordered by how many sets hold them, they
share one among the first `held - needed + 1` of each (prefix), and a list's
partners that can no longer come to `needed` from where they stand, or whose
size differs too much, are skipped. Collisions of the rest are counted on the
whole signatures, and pairs above the threshold are confirmed on the full sets.

Groups of near copies do not become pairs: first each set is confirmed against
the least set of its lists, one row per set and list. Then only lists that
still hold sets of several components are gone through, and only for pairs of
two components, inside the task.
"""

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from gridmill.llm.common import key_bits, may_hold, uid
from gridmill.llm.components import components
from gridmill.session import stored

SHINGLE, PERCENT, COORDINATES = 2, 80, 64
PER_TASK, BLOCK = 2000, 1000  # rows of many small lists in a task, rows of a block of a large one
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
KEY = ["k1", "k2"]


def needed_matches(percent=PERCENT, coordinates=COORDINATES):
    """Matches of a pair just at the threshold, less four standard deviations."""
    p = percent / 100
    return max(math.floor(coordinates * p - 4 * math.sqrt(coordinates * p * (1 - p))), 1)


def mixed(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hashes(dict):
    """Word hashes, made when first asked for."""

    def __missing__(self, word):
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


class Shingles:
    """Sorted 64-bit hashes of the distinct word shingles of a text; fewer words are one shingle."""

    def __init__(self, size=SHINGLE):
        self.size, self.known = size, Hashes()

    def __call__(self, text):
        words, known = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split(), self.known
        if not words:
            return np.empty(0, np.uint64)
        values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > 500_000:
            known.clear()
        size = min(self.size, len(values))
        total = np.full(len(values) - size + 1, size, np.uint64)
        for i in range(size):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + values[i:i + len(total)])
        return np.unique(total)


def signed(documents, size=SHINGLE, coordinates=COORDINATES):
    """doc_id, uid, n_shingles, a 128-bit key of the set and its minima, 32 bits each (none for an empty set)."""
    rng = np.random.default_rng(13)
    factors = rng.integers(0, 1 << 63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, coordinates, np.uint64)

    def run(batches):
        shingles = Shingles(size)
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = shingles(text)
                tokens = None
                if len(found):
                    least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
                    for i in range(0, len(found), 1024):
                        part = found[None, i:i + 1024] * factors[:, None] + shifts[:, None]
                        np.minimum(least, part.min(axis=1), out=least)
                    tokens = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
                key = xxhash.xxh3_128_intdigest(found.tobytes())
                out.append((len(found), (key >> 64) - (1 << 63), (key & (1 << 64) - 1) - (1 << 63), tokens))
            n, k1, k2, tokens = zip(*out, strict=True) if out else ((),) * 4
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "uid": batch["uid"], "n_shingles": np.array(n, np.int64),
                "k1": np.array(k1, np.int64), "k2": np.array(k2, np.int64), "tokens": list(tokens),
            })

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", uid().alias("uid"), "text").mapInPandas(
        run, f"doc_id {kind}, uid long, n_shingles long, k1 long, k2 long, tokens array<int>"
    )


def postings(sets, needed):
    """k1, k2 and prefix of every set that may have a partner.

    Tokens of one set only lead nowhere, and a set that shares fewer than
    `needed` of its tokens has no partner. `prefix` holds the tokens it is
    posted under, rarest first.
    """
    # Values above 2^31 are negative as integers; without their sign the upper half of a token is its coordinate.
    value = F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    tokens = sets.select(*KEY, F.posexplode("tokens").alias("at", "value")).select(
        *KEY, (F.col("at").cast("long") * 2**32 + value).alias("token")
    )
    sizes = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n_sets")).filter("n_sets > 1")
    sizes = stored(sizes, "tokens")
    maybe = may_hold(tokens, "token", key_bits(sizes, "token")).filter("may_hold").drop("may_hold")
    shared = maybe.join(sizes, "token").groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("n_sets", "token"))).alias("shared")
    ).filter(F.size("shared") >= needed)
    prefix = F.slice("shared.token", F.lit(1), F.size("shared") - needed + 1)
    return shared.select(*KEY, prefix.alias("prefix"))


def common(a, b):
    """How many values two sorted arrays share."""
    place = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[place] == b).sum())


class Rows:
    """Rows of a task as arrays: sizes, tokens, prefixes, and the sets of those that are asked for."""

    def __init__(self, frame, needed, percent, size):
        self.n = frame["n"].to_numpy()
        self.tokens = np.stack(frame["tokens"].to_list())
        if "posted" in frame:
            bits = frame["posted"].to_numpy().view(np.uint64)[:, None] >> np.arange(self.tokens.shape[1], dtype=np.uint64)
            self.posted = bits & np.uint64(1) == 1
        self.text = frame["text"].to_list() if "text" in frame else None
        self.needed, self.percent = needed, percent
        self.shingles, self.sets = Shingles(size), {}

    def near(self, i, others, token=None):
        """Those of `others` with a possible size and enough collisions with row i, and none of
        those posted before the one under `token`: a pair is met in one list only."""
        sizes = self.n[others]
        others = others[(100 * sizes >= self.percent * self.n[i]) & (100 * self.n[i] >= self.percent * sizes)]
        equal = self.tokens[others] == self.tokens[i]
        good = equal.sum(axis=1) >= self.needed
        if token is not None and good.any():
            met = equal & self.posted[others] & self.posted[i]
            good &= met.argmax(axis=1) == token >> 32
        return others[good]

    def set_of(self, i):
        if i not in self.sets:
            self.sets[i] = self.shingles(self.text[i])
        return self.sets[i]

    def linked(self, i, j):
        a, b = self.set_of(i), self.set_of(j)
        both = common(a, b)
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def ranges(*columns):
    """Where runs of equal rows begin and end."""
    change = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    cuts = (np.flatnonzero(change) + 1).tolist()
    return zip([0, *cuts], [*cuts, len(columns[0])], strict=True)


EDGE = "k1 long, k2 long, r1 long, r2 long"


def _edges(pairs, k1, k2):
    a, b = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
    return pd.DataFrame({"k1": k1[a], "k2": k2[a], "r1": k1[b], "r2": k2[b]})


def _centred(needed, percent, size):
    """Links of the sets of each centre with it."""
    def run(group):
        group = group.sort_values(["c1", "c2", "part", "own"], ignore_index=True)
        k1, k2, c1, c2 = (group[c].to_numpy() for c in ("k1", "k2", "c1", "c2"))
        rows, found = Rows(group, needed, percent, size), []
        for low, high in ranges(c1, c2, group["part"].to_numpy()):
            near = rows.near(high - 1, np.arange(low, high - 1))  # the centre is the last row
            found += [(i, high - 1) for i in near.tolist() if rows.linked(i, high - 1)]
            rows.sets.clear()
        return _edges(found, k1, k2)

    return run


def _crossed(needed, percent, size, mark):
    """Links between components of a list; with `mark` the rows of pairs to be confirmed."""
    def run(group):
        group = group.sort_values(["token", "i", "j"], ignore_index=True)
        k1, k2, token, block = (group[c].to_numpy() for c in ("k1", "k2", "token", "block"))
        i_block, j_block = group["i"].to_numpy(), group["j"].to_numpy()
        _, component = np.unique(group[["m1", "m2"]].to_numpy(), axis=0, return_inverse=True)
        rows, found, marked = Rows(group, needed, percent, size), [], np.zeros(len(group), bool)
        for low, high in ranges(token, i_block, j_block):
            root = component[low:high].ravel()
            for i in range(low, high):
                others = low + np.flatnonzero(root != root[i - low])
                others = others[others > i]
                if i_block[i] != j_block[i]:  # pairs inside a block meet where both blocks are this one
                    others = others[block[others] != block[i]]
                others = rows.near(i, others, token[i])
                if mark:
                    marked[others] = True
                    marked[i] |= len(others) > 0
                    continue
                for j in others.tolist():
                    if root[i - low] != root[j - low] and rows.linked(i, j):
                        root[root == root[j - low]] = root[i - low]
                        found.append((i, j))
            rows.sets.clear()
        return group.loc[marked, ["token", *KEY]] if mark else _edges(found, k1, k2)

    return run


def struct_of(a="k1", b="k2"):
    return F.struct(F.col(a).alias("k1"), F.col(b).alias("k2"))


def as_edges(found):
    return found.select(struct_of().alias("u"), struct_of("r1", "r2").alias("v"))


def colliding(pairs, slim, needed):
    """Pairs whose signatures match in `needed` coordinates."""
    own = slim.select(*KEY, "tokens")
    other = slim.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("tokens").alias("c_tokens"))
    equal = F.zip_with("tokens", "c_tokens", lambda a, b: (a == b).cast("int"))
    matches = F.aggregate(equal, F.lit(0), lambda n, x: n + x)
    return pairs.join(own, KEY).join(other, ["c1", "c2"]).filter(matches >= needed).select(*pairs.columns)


def with_texts(documents, wanted):
    """k1, k2 and text of the sets `wanted`, of one document each; all other texts stay where they are."""
    wanted = stored(wanted, "wanted")
    texts = may_hold(documents.select(uid().alias("uid"), "text"), "uid", key_bits(wanted.select("uid"), "uid"))
    texts = texts.filter("may_hold").drop("may_hold").dropDuplicates(["uid"])
    return stored(texts.join(wanted, "uid").drop("uid"), "set-texts")


def star_links(lists, slim, documents, needed, percent, size, block=BLOCK):
    """Confirmed links of sets with the least set of any of their lists."""
    centres = lists.groupBy("token").agg(F.min(struct_of()).alias("c"))
    pairs = lists.join(centres, "token").filter((F.col("k1") != F.col("c.k1")) | (F.col("k2") != F.col("c.k2")))
    pairs = pairs.select(*KEY, F.col("c.k1").alias("c1"), F.col("c.k2").alias("c2")).distinct()
    pairs = stored(colliding(stored(pairs, "stars"), slim, needed), "star-pairs")
    sizes = pairs.groupBy("c1", "c2").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    sizes = stored(sizes, "star-sizes")
    members = pairs.join(sizes, ["c1", "c2"]).withColumn("part", F.pmod(F.xxhash64(*KEY), "parts").cast("int"))
    centre = sizes.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "c1", "c2", "parts",
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = members.select(*KEY, "c1", "c2", "parts", "part", F.lit(False).alias("own")).unionByName(
        centre.withColumn("own", F.lit(True))
    )
    details = slim.select(*KEY, "n", "tokens", "uid").join(rows.select(*KEY).distinct(), KEY, "left_semi")
    rows = rows.join(with_texts(documents, details), KEY)
    tasks = pairs.count() // PER_TASK + 1
    task = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("c1", "c2"), F.lit(tasks))).otherwise(F.xxhash64("c1", "c2", "part"))
    return rows.groupBy(task.alias("task")).applyInPandas(_centred(needed, percent, size), EDGE)


def blocked(rows, block=BLOCK):
    """Rows of each list in blocks of about `block`, once for every two blocks that meet, and once for the block itself."""
    sizes = rows.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(13), *KEY), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = rows.join(stored(sizes, "list-sizes"), "token").withColumn("block", own).withColumn("other", others)
    return placed.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})


def crossing_links(lists, slim, documents, labels, needed, percent, size, block=BLOCK):
    """Confirmed links between sets of one list that `labels` leaves in different components."""
    own = labels.select(F.col("u.k1").alias("k1"), F.col("u.k2").alias("k2"), F.col("v").alias("m"))
    member = lists.join(own, KEY, "left").withColumn("m", F.coalesce("m", struct_of()))
    mixed_lists = member.groupBy("token").agg(F.min("m").alias("a"), F.max("m").alias("b")).filter("a <> b")
    rows = member.join(mixed_lists.select("token"), "token", "left_semi")
    rows = stored(rows.select("token", *KEY, F.col("m.k1").alias("m1"), F.col("m.k2").alias("m2")), "crossings")

    def sent(chosen, with_what, fields, mark):
        tasks = chosen.count() // PER_TASK + 1
        task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("token"), F.lit(tasks))).otherwise(F.xxhash64("token", "i", "j"))
        placed = blocked(chosen, block).join(with_what, KEY)
        return placed.groupBy(task.alias("task")).applyInPandas(_crossed(needed, percent, size, mark), fields)

    slim = slim.drop("prefix")
    pairs = stored(sent(rows, slim.drop("uid"), "token long, k1 long, k2 long", True).distinct(), "crossing-rows")
    details = with_texts(documents, slim.join(pairs.select(*KEY).distinct(), KEY, "left_semi"))
    return sent(rows.join(pairs, ["token", *KEY], "left_semi"), details, EDGE, False)


def near_duplicates(documents, percent=PERCENT, size=SHINGLE, coordinates=COORDINATES, block=BLOCK):
    """doc_id, n_shingles, component_id and kept of every row.

    Texts are compared by their sets of `size`-word shingles (A-Z lower-cased,
    split at white space); a text of fewer words is one shingle. Sets whose
    intersection is at least `percent` of their union are linked, component_id
    is the least doc_id that links lead to, and the row with that id is kept.

    Null and blank texts have no shingles and are alone. Null ids come last: a
    component of null ids has a null id, and its rows are all kept. Rows of
    equal text are linked, a repeated id is kept as often as it is there. Texts
    are taken whole, other columns are left out, an empty table gives no rows.
    """
    if coordinates > 64:
        raise ValueError("a set is posted under at most 64 coordinates")
    needed = needed_matches(percent, coordinates)
    rows = stored(signed(documents, size, coordinates), "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    sets = stored(rows.filter("n_shingles > 0").groupBy(*KEY).agg(
        F.min(order).alias("first"), F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens")
    ), "sets")
    live = postings(sets, needed)
    coordinate = lambda mask, token: mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(token, 32).cast("int")))
    posted = F.aggregate("prefix", F.lit(0).cast("long"), coordinate).alias("posted")
    slim = stored(live.select(*KEY, "prefix", posted).join(sets.select(*KEY, "n", "tokens", "first.uid"), KEY), "posted")
    lists = stored(slim.select(*KEY, F.explode("prefix").alias("token")), "lists")
    stars = stored(star_links(lists, slim, documents, needed, percent, size, block), "star-links")
    labels = components(as_edges(stars))
    crossing = stored(
        crossing_links(lists, slim, documents, labels, needed, percent, size, block), "crossing-links"
    )
    ends = components(as_edges(stars.unionByName(crossing)))
    named = sets.select(*KEY, "first").join(
        ends.select("u.k1", "u.k2", F.col("v").alias("m")), KEY, "left"
    ).withColumn("m", F.coalesce("m", struct_of()))
    named = stored(named, "set-components")
    heads = named.groupBy("m").agg(F.min("first").alias("head"))
    heads = stored(named.join(heads, "m").select(*KEY, F.col("head.doc_id").alias("component_id")), "components")
    slim_rows = rows.select("doc_id", "n_shingles", *KEY)
    found = slim_rows.filter("n_shingles > 0").join(heads, KEY).unionByName(
        slim_rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    )
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

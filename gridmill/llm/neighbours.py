"""Exact top-k search by inner product with a paged M-tree.

The tree has four levels: at most 256 routers, at most 256 routers below each
of them, a page of vectors below each of those, and routers inside the page.
Every node keeps the least and largest distance of what lies below it, entries
of a page keep the distance to their router. Pages are dealt by distance, so a
query visits the pages whose rings its floor does not rule out.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.session import stored

PAGE = 2048  # vectors of a page; a page is one task's tree
NODE = 64  # vectors below one router of a page
MAX_ROUTERS = 256  # of the first level, and below each of them
QUERY_BLOCK = 4096  # queries that meet a page at a time
NO_ID = (1 << 63) - 1  # stands for a null vec_id inside, behind all others
NONE = -(1 << 62) - 1  # below every score
EXACT = float(1 << 53)  # sums of whole numbers below it are exact as doubles


def whole_numbers(vector):
    """floor(256 x) of every component as doubles; None if one is null or not finite."""
    if vector is None:
        return None
    values = np.array([np.nan if x is None else x for x in vector], np.float64) * 256
    return np.floor(values) if np.isfinite(values).all() else None


def points(embeddings, column="embedding"):
    """vec_id, v (int64 components as bytes) and squared norm of vectors that take part."""
    def run(batches):
        for batch in batches:
            made = [(i, whole_numbers(v)) for i, v in zip(batch["vec_id"], batch["v"], strict=True)]
            with np.errstate(invalid="ignore"):  # what 64 bits cannot hold ends the search, see `build`
                out = [(i, v.astype(np.int64).tobytes(), float((v**2).sum())) for i, v in made if v is not None]
            yield pd.DataFrame(out, columns=["vec_id", "v", "norm"])

    ids = F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id")
    return embeddings.select(ids, F.col(column).alias("v")).mapInPandas(run, "vec_id long, v binary, norm double")


def unpacked(column, width):
    """Rows of int64, shorter vectors filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        one = np.frombuffer(v, np.int64)
        out[i, :len(one)] = one
    return out


def lifted(vectors, top):
    """Vectors as doubles with one more component that brings all norms to `top`.

    Among such points the nearest to (q, 0) are those with the largest inner
    product with q, so the distance is a metric that a tree can prune by.
    """
    out = flat(vectors)
    out[:, -1] = np.sqrt(np.maximum(top - (out**2).sum(axis=1), 0))
    return out


def flat(vectors):
    """Queries among lifted vectors: the added component is zero."""
    return np.hstack([vectors.astype(np.float64), np.zeros((len(vectors), 1))])


def distances(a, b):
    square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def reach(floors, full):
    """Distance up to which a vector may score a floor or more, with room for rounding."""
    far = np.sqrt(np.maximum(full - 2 * floors.astype(np.float64), 0)) * (1 + 1e-9) + 1e-6 * (1 + np.sqrt(full))
    return np.where(floors == NONE, np.inf, far)


class Page:
    """Routers with covering radii, entries with parent distances."""

    def __init__(self, ids, vectors, top):
        self.ids, self.vectors, self.top = ids, vectors, top
        if top < EXACT:
            self.vectors = vectors.astype(np.float64)
        place = lifted(vectors, top)
        self.routers = place[::NODE]
        far = distances(place, self.routers)
        home = far.argmin(axis=1)
        parent = far[np.arange(len(place)), home]
        self.entries = [np.flatnonzero(home == r) for r in range(len(self.routers))]
        self.parents = [parent[mine] for mine in self.entries]
        self.radii = np.array([p.max(initial=0.0) for p in self.parents])

    def search(self, ids, queries, floors, k):
        """(query id, vec_id, score) of the k best of each query with a score from its floor on.

        Nodes are taken in the order of their lower bounds, each once for all
        queries that it may serve. A node beyond the distance of a query's k-th
        best so far is left out for it, and an entry whose parent distance
        differs too much from those of all queries is not computed. Scores are
        whole numbers: products of doubles below 2^53, of integers beyond. Ties
        are kept until the ids decide.
        """
        far = distances(flat(queries), self.routers)
        lower = np.maximum(far - self.radii, 0)
        full = (queries.astype(np.float64) ** 2).sum(axis=1) + self.top
        asked = queries.astype(self.vectors.dtype)
        score = np.full((len(ids), k), NONE)
        other = np.full((len(ids), k), NO_ID)
        floors = floors.copy()
        limit = reach(floors, full)
        for r in np.argsort(lower.min(axis=0), kind="stable"):
            active = np.flatnonzero(lower[:, r] <= limit)
            close = np.abs(self.parents[r][None, :] - far[active, r][:, None]) <= limit[active][:, None]
            some = close.any(axis=0)
            near = self.entries[r][some]
            if not len(near):
                continue
            made = (asked[active] @ self.vectors[near].T).astype(np.int64)
            good = close[:, some] & (made >= floors[active][:, None]) & (self.ids[near][None, :] != ids[active][:, None])
            rows = good.any(axis=1)
            hit = active[rows]
            if not len(hit):
                continue
            scores = np.hstack([score[hit], np.where(good[rows], made[rows], NONE)])
            others = np.hstack([other[hit], np.broadcast_to(self.ids[near], (len(hit), len(near)))])
            first = np.lexsort((others, -scores))[:, :k]
            score[hit] = np.take_along_axis(scores, first, axis=1)
            other[hit] = np.take_along_axis(others, first, axis=1)
            floors[hit] = np.maximum(floors[hit], score[hit, -1])
            limit[hit] = reach(floors[hit], full[hit])
        q, place = np.nonzero(score != NONE)
        return ids[q], other[q, place], score[q, place]


class Routers:
    """The upper two levels: centres, and centres below each of them, with rings."""

    def __init__(self, centres, width, top):
        self.width, self.top = width, top
        self.centres = lifted(unpacked(centres, width), top)
        self.below = [c[None, :] for c in self.centres]
        self.rings, self.pages = {}, {}

    def refine(self, router, vectors):
        self.below[router] = lifted(unpacked(vectors, self.width), self.top)

    def place(self, vectors):
        """Router and page of every vector, with the distances to both."""
        here = lifted(vectors, self.top)
        far = distances(here, self.centres)
        home = far.argmin(axis=1)
        page, near = np.zeros(len(here), np.int64), np.zeros(len(here))
        for r in np.unique(home):
            mine = np.flatnonzero(home == r)
            within = distances(here[mine], self.below[r])
            page[mine] = within.argmin(axis=1)
            near[mine] = within.min(axis=1)
        return home, far[np.arange(len(here)), home], page, near

    def keep(self, rows):
        """Take in rings and part counts of pages, one row each."""
        for r in sorted({row["router"] for row in rows}):
            mine = sorted((row for row in rows if row["router"] == r), key=lambda row: row["page"])
            self.rings[r] = (min(m["low"] for m in mine), max(m["high"] for m in mine))
            self.pages[r] = tuple(
                np.array([m[name] for m in mine]) for name in ("page", "parts", "near_low", "near_high")
            )

    def nearest(self, vectors):
        """One page near each query: (place in `vectors`, router, page, parts)."""
        here = flat(vectors)
        names = np.array(sorted(self.pages))
        home = names[distances(here, self.centres[names]).argmin(axis=1)]
        for r in np.unique(home):
            page, parts, _, _ = self.pages[r]
            mine = np.flatnonzero(home == r)
            best = distances(here[mine], self.below[r][page]).argmin(axis=1)
            for i, p in zip(mine, best, strict=True):
                yield i, r, page[p], parts[p]

    def within(self, vectors, floors):
        """All pages that may hold a score from a query's floor on, in the same form."""
        here = flat(vectors)
        limit = reach(floors, (here**2).sum(axis=1) + self.top)
        far = distances(here, self.centres)
        for r, (page, parts, near_low, near_high) in self.pages.items():
            low, high = self.rings[r]
            mine = np.flatnonzero(np.maximum(far[:, r] - high, low - far[:, r]) <= limit)
            if not len(mine):
                continue
            near = distances(here[mine], self.below[r][page])
            q, p = np.nonzero(np.maximum(near - near_high, near_low - near) <= limit[mine][:, None])
            for i, j in zip(mine[q], p, strict=True):
                yield i, r, page[j], parts[j]


PLACED = "vec_id long, v binary, router long, far double, page long, near double"
FOUND = "query_id long, vec_id long, score long"
SENT = "query_id long, v binary, floor long, router long, page long, part long"
KEYS = ["router", "page", "part"]


def build(embeddings, page=PAGE, max_routers=MAX_ROUTERS):
    """Every vector with its page, and the routers; None without vectors.

    Routers of the first level are a bounded sample: a vector per page, those of
    the lowest hashes, at most `max_routers`. A router with more vectors than a
    page gets a sample of its own vectors below it, again one per page and about
    `max_routers` at most, so the driver holds some 65,536 vectors at any size.
    Every vector lies below its nearest router. What still exceeds two pages, as
    equal vectors or those of a very large table do, is dealt by hash over parts.
    """
    rows = stored(points(embeddings), "points")
    total, top, width = rows.agg(F.count(F.lit(1)), F.max("norm"), F.max(F.length("v"))).first()
    if not total:
        return None
    if top >= 1 << 62:
        raise ValueError(f"vectors of squared norm {top} make scores beyond 64 bits")
    width //= 8
    chosen = rows.select("v").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(int(min(max(total // page, 1), max_routers)))
    routers = Routers([r["v"] for r in chosen.collect()], width, top)

    def run(batches):
        for batch in batches:
            home, far, at, near = routers.place(unpacked(batch["v"], width))
            yield pd.DataFrame({
                "vec_id": batch["vec_id"], "v": batch["v"], "router": home, "far": far, "page": at, "near": near,
            })

    if total > 2 * page:
        first = rows.mapInPandas(run, PLACED).select("router", "v")
        first = stored(first, "below")
        sizes = first.groupBy("router").count().filter(F.col("count") > 2 * page)
        share = F.least(F.ceil(F.col("count") / page), F.lit(max_routers)) / F.col("count")
        draw = F.pmod(F.xxhash64(F.lit(5), "v"), F.lit(1 << 30)) / F.lit(1 << 30)
        drawn = first.join(F.broadcast(sizes), "router").filter(draw < share).select("router", "v").distinct()
        below = {}
        for r in drawn.orderBy("router", "v").collect():
            below.setdefault(r["router"], []).append(r["v"])
        for r, vectors in below.items():
            routers.refine(r, vectors)
    placed = stored(rows.mapInPandas(run, PLACED), "placed")
    many = F.when(F.count(F.lit(1)) > 2 * page, F.ceil(F.count(F.lit(1)) / page)).otherwise(1).cast("long")
    sizes = stored(placed.groupBy("router", "page").agg(
        many.alias("parts"), F.min("far").alias("low"), F.max("far").alias("high"),
        F.min("near").alias("near_low"), F.max("near").alias("near_high"),
    ), "pages")
    routers.keep(sizes.collect())
    paged = placed.join(sizes.select("router", "page", "parts"), ["router", "page"]).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(3), "vec_id"), "parts")
    )
    return paged.select("vec_id", "v", *KEYS), routers


def _routed(routers):
    """Queries with every page they visit: one page where `first` is set, else all in reach."""
    def run(batches):
        for batch in batches:
            ids, packed = batch["query_id"].to_numpy(), batch["v"].to_numpy()
            first = batch["first"].to_numpy(bool)
            out = []
            for visits, rows in ((routers.nearest, first), (routers.within, ~first)):
                mine = np.flatnonzero(rows)
                if not len(mine):
                    continue
                floors = batch["floor"].to_numpy(np.int64)
                vectors = unpacked(packed[mine], routers.width)
                for i, r, page, parts in visits(vectors) if visits == routers.nearest else visits(vectors, floors[mine]):
                    q = mine[i]
                    some = [int(ids[q]) % parts] if first[q] else range(parts)
                    out += [(ids[q], packed[q], floors[q], r, page, part) for part in some]
            yield pd.DataFrame(out, columns=["query_id", "v", "floor", *KEYS])

    return run


def _searched(routers, k):
    def run(page, asked):
        if page.empty or asked.empty:
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        tree = Page(page["vec_id"].to_numpy(), unpacked(page["v"], routers.width), routers.top)
        found = tree.search(
            asked["query_id"].to_numpy(), unpacked(asked["v"], routers.width), asked["floor"].to_numpy(), k
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    return run


def top_k(embeddings, is_query, k=5, page=PAGE, query_block=QUERY_BLOCK):
    """query_id, rank, vec_id and score: the k largest inner products per query.

    Components are floor(256 x) as whole numbers. `is_query` picks the queries
    by vec_id; every other row is a candidate, also other queries. First each
    query searches one page near it, whose k-th score is a floor; then it visits
    all pages that the floor does not rule out. A page is copied only as often
    as blocks of queries visit it; the k best of the pages are merged per query.
    The result is exact.

    Vectors that are null or hold a null or non-finite component take no part.
    A null vec_id is a candidate behind all other ids and never a query. Rows
    with the id of the query are left out, a repeated query is asked once,
    repeated other rows count each. Shorter vectors count as filled with zeros,
    so an empty one scores 0. Squared norms from 2^62 on raise an error, as
    scores could pass 64 bits. No vectors give no rows.
    """
    spark = embeddings.sparkSession
    built = build(embeddings, page)
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    paged, routers = built
    asked = paged.filter(is_query).filter(F.col("vec_id") != NO_ID)
    asked = stored(asked.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v")), "queries")

    def visit(queries):
        sent = stored(queries.select("query_id", "v", "floor", "first").mapInPandas(_routed(routers), SENT), "visits")
        blocks = sent.groupBy(*KEYS).agg(F.ceil(F.count(F.lit(1)) / query_block).cast("long").alias("blocks"))
        blocks = stored(blocks, "blocks")
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
        slots = paged.join(blocks, KEYS).select("vec_id", "v", *KEYS, copies)
        dealt = sent.join(blocks, KEYS).withColumn("block", F.pmod(F.xxhash64(F.lit(7), "query_id"), "blocks"))
        keys = [*KEYS, "block"]
        return slots.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(_searched(routers, k), FOUND)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    seen = visit(asked.withColumn("floor", F.lit(NONE)).withColumn("first", F.lit(True)))
    floors = seen.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
    again = stored(
        asked.join(floors.select("query_id", F.col("score").alias("floor")), "query_id", "left")
        .withColumn("floor", F.coalesce("floor", F.lit(NONE))).withColumn("first", F.lit(False)),
        "floors",
    )
    ranked = visit(again).withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")

"""Vector code compression: product codes learned by exact ball k-means on whole numbers.

An entry and the parts assigned to it form a ball. Only entries whose centre is
at most twice the ball's radius away are its neighbours. A part nearer to its
entry than half the way to the nearest neighbour is in the stable core and is
compared with nothing; the others lie in rings, and a part is compared with the
neighbours whose half distance its own distance reaches. All distances are
whole numbers, so the result is that of comparing everything.
"""

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridmill.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SUMS = "part int, entry int, position int, total long, far long"


def whole_numbers(vectors, scale=SCALE):
    """(row numbers, rows of floor(scale x)) of vectors without null or non-finite components,
    shorter ones filled up with zeros, and the lengths."""
    there = [i for i, v in enumerate(vectors) if v is not None]
    sizes = np.array([len(vectors[i]) for i in there], np.int64)
    flat = np.concatenate([np.empty(0), *(np.asarray(vectors[i], np.float64) for i in there)])
    rows = np.repeat(np.arange(len(there)), sizes)
    out = np.zeros((len(there), sizes.max(initial=0)))
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    good = np.isfinite(out).all(axis=1)
    with np.errstate(over="ignore"):
        return np.array(there, np.int64)[good], np.floor(out[good] * scale), sizes[good]


def points(embeddings, column="embedding", scale=SCALE):
    """vec_id, label, v (whole components as bytes of int32), its width and largest magnitude."""
    def run(batches):
        for batch in batches:
            rows, whole, sizes = whole_numbers(batch["v"].to_list(), scale)
            far = np.abs(whole).max(axis=1, initial=0.0)
            safe = np.where(np.abs(whole) < 2**31, whole, 0).astype(np.int32)
            yield batch.iloc[rows][["vec_id", "label"]].assign(
                v=[row[:size].tobytes() for row, size in zip(safe, sizes, strict=True)], width=sizes, far=far
            )

    chosen = embeddings.select("vec_id", "label", F.col(column).alias("v"))
    label = chosen.schema["label"].dataType.simpleString()
    kind = chosen.schema["vec_id"].dataType.simpleString()
    return chosen.mapInPandas(run, f"vec_id {kind}, label {label}, v binary, width long, far double")


def cut(column, width, parts):
    """The vectors as an int64 array by part, row and position within the part."""
    arrays = [np.frombuffer(v, np.int32) for v in column]
    out = np.zeros((len(arrays), width * parts), np.int64)
    for row, array in zip(out, arrays, strict=True):
        row[:len(array)] = array
    return out.reshape(len(arrays), parts, width).transpose(1, 0, 2)


def balls(entries, radii):
    """For each entry its neighbours, nearest first, and their squared distances from it."""
    gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    out = []
    for i, radius in enumerate(radii):
        near = [j for j in np.argsort(gaps[i], kind="stable") if j != i and math.sqrt(gaps[i, j]) <= 2 * radius]
        out.append((near, gaps[i, near]))
    return out


def moved(vectors, own, entries, rings):
    """Nearest entry (the lower one of equals) and squared distance, from the entry each part had."""
    best = np.zeros(len(vectors), np.int64)
    new = own.copy()
    for i, (near, gaps) in enumerate(rings):
        mine = np.flatnonzero(own == i)
        if not len(mine):
            continue
        best[mine] = ((vectors[mine] - entries[i]) ** 2).sum(axis=1)
        # Another entry is as near only if it is at most twice as far from this one: in the core none is.
        reach = np.searchsorted(gaps, 4 * best[mine], side="right")
        for k in range(reach.max(initial=0)):
            ring, j = mine[reach > k], near[k]
            far = ((vectors[ring] - entries[j]) ** 2).sum(axis=1)
            better = (far < best[ring]) | ((far == best[ring]) & (j < new[ring]))
            best[ring[better]], new[ring[better]] = far[better], j
    return new, best


def assigned(vectors, history):
    """Entries and squared distances of one part position after all rounds of `history`.

    The rounds are gone through again from the vectors: a round costs a distance
    per part and few more, and no state has to be written or kept.
    """
    own = np.zeros(len(vectors), np.int64)
    far = np.zeros(len(vectors), np.int64)
    for entries, rings in history:
        own, far = moved(vectors, own, entries, rings)
    return own, far


def _sums(history, width, parts):
    def run(batches):
        total = {}
        for batch in batches:
            for p, vectors in enumerate(cut(batch["v"], width, parts)):
                own, far = assigned(vectors, history[p])
                for e in np.unique(own):
                    mine = own == e
                    now = np.array([mine.sum(), *vectors[mine].sum(axis=0)])
                    before, most = total.get((p, e), (0, 0))
                    total[p, e] = before + now, max(most, int(far[mine].max()))
        rows = [(p, e, i - 1, int(x), far) for (p, e), (sums, far) in total.items() for i, x in enumerate(sums)]
        yield pd.DataFrame(rows, columns=["part", "entry", "position", "total", "far"])

    return run


def learned(rows, width, entries=ENTRIES, rounds=ROUNDS, parts=PARTS):
    """Per part position the codebooks of all rounds with their balls, the last one at the end.

    A round sends the sums of every entry to the driver, parts x entries x
    width numbers whatever the number of vectors. A ball's radius is the largest
    distance to the entry before it moved, and the way that it moved.
    """
    order = [F.col("vec_id").isNull(), F.col("vec_id"), F.col("v")]
    first = cut([r["v"] for r in rows.orderBy(*order).limit(entries).collect()], width, parts)
    history = [[(codebook, balls(codebook, [math.inf] * len(codebook)))] for codebook in first]
    for _ in range(rounds):
        partial = rows.select("v").mapInPandas(_sums(history, width, parts), SUMS)
        sums = partial.groupBy("part", "entry", "position").agg(F.sum("total"), F.max("far")).collect()
        count = {(p, e): n for p, e, i, n, _ in sums if i < 0}
        reach = {(p, e): far for p, e, i, _, far in sums if i < 0}
        for p, rounds_of_part in enumerate(history):
            old = rounds_of_part[-1][0]
            new = old.copy()
            for q, e, i, total, _ in sums:
                if q == p and i >= 0:
                    new[e, i] = total // count[p, e]
            way = np.sqrt(((new - old) ** 2).sum(axis=1))
            radii = [(math.sqrt(reach.get((p, e), 0)) + way[e]) * (1 + 1e-9) + 1e-6 for e in range(len(new))]
            rounds_of_part.append((new, balls(new, radii)))
    return history


def compress(embeddings, entries=ENTRIES, rounds=ROUNDS, parts=PARTS, scale=SCALE, column="embedding"):
    """vec_id, label, code, error, label_error and codebooks_sha256 of every vector that takes part.

    `code` has two hex digits for each part's entry, `error` is the squared
    distance to the decoded vector, `label_error` its sum over the rows of equal
    label (nulls are equal), codebooks_sha256 the hash of all final entries.

    Vectors that are null or hold a null or non-finite component take no part.
    Shorter vectors, empty ones too, count as filled up with zeros to the
    longest, and that to a multiple of `parts`. Null ids come last among the
    first entries, equal ids by their vectors; repeated rows count each. With
    fewer rows than `entries` the codebooks are as short. An empty table gives no
    rows. Components whose squared distances might pass 64 bits are an error.
    Other columns are left out.
    """
    rows = stored(points(embeddings, column, scale), "vectors")
    widest, far = rows.agg(F.max("width"), F.max("far")).first()
    width = -(-(widest or 0) // parts)
    if (far or 0) >= math.sqrt(2**59 / max(width * parts, 1)):
        raise ValueError(f"components up to {far} pass 64 bits in squared distances")
    history = learned(rows, width, entries, rounds, parts)
    final = [book.tolist() for *_, (book, _) in history]
    digest = hashlib.sha256(",".join(str(x) for book in final for e in book for x in e).encode()).hexdigest()

    def run(batches):
        for batch in batches:
            found = [assigned(v, h) for v, h in zip(cut(batch["v"], width, parts), history, strict=True)]
            own = np.stack([f[0] for f in found], axis=1)
            yield batch[["vec_id", "label"]].assign(
                code=["".join(f"{e:02x}" for e in row) for row in own.tolist()], error=sum(f[1] for f in found)
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    coded = stored(rows.mapInPandas(run, f"{kinds}, code string, error long"), "codes")
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )

"""Language identification with hyperdimensional letter vectors."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridmill.llm.common import held_out
from gridmill.session import stored

DIMENSIONS = 1024
LETTERS = 256  # letter ids: space, and code points by remainder
MAX_LANGUAGES = 10_000
CHUNK = 1 << 18  # characters of a text looked at together


def letter_vectors(dimensions=DIMENSIONS, seed=7):
    """Random signs of each letter id, shifted by its place in a trigram."""
    base = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (LETTERS, dimensions))
    return [np.roll(base, 2 - place, axis=1) for place in range(3)]


def trigrams(text):
    """Codes and counts of the letter trigrams of a text; None without a letter.

    Letters in lower case keep their code point modulo 255 plus 1; everything
    else counts as one space, runs of it once.
    """
    codes, counts, seen, tail = [], [], False, ""
    for i in range(0, len(text), CHUNK):
        part = tail + text[i:i + CHUNK].lower()
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        ascii_letter = (points >= 97) & (points <= 122)
        letter = ascii_letter | (points >= 170)
        if not letter.any():
            tail = part[-2:]
            continue
        wide = np.flatnonzero(points >= 170)
        if len(wide):
            kinds, where = np.unique(points[wide], return_inverse=True)
            letter[wide] = np.array([chr(k).isalpha() for k in kinds])[where]
        seen = seen or bool(letter.any())
        ids = np.where(letter, points % (LETTERS - 1) + 1, 0).astype(np.int64)
        ids = np.concatenate([[0], ids, [0]])
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0)
        ids = ids[keep]
        made, many = np.unique((ids[:-2] * LETTERS + ids[1:-1]) * LETTERS + ids[2:], return_counts=True)
        codes.append(made)
        counts.append(many)
        tail = ""
    if not seen:
        return None
    return np.concatenate(codes), np.concatenate(counts)


def bind(codes, vectors):
    first, second, third = vectors
    return first[codes // LETTERS**2] * second[codes // LETTERS % LETTERS] * third[codes % LETTERS]


def bundle_all(found, vectors, dimensions):
    """Bundled vectors of several texts: the trigrams of all are bound once."""
    out = np.zeros((len(found), dimensions), np.float32)
    for low in range(0, len(found), 256):
        part = [(i, f) for i, f in enumerate(found[low:low + 256], low) if f is not None and len(f[0])]
        if not part:
            continue
        known = np.unique(np.concatenate([f[0] for _, f in part]))
        if len(known) > 40_000:  # bound in pieces, 160 MB at most
            for i, (codes, counts) in part:
                for j in range(0, len(codes), 20_000):
                    out[i] += counts[j:j + 20_000].astype(np.float32) @ bind(codes[j:j + 20_000], vectors).astype(np.float32)
            continue
        bound = bind(known, vectors).astype(np.float32)
        for i, (codes, counts) in part:
            out[i] = counts.astype(np.float32) @ bound[np.searchsorted(known, codes)]
    return out


def learn(documents, dimensions=DIMENSIONS):
    """Prototype per language: the sum of the vectors of its texts, one to unit length each.

    Every task adds up its own texts; sums of tasks are added by language and
    dimension, so nothing grows with the number of texts.
    """
    def run(batches):
        vectors, sums = letter_vectors(dimensions), {}
        for batch in batches:
            made = bundle_all([trigrams(t) for t in batch["text"]], vectors, dimensions)
            length = np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)
            # Whole numbers add up alike in any order of tasks.
            made = np.rint(made / length * 65_536).astype(np.int64)
            for lang, rows in batch.groupby("lang").indices.items():
                sums[lang] = sums.get(lang, 0) + made[rows].sum(axis=0)
        for lang, total in sums.items():
            yield pd.DataFrame({"lang": [lang], "total": [total]})

    sums = documents.select("lang", "text").filter("lang is not null and text is not null").mapInPandas(
        run, "lang string, total array<long>"
    )
    return (
        sums.select("lang", F.posexplode("total").alias("place", "value"))
        .groupBy("lang", "place").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("profile"))
        .select("lang", F.transform("profile", lambda p: p["value"]).alias("profile"))
    )


def predict(documents, profiles, dimensions=DIMENSIONS):
    """lang_pred and score of every text, beside the other columns of `documents`.

    `profiles` (lang, vector) of at most MAX_LANGUAGES languages go to every
    task. The score is the cosine with the nearest profile moved to 0..1; ties
    go to the first language by name. `und` with score 0 for null, for texts
    without a letter, and where nothing was learned.
    """
    names = [lang for lang, _ in profiles]
    matrix = np.array([v for _, v in profiles], np.float64).reshape(len(names), dimensions)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)

    def run(batches):
        vectors = letter_vectors(dimensions)
        for batch in batches:
            found = [trigrams(t) if t is not None else None for t in batch["text"]]
            made = bundle_all(found, vectors, dimensions).astype(np.float64)
            made /= np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)
            lang, score = [], []
            cosines = made @ matrix.T if names else None
            for i, one in enumerate(found):
                best = int(np.argmax(cosines[i])) if one is not None and names else -1
                lang.append(names[best] if best >= 0 else "und")
                score.append(min(max((float(cosines[i][best]) + 1) / 2, 0.0), 1.0) if best >= 0 else 0.0)
            yield batch.drop(columns="text").assign(lang_pred=lang, score=score)

    kept = documents.select(*[c for c in documents.columns if c not in ("lang_pred", "score")])
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c != "text")
    return kept.mapInPandas(run, f"{schema}, lang_pred string, score double")


def identify(documents, dimensions=DIMENSIONS):
    """doc_id, held_out, lang_pred and score of every row.

    Profiles are learned from documents with a language that are not held out;
    a prediction sees the text alone. Empty texts count as texts without a
    letter; repeated rows stay and teach as often.
    """
    taught = documents.filter(~held_out(F.col("doc_id")))
    rows = stored(learn(taught, dimensions), "profiles").orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; profiles must fit a task")
    found = predict(documents.select("doc_id", "text"), [(r[0], r[1]) for r in rows], dimensions)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

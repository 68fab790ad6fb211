"""Quality scores learned from preference pairs (Bradley-Terry)."""

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gridmill.llm.common import drop_rows, held_out, ranked, uid
from gridmill.operators import rollup
from gridmill.session import stored, stored_alone

PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
CHUNK = 1 << 20  # bytes looked at together, so long texts stay small in memory


def text_features(text):
    """Shares and averages of one text; an empty or null one gives zeros."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    counts, starts, doubled, ends = np.zeros(256), 0, 0, 0
    for i in range(0, len(data), CHUNK):
        part = data[i:i + CHUNK]
        counts += np.bincount(part, minlength=256)
        letter = _LETTER[part]
        starts += int(np.count_nonzero(letter[1:] & ~letter[:-1])) + int(letter[0])
        doubled += int(np.count_nonzero((part[1:] == part[:-1]) & _MARK[part[1:]]))
        ends += int(np.count_nonzero(_MARK[part[:-1]] & (part[1:] <= 32)))
    size = max(len(data), 1)
    marks = counts[PUNCTUATION]
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    lines = (text or "").split("\n")
    words = (text or "").split()
    shape = [
        letters / size, counts[65:91].sum() / size, counts[97:123].sum() / size,
        counts[48:58].sum() / size, counts[128:].sum() / size, counts[:33].sum() / size,
        marks.sum() / size, doubled / size, ends / size, starts / size,
        counts[65:91].sum() / max(letters, 1), letters / max(starts, 1) / 20,
        marks.sum() / max(len(words), 1) / 4, len(set(words)) / max(len(words), 1),
        len(set(lines)) / max(len(lines), 1), np.log1p(len(words)) / 10, np.log1p(len(lines)) / 10,
    ]
    return np.concatenate([shape, np.sqrt(marks / size)]).astype(np.float32)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARK = np.zeros(256, bool)
_MARK[PUNCTUATION] = True


def with_features(documents):
    """The columns of `documents` but its text, and `features` (array<float>)."""
    def run(batches):
        for batch in batches:
            made = [text_features(t) for t in batch["text"]]
            yield batch.drop(columns="text").assign(features=pd.Series(made, dtype=object, index=batch.index))

    schema = ", ".join(f"`{c}` {t}" for c, t in documents.dtypes if c != "text")
    return documents.mapInPandas(run, f"{schema}, features array<float>")


def preference_pairs(good, bad, per_example=4):
    """Feature differences of preferred minus other, half of them turned round.

    `good` and `bad`: features of the two labels and n, their place from 0. Every example of the
    larger label meets `per_example` of the other, dealt evenly over their positions.
    """
    n_good, n_bad = good.count(), bad.count()
    if not n_good or not n_bad:
        return None
    good = good.select(F.col("n").alias("i"), F.col("features").alias("a"))
    bad = bad.select(F.col("n").alias("j"), F.col("features").alias("b"))
    few = min(n_good, n_bad)
    steps = F.explode(F.sequence(F.lit(0), F.lit(min(per_example, few) - 1)))
    if n_good >= n_bad:
        pairs = good.withColumn("s", steps).withColumn("j", (F.col("i") * per_example + F.col("s")) % n_bad).join(bad, "j")
    else:
        pairs = bad.withColumn("s", steps).withColumn("i", (F.col("j") * per_example + F.col("s")) % n_good).join(good, "i")
    up = (F.col("i") + F.col("j") + F.col("s")) % 2
    sign = F.when(up == 0, 1.0).otherwise(-1.0)
    return pairs.select(
        (up == 0).cast("double").alias("label"),
        F.zip_with("a", "b", lambda x, y: (x - y) * sign).alias("difference"),
    )


def fit(examples, max_iter=50, penalty=1e-3):
    """Weights, threshold and scale from all labelled examples (features, label 0/1, key).

    Examples are placed by the hash of their key. The loss is the logistic one of
    the score difference of each pair. The threshold is the score below which the
    share of label 0 lies among the examples. None without examples of both labels.
    """
    order = ["place", "key", "features"]
    placed = examples.withColumn("place", F.xxhash64("key"))
    good, bad = (
        stored(ranked(placed.filter(F.col("label") == label), order, "n").select("n", "label", "features"), "labelled")
        for label in (1, 0)
    )
    pairs = preference_pairs(good, bad)
    if pairs is None:
        return None
    model = LogisticRegression(
        maxIter=max_iter, regParam=penalty, fitIntercept=False, featuresCol="vector"
    ).fit(stored(pairs, "pairs").withColumn("vector", array_to_vector("difference")))
    weights = [float(w) for w in model.coefficients]
    scored = stored(good.unionByName(bad).select("label", raw_score(weights).alias("raw")), "label-scores")
    share, low, high = scored.agg(
        F.avg(1 - F.col("label")),
        F.avg(F.when(F.col("label") == 0, F.col("raw"))), F.avg(F.when(F.col("label") == 1, F.col("raw"))),
    ).first()
    # The exact quantile, without all scores in one task; its column is named after the share.
    edge = rollup.summary(scored, "raw", by=[], quantiles=[share]).first()[f"p{round(share * 100)}"]
    return weights, edge, max(abs(high - low) / 8, 1e-6)


def raw_score(weights):
    products = F.zip_with("features", F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)


def score_quality(documents, labels):
    """doc_id, uid, held_out, score and predicted of every row, in one pass over the texts.

    All labels of documents that are not held out teach, and no others; features see the
    text alone. The score is the logistic of the distance to the threshold.
    Without labels of both kinds every score is 0.5. Null ids count as ids that
    no label matches; labels other than 0 and 1 are left out; a document with
    both labels teaches both; repeated rows stay.
    """
    rows = stored(with_features(documents.select("doc_id", "text", uid().alias("uid"))), "features")
    taught = labels.filter("quality in (0, 1)").select("doc_id", F.col("quality").cast("double").alias("label")).distinct()
    examples = rows.filter(~held_out(F.col("doc_id"))).join(taught, "doc_id").select(
        "features", "label", F.col("doc_id").cast("string").alias("key")
    )
    fitted = fit(examples)
    if fitted is None:
        score = F.lit(0.5)
    else:
        weights, threshold, scale = fitted
        score = 1 / (1 + F.exp(-(raw_score(weights) - threshold) / scale))
    return rows.select(
        "doc_id", "uid", held_out(F.col("doc_id")).alias("held_out"), score.cast("double").alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents, labels):
    """The documents that are not rejected, with all columns as they are."""
    bad = stored_alone(
        documents.sparkSession,
        lambda: score_quality(documents, labels).filter("predicted = 0").select("uid").distinct(), "rejected",
    )
    return drop_rows(documents, bad)

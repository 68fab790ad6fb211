"""Operators without a SQL counterpart against plain Python and on held-out rows of the shared tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gridmill.llm import languages, personal, quality, urls
from gridmill.session import table

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def base_spans(text):
    return [
        (kind, m.start(), m.end()) for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "") if passes(kind, m[0])
    ]


def test_base_spans_equal_plain_patterns(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    odd = [(-1, "a@b 1.2.3.256 1.2.3.4.5 4111 1111 1111 1111 +1 (202) 555-0100 é x@y.z"), (-2, None), (-3, "")]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    out = {r["doc_id"]: r for r in personal.digest(personal.find_personal_data(docs)).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(out) == len(texts)
    for doc_id, text in texts.items():
        spans = base_spans(text)
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert out[doc_id]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        counts = Counter(k for k, _, _ in spans)
        assert all(out[doc_id][f"n_{k}"] >= counts[k] for k in BASE)
        assert set(shown.split(",")) - {""} <= set(out[doc_id]["spans"].split(","))


def plain_vector(text, vectors):
    """Sum of the bound trigrams of a text, None without a letter."""
    ids = [0]
    for c in (text or "").lower() + " ":
        letter = "a" <= c <= "z" or (ord(c) >= 170 and c.isalpha())
        if letter or ids[-1]:
            ids.append(ord(c) % 255 + 1 if letter else 0)
    total = np.zeros(languages.DIMENSIONS)
    for (a, b, c), n in Counter(zip(ids, ids[1:], ids[2:])).items():
        total += n * (vectors[0][a] * vectors[1][b] * vectors[2][c]).astype(float)
    return total if any(ids) else None


def test_languages_equal_plain_cosines(spark):
    docs = table(spark, SMALL, "documents")
    rows, vectors, profiles = docs.select("doc_id", "text", "lang").collect(), languages.letter_vectors(), {}
    made = {r["doc_id"]: plain_vector(r["text"], vectors) for r in rows}
    apart = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows}
    for r in rows:
        v = made[r["doc_id"]]
        if not apart[r["doc_id"]] and r["lang"] is not None and v is not None:
            profiles[r["lang"]] = profiles.get(r["lang"], 0) + v / max(np.linalg.norm(v), 1e-9)
    names = sorted(profiles)
    out = {r["doc_id"]: r for r in languages.identify(docs).collect()}
    for r in rows:
        v, one = made[r["doc_id"]], out[r["doc_id"]]
        assert one["held_out"] == apart[r["doc_id"]]
        if v is None:
            assert (one["lang_pred"], one["score"]) == ("und", 0.0)
            continue
        cosines = [float(v @ profiles[n] / max(np.linalg.norm(v) * np.linalg.norm(profiles[n]), 1e-9)) for n in names]
        best = int(np.argmax(cosines))
        assert abs(one["score"] - (cosines[best] + 1) / 2) < 1e-4
        assert one["lang_pred"] == names[best] or sorted(cosines)[-1] - sorted(cosines)[-2] < 1e-4


def test_languages_and_quality_of_held_out_documents(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    langs = languages.identify(docs).filter("held_out").join(docs.select("doc_id", "lang").filter("lang is not null"), "doc_id")
    right = langs.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right[0] >= 0.95 and right[1] > 100
    scored = quality.score_quality(docs, labels).filter("held_out").join(labels.filter("quality is not null"), "doc_id")
    right = scored.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert right[0] >= 0.9 and right[1] > 50


def test_urls_without_a_rule_by_a_labelled_table(spark):
    """A small table of labelled URLs teaches; a third of it is held out and judged."""
    good, bad = ("library", "museum", "school", "garden"), ("casino", "jackpot", "betting", "poker")
    rows = [
        (i, f"https://{('www', 'm', 'old')[i % 3]}.{words[i % 4]}{i % 29}.com/{('news', 'page', 'a')[i % 3]}/{i}", verdict)
        for n, (words, verdict) in enumerate(((good, "allow"), (bad, "block"))) for i in range(n * 300, n * 300 + 300)
    ]
    known = spark.createDataFrame(rows, "page_id long, url string, rule_verdict string")
    apart = F.crc32(F.col("url")) % 3 == 1
    held = known.filter(apart)
    out = urls.judge(held.select("page_id", "url"), labelled=known.filter(~apart).drop("page_id")).join(held.drop("url"), "page_id")
    right = out.agg(F.avg((F.col("verdict") == F.col("rule_verdict")).cast("int")), F.count("*"), F.count("rule")).first()
    assert right[0] >= 0.95 and right[1] > 100 and right[2] == 0


def test_urls_with_clashing_columns(spark):
    names = ["features", "rawPrediction", "probability", "prediction", "_grams", "rule_verdict", "page", "weight", "label"]
    rows = [(i, f"http://{'a.net' if i % 2 else 'b.org'}/fr/{i}", "old", *names) for i in range(6)] + [(9, None, "old", *names)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string, " + ", ".join(f"{n} string" for n in names))
    out = urls.judge(pages).orderBy("page_id").collect()
    assert [r["verdict"] for r in out[:6]] == ["allow", "block"] * 3 and out[6]["host"] == ""
    assert all([r[n] for n in names] == names for r in out)

"""Benchmark decontamination: an Aho-Corasick automaton over word windows of test items."""

import re

import ahocorasick
import pandas as pd
from pyspark.sql import functions as F

from gridmill.llm.common import drop_rows, uid, words_of
from gridmill.session import stored, stored_alone

WINDOW = 10
#: Bytes of benchmark text in one automaton (about 60 times as much in memory).
BLOCK_BYTES = 4 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def flat(words):
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def build(items, window=WINDOW):
    """Automaton over the windows of (item_id, text) pairs.

    A window is `window` consecutive words, or the whole of a shorter item; the
    value of each is its word count and the ids of the items that hold it.
    """
    machine, owners = ahocorasick.Automaton(), {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            part = words[i:i + window]
            owners.setdefault(flat(part), (len(part), set()))[1].add(item)
    for key, value in owners.items():
        machine.add_word(key, value)
    machine.make_automaton()
    return machine


def scan(machine, text):
    """Words of the text, [first, last) word intervals hit (merged), and the items found."""
    words = words_of(text)
    if not words or not len(machine):
        return len(words), [], set()
    hits, found, line, seen, at = [], set(), flat(words), 0, 0
    for end, (count, items) in machine.iter(line):
        # Spaces before the closing one of the match: the words up to its last.
        seen, at = seen + line.count(" ", at, end), end
        found |= items
        first = seen - count
        # Matches come by their end, a longer one may start before those seen.
        while hits and hits[-1][1] >= first:
            first = min(first, hits.pop()[0])
        hits.append((first, seen))
    return len(words), hits, found


def spans(text, hits):
    """Code point offsets [start, end) in the original text of word intervals."""
    if not hits:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in hits]


FOUND = (
    "n_words long, words array<struct<first: int, last: int>>, items array<string>, "
    "spans array<struct<first: int, last: int>>"
)


def _scanner(items, window):
    def run(batches):
        machine = build(items.value, window)
        for batch in batches:
            out = []
            for text in batch["text"]:
                n, hits, found = scan(machine, text)
                pairs = [{"first": a, "last": b} for a, b in hits]
                marks = [{"first": a, "last": b} for a, b in spans(text, hits)]
                out.append((n, pairs, sorted(str(i) for i in found), marks))
            made = pd.DataFrame(out, columns=["n_words", "words", "items", "spans"])
            yield pd.concat([batch.drop(columns="text").reset_index(drop=True), made], axis=1)

    return run


def n_blocks(benchmark, block_bytes=BLOCK_BYTES):
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return total // block_bytes + 1


def blocks(benchmark, count):
    """The benchmark as `count` lists of (item_id, text) of about the same size.

    Each is read when it is asked for, so that only one need be on the driver.
    Null ids are left out of the item list but their windows are not, null
    texts have none.
    """
    for i in range(count):
        part = benchmark.filter("text is not null")
        if count > 1:
            part = part.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        yield [(r[0], r[1]) for r in part.select("item_id", "text").collect()]


def find_overlap(documents, benchmark, window=WINDOW, block_bytes=BLOCK_BYTES, key=("doc_id",)):
    """Per document: `key` columns, n_words, hit words, item ids and spans of the text.

    One automaton holds a block of the benchmark, whose size is measured first;
    a benchmark of several blocks takes a pass over the texts for each, and the
    passes are merged per document. Items are read as the bounded side, the
    documents only stream by. A null text has no words; repeated rows stay, and
    with several blocks rows that share `key` and text are told apart by a row id.
    """
    spark = documents.sparkSession
    kept = documents.select(*key, "text")
    names = list(key)
    count = n_blocks(benchmark, block_bytes)
    if count > 1:
        kept, names = stored(kept.withColumn("_row", F.monotonically_increasing_id()), "texts"), [*names, "_row"]
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c != "text") + ", " + FOUND
    every = None
    for items in blocks(benchmark, count):
        sent = spark.sparkContext.broadcast(items)
        found = kept.mapInPandas(_scanner(sent, window), schema)
        if count == 1:
            return found
        # The pass is written before the next block is read, so this one can go.
        found = stored(found, "pass")
        sent.destroy()
        every = found if every is None else every.unionByName(found)
    joined = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    merged = every.groupBy(*names).agg(
        F.first("n_words").alias("n_words"), joined("words").alias("words"),
        joined("items").alias("items"), joined("spans").alias("spans"),
    )
    return merged.withColumns({c: merge_intervals(c) for c in ("words", "spans")}).drop("_row")


def merge_intervals(column):
    """Sorted struct<first, last> arrays with overlapping neighbours joined."""
    kind = "array<struct<first: int, last: int>>"

    def step(done, one):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= one["first"])
        wider = F.struct(last["first"].alias("first"), F.greatest(last["last"], one["last"]).alias("last"))
        return F.when(
            joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))
        ).otherwise(F.concat(done, F.array(one)))

    return F.aggregate(column, F.array().cast(kind), step)


def digest(found):
    """n_hit, n_items, items_sha256 and contaminated of `find_overlap` rows."""
    hit = F.aggregate("words", F.lit(0), lambda n, w: n + w["last"] - w["first"])
    return found.select(
        "doc_id", "n_words", hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def clean(documents, benchmark, **settings):
    """Documents without a hit word, all columns and rows as they are."""
    texts = documents.select(uid().alias("uid"), "text")
    hits = stored_alone(
        documents.sparkSession,
        lambda: find_overlap(texts, benchmark, key=("uid",), **settings).filter(F.size("words") > 0).select("uid").distinct(),
        "hits",
    )
    return drop_rows(documents, hits)

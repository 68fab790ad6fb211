"""Phrase collocations by prefix-free parsing.

Texts are parsed into chunks that begin where the next characters hash to a trigger
value, so equal passages are cut at equal places wherever they stand. A chunk
holds the words up to the next trigger and the few after it that an n-gram may
reach; an n-gram belongs to the chunk in whose own part it begins, so no
occurrence counts twice. The distinct chunks with their frequencies replace the
texts: n-grams are counted inside each of them once, weighted.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.session import stored

LONGEST, LEAST, TRIGGER, KEEP = 3, 10, 48, 2000
SPLIT = b"."  # stands for every character that ends a piece; no word holds it
TOKEN_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else SPLIT[0] if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c
    for c in range(256)
)
BITS = 1 << 26
SHARES = 64  # of the phrases of a language, ranked apart before the last ranking
HELD = 1_000_000  # counts held by a task before they are sent on
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x):
    """One multiply and shift round on arrays of uint64."""
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def tokens_of(text):
    """Words of a text in order, SPLIT between pieces; A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TOKEN_BYTES).replace(SPLIT, b" . ").split()


class Numbers(dict):
    """Words numbered in the order in which they are first seen."""

    def __missing__(self, word):
        self[word] = value = len(self)
        return value


def chunks_of(text, longest=LONGEST, trigger=TRIGGER):
    """The chunks of a text; each ends with `longest` - 1 tokens of what follows it."""
    ahead = longest - 1
    tokens = tokens_of(text)
    if not tokens:
        return []
    whole = b" ".join([*tokens, *[SPLIT] * ahead])
    letters = np.frombuffer(whole + bytes(8), np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(letters[:len(whole)] == 32) + 1])
    own = starts[:len(tokens)]
    window = np.lib.stride_tricks.sliding_window_view(letters, 8)[own].view(np.uint64).ravel()
    first = np.flatnonzero(mixed(window * MULTIPLIER) % np.uint64(trigger) == 0)
    first = first if len(first) and first[0] == 0 else np.concatenate([[0], first])
    last = np.concatenate([first[1:], [len(tokens)]]) + ahead
    ends = np.concatenate([starts[1:] - 1, [len(whole)]])
    return [whole[i:j] for i, j in zip(starts[first].tolist(), ends[last - 1].tolist(), strict=True)]


def parse(documents, longest=LONGEST, trigger=TRIGGER):
    """lang, chunk and times: the dictionary of distinct chunks of all texts."""
    def run(batches):
        for batch in batches:
            counts = {}
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for chunk in chunks_of(text, longest, trigger):
                    counts[lang, chunk] = counts.get((lang, chunk), 0) + 1
            yield pd.DataFrame(
                [(lang, chunk.decode("utf-8", "replace"), n) for (lang, chunk), n in counts.items()],
                columns=["lang", "chunk", "times"],
            )

    parsed = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInPandas(
        run, "lang string, chunk string, times long"
    )
    return parsed.groupBy("lang", "chunk").agg(F.sum("times").alias("times"))


class Counts:
    """Weighted counts of n-grams in chunks of one language, by word numbers.

    `wanted` has the sizes with two bit tables each, or None: of grams of one
    word less that may be frequent, for a gram that holds a rare one is rare
    itself, and of grams of this size.
    """

    def __init__(self, lang, wanted, longest):
        self.lang, self.wanted, self.ahead = lang, wanted, longest - 1
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self.numbers, self.hashes = Numbers({SPLIT.decode(): 0}), np.zeros(1, np.uint64)
        self.held = [[] for _ in wanted]

    def marks(self, grams):
        value = np.full(len(grams), self.seed, np.uint64)
        for column in grams.T:
            value = mixed(value * MULTIPLIER + self.hashes[column])
        return value

    def add(self, chunks, times):
        """Count the n-grams that begin in each chunk's own part, less those that the bit tables rule out."""
        tokens = pc.split_pattern(pa.array(chunks, pa.large_string()), " ")
        coded = tokens.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        if len(self.numbers) > len(self.hashes):
            new = list(self.numbers)[len(self.hashes):]
            self.hashes = np.concatenate([self.hashes, np.array([xxhash.xxh64_intdigest(w) for w in new], np.uint64)])
        sizes = pc.list_value_length(tokens).to_numpy()
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(ids))
        begins = np.flatnonzero(left > self.ahead)
        weights = np.repeat(np.array(times, np.int64), sizes)[begins]
        for held, (size, inner, own) in zip(self.held, self.wanted, strict=True):
            grams = np.stack([ids[begins + i] for i in range(size)], axis=1)
            good = (grams > 0).all(axis=1)
            for bits, part in ((inner, slice(None, -1)), (inner, slice(1, None)), (own, slice(None))):
                if bits is not None:
                    good[good] = may_count(self.marks(grams[good][:, part]), bits)
            held.append(self.sums(grams[good], weights[good]))

    def sums(self, grams, totals):
        key = grams[:, 0]
        for column in grams.T[1:]:
            if key.max(initial=0) > 2**62 // len(self.numbers):
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(self.numbers) + column
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, back, totals)
        return grams[first], sums

    def size_held(self):
        return len(self.numbers) + sum(len(sums) for held in self.held for _, sums in held)

    def rows(self, texts, marks):
        words = list(self.numbers)
        for held in self.held:
            grams, totals = self.sums(*(np.concatenate(x) for x in zip(*held, strict=True)))
            out = {"lang": self.lang, "gram": [" ".join([words[i] for i in g]) for g in grams.tolist()]} if texts else {}
            if marks:
                out["mark"] = self.marks(grams).view(np.int64)
            if len(grams):
                yield pd.DataFrame(out | {"f": totals})


def may_count(marks, bits):
    """False where the mark is surely none of those in a bit table."""
    place = marks % np.uint64(BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def counted(dictionary, wanted, longest=LONGEST, texts=True, marks=False):
    """f of the `wanted` n-grams (see Counts) by lang and gram, by mark (a hash), or both."""
    shared = dictionary.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        held = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang", sort=False):
                counts = held.setdefault(lang, Counts(lang, shared.value, longest))
                counts.add(rows["chunk"].tolist(), rows["times"].tolist())
            if sum(c.size_held() for c in held.values()) > HELD:
                for counts in held.values():
                    yield from counts.rows(texts, marks)
                held.clear()
        for counts in held.values():
            yield from counts.rows(texts, marks)

    keys = {"lang": "string", "gram": "string"} if texts else {}
    keys |= {"mark": "long"} if marks else {}
    rows = dictionary.mapInPandas(run, ", ".join(f"{k} {kind}" for k, kind in keys.items()) + ", f long")
    return rows.groupBy(*keys).agg(F.sum("f").alias("f"))


def bit_table(grams):
    """Bits of the grams' marks: 8 MB at most, whatever their number.

    With very many grams it fills up and saves no more work; counts stay the same.
    """
    place = F.pmod("mark", F.lit(BITS)) + 1  # the first bucket begins at 1
    parts = grams.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map")
    ).collect()
    bits = np.zeros(BITS // 8, np.uint8)
    for r in parts:
        low = (r["bucket"] - 1) * 4096
        bits[low:low + 4096] = np.frombuffer(r["map"], np.uint8)
    return bits


def scored(grams, longest=LONGEST):
    """lang, phrase, a, l, r and score of every phrase, by its lowest-scoring cut.

    Products are decimals of 38 digits: exact up to counts of 10^16, an error beyond.
    """
    words = F.split("gram", " ")
    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = (
        grams.withColumn("words", words).filter(F.size("words") > 1)
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
        .select("lang", "gram", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("left"),
                part(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    )
    lefts = grams.select("lang", F.col("gram").alias("left"), F.col("f").alias("l"))
    rights = grams.select("lang", F.col("gram").alias("right"), F.col("f").alias("r"))
    whole = {c: f"cast({c} as decimal(16,0))" for c in "alr"}
    score = F.expr(f"({whole['a']} * {whole['a']} * 1000000) div ({whole['l']} * {whole['r']})")
    return (
        cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
        .groupBy("lang", F.col("gram").alias("phrase"), "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )


def inner_phrases(phrases):
    """lang, phrase and f of the most frequent longer phrase that holds it, of at least two words."""
    words = F.split("phrase", " ")
    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    inside = F.flatten(F.transform(sizes, lambda s: F.transform(
        F.sequence(F.lit(1), F.size("words") - s + 1), lambda i: F.array_join(F.slice("words", i, s), " ")
    )))
    return (
        phrases.withColumn("words", words).filter(F.size("words") > 2)
        .select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("f"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )


def collocations(documents, longest=LONGEST, least=LEAST, inside=50, keep=KEEP, trigger=TRIGGER):
    """lang, rank, phrase, a, l, r, n and score: the phrases of each language that bind most.

    Phrases have 2 to `longest` words of one piece and at least `least`
    occurrences, overlapping ones included. `score` is the least of 10^6 a^2 /
    (l r), rounded down, over the places a phrase can be cut at; a phrase goes
    where one longer phrase has `inside` percent of its occurrences. The first
    `keep` of each language stay, `n` counts all of its words.

    Null texts are empty, a null language is `und`. Repeated rows count each,
    ties are ordered by the phrase. Texts of any length are one row's work. A
    trigger only tells where chunks end; it changes no count. Other columns are
    left out, and an empty table gives no rows.
    """
    dictionary = stored(parse(documents, longest, trigger), "chunks")
    words = stored(counted(dictionary, [(1, None, None)], longest, marks=True), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = F.col("f") >= least
    bits, wanted = bit_table(words.filter(frequent)), []
    for size in range(2, longest):
        # Most grams are rare: hashes are counted first, texts only of those that come often enough.
        marks = counted(dictionary, [(size, bits, None)], longest, texts=False, marks=True)
        bits = bit_table(stored(marks.filter(frequent), "marks"))
        wanted.append((size, None, bits))
    grams = counted(dictionary, [*wanted, (longest, bits, None)], longest)
    often = stored(grams.filter(frequent), "grams").unionByName(words.filter(frequent).drop("mark"))
    phrases = stored(scored(often, longest), "phrases")
    covered = F.coalesce(100 * F.col("longer") >= inside * F.col("a"), F.lit(False))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The first of each share of a language first: no task ranks all phrases of a frequent one.
    share = Window.partitionBy("lang", "share").orderBy(*order)
    best = Window.partitionBy("lang").orderBy(*order)
    return (
        phrases.join(inner_phrases(phrases), ["lang", "phrase"], "left").filter(~covered)
        .withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
        .withColumn("rank", F.row_number().over(share)).filter(F.col("rank") <= keep)
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )

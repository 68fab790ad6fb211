"""Personal data: patterns for seeds, and contexts learned from them for the rest."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.session import stored

KINDS = ("email", "ip", "card", "phone")
#: Leftmost matches without overlap, written so that no text is scanned over and
#: over: a match starts where its run of characters starts or the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole run of digits with single blanks or hyphens between, of 16 to 19 digits.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": r"(?<!\S)\S*?[0-9@]\S*+",
    # Runs of digits joined by a blank, dot, hyphen or bracket; each starts where a run of digits does.
    "run": r"(?<![\p{L}\p{N}_])\+?\(?[0-9]++(?:(?:[\x20.-]|\)[\x20.-]?|[\x20.-]?\()[0-9]++(?![\p{L}_@]|[:/,][0-9]))++",
}
UNKNOWN = ("token", "run")  # matches that are no base spans
LEFT, RIGHT = 80, 40  # code points of context kept beside a match


def digits(text):
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn(text):
    places = F.reverse(F.split(digits(text), ""))
    doubled = F.transform(places, lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def passes(kind="kind", text="match"):
    """Whether a match of a kind holds; tokens always do."""
    parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.try_to_number(p, F.lit("999")), F.lit(0)) <= 255))
    count = F.length(digits(text))
    return (
        F.when(F.col(kind) == "ip", small)
        .when(F.col(kind) == "card", luhn(text))
        .when(F.col(kind) == "phone", count.between(8, 15))
        .otherwise(True)
    )


def matches(documents):
    """uid, kind, first, last, match and context words of every match of PATTERNS.

    A text cut at the matches gives the stretches between them, and running
    sums of both lengths the places in code points, end exclusive.
    """
    texts = documents.select(F.xxhash64("doc_id", "text").alias("uid"), "text").filter(F.col("text").rlike("[0-9@]"))
    found = F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), F.regexp_extract_all("text", F.lit(p), 0).alias("match"),
            F.transform(F.split("text", p), lambda s: F.struct(
                F.length(s).alias("size"), F.substring(s, -LEFT, LEFT).alias("tail"), F.substring(s, 1, RIGHT).alias("head"),
            )).alias("gap"),
        )
        for kind, p in PATTERNS.items()
    ])
    hits = texts.select("uid", F.explode(found).alias("f")).select("uid", "f.*").filter(F.size("match") > 0)
    rows = hits.select("uid", "kind", "gap", F.posexplode("match").alias("n", "match")).select(
        "uid", "kind", "n", "match", F.col("gap")[F.col("n")].alias("gap"),
        F.col("gap")[F.col("n") + 1]["head"].alias("head"),
    ).dropDuplicates(["uid", "kind", "n"])
    upto = Window.partitionBy("uid", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum(F.col("gap.size") + F.length("match")).over(upto).cast("int")
    words = F.regexp_extract_all(F.lower(F.col("gap.tail")), F.lit(r"[\p{L}\p{N}_]+"), 0)
    after = F.regexp_extract(F.lower("head"), r"^[^\p{L}\p{N}]*([\p{L}\p{N}_]+)", 1)
    return rows.withColumn("last", last).select(
        "uid", "kind", (F.col("last") - F.length("match")).alias("first"), "last", "match",
        F.coalesce(F.try_element_at(words, F.lit(-2)), F.lit("")).alias("before2"),
        F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit("")).alias("before1"), after.alias("after"),
    ).filter(passes())


def free_tokens(found):
    """Tokens and runs without a shared character with a base span, less the marks around them.

    Runs count with a blank (others are tokens) and 6 to 19 digits. Tokens that
    share a character with one have its text as `slot` and its place as `run`.
    """
    count = F.length(digits("match"))
    found = found.filter((F.col("kind") != "run") | (F.col("match").contains(" ") & count.between(6, 19)))
    base = ~F.col("kind").isin(*UNKNOWN)
    own = Window.partitionBy("uid").orderBy("first", "last", "kind")
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    later = own.rowsBetween(1, Window.unboundedFollowing)
    marked = found.withColumn("reach", F.max(F.when(base, F.col("last"))).over(earlier)).withColumn(
        "next", F.min(F.when(base, F.col("first"))).over(later)
    )
    free = marked.filter(
        ~base & (F.coalesce("reach", F.lit(0)) <= F.col("first")) & (F.coalesce("next", F.col("last")) >= F.col("last"))
    )
    lead = F.length(F.regexp_extract("match", r"^[^\p{L}\p{N}+]*", 0))
    core = F.regexp_replace("match", r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")
    token = F.col("kind") == "token"
    cut = free.withColumn("first", F.col("first") + F.when(token, lead).otherwise(0)).withColumn(
        "match", F.when(token, core).otherwise(F.col("match"))
    ).filter("match <> ''").withColumn("last", F.col("first") + F.length("match")).drop("reach", "next")
    # Runs do not overlap: one that shares a character is the last to start before, or the next to start.
    one = F.when(~token, F.struct("first", "last", "match"))
    near = cut.withColumn("prior", F.last(one, True).over(own.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "later", F.first(one, True).over(own.rowsBetween(0, Window.unboundedFollowing))
    )
    run = F.when(F.col("prior.last") > F.col("first"), F.col("prior")).when(F.col("later.first") < F.col("last"), F.col("later"))
    return near.withColumn("run", run).withColumn("slot", F.lower(F.coalesce("run.match", "match"))).drop("prior", "later")


def plausible(kind, text):
    """Whether an unknown token can be an identifier of a kind at all."""
    count = F.length(digits(text))
    return (
        F.when(kind == "email", text.contains("@"))
        .when(kind == "ip", text.rlike(r"^[0-9a-fA-F]+([.:][0-9a-fA-F]*){3,7}$"))
        .when(kind == "card", (count >= 12) & text.rlike(r"^[0-9\x20-]+$"))
        .otherwise((count >= 6) & (~text.contains(" ") | (count <= 15)) & text.rlike(r"^\+?[0-9().\x20-]+$"))
    )


def contexts(rows):
    """(pattern, instance, kind) edges: the two words before, and the words around."""
    two = F.when(F.col("before2") != "", F.concat_ws(" ", "before2", "before1", F.lit("_")))
    around = F.when((F.col("before1") != "") & (F.col("after") != ""), F.concat_ws(" ", "before1", F.lit("_"), "after"))
    return rows.withColumn("pattern", F.explode(F.array_compact(F.array(two, around)))).withColumn("instance", F.lower("match"))


def bootstrap(seeds, tokens, rounds=3, confidence=0.8, support=3):
    """Identifiers among `tokens` as (instance, kind, score).

    Each round scores a pattern for a kind by the summed scores of its known
    instances over all its instances plus one, and keeps patterns of at least
    `support` known ones; a token's score is what it gets from all patterns
    together (one minus the product of the misses). Tokens from `confidence` on
    are known in the next round. Scores are sums per pattern and per instance,
    so a frequent context is no hot group. A run and its tokens count as one
    instance of a pattern (`slot`).
    """
    known = contexts(seeds).withColumn("slot", F.col("instance"))
    edges = known.select("pattern", "instance", "slot", "kind").distinct().withColumn("known", F.lit(True))
    unknown = contexts(tokens).select("pattern", "instance", "slot", F.lit(None).cast("string").alias("kind")).distinct()
    edges = stored(edges.unionByName(unknown.withColumn("known", F.lit(False))), "contexts")
    sizes = edges.groupBy("pattern").agg(F.count_distinct("slot").alias("n"))
    new = None
    for _ in range(rounds):
        taught = edges.filter("known").select("pattern", "instance", "kind", F.lit(1.0).alias("score"))
        if new is not None:
            again = edges.filter("not known").select("pattern", "instance").distinct().join(new, "instance")
            taught = taught.unionByName(again.select("pattern", "instance", "kind", "score"))
        patterns = (
            taught.groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count(F.lit(1)).alias("seen"))
            .filter(F.col("seen") >= support).join(sizes, "pattern")
            .select("pattern", "kind", (F.col("sum") / (F.col("n") + 1)).alias("weight"))
        )
        miss = F.product(1 - F.col("weight"))
        scored = (
            edges.filter("not known").select("pattern", "instance").distinct().join(patterns, "pattern")
            .filter(plausible(F.col("kind"), F.col("instance")))
            .groupBy("instance", "kind").agg((1 - miss).alias("score")).filter(F.col("score") >= confidence)
        )
        best = F.max(F.struct("score", "kind"))
        new = stored(scored.groupBy("instance").agg(best.alias("b")).select("instance", "b.kind", "b.score"), "found")
    return new


def find_personal_data(documents, **learning):
    """Per row: doc_id, base and found spans as arrays of (place, kind, first, last).

    Base spans are the matches of PATTERNS that hold; found spans are tokens and
    spaced runs of digits whose contexts, learned from the base spans, make them
    identifiers too. A found run takes the place of the tokens it shares text with.
    `place` is the place of the kind in KINDS. Null and empty texts have no
    span; rows that repeat id and text get the same spans.
    """
    found = stored(matches(documents.select("doc_id", "text")), "matches")
    base = found.filter(~F.col("kind").isin(*UNKNOWN))
    tokens = stored(free_tokens(found).filter(F.length(digits("match")) + F.col("match").contains("@").cast("int") * 4 >= 4), "tokens")
    new = bootstrap(base, tokens, **learning)
    named = tokens.withColumnRenamed("kind", "form").withColumn("instance", F.lower("match"))
    hits = named.join(new.select("instance", "kind"), "instance")
    runs = hits.filter("form = 'run'").select("uid", F.col("first").alias("run_first"))
    held = F.when(F.col("form") == "token", F.col("run.first")).alias("run_first")
    more = hits.withColumn("run_first", held).join(runs, ["uid", "run_first"], "left_anti")
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(place.alias("place"), "kind", "first", "last")
    every = base.select("uid", span.alias("span"), F.lit(True).alias("base")).unionByName(
        more.select("uid", span.alias("span"), F.lit(False).alias("base"))
    )
    spans = every.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base_spans"),
        F.array_sort(F.collect_list("span")).alias("spans"),
    )
    none = F.array().cast("array<struct<place: int, kind: string, first: int, last: int>>")
    rows = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("uid"))
    return rows.join(spans, "uid", "left").select(
        "doc_id", F.coalesce("base_spans", none).alias("base_spans"), F.coalesce("spans", none).alias("spans")
    )


def digest(found):
    """Counts of base spans by kind, their digest, and all spans as text."""
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(shown("base_spans"), 256).alias("base_sha256"), shown("spans").alias("spans"),
        (F.size("spans") - F.size("base_spans")).cast("long").alias("n_found"),
    )

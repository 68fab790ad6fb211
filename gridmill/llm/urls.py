"""URL filters: host and path rules, and a classifier for the other URLs."""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridmill.llm.common import lower_ascii
from gridmill.session import stored

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_and_path(url):
    """Host and path columns of a URL; both empty for null or without `://`."""
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def with_rule(urls, rules=RULES):
    """`rule` and `rule_verdict` of the longest rule that fits host and path, else null.

    The rules are a short list of the caller, tried from the longest down.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        fits = own & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return urls.withColumns({"rule": rule, "rule_verdict": verdict})


def grams(text, n, mark):
    """Character n-grams of a column between bounds, each marked with its part."""
    whole = F.concat(F.lit("^"), text, F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(whole) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(whole, i, F.lit(n))))


def features(urls, sizes=(3, 4), width=1 << 14):
    """Hashed character n-grams of host and path; digits count as one letter."""
    path = F.regexp_replace("path", r"[0-9]+", "0")
    parts = [g for n in sizes for g in (grams(F.col("host"), n, "h:"), grams(path, n, "p:"))]
    made = urls.withColumn("_grams", F.array_distinct(F.concat(*parts)))
    hashing = HashingTF(numFeatures=width, inputCol="_grams", outputCol="features", binary=True)
    return hashing.transform(made).drop("_grams")


def train(labelled, bound=20_000, max_iter=30, penalty=1e-4):
    """A classifier from at most `bound` different labelled (host, path), block being 1.

    The bound is the one sampled part of this operator: the labelled table is
    meant to be small, and a larger one is cut to its lowest hashes. Returns the
    only label there is, or `allow` without any, where no model can be fitted.
    """
    picked = (
        labelled.select("host", "path", (F.col("rule_verdict") == "block").cast("double").alias("label"))
        .distinct().orderBy(F.xxhash64("host", "path"), "host", "path").limit(bound)
    )
    rows = stored(picked, "labelled-urls")
    found = {r[0] for r in rows.select("label").distinct().collect()}
    if len(found) < 2:
        return "block" if found == {1.0} else "allow"
    balance = rows.agg(F.avg("label")).first()[0]
    weight = F.when(F.col("label") == 1, 0.5 / balance).otherwise(0.5 / (1 - balance))
    model = LogisticRegression(maxIter=max_iter, regParam=penalty, weightCol="weight")
    return model.fit(features(rows.withColumn("weight", weight)))


def judge(pages, rules=RULES, labelled=None, threshold=0.5, **training):
    """host, path, rule, verdict and block_score beside the columns of `pages`.

    The longest rule that fits decides; other URLs get the verdict of logistic
    regression on character n-grams. It learns from `labelled` (url,
    rule_verdict), by default from the URLs of `pages` that the rules judge.
    Null and malformed URLs have an empty host and path and are judged like
    any other without a rule. Repeated rows stay. Columns of `pages` called
    like a result are replaced.
    """
    parts = dict(zip(("host", "path"), host_and_path(F.col("url")), strict=True))
    results = ["host", "path", "rule", "verdict", "block_score"]
    # The page is one column, so that no name of its own meets one of the model's.
    kept = F.struct(*[c for c in pages.columns if c not in results]).alias("page")
    own = with_rule(pages.select(kept, *[c.alias(name) for name, c in parts.items()]), rules)
    if labelled is None:
        taught = own.filter("rule_verdict is not null")
    else:
        taught = labelled.withColumns(parts)
    model = train(taught, **training)
    if isinstance(model, str):
        scored = own.withColumn("block_score", F.lit(1.0 if model == "block" else 0.0))
    else:
        scored = model.transform(features(own)).withColumn(
            "block_score", vector_to_array("probability")[1]
        )
    guess = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("rule_verdict", guess)).select("page.*", *results)

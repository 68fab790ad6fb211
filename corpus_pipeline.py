"""Training corpus from raw documents: five stages, each written and read again."""

from pyspark.sql import functions as F

from gridmill.llm import decontamination, lines, mixing, quality, similar
from gridmill.session import stored, table


def good_documents(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark, docs, sf_dir):
    """Documents less the lines seen earlier; one whose lines all go, goes too."""
    cut = lines.dedup_lines(docs).filter("n_lines = 0 or n_kept > 0").drop("n_lines", "n_kept")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_near_copies(spark, docs, sf_dir):
    """One document of each class of copies and near copies."""
    return similar.one_of_each(docs)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them, numbered by `copy`."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("n-gram jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
]

#: The first stage is a trained model, which SQL cannot repeat.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

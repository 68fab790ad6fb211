"""One query per operator over its whole table; `oracles` holds the SQL that repeats it."""

from pyspark.sql import functions as F

from gridmill.llm import (
    chats, codes, copies, decontamination, languages, lines, mixing, neighbours, personal, phrases, quality, similar, urls,
)
from gridmill.llm.oracles import ORACLES  # noqa: F401
from gridmill.session import table


def op1_line_dedup(spark, folder):
    return lines.dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_kept").cast("long").alias("n_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op2_decontaminate(spark, folder):
    found = decontamination.find_overlap(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.digest(found)


def op3_personal_data(spark, folder):
    return personal.digest(personal.find_personal_data(table(spark, folder, "documents")))


def op4_url_filter(spark, folder):
    return urls.judge(table(spark, folder, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


def op5_language_id(spark, folder):
    return languages.identify(table(spark, folder, "documents"))


def op6_chat_rotation(spark, folder):
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return chats.rotate(table(spark, folder, "conversations")).withColumn("mask", F.array_join(spans, ","))


def op7_quality(spark, folder):
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("uid")


def op8_jaccard_join(spark, folder):
    return similar.jaccard_join(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "n_links", "n_copies"
    )


def op9_top_k(spark, folder):
    return neighbours.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_mix(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source"
    )


def op11_vector_codes(spark, folder):
    return codes.compress(table(spark, folder, "embeddings")).drop("label")


def op12_collocations(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


def op13_near_duplicates(spark, folder):
    return copies.near_duplicates(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_decontaminate, op3_personal_data, op4_url_filter, op5_language_id, op6_chat_rotation, op7_quality,
    op8_jaccard_join, op9_top_k, op10_mix, op11_vector_codes, op12_collocations, op13_near_duplicates,
)}

"""Small helpers shared by the operators of this subpackage."""

import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.session import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of lower-cased text: letters, digits and everything beyond ASCII stay, the rest is a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def lower_ascii(column):
    """A-Z in lower case, all else as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def words_of(text):
    """Words of a text as UTF-8 bytes, see WORD_BYTES; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def joined_sha256(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def held_out(doc_id):
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id counts as ''."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3) == 1


def null_safe(*columns):
    """One struct as key: null parts compare equal in joins and groups."""
    return F.struct(*columns)


def ranked(df, order, name="position"):
    """Position from 0 along a total order, without sorting all rows in one task.

    Rows are dealt by range and numbered inside their partition; what comes
    before a partition is a sum over one row per partition.
    """
    spread = df.repartitionByRange(*order).withColumn("_deal", F.spark_partition_id())
    kept = stored(spread, "ranked")
    sizes = kept.groupBy("_deal").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_deal", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_deal").orderBy(*order)
    return (
        kept.withColumn("_in", F.row_number().over(inside) - 1)
        .join(starts, "_deal")
        .select(*df.columns, (F.col("_start") + F.col("_in")).alias(name))
    )


BITS_PER_ROW = 32_768  # what one value of bitmap_construct_agg covers


def key_bits(keys, column, bits=1 << 23):
    """Bit table of hashed keys: at most bits / 32,768 rows of 4 KB, whatever the input."""
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    return (
        keys.select(place.alias("_p"))
        .groupBy(F.bitmap_bucket_number("_p").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_map"))
    )


def may_hold(df, column, bit_table, bits=1 << 23, name="may_hold"):
    """False only where the key is surely not among those of `key_bits`.

    The bit table is broadcast: 1 MB for the standard 8 million bits. With very
    many keys it fills up and stops saving work, results stay the same.
    """
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    marked = df.withColumn("_p", place).withColumn("_bucket", F.bitmap_bucket_number("_p"))
    at = F.bitmap_bit_position("_p")
    byte = F.conv(F.hex(F.substring(F.col("_map"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return (
        marked.join(F.broadcast(bit_table), "_bucket", "left")
        .withColumn(name, F.coalesce(F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1, F.lit(False)))
        .drop("_p", "_bucket", "_map")
    )


def uid():
    """Hash of a document's id and text; rows that repeat both share it."""
    return F.xxhash64("doc_id", "text")


def drop_rows(documents, gone):
    """`documents` without the rows whose `uid` is in the stored frame `gone`.

    Texts of rows that surely stay are not shuffled. Columns pass through
    whatever their names are.
    """
    whole = documents.select(F.struct(*documents.columns).alias("row"), uid().alias("uid"))
    marked = may_hold(whole, "uid", key_bits(gone, "uid"), name="touched")
    rest = marked.filter("touched").join(gone.select("uid"), "uid", "left_anti")
    return marked.filter("not touched").select("row.*").unionByName(rest.select("row.*"))

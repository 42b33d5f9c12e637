"""Document fingerprints by consistent weighted sampling.

The terms of a document are its words, weighted by their counts. For each of SAMPLES samples, a term draws
r and c from the gamma distribution of shape 2 and b from the uniform one, all from a hash of the term, so that every
document draws the same. With t = floor(ln(weight) / r + b) the term's value is c * exp(-r * (t - b + 1)), and the
sample is the term and t of the least value. Two documents share a sample with a probability equal to the
generalised Jaccard similarity of their weighted words: sum of smaller over sum of larger counts. A value names its
term and t by itself, so a fingerprint is a list of hashes of least values.

Everything is DataFrame expressions. Words are counted and sampled in the stage that holds the document, so only whole
texts are shuffled, once for a document and half of it once more for its neighbour, and no key has more than a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.sources import materialise, table

SAMPLES = 32
WHITE = r"[ \t-\r]+"


def _uniform(bits: Column, shift: int, width: int) -> Column:
    """A number strictly between 0 and 1 from some bits of a long."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part + F.lit(0.5)) * F.lit(2.0**-width)


def sample_value(term: Column, log_weight: Column, sample: int) -> Column:
    """ln of the value that a term (a long) of this weight has in a sample."""
    one, two = F.xxhash64(term, F.lit(2 * sample)), F.xxhash64(term, F.lit(2 * sample + 1))
    r = -F.log(_uniform(one, 0, 32) * _uniform(one, 32, 32))
    log_c = F.log(-F.log(_uniform(two, 0, 21) * _uniform(two, 21, 21)))
    b = _uniform(two, 42, 22)
    return log_c - r * (F.floor(log_weight / r + b) - b + F.lit(1.0))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal samples; no words have the samples of no words."""
    equal = F.aggregate(F.zip_with(one, other, lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x)
    return equal / F.size(one)


def signatures(texts: DataFrame, key: list[str], samples: int = SAMPLES) -> DataFrame:
    """``key`` and signature, an array of ints, from the key and text of rows that the key identifies.

    A text without words has zeros only. Rows that are already dealt by a part of the key are not shuffled.
    """
    words = texts.select(*key, F.explode_outer(F.split(F.col("text"), WHITE)).alias("_word"))
    terms = words.select(*key, F.when(F.col("_word") != "", F.xxhash64("_word")).alias("_term"))
    counts = terms.groupBy(*key, "_term").agg(F.count("_term").alias("_n"))
    weighted = counts.select(*key, "_term", F.when(F.col("_n") > 0, F.log("_n")).alias("_log"))
    least = weighted.groupBy(*key).agg(
        *[F.min(F.when(F.col("_term").isNotNull(), sample_value(F.col("_term"), F.col("_log"), i))).alias(f"_{i}")
          for i in range(samples)]
    )
    hashes = [F.coalesce(F.xxhash64(f"_{i}").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"), F.lit(0)) for i in range(samples)]
    none = F.array_repeat(F.lit(0), samples)
    return least.select(*key, F.when(F.col("_0").isNull(), none).otherwise(F.array(*hashes)).alias("signature"))


def next_ids(docs: DataFrame) -> DataFrame:
    """doc_id, next_id and half of every distinct doc_id: the next in ascending order, after the last the first.

    half is half the length of its longest text. The identifiers are dealt by range and numbered within a range; only
    one row per range meets in one task.
    """
    ids = docs.groupBy("doc_id").agg(F.max(F.floor(F.char_length("text") / 2)).cast("int").alias("half"))
    placed = materialise(ids.repartitionByRange("doc_id").withColumn("slice", F.spark_partition_id()), "ids")
    slices = placed.groupBy("slice").agg(F.min("doc_id").alias("first"))
    everything = Window.orderBy("slice")
    following = slices.select(
        "slice",
        F.coalesce(F.lead("first").over(everything), F.first("first").over(everything)).alias("following"),
    )
    inside = Window.partitionBy("slice").orderBy("doc_id")
    return placed.withColumn("next", F.lead("doc_id").over(inside)).join(F.broadcast(following), "slice").select(
        "doc_id", "half", F.coalesce("next", "following").alias("next_id")
    )


def with_edited(docs: DataFrame, nexts: DataFrame) -> DataFrame:
    """doc_id, text and edited: the last half of the text replaced by as much of the beginning of the next document."""
    heads = (
        docs.join(nexts.select(F.col("doc_id").alias("for_id"), "half", F.col("next_id").alias("doc_id")), "doc_id")
        .select("for_id", F.substring("text", F.lit(1), F.col("half")).alias("head"))
        .groupBy("for_id").agg(F.min("head").alias("head")).withColumnRenamed("for_id", "doc_id")
    )
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    kept = F.substring("text", F.lit(1), n - half)
    return docs.join(heads, "doc_id").select(
        "doc_id", "text", F.concat(kept, F.substring("head", F.lit(1), half)).alias("edited")
    )


def fingerprinted(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    A null or empty text has no words; two such texts are alike (1) and unlike any other (0). Repeated rows come out
    each. Where a doc_id is repeated, the edited text of the document before takes the least of the beginnings, and
    near_next is the highest likeness. A row without a doc_id has no place in the order: its edited text is its text
    and near_next is null. Other columns are not read; no rows give no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = docs.filter("doc_id IS NOT NULL")
    nexts = next_ids(placed)
    unplaced = docs.filter("doc_id IS NULL").select(F.xxhash64("text").alias("deal"), "text", F.col("text").alias("edited"))
    without_id = _signed(unplaced.repartition("deal"), "deal", samples)
    signed = _signed(with_edited(placed, nexts), "doc_id", samples).unionByName(
        without_id.withColumn("doc_id", F.lit(None).cast("long")).drop("deal")
    )
    signed = materialise(signed, "signatures")
    following = signed.select(F.col("doc_id").alias("next_id"), F.col("signature").alias("next_signature")).distinct()
    near_next = (
        signed.select("doc_id", "text_key", "signature").distinct().join(nexts.select("doc_id", "next_id"), "doc_id")
        .join(following, "next_id").groupBy("doc_id", "text_key")
        .agg(F.max(likeness(F.col("signature"), F.col("next_signature"))).alias("near_next"))
    )
    return signed.join(near_next, ["doc_id", "text_key"], "left").select(
        "doc_id", "n_chars", "edited_sha256", _text(F.col("signature")).alias("fingerprint"),
        _text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("changed")).alias("near_edited"), "near_next",
    )


def _signed(rows: DataFrame, by: str, samples: int) -> DataFrame:
    """``by``, text_key, n_chars, edited_sha256, signature and changed of every row, from ``by``, text and edited.

    The rows are dealt by ``by``, which every grouping and the join have in their keys, so no term is shuffled, and the
    two branches share the shuffle of the texts.
    """
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("text")) for k, c in enumerate(("text", "edited"))]
    versions = rows.dropDuplicates([by, "text_key"]).select(by, "text_key", F.explode(F.array(*kinds)).alias("version"))
    each = signatures(versions.select(by, "text_key", "version.kind", "version.text"), [by, "text_key", "kind"], samples)
    both = each.groupBy(by, "text_key").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("signature"))).alias(c) for k, c in enumerate(("signature", "changed"))]
    )
    lengths = rows.select(
        by, "text_key", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256")
    )
    return lengths.join(both, [by, "text_key"])


def _text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprinted(table(spark, folder, "documents", "doc_id", "text"))


QUERIES = {"op2_fingerprints": op2_fingerprints}
ORACLES: dict[str, str] = {}

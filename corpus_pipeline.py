"""A corpus pipeline: documents in, token digests out.

STAGES run in order. Each is written as Parquet in the shared folder and reread as the documents of the next, so a lost
executor costs no more than its part of a stage. With a folder of its own a run can be resumed after its driver was lost
too, and deletes a stage once the next is there.

Every stage takes a table without rows, and then has none. Columns beyond those of documents are left out. A null text
counts as an empty one and stays null; repeated rows are rows of their own unless a stage says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.byte_bpe import corpus_digests
from almanac.llm.line_dedup import line_deduplicated
from almanac.llm.mixing import mixture
from almanac.llm.simhash import near_deduplicated
from almanac.llm.toxicity import graded, train
from almanac.sources import Run, Stage, materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the limit. The model is trained on those of them with a label.

    Rows without text or doc_id are graded like others, and an empty text is not toxic. Equal rows share their fate. Without
    labels of both kinds all stay.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    return graded(docs, model, keep=COLUMNS).filter("NOT toxic").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template an earlier one has; n_chars is that of the text left.

    Earlier is the smaller doc_id; rows without one are one document after all others, rows of one doc_id one document. So
    equal rows come out equal, and a null or empty text as it is. A document may lose all of its text, but no row goes.
    """
    found = line_deduplicated(docs.select(*COLUMNS))
    length = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id; a row without one only where none has one.

    Texts without words are copies of each other, so one of them stays. Of several rows of that doc_id the least text, then
    the least of the other columns, stays; of equal rows one.
    """
    return near_deduplicated(docs.select(*COLUMNS), spare_null_ids=False)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times.

    Texts without words are in no mix. A null source is a source of its own, the last. Of equal rows each comes equally
    often.
    """
    return mixture(docs.select(*COLUMNS))


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document: doc_id, n_tokens, ids_sha256 and decoded_sha256. A row for each row, nulls as empty texts."""
    return corpus_digests(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", without_near_copies),
    ("mixing", mixed_sources),
    ("byte-level bpe", token_digests),
]

# No SQL: the stages need a fitted model, XXH64 fingerprints and a tokenizer. tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Apply the stages to the documents. In a ``folder`` the run goes on where an earlier one, of the same tables, stopped."""
    if folder:
        return resumable(spark, sf_dir, folder).result()
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def resumable(spark: SparkSession, sf_dir: str, folder: str) -> Run:
    """The stages as a run; ``close()`` it when its result is no longer read."""
    stages, before = [], "documents"
    for name, stage in STAGES:
        made = Stage(name.replace(" ", "-"), _built(stage, spark, sf_dir), (before, "labels"))
        stages.append(made)
        before = made.name
    sources = {name: f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("documents", "labels")}
    return Run(spark, folder, stages, sources)


def _built(stage, spark: SparkSession, sf_dir: str):
    return lambda docs, labels: stage(spark, docs, sf_dir)

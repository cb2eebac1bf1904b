"""Token counts from a digest cache.

A count depends on the text and the tokenizer version only. Both have a digest (SHA-256 of the
text as it goes to the tokenizer; of the vocabulary file and the library's version). Stored counts
are joined by it, and only distinct texts without one are encoded and appended.

The tokenizers normalise by themselves, so the only step before the digest is null to empty: any
other would change counts. Copies within a scan task are dropped before the texts are shuffled, so
a text with many copies sends one from each task. Two loads at a time may store a text twice with
the same count; readers take one. Equal rows get equal counts, an empty table an empty result, and
columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.frames import others
from stardw.llm.vocabularies import Vocabulary
from stardw.llm.words import blocks
from stardw.session import cut_lineage, scratch_dir

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
CACHE = "digest binary, n_bytes long, n_tokens long, version string"


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The counts of one tokenizer version, one row for each text; none without a cache."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return (rows.filter(F.col("version") == version)
            .select("digest", "n_bytes", "n_tokens").dropDuplicates(["digest"]))


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each digest in the task; it remembers the digests, not the texts."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for digest in batch.column("digest").to_pylist():
            fresh.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _encoder(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(_first_of_task(batches)):
            texts = batch.column("text")
            counts = [len(ids) for ids in sent.value.encode(texts.to_pylist())]
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[
                texts.offset:texts.offset + len(texts) + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["digest", "n_bytes", "n_tokens"])
    return run


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text as it goes to the tokenizer and its ``digest``."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    clash = {"digest", "n_bytes", "n_tokens", text}
    return docs.select(*others(docs, clash), own.alias("text"),
                       F.unhex(F.sha2(own, 256)).alias("digest"))


def fill(docs: DataFrame, cache: str, vocabulary: Vocabulary, *, text: str = "text") -> None:
    """Encode the distinct texts that the cache doesn't know and append their counts."""
    spark = docs.sparkSession
    prepare(spark)
    texts = keyed(docs, text).select("digest", "text")
    texts = texts.mapInArrow(_first_of_task, texts.schema).repartition("digest")
    known = stored(spark, cache, vocabulary.digest)
    misses = texts.join(known, "digest", "left_anti")
    sent = spark.sparkContext.broadcast(vocabulary)
    (misses.mapInArrow(_encoder(sent), "digest binary, n_bytes long, n_tokens long")
     .withColumn("version", F.lit(vocabulary.digest))
     .write.mode("append").partitionBy("version").parquet(cache))


def count_tokens(docs: DataFrame, cache: str, vocabulary: Vocabulary, *, text: str = "text",
                 ) -> DataFrame:
    """``docs`` without the text, with ``n_bytes`` and ``n_tokens`` of it."""
    fill(docs, cache, vocabulary, text=text)
    rows = keyed(docs, text).drop("text")
    known = stored(docs.sparkSession, cache, vocabulary.digest)
    known = cut_lineage(known.join(rows.select("digest"), "digest", "left_semi"), "counts")
    # A left join of two shuffled sides: adaptive execution splits the rows of a frequent text.
    return rows.join(known, "digest", "left").drop("digest")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = count_tokens(docs, scratch_dir(spark, "token-cache"), Vocabulary.public(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens",
                          (F.col("n_tokens") > LIMIT).alias("over_limit"))


QUERIES = {"op3_token_counts": op3_token_counts}

"""Token counts with a digest cache.

Texts are known by a digest of their normalised content, tokenizers by a digest of their file and
library version. Counts that the cache holds are joined; of the others each distinct content is
encoded once, on the executors, and appended to the cache.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import mapped, picked, table
from lakewright.session import shared_folder, written

CACHE_SCHEMA = "content binary, n_tokens long, tokenizer string"

#: Pieces whose counts a worker remembers before it starts anew.
REMEMBERED = 300_000


def tokenizer_digest(path: str) -> str:
    """Of the file's content and of the library's version: another version is another tokenizer."""
    import sentencepiece
    import tokenizers

    version = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    return hashlib.sha256(Path(path).read_bytes() + version.encode()).hexdigest()


def spaces_collapsed(text: Column) -> Column:
    """Runs of ASCII white space as one space, none at the ends. Keeps the count of any tokenizer
    for which white space only separates."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\x0b\f\r]+", " "))


class _Counts(dict):
    """Token counts of pieces of text, encoded on first sight."""

    def __init__(self, encode: Callable[[list[str]], list[int]]):
        super().__init__()
        self.encode = encode

    def learn(self, pieces: Iterable[bytes]) -> None:
        new = [p for p in set(pieces) if p not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(set(pieces))
        if new:
            self.update(zip(new, self.encode([p.decode() for p in new])))


def _encoder(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


_loaded: dict[str, _Counts] = {}


def _count(path: str, texts: list[str], by_word: bool) -> list[int]:
    if path not in _loaded:
        _loaded[path] = _Counts(_encoder(path))
    counts = _loaded[path]
    if not by_word:
        return counts.encode(texts)
    out = []
    for text in texts:
        words = text.encode().split()  # bytes split at ASCII white space only
        counts.learn(words)
        out.append(sum(map(counts.__getitem__, words)))
    return out


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache's rows; no rows where nothing has been written yet."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(place):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def token_counts(
    df: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    by_word: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` of every row; rows with the same id stay separate.

    ``by_word`` is for tokenizers to which white space only separates tokens and no special string
    holds white space: texts that differ in white space share a count, and words are encoded once
    per worker. A null text counts as empty, a null id is kept. An empty table gives no rows.
    The cache is a Parquet folder partitioned by tokenizer; several writers may add the same
    content, which is read as one.
    """
    spark = df.sparkSession
    tokenizer = tokenizer_digest(tokenizer_path)
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = picked(df, doc_id=id_column, text=text_column).select("doc_id", content.alias("text"))
    digest = F.unhex(F.sha2(spaces_collapsed(F.col("text")) if by_word else F.col("text"), 256))
    keyed = written(rows.select("doc_id", digest.alias("content"), F.octet_length("text").cast("long").alias("n_bytes")))

    def known() -> DataFrame:
        mine = read_cache(spark, cache_path).filter(F.col("tokenizer") == tokenizer)
        return mine.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    # One row stands for each content that is not in the cache; only its text is sent on.
    misses = (
        keyed.groupBy("content").agg(F.min("doc_id").alias("first_id"))
        .join(known().select("content"), "content", "left_anti")
    )
    texts = rows.join(misses, rows["doc_id"].eqNullSafe(misses["first_id"]))
    # An id that is used twice brings texts of another content; they are told apart by the digest.
    texts = texts.filter(F.col("content") == digest).select("content", "text")
    counted = mapped(
        texts,
        lambda columns: zip(columns[0], _count(tokenizer_path, columns[1], by_word)),
        "content binary, n_tokens long",
    )
    counted.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    return keyed.join(known(), "content", "left").select("doc_id", "n_bytes", "n_tokens")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cache = f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}"
    counts = token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache, by_word=True
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


QUERIES = {"op2_token_counts": (op2_token_counts, None)}

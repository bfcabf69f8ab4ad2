"""Token counts from pre-tokens.

The SentencePiece model has no piece with a space after another character and none with a
line feed, so a text's pieces are those of its pre-tokens one after another: runs of
spaces with the characters up to the next space or line feed, and line feeds by
themselves. The number of pieces is found once per distinct pre-token of the corpus and
joined to the pre-token frequencies of each document; no ids are made.

1. All texts: each task counts its pre-tokens, Spark sums the counts.
2. Each distinct pre-token is encoded once.
3. All texts again: the ``HEAD`` most frequent pre-tokens of up to ``LONG`` characters, a
   bounded table, are joined inside the tasks; what is left of a document goes out as (pre-token, frequency) and is
   joined by a shuffle, where no pre-token is frequent any more.

Defined results: null text counts as empty (0 tokens); rows with equal or null ``doc_id``
are kept, each with its own counts; other columns are dropped. No documents, no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, narrow_batches, read_table, salt_of, staged, worker_cache

MODEL = "piece_bpe_32k.model"
HEAD = 1 << 18
LIMIT = 4096
LONG = 64
SALTS = 32
MOST_HELD = 200_000  # pre-tokens that a task counts before it hands them on
MOST_CHARS = 32_000_000  # of texts that it counts before
SPACE = "▁"  # the model's sign for a space; in a text it is one
_PRE_TOKENS = re.compile(rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def pre_tokens(text: str | None) -> list[str]:
    """The library puts a space before every text but the empty one."""
    return _PRE_TOKENS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def processor(path: str | None = None) -> sentencepiece.SentencePieceProcessor:
    return worker_cache(f"pieces {path}", lambda: sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL)))


def pieces_of(words: list[str], path: str | None = None) -> list[int]:
    """The number of pieces of each pre-token. A line feed in front keeps the library's
    own space apart; both are pieces of their own."""
    return [len(ids) - 2 for ids in processor(path).encode(["\n" + w for w in words], num_threads=1)]


def corpus_pre_tokens(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        chars = 0

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column("text"):
                held.update(pre_tokens(text := text.as_py()))
                chars += len(text or "")
                if len(held) > MOST_HELD or chars > MOST_CHARS:
                    yield out()
                    chars = 0
        if held:
            yield out()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def with_pieces(words: DataFrame, path: str | None = None) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = pa.array(pieces_of(batch.column("word").to_pylist(), path), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pieces], names=["word", "n", "pieces"])

    return words.mapInArrow(encode, "word string, n long, pieces long")


def frequent(words: DataFrame, most: int = HEAD) -> DataFrame:
    """The words of at most ``LONG`` characters of the highest frequency classes (sixteen to
    each doubling) that together have at most ``most`` words. The classes are counted, the
    words not sorted."""
    words = words.where(F.length("word") <= LONG)
    level = F.floor(F.log2("n") * 16).cast("int")
    classes = words.groupBy(level.alias("level")).count().collect()  # sixteen for each doubling of n
    least, total = None, 0
    for row in sorted(classes, key=lambda r: -r["level"]):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    return words.where(F.lit(False) if least is None else level >= least)


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of documents (doc_id, text)."""
    spark = docs.sparkSession
    narrow_batches(spark)
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    words = staged(with_pieces(corpus_pre_tokens(plain), path), "pre-tokens")
    top = frequent(words).select("word", "pieces").toArrow()  # HEAD rows at most
    head = spark.sparkContext.broadcast(dict(zip(top.column("word").to_pylist(), top.column("pieces").to_pylist(), strict=True)))
    tail = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        for whole in batches:
            for batch in by_size(whole, "text"):
                sizes, sums, rest = [], [], []
                for text in batch.column("text"):
                    text = text.as_py()
                    found = pre_tokens(text)
                    pieces = list(map(known.get, found))
                    sizes.append(len(text.encode()) if text else 0)
                    sums.append(sum(filter(None, pieces)))
                    left = Counter(w for w, p in zip(found, pieces, strict=True) if p is None) if None in pieces else {}
                    rest.append([{"word": w, "n": n} for w, n in left.items()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, tail)], names=["doc_id", "n_bytes", "n_head", "tail"])

    schema = "doc_id long, n_bytes long, n_head long, tail array<struct<word:string,n:long>>"
    found = staged(plain.mapInArrow(join, schema).withColumn("row", F.monotonically_increasing_id()), "frequencies")
    rare = found.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    # Words of at most LONG characters are rarer than the head's; a longer one may be in many
    # documents, whose rows are dealt over salts.
    known = words.select("word", "pieces")
    short = rare.where(F.length("word") <= LONG).join(known.where(F.length("word") <= LONG), "word").select("row", "n", "pieces")
    salted = rare.where(F.length("word") > LONG).withColumn("salt", salt_of(SALTS, "row"))
    met = salted.select("word", "salt").distinct().join(known.where(F.length("word") > LONG), "word")
    long = salted.join(met, ["word", "salt"]).select("row", "n", "pieces")
    sums = short.unionByName(long).groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("n_tail"))
    joined = found.select("row", "doc_id", "n_bytes", "n_head").join(sums, "row", "left")
    return joined.select("doc_id", "n_bytes", (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_tokens"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(read_table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)

"""Language identification by compression.

Each language has a zstandard dictionary of raw content: texts of that language, up to
``DICTIONARY_BYTES``. A text is compressed with every dictionary and gets the language of
the smallest result. As a dictionary saves a roughly fixed number of bytes, texts are
compressed in blocks of ``BLOCK`` bytes, each with the dictionary, and the results' sizes
are summed, so that a long text's margin is that of its blocks. ``score`` is the share by which the runner-up is larger, i.e.
1 - smallest / second (1 if only one language is known); below ``MARGIN`` the text is
rejected, its prediction standing all the same.

The dictionaries are all that is learned, and all labelled rows outside the held-out ones
count: tasks count their words, and a dictionary holds the words that cover most bytes of
its language (count times length), the best last, where zstandard's matches are cheapest.
Words over ``LONGEST`` letters, as in scripts without spaces, count as pieces of
``PIECE`` letters. A language whose texts have no more than ``DICTIONARY_BYTES`` letters
has all these texts for its dictionary. The driver sees the dictionaries' words, some
hundred sums a language, and no other texts.

Defined results: null text, or a text without a letter, is ``und`` with score 0 and
rejected, and so is every text if no labelled document exists. Equal sizes: the
alphabetically first language, rejected. Rows with equal or null ``doc_id`` are kept; a
null id is not held out and not learned from; repeated rows count as often. Texts are predicted whole. Other columns
stay (in ``identify``, those named as its results are replaced; in ``keep_identified``, none).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_size, drop_cache, free_names, narrow_batches, read_table, staged

DICTIONARY_BYTES = 128 * 1024
BLOCK = 8 * 1024
LEVEL = 6
MARGIN = 0.004
LONGEST, PIECE = 24, 8
COUNTED_AT_ONCE = 200_000  # different words that a task holds
UNKNOWN = "und"


_WORDS = re.compile(r"[^\W\d_]+")


def letters(text: str) -> bytes:
    """The text's words of letters in lower case, single spaces between: other marks
    would break the matches."""
    return f" {' '.join(_WORDS.findall(text.lower()))} ".encode()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_counts(known: DataFrame) -> DataFrame:
    """(lang, word, n) of all rows (lang, text); the word ``""`` has the language's bytes of
    letters, single spaces included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        totals: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            columns: tuple[list, list, list] = ([], [], [])
            for lang, words in totals.items():
                for word in [w for w in words if len(w) > LONGEST]:
                    n = words.pop(word)
                    for k in range(0, len(word) - PIECE // 2, PIECE // 2):
                        words[word[k : k + PIECE]] += n
                for column, values in zip(columns, ([lang] * len(words), words.keys(), words.values()), strict=True):
                    column.extend(values)
            totals.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "word", "n"])

        for whole in batches:
            for batch in by_size(whole, "text"):
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    words, held = _WORDS.findall(text.lower()), totals.setdefault(lang, Counter())
                    held.update(words)
                    held[""] += len(" ".join(words).encode()) + 2
                if sum(map(len, totals.values())) > COUNTED_AT_ONCE:
                    yield out()
        if totals:
            yield out()

    return known.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame) -> dict[str, list[str]]:
    """Of each language the words that cover most bytes, best first: ``DICTIONARY_BYTES`` of
    them, with a space each, or all if these are fewer. Words of least value go by a few
    hundred classes of it first, so that no task orders all words."""
    size = F.octet_length("word") + 1
    valued = counts.where("word <> ''").withColumn("_size", size).withColumn("_value", F.col("n") * F.col("_size"))
    valued = valued.withColumn("_class", F.floor(8 * F.log2("_value")).cast("int"))
    held, least = {}, {}
    for row in sorted(valued.groupBy("lang", "_class").agg(F.sum("_size").alias("bytes")).collect(), key=lambda r: -r["_class"]):
        if held.get(row["lang"], 0) < DICTIONARY_BYTES:
            least[row["lang"]] = row["_class"]
        held[row["lang"]] = held.get(row["lang"], 0) + row["bytes"]
    if not least:
        return {}
    classes = counts.sparkSession.createDataFrame(sorted(least.items()), "lang string, _least int")
    best = Window.partitionBy("lang").orderBy(F.desc("_value"), "word")
    chosen = valued.join(F.broadcast(classes), "lang").where("_class >= _least").withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= DICTIONARY_BYTES // 2)
    words: dict[str, list[str]] = {}
    for row in sorted(chosen.select("lang", "word", "_n").collect(), key=lambda r: (r["lang"], r["_n"])):
        words.setdefault(row["lang"], []).append(row["word"])
    return words


def letters_of(known: DataFrame) -> DataFrame:
    """(lang, data) of rows (lang, text): their letters."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        for whole in batches:
            for batch in by_size(whole, "text"):
                data = pa.array([letters(t.as_py()) for t in batch.column("text")], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("lang"), data], names=["lang", "data"])

    return known.select("lang", "text").mapInArrow(work, "lang string, data binary")


def language_samples(docs: DataFrame) -> dict[str, bytes]:
    """The dictionary of each language that documents (doc_id, text, lang) outside the
    held-out rows name."""
    narrow_batches(docs.sparkSession)
    known = docs.select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}")
    )
    counts = staged(word_counts(known), "words")
    sizes = {r["lang"]: r["n"] for r in counts.where("word = ''").collect()}  # a row a language
    short = [lang for lang, n in sizes.items() if n <= DICTIONARY_BYTES]
    parts: dict[str, list[bytes]] = {lang: [] for lang in sorted(sizes)}
    if short:
        for row in sorted(letters_of(known.where(F.col("lang").isin(short))).collect()):  # DICTIONARY_BYTES a language
            parts[row["lang"]].append(bytes(row["data"]))
    for lang, words in frequent_words(counts.where(~F.col("lang").isin(short))).items():
        data = f" {' '.join(reversed(words))} ".encode()
        parts[lang] = [(data * (DICTIONARY_BYTES // len(data) + 1))[-DICTIONARY_BYTES:]]  # few words are said again
    return {lang: b"".join(texts) for lang, texts in parts.items()}


class Compressors:
    """One compressor a language, made once a Python worker."""

    def __init__(self, samples: dict[str, bytes]):
        self.of = {}
        for lang in sorted(samples):
            content = zstandard.ZstdCompressionDict(samples[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.of[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.of or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = letters(text)
        blocks = [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.of.items())
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], 1 - sizes[0][0] / sizes[1][0]


RESULTS = ("lang_pred", "score", "rejected")


def predict_languages(rows: DataFrame, samples: dict[str, bytes], results: tuple[str, ...] = RESULTS) -> DataFrame:
    """(doc_id, text) with lang_pred, score and rejected, under the names of ``results``;
    ``rows`` may have other columns."""
    shared = rows.sparkSession.sparkContext.broadcast(samples)
    own: list[Compressors] = []
    kept = [c for c in rows.columns if c not in results]
    fields = [f for f in rows.schema.fields if f.name in kept]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        for whole in batches:
            if not own:
                own.append(Compressors(shared.value))
            for batch in by_size(whole, "text"):
                found = [own[0].predict(t.as_py()) for t in batch.column("text")]
                columns = [batch.column(c) for c in kept]
                columns += [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64()), pa.array([x == UNKNOWN or s < MARGIN for x, s in found], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *results])

    narrow_batches(rows.sparkSession)
    schema = type(rows.schema)(fields)
    for name, kind in zip(results, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return rows.select(*kept).mapInArrow(work, schema)


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang and others) with lang_pred, score and rejected."""
    return predict_languages(docs, language_samples(docs))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with its own columns, whatever their names."""
    results = free_names(docs, *RESULTS)
    return predict_languages(docs, language_samples(docs), tuple(results)).where(~F.col(results[-1])).select(*docs.columns)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = predict_languages(docs.select("doc_id", "text"), language_samples(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")

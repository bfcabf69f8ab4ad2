"""Phrase collocations by vertical positional inverted lists.

A block is some megabytes of one language's documents. It has an inverted list for each
different word: the ascending places at which it stands; places count on over pieces and
documents, with a gap between them, so that neighbours of one piece alone are one apart.
Phrases grow by a word at a time: the list of a phrase is merged with the list of the place
after each of its places, and what both hold is the longer phrase's list. Its length is the
phrase's exact frequency in the block; blocks' frequencies add up. A block's merges are done
at once: its lists in the order of their places. Blocks are made where documents are read,
once for each length of phrase; lists never leave them, only counts do.

Only phrases of ``LEAST`` occurrences need be extended, and only by phrases that are as
frequent themselves. Which these are every task learns from a Bloom filter of the frequent
words, then pairs: of at most ``MOST_BITS`` bits, whatever the vocabulary. What it lets pass
by mistake costs a count and changes none, as a frequent phrase has frequent parts only.
A word's key is a 64-bit hash of language and word, which no other word of the corpus has:
that is looked up, and another seed taken if it is not so.

Scores are integers of decimals of 38 digits, divided exactly. The first ``MOST`` of a
language are taken from the first of each of its salts.

Defined results: null text is empty, null lang ``und``. Repeated rows count as often as they
are there. Ids and other columns play no part. No documents or no frequent phrase, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import narrow_batches, read_table, salt_of, staged
from .minhash import mixed

LEAST = 10
MOST = 2000
BLOCK_BYTES = 8_000_000
MOST_BITS = 1 << 29
SALTS = 32
BREAK = "\n"  # of pieces; no word holds it
Lists = tuple[np.ndarray, np.ndarray]  # places in ascending order, and what stands at each


def inverted_lists(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, how often each occurs, and their places, word by
    word, ascending for each."""
    plain = pc.ascii_lower(pa.array([t + BREAK for t in texts], pa.string()))
    apart = pc.replace_substring(pc.replace_substring_regex(plain, r"[.,;:!?\n-\r]", f" {BREAK} "), "\t", " ")
    tokens = pc.split_pattern(apart, " ").flatten()
    tokens = tokens.filter(pc.not_equal(tokens, "")).dictionary_encode()
    codes, is_break = tokens.indices.to_numpy(), pc.equal(tokens.dictionary, BREAK).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable").astype(np.int32)
    counts = np.bincount(codes, minlength=len(is_break))
    keep = ~is_break
    return tokens.dictionary.filter(pa.array(keep)), counts[keep], order[np.repeat(keep, counts)]


def keys_of(lang: str, words: pa.Array, seed: int) -> np.ndarray:
    """Each word's key, as a signed number."""
    begin = lang.encode() + b"\0"
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(begin + w.as_buffer().to_pybytes(), seed) for w in words.cast(pa.binary())], np.uint64).view(np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """(lang, texts): some megabytes of one language at a time."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] > BLOCK_BYTES:
                sizes.pop(lang)
                yield lang, held.pop(lang)
        while sum(sizes.values()) > 2 * BLOCK_BYTES:
            lang = max(sizes, key=sizes.__getitem__)
            sizes.pop(lang)
            yield lang, held.pop(lang)
    yield from held.items()


def plain_documents(docs: DataFrame) -> DataFrame:
    narrow_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, key, n) of documents (text, lang): every word, staged."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in blocks(batches):
            words, counts, _ = inverted_lists(texts)
            whole = pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), words, pa.array(keys_of(lang, words, seed)), pa.array(counts.astype(np.int64))], names=["lang", "word", "key", "n"])
            for k in range(0, len(words), 65536):
                yield whole.slice(k, 65536)

    found = plain_documents(docs).mapInArrow(work, "lang string, word string, key long, n long")
    return staged(found.groupBy("lang", "word", "key").agg(F.sum("n").alias("n")), "word-counts")


class Bits:
    """A Bloom filter: two bits of a number of bits that is a power of two."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        hashed = mixed(keys.view(np.uint64))
        return hashed & np.uint64(size - 1), mixed(hashed + np.uint64(1)) & np.uint64(size - 1)

    def hold(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for place in self.places(keys, 64 * len(self.words)):
            out &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mixed(second.view(np.uint64))).view(np.int64)


def bits_of(frame: DataFrame, columns: list[str]) -> Broadcast:
    """The filter of a table's keys or pairs of keys, at every task: about sixteen bits a row,
    ``MOST_BITS`` at most."""
    spark = frame.sparkSession
    size = min(MOST_BITS, 1 << max(10, (16 * frame.count()).bit_length()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in columns]
            place = np.concatenate(Bits.places(keys[0] if len(keys) == 1 else pair_keys(*keys), size))
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))], names=["word", "bits"])

    set_ = frame.select(*columns).mapInArrow(work, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[set_.column("word").to_numpy()] = set_.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(Bits(words))


def merged(lists: list[np.ndarray]) -> Lists:
    """A block's lists in the order of their places, each named by its index."""
    places = np.concatenate(lists)
    order = np.argsort(places, kind="stable")
    return places[order], np.repeat(np.arange(len(lists)), [len(x) for x in lists])[order]


def extended(held: Lists, size: int) -> Lists:
    """The lists of the pairs of phrases (names below ``size``) that begin one place apart, a
    pair named ``first * size + second``: phrases of k words make one of k + 1."""
    places, names = held
    near = np.flatnonzero(np.diff(places) == 1)
    return places[near], names[near] * size + names[near + 1]


def restricted(held: Lists, known: np.ndarray) -> Lists:
    """The lists with a name in ``known`` (ascending), named by its index there."""
    places, names = held
    if not len(known):
        return places[:0], names[:0]
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    same = known[at] == names
    return places[same], at[same]


def phrase_counts(docs: DataFrame, seed: int, words: Broadcast, pairs: Broadcast | None = None) -> DataFrame:
    """(first, second, third, a) of documents: the keys of the phrases of two words (third is
    null), or of three if the filter of ``pairs`` is given, that occur ``LEAST`` times."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in blocks(batches):
            found, counts, places = inverted_lists(texts)
            keys = keys_of(lang, found, seed)
            lists = np.split(places, np.cumsum(counts)[:-1]) if len(keys) else []
            known = np.flatnonzero(words.value.hold(keys))
            if not len(known):
                continue
            keys, size = keys[known], len(known)
            held = extended(merged([lists[k] for k in known.tolist()]), size)
            if pairs is not None:
                names = np.unique(held[1])
                names = names[pairs.value.hold(pair_keys(keys[names // size], keys[names % size]))]
                held = extended(restricted(held, names), len(names))
            seen, n = np.unique(held[1], return_counts=True)
            if pairs is None:
                columns = [keys[seen // size], keys[seen % size]]
            else:
                a, b = (names[x] for x in np.divmod(seen, max(1, len(names))))
                columns = [keys[a // size], keys[a % size], keys[b % size]]
            arrays = [pa.array(c) for c in columns] + [pa.nulls(len(seen), pa.int64())] * (pairs is None)
            whole = pa.RecordBatch.from_arrays([*arrays, pa.array(n.astype(np.int64))], names=["first", "second", "third", "n"])
            for k in range(0, len(seen), 65536):
                yield whole.slice(k, 65536)

    counted = plain_documents(docs).mapInArrow(work, "first long, second long, third long, n long")
    keys = ["first", "second"] if pairs is None else ["first", "second", "third"]
    return staged(counted.groupBy(*keys).agg(F.sum("n").alias("a")).where(F.col("a") >= LEAST), "phrases")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * wide[0] * wide[0], wide[1] * wide[2]).cast("long")


def candidates(docs: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that no longer one covers."""
    seed = 0
    counts = word_counts(docs, seed)
    while not counts.groupBy("key").agg(F.count("*").alias("words")).where("words > 1").isEmpty():
        seed += 1
        counts = word_counts(docs, seed)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    words = counts.where(F.col("n") >= LEAST)
    held = bits_of(words, ["key"])
    pairs = phrase_counts(docs, seed, held)
    triples = phrase_counts(docs, seed, held, bits_of(pairs, ["first", "second"]))

    word = lambda name: words.select(F.col("key").alias(name), F.col("word").alias(f"{name}_text"), F.col("n").alias(f"{name}_n"), *(["lang"] if name == "first" else []))
    two = staged(pairs.join(word("first"), "first").join(word("second"), "second").withColumn("id", F.monotonically_increasing_id()), "named-pairs")
    begin = two.select("first", "second", F.col("id").alias("begin"), "lang", F.col("a").alias("first_a"), F.col("first_text").alias("w1"), F.col("second_text").alias("w2"), F.col("first_n").alias("n1"))
    end = two.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("id").alias("end"), F.col("a").alias("second_a"), F.col("second_text").alias("w3"), F.col("second_n").alias("n3"))
    three = staged(triples.join(begin, ["first", "second"]).join(end, ["second", "third"]), "named-triples")
    covers = three.select(F.col("begin").alias("id"), "a").unionByName(three.select(F.col("end").alias("id"), "a")).groupBy("id").agg(F.max("a").alias("longer"))
    left = two.join(covers, "id", "left").where(F.coalesce(100 * F.col("longer") < 50 * F.col("a"), F.lit(True)))
    short = left.select("lang", F.concat_ws(" ", "first_text", "second_text").alias("phrase"), "a", F.col("first_n").alias("l"), F.col("second_n").alias("r"))
    # Of the cuts after one and after two words the lower score counts, the first on a tie.
    later = score(F.col("a"), F.col("first_a"), F.col("n3")) < score(F.col("a"), F.col("n1"), F.col("second_a"))
    long = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(later, F.col("first_a")).otherwise(F.col("n1")).alias("l"), F.when(later, F.col("n3")).otherwise(F.col("second_a")).alias("r"))
    scored = short.unionByName(long).withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    return scored.join(totals, "lang").select("lang", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")  # a row a language


def collocations(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``most`` of each language."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = staged(candidates(docs), "candidates").withColumn("salt", salt_of(SALTS, "phrase"))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT d, lang, unnest(string_split_regex(text, '[.,;:!?\n-\r]')) AS piece, generate_subscripts(string_split_regex(text, '[.,;:!?\n-\r]'), 1) AS p FROM docs
), parts AS (
  SELECT d, lang, p, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces
), one AS (
  SELECT d, lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM parts
), words AS (
  SELECT lang, w, lead(w) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM one WINDOW s AS (PARTITION BY d, p ORDER BY i)
), f1 AS (SELECT lang, w AS phrase, count(*) AS f FROM words GROUP BY ALL
), f2 AS (SELECT lang, w, w2, count(*) AS a FROM words WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (SELECT lang, w, w2, w3, count(*) AS a FROM words WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang
), covers AS (
  SELECT lang, w, w2, max(a) AS longer FROM (SELECT lang, w, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL
), two AS (
  SELECT f2.lang, f2.w || ' ' || f2.w2 AS phrase, a, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.phrase = f2.w JOIN f1 y ON y.lang = f2.lang AND y.phrase = f2.w2
  LEFT JOIN covers c ON c.lang = f2.lang AND c.w = f2.w AND c.w2 = f2.w2
  WHERE a >= 10 AND coalesce(100 * longer < 50 * a, true)
), cuts AS (
  SELECT f3.lang, f3.w || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.a, x.f AS l1, q.a AS r1, p.a AS l2, z.f AS r2,
    (1000000::HUGEINT * f3.a * f3.a) // (x.f::HUGEINT * q.a) AS s1, (1000000::HUGEINT * f3.a * f3.a) // (p.a::HUGEINT * z.f) AS s2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.phrase = f3.w JOIN f1 z ON z.lang = f3.lang AND z.phrase = f3.w3
  JOIN f2 p ON p.lang = f3.lang AND p.w = f3.w AND p.w2 = f3.w2 JOIN f2 q ON q.lang = f3.lang AND q.w = f3.w2 AND q.w2 = f3.w3
), scored AS (
  SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM two
  UNION ALL SELECT lang, phrase, a, if(s2 < s1, l2, l1), if(s2 < s1, r2, r1), least(s1, s2) FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
)
SELECT lang, rank, phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

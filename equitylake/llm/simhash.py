"""SimHash near-duplicates by anchor-point covering.

Anchors are the pairs of words of two binary Golay [23,12] codes on bits 0-22 and 23-45
of a fingerprint. That code is perfect: every 23-bit word lies within 3 bits of exactly
one code word (covering radius 3). Two fingerprints within 2 bits have a point between
them that is at most 1 bit from either, and the anchor covering that point is within
radius 3 of it in both halves. So each fingerprint is replicated to all anchors within
radius 3 in both halves, but for one bit more in one of them: half the threshold on
either side. That is 1 + 2 x 5 anchors at most, and both fingerprints of a link meet.

Fingerprints are compared per anchor; a run of equal anchors yields the edges of a
spanning forest, not its pairs. A run of more than ``MOST_COMPARED`` different
fingerprints is not compared at all: its fingerprints are linked through the points
within 1 bit of them (all that share such a point are within 2 bits of each other, and
all links have such a point), which takes 65 rows a fingerprint whatever their number.

Defined results: null or blank text has fingerprint zero and links like any other. Rows
with equal or null ``doc_id`` are kept, a null id being no candidate for component_id
(null if its component has no other). ``keep_one_of_each`` keeps a component's row of
least doc_id (null last; of equal ids, that of least hash), one of equal rows, with all
its columns whatever their names; ``fingerprints`` drops them. No documents, no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, components, drop_cache, free_names, narrow_batches, read_table, row_key, salt_of, staged

SHINGLE = 3
SEED = 42
THRESHOLD = 2
HALF = 23
MOST_COMPARED = 2048
SALTS = 32


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a text's UTF-8 bytes."""
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], "<u8")
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65536):
        chunk = hashes[part : part + 65536]
        counts += np.unpackbits(chunk.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, fp): the row's key and the fingerprint as a signed 64-bit integer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        for whole in batches:
            for batch in by_size(whole, "text"):
                prints = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k1", "k2")), pa.array(prints.view(np.int64))], names=["doc_id", "k1", "k2", "fp"])

    narrow_batches(docs.sparkSession)
    k1, k2 = row_key()
    plain = docs.select(F.col("doc_id").cast("long"), k1.alias("k1"), k2.alias("k2"), F.col("text").cast("string").cast("binary").alias("text"))
    return plain.mapInArrow(work, "doc_id long, k1 long, k2 long, fp long")


@functools.cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of single bits, and for each syndrome the error of weight 3 or less and
    the (five or no) errors of weight 4."""
    generator = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the code
    bits = []
    for k in range(HALF):
        value = 1 << k
        for top in range(HALF - 1, 10, -1):
            if value >> top & 1:
                value ^= generator << top - 11
        bits.append(value)
    syndromes = np.array(bits, np.int64)
    near, far = np.zeros(2048, np.int64), np.zeros((2048, 5), np.int64)
    errors = [(0, 0, 0, -1)]  # error, syndrome, weight, highest bit
    found = [0] * 2048
    while errors:
        error, syndrome, weight, high = errors.pop()
        if weight < 4:
            near[syndrome] = error
            errors += [(error | 1 << k, syndrome ^ bits[k], weight + 1, k) for k in range(high + 1, HALF)]
        else:
            far[syndrome, found[syndrome]] = error
            found[syndrome] += 1
    return syndromes, near, far


def code_words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code word within 3 bits of each 23-bit point, and those 4 bits away (a row of
    five for each point; where there are none, the nearest again)."""
    syndromes, near, far = golay()
    of = np.zeros(len(points), np.int64)
    for k in range(HALF):
        of ^= syndromes[k] * (points >> k & 1)
    nearest = points ^ near[of]
    others = points[:, None] ^ far[of]
    others[far[of] == 0] = np.broadcast_to(nearest[:, None], others.shape)[far[of] == 0]
    return nearest, others


def anchors_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, anchor) of every anchor that a fingerprint is replicated to."""
    mask = (1 << HALF) - 1
    low, high = prints & mask, prints >> HALF & mask
    (a, near_a), (b, near_b) = code_words(low), code_words(high)
    all_anchors = np.concatenate([(a | b << HALF)[:, None], near_a | (b << HALF)[:, None], a[:, None] | near_b << HALF], axis=1)
    home = all_anchors[:, :1]
    keep = all_anchors != home
    keep[:, 0] = True
    rows, columns = np.nonzero(keep)
    return rows, all_anchors[rows, columns]


def forest(prints: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """(fingerprint, least fingerprint linked to it) within one anchor's fingerprints."""
    bits = prints.view(np.uint64)  # of signed integers, bitwise_count takes the absolute value's bits
    linked = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= threshold
    if linked.sum() == len(prints):
        return []
    label = np.arange(len(prints))
    while True:
        lower = np.where(linked, label[None, :], len(prints)).min(1)
        if (lower == label).all():
            break
        label = lower
    return [(int(prints[k]), int(prints[label[k]])) for k in np.flatnonzero(label != np.arange(len(prints)))]


def link_prints(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect the same fingerprints (column ``fp``, all different) as
    all links at THRESHOLD bits or fewer."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        for batch in batches:
            values = batch.column("fp").to_numpy()
            rows, anchors = anchors_of(values)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(values[rows])], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        last, held, hot = None, np.zeros(0, np.int64), False

        def out(links: list[tuple[int, int]], crowded: list[int]) -> pa.RecordBatch:
            a = [x for x, _ in links] + crowded
            b = [y for _, y in links] + crowded
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            anchor, fp = batch.column("anchor").to_numpy(), batch.column("fp").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(anchor, prepend=anchor[:1] - 1)), len(anchor))
            links, crowded = [], []
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if anchor[begin] != last:
                    if len(held) > 1:
                        links += forest(held)
                    last, held, hot = anchor[begin], fp[begin:end], False
                else:
                    held = np.append(held, fp[begin:end])
                if hot or len(held) > MOST_COMPARED:
                    hot, crowded, held = True, crowded + held.tolist(), held[:0]
            if links or crowded:
                yield out(links, crowded)
        if len(held) > 1 and (links := forest(held)):
            yield out(links, [])

    spread = prints.select("fp").mapInArrow(replicate, "anchor long, fp long").repartition("anchor").sortWithinPartitions("anchor")
    links = staged(spread.mapInArrow(compare, "a long, b long").distinct(), "links")
    crowded = links.where("a = b").select(F.col("a").alias("fp"))
    points = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("long")) for k in range(64)])
    balls = crowded.select("fp", F.explode(points).alias("point"))
    shared = balls.join(balls.groupBy("point").agg(F.min("fp").alias("b")), "point").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return links.where("a <> b").unionByName(shared)


def labelled_prints(prints: DataFrame) -> DataFrame:
    """(fp, component): each different fingerprint with the least one linked to it."""
    different = staged(prints.select("fp").distinct(), "different-prints")
    linked = components(link_prints(different)).select(F.col("node").alias("fp"), "component")
    return different.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of documents (doc_id, text)."""
    prints = staged(fingerprints(docs), "prints")
    firsts = staged(labelled_prints(prints).join(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp"), "firsts")
    least = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    named = salted_join(firsts.select("fp", "component"), least, "component", "fp").select("fp", "component_id")
    return salted_join(prints.select("doc_id", "k1", "fp"), named, "fp", "k1").select("doc_id", "fp", "component_id")


def salted_join(rows: DataFrame, table: DataFrame, on: str, salt: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each ``on``; rows of one
    ``on`` are dealt over salts."""
    salted = rows.withColumn("salt", salt_of(SALTS, salt))
    met = salted.select(on, "salt").distinct().join(table, on)
    return salted.join(met, [on, "salt"]).drop("salt")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, all columns kept. Texts move once, to meet the
    keys that are kept; only rows whose key another row shares are then made one."""
    prints = staged(fingerprints(docs), "prints")
    row = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "k1", "k2")
    least = prints.groupBy("fp").agg(F.min(row).alias("row"))
    k1, k2, repeated = free_names(docs, "k1", "k2", "repeated")
    kept = labelled_prints(prints).join(least, "fp").groupBy("component").agg(F.min("row").alias("row")).select(F.col("row.k1").alias(k1), F.col("row.k2").alias(k2))
    counts = prints.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg((F.count("*") > 1).alias(repeated))
    chosen = docs.withColumns(dict(zip((k1, k2), row_key(), strict=True))).join(staged(kept.join(counts, [k1, k2]), "kept"), [k1, k2])
    return chosen.where(~F.col(repeated)).unionByName(chosen.where(repeated).dropDuplicates([k1, k2])).select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

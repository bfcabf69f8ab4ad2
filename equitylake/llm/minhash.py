"""MinHash near-duplicates: one permutation, optimal densification, banded buckets, stars.

A document's set holds 64-bit hashes of its different shingles. The hashes are the one
permutation: their ascending order falls into ``BINS`` equal ranges, and a range's least
hash is the bin's minimum. An empty bin takes over the minimum of a bin that is not, the
first such in a sequence of random bins that is fixed for each empty bin (optimal
densification), so that bins agree with the sets' similarity as probability. Each ``ROWS``
bins make a band; equal bands are a bucket. At similarity 0.8 a pair shares no bucket with
a probability below 1e-7.

Equal sets are made one node first. Then links are found in steps, each of which confirms
them on the full sets; a bucket whose nodes are in one component is done:

1. Stars: a bucket's least node with each other one. A bucket of k nodes gives k - 1 pairs,
   and as all buckets choose by the same order, pairs of a group repeat and fall together.
2. Buckets of at most ``CROWD`` nodes that hold several components still: all their other
   pairs across components, fewer than ``CROWD`` for a node and band.
3. Larger ones: no pairs are made. Their nodes are dealt over blocks, and each two blocks
   are a group whose sets are counted against each other at once; it gives a forest of links.
4. Nodes of buckets beyond ``HUGE`` (many texts around one shared passage): two sets that
   are similar enough share one of the rarest fifth of their shingles, rarest by these
   nodes' counts. The shingles of that part are buckets for steps 1 to 3. So no link is left
   to a cap.

Sets are made, from the texts again, only for nodes that share a bucket with another one.
Counts, sets and pairs are tables; nothing is collected. Rows that meet a node of many
copies or links are dealt over salts.

Defined results: without words or text a set is empty and linked with nothing. Rows with
equal or null ``doc_id`` are rows of their own; a null id is no candidate for component_id
(null if its component has no other) and is not kept then. Other columns are dropped. No
documents, no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_size, components, narrow_batches, read_table, row_key, salt_of, staged
from .url_filter import filtered

SHINGLE = 4
BINS = 128
ROWS = 4
CROWD = 64
HUGE = 4096
BLOCK_NODES, BLOCK_SHINGLES = 256, 500_000  # about so much of a bucket in a block
COLUMNS = 4096
SIMILAR, OF = 80, 100  # linked if OF * intersection >= SIMILAR * union
SALTS, PAIRS_A_SALT = 32, 32
TRIES = 1024

_RNG = np.random.default_rng(13)
_TERMS = _RNG.integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_ENDS = _RNG.integers(1, 1 << 63, SHINGLE + 1, np.uint64)
_ROW_TERMS = _RNG.integers(1, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_BANDS = _RNG.integers(1, 1 << 63, BINS // ROWS, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit number one to one, every bit of the result depending on all of its bits."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        values = (values ^ values >> np.uint64(33)) * np.uint64(factor)
    return values ^ values >> np.uint64(33)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The ascending different shingle hashes of a text, given its words' hashes."""
    n = len(words)
    if not n:
        return words
    size = min(n, SHINGLE)
    sums = sum((words[k : n - size + 1 + k] * _TERMS[k] for k in range(size)), _ENDS[size])
    return np.unique(mixed(sums))


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words, A-Z in lower case; ASCII white space parts words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten().dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w.as_buffer()) for w in words.dictionary.cast(pa.binary())], np.uint64)
    empty = np.flatnonzero(pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False))
    places = words.indices.to_numpy()
    bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        part = places[a:b]
        yield known[part[part != empty[0]] if len(empty) else part]


@functools.cache
def sequences() -> np.ndarray:
    """For each bin the random bins that it turns to when empty, all bins at the end."""
    rng = np.random.default_rng(17)
    return np.concatenate([rng.integers(0, BINS, (BINS, TRIES)), np.tile(rng.permutation(BINS), (BINS, 1))], axis=1)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The bins of a set that is not empty."""
    edges = np.arange(BINS, dtype=np.uint64) * np.uint64((1 << 64) // BINS)
    first = np.searchsorted(hashes, edges)
    filled = np.diff(np.append(first, len(hashes))) > 0
    out = hashes[np.minimum(first, len(hashes) - 1)]
    for columns in (sequences()[:, :16], sequences()):
        empty = np.flatnonzero(~filled)
        if not len(empty):
            break
        turns = columns[empty]
        met = (first[turns] < np.append(first, len(hashes))[turns + 1])
        found = met.any(1)
        source = turns[np.arange(len(empty)), met.argmax(1)]
        out[empty[found]] = hashes[first[source[found]]]
        filled[empty[found]] = True
    return out


def bands(hashes: np.ndarray) -> np.ndarray:
    """A bucket for each band, as signed numbers."""
    sums = (minima(hashes).reshape(-1, ROWS) * _ROW_TERMS).sum(1, dtype=np.uint64)
    return mixed(sums + _BANDS).view(np.int64)


def sets_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for batch in by_size(whole, "text"):
            yield batch, [shingle_set(w) for w in word_hashes(batch.column("text"))]


def sketches(docs: DataFrame) -> DataFrame:
    """(row, doc_id, k1, k2, n, digest, bands): the row's keys, the set's size, a digest that is
    the same for equal sets only (128 bits) and the buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in sets_of_texts(batches):
            columns = [
                *(batch.column(c) for c in ("row", "doc_id", "k1", "k2")), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([bands(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "k1", "k2", "n", "digest", "bands"])

    narrow_batches(docs.sparkSession)
    k1, k2 = row_key()
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), k1.alias("k1"), k2.alias("k2"), F.col("text").cast("string"))
    return plain.mapInArrow(work, "row long, doc_id long, k1 long, k2 long, n long, digest binary, bands array<long>")


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of nodes (node, k1, k2, repeated): the set as 64-bit numbers, ascending.
    ``repeated`` tells whether several rows have the keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in sets_of_texts(batches):
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    k1, k2 = row_key()
    key = F.concat_ws(" ", "k1", "k2").alias("url")  # the filter's name for what it looks up
    texts = docs.select(k1.alias("k1"), k2.alias("k2"), F.col("text").cast("string")).select("*", key)
    # A filter of the wanted rows, if its size is bounded, spares the others' texts the shuffle.
    likely = filtered(texts, nodes.select(key)).where("possible").select("k1", "k2", "text")
    met = likely.join(nodes, ["k1", "k2"]).select("node", "repeated", "text")
    once = met.where("not repeated").unionByName(met.where("repeated").dropDuplicates(["node"]))
    return once.select("node", "text").mapInArrow(work, "node long, shingles binary")


def similar(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    low, high = min(len(x), len(y)), max(len(x), len(y))
    if OF * low < SIMILAR * high:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # merges the two ascending sets
    common = int((both[1:] == both[:-1]).sum())
    return OF * common >= SIMILAR * (len(both) - common)


def dealt(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the salt of ``a`` that each goes to: one for ``PAIRS_A_SALT`` pairs
    of ``a``, as its set goes to each of them, ``SALTS`` at most."""
    counts = pairs.groupBy("a").agg(F.count("*").alias("pairs")).where(F.col("pairs") > PAIRS_A_SALT)
    many = pairs.select("a", "b", salt_of(SALTS, "b").alias("salt"))
    salts = F.least(F.lit(SALTS), F.ceil(F.coalesce("pairs", F.lit(1)) / PAIRS_A_SALT))
    met = many.join(counts, "a", "left").withColumn("salts", salts)
    return met.select("a", "b", F.pmod("salt", "salts").cast("int").alias("salt"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose sets (node, shingles) are similar, staged.

    Each set goes once to every salt of ``a`` (``dealt``), before the pairs of that salt,
    which carry the set of ``b``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, b""
        for batch in batches:
            a, b, found = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
            for k, value in enumerate(batch.column("shingles")):
                if b[k] is None:
                    node, held = a[k], value.as_py()
                elif a[k] == node and similar(held, value.as_buffer()):
                    found.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(found, pa.int64())) for c in ("a", "b")], names=["a", "b"])

    salted = dealt(pairs)
    centres = salted.select("a", "salt", F.lit(None).cast("long").alias("b"), F.col("a").alias("node")).distinct()
    met = centres.unionByName(salted.select("a", "salt", "b", F.col("b").alias("node"))).join(sets, "node")
    rows = met.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return staged(rows.select("a", "b", "shingles").mapInArrow(work, "a long, b long"), "similar-pairs")


def links_among(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """(place, least place linked to it) of some sets: a forest of all their links. Shingles
    of a single set are left out; the others are counted for all pairs by products of 0-1
    matrices, some columns at a time."""
    sizes = np.array([len(x) for x in sets], np.int64)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    place = np.repeat(np.arange(len(sets)), sizes)[shared]
    column = (np.cumsum(counts > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    place, column = place[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    starts = np.arange(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS)
    for start, a, b in zip(starts.tolist(), np.searchsorted(column, starts), np.searchsorted(column, starts + COLUMNS), strict=True):
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[place[a:b], column[a:b] - start] = 1
        common += (held @ held.T).astype(np.int64)
    linked = OF * common >= SIMILAR * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        lower = np.where(linked, label[None, :], len(sets)).min(1)
        if (lower == label).all():
            return [(k, int(label[k])) for k in np.flatnonzero(label != np.arange(len(sets))).tolist()]
        label = lower


def block_links(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what all links within these buckets connect, staged."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, held = None, [], []

        def found() -> pa.RecordBatch:
            pairs = links_among(held) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[x] for x, _ in pairs], pa.int64()), pa.array([nodes[y] for _, y in pairs], pa.int64())], names=["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j")), strict=True)
            for k, key in enumerate(keys):
                if key != group:
                    yield found()
                    group, nodes, held = key, [], []
                nodes.append(batch.column("node")[k].as_py())
                held.append(np.frombuffer(batch.column("shingles")[k].as_py(), "<u8"))
        yield found()

    parts = F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = stars.select("bucket", "node", parts.alias("parts")).withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), F.col("parts")).cast("int"))
    met = dealt.select("bucket", "node", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    grouped = met.select("bucket", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(sets, "node")
    rows = grouped.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return staged(rows.select("bucket", "i", "j", "node", "shingles").mapInArrow(work, "a long, b long").distinct(), "block-links")


def fitting(pairs: DataFrame) -> DataFrame:
    """Different pairs (a, b) whose sizes (n, m) allow the similarity."""
    allowed = (F.least("n", "m") * OF >= F.greatest("n", "m") * SIMILAR) & (F.col("a") != F.col("b"))
    return pairs.where(allowed).select("a", "b").distinct()


def starred(buckets: DataFrame) -> DataFrame:
    """``buckets`` (bucket, node, n, component) with each bucket's least node, its size and
    component (centre, m, centre_component), the numbers of its nodes and their shingles
    (nodes, total) and whether it has ``several`` components, for buckets of two nodes or more."""
    sums = buckets.groupBy("bucket").agg(
        F.min(F.struct("node", "n", "component")).alias("c"), F.count("*").alias("nodes"), F.sum("n").alias("total"), (F.min("component") < F.max("component")).alias("several")
    ).where("nodes > 1")
    # Rows of a bucket are dealt over salts, so that a hot one meets its sums in many tasks.
    salted = buckets.withColumn("salt", salt_of(SALTS, "node"))
    met = salted.select("bucket", "salt").distinct().join(sums, "bucket")
    joined = salted.join(met, ["bucket", "salt"])
    return joined.select("bucket", "node", "n", "component", F.col("c.node").alias("centre"), F.col("c.n").alias("m"), F.col("c.component").alias("centre_component"), "nodes", "total", "several")


def star_pairs(stars: DataFrame) -> DataFrame:
    across = stars.where("node <> centre and component <> centre_component")
    return fitting(across.select(F.col("centre").alias("a"), F.col("node").alias("b"), "n", "m"))


def all_pairs(stars: DataFrame) -> DataFrame:
    """The pairs without the centre, of different components, of buckets with at most
    ``CROWD`` nodes."""
    small = stars.where((F.col("nodes") <= CROWD) & F.col("several") & (F.col("node") != F.col("centre")))
    left = small.select("bucket", F.col("node").alias("a"), "n", F.col("component").alias("of_a"))
    right = small.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"), F.col("component").alias("of_b"))
    return fitting(left.join(right, "bucket").where("a < b and of_a <> of_b"))


def joined_components(nodes: DataFrame, links: list[DataFrame]) -> DataFrame:
    """(node, n, component) of nodes (node, n), staged."""
    found = components(functools.reduce(DataFrame.unionByName, links)).select("node", "component")
    return staged(nodes.join(found, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component")), "node-components")


def placed(buckets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``buckets`` (bucket, node) with size and component."""
    return buckets.join(nodes, "node").select("bucket", "node", "n", "component")


def rare_buckets(huge: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, node): the part of each of these nodes' shingles, rarest first, of which two
    similar sets must share one."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "shingles"):
                sizes = pc.binary_length(batch.column("shingles")).to_numpy(zero_copy_only=False) // 8
                hashes = np.concatenate([np.frombuffer(s.as_buffer(), "<i8") for s in batch.column("shingles")])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("node").to_numpy(), sizes)), pa.array(np.repeat(sizes, sizes).astype(np.int64)), pa.array(hashes)], names=["node", "n", "bucket"])

    rows = huge.join(sets, "node").select("node", "shingles").mapInArrow(opened, "node long, n long, bucket long")
    counts = rows.groupBy("bucket").agg(F.count("*").alias("nodes")).where("nodes > 1")
    salted = rows.withColumn("salt", salt_of(SALTS, "node"))
    met = salted.select("bucket", "salt").distinct().join(counts, "bucket")
    counted = salted.join(met, ["bucket", "salt"], "left")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("nodes", F.lit(1)), "bucket"))
    # n - ceil(SIMILAR * n / OF) + 1 of n shingles; those of one node lead to nobody.
    first = counted.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.expr(f"(n * {SIMILAR} + {OF - 1}) div {OF}") + 1)
    return first.where("nodes > 1").select("bucket", "node")


def link_sets(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """(node, n, component) of the different sets (node, k1, k2, repeated, n, bands) of documents, those
    that share a bucket with another; the sets are not empty."""
    spread = sketched.select(F.explode("bands").alias("bucket"), "node")
    buckets = staged(spread.join(spread.groupBy("bucket").agg(F.count("*").alias("nodes")).where("nodes > 1").select("bucket"), "bucket"), "shared-buckets")
    met = staged(sketched.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "k1", "k2", "n", "repeated"), "met-nodes")
    sets, plain = staged(sets_of(docs, met.drop("n")), "sets"), met.select("node", "n")
    links, nodes = linked_in(buckets, plain, plain.withColumn("component", F.col("node")), sets, [], HUGE)
    stars = starred(placed(buckets, nodes)).where(F.col("several") & (F.col("nodes") > HUGE))
    huge = staged(stars.select("node").distinct(), "huge-buckets")
    if not huge.isEmpty():
        _, nodes = linked_in(staged(rare_buckets(huge, sets), "rare-buckets"), plain, nodes, sets, links, None)
    return nodes


def linked_in(buckets: DataFrame, plain: DataFrame, nodes: DataFrame, sets: DataFrame, links: list[DataFrame], most: int | None) -> tuple[list[DataFrame], DataFrame]:
    """``links`` with those in buckets (bucket, node) of at most ``most`` nodes, in larger ones
    those of stars only, and the components that they make."""
    links = [*links, confirmed(star_pairs(starred(placed(buckets, nodes))), sets)]
    nodes = joined_components(plain, links)
    links.append(confirmed(all_pairs(starred(placed(buckets, nodes))), sets))
    nodes = joined_components(plain, links)
    large = starred(placed(buckets, nodes)).where(F.col("several") & (F.col("nodes") > CROWD))
    large = staged(large if most is None else large.where(F.col("nodes") <= most), "large-buckets")
    if not large.isEmpty():
        links.append(block_links(large, sets))
        nodes = joined_components(plain, links)
    return links, nodes


def minhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of documents (doc_id, text)."""
    rows = staged(sketches(docs), "sketches")
    firsts = staged(rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("first")), "different-sets")
    copies = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies")).where("copies > 1").select("k1", "k2", F.lit(True).alias("repeated"))
    chosen = rows.join(firsts.select(F.col("node").alias("row")), "row", "left_semi").join(copies, ["k1", "k2"], "left").select(F.col("row").alias("node"), "k1", "k2", F.coalesce("repeated", F.lit(False)).alias("repeated"), "n", "bands")
    linked = link_sets(docs, staged(chosen, "chosen-sketches"))
    named = staged(firsts.join(linked.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node")), "named-sets")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    whole = named.join(least, "component").select("digest", "component_id")
    # Copies of one set are dealt over salts.
    salted = rows.select("row", "doc_id", "n", "digest").withColumn("salt", salt_of(SALTS, "row"))
    met = salted.select("digest", "salt").distinct().join(whole, "digest")
    joined = salted.join(met, ["digest", "salt"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(read_table(spark, sf_dir, "documents"))

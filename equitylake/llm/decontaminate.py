"""Benchmark decontamination by latent semantic retrieval.

Passages are ``PASSAGE`` words of a document, beginning every ``STEP`` words. Words are
hashed to ``TERMS`` terms; document frequencies come from all documents, and a term weighs
the square of its inverse document frequency's logarithm. A randomised singular value
decomposition of the TF-IDF matrix A of passages (distributed products Aᵀ(A Ω), once more
with an orthonormal basis in place of Ω) gives latent vectors of the terms. Its columns are
the terms of the benchmark; its rows are the benchmark's passages, each counting
``EMPHASIS`` times, and those of all documents, which together count as those of
``WEIGH_AS`` documents at most, so that a large table does not drown the benchmark.

Then all passages of all documents are folded in and compared with all items, whole and in
pieces of ``PASSAGE`` words (the last may overlap the one before it). A passage's score is
the share of the piece in it: their product over the piece's with itself, which other words
of the passage, however rare, don't lower. ``LEAST_SHARE`` of it makes a candidate, and so
does such a share of the cosine between the piece folded in and its own full vector: in a
passage of lighter words than the piece's, less of the piece is enough. Passages whose
terms' greatest products with any piece add up to less than that are not folded in: no
piece can reach it there. A candidate, with an item's length of words on either side, is
contaminated if the longest common subsequence with the item covers ``SURE`` of the item's
words, or ``PARAPHRASE`` of them and the item's answer (column ``answer`` or, in its
absence, the item's last sentence) is there in order to ``ANSWERED`` of its words.

Items are a stated query set: their vectors and words are broadcast in blocks of
``PIECES_A_BLOCK`` pieces or an item, one pass over the documents for each block. A task
multiplies ``TILE`` passages and pieces at a time.

Defined results: null or wordless texts and items match nothing. Equal items each match.
Rows with equal or null ``doc_id`` are judged one by one: ``find_leaks`` has one row a
matching row and item, ``keep_clean`` keeps all other rows with all their columns,
whatever their names. Texts are taken whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import by_size, drop_cache, free_names, in_chunks, narrow_batches, read_table, row_key, split_words, staged, summed, word_places

PASSAGE, STEP = 32, 16
TERMS = 1 << 17
RANK, EXTRA = 128, 16
WEIGH_AS, EMPHASIS = 1000, 6
GRAM, ROWS_AT_ONCE = 4096, 256
LEAST_SHARE, LEAST_OWN = 0.33, 0.05
SURE, PARAPHRASE, ANSWERED = 0.7, 0.5, 0.8
PIECES_A_BLOCK = 20_000
WORDS_AT_ONCE = 1 << 14
TILE = 1 << 20
MASKS = 1 << 21  # of items and columns, held as a table
SLACK = 1e-3  # of a share, for the rounding of 32-bit sums
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def term_ids(text: str | None) -> np.ndarray:
    """Terms of a text's words, words without a letter or digit left out."""
    places = word_places((text or "").split(), TERMS)
    return places[places >= 0]


def batch_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all texts of a batch, one text after another, and each text's bounds."""
    words, codes, bounds = split_words(texts)
    terms = word_places(words, TERMS)[codes]
    known = terms >= 0
    return terms[known], np.append(0, np.cumsum(known))[bounds]


def tokens(texts: DataFrame) -> DataFrame:
    """The texts' other columns with ``terms``, written once: all passes read these."""
    kept = [c for c in texts.columns if c != "text"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        for whole in batches:
            for batch in by_size(whole, "text"):
                terms, bounds = batch_terms(batch.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(terms, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], names=[*kept, "terms"])

    schema = type(texts.schema)([texts.schema[c] for c in kept]).add("terms", ArrayType(IntegerType()))
    return staged(texts.select(*kept, "text").mapInArrow(encode, schema), "terms")


def listed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All terms of a batch of ``tokens``, and each row's bounds."""
    lists = batch.column("terms")
    return lists.flatten().to_numpy().astype(np.int64), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents of ``tokens`` hold each term, and how many documents there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        totals, n = np.zeros(TERMS, np.int64), 0
        last, order = np.zeros(TERMS, np.int64), np.arange(1 << 16)
        for batch in batches:
            terms, bounds = listed(batch)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own, at = terms[a:b], order[: b - a] if b - a <= len(order) else np.arange(b - a)
                last[own] = at
                totals[own[last[own] == at]] += 1  # a term counts where it stands last
            n += batch.num_rows
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, TERMS)), pa.array(np.append(totals[used], n))], names=["term", "n"])

    sums = docs.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(TERMS + 1, np.int64)  # TERMS + 1 rows at most
    found[sums.column("term").to_numpy()] = sums.column("n").to_numpy()
    return found[:TERMS], int(found[TERMS])


class Space(NamedTuple):
    weights: np.ndarray  # of each term
    columns: np.ndarray  # of each term: its row of ``latent``, the last for terms outside the benchmark
    latent: np.ndarray  # RANK values for each column, the last row zero


def passage_values(terms: np.ndarray, bounds: np.ndarray, weights: np.ndarray, columns: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, column and value of what the TF-IDF rows of a batch hold, passages ascending."""
    blocks = -(-np.diff(bounds) // PASSAGE)
    row = np.repeat(np.arange(len(blocks)), blocks)
    begin = bounds[row] + PASSAGE * (np.arange(len(row)) - np.append(0, np.cumsum(blocks))[row])
    if not len(row):
        return row, row, np.zeros(0, np.float32)
    passage = np.repeat(np.arange(len(row)), np.diff(np.append(begin, len(terms))))
    values = weights[terms]
    values = (values / (np.sqrt(np.add.reduceat(values**2, begin)) + 1e-9)[passage]).astype(np.float32)
    at = columns[terms].astype(np.int64)
    inside = at < size
    return passage[inside], at[inside], values[inside]


def below(row: np.ndarray | int) -> np.ndarray | int:
    """Where a row begins in the lower triangle of a square, row by row."""
    return row * (row + 1) // 2


def add_gram(gram: np.ndarray, size: int, passage: np.ndarray, at: np.ndarray, values: np.ndarray, times: float) -> None:
    """Add ``times`` AᵀA, of ``size`` columns, to the lower triangle ``gram``, half of its
    diagonal. Its last row takes what passages lack of ``PASSAGE`` terms."""
    first = np.flatnonzero(np.append(True, np.diff(passage) != 0)) if len(passage) else passage
    count = np.diff(np.append(first, len(passage)))
    row, place = np.repeat(np.arange(len(first)), count), np.arange(len(passage)) - np.repeat(first, count)
    held, amount = np.full((PASSAGE, len(first)), size), np.zeros((PASSAGE, len(first)))
    held[place, row], amount[place, row] = at, values
    for k in range(int(count.max(initial=0))):
        use = np.flatnonzero(count > k)
        most = int(count[use].max())
        left, right = held[k, use], amount[k, use] * times
        np.add.at(gram, below(left) + left, right * amount[k, use] / 2)
        for other in range(k + 1, most):
            beside = held[other, use]
            np.add.at(gram, below(np.maximum(left, beside)) + np.minimum(left, beside), right * amount[other, use])


def gram_times(gram: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """AᵀA ``basis``, from the triangle that ``add_gram`` makes."""
    total = np.zeros(basis.shape)
    for first in range(0, len(basis), ROWS_AT_ONCE):
        last = min(first + ROWS_AT_ONCE, len(basis))
        rows = np.zeros((last - first, last))
        for k in range(first, last):
            rows[k - first, : k + 1] = gram[below(k) : below(k + 1)]
        total[first:last] += rows @ basis[:last]
        total[:last] += rows.T @ basis[first:last]
    return total


def add_products(total: np.ndarray, passage: np.ndarray, at: np.ndarray, values: np.ndarray, times: float, basis: np.ndarray) -> None:
    """Add ``times`` Aᵀ(A basis) to ``total``."""
    cuts = np.flatnonzero(np.append(True, np.diff(passage) != 0)) if len(passage) else passage
    parts = np.searchsorted(cuts, np.arange(0, len(passage) + WORDS_AT_ONCE, WORDS_AT_ONCE))
    ends = np.append(cuts, len(passage))
    for first, last in zip(parts[:-1].tolist(), parts[1:].tolist(), strict=True):
        if last == first:
            continue
        a, b = ends[first], ends[last]
        folded = np.add.reduceat(values[a:b, None] * basis[at[a:b]], cuts[first:last] - a, axis=0)
        order = np.argsort(at[a:b], kind="stable")
        column, of = at[a:b][order], np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))[order]
        starts = np.flatnonzero(np.append(True, np.diff(column) != 0))
        total[column[starts]] += times * np.add.reduceat(values[a:b][order, None] * folded[of], starts, axis=0)


def product(rows: DataFrame, basis: np.ndarray, space: Space) -> np.ndarray:
    """Aᵀ(A basis) for the TF-IDF rows A of the passages of rows (terms array<int>, times
    double), each counted ``times``. A task sums up AᵀA and multiplies once if there are no
    more than ``GRAM`` columns, which takes far fewer steps; else it multiplies each row."""
    shared = rows.sparkSession.sparkContext.broadcast((basis.astype(np.float32), space.weights, space.columns))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        basis, weights, columns = shared.value
        total, size = np.zeros(basis.shape), len(basis)
        gram = np.zeros(below(size + 1)) if size <= GRAM else None
        for batch in batches:
            terms, bounds = listed(batch)
            times = batch.column("times").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(times)) + 1).tolist(), len(times)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # rows that count the same
                if b > a:
                    held = passage_values(terms[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], weights, columns, size)
                    add_products(total, *held, times[a], basis) if gram is None else add_gram(gram, size, *held, times[a])
        if gram is not None:
            total = gram_times(gram, basis)
        yield from in_chunks(total.reshape(-1))

    return summed(rows.select("terms", "times").mapInArrow(multiply, "chunk int, data binary"), basis.size).reshape(basis.shape)


def latent_terms(rows: DataFrame, space: Space) -> Space:
    """``space`` with the right singular vectors times the terms' weights."""
    size = int(space.columns.max())
    start = np.random.default_rng(7).standard_normal((size, min(RANK + EXTRA, size)))
    basis, _ = np.linalg.qr(product(rows, start, space))
    small = product(rows, basis, space)  # AᵀA Q; QᵀAᵀA Q has the squared singular values
    values, vectors = np.linalg.eigh(basis.T @ small)
    latent = np.zeros((size + 1, RANK), np.float32)
    right = basis @ vectors[:, np.argsort(-values)[:RANK]]
    of_column = np.zeros(size)
    inside = space.columns < size
    of_column[space.columns[inside]] = space.weights[inside]
    latent[:size, : right.shape[1]] = of_column[:, None] * right
    return space._replace(latent=latent)


class Items(NamedTuple):
    ids: list[int]
    terms: list[np.ndarray]
    answers: list[np.ndarray]
    owner: np.ndarray  # each piece's item
    vectors: np.ndarray  # pieces x RANK, over the square of their lengths
    own: np.ndarray  # the piece's length over its cosine with its own full vector: share x own / passage = cosine
    most: np.ndarray  # each column's greatest product with a piece
    keys: np.ndarray | None  # ascending item x columns + column of each of ``masks``; None: every one has its mask
    masks: np.ndarray  # the places of a column in an item of 64 terms or fewer


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of ``a``."""
    places: dict[int, int] = {}
    for k, term in enumerate(a.tolist()):
        places[term] = places.get(term, 0) | 1 << k
    full = (1 << len(a)) - 1
    free = full
    for term in b.tolist():
        if held := places.get(term):
            both = free & held
            free = (free + both | free - both) & full
    return len(a) - free.bit_count()


def masks_of(terms: list[np.ndarray], columns: np.ndarray, width: int) -> tuple[np.ndarray | None, np.ndarray]:
    """``keys`` and ``masks`` of items: bit j is set if the item's term j is the column, of ``width``."""
    masks: dict[int, int] = {}
    for k, item in enumerate(terms):
        for j, column in enumerate(columns[item].tolist() if len(item) <= 64 else ()):
            masks[k * width + column] = masks.get(k * width + column, 0) | 1 << j
    keys = np.array(sorted(masks), np.int64)
    values = np.array([masks[key] for key in keys.tolist()], np.uint64)
    if len(terms) * width > MASKS:
        return keys, values
    table = np.zeros(len(terms) * width, np.uint64)
    table[keys] = values
    return None, table


def common_lengths(k: np.ndarray, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int, items: Items) -> np.ndarray:
    """``common_length`` of the items k, of 64 terms or fewer, and the columns from ``begin``
    to ``end`` of ``codes``, all at once; the column ``width`` - 1 is in no item."""
    lengths, out = np.array([len(t) for t in items.terms], np.int64)[k], np.zeros(len(k), np.int64)
    for part in range(0, len(k), WORDS_AT_ONCE):
        some = slice(part, part + WORDS_AT_ONCE)
        first, last, n = begin[some], end[some], lengths[some].astype(np.uint64)
        full = np.where(n == 0, np.uint64(0), ~np.uint64(0) >> (np.uint64(64) - np.maximum(n, np.uint64(1))))
        base, free = k[some] * width, full.copy()
        for step in range(int((last - first).max(initial=0))):
            at = first + step
            key = base + np.where(at < last, codes[np.minimum(at, len(codes) - 1)], width - 1)
            if items.keys is None:
                mask = items.masks[key]
            else:
                place = np.minimum(np.searchsorted(items.keys, key), len(items.keys) - 1)
                mask = np.where(items.keys[place] == key, items.masks[place], np.uint64(0))
            both = free & mask
            free = (free + both | free & ~both) & full
        out[some] = lengths[some] - np.bitwise_count(free)
    return out


class Passages(NamedTuple):
    row: np.ndarray  # the text of each
    begin: np.ndarray  # its first word
    end: np.ndarray
    length: np.ndarray  # of its full vector


def possible_passages(terms: np.ndarray, bounds: np.ndarray, space: Space, items: Items) -> Passages:
    """The passages of a batch in which some piece may reach its share."""
    lengths = np.diff(bounds)
    blocks = -(-lengths // STEP)
    row = np.repeat(np.arange(len(lengths)), blocks)
    begin = bounds[row] + STEP * (np.arange(len(row)) - np.append(0, np.cumsum(blocks))[row])
    if not len(row):
        return Passages(row, begin, begin, np.zeros(0))
    squares = np.add.reduceat(space.weights[terms] ** 2, begin)
    gains = np.add.reduceat(items.most[space.columns[terms]], begin)
    more = np.append(row[1:] == row[:-1], False)  # a second block belongs to the passage
    first = np.append(True, row[1:] != row[:-1])
    length = np.sqrt(squares + np.where(more, np.append(squares[1:], 0), 0) + 1e-9)
    gain = gains + np.where(more, np.append(gains[1:], 0), 0)
    needed = LEAST_SHARE * np.minimum(1, length / max(items.own.max(initial=0), 1e-9)) - SLACK
    chosen = np.flatnonzero((more | first) & (gain >= needed))  # a text's last block belongs to the passage before it
    end = np.minimum(begin + PASSAGE, bounds[row + 1])
    return Passages(row[chosen], begin[chosen], end[chosen], length[chosen])


def vectors_of(terms: np.ndarray, begin: np.ndarray, end: np.ndarray, space: Space) -> np.ndarray:
    """The folded-in vectors of the passages from ``begin`` to ``end``."""
    places = begin[:, None] + np.arange(int((end - begin).max(initial=0)))
    codes = space.columns[terms[np.minimum(places, len(terms) - 1)]]
    codes[places >= end[:, None]] = len(space.latent) - 1  # its row is zero
    out, row = np.zeros((len(begin), space.latent.shape[1]), np.float32), np.empty((len(begin), space.latent.shape[1]), np.float32)
    for column in np.ascontiguousarray(codes.T):
        out += np.take(space.latent, column, axis=0, out=row, mode="clip")
    return out


def judge(candidates: list[np.ndarray], terms: np.ndarray, bounds: np.ndarray, space: Space, items: Items, found: dict[tuple[int, int], tuple[float, float, float]]) -> None:
    """Enter into ``found`` those of the candidates (row, first word of the passage, item,
    cosine) whose common subsequence with the item is long enough."""
    row, begin, k, cosine = candidates
    spans = np.array([len(t) for t in items.terms], np.int64)[k]
    start, stop = np.maximum(bounds[row], begin - spans), np.minimum(bounds[row + 1], begin + PASSAGE + spans)
    common = np.full(len(k), -1)
    narrow = np.flatnonzero(spans <= 64)
    common[narrow] = common_lengths(k[narrow], space.columns[terms].astype(np.int64), start[narrow], stop[narrow], len(space.latent), items)
    near = np.flatnonzero((spans > 0) & ((common < 0) | (common / np.maximum(spans, 1) >= PARAPHRASE)))
    for r, k, cosine, start, stop, common in zip(*(x[near].tolist() for x in (row, k, cosine, start, stop, common)), strict=True):
        item, answer, region = items.terms[k], items.answers[k], terms[start:stop]
        if found.get((r, k), (0, 0, 0))[1] >= 1:
            continue
        covered = (common if common >= 0 else common_length(item, region)) / len(item)
        if covered < PARAPHRASE:
            continue
        answered = common_length(answer, region) / len(answer) if len(answer) else 1.0
        if (covered >= SURE or answered >= ANSWERED) and covered > found.get((r, k), (0, 0, 0))[1]:
            found[r, k] = (cosine, covered, answered)


def leaks_in(terms: np.ndarray, bounds: np.ndarray, space: Space, items: Items) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(row, item) -> cosine, share of the item, share of its answer, the best passage of each."""
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    passages, held, n = possible_passages(terms, bounds, space, items), [], 0
    step = max(1, min(WORDS_AT_ONCE // PASSAGE, TILE // max(1, len(items.owner))))
    lightest = max(items.own.max(initial=0), 1e-9)
    for part in range(0, len(passages.row), step):
        row, begin, end, lengths = (x[part : part + step] for x in passages)
        shares = vectors_of(terms, begin, end, space) @ items.vectors.T
        # Those that no piece's threshold excludes, then by the piece's own.
        p, piece = np.divmod(np.flatnonzero(shares >= (LEAST_SHARE * np.minimum(1, lengths / lightest) - SLACK)[:, None]), len(items.owner))
        share = shares[p, piece]
        chosen = share >= LEAST_SHARE * np.minimum(1, lengths[p] / np.maximum(items.own, 1e-9)[piece])
        p, piece, share = p[chosen], piece[chosen], share[chosen]
        k, cosine = items.owner[piece], share * items.own[piece] / lengths[p]
        best = np.lexsort((-cosine, k, p))  # of an item's pieces in a passage, the likest
        p, k, cosine = p[best], k[best], cosine[best]
        first = np.append(True, (np.diff(p) != 0) | (np.diff(k) != 0))[: len(p)]
        held.append((row[p[first]], begin[p[first]], k[first], cosine[first]))
        n += len(held[-1][0])
        if n >= WORDS_AT_ONCE:
            judge([np.concatenate(x) for x in zip(*held, strict=True)], terms, bounds, space, items, found)
            held, n = [], 0
    if n:
        judge([np.concatenate(x) for x in zip(*held, strict=True)], terms, bounds, space, items, found)
    return found


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """(item_id, terms, terms of the answer), a bounded block at a time."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"), answer.alias("answer")).where("text is not null")
    block, n = [], 0
    for row in rows.toLocalIterator():
        sentences = [s for s in _SENTENCE.split(row["text"]) if s.strip()]
        says = row["answer"] if row["answer"] is not None else sentences[-1] if len(sentences) > 1 else ""
        terms = term_ids(row["text"])
        if len(terms):
            block.append((row["item_id"], terms, term_ids(says)))
            n += len(item_pieces(terms))
        if n >= PIECES_A_BLOCK:
            yield block
            block, n = [], 0
    if block:
        yield block


def item_pieces(terms: np.ndarray) -> list[np.ndarray]:
    """The item, and its passages if it is longer than one."""
    starts = {min(k, max(0, len(terms) - PASSAGE)) for k in range(0, len(terms), PASSAGE)}
    return [terms] if len(terms) <= PASSAGE else [terms, *(terms[k : k + PASSAGE] for k in sorted(starts))]


def fitted(docs: DataFrame, benchmark: DataFrame) -> Space:
    """The latent space of the ``tokens`` of documents and of the benchmark."""
    counts, n = document_frequencies(docs)
    weights = (np.log((2 + n) / (1 + counts)) ** 2).astype(np.float32)
    terms = benchmark.select(F.explode("terms").alias("term")).distinct().toArrow().column("term").to_numpy()  # TERMS at most
    columns = np.full(TERMS, len(terms), np.int32)
    columns[np.sort(terms)] = np.arange(len(terms))
    space = Space(weights, columns, np.zeros((len(terms) + 1, RANK), np.float32))
    if not len(terms):
        return space
    rows = docs.select("terms", F.lit(min(1.0, WEIGH_AS / max(n, 1))).alias("times"))
    return latent_terms(rows.unionByName(benchmark.select("terms", F.lit(float(EMPHASIS)).alias("times"))), space)


def greatest_products(latent: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each column the greatest product of its latent vector with a piece."""
    step = max(1, (8 * TILE) // len(vectors))
    return np.concatenate([(latent[k : k + step] @ vectors.T).max(1) for k in range(0, len(latent), step)])


LEAKS = "item_id long, cosine double, covered double, answered double"


def find_leaks(docs: DataFrame, benchmark: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, item_id, cosine, covered, answered) of documents (doc_id, text) that hold a
    passage of the benchmark (item_id, text and perhaps answer)."""
    spark = docs.sparkSession
    narrow_batches(spark)
    held = tokens(docs.select(*keys, F.col("text").cast("string")))
    schema = type(docs.schema)([docs.schema[k] for k in keys])
    for field in spark.createDataFrame([], LEAKS).schema:
        schema = schema.add(field)
    space = fitted(held, tokens(benchmark.select(F.col("text").cast("string"))))
    shared, out = spark.sparkContext.broadcast(space), None
    for block in item_blocks(benchmark):
        pieces = [(k, piece) for k, (_, terms, _) in enumerate(block) for piece in item_pieces(terms)]
        vectors = np.stack([space.latent[space.columns[t]].sum(0) for _, t in pieces])
        lengths, full = np.linalg.norm(vectors, axis=1), np.array([np.linalg.norm(space.weights[t]) for _, t in pieces])
        own = lengths / np.maximum(lengths / (full + 1e-9), LEAST_OWN)
        vectors /= np.maximum(lengths, 1e-9)[:, None] ** 2
        items = spark.sparkContext.broadcast(Items([b[0] for b in block], [b[1] for b in block], [b[2] for b in block], np.array([k for k, _ in pieces]), vectors, own.astype(np.float32), greatest_products(space.latent, vectors), *masks_of([b[1] for b in block], space.columns, len(space.latent))))

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            drop_cache()
            for whole in batches:
                for batch in by_size(whole, "terms"):
                    found = leaks_in(*listed(batch), shared.value, items.value)
                    if found:
                        at = pa.array([int(r) for r, _ in found])
                        columns = [batch.column(k).take(at) for k in keys] + [pa.array([items.value.ids[k] for _, k in found], pa.int64())]
                        columns += [pa.array([v[c] for v in found.values()], pa.float64()) for c in range(3)]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        part = held.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with their own columns."""
    names = free_names(docs, "k1", "k2")
    keyed = docs.withColumns(dict(zip(names, row_key(), strict=True)))
    leaks = find_leaks(keyed, benchmark, tuple(names)).select(*names).distinct()
    return keyed.join(leaks, names, "left_anti").select(*docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))

"""Packing by cutting-stock column generation.

Documents become token pieces of at most ``SEQUENCE`` ids; full pieces are sequences of
their own. The other pieces are counted by length: those below ``SHORT`` ids exactly, the
others in classes ``UNIT`` ids wide, at most 3 % of a piece. Either kind has a linear
program of its own, over patterns, i.e. multisets of classes that fit one sequence, which is
solved by column generation: a knapsack dynamic program prices new patterns against the duals.
Rounded-down patterns cover nearly all pieces; what is left, a number bounded by the
number of classes, is packed first-fit decreasing. Each class's slots are then handed to
its pieces by rank.

The program sees only the histogram, about 740 rows, whatever the input.
Ranks come from salted groups of a class, so that no class lies in one task; each piece has
a number of its own, so that ranks are the same when a task is run again.

Defined results: null text counts as empty, and an empty document still has its end id.
Repeated or null ``doc_id`` values are kept as rows of their own. Other columns of the
input are dropped. No documents, no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_size, narrow_batches, read_table, salt_of, staged
from .word_ids import TEXTS_AT_ONCE, word_ids

SEQUENCE = 4096
UNIT = 8
SHORT = 256
FEW = 4096  # pieces: rounding may cost so few more than the program gains
GAP = 0.01  # of the number of sequences, left to the linear program's optimum
END_ID = 2
ROWS_PER_SALT = 50_000
LEAST_SALTS = 64
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def cut_documents(docs: DataFrame, sequence: int = SEQUENCE, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids) of documents (doc_id, text); ``ids``
    holds little-endian unsigned 32-bit integers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for whole in batches:
            for batch in by_size(whole, "text", TEXTS_AT_ONCE):
                rows = []
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode_batch(batch.column("text")), strict=True):
                    ids = np.append(ids, end_id).astype("<u4")
                    rows += [(doc_id, a, min(sequence, len(ids) - a), len(ids), ids[a : a + sequence].tobytes()) for a in range(0, len(ids), sequence)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.binary(),), strict=True)], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    narrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def knapsack(values: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best value of an unbounded knapsack and how often it takes each item. An item is
    offered once, twice, four times ...: each offer is one step over all capacities."""
    best, offers = np.zeros(capacity + 1), []
    for k in np.flatnonzero(values > 1e-12).tolist():
        times, value, width = 1, float(values[k]), int(widths[k])
        while times * width <= capacity:
            gains = best[: capacity + 1 - times * width] + times * value
            better = gains > best[times * width :] + 1e-12
            np.copyto(best[times * width :], gains, where=better)
            offers.append((k, times, times * width, better))
            times *= 2
    pattern, room = np.zeros(len(widths)), capacity
    for k, times, width, better in reversed(offers):
        if room >= width and better[room - width]:
            pattern[k] += times
            room -= width
    return float(best[capacity]), pattern


def cutting_stock(widths: np.ndarray, demand: np.ndarray, capacity: int, steps: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Columns (class x pattern) of a basis of the linear program and their amounts.
    ``widths`` ascend. No solution is below the present one divided by the best pattern's
    value, so a value of 1 + GAP ends the search. Any basis is feasible: stopping early
    costs padding only."""
    m = len(widths)
    columns = np.diag(np.floor(capacity / widths))
    inverse = np.diag(1 / np.diag(columns))
    amounts = inverse @ demand
    for step in range(steps):
        if step and step % 200 == 0:
            inverse = np.linalg.inv(columns)
            amounts = np.maximum(inverse @ demand, 0)
        value, pattern = knapsack(inverse.sum(0), widths, capacity)
        if value <= 1 + GAP:
            break
        way = inverse @ pattern
        able = way > 1e-9
        ratios = np.full(m, np.inf)
        ratios[able] = amounts[able] / way[able]
        out = int(np.argmin(ratios))
        amounts = np.maximum(amounts - ratios[out] * way, 0)
        amounts[out] = ratios[out]
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        columns[:, out] = pattern
    return columns, amounts


def first_fit(widths: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Sequences for the items that rounding leaves, widest first."""
    rooms = np.zeros(int(demand.sum()), dtype=np.int64) + capacity
    filled = np.zeros((len(rooms), len(widths)), dtype=np.int64)
    for k in range(len(widths) - 1, -1, -1):
        for _ in range(int(demand[k])):
            place = int(np.argmax(rooms >= widths[k]))
            rooms[place] -= widths[k]
            filled[place, k] += 1
    return [f for f in filled if f.any()]


def patterns(histogram: dict[int, int], capacity: int, scale: int = 1) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(classes, copies of each, sequences) that together hold every counted piece. Classes
    are multiples of ``scale``."""
    out: list[tuple[np.ndarray, np.ndarray, int]] = []
    if histogram.get(capacity):
        out.append((np.array([capacity]), np.array([1]), histogram[capacity]))
    classes = np.array(sorted(w for w in histogram if w < capacity), dtype=np.int64)
    if not len(classes):
        return out
    widths, room = classes // scale, capacity // scale
    demand = np.array([histogram[w] for w in classes.tolist()], dtype=np.int64)
    columns, amounts = cutting_stock(widths, demand.astype(float), room)
    left = demand.copy()
    for k in np.argsort(-amounts, kind="stable"):
        column = np.rint(columns[:, k]).astype(np.int64)
        used = column > 0
        times = int(min(np.floor(amounts[k] + 1e-6), np.min(left[used] // column[used])))
        if times > 0:
            left -= times * column
            out.append((classes[used], column[used], times))
    for column in first_fit(widths, left, room):
        out.append((classes[column > 0], column[column > 0], 1))
    if demand.sum() <= FEW:
        plain = [(classes[c > 0], c[c > 0], 1) for c in first_fit(widths, demand, room)]
        if len(plain) < sum(times for _, _, times in out) - histogram.get(capacity, 0):
            out = out[: 1 if histogram.get(capacity) else 0] + plain
    return out


def length_class(length: Column, unit: int) -> Column:
    """The room that a piece is given: its length if it is short, else whole units."""
    return F.when(length < SHORT, length).otherwise(F.ceil(length / unit) * unit).cast("int")


def plan_of(histogram: dict[int, int], sequence: int, unit: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    short = {c: n for c, n in histogram.items() if c < SHORT}
    long = {c: n for c, n in histogram.items() if c >= SHORT}
    return patterns(short, sequence) + patterns(long, sequence, unit)


def planned(histogram: DataFrame, sequence: int, unit: int) -> DataFrame:
    """(_class, _low, _high, _copies, _base), staged: ranks _low to _high of a class go, _copies
    to a sequence, into the sequences from _base on. The program runs in a task, where Spark
    keeps the linear algebra to the task's cores; its input is a row a class."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[int, int] = {}
        for batch in batches:
            counted |= dict(zip(batch.column("_class").to_pylist(), batch.column("n").to_pylist(), strict=True))
        slots, low, base = [], dict.fromkeys(counted, 0), 0
        for classes, copies, times in plan_of(counted, sequence, unit):
            for c, n in zip(classes.tolist(), copies.tolist(), strict=True):
                slots.append((c, low[c], low[c] + n * times, n, base))
                low[c] += n * times
            base += times
        names = ["_class", "_low", "_high", "_copies", "_base"]
        if slots:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*slots, strict=True)], names=names)

    return staged(histogram.coalesce(1).mapInArrow(solve, "_class long, _low long, _high long, _copies long, _base long"), "packing-plan")


def pack_pieces(pieces: DataFrame, sequence: int = SEQUENCE, unit: int = UNIT) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, start, length, ...), which are staged;
    other columns stay. ``unit`` divides ``sequence``."""
    spark, columns = pieces.sparkSession, pieces.columns
    pieces = staged(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    classed = pieces.withColumn("_class", length_class(F.col("length"), unit))
    histogram = staged(classed.groupBy("_class").agg(F.count("*").alias("n")), "lengths")
    plan = planned(histogram, sequence, unit)
    salts = max(LEAST_SALTS, -(-(histogram.agg(F.max("n")).first()[0] or 0) // ROWS_PER_SALT))
    salted = classed.withColumn("_salt", salt_of(salts, "_piece"))
    before = (
        salted.groupBy("_class", "_salt").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("_class").orderBy("_salt")) - F.col("_n"))
        .drop("_n")
    )
    within = Window.partitionBy("_class", "_salt").orderBy("doc_id", "start", "_piece")
    ranked = (
        salted.withColumn("_row", F.row_number().over(within) - 1)
        .join(before, ["_class", "_salt"])
        .withColumn("_rank", F.col("_row") + F.col("_before"))
    )
    # The plan has a few rows for each class and pattern, whose numbers do not grow with the input.
    held = ranked.join(F.broadcast(plan.withColumnRenamed("_class", "_of")), (F.col("_class") == F.col("_of")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")))
    placed = held.withColumn("sequence_id", F.col("_base") + F.expr("(_rank - _low) div _copies"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    packed = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))
    return packed.select(*columns, F.col("sequence_id").cast("long"), "offset")


def pack_documents(docs: DataFrame, sequence: int = SEQUENCE, unit: int = UNIT, end_id: int = END_ID) -> DataFrame:
    """The packed pieces with their ids."""
    return pack_pieces(cut_documents(docs, sequence, end_id), sequence, unit)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(read_table(spark, sf_dir, "documents"))


def packed_digests(docs: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of the ids."""
    pieces = cut_documents(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack_pieces(pieces)

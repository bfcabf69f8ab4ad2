"""Quality classifier: ordinal regression with cumulative links on graded ratings.

A rating is 0 (toxic), 1 (not toxic, low quality) or 2 (not toxic, good). Features are
the shares of a text's hashed words and hashed word shapes (``Ab1%``: upper, lower, digit,
marks, runs once) and one for its share of different words. One weight vector serves all
grades; ordered thresholds t0 < t1 give P(grade <= k) = logistic(t_k - score), from
which follow the expected grade and the tail probability P(grade = 2).

Fitting takes all labelled documents: executors extract and stage their features. Up to
``FEATURES`` of them the driver fits on all of these rows (full batches, adaptive steps).
Beyond that each step of the fit (L-BFGS, scaled by the features' mean squares, until a
step gains less than a share ``GAIN``, by the mean of five) is a pass of tasks over all rows; they return the sums of
the gradient, which are as many as the features that get a weight. Scoring covers every
whole text.

Defined results: null or blank text has no features and scores zero. A document with
several labels takes the lowest grade; labels with nulls are left out. Without two grades
there is no model: null results, kept. Rows with equal or null ``doc_id`` are kept; in
the fit, a doc_id counts once, with its least text. Other columns of ``docs`` stay
(in ``classify``, those named as its results are replaced; in ``keep_good``, none).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, drop_cache, free_names, hashes_of, in_chunks, narrow_batches, read_table, split_words, staged, summed, word_places

GRADES = 3
FEATURES = 3_000_000
WORDS = 1 << 19
SHAPES = 1 << 10
VARIETY = 16
SIZE = WORDS + SHAPES + VARIETY
SCALE = 30.0
STEPS = 200
LEAST_DOCUMENTS = 10  # of a feature that gets a weight
PENALTY = 2e-4
GAIN, PASSES, REMEMBERED = 3e-5, 200, 10
SELECT_AT = 0.35

# Digits, upper-case letters and other letters, and what a run of each is shown as.
_KINDS = ((r"\p{N}+", "1"), (r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]+", "a"))


class Model(NamedTuple):
    weights: np.ndarray  # SIZE
    thresholds: np.ndarray  # GRADES - 1, ascending


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of each word's two features; SIZE stands for none."""
    places, shown = word_places(words, WORDS), words
    for pattern, sign in _KINDS:
        shown = pc.replace_substring_regex(shown, pattern, sign)
    forms = WORDS + (hashes_of(shown, runs_once=True) % np.uint64(SHAPES)).astype(np.int64)
    return np.where(places < 0, SIZE, places), np.where(words.to_numpy(zero_copy_only=False) == "", SIZE, forms)


def variety(codes: np.ndarray) -> int:
    """The feature of a text's share of different words, by text length up to a point."""
    n = len(codes)
    share = len(np.unique(codes)) / n if n else 1.0
    return WORDS + SHAPES + (8 if n >= 50 else 0) + min(7, int(share * 8))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and value of all features, and the row of each, of a batch."""
    words, codes, bounds = split_words(texts)
    first, second = word_features(words)
    lengths = np.diff(bounds)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    share = SCALE / np.maximum(lengths, 1)
    extra = np.array([variety(codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.int64)
    places = np.concatenate([first[codes], second[codes], extra])
    values = np.concatenate([share[rows], share[rows], np.where(lengths > 0, 1.0, 0.0)])
    row = np.concatenate([rows, rows, np.arange(len(lengths))])
    used = places < SIZE
    return places[used], values[used], row[used]


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(grade, text) of all labelled documents. Only texts of repeated ids are grouped."""
    graded = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy("doc_id").agg(F.min(F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)).alias("grade"))
    )
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg((F.count("*") > 1).alias("repeated"))
    of_docs = staged(ids.join(graded, "doc_id"), "graded")
    held = docs.select("doc_id", F.col("text").cast("string"))
    once = held.join(of_docs.where("not repeated"), "doc_id").select("grade", "text")
    repeated = of_docs.where("repeated")
    if repeated.isEmpty():
        return once
    return once.unionByName(held.join(repeated, "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("grade", "text"))


def rated_features(rows: DataFrame) -> DataFrame:
    """(grade, n, places, amounts) of each document (grade, text), places ascending."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        for whole in batches:
            for batch in by_size(whole, "text"):
                places, values, rows = features(batch.column("text"))
                key, inverse = np.unique(rows * (SIZE + 1) + places, return_inverse=True)
                sums = np.bincount(inverse, values, len(key)).astype(np.float32)
                counts = np.bincount(key // (SIZE + 1), minlength=batch.num_rows)
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(key % (SIZE + 1), pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(sums))]
                yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(counts, pa.int64()), *lists], names=["grade", "n", "places", "amounts"])

    narrow_batches(rows.sparkSession)
    return rows.select("grade", "text").mapInArrow(work, "grade int, n long, places array<int>, amounts array<float>")


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbours of ``bounds``, 0 where they are equal."""
    out, held = np.zeros(len(bounds) - 1), bounds[1:] > bounds[:-1]
    if held.any():
        out[held] = np.add.reduceat(values, bounds[:-1][held], dtype=np.float64)
    return out


def fit_ordinal(places: np.ndarray, amounts: np.ndarray, bounds: np.ndarray, grades: np.ndarray, counts: dict[int, int]) -> Model:
    """Least penalised negative log-likelihood, by Adam on all rows at once; row k has the
    features bounds[k] to bounds[k + 1]. Each row stands for as many documents as its grade
    has for each in the sample, so that the sample's bound does not change how frequent the
    grades are. All that is as long as the features has 32 bits: 16 bytes a feature."""
    n, often = len(grades), np.bincount(places, minlength=SIZE) >= LEAST_DOCUMENTS
    active, used = np.flatnonzero(often), often[places]
    index = np.cumsum(often, dtype=np.int32) - np.int32(1)
    at, amounts = index[places[used]], amounts[used].astype(np.float32)
    bounds = np.append(0, np.cumsum(used, dtype=np.int64))[bounds]
    m = len(active)
    order = np.argsort(at, kind="stable")
    row_of = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))[order]
    amount_of, columns = amounts[order], np.append(0, np.cumsum(np.bincount(at, minlength=m)))
    del order, used, index
    sampled = np.bincount(grades, minlength=GRADES)
    stands = np.array([counts.get(g, 0) / max(sampled[g], 1) for g in range(GRADES)])[grades]
    stands *= n / stands.sum()
    share = np.clip(np.cumsum(np.bincount(grades, stands, GRADES))[:-1] / n, 0.01, 0.99)
    cuts = np.log(share / (1 - share))
    state = np.concatenate([np.zeros(m), [cuts[0]], np.log(np.maximum(np.diff(cuts), 0.05))])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, STEPS + 1):
        gaps = np.exp(state[m + 1 :])
        cuts = state[m] + np.append(0, np.cumsum(gaps))
        score = segment_sums(amounts * state[:m].astype(np.float32)[at], bounds)
        ends = np.concatenate([[-np.inf], cuts, [np.inf]])
        high, low = logistic(ends[grades + 1] - score), logistic(ends[grades] - score)
        high[grades == GRADES - 1], low[grades == 0] = 1, 0
        p = np.maximum(high - low, 1e-9)
        slope_high, slope_low = stands * high * (1 - high) / p, stands * low * (1 - low) / p
        by_score = ((slope_high - slope_low) / n).astype(np.float32)
        by_cut = np.array([slope_low[grades == k + 1].sum() - slope_high[grades == k].sum() for k in range(GRADES - 1)]) / n
        by_gap = [by_cut[k + 1 :].sum() * gaps[k] for k in range(GRADES - 2)]
        gradient = np.concatenate([segment_sums(amount_of * by_score[row_of], columns) + PENALTY * state[:m], [by_cut.sum()], by_gap])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        state = state - 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    weights = np.zeros(SIZE, np.float32)
    weights[active] = state[:m]
    return Model(weights, state[m] + np.append(0, np.cumsum(np.exp(state[m + 1 :]))))


def bounded_sample(rows: DataFrame) -> DataFrame:
    """Of each grade's rows (grade, share, n) those of lowest share with ``FEATURES``
    features at most, the first at least. No model comes from these: ``fit`` takes all rows."""
    sizes = rows.select("grade", "share", "n").toArrow().sort_by([("grade", "ascending"), ("share", "ascending")])
    grades, shares, n = (sizes.column(c).to_numpy() for c in ("grade", "share", "n"))
    last = {int(g): float(shares[grades == g][max(0, np.searchsorted(np.cumsum(n[grades == g]), FEATURES, "right") - 1)]) for g in np.unique(grades)}
    return rows.where(reduce(or_, [(F.col("grade") == g) & (F.col("share") <= s) for g, s in last.items()], F.lit(False)))


def listed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and amount of all features of a batch of ``rated_features``."""
    lists = batch.column("places")
    rows = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return rows, lists.flatten().to_numpy(), batch.column("amounts").flatten().to_numpy()


def minimise(value_of: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray) -> np.ndarray:
    """Where a smooth function is least, by L-BFGS; ``value_of`` gives value and gradient."""
    at, steps, turns = start, [], []
    value, slope = value_of(at)
    passes, values = 1, [value]
    while passes < PASSES:
        way, shares = -slope, []
        for s, y in zip(reversed(steps), reversed(turns), strict=True):
            shares.append(s @ way / (s @ y))
            way = way - shares[-1] * y
        if steps:
            way = way * (steps[-1] @ turns[-1] / (turns[-1] @ turns[-1]))
        for s, y, share in zip(steps, turns, reversed(shares), strict=True):
            way = way + (share - y @ way / (s @ y)) * s
        length = 1.0
        while True:
            new_value, new_slope = value_of(at + length * way)
            passes += 1
            if new_value <= value + 1e-4 * length * (slope @ way):
                break
            length /= 4
            if length < 1e-6 or passes >= PASSES:
                return at
        s, y = length * way, new_slope - slope
        if s @ y > 1e-12:
            steps, turns = [*steps, s][-REMEMBERED:], [*turns, y][-REMEMBERED:]
        at, value, slope = at + s, new_value, new_slope
        values.append(value)
        if len(values) > 5 and values[-6] - value < 5 * GAIN * value:
            break
    return at


def fit_over_all(rows: DataFrame, counts: dict[int, int]) -> Model:
    """The model of ``fit_ordinal`` for all ``rated_features``, by passes over them."""
    context, n = rows.sparkSession.sparkContext, sum(counts.values())
    # A task gives one array of sums, whatever it reads: no more tasks than run at once, so
    # that what a pass shuffles does not grow with the rows.
    rows = rows.coalesce(context.defaultParallelism)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        often, squares = np.zeros(SIZE), np.zeros(SIZE)
        for batch in batches:
            _, places, amounts = listed(batch)
            np.add.at(often, places, 1.0)
            np.add.at(squares, places, amounts.astype(np.float64) ** 2)
        yield from in_chunks(np.concatenate([often, squares]))

    sums = summed(rows.select("places", "amounts").mapInArrow(moments, "chunk int, data binary"), 2 * SIZE)
    active = np.flatnonzero(sums[:SIZE] >= LEAST_DOCUMENTS)
    m = len(active)
    index = np.full(SIZE, m, np.int32)  # m: without a weight
    index[active] = np.arange(m)
    columns = context.broadcast(index)
    scale = np.sqrt(np.append(PENALTY + sums[SIZE:][active] / (4 * n), np.full(GRADES - 1, 0.25)))

    def value_of(scaled: np.ndarray) -> tuple[float, np.ndarray]:
        state = scaled / scale
        gaps = np.exp(state[m + 1 :])
        cuts = state[m] + np.append(0, np.cumsum(gaps))
        shared = context.broadcast((np.append(state[:m], 0), cuts))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop_cache()
            weights, cuts = shared.value
            total = np.zeros(m + 1 + GRADES)  # slopes by weight (the one at m is none), by cut, loss
            ends = np.concatenate([[-np.inf], cuts, [np.inf]])
            for batch in batches:
                row, places, amounts = listed(batch)
                at, grades = columns.value[places], batch.column("grade").to_numpy()
                score = np.bincount(row, amounts * weights[at], batch.num_rows)
                high, low = logistic(ends[grades + 1] - score), logistic(ends[grades] - score)
                high[grades == GRADES - 1], low[grades == 0] = 1, 0
                p = np.maximum(high - low, 1e-9)
                slope_high, slope_low = high * (1 - high) / p, low * (1 - low) / p
                np.add.at(total, at, amounts * (slope_high - slope_low)[row])
                for k in range(GRADES - 1):
                    total[m + 1 + k] += slope_low[grades == k + 1].sum() - slope_high[grades == k].sum()
                total[-1] -= np.log(p).sum()
            yield from in_chunks(total)

        total = summed(rows.select("grade", "places", "amounts").mapInArrow(work, "chunk int, data binary"), m + 1 + GRADES) / n
        shared.destroy()
        by_cut = total[m + 1 : -1]
        by_gap = [by_cut[k + 1 :].sum() * gaps[k] for k in range(GRADES - 2)]
        gradient = np.concatenate([total[:m] + PENALTY * state[:m], [by_cut.sum()], by_gap])
        return total[-1] + PENALTY / 2 * (state[:m] @ state[:m]), gradient / scale

    share = np.clip(np.cumsum([counts.get(g, 0) for g in range(GRADES)])[:-1] / n, 0.01, 0.99)
    cuts = np.log(share / (1 - share))
    start = np.concatenate([np.zeros(m), [cuts[0]], np.log(np.maximum(np.diff(cuts), 0.05))])
    state = minimise(value_of, start * scale) / scale
    weights = np.zeros(SIZE, np.float32)
    weights[active] = state[:m]
    return Model(weights, state[m] + np.append(0, np.cumsum(np.exp(state[m + 1 :]))))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    rows = staged(rated_features(rated(docs, labels)), "ratings")
    sums = rows.groupBy("grade").agg(F.count("*").alias("documents"), F.sum("n").alias("n")).collect()  # GRADES rows
    counts = {r["grade"]: r["documents"] for r in sums}
    if len(counts) < 2:
        return None
    if sum(r["n"] for r in sums) > FEATURES:
        return fit_over_all(rows, counts)
    all_rows = rows.toArrow().sort_by([("grade", "ascending"), ("n", "ascending")])
    lists = all_rows.column("places").combine_chunks()
    bounds = np.append(0, np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64))
    places, amounts = lists.flatten().to_numpy(), all_rows.column("amounts").combine_chunks().flatten().to_numpy()
    return fit_ordinal(places, amounts, bounds, all_rows.column("grade").to_numpy().astype(np.int64), counts)


RESULTS = ("expected_grade", "p_good", "kept")


def classify(docs: DataFrame, model: Model | None, results: tuple[str, ...] = RESULTS) -> DataFrame:
    """``docs`` with expected_grade, p_good and kept (p_good >= SELECT_AT), under the names of ``results``."""
    names = [c for c in docs.columns if c not in results]
    rows = docs.select(*names)
    if model is None:
        values = (F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(True))
        return rows.select("*", *[v.alias(c) for v, c in zip(values, results, strict=True)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        weights, cuts = np.append(shared.value.weights, np.float32(0)), shared.value.thresholds
        for whole in batches:
            for batch in by_size(whole, "text"):
                words, codes, bounds = split_words(batch.column("text"))
                first, second = word_features(words)
                lengths = np.diff(bounds)
                score = SCALE * segment_sums((weights[first] + weights[second])[codes], bounds) / np.maximum(lengths, 1)
                extra = np.array([variety(codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.int64)
                score += np.where(lengths > 0, weights[extra], 0)
                above = 1 - logistic(cuts[None, :] - score[:, None])
                columns = [*(batch.column(c) for c in names), pa.array(above.sum(1)), pa.array(above[:, -1]), pa.array(above[:, -1] >= SELECT_AT)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *results])

    narrow_batches(docs.sparkSession)
    schema = type(docs.schema)(list(rows.schema.fields))
    for name, kind in zip(results, ("double", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return rows.mapInArrow(work, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier selects, with its own columns, whatever their names."""
    results = free_names(docs, *RESULTS)
    return classify(docs, fit(docs, labels), tuple(results)).where(F.col(results[-1])).select(*docs.columns)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return classify(docs.select("doc_id", "text"), model).select("doc_id", *RESULTS)

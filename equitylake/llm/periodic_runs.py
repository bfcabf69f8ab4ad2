"""Periodic runs of words by Lyndon arrays on an ordered alphabet.

A run with period q has Lyndon words of length q as roots, for one of the two orders of
its alphabet, and a root is the longest Lyndon word that begins at its place: it ends where
the next smaller suffix begins. So both orders' next smaller suffixes, with the length of
what each place and its next smaller suffix have in common, give all runs. A word's number
is its place among the text's different words: any order of the alphabet serves.

Suffixes are compared from left to right along the chain of previous smaller suffixes, as
for next smaller values. What two of them have in common is not matched anew: along the
chain it is the less of two known lengths if these differ; and within the stretch that was
matched farthest to the right it is what the pair one period earlier has, up to that
stretch's end, from where alone words are compared. No suffix array, no hash of words.

Each text is one row and one task's work, in memory proportional to its words. Defined
results: null text has no words and no runs. A null ``doc_id`` is crc32 of nothing for the
query's repetition: its text is left alone. Rows are kept as they come, repeated ones too;
other columns are dropped. No documents, no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, narrow_batches, read_table

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
Run = tuple[int, int, int]  # start, length, period


def next_smaller(x: list[int]) -> tuple[list[int], list[int]]:
    """For each place of ``x`` the next one whose suffix is smaller (len(x) if none), and
    how long both suffixes agree. A suffix that ends is smaller than one that goes on."""
    n = len(x)
    x = [*x, min(x, default=0) - 1]
    after, common = [n] * n, [0] * n  # next smaller suffix, and the length in common with it
    before, shared = [-1] * n, [0] * n  # previous smaller suffix, likewise
    left = right = end = 0  # x[left:] and x[right:] agree up to place ``end`` of the latter
    for r in range(1, n):
        j, e, here = r - 1, 0, x[r]
        if x[j] < here:
            before[r] = j
            continue
        fresh = x[j] == here  # whether the length in common is still to be found
        while True:
            if fresh:
                fresh = False
                if r + e < end:
                    d = right - left
                    if j >= right and after[j - d] == r - d:
                        e = max(e, min(common[j - d], end - r))
                    elif j >= right and before[r - d] == j - d:
                        e = max(e, min(shared[r - d], end - r))
                while x[j + e] == x[r + e]:
                    e += 1
                if r + e > end:
                    left, right, end = j, r, r + e
            if x[j + e] < x[r + e]:
                break
            after[j], common[j] = r, e
            k = before[j]
            if k < 0:
                j, e = -1, 0
                break
            if shared[j] < e:
                e = shared[j]
            else:
                fresh = shared[j] == e
            j = k
        before[r], shared[r] = j, e
    return after, common


def runs(x: list[int], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[Run]:
    """The runs of ``x`` of at least so many items and, of at least 3, so many periods, by
    start, then period.

    The leftmost root of a run begins less than a period after it, so that of three periods
    more than one lies behind that root's end: other places need no look to their left."""
    n, found = len(x), {}
    for order in (x, [-v for v in x]):
        after, common = (np.array(a, np.int64) for a in next_smaller(order))
        period = after - np.arange(n)
        for a in np.flatnonzero((common > period) & (after < n)).tolist():
            p, stop = int(period[a]), int(after[a] + common[a])
            if found.get((stop, p), n) <= a:
                continue  # a root of a run that a place before it gave
            start = a
            while start and x[start - 1] == x[start - 1 + p]:
                start -= 1
            found[stop, p] = start
    long = [(start, stop - start, p) for (stop, p), start in found.items() if stop - start >= max(least_length, least_exponent * p)]
    return sorted(long, key=lambda r: (r[0], r[2]))


def strongest(found: list[Run]) -> Run | None:
    """The run of greatest length/period, compared exactly; of equal ones the first."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_places(n: int, found: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay if a run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def repetition(doc_id: int | None, n: int) -> tuple[int, int]:
    """From which word on, and with which period, the query repeats a document's words;
    (n, 1) for no repetition. It plants runs in a tenth of the documents."""
    g, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if doc_id is None or last or not n:
        return n, 1
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes: ASCII white space only


def numbered(words: list[bytes]) -> list[int]:
    known: dict[bytes, int] = {}
    return [known.setdefault(w, len(known)) for w in words]


RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _with_runs(docs: DataFrame, collapsed: bool, planted: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "text"):
                out = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    words = words_of(text.as_py())
                    if planted:
                        a, p = repetition(doc_id, len(words))
                        words[a:] = [words[a + k % p] for k in range(len(words) - a)]
                    found = runs(numbered(words))
                    kept = [w for w, stays in zip(words, kept_places(len(words), found), strict=True) if stays] if found else words
                    joined = b" ".join(kept)
                    best = strongest(found)
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
                    tail = (joined.decode(),) if collapsed else (hashlib.sha256(listed).hexdigest(), hashlib.sha256(joined).hexdigest())
                    out.append((doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *tail))
                types = [pa.int64()] * 6 + [pa.string()] * len(tail)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    schema = "doc_id long, " + (RESULT.rsplit(", ", 2)[0] + ", collapsed string" if collapsed else RESULT)
    names = [c.split()[0] for c in schema.split(", ")]
    narrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, collapsed) of documents
    (doc_id, text): the strongest run, nulls if none, and the text with each run cut to its
    first period, words joined by one space."""
    return _with_runs(docs, collapsed=True, planted=False)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_runs(read_table(spark, sf_dir, "documents"), collapsed=False, planted=True)

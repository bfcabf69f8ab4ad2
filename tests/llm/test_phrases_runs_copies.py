"""Collocations, periodic runs and MinHash near-duplicates against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ops import DOCS, EDGES, row

from equitylake.llm import collocations, minhash, periodic_runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_collocations(rows, most=2000):
    out = []
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2] or "und"] += [re.findall(r"[^ \t]+", piece) for piece in re.split(r"[.,;:!?\n-\r]", lowered(r[1]))]
    for lang, pieces in by_lang.items():
        f = [None] + [Counter(tuple(p[i : i + k]) for p in pieces for i in range(len(p) - k + 1)) for k in (1, 2, 3)]
        found = {p: a for k in (2, 3) for p, a in f[k].items() if a >= 10}
        scored = []
        for phrase, a in found.items():
            size = len(phrase)
            if any(len(q) > size and 100 * b >= 50 * a and any(q[i : i + size] == phrase for i in range(len(q) - size + 1)) for q, b in found.items()):
                continue
            cuts = [(1000000 * a * a // (f[k][phrase[:k]] * f[size - k][phrase[k:]]), k) for k in range(1, size)]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), f[k][phrase[:k]], f[size - k][phrase[k:]]))
        n = sum(map(len, pieces))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(5)
    vocabulary = ["An", "of", "the", "É", "new", "york", "city", "x", "y"]
    rows = [row(k, " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None, "und"])) for k in range(60)]
    return rows + [row(100, "new york city " * 30 + "the the the the"), row(100, "new york city " * 30), row(None, "A-b " * 5000, "fr"), row(101, None), row(102, " \t\n."), row(103, "a" * 100_000)]


@pytest.mark.parametrize("most", [3, 2000])
def test_collocations(spark, monkeypatch, most):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 300)
    rows = phrase_rows()
    found = collocations.collocations(spark.createDataFrame(rows, DOCS), most)
    assert sorted(tuple(r) for r in found.collect()) == brute_collocations(rows, most)


def test_collocations_of_edge_cases(edges, none):
    assert sorted(tuple(r) for r in collocations.collocations(edges).collect()) == brute_collocations(EDGES)
    found = collocations.collocations(none)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.isEmpty()


def test_score_is_exact_beyond_64_bits(spark):
    a, left, right = 987_654_321_987, 999_999_999_989, 999_999_000_001
    frame = spark.createDataFrame([(a, left, right), (10, 10, 10), (10, 3_000_000, 7)], "a long, l long, r long")
    got = [r[0] for r in frame.select(collocations.score(*[frame[c] for c in "alr"])).collect()]
    assert got == [1000000 * a * a // (left * right), 1000000, 1000000 * 100 // 21_000_000]


def brute_runs(x, least_length, least_exponent):
    n, out = len(x), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and x[j] == x[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least_length, least_exponent * p):
                w = x[i : i + length]
                if not any(w[q:] == w[:-q] for q in range(1, p)):
                    out.add((i, length, p))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_are_those_of_all_periods():
    rng = random.Random(2)
    for _ in range(3000):
        x = [rng.randrange(rng.choice([1, 2, 2, 3])) for _ in range(rng.randrange(60))]
        if x and rng.random() < 0.5:
            a = rng.randrange(len(x))
            p = 1 + (len(x) - a) // rng.randrange(2, 9)
            x[a:] = [x[a + k % p] for k in range(len(x) - a)]
        assert periodic_runs.runs(x, 2, 3) == brute_runs(x, 2, 3)
        after, _ = periodic_runs.next_smaller(x)
        assert after == [next((j for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x)) for i in range(len(x))]


class Counted(int):
    looks = 0

    def __eq__(self, other):
        Counted.looks += 1
        return int(self) == int(other)

    __hash__ = int.__hash__


def test_work_is_linear_in_the_text():
    fibonacci = ["0", "01"]
    while len(fibonacci[-1]) < 6000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    nested = (([0] * 20 + [1]) * 20 + [2]) * 15
    for x in ([1] * 6000, [*map(int, fibonacci[-1])], nested, [2 - v for v in nested], [*range(300)] * 20, [k.bit_count() & 1 for k in range(6000)]):
        Counted.looks = 0
        periodic_runs.next_smaller([Counted(v) for v in x])
        assert Counted.looks < 8 * len(x)


def expected_runs(doc_id, text, planted):
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and n:
        a, g = h // 10 % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words, 24, 3)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return found, best, kept


def test_periodic_runs(spark, edges, none, monkeypatch):
    rng = random.Random(8)
    rows = [r for r in EDGES if len(r[1] or "") < 1000] + [row(k, " ".join(rng.choice("abcde") for _ in range(rng.randrange(200)))) for k in range(20, 120)]
    monkeypatch.setattr(periodic_runs, "read_table", lambda *_: spark.createDataFrame(rows, DOCS))
    got = Counter(tuple(r) for r in periodic_runs.op12_periodic_runs(spark, "").collect())
    want = Counter()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        found, best, kept = expected_runs(r[0], r[1], True)
        want[(r[0], len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept))] += 1
    assert got == want and any(r[1] for r in got)
    whole = {r["doc_id"]: r for r in periodic_runs.collapse_runs(edges).collect()}
    assert (whole[8]["n_runs"], whole[8]["length"], whole[8]["period"], whole[8]["collapsed"]) == (1, 9000, 1, "word")
    assert (whole[1]["n_runs"], whole[1]["start"], whole[1]["collapsed"]) == (0, None, "")
    assert periodic_runs.collapse_runs(none).isEmpty()


def test_long_text_of_one_word(spark):
    got = periodic_runs.collapse_runs(spark.createDataFrame([row(1, "x y " * 150_000)], DOCS)).first()
    assert (got["n_runs"], got["length"], got["period"], got["collapsed"]) == (1, 300_000, 2, "x y")


def brute_sets(rows):
    out = []
    for r in rows:
        w = WORDS.findall(lowered(r[1]))
        out.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()})
    return out


def brute_copies(rows):
    sets, n = brute_sets(rows), len(rows)
    label = list(range(n))
    links = [(i, j) for i in range(n) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    least = {}
    for k in range(n):
        if rows[k][0] is not None:
            least[label[k]] = min(least.get(label[k], rows[k][0]), rows[k][0])
    return Counter((rows[k][0], len(sets[k]), least.get(label[k]), rows[k][0] is not None and rows[k][0] == least.get(label[k])) for k in range(n))


def copies_rows(rng, passage_share):
    """Chains of edited copies, short texts, and texts around one passage that all share."""
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(int(60 * passage_share))]
    texts = []
    for k in range(90):
        own = [word() for _ in range(rng.choice([1, 2, 3, 4, 5, 9, 60]))]
        if k % 3 == 0:
            own = passage + [word() for _ in range(60 - len(passage))]
        for _ in range(rng.randrange(1, 5)):
            texts.append(" ".join(own))
            own = list(own)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = word()
    return [row(k * 7 % 1009, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("crowd,huge,share", [(64, 4096, 0.5), (2, 4096, 0.85), (2, 3, 0.85)])
def test_copies_are_those_of_all_pairs(spark, monkeypatch, crowd, huge, share):
    monkeypatch.setattr(minhash, "CROWD", crowd)
    monkeypatch.setattr(minhash, "HUGE", huge)
    monkeypatch.setattr(minhash, "BLOCK_NODES", 4)
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    rows = copies_rows(random.Random(crowd * 100 + int(share * 10)), share) + EDGES
    got = Counter(tuple(r) for r in minhash.minhash_components(spark.createDataFrame(rows, DOCS)).collect())
    assert got == brute_copies(rows)


def test_sets_go_to_few_salts(spark):
    pairs = spark.createDataFrame([(1, b) for b in range(2, 12)] + [(20, b) for b in range(100, 400)], "a long, b long")
    salts = {r["a"]: r["n"] for r in minhash.dealt(pairs).groupBy("a").agg(F.countDistinct("salt").alias("n")).collect()}
    assert salts[1] == 1 and 4 < salts[20] <= 10
    assert minhash.dealt(pairs).select("a", "b").exceptAll(pairs).isEmpty() and minhash.dealt(pairs).count() == pairs.count()


def test_copies_of_edge_cases(edges, none):
    assert Counter(tuple(r) for r in minhash.minhash_components(edges).collect()) == brute_copies(EDGES)
    assert minhash.minhash_components(none).isEmpty()


def test_bins_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(4)
    for size, other in ((5, 5), (40, 20), (2000, 500)):
        agree = []
        for _ in range(300):
            x = rng.integers(0, 1 << 63, size + 2 * other, np.uint64) * np.uint64(2)
            a, b = np.sort(x[: size + other]), np.sort(np.append(x[:size], x[size + other :]))
            agree.append((minhash.minima(a) == minhash.minima(b)).mean())
        assert abs(np.mean(agree) - size / (size + 2 * other)) < 0.03

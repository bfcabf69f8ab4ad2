"""Each operator against a brute-force version or an exact round trip, on small tables
with nulls, blanks, repeated rows, long texts and columns of clashing names."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import compare
from pyspark.sql import functions as F

from equitylake.llm import chat_tree, common, decontaminate, language, packing, quality, quality_rules, simhash, token_counts, token_files, url_filter, word_ids
from equitylake.llm.registry import ORACLE_SQL, QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, start string"


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), "x", "y", "z")


EDGES = [
    row(1, None), row(2, ""), row(3, " \n\t "), row(4, "one"), row(5, "two words"), row(6, "The  quick\n\nbrown fox <|endoftext|> jumps"),
    row(7, "naïve Ünïcode 漢字 \u2003 spaces\u00a0here ▁ mark"), row(8, "word " * 9000), row(9, "a b c d e f g h i j k l m n o p"), row(9, "a b c d e f g h i j k l m n o p"),
    row(None, "no id here at all"), row(10, "A B C D E F G H I J K L M N O P", None, None), row(11, "\x00 zero \x1c sep"), row(12, "12345 !!! ???"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, sf, name):
    got, want = compare(spark, sf, QUERIES[name], ORACLE_SQL[name])
    assert got == want


def reference_ids(text):
    from tokenizers import Tokenizer
    import public_tokenizers

    if not hasattr(reference_ids, "t"):
        reference_ids.t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return reference_ids.t.encode(text or "", add_special_tokens=False).ids


def test_packing(spark, edges, none):
    rows = packing.pack_documents(edges).collect()
    whole = collections.Counter((r[0], tuple([*reference_ids(r[1]), 2])) for r in EDGES)
    cut = collections.Counter()
    for (doc_id, ids), times in whole.items():
        for a in range(0, len(ids), 4096):
            cut[doc_id, a, len(ids), np.array(ids[a : a + 4096], "<u4").tobytes()] += times
    assert collections.Counter((r["doc_id"], r["start"], r["doc_tokens"], bytes(r["ids"])) for r in rows) == cut
    held = collections.defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(none).count() == 0


def test_packing_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.packed_digests(docs).collect()
    sequences = len({r["sequence_id"] for r in rows})
    assert sum(r["length"] for r in rows) / (sequences * 4096) > 0.97


@pytest.mark.parametrize("most", [1, 5, 60])
def test_packing_padding_of_short_documents(spark, most):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % most + 1).cast("int")).alias("text"))
    found = packing.pack_documents(docs).agg(F.sum("length"), F.countDistinct("sequence_id"), F.count("*"), F.countDistinct("doc_id")).first()
    assert found[0] / (found[1] * 4096) > 0.97 and found[2] == found[3] == 30_000


def test_packing_of_rows_without_ids(spark):
    docs = spark.createDataFrame([row(None, "same text")] * 500 + [row(7, "same text")] * 500, DOCS)
    rows = packing.pack_documents(docs).collect()
    assert len(rows) == 1000 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 1000


def brute_print(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(ids, prints):
    label = list(range(len(ids)))
    for _ in ids:
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    least = {}
    for i, k in enumerate(label):
        if ids[i] is not None:
            least[k] = min(least.get(k, ids[i]), ids[i])
    return collections.Counter((ids[i], prints[i], least.get(k)) for i, k in enumerate(label))


def test_simhash(edges, none):
    rows = simhash.simhash_components(edges).collect()
    prints = [brute_print(r[1]) for r in EDGES]
    assert collections.Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in rows) == brute_components([r[0] for r in EDGES], prints)
    assert simhash.simhash_components(none).count() == 0
    kept = simhash.keep_one_of_each(edges)
    assert kept.columns == edges.columns
    assert kept.count() == len({r["component_id"] for r in rows})  # each has an id here


def test_simhash_links_are_those_of_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 60)
    flips = np.array([sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False)) for _ in range(600)])
    prints = np.unique(np.append(base[rng.integers(0, 60, 600)] ^ flips, [-1, -2, -(2**63)]))
    frame = spark.createDataFrame([(int(p),) for p in prints], "fp long")
    brute = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    label = np.arange(len(prints))
    for _ in range(20):
        label = np.where(brute, label[None, :], len(prints)).min(1)
    want = {int(p): int(prints[k]) for p, k in zip(prints, label)}
    for most in (2048, 3):  # 3: nearly all anchors go the way of the crowded ones
        monkeypatch.setattr(simhash, "MOST_COMPARED", most)
        rows = common.components(simhash.link_prints(frame)).collect()
        got = {int(p): int(p) for p in prints} | {r["node"]: r["component"] for r in rows}
        assert got == want


def test_simhash_links_over_all_64_bits(spark, monkeypatch):
    base = 0x0123456789ABCDEF
    masks = [*(1 << a | 1 << b for a in range(64) for b in range(a + 1, 64))]
    for mask in [*masks, 0xF << 60, 7 << 61, 7]:
        pair = np.array([base, base ^ mask], np.uint64).view(np.int64)
        assert bool(simhash.forest(pair)) == (0 < mask.bit_count() <= 2)
    rng = np.random.default_rng(6)
    values = [int(v) for v in rng.integers(0, 2**64, 40, np.uint64)]
    values += [values[k % 40] ^ sum(1 << int(b) for b in rng.choice(64, 1 + k % 4, replace=False)) for k in range(400)]
    values = sorted({v ^ m for v in values[:10] for m in (0, 1 << 63 | 1, 1 << 63 | 1 << 60, 0xF << 60)} | set(values))
    label = list(range(len(values)))
    near = [(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if (a ^ b).bit_count() <= 2]
    while (least := [min(label[j] for j in js) for js in _neighbours(near, len(values))]) != label:
        label = least
    want = {frozenset(values[i] for i in range(len(values)) if label[i] == k) for k in set(label)}
    frame = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp long")
    for most in (2048, 3):
        monkeypatch.setattr(simhash, "MOST_COMPARED", most)
        of = {v: v for v in values} | {r["node"] % 2**64: r["component"] % 2**64 for r in common.components(simhash.link_prints(frame)).collect()}
        assert {frozenset(v for v in values if of[v] == k) for k in set(of.values())} == want


def _neighbours(pairs, n):
    beside = [[] for _ in range(n)]
    for i, j in pairs:
        beside[i].append(j)
    return beside


def brute_statistics(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often, covered = collections.Counter(windows), set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(k, k + 5))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, edges, none):
    rows = quality_rules.quality_rules(edges).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collections.Counter((r["doc_id"], *(r[n] for n in names)) for r in rows) == collections.Counter((r[0], *brute_statistics(r[1])) for r in EDGES)
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) for r in rows)
    assert all(r["d2"] is not None and (not r["kept"] or not r["base_failed"]) for r in rows)
    assert quality_rules.quality_rules(none).count() == 0
    assert all(r["d2"] is None and not r["kept"] for r in quality_rules.quality_rules(edges.where("doc_id in (1, 2, 4)")).collect())


def factor_and_distance(x, mean, cov):
    z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
    return (z * z).sum(0)


def brute_estimate(x, steps=quality_rules.STEPS):
    """The estimate's definition in numpy: n, mean and covariance of one group."""
    n, floors = len(x), np.diag(np.square(quality_rules.FLOORS))
    quantile = lambda p: np.sort(x, 0)[max(0, int(np.ceil(p * n)) - 1)]
    spread = lambda y: np.cov(y.T, bias=True).reshape(4, 4) + floors if len(y) > 1 else floors
    inner = quality_rules.chi_square_quantile(quality_rules.SHARE, 2)
    consistent = quality_rules.SHARE / quality_rules.chi_square(inner, 3)
    found = []
    for mean, cov in ((quantile(0.5), floors), (quantile(0.5), np.diag(((quantile(0.75) - quantile(0.25)) / 1.349) ** 2) + floors), (x.mean(0), spread(x))):
        for _ in range(steps):
            level = np.floor(quality_rules.BINS * np.log2(factor_and_distance(x, mean, cov) + 1e-6))
            kept = level <= np.sort(level)[int(np.ceil(quality_rules.SHARE * n)) - 1]
            mean, cov = x[kept].mean(0), spread(x[kept])
        found.append((np.linalg.det(consistent * (cov - floors) + floors), mean, consistent * (cov - floors) + floors))
    det, mean, cov = min(found, key=lambda f: f[0])
    within = quality_rules.chi_square_quantile(0.975, 2)
    near = x[factor_and_distance(x, mean, cov) <= within]
    return len(near), near.mean(0), 0.975 / quality_rules.chi_square(within, 3) * (spread(near) - floors) + floors, det


def random_groups():
    rng = np.random.default_rng(3)
    x = rng.multivariate_normal([1, 2, 0, 0], np.diag([0.04, 0.09, 0.02, 0.03]) + 0.01, 900)
    x[:160] += 5
    return {"en-a": x[:800], "en-b": x[800:830] + 0.3, "de-a": x[830:833] - 1, "fr-a": x[840:841]}


def test_robust_estimates_are_those_of_numpy(spark):
    groups = random_groups()
    frame = spark.createDataFrame([(g, *map(float, v)) for g, x in groups.items() for v in x], "g string, x0 double, x1 double, x2 double, x3 double")
    found = {r["g"]: r for r in quality_rules.robust_estimates(frame).collect()}
    for g, x in groups.items():
        n, mean, cov, _ = brute_estimate(x)
        assert found[g]["n"] == n and np.allclose([found[g][f"m{i}"] for i in range(4)], mean)
        assert np.allclose([found[g][f"c{i}{j}"] for i, j in quality_rules.PAIRS], [cov[i, j] for i, j in quality_rules.PAIRS])
    clean = groups["en-a"][160:]
    assert np.allclose([found["en-a"][f"m{i}"] for i in range(4)], clean.mean(0), atol=0.05)


def test_three_starts_find_nearly_the_least_determinant():
    x, rng = random_groups()["en-a"], np.random.default_rng(5)
    floors, best = np.diag(np.square(quality_rules.FLOORS)), np.inf
    for _ in range(200):
        mean, cov = x[rng.choice(len(x), 6, replace=False)].mean(0), floors
        for _ in range(10):
            near = np.argsort(factor_and_distance(x, mean, cov))[: int(quality_rules.SHARE * len(x))]
            mean, cov = x[near].mean(0), np.cov(x[near].T, bias=True) + floors
        best = min(best, np.linalg.det(cov))
    inner = quality_rules.chi_square_quantile(quality_rules.SHARE, 2)
    consistent = quality_rules.SHARE / quality_rules.chi_square(inner, 3)
    assert brute_estimate(x)[3] < 1.1 * consistent**4 * best


def test_verdicts_are_those_of_numpy(spark):
    """Large and small groups, from texts to verdicts."""
    rng = np.random.default_rng(6)
    docs = []
    for lang, source, n in (("en", "a", 400), ("en", "b", 12), ("de", "a", 3), (None, None, 2)):
        for _ in range(n):
            words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(5, 120))]
            words += ["#" * 12] * int(rng.integers(0, 2) * rng.integers(0, 40) * (rng.random() < 0.1)) + ["x" * 90] * int(10 * (rng.random() < 0.03))
            docs.append((len(docs), " ".join(words), lang, source))
    rows = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    vectors, failed = [], []
    for _, text, _, _ in docs:
        n, chars, symbols, dup, repeat = brute_statistics(text)
        lines = sum(1 for x in text.split("\n") if WORDS.search(x))
        failed.append(n < 10 or 100 * repeat > 20 * n)
        w, c = n + quality_rules.PRIOR_WORDS, chars + quality_rules.PRIOR_WORDS * quality_rules.PRIOR_LENGTH
        vectors.append([np.log(c / w), np.sqrt(symbols / c), np.sqrt(dup / (lines + 5)), np.sqrt(repeat / w)])
    x, failed = np.array(vectors), np.array(failed)

    def drawn(keys, k, around):
        inside = np.array([key == k for key in keys]) & ~failed
        if not inside.any():
            return around
        n, mean, cov, _ = brute_estimate(x[inside])
        if around is None:
            return mean, cov
        return tuple((n * own + quality_rules.PSEUDO * other) / (n + quality_rules.PSEUDO) for own, other in zip((mean, cov), around))

    every = drawn([0] * len(docs), 0, None)
    cut = quality_rules.chi_square_quantile(quality_rules.CUT, 2)
    for k, (_, _, lang, source) in enumerate(docs):
        mean, cov = drawn([d[2:] for d in docs], (lang, source), drawn([d[2] for d in docs], lang, every))
        d2 = factor_and_distance(x[k : k + 1], mean, cov)[0]
        assert np.isclose(rows[k]["d2"], d2, rtol=1e-6) and rows[k]["kept"] == bool(not failed[k] and d2 <= cut)
    assert 0 < sum(not r["kept"] and not r["base_failed"] for r in rows.values()) < 100


CLASHES = "doc_id long, text string, lang string, kept string, p_good string, expected_grade string, lang_pred string, score string, rejected string, k1 string, _K1 string, k2 string"


@pytest.mark.parametrize("kind, values", [("binary", [b"ab", None, b"abcd"]), ("large_binary", [b"ab", None, b"abcd"]), ("string", ["ab", None, "abcd"]), ("list", [[1], None, [2]])])
def test_slices_by_size_of_all_columns_read(kind, values):
    typed = pa.array(values, pa.list_(pa.int32()) if kind == "list" else getattr(pa, kind)())
    slices = list(common.by_size(pa.RecordBatch.from_arrays([typed], names=["x"]), "x", 4))
    assert [v for part in slices for v in part.column("x").to_pylist()] == values and len(slices) == 2


def test_caches_of_other_operators_are_dropped():
    common.worker_cache("held", lambda: ["x"])
    common.drop_cache()
    made = []
    common.worker_cache("held", lambda: made.append(1))
    assert made == [1]


def test_fit_shuffles_no_more_with_more_partitions(spark, monkeypatch):
    texts = [(k % 2, f"good words {k % 7}" if k % 2 else f"bad lines {k % 5}") for k in range(400)]
    rows = common.staged(quality.rated_features(spark.createDataFrame(texts, "grade int, text string").repartition(40)), "ratings")
    tasks, summed = [], common.summed
    monkeypatch.setattr(quality, "summed", lambda parts, size: tasks.append(parts.rdd.getNumPartitions()) or summed(parts, size))
    quality.fit_over_all(rows, {0: 200, 1: 200})
    assert len(tasks) > 2 and max(tasks) <= spark.sparkContext.defaultParallelism


def test_filter_stages_leave_clashing_columns_alone(spark):
    words = [f"w{k}" for k in range(40)]
    docs = [(k, " ".join(np.random.default_rng(k).choice(words, 60)), "en", *"abcdefghi") for k in range(40)]
    frame = spark.createDataFrame([*docs, docs[3], (None, "no id", None, *"abcdefghi"), (50, None, "en", *"abcdefghi")], CLASHES)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, docs[5][1])], "item_id long, text string")
    before = collections.Counter(map(tuple, frame.collect()))
    for after in (quality.keep_good(frame, labels), language.keep_identified(frame), simhash.keep_one_of_each(frame), decontaminate.keep_clean(frame, benchmark)):
        assert after.schema.simpleString() == frame.schema.simpleString()
        got = collections.Counter(map(tuple, after.collect()))
        assert got and all(n <= before[r] for r, n in got.items())
    assert docs[5] not in got and before[docs[3]] == got[docs[3]] == 2


def test_one_of_each_keeps_different_texts_of_one_id(spark):
    texts = ["a b c d e f g h", "one two three four five six", "entirely other words in here now"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[0]), (None, texts[2]), (1, texts[0]), (None, "only this one has no id")]
    kept = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, "only this one has no id")], key=str)


def test_short_labelled_texts_are_learned(spark):
    rows = [(k, text, lang) for k, (text, lang) in enumerate([("der die das und nicht", "de"), ("the and of it", "en"), ("der Hund und die Katze", "de"), ("the dog and the cat", "en")] * 4)]
    frame = spark.createDataFrame([*rows, (90, "!!", "xx")], "doc_id long, text string, lang string")
    samples = language.language_samples(frame)
    assert set(samples) == {"de", "en"}
    found = {r["text"]: r for r in language.predict_languages(frame, samples).collect()}
    assert found["der Hund und die Katze"]["lang_pred"] == "de" and found["the dog and the cat"]["lang_pred"] == "en" and found["!!"]["lang_pred"] == "und"


def test_all_labelled_texts_are_learned(spark, monkeypatch):
    """The dictionary's words are those of the greatest sums over all rows, in whichever row they stand."""
    rng = np.random.default_rng(3)
    texts = [(k, " ".join(rng.choice([f"{a}{b}{'xyz'[k % 3]}" for a in "abcdefgh" for b in "ijklmnopq"], 40)), ["aa", "bb", None][k % 3]) for k in range(400)]
    texts += [(1000 + k, "seldomword " * 30 + "\u6f22" * 60, "aa") for k in range(2)] + [texts[0], (None, "nobody " * 999, "aa"), (2000, "one two", "cc")]
    monkeypatch.setattr(language, "DICTIONARY_BYTES", 200)
    samples = language.language_samples(spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(5))
    for lang in ("aa", "bb"):
        sums = collections.Counter()
        for doc_id, text, of in texts:
            if of == lang and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
                for word in text.split(" "):
                    word, n = word.strip("\u6f22"), len(word) - len(word.strip("\u6f22"))
                    sums[word] += 1
                    sums["\u6f22" * language.PIECE] += max(0, n // 4 - 1)
        best = sorted((w for w in sums if w), key=lambda w: (-sums[w] * (len(w.encode()) + 1), w.encode()))
        want = f" {' '.join(reversed(best))} ".encode()[-200:]
        assert samples[lang] == want
    assert samples["cc"] == b" one two " and set(samples) == {"aa", "bb", "cc"}


def test_predictions_are_those_of_plain_compression(spark):
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    samples = language.language_samples(docs)
    held = [r for r in docs.collect() if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    assert all(language.letters(r["text"]) in samples[r["lang"]] or len(samples[r["lang"]]) == language.DICTIONARY_BYTES for r in held if any(map(str.isalpha, r["text"] or "")))
    for r in language.predict_languages(docs, samples).collect():
        if r["text"] is None or not any(map(str.isalpha, r["text"])):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        data, sizes = language.letters(r["text"]), []
        for lang, content in samples.items():
            packer = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False)
            sizes.append((sum(len(packer.compress(data[k : k + language.BLOCK])) for k in range(0, len(data), language.BLOCK)), lang))
        sizes.sort()
        assert r["lang_pred"] == sizes[0][1] or r["score"] < language.MARGIN or sizes[1][0] - sizes[0][0] <= 2


def test_fit_is_that_of_a_plain_optimiser(monkeypatch):
    """The penalised likelihood of few features, written out and minimised by bisection of steps."""
    monkeypatch.setattr(quality, "LEAST_DOCUMENTS", 1)
    rng = np.random.default_rng(4)
    n, m = 400, 3
    dense = rng.random((n, m)) * (rng.random((n, m)) < 0.7)
    grades = np.clip((dense @ np.array([4.0, -3.0, 0.5]) + rng.logistic(size=n)).round(), 0, 2).astype(np.int64)
    row, place = np.nonzero(dense)
    counts = {0: 900, 1: 300, 2: 500}
    model = quality.fit_ordinal(place.astype(np.int32), dense[row, place], np.append(0, np.cumsum(np.bincount(row, minlength=n))), grades, counts)
    stands = np.array([counts[g] / max((grades == g).sum(), 1) for g in range(3)])[grades]
    stands *= n / stands.sum()

    def loss(state):
        cuts = np.array([-np.inf, state[m], state[m] + np.exp(state[m + 1]), np.inf])
        score = dense @ state[:m]
        upto = lambda k: 1 / (1 + np.exp(-(cuts[k] - score)))
        return -(stands * np.log(upto(grades + 1) - upto(grades))).mean() + quality.PENALTY / 2 * (state[:m] ** 2).sum()

    state, step = np.zeros(m + 2), 1.0
    for _ in range(3000):
        slope = np.array([(loss(state + h) - loss(state - h)) / 2e-5 for h in np.eye(m + 2) * 1e-5])
        while step > 1e-9 and loss(state - step * slope) > loss(state):
            step /= 2
        state, step = state - step * slope, step * 1.3
    assert np.allclose(model.weights[:m], state[:m], atol=0.05)
    assert np.allclose(model.thresholds, [state[m], state[m] + np.exp(state[m + 1])], atol=0.05)


def test_fit_takes_all_labelled_documents(spark, monkeypatch):
    """Of more features than the driver takes, all rows make the same model by passes over them."""
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join(rng.choice(words[10 * (k % 3) : 40 + 10 * (k % 3)], 30))) for k in range(600)]
    labels = spark.createDataFrame([(k, int(k % 3 != 1), int(k % 3 == 0)) for k, _ in docs], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([*docs, (4, "zz least text is the other"), docs[7]], "doc_id long, text string").repartition(4)
    texts = collections.Counter((r["grade"], r["text"]) for r in quality.rated(frame, labels).collect())
    assert texts == collections.Counter(([0, 1, 2][k % 3], text) for k, text in docs)
    models = [quality.fit(frame, labels)]
    monkeypatch.setattr(quality, "FEATURES", 500)
    models.append(quality.fit(frame, labels))
    few, many = ([r["p_good"] for r in quality.classify(frame, model).orderBy("doc_id", "text").collect()] for model in models)
    assert np.abs(np.subtract(few, many)).max() < 0.05 and np.std(few) > 0.2


def test_sample_is_bounded_in_features(spark, monkeypatch):
    rows = spark.createDataFrame([(g, k / 100, 10) for g in (0, 1) for k in range(50)] + [(2, 0.5, 999)], "grade int, share double, n long")
    monkeypatch.setattr(quality, "FEATURES", 205)
    kept = collections.Counter(r["grade"] for r in quality.bounded_sample(rows).collect())
    assert kept == {0: 20, 1: 20, 2: 1}


def test_token_file_masks_and_random_access(spark):
    from pyarrow import fs

    folder = common.new_path(spark, "files").removeprefix("file://")
    ids = [np.arange(5, dtype="uint16"), np.arange(7, dtype="uint16") + 100, np.zeros(0, "uint16")]
    for _ in range(2):  # a task that runs twice leaves one whole file
        writer = token_files.ShardWriter(folder, 3, 4, "uint16")
        for k, x in enumerate(ids):
            writer.add(k, x)
        assert writer.close() == (3, 12)
    names = sorted(f.base_name for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(folder)))
    assert names == ["000003.arrow", "000003.docs.arrow"]
    writer = token_files.ShardWriter(folder, 4, 4, "uint16")
    writer.add(9, np.arange(6, dtype="uint16"))
    writer.close()
    reader, docs = token_files.open_shard(folder, 4)
    batch = reader.get_batch(0)
    assert batch.column("ids").to_pylist() == [[0, 1, 2, 3], [4, 5, 0, 0]] and batch.column("mask").to_pylist() == [[True] * 4, [True, True, False, False]]
    reader, docs = token_files.open_shard(folder, 3)
    assert reader.get_batch(0).column("ids")[2].as_py() == [103, 104, 105, 106] and docs.column("start").to_pylist() == [0, 5, 12]


def leaks_of_all_pairs(rows, benchmark):
    """(doc_id, item_id) by the operator's decision, over all pairs of documents and items."""
    items = [b for block in decontaminate.item_blocks(benchmark) for b in block]
    want = set()
    for r in rows:
        terms = decontaminate.term_ids(r["text"])
        held = collections.Counter(terms.tolist())
        for item_id, item, answer in items:
            if sum((held & collections.Counter(item.tolist())).values()) < decontaminate.PARAPHRASE * len(item):
                continue
            for at in range(0, max(1, len(terms)), decontaminate.STEP):
                region = terms[max(0, at - len(item)) : at + decontaminate.PASSAGE + len(item)]
                covered = decontaminate.common_length(item, region) / len(item)
                answered = decontaminate.common_length(answer, region) / len(answer) if len(answer) else 1.0
                if covered >= decontaminate.SURE or covered >= decontaminate.PARAPHRASE and answered >= decontaminate.ANSWERED:
                    want.add((r["doc_id"], item_id))
                    break
    return want


def test_leaks_against_all_pairs(spark):
    """Recall over all pairs of documents and items on real text, by the same decision."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = leaks_of_all_pairs(docs.collect(), benchmark)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found <= want and len(found) >= 0.9 * len(want) and len(want) > 10


@pytest.mark.parametrize("changed", [0.25, 0.4])
def test_leaks_of_paraphrases(spark, changed):
    """Recall over paraphrases, by the same decision over all pairs: a share of an item's words is
    left out or gives way to words of documents, some are swapped, its last sentence stays."""
    rng = np.random.default_rng(int(100 * changed))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [r["text"] for r in benchmark.orderBy("item_id").collect() if r["text"]]
    others = [w for r in docs for w in (r["text"] or "").split()]
    rows = []
    for k, r in enumerate(docs):
        words = (r["text"] or "").split()
        if k % 3 == 0 and len(words) < 3000:
            sentences = re.split(r"(?<=[.!?])\s+", items[k // 3 % len(items)])
            said, answer = " ".join(sentences[:-1]).split() or sentences[-1].split(), sentences[-1].split()
            said = [w if x > changed else others[rng.integers(len(others))] for w, x in zip(said, rng.random(len(said)), strict=True) if not changed / 2 < x <= changed]
            for at in np.flatnonzero(rng.random(max(0, len(said) - 1)) < 0.05):
                said[at], said[at + 1] = said[at + 1], said[at]
            place = int(rng.integers(0, len(words) + 1))
            words[place:place] = said + answer
        rows.append((r["doc_id"], " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = leaks_of_all_pairs(frame.collect(), benchmark)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(frame, benchmark).collect()}
    assert found <= want and len(found) >= 0.9 * len(want) and len(want) > 100


def test_language(spark, edges, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).toPandas()
    held = rows[[zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"]]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert rows["rejected"].mean() < 0.05
    found = {r["doc_id"]: r for r in language.predict_languages(edges, {"en": b"the and one two words", "de": b"der die das"}).collect()}
    assert found[1]["lang_pred"] == found[12]["lang_pred"] == "und" and found[12]["rejected"]
    assert language.identify(none).count() == 0
    assert set(language.identify(edges.where("lang is null")).toPandas()["lang_pred"]) == {"und"}


def test_language_of_long_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    compressors = language.Compressors(language.language_samples(docs))
    for lang in ("en", "de", "fr"):
        texts = [r["text"] for r in docs.where(f"lang = '{lang}'").where(language.held_out(docs["doc_id"])).select("text").orderBy("doc_id").collect()]
        joined = " ".join(texts)
        while len(joined) < 6_000_000:
            joined += " " + joined
        short = compressors.predict(joined[:6000])
        for size in (200_000, 6_000_000):
            found, score = compressors.predict(joined[:size])
            assert found == lang and score > 0.5 * short[1] > language.MARGIN


def test_token_counts(edges, none):
    import sentencepiece
    import public_tokenizers

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = collections.Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in EDGES)
    for rows in (token_counts.count_tokens(edges),):
        assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows.collect()) == want
    assert token_counts.count_tokens(none).count() == 0


def test_token_counts_without_a_head(edges, monkeypatch):
    monkeypatch.setattr(token_counts, "frequent", lambda words: words.where("false"))
    test_token_counts(edges, edges.where("false"))


def test_strings_are_those_of_the_array():
    values = pa.array(["", "a", "\u00e9", "\u6f22", "\x00b"])
    assert word_ids.strings(values) == values.to_pylist() and word_ids.strings(values.slice(1, 2)) == ["a", "\u00e9"]
    assert word_ids.strings(values.slice(5)) == [] and word_ids.strings(pa.array(["x", "x"]).dictionary_encode().dictionary) == ["x"]


def test_token_files(spark, edges, none):
    folder = common.new_path(spark, "files")
    rows = token_files.read_token_files(token_files.write_token_files(edges, folder), folder).collect()
    order = sorted(EDGES, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    at = 0
    for r, want in zip(sorted(rows, key=lambda r: r["start"]), order, strict=True):
        ids = [*reference_ids(want[1]), 1]
        assert (r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) == (want[0], at, len(ids), np.array(ids, "<u4").tobytes())
        at += len(ids)
    empty = common.new_path(spark, "files")
    assert token_files.read_token_files(token_files.write_token_files(none, empty), empty).count() == 0


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\| a", "a<|im_end|>b", "", "<<||", "\\", "\n"])
def test_escapes(text):
    assert chat_tree.unescape(chat_tree.escape(text)) == text and "<|" not in chat_tree.escape(text)
    assert chat_tree.unescape_role(chat_tree.escape_role(text)) == text


def check_tree(rows):
    """The tree of rows (conv_id, turn, role, text) in a frame, against its nodes taken one by one."""
    tree = chat_tree.build_tree(rows)
    nodes = sorted(tree.nodes.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in nodes] == [0, *[r["finish"] for r in nodes[:-1]]]
    by_key, lists = {bytes(r["key"]): r for r in nodes}, collections.defaultdict(list)
    for r in sorted(tree.paths.collect(), key=lambda r: r["depth"]):
        lists[r["conv_id"]].append(bytes(r["key"]))
    paths = {tuple(keys[: i + 1]) for keys in lists.values() for i in range(len(keys))}
    assert len(paths) == len(nodes) == len(by_key) and {p[-1] for p in paths} == set(by_key)
    for path in paths:
        node, above = by_key[path[-1]], [by_key[k] for k in path]
        assert {t for s in node["spans"] for t in range(s["start"], s["finish"])} == {t for n in above for t in range(n["start"], n["finish"])}
        assert node["position"] == sum(n["finish"] - n["start"] for n in above[:-1]) and node["depth"] == len(path) - 1
        below = [by_key[p[-1]] for p in paths if p[: len(path)] == path]
        assert node["subtree_finish"] == max(n["finish"] for n in below) and node["start"] == min(n["start"] for n in below)
        assert node["subtree_finish"] - node["start"] == sum(n["finish"] - n["start"] for n in below)
    return tree, nodes


def test_chat_tree(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo <|im_end|>"), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, "user", "hi"), (4, None, None, None), (4, 0, "user", "hi"), (None, 0, "assistant", "x"), (1, 1, "assistant", "yo <|im_end|>")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, owner string")
    tree, nodes = check_tree(frame)
    assert len(nodes) == 7
    read = {r["conv_id"]: r for r in chat_tree.read_conversations(tree).collect()}
    assert {k: r["n_turns"] for k, r in read.items()} == {1: 3, 2: 2, 3: 1, 4: 2, None: 1}
    assert read[1]["loss_chars"] == 26 and read[3]["loss_chars"] == 0
    assert chat_tree.read_conversations(chat_tree.build_tree(frame.where("false"))).count() == 0


def test_chat_tree_of_many_shapes(spark):
    """A chain of longer and longer conversations, a comb, one long one, copies and a random bush."""
    rng = np.random.default_rng(5)
    talks = [[f"c{i}" for i in range(n)] for n in range(1, 12)]
    talks += [[f"s{i}" for i in range(n)] + [f"tooth {n}"] for n in range(8)]
    talks += [[f"long {i}" for i in range(300)], ["same"], ["same"], ["same", "same", "same"]]
    talks += [["hot", *(f"t{x}" for x in rng.integers(0, 2, rng.integers(0, 6)))] for _ in range(60)]
    rows = [(c, t, "assistant" if t % 2 else "user", text) for c, talk in enumerate(talks) for t, text in enumerate(talk)]
    rng.shuffle(rows)
    tree, _ = check_tree(spark.createDataFrame([(int(c), int(t), r, x) for c, t, r, x in rows], "conv_id long, turn long, role string, text string"))
    want = {}
    for c, talk in enumerate(talks):
        said = "".join(f"{'assistant' if t % 2 else 'user'}\n{x}\n" for t, x in enumerate(talk))
        loss = "".join(talk[1::2])
        want[c] = (len(talk), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_tree.read_conversations(tree).collect()}
    assert got == want
    assert max(len(r["spans"]) for r in tree.nodes.select("spans").collect()) < 20


def test_quality(spark, edges, none):
    insults, rng = ["loser", "scum", "trash"], np.random.default_rng(1)
    words = [f"w{k}" for k in range(300)]
    docs, labels = [], []
    for i in range(900):
        text, kind = list(rng.choice(words, 60)), i % 3
        if kind == 0:
            text[::8] = list(rng.choice(insults, len(text[::8])))
        if kind == 1:
            text = [t + "%%%" for t in text]
        docs.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, int(kind != 1), int(kind == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    held = quality.classify(docs, model).where("doc_id % 2 = 0").toPandas()
    assert (held["kept"] == (held["doc_id"] % 3 == 2)).mean() > 0.95
    assert list(np.diff(model.thresholds) > 0) == [True]
    assert quality.classify(edges, model).count() == len(EDGES) and quality.classify(none, model).count() == 0
    assert quality.fit(docs, labels.where("false")) is None and quality.classify(edges, None).where("kept").count() == len(EDGES)


def brute_common(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_common_length():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 80)), rng.integers(0, 6, rng.integers(0, 120))
        assert decontaminate.common_length(a, b) == brute_common(a.tolist(), b.tolist())


@pytest.mark.parametrize("most", [decontaminate.MASKS, 0])
def test_common_lengths_of_many_at_once(monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MASKS", most)
    monkeypatch.setattr(decontaminate, "WORDS_AT_ONCE", 50)
    rng = np.random.default_rng(5)
    width = 12
    columns = np.minimum(np.arange(20), width - 1)
    terms = [rng.integers(0, width - 1, n) for n in (1, 2, 30, 63, 64, 65, 64, 0)]
    items = decontaminate.Items([], terms, [], *[None] * 4, *decontaminate.masks_of(terms, columns, width))
    text = rng.integers(0, 20, 500)
    k = rng.choice([0, 1, 2, 3, 4, 6, 7], 300)
    begin = rng.integers(0, 500, 300)
    end = np.minimum(begin + rng.integers(0, 150, 300), 500)
    got = decontaminate.common_lengths(k, columns[text], begin, end, width, items)
    assert got.tolist() == [decontaminate.common_length(terms[i], text[a:b]) for i, a, b in zip(k, begin, end, strict=True)]


def test_candidates_of_a_batch_are_measured_together(monkeypatch):
    words = [f"w{k}" for k in range(400)]
    terms = [decontaminate.term_ids(" ".join(words[10 * k : 10 * k + 30])) for k in range(4)]
    held = np.unique(np.concatenate(terms))
    columns = np.full(decontaminate.TERMS, len(held), np.int32)
    columns[held] = np.arange(len(held))
    latent = np.vstack([np.eye(len(held), dtype=np.float32), np.zeros(len(held), np.float32)])
    space = decontaminate.Space(np.ones(decontaminate.TERMS, np.float32), columns, latent)
    vectors = np.stack([latent[columns[t]].sum(0) for t in terms])
    lengths = np.linalg.norm(vectors, axis=1)
    vectors /= lengths[:, None] ** 2
    items = decontaminate.Items([0, 1, 2, 3], terms, [t[:0] for t in terms], np.arange(4), vectors, lengths.astype(np.float32), decontaminate.greatest_products(latent, vectors), *decontaminate.masks_of(terms, columns, len(latent)))
    calls, lengths_of = [], decontaminate.common_lengths
    monkeypatch.setattr(decontaminate, "common_lengths", lambda *a: calls.append(len(a[0])) or lengths_of(*a))
    monkeypatch.setattr(decontaminate, "TILE", 4)  # a passage at a time
    text = decontaminate.term_ids(" ".join(words[:60]))
    found = decontaminate.leaks_in(np.concatenate([text, text[::-1]]), np.array([0, len(text), 2 * len(text)]), space, items)
    assert len(calls) == 1 and calls[0] > 4
    assert {k for k, v in found.items() if v[1] == 1} == {(0, 0), (0, 1), (0, 2), (0, 3)} and {r for r, _ in found} == {0}


def test_decontamination(spark, edges, none):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(3000)]
    items = [list(rng.choice(words, 30)) for _ in range(20)]
    texts, want = [], set()
    for i in range(200):
        text = list(rng.choice(words, 300))
        if i % 4 == 0:
            item = list(items[i // 4 % 20])
            if i % 8 == 0:  # a paraphrase: every sixth word is another one
                item[::6] = list(rng.choice(words, len(item[::6])))
            text[100:100] = item
            want.add((i, i // 4 % 20))
        texts.append((i, " ".join(text)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([*[(k, " ".join(t)) for k, t in enumerate(items)], (98, None), (99, " ")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found == want
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(200)} - {d for d, _ in want}
    assert decontaminate.find_leaks(edges, benchmark).count() == 0 and decontaminate.find_leaks(none, benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.where("false")).count() == 0


def test_decontamination_of_frequent_items(spark):
    """An item that a third of the documents hold, between words that few hold."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(6000)]
    items = [list(rng.choice(words, n, replace=False)) for n in (17, 24, 36)] + [list(rng.choice(words, 30)) for _ in range(20)]
    texts, want = [], set()
    for i in range(300):
        text, at = list(rng.choice(words, 200)), int(rng.integers(0, 201))
        if i % 3 == 0:
            for k in range(3):
                text[at:at] = items[k] + list(rng.choice(words, 40))
                want.add((i, k))
        texts.append((i, " ".join(text)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()} == want


def test_decontamination_of_long_items(spark):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(6000)]
    items = [list(rng.choice(words, n)) for n in (33, 400, 700, 1500)]
    texts, want = [], set()
    for i in range(60):
        text = list(rng.choice(words, 100 + 30 * i))
        if i % 3 == 0:
            text[50:50] = items[i // 3 % 4]
            want.add((i, i // 3 % 4))
        texts.append((i, " ".join(text)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()} == want


@pytest.mark.parametrize("gram", [4096, 0])
def test_latent_space_of_all_documents(spark, monkeypatch, gram):
    """The space is that of the Gram matrix of all documents' passages, not of some of them,
    whether tasks sum that matrix up or multiply each row."""
    monkeypatch.setattr(decontaminate, "GRAM", gram)
    rng = np.random.default_rng(10)
    words = np.array([f"w{k}" for k in range(60)])
    texts = [" ".join(words[np.minimum(rng.geometric(0.08, int(n)), 60) - 1]) for n in rng.integers(0, 90, 4000)]
    benchmark = " ".join(words[:40])
    docs = decontaminate.tokens(spark.createDataFrame([(t,) for t in texts], "text string"))
    space = decontaminate.fitted(docs, decontaminate.tokens(spark.createDataFrame([(benchmark,)], "text string")))
    size = int(space.columns.max())
    gram = np.zeros((size, size))
    for text, times in [*((t, decontaminate.WEIGH_AS / len(texts)) for t in texts), (benchmark, decontaminate.EMPHASIS)]:
        terms = decontaminate.term_ids(text)
        for k in range(0, len(terms), decontaminate.PASSAGE):
            part, row = terms[k : k + decontaminate.PASSAGE], np.zeros(size + 1)
            np.add.at(row, space.columns[part], space.weights[part] / np.linalg.norm(space.weights[part]))
            gram += times * np.outer(row[:size], row[:size])
    weights = np.zeros(size)
    inside = space.columns < size
    weights[space.columns[inside]] = space.weights[inside]
    right = space.latent[:size, :3] / weights[:, None]
    assert np.allclose(np.abs(np.sum(right * np.linalg.eigh(gram)[1][:, ::-1][:, :3], axis=0)), 1, atol=1e-4)


def test_url_filter(spark):
    urls = ["https://A.example.com/en/x", "http://www.example.com/en/y", "ftp://fr.net/fr/", "https://adult-x.org/a/index.html", "https://m.adult-x.org/a?q=1", "https://u@adult-x.org:80/a/#t", "https://adult-x.org/ab", None, "no-scheme", "x://net", ""]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("adult-x.org/a",), ("adult-x.org/a",), (None,), *[(f"other{k}.org/",) for k in range(500)]], "url string")
    rows = {r["page_id"]: r for r in url_filter.judge(pages, listed).collect()}
    assert [rows[k]["verdict"] for k in range(len(urls))] == ["block", "allow", "block", "block", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert rows[1]["rule"] == "www.example.com/en/" and rows[7]["host"] == "" and rows[9]["host"] == "net"
    assert url_filter.judge(pages, listed.where("false")).where("verdict = 'block'").count() == 2
    assert url_filter.judge(pages.where("false"), listed).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, "/root/testdata/sf0.001")
        assert after.columns == docs.columns and after.join(before, "doc_id", "left_anti").count() == 0
        before = common.staged(after, "stage")
    assert before.count() > 0.5 * docs.count()

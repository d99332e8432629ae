"""Substring dedup, hard negatives, collocations: against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epiframe.llm import collocations, hard_negatives, repeats, tallies
from epiframe.llm.queries import op11_substring_dedup
from epiframe.llm.words import chained


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_repeats(texts, window):
    """Per text its words, the places of those removed, and what is left."""
    docs = [cut(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        out.append((len(w), sorted(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def passages(seed, n, window):
    """Texts that share passages around the length of a window, whole and with a word changed, in many copies and twice in one text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    shared = [[word() for _ in range(rng.choice([window - 1, window, window + 1, 2 * window, 4 * window]))] for _ in range(8)]
    texts = []
    for _ in range(n):
        words = [word() for _ in range(rng.randint(0, 2 * window))]
        for _ in range(rng.randint(0, 3)):
            some = list(shared[min(7, int(rng.expovariate(0.5)))])
            if rng.random() < 0.4:
                some[rng.randrange(len(some))] = word()
            if rng.random() < 0.4:
                some = some[rng.randrange(len(some)) :]
            at = rng.randint(0, len(words))
            words[at:at] = some
        texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(words))
    return [*texts, texts[3], "la " * (3 * window), "la " * (window - 1), "x y " * window, "z"]


@pytest.mark.parametrize("window,batch_bytes,shard_words", [(35, 6_000_000, 2_000_000), (9, 2000, 400), (2, 6000, 1000)])
def test_repeated_words_go(make_docs, monkeypatch, window, batch_bytes, shard_words):
    monkeypatch.setattr(repeats, "AT_ONCE", 50)
    texts = passages(window, 40, window)
    found = {r["doc_id"]: r for r in repeats.cleaned(make_docs(list(enumerate(texts))), window, batch_bytes, shard_words).collect()}
    want = without_repeats(texts, window)
    for i, (n, gone, left) in enumerate(want):
        assert (found[i]["n_words"], found[i]["n_removed"], found[i]["text"]) == (n, len(gone), left)
        assert [s["start"] + k for s in found[i]["spans"] for k in range(s["length"])] == gone
    assert 0 < sum(len(g) for _, g, _ in want) < sum(n for n, _, _ in want) 


def test_repeats_of_odd_rows(spark, make_docs, odd_rows):
    rows = repeats.cleaned(make_docs(odd_rows)).collect()
    want = without_repeats([t for _, t in odd_rows], 35)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in rows) == Counter((i, n, len(g), left) for (i, _), (n, g, left) in zip(odd_rows, want))
    assert {r["n_removed"] for r in rows if r["doc_id"] in (10, 11)} == {20_000}
    # a row that repeats is there twice, and its words are too
    again = repeats.cleaned(make_docs([(1, "w " * 3 + " ".join(map(str, range(40))))] * 2)).collect()
    assert [(r["n_words"], r["n_removed"], r["text"]) for r in again] == [(43, 43, "")] * 2
    assert repeats.cleaned(make_docs([])).count() == 0


def test_the_digest_is_that_of_the_words_left(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: hashlib.sha256(left.encode()).hexdigest() for (i, _), (_, _, left) in zip(docs, without_repeats([t for _, t in docs], 35))}
    assert {r["doc_id"]: r["kept_sha256"] for r in op11_substring_dedup(spark, sf).collect()} == want


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=80), st.integers(1, 40))
def test_doubled_folds_in_order(values, length):
    x = np.array(values, np.uint64)
    least = tallies.doubled(x, length, np.minimum)
    assert least.tolist() == [min(values[i : i + length]) for i in range(len(values) - length + 1)]
    first, again = tallies.doubled(x, length, chained), tallies.doubled(x[1:], length, chained)
    assert first[1:].tolist() == again.tolist()


def test_totals_come_back_to_every_batch(spark):
    """Equal keys with another check are other keys; one batch of each key's is the first."""
    rng = np.random.default_rng(1)
    asked = {b: (rng.integers(0, 2**64, 40, np.uint64) & np.uint64(0xFF00000000000007)) for b in range(9)}
    checks = {b: (k % np.uint64(3)).astype(np.uint32) + np.uint32(b % 2) for b, k in asked.items()}
    tables = [tallies.requests(b, 5, asked[b], checks[b]) for b in asked]
    rows = spark.createDataFrame([r for t in tables for r in t.to_pylist()], tallies.REQUEST)
    back = tallies.answers(rows, 2).toArrow()
    want, firsts = Counter(), Counter()
    for b, keys in asked.items():
        want.update((int(k), int(k) % 3 + b % 2) for k in keys)
    for b, keys in asked.items():
        told = tallies.told(back.filter(np.equal(back["batch"].to_numpy(), b)), keys)
        for k in keys.tolist():
            n = want[k, k % 3 + b % 2]
            assert told.of(np.array([k], np.uint64)).tolist() == [n if n >= 2 else 0]
        firsts.update((int(k), int(k) % 3 + b % 2) for k, f in zip(told.keys, told.first) if f)
    assert firsts == {k: 1 for k, n in want.items() if n >= 2}


def negatives_by_hand(rows, step):
    """rows: (vec_id, label, vector)."""
    good = {}
    for i, label, v in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2])), key=lambda r: (r[0], r[1], r[2])):
        good.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, x) in good.items():
        if a % step:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in good.items() if i != a and len(x) == len(y))
        for s, positive, _ in [t for t in scores if t[2] == label][:5]:
            near = [(i, n) for n, i, other in scores if other != label and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out += [(a, positive, k, i, -s, -n) for k, (i, n) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,chunk", [(4_000_000, 4_000_000), (3000, 400)])
def test_negatives_are_exact(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block)
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(2)
    data = np.round(rng.normal(size=(400, 10)) * 2 + 0.7, 1)
    data[50:90] = data[7]  # ties
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(400 + i, 1, [float(x) for x in v[:3]]) for i, v in enumerate(data[:60])]
    rows += [(1000, None, rows[0][2]), (1020, 1, None), (1040, 1, [math.nan] * 10), (1060, 1, [None] * 10), (1080, 1, [math.inf] * 10), (1100, 1, []), (None, 1, rows[0][2]), (1120, 1, [1e300] * 10), (1140, 2, [0.0] * 10), rows[20], (20, 2, rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 AS q", "2 AS dim", "3 AS block", "4 AS chunk", "'x' AS row").repartition(4)
    found = hard_negatives.mined(df, F.col("vec_id") % 20 == 0)
    want = negatives_by_hand([r for r in rows if r[0] != 1120], 20)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) > 150


def test_negatives_of_little(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mined(empty, F.col("vec_id") % 1 == 0).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0]), (1, 2, [1.0]), (2, 2, [0.9])], "vec_id long, label int, embedding array<float>")
    assert [tuple(r) for r in hard_negatives.mined(alone, F.col("vec_id") % 1 == 0).collect()] == [(2, 1, 1, 0, 230 * 256, 230 * 256)]
    two = alone.unionByName(spark.createDataFrame([(3, 1, [2.0])], alone.schema))
    assert hard_negatives.mined(two, F.col("vec_id") == 0).count() == 0  # 512 * 256 is out of reach
    assert hard_negatives.mined(two, F.col("vec_id") == 1).count() == 0  # both others score more than the positive
    assert [tuple(r) for r in hard_negatives.mined(two, F.col("vec_id") == 2).collect()] == [(2, 1, 1, 0, 230 * 256, 230 * 256)]


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 12), st.integers(1, 60), st.integers(1, 7), st.randoms(use_true_random=False))
def test_a_scan_gives_up_no_row_too_early(dim, n, k, rng):
    x = np.array([[rng.randint(-9, 9) for _ in range(dim)] for _ in range(n)], np.int64)
    block = hard_negatives.Block({"ids": np.arange(n).tobytes(), "labels": ["a"], "label_of": np.zeros(n, np.int32).tobytes(), "columns": np.ascontiguousarray(x.T).tobytes(), "least": x.min(0).tobytes(), "most": x.max(0).tobytes()})
    anchor = np.array([rng.randint(-9, 9) for _ in range(dim)], np.int64)
    scores = x @ anchor
    rows, score = block.scan(anchor, np.arange(n), hard_negatives.best(k))
    assert (score == scores[rows]).all()
    assert rows[hard_negatives.first(rows, score, k)].tolist() == hard_negatives.first(np.arange(n), scores, k).tolist()
    low = rng.randint(-100, 100)
    rows, score = block.scan(anchor, np.arange(n), hard_negatives.in_windows([(low, low + 40), (low + 20, low + 60)], k))
    for a, b in ((low, low + 40), (low + 20, low + 60)):
        inside, every = np.flatnonzero((score >= a) & (score <= b)), np.flatnonzero((scores >= a) & (scores <= b))
        assert rows[inside[hard_negatives.first(rows[inside], score[inside], k)]].tolist() == every[hard_negatives.first(every, scores[every], k)].tolist()


def phrases_by_hand(rows, least, most, limit):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for m in range(1, most + 1):
                f[lang or "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        candidates = {p: n for p, n in c.items() if len(p) > 1 and n >= least}
        some, longer = [], Counter()
        for q, n in candidates.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    longer[q[i : i + m]] = max(longer[q[i : i + m]], n)
        for p, a in candidates.items():
            if longer[p] and 100 * longer[p] >= 50 * a:
                continue
            score, _, left, right = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            some.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(some)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrases(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "it's", "A", "\x00", "new", "york"]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 40)):
            text.append(rng.choice(["New York", "new york City", "x y x y", rng.choice(words), rng.choice(words)]))
            text.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]))
        rows.append((i, "".join(text), rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("least,most,batch_bytes,shard_words,limit", [(10, 3, 6_000_000, 2_000_000, 2000), (4, 3, 4000, 600, 15), (3, 5, 9000, 2000, 2000), (2, 2, 9000, 500, 2000)])
def test_phrases_are_exact(make_docs, monkeypatch, least, most, batch_bytes, shard_words, limit):
    rows = [*phrases(least, 80), (900, "Only ONCE", "fr"), (901, None, "fr"), (902, None, None)]
    docs = make_docs(rows)
    monkeypatch.setattr(collocations, "counts", lambda *a, f=collocations.counts: f(*a, batch_bytes=batch_bytes, shard_words=shard_words))
    found = collocations.mined(docs, least, most, limit)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = phrases_by_hand([r[1:] for r in rows], least, most, limit)
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) >= 30


def test_phrases_of_odd_rows(make_docs, odd_rows):
    rows = odd_rows * 6
    want = phrases_by_hand([(t, "en") for _, t in rows], 5, 3, 2000)
    assert sorted(tuple(r) for r in collocations.mined(make_docs(rows), 5).collect()) == want and want
    assert collocations.mined(make_docs([])).count() == 0
    assert collocations.mined(make_docs([(1, None), (2, " ..,")])).count() == 0


def test_scores_pass_64_bits(spark):
    big = 4 * 10**15
    rows = [("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 7), ("en", 0, None, 2 * big)]
    found = collocations.scored(spark.createDataFrame(rows, collocations.COUNTED)).collect()
    assert [(r["a"], r["l"], r["r"], r["score"]) for r in found] == [(big - 7, big, big - 1, 1000000 * (big - 7) ** 2 // (big * (big - 1)))]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 4))
def test_intervals_extend_both_ways(ids, depth):
    """Counts and extensions of all n-grams, by whichever end they grow."""
    index = collocations.Index(np.array(ids, np.int64), depth + 1)
    grams = [Counter(tuple(ids[i : i + m]) for i in range(len(ids) - m + 1) if 0 not in ids[i : i + m]) for m in range(depth + 2)]
    for turns in range(2 ** max(0, depth)):
        now = index.words()
        for m in range(1, depth + 1):
            assert {tuple(g): c for g, c in zip(now.grams.tolist(), now.count.tolist())} == grams[m]
            now = index.right(now) if turns >> (m - 1) & 1 else index.left(now)

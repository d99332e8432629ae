"""Language identification, toxicity, Kneser-Ney quality, stupid backoff."""

import functools
import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from epiframe.llm import kneser_ney, language, stupid_backoff, toxicity
from epiframe.llm.words import fold

SYLLABLES = {"xx": ["ka", "ro", "mi", "tul"], "yy": ["sche", "berg", "ung", "ei"], "zz": ["ción", "ado", "ñe", "lla"]}
COMMON = {"xx": ["the", "of", "and"], "yy": ["der", "und", "von"], "zz": ["que", "los", "una"]}


def prose(rng, lang, n):
    word = lambda: rng.choice(COMMON[lang]) if rng.random() < 0.4 else "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))
    return " ".join(word() for _ in range(n))


@pytest.fixture
def corpus():
    rng = random.Random(4)
    return [(i, prose(rng, lang, rng.randint(5, 60)), lang) for i, lang in enumerate(rng.choice(["xx", "yy", "zz"]) for _ in range(300))]


def test_fold_is_crc32_of_the_text(spark):
    import zlib

    rows = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert [r["f"] for r in rows] == [zlib.crc32(str(i).encode()) % 5 for i in range(50)]


def test_languages_of_held_out_texts(make_docs, corpus):
    docs = make_docs(corpus)
    model = language.fit(language.training_rows(docs))
    found = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert np.mean([found[i]["lang_pred"] == lang for i, _, lang in corpus]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_all_labelled_documents_are_learned_from(spark):
    """More of one language than any sample took: every word is known, with its count."""
    docs = spark.range(6000).selectExpr("'xx' AS lang", "concat('common ', translate(cast(id AS string), '0123456789', 'abcdefghij'), 'word common') AS text")
    model = language.fit(docs.unionByName(spark.createDataFrame([("yy", "other")], "lang string, text string")))
    rare = ["".join("abcdefghij"[int(d)] for d in str(i)) + "word" for i in range(6000)]
    assert set(model.tables[0]) == {"common", "other", *rare}
    row, column = model.tables[0]["common"], model.languages.index("xx")
    assert model.values[row, column] - model.values[row, 1 - column] == pytest.approx(math.log((12000 + 0.5) / (18000 + 0.5 * 6002)) - math.log(0.5 / (1 + 0.5 * 6002)))


def test_levels_of_words_agree_with_one_word_at_a_time(make_docs, corpus):
    model = language.fit(make_docs(corpus))
    words = ["the", "karomi", "unknownberg", "q", "ñ", "日本", "schexq"]
    assert np.allclose(model.words(words), [model.word(w) for w in words])
    # known words come first, then the longest known n-grams
    assert model.tables[0].get("the") is not None and model.tables[0].get("unknownberg") is None
    assert model.languages[int(model.word("xxxberg").argmax())] == "yy"


def test_languages_of_odd_rows(spark, make_docs, odd_rows, corpus):
    model = language.fit(make_docs(corpus))
    docs = make_docs(odd_rows)
    rows = language.predict(docs, model, ("doc_id", "text")).collect()
    assert len(rows) == len(odd_rows)
    assert language.accepted(docs, model, 0.0).columns == docs.columns
    assert language.accepted(docs, model, 0.0).count() == sum(r["lang_pred"] != "und" for r in rows)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0.0)
    nothing = language.fit(make_docs([(1, "text", None)]))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(make_docs([]), model).count() == 0


def test_toxic_texts_are_found(spark, make_docs):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(900):
        text = prose(rng, "xx", rng.randint(5, 80)).split(" ")
        toxic = i % 5 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["scumbag", "trashy", "idiotic"]))
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    docs = make_docs(rows)
    machine = toxicity.fit(docs, toxicity.training_labels(labels))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine).collect()}
    held = {r["doc_id"] for r in labels.filter(fold("doc_id", 3) == 1).collect()}
    assert np.mean([scores[i] >= 0.7 for i, t in marks if t and i in held]) > 0.95
    assert not any(scores[i] >= 0.7 for i, t in marks if not t and i in held)


def test_pairs_say_more_than_their_sum():
    """A term is toxic with one other alone: no sum of weights can tell."""
    rng = random.Random(2)
    rows = []
    for _ in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        noise = [f"n{rng.randrange(300)}" for _ in range(10)]
        rows.append(([*noise, "insulting" if a else "praising", "groupname" if b else "weather"], int(a == b)))
    machine = toxicity.train(*toxicity.presence(pa.array([" ".join(t) for t, _ in rows])), np.array([y for _, y in rows], float))
    texts = pa.array(["insulting groupname", "insulting weather", "praising groupname", "praising weather"])
    score = machine.score(*toxicity.presence(texts), 4)
    assert score[0] > 0.7 and score[1] < 0.3 and score[2] < 0.3 and score[3] > 0.7


def test_a_score_is_the_sum_over_terms_and_pairs():
    rng = np.random.default_rng(1)
    machine = toxicity.Machine(np.arange(50), rng.normal(size=50), rng.normal(size=(50, toxicity.FACTORS)).astype(np.float32), 0.3)
    for n in (0, 1, 5, 45):
        terms = np.sort(rng.choice(60, n, replace=False))
        known = [t for t in terms if t < 50]
        pairs = sum(float(machine.vectors[a].astype(float) @ machine.vectors[b].astype(float)) for k, a in enumerate(known) for b in known[:k])
        x = 0.3 + sum(machine.weights[known]) + pairs * min(1, toxicity.PAIR_TERMS / max(1, n))
        assert machine.score(np.zeros(n, np.int64), terms, 1)[0] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, x)))))


def test_sampling_rates_do_not_move_scores():
    """Half of the clean rows left out, and said so: texts of no known terms score alike."""
    rows = [("one two", 0)] * 400 + [("three two", 1)] * 50
    some = [*rows[:200], *rows[400:]]
    score = [toxicity.train(*toxicity.presence(pa.array([t for t, _ in r])), np.array([y for _, y in r], float), shares).score(np.zeros(0, np.int64), np.zeros(0, np.int64), 1)[0] for r, shares in ((rows, (1.0, 1.0)), (some, (0.5, 1.0)))]
    assert score[0] == pytest.approx(score[1], abs=0.05)


def test_toxicity_of_odd_rows(spark, make_docs, odd_rows):
    docs, labels = make_docs(odd_rows), spark.createDataFrame([(3, 1), (4, 0), (99, 1), (5, None)], "doc_id long, toxic int")
    for some in (labels, labels.filter("toxic = 1"), labels.filter("toxic = 7")):
        rows = toxicity.score(docs, toxicity.fit(docs, some)).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(make_docs([]), toxicity.fit(make_docs([]), labels)).count() == 0


def kneser_ney_by_hand(texts):
    """log p(w | u v) of an interpolated modified Kneser-Ney model, by dictionaries."""
    grams = [("<s>", "<s>", *t.split()) for t in texts]
    c3 = Counter(g[i : i + 3] for g in grams for i in range(len(g) - 2))
    c2 = Counter(g[1:] for g in c3)
    c1 = Counter(g[1:] for g in c2)

    def discounts(c):
        n = [0] + [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        return lambda v: [min(k, max(0.0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.0 for k in (1, 2, 3)][min(v, 3) - 1]

    d3, d2, d1 = map(discounts, (c3, c2, c1))

    def context(c, d, size):
        total, free = Counter(), defaultdict(float)
        for g, v in c.items():
            total[g[:size]] += v
            free[g[:size]] += d(v)
        return total, {k: free[k] / total[k] for k in total}

    t3, b3 = context(c3, d3, 2)
    t2, b2 = context(c2, d2, 1)
    total, (free,) = sum(c1.values()), context(c1, d1, 0)[1].values()
    p1 = {g: (v - d1(v)) / total + free / (len(c1) + 1) for g, v in c1.items()}
    p2 = {g: (v - d2(v)) / t2[g[:1]] + b2[g[:1]] * p1[g[1:]] for g, v in c2.items()}
    p3 = {g: (v - d3(v)) / t3[g[:2]] + b3[g[:2]] * p2[g[1:]] for g, v in c3.items()}
    pruned = [g for g in c1 if c1[g] == 1]
    unknown = (1 - sum(p1[g] for g in c1 if c1[g] > 1)) / (len(pruned) + 1)
    followed2, followed3 = defaultdict(list), defaultdict(list)
    for g in c2:
        followed2[g[0]] += [g[1]] * (c2[g] > 1)
    for g in c3:
        followed3[g[:2]] += [g[2]] * (c3[g] > 1)

    def q1(w):
        return p1[w,] if c1[w,] > 1 else unknown

    @functools.cache
    def b2_left(v):
        return (1 - sum(p2[v, w] for w in followed2[v])) / (1 - sum(map(q1, followed2[v])))

    def q2(v, w):
        return p2[v, w] if c2[v, w] > 1 else b2_left(v) * q1(w)

    @functools.cache
    def b3_left(u, v):
        return (1 - sum(p3[u, v, w] for w in followed3[u, v])) / (1 - sum(q2(v, w) for w in followed3[u, v]))

    def q3(u, v, w):
        return p3[u, v, w] if c3[u, v, w] > 1 else b3_left(u, v) * q2(v, w)

    # the whole model, nothing left out, is a distribution itself
    full = lambda u, v, w: max(c3[u, v, w] - d3(c3[u, v, w]), 0) / t3[u, v] + b3[u, v] * (p2[v, w] if (v, w) in p2 else b2[v,] * (p1[w,] if (w,) in p1 else free / (len(c1) + 1)))
    u, v = next(iter(t3))
    assert sum(full(u, v, w) for w, in [*c1, ("<unseen>",)]) == pytest.approx(1, abs=1e-9)

    def score(text):
        g = ("<s>", "<s>", *text.split())
        return sum(math.log(q3(*g[i - 2 : i + 1])) for i in range(2, len(g)))

    return score


@pytest.mark.parametrize("local_rows", [10**6, 0])
def test_model_is_that_of_the_book(make_docs, corpus, local_rows):
    docs = make_docs(corpus)
    model = kneser_ney.train(docs)
    want = kneser_ney_by_hand([t for _, t, _ in corpus])
    rows = [*corpus[:60], (1000, "entirely new words here"), (1001, None), (1002, " "), (1003, "the the the of")]
    found = {r["doc_id"]: r for r in kneser_ney.log_probabilities(make_docs(rows), model, local_rows).collect()}
    for i, text, *_ in rows:
        assert found[i][kneser_ney.WORDS] == len((text or "").split())
        assert found[i][kneser_ney.LOGP] == pytest.approx(want(text or ""), rel=1e-9, abs=1e-9)


def test_probabilities_after_a_context_sum_to_one(make_docs, corpus):
    """Of all words of the training text and an unseen one, after contexts that are frequent, rare and new."""
    model = kneser_ney.train(make_docs(corpus))
    grams = Counter(tuple(("<s> " + t).split()[i : i + 2]) for _, t, _ in corpus for i in range(len(t.split()) - 1))
    words = sorted({w for _, t, _ in corpus for w in t.split()})
    frequent = [g for g, _ in grams.most_common(4)]
    once = [g for g, n in grams.items() if n == 1][:3]
    contexts = [("",), *(c for c in (*frequent, *once) if "<s>" not in c), (words[0],), (words[3], "neverseen"), ("neverseen", words[5])]
    texts = [" ".join([*c, w]).strip() for c in contexts for w in ["", *words, "<unseen>"]]
    found = {r["doc_id"]: r[kneser_ney.LOGP] for r in kneser_ney.log_probabilities(make_docs(list(enumerate(texts))), model).collect()}
    step = len(words) + 2
    for k in range(len(contexts)):
        before, *after = (found[k * step + i] for i in range(step))
        assert sum(math.exp(x - before) for x in after) == pytest.approx(1, abs=1e-9), contexts[k]


def test_fewer_trusted_documents_judge_more_mildly(spark, make_docs):
    """No number of documents is a switch: the threshold falls smoothly as they get more."""
    rng = random.Random(9)
    texts = [prose(rng, "xx", 40) for _ in range(40)]
    limits = []
    for n in (20, 160, 170, 400):
        rows = [(i, texts[i % 40], "xx") for i in range(n)]
        labels = spark.createDataFrame([(i, 1) for i in range(n)], "doc_id long, quality int")
        limits.append(math.log(kneser_ney.scored(make_docs(rows), labels).first()["threshold"]))
    assert limits[0] > limits[1] > limits[3] and abs(limits[1] - limits[2]) < 0.3


def test_quality_keeps_clean_and_drops_junk(spark, make_docs, odd_rows):
    rng = random.Random(6)
    rows = [(i, prose(rng, lang, rng.randint(8, 60)), lang) for i, lang in enumerate(rng.choice(["xx", "yy"]) for _ in range(600))]
    junk = [(1000 + i, " ".join(f"{rng.randrange(10**6)}##" for _ in range(40)), "xx") for i in range(30)]
    labels = spark.createDataFrame([(i, 1) for i in range(400)] + [(1000, 0)], "doc_id long, quality int")
    docs = make_docs([*rows, *junk, *((2000 + k, t) for k, (_, t) in enumerate(odd_rows))])
    out = kneser_ney.scored(docs, labels)
    keep = {r["doc_id"]: r["keep"] for r in out.collect()}
    assert np.mean([keep[i] for i, *_ in rows]) > 0.98 and not any(keep[i] for i, *_ in junk)
    assert not keep[2000] and not keep[2001] and not keep[2002]
    assert kneser_ney.filtered(docs, labels).columns == docs.columns
    assert {r["keep"] for r in kneser_ney.scored(docs, labels.filter("quality = 9")).filter("doc_id < 2000").collect()} == {True}
    assert kneser_ney.filtered(make_docs([]), labels).count() == 0


def test_what_a_task_counts_at_once_is_small():
    """two tasks count n-grams side by side on an executor of 3 GB."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(50_000)]
    texts, size = [], 0
    while size < kneser_ney.COUNT_BYTES:
        texts.append(" ".join(rng.choices(words, k=400)))
        size += len(texts[-1])
    tracemalloc.start()
    try:
        sent = kneser_ney._sent(texts, 3)
        table = pa.Table.from_batches([sent.filter(pc.equal(sent["shard"], 1))] * (3 * kneser_ney.COUNT_SHARD // kneser_ney.COUNT_BYTES))
        kneser_ney._summed(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200e6


@pytest.mark.parametrize("local_rows", [10**6, 40, 0])
def test_rare_ngrams_are_asked_for_and_others_are_not(spark, make_docs, corpus, local_rows):
    """texts stay where they are, and n-grams of no table are no part of a shuffle; repeated texts get one answer."""
    model = kneser_ney.train(make_docs(corpus))
    docs = make_docs([*corpus[:50], *corpus[:50], (1000, None), (1001, "entirely new words")])
    least, head, bitmap = kneser_ney._head(model, local_rows)
    assert len(head.keys) <= local_rows and (least == 0) == (local_rows == 10**6)
    new = np.random.default_rng(1).integers(0, 1 << 64, 10_000, dtype=np.uint64)
    assert len(kneser_ney._met(bitmap, new)) < 2_000 and len(kneser_ney._met(bitmap, head.keys)) == len(head.keys)
    want = kneser_ney_by_hand([t for _, t, _ in corpus])
    found = {r[kneser_ney.ROW]: r for r in kneser_ney.text_sums(docs, model, local_rows).collect()}
    rows = docs.select(kneser_ney._row().alias("row"), "text").collect()
    assert len(found) == len({r["text"] or "" for r in rows})
    for r in rows:
        assert found[r["row"]][kneser_ney.LOGP] == pytest.approx(want(r["text"] or ""), rel=1e-9, abs=1e-9)


def test_thresholds_are_set_by_all_held_out_documents(spark, make_docs, monkeypatch):
    monkeypatch.setattr(kneser_ney, "FIT_DOCUMENTS", 20)
    docs = make_docs([(i, f"text {i}", "xx") for i in range(500)])
    fit_on, set_by = kneser_ney.trusted(docs, spark.createDataFrame([(i, 1) for i in range(500)], "doc_id long, quality int"))
    held = docs.filter(fold("doc_id", 10) >= 7)
    assert fit_on.count() == 20 and {r["text"] for r in set_by.collect()} == {r["text"] for r in held.collect()}


def test_all_trusted_documents_train_the_model(spark):
    """More of one language than any sample took, and none left out."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "'xx' AS lang", "concat('text ', id) AS text")
    fit_on, set_by = kneser_ney.trusted(docs, docs.selectExpr("doc_id", "1 AS quality"))
    held = docs.filter(fold("doc_id", 10) >= 7).count()
    assert fit_on.select("doc_id").distinct().count() == fit_on.count() == 6000 - held and set_by.count() == held


def test_a_language_with_little_trusted_text_is_kept(spark, make_docs):
    rng = random.Random(6)
    rows = [(i, prose(rng, "xx", rng.randint(8, 60)), "xx") for i in range(300)]
    small = [(1000 + i, prose(rng, "zz", 40), "zz") for i in range(60)]
    labels = spark.createDataFrame([(i, 1) for i in range(300)] + [(1000 + i, 1) for i in range(10)], "doc_id long, quality int")
    keep = {r["doc_id"]: r["keep"] for r in kneser_ney.scored(make_docs([*rows, *small, (2000, " ", "zz")]), labels).collect()}
    assert all(keep[i] for i, *_ in small) and not keep[2000]


@pytest.mark.parametrize("order,size", [(1, 400), (2, 6_000_000), (3, 300)])
def test_backoff_scores(make_docs, corpus, odd_rows, order, size):
    rows = [(i, t) for i, t, _ in corpus[:80]] + [(500 + k, t) for k, (_, t) in enumerate(odd_rows) if len(t or "") < 500]
    tokens = {i: (t or "").lower().split() if t != odd_rows[7][1] else t.encode().lower().decode().replace("　", "_").split(" ") for i, t in rows}
    tokens = {i: (t or "").encode().lower().split() for i, t in rows}
    count = [Counter(tuple(w[i - k + 1 : i + 1]) for w in tokens.values() for i in range(k - 1, len(w))) for k in range(order + 1)]
    words = sum(map(len, tokens.values()))
    found = {r["doc_id"]: r for r in stupid_backoff.scored(make_docs(rows), order, size, 200).collect()}
    for i, w in tokens.items():
        own = [Counter(tuple(w[j - k + 1 : j + 1]) for j in range(k - 1, len(w))) for k in range(order + 1)]
        total = 0.0
        for j in range(len(w)):
            score = order * math.log(0.4) - math.log(words - len(w))
            for k in range(min(order, j + 1), 0, -1):
                gram = tuple(w[j - k + 1 : j + 1])
                c = count[k][gram] - own[k][gram]
                context = count[k - 1][gram[:-1]] - own[k - 1][gram[:-1]] if k > 1 else words - len(w)
                if c > 0 and context > 0:
                    score = math.log(c / context) + (order - k) * math.log(0.4)
                    break
            total += score
        assert found[i]["n_words"] == len(w) and found[i]["log_score"] == pytest.approx(total, rel=1e-9, abs=1e-9)
        assert (found[i]["mean_log_score"] is None) == (not w)


def test_backoff_of_little(make_docs):
    assert stupid_backoff.scored(make_docs([])).count() == 0
    assert stupid_backoff.scored(make_docs([(1, "only one text")])).first()["n_words"] == 3
    assert stupid_backoff.scored(make_docs([(1, None), (2, "")])).agg(F.sum("n_words")).first()[0] == 0

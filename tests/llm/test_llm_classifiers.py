"""Toxicity and quality: held-out accuracy, hierarchy, cases."""

import zlib

import numpy as np
from llm_helpers import clashing, documents, random_text, rng

from demandcast.llm import quality_classifier as Q
from demandcast.llm import toxicity as T
from demandcast.llm.common import Scratch

LABELS = "doc_id long, quality int, toxic int"


def toxic_corpus(n=400):
    r = rng(8)
    stems = ["grubbel", "snarfik"]
    ends = [a + b for a in "abdegikmnoprstuvz" for b in "aeiouy"]
    rows, labels = [], []
    for i in range(n):
        words = random_text(r, r.randrange(20, 300), 400).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(r.randrange(1, 4)):
                words[r.randrange(len(words))] = r.choice(stems) + r.choice(ends)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_unseen_inflections_are_found(spark):
    rows, labels = toxic_corpus()
    rows += [(5000, None), (5001, ""), (5002, "x"), (4, rows[4][1]), (None, "words")]
    docs = clashing(documents(spark, rows))
    out = T.classify(docs, clashing(spark.createDataFrame([*labels, (4, 1, 0), (3, 1, None), (None, 1, 1)], LABELS))).collect()
    assert len(out) == len(rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.predicted == 0 for r in out if r.doc_id in (5000, 5001))


def test_without_both_classes_nothing_is_toxic(spark):
    docs = documents(spark, [(1, "a b"), (2, "c")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS)
    assert [r.score for r in T.classify(docs, labels).collect()] == [0.0, 0.0]
    assert T.classify(documents(spark, []), labels).collect() == []


def test_worst_bag_and_training_is_repeatable():
    assert T.worst_bag(np.array([0.0, 5.0, 1.0]), 2) == 3.0 and T.worst_bag(np.array([4.0]), 5) == 4.0 and T.worst_bag(np.zeros(0), 5) == 0.0
    rows, labels = toxic_corpus(60)
    a, b = (T.train([T.cut(t, 5, 60, i) for i, t in rows], [t for _, _, t in labels]) for _ in range(2))
    assert np.array_equal(a.buckets, b.buckets) and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)


def plain_score(text, model):
    """A document's score a word at a time."""
    def of_word(word):
        parts = {f"<{word}>"[i:i + n] for n in (3, 4, 5) for i in range(len(word) + 3 - n)} | {f"<{word}>"} if word else set()
        parts = {zlib.crc32(p.encode()) % T.BUCKETS for p in parts}
        return sum(float(model.buckets[p]) for p in parts) / max(1, len(parts))

    found = [of_word(w.strip(T.EDGE)) for w in (text or "").lower().split()]
    size = min(model.bag, len(found))
    worst = max((sum(found[i:i + size]) / size for i in range(len(found) - size + 1)), default=0.0) if size else 0.0
    return 1 / (1 + np.exp(-(model.slope * (worst + model.bias) + model.shift)))


def test_scores_equal_brute_force_on_whole_texts(spark):
    rows, labels = toxic_corpus(200)
    r = rng(5)
    late = random_text(r, 30_000, 400) + " grubbelzu " + random_text(r, 10, 400)
    rows += [(5000, None), (5001, "  "), (5002, late), (5003, "\u00e9\u00df \u0130x <> -- w1"), (5004, "x" * 100_000)]
    docs = documents(spark, rows)
    model = T.fit(docs, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        assert abs(got[i] - plain_score(text, model)) < 1e-6, i
    assert got[5002] >= 0.5  # the toxic word is the 30,001st


def test_bags_are_bounded_and_spread_over_the_text():
    text = " ".join(f"w{i}" for i in range(10_000)) + " " + "y" * (T.LONGEST_WORD + 1)
    bags = T.cut(text, 5, 400, 3)
    assert len(bags) == 400 and bags == T.cut(text, 5, 400, 3)
    starts = [int(b.split()[0][1:]) for b in bags if b.strip()]
    assert min(starts) < 500 and max(starts) > 9_500 and all(s % 5 == 0 for s in starts)
    assert "y" * 50 not in " ".join(T.cut(text, 5, 10_000, 3))
    assert T.cut("", 5, 400, 3) == [""]


def test_shares_and_costs_move_the_threshold():
    r = np.random.default_rng(3)
    labels = np.repeat([0, 1], 2000)
    worst = r.normal(labels * 2.0, 1.0)
    plain = T.Model(np.zeros(1, np.float32), 0.0, 1.0, 0.0)
    for share in (0.05, 0.5):
        m = T.calibrate(plain, worst, labels, share)
        # two normals two apart: log odds 2x - 2 at even shares
        cut = -m.shift / m.slope
        want = 1 - np.log(T.MISS_COST * share / (1 - share)) / 2
        assert abs(cut - want) < 0.2 and abs(m.slope - 2) < 0.3
    assert T.calibrate(plain, worst[:5], labels[:5], 0.1) is plain


def quality_corpus():
    r = rng(2)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        text = random_text(r, r.randrange(10, 200), 400)
        rows.append((i, text if good else " ".join(w + "###" for w in text.split()), f"site{i % 7}"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_keeps_clean_documents(spark):
    rows, labels = quality_corpus()
    rows += [(900, None, None), (901, "", "site1"), (5, rows[5][1], "site5"), (None, rows[1][1], "new")]
    docs = clashing(documents(spark, rows))
    known = clashing(spark.createDataFrame([*labels, (None, 0, 0), (7, None, 0)], LABELS))
    kept = Q.keep_good(docs, known, Scratch(spark, "t"))
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    truth = {i: g for i, g, _ in labels}
    assert np.mean([(i in ids) == bool(g) for i, g in truth.items()]) > 0.98
    assert ids.count(5) == 2 and None in ids


def plain_features(text):
    words = text.split()
    n, length = len(words), len(text)
    count = lambda chars: sum(c in chars for c in text)
    marked = count(Q.SYMBOLS) / max(n, 1)
    upper = count(Q.UPPER) / max(length, 1)
    again = sum(a == b for a, b in zip(words, words[1:])) / max(n, 1)
    return [min(marked, 3) / 3, min(marked, 0.3) / 0.3, upper, min(upper, 0.1) / 0.1, len(set(words)) / max(n, 1), again, min(again, 0.05) / 0.05,
            min(count("|") / max(n, 1), 1), np.log1p(n) / 10, min(length / max(n, 1), 30) / 30, count("0123456789") / max(length, 1)]


def plain_strength(groups, priors):
    """Beta strength by the method of moments; groups of (n, good)."""
    chance = sum(p * (1 - p) for p in priors)
    spread = sum(n * (good / n - p) ** 2 for (n, good), p in zip(groups, priors)) - chance
    total = sum(n for n, _ in groups)
    between = max(spread, 0) / max(total - len(groups), 1)
    unit = sum(n * p * (1 - p) for (n, _), p in zip(groups, priors)) / total
    return min(unit / between if between else Q.LARGEST_STRENGTH, Q.LARGEST_STRENGTH)


def plain_posterior(rows, evidence):
    """{row number: (text, site, path, whole)} a row at a time."""
    logistic = lambda x: 1 / (1 + np.exp(-x))
    odds = [float(np.dot(evidence.weights, plain_features(text or "")) + evidence.bias) for text, _, _ in rows]
    site, path = {}, {}
    for x, (_, s, q) in zip(odds, rows):
        for held, key in ((site, s), (path, (s, q))):
            n, good = held.get(key, (0, 0.0))
            held[key] = (n + 1, good + logistic(x))
    whole = sum(g for _, g in site.values()) / len(rows)
    k = plain_strength(list(site.values()), [whole] * len(site))
    site_share = {s: (k * whole + good) / (k + n) for s, (n, good) in site.items()}
    k = plain_strength(list(path.values()), [site_share[s] for s, _ in path])
    path_share = {(s, q): (k * site_share[s] + good) / (k + n) for (s, q), (n, good) in path.items()}
    out = []
    for x, (_, s, q) in zip(odds, rows):
        share = path_share[s, q]
        out.append((logistic(x), site_share[s], share, logistic(x - evidence.sample_odds + np.log(share / (1 - share)))))
    return out


def sites_that_differ():
    """Texts from clean to marked, on sites of very different shares; the
    marks of a doubtful text say little, its site says much."""
    r = rng(21)
    rows, labels = [], []
    sites = [("clean", 400, 0.97), ("spam", 400, 0.05), ("mixed", 300, 0.5), ("one", 1, 0.0), ("two", 2, 1.0)]
    for site, n, share in sites:
        for i in range(n):
            good = r.random() < share
            words = random_text(r, r.randrange(30, 90), 400).split()
            marks = max(0, round(r.gauss(2 if good else 5, 1.8)))
            for at in r.sample(range(len(words)), min(marks, len(words))):
                words[at] += "#"
            rows.append((len(rows), " ".join(words), site, f"p{i % 2}"))
            labels.append((len(labels), int(good), 0))
    return rows, labels


def test_posterior_equals_brute_force_and_sites_decide_doubtful_texts(spark):
    rows, labels = sites_that_differ()
    rows += [(5000, None, None, None), (5001, "", "clean", "p0"), (3, rows[3][1], rows[3][2], rows[3][3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    # labels of every fifth document are kept from the fit
    known = spark.createDataFrame([x for x in labels if x[0] % 5], LABELS)
    evidence = Q.fit(docs, known)
    want = plain_posterior([r[1:] for r in rows], evidence)
    got = Q.posterior(docs, known, Scratch(spark, "t")).collect()
    got = sorted((r._id, r.text_probability, r.site_share, r.path_share, r.probability) for r in got)
    want = sorted((r[0], *w) for r, w in zip(rows, want))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1:] for g in got], [w[1:] for w in want], rtol=0, atol=1e-9)

    site, truth = {r[0]: r[2] for r in rows}, {i: g for i, g, _ in labels}
    held = [g for g in got if g[0] in truth and g[0] % 5 == 0]
    right = lambda column: np.mean([(g[column] >= 0.5) == bool(truth[g[0]]) for g in held])
    assert right(4) > right(1) + 0.02, (right(4), right(1))  # the hierarchy decides, and rightly
    flipped = {(site[g[0]], g[4] >= 0.5) for g in got if (g[1] >= 0.5) != (g[4] >= 0.5)}
    assert ("clean", True) in flipped and ("spam", False) in flipped
    share = {s: next(g[2] for g in got if site[g[0]] == s) for s in ("clean", "spam", "mixed", "one")}
    assert share["spam"] < share["one"] < share["mixed"] + 0.2 and share["spam"] < share["mixed"] < share["clean"]


def test_shares_do_not_depend_on_partitions(spark):
    r = rng(4)
    rows = [(f"s{i % 3}", i % 2, r.random() ** 9) for i in range(3000)]
    judged = spark.createDataFrame(rows, "_site string, _path int, _p double")
    found = [sorted(map(tuple, Q.site_posteriors(judged.repartition(n), Scratch(spark, "t")).collect())) for n in (1, 7)]
    assert found[0] == found[1]


def test_sites_are_shrunk_toward_the_whole(spark):
    rows = [("big", 0, 0.9)] * 400 + [("bad", 0, 0.1)] * 400 + [("tiny", 0, 0.1)] * 2 + [(None, None, 0.5)] * 50
    judged = spark.createDataFrame(rows, "_site string, _path int, _p double")
    got = {r._site: r for r in Q.site_posteriors(judged, Scratch(spark, "t")).collect()}
    whole = sum(r[2] for r in rows) / len(rows)
    assert got["big"].site_share > 0.85 and got["bad"].site_share < 0.15
    assert 0.1 < got["tiny"].site_share < whole  # sparse: between its own share and the prior
    assert abs(got[None].site_share - 0.5) < 0.05


def test_quality_without_labels_keeps_all(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    assert Q.keep_good(docs, spark.createDataFrame([], LABELS), Scratch(spark, "t")).count() == 2
    assert Q.keep_good(documents(spark, []), spark.createDataFrame([(1, 1, 0)], LABELS), Scratch(spark, "t")).count() == 0

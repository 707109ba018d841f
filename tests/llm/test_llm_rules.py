"""Quality rules: measurements against brute force, policies and ablations."""

from llm_helpers import clashing, documents, random_text, rng, words

from demandcast.llm import quality_rules as Q

R = rng(3)
TEXTS = [
    None, "", "   \n\t ", "one", "a b c d e a b c d e", "x " * 30, "line one\nline one\nline one\n\n \nother", "SHOUT LOUD " * 12,
    "a\x0bb\x0cc\rd\te f g", "#$% & | <> *" * 5, "é ü ñ 日本 🤖 " * 4, "a a a a a a", "a b c d e f a b c d",
    *[random_text(R, R.randrange(5, 120), 6) for _ in range(15)], " ".join(str(i) for i in range(3000)) + " 1 2 3 4 5",
]


def brute(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, g in enumerate(windows) if windows.count(g) > 1 for k in range(5)} if len(w) < 500 else None
    if covered is None:
        seen = {}
        for i, g in enumerate(windows):
            seen.setdefault(g, []).append(i)
        covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measurements_match_brute_force(spark):
    df = clashing(documents(spark, list(enumerate(TEXTS))).withColumnRenamed("n_chars", "n_lines"))
    book = Q.apply_policy(Q.ledger(Q.measure(df)))
    for r in book.collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(TEXTS[r.doc_id]), (TEXTS[r.doc_id], got)
        n, repeat = got[0], got[4]
        assert bool(r.failures & 3) == (n < 10 or 100 * repeat > 20 * n)


def test_rows_stay_rows(spark):
    df = documents(spark, [(1, "a b"), (1, "a b"), (None, None)])
    assert sorted((r.doc_id or -1, r.n_words) for r in Q.measure(df).collect()) == [(-1, 0), (1, 2), (1, 2)]
    assert Q.apply_policy(Q.ledger(Q.measure(documents(spark, [])))).collect() == []


def test_ablations_count_by_mask(spark):
    book = Q.ledger(Q.measure(documents(spark, list(enumerate(TEXTS)))))
    masks = [r.failures for r in book.collect()]
    names = [r.name for r in Q.default_rules()]
    for r in Q.ablations(book).collect():
        policy = next(p for p in Q.POLICIES if p.name == r.policy)
        whole, bit = Q.policy_mask(policy), 1 << names.index(r.rule)
        assert r.rejected == sum(bool(m & whole) for m in masks)
        assert r.failed == sum(bool(m & bit) for m in masks)
        assert r.only_this_rule == sum((m & whole) == bit for m in masks)

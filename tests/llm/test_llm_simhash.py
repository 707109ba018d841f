"""SimHash groups against brute force, also through points of heavy lists."""

import numpy as np
import pytest
import xxhash
from llm_helpers import clashing, documents, random_text, rng, words

from demandcast.llm import simhash as H
from demandcast.llm.common import Scratch
from demandcast.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, shingle=3):
    w = words((text or "").translate(LOWER))
    s = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(s)) if s else 0


def brute_groups(fps, distance=2):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    some = sorted(set(fps))
    for i, a in enumerate(some):
        for b in some[i + 1:]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in some}


def texts():
    r = rng(5)
    base = [random_text(r, 400) for _ in range(12)]
    near = [" ".join([*t.split()[:-1], "changed"]) for t in base]
    return [None, "", "One", "one", "Two words", "É é", *base, *near, base[0].upper(), base[1], base[1]]


def test_groups_match_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in H.groups(clashing(documents(spark, rows)), Scratch(spark, "t")).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    roots = brute_groups(fps.values())
    for i, f in fps.items():
        assert got[i].fp & (1 << 64) - 1 == f
        assert got[i].component_id == min(j for j, g in fps.items() if roots[g] == roots[f])


def planted(r):
    fps = [r.getrandbits(64) for _ in range(30)]
    center = r.getrandbits(64)
    # a dense cluster within two bytes, and chains of two bits a step
    fps += [center ^ (1 << r.randrange(16)) ^ (1 << r.randrange(16)) for _ in range(120)]
    chain = r.getrandbits(64)
    for _ in range(20):
        chain ^= (1 << r.randrange(64)) | (1 << r.randrange(64))
        fps.append(chain)
    return sorted(set(fps))


def signed(spark, fps):
    return spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")


def unsigned(v):
    return v & (1 << 64) - 1


def shared_bytes(a, b):
    return sum((a ^ b) >> 8 * p & 0xFF == 0 for p in range(8))


def check_links(spark, fps, distance, paired):
    roots = brute_groups(fps, distance)
    edges = H.links(signed(spark, fps), Scratch(spark, "t"), distance, paired).collect()
    assert all(bin(unsigned(e.a ^ e.b)).count("1") <= distance for e in edges)
    found = {f: f for f in fps}
    for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect():
        found[unsigned(r.node)] = unsigned(r.root)
    same = lambda m: {frozenset(f for f in fps if m[f] == g) for g in m.values()}
    assert same(found) == same(roots)


@pytest.mark.parametrize("paired", [2, 8, 1000])
def test_links_with_and_without_heavy_lists(spark, paired):
    check_links(spark, planted(rng(9)), 2, paired)


@pytest.mark.parametrize("distance", [0, 1, 3])
def test_links_at_other_distances(spark, distance):
    check_links(spark, planted(rng(9))[:120], distance, 8)
    with pytest.raises(ValueError, match="distance"):
        H.links(signed(spark, [1]), Scratch(spark, "t"), 8)


@pytest.mark.parametrize("paired", [4, 1000])
def test_tally_counts_shared_bytes(spark, paired):
    """Pairs that share six bytes are counted in full unless they lie in a
    heavy list of six; pairs that share fewer are met too, and are rejected."""
    fps = planted(rng(4))
    met, heavy = H.meetings(signed(spark, fps), Scratch(spark, "t"), 6, paired)
    counts = {(unsigned(r.a), unsigned(r.b)): r.tally for r in H.tally(met).collect()}
    lists = {}
    for r in heavy.collect():
        lists.setdefault((r.set, r.key), set()).add(unsigned(r.fp))
    assert all(len(m) > paired for m in lists.values()) and bool(lists) == (paired == 4)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            shared = shared_bytes(a, b)
            pair = (a, b) if (a, b) in counts else (b, a)
            told = counts.get(pair, 0)
            assert told <= shared
            if shared >= 6 and not any(a in m and b in m for m in lists.values()):
                assert told == shared
    assert any(n < 6 for n in counts.values())


def test_lists_begin_with_more_positions_for_more_fingerprints():
    assert [H._first_size(n, 6) for n in (0, 32, 33, 8192, 8193, 10**7, 10**11, 10**14)] == [1, 1, 2, 2, 3, 4, 5, 6]


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    rows = {r.node: r.root for r in components(spark.createDataFrame([*path, *star, (7, 7)], "a long, b long"), Scratch(spark, "t")).collect()}
    assert rows == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).collect() == []


def test_one_of_each_keeps_the_smallest_id(spark):
    t = texts()
    rows = [(i, x) for i, x in enumerate(t)] + [(6, t[6]), (6, "another text of the same id"), (None, t[7]), (None, "nobody has this"), (None, "nobody has this")]
    df = clashing(documents(spark, rows))
    kept = H.one_of_each(df, Scratch(spark, "t"))
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    roots = brute_groups([brute_fingerprint(x) for _, x in rows])
    groups = {}
    for i, x in rows:
        groups.setdefault(roots[brute_fingerprint(x)], []).append(i)
    want = sorted((min((i for i in ids if i is not None), default=-1) for ids in groups.values()))
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.select("doc_id").collect()) == want
    assert H.one_of_each(documents(spark, []), Scratch(spark, "t")).collect() == []


def test_bits_are_counted_over_pieces(monkeypatch):
    text = random_text(rng(2), 900, 300).encode()
    whole = H.fingerprint(text)
    monkeypatch.setattr(H, "PIECE", 100)
    assert H.fingerprint(text) == whole == brute_fingerprint(text.decode())
    assert np.uint64(whole) == whole

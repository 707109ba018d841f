"""Structure repair against a plain search over every sequence of edits."""

import hashlib
import heapq
import re
import time
import zlib

import pytest
from llm_helpers import clashing, rng

from demandcast.llm import structure_repair as R
from demandcast.llm.common import Scratch
from demandcast.llm.queries import repaired_conversations

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
VISIBLE = re.compile("[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_repair(rows):
    """(cost, audit, messages) of (role, fault, text) by a queue over whole
    strings of edits, checked by the grammar itself."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, initials, messages = heapq.heappop(queue)
        if i == len(rows) and GRAMMAR.fullmatch(initials):
            return cost, audit, messages
        tail = initials[-1:] if initials else "^"
        if (i, tail) in seen:
            continue
        seen.add((i, tail))
        options = [("I", 2, i, "u", ("user", "")), ("I", 2, i, "a", ("assistant", ""))]
        if i < len(rows):
            role, fault, text = rows[i]
            options.append(("D", 3, i + 1, "", None))
            if fault not in "bd":
                extra = int(fault == "t")
                options += [("R", 2 + extra, i + 1, x[0], (x, text)) for x in ("user", "assistant")]
                if role[:1] in ("s", "u", "a"):
                    options.append(("K", extra, i + 1, role[0], (role, text)))
        for letter, paid, j, initial, message in options:
            word = initials + initial
            if GRAMMAR.fullmatch(word) or GRAMMAR.fullmatch(word + "a") or word == "s":
                heapq.heappush(queue, (cost + paid, audit + letter, j, word, messages + ((message,) if message else ())))
    raise AssertionError


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = VISIBLE.findall(text)
        fault = "b" if not visible else "d" if (role, text) in seen else "t" if visible[-1] not in ".!?" else "f"
        seen.add((role, text))
        out.append((role, fault, text))
    return out


def expected(rows):
    rows_after, out = {}, []
    for row in damaged(rows):
        rows_after.setdefault(row[0], []).append(row)
    for conv in {r[0] for r in rows}:
        mine = sorted(rows_after.get(conv, []), key=lambda r: (r[1] is not None, r[1], r[2], R_key(r)))
        marked = faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        initials = [r[2][:1] for r in mine]
        cost, audit, messages = plain_repair(marked)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(f == x for _, f, _ in marked) for x in "bdt"],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{a}:{b}" for a, b in messages).encode()).hexdigest()))
    return sorted(out, key=repr)


def R_key(row):
    conv, turn, role, text = row
    body = hashlib.sha256(f"{'-' if conv is None else conv}:{len(role.encode())}:{role}{text}".encode()).digest()
    return hashlib.sha256(f"{'-' if turn is None else turn}:".encode() + body).digest()


def some_rows(seed, n):
    r, rows = rng(seed), []
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "student"]
    texts = ["Fine.", "cut", "", " \t", "Again!\n", None, "x" * 50 + "?", "é."]
    for c in range(n):
        for t in range(r.randrange(0, 9)):
            rows.append((c, r.choice([t, t, t, t + 3, None]), r.choice(roles), r.choice(texts) if r.random() < 0.6 else f"Text {c} {t}."))
    rows += [(900, t, "user" if t % 3 else "assistant", f"Turn {t}" + "." * (t % 5 > 0)) for t in range(150)]  # a long one
    rows += [(901, 1, "user", "Same.")] * 40 + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    rows += [(902, -2**63, "user", "Low."), (902, 2**63 - 2**40, "assistant", "L" * 300_000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_search(spark, monkeypatch, seed):
    rows = some_rows(seed, 80)
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(4)
    monkeypatch.setattr(R, "BLOCK", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repaired_conversations(df, Scratch(spark, "t")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [tuple(R.MOST if i == 1 and v > R.MOST else v for i, v in enumerate(row)) for row in expected(rows)]
    assert sorted(map(tuple, found), key=repr) == want


def test_search_and_blocks_agree():
    r = rng(7)
    for _ in range(300):
        codes = "".join(r.choice("uasxUAS-") for _ in range(r.randrange(2, 14)))
        cut = r.randrange(1, len(codes))
        tables = [tuple(zip(*[R.search(part, a, (b,)) for a, b in R.ENDS])) for part in (codes[:cut], codes[cut:])]
        cost, chosen = R.combine(tables)
        assert (cost, "".join(e for _, e in chosen)) == R.search(codes)


def test_search_of_a_full_block_is_quick():
    r = rng(8)
    for letters in ("sssu", "uasx", "uaUAS-", "sa", "ss-", "u", "a"):
        codes = "".join(r.choice(letters) for _ in range(R.BLOCK))
        start = time.perf_counter()
        for a, b in R.ENDS:
            R.search(codes, a, (b,))
        assert time.perf_counter() - start < 10, letters


def test_nothing(spark):
    assert repaired_conversations(spark.createDataFrame([], SCHEMA), Scratch(spark, "t")).count() == 0

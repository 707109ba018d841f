"""Conversation structure repair by depth-first branch and bound.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. The
edits of a row are Keep (0), Rerole to user or assistant (2) and Delete (3,
forced for blank and duplicate rows); an empty user or assistant message may
be inserted anywhere (2); a truncated row that stays costs 1. Wanted are the
cheapest edits, and of these the ASCII-least audit, the edits' initials in
order.

Search (:func:`search`): a node is (row, state of the grammar). An explicit
stack holds open prefixes, best estimate on top. A prefix's estimate is its
cost plus a lower bound of its suffix: the least cost in a looser grammar that,
as long as nothing is kept, lets system messages stand before any user message,
and in which a lone system message is complete. The incumbent is the best (cost, audit) so
far: a prefix goes if its estimate is above it, or equal with a larger audit.
A dominance table keeps the best (cost, audit) per node: another prefix there
that is no better goes too. (Two prefixes of one node and one cost hold equally
many inserts, so neither audit begins the other, and the smaller one wins
whatever follows.) The stack runs empty when the incumbent is proved best.

Distribution: rows travel without their texts, range-partitioned by
conversation, turn, role and text digest, so that a long conversation spreads
over tasks. A task searches whole conversations of up to ``BLOCK`` rows. Longer
ones, and those a partition border cuts, are searched in blocks, once per pair
of grammar states at a block's ends; per conversation, the blocks' tables are
then combined in order, some kilobytes each. The chosen edits go back to
the blocks, and kept rows meet their texts again by their digest.

Cases: rows are taken by turn (nulls first), role, then text digest; a row whose
role is empty or begins with another letter than s, u, a can't be kept; a null
conversation id is a conversation; null role and text count as empty; repeated
rows are duplicates of the first; an empty table gives empty tables; very long
texts are only digested; other columns are ignored; a span of turns beyond 64
bits counts as 2^63-1 gaps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow, pick, rows_in, Scratch

BLOCK = 256  # rows searched at once
# Grammar states: 0 nothing yet, 1 after the system message, 2 after a user, 3 after an assistant message.
START, GOALS = 0, (0, 3)
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ADD = (2, 2, 3, 2)  # state after the only message that may be added
ROLE = {2: "user", 3: "assistant"}
REACHED = ({0, 1, 2, 3}, {1, 2, 3}, {2, 3}, {2, 3})  # states that can follow a state
ENDS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]  # states a block can lead from and to
MOST = (1 << 63) - 1
BLANK, DUPLICATE, TRUNCATED, FINE = "b", "d", "t", "f"
VISIBLE_END = " \t\n\x0b\x0c\r"


# --- the search -------------------------------------------------------------
# A row is one character: '-' must be deleted, else the role's initial
# ('x' for one that can't be kept), in upper case if the text is truncated.

def suffix_bounds(codes: str, goals: tuple[int, ...], system: bool) -> list[tuple[int, int]]:
    """Per row, a lower bound of the costs of the rows from it on if a user
    message (first number) or an assistant message (second) comes next. With
    ``system``, a system row may be kept wherever a user message may come."""
    at = [0 if any(g != 2 for g in goals) else 2, 0 if 2 in goals else 2]
    bounds = [(at[0], at[1])]
    for code in reversed(codes):
        user, assistant = bounds[-1]
        if code == "-":
            at = [user + 3, assistant + 3]
        else:
            extra, kind = int(code.isupper()), code.lower()
            at = [min(user + 3, assistant + 2 + extra), min(assistant + 3, user + 2 + extra)]
            if kind == "u":
                at[0] = min(at[0], assistant + extra)
            elif kind == "a":
                at[1] = min(at[1], user + extra)
            elif kind == "s" and system:
                at[0] = min(at[0], user + extra)
        bounds.append((min(at[0], at[1] + 2), min(at[1], at[0] + 2)))
    bounds.reverse()
    return bounds


def search(codes: str, entry: int = START, goals: tuple[int, ...] = GOALS) -> tuple[int | None, str | None]:
    """Least (cost, audit) of edits that lead from ``entry`` to a goal state;
    nulls where none do (state 1 takes a system row to keep)."""
    n, begun = len(codes), suffix_bounds(codes, goals, False)
    fresh = suffix_bounds(codes, goals, True) if entry == START and "s" in codes.lower() else begun
    bounds = (fresh, begun, [b[::-1] for b in begun], begun)  # by state; after a user message an assistant message comes next
    best: tuple[int, str] | None = None
    dominant: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        label, node = (cost, audit), (i, state)
        if REACHED[state].isdisjoint(goals):
            continue
        if best is not None:
            estimate = cost + bounds[state][i][0]
            if estimate > best[0] or estimate == best[0] and audit > best[1][:len(audit)]:
                continue
        if node in dominant and dominant[node] <= label:
            continue
        dominant[node] = label
        if i == n and state in goals:
            if best is None or label < best:
                best = label
            continue
        added = ADD[state]
        after = [(cost + 2 + bounds[added][i][0], "I", i, added, cost + 2)]
        if i < n:
            code = codes[i]
            after.append((cost + 3 + bounds[state][i + 1][0], "D", i + 1, state, cost + 3))
            if code != "-":
                extra, kept = int(code.isupper()), KEEP.get((state, code.lower()))
                if kept is not None:
                    after.append((cost + extra + bounds[kept][i + 1][0], "K", i + 1, kept, cost + extra))
                after.append((cost + 2 + extra + bounds[added][i + 1][0], "R", i + 1, added, cost + 2 + extra))
        after.sort(reverse=True)  # the best estimate is taken first, ties by letter
        for _, letter, j, to, paid in after:
            known = dominant.get((j, to))
            if known is None or known > (paid, audit + letter):
                stack.append((j, to, paid, audit + letter))
    return (None, None) if best is None else best


# --- rows and blocks --------------------------------------------------------

def light_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, row_key, code, fault, n, first): equal rows of
    ``rows`` counted, ``first`` where role and text are not seen earlier."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    body = F.rtrim(text, F.lit(VISIBLE_END))
    end, initial = F.right(body, F.lit(1)), F.substring(role, 1, 1)
    fault = F.when(body == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    taken = keyed(rows).select("conv_id", "turn", role.alias("role"), "text_key", "row_key", initial.alias("initial"), kind.alias("kind"), fault.alias("fault"))
    counted = taken.groupBy(*taken.columns).agg(F.count(F.lit(1)).alias("n"))
    seen = counted.filter(F.col("fault") != BLANK).groupBy("text_key").agg(F.min_by("row_key", F.struct("turn")).alias("row_key"))
    joined = counted.join(seen.select("row_key", F.lit(True).alias("first")), "row_key", "left")
    return joined.select("conv_id", "turn", "role", "row_key", "initial", "kind", "fault", "n", F.coalesce("first", F.lit(False)).alias("first"))


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with ``text_key``, a digest of
    conversation, role and text, and ``row_key``, of that and the turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.concat(F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.lit(":"))
    df = pick(rows, "conv_id", "turn", "role", "text").withColumn("text_key", F.unhex(F.sha2(whole, 256)))
    return df.withColumn("row_key", F.unhex(F.sha2(F.concat(turn.cast("binary"), F.col("text_key")), 256)))


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_BLOCKS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("whole", pa.bool_()), ("first_initial", pa.string()),
     ("last_initial", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64())]
    + [(c, pa.int64()) for c in _COUNTS]
    + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("codes", pa.string()), ("keys", pa.list_(pa.binary())), ("roles", pa.list_(pa.string()))])
_BLOCKS_SQL = ("conv_id long, part int, block long, whole boolean, first_initial string, last_initial string, low long, high long, turns long, "
               "blank long, duplicate long, truncated long, illegal long, costs array<long>, audits array<string>, codes string, keys array<binary>, roles array<string>")
LEGAL = {"su", "ua", "au"}


class _Block:
    """Rows of one conversation on their way to a search."""

    def __init__(self, conv, part, number):
        self.place = (conv, part, number)
        self.codes: list[str] = []
        self.keys: list[bytes] = []
        self.roles: list[str] = []
        self.count = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role, key, initial, kind, fault):
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.count["illegal"] += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault == BLANK or fault == DUPLICATE:
            self.count["blank" if fault == BLANK else "duplicate"] += 1
            self.codes.append("-")
            return
        self.count["truncated"] += fault == TRUNCATED
        self.codes.append(kind.upper() if fault == TRUNCATED else kind)
        self.keys.append(key)
        self.roles.append(role)

    def record(self, whole: bool) -> tuple:
        codes = "".join(self.codes)
        found = [search(codes)] if whole else [search(codes, a, (b,)) for a, b in ENDS]
        return (*self.place, whole, self.first, self.last, self.low, self.high, self.turns, *self.count.values(),
                [c for c, _ in found], [a for _, a in found], codes, self.keys, self.roles)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks of a sorted partition. A conversation is whole if it neither
    begins nor ends the partition and fits a block."""
    block, at_border = None, True
    for batch in rows_in(batches, 4096):
        for conv, turn, role, key, initial, kind, fault, n, first, part in zip(*[c.to_pylist() for c in batch.columns]):
            if block is None or block.place[0] != conv:
                if block is not None:
                    yield block.record(not at_border and block.place[2] == 0)
                    at_border = False
                block = _Block(conv, part, 0)
            for copy in range(n):
                if len(block.codes) == BLOCK:
                    yield block.record(False)
                    block = _Block(conv, part, block.place[2] + 1)
                block.add(turn, role, key, initial, kind, fault if fault == BLANK or first and not copy else DUPLICATE)
    if block is not None:
        yield block.record(False)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


# --- combining blocks -------------------------------------------------------

_CHOICES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("entry", pa.int32()), ("edits", pa.string()),
                      ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64()), ("audit", pa.string())])
_CHOICES_SQL = ("conv_id long, part int, block long, entry int, edits string, gaps long, blank long, duplicate long, truncated long, "
                "illegal long, cost long, audit string")


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, MOST)


def combine(tables: list[tuple[list[int], list[str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Least cost over a conversation's blocks, and per block the entry state
    and the edits. The audits of states compared are of equal rows, so the
    order of whole audits is that of :func:`search`."""
    labels: dict[int, tuple[int, str]] = {START: (0, "")}
    came: list[dict[int, int]] = []
    for costs, audits in tables:
        new: dict[int, tuple[int, str]] = {}
        source: dict[int, int] = {}
        for (a, b), cost, audit in zip(ENDS, costs, audits):
            if a in labels and cost is not None:
                label = (labels[a][0] + cost, labels[a][1] + audit)
                if b not in new or label < new[b]:
                    new[b], source[b] = label, a
        labels = new
        came.append(source)
    state = min((g for g in GOALS if g in labels), key=lambda g: labels[g])
    cost, chosen = labels[state][0], []
    for (_, audits), source in zip(reversed(tables), reversed(came)):
        entry = source[state]
        chosen.append((entry, audits[ENDS.index((entry, state))]))
        state = entry
    return cost, chosen[::-1]


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Edits per block of the conversations that were searched in blocks; the
    last block's row carries the conversation's figures."""
    def finish(conv, blocks):
        cost, chosen = combine([(b["costs"], b["audits"]) for b in blocks])
        counts = {c: sum(b[c] for b in blocks) for c in _COUNTS}
        turns, high = 0, None
        for before, b in zip([None, *blocks], blocks):
            if before is not None and before["last_initial"] + b["first_initial"] not in LEGAL:
                counts["illegal"] += 1
            turns += b["turns"] - (b["low"] is not None and b["low"] == high)
            high = high if b["high"] is None else b["high"]
        low = next((b["low"] for b in blocks if b["low"] is not None), None)
        for b, (entry, edits) in zip(blocks[:-1], chosen):
            yield conv, b["part"], b["block"], entry, edits, None, None, None, None, None, None, None
        audit = "".join(e for _, e in chosen)
        yield (conv, blocks[-1]["part"], blocks[-1]["block"], *chosen[-1], gaps(low, high, turns), *counts.values(), cost, audit)

    conv, blocks = None, []
    for batch in rows_in(batches, 256):
        for row in batch.to_pylist():
            if blocks and row["conv_id"] != conv:
                yield from finish(conv, blocks)
                blocks = []
            conv = row["conv_id"]
            blocks.append(row)
    if blocks:
        yield from finish(conv, blocks)


_MESSAGES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("at", pa.int64()), ("role", pa.string()), ("row_key", pa.binary())])


def edited(codes: str, keys: list[bytes], roles: list[str], entry: int, edits: str) -> Iterator[tuple[str, bytes | None]]:
    """(role, key of the row or None for an inserted message) after the edits."""
    state, i, kept = entry, 0, 0
    for letter in edits:
        if letter == "I":
            state = ADD[state]
            yield ROLE[state], None
            continue
        code, i = codes[i], i + 1
        if code == "-":
            continue
        kept += 1
        if letter == "K":
            state = KEEP[state, code.lower()]
            yield roles[kept - 1], keys[kept - 1]
        elif letter == "R":
            state = ADD[state]
            yield ROLE[state], keys[kept - 1]


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in rows_in(batches, 256):
        for row in batch.to_pylist():
            found = edited(row["codes"], row["keys"], row["roles"], row["entry"], row["edits"])
            for at, (role, key) in enumerate(found):
                yield row["conv_id"], row["part"], row["block"], at, role, key


def repair(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(report, messages) of conversations given as rows (conv_id, turn, role,
    text). The report has a row per conversation: gaps, blank, duplicate,
    truncated, illegal, cost, audit. The messages are the repaired
    conversations (conv_id, part, block, at, role, text), in order of (part,
    block, at)."""
    rows = pick(rows, "conv_id", "turn", "role", "text").withColumns({"conv_id": F.col("conv_id").cast("long"), "turn": F.col("turn").cast("long")})
    order = ["conv_id", "turn", "role", "row_key"]
    placed = light_rows(rows).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    blocks = scratch.write(map_arrow(placed, lambda b: _batches(_records(b), _BLOCKS), _BLOCKS_SQL), "blocks")

    split = blocks.filter("not whole").select("conv_id", "part", "block", "first_initial", "last_initial", "low", "high", "turns", *_COUNTS, "costs", "audits")
    dealt = split.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    chosen = scratch.write(map_arrow(dealt, lambda b: _batches(_chosen(b), _CHOICES), _CHOICES_SQL), "choices")

    span = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns")
    whole = blocks.filter("whole").select(
        "conv_id", F.when(span.isNull(), 0).otherwise(F.least(span, F.lit(MOST).cast("decimal(38,0)"))).cast("long").alias("gaps"), *_COUNTS,
        F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    report = whole.unionByName(chosen.filter("cost is not null").drop("part", "block", "entry", "edits"))

    body = ["conv_id", "part", "block", "codes", "keys", "roles"]
    ready = blocks.filter("whole").select(*body, F.lit(START).alias("entry"), F.col("audits")[0].alias("edits"))
    place = [F.col("b.conv_id").eqNullSafe(F.col("c.conv_id")), F.col("b.part") == F.col("c.part"), F.col("b.block") == F.col("c.block")]
    cut = blocks.filter("not whole").alias("b").join(chosen.select("conv_id", "part", "block", "entry", "edits").alias("c"), place).select(
        *[f"b.{c}" for c in body], "c.entry", "c.edits")
    edits = map_arrow(ready.unionByName(cut), lambda b: _batches(_messages(b), _MESSAGES), "conv_id long, part int, block long, at long, role string, row_key binary")
    placed = scratch.write(edits, "edits")
    texts = keyed(rows).select("row_key", "text").dropDuplicates(["row_key"])
    columns = ["conv_id", "part", "block", "at", "role"]
    kept = placed.join(texts, "row_key").select(*columns, F.coalesce("text", F.lit("")).alias("text"))
    # inserted messages have no key to meet on
    messages = kept.unionByName(placed.filter("row_key is null").select(*columns, F.lit("").alias("text")))
    return report, messages


def damage(df: DataFrame, kinds: int = 20) -> DataFrame:
    """Rows (conv_id, turn, role, text) with seeded faults, by crc32 of
    ``conv_id:turn`` modulo ``kinds``: 0 drops a row, 1 empties its text, 2
    takes the sentence marks out, 3 repeats it, 4 sets its role to user; nulls
    become one space."""
    rows = pick(df, "conv_id", "turn", "role", "text")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    kind = F.col("kind")
    changed = rows.withColumn("kind", F.pmod(F.crc32(named.cast("binary")), F.lit(kinds))).filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"))
    return changed.drop("copy")


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
NO_MESSAGE = hashlib.sha256(b"").hexdigest()


def digests(messages: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of a conversation's ``role:text``
    lines; its messages stream by, one at a time."""
    def rows(batches):
        begun, conv, digest = False, None, None
        for batch in rows_in(batches, 1024):
            for c, role, text in zip(*[x.to_pylist() for x in batch.columns]):
                if begun and c == conv:
                    digest.update(b"\n")
                else:
                    if begun:
                        yield conv, digest.hexdigest()
                    begun, conv, digest = True, c, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
        if begun:
            yield conv, digest.hexdigest()

    ordered = messages.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "at").select("conv_id", "role", "text")
    return map_arrow(ordered, lambda b: _batches(rows(b), _DIGESTS), "conv_id long, repaired_sha256 string")


def summary(conversations: DataFrame, report: DataFrame, messages: DataFrame) -> DataFrame:
    """A row for each conversation of ``conversations``, whether or not rows
    of it are left: the report's figures and the digest of its messages."""
    ids = pick(conversations, "conv_id").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    known = ids.unionByName(report, allowMissingColumns=True).unionByName(digests(messages), allowMissingColumns=True)
    numbers = ["gaps", *_COUNTS, "cost"]
    one = known.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in [*numbers, "audit", "repaired_sha256"]])
    return one.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(NO_MESSAGE)).alias("repaired_sha256"))

"""Substring deduplication by fixed-block anchors.

A window of ``window`` words that starts somewhere earlier in the corpus is
repeated; every word it covers is removed. Every window holds one whole block
of ``window`` // 2 words that begins at a multiple of that length in its
document: its anchor. A window can be repeated only if its anchor's words
stand somewhere else, at whatever position.

1. Index and probe. Blocks at multiples of the block length are the index;
   every rolling window of the block length is a probe. Both are hashed; each
   task joins up the hashes of a batch of documents (a hash is sent once per
   batch, so a passage of many documents costs each bucket one entry per
   batch) and sends sorted runs of them, packed, to buckets by hash. A bucket
   finds the blocks whose hash occurs elsewhere: the hits.
2. Extend. Windows around hits are compared as a whole, again by buckets, on
   their 128-bit digests: the first in order of (document, position) stays,
   the others are repeated. Windows in a row make up the maximal repeats.
3. Cut. The words of repeated windows go from the documents that have any.

Hashes of step 1 keep 48 bits and may only bring too many windows to step 2.
The text itself moves only for documents with hits. Nothing is paired: per
hash or digest the entries of a bucket are one per batch, and batches hold
``BATCH_WORDS`` words. Buckets hold ``BUCKET_BYTES`` of text at any size of the
corpus, and the number of tasks follows them.

Cases: a null or empty text has no words; texts shorter than a window keep
all; of rows that share an id (or have none) the order is fixed by sorting,
ids first and rows without id last, so a repeated row counts as a later
document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import Memo, Scratch, keep_row, map_arrow, python_bytes, rows_in
from demandcast.session import broadcast_max_rows

WINDOW = 20
BATCH_WORDS = 1 << 19
BUCKET_BYTES = 8 << 20  # of text per bucket, whatever the size of the corpus
LEAST_BUCKETS = 64  # of small corpora, to spread their work
TASK_BUCKETS = 4  # per task, where the session's shuffle partitions are too few
WORDS_KEPT = 300_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)

# Rows between the steps. kind: blob (for a bucket), part (runs of a document,
# on its way through a bucket's task), info (of a document), pack (findings of
# a bucket for a group of documents).
BLOB, PART, INFO, PACK = 0, 1, 2, 3
ROW = "kind int, bucket int, key long, n long, digest string, a binary, b binary, c binary"
_ROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("digest", pa.string()),
                  ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)


# Two 64-bit hashes of a word, remembered by a worker between batches.
_word = Memo(xxhash.xxh3_128_digest, WORDS_KEPT)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(_word.__getitem__, words)), "<u8").reshape(-1, 2)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbours of a column of word hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= FACTOR
        out += hashes[k:k + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as 4-byte steps where they fit, with a leading mark."""
    if not len(values):
        return b""
    steps = np.diff(values)
    if len(steps) and int(steps.max()) >= 1 << 32:
        return b"\1" + values.astype("<u8").tobytes()
    return b"\0" + values[:1].astype("<u8").tobytes() + steps.astype("<u4").tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    if blob[0]:
        return np.frombuffer(blob, "<u8", offset=1)
    first = np.frombuffer(blob, "<u8", 1, 1)
    return np.concatenate([first, first + np.cumsum(np.frombuffer(blob, "<u4", offset=9), dtype=np.uint64)])


def to_runs(positions: np.ndarray) -> np.ndarray:
    """(start, length) of the runs of sorted distinct positions."""
    if not len(positions):
        return np.zeros((0, 2), np.int64)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(positions) != 1]))
    return np.stack([positions[starts], np.diff(np.append(starts, len(positions)))], axis=1)


def runs_mask(runs: np.ndarray, size: int, before: int = 0, after: int = 0) -> np.ndarray:
    """Marks of the positions from ``before`` ahead of a run to ``after`` past it."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, np.clip(runs[:, 0] - before, 0, size), 1)
    np.add.at(edges, np.clip(runs[:, 0] + runs[:, 1] + after, 0, size), -1)
    return np.cumsum(edges[:size]) > 0


def _runs_of(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u4").reshape(-1, 2).astype(np.int64)


def _by_bucket(values: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted 64-bit values by bucket; buckets cut their range."""
    of = ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
    for k, at in enumerate(cuts):
        yield int(of[at]), slice(at, cuts[k + 1] if k + 1 < len(cuts) else len(of))


def _parts(keys: np.ndarray, positions: np.ndarray, buckets: int, step: int = 1) -> list[tuple]:
    """PART rows, a document each, of (key, position) pairs; positions that are
    ``step`` apart make runs."""
    order = np.lexsort((positions, keys))
    keys, positions = keys[order], positions[order] // step
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    out = []
    for k, at in enumerate(cuts):
        end = cuts[k + 1] if k + 1 < len(cuts) else len(keys)
        runs = to_runs(np.unique(positions[at:end]))
        out.append((PART, int(keys[at] % buckets), int(keys[at]), None, None, runs.astype("<u4").tobytes(), None, None))
    return out


def _packs(keys: np.ndarray, positions: np.ndarray, groups: int) -> list[tuple]:
    """PACK rows of (key, position) pairs, one for each group of documents, so
    that their number does not grow with the documents of a bucket."""
    of = keys % groups
    order = np.argsort(of, kind="stable")
    of, keys, positions = of[order], keys[order], positions[order]
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
    ends = [*cuts[1:], len(of)]
    return [(PACK, int(of[a]), None, None, None, keys[a:b].astype("<i8").tobytes(), positions[a:b].astype("<u4").tobytes(), None) for a, b in zip(cuts, ends)]


def _batches_of_documents(batches, words_of_row: Callable) -> Iterator[list]:
    held, size = [], 0
    for batch in rows_in(batches, 256):
        for item, n in words_of_row(batch):
            held.append(item)
            size += n
            if size >= BATCH_WORDS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _index(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """Step 1 in a document's task: info of every document, packed hashes of
    blocks and probes for the buckets, hits that the batch shows by itself."""
    block = window // 2

    def read(batch):
        for key, text in zip(batch.column(0).to_pylist(), python_bytes(batch.column(1))):
            words = text.split()
            yield (key, words), len(words) + 1

    def run(batches):
        for docs_here in _batches_of_documents(batches, read):
            yield _rows([(INFO, int(key % buckets), key, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), None, None, None) for key, words in docs_here])
            long = [(key, words) for key, words in docs_here if len(words) >= window]
            if not long:
                continue
            hashes = [rolling(word_hashes(words)[:, 0], block) for _, words in long]
            sizes = [len(h) for h in hashes]
            h = np.concatenate(hashes) >> np.uint64(16)
            key = np.repeat(np.array([k for k, _ in long], np.int64), sizes)
            at = np.concatenate([np.arange(n) for n in sizes])
            del hashes
            order = np.argsort(h, kind="stable")
            h, key, at = h[order], key[order], at[order]
            first = np.concatenate([[True], h[1:] != h[:-1]])
            group = np.cumsum(first) - 1
            many = (np.bincount(group) > 1)[group]
            anchor = at % block == 0
            local = many & anchor
            out = _parts(key[local], at[local], buckets, block)
            alone = anchor & ~many
            probe = first & ~alone
            wide = h << np.uint64(16)
            blobs: dict[int, list] = {}
            for b, part in _by_bucket(wide[probe], buckets):
                blobs.setdefault(b, [b"", b"", b""])[0] = pack(h[probe][part])
            a_h, a_key, a_at = h[alone], key[alone], at[alone] // block
            for b, part in _by_bucket(wide[alone], buckets):
                blobs.setdefault(b, [b"", b"", b""])[1:] = [pack(a_h[part]), a_key[part].astype("<i8").tobytes() + a_at[part].astype("<u4").tobytes()]
            out += [(BLOB, b, None, None, None, *x) for b, x in blobs.items()]
            if out:
                yield _rows(out)

    return map_arrow(docs, _nonempty(run), ROW)


def _nonempty(run: Callable) -> Callable:
    """Drop batches without rows."""
    return lambda batches: (b for b in run(batches) if b.num_rows)


def _buckets_in(batches) -> Iterator[tuple[list, list]]:
    """(blobs of one bucket, rows passing through), from rows sorted by bucket."""
    bucket, blobs, others = None, [], []
    for batch in rows_in(batches, 64):
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[0] != BLOB:
                others.append(row)
            else:
                if row[1] != bucket and blobs:
                    yield blobs, others
                    blobs, others = [], []
                bucket = row[1]
                blobs.append(row[5:])
        if len(others) >= 1024:
            yield [], others
            others = []
    if blobs or others:
        yield blobs, others


def bucket_count(size: int) -> int:
    """Buckets of a corpus of ``size`` bytes of text."""
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows by bucket, to tasks whose number follows the buckets: a task holds
    ``TASK_BUCKETS`` of them on average, or fewer."""
    tasks = -(-buckets // TASK_BUCKETS)
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(tasks, "bucket")
    return rows.repartition("bucket")


def _through_buckets(sent: DataFrame, judge: Callable, buckets: int) -> DataFrame:
    """Deal rows out by bucket and let ``judge`` turn a bucket's blobs into
    (keys, positions); these and the rows passing through come out."""

    def run(batches):
        for blobs, others in _buckets_in(batches):
            if others:
                yield _rows(others)
            if blobs:
                if found := _packs(*judge(blobs), buckets):
                    yield _rows(found)

    dealt = _dealt(sent, buckets).sortWithinPartitions("kind", "bucket")
    return map_arrow(dealt, _nonempty(run), ROW)


def _hit_blocks(blobs: list) -> tuple[np.ndarray, np.ndarray]:
    """(keys, block numbers) of index blocks whose hash occurs elsewhere."""
    index = [unpack(b) for _, b, _ in blobs]
    sizes = [len(x) for x in index]
    blocks = np.concatenate(index)
    key = np.concatenate([np.frombuffer(c, "<i8", n) for n, (_, _, c) in zip(sizes, blobs)])
    number = np.concatenate([np.frombuffer(c, "<u4", n, 8 * n) for n, (_, _, c) in zip(sizes, blobs)]).astype(np.int64)
    every = np.sort(np.concatenate([blocks, *[unpack(a) for a, _, _ in blobs]]))
    count = np.searchsorted(every, blocks, "right") - np.searchsorted(every, blocks, "left")
    return key[count > 1], number[count > 1]


def _extend(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """Step 2 in a document's task: digests of the windows anchored in hits,
    the first of each batch for the buckets, the others repeated at once."""
    block = window // 2

    def read(batch):
        for key, text, hits in zip(batch.column(0).to_pylist(), python_bytes(batch.column(1)), batch.column(2).to_pylist()):
            words = text.split()
            n = len(words) - window + 1
            anchors = runs_mask(_runs_of(hits), max(n, 0) // block + 2)
            starts = np.arange(max(n, 0))
            starts = starts[anchors[-(-starts // block)]]
            yield (key, words, starts), len(words) + 1

    def run(batches):
        for docs_here in _batches_of_documents(batches, read):
            docs_here.sort(key=lambda d: d[0])  # in a batch, order is that of the corpus
            digests, sizes = [], []
            for _, words, starts in docs_here:
                lanes = word_hashes(words)
                digests.append(np.stack([rolling(lanes[:, k], window)[starts] for k in (0, 1)], axis=1) if len(starts) else np.zeros((0, 2), np.uint64))
                sizes.append(len(starts))
            digest = np.concatenate(digests)
            if not len(digest):
                continue
            key = np.repeat(np.array([d[0] for d in docs_here], np.int64), sizes)
            at = np.concatenate([d[2] for d in docs_here])
            order = np.lexsort((digest[:, 1], digest[:, 0]))  # stable: first in the corpus first
            digest, key, at = digest[order], key[order], at[order]
            first = np.concatenate([[True], np.any(digest[1:] != digest[:-1], axis=1)])
            out = _parts(key[~first], at[~first], buckets)
            digest, key, at = digest[first], key[first], at[first]
            for b, part in _by_bucket(digest[:, 0], buckets):
                place = key[part].astype("<i8").tobytes() + at[part].astype("<u4").tobytes()
                out.append((BLOB, b, None, None, None, digest[part, 0].astype("<u8").tobytes(), digest[part, 1].astype("<u8").tobytes(), place))
            yield _rows(out)

    return map_arrow(docs, _nonempty(run), ROW)


def _repeated_windows(blobs: list) -> tuple[np.ndarray, np.ndarray]:
    """(keys, positions) of all but the first of each digest."""
    sizes = [len(a) // 8 for a, _, _ in blobs]
    high = np.frombuffer(b"".join(a for a, _, _ in blobs), "<u8")
    low = np.frombuffer(b"".join(b for _, b, _ in blobs), "<u8")
    key = np.concatenate([np.frombuffer(c, "<i8", n) for n, (_, _, c) in zip(sizes, blobs)])
    at = np.concatenate([np.frombuffer(c, "<u4", n, 8 * n) for n, (_, _, c) in zip(sizes, blobs)]).astype(np.int64)
    order = np.lexsort((at, key, low, high))
    high, low, key, at = high[order], low[order], key[order], at[order]
    again = np.concatenate([[False], (high[1:] == high[:-1]) & (low[1:] == low[:-1])])
    return key[again], at[again]


def _by_document(rows: DataFrame, buckets: int) -> DataFrame:
    """(key, found binary): the runs of each document that has any, joined up
    from all buckets a group of documents at a time."""
    schema = pa.schema([("key", pa.int64()), ("found", pa.binary())])

    def joined(parts: list[tuple]) -> pa.RecordBatch:
        keys, positions = [], []
        for kind, _, key, a, b in parts:
            if kind == PACK:
                keys.append(np.frombuffer(a, "<i8"))
                positions.append(np.frombuffer(b, "<u4").astype(np.int64))
            else:
                runs = _runs_of(a)
                starts = np.repeat(runs[:, 0] - np.concatenate([[0], np.cumsum(runs[:-1, 1])]), runs[:, 1])
                positions.append(starts + np.arange(len(starts)))
                keys.append(np.full(len(starts), key, np.int64))
        runs = [(r[2], r[5]) for r in _parts(np.concatenate(keys), np.concatenate(positions), 1)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*runs), schema)], schema=schema)

    def run(batches):
        group, held = None, []
        for batch in rows_in(batches, 1024):
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[1] != group and held:
                    yield joined(held)
                    held = []
                group = row[1]
                held.append(row)
        if held:
            yield joined(held)

    dealt = rows.filter(F.col("kind").isin(PART, PACK)).select("kind", "bucket", "key", "a", "b")
    dealt = _dealt(dealt, buckets).sortWithinPartitions("bucket")
    return map_arrow(dealt, run, "key long, found binary")


def _with_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents that have findings; their texts alone are moved. ``found`` is
    a written table; its keys are broadcast if the counted rows allow."""
    if found.count() <= broadcast_max_rows(docs.sparkSession):
        docs = docs.join(F.broadcast(found.select("key")), "key", "left_semi")
    return docs.join(found, "key").select("key", "text", "found")


def repeats(docs: DataFrame, scratch: Scratch, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """For documents (key long, distinct; text): the info rows (key, n_words,
    digest of the words) and (key, found) with the runs of repeated windows."""
    if window < 2 or window % 2:
        raise ValueError("the window must be an even number of words")
    size = docs.agg(F.sum(F.octet_length("text")).alias("s")).first()["s"] or 0
    buckets = bucket_count(size)
    probed = scratch.write(_through_buckets(_index(docs, window, buckets), _hit_blocks, buckets), "probed")
    info = probed.filter(F.col("kind") == INFO).select("key", F.col("n").alias("n_words"), "digest")
    hits = scratch.write(_by_document(probed, buckets), "hits")
    judged = scratch.write(_through_buckets(_extend(_with_found(docs, hits), window, buckets), _repeated_windows, buckets), "judged")
    return info, scratch.write(_by_document(judged, buckets), "repeats")


def _cut(found: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """(key, n_removed, digest, text) of documents with repeated windows."""
    schema = pa.schema([("key", pa.int64()), ("n_removed", pa.int64()), ("digest", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in rows_in(batches, 256):
            out = []
            for key, text, runs in zip(batch.column(0).to_pylist(), python_bytes(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split()
                gone = runs_mask(_runs_of(runs), len(words), after=window - 1)
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((key, int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest(), _kept_text(text, words, gone) if keep_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return map_arrow(found, _nonempty(run), "key long, n_removed long, digest string, text string")


def _kept_text(text: bytes, words: list[bytes], gone: np.ndarray) -> str:
    """The text without the words that go; kept runs stay as written, a line
    break stands for what was between them."""
    spans, at, begin = [], 0, None
    end = 0
    for word, g in zip(words, gone.tolist()):
        start = text.index(word, at)
        at = start + len(word)
        if g and begin is not None:
            spans.append(text[begin:end])
            begin = None
        elif not g and begin is None:
            begin = start
        end = at
    if begin is not None:
        spans.append(text[begin:end])
    return b"\n".join(spans).decode()


def _keyed(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with _row, _key; (key, text)): the key is the id where ids are
    distinct, else a number in order of ids, written with the rows."""
    rows = keep_row(docs, id_col, text_col).toDF("_row", "_id", "_text").withColumn("_id", F.col("_id").cast("long"))
    ids = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or _id is null")
    if ids.isEmpty():
        keyed = rows.withColumn("_key", F.col("_id"))
    else:
        ordered = rows.orderBy(F.col("_id").asc_nulls_last(), F.xxhash64("_text"), F.col("_text"))
        keyed = scratch.write(ordered.withColumn("_key", F.monotonically_increasing_id()), "keyed")
    texts = keyed.select(F.col("_key").alias("key"), F.coalesce(F.col("_text").cast("string"), F.lit("")).alias("text"))
    return keyed, texts


def removed(docs: DataFrame, scratch: Scratch, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row of ``docs``."""
    keyed, texts = _keyed(docs, scratch, id_col, text_col)
    info, found = repeats(texts, scratch, window)
    cut = _cut(_with_found(texts, found), window, False).select("key", "n_removed", F.col("digest").alias("cut"))
    out = info.join(cut, "key", "left").select(
        "key", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("cut", "digest").alias("kept_sha256"))
    return keyed.select(F.col("_key").alias("key"), F.col("_id").alias(id_col)).join(out, "key").drop("key")


def without_repeats(docs: DataFrame, scratch: Scratch, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with repeated words cut out of their texts (and
    ``length_col`` the new length); rows that lose all words go."""
    keyed, texts = _keyed(docs, scratch, id_col, text_col)
    _, found = repeats(texts, scratch, window)
    cut = scratch.write(_cut(_with_found(texts, found), window, True), "cut").select("key", F.col("text").alias("_cut"))
    at = docs.columns.index(text_col)
    joined = keyed.join(cut, F.col("_key") == F.col("key"), "left").filter("_cut is null or _cut <> ''")
    columns = [F.col("_row")[f"_c{i}"] for i in range(len(docs.columns))]
    columns[at] = F.when(F.col("_cut").isNotNull(), F.col("_cut")).otherwise(columns[at])
    if length_col in docs.columns:
        columns[docs.columns.index(length_col)] = F.when(F.col("_cut").isNotNull(), F.length("_cut").cast(docs.schema[length_col].dataType)).otherwise(
            columns[docs.columns.index(length_col)])
    return joined.select(*columns).toDF(*docs.columns)

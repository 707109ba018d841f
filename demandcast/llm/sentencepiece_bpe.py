"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding is a score-ordered agenda: every adjacent pair of symbols that forms
a piece waits in a heap by (score, position); the best pair is merged, the
pairs around it are renewed, until the agenda is empty. Symbols that are no
piece fall back to their UTF-8 bytes. No piece of such a vocabulary continues
across the start of a run of spaces, nor across two characters that are
neighbours in no piece, so a text falls into segments that are encoded on their own (see
``segment_pattern``); a worker remembers the segments it has met.

Every segment not met before is also encoded by the sentencepiece library,
in one call per Arrow batch; on any difference (none known) the task fails and
names the segment. The result is the agenda's, never the library's.

Cases: a null or empty text has no ids and decodes to the empty text;
repeated rows give repeated rows; an empty table gives an empty table; a very
long text is encoded whole, segment by segment.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow, pick, python_strings, rows_in

SPACE = "▁"
SEGMENTS_KEPT = 400_000  # per worker and generation
LONGEST_KEPT = 64  # characters; longer segments are encoded each time
ROWS_AT_A_TIME = 256
MARKS = ".,!?;:|%$&*#\"()"
SHORT = 64  # characters; up to here a linear look for the best pair beats a heap
NEVER = float("inf")


class Agenda:
    """Merge encoder over the vocabulary of a SentencePiece BPE model."""

    def __init__(self, model_path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        m = self.library
        self.byte_id = {}
        self.pieces: dict[str, tuple[float, int]] = {}
        for i in range(m.vocab_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                self.pieces[piece] = (-m.get_score(i), i)
        self.unknown = m.unk_id()
        self.cost = {piece: cost for piece, (cost, _) in self.pieces.items()}
        self.ids = {piece: i for piece, (_, i) in self.pieces.items()}
        longer = [p for p in self.pieces if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("pieces that hold a space after other characters are not supported")
        if "".join(m.encode(" a  b ", out_type=str)) != "  a  b ".replace(" ", SPACE):
            raise ValueError("the model must keep all spaces and add one in front")
        self.segment = re.compile(self.segment_pattern(longer))
        self.young: dict[str, tuple[list[int], str]] = {}
        self.old: dict[str, tuple[list[int], str]] = {}

    @staticmethod
    def segment_pattern(longer: list[str]) -> str:
        """A segment begins at a run of spaces. It ends as well, if the
        vocabulary allows, at a line break and between a letter and a mark: no
        piece may hold the two characters next to each other."""
        if any("\n" in p for p in longer):
            return " +[^ ]*"
        pairs = {p[i:i + 2] for p in longer for i in range(len(p) - 1)}
        odd = {a for a, b in pairs if b in MARKS and (a.isalpha() or re.match(r"[^\W\d_]", a))}
        word = rf"[^\W\d_{re.escape(''.join(sorted(odd)))}]+(?=[ \n{re.escape(MARKS)}]|\Z)"
        return rf" +{word}| +[^ \n]*|{word}|[^ \n]+|\n"

    def segments(self, text: str) -> list[str]:
        """The text with its leading space, cut where no merge can cross."""
        return self.segment.findall(" " + text.replace(SPACE, " ")) if text else []

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment, by the agenda: an array of the pairs' costs for
        a short segment, a heap for a long one."""
        if len(segment) > SHORT:
            return self.merge_long(segment)
        cost = self.cost.get
        symbols = list(segment.replace(" ", SPACE))
        agenda = [cost(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)  # the leftmost of the best
            symbols[i] = joined = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + joined, NEVER)
            if i < len(agenda):
                agenda[i] = cost(joined + symbols[i + 1], NEVER)
        return self.to_ids(symbols)

    def to_ids(self, symbols: list[str | None]) -> list[int]:
        ids = []
        for symbol in symbols:
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            elif symbol is not None and self.byte_id:
                ids.extend(self.byte_id[b] for b in symbol.encode())
            elif symbol is not None:
                ids.append(self.unknown)
        return ids

    def merge_long(self, segment: str) -> list[int]:
        pieces = self.pieces
        symbols: list[str | None] = list(segment.replace(" ", SPACE))
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            joined = symbols[i] + symbols[i + 1]
            if joined in pieces:
                agenda.append((pieces[joined][0], i, joined))
        heapify(agenda)
        while agenda:
            _, left, joined = heappop(agenda)
            first = symbols[left]
            right = after[left]
            if first is None or right >= n or len(first) + len(symbols[right]) != len(joined) or first + symbols[right] != joined:
                continue  # one of the two has been merged since
            symbols[left] = joined
            symbols[right] = None
            after[left] = beyond = after[right]
            if beyond < n:
                before[beyond] = left
                pair = joined + symbols[beyond]
                if pair in pieces:
                    heappush(agenda, (pieces[pair][0], left, pair))
            ahead = before[left]
            if ahead >= 0:
                pair = symbols[ahead] + joined
                if pair in pieces:
                    heappush(agenda, (pieces[pair][0], ahead, pair))
        return self.to_ids(symbols)

    def checked(self, segments: list[str]) -> list[list[int]]:
        """Agenda ids of the segments, held against one library call for all; a
        difference raises, since the ids of the agenda are the result."""
        # The library puts a space in front: it stands for a segment's first
        # space; other segments follow a line break, whose ids are cut off.
        asked = [s[1:] if s[0] == " " else "\n" + s for s in segments]
        lead = len(self.library.encode("\n"))
        told = self.library.encode(asked, num_threads=1)
        out = []
        for segment, text, theirs in zip(segments, asked, told):
            ids = self.merge(segment)
            theirs = self.merge(" ") if not text else theirs if segment[0] == " " else theirs[lead:]
            if ids != theirs:
                raise ValueError(f"agenda and library differ on {segment!r}: {ids} and {theirs}")
            out.append(ids)
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[list[tuple[list[int], str]]]:
        """Per text the (ids, ids joined by commas) of its segments."""
        cut = [self.segments(t) for t in texts]
        found = [list(map(self.young.get, segments)) for segments in cut]
        unknown = {s for segments, entries in zip(cut, found) if None in entries for s, e in zip(segments, entries) if e is None}
        young, old = self.young, self.old
        for segment in unknown.intersection(old):
            young[segment] = old[segment]
        new = list(unknown.difference(old))
        for segment, ids in zip(new, self.checked(new) if new else []):
            young[segment] = (ids, ",".join(map(str, ids)))
        for segments, entries in zip(cut, found):
            yield list(map(young.__getitem__, segments)) if None in entries else entries
        for segment in new:
            if len(segment) > LONGEST_KEPT:
                del young[segment]
        if len(young) > SEGMENTS_KEPT:
            self.young, self.old = {}, young


@lru_cache(maxsize=2)
def agenda_for(model_path: str) -> Agenda:
    return Agenda(model_path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _encoded(df: DataFrame, id_col: str, text_col: str, model_path: str | None) -> tuple[DataFrame, str]:
    picked = pick(df, id_col, text_col).toDF("_id", "_text").withColumn("_text", F.col("_text").cast("string"))
    return picked, model_path or default_model()


def encode_texts(df: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) per row."""
    source, path = _encoded(df, id_col, text_col, model_path)
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = agenda_for(path)
        for batch in rows_in(batches, ROWS_AT_A_TIME):
            ids = [list(chain.from_iterable(e[0] for e in x)) for x in encoder.encode_batch(python_strings(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([encoder.library.decode(x) for x in ids], pa.string())],
                names=["_id", "ids", "decoded"],
            )

    out = map_arrow(source, run, f"_id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("_id", id_col)


def encode_digests(df: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: the digests of
    :func:`encode_texts` without moving ids or texts out of the task."""
    source, path = _encoded(df, id_col, text_col, model_path)
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = agenda_for(path)
        decode = encoder.library.decode
        sha = hashlib.sha256
        for batch in rows_in(batches, ROWS_AT_A_TIME):
            counts, of_ids, of_text = [], [], []
            for entries in encoder.encode_batch(python_strings(batch.column(1))):
                ids = list(chain.from_iterable([e[0] for e in entries]))
                counts.append(len(ids))
                of_ids.append(sha(",".join([e[1] for e in entries]).encode()).hexdigest())
                of_text.append(sha(decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    out = map_arrow(source, run, f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("_id", id_col)

"""Packing tokenised documents into sequences by vector bin packing.

An example is a piece of a document with three demands: tokens, segments (one) and loss-bearing tokens. A sequence
is a bin with a capacity for each. Pieces are placed, large ones first within a window of documents, into the open
bin with the largest dot product of the piece's demands and the bin's room, both as shares of the capacity. If none
has room, a new bin is opened while fewer than ``open_bins`` are; beyond that the piece is cut to fill the bin with
the most room. A document longer than a sequence fills whole sequences first.

Each partition of the input packs its own pieces as they stream by, so nothing is shuffled and memory holds what a
window's documents have beyond their whole sequences, and the pieces of the open bins. Windows are counted over the
partition's rows, so nothing depends on the batches in which they come. What is left in the open bins at the end of a partition is laid
out anew, end to end, so at most one sequence of a partition is short. A task that is run again reads the same split
and packs alike.

Which sequence a piece is in, and so its id, follows from how Spark splits the input; each id is used once.

Defined cases: a null or empty text is the one end token; repeated rows are packed each for itself; a null id is
kept as null; of equal pieces the earlier one is placed first, and of bins that suit it alike it takes the
first; an empty table gives no rows; very long texts are tokenised in parts that end where no token can span;
extra columns, whatever their names, are never read. Without a loss share all tokens bear loss, so the loss limit then
is one on tokens.
"""

from __future__ import annotations

import base64
import functools
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm.common import released, small_batches, table

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
END = 1
#: Parts whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
#: White space after a space: such a space belongs to what is before it.
ODD_SPACE = re.compile(r" (?:\s|\Z)").search
#: Letters and marks that every version of the two libraries treats alike.
PLAIN = re.compile(r"[\n\x20-\x7eÀ-ÖØ-öø-ſ]+").fullmatch
#: Documents that are placed together, largest first; texts that are strings at once; bytes of ids that are given out at once.
WINDOW, TEXTS, GIVEN = 1024, 64, 1 << 20


@dataclass(frozen=True)
class Limits:
    """Capacity of a sequence."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


class Encoder(dict):
    """Token ids as little-endian unsigned 32-bit bytes.

    A token never spans the place before a single space that follows anything and precedes a character other than
    white space. Texts are split there; the dictionary remembers the ids of each part, which stands for itself with
    that space before it. Parts of plain letters are encoded from the rank file, which holds the same vocabulary and
    is faster; all others, among them those with a special token's string, by the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.by_rank = None
        if ranks and sys.byteorder == "little":
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.by_rank = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def __missing__(self, part: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        self[part] = ids = self._fresh(" " + part)
        return ids

    def _fresh(self, text: str) -> bytes:
        if self.by_rank and "<|" not in text and ((text.isascii() and text.isprintable()) or PLAIN(text)):
            return array("I", self.by_rank(text)).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        parts = text.split(" ")
        if ODD_SPACE(text):
            joined = [parts[0]]
            for p in parts[1:]:
                if p and not p[0].isspace():
                    joined.append(p)
                else:
                    joined[-1] += " " + p
            parts = joined
        return (self._fresh(parts[0]) if parts[0] else b"") + b"".join(map(self.__getitem__, parts[1:]))


@functools.lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    if path is not None:
        return Encoder(path)
    import public_tokenizers

    return Encoder(public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@dataclass
class Bin:
    number: int
    room: np.ndarray
    pieces: list = field(default_factory=list)


class Packer:
    """Places pieces one by one; a placed piece is (document, start, length, loss, bin number, offset)."""

    def __init__(self, limits: Limits, open_bins: int, first: int):
        self.cap = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.limits, self.most, self.next = limits, open_bins, first
        self.bins: list[Bin] = []
        self.room = np.zeros((open_bins, 3))

    def _open(self) -> int:
        self.bins.append(Bin(self.next, self.cap.copy()))
        self.next += 1
        self.room[len(self.bins) - 1] = self.cap
        return len(self.bins) - 1

    def _put(self, i: int, doc, start: int, need: np.ndarray) -> list:
        """The pieces of the bin, if that closed it."""
        b = self.bins[i]
        b.pieces.append((doc, start, int(need[0]), int(need[2]), b.number, int(self.cap[0] - self.room[i, 0])))
        self.room[i] -= need
        if self.room[i, 0] >= 1 and self.room[i, 1] >= 1:
            return []
        return self._close(i)

    def _close(self, i: int) -> list:
        done = self.bins[i].pieces
        last = len(self.bins) - 1
        self.bins[i] = self.bins[last]
        self.room[i] = self.room[last]
        self.bins.pop()
        return done

    def place(self, doc, start: int, tokens: int, loss: int) -> list:
        """Closed bins' pieces. ``loss`` of the tokens bear loss; a cut shares them out in proportion."""
        out = []
        while tokens:
            need = np.array([tokens, 1, loss], float)
            n = len(self.bins)
            room = self.room[:n]
            fits = (room >= need).all(axis=1)
            if fits.any():
                score = np.where(fits, (room / self.cap) @ (need / self.cap), -1)
                return out + self._put(int(score.argmax()), doc, start, need)
            if n < self.most and (need <= self.cap).all():
                return out + self._put(self._open(), doc, start, need)
            if n < self.most:
                i = self._open()
            else:
                i = int(((room / self.cap) @ (need / self.cap)).argmax())
            most = int(min(tokens, self.room[i, 0]))
            part_loss = -(-loss * most // tokens)
            while most > 1 and part_loss > self.room[i, 2]:
                most = max(1, min(most - 1, int(self.room[i, 2] * tokens // max(loss, 1))))
                part_loss = -(-loss * most // tokens)
            if part_loss > self.room[i, 2]:
                out += self._close(i)
                continue
            out += self._put(i, doc, start, np.array([most, 1, part_loss], float))
            start, tokens, loss = start + most, tokens - most, loss - part_loss
        return out

    def flush(self) -> list:
        """The pieces of the open bins, end to end in as few sequences as their limits allow."""
        pieces = [p for b in self.bins for p in b.pieces]
        self.bins, out, self.most = [], [], 1
        for doc, start, tokens, loss, *_ in sorted(pieces, key=lambda p: -p[2]):
            out += self.place(doc, start, tokens, loss)
        return out + [p for b in self.bins for p in b.pieces]


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_share_col: str | None = None,
    limits: Limits = Limits(),
    open_bins: int = 32,
    vocabulary: str | Callable[[], str] | None = None,
) -> DataFrame:
    """One row per piece: id, start, length, loss_tokens, sequence_id, offset, ids (binary), doc_tokens.

    ``loss_share_col`` holds the share of a row's tokens that bear loss (null or no column: all).
    ``vocabulary`` is the tokenizer file's place on the workers; a function is called there.
    """
    share = F.coalesce(F.col(loss_share_col).cast("double"), F.lit(1.0)) if loss_share_col else F.lit(1.0)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), share.alias("loss_share"))
    kind = dict(rows.dtypes)["id"]
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = vocabulary() if callable(vocabulary) else vocabulary
        enc = encoder(place)
        packer = Packer(limits, open_bins, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33)
        held: dict[int, list] = {}  # documents with tokens not yet placed: [id, ids, place of the first of them, tokens left, tokens in all]
        ready, tail, number, waiting, full, id_type = [], [], 0, 0, limits.tokens, None  # waiting: bytes of ids in ready

        def give(placed: list) -> None:
            nonlocal waiting
            for doc, start, n, *rest in placed:
                d = held[doc]
                at = 4 * (start - d[2])
                ready.append((d[0], start, n, *rest, d[1][at : at + 4 * n], d[4]))
                d[3] -= n
                waiting += 4 * n
                if not d[3]:
                    del held[doc]

        def place_tail() -> None:
            for doc, start, n, loss_n in sorted(tail, key=lambda x: -x[2]):
                give(packer.place(doc, start, n, loss_n))
            tail.clear()

        def emit() -> pa.RecordBatch:
            nonlocal waiting
            types = (id_type, *[pa.int64()] * 5, pa.binary(), pa.int64())
            names = ("id", "start", "length", "loss_tokens", "sequence_id", "offset", "ids", "doc_tokens")
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready, strict=True), types, strict=True)], names)
            ready.clear()
            waiting = 0
            return out

        for batch in batches:
            id_type = batch.schema.field("id").type
            for at in range(0, len(batch), TEXTS):
                part = batch.slice(at, TEXTS)
                for key, ids, loss in zip(part["id"].to_pylist(), map(enc.encode, part["text"].to_pylist()), part["loss_share"].to_pylist(), strict=True):
                    ids += END.to_bytes(4, "little")
                    n = len(ids) // 4
                    held[number] = [key, ids, 0, n, n]
                    loss_n = min(n, max(0, round(n * loss)))
                    start = 0
                    while n - start >= full and loss_n <= limits.loss_tokens * (n // full):
                        part_loss = -(-loss_n * full // (n - start))
                        if part_loss > limits.loss_tokens:
                            break
                        give([(number, start, full, part_loss, packer.next, 0)])
                        packer.next += 1
                        start, loss_n = start + full, loss_n - part_loss
                        if waiting >= GIVEN:
                            yield emit()
                    if start < n:
                        tail.append((number, start, n - start, loss_n))
                        held[number][1:3] = ids[4 * start :], start
                    number += 1
                    if number % WINDOW == 0:
                        place_tail()
                    if waiting >= GIVEN:
                        yield emit()
        place_tail()
        give(packer.flush())
        enc.clear()  # the worker lives on; what it remembers does not
        if ready:
            yield emit()

    return rows.mapInArrow(released(run), f"id {kind}, start long, length long, loss_tokens long, sequence_id long, offset long, ids binary, doc_tokens long")



def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pack(table(spark, sf_dir, "documents"))
    return p.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

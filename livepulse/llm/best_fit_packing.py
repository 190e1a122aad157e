"""Operator 8, best-fit packing: bulk-synchronous best fit.

Documents are cut into pieces of at most ``capacity`` ids and the pieces packed into
sequences. Pieces of one length are interchangeable, and so are sequences with one
gap, so a round works on *runs*: (length, first rank, pieces) and (gap, list of
sequence intervals). A round sweeps the lengths downwards; each run of pieces looks
for its successor, the smallest gap that holds it, in the sorted gaps, and when more
pieces than gaps meet there, rank decides: the k-th piece takes the k-th gap, the rest
moves on to the next gap. Pieces that find no gap open sequences. Gaps that took a
piece in a round come back smaller in the next one, and rounds repeat until no piece
is left. There are at most ``capacity`` runs of either kind and they are all the sweep
sees, whatever the number of documents; what a run decides is a rule on ranks. Spark
does the work that grows with the documents: it encodes, counts lengths, range-sorts
the pieces into ranks, and joins every piece with the rule its rank falls under.

Lengths are taken in bands, longest first (a band ends where two of its pieces could
share a fresh sequence), so that short pieces are left to close the gaps.

Defined cases: null text: the end id alone; an empty table gives an empty result;
repeated rows are packed one by one; a null ``doc_id`` is kept as null; other columns
are ignored by ``pack`` and kept by nothing.
"""

from __future__ import annotations

import bisect
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import batch_of, id_and_text, number_rows, stored

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECE + ", sequence_id long, offset long"


def pieces_of(docs: DataFrame, capacity: int, vocabulary: str | None, end_id: int) -> DataFrame:
    """Encode whole texts, append ``end_id``, cut what is longer than ``capacity``: the
    first piece takes the remainder, all others are full."""
    vocabulary = vocabulary or tokens.default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        with tokens.task_encoder(vocabulary) as enc:
            for b in batches:
                out: list[tuple] = []
                for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    ids = enc.encode(text) + end
                    n, at, k = len(ids) // 4, 0, 0
                    while at < n:
                        size = capacity if (n - at) % capacity == 0 else (n - at) % capacity
                        out.append((doc_id, k, at, size, zlib.crc32(ids[4 * at:4 * (at + size)])))
                        at, k = at + size, k + 1
                if out:
                    yield batch_of(PIECE, **dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"),
                                                     map(list, zip(*out)))))

    return id_and_text(docs).mapInArrow(cut, PIECE)


def plan_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rules (length, first rank, pieces, first sequence, offset): the pieces of that
    length with ranks first rank.. go to sequences first sequence.., at that offset."""
    rules: list[tuple[int, int, int, int, int]] = []
    rank = dict.fromkeys(counts, 0)
    left = dict(counts)
    gaps: dict[int, deque[list[int]]] = {}
    order: list[int] = []          # gaps in use, sorted; the sweep's successor search
    opened = 0

    def free(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = deque()
                bisect.insort(order, gap)
            gaps[gap].append([first, n])

    def place(length: int, gap: int, first: int, n: int, freed: list) -> None:
        rules.append((length, rank[length], n, first, capacity - gap))
        rank[length] += n
        left[length] -= n
        freed.append((gap - length, first, n))

    todo = sorted(counts, reverse=True)
    while todo:
        # a band: no two of its pieces fit into one fresh sequence beyond the first halving
        band = [x for x in todo if x > todo[0] // 2]
        todo = todo[len(band):]
        while any(left[x] for x in band):
            freed: list[tuple[int, int, int]] = []
            for length in band:                                  # one sweep, longest first
                at = bisect.bisect_left(order, length)
                while left[length] and at < len(order):
                    gap = order[at]
                    runs = gaps[gap]
                    while left[length] and runs:                 # k-th piece, k-th gap
                        n = min(left[length], runs[0][1])
                        place(length, gap, runs[0][0], n, freed)
                        runs[0][0] += n
                        runs[0][1] -= n
                        if not runs[0][1]:
                            runs.popleft()
                    if runs:
                        break
                    del gaps[gap]
                    order.pop(at)
            if not freed:                                        # no gap holds any: open sequences
                for length in band:
                    if n := left[length]:
                        # as many of this length as a sequence holds go side by side
                        side = capacity // length
                        need = -(-n // side)
                        full = need if left[length] >= need else left[length]
                        place(length, capacity, opened, full, freed)
                        opened += full
                        break
            for gap, first, n in freed:
                free(gap, first, n)
    return rules


def pack(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(pieces_of(docs, capacity, vocabulary, end_id), "pieces")
    return place_pieces(pieces, capacity)


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces``: stored rows with a ``length`` of 1 to ``capacity``; adds sequence_id and offset."""
    # at most ``capacity`` rows come back, whatever the input
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rules = plan_rounds(counts, capacity)
    ranked = number_rows(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank")
    order = sorted(range(len(rules)), key=lambda i: rules[i][:2])
    lengths, first, _, seq, offset = (np.array([rules[i][k] for i in order], np.int64) for k in range(5))
    shift = 2 ** 48 // (capacity + 1)                 # ranks below 2**48 / capacity

    def rule(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = lengths * shift + first
        for b in batches:
            rank = b.column("_rank").to_numpy()
            at = np.searchsorted(key, b.column("length").to_numpy() * shift + rank, "right") - 1
            yield batch_of(PLACED, **{c: b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
                           sequence_id=seq[at] + rank - first[at], offset=offset[at])

    return ranked.mapInArrow(rule, PLACED)

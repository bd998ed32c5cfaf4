"""Hierarchical multi-length packing.

A document's full windows stand alone; its rest goes to the smallest context
tier that holds it.  From the longest tier down, every rest opens a window of
its tier and the gap is filled with the largest rests that fit, from the same
or shorter tiers; where none fits, the smallest one is cut at the gap.  Windows
of every tier are thus full.  What is left at the end of a part of the table
(less than one window) goes into full windows of shorter tiers, and fewer ids
than the shortest tier into one padded window.

Each task packs its own part of the table as it streams by, a bounded number
of ids at a time, so nothing is shuffled and no key or source gathers in a
task; a few hundred padded ids per task are all that this costs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import slices
from freightlens.llm.tokens import encoder_for

TIERS = (2048, 1024, 512, 256)
CHUNK_TOKENS = 4_000_000
STEP_TOKENS = 16 * 2048

# Bytes of text encoded at once.
SLICE_BYTES = 2 << 20
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, context int, step_group long"

# A piece: (item number, start within the item, length).
Piece = tuple[int, int, int]


class Rests:
    """Pieces by length, with the largest length up to a bound in a few word operations."""

    def __init__(self, longest: int):
        self.stacks: list[list[Piece]] = [[] for _ in range(longest + 1)]
        self.bits = 0

    def push(self, p: Piece) -> None:
        self.stacks[p[2]].append(p)
        self.bits |= 1 << p[2]

    def pop(self, length: int) -> Piece:
        p = self.stacks[length].pop()
        if not self.stacks[length]:
            self.bits ^= 1 << length
        return p

    def at_most(self, n: int) -> int:
        """The largest length up to ``n``, 0 if there is none."""
        return max(0, (self.bits & ((1 << (n + 1)) - 1)).bit_length() - 1)

    def smallest(self) -> int:
        return max(0, (self.bits & -self.bits).bit_length() - 1)


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows ``(context, pieces)`` of items with these lengths, and the
    pieces left over: fewer ids than one window of the longest tier."""
    longest, windows, rests = tiers[0], [], Rests(tiers[0])
    for i, n in enumerate(lengths):
        for start in range(0, n - longest + 1, longest):
            windows.append((longest, [(i, start, longest)]))
        if n % longest:
            rests.push((i, n - n % longest, n % longest))
    for tier, below in zip(tiers, (*tiers[1:], 0), strict=True):
        while (n := rests.at_most(tier)) > below:
            window, gap = [rests.pop(n)], tier - n
            while gap and rests.bits:
                if n := rests.at_most(gap):
                    window.append(rests.pop(n))
                    gap -= n
                else:
                    i, start, n = rests.pop(rests.smallest())
                    window.append((i, start, gap))
                    rests.push((i, start + gap, n - gap))
                    gap = 0
            if gap:
                return windows, window
            windows.append((tier, window))
    return windows, []


def pack_tail(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """Windows for the last pieces: full ones of the shorter tiers, then one that is not full."""
    out, left = [], sum(n for _, _, n in pieces)
    for tier in tiers[1:]:
        if left >= tier:
            window, gap = [], tier
            while gap:
                i, start, n = pieces[0]
                take = min(n, gap)
                window.append((i, start, take))
                pieces = pieces[1:] if take == n else [(i, start + take, n - take), *pieces[1:]]
                gap -= take
            out.append((tier, window))
            left -= tier
    return out + ([(tiers[0], pieces)] if pieces else [])


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group number per window.  A group has windows of one context size and at
    most ``step_tokens`` ids; windows are dealt back and forth by their number
    of pieces, so that the groups of a size differ little."""
    groups, used = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        own = sorted((k for k, (t, _) in enumerate(windows) if t == tier), key=lambda k: (-len(windows[k][1]), k))
        count = -(-len(own) * tier // step_tokens)
        for place, k in enumerate(own):
            turn, at = divmod(place, count)
            groups[k] = used + (count - 1 - at if turn % 2 else at)
        used += count
    return groups


def pack(docs: DataFrame, tokenizer: str, end: int = 1, tiers: tuple[int, ...] = TIERS, by_word: bool = True,
         chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """``PIECES`` of the packed sequences of ``docs(doc_id, text)``.

    ``ids`` are little-endian unsigned 32-bit; every id of a row lies in exactly
    one piece, ``start`` counts the row's ids before it, ``offset`` the ids
    before it in its sequence.  ``context`` is the sequence's size: a padded
    sequence is padded to it.  Null texts are empty (one end id), null ids stay
    null, repeated rows are packed each by itself; an empty table gives no piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer, end, by_word)
        high = TaskContext.get().partitionId() << 33
        n_sequences = n_groups = 0
        items: list[tuple[int | None, int, int, np.ndarray]] = []  # id, ids of the document, start, ids

        def emit(windows: list[tuple[int, list[Piece]]]) -> Iterator[pa.RecordBatch]:
            nonlocal n_sequences, n_groups
            groups = step_groups(windows)
            for at in range(0, len(windows), 2000):  # bounds the size of a batch
                rows = []
                for k in range(at, min(at + 2000, len(windows))):
                    context, pieces = windows[k]
                    offset = 0
                    for i, start, n in pieces:
                        doc_id, total, base, ids = items[i]
                        rows.append((doc_id, base + start, n, ids[start:start + n].tobytes(), total, high + n_sequences + k, offset, context, high + n_groups + groups[k]))
                        offset += n
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=[c.split()[0] for c in PIECES.split(", ")])
            n_sequences += len(windows)
            n_groups += max(groups, default=-1) + 1

        held = 0
        for b in slices(batches, "text", SLICE_BYTES):
            ids, offsets = encoder.encode(b.column("text"))
            ids = ids.astype("<u4", copy=False)
            for doc_id, i, j in zip(b.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                items.append((doc_id, j - i, 0, ids[i:j]))
            held += len(ids)
            if held >= chunk_tokens:
                windows, left = pack_lengths([len(x[3]) for x in items], tiers)
                yield from emit(windows)
                items = [(items[i][0], items[i][1], items[i][2] + s, items[i][3][s:s + n].copy()) for i, s, n in left]
                held = sum(len(x[3]) for x in items)
        if items:
            windows, left = pack_lengths([len(x[3]) for x in items], tiers)
            yield from emit(windows + pack_tail(left, tiers))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)

"""Hierarchical packing of documents into training sequences of several context sizes.

A document's ids are cut into full longest windows; what remains goes to the smallest context size
that holds it. Each tier is packed into sequences of exactly its size, the longest remainders
first; a gap is filled with the longest remainder of that or a shorter tier that fits, and what is
then left of the gap with a piece cut off the shortest remainder that is long enough. So every
sequence is full but the last ones of a task, which are closed at the tiers' sizes; fewer ids than the
smallest tier per task are padded. Sequences are dealt to step groups of about equal ids, the largest
first.

A task packs the rows it reads, in their order, without a shuffle: nothing is gathered anywhere,
and a repeated task gives the same sequences. The buffer is bounded; remainders that fill no sequence
yet are carried on to the next buffer.

Each row is a document, also a repeated one. A null or empty text is a document of its end id alone.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tables import give_back, table
from .tokens import MANY, REMEMBERED, byte_bpe, encoder

TIERS = (2048, 1024, 512, 256)
BUFFER_IDS = 1 << 20
STEP_SEQUENCES = 64
#: bits of a sequence id that number the sequences of a task
TASK_BITS = 36

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, context int, step_group bigint"
)


class Remainders:
    """Pieces waiting for a sequence, ordered by length; equal lengths leave in the order they came."""

    def __init__(self) -> None:
        self.keys: list[tuple[int, int]] = []
        self.pieces: dict[int, tuple] = {}
        self.came = 0
        self.ids = 0

    def add(self, piece: tuple) -> None:
        length = piece[3]
        insort(self.keys, (length, -self.came))
        self.pieces[-self.came] = piece
        self.came += 1
        self.ids += length

    def take(self, at: int) -> tuple:
        length, key = self.keys.pop(at)
        self.ids -= length
        return self.pieces.pop(key)

    def longest_within(self, most: int) -> int:
        """Position of the longest piece of at most that length, or -1."""
        return bisect_right(self.keys, (most, 1)) - 1

    def shortest_from(self, least: int) -> int:
        return bisect_left(self.keys, (least, -self.came - 1))


def split(piece: tuple, at: int) -> tuple[tuple, tuple]:
    doc, total, start, length, ids = piece
    return (doc, total, start, at, ids[: 4 * at]), (doc, total, start + at, length - at, ids[4 * at :])


def fill(waiting: Remainders, size: int) -> list[tuple]:
    """Pieces of exactly ``size`` ids in all; the caller sees to it that there are enough."""
    taken, gap = [], size
    while gap:
        at = waiting.longest_within(gap)
        if at < 0:
            head, rest = split(waiting.take(waiting.shortest_from(gap)), gap)
            waiting.add(rest)
            taken.append(head)
            break
        taken.append(waiting.take(at))
        gap -= taken[-1][3]
    return taken


def pack_tiers(waiting: Remainders, tiers: tuple[int, ...], last: bool) -> Iterator[tuple[int, list[tuple]]]:
    """(context size, pieces) of full sequences; with ``last``, of everything.

    A tier opens a sequence for each remainder that no smaller tier holds.
    """
    for at, size in enumerate(tiers):
        below = tiers[at + 1] if at + 1 < len(tiers) else 0
        while waiting.ids >= size and (waiting.keys[-1][0] > below or (last and not below)):
            yield size, fill(waiting, size)
    if last:
        for size in tiers:
            while waiting.ids >= size:
                yield size, fill(waiting, size)
        if waiting.ids:
            yield tiers[0], [waiting.take(len(waiting.keys) - 1) for _ in list(waiting.keys)]


def step_groups(sizes: list[int], longest: int, first: int) -> list[int]:
    """A step group for each sequence, so that the groups have about equal ids."""
    groups = max(1, round(sum(sizes) / (longest * STEP_SEQUENCES)))
    heap = [(0, g) for g in range(groups)]
    given = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        load, group = heapq.heappop(heap)
        given[k] = first + group
        heapq.heappush(heap, (load + sizes[k], group))
    return given


def sequences(
    documents: Iterable[tuple], tiers: tuple[int, ...], buffer_ids: int
) -> Iterator[list[tuple[int, list[tuple]]]]:
    """Lists of finished sequences (context size, pieces). documents: (key, ids as bytes)."""
    longest, waiting, done, held = tiers[0], Remainders(), [], 0
    for doc, ids in documents:
        total = len(ids) // 4
        whole = total - total % longest
        for start in range(0, whole, longest):
            done.append((longest, [(doc, total, start, longest, ids[4 * start : 4 * (start + longest)])]))
        if total > whole:
            waiting.add((doc, total, whole, total - whole, ids[4 * whole :]))
        held += total
        if held >= buffer_ids:
            done.extend(pack_tiers(waiting, tiers, False))
            yield done
            done, held = [], 0
    done.extend(pack_tiers(waiting, tiers, True))
    if done:
        yield done


def packer(path: str, tiers: tuple[int, ...], end_id: int, with_ids: bool, remembered: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path, remembered), TaskContext.get().partitionId()
        number, group = task << TASK_BITS, task << TASK_BITS

        def documents() -> Iterator[tuple]:
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield doc, encode.ids(text.as_py()) + end

        for done in sequences(documents(), tiers, BUFFER_IDS):
            given = step_groups([sum(p[3] for p in pieces) for _, pieces in done], tiers[0], group)
            group = max(given) + 1
            columns: list[list] = [[] for _ in range(10)]
            for (context, pieces), step in zip(done, given, strict=True):
                offset = 0
                for doc, total, start, length, ids in pieces:
                    row = (doc, start, length, zlib.crc32(ids), total, number, offset, context, step, ids)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                number += 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.binary()]
            names = [field.split()[0] for field in PIECES.split(", ")] + ["ids"]
            keep = 10 if with_ids else 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns[:keep], kinds[:keep], strict=True)], names=names[:keep]
            )
        give_back()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = 1,
    with_ids: bool = True,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece of a document: where it comes from, its sequence and place there.

    tiers: context sizes, descending powers of two. with_ids: also ``ids``, little-endian unsigned
    32-bit integers. remembered: words whose ids a worker process keeps.
    """
    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(packer(tokenizer, tuple(tiers), end_id, with_ids, remembered), schema)


def op5_tiered_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids; a null text is its end id alone, repeated rows
    are packed each. A special token's spelling in a text is that token, as the tokenizer takes it."""
    return pack(table(spark, sf_dir, "documents"), byte_bpe(), with_ids=False, remembered=MANY)

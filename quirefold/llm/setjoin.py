"""Exact n-gram Jaccard join with set-relation skipping.

A document's set holds the hashes of its distinct five-word shingles (fewer words: the whole
sequence). Two sets are linked at a Jaccard similarity of at least PERCENT / 100.

1. Equal sets are one class; everything below is about classes. A set is named by 128 bits. The compressed texts
   travel by name once, so that one task has all copies of a set and goes on with one of them.
2. Every shingle's set frequency is counted. Shingles of one set link nothing; the others of a set, rarest
   first, give its prefix: two linked sets have a shingle in common that lies in both prefixes.
3. A set's home is the most frequent shingle of its prefix. The sets of a home form blocks of bounded size, by
   their sizes; so near copies share blocks, and each set lies in one.
4. The prefix entries form inverted lists, one per shingle. A list falls into parts by set size, position and the
   sets' block. A part knows its smallest set and the largest set that a partner of its entries can have (from
   size and position); two parts that rule each other out are skipped as a whole.
5. Blocks with parts that some list did not skip meet, each pair of blocks once; two sets that are linked
   meet exactly there. In a pair of blocks a set's overlaps with all sets of the other block are computed at
   once: from those of the set before it, by what the two differ in, where that is less than the set
   itself. Sets are taken in the order of their smallest hashes, which similar sets have in common.

Shingles travel in packed arrays, a row per flush of a task and part, as rows of their own would cost
several times the text. In a row a set is a number within its flush, written as its distance from the
set before: about a byte a shingle, however many parts a set falls into. Names go once, beside the
shingles. No step emits all pairs of a group: a block pair returns a spanning forest of its links and
a number of links per set. A set is sent to as many pairs of blocks as its prefix's lists leave, not
to all that they connect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import give_back, stored, table
from .wordhash import by_space, chunks, run_hash

WORDS = 5
PERCENT = 80
#: shingles that a task holds before it hands them on
FLUSH = 2_000_000
#: bytes of texts unpacked at once
UNPACKED = 8_000_000
#: names that a task remembers, to hand on one of its own copies only
REMEMBERED = 200_000
#: shingles of the classes that are counted in one part
PART_SHINGLES = 3_000_000
BLOCK_SETS = 256
BLOCK_SHINGLES = 60_000
#: width of a size band of a list's part and of a home's block
BAND = 1.25


def sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes in ascending order) of each text that has words."""
    for row, found in chunks(texts, by_space()):
        hashes, at = found.shingles(words)
        edges = np.searchsorted(at, found.first)
        for doc in range(len(found.first) - 1):
            first, last = found.first[doc], found.first[doc + 1]
            if last - first >= words:
                yield row + doc, np.unique(hashes[edges[doc] : edges[doc + 1]])
            elif last > first:
                yield row + doc, run_hash([found.hash[k : k + 1] for k in range(first, last)])


def set_key(shingles: np.ndarray) -> bytes:
    """The name of a set: equal for equal sets."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def describe(words: int):
    """Each row's other columns with the size and the name of its last one's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, "<i8")
            key: list[bytes | None] = [None] * batch.num_rows
            for row, shingles in sets(batch.column(batch.num_columns - 1), words):
                n[row], key[row] = len(shingles), set_key(shingles)
            columns = [*batch.columns[:-1], pa.array(n), pa.array(key, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n", "key"])
        give_back()

    return run


def part_of(numbers: np.ndarray, parts: int) -> np.ndarray:
    return ((numbers.view("<u8") >> np.uint64(20)) % np.uint64(parts)).astype("<i4")


NAMED = "key binary, bytes bigint, text binary"


def name_texts(words: int):
    """Name and compressed text of each text that has words; of the copies in a task, about one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, seen = pa.Codec("zstd"), set()
        for batch in batches:
            texts, out = batch.column(0), ([], [], [])
            for row, shingles in sets(texts, words):
                key = set_key(shingles)
                if key in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                text = texts[row].as_buffer()
                for column, value in zip(out, (key, text.size, codec.compress(text, asbytes=True)), strict=True):
                    column.append(value)
            columns = [pa.array(c, k) for c, k in zip(out, (pa.binary(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "bytes", "text"])
        del seen
        give_back()

    return run


def first_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows of ``NAMED`` in the order of their names: one text of each name."""
    codec, last = pa.Codec("zstd"), None
    for batch in batches:
        texts, waiting = [], 0
        for key, size, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key == last:
                continue
            last = key
            texts.append(codec.decompress(text, size, asbytes=True))
            waiting += size
            if waiting >= UNPACKED:
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).view(pa.string())], names=["text"])
                texts, waiting = [], 0
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).view(pa.string())], names=["text"])


#: A row has a flush's names and sizes, or some of its sets' shingles.
PACKED = "part int, flush binary, keys binary, sizes binary, owners binary, shingles binary"


def planes(values: np.ndarray) -> bytes:
    """All first bytes, all second bytes and so on; of small numbers most are runs of zeros."""
    return np.ascontiguousarray(values).view("u1").reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, "u1").reshape(size, -1).T).view(kind).ravel()


def steps(owner: np.ndarray) -> bytes:
    """Ascending numbers below 2^31 as their distances."""
    return planes(np.diff(owner, prepend=0).astype("<i4"))


def flush_part(flush: bytes, parts: int) -> int:
    return int(part_of(np.frombuffer(flush, "<u8"), parts)[0])


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def deal_shingles(words: int, parts: int):
    """The shingles of texts, packed for the part of the shingle. No other task may have a text of the same set.

    A flush is called by a hash of its names in order: a repeated task, given its texts in the same order, makes the same.
    """
    columns = ["part", "flush", "keys", "sizes", "owners", "shingles"]

    def flush(held: list[np.ndarray], keys: list[bytes]) -> Iterator[pa.RecordBatch]:
        called = hashlib.blake2b(b"".join(keys), digest_size=16).digest()
        sizes = np.array([len(s) for s in held], "<i4")
        yield _rows([(flush_part(called, parts), called, b"".join(keys), sizes.tobytes(), None, None)], columns)
        shingles = np.concatenate(held)
        owner = np.repeat(np.arange(len(held)), sizes)
        part = part_of(shingles, parts)
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(parts + 1))
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            own = order[bounds[k] : bounds[k + 1]]
            yield _rows([(k, called, None, None, steps(owner[own]), shingles[own].tobytes())], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, seen, waiting = [], [], set(), 0
        for batch in batches:
            for _, shingles in sets(batch.column(0), words):
                key = set_key(shingles)
                if key in seen:
                    continue
                seen.add(key)
                held.append(shingles)
                keys.append(key)
                waiting += len(shingles)
                if waiting >= FLUSH:
                    yield from flush(held, keys)
                    held, keys, seen, waiting = [], [], set(), 0
        if held:
            yield from flush(held, keys)
        del held, keys, seen
        give_back()

    return run


def deal_classes(docs: DataFrame, words: int, parts: int) -> DataFrame:
    """The shingles of each class once, packed for the part of the shingle."""
    deal = deal_shingles(words, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return deal(first_texts(batches))

    texts = docs.select("text").mapInArrow(name_texts(words), NAMED)
    return texts.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, PACKED)


def _entries(rows: pa.Table, first: dict[bytes, int] | None = None) -> tuple[list[bytes], np.ndarray, list[int], pa.Table]:
    """Flushes, the number of its set for every entry, the first number of each flush, and the rows with entries."""
    rows = rows.filter(pc.is_valid(rows.column("owners")))
    called = rows.column("flush").to_pylist()
    owners = [np.cumsum(from_planes(b, "<i4"), dtype="<i8") for b in rows.column("owners").to_pylist()]
    if first is None:
        most: dict[bytes, int] = {}
        for flush, own in zip(called, owners, strict=True):
            most[flush] = max(most.get(flush, 0), int(own[-1]) + 1)
        first = dict(zip(most, accumulate(most.values(), initial=0), strict=False))
    owner = np.concatenate([np.zeros(0, "<i8"), *(own + first[f] for f, own in zip(called, owners, strict=True))])
    return list(first), owner, list(first.values()), rows


SHARED = PACKED + ", frequency binary"


def count_frequencies(parts: int):
    """Of one part's shingles: the entries of those in two sets or more, with the number of sets,
    packed for the part of the flush. Names go through."""
    columns = ["part", "flush", "keys", "sizes", "owners", "shingles", "frequency"]

    def run(rows: pa.Table) -> pa.Table:
        told = rows.filter(pc.is_valid(rows.column("keys"))).select(columns[:-1])
        out = [(*row.values(), None) for row in told.to_pylist()]
        called, owner, first, rows = _entries(rows)
        shingles = np.frombuffer(b"".join(rows.column("shingles").to_pylist()), "<u8")
        del rows, told
        order = np.lexsort((owner, shingles))
        owner, shingles = owner[order], shingles[order]
        fresh = np.ones(len(owner), bool)  # equal flushes may have come from several tasks
        fresh[1:] = (np.diff(owner) != 0) | (np.diff(shingles.view("<i8")) != 0)
        owner, shingles = owner[fresh], shingles[fresh]
        starts = np.flatnonzero(np.diff(shingles.view("<i8"), prepend=~shingles[:1].view("<i8")))
        times = np.diff(np.append(starts, len(owner)))
        frequency = np.repeat(times, times).astype("<i8")
        shared = frequency > 1
        owner, shingles, frequency = owner[shared], shingles[shared], frequency[shared]
        order = np.argsort(owner, kind="stable")
        owner, shingles, frequency = owner[order], shingles[order], frequency[order]
        bounds = np.append(np.searchsorted(owner, first), len(owner)).tolist()
        for flush, base, a, b in zip(called, first, bounds, bounds[1:], strict=False):
            if b > a:
                held = steps(owner[a:b] - base), shingles[a:b].tobytes(), planes(frequency[a:b])
                out.append((flush_part(flush, parts), flush, None, None, *held))
        if out:
            made = pa.Table.from_batches([_rows(out, columns)])
        else:
            made = pa.table({n: pa.array([], pa.int32() if n == "part" else pa.binary()) for n in columns})
        del owner, shingles, frequency, order, out
        give_back()
        return made

    return run


LIVE = "key binary, n int, shared binary, prefix array<bigint>, place int, home bigint"


def prefix_length(n, percent: int = PERCENT):
    """Shingles of a set of n, rarest first, of which a linked set must share one."""
    return n - (percent * n + 99) // 100 + 1


def find_prefixes(percent: int):
    """Sets whose prefix has shared shingles: all shared shingles, the prefix, its first place, the home."""

    def run(rows: pa.Table) -> pa.Table:
        told = rows.filter(pc.is_valid(rows.column("keys")))
        named = {row["flush"]: (row["keys"], row["sizes"]) for row in told.to_pylist()}
        size = np.frombuffer(b"".join(sizes for _, sizes in named.values()), "<i4")
        key = np.frombuffer(b"".join(keys for keys, _ in named.values()), "V16")
        counts = (len(sizes) // 4 for _, sizes in named.values())
        _, owner, _, rows = _entries(rows, dict(zip(named, accumulate(counts, initial=0), strict=False)))
        shingles = np.frombuffer(b"".join(rows.column("shingles").to_pylist()), "<u8")
        frequency = np.concatenate([np.zeros(0, "<i8"), *(from_planes(b, "<i8") for b in rows.column("frequency").to_pylist())])
        order = np.lexsort((shingles, frequency, owner))
        owner, shingles = owner[order], shingles[order]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        stops = np.append(starts, len(owner))[1:]
        out: list[list] = [[], [], [], [], [], []]
        for first, stop in zip(starts.tolist(), stops.tolist(), strict=True):
            n = int(size[owner[first]])
            alone = n - (stop - first)  # shingles of this set only come first in the order
            most = prefix_length(n, percent) - alone
            if most > 0:
                prefix = shingles[first : min(stop, first + most)].view("<i8")
                row = key[owner[first]].tobytes(), n, np.sort(shingles[first:stop]).tobytes(), prefix, alone, prefix[-1]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.int64()
        columns = ["key", "n", "shared", "prefix", "place", "home"]
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=columns)

    return run


def size_band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(BAND)) + 1e-9)


def in_blocks(live: DataFrame) -> DataFrame:
    """``live`` with the ``block`` of each set.

    A home with more than a block holds is cut by size bands, and these by a hash. The block's number is a
    hash of home, band and slice: blocks that agree in it by chance are one.
    """
    banded = live.withColumn("band", size_band(F.col("n")))
    loads = stored(
        banded.groupBy("home", "band").agg(F.count("*").alias("sets"), F.sum("held").alias("shingles")), "home-loads"
    )
    whole = loads.groupBy("home").agg(F.sum("sets").alias("all_sets"), F.sum("shingles").alias("all_shingles"))

    def cuts(sets: str, shingles: str) -> Column:
        return F.ceil(F.greatest(F.col(sets) / BLOCK_SETS, F.col(shingles) / BLOCK_SHINGLES))

    plan = loads.join(whole, "home").select(
        "home",
        "band",
        F.when(cuts("all_sets", "all_shingles") > 1, cuts("sets", "shingles")).otherwise(F.lit(0)).alias("cuts"),
    )
    cut = F.col("cuts") > 0
    band, piece = F.when(cut, F.col("band")), F.when(cut, F.pmod(F.xxhash64("key"), F.col("cuts")))
    return banded.join(stored(plan, "home-cuts"), ["home", "band"]).select(
        *live.columns, F.xxhash64("home", F.coalesce(band, F.lit(-1)), F.coalesce(piece, F.lit(0))).alias("block")
    )


def block_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """``l, r``: the pairs of blocks with parts of a list that do not rule each other out, l <= r."""
    entries = placed.select("block", "n", "place", F.posexplode("prefix").alias("at", "shingle"))
    n, place = F.col("n").cast("double"), F.col("place") + F.col("at")
    # an overlap of at most n - place is enough for partners of up to this size
    reach = F.floor((n - place) * ((100 + percent) / percent) - n + 1e-6)
    parts = (
        entries.select(
            "shingle", "block", "n", reach.alias("reach"), size_band(n).alias("band"), F.floor(place * 10 / n).alias("where")
        )
        .groupBy("shingle", "band", "where", "block")
        .agg(F.min("n").alias("least"), F.max("reach").alias("reach"), F.count("*").alias("held"))
    )
    parts = stored(parts, "list-parts")
    inside = parts.filter("held > 1 and least <= reach").select(F.col("block").alias("l"), F.col("block").alias("r"))
    others = parts.select("shingle", *(F.col(c).alias(f"o_{c}") for c in ("band", "where", "block", "least", "reach")))
    # a partner is at most a band larger
    near = parts.withColumn("o_band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    across = near.join(others, ["shingle", "o_band"]).filter(
        "(o_band > band or struct(o_where, o_block) > struct(where, block)) and least <= o_reach and o_least <= reach"
    )
    across = across.select(F.least("block", "o_block").alias("l"), F.greatest("block", "o_block").alias("r"))
    return inside.unionAll(across).distinct()


class Overlaps:
    """Overlaps of one set after another with all sets of a block."""

    def __init__(self, block: list[np.ndarray]):
        self.known = np.unique(np.concatenate(block))
        self.has = np.zeros((len(self.known), len(block)), np.uint8)
        for k, shingles in enumerate(block):
            self.has[np.searchsorted(self.known, shingles), k] = 1
        self.last: np.ndarray | None = None
        self.counts = np.zeros(len(block), "<i8")

    def _sum(self, places: np.ndarray) -> np.ndarray:
        return self.has[places].sum(axis=0, dtype="<i8")

    def of(self, shingles: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, shingles)
        at[at == len(self.known)] = 0
        places = at[self.known[at] == shingles]
        if self.last is None:
            self.counts = self._sum(places)
        else:
            common = np.isin(places, self.last, assume_unique=True)
            gone = self.last[~np.isin(self.last, places, assume_unique=True)]
            came = places[~common]
            if len(gone) + len(came) < len(places):  # derive from the answers of the set before
                self.counts = self.counts + self._sum(came) - self._sum(gone)
            else:
                self.counts = self._sum(places)
        self.last = places
        return self.counts


def find(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def similar_order(shingles: list[np.ndarray]) -> list[int]:
    """The sets by their smallest hashes, so that similar ones follow each other."""
    return sorted(range(len(shingles)), key=lambda k: shingles[k][:4].tolist())


def verify(percent: int):
    """Of a pair of blocks: ``number, root, links``: for each set its links to sets of the other side
    (counted in documents), and the smallest class joined with it by links in here."""

    def run(rows: pa.Table) -> pa.Table:
        number, copies, n, side = (np.array(rows.column(c).to_pylist(), "<i8") for c in ("number", "copies", "n", "side"))
        shingles = [np.frombuffer(b, "<u8") for b in rows.column("shared").to_pylist()]
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        within = not len(right)
        if within:
            right = left
        left = left[similar_order([shingles[k] for k in left])]
        overlaps = Overlaps([shingles[k] for k in right])
        links = np.zeros(len(number), "<i8")
        parent = {int(r): int(r) for r in number}
        for x in left.tolist():
            both = overlaps.of(shingles[x])
            linked = right[100 * both >= percent * (n[x] + n[right] - both)]
            linked = linked[linked != x]
            links[x] += copies[linked].sum()
            if not within:
                links[linked] += copies[x]
            for y in linked.tolist():
                a, b = sorted((find(parent, int(number[x])), find(parent, int(number[y]))))
                parent[b] = a
        roots = [find(parent, int(r)) for r in number]
        return pa.table({"number": pa.array(number), "root": pa.array(roots, pa.int64()), "links": pa.array(links)})

    return run


def class_links(docs: DataFrame, own: DataFrame, words: int, percent: int) -> DataFrame:
    """``key, n, copies, rep, component, links`` of the classes of the rows ``own`` with a doc_id and
    words. rep: the smallest doc_id; links: to other classes, in documents."""
    classes = own.filter("n > 0 and doc_id is not null").groupBy("key")
    classes = classes.agg(F.max("n").alias("n"), F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("number", F.monotonically_increasing_id()), "set-classes")
    parts = -(-(classes.agg(F.sum("n")).first()[0] or 1) // PART_SHINGLES)
    live = (
        deal_classes(docs.filter("doc_id is not null"), words, parts)
        .groupBy("part")
        .applyInArrow(count_frequencies(parts), SHARED)
        .groupBy("part")
        .applyInArrow(find_prefixes(percent), LIVE)
    )
    live = stored(live, "live-sets")
    held = F.octet_length("shared") / 8
    placed = stored(in_blocks(live.select("key", "n", "prefix", "place", "home", held.alias("held"))), "placed-sets")
    pairs = stored(block_pairs(placed, percent), "block-pairs")
    pair = F.struct("l", "r").alias("pair")
    sides = pairs.select(F.col("l").alias("block"), pair, F.lit(0).alias("side")).unionAll(
        pairs.filter("l <> r").select(F.col("r").alias("block"), pair, F.lit(1).alias("side"))
    )
    met = placed.select("key", "block").join(sides, "block").join(classes.select("key", "number", "copies"), "key")
    met = stored(met.select("key", "pair", "side", "number", "copies"), "met-sets")
    found = (
        live.select("key", "n", "shared")
        .join(met, "key")
        .select("pair", "side", "number", "copies", "n", "shared")
        .groupBy("pair")
        .applyInArrow(verify(percent), "number bigint, root bigint, links bigint")
    )
    found = stored(found, "links")
    joined = components(found, "number", "root").withColumnRenamed("node", "number")
    counts = found.groupBy("number").agg(F.sum("links").alias("links"))
    return stored(
        classes.join(counts, "number", "left")
        .join(joined, "number", "left")
        .select("key", "n", "copies", "rep", F.coalesce("component", "number").alias("component"), F.coalesce("links", F.lit(0)).alias("links")),
        "class-links",
    )


def join_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of each row.

    A text without words has an empty set, linked with nothing; a row without doc_id is compared with
    nothing and has no component. Rows that repeat are copies of one another.
    """
    own = docs.select(F.col("doc_id").cast("bigint"), "text")
    own = stored(own.mapInArrow(describe(words), "doc_id bigint, n bigint, key binary"), "document-sets")
    linked = class_links(docs, own, words, percent)
    smallest = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    told = linked.join(smallest, "component").select(
        "key", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    some = own.filter("n > 0 and doc_id is not null").join(stored(told, "class-components"), "key")
    rest = own.filter("n = 0 or doc_id is null")
    return some.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links").unionAll(
        rest.select("doc_id", "n", "doc_id", F.lit(0).cast("bigint"))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: of the smallest doc_id, and of its texts one.

    Rows without doc_id or without words all stay. Texts count as they are: of rows that repeat a doc_id
    with texts of different components, one of each component stays.
    """
    digest = F.md5(F.col("text").cast("binary"))
    own = docs.select(F.col("doc_id").cast("bigint"), digest.alias("digest"), "text")
    own = stored(own.mapInArrow(describe(WORDS), "doc_id bigint, digest string, n bigint, key binary"), "document-sets")
    linked = class_links(docs, own, WORDS, PERCENT)
    rows = own.filter("n > 0 and doc_id is not null").groupBy("key", "doc_id", "digest").agg(F.count("*").alias("same"))
    heads = rows.join(linked.select("key", "component"), "key").groupBy("component")
    heads = heads.agg(F.min(F.struct("doc_id", "digest", "same")).alias("h")).select(F.col("h.doc_id").alias("id"), "h.digest", "h.same")
    heads = stored(heads, "component-heads")

    def those(chosen: DataFrame) -> DataFrame:
        return docs.join(chosen, (docs["doc_id"] == chosen["id"]) & (F.md5(docs["text"].cast("binary")) == chosen["digest"]), "left_semi")

    # a row that is repeated as it is, which is rare, is looked for among those alone
    kept = those(heads.filter("same = 1"))
    repeated = heads.filter("same > 1")
    if not repeated.isEmpty():
        kept = kept.unionAll(those(repeated).dropDuplicates(["doc_id", "text"]))
    return kept.unionAll(docs.filter(docs["doc_id"].isNull() | ~F.coalesce(docs["text"].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))))


def op2_set_relation_join(spark, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents"))

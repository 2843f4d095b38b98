"""Prefix trie of conversations, built by truncation peeling.

Conversations with the same turns are one class. The trie grows upwards, from the greatest depth to the root:
at each depth the classes that end there are merged with the nodes that survive from below; every group is a
node and is final at once; each node then loses its last turn and, as a member of its parent, goes on to the
next depth. So one pass finds the nodes and gathers their numbers. A node that a third of all
conversations pass is, at each depth, one row per task before the shuffle.

A turn enters as a digest of role and text and its number of bytes; texts are not shuffled. A prefix is named by
128 bits, the exclusive or of what its turns and their places hash to.

What a long conversation shares with no other needs no merging. Its prefixes of 8, 16, 32, ... turns are
counted over all classes; what lies below the first that no other class goes on from becomes nodes straight away.
The number of rounds is thereby at most twice the depth of the deepest prefix that two classes share.
A conversation's turns, 24 bytes each, must fit into a task; their texts need not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_dir
from .tables import stored, table

#: conversations whose ids are written together; ids are distinct, so a group is no larger
IDS = 12
#: the first depth at which a conversation may be found to be alone
ALONE = 8
NODE = ["depth", "a", "b"]
EMPTY = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as digest and UTF-8 bytes of the text.

    Null role or text: empty. Turns without number come first; turns of one number lie in the order
    of their digests, and repeated rows are repeated turns. Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turn = F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))
    held = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("bigint"), turn.alias("t"))
    own = held.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return own.withColumn("turns", F.transform("turns", lambda t: t.dropFields("turn")))


def with_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path``: for each prefix its name (a, b) and its bytes of text so far."""
    w = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    each = turns.select("conv_id", F.posexplode("turns").alias("at", "t"))
    steps = each.select(
        "conv_id",
        "at",
        F.bit_xor(F.xxhash64("at", "t.digest")).over(w).alias("a"),
        F.bit_xor(F.xxhash64("t.digest", "at", F.lit("b"))).over(w).alias("b"),
        F.sum("t.bytes").over(w).alias("bytes"),
    )
    step = F.struct("at", "a", "b", "bytes")
    paths = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("path"))
    paths = paths.withColumn("path", F.transform("path", lambda s: s.dropFields("at")))
    none = F.expr("cast(array() as array<struct<a: bigint, b: bigint, bytes: bigint>>)")
    return paths.unionAll(turns.filter(F.size("turns") == 0).select("conv_id", none))


def prefix_name(path: Column, depth: Column, name: str) -> Column:
    """a or b of the prefix of so many turns; the empty prefix has 0."""
    return F.when(depth > 0, F.get(path, depth - 1)[name]).otherwise(F.lit(0).cast("bigint"))


def bytes_up_to(path: Column, depth: Column) -> Column:
    return F.when(depth > 0, F.get(path, depth - 1)["bytes"]).otherwise(F.lit(0).cast("bigint"))


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each class's ids, comma-joined; its chunks come in order, none is kept."""
    last, running = None, None
    for batch in batches:
        done = []
        for *name, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name != last:
                if last:
                    done.append((*last, running.hexdigest()))
                last, running = name, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.encode())
        if done:
            yield _digests(done)
    if last:
        yield _digests([(*last, running.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.int64(), pa.string()
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends"])


def named(path: str = "path") -> list[Column]:
    depth = F.size(path)
    return [
        depth.cast("bigint").alias("depth"),
        prefix_name(F.col(path), depth, "a").alias("a"),
        prefix_name(F.col(path), depth, "b").alias("b"),
    ]


def alone_from(classes: DataFrame) -> DataFrame:
    """``depth, a, b, cut`` of the classes longer than ALONE turns that are alone beyond a prefix of ``cut``
    turns, the least of ALONE, 2 ALONE, 4 ALONE, ..."""
    depth = F.size("path")
    doubling = F.array(*(F.lit(ALONE << k) for k in range(31 - ALONE.bit_length())))
    cuts = F.filter(doubling, lambda c: c < depth)
    probes = classes.filter(depth > ALONE).select(*named(), F.explode(cuts).alias("cut"), "path")
    path, cut = F.col("path"), F.col("cut")
    probes = probes.select(*NODE, "cut", prefix_name(path, cut, "a").alias("pa"), prefix_name(path, cut, "b").alias("pb"))
    single = probes.groupBy("cut", "pa", "pb").agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in NODE))
    return single.filter("n = 1").groupBy(*NODE).agg(F.min("cut").alias("cut"))


def grow(classes: DataFrame, folder: str) -> list[str]:
    """Write the nodes of all classes (``path, conv_id, n_convs``); the paths of the tables written."""
    spark = classes.sparkSession
    cut = stored(alone_from(classes), "alone")
    joined = classes.select("path", "conv_id", "n_convs", *named()).join(cut, NODE, "left")
    joined = stored(joined, "classes")
    path, depth, cut = F.col("path"), F.col("depth").cast("int"), F.coalesce(F.col("cut"), F.col("depth").cast("int"))
    at = F.col("at")
    tail = joined.filter("cut is not null").select(
        "path", "conv_id", "n_convs", F.col("depth").alias("most"), F.explode(F.sequence(cut + 1, depth)).alias("at")
    )
    written = [f"{folder}/alone"]
    below = (F.col("n_convs") - 1) * (bytes_up_to(path, F.col("most").cast("int")) - bytes_up_to(path, at - 1))
    tail.select(
        at.cast("bigint").alias("depth"),
        *(prefix_name(path, at, c).alias(c) for c in ("a", "b")),
        *(prefix_name(path, at - 1, c).alias(f"parent_{c}") for c in ("a", "b")),
        "conv_id",
        "n_convs",
        F.when(at < F.col("most"), 1).otherwise(0).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        below.alias("saved_tokens"),
    ).write.parquet(written[0])
    cut_off = F.col("cut").isNotNull()
    entering = joined.select(
        cut.alias("depth"),
        F.when(cut > 0, F.slice(path, F.lit(1), F.greatest(cut, F.lit(1)))).otherwise(path).alias("path"),
        "conv_id",
        "n_convs",
        cut_off.cast("bigint").alias("children"),
        cut_off.cast("bigint").alias("leaves"),
        F.when(cut_off, (F.col("n_convs") - 1) * (bytes_up_to(path, depth) - bytes_up_to(path, cut)))
        .otherwise(0)
        .alias("saved"),
    )
    entering.write.partitionBy("depth").parquet(f"{folder}/entering")
    members = ["path", "conv_id", "n_convs", "children", "leaves", "saved"]
    entered = spark.read.schema(entering.schema).parquet(f"{folder}/entering")
    depths = {r.depth for r in entered.select("depth").distinct().collect()}  # a number for each length
    survivors = None
    for d in range(max(depths, default=-1), -1, -1):
        sources = [entered.filter(F.col("depth") == d).select(members)] if d in depths else []
        if survivors is not None:
            sources.append(survivors)
        nodes = reduce(DataFrame.unionAll, sources).groupBy("path").agg(
            F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in members[2:])
        )
        path, depth = F.col("path"), F.size("path")
        saved = F.col("saved") + (F.col("n_convs") - 1) * (bytes_up_to(path, depth) - bytes_up_to(path, depth - 1))
        parent = F.when(depth > 0, F.slice(path, F.lit(1), F.greatest(depth - 1, F.lit(0))))
        written.append(f"{folder}/nodes-{d}")
        nodes.select(
            *named(),
            prefix_name(path, depth - 1, "a").alias("parent_a"),
            prefix_name(path, depth - 1, "b").alias("parent_b"),
            "conv_id",
            "n_convs",
            F.col("children").alias("n_children"),
            F.greatest("leaves", F.lit(1)).alias("n_leaves"),
            saved.alias("saved_tokens"),
            parent.alias("parent_path"),
        ).write.parquet(written[-1])
        survivors = spark.read.parquet(written[-1]).select(
            F.col("parent_path").alias("path"),
            "conv_id",
            "n_convs",
            F.lit(1).cast("bigint").alias("children"),
            F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("saved"),
        )
    return written


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations given as ``conv_id, turns`` (distinct ids, see ``turns_of``).

    Per node: ``conv_id`` (its smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens`` and ``ends_sha256``. No conversations: no nodes, not even a root. Conversations
    without turns end at the root.
    """
    spark = turns.sparkSession
    paths = stored(with_paths(turns), "paths")
    chunks = paths.groupBy("path", F.shiftright("conv_id", IDS).alias("chunk")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids")
    )
    chunks = stored(chunks, "members")
    classes = chunks.groupBy("path").agg(
        F.min(F.element_at("ids", 1)).alias("conv_id"), F.sum(F.size("ids")).cast("bigint").alias("n_convs")
    )
    classes = stored(classes, "path-classes")
    joined = chunks.select(*named(), "chunk", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    in_order = joined.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
    ends = stored(in_order.mapInArrow(digests, "depth bigint, a bigint, b bigint, ends string"), "ends")
    written = grow(classes, new_run_dir(spark, "trie"))
    columns = [*NODE, "parent_a", "parent_b", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = reduce(DataFrame.unionAll, (spark.read.parquet(p).select(columns) for p in written))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("parent_a"),
        F.col("b").alias("parent_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    inner = nodes.filter("depth > 0").join(parents, ["depth", "parent_a", "parent_b"])
    told = [*columns, "parent_conv_id"]
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    return (
        inner.select(told)
        .unionAll(root.select(told))
        .join(ends, NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )


def with_borrowed_heads(turns: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 5, if there is one, and its own
    turns from the h-th on; h: the CRC-32 of c in decimal, modulo 9."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % 9).cast("int")
    heads = turns.filter(c % 5 == 0).select(c.alias("base"), F.slice("turns", 1, 8).alias("head"))
    own = turns.withColumns({"base": c - c % 5, "h": h})
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    none = F.slice("turns", 1, 0)
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), none)
    return own.join(heads, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def op11_truncation_peeling(spark, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations. Ties and nulls as in ``turns_of``; an empty table: no rows."""
    turns = stored(turns_of(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie(with_borrowed_heads(turns))


#: CRC-32 of a text of ASCII characters, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1),
    lambda i: ascii(substr(s, i, 1))::BIGINT)), lambda r, x: list_reduce(list_prepend(xor(r, x), range(8)),
    lambda v, j: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

OP11_SQL = f"""
WITH own AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (SELECT c, {_CRC} % 9 AS h FROM (SELECT DISTINCT c, c::VARCHAR AS s FROM own)
), rebuilt AS (
    SELECT ids.c, pos, role, text FROM ids JOIN own ON own.c = ids.c - ids.c % 5 AND pos <= h
    UNION ALL SELECT ids.c, pos + 1000000, role, text FROM ids JOIN own ON own.c = ids.c AND pos > h
), turns AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, strlen(text) AS bytes,
        md5(length(role) || ':' || role || text) AS t FROM rebuilt
), prefixes AS (
    SELECT c, d, bytes, string_agg(t, '') OVER (PARTITION BY c ORDER BY d) AS p,
        lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS is_end FROM turns
    UNION ALL SELECT c, 0, 0, '', c NOT IN (SELECT c FROM turns) FROM ids
), nodes AS (
    SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '') AS ends
    FROM prefixes GROUP BY d, p
), linked AS (SELECT *, left(p, 32 * (d - 1)::INT) AS above_p, d - 1 AS d_above FROM nodes
), children AS (SELECT d_above AS d, above_p AS p, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL
), full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (d, p)
), sums AS (
    SELECT a.d, a.p, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved
    FROM full_nodes b, unnest(range(0, b.d + 1)) AS u(k) JOIN full_nodes a ON a.d = k AND a.p = left(b.p, 32 * k::INT)
    GROUP BY a.d, a.p
)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children,
    s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN sums s USING (d, p)
LEFT JOIN nodes up ON f.d > 0 AND up.d = f.d - 1 AND up.p = left(f.p, 32 * (f.d - 1)::INT)
"""

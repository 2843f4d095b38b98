"""Token-id files: a concatenated id array with Elias-Fano document boundaries.

A file holds documents in ascending doc_id order:

    ids         each in 2 or 4 bytes, little-endian
    ends        Elias-Fano: for each document, the ids up to its end
    keys        Elias-Fano: doc_id less the smallest doc_id of the file
    footer      offsets of the sections, counts, smallest doc_id, id width, magic

Nothing is as wide as 64 bits per document. The files of a table follow each other; the manifest
(a table with one row per file) gives their order and counts.

Documents are dealt to the files by ranges of doc_id, and each task streams one file: it holds one
batch of texts and eight bytes a document. A null doc_id comes first; a null text is empty; repeated
rows are documents of their own, in the order of their texts' checksums. An empty table has no files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_dir
from .eliasfano import EliasFano
from .files import new_file, opened
from .tables import stored, table, tasks
from .tokens import MANY, byte_bpe, encoder

FOOTER = struct.Struct("<QQQQQqI8s")
MAGIC = b"QFTOKID1"
MANIFEST = "file string, place bigint, n_docs bigint, n_ids bigint"
INDEX = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
READ_DOCS = 2048


def footer(ids: int, ends: int, keys: int, docs: int, nulls: int, least: int, width: int) -> bytes:
    return FOOTER.pack(ids, ends, keys, docs, nulls, least, width, MAGIC)


def file_writer(folder: str, path: str, end_id: int, width: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, lengths, keys, nulls = encoder(path, MANY), [], [], 0
        if max(encode.tokenizer.get_vocab_size(), end_id + 1) > 1 << (8 * width):
            raise ValueError(f"ids do not fit into {width} bytes")
        file = None
        with new_file(folder, ".ids") as (name, out):
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.frombuffer(encode.ids(text.as_py()) + end, "<u4")
                    out.write(ids.astype(f"<u{width}").tobytes())
                    lengths.append(len(ids))
                    if doc is None:
                        nulls += 1
                    else:
                        keys.append(doc)
            if lengths:
                file = name
                ends = EliasFano.encode(np.cumsum(np.array(lengths, "<u8"))).to_bytes()
                least = keys[0] if keys else 0
                given = EliasFano.encode(np.array([k - least for k in keys], "<u8")).to_bytes()
                total = sum(lengths)
                out.write(ends + given)
                out.write(footer(total * width, len(ends), len(given), len(lengths), nulls, least, width))
        if file:
            row = [file], [TaskContext.get().partitionId()], [len(lengths)], [total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.string()), *(pa.array(v, pa.int64()) for v in row[1:])],
                names=["file", "place", "n_docs", "n_ids"],
            )

    return run


class TokenFile:
    """One file, open for reading: documents by position."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        id_bytes, ends, keys, self.n_docs, self.nulls, self.least, self.width, magic = FOOTER.unpack(
            file.read_at(FOOTER.size, size - FOOTER.size)
        )
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        self.ends = EliasFano.from_bytes(file.read_at(ends, id_bytes))
        self.keys = EliasFano.from_bytes(file.read_at(keys, id_bytes + ends))

    def span(self, at: int) -> tuple[int, int]:
        return (self.ends.select(at - 1) if at else 0), self.ends.select(at)

    def doc_id(self, at: int) -> int | None:
        return None if at < self.nulls else self.least + self.keys.select(at - self.nulls)

    def ids(self, start: int, stop: int) -> np.ndarray:
        data = self.file.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")


def read_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each file (path, ids before it): a row per document."""
    for batch in batches:
        for path, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with opened(path) as raw:
                file = TokenFile(raw)
                keys = [None] * file.nulls + [file.least + int(k) for k in file.keys.decode()]
                for first in range(0, file.n_docs, READ_DOCS):
                    stop = min(first + READ_DOCS, file.n_docs)
                    edges = [file.span(first)[0], *(file.ends.select(at) for at in range(first, stop))]
                    ids = file.ids(edges[0], edges[-1]).tobytes()
                    sums = [
                        zlib.crc32(memoryview(ids)[4 * (a - edges[0]) : 4 * (b - edges[0])])
                        for a, b in zip(edges, edges[1:], strict=False)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[first:stop], pa.int64()),
                            pa.array([before + a for a in edges[:-1]], pa.int64()),
                            pa.array(np.diff(edges), pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, width: int = 2) -> DataFrame:
    """Encode and write all documents; the manifest, with ``before``: the ids in earlier files.

    width: bytes per id; 2 for vocabularies up to 65,536.
    """
    key = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary"))]
    files = max(tasks(docs.sparkSession), docs.rdd.getNumPartitions())  # an input split is bounded
    dealt = docs.select("doc_id", "text").repartitionByRange(files, *key).sortWithinPartitions(*key)
    manifest = stored(dealt.mapInArrow(file_writer(folder, tokenizer, end_id, width), MANIFEST), "token-manifest")
    earlier = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """A row per document, from the files."""
    files = manifest.select("file", "before")
    files = files.repartition(max(tasks(manifest.sparkSession), files.count()), "file")
    return files.mapInArrow(read_index, INDEX)


def op3_elias_fano_ids(spark, sf_dir: str) -> DataFrame:
    """The index of all documents, read from the files; a null text is its end id alone, repeated rows follow
    each other, rows without doc_id come first. A special token's spelling in a text is that token."""
    folder = new_run_dir(spark, "token-files")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), folder, byte_bpe()))

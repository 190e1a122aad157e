"""Operator 3, token-id output: concatenated ids with Elias-Fano document boundaries.

A data set is a folder of shards in ascending ``doc_id`` order. A shard is two files:
``.ids``, all ids as little-endian unsigned integers of 2 or 4 bytes, and ``.idx``,
which holds two Elias-Fano sequences: the end of each document (a non-decreasing
sequence bounded by the id count) and the ``doc_id`` of each document. A sequence of
n values below u takes about n * (2 + log2(u / n)) bits; a select directory with one
32-bit count per 4096 bits of the upper half finds any value without a 64-bit table.

Writing: texts are range-sorted by doc_id, and each task encodes and appends its
range, document by document. A task names its files with a fresh token and returns one
manifest row per shard; only files in the manifest (written by Spark's commit)
count, so a repeated or lost task leaves at most an orphan. Paths may be any that
pyarrow's file systems open; on a cluster the folder must be shared.

Defined cases: null text: no ids but the end id; null ``doc_id``: such rows come
first and read back as null; repeated ids: all rows are written, ordered by a hash of
the text; an empty table gives a data set without shards; other columns are ignored.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from livepulse.session import scratch_dir

from . import tokens
from .common import batch_of, id_and_text, stored

MAGIC = b"LPTOKEN1"
HEAD = struct.Struct("<8sIIQQQq")     # magic, bytes per id, 0, documents, ids, null doc_ids, least doc_id
EF_HEAD = struct.Struct("<IIQQQ")     # low bits, directory length, values, bytes of low part, bytes of high part
BLOCK_BITS = 4096


class EliasFano:
    """Non-decreasing unsigned values: low bits packed, high parts in unary."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.bits, self.low, self.high, self.directory = n, bits, low, high, directory

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(1, np.uint32))
        bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        plain = np.zeros((n, bits), np.uint8)
        for b in range(bits):
            plain[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        low = np.packbits(plain.ravel(), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        length = -(-(int(ones[-1]) + 1) // BLOCK_BITS) * BLOCK_BITS
        marks = np.zeros(length, np.uint8)
        marks[ones] = 1
        directory = np.concatenate([[0], np.cumsum(marks.reshape(-1, BLOCK_BITS).sum(1, dtype=np.int64))])
        return cls(n, bits, low, np.packbits(marks, bitorder="little"), directory.astype(np.uint32))

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for b in range(self.bits):
            at = i * self.bits + b
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """Value i: the directory names the block of the i-th one, a scan of that block finds it."""
        block = int(np.searchsorted(self.directory, i, "right")) - 1
        part = self.high[block * BLOCK_BITS // 8:(block + 1) * BLOCK_BITS // 8]
        at = np.flatnonzero(np.unpackbits(part, bitorder="little"))[i - int(self.directory[block])]
        upper = block * BLOCK_BITS + int(at) - i
        return upper << self.bits | int(self._low(np.array([i]))[0])

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        i = np.arange(self.n)
        return (ones - i).astype(np.uint64) << np.uint64(self.bits) | self._low(i)

    def dump(self) -> bytes:
        return EF_HEAD.pack(self.bits, len(self.directory), self.n, len(self.low), len(self.high)) + \
            self.directory.astype("<u4").tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def load(cls, data: memoryview) -> tuple[EliasFano, memoryview]:
        bits, blocks, n, low, high = EF_HEAD.unpack_from(data)
        at = EF_HEAD.size
        parts = []
        for size, kind in ((4 * blocks, "<u4"), (low, np.uint8), (high, np.uint8)):
            parts.append(np.frombuffer(data[at:at + size], kind))
            at += size
        return cls(n, bits, parts[1], parts[2], parts[0]), data[at:]


def _open_folder(uri: str):
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    return system, path


class _Shard:
    """A shard being written; ids go to the file, doc_ids and ends (8 bytes each) wait for the index."""

    def __init__(self, folder: str, width: int):
        self.system, path = _open_folder(folder)
        self.system.create_dir(path, recursive=True)
        self.name = f"shard-{uuid.uuid4().hex}"
        self.base, self.width = f"{path}/{self.name}", width
        self.out = self.system.open_output_stream(f"{self.base}.ids", buffer_size=1 << 20)
        self.doc_ids, self.ends = array("q"), array("q")     # known doc_ids; null ones come first
        self.n_ids = self.nulls = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.n_ids += len(ids)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)
        self.ends.append(self.n_ids)

    def close(self) -> None:
        self.out.close()
        known = np.array(self.doc_ids, np.int64).view(np.uint64)
        least = self.doc_ids[0] if self.doc_ids else 0
        docs = EliasFano.build(known - np.uint64(least % (1 << 64)))     # modulo 2**64: exact for any two longs
        head = HEAD.pack(MAGIC, self.width, 0, len(self.ends), self.n_ids, self.nulls, least)
        with self.system.open_output_stream(f"{self.base}.idx") as f:
            f.write(head + EliasFano.build(np.array(self.ends, np.uint64)).dump() + docs.dump())


class ShardReader:
    """Random access to one shard: document(i) is its doc_id and ids."""

    def __init__(self, folder: str, name: str):
        self.system, path = _open_folder(folder)
        self.base = f"{path}/{name}"
        with self.system.open_input_file(f"{self.base}.idx") as f:
            data = memoryview(f.read())
        magic, self.width, _, self.n_docs, self.n_ids, self.nulls, self.least = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError(f"{self.base}.idx is not a token index")
        self.ends, rest = EliasFano.load(data[HEAD.size:])
        self.doc_ids, _ = EliasFano.load(rest)

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def read(self, lo: int, hi: int) -> np.ndarray:
        with self.system.open_input_file(f"{self.base}.ids") as f:
            return np.frombuffer(f.read_at((hi - lo) * self.width, lo * self.width), f"<u{self.width}")

    def document(self, i: int) -> tuple[int | None, np.ndarray]:
        doc_id = None if i < self.nulls else self.least + self.doc_ids.select(i - self.nulls)
        return doc_id, self.read(*self.span(i))

    def documents(self, most: int = 1 << 22) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of every document, about ``most`` ids read at once."""
        ends = self.ends.values().astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        ids = [None] * self.nulls + [self.least + int(v) for v in self.doc_ids.values()]
        lo = 0
        while lo < self.n_docs:
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + most, "right")))
            part = self.read(int(starts[lo]), int(ends[hi - 1]))
            for i in range(lo, hi):
                yield ids[i], int(starts[i]), part[starts[i] - starts[lo]:ends[i] - starts[lo]]
            lo = hi


MANIFEST = "part int, sub int, shard string, n_docs long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 2,
                      shard_ids: int = 1 << 28, shard_docs: int = 1 << 20) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the data set to ``folder``, in shards of
    about ``shard_ids`` ids and at most ``shard_docs`` documents (what a task holds of a shard's index).
    Returns the manifest: shard, n_docs, n_ids and first_id, the ids of all shards before."""
    vocabulary = vocabulary or tokens.default_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, done, shard = TaskContext.get().partitionId(), [], None
        width = 2 if max(tokens.encoder(vocabulary).vocab, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()

        def finish(s: _Shard) -> None:
            s.close()
            done.append((part, len(done), s.name, len(s.ends), s.n_ids))

        with tokens.task_encoder(vocabulary) as enc:
            for b in batches:
                for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    if shard is not None and (shard.n_ids >= shard_ids or len(shard.ends) >= shard_docs):
                        finish(shard)
                        shard = None
                    shard = shard or _Shard(folder, width)
                    shard.add(doc_id, np.frombuffer(enc.encode(text) + end, "<u4"))
        if shard is not None:
            finish(shard)
        if done:
            yield batch_of(MANIFEST, **dict(zip(("part", "sub", "shard", "n_docs", "n_ids"), map(list, zip(*done)))))

    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = id_and_text(docs).repartitionByRange(*keys).sortWithinPartitions(*keys)
    manifest = stored(rows.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("part", "sub").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, first in zip(b.column("shard").to_pylist(), b.column("first_id").to_pylist()):
                found = ShardReader(folder, name).documents()
                while got := [(d, first + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                              for d, s, ids in itertools.islice(found, 4096)]:
                    yield batch_of(READ, **dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), map(list, zip(*got)))))

    width = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("shard", "first_id").repartition(width).mapInArrow(read, READ)


def token_file_index(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None,
                     end_id: int = 2) -> DataFrame:
    """Write the data set, read it back."""
    spark: SparkSession = docs.sparkSession
    folder = folder or scratch_dir(spark, "llm", "token-files")
    return read_token_files(write_token_files(docs, folder, vocabulary, end_id), folder)

"""Token-id files of independent zstandard frames with a trailing seek table.

Layout of a file, all numbers little-endian:

* one zstandard frame per document: its ids as uint32,
* a skippable frame (magic 0x184D2A50) with the documents' ids, compressed: int64 each, then a byte each (1: null),
* the seek table of the public seekable format: a skippable frame (magic 0x184D2A5E) with an entry per frame
  (compressed size, plain size, lower 32 bits of the XXH64 of the plain bytes; uint32 each; the last entry is the
  skippable frame above, with plain size 0), then the number of entries (uint32), a descriptor byte (0x80: with
  checksums) and the magic 0x8F92EAB1.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import new_folder, table, written
from llm.files import create, reading
from llm.registry import query
from llm.tokens import END, default_vocabulary, encoder, texts_of

SKIP, SEEK, TABLE = 0x184D2A50, 0x8F92EAB1, 0x184D2A5E
MANIFEST = "part int, file string, documents bigint, tokens bigint"
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])


class FrameWriter:
    """Writes documents one after the other; holds one document and 20 bytes for each one written."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=3)
        self.entries, self.ids, self.tokens = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.stream.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += len(ids) // 4

    def close(self) -> None:
        keys = np.array([x or 0 for x in self.ids], "<i8").tobytes() + bytes(x is None for x in self.ids)
        packed = self.packer.compress(keys)
        self.stream.write(struct.pack("<II", SKIP, len(packed)) + packed)
        entries = np.array([*self.entries, (len(packed) + 8, 0, 0)], ENTRY)
        self.stream.write(struct.pack("<II", TABLE, 12 * len(entries) + 9) + entries.tobytes())
        self.stream.write(struct.pack("<IBI", len(entries), 0x80, SEEK))


class FrameReader:
    """Reads the seek table of a file once, then any document by its place alone."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.unpacker = stream, zstandard.ZstdDecompressor()
        end = stream.seek(0, 2) or stream.tell()
        stream.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEK or flags != 0x80:
            raise ValueError("no seek table with checksums")
        stream.seek(end - 9 - 12 * n)
        entries = np.frombuffer(stream.read(12 * n), ENTRY)
        starts = np.concatenate([[0], np.cumsum(entries["packed"], dtype=np.int64)])
        stream.seek(int(starts[-2]) + 8)
        keys = self.unpacker.decompress(stream.read(int(entries["packed"][-1]) - 8))
        self.entries, self.starts = entries[:-1], starts
        count = len(self.entries)
        self.doc_ids = np.frombuffer(keys, "<i8", count)
        self.no_id = np.frombuffer(keys, bool, count, 8 * count)

    def __len__(self) -> int:
        return len(self.entries)

    def ids(self, place: int) -> np.ndarray:
        """The token ids of one document; no other frame is read."""
        size, plain, check = self.entries[place].tolist()
        self.stream.seek(int(self.starts[place]))
        data = self.unpacker.decompress(self.stream.read(size), max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {place} does not match its checksum")
        return np.frombuffer(data, "<u4")

    def find(self, doc_id: int) -> list[int]:
        """Places of a document id; the ids ascend, nulls first."""
        nulls = int(self.no_id.sum())
        low, high = (nulls + np.searchsorted(self.doc_ids[nulls:], doc_id, side) for side in ("left", "right"))
        return list(range(low, high))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Encodes whole texts and writes their ids in ascending order of doc_id, a file for each task.

    Returns the manifest: part (files in order of doc_id), file, documents, tokens. Every document ends with id 0. A
    null or empty text is that id alone. Null doc_ids come first; rows with equal doc_ids all stay. An empty table
    gives no files. Columns besides doc_id and text are not read.
    """
    path = vocabulary or default_vocabulary()

    def write(batches):
        own = encoder(path)
        held, out = None, None
        try:
            for batch in batches:
                if out is None:
                    held = create(folder, ".tok.zst")
                    name, stream = held.__enter__()
                    out = FrameWriter(stream)
                for doc_id, ids in own.encode_rows(texts_of(batch)):
                    out.add(doc_id, ids + END)
            if out is not None:
                out.close()
        finally:
            if held is not None:
                held.__exit__(None, None, None)
        if out is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), pa.array([len(out.ids)]), pa.array([out.tokens])],
                ["part", "file", "documents", "tokens"],
            )

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return written(ordered.mapInArrow(write, MANIFEST), "token-files")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids as bytes) of every document, from the files alone.

    The only ordered step runs over the manifest, a row for each file.
    """
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("base", F.coalesce(before, F.lit(0))).select("file", "base")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def read(rows):
        for batch in rows:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with reading(name) as stream:
                    own = FrameReader(stream)
                    for at in range(0, len(own), 2048):
                        places = range(at, min(at + 2048, len(own)))
                        ids = [own.ids(p).tobytes() for p in places]
                        n = np.array([len(x) // 4 for x in ids], np.int64)
                        start = base + np.cumsum(n) - n
                        base += int(n.sum())
                        columns = [
                            pa.array(own.doc_ids[at : at + 2048], pa.int64(), mask=own.no_id[at : at + 2048]),
                            pa.array(start), pa.array(n), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        ] + ([pa.array(ids, pa.binary())] if with_ids else [])
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    return files.repartition(max(1, manifest.count())).mapInArrow(read, schema)


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, new_folder(spark, "tokens")))

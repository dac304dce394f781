"""Token ids of a corpus as binary files, in ascending ``doc_id`` order.

Each range of documents is two files: ``.ids`` holds the ids of its documents one after the
other as little-endian unsigned integers of two bytes (four, where the vocabulary needs
it); ``.ef`` holds, in Elias-Fano code, where each document ends and what its ``doc_id`` is.
A Parquet table, the manifest, lists the ranges in order with their numbers of documents
and ids.  Files are named anew by every attempt of a task and only those of the attempt
that ended well are in the manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.elias_fano import EliasFano
from loyalpulse.llm.elias_fano import encode as elias_fano
from loyalpulse.llm.encode import encoded
from loyalpulse.llm.store import stored

#: Version, bytes an id, documents without doc_id (they come first), smallest doc_id.
_INDEX_HEAD = struct.Struct("<4sBBxxQq")
_MAGIC = b"TKN1"
_MANIFEST = "part int, name string, id_bytes int, documents bigint, ids bigint"


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _index(ends: list[int], doc_ids: list[int | None], id_bytes: int) -> bytes:
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    head = _INDEX_HEAD.pack(_MAGIC, 1, id_bytes, len(doc_ids) - len(known), least)
    above = known.astype(np.uint64) - np.uint64(least % 2**64)
    return head + elias_fano(np.array(ends, dtype=np.uint64)) + elias_fano(above)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_bytes: int = 2
) -> DataFrame:
    """Writes the files and returns their manifest, already computed.

    A null text counts as empty.  Rows without ``doc_id`` come first; rows of one
    ``doc_id`` follow each other in the order of their texts' hashes.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
    )
    # the range of a hot id is split by the hash of its texts
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        files, root = _file_system(folder)
        kind = np.dtype(f"<u{id_bytes}")
        limit = np.iinfo(kind).max
        ends, doc_ids, total = [], [], 0
        end = np.array([end_id], dtype=np.uint32)
        with files.open_output_stream(f"{root}/{name}.ids", compression=None) as out:
            for batch in batches:
                doc_ids += batch.column("doc_id").to_pylist()
                for ids in encoded(batch.column("text"), tokenizer):
                    ids = np.concatenate([ids, end])
                    if ids.max() > limit:
                        raise ValueError(f"id {ids.max()} needs more than {id_bytes} bytes")
                    out.write(ids.astype(kind).tobytes())
                    total += len(ids)
                    ends.append(total)
        if not ends:
            files.delete_file(f"{root}/{name}.ids")
            return
        with files.open_output_stream(f"{root}/{name}.ef", compression=None) as out:
            out.write(_index(ends, doc_ids, id_bytes))
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "part": part,
                    "name": name,
                    "id_bytes": id_bytes,
                    "documents": len(ends),
                    "ids": total,
                }
            ],
            schema=pa.schema(
                [
                    ("part", pa.int32()),
                    ("name", pa.string()),
                    ("id_bytes", pa.int32()),
                    ("documents", pa.int64()),
                    ("ids", pa.int64()),
                ]
            ),
        )

    files, root = _file_system(folder)
    files.create_dir(root, recursive=True)
    return stored(ordered.select("doc_id", "text").mapInArrow(write, _MANIFEST))


class TokenFile:
    """One range of documents, read at any place."""

    def __init__(self, folder: str, name: str) -> None:
        files, root = _file_system(folder)
        with files.open_input_stream(f"{root}/{name}.ef", compression=None) as source:
            index = source.read()
        magic, _, self._id_bytes, self._unnamed, self._least = _INDEX_HEAD.unpack_from(index)
        if magic != _MAGIC:
            raise ValueError(f"{name}.ef is no token index")
        self.ends = EliasFano(index, _INDEX_HEAD.size)
        self._doc_ids = EliasFano(index, self.ends.end)
        self._data = files.open_input_file(f"{root}/{name}.ids")

    def __len__(self) -> int:
        return len(self.ends)

    def doc_ids(self) -> list[int | None]:
        known = self._doc_ids.all() + np.uint64(self._least % 2**64)
        return [None] * self._unnamed + known.astype(np.int64).tolist()

    def document(self, i: int) -> np.ndarray:
        """The ids of the ``i``-th document."""
        first = self.ends[i - 1] if i else 0
        return self.between(first, self.ends[i])

    def between(self, first: int, end: int) -> np.ndarray:
        data = self._data.read_at((end - first) * self._id_bytes, first * self._id_bytes)
        return np.frombuffer(data, dtype=f"<u{self._id_bytes}").astype("<u4")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files."""
    spark = manifest.sparkSession
    # one row per file: their starts are summed up here
    parts = manifest.orderBy("part").collect()
    starts, total = [], 0
    for part in parts:
        starts.append((part["name"], total))
        total += part["ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, firsts = batch.column("name").to_pylist(), batch.column("start").to_pylist()
            for name, before in zip(names, firsts, strict=True):
                source = TokenFile(folder, name)
                ends = source.ends.all().astype(np.int64)
                firsts_in = np.concatenate([[0], ends[:-1]])
                crc = [
                    zlib.crc32(source.between(a, b))
                    for a, b in zip(firsts_in.tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(source.doc_ids(), pa.int64()),
                        pa.array(firsts_in + before),
                        pa.array(ends - firsts_in),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    files = spark.createDataFrame(starts, "name string, start bigint")
    return files.repartition(max(1, len(starts))).mapInArrow(read, schema)

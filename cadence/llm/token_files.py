"""Token-id files in the Arrow stream format with fixed-size lists (operator 5).

``write_tokens`` range-partitions the documents by id and lets every task write
one shard: an Arrow stream file of record batches with three fixed-size-list
columns of ``sequence_length`` items: ``ids``, ``mask`` (true: a token, false:
padding after the shard's last token) and ``ends`` (true: the last token of a
document), and beside it a stream file with the shard's doc_ids in order. All
batches but the last hold ``batch_sequences`` sequences, so sequence i is row
i mod batch_sequences of batch i div batch_sequences. ``SequenceFile`` maps a
shard into memory and gives zero-copy views of any sequence and its mask.

A task writes its files under names of its own and then reports them; only
reported files form the manifest, so a retried or speculative task never mixes
with another. Files go through pyarrow's file systems into a shared folder
(by default below the session's checkpoint folder). Shards are never merged;
the manifest (one row a shard) gives each shard's first token number.

Defined cases: a NULL or empty text is the end id alone; NULL doc_ids come
first, ties are ordered by text; repeated rows are written once each; an empty
table gives no shard; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import (delete_at_exit, file_system, keyed_texts, scratch_dir, scratch_table, ship_package,
                                shuffle_partitions, to_arrow)
from cadence.llm.tokens import encoder, vocabulary

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SEQUENCE_LENGTH = 2048
BATCH_SEQUENCES = 64


def sequence_schema(id_type: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("ends", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Buffers one batch of ids and writes full record batches."""

    def __init__(self, folder: str, shard: int, dtype: str, length: int, batch_sequences: int):
        self.fs, at = file_system(folder)
        self.fs.create_dir(at, recursive=True)
        stem = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        self.tokens_path, self.docs_path = f"{stem}.tokens.arrows", f"{stem}.docs.arrows"
        self.dtype, self.length, self.batch = np.dtype(dtype), length, length * batch_sequences
        self.id_type = pa.from_numpy_dtype(self.dtype)
        self.schema = sequence_schema(self.id_type, length)
        self.sink = self.fs.open_output_stream(file_system(self.tokens_path)[1])
        self.writer = pa.ipc.new_stream(self.sink, self.schema)
        self.docs_sink = self.fs.open_output_stream(file_system(self.docs_path)[1])
        self.docs_schema = pa.schema([("doc_id", pa.int64())])
        self.docs_writer = pa.ipc.new_stream(self.docs_sink, self.docs_schema)
        self.ids = np.zeros(self.batch, self.dtype)
        self.ends = np.zeros(self.batch, bool)
        self.filled, self.n_tokens, self.n_docs = 0, 0, 0

    def add(self, ids: np.ndarray) -> None:
        """Append one document's ids, its end id included."""
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.batch - self.filled)
            self.ids[self.filled:self.filled + n] = ids[at:at + n]
            self.filled += n
            at += n
            if at == len(ids):
                self.ends[self.filled - 1] = True
            if self.filled == self.batch:
                self._write()
        self.n_tokens += len(ids)

    def add_doc_ids(self, doc_ids: pa.Array) -> None:
        self.docs_writer.write_batch(pa.RecordBatch.from_arrays([doc_ids], schema=self.docs_schema))
        self.n_docs += len(doc_ids)

    def _write(self) -> None:
        n = -(-self.filled // self.length) * self.length
        self.ids[self.filled:n] = 0
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length)
                 for x in (self.ids[:n], np.arange(n) < self.filled, self.ends[:n])]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.filled = 0
        self.ends[:] = False

    def close(self) -> None:
        if self.filled:
            self._write()
        for x in (self.writer, self.sink, self.docs_writer, self.docs_sink):
            x.close()


class SequenceFile:
    """Random access to a shard's sequences without copying."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(self.source))
        self.rows = len(self.batches[0]) if self.batches else 0

    def __len__(self) -> int:
        return sum(map(len, self.batches))

    def ids(self, i: int) -> np.ndarray:
        batch, row = divmod(i, self.rows)
        lists = self.batches[batch].column(0)
        width = lists.type.list_size
        return lists.values.slice(row * width, width).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.BooleanArray:
        batch, row = divmod(i, self.rows)
        lists = self.batches[batch].column(1)
        width = lists.type.list_size
        return lists.values.slice(row * width, width)


MANIFEST = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                      ("tokens_path", pa.string()), ("docs_path", pa.string())])


def write_tokens(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 vocab: str = VOCABULARY, end_id: int = END_ID, sequence_length: int = SEQUENCE_LENGTH,
                 batch_sequences: int = BATCH_SEQUENCES, shards: int | None = None) -> DataFrame:
    """Write the documents' ids in ascending doc_id order; returns the manifest
    (shard, n_docs, n_tokens, tokens_path, docs_path, first_token)."""
    spark = docs.sparkSession
    ship_package(spark)
    if folder is None:
        folder = scratch_dir(spark, "token-files")
        delete_at_exit(spark, folder)
    path = vocabulary(vocab)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        shard = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            enc = encoder(path, "spaced")
            if out is None:
                out = ShardWriter(folder, shard, enc.dtype, sequence_length, batch_sequences)
                end = np.array([end_id], enc.dtype).tobytes()
            for text in batch.column(1).to_pylist():
                out.add(np.frombuffer(enc.encode(text) + end, enc.dtype))
            out.add_doc_ids(batch.column(0))
        if out is not None:
            out.close()
            yield to_arrow({"shard": [shard], "n_docs": [out.n_docs], "n_tokens": [out.n_tokens],
                            "tokens_path": [out.tokens_path], "docs_path": [out.docs_path]}, MANIFEST)

    ordered = (keyed_texts(docs, id_col, text_col)
               .repartitionByRange(shards or shuffle_partitions(spark), F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    written = scratch_table(ordered.mapInArrow(
        write, "shard long, n_docs long, n_tokens long, tokens_path string, docs_path string"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return written.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.
    A shard is one task's work, read batch by batch."""

    def shard_rows(tokens_path: str, docs_path: str, start: int) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(docs_path)
        with fs.open_input_stream(at) as source:
            doc_ids = [i for batch in pa.ipc.open_stream(source) for i in batch.column(0).to_pylist()]
        fs, at = file_system(tokens_path)
        seen, crc, n = 0, 0, 0
        with fs.open_input_stream(at) as source:
            for batch in pa.ipc.open_stream(source):
                ids, mask, ends = (c.values.to_numpy(zero_copy_only=False) for c in batch.columns)
                words = ids[mask].astype("<u4")
                rows: dict[str, list] = {c: [] for c in DOCS.names}
                at = 0
                for stop in (np.flatnonzero(ends[mask]) + 1).tolist():
                    crc, n = zlib.crc32(words[at:stop].tobytes(), crc), n + stop - at
                    for name, value in zip(DOCS.names, (doc_ids[seen], start, n, crc)):
                        rows[name].append(value)
                    start, seen, crc, n, at = start + n, seen + 1, 0, 0, stop
                crc, n = zlib.crc32(words[at:].tobytes(), crc), n + len(words) - at
                if rows["doc_id"]:
                    yield to_arrow(rows, DOCS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                yield from shard_rows(shard["tokens_path"], shard["docs_path"], shard["first_token"])

    return (manifest.select("tokens_path", "docs_path", "first_token", "shard")
            .repartition(shuffle_partitions(manifest.sparkSession), "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))

"""Token ids of documents in Arrow files of equal-length sequences.

Documents are dealt by range of ``doc_id``; each partition becomes ``part-NNNNN.arrow``, an Arrow
file whose record batches hold ``tokens`` and ``mask``, fixed-size lists of ``SEQUENCE`` values
without nulls or compression: sequence ``i`` is row ``i % BATCH`` of batch ``i // BATCH``, and its
values are a slice of the mapped file. Ids of 16 bits are used where the vocabulary allows. Only the
last sequence of a file is filled up; the mask is false there. ``part-NNNNN.docs.arrow`` has doc_id,
start (in the file) and n_tokens of the part's documents in order. A file is written under another
name and moved, so a repeated task leaves the same files.

Defined cases: null and empty texts have the end id alone; rows that repeat a ``doc_id`` follow each
other in order of their texts; null ids come first; an empty table has no files; other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import tokens

SEQUENCE = 2048
BATCH = 64
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _id_type(vocabulary: str) -> pa.DataType:
    return pa.uint16() if tokens.encoder(vocabulary).tokenizer.get_vocab_size() <= 1 << 16 else pa.uint32()


def sequence_schema(kind: pa.DataType, length: int) -> pa.Schema:
    lists = [pa.field("tokens", pa.list_(pa.field("item", kind, nullable=False), length), nullable=False)]
    lists.append(pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length), nullable=False))
    return pa.schema(lists)


class SequenceWriter:
    """Appends ids to an Arrow file of fixed-size lists; holds one record batch at most."""

    def __init__(self, sink, kind: pa.DataType, length: int = SEQUENCE):
        self.schema, self.kind, self.length = sequence_schema(kind, length), kind, length
        self.writer = ipc.new_file(sink, self.schema)
        self.buffer, self.size = [], 0

    def _batch(self, ids: np.ndarray, valid: int) -> None:
        values = pa.array(ids, self.kind)
        mask = pa.array(np.arange(len(ids)) < valid)
        columns = [pa.FixedSizeListArray.from_arrays(v, type=f.type) for v, f in zip((values, mask), self.schema)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def append(self, ids: np.ndarray) -> None:
        self.buffer.append(ids)
        self.size += len(ids)
        full = self.length * BATCH
        if self.size >= full:
            joined = np.concatenate(self.buffer)
            for at in range(0, len(joined) - full + 1, full):
                self._batch(joined[at : at + full], full)
            rest = joined[len(joined) // full * full :]
            self.buffer, self.size = [rest], len(rest)

    def close(self) -> None:
        if self.size:
            joined = np.concatenate(self.buffer)
            padded = np.zeros(-(-len(joined) // self.length) * self.length, dtype=joined.dtype)
            padded[: len(joined)] = joined
            self._batch(padded, len(joined))
        self.writer.close()


def _write(folder: str, vocabulary: str, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        encoder, end = tokens.encoder(vocabulary), np.array([END_ID], dtype="<u4").tobytes()
        kind = _id_type(vocabulary)
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        name = f"{path}/part-{part:05d}"
        passing = f"{path}/.part-{part:05d}-{attempt}"
        writer, sink = None, None
        ids, starts, counts, total = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if writer is None:
                    sink = system.open_output_stream(passing)
                    writer = SequenceWriter(sink, kind, length)
                own = np.frombuffer(encoder.ids(text.as_py()) + end, dtype="<u4").astype(kind.to_pandas_dtype())
                writer.append(own)
                ids.append(doc)
                starts.append(total)
                counts.append(len(own))
                total += len(own)
        if writer is None:
            return
        writer.close()
        sink.close()
        docs = pa.table({"doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(counts, pa.int64())})
        with system.open_output_stream(passing + ".docs") as stream, ipc.new_file(stream, docs.schema) as out:
            out.write_table(docs)
        system.move(passing + ".docs", name + ".docs.arrow")
        system.move(passing, name + ".arrow")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_tokens": pa.array([total], pa.int64())})

    return run


def write_token_files(documents: DataFrame, folder: str, vocabulary: str = VOCABULARY, length: int = SEQUENCE) -> list[tuple[int, int]]:
    """Writes the files; (part, tokens before it) of every part, a row per file."""
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    parts, total = [], 0
    for row in sorted(dealt.mapInArrow(_write(folder, vocabulary, length), "part int, n_tokens long").collect()):
        parts.append((row.part, total))
        total += row.n_tokens
    return parts


def read_sequences(folder: str, part: int) -> ipc.RecordBatchFileReader:
    """Reader over one file, mapped into memory where the file system is local."""
    system, path = _open(folder)
    name = f"{path}/part-{part:05d}.arrow"
    if isinstance(system, fs.LocalFileSystem):
        return ipc.open_file(pa.memory_map(name))
    return ipc.open_file(system.open_input_file(name))


def sequence(reader: ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, pa.Array]:
    """Ids (a view of the file) and mask of sequence ``i``."""
    batch = reader.get_batch(i // BATCH)
    return np.asarray(batch.column(0)[i % BATCH].values), batch.column(1)[i % BATCH].values


def _read(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        for batch in batches:
            for part, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{path}/part-{part:05d}.docs.arrow") as source:
                    docs = ipc.open_file(source).read_all()
                reader = read_sequences(folder, part)
                number, held, at, crcs = 0, np.zeros(0, dtype=np.uint32), 0, []
                for count in docs["n_tokens"].to_pylist():
                    left, crc = count, 0
                    while left:
                        if at == len(held):
                            held, at = np.asarray(reader.get_batch(number).column(0).flatten()), 0
                            number += 1
                        take = held[at : at + left]
                        crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                        at += len(take)
                        left -= len(take)
                    crcs.append(crc)
                starts = np.asarray(docs["start"]) + before
                yield pa.RecordBatch.from_arrays(
                    [
                        docs["doc_id"].combine_chunks(),
                        pa.array(starts, pa.int64()),
                        docs["n_tokens"].combine_chunks(),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_token_files(spark: SparkSession, folder: str, parts: list[tuple[int, int]]) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of every document, from the files."""
    listed = spark.createDataFrame(parts, "part int, before long").repartition(max(1, len(parts)))
    return listed.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")

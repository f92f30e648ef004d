"""Token ids in Arrow files of equal-length sequences, readable at any place without a copy.

Documents, in ascending order of doc_id, are joined to one stream of ids per task. Each task writes
its stream as an Arrow file of record batches with two fixed-size lists a row: ``ids`` (16 bits each
if the vocabulary allows, else 32) and ``mask`` (false behind the stream's end, in the last sequence
only). Beside it lies an index, also an Arrow file: ``doc_id, start, n_tokens`` within the stream.

Files lie in a folder all executors share, by any URI that Arrow's file systems open. A task names
its files after itself and reports them when they are closed; only reported files are ever read, so
tasks may fail and run again.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import fresh_path, picked, settle
from signalwatch.llm.tokens import default_tokenizer, encoder

LENGTH = 2048
#: Sequences of a record batch.
BATCH = 128
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_FILES = ("task int, sequences_uri string, index_uri string, n_documents long, n_ids long,"
          " length int, n_sequences long")


class SequenceFile:
    """Sequences of one file by number; local files are mapped, not read."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self._reader = pa.ipc.open_file(pa.memory_map(path) if local else
                                        system.open_input_file(path))
        self.length = self._reader.schema.field("ids").type.list_size
        self._held: tuple[int, pa.RecordBatch | None] = (-1, None)

    def __len__(self) -> int:
        last = self._reader.num_record_batches
        return (last - 1) * BATCH + self._reader.get_batch(last - 1).num_rows if last else 0

    def _batch(self, number: int) -> pa.RecordBatch:
        if self._held[0] != number:
            self._held = number, self._reader.get_batch(number)
        return self._held[1]

    def __getitem__(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the mask of one sequence; the ids are a view of the file."""
        batch, row = self._batch(number // BATCH), number % BATCH
        here = slice(row * self.length, (row + 1) * self.length)
        return (batch.column("ids").flatten().to_numpy()[here],
                batch.column("mask").flatten()[here].to_numpy(zero_copy_only=False))

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of one record batch after the other."""
        held = BATCH * self.length
        while n > 0:
            ids = self._batch(start // held).column("ids").flatten().to_numpy()
            part = ids[start % held:start % held + n]
            yield part
            start, n = start + len(part), n - len(part)

    def masked(self) -> int:
        """How many ids the masks call real."""
        return sum(int(self._reader.get_batch(k).column("mask").flatten().true_count)
                   for k in range(self._reader.num_record_batches))


def _write(folder: str, tokenizer: str, length: int):
    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Tokenizer

        wide = Tokenizer.from_file(tokenizer).get_vocab_size() > 1 << 16
        kind = pa.uint32() if wide else pa.uint16()
        schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        task = TaskContext.get().partitionId()
        name = f"{folder}/part-{task:06d}-{uuid.uuid4().hex}"
        system, path = fs.FileSystem.from_uri(name)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        n_documents = n_ids = n_sequences = 0
        rest = np.empty(0, kind.to_pandas_dtype())
        encode = encoder(tokenizer)

        def sequences(ids: np.ndarray, real: int) -> pa.RecordBatch:
            mask = pa.array(np.arange(len(ids)) < real)
            return pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids, kind), length),
                                    pa.FixedSizeListArray.from_arrays(mask, length)], schema=schema)

        with system.open_output_stream(f"{path}.arrow") as out, \
                system.open_output_stream(f"{path}.index.arrow") as index_out, \
                pa.ipc.new_file(out, schema) as writer, \
                pa.ipc.new_file(index_out, _INDEX) as index:
            for batch in batches:
                counts, parts, size = [], [rest], len(rest)
                for ids in encode.encode_all(batch.text):
                    counts.append(len(ids))
                    parts.append(ids.astype(rest.dtype))
                    size += len(ids)
                    if size >= BATCH * length:
                        joined = np.concatenate(parts)
                        full = size // (BATCH * length) * BATCH * length
                        for at in range(0, full, BATCH * length):
                            writer.write_batch(sequences(joined[at:at + BATCH * length], size))
                        n_sequences += full // length
                        parts, size = [joined[full:]], size - full
                rest = np.concatenate(parts)
                starts = n_ids + np.cumsum([0, *counts])
                index.write_batch(pa.record_batch(
                    [pa.array(batch.doc_id.to_numpy()), pa.array(starts[:-1]),
                     pa.array(counts, pa.int64())], schema=_INDEX))
                n_documents, n_ids = n_documents + len(batch), int(starts[-1])
            if len(rest):
                n_last = -(-len(rest) // length)
                padded = np.zeros(n_last * length, rest.dtype)
                padded[:len(rest)] = rest
                writer.write_batch(sequences(padded, len(rest)))
                n_sequences += n_last
        if n_documents:
            yield pd.DataFrame([(task, f"{name}.arrow", f"{name}.index.arrow", n_documents, n_ids,
                                 length, n_sequences)], columns=_FILES.replace(",", "").split()[::2])

    return written


def write_sequences(documents: DataFrame, folder: str | None = None, length: int = LENGTH,
                    tokenizer: str | None = None) -> DataFrame:
    """Encode and write all documents; return a stored table of the files, a row for each.

    Null and empty texts have just the end id. Rows that repeat a doc_id follow each other, ordered
    by text. Other columns are ignored; rows without a doc_id are left out. An empty table has no
    files. Texts are read whole, however long.
    """
    folder = folder or fresh_path(documents.sparkSession, "token-files")
    ordered = picked(documents, doc_id="long", text="string") \
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return settle(ordered.mapInPandas(_write(folder, tokenizer or default_tokenizer(), length),
                                      _FILES), "token-manifest")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        for task, uri, index_uri, n_ids, before in zip(files.task, files.sequences_uri,
                                                       files.index_uri, files.n_ids, files.before):
            sequences = SequenceFile(uri)
            if sequences.masked() != n_ids:
                raise ValueError(f"{uri} holds {sequences.masked()} ids, {n_ids} were written")
            system, path = fs.FileSystem.from_uri(index_uri)
            with system.open_input_file(path) as source:
                index = pa.ipc.open_file(source)
                for k in range(index.num_record_batches):
                    frame = index.get_batch(k).to_pandas()
                    sums = []
                    for start, n in zip(frame.start, frame.n_tokens):
                        crc = 0
                        for part in sequences.span(start, n):
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    yield frame.assign(start=frame.start + before, ids_crc32=sums, file=task)


def read_documents(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, file`` of each document, read from the files.

    ``start`` counts all ids of documents before it: a running sum over the files' table, which has
    one row for a task.
    """
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counted = files.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n = files.count()
    return counted.repartitionByRange(max(n, 1), "task").mapInPandas(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long, file int")

"""Token ids as Arrow files with fixed-size-list batches (operator 3).

Each range of doc_ids becomes one Arrow IPC file: record batches of ``batch`` sequences, each a
``fixed_size_list<uint16 or uint32>[seq_len]`` of ids and a ``fixed_size_list<bool>[seq_len]`` mask
that is false in the padding of the file's last sequence. Equal lengths make sequence ``i`` a
computed place: a memory-mapped reader gets it without a copy. A second small file beside it
holds doc_id, start and n_tokens, since ids alone don't say where documents end.

Files go to the session's shared folder under names that hold the task attempt; only attempts
that Spark committed are in the manifest, so retried and speculative tasks do no harm.

Edge cases: null text is empty (the end id alone); null doc_ids come first; rows of one doc_id are
ordered by a hash of their text; identical rows are separate documents; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, split_text_key, tokenizer_path, tune

SEQ_LEN = 2048
BATCH_SEQUENCES = 256


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Cuts a stream of ids into equal sequences and writes them in equal batches."""

    def __init__(self, sink, dtype: np.dtype, seq_len: int = SEQ_LEN, batch: int = BATCH_SEQUENCES):
        self.dtype, self.seq_len, self.room = np.dtype(dtype), seq_len, seq_len * batch
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.dtype), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.buffer, self.used = np.zeros(self.room, self.dtype), 0

    def add(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.room - self.used)
            self.buffer[self.used : self.used + n] = ids[at : at + n]
            self.used, at = self.used + n, at + n
            if self.used == self.room:
                self._write()

    def _write(self) -> None:
        if self.used:
            padded = -(-self.used // self.seq_len) * self.seq_len
            self.buffer[self.used :] = 0
            mask = np.arange(padded) < self.used
            cols = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (self.buffer[:padded].copy(), mask)]
            self.out.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))
            self.used = 0

    def close(self) -> None:
        self._write()
        self.out.close()


def write_token_files(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 2,
    seq_len: int = SEQ_LEN,
    tokenizer_dir: str | None = None,
    directory: str | None = None,
) -> tuple[str, list[tuple[str, int, int]]]:
    """Write the files; the folder, and (file name, documents, tokens) of each file in doc_id order."""
    spark = docs.sparkSession
    tune(spark)
    path = tokenizer_path(tokenizer, tokenizer_dir)
    directory = directory or shared_dir(spark, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .tokens import encoder

        enc = encoder(path)
        dtype = np.uint16 if len(enc.edge) <= 1 << 16 and end_id < 1 << 16 else np.uint32
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        fs, root = _open_fs(directory)
        fs.create_dir(root, recursive=True)
        writer = sink = None
        doc_ids: list[pa.Array] = []
        counts: list[np.ndarray] = []
        for batch in batches:
            if writer is None:
                sink = fs.open_output_stream(f"{root}/{name}.arrow")
                writer = SequenceWriter(sink, dtype, seq_len)
            doc_ids.append(batch.column(0))
            ids, at = enc.encode_column(batch.column(1), end_id)
            counts.append(np.diff(at))
            writer.add(ids.astype(dtype))
        if writer is None:
            return
        writer.close()
        sink.close()
        sizes = np.concatenate(counts)
        total = int(sizes.sum())
        index = pa.RecordBatch.from_pydict({"doc_id": pa.concat_arrays(doc_ids), "start": pa.array(np.cumsum(sizes) - sizes), "n_tokens": pa.array(sizes)})
        with fs.open_output_stream(f"{root}/{name}.index.arrow") as f, pa.ipc.new_file(f, index.schema) as w:
            w.write_batch(index)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "docs": pa.array([len(sizes)], pa.int64()), "tokens": pa.array([total], pa.int64())})

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", split_text_key(F.col("text")).alias("_k"))
        .repartitionByRange("doc_id", "_k")
        .sortWithinPartitions("doc_id", "_k")
        .select("doc_id", "text")
    )
    made = ordered.mapInArrow(run, "part int, name string, docs long, tokens long").collect()  # one row a file
    return directory, [(r.name, r.docs, r.tokens) for r in sorted(made, key=lambda r: r.part)]


def read_sequence(directory: str, name: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``i`` of a file; only its batch is read (mapped, where the file is local)."""
    fs, root = _open_fs(directory)
    reader = pa.ipc.open_file(fs.open_input_file(f"{root}/{name}.arrow") if fs.type_name != "local" else pa.memory_map(f"{root}/{name}.arrow"))
    per = len(reader.get_batch(0))
    batch, at = reader.get_batch(i // per), i % per
    width = batch.schema.field(0).type.list_size
    flat = batch.column(0).values.slice(at * width, width).to_numpy()
    return flat, batch.column(1).values.slice(at * width, width).to_numpy(zero_copy_only=False)


def read_token_files(spark: SparkSession, directory: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """One row a document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    firsts = [0, *accumulate(t for _, _, t in files)]
    todo = spark.createDataFrame([(n, s) for (n, _, _), s in zip(files, firsts)], "name string, first long").repartition(len(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_fs(directory)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}.index.arrow") as f:
                    index = pa.ipc.open_file(f).read_all()
                sizes = index.column("n_tokens").to_numpy()
                with fs.open_input_file(f"{root}/{name}.arrow") as f:
                    crcs = crc_by_document(pa.ipc.open_file(f), sizes)
                starts = pa.array(index.column("start").to_numpy() + first, pa.int64())
                out = pa.table({"doc_id": index.column("doc_id"), "start": starts, "n_tokens": index.column("n_tokens"), "ids_crc32": pa.array(crcs, pa.int64())})
                yield from out.to_batches(max_chunksize=10_000)

    return todo.mapInArrow(run, schema)


def crc_by_document(reader, sizes: np.ndarray) -> list[int]:
    """CRC-32 of each document's ids as unsigned 32-bit, batch after batch."""
    crcs, crc, doc = [], 0, 0
    left = int(sizes[0]) if len(sizes) else 0
    for b in range(reader.num_record_batches):
        batch = reader.get_batch(b)
        ids, mask = batch.column(0).values.to_numpy(), batch.column(1).values
        if mask.true_count < len(mask):  # only a file's last batch has padding
            ids = ids[mask.to_numpy(zero_copy_only=False)]
        raw, at, n = memoryview(ids.astype("<u4").tobytes()), 0, len(ids)
        while at < n:
            take = min(left, n - at)
            crc = zlib.crc32(raw[4 * at : 4 * (at + take)], crc)
            at, left = at + take, left - take
            if not left:
                crcs.append(crc)
                crc, doc = 0, doc + 1
                left = int(sizes[doc]) if doc < len(sizes) else 0
    if len(crcs) != len(sizes):
        raise ValueError("the index and the ids differ")
    return crcs

"""Token ids in Arrow stream files of fixed-size lists: equal-length sequences and masks, read in place."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces
from .encoding import encoder, vocabulary

INDEX = "doc_id long, part int, file string, at long, n_tokens long"


def schema(length: int, dtype: str) -> pa.Schema:
    kind = pa.uint16() if dtype == "<u2" else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(kind, length), nullable=False), pa.field("mask", pa.list_(pa.bool_(), length), nullable=False)])


class Writer:
    """One file: the ids of its documents end to end, cut into rows of ``length``; the last row is filled with 0 and masked.

    All batches but the last hold ``rows`` rows, so token i lies in batch i // (rows * length).
    """

    def __init__(self, sink: pa.NativeFile, length: int, dtype: str, rows: int) -> None:
        self.sink, self.length, self.dtype, self.rows = sink, length, dtype, rows
        self.schema = schema(length, dtype)
        self.out = pa.ipc.new_file(sink, self.schema)
        self.parts: list[bytes] = []
        self.held = 0

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.held += len(ids)
        full = self.rows * self.length * np.dtype(self.dtype).itemsize
        if self.held >= full:
            data = b"".join(self.parts)
            whole = len(data) // full * full
            for i in range(0, whole, full):
                self.put(np.frombuffer(data, self.dtype, full // np.dtype(self.dtype).itemsize, i))
            self.parts, self.held = [data[whole:]], len(data) - whole

    def put(self, ids: np.ndarray) -> None:
        n = -(-len(ids) // self.length) * self.length
        values, mask = np.zeros(n, self.dtype), np.arange(n) < len(ids)
        values[: len(ids)] = ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((values, mask), self.schema, strict=True)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self.put(np.frombuffer(b"".join(self.parts), self.dtype))
        self.out.close()
        self.sink.close()


class Reader:
    """Random access to one file. A local file is mapped: ids are views of its pages, nothing is copied or decoded."""

    def __init__(self, uri: str) -> None:
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(uri)
        self.file = pa.memory_map(path) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(path)
        self.batches = pa.ipc.open_file(self.file)
        first = self.batches.get_batch(0) if self.batches.num_record_batches else None
        self.length = self.batches.schema.field("ids").type.list_size
        self.per_batch = len(first) * self.length if first is not None else 1

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views of ``n`` ids from ``start``, one for each batch they lie in."""
        while n:
            k, at = divmod(start, self.per_batch)
            values = self.batches.get_batch(k).column(0).values.to_numpy(zero_copy_only=True)[at : at + n]
            yield values
            start, n = start + len(values), n - len(values)

    def rows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of batch ``k`` as two tables of equal-length rows."""
        batch = self.batches.get_batch(k)
        ids, mask = batch.column(0).values.to_numpy(), batch.column(1).values.to_numpy(zero_copy_only=False)
        return ids.reshape(-1, self.length), mask.reshape(-1, self.length)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, rows: int = 64) -> None:
    """Encode every text, end it with ``end_id`` and write files in ascending id order under ``path``.

    Texts are placed by range of id (then by text hash, so rows repeated under one id part and have a fixed order;
    null ids come first), then encoded where they land: only texts move. A file holds one range; ``path/index`` lists
    each document's file and place. File names are new for each attempt of a task and only those of the attempt that
    Spark commits are listed, so a task that is lost and run again leaves no wrong file in use. A null text is empty;
    an empty table gives an empty index. Ids below 65,536 are stored in two bytes, else in four.
    """
    spark = docs.sparkSession
    dtype = "<u2" if max(vocabulary(tokenizer), end_id + 1) <= 1 << 16 else "<u4"
    end = np.array([end_id], dtype).tobytes()
    # A folder that executors can write to must exist first; local paths need it, object stores do not mind.
    spark.createDataFrame([(length, dtype)], "length int, dtype string").coalesce(1).write.mode("overwrite").json(f"{path}/about")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        part = TaskContext.get().partitionId()
        encode, out, at, uri = encoder(tokenizer, dtype).encode, None, 0, f"{path}/tokens-{part:06d}-{uuid.uuid4().hex}.arrow"
        for whole in batches:
            for batch in pieces(whole, "text"):
                if out is None:
                    files, place = fs.FileSystem.from_uri(uri)
                    out = Writer(files.open_output_stream(place), length, dtype, rows)
                starts, sizes = [], []
                for ids in encode(batch.column(1)):
                    out.add(ids + end)
                    starts.append(at)
                    sizes.append(len(ids) // len(end) + 1)
                    at += sizes[-1]
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([part] * n, pa.int32()), pa.array([uri] * n), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names=["doc_id", "part", "file", "at", "n_tokens"])
        if out is not None:
            out.close()

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("th"))
    placed = rows_in.repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th").select("doc_id", "text")
    placed.mapInArrow(write, INDEX).write.mode("overwrite").parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, file, at, n_tokens, start): ``start`` counts the ids of all documents before it.

    Files follow each other in id order, so a document's start is its place in its file plus the sizes of the files
    before: a sum over one row per file.
    """
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sizes.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as before")
    return index.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("at")).drop("before")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read from the token files, each document by random access."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file = None, None
        for batch in batches:
            sums = []
            for f, at, n in zip(*(batch.column(i).to_pylist() for i in range(2, 5)), strict=True):
                if f != uri:
                    uri, file = f, Reader(f)
                crc = 0
                for ids in file.ids(at, n):
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_index(spark, path).select("doc_id", "start", "file", "at", "n_tokens").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")

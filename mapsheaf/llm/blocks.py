"""Blocks of documents, and questions that blocks put to slices of a key space.

A block is one row that holds some megabytes of documents, compressed. Blocks are written
once to the shared folder, so they stay what they are when a task runs again. A block asks
each slice of a hash range one question, a blob that holds all its keys of that range; the
slice sees the questions of all blocks and answers each with a blob in the same order. So
a frequent key costs one entry for each block, never one row for each occurrence, and rows
shuffled are blocks times slices.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm.common import materialize

BLOCK_BYTES = 4 << 20
BLOCK = "block long, docs long, size long, payload binary"
QUESTION = "slice int, block long, question binary"
ANSWER = "block long, slice int, answer binary"
LEAST_SLICES = 64


def squeeze(array: np.ndarray | bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level).compress(array if isinstance(array, bytes) else array.tobytes())


def expand(blob: bytes, kind: str | None = None) -> np.ndarray | bytes:
    data = zstandard.ZstdDecompressor().decompress(blob)
    return data if kind is None else np.frombuffer(data, kind)


def write_sorted(keys: np.ndarray) -> bytes:
    """Rising whole numbers as their differences, byte by byte."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    return squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, keys.dtype.itemsize).T))


def read_sorted(blob: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    steps = np.ascontiguousarray(expand(blob, "u1").reshape(width, -1).T).view(kind)[:, 0]
    return np.cumsum(steps, dtype=kind)


def pack(docs: DataFrame, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (``doc_id, text``) as blocks; a longer text is a block of its own."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size, count = TaskContext.get().partitionId() << 32, [], 0, 0

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_table(rows)
            return pa.RecordBatch.from_pydict({
                "block": pa.array([first + count], pa.int64()), "docs": pa.array([len(rows)], pa.int64()),
                "size": pa.array([size], pa.int64()),
                "payload": pa.array([squeeze(sink.getvalue().to_pybytes(), 6)], pa.binary())})

        for part in parts:
            part = pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.binary())], ["doc_id", "text"])
            ends = np.cumsum(pc.fill_null(pc.binary_length(part.column(1)), 0).to_numpy(
                zero_copy_only=False)) if len(part) else np.empty(0, np.int64)
            start, before = 0, 0
            while start < len(part):
                end = max(start + 1, int(np.searchsorted(ends, before + block_bytes - size, "right")))
                held.append(part.slice(start, end - start))
                size += int(ends[end - 1]) - before
                start, before = end, int(ends[end - 1])
                if size >= block_bytes or start < len(part):
                    yield block()
                    held, size, count = [], 0, count + 1
        if held:
            yield block()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(narrow.mapInArrow(batches, BLOCK), name)


def unpack(payload: bytes) -> tuple[list[int | None], list[bytes]]:
    """Ids and texts (UTF-8, null as empty) of a block."""
    with pa.ipc.open_stream(expand(payload)) as reader:
        rows = reader.read_all()
    return rows.column("doc_id").to_pylist(), [text or b"" for text in rows.column("text").to_pylist()]


def slices_for(keys: int, each: int) -> int:
    """How many slices hold about ``each`` keys."""
    return max(LEAST_SLICES, math.ceil(keys / each))


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    """The slice of 64-bit hashes, by their upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int32)


def each_block(blocks: DataFrame, run: Callable[[int, bytes], pd.DataFrame], schema: str) -> DataFrame:
    """``run(block, payload)`` for every block."""
    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, payload in zip(frame["block"], frame["payload"], strict=True):
                yield run(int(block), payload)

    return blocks.select("block", "payload").mapInPandas(parts, schema)


def each_answered(
    blocks: DataFrame, answers: DataFrame, run: Callable[[int, bytes, dict[int, bytes]], pd.DataFrame], schema: str,
) -> DataFrame:
    """``run(block, payload, answers)`` for every block; its answers by slice."""
    def parts(own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        found = dict(zip(given["slice"], given["answer"], strict=True))
        return run(int(own["block"].iloc[0]), own["payload"].iloc[0], found)

    return blocks.select("block", "payload").groupBy("block").cogroup(
        answers.groupBy("block")).applyInPandas(parts, schema)


def each_slice(
    questions: DataFrame, answer: Callable[[list[bytes]], Iterator[bytes]], name: str,
) -> DataFrame:
    """The answers to all questions; ``answer`` gets those of one slice."""
    def parts(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block", ignore_index=True)
        return pd.DataFrame({
            "block": frame["block"], "slice": frame["slice"],
            "answer": list(answer(list(frame["question"])))})

    return materialize(questions.groupBy("slice").applyInPandas(parts, ANSWER), name)


def questions(block: int, slice_numbers: np.ndarray, write: Callable[[slice], bytes]) -> pd.DataFrame:
    """Questions of keys that are sorted by slice: one for each slice that occurs."""
    starts = np.flatnonzero(np.diff(slice_numbers, prepend=-1))
    ends = np.append(starts[1:], len(slice_numbers))[:len(starts)]
    return pd.DataFrame({
        "slice": slice_numbers[starts].astype(np.int32), "block": np.int64(block),
        "question": [write(slice(a, b)) for a, b in zip(starts, ends, strict=True)]})

"""Documents gathered into blocks, and packed integers.

A block is one row with about BLOCK_BYTES of text: what a task needs to look
at several times, or to exchange with other tasks by packed answers instead of
one row per word or position. Blocks are made where the documents are read,
without a shuffle, and are written once, so their numbers are stable.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from mediamart.llm.common import ship, slices, text_bytes

BLOCK_BYTES, CHUNK_BYTES = 24 << 20, 2 << 20


def zipped(raw: bytes, level: int = 1) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def unzipped(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def packed(values: np.ndarray, kind=np.int64) -> bytes:
    return zipped(np.ascontiguousarray(values, kind).tobytes())


def unpacked(blob: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(unzipped(blob), kind)


_SHAPE = pa.schema([("block", pa.int64()), ("size", pa.list_(pa.int64())), ("texts", pa.binary()), ("rest", pa.binary())])


def gather(docs: DataFrame, text_col: str, lower: bool = False, block_bytes: int = BLOCK_BYTES, level: int = 1) -> DataFrame:
    """block, size, texts, rest: the texts (null: empty; ``lower``: A-Z in
    lower case) and, as they are, the other columns of the same rows. A text
    longer than a block is a block of its own."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        values, size, rest = [], 0, []

        def row():
            nonlocal number
            number += 1
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest[0].schema) as out:
                for x in rest:
                    out.write_batch(x)
            return pa.RecordBatch.from_pydict({
                "block": [number], "size": [[len(v) for v in values]], "texts": [zipped(b"".join(values), level)],
                "rest": [zipped(sink.getvalue().to_pybytes())]}, schema=_SHAPE)

        for batch in batches:
            for part in slices(batch, at, block_bytes // 6):
                texts = text_bytes(part.column(at))
                more = sum(map(len, texts))
                if values and size + more > block_bytes:
                    yield row()
                    values, size, rest = [], 0, []
                values += [v.lower() for v in texts] if lower else texts
                size += more
                others = [i for i in range(part.num_columns) if i != at]
                rest.append(pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(part.num_rows, np.int8)), *(part.column(i) for i in others)],
                    names=["row", *(f"c{i}" for i in others)]))
        if values:
            yield row()

    return docs.mapInArrow(run, "block long, size array<long>, texts binary, rest binary")


def text_values(row: dict) -> list[bytes]:
    flat, ends = unzipped(row["texts"]), np.cumsum([0, *row["size"]]).tolist()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def rest_columns(row: dict) -> list[pa.Array]:
    """The other columns of a block's rows, in their order."""
    with pa.ipc.open_stream(unzipped(row["rest"])) as stream:
        held = stream.read_all().combine_chunks()
    return [held.column(i).combine_chunks() if held.column(i).num_chunks != 1 else held.column(i).chunk(0)
            for i in range(1, held.num_columns)]


def chunks(sizes: list[int], limit: int = CHUNK_BYTES):
    """Index ranges of about ``limit`` bytes."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if len(sizes) > start:
        yield start, len(sizes)


def ranges(group: np.ndarray):
    """(value, start, end) of the runs of equal values in a sorted array."""
    cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    return list(zip(group[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(group)]))

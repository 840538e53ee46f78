"""Packing by powers of two: documents become pieces of binary lengths, each a sequence of its own, in buckets of equal lengths.

A document of n tokens gives whole sequences of ``size`` tokens and one piece for each binary digit of what is left, from the
longest. No sequence crosses documents or needs padding, and batches are cut from a bucket, so that all their sequences are of one length.
Nothing shuffles: tasks number their own sequences and batches.

Null texts are empty and give the separator alone; null and repeated ids stay as they are, each row for itself.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.llm._common import reachable, releasing
from windrow.llm.byte_ids import worker_ids

#: Documents whose pieces leave a worker together.
_TOGETHER = 256


def binary_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: ``size`` as often as it goes in, then falling powers of two."""
    rest = n % size
    return [size] * (n // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def decompose(docs: DataFrame, tokenizer: str, size: int = 1024, separator: int = 0, batch_tokens: int = 65_536, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, start, length, ids, doc_tokens, sequence_id, offset, bucket, batch_id): a row for each piece.

    ``ids`` are little-endian unsigned 32-bit numbers; ``bucket`` is the binary logarithm of the length. A batch holds ``batch_tokens`` tokens of one bucket; the last
    ones of each task may hold fewer.
    """
    if size < 1 or size & (size - 1) or batch_tokens < size:
        raise ValueError("size must be a power of two, and a batch hold one sequence at least")
    reachable(docs.sparkSession)
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *[T.StructField(n, t) for n, t in (("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()), ("bucket", T.IntegerType()), ("batch_id", T.LongType()))]])
    end = array("I", [separator]).tobytes()

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, sequences, count = TaskContext.get().partitionId() << 33, 0, 0
        room: dict[int, tuple[int, int]] = {}  # by length: the batch that is being filled, and the sequences it still takes
        encoder = worker_ids(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, _TOGETHER):
                some = batch.slice(i, _TOGETHER)
                rows: list[int] = []
                starts: list[int] = []
                lengths: list[int] = []
                totals: list[int] = []
                within: list[int] = []
                data: list[bytes] = []
                for row, ids in enumerate(encoder.packed(some.column(1).to_pylist())):
                    ids += end
                    n, start = len(ids) // 4, 0
                    data.append(ids)
                    for length in binary_lengths(n, size):
                        number, left = room.get(length, (0, 0))
                        if not left:
                            number, left, count = count, batch_tokens // length, count + 1
                        room[length] = number, left - 1
                        rows.append(row)
                        starts.append(start)
                        lengths.append(length)
                        totals.append(n)
                        within.append(base | number)
                        start += length
                m = len(rows)
                offsets = np.zeros(m + 1, np.int32)
                np.cumsum(np.array(lengths) * 4, out=offsets[1:])
                pieces = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(data))])
                long = lambda v: pa.array(v, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(rows, pa.int64())), long(starts), long(lengths), pieces, long(totals), long(np.arange(sequences, sequences + m) | base),
                        long(np.zeros(m, np.int64)), pa.array([n.bit_length() - 1 for n in lengths], pa.int32()), long(within),
                    ],
                    names=[f.name for f in schema],
                )
                sequences += m

    return docs.select(F.col(key), F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences in a folder for each bucket, batches together."""
    pieces.sortWithinPartitions("bucket", "batch_id").write.partitionBy("bucket").parquet(path)

"""Telling documents apart and cutting byte spans out of their texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import map_arrow

#: A document is its doc_id and its text's digest; rows that share both are one document given more than once.
KEY = ["_no_id", "_id", "_digest"]


def key_columns() -> list[Column]:
    """None of them is null, so they join and group without special cases."""
    return [F.col("doc_id").isNull().alias("_no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
            F.xxhash64("text").alias("_digest")]


def pieces(docs: DataFrame, cut: Callable[[bytes], tuple[list[bytes], list[int], list[int], list[int]]]) -> DataFrame:
    """(key, d1, d2, start, end, n): the pieces that ``cut`` finds in each text,
    as 16-byte digests, byte offsets and sizes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                row, digests, starts, ends, sizes = [], [], [], [], []
                for i, text in enumerate(batch.column(3).slice(at, 256).to_pylist(), at):
                    found = cut(text or b"")
                    row += [i] * len(found[0])
                    digests += found[0]
                    starts += found[1]
                    ends += found[2]
                    sizes += found[3]
                d = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                keys = [batch.column(k).take(pa.array(row, pa.int32())) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                     pa.array(sizes, pa.int32())], [*KEY, "d1", "d2", "start", "end", "n"])

    return map_arrow(
        docs.select(*key_columns(), F.col("text").cast("binary")), run, "_no_id boolean, _id long, _digest long, d1 long, d2 long, start int, end int, n int")


def removed_spans(found: DataFrame, least: int) -> DataFrame:
    """(key, removed, kept): per document the byte spans to remove, touching
    and overlapping ones as one, and what lies between them.  ``found`` has (key, start, end, n, next);
    runs of touching pieces whose sizes add up to under ``least`` stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, kept = [], []
            for spans in batch.column(3).to_pylist():
                runs: list[list[int]] = []
                for start, end, n in sorted({(x["start"], x["end"], x["n"]) for x in spans}):
                    if runs and runs[-1][1] >= start:
                        runs[-1][1] = max(runs[-1][1], end)
                        runs[-1][2] += n
                    else:
                        runs.append([start, end, n])
                runs = [r for r in runs if r[2] >= least]
                gone.append([{"start": a, "end": b} for a, b, _ in runs])
                ends = [0, *[r[1] for r in runs]]
                starts = [*[r[0] for r in runs], 2**31 - 1]
                kept.append([{"start": a, "end": b} for a, b in zip(ends, starts) if b > a])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], pa.array(gone, kind), pa.array(kept, kind)],
                                             [*KEY, "removed", "kept"])

    spans = "array<struct<start:int,end:int>>"
    return map_arrow(found.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end", "n")).alias("s")), run, f"_no_id boolean, _id long, _digest long, removed {spans}, kept {spans}")


def without_spans(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """``docs`` with ``_removed`` (empty array if nothing) and the text that is left."""
    left = "array_join(transform(_kept, x -> cast(substring(cast(text as binary), x.start + 1, x.end - x.start) as string)), '')"
    spans = cuts.withColumnsRenamed({"removed": "_removed", "kept": "_kept"})
    return (docs.select("*", *key_columns()).join(spans, KEY, "left")
            .withColumn("text", F.when(F.size(F.coalesce("_removed", F.array())) > 0, F.expr(left)).otherwise(F.col("text")))
            .withColumn("_removed", F.coalesce("_removed", F.array().cast("array<struct<start:int,end:int>>")))
            .select(*docs.columns, "_removed"))

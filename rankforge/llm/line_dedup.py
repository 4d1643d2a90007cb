"""Line dedup by content-defined chunks of lines.

A hash rolled over the digests of two successive lines chooses the boundaries: a
chunk begins before a line if the hash from this line on has its low bits zero,
and ends before the next boundary, but has two lines at least.  Boundaries
depend on the lines behind them alone, so inserting or deleting lines moves no
other boundary.  Every text is cut under several SPACINGS (one bit more makes
boundaries half as frequent).  At spacing 1 there is a chunk of two lines from every line
on, so short passages are found whatever stands around them; wider spacings
give longer passages as one chunk.

Chunks whose bytes occur more than once in the corpus go but for the earliest
occurrence (doc_id, null last; then the text's digest; then the offset), and no line of an
earliest occurrence goes, be it part of another chunk's later occurrence.  So
of every repeated chunk, of any spacing, a whole copy stays.

Chunks are grouped by 128-bit digest first; only the bytes of chunks whose
digest repeats are fetched, and they are grouped by the bytes themselves, so
nothing is removed on the word of a digest.

Defined results: a line ends with its line feed, the last one with the text; blank
lines belong to the line before them (at the start: to the first), so a chunk
has two lines with something in them, and line feeds at a chunk's end do not count;
null, empty and one-line texts have no chunk and stay; of a line
repeated right after itself two stay; rows
equal in doc_id and text are one document and all get its result; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import lookup_join, read, shared_table
from rankforge.llm.spans import KEY, key_columns, pieces, without_spans
from rankforge.session import map_arrow

#: Lines that the rolling hash covers, and that a chunk has at least.
WINDOW = 2
#: Lines between boundaries on average; powers of two, so that boundaries of a wider spacing are among those of a narrower.
SPACINGS = (1, 2, 4, 8)
_ODD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def lines(text: bytes) -> list[tuple[int, int]]:
    """Start and end of the lines that are not blank, with the blank lines behind them."""
    found, at = [], 0
    for part in text.split(b"\n"):
        end = min(at + len(part) + 1, len(text))
        if part and not part.isspace():
            found.append((at if found else 0, end))
        elif found:
            found[-1] = (found[-1][0], end)
        at = end
    return found


def boundary(rolled: int, spacing: int) -> bool:
    """Whether a chunk begins where the hash of two lines is ``rolled``."""
    return rolled >> 40 & spacing - 1 == 0


def chunks(text: bytes) -> tuple[list[bytes], list[int], list[int], list[int]]:
    """Digests, starts, ends and lines of a text's chunks under every spacing; equal spans once."""
    spans = lines(text)
    if len(spans) < WINDOW:
        return [], [], [], []
    digest = [xxhash.xxh3_64_intdigest(text[a:b].strip()) for a, b in spans]
    rolled = [(d * _ODD + e) * _ODD & _MASK for d, e in zip(digest, digest[1:])]
    found: dict[tuple[int, int], int] = {}
    for spacing in SPACINGS:
        begins = [0, *[i for i, r in enumerate(rolled) if i and boundary(r, spacing)]]
        for i, j in zip(begins, [*begins[1:], len(spans)]):
            j = max(j, i + WINDOW)
            found[(spans[i][0], spans[j - 1][1])] = j - i
    return ([xxhash.xxh3_128_digest(text[a:b].rstrip(b"\n")) for a, b in found], [a for a, _ in found], [b for _, b in found], list(found.values()))


def _cuts(seen: DataFrame) -> DataFrame:
    """(key, removed, kept): what later occurrences cover and first ones do not; ``seen`` has (key, start, end, first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, kept = [], []
            for spans in batch.column(3).to_pylist():
                steps = sorted([(x["start"], 1, x["first"]) for x in spans] + [(x["end"], -1, x["first"]) for x in spans], key=lambda s: s[0])
                open_, runs = [0, 0], []
                for k, (at, step, first) in enumerate(steps):
                    open_[first] += step
                    nxt = steps[k + 1][0] if k + 1 < len(steps) else at
                    if open_[False] and not open_[True] and nxt > at:
                        if runs and runs[-1][1] == at:
                            runs[-1][1] = nxt
                        else:
                            runs.append([at, nxt])
                gone.append([{"start": a, "end": b} for a, b in runs])
                kept.append([{"start": a, "end": b} for a, b in zip([0, *[r[1] for r in runs]], [*[r[0] for r in runs], 2**31 - 1]) if b > a])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], pa.array(gone, kind), pa.array(kept, kind)], [*KEY, "removed", "kept"])

    spans = "array<struct<start:int,end:int>>"
    return map_arrow(seen.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end", "first")).alias("s")), run,
                     f"_no_id boolean, _id long, _digest long, removed {spans}, kept {spans}")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut and ``_removed``, the byte spans that went."""
    found = shared_table(pieces(docs, chunks), "chunks")
    groups = shared_table(found.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "chunks")
    suspect = shared_table(lookup_join(found, groups, ["d1", "d2"], "copies").select(*KEY, "d1", "d2", "start", "end"), "chunks")
    # the bytes of a suspect chunk, without the line feeds at its end
    seen = (docs.select(*key_columns(), "text").join(suspect, KEY)
            .withColumn("_b", F.expr("cast(substring(cast(text as binary), start + 1, end - start) as string)"))
            .select(*KEY, "d1", "d2", "start", "end", F.rtrim(F.col("_b"), F.lit("\n")).alias("body")))
    equal = (seen.groupBy("d1", "d2", "body").agg(F.min(F.struct(*KEY, "start")).alias("_first"), F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1"))
    several = F.count(F.lit(1)).over(Window.partitionBy("d1", "d2")) > 1  # different bytes under one digest
    equal = shared_table(equal.withColumn("body", F.when(several, F.col("body"))), "chunks")
    all_ = lookup_join(suspect, equal.filter("body is null").drop("body"), ["d1", "d2"], "copies")
    if not equal.filter("body is not null").isEmpty():
        all_ = all_.unionByName(seen.join(equal, ["d1", "d2", "body"]).drop("body"))
    return without_spans(docs, _cuts(all_.withColumn("first", F.struct(*KEY, "start") == F.col("_first"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text and the spans removed."""
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("_removed").cast("long").alias("n_removed"),
                      F.expr("aggregate(_removed, 0L, (a, x) -> a + x.end - x.start)").alias("bytes_removed"),
                      F.col("_removed").alias("removed"), "text")

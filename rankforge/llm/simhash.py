"""SimHash near-duplicates by pigeonring filtering.

A text's fingerprint has a bit for each of 64 positions at which over half of
its word shingles' XXH64 values have one.  Texts whose fingerprints differ in
at most four bits are linked; classes are the connected components.

Search, on distinct fingerprints only: the 64 bits are five segments on a ring.
If two fingerprints differ in at most 4 bits, then from some segment on, every
run of l consecutive segments has at most floor(4 l / 5) differences: 0 in the
first segment, 1 in the first two, 2 in three, 3 in four and 4 in all five.  So
the first segment is equal and the second, cut into four parts, is equal in
three of them; that makes 5 x 4 exact keys of about 23 bits.  With very many
fingerprints the third segment joins the key (at most two of its four parts
differ: 5 x 4 x 6 keys of about 29 bits); either way every link is found.  Each
pair that meets under a key is taken along the ring, segment by segment, and
dropped at the first run over its budget; a pair that is still in after the
fifth segment has passed the full Hamming check.

Buckets are cut into blocks, pairs never leave the task that compares them,
and a task passes on at most one link per row and bucket.

Defined results: null, empty and blank texts have fingerprint 0 and link like
any other; a text of fewer words than a shingle is one shingle; equal
fingerprints (repeated rows) are one class from the start; a class's id is its
smallest doc_id, null only if no member has one; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import (block_rows, connected_components, lookup_join, map_arrow, merge_labels, pair_steps,
                                  read, scan_groups, shared_table)

BITS = 64
#: Over so many distinct fingerprints three segments make the key.
WIDE_KEYS_FROM = 1 << 23
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes | None, words: int) -> int:
    """Of a whole text in UTF-8; as an unsigned integer."""
    parts = (text or b"").lower().split()  # both know ASCII only: A-Z, and blank with 0x09-0x0D
    if not parts:
        return 0
    flat = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        starts, ends = starts[:len(parts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())], dtype="<u8")
    lanes = h.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(lanes[:, j], minlength=256) @ _BYTE_BITS for j in range(8)])
    return sum(1 << j for j in np.flatnonzero(2 * ones > len(h)).tolist())


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp long, digest long): the fingerprint's 64 bits as a signed long
    and the text's XXH64, which with doc_id tells documents apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), batch.column(2)], ["doc_id", "fp", "digest"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), F.xxhash64("text").alias("digest"))
    return map_arrow(rows, run, "doc_id long, fp long, digest long")


def _segments(n: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(first bit, width) of n segments of nearly equal width."""
    cuts = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _kept(first: int, width: int, parts: int, dropped: tuple[int, ...]) -> int:
    """Mask of a segment without some of its parts."""
    return sum(((1 << w) - 1) << (first + a) for p, (a, w) in enumerate(_segments(parts, width)) if p not in dropped)


def ring_keys(segments: int, depth: int, parts: int = 4) -> list[int]:
    """64-bit masks: two fingerprints within ``segments - 1`` differing bits agree
    under one of them at least.  Number j of the run has at most j differences."""
    ring = _segments(segments)
    masks = []
    for i in range(segments):
        found = [_kept(*ring[i], 1, ())]
        for j in range(1, depth):
            seg = ring[(i + j) % segments]
            found = [m | _kept(*seg, parts, d) for m in found for d in combinations(range(parts), j)]
        masks += found
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, max_bits: int = 4, depth: int = 2) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints ``fp`` to hold
    every class of the ones within ``max_bits`` together."""
    segments = max_bits + 1
    masks = ring_keys(segments, depth)
    per_start = len(masks) // segments
    ring = np.array([((1 << w) - 1) << a for a, w in _segments(segments)], dtype=np.uint64)
    budget = [max_bits * length // segments for length in range(1, segments + 1)]
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).cast("int").alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v"))
        for i, m in enumerate(masks)]))
    keyed = distinct.select("fp", keys.alias("_key")).select("fp", "_key.k", "_key.v")

    def kernel(cols: dict[str, np.ndarray], gid: np.ndarray) -> Iterator[pa.RecordBatch]:
        fp = cols["fp"].view(np.uint64)
        start = cols["k"] // per_start
        label = np.arange(len(fp))
        for a, b in pair_steps(gid, cols["_b"], cols["_i"], cols["_k"]):
            differ = fp[a] ^ fp[b]
            at = start[a]
            run = np.zeros(len(a), dtype=np.int64)
            for length in range(segments):  # along the ring; out at the first run over its budget
                run += np.bitwise_count(differ & ring[(at + length) % segments])
                near = run <= budget[length]
                a, b, differ, at, run = a[near], b[near], differ[near], at[near], run[near]
            merge_labels(label, a, b)
        linked = np.flatnonzero(label != np.arange(len(fp)))
        if linked.size:
            yield pa.RecordBatch.from_arrays([pa.array(cols["fp"][linked]), pa.array(cols["fp"][label[linked]])], ["a", "b"])

    return scan_groups(block_rows(keyed, ["k", "v"], "fp"), ["k", "v", "_i", "_k"], kernel, "a long, b long", ["fp", "_b"])


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, digest, root, component_id) for every row of ``docs``; root
    is the smallest fingerprint of the class."""
    marked = shared_table(fingerprints(docs, words), "simhash")
    distinct = shared_table(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "simhash")
    depth = 2 if distinct.count() <= WIDE_KEYS_FROM else min(3, max_bits + 1)
    roots = connected_components(links(distinct.select("fp"), max_bits, depth)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("_in_root"))
    classes = shared_table(lookup_join(shared_table(rooted, "simhash"), shared_table(smallest, "simhash"), "root", "_in_root")
                           .select("fp", "copies", "root", "component_id"), "simhash")
    return lookup_join(marked, classes, "fp", "copies").select("doc_id", "fp", "digest", "root", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each class, in the columns of ``docs``: the one with the
    smallest doc_id (null only if no member has one); of several texts under
    that id the one with the smallest fingerprint, then digest.  Repeated rows of
    it count as one."""
    def named(id_: str, digest: Column) -> list[Column]:
        return [F.coalesce(F.col(id_).cast("long"), F.lit(0)).alias("_id"), F.col(id_).isNull().alias("_no_id"),
                digest.alias("_digest")]

    first = (near_duplicates(docs, words, max_bits).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("root").agg(F.min(F.struct("fp", "digest")).alias("_m"), F.first("component_id").alias("_kept_id")))
    kept = first.select(*named("_kept_id", F.col("_m.digest")))
    key = ["_id", "_no_id", "_digest"]
    return (docs.select("*", *named("doc_id", F.xxhash64("text"))).join(kept, key, "left_semi").dropDuplicates(key)
            .select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint (4-word shingles) and class (4 bits or fewer)."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")

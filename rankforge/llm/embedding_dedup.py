"""Embedding near-duplicates by random-hyperplane hashing.

Equal vectors of a label are one class from the start.  Each class gets, in
each of several tables, the signs of its scalar products with seeded random
hyperplanes; classes of one label that share a table's signs meet in a bucket.
Buckets are cut into blocks; where two classes meet, the cosine is taken in
double precision in the first table they share and nowhere else, so every link
is counted once and no pair ever leaves its task.  A task passes on link counts
and at most one link per row and bucket; components come from those links.

Two vectors at cosine c share a sign with probability 1 - arccos(c) / pi, so
at c = 0.98 and with 24 tables of 14 signs a pair is missed with probability
5e-6, and at 0.99 with 2e-8.

Defined results: a vector that is null, empty, zero or holds null or
non-finite components, and a vector without a label, has no links and is its
own component; only vectors of equal length are compared; repeated vec_ids are
separate rows but one node of the components; rows without vec_id have no
component and are not kept, yet count as links; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import (block_rows, connected_components, lookup_join, map_arrow, merge_labels, pair_steps,
                                  read, scan_groups, shared_table)

TABLES, SIGNS, SEED = 24, 14, 20240607


@cache
def planes(length: int, tables: int, signs: int) -> np.ndarray:
    return np.random.default_rng([SEED, length]).standard_normal((length, tables * signs))


def sign_codes(vectors: np.ndarray, tables: int, signs: int) -> np.ndarray:
    """(rows, tables) integers made of the signs."""
    bits = (vectors @ planes(vectors.shape[1], tables, signs) > 0).reshape(len(vectors), tables, signs)
    return bits @ (1 << np.arange(signs))


def usable(column: pa.Array) -> list[np.ndarray | None]:
    """Each list as doubles; None if it is null, empty, zero or not finite."""
    out: list[np.ndarray | None] = []
    for v in column.to_pylist():
        a = None if not v or any(x is None for x in v) else np.array(v, dtype=np.float64) + 0.0  # no negative zero
        out.append(a if a is not None and np.isfinite(a).all() and a.any() and np.isfinite(a @ a) and a @ a > 0 else None)
    return out


def packed(vectors: DataFrame, tables: int, signs: int) -> DataFrame:
    """(vec_id, label, vector, codes, length): doubles and sign codes as bytes, null if not usable."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = usable(batch.column(2))
            vector: list[bytes | None] = [None] * len(rows)
            codes: list[bytes | None] = [None] * len(rows)
            sizes = [0 if a is None else len(a) for a in rows]
            for length in set(sizes) - {0}:
                at = [i for i, n in enumerate(sizes) if n == length]
                m = np.stack([rows[i] for i in at])
                for i, code in zip(at, sign_codes(m, tables, signs)):
                    vector[i], codes[i] = rows[i].tobytes(), code.astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(vector, pa.binary()), pa.array(codes, pa.binary()),
                pa.array(sizes, pa.int32())], ["vec_id", "label", "vector", "codes", "length"])

    # lists of floats become lists of doubles here; their values stay the same
    cols = [F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")]
    return map_arrow(vectors.select(*cols), run, "vec_id long, label long, vector binary, codes binary, length int")


def bucket_links(classes: DataFrame, least: float, tables: int) -> DataFrame:
    """(node, peer, n): for classes (node, label, length, copies, vector, codes)
    the rows that a class links with under one bucket's blocks, and one of its links."""
    key = ["label", "length", "t", "code"]
    code = F.expr(f"transform(sequence(0, {tables - 1}), t -> struct(t, substring(codes, 4 * t + 1, 4) as code))")
    meet = classes.select("node", "label", "length", "copies", F.explode(code).alias("_c")).select(
        "node", "label", "length", "copies", "_c.t", F.conv(F.hex("_c.code"), 16, 10).cast("long").alias("code"))
    # classes alone in all their buckets go no further, so vectors travel only where something may be found
    laid = block_rows(meet, key, "node", 512).join(classes.select("node", "vector", "codes"), "node")

    def kernel(cols: dict[str, np.ndarray], gid: np.ndarray) -> Iterator[pa.RecordBatch]:
        for length in np.unique(cols["length"]).tolist():
            at = np.flatnonzero(cols["length"] == length)
            own = {c: v[at] for c, v in cols.items()}
            m = np.frombuffer(b"".join(own["vector"]), dtype=np.float64).reshape(len(at), length)
            unit = m / np.sqrt((m * m).sum(1))[:, None]
            codes = np.frombuffer(b"".join(own["codes"]), dtype="<i4").reshape(len(at), tables)
            label, n = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
            for a, b in pair_steps(gid[at], own["_b"], own["_i"], own["_k"], 1 << 14):
                first = (codes[a] == codes[b]).argmax(1) == own["t"][a]
                a, b = a[first], b[first]
                near = (unit[a] * unit[b]).sum(1) >= least
                a, b = a[near], b[near]
                np.add.at(n, a, own["copies"][b])
                np.add.at(n, b, own["copies"][a])
                merge_labels(label, a, b)
            hit = np.flatnonzero(n)
            if hit.size:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own["node"][hit]), pa.array(own["node"][label[hit]]), pa.array(n[hit])], ["node", "peer", "n"])

    return scan_groups(laid, [*key, "_i", "_k"], kernel, "node long, peer long, n long",
                       ["node", "copies", "vector", "codes", "_b"])


def near_duplicates(vectors: DataFrame, least: float = 0.98, tables: int = TABLES, signs: int = SIGNS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label)."""
    rows = packed(vectors, tables, signs)
    rows = shared_table(rows.withColumn("vector", F.when(F.col("label").isNotNull(), F.col("vector"))), "vectors")
    compared = rows.filter("vector is not null")
    # a class's node is a digest of label and vector: the smallest vec_id may be null or shared
    for seed in range(8):
        named = compared.withColumn("node", F.xxhash64("label", "vector", F.lit(seed)))
        classes = shared_table(named.groupBy("label", "length", "vector").agg(
            F.first("node").alias("node"), F.first("codes").alias("codes"), F.min("vec_id").alias("first"),
            F.count(F.lit(1)).alias("copies")), "vectors")
        if classes.groupBy("node").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("two different vectors have the same digest under every seed")
    links = shared_table(bucket_links(classes, least, tables), "links")
    others = links.groupBy("node").agg(F.sum("n").alias("others"))
    # rows that share a vec_id are one node of the components: they hold their classes together
    shared = (named.filter("vec_id is not null").groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("b"),
                                                                       F.count(F.lit(1)).alias("n")).filter("n > 1 and a <> b"))
    shared = shared.select("vec_id", "a").join(named.select("vec_id", "node"), "vec_id").select("a", F.col("node").alias("b"))
    edges = links.select(F.col("node").alias("a"), F.col("peer").alias("b")).unionByName(shared)
    roots = connected_components(edges).distinct()
    rooted = shared_table(classes.select("node", "first", "copies").join(roots, "node", "left")
                          .withColumn("root", F.coalesce("root", "node")), "vectors")
    smallest = shared_table(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("_in_root")), "vectors")
    told = shared_table(lookup_join(rooted, smallest, "root", "_in_root").join(others, "node", "left")
                        .select("node", "copies", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vectors")
    slim = shared_table(named.select("vec_id", "node"), "vectors")
    linked = lookup_join(slim, told, "node", "copies").select("vec_id", "n_links", "component_id")
    alone = rows.filter("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links at cosine 0.98 within its label, and its component."""
    return near_duplicates(read(spark, sf_dir, "embeddings"))

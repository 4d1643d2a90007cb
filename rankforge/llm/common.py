"""Helpers shared by the training-data operators: shared-storage tables, a
skew-proof lookup join, blocked bucket self-joins and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import checkpoint_dir, map_arrow, scratch_path

#: What counts as white space between words: blank and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_join(rows: DataFrame, table: DataFrame, key: str | list[str], count: str, hot_share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per key), safe when one
    key holds a third of all rows.

    ``table`` carries in ``count`` how many rows have its key.  A key with at
    least 1/``hot_share`` of all rows is hot; there are at most ``hot_share``
    of those, so they are broadcast and their rows are never shuffled.  All
    other keys are joined by a shuffle in which no key has more than that share.
    ``rows`` is read twice: hand over a stored table.
    """
    key = [key] if isinstance(key, str) else key
    total = table.agg(F.sum(count)).first()[0] or 0
    floor = max(1000, -(-total // hot_share))
    hot = F.broadcast(table.filter(F.col(count) >= floor))
    cold = table.filter(F.col(count) < floor)
    return rows.join(hot, key).unionByName(
        rows.join(F.broadcast(table.filter(F.col(count) >= floor).select(*key)), key, "left_anti").join(cold, key))


def block_rows(df: DataFrame, key: list[str], row_id: str, block: int = 1024) -> DataFrame:
    """Lay out a self-join within buckets so that no task holds a whole bucket.

    Buckets with one row vanish.  A bucket of n rows is cut into m = ceil(n /
    block) blocks by the row id's hash; every unordered pair of blocks becomes
    a group (``_i``, ``_k``) of about 2 x block rows, and each row goes, with
    its block ``_b``, to the m groups its block takes part in.  Only rows are
    shuffled, never pairs.
    """
    counts = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
              .withColumn("_m", F.ceil(F.col("_n") / F.lit(block)).cast("int")).drop("_n"))
    laid = (df.join(counts, key)
            .withColumn("_b", F.pmod(F.xxhash64(F.col(row_id), F.lit(7)), F.col("_m")).cast("int"))
            .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_m") - 1))))
    return (laid.withColumn("_i", F.least("_b", "_o")).withColumn("_k", F.greatest("_b", "_o")).drop("_o", "_m"))


def scan_groups(df: DataFrame, key: list[str], kernel: Callable[[dict[str, np.ndarray], np.ndarray], Iterator[pa.RecordBatch]],
                schema: str, columns: list[str]) -> DataFrame:
    """Run ``kernel`` over whole groups of ``df``.

    Rows are dealt by the group key and sorted by it; the kernel gets the
    columns of a run of whole groups and the group number of each row.  A run
    ends with the Arrow batch it is cut from, and the group cut by the end of a
    batch is carried over, so memory is one batch plus one group.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*key, *columns).repartition(parts, *key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def numbered(t: pa.Table) -> np.ndarray:
            new = np.zeros(t.num_rows, dtype=bool)
            for k in key:
                v = t.column(k).to_numpy()
                new[1:] |= v[1:] != v[:-1]
            return np.cumsum(new)

        def out(t: pa.Table, gid: np.ndarray) -> Iterator[pa.RecordBatch]:
            cols = {c: (t.column(c).to_numpy() if not pa.types.is_binary(t.schema.field(c).type)
                        else np.array(t.column(c).to_pylist(), dtype=object)) for c in [*key, *columns]}
            yield from kernel(cols, gid)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            if not t.num_rows:
                continue
            gid = numbered(t)
            cut = int(np.searchsorted(gid, gid[-1]))
            rest = t.slice(cut)
            if cut:
                yield from out(t.slice(0, cut), gid[:cut])
        if rest is not None and rest.num_rows:
            yield from out(rest, np.zeros(rest.num_rows, dtype=np.int64))

    return map_arrow(dealt, run, schema)


def pair_steps(gid: np.ndarray, block: np.ndarray | None, i: np.ndarray | None, k: np.ndarray | None,
               most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (a, b), a < b, of rows in the same group, at most ``most`` at
    a time.  In a group made of two different blocks only pairs across them
    count: the pairs within a block belong to the group (block, block)."""
    act = np.arange(len(gid) - 1)
    step = 1
    while act.size:
        act = act[act + step < len(gid)]
        act = act[gid[act] == gid[act + step]]
        for at in range(0, len(act), most):
            a = act[at:at + most]
            b = a + step
            if block is not None:
                keep = (i[a] == k[a]) | (block[a] != block[b])
                a, b = a[keep], b[keep]
            if a.size:
                yield a, b
        step += 1


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the classes of a[j] and b[j] in place; labels are row indexes and
    every class carries its smallest."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): root is the
    smallest node reachable.

    Alternates two star operations, as published for map-reduce connected
    components: link every larger neighbour, then every smaller one, to the
    smallest neighbour, until the graph is stars.  Each is a grouped minimum and
    a join back, so no group is ever collected; a node with a third of all
    edges is one partial aggregate and a join that adaptive execution splits.
    Every round is written to the shared checkpoint folder.
    """
    def minimum(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))

    def state(e: DataFrame) -> tuple[int, int]:
        """Nodes that break a star, and edges."""
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        bad = F.sum(F.expr("if(up > 1 or (up > 0 and down > 0), 1, 0)"))
        r = sums.coalesce(tasks).agg(bad, F.sum("up")).first()
        return r[0] or 0, r[1] or 0

    # the graph shrinks round by round: a task for so many edges, not one for every shuffle partition
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = most
    e = shared_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct(), "components")
    for _ in range(rounds):
        bad, n = state(e)
        tasks = max(8, min(most, n // 50_000))
        if not bad:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(minimum(both), "u").coalesce(tasks).filter("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(minimum(large), "u").coalesce(tasks)
        star = F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m"))))
        e = shared_table(small.select(star.alias("s")).select("s.u", F.col("s.m").alias("v")).filter("u <> v").distinct()
                         .coalesce(tasks), "components")
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

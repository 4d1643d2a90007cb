"""Sharding along a Hilbert curve [native].

Several metadata dimensions are quantised to 2^bits levels each, every row
gets the index of its cell on the Hilbert curve, rows are ordered by that
index, and the order is cut into runs of equal row counts.  Neighbouring cells
lie in the same or in neighbouring shards, so the minimum and maximum that a
file keeps of *each* dimension stay narrow and filters on any of them prune.

Only DataFrame functions; nothing but row counts and the at most 2^bits values
at which each dimension is cut reaches the driver.

Defined results: a null or empty text has size 1 and checksum 0; a null source
or language has a level of its own, before all others; repeated rows each get a slot of
their own; rows that tie on the curve are ordered by the MD5 of their id (null
id: of the empty string), then id, size and checksum; an empty table gives an
empty result.  Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import read, shared_table


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Lookup tables of the curve: for state * 2^dims + corner, the digit along
    the curve and the next state.  A state is direction * 2^dims + entry corner;
    both follow from the reflected Gray code (published compact-Hilbert rule)."""
    corners, mask = 1 << dims, (1 << dims) - 1

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def ungray(g: int) -> int:
        i = g
        while g := g >> 1:
            i ^= g
        return i

    def rot(x: int, by: int) -> int:  # to the left
        by %= dims
        return ((x << by) | (x >> (dims - by))) & mask

    def ones(i: int) -> int:  # trailing set bits
        n = 0
        while i & 1:
            n, i = n + 1, i >> 1
        return n

    def entry(w: int) -> int:
        return 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def direction(w: int) -> int:
        return 0 if w == 0 else ones(w - 1 if w % 2 == 0 else w) % dims

    digit, after = [], []
    for state in range(dims * corners):
        d, e = divmod(state, corners)
        for corner in range(corners):
            w = ungray(rot(corner ^ e, -(d + 1)))
            digit.append(w)
            after.append(((d + direction(w) + 1) % dims) * corners + (e ^ rot(entry(w), d + 1)))
    return digit, after


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """Index on the curve of a cell given by one integer in [0, 2^bits) per dimension."""
    n = len(levels)
    digit, after = (F.array(*[F.lit(x) for x in t]) for t in curve_tables(n))

    def step(acc: Column, bit: Column) -> Column:
        corner = sum(((F.call_function("shiftright", v, bit)).bitwiseAND(1) * F.lit(1 << j) for j, v in enumerate(levels)),
                     F.lit(0))
        at = (acc["s"] * F.lit(1 << n) + corner + 1).cast("int")
        return F.struct(F.element_at(after, at).cast("int").alias("s"),
                        (acc["h"] * F.lit(1 << n) + F.element_at(digit, at)).cast("long").alias("h"))

    start = F.struct(F.lit(0).cast("int").alias("s"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)]), start, step, lambda acc: acc["h"])


def level_cuts(rows: DataFrame, value: str, before: int, n: int, steps: int) -> list:
    """(level, smallest value) of the levels in use when the ``n`` rows with a value are cut at
    equal row counts into ``steps`` levels from ``before`` on.  Distinct values are counted and
    dealt out by range, so that running sums need no single task, however many there are."""
    counts = shared_table(rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n")), "hilbert")
    ranged = shared_table(counts.repartitionByRange(value).withColumn("_p", F.spark_partition_id()), "hilbert")
    ranges = ranged.groupBy("_p").agg(F.sum("_n").alias("_s"))  # one row for each partition
    ranges = ranges.select("_p", (F.sum("_s").over(Window.orderBy("_p")) - F.col("_s")).alias("_start"))
    smaller = F.sum("_n").over(Window.partitionBy("_p").orderBy(value)) - F.col("_n") + F.col("_start")
    levels = (ranged.join(F.broadcast(ranges), "_p").withColumn("_smaller", smaller)
              .withColumn("_level", F.expr(f"cast((_smaller * {steps}L) div {n}L as int) + {before}")))
    return sorted(tuple(r) for r in levels.groupBy("_level").agg(F.min(value)).collect())


def level_of(rows: DataFrame, value: str, n_all: int, n: int, bits: int) -> Column:
    """Level in [0, 2^bits) of a value; null, where there is one, has level 0 to itself."""
    null = int(n < n_all)
    out = F.lit(0)
    for level, least in level_cuts(rows, value, null, n, (1 << bits) - null) if n else []:
        least = bytes(least) if isinstance(least, bytearray) else least
        out = F.when(F.col(value) >= F.lit(least), F.lit(level)).otherwise(out)
    return out.cast("int")


def hilbert_shards(rows: DataFrame, dims: dict[str, Column], tie: Column, keep: list[str], n_shards: int = 16,
                   bits: int = 4) -> DataFrame:
    """Add ``shard`` (int), ``slot`` (long, gapless from 0 in each shard) and
    ``hilbert`` (long) to the columns ``keep`` of ``rows``.

    ``dims``: expressions with an order.  The rows of each distinct value are
    counted and the values cut at equal row counts into 2^bits levels, so a
    level is a range of values and a hot value has one level; null has its own.
    Shards differ by at most one row.  ``rows`` is read several times:
    hand over a stored table.

    Ranks need no global sort: cell and the first byte of the tie break make
    buckets (a cell with a third of all rows has 256 of them), whose offsets
    come from grouped counts; rows are numbered within their bucket.
    """
    raw = rows.select(*keep, *[v.alias(f"_v{i}") for i, v in enumerate(dims.values())],
                      F.md5(F.coalesce(tie.cast("string"), F.lit("")).cast("binary")).alias("_tie"))
    given = raw.agg(F.count(F.lit(1)).alias("n"), *[F.count(f"_v{i}").alias(f"n{i}") for i in range(len(dims))]).first()
    n = given["n"]
    if not n:
        return raw.select(*keep, F.lit(0).cast("int").alias("shard"), F.lit(0).cast("long").alias("slot"),
                          F.lit(0).cast("long").alias("hilbert"))
    levels = raw.withColumns({f"_l{i}": level_of(raw, f"_v{i}", n, given[f"n{i}"], bits) for i in range(len(dims))})
    placed = levels.select(*keep, "_tie", hilbert_index([F.col(f"_l{i}") for i in range(len(dims))], bits).alias("hilbert"),
                           F.conv(F.substring("_tie", 1, 2), 16, 10).cast("int").alias("_sub"))
    counts = placed.groupBy("hilbert", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    cells = counts.groupBy("hilbert").agg(F.sum("_n").alias("_c"))  # at most 2^(bits * dims) rows
    cells = cells.select("hilbert", (F.sum("_c").over(Window.orderBy("hilbert")) - F.col("_c")).alias("_cell"))
    offsets = (counts.withColumn("_in", F.sum("_n").over(Window.partitionBy("hilbert").orderBy("_sub")) - F.col("_n"))
               .join(F.broadcast(cells), "hilbert").select("hilbert", "_sub", (F.col("_cell") + F.col("_in")).alias("_offset")))
    rank = (F.row_number().over(Window.partitionBy("hilbert", "_sub").orderBy("_tie", *keep)) - 1).cast("long")
    return (placed.join(offsets, ["hilbert", "_sub"]).withColumn("_rank", rank + F.col("_offset"))
            .withColumn("shard", F.expr(f"cast((_rank * {n_shards}L) div {n}L as int)"))
            .withColumn("slot", F.expr(f"_rank - ((shard * {n}L + {n_shards - 1}L) div {n_shards}L)"))
            .select(*keep, "shard", "slot", "hilbert"))


def shard_documents(docs: DataFrame, n_shards: int = 16, bits: int = 4) -> DataFrame:
    """All documents over source, language and size (64 steps of its logarithm for each doubling)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = shared_table(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.col("source").cast("binary").alias("_source"), F.col("lang").cast("binary").alias("_lang")), "hilbert")
    dims = {"source": F.col("_source"), "lang": F.col("_lang"), "size": F.floor(F.log2("size") * 64).cast("long")}
    return hilbert_shards(narrow, dims, F.col("doc_id"), ["doc_id", "size", "text_crc32"], n_shards, bits)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards whose row counts differ by at most one."""
    return shard_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert")

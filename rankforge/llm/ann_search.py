"""Nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

The largest inner product is the smallest distance once every vector gets one
more component, sqrt(M^2 - |x|^2) with M the largest norm (a query gets 0).  The
lists' centres come from k-means on a bounded sample; every row is then
assigned to its list.  Vectors are rotated at random, so any prefix of their
columns is a fair sample of all.  A query scans the few lists nearest to it
first, which gives it a bound, and then every list but those that are unlikely
to hold a nearer row (``chosen_lists``).  Within a list the squared distance is
summed up over blocks of columns, and after each block a hypothesis test
compares the partial sum, scaled to all columns, with the distance of the
query's k-th best so far: candidates that are very unlikely to beat it are
abandoned.  Survivors are scored by the inner product of the original vectors
in double precision.

Lists and their queries are cut into blocks, so no task holds a whole list;
every block hands on the k best of each query and a window merges them.

Defined results: rows without vec_id take no part; nor do vectors that are
null, empty, zero or hold null or non-finite components, nor those of another
length than the most frequent one (the smaller on a tie); rows that share the
query's vec_id are its own; of several rows with one query id the vector
smallest in bytes asks; equal scores go to the smaller vec_id; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import map_arrow, read, scan_groups, shared_table
from rankforge.llm.embedding_dedup import usable

SEED = 20240611
#: Rows the centres are fitted on, at most; lists, at most; share of the lists a query visits first, for its
#: bound; share of the rows within that bound that the lists it skips are expected to hold.
SAMPLE_ROWS, LISTS_MOST, FIRST, LOSS = 20_000, 1024, 0.05, 0.05
#: Rotated columns summed up between two tests; the test's margin: a row is
#: abandoned if its scaled partial distance is over (1 + MARGIN / sqrt(columns seen)) times the k-th best.
COLUMNS, MARGIN = 16, 2.1
#: Rows and queries of a list that one block holds.
ROWS, QUERIES = 4096, 512


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def fit_centres(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """k-means on the sample: seeded start, empty lists keep their centre."""
    rng = np.random.default_rng(SEED)
    centres = sample[np.sort(rng.choice(len(sample), lists, replace=False))].copy()
    for _ in range(rounds):
        own = nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=lists)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, nearest first."""
    far = (centres * centres).sum(1) - 2 * rows @ centres.T
    return np.argmin(far, 1)[:, None] if n == 1 else np.argsort(far, 1, kind="stable")[:, :n]


def spread_columns(sample: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per list, over how many directions the sample's rows spread around its
    centre: (tr C)^2 / tr C^2 of their scatter C, at least 1."""
    own = nearest(sample, centres, 1)[:, 0]
    out = np.ones(len(centres))
    for i in range(len(centres)):
        x = sample[own == i] - centres[i]
        c = x.T @ x if len(x) > x.shape[1] else x @ x.T
        if len(x) and np.trace(c) > 0:
            out[i] = max(1.0, np.trace(c) ** 2 / (c * c).sum())
    return out


def chosen_lists(far: np.ndarray, bound: np.ndarray, seen: np.ndarray, lists: dict[str, np.ndarray], k: int, loss: float) -> np.ndarray:
    """(queries, lists) booleans: the lists to scan after those ``seen``.

    ``far`` is the squared distance of query and centre, ``bound`` that of the
    query's k-th best so far.  A row r away from its centre lies at far + r^2 -
    2 sqrt(far) r cos(angle); over the list's rows this has mean far + mean r^2
    and, by the number of directions they spread over, a known variance.  The
    normal upper tail bound of falling under ``bound`` times the rows is the
    number of rows the list is expected to add.  The lists seen hold k rows
    within the bound; the lists that add least are skipped as long as all
    skipped ones together add at most the share ``loss`` of these k and all
    that is expected.  A list whose farthest row cannot come near enough adds
    nothing.  A query without a bound skips no list.
    """
    mean, dev = far + lists["mean"], np.sqrt(lists["var"] + 4 * far * lists["mean"] / lists["spread"])
    z = np.maximum((mean - bound[:, None]) / np.maximum(dev, 1e-12), 1e-12)
    adds = lists["rows"] * np.exp(-np.minimum(z * z / 2, 700)) * np.minimum(0.5, 1 / (z * np.sqrt(2 * np.pi)))
    with np.errstate(invalid="ignore"):
        adds[np.sqrt(far) - np.sqrt(lists["most"]) > np.sqrt(bound)[:, None] + 1e-9] = 0
    adds[seen] = 0
    spare = loss * (k + adds.sum(1, keepdims=True))
    order = np.argsort(adds, 1, kind="stable")
    skip = np.empty(adds.shape, dtype=bool)
    np.put_along_axis(skip, order, np.cumsum(np.take_along_axis(adds, order, 1), 1) <= spare, 1)
    skip[np.isinf(bound)] = False
    return ~skip & ~seen


def scan_block(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) index pairs that survive the adaptive scan of rotated
    vectors.  ``own`` marks pairs that must not meet; ``bound`` is each query's
    squared distance of the k-th best so far (infinite if not known)."""
    size = rows.shape[1]
    cuts = [*range(COLUMNS, size, COLUMNS), size]
    n = cuts[0]
    part = (queries[:, :n] ** 2).sum(1)[:, None] + (rows[:, :n] ** 2).sum(1) - 2 * queries[:, :n] @ rows[:, :n].T
    part[own] = np.inf
    new = np.flatnonzero(np.isinf(bound))
    if new.size and len(rows) > k:
        # the k that look nearest after the first columns: their distances bound the k-th best
        look = np.argpartition(part[new], k - 1, axis=1)[:, :k]
        full = ((queries[new][:, None, :] - rows[look]) ** 2).sum(2)
        full[own[new[:, None], look]] = np.inf
        bound = bound.copy()
        bound[new] = full.max(1)
    bound = bound * (1 + 1e-9) + 1e-9  # rounding must not lose a row at the bound itself
    q, r = np.nonzero(part * (size / n) <= (bound * (1 + MARGIN / np.sqrt(n)) ** 2)[:, None])
    mine = ~own[q, r]
    q, r = q[mine], r[mine]
    some = part[q, r]
    for a, b in zip(cuts, cuts[1:]):
        some = some + ((queries[q, a:b] - rows[r, a:b]) ** 2).sum(1)
        margin = 1.0 if b == size else (1 + MARGIN / np.sqrt(b)) ** 2
        near = some * (size / b) <= bound[q] * margin
        q, r, some = q[near], r[near], some[near]
    return q, r


def best_of(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best of each query: highest score, then smaller id."""
    order = np.lexsort((ids, -score, q))
    first = np.flatnonzero(np.diff(q[order], prepend=-1))
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[place < k]


def search(vectors: DataFrame, asks: Column, k: int = 20, loss: float = LOSS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row of (vec_id, embedding) that ``asks``.

    Each query first scans the few lists nearest to it; the k-th best score
    found there is the bound it takes to the other lists; those that are
    expected to hold the share ``loss`` of the rows within it are skipped.
    """
    spark = vectors.sparkSession
    # single precision is kept as it came; everything is computed in double
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = usable(batch.column(2))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([None if a is None else a.astype(kind).tobytes() for a in rows], pa.binary()),
                pa.array([0 if a is None else len(a) for a in rows], pa.int32()),
                pa.array([0.0 if a is None else float(a @ a) for a in rows])], ["vec_id", "asks", "vector", "length", "norm2"])

    named = vectors.select(F.col("vec_id").cast("long"), F.coalesce(asks, F.lit(False)).alias("asks"),
                           F.col("embedding").cast("array<double>")).filter("vec_id is not null")
    stored = shared_table(map_arrow(named, pack, "vec_id long, asks boolean, vector binary, length int, norm2 double")
                          .filter("vector is not null"), "ann")
    lengths = stored.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("m")).orderBy(F.desc("n"), "length").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total, most = lengths["length"], lengths["n"], lengths["m"]
    usable_rows = stored.filter(F.col("length") == size)
    # a bounded sample by the rows' hash: the SAMPLE_ROWS smallest, so it is the same in every run
    picked = (usable_rows.withColumn("h", F.xxhash64("vec_id", F.lit(SEED)))
              .filter(F.pmod("h", F.lit(1 << 20)) < min(1 << 20, (2 * SAMPLE_ROWS << 20) // total + 1))
              .orderBy("h", "vector").limit(SAMPLE_ROWS).select("vector").collect())

    def matrix(raw: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), size).astype(np.float64)

    def extended(m: np.ndarray, ask: bool) -> np.ndarray:
        more = np.zeros(len(m)) if ask else np.sqrt(np.maximum(most - (m * m).sum(1), 0))
        return np.column_stack([m, more])

    sample = extended(matrix([r[0] for r in picked]), False)
    lists = max(1, min(LISTS_MOST, int(total ** 0.5 / 2), len(sample)))
    first = int(np.ceil(lists * FIRST))
    fitted = fit_centres(sample, lists)
    index = spark.sparkContext.broadcast((fitted, rotation(size + 1)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, _ = index.value
        for batch in batches:
            if not batch.num_rows:
                continue
            m = matrix(batch.column(2).to_pylist())
            ask = np.array(batch.column(1).to_pylist(), dtype=bool)
            visit = np.array([None] * len(m), dtype=object)
            for i, x in zip(np.flatnonzero(ask), nearest(extended(m[ask], True), centres, first) if ask.any() else ()):
                visit[i] = x.reshape(-1)
            x = extended(m, False)
            own = nearest(x, centres, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(own, pa.int32()), pa.array(((x - centres[own]) ** 2).sum(1)),
                pa.array(visit.tolist(), pa.list_(pa.int32()))], ["vec_id", "vector", "list", "away", "visits"])

    listed = shared_table(map_arrow(usable_rows.select("vec_id", "asks", "vector"), assign,
                                    "vec_id long, vector binary, list int, away double, visits array<int>"), "ann")
    rows = listed.select("vec_id", "vector", "list")
    one = Window.partitionBy("vec_id").orderBy("vector")
    queries = shared_table(listed.filter("visits is not null").withColumn("_one", F.row_number().over(one)).filter("_one = 1")
                           .select("vec_id", "vector", "visits"), "ann")

    def kernel(cols: dict[str, np.ndarray], gid: np.ndarray) -> Iterator[pa.RecordBatch]:
        turn = index.value[1]
        cuts = np.flatnonzero(np.diff(gid, prepend=-1, append=gid[-1] + 1))
        for a, b in zip(cuts, cuts[1:]):
            ask = cols["asks"][a:b].astype(bool)
            qi, ri = a + np.flatnonzero(ask), a + np.flatnonzero(~ask)
            if not qi.size or not ri.size:
                continue
            left, right = matrix([*cols["vector"][qi]]), matrix([*cols["vector"][ri]])
            ids, floor = cols["vec_id"][ri], cols["floor"][qi]
            own = cols["vec_id"][qi][:, None] == ids
            # of unit k-th score s the squared distance is |q|^2 + M^2 - 2 s
            q, r = scan_block(extended(left, True) @ turn, extended(right, False) @ turn, own, (left * left).sum(1) + most - 2 * floor, k)
            if not q.size:
                continue
            score = np.concatenate([(left[q[i:i + 65536]] * right[r[i:i + 65536]]).sum(1) for i in range(0, len(q), 65536)])
            near = score >= floor[q]
            q, r, score = q[near], r[near], score[near]
            best = best_of(q, ids[r], score, k)
            if best.size:
                yield pa.RecordBatch.from_arrays([pa.array(cols["vec_id"][qi][q[best]]), pa.array(ids[r[best]]), pa.array(score[best])],
                                                 ["query_id", "vec_id", "score"])

    def scan(asking: DataFrame) -> DataFrame:
        """Of queries (vec_id, vector, floor, list) and all rows of their lists; blocks of both meet."""
        # at most LISTS_MOST rows
        plan = F.broadcast(rows.groupBy("list").agg(F.count(F.lit(1)).alias("_rows")).join(
            asking.groupBy("list").agg(F.count(F.lit(1)).alias("_queries")), "list").select(
            "list", F.ceil(F.col("_rows") / ROWS).cast("int").alias("_mr"), F.ceil(F.col("_queries") / QUERIES).cast("int").alias("_mq")))

        def laid(df: DataFrame, mine: str, own: str, theirs: str, other: str) -> DataFrame:
            return (df.join(plan, "list").withColumn(mine, F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col(own)).cast("int"))
                    .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                    .select("list", "r", "q", F.lit(mine == "q").alias("asks"), "vec_id", "vector", "floor"))

        blocks = laid(rows.withColumn("floor", F.lit(0.0)), "r", "_mr", "q", "_mq").unionByName(laid(asking, "q", "_mq", "r", "_mr"))
        return scan_groups(blocks, ["list", "r", "q"], kernel, "query_id long, vec_id long, score double",
                           ["asks", "vec_id", "vector", "floor"])

    def ranked(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k)

    unknown = F.lit(float("-inf"))
    near = shared_table(ranked(scan(queries.select("vec_id", "vector", unknown.alias("floor"),
                                                   F.explode("visits").alias("list")))).drop("rank"), "ann")
    if lists > first:
        floors = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        about = {name: np.zeros(lists) for name in ("rows", "mean", "var", "most")}
        # at most LISTS_MOST rows
        for r in listed.groupBy("list").agg(F.count(F.lit(1)).alias("rows"), F.avg("away").alias("mean"), F.var_pop("away").alias("var"),
                                            F.max("away").alias("most")).collect():
            for name in about:
                about[name][r["list"]] = r[name]
        about["spread"] = spread_columns(sample, fitted)
        known = spark.sparkContext.broadcast(about)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, _ = index.value
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    batch = whole.slice(at, 1024)
                    q = extended(matrix(batch.column(1).to_pylist()), True)
                    floor = batch.column(2).to_numpy(zero_copy_only=False)
                    norm = (q * q).sum(1)
                    seen = np.zeros((len(q), lists), dtype=bool)
                    for i, x in enumerate(batch.column(3).to_pylist()):
                        seen[i, x] = True
                    far = np.maximum(norm[:, None] + (centres * centres).sum(1) - 2 * q @ centres.T, 0)
                    scans = chosen_lists(far, np.maximum(norm + most - 2 * floor, 0), seen, known.value, k, loss)
                    i, chosen = np.nonzero(scans)
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(i)) for c in range(3)], pa.array(chosen, pa.int32())],
                                                     ["vec_id", "vector", "floor", "list"])

        bounded = queries.join(floors, "vec_id", "left").select("vec_id", "vector", F.coalesce("floor", unknown).alias("floor"), "visits")
        rest = shared_table(map_arrow(bounded, choose, "vec_id long, vector binary, floor double, list int"), "ann")
        near = near.unionByName(scan(rest))
    return ranked(near).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20, against all rows."""
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

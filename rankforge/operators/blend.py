"""Blending and weight search.

Weight search is re-aimed from a sequential simplex solver to a *batched
lattice search*: one pass over the rows bounds the AUC of every candidate
weight vector of a simplex lattice by histograms, and the few candidates that
can still win get their exact AUC.  Refinement rounds shrink the lattice around
the winner; it is held against every single model, so "blend >= best single
model" holds by construction.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.columns import logit, rnd, sigmoid
from rankforge.operators.joins import null_safe_join
from rankforge.operators.metrics import auc_by, auc_columns, row_loss
from rankforge.operators.rank import percentile_rank_columns
from rankforge.schema import LOGLOSS_CLIP
from rankforge.session import cut_lineage, map_arrow

#: Bins of the first bounding pass; they decide how many candidates it leaves, not the result.
N_BINS = 4096
#: Counters (candidates x bins) of a finer pass over the candidates that are left.
CELLS = 1 << 20
#: Rows of a candidate in a range of scores that is sorted by itself.
RANGE_ROWS = 1 << 18


# ---------------------------------------------------------------------------------
# Fixed blends
# ---------------------------------------------------------------------------------
def uniform_blend(cols: list[str]) -> Column:
    """Plain mean of the columns."""
    acc = F.col(cols[0])
    for c in cols[1:]:
        acc = acc + F.col(c)
    return acc / F.lit(float(len(cols)))


def weighted_blend(cols: list[str], weights) -> Column:
    """sum_i w_i * col_i with literal weights (or weight columns)."""
    acc = None
    for c, w in zip(cols, weights):
        term = (w if isinstance(w, Column) else F.lit(float(w))) * F.col(c)
        acc = term if acc is None else acc + term
    return acc


def two_stage_blend(tree_cols: list[str], tree_w, other: str, alpha: float) -> Column:
    """X4 scoring: alpha * sum(w_tree r_tree) + (1 - alpha) * r_other."""
    return F.lit(float(alpha)) * weighted_blend(tree_cols, tree_w) + F.lit(1.0 - float(alpha)) * F.col(other)


# ---------------------------------------------------------------------------------
# candidate lattices
# ---------------------------------------------------------------------------------
def simplex_lattice(m: int, divisions: int) -> list[tuple[float, ...]]:
    """All weight vectors with components k/divisions, k >= 0, summing to 1 (fixed order)."""
    out = []
    for ks in itertools.product(range(divisions + 1), repeat=m):
        if sum(ks) == divisions:
            out.append(tuple(k / divisions for k in ks))
    return out


def local_lattice(center, step: float, radius: int = 2) -> list[tuple[float, ...]]:
    """Simplex points around ``center`` on a finer grid (clipped to w >= 0, sum = 1)."""
    m = len(center)
    pts = set()
    for deltas in itertools.product(range(-radius, radius + 1), repeat=m - 1):
        w = [center[i] + deltas[i] * step for i in range(m - 1)]
        last = 1.0 - sum(w)
        w.append(last)
        if all(x >= -1e-12 for x in w):
            pts.add(tuple(round(max(x, 0.0), 10) for x in w))
    return sorted(pts)


# ---------------------------------------------------------------------------------
# Batched lattice search
# ---------------------------------------------------------------------------------
def _scores(w: np.ndarray, ranks: list[np.ndarray], alpha: np.ndarray | None, other: np.ndarray | None) -> np.ndarray:
    """(rows, candidates) blend scores, added up in the order of the columns as SQL does."""
    s = ranks[0][:, None] * w[:, 0]
    for j in range(1, len(ranks)):
        s = s + ranks[j][:, None] * w[:, j]
    return s if alpha is None else alpha * s + (1.0 - alpha) * other[:, None]


def lattice_bounds(df: DataFrame, rank_cols: list[str], label: str, cands: list[tuple], strata=(),
                   other: str | None = None, loss: bool = False, n_bins: int = N_BINS, ids: list[int] | None = None) -> DataFrame:
    """(strata..., cand, low, high, log_loss, edges, widest): bounds of every candidate's AUC from ONE pass.

    Every partition counts positives and negatives per candidate and bin of the
    score in one array (candidates x bins x 2, whatever its rows), and the
    arrays are added up per candidate.  Pairs in different bins are ordered, so
    the AUC lies within half the pairs that share a bin of the binned value.
    ``edges`` (binary, int32) are the first bins of score ranges of about ``RANGE_ROWS`` rows
    behind the first range; ``widest`` has the rows of the largest.
    ``ids``: the numbers of ``cands``, if they are not all of them.
    """
    strata = list(strata)
    ids = list(range(len(cands))) if ids is None else ids
    w = np.array([c[0] for c in cands], dtype=np.float64)
    alpha = None if other is None else np.array([c[1] for c in cands], dtype=np.float64)
    size = len(cands)
    cols = [F.col(c).cast("double").alias(f"_r{j}") for j, c in enumerate([*rank_cols, *([other] if other else [])])]
    rows = df.select(*strata, F.col(label).cast("int").alias("_y"), *cols)
    rows = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in rows.columns[len(strata) + 1:]])
                      & F.col("_y").isNotNull())
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:len(strata)])
    names = [*strata, "cand", "h", "loss"]

    def count(batches):
        total: dict[tuple, list] = {}

        def flush(held: list) -> None:
            if held[2]:
                held[0] += np.bincount(np.concatenate(held[2]), minlength=size * n_bins * 2)
                held[2], held[3] = [], 0

        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(strata))])) if strata else [()] * batch.num_rows
            y = batch.column(len(strata)).to_numpy()
            ranks = [batch.column(len(strata) + 1 + j).to_numpy() for j in range(len(rank_cols) + bool(other))]
            for key in dict.fromkeys(keys):
                mine = np.flatnonzero(np.array([k == key for k in keys])) if len(set(keys)) > 1 else np.arange(len(y))
                held = total.setdefault(key, [np.zeros(size * n_bins * 2, dtype=np.int64), np.zeros(size), [], 0])
                for at in range(0, len(mine), 4096):
                    own = mine[at:at + 4096]
                    r = [x[own] for x in ranks]
                    s = _scores(w, r[:len(rank_cols)], alpha, r[-1])
                    bins = np.clip(np.floor(s * n_bins), 0, n_bins - 1).astype(np.int64)
                    held[2].append(((np.arange(size) * n_bins + bins) * 2 + y[own][:, None]).ravel())
                    held[3] += bins.size
                    if held[3] >= CELLS:                      # an addition of whole arrays pays for as many rows' counts
                        flush(held)
                    if loss:
                        p = np.clip(s, LOGLOSS_CLIP, 1.0 - LOGLOSS_CLIP)
                        held[1] += -np.where(y[own][:, None] == 1, np.log(p), np.log(1.0 - p)).sum(0)
        for key, held in total.items():
            flush(held)
            h, lost = held[:2]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k] * size, batch.schema.field(i).type) for i, k in enumerate(key)], pa.array(ids, pa.int32()),
                 pa.array([x.tobytes() for x in h.reshape(size, -1)], pa.binary()), pa.array(lost)], names)

    def add_up(batches):
        held: dict[tuple, list] = {}
        types: list = []
        for batch in batches:
            types = [f.type for f in batch.schema]
            for *key, h, lost in zip(*[c.to_pylist() for c in batch.columns]):
                mine = held.setdefault(tuple(key), [np.zeros(n_bins * 2, dtype=np.int64), 0.0])
                mine[0] += np.frombuffer(h, dtype=np.int64)
                mine[1] += lost
        out: list[list] = [[] for _ in names[:-2]] + [[], [], [], [], []]
        for key, (h, lost) in held.items():
            neg, pos = h.reshape(-1, 2).T.astype(np.float64)
            pairs = pos.sum() * neg.sum()
            base, slack = float((pos * (np.cumsum(neg) - neg / 2)).sum()), float((pos * neg).sum() / 2)
            got = [*key, (base - slack) / pairs, (base + slack) / pairs, lost / float(h.sum())] if pairs else [*key, None, None, None]
            both = h.reshape(-1, 2).sum(1)
            at = (np.cumsum(both) - both) // RANGE_ROWS
            got += [(np.flatnonzero(np.diff(at)) + 1).astype(np.int32).tobytes(), int(np.bincount(at, both).max())]
            for column, x in zip(out, got):
                column.append(x)
        if held:
            kinds_out = [*types[:-2], pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds_out)], [*names[:-2], "low", "high", "log_loss", "edges", "widest"])

    parts = map_arrow(rows, count, f"{kinds}cand int, h binary, loss double").repartition(*strata, "cand")
    return map_arrow(parts, add_up, f"{kinds}cand int, low double, high double, log_loss double, edges binary, widest long")


def range_counts(scores: np.ndarray, y: np.ndarray, edges: np.ndarray, n_bins: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(range, values, rows, positives) of the distinct scores, ascending; NaN is the largest value, as in Spark."""
    order = np.argsort(scores)
    v, first = scores[order], np.ones(len(scores), dtype=bool)
    first[1:] = (v[1:] != v[:-1]) & ~(np.isnan(v[1:]) & np.isnan(v[:-1]))
    at = np.flatnonzero(first)
    values, n, npos = v[at], np.diff(at, append=len(v)), np.add.reduceat(y[order], at)
    bins = np.clip(np.floor(np.nan_to_num(values, nan=1.0) * n_bins), 0, n_bins - 1).astype(np.int64)
    cuts = [0, *np.searchsorted(bins, edges, side="left"), len(values)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            yield i, values[a:b], n[a:b], npos[a:b]


def lattice_auc(df: DataFrame, rank_cols: list[str], label: str, cands: list[tuple], alive: dict[tuple, dict[int, np.ndarray]], n_bins: int,
                strata=(), other: str | None = None) -> DataFrame:
    """(strata..., cand, auc): the exact AUC of the candidates of ``alive`` (stratum -> candidate -> edges of
    its score ranges, in bins of a ``n_bins``-th).

    Tasks collapse ties of their rows' scores and send them by candidate and range, as arrays; a range is
    put together and sorted by itself, and the ranges' sums are added up in their order.
    """
    strata = list(strata)
    cols = [F.col(c).cast("double").alias(f"_r{j}") for j, c in enumerate([*rank_cols, *([other] if other else [])])]
    rows = df.select(*strata, F.col(label).cast("long").alias("_y"), *cols)
    rows = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rows.columns[len(strata):]]))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:len(strata)])
    keys, width = [*strata, "cand", "range"], 1 + len(cols)

    def send(batches):
        held: dict[tuple, list] = {}

        def flush(key: tuple, kind: list):
            y, *ranks = [np.concatenate(x) for x in zip(*held.pop(key))]
            for c, edges in alive[key].items():
                w = np.array([cands[c][0]], dtype=np.float64)
                alpha = None if other is None else np.array([cands[c][1]], dtype=np.float64)
                got = list(range_counts(_scores(w, ranks[:len(rank_cols)], alpha, ranks[-1])[:, 0], y, edges, n_bins))
                binary = [pa.array([x[i].astype(t).tobytes() for x in got], pa.binary()) for i, t in ((1, np.float64), (2, np.int32), (3, np.int32))]
                yield pa.RecordBatch.from_arrays([*[pa.array([k] * len(got), t) for k, t in zip(key, kind)], pa.array([c] * len(got), pa.int32()),
                                                  pa.array([x[0] for x in got], pa.int32()), *binary], [*keys, "v", "n", "npos"])

        kind: list = []
        for batch in batches:
            kind = [batch.schema.field(i).type for i in range(len(strata))]
            of = list(zip(*[batch.column(i).to_pylist() for i in range(len(strata))])) if strata else [()] * batch.num_rows
            data = [batch.column(len(strata) + j).to_numpy() for j in range(width)]
            for key in dict.fromkeys(of):
                if key not in alive:
                    continue
                mine = np.flatnonzero(np.array([k == key for k in of])) if len(set(of)) > 1 else slice(None)
                held.setdefault(key, []).append([x[mine] for x in data])
                if sum(len(x[0]) for x in held[key]) >= 1 << 16:
                    yield from flush(key, kind)
        for key in list(held):
            yield from flush(key, kind)

    def sums(batches):
        at, got, out, kind = None, [], [], []

        def close() -> None:
            v, n, npos = (np.concatenate([np.frombuffer(x[i], dtype=t) for x in got]) for i, t in ((0, np.float64), (1, np.int32), (2, np.int32)))
            _, where = np.unique(v, return_inverse=True)
            pos = np.bincount(where, npos)
            neg = np.bincount(where, n) - pos
            out.append([*at, float((pos * (2.0 * (np.cumsum(neg) - neg) + neg)).sum()), int(pos.sum()), int(neg.sum())])

        for batch in batches:
            kind = [f.type for f in batch.schema][:len(keys)]
            for *key, v, n, npos in zip(*[c.to_pylist() for c in batch.columns]):
                if key != at:
                    if got:
                        close()
                    at, got = key, []
                got.append((v, n, npos))
        if got:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [*kind, pa.float64(), pa.int64(), pa.int64()])], [*keys, "num", "pos", "neg"])

    sent = map_arrow(rows, send, f"{kinds}cand int, range int, v binary, n binary, npos binary")
    # a number of partitions of its own: small ones are not put together, a group of them is read at once
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sent.repartition(parts, *keys).sortWithinPartitions(*keys)
    t = map_arrow(dealt, sums, f"{kinds}cand int, range int, num double, pos long, neg long")
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(*strata, "cand").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = t.withColumn("num", F.col("num") + F.lit(2.0) * F.col("pos") * below).groupBy(*strata, "cand").agg(   # a row per range
        F.sum("num").alias("num"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return whole.select(*strata, "cand", F.try_divide("num", F.lit(2.0) * F.col("pos").cast("double") * F.col("neg").cast("double")).alias("auc"))


def _auc_of_each(df: DataFrame, rank_cols: list[str], label: str, alive: DataFrame, strata: list[str], other: str | None) -> DataFrame:
    """The exact AUC of the candidates of ``alive`` (strata, cand, w1.., alpha) from a row for each of them and each row of ``df``."""
    names = [f"w{j + 1}" for j in range(len(rank_cols))]
    keep = df.select(*strata, label, *rank_cols, *([other] if other else [])).where(F.col(label).isNotNull())
    if strata:
        each = null_safe_join(keep, alive, strata, broadcast=True)
    else:
        each = keep.withColumn("_c", F.explode(F.array(*[
            F.struct(*[F.lit(r[c]).alias(c) for c in ("cand", *names, "alpha")])
            for r in alive.collect()]))).select("*", "_c.*").drop("_c")     # <= |candidates|
    score = weighted_blend(rank_cols, [F.col(n) for n in names])
    if other:
        score = F.col("alpha") * score + (F.lit(1.0) - F.col("alpha")) * F.col(other)
    return auc_by(each.select(*strata, "cand", label, score.alias("_score")), "_score", label, [*strata, "cand"])


def lattice_search(df: DataFrame, rank_cols: list[str], label: str, candidates, top: int = 10, strata=(),
                   other: str | None = None, alphas=None, loss_weight: float = 0.0) -> DataFrame:
    """(strata..., rank, cand, w1.., [alpha,] auc[, log_loss, objective]): the best ``top`` candidates, exactly.

    ``candidates`` are weight vectors over ``rank_cols``; with ``alphas`` the
    candidates are (w, alpha) pairs for the two-stage blend against ``other``.
    One pass bounds the AUC of all candidates; those whose upper bound reaches
    the lower bound of the ``top``-th best can still win.  While many can, they are bounded
    again by as many more bins as there are fewer candidates.  Only the ones then left get the
    exact AUC, from their own scores.  Best means highest AUC, or, with
    ``loss_weight``, lowest ``loss_weight * log_loss - auc`` (to nine digits);
    ties go to the smaller candidate.  Rows with a NULL rank or label do not count.
    """
    strata = list(strata)
    spark = df.sparkSession
    cands = [(tuple(w), a) for w in candidates for a in (alphas if alphas is not None else [None])]
    names = [f"w{j + 1}" for j in range(len(rank_cols))]
    loss = F.lit(float(loss_weight)) * F.col("log_loss")
    best, worst = F.col("high") - loss, F.col("low") - loss   # of the negated objective
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(worst.desc_nulls_last()))  # |candidates| rows each
    floor = F.max(F.when(F.col("_place") == top, worst)).over(Window.partitionBy(*strata))

    def left(bounds: DataFrame) -> DataFrame:
        held = bounds.withColumn("_place", place).withColumn("_floor", F.coalesce(floor, F.lit(float("-inf"))))
        return cut_lineage(held.where(best >= F.col("_floor") - 1e-9).drop("_place", "_floor"))

    alive, n_bins = left(lattice_bounds(df, rank_cols, label, cands, strata, other, bool(loss_weight))), N_BINS
    while True:
        per = alive.groupBy(*strata).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("groups")).first()
        ids = sorted(r["cand"] for r in alive.select("cand").distinct().collect())      # <= |candidates|
        finer = CELLS // max(1, len(ids) * per["groups"])
        if (per["most"] or 0) <= top + top // 2 or finer < 4 * n_bins:
            break
        n_bins = finer
        again = lattice_bounds(df, rank_cols, label, [cands[i] for i in ids], strata, other, False, n_bins, ids)
        both = null_safe_join(alive.drop("edges", "widest"), again.drop("log_loss").withColumnsRenamed({"low": "_low", "high": "_high"}), [*strata, "cand"])
        alive = left(both.select(*strata, "cand", F.greatest("low", "_low").alias("low"), F.least("high", "_high").alias("high"), "log_loss", "edges", "widest"))
    values = spark.createDataFrame([(i, *map(float, w), None if a is None else float(a)) for i, (w, a) in enumerate(cands)],
                                   "cand int, " + "".join(f"{n} double, " for n in names) + "alpha double")
    # |strata| x |candidates| rows at most
    found = alive.select(*strata, "cand", "edges", "widest").collect()
    alive = cut_lineage(alive.select(*strata, "cand", "log_loss").join(F.broadcast(values), "cand"))
    ranges: dict[tuple, dict[int, np.ndarray]] = {}
    widest = 0
    for r in found:
        ranges.setdefault(tuple(r[c] for c in strata), {})[r["cand"]] = np.frombuffer(r["edges"], dtype=np.int32)
        widest = max(widest, r["widest"])
    if widest <= 8 * RANGE_ROWS:
        exact = lattice_auc(df, rank_cols, label, cands, ranges, n_bins, strata, other)
    else:
        # the scores lie so close that bins do not part them: their values do
        exact = _auc_of_each(df, rank_cols, label, alive, strata, other)
    out = null_safe_join(alive, exact.select(*strata, "cand", "auc"), [*strata, "cand"])
    goal = rnd(F.col("auc") - loss, 9) if loss_weight else F.col("auc")
    ranked = F.row_number().over(Window.partitionBy(*strata).orderBy(goal.desc_nulls_last(), "cand"))
    out = out.withColumn("rank", ranked).where(F.col("rank") <= top)
    if loss_weight:
        out = out.withColumn("objective", loss - F.col("auc"))
    return out.select(*strata, "rank", "cand", *names, *(["alpha"] if other else []), "auc",
                      *(["log_loss", "objective"] if loss_weight else []))


@dataclass
class BlendFit:
    weights: tuple
    alpha: float | None
    auc: float
    chosen: str           # 'blend' or the name of the best single column
    history: list


def fit_blend(df: DataFrame, rank_cols: list[str], label: str, other: str | None = None, divisions: int = 10,
              alpha_steps: int = 10, loss_weight: float = 0.0, rounds: int = 3, shrink: int = 5) -> BlendFit:
    """X3/X5 (one stage), X4 (``other`` and loss_weight=1e-4), X6 (``other``, AUC only).

    Lattice search with refinement around each round's winner, all exact; the
    goal is the AUC or, with ``loss_weight``, ``loss_weight * log loss - AUC``.
    The best round by that goal is held against every single column by the same
    goal, so the blend is never worse than the best of them.
    """
    cands, step = simplex_lattice(len(rank_cols), divisions), 1.0 / divisions
    alphas, alpha_step = ([i / alpha_steps for i in range(alpha_steps + 1)], 1.0 / alpha_steps) if other else (None, 0.0)
    history: list = []
    for r in range(rounds):
        top = lattice_search(df, rank_cols, label, cands, 1, (), other, alphas, loss_weight).first()
        w = tuple(top[f"w{i + 1}"] for i in range(len(rank_cols)))
        history.append((r, w, top["alpha"] if other else None, top["auc"], top["objective"] if loss_weight else -top["auc"]))
        step, alpha_step = step / shrink, alpha_step / shrink
        cands = local_lattice(w, step)
        if other:
            alphas = sorted({min(1.0, max(0.0, round(top["alpha"] + i * alpha_step, 10))) for i in range(-2, 3)})
    # refinement only ever looks around the winner, which is itself in the next lattice
    _, w, alpha, auc, goal = min(history, key=lambda h: h[4])
    singles = [*rank_cols, *([other] if other else [])]
    exact = {r["model"]: r["auc"] for r in auc_columns(df, singles, label).collect()}   # one row per column
    loss = dict.fromkeys(singles, 0.0)
    if loss_weight:
        row = df.agg(*[F.avg(row_loss(c, label)).alias(c) for c in singles]).first()
        loss = {c: loss_weight * row[c] for c in singles}
    single = min(singles, key=lambda c: (loss[c] - exact[c], singles.index(c)))
    if goal <= loss[single] - exact[single]:
        return BlendFit(w, alpha, auc, "blend", history)
    onehot = tuple(1.0 if c == single else 0.0 for c in rank_cols) if single in rank_cols else tuple(1.0 / len(rank_cols) for _ in rank_cols)
    return BlendFit(onehot, None if not other else float(single in rank_cols), exact[single], single, history)


# ---------------------------------------------------------------------------------
# Meta features, logit blend, weight averaging
# ---------------------------------------------------------------------------------
def meta_features(cols: list[str], clip: float = 1e-6) -> dict[str, Column]:
    """Clipped logits, pairwise logit differences, mean / population variance /
    spread of the logits across models."""
    z = {c: logit(F.col(c), clip) for c in cols}
    out = {f"logit_{c}": z[c] for c in cols}
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            out[f"dlogit_{a}_{b}"] = z[a] - z[b]
    m = F.lit(float(len(cols)))
    mean = sum((z[c] for c in cols[1:]), z[cols[0]]) / m
    out["logit_mean"] = mean
    out["logit_var"] = sum(((z[c] - mean) * (z[c] - mean) for c in cols[1:]),
                           (z[cols[0]] - mean) * (z[cols[0]] - mean)) / m
    out["logit_spread"] = F.greatest(*[z[c] for c in cols]) - F.least(*[z[c] for c in cols])
    return out


def logit_tree_blend(cols: list[str], weights, clip: float = 1e-5) -> Column:
    """G21 stage A: sigmoid of the weighted logit average of tree scores."""
    z = None
    for c, w in zip(cols, weights):
        t = F.lit(float(w)) * logit(F.col(c), clip)
        z = t if z is None else z + t
    return sigmoid(z)


def logit_then_rank_blend(df: DataFrame, tree_cols: list[str], tree_w, other: str, alpha: float,
                          out: str = "score", tie_digits: int | None = None) -> DataFrame:
    """Logit-average trees -> percentile rank; rank the other model; alpha-blend ranks.

    ``tie_digits`` rounds the tree score before ranking so that last-bit
    differences of ``exp``/``ln`` between engines cannot reorder rows.
    """
    tree = logit_tree_blend(tree_cols, tree_w)
    if tie_digits is not None:
        tree = rnd(tree, tie_digits)
    d = df.withColumn("_tree", tree)
    d = percentile_rank_columns(d, ["_tree", other], prefix="_r")
    return d.withColumn(out, F.lit(float(alpha)) * F.col("_r_tree")
                        + F.lit(1.0 - float(alpha)) * F.col(f"_r{other}")).drop("_tree", "_r_tree", f"_r{other}")


def per_stratum_winners(df: DataFrame, rank_cols: list[str], label: str, strata: list[str],
                        divisions: int = 10) -> DataFrame:
    """Lattice winner per stratum (e.g. per fold / seed), by exact AUC."""
    return lattice_search(df, rank_cols, label, simplex_lattice(len(rank_cols), divisions), 1, strata)


def average_weights(winners: DataFrame, rank_cols: list[str]) -> DataFrame:
    """Average the winning weight vectors over seeds/folds, one row per model."""
    m = len(rank_cols)
    args = ", ".join(f"'{c}', w{i + 1}" for i, c in enumerate(rank_cols))
    long = winners.select(F.expr(f"stack({m}, {args}) AS (model, weight)"))
    return long.groupBy("model").agg(F.avg("weight").alias("avg_weight"),
                                     F.count(F.lit(1)).alias("n_runs"))

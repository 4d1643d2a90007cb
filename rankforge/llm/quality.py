"""Quality classifier with hierarchical empirical Bayes.

The evidence of a document is the log-odds of a logistic regression on shape
features of its whole text, fitted on a bounded sample of labelled rows.  Its
site speaks as well: labelled outcomes are summed up by host and by path (all
labels, grouped aggregation), a host's rate is shrunk toward the global one and
a path's toward its host's, with prior strengths estimated from how much hosts
and paths really differ (method of moments).  A site with few labels thus stays
near its parent, one without labels is its parent.  Posterior log-odds =
evidence + logit(path rate) - logit(global rate).

Features are computed where the texts are read and never shuffled with them;
the site table is broadcast when it is small (its size is checked).  Beyond
that the sites that hold over a thousandth of the documents are broadcast, and
only the documents of the others are shuffled by their site.

Defined results: a null, empty or blank text is rejected (probability 0); null
hosts and paths are sites of their own; labels without id or quality are not
used, several labels of a document count each; with no labels, or of one class
only, the evidence is 0; repeated rows get equal results; columns of any name
are carried along, and one named like a result (``_kept`` ...) gives way to it;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import lookup_join, map_arrow, read, shared_table

#: Labelled rows that the regression is fitted on, at most (the smallest by hash), and its ridge.
SAMPLE_ROWS, RIDGE, SEED = 20_000, 1.0, 11
#: A document is kept from this posterior probability on.
KEEP_FROM = 0.5
#: Log-odds that a document's evidence cannot exceed.
MOST_EVIDENCE = 12.0
#: A site table of so many rows is broadcast (host, path and two numbers a row).
SMALL_SITES = 50_000
RESULTS = ["_evidence", "_host_rate", "_path_rate", "_quality", "_kept"]
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
FEATURES = ("words", "word_length", "upper", "digits", "marks", "bangs", "bars", "ends", "variety", "echoes", "lines", "line_variety",
            "longest", "short")


def features(text: bytes) -> list[float] | None:
    """Shape of a whole text; None if it is blank."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return None
    lines = text.split(b"\n")
    sizes = [*map(len, words)]
    return [
        np.log(n), np.log(sum(sizes) / n), (size - len(text.translate(None, _UPPER))) / size,
        (size - len(text.translate(None, _DIGITS))) / size, (size - len(text.translate(None, _MARKS))) / size,
        text.count(b"!") / n, text.count(b"|") / n, (text.count(b". ") + text.count(b".\n")) / n,
        np.log(len(set(words)) / n), sum(map(eq, words, words[1:])) / n, np.log(len(lines) / n),
        len(set(lines)) / len(lines), np.log(max(sizes)), sum([s < 3 for s in sizes]) / n]


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``_x``, the features of ``text`` (null if blank)."""
    at = len(keep)
    picked = docs.select(*keep, F.col("text").cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                x = pa.array([features(t) if t else None for t in part.column(at).to_pylist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], x], [*keep, "_x"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:at])
    return map_arrow(picked, run, f"{schema}{', ' if keep else ''}_x array<double>")


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the features and the intercept, by Newton steps with a ridge on standardised features."""
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1] + 1)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-12] = 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), RIDGE)
    penalty[-1] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ z + np.diag(penalty) + 1e-9 * np.eye(len(w)),
                               z.T @ (y - p) - penalty * w)
        size = np.abs(step).max()
        w += step * min(1.0, 5 / max(size, 1e-12))
        if size < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def evidence(weights: np.ndarray) -> Column:
    """Log-odds from ``_x``, null for blank texts."""
    terms = [F.element_at("_x", i + 1) * F.lit(float(w)) for i, w in enumerate(weights[:-1])]
    held = F.greatest(F.lit(-MOST_EVIDENCE), F.least(F.lit(MOST_EVIDENCE), sum(terms, F.lit(float(weights[-1])))))
    return F.when(F.col("_x").isNotNull(), held)


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def shrinkage(groups: DataFrame, rate: Column) -> float:
    """Prior strength, in labels, of groups (n labels, k of them good) around the
    rate of their parents: large if groups differ no more than chance makes them."""
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    within = rate * (1 - rate)
    r = groups.agg(F.sum((k - n * rate) * (k - n * rate) / n).alias("between"), F.sum(within).alias("chance"),
                   F.sum((n - 1) * within).alias("spread")).first()
    # E[(k - n m)^2 / n] = m(1-m) (1 + (n-1) rho) with rho = 1 / (strength + 1)
    if r["between"] is None or not r["spread"] or r["between"] <= r["chance"]:
        return 1e4
    rho = min(0.5, (r["between"] - r["chance"]) / r["spread"])
    return float(min(1e4, 1 / rho - 1))


def site_rates(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """(_host, _path, path_rate, n), (_host, host_rate, n) and the global rate from (_host, _path, quality)."""
    paths = shared_table(labelled.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("k")), "sites")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    whole = paths.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((whole["k"] or 0) + 1) / ((whole["n"] or 0) + 2)
    strong = shrinkage(hosts, F.lit(overall))
    hosts = hosts.select("_host", "n", ((F.col("k") + strong * overall) / (F.col("n") + strong)).alias("host_rate"))
    below = paths.join(hosts.select("_host", "host_rate"), "_host")
    firm = shrinkage(below, F.col("host_rate"))
    below = below.select("_host", "_path", "n", ((F.col("k") + firm * F.col("host_rate")) / (F.col("n") + firm)).alias("path_rate"))
    return shared_table(below, "sites"), shared_table(hosts, "sites"), overall


def with_site_rates(scored: DataFrame, sited: DataFrame, hosts: DataFrame, paths: DataFrame) -> DataFrame:
    """``host_rate`` and ``path_rate`` for the rows of ``scored``, whatever part of them one site holds.

    A table of every site that documents have, with its number of documents, says
    which ones are hot: ``lookup_join`` broadcasts those and shuffles the rest.
    """
    sites = sited.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("_docs"))
    rates = shared_table(sites.join(hosts.drop("n"), "_host", "left").join(paths.drop("n"), ["_host", "_path"], "left"), "site-rates")
    return lookup_join(shared_table(scored, "scored"), rates, ["_host", "_path"], "_docs").drop("_docs")


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``_evidence``, ``_host_rate``, ``_path_rate``, ``_quality`` (posterior probability) and ``_kept``."""
    sited = docs.select("doc_id", F.coalesce(F.concat(F.lit("h"), host), F.lit("")).alias("_host"),
                        F.coalesce(F.concat(F.lit("p"), path), F.lit("")).alias("_path"), "text")
    known = labels.filter("doc_id is not null and quality is not null").select(
        F.col("doc_id").alias("doc_id"), (F.col("quality") > 0).cast("int").alias("quality"))
    # texts without a label are only measured where they are scored, so only ids and features are shuffled here
    measured = with_features(sited, ["doc_id", "_host", "_path"])
    labelled = shared_table(measured.join(known, "doc_id"), "labelled")
    order = F.xxhash64("doc_id", F.lit(SEED))
    share = min(1 << 20, (2 * SAMPLE_ROWS << 20) // max(1, labelled.count()) + 1)  # about twice the bound come to be sorted
    sample = (labelled.filter("_x is not null").filter(F.pmod(order, F.lit(1 << 20)) < share)
              .orderBy(order, "quality", "_x").limit(SAMPLE_ROWS).select("_x", "quality").collect())
    weights = fit_logistic(np.array([r["_x"] for r in sample], dtype=np.float64).reshape(-1, len(FEATURES)),
                           np.array([r["quality"] for r in sample], dtype=np.float64))
    paths, hosts, overall = site_rates(labelled.select("_host", "_path", "quality"))
    names = [n for n in keep or docs.columns if n not in RESULTS]
    inner = [f"_c{i}" for i in range(len(names))]      # so that no column of the documents meets one made here
    carried = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, inner)], "text",
                          F.coalesce(F.concat(F.lit("h"), host), F.lit("")).alias("_host"),
                          F.coalesce(F.concat(F.lit("p"), path), F.lit("")).alias("_path"))
    scored = with_features(carried, [*inner, "_host", "_path"]).withColumn("_evidence", evidence(weights)).drop("_x")
    if paths.count() <= SMALL_SITES:
        scored = (scored.join(F.broadcast(hosts.drop("n")), "_host", "left")
                  .join(F.broadcast(paths.drop("n")), ["_host", "_path"], "left"))
    else:
        scored = with_site_rates(scored, sited, hosts, paths)
    scored = (scored.withColumn("_host_rate", F.coalesce("host_rate", F.lit(overall)))
              .withColumn("_path_rate", F.coalesce("path_rate", "_host_rate")))
    odds = F.col("_evidence") + logit(F.col("_path_rate")) - logit(F.lit(overall))
    return (scored.withColumn("_quality", F.coalesce(1 / (1 + F.exp(-odds)), F.lit(0.0)))
            .withColumn("_kept", F.col("_quality") >= KEEP_FROM)
            .select(*[F.col(c).alias(n) for n, c in zip(names, inner)], *RESULTS))


def classify_documents(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A document's host is its source, its path the source's part in its language."""
    return classify(docs, labels, F.col("source"), F.col("lang"), keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's evidence, site rates, posterior and decision."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return classify_documents(docs, read(spark, sf_dir, "labels"), ["doc_id", "source", "lang"]).select(
        "doc_id", "source", "lang", F.col("_evidence").alias("evidence"), F.col("_host_rate").alias("host_rate"),
        F.col("_path_rate").alias("path_rate"), F.col("_quality").alias("quality"), F.col("_kept").alias("kept"))

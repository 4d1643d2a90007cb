"""Merkle manifest of a dataset by slot pivots.

A leaf is the digest of a row.  The leaves of a source, in the order of their
doc_ids, are the bottom of the source's tree; its root, the subroot, is a leaf
of the tree over all sources.  A level is built by one grouping: conditional
aggregates spread the children of a parent into ``FANOUT`` columns by their
slot, and the columns put together are hashed.  The siblings of a node are its
parent's columns without the one of its own slot, so the same table proves what
it hashes.

Going down from the root, every node gets its path: for each level above it
the siblings before and after its slot.  A leaf is proved by hashing it up its
path.  Nodes meet their parents by (tree, place), of which each has one row, and
a path is a list as long as the tree is high; places come from ranges of the
order, so no source lies in one task.

Defined results: a null source is a source of its own, before all others; null
doc_ids come first, rows with the same doc_id (or none) go by their leaf, and
rows alike in every column are leaves of their own side by side; a source with one row has that leaf
as subroot; with one source the subroot is the root; an empty table gives an empty result.
Columns beyond the five are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import read, shared_table
from rankforge.llm.numbering import numbered

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A row is tampered with where this divides the CRC-32 of its doc_id.
TAMPERED = 5
_SLOTS = [f"_c{j}" for j in range(FANOUT)]
_PATH = "array<struct<b:string,a:string>>"


def leaf_digest(values: list[Column]) -> Column:
    """H of a row's values: null as ``-``, else bytes, colon, value."""
    parts = []
    for v in values:
        v = v.cast("string")
        parts.append(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts), 256)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, _tree, leaf, _seen): the digest of each row as it is, and as it is seen by who checks it."""
    own = [F.col(c) for c in FIELDS]
    bad = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    leaf = leaf_digest(own)
    seen = F.when(bad & (ascii_lower(own[-1]) != own[-1]), leaf_digest([*own[:-1], ascii_lower(own[-1])]))
    return docs.select("doc_id", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_tree"),
                       leaf.alias("leaf"), seen.alias("_seen"))


def build(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The levels of every tree over ``nodes`` (_tree, _pos, _n, _digest), from
    the lowest parents up.  A level has (_tree, _pos, _n, _digest) and the children's digests by slot."""
    levels = []
    most = nodes.agg(F.max("_n")).first()[0] or 0                       # one number
    while most > 1:
        spread = [F.max(F.when(F.col("_pos") % FANOUT == j, F.col("_digest"))).alias(c) for j, c in enumerate(_SLOTS)]
        up = (nodes.filter("_n > 1").groupBy("_tree", F.expr(f"_pos div {FANOUT}").alias("_up"), "_n").agg(*spread)
              .select("_tree", F.col("_up").alias("_pos"), F.expr(f"(_n + {FANOUT - 1}) div {FANOUT}").alias("_n"),
                      F.sha2(F.concat_ws("", *_SLOTS), 256).alias("_digest"), *_SLOTS))
        nodes = shared_table(up, name)
        levels.append(nodes)
        most = -(-most // FANOUT)
    return levels


def step(slot: Column, columns: list[str]) -> Column:
    """One step of a path: the parent's columns before the own slot, and those after it."""
    return F.struct(F.concat_ws("", *[F.when(slot > j, F.col(c)) for j, c in enumerate(columns)]).alias("b"),
                    F.concat_ws("", *[F.when(slot < j, F.col(c)) for j, c in enumerate(columns)]).alias("a"))


def paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """``nodes`` with ``_path`` and the columns of ``tops`` (_tree, _path and others; one row per tree), handed down from the trees' roots."""
    handed = [c for c in tops.columns if c not in ("_tree", "_path")]

    def below(children: DataFrame, above: DataFrame | None) -> DataFrame:
        done = children.filter("_n = 1").join(tops, "_tree")
        if above is None:
            return done
        up = above.select("_tree", F.col("_pos").alias("_up"), *_SLOTS, F.col("_path").alias("_above"), *handed)
        more = (children.filter("_n > 1").withColumn("_up", F.expr(f"_pos div {FANOUT}"))
                .join(up.withColumnsRenamed({c: f"_s{c}" for c in _SLOTS}), ["_tree", "_up"]))
        own = step(F.col("_pos") % FANOUT, [f"_s{c}" for c in _SLOTS])
        more = more.withColumn("_path", F.concat(F.array(own), F.col("_above")))
        return done.unionByName(more.select(*done.columns))

    above = None
    for level in reversed(levels):
        above = shared_table(below(level, above), name)
    return below(nodes, above)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, _path, _seen) for every row; ``_path`` holds the siblings up to the root."""
    at = numbered(leaves(docs), "_tree", [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], "merkle")
    nodes = shared_table(at.withColumn("_digest", F.col("leaf")), "merkle")
    levels = build(nodes, "merkle")
    subroots = None
    for t in [nodes, *levels]:
        one = t.filter("_n = 1").select("_tree", "_digest")
        subroots = one if subroots is None else subroots.unionByName(one)
    sources = shared_table(numbered(subroots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_source"), "_digest"), "_tree",
                                    [F.col("_source").asc()], "merkle"), "merkle")
    over = build(sources, "merkle")
    root = (over[-1] if over else sources).filter("_n = 1").select("_tree", F.col("_digest").alias("root"), F.lit(None).cast(_PATH).alias("_path"))
    root = root.withColumn("_path", F.coalesce("_path", F.array().cast(_PATH)))
    proved = paths(sources, over, F.broadcast(root), "merkle")          # of the root there is one row
    tops = shared_table(proved.select(F.col("_source").alias("_tree"), F.col("_digest").alias("subroot"), "root", "_path"), "merkle")
    return paths(nodes, levels, tops, "merkle").select("doc_id", "leaf", "subroot", "root", "_path", "_seen")


def prove(entries: DataFrame) -> DataFrame:
    """Each row of a manifest, with the root that follows from the leaf as seen and the stored siblings."""
    folded = F.aggregate("_path", F.coalesce("_seen", "leaf"), lambda node, x: F.sha2(F.concat(x["b"], node, x["a"]), 256))
    proof = F.sha2(F.array_join(F.transform("_path", lambda x: F.concat(x["b"], x["a"])), ""), 256)
    return (entries.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents`` with a proof of every row."""
    return prove(manifest(read(spark, sf_dir, "documents").select(*FIELDS)))

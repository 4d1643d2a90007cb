"""Mixing sources to target weights by Sainte-Lague apportionment [native].

Every source's documents form one stream in seeded order, cut into blocks of
equally many words.  Sources get blocks by highest quotients target / (2k + 1);
the blocks of each shard of the mix are the seats that source gains when the
house grows by that shard's seats (the method is house monotone, so the gains
are never negative and their sum is as near the targets as one apportionment).
A source's blocks are taken in a row from a seeded start, round and round its
stream, so at most two documents of a source are cut per shard of the mix.

Defined results: a document with null or blank text has size 0 and takes no
words; null sources form one source, after all others; repeated rows count
each on their own; the seeded order goes by id and text, so equal or null ids
spread over a source's buckets and reruns agree (ties are left between rows
that are equal in both); equal quotients fall to the earlier source; columns of
any name are carried along, and one named like a result (``_taken`` ...) gives
way to it; an empty table, or one without words, gives targets of 0.  Only
DataFrame functions; reruns give equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import read, shared_table

#: Documents of a source are numbered within so many buckets of their seeded hash.
BUCKETS = 1024
RESULTS = ["_size", "_source_size", "_target", "_taken", "_full", "_from1", "_to1", "_from2", "_to2"]
WHITE = [32, 9, 10, 11, 12, 13]


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    pieces = F.size(F.split(text, r"[\x20\x09-\x0D]+"))
    edges = F.ascii(text).isin(WHITE).cast("int") + F.ascii(F.right(text, F.lit(1))).isin(WHITE).cast("int")
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(pieces - edges).cast("long")


def _streams(docs: DataFrame, seed: int) -> DataFrame:
    """Adds the source's key, the words and the place in the seeded order."""
    return (docs.withColumn("_key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
            .withColumn("_size", word_count(F.col("text"))).withColumn("_digest", F.xxhash64("text"))
            .withColumn("_h", F.xxhash64(F.col("doc_id"), F.col("_digest"), F.lit(seed)))
            .withColumn("_bucket", F.shiftrightunsigned(F.col("_h"), 54).cast("int")))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Targets in words from (source, _key, total): weights repeat over the
    sources by code point, null last; a target stops at ``most`` times its
    source's words and the excess goes to the others by weight.

    In ascending order of cap / weight a source is at its cap if the level
    reached without the capped ones before it is at or above its own.  One row
    per source of the mixture's configuration, so windows over all of them are small.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("_ratio", "_key").rowsBetween(Window.unboundedPreceding, -1)
    out = (sources.withColumn("_w", w).withColumn("_cap", F.col("total") * F.lit(float(most)))
           .withColumn("_ratio", F.col("_cap") / F.col("_w"))
           .withColumn("_all", F.sum("total").over(every).cast("double")).withColumn("_ws", F.sum("_w").over(every))
           .withColumn("_c", F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0)))
           .withColumn("_cw", F.coalesce(F.sum("_w").over(by_ratio), F.lit(0.0)))
           .withColumn("_capped", F.col("_ratio") <= (F.col("_all") - F.col("_c")) / (F.col("_ws") - F.col("_cw"))))
    capped = F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0.0)).over(every)
    capped_w = F.sum(F.when(F.col("_capped"), F.col("_w")).otherwise(0.0)).over(every)
    level = F.try_divide(F.col("_all") - capped, F.col("_ws") - capped_w)
    return out.select("source", "_key", "total",
                      F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_w") * level).alias("target"))


def block_quotas(targets: DataFrame, seats: int, shards: int = 16) -> DataFrame:
    """Sainte-Lague: blocks per (source key, shard) out of ``seats`` in all.

    With S sources a source of share p has at least p (m - S/2) - 1/2 and at
    most p (m + S/2) + 1/2 of m seats, so only the quotients between those two
    are generated (about 3 S a shard) and ranked.
    """
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.coalesce(F.try_divide(F.col("target"), F.sum("target").over(every)), F.lit(0.0))
    t = (targets.select("_key", "target", share.alias("_p"), F.count(F.lit(1)).over(every).alias("_s"))
         .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
         .withColumn("_m", F.expr(f"((shard + 1) * {seats}L) div {shards}L"))
         .withColumn("_low", F.greatest(F.lit(0), F.ceil(F.col("_p") * (F.col("_m") - F.col("_s") / 2) - 0.5) - 1).cast("long"))
         .withColumn("_high", F.greatest(F.col("_low"), F.floor(F.col("_p") * (F.col("_m") + F.col("_s") / 2) + 0.5) + 1).cast("long"))
         .withColumn("_open", F.col("_m") - F.sum("_low").over(Window.partitionBy("shard"))))
    ranked = (t.filter("_high > _low and target > 0").withColumn("_k", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)))
              .withColumn("_r", F.row_number().over(Window.partitionBy("shard").orderBy(
                  (F.col("target") / (2 * F.col("_k") + 1)).desc(), "_key", "_k"))))
    won = ranked.filter("_r <= _open").groupBy("_key", "shard").agg(F.count(F.lit(1)).alias("_won"))
    held = t.join(won, ["_key", "shard"], "left").withColumn("_seats", F.col("_low") + F.coalesce("_won", F.lit(0)))
    gain = F.col("_seats") - F.coalesce(F.lag("_seats").over(Window.partitionBy("_key").orderBy("shard")), F.lit(0))
    return held.select("_key", "shard", gain.alias("quota"))


def mix(docs: DataFrame, seed: int = 17, shards: int = 16, max_blocks: int = 1 << 20) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target``, ``_taken`` and
    where the words lie: ``_full`` whole passes, then the word ranges
    [``_from1``, ``_to1``) and [``_from2``, ``_to2``) of the document.

    A block has max(1, ceil(words / max_blocks)) words.
    """
    names = [n for n in docs.columns if n not in RESULTS]
    inner = [f"_c{i}" for i in range(len(names))]      # so that no column of the documents meets one made here
    carried = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, inner)], "doc_id", "text", "source")
    narrow = shared_table(_streams(docs.select("doc_id", "source", "text"), seed).select("source", "_key", "_bucket", "_size"), "mix")
    buckets = shared_table(narrow.groupBy("_key", "_bucket").agg(F.first("source").alias("source"), F.sum("_size").alias("_n")), "mix")
    sources = buckets.groupBy("_key").agg(F.first("source").alias("source"), F.sum("_n").alias("total"))
    words = sources.agg(F.sum("total")).first()[0] or 0
    block = max(1, -(-words // max_blocks))
    targets = source_targets(sources)
    quotas = block_quotas(targets, words // block, shards).groupBy("_key").agg(F.sum("quota").alias("_q"))
    plan = (targets.join(quotas, "_key")
            .withColumn("_k", F.least(F.col("_q") * F.lit(block), F.col("total") * 3))
            .withColumn("_full", F.expr("if(total = 0, 0L, _k div total)"))
            .withColumn("_rest", F.col("_k") - F.col("_full") * F.col("total"))
            .withColumn("_start", F.expr(f"if(total = 0, 0L, pmod(xxhash64(_key, {seed}), (total + {block - 1}L) div {block}L) * {block}L)"))
            .select("_key", F.col("total").alias("_source_size"), F.coalesce("target", F.lit(0.0)).alias("_target"), "_full", "_rest", "_start"))
    before = F.sum("_n").over(Window.partitionBy("_key").orderBy("_bucket")) - F.col("_n")
    offsets = buckets.select("_key", "_bucket", before.alias("_before")).join(plan, "_key")
    inside = (Window.partitionBy("_key", "_bucket").orderBy("_h", "doc_id", "_digest", "_size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (_streams(carried, seed).join(offsets, ["_key", "_bucket"])
           .withColumn("_at", F.col("_before") + F.sum("_size").over(inside) - F.col("_size")))

    def part(low: str, high: str) -> tuple[Column, Column]:
        a = F.greatest(F.expr(low) - F.col("_at"), F.lit(0))
        return a, F.greatest(F.least(F.expr(high) - F.col("_at"), F.col("_size")), a)

    a1, b1 = part("_start", "_start + _rest")
    a2, b2 = part("0L", "_start + _rest - _source_size")
    out = (out.withColumn("_from1", F.least(a1, F.col("_size"))).withColumn("_to1", F.least(b1, F.col("_size")))
           .withColumn("_from2", F.least(a2, F.col("_size"))).withColumn("_to2", F.least(b2, F.col("_size")))
           .withColumn("_taken", F.col("_full") * F.col("_size") + F.expr("_to1 - _from1 + _to2 - _from2")))
    return out.select(*[F.col(c).alias(n) for n, c in zip(names, inner)], *RESULTS)


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for every whole pass
    over a document and one more for each part of it that was taken."""
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))

    def piece(a: str, b: str) -> Column:
        cut = F.array_join(F.slice(words, (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a)).cast("int")), "")
        return F.when(F.col(b) - F.col(a) >= F.col("_size"), F.col("text")).otherwise(cut)

    copies = F.concat(
        F.array_repeat(F.col("text"), F.col("_full").cast("int")),
        F.when(F.col("_to1") > F.col("_from1"), F.array(piece("_from1", "_to1"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("_to2") > F.col("_from2"), F.array(piece("_from2", "_to2"))).otherwise(F.array().cast("array<string>")))
    taken = mix(docs, seed).filter("_taken > 0").withColumn("text", F.explode(copies))
    if "n_chars" in docs.columns:
        taken = taken.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return taken.select(*[F.col(f"`{n}`") for n in docs.columns if n not in RESULTS])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, its source's words and target, and the words the mix takes of it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                            F.col("_target").alias("target"), F.col("_taken").alias("taken"))

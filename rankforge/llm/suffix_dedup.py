"""Substring dedup by suffix arrays over shards that hold all that can match.

Every byte covered by a string of ``width`` bytes that also starts anywhere else
in the corpus goes, all copies alike, judged on the texts as they came in.

Sharding.  In each window of ``width`` bytes the rolling hash of ANCHOR bytes is least at
one place (the leftmost, of equals), the window's anchor.  Equal windows have equal anchors at
equal places, so windows can only match within the group of an anchor's hash.
Successive windows with one anchor make a piece of text.  Groups that occur
once are done with.  Equal pieces are counted and go whole if there are two; of
a group's different pieces one copy each goes into a shard, where windows whose
middle bytes stand in one piece only are left out.  A shard's pieces
are sorted by an induced suffix array, and windows that have ``width`` bytes in common with
their neighbour in order, by the permuted common prefixes, go.

Hot groups.  A passage in a third of all documents gives as many different
pieces at its ends, as they reach into what stands around it.  A group of over
MOST pieces is cut by the anchor's place in the window, into stretches of GRAINS
places; all windows of a stretch share a core of bytes, and the core is the new
group.  What stands around the passage differs, so most groups fall to single
pieces; at grain 1 the core is the window itself, and equal pieces are counted.
No group is ever brought to one task whole, and none is cut short.

Defined results: null and empty texts have no bytes; texts under ``width`` bytes
lose nothing; rows equal in doc_id and text are documents of their own, whose
bytes repeat in each other; matches may lie in one text and overlap; removed
spans that touch are one; an empty table gives an empty result.  Removal is by
bytes and may cut a character, so what is left is binary.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import lookup_join, read, shared_table
from rankforge.llm.spans import KEY, key_columns, removed_spans
from rankforge.llm.suffixes import repeats
from rankforge.session import map_arrow

WIDTH = 200
#: Bytes of an anchor: 8, 8 and 8 put together.
ANCHOR = 24
#: Different pieces of a group that may go into one shard; a group of more is cut finer.
MOST = 2048
#: Bytes of a shard, roughly.
SHARD = 1 << 20
#: Places of the anchor that a hot group's stretches cover, from one cut to the next.
GRAINS = (32, 4, 1)
#: Windows that are looked at together; longer texts go slab by slab.
_SLAB = 1 << 20
_ODD, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
_KEYS = "_no_id boolean, _id long, _digest long"
_SPAN = f"{_KEYS}, start int, end int, n int"


def _hashes(b: np.ndarray) -> np.ndarray:
    """Of every ANCHOR bytes; built up by doubling."""
    h, m = b.astype(np.uint64) + np.uint64(1), 1
    while m < 8:
        h = h[:-m] * np.uint64(pow(_ODD, m, 1 << 64)) + h[m:]
        m *= 2
    two = h[:-8] * np.uint64(pow(_ODD, 8, 1 << 64)) + h[8:]
    h = two[:-8] * np.uint64(pow(_ODD, 8, 1 << 64)) + h[16:]
    h = (h ^ h >> np.uint64(31)) * _MIX
    return h ^ h >> np.uint64(29)


def pieces(text: bytes, width: int = WIDTH) -> Iterator[tuple[int, int, int, int, int, bytes, int]]:
    """(anchor hash, anchor's place, start, end, size, digest, copies) of a text's
    pieces; equal ones that overlap are one row, with the bytes they cover together and the size of one copy."""
    span = width - ANCHOR + 1                                              # anchors of a window
    for slab in range(0, max(0, len(text) - width + 1), _SLAB):
        h = _hashes(np.frombuffer(text, dtype=np.uint8, offset=slab, count=min(len(text) - slab, _SLAB + width - 1)))
        low = h & np.uint64(~(2 * _SLAB - 1) & (1 << 64) - 1) | np.arange(len(h), dtype=np.uint64)
        m = 1
        while 2 * m <= span:
            low, m = np.minimum(low[:-m], low[m:]), 2 * m
        if m < span:
            low = np.minimum(low[:len(low) - (span - m)], low[span - m:])
        at = (low & np.uint64(2 * _SLAB - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.append(first[1:], len(at)) - 1
        mine = None
        for a, s, e, key in zip((at[first] - first).tolist(), (first + slab).tolist(), (last + slab + width).tolist(),
                                h[at[first]].view(np.int64).tolist()):
            digest = xxhash.xxh3_128_digest(text[s:e])
            if mine and mine[5] == digest and mine[1] == a and s <= mine[3]:
                mine = (key, a, mine[2], e, e - s, digest, mine[6] + 1)
                continue
            if mine:
                yield mine
            mine = (key, a, s, e, e - s, digest, 1)
        if mine:
            yield mine


def _rows(batch: pa.RecordBatch, row: list[int], out: list[tuple]) -> list[pa.Array]:
    """Keys, hash, place, start, end, size and digest of pieces; ``row`` says of which row of the batch, ``out`` ends with two more."""
    h, place, start, end, size, digest = list(zip(*out))[:6] if out else ((),) * 6
    d = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
    return [*[batch.column(k).take(pa.array(row, pa.int32())) for k in range(3)], pa.array(h, pa.int64()),
            *[pa.array(x, pa.int32()) for x in (place, start, end, size)], pa.array(d[:, 0]), pa.array(d[:, 1])]


_PIECE = f"{_KEYS}, h long, place int, start int, end int, size int, d1 long, d2 long, m long"
_NAMES = [*KEY, "h", "place", "start", "end", "size", "d1", "d2", "m"]


def _found(docs: DataFrame, width: int) -> DataFrame:
    """The pieces of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                row, out = [], []
                for i, text in enumerate(batch.column(3).slice(at, 256).to_pylist(), at):
                    found = list(pieces(text or b"", width))
                    row += [i] * len(found)
                    out += found
                yield pa.RecordBatch.from_arrays([*_rows(batch, row, out), pa.array([x[6] for x in out], pa.int64())], _NAMES)

    return map_arrow(docs.select(*key_columns(), F.col("text").cast("binary")), run, _PIECE)


_SAME = ["h", "place", "d1", "d2"]


def _distinct(rows: DataFrame, more: list[str]) -> DataFrame:
    """Equal pieces as one: how many there are, and the first."""
    return rows.groupBy(*_SAME).agg(F.sum("m").alias("copies"), F.min(F.struct(*KEY, "start", (F.col("start") + F.col("size")).alias("end"))).alias("first"),
                                    *[F.first(c).alias(c) for c in more])


def _mixed(distinct: DataFrame) -> DataFrame:
    """The pieces of groups with several, of which some have no equal; with ``among``, the group's number of pieces."""
    groups = (distinct.groupBy("h").agg(F.count(F.lit(1)).alias("among"), F.min("copies").alias("_least"))
              .filter("among > 1 and _least = 1").drop("_least"))
    return lookup_join(distinct, shared_table(groups, "suffixes"), "h", "among")


def _bodies(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` with the bytes of its pieces, each text being sent once to the pieces that are cut from it."""
    fields = ["h", "place", "start", "end", "copies", "among"]
    wanted = chosen.select("h", "place", "copies", "among", "first.*").groupBy(*KEY).agg(F.collect_list(F.struct(*fields)).alias("_w"))
    rows = docs.select(*key_columns(), F.col("text").cast("binary").alias("_b")).join(wanted, KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                row, got, body = [], [], []
                for i, (text, wants) in enumerate(zip(batch.column(3).slice(at, 64).to_pylist(), batch.column(4).slice(at, 64).to_pylist()), at):
                    for w in wants:
                        row.append(i)
                        got.append(w)
                        body.append(text[w["start"]:w["end"]])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(pa.array(row, pa.int32())) for k in range(3)],
                     *[pa.array([g[f] for g in got], pa.int64() if f in ("h", "copies", "among") else pa.int32()) for f in fields], pa.array(body, pa.binary())],
                    [*KEY, *fields, "body"])

    return map_arrow(rows.select(*KEY, "_b", "_w"), run, f"{_KEYS}, h long, place int, start int, end int, copies long, among long, body binary")


def _stretches(place: int, size: int, grain: int, width: int) -> Iterator[tuple[int, int, slice, int]]:
    """(first window, window behind the last, core, anchor's least place) of a
    piece's stretches; the core is the bytes that all windows of a stretch share."""
    s = 0
    while s < size - width + 1:
        low = (place - s) // grain * grain                                 # window s has the anchor at place - s
        stop = min(size - width + 1, place - low + 1)
        yield s, stop, slice(place - low, place - low - grain + 1 + width), low
        s = stop


def candidates(places: list[int], bodies: list[bytes], width: int, grain: int = GRAINS[0]) -> tuple[list[int], list[int], list[bytes]]:
    """(piece, offset, bytes): the parts of pieces whose stretches have a core that
    another stretch has too; only they can hold windows that match."""
    cores = [[(s, stop, xxhash.xxh3_64_intdigest(body[core], low)) for s, stop, core, low in _stretches(place, len(body), grain, width)]
             for place, body in zip(places, bodies)]
    times = Counter(c for mine in cores for _, _, c in mine)
    at, offset, parts = [], [], []
    for i, mine in enumerate(cores):
        runs: list[list[int]] = []
        for s, stop, c in mine:
            if times[c] > 1:
                if runs and runs[-1][1] == s:
                    runs[-1][1] = stop
                else:
                    runs.append([s, stop])
        for s, stop in runs:
            at.append(i)
            offset.append(s)
            parts.append(bodies[i][s:stop - 1 + width])
    return at, offset, parts


def _sorted(bodies: DataFrame, width: int) -> DataFrame:
    """The spans that suffix arrays find in pieces of which there is one copy."""
    total = bodies.agg(F.sum(F.octet_length("body") + 1)).first()[0] or 0  # one number
    shards = -(-total // SHARD) or 1
    parts = int(bodies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (bodies.select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("_shard"), *KEY, "start", F.col("copies") == 1, "place", "body")
             .repartition(min(shards, 8 * parts), "_shard").sortWithinPartitions("_shard"))

    def one(rows: pa.Table) -> pa.RecordBatch:
        at, start, end = [], [], []
        single, base, bodies_ = (rows.column(k).to_pylist() for k in (5, 4, 7))
        piece, offset, parts = candidates(rows.column(6).to_pylist(), bodies_, width)
        for i, o, hit in zip(piece, offset, repeats(parts, width) if parts else []):
            if single[i] and hit.size:
                cut = np.flatnonzero(np.diff(hit) > 1)
                for a, b in zip(hit[np.concatenate(([0], cut + 1))].tolist(), hit[np.append(cut, len(hit) - 1)].tolist()):
                    at.append(i)
                    start.append(base[i] + o + a)
                    end.append(base[i] + o + b + width)
        keys = [pa.array([rows.column(k)[i].as_py() for i in at], rows.schema.field(k).type) for k in (1, 2, 3)]
        return pa.RecordBatch.from_arrays([*keys, pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array([1] * len(at), pa.int32())],
                                          [*KEY, "start", "end", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:                                              # a shard ends where its number does
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if held and held[0].column(0)[0].as_py() != int(shard[a]):
                    yield one(pa.Table.from_batches(held))
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield one(pa.Table.from_batches(held))

    return map_arrow(dealt, run, _SPAN)


def _finer(bodies: DataFrame, grain: int, width: int) -> DataFrame:
    """Pieces, with their bytes, cut by the anchor's place into stretches of
    ``grain`` windows and grouped by the core that a stretch's windows share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                row, out = [], []
                for i, (h, place, start, copies, body) in enumerate(zip(*[batch.column(k).slice(at, 256).to_pylist() for k in (3, 4, 5, 7, 9)]), at):
                    for s, stop, core, low in _stretches(place, len(body), grain, width):
                        part = body[s:stop - 1 + width]
                        key = xxhash.xxh3_64_intdigest(body[core], low * 31 + grain) ^ (h & (1 << 64) - 1)
                        row.append(i)
                        out.append((key - (1 << 64) if key >> 63 else key, place - s, start + s, start + stop - 1 + width, len(part),
                                    xxhash.xxh3_128_digest(part), copies, part))
                yield pa.RecordBatch.from_arrays([*_rows(batch, row, out), pa.array([x[6] for x in out], pa.int64()),
                                                  pa.array([x[7] for x in out], pa.binary())], [*_NAMES, "body"])

    return map_arrow(bodies.select(*KEY, "h", "place", "start", "end", "copies", "among", "body"), run,
                     f"{_PIECE}, body binary")


def _spans(bodies: DataFrame, width: int, grains: tuple[int, ...]) -> DataFrame:
    """The spans to remove of pieces that stand alone among other pieces of their group."""
    found = _sorted(bodies.filter(F.col("among") <= MOST), width)
    hot = bodies.filter(F.col("among") > MOST)
    if not grains or hot.isEmpty():
        return found
    cut = shared_table(_finer(hot, grains[0], width), "suffixes")
    same = shared_table(_distinct(cut, ["body"]), "suffixes")
    equal = lookup_join(cut.filter("m = 1").drop("body"), same.filter("copies > 1").select(*_SAME, "copies"), _SAME, "copies")
    rest = shared_table(_mixed(same).select("h", "place", "first.*", "copies", "among", "body"), "suffixes")
    return (found.unionByName(equal.select(*KEY, "start", "end", F.lit(1).alias("n")))
            .unionByName(_spans(rest, width, grains[1:])))


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, start, end, n): spans that cover all repeated strings of ``width`` bytes."""
    found = shared_table(_found(docs, width), "suffixes")
    groups = shared_table(found.groupBy("h").agg(F.sum("m").alias("_n")).filter("_n > 1"), "suffixes")
    shared = shared_table(lookup_join(found, groups, "h", "_n").drop("_n"), "suffixes")
    distinct = shared_table(_distinct(shared, []), "suffixes")
    whole = lookup_join(shared, distinct.filter("copies > 1").select(*_SAME, "copies"), _SAME, "copies")
    # of rows given more than once, each sends the bytes
    bodies = shared_table(_bodies(docs, _mixed(distinct)).dropDuplicates([*KEY, "h", "start"]), "suffixes")
    return whole.select(*KEY, "start", "end", F.lit(1).alias("n")).unionByName(_spans(bodies, width, GRAINS)).distinct()


def dedup_substrings(docs: DataFrame, width: int = WIDTH, texts: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, removed, kept_sha256, left) for every row of
    ``docs`` (doc_id, text): the spans that went, and, with ``texts``, the bytes that are left."""
    cuts = removed_spans(repeated_spans(docs, width), 0).select(*KEY, "removed")
    rows = docs.select("doc_id", *key_columns(), F.col("text").cast("binary").alias("_b")).join(cuts, KEY, "left")
    names = ["doc_id", "n_bytes", "n_removed", "removed", "kept_sha256", *["left"][:texts]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    text = text or b""
                    keep = b"".join(text[a:b] for a, b in zip([0, *[x["end"] for x in spans]], [*[x["start"] for x in spans], len(text)]))
                    out.append((len(text), len(text) - len(keep), hashlib.sha256(keep).hexdigest(), keep))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array([x[i] for x in out], pa.int64()) for i in range(2)], part.column(2), pa.array([x[2] for x in out], pa.string()),
                     *[pa.array([x[3] for x in out], pa.binary())][:texts]], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows.select("doc_id", "_b", F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>"))), run,
                     f"doc_id {kind}, n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, kept_sha256 string"
                     + ", left binary" * texts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents``: what strings of 200 bytes that repeat anywhere take out of it."""
    out = dedup_substrings(read(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")

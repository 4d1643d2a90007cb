"""Repair of conversation structure by Four-Russians block tables.

A conversation should read as an optional system turn and then pairs of a user
and an assistant turn: role initials ``(s?(ua)+)?``.  Four states say how far
such a sequence has come: nothing yet, after the system turn, after a user turn,
after a pair.  Every row is kept (0), given the other role (3) or deleted (4;
the only choice for blank and repeated rows), and empty turns are put in (3); a
truncated row that stays costs 3 more.

What the rest of a conversation costs is a vector over the four states.  Its
entries differ by a few units at most, so vectors less their smallest entry are
few, and each gets a number.  Rows are one of nine symbols.  For every block of
``BLOCK`` symbols and every vector behind it a table holds the vector before the block and what was
subtracted; it is composed from the one-symbol table.  A conversation is taken
from its end to its start, one lookup for a block.  Going forward again, each block is
expanded backward from the vector behind it, and of all cheapest edits the one
with the smallest letter is taken (D, I, K, R); the letter decides the next
state, so this gives the smallest of all cheapest edit strings.

Long conversations are cut into chunks of ``CHUNK`` rows.  A chunk's table of
all vectors does not depend on what follows, so chunks are done apart, put
together by one fold over a conversation's chunks, and traced apart from each
of the four states.  Only the digest of a repaired conversation needs its texts
in order: they are sorted by conversation and hashed as they stream by.

Defined results: a null conv_id is a conversation of its own; null roles and texts
are one space; turns go up, null first, rows of the same turn by role, then the
text's digest; a role's initial is its first character, and a row whose initial is none of s, u, a
can be given a role or deleted; a conversation without rows after the damage has
zeros and the digest of the empty string; an empty table gives an empty result.
Columns beyond the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import read, shared_table
from rankforge.llm.numbering import numbered
from rankforge.session import map_arrow

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 4
#: Rows of a conversation that are traced together.
CHUNK = 4096
#: The state after a turn is put in, or given the role that fits.
NEXT = (2, 2, 3, 2)
#: Initials, and the states that a turn with that initial leads to.
INITIALS = "sua"
FITS = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
#: Symbols: nothing (fills up a block), a row to delete, then by initial (s, u, a, other) a whole and a truncated row.
FILL, GONE, FIRST = 0, 1, 2
SYMBOLS = FIRST + 2 * (len(INITIALS) + 1)
_SPACE = " \t\n\x0b\f\r"


def _inserted(cost: list[int]) -> tuple[int, ...]:
    """With turns put in before the row; a third one never pays."""
    return tuple(min(cost[q], INSERT + cost[NEXT[q]], 2 * INSERT + cost[NEXT[NEXT[q]]]) for q in range(4))


#: Behind the last row: an empty or finished sequence needs nothing more.
END = (0, 2 * INSERT, INSERT, 0)


def before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row from the costs after it."""
    if symbol == FILL:
        return after
    cost = [DELETE + c for c in after]
    if symbol != GONE:
        fits, more = FITS[(symbol - FIRST) // 2], TRUNCATED * ((symbol - FIRST) % 2)
        for q in range(4):
            cost[q] = min(cost[q], REROLE + more + after[NEXT[q]], *([KEEP + more + after[fits[q]]] if q in fits else []))
    return _inserted(cost)


@dataclass
class Tables:
    vectors: list[tuple[int, ...]]   # normalised; number 0 is END
    to: np.ndarray                   # (block, vector behind) -> vector before
    cost: np.ndarray                 # (block, vector behind) -> what was subtracted


@cache
def tables() -> Tables:
    vectors, number = [END], {END: 0}
    one_to: list[list[int]] = []
    one_cost: list[list[int]] = []
    for v in vectors:                                                   # grows until no step makes a new one
        to, cost = [], []
        for s in range(SYMBOLS):
            w = before(s, v)
            low = min(w)
            w = tuple(c - low for c in w)
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
            to.append(number[w])
            cost.append(low)
        one_to.append(to)
        one_cost.append(cost)
    to1, cost1 = np.array(one_to, dtype=np.int16).T, np.array(one_cost, dtype=np.int32).T
    to, cost = to1, cost1
    for _ in range(BLOCK - 1):                                          # one more symbol in front
        cost = (cost[None, :, :] + cost1[:, to]).reshape(-1, len(vectors))
        to = to1[:, to].reshape(-1, len(vectors))
    return Tables(vectors, to, cost)


def blocks(symbols: np.ndarray) -> list[int]:
    """Block numbers of a chunk's symbols, filled up in front."""
    full = np.concatenate([np.full(-len(symbols) % BLOCK, FILL, dtype=np.int64), symbols])
    return (full.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()


def chunk_map(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector behind a chunk the one before it, and what was subtracted."""
    t = tables()
    at, cost = np.arange(len(t.vectors)), np.zeros(len(t.vectors), dtype=np.int64)
    for b in reversed(blocks(symbols)):
        cost += t.cost[b, at]
        at = t.to[b, at]
    return at, cost


@lru_cache(maxsize=1 << 16)
def expand(block: int, behind: int, state: int) -> tuple[tuple[str, ...], int, int]:
    """A block's rows as edited from ``state`` on: the moves of each, their cost, the state behind.
    Moves: u, a put a turn in; then D deletes the row, K keeps it, U and A give it a role."""
    symbols = [block // SYMBOLS ** i % SYMBOLS for i in range(BLOCK - 1, -1, -1)]
    costs = [tables().vectors[behind]]
    for s in reversed(symbols):
        costs.append(before(s, costs[-1]))
    costs.reverse()
    first, q, out = costs[0][state], state, []
    for s, now, after in zip(symbols, costs, costs[1:]):
        if s == FILL:
            continue
        moves = ""
        fits, more = ({}, 0) if s == GONE else (FITS[(s - FIRST) // 2], TRUNCATED * ((s - FIRST) % 2))
        while True:
            if now[q] == DELETE + after[q]:
                moves += "D"
            elif now[q] == INSERT + now[NEXT[q]]:
                moves, q = moves + "au"[NEXT[q] == 2], NEXT[q]
                continue
            elif q in fits and now[q] == KEEP + more + after[fits[q]]:
                moves, q = moves + "K", fits[q]
            else:
                moves, q = moves + "AU"[NEXT[q] == 2], NEXT[q]
            break
        out.append(moves)
    return tuple(out), first - costs[-1][q], q


def trace(symbols: np.ndarray, behind: int, state: int, last: bool) -> tuple[list[str], int, int]:
    """The moves of a chunk's rows, their cost and the state behind.  What the
    last chunk's last row is followed by stands behind its own letter."""
    t, numbers, after = tables(), blocks(symbols), []
    for b in reversed(numbers):
        after.append(behind)
        behind = int(t.to[b, behind])
    moves, cost = [], 0
    for b, v in zip(numbers, reversed(after)):
        some, c, state = expand(b, v, state)
        moves += some
        cost += c
    while last and END[state]:
        moves[-1] += "au"[NEXT[state] == 2]
        cost, state = cost + INSERT, NEXT[state]
    return moves, cost, state


# ---- rows
def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def conversation_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("_conv")


def damaged(conversations: DataFrame) -> DataFrame:
    """(_conv, turn, role, text) after the damage that the rule ``crc32(conv_id:turn) % 20`` does."""
    rule = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = conversations.select(conversation_key(), F.col("turn").cast("long").alias("turn"), _text("role").alias("role"),
                                _text("text").alias("text"), rule.alias("_rule")).filter("_rule <> 0")
    text = (F.when(F.col("_rule") == 1, F.lit("")).when(F.col("_rule") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return rows.select("_conv", "turn", F.when(F.col("_rule") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("_rule") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def faults(rows: DataFrame) -> DataFrame:
    """Rows in their order (``_pos`` of ``_n``) with the first fault of each and their code, initial and symbol."""
    at = shared_table(numbered(rows.withColumn("_sha", F.sha2("text", 256)), "_conv",
                               [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("_sha").asc()], "turns"), "turns")
    first = at.groupBy("_conv", "role", "_sha").agg(F.min("_pos").alias("_pos")).select("_conv", "_pos", F.lit(True).alias("_new"))
    rest = F.rtrim(F.col("text"), F.lit(_SPACE))
    blank = F.length(rest) == 0
    repeated = ~blank & F.col("_new").isNull()
    cut = ~blank & ~repeated & ~F.right(rest, F.lit(1)).isin(".", "!", "?")
    initial = F.coalesce(*[F.when(F.left("role", F.lit(1)) == c, F.lit(i)) for i, c in enumerate(INITIALS)], F.lit(len(INITIALS)))
    symbol = F.when(blank | repeated, F.lit(GONE)).otherwise(FIRST + 2 * initial + cut.cast("int"))
    return (at.join(first, ["_conv", "_pos"], "left")
            .select("_conv", "turn", "role", "text", "_pos", "_n", blank.alias("_blank"), repeated.alias("_repeated"), cut.alias("_cut"),
                    (initial * SYMBOLS + symbol).cast("int").alias("_code")))


def _folded(chunks: DataFrame, columns: list[str], start: str, backward: bool, nxt: str, name: str) -> DataFrame:
    """(_conv, _chunk, name): what holds at each chunk's one end, by a fold over
    the conversation's chunks, of which it has one for CHUNK rows."""
    order = F.array_sort(F.collect_list(F.struct("_chunk", *columns)))
    listed = chunks.groupBy("_conv").agg((F.reverse(order) if backward else order).alias("_all"))
    at = (f"aggregate(_all, named_struct('at', {start}, 'out', cast(array() as array<struct<_chunk:bigint,{name}:int>>)), "
          f"(s, x) -> named_struct('at', x.{nxt}[s.at], 'out', concat(s.out, array(named_struct('_chunk', x._chunk, '{name}', s.at)))), s -> s.out)")
    return listed.select("_conv", F.explode(F.expr(at)).alias("_o")).select("_conv", "_o.*")


def edits(rows: DataFrame) -> DataFrame:
    """(_conv, _chunk, moves, cost, illegal, first, last) for every chunk of the conversations in ``rows``, as of ``faults``."""
    code = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_code"))), lambda x: x["_code"])
    chunks = shared_table(rows.groupBy("_conv", F.expr(f"_pos div {CHUNK}").alias("_chunk"), "_n").agg(code.alias("_codes"))
                          .withColumns({"_last": F.expr(f"(_chunk + 1) * {CHUNK} >= _n"), "_only": F.col("_n") <= CHUNK}), "turns")

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chunk_map(np.array(c) % SYMBOLS)[0].tolist() for c in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["_conv", "_chunk", "to"])

    several = chunks.filter("not _only")
    mapped = map_arrow(several.select("_conv", "_chunk", "_codes"), maps, "_conv string, _chunk long, to array<int>")
    behind = _folded(mapped, ["to"], "0", True, "to", "_behind")
    known = chunks.join(behind, ["_conv", "_chunk"], "left").withColumn("_behind", F.coalesce("_behind", F.lit(0)))

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for codes, last, only, right in zip(*[batch.column(i).to_pylist() for i in range(2, 6)]):
                codes = np.array(codes)
                initial, symbol = codes // SYMBOLS, codes % SYMBOLS
                ways = [trace(symbol, right, q, last) for q in range(1 if only else 4)]
                for column, values in zip(out, zip(*ways)):
                    column.append(list(values))
                out[3].append(int((~legal(initial[:-1], initial[1:])).sum()))
                out[4].append(int(initial[0]))
                out[5].append(int(initial[-1]))
            kinds = [pa.list_(pa.list_(pa.string())), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                                             ["_conv", "_chunk", "moves", "cost", "state", "illegal", "first", "last"])

    traced = shared_table(map_arrow(known.select("_conv", "_chunk", "_codes", "_last", "_only", "_behind"), traces,
                                    "_conv string, _chunk long, moves array<array<string>>, cost array<long>, state array<int>, "
                                    "illegal long, first int, last int"), "turns")
    begins = _folded(traced.filter("size(state) > 1"), ["state"], "0", False, "state", "_begin")
    begin = F.coalesce(F.col("_begin"), F.lit(0))
    return shared_table(traced.join(begins, ["_conv", "_chunk"], "left").select(
        "_conv", "_chunk", F.get("moves", begin).alias("moves"), F.get("cost", begin).alias("cost"), "illegal", "first", "last"), "turns")


def legal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """su, ua and au, by the initials' numbers."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


def repaired_digests(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """(_conv, repaired_sha256): of the repaired turns, ``role:text`` and a line feed between them."""
    each = moves.select("_conv", "_chunk", F.posexplode("moves").alias("_i", "_moves")).select(
        "_conv", (F.col("_chunk") * CHUNK + F.col("_i")).alias("_pos"), "_moves")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = (rows.select("_conv", "_pos", "role", "text").join(each, ["_conv", "_pos"])
              .repartition(parts, "_conv").sortWithinPartitions("_conv", "_pos").select("_conv", "_moves", "role", "text"))
    put = {"u": "user:", "a": "assistant:"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, some = None, hashlib.sha256(), False
        for batch in batches:
            done: list[tuple[str, str]] = []
            for c, moves_, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if c != conv:
                    if conv is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest, some = c, hashlib.sha256(), False
                for m in moves_:
                    if m == "D":
                        continue
                    line = put.get(m) or {"K": f"{role}:", "U": "user:", "A": "assistant:"}[m] + text
                    digest.update((("\n" if some else "") + line).encode())
                    some = True
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in range(2)], ["_conv", "repaired_sha256"])
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], ["_conv", "repaired_sha256"])

    return map_arrow(inside, run, "_conv string, repaired_sha256 string")


def repair(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """One row for every conv_id of ``conversations`` (conv_id, turn, role, text): its
    faults, the cheapest edits that mend it, their cost, and the digest of the mended conversation."""
    plain = conversations.select(conversation_key(), F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text"))
    rows = shared_table(faults(damaged(conversations) if damage else plain), "turns")
    moves = edits(rows)
    counts = rows.groupBy("_conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(c).alias(name) for c, name in (("_blank", "blank"), ("_repeated", "duplicate"), ("_cut", "truncated"))])
    previous = F.lag("last").over(Window.partitionBy("_conv").orderBy("_chunk"))        # a row for CHUNK turns
    fine = ((previous == 0) & (F.col("first") == 1)) | ((previous == 1) & (F.col("first") == 2)) | ((previous == 2) & (F.col("first") == 1))
    letters = F.translate(F.array_join("moves", ""), "uaUA", "IIRR")
    whole = (moves.withColumn("_seam", F.when(previous.isNotNull() & ~fine, 1).otherwise(0)).groupBy("_conv")
             .agg((F.sum("illegal") + F.sum("_seam")).alias("illegal"), F.sum("cost").alias("cost"),
                  F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", letters.alias("a")))), lambda x: x["a"]), "").alias("audit")))
    every = conversations.select("conv_id", conversation_key()).distinct()
    out = every.join(counts, "_conv", "left").join(whole, "_conv", "left").join(repaired_digests(rows, moves), "_conv", "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations`` after the damage."""
    return repair(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), damage=True)

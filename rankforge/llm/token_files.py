"""Token-id files with Elias-Fano encoded document boundaries.

A file holds the ids of many documents, one array without gaps, and two
monotone sequences in Elias-Fano form: the documents' start offsets and their
doc_ids.  A sequence of n values below u takes about 2 + log2(u / n) bits a
value; a sampled select over its upper bits returns any value without a table
of 64-bit offsets.

Texts are encoded where they are read; only ids are shuffled, to ranges of
doc_id chosen from the column alone, and sorted there.  A task cuts its range
into files of bounded size.  Files are written by Spark's committer (each is
one row of raw bytes, so each ends with a line feed) under ``part=/piece=/
tokens=`` folders, which serve as the manifest: a file's first offset in the
whole corpus is the sum of the ``tokens`` before it, known without opening any.

Defined results: a null or empty text is the end id alone; null doc_ids come
first; rows that share a doc_id are ordered by their ids; an empty table gives
no files and an empty result.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import map_arrow, read, shared_table
from rankforge.llm.runs import ColumnMemo, chained, ship, small_batches, split_runs, text_chunks
from rankforge.session import checkpoint_dir, scratch_path

MAGIC = b"IDSEF001"
#: A file is closed at so many ids; a range is meant to hold so many bytes of text.
FILE_IDS, RANGE_BYTES, RANGES_MOST = 2 << 20, 16 << 20, 1 << 16
#: Runs a worker remembers.
MEMO_RUNS = 600_000
#: One select sample for so many values.
SAMPLE = 128


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.ascontiguousarray(values, dtype="<u8")
        n = len(v)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = np.unpackbits(v.view(np.uint8).reshape(n, 8), axis=1, bitorder="little", count=max(low_bits, 1))[:, :low_bits]
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(bits, bitorder="little"), np.packbits(high, bitorder="little"),
                   ones[::SAMPLE].astype(np.uint32))

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        chunk = int.from_bytes(self.low[first // 8:(first + self.low_bits + 7) // 8].tobytes(), "little")
        return chunk >> first % 8 & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value number i: from the sample before it count on over the upper bits."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        word = int(self.high[byte]) >> at % 8 << at % 8
        while (ones := word.bit_count()) <= left:
            left, byte = left - ones, byte + 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        at = byte * 8 + (word & -word).bit_length() - 1
        return (at - i) << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """Every value."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little")).astype(np.uint64)
        bits = np.zeros((self.n, 64), dtype=np.uint8)
        bits[:, :self.low_bits] = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        low = np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)
        return ((ones - np.arange(self.n, dtype=np.uint64)) << np.uint64(self.low_bits)) | low

    def dump(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)], dtype="<u8")
        return b"".join([head.tobytes(), self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()])

    @classmethod
    def parse(cls, raw: memoryview) -> tuple[EliasFano, int]:
        """The sequence at the start of ``raw`` and where it ends."""
        n, low_bits, a, b, c = (int(x) for x in np.frombuffer(raw[:40], dtype="<u8"))
        ends = np.cumsum([40, a, b, 4 * c]).tolist()
        return cls(n, low_bits, np.frombuffer(raw[40:ends[1]], dtype=np.uint8), np.frombuffer(raw[ends[1]:ends[2]], dtype=np.uint8),
                   np.frombuffer(raw[ends[2]:ends[3]], dtype="<u4")), ends[3]


def pack(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One file: nulls first, then ascending doc_ids; ``ids`` little-endian of ``width`` bytes."""
    nulls = sum(x is None for x in doc_ids)
    known = np.array(doc_ids[nulls:], dtype=np.int64)
    base = int(known[0]) if len(known) else 0
    starts = np.cumsum([0, *[len(x) // width for x in ids]])
    head = np.array([len(ids), int(starts[-1]), width, nulls, base & (1 << 64) - 1], dtype="<u8")
    away = known.view(np.uint64) - np.uint64(base & (1 << 64) - 1)
    return b"".join([MAGIC, head.tobytes(), EliasFano.of(starts).dump(), EliasFano.of(away).dump(), *ids])


def unpack(content: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """doc_ids, boundaries (one more than documents) and ids of a file."""
    raw = memoryview(content)
    if bytes(raw[:8]) != MAGIC:
        raise ValueError("not a token-id file")
    n, total, width, nulls, base = (int(x) for x in np.frombuffer(raw[8:48], dtype="<u8"))
    starts, end = EliasFano.parse(raw[48:])
    away, more = EliasFano.parse(raw[48 + end:])
    at = 48 + end + more
    ids = np.frombuffer(raw[at:at + total * width], dtype=f"<u{width}")
    known = (away.all() + np.uint64(base)).view(np.int64).tolist()
    if starts.n != n + 1 or len(ids) != total:
        raise ValueError("a token-id file is cut short")
    return [None] * nulls + known, starts, ids


_memos: dict[str, tuple[ColumnMemo, int]] = {}


def _memo(name: str) -> tuple[ColumnMemo, int]:
    if name not in _memos:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer, pre_tokenizers

        library = Tokenizer.from_file(SparkFiles.get(name))
        library.no_truncation()
        library.no_padding()
        size = library.get_vocab_size()
        kind = "<u2" if size <= 1 << 16 else "<u4"
        suffix = getattr(library.model, "end_of_word_suffix", None)
        # the same vocabulary for words that need no normalising and are one piece each: only bytes and merges are left to do
        plain = Tokenizer(library.model)
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(),
                                                       pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends_word = np.array([bool(suffix) and (library.id_to_token(i) or "").endswith(suffix) for i in range(size)])

        def column(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
            offsets = np.concatenate(([0], cuts * ids.itemsize)).astype(np.int64)
            return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])

        def whole(texts: list[str]) -> pa.Array:
            coded = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
            return column(np.array([i for ids in coded for i in ids], dtype=kind), np.cumsum([len(ids) for ids in coded], dtype=np.int64))

        def encode(runs: pa.Array) -> pa.Array:
            simple = pc.and_(pc.utf8_is_alpha(runs), pc.utf8_is_lower(runs)).to_numpy(zero_copy_only=False) & bool(suffix)
            words, out = runs.filter(pa.array(simple)), []
            for at in range(0, len(words), 4096):
                own = words.slice(at, 4096).to_pylist()
                text = " ".join(own)
                ids = np.array(plain.encode(text, add_special_tokens=False).ids, dtype=kind)
                cuts = np.flatnonzero(ends_word[ids]) + 1
                # not so if a letter is one to the column functions only, or not in its normal form
                out.append(column(ids, cuts) if len(cuts) == len(own) and unicodedata.is_normalized("NFC", text) else whole(own))
            rest = runs.filter(pa.array(~simple)).to_pylist()
            order = np.empty(len(runs), dtype=np.int64)
            order[np.flatnonzero(simple)] = np.arange(len(words))
            order[np.flatnonzero(~simple)] = len(words) + np.arange(len(rest))
            return pa.concat_arrays([*out, whole(rest)]).take(pa.array(order))

        _memos[name] = ColumnMemo(encode, MEMO_RUNS), np.dtype(kind).itemsize
    return _memos[name]


def write_token_files(docs: DataFrame, vocabulary: str, path: str, end_id: int = 2, file_ids: int = FILE_IDS) -> None:
    """Encodes all texts, each with ``end_id`` after it, into files under ``path``."""
    name = ship(docs.sparkSession, vocabulary)
    known = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    ranges = max(1, min(RANGES_MOST, -(-known // RANGE_BYTES)))
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / ranges for i in range(1, ranges)] or [0.5],
                                        max(10_000, 20 * ranges))).first()[0] or []
    edges = np.array(cuts if ranges > 1 else [], dtype=np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, width = _memo(name)
        end = end_id.to_bytes(width, "little")
        for batch in text_chunks(batches, 1):
            firsts, indices, distinct = split_runs(batch.column(1))
            values, place = memo.of(distinct)
            flat, at = chained(values, pa.array(place[indices.to_numpy()]))
            cuts = at[firsts].tolist()
            ids = [bytes(flat[a:b]) + end for a, b in zip(cuts, cuts[1:])]
            at = np.searchsorted(edges, batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0), pa.array(ids, pa.binary()),
                                              pa.array([width] * len(ids), pa.int32())], ["part", "doc_id", "ids", "width"])

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        size = piece = part = 0
        width = 2

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([size // width], pa.int64()),
                pa.array([pack(doc_ids, ids, width)], pa.binary())], ["part", "piece", "tokens", "content"])

        for batch in batches:
            for p, d, x, w in (row for part in small_batches(batch) for row in zip(*[c.to_pylist() for c in part.columns])):
                if ids and (size + len(x) > file_ids * w or p != part):
                    yield close()
                    ids, doc_ids, size, piece = [], [], 0, piece + 1 if p == part else 0
                part, width = p, w
                ids.append(x)
                doc_ids.append(d)
                size += len(x)
        if ids:
            yield close()

    coded = map_arrow(docs.select(F.col("doc_id").cast("long"), F.make_valid_utf8("text")), encode,
                      "part int, doc_id long, ids binary, width int")
    ordered = coded.repartitionById(int(ranges), "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "ids")
    (map_arrow(ordered, files, "part int, piece int, tokens long, content binary")
     .withColumn("content", F.col("content").cast("string"))
     .write.partitionBy("part", "piece", "tokens").text(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files under ``path``."""
    stored = spark.read.format("binaryFile").load(path)
    if "part" not in stored.columns:  # no documents, no files
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    stored = stored.withColumn("tokens", F.col("tokens").cast("long"))
    manifest = stored.select("part", "piece", "tokens")
    in_part = Window.partitionBy("part").orderBy("piece")
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("_n"))  # at most RANGES_MOST rows
    parts = parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    firsts = shared_table(manifest.join(F.broadcast(parts), "part").select(
        "part", "piece", (F.col("_before") + F.sum("tokens").over(in_part) - F.col("tokens")).alias("_first")), "token-files")
    if firsts.count() <= 200_000:  # three numbers a row
        firsts = F.broadcast(firsts)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, piece, content in zip(*batch.columns):  # one file at a time
                part, piece = part.as_py(), piece.as_py()
                doc_ids, bounds, ids = unpack(content.as_py())
                starts = bounds.all().astype(np.int64)
                flat = memoryview(ids.astype("<u4")).cast("B")
                ends = (4 * starts).tolist()
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int32()), pa.array([piece] * n, pa.int32()), pa.array(doc_ids, pa.int64()),
                    pa.array(starts[:-1]), pa.array(np.diff(starts)),
                    pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())],
                    ["part", "piece", "doc_id", "_at", "n_tokens", "ids_crc32"])

    rows = map_arrow(
        stored.select("part", "piece", "content"), documents, "part int, piece int, doc_id long, _at long, n_tokens long, ids_crc32 long")
    return rows.join(firsts, ["part", "piece"]).select("doc_id", (F.col("_first") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the files written of all texts."""
    import public_tokenizers

    checkpoint_dir(spark)
    path = scratch_path(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return read_token_files(spark, path)

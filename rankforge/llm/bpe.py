"""BPE encoding and decoding with a contiguous rank array.

A word's parts lie in one row of boundaries, with the rank of each part's
merge with its right neighbour in a row beside it.  The smallest rank is
searched by a plain scan (words are short), its boundary is deleted, and the
ranks of the two neighbours are refreshed.  The rows of many words form an array,
so one scan serves them all; a word too long for scans is done with a heap
over the same ranks.  Both give the same parts.

Whole texts are cut at ASCII white space, which no token spans; every distinct
run between is normalised, split and merged once (a bounded memo per worker),
and a document is the concatenation of its runs.  Vocabulary, merges, special
tokens and normaliser come from a tokenizers-library JSON file whose path is a
parameter.  The merging is done here; of that library only the regex classes
for letters and numbers are asked for, because they differ between Unicode
versions.

Defined results: a null or empty text has no tokens and decodes to the empty
string; special-token strings inside a text give their special ids; repeated
rows give repeated results; an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import map_arrow, read
from rankforge.llm.runs import RunMemo, chained, ship, split_runs, text_chunks

#: Words of more parts than this are merged with a heap.
SCAN_MOST = 64
#: Bytes of text looked at together, and runs remembered: a run's two texts take more room than its ids.
TEXT_BYTES, MEMO_RUNS = 8 << 20, 300_000
_NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


def char_class(pattern: str) -> str:
    """The characters that a one-character pattern of the tokenizers library
    matches, as the inside of a character class."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
    hits = []
    for base in range(0, 0x110000, 4096):
        block = "".join(chr(c) for c in range(base, base + 4096) if not 0xD800 <= c < 0xE000)
        hits += [ord(t) for t, _ in split.pre_tokenize_str(block)] if block else []
    ends = np.flatnonzero(np.diff(np.array(hits)) > 1)
    return "".join(f"{re.escape(chr(hits[a]))}-{re.escape(chr(hits[b]))}" for a, b in
                   zip([0, *(ends + 1).tolist()], [*ends.tolist(), len(hits) - 1]))


class PairRanks:
    """Rank of (left id, right id), for whole arrays: one probe of a table, and
    a second table without collisions for the few pairs that lost their slot."""

    def __init__(self, pairs: np.ndarray):
        self.keys = np.append(pairs, np.iinfo(np.int64).min)
        self.tables = []
        left, size = np.arange(len(pairs)), 1 << 22
        multiplier = 0x9E3779B97F4A7C15
        while left.size:
            shift, table = 64 - size.bit_length() + 1, np.full(size, len(pairs), dtype=np.int32)
            slot = self._slot(pairs[left], multiplier, shift)
            table[slot] = left
            self.tables.append((multiplier, shift, table))
            left = left[table[slot] != left]
            multiplier, size = (multiplier * 6364136223846793005 + 1442695040888963407) % (1 << 64) | 1, 1 << 16

    @staticmethod
    def _slot(key: np.ndarray, multiplier: int, shift: int) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(multiplier) >> np.uint64(shift)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(key.shape, _NONE, dtype=np.int32)
        for multiplier, shift, table in self.tables:
            rank = table[self._slot(key, multiplier, shift)]
            hit = self.keys[rank] == key
            out[hit] = rank[hit]
        return out


class WordBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix: str = model.get("end_of_word_suffix") or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(merges)}
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        self.ranks = PairRanks(np.array([a << 32 | b for a, b in self.pairs], dtype=np.int64))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        # how the file normalises and splits is done by hand here; anything else must not pass unnoticed
        split = spec["pre_tokenizer"]["pretokenizers"]
        if ([s["type"] for s in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]
                or [s["type"] for s in split] != ["Split", "ByteLevel"] or split[0]["behavior"] != "Removed"
                or not split[0]["invert"] or len(self.pairs) != len(merges)):
            raise ValueError("this file's normaliser, pre-tokenizer or merges are not supported")
        pattern = split[0]["pattern"]["Regex"]
        for escape in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(escape, char_class(escape))
        white = char_class(r"\s")
        self.pieces = re.compile("[\n]|" + pattern.replace(r"\s", white))
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], dtype=np.int32)
        self.last = np.array([vocab[s + suffix] for s in symbols], dtype=np.int32)
        self.cut = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")")

    def _merge_rows(self, ids: np.ndarray) -> list[list[int]]:
        """Rows of parts, padded with -1 on the right, merged until no neighbours have a rank."""
        final = np.full(ids.shape, -1, dtype=np.int32)
        row = np.arange(len(ids))
        ranks = self.ranks.of(ids[:, :-1], ids[:, 1:])
        while row.size:
            width = ids.shape[1] - 1
            r = np.arange(len(row))
            at = ranks.argmin(1) if width else np.zeros(len(row), dtype=np.int64)
            low = ranks[r, at] if width else np.full(len(row), _NONE)
            over = np.flatnonzero(low == _NONE)
            if over.size:
                final[row[over], :width + 1] = ids[over]
                live = low != _NONE
                ids, ranks, row, at, low = ids[live], ranks[live], row[live], at[live], low[live]
                if not row.size:
                    break
                r = r[:len(row)]
            ids[r, at] = self.made[low]
            # delete the boundary after the part that was made: all behind it move up by one
            column = np.arange(width, dtype=np.int8 if width < 127 else np.int64)
            behind = column > at[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            ranks = np.where(behind[:, 1:] | (column[:-1] == at[:, None]), ranks[:, 1:], ranks[:, :-1])
            right = np.flatnonzero(at < width - 1)
            at_right = at[right]
            ranks[right, at_right] = self.ranks.of(ids[right, at_right], ids[right, at_right + 1])
            left = np.flatnonzero(at > 0)
            at_left = at[left]
            ranks[left, at_left - 1] = self.ranks.of(ids[left, at_left - 1], ids[left, at_left])
        return [x[:n] for x, n in zip(final.tolist(), (final >= 0).sum(1).tolist())]

    def _merge_heap(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.pairs.get
        after, before, gone = [*range(1, n + 1)], [*range(-1, n - 1)], [False] * n

        def push(i: int, j: int) -> None:
            if (rank := get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        heap: list[tuple] = []
        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            if gone[i] or ids[i] != a or (j := after[i]) >= n or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = int(self.made[rank]), True, after[j]
            if after[i] < n:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return [x for x, dead in zip(ids, gone) if not dead]

    def merge(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of each distinct word, already normalised and split."""
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        order = np.argsort(sizes, kind="stable")
        out, at = {}, 0
        while at < len(order) and sizes[order[at]] <= SCAN_MOST:
            wide = min(max(6, 3 * int(sizes[order[at]]) // 2), SCAN_MOST)
            to = int(np.searchsorted(sizes[order], wide, side="right"))
            own, n = order[at:to], sizes[order[at:to]]
            wide = int(n[-1])
            got = np.frombuffer(b"".join([raw[i].ljust(wide, b"\0") for i in own.tolist()]), dtype=np.uint8).reshape(-1, wide)
            ids = self.first[got]
            ids[np.arange(wide) >= n[:, None]] = -1
            ids[np.arange(len(ids)), n - 1] = self.last[got[np.arange(len(ids)), n - 1]]
            out.update(zip([pieces[i] for i in own.tolist()], self._merge_rows(ids)))
            at = to
        for i in order[at:].tolist():
            got = np.frombuffer(raw[i], dtype=np.uint8)
            out[pieces[i]] = self._merge_heap([*self.first[got[:-1]].tolist(), int(self.last[got[-1]])])
        return out

    def split(self, texts: list[str]) -> list[list]:
        """The pieces of each text: words as strings, special tokens as ids."""
        plain, shape = [], []
        for t in texts:
            parts = self.cut.split(t) if "<" in t else [t]
            plain += parts[::2]
            shape.append([self.special[p] for p in parts[1::2]])
        # lower case without context: a final sigma is an ordinary one
        joined = unicodedata.normalize("NFC", "\n".join(plain)).replace("\u03a3", "\u03c3").lower()
        groups: list[list] = [[]]
        for piece in self.pieces.findall(joined):
            if piece == "\n":
                groups.append([])
            else:
                groups[-1].append(piece)
        out, at = [], 0
        for specials in shape:
            own = groups[at]
            for k, special in enumerate(specials, 1):
                own = [*own, special, *groups[at + k]]
            out.append(own)
            at += 1 + len(specials)
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text that has no line feed."""
        split = self.split(texts)
        ids = self.merge([*{p for own in split for p in own if isinstance(p, str)}])
        return [ids[own[0]] if len(own) == 1 and isinstance(own[0], str) else
                [i for p in own for i in (ids[p] if isinstance(p, str) else (p,))] for own in split]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a blank, as a file without a decoder says."""
        return " ".join([self.token[i] for i in ids])


_loaded: dict[str, RunMemo] = {}


def memo_of(name: str) -> RunMemo:
    """One per worker and vocabulary: of a run the ids and the decoded text, each
    with a blank after every token, and the number of ids."""
    if name not in _loaded:
        with open(SparkFiles.get(name), encoding="utf-8") as f:
            bpe = WordBpe(json.load(f))
        digits = [f"{i} " for i in range(max(bpe.token) + 1)]

        def make(runs: list[str]) -> list[tuple[bytes, bytes, int]]:
            return [("".join([digits[i] for i in ids]).encode(), (bpe.decode(ids) + " " * bool(ids)).encode(), len(ids))
                    for ids in bpe.encode(runs)]

        def chain(a: tuple, b: tuple) -> tuple[bytes, bytes, int]:
            return a[0] + b[0], a[1] + b[1], a[2] + b[2]

        _loaded[name] = RunMemo(make, chain, (b"", b"", 0), MEMO_RUNS)
    return _loaded[name]


def tokenize(docs: DataFrame, vocabulary: str, ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every document, and
    with ``ids`` the token ids themselves.  The decoded text is made from the
    ids, token by token."""
    name = ship(docs.sparkSession, vocabulary)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")

    def digests(flat: memoryview, cuts: list[int]) -> pa.Array:
        # without the blank after the last token
        return pa.array([hashlib.sha256(flat[a:max(a, b - 1)]).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = memo_of(name)
        for batch in text_chunks(batches, 1, TEXT_BYTES):
            firsts, indices, distinct = split_runs(batch.column(1))
            known = memo.of(distinct.to_pylist())
            numbers, at = chained([x[0] for x in known], indices)
            cuts = at[firsts].tolist()
            tokens, at = chained([x[1] for x in known], indices)
            counts = np.concatenate(([0], np.cumsum(np.array([x[2] for x in known], dtype=np.int64)[indices.to_numpy()])))[firsts]
            cols = [batch.column(0), pa.array(np.diff(counts)), digests(numbers, cuts), digests(tokens, at[firsts].tolist())]
            if ids:
                flat = np.fromstring(bytes(numbers[:cuts[-1]]), dtype=np.int32, sep=" ")
                cols.append(pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols)])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.make_valid_utf8("text")), run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: counts and digests of both."""
    return tokenize(read(spark, sf_dir, "documents"), default_vocabulary())

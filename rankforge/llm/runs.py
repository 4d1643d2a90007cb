"""Tokenizing whole texts run by run: no token spans ASCII white space, so a
text is the chain of its runs between, and a distinct run is tokenized once per
worker and remembered.  Splitting, finding the distinct runs of a batch and
chaining their values are done on whole Arrow columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text that are split together; runs a worker remembers; the longest one remembered.
CHUNK_BYTES, MEMO_MOST, MEMO_LONGEST = 12 << 20, 400_000, 64
#: Marks that no word holds: a word and the marks after it are tokenized apart.
MARKS = ".,!?;:"


def split_runs(texts: pa.StringArray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Where each text's runs begin in the list of all runs, the runs as indexes,
    and the distinct runs.

    Texts are put in ASCII lower case, but for those that may hold a special
    token, which is told apart by case.
    """
    plain = pc.fill_null(texts, "")
    plain = pc.if_else(pc.match_substring(plain, "<"), plain, pc.ascii_lower(plain))
    runs = pc.ascii_split_whitespace(plain)
    del plain
    found = runs.flatten().dictionary_encode()
    firsts = runs.offsets.to_numpy().astype(np.int64) - runs.offsets[0].as_py()
    return firsts, found.indices, found.dictionary


def chained(values: list[bytes] | pa.Array, indices: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The values of all runs in order, one after the other, and where each begins."""
    taken = (values if isinstance(values, pa.Array) else pa.array(values, pa.large_binary())).take(indices)
    ends = np.frombuffer(taken.buffers()[1], dtype=np.int64)[taken.offset:taken.offset + len(taken) + 1]
    return memoryview(taken.buffers()[2] or b""), ends


class RunMemo:
    """What ``make`` gives for each distinct run, remembered up to a bound in two
    halves: when the newer one is full the older one is dropped.

    For vocabularies in lower case that cut words from punctuation: a run that
    ends in an ASCII letter and marks is the ``chain`` of both.  The empty run
    gives ``empty``.
    """

    def __init__(self, make: Callable[[list[str]], list], chain: Callable, empty, most: int = MEMO_MOST):
        self.make, self.chain, self.empty, self.most = make, chain, empty, most
        self.known: dict = {"": empty}
        self.older: dict = {}

    def of(self, distinct: list[str]) -> list:
        found = [*map(self.known.get, distinct)]
        gaps = [i for i, x in enumerate(found) if x is None]
        old = [*map(self.older.get, [distinct[i] for i in gaps])]
        if len(self.known) + len(gaps) > self.most // 2:  # what is still in use has just come back from the older half
            self.known, self.older = {"": self.empty}, self.known
        for i, x in zip(gaps, old):
            if x is not None:
                found[i] = self.known[distinct[i]] = x
        gaps = [i for i, x in zip(gaps, old) if x is None]
        if gaps:
            values = self._learn([distinct[i] for i in gaps])
            for i, x in zip(gaps, values):
                found[i] = x
            self.known.update([(distinct[i], x) for i, x in zip(gaps, values) if len(distinct[i]) <= MEMO_LONGEST])
        return found

    def _learn(self, new: list[str]) -> list:
        known, chain = self.known, self.chain
        words = [r.rstrip(MARKS) for r in new]
        parts = [(r, w, r[len(w):]) for r, w in zip(new, words) if len(w) < len(r) and "a" <= w[-1:] <= "z"]
        need = set(new).difference([r for r, _, _ in parts])
        need.update([w for _, w, _ in parts], [m for _, _, m in parts])
        wanted = [*need.difference(known)]
        made = dict(zip(wanted, self.make(wanted)))

        def value(run: str):
            return made[run] if run in made else known[run]

        made.update([(r, chain(value(w), value(m))) for r, w, m in parts])
        return [made[r] for r in new]


def text_chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (at least one row):
    the more text, the fewer distinct runs there are to a run."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        out = held[0] if len(held) == 1 else pa.concat_batches(held)
        held.clear()
        return out

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most - size, side="right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - before
            at = to
            if size >= most or at < batch.num_rows:
                yield joined()
                size = 0
                pa.default_memory_pool().release_unused()  # an executor's memory is shared with its other workers
    if held:
        yield joined()


def ship(spark: SparkSession, path: str) -> str:
    """Sends the vocabulary file to every executor; the name to load it by."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


class ColumnMemo:
    """``RunMemo`` for values that are bytes, kept as Arrow columns: a remembered
    run takes its letters, its value and twelve bytes, and finding the runs of a
    text among them is one lookup of a whole column."""

    def __init__(self, encode: Callable[[pa.Array], pa.Array], most: int):
        self.encode, self.most = encode, most
        self.words, self.values = pa.array([""], pa.string()), pa.array([b""], pa.large_binary())

    def of(self, distinct: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All values, and for each of the distinct runs which one is its own."""
        at = pc.index_in(distinct, value_set=self.words)
        missing = at.is_null()
        new = distinct.filter(missing)
        place = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        values = self.values
        if len(new):
            place[missing.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
            values = pa.concat_arrays([self.values, self._learn(new)])
            self.words, self.values = pa.concat_arrays([self.words, new]), values
            if len(self.words) > self.most:  # the older half goes
                self.words, self.values = (pa.concat_arrays([pa.array(first, x.type), x.slice(len(x) - self.most // 2)])
                                           for first, x in (([""], self.words), ([b""], self.values)))
        return values, place

    def _learn(self, new: pa.Array) -> pa.Array:
        words = pc.utf8_rtrim(new, MARKS)
        ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1]
        letters = np.frombuffer(words.buffers()[2] or b"\0", dtype=np.uint8)
        last = letters[np.maximum(ends[1:] - 1, 0)]
        apart = (np.diff(ends) < pc.binary_length(new).to_numpy()) & (np.diff(ends) > 0) & (last >= 97) & (last <= 122)
        whole, base = new.filter(pa.array(~apart)), words.filter(pa.array(apart))
        marks = pc.replace_substring_regex(new.filter(pa.array(apart)), pattern=f"^.*?([{MARKS}]+)$", replacement=r"\1")
        need = pc.unique(pa.concat_arrays([whole, base, marks]))
        made = self.encode(need)

        def value(runs: pa.Array) -> pa.Array:
            return made.take(pc.index_in(runs, value_set=need))

        both = pc.binary_join_element_wise(value(base), value(marks), pa.scalar(b"", pa.large_binary()))
        order = np.empty(len(new), dtype=np.int64)
        order[np.flatnonzero(~apart)] = np.arange(len(whole))
        order[np.flatnonzero(apart)] = len(whole) + np.arange(len(base))
        return pa.concat_arrays([value(whole), both]).take(pa.array(order))


def small_batches(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that are cheap to hold as Python objects."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))

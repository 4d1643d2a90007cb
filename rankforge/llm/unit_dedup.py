"""Substring dedup by line hashing.

A text's units are its lines, and within a line its sentences, so that a
passage pasted into the middle of a line is found as well.  Units are
normalised (ASCII letters lower-cased, white space runs as one blank) and
digested to 128 bits; digests are grouped over the whole corpus.  The earliest
occurrence by rank (doc_id, null last; then the text's digest; then the offset)
stays and the others go, unless the run of touching units that would go holds
no whole line and has under ``min_words`` words: chance repeats of very short
sentences are no passages, but a whole line goes however short it is.  A line
of several sentences with under ``min_words`` words has an empty unit at its
end, which is repeated if they all are, in this order.  Offsets are bytes of the original text in UTF-8.

Counts are partial aggregates, and the units are joined with their group by
broadcasting the few digests that make up a large share of all units, so a
line in a third of all documents burdens no task.

Defined results: null, empty and blank texts have no units and stay as they
are; rows equal in doc_id and text are one document and all get its result;
ties cannot occur between different documents; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from functools import partial

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import lookup_join, read, shared_table
from rankforge.llm.spans import KEY, pieces, removed_spans, without_spans

#: A unit ends with a line, or with one full stop, question or exclamation mark and blanks.
_END = re.compile(rb"(?<![.!?])[.!?][ \t\r]+|\n\s*")
#: Added to the words of a whole line: a run with one goes however few words it has.
WHOLE = 1 << 30


def units(text: bytes, short: int = 8) -> tuple[list[bytes], list[int], list[int], list[int]]:
    """Digests, starts, ends and words of a text's units; whole lines have WHOLE more.
    A line of several sentences with under ``short`` words is a unit besides them."""
    digests, starts, ends, sizes = [], [], [], []
    digest, low, at, line = xxhash.xxh3_128_digest, text.lower(), 0, 0
    for end in [*[m.end() for m in _END.finditer(text)], len(text)]:
        words = low[at:end].split()
        if words:
            digests.append(digest(b" ".join(words)))
            starts.append(at)
            ends.append(end)
            sizes.append(len(words))
        if end == len(text) or b"\n" in text[at:end]:
            if len(sizes) - line == 1:
                sizes[-1] += WHOLE
            elif len(sizes) > line and sum(sizes[line:]) < short:
                digests.append(digest(b"".join(digests[line:])))
                starts.append(ends[-1])
                ends.append(ends[-1])
                sizes.append(WHOLE)
            line = len(sizes)
        at = end
    return digests, starts, ends, sizes


def repeated(found: DataFrame) -> DataFrame:
    """Digests met more than once: (d1, d2, first, copies); first is the earliest occurrence."""
    return (found.groupBy("d1", "d2").agg(F.min(F.struct(*KEY, "start")).alias("first"), F.count(F.lit(1)).alias("copies"))
            .filter("copies > 1"))


def dedup_units(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """``docs`` with ``text`` cut and ``_removed``, the byte spans that went."""
    found = shared_table(pieces(docs, partial(units, short=min_words)), "units")
    groups = shared_table(repeated(found), "units")
    later = lookup_join(found, groups, ["d1", "d2"], "copies").filter(F.struct(*KEY, "start") != F.col("first"))
    return without_spans(docs, removed_spans(later, min_words))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text and the spans removed."""
    out = dedup_units(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("_removed").cast("long").alias("n_removed"),
                      F.expr("aggregate(_removed, 0L, (a, x) -> a + x.end - x.start)").alias("bytes_removed"),
                      F.col("_removed").alias("removed"), "text")

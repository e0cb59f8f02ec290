"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words; a word goes if a window that covers it also starts in a
document with a smaller id. A window's minimiser is the smallest hash among its runs of ``MINIMISER``
words; consecutive windows with one minimiser form a super-k-mer, which travels as one packed string
(50 words for its first window, one more for each further one) to the minimiser's bucket. There
the strings are sorted by document, and a table of the bucket's windows gives each window's first
document. There windows are compared as words, not as hashes.

What travels is cut down first: equal texts are folded into the one with the smallest id, and
minimisers alone (no text) show which buckets hold windows of two documents at all - a window
without such a minimiser cannot repeat. Minimisers shared by more than ``HOT`` texts would make a bucket
that one task cannot hold: their windows travel one by one as 128-bit BLAKE2b digests of their words, pre-aggregated by
Spark, so there equal digests stand for equal words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import flat, signed, slices, span_hash, windows, word_spans, written

WINDOW = 50
MINIMISER = 10
HOT = 2000


def _digest(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive elements (fewer at the end), by doubling."""
    span = 1
    while span * 2 <= size:
        y = x.copy()
        y[:len(x) - span] = np.minimum(x[:len(x) - span], x[span:])
        x, span = y, span * 2
    rest = size - span
    if rest:
        y = x.copy()
        y[:len(x) - rest] = np.minimum(x[:len(x) - rest], x[rest:])
        x = y
    return x


def super_kmers(buf: np.ndarray, off: np.ndarray, window: int, minimiser: int):
    """(row, minimiser hash, first window, number of windows) of all super-k-mers, and word offsets of the rows."""
    starts, ends, words = word_spans(buf, off)
    ids = span_hash(buf, starts, ends)
    at, rows = windows(words, minimiser)
    small = span_hash(ids, at, at + minimiser)
    n_small = np.maximum(np.diff(words) - minimiser + 1, 0)
    small_off = np.concatenate([[0], np.cumsum(n_small)])
    begin, rows = windows(small_off, window - minimiser + 1)
    low = sliding_min(small, window - minimiser + 1)[begin]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (rows[1:] != rows[:-1])
    cut = np.flatnonzero(new)
    return rows[cut], low[cut], (begin - small_off[:-1][rows])[cut], np.diff(np.append(cut, len(low))), words


def _first_pass(window: int, minimiser: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            buf, off = flat(batch.column("text"))
            row, low, first, many, words = super_kmers(buf, off, window, minimiser)
            raw = buf.tobytes()
            sha = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(off[:-1], off[1:])]
            of = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("digest"), pa.array(np.diff(words), pa.int64()), pa.array(sha),
                pa.ListArray.from_arrays(of, pa.array(signed(low))), pa.ListArray.from_arrays(of, pa.array(first.astype(np.int32))),
                pa.ListArray.from_arrays(of, pa.array(many.astype(np.int32)))],
                names=["doc_id", "digest", "n_words", "sha", "low", "first", "many"])
    return run


def _pack(window: int):
    """Packed strings of the listed super-k-mers of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for d in batch.select(["digest", "first_id", "text", "spans"]).to_pylist():
                words = d["text"].encode().split()
                out += [(s["low"], d["first_id"], d["digest"], s["first"], b" ".join(words[s["first"]:s["first"] + s["many"] + window - 1]))
                        for s in d["spans"] if not s["hot"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()))],
                names=["low", "first_id", "digest", "first", "words"])
    return run


def _sweep(window: int):
    """Buckets one after the other, each sorted by document: runs of windows met before in a smaller document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, seen = None, {}
        for batch in batches:
            out = []
            for low, id_, digest, first, packed in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if low != bucket:
                    bucket, seen = low, {}
                cut = [-1]
                at = packed.find(b" ")
                while at >= 0:
                    cut.append(at)
                    at = packed.find(b" ", at + 1)
                cut.append(len(packed))
                begin = None
                n = len(cut) - window
                for i in range(n):
                    repeat = seen.setdefault(packed[cut[i] + 1:cut[i + window]], id_) < id_
                    if repeat and begin is None:
                        begin = i
                    elif not repeat and begin is not None:
                        out.append((digest, first + begin, first + i))
                        begin = None
                if begin is not None:
                    out.append((digest, first + begin, first + n))
            yield _runs(out)
    return run


def _runs(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.int32(), pa.int32()))],
                                      names=["digest", "a", "b"])


def _single(window: int):
    """128-bit BLAKE2b digests of the windows, as words joined by one space, of the super-k-mers of frequent minimisers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            marks, rows, at = [], [], []
            for row, (text, spans) in enumerate(zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())):
                words = text.encode().split()
                for s in spans:
                    if s["hot"]:
                        for i in range(s["first"], s["first"] + s["many"]):
                            marks.append(hashlib.blake2b(b" ".join(words[i:i + window]), digest_size=16).digest())
                            at.append(i)
                        rows += [row] * s["many"]
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.binary()), batch.column("digest").take(take), batch.column("first_id").take(take), pa.array(at, pa.int32())],
                names=["mark", "digest", "first_id", "a"])
    return run


def _remove(window: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for digest, text, runs in zip(*(batch.column(c).to_pylist() for c in ("digest", "text", "runs"))):
                words = text.encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                for r in runs:  # windows a..b-1 cover words a..b-1+window-1
                    gone[r["a"]] += 1
                    gone[r["b"] + window - 1] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                kept = b" ".join(w for w, g in zip(words, gone) if not g)
                out.append((digest, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string(), pa.string()))],
                names=["digest", "n_removed", "kept_sha256", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   minimiser: int = MINIMISER, hot: int = HOT, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), and with
    ``texts`` also kept_text where some but not all words went.

    Null and empty texts have no words, texts shorter than a window lose none. Windows are judged
    on the input. Only a strictly smaller id takes words away: rows with equal ids never do, nor do null ids,
    which also lose nothing. Repeated rows get equal results. An empty table gives an empty result; other columns are
    not read. A bucket's task holds the windows of one minimiser, at most ``hot`` texts of them.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), _digest(F.col(text_col)).alias("digest"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    first = written(d.mapInArrow(
        _first_pass(window, minimiser),
        "doc_id long, digest binary, n_words long, sha string, low array<long>, first array<int>, many array<int>"), "superkmer-first")
    owners = written(first.groupBy("digest").agg(F.min("doc_id").alias("first_id")), "superkmer-owners")
    # one row per different text, its super-k-mers without words
    slim = first.filter(F.size("low") > 0).join(owners, "digest").filter(F.col("doc_id") == F.col("first_id")) \
        .dropDuplicates(["digest"]).select("digest", "first_id", F.explode(F.arrays_zip("low", "first", "many")).alias("s")) \
        .select("digest", "first_id", "s.*")
    slim = written(slim, "superkmer-slim")
    shared = slim.groupBy("low").agg(F.min("first_id").alias("lo"), F.max("first_id").alias("hi"),
                                     F.count(F.lit(1)).alias("n")).filter("lo < hi").select("low", (F.col("n") > hot).alias("hot"))
    spans = slim.join(shared, "low").groupBy("digest", "first_id").agg(
        F.collect_list(F.struct("low", "first", "many", "hot")).alias("spans"))  # bounded by the text
    spans = written(spans, "superkmer-spans")
    some = d.join(spans.withColumnRenamed("first_id", "doc_id"), ["digest", "doc_id"]).dropDuplicates(["digest"]) \
        .select("digest", F.col("doc_id").alias("first_id"), "text", "spans")
    some = written(some, "superkmer-texts")
    runs = some.mapInArrow(_pack(window), "low long, first_id long, digest binary, first int, words binary") \
        .repartition("low").sortWithinPartitions("low", "first_id") \
        .mapInArrow(_sweep(window), "digest binary, a int, b int")
    single = some.filter(F.exists("spans", lambda s: s["hot"])).mapInArrow(
        _single(window), "mark binary, digest binary, first_id long, a int")
    single = written(single, "superkmer-single")
    firsts = single.groupBy("mark").agg(F.min("first_id").alias("lo"), F.max("first_id").alias("hi")).filter("lo < hi")
    more = single.join(firsts, "mark").filter("first_id > lo").select("digest", "a", (F.col("a") + 1).alias("b"))
    runs = runs.unionByName(more).groupBy("digest").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    part = some.select("digest", "text").join(runs, "digest").mapInArrow(
        _remove(window, texts), "digest binary, n_removed long, kept_sha256 string, kept_text string")
    part = written(part, "superkmer-kept")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= window)
    own = F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("n_removed").isNotNull()
    out = first.select("doc_id", "digest", "n_words", "sha").join(owners, "digest").join(part, "digest", "left")
    return out.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).when(own, F.col("n_removed")).otherwise(0).alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).when(own, F.col("kept_sha256")).otherwise(F.col("sha")).alias("kept_sha256"),
        *([F.when(own, F.col("kept_text")).alias("kept_text")] if texts else []))


ORACLE_SQL = f"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + {WINDOW} - 1], ' ') as x
        from (select doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) as i from d where len(w) >= {WINDOW})),
lo as (select x, min(doc_id) as lo from win group by x),
gone as (select distinct doc_id, unnest(range(i, i + {WINDOW})) as j from win join lo using (x) where doc_id > lo),
word as (select doc_id, unnest(range(1, len(w) + 1)) as j, unnest(w) as x from d),
kept as (select doc_id, string_agg(x, ' ' order by j) as t, count(*) as n from word anti join gone using (doc_id, j) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""

"""Quality rules by compression bands.

A text's zstandard ratio (compressed / raw UTF-8 bytes) is low when it repeats itself and high
when it is noise (random identifiers, encoded binaries). Both ends are rejected, by limits that
depend on the length, because short texts pay the frame header and have little to repeat. The
same is asked of fixed chunks, so a long document cannot hide a repetitive or noisy bulk
behind a normal average.

Beside the verdict every row gets the plain counts (words, symbols, repeated lines and windows).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcast.llm.common import (
    append_columns,
    covered,
    flat,
    kept_fields,
    mix,
    row_sums,
    slices,
    span_hash,
    windows,
    word_spans,
)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_BLANKS = " \t\n\v\f\r"


@dataclass(frozen=True)
class Bands:
    """Ratio limits by length in bytes: (length from, lowest, highest ratio kept)."""

    #: Above the highest ratio of 58,000 ordinary texts of each length (0.71 at 512, 0.61 at 1 KB, 0.557 at 2 KB, 0.51 at 4 KB, 0.469
    #: at 8 KB). Random letters (0.63 at 1 KB, 0.60 at 8 KB) lie above from 1 KB on, random hex (0.53 at 2 KB, 0.52 at 8 KB) from 6 KB on.
    limits: tuple = ((0, 0.0, float("inf")), (64, 0.30, 1.40), (128, 0.28, 1.10), (256, 0.245, 0.92),
                     (512, 0.22, 0.78), (768, 0.22, 0.72), (1024, 0.20, 0.625), (1280, 0.20, 0.61), (1536, 0.20, 0.60),
                     (2048, 0.18, 0.575), (2560, 0.18, 0.555), (3072, 0.18, 0.545), (4096, 0.18, 0.53), (6144, 0.18, 0.505),
                     (8192, 0.15, 0.485), (16384, 0.15, 0.46), (32768, 0.12, 0.45))
    chunk_bytes: int = 2048
    chunk_low: float = 0.18
    chunk_high: float = 0.58
    #: Rejected when more than this share of the chunks is outside the chunk band.
    chunk_share: float = 0.2
    level: int = 3


METRICS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
           ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
           ("kept", T.BooleanType()), ("ratio", T.DoubleType()), ("chunk_outside", T.DoubleType())]
WINDOW = 8


def _repeated(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Words of each row inside a window of eight that occurs twice or more in the row."""
    begin, rows = windows(words, WINDOW)
    if not len(begin):
        return np.zeros(len(words) - 1, np.int64)
    ids = span_hash(buf, starts, ends)
    key = span_hash(ids, begin, begin + WINDOW) ^ mix(rows.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    a, b = order[:-1], order[1:]
    same = (key[a] == key[b]) & (rows[a] == rows[b])
    a, b = a[same], b[same]
    for i in range(WINDOW):  # equal keys are checked word by word
        ok = ids[begin[a] + i] == ids[begin[b] + i]
        a, b = a[ok], b[ok]
    flags = covered(begin[np.union1d(a, b)], WINDOW, len(ids))
    return row_sums(flags, words)


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _ratios(data: bytes, zip_, bands: Bands) -> tuple[float, float]:
    """Ratio of the whole text, and the share of its chunks outside the chunk band."""
    n = len(data)
    if not n:
        return 0.0, 0.0
    whole = len(zip_.compress(data)) / n
    k = n // bands.chunk_bytes
    if k < 2:
        return whole, 0.0
    cuts = [i * bands.chunk_bytes for i in range(k)] + [n]  # the last chunk takes the rest
    out = 0
    for a, b in zip(cuts, cuts[1:]):
        r = len(zip_.compress(data[a:b])) / (b - a)
        out += not bands.chunk_low <= r <= bands.chunk_high
    return whole, out / k


def measure(batches: Iterator[pa.RecordBatch], column: str, bands: Bands) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=bands.level)
    froms = np.array([x[0] for x in bands.limits])
    low, high = (np.array([x[i] for x in bands.limits]) for i in (1, 2))
    for batch in slices(batches, column):
        col = batch.column(column)
        buf, off = flat(col)
        starts, ends, words = word_spans(buf, off)
        n_words = np.diff(words)
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[starts] += 1
        np.add.at(inside, ends, -1)
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        chars = row_sums(inside & ((buf & 0xC0) != 0x80), off)
        repeat = _repeated(buf, starts, ends, words)
        failed = (n_words < 20) | (100 * repeat > 30 * n_words)
        raw = buf.tobytes()
        two = [_ratios(raw[a:b], zip_, bands) for a, b in zip(off[:-1], off[1:])]
        ratio, outside = (np.array([x[i] for x in two]) for i in (0, 1))
        band = np.searchsorted(froms, np.diff(off), "right") - 1
        good = (ratio >= low[band]) & (ratio <= high[band]) & (outside <= bands.chunk_share)
        yield append_columns(
            batch, n_words=pa.array(n_words, pa.int64()), word_chars=pa.array(chars, pa.int64()),
            n_symbols=pa.array(row_sums(SYMBOLS[buf], off), pa.int64()),
            n_dup_lines=pa.array([_dup_lines(x) for x in col.to_pylist()], pa.int64()),
            n_repeat_words=pa.array(repeat, pa.int64()), base_failed=pa.array(failed),
            kept=pa.array(~failed & good), ratio=pa.array(ratio), chunk_outside=pa.array(outside))


def compression_quality(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """``docs`` with the counts, ratios and verdict of every row; one narrow pass, no shuffle.

    Null and empty texts have no words: all counts 0, ratio 0, ``base_failed`` true, ``kept`` false.
    Repeated rows are judged alike. Input columns named like a metric are replaced. An empty
    table gives an empty result. Memory: one slice of whole rows (1 MB, or one longer text).
    """
    names = [n for n, _ in METRICS]
    schema = T.StructType([docs.schema[c] for c in kept_fields(docs, names)]
                          + [T.StructField(n, t) for n, t in METRICS])
    return docs.mapInArrow(lambda batches: measure(batches, text_col, bands), schema)

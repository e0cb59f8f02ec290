"""Language identification by prediction by partial matching (PPM).

Every language has a variable-order byte context tree: how often each byte followed each context of
up to ``order`` bytes. With frozen statistics a byte's code length in a language is that of method C:
in the longest known context it costs -log2(c / (t + q)), where the byte was seen c of t times among
q distinct bytes; if it was not seen there, the escape -log2(q / (t + q)) is paid and the next
shorter context is asked, down to the uniform code of 8 bits. Unknown contexts cost nothing. A text's
language is the one with the shortest code for all its bytes.

The trees are fitted on a bounded sample of the labelled rows: at most ``sample_bytes`` over all
languages, shared equally, whole texts in order of a digest (one text may pass the bound per
language). So the model's size is bounded: one entry per sampled byte and order. It is built once and
broadcast; scoring is one narrow pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import append_columns, flat, kept_fields, slices, written
from shelfcast.operators.quantiles import _narrowed

ORDER = 3
SAMPLE_BYTES = 8 << 20
PIECE = 1 << 20  # bytes scored at once
UNDETERMINED = "und"


def sample(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, sample_bytes: int, ordered: int = 100_000) -> DataFrame:
    """(lang, text) of whole rows, the same at each run: per language the first rows by digest until their running size
    reaches its equal share of ``sample_bytes``, and so always at least one with text.

    The running size is taken over (digest, bytes) alone; while a language has more than ``ordered`` of them, only the range
    that holds the last row is cut again."""
    d = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.octet_length(text_col).cast("long").alias("n"),
        (F.xxhash64(F.col(id_col), F.lit("ppm")).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).alias("u"))
    slim = written(d.groupBy("lang", F.col("u").alias("_x")).agg(F.sum("n").alias("_w")), "ppm-sizes")
    sizes = slim.groupBy("lang").agg(F.sum("_w").alias("_all"))
    share = F.greatest(F.lit(1), (F.lit(sample_bytes) / F.count(F.lit(1)).over(W.partitionBy(F.lit(0)))).cast("long"))  # one row a language
    wanted = sizes.select("lang", (F.least(share, "_all") - 1).alias("_k0")).withColumn("_k1", F.col("_k0")).withColumn("_off", F.lit(0).cast("long"))
    live = slim.filter("_w > 0").join(wanted, "lang")
    while (live.groupBy("lang").count().agg(F.max("count")).first()[0] or 0) > ordered:
        live = written(_narrowed(live, ["lang"], 64), "ppm-sizes")  # the part of the digests where the running size passes the share
    before = F.col("_off") + F.sum("_w").over(W.partitionBy("lang").orderBy("_x")) - F.col("_w")
    last = live.withColumn("before", before).filter("before <= _k0").groupBy("lang").agg(F.max("_x").alias("last"))
    return d.join(last, "lang").filter(F.col("u") <= F.col("last")).select("lang", "text")


def _grams(buf: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n bytes ending at each place, and which places have n bytes of their own text."""
    code = np.zeros(len(buf), np.uint32)
    for i in range(n):
        code[i:] |= buf[:len(buf) - i].astype(np.uint32) << np.uint32(8 * i) if i else buf
    place = np.arange(len(buf)) - np.repeat(off[:-1], np.diff(off))
    return code, place >= n - 1


def _count(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                part = batch.filter(pa.array(langs == lang))
                buf, off = flat(part.column("text"))
                for n in range(1, order + 2):
                    code, ok = _grams(buf, off, n)
                    codes, counts = np.unique(code[ok], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array([n] * len(codes), pa.int32()),
                         pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                        names=["lang", "n", "code", "count"])
    return count


class Index:
    """Codes to rows by open addressing in numpy arrays; -1 for unknown codes."""

    def __init__(self, codes: np.ndarray):
        bits = max(4, int(len(codes) * 3).bit_length())
        self.shift, self.mask = np.uint32(32 - min(bits, 31)), np.uint32((1 << min(bits, 31)) - 1)
        self.codes = codes
        self.slots = np.full(int(self.mask) + 1, -1, np.int32)
        self.probes = 0
        left = np.arange(len(codes), dtype=np.int32)
        while len(left):
            at = self._slot(codes[left], self.probes)
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several that want a slot one stays
            left = left[self.slots[at] != left]
            self.probes += 1

    def _slot(self, codes: np.ndarray, probe: int) -> np.ndarray:
        return (((codes * np.uint32(0x9E3779B1)) >> self.shift) + np.uint32(probe)) & self.mask

    def rows(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(codes), -1, np.int32)
        out = self.slots[self._slot(codes, 0)]
        wrong = np.flatnonzero((out >= 0) & (self.codes[out] != codes))
        for probe in range(1, self.probes):
            if not len(wrong):
                break
            out[wrong] = self.slots[self._slot(codes[wrong], probe)]
            wrong = wrong[(out[wrong] >= 0) & (self.codes[out[wrong]] != codes[wrong])]
        out[wrong] = -1
        return out


@dataclass
class Trees:
    """The context trees of all languages side by side; costs in bits, one column per language."""

    langs: list[str]
    grams: list[Index]          # by n: codes of n bytes seen in any language
    costs: list[np.ndarray]     # by n: cost of the last byte after the others
    contexts: list[Index]       # by n: contexts of n - 1 bytes
    escapes: list[np.ndarray]   # by n: cost of leaving that context

    @staticmethod
    def build(langs: list[str], tables: list[tuple[np.ndarray, np.ndarray]]) -> Trees:
        """tables: for n = 1, 2, ...: sorted codes and their counts by language."""
        t = Trees(langs, [], [], [], [])
        lower = None
        for n, (codes, counts) in enumerate(tables, 1):
            contexts, at = np.unique(codes >> np.uint32(8), return_inverse=True)
            total = np.zeros((len(contexts), len(langs)))
            distinct = np.zeros((len(contexts), len(langs)))
            np.add.at(total, at, counts)
            np.add.at(distinct, at, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + distinct) / distinct), 0.0)
                seen = np.log2((total + distinct)[at] / counts)
            if lower is None:
                below = np.full(counts.shape, 8.0)
            else:
                suffix = codes & np.uint32((1 << 8 * (n - 1)) - 1)
                below = lower[1][np.searchsorted(lower[0], suffix)]
            cost = np.where(counts > 0, seen, escape[at] + below)
            t.grams.append(Index(codes))
            t.costs.append(cost)
            t.contexts.append(Index(contexts))
            t.escapes.append(escape)
            lower = (codes, cost)
        return t

    def bits(self, code: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Cost of each place's byte in each language; ``length``: how many bytes of context and byte there are."""
        out = np.zeros((len(code), len(self.langs)))
        todo = np.arange(len(code))
        for n in range(len(self.grams), 0, -1):
            now = todo[length[todo] >= n]
            c = code[now] & np.uint32((1 << 8 * n) - 1) if n < 4 else code[now]
            row = self.grams[n - 1].rows(c)
            known = row >= 0
            out[now[known]] += self.costs[n - 1][row[known]]
            miss = now[~known]
            ctx = self.contexts[n - 1].rows(c[~known] >> np.uint32(8))
            leave = ctx >= 0
            out[miss[leave]] += self.escapes[n - 1][ctx[leave]]
            todo = np.concatenate([todo[length[todo] < n], miss])
        out[todo] += 8.0
        return out


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> Trees:
    """Context trees of the labelled rows; rows without text or language are left out."""
    if not 0 <= order <= 3:
        raise ValueError("contexts of 0 to 3 bytes are supported")
    counts = sample(labelled, text_col, lang_col, id_col, sample_bytes).mapInArrow(
        _count(order), "lang string, n int, code long, count long").groupBy("lang", "n", "code").agg(F.sum("count").alias("count"))
    rows = counts.toPandas()  # bounded by sample_bytes
    langs = sorted(rows["lang"].unique())
    col = {x: i for i, x in enumerate(langs)}
    tables = []
    for n in range(1, order + 2):
        part = rows[rows["n"] == n]
        codes, at = np.unique(part["code"].to_numpy(np.int64).astype(np.uint32), return_inverse=True)
        m = np.zeros((len(codes), len(langs)))
        np.add.at(m, (at, part["lang"].map(col).to_numpy(np.int64)), part["count"].to_numpy(float))
        tables.append((codes, m))
    return Trees.build(langs, tables)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def code_lengths(t: Trees, buf: np.ndarray, off: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Bits of each row in each language, ``piece`` bytes at a time with the bytes before them that a context may reach."""
    total = np.zeros((len(off) - 1, len(t.langs)))
    top = len(t.grams)
    for a in range(0, len(buf) if t.langs else 0, piece):
        b, lead = min(a + piece, len(buf)), min(a, top - 1)
        code, _ = _grams(buf[a - lead:b], np.array([0, b - a + lead]), top)
        row = np.searchsorted(off, np.arange(a, b), "right") - 1
        bits = t.bits(code[lead:], np.minimum(np.arange(a, b) - off[row] + 1, top))
        first = np.flatnonzero(np.diff(row, prepend=-1))
        total[row[first]] += np.add.reduceat(bits, first, axis=0)
    return total


def predict(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (its posterior among the languages, equal priors) and bits (its code length).

    ``und`` with score 0 where the text is null or has no letter, or no language was learned. Equal code
    lengths go to the first language by code point. The prediction of a row depends on its text only. A very long text
    is scored whole, a piece of ``PIECE`` bytes at a time.
    Input columns named like a result are replaced; an empty table gives an empty result.
    """
    more = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("bits", T.DoubleType())]
    schema = T.StructType([docs.schema[c] for c in kept_fields(docs, [n for n, _ in more])]
                          + [T.StructField(n, t) for n, t in more])
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = model.value
        for batch in slices(batches, text_col):
            col = batch.column(text_col)
            buf, off = flat(col)
            rows = batch.num_rows
            total = code_lengths(t, buf, off)
            best = total.argmin(axis=1) if t.langs else np.zeros(rows, int)
            low = total[np.arange(rows), best] if t.langs else np.zeros(rows)
            post = 1 / np.exp2(np.maximum(low[:, None] - total, -1000.0)).sum(axis=1) if t.langs else np.zeros(rows)
            good = np.array([bool(t.langs) and _has_letter(x) for x in col.to_pylist()])
            yield append_columns(
                batch, lang_pred=pa.array([t.langs[i] if g else UNDETERMINED for i, g in zip(best, good)], pa.string()),
                score=pa.array(np.where(good, post, 0.0)), bits=pa.array(low))
    return docs.mapInArrow(score, schema)

"""Alignment of two tokenizers over a corpus, its id pairs counted by external spill counting.

A text is encoded by a byte-level BPE (A, over space + text) and by a piece BPE (B, which adds the space itself). Where tokens of
both end at one byte the text is cut into groups; every A token of a group is linked with every B token of it. For
all links the corpus-wide count of their id pair is needed (in how many documents it occurs), and per A id the highest.

1. Tasks encode slices of documents and write pair-document records, radix-partitioned by A id, as runs: sorted by (A id,
   B id, document), cut into blocks, zstd-compressed. The written runs are the spill: they outlive executors.
2. Runs of one radix and one set of slices go to one task, where a k-way heap merge of their blocks counts each pair. The
   partial counts of the sets are summed by Spark, so a pair that occurs everywhere never makes one long task.
3. In side-major order all pairs of an A id are neighbours (at most one per B id), which yields the highest count.
4. The runs are streamed once more beside the counts of their pairs, and each record gives its share back to its document.

Encoding is local to segments: a text is cut before a single space or newline between two other characters. A's splitting
rule starts a token there, and no piece of B holds a space mark or newline behind another character, so
the tokens of a text are those of its segments, and both end at each cut. A segment met before is looked up, not encoded again.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import slices, written

RADIX = 16          # parts of the A ids
SLICE = 4 << 20     # bytes of text whose records make one run a radix
BLOCK = 4096        # pairs in a block of a run
GROUP = 32 << 20    # bytes of runs that one task merges
WORDS = 3 << 16     # segments kept by a worker between slices

#: Up to the next single space or newline that stands between two characters other than white space.
SEGMENT = re.compile(r"(?:\A\s*|[ \n])?\S+(?:(?:\s{2,}|[^\S \n])\S+)*(?:\s+\Z)?")


def segments(text: str) -> Iterator[str]:
    """Pieces of space + ``text`` that both tokenizers encode on their own; each starts with a space or newline."""
    if text.isspace():
        yield " " + text
        return
    if len(text) < 1 << 20:
        found = SEGMENT.findall(text)
        found[0] = " " + found[0]
        yield from found
        return
    for m in SEGMENT.finditer(text):  # one by one
        yield m[0] if m.start() else " " + m[0]


def byte_symbols() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ranges [start, start + size)."""
    end = np.cumsum(sizes)
    return np.repeat(starts - (end - sizes), sizes) + np.arange(end[-1] if len(end) else 0)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)) if len(keys) else np.zeros(0, np.int64)
    return (keys[at], *(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values))


def pack(top: np.ndarray, bottom: np.ndarray) -> bytes:
    """Two integer arrays of one length as a zstd frame of byte planes."""
    return zstandard.compress(np.stack([top, bottom]).astype(np.int64).view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes())


def unpack(frame: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(frame), np.uint8).reshape(2, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64)[..., 0]


class Segments(dict):
    """Numbers of the segments met so far; by number: counts of tokens, groups and links, groups as text, id pairs with their links."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers
        super().__init__()
        self.a = tokenizers.Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        symbols, vocab = byte_symbols(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(symbols[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a newline or a space mark behind another character: segments are not independent")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.texts: list[str] = []
        self.facts = np.zeros((0, 5), np.int64)  # A tokens, B tokens, groups, links, joined bytes differ
        self.off = np.zeros(1, np.int64)
        self.keys = self.links = np.zeros(0, np.int64)

    def __missing__(self, segment: str) -> int:
        self[segment] = number = len(self)
        self.new.append(segment)
        return number

    def encode(self, new: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Token ids of both, and whether their joined bytes are those of the segment (else no ids)."""
        a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        b = self.b.encode([s[1:] if s[0] == " " else s for s in new], num_threads=1)
        raw = [s.encode() for s in new]
        same = np.ones(len(new), bool)
        for i, s in enumerate(new):
            if s[0] != " ":  # B adds a space, a token of its own before a newline
                same[i] = b[i] and self.b_bytes[b[i][0]] == b" "
                b[i] = b[i][1:]
        size = np.array([len(x) for x in raw])
        for ids, sizes, table in ((a, self.a_size, self.a_bytes), (b, self.b_size, self.b_bytes)):
            flat = list(itertools.chain.from_iterable(ids))
            ends = np.concatenate([[0], np.cumsum(sizes[np.array(flat, np.int64)])])[np.cumsum([len(x) for x in ids])]
            if (ends != np.cumsum(size)).any() or b"".join(map(table.__getitem__, flat)) != b"".join(raw):
                same &= [b"".join(map(table.__getitem__, x)) == y for x, y in zip(ids, raw)]
        for i in np.flatnonzero(~same):
            a[i], b[i] = [], []
        return a, b, same

    def fill(self) -> None:
        """Take in the segments met since the last call."""
        new, self.new = self.new, []
        if not new:
            return
        a, b, same = self.encode(new)
        na, nb = (np.array([len(x) for x in ids]) for ids in (a, b))
        ia, ib = (np.fromiter(itertools.chain.from_iterable(ids), np.int64) for ids in (a, b))
        ends_a, ends_b = np.cumsum(self.a_size[ia]), np.cumsum(self.b_size[ib])
        joint = np.intersect1d(ends_a, ends_b, assume_unique=True)  # a group ends
        ga, gb = np.searchsorted(joint, ends_a), np.searchsorted(joint, ends_b)
        last = np.concatenate([[0], ends_a])[np.cumsum(na)]
        of = np.searchsorted(last, joint)  # segment of each group
        ca, cb = np.bincount(ga, minlength=len(joint)), np.bincount(gb, minlength=len(joint))
        links = np.zeros(len(new), np.int64)
        np.add.at(links, of, ca * cb)
        groups = np.bincount(of, minlength=len(new))
        self.facts = np.concatenate([self.facts, np.stack([na, nb, groups, links, ~same], 1).astype(np.int64)])

        # a1,a2|b1;a3|b2,b3
        all_a = np.cumsum(ca)
        order = np.empty(len(ia) + len(ib), np.int64)
        after = np.empty(len(order), np.int64)
        at_a, at_b = np.arange(len(ia)) + (np.cumsum(cb) - cb)[ga], np.arange(len(ib)) + all_a[gb]
        order[at_a], order[at_b] = ia, ib
        after[at_a] = np.append(ga[1:] != ga[:-1], True)[:len(ga)] * 1
        after[at_b] = np.append(gb[1:] != gb[:-1], True)[:len(gb)] * 2
        off = np.concatenate([[0], np.cumsum(na + nb)])
        after[off[1:][same] - 1] = 3
        parts = [f"{i}{',|;'[k:k + 1]}" for i, k in zip(order.tolist(), after.tolist())]
        self.texts += ["".join(parts[x:y]) for x, y in zip(off[:-1].tolist(), off[1:].tolist())]

        # distinct ids of a group with their numbers, then all pairs of distinct ids, summed by segment
        va, vb = len(self.a_bytes), len(self.b_bytes)
        ka, ma = summed(ga * va + ia, np.ones(len(ia), np.int64))
        kb, mb = summed(gb * vb + ib, np.ones(len(ib), np.int64))
        many = np.bincount(kb // vb, minlength=len(joint))
        sizes = many[ka // va]
        left, right = np.repeat(np.arange(len(ka)), sizes), ranges((np.cumsum(many) - many)[ka // va], sizes)
        pair = (of[ka // va] * va + ka % va)[left] * vb + (kb % vb)[right]
        pair, times = summed(pair, ma[left] * mb[right])
        self.off = np.concatenate([self.off, self.off[-1] + np.searchsorted(pair, (np.arange(len(new)) + 1) * (va * vb))])
        self.keys, self.links = np.concatenate([self.keys, pair % (va * vb)]), np.concatenate([self.links, times])


_TABLES: dict[tuple[str, str], Segments] = {}


def _table(a_file: str, b_file: str) -> Segments:
    """One table a worker process: its next tasks find the segments of the ones before."""
    if (a_file, b_file) not in _TABLES:
        _TABLES[a_file, b_file] = Segments(a_file, b_file)
    return _TABLES[a_file, b_file]


FACT = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string())]
RUN = "slice long, radix int, first array<long>, pairs array<binary>, docs array<binary>, " \
      "facts array<struct<doc_id:long,n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string>>"
RUN_TYPES = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.struct(FACT))]


def _numbers(table: Segments, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Segment numbers of all texts, and their offsets."""
    found, n = [], []
    for text in texts:
        n.append(0)
        pieces = segments(text) if text else iter(())
        while chunk := list(itertools.islice(pieces, 1 << 14)):
            found.append(np.fromiter(map(table.__getitem__, chunk), np.int64, len(chunk)))
            n[-1] += len(chunk)
            if len(table.new) > 1 << 14:
                table.fill()
    table.fill()
    return np.concatenate([*found, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def _records(table: Segments, w: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair-document records in order of (pair, document): pair, document, links."""
    both, times = summed(of * len(table) + w, np.ones(len(w), np.int64))
    doc, w = both // len(table), both % len(table)
    sizes = table.off[w + 1] - table.off[w]
    at = ranges(table.off[w], sizes)
    both, links = summed(table.keys[at] * n + np.repeat(doc, sizes), table.links[at] * np.repeat(times, sizes))
    return both // n, both % n, links


def _run(key: np.ndarray, doc: np.ndarray, links: np.ndarray, block: int) -> tuple[list[int], list[bytes], list[bytes]]:
    """First keys, pair frames (key steps, documents a pair) and document frames (document, links) of a run's blocks."""
    at = np.flatnonzero(np.diff(key, prepend=-1))
    first, pairs, docs = [], [], []
    for i in range(0, len(at), block):
        to = np.append(at, len(key))[i:i + block + 1]
        k = key[to[:-1]]
        first.append(int(k[0]))
        pairs.append(pack(np.diff(k, prepend=0), np.diff(to)))
        docs.append(pack(doc[to[0]:to[-1]], links[to[0]:to[-1]]))
    return first, pairs, docs


def _spill(a_file: str, b_file: str, radix: int, size: int, block: int, words: int):
    """Runs and document facts of slices of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(a_file, b_file)
        task = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(slices(batches, "text", size)):
            if len(table) > words or len(table.keys) > 8 * words:
                table.reset()
            w, off = _numbers(table, batch.column("text").to_pylist())
            of = np.repeat(np.arange(batch.num_rows), np.diff(off))
            sums = np.zeros((batch.num_rows, 5), np.int64)
            np.add.at(sums, of, table.facts[w])
            bad = sums[:, 4] > 0
            sums[bad] = 0
            facts, ends = [], off.tolist()
            for i, id_ in enumerate(batch.column("doc_id").to_pylist()):
                sha, (x, y) = hashlib.sha256(), ends[i:i + 2]
                for at in range(x, y, 1 << 14):
                    sha.update((";" * (at > x) + ";".join(map(table.texts.__getitem__, w[at:min(at + (1 << 14), y)].tolist()))).encode())
                none = bad[i] or x == y
                facts.append((id_, *sums[i, :4].tolist(), "" if none else sha.hexdigest()))
            rows = [(task + number, -1, [], [], [], [dict(zip([n for n, _ in FACT], f)) for f in facts])]
            good = ~bad[of]
            key, doc, links = _records(table, w[good], of[good], batch.num_rows)
            part = key // len(table.b_bytes) % radix
            for r in np.unique(part).tolist():
                mine = part == r
                rows.append((task + number, r, *_run(key[mine], doc[mine], links[mine], block), []))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(RUN_TYPES)],
                                             names=["slice", "radix", "first", "pairs", "docs", "facts"])
    return run


def merge(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending (keys, documents) of all runs: a heap holds every run's next block by its first key; what lies below all
    of them is complete. Held at once: a block a run, and what the blocks read so far have not settled."""
    heap = [(first[0], i, 0) for i, (first, _) in enumerate(runs)]
    heapq.heapify(heap)
    held, size, goal = [], 0, 0
    while heap:
        _, i, j = heapq.heappop(heap)
        first, frames = runs[i]
        step, n = unpack(frames[j])
        held.append((np.cumsum(step), n))
        size += len(n)
        if j + 1 < len(first):
            heapq.heappush(heap, (first[j + 1], i, j + 1))
        if size > goal or not heap:
            keys, n = summed(*(np.concatenate(x) for x in zip(*held)))
            done = np.searchsorted(keys, heap[0][0]) if heap else len(keys)
            if done:
                yield keys[:done], n[:done]
            held, size = [(keys[done:], n[done:])], len(keys) - done
            goal = 2 * size + 4 * BLOCK


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """Consecutive rows of one (radix, salt): yields ((radix, salt), rows)."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("radix", "salt", *columns))))
    return itertools.groupby(rows, key=lambda row: row[:2])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the pairs of each (radix, salt)."""
    for (radix, salt), rows in _groups(batches, ["first", "pairs"]):
        for keys, n in merge([row[2:] for row in rows]):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), radix, np.int32)), pa.array(np.full(len(keys), salt, np.int64)),
                                              pa.array(keys), pa.array(n)], names=["radix", "salt", "pair", "n"])


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums for the documents of each run: links whose pair is its A id's most frequent, and counts over links.

    In each (radix, salt) the counted pairs come first, in order, then the runs one by one."""
    group, known, table = None, [], None
    for batch in batches:
        radix, salt, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("radix", "salt", "kind"))
        cut = np.flatnonzero((np.diff(radix) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0) | (kind[1:] == 1)) + 1
        for x, y in zip([0, *cut.tolist()], [*cut.tolist(), len(kind)]):
            if (radix[x], salt[x]) != group:
                group, known, table = (radix[x], salt[x]), [], None
            part = batch.slice(x, y - x)
            if kind[x] == 0:
                known.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")])
                continue
            if table is None:
                table = [np.concatenate(c) for c in zip(*known)]
            yield _shares(*(part.column(c)[0].as_py() for c in ("slice", "pairs", "docs")), *table)


def _shares(slice_: int, pairs: list[bytes], docs: list[bytes], keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    sums = np.zeros((2, 0), np.int64)
    for p, d in zip(pairs, docs):
        step, n = unpack(p)
        at = np.repeat(np.searchsorted(keys, np.cumsum(step)), n)
        doc, links = unpack(d)
        if doc.max() >= sums.shape[1]:
            sums = np.pad(sums, ((0, 0), (0, int(doc.max()) + 1 - sums.shape[1])))
        np.add.at(sums[0], doc, links * best[at])
        np.add.at(sums[1], doc, links * counts[at])
    doc = np.flatnonzero(sums[1])
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), slice_, np.int64)), pa.array(doc.astype(np.int32)), pa.array(sums[0][doc]),
                                       pa.array(sums[1][doc])], names=["slice", "at", "n_best", "count_sum"])


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", radix: int = RADIX,
          slice_bytes: int = SLICE, group_bytes: int = GROUP, block: int = BLOCK, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row per row of
    ``docs``. Pairs: a, b, n (documents that hold the pair linked), best (n is the highest of a).

    Null and empty texts, and texts whose joined tokens are not space + text, have zeros and an empty digest. Rows with equal ids or
    equal texts are documents of their own; null ids stay null. Texts of any length are taken in chunks of segments (a stretch
    without a single space or newline is one segment). An empty table gives empty results; other columns are not read.
    A task holds the segments of one slice, and in both merges one (radix, set of slices) of about ``group_bytes`` of runs with
    its counted pairs. The number of sets follows from the size of the written runs.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    runs = written(d.mapInArrow(_spill(a_file, b_file, radix, slice_bytes, block, words), RUN), "align-runs")
    size = F.expr("aggregate(transform(pairs, x -> octet_length(x)) || transform(docs, x -> octet_length(x)), 0L, (s, x) -> s + x)")
    total = runs.agg(F.sum(size)).first()[0] or 0
    spill = runs.filter("radix >= 0").withColumn("salt", F.pmod(F.xxhash64("slice"), F.lit(1 + total // (group_bytes * radix))))

    n_b = len(_table(a_file, b_file).b_bytes)
    partial = spill.select("radix", "salt", "slice", "first", "pairs").repartition("radix", "salt") \
        .sortWithinPartitions("radix", "salt", "slice").drop("slice").mapInArrow(_count, "radix int, salt long, pair long, n long")
    partial = written(partial, "align-partial")
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {n_b}"))
    counts = counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))  # a row per B id at most
    counts = written(counts, "align-pairs")

    known = partial.select("radix", "salt", "pair").join(counts.drop("a"), "pair").withColumn("kind", F.lit(0))
    both = known.unionByName(spill.select("radix", "salt", "slice", "pairs", "docs", F.lit(1).alias("kind")), allowMissingColumns=True)
    shares = both.repartition("radix", "salt").sortWithinPartitions("radix", "salt", "kind", "pair", "slice") \
        .mapInArrow(_contribute, "slice long, at int, n_best long, count_sum long")
    shares = shares.groupBy("slice", "at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    facts = runs.filter("radix < 0").select("slice", F.posexplode("facts").alias("at", "f")).select("slice", "at", "f.*")
    out = facts.join(shares, ["slice", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    return out, counts.select("a", F.expr(f"pair % {n_b}").alias("b"), "n", "best")

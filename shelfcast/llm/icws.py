"""Near-duplicate documents by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

A text's shingles are its runs of five words (a shorter text is one shingle); a shingle's weight is
its count in the text times a smoothed inverse document frequency. Document frequencies are kept
for all documents in one row of ``2**DF_BITS`` counters (an upper bound per shingle, less the
counters' noise), so their size is fixed. Damping keeps the weighted similarity close to the plain
one: only shingles well above the noise, such as boilerplate, weigh less, at most by 1 / (1 + DAMPING).

Two texts get the same sample (shingle, level) with the probability of their weighted Jaccard
similarity. ``BANDS`` keys of ``ROWS`` samples each lead to candidates: a pair at 0.8 misses all
keys with probability (1 - 0.8^3)^16 = 1e-5. Exact copies are first folded into one text. All texts of a
bucket are compared with each other by the exact weighted Jaccard similarity: small buckets as distinct pairs,
larger ones in salted blocks, where the common weights of a block's pairs are products of matrices and a pair is
compared only in the first bucket that it shares. A block returns a spanning forest of its links and how many
links each text has in it, so no step writes the pairs of a large group. Classes are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import flat, mix, signed, slices, span_hash, windows, word_spans, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 3
DF_BITS = 20
DAMPING = 0.25
_RANGES = 16  # parts of the counter row
_FAN = 64     # blobs added up in one step
SMALL = 8     # texts of a bucket whose pairs are listed; larger ones are cut into blocks
BLOCK_ROWS, BLOCK_BYTES = 512, 1 << 20
_COLUMNS = 4096  # shingles in one matrix product

_rng = np.random.default_rng(20240607)
_CELLS = 1 << 16
_R = -np.log(_rng.random(_CELLS) * _rng.random(_CELLS))          # Gamma(2, 1)
_LOG_C = np.log(-np.log(_rng.random(_CELLS) * _rng.random(_CELLS)))
_BETA = _rng.random(_CELLS)
_R, _LOG_C, _BETA = (x.astype(np.float32) for x in (_R, _LOG_C, _BETA))
_INV_R = (1 / _R).astype(np.float32)
_MULTIPLIERS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(buf: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row with their counts, and row offsets; sorted within a row."""
    starts, ends, words = word_spans(buf, off)
    ids = span_hash(buf, starts, ends)
    begin, rows = windows(words, size)
    n = np.diff(words)
    short = np.flatnonzero((n > 0) & (n < size))
    key = span_hash(ids, np.concatenate([begin, words[short]]), np.concatenate([begin + size, words[short + 1]]))
    rows = np.concatenate([rows, short])
    order = np.lexsort((key, rows))
    key, rows = key[order], rows[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(first)
    return key[at], np.diff(np.append(at, len(key))), np.searchsorted(rows[at], np.arange(len(n) + 1))


def _cell(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64)


# ---- document frequencies

def document_frequencies(texts: DataFrame, bits: int = DF_BITS, fan: int = _FAN) -> tuple[np.ndarray, int]:
    """Counters of all documents' distinct shingles, and the number of documents that have any.

    Tasks count into their own row and send it in parts; parts are added ``fan`` at a time, so no step
    holds more than that many, however many tasks there were. The driver gets one row of 2**bits counters."""
    size = (1 << bits) // _RANGES
    schema = "part int, turn int, docs long, blob binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row, docs = np.zeros(1 << bits, np.int64), 0
        for batch in slices(batches, "text"):
            key, _, off = shingles(*flat(batch.column("text")))
            row += np.bincount(_cell(key, bits), minlength=1 << bits)
            docs += int((np.diff(off) > 0).sum())
        if docs:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(_RANGES, dtype=np.int32)), pa.array([TaskContext.get().partitionId()] * _RANGES, pa.int32()),
                pa.array([docs] + [0] * (_RANGES - 1), pa.int64()),
                pa.array([pack(row[i * size:(i + 1) * size]) for i in range(_RANGES)], pa.binary())],
                names=["part", "turn", "docs", "blob"])

    def pack(x: np.ndarray) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(x.tobytes())

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for b in table.column("blob").to_pylist():
            total += np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.int64)
        docs = sum(table.column("docs").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "turn": pa.array([key[1].as_py()], pa.int32()),
                         "docs": pa.array([docs], pa.int64()), "blob": pa.array([pack(total)], pa.binary())})
    blobs = written(texts.select("text").mapInArrow(count, schema), "icws-df")
    while True:
        turns = blobs.agg(F.max("turn")).first()[0]
        if not turns:
            break
        blobs = written(blobs.withColumn("turn", F.floor(F.col("turn") / fan).cast("int"))
                        .groupBy("part", "turn").applyInArrow(add, schema), "icws-df")
    row, docs = np.zeros(1 << bits, np.int64), 0
    for r in blobs.collect():  # the parts of one counter row
        row[r["part"] * size:(r["part"] + 1) * size] += np.frombuffer(zstandard.ZstdDecompressor().decompress(r["blob"]), np.int64)
        docs += r["docs"]
    return row, docs


def inverse_frequencies(counters: np.ndarray, docs: int, damping: float = DAMPING) -> np.ndarray:
    """The weight factor per counter: 1 + damping for rare shingles, towards 1 for those in every document."""
    noise = counters.sum() / len(counters)  # what other shingles add to a counter, with three deviations
    df = np.maximum(counters - noise - 3 * np.sqrt(noise), 1.0)
    return (1 + damping * np.log((1 + docs) / (1 + np.minimum(df, docs))) / np.log(2 + docs)).astype(np.float32)


# ---- samples and keys

def band_keys(key: np.ndarray, count: np.ndarray, off: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """BANDS keys of each row with shingles (rows without get none): ICWS of the weights count * idf."""
    full = np.flatnonzero(np.diff(off) > 0)
    cut = off[:-1][full]
    n = np.diff(off)[full]
    log_w = np.log(count * idf[_cell(key, int(len(idf)).bit_length() - 1)]).astype(np.float32)
    out = np.zeros((len(full), BANDS), np.uint64)
    row = np.repeat(np.arange(len(full)), n)
    for k, a in enumerate(_MULTIPLIERS):
        i = ((key * a) >> np.uint64(48)).astype(np.intp)
        level = np.floor(log_w * _INV_R[i] + _BETA[i])
        log_a = _LOG_C[i] - _R[i] * (level - _BETA[i] + 1)
        low = np.minimum.reduceat(log_a, cut)
        at = np.flatnonzero(log_a == low[row])  # equal minima: the smallest hash, as rows are sorted by it
        at = at[np.unique(row[at], return_index=True)[1]]
        sample = mix(key[at] ^ (level[at].astype(np.int64) * 0x9E37 + k).astype(np.uint64))
        band = k // ROWS
        out[:, band] = mix(out[:, band] * np.uint64(31) + sample + np.uint64(band))
    return out


def _signatures(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(digest, keys, bytes) of each text that has words."""
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            key, count, off = shingles(*flat(batch.column("text")))
            keys = band_keys(key, count, off, shared.value)
            full = pa.array(np.flatnonzero(np.diff(off) > 0))
            yield pa.RecordBatch.from_arrays([batch.column("digest").take(full), pa.FixedSizeListArray.from_arrays(
                pa.array(signed(keys).ravel()), BANDS).cast(pa.list_(pa.int64())),
                pc.binary_length(batch.column("text").take(full)).cast(pa.int64())], names=["digest", "keys", "bytes"])
    return texts.select("digest", "text").mapInArrow(sign, "digest binary, keys array<long>, bytes long")


# ---- verification

def weighted_jaccard(a: tuple, b: tuple, idf: np.ndarray) -> np.ndarray:
    """Row by row, of two (keys, counts, offsets); 0 where a side has no shingles."""
    bits = int(len(idf)).bit_length() - 1
    rows = len(a[2]) - 1
    key = np.concatenate([a[0], b[0]])
    row = np.concatenate([np.repeat(np.arange(rows), np.diff(x[2])) for x in (a, b)])
    w = np.concatenate([a[1], b[1]]) * idf[_cell(key, bits)].astype(float)
    order = np.lexsort((key, row))
    key, row, w = key[order], row[order], w[order]
    pair = np.flatnonzero((key[1:] == key[:-1]) & (row[1:] == row[:-1]))
    both = np.zeros(rows)
    np.add.at(both, row[pair], np.minimum(w[pair], w[pair + 1]))
    total = np.zeros(rows)
    np.add.at(total, row, w)
    return np.divide(both, total - both, out=np.zeros(rows), where=total > both)


def _links(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough. ``texts`` holds one row per digest."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            a, b = (shingles(*flat(batch.column(c))) for c in ("text_a", "text_b"))
            good = pa.array(weighted_jaccard(a, b, shared.value) >= threshold)
            yield batch.select(["a", "b"]).filter(good)
    both = pairs.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a binary, b binary")


def common_weights(a: np.ndarray, b: np.ndarray, key: np.ndarray, count: np.ndarray, off: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sums of the smaller weights of each row of ``a`` with each row of ``b`` (row numbers of the shingles).

    A shingle that a row has c times is c columns, so the smaller weight of two rows is a product."""
    n = len(off) - 1
    row = np.repeat(np.repeat(np.arange(n), np.diff(off)), count)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    weight = np.repeat(idf[_cell(key, int(len(idf)).bit_length() - 1)].astype(float), count)
    column = mix(np.repeat(key, count) + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(column, kind="stable")
    row, weight, column = row[order], weight[order], column[order]
    first = np.ones(len(column), bool)
    first[1:] = column[1:] != column[:-1]
    at = np.flatnonzero(first)
    shared = np.repeat(np.diff(np.append(at, len(column))) > 1, np.diff(np.append(at, len(column))))
    row, weight = row[shared], weight[shared]
    column = np.cumsum(first[shared]) - 1
    place = np.full((2, n), -1)
    place[0, a], place[1, b] = np.arange(len(a)), np.arange(len(b))
    out = np.zeros((len(a), len(b)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        part = slice(*np.searchsorted(column, [low, low + _COLUMNS]))
        sides = []
        for side, size in ((0, len(a)), (1, len(b))):
            to = place[side, row[part]]
            x = np.zeros((size, _COLUMNS))
            x[to[to >= 0], column[part][to >= 0] - low] = 1.0 if side else weight[part][to >= 0]
            sides.append(x)
        out += sides[0] @ sides[1].T
    return out


def spanning(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of a spanning forest of the links ``hit`` between rows and columns."""
    rows, columns = hit.any(1), hit.any(0)  # not yet reached
    out = []
    while rows.any():
        new = np.array([np.argmax(rows)])
        rows[new] = False
        while len(new):
            to = np.flatnonzero(hit[new].any(0) & columns)
            columns[to] = False
            out.append((new[np.argmax(hit[np.ix_(new, to)], 0)], to))
            new = np.flatnonzero(hit[:, to].any(1) & rows)
            rows[new] = False
            out.append((new, to[np.argmax(hit[np.ix_(new, to)], 1)] if len(new) else new))
    return tuple(np.concatenate([x[k] for x in out] or [np.zeros(0, int)]) for k in (0, 1))


def _block_hits(key: int, i: int, j: int, t: pa.Table, idf: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(a, b, hit): rows of blocks i and j, and which of their pairs are similar enough and belong to this bucket."""
    salt = t.column("salt").to_numpy()
    keys = t.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    large = t.column("large").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
    a, b = np.flatnonzero(salt == i), np.flatnonzero(salt == j)
    if not len(a) or not len(b):
        return None
    todo = np.triu(np.ones((len(a), len(b)), bool), 1) if i == j else np.ones((len(a), len(b)), bool)
    band = int(np.argmax(keys[0] == key))
    for k in range(BANDS):  # pairs of listed buckets and of earlier large ones are compared there
        if k != band:
            same = keys[a, k][:, None] == keys[b, k][None, :]
            todo &= ~(same if k < band else same & ~large[a, k][:, None])
    if not todo.any():
        return None
    some, other = todo.any(1), todo.any(0)
    todo, a, b = todo[np.ix_(some, other)], a[some], b[other]
    both = np.union1d(a, b)
    sh, count, off = shingles(*flat(t.column("text").combine_chunks().take(pa.array(both))))
    ra, rb = np.searchsorted(both, a), np.searchsorted(both, b)
    w = count * idf[_cell(sh, int(len(idf)).bit_length() - 1)].astype(float)
    total = np.add.reduceat(w, off[:-1])  # every member of a bucket has shingles
    low = common_weights(ra, rb, sh, count, off, idf)
    return a, b, todo & (low >= threshold * (total[ra][:, None] + total[rb][None, :] - low))


def _block_links(members: DataFrame, keys: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Links (a, b) that span the similar texts of the larger buckets, and rows (a, hits) with the number of
    links of a text in one block. ``members``: (digest, key, blocks)."""
    shared = members.sparkSession.sparkContext.broadcast(idf)

    def verify(group: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        found = _block_hits(*(x.as_py() for x in group), t, shared.value, threshold)
        digest = t.column("digest").combine_chunks()
        a = b = np.zeros(0, int)
        hits = np.zeros(t.num_rows, np.int64)
        if found is not None:
            x, y = spanning(found[2])
            a, b = found[0][x], found[1][y]
            hits[found[0]] += found[2].sum(1)
            hits[found[1]] += found[2].sum(0)
        own = np.flatnonzero(hits)
        return pa.table({"a": digest.take(pa.array(np.concatenate([a, own]))),
                         "b": pa.concat_arrays([digest.take(pa.array(b)), pa.nulls(len(own), digest.type)]),
                         "hits": pa.array(np.concatenate([np.zeros(len(a), np.int64), hits[own]]))})
    spots = members.groupBy("digest").agg(F.collect_list(F.struct("key", "blocks")).alias("spots"))  # BANDS at most
    rows = spots.join(keys.select("digest", "keys"), "digest").join(texts, "digest") \
        .withColumn("large", F.transform("keys", lambda k: F.array_contains("spots.key", k))) \
        .select("digest", "keys", "large", "text", F.explode("spots").alias("s")) \
        .withColumn("salt", F.pmod(F.xxhash64("digest", "s.key"), F.col("s.blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s.blocks") - 1))) \
        .select(F.col("s.key").alias("key"), F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"),
                "salt", "digest", "keys", "large", "text")
    return rows.groupBy("key", "i", "j").applyInArrow(verify, "a binary, b binary, hits long")


def near_links(texts: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(a, b) of distinct texts with weighted Jaccard similarity of at least ``threshold``, enough of them to
    connect all such pairs that share a key; and (node, n_links), the number of all such pairs of each text.

    ``texts``: (digest, text), repeated for repeated texts (their document frequencies count)."""
    counters, docs = document_frequencies(texts)
    idf = inverse_frequencies(counters, docs)
    keys = _signatures(texts, idf).groupBy("digest").agg(F.first("keys").alias("keys"), F.first("bytes").alias("bytes"))
    keys = written(keys, "icws-keys")
    members = keys.select("digest", F.explode("keys").alias("key"), "bytes")
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("size")).filter("n > 1")
    blocks = F.least("n", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("size") / BLOCK_BYTES)))
    joined = members.select("digest", "key").join(buckets.select("key", "n", blocks.alias("blocks")), "key")
    joined = written(joined, "icws-members")  # only those with company
    # texts of the members: later joins read only these
    some = texts.join(joined.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])
    some = written(some, "icws-texts")
    listed = joined.filter(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("digest")).alias("g"))
    pairs = listed.select(F.explode(F.expr(
        "flatten(transform(g, (x, p) -> transform(slice(g, p + 2, size(g)), y -> struct(x AS a, y AS b))))")).alias("p"))
    links = written(_links(written(pairs.select("p.a", "p.b").distinct(), "icws-pairs"), some, idf, threshold), "icws-links")
    large = joined.filter(F.col("n") > SMALL).select("digest", "key", "blocks")
    found = written(_block_links(large, keys, some, idf, threshold), "icws-links")
    ends = links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("hits"))
    degree = ends.unionByName(found.filter("b IS NULL").select(F.col("a").alias("node"), "hits")) \
        .groupBy("node").agg(F.sum("hits").alias("n_links"))
    return links.unionByName(found.filter("b IS NOT NULL").select("a", "b")), degree


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of all linked nodes: alternating star contraction, a logarithmic number of rounds.

    Neighbours are reduced to their minimum by aggregation and joined back, so no neighbourhood is
    collected; each round is written, and the loop ends when a round changes nothing."""
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "cc")

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    last = None
    while (now := state(edges)) != last:
        last = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")) \
            .select(F.greatest("e.v", "e.m").alias("u"), F.least("e.v", "e.m").alias("v")).filter("u <> v").distinct()
        edges = written(small, "cc")
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest of its text, class_id (smallest id of its class), n_links (how
    many different texts are similar enough to its text and share a key with it), kept (it has the smallest id).

    Exact copies share a class whatever their links. Null texts and texts without words are classes
    of their own and kept. Null ids come last in the choice of class_id; a class of null ids only has a
    null class_id and keeps them. Rows repeated with equal id and text are all marked; a caller that keeps one
    document drops repeats of (doc_id, digest). An empty table gives an empty result; other columns are not read.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(F.col(text_col))).alias("digest"), F.col(text_col).alias("text"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    links, degree = near_links(d.filter(has_words).select("digest", "text"), threshold)
    roots = written(components(links), "icws-roots")
    # roots are smallest members and not listed as nodes of their own
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    ids = d.select("doc_id", "digest", has_words.alias("words"))
    named = ids.filter("words").join(roots, F.col("digest") == F.col("node"), "left") \
        .select("doc_id", "digest", F.coalesce("root", "digest").alias("root"))
    named = written(named, "icws-named")
    classes = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    out = named.join(classes, "root").join(degree, F.col("digest") == F.col("node"), "left") \
        .select("doc_id", "digest", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    blank = ids.filter(~F.col("words")).select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one per class."""
    keep = near_duplicates(docs, id_col, text_col, **options).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__of")).distinct()
    keep = written(keep, "icws-kept")
    d = docs.withColumn("__digest", F.unhex(F.md5(F.col(text_col))))
    hit = d.join(keep, F.col(id_col).eqNullSafe(F.col("__id")) & F.col("__digest").eqNullSafe(F.col("__of")), "left_semi")
    return hit.dropDuplicates([id_col, "__digest"]).select(*docs.columns)

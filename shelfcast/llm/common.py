"""Helpers shared by the text operators: flat byte views of Arrow text columns, vectorised word
spans and 64-bit hashes, written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import written  # noqa: F401 - for the operators

#: Word separators of the contracts: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD_RE = r"[^\x20\x09-\x0D]+"

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_Q = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(col, n: int):
    """crc32 of the decimal text of an id, modulo n (null id: of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece holds about ``max_bytes`` of text, whole rows only."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = np.zeros(n + 1, np.int64)
        size[1:] = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                             .to_numpy(zero_copy_only=False))
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(size, size[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column, and the offsets of its rows (null: no bytes)."""
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def word_spans(buf: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row its range in them (offsets)."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    s = sep[buf]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = s[:-1]
    before[off[:-1][off[:-1] < n]] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = s[1:]
    after[off[1:][off[1:] > 0] - 1] = True
    np.logical_not(s, out=s)
    starts = np.flatnonzero(s & before)
    return starts, np.flatnonzero(s & after) + 1, np.searchsorted(starts, off)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["p"]) < n:
        size = max(n, 3 << 19)
        for k, base in (("p", _P), ("q", _Q)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.cumprod(x, dtype=np.uint64)
    return _POWERS["p"], _POWERS["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (Stafford's variant 13)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


LONG_SPAN = 64


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span [start, end) of a byte or integer sequence.

    Short spans: a polynomial, then mixed. Modulo 2^64 a polynomial cannot tell some long alternating
    sequences apart (from 1,024 elements on whatever its base), so spans of more than ``LONG_SPAN`` bytes are hashed by BLAKE2b."""
    p, q = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * p[:len(values)], out=sums[1:])
    out = mix((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64))
    if values.dtype == np.uint8:
        for i in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(values[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def row_of(off: np.ndarray) -> np.ndarray:
    """The row of each element, from row offsets."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def row_sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` within each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def windows(off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` consecutive elements inside one row, and their rows."""
    n = np.maximum(np.diff(off) - size + 1, 0)
    rows = np.repeat(np.arange(len(n)), n)
    begin = np.cumsum(n) - n
    return off[:-1][rows] + (np.arange(len(rows)) - begin[rows]), rows


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Flags of the n elements inside any span [start, start + length)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + lengths, -1)
    return np.cumsum(d[:-1]) > 0


def append_columns(batch: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
    """The batch's columns, those with clashing names replaced, then the new ones."""
    low = {k.lower() for k in more}
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() not in low]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + list(more.values()),
                                      names=[batch.schema.names[i] for i in keep] + list(more))


def kept_fields(df: DataFrame, more: list[str]) -> list[str]:
    low = {m.lower() for m in more}
    return [c for c in df.columns if c.lower() not in low]


# ---- sorted arrays in the shared folder

def _local(uri: str) -> str | None:
    """The path of a folder that every node mounts; None for object stores and the like."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return None if "://" in uri else uri


def put_file(folder: str, name: str, data: bytes) -> None:
    """Write one file of the shared folder; a repeated task replaces it by the same bytes in one step."""
    local = _local(folder)
    if local is None:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
    else:
        system, path = fs.LocalFileSystem(), local
        os.makedirs(path, exist_ok=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{path}/{name}")


def map_file(folder: str, name: str, dtype) -> np.ndarray:
    """A file of the shared folder as a memory-mapped array (via a local copy where it cannot be mounted)."""
    local = _local(folder)
    path = f"{local}/{name}"
    if local is None:
        system, remote = fs.FileSystem.from_uri(folder)
        path = os.path.join(tempfile.gettempdir(), f"shelfcast-{hashlib.md5(folder.encode()).hexdigest()}-{name}")
        if not os.path.exists(path):
            with system.open_input_stream(f"{remote}/{name}") as src, open(f"{path}.{os.getpid()}", "wb") as dst:
                dst.write(src.read())
            os.replace(f"{path}.{os.getpid()}", path)
    if os.path.getsize(path) == 0:
        return np.zeros(0, dtype)
    return np.memmap(path, dtype, "r")

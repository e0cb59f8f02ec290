"""Token counts by a compiled finite-state transducer for byte-level BPE.

The tokenizer (word splitting pattern and merges) becomes one deterministic transducer over bytes.
Each transition carries the change of the token count, so a text's count is a sum along one path:

* A BPE state is what the future of a word can depend on: the longest suffix that begins some
  token (an Aho-Corasick node) and, for each suffix of it that begins a token, the last token and
  the relative count at the place where that suffix starts. The next byte ends exactly one token that
  is a suffix of the word so far and is a valid neighbour of the token before it; that is the last token
  of the new prefix. There are finitely many such states because tokens have bounded length.
* A splitting state says which alternative of the pattern is open (letters, digits, other, white space,
  an apostrophe that may begin a contraction); undecided look-ahead is carried in the state and
  settled by a corrected count when the next character comes.

States and transitions are compiled when first met and kept in a paged table per Python worker.
Texts are cut into chunks that run side by side, two look-ups per byte for thousands of chunks.
A chunk yields a state map (entry state -> exit state, tokens); its entry is guessed by a short run-up.
The maps of a text's chunks compose in a parallel prefix scan; where a guess was wrong the chunk's map is
extended by the true entry, until all compose.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcast.llm.common import append_columns, flat, kept_fields, row_sums, slices

#: White_Space of Unicode; second letters of the contractions 's 't 'm 'd, and 're 've 'll.
WHITE = {0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
         0x205F, 0x3000}
ONE, TWO = set("stmd"), {"r": "e", "v": "e", "l": "l"}

PAD = 256  # beside the bytes: pads the last chunk of a text
BLOCKS, CELLS = 17, 16  # a state's transitions: 17 blocks of 16, only those in use have cells
CHUNK = 512
RUN_UP = 32
MAX_STATES = 1 << 18
_SHIFT, _ZERO = 10, 512  # a table entry is state << 10 | (count change + 512); 0: not compiled yet
_START = -1


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Tokens as bytes and the merge order; encodes short strings the plain way."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (pre["type"] != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space")
                or spec["normalizer"] or model["type"] != "BPE" or model.get("dropout")):
            raise ValueError("only plain byte-level BPE with the default splitting pattern is supported")
        back = _byte_symbols()
        self.bytes = {i: bytes(back[c] for c in tok) for tok, i in model["vocab"].items() if all(c in back for c in tok)}
        self.id = {b: i for i, b in self.bytes.items()}
        as_bytes = lambda s: bytes(back[c] for c in s)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(self.id[as_bytes(a)], self.id[as_bytes(b)]): r for r, (a, b) in enumerate(pairs)}
        self.special = [a["content"].encode() for a in spec["added_tokens"]]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"]):
            raise ValueError("added tokens that take their surroundings are not supported")

    def encode(self, data: bytes) -> list[int]:
        out = [self.id[data[i:i + 1]] for i in range(len(data))]
        while len(out) > 1:
            rank, i = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(out, out[1:])))
            if rank == 1 << 60:
                break
            out[i:i + 2] = [self.id[self.bytes[out[i]] + self.bytes[out[i + 1]]]]
        return out


class Transducer:
    """Lazily compiled states; ``block`` and ``cell`` map a state and a byte to the next state and count change."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self._trie()
        self.neighbours: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.bpe_ids: dict = {}
        self.bpe: list = []
        self.bpe_steps: dict[int, tuple[int, int]] = {}
        self.shared: dict = {}  # one object for equal pairs and characters: most states hold the same few
        self.fresh = self._bpe_id((0, ((_START, 0),)))
        self.ids: dict = {}
        self.states: list = [None]
        self.block = np.zeros(4096 * BLOCKS, np.int32)  # block 0 is empty: nothing compiled
        self.cell = np.zeros(4096 * CELLS, np.int32)
        self.blocks = 1
        self.ground = self._id(("0", b""))

    # ---- tokens as a trie with failure links
    def _trie(self) -> None:
        child: dict[int, int] = {}
        token, depth = [-1], [0]
        for data, i in self.merges.id.items():
            at = 0
            for b in data:
                to = child.get(at << 8 | b)
                if to is None:
                    to = child[at << 8 | b] = len(token)
                    token.append(-1)
                    depth.append(depth[at] + 1)
                at = to
            token[at] = i
        fail = [0] * len(token)
        by_depth = sorted(child.items(), key=lambda kv: depth[kv[1]])
        for key, to in by_depth:
            at, b = key >> 8, key & 255
            if at:
                f = fail[at]
                while f and (f << 8 | b) not in child:
                    f = fail[f]
                fail[to] = child.get(f << 8 | b, 0)
        # a node that nothing extends cannot begin a longer token: its longest live suffix stands for it
        inner = {key >> 8 for key in child}
        live = list(range(len(token)))
        for _, to in by_depth:
            if to not in inner:
                live[to] = live[fail[to]]
        self.child, self.token, self.live = child, token, live
        self.fail = [live[f] for f in fail]

    def _adjoin(self, a: int, b: int) -> bool:
        """Whether [a, b] is how BPE splits the bytes of a and b; a may be the word's start."""
        ok = self.neighbours.get(a << 32 | b)
        if ok is None:
            m = self.merges
            ok = m.encode(m.bytes[b]) == [b] if a == _START else m.encode(m.bytes[a] + m.bytes[b]) == [a, b]
            self.neighbours[a << 32 | b] = ok
        return ok

    # ---- BPE states: (node, ((last token, relative count) for each node of the failure chain, longest first))
    def _bpe_id(self, key) -> int:
        i = self.bpe_ids.get(key)
        if i is None:
            i = self.bpe_ids[key] = len(self.bpe)
            self.bpe.append(key)
        return i

    def bpe_step(self, state: int, b: int) -> tuple[int, int]:
        got = self.bpe_steps.get(state << 8 | b)
        if got is not None:
            return got
        node, history = self.bpe[state]
        chain = [node]
        while chain[-1]:
            chain.append(self.fail[chain[-1]])
        by_node = dict(zip(chain, history))
        found = None
        for n in chain:  # tokens that end here: each begins where a node of the chain begins
            to = self.child.get(n << 8 | b)
            if to is not None and self.token[to] >= 0:
                last, rel = by_node[n]
                # a whole word so far has the start before it, and then the token must be its own encoding
                if self._adjoin(last, self.token[to]):
                    found = (self.token[to], rel + 1)
                    break
        token, delta = found
        new, to = [], 0
        for n in chain:
            nxt = self.child.get(n << 8 | b)
            if nxt is not None and self.live[nxt] == nxt:
                to = to or nxt
                last, rel = by_node[n]
                new.append(self._share((last, rel - delta)))
        got = self._share((self._bpe_id((to, (*new, self._share((token, 0))))), delta))
        self.bpe_steps[state << 8 | b] = got
        return got

    def _share(self, x):
        return self.shared.setdefault(x, x)

    def bpe_run(self, state: int, data: bytes) -> tuple[int, int]:
        total = 0
        for b in data:
            state, d = self.bpe_step(state, b)
            total += d
        return state, total

    # ---- splitting states: (mode, bytes of an unfinished character, ...)
    def _id(self, key) -> int:
        i = self.ids.get(key)
        if i is None:
            i = self.ids[key] = len(self.states)
            self.states.append(key)
            if (i + 1) * BLOCKS > len(self.block):
                self.block = np.concatenate([self.block, np.zeros(len(self.block) // 2, np.int32)])
        return i

    def compile(self, state: int, b: int) -> None:
        """Fill one table entry."""
        to, delta = self._next(state, b)
        at = state * BLOCKS + (b >> 4)
        if not self.block[at]:
            if (self.blocks + 1) * CELLS > len(self.cell):
                self.cell = np.concatenate([self.cell, np.zeros(len(self.cell) // 2, np.int32)])
            self.block[at] = self.blocks
            self.blocks += 1
        self.cell[self.block[at] * CELLS + (b & 15)] = to << _SHIFT | (delta + _ZERO)

    def _next(self, state: int, b: int) -> tuple[int, int]:
        if b == PAD:
            return state, 0
        mode, part, *rest = self.states[state]
        data = part + bytes([b])
        lead = data[0]
        need = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        if 0x80 <= lead < 0xC0:  # only a run-up can begin inside a character
            return state, 0
        if len(data) < need:
            return self._id((mode, data, *rest)), 0
        key, delta = self._char(mode, rest, data)
        return self._id(key), delta

    def _begin(self, c: str, kind: str, data: bytes):
        s, n = self.bpe_run(self.fresh, data)
        return ("A" if c == "'" else kind, b"", s), n

    def _char(self, mode: str, rest: list, data: bytes):
        """Next state and count change for one whole character."""
        c = data.decode("utf-8", "replace")
        kind = "S" if ord(c[0]) in WHITE else {"L": "L", "N": "N"}.get(unicodedata.category(c[0])[0], "O")
        if mode == "S":
            before, gone, last, state = rest  # state of the run without its last character, its relative count
            if kind == "S":
                s, n = self.bpe_run(state, data)
                return ("S", b"", state, -n, data, s), n
            if last == b" ":  # the last space goes with what follows
                s, n = self.bpe_run(self.fresh, b" " + data)
                alone = self.bpe_run(self.fresh, last)[1]
                return (kind, b"", s), n + (gone if before >= 0 else -alone)
            key, n = self._begin(c, kind, data)
            alone = self.bpe_run(self.fresh, last)[1]
            return key, n + (gone + alone if before >= 0 else 0)
        if kind == "S":
            s, n = self.bpe_run(self.fresh, data)
            return ("S", b"", -1, 0, data, s), n
        if mode == "A":
            if c in ONE:
                n = self.bpe_run(self.fresh, b"'" + data)[1] - self.bpe_run(self.fresh, b"'")[1]
                return ("0", b""), n
            if c in TWO:
                s, n = self.bpe_run(self.fresh, data)
                return ("C", b"", s, c), n
            if kind == "O":
                s, n = self.bpe_run(rest[0], data)
                return ("O", b"", s), n
        if mode == "C":
            if c == TWO[rest[1]]:
                first = rest[1].encode()
                apart = self.bpe_run(self.fresh, b"'")[1] + self.bpe_run(self.fresh, first)[1]
                return ("0", b""), self.bpe_run(self.fresh, b"'" + first + data)[1] - apart
            mode = "L"
        if mode == kind:
            s, n = self.bpe_run(rest[0], data)
            return (kind, b"", s), n
        return self._begin(c, kind, data)

    # ---- running
    def run(self, bytes_by_step: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and token counts of chunks (one column each) from their entry states."""
        s, total = entry.astype(np.int64), np.zeros(len(entry), np.int64)
        high, low = bytes_by_step >> 4, bytes_by_step & 15
        for i in range(len(bytes_by_step)):
            at = s * BLOCKS
            at += high[i]
            v = self.cell.take(self.block.take(at) * CELLS + low[i])
            if not v.all():
                for x in np.unique((s << 9 | bytes_by_step[i])[v == 0]):
                    self.compile(int(x) >> 9, int(x) & 511)
                v = self.cell.take(self.block.take(at) * CELLS + low[i])
            total += v & ((1 << _SHIFT) - 1)
            s = (v >> _SHIFT).astype(np.int64)
        return s, total - _ZERO * len(bytes_by_step)

    def count(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Tokens of each piece [off[i], off[i + 1])."""
        if len(self.states) > MAX_STATES:  # bounds the table; everything is compiled again when met
            self.reset()
        n_chunks = -(-np.diff(off) // CHUNK)
        first = np.cumsum(n_chunks) - n_chunks
        piece = np.repeat(np.arange(len(n_chunks)), n_chunks)
        if not len(piece):
            return np.zeros(len(off) - 1, np.int64)
        nth = np.arange(len(piece)) - first[piece]
        start = off[:-1][piece] + nth * CHUNK

        def matrix(begin: np.ndarray, stop: np.ndarray, steps: int) -> np.ndarray:
            at = begin[None, :] + np.arange(steps)[:, None]
            return np.where(at < stop[None, :], buf.take(np.minimum(at, len(buf) - 1)).astype(np.int16), np.int16(PAD))
        end = np.minimum(start + CHUNK, off[1:][piece])
        body = matrix(start, end, CHUNK)
        entry = np.full(len(piece), self.ground)
        inner = np.flatnonzero(nth > 0)
        if len(inner):
            entry[inner] = self.run(matrix(start[inner] - RUN_UP, start[inner], RUN_UP), entry[inner])[0]
        exit_, tokens = self.run(body, entry)
        while True:
            wrong = inner[entry[inner] != exit_[inner - 1]]
            if not len(wrong):
                break
            entry[wrong] = exit_[wrong - 1]
            exit_[wrong], tokens[wrong] = self.run(body[:, wrong], entry[wrong])
        whole, done = self.compose(entry, exit_, tokens, nth)
        assert done.all()
        out = np.zeros(len(off) - 1, np.int64)
        last = np.flatnonzero(n_chunks > 0)
        out[last] = whole[first[last] + n_chunks[last] - 1]
        return out

    @staticmethod
    def compose(entry, exit_, tokens, nth) -> tuple[np.ndarray, np.ndarray]:
        """Prefix scan of the maps within each piece: a map entry -> (exit, tokens) follows another if the other
        ends where it begins. After the step of width d each map covers its last 2d chunks."""
        entry, tokens, ok = entry.copy(), tokens.copy(), np.ones(len(entry), bool)
        d, longest = 1, int(nth.max()) + 1
        while d < longest:
            i = np.flatnonzero(nth >= d)
            ok_i = ok[i] & ok[i - d] & (exit_[i - d] == entry[i])
            entry_i, tokens_i = entry[i - d], tokens[i] + tokens[i - d]
            ok[i], entry[i], tokens[i] = ok_i, entry_i, tokens_i
            d *= 2
        return tokens, ok


_COMPILED: dict[str, Transducer] = {}


def _transducer(path: str) -> Transducer:
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def token_counts(buf: np.ndarray, off: np.ndarray, fst: Transducer) -> np.ndarray:
    """Tokens of each text; special strings inside a text are one token each and split it."""
    data = buf.tobytes()
    marks = []  # (start, end) of special strings, leftmost first
    for s in fst.merges.special:
        at = data.find(s)
        while at >= 0:
            marks.append((at, at + len(s)))
            at = data.find(s, at + 1)
    marks.sort()
    kept, free = [], 0
    for a, b in marks:
        row = np.searchsorted(off, a, "right") - 1
        if a >= free and b <= off[row + 1]:
            kept.append((a, b))
            free = b
    if not kept:
        return fst.count(buf, off)
    # pieces alternate text and special string; a special string counts one
    cuts = np.union1d(off, np.array(kept, np.int64).ravel())
    special = np.isin(cuts[:-1], [a for a, _ in kept])
    pieces = fst.count(buf, cuts)
    pieces[special] = 1
    return row_sums(pieces, np.searchsorted(cuts, off))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text; no shuffle.

    ``path`` is a byte-level BPE tokenizer file that every worker can read. Counts equal the tokenizer
    library's without added begin or end tokens. Null and empty texts have 0 bytes and 0 tokens.
    Repeated rows are counted alike; input columns with a result's name are replaced; an empty table gives an
    empty result. Memory: one slice of texts and a table of at most ``MAX_STATES`` states and the
    states of one slice; a very long text is cut into chunks like any other.
    """
    more = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]
    schema = T.StructType([docs.schema[c] for c in kept_fields(docs, [n for n, _ in more])]
                          + [T.StructField(n, t) for n, t in more])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _transducer(path)
        for batch in slices(batches, text_col, 2 << 20):
            buf, off = flat(batch.column(text_col))
            n = token_counts(buf, off, fst)
            yield append_columns(batch, n_bytes=pa.array(np.diff(off), pa.int64()), n_tokens=pa.array(n, pa.int64()),
                                 over_limit=pa.array(n > limit))
    return docs.mapInArrow(count, schema)

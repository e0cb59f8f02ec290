import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from llm_cases import awkward, empty, sample_text

from shelfcast.llm import alignment as AL
from shelfcast.llm import merkle as MK
from shelfcast.llm import prefix_free as PF
from shelfcast.llm.queries import QUERIES
from shelfcast.session import written

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- two tokenizers

def _tokens():
    import sentencepiece
    import tokenizers
    a = tokenizers.Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    table = AL.byte_symbols()

    def bytes_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), (lambda i: bytes(table[c] for c in a.id_to_token(i))), b.encode, bytes_b


def _groups(text, lib):
    """Groups of a whole text by the libraries' own encoding: [(a ids, b ids)]."""
    ids_a, bytes_a, ids_b, bytes_b = lib
    if not text:
        return []
    a, b = ids_a(text), ids_b(text)
    if b"".join(map(bytes_a, a)) != (" " + text).encode() or b"".join(map(bytes_b, b)) != (" " + text).encode():
        return []
    out, i, j = [], 0, 0
    while i < len(a):
        ga, gb = [a[i]], [b[j]]
        x, y = len(bytes_a(a[i])), len(bytes_b(b[j]))
        i, j = i + 1, j + 1
        while x != y:
            if x < y:
                ga.append(a[i])
                x, i = x + len(bytes_a(a[i])), i + 1
            else:
                gb.append(b[j])
                y, j = y + len(bytes_b(b[j])), j + 1
        out.append((ga, gb))
    return out


def _aligned(rows):
    """op12 by definition."""
    lib = _tokens()
    docs = [(i, _groups(t, lib)) for i, t in rows]
    bags = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in docs]
    count = Counter(p for bag in bags for p in bag)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, g), bag in zip(docs, bags):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(bag.values()),
                    sum(n for p, n in bag.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in bag.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out, count, best


AWKWARD_TEXTS = ["", None, " ", "  a", "a ", "\n", "\n\na\nb", "a\n b", "a \nb", "a\r\nb\tc", "x▁y", "▁", "a b c　d", "naïve ﬁ ① é",
                 "<s> </s> <unk> <0x41> <|endoftext|> [x]", "\x00 \x1c a\x1cb", "it's we'll I'M", "\U0001f642\U0001f642 日本語です。", "a" * 3000,
                 "12345 3.14 1e9", "    if (x) {\r\n\treturn;\r\n    }\n", "   wide line", "١٢ ٣", ".\n.\n .", "​ ​﻿ x"]


@pytest.mark.parametrize("text", [t for t in AWKWARD_TEXTS if t])
def test_segments_encode_as_the_whole_text(text):
    table = AL.Segments(A_FILE, B_FILE)
    w, _ = AL._numbers(table, [text])
    want = _groups(text, _tokens())
    got = ";".join(table.texts[i] for i in w) if not table.facts[w, 4].any() else ""
    assert got == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want)


def test_segments_of_random_texts():
    rnd, lib, table = random.Random(3), _tokens(), AL.Segments(A_FILE, B_FILE)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "B", "the", " ", " ", "  ", "\n", "\t", "'s", "9", "é", "日", "-", " ", "ing", "\r"]) for _ in range(rnd.randint(1, 40)))
        assert "".join(AL.segments(text)) == " " + text
        w, _ = AL._numbers(table, [text])
        assert ";".join(table.texts[i] for i in w) == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in _groups(text, lib))


def _rows(df):
    return sorted(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"radix": 3, "slice_bytes": 500, "group_bytes": 2000, "block": 7, "words": 20}])
def test_alignment_matches_brute_force(spark, options):
    """Whole slices, and many small slices, blocks and sets with a table that is emptied often."""
    rows = [(i, t) for i, t in enumerate(AWKWARD_TEXTS)] + [(100 + i % 20, sample_text(30 + i, i % 25)) for i in range(60)]
    rows += [(i, t) for i, t in zip(range(200, 230), [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").take(30)])]
    out, pairs = AL.align(_frame(spark, rows).repartition(3), A_FILE, B_FILE, **options)
    want, count, best = _aligned(rows)
    assert _rows(out) == sorted(want)
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in pairs.collect()} == {p: (n, n == best[p[0]]) for p, n in count.items()}


def test_alignment_of_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    out, _ = AL.align(docs, A_FILE, B_FILE)
    want, _, _ = _aligned([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(_rows(out.na.fill(-99, ["doc_id"]))) == sorted((-99 if r[0] is None else r[0], *r[1:]) for r in want)
    out, pairs = AL.align(empty(spark), A_FILE, B_FILE)
    assert out.count() == 0 and pairs.count() == 0


def test_merge_of_runs():
    rng = np.random.default_rng(0)
    runs, want = [], Counter()
    for k in range(9):
        keys = np.sort(rng.integers(0, 400, 150 * (k % 3)))
        first, pairs, _ = AL._run(keys, np.zeros(len(keys), np.int64), np.ones(len(keys), np.int64), 5 + k)
        if first:
            runs.append((first, pairs))
        want.update(keys.tolist())
    got = list(AL.merge(runs))
    keys, n = (np.concatenate(x) for x in zip(*got))
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), n.tolist())) == want


# ---- repeated bytes

def _bytes_kept(rows, window=100):
    """op11 by definition, for (doc_id, text) rows."""
    first, own, out = {}, defaultdict(dict), []
    for k, (i, t) in enumerate(rows):
        raw = (t or "").encode()
        for j in range(len(raw) - window + 1):
            x = raw[j:j + window]
            own[k].setdefault(x, j)
            if i is not None:
                first[x] = min(first.get(x, i), i)
    for k, (i, t) in enumerate(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - window + 1):
            x = raw[j:j + window]
            if (i is not None and first[x] < i) or own[k][x] < j:
                gone[j:j + window] = b"\1" * window
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _byte_rows(seed=0):
    rnd = random.Random(seed)
    shared = [sample_text(rnd.randint(12, 60), 100 + i) for i in range(5)] + ["é日🙂 " * 40, "=" * 130, "ab" * 90]
    rows = []
    for i in range(50):
        parts = [sample_text(rnd.randint(0, 40), 1000 + i), rnd.choice(shared), sample_text(rnd.randint(0, 30), 2000 + i), rnd.choice(shared)]
        rows.append((rnd.randint(0, 60), rnd.choice(["", " ", "\n"]).join(parts)))
    rows += [(7, "x" * 5000), (9, "x" * 99), (10, "x" * 100), (11, "x" * 101), (12, "\x00" * 150), (3, "\x00" * 99 + "\x01"), (70, rows[3][1]), (71, rows[3][1]),
             (71, rows[3][1]), (1, None), (2, ""), (None, rows[5][1]), (None, rows[5][1] * 2), (None, shared[0]), (80, "  ".join(shared)), (81, shared[1][:100]),
             (82, shared[1][5:104]), (-4, shared[2])]
    return rows


def _cut_rows(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def _want(rows):
    return sorted((i is None, i or 0, *r) for i, *r in _bytes_kept(rows))


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"hot": 3, "gram": 8, "part_bytes": 500}, {"gram": 99, "phrase": 1, "chunk": 300},
                                     {"longest": 7, "hot_bytes": 2000, "phrase": 1000}])
def test_repeated_bytes_match_brute_force(spark, options):
    """Buckets ordered in tasks, windows of frequent triggers one by one, short and long phrases, several parts."""
    rows = _byte_rows()
    assert _cut_rows(PF.remove_repeats(_frame(spark, rows).repartition(5), **options)) == _want(rows)


@pytest.mark.parametrize("options", [{"hot": 2, "hot_bytes": 900}, {"hot": 5, "hot_bytes": 20000, "gram": 8}, {"hot": 1, "hot_bytes": 1}])
def test_frequent_triggers_over_chunks_and_shares(spark, options):
    """Many chunks and many shares of a trigger, null ids, one id twice, text that repeats in itself."""
    rnd = random.Random(5)
    base = sample_text(45, 77)
    rows = [(rnd.choice([None, 4, rnd.randint(0, 90)]), "".join(c if rnd.random() > .01 else rnd.choice("xyz") for c in base) * rnd.choice([1, 1, 2])) for _ in range(40)]
    assert _cut_rows(PF.remove_repeats(_frame(spark, rows).repartition(3), **options)) == _want(rows)


def test_windows_of_frequent_triggers_do_not_travel_one_by_one(spark, monkeypatch):
    """Near copies of one text: no step writes a row for every window of their strings."""
    rnd, made = random.Random(6), {}
    base = sample_text(60, 78)
    rows = [(i, "".join(c if rnd.random() > .004 else rnd.choice("xyz") for c in base)) for i in range(120)]

    def counted(df, name):
        out = written(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out
    monkeypatch.setattr(PF, "written", counted)
    assert _cut_rows(PF.remove_repeats(_frame(spark, rows).repartition(3), hot=40)) == _want(rows)
    assert max(made.values()) < sum(len(t) - 99 for _, t in rows) / 8


def test_repeated_bytes_of_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = PF.remove_repeats(docs, texts=True)
    assert _cut_rows(got) == _want(rows)
    for r in got.filter("kept is not null").collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
    assert PF.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("window", [3, 8, 9, 16, 100])
def test_ranks_order_windows(window):
    rng = np.random.default_rng(window)
    buf = rng.integers(97, 99, 900).astype(np.uint8)
    at = np.arange(len(buf) - window + 1)
    strings = [buf[i:i + window].tobytes() for i in at]
    order = {s: i for i, s in enumerate(sorted(set(strings)))}
    assert PF.ranks(buf, at, window).tolist() == [order[s] for s in strings]


# ---- manifest

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _up(nodes):
    return [_h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]


def _walk(nodes, at):
    """Siblings (left, right) of a leaf, level by level, and the top."""
    out = []
    while len(nodes) > 1:
        run = nodes[at // 8 * 8:at // 8 * 8 + 8]
        out.append((run[:at % 8], run[at % 8 + 1:]))
        nodes, at = _up(nodes), at // 8
    return out, nodes[0]


def _manifest(rows):
    """op13 by definition, for (doc_id, source, lang, n_chars, text) rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    leaves = {g: [_leaf(r) for r in groups[g]] for g in names}
    tops = {g: _walk(leaves[g], 0)[1] for g in names}
    out = []
    for k, g in enumerate(names):
        upper, root = _walk([tops[x] for x in names], k)
        for at, r in enumerate(groups[g]):
            path = _walk(leaves[g], at)[0] + upper
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            x = _leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))) if hit else leaves[g][at]
            for left, right in path:
                x = _h(*left, x, *right)
            proof = _h(*(s for left, right in path for s in left + right))
            out.append((r[0] is None, r[0] or 0, leaves[g][at], tops[g], root, proof, x, x == root))
    return sorted(out)


def _manifest_rows(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *(r[c] for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")))
                  for r in df.collect())


@pytest.mark.parametrize("n,langs", [(1, 1), (8, 1), (9, 1), (520, 1), (700, 3), (60, 30)])
def test_manifest_matches_definition(spark, n, langs):
    """One leaf, full and broken runs, more than one stored level, more groups than a run holds."""
    rnd = random.Random(n)
    rows = [(rnd.randint(-9, 10 * n), rnd.choice(["a", "ß", None]), [None, "de", "", "日", *map(str, range(30))][rnd.randrange(langs)], rnd.choice([None, i]),
             rnd.choice([None, "", "Ab C é" * rnd.randint(1, 9)])) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert _manifest_rows(MK.manifest(df)) == _manifest(rows)


def test_manifest_of_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = [tuple(r[c] for c in MK.FIELDS) for r in docs.collect()]
    assert _manifest_rows(MK.manifest(docs)) == _manifest(rows)
    assert MK.manifest(empty(spark)).count() == 0


def test_only_every_third_level_is_stored(spark):
    leaves = spark.range(600).selectExpr("'g' as grp", "id as pos", "600L as total", "sha2(cast(id as string), 256) as node")
    levels = MK.build(leaves, "test-level")
    assert [x.count() for x in levels] == [600, 2, 1]
    assert levels[-1].first()["node"] == _walk([r["node"] for r in leaves.orderBy("pos").collect()], 0)[1]


def test_queries_cover_whole_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    want, _, _ = _aligned(rows)
    assert _rows(QUERIES["op12_token_alignment"](spark, SF_SMALL)) == sorted(want)

"""Words that a plain polynomial hash cannot tell apart, languages of few long texts, bounded open files and pieces."""

import math
import os
import subprocess

import numpy as np
import pytest
from llm_cases import base_counts, repeats, sample_text

from shelfcast.llm import kneser_ney as KN
from shelfcast.llm import ppm_langid as PPM
from shelfcast.llm import superkmer as SK
from shelfcast.llm.common import span_hash
from shelfcast.llm.compression_quality import compression_quality


def _alternating(k, swap=False):
    """2 ** k letters a, b by the parity of the ones in each place's number (or the other way round)."""
    return "".join("ab"[bin(i).count("1") % 2 ^ swap] for i in range(1 << k))


ONE, OTHER = _alternating(10), _alternating(10, True)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("k", range(1, 13))
def test_alternating_words_have_their_own_hashes(k):
    for form in (lambda s: s, lambda s: s[::-1]):
        buf = np.frombuffer((form(_alternating(k)) + form(_alternating(k, True))).encode(), np.uint8)
        h = span_hash(buf, np.array([0, 1 << k]), np.array([1 << k, 2 << k]))
        assert h[0] != h[1]


def test_repeated_words_compare_long_words(spark):
    text = " ".join([ONE, "b c d e f g h", OTHER, "b c d e f g h"])
    got = compression_quality(_frame(spark, [(1, text)])).first()
    assert got["n_repeat_words"] == base_counts(text)[4] == 0
    assert got["base_failed"] == base_counts(text)[5]


@pytest.mark.parametrize("hot", [1, 2000])
def test_passages_that_differ_in_one_long_word(spark, hot):
    start, end = sample_text(24, 1), sample_text(25, 2)
    rows = [(1, f"{start} {ONE} {end}"), (2, f"{start} {OTHER} {end}"), (3, f"{start} {ONE} {end} more")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in SK.remove_repeats(_frame(spark, rows), hot=hot).collect()}
    assert got == {i: want for (i, _), want in repeats(rows).items()}
    assert got[2][1] == 0 and got[3][1] == 50


def test_unseen_long_word_is_unknown(spark):
    model = KN.train(_frame(spark, [(1, f"x {ONE} y")]))
    got = {r["doc_id"]: r["n_known"] for r in KN.score(_frame(spark, [(1, ONE), (2, OTHER)]), model).collect()}
    assert got == {1: 2, 2: 1}


@pytest.mark.parametrize("first", [0, 100, 12345])
def test_every_language_is_learned(spark, first):
    """Few long texts of one language, whatever their ids: all languages have rows, within one text of their share."""
    rows = [(first + i, sample_text(40_000, i), "de") for i in range(3)] + [(first + 10 + i, sample_text(30, 50 + i), "en") for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = PPM.sample(d, "text", "lang", "doc_id", 20_000).collect()
    assert sum(r["lang"] == "de" for r in got) == 1
    assert 10_000 <= sum(len(r["text"]) for r in got if r["lang"] == "en") <= 10_000 + 400
    narrow = PPM.sample(d, "text", "lang", "doc_id", 20_000, ordered=5).collect()
    assert sorted(map(str, narrow)) == sorted(map(str, got))
    assert PPM.fit(d, sample_bytes=20_000).langs == ["de", "en"]


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_pieces_score_as_the_whole(spark, monkeypatch, piece):
    rows = [(i, sample_text(5 + 3 * i, i), "en" if i % 2 else "de") for i in range(30)] + [(50, "", "en"), (51, "é" * 40, "de"), (52, None, "de")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = PPM.fit(d)
    for _, text, _ in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        code, _ = PPM._grams(raw, np.array([0, len(raw)]), len(trees.grams))
        whole = trees.bits(code, np.minimum(np.arange(len(raw)) + 1, len(trees.grams))).sum(axis=0)
        assert np.allclose(PPM.code_lengths(trees, raw, np.array([0, len(raw)]), piece)[0], whole, rtol=1e-12)
    many = np.frombuffer("".join(t or "" for _, t, _ in rows).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len((t or "").encode()) for _, t, _ in rows])])
    assert np.allclose(PPM.code_lengths(trees, many, off, piece), PPM.code_lengths(trees, many, off), rtol=1e-12)


def test_many_shards_few_open_files(spark, monkeypatch):
    """A model of several hundred files is scored with a bounded number of them open, to the same scores."""
    rows = [(i, sample_text(120, i)) for i in range(60)]
    d = _frame(spark, rows).coalesce(1)
    few = KN.train(d)
    many = KN.train(d, shard_bytes=200, shard_tokens=20)
    assert len(os.listdir(many.folder.replace("file:", ""))) > 400
    a, b = ({r["doc_id"]: r["score"] for r in KN.score(d, m).collect()} for m in (few, many))
    assert all(math.isclose(a[i], b[i], rel_tol=1e-9) for i in a)
    h, off = KN.tokens(np.frombuffer(" ".join(t for _, t in rows).encode(), np.uint8), np.array([0, sum(len(t) + 1 for _, t in rows) - 1]))
    words = np.unique(h)
    ids = many.ids(words)
    many.counts(ids)
    many.follow(ids)
    assert (ids >= 0).all() and len(KN._OPEN) <= KN.MAX_OPEN
    maps = subprocess.run(["cat", f"/proc/{os.getpid()}/maps"], capture_output=True, text=True).stdout
    assert sum("kneser-ney" in line for line in maps.splitlines()) <= KN.MAX_OPEN

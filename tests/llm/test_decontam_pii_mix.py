import hashlib
import re

import pytest
from llm_cases import awkward, bench_hits, empty, personal, sample_text, words

from shelfcast.llm import decontam as DEC
from shelfcast.llm import pareto_mix as MIX
from shelfcast.llm import pii as PII

LONG = sample_text(60, 11)
ITEMS = [(1, " ".join(LONG.split()[:25])), (2, "Solo"), (3, "two Words"), (3, "two Words"), (None, " ".join(LONG.split()[30:45])),
         (5, None), (6, " .,; "), (10, " ".join(LONG.split()[5:16]))]


def _bench(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "z") for i, t in rows], "item_id long, text string, w string")


@pytest.mark.parametrize("limit", [{}, {"broadcast_windows": 0}, {"broadcast_bytes": 100}])
def test_hits_match_brute_force(spark, limit):
    """Both joins: with the benchmark broadcast, and by shuffled positions."""
    rows = [(1, "x " + LONG + " y"), (1, "x " + LONG + " y"), (2, LONG.upper()), (3, "a SOLO, b"), (4, None), (5, ""), (6, "two words two words"),
            (7, " ".join(LONG.split()[3:14])), (8, " ".join(LONG.split()[:9])), (None, LONG), (9, sample_text(500, 12)), (9, LONG[:200])]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, item string, n int")
    got = DEC.digest(DEC.hits(docs, _bench(spark), **limit)).collect()
    want = []
    for i, t in rows:
        n, hit, items = bench_hits(t, ITEMS)
        want.append((i, n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0))
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    clean = DEC.clean_documents(docs, _bench(spark), **limit)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in rows if not bench_hits(t, ITEMS)[1])


def test_decontam_awkward(spark):
    d = awkward(spark)
    assert DEC.digest(DEC.hits(d, _bench(spark, []))).count() == d.count()
    assert DEC.digest(DEC.hits(empty(spark), _bench(spark))).count() == 0
    assert DEC.clean_documents(d, _bench(spark, [])).count() == d.count()


TEXTS = [
    "mail a.b+c@d-e.co.uk, x_y%z@q.r", "a@b.c@d.e a@b.c_d@e.f @x.y a@b", "1.2.3.4 256.1.1.1 1.2.3.4.5 0001.02.3.255 1..2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500005555555559", "+1 (555) 010-9999 +49.30.1234567 +12 34 +1-2-3",
    "DE89 3704 0044 0532 0130 00 OK GB82WEST12345698765432 DE89370400440532013001 XX00123456789012",
    "é日🙂 a@b.cc 日 8.8.8.8 ++1234567890 1.1.1.1@x.com", "0" * 30000, "a" * 30000 + "@x.y", "1 " * 9000, "+" * 5000 + "1", "." * 20000,
    "123456789.1.1.99999999999999999999 4111111111111111 4111111111111111", None, "", "@"]


def test_spans_match_brute_force(spark):
    rows = PII.digest(PII.find_pii(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))).collect()
    for r in rows:
        want = personal(TEXTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("iban")] == want
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(want)
    ibans = [s for s in rows[5].spans.split(",") if s.startswith("iban")]
    assert [TEXTS[5][int(a):int(b)] for _, a, b in (s.split(":") for s in ibans)] == [
        "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]


def test_context_raises_score(spark):
    t = ["call +1 555 010 9999 now", "xyz +1 555 010 9999 now", "my card 4111 1111 1111 1111", "discard 4111 1111 1111 1111"]
    d = PII.find_pii(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")).orderBy("doc_id").collect()
    s = [max(x.score for x in r.pii if x.kind in ("phone", "card")) for r in d]
    assert s[0] > s[1] and s[2] > s[3]


def test_mask_replaces_all_spans(spark):
    d = spark.createDataFrame([(*r, "z") for r in enumerate(TEXTS)], "doc_id long, text string, pii string")
    out = PII.mask(PII.find_pii(d)).collect()
    assert len(out) == len(TEXTS)
    got = {r.doc_id: r.text for r in out}
    assert got[0] == "mail [EMAIL], [EMAIL]" and got[13] is None and got[14] == ""
    assert got[3] == "[CARD] and 4111-1111-1111-1112 5500005555555559"  # one run of 32 digits: it fails and is not retried
    for i, t in enumerate(TEXTS):
        if t and not personal(t) and i != 5:
            assert got[i] == t
    for t in got.values():  # what is left of a masked text holds none
        assert not [s for s in personal(t) if s.startswith("email")] or "@" in re.sub(r"\[EMAIL\]", "", t)


def test_context_decides_over_added_spans(spark):
    """The same run of characters stays beside a context word and goes without one; scores are given out; mod-97 needs none."""
    run, iban = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "GE29NB0000000101904917"
    texts = [f'token = "{run}"', f"the commit {run} of", f"{run} is your password", "a" * 40 + " token", "1" * 40 + " key", iban, f"bank {iban}",
             "BR1800360305000010009795493C1", f"token {' x' * 30} {run}"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in PII.digest(PII.find_pii(d)).collect()}
    assert [got[i]["n_secret"] for i in range(9)] == [1, 0, 1, 0, 0, 0, 0, 0, 0]
    assert [got[i]["n_iban"] for i in range(9)] == [0, 0, 0, 0, 0, 1, 1, 1, 0]
    assert got[0]["scores"] == "0.6" and got[5]["scores"] == "0.6" and got[6]["scores"] == "0.9"
    assert run not in PII.mask(PII.find_pii(d)).filter("doc_id = 0").first()["text"]


def test_pii_awkward(spark):
    d = awkward(spark)
    assert PII.find_pii(d).count() == d.count() and PII.find_pii(empty(spark)).count() == 0
    assert PII.mask(PII.find_pii(d)).count() == d.count()


def _targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Fill by weight, hold what is above its cap, share the rest again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > cap * sizes[s]]
        if not over:
            return t | {s: float(cap * sizes[s]) for s in full}
        full.update(over)


@pytest.mark.parametrize("buckets", [4096, 3])
def test_mix_targets_and_fill(spark, buckets):
    rows = [(i, sample_text(5 + i * 7 % 90, i), ["a", "B", "é", None, "zz", "日"][min(i % 11, 5)]) for i in range(900)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = MIX.pareto_mix(d, buckets=buckets).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = _targets(sizes)
    assert len(out) == len(rows)
    for s in sizes:
        mine = [r for r in out if r.source == s]
        assert mine[0].target == pytest.approx(want[s]) and mine[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r.size for r in mine) / 2 + 1e-6
        low = int(want[s] / sizes[s] + 1e-9)
        assert all(r.taken in (low * r.size, (low + 1) * r.size) and r.taken <= 2 * r.size for r in mine)
    again = MIX.pareto_mix(d.repartition(7), buckets=64).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in out)


def test_mix_with_document_weights(spark):
    rows = [(i, 10 + i % 5, "a" if i % 3 else "b", 1.0 + (i % 4)) for i in range(2000)]
    d = spark.createDataFrame(rows, "doc_id long, words long, source string, quality double")
    out = MIX.pareto_mix(d, size_col="words", weight_col="quality", share=0.5).collect()
    for s in "ab":
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 14
    share = {q: sum(r.copies for r in out if r.quality == q) for q in (1.0, 4.0)}
    assert share[4.0] > 3 * share[1.0]  # inclusion follows the weight


@pytest.mark.parametrize("share", [0.3, 1.5, 1.9])
def test_heavy_documents_reach_the_cap_and_the_target_holds(spark, share):
    """Where the heavier documents are full, the lighter ones take the rest of the target."""
    rows = [(i, 10 + i % 7, "ab"[i % 5 == 0], (1.0, 2.0, 9.0)[i % 3]) for i in range(1500)]
    d = spark.createDataFrame(rows, "doc_id long, words long, source string, quality double")
    out = MIX.pareto_mix(d, size_col="words", weight_col="quality", share=share).collect()
    for s in "ab":
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 8 and all(r.taken <= 2 * r.size for r in mine)
        by = [sum(r.copies for r in mine if r.quality == q) / sum(r.quality == q for r in mine) for q in (1.0, 2.0, 9.0)]
        assert by == sorted(by)
        # expected copies: the weight times one rate, at most 2, that adds up to the target
        low, high = 0.0, 1e6
        for _ in range(200):
            rate = (low + high) / 2
            full = sum(r.size * min(2, rate * r.quality) for r in mine) > mine[0].target
            low, high = (low, rate) if full else (rate, high)
        assert by == pytest.approx([min(2, low * q) for q in (1.0, 2.0, 9.0)], abs=0.12)


def test_mix_awkward(spark):
    d = awkward(spark)
    out = MIX.pareto_mix(d)
    assert out.count() == d.count() and len(set(out.columns)) == len(out.columns)
    assert all(r.size == len(words(r.text)) and r.taken <= 2 * r.size for r in out.collect())
    assert MIX.pareto_mix(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in MIX.pareto_mix(blank).collect()] == [0, 0]

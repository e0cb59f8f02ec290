import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_cases import awkward, empty, near_classes, repeats, sample_text, words

from shelfcast.llm import icws as ICWS
from shelfcast.llm import kneser_ney as KN
from shelfcast.llm import superkmer as SK
from shelfcast.llm import text_density as TD
from shelfcast.llm.queries import QUERIES


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- repeated passages

def _passages(seed=0, n=40):
    rnd = random.Random(seed)
    shared = [sample_text(rnd.randint(45, 90), 100 + i) for i in range(4)]
    rows = []
    for i in range(n):
        parts = [sample_text(rnd.randint(0, 60), 1000 + i), rnd.choice(shared), sample_text(rnd.randint(0, 40), 2000 + i)]
        rows.append((rnd.randint(0, 60), (" \n"[i % 2]).join(p for p in parts if p)))
    rows += [(7, "la " * 300), (9, "la " * 120), (70, rows[3][1]), (71, rows[3][1]), (71, rows[3][1]), (1, None), (2, ""), (None, rows[5][1]),
             (None, shared[0]), (80, "  ".join(shared))]
    return rows


@pytest.mark.parametrize("hot,minimiser", [(2000, 10), (1, 10), (2, 1), (2000, 49)])
def test_repeats_match_brute_force(spark, hot, minimiser):
    """Buckets of strings, and the digests of frequent minimisers."""
    rows = _passages()
    want = repeats(rows)
    got = SK.remove_repeats(_frame(spark, rows), hot=hot, minimiser=minimiser).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted((str(i), *want[i, t]) for i, t in rows)
    assert sum(r.n_removed for r in got) > 1000


def test_repeats_return_texts(spark):
    import hashlib
    for r in SK.remove_repeats(_frame(spark, _passages()), texts=True).collect():
        if r.kept_text is not None:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_repeats_awkward(spark):
    d = awkward(spark)
    assert SK.remove_repeats(d).count() == d.count() and SK.remove_repeats(empty(spark)).count() == 0


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for size in (1, 2, 7, 41):
        got = SK.sliding_min(x.copy(), size)
        assert [int(v) for v in got[:200 - size + 1]] == [int(x[i:i + size].min()) for i in range(200 - size + 1)]


# ---- near duplicates

def _near(seed=1):
    rnd = random.Random(seed)
    rows = []
    for g in range(25):
        base = sample_text(rnd.randint(120, 400), 300 + g).split()
        for c in range(rnd.randint(1, 9)):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                w[rnd.randrange(len(w))] = sample_text(1, rnd.randrange(10**6))
            rows.append((rnd.randint(0, 5000), " ".join(w)))
    rows += [(9001, rows[0][1]), (9002, rows[0][1]), (9003, None), (9004, ""), (9005, " \n"), (None, rows[1][1]), (9006, "a b"), (9007, "a b"),
             (9008, "a b c")]
    return rows


def test_classes_match_brute_force(spark):
    rows = _near()
    got = ICWS.near_duplicates(_frame(spark, rows)).collect()
    want = near_classes(rows)
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == sorted((str(i), str(c)) for i, _, c in want)
    small = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op7_icws_neardup"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == sorted((i, c) for i, _, c in near_classes(small))


def test_large_group_of_near_copies_is_one_class(spark):
    """Leaders that some members do not match: the finer buckets find the rest."""
    rnd, base, rows = random.Random(4), sample_text(150, 9).split(), []
    for i in range(300):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2])):
            w[rnd.randrange(len(w))] = sample_text(1, 10**6 + i * 7 + rnd.randrange(7))
        rows.append((i, " ".join(w)))
    got = ICWS.near_duplicates(_frame(spark, rows)).collect()
    want = {i: c for i, _, c in near_classes(rows)}
    assert {r.doc_id: r.class_id for r in got} == want
    assert Counter(want.values()).most_common(1)[0][1] > 250


def _star(copies, edits, seed, n=200):
    """A text, and copies that are similar to it but not to each other."""
    rnd, base = random.Random(seed), sample_text(n, seed).split()
    out = [" ".join(base)]
    for i in range(copies):
        w = list(base)
        for at in rnd.sample(range(3, n - 3, 6), edits):
            w[at] = f"edit{seed}x{i}x{at}"
        out.append(" ".join(w))
    return out


def test_copies_that_match_only_their_hub_are_one_class(spark):
    rows = list(enumerate(_star(250, 3, 71) + _star(40, 3, 72) + _star(6, 3, 73)))
    want = {i: c for i, _, c in near_classes(rows)}
    assert len(set(want.values())) == 3
    got = ICWS.near_duplicates(_frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == want


def test_small_blocks_give_the_same_classes(spark, monkeypatch):
    monkeypatch.setattr(ICWS, "BLOCK_ROWS", 16)
    rows = list(enumerate(_star(90, 3, 74) + ["la " * 40 + t for t in _star(30, 2, 75)]))
    got = ICWS.near_duplicates(_frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: c for i, _, c in near_classes(rows)}


def test_links_count_every_similar_text(spark):
    """Groups of mutually similar texts: a link to each of the others, in listed buckets and in blocks."""
    rows = list(enumerate(_star(39, 1, 76) + _star(4, 1, 77)))
    got = {r.doc_id: r.n_links for r in ICWS.near_duplicates(_frame(spark, rows + [(900, rows[0][1])])).collect()}
    assert [got[i] for i, _ in rows] == [39] * 40 + [4] * 5 and got[900] == 39


def test_one_of_each(spark):
    rows = _near()
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, digest string, root int")
    out = ICWS.one_of_each(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    want = near_classes(rows)
    blank = [i for i, t, _ in want if not words(t)]
    assert len(kept) == len({c for _, t, c in want if words(t)}) + len(set(blank))
    assert {r.doc_id for r in kept} == {c for _, _, c in want}


def test_sampling_follows_weighted_jaccard():
    """The share of equal samples estimates the similarity of two weighted sets."""
    rng = np.random.default_rng(3)
    key = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2))
    ca, cb = rng.integers(1, 5, 400), rng.integers(1, 5, 400)
    idf = np.ones(16, np.float32)
    true = np.minimum(ca, cb).sum() / np.maximum(ca, cb).sum()
    off = np.array([0, 400])
    hits = 0
    for t in range(60):
        k = np.sort(ICWS.mix(key + np.uint64(t)))
        a, b = (ICWS.band_keys(k, c, off, idf)[0] for c in (ca, cb))
        hits += (a == b).sum()
    assert hits / (60 * ICWS.BANDS) == pytest.approx(true ** ICWS.ROWS, abs=0.05)
    assert ICWS.weighted_jaccard((key, ca, off), (key, cb, off), idf)[0] == pytest.approx(true)


def test_document_frequencies_add_up(spark):
    rows = [(i, sample_text(30, i % 17)) for i in range(200)]
    d = _frame(spark, rows).repartition(9)
    counters, docs = ICWS.document_frequencies(d, fan=2)
    assert docs == 200 and counters.sum() == 200 * 26
    idf = ICWS.inverse_frequencies(counters, docs)
    assert 1 <= idf.min() <= idf.max() <= 1 + ICWS.DAMPING


def test_components(spark):
    rnd = random.Random(2)
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("a", f"b{i}") for i in range(50)] + [(f"q{rnd.randrange(30)}", f"q{rnd.randrange(30)}") for _ in range(25)]
    got = {r.node: r.root for r in ICWS.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[find(a)] = find(b)
    low = {}
    for x in list(parent):
        low[find(x)] = min(low.get(find(x), x), x)
    want = {x: low[find(x)] for x in parent if low[find(x)] != x}
    assert {k: v for k, v in got.items() if k != v} == want


def test_near_awkward(spark):
    d = awkward(spark)
    out = ICWS.near_duplicates(d)
    assert out.count() == d.count() and ICWS.near_duplicates(empty(spark)).count() == 0
    assert ICWS.one_of_each(d).columns == d.columns


# ---- pages

PAGES = [
    ("<p>a<p>b", "a\nb"), ("x &amp; y &eacute;&#233;&lt;b&gt;", "x & y éé<b>"), (None, ""), ("", ""), ("plain  text\n here", "plain text here"),
    ("<html><head><title>t</title><style>p{}</style></head><body><nav>m</nav><div class='ad'>buy</div><article><h1>T</h1><p><b>One<br>"
     "two<p>three <a href=x>four</a></article><div id='comments'><p>" + "reader " * 50 + "</p></div><footer>f</footer></body>", "T\nOne two\nthree four"),
    ("<script>if (a < b) { '</p>' }</script><p>z<!-- <p>no</p> --> y</p><textarea>form</textarea>", "z y"),
    ("<main><header><h1>Head</h1></header><p>text</p><form><p>name</p></form><aside>side</aside></main>", "Head\ntext"),
    ("<div hidden>h</div><div style='display: none'>h</div><div role=navigation>h</div><p title='a>b'>shown</p>", "shown"),
    ("<div class=x><p>" + "first part of it " * 20 + "</p><p>" + "second part of it " * 20 + "</p></div><ul>" + "<li><a href=1>link</a>" * 30 + "</ul>",
     ("first part of it " * 20).strip() + "\n" + ("second part of it " * 20).strip()),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<div>" * 30000 + "deep", "deep"), ("<" * 5000, "<" * 5000), ("<p>cut <b", "cut"),
]


STORY = "a long line of the story " * 8
WRAPPED = [
    ("<div class='%s'><article><p>" + STORY + "</p></article></div>", ["content-sidebar-wrap", "layout has-sidebar", "site no-sidebar", "sidebar", "modal"]),
    ("<nav>menu</nav><form id=%s><div><p>" + STORY + "</p><p>" + STORY + "</p></div></form><footer>end</footer>", ["aspnet", "login"]),
    ("<article><p>" + STORY + "</p><div class='%s'><p>" + STORY + "</p></div><div class=ads>buy</div></article>",
     ["social-science", "related-work", "notice"]),
]


def test_wrappers_and_content_blocks_stay():
    line = STORY.strip()
    for (page, names), n in zip(WRAPPED, (1, 2, 2)):
        for name in names:
            assert TD.main_text(page % name) == "\n".join([line] * n), name
    assert TD.main_text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math></p></article>") == "so x=1"
    teaser = "<aside class=sidebar><article>short</article></aside>"
    assert TD.main_text(f"{teaser}<div><article>{STORY}</article></div>") == line
    assert TD.main_text(f"<div class=sidebar><main>{STORY}</main></div>{teaser}") == line


def test_pages(spark):
    d = spark.createDataFrame([(i, "u", h, "z") for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    for r in TD.extract(d).collect():
        assert r.text == PAGES[r.page_id][1] and r.n_chars == len(r.text), PAGES[r.page_id][0][:60]
    assert TD.extract(d.limit(0)).count() == 0


def test_all_pages_give_their_article(spark):
    import html
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = QUERIES["op8_text_density"](spark, SF_SMALL).collect()
    assert len(rows) == len(raw)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", raw[r.page_id] or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", article[1] if article else "")
        text = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        assert r.text == "\n".join(x for x in text if x)


def test_density_formula():
    p = TD._Page("<body><div><p>" + "a" * 80 + "</p><a>" + "b" * 20 + "</a></div></body>")
    density, sums = TD._densities(p)
    body, div, par, link = 1, 2, 3, 4
    base = math.log(100 / 80 * 20 + 0.2 * 100 + math.e)
    assert density[div] == pytest.approx(100 / 2 * math.log(100 / 20 * 2 / 1) / math.log(base))
    assert sums[div] == pytest.approx(density[par] + density[link]) and sums[body] == pytest.approx(density[div])


# ---- language model

def _model(rows):
    """Plain modified Kneser-Ney on (text) rows; returns a scorer of texts."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tok = lambda s: words((s or "").translate(low)) + ["\0end"]
    c, pairs = Counter(), Counter()
    for t in rows:
        w = tok(t)
        c.update(w)
        pairs.update(zip(["\0begin"] + w, w))
    n, v = sum(c.values()), len(c)
    ctx, follow, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (a, b), k in pairs.items():
        ctx[a] += k
        follow[a][min(k, 3) - 1] += 1
        before[b] += 1
    d = KN.discounts(*[sum(k == j for k in pairs.values()) for j in (1, 2, 3, 4)])
    e = KN.discounts(*[sum(k == j for k in before.values()) for j in (1, 2, 3, 4)])
    free = sum(e[min(k, 3)] for k in before.values()) / len(pairs) if pairs else 1.0

    def one(w):
        return (max(before[w] - e[min(before[w], 3)], 0) / len(pairs) if pairs else 0) + free / (v + 1)

    def score(text):
        w = tok(text)
        s = 0.0
        for a, b in zip(["\0begin"] + w, w):
            k = pairs[a, b]
            s += math.log10(max(k - d[min(k, 3)], 0) / ctx[a] + sum(d[j + 1] * follow[a][j] for j in range(3)) / ctx[a] * one(b)
                            if ctx[a] else one(b))
        return (len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), s), (c, one)
    return score


def test_scores_match_definition(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    score = _model([t for i, t in rows.items() if not held(i)])
    got = QUERIES["op9_kneser_ney"](spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, s = score(rows[r.doc_id])[0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(s, rel=1e-9)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # better than the base on held-out texts


def test_small_shards_and_sums_to_one(spark):
    rows = [sample_text(40, i % 9) + " The the THE" for i in range(60)] + [None, ""]
    texts = spark.createDataFrame([(t,) for t in rows], "text string").repartition(5)
    m = KN.train(texts, shard_bytes=64, shard_tokens=50)
    score = _model(rows)
    for r in KN.score(texts, m).collect():
        assert r.score == pytest.approx(score(r.text)[0][4], rel=1e-9)
    c, one = score("")[1]
    assert sum(one(w) for w in c) + one("never seen") == pytest.approx(1.0)


def test_model_of_nothing(spark):
    d = awkward(spark)
    m = KN.train(empty(spark))
    out = KN.score(d, m).collect()
    assert len(out) == d.count() and all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in out)
    m = KN.train(d)
    assert KN.score(d, m).count() == d.count() and KN.score(empty(spark), m).count() == 0


# ---- the choice by density

def _naive(p):
    """Chosen roots by definition: densities from whole subtrees, the largest sum, the path's threshold, each subtree's best."""
    n = len(p.tag)
    below = [[j for j in range(n) if i <= j <= p.last[i]] for i in range(n)]
    c = [sum(p.chars[j] for j in b) for b in below]
    lc = [sum(p.link_chars[j] for j in b) for b in below]
    t = [max(1, len(b) - 1) for b in below]
    lt = [sum(p.tag[j] == "a" for j in b[1:]) for b in below]
    share = lc[0] / (c[0] or 1)

    def density(i):
        if not c[i]:
            return 0.0
        d = c[i] / t[i]
        if share:
            base = math.log(c[i] / ((c[i] - lc[i]) or 1) * lc[i] + share * c[i] + math.e)
            d *= math.log(max(c[i] / (lc[i] or 1) * t[i] / (lt[i] or 1), 1.0)) / math.log(base)
        return d
    dens = [density(i) for i in range(n)]
    sums = [sum(dens[j] for j in range(1, n) if p.parent[j] == i) for i in range(n)]
    best = max(range(n), key=lambda i: (sums[i], -i))
    path, i = [], best
    while i >= 0:
        path.append(dens[i])
        i = p.parent[i]
    roots = {max(below[i], key=lambda j: (sums[j], -j)) for i in range(n) if dens[i] and dens[i] >= min(path)}
    roots = {TD._block(p, r) for r in roots}
    return sorted(r for r in roots if not any(o < r <= p.last[o] for o in roots))


def test_density_choice_matches_definition():
    rnd = random.Random(4)

    def html(depth):
        out = []
        for _ in range(rnd.randint(1, 4)):
            tag = rnd.choice(["div", "p", "a", "span", "article", "ul", "section", "b"])
            inner = html(depth - 1) if depth and tag not in ("p", "a") and rnd.random() < 0.6 else "word " * rnd.randint(0, 30)
            out.append(f"<{tag}>{inner}</{tag}>")
        return "".join(out)
    for _ in range(120):
        page = TD._Page(f"<html><body>{html(3)}</body></html>")
        assert TD._chosen(page) == _naive(page)


@pytest.mark.parametrize("page", ["<body><nav>" + "<div>" * 100_000 + "x", "<body><p><button>" + "<i>" * 100_000 + "<hr>" * 100_000,
                                  "<table>" + "<tr><td>" * 100_000, "<ul>" + "<li><a>" * 100_000, "<div>" * 100_000 + "<a>x" * 100_000])
def test_nested_pages_take_linear_time(page):
    start = time.process_time()
    TD.main_text(page)
    assert time.process_time() - start < 4

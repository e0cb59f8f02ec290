"""Plain-Python versions of the text operators, and a table of awkward rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def sample_text(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abdeilmnorstu") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def awkward(spark, extra=True):
    """Nulls in every column, blank and very long texts, repeated rows, ties, columns named like results."""
    a, b = sample_text(120, 1), sample_text(300, 2)
    rows = [(1, a, "en", "s0", 1), (1, a, "en", "s0", 1), (2, a, "en", "s1", 1), (3, None, "en", "s0", None), (4, "", None, None, 0),
            (None, b, "de", "s1", 5), (None, b, "de", "s1", 5), (None, None, None, None, None), (5, " \t\n\v\f\r ", "fr", "s2", 6),
            (6, sample_text(30000, 3), "en", "s0", 9), (7, b + " " + a, "de", "s2", 2), (8, "the the " * 4000, "en", None, 3),
            (9, "aé日🙂 x y ##$% <|endoftext|> 'll", "en", "s3", 2), (10, "x" * 70000, "en", "s3", 70000), (11, "one", "en", "s3", 3),
            (-5, a + "\n" + a, "en", "s0", 2)]
    schema = T._parse_datatype_string(DOCS)
    if not extra:
        return spark.createDataFrame(rows, schema)
    more = "kept string, n_words string, n_tokens string, pii string, size string, digest string, word string, taken string, bits string, score string"
    return spark.createDataFrame([(*r, *["z"] * 10) for r in rows], T._parse_datatype_string(DOCS + ", " + more))


def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCS))


def base_counts(text):
    """op1's counts."""
    w = words(text)
    first, cov = {}, set()
    for i in range(len(w) - 7):
        k = tuple(w[i:i + 8])
        if k in first:
            cov.update(range(i, i + 8))
            cov.update(range(first[k], first[k] + 8))
        else:
            first[k] = i
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cov), len(w) < 20 or 100 * len(cov) > 30 * len(w))


def repeats(rows, window=50):
    """op5 for (doc_id, text) rows: {(doc_id, text): (n_words, n_removed, kept_sha256)}."""
    first = {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i, t] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def near_classes(rows, threshold=0.8, size=5):
    """Class id of each (doc_id, text) row by plain weighted Jaccard of shingle counts, all pairs that share one."""
    texts = {}
    for i, t in rows:
        if words(t):
            texts.setdefault(t, []).append(i)
    keys, bags = list(texts), []
    for t in keys:
        w = words(t)
        bags.append(Counter(tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))))
    where = defaultdict(list)
    for k, bag in enumerate(bags):
        for s in bag:
            where[s].append(k)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in {(a, b) for v in where.values() for a in v for b in v if a < b}:
        both = sum((bags[a] & bags[b]).values())
        if both >= threshold * (sum(bags[a].values()) + sum(bags[b].values()) - both):
            parent[find(a)] = find(b)
    low = defaultdict(list)
    for k, t in enumerate(keys):
        low[find(k)] += [i for i in texts[t] if i is not None]
    at = {t: k for k, t in enumerate(keys)}
    return [(i, t, (min(low[find(at[t])], default=None) if words(t) else i)) for i, t in rows]


def bench_hits(text, items, size=10):
    """op4: (n_words, n_hit, sorted items) of a text; items: (item_id, text)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = split(text), set(), set()
    for item, t in items:
        b = split(t)
        for j in range(max(1, len(b) - size + 1) if b else 0):
            win = b[j:j + size]
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def personal(text):
    """op6's base spans."""
    t, out = text or "", []
    for kind, pattern, ok in [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[ -]", "", m)) <= 19 and _luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]:
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, t) if ok(m[0])]
    return out

"""Benchmark decontamination: a prefix-filtered set join on item-sized windows.

A window is ``WINDOW`` consecutive words of an item (an item with fewer words is one window). Its
tokens are its two-word shingles. A document that contains the window contains all of them, so for
this similarity (full containment) the necessary prefix is one token: the rarest over all documents.
Documents are joined on that token only. The token's place in the window gives the place of the window
in the document (positional bound), which must fit between the document's ends (length bound), and the
words there are compared with the window's (exact verification).

Documents are read twice and never shuffled: once to count the benchmark's shingles, once to join.
What leaves a scan are counts, or one row per document plus one per hit. The benchmark's side is
broadcast while its measured size is small; beyond, slim positions are shuffled instead and the hits
verified against the documents by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import written

WINDOW = 10
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Above so many windows, or so many bytes of them, the benchmark is not broadcast.
BROADCAST_WINDOWS = 200_000
BROADCAST_BYTES = 32 << 20
_END = -1  # token of the row that each document sends once


def words(text: Column) -> Column:
    """Words of a text after A-Z are lower-cased; null has none."""
    t = F.coalesce(text, F.lit(""))
    plain = F.octet_length(t) == F.length(t)  # ASCII only: the fast lower() does the same
    return F.array_remove(F.split(F.when(plain, F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER)), WORD_BREAK), "")


def _token(at: Column, next_: Column) -> Column:
    return F.xxhash64(at, next_)


def _windows(bench: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(item, words, tokens) of every distinct window of an item."""
    b = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w"))
    b = b.filter(F.size("w") > 0)
    b = b.select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1))),
        lambda i: F.slice(F.col("w"), i, size))).alias("window")).distinct()
    single = F.size("window") == 1
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("window") - 1, F.lit(1))),
                        lambda i: _token(F.element_at("window", i), F.try_element_at("window", i + 1)))
    return b.withColumn("tokens", F.when(single, F.array(_token(F.element_at("window", 1), F.lit(None).cast("string"))))
                        .otherwise(pairs))


def _positions(docs: DataFrame, single: bool) -> DataFrame:
    """Each document's words one by one with their token, and one row past the last.

    ``posexplode_outer`` keeps Catalyst from adding a size test that would split every text again."""
    d = docs.select("id", "text_hash", "w", F.posexplode_outer("w").alias("at", "word"), F.size("w").alias("n"))
    token = F.when(F.col("at") == F.col("n") - 1, F.lit(_END).cast("long")).otherwise(
        _token(F.col("word"), F.get(F.col("w"), F.col("at") + 1)))
    if single:
        d = d.select("*", F.explode(F.array(token, F.when(
            F.col("at") < F.col("n") - 1, _token(F.col("word"), F.lit(None).cast("string"))))).alias("token"))
        return d.filter(F.col("token").isNotNull())
    return d.withColumn("token", token)


def hits(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per distinct (doc_id, text): id, text_hash, copies, n_words, spans (start, end), items.

    Words are code points other than ASCII non-alphanumerics. Null or wordless texts have no words and
    no hits; wordless items have no windows; items with equal ids count as one, a null id as the
    empty id. Repeated rows are one row here, with their number in ``copies``. Empty tables on either
    side are fine, as are texts and words of any length. No pairs of documents are formed, and a passage that many documents hold costs
    one row per occurrence. Other columns of either table are not read.
    """
    end = F.array(F.lit("\x01"))
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.concat(words(F.col(text_col)), end).alias("w"))
    wins = written(_windows(bench, item_id, item_text, window), "decontam-windows")
    tokens = wins.select(F.explode("tokens").alias("token")).distinct()
    size = F.aggregate("window", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w))
    n, n_bytes = wins.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()  # bound the broadcast
    small = n <= broadcast_windows and n_bytes <= broadcast_bytes
    single = not wins.filter(F.size("window") == 1).isEmpty()
    hint = F.broadcast if small else (lambda d: d)

    # rarity of the benchmark's tokens over all documents
    rare = _slim(base, single).join(hint(tokens), "token").groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    ranked = wins.select("item", "window", F.posexplode("tokens").alias("off", "token")).join(hint(rare), "token", "left")
    prefix = ranked.groupBy("item", "window").agg(F.min_by(
        F.struct("token", "off"), F.struct(F.coalesce("freq", F.lit(0)), "token", "off")).alias("rarest"))
    prefix = prefix.select("item", "window", F.size("window").alias("len"), "rarest.*")
    prefix = prefix.groupBy("token", "off", "window", "len").agg(F.collect_set("item").alias("items"))
    ends = prefix.sparkSession.range(1).select(
        F.lit(_END).cast("long").alias("token"), F.lit(0).alias("off"), F.array().cast("array<string>").alias("window"),
        F.lit(0).alias("len"), F.array().cast("array<string>").alias("items"))
    prefix = written(prefix.unionByName(ends), "decontam-prefixes")
    start = F.col("at") - F.col("off")
    fits = (start >= 0) & (start + F.col("len") <= F.col("n") - 1)
    if small:
        found = _positions(base, single).join(F.broadcast(prefix), "token") \
            .filter((F.col("token") == _END) | (fits & (F.slice(F.col("w"), start + 1, F.col("len")) == F.col("window"))))
        found = found.select("id", "text_hash", F.col("n") - 1, (F.col("token") == _END), start, "len", "items") \
            .toDF("id", "text_hash", "n", "is_end", "start", "len", "items")
    else:
        found = _verified_by_key(base, _slim(base, single), prefix, start, fits)
    return found.groupBy("id", "text_hash").agg(
        F.count_if("is_end").alias("copies"), F.max("n").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(~F.col("is_end"), F.struct("start", (F.col("start") + F.col("len")).alias("end")))
                                   )).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def _slim(base: DataFrame, single: bool) -> DataFrame:
    """Positions without the document's word array."""
    return _positions(base, single).select("id", "text_hash", "at", "n", "token")


def _verified_by_key(base: DataFrame, slim: DataFrame, prefix: DataFrame, start: Column, fits: Column) -> DataFrame:
    """The join for a large benchmark: slim positions are shuffled by token, hits by document."""
    ends = slim.filter(F.col("token") == _END).select(
        "id", "text_hash", (F.col("n") - 1).alias("n"), F.lit(True).alias("is_end"), F.lit(0).alias("start"),
        F.lit(0).alias("len"), F.array().cast("array<string>").alias("items"))
    cand = slim.filter(F.col("token") != _END).join(prefix, "token").filter(fits) \
        .select("id", "text_hash", start.alias("start"), "len", "window", "items").distinct().alias("c")
    texts = base.dropDuplicates(["id", "text_hash"]).alias("b")
    same = F.slice(F.col("b.w"), F.col("start") + 1, F.col("len")) == F.col("window")
    ok = cand.join(texts, F.col("c.id").eqNullSafe(F.col("b.id")) & F.col("c.text_hash").eqNullSafe(F.col("b.text_hash"))) \
        .filter(same).select("c.id", "c.text_hash", (F.size("b.w") - 1).alias("n"), F.lit(False).alias("is_end"),
                             "start", "len", "items")
    return ends.unionByName(ok)


def digest(found: DataFrame) -> DataFrame:
    """Per document row: n_words, n_hit (words inside any occurrence), n_items, items_sha256, contaminated."""
    def step(acc: Column, s: Column) -> Column:
        return F.struct((acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["to"], s["start"]))).alias("n"),
                        F.greatest(acc["to"], s["end"]).alias("to"))
    hit = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), step, lambda a: a["n"].cast("long"))
    d = found.select(F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
                     "copies")
    return d.select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy", "copies")


def clean_documents(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents (all columns) that hold no benchmark window."""
    bad = hits(docs, bench, id_col, text_col, **options).filter(F.size("spans") > 0).select("id", "text_hash")
    bad = written(bad, "decontam-hits").alias("bad")
    return docs.alias("d").join(bad, F.col(f"d.{id_col}").eqNullSafe(F.col("bad.id"))
                                & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("bad.text_hash")), "left_anti")


_SQL_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
with d as (select doc_id, coalesce({_SQL_WORDS.format(t='text')}, []) as w from documents),
b as (select item_id, {_SQL_WORDS.format(t='text')} as w from benchmark),
win as (select distinct item_id, least(len(w), {WINDOW}) as n, array_to_string(w[i:i + {WINDOW} - 1], ' ') as x
        from (select item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from win),
pos as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as x
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hit as (select doc_id, i, pos.n, item_id from pos join win on pos.x = win.x and pos.n = win.n),
word as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from hit) group by doc_id),
item as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
         from (select distinct doc_id, item_id::varchar as s from hit) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join word using (doc_id) left join item using (doc_id)
"""

"""Merkle manifest of a dataset by checkpoint and recomputation.

Every row is a leaf: the SHA-256 of its fields, each written as byte length, colon and value. Within a
group (the language) the leaves ascend by id, and every ``FAN`` consecutive nodes become one until one is left, the group's
subroot; the subroots, in order of the group's name, give the root in the same way.

Only every ``STEP``-th level is persisted. An aligned subtree of FAN ** STEP stored nodes fits one row, so building the next
stored level is a grouping by (group, position div FAN ** STEP). A proof is drawn from the top down: each
aligned subtree regenerates its missing interior levels from its stored nodes, gives every node its siblings on these
levels after those of the levels above, and forgets them. No step orders a group in one task: rows are range-partitioned and
numbered by partition offsets, so a group that holds most of the rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import crc_mod, written

FAN = 8
STEP = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 3


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields: '-' for null, else UTF-8 length, ':' and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in fields]
    return digest(F.concat(*parts))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with ``pos`` (0, 1, ... within each ``grp``) and ``total`` (rows of the group), written.

    Rows go to tasks by ranges of (grp, *order, _row), where _row is a written number, so also rows that tie on the order
    are spread and a repeated task gives the same numbers. Each task numbers its sorted rows; only one count per
    (task, group) is gathered.
    """
    keys = ["grp", *order, "_row"]
    nodes = written(nodes.withColumn("_row", F.monotonically_increasing_id()), name)
    ranged = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.spark_partition_id())
    ranged = written(ranged, name)
    parts = ranged.groupBy("grp", "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("grp").orderBy("_task")  # one row a task
    parts = parts.select("grp", "_task", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"),
                         F.sum("_n").over(Window.partitionBy("grp")).alias("total"))
    return ranged.join(parts, ["grp", "_task"]).withColumn("pos", F.col("_at") + F.col("_shift")) \
        .drop("_row", "_at", "_task", "_shift")


def _up(nodes: Column) -> Column:
    """The next level of an aligned run of nodes."""
    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(nodes) / FAN).cast("int") - 1),
                       lambda i: digest(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), "")))


def _width(level: int) -> int:
    return FAN ** level


def _subtrees(stored: DataFrame, base: int) -> DataFrame:
    """Aligned subtrees of a stored level with their regenerated levels: (grp, sub, total, rows, l0 .. l<STEP>).

    ``base`` is the stored level. A level stays as it is where the group has only one node on it.
    """
    rows = F.sort_array(F.collect_list(F.struct("pos", *[c for c in stored.columns if c not in ("grp", "pos", "total")])))
    out = stored.groupBy("grp", F.expr(f"pos div {_width(STEP)}").alias("sub")).agg(F.first("total").alias("total"), rows.alias("rows"))
    out = out.withColumn("l0", F.col("rows.node"))
    for i in range(STEP):
        out = out.withColumn(f"l{i + 1}", F.when(F.col("total") > _width(base + i), _up(F.col(f"l{i}"))).otherwise(F.col(f"l{i}")))
    return out


def build(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Stored levels 0, STEP, 2 STEP, ... of numbered leaves (grp, pos, total, node, ...); the last holds one node a group."""
    levels = [leaves]
    widest = leaves.agg(F.max("total")).first()[0] or 0
    while widest > _width(STEP * (len(levels) - 1)):
        top = _subtrees(levels[-1], STEP * (len(levels) - 1))
        levels.append(written(top.select("grp", F.col("sub").alias("pos"), "total", F.col(f"l{STEP}")[0].alias("node")), name))
    return levels


def _no_proof() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def _path(base: int, at: Column) -> Column:
    """Siblings left and right of the node at index ``at`` of its subtree, one entry a level that has several nodes."""
    entries = []
    for i in range(STEP):
        here = F.floor(at / _width(i)).cast("int")
        run = F.floor(here / FAN).cast("int") * FAN
        level = F.col(f"l{i}")
        entries.append(F.when(F.col("total") > _width(base + i), F.array(F.struct(
            F.array_join(F.slice(level, run + 1, here - run), "").alias("left"),
            F.array_join(F.slice(level, here + 2, run + (FAN - 1) - here), "").alias("right")))).otherwise(_no_proof()))
    return F.concat(*entries)


def proofs(levels: list[DataFrame], above: DataFrame, finish) -> DataFrame:
    """Results of all leaves, top-down: ``finish(row, proof)`` makes a leaf's result from its row and its whole proof.

    ``above`` has one row a group: grp, proof (of its subroot) and columns that ``finish`` may use. A subtree's regenerated
    nodes live only in its row; what is handed down is one proof a stored node, and the leaves' proofs are used up in
    ``finish``, never written.
    """
    more = [c for c in above.columns if c not in ("grp", "proof")]
    up = levels[-1].select("grp", F.col("pos").alias("sub")).join(above, "grp")
    if len(levels) == 1:  # no group has two leaves
        leaves = levels[0].withColumnRenamed("pos", "sub")
        row = F.struct(*[c for c in leaves.columns if c not in ("grp", "total")])
        return leaves.join(up, ["grp", "sub"]).select(finish(row, F.col("proof")).alias("_o")).select("_o.*")
    for i in reversed(range(len(levels) - 1)):
        def paths(row):
            return F.struct(row.alias("row"), F.concat(_path(i * STEP, row["pos"] % _width(STEP)), F.col("proof")).alias("proof"))
        tree = _subtrees(levels[i], i * STEP).join(up, ["grp", "sub"])
        each = F.transform("rows", paths)
        if i == 0:
            return tree.select(F.explode(F.transform(each, lambda x: finish(x["row"], x["proof"]))).alias("_o")).select("_o.*")
        up = tree.select("grp", *more, F.explode(each).alias("_o")) \
            .select("grp", F.col("_o.row.pos").alias("sub"), "_o.proof", *more)


def fold(node: Column, proof: Column) -> Column:
    """The root that a node and its proof give."""
    return F.aggregate(proof, node, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))


def siblings(proof: Column) -> Column:
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def subroots(levels: list[DataFrame]) -> DataFrame:
    """Per group: grp, subroot, root and the subroot's proof up to the root."""
    tops = levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    upper = build(numbered(tops, ["name"], "merkle-groups"), "merkle-group-level")
    none = upper[-1].select("grp", _no_proof().alias("proof"))
    return proofs(upper, none, lambda row, proof: F.struct(
        row["name"].alias("grp"), row["node"].alias("subroot"), fold(row["node"], proof).alias("root"), proof.alias("proof")))


def manifest(docs: DataFrame, group_col: str = "lang", id_col: str = "doc_id", fields: tuple = FIELDS,
             text_col: str = "text", tamper: int = TAMPER) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows whose crc32 of the decimal id is divisible by ``tamper`` are folded from the leaf of their text with A-Z
    lower-cased; all others from their own leaf. ``verified`` tells whether that gives the root.

    A null field counts as '-', which no other value gives, and an empty one as '0:'. Null ids come first in their group and
    are never tampered with; the null group comes before all others. Rows with equal ids are ordered by leaf; rows with equal
    leaves are equal in all fields, so any order of them gives the same tree. Texts of any length are hashed where they
    are read and never shuffled. An empty table gives an empty result; other columns are not read.
    """
    changed = leaf([lower_ascii(F.col(c)) if c == text_col else F.col(c) for c in fields])
    hit = F.col(id_col).isNotNull() & (crc_mod(F.col(id_col), tamper) == 0)
    name = F.col(group_col).cast("string")
    leaves = docs.select(F.coalesce(F.concat(F.lit("1"), name), F.lit("0")).alias("grp"), F.col(id_col).cast("long").alias("doc_id"),
                         leaf([F.col(c) for c in fields]).alias("node"), F.when(hit, changed).alias("tampered"))
    levels = build(numbered(leaves, ["doc_id", "node"], "merkle-leaves"), "merkle-level")
    return proofs(levels, written(subroots(levels), "merkle-subroots"), lambda row, proof: F.struct(
        row["doc_id"].alias("doc_id"), row["node"].alias("leaf"), F.col("subroot").alias("subroot"), F.col("root").alias("root"),
        digest(siblings(proof)).alias("proof_sha256"),
        fold(F.coalesce(row["tampered"], row["node"]), proof).alias("folded_root"))) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(depth: int = 9) -> str:
    """The manifest in SQL: crc32 bit by bit, every level of both trees (FAN ** depth leaves a group), all proofs and folds."""
    def field(e):
        return f"coalesce(strlen({e}::varchar)::varchar || ':' || {e}::varchar, '-')"

    def hashed(text):
        return "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"

    def trees(t, first, depth):  # a node's run without itself is l and r; single nodes stay
        yield f"""{t}0 as ({first})"""
        for i in range(depth):
            run = f"partition by grp, pos // {FAN} order by pos rows between"
            yield f"""{t}p{i} as (select *, coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l,
  coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r from {t}{i} where n > 1)"""
            yield f"""{t}{i + 1} as (select grp, pos // {FAN} as pos, (max(n) + {FAN - 1}) // {FAN} as n, sha256(string_agg(h, '' order by pos)) as h
  from {t}{i} where n > 1 group by grp, pos // {FAN} union all select * from {t}{i} where n <= 1)"""

    def folds(f, t, first, depth):
        yield f"""{f}0 as ({first})"""
        for i in range(depth):
            yield f"""{f}{i + 1} as (select f.* replace (f.proof || coalesce(l || r, '') as proof, case when l is null then x else sha256(l || x || r) end as x)
  from {f}{i} f left join {t}p{i} t on t.grp = f.grp and t.pos = f.pos // {FAN ** i})"""

    bit = "xor(p >> 1, (p & 1) * 3988292384)"
    crc = ("xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), "
           f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: {bit})), 4294967295)")
    top = f"{hashed('text')} as h"
    bad = f"case when {crc} % {TAMPER} = 0 then {hashed(_LOWER_SQL)} else {hashed('text')} end as x"
    parts = [f"doc as (select doc_id, coalesce('1' || lang, '0') as grp, {top}, {bad} from documents)",
             "leaf as (select *, row_number() over (partition by grp order by doc_id nulls first, h) - 1 as pos, count(*) over (partition by grp) as n from doc)",
             *trees("t", "select grp, pos, n, h from leaf", depth),
             f"name as (select '' as grp, row_number() over (order by grp) - 1 as pos, count(*) over () as n, h, grp as own from t{depth})",
             *trees("u", "select grp, pos, n, h from name", 4),
             *folds("f", "t", "select doc_id, grp as own, grp, pos, h, x, '' as proof from leaf", depth),
             *folds("g", "u", f"select f.* replace (n.grp as grp, n.pos as pos), n.h as subroot from f{depth} f join name n using (own)", 4)]
    return "with " + ",\n".join(parts) + """
select doc_id, g.h as leaf, subroot, u.h as root, sha256(proof) as proof_sha256, x as folded_root, x = u.h as verified from g4 g cross join u4 u
"""


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = _oracle()

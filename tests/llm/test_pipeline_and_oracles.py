import math
import os
import subprocess
import sys

import duckdb
import pytest
from conftest import SF_SMALL
from llm_cases import awkward, base_counts, bench_hits, empty, near_classes, personal, words

import corpus_pipeline as P
from shelfcast.llm.queries import ORACLE, QUERIES
from shelfcast.session import scratch_dir

REPO = os.path.dirname(os.path.abspath(P.__file__))


def _norm(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.execute(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(d[0] for d in rel.description)
    at = [[d[0] for d in rel.description].index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in at) for r in rel.fetchall())
    assert sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect()) == want


def test_query_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output on the smallest tables."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in P.STAGES:
        path = scratch_dir(spark, f"test-stage-{name}")
        stage(spark, docs, SF_SMALL).write.mode("overwrite").parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs.collect(), after.collect(), docs.columns, after.columns)
        docs = after
    return out


def test_stage_order_and_columns(stages):
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "mask_pii", "mix"]
    for name, (_, _, before, after) in stages.items():
        assert before == after or name == "mix"


def test_quality_stage(stages):
    before, after, _, _ = stages["quality"]
    kept = {r.doc_id for r in after}
    for r in before:
        if base_counts(r.text)[5]:
            assert r.doc_id not in kept
    assert all(r in before for r in after) and len(kept) > 0.85 * len(before)


def test_near_dedup_stage(stages):
    before, after, _, _ = stages["near_dedup"]
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in near_classes([(r.doc_id, r.text) for r in before])})


def test_decontaminate_stage(spark, stages):
    before, after, _, _ = stages["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not bench_hits(r.text, items)[1])


def test_mask_stage(stages):
    before, after, _, _ = stages["mask_pii"]
    got = {r.doc_id: r for r in after}
    assert len(got) == len(before)
    for r in before:
        spans = [(int(a), int(b)) for _, a, b in (s.split(":") for s in personal(r.text))]
        if not spans:
            assert got[r.doc_id].text == r.text
        for a, b in spans:
            assert r.text[a:b] not in got[r.doc_id].text
        assert got[r.doc_id].n_chars == len(got[r.doc_id].text)


def test_mix_stage(stages):
    before, after, _, _ = stages["mix"]
    size = {}
    for r in before:
        size[r.source] = size.get(r.source, 0) + len(words(r.text))
    texts = {r.doc_id: r.text for r in before}
    for s in size:
        mine = [r for r in after if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(len(words(r.text)) for r in before if r.source == s) / 2 + 1e-6
    assert all(r.text == texts[r.doc_id] and r.copies > 0 for r in after)


def test_run_and_awkward_rows(spark):
    assert P.run(spark, SF_SMALL).count() > 0
    for name, stage in P.STAGES:
        for docs in (awkward(spark), empty(spark)):
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns or name == "mix"
            out.count()
            for c in ("kept", "pii", "digest", "size"):  # columns named like an operator's own come through
                if c in docs.columns and name != "mix":
                    assert {r[c] for r in out.select(c).collect()} <= {"z"}


def test_entry_without_the_subpackage(tmp_path):
    """The rest of the queries are there when this subpackage and the pipeline are deleted."""
    import shutil
    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'promo_lift' in q and not [n for n in q if n.startswith('op1_') or n == 'pipeline']; e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, env=env, timeout=120)
    assert done.returncode == 0, done.stderr[-800:]

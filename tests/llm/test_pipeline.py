"""The pipeline against its parts, and the registered queries' shapes."""

import os
import shutil

import corpus_pipeline
from cartpulse.llm import decontamination, minhash_dedup
from cartpulse.llm.common import read, saved
from cartpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    ids = [{r.doc_id for r in docs.select("doc_id").collect()}]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(spark, stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        tables.append(docs)
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert ids[-1] <= ids[-2]
    # each decision against the operator's own result on the stage's input
    toxic = {r.doc_id for r in QUERIES["op5_toxicity"](spark, SF).collect() if r.predicted}
    assert ids[1] == ids[0] - toxic
    kept = {r.doc_id for r in minhash_dedup.near_duplicates(spark, tables[1]).collect() if r.kept}
    assert ids[2] == kept
    hit = {r.doc_id for r in decontamination.contaminated(
        spark, tables[2], read(spark, SF, "benchmark")).collect()}
    assert ids[3] == ids[2] - hit
    assert ids[4] == ids[3]
    last = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in last} == ids[4]


def test_entry_without_the_subpackage(tmp_path):
    """The entry module imports and serves the other queries without llm."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in ("cartpulse", "__spark_entry__.py"):
        src, dst = os.path.join(root, name), tmp_path / name
        if os.path.isdir(src):
            shutil.copytree(src, dst, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, dst)
    code = ("import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q; "
            "assert not [k for k in q if k.startswith('op')]; assert q and e.oracle_sql()")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)

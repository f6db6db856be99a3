import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shelfwise.llm import decontaminate, mixing, neardup, pii, queries, quality
from tools.check_queries import compare, connect


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, sf_dir, name):
    rows = entry.queries()[name](spark, sf_dir)
    sql = queries.oracle_sql().get(name)
    if sql:
        assert compare(rows, connect(sf_dir), sql) == ""
    elif name.startswith("op11_"):
        assert rows.count() == 4 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    elif not name.startswith(("op3_", "op7_")):  # these may find nothing in so few rows
        table = spark.read.parquet(f"{sf_dir}/documents.parquet")
        assert rows.count() == table.count()


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "pii", "mixing"]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], sf_dir)
        kept.append(neardup.materialize(out, name))
        if name != "mixing":
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    _, good, first, clean, masked, mixed = kept
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = corpus_pipeline.quality_model(docs, labels)
    scores = quality.score_quality(docs, model).where(f"quality_score >= {model.cut}")
    assert ids(good) == ids(scores)
    classes = neardup.near_duplicates(good)
    assert ids(first) == ids(classes.where("doc_id = class_id"))
    held = decontaminate.find_contamination(first, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert ids(clean) == ids(first) - ids(held)
    assert ids(masked) == ids(clean)
    for r in masked.collect():
        assert not pii.base_spans(r.text or "")
    before = {r.doc_id: r for r in clean.collect()}
    assert all(r == before[r.doc_id] or "<" in r.text and r.n_chars == len(r.text) for r in masked.collect())
    again = mixing.mix_sources(masked).toPandas().sort_values("doc_id").values.tolist()
    assert mixed.toPandas().sort_values("doc_id").values.tolist() == again
    assert corpus_pipeline.run(spark, sf_dir).count() == mixed.count()


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_the_rest_works_without_the_subpackage(tmp_path):
    import subprocess
    import sys
    root = os.path.dirname(entry.__file__)
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "shelfwise", ".git"):
            os.symlink(os.path.join(root, name), tmp_path / name)
    os.mkdir(tmp_path / "shelfwise")
    for name in os.listdir(os.path.join(root, "shelfwise")):
        if name != "llm":
            os.symlink(os.path.join(root, "shelfwise", name), tmp_path / "shelfwise" / name)
    code = "import __spark_entry__ as e; assert 'clean_products' in e.queries() and 'op6_exact_topk' not in e.queries()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)},
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr

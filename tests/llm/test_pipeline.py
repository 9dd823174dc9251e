"""The stages of the pipeline, one by one, against plain Python."""

import os
import subprocess
import sys

from __spark_entry__ import queries
from clickstrata.llm import mixing, secrets, toxicity
from clickstrata.llm.queries import toxicity_model
from corpus_pipeline import STAGES, run

from .test_sets import classes, contaminated

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = "/root/testdata/sf0.001"


def test_names():
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in queries()}
    assert "pipeline" in queries()


def test_the_pipeline_loads_its_own_operators_only():
    code = "import sys, corpus_pipeline; print({'tokenizers', 'pyspark.ml'} & set(sys.modules))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "set()"


def test_each_stage(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, columns = documents, documents.columns
    results = []
    for _, stage in STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
        results.append((before, {r.doc_id: r for r in docs.collect()}))
    toxic, similar, leaked, secret, mixed = results

    model = toxicity_model(spark, SF_DIR)
    scores = {i: model.score(toxicity.lower_words(r.text)) for i, r in toxic[0].items()}
    assert set(toxic[1]) == {i for i, score in scores.items() if score < toxicity.THRESHOLD}

    rows = [(i, r.text) for i, r in similar[0].items()]
    assert set(similar[1]) == {i for i, _, component in classes(rows, 5, 80) if i == component}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hits = contaminated([(i, r.text) for i, r in leaked[0].items()], items)
    assert set(leaked[1]) == {i for i, _, n_hit, _ in hits if not n_hit}
    assert len(leaked[1]) < len(leaked[0])

    assert set(secret[1]) == set(secret[0])
    for i, row in secret[0].items():
        spans = secrets.find_secrets(row.text, secrets.scanner())
        text = secrets.redacted(row.text, spans, "[secret]")
        assert secret[1][i].text == text and (not spans or secret[1][i].n_chars == len(text))

    assert set(mixed[1]) == set(mixed[0])
    assert docs.columns == [*columns, *mixing.MIX_COLUMNS]
    found = run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.mix_slot, r.text) for r in found) == sorted(
        (r.doc_id, r.mix_slot, r.text) for r in mixed[1].values()
    )

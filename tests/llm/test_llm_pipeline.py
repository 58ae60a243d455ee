"""The pipeline's stages, one after the other, against plain Python."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from subtide.llm.queries import tokenizer_file
from subtide.llm.shared import written
from test_llm_quality import verdicts
from test_llm_scans import leaks
from texts import components, corpus, frame, prose, same, vocabulary, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng, known = random.Random(8), vocabulary()
    items = [(k, prose(rng, 25, known)) for k in range(6)]
    rows = corpus()
    for k in range(12):
        value = "".join(rng.choices("0123456789abcdef", k=40))
        rows.append((1000 + k, prose(rng, 60, known) + f' token = "{value}" ' + prose(rng, 20, known), "xx", "src1", None))
        rows.append((2000 + k, prose(rng, 60, known) + " " + "".join(rng.choices("0123456789", k=16)) + " " + prose(rng, 20, known), "xx", "src1", None))
        rows.append((3000 + k, prose(rng, 30, known) + " " + items[k % 6][1] + "\n" + prose(rng, 30, known), "xx", "src2", None))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, path), f"test-{name}")
        steps.append(docs)
    quality, unique, clean, redacted, packed = steps
    for step in steps[:-1]:
        assert step.columns == COLUMNS
    # 1: kept documents, without their boilerplate lines.
    wanted = verdicts(rows, 20, 0.001, 0.2)
    same([r["doc_id"] for r in quality.collect()], [v[0] for v in wanted if v[-1]])
    # 2: one of each component.
    kept = [tuple(r) for r in quality.collect()]
    groups = components(kept, 5, 80)
    same([r["doc_id"] for r in unique.collect()], [d for d, _ in {(r[0], r[1]) for k, r in enumerate(kept) if not groups[k][0] or groups[k][1] == r[0]}])
    # 3: no passages of the benchmark.
    before = [tuple(r) for r in unique.collect()]
    gone = {k for k, _ in leaks([r[1] for r in before if len(r[1]) < 20_000], items)}
    short = [r for r in before if len(r[1]) < 20_000]
    assert len(gone) >= 12
    same([r["doc_id"] for r in clean.collect() if len(r["text"]) < 20_000], [r[0] for k, r in enumerate(short) if k not in gone])
    # 4: marks instead of secrets, and nothing else changed.
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in redacted.collect():
        if r["doc_id"] is not None and 1000 <= r["doc_id"] < 2000:
            assert "[SECRET]" in r["text"]
        else:
            assert r["text"] == texts[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
    # 5: every token of what is left, once.
    tokenizer = Tokenizer.from_file(tokenizer_file())
    pieces = packed.collect()
    total = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in redacted.collect()}
    lengths = {}
    for p in pieces:
        lengths[p["doc_id"]] = lengths.get(p["doc_id"], 0) + p["length"]
    assert lengths == total
    assert len(words(rows[0][1])) and np.all([p["length"] <= 4096 for p in pieces])


def test_run_gives_the_last_stage(spark, folder):
    path, *_ = folder
    out = corpus_pipeline.run(spark, path)
    assert out.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_tables_pass_through(spark, folder):
    path, *_ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.count() == 0


def test_other_columns_come_through(spark, folder):
    """Columns called like the operators' own names, and one with a dot, stay as they are."""
    path, rows, _ = folder
    docs = frame(spark, rows[:80])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
    assert docs.columns == frame(spark, rows[:2]).columns
    found = docs.collect()
    assert found and all(set(r[5:]) == {"clash"} for r in found)

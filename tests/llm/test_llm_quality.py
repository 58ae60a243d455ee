"""Quality rules and the ranking classifier."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_check import connect, oracle_result, spark_result, type_differences
from subtide.llm.line_quality import quality_verdicts, without_lines, without_low_quality
from subtide.llm.quality_ranking import THRESHOLD, fit_ranking, held_out, quality_scores
from subtide.llm.queries import ORACLES, QUERIES
from texts import SCHEMA, WORD, corpus, frame, prose, same, vocabulary, words


def verdicts(rows, min_documents, min_share, min_left):
    hosts, having = Counter(host for host, _ in {(r[3], r[1] or "") for r in rows}), defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if words(line):
                having[r[3], " ".join(words(line))].add(r[1] or "")
    out = []
    for r in rows:
        text = r[1] or ""
        w = WORD.findall(text)
        lines = [line for line in text.split("\n") if words(line)]
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        count = Counter(windows)
        repeat = {k + j for k, x in enumerate(windows) if count[x] > 1 for j in range(5)}
        gone = 0
        for line in lines:
            texts = len(having.get((r[3], " ".join(words(line))), ()))
            gone += len(words(line)) * (texts > min_documents and texts > min_share * hosts[r[3]])
        failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.append((r[0], len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeat), gone, failed, not failed and len(w) - gone >= min_left * len(w)))
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize("limits", [(20, 0.001, 0.2), (3, 0.01, 0.6)])
def test_verdicts_match_brute_force(spark, rows, limits):
    got = quality_verdicts(frame(spark, rows).drop("host"), *limits).drop("host", "t1", "t2", "boilerplate")
    same([tuple(r) for r in got.collect()], verdicts(rows, *limits))


def test_rejected_rows_and_lines_go(spark, rows):
    wanted = verdicts(rows, 3, 0.01, 0.6)
    kept = without_low_quality(frame(spark, rows), min_documents=3, min_share=0.01, min_left=0.6)
    assert kept.columns == frame(spark, rows).columns
    kept = kept.collect()
    assert all(set(r[5:]) == {"clash"} for r in kept)
    same([r["doc_id"] for r in kept], [v[0] for v in wanted if v[-1]])
    gone = {v[0]: v[6] for v in wanted}
    before = {r[0]: len(words(r[1])) for r in rows}
    for r in kept:
        assert r["n_chars"] == len(r["text"])
        if r["doc_id"] is not None:
            assert len(words(r["text"])) == before[r["doc_id"]] - gone[r["doc_id"]]


def host_of_lines(line, texts, copies=0, host="h"):
    """Rows of one host: different texts with the line, without it, and copies of one text."""
    rng, known = random.Random(4), vocabulary(2000)
    rows = [(k, f"{prose(rng, 30, known)}\n{line}\n{prose(rng, 30, known)}" if k < texts else prose(rng, 40, known), "xx", host, None) for k in range(texts + 15)]
    return rows + [(1000 + k, prose(random.Random(9), 40, known), "xx", host, None) for k in range(copies)]


@pytest.mark.parametrize("n", [5, 30, 31, 40, 200])
def test_lines_of_every_length_go(spark, n):
    line = " ".join(f"Notice{k}" for k in range(n))
    rows = host_of_lines(line, 25)
    rows.append((500, "\n".join([line, "few other words stand here"]), "xx", "h", None))
    got = {r["doc_id"]: r for r in quality_verdicts(frame(spark, rows).drop("host")).collect()}
    assert [got[k]["n_boilerplate_words"] for k in range(40)] == [n] * 25 + [0] * 15
    assert got[500]["n_boilerplate_words"] == n and got[500]["kept"] == (n + 5 >= 10 and 5 >= 0.2 * (n + 5))
    left = without_low_quality(frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")).collect()
    assert len(left) == sum(r["kept"] for r in got.values())
    assert not any("Notice" in r["text"] for r in left)


def test_copies_of_other_texts_change_no_line(spark):
    alone = host_of_lines("We use cookies here.", 25)
    crowded = host_of_lines("We use cookies here.", 25, copies=200)
    docs = frame(spark, alone + [(*r[:3], "g", None) for r in crowded]).drop("host")
    # 25 of 40 texts are over a half, as are 25 of 41, but 25 of 240 rows are not.
    got = quality_verdicts(docs, 20, 0.5).where("n_boilerplate_words > 0").groupBy("host").count().collect()
    assert {r["host"]: r["count"] for r in got} == {"h": 25, "g": 25}


def test_query_counts_long_lines_and_distinct_texts(spark, tmp_path):
    """Through the registered query and its SQL: a notice of 40 words in 200 texts, and a host that copies of one text dominate."""
    notice = " ".join(f"Notice{k}" for k in range(40))
    rows = host_of_lines(notice, 200) + [(5000 + r[0], *r[1:3], "g", None) for r in host_of_lines("We use cookies here.", 25, copies=30_000)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op2_quality_rules"](spark, str(tmp_path))
    assert got.where("n_boilerplate_words = 40").count() == 200
    # 25 of 41 different texts, though 25 of 30,040 rows are under a thousandth.
    assert got.where("doc_id >= 5000 AND n_boilerplate_words > 0").count() == 25
    assert spark_result(got) == oracle_result(con, ORACLES["op2_quality_rules"])


def test_lines_are_cut_where_they_stand():
    from subtide.llm import batch
    import pyarrow as pa

    for _, data, offsets in batch.runs(pa.array(["Read  MORE here"])):
        found = batch.words(data, offsets)
        key = int(batch.span_hashes(batch.prefix_sums(found.hashes()), found.first[:-1], found.first[1:]).view(np.int64)[0])
    assert without_lines("a\nread more HERE\n\nb\n read more here \nread more", {key}) == "a\n\nb\nread more"


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_verdicts(empty).count() == 0
    assert without_low_quality(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_scores(empty, labels).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_rules_match_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    got = QUERIES["op2_quality_rules"](spark, sf_dir)
    assert spark_result(got) == oracle_result(connect(sf_dir), ORACLES["op2_quality_rules"])
    assert type_differences(connect(sf_dir), got, ORACLES["op2_quality_rules"]) == []


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    scores = QUERIES["op4_quality_classifier"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = scores.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert len(judged) > 500
    right = [r["quality"] == r["predicted"] for r in judged]
    assert sum(right) / len(right) > 0.97
    for label in (0, 1):
        own = [r["predicted"] == label for r in judged if r["quality"] == label]
        assert sum(own) / len(own) > 0.9


def test_held_out_labels_teach_nothing(spark, rows):
    docs = frame(spark, [r for r in rows if r[0] is not None])
    labels = spark.createDataFrame([(r[0], int(len(r[1] or "") > 200)) for r in rows if r[0] is not None], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one = sorted(map(tuple, quality_scores(docs, labels).collect()))
    other = sorted(map(tuple, quality_scores(docs, turned).collect()))
    assert one == other
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) and 0 <= r[2] <= 1 and r[3] == int(r[2] >= THRESHOLD) for r in one)


def test_hostile_rows_have_scores(spark, rows):
    labels = spark.createDataFrame([(r[0], k % 2) for k, r in enumerate(rows)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality_scores(frame(spark, rows), labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    one_sided = quality_scores(frame(spark, rows), labels.withColumn("quality", F.lit(1))).collect()
    assert {r["score"] for r in one_sided} == {0.5}


def test_pairs_order_the_good_first():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.1 * rng.normal(size=400) > 0.8).astype(int)
    ranking = fit_ranking(x, y, pairs=20_000, steps=150)
    score = ranking.score(x)
    assert ((score >= THRESHOLD) == (y == 1)).mean() > 0.95
    assert random.Random(0) and np.all((score >= 0) & (score <= 1))

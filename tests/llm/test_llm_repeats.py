"""Long repeats against a brute-force count of windows."""

import hashlib
import random
from collections import Counter

import pytest

from subtide.llm.queries import QUERIES
from subtide.llm.repeats import common_prefix, maximal_groups, maximal_repeats, prefix_intervals, repeated_spans
from texts import SCHEMA, corpus, frame, same


def covered(rows, least):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(t[s : s + least] for t in texts for s in range(len(t) - least + 1))
    out = []
    for row, t in zip(rows, texts, strict=True):
        hit = bytearray(len(t))
        for s in range(len(t) - least + 1):
            if count[t[s : s + least]] > 1:
                hit[s : s + least] = b"\1" * least
        kept = bytes(b for b, h in zip(t, hit, strict=True) if not h)
        spans = sum(1 for k in range(len(t)) if hit[k] and not (k and hit[k - 1]))
        out.append((row[0], len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize(("least", "gram", "bucket"), [(400, 96, 32768), (120, 30, 32768), (120, 30, 1)])
def test_spans_match_brute_force(spark, rows, least, gram, bucket):
    got = repeated_spans(frame(spark, rows), least, gram, bucket).drop("spans").collect()
    same([tuple(r) for r in got], covered(rows, least))


def test_no_rows(spark):
    assert repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_matches_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    same([tuple(r) for r in QUERIES["op1_suffix_array_dedup"](spark, sf_dir).collect()], covered(rows, 400))


def test_planted_passages_go_from_400_bytes_on(spark):
    """Columns tell what was removed: ``n_removed``. ``n_bytes`` is the length of the input, whatever is removed."""
    rng = random.Random(8)

    def words(size):
        text = ""
        while len(text) < size:
            text += "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) + " "
        return text[:size]

    passages = {k: words(size) for k, size in enumerate([340, 399, 400, 401, 700, 3_000])}
    assert all(len(p.split()) > 50 for p in passages.values())
    rows = [(10 * k + copy, f"{words(900)}{copy}{p}{copy}{words(900)}", None, None, None) for k, p in passages.items() for copy in range(3)]
    rows += [(1_000 + k, words(2_000), None, None, None) for k in range(10)]
    found = {r["doc_id"]: r for r in repeated_spans(frame(spark, rows)).collect()}
    for doc_id, text, *_ in rows:
        planted = len(passages[doc_id // 10]) if doc_id < 1_000 else 0
        removed = found[doc_id]["n_removed"]
        assert found[doc_id]["n_bytes"] == len(text)
        assert removed == (planted if planted >= 400 else 0)


def test_groups_hold_all_occurrences(spark):
    rng = random.Random(2)
    shared = "".join(rng.choices("abcdefgh", k=150))
    texts = ["".join(rng.choices("abcdefgh", k=60)) + shared + "".join(rng.choices("abcdefgh", k=60)) for _ in range(5)]
    frame_ = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], SCHEMA)
    sizes = {(r["length"], r["classes"]) for r in maximal_repeats(frame_, 120, 30).groupBy("group", "length").agg({"*": "count"}).withColumnRenamed("count(1)", "classes").collect()}
    # Context ends cut a repeat, so its longest group lies between the least length and the shared string's.
    assert all(120 <= length <= 152 for length, _ in sizes)
    assert any(classes == 5 for _, classes in sizes)


def test_intervals_of_a_known_array():
    # Suffixes of "banana" in order: a, ana, anana, banana, na, nana.
    assert sorted(prefix_intervals([0, 1, 3, 0, 0, 2], 1)) == [(1, 0, 2), (2, 4, 5), (3, 1, 2)]


def test_groups_match_all_pairs():
    rng = random.Random(4)
    for _ in range(200):
        contexts = sorted({("".join(rng.choices("ab", k=rng.randint(0, 6))) + "X" + "".join(rng.choices("ab", k=rng.randint(0, 6)))).encode() for _ in range(rng.randint(2, 7))})
        placed = [(c, c.index(b"X")) for c in contexts]
        least = rng.randint(2, 6)
        reach: dict = {}
        for a, (one, i) in enumerate(placed):
            for b, (other, j) in enumerate(placed):
                before = common_prefix(one[:i][::-1], other[:j][::-1])
                after = common_prefix(one[i:], other[j:])
                if a != b and before + after >= least:
                    reach.setdefault(a, set()).update(range(i - before, i + after))
        found: dict = {}
        groups = maximal_groups(placed, least)
        for before, after, members in groups:
            texts = {placed[k][0][placed[k][1] - before : placed[k][1] + after] for k in members}
            assert len(texts) == 1
            # Maximal: no byte more on either side is common to all, and everyone who has the string is in.
            text = texts.pop()
            assert members == [k for k, (c, at) in enumerate(placed) if at >= before and c[at - before : at + after] == text]
            assert len({placed[k][0][placed[k][1] - before - 1 : placed[k][1] - before] for k in members}) > 1 or any(placed[k][1] == before for k in members)
            for k in members:
                found.setdefault(k, set()).update(range(placed[k][1] - before, placed[k][1] + after))
        assert found == reach


def test_slices_of_long_texts_keep_every_window(monkeypatch):
    import numpy as np

    from subtide.llm import repeats

    rng = np.random.default_rng(6)
    data = rng.integers(97, 101, 9000).astype(np.uint8)
    data[3000:4500] = 97  # the same byte: the first of equal hashes is the anchor
    offsets = np.array([0, 40, 6200, 6200, 9000])
    least, gram = 60, 16

    def anchors(runs):
        return {w: int(p) for a, b, p in zip(runs.first.tolist(), runs.end.tolist(), runs.place.tolist(), strict=True) for w in range(a, b - least + 1)}

    whole = anchors(repeats.Runs(data, offsets, least, gram))
    assert set(whole) == {w for a, b in zip(offsets, offsets[1:]) for w in range(a, b - least + 1)}
    monkeypatch.setattr(repeats, "_SLICE", 700)
    assert anchors(repeats.Runs(data, offsets, least, gram)) == whole

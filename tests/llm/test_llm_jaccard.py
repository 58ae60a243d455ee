"""The Jaccard join against all pairs."""

import numpy as np
import pytest

from subtide.llm.jaccard_join import Prefixes, _sliced, components, jaccard_components, linked_stars, without_near_copies
from subtide.llm.queries import QUERIES
from texts import SCHEMA, components as all_pairs, corpus, frame, same


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize(("n", "percent", "crowd", "bits"), [(3, 90, 4096, 18), (3, 90, 3, 6), (2, 60, 5, 12), (1, 50, 4096, 12)])
def test_components_match_all_pairs(spark, rows, n, percent, crowd, bits):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, rows), n, percent, crowd, bits).collect()]
    wanted = all_pairs(rows, n, percent)
    same(got, [(rows[k][0], *wanted[k]) if wanted[k][0] else (rows[k][0], 0, rows[k][0]) for k in range(len(rows))])


def test_many_near_copies(spark):
    import random

    rng = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(150):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5])):
            own[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        rows.append((k, " ".join(own), None, f"src{k % 2}", None))
    wanted = all_pairs(rows)
    for crowd in (4096, 40):
        got = [(r["doc_id"], r["component_id"]) for r in jaccard_components(frame(spark, rows), crowd=crowd).collect()]
        same(got, [(rows[k][0], wanted[k][1]) for k in range(len(rows))])


def test_query_matches_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    wanted = all_pairs(rows)
    got = [tuple(r) for r in QUERIES["op3_jaccard_join"](spark, sf_dir).select("doc_id", "n_shingles", "component_id").collect()]
    same(got, [(rows[k][0], *wanted[k]) if wanted[k][0] else (rows[k][0], 0, rows[k][0]) for k in range(len(rows))])


def test_no_rows(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert without_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_document_of_each_group_stays(spark, rows):
    wanted = all_pairs(rows, 5, 80)
    kept = without_near_copies(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    found = kept.collect()
    assert all(set(r[5:]) == {"clash"} for r in found)
    got = [r["doc_id"] for r in found]
    expected = {(r[0], r[1]) for k, r in enumerate(rows) if not wanted[k][0] or wanted[k][1] == r[0]}
    same(got, [doc_id for doc_id, _ in expected])


def test_long_chains_settle(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 502)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "one long, other long")).collect()}
    assert found == {**{k: 0 for k in range(201)}, **{k: 500 for k in (500, 501, 502)}}


def test_extensions_lose_no_link():
    rng = np.random.default_rng(3)
    universe = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    sets = [np.sort(rng.choice(universe, rng.integers(1, 60), replace=False)) for _ in range(60)]
    sets += [np.sort(np.unique(np.concatenate([s[rng.random(len(s)) > 0.05], rng.choice(universe, 1)]))) for s in sets]
    sketch = rng.integers(0, 5000, 1 << 8)
    for percent in (50, 80, 90):
        edges = linked_stars(sets, Prefixes(sketch, percent))
        root = list(range(len(sets)))

        def find(a, root=root):
            while root[a] != a:
                a = root[a]
            return a

        for a, b in edges:
            root[find(a)] = find(b)
        for a in range(len(sets)):
            for b in range(a):
                shared = len(np.intersect1d(sets[a], sets[b]))
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    assert find(a) == find(b)


def test_bit_tables_hold_their_keys(spark):
    from subtide.llm.bits import holds, key_bits

    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, 5000)
    table = key_bits(spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "key long"), "key")
    assert holds(table, keys).all()
    assert holds(table, rng.integers(-(2**63), 2**63 - 1, 5000)).mean() < 0.01
    assert not key_bits(spark.createDataFrame([], "key long"), "key").any()


def test_extensions_grow_with_the_set():
    prefixes = Prefixes(np.zeros(1 << 6, np.int64), 90)
    sizes = range(1, 5000)
    extensions = [prefixes.extension(s) for s in sizes]
    assert extensions == sorted(extensions)
    assert all(prefixes.matches(s) <= 1 + min(prefixes.extension(t) for t in (prefixes.need(s), s)) for s in sizes)


def test_places_are_cut_by_shingles_too(spark, rows):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, rows), crowd_shingles=300).collect()]
    wanted = all_pairs(rows)
    same(got, [(rows[k][0], *wanted[k]) if wanted[k][0] else (rows[k][0], 0, rows[k][0]) for k in range(len(rows))])
    # 200 texts of a megabyte at one place, two short ones at another, one alone.
    large = spark.range(200).selectExpr("7L AS leader", "id AS key", "170000L AS high")
    small = spark.createDataFrame([(8, 1000, 40), (8, 1001, 50), (9, 1002, 170_000_000)], "leader long, key long, high long")
    cut = _sliced(large.unionByName(small), 4096, 4_000_000).collect()
    assert {(r["leader"], r["slices"]) for r in cut} == {(7, 9), (8, 1)}
    shingles = [sum(r["high"] for r in cut if r["leader"] == 7 and r["slice"] == k) for k in range(9)]
    assert sum(shingles) == 200 * 170_000 and max(shingles) < 8_000_000
    # No more slices than classes, however long the texts are.
    pair = spark.createDataFrame([(1, 5, 10**9), (1, 6, 10**9)], "leader long, key long, high long")
    assert {r["slices"] for r in _sliced(pair, 4096, 4_000_000).collect()} == {2}

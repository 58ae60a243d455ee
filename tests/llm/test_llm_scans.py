"""Secret scan, benchmark decontamination and licence scan."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from subtide.llm import batch
from subtide.llm.decontamination import BLOCKS, RADIUS, BlockIndex, Items, Rarity, benchmark_matches, distances, without_benchmark
from subtide.llm.licenses import license_scan
from subtide.llm.queries import QUERIES
from subtide.llm.secrets import FEATURES, Forest, fit_forest, scored_candidates, secret_scan, trigram_dictionary, weak_findings, without_secrets
from texts import SCHEMA, corpus, frame, lowered, prose, same, vocabulary

PLAIN = re.compile("[0-9a-z\x80-\U0010ffff]+")


@pytest.fixture(scope="module")
def rows():
    return corpus()


def leaks(docs, items, least=0.8):
    """(doc index, item id) of windows of the item's size, by comparing every window."""

    def grams(w, n):
        return [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]

    worded = [(i, PLAIN.findall(lowered(t))) for i, t in items]
    count = Counter(g for _, w in worded if w for g in set(grams(w, min(5, len(w)))))
    n_items = max(1, len(items))
    weight = lambda g: math.log(1 + n_items / count[g]) if g in count else math.log(1 + n_items)
    out = set()
    for d, text in enumerate(docs):
        w = PLAIN.findall(lowered(text))
        for item, own in worded:
            if not own:
                continue
            n = min(5, len(own))
            a = Counter(grams(own, n))
            for s in range(len(w) - len(own) + 1):
                b = Counter(grams(w[s : s + len(own)], n))
                shared = sum(min(k, a[g]) * weight(g) for g, k in b.items())
                total = sum(k * weight(g) for g, k in (a + b).items()) - shared
                if shared >= least * total - 1e-9:
                    out.add((d, item))
    return out


@pytest.mark.parametrize("block_chars", [4_000_000, 300])
def test_leaks_match_brute_force(spark, rows, block_chars):
    rng, known = random.Random(3), vocabulary()
    items = [(k, prose(rng, rng.randint(1, 50), known)) for k in range(25)] + [(90, None), (91, ""), (92, "tick tick tick tick tick tick"), (93, "Two. words")]
    texts = [r[1] for r in rows if r[1] and len(r[1]) < 20_000][:60] + ["two words", "TWO, (words)!", None, ""]
    for k in range(40):
        own = items[rng.randrange(25)][1].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            own[rng.randrange(len(own))] = rng.choice(known)
        texts.append(prose(rng, rng.randint(0, 40), known) + " " + " ".join(own).upper() + "\n" + prose(rng, rng.randint(0, 30), known))
    docs = [(k, t, None, None, None) for k, t in enumerate(texts)]
    found = benchmark_matches(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars).collect()
    if block_chars == 4_000_000:
        assert {(r["doc_id"], r["item_id"]) for r in found} == leaks(texts, items)
        kept = without_benchmark(frame(spark, docs).select("doc_id", "text", "n"), spark.createDataFrame(items, "item_id long, text string")).collect()
        same([r["doc_id"] for r in kept], sorted(set(range(len(texts))) - {d for d, _ in leaks(texts, items)}))
    else:  # rarity is counted within a block, so only exact passages must agree
        exact = {(d, i) for d, i in leaks(texts, items, 1.0)}
        assert exact <= {(r["doc_id"], r["item_id"]) for r in found}
    for r in found:
        window = PLAIN.findall(lowered(texts[r["doc_id"]]))[r["start_word"] : r["start_word"] + r["n_words"]]
        assert len(window) == len(PLAIN.findall(lowered(dict(items)[r["item_id"]])))


def short_leaks(docs, items, least=0.8):
    """As ``leaks``, and items whose words outnumber the text's against the whole text."""
    out = leaks(docs, items, least)
    worded = [(i, PLAIN.findall(lowered(t))) for i, t in items]
    grams = lambda w, n: [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
    count = Counter(g for _, w in worded if w for g in set(grams(w, min(5, len(w)))))
    weight = lambda g: math.log(1 + len(items) / count.get(g, 1))
    for d, text in enumerate(docs):
        w = PLAIN.findall(lowered(text))
        for item, own in worded:
            if len(w) < len(own):
                a, b = Counter(grams(own, min(5, len(own)))), Counter(grams(w, min(5, len(own))))
                shared = sum((a & b)[g] * weight(g) for g in a)
                if shared and shared >= least * sum(k * weight(g) for g, k in (a | b).items()) - 1e-9:
                    out.add((d, item))
    return out


def test_texts_shorter_than_the_item(spark):
    rng, known = random.Random(12), vocabulary(2000)
    items = [(k, prose(rng, size, known)) for k, size in enumerate([2, 4, 5, 6, 9, 25, 25, 60])]
    texts = [None, "", "two words"]
    for _, item in items:
        own = item.split()
        texts += [" ".join(own[: len(own) - cut]) for cut in (1, 2, 5, 12)] + [" ".join(own[cut:]) for cut in (1, 3)] + [" ".join(own[:-1]) + " end of it"]
    wanted = short_leaks(texts, items)
    assert len(wanted) > len(leaks(texts, items))
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = benchmark_matches(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == wanted
    sizes = {i: len(PLAIN.findall(lowered(t))) for i, t in items}
    for r in found:
        n = len(PLAIN.findall(lowered(texts[r["doc_id"]])))
        assert r["n_words"] == min(n, sizes[r["item_id"]]) and r["start_word"] + r["n_words"] <= n
    kept = {r["doc_id"] for r in without_benchmark(docs.select("doc_id", "text"), benchmark).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in wanted}


def test_blocks_change_no_result(spark):
    rng, known = random.Random(21), vocabulary(2000)
    common = [prose(rng, 12, known) for _ in range(4)]
    items = [(k, f"{prose(rng, rng.randint(3, 25), known)} {rng.choice(common)} {prose(rng, rng.randint(0, 8), known)}") for k in range(30)] + [(90, None), (91, "a b c")]
    texts = ["a b c"]
    for k in range(120):
        own = items[k % 30][1].split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            own[rng.randrange(len(own))] = rng.choice(known)
        texts.append(" ".join([rng.choice(common), *own[rng.choice([0, 0, 1, 3]) :], rng.choice(common)]))
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = benchmark_matches(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in whole} == short_leaks(texts, items)
    assert any(0.8 <= r["similarity"] < 0.9 for r in whole)
    for block_chars in (2000, 700):
        same([tuple(r) for r in benchmark_matches(docs, benchmark, block_chars=block_chars).collect()], [tuple(r) for r in whole])


def test_blocks_reach_every_fingerprint_in_the_radius():
    rng = np.random.default_rng(1)
    for radius in (0, 5, BLOCKS - 1, BLOCKS, 2 * BLOCKS + 3, 3 * BLOCKS - 1, RADIUS):
        items = rng.integers(0, 1 << 16, (60, BLOCKS)).astype(np.uint16)
        probes = items[rng.integers(0, 60, 400)].copy()
        for row in probes:
            bits = np.unpackbits(row.view(np.uint8))
            bits[rng.choice(16 * BLOCKS, radius + int(rng.integers(-1, 2)) if radius else 0, replace=False)] ^= 1
            row[:] = np.packbits(bits).view(np.uint16)
        wanted = {(a, b, int(d)) for a in range(400) for b, d in enumerate(distances(probes[a][None], items)) if d <= radius}
        assert len(wanted) > 100
        got = [x.tolist() for x in BlockIndex(items, radius).within(probes)]
        assert sorted(zip(*got, strict=True)) == sorted(wanted)
        # The worst case of the pigeonhole: bits spread evenly over the blocks.
        even = items.copy()
        for bit in range(radius):
            even[:, bit % BLOCKS] ^= np.uint16(1 << (bit // BLOCKS * 5 % 16))
        row, other, far = BlockIndex(items, radius).within(even)
        assert {(k, k) for k in range(60)} <= set(zip(row.tolist(), other.tolist(), strict=True)) and (far[row == other] == radius).all()


def test_few_windows_meet_an_item():
    rng, known = random.Random(5), vocabulary(3000)
    items = Items([(k, prose(rng, 40, known)) for k in range(300)], Rarity(np.zeros(0, np.uint64), np.zeros(0, np.int64), 300), RADIUS)
    others = Items([(k, prose(rng, 40, known)) for k in range(300)], Rarity(np.zeros(0, np.uint64), np.zeros(0, np.int64), 300), RADIUS)
    size = max(items.by_size, key=lambda n: len(items.by_size[n]))
    index, windows = items.index[size], others.index[size].prints
    pairs = len(windows) * len(index.prints)
    assert pairs > 10_000
    assert len(index.meeting(windows)) < 0.25 * pairs
    assert len(index.within(windows)[0]) == 0


def test_similar_passages_are_within_the_radius(spark):
    """Of all pairs at a weighted similarity of 0.8 or more, those that fingerprints find."""
    rng, known = random.Random(8), vocabulary(3000)
    items, texts = [], []
    for k in range(400):
        words = prose(rng, rng.randint(46, 140), known).split()
        items.append((k, " ".join(words)))
        words[rng.randrange(8, len(words) - 8)] = "changed"
        if len(words) > 100:
            words[rng.randrange(8, len(words) - 8)] = "again"
        texts.append(f"before {' '.join(words)} after")
    def alike(k):
        # Texts share no shingle with other items, so all weights are equal and the best window is the one in place.
        own, word = PLAIN.findall(lowered(items[k][1])), PLAIN.findall(lowered(texts[k]))[1:-1]
        one, other = (Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4)) for w in (own, word))
        shared = (one & other).total()
        return shared / (one.total() + other.total() - shared)

    wanted = {(k, k) for k in range(400) if alike(k) >= 0.8}
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    found = {(r["doc_id"], r["item_id"]) for r in benchmark_matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(wanted) > 250 and found <= wanted
    assert len(found) >= 0.98 * len(wanted)


def test_planted_passages_are_found(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_benchmark_decontamination"](spark, sf_dir).collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    plain = {d["doc_id"]: " ".join(PLAIN.findall(lowered(d["text"]))) for d in docs}
    exact = {(d, i) for i, t in items for d, own in plain.items() if f" {' '.join(PLAIN.findall(lowered(t)))} " in f" {own} "}
    assert exact and exact <= found


def test_nothing_to_scan(spark, rows):
    empty, no_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert benchmark_matches(empty, no_items).count() == 0
    assert benchmark_matches(frame(spark, rows), no_items).count() == 0
    assert license_scan(empty).count() == 0
    assert secret_scan(empty).count() == 0
    assert without_secrets(empty).count() == 0


def base_places(text):
    w = PLAIN.findall(lowered(text))
    out = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        out += [(k, label) for k in range(len(w)) if w[k : k + len(p)] == p]
    return len(w), out


LICENSED = [
    ("Some text. Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0"}),
    ("Licensed under the Apache License", {"apache"}),
    ("THIS WORK is licensed under the GNU General Public License, version 3. More of it.", {"gpl", "gpl-3.0"}),
    ("This work is licensed under the GNU General Public License, version 2.", {"gpl", "gpl-2.0"}),
    ("é Released under the MIT License.\nReleased under the mit-license", {"mit"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", {"bsd"}),
    ("the license of the general public", set()), ("mit. License", {"mit"}), ("mitlicense mit licenses", set()), ("", set()), (None, set()), ("É mit ÉLICENSE license", set()),
]


def test_licences(spark, rows):
    texts = [t for t, _ in LICENSED] + [r[1] for r in rows]
    docs = [(k, t, None, None, None) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in license_scan(frame(spark, docs)).collect()}
    assert len(got) == len(docs)
    for k, text in enumerate(texts):
        n, places = base_places(text)
        r = got[k]
        at = [p for p, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (n, len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]
        assert 0 <= r["score"] <= 1
    for k, (_, labels) in enumerate(LICENSED):
        assert got[k]["labels"] == ",".join(sorted(labels))


def test_reserved_rights_are_proprietary(spark, rows):
    texts = ["All rights reserved.", "é. ALL RIGHTS\nRESERVED", "Copyright 2024 Some Name. All rights reserved.", "Copyright (c) Name, 2020-2024, all rights reserved!", "All rights are reserved.", "Copyright 2024 Some Name.", "reserved rights, all"]
    docs = [(k, t, None, None, None) for k, t in enumerate(texts)] + [(100 + k, f"{r[1]} All rights reserved.", None, None, None) for k, r in enumerate(rows)]
    got = {r["doc_id"]: r["labels"] for r in license_scan(frame(spark, docs)).collect()}
    assert [got[k] for k in range(len(texts))] == ["proprietary"] * 4 + [""] * 3
    assert {got[100 + k] for k in range(len(rows))} == {"proprietary"}


def test_base_licences_match_sql(spark):
    from oracle_check import connect

    sf_dir = "/root/testdata/sf0.01"
    sql = r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        e AS (SELECT doc_id, len(w) AS n, list_filter(range(len(w)), lambda i: w[i + 1] IN ('mit', 'apache') AND w[i + 2] = 'license' OR w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS p FROM d)
        SELECT doc_id, n, len(p), list_min(p), list_max(p) FROM e"""
    wanted = connect(sf_dir).execute(sql).fetchall()
    got = QUERIES["op9_license_scan"](spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word").collect()
    same([tuple(r) for r in got], wanted)


def test_secrets_are_told_from_numbers_and_paths(spark):
    rng, known = random.Random(5), vocabulary()
    texts, secret = [], []
    for k in range(240):
        value = "".join(rng.choices("0123456789abcdef", k=40))
        kind = k % 6
        tail = {0: f'token = "{value}"', 1: f"password: {value}", 2: "".join(rng.choices("0123456789", k=16)), 3: f"/usr/lib/{rng.choice(known)}2/{rng.choice(known)}-3.14/x.so", 4: f"commit {value}", 5: f"api_key={value}"}[kind]
        texts.append(prose(rng, 20, known) + " é " + tail + " " + prose(rng, 5, known))
        secret.append(kind in (0, 1, 5))
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    found = secret_scan(docs).collect()
    flagged = {r["doc_id"] for r in found if r["secret"]}
    assert flagged == {k for k, s in enumerate(secret) if s}
    for r in found:
        assert texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == r["value"]
    cleaned = {r["doc_id"]: r["text"] for r in without_secrets(docs.select("doc_id", "text", "n_chars")).collect()}
    for k, text in enumerate(texts):
        assert ("[SECRET]" in cleaned[k]) == secret[k]
        assert secret[k] or cleaned[k] == text


JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5Nx"
VALUES = [
    ("password: hunter2secret", "hunter2secret", True), ("pwd=Tr0ub4dor&3xyz!", "Tr0ub4dor&3xyz!", True), ("postgres://bob:s3cr3tPw9@db.example.org/x", "s3cr3tPw9", True),
    ('DB_PASSWORD="my pass 9 word!x"', "my pass 9 word!x", True), ('{"api_key": "aB3$xY"}', "aB3$xY", True), (f"Authorization: Bearer {JWT}", JWT, True), (f"token={JWT}&user=7", JWT, True),
    ("secret = 'pässwörd9'", "pässwörd9", True), ('password = "x7', "x7", True), (f"see {JWT}, or not", JWT, None), ("login bob:s3cr3t@ftp.example.org", "s3cr3t", None),
    ("the key: it", "it", False), ("Password: required.", "required", False), ("mailto:bob@host.com", "bob", False),
]


def test_whole_values_of_any_length_are_candidates(spark):
    rng = random.Random(5)
    known = "the of and required optional value text word report nation station order letter number under water other".split()
    texts = [f"Some text, é {tail}" for tail, *_ in VALUES]
    for k in range(240):
        value = "".join(rng.choices("0123456789abcdef", k=40))
        tail = [f'token = "{value}"', f"password: {value}", "".join(rng.choices("0123456789", k=16)), f"commit {value}", f"password: {rng.choice(known)}", f"the key: {rng.choice(['it', 'a', 'so'])}", f"pwd: {''.join(rng.choices('abcdefghkmnpqrstuvwxyzABCDEFGH23456789', k=rng.randint(7, 12)))}"][k % 7]
        texts.append(" ".join(rng.choices(known, k=30)) + " " + tail + " " + " ".join(rng.choices(known, k=8)))
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    found = {}
    for r in secret_scan(docs).collect():
        assert texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == r["value"]
        found.setdefault(r["doc_id"], []).append((r["value"], r["secret"]))
    cleaned = {r["doc_id"]: r["text"] for r in without_secrets(docs.select("doc_id", "text", "n_chars")).collect()}
    for k, (_, value, secret) in enumerate(VALUES):
        assert [v for v, _ in found[k]] == [value]
        if secret is not None:
            assert found[k][0][1] == secret, value
            assert cleaned[k] == (texts[k].replace(value, "[SECRET]") if secret else texts[k])


def test_values_do_not_cross_texts(spark):
    docs = spark.createDataFrame([(0, "password:"), (1, "hunter2 and more"), (2, "https://bob:"), (3, "pw9@host"), (4, None)], "doc_id long, text string").coalesce(1)
    assert secret_scan(docs).count() == 0


def test_own_findings_train_the_forest(spark, rows):
    docs = frame(spark, [(0, 'note abc "0123456789abcdef0123"', None, None, None)])
    dictionary = trigram_dictionary(docs)
    assert dictionary.shape == (26**3,)
    labelled = spark.createDataFrame([([float(k % 7 + 20 * y)] * len(FEATURES), y) for k in range(60) for y in (0, 1)], "features array<double>, label int")
    assert secret_scan(docs, labelled).count() == 1
    assert weak_findings(frame(spark, rows), dictionary).where("label IS NULL").count() == 0
    assert secret_scan(frame(spark, rows)).where("score < 0 OR score > 1").count() == 0
    assert scored_candidates(frame(spark, [(1, None, None, None, None)]), Forest([]), dictionary).count() == 0


def test_forest_holds_out():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16))
    y = ((x[:, 0] > 0) & (x[:, 3] + x[:, 5] > 0)).astype(int)
    forest = fit_forest(x[:1000], y[:1000])
    assert ((forest.predict(x[1000:]) >= 0.5) == (y[1000:] == 1)).mean() > 0.88


def test_words_of_batches_are_those_of_texts(rows):
    import pyarrow as pa

    from texts import words

    texts = [r[1] for r in rows]
    got = []
    for _, data, offsets in batch.runs(pa.array(texts, pa.string())):
        found = batch.words(data, offsets)
        for k in range(len(offsets) - 1):
            got.append([found.data[a:b].tobytes().decode() for a, b in zip(found.starts[found.first[k] : found.first[k + 1]], found.ends[found.first[k] : found.first[k + 1]], strict=True)])
    assert got == [words(t) for t in texts]

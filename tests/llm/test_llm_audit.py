"""Filter interaction audit against chains that are run order by order."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
import texts
from pyspark.sql import functions as F

from subtide.llm import filter_audit as audit

LABELS = [(k, k % 2, int(k % 7 == 0)) for k in range(0, 130, 3)] + [(4, None, 1), (4, 1, None), (5, 0, 0), (None, 1, 1), (999, 1, 1)]


def fails(rows: list[tuple]) -> list[set[str]]:
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = texts.WORD.findall(text)
        own = set()
        if len(words) < 200:
            own.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            own.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            own.add("C")
        if re.search("[#$%&*|]", text):
            own.add("D")
        if doc_id is not None and first[text] < doc_id:
            own.add("E")
        out.append(own)
    return out


def brute(rows: list[tuple], labels: list[tuple]) -> list[tuple]:
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for row, failed in zip(rows, fails(rows), strict=True):
        parts[row[3] or ""].append((row[0], failed))
    out = []
    for part, members in parts.items():
        shapley, steps = Counter(), []
        for order in permutations("ABCDE"):
            left, gone = members, []
            for step, f in enumerate(order, 1):
                lost = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                redundant = sum(f in m[1] for m in gone)
                gone = gone + lost
                shapley[f] += len(lost)
                unique = sum(m[1] == {f} for m in members)
                steps.append((part, "".join(order), step, len(left), len(lost), redundant, unique, sum(m[0] in good for m in lost), sum(m[0] in toxic for m in lost), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return out


def frames(spark, rows, labels=LABELS):
    of = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = texts.frame(spark, rows)
    for name in ("mask", "part", "t1", "t2", "first", "good", "toxic", "quality", "state", "filter", "removed", "_again"):
        docs, of = docs.withColumn(name, F.lit("clash")), of if name in of.columns else of.withColumn(name, F.lit("clash"))
    return docs, of


def hostile() -> list[tuple]:
    rows = texts.corpus(n=40)
    return rows + [(900 + k, "LOUD # text " * (10 + k % 2 * 300), "xx", ["a", None][k % 2], 1) for k in range(6)] + [(900, "LOUD # text " * 10, "xx", "b", 1)]


def test_against_every_order_run(spark):
    rows = hostile()
    docs, labels = frames(spark, rows)
    got = [tuple(r) for r in audit.filter_audit(docs, labels).collect()]
    texts.same(got, brute(rows, LABELS))
    assert len(got) == 600 * len({r[3] or "" for r in rows})


def test_one_text_that_most_rows_have(spark):
    rows = [(k, "the same text", "xx", f"s{k % 2}", 1) for k in range(300)] + [(k, f"text {k}", "xx", "s0", 1) for k in range(300, 330)]
    docs, labels = frames(spark, rows)
    texts.same([tuple(r) for r in audit.filter_audit(docs, labels).collect()], brute(rows, LABELS))


def test_empty_tables(spark):
    docs, labels = frames(spark, hostile()[:3])
    assert audit.filter_audit(docs.limit(0), labels).collect() == []
    rows = hostile()[:9]
    docs, labels = frames(spark, rows)
    texts.same([tuple(r) for r in audit.filter_audit(docs, labels.limit(0)).collect()], brute(rows, []))


def test_paths_through_the_lattice():
    reach, leave = audit.path_counts(4)
    assert reach[0b1111] == leave[0] == 24
    assert reach[0b0101] == 2 and leave[0b0101] == 2
    # Edges of one filter carry every order once.
    assert sum(reach[s] * leave[s | 1] for s in range(16) if not s & 1) == 24


def test_own_filters_and_orders(spark):
    counts = spark.createDataFrame([("p", 0b000, 5, 0, 0), ("p", 0b011, 3, 1, 0), ("p", 0b110, 2, 0, 2)], "part string, mask int, n long, good long, toxic long")
    got = audit.order_audit(counts, ["short", "long", "odd"], [(1, 0, 2), (0, 2, 1)]).orderBy("filter_order", "step").collect()
    assert [(r.filter_order, r.step, r.removed, r.kept, r.redundant) for r in got] == [
        ("longshortodd", 1, 5, 5, 0),
        ("longshortodd", 2, 0, 5, 3),
        ("longshortodd", 3, 0, 5, 2),
        ("shortoddlong", 1, 3, 7, 0),
        ("shortoddlong", 2, 2, 5, 0),
        ("shortoddlong", 3, 0, 5, 5),
    ]
    with pytest.raises(ValueError, match="too many"):
        audit.order_audit(counts, list("abcdefgh"))

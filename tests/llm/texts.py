"""Small hostile tables and plain-Python versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def lowered(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def words(text: str | None) -> list[str]:
    return WORD.findall(lowered(text))


def vocabulary(n: int = 300, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    syllables = ["ta", "re", "mi", "on", "é", "ßu", "kel", "or", "zz", "ni"]
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, n: int, known: list[str]) -> str:
    out = []
    for k in range(n):
        out.append(rng.choice(known) + rng.choice(["", "", "", ",", "."]))
        out.append("\n" if k % 14 == 13 else " ")
    return "".join(out).strip()


def corpus(seed: int = 5, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, empty and very long texts."""
    rng, known = random.Random(seed), vocabulary()
    passage, boilerplate = prose(rng, 120, known), "Read more. Here! of it"
    texts: list[str | None] = [prose(rng, rng.randint(1, 260), known) for _ in range(n)]
    for _ in range(25):
        own = rng.choice(texts[:n]).split(" ")
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(known)
        texts.append(" ".join(own))
    texts += [texts[0]] * 6
    texts += [prose(rng, 40, known) + "\n" + passage + "\n" + prose(rng, 30, known) for _ in range(12)]
    texts += [boilerplate + "\n" + prose(rng, rng.randint(3, 40), known) + "\n" + boilerplate for _ in range(30)]
    texts += [None, None, "", "", " \n\t", "a", "a b", "A  b", "tick " * 900, "tick " * 901, "  x́ é É 𝄞 " * 60, "x" * 5000, "y" * 399, "y" * 400]
    texts.append(prose(rng, 9000, known))
    rows = [(k, t, "xx", f"src{k % 3}" if k % 11 else None, len(t or "")) for k, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, texts[5], None, None, None)]


def frame(spark, rows: list[tuple]):
    """The rows with columns that clash with names the operators use."""
    from pyspark.sql import functions as F

    out = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("spans", "class", "key", "n", "score", "tid", "length", "host", "labels", "rank", "task", "id", "no_id", "hash", "copy", "_id", "_no_id", "_hash", "_copy", "_host", "_t1", "_t2", "_boilerplate", "of", "one", "two", "cut", "at", "a.b"):
        out = out.withColumn(name, F.lit("clash"))
    return out


def same(got: list, wanted: list) -> None:
    assert Counter(map(repr, got)) == Counter(map(repr, wanted))


def components(rows: list[tuple], n: int = 3, percent: int = 90) -> dict[int, int]:
    """Row index -> smallest doc_id reachable, by comparing all pairs."""
    sets = []
    for row in rows:
        w = words(row[1])
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    links = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    out, seen = {}, set()
    for a in range(len(rows)):
        if a in seen:
            continue
        group, queue = {a}, [a]
        while queue:
            for b in links[queue.pop()] - group:
                group.add(b)
                queue.append(b)
        seen |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            out[k] = min(ids) if ids else None
    return {k: (len(sets[k]), out[k]) for k in out}

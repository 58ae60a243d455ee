"""What each filter of a chain removes in any order of the chain, from one count per combination of failures.

Filters only look at a document, never at what other filters left, so a document is fully told by the set of filters it fails.

1. Each document becomes a bit mask of the filters it fails; documents are counted per part and mask. This is the only step whose
   work grows with the documents. A filter for repeated texts compares 128-bit hashes: the smallest id of each text is found by
   sums before the shuffle and met again by id, so a text that a third of all rows have is no hot key.
2. The states of a chain are the sets of filters already applied: a lattice whose edges apply one more filter. An edge removes the
   documents that fail its filter and none of its state's. Each mask adds its counts to the edges it leaves the lattice on.
3. Orders that reach a state are counted forwards from the empty set, orders that leave it backwards from the full one; an edge
   lies on the product of both. That weight makes the sum over all orders (``shapley``) one pass over the edges, and the steps of
   each single order are read from the same edges.

Null text is empty. Null part is the empty string. A null id is never larger than another, so its text is no repetition, nor does it
make others one. Rows that occur twice are two documents; with the same id neither repeats the other. A document is good or toxic if any of its labels says so.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.shared import split_join, text_column, written

#: All orders of more filters than this are too many rows to list; give ``orders`` then.
MOST_ORDERED = 7

_SPACE = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of a text: A short, B repetitive, C capitals, D symbols."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 200,
        "B": 100 * n_distinct < 50 * n_words,
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, filters: dict[str, Column], part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, part, mask: the filters each document fails, the first filter in the lowest bit; with t1, t2, two hashes of the text."""
    mask = F.lit(0)
    for k, fails in enumerate(filters.values()):
        mask = mask + F.when(fails, F.lit(1 << k)).otherwise(F.lit(0))
    own = text_column(text)
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        mask.cast("int").alias("mask"),
        F.xxhash64(own).alias("t1"),
        F.xxhash64(F.lit(1), own).alias("t2"),
    )


def with_repeats(failed: DataFrame, bit: int) -> DataFrame:
    """``failed`` with ``bit`` set in the mask where a smaller doc_id has the same text."""
    first = failed.where("doc_id IS NOT NULL").groupBy("t1", "t2").agg(F.min("doc_id").alias("doc_id"))
    marked = split_join(failed, first.withColumn("first", F.lit(True)), ["doc_id", "t1", "t2"], "left")
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return marked.withColumn("mask", F.col("mask") + F.when(repeats, F.lit(1 << bit)).otherwise(F.lit(0))).drop("first")


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents per part and set of failed filters."""
    of = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality") == 1, F.col("toxic") == 1).toDF("doc_id", "good", "toxic")
    of = of.where("good OR toxic").groupBy("doc_id").agg(*(F.max(F.coalesce(c, F.lit(False))).cast("int").alias(c) for c in ("good", "toxic")))
    labelled = split_join(failed.select("doc_id", "part", "mask"), of, ["doc_id"], "left")
    return labelled.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("good", "toxic")))


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For each state of a lattice of ``n`` filters, the orders that reach it and those that lead on from it to the end."""
    full = (1 << n) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):
        for k in range(n):
            if not state >> k & 1:
                reach[state | 1 << k] += reach[state]
    for state in range(full, -1, -1):
        for k in range(n):
            if not state >> k & 1:
                leave[state] += leave[state | 1 << k]
    return reach, leave


def _edges(counts: DataFrame, n: int) -> DataFrame:
    """part, state, filter, weight, removed, good, toxic: what each edge of the lattice removes; edges that remove nothing are absent."""
    reach, leave = path_counts(n)
    rows = [
        (mask, state, k, reach[state] * leave[state | 1 << k])
        for mask in range(1 << n)
        for state in range(1 << n)
        if not state & mask
        for k in range(n)
        if mask >> k & 1
    ]
    lattice = counts.sparkSession.createDataFrame(rows, "mask int, state int, filter int, weight long")
    sums = [F.sum(c).alias(as_) for c, as_ in (("n", "removed"), ("good", "good"), ("toxic", "toxic"))]
    # The lattice has n * 3 ** (n - 1) rows whatever the input.
    return counts.join(F.broadcast(lattice), "mask").groupBy("part", "state", "filter").agg(F.first("weight").alias("weight"), *sums)


def order_audit(counts: DataFrame, names: list[str], orders: list[tuple[int, ...]] | None = None) -> DataFrame:
    """One row per part, order and step: what the step's filter removes there, and what it does over all orders.

    ``counts`` are ``mask_counts``; ``names`` of the filters from the lowest bit on; ``orders`` of their places, all by default.
    """
    n = len(names)
    if orders is None:
        if n > MOST_ORDERED:
            raise ValueError(f"all orders of {n} filters are too many to list, name some")
        orders = list(permutations(range(n)))
    full = (1 << n) - 1
    steps = []
    for order in orders:
        state, path = 0, []
        for step, k in enumerate(order, 1):
            path.append(state * n + k)
            name = "".join(names[j] for j in order)
            steps.append({"filter_order": name, "step": step, "k": k, "path": list(path), "alone": (full ^ 1 << k) * n + k})
            state |= 1 << k
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,k:int,path:array<int>,alone:int>>")

    # At most n * 2 ** (n - 1) entries a part.
    entry = F.struct(F.col("state") * n + F.col("filter"), F.struct("removed", "good", "toxic"))
    over = [F.sum(F.when(F.col("filter") == k, F.col("weight") * F.col("removed")).otherwise(0)) for k in range(n)]
    per_part = _edges(counts, n).groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("edges"), F.array(*over).alias("over"))
    totals = counts.groupBy("part").agg(F.sum("n").alias("documents"))
    rows = totals.join(per_part, "part", "left").withColumn("at", F.explode(listed)).select("part", "documents", "edges", "over", "at.*")

    def edge(key: Column, field: str = "removed") -> Column:
        return F.coalesce(F.try_element_at("edges", key)[field], F.lit(0).cast("long"))

    here = F.element_at("path", F.lit(-1))
    gone_so_far = F.aggregate("path", F.lit(0).cast("long"), lambda total, key: total + edge(key))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - gone_so_far).alias("kept"),
        edge(here).alias("removed"),
        (edge(F.col("k")) - edge(here)).alias("redundant"),
        edge(F.col("alone")).alias("unique_fails"),
        edge(here, "good").alias("good_lost"),
        edge(here, "toxic").alias("toxic_lost"),
        F.coalesce(F.element_at("over", F.col("k") + 1), F.lit(0)).cast("long").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """All orders of five filters over the whole texts of ``docs``: A to D of ``text_filters``, and E, a text that a smaller doc_id has."""
    filters = text_filters(text_column("text"))
    failed = written(failures(docs, filters, part), "filter-failures")
    marked = with_repeats(failed, len(filters))
    return order_audit(mask_counts(marked, labels), [*filters, "E"])

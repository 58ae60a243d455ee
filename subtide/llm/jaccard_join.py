"""Similarity join of documents by n-gram Jaccard with adaptive multi-match prefixes, down to connected components.

A document is the set of its shingles of ``n`` words (fewer words: all of them as one shingle). Two
documents link when ``100 * shared >= percent * union``.

1. Shingles are counted in a sketch of fixed size, one counter per slot of their hash. All shingles have one order: by
   their slot's count, then by hash, so frequent ones come last.
2. Sets with the same shingles are one class. For a class of s shingles, two that link share ``need = ceil(s * percent / 100)``
   at least, so they share one of its first ``s - need + 1`` shingles: its prefix. With m more shingles they share m more
   (the shorter extension counts). Every prefix has ``EXTENSION`` more, and the longer the list of candidates that the
   sketch lets expect, the further it is lengthened, and the more shared shingles are asked for.
3. Shingles of prefixes that only one class has drop out, and classes that are left with fewer than their links share.
   The others meet at the smallest class of each rarer shingle they share, the leader, so classes with many common
   shingles meet in a few places rather than at each shingle.
4. A task that holds the prefixes of a place finds, breadth first, which of its classes share enough prefix shingles and are alike
   in size. Only those get their texts, and only connected ones go on to the same task, which verifies the exact
   overlap: a class is compared with those that no earlier one has reached, so a group of copies costs a pass and not
   all its pairs. A place with more than ``crowd`` classes, or of more than ``crowd_shingles`` shingles, is cut into slices,
   and each pair of slices is one task's work.
5. Stars become components over all places by rounds of smallest neighbours, written to the shared folder.

Null and empty texts and texts without words have no shingles and link with nothing. Repeated rows and copies are one class; every
row is returned. An empty table gives no rows; other columns are ignored. A null doc_id takes part in links but
does not name a component unless it is alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.bits import holds, key_bits
from subtide.llm.shared import bounded, quoted, split_join, text_column, unused, written

SKETCH_BITS = 18
# A slice of a place has about so many classes and so many shingles, so about 25 MB of text, at most.
CROWD, CROWD_SHINGLES = 4096, 4_000_000
# Shingles by which every prefix is longer than it has to be: at least so many, and a share of large sets;
# and by how many more the estimated cost may lengthen it.
EXTENSION, EXTENSION_SHARE, COST_EXTENSION = 12, 1 / 32, 12
_SEGMENT_BITS = 12


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    found = batch.words(data, offsets)
    hashes = found.hashes()
    for row in range(len(offsets) - 1):
        own = hashes[found.first[row] : found.first[row + 1]]
        yield np.unique(batch.shingle_hashes(own, min(n, len(own)))) if len(own) else own


def slots(shingles: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    return (shingles >> np.uint64(64 - bits)).astype(np.int64)


def class_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def class_key(identity: bytes) -> int:
    """A long for the places where classes only have to meet, so that two classes with one key do no harm."""
    return int.from_bytes(identity[:8], "big", signed=True)


def frequency_sketch(texts: DataFrame, n: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """How many documents' shingles fall into each slot. The driver gets ``2 ** bits`` numbers, whatever the input."""
    size = min(1 << _SEGMENT_BITS, 1 << bits)
    schema = pa.schema([("segment", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << bits, np.int64)
        for rows in batches:
            for _, data, offsets in batch.runs(rows.column(0)):
                totals += np.bincount(slots(np.concatenate([*shingle_sets(data, offsets, n)]), bits), minlength=1 << bits)
        parts = totals.reshape(-1, size)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for rows in batches:
            for segment, counts in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                own = np.frombuffer(counts, "<i8")
                totals[segment] = totals[segment] + own if segment in totals else own
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([p.tobytes() for p in totals.values()], pa.binary())], schema=schema)

    kinds = "segment int, counts binary"
    rows = texts.select("text").mapInArrow(count, kinds).repartition("segment").mapInArrow(add, kinds).collect()
    out = np.zeros((1 << bits) // size * size, np.int64).reshape(-1, size)
    for row in rows:
        out[row["segment"]] += np.frombuffer(row["counts"], "<i8")
    return out.ravel()


class Prefixes:
    """Prefixes under the order that a sketch gives, and how far they are lengthened."""

    def __init__(self, sketch: np.ndarray, percent: int) -> None:
        # What a slot holds beyond the usual comes from frequent shingles.
        self.sketch, self.percent = sketch, percent
        self.usual = int(np.median(sketch)) + 4 * math.isqrt(int(np.median(sketch)) + 1)
        self.bits = int(len(sketch)).bit_length() - 1

    def need(self, size: int) -> int:
        return -(-size * self.percent // 100)

    def matches(self, size: int) -> int:
        """Shared prefix shingles that any link of a set of this size has at least, whatever the other's extension."""
        return 1 + self.extension(self.need(size))

    def extension(self, size: int) -> int:
        """How much longer the prefix of a set of this size is at least; never less for a larger set."""
        return min(self.need(size) - 1, max(EXTENSION, int(size * EXTENSION_SHARE)))

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, int]:
        """The shingles of the prefix, in order; the extension."""
        size = len(shingles)
        base = size - self.need(size) + 1
        count = self.sketch[slots(shingles, self.bits)]
        order = np.lexsort((shingles, count))
        # Estimated candidates: what the slots of the prefix hold beyond the usual. Each doubling asks for one more match.
        cost = int(np.maximum(count[order[:base]] - self.usual, 0).sum())
        extension = min(size - base, self.extension(size) + min(COST_EXTENSION, max(0, cost.bit_length() - 5)))
        return shingles[order[: base + extension]], extension


def _prefix_rows(texts: DataFrame, prefixes: Prefixes, n: int) -> DataFrame:
    """One row per document: its class (null without words), the class's key, size, the matches its links have at least, and its prefix."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("class", pa.binary()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("matches", pa.int32()), ("extension", pa.int32()), ("prefix", pa.list_(pa.int64()))])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, data, offsets in batch.runs(rows.column(1)):
                classes, sizes, extensions, lists = [], [], [], []
                for own in shingle_sets(data, offsets, n):
                    classes.append(class_id(own) if len(own) else None)
                    sizes.append(len(own))
                    head, extension = prefixes.of(own) if len(own) else (own, 0)
                    lists.append(head.view(np.int64))
                    extensions.append(extension)
                flat = np.concatenate([*lists, np.zeros(0, np.int64)])
                ends = np.cumsum([0, *map(len, lists)])
                prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(first, len(sizes)), rows.column(2).slice(first, len(sizes)), pa.array(classes, pa.binary()), pa.array([c and class_key(c) for c in classes], pa.int64()), pa.array(sizes, pa.int64()), pa.array([prefixes.matches(k) if k else 0 for k in sizes], pa.int32()), pa.array(extensions, pa.int32()), prefix], schema=schema)

    return texts.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(emit, "doc_id long, text_hash long, class binary, key long, n_shingles long, matches int, extension int, prefix array<long>")


class Heads:
    """Which of some sets may link, by prefixes and sizes: postings of their prefix shingles."""

    def __init__(self, heads: list[np.ndarray], extension: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> None:
        self.heads, self.extension, self.low, self.high, self.percent = heads, extension, low, high, percent
        flat = np.concatenate([*heads, np.zeros(0, np.int64)]).astype(np.int64, copy=False)
        owner = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
        order = np.argsort(flat, kind="stable")
        self.keys, self.begin = np.unique(flat[order], return_index=True)
        self.end = np.append(self.begin[1:], len(flat))
        self.owner = owner[order]

    def likely(self, k: int, among: np.ndarray) -> np.ndarray:
        """Those of ``among`` that share one prefix shingle more than the shorter of both extensions with k, and could be large enough."""
        at = np.searchsorted(self.keys, self.heads[k])
        begin, n = self.begin[at], self.end[at] - self.begin[at]
        begin, n = begin[n > 1], n[n > 1]
        if not len(n):
            return np.zeros(0, np.int64)
        places = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        together = np.bincount(self.owner[places], minlength=len(self.heads))
        fits = among & (together > np.minimum(self.extension, self.extension[k]))
        fits &= 100 * np.minimum(self.high, self.high[k]) >= self.percent * np.maximum(self.low, self.low[k])
        return np.flatnonzero(fits)


def breadth_first(order: list[int], neighbours: Callable[[int, np.ndarray], Iterable[int]]) -> list[tuple[int, int]]:
    """Edges that connect every component; ``neighbours`` gets a set and the sets not reached yet."""
    free = np.ones(len(order), bool)
    edges = []
    for start in order:
        queue = [start] if free[start] else []
        free[start] = False
        while queue:
            k = queue.pop()
            for other in neighbours(k, free):
                edges.append((k, other))
                free[other] = False
                queue.append(other)
    return edges


def linked_stars(sets: list[np.ndarray], prefixes: Prefixes, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that connect every component of the sets.

    ``side``: 0 or 1 for each set; then only links between 0 and 1 count.
    """
    size = np.array([len(s) for s in sets])
    taken = [prefixes.of(s) for s in sets]
    heads = Heads([h.view(np.int64) for h, _ in taken], np.array([e for _, e in taken]), size, size, prefixes.percent)

    def linked(k: int, free: np.ndarray) -> list[int]:
        out = []
        for other in heads.likely(k, free if side is None else free & (side != side[k])).tolist():
            shared = len(np.intersect1d(sets[k], sets[other], assume_unique=True))
            if 100 * shared >= prefixes.percent * (size[k] + size[other] - shared):
                out.append(other)
        return out

    return breadth_first(np.argsort(size, kind="stable").tolist(), linked)


def _grouped(batches: Iterator[pa.RecordBatch], width: int, act: Callable[[list[tuple]], list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What ``act`` makes of each group of consecutive rows that agree in their first ``width`` columns."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    out: list[tuple] = []
    group: list[tuple] = []
    for rows in batches:
        for row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if group and row[:width] != group[0][:width]:
                out += act(group)
                group = []
                if len(out) > 10_000:
                    yield batch_of(out)
                    out = []
            group.append(row)
    if group:
        out += act(group)
    yield batch_of(out)


def _likely_groups(members: DataFrame, percent: int) -> DataFrame:
    """leader, a, b, part, slice, key: those at each place that may link, and which of them are connected by that.

    members: leader, slice pair (a, b), slice, key, low and high size, extension, live prefix shingles.
    """
    schema = pa.schema([("leader", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("part", pa.int32()), ("slice", pa.int32()), ("key", pa.int64())])

    def connected(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        leader, a, b = rows[0][:3]
        heads = Heads([np.array(r[8], np.int64) for r in rows], np.array([r[7] for r in rows]), np.array([r[5] for r in rows]), np.array([r[6] for r in rows]), percent)
        side = np.array([int(r[3] == b) for r in rows]) if a != b else None
        part: dict[int, int] = {}
        edges = breadth_first(list(range(len(rows))), lambda k, free: heads.likely(k, free if side is None else free & (side != side[k])).tolist())
        for k, other in edges:
            part[other] = part.setdefault(k, k)
        return [(leader, a, b, p, rows[k][3], rows[k][4]) for k, p in part.items()]

    keys = ["leader", "a", "b"]
    columns = members.select(*keys, "slice", "key", "low", "high", "extension", "live")
    return columns.repartition(*keys).sortWithinPartitions(*keys, "key").mapInArrow(lambda batches: _grouped(batches, 3, connected, schema), "leader long, a int, b int, part int, slice int, key long")


def _compared(members: DataFrame, prefixes: Prefixes, n: int) -> DataFrame:
    """Edges between classes that meet; members: leader, slice pair (a, b), part, slice, class, text."""
    schema = pa.schema([("one", pa.binary()), ("other", pa.binary())])

    def within(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        sets = []
        for _, data, offsets in batch.runs(pa.array([r[6] for r in rows], pa.string())):
            sets += shingle_sets(data, offsets, n)
        side = np.array([int(r[4] == r[2]) for r in rows]) if rows[0][1] != rows[0][2] else None
        return [(rows[a][5], rows[b][5]) for a, b in linked_stars(sets, prefixes, side)]

    keys = ["leader", "a", "b", "part"]
    columns = members.select(*keys, "slice", "class", "text")
    return columns.repartition(*keys).sortWithinPartitions(*keys, "class").mapInArrow(lambda batches: _grouped(batches, 4, within, schema), "one binary, other binary")


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def components(edges: DataFrame, one: str = "one", other: str = "other", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges; root is the smallest node reachable.

    Each round hangs every neighbour at least as large as a node on the smallest node of its neighbourhood, and then every
    smaller one; edges become stars in a number of rounds that grows with the logarithm of the diameter. Neighbourhoods
    are reduced to their smallest node before they are shuffled, and no neighbourhood is ever in one place.
    """
    links = written(edges.select(F.greatest(one, other).alias("hi"), F.least(one, other).alias("lo")).where("hi <> lo").distinct(), "links")
    now = _fingerprint(links)
    for _ in range(rounds):
        # Large star: neighbours above a node hang on the smallest node around it.
        both = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        small = both.groupBy("hi").agg(F.min("lo").alias("least")).select(F.col("hi").alias("node"), F.least("hi", "least").alias("least"))
        large = split_join(links, small.withColumnRenamed("node", "lo"), ["lo"]).select("hi", F.col("least").alias("lo"))
        # Small star: a node and those below it hang on the smallest of them.
        large = written(large.distinct(), "links")
        below = large.groupBy("hi").agg(F.min("lo").alias("least"))
        hung = split_join(large, below, ["hi"]).select(F.col("lo").alias("hi"), F.col("least").alias("lo")).unionByName(below.select("hi", F.col("least").alias("lo")))
        new = written(hung.where("hi <> lo").distinct(), "links")
        links, before, now = new, now, _fingerprint(new)
        if now == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, crowd: int = CROWD, sketch_bits: int = SKETCH_BITS, crowd_shingles: int = CROWD_SHINGLES) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id (the smallest doc_id reachable by links)."""
    texts = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_column("text").alias("text"))
    prefixes = Prefixes(frequency_sketch(texts, n, sketch_bits), percent)
    every = written(_prefix_rows(texts, prefixes, n), "prefixes")
    places = written(_places(every), "places")
    sliced = _sliced(places, crowd, crowd_shingles)
    pair = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda k: F.struct(F.least(k, F.col("slice")).alias("a"), F.greatest(k, F.col("slice")).alias("b")))
    likely = _likely_groups(sliced.select("leader", "key", "slice", "low", "high", "extension", "live", F.inline(pair)), percent)
    # One text of each class that may link with another; the others are left out before the shuffle, as far as a
    # bit table of fixed size can tell.
    names = every.where("class IS NOT NULL").select("key", "class").distinct()
    meeting = written(likely, "likely").join(names, "key")
    meets = meeting.groupBy("class").agg(F.collect_list(F.struct("leader", "a", "b", "part", "slice")).alias("meets"))
    wanted = key_bits(meeting.select("key"), "key")
    one_text = _with_class(texts, n, wanted).groupBy("class").agg(F.first("text").alias("text"))
    members = one_text.join(meets, "class").select("class", "text", F.inline("meets"))
    edges = _compared(members, prefixes, n)
    rooted = components(edges)
    of_class = every.join(rooted, every["class"] == rooted["node"], "left").select("doc_id", "text_hash", "n_shingles", F.coalesce("root", "class").alias("root"))
    smallest = of_class.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    done = split_join(of_class, smallest, ["root"], "left")
    return done.select("doc_id", "text_hash", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"))


def _places(every: DataFrame) -> DataFrame:
    """leader, key, low, high, extension, live: where the classes meet that can have a link.

    A link shares ``matches`` prefix shingles, so a class with fewer that anyone else has is out. The first shared shingle,
    with rare ones first, is followed by ``matches - 1`` others on both sides, so the last of them are no places.
    """
    known = every.where("class IS NOT NULL")
    single = known.select("key", F.explode("prefix").alias("shingle"))
    leaders = single.groupBy("shingle").agg(F.min("key").alias("leader"), F.max("key").alias("largest"), F.count("*").alias("rows")).where("leader < largest")
    live = split_join(single, leaders.drop("largest"), ["shingle"]).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("rows", "shingle", "leader"))).alias("live"))
    sizes = known.groupBy("key").agg(F.min("matches").alias("matches"), F.min("extension").alias("extension"), F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    enough = live.join(sizes, "key").where(F.size("live") >= F.col("matches"))
    kept = F.slice("live", F.lit(1), F.size("live") - F.col("matches") + 1)
    leader = F.explode(F.array_distinct(F.transform(kept, lambda x: x["leader"]))).alias("leader")
    return enough.select("key", "low", "high", "extension", F.transform("live", lambda x: x["shingle"]).alias("live"), leader)


def _sliced(places: DataFrame, crowd: int, crowd_shingles: int) -> DataFrame:
    """``places`` where several classes meet, plus slices and slice: into how many their place is cut, and which is theirs.

    Long texts fill a task as many classes do, so a place is cut by whichever asks for more; there are no more slices than classes.
    """
    asked = F.greatest(F.ceil(F.count("*") / F.lit(crowd)), F.ceil(F.sum("high") / F.lit(crowd_shingles)))
    crowds = places.groupBy("leader").agg(F.count("*").alias("classes"), F.least(asked, F.count("*")).cast("int").alias("slices")).where("classes > 1")
    return split_join(places, crowds, ["leader"]).withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))


def _with_class(texts: DataFrame, n: int, wanted: np.ndarray) -> DataFrame:
    """class and text of the texts whose class's key the bits of ``wanted`` hold."""
    schema = pa.schema([("class", pa.binary()), ("text", pa.string())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            classes = [class_id(own) if len(own) else None for _, data, offsets in batch.runs(rows.column(0)) for own in shingle_sets(data, offsets, n)]
            at = [k for k, c in enumerate(classes) if c]
            hit = holds(wanted, np.array([class_key(classes[k]) for k in at], np.int64))
            at = [k for k, h in zip(at, hit.tolist(), strict=True) if h]
            yield pa.RecordBatch.from_arrays([pa.array([classes[k] for k in at], pa.binary()), rows.column(0).take(pa.array(at, pa.int64())).cast(pa.string())], schema=schema)

    return texts.select("text").mapInArrow(keyed, "class binary, text string")


def without_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that name their component, one of equal rows; documents without an id stay if no linked one has an id."""
    found = jaccard_components(docs, n, percent)
    # Keys without nulls, the same on both sides, so the copies of a row are counted where the join has put them.
    *keys, copy = unused(docs.columns, "no_id", "id", "hash", "copy")

    def keyed(rows: DataFrame, text_hash: Column) -> DataFrame:
        doc_id = F.col("doc_id").cast("long")
        return rows.withColumns(dict(zip(keys, (doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), text_hash), strict=True)))

    named = keyed(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), F.col("text_hash")).select(*keys).distinct()
    kept = keyed(docs, F.xxhash64(text_column("text"))).join(named, keys, "left_semi")
    # Rows that name their component twice are equal in id and text; one of them stays.
    one = Window.partitionBy(*keys).orderBy(*keys)
    return kept.withColumn(copy, F.row_number().over(one)).where(F.col(copy) == 1).select(*map(quoted, docs.columns))

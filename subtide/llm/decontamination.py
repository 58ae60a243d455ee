"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact verification.

Words are runs of letters, digits and bytes above ASCII, with A-Z lower-cased. An item of n words is
compared with windows of n words, or with the whole text where that is shorter. Features are its shingles of ``SHINGLE`` words (an item of fewer
words is one shingle), weighted by their rarity among the items of the benchmark.

1. A window without a shingle of any item of its size has similarity 0, so windows are formed around
   shingles that an item has, and nowhere else. That drops no window that could match.
2. Each window gets a SimHash of ``BLOCKS`` blocks of 16 bits. Two fingerprints within the radius differ in at most
   ``radius // BLOCKS`` bits of some block. Each block of an item is indexed with half of those bits flipped in every way, and looked
   up with the other half flipped, so every pair within the radius meets; a fifth of
   unrelated pairs does, and the distance of whole fingerprints stops those before the exact step.
3. Weighted Jaccard similarity of the two multisets of shingles decides.

The benchmark is the query set: it is taken in blocks of items of bounded size, each held whole by
the tasks, and all documents stream past each block. Rarity is counted over the whole benchmark: shingles
that several items share go to every task, all others weigh the same, so blocks change no result. Nothing
is shuffled but counts of shingles, so no key can be hot.

Null or empty texts and items match nothing. Repeated rows are reported each for itself. Of
overlapping windows of one document and item the most similar is reported, the earliest of equals.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.shared import bounded, mapped, text_column

SHINGLE = 5
SCHEMA = "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("hamming", pa.int32()), ("similarity", pa.float64())])

#: 0-9, A-Z, a-z and the bytes of other characters.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x41:0x5B] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True

#: Blocks of 16 bits of a fingerprint, and the distance up to which similar passages are looked for.
BLOCKS = 20
RADIUS = 4 * BLOCKS - 1

_SEEDS = np.arange(1, BLOCKS // 4 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def signs(hashes: np.ndarray) -> np.ndarray:
    """A row of signs for each hash, one for each bit of a fingerprint."""
    bits = np.unpackbits(batch.mixed(hashes[:, None] ^ _SEEDS).view(np.uint8), axis=1)
    return bits.astype(np.float64) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of weighted sums of signs, as rows of blocks."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


def distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bits in which rows of fingerprints differ."""
    return np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)


def flips(bits: int) -> np.ndarray:
    """All values of a block with at most so many bits set."""
    values = np.arange(1 << 16, dtype=np.uint16)
    return values[np.bitwise_count(values) <= bits]


class BlockIndex:
    """Finds the fingerprints within a radius by their blocks."""

    def __init__(self, prints: np.ndarray, radius: int) -> None:
        self.prints, self.radius = prints, radius
        apart = radius // BLOCKS
        self.probes = flips(apart // 2)
        ways = flips(apart - apart // 2)
        owner = np.repeat(np.arange(len(prints), dtype=np.int32), len(ways))
        self.tables = []
        for k in range(BLOCKS):
            values = (prints[:, k, None] ^ ways).ravel()
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], owner[order]))

    def meeting(self, prints: np.ndarray) -> np.ndarray:
        """Pairs that meet in some block, as place in ``prints`` * indexed fingerprints + place among those."""
        pairs = []
        for k, (values, owner) in enumerate(self.tables):
            own = (prints[:, k, None] ^ self.probes).ravel()
            low = np.searchsorted(values, own, "left")
            n = np.searchsorted(values, own, "right") - low
            row = np.repeat(np.arange(len(own)) // len(self.probes), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            pairs.append(np.unique(row * len(self.prints) + owner[at]))
        return np.unique(np.concatenate(pairs))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``prints``, places among the indexed ones and distances of all pairs within the radius."""
        row, other = np.divmod(self.meeting(prints), len(self.prints))
        far = distances(prints[row], self.prints[other])
        near = far <= self.radius
        return row[near], other[near], far[near]


#: Windows whose running sums are in memory together.
WINDOWS = 1024


class Rarity:
    """Weights of shingles by the items of the whole benchmark that have them; a shingle without a count is in one item or none."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, n_items: int) -> None:
        order = np.argsort(keys)
        self.rare = math.log(1 + n_items)
        self.keys, self.weights = keys[order], np.array([math.log(1 + n_items / n) for n in counts[order].tolist()])

    def of(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(shingles), self.rare)
        at = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        return np.where(self.keys[at] == shingles, self.weights[at], self.rare)


class Items:
    """One block of the benchmark, ready for lookups. ``elsewhere`` is the broadcast rarity where there are other blocks."""

    def __init__(self, rows: list[tuple[int, str]], rarity: Rarity, radius: int, elsewhere: Broadcast | None = None) -> None:
        self.elsewhere, self.ids = elsewhere, []
        self.shingles: list[np.ndarray] = []
        self.sizes: list[int] = []
        for first, data, offsets in batch.runs(pa.array([text for _, text in rows], pa.string())):
            found = batch.words(data, offsets, inside=WORD_BYTES)
            hashes = found.hashes()
            for row in range(len(offsets) - 1):
                own = hashes[found.first[row] : found.first[row + 1]]
                if len(own):
                    self.ids.append(rows[first + row][0])
                    self.sizes.append(len(own))
                    self.shingles.append(batch.shingle_hashes(own, min(SHINGLE, len(own))))
        self.keys = np.unique(np.concatenate(self.shingles)) if self.shingles else np.zeros(0, np.uint64)
        self.known = batch.HashSet(self.keys)
        self.rare = rarity.rare
        self.weights = rarity.of(self.keys)
        self.local = [np.searchsorted(self.keys, s) for s in self.shingles]
        self.counts = [Counter(x.tolist()) for x in self.local]
        self.totals = [float(self.weights[x].sum()) for x in self.local]
        prints = [packed(np.round((signs(s) * self.weights[x][:, None]).sum(axis=0), 6)[None]) for s, x in zip(self.shingles, self.local, strict=True)]
        self.by_size: dict[int, np.ndarray] = {}
        for size in sorted(set(self.sizes)):
            self.by_size[size] = np.flatnonzero(np.array(self.sizes) == size)
        # For each shingle of an item, the sizes of the items that have it.
        self.sizes_of: list[set[int]] = [set() for _ in self.keys]
        for size, local in zip(self.sizes, self.local, strict=True):
            for k in set(local.tolist()):
                self.sizes_of[k].add(size)
        self.index = {size: BlockIndex(np.concatenate([prints[k] for k in items.tolist()]), radius) for size, items in self.by_size.items()}

    def within_radius(self, size: int, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, item, distance) of all pairs within the radius."""
        window, place, far = self.index[size].within(prints)
        return list(zip(window.tolist(), self.by_size[size][place].tolist(), far.tolist(), strict=True))

    def similarity(self, item: int, own: np.ndarray, weight: np.ndarray) -> float:
        """Weighted Jaccard of an item and a window, given by its shingles' places in ``keys`` and weights."""
        shared = 0.0
        for k, n in Counter(own[own >= 0].tolist()).items():
            shared += min(n, self.counts[item].get(k, 0)) * self.weights[k]
        return shared / (float(weight.sum()) + self.totals[item] - shared)

    def matches(self, words: np.ndarray, least: float) -> list[tuple[int, int, int, int, float]]:
        """(item id, first word, words, distance, similarity) for the word hashes of one text."""
        found = []
        for n in sorted({min(SHINGLE, s) for s in self.by_size}):
            shingles = batch.shingle_hashes(words, n)
            known = self.known.places(shingles)
            hits = np.flatnonzero(known >= 0)
            if not len(hits):
                continue
            starts: dict[int, set[int]] = {}
            for p in hits.tolist():
                for size in self.sizes_of[known[p]]:
                    if min(SHINGLE, size) == n:
                        length = min(size, len(words))
                        starts.setdefault(size, set()).update(range(max(0, p - length + n), min(p, len(words) - length) + 1))
            for size, own_starts in starts.items():
                first = np.array(sorted(own_starts), np.int64)
                if not len(first):
                    continue
                for k in range(0, len(first), WINDOWS):
                    found += self._near(first[k : k + WINDOWS], size, min(size, len(words)), n, shingles, known, least)
        return self._best(found)

    def _near(self, first: np.ndarray, size: int, length: int, n: int, shingles: np.ndarray, known: np.ndarray, least: float) -> list[tuple[int, int, int, int, float]]:
        width = length - n + 1
        # Sums over windows as differences of running sums over the shingles that the windows cover.
        used = np.zeros(len(shingles) + 1, np.int64)
        np.add.at(used, first, 1)
        np.add.at(used, first + width, -1)
        covered = np.flatnonzero(np.cumsum(used)[:-1] > 0)
        weight = np.where(known[covered] >= 0, self.weights[known[covered]], self.rare)
        if self.elsewhere is not None:
            other = known[covered] < 0
            weight[other] = self.elsewhere.value.of(shingles[covered[other]])
        sums = np.zeros((len(covered) + 1, 16 * BLOCKS))
        np.cumsum(signs(shingles[covered]) * weight[:, None], axis=0, out=sums[1:])
        at = np.searchsorted(covered, first)
        # Rounding of the running sums must not decide a sign.
        prints = packed(np.round(sums[at + width] - sums[at], 6))
        out = []
        for window, item, far in self.within_radius(size, prints):
            start = int(first[window])
            alike = self.similarity(item, known[start : start + width], weight[at[window] : at[window] + width])
            if alike >= least - 1e-12:
                out.append((item, start, length, far, round(alike, 9)))
        return out

    def _best(self, found: list[tuple[int, int, int, int, float]]) -> list[tuple[int, int, int, int, float]]:
        out, taken = [], {}
        for item, start, size, far, alike in sorted(found, key=lambda x: (-x[4], x[1], x[0])):
            if all(abs(start - other) >= size for other in taken.setdefault(item, [])):
                taken[item].append(start)
                out.append((self.ids[item], start, size, far, alike))
        return out


def _item_shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingles of each text that has words."""
    for _, data, offsets in batch.runs(texts):
        found = batch.words(data, offsets, inside=WORD_BYTES)
        hashes = found.hashes()
        for row in range(len(offsets) - 1):
            own = hashes[found.first[row] : found.first[row + 1]]
            if len(own):
                yield np.unique(batch.shingle_hashes(own, min(SHINGLE, len(own))))


def _shared_shingles(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several items have, and how many have them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            own = [*_item_shingles(rows.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64))], names=["shingle"])

    counts = bounded(items).select("text").mapInArrow(each, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").toArrow()
    return counts.column("shingle").to_numpy().astype(np.int64).view(np.uint64), counts.column("n").to_numpy().astype(np.int64)


def _blocks(benchmark: DataFrame, radius: int, block_chars: int) -> Iterator[Items]:
    """The benchmark in blocks that a task can hold, one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_column("text").alias("text"))
    whole = items.agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("n")).first()
    blocks, n_items = -(-(whole["chars"] or 0) // block_chars) or 1, max(1, whole["n"])
    if blocks == 1:
        rows = [(r["item_id"], r["text"]) for r in items.collect()]
        own = [*_item_shingles(pa.array([text for _, text in rows], pa.string()))]
        yield Items(rows, Rarity(*np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]), return_counts=True), n_items), radius)
        return
    rarity = Rarity(*_shared_shingles(items), n_items)
    elsewhere = benchmark.sparkSession.sparkContext.broadcast(rarity)
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Items([(r["item_id"], r["text"]) for r in mine.collect()], rarity, radius, elsewhere)


def _matches(texts: pa.Array, block: Items, least: float) -> Iterator[tuple[int, list[tuple[int, int, int, int, float]]]]:
    """(row, matches) for the rows that may have some."""
    for first, data, offsets in batch.runs(texts):
        words = batch.words(data, offsets, inside=WORD_BYTES)
        hashes = words.hashes()
        # Rows in which no shingle of the run is known need no closer look.
        known = np.zeros(len(hashes) + 1, bool)
        for n in {min(SHINGLE, s) for s in block.by_size}:
            known[: max(0, len(hashes) - n + 1)] |= block.known.places(batch.shingle_hashes(hashes, n)) >= 0
        for row in np.unique(np.searchsorted(words.first, np.flatnonzero(known), "right") - 1).tolist():
            yield first + row, block.matches(hashes[words.first[row] : words.first[row + 1]], least)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = RADIUS, block_chars: int = 2_000_000) -> DataFrame:
    """One row per document, item and place where a window of the item's size is similar enough.

    ``block_chars`` bounds the characters of items that tasks hold at a time; an item longer than that
    is a block of its own. It changes no result.
    """
    texts = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_column("text").alias("text"))

    def against(block: Items) -> DataFrame:
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                out = [(rows.column(0)[row].as_py(), *match) for row, matches in _matches(rows.column(1), block, least) for match in matches]
                columns = list(zip(*out, strict=True)) or [()] * len(_ARROW)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

        return texts.mapInArrow(found, SCHEMA)

    return reduce(DataFrame.unionAll, [against(block) for block in _blocks(benchmark, radius, block_chars)])


def without_benchmark(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = RADIUS, block_chars: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of the benchmark, one scan per block of items."""
    at = docs.columns.index("text")

    def clean_of(block: Items):  # noqa: ANN202
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                keep = np.ones(rows.num_rows, bool)
                for row, matches in _matches(rows.column(at), block, least):
                    keep[row] = not matches
                yield rows.filter(pa.array(keep))

        return clean

    for block in _blocks(benchmark, radius, block_chars):
        docs = mapped(bounded(docs), clean_of(block), docs.schema)
    return docs

"""Spelling variants: words one edit apart, found by a trie of letter-group counts, and the frequent word each leads to.

1. Words are counted with map-side sums; ``variant_words`` says what a word is.
2. A word's vector counts its letters in each of ``GROUPS`` groups (code point modulo ``GROUPS``). One inserted, deleted or replaced letter
   changes the vector by at most one surplus and one deficit of one each.
3. The vectors form a trie, a group's count a level. Nodes above ``most`` words are open: their children are units of work of their
   own, so that no unit has more words than that; a full vector with more is dealt into slices. A word lies in one unit, and is sent
   as a probe to every unit that its budget of one surplus and one deficit reaches.
4. A task sorts a unit's vectors, so a node of the trie is a range of rows, and searches depth first with all probes at once: each
   child takes those that can still pay for it. At a leaf, words that agree in their first or second half are compared in full.
5. The form of a word is its most frequent near word, if that is ``times`` as frequent; the root is reached by following forms, in steps that
   double.

``most`` is a thousandth of the words, 4,096 at least, so there are at most about a thousand open nodes per level whatever the input;
only they go through the driver. Probes stream through the tasks.

Null text has no words; a null doc_id reads as the empty text. Repeated rows count as often as they occur. Equal counts go to the smaller
word in code-point order. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm.shared import bounded, text_column, written

GROUPS = 12
#: Open nodes a level has at most, about.
OPEN_NODES = 1_024
LEAST_WORDS = 4_096
#: Probes that go through a unit together.
PROBES = 8_192
#: Leaves times probes below which a search does not descend further.
SMALL = 1_024
#: Letters of words, lower-cased: a-z and U+00C0-U+00FF.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Path = tuple[int, ...]


def variant_words(docs: DataFrame, least_letters: int = 6, least_times: int = 5, misspell: int | None = 199) -> DataFrame:
    """word, n: runs of letters of all texts, A-Z lower-cased, with at least ``least_letters`` letters and ``least_times`` places.

    With ``misspell``, where it divides the CRC-32 of ``<doc_id>:<run>``, one letter of the run is left out: known misspellings to find again.
    """
    lowered = F.translate(text_column("text"), _UPPER, _LOWER)
    letters = f"[a-zÀ-ÿ]{{{least_letters},}}"
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(F.regexp_extract_all(lowered, F.lit(letters), 0)).alias("run"))
    word = F.col("run")
    if misspell is not None:
        hashed = runs.withColumn("h", F.crc32(F.encode(F.concat("doc_id", F.lit(":"), "run"), "UTF-8")))
        shorter = F.expr("concat(substring(run, 1, cast(h % length(run) AS int)), substring(run, cast(h % length(run) AS int) + 2))")
        runs, word = hashed, F.when(F.col("h") % misspell == 0, shorter).otherwise(word)
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_times)


def _vectors(words: DataFrame) -> DataFrame:
    """``words`` with ``vec``, the letters in each group."""
    counts = []
    for g in range(GROUPS):
        own = "".join(c for c in LETTERS if ord(c) % GROUPS == g)
        counts.append(F.length("word") - F.length(F.translate("word", own, "")))
    return words.withColumn("vec", F.array(*counts))


def open_nodes(vectors: DataFrame, most: int) -> dict[Path, int]:
    """Paths of the trie's nodes with more than ``most`` words, and their words."""
    leaves = vectors.groupBy("vec").agg(F.count("*").alias("words"))
    nodes = leaves.select("words", F.explode(F.expr(f"transform(sequence(0, {GROUPS}), d -> slice(vec, 1, d))")).alias("path"))
    # Each level's nodes above ``most`` are fewer than words / most.
    rows = nodes.groupBy("path").agg(F.sum("words").alias("words")).where(F.col("words") > most).collect()
    return {tuple(r["path"]): r["words"] for r in rows}


def units(vec: Path, nodes: dict[Path, int], budget: int) -> list[Path]:
    """Units that ``vec`` reaches with a surplus and a deficit of ``budget`` each; with none, its own."""
    out, stack = [], [((), budget, budget)]
    while stack:
        path, surplus, deficit = stack.pop()
        if path not in nodes or len(path) == GROUPS:
            out.append(path)
            continue
        count = vec[len(path)]
        stack.append(((*path, count), surplus, deficit))
        if surplus:
            stack.append(((*path, count + 1), surplus - 1, deficit))
        if deficit and count:
            stack.append(((*path, count - 1), surplus, deficit - 1))
    return out


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class Unit:
    """The trie below one node: words by vector, vectors sorted."""

    def __init__(self, words: list[str], vectors: np.ndarray) -> None:
        self.words = words
        self.rows, of = np.unique(vectors, axis=0, return_inverse=True)
        self.members: list[list[int]] = [[] for _ in range(len(self.rows))]
        for k, row in enumerate(of.ravel()):
            self.members[row].append(k)
        self.halves: list[dict[tuple[bool, str], list[int]] | None] = [None] * len(self.rows)

    def leaves(self, probes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves of the trie with the probes that reach them, depth first."""
        everyone = np.arange(len(probes))
        stack = [(0, 0, len(self.rows), everyone, np.ones(len(probes), np.int8), np.ones(len(probes), np.int8))]
        while stack:
            depth, low, high, who, surplus, deficit = stack.pop()
            if depth == GROUPS:
                yield low, who
                continue
            if (high - low) * len(who) <= SMALL:
                yield from self._rest(depth, low, high, who, probes, surplus, deficit)
                continue
            level = self.rows[low:high, depth]
            cuts = [0, *(np.flatnonzero(level[1:] != level[:-1]) + 1), high - low]
            own = probes[who, depth]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                more = level[begin] - own
                able = (more == 0) | ((more == 1) & (surplus > 0)) | ((more == -1) & (deficit > 0))
                if able.any():
                    more = more[able]
                    stack.append((depth + 1, low + begin, low + end, who[able], surplus[able] - (more == 1), deficit[able] - (more == -1)))

    def _rest(self, depth: int, low: int, high: int, who: np.ndarray, probes: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The same for few leaves and probes: all that is left of their vectors at once."""
        more = self.rows[low:high, None, depth:] - probes[who, depth:]
        able = (np.maximum(more, 0).sum(2) <= surplus) & (np.maximum(-more, 0).sum(2) <= deficit)
        for k in np.flatnonzero(able.any(axis=1)):
            yield low + int(k), who[able[k]]

    def near(self, leaf: int, word: str) -> set[int]:
        """Words of the leaf one edit from ``word``: one of their halves is the same."""
        table = self.halves[leaf]
        if table is None:
            table = self.halves[leaf] = defaultdict(list)
            for k in self.members[leaf]:
                own = self.words[k]
                for half in {(len(own) - 1) // 2, len(own) // 2}:
                    table[True, own[:half]].append(k)
                    table[False, own[len(own) - half :]].append(k)
        half = min(len(word), len(self.words[self.members[leaf][0]])) // 2
        maybe = {*table.get((True, word[:half]), ()), *table.get((False, word[len(word) - half :]), ())}
        return {k for k in maybe if one_edit(word, self.words[k])}


def _pairs(unit: Unit, counts: list[int], probes: Iterable[tuple[str, Path]]) -> tuple[list[str], list[str], list[int]]:
    """word, near, n_of_near of the probes' near words in a unit."""
    by_vector: dict[Path, list[str]] = defaultdict(list)
    for word, vec in probes:
        by_vector[vec].append(word)
    groups = list(by_vector.values())
    found: tuple[list[str], list[str], list[int]] = ([], [], [])
    for leaf, who in unit.leaves(np.array(list(by_vector), np.int64).reshape(-1, GROUPS)):
        for g in who:
            for word in groups[g]:
                for k in unit.near(leaf, word):
                    found[0].append(word)
                    found[1].append(unit.words[k])
                    found[2].append(counts[k])
    return found


def near_words(words: DataFrame, most: int | None = None) -> DataFrame:
    """word, near, near_n: all pairs of words one edit apart, both ways. ``words`` has word, n, each word once."""
    vectors = _vectors(bounded(words))
    total = words.count()
    most = most or max(LEAST_WORDS, total // OPEN_NODES)
    nodes = open_nodes(vectors, most) if total > most else {}

    schema = pa.schema([("unit", pa.binary()), ("probe", pa.bool_()), ("word", pa.string()), ("n", pa.int64()), ("vec", pa.list_(pa.int32()))])

    def name(path: Path, part: int) -> bytes:
        return np.array([part, *path], np.int32).tobytes()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            at: list[int] = []
            unit: list[bytes] = []
            probe: list[bool] = []
            known: dict[Path, tuple[Path, list[Path]]] = {}
            for k, (word, vec) in enumerate(zip(rows.column(0).to_pylist(), map(tuple, rows.column(2).to_pylist()), strict=True)):
                if vec not in known:
                    known[vec] = (units(vec, nodes, 0)[0], units(vec, nodes, 1))
                home, reached = known[vec]
                # A full vector with too many words is dealt into slices.
                slices = -(-nodes[home] // most) if home in nodes else 1
                sent = [(home, zlib.crc32(word.encode()) % slices, False)]
                sent += [(path, part, True) for path in reached for part in range(-(-nodes[path] // most) if path in nodes else 1)]
                for path, part, asked in sent:
                    at.append(k)
                    unit.append(name(path, part))
                    probe.append(asked)
            chosen = pa.array(at, pa.int64())
            columns = [rows.column(c).take(chosen) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.binary()), pa.array(probe), columns[0], columns[1], columns[2].cast(pa.list_(pa.int32()))], schema=schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by unit, its own words first, probes by vector.
        current, words_of, counts, vecs, unit = None, [], [], [], None
        asked: list[tuple[str, Path]] = []

        def answer() -> pa.RecordBatch:
            nonlocal unit, asked
            if unit is None:
                unit = Unit(words_of, np.array(vecs, np.int64).reshape(-1, GROUPS))
            found = _pairs(unit, counts, asked)
            asked = []
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.string()), pa.array(found[2], pa.int64())], names=["word", "near", "near_n"])

        for rows in batches:
            for key, probe, word, n, vec in zip(*(rows.column(c).to_pylist() for c in range(5)), strict=True):
                if key != current:
                    if asked:
                        yield answer()
                    current, words_of, counts, vecs, unit = key, [], [], [], None
                if not probe:
                    words_of.append(word)
                    counts.append(n)
                    vecs.append(vec)
                elif words_of:
                    asked.append((word, tuple(vec)))
                    if len(asked) == PROBES:
                        yield answer()
        if asked:
            yield answer()

    sent = vectors.select("word", F.col("n").cast("long").alias("n"), "vec").mapInArrow(send, "unit binary, probe boolean, word string, n long, vec array<int>")
    return sent.repartition("unit").sortWithinPartitions("unit", "probe", "vec").mapInArrow(meet, "word string, near string, near_n long")


def variant_forms(words: DataFrame, times: int = 5, most: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of ``words`` (word, n)."""
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "variant-words")
    # The least of (-n, word) is the largest n, then the smallest word.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    formed = written(
        joined.select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain. Counts grow fivefold along a chain, so it is short, and steps double its reach."""
    roots = written(forms, "variant-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = written(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        roots = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, least_letters: int = 6, least_times: int = 5, times: int = 5, misspell: int | None = 199, most: int | None = None) -> DataFrame:
    """The variant forms of the words of ``docs``; ``variant_words`` and ``variant_forms`` say of what and how."""
    return variant_forms(variant_words(docs, least_letters, least_times, misspell), times, most)

"""Best-fit packing of tokenised documents by a linear grouping scheme.

1. Tasks tokenise the texts and cut what is longer than a sequence. Each piece knows its
   rank among the pieces of its length within its task.
2. The driver sees one number per length, at most ``max_tokens`` of them whatever the input.
   Large lengths fall into groups of equal cardinality and are rounded up to the longest
   of their group; configurations of these few sizes are filled one after the other, each the
   fullest around the largest size left. The actual lengths replace the rounded ones,
   and small pieces go where they fit best.
3. The plan says for each length which ranks go where. Its size depends on ``max_tokens``
   and the number of groups alone, so tasks get it whole and place their pieces by rank.

Nothing depends on which documents share a length, so a length that a third of all pieces
have is an ordinary row of the plan.

Null text is an empty text: one piece that holds the end id. Repeated rows are packed each
for itself, ties go by task and place, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.shared import bounded, text_column, written

CACHED_WORDS = 500_000

# Letters whose lower case is one letter and whose normal form is their own, then ASCII signs that
# begin no contraction and no special token: such a word is two pre-tokens at most, whatever stands around it.
_PLAIN = re.compile("([a-zà-öø-ÿ]*)([!\"#$%&()*+,\\-./:;=>?@\\[\\\\\\]^_`{}~]*)")


_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[97:123] = True


def _byte_letters() -> list[str]:
    """The letter by which byte-level models write each byte: printable ones by themselves, the others by letters from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256))
    return [chr(b) if b in printable else chr(256 + next(others)) for b in range(256)]


class _WordIds(dict):
    """Word -> place of its ids. Encoding never looks across white space, so words are encoded once and kept.

    ``plain`` says that the model's normaliser lower-cases and that letters and signs are
    pre-tokens of their own, so that plain words may go to the model directly. It is found
    by comparing both ways on sample words.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.plain = self.tokenizer.model, _byte_letters(), True
        self.forget()
        samples = ["reet", "reet,", "Reet.", "élan", "straße!!", "a&&&", ".", "x(%)", "ñandú###", "ÉTÉ"]
        self.plain = all(self._plain_ids(w) in (None, self._library_ids(w)) for w in samples)

    def forget(self) -> None:
        """Begin a new generation; words of the one before are taken over when they occur again."""
        self.before, self.before_ids = dict(self), (self.ids, self.starts, self.lengths) if self else None
        self.clear()
        self.ids, self.starts, self.lengths = array("I"), array("q"), array("q")

    def _library_ids(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _plain_ids(self, word: str) -> list[int] | None:
        match = _PLAIN.fullmatch(word.lower())
        if match is None:
            return None
        letters, signs = match.groups()
        if not letters.isascii():
            letters = "".join([self.letters[b] for b in letters.encode()])
        return [t.id for part in (letters, signs) if part for t in self.model.tokenize(part)]

    def __missing__(self, word: bytes) -> int:
        known = self.before.get(word)
        if known is not None:
            old_ids, old_starts, old_lengths = self.before_ids
            ids = old_ids[old_starts[known] : old_starts[known] + old_lengths[known]]
        elif self.plain and word.isalpha() and word.islower():  # of bytes: ASCII letters
            ids = [t.id for t in self.model.tokenize(word.decode())]
        else:
            text = word.decode()
            ids = self._plain_ids(text) if self.plain else None
            if ids is None:
                ids = self._library_ids(text)
        place = self[word] = len(self.starts)
        self.starts.append(len(self.ids))
        self.lengths.append(len(ids))
        self.ids.extend(ids)
        return place

    @staticmethod
    def _spaced(texts: list[bytes]) -> list[bytes]:
        """The texts in small letters, with a space before a full stop or comma that ends a word of ASCII letters or digits.

        Both make fewer different words and change no id: the model lower-cases, and such a sign is a pre-token of
        its own. Texts that may hold a special token, which is found before that, stay as they are.
        """
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        lowered = batch.LOWER[data]
        if len(data) < 3:
            return texts
        ends = np.append(batch.SPACE[lowered[2:]], True)
        mark = np.flatnonzero(((lowered[1:] == 44) | (lowered[1:] == 46)) & _ALNUM[lowered[:-1]] & ends) + 1
        spaced = np.insert(lowered, mark, 32).tobytes()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        edges = np.concatenate([[0], np.cumsum(lengths)])
        edges += np.searchsorted(mark, edges)
        return [t if b"<|" in t else spaced[a : b - 1] for t, a, b in zip(texts, edges.tolist(), edges[1:].tolist(), strict=False)]

    def encode(self, texts: list[bytes], end_id: int) -> list[np.ndarray]:
        if len(self) > CACHED_WORDS:
            self.forget()
        split = [t.split() for t in (self._spaced(texts) if self.plain else texts)]
        places = [np.fromiter(map(self.__getitem__, own), np.int64, len(own)) for own in split]
        # An array may not grow while numpy looks at it; these views end with the call.
        all_ids, starts, all_lengths = (np.frombuffer(x, x.typecode) if len(x) else np.zeros(0, x.typecode) for x in (self.ids, self.starts, self.lengths))
        out = []
        for at in places:
            lengths = all_lengths[at]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(at) else 0
            ids = np.empty(total + 1, np.uint32)
            ids[:total] = all_ids[np.repeat(starts[at] - ends + lengths, lengths) + np.arange(total)]
            ids[total] = end_id
            out.append(ids)
        return out


_tokenizers: dict[str, _WordIds] = {}


def _word_ids(path: str) -> _WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = _WordIds(path)
    return _tokenizers[path]


def tokenised_pieces(docs: DataFrame, tokenizer: str, max_tokens: int, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, task, rank (within task and length); ids if asked for."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("rank", pa.int64())]
    fields += [("ids", pa.list_(pa.int64()))] * with_ids
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _word_ids(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, np.int64)
        for arrived in batches:
            for first in range(0, arrived.num_rows, 256):
                part = arrived.slice(first, 256)
                doc_ids, rows = part.column(0).to_pylist(), []
                for doc_id, ids in zip(doc_ids, encoder.encode(part.column(1).to_pylist(), end_id), strict=True):
                    for k, start in enumerate(range(0, len(ids), max_tokens)):
                        own = ids[start : start + max_tokens]
                        rows.append((doc_id, k, start, len(own), zlib.crc32(own.astype("<u4").tobytes()), task, int(seen[len(own)]), *[own.astype(np.int64)] * with_ids))
                        seen[len(own)] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long" + ", ids array<long>" * with_ids
    return bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(text_column("text"), "UTF-8").alias("text")).mapInArrow(cut, kinds)


class _Plan:
    """Placements by length and rank, and runs of bins with equal room left."""

    def __init__(self, counts: np.ndarray, capacity: int) -> None:
        self.left, self.next_rank, self.capacity = counts.copy(), np.zeros(len(counts), np.int64), capacity
        self.bins = 0
        self.rows: list[tuple[int, int, int, int, int, int]] = []  # length, first rank, end rank, first bin, pieces a bin, offset
        self.open: dict[int, list[tuple[int, int]]] = {}  # room left -> (first bin, bins)
        self.rooms = 0  # bit r: there are bins with r left

    def place(self, length: int, pieces: int, first_bin: int, a_bin: int, offset: int) -> None:
        rank = int(self.next_rank[length])
        self.rows.append((length, rank, rank + pieces, first_bin, a_bin, offset))
        self.next_rank[length] += pieces
        self.left[length] -= pieces

    def add_open(self, room: int, first_bin: int, bins: int) -> None:
        if room and bins:
            self.open.setdefault(room, []).append((first_bin, bins))
            self.rooms |= 1 << room

    def take_open(self, least: int) -> tuple[int, int, int] | None:
        """The tightest bins with room for ``least``: room, first bin, bins."""
        above = self.rooms >> least
        if not above:
            return None
        room = least + (above & -above).bit_length() - 1
        first_bin, bins = self.open[room].pop()
        if not self.open[room]:
            self.rooms ^= 1 << room
        return room, first_bin, bins


def _fullest(sizes: list[int], left: list[int], room: int) -> dict[int, int]:
    """How many of each size fill ``room`` best, by subset sums; sizes are descending."""
    reach, layers = 1, []
    limit = (1 << (room + 1)) - 1
    for size, n in zip(sizes, left, strict=True):
        layers.append(reach)
        step = reach
        for _ in range(min(n, room // size)):
            step = (step << size) & limit
            reach |= step
    total, chosen = reach.bit_length() - 1, {}
    for k in range(len(sizes) - 1, -1, -1):
        while not layers[k] >> total & 1:
            chosen[k] = chosen.get(k, 0) + 1
            total -= sizes[k]
    return chosen


def packing_plan(counts: np.ndarray, capacity: int, groups: int = 48, small_share: float = 0.125) -> tuple[np.ndarray, int]:
    """Placements (length, first rank, end rank, first bin, pieces a bin, offset) for ``counts[length]`` pieces, and the number of bins."""
    plan = _Plan(counts, capacity)
    full = int(counts[capacity])
    if full:
        plan.place(capacity, full, 0, 1, 0)
        plan.bins = full
    least = max(1, int(capacity * small_share))
    # Groups of equal cardinality, longest first: segments (length, pieces) of each.
    total = int(counts[least:capacity].sum())
    size = -(-total // groups) if total else 0
    grouped: list[list[list[int]]] = []
    room = 0
    for length in range(capacity - 1, least - 1, -1):
        n = int(counts[length])
        while n:
            if not room:
                grouped.append([])
                room = size
            some = min(n, room)
            grouped[-1].append([length, some])
            n, room = n - some, room - some
    sizes = [g[0][0] for g in grouped]
    left = [sum(n for _, n in g) for g in grouped]
    while any(left):
        lead = next(k for k, n in enumerate(left) if n)
        left[lead] -= 1
        chosen = _fullest(sizes, left, capacity - sizes[lead])
        left[lead] += 1
        chosen[lead] = chosen.get(lead, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        slots = []
        for k, n in sorted(chosen.items()):
            left[k] -= n * times
            for _ in range(n):
                slots.append(_taken(grouped[k], times))
        done = 0
        while done < times:
            same = min(slot[-1][1] for slot in slots)
            offset = 0
            for slot in slots:
                plan.place(slot[-1][0], same, plan.bins, 1, offset)
                offset += slot[-1][0]
                slot[-1][1] -= same
                if not slot[-1][1]:
                    slot.pop()
            plan.add_open(capacity - offset, plan.bins, same)
            plan.bins += same
            done += same
    for length in range(least - 1, 0, -1):
        while n := int(plan.left[length]):
            found = plan.take_open(length)
            room, first_bin, bins = found or (capacity, plan.bins, -(-n // (capacity // length)))
            if not found:
                plan.bins += bins
            a_bin = room // length
            whole = min(bins, n // a_bin)
            offset = capacity - room
            if whole:
                plan.place(length, whole * a_bin, first_bin, a_bin, offset)
                plan.add_open(room - a_bin * length, first_bin, whole)
            rest = n - whole * a_bin
            if whole < bins:
                if rest:
                    plan.place(length, rest, first_bin + whole, a_bin, offset)
                    plan.add_open(room - rest * length, first_bin + whole, 1)
                plan.add_open(room, first_bin + whole + bool(rest), bins - whole - bool(rest))
    rows = np.array(plan.rows, np.int64).reshape(-1, 6)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))], plan.bins


def _taken(group: list[list[int]], pieces: int) -> list[list[int]]:
    """The longest ``pieces`` of a group as segments, last first; the group keeps the rest."""
    out = []
    while pieces:
        some = min(group[0][1], pieces)
        out.append([group[0][0], some])
        group[0][1] -= some
        pieces -= some
        if not group[0][1]:
            group.pop(0)
    return out[::-1]


def best_fit_packing(docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1, groups: int = 48, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; ids (longs) with ``with_ids``.

    ``docs`` has doc_id and text; ``tokenizer`` is a file of the tokenizers library which tasks can
    open. Sequences are filled from offset 0 without gaps.
    """
    pieces = written(tokenised_pieces(docs, tokenizer, max_tokens, end_id, with_ids), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-offsets")
    counts = np.zeros(max_tokens + 1, np.int64)
    for row in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most max_tokens rows
        counts[row["length"]] = row["n"]
    plan, _ = packing_plan(counts, max_tokens, groups)

    # One key for length and rank: ranks stay far below 2**48.
    keys = (plan[:, 0] << 48) + plan[:, 1]
    names = [f.name for f in pieces.schema if f.name not in ("task", "rank")]
    out = pieces.select(*names).schema.add("sequence_id", "long").add("offset", "long")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            length, rank = (rows.column(k).to_numpy(zero_copy_only=False) for k in ("length", "at"))
            row = plan[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            place = rank - row[:, 1]
            sequence, offset = row[:, 3] + place // row[:, 4], row[:, 5] + place % row[:, 4] * length
            yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"])

    at = pieces.join(offsets.select("task", "length", "before").hint("merge"), ["task", "length"]).withColumn("at", F.col("rank") + F.col("before"))
    return at.select(*names, "at").mapInArrow(placed, out)

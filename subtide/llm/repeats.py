"""Long repeats of byte strings across and within texts, by enhanced suffix arrays around anchors.

A string of ``least`` bytes that occurs twice holds the same anchor at the same relative place: the
first smallest hash among its substrings of ``GRAM`` bytes. So occurrences of repeats meet under
their anchor's hash, and suffixes need sorting among those only.

1. Tasks slide over every text and find runs of windows (strings of ``least`` bytes) with the same anchor.
   The bytes that a run's windows cover are its context. Anchors that occur once drop out.
2. Equal contexts of an anchor are one class, counted before anything else meets, so a group of copies is one
   row by then. A class that occurs twice repeats as a whole.
3. Where an anchor has several classes, one context of each is taken from its text. The suffixes from the anchor on
   are sorted, neighbours' common prefixes form the array that a stack scan turns into the tree of common-prefix
   intervals. At each interval the texts before the anchor, sorted backwards, are scanned likewise:
   a set of occurrences that extends left by m bytes, and whose members lie in different
   children of an interval of depth r, is a maximal repeat of m + r bytes with all its occurrences.
4. Anchors with more than ``bucket`` classes do not go to one task. Their windows are counted by a 128-bit hash of
   their bytes: the common-prefix intervals of depth ``least``, without the part of the tree above.

Repeats are maximal within the context of their anchor: a longer one appears as a chain of overlapping
groups, whose union is what ``repeated_spans`` returns.

Null text is an empty text. Texts are told apart by their MD5, so repeated rows and copies are counted and get
the same spans. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.shared import bounded, split_join, text_column, written

GRAM = 96
BUCKET = 32_768
_PLACE_BITS = 24
_SLICE = 1 << 20


class Runs:
    """Runs of windows with the same anchor: row, first window, end of the last window, place of the anchor and its hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int, gram: int) -> None:
        self.data, self.offsets = data, offsets
        parts = []
        # Slices overlap by a window less a byte; hashes and places stay comparable between them.
        for a in range(0, max(1, len(data)), _SLICE):
            parts.append(self._slice(a, min(len(data), a + _SLICE + least - 1), least, gram))
        self.first, self.end, self.place, self.anchor = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.row = np.searchsorted(offsets, self.first, "right") - 1

    def _slice(self, a: int, b: int, least: int, gram: int) -> tuple[np.ndarray, ...]:
        data, none = self.data[a:b], np.zeros(0, np.int64)
        n, width = len(data), least - gram + 1
        if n < least:
            return none, none, none, none.astype(np.uint64)
        grams = np.arange(n - gram + 1)
        hashes = batch.span_hashes(batch.prefix_sums(data), grams, grams + gram)
        keyed = (hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | grams.astype(np.uint64)
        windows = n - least + 1
        # Sliding minimum by running minima of blocks, forwards and backwards.
        blocks = -(-len(keyed) // width)
        padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(keyed)] = keyed
        padded = padded.reshape(blocks, width)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows]) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        # Windows within one row; a window that begins in the next slice is found there.
        row_first, row_end = np.maximum(self.offsets[:-1], a) - a, np.minimum(self.offsets[1:], b) - a
        long = row_end - row_first >= least
        change = np.zeros(n + 2, np.int64)
        np.add.at(change, row_first[long], 1)
        np.add.at(change, row_end[long] - least + 1, -1)
        window = np.flatnonzero(np.cumsum(change)[:windows] > 0)
        if not len(window):
            return none, none, none, none.astype(np.uint64)
        new = np.ones(len(window), bool)
        new[1:] = (window[1:] != window[:-1] + 1) | (place[window[1:]] != place[window[:-1]])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(window)) - 1
        at = place[window[begin]]
        return window[begin] + a, window[last] + least + a, at + a, hashes[at]

    def context(self, k: int) -> bytes:
        return self.data[self.first[k] : self.end[k]].tobytes()

    def class_hash(self, k: int) -> int:
        """Hash of a context and the anchor's place in it."""
        digest = hashlib.blake2b(self.context(k), digest_size=8, salt=int(self.place[k] - self.first[k]).to_bytes(8, "little"))
        return int.from_bytes(digest.digest(), "little", signed=True)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def prefix_intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """(depth, first, last) of the common-prefix intervals of a sorted array, by a stack scan.

    ``lcp[i]`` is the common prefix of entries i - 1 and i; children come before their parents.
    """
    out, stack = [], [(0, 0)]
    for i in range(1, len(lcp) + 1):
        depth, left = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack and stack[-1][0] > depth:
            top, left = stack.pop()
            # The whole array is an interval of depth 0 only if some neighbours differ at once.
            if top >= least and left < i - 1 and (top or 0 in lcp[1:]):
                out.append((top, left, i - 1))
        if not stack or stack[-1][0] < depth:
            stack.append((depth, left))
    return out


def _scan(entries: list[bytes], least: int) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
    order = sorted(range(len(entries)), key=entries.__getitem__)
    lcp = [0, *(common_prefix(entries[a], entries[b]) for a, b in zip(order, order[1:], strict=False))]
    return order, lcp, prefix_intervals(lcp, least)


def maximal_groups(contexts: list[tuple[bytes, int]], least: int) -> list[tuple[int, int, list[int]]]:
    """(bytes before the anchor, bytes from it on, members) of all maximal repeats around one anchor.

    ``contexts`` are distinct: bytes and the anchor's place.
    """
    after = [c[at:] for c, at in contexts]
    before = [c[:at][::-1] for c, at in contexts]
    order, lcp, intervals = _scan(after, 1)
    found = []
    for depth, first, last in intervals:
        members = order[first : last + 1]
        # Children of the interval: cut where the common prefix is no longer than the interval's.
        child, number = {}, 0
        for i in range(first, last + 1):
            number += i > first and lcp[i] == depth
            child[order[i]] = number
        left_order, _, lefts = _scan([before[k] for k in members], max(0, least - depth))
        for m, a, b in lefts:
            own = [members[k] for k in left_order[a : b + 1]]
            if m + depth >= least and len({child[k] for k in own}) > 1:
                found.append((m, depth, sorted(own)))
    return found


def _classes(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """One row per text and class: tid, anchor, class, occurrences in the text, bytes of the context."""
    schema = pa.schema([("tid", pa.binary()), ("anchor", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("size", pa.int32())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, data, offsets in batch.runs(rows.column(1)):
                runs = Runs(data, offsets, least, gram)
                own = np.array([runs.class_hash(k) for k in range(len(runs.row))], np.int64)
                anchor = runs.anchor.view(np.int64)
                order = np.lexsort((own, anchor, runs.row))
                row, anchor, own, size = runs.row[order], anchor[order], own[order], (runs.end - runs.first)[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(row)))
                tid = rows.column(0).slice(first).take(pa.array(row[at]))
                yield pa.RecordBatch.from_arrays([tid.cast(pa.binary()), pa.array(anchor[at]), pa.array(own[at]), pa.array(n.astype(np.int32)), pa.array(size[at].astype(np.int32))], schema=schema)

    return docs.select("tid", "text").mapInArrow(emit, "tid binary, anchor long, class long, n int, size int")


def _anchors_that_repeat(docs: DataFrame, least: int, gram: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for _, data, offsets in batch.runs(rows.column(0)):
                anchor, n = np.unique(Runs(data, offsets, least, gram).anchor.view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    counts = docs.select("text").mapInArrow(count, "anchor long, n long")
    return counts.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor")


def _contexts(texts: DataFrame, wanted: DataFrame, least: int, gram: int) -> DataFrame:
    """anchor, class, context, place of the anchor in it, for the (anchor, class) pairs wanted of each text."""
    schema = pa.schema([("anchor", pa.int64()), ("class", pa.int64()), ("n", pa.int64()), ("n_classes", pa.int64()), ("context", pa.binary()), ("place", pa.int32())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lists = rows.column(1)
            for first, data, offsets in batch.runs(rows.column(0)):
                runs = Runs(data, offsets, least, gram)
                wanted_of = [{(w["anchor"], w["class"]): (w["n"], w["n_classes"]) for w in lists[first + r].as_py()} for r in range(len(offsets) - 1)]
                anchors_of = [{a for a, _ in w} for w in wanted_of]
                anchors, out = runs.anchor.view(np.int64).tolist(), []
                for k, row in enumerate(runs.row.tolist()):
                    if anchors[k] in anchors_of[row]:
                        found = wanted_of[row].pop((anchors[k], own := runs.class_hash(k)), None)
                        if found:
                            out.append((anchors[k], own, *found, runs.context(k), int(runs.place[k] - runs.first[k])))
                columns = list(zip(*out, strict=True)) or [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    lists = wanted.groupBy(F.col("rep").alias("tid")).agg(F.collect_list(F.struct("anchor", "class", "n", "n_classes")).alias("wanted"))
    return texts.join(lists, "tid").select("text", "wanted").mapInArrow(take, "anchor long, class long, n long, n_classes long, context binary, place int")


_GROUP = pa.struct([("group", pa.string()), ("start", pa.int32()), ("length", pa.int32())])
_FOUND_SCHEMA = "anchor long, class long, found array<struct<group:string,start:int,length:int>>"
_FOUND_ARROW = pa.schema([("anchor", pa.int64()), ("class", pa.int64()), ("found", pa.list_(_GROUP))])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans covered by the given ones, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _tree_groups(contexts: DataFrame, least: int, by_group: bool) -> DataFrame:
    """Per class the maximal repeats it is in, or the merged spans that they cover; contexts of an anchor meet in one task."""

    def bucket_rows(anchor: int, bucket: list[tuple[int, bytes, int]]) -> Iterator[tuple[int, int, list]]:
        found: dict[int, list[tuple[str, int, int]]] = {}
        for before, after, members in maximal_groups([(c, at) for _, c, at in bucket], least):
            first = bucket[members[0]]
            text = first[1][first[2] - before : first[2] + after]
            group = hashlib.blake2b(text, digest_size=12).hexdigest() if by_group else ""
            for k in members:
                own, one = found.setdefault(k, []), (group, bucket[k][2] - before, before + after)
                if by_group or not own:
                    own.append(one)
                else:
                    own[:] = [("", a, b - a) for a, b in merged([(s, s + n) for _, s, n in [*own, one]])]
        for k, own in found.items():
            yield anchor, bucket[k][0], [dict(zip(("group", "start", "length"), g, strict=True)) for g in own]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, list]] = []
        bucket: list[tuple[int, bytes, int]] = []
        current = None

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(_FOUND_ARROW)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)

        for rows in batches:
            for anchor, own, context, place in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if anchor != current:
                    out.extend(bucket_rows(current, bucket))
                    current, bucket = anchor, []
                    if len(out) > 5_000:
                        yield batch_of(out)
                        out = []
                bucket.append((own, context, place))
        out.extend(bucket_rows(current, bucket))
        yield batch_of(out)

    columns = contexts.select("anchor", "class", "context", "place")
    return columns.repartition("anchor").sortWithinPartitions("anchor", "class").mapInArrow(scan, _FOUND_SCHEMA)


def _window_groups(contexts: DataFrame, least: int) -> DataFrame:
    """Repeats of exactly ``least`` bytes in contexts of crowded anchors, met by a hash of their bytes."""
    schema = pa.schema([("anchor", pa.int64()), ("class", pa.int64()), ("group", pa.string()), ("start", pa.int32())])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for anchor, own, context in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                starts = range(len(context) - least + 1)
                groups = [hashlib.blake2b(context[s : s + least], digest_size=16).hexdigest() for s in starts]
                n = len(groups)
                yield pa.RecordBatch.from_arrays([pa.array([anchor] * n, pa.int64()), pa.array([own] * n, pa.int64()), pa.array(groups, pa.string()), pa.array(starts, pa.int32())], schema=schema)

    every = contexts.select("anchor", "class", "context").mapInArrow(windows, "anchor long, class long, group string, start int")
    repeated = every.groupBy("group").agg(F.count("*").alias("classes")).where("classes > 1").select("group")
    one = F.struct("group", "start", F.lit(least).alias("length"))
    return every.join(repeated, "group").groupBy("anchor", "class").agg(F.collect_list(one).alias("found"))


def _prepared(docs: DataFrame) -> DataFrame:
    text = text_column("text")
    return bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(text, "UTF-8").alias("text"), F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("tid"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("tid").agg(F.first("text").alias("text"))


def _repeat_classes(docs: DataFrame, least: int, gram: int, bucket: int, by_group: bool) -> tuple[DataFrame, DataFrame]:
    """Classes of anchors that occur twice, by text; and the repeats found in each class."""
    live = written(split_join(_classes(docs, least, gram), _anchors_that_repeat(docs, least, gram), ["anchor"]), "repeat-classes")
    classes = live.groupBy("anchor", "class").agg(F.sum("n").alias("n"), F.min("tid").alias("rep"), F.first("size").alias("size"))
    classes = written(classes, "repeat-class-counts")
    several = classes.groupBy("anchor").agg(F.count("*").alias("n_classes")).where("n_classes > 1")
    wanted = split_join(classes, several, ["anchor"])
    contexts = written(_contexts(_texts(docs), wanted, least, gram), "repeat-contexts")
    one = F.struct(F.concat(F.hex("anchor"), F.hex("class")).alias("group"), F.lit(0).alias("start"), F.col("size").alias("length"))
    whole = classes.where("n > 1").select("anchor", "class", F.array(one).alias("found"))
    groups = whole.unionByName(_tree_groups(contexts.where(F.col("n_classes") <= bucket), least, by_group))
    crowded = contexts.where(F.col("n_classes") > bucket)
    if not crowded.isEmpty():
        groups = groups.unionByName(_window_groups(crowded, least))
    return live, groups


_SPANS = "tid binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
_SPANS_ARROW = pa.schema(
    [("tid", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    + [("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)


def maximal_repeats(docs: DataFrame, least: int = 400, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """One row per group of repeats and class of occurrences: group, length, anchor, class, start in the context, texts, occurrences."""
    live, groups = _repeat_classes(_prepared(docs), least, gram, bucket, by_group=True)
    counts = live.groupBy("anchor", "class").agg(F.count_distinct("tid").alias("texts"), F.sum("n").alias("occurrences"))
    each = groups.select("anchor", "class", F.inline("found"))
    return split_join(each, counts, ["anchor", "class"]).select("group", "length", "anchor", "class", "start", "texts", "occurrences")


def repeated_spans(docs: DataFrame, least: int = 400, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """Per document the maximal byte spans covered by strings of ``least`` bytes that also start elsewhere, and what is left without them.

    Columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (array of struct(start, end)).
    """
    prepared = _prepared(docs)
    live, groups = _repeat_classes(prepared, least, gram, bucket, by_group=False)
    covered = groups.groupBy("anchor", "class").agg(F.flatten(F.collect_list(F.transform("found", lambda g: F.struct(g["start"].alias("start"), g["length"].alias("length"))))).alias("spans"))
    by_text = split_join(live.select("tid", "anchor", "class").distinct(), covered, ["anchor", "class"]).groupBy("tid").agg(F.collect_list(F.struct("anchor", "class", "spans")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first in range(0, rows.num_rows, 128):
                yield cut_rows(rows.slice(first, 128))

    def cut_rows(rows: pa.RecordBatch) -> pa.RecordBatch:
        found, out = rows.column(2), []
        for first, data, offsets in batch.runs(rows.column(1)):
            known = [{(f["anchor"], f["class"]): [(s["start"], s["length"]) for s in f["spans"]] for f in found[first + r].as_py() or ()} for r in range(len(offsets) - 1)]
            spans: list[list[tuple[int, int]]] = [[] for _ in known]
            if any(known):
                runs = Runs(data, offsets, least, gram)
                anchors_of = [{a for a, _ in k} for k in known]
                anchors = runs.anchor.view(np.int64).tolist()
                for k, row in enumerate(runs.row.tolist()):
                    if anchors[k] in anchors_of[row]:
                        base = int(runs.first[k] - offsets[row])
                        spans[row] += [(base + start, base + start + length) for start, length in known[row].get((anchors[k], runs.class_hash(k)), ())]
            for r, own in enumerate(map(merged, spans)):
                text = data[offsets[r] : offsets[r + 1]].tobytes()
                digest, at = hashlib.sha256(), 0
                for a, b in own:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                out.append((rows.column(0)[first + r].as_py(), len(text), sum(b - a for a, b in own), len(own), digest.hexdigest(), [{"start": a, "end": b} for a, b in own]))
        columns = list(zip(*out, strict=True)) or [()] * len(_SPANS_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPANS_ARROW, strict=True)], schema=_SPANS_ARROW)

    # Each text is cut once; its copies take the result.
    by_content = _texts(prepared).join(by_text, "tid", "left").select("tid", "text", "found").mapInArrow(cut, _SPANS)
    return prepared.select("doc_id", "tid").join(by_content, "tid").drop("tid")

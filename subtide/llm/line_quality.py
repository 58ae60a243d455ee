"""Quality rules: counts of each text, and lines that too many documents of a host share.

Words are ``[^\\x20\\x09-\\x0D]+``. A document fails the base rules with fewer than 10 words, or if more than a fifth of
its words stand in windows of 5 words that occur twice in it.

1. Lines are normalised (A-Z lower-cased, words joined by one space) and hashed.
2. Per host and line, distinct texts are counted, so a group of copies counts once. A line of any length is boilerplate if
   more than ``min_documents`` texts and more than ``min_share`` of the host's distinct texts have it.
3. Boilerplate lines are removed. A document left with less than ``min_left`` of its words is depleted and rejected.

Counts are summed before every shuffle, so a line or a host that a third of all documents have is a few rows a task.

Null text has no words and fails. Null host is a host of its own. Repeated rows count once and each get the result; an
empty table gives no rows; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.shared import bounded, mapped, quoted, text_column, unused, written

WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the lines between newlines; rows without bytes have none."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    newline = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([np.flatnonzero(edge)[:-1], newline + 1]))
    starts = starts[starts < len(data)]
    rows = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.append(newline, len(data))
    ends = np.minimum(offsets[rows + 1], breaks[np.searchsorted(breaks, starts)])
    return rows, starts, ends


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by their keys, and which rows in it are the first of their keys."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, new


def text_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Base counts of each row; and row, hash and words of each row's distinct normalised lines, all places summed."""
    n = len(offsets) - 1
    found = batch.words(data, offsets, lower=False)
    lowered = batch.words(data, offsets).hashes()
    hashes, rows = found.hashes(), found.rows()
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    counts = {
        "n_words": np.diff(found.first),
        "word_chars": np.bincount(rows, letters[found.ends] - letters[found.starts], n).astype(np.int64),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
    }
    line_row, line_start, line_end = _line_spans(data, offsets)
    first_word, end_word = np.searchsorted(found.starts, line_start), np.searchsorted(found.starts, line_end)
    some = end_word > first_word
    line_row, line_start, line_end, first_word, end_word = (x[some] for x in (line_row, line_start, line_end, first_word, end_word))
    order, new = _firsts(line_row, batch.span_hashes(batch.prefix_sums(data), line_start, line_end))
    counts["n_dup_lines"] = np.bincount(line_row[order[~new]], minlength=n)
    # Windows within one row that occur twice in it; a word counts once however many of them hold it.
    windows = batch.shingle_hashes(hashes, WINDOW)
    at = np.flatnonzero(rows[: len(windows)] == rows[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    order, new = _firsts(rows[at], windows[at])
    group = np.cumsum(new) - 1
    twice = at[order[np.bincount(group, minlength=1)[group] > 1]] if len(at) else at
    change = np.zeros(len(rows) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + WINDOW, -1)
    counts["n_repeat_words"] = np.bincount(rows[np.cumsum(change[:-1]) > 0], minlength=n)
    lines = batch.span_hashes(batch.prefix_sums(lowered), first_word, end_word)
    order, new = _firsts(line_row, lines)
    begin = np.flatnonzero(new)
    words = np.add.reduceat((end_word - first_word)[order], begin) if len(begin) else begin
    return counts, (line_row[order[begin]], lines[order[begin]].view(np.int64), words)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _counted(docs: DataFrame) -> DataFrame:
    """doc_id, host, two hashes of the text, base counts, lines: array of struct(line, words)."""
    line = pa.struct([("line", pa.int64()), ("words", pa.int32())])
    keep = [("doc_id", pa.int64()), ("host", pa.string()), ("t1", pa.int64()), ("t2", pa.int64())]
    schema = pa.schema([*keep, *((c, pa.int64()) for c in _COUNTS), ("lines", pa.list_(line))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, data, offsets in batch.runs(rows.column("text")):
                counts, (line_row, hashes, words) = text_counts(data, offsets)
                n = len(offsets) - 1
                lines = pa.StructArray.from_arrays([pa.array(hashes), pa.array(words.astype(np.int32))], fields=list(line))
                ends = np.searchsorted(line_row, np.arange(n + 1))
                own = rows.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(k).cast(t) for k, t in keep), *(pa.array(counts[c].astype(np.int64)) for c in _COUNTS), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)],
                    schema=schema,
                )

    text = text_column("text")
    chosen = bounded(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text")
    )
    kinds = ", ".join(["doc_id long", "host string", "t1 long", "t2 long", *(f"{c} long" for c in _COUNTS), "lines array<struct<line:long,words:int>>"])
    return chosen.mapInArrow(count, kinds)


def _boilerplate(counted: DataFrame, min_documents: int, min_share: float) -> DataFrame:
    """host, t1, t2, line, words: the boilerplate lines of each text."""
    by_text = counted.select("host", "t1", "t2", F.inline("lines")).distinct()
    hosts = counted.select("host", "t1", "t2").distinct().groupBy("host").agg(F.count("*").alias("documents"))
    frequent = by_text.groupBy("host", "line").agg(F.count("*").alias("texts")).where(F.col("texts") > min_documents)
    frequent = frequent.join(hosts.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of"))).where(F.col("texts") > min_share * F.col("documents"))
    frequent = frequent.select(F.col("host").alias("of"), F.col("line").alias("frequent"))
    return by_text.join(frequent, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("frequent"))).drop("of", "frequent")


def quality_verdicts(docs: DataFrame, min_documents: int = 20, min_share: float = 0.001, min_left: float = 0.2) -> DataFrame:
    """Per document: doc_id, base counts, n_boilerplate_words, base_failed, kept; with host, t1, t2 and ``boilerplate``, the hashes of its boilerplate lines."""
    counted = written(_counted(docs), "line-counts")
    lines = _boilerplate(counted, min_documents, min_share)
    per_text = lines.groupBy(F.col("host").alias("of"), F.col("t1").alias("o1"), F.col("t2").alias("o2")).agg(F.sum("words").alias("gone"), F.collect_list("line").alias("boilerplate"))
    same = F.col("host").eqNullSafe(F.col("of")) & (F.col("t1") == F.col("o1")) & (F.col("t2") == F.col("o2"))
    joined = counted.drop("lines").join(per_text, same, "left").withColumn("n_boilerplate_words", F.coalesce("gone", F.lit(0)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_boilerplate_words")
    return joined.select(
        "doc_id", *_COUNTS, "n_boilerplate_words", failed.alias("base_failed"), (~failed & (left >= min_left * F.col("n_words"))).alias("kept"), "host", "t1", "t2", "boilerplate"
    )


def without_low_quality(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of ``docs`` that are kept, their boilerplate lines removed; n_chars, if there is one, is counted anew."""
    names = docs.columns
    of, one, two, cut = unused(names, "of", "one", "two", "cut")
    verdicts = quality_verdicts(docs, **limits).where("kept").select("host", "t1", "t2", "boilerplate").dropDuplicates(["host", "t1", "t2"]).toDF(of, one, two, cut)
    text = text_column("text")
    same = F.col("source").cast("string").eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(one)) & (F.xxhash64(F.lit(1), text) == F.col(two))
    kept = docs.join(verdicts, same).select(*map(quoted, names), cut)
    at, own = names.index("text"), len(names)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column(at).to_pylist()
            listed = rows.column(own).to_pylist()
            for k, lines in enumerate(listed):
                if lines:
                    texts[k] = without_lines(texts[k], set(lines))
            columns = [*rows.columns[:own]]
            columns[at] = pa.array(texts, rows.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names[:own])

    cleaned = mapped(kept, clean, docs.schema)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else cleaned


def without_lines(text: str, hashes: set[int]) -> str:
    """The text without lines whose normalised hash is one of ``hashes``."""
    lines = text.split("\n")
    own = [None] * len(lines)
    for first, data, offsets in batch.runs(pa.array(lines, pa.string())):
        found = batch.words(data, offsets)
        hashed = batch.span_hashes(batch.prefix_sums(found.hashes()), found.first[:-1], found.first[1:]).view(np.int64)
        for k in range(len(offsets) - 1):
            if found.first[k + 1] > found.first[k]:
                own[first + k] = int(hashed[k])
    return "\n".join(line for line, h in zip(lines, own, strict=True) if h is None or h not in hashes)

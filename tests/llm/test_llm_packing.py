"""Packing: token ids against the library, plans against their rules."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from subtide.llm.packing import _word_ids, best_fit_packing, packing_plan
from subtide.llm.queries import QUERIES, tokenizer_file
from texts import SCHEMA, corpus, frame, same


@pytest.fixture(scope="module")
def rows():
    return corpus()


def cut(rows, max_tokens):
    tokenizer = Tokenizer.from_file(tokenizer_file())
    out = []
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [1]
        for k, start in enumerate(range(0, len(ids), max_tokens)):
            own = np.array(ids[start : start + max_tokens], "<u4")
            out.append((row[0], k, start, len(own), zlib.crc32(own.tobytes())))
    return out


def check_sequences(pieces, max_tokens):
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= max_tokens
    return len(sequences)


@pytest.mark.parametrize("max_tokens", [4096, 64])
def test_pieces_match_the_library(spark, rows, max_tokens):
    got = best_fit_packing(frame(spark, rows), tokenizer_file(), max_tokens).collect()
    same([tuple(r)[:5] for r in got], cut(rows, max_tokens))
    n = check_sequences(got, max_tokens)
    assert n <= 1.06 * sum(r["length"] for r in got) / max_tokens + 2


def test_ids_come_with_the_pieces(spark, rows):
    for r in best_fit_packing(frame(spark, rows[:20]), tokenizer_file(), 100, with_ids=True).collect():
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_no_rows(spark):
    assert best_fit_packing(spark.createDataFrame([], SCHEMA), tokenizer_file()).count() == 0


def test_query_covers_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op10_best_fit_packing"](spark, sf_dir).collect()
    same([tuple(r)[:5] for r in got], cut(rows, 4096))
    check_sequences(got, 4096)


def test_words_encode_as_in_their_text():
    encoder = _word_ids(tokenizer_file())
    assert encoder.plain
    texts = ["it's IT'S 's", "a\x85b c d \x1c x", "<|endoftext|>y z<|startoftext|>", "Σας ΑΣ İstanbul ﬁ Å K", "é ́a ≠ ,̸", "½ ² 12345 3.14", "日本語 text", "a_b-c (d) [e] {f} x|y <z>", "naïve—dash…,", "\t\n\x0b", "ǅ ß ẞ"]
    rng = random.Random(1)
    texts += ["".join(rng.choices("abÉéß'.,<|>́ \n 1", k=60)) for _ in range(300)]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode([t.encode() for t in texts], 1), strict=True):
            assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]
        encoder.forget()


def test_plans_place_every_piece_once():
    rng = np.random.default_rng(1)
    for _ in range(150):
        capacity, n = int(rng.integers(5, 300)), int(rng.integers(0, 1500))
        lengths = np.clip(rng.exponential(capacity / rng.integers(1, 8), n).astype(int) + 1, 1, capacity)
        counts = np.bincount(lengths, minlength=capacity + 1)
        plan, bins = packing_plan(counts, capacity, groups=int(rng.integers(1, 20)))
        next_rank, used = np.zeros(capacity + 1, int), {}
        for length, first, end, first_bin, a_bin, offset in plan.tolist():
            assert first == next_rank[length]
            next_rank[length] = end
            for k in range(end - first):
                used.setdefault(first_bin + k // a_bin, []).append((offset + k % a_bin * length, length))
        assert (next_rank == counts).all() and len(used) == bins
        for own in used.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity


def test_plans_stay_close_to_the_bound_and_small():
    rng = np.random.default_rng(2)
    for n in (10_000, 1_000_000):
        lengths = np.minimum(4096, rng.lognormal(6.6, 1, n).astype(int) + 1)
        plan, bins = packing_plan(np.bincount(lengths, minlength=4097), 4096)
        assert bins <= 1.02 * lengths.sum() / 4096 + 1
        assert len(plan) < 40_000

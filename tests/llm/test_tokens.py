"""Token ids, counts and packing against the defining library and plain computations."""

import random
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemart.llm.packing import best_fit, improve, pack, token_pieces
from tidemart.llm.queries import QUERIES
from tidemart.llm.token_counts import context_totals, length_histogram
from tidemart.llm.tokens import Encoder, vocabulary_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    return Encoder(vocabulary_path())


LIBRARY = Tokenizer.from_file(f"{vocabulary_path()}.json")


def defined(encoder, text):
    return array("I", LIBRARY.encode(text or "", add_special_tokens=False).ids).tobytes()


def test_ids_are_those_of_the_defining_library(encoder):
    random.seed(4)
    letters = list("ab Z'sdll re 09.,!?-_\n\t\r\x0b\x0c\x1c\x85\xa0　é漢字🙂<|endoftext|>'ve²Ⅷ٣​́")
    for _ in range(3000):
        text = "".join(random.choices(letters, k=random.randint(0, 50)))
        assert encoder.encode(text) == defined(encoder, text), repr(text)
    for text in ["", " " * 50_000 + "x", "x" + "\n" * 50_000, "a" * 50_000, "<|endoftext|>", "one  two "]:
        assert encoder.encode(text) == defined(encoder, text)
    assert encoder.encode(None) == b""
    ids = [31373, 220, 50256, 995]
    assert encoder.encode("hello <|endoftext|> world") == array("I", ids).tobytes() == defined(encoder, "hello <|endoftext|> world")


def test_pieces_and_sequences_of_the_table(spark, encoder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op2_packing"](spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, pieces in by_doc.items():
        ids = defined(encoder, texts[doc]) + (2).to_bytes(4, "little")
        pieces.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert sum(p["length"] for p in pieces) == len(ids) // 4
        assert all(p["length"] == 1024 for p in pieces[1:])
        for p in pieces:
            part = ids[4 * p["start"]:4 * (p["start"] + p["length"])]
            assert zlib.crc32(part) == p["ids_crc32"]
    check_sequences(rows, 1024)
    used = len({r["sequence_id"] for r in rows})
    assert used <= 1.02 * -(-sum(r["length"] for r in rows) // 1024)


def check_sequences(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity


def test_pack_many_groups_and_repeats(spark):
    random.seed(1)
    rows = [(i // 2, 0, 0, random.choice([3, 7, 20, 33, 64, 100]), 5) for i in range(900)] + [(None, 0, 0, 1, 5)] * 5
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = pack(pieces, capacity=100, group_rows=100).collect()
    assert Counter((r["doc_id"], r["length"]) for r in got) == Counter((r[0], r[3]) for r in rows)
    check_sequences(got, 100)
    least = -(-sum(r[3] for r in rows) // 100)
    assert len({r["sequence_id"] for r in got}) <= 1.06 * least


def test_swaps_empty_bins():
    lengths = np.array([6, 4, 4, 3, 3])  # sequences of 10: best fit leaves 6+4, 4+3+3
    assert len(improve([[0], [1, 2], [3, 4]], lengths, 10)) == 2
    rng = np.random.default_rng(0)
    for _ in range(30):
        lengths = rng.integers(1, 60, 80)
        before = best_fit(lengths, 100)
        after = improve([list(b) for b in before], lengths, 100)
        assert sorted(i for b in after for i in b) == list(range(80))
        assert all(lengths[b].sum() <= 100 for b in after)
        assert len(after) <= len(before)


def test_nulls_empty_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, "x", 1), (None, "", "y", 2), (3, "word " * 3000, "z", 3)],
                                 "doc_id long, text string, piece string, length int")
    rows = token_pieces(docs, capacity=1024).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows if r["doc_id"] != 3) == [(0, 1), (1, 1)]
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 3002
    assert pack(token_pieces(docs.limit(0))).count() == 0


def test_histogram_answers_every_limit(spark, encoder):
    texts = [None, "", "one", "one two three", "one two three", "x " * 500]
    docs = spark.createDataFrame([(t, 1) for t in texts], "text string, n_tokens int")
    lengths = sorted(len(defined(encoder, t)) // 4 for t in texts)
    rows = {r["n_tokens"]: r for r in context_totals(length_histogram(docs)).collect()}
    assert {n: r["n_docs"] for n, r in rows.items()} == Counter(lengths)
    for limit in range(0, lengths[-1] + 3):
        row = rows[max(n for n in rows if n <= limit)]
        assert row["tokens_within"] + limit * row["docs_beyond"] == sum(min(n, limit) for n in lengths)
    for n, r in rows.items():
        assert r["tokens_truncated"] == sum(min(m, n) for m in lengths)
        assert r["quantile"] == sum(m <= n for m in lengths) / len(lengths)
    assert context_totals(length_histogram(docs.limit(0))).count() == 0


def test_counts_of_the_table(spark, encoder):
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = QUERIES["op8_token_counts"](spark, FOLDER).collect()
    assert {r["n_tokens"]: r["n_docs"] for r in rows} == Counter(len(defined(encoder, t)) // 4 for t in texts)

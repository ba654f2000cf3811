"""Registered queries without SQL on whole tables: exact columns against brute force, scores on what was held out."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from strataq.llm.queries import QUERIES

from .test_pii import expected
from .test_repeats import brute as repeats_brute
from .test_repeats import brute_passages
from .test_rules import brute as rules_brute

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(MIDDLE), reason="no tables here")


def rows_of(d, name):
    return pq.read_table(f"{d}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] for r in rows_of(SMALL, "documents")}


def test_repeats(spark, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_repeated_words, r.n_passages) for r in QUERIES["op1_repeats"](spark, SMALL).collect()}
    want = zip(texts, repeats_brute(texts.values(), 400), brute_passages(texts.values(), 50), strict=True)
    assert got == {i: (*a, *b) for i, a, b in want} and any(x[1] for x in got.values())


def test_personal_data(spark, texts):
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in QUERIES["op4_personal_data"](spark, SMALL).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}


def test_quality_rules(spark, texts):
    quality = {r["doc_id"]: r["quality"] for r in rows_of(SMALL, "labels")}
    got = QUERIES["op5_quality_rules"](spark, SMALL).collect()
    for r in got:
        want = rules_brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    assert len(got) == len(texts)
    good = [r.kept for r in got if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(good) >= 0.9 * len(good) > 0


def test_packing(spark, texts):
    public = pytest.importorskip("public_tokenizers")
    own = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    got = QUERIES["op9_packing"](spark, SMALL).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for start, length, crc, n in sorted(pieces[i]):
            assert start == at and n == len(ids) and crc == zlib.crc32(ids[at : at + length].tobytes())
            at += length
        assert at == len(ids)
    for spots in sequences.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert 0 < at <= 2048


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_of_held_out_rows(spark):
    quality = {r["doc_id"]: r["quality"] for r in rows_of(MIDDLE, "labels")}
    got = QUERIES["op6_quality"](spark, MIDDLE).collect()
    assert len(got) == len(rows_of(MIDDLE, "documents")) and all(r.held_out == (remainder(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    right = [r.predicted == quality[r.doc_id] for r in got if r.held_out and quality.get(r.doc_id) is not None]
    assert len(right) > 30 and sum(right) >= 0.93 * len(right)


def test_language_of_held_out_rows(spark):
    docs = {r["doc_id"]: r for r in rows_of(MIDDLE, "documents")}
    got = QUERIES["op7_language"](spark, MIDDLE).collect()
    assert len(got) == len(docs) and all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in got)
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert all((r.lang_pred == "und") == (not letters(docs[r.doc_id]["text"])) for r in got)
    seen = Counter((r.lang_pred == docs[r.doc_id]["lang"]) for r in got if r.held_out and docs[r.doc_id]["lang"] and r.lang_pred != "und")
    assert seen[True] > 100 and seen[True] >= 0.97 * seen.total()

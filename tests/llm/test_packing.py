import zlib
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strataq.llm.packing import SumOfSquares, WordIds, pack_documents

public = pytest.importorskip("public_tokenizers")
WORDS = ["Then", "can't", "É", "éÀ", "42", "x1y", "<|endoftext|>", "<|ENDOFTEXT|>a", "İ", "é", "ß", "İ", "日本", "a b", "!!", "\x1c", "ǅ", "Ω", "thionblé,", "'S", "a" * 90, "²½", "K"]


def text(rng, n):
    return "".join(rng.choice(WORDS) + rng.choice([" ", "\n", "\t ", "　", "  "]) for _ in range(n))


def test_ids_as_the_tokenizer():
    path, rng = public.path("word_bpe_49k.json"), Random(1)
    own, words = Tokenizer.from_file(path), WordIds(path)
    assert words.by_piece
    texts = [text(rng, rng.randint(0, 30)) for _ in range(500)] + ["", " ", "É", None]
    texts += ["".join(chr(rng.randrange(33, 0x250)) + rng.choice(["", "", " "]) for _ in range(40)) for _ in range(300)]
    for t, ids in zip(texts, words.ids(pa.array(texts)), strict=True):
        assert ids.tolist() == own.encode(t or "", add_special_tokens=False).ids, t


def test_a_tokenizer_that_keeps_white_space_is_refused():
    with pytest.raises(ValueError, match="white space"):
        WordIds(public.path("byte_bpe_50k.json"))


def test_ids_in_parts(monkeypatch):
    from strataq.llm import packing

    path, rng = public.path("word_bpe_49k.json"), Random(3)
    texts = [text(rng, n) for n in (300, 0, 5, 7, 1)]
    want = [x.tolist() for x in WordIds(path).ids(pa.array(texts))]
    monkeypatch.setattr(packing, "_WORDS", 4)
    assert [x.tolist() for x in WordIds(path).ids(pa.array(texts))] == want
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": [*texts, None]})
    parts = list(packing._about(batch, 60))
    assert sum(p.num_rows for p in parts) == 6 and len(parts) > 1 and pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


def test_pieces(spark):
    path, rng = public.path("word_bpe_49k.json"), Random(2)
    own = Tokenizer.from_file(path)
    rows = [(i, text(rng, rng.choice([0, 3, 40, 300, 900])), "x") for i in range(80)] + [(None, "no id", "y"), (500, None, "z"), (501, "twice", "a"), (501, "twice", "a")]
    got = pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string, offset string").repartition(3), path, window=256).collect()
    wanted = Counter()
    for i, t, _ in rows:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 256):
            part = ids[at : at + 256]
            wanted[(i, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in got) == wanted
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for spots in windows.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 256
    assert pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), path).count() == 0


def test_sum_of_squares():
    rule, rng, fills = SumOfSquares(100), Random(3), defaultdict(int)
    sizes = [rng.randint(1, 100) for _ in range(3000)]
    for s in sizes:
        before = rule.counts.copy()
        at, offset = rule.place(s)
        assert fills[at] == offset
        fills[at] += s
        assert fills[at] <= 100
        cost = (rule.counts.astype(int) ** 2).sum()
        for h in [0, *np.flatnonzero(before)]:
            if h + s <= 100:
                other = before.copy()
                other[h] -= h > 0
                other[h + s] += h + s < 100
                assert cost <= (other.astype(int) ** 2).sum()
    assert sum(sizes) / (100 * len(fills)) > 0.95
    with pytest.raises(ValueError):
        rule.place(101)

"""Packing token pieces into training windows by the sum-of-squares rule.

Documents are tokenised where they are read, cut into whole windows and one rest each, and only
a narrow row per piece is shuffled (never ids or text). Each task then packs its pieces: a piece
goes to the fill level that makes the sum of squared counts of partly filled windows least. The
state is the array of those counts and the open windows of each level.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written

WINDOW = 2048
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_MEMO = 800_000  # entries a worker keeps; words beyond are encoded each time
_CHUNK, _WORDS = 1 << 24, 1 << 20  # bytes of text and words that are looked up at once
#: Words of all classes that pieces must give the same ids as the tokenizer does.
_PROBES = ("plain", "Über-Größe,", "don't", "they'll've", "a1b22c", "x--y__z", "ÀÖØöøÿ", "'tis", "(end).", "#%&", "1234567", "ß")
#: Texts whose ids must be those of their words.
_SPACED = ("plain words here", " a  b\n\nc\td ", "Ünder, the\r\nsea. 12 3")


class _ByteChars(dict):
    """For str.translate: the characters that byte-level BPE writes for a character's bytes."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.level = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        self[code] = found = self.level.pre_tokenize_str(chr(code))[0][0]
        return found


def _splits_at_space_and_lowers(tokenizer) -> bool:
    """Whether the tokenizer lower-cases, splits words as `_PIECE` does, and takes bytes as characters: by its own settings."""
    settings = json.loads(tokenizer.to_str())
    normal, splits = json.dumps(settings["normalizer"]), json.dumps(settings["pre_tokenizer"])
    return settings["model"]["type"] == "BPE" and "Lowercase" in normal and "ByteLevel" in splits and not settings["model"].get("ignore_merges")


#: How the lower-casing tokenizer splits a word, on the Latin letters that `_LATIN` lets through.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+").findall
_LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch  # composed, and lower-cased alike everywhere


class WordIds(dict):
    """Ids of a white-space separated word as little-endian 16 or 32-bit numbers, remembered.

    The tokenizer must split at white space, drop it and never look across it (another one is refused), so a text's ids are its
    words' ids joined. Of the lower-casing tokenizer (`by_piece`) words are lower-cased first, and
    those of plain Latin characters are put together from pieces that go to the BPE model directly;
    a word list checks that on loading.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.chars = self.tokenizer.model, _ByteChars()
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        if any(self.encoded(t) != b"".join(map(self.encoded, t.split())) for t in _SPACED):
            raise ValueError(f"{path} doesn't drop white space: its ids of a text aren't those of the text's words")
        self.pieces: dict[str, bytes] = {}
        self.by_piece = _splits_at_space_and_lowers(self.tokenizer) and all(self.from_pieces(w) == self.encoded(w) for w in _PROBES)

    def encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def piece(self, text: str) -> bytes:
        if (found := self.pieces.get(text)) is None:
            found = np.array([x.id for x in self.model.tokenize(text.translate(self.chars))], self.kind).tobytes()
            if len(self.pieces) < _MEMO:
                self.pieces[text] = found
        return found

    def from_pieces(self, text: str) -> bytes:
        return b"".join(map(self.piece, _PIECE(text.lower())))

    def __missing__(self, text: str) -> bytes:
        found = self.from_pieces(text) if self.by_piece and "<|" not in text and _LATIN(text) else self.encoded(text)
        if len(self) < _MEMO and len(text) <= 64:
            self[text] = found
        return found

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, by the distinct words of all. A text with special tokens isn't lower-cased."""
        texts = pc.fill_null(texts, "")
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)) if self.by_piece else texts
        lists = pc.ascii_split_whitespace(lowered)
        coded = lists.flatten().dictionary_encode()
        found = list(map(self.__getitem__, coded.dictionary.to_pylist()))
        pool = np.frombuffer(b"".join(found), self.kind)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // pool.itemsize
        starts, codes, begin = np.cumsum(sizes) - sizes, coded.indices.to_numpy(), 0
        for n in pc.list_value_length(lists).to_pylist():
            parts = []
            for at in range(begin, begin + n, _WORDS):  # a very long text in parts
                c = codes[at : min(begin + n, at + _WORDS)]
                size = sizes[c]
                ends = np.cumsum(size)
                parts.append(pool[np.repeat(starts[c] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)])
            begin += n
            yield parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, self.kind), *parts])


_workers: dict[str, WordIds] = {}


def _about(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about `size` bytes of text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size)))
        yield batch.slice(at, end - at)
        at = end


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each text's ids and `end_id`, cut at each full window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _workers.setdefault(tokenizer, None) or _workers.update({tokenizer: WordIds(tokenizer)}) or _workers[tokenizer]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for some in _about(batch, _CHUNK):
                for key, body in zip(some.column(0).to_pylist(), words.ids(some.column(1)), strict=True):
                    ids = np.append(body, np.array(end_id, "<u4")).astype("<u4")
                    raw, n = memoryview(ids).cast("B"), len(ids)
                    for at in range(0, n, window):
                        end = min(n, at + window)
                        for column, x in zip(out, (key, at, end - at, zlib.crc32(raw[4 * at : 4 * end]), n), strict=True):
                            column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(lean(run), _PIECES)


class SumOfSquares:
    """Online packing: counts[h] windows are filled to h; `place` gives (window, offset) of a piece."""

    def __init__(self, window: int = WINDOW):
        self.window, self.next = window, 0
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def place(self, size: int) -> tuple[int, int]:
        if not 0 < size <= self.window:
            raise ValueError(f"a piece of {size} ids")
        # moving a window from level h to h + size changes the sum by 2 (counts[h + size] - counts[h] + 1); a new one by 2 counts[size] + 1
        room = self.window - size
        change = 2 * (self.counts[size:] - self.counts[: room + 1] + 1)
        change[self.counts[: room + 1] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * self.counts[size] + 1
        change[room] -= change[room] != np.iinfo(np.int64).max  # full windows are not counted, so that place is free
        level = room - int(np.argmin(change[::-1]))  # of equals, the fullest
        if level:
            at = self.open[level].pop()
            self.counts[level] -= 1
        else:
            at, self.next = self.next, self.next + 1
        if level + size < self.window:
            self.open[level + size].append(at)
            self.counts[level + size] += 1
        return at, level


def pack(pieces: DataFrame, window: int = WINDOW, per_task: int = 1 << 26) -> DataFrame:
    """`pieces` (a written table) with sequence_id and offset; about `per_task` ids a task.

    Rows are dealt evenly whatever their ids, longest first in each task, so small pieces fill
    the gaps at the end. Sequence ids hold the task above bit 40. Equal rows are separate pieces.
    """
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rule, base = SumOfSquares(window), TaskContext.get().partitionId() << 40
        for batch in batches:
            spots = [rule.place(x) for x in batch.column("length").to_pylist()]
            extra = np.array(spots, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(extra[:, 0] + base), pa.array(extra[:, 1])], names=[*fields, "sequence_id", "offset"])

    dealt = pieces.select(*fields).repartition(max(1, -(-total // per_task)))
    ordered = dealt.sortWithinPartitions(F.col("length").desc(), "ids_crc32", "doc_id", "start")
    return ordered.mapInArrow(lean(run), f"{_PIECES}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    A null or empty text has the end id alone; a null doc_id stays null; repeated rows are packed
    as often as they occur; other columns don't matter; an empty table gives no piece.
    """
    return pack(written(token_pieces(docs, tokenizer, end_id, window), "pieces"), window)

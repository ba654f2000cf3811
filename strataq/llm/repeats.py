"""Repeated byte strings and word passages across documents, by minimizers and digests in place of a radix sort of suffixes.

A window is `threshold` tokens that start at one place of one document. Tokens are bytes (what is
cut) and words as 64-bit hashes (what is counted as repeated passages); both are taken through the
same passes at once, and the unit is part of a row. Only equality of windows is
asked for, so none is ordered by its bytes. Windows are refined in three steps ("digits" below), and
only while their group is neither alone nor settled:

1. Each window is filed under the place of its least hashed gram (of all grams in the window,
   the rightmost of equals), which follows from its tokens alone. A place stands for a run of
   neighbouring windows and for the tokens that they cover together. First digit: the gram.
2. Places of one gram: if the tokens around them are equal throughout, all their windows are
   repeated. If they differ, second digit: windows of 16 neighbouring offsets by the tokens
   they share, again settled as a whole where the tokens they cover are equal.
3. Ranges still open, last digit: each window by a 128-bit digest of all its tokens. Groups of two
   and more are exactly the repeated windows.

Only digests and places are shuffled, and the tokens around open places. Equal rows are folded
before each shuffle, so a passage that a third of all documents hold sends one row a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import lean, written

THRESHOLD, PASSAGE = 400, 50
_BYTES, _WORDS = 0, 1  # units
_WIDTH = (1, 8)  # bytes of a token
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_STEP = 16
_SEGMENT = 1 << 20  # window starts handled at once; a longer text is taken in such parts
_ROW = "key bigint, full bigint, doc bigint, h bigint, a bigint, meta bigint"
_NAMES = ["key", "full", "doc", "h", "a", "meta"]
_PENDING, _DONE, _OPEN = 0, 1, 2  # kinds of a row; a done row holds [a, full) of its text
_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_M_INV = np.uint64(pow(int(_M), -1, 1 << 64))
_LOW = np.uint64(0xFFFFFFFF)
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, np.uint64))]) for x in (_M, _M_INV)]
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def places(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window, gram hash) of all windows within the parts [start, end) of buf."""
    gram = max(1, threshold // 2)
    width = threshold - gram + 1
    power, inverse = _power(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=sums[1:])
    grams = _mix((sums[gram:] - sums[:-gram]) * inverse[: len(buf) - gram + 1])
    ranked = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
    place = (_LOW - (_least(ranked, width) & _LOW)).astype(np.int64)
    inside = np.zeros(len(place) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends - threshold + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    owner = place[at]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])
    last = np.r_[first[1:], len(at)] - 1
    return owner[first], at[first], at[last], grams[owner[first]].view(np.int64)


def _digest(content: bytes, salt: int) -> int:
    return int.from_bytes(blake2b(content, digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little", signed=True)


def _meta(low, high, unit, state=0, kind=0):
    return low | (high << 20) | (state << 40) | (kind << 44) | (unit << 46)


def _unit(meta):
    return (meta >> 46) & 1


def tokens(text: str | None, unit: int) -> bytes:
    """A text's bytes, or the hashes of its words (8 bytes each)."""
    raw = (text or "").encode()
    if unit == _BYTES:
        return raw
    words = raw.split() if len(raw) <= _SEGMENT else map(re.Match.group, _WORD.finditer(raw))
    return np.fromiter(map(xxh64_intdigest, words), np.uint64).tobytes()


def _scatter(doc: np.ndarray, a: np.ndarray) -> np.ndarray:
    return _mix(doc.astype(np.uint64) * np.uint64(31) + a.astype(np.uint64)).view(np.int64)


def _groups(key: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order by (key, full); of each row in it: the first of its key, of its pair; and the counts."""
    order = np.lexsort((full, key))
    k, f = key[order], full[order]
    new_key = np.r_[True, k[1:] != k[:-1]]
    new = new_key | np.r_[True, f[1:] != f[:-1]]
    pair, group = np.cumsum(new) - 1, np.cumsum(new_key) - 1
    return order, new_key, new, np.bincount(pair)[pair], np.bincount(group, weights=new).astype(np.int64)[group], group


def fold(rows: dict[str, np.ndarray], thresholds: tuple[int, int]) -> dict[str, np.ndarray]:
    """What a batch knows by itself: pairs met twice are done, grams with several pairs are open.

    Of each gram one row stays pending, to be compared with other batches.
    """
    if not len(rows["key"]):
        return rows
    order, new_key, new, n_pair, n_pairs, _ = _groups(rows["key"], rows["full"])
    r = {c: x[order] for c, x in rows.items()}
    low, high = r["meta"] & 0xFFFFF, (r["meta"] >> 20) & 0xFFFFF
    several = n_pairs > 1
    done, kept = n_pair > 1, new
    rep = {c: x[kept] for c, x in r.items()}
    state = (done[kept] | 0) + 2 * several[kept]
    opened = several[kept] & ~new_key[kept]
    unit = _unit(r["meta"])
    rep["meta"] = _meta(low[kept], high[kept], unit[kept], state.astype(np.int64), np.where(opened, _OPEN, _PENDING))
    rep["key"] = np.where(opened, _scatter(rep["doc"] ^ rep["h"], rep["a"]), rep["key"])
    found = merged({c: r[c][done] for c in ("doc", "h")} | {"unit": unit[done], "lo": (r["a"] - high)[done], "hi": (r["a"] - low + np.array(thresholds)[unit])[done]})
    return {c: np.concatenate([rep[c], found[c]]) for c in _NAMES}


def merged(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Done rows of the spans given, those that meet within a text as one."""
    order = np.lexsort((x["lo"], x["unit"], x["h"], x["doc"]))
    doc, h, unit, lo, hi = (x[c][order] for c in ("doc", "h", "unit", "lo", "hi"))
    if not len(doc):
        return {c: np.zeros(0, np.int64) for c in _NAMES}
    text = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (unit[1:] != unit[:-1])]) - 1
    shift = text * (int(hi.max()) + 2)
    far = np.maximum.accumulate(hi + shift)
    new = np.r_[True, (lo + shift)[1:] > far[:-1]]
    end = np.r_[np.flatnonzero(new)[1:], len(doc)] - 1
    doc, h, a, full = doc[new], h[new], lo[new], (far - shift)[end]
    return {"key": _scatter(doc ^ h, a), "full": full, "doc": doc, "h": h, "a": a, "meta": _meta(0, 0, unit[new], 0, _DONE)}


def settle(rows: dict[str, np.ndarray], thresholds: tuple[int, int]) -> dict[str, np.ndarray]:
    """All pending rows of some grams: done spans, and one open row for each pair still to refine."""
    if not len(rows["key"]):
        return rows
    order, _, new, n_pair, n_pairs, group = _groups(rows["key"], rows["full"])
    r = {c: x[order] for c, x in rows.items()}
    low, high, state = r["meta"] & 0xFFFFF, (r["meta"] >> 20) & 0xFFFFF, (r["meta"] >> 40) & 0xF
    done = (n_pair > 1) & (state & 1 == 0)
    several = (n_pairs > 1) | (np.bincount(group, weights=state & 2)[group] > 0)
    opened = {c: x[new & several] for c, x in r.items()}
    unit = _unit(r["meta"])
    opened["meta"] = _meta(low[new & several], high[new & several], unit[new & several], 0, _OPEN)
    found = merged({c: r[c][done] for c in ("doc", "h")} | {"unit": unit[done], "lo": (r["a"] - high)[done], "hi": (r["a"] - low + np.array(thresholds)[unit])[done]})
    return {c: np.concatenate([opened[c], found[c]]) for c in _NAMES}


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in _NAMES}


def _batch(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[c], pa.int64()) for c in _NAMES], names=_NAMES)


def settled(folded: DataFrame, thresholds: tuple[int, int], name: str) -> DataFrame:
    """Pending rows meet by their key; done and open rows pass. A key has a row a batch at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            rows = _arrays(batch)
            pending = ((rows["meta"] >> 44) & 3) == _PENDING
            yield _batch({c: x[~pending] for c, x in rows.items()})
            rows = {c: x[pending] for c, x in rows.items()}
            if not len(rows["key"]):
                continue
            if held and held[-1]["key"][-1] == rows["key"][-1]:
                held.append(rows)
                continue
            whole = {c: np.concatenate([*(x[c] for x in held), rows[c]]) for c in _NAMES}
            tail = whole["key"] == whole["key"][-1]
            yield _batch(settle({c: x[~tail] for c, x in whole.items()}, thresholds))
            held = [{c: x[tail] for c, x in whole.items()}]
        if held:
            yield _batch(settle({c: np.concatenate([x[c] for x in held]) for c in _NAMES}, thresholds))

    return written(folded.repartition("key").sortWithinPartitions("key").mapInArrow(lean(run), _ROW), name)


def _segments(texts: Iterable[bytes], threshold: int, width: int = 1) -> Iterator[list[tuple[int, int, bytes]]]:
    """(index, offset, tokens) of parts, together about a segment, that hold all windows once."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) // width - threshold + 1, _SEGMENT):
            part = text[width * at : width * (at + _SEGMENT + threshold - 1)]
            group.append((i, at, part))
            size += len(part) // width
            if size >= _SEGMENT:
                yield group
                group, size = [], 0
    if group:
        yield group


def _place_rows(parts: list[tuple[int, int, bytes]], doc: np.ndarray, h: np.ndarray, unit: int, threshold: int) -> dict[str, np.ndarray]:
    width = _WIDTH[unit]
    raw = b"".join(p for _, _, p in parts)
    ends = np.cumsum([len(p) // width for _, _, p in parts])
    starts = np.r_[0, ends[:-1]]
    place, first, last, gram = places(np.frombuffer(raw, np.uint8 if width == 1 else np.uint64), starts, ends, threshold)
    part = np.searchsorted(starts, first, "right") - 1
    index, shift = np.array([i for i, _, _ in parts])[part], np.array([at for _, at, _ in parts])[part] - starts[part]
    full = np.array([_digest(raw[s:e], d) for s, e, d in zip((width * first).tolist(), (width * (last + threshold)).tolist(), (place - first).tolist(), strict=True)], np.int64)
    return {"key": gram, "full": full, "doc": doc[index], "h": h[index], "a": place + shift, "meta": _meta(place - last, place - first, unit)}


def first_digits(docs: DataFrame, thresholds: tuple[int, int]) -> DataFrame:
    """docs: doc, h, text. Folded rows of all places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "h"))
            found: list[dict[str, np.ndarray]] = []
            for unit, threshold in enumerate(thresholds):
                if threshold:
                    texts = (tokens(x.as_py(), unit) for x in batch.column("text"))
                    found += [_place_rows(parts, doc, h, unit, threshold) for parts in _segments(texts, threshold, _WIDTH[unit])]
            if found:
                yield _batch(fold({c: np.concatenate([x[c] for x in found]) for c in _NAMES}, thresholds))

    return docs.mapInArrow(lean(run), _ROW)


def _of(kind: int) -> Column:
    return F.shiftright("meta", 44).bitwiseAND(3) == kind


def _offsets() -> list[Column]:
    return [F.shiftright("meta", 46).alias("unit"), F.col("meta").bitwiseAND(0xFFFFF).alias("low"), F.shiftright("meta", 20).bitwiseAND(0xFFFFF).alias("high")]


def around_open(docs: DataFrame, rows: DataFrame, thresholds: tuple[int, int]) -> DataFrame:
    """doc, h, unit, a, low, high, off, around: of each open place the tokens its windows' ranges touch."""
    places_open = rows.where(_of(_OPEN)).select("doc", "h", "a", *_offsets()).distinct()
    lists = places_open.groupBy("doc", "h").agg(F.collect_list(F.struct("unit", "a", "low", "high")).alias("places"))
    schema = "doc bigint, h bigint, unit bigint, a bigint, low bigint, high bigint, off bigint, around binary"
    names = ["doc", "h", "unit", "a", "low", "high", "off", "around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, h, text, found in zip(*(batch.column(c) for c in ("doc", "h", "text", "places")), strict=True):
                body, found = text.as_py(), found.as_py()
                raw = {unit: tokens(body, unit) for unit in {p["unit"] for p in found}}
                for p in found:
                    unit, a, lo, hi = p["unit"], p["a"], p["low"], p["high"]
                    width, begin = _WIDTH[unit], a - hi
                    out.append((doc.as_py(), h.as_py(), unit, a, lo, hi, a - begin, raw[unit][width * begin : width * (a - lo + thresholds[unit])]))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 8, [pa.int64()] * 7 + [pa.binary()], strict=True)], names=names)

    return docs.join(lists, ["doc", "h"]).select("doc", "h", "text", "places").mapInArrow(lean(run), schema)


def _range_rows(doc, h, unit, a, lo, hi, off, around, thresholds: tuple[int, int]) -> Iterator[tuple]:
    threshold, width = thresholds[unit], _WIDTH[unit]
    step = max(1, min(_STEP, threshold // 4))
    for r in range(lo // step, hi // step + 1):
        least, most = r * step, r * step + step - 1
        d0, d1 = max(lo, least), min(hi, most)
        # `around` begins at offset `off` before the place; it holds what the range's windows share
        shared = around[width * (off - least) : width * (off - most + threshold)]
        yield (_digest(shared, r), _digest(around[width * (off - d1) : width * (off - d0 + threshold)], (d0 << 20) | d1), doc, h, a, _meta(d0, d1, unit))


def next_digits(contexts: DataFrame, thresholds: tuple[int, int]) -> DataFrame:
    """Folded rows of the ranges of offsets of open places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row for x in zip(*(c.to_pylist() for c in batch.columns), strict=True) for row in _range_rows(*x, thresholds)]
            if out:
                table = np.array(out, np.int64)
                yield _batch(fold({c: table[:, i] for i, c in enumerate(_NAMES)}, thresholds))

    return contexts.select("doc", "h", "unit", "a", "low", "high", "off", "around").mapInArrow(lean(run), _ROW)


def last_digits(contexts: DataFrame, rows: DataFrame, thresholds: tuple[int, int]) -> DataFrame:
    """Folded rows of the single windows of open ranges, by 128 bits of their digest."""
    ranges = rows.where(_of(_OPEN)).select("doc", "h", "a", *_offsets()).withColumnsRenamed({"low": "d0", "high": "d1"}).distinct()
    # a place may be listed for two runs of windows (parts of a long text); its range lies in one
    joined = contexts.join(ranges, ["doc", "h", "unit", "a"]).where((F.col("low") <= F.col("d0")) & (F.col("d1") <= F.col("high")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, h, unit, a, off, around, d0, d1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                width = _WIDTH[unit]
                for d in range(d0, d1 + 1):
                    x = blake2b(around[width * (off - d) : width * (off - d + thresholds[unit])], digest_size=16).digest()
                    out.append((int.from_bytes(x[:8], "little", signed=True), int.from_bytes(x[8:], "little", signed=True), doc, h, a, _meta(d, d, unit)))
            if out:
                table = np.array(out, np.int64)
                yield _batch(fold({c: table[:, i] for i, c in enumerate(_NAMES)}, thresholds))

    return joined.select("doc", "h", "unit", "a", "off", "around", "d0", "d1").mapInArrow(lean(run), _ROW)


def repeated_spans(docs: DataFrame, thresholds: tuple[int, int] = (THRESHOLD, 0)) -> DataFrame:
    """doc, h, spans (list of unit, lo, hi; may overlap) of the texts that hold repeated windows.

    docs: doc, h (hash of the text), text. Thresholds are of bytes and words; 0 leaves a unit out.
    """
    first = settled(first_digits(docs, thresholds), thresholds, "repeats-1")
    contexts = written(around_open(docs, first, thresholds), "repeats-tokens")
    second = settled(next_digits(contexts, thresholds), thresholds, "repeats-2")
    third = settled(last_digits(contexts, second, thresholds), thresholds, "repeats-3")
    done = [x.where(_of(_DONE)).select("doc", "h", F.shiftright("meta", 46).cast("int").alias("unit"), F.col("a").alias("lo"), F.col("full").alias("hi")) for x in (first, second, third)]
    spans = done[0].unionByName(done[1]).unionByName(done[2])
    return spans.distinct().groupBy("doc", "h").agg(F.collect_list(F.struct("unit", "lo", "hi")).alias("spans"))


def _runs(spans: list[dict], unit: int) -> list[tuple[int, int]]:
    """Maximal runs that the spans of a unit cover."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans if s["unit"] == unit):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def cut_repeats(docs: DataFrame, threshold: int = THRESHOLD, passage: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary): each text without repeated windows;
    n_repeated_words, n_passages: words in runs of `passage` words that start anywhere else too, and these runs.

    A byte goes if a string of `threshold` bytes that covers it starts anywhere else, in this
    document or another; strings are judged on the input. Passages are counted alike, on words
    (parts between ASCII white space, as they are) whatever stands between them; they aren't cut,
    and with `passage` 0 the counts are 0. Null text: empty. Shorter texts stay whole. Repeated
    rows are copies of each other and lose all (if long enough). Null ids are kept. `kept` need
    not be valid UTF-8. Other columns don't matter.
    """
    if not 2 <= threshold < 1 << 19 or passage and not 2 <= passage < 1 << 19:
        raise ValueError(f"thresholds {threshold}, {passage}")
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = given.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    shortest = min(threshold, 2 * passage - 1) if passage else threshold
    spans = repeated_spans(keyed.where(F.octet_length("text") >= shortest).select("doc", "h", "text"), (threshold, passage))
    kind = dict(given.dtypes)["doc_id"]
    columns = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary(), "n_repeated_words": pa.int64(), "n_passages": pa.int64()}
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, n_repeated_words bigint, n_passages bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for body, found in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                raw = (body.as_py() or "").encode()
                cut, passages = _runs(found or [], _BYTES), _runs(found or [], _WORDS)
                kept = b"".join(raw[a:b] for a, b in zip([0, *(hi for _, hi in cut)], [*(lo for lo, _ in cut), len(raw)], strict=True))
                out.append((len(raw), len(raw) - len(kept), len(cut), sha256(kept).hexdigest(), kept, sum(hi - lo for lo, hi in passages), len(passages)))
            arrays = [pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 7, columns.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *columns])

    return keyed.join(spans, ["doc", "h"], "left").select("doc_id", "text", "spans").mapInArrow(lean(run), schema)

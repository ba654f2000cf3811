"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

The sketch (Dahlgaard, Knudsen, Thorup, 2017) has `COORDINATES` bins. In round i every element
falls into a bin by its i-th hash with the value (i, hash), and a bin keeps its least value; the
rounds end once every bin is filled, and from round `COORDINATES` on all elements go to one bin
a round, so they do end. Two sets agree in a coordinate as often as they are alike, and the share
of equal coordinates is as concentrated as with independent minima.

Documents with equal sets are one class from the start. Bands of a class's sketch are its
buckets. In each bucket the members are compared with a hub. Where members beside the hub are
still in different components, all such sets of all buckets are searched exactly, by the rare
elements that sets which are alike must share. So no pair that shares a bucket is lost. An element
that many such sets share (pages of one template, say) doesn't cost a row a pair: its sets
meet in blocks, where sizes, places and odd sketches (Mitzenmacher et al., 2014; the parities of
set bits bound the symmetric difference from below) leave hardly more than what is alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, of_row, with_row, written
from .components import components

COORDINATES = 128
ROWS = 4  # of a band: of pairs of similarity 0.8, one in 20 million shares none of 32 bands
#: Sketches of sets of similarity 0.8 agree in 102 of 128 coordinates, give or take 5.
_LEAST_AGREEING = 76
_CHUNK = 1 << 20
#: Sets that share a rare element meet by a join up to _FEW, beyond it in blocks of _BLOCK with odd sketches of _BITS bits.
_FEW, _BLOCK, _BITS, _SAMPLED = 32, 2048, 2048, 1024
_M = np.uint64(0xD1342543DE82EF95)
_M_INV = np.uint64(pow(int(_M), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, np.uint64))]) for x in (_M, _M_INV)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_SEEDS = mix(np.arange(1, 2 * COORDINATES + 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle hash), distinct, sorted: of all texts, their `words`-word shingles.

    A-Z are lower-cased, words end at ASCII white space; a text of fewer words has one shingle,
    one without words none.
    """
    bodies = [b" ".join((t or "").encode().lower().split()) for t in texts]
    raw = np.frombuffer(b"\n".join([*bodies, b""]), np.uint8)
    power, inverse = _power(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.r_[0, ends[:-1] + 1]
    doc = np.cumsum(np.r_[0, raw[ends[:-1]] == 10])
    some = ends > starts  # an empty text has an empty "word"
    starts, ends, doc = starts[some], ends[some], doc[some]
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = np.bincount(doc, minlength=len(texts))
    first = np.r_[0, np.cumsum(n)[:-1]]
    at = np.arange(len(doc))
    last = at + words - 1
    whole = (last < len(doc)) & (doc[np.minimum(last, len(doc) - 1)] == doc)
    short = (n[doc] < words) & (at == first[doc])
    begin = np.flatnonzero(whole | short)
    stop = np.where(short, first[doc] + n[doc] - 1, np.minimum(last, len(doc) - 1))[begin]
    hashes = mix((sums[ends[stop]] - sums[starts[begin]]) * inverse[starts[begin]])
    owner = doc[begin]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])]
    return owner[new], hashes[new]


def sketches(owner: np.ndarray, hashes: np.ndarray, n: int, t: int = COORDINATES) -> np.ndarray:
    """n x t values of the sets given by (owner, hash); rows of empty sets stay all ones."""
    top = np.iinfo(np.uint64).max
    out = np.full(n * t, top, np.uint64)
    shift = np.uint64(64 - t.bit_length() + 1)
    if t & (t - 1) or t > 128:
        raise ValueError(f"{t} coordinates")
    for i in range(2 * t):
        if not len(owner):
            break
        x = mix(hashes ^ _SEEDS[i])
        bin_ = (x >> shift).astype(np.int64) if i < t else np.full(len(x), i - t)
        np.minimum.at(out, owner * t + bin_, (np.uint64(i) << np.uint64(56)) | (x & np.uint64((1 << 56) - 1)))
        if i % 4 == 3 or i > t:
            left = (out.reshape(n, t) == top).any(axis=1)[owner]
            owner, hashes = owner[left], hashes[left]
    return out.reshape(n, t)


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, t = sketch.shape
    parts = sketch.reshape(n, t // rows, rows)
    x = np.broadcast_to(_SEEDS[: t // rows], (n, t // rows)).copy()
    for i in range(rows):
        x = mix(x ^ parts[:, :, i])
    return x.view(np.int64)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= _CHUNK:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _parts(text: str | None, words: int) -> list[str | None]:
    """A very long text in parts that have all its shingles, so that its arrays stay small."""
    if len(text or "") <= 4 * _CHUNK:
        return [text]
    all_words = [w.decode() for w in text.encode().split()]
    step = _CHUNK // 8
    return [" ".join(all_words[i : i + step + words - 1]) for i in range(0, max(1, len(all_words) - words + 1), step)]


def _sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """As `shingle_sets`; here a text may be of any length."""
    parts = [_parts(t, words) for t in texts]
    if all(len(p) == 1 for p in parts):
        return shingle_sets([p[0] for p in parts], words)
    found = [np.unique(np.concatenate([shingle_sets([x], words)[1] for x in p])) for p in parts]
    return np.repeat(np.arange(len(texts)), [len(x) for x in found]), np.concatenate(found)


def _per_set(texts: list[str | None], words: int, with_sketch: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(first, last, set bounds, hashes, sketches) of runs of texts."""
    for lo, hi in _chunks(texts):
        owner, hashes = _sets(texts[lo:hi], words)
        bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
        yield lo, hi, bounds, hashes, sketches(owner, hashes, hi - lo) if with_sketch else None


def _digest(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, digest of the set, bands, small (a byte of each coordinate); docs: doc_id, text."""
    names = ["doc_id", "n", "digest", "bands", "small"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi, bounds, hashes, sketch in _per_set(texts, words, True):
                keys, small = bands(sketch), mix(sketch.copy()).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([_digest(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())),
                        pa.array([x.tobytes() for x in small], pa.binary()),
                    ],
                    names=names,
                )

    return docs.mapInArrow(lean(run), "doc_id bigint, n bigint, digest binary, bands array<bigint>, small binary")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, digest, items: the whole set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi, bounds, hashes, _ in _per_set(texts, words, False):
                sets = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array([_digest(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["doc_id", "digest", "items"])

    return docs.mapInArrow(lean(run), "doc_id bigint, digest binary, items binary")


def _alike(pairs: DataFrame, sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Of distinct candidate pairs (u, v) those that are alike: sizes and sketches first, then full sets."""
    side = lambda new: reps.select(F.col("rep").alias(new), F.col("n").alias(f"n_{new}"), F.col("small").alias(f"small_{new}"))
    sized = pairs.join(side("u"), "u").join(side("v"), "v").where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("small_u", "small_v"))
            close = pa.array((x == y).sum(axis=1) >= _LEAST_AGREEING)
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(close), batch.column("v").filter(close)], names=["u", "v"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sure = []
            for x, y in zip(batch.column("items_u").to_pylist(), batch.column("items_v").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                sure.append(100 * common >= percent * (len(a) + len(b) - common))
            sure = pa.array(sure, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(sure), batch.column("v").filter(sure)], names=["u", "v"])

    schema = "u bigint, v bigint"
    likely = sized.select("u", "v", "small_u", "small_v").mapInArrow(lean(near), schema)
    of = lambda new: sets.select(F.col("doc_id").alias(new), F.col("items").alias(f"items_{new}"))
    return written(likely.join(of("u"), "u").join(of("v"), "v").select("u", "v", "items_u", "items_v").mapInArrow(lean(alike), schema), "links")


def _placed(rows: DataFrame, roots: DataFrame, node: str, comp: str) -> DataFrame:
    """`rows` with the component of `node` so far."""
    named = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
    return rows.join(named, node, "left").withColumn(comp, F.coalesce("_root", node)).drop("_root")


def _tokens(sets: DataFrame) -> DataFrame:
    """doc_id, comp, n, item: a row per element."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [np.frombuffer(x, np.int64) for x in batch.column("items").to_pylist()]
            sizes = np.array([len(x) for x in items], np.int64)
            repeat = lambda c: np.repeat(batch.column(c).to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(repeat("doc_id")), pa.array(repeat("comp")), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate([np.zeros(0, np.int64), *items]))], names=["doc_id", "comp", "n", "item"])

    return sets.select("doc_id", "comp", "items").mapInArrow(lean(run), "doc_id bigint, comp bigint, n bigint, item bigint")


def _bin(n: Column, percent: int) -> Column:
    """Sizes of sets that are alike are in the same bin or in neighbouring ones, or, by rounding, in the next."""
    return F.floor(F.log(n.cast("double")) / np.log(100 / percent)).cast("bigint")


def _halvings(bins: np.ndarray, percent: int) -> np.ndarray:
    """How often the sets that meet in a bin (their sizes lie in it and the two above) are halved for the sketch."""
    return np.maximum(0, np.ceil(np.log2((100 / percent) ** (bins + 3.0) / _SAMPLED))).astype(np.int64)


def odd_sketches(items: list[np.ndarray], halvings: np.ndarray) -> np.ndarray:
    """Rows of _BITS bits: parities of the hashes in each place, of elements that a hash leaves after so many halvings."""
    owner = np.repeat(np.arange(len(items)), [len(x) for x in items])
    x = np.concatenate([np.zeros(0, np.uint64), *items])
    kept = (x & ((np.uint64(1) << halvings[owner].astype(np.uint64)) - np.uint64(1))) == 0
    place = (x[kept] >> np.uint64(40)) % np.uint64(_BITS)
    counts = np.bincount(owner[kept] * _BITS + place.astype(np.int64), minlength=len(items) * _BITS)
    return np.packbits((counts & 1).astype(np.uint8).reshape(-1, _BITS), axis=1)


def _sketched(sets: DataFrame, percent: int) -> DataFrame:
    """doc_id, odd0, odd1, odd2: odd sketches of each set for its bin, and for the bins one and two below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                items = [np.frombuffer(x, np.uint64) for x in part.column("items").to_pylist()]
                own = part.column("own").to_numpy()
                odd = [pa.array([r.tobytes() for r in odd_sketches(items, _halvings(own - k, percent))], pa.binary()) for k in range(3)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *odd], names=["doc_id", "odd0", "odd1", "odd2"])

    own = _bin(F.floor(F.octet_length("items") / 8), percent).alias("own")
    return sets.select("doc_id", "items", own).mapInArrow(lean(run), "doc_id bigint, odd0 binary, odd1 binary, odd2 binary")


def _fits(n_u, n_v, rest_u, rest_v, least, percent: int):
    """Whether the overlap that two sets need, percent / (100 + percent) of both sizes, is still left where they meet."""
    return (100 + percent) * least(rest_u, rest_v) >= percent * (n_u + n_v)


def _block_pairs(rows: pa.Table, percent: int) -> pa.Table:
    """u, v of one block: `home` rows against the others of their element and bin."""
    c = {x: rows.column(x).to_numpy() for x in ("doc_id", "comp", "n", "rest", "home", "bin")}
    odd = np.frombuffer(b"".join(rows.column("odd").to_pylist()), np.uint64).reshape(len(rows), -1)
    home, other = np.flatnonzero(c["home"]), np.flatnonzero(~c["home"])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rate = 0.5 ** float(_halvings(c["bin"][:1], percent)[0])
    id_v, comp_v, n_v, rest_v, odd_v = c["doc_id"][other], c["comp"][other], c["n"][other], c["rest"][other], odd[other]
    for i in home:
        n, key = c["n"][i], c["doc_id"][i]
        later = (n < n_v) | ((n == n_v) & (key < id_v))
        at = np.flatnonzero(later & (comp_v != c["comp"][i]) & _fits(n, n_v, c["rest"][i], rest_v, np.minimum, percent))
        if len(at):
            most = n + n_v[at] - 2 * -(-percent * (n + n_v[at]) // (100 + percent))  # elements in one of two sets that are alike
            limit = most if rate == 1 else most * rate + 6 * np.sqrt(most * rate) + 6
            at = at[np.bitwise_count(odd_v[at] ^ odd[i]).sum(axis=1, dtype=np.int64) <= limit]
            found.append((np.full(len(at), key), id_v[at]))
    u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def prefix_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """u, v: candidates among sets (doc_id, comp, items) of different components; no pair that is alike is missed.

    Elements of a set are ranked by how few sets hold them. Two sets that are alike share one of
    their first n - ceil(percent * n / 100) + 1 elements, and at the first that they share what
    follows must still hold the overlap that they need. For the smaller set that means few
    elements before that place, so sets that only have frequent passages in common don't meet.
    Groups of few sets are joined. The sets of a larger group are dealt to blocks by a hash, and all
    pairs of blocks are compared by odd sketches, but for those inside the group's largest component: up to _SAMPLED elements a set these rule out
    only what is surely not alike; larger sets are halved first, with room for six deviations.
    """
    tokens = written(_tokens(placed), "tokens")
    # written, so that both sides of a join are plain exchanges, which adaptive execution can split
    often = written(tokens.groupBy("item").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "often")
    shared = tokens.join(often, "item")
    doc = Window.partitionBy("doc_id")
    place = F.col("n") - F.count(F.lit(1)).over(doc) + F.row_number().over(doc.orderBy("f", "item"))
    ranked = shared.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    entry = ranked.select("item", "doc_id", "comp", "n", (F.col("n") - F.col("place") + 1).alias("rest"), _bin(F.col("n"), percent).alias("bin"))
    # overlap >= percent / (100 + percent) * (n_u + n_v); u, at home, is the smaller, at most two bins below
    roles = F.explode(F.array(*[F.struct((F.col("bin") - k).alias("bin"), F.lit(k).alias("below"), F.lit(home).alias("home")) for k, home in ((0, True), (0, False), (1, False), (2, False))])).alias("role")
    able = ~F.col("home") | ((100 + percent) * F.col("rest") >= 2 * percent * F.col("n"))
    roled = entry.select("item", "doc_id", "comp", "n", "rest", roles).select("item", "doc_id", "comp", "n", "rest", "role.*").where(able)
    group = ["item", "bin"]
    by_comp = roled.groupBy(*group, "comp").agg(F.sum(F.col("home").cast("int")).alias("homes"), F.sum((~F.col("home")).cast("int")).alias("others"))
    top = F.max(F.struct("others", "comp", "homes"))
    sized = by_comp.groupBy(*group).agg(F.sum("homes").alias("homes"), F.sum("others").alias("others"), F.count(F.lit(1)).alias("comps"), top.alias("top"))
    sized = written(sized.where("homes > 0 and comps > 1").drop("comps"), "groups")
    met = written(roled.join(sized, group), "prefixes")
    few = met.where(F.col("others") <= _FEW)
    side = lambda home, x: few.where(F.col("home") == home).select(*group, *[F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "comp", "n", "rest")])
    order = (F.col("n_u") < F.col("n_v")) | ((F.col("n_u") == F.col("n_v")) & (F.col("doc_id_u") < F.col("doc_id_v")))
    fits = _fits(F.col("n_u"), F.col("n_v"), F.col("rest_u"), F.col("rest_v"), F.least, percent)
    joined = side(True, "u").join(side(False, "v"), group).where(fits & order & (F.col("comp_u") != F.col("comp_v"))).select(F.col("doc_id_u").alias("u"), F.col("doc_id_v").alias("v"))
    many = met.where(F.col("others") > _FEW)
    odd = written(_sketched(placed.join(many.select("doc_id").distinct(), "doc_id", "left_semi"), percent), "odd")
    many = many.join(odd, "doc_id").withColumn("odd", F.when(F.col("below") == 0, F.col("odd0")).when(F.col("below") == 1, F.col("odd1")).otherwise(F.col("odd2")))
    # the largest component (0) and the rest (1) have blocks of their own; 0 meets 1 alone
    blocks = lambda count: F.ceil(count / _BLOCK).cast("int")
    n_blocks = {("homes", 0): blocks(F.col("top.homes")), ("others", 0): blocks(F.col("top.others")), ("homes", 1): blocks(F.col("homes") - F.col("top.homes")), ("others", 1): blocks(F.col("others") - F.col("top.others"))}
    of = lambda role, part: F.transform(F.filter(F.sequence(F.lit(0), n_blocks[role, part]), lambda i: i < n_blocks[role, part]), lambda i: 2 * i + part)
    rest = F.col("comp") != F.col("top.comp")
    across = lambda role: F.when(rest, F.concat(of(role, 0), of(role, 1))).otherwise(of(role, 1))
    own = lambda role: F.when(rest, 2 * F.pmod(F.xxhash64("doc_id"), n_blocks[role, 1]) + 1).otherwise(2 * F.pmod(F.xxhash64("doc_id"), n_blocks[role, 0])).cast("int")
    cell = F.when(F.col("home"), F.transform(across("others"), lambda j: F.struct(own("homes").alias("i"), j.alias("j")))).otherwise(F.transform(across("homes"), lambda i: F.struct(i.alias("i"), own("others").alias("j"))))
    dealt = many.select(*group, "doc_id", "comp", "n", "rest", "home", "odd", F.explode(cell).alias("cell")).select("*", "cell.i", "cell.j").drop("cell")
    compared = dealt.groupBy(*group, "i", "j").applyInArrow(lambda rows: _block_pairs(rows, percent), "u bigint, v bigint")
    return joined.unionByName(compared).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; alike are 100 * common >= percent * union.

    Null and empty texts have no shingle and are linked with nothing. Rows with equal sets are
    always linked, repeated rows so too. A class of equal sets is a node of its own, whatever its
    ids are, and components are named by the least id in them. A row without an id links others
    as any row does, but can't be named: its component_id is null and it is kept. Different texts
    under one id are each judged by themselves; the least ids of classes that are the same id
    make the classes one component. Other columns don't matter.
    """
    given = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = written(signatures(given, words), "signatures")
    classes = signed.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("small").alias("small"))
    reps = written(classes.select(F.monotonically_increasing_id().alias("rep"), *classes.columns), "classes")
    # hubs are of the least ids: the same one in all buckets of a group
    key = F.struct(F.coalesce("least", F.lit(2**63 - 1)).alias("least"), "rep")
    spread = reps.select("rep", key.alias("key"), F.explode("bands").alias("bucket"))
    hubs = spread.groupBy("bucket").agg(F.min("key").alias("first"), F.max("key").alias("_other")).where("first < _other").drop("_other")
    members = written(spread.join(hubs, "bucket").select("bucket", "rep", F.col("first.rep").alias("hub"), "first").where("rep <> hub"), "members")
    # the full sets of all that share a bucket, from their texts
    needed = reps.join(members.select("rep").union(members.select("hub")).distinct(), "rep").select("rep", "least", "digest")
    nameless = given.where("doc_id is null").join(needed.where("least is null").select(F.lit(True).alias("_")).limit(1), how="left_semi")
    texts = given.join(needed.select(F.col("least").alias("doc_id")).distinct(), "doc_id").select("doc_id", "text").unionByName(nameless)
    sets = written(full_sets(texts, words).drop("doc_id").join(needed.select("digest", F.col("rep").alias("doc_id")), "digest").select("doc_id", "digest", "items").dropDuplicates(["doc_id"]), "sets")
    # each with one hub; then with its other hubs, unless they are joined by now
    same_id = reps.groupBy("least").agg(F.min("rep").alias("v"), F.max("rep").alias("_other")).where("least is not null and v < _other").select("least", "v")
    one_id = reps.join(same_id, "least").where("rep <> v").select(F.col("rep").alias("u"), "v")
    links = _alike(members.groupBy(F.col("rep").alias("u")).agg(F.min("first")["rep"].alias("v")), sets, reps, percent).unionByName(one_id)
    roots = components(links)
    open_pairs = _placed(_placed(members.select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct(), roots, "u", "cu"), roots, "v", "cv").where("cu <> cv").select("u", "v")
    links = links.unionByName(_alike(open_pairs, sets, reps, percent))
    roots = components(links)
    # members of a bucket that are not yet one component with each other: exact search among them
    placed = _placed(members.select("bucket", "rep"), roots, "rep", "comp")
    split = placed.groupBy("bucket").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a < _b").select("bucket")
    rest = placed.join(split, "bucket", "left_semi").select(F.col("rep").alias("doc_id"), "comp").distinct()
    links = links.unionByName(_alike(prefix_pairs(sets.join(rest, "doc_id").select("doc_id", "comp", "items"), percent), sets, reps, percent))
    roots = components(links)
    rooted = written(reps.select("digest", "rep", "least").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("digest", "least", F.coalesce("root", "rep").alias("root")), "rooted")
    names = rooted.groupBy("root").agg(F.min("least").alias("_root"))
    classes = rooted.join(names, "root").select("digest", "_root")
    out = signed.select("doc_id", "n", "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("_root")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that are kept, with all their columns; of equal rows of one id one.

    Null and empty texts are like nothing else and stay, once an id. Different texts under the id of
    a kept row stay, since a result by id can't tell them apart. Rows without an id are all kept.
    Columns may have any names; an empty table stays empty.
    """
    found = near_duplicates(docs, words, percent, text, doc_id).where("kept and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    body = F.col(f"`{text}`")
    rows = with_row(docs, id=F.col(f"`{doc_id}`").cast("bigint"), h=F.xxhash64(F.coalesce(body, F.lit(""))))
    named = rows.join(found, "id", "left_semi").dropDuplicates(["id", "h"])
    return named.select(*of_row(docs)).unionByName(docs.where(F.col(f"`{doc_id}`").isNull()))

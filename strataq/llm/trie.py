"""Prefix tree of conversations, by a Patricia construction over sorted sequences.

A turn is a digest; a prefix is known by its depth and two 64-bit sums of hashes of (place, turn), which are
prefix sums, so a conversation may be cut over tasks. Conversations are sorted by the turns at which paths
part, so that the subtree of any node is a run of ranks. Nodes of one chain with as many conversations
below are one edge of the compressed tree: its lowest node is a branch, end or leaf point. Sums over subtrees are made on
edges: prefix sums over ranks, one lookup at the end of the run, and sums down the chain; sums from the end of
an edge upwards then give its unary nodes. No step goes level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, lean, written

DECADE, HEADS = 20, 4
_SUMS = ("s1", "s2", "s3", "s4")
_CHUNK = 8192


def _ordered(df: DataFrame, keys: Sequence[Column], name: str) -> DataFrame:
    """`df` sorted by keys, written, with part and at: the task and the place in it."""
    sorted_ = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    m = F.monotonically_increasing_id()
    return written(sorted_.withColumn("_m", m).select(*df.columns, F.shiftright("_m", 33).alias("part"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("at")), name)


def _running(df: DataFrame, group: Sequence[str], slice_: str, order: Column, sums: dict[str, Column]) -> DataFrame:
    """`df` with running sums along `order` in each group; a group is summed slice by slice (slices follow the order), so none is one task."""
    whole = {n: c.alias(n) for n, c in sums.items()}
    parts = df.groupBy(*group, slice_).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*group).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*group, slice_, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in whole])
    here = Window.partitionBy(*group, slice_).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.select(*df.columns, *[F.sum(c).over(here).alias(n) for n, c in sums.items()])
    joined = local.join(carried, [*group, slice_])
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


def _share(depth: Column, turn: Column) -> list[Column]:
    """What a turn at a depth adds to the four sums: halves of two 64-bit hashes."""
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), depth, turn)
        out += [F.shiftrightunsigned(h, 32), h.bitwiseAND(0xFFFFFFFF)]
    return out


def _key(depth: Column, sums: Sequence[Column]) -> Column:
    """A prefix's name."""
    return F.unhex(F.md5(F.concat_ws(",", *[c.cast("string") for c in (depth, *sums)])))


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their rebuilt turns: conv_id, depth, turn, words, length, s1 to s4 with this turn, and its share c1 to c4."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    given = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("no"), F.substring(role, 1, 32).alias("r"), F.substring(text, 1, 32).alias("t"), turn.alias("turn"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    rows = _ordered(given, [F.col("conv_id"), F.col("no").asc_nulls_first(), F.col("r"), F.col("t"), F.col("turn")], "turns").drop("no", "r", "t")
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv_id", "part", "first", (F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"))
    placed = rows.join(starts, ["conv_id", "part"]).select("conv_id", "part", "turn", "words", (F.col("start") + F.col("at") - F.col("first") + 1).alias("pos"))
    heads = placed.where(F.col("pos") < HEADS).groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "words"))).alias("heads"))  # three at most
    c = F.col("conv_id")
    h = F.pmod(F.crc32(c.cast("string")), F.lit(HEADS)).cast("int")
    known = parts.groupBy("conv_id").agg(F.sum("n").alias("m")).select("conv_id", "m", h.alias("h"), (c - c % DECADE).alias("base"))
    known = known.join(heads, "base", "left").select("conv_id", "h", "m", F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), F.lit(1), F.col("h")).alias("heads"))
    convs = written(known.select("conv_id", "h", "heads", (F.size("heads") + F.greatest(F.col("m") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    own = placed.join(convs, "conv_id").where("pos > h").select("conv_id", "part", (F.col("pos") - F.col("h") + F.size("heads")).alias("depth"), "turn", "words", "length")
    taken = convs.select("conv_id", F.lit(-1).cast("bigint").alias("part"), F.posexplode("heads").alias("i", "x"), "length").select("conv_id", "part", (F.col("i") + 1).cast("bigint").alias("depth"), "x.turn", "x.words", "length")
    every = own.unionByName(taken)
    shares = every.select("*", *[x.alias(f"c{i + 1}") for i, x in enumerate(_share(F.col("depth"), F.col("turn")))])
    return convs.select("conv_id", "length"), _running(shares, ["conv_id"], "part", F.col("depth"), {s: F.col(f"c{i + 1}") for i, s in enumerate(_SUMS)})


def _ends(ends: DataFrame) -> DataFrame:
    """key, ends_sha256 of the ids that end at each key, ascending, joined by commas. ends: key, conv_id.

    Ids are joined in runs of 8,192 possible ids; a key with one run is hashed at once, of
    others a task streams the runs through one hash and holds none but the last.
    """
    run = F.floor(F.col("conv_id") / _CHUNK)
    runs = ends.groupBy("key", run.alias("run")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    runs = written(runs, "ends")
    many = written(runs.groupBy("key").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1").select("key"), "ends-in-runs")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        yield done()
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if now is not None:
            yield done()

    long_ = runs.join(many, "key").repartition("key").sortWithinPartitions("key", "run").select("key", "ids").mapInArrow(lean(stream), "key binary, ends_sha256 string")
    return runs.join(many, "key", "left_anti").select("key", F.sha2("ids", 256).alias("ends_sha256")).unionByName(long_)


def prefix_tree(conversations: DataFrame) -> DataFrame:
    """A row a node, as the contract of op13 names its columns. conversations: conv_id, turn, role, text.

    Turns are ordered by turn, nulls first; equal turns by role and the first 32 characters of both, then by digest.
    Repeated rows are turns of their own. Rows without a conv_id belong to no conversation and take no part. `%`
    keeps the sign, as in SQL. An empty table has no root. Other columns don't matter.
    """
    convs, turns = _rebuilt(conversations)
    sums = [F.col(s) for s in _SUMS]
    before = [F.col(s) - F.col(f"c{i + 1}") for i, s in enumerate(_SUMS)]
    paths = written(turns.select("conv_id", "depth", "turn", "words", "length", _key(F.col("depth"), sums).alias("key"), _key(F.col("depth") - 1, before).alias("above")), "paths")
    root = _key(F.lit(0), [F.lit(0)] * 4)
    ends = written(paths.where("depth = length").select("conv_id", "key", "length").unionByName(convs.where("length = 0").select("conv_id", root.alias("key"), F.col("length").cast("bigint").alias("length"))), "conversation-ends")
    # copies are one class, named by its least id
    classes = written(ends.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("length").alias("length")).select("conv_id", F.lit(True).alias("first"), F.col("key").alias("end"), "length"), "classes")
    marked = paths.join(classes.select("conv_id", "first"), "conv_id", "left").withColumn("first", F.coalesce("first", F.lit(False)))
    inner = marked.groupBy("key").agg(F.max("above").alias("above"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("first").alias("n_classes"), F.max("words").alias("words"))
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).join(classes.agg(F.count(F.lit(1)).alias("n_classes"))).where("n_convs > 0")  # one row each
    named = ["key", "above", "depth", "conv_id", "n_convs", "n_classes", "words"]
    plain = written(inner.select(*named).unionByName(top.select(root.alias("key"), F.lit(None).cast("binary").alias("above"), F.lit(0).cast("bigint").alias("depth"), "conv_id", "n_convs", "n_classes", F.lit(0).cast("bigint").alias("words"))), "plain-nodes")
    counts = plain.where("above is not null").groupBy(F.col("above").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(plain.join(counts, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    # rank of each class: by the turns where its path parts from others', shorter first
    own = paths.join(classes.select("conv_id"), "conv_id", "left_semi")
    parting = nodes.where("n_children > 1 and above is not null").select(F.col("key").alias("above"))
    choices = own.where("depth = 1").select("conv_id", "depth", "turn").unionByName(own.where("depth > 1").join(parting, "above", "left_semi").select("conv_id", "depth", "turn"))
    chosen = choices.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "turn"))), lambda x: x["turn"]).alias("way"))
    leaf = nodes.where("n_children = 0").select(F.col("key").alias("end"), F.lit(1).cast("bigint").alias("leaf"))
    with_way = classes.join(chosen, "conv_id", "left").join(leaf, "end", "left").select("conv_id", "length", F.coalesce("way", F.array().cast("array<binary>")).alias("way"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    ordered = _ordered(with_way, [F.col("way"), F.col("length")], "ways").drop("way")
    tasks = ordered.groupBy("part").agg(F.max("at").alias("last"))
    offset = F.coalesce(F.sum(F.col("last") + 1).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a task
    ranked = written(ordered.join(F.broadcast(tasks.select("part", offset.alias("offset"))), "part").select("conv_id", (F.col("offset") + F.col("at")).alias("rank"), "leaf"), "ranks")

    # each node belongs to the chain of the first class that has it; the root to rank 0
    firsts = own.join(ranked.select("conv_id", "rank"), "conv_id").groupBy("key").agg(F.min("rank").alias("rank"))
    saved = (F.col("n_convs") - 1) * F.col("words")
    chained = written(nodes.join(firsts, "key", "left").select("*", saved.alias("saved")).withColumn("rank", F.coalesce("rank", F.lit(0))), "chained-nodes")
    edges = written(chained.groupBy("rank", "n_classes").agg(F.sum("saved").alias("saved"), F.max("depth").alias("point")), "edges")

    # over ranks: what the chains of all classes up to one have
    chains = ranked.select("rank", "leaf").join(edges.groupBy("rank").agg(F.sum("saved").alias("saved")), "rank", "left").select("rank", "leaf", F.coalesce("saved", F.lit(0)).alias("saved"), F.floor(F.col("rank") / 65536).alias("slice"))
    upto = written(_running(chains.withColumn("all", F.lit(0)), ["all"], "slice", F.col("rank"), {"leaves_upto": F.col("leaf"), "saved_upto": F.col("saved")}).select("rank", "leaf", "leaves_upto", "saved_upto"), "sums-over-ranks")
    at = lambda side: upto.select(F.col("rank").alias(f"{side}_rank"), F.col("leaf").alias(f"{side}_leaf"), F.col("leaves_upto").alias(f"{side}_leaves"), F.col("saved_upto").alias(f"{side}_saved"))
    run = edges.withColumn("last", F.col("rank") + F.col("n_classes") - 1).join(at("own"), F.col("rank") == F.col("own_rank")).join(at("end"), F.col("last") == F.col("end_rank"))
    down = _running(run.withColumn("slice", -F.floor(F.col("point") / 65536)), ["rank"], "slice", -F.col("point"), {"chain": F.col("saved")})
    # below: of this edge's point downwards without the edge itself; an edge's leaves are those of its whole run
    points = down.select("rank", "n_classes", (F.col("chain") - F.col("saved") + F.col("end_saved") - F.col("own_saved")).alias("below"), (F.col("own_leaf") + F.col("end_leaves") - F.col("own_leaves")).alias("n_leaves"))
    up = _running(chained.withColumn("slice", -F.floor(F.col("depth") / 65536)), ["rank", "n_classes"], "slice", -F.col("depth"), {"edge": F.col("saved")})
    summed = up.join(points, ["rank", "n_classes"]).select("key", "above", "depth", "conv_id", "n_convs", "n_children", "n_leaves", (F.col("edge") + F.col("below")).alias("saved_tokens"))
    parents = nodes.where("n_children > 0").select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    hashed = _ends(ends.select("key", "conv_id"))
    full = summed.join(parents, "above", "left").join(hashed, "key", "left")
    long_ = lambda c: F.col(c).cast("bigint").alias(c)
    return full.select("conv_id", "depth", "parent_conv_id", long_("n_convs"), long_("n_children"), long_("n_leaves"), long_("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

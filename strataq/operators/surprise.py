"""Difficulty by surprise: how unlikely a text's words are to a language model counted over a corpus.

The model is an interpolated Kneser-Ney one (Kneser & Ney, 1995): counts of runs of words, each a row, with one discount an order.
Counts and chances are tables that grow with the corpus and are joined by key; only a few numbers an order reach the driver. Words are counted
as numbers: common ones by their rank, others by 63 bits of a hash, so that a run is mostly one long on its way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.sources import written

START = "\n"  # stands before a text's first word; no word holds white space
WORD = r"[^ \t\n\r]+"
HOT = 1000
LONG = 64
RANKED = 1 << 20  # words with a 2^20th of all words or more have a rank, so as many at most
HOT_WORDS = 500
ASKED = 1 << 48
OTHER = -(1 << 63)  # this bit marks the hash of a word without a rank


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], hot: int = HOT) -> DataFrame:
    """`rows` with the columns of `table`, null where it has no such key; `table` has one row a key, and no key is null.

    Keys with 1/`hot` of the rows or more, so at most `hot` of them, go to every task and their rows stay where they are; others are
    shuffled. `rows` should be a written table, as it is read three times.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    common = written(counts.where(F.col("_n") * hot >= max(1, rows.count())).drop("_n").join(table, keys, "left"))
    here = F.broadcast(common)  # at most `hot` rows
    return rows.join(here, keys).unionByName(rows.join(here.select(*keys), keys, "left_anti").join(table, keys, "left"))


def _names(order: int) -> list[str]:
    return [f"w{i}" for i in range(order)]


def _padded(text: str, order: int) -> Column:
    """The words of a text in lower case, long ones as a digest, after the marks of its start."""
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({WORD})"), F.lit(1))
    short = F.transform(found, lambda w: F.when(F.length(w) > LONG, F.sha2(w, 256)).otherwise(w))
    return F.concat(F.array_repeat(F.lit(START), order - 1), short)


def _each(rows: DataFrame, keys: list[str], order: int) -> DataFrame:
    """keys, w0 to w{order-1}: the runs of the array `_t`."""
    shifted = [F.slice("_t", i + 1, F.greatest(F.size("_t") - (order - 1), F.lit(0))) for i in range(order)]
    return rows.where(F.size("_t") >= order).select(*keys, F.inline(F.arrays_zip(*shifted))).toDF(*keys, *_names(order))


def runs(texts: DataFrame, keys: list[str], text: str, order: int) -> DataFrame:
    """keys, w0 to w{order-1}: a row for each word, the last column, after the words before it in lower case."""
    return _each(texts.select(*keys, _padded(text, order).alias("_t")), keys, order)


class Model:
    """A corpus as hashed words, and the ranks of its common words; `hot` is the last rank of those that a task alone should not count."""

    def __init__(self, texts: DataFrame, text: str, order: int) -> None:
        self.order, self.names, self.bits = order, _names(order), min(63 // order, RANKED.bit_length())
        self.hashed = texts.select(F.transform(_padded(text, order), lambda w: F.xxhash64(w)).alias("_t"))
        words = written(self.hashed.select(F.explode("_t").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
        total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        common = words.where(F.col("n") * min(RANKED, (1 << self.bits) - 1) >= total)
        self.ranks = written(common.select("word", F.row_number().over(Window.orderBy(F.desc("n"), "word")).alias("rank")))
        self.hot = common.where(F.col("n") * HOT_WORDS >= total).count()

    def ranked(self, rows: DataFrame) -> DataFrame:
        """`rows` whose names are hashes, with the rank of each in `_r{name}`, null where it has none."""
        for w in self.names[-2:-1] + self.names[:-2] + self.names[-1:]:  # the one that rows are chosen by first
            rows = rows.join(F.broadcast(self.ranks.select(F.col("word").alias(w), F.col("rank").cast("bigint").alias(f"_r{w}"))), w, "left")
        return rows

    def code(self, w: str) -> Column:
        return F.coalesce(F.col(f"_r{w}"), F.col(w).bitwiseOR(F.lit(OTHER)))

    def packed(self, rows: DataFrame) -> DataFrame:
        """`_k`, the ranks of a run side by side, and in `_h{name}` the hashes of words without one, else 0."""
        k: Column = reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(F.coalesce(F.col(f"_r{w}"), F.lit(0).cast("bigint")), self.bits * i) for i, w in enumerate(self.names)])
        k = k.bitwiseOR(F.when(F.col("asked"), F.lit(OTHER)).otherwise(F.lit(0).cast("bigint")))
        return rows.select(k.alias("_k"), *[F.when(F.col(f"_r{w}").isNull(), self.code(w)).otherwise(F.lit(0).cast("bigint")).alias(f"_h{w}") for w in self.names])

    def unpacked(self, w: str) -> Column:
        rank = F.shiftrightunsigned("_k", self.bits * self.names.index(w)).bitwiseAND(F.lit((1 << self.bits) - 1))
        return F.when(F.col(f"_h{w}") == 0, rank).otherwise(F.col(f"_h{w}"))


def counted(texts: DataFrame, text: str, order: int = 3) -> Model:
    """The model of a corpus: its runs of `order` words, and of shorter ones how many different words precede them, are counted when chances are asked for."""
    return Model(texts, text, order)


def _counts(given: DataFrame, model: Model) -> DataFrame:
    """level, starts, names, asked, upto3, rows, n, kinds: of each length the counts of the runs of `given` (hashes) and the totals of what they begin with,
    and how many other runs there are with a count of 1, 2 and more.

    Runs of two words or more, what they begin with, and the shorter runs in them all hold the word before the last. Runs go to that word's task,
    where all lengths are counted; those with a hot word there, which are fewer once counted, are counted by key.
    """
    names, order = model.names, model.order
    both = _each(model.hashed, [], order).withColumn("asked", F.lit(False)).unionByName(given.withColumn("asked", F.lit(True)))
    both = model.ranked(both)
    plain = [model.unpacked(w).alias(w) for w in names]
    # one sum for both, so that what is shuffled is alike wherever it is used, and shuffled once; a run is asked for once
    seen = F.sum(F.when(F.col("_k") < 0, F.lit(ASKED)).otherwise(F.lit(1).cast("bigint"))).alias("seen")
    split = [F.col("seen").bitwiseAND(F.lit(ASKED - 1)).alias("n"), (F.col("seen") >= ASKED).alias("asked")]

    def by_key(rows: DataFrame) -> DataFrame:
        keys = [F.col("_k").bitwiseAND(F.lit(~OTHER)).alias("_k"), *[F.col(f"_h{w}") for w in names]]
        return model.packed(rows).groupBy(*keys).agg(seen).select(*plain, *split)

    def by_word(rows: DataFrame) -> DataFrame:
        return model.packed(rows).repartition(model.unpacked(names[-2])).select(*plain, "_k").groupBy(*names).agg(seen).select(*names, *split)

    def shorter(df: DataFrame, held: list[str]) -> DataFrame:
        return df.groupBy(*held).agg(F.count_if(F.col("n") > 0).alias("n"), F.bool_or("asked").alias("asked"))

    def columns(level: int, starts: bool, held: list[str]) -> list[Column]:
        return [F.lit(level).alias("level"), F.lit(starts).alias("starts"), *[(F.col(w) if w in held else F.lit(None).cast("bigint")).alias(w) for w in names], F.col("asked"), F.col("upto3"), F.col("rows"), F.col("n"), F.col("kinds")]

    none, facts = F.lit(0).cast("bigint"), []
    if order > 1:
        hot = F.coalesce(F.col(f"_r{names[-2]}") <= model.hot, F.lit(False))
        parts = [by_word(both.where(~hot)), by_key(both.where(hot))]
    else:
        parts = [by_key(both)]
    for level in range(order, 0, -1):
        held = names[order - level :]
        if level < order:
            parts = [shorter(p, held) for p in parts] if level > 1 else [shorter(reduce(DataFrame.unionByName, parts), held)]
        every = reduce(DataFrame.unionByName, parts)
        told = every.groupBy(*[F.when(F.col("asked"), F.col(w)).alias(w) for w in held], "asked", F.least("n", F.lit(3)).alias("upto3")).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
        facts.append(told.withColumn("kinds", none).select(*columns(level, False, held)))
        for p in parts if level > 1 else []:
            begun = p.groupBy(*held[:-1]).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("kinds"), F.bool_or("asked").alias("asked")).where("asked and n > 0")
            facts.append(begun.withColumns({"upto3": none, "rows": none}).select(*columns(level, True, held[:-1])))
    return written(reduce(DataFrame.unionByName, facts))


def chances(wanted: DataFrame, model: Model) -> DataFrame:
    """Distinct runs of `wanted`, each with the chance `p` of its last word after those before it; unseen words share what the discount leaves for one."""
    names, order = model.names, model.order
    asked = written(wanted.select(*names).distinct())
    counts = _counts(asked.select(*[F.xxhash64(w).alias(w) for w in names]), model)
    numbers = {(r.level, r.upto3): r for r in counts.where("not starts").groupBy("level", "upto3").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n")).collect()}  # four a length
    p = None
    for level in range(1, order + 1):
        held = names[order - level :]
        rows, n = ([numbers[level, i][x] if (level, i) in numbers else 0 for i in range(1, 4)] for x in ("rows", "n"))
        discount = rows[0] / (rows[0] + 2 * rows[1]) if rows[0] else 0.5
        over = F.greatest(F.col("n") - F.lit(float(discount)), F.lit(0.0))
        of_level = counts.where(F.col("asked") & (F.col("level") == level))
        seen = of_level.where("not starts").select(*held, "n")
        if p is None:
            left = discount * sum(rows) / (sum(rows) + 1)
            p = written(seen.select(*held, ((over + F.lit(float(left))) / F.lit(float(sum(n))) if sum(n) else F.lit(1.0)).alias("p")))
            continue
        started = looked_up(seen, of_level.where("starts").select(*held[:-1], F.col("n").alias("total"), "kinds"), held[:-1])
        met = looked_up(written(started), p.withColumnRenamed("p", "less"), held[1:])
        kept = (over + F.lit(float(discount)) * F.col("kinds") * F.col("less")) / F.col("total")
        p = written(met.select(*held, F.coalesce(kept, F.col("less")).alias("p")))
    text = [f"_{w}" for w in names]
    coded = model.ranked(asked.select(*[F.col(w).alias(t) for w, t in zip(names, text, strict=True)], *[F.xxhash64(w).alias(w) for w in names]))
    found = coded.select(*text, *[model.code(w).alias(w) for w in names]).join(p, names).select(*text, "p")
    return written(found.toDF(*names, "p"))


def surprise(texts: DataFrame, keys: list[str], text: str, model: Model) -> DataFrame:
    """keys, words, bits: the number of words of each text and the mean of -log2 of their chances; (0, 0.0) for a null text or one without words.

    `keys` name a text and are not null; rows with equal ones count as one text. Words are runs without white space, in lower case. A text that is
    in the corpus itself is less surprising than one like it that is not.
    """
    top, own = model, [f"_key{i}" for i in range(len(keys))]
    named = texts.select(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], F.col(text).alias("_text"))
    given = written(runs(named, own, "_text", model.order).groupBy(*own, *top.names).agg(F.count(F.lit(1)).alias("n")))
    scored = looked_up(given, chances(given, model), top.names)
    sums = scored.groupBy(*own).agg(F.sum("n").alias("words"), (F.sum((0 - F.log2("p")) * F.col("n")) / F.sum("n")).alias("bits"))
    every = named.select(*own).distinct().join(sums, own, "left")
    return every.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=True)], F.coalesce("words", F.lit(0)).alias("words"), F.coalesce("bits", F.lit(0.0)).alias("bits"))

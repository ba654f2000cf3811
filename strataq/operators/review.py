"""Question review: pairs, rule checks, duplicates, contamination, labels, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.functions import content_id, normalised, only_letters, window_hashes, words
from strataq.sources import written

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def question_pairs(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, question, answer: user turns that an assistant turn follows. One shuffle, on the conversation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    ahead = conversations.select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("_role"), F.lead("text").over(w).alias("answer"))
    return ahead.where("role = 'user' and _role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")


def with_ids(pairs: DataFrame, origin: str = "seed") -> DataFrame:
    return pairs.withColumn("question_id", F.md5(F.concat_ws("|", content_id(F.col("question")), F.lit(origin), F.col("conv_id"), F.col("turn"))))


def review(pairs: DataFrame, least: int = 20, most: int = 4000) -> DataFrame:
    """question_id, passed, reasons: every rule that a pair breaks, in the rules' order. Nulls break `empty`."""
    q, a = F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit(""))
    rules = {"empty": (F.trim(q) == "") | (F.trim(a) == ""), "short": F.length(a) < least, "long": F.length(a) > most, "echo": normalised(q) == normalised(a), "personal": q.rlike(EMAIL) | a.rlike(EMAIL)}
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return with_ids(pairs).select("question_id", (F.size(reasons) == 0).alias("passed"), F.array_join(reasons, ",").alias("reasons"))


def exact_duplicates_removed(docs: DataFrame) -> DataFrame:
    """Of each text the row of the least id: a group by the text's hash with partial minima, so copies are folded before the shuffle."""
    return docs.groupBy(F.sha2("text", 256).alias("text_id")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, item_id: documents that hold a whole benchmark item.

    An item's inner words are whole words of any text that holds it, so one window of up to n of
    them (the least hash) is looked up among the document's windows of that size; only ids are
    joined, and only the texts of hits are fetched and searched. Items of one or two words have no
    inner word and are searched in every document. An empty or null item is none.
    """
    tokens = F.split(F.col("text"), r"[ \t\n\r]+")
    items = benchmark.select("item_id", F.col("text").alias("item"), tokens.alias("t")).withColumn("m", F.least(F.size("t") - 2, F.lit(n)))
    hits = docs.select("doc_id", F.lit(None).cast("bigint").alias("item_id")).limit(0)
    sizes = sorted(r.m for r in items.where("m > 0").select("m").distinct().collect())  # n numbers at most
    for m in sizes:
        inner = items.where(F.col("m") == m).select("item_id", F.array_min(window_hashes(F.slice("t", F.lit(2), F.size("t") - 2), m)).alias("inner"))
        hits = hits.unionByName(docs.select("doc_id", F.explode(window_hashes(tokens, m)).alias("inner")).join(inner, "inner").select("doc_id", "item_id"))
    found = hits.distinct().join(docs.select("doc_id", "text"), "doc_id").join(items.select("item_id", "item"), "item_id").where(F.contains("text", "item")).select("doc_id", "item_id")
    tiny = items.where("m <= 0 and item <> ''").select("item_id", "item")
    anywhere = docs.select("doc_id", "text").join(tiny, F.contains("text", "item")).select("doc_id", "item_id")
    return found.unionByName(anywhere).distinct()


_WORDS_OF_BITS, _GROUP, _LOADS, _WIDE = 8, 4096, 1 << 18, 128


def _bit(item: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), item.bitwiseAND(F.lit(63)).cast("int"))


def _held_often(named: DataFrame) -> list[int]:
    """A bit for each value of the last bits of a window: whether windows that end so are held twice as often as the mean or more."""
    loads = named.select(F.explode("items").alias("item")).groupBy(F.col("item").bitwiseAND(F.lit(_LOADS - 1)).alias("end")).agg(F.count(F.lit(1)).alias("n"))
    loads = written(loads)  # as many rows at most
    total = loads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = loads.where(F.col("n") * _LOADS >= 2 * total).groupBy(F.shiftright("end", 6).cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(end & 63 AS INT)))").alias("bits"))
    found = {r.word: r.bits for r in bits.collect()}
    return [found.get(i, 0) for i in range(_LOADS // 64)]


def _alike_by_wide_parity(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: `pairs` without those whose parities by 8,192 bits are too far apart, where 512 bits can't tell as the sets are long."""
    far = (100 - percent) * F.col("both") >= (100 + percent) * 32 * _WORDS_OF_BITS  # sets without a common window differ in half the bits
    long_ = sets.join(pairs.where(far).select(F.explode(F.array("a", "b")).alias("class_id")).distinct(), "class_id", "left_semi")
    word = F.shiftright("item", 6).bitwiseAND(F.lit(_WIDE - 1)).cast("int")
    by_word = long_.select("class_id", F.explode("items").alias("item")).groupBy("class_id", word.alias("word")).agg(F.bit_xor(_bit(F.col("item"))).alias("bits"))
    found = by_word.groupBy("class_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    wide = written(found.select("class_id", F.transform(F.sequence(F.lit(0), F.lit(_WIDE - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("bigint"))).alias("bits")))
    side = lambda x: wide.select(F.col("class_id").alias(x), F.col("bits").alias(f"bits_{x}"))
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    near = pairs.where(far).join(side("a"), "a").join(side("b"), "b").where((100 + percent) * apart <= (100 - percent) * F.col("both"))
    return pairs.where(~far).select("a", "b").unionByName(near.select("a", "b"))


def near_duplicate_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, class_id, n_links: exact similarity of n-word windows, `percent` or more.

    Documents of one window set are a class, named by its least id. Classes are linked by a
    prefix filter: two sets that are alike share one of their first size - ceil(percent * size / 100) + 1
    windows, in any order that is the same for all sets, so only these are shuffled; the order is that of the hashes, with windows
    last whose last bits are those of windows held often. Where two sets first share one, both
    must still have room for the overlap that they need, and they are of neighbouring size bins. Then
    the parities of both sets, 512 bits by window, are compared: they differ in no more bits than
    the sets in windows, so no pair alike is lost, and few others are left whose sets are fetched;
    long sets are compared once more by 8,192 bits.
    Windows that many classes hold are joined in groups. n_links counts the other classes alike. Documents under
    n words are classes of their own text, without links; null texts are one class.
    """
    tokens = words(only_letters(F.col("text")))
    sets = docs.select("doc_id", F.sort_array(window_hashes(tokens, n)).alias("items"), F.coalesce(F.md5("text"), F.lit("null")).alias("_text"))
    set_id = F.when(F.size("items") > 0, F.md5(F.concat_ws(",", F.col("items").cast("array<string>")))).otherwise(F.concat(F.lit("text "), F.col("_text")))
    named = written(sets.select("doc_id", "items", set_id.alias("set_id")))
    classes = written(named.groupBy("set_id").agg(F.min("doc_id").alias("class_id")))
    held = named.where(F.size("items") > 0).select(F.col("doc_id").alias("class_id"), "items", F.size("items").alias("size"))
    often = F.array(*map(F.lit, _held_often(named)))
    is_often = lambda x: F.get(often, F.shiftright(x.bitwiseAND(F.lit(_LOADS - 1)), 6).cast("int")).bitwiseAND(_bit(x)) != 0
    ordered = F.concat(F.filter("items", lambda x: ~is_often(x)), F.filter("items", is_often))
    first = F.slice(ordered, 1, F.col("size") - F.ceil(percent * F.col("size") / 100).cast("int") + 1)
    each = held.select("class_id", "size", F.posexplode(first).alias("place", "item")).select("class_id", "item", "size", (F.col("size") - F.col("place")).alias("rest"))
    each = written(each.join(classes.select("class_id"), "class_id", "left_semi"))
    shared = each.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bits = [F.coalesce(F.bit_xor(F.expr(f"CASE WHEN (item >> 6 & {_WORDS_OF_BITS - 1}) = {w} THEN shiftleft(1L, CAST(item & 63 AS INT)) END")), F.lit(0)).alias(f"x{w}") for w in range(_WORDS_OF_BITS)]
    parities = held.select("class_id", F.explode("items").alias("item")).groupBy("class_id").agg(*bits)
    ranked = written(each.join(shared, "item"))
    ranked = written(ranked.join(parities, "class_id"))
    bin_ = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100 / percent)))
    groups = F.ceil(F.col("n") / _GROUP).cast("int")
    side = lambda x: [F.col("class_id").alias(x), F.col("size").alias(f"n{x}"), F.col("rest").alias(f"r{x}"), *[F.col(f"x{w}").alias(f"{x}{w}") for w in range(_WORDS_OF_BITS)]]
    small = ranked.where((100 + percent) * F.col("rest") >= 2 * percent * F.col("size")).select("item", bin_.alias("bin"), F.pmod(F.xxhash64("class_id"), groups).cast("int").alias("group"), *side("u"))
    large = ranked.select("*", F.explode(F.array(bin_, bin_ - 1, bin_ - 2)).alias("bin")).select("item", "bin", F.explode(F.sequence(F.lit(0), groups - 1)).alias("group"), *side("v"))
    fits = (100 + percent) * F.least("ru", "rv") >= percent * (F.col("nu") + F.col("nv"))
    order = (F.col("nu") < F.col("nv")) | ((F.col("nu") == F.col("nv")) & (F.col("u") < F.col("v")))
    apart = sum(F.bit_count(F.col(f"u{w}").bitwiseXOR(F.col(f"v{w}"))) for w in range(_WORDS_OF_BITS))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("nu") + F.col("nv"))
    likely = small.join(large, ["item", "bin", "group"]).where(fits & order & near).select(F.col("u").alias("a"), F.col("v").alias("b"), (F.col("nu") + F.col("nv")).alias("both")).distinct()
    likely = written(likely)
    sets = written(held.join(likely.select(F.explode(F.array("a", "b")).alias("class_id")).distinct(), "class_id", "left_semi"))
    likely = written(_alike_by_wide_parity(likely, sets, percent))
    whole = lambda x: sets.select(F.col("class_id").alias(x), F.col("items").alias(f"items_{x}"))
    common = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - common
    links = likely.join(whole("a"), "a").join(whole("b"), "b").where(100 * common >= percent * union).select("a", "b")
    counts = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    members = named.select("doc_id", "set_id").join(classes.select("set_id", "class_id"), "set_id")
    return members.join(counts, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def with_email(docs: DataFrame) -> DataFrame:
    return docs.where(F.contains("text", F.lit("@")) & F.col("text").rlike(EMAIL)).select("doc_id")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return docs.join(labels, "doc_id", "left").groupBy(F.coalesce("quality", F.lit(-1)).alias("quality")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


def unlabelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return docs.join(labels, "doc_id", "left_anti").select("doc_id")


def report(docs: DataFrame) -> DataFrame:
    return docs.cube("lang", "source").agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


def role_paths(conversations: DataFrame) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return conversations.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["role"]), ">").alias("path"))

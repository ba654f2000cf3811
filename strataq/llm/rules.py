r"""Quality rules: text statistics, fixed limits, and a learned ordered list of threshold conjunctions.

DataFrame functions only. Statistics are computed within each row. The list is learned by
sequential covering: a rule for low quality grows by the threshold test with the best gain, is
pruned on rows held back, and takes what it covers out of the rest. Only counts by feature and bin
reach the driver. The result is one conditional expression, in the rules' order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_share, let, written

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_POSITION_BITS = 26
#: Labelled rows that the list is learned from, at most about; a hash of the id chooses them.
MOST_LABELLED = 200_000
MOST_RULES, MOST_TESTS, BINS = 8, 3, 24


def _removed(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def _repeated_words(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more: sorting hashes finds candidates, the words decide."""
    low = (1 << _POSITION_BITS) - 1
    empty = F.array().cast("array<bigint>")

    def of_hashes(w: Column, h: Column) -> Column:
        window = lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2])
        places = F.sequence(F.lit(0), F.size(h) - 3)
        # hash and place share a long, which sorts fast; a text of more places than its bits can tell has them side by side
        short = F.transform(places, lambda i: window(i).bitwiseAND(~low).bitwiseOR(i.cast("bigint")))
        long_ = F.transform(places, lambda i: F.struct(window(i).alias("k"), i.alias("p")))

        def candidates(s: Column, key, place) -> Column:
            same = lambda x, y: F.coalesce(key(x) == key(y), F.lit(False))
            twice = F.filter(s, lambda x, j: same(x, F.get(s, j + 1)) | same(x, F.get(s, j - 1)))
            return F.transform(twice, place)

        in_bits = let(F.sort_array(short), lambda s: candidates(s, lambda x: F.shiftright(x, _POSITION_BITS), lambda x: x.bitwiseAND(low).cast("int")))
        beside = let(F.sort_array(long_), lambda s: candidates(s, lambda x: x["k"], lambda x: x["p"]))

        def confirmed(c: Column) -> Column:
            named = F.array_sort(F.transform(c, lambda p: F.struct(F.array(w[p], w[p + 1], w[p + 2]).alias("w"), p.alias("p"))))

            def kept(s: Column) -> Column:
                same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
                return F.transform(F.filter(s, lambda x, j: same(x, F.get(s, j + 1)) | same(x, F.get(s, j - 1))), lambda x: x["p"].cast("bigint"))

            return F.when(F.size(c) > 0, F.array_sort(let(named, kept))).otherwise(empty)

        return let(F.when(F.size(h) <= low, in_bits).otherwise(beside), confirmed)

    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    covered = lambda p: F.aggregate(p, start, lambda acc, x: F.struct((x + 3).alias("end"), (acc["n"] + x + 3 - F.greatest(x, acc["end"])).alias("n")), lambda acc: acc["n"])
    hashed = lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: of_hashes(w, h))
    return let(words, lambda w: F.when(F.size(w) > 3, covered(hashed(w))).otherwise(F.lit(0).cast("bigint")))


def statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and long counts of every whole text; a null text has none of anything."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+", -1), "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    both = let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _repeated_words(w).alias("n_repeat_words")))
    line = let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), t.alias("_t"), both.alias("_w"), line.alias("_l")).select(
        "doc_id",
        F.col("_w.n_words"),
        F.length(F.translate("_t", _SPACE, "")).cast("bigint").alias("word_chars"),
        _removed(F.col("_t"), SYMBOLS).alias("n_symbols"),
        F.col("_l.n_dup_lines"),
        F.col("_w.n_repeat_words"),
        F.col("_l.n_lines"),
        _removed(F.col("_t"), _UPPER).alias("n_upper"),
        _removed(F.col("_t"), "!?").alias("n_exclaimed"),
        _removed(F.col("_t"), "0123456789").alias("n_digits"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What rules test: whole numbers, shares in thousandths."""
    share = lambda n, of: F.when(F.col(of) > 0, F.floor(1000 * F.col(n) / F.col(of))).otherwise(0).cast("bigint")
    return {
        "words": F.col("n_words"),
        "repeated": share("n_repeat_words", "n_words"),
        "symbols": share("n_symbols", "word_chars"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "upper": share("n_upper", "word_chars"),
        "exclaimed": share("n_exclaimed", "word_chars"),
        "digits": share("n_digits", "word_chars"),
        "word_length": share("word_chars", "n_words"),
        "line_length": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: int

    def column(self) -> Column:
        x = F.col(f"f.{self.feature}")
        return x >= self.threshold if self.above else x < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold}"


Rule = tuple[Test, ...]


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [t.column() for t in rule])


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one expression over the struct `f`: true keeps."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(holds(rule), F.lit(False)).otherwise(out)
    return out


def _counts(rows: DataFrame, cuts: dict[str, list[int]]) -> dict[tuple[str, int], tuple[int, int]]:
    """By feature and bin (cuts passed) the rows of low quality and the others; at most features times bins rows."""
    bins = []
    for name, c in cuts.items():
        passed = reduce(lambda a, b: a + b, [F.when(F.col(f"f.{name}") >= x, 1).otherwise(0) for x in c], F.lit(0))
        bins.append(F.struct(F.lit(name).alias("feature"), passed.alias("bin")))
    found = rows.select("bad", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    return {(r.feature, r.bin): (r.p, r.n) for r in found}


def _best(counts: dict[tuple[str, int], tuple[int, int]], cuts: dict[str, list[int]]) -> tuple[float, Test] | None:
    first = next(iter(cuts))
    p0 = sum(p for (f, _), (p, _) in counts.items() if f == first)
    n0 = sum(n for (f, _), (_, n) in counts.items() if f == first)
    if not p0 or not n0:
        return None
    before, best = math.log2(p0 / (p0 + n0)), None
    equal: list[Test] = []
    for name, c in cuts.items():
        for i, threshold in enumerate(c):
            p_up = sum(p for (f, b), (p, _) in counts.items() if f == name and b > i)
            n_up = sum(n for (f, b), (_, n) in counts.items() if f == name and b > i)
            for above, p, n in ((True, p_up, n_up), (False, p0 - p_up, n0 - n_up)):
                gain = p * (math.log2(p / (p + n)) - before) if p else 0
                if gain > (best[0] if best else 1e-9):
                    best, equal = (gain, Test(name, above, threshold)), []
                if best and gain == best[0] and (name, above) == (best[1].feature, best[1].above):
                    equal.append(Test(name, above, threshold))
    return best and (best[0], equal[len(equal) // 2])  # of equal thresholds the middle, with room on both sides


def learn(labelled: DataFrame, most_rules: int = MOST_RULES, most_tests: int = MOST_TESTS, least_precision: float = 0.8, least_covered: int = 5) -> list[Rule]:
    """Rules for low quality. labelled: f (struct of features), bad (0 or 1), part (0 to 2; 2 prunes).

    Without rows of both kinds there is no rule.
    """
    names = labelled.schema["f"].dataType.names
    probes = [(i + 0.5) / BINS for i in range(BINS)]
    asked = [F.percentile_approx(F.when(F.col("bad") == b, F.col(f"f.{n}")), probes, 1000).alias(f"{n}_{b}") for n in names for b in (0, 1)]
    seen = labelled.agg(*asked).first()
    cuts = {n: c for n in names if (c := sorted({int(x) + d for b in (0, 1) for x in seen[f"{n}_{b}"] or () for d in (0, 1)}))}
    rules: list[Rule] = []
    if not cuts:
        return rules
    while len(rules) < most_rules:
        left = labelled.where(verdict(rules))
        rule: Rule = ()
        for _ in range(most_tests):
            grown = left.where("part < 2").where(holds(rule) if rule else F.lit(True))
            best = _best(_counts(grown, cuts), cuts)
            if best is None:
                break
            rule = (*rule, best[1])
        if not rule:
            break
        # the shortest beginning that does best on the rows held back
        checks = [x for i in range(len(rule)) for x in (F.sum(F.when(holds(rule[: i + 1]), F.col("bad")).otherwise(0)).alias(f"p{i}"), F.sum(F.when(holds(rule[: i + 1]), 1 - F.col("bad")).otherwise(0)).alias(f"n{i}"))]
        held = left.where("part = 2").agg(*checks).first()
        worth = [((held[f"p{i}"] or 0) - (held[f"n{i}"] or 0)) / max(1, (held[f"p{i}"] or 0) + (held[f"n{i}"] or 0)) for i in range(len(rule))]
        at = max(range(len(rule)), key=lambda i: (worth[i], -i))
        p, n = held[f"p{at}"] or 0, held[f"n{at}"] or 0
        if p + n < least_covered or p < least_precision * (p + n):
            break
        rules.append(rule[: at + 1])
    return rules


def decide(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, the statistics, base_failed, kept, and the rules (text) of every row.

    Labels: doc_id, quality; null ones don't count, of repeated ones the least does. Rows that the
    limits reject teach nothing. With more than `most_labelled` labels a hash of the id chooses
    about that many. No labels: the limits alone decide. Null ids and repeated rows are rows like
    others. Other columns don't matter.
    """
    counted = written(statistics(docs, text, doc_id), "statistics")
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_q"))
    share = min(1.0, most_labelled / max(1, marks.count()))
    marks = marks.where(in_share(F.col("_id"), 1, share))
    f = F.struct(*[c.alias(n) for n, c in features().items()])
    taught = counted.where(~base_failed()).join(marks, counted["doc_id"] == F.col("_id"))
    taught = written(taught.select(f.alias("f"), (F.col("_q") == 0).cast("bigint").alias("bad"), F.pmod(F.xxhash64("_id", F.lit(2)), F.lit(3)).alias("part")), "taught")
    rules = learn(taught)
    told = "; ".join(" and ".join(map(str, r)) for r in rules)
    failed = counted.withColumn("base_failed", base_failed()).withColumn("f", f)
    return failed.withColumn("kept", ~F.col("base_failed") & verdict(rules)).withColumn("rules", F.lit(told)).drop("f")

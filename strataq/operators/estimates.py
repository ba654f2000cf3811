"""Estimates fitted in rounds of partial sums: reviewers' agreement, and difficulty from solve rates.

State is a table a round, so lineage ends there; each round joins votes or answers to it by key and adds up
before the shuffle. Where one reviewer, solver or item has a third of all rows adaptive execution splits the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.sources import written

SMOOTH = 0.01


def agreement(votes: DataFrame, classes: Sequence[str], rounds: int = 20, tolerance: float = 1e-6) -> tuple[DataFrame, DataFrame]:
    """What reviewers agree on (item, class, p) and how each votes (reviewer, class, vote, share), by expectation-maximisation
    over their confusion matrices (Dawid & Skene, 1979).

    votes: item, reviewer, vote; rows with a null, and votes of no class, don't count, repeated rows count each. `classes` is a short closed
    list. Rounds end early when no p moves by more than `tolerance`. Items without a vote have no row.
    """
    cases = F.explode(F.array(*map(F.lit, classes))).alias("class")
    given = written(votes.where(F.col("vote").isin(*classes) & F.col("item").isNotNull() & F.col("reviewer").isNotNull()).select("item", "reviewer", "vote"))
    counts = given.groupBy("item").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("vote") == c).alias(f"v{i}") for i, c in enumerate(classes)])
    p = written(counts.select("item", F.explode(F.array(*[F.struct(F.lit(c).alias("class"), (F.col(f"v{i}") / F.col("n")).alias("p")) for i, c in enumerate(classes)])).alias("x")).select("item", "x.*"))
    n = counts.count()
    while True:
        sums = given.join(p, "item").groupBy("reviewer", "class", "vote").agg(F.sum("p").alias("sum"))
        every = sums.select("reviewer", "class").distinct().select("reviewer", "class", F.explode(F.array(*map(F.lit, classes))).alias("vote")).join(sums, ["reviewer", "class", "vote"], "left").withColumn("sum", F.coalesce("sum", F.lit(0.0)) + SMOOTH)
        whole = every.groupBy("reviewer", "class").agg(F.sum("sum").alias("whole"))
        share = written(every.join(whole, ["reviewer", "class"]).select("reviewer", "class", "vote", (F.col("sum") / F.col("whole")).alias("share")))
        if not rounds:
            return p, share
        rounds -= 1
        prior = {r["class"]: r["prior"] for r in p.groupBy("class").agg(((F.sum("p") + SMOOTH) / (n + SMOOTH * len(classes))).alias("prior")).collect()}  # a row a class
        start = F.coalesce(*[F.when(F.col("class") == c, F.lit(float(x))) for c, x in prior.items()]) if prior else F.lit(1.0)
        likely = given.select("*", cases).join(share, ["reviewer", "class", "vote"]).groupBy("item", "class").agg(F.sum(F.ln("share")).alias("log"))
        logs = likely.select("item", "class", (F.col("log") + F.ln(start)).alias("log"))
        most = logs.groupBy("item").agg(F.max("log").alias("most"))
        weights = logs.join(most, "item").select("item", "class", F.exp(F.col("log") - F.col("most")).alias("w"))
        new = written(weights.join(weights.groupBy("item").agg(F.sum("w").alias("all")), "item").select("item", "class", (F.col("w") / F.col("all")).alias("p")))
        moved = new.join(p.withColumnRenamed("p", "was"), ["item", "class"]).agg(F.max(F.abs(F.col("p") - F.col("was")))).first()[0]
        p = new
        if moved is None or moved <= tolerance:
            rounds = 0


def _chance(ability: Column, difficulty: Column) -> Column:
    return 1 / (1 + F.exp(difficulty - ability))


def solve_difficulty(answers: DataFrame, rounds: int = 30, tolerance: float = 1e-4) -> tuple[DataFrame, DataFrame]:
    """Difficulty of each item and ability of each solver from who solved what: a one-parameter item-response model (Rasch, 1960).

    answers: solver, item, solved (boolean); rows with a null don't count, repeated rows count each. Both are fitted in turn by a Newton
    step on the likelihood with a standard normal prior, which keeps those finite that all or none solved. Rounds end early when
    no difficulty moves by more than `tolerance`. Returns (item, difficulty, n) and (solver, ability, n).
    """
    given = written(answers.where("solver is not null and item is not null and solved is not null").select("solver", "item", F.col("solved").cast("double").alias("y")))
    items = written(given.groupBy("item").agg(F.count(F.lit(1)).alias("n")).select("item", F.lit(0.0).alias("difficulty"), "n"))
    solvers = written(given.groupBy("solver").agg(F.count(F.lit(1)).alias("n")).select("solver", F.lit(0.0).alias("ability"), "n"))
    for _ in range(rounds):
        for of_items in (False, True):
            key, value, table, sign = ("item", "difficulty", items, -1) if of_items else ("solver", "ability", solvers, 1)
            p = _chance(F.col("ability"), F.col("difficulty"))
            met = given.join(solvers.drop("n"), "solver").join(items.drop("n"), "item")
            sums = met.groupBy(key).agg(F.sum(F.col("y") - p).alias("slope"), F.sum(p * (1 - p)).alias("bend"))
            step = (sign * F.col("slope") - F.col(value)) / (F.col("bend") + 1)
            new = written(table.join(sums, key).select(key, (F.col(value) + F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step))).alias(value), "n"))
            if of_items:
                moved = new.join(items.select("item", F.col("difficulty").alias("was")), "item").agg(F.max(F.abs(F.col("difficulty") - F.col("was")))).first()[0]
                items = new
            else:
                solvers = new
        if moved is None or moved <= tolerance:
            break
    return items, solvers

"""Mixing sources by temperature and realising the weights as block permutations, built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitlens.session import written

# Exponents tried by one pass over the sources' totals (four halvings at once) and passes made.
_GRID, _PASSES = 16, 6


@dataclass(frozen=True)
class Mixture:
    """What to aim for.

    ``entropy`` is the least entropy of the weights, as a share of that of equal weights;
    ``repeats`` the most often a source may be gone through; ``budget`` the tokens to draw in all,
    by default as many as make every source come whole at least once. The repetition limit goes
    before the entropy. A block holds about ``block_docs`` documents.
    """

    entropy: float = 0.92
    repeats: float = 2.0
    budget: float | None = None
    block_docs: int = 256
    seed: int = 11


def hashed(*parts: Column | str) -> Column:
    """A number below 2^60 that depends on the parts' texts only: the first digits of an MD5 sum."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, 15), 16, 10).cast("long")


def word_tokens(text: Column) -> Column:
    """Words of a text, by ASCII white space; 0 for null."""
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    counted = F.length(F.regexp_replace(text, f"{space}*+{word}++{space}*+", "x"))
    return F.when(text.rlike(word), counted).otherwise(0).cast("long")


def total_tokens(docs: DataFrame, text_column: str = "text") -> int:
    return docs.agg(F.sum(word_tokens(F.col(text_column)))).first()[0] or 0


def exponent(sources: DataFrame, goal: Mixture) -> float:
    """The exponent of the sources' token shares, in [0, 1]: the largest, so nearest to the shares
    themselves, whose weights reach the entropy, or the smallest that keeps the repetition limit
    if that is larger. Without sources it is 1.

    Entropy and repetition fall as the exponent grows, so both limits are found by bisection. A
    pass is one aggregation over the sources for a grid of exponents, several halvings at once;
    only the grid's sums reach the driver.
    """
    power = F.pow("share", "a")
    rate = F.pow("share", F.col("a") - 1)
    entropy = F.log("z") - F.col("a") * F.col("l") / F.col("z")
    # Tokens drawn, as a multiple of those there are.
    drawn = F.col("z") / F.col("least") if goal.budget is None else F.lit(float(goal.budget)) / F.col("tokens")

    def measure(points: list[float]) -> list:
        grid = sources.select("share", "tokens", F.explode(F.array(*map(F.lit, points))).alias("a"))
        sums = grid.groupBy("a").agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("share")).alias("l"),
            F.max(rate).alias("most"),
            F.min(rate).alias("least"),
            F.sum("tokens").alias("tokens"),
            F.count(F.lit(1)).alias("n"),
        )
        even = F.when(F.col("n") > 1, entropy / F.log("n")).otherwise(1.0)
        return sums.select("a", even.alias("entropy"), (drawn * F.col("most") / F.col("z")).alias("repeats")).orderBy("a").collect()

    def border(low_side: bool, test) -> tuple[float, float]:
        """Neighbouring exponents between which ``test`` turns from ``low_side`` to its opposite."""
        low, high = 0.0, 1.0
        for _ in range(_PASSES):
            rows = measure([low + (high - low) * i / _GRID for i in range(_GRID + 1)])
            if not rows:
                return 1.0, 1.0
            turn = next((i for i, r in enumerate(rows) if test(r) != low_side), len(rows))
            if turn in (0, len(rows)):
                end = rows[min(turn, len(rows) - 1)].a
                return end, end
            low, high = rows[turn - 1].a, rows[turn].a
        return low, high

    by_entropy, _ = border(True, lambda r: r.entropy >= goal.entropy - 1e-12)
    _, by_repeats = border(False, lambda r: r.repeats <= goal.repeats + 1e-9)
    return max(by_entropy, by_repeats)


def mix(
    docs: DataFrame, goal: Mixture, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """(doc, epoch, turn, n_tokens): the rows of ``docs`` as often as their source's weight asks.

    ``doc`` is the whole row as a struct. A source with weight w gets w of the budget: it is gone
    through whole, as often as fits, and once more in part. Each time (``epoch``, from 0) its blocks
    come in another order (``turn``, from 1), given by hashes, and blocks are taken until the budget
    is spent; in the block where that happens, documents are taken in hash order up to it,
    rows of one id together. A block is a hash of the id, so a source of any size spreads over as many
    blocks as it needs, and orders are found over blocks, not documents. A source is null, a text
    null or empty like any other value; documents without a word cost nothing and come with their
    block; a source without any word comes once. Repeated rows stay together; an empty table gives no
    rows. Other columns, whatever their names, are only carried along.
    """
    source, seed = F.col(source_column), F.lit(goal.seed)
    key = hashed(seed, F.col(id_column))
    tokens = word_tokens(F.col(text_column))
    counted = written(docs.select(source.alias("source"), key.alias("key"), tokens.alias("tokens")), "counted")
    totals = counted.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    totals = written(totals.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1)))), "sources")
    spoken = totals.where("tokens > 0")
    alpha = exponent(spoken, goal)
    norm = spoken.agg(F.sum(F.pow("share", F.lit(alpha))).alias("z"), F.min(F.pow("share", F.lit(alpha - 1))).alias("least")).first()
    z, least = norm.z or 1.0, norm.least or 1.0
    budget = goal.budget if goal.budget is not None else whole * z / least
    quota = F.lit(float(budget)) * F.pow("share", F.lit(alpha)) / F.lit(z)
    # A hair more or less than a whole pass is a whole pass: sums are rounded.
    times = F.floor(quota / F.col("tokens") + 1e-9)
    over = quota - times * F.col("tokens")
    plan = written(
        totals.select(
            "source",
            F.ceil(F.col("docs") / goal.block_docs).alias("blocks"),
            F.when(F.col("tokens") > 0, times).otherwise(1).cast("int").alias("full"),
            F.when((F.col("tokens") > 0) & (over > F.col("tokens") * 1e-9), over).otherwise(0.0).alias("rest"),
        ),
        "plan",
    )
    block = (hashed(seed, F.lit("block"), "key") % F.col("blocks")).alias("block")

    def same(a: DataFrame, b: DataFrame, *names: str) -> Column:
        tests = [a[n].eqNullSafe(b[n]) for n in names]
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]

    placed = counted.join(plan, same(counted, plan, "source")).select(plan["source"], block, "key", "tokens", "full", "rest")
    blocks = placed.groupBy("source", "block").agg(
        F.sum("tokens").alias("tokens"), F.first("full").alias("full"), F.first("rest").alias("rest")
    )
    epochs = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("full"))).alias("epoch"))
    order = Window.partitionBy("source", "epoch").orderBy(hashed(seed, "epoch", "block"), "block")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = epochs.select("source", "block", "epoch", F.row_number().over(order).alias("turn"), before.alias("before"), "tokens", "full", "rest")
    # In the last, partial epoch a block starts before the rest is spent or is not taken.
    taken = turns.where((F.col("epoch") < F.col("full")) | ((F.col("rest") > 0) & (F.col("before") < F.col("rest"))))
    cut = (F.col("epoch") == F.col("full")) & (F.col("before") + F.col("tokens") > F.col("rest"))
    taken = written(taken.withColumn("cut", F.when(cut, F.col("rest") - F.col("before"))).drop("before", "tokens", "full", "rest"), "turns")

    # The one cut block of each source, by ids.
    cuts = taken.where(F.col("cut").isNotNull()).select("source", "block", "epoch", "cut")
    ids = placed.groupBy("source", "block", "key").agg(F.sum("tokens").alias("tokens"))
    inside = ids.join(cuts, same(ids, cuts, "source", "block")).select(ids["source"], ids["block"], "epoch", "key", "tokens", "cut")
    by_hash = Window.partitionBy("source", "block").orderBy(hashed(seed, "epoch", "key"), "key")
    spent = F.coalesce(F.sum("tokens").over(by_hash.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    some = inside.withColumn("spent", spent).where(F.col("spent") < F.col("cut")).select("source", "block", "epoch", "key")

    schedule = taken.groupBy("source", "block").agg(
        F.collect_list(F.when(F.col("cut").isNull(), F.struct("epoch", "turn"))).alias("whole"),
        F.max(F.when(F.col("cut").isNotNull(), F.struct("epoch", "turn"))).alias("part"),
    )
    rows = docs.select(F.struct("*").alias("doc"), source.alias("source"), key.alias("key"), tokens.alias("n_tokens"))
    rows = rows.join(plan, same(rows, plan, "source")).select("doc", plan["source"], block, "key", "n_tokens")
    rows = rows.join(schedule, same(rows, schedule, "source", "block")).select("doc", rows["source"], rows["block"], "key", "n_tokens", "whole", "part")
    some = some.withColumnsRenamed({"source": "s", "block": "b", "key": "k"}).select("s", "b", "k", F.lit(True).alias("in_part"))
    rows = rows.join(some, (F.col("key") == F.col("k")) & (F.col("block") == F.col("b")) & F.col("source").eqNullSafe(F.col("s")), "left")
    drawn = F.when(F.col("in_part"), F.concat("whole", F.array("part"))).otherwise(F.col("whole"))
    return rows.select("doc", "n_tokens", F.explode(drawn).alias("at")).select("doc", "at.epoch", "at.turn", "n_tokens")


def mixed_documents(docs: DataFrame, goal: Mixture, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """The rows that ``mix`` draws, with the columns of ``docs`` and nothing else."""
    return mix(docs, goal, id_column, source_column, text_column).select("doc.*")

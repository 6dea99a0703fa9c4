"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens raised to an exponent between 0 and 1, normalised.
The exponent is bisected until the weights have a target entropy, or until no source repeats
more often than a limit. Weights become budgets of tokens, and a budget becomes passes over the
source in block permutations: documents are dealt to blocks by a keyed hash, and each pass has its
own order of blocks and of documents in them. The last pass stops where the budget ends. ``draw`` says how
often each document is drawn, ``permutation`` where each draw stands.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relayframe.llm.tables import BLANKS, fresh, read
from relayframe.session import cut_lineage

#: Documents in a block, on average.
BLOCK_DOCS = 2048
#: Halvings of the exponent's range in one round, tried together, and rounds.
HALVINGS, ROUNDS = 5, 7


@dataclass(frozen=True)
class Target:
    """What the exponent is chosen for, and how many tokens are drawn.

    ``entropy`` is a share of the largest entropy, that of equal weights. ``repeats`` is how often
    the rarest source may be passed over for each pass over the commonest. With ``cover`` the
    budget is the least that passes every source once; else it is ``tokens``, or as many as there
    are.
    """

    entropy: float | None = None
    repeats: float | None = None
    cover: bool = False
    tokens: int | None = None


def token_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``: blanks and words are counted apart, without a split."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.coalesce(F.when(inner != "", F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).otherwise(0), F.lit(0)).cast("long")


def source_tokens(docs: DataFrame) -> DataFrame:
    """``source, n_docs, tokens`` over rows of ``source, tokens``; null is a source of its own."""
    return docs.groupBy("source").agg(F.sum("copies").alias("n_docs"), F.sum("tokens").alias("tokens"))


def _fits(share: Column, alpha: float, target: Target, sizes: dict) -> Column:
    """Aggregate: whether the weights at ``alpha`` are even enough still, or repeat too often."""
    power = F.pow(share, F.lit(alpha))
    if target.entropy is not None:
        z = F.sum(power)
        entropy = F.log(z) - F.sum(power * alpha * F.log(share)) / z
        return entropy >= target.entropy * math.log(max(sizes["n"], 1))
    limit = F.lit(sizes["most"] / sizes["least"]) if sizes["least"] else F.lit(1.0)
    return F.pow(limit, F.lit(1 - alpha)) > target.repeats


def exponent(sources: DataFrame, target: Target) -> float:
    """The exponent in [0, 1] for the target, rounded to 9 digits.

    For an entropy it is the largest that reaches it; for a limit the smallest that keeps to it.
    Sources without tokens have no share. Sources stay distributed: a round tries the next
    halvings of the range together, in one aggregate that gives the driver one row.
    """
    held = sources.where("tokens > 0")
    sizes = held.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("sum"), F.max("tokens").alias("most"),
                     F.min("tokens").alias("least")).first().asDict()
    if not sizes["n"] or (target.entropy is None and target.repeats is None):
        return 1.0
    share = F.col("tokens") / F.lit(float(sizes["sum"]))
    low, high = 0.0, 1.0
    if not held.agg(_fits(share, 0.0, target, sizes).alias("ok")).first()["ok"]:
        return 0.0
    if held.agg(_fits(share, 1.0, target, sizes).alias("ok")).first()["ok"]:
        return 1.0
    for _ in range(ROUNDS):
        n = 1 << HALVINGS
        tried = [low + (high - low) * i / n for i in range(1, n)]
        row = held.agg(*[_fits(share, a, target, sizes).alias(f"a{i}") for i, a in enumerate(tried)]).first()
        holds = sum(bool(x) for x in row)  # falls once along the range
        low, high = [low, *tried, high][holds], [low, *tried, high][holds + 1]
    return round(low if target.entropy is not None else high, 9)


def budgets(sources: DataFrame, target: Target) -> DataFrame:
    """``sources`` with ``weight``, ``budget``, full ``passes`` and the ``rest`` after them, in tokens.

    A source without tokens has weight 0 and is passed over once where the target covers all, as
    its documents cost nothing, and never else.
    """
    alpha = exponent(sources, target)
    total = Window.partitionBy()
    share = F.col("tokens") / F.sum("tokens").over(total)
    power = F.when(F.col("tokens") > 0, F.pow(share, F.lit(alpha))).otherwise(0.0)
    rows = sources.withColumn("power", power)
    sums = rows.agg(F.sum("power").alias("z"), F.sum("tokens").alias("all"),
                    F.max(F.when(F.col("power") > 0, F.col("tokens") / F.col("power"))).alias("cover")).first()
    z, n = sums["z"] or 1.0, float(sums["all"] or 0)
    weight = F.round(F.col("power") / F.lit(z), 12)
    wanted = (sums["cover"] or 0.0) * z if target.cover else float(target.tokens or n)
    budget = F.floor(F.lit(wanted) * F.col("weight") + 0.5).cast("long")
    if target.cover:
        budget = F.greatest(budget, F.col("tokens"))
    rows = rows.withColumn("weight", weight).withColumn("budget", budget)
    passes = F.when(F.col("tokens") > 0, F.floor(F.try_divide("budget", "tokens"))).otherwise(int(target.cover)).cast("long")
    return rows.withColumn("passes", passes).select(
        "source", "n_docs", "tokens", "weight", "budget", "passes",
        (F.col("budget") - F.col("passes") * F.col("tokens")).alias("rest"))


def _unit(seed: str, *columns: str) -> Column:
    """A keyed hash as a fraction of 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def draw(docs: DataFrame, target: Target, seed: str = "mix") -> DataFrame:
    """How often each distinct document is drawn.

    ``docs`` has ``doc_id, source, text``. Returns ``doc_id, source, text_hash, tokens, copies,
    weight, block, draws``: one row for each distinct (doc_id, source, text), with ``copies`` rows
    in ``docs`` that are drawn together and ``tokens`` for all of them. A document is drawn in each
    full pass, and in the last if the documents before it in that pass's order leave budget. Null
    text has no tokens; null sources and doc_ids are values like others.

    Blocks are of bounded size, so the order within one is a window over few rows, whatever the
    source holds. Blocks of one source are added up in a window over one row a block.
    """
    narrow = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), token_count(F.col("text")).alias("n"))
    narrow = cut_lineage(narrow.groupBy("doc_id", "source", "text_hash").agg(
        F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("copies")), "mix-tokens")
    sources = cut_lineage(budgets(source_tokens(narrow), target), "mix-budgets")
    n_blocks = F.ceil(F.col("n_docs") / BLOCK_DOCS)
    rows = (narrow.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
            .select("d.doc_id", "d.source", "d.text_hash", "d.tokens", "d.copies", "s.weight", "s.passes", "s.rest",
                    F.floor(_unit(seed, "d.doc_id", "d.text_hash") * n_blocks).alias("block")))
    order = _unit(f"{seed} pass", "passes", "block")
    blocks = rows.groupBy("source", "block").agg(
        F.sum("tokens").alias("block_tokens"), F.first("passes").alias("passes")).withColumn("place", order)
    ahead = (Window.unboundedPreceding, -1)
    along = Window.partitionBy("source").orderBy("place", "block").rowsBetween(*ahead)
    blocks = blocks.select("source", "block", F.coalesce(F.sum("block_tokens").over(along), F.lit(0)).alias("before"))
    inside = (Window.partitionBy("source", "block")
              .orderBy(_unit(f"{seed} doc", "passes", "doc_id", "text_hash"), "doc_id", "text_hash").rowsBetween(*ahead))
    rows = rows.withColumn("within", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    same = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.block") == F.col("b.block"))
    rows = rows.alias("r").join(blocks.alias("b"), same)
    last = (F.col("rest") > 0) & (F.col("before") + F.col("within") < F.col("rest"))
    return rows.select("doc_id", "r.source", "text_hash", "tokens", "copies", "weight", "r.block",
                       (F.col("passes") + last.cast("long")).alias("draws"))


def permutation(drawn: DataFrame, seed: str = "mix") -> DataFrame:
    """Where each draw stands: rows of ``draw``, once for each time the document is drawn.

    Adds ``pass`` (from 0), ``block_place`` (the place of its block among those of the source in this
    pass, from 1) and ``place`` (its own in the block). Reading a source by the three gives its budget;
    each pass has an order of its own, by keyed hashes of the pass. A document that is not drawn keeps
    one row, with nulls. ``seed`` is that of ``draw``, so the last pass ends where the draws end.
    """
    turns = F.when(F.col("draws") > 0, F.sequence(F.lit(0).cast("long"), F.col("draws") - 1))
    rows = drawn.select("*", F.explode_outer(turns).alias("pass"))
    inside = Window.partitionBy("source", "pass", "block").orderBy(
        _unit(f"{seed} doc", "pass", "doc_id", "text_hash"), "doc_id", "text_hash")
    along = Window.partitionBy("source", "pass").orderBy(_unit(f"{seed} pass", "pass", "block"), "block")
    blocks = (rows.where("pass is not null").groupBy("source", "pass", "block").agg(F.lit(1).alias("one"))
              .select("source", "pass", "block", F.row_number().over(along).cast("long").alias("block_place")))
    place = F.when(F.col("pass").isNotNull(), F.row_number().over(inside)).cast("long").alias("place")
    same = (F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.pass") == F.col("b.pass"))
            & (F.col("r.block") == F.col("b.block")))
    placed = rows.select("*", place).alias("r").join(blocks.alias("b"), same, "left")
    return placed.select("r.*", "block_place")


def mixture(docs: DataFrame, target: Target, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn, with their columns as they are."""
    drawn = draw(docs, target, seed).where("draws > 0")
    same = (F.col("d.doc_id").eqNullSafe(F.col("n.doc_id")) & F.col("d.source").eqNullSafe(F.col("n.source"))
            & (F.xxhash64("d.text") == F.col("n.text_hash")))
    turn = fresh(docs, "turn")
    rows = docs.alias("d").join(drawn.alias("n"), same)
    return rows.select("d.*", F.explode(F.sequence(F.lit(1), F.col("n.draws"))).alias(turn)).drop(turn)


#: The registered query: weights of 0.99 of the largest entropy, as many tokens as there are.
TARGET = Target(entropy=0.99)


def op9_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws of every document for ``TARGET``, each with its place in the permutation of its pass."""
    drawn = cut_lineage(draw(read(spark, sf_dir, "documents"), TARGET), "mix-draws")
    return permutation(drawn).select(
        "doc_id", "source", "tokens", "weight", "block", "draws", "pass", "block_place", "place")

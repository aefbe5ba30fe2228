"""Mixing sources to target weights (operator 1), in DataFrame functions only.

Source shares of tokens are raised to an exponent and normalised. The exponent is found by
bisection: the one whose weights have the target entropy, or the smallest (flattest mix) under
which no source is repeated more often than the limit. Weights become token budgets. Each source's
documents lie in blocks of about equal size; every pass over a source goes through its blocks in
a new permutation, and the last pass ends where the budget does.

Defined results: null text has no tokens; a null source is a source of its own; sources without
tokens have weight 0 and are left out unless the mix covers all; repeated rows are documents of
their own; null ids are allowed; an empty table gives no rows. A document at the end of a budget
is taken whole. Other columns are kept by ``mix`` and unread by ``schedule``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import column, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Tokens of a block. Blocks are ordered as wholes, so this bounds what one task orders.
BLOCK_TOKENS = 1 << 16
#: Parts into which one job cuts the bracket of the exponent: four bisections.
PARTS = 16
_OWN = "__mix_"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _number(text: Column, digits: int = 12) -> Column:
    """A reproducible number from a text."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def totals(rows: DataFrame) -> DataFrame:
    """(key, tokens, docs) for each source of rows with ``__mix_key`` and ``__mix_tokens``."""
    return rows.groupBy(F.col(_OWN + "key").alias("key")).agg(
        F.sum(_OWN + "tokens").alias("tokens"), F.count("*").alias("docs")
    )


def exponent(
    sources: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    cover: bool = False,
    steps: int = 8,
) -> float:
    """Exponent in [0, 1] by bisection; what leaves the executors is one row of sums a step.

    ``target_entropy`` in nats: the exponent with that entropy (or the nearest reachable).
    ``max_repeats``: the smallest exponent under which no source is passed more often than that,
    for a budget of all tokens, or with ``cover`` of as many as pass every source once.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give a target entropy or a limit of repetitions")
    some = sources.where("tokens > 0")
    top = some.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most"), F.min("tokens").alias("least")).first()
    if not top["all"]:
        return 1.0
    share = F.col("tokens") / float(top["all"])
    p_most, p_least = top["most"] / top["all"], top["least"] / top["all"]
    low, high = 0.0, 1.0
    for _ in range(steps):
        points = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
        sums = some.agg(
            *[F.sum(F.pow(share, F.lit(a))).alias(f"z{i}") for i, a in enumerate(points)],
            *[F.sum(F.pow(share, F.lit(a)) * F.log(share)).alias(f"l{i}") for i, a in enumerate(points)],
        ).first()

        def too_flat(i: int) -> bool:
            a, z = points[i], sums[f"z{i}"]  # noqa: B023 - used within the step
            if target_entropy is not None:
                return math.log(z) - a * sums[f"l{i}"] / z > target_entropy  # noqa: B023
            # The smallest source is repeated most.
            repeats = (p_most / p_least) ** (1 - a) if cover else p_least ** (a - 1) / z
            return repeats > max_repeats + 1e-12

        flat = [i for i in range(PARTS + 1) if too_flat(i)]
        if not flat:
            high = points[0]
            break
        if flat[-1] == PARTS:
            return 1.0
        low, high = points[flat[-1]], points[flat[-1] + 1]
    return round(high, 6)


def budgets(
    sources: DataFrame, power: float, budget: int | None = None, cover: bool = False, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """(key, tokens, docs, weight, budget, n_blocks): normalised weights and token budgets.

    ``budget``: tokens of the mix; all tokens of the input by default, with ``cover`` as many as
    give every source one whole pass.
    """
    share = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(power))).otherwise(0.0)
    sums = sources.agg(F.sum(share).alias("z"), F.sum("tokens").alias("all"), F.max(F.try_divide(F.col("tokens"), share)).alias("cover")).first()
    if cover:
        size = sums["cover"] or 0.0
        wanted = F.greatest(F.col("tokens"), F.round(share * size).cast("long"))
    else:
        size = float(budget if budget is not None else (sums["all"] or 0)) / (sums["z"] or 1.0)
        wanted = F.round(share * size).cast("long")
    return sources.select(
        "key",
        "tokens",
        "docs",
        F.round(share / float(sums["z"] or 1.0), 9).alias("weight"),
        wanted.alias("budget"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("n_blocks"),
    )


def _plan(blocks: DataFrame, mix: DataFrame, cover: bool) -> DataFrame:
    """(key, block, passes): the passes that reach a block, and the tokens of its source before it.

    Prefix sums run over the blocks of a source in the pass's permutation, in two levels, so that
    a source that holds most blocks is spread over many tasks.
    """
    passes = F.greatest(F.lit(1), F.ceil(F.col("budget") / F.greatest(F.col("tokens"), F.lit(1)))).cast("int")
    each = (
        blocks.join(mix.select("key", "tokens", "budget", "weight"), "key")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), passes - 1)))
        .withColumn("place", _number(F.concat_ws("/", F.lit("block"), "key", "pass", "block")))
        .withColumn("part", F.shiftright("place", 40))
    )
    parts = each.groupBy("key", "pass", "part").agg(F.sum("size").alias("size"))
    over = Window.partitionBy("key", "pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("key", "pass", "part", F.coalesce(F.sum("size").over(over), F.lit(0)).alias("part_before"))
    inside = Window.partitionBy("key", "pass", "part").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    each = each.join(parts, ["key", "pass", "part"])
    before = F.col("pass") * F.col("tokens") + F.col("part_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    reached = (F.col("before") < F.col("budget")) | (F.lit(cover) & (F.col("pass") == 0))
    return (
        each.withColumn("before", before)
        .where(reached)
        .groupBy("key", "block")
        .agg(
            F.sort_array(F.collect_list(F.struct("pass", "before"))).alias("passes"),
            F.first("budget").alias("budget"),
            F.first("weight").alias("weight"),
        )
    )


def _scheduled(rows: DataFrame, order: Column, power_of, budget: int | None, cover: bool, block_tokens: int) -> DataFrame:
    """Rows once for each pass that takes them, with pass, weight and place in the mix."""
    sources = stored(totals(rows), "sources")
    mix = stored(budgets(sources, power_of(sources), budget, cover, block_tokens), "mix")
    sizes = mix.select(F.col("key").alias(_OWN + "source"), F.col("n_blocks").alias(_OWN + "n"))
    dealt = (
        rows.withColumn(_OWN + "order", order)
        .join(sizes, F.col(_OWN + "key") == F.col(_OWN + "source"))
        .withColumn(_OWN + "block", _number(F.concat(F.lit("block of "), F.col(_OWN + "order"))) % F.col(_OWN + "n"))
    )
    blocks = dealt.groupBy(F.col(_OWN + "key").alias("key"), F.col(_OWN + "block").alias("block")).agg(
        F.sum(_OWN + "tokens").alias("size")
    )
    plan = stored(_plan(stored(blocks, "blocks"), mix, cover), "plan")
    plan = plan.select(*[F.col(c).alias(_OWN + "p_" + c) for c in plan.columns])
    inside = (
        Window.partitionBy(_OWN + "key", _OWN + "block")
        .orderBy(F.md5(_OWN + "order"), _OWN + "order", _OWN + "tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = dealt.withColumn(_OWN + "inside", F.coalesce(F.sum(_OWN + "tokens").over(inside), F.lit(0)))
    joined = within.join(
        plan, (F.col(_OWN + "key") == F.col(_OWN + "p_key")) & (F.col(_OWN + "block") == F.col(_OWN + "p_block"))
    )
    taken = F.filter(
        _OWN + "p_passes",
        lambda p: (p["before"] + F.col(_OWN + "inside") < F.col(_OWN + "p_budget")) | (F.lit(cover) & (p["pass"] == 0)),
    )
    out = joined.withColumn(_OWN + "taken", F.explode(taken))
    at = (F.col(_OWN + "taken.before") + F.col(_OWN + "inside")) / F.greatest(F.col(_OWN + "p_budget"), F.lit(1))
    return out.withColumn(_OWN + "position", at)


def _limits(target_entropy, max_repeats, cover):
    if target_entropy is None and max_repeats is None:
        max_repeats = 2.0
    return lambda sources: exponent(sources, target_entropy, max_repeats, cover)


def schedule(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(doc_id, source, tokens, weight, pass, block, position): one row for each use of a document.

    Reading rows in order of ``position`` (from 0 to 1) gives the sources in their weights
    throughout. Tokens are words between ASCII white space, counted over whole texts.
    """
    slim = docs.select(
        column(doc_id).alias("doc_id"),
        column(source).alias("source"),
        _source_key(column(source)).alias(_OWN + "key"),
        words_of(column(text)).alias(_OWN + "tokens"),
    )
    slim = stored(slim, "tokens")
    order = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    out = _scheduled(slim, order, _limits(target_entropy, max_repeats, False), budget, False, block_tokens)
    return out.select(
        "doc_id",
        "source",
        F.col(_OWN + "tokens").alias("tokens"),
        F.col(_OWN + "p_weight").alias("weight"),
        F.col(_OWN + "taken.pass").alias("pass"),
        F.col(_OWN + "block").alias("block"),
        F.round(_OWN + "position", 9).alias("position"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    max_repeats: float = 2.0,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of the mix, with all columns of the input: every document at least once, those of
    small sources again within the limit of repetitions."""
    rows = docs.withColumns({_OWN + "key": _source_key(column(source)), _OWN + "tokens": words_of(column(text))})
    order = F.coalesce(column(doc_id).cast("string"), F.lit("null"))
    out = _scheduled(rows, order, _limits(None, max_repeats, True), None, True, block_tokens)
    return out.select(*[column(c) for c in docs.columns])

"""Mixing sources to target weights: budgets run down a tree, documents are taken by seeded epochs.

Levels of the tree are columns, from the root's children to the leaves (domain, language, source). Going down,
a node's budget is poured over its children by weight; a child takes no more than its subtree holds (tokens
times ``max_epochs``), and what it cannot take rises among its siblings first. Only what a whole family cannot
take has been left to the family's siblings, because a node's own limit is the sum of its children's. Pouring is
one window per level: with children sorted by limit over weight, the water level is the largest
(budget - limits before) / (weights from here on).

A leaf's budget buys whole epochs and then a prefix of one more, in an order seeded by epoch. Running totals of
a hot leaf are split: the order is cut into pieces by its leading digits, pieces are summed first, and only inside
a piece are rows numbered. The result of all that is one cut per leaf, so the documents themselves are joined to
a table of leaves and never shuffled by leaf.

Defined results: null level values form a node of their own; null and empty texts have no tokens and come with
every epoch their leaf takes (in the prefix if their place is), ``max_epochs`` at most; rows equal in id are in or out together; a leaf of
weight 0 takes nothing; an empty table gives no rows; extra columns are kept under any names but those of the two added
columns, which take their place; names of two leading underscores are the operator's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.components import stored

_NULL = "∅"


def tokens(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("bigint")


def _weighted(children: DataFrame, level: str, weights: dict[str, int]) -> DataFrame:
    """Add ``weight``; a value that is not listed weighs what the entry ``*`` says, or 1."""
    rest = F.lit(weights.get("*", 1))
    known = {k: v for k, v in weights.items() if k != "*"}
    if not known:
        return children.withColumn("weight", rest.cast("bigint"))
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return children.withColumn("weight", F.coalesce(F.try_element_at(table, F.col(level)), rest).cast("bigint"))


def budgets(leaves: DataFrame, levels: Sequence[str], weights: dict[str, dict[str, int]], total: Column, max_epochs: int) -> DataFrame:
    """Leaf rows (levels, ``held`` tokens) with ``budget``; ``total`` is an expression of the root's ``held``."""
    limit = leaves.withColumn("limit", F.col("held") * max_epochs)
    parents = limit.agg(F.sum("held").alias("held")).select(total.cast("bigint").alias("budget"))
    above: list[str] = []
    for level in levels:
        nodes = [*above, level]
        children = _weighted(limit.groupBy(*nodes).agg(F.sum("limit").alias("limit")), level, weights.get(level, {})).where("weight > 0")
        joined = children.join(parents, above) if above else children.crossJoin(F.broadcast(parents))  # one row: the root
        family = Window.partitionBy(*above)
        order = family.orderBy((F.col("limit") / F.col("weight")), level)
        before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
        parents = (
            joined.withColumn("reach", (F.col("budget") - before).cast("double") / onward.cast("double"))
            .withColumn("water", F.max("reach").over(family))
            .select(*nodes, F.least(F.col("limit"), F.floor(F.col("weight") * F.col("water")).cast("bigint")).alias("budget"))
        )
        above = nodes
    return leaves.join(parents, list(levels))


def mix(
    spark: SparkSession,
    documents: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    total: Column,
    max_epochs: int = 1,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece_rows: int = 20_000,
    small_tree: int = 20_000,
    epoch_col: str = "mix_epoch",
    tokens_col: str = "mix_tokens",
) -> DataFrame:
    """The chosen rows of ``documents``, once per epoch, with ``mix_epoch`` (from 1) and ``mix_tokens`` added.

    Columns of these names that the documents have already give way to the added ones; ``epoch_col`` and ``tokens_col``
    name them otherwise. All other columns are kept, whatever they are called.

    ``levels`` names the tree's levels and how they are read from a row, ``weights`` gives whole-number weights
    by level and value, ``total`` the budget as an expression of ``held``, the tokens of all documents. A tree of up
    to ``small_tree`` leaves is broadcast to the documents, a larger one is joined by its leaves.
    """
    names = [f"__l{i}" for i in range(len(levels))]
    keyed = documents.withColumns(
        {n: F.coalesce(c.cast("string"), F.lit(_NULL)) for n, c in zip(names, levels.values())} | {"__mix_tokens": tokens(F.col(text_col))}
    )
    by_name = {n: weights.get(k, {}) for n, k in zip(names, levels)}
    # the texts are read twice in all: here to count tokens, and when the chosen rows are taken
    slim = stored(spark, keyed.select(*names, F.col(id_col).cast("string").alias("id"), "__mix_tokens"), "mix-rows")
    leaves = slim.groupBy(*names).agg(F.sum("__mix_tokens").alias("held"), F.count(F.lit(1)).alias("rows"))
    plan = (
        budgets(leaves, names, by_name, total, max_epochs)
        .withColumn("__whole", F.when(F.col("held") > 0, F.floor(F.col("budget") / F.col("held"))).otherwise(F.lit(0)).cast("int"))
        .withColumn("left", F.col("budget") - F.col("__whole") * F.col("held"))
        .withColumn("pieces", F.ceil(F.col("rows") / piece_rows))
    )
    plan = stored(spark, plan, "mix-plan")
    spread = F.broadcast if plan.count() <= small_tree else (lambda table: table)

    def place(row_id: Column) -> Column:
        """Seeded place of a document in the epoch that its leaf takes in part."""
        return F.md5(F.concat_ws("|", F.lit(seed), F.col("__whole") + 1, F.coalesce(row_id.cast("string"), F.lit(_NULL))))

    def piece(at: Column) -> Column:
        return F.floor(F.conv(F.substring(at, 1, 8), 16, 10).cast("bigint") * F.col("pieces") / F.lit(1 << 32))

    rows = slim.join(spread(plan), names).select(*names, "left", "__mix_tokens", place(F.col("id")).alias("place"), "pieces")
    rows = rows.withColumn("piece", piece(F.col("place")))
    per_leaf = Window.partitionBy(*names).orderBy("piece")
    sums = rows.groupBy(*names, "piece").agg(F.sum("__mix_tokens").alias("own"))
    starts = sums.select(*names, "piece", (F.sum("own").over(per_leaf) - F.col("own")).alias("before"))
    inside = Window.partitionBy(*names, "piece").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        rows.join(starts, [*names, "piece"])
        .withColumn("reached", F.col("before") + F.sum("__mix_tokens").over(inside))
        .where(F.col("reached") <= F.col("left"))
        .groupBy(*names)
        .agg(F.max("place").alias("__cut"))
    )
    chosen = stored(spark, plan.join(cuts, names, "left").select(*names, "__whole", "__cut"), "mix-cuts")
    taken = keyed.join(spread(chosen), names)
    copies = F.col("__whole") + F.when(place(F.col(id_col)) <= F.col("__cut"), 1).otherwise(0)
    copies = F.least(copies, F.lit(max_epochs))  # a row without tokens fits into a budget of nothing
    own = [documents[c] for c in documents.columns if c.lower() not in (epoch_col.lower(), tokens_col.lower())]
    return (
        taken.withColumn("__copies", copies)
        .where("__copies > 0")
        .withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*own, F.col("__epoch").alias(epoch_col), F.col("__mix_tokens").alias(tokens_col))
    )

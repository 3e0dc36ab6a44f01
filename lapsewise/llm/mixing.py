"""Mixing sources to target weights by hierarchical budgeting.

Weights run down a tree of domain, language and source. A node that cannot supply its share leaves
the shortage to its siblings in proportion to their weights; what all siblings together cannot
supply goes back to the ancestor's siblings. Every leaf then takes a token prefix of its seeded
epochs: each epoch is the leaf's rows in a new hash order, and a row is taken if the tokens up to
and with it fit the leaf's budget. Null texts have no tokens and are taken wherever the prefix
reaches them, null level values form a group of their own, ties in hash order go by id. Repeated
rows count each time. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.storage import write_and_reload

LEVELS = ("domain", "lang", "source")
#: More leaves than this are refused: the tree is budgeted by the driver.
MOST_LEAVES = 200_000
#: Rows of one piece of a leaf's hash order.
PIECE_ROWS = 4096


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long")


def length_domain(text: Column) -> Column:
    """Domain of a table that names none: long texts are "works", the others "notes"."""
    return F.when(F.length(F.coalesce(text, F.lit(""))) >= 2000, "works").otherwise("notes")


def share_out(budget: float, children: list[tuple[str, float, float]]) -> dict[str, float]:
    """Split a budget by (name, weight, capacity); full children leave the rest to their siblings."""
    given = {name: 0.0 for name, _, _ in children}
    open_ = [c for c in children if c[1] > 0 and c[2] > 0]
    while open_ and budget > 1e-6:
        total = sum(w for _, w, _ in open_)
        full = [c for c in open_ if budget * c[1] / total >= c[2] - given[c[0]]]
        if not full:
            for name, w, _ in open_:
                given[name] += budget * w / total
            break
        for name, _, capacity in full:
            budget -= capacity - given[name]
            given[name] = capacity
        open_ = [c for c in open_ if c not in full]
    return given


def leaf_budgets(leaves: dict[tuple, float], weights: dict[tuple, float], budget: float) -> dict[tuple, float]:
    """Budget of every leaf from the capacities; ``weights`` holds tree paths, 1 where none is given."""
    capacity: dict[tuple, float] = {}
    below: dict[tuple, set] = {}
    for leaf, size in leaves.items():
        for depth in range(len(leaf) + 1):
            capacity[leaf[:depth]] = capacity.get(leaf[:depth], 0) + size
            if depth:
                below.setdefault(leaf[: depth - 1], set()).add(leaf[:depth])
    out, todo = {}, [((), min(budget, capacity.get((), 0)))]
    while todo:
        node, amount = todo.pop()
        if node not in below:
            out[node] = amount
            continue
        children = sorted(below[node])
        todo += share_out(amount, [(c, weights.get(c, 1.0), capacity[c]) for c in children]).items()
    return out


def select(
    docs: DataFrame, weights: dict[tuple, float], share: float, epochs: int = 1, seed: int = 17,
    key: str = "doc_id", levels: tuple[str, ...] = LEVELS, tokens: str = "n_tokens",
) -> DataFrame:
    """Rows of (key, levels, tokens) taken, with ``epoch`` (from 0) and ``leaf_budget``; the budget is ``share`` of all tokens."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_l{i}") for i, c in enumerate(levels)]
    leaf = [f"_l{i}" for i in range(len(levels))]
    base = docs.select(key, *levels, tokens, *names)
    sizes = base.groupBy(*leaf).agg(F.sum(tokens).alias("n"), F.count("*").alias("rows")).limit(MOST_LEAVES + 1).collect()
    if len(sizes) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves")
    capacity = {tuple(r[: len(leaf)]): float((r.n or 0) * epochs) for r in sizes}
    budgets = leaf_budgets(capacity, weights, share * sum(capacity.values()) / epochs)
    schema = ", ".join(f"{c} string" for c in leaf) + ", leaf_budget long, _pieces long"
    plan = docs.sparkSession.createDataFrame(
        [
            (*r[: len(leaf)], int(budgets[tuple(r[: len(leaf)])] + 1e-3), max(1, -(-r.rows // PIECE_ROWS)))
            for r in sizes
        ],
        schema,
    )
    each = base.join(F.broadcast(plan), leaf).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    # The hash order of a leaf is cut into pieces of bounded size; sums of pieces give each its start. A piece is
    # a range of the leading bits of the number that rows are ordered by, so the order does not depend on the pieces.
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "epoch", key, tokens), 1)
    piece = F.floor(F.shiftright("_order", 23) / float(1 << 40) * F.col("_pieces"))
    each = each.withColumn("_order", order).withColumn("_piece", piece)
    sums = each.groupBy(*leaf, "epoch", "_piece").agg(F.sum(tokens).alias("_n"))
    running = " , ".join(leaf)
    sums = sums.selectExpr(
        "*", f"sum(_n) over (partition by {running} order by epoch, _piece) - _n as _before"
    ).drop("_n")
    walked = each.join(write_and_reload(sums, "mixing-pieces"), [*leaf, "epoch", "_piece"])
    walked = walked.selectExpr(
        "*",
        f"_before + sum({tokens}) over (partition by {running}, epoch, _piece order by _order, {key}, {tokens} "
        "rows between unbounded preceding and current row) as _reached",
    )
    return walked.where("_reached <= leaf_budget").select(key, *levels, tokens, "epoch", "leaf_budget")

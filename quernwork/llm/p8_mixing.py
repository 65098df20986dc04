"""Problem 8: choose and repeat documents so that each source has its target share of all tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from .common import cut, table
from .p4_tokens import document_tokens

SEED = 20
#: Bits of an epoch's order that make its parts: 4,096 and up to 2^20, so that a part of the largest leaf has about
#: ``PART_ROWS`` rows. Only the part that holds the end of the prefix is sorted.
LEAST_BITS, MOST_BITS, PART_ROWS = 12, 20, 1 << 18
#: Leaves and sources that plans are made for on the driver and sent to all executors, one short row each; a tree of
#: more is refused, as names of languages and domains do not grow with the rows.
MOST_LEAVES = 1 << 17


def fill(budget: float, weights: list[float], caps: list[float]) -> list[float]:
    """Divide ``budget`` by ``weights``; what a child cannot take (``caps``) goes to its siblings by their weights."""
    given, open_ = [0.0] * len(caps), [i for i, c in enumerate(caps) if c > 0 and weights[i] > 0]
    budget = min(budget, sum(caps[i] for i in open_))
    while open_ and budget > 1e-9:
        unit = budget / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit >= caps[i] - given[i]]
        if not full:
            for i in open_:
                given[i] += weights[i] * unit
            break
        for i in full:
            budget -= caps[i] - given[i]
            given[i] = caps[i]
        open_ = [i for i in open_ if i not in set(full)]
    return given


def plan_leaves(
    available: dict[tuple, int],
    targets: dict[str, tuple[float, int]],
    total: float | None = None,
    weights: dict[tuple, float] | None = None,
) -> dict[tuple, int]:
    """Token budget of each leaf (source, language, domain).

    ``weights`` gives the weight of nodes (source, language) and (source, language, domain) among their siblings;
    those it does not name weigh as many tokens as they have.

    The root's budget is ``total``, else the largest at which every source with tokens can have its target share
    under its cap on repeats. It goes down the tree by weights; at each node, what one child cannot take goes to its
    siblings, and only what no sibling can take changes the shares one level higher (a child's cap is the sum of the
    caps below it).
    """
    cap = {leaf: n * targets[leaf[0]][1] for leaf, n in available.items() if leaf[0] in targets and n > 0}

    def down(prefix: tuple, budget: float) -> dict[tuple, float]:
        if len(prefix) == 3:
            return {prefix: budget}
        below: dict[tuple, list] = {}
        for leaf in cap:
            if leaf[: len(prefix)] == prefix:
                below.setdefault(leaf[: len(prefix) + 1], []).append(leaf)
        # an equal order in every run, nulls first
        children = sorted(below, key=lambda c: [(x is not None, x or "") for x in c])
        weigh = [
            targets[c[0]][0] if not prefix else (weights or {}).get(c, float(sum(available[x] for x in below[c])))
            for c in children
        ]
        parts = fill(budget, weigh, [float(sum(cap[x] for x in below[c])) for c in children])
        return {leaf: b for c, part in zip(children, parts) for leaf, b in down(c, part).items()}

    by_source: dict[str, int] = {}
    for leaf, n in cap.items():
        by_source[leaf[0]] = by_source.get(leaf[0], 0) + n
    reach = [n / targets[s][0] for s, n in by_source.items() if targets[s][0] > 0]
    return {k: round(b) for k, b in down((), min(reach, default=0.0) if total is None else total).items()}


def _order(epoch: Column) -> Column:
    """A seeded place in the order of an epoch; ties are equal rows or settled by the document's id."""
    return F.xxhash64(F.lit(SEED), epoch, "doc_id", "n_tokens")


_LEAF = ["source", "language", "domain"]


def _collected(rows: DataFrame) -> list:
    """A row a leaf at most."""
    found = rows.limit(MOST_LEAVES + 1).collect()
    if len(found) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves")
    return found


def _choose(usable: DataFrame, budgets: dict[tuple, int], held: dict[tuple, int], bits: int) -> DataFrame:
    """Rows with their repeats: whole epochs, and of one more epoch the prefix that comes closest to the budget."""
    spark = usable.sparkSession
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in _LEAF]
    rows = [(*k, b // held[k], b % held[k]) for k, b in budgets.items()]
    kinds = "source string, language string, domain string, full bigint, rest bigint"
    plan = F.broadcast(spark.createDataFrame(rows, kinds))
    planned = usable.join(plan, same(usable, plan)).select(*[usable[c] for c in usable.columns], "full", "rest")
    ordered = planned.withColumn("_at", _order(F.col("full"))).withColumn(
        "_part", F.shiftright("_at", 64 - bits).cast("int") + (1 << bits - 1)
    )
    parts = ordered.groupBy(*_LEAF, "_part").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = F.sum("tokens").over(W.Window.partitionBy(*_LEAF).orderBy("_part"))
    ends = parts.withColumn("_upto", upto).filter(
        (F.col("_upto") > F.col("rest")) & (F.col("_upto") - F.col("tokens") <= F.col("rest"))
    )
    end_rows = ends.select(*_LEAF, F.col("_part").alias("_end"), (F.col("_upto") - F.col("tokens")).alias("_base"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in end_rows.schema])
    end = F.broadcast(spark.createDataFrame(_collected(end_rows), schema))
    placed = ordered.join(end, same(ordered, end), "left").select(
        *[ordered[c] for c in ordered.columns], "_end", "_base"
    )
    # only rows of the part that holds the end are sorted
    inside = F.col("_part") == F.col("_end")
    before = W.Window.partitionBy(*_LEAF).orderBy("_at", "doc_id").rowsBetween(W.Window.unboundedPreceding, 0)
    edge = placed.filter(inside).withColumn("_run", F.sum("n_tokens").over(before) + F.col("_base"))
    edge = edge.withColumn("_one", (F.col("_run") - F.col("n_tokens") / 2 <= F.col("rest")).cast("int")).drop("_run")
    # without an end the whole epoch lies before it
    clear = placed.filter(~F.coalesce(inside, F.lit(False))).withColumn(
        "_one", F.coalesce((F.col("_part") < F.col("_end")).cast("int"), F.lit(1))
    )
    repeats = (F.col("full") + F.col("_one")).cast("int")
    return (
        clear.unionByName(edge)
        .select("doc_id", *_LEAF, "n_tokens", repeats.alias("repeats"))
        .filter(F.col("repeats") > 0)
    )


def settle(
    budgets: dict[tuple, int], reached: dict[tuple, int], held: dict[tuple, int], caps: dict[str, int]
) -> dict[tuple, int]:
    """Budgets in which one leaf of each source makes up for what whole documents left or took too much in the others.

    It is the leaf with the most tokens that can: so a source misses its share by half a document at most, where one
    of its leaves can give or take that much.
    """
    out = dict(budgets)
    for source in {k[0] for k in budgets}:
        leaves = [k for k in budgets if k[0] == source]
        miss = {k: budgets[k] - reached.get(k, 0) for k in leaves}
        for leaf in sorted(leaves, key=lambda k: (-held[k], [(x is not None, x or "") for x in k])):
            to = budgets[leaf] + sum(miss[k] for k in leaves if k != leaf)
            if 0 <= to <= held[leaf] * caps[source]:
                out[leaf] = to
                break
    return out


def mix(
    sized: DataFrame, targets: DataFrame, total: float | None = None, weights: dict[tuple, float] | None = None
) -> DataFrame:
    """(doc_id, source, language, domain, n_tokens, repeats) of the rows that are used.

    ``sized`` is (doc_id, source, language, domain, n_tokens), best in a checkpoint, as it is read a few times. A leaf
    uses whole epochs of its rows and of one more epoch the prefix, in that epoch's seeded order, that comes closest to
    its budget; one leaf of each source then makes up for the others' remainders. Rows without tokens and of sources
    without a target are not used. The tables collected hold one row for each leaf or source, ``MOST_LEAVES`` at most.
    """
    goal = {
        r.source: (float(r.target_share), int(r.max_repeats))
        for r in _collected(targets.dropna().dropDuplicates(["source"]))
    }
    usable = sized.filter((F.col("n_tokens") > 0) & F.col("source").isin(list(goal)))
    leaves = _collected(usable.groupBy(*_LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")))
    held = {(r.source, r.language, r.domain): int(r.tokens) for r in leaves}
    parts = max((r.n for r in leaves), default=0) // PART_ROWS
    bits = min(MOST_BITS, max(LEAST_BITS, parts.bit_length()))
    budgets = plan_leaves(held, goal, total, weights)
    first = _choose(usable, budgets, held, bits).groupBy(*_LEAF).agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("t"))
    reached = {(r.source, r.language, r.domain): int(r.t) for r in _collected(first)}
    return _choose(usable, settle(budgets, reached, held, {s: c for s, (_, c) in goal.items()}), held, bits)


def reached_shares(mixed: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: target_share, max_repeats, available_tokens, n_docs, tokens, share, most_repeats."""
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    used = mixed.groupBy("source").agg(
        F.count("*").alias("n_docs"),
        F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"),
        F.max("repeats").alias("most_repeats"),
    )
    whole = F.sum("tokens").over(W.Window.partitionBy())  # one row a source
    return (
        targets.dropDuplicates(["source"])
        .join(have, "source", "left")
        .join(used, "source", "left")
        .na.fill(0, ["available_tokens", "n_docs", "tokens", "most_repeats"])
        .withColumn("share", F.try_divide(F.col("tokens"), whole))
        .select(
            "source", "target_share", "max_repeats", "available_tokens", "n_docs", "tokens", "share", "most_repeats"
        )
    )


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(document_tokens(table(spark, sf_dir, "documents"), table(spark, sf_dir, "manifest")))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_sized(spark, sf_dir), table(spark, sf_dir, "source_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, targets = _sized(spark, sf_dir), table(spark, sf_dir, "source_targets")
    return reached_shares(mix(sized, targets), sized, targets)


QUERIES = {"p8_mixture": p8_mixture, "p8_shares": p8_shares}
ORACLES: dict[str, str] = {}

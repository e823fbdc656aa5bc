"""Mixing sources to target weights with a hierarchical token budget, in Spark built-ins.

The tree is domain - language - source. A node's budget goes to its children by weight; a
child that cannot take its share (its tokens times ``max_epochs``) takes all it has, and the
shortage goes to its siblings. Capacities are those of whole subtrees, so a shortage leaves
a parent only when all below it is used up: siblings come first, then the ancestors' siblings.

Each leaf spends its quota in epochs. Every full epoch takes all its documents; the last one
takes the prefix, in that epoch's seeded order, whose tokens fit the rest. The order key is
an MD5, and its leading digits cut a leaf into slices: token sums of slices find the one in
which the prefix ends, and only documents of that slice are sorted. A source that holds a
third of all rows is therefore never in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payerlens.llm.tables import stored
from payerlens.llm.tokens import word_count

# Integer weights of tree nodes by name; a node that is not named weighs 1.
LANGUAGE_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 2}
BUDGET_PERCENT = 80
MAX_EPOCHS = 2
SEED = 29
SLICE_DIGITS = 3  # hex digits: 4096 slices a leaf

_LEVELS = ("domain", "language", "source_name")
_WIDE = "decimal(38,0)"


def domain_of(source: Column) -> Column:
    """The registered queries' domain: the source's name without its last character."""
    return F.substring(source, F.lit(1), F.greatest(F.length(source) - 1, F.lit(1)))


def _weight(name: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for key, value in weights.items():
        out = F.when(F.col(name) == key, F.lit(value)).otherwise(out)
    return out.cast(_WIDE)


def _share(nodes: DataFrame, parent: list[str], name: str, weights: Mapping[str, int]) -> DataFrame:
    """Budgets of the nodes ``name`` below ``parent``; ``budget`` is the parent's.

    Children in order of capacity per weight: the first ones, as long as their share of what
    is left exceeds their capacity, are filled; the rest share by weight, rounded down.
    """
    order = [F.col("capacity") / F.col("weight"), F.col(name)]
    before = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    zero = F.lit(0).cast(_WIDE)
    nodes = (
        nodes.withColumn("weight", _weight(name, weights))
        .withColumn("taken", F.coalesce(F.sum("capacity").over(before), zero).cast(_WIDE))
        .withColumn("used", F.coalesce(F.sum("weight").over(before), zero).cast(_WIDE))
        .withColumn("total", F.sum("weight").over(whole).cast(_WIDE))
        .withColumn("left", F.greatest(F.col("budget").cast(_WIDE) - F.col("taken"), zero).cast(_WIDE))
        .withColumn("open", (F.col("total") - F.col("used")).cast(_WIDE))
        .withColumn("full", F.col("left") * F.col("weight") >= F.col("capacity") * F.col("open"))
    )
    full = F.when(F.col("full"), F.lit(0)).otherwise(F.lit(1))
    first = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # Once one child is not filled, none after it is: all those share what was left then.
    nodes = nodes.withColumn("later", F.sum(full).over(first) > 0)
    rest = F.max(F.when(F.col("later"), F.col("left"))).over(whole)
    width = F.max(F.when(F.col("later"), F.col("open"))).over(whole)
    shared = F.expr("cast((rest * weight) div width as bigint)")
    return (
        nodes.withColumn("rest", rest.cast("decimal(28,0)"))
        .withColumn("width", width.cast("decimal(18,0)"))
        .withColumn("weight", F.col("weight").cast("decimal(9,0)"))
        .withColumn(
            "budget", F.when(F.col("later"), shared).otherwise(F.col("capacity").cast("bigint"))
        )
        .drop("weight", "taken", "used", "total", "left", "open", "full", "later", "rest", "width")
    )


def leaf_quotas(
    leaves: DataFrame,
    budget_percent: int,
    max_epochs: int,
    weights: Mapping[str, Mapping[str, int]],
) -> DataFrame:
    """``leaves(domain, language, source_name, tokens)`` with a token ``quota`` each."""
    leaves = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast(_WIDE))
    above, parent = None, []
    for depth, name in enumerate(_LEVELS):
        keys = list(_LEVELS[: depth + 1])
        nodes = leaves.groupBy(*keys).agg(
            F.sum("capacity").cast(_WIDE).alias("capacity"), F.sum("tokens").alias("tokens")
        )
        if above is None:
            nodes = nodes.withColumn("root", F.lit(0)).withColumn(
                "whole", F.sum("tokens").over(Window.partitionBy("root"))
            )
            nodes = nodes.withColumn("budget", F.expr(f"(whole * {budget_percent}) div 100"))
            above = _share(nodes, ["root"], name, weights.get(name, {}))
        else:
            parents = above.select(*parent, "budget")
            nodes = nodes.drop("tokens").join(parents, parent)
            above = _share(nodes, parent, name, weights.get(name, {}))
        parent = keys
    return leaves.select(*_LEVELS, "tokens").join(
        above.select(*_LEVELS, F.col("budget").alias("quota")), list(_LEVELS)
    )


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    source_column: str = "source",
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    weights: Mapping[str, Mapping[str, int]] | None = None,
    seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """The selected documents, one row for each epoch that takes them.

    Columns: doc_id, domain, language, source_name, tokens, epoch; or the input columns
    named in ``keep`` instead. The budget is ``budget_percent`` of all tokens. A missing
    language or source counts as the empty name; documents without tokens are selected
    with every epoch in whose prefix they lie and cost nothing. Leaves without tokens
    select nothing. Rows that repeat a doc_id are taken one by one, smaller texts first, then
    by a hash of the text. Rows without doc_id are ordered by that hash, so they spread over
    all slices, and a task that runs again takes the same rows.
    """
    weights = {"language": LANGUAGE_WEIGHTS} if weights is None else weights
    own = {name: F.col(f"`{name}`").alias(f"in_{i}") for i, name in enumerate(keep or [])}
    base = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.col(f"`{language_column}`"), F.lit("")).alias("language"),
        F.coalesce(F.col(f"`{source_column}`"), F.lit("")).alias("source_name"),
        word_count(F.col(f"`{text_column}`")).alias("tokens"),
        F.xxhash64(F.col(f"`{text_column}`")).alias("text_code"),
        *own.values(),
    ).withColumn("domain", domain_of(F.col("source_name")))
    base = stored(base, "mixing-input")  # texts are counted once
    thin = ["doc_id", *_LEVELS, "tokens"]
    leaves = stored(
        base.groupBy(*_LEVELS).agg(F.sum("tokens").alias("tokens")), "mixing-leaves"
    )
    quotas = leaf_quotas(leaves, budget_percent, max_epochs, weights).where("tokens > 0 AND quota > 0")
    quotas = stored(
        quotas.select(
            *_LEVELS,
            F.expr("cast(quota div tokens as int)").alias("full_epochs"),
            F.expr("quota % tokens").alias("part"),
        ),
        "mixing-quotas",
    )
    key = F.md5(
        F.concat_ws(
            "|",
            F.lit(str(seed)),
            F.col("full_epochs").cast("string"),
            F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.col("text_code"))),
        )
    )
    keyed = base.join(quotas, list(_LEVELS)).withColumn("order_key", key).withColumn(
        "slice", F.substring("order_key", 1, SLICE_DIGITS)
    )
    before = Window.partitionBy(*_LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        keyed.where("part > 0").groupBy(*_LEVELS, "slice", "part").agg(F.sum("tokens").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    # The slice in which the prefix ends; all slices before it are taken whole.
    last = stored(
        slices.where("before <= part AND before + n > part")
        .select(*_LEVELS, F.col("slice").alias("last_slice"), (F.col("part") - F.col("before")).alias("room")),
        "mixing-cuts",
    )
    cut = keyed.join(last, list(_LEVELS))
    whole = cut.where("slice < last_slice").withColumn("epoch", F.col("full_epochs"))
    so_far = (
        Window.partitionBy(*_LEVELS)
        .orderBy("order_key", "doc_id", "tokens", "text_code")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    partly = (
        cut.where("slice = last_slice")
        .withColumn("so_far", F.sum("tokens").over(so_far))
        .where("so_far <= room")
        .withColumn("epoch", F.col("full_epochs"))
    )
    full = keyed.where("full_epochs > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("full_epochs") - 1))
    )
    out = [*thin, "epoch"] if keep is None else [F.col(f"in_{i}").alias(n) for i, n in enumerate(keep)]
    parts = [frame.select(*out) for frame in (full, whole, partly)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

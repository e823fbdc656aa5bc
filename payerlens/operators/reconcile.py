"""Compare two independently computed results, row by row, as multisets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payerlens.operators.key_bits import key_bits, with_bit


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the copies on each side.

    One grouping over the tagged union answers both directions, where two
    ``exceptAll`` would read each side twice. NULLs group together, so NULL
    equals NULL.
    """
    return _copies(left, right).where(F.col("left_copies") != F.col("right_copies"))


def reconcile(left: DataFrame, right: DataFrame, table_name: str) -> DataFrame:
    """One row of match counts; the results agree if both ``_only`` counts are 0."""
    left_copies, right_copies = F.col("left_copies"), F.col("right_copies")
    matched = F.least(left_copies, right_copies)

    def total(expression):
        return F.coalesce(F.sum(expression), F.lit(0))

    return _copies(left, right).agg(
        F.lit(table_name).alias("table_name"),
        total(left_copies).alias("left_rows"),
        total(right_copies).alias("right_rows"),
        total(matched).alias("matched_rows"),
        total(left_copies - matched).alias("left_only_rows"),
        total(right_copies - matched).alias("right_only_rows"),
    )


def _copies(left: DataFrame, right: DataFrame) -> DataFrame:
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    tagged = left.withColumn("_left", F.lit(True)).unionByName(
        right.withColumn("_left", F.lit(False))
    )
    return tagged.groupBy(*left.columns).agg(
        F.count_if("_left").alias("left_copies"),
        F.count_if(~F.col("_left")).alias("right_copies"),
    )


LEAVES, FANOUT = 4096, 16  # of the tree of hashes: three levels


def _hash(columns: list[str], seed: int | Column = 0) -> Column:
    return F.xxhash64(seed if isinstance(seed, Column) else F.lit(seed), *[v for c in columns for v in (F.col(c), F.col(c).isNull())])


def range_digests(sides: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(side, leaf, rows, digest): what each side holds in each of 4,096 ranges of the keys' hash.

    A digest is the sum of the rows' hashes: it does not depend on their order, and copies
    count. A task sends as many rows as there are leaves, whatever it reads.
    """
    columns = sorted(next(iter(sides.values())).columns)
    tagged = [
        side.select(
            F.lit(name).alias("side"),
            F.pmod(_hash(keys), F.lit(LEAVES)).cast("int").alias("leaf"),
            _hash(columns, 1).cast("decimal(20,0)").alias("row_hash"),
        )
        for name, side in sides.items()
    ]
    return reduce(DataFrame.unionByName, tagged).groupBy("side", "leaf").agg(
        F.count("*").alias("rows"), F.sum("row_hash").alias("digest")
    )


def differing_leaves(digests: DataFrame, n_sides: int) -> DataFrame:
    """(leaf) of the ranges where the sides differ, found from the root of the tree downwards.

    A node is the sum of what is below it; below a node in which all sides agree nothing
    is looked at.
    """
    node = None
    for below in (LEAVES // FANOUT, FANOUT, 1):
        step = digests.withColumn("node", F.floor(F.col("leaf") / below).cast("int"))
        if node is not None:
            parent = F.floor(F.col("node") / FANOUT).cast("int")
            step = step.join(F.broadcast(node), parent == F.col("differing"), "left_semi")  # 4,096 rows at most
        sums = step.groupBy("node", "side").agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))
        node = (
            sums.groupBy("node").agg(
                F.count("*").alias("sides"),
                *[f(c).alias(f"{f.__name__}_{c}") for c in ("rows", "digest") for f in (F.min, F.max)],
            )
            .where((F.col("sides") < n_sides) | (F.col("min_rows") != F.col("max_rows")) | (F.col("min_digest") != F.col("max_digest")))
            .select(F.col("node").alias("differing"))
        )
    return node.withColumnRenamed("differing", "leaf")


def side_classes(digests: DataFrame, leaves: DataFrame, names: list[str]) -> DataFrame:
    """(leaf, classes) of the differing ranges: which sides hold the same there.

    ``classes[i]`` is the first of the sides that hold what side i holds, or nothing as side i
    does; ``classes[n + i]`` is the next such first side, the lowest one after the highest.
    """
    sides = range(len(names))
    held = [F.max(F.when(F.col("side") == name, F.struct("rows", "digest"))).alias(f"held_{i}") for i, name in enumerate(names)]
    ranges = digests.join(F.broadcast(leaves), "leaf", "left_semi").groupBy("leaf").agg(*held)
    same = lambda i, j: F.col(f"held_{i}").eqNullSafe(F.col(f"held_{j}"))
    firsts = ranges.select(
        "leaf", F.array(*[F.coalesce(*[F.when(same(i, j), j) for j in range(i)], F.lit(i)) for i in sides]).alias("firsts")
    ).withColumn("distinct", F.sort_array(F.array_distinct("firsts")))
    after = F.transform("firsts", lambda f: F.coalesce(
        F.get("distinct", F.array_position("distinct", f).cast("int")), F.get("distinct", F.lit(0))))
    return firsts.select("leaf", F.concat("firsts", after).alias("classes"))


def _differing_keys(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    """(_key) of the key hashes whose rows differ between the classes of sides of their range.

    Each class adds, for each of its rows, a hash of its own minus that of the next class. Over
    all classes these cancel out where they hold the same rows equally often. 16 bytes a row are shuffled.
    """
    n = len(parts)
    mark = lambda seed: F.shiftright(_hash(columns, seed + 2), 9)
    marks = [
        part.select("_key", (mark(F.lit(i)) - mark(F.col("classes")[n + i])).alias("mark"))
        for i, part in enumerate(parts)
    ]
    # A sum too large for 64 bits is NULL: its rows are compared.
    sums = reduce(DataFrame.unionByName, marks).groupBy("_key").agg(F.try_sum("mark").alias("mark"))
    return sums.where("mark IS NULL OR mark <> 0").select("_key")


def reconcile_sides(sides: dict[str, DataFrame], keys: list[str], digests: DataFrame | None = None) -> DataFrame:
    """(side, total_rows, compared_rows, agreeing_rows, differing_rows) of any number of sides.

    A row agrees if all sides hold it equally often. In a differing range one side stands for
    all that hold the same, and the hashes of single keys are the last level of the tree: only
    rows of keys that differ are compared, all sides in one grouping. If the sides agree, no row
    is moved. ``digests`` is the stored result of ``range_digests``, which is read more than once;
    what differs of it, a row a range, is in the plan.
    """
    names = list(sides)
    columns = sorted(sides[names[0]].columns)
    for name in names:
        if sorted(sides[name].columns) != columns:
            raise ValueError(f"columns differ: {columns} and {sorted(sides[name].columns)} of {name}")
    digests = range_digests(sides, keys) if digests is None else digests
    found = side_classes(digests, differing_leaves(digests, len(names)), names).collect()  # 4,096 rows at most
    classes = F.broadcast(digests.sparkSession.createDataFrame(found, "leaf int, classes array<int>"))
    parts = [
        side.select(*columns, _hash(keys).alias("_key"))
        .withColumn("leaf", F.pmod("_key", F.lit(LEAVES)).cast("int"))
        .join(classes, "leaf").where(F.col("classes")[i] == i)
        for i, side in enumerate(sides.values())
    ]
    bits = key_bits(_differing_keys(parts, columns), "_key")
    tagged = [
        with_bit(part, "_key", bits, "_differs").where("_differs")
        .select("leaf", *columns, *[F.lit(int(j == i)).alias(f"_own_{j}") for j in range(len(names))])
        for i, part in enumerate(parts)
    ]
    copies = [f"_copies_{i}" for i in range(len(names))]
    own = reduce(DataFrame.unionByName, tagged).groupBy("leaf", *columns).agg(
        F.array(*[F.sum(f"_own_{i}") for i in range(len(names))]).alias("_own")
    )
    compared = own.join(classes, "leaf").select(
        *[F.get("_own", F.col("classes")[i]).alias(c) for i, c in enumerate(copies)]
    )
    agrees = F.lit(True)
    for c in copies[1:]:
        agrees = agrees & (F.col(c) == F.col(copies[0]))
    counted = compared.withColumn("_agrees", agrees).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{i}") for i, c in enumerate(copies)],
        *[F.coalesce(F.sum(F.when(~F.col("_agrees"), F.col(c))), F.lit(0)).alias(f"d_{i}") for i, c in enumerate(copies)],
    )
    found = counted.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(name).alias("side"),
                F.col(f"n_{i}").cast("long").alias("compared_rows"),
                F.col(f"d_{i}").cast("long").alias("differing_rows"),
            )
            for i, name in enumerate(names)
        ]))
    )
    totals = digests.groupBy("side").agg(F.sum("rows").alias("total_rows"))
    total = F.coalesce("total_rows", F.lit(0))
    return found.join(totals, "side", "left").select(
        "side", total.alias("total_rows"), "compared_rows",
        (total - F.col("differing_rows")).alias("agreeing_rows"), "differing_rows",
    )

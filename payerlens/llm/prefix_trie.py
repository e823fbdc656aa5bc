"""Prefix trie of conversations, screened by a count-min sketch of prefix digests.

Every conversation is rebuilt (some of its turns come from the first conversation of its
family) and each of its prefixes gets a digest. A count-min sketch counts the digests; only
the counters that reached two matter, so the sketch is two bit maps of a bounded size. An
estimate of one proves that no other conversation has this prefix, nor any longer one: that
tail of the trie is emitted row by row. What may be shared is grouped by its digest, which
is exact whatever the sketch says. A small sketch screens less and changes no result.

No task holds a conversation or the members of a node: turns are sorted by range, places
and digests are running sums over the pieces of a conversation, the members of a node are
counted on the map side, and the ends of a node are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payerlens.llm.tables import pick, stored

FAMILY = 5  # conversations c - c % 5 lend their first turns
MOST_HEAD = 8  # crc32(c) % 9 of them
COUNTERS_PER_PREFIX = 8
MOST_COUNTERS = 1 << 27  # in each of two rows: the sketch has at most 32 MB of bits
CHUNK_IDS = 4096  # ids of a node's end that are joined to one string
_CHUNK_BITS = 32768  # of a bit map of Spark's bitmap functions
_SEEDS = (101, 202)
_WRAP, _HALF = "18446744073709551616", "9223372036854775808"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _running(df: DataFrame, values: dict[str, Column], order: list[str], reverse: bool = False) -> DataFrame:
    """Adds inclusive running sums within a conversation, by ``part`` and ``order`` (or backwards).

    A conversation of many parts is summed part by part; what the parts before it
    hold is added. So it is no single task's work.
    """
    names = list(values)
    df = df.withColumns({f"_{n}": v for n, v in values.items()})
    turn = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    parts = df.groupBy("conv", "part").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in names])
    before = Window.partitionBy("conv").orderBy(turn("part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        "conv", "part", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in names]
    )
    own = Window.partitionBy("conv", "part").orderBy(*[turn(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    kept = [c for c in df.columns if c not in names and c not in [f"_{n}" for n in names]]
    return df.join(carried, ["conv", "part"]).select(
        *kept, *[(F.sum(f"_{n}").over(own) + F.col(f"_{n}_before")).alias(n) for n in names]
    )


def _turns(conversations: DataFrame, *columns: str) -> DataFrame:
    """(conv, part, rank, turn_digest, size): turns in order, without their texts, stored."""
    named = pick(conversations, **dict(zip(("conv", "turn", "role", "text"), columns, strict=True)))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = named.where("conv IS NOT NULL").select(
        F.col("conv").cast("long").alias("conv"),
        "turn",
        F.unhex(F.sha2(content, 256)).alias("turn_digest"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("copy"),  # tells repeated rows apart, which are equal
    )
    order = ["conv", "turn", "turn_digest", "copy"]
    placed = stored(
        slim.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()),
        "sorted-turns",
    )
    return _running(placed, {"rank": F.lit(1)}, order[1:]).drop("turn", "copy")


def _hashed(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("turn_digest"), F.col("depth")).cast("decimal(38,0)")


def rebuilt_prefixes(conversations: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """All prefixes (conv, part, depth, size, p1, p2, q1, q2, last) and all (conv, depth of its end).

    p is the digest of the prefix that ends at ``depth``, q of the one before. A digest is
    the sum of the hashes of its turns' SHA-256 and places, in two 64-bit numbers.
    """
    turns = stored(_turns(conversations, *columns), "turns")
    own = turns.groupBy("conv").agg(F.count("*").alias("own"))
    base = F.col("conv") - F.col("conv") % FAMILY
    wanted = F.crc32(F.col("conv").cast("string")) % (MOST_HEAD + 1)
    lent = turns.where((F.col("conv") % FAMILY == 0) & (F.col("rank") <= MOST_HEAD)).withColumnRenamed("conv", "base")
    lengths = lent.groupBy("base").agg(F.count("*").alias("there"))
    built = stored(
        own.withColumns({"base": base, "wanted": wanted}).join(lengths, "base", "left").select(
            "conv", "base", "wanted",
            F.least("wanted", F.coalesce("there", F.lit(0))).alias("head"),
            F.greatest(F.col("own") - F.col("wanted"), F.lit(0)).alias("after"),
        ).withColumn("end", F.col("head") + F.col("after")),
        "conversation-lengths",
    )
    first = lent.drop("part").join(built, "base").where("rank <= wanted").select(
        "conv", F.lit(-1).alias("part"), F.col("rank").alias("depth"), "size", "turn_digest", "end"
    )
    then = turns.join(built, "conv").where("rank > wanted").select(
        "conv", "part", (F.col("head") + F.col("rank") - F.col("wanted")).alias("depth"), "size", "turn_digest", "end"
    )
    sums = {f"p{i}": _hashed(seed) for i, seed in enumerate(_SEEDS, 1)}
    running = _running(first.unionByName(then), sums, ["depth"])
    wrapped = lambda c: F.pmod(c, F.lit(_WRAP).cast("decimal(38,0)"))
    as_long = lambda c: (wrapped(c) - F.lit(_HALF).cast("decimal(38,0)")).cast("long")
    prefixes = running.select(
        "conv", "part", "depth", "size", "turn_digest",
        *[as_long(F.col(f"p{i}")).alias(f"p{i}") for i in (1, 2)],
        *[as_long(F.col(f"p{i}") - _hashed(seed)).alias(f"q{i}") for i, seed in enumerate(_SEEDS, 1)],
        (F.col("depth") == F.col("end")).alias("last"),
    )
    return stored(prefixes, "prefixes"), built.select("conv", "end")


ROOT = -(2**63)  # both digests of the empty prefix


def sketch(prefixes: DataFrame, counters: int) -> list[dict[int, np.ndarray]]:
    """The counters above one of each of the sketch's rows: (chunk -> bytes of bits).

    Counters are counted on the map side; the driver gets bits, ``counters`` / 8 bytes a row
    of the sketch at most.
    """
    rows = []
    for digest in ("p1", "p2"):
        place = F.pmod(F.col(digest), F.lit(counters)).alias("place")
        several = prefixes.select(place).groupBy("place").count().where("count > 1")
        bits = several.groupBy(F.bitmap_bucket_number("place").alias("chunk")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
        )
        rows.append({r["chunk"]: np.frombuffer(bytes(r["bits"]), np.uint8) for r in bits.collect()})
    return rows


def _reached_two(chunks: dict[int, np.ndarray], digests: np.ndarray, counters: int) -> np.ndarray:
    place = np.mod(digests, counters)
    # Chunks are numbered from 1; chunk 1 holds the places 1 to 32,768, chunk 0 the place 0.
    chunk = np.where(place == 0, 0, (place - 1) // _CHUNK_BITS + 1)
    bit = np.where(place == 0, 0, (place - 1) % _CHUNK_BITS)
    out = np.zeros(len(place), bool)
    for c in np.unique(chunk):
        bits = chunks.get(int(c))
        if bits is not None:
            at = np.flatnonzero(chunk == c)
            out[at] = bits[bit[at] >> 3] >> (bit[at] & 7) & 1
    return out


def _screened(sketches: list[dict[int, np.ndarray]], counters: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            several = np.ones(batch.num_rows, bool)
            for chunks, name in zip(sketches, ("p1", "p2"), strict=True):
                several &= _reached_two(chunks, batch.column(name).to_numpy(), counters)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(several)], [*batch.schema.names, "several"]
            )

    return rows


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node, in order, as comma-joined strings of bounded length."""
    for batch in batches:
        p1, p2, conv = (batch.column(c).to_numpy() for c in ("p1", "p2", "conv"))
        new = np.ones(len(conv), bool)
        new[1:] = (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
        edges = []
        starts = np.flatnonzero(new).tolist()
        for start, end in zip(starts, [*starts[1:], len(conv)], strict=True):
            edges += [(at, min(at + CHUNK_IDS, end)) for at in range(start, end, CHUNK_IDS)]
        first = [a for a, _ in edges]
        texts = [",".join(map(str, conv[a:b].tolist())) for a, b in edges]
        yield pa.RecordBatch.from_arrays(
            [pa.array(p1[first]), pa.array(p2[first]), pa.array(conv[first]), pa.array(texts, pa.string())],
            ["p1", "p2", "first", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined strings of each node; a node's strings are neighbours, in order."""
    node, state = None, None

    def emit(done: list) -> pa.RecordBatch:
        columns = [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["p1", "p2", "ends_sha256"])

    for batch in batches:
        done = []
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in ("p1", "p2", "ids")], strict=True):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.encode())
        yield emit(done)
    if node is not None:
        yield emit([(*node, state.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256) of the nodes where the conversations ``ends(p1, p2, conv)`` end."""
    order = ["p1", "p2", "conv"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "p1 bigint, p2 bigint, first bigint, ids string"
    )
    in_order = joined.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first")
    return in_order.mapInArrow(_digests, "p1 bigint, p2 bigint, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    most_counters: int = MOST_COUNTERS,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Turns are ordered by ``turn`` (null first); rows of the same turn
    by the SHA-256 of length of role, colon, role and text. Repeated rows are turns of their
    own. Null role and text are empty. Rows without conversation id take no part.
    Without any conversation there is no node, the root included.
    """
    prefixes, ends = rebuilt_prefixes(conversations, id_column, turn_column, role_column, text_column)
    wanted = COUNTERS_PER_PREFIX * max(prefixes.count(), 1)
    counters = 1 << min(max(wanted.bit_length(), 16), most_counters.bit_length() - 1)
    schema = ", ".join(f"{n} {t}" for n, t in prefixes.dtypes) + ", several boolean"
    screened = stored(prefixes.mapInArrow(_screened(sketch(prefixes, counters), counters), schema), "screened")

    # Where a conversation's prefixes become its own; from there on its nodes are emitted alone.
    alone = screened.where("NOT several").groupBy("conv").agg(F.min("depth").alias("tail"))
    marked = stored(screened.join(alone, "conv", "left").drop("several"), "marked-prefixes")
    tails = marked.where("depth >= tail")
    top = tails.where("depth = tail").select("conv", "q1", "q2")
    node = ["p1", "p2"]
    starts = ends.join(alone, "conv", "left").select(
        "conv", F.lit(-2).alias("part"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"),
        F.lit(b"").alias("turn_digest"), *[F.lit(ROOT).alias(c) for c in ("p1", "p2", "q1", "q2")],
        (F.col("end") == 0).alias("last"), "tail",
    )
    shared = starts.unionByName(
        marked.where("tail IS NULL OR depth < tail").withColumn("depth", F.col("depth").cast("long")), allowMissingColumns=True
    )
    grouped = shared.groupBy(*node).agg(
        F.min("conv").alias("conv"),
        F.count("*").alias("n_convs"),
        F.count_if(~F.col("last")).alias("going_on"),
        F.max("size").alias("size"),
        *[f(c).alias(n) for c in ("q1", "q2", "depth") for f, n in ((F.min, f"least_{c}"), (F.max, f"most_{c}"))],
        # The turn itself as two hashes: numbers are summed up without sorting.
        *[
            f(F.xxhash64(F.lit(s), "turn_digest")).alias(f"{n}_turn_{s}")
            for s in _SEEDS for f, n in ((F.min, "least"), (F.max, "most"))
        ],
    )
    same = [("least_q1", "most_q1"), ("least_q2", "most_q2"), ("least_depth", "most_depth")]
    same += [(f"least_turn_{s}", f"most_turn_{s}") for s in _SEEDS]
    differs = [F.col(a) != F.col(b) for a, b in same]
    collided = differs[0]
    for d in differs[1:]:
        collided = collided | d
    nodes = stored(
        grouped.select(
            *node, "conv",
            F.when(collided, F.raise_error(F.lit("two prefixes share a digest: choose other seeds")))
            .otherwise(F.col("least_depth")).alias("depth"),
            F.col("least_q1").alias("q1"), F.col("least_q2").alias("q2"), "n_convs", "going_on",
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        ),
        "nodes",
    )
    # A node counts for its smallest member, at its depth; what lies below a node is the sum
    # of its members' parts from that depth on.
    own = nodes.select("conv", "depth", "saved", (F.col("going_on") == 0).cast("long").alias("leaf"))
    valued = shared.select("conv", "part", "depth", *node, "tail").join(own, ["conv", "depth"], "left")
    below = _running(
        valued, {n: F.coalesce(n, F.lit(0)) for n in ("saved", "leaf")}, ["depth"], reverse=True
    )
    nothing = F.lit(0).cast("long")
    parts = (
        below.select(*node, "saved", (F.col("leaf") + F.col("tail").isNotNull().cast("long")).alias("leaf"), nothing.alias("child"))
        .unionByName(
            nodes.where("depth > 0").select(F.col("q1").alias("p1"), F.col("q2").alias("p2"))
            .unionByName(top.select(F.col("q1").alias("p1"), F.col("q2").alias("p2")))
            .select(*node, nothing.alias("saved"), nothing.alias("leaf"), F.lit(1).cast("long").alias("child"))
        )
        .groupBy(*node).agg(
            F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
        )
    )
    digests = ends_digests(shared.where("last"))
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent_conv_id"))
    above = parents.where(F.col("q1").isNotNull())
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    grown = (
        nodes.where("depth > 0").join(above, ["q1", "q2"], "left")
        .unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
        .join(parts, node).join(digests, node, "left")
        .withColumns({"conv_id": F.col("conv"), "ends_sha256": F.coalesce("ends_sha256", F.lit(_NO_ENDS))})
    )
    # The first node of a tail hangs on a node that was grouped, the others on the tail itself.
    hung = top.join(above, ["q1", "q2"]).select("conv", "parent_conv_id")
    first = tails.where("depth = tail").join(hung, "conv")
    rest = tails.where("depth > tail").withColumn("parent_conv_id", F.col("conv"))
    single = first.unionByName(rest, allowMissingColumns=True).select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        F.lit(1).cast("long").alias("n_convs"),
        (~F.col("last")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        nothing.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
    return grown.select(*out).unionByName(single)

"""A Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf. The leaves of a source, in the order of their ids, are cut
into aligned blocks of ``fanout ** block_levels``; a block is a partition of the
exchange and hashes its own subtree. Then the partitions go through rounds: in
round r, those whose numbers differ in the r-th digit to the base ``fanout`` swap
the roots of the subtrees they stand for, and each hashes the ancestor for
itself. What a partition receives is just what its proofs need on that level,
so after as many rounds as the source's tree has levels above a block, every
partition has its subroot and the way there; no pass goes down again. Rounds
over the numbers of the sources follow likewise, up to the root of all.

Where the last group is not full, the partition asked for may not exist; then
the last one of that subtree answers in its stead, since all of a subtree's
partitions hold the same root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabsmith.llm.common import ship, written
from tabsmith.session import materialize

_PROOF = "array<struct<at:int,siblings:array<string>>>"


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """SHA-256, in hex, of the values one after another: ``-`` for null, else
    the number of UTF-8 bytes, a colon and the value as text."""
    text = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t), F.lit(":"), t)) for t in text]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""

    def up(digest: Column, level: Column) -> Column:
        at, others = level["at"], level["siblings"]
        before, after = F.slice(others, F.lit(1), at), F.slice(others, at + 1, F.size(others))
        return F.sha2(F.concat(F.array_join(before, ""), digest, F.array_join(after, "")), 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """SHA-256, in hex, of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda level: level["siblings"])), ""), 256)


def _levels(leaves: list[str], fanout: int, least: int) -> list[list[str]]:
    """The leaves and the levels above them, ``least`` at least, to the one with a single node."""
    levels = [leaves]
    while len(levels[-1]) > 1 or len(levels) <= least:
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[i : i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return levels


def _proof(levels: list[list[str]], at: int, fanout: int) -> list[dict]:
    steps = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        steps.append({"at": at - first, "siblings": nodes[first:at] + nodes[at + 1 : first + fanout]})
        at //= fanout
    return steps


def _numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, id, leaf, ...) with ``sid``, the number of the source
    in byte order, null first; ``place``, the number of the leaf within it; and
    ``size``, the source's leaves. Rows are range-sorted once; what is counted
    over all of them has a row per partition and source."""
    order = [F.col(c).asc_nulls_first() for c in ("source", "id", "leaf", "tie")]
    tied = leaves.withColumn("tie", F.monotonically_increasing_id())  # a range may end among rows that are alike
    laid = written(tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie").withColumn("row", F.monotonically_increasing_id()), "leaves")
    laid = laid.withColumn("part", F.shiftright("row", 33))
    pieces = materialize(laid.groupBy("part", "source").agg(F.min("row").alias("first"), F.count("*").alias("n")))
    sources = pieces.groupBy("source").agg(F.min("part").alias("home"), F.sum("n").alias("size"))
    homes = sources.groupBy("home").agg(F.count("*").alias("begun"))  # no more rows than partitions
    homes = homes.select("home", F.coalesce(F.sum("begun").over(Window.orderBy("home").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("home").orderBy(F.col("source").asc_nulls_first())) - 1
    sources = materialize(sources.withColumn("nth", within).join(homes, "home").select("source", "size", (F.col("base") + F.col("nth")).alias("sid")))
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("part", "source", "first", F.coalesce(earlier, F.lit(0)).alias("before"))
    pieces = pieces.alias("p").join(sources.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
    pieces = pieces.select("part", F.col("p.source").alias("of"), "first", "before", "size", "sid")
    found = laid.join(pieces.withColumnRenamed("part", "of_part"), (F.col("part") == F.col("of_part")) & F.col("source").eqNullSafe(F.col("of")))
    return found.withColumn("place", F.col("before") + F.col("row") - F.col("first")).drop("part", "of_part", "of", "first", "before", "row", "source")


def _swap(state: DataFrame, more: Column, mine: Column, partners: Column) -> DataFrame:
    """One round: where ``more`` holds, a partition takes the digests of its
    ``partners`` (array of (u, sid, block)), whose node numbers on this level are
    ``u`` and its own is ``mine``, and hashes the ancestor of all."""
    keys = ["sid", "block"]
    asked = state.filter(more).select("sid", "block", F.explode(partners).alias("p")).select("sid", "block", "p.u", F.col("p.sid").alias("of"), F.col("p.block").alias("of_block"))
    held = state.select(F.col("sid").alias("of"), F.col("block").alias("of_block"), F.col("digest"))
    told = asked.join(held, ["of", "of_block"]).select(*keys, "u", "digest", F.lit(None).alias("own"))
    own = state.select(*keys, F.when(more, mine).alias("u"), "digest", F.struct(*[c for c in state.columns if c not in keys]).alias("own"))
    met = told.unionByName(own).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("u", "digest"))).alias("run"), F.first("own", ignorenulls=True).alias("own"), F.max(F.when(F.col("own").isNotNull(), F.col("u"))).alias("mine"))
    taking = F.col("mine").isNotNull()
    joined = F.sha2(F.array_join(F.transform("run", lambda x: x["digest"]), ""), 256)
    step = F.struct(
        F.size(F.filter("run", lambda x: x["u"] < F.col("mine"))).alias("at"),
        F.transform(F.filter("run", lambda x: x["u"] != F.col("mine")), lambda x: x["digest"]).alias("siblings"),
    )
    changed = {"digest": F.when(taking, joined).otherwise(F.col("own.digest")), "proof": F.when(taking, F.concat("own.proof", F.array(step))).otherwise(F.col("own.proof"))}
    return met.select(*keys, *[changed.get(c, F.col(f"own.{c}")).alias(c) for c in state.columns if c not in keys])


def _siblings(number: Column, count: Column, r: int, fanout: int, to: Callable[[Column], Column]) -> tuple[Column, Column, Column]:
    """Of partition ``number`` among ``count`` in round ``r``: whether there is
    more than one node, its own node, and ``to`` of each sibling node."""
    width = fanout**r
    mine = F.floor(number / width)
    nodes = F.ceil(count / width)
    first = mine - mine % fanout
    others = F.filter(F.sequence(first, F.least(first + fanout - 1, nodes - 1)), lambda u: u != mine)
    return nodes > 1, mine, F.transform(others, to)


def _exchange(state: DataFrame, fanout: int) -> DataFrame:
    """Rounds over the blocks of every source, then over the sources."""
    top = state.agg(F.max("blocks"), F.max("sid")).first()
    most, n_sources = top[0] or 0, (top[1] if top[1] is not None else -1) + 1
    r = 0
    while fanout**r < most:
        width = fanout**r
        partner = lambda u: F.struct(u.alias("u"), F.col("sid").alias("sid"), F.least(u * width + F.col("block") % width, F.col("blocks") - 1).alias("block"))  # noqa: B023, E731
        state = materialize(_swap(state, *_siblings(F.col("block"), F.col("blocks"), r, fanout, partner)))
        r += 1
    state = materialize(state.withColumn("subroot", F.col("digest")))
    if n_sources < 2:
        return state
    # whom a source asks in each round, and how many blocks they have to share the answers
    sources = materialize(state.filter("block = 0").select("sid", "blocks"))
    rounds = [r for r in range(64) if fanout**r < n_sources]
    asks = [
        F.transform(_siblings(F.col("sid"), F.lit(n_sources), r, fanout, lambda u: u)[2], lambda u: F.struct(F.lit(r).alias("r"), u.alias("u"), F.least(u * fanout**r + F.col("sid") % fanout**r, F.lit(n_sources - 1)).alias("of")))  # noqa: B023
        for r in rounds
    ]
    asked = sources.select("sid", F.inline(F.concat(*asks))).join(sources.toDF("of", "of_blocks"), "of")
    plan = asked.groupBy("sid").agg(F.collect_list(F.struct("r", "u", "of", "of_blocks")).alias("plan"))
    state = materialize(state.join(plan, "sid"))
    for r in rounds:
        more, mine, _ = _siblings(F.col("sid"), F.lit(n_sources), r, fanout, lambda u: u)
        partners = F.transform(F.filter("plan", lambda p: p["r"] == r), lambda p: F.struct(p["u"].alias("u"), p["of"].alias("sid"), (F.col("block") % p["of_blocks"]).alias("block")))  # noqa: B023
        state = materialize(_swap(state, more, mine, partners))
    return state


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), by: str = "source", id_col: str = "doc_id",
    fanout: int = 3, block_levels: int = 7, carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, carried) of every row.

    ``leaf`` is :func:`leaf_digest` of ``columns``. The leaves of each value of
    ``by`` ascend by ``id_col``; while there are several nodes, every ``fanout``
    consecutive ones (the last run fewer, even one) become the digest of their
    digests. The subroots, by the bytes of ``by``, give ``root`` in the same way.
    ``proof`` holds, level by level, the place of the node in its run and the
    run's other digests: ``fold(leaf, proof)`` is the root. ``carried`` is a
    struct of the columns named by ``carry``.

    A null is a value of its own, told from an empty text; a null source or id
    comes first. Rows of one id follow each other by their digests, so rows that
    are alike may change places without a trace. An empty table gives no rows;
    other columns are ignored, whatever their names. A task holds one block of
    ``fanout ** block_levels`` leaves, whatever a source's size.
    """
    if fanout < 2 or block_levels < 1:
        raise ValueError("fanout must be 2 or more, block_levels 1 or more")
    ship(docs.sparkSession)
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    # written first: the range sort below samples its input, which must not mean to digest all texts twice
    leaves = written(docs.select(F.col(by).cast("string").alias("source"), F.col(id_col).alias("id"), leaf_digest(columns).alias("leaf"), carried.alias("carried")), "digests")
    size = fanout**block_levels
    numbered = _numbered(leaves).withColumns({"block": F.floor(F.col("place") / size), "blocks": F.ceil(F.col("size") / size)})
    numbered = written(numbered, "numbered")

    def levels_of(rows: pa.Table) -> list[list[str]]:
        return _levels(rows.column("leaf").to_pylist(), fanout, block_levels if rows.column("blocks")[0].as_py() > 1 else 0)

    def root(key: tuple, rows: pa.Table) -> pa.Table:
        top = levels_of(rows.sort_by("place"))[-1][0]
        return pa.table({"sid": [key[0].as_py()], "block": [key[1].as_py()], "blocks": rows.column("blocks").slice(0, 1).combine_chunks(), "digest": [top]})

    roots = numbered.select("sid", "block", "blocks", "place", "leaf").groupBy("sid", "block").applyInArrow(root, "sid long, block long, blocks long, digest string")
    state = _exchange(materialize(roots.withColumn("proof", F.array().cast(_PROOF))), fanout)

    steps = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.list_(pa.string()))]))

    def proofs(key: tuple, rows: pa.Table, upper: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        levels = levels_of(rows)
        above = upper.column("proof")[0].as_py()
        paths = [_proof(levels, at, fanout) + above for at in range(len(rows))]
        ends = {c: pa.array([upper.column(c)[0].as_py()] * len(rows), type=pa.string()) for c in ("subroot", "digest")}
        return pa.table({"doc_id": rows.column("id"), "leaf": rows.column("leaf"), "subroot": ends["subroot"], "root": ends["digest"], "proof": pa.array(paths, type=steps), "carried": rows.column("carried")})

    kinds = {"doc_id": numbered.schema["id"].dataType, **dict.fromkeys(("leaf", "subroot", "root"), T.StringType()), "proof": T.DataType.fromDDL(_PROOF), "carried": numbered.schema["carried"].dataType}
    rows = numbered.select("sid", "block", "blocks", "place", "id", "leaf", "carried").groupBy("sid", "block")
    upper = state.select("sid", "block", "subroot", "digest", "proof").groupBy("sid", "block")
    return rows.cogroup(upper).applyInArrow(proofs, T.StructType([T.StructField(name, kind) for name, kind in kinds.items()]))

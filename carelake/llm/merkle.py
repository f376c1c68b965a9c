"""Merkle manifest of a dataset by a rollup of nested structs, with a proof for every row.

Leaves are ranked in their group, and the rank is written in digits of ``BASE``. Blocks of ``BASE ** DIGITS``
ranks are rolled up inside one task: the last digit is grouped away, which nests its structs under their run,
then the digit before it, until a block is one struct with all hashes of its levels. Roots of blocks are nodes
of the next storey, which is rolled up in the same way until a group is one node; the roots of the groups are
rolled up likewise. On the way back each block's struct is transformed into the paths of its children, level by
level, and exploded. A block gets the path above it by a union and a grouping, so no join emits a proof and no
struct outgrows a block.

A node is the hash of the concatenated hexadecimal hashes of two consecutive nodes, or of the last one alone;
a level is made as long as several nodes remain.

Nulls: a null value is written ``-``; a null group comes first, a null key ranks first in its group. Rows with
the same key are ranked by their hash; repeated rows are leaves each. Empty and long texts are hashed whole.
An empty table gives an empty result. Only the columns named are read; others, whatever their name, are not
carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.position import with_position
from ..session import written

BITS = 4
BASE = 1 << BITS
DIGITS = 3
BLOCK = BASE**DIGITS
_STEPS = "array<struct<left:string,right:string>>"


def entry_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns: ``-`` for a null, else the bytes of its text, ``:`` and the text."""
    text = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]
    return F.sha2(F.concat(*parts), 256)


def node_hash(*hashes: Column) -> Column:
    return F.sha2(F.concat(*hashes), 256)


def _level_of(digit: int, step: int) -> int:
    """Level of the tree below which a digit's run has its ``step``-th level."""
    return digit * BITS + step


def _active(level: int) -> Column:
    """Whether several nodes of the group remain at this level."""
    return F.col("_n") > F.lit(1 << level)


def _pair_of(level: Column):
    """The node over two consecutive ones of a level, or over the last one alone."""
    return lambda i: node_hash(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit("")))


def _run_levels(df: DataFrame, digit: int) -> DataFrame:
    """Adds ``_hash`` and ``_levels`` of a run from the hashes of its children ``_kids``."""
    df = df.withColumn("_l0", F.col("_kids._hash"))
    for step in range(BITS):
        below = F.col(f"_l{step}")
        half = F.transform(F.sequence(F.lit(0), F.floor((F.size(below) - 1) / 2).cast("int")), _pair_of(below))
        df = df.withColumn(f"_l{step + 1}", F.when(_active(_level_of(digit, step)), half).otherwise(below))
    return df.withColumn("_hash", F.get(f"_l{BITS}", F.lit(0))).withColumn("_levels", F.array(*[f"_l{step}" for step in range(BITS)]))


def rolled(nodes: DataFrame) -> DataFrame:
    """Blocks (``_g``, ``_block``, ``_n``, ``_hash``, ``_levels``, ``_kids``) of nodes (``_g``, ``_rank``, ``_n``: nodes
    of the group, ``_hash``, ``_load``)."""
    rank = F.col("_rank")
    digits = [f"_d{i}" for i in range(DIGITS)]
    cut = nodes.select(
        "_g", F.expr(f"_rank div {BLOCK}").alias("_block"), "_n", "_hash", "_load",
        *[F.shiftright(rank, i * BITS).bitwiseAND(F.lit(BASE - 1)).cast("int").alias(d) for i, d in enumerate(digits)],
    )
    # One shuffle; every grouping below keeps these two columns, so none moves a row again.
    runs = cut.repartition("_g", "_block").withColumn("_node", F.struct(F.col("_d0").alias("digit"), "_hash", "_load"))
    for i in range(DIGITS):
        grouped = runs.groupBy("_g", "_block", "_n", *digits[i + 1 :]).agg(F.array_sort(F.collect_list("_node")).alias("_kids"))
        runs = _run_levels(grouped, i)
        if i + 1 < DIGITS:
            runs = runs.withColumn("_node", F.struct(F.col(digits[i + 1]).alias("digit"), "_hash", "_levels", "_kids"))
    return runs.select("_g", "_block", "_n", "_hash", "_levels", "_kids")


def _steps(levels: Column, place: Column, digit: int) -> Column:
    """The neighbours that the child at ``place`` of a run is hashed with, from its own level upwards."""
    out = []
    for step in range(BITS):
        at, level = F.shiftright(place, step), F.get(levels, F.lit(step))
        odd = at.bitwiseAND(F.lit(1)) == 1
        left = F.when(odd, F.get(level, at - 1)).otherwise(F.lit(""))
        right = F.when(odd, F.lit("")).otherwise(F.coalesce(F.get(level, at + 1), F.lit("")))
        out.append(F.when(_active(_level_of(digit, step)), F.struct(left.alias("left"), right.alias("right"))))
    return F.array_compact(F.array(*out))


def _children(digit: int):
    """The children of a run, each with its path."""

    def children(run: Column) -> Column:
        def child(kid: Column, place: Column) -> Column:
            path = F.concat(_steps(run["_levels"], place, digit), run["path"])
            inner = [kid["_levels"].alias("_levels"), kid["_kids"].alias("_kids")] if digit else [kid["_load"].alias("_load")]
            return F.struct(path.alias("path"), *inner)

        return F.transform(run["_kids"], child)

    return children


def unrolled(blocks: DataFrame) -> DataFrame:
    """The children of blocks that know their own ``_path``: (``_load``, ``_path``, ``_sub``, ``_root``)."""
    top = F.array(F.struct(F.col("_path").alias("path"), F.col("_levels").alias("_levels"), F.col("_kids").alias("_kids")))
    df = blocks.select("_n", "_sub", "_root", top.alias("_open"))
    for digit in reversed(range(DIGITS)):
        df = df.select("_n", "_sub", "_root", F.flatten(F.transform("_open", _children(digit))).alias("_open"))
    rows = df.select("_sub", "_root", F.explode("_open").alias("_leaf"))
    return rows.select(F.col("_leaf._load").alias("_load"), F.col("_leaf.path").alias("_path"), "_sub", "_root")


def _given_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the path, group root and root of their own node, from rows (``_g``, ``_block``, ...)."""
    own, told = ("_n", "_hash", "_levels", "_kids"), ("_path", "_sub", "_root")
    both = blocks.unionByName(above, allowMissingColumns=True)
    first = lambda c: F.first(c, ignorenulls=True).alias(c)
    # A block of the leaves meets exactly one row from above, so a group holds two rows.
    return both.groupBy("_g", "_block").agg(*[first(c) for c in (*own, *told)])


def _storeys(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Written blocks, storey by storey, until the largest group (``most`` nodes) is one block."""
    out = [written(rolled(nodes), "merkle")]
    while most > BLOCK:
        most = -(-most // BLOCK)
        upper = out[-1].select(
            "_g", F.col("_block").alias("_rank"), F.expr(f"(_n + {BLOCK - 1}) div {BLOCK}").alias("_n"), "_hash",
            F.struct("_g", "_block").alias("_load"),
        )
        out.append(written(rolled(upper), "merkle"))
    return out


def _descended(storeys: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest children with their paths, from the paths of the roots (``_g``, ``_block`` 0)."""
    rows = unrolled(_given_paths(storeys[-1], tops))
    for blocks in reversed(storeys[:-1]):
        rows = unrolled(_given_paths(blocks, rows.select("_load._g", "_load._block", "_path", "_sub", "_root")))
    return rows


def proofs(leaves: DataFrame, leaf: str, key: str, group: str, carry: Sequence[str] = ()) -> DataFrame:
    """``key``, ``leaf``, the columns ``carry``, ``subroot`` (of the row's group), ``root``, and ``path``: the hashes
    left and right of the row's node at each level up to the root.

    ``leaves`` has one row per leaf with its hash in the column ``leaf``; leaves ascend by ``key``, groups by
    the bytes of ``group``.
    """
    load = dict.fromkeys((key, leaf, *carry))
    named = leaves.select(
        F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("_g"),  # null before every text
        F.col(leaf).alias("_hash"), F.struct(*load).alias("_load"),
    )
    placed = with_position(named, [F.col("_g"), F.col(f"_load.{key}"), F.col("_hash"), F.col("_load")], "_at")
    groups = written(placed.groupBy("_g").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n")), "merkle-groups")
    most, count = groups.agg(F.max("_n"), F.count(F.lit(1))).first()
    ranked = placed.join(groups, "_g").select("_g", (F.col("_at") - F.col("_from")).alias("_rank"), "_n", "_hash", "_load")
    storeys = _storeys(ranked, most or 0)

    roots = storeys[-1].select(F.col("_g").alias("_name"), F.col("_hash"))
    whole = with_position(roots, [F.col("_name")], "_at", unique=True).select(
        F.lit("").alias("_g"), (F.col("_at") - 1).alias("_rank"), F.lit(count).cast("bigint").alias("_n"), "_hash",
        F.struct("_name", F.col("_hash").alias("_sub")).alias("_load"),
    )
    upper = _storeys(whole, count)
    top = upper[-1].select("_g", "_block", F.array().cast(_STEPS).alias("_path"), F.lit("").alias("_sub"), F.col("_hash").alias("_root"))
    tops = _descended(upper, top).select(
        F.col("_load._name").alias("_g"), F.lit(0).cast("bigint").alias("_block"), "_path", F.col("_load._sub").alias("_sub"), "_root"
    )
    rows = _descended(storeys, tops)
    return rows.select("_load.*", F.col("_sub").alias("subroot"), F.col("_root").alias("root"), F.col("_path").alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hash and a path lead to."""
    return F.aggregate(path, leaf, lambda h, step: node_hash(step["left"], h, step["right"]))


def proof_digest(path: Column) -> Column:
    """Hash over the hashes of a path, from the leaf's level upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)

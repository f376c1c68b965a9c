"""Near-duplicate embeddings by NN-descent within each label.

Every vector keeps a list of its nearest others. Lists start from random trees: rows are sorted by
label and the sides they take of random hyperplanes, and blocks of neighbouring rows are compared.
Then the graph is refined: the neighbours of a vector's neighbours (in either direction) are compared
with it and the best are kept, until few lists change. Then every row is compared with all links of some
of the rows it is linked to, others each time, until that finds no new link; this fills groups of any size
at a cost that follows the number of links.
A bounded set of audit rows, compared with all rows, measures the recall as a mean over the rows that
have links, so that a dense group does not outweigh isolated pairs; rows of few links are measured apart,
and the audit is enlarged until it holds enough of them. Trees and refinements go on while either recall
is below the goal or a round still finds a link. Once the trees have cost as much as comparing all rows of
a label would, that is done instead, and the result is exact. At the end the entries that reach the
threshold are the links. The recall is null if the audit is a sample and none of its rows has a link.

Equal vectors of one label are compared once: they form a class, and links hold between classes.
Vectors that are null, zero, or hold null or non-finite components, and rows with a null label or id,
link with nothing. Vectors of different length do not link. Cosines are taken in double precision.
Repeated ids count as one vector (the first in order of label and components). An empty table gives an
empty result. Other columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import graph
from ..session import task_count, written

_PAIR = "a bigint, b bigint, sim double"


def classes(df: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Members (id, c) and classes (c, n, _label, _v): the vectors that can link, equal ones as one.
    ``c`` is the smallest id of the class."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("string").alias("_label"), v.alias("_v"))
    # -0.0 and 0.0 are one value.
    rows = rows.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct("_label", F.transform("_v", lambda x: x + 0.0).alias("_v"))).alias("r"))
    able = written(rows.select("id", "r.*").filter(F.col("_label").isNotNull() & fine & F.exists("_v", lambda x: x != 0)), "vectors")
    members = able.select("id", "_label", F.sha2(F.to_json("_v"), 256).alias("_d"))
    found = members.groupBy("_label", "_d").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("n"))
    of_class = written(members.join(found, ["_label", "_d"]).select("id", "c", "n"), "members")
    heads = of_class.filter(F.col("id") == F.col("c")).select("c", "n")
    return of_class.select("id", "c"), written(heads.join(able.withColumnRenamed("id", "c"), "c"), "classes")


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit rows of a column of equally long lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _pairs(a, b, sim) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())], names=["a", "b", "sim"])


def tree_pairs(vectors: DataFrame, seed: int, bits: int, keep: int, parts: int, block: int = 64) -> DataFrame:
    """Pairs (a < b) of rows that share a block of one random tree, the ``keep`` best of each row."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, last = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            size = np.array([len(v) for v in batch.column("_v")])
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                planes = np.random.default_rng([seed, int(n)]).standard_normal((int(n), bits + 1))
                side = _matrix(batch.column("_v").take(pa.array(at))) @ planes
                # Gray order: codes next to one another differ in one side.
                gray = (side[:, :bits] > 0).astype(np.int64)
                gray = np.bitwise_xor.accumulate(gray, axis=1)
                code[at], last[at] = gray @ (1 << np.arange(bits)[::-1]), side[:, bits]
            columns = [batch.column(n) for n in ("c", "_label", "_v")]
            yield pa.record_batch([*columns, pa.array(size), pa.array(code), pa.array(last)], names=["c", "_label", "_v", "_n", "_code", "_side"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, size = batch.column("_label").to_pylist(), batch.column("_n").to_pylist()
            ids = batch.column("c").to_numpy()
            edge = [0, *[i for i in range(1, len(ids)) if label[i] != label[i - 1] or size[i] != size[i - 1]], len(ids)]
            for begin, end in zip(edge[:-1], edge[1:]):
                unit = _matrix(batch.column("_v").slice(begin, end - begin))
                for at in range(0, max(end - begin - block // 2, 1), block // 2):
                    u, own = unit[at : at + block], ids[begin:end][at : at + block]
                    sim = u @ u.T
                    np.fill_diagonal(sim, -2)
                    best = np.argsort(-sim, axis=1)[:, :keep]
                    a, b = np.repeat(own, best.shape[1]), own[best.ravel()]
                    s = np.take_along_axis(sim, best, axis=1).ravel()
                    fine = s > -2
                    yield _pairs(np.minimum(a, b)[fine], np.maximum(a, b)[fine], s[fine])

    order = ["_label", "_n", "_code", "_side", "c"]
    rows = vectors.select("c", "_label", "_v").mapInArrow(coded, "c bigint, _label string, _v array<double>, _n bigint, _code bigint, _side double")
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(compared, _PAIR)


def cosines(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(a, b, sim) of pairs (a, b) whose vectors have equal length."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sim = np.empty(batch.num_rows)
                size = np.array([len(v) for v in batch.column("_va")])
                for n in np.unique(size):
                    at = np.flatnonzero(size == n)
                    take = pa.array(at)
                    sim[at] = np.einsum("ij,ij->i", _matrix(batch.column("_va").take(take)), _matrix(batch.column("_vb").take(take)))
                yield _pairs(batch.column("a"), batch.column("b"), sim)

    side = lambda c: vectors.select(F.col("c").alias(c), F.col("_v").alias(f"_v{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.size("_va") == F.size("_vb"))
    return joined.select("a", "b", "_va", "_vb").mapInArrow(compare, _PAIR)


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", "sim").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))


def _lists(known: DataFrame, room: int) -> DataFrame:
    """The neighbour lists (a, b, sim): the best ``room`` of each row."""
    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return _both(known).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= room)


def _beyond(lists: DataFrame, through: Column, known: DataFrame) -> DataFrame:
    """Pairs not yet compared of a row and a neighbour of one of its neighbours. ``through`` limits the
    neighbours that are asked for their lists."""
    ask = lists.filter(through).select(F.col("a").alias("x"), F.col("b").alias("y"))
    met = ask.join(lists.select(F.col("a").alias("y"), F.col("b").alias("z")), "y").filter(F.col("x") != F.col("z"))
    pairs = met.select(F.least("x", "z").alias("a"), F.greatest("x", "z").alias("b")).distinct()
    return pairs.join(known, ["a", "b"], "left_anti")


def audit_links(vectors: DataFrame, threshold: float, rows: int) -> tuple[DataFrame, bool]:
    """All links (x, b) of about ``rows`` audit rows x, by comparing them with every row, and whether
    all rows were drawn."""
    n = vectors.count()
    drawn = F.pmod(F.xxhash64(F.lit(31), "c"), F.lit(1_000_000)) < int(1e6 * min(1.0, rows / max(n, 1))) + 1
    picked = vectors.filter(drawn).limit(2 * rows).select("c", "_label", "_v").toArrow()  # bounded by the limit
    ids, label = picked.column("c").to_numpy(), np.array(picked.column("_label").to_pylist(), dtype=object)
    size = np.array([len(v) for v in picked.column("_v")])
    units = {int(s): _matrix(picked.column("_v").combine_chunks().take(pa.array(np.flatnonzero(size == s)))) for s in np.unique(size)}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([len(v) for v in batch.column("_v")])
            names = np.array(batch.column("_label").to_pylist(), dtype=object)
            all_ids = batch.column("c").to_numpy()
            for n, unit in units.items():
                at = np.flatnonzero(own == n)
                if len(at):
                    other = _matrix(batch.column("_v").take(pa.array(at))).T
                    every = np.flatnonzero(size == n)
                    for begin in range(0, len(every), 256):  # bounds the memory of a comparison
                        asked = every[begin : begin + 256]
                        sim = unit[begin : begin + 256] @ other
                        near = (sim >= threshold) & (label[asked][:, None] == names[at]) & (ids[asked][:, None] != all_ids[at])
                        i, j = np.nonzero(near)
                        yield _pairs(ids[asked][i], all_ids[at][j], sim[i, j])

    links = vectors.select("c", "_label", "_v").mapInArrow(compare, _PAIR)
    return links.select(F.col("a").alias("x"), "b"), len(ids) == n


def audit(vectors: DataFrame, threshold: float, rows: int, most: int, least: int, few: int) -> tuple[DataFrame, bool]:
    """The audited links, of more and more rows (at most about ``most``) until ``least`` rows have 1 to ``few`` links."""
    while True:
        links, whole = audit_links(vectors, threshold, rows)
        links = written(links, "audit")
        if whole or rows >= most or links.groupBy("x").count().filter(F.col("count") <= few).count() >= least:
            return links, whole
        rows = min(4 * rows, most)


def row_recall(links: DataFrame, truth: DataFrame, few: int) -> tuple[float | None, float | None]:
    """Mean over the audit rows that have links of the share found, and the same over rows of at most
    ``few`` links. Null where there is no such row."""
    found = _both(links).select(F.col("a").alias("x"), "b").join(truth.select("x").distinct(), "x", "left_semi").withColumn("_f", F.lit(1.0))
    rows = truth.join(found, ["x", "b"], "left").groupBy("x").agg(
        F.avg(F.coalesce("_f", F.lit(0.0))).alias("share"), F.count(F.lit(1)).alias("n")
    )
    return tuple(rows.agg(F.avg("share"), F.avg(F.when(F.col("n") <= few, F.col("share")))).first())


def block_links(vectors: DataFrame, threshold: float, block: int = 1024) -> DataFrame:
    """All links (a, b, sim), a < b, by comparing the rows of each label block by block."""

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        mine, i, j = rows.column("_mine").to_numpy(), rows.column("_i")[0].as_py(), rows.column("_j")[0].as_py()
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        ids, unit = rows.column("c").to_numpy(), _matrix(rows.column("_v").combine_chunks())
        sim = unit[left] @ unit[right].T
        x, y = np.nonzero((sim >= threshold) & ((i != j) | (ids[left][:, None] < ids[right])))
        a, b = ids[left][x], ids[right][y]
        return pa.Table.from_batches([_pairs(np.minimum(a, b), np.maximum(a, b), sim[x, y])])

    rows = vectors.select("c", "_label", "_v", F.size("_v").alias("_n"))
    blocks = rows.groupBy("_label", "_n").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_k"))
    placed = rows.join(blocks, ["_label", "_n"]).withColumn("_mine", F.pmod(F.xxhash64("c"), F.col("_k")).cast("int"))
    met = placed.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    cells = met.withColumns({"_i": F.least("_mine", "_o"), "_j": F.greatest("_mine", "_o")})
    return cells.select("c", "_label", "_n", "_v", "_mine", "_i", "_j").groupBy("_label", "_n", "_i", "_j").applyInArrow(compare, _PAIR)


def near_links(
    vectors: DataFrame, threshold: float, room: int = 6, trees: int = 4, goal: float = 0.99, audit_rows: int = 256,
    through: int = 3, audit_most: int = 8192, audit_least: int = 64, most_trees: int | None = None,
) -> tuple[DataFrame, float | None]:
    """Links (a, b, sim) between classes with cosine of at least ``threshold``, and the audited recall
    (the smaller one of all rows with links and of rows with few). After ``most_trees`` trees, by default
    as many as cost about what comparing all rows costs, all rows are compared."""
    largest = vectors.groupBy("_label").count().agg(F.max("count")).first()[0] or 1
    bits = max(1, int(np.ceil(np.log2(max(2, largest / 48)))))
    parts = max(1, min(task_count(vectors.sparkSession), vectors.count() // 512))  # a cut separates neighbours
    truth, whole = audit(vectors, threshold, audit_rows, audit_most, audit_least, room)
    # A tree compares a row with about 64 others, and codes, sorts and shuffles it as well.
    most_trees = max(32, largest // 256) if most_trees is None else most_trees
    known, recall, n_links, grown = None, None, 0, 0
    while grown < most_trees:
        fresh = None
        for t in range(grown, grown + trees):
            pairs = tree_pairs(vectors, t, bits, room, parts)
            fresh = pairs if fresh is None else fresh.unionByName(pairs)
        first, grown = grown == 0, grown + trees
        fresh = fresh.groupBy("a", "b").agg(F.max("sim").alias("sim"))
        known = fresh if known is None else known.unionByName(fresh.join(known, ["a", "b"], "left_anti"))
        known = _closed(_descended(written(known, "known"), vectors, room, through), vectors, threshold)
        links = known.filter(F.col("sim") >= threshold)
        before, n_links = n_links, links.count()
        measured = [r for r in row_recall(links, truth, room) if r is not None]
        recall = min(measured) if measured else (1.0 if whole else None)
        if (whole or not first) and n_links == before and (recall is None or recall >= goal):
            return written(links, "links"), recall
    return written(block_links(vectors, threshold), "links"), 1.0


def _descended(known: DataFrame, vectors: DataFrame, room: int, through: int) -> DataFrame:
    """Joins neighbours of neighbours until fewer than one list entry in a thousand is new."""
    lists = written(_lists(known, room), "lists")
    while True:
        known = known.unionByName(written(cosines(_beyond(lists, F.col("_r") <= through, known), vectors), "known"))
        now = written(_lists(known, room), "lists")
        new = now.join(lists, ["a", "b"], "left_anti").count()
        lists = now
        if new * 1000 <= now.count():
            return known


def _closed(known: DataFrame, vectors: DataFrame, threshold: float, asked: int = 8) -> DataFrame:
    """Compares every row with all links of about ``asked`` of the rows it is linked to, others each
    time, until that finds no new link."""
    turn = 0
    while True:
        links = _both(known.filter(F.col("sim") >= threshold))
        degree = links.groupBy("a").agg(F.count(F.lit(1)).alias("_d"))
        lists = written(links.join(degree, "a"), "lists")
        some = F.pmod(F.xxhash64(F.lit(turn), "a", "b"), F.col("_d")) < asked
        found = written(cosines(_beyond(lists, some, known), vectors), "known")
        known, turn = known.unionByName(found), turn + 1
        if found.filter(F.col("sim") >= threshold).isEmpty():
            return known


def near_duplicates(
    df: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label", **options
) -> DataFrame:
    """One row per id: ``n_links`` (other vectors linked directly), ``component_id`` (smallest id
    reachable by links), ``kept`` (it is that smallest id) and the audited ``recall`` of the links."""
    members, heads = classes(df, key, vector, label)
    links, recall = near_links(heads.select("c", "_label", "_v"), threshold, **options)
    size = heads.select(F.col("c").alias("b"), "n")
    near = _both(links).join(size, "b").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("_near"))
    roots = graph.components(links.select(F.col("a").alias("lo"), F.col("b").alias("hi"))).withColumnRenamed("node", "c")
    of_class = heads.select("c", "n").join(near, "c", "left").join(roots, "c", "left").select(
        "c", (F.col("n") - 1 + F.coalesce("_near", F.lit(0))).alias("_links"), F.coalesce("root", "c").alias("_root")
    )
    own = members.join(of_class, "c").select(F.col("id"), "_links", "_root")
    every = df.select(F.col(key).cast("bigint").alias("id")).join(own, "id", "left")
    return every.select(
        F.col("id").alias(key),
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("_root", "id").alias("component_id"),
        (F.coalesce("_root", "id") == F.col("id")).alias("kept"),
        F.lit(recall).cast("double").alias("recall"),
    )

"""Near-duplicate embeddings by dual traversal of cover trees.

The top of the tree is made by Spark: a bounded sample of pivots per label, every
vector goes to its nearest pivot's cell, and pairs of cells that their covering
radii prove apart are pruned. Below that, a task builds a cover tree per block of a
cell, whose levels are nested and halve their radius, and walks two trees at once,
pruning node pairs by the same bound. All pairs at the threshold are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import column_of, number_of, numbered, prepare, stored
from tracklens.llm.components import connected_components

CELL_ROWS = 4096
MOST_PIVOTS = 64
STRIP = 512


def rounding(size: int) -> float:
    """Most that a distance of unit vectors of ``size`` components can be off, by the root of the products' error."""
    return 3 * float(np.sqrt((size + 2) * np.finfo(np.float64).eps))


# ---------------------------------------------------------------- one task's trees


class Node:
    """A cover-tree node: rows it covers, its centre's row, covering radius, children."""

    __slots__ = ("centre", "radius", "children", "heads", "radii", "single")

    def __init__(self, centre: int, radius: float):
        self.centre, self.radius, self.children = centre, radius, None


def cover_tree(x: np.ndarray) -> Node | None:
    """Tree over unit vectors ``x``. A child covers half its parent's radius.

    Children's centres lie more than that half apart; the parent's centre is one of them. Where half
    the radius is within rounding, every vector is a child.
    """
    if not len(x):
        return None
    every, off = np.arange(len(x)), rounding(x.shape[1])
    top = Node(0, float(_distance(x, x[0])[1:].max(initial=0.0)))
    todo = [(top, every)]
    while todo:
        node, rows = todo.pop()
        if len(rows) == 1:
            continue
        node.children = []
        half = node.radius / 2
        centre, rest = node.centre, rows
        while len(rest):
            away = _distance(x[rest], x[centre])
            away[rest == centre] = 0.0
            near = away <= half if half > off else rest == centre
            child = Node(centre, float(away[near].max()))
            node.children.append(child)
            todo.append((child, rest[near]))
            rest = rest[~near]
            centre = int(rest[0]) if len(rest) else -1
        node.heads = np.array([c.centre for c in node.children])
        node.radii = np.array([c.radius for c in node.children])
    # A child without children is one vector.
    todo = [top]
    while todo:
        node = todo.pop()
        if node.children:
            node.single = np.array([c.children is None for c in node.children])
            todo += node.children
    return top


def _distance(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ c)))


class _Parts:
    """Parts of linked rows; keeps no pairs."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.up[x]
            if (up == x).all():
                return x
            x = up

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            i, j = self.root(i), self.root(j)
            apart = i != j
            i, j = i[apart], j[apart]
            if len(i):
                np.minimum.at(self.up, np.maximum(i, j), np.minimum(i, j))


def linked(x: np.ndarray, left: np.ndarray, right: np.ndarray | None, weight: np.ndarray, least: float):
    """Links of unit vectors ``x[left]`` with ``x[right]``, or among ``x[left]``.

    Returns per row the summed weight of its partners, and the parts.
    """
    links, parts = np.zeros(len(x), np.int64), _Parts(len(x))
    reach = np.sqrt(2.0 - 2.0 * least) + rounding(x.shape[1])
    a = cover_tree(x[left])
    if right is None:
        right, b = left, a
    else:
        b = cover_tree(x[right])
    if a is None or b is None:
        return links, parts
    for tree, rows in ((a, left), (b, right)):
        if tree.children is None:  # a tree of one vector: give it itself as child
            tree.children = [Node(tree.centre, 0.0)]
            tree.heads, tree.radii, tree.single = np.array([0]), np.zeros(1), np.ones(1, bool)
    todo = [(a, b)]
    while todo:
        p, q = todo.pop()
        own = p is q
        # One vector against a node meets the node's children.
        ph, pr, ps = (p.heads, p.radii, p.single) if p.children else (np.array([p.centre]), np.zeros(1), np.ones(1, bool))
        qh, qr, qs = (q.heads, q.radii, q.single) if q.children else (np.array([q.centre]), np.zeros(1), np.ones(1, bool))
        columns, right_rows = x[right[qh]], right[qh]
        for at in range(0, len(ph), STRIP):
            rows = left[ph[at : at + STRIP]]
            dot = x[rows] @ columns.T
            if own:
                dot[np.arange(len(ph))[None, :] < np.arange(at, at + len(rows))[:, None]] = -3.0
            single = ps[at : at + STRIP, None] & qs[None, :]
            hit = single & (dot >= least)
            if own:
                hit &= rows[:, None] != right_rows[None, :]
            i, j = np.nonzero(hit)
            if len(i):
                links[rows] += hit @ weight[right_rows]
                links[right_rows] += weight[rows] @ hit
                parts.join(rows[i], right_rows[j])
            bound = reach + pr[at : at + STRIP, None] + qr[None, :]
            near = ~single & (dot > -2.0) & (2.0 - 2.0 * dot <= bound * bound)
            for i, j in zip(*np.nonzero(near), strict=True):
                todo.append((
                    p.children[at + i] if p.children else p,
                    q.children[j] if q.children else q,
                ))
    return links, parts


# ---------------------------------------------------------------- Spark steps


def _units(id_name: str, vector: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = column_of(batch, "label").to_pylist()
            column = column_of(batch, vector)
            tags, units = [], []
            for label, value in zip(labels, column.to_pylist(), strict=True):
                unit = None
                if label is not None and value and None not in value:
                    x = np.array(value, np.float64)
                    if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                        x = x / top  # keeps squares in range
                        unit = (x / np.sqrt(x @ x)).tobytes()
                units.append(unit)
                tags.append(xxhash.xxh3_128_digest(label.encode() + b"\0" + unit) if unit else None)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, id_name), column_of(batch, "label"), pa.array(tags, pa.binary()), pa.array(units, pa.binary())],
                names=["id", "label", "tag", "unit"],
            )

    return run


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 1))


def _to_cells(rows: pa.Table, pivots: pa.Table) -> pa.Table:
    """Each vector's nearest pivot and the distance to it; 2 and cell 0 without pivots."""
    n = rows.num_rows
    cell, away = np.zeros(n, np.int32), np.full(n, 2.0)
    if n and pivots.num_rows:
        # Sorted, so that a number names the same pivot in every group of a label.
        order = np.argsort(np.array(pivots.column("tag").to_pylist(), dtype=object))
        centres = _matrix(pivots.column("unit").take(pa.array(order)))
        for at in range(0, n, STRIP):
            dot = _matrix(rows.column("unit").slice(at, STRIP)) @ centres.T
            best = dot.argmax(axis=1)
            cell[at : at + STRIP] = best
            away[at : at + STRIP] = np.sqrt(np.maximum(0, 2 - 2 * dot[np.arange(len(dot)), best]))
    return pa.table({
        "tag": rows.column("tag"), "part": rows.column("part"), "unit": rows.column("unit"),
        "n": rows.column("n"), "cell": pa.array(cell), "away": pa.array(away),
    })


def _apart(least: float):
    """Drop pairs of cells whose covering radii prove that nothing links."""
    reach = float(np.sqrt(2 - 2 * least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            c = {n: column_of(batch, n).to_pylist() for n in ("u1", "u2", "r1", "r2", "c1", "c2")}
            for u, v, r, s, i, j in zip(c["u1"], c["u2"], c["r1"], c["r2"], c["c1"], c["c2"], strict=True):
                if i == j or u is None or v is None:
                    keep.append(True)
                    continue
                u, v = np.frombuffer(u), np.frombuffer(v)
                keep.append(bool(np.linalg.norm(u - v) <= reach + r + s + rounding(len(u))))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["part", "c1", "c2", "n1", "n2"])

    return run


def _walk(least: float):
    def run(table: pa.Table) -> pa.Table:
        x, weight = _matrix(table.column("unit")), np.array(table.column("n").to_pylist(), np.int64)
        side, same = np.array(table.column("side").to_pylist()), table.column("same")[0].as_py()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        links, parts = linked(x, left, None if same else right, weight, least)
        root = parts.root(np.arange(len(x)))
        some = np.flatnonzero((links > 0) | (root != np.arange(len(x))))
        tags = table.column("tag")
        return pa.table({
            "tag": tags.take(pa.array(some)), "links": pa.array(links[some]),
            "root": tags.take(pa.array(root[some])),
        })

    return run


def embedding_components(
    vectors: DataFrame,
    id_name: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.93,
    cell_rows: int = CELL_ROWS,
    most_pivots: int = MOST_PIVOTS,
) -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row for every row of ``vectors``.

    Vectors of equal labels link at a cosine of ``least`` or more, in double precision.
    Vectors that are null, empty, zero, or hold null or non-finite components, and those with a
    null label, link with nothing and are their own component. Vectors of different
    lengths do not link. Repeated rows are vectors of their own that link. Null ids take
    part, but are a component's id only if all its ids are null. ``kept`` tells whether the id is the
    component's (null counts as equal to null). An empty table gives no rows.

    Equal vectors are one class, found by a map-side combine first. ``cell_rows`` bounds
    the vectors a task holds per side; at most about ``most_pivots`` pivots per label are sampled,
    larger cells are cut into blocks that all meet.
    """
    prepare(vectors.sparkSession)
    slim = vectors.select(
        vectors[id_name].cast("long").alias("id"), vectors[vector].alias("v"),
        vectors[label].cast("string").alias("label"),
    )
    rows = stored(
        slim.mapInArrow(_units("id", "v"), "id long, label string, tag binary, unit binary"), "vectors"
    )
    classes = stored(
        rows.where("tag is not null").groupBy("tag").agg(
            F.first("unit").alias("unit"), F.first("label").alias("label"),
            F.min("id").alias("least"), F.count(F.lit(1)).alias("n"),
        ).withColumn("part", F.concat_ws(":", F.length("unit"), F.hex(F.col("label").cast("binary")))),
        "vector-classes",
    )
    sizes = classes.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    sized = classes.join(sizes, "part")
    want = F.least(F.ceil(F.col("size") / cell_rows), F.lit(most_pivots))
    draw = F.pmod(F.xxhash64("tag"), F.lit(1 << 40)) / float(1 << 40)
    pivots = stored(
        sized.where((F.col("size") > cell_rows) & (draw < want / F.col("size"))).select("part", "tag", "unit", "size"),
        "vector-pivots",
    )
    salts = F.ceil(F.col("size") / cell_rows).cast("int")
    dealt = sized.withColumn("salt", F.pmod(F.xxhash64("tag", F.lit(1)), salts).cast("int"))
    spread = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    placed = stored(
        dealt.select("part", "salt", "tag", "unit", "n").groupBy("part", "salt")
        .cogroup(spread.select("part", "salt", "tag", "unit").groupBy("part", "salt"))
        .applyInArrow(_to_cells, "tag binary, part string, unit binary, n long, cell int, away double"),
        "vector-cells",
    )
    cells = placed.groupBy("part", "cell").agg(F.max("away").alias("r"), F.count(F.lit(1)).alias("n"))
    order = F.expr("sort_array(collect_list(struct(tag, unit)))")
    centres = pivots.groupBy("part").agg(order.alias("p")).select("part", F.posexplode("p").alias("cell", "p"))
    cells = stored(
        cells.join(centres, ["part", "cell"], "left").select("part", "cell", "r", "n", F.col("p.unit").alias("u")),
        "vector-cell-list",
    )
    one = cells.toDF("part", "c1", "r1", "n1", "u1")
    two = cells.toDF("part", "c2", "r2", "n2", "u2")
    near = one.join(two, "part").where("c1 <= c2").mapInArrow(
        _apart(least), "part string, c1 int, c2 int, n1 long, n2 long"
    )
    blocks = lambda n: F.ceil(F.col(n) / cell_rows).cast("int")
    met = near.withColumn("b1", F.explode(F.sequence(F.lit(0), blocks("n1") - 1))).withColumn(
        "b2", F.explode(F.sequence(F.lit(0), blocks("n2") - 1))
    ).where("c1 < c2 or b1 <= b2")
    met = met.withColumn("same", F.expr("c1 = c2 and b1 = b2")).withColumn(
        "pair", F.concat_ws("/", "part", "c1", "b1", "c2", "b2")
    )
    sides = F.array(
        F.struct(F.col("c1").alias("cell"), F.col("b1").alias("block"), F.col("n1").alias("size"), F.lit(0).alias("side")),
        F.struct(F.col("c2").alias("cell"), F.col("b2").alias("block"), F.col("n2").alias("size"), F.lit(1).alias("side")),
    )
    wanted = met.withColumn("s", F.explode(sides)).where("not same or s.side = 0").select(
        "part", "pair", "same", F.col("s.cell").alias("cell"), F.col("s.block").alias("block"), F.col("s.side").alias("side")
    )
    counts = cells.select("part", "cell", blocks("n").alias("blocks"))
    blocked = placed.join(counts, ["part", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("tag", F.lit(2)), F.col("blocks")).cast("int")
    )
    groups = blocked.join(wanted, ["part", "cell", "block"]).select("pair", "same", "side", "tag", "unit", "n")
    found = stored(
        groups.groupBy("pair").applyInArrow(_walk(least), "tag binary, links long, root binary"), "vector-links"
    )
    return _rows_of(rows, classes, found, id_name, vectors.schema[id_name].dataType)


def _rows_of(rows: DataFrame, classes: DataFrame, found: DataFrame, id_name: str, kind: T.DataType) -> DataFrame:
    roots = connected_components(found.select(F.col("tag").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("tag").agg(F.sum("links").alias("links"))
    named = classes.select("tag", "least", "n").join(links, "tag", "left").join(
        roots.withColumnRenamed("node", "tag"), "tag", "left"
    ).select("tag", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "tag").alias("root"))
    named = stored(named, "vector-named")
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(heads, "root").select(F.col("tag").alias("t"), "n_links", "component_id")
    joined = rows.select("id", "tag").join(known, F.col("tag") == F.col("t"), "left")
    component = F.when(F.col("tag").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").cast(kind).alias(id_name), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )


def keep_one(vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding", label: str = "label", **how) -> DataFrame:
    """The rows of ``vectors`` that are kept; columns stay the same."""
    kept = embedding_components(vectors, id_name, vector, label, **how).where("kept").select(
        F.col(id_name).alias("kept_id")
    ).distinct()
    rows, name = numbered(vectors), number_of(vectors, id_name)
    return rows.join(kept, rows[name].eqNullSafe(F.col("kept_id")), "left_semi").toDF(*vectors.columns)

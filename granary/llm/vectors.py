"""Near duplicates among embeddings by a forest of random-projection trees.

Vectors with one label and one length are a region for each tree. A region is split by a
random direction: of several directions and places, the one whose border has fewest vectors
near it is taken, and vectors near the border go to both sides. The splits of a region are
fitted on a bounded sample of it; regions that are still large are split again in a next
round, on a new sample of their own. Regions are worked on in slices, so a label with most
of the rows is no single task. A region that no direction splits is compared in blocks.

Vectors are compared inside leaves only, in double precision. A pair that shares several
leaves counts in the first of them, so pairs are counted without being written out: a leaf
gives each vector's number of links and joins linked vectors to its smallest one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import words as W
from granary.llm.shared import components, written

COSINE = 0.93
TREES = 6
#: Vectors in a leaf, a region's sample, and rows of a slice.
LEAF, SAMPLE, SLICE = 512, 4096, 20_000
#: Vectors within this distance of a border (in units of the vectors' length) go to both
#: sides; directions tried for a split; share of a region that may be near the border.
MARGIN, TRIED, SPREAD = 0.035, 12, 0.6
ROUNDS = 12

_PLACES = "region long, done boolean, rep long, vec binary"
_MODEL = "region long, directions binary, borders binary, left binary, right binary"


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.float64).reshape(len(values), -1)


def split(sample: np.ndarray, rows: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tree over a sample of a region of ``rows`` vectors: directions, borders, and for each
    side the next node, or -1 for a leaf that may be split again, -2 for one that cannot."""
    rng = np.random.default_rng([seed, 1])
    width = sample.shape[1]
    directions, borders, sides = [], [], []

    def grow(at: np.ndarray) -> int:
        size = len(at) * rows / max(1, len(sample))
        if size <= LEAF or len(at) < 32:
            return -1
        tried = rng.standard_normal((TRIED, width))
        tried /= np.linalg.norm(tried, axis=1, keepdims=True)
        place = sample[at] @ tried.T
        # Borders between the third and the seventh tenth.
        marks = np.quantile(place, np.linspace(0.3, 0.7, 9), axis=0)
        near = np.array([(np.abs(place - m) <= MARGIN).mean(axis=0) for m in marks])
        m, d = np.unravel_index(near.argmin(), near.shape)
        if near[m, d] > SPREAD:
            return -2
        here = len(borders)
        directions.append(tried[d])
        borders.append(marks[m, d])
        sides.append([0, 0])
        sides[here] = [grow(at[place[:, d] <= marks[m, d] + MARGIN]), grow(at[place[:, d] >= marks[m, d] - MARGIN])]
        return here

    root = grow(np.arange(len(sample)))
    if root < 0:
        return np.zeros((0, width)), np.zeros(0), np.array([root]), np.array([root])
    both = np.array(sides, dtype=np.int64)
    return np.array(directions), np.array(borders), both[:, 0], both[:, 1]


def _walk(vectors: np.ndarray, model, region: int) -> list[tuple[int, bool, np.ndarray]]:
    """(leaf, whether it cannot be split, rows) for each leaf of a region's tree."""
    directions, borders, left, right = model
    named = lambda path: int(W.mix(np.array([region], dtype=np.int64).view(np.uint64) + W.mix(np.array([path], dtype=np.uint64)))[0].astype(np.int64))
    if not len(borders):
        return [(named(1), left[0] == -2, np.arange(len(vectors)))]
    out, todo = [], [(0, 1, np.arange(len(vectors)))]
    while todo:
        node, path, at = todo.pop()
        place = vectors[at] @ directions[node]
        for bit, side, mine in ((0, left[node], place <= borders[node] + MARGIN), (1, right[node], place >= borders[node] - MARGIN)):
            rows, way = at[mine], (path * 2 + bit) % 2**62
            if side >= 0:
                todo.append((int(side), way, rows))
            elif len(rows):
                out.append((named(way), side == -2, rows))
    return out


def _fit(table: pa.Table) -> pa.Table:
    region, rows = table.column("region")[0].as_py(), table.column("size")[0].as_py()
    table = table.sort_by("rep")
    parts = split(_matrix(table.column("vec")), rows, region % 2**62)
    kinds = (np.float64, np.float64, np.int64, np.int64)
    return pa.table({"region": [region]} | {n: [p.astype(k).tobytes()] for n, p, k in zip(("directions", "borders", "left", "right"), parts, kinds, strict=True)})


def _assign(rows: pa.Table, model: pa.Table) -> pa.Table:
    out = {"region": [], "done": [], "rep": [], "vec": []}
    if rows.num_rows:
        region, vectors = rows.column("region")[0].as_py(), _matrix(rows.column("vec"))
        m = model.slice(0, 1).to_pylist()[0]
        borders = np.frombuffer(m["borders"])
        tree = (
            np.frombuffer(m["directions"]).reshape(len(borders), -1) if len(borders) else None, borders,
            np.frombuffer(m["left"], dtype=np.int64), np.frombuffer(m["right"], dtype=np.int64),
        )
        reps, raw = rows.column("rep").to_pylist(), rows.column("vec").to_pylist()
        for leaf, closed, at in _walk(vectors, tree, region):
            out["region"] += [leaf] * len(at)
            out["done"] += [bool(closed)] * len(at)
            out["rep"] += [reps[i] for i in at]
            out["vec"] += [raw[i] for i in at]
    return pa.table(out, schema=pa.schema([("region", pa.int64()), ("done", pa.bool_()), ("rep", pa.int64()), ("vec", pa.binary())]))


def _leaves(vectors: DataFrame, trees: int) -> DataFrame:
    """``region, rep``: the leaves of each vector in all trees."""
    places = written(
        vectors.select(
            F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "space", "rep", "vec"
        ).select(F.xxhash64("tree", "space").alias("region"), F.lit(False).alias("done"), "rep", "vec"),
        "regions",
    )
    closed = []
    for _ in range(ROUNDS):
        sizes = places.groupBy("region").agg(F.count("*").alias("size"), F.max("done").alias("done"))
        large = written(sizes.filter((F.col("size") > LEAF) & ~F.col("done")).select("region", "size"), "large")
        closed.append(places.join(large, "region", "left_anti").select("region", "rep"))
        if large.isEmpty():
            break
        open_rows = places.join(large, "region")
        # A sample of SAMPLE rows and a few standard deviations more.
        chance = F.pmod(F.xxhash64("rep", "region"), F.lit(1 << 30)) / float(1 << 30)
        model = open_rows.filter(chance < F.lit(float(SAMPLE)) / F.col("size")).groupBy("region").applyInArrow(_fit, _MODEL)
        slices = F.greatest(F.lit(1), F.ceil(F.col("size") / SLICE)).cast("int")
        sliced = open_rows.withColumn("slice", F.pmod(F.xxhash64("rep"), slices).cast("int")).select("region", "slice", "rep", "vec")
        dealt = model.join(large, "region").withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("size")
        places = written(
            sliced.groupBy("region", "slice").cogroup(dealt.groupBy("region", "slice")).applyInArrow(_assign, _PLACES),
            "regions",
        )
    else:
        closed.append(places.select("region", "rep"))
    out = closed[0]
    for c in closed[1:]:
        out = out.unionByName(c)
    return out.distinct()


def _compare(cosine: float, blocks: bool):
    def run(table: pa.Table) -> pa.Table:
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        region, side = table.column("region")[0].as_py(), table.column("side").to_numpy()
        x = _matrix(table.column("vec"))
        leaves = [set(v) for v in table.column("leaves").to_pylist()]
        links, root = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        first, second = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if blocks and (side == 1).any() else (np.arange(len(rep)),) * 2
        for begin in range(0, len(first), 512):
            rows = first[begin : begin + 512]
            a, b = np.nonzero(x[rows] @ x[second].T >= cosine)
            for i, j in zip(rows[a].tolist(), second[b].tolist(), strict=True):
                # In the first of the leaves that a pair shares, and once there.
                if (first is second and i >= j) or min(leaves[i] & leaves[j]) != region:
                    continue
                links[i] += copies[j]
                links[j] += copies[i]
                s, t = top(i), top(j)
                if s != t:
                    if rep[s] < rep[t]:
                        root[t] = s
                    else:
                        root[s] = t
        tops = np.array([rep[top(i)] for i in range(len(rep))], dtype=np.int64)
        keep = links > 0
        return pa.table({"rep": rep[keep], "links": links[keep], "root": tops[keep]})

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES) -> DataFrame:
    """Groups of ``vectors(vec_id, embedding, label, ...)`` linked by a cosine of at least ``cosine``.

    One row per row: ``vec_id, n_links, component_id, kept``. Only vectors with one label (not
    null) and as many components are compared. Null, zero and empty vectors and vectors with
    a null or non-finite component link with nothing. No pair below ``cosine`` is linked; of
    those above, the forest finds nearly all. Equal vectors always link; they are compared
    once, for their smallest vec_id, and each counts as a link. A row without vec_id is a
    group of its own with a null component_id and no links. Rows that repeat a vec_id with
    one label count as one vector each. Other columns are ignored, whatever their names. An
    empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    some = F.exists("embedding", lambda v: v != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & some, F.lit(False))
    held = written(
        rows.select("vec_id", F.when(usable, F.col("label")).alias("label"), F.when(usable, F.col("embedding")).alias("embedding")),
        "vectors",
    )
    same = ["label", "embedding"]
    classes = held.filter("embedding is not null").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))

    def unit(batches):
        for batch in batches:
            scaled = []
            for v in batch.column("embedding"):
                a = v.values.to_numpy()
                a = a / np.abs(a).max()
                scaled.append((a / np.linalg.norm(a)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("space", "rep", "copies")), pa.array(scaled, pa.binary())], names=["space", "rep", "copies", "vec"]
            )

    space = F.xxhash64("label", F.size("embedding")).alias("space")
    units = written(
        classes.select(space, "rep", "copies", "embedding").mapInArrow(unit, "space long, rep long, copies long, vec binary"), "units"
    )
    leaves = written(_leaves(units, trees), "leaves")
    listed = leaves.groupBy("rep").agg(F.sort_array(F.collect_set("region")).alias("leaves"))
    sizes = leaves.groupBy("region").agg(F.count("*").alias("size")).filter("size > 1")
    full = leaves.join(sizes, "region").join(units.drop("space"), "rep").join(listed, "rep")
    schema = "rep long, links long, root long"
    wide = 8 * LEAF
    small = full.filter(F.col("size") <= wide).withColumn("side", F.lit(0)).groupBy("region").applyInArrow(_compare(cosine, False), schema)
    # Blocks of a leaf that could not be split meet two by two.
    many = F.ceil(F.col("size") / (wide // 2)).cast("int")
    block = F.pmod(F.xxhash64("rep"), F.col("many")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("many") - 1),
        lambda o: F.struct(F.least(o, F.col("own")).alias("low"), F.greatest(o, F.col("own")).alias("high"), (o < F.col("own")).cast("int").alias("side")),
    )
    large = (
        full.filter(F.col("size") > wide)
        .withColumn("many", many)
        .withColumn("own", block)
        .withColumn("meet", F.explode(meets))
        .select("region", "rep", "copies", "vec", "leaves", "meet.low", "meet.high", "meet.side")
        .groupBy("region", "low", "high")
        .applyInArrow(_compare(cosine, True), schema)
    )
    found = written(small.unionByName(large), "links")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    named = (
        classes.select(*same, "rep", "copies")
        .join(linked, "rep", "left")
        .join(roots, "rep", "left")
        .select(*same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "rep").alias("found"))
    )
    return (
        held.join(named, same, "left")
        .withColumn("component_id", F.coalesce("found", "vec_id"))
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )

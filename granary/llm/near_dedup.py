"""Near duplicates by an LSH forest over MinHash signatures.

1. *Signatures.* One pass gives every document its number of distinct shingles, a digest of
   its shingle set and 256 minima, also as one bit each. Documents with equal sets are one
   class; only one row of a class goes on.
2. *Forest.* Each order sorts all signatures by minima of its own, over range partitions, so
   neighbours in it share the longest prefixes. Rows that share the shortest prefix that
   counts (two minima) are a region.
3. *Neighbours.* Each row walks from its longest common prefix to shorter ones and stops at
   the first that holds a candidate, a row whose signature bits and set size allow the wanted
   similarity. So the depth is that of the region around the row. These pairs are confirmed
   on the full shingle sets and joined to groups, which settles most rows.
4. *The rest.* A region that still has rows of several groups is read down to its shortest
   prefix: every candidate pair of different groups is compared on the full sets, and a region
   gives out one link for each two groups it joins.
5. *Crowded regions* are no task of their own. The row that is named most often in one is
   compared with all its rows, so a family around one original becomes one group. If groups
   remain, their rows go into a second forest with deeper prefixes (five minima) and many more
   orders, which finds as many of the pairs among far fewer candidates. Only regions that are
   crowded there too are dealt into blocks that meet two by two.

No limit grows with the rows, and no candidate is left out. A pair at a similarity of 0.75
shares no region of the first forest with probability 5e-5, none of the second with 1e-6, and
has too few equal bits with 3e-6; these bound what may be missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import words as W
from granary.llm.shared import components, written

SHINGLE = 5
PERCENT = 75
VALUES = 256


@dataclass(frozen=True)
class Orders:
    """A forest: its orders, the minima an order sorts by, and the shortest prefix."""

    count: int
    values: int
    shortest: int


#: The usual forest, and the one for rows of crowded regions.
FORESTS = (Orders(12, 8, 2), Orders(51, 5, 5))
#: Equal bits (of 256) from which a pair is a candidate: 4.5 standard deviations below the
#: 224 that a similarity of 0.75 gives on average.
LIKELY = 200
#: A region with more rows is crowded.
REGION_ROWS = 4096
SALTS = 8

_FACTORS = np.random.default_rng(20240229).integers(0, 2**63, size=VALUES // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, sig binary, minima binary"
_ROWS = "key long, rep long, n long, sig binary"
_FOREST = _ROWS + ", label binary"
_FOUND = _ROWS + ", partner long, open boolean"
_MEETING = _ROWS + ", root long, region long, side long"


def shingle_sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = W.hashed(texts, lower=True)
    grams = {k: words.grams(k) for k in range(1, size + 1)}
    for begin, count in zip(words.bounds[:-1].tolist(), words.counts.tolist(), strict=True):
        if count >= size:
            h = np.sort(grams[size][begin : begin + count - size + 1])
            yield h[np.concatenate(([True], h[1:] != h[:-1]))]
        elif count:
            yield W.mix(grams[count][begin : begin + 1] + np.uint64(count))
        else:
            yield np.zeros(0, dtype=np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each of VALUES hash functions: the halves of VALUES / 2 products."""
    best = np.full(VALUES, np.iinfo(np.uint32).max, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):
            product = shingles[at : at + 512, None] * _FACTORS
            np.minimum(best, product.view(np.uint32).min(axis=0), out=best)
    return best


def _signed(size: int):
    def run(batches):
        for batch in W.parts(batches):
            n, a, b, sig, low = [], [], [], [], []
            for s in shingle_sets(W.utf8(batch.column("text")), size):
                n.append(len(s))
                a.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                b.append(int(W.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                least = minima(s)
                sig.append(np.packbits((least >> np.uint32(4)) & np.uint32(1)).tobytes())
                low.append((least & np.uint32(0xFFFF)).astype(">u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array(sig, pa.binary()),
                    pa.array(low, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sig", "minima"],
            )

    return run


def _key(h: np.ndarray, order: int) -> np.ndarray:
    """A hash with the number of its order in the last six bits."""
    return ((h & ~np.uint64(63)) | np.uint64(order)).view(np.int64)


def _forest(forest: Orders):
    """A row for each class and order: its region, and the minima the order sorts by."""

    def run(batches):
        for batch in batches:
            least = np.frombuffer(b"".join(batch.column("minima").to_pylist()), dtype=">u2").reshape(-1, VALUES)
            sig = batch.column("sig")
            rep, n = batch.column("rep"), batch.column("n_shingles")
            for t in range(forest.count):
                own = least[:, t * forest.values : (t + 1) * forest.values]
                h = np.full(len(own), t + 64 * forest.shortest, dtype=np.uint64)
                for j in range(forest.shortest):
                    h = W.mix(h + own[:, j])
                labels = np.ascontiguousarray(own).tobytes()
                width = 2 * forest.values
                label = [labels[i * width : (i + 1) * width] for i in range(len(own))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_key(h, t)), rep, n, sig, pa.array(label, pa.binary())], names=["key", "rep", "n", "sig", "label"]
                )

    return run


def _met(batches) -> Iterator[pa.RecordBatch]:
    """Rows of crowded regions for each two blocks that meet, and for each block of many groups.

    Small groups of a region share ``mixed`` blocks; each of the ``large`` ones has its own.
    Blocks of one group do not meet.
    """
    for batch in batches:
        key, rep, root = (batch.column(c).to_numpy() for c in ("key", "rep", "root"))
        for k in np.unique(key).tolist():
            at = np.flatnonzero(key == k)
            mixed = batch.column("mixed")[int(at[0])].as_py()
            block = np.mod(W.mix(root[at].view(np.uint64)), np.uint64(max(1, mixed))).astype(np.int64)
            owner = [-1] * mixed
            for g in sorted(batch.column("large")[int(at[0])].as_py(), key=lambda g: g["root"]):
                mine = root[at] == g["root"]
                block[mine] = len(owner) + np.mod(W.mix(rep[at][mine].view(np.uint64)), np.uint64(g["parts"])).astype(np.int64)
                owner += [g["root"]] * g["parts"]
            group, pure = np.array(owner), np.arange(len(owner)) >= mixed
            for b in np.unique(block).tolist():
                others = np.flatnonzero(~(pure & pure[b] & (group == group[b])))
                if not len(others):
                    continue
                low, high = np.minimum(others, b), np.maximum(others, b)
                task = _key(W.mix(np.uint64(k % 2**64) + W.mix((low * len(owner) + high).astype(np.uint64))), k & 63)
                # Rows of two blocks are compared across, those of one block with each other.
                side = np.where(low == high, -1, (b == high).astype(np.int64))
                mine = batch.take(pa.array(np.repeat(at[block == b], len(others))))
                times = int((block == b).sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(task, times)),
                        *(mine.column(c) for c in ("rep", "n", "sig", "root", "key")),
                        pa.array(np.tile(side, times)),
                    ],
                    names=["key", "rep", "n", "sig", "root", "region", "side"],
                )


def _rows(key, rep, n, sig) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(rep, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())],
        names=["key", "rep", "n", "sig"],
    )


def _cut(table: pa.Table, least: int = 2) -> Iterator[dict[str, np.ndarray]]:
    """Regions of ``least`` rows or more of a table that holds them whole, one after another."""
    key = table.column("key").to_numpy()
    opens = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(opens, len(key)))
    many = size >= least
    if not many.any():
        return
    table = table.filter(pa.array(np.repeat(many, size)))
    cols = {c: _column(table.column(c)) for c in table.schema.names if c != "sig"}
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint64).reshape(-1, VALUES // 64)
    end = np.cumsum(size[many])
    for b, e in zip((end - size[many]).tolist(), end.tolist(), strict=True):
        yield {c: v[b:e] for c, v in cols.items()} | {"sig": sig[b:e]}


def _regions(batches) -> Iterator[dict[str, np.ndarray]]:
    """Regions of two rows or more, from rows sorted by key."""
    for r, _ in _pieces(batches, None):
        if len(r["rep"]) > 1:
            yield r


def _pieces(batches, limit: int | None) -> Iterator[tuple[dict[str, np.ndarray], bool]]:
    """Regions from sorted rows, and whether one surely is here as a whole.

    Single rows are left out where they are whole regions. With a ``limit`` the first and the
    last region of the task may go on in others, and larger regions come in pieces.
    """
    held: list[pa.RecordBatch] = []
    parted = limit is not None  # whether what is held began earlier

    def close(whole: bool) -> Iterator[tuple[dict[str, np.ndarray], bool]]:
        if held:
            for r in _cut(pa.Table.from_batches(held), 2 if whole else 1):
                yield r, whole
            held.clear()

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        if last is not None and key[0] != last:
            yield from close(not parted)
            parted = False
        last = key[-1]
        change = np.flatnonzero(key[1:] != key[:-1]) + 1
        if len(change):
            held.append(batch.slice(0, int(change[0])))
            yield from close(not parted)
            parted = False
            for r in _cut(pa.Table.from_batches([batch.slice(int(change[0]), int(change[-1] - change[0]))])):
                yield r, limit is None or len(r["rep"]) <= limit
            batch = batch.slice(int(change[-1]))
        held.append(batch)
        if limit is not None and sum(b.num_rows for b in held) > limit:
            parted = True
            yield from close(False)
    yield from close(limit is None)


def _column(column) -> np.ndarray:
    """Numbers as numbers; lists and bytes as objects."""
    if pa.types.is_integer(column.type):
        return column.to_numpy()
    out = np.empty(len(column), dtype=object)
    out[:] = [np.array(v, dtype=np.int64) if isinstance(v, list) else v for v in column.to_pylist()]
    return out


def _likely(r: dict[str, np.ndarray], i: int, percent: int) -> np.ndarray:
    """Equal bits of row i of a region with every row, 0 for those that are no candidates."""
    return _equal(r["sig"], r["sig"][i], r["n"], r["n"][i], percent) * (r["rep"] != r["rep"][i])


def _equal(sig, other, n, size, percent: int) -> np.ndarray:
    """Equal bits of signatures, 0 where these or the sizes of the sets rule a link out."""
    same = VALUES - np.bitwise_count(sig ^ other).sum(axis=1, dtype=np.int64)
    low, high = np.minimum(n, size), np.maximum(n, size)
    return np.where((100 * low >= percent * high) & (same >= LIKELY), same, 0)


def _apart(r: dict[str, np.ndarray], i: int) -> np.ndarray:
    """Rows of other groups that row i is to be compared with here."""
    return (r["root"] != r["root"][i]) & ((r["side"] != r["side"][i]) | (r["side"] < 0))


def _nearest(r: dict[str, np.ndarray], percent: int, forest: Orders) -> np.ndarray:
    """For each row of a region sorted by label its nearest candidate, or -1: the one with most
    equal bits among those with the longest prefix that has any."""
    m = len(r["rep"])
    partner = np.full(m, -1)
    labels = np.frombuffer(b"".join(r["label"]), dtype=">u2").reshape(m, forest.values)
    # Minima that each row shares with the row before it in the order.
    common = np.concatenate(([0], (np.cumprod(labels[1:] == labels[:-1], axis=1)).sum(axis=1)))
    for depth in range(forest.values, forest.shortest - 1, -1):
        if depth > forest.shortest and (common[1:] < depth).all():
            continue
        opens = np.flatnonzero(common < depth) if depth > forest.shortest else np.array([0])
        ends = np.append(opens[1:], m)
        for b, e in zip(opens.tolist(), ends.tolist(), strict=True):
            todo = b + np.flatnonzero(partner[b:e] < 0)
            if e - b < 2 or not len(todo):
                continue
            run = {c: r[c][b:e] for c in ("rep", "n", "sig")}
            for i in todo.tolist():
                same = _likely(run, i - b, percent)
                if same.any():
                    partner[i] = b + int(same.argmax())
    return partner


def _neighbours(percent: int, forest: Orders, limit: int):
    """Rows that have a candidate in their region, with the nearest one, and all rows of regions
    that are not here as a whole."""

    def run(batches):
        for r, whole in _pieces(batches, limit):
            partner = _nearest(r, percent, forest)
            at = np.flatnonzero(partner >= 0) if whole else np.arange(len(partner))
            if len(at):
                rows = _rows(r["key"][at], r["rep"][at], r["n"][at], [r["sig"][i].tobytes() for i in at])
                named = pa.array([int(r["rep"][p]) if p >= 0 else None for p in partner[at].tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([*rows.columns, named, pa.array(np.full(len(at), not whole))], names=[*rows.schema.names, "partner", "open"])

    return run


def _to_hubs(percent: int):
    """Candidate pairs of rows with the hubs of their regions."""

    def run(batches):
        for batch in batches:
            rep, hub, n, size = (batch.column(c).to_numpy() for c in ("rep", "hub", "n", "hub_n"))
            sig, own = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(-1, VALUES // 64) for c in ("sig", "hub_sig"))
            near = _equal(sig, own, n, size, percent) * (rep != hub) > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rep, hub)[near]), pa.array(np.maximum(rep, hub)[near])], names=["a", "b"])

    return run


def _open(percent: int):
    """Rows that have a candidate in another group."""

    def run(batches):
        for r in _regions(batches):
            if (r["root"] == r["root"][0]).all():
                continue
            at = [i for i in range(len(r["rep"])) if (_likely(r, i, percent)[_apart(r, i)] > 0).any()]
            if at:
                rows = _rows(r["key"][at], r["rep"][at], r["n"][at], [r["sig"][i].tobytes() for i in at])
                more = ["root", "region", "side"]
                yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(r[c][at]) for c in more)], names=[*rows.schema.names, *more])

    return run


def _settled(percent: int):
    """A link for each two groups of a region that a pair of candidates joins."""

    def run(batches):
        for r in _regions(batches):
            rep, root = r["rep"], r["root"]
            tree = int(r["key"][0]) & 63
            keys = -1 - np.arange(len(rep) * 64, dtype=np.int64).reshape(len(rep), 64)
            for i, own in enumerate(r["regions"]):
                keys[i, own & 63] = own
            sets = [_unpacked(x) for x in r["shingles"]]
            size = np.array([len(x) for x in sets])
            # Rows of each shingle, so that one pass counts what a row shares with all others.
            _, number = np.unique(np.concatenate(sets), return_inverse=True)
            held = np.split(number, np.cumsum(size)[:-1])
            order = np.argsort(number, kind="stable")
            rows = np.repeat(np.arange(len(sets)), size)[order]
            begin = np.concatenate(([0], np.cumsum(np.bincount(number))))
            group = {g: g for g in root.tolist()}

            def top(g: int, group=group) -> int:
                while group[g] != g:
                    group[g] = group[group[g]]
                    g = group[g]
                return g

            found: list[tuple[int, int]] = []
            for i in range(1, len(rep)):
                # A pair is compared in the first region that it shares.
                equal = keys[:i] == keys[i]
                at = np.flatnonzero((_likely(r, i, percent)[:i] > 0) & _apart(r, i)[:i] & (equal.argmax(axis=1) == tree))
                if not len(at):
                    continue
                first, count = begin[held[i]], begin[held[i] + 1] - begin[held[i]]
                shared = rows[np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
                both = np.bincount(shared, minlength=len(rep))[at]
                for j in at[100 * both >= percent * (size[at] + size[i] - both)].tolist():
                    a, b = top(int(root[i])), top(int(root[j]))
                    if a != b:
                        group[max(a, b)] = min(a, b)
                        found.append((int(rep[j]), int(rep[i])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found]), pa.array([f[1] for f in found])], names=["a", "b"])

    return run


def _packed(size: int):
    """Full shingle sets, 48 bits a shingle."""

    def run(batches):
        for batch in W.parts(batches):
            sets = []
            for s in shingle_sets(W.utf8(batch.column("text")), size):
                top = s >> np.uint64(16)
                sets.append(top.view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.binary())],
                names=["rep", "shingles"],
            )

    return run


def _unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _confirmed(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                s = np.sort(np.concatenate((_unpacked(x), _unpacked(y))))
                both = int((s[1:] == s[:-1]).sum())
                keep.append(100 * both >= percent * (len(s) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def _by_key(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "key").sortWithinPartitions("key")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    # The plan of a large run at every size, so that small runs tell what large ones need.
    return pairs.hint("merge").join(left, "a").hint("merge").join(right, "b").mapInArrow(_confirmed(percent), "a long, b long")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Groups of documents linked by a shingle similarity of ``percent`` or more.

    One row per row of ``docs(doc_id, text, ...)``: ``doc_id, n_shingles, component_id, kept``.
    A-Z are lowered; words are runs of bytes other than space and 0x09-0x0D; the set is the
    distinct shingles of ``shingle`` words, or the whole text as one if it has fewer. Null and
    empty texts and texts without words have an empty set and link with nothing. A row
    without doc_id is a group of its own with a null component_id, and kept. Rows that
    repeat a doc_id are in one component, whatever their texts, and all are kept if that id is
    its smallest. Other columns are ignored, whatever their names. An empty table gives no
    rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    signed = written(rows.mapInArrow(_signed(shingle), _SIGNED), "signatures")
    sets_key = ["set_a", "set_b", "n_shingles"]
    # Rows of one id may be of several classes; these share the id that stands for them.
    known = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = written(
        known.groupBy(*sets_key).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("minima").alias("minima")), "classes"
    )
    held = known.select("doc_id", *sets_key).join(classes.select(*sets_key, "rep"), sets_key)
    of_id = held.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z")
    links = held.join(of_id, "doc_id").select("a", F.col("rep").alias("b")).filter("a <> b")

    signs = classes.select("rep", "n_shingles", "sig", "minima")
    for forest in FORESTS:
        links, crowd = _searched(signs, rows, links, forest, shingle, percent)
        if crowd is None:
            break
        signs = written(signs.join(crowd.select("rep").distinct(), "rep", "left_semi"), "crowd")
    roots = components(links).withColumnRenamed("id", "rep")

    class_roots = (
        classes.select(*sets_key, "rep").join(roots, "rep", "left").select(*sets_key, F.coalesce("root", "rep").alias("found"))
    )
    found = signed.select("doc_id", *sets_key).join(class_roots, sets_key, "left")
    # A row without words is in the component of other rows of its id.
    wordless = found.filter("n_shingles = 0 and doc_id is not null").select("doc_id").distinct()
    beside = found.filter("n_shingles > 0").join(wordless, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("found").alias("other"))
    component = F.coalesce("found", "other", "doc_id")
    return (
        found.join(beside, "doc_id", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def _with_key(rows: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows with one row a key, spread over salts, as a key may hold very many rows."""
    spread = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).join(spread, ["key", "_salt"], how).drop("_salt")


def _searched(signs: DataFrame, rows: DataFrame, links: DataFrame, forest: Orders, shingle: int, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Links that join the same groups as ``links`` and those a forest over ``signs`` finds, and
    the rows of its crowded regions that remain in several groups, if any and if a deeper
    forest is left for them."""
    spark = signs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = REGION_ROWS
    ordered = signs.mapInArrow(_forest(forest), _FOREST).repartitionByRange(parts, "key", "label", "rep").sortWithinPartitions("key", "label", "rep")
    found = written(ordered.mapInArrow(_neighbours(percent, forest, limit), _FOUND), "neighbours")
    named = found.filter("partner is not null").select(F.least("rep", "partner").alias("a"), F.greatest("rep", "partner").alias("b"))
    sizes = found.filter("open").groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > limit).select("key")
    crowded = not sizes.isEmpty()
    if crowded:
        crowd = written(_with_key(found.select("key", "rep", "n", "sig"), sizes), "crowd")
        named = named.unionByName(_with_key(crowd, _hubs(crowd, named)).mapInArrow(_to_hubs(percent), "a long, b long"))
    pairs = written(named.distinct(), "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = _sets(rows, needed, shingle)
    roots = components(links.unionByName(_confirm(pairs, sets, percent))).withColumnRenamed("id", "rep")

    rooted = (
        found.select("key", "rep", "n", "sig")
        .join(roots, "rep", "left")
        .select("key", "rep", "n", "sig", F.coalesce("root", "rep").alias("root"), F.col("key").alias("region"), F.lit(-1).cast("long").alias("side"))
    )
    if crowded:
        rooted = written(rooted, "rooted")
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m")).filter("low < high")
    rooted = _with_key(rooted, several.select("key", "m"))
    blocked = None
    if crowded:
        left = written(rooted.filter(F.col("m") > limit).select("key", "rep", "n", "sig", "root"), "crowd")
        rooted = rooted.filter(F.col("m") <= limit)
        if not left.isEmpty():
            if forest is FORESTS[-1]:
                rooted = rooted.drop("m").unionByName(_with_key(left, _layout(left, limit // 2)).mapInArrow(_met, _MEETING))
            else:
                blocked = left
    unsettled = written(_by_key(rooted.drop("m"), parts).mapInArrow(_open(percent), _MEETING), "unsettled")
    # Rows that no neighbour has named.
    missing = unsettled.select("rep").distinct().join(needed, "rep", "left_anti")
    if not missing.isEmpty():
        sets = sets.unionByName(_sets(rows, missing, shingle))
    regions_of = unsettled.groupBy("rep").agg(F.collect_set("region").alias("regions"))
    settled = _by_key(unsettled.join(regions_of, "rep").hint("merge").join(sets, "rep"), parts).mapInArrow(_settled(percent), "a long, b long")
    return roots.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(settled), blocked


def _sets(rows: DataFrame, reps: DataFrame, shingle: int) -> DataFrame:
    """Full sets of the given documents."""
    return written(
        rows.join(reps.withColumnRenamed("rep", "doc_id"), "doc_id")
        .mapInArrow(_packed(shingle), "rep long, shingles binary")
        .distinct(),
        "shingles",
    )


def _hubs(crowd: DataFrame, named: DataFrame) -> DataFrame:
    """The row of each crowded region that most rows name as partner."""
    votes = named.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("votes"))
    hub = F.max_by(F.struct("rep", "n", "sig"), F.struct("votes", -F.col("rep"))).alias("hub")
    return crowd.join(votes, "rep").groupBy("key").agg(hub).select(
        "key", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.sig").alias("hub_sig")
    )


def _layout(crowd: DataFrame, size: int) -> DataFrame:
    """Blocks of each crowded region: of its small groups together, and of each large group."""
    blocks = lambda n: F.ceil(n / size).cast("long")
    groups = crowd.groupBy("key", "root").agg(F.count("*").alias("m"))
    return groups.groupBy("key").agg(
        blocks(F.coalesce(F.sum(F.when(F.col("m") <= size, F.col("m"))), F.lit(0))).alias("mixed"),
        F.collect_list(F.when(F.col("m") > size, F.struct("root", blocks(F.col("m")).alias("parts")))).alias("large"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of smallest id of each near-duplicate group; columns as they are."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    dropped = near_groups(docs).filter("not kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_id"], "left_anti").select(*names)

"""Trie of conversation prefixes by van Emde Boas recursion.

A sequence of turns is cut at half the height of the trie. The part above the cut is named by
a fingerprint of the node it hangs from and of its turns; sequences with the same name go
through the same node at the cut. Above the cuts lies the upper trie, below each name a lower
trie, and both are cut again in the same way, side by side, down to single turns. As a name
needs only the sequence itself, no rows move for it: pages of 64 turns are cut inside a task,
and only the cuts between pages, which long conversations have, are joins of page fingerprints.

Then nodes are counted, and totals are grafted upward: tries of twice the height are made of
an upper one and its lower ones by adding the totals of each lower trie to the nodes on the
way to the node it hangs from. That way is read from the page of any member of the node.

Fingerprints have 128 bits of SHA-256; different prefixes are taken to differ in them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import turns as T
from granary.llm.shared import written

PAGE = 64
ROOT = bytes(16)
SALTS = 64
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _name(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:16]


def _name_column(*parts: Column) -> Column:
    """``_name`` as a column; null where a part is."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def cut(top: bytes, turns: list[bytes], height: int, end: bytes | None) -> list[bytes]:
    """Name of the node after each of ``turns``, which hang from ``top`` in a trie of
    ``height``, a power of two. ``end`` names the last node of a sequence that fills it."""
    if not turns:
        return []
    if height == 1:
        return [end]
    half = height // 2
    if len(turns) < half:
        return cut(top, turns, half, None)
    middle = _name(top, _name(*turns[:half]))
    return cut(top, turns[:half], half, middle) + cut(middle, turns[half:], half, end)


def _page_prints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Fingerprints of full pages, which have ``size`` turns."""
    for batch in batches:
        prints = [_name(*t) if len(t) == size else None for t in batch.column("turns").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("page"), pa.array(prints, pa.binary())], names=["conv_id", "m", "print"])


def _page_names(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Names of the nodes along each page of ``size`` turns at most."""
    for batch in batches:
        names = []
        for turns, top, end in zip(*(batch.column(c).to_pylist() for c in ("turns", "top", "end")), strict=True):
            if len(turns) == size and end is None:
                end = _name(top, _name(*turns))
            names.append(cut(top, turns, size, end))
        kept = ["conv_id", "page", "top", "sizes"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(names, pa.list_(pa.binary()))], names=[*kept, "names"])


def _tops(pages: DataFrame) -> DataFrame:
    """The node that each page hangs from, and the name of a full page's last node where the
    cuts between pages give it: ``pages`` with ``top`` and ``end``."""
    root, none = F.lit(bytearray(ROOT)), F.lit(None).cast("binary")
    count = pages.agg(F.max("page")).first()[0]
    if not count:
        return pages.withColumns({"top": root, "end": none})
    long = pages.filter("page > 0").groupBy("conv_id").agg((F.max("page") + 1).alias("pages"))
    mine = written(pages.join(long, "conv_id").select("conv_id", "page", "turns"), "trie-long")
    prints = [written(mine.mapInArrow(partial(_page_prints, size=PAGE), "conv_id long, m long, print binary").filter("print is not null"), "trie-prints")]
    levels = int(count).bit_length()
    for _ in range(levels - 1):
        sides = [F.max(F.when(F.col("m") % 2 == side, F.col("print"))).alias(n) for side, n in enumerate(("left", "right"))]
        pairs = prints[-1].groupBy("conv_id", (F.col("m") / 2).cast("long").alias("m")).agg(*sides)
        joined = pairs.filter("left is not null and right is not null").select("conv_id", "m", _name_column(F.col("left"), F.col("right")).alias("print"))
        prints.append(written(joined, "trie-prints"))
    rows = long.select("conv_id", "pages", F.lit(0).cast("long").alias("m"), root.alias("top"), none.alias("end"))
    for level in reversed(range(levels)):
        above = prints[level].filter("m % 2 = 0").select("conv_id", (F.col("m") / 2).cast("long").alias("m"), "print")
        halved = rows.join(above, ["conv_id", "m"], "left").withColumn("cut", _name_column(F.col("top"), F.col("print")))
        second = F.col("m") * 2 + 1
        both = F.array(
            F.struct((second - 1).alias("m"), F.col("top"), F.col("cut").alias("end")),
            F.struct(second.alias("m"), F.col("cut").alias("top"), F.col("end")),
        )
        rows = written(
            halved.select("conv_id", "pages", F.explode(both).alias("h"))
            .select("conv_id", "pages", "h.*")
            .filter(F.col("top").isNotNull() & (F.col("m") * 2**level < F.col("pages"))),
            "trie-tops",
        )
    hung = pages.join(rows.select("conv_id", F.col("m").alias("page"), "top", "end"), ["conv_id", "page"], "left")
    return hung.withColumn("top", F.coalesce("top", root))


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the sorted ids of each name, read as they come."""
    name, digest = None, None
    out: list[tuple[bytes, str]] = []
    for batch in batches:
        for key, conv in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if key != name:
                if digest is not None:
                    out.append((name, digest.hexdigest()))
                name, digest = key, hashlib.sha256(b"%d" % conv)
            else:
                digest.update(b",%d" % conv)
        if len(out) > 10_000:
            yield _ends_batch(out)
            out = []
    if digest is not None:
        out.append((name, digest.hexdigest()))
    yield _ends_batch(out)


def _ends_batch(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["name", "ends_sha256"])


def _grafted(nodes: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """Totals of ``nodes(name, parent, depth, conv_id, leaves, saved)`` over their subtrees."""
    size = 1
    while size < height:
        mid = F.col("mid")
        lower = (
            nodes.filter((F.col("depth") - 1) % (2 * size) == size)
            .groupBy("parent")
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.min("conv_id").alias("conv_id"), (F.min("depth") - 1).alias("mid"))
            .withColumn("page", F.explode(F.sequence(((mid - size) / PAGE).cast("long"), ((mid - 1) / PAGE).cast("long"))))
        )
        first = F.when(F.lit(size < PAGE), (mid - 1) % PAGE - size + 2).otherwise(1).cast("int")
        way = F.explode(F.slice("names", first, min(size, PAGE))).alias("name")
        added = (
            lower.join(paths.select("conv_id", "page", "names"), ["conv_id", "page"])
            .select(way, "leaves", "saved")
            .groupBy("name")
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        total = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
        nodes = written(
            nodes.join(added, "name", "left").select("name", "parent", "depth", "conv_id", total("leaves"), total("saved")), "trie-totals"
        )
        size *= 2
    return nodes


def prefix_trie(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes of the trie over ``sequences(conv_id, depth, turn, size)``: the turns of each
    conversation by depth from 1, without gaps, ``turn`` a 16-byte fingerprint and ``size``
    its bytes. ``members(conv_id)`` has each conversation once, also those without turns.

    Returns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``, one row a node, the root included unless there are no members.
    """
    slot = (F.col("depth") - 1) % PAGE
    listed = F.sort_array(F.collect_list(F.struct(slot.alias("slot"), "turn", "size")))
    pages = written(
        sequences.groupBy("conv_id", ((F.col("depth") - 1) / PAGE).cast("long").alias("page"))
        .agg(listed.alias("t"))
        .select("conv_id", "page", F.col("t.turn").alias("turns"), F.col("t.size").alias("sizes")),
        "trie-pages",
    )
    paths = written(
        _tops(pages).mapInArrow(partial(_page_names, size=PAGE), "conv_id long, page long, top binary, sizes array<long>, names array<binary>"), "trie-paths"
    )

    above = F.concat(F.array("top"), F.slice("names", 1, F.greatest(F.size("names") - 1, F.lit(1))))
    steps = paths.select("conv_id", "page", F.posexplode(F.arrays_zip("names", above.alias("above"), "sizes")).alias("at", "s"))
    inner = (
        steps.select("conv_id", F.col("s.names").alias("name"), F.col("s.above").alias("parent"), (F.col("page") * PAGE + F.col("at") + 1).alias("depth"), F.col("s.sizes").alias("size"))
        .filter("name is not null")
        .groupBy("name")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("size").alias("size"))
    )
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        F.lit(bytearray(ROOT)).alias("name"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size")
    )
    nodes = written(inner.unionByName(root), "trie-nodes")
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(kids, "name", "left").fillna(0, ["n_children"]), "trie-nodes")

    height = nodes.agg(F.max("depth")).first()[0] or 0
    own = nodes.filter("depth > 0").select(
        "name", "parent", "depth", "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved")
    )
    totals = _grafted(own, paths, height)
    whole = totals.filter("depth = 1").agg(F.coalesce(F.sum("leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))
    sums = totals.select("name", "leaves", "saved").unionByName(whole.select(F.lit(bytearray(ROOT)).alias("name"), "leaves", "saved"))

    # A node may have very many children: its id reaches them over salted rows.
    salt = F.pmod(F.xxhash64("name"), F.lit(SALTS)).alias("salt")
    parents = (
        nodes.select("parent", salt).distinct()
        .join(nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    )
    last = paths.groupBy("conv_id").agg(F.max(F.struct("page", F.element_at("names", -1).alias("name"))).alias("e")).select("conv_id", "e.name")
    ends = members.join(last, "conv_id", "left").select(F.coalesce("name", F.lit(bytearray(ROOT))).alias("name"), "conv_id")
    ended = ends.repartition("name").sortWithinPartitions("name", "conv_id").mapInArrow(_end_digests, "name binary, ends_sha256 string")
    return (
        nodes.withColumn("salt", salt)
        .join(parents, ["parent", "salt"], "left")
        .join(sums, "name")
        .join(ended, "name", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
        )
    )


def fingerprinted(conversations: DataFrame) -> DataFrame:
    """Turns with the fingerprint of role and text and the bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    both = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumns({"print": F.unhex(F.substring(F.sha2(both, 256), 1, 32)), "size": F.octet_length("text").cast("long")})


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Trie of ``conversations(conv_id, turn, role, text, ...)`` as they are; see ``prefix_trie``.

    Turns are ordered by turn (null first), then role and text, which decides ties and tells
    nothing apart that is equal. Null roles and texts count as empty. Rows without a conv_id
    belong to no conversation and take no part. Repeated rows are turns of their own. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    rows, counts = T.numbered(fingerprinted(conversations), "print", "size")
    return prefix_trie(rows.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("print").alias("turn"), "size"), counts.select("conv_id"))


def forked_trie(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Trie of conversations rebuilt as forks: c takes the first h turns of conversation
    c - c % ``family`` in place of its own first h, h = crc32(c as text) % ``most``.

    Rows and nulls are as in ``conversation_trie``; c % family has the sign of c. A
    conversation left without turns is a member of the root.
    """
    rows, counts = T.numbered(fingerprinted(conversations), "print", "size")
    rows = rows.select("conv_id", "pos", F.col("print").alias("turn"), "size")
    lengths = written(counts, "trie-lengths")
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    h = (F.crc32(F.col("conv_id").cast("string")) % most).alias("h")
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    forks = written(
        lengths.select("conv_id", base, h).join(bases, "base", "left")
        .select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")),
        "trie-forks",
    )
    begun = (
        forks.filter("taken > 0")
        .join(rows.filter((F.col("pos") < most) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base"), "base")
        .filter("pos < taken")
        .select("conv_id", (F.col("pos") + 1).alias("depth"), "turn", "size")
    )
    own = rows.join(forks, "conv_id").filter("pos >= h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "turn", "size")
    return prefix_trie(begun.unionByName(own), forks.select("conv_id"))

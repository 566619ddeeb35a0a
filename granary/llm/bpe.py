"""Byte-level BPE of whole texts by overlapping chunks, and back.

A text longer than a chunk is cut into chunks that overlap. Chunks are split into pre-tokens
in parallel. A chunk may begin inside a pre-token, but what follows a boundary does not
depend on what stands before it; so where two chunks have a boundary in common inside their
overlap they agree from there on, and the text may be cut there. The pieces between such
cuts are then encoded in parallel. Chunks that share no boundary stay in one piece. Shorter
texts are one chunk and are encoded where they are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import tokens
from granary.llm import words as W
from granary.llm.shared import written

#: Characters of a chunk beside its overlap with the next, and of the overlap.
CHUNK, OVERLAP = 32_768, 1_024
#: Ids that are decoded together.
_DECODED = 400_000
#: The pattern looks at most so far beyond a match.
_AHEAD = 4

_PRETOKEN = regex.compile(PATTERN)
_CHUNKS = "row long, chunk long, text string"
_EDGES = "row long, chunk long, head array<long>, tail array<long>, sure boolean"


def _chunked(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for k, begin in enumerate(range(0, max(len(text), 1), chunk)):
                    yield pa.RecordBatch.from_pydict(
                        {"row": [row], "chunk": pa.array([k], pa.int64()), "text": [text[begin : begin + chunk + overlap]]}
                    )

    return run


def _edges(chunk: int, overlap: int):
    """Boundaries of pre-tokens in the overlaps at the head and the tail of a chunk."""

    def run(batches):
        for batch in batches:
            head, tail, sure = [], [], []
            for k, text in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # What touches the end of the chunk may go on behind it, and white space at
                # the end of a piece would be split in another way than inside the text.
                ends = [m.end() for m in _PRETOKEN.finditer(text)]
                known = [e for e in ends if e <= len(text) - _AHEAD and not text[e - 1].isspace()]
                head.append([k * chunk + e for e in known if e <= overlap])
                tail.append([k * chunk + e for e in known if e > chunk])
                # A space before something else is a boundary whatever stands before it.
                sure.append(k == 0 or regex.search(r" \S", text[:chunk]) is not None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64())), pa.array(sure, pa.bool_())],
                names=["row", "chunk", "head", "tail", "sure"],
            )

    return run


def _stitched(table: pa.Table) -> pa.Table:
    """Places where the text of a row may be cut: the first boundary two chunks agree on."""
    edges = sorted(table.to_pylist(), key=lambda e: e["chunk"])
    cuts, agrees = [], True
    for left, right in zip(edges, edges[1:], strict=False):
        common = set(left["tail"]) & set(right["head"]) if agrees or left["sure"] else set()
        agrees = bool(common)
        if common:
            cuts.append(min(common))
    return pa.table({"row": [edges[0]["row"]], "cuts": pa.array([cuts], pa.list_(pa.int64()))})


def _pieces(batches):
    for batch in batches:
        for row, text, cuts in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "cuts")), strict=True):
            for k, (begin, end) in enumerate(zip([0, *cuts], [*cuts, len(text)], strict=True)):
                yield pa.RecordBatch.from_pydict({"row": [row], "chunk": pa.array([k], pa.int64()), "text": [text[begin:end]]})


def _encoded(path: str, keep: list[str]):
    def run(batches):
        encoder = tokens.encoder(path)
        for batch in W.parts(batches):
            found = [encoder.encode(t or "") for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(x) // encoder.kind.itemsize for x in found)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(found), dtype=encoder.kind).astype(np.int32))
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), ids)], names=[*keep, "ids"])

    return run


def _gathered(table: pa.Table) -> pa.Table:
    ordered = table.sort_by("chunk")
    ids = [x for part in ordered.column("ids").to_pylist() for x in part]
    return pa.table({"doc_id": ordered.column("doc_id").slice(0, 1), "ids": pa.array([ids], pa.list_(pa.int32()))})


def encode_texts(docs: DataFrame, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids`` for each row of ``docs(doc_id, text, ...)``.

    The ids are those of the rank file ``vocabulary`` for the whole text, without special
    tokens, whose strings are ordinary text. Null and empty texts have no ids. Null and
    repeated ids are encoded like others. Texts of any length are encoded whole. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    long_text = F.char_length("text") > chunk
    short = rows.filter(F.coalesce(~long_text, F.lit(True))).mapInArrow(
        _encoded(vocabulary, ["doc_id"]), "doc_id long, ids array<int>"
    )
    held = written(rows.filter(long_text).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = (
        held.select("row", "text")
        .mapInArrow(_chunked(chunk, overlap), _CHUNKS)
        .repartition(parts, "row", "chunk")
        .mapInArrow(_edges(chunk, overlap), _EDGES)
        .groupBy("row")
        .applyInArrow(_stitched, "row long, cuts array<long>")
    )
    pieces = (
        held.select("row", "text")
        .join(cuts, "row")
        .mapInArrow(_pieces, _CHUNKS)
        .repartition(parts, "row", "chunk")
        .mapInArrow(_encoded(vocabulary, ["row", "chunk"]), "row long, chunk long, ids array<int>")
    )
    whole = pieces.join(held.select("row", "doc_id"), "row").groupBy("row").applyInArrow(_gathered, "doc_id long, ids array<int>")
    return short.unionByName(whole)


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded(doc_id, ids)`` with ``decoded``, the bytes of the ids one after another."""

    def run(batches):
        table = tokens.token_bytes(vocabulary)
        sizes = np.array([len(t) for t in table], dtype=np.int64)
        begins, letters = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(table), dtype=np.uint8)
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy()
            full = np.cumsum(lengths.astype(np.int64))
            row = 0
            while row < batch.num_rows:
                done = full[row - 1] if row else 0
                stop = min(batch.num_rows, int(np.searchsorted(full, done + _DECODED)) + 1)
                part = batch.slice(row, stop - row)
                ids = part.column("ids").flatten().to_numpy()
                size = sizes[ids]
                places = np.arange(size.sum()) + np.repeat(begins[ids] - (np.cumsum(size) - size), size)
                ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], full[row:stop] - done))]
                data = pa.py_buffer(letters[places].tobytes())
                decoded = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), data])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded.cast(pa.binary())], names=[*part.schema.names, "decoded"])
                row = stop

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")

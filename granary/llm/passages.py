"""Removal of passages that an earlier document already has, with repeated-phrase automata.

A window is ``window`` consecutive words of one document. Documents are dealt to small
buckets by id. The steps:

1. *Phrases.* In every window one phrase of six words is picked, the one with the smallest
   hash, so windows with equal words pick the same phrase and neighbours mostly share one.
   Phrases and document ids go to phrase shards, where phrases seen in two documents stay.
   A task passes on two ids for a phrase that it sees more often, so that a passage of
   every third document does not gather anywhere.
2. *Confirmation.* Buckets send the words around those phrases to the shard of the phrase,
   which compares the words of windows, finds the first document of each, and answers each
   bucket that holds a later one with the passage and the first documents of its windows. The
   windows of a phrase that very many documents have go out one by one to the shards of their
   own words.
3. *Automata.* The confirmed passages of a bucket, from whatever document they come, are
   compiled to Aho-Corasick automata, a bounded number of patterns in each, and all documents
   of the bucket are streamed through them whole. An occurrence is a match of all words; its
   words are removed if the passage starts in a document with a smaller id.

So each document meets all confirmed passages that it can hold, and only these. Hashes say
where to look; every decision compares words. Text moves by document once and by repeated
passage twice; everything else is 64-bit numbers in blocks, so the shuffled rows are few.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from granary.llm import words as W
from granary.llm.shared import written

WINDOW = 13
PHRASE = 6
#: Bytes of text in a bucket and in the share of a phrase shard.
BUCKET_BYTES = 2 << 20
SHARD_BYTES = 8 << 20
#: Most patterns of an automaton, and words it can tell apart: a word is two letters of 256,
#: the second of its own alphabet, because a node looks its children up one by one.
PATTERNS = 50_000
VOCABULARY = 256 * 256

#: A phrase is hot if it is in more than this share of all documents, and in so many at least.
#: As a document has as many phrases as it has words at most, there are at most this number
#: of hot phrases for each word of an average document.
HOT_SHARE, HOT_LEAST = 4096, 32_768

_OTHER = chr(1)
_HOT = -1
_PHRASES = "shard long, fixed boolean, phrase binary, doc binary, docs binary"
_HITS = "bucket long, phrase binary"
_SPANS = "shard long, bucket long, text binary, length binary, size binary, low binary, high binary"
_ANSWERS = "bucket long, text binary, length binary, size binary, first binary"
_RESULT = "doc_id long, kept_text string, n_words long, n_removed long, removed array<struct<start: long, stop: long>>"
_NONE = np.iinfo(np.int64).max


def _raw(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _joined(column, kind) -> np.ndarray:
    parts = [np.frombuffer(b, dtype=kind) for b in column.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, positions) for each key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    cuts = np.flatnonzero(np.diff(ordered)) + 1
    for at in np.split(order, cuts) if len(order) else ():
        yield int(keys[at[0]]), at


def _picked(words: W.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window: start, start of its phrase, hash of its phrase."""
    ok = words.starts(window)
    if not ok.any():
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, nothing.astype(np.uint64)
    size = min(PHRASE, window)
    grams = words.grams(size)
    best = grams[: len(ok)].copy()
    place = np.zeros(len(ok), dtype=np.int64)
    for j in range(1, window - size + 1):
        other = grams[j : j + len(ok)]
        less = other < best
        np.copyto(best, other, where=less)
        place[less] = j
    at = np.flatnonzero(ok)
    return at, at + place[at], best[at]


def _ids(column) -> np.ndarray:
    """Document ids; a null is given an id of its own that nothing is compared with."""
    return column.fill_null(_NONE).to_numpy(zero_copy_only=False)


def _phrase_blocks(shards: int, window: int):
    def run(batches):
        for batch in W.parts(batches):
            ids = _ids(batch.column("doc_id"))
            words = W.hashed(W.utf8(batch.column("text")))
            at, place, _ = _picked(words, window)
            if not len(at):
                continue
            place = np.unique(place)
            doc = ids[words.text_of()[place]]
            place, doc = place[doc != _NONE], doc[doc != _NONE]
            phrase = words.grams(min(PHRASE, window))[place]
            order = np.lexsort((doc, phrase))
            phrase, doc = phrase[order], doc[order]
            new = np.concatenate(([True], (phrase[1:] != phrase[:-1]) | (doc[1:] != doc[:-1])))[: len(phrase)]
            phrase, doc = phrase[new], doc[new]
            if not len(phrase):
                continue
            opens = np.concatenate(([True], phrase[1:] != phrase[:-1]))
            ends = np.concatenate((opens[1:], [True]))
            inner = ~(opens | ends)
            docs = np.zeros(len(phrase), dtype=np.uint32)
            docs[opens] = np.diff(np.append(np.flatnonzero(opens), len(phrase)))
            shard = (phrase % np.uint64(shards)).astype(np.int64)
            # Ids between the first and the last of a phrase need no other proof that it repeats.
            for fixed, mine in ((False, np.flatnonzero(~inner)), (True, np.flatnonzero(inner))):
                spread = shard[mine] if not fixed else (W.mix(doc[mine].view(np.uint64)) % np.uint64(shards)).astype(np.int64)
                rows = [(k, mine[at]) for k, at in _split(spread)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k for k, _ in rows], pa.int64()),
                            pa.array([fixed] * len(rows)),
                            pa.array([_raw(phrase[a]) for _, a in rows], pa.binary()),
                            pa.array([_raw(doc[a]) for _, a in rows], pa.binary()),
                            pa.array([b"" if fixed else _raw(docs[a]) for _, a in rows], pa.binary()),
                        ],
                        names=["shard", "fixed", "phrase", "doc", "docs"],
                    )

    return run


def _repeated(buckets: int, hot: int):
    """Phrases of two documents for the buckets that hold them, and, for the bucket _HOT, those
    of more than ``hot`` documents."""

    def run(table: pa.Table) -> pa.Table:
        fixed = table.column("fixed")
        known = table.filter(fixed)
        new = table.filter(pa.compute.invert(fixed))
        phrase, doc = _joined(new.column("phrase"), np.uint64), _joined(new.column("doc"), np.int64)
        docs = _joined(new.column("docs"), np.uint32)
        order = np.lexsort((doc, phrase))
        phrase, doc, docs = phrase[order], doc[order], docs[order].astype(np.int64)
        opens = np.flatnonzero(np.concatenate(([True], phrase[1:] != phrase[:-1]))) if len(phrase) else np.zeros(0, np.int64)
        size = np.diff(np.append(opens, len(phrase)))
        low, high = doc[opens], doc[opens + size - 1] if len(opens) else doc[opens]
        crowded = phrase[opens][np.add.reduceat(docs, opens) > hot] if len(opens) else phrase
        many = np.repeat(low < high, size)
        phrase = np.concatenate((phrase[many], _joined(known.column("phrase"), np.uint64)))
        doc = np.concatenate((doc[many], _joined(known.column("doc"), np.int64)))
        rows = [(k, np.unique(phrase[a])) for k, a in _split(np.mod(W.spark_hash(doc), buckets))] if len(doc) else []
        rows += [(_HOT, crowded)] if len(crowded) else []
        return pa.table(
            {"bucket": pa.array([k for k, _ in rows], pa.int64()), "phrase": pa.array([_raw(p) for _, p in rows], pa.binary())}
        )

    return run


def _spans(words: W.Words, window: int) -> dict[str, np.ndarray]:
    """Runs of windows that share one picked phrase: first window, windows, phrase."""
    at, place, phrase = _picked(words, window)
    if not len(at):
        return {"at": at, "size": at, "phrase": phrase}
    opens = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))))
    return {"at": at[opens], "size": np.diff(np.append(opens, len(at))), "phrase": phrase[opens]}


def _steps(size: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _texts(column, lengths) -> list[bytes]:
    """Texts of blocks, each block's joined in one value beside their lengths."""
    out: list[bytes] = []
    for data, sizes in zip(column.to_pylist(), lengths.to_pylist(), strict=True):
        ends = np.cumsum(np.frombuffer(sizes, dtype=np.uint32)).tolist()
        out += [data[b:e] for b, e in zip([0, *ends], ends, strict=False)]
    return out


def _lengths(texts: list[bytes]) -> bytes:
    return _raw(np.array([len(t) for t in texts], dtype=np.uint32))


def _span_blocks(shards: int, window: int, hot: np.ndarray):
    def run(key, docs: pa.Table, hits: pa.Table) -> Iterator[pa.RecordBatch]:
        wanted = np.unique(_joined(hits.column("phrase"), np.uint64))
        if not len(wanted):
            return
        # Words of each run, and of each window of a hot phrase: windows, shard, first and last document.
        found: dict[bytes, list[int]] = {}
        ids, texts = _ids(docs.column("doc_id")), W.utf8(docs.column("text"))
        for part in W.sliced(texts):
            # Words one blank apart, so that equal words are equal bytes.
            plain = [b" ".join((t or b"").split()) for t in texts[part]]
            words, data = W.hashed(plain), b"\n".join(plain)
            spans = _spans(words, window)
            if not len(spans["at"]):
                continue
            owner = words.text_of()[spans["at"]]
            near = np.minimum(np.searchsorted(wanted, spans["phrase"]), len(wanted) - 1)
            mine = np.flatnonzero((wanted[near] == spans["phrase"]) & (ids[part][owner] != _NONE))
            grams = words.grams(window)
            single = np.isin(spans["phrase"][mine], hot)
            ends = np.append(words.places[1:], len(data) + 1) - 1
            ends[words.bounds[1:][words.counts > 0] - 1] = (np.cumsum([len(t) + 1 for t in plain]) - 1)[words.counts > 0]
            begin, stop = words.places.tolist(), ends.tolist()
            columns = (spans["at"], spans["size"], (spans["phrase"] % np.uint64(shards)).astype(np.int64), ids[part][owner])
            for at, size, shard, doc, one in zip(*(c[mine].tolist() for c in columns), single.tolist(), strict=True):
                if one:
                    runs = [(data[begin[at + j] : stop[at + j + window - 1]], 1, int(grams[at + j] % np.uint64(shards))) for j in range(size)]
                else:
                    runs = [(data[begin[at] : stop[at + size + window - 2]], size, shard)]
                for text, n, k in runs:
                    held = found.get(text)
                    if held is None:
                        found[text] = [n, k, doc, doc]
                    else:
                        held[2], held[3] = min(held[2], doc), max(held[3], doc)
        if not found:
            return
        runs = list(found)
        facts = np.array(list(found.values()), dtype=np.int64)
        bucket = key[0].as_py()
        for k, a in _split(facts[:, 1]):
            block = [runs[i] for i in a.tolist()]
            size, low, high = (_raw(facts[a, c].astype(kind)) for c, kind in ((0, np.uint8), (2, np.int64), (3, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int64()), pa.array([bucket], pa.int64()), *(pa.array([x], pa.binary()) for x in (b"".join(block), _lengths(block), size, low, high))],
                names=["shard", "bucket", "text", "length", "size", "low", "high"],
            )

    return run


def _firsts(window: int):
    """Passages of a shard with the first document of each of their windows, for the buckets
    that hold them in a later one."""

    def run(table: pa.Table) -> pa.Table:
        texts = _texts(table.column("text"), table.column("length"))
        size = _joined(table.column("size"), np.uint8).astype(np.int64)
        low, high = _joined(table.column("low"), np.int64), _joined(table.column("high"), np.int64)
        counts = [len(b) for b in table.column("size").to_pylist()]
        bucket = np.repeat(np.asarray(table.column("bucket").to_numpy()), counts)
        # Equal passages of several buckets are one.
        number: dict[bytes, int] = {}
        passage = np.array([number.setdefault(t, len(number)) for t in texts], dtype=np.int64)
        own, start = np.zeros(len(number), np.int64), np.full(len(number), _NONE)
        own[passage] = size
        np.minimum.at(start, passage, low)
        # A window whose hash no other passage has starts first where its passage does.
        distinct = list(number)
        words = W.hashed(distinct)
        begin = np.cumsum(own) - own
        prints = words.grams(window)[np.repeat(words.bounds[:-1], own) + _steps(own)] if len(own) else np.zeros(0, np.uint64)
        _, group, times = np.unique(prints, return_inverse=True, return_counts=True)
        earliest = np.repeat(start, own)
        at = np.flatnonzero(times[group] > 1)
        # Of others, equal words and not equal hashes make windows one.
        owner = np.repeat(np.arange(len(own)), own)[at]
        names: dict[bytes, int] = {}
        name, last, split = np.zeros(len(at), dtype=np.int64), -1, []
        for i, (p, j) in enumerate(zip(owner.tolist(), (at - begin[owner]).tolist(), strict=True)):
            if p != last:
                last, split = p, distinct[p].split(b" ")
            name[i] = names.setdefault(b" ".join(split[j : j + window]), len(names))
        least = np.full(len(names), _NONE)
        np.minimum.at(least, name, start[owner])
        earliest[at] = least[name]
        first = earliest[np.repeat(begin[passage], size) + _steps(size)]
        first = np.where(first < np.repeat(high, size), first, _NONE)
        begin = np.cumsum(size) - size
        needed = np.flatnonzero(np.logical_or.reduceat(first != _NONE, begin)) if len(size) else np.zeros(0, np.int64)
        rows = [(k, needed[a]) for k, a in _split(bucket[needed])] if len(needed) else []
        of = lambda a: first[np.repeat(begin[a], size[a]) + _steps(size[a])]
        blocks = [[texts[i] for i in a.tolist()] for _, a in rows]
        return pa.table(
            {
                "bucket": pa.array([k for k, _ in rows], pa.int64()),
                "text": pa.array([b"".join(b) for b in blocks], pa.binary()),
                "length": pa.array([_lengths(b) for b in blocks], pa.binary()),
                "size": pa.array([_raw(size[a].astype(np.uint8)) for _, a in rows], pa.binary()),
                "first": pa.array([_raw(of(a)) for _, a in rows], pa.binary()),
            }
        )

    return run


def _patterns(answers: pa.Table) -> Iterator[tuple[list[bytes], list[int]]]:
    """Words of each confirmed passage, and the first document of its windows."""
    first, at = _joined(answers.column("first"), np.int64).tolist(), 0
    sizes = _joined(answers.column("size"), np.uint8).tolist()
    for text, size in zip(_texts(answers.column("text"), answers.column("length")), sizes, strict=True):
        yield text.split(b" "), first[at : at + size]
        at += size


def _automata(patterns) -> Iterator[tuple[object, dict[bytes, str]]]:
    """Automata over words as pairs of letters; none has more than PATTERNS patterns."""
    letters: dict[bytes, str] = {}
    automaton = ahocorasick.Automaton()
    for words, firsts in patterns:
        for w in words:
            if w not in letters:
                letters[w] = chr(256 + len(letters) // 256) + chr(512 + len(letters) % 256)
        automaton.add_word("".join([letters[w] for w in words]), firsts)
        if len(automaton) >= PATTERNS or len(letters) >= VOCABULARY - 1024:
            automaton.make_automaton()
            yield automaton, letters
            letters, automaton = {}, ahocorasick.Automaton()
    if len(automaton):
        automaton.make_automaton()
        yield automaton, letters


def _located(text: bytes, doc: int, automaton, letters: dict[bytes, str], window: int) -> Iterator[int]:
    """Starts of the windows of a text that an earlier document has."""
    codes = [letters.get(w, _OTHER) for w in text.split()]
    # A word outside the passages is one letter, so places are counted in letters first.
    found = [(end, firsts) for end, firsts in automaton.iter("".join(codes)) if min(firsts) < doc]
    if found:
        word_at = np.cumsum([len(c) for c in codes]) - 1
        for (_, firsts), last in zip(found, np.searchsorted(word_at, [end for end, _ in found]).tolist(), strict=True):
            at = last + 2 - window - len(firsts)
            yield from (at + j for j, first in enumerate(firsts) if first < doc)


def _removals(window: int, carried: list[str], as_is: bool):
    def run(key, docs: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        column = docs.column("doc_id")
        ids, texts = _ids(column), W.utf8(docs.column("text"))
        covered: dict[int, set[int]] = {}
        for automaton, letters in _automata(_patterns(answers)):
            for i, text in enumerate(texts):
                if text is not None and ids[i] != _NONE:
                    covered.setdefault(i, set()).update(_located(text, int(ids[i]), automaton, letters, window))
        for part in W.sliced(texts):
            kept, n_words, n_removed, spans = [], [], [], []
            for i in range(part.start, part.stop):
                words = (texts[i] or b"").split()
                n_words.append(len(words))
                runs: list[dict[str, int]] = []
                for at in sorted(covered.get(i, ())):
                    if runs and at <= runs[-1]["stop"]:
                        runs[-1]["stop"] = at + window
                    else:
                        runs.append({"start": at, "stop": at + window})
                for r in reversed(runs):
                    del words[r["start"] : r["stop"]]
                whole = as_is and not runs
                kept.append((texts[i] or b"" if whole else b" ".join(words)).decode())
                n_removed.append(n_words[-1] - len(words))
                spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [
                    column.slice(part.start, part.stop - part.start).combine_chunks(),
                    pa.array(kept, pa.string()),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    *(docs.column(c).slice(part.start, part.stop - part.start).combine_chunks() for c in carried),
                ],
                names=["doc_id", "kept_text", "n_words", "n_removed", "removed", *carried],
            )

    return run


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _cogrouped(run, schema: pa.Schema):
    def table(key, docs: pa.Table, other: pa.Table) -> pa.Table:
        return pa.Table.from_batches([b.cast(schema) for b in run(key, docs, other)] if docs.num_rows else [], schema)

    return table


def remove_repeated(
    docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = (), as_is: bool = False
) -> DataFrame:
    """``docs(doc_id, text, ...)`` without the passages that an earlier document has.

    Returns, for each row, ``doc_id, kept_text, n_words, n_removed, removed``: the words that
    stay joined by one space, and the removed word ranges (start, stop). A word goes if a
    window that covers it also starts in a document with a smaller doc_id; windows are those
    of the input. Words are runs of bytes other than space and 0x09-0x0D, unchanged. Null and
    empty texts have no words. A row without doc_id loses nothing and proves nothing. Rows
    that repeat a doc_id are one document for this rule, so they leave each other alone, and
    each is returned. Texts of any length are read whole. An empty table gives no rows.

    Columns named in ``carry`` are returned too; others are ignored, whatever their names.
    With ``as_is`` a text that loses nothing is returned as it is, blanks included.
    """
    size, n_docs = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("doc_id")).first()
    buckets, shards = (max(1, math.ceil(size / b)) for b in (BUCKET_BYTES, SHARD_BYTES))
    carried = [f"_carry{i}" for i in range(len(carry))]
    named = [F.col(f"`{c}`").alias(n) for c, n in zip(carry, carried, strict=True)]
    whole = docs.select(F.col("doc_id").cast("long"), "text", *named)
    known = whole.filter("doc_id is not null")
    dealt = known.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets).cast("long")))
    hits = written(
        known.select("doc_id", "text").mapInArrow(_phrase_blocks(shards, window), _PHRASES)
        .groupBy("shard")
        .applyInArrow(_repeated(buckets, max(HOT_LEAST, n_docs // HOT_SHARE)), _HITS),
        "phrases",
    )
    hot = [np.frombuffer(r["phrase"], dtype=np.uint64) for r in hits.filter(F.col("bucket") == _HOT).collect()]
    hot = np.unique(np.concatenate(hot)) if hot else np.zeros(0, dtype=np.uint64)
    answers = (
        dealt.groupBy("bucket")
        .cogroup(hits.filter(F.col("bucket") != _HOT).groupBy("bucket"))
        .applyInArrow(_cogrouped(_span_blocks(shards, window, hot), _arrow(_SPANS)), _SPANS)
        .groupBy("shard")
        .applyInArrow(_firsts(window), _ANSWERS)
    )
    schema = StructType([*StructType.fromDDL(_RESULT).fields, *dealt.select(*carried).schema.fields])
    removals, arrow = _removals(window, carried, as_is), to_arrow_schema(schema)
    result = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_cogrouped(removals, arrow), schema)

    none = pa.table({f.name: pa.array([], f.type) for f in _arrow(_ANSWERS)})

    def untouched(batches):
        for batch in W.parts(batches):
            for out in removals(None, pa.Table.from_batches([batch]), none):
                yield out.cast(arrow)

    # Rows without an id lose nothing: they are not gathered anywhere.
    result = result.unionByName(whole.filter("doc_id is null").mapInArrow(untouched, schema))
    own = [c for c in result.columns if c not in carried]
    return result.select(*own, *[F.col(n).alias(c) for c, n in zip(carry, carried, strict=True)])

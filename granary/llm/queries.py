"""The operators over whole test tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import bpe, exact_dedup, licenses, near_dedup, packing, passages, quality, repair, sharding, topk, toxicity, trie, vectors

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = _table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that stay once passages of earlier documents are removed."""
    return passages.remove_repeated(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP2_SQL = r"""
with texts as (
    select doc_id, [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as words
    from documents
),
windows as (
    select doc_id, p, array_to_string(words[p:p + 12], ' ') as g
    from (select doc_id, words, unnest(range(1, len(words) - 11)) as p from texts where len(words) >= 13)
),
firsts as (select g, min(doc_id) as f from windows group by g),
covered as (
    select distinct doc_id, p + k as at
    from (select w.doc_id, w.p, unnest(range(0, 13)) as k from windows w join firsts using (g) where f < w.doc_id)
),
words as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as at from texts),
kept as (
    select w.doc_id, string_agg(word, ' ' order by w.at) as body, count(*) as n
    from words w anti join covered c on w.doc_id = c.doc_id and w.at = c.at
    group by w.doc_id
)
select t.doc_id, cast(len(words) as bigint) as n_words,
       cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(body, '')) as kept_sha256
from texts t left join kept using (doc_id)
"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents, and the bytes that the ids give back."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_texts(_table(spark, sf_dir, "documents"), ranks)
    return bpe.decode_ids(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among whole documents, and the document that stays."""
    return near_dedup.near_groups(_table(spark, sf_dir, "documents"))


OP4_SQL = r"""
with texts as (
    select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as w
    from documents
),
shingles as (
    select distinct doc_id, array_to_string(w[p:p + 4], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as p from texts where len(w) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id
),
links as (
    select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * common.n >= 75 * (x.n + y.n - common.n)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
    with recursive r(a, b) as (
        select doc_id, doc_id from texts
        union
        select r.a, l.b from r join both_ways l on r.b = l.a
    )
    select a, min(b) as root from r group by a
)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, root as component_id, doc_id = root as kept
from texts left join sizes using (doc_id) join reach on reach.a = doc_id
"""


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of whole texts; the largest doc_id of a group stays."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


OP5_SQL = """
select doc_id,
       max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       cast(count(*) over (partition by coalesce(text, '')) as bigint) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards, counts at most one apart, in uniformly random order."""
    text = F.coalesce("text", F.lit(""))
    return sharding.shuffled_shards(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, seen as files in folders by source and language."""
    docs = _table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.lit("corpus"), "source", "lang", F.col("doc_id").cast("string"))
    found = licenses.licences(docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text"))
    return found.select(F.col("file").alias("doc_id"), "path", "licence", F.round("score", 6).alias("score"), "origin", "licence_file", F.array_join("licences", " ").alias("licences"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among embeddings of one label."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


OP8_SQL = """
with vectors as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
usable as (
    select * from vectors
    where vec_id is not null and label is not null and e is not null and len(e) > 0
      and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_inner_product(e, e) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b
    from usable a join usable b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.93
),
reach as (
    with recursive r(a, b) as (
        select vec_id, vec_id from vectors
        union
        select r.a, l.b from r join links l on r.b = l.a
    )
    select a, min(b) as root from r group by a
),
counts as (select a, count(*) as n from links group by a)
select vec_id, cast(coalesce(n, 0) as bigint) as n_links, root as component_id, vec_id = root as kept
from vectors join reach on reach.a = vec_id left join counts on counts.a = vec_id
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids, every window in the corpus's mixture."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best-scoring vectors for every fiftieth vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
pairs as (
    select q.vec_id as query_id, c.vec_id,
           cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) as bigint) as score
    from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place from pairs
)
select query_id, cast(place as int) as rank, vec_id, score from ranked where place <= 5
"""


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations, after damage."""
    return repair.repaired(repair.damaged(_table(spark, sf_dir, "conversations")))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, rebuilt as forks of every fifth one."""
    return trie.forked_trie(_table(spark, sf_dir, "conversations"))


def _crc32_sql(text: str) -> str:
    """zlib's CRC-32 of an ASCII text, bit by bit: DuckDB has no function for it."""
    byte = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda c: cast(ascii(c) as bigint))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {codes}), lambda crc, b: {byte}), 4294967295)"


OP12_SQL = rf"""
with recursive damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else coalesce(role, ' ') end as role,
           case when kind = 1 then '' when kind = 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text,
           unnest(case when kind = 3 then [1, 2] else [1] end) as copy
    from (
        select *, {_crc32_sql("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as kind
        from conversations
    )
    where kind <> 0
),
placed as (
    select conv_id, turn, role, text, left(role, 1) as initial,
           row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
           row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen
    from damaged
),
faulty as (
    select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when seen > 1 then 'duplicate'
                   when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault,
           lag(initial) over (partition by conv_id order by i) as before
    from placed
),
facts as (
    select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated,
           count(*) filter (i > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
    from faulty group by conv_id
),
-- States of the grammar: 0 for nothing yet, else the initial written last.
inserts(state, onto, dearer, letters, lines) as (
    values ('0', '0', 0, '', ''), ('0', 'u', 5, 'I', 'user:\n'), ('0', 'a', 10, 'II', 'user:\nassistant:\n'),
           ('s', 's', 0, '', ''), ('s', 'u', 5, 'I', 'user:\n'), ('s', 'a', 10, 'II', 'user:\nassistant:\n'),
           ('u', 'u', 0, '', ''), ('u', 'a', 5, 'I', 'assistant:\n'), ('u', 'u', 10, 'II', 'assistant:\nuser:\n'),
           ('a', 'a', 0, '', ''), ('a', 'u', 5, 'I', 'user:\n'), ('a', 'a', 10, 'II', 'user:\nassistant:\n')
),
edits(state, letter, onto) as (
    values ('0', 'D', '0'), ('s', 'D', 's'), ('u', 'D', 'u'), ('a', 'D', 'a'), ('0', 'K', 's'), ('0', 'K', 'u'), ('s', 'K', 'u'),
           ('u', 'K', 'a'), ('a', 'K', 'u'), ('0', 'R', 'u'), ('s', 'R', 'u'), ('u', 'R', 'a'), ('a', 'R', 'u')
),
walk as (
    select conv_id, 0 as i, '0' as state, 0 as cost, '' as audit, '' as lines from facts
    union all
    select conv_id, i, state, cost, audit, lines
    from (
        select w.conv_id, f.i, e.onto as state, w.audit || x.letters || e.letter as audit,
               w.cost + x.dearer + case e.letter when 'D' then 2 when 'R' then 1 else 0 end
                   + case when e.letter <> 'D' and f.fault = 'truncated' then 5 else 0 end as cost,
               w.lines || replace(x.lines, '\n', chr(10)) || case e.letter when 'D' then '' when 'K' then f.role || ':' || f.text || chr(10)
                   else case e.onto when 'u' then 'user' else 'assistant' end || ':' || f.text || chr(10) end as lines
        from walk w
        join faulty f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1
        join inserts x on x.state = w.state
        join edits e on e.state = x.onto
        where e.letter = 'D' or (f.fault not in ('blank', 'duplicate') and (e.letter = 'R' or f.initial = e.onto))
    )
    qualify row_number() over (partition by conv_id, state order by cost, audit) = 1
),
ends as (
    select w.conv_id, w.cost + x.dearer as cost, w.audit || x.letters as audit, w.lines || replace(x.lines, '\n', chr(10)) as lines
    from walk w
    join facts f on f.conv_id is not distinct from w.conv_id and f.n = w.i
    join inserts x on x.state = w.state
    where x.onto in ('0', 'a')
    qualify row_number() over (partition by w.conv_id order by w.cost + x.dearer, w.audit || x.letters) = 1
)
select c.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost,
       coalesce(audit, '') as audit, sha256(coalesce(left(lines, len(lines) - 1), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join facts f on f.conv_id is not distinct from c.conv_id
left join ends e on e.conv_id is not distinct from c.conv_id
"""


OP13_SQL = f"""
with turns as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
           strlen(role) || ':' || role || text as k, strlen(text) as size
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
),
convs as (
    select conv_id, count(*) as n, any_value({_crc32_sql("cast(conv_id as varchar)")}) % 9 as h from turns group by conv_id
),
forks as (
    select c.conv_id, c.conv_id - c.conv_id % 5 as base, c.h, least(c.h, coalesce(b.n, 0)) as taken
    from convs c left join convs b on b.conv_id = c.conv_id - c.conv_id % 5
),
rebuilt as (
    select f.conv_id, t.pos as depth, k, size from forks f join turns t on t.conv_id = f.base where t.pos <= f.taken
    union all
    select f.conv_id, f.taken + t.pos - f.h, k, size from forks f join turns t using (conv_id) where t.pos > f.h
),
paths as (
    select conv_id, depth, size, sha256(string_agg(k, chr(0)) over (partition by conv_id order by depth)) as node from rebuilt
    union all
    select conv_id, 0, 0, '' from convs
),
steps as (
    select *, lag(node) over (partition by conv_id order by depth) as above,
           depth = max(depth) over (partition by conv_id) as is_end
    from paths
),
nodes as (
    select depth, node, min(conv_id) as conv_id, min(above) as above, count(*) as n_convs, min(size) as size,
           coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (is_end), '') as ends
    from steps group by depth, node
),
kids as (select depth - 1 as depth, above as node, count(*) as n_children from nodes where depth > 0 group by 1, 2),
counted as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (depth, node)),
below as (
    select a.depth, a.node, sum(cast(c.n_children = 0 as bigint)) as n_leaves, sum((c.n_convs - 1) * c.size) as saved
    from counted c join steps a on a.conv_id = c.conv_id and a.depth <= c.depth
    group by 1, 2
)
select c.conv_id, cast(c.depth as bigint) as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children,
       cast(n_leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, sha256(c.ends) as ends_sha256
from counted c join below b using (depth, node) left join nodes p on p.depth = c.depth - 1 and p.node = c.above
"""


def registered() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_passages": op2_passages,
        "op3_bpe": op3_bpe,
        "op4_near_dedup": op4_near_dedup,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_sharding": op6_sharding,
        "op7_licenses": op7_licenses,
        "op8_vectors": op8_vectors,
        "op9_toxicity": op9_toxicity,
        "op10_packing": op10_packing,
        "op11_topk": op11_topk,
        "op12_repair": op12_repair,
        "op13_trie": op13_trie,
    }


def statements() -> dict[str, str]:
    return {"op2_passages": OP2_SQL, "op4_near_dedup": OP4_SQL, "op5_exact_dedup": OP5_SQL, "op8_vectors": OP8_SQL, "op11_topk": OP11_SQL, "op12_repair": OP12_SQL, "op13_trie": OP13_SQL}

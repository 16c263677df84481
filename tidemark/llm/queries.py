"""The registered queries of the text operators: (spark, sf_dir) -> DataFrame over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, conversations, html_extract, langid, packing, secret_scan, sharding, spelling, suffix_dedup, va_search
from tidemark.llm.common import table
from tidemark.llm.exact_dedup import DigestIndex
from tidemark.llm.simhash import near_components

Query = Callable[[SparkSession, str], DataFrame]

ENCODER = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch of a new digest index."""
    docs = table(spark, sf_dir, "documents")
    return DigestIndex.scratch(spark).assign(docs, "documents")


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id is divisible by 20."""
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word SimHash fingerprints differ in at most 3 bits."""
    found = near_components(table(spark, sf_dir, "documents"), words=3, turns=1, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"), ENCODER, packing.CAPACITY)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page; the text model is fitted on labelled documents."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    model = langid.train(table(spark, sf_dir, "documents"))
    return langid.page_languages(pages, model).drop("html")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    vocabulary = bpe.load_vocabulary(ENCODER[1], ENCODER[2])
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary)


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.main_text(pages, html_extract.train(pages))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that a document with a smaller id has."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), 50)


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards along a Hilbert curve through source, language and length."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        "lang",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size", "source", "lang"]
    placed = sharding.curve_shards(rows, ["source", "lang", "size"], 16, order)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form, the last form reached, and its counts."""
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the damage did to every conversation, and its cheapest repair."""
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_va_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 other vectors with the largest integer inner product of every vector whose id is divisible by 50."""
    return va_search.exact_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


REGISTRY: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_learned_partitions": op2_learned_partitions,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_language_id": op5_language_id,
    "op6_secret_scan": op6_secret_scan,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_html_extract": op8_html_extract,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_hilbert_shards": op10_hilbert_shards,
    "op11_spelling_groups": op11_spelling_groups,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_va_search": op13_va_search,
}

# CRC-32 in SQL: its table of 256 numbers by rule, and one step a byte.
CRC_TABLE = """
    select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
               case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc
"""
CRC = "xor(list_reduce([4294967295] || {octets}, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"
OCTETS = "list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::int + 1, 2))::bigint)"
ASCII_CODES = "list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"

SQL: dict[str, str] = {
    "op1_exact_dedup": """
        with d as (
            select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) as text_sha256
            from documents
        )
        select doc_id,
               max(doc_id) over w as keep_id,
               count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept,
               text_sha256
        from d
        window w as (partition by text_sha256)
    """,
    "op11_spelling_groups": f"""
        with recursive crc as ({CRC_TABLE}),
        runs as (
            select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[A-Za-z\u00C0-\u00FF]+')) as run
            from documents
        ), named as (
            select run, coalesce(doc_id::varchar, '') || ':' || run as name, count(*) as n from runs where length(run) >= 5 group by all
        ), hashed as (
            select run, n, {CRC.format(octets=OCTETS.format(text="name"))} as h from named, crc
        ), words as materialized (
            select case when h % 97 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(n)::bigint as n
            from hashed group by 1 having sum(n) >= 3 and length(word) >= 5
        ), shorter as (
            select word, n, cut, left(word, cut - 1) || substr(word, cut + 1) as rest
            from (select word, n, unnest(range(1, length(word) + 1)) as cut from words)
        ), near as (
            select a.word, b.word as other, b.n as m from shorter a join shorter b on a.cut = b.cut and a.rest = b.rest and a.word <> b.word
            union
            select a.word, b.word, b.n from shorter a join words b on a.rest = b.word
            union
            select b.word, a.word, a.n from shorter a join words b on a.rest = b.word
        ), best as (
            select word, count(*) as n_near, min({{'less': -m, 'form': other}}) as best from near group by word
        ), forms as materialized (
            select words.word, n, coalesce(n_near, 0) as n_near,
                   case when -best.less >= 2 * n then best.form end as form, case when -best.less >= 2 * n then -best.less end as form_n
            from words left join best on best.word = words.word
        ), chains(word, root, ahead) as (
            select word, word, form from forms
            union all
            select chains.word, forms.word, forms.form from chains join forms on forms.word = chains.ahead
        )
        select forms.word, form, root, n, n_near, form_n from forms join chains on chains.word = forms.word where chains.ahead is null
    """,
    "op12_conversation_repair": f"""
        with recursive crc as ({CRC_TABLE}),
        named as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
            from conversations
        ), kinds as (
            select named.*, {CRC.format(octets=ASCII_CODES.format(text="name"))} % 20 as kind from named, crc
        ), hurt as (
            select conv_id, turn, case when kind = 4 then 'user' else role end as role,
                   case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
                   unnest(case when kind = 3 then [0, 1] else [0] end) as copy
            from kinds where kind <> 0
        ), placed as (
            select *, row_number() over w as place,
                   row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as times,
                   lead(role) over w as follower
            from hurt
            window w as (partition by conv_id order by turn nulls first, role, text, copy)
        ), coded as (
            select *, left(role, 1) as initial,
                   case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
                        when times > 1 then 'duplicate'
                        when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 'truncated'
                        else '' end as fault
            from placed
        ), sums as (
            select conv_id, count(*) as n,
                   coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
                   count(*) filter (fault = 'blank') as blank,
                   count(*) filter (fault = 'duplicate') as duplicate,
                   count(*) filter (fault = 'truncated') as truncated,
                   count(*) filter (follower is not null and initial || left(follower, 1) not in ('su', 'ua', 'au')) as illegal
            from coded group by conv_id
        ), inserts(state, reached, lines) as (
            values ('-', '-', []::varchar[]), ('-', 'u', ['user:']), ('-', 'a', ['user:', 'assistant:']),
                   ('s', 's', []), ('s', 'u', ['user:']), ('s', 'a', ['user:', 'assistant:']),
                   ('u', 'u', []), ('u', 'a', ['assistant:']), ('a', 'a', []), ('a', 'u', ['user:'])
        ), steps(state, given, reached) as (
            values ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
        ), edits as (
            select conv_id, place, state, state as reached, 2 as cost, 'D' as letter, []::varchar[] as lines
            from coded, (select distinct state from inserts)
            union all
            select conv_id, place, state, reached, case when fault = '' then 0 else 5 end, 'K', [role || ':' || text]
            from coded join steps on given = initial where fault in ('', 'truncated')
            union all
            select conv_id, place, state, reached, case when fault = '' then 1 else 6 end, 'R',
                   [case given when 'u' then 'user' else 'assistant' end || ':' || text]
            from coded join steps on given <> 's' where fault in ('', 'truncated')
        ), paths(conv_id, place, state, best) as (
            select conv_id, n + 1, state, min({{'cost': 5 * len(lines), 'audit': repeat('I', len(lines)), 'lines': lines}})
            from sums, inserts where reached = 'a' or reached = '-' group by all
            union all
            select paths.conv_id, edits.place, inserts.state,
                   min({{'cost': best.cost + edits.cost + 5 * len(inserts.lines),
                        'audit': repeat('I', len(inserts.lines)) || letter || best.audit,
                        'lines': inserts.lines || edits.lines || best.lines}})
            from paths
            join edits on edits.conv_id is not distinct from paths.conv_id and edits.place = paths.place - 1 and edits.reached = paths.state
            join inserts on inserts.reached = edits.state
            group by paths.conv_id, edits.place, inserts.state
        ), solved as (
            select conv_id, best.cost::bigint as cost, best.audit, sha256(array_to_string(best.lines, chr(10))) as repaired_sha256
            from paths where place = 1 and state = '-'
        )
        select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
               coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
        from (select distinct conv_id from conversations) c
        left join sums on sums.conv_id is not distinct from c.conv_id
        left join solved on solved.conv_id is not distinct from c.conv_id
    """,
    "op13_va_search": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as ints
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id, list_dot_product(q.ints, c.ints)::bigint as score
            from v q join v c on q.vec_id <> c.vec_id
            where q.vec_id % 50 = 0
        ), ranked as (
            select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank
            from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
}

"""The registered query of each operator, with its check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from vitalgrid.llm import decontaminate, exact_dedup, fixity, langid, lexical, line_templates, mixing, neighbours, ngram_join, pieces, pii, repair, toxicity
from vitalgrid.llm.common import table

#: A public byte-pair model with byte fallback.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return add


@query("op8_exact_dedup", r"""
    with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
    select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
        doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from d""")
def op8(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op10_mix_sources")
def op10(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6(spark, sf_dir):
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_personal_data")
def op2(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@query("op7_nearest_neighbours", """
    with v as (select vec_id, embedding::double[] as e from embeddings
               where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                   and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    p as (select a.vec_id as query_id, b.vec_id,
              list_reduce(list_transform(generate_series(1, len(a.e)), lambda i: a.e[i] * b.e[i]), lambda x, y: x + y) as score
          from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
    r as (select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from p)
    select query_id, rank, vec_id, score from r where rank <= 20""")
def op7(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_line_templates")
def op3(spark, sf_dir):
    return line_templates.dedup_lines(table(spark, sf_dir, "documents"))


@query("op5_merkle_fixity", """
    with r as (select page_id, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Target-URI: ',
            coalesce(url, ''), chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ',
            strlen(coalesce(html, '')), chr(13), chr(10), chr(13), chr(10), coalesce(html, ''), chr(13), chr(10), chr(13), chr(10)) as rec,
            substr(sha256(page_id::varchar), 1, 2) as fate from pages),
    m as (select *, length(rec) // 2 as mid from r where fate in ('00', '01', '02'))
    select page_id, strlen(rec) as length, case when fate = '02' then 'missing' else 'changed' end as status,
        sha256(rec) as sha256_expected,
        case fate when '00' then sha256(concat(substr(rec, 1, mid), case when substr(rec, mid + 1, 1) = '#' then '$' else '#' end,
                                               substr(rec, mid + 2)))
                  when '01' then sha256(substr(rec, 1, mid)) end as sha256_found
    from m""")
def op5(spark, sf_dir):
    found = fixity.audited(table(spark, sf_dir, "pages"))
    return found.select("page_id", (F.col("hi") - F.col("lo")).alias("length"), "status", "sha256_expected", "sha256_found")


@query("op9_ngram_join")
def op9(spark, sf_dir):
    return ngram_join.similar(table(spark, sf_dir, "documents"))


@query("op1_sentencepiece")
def op1(spark, sf_dir):
    model = pieces.Model.load(PIECE_MODEL)
    coded = pieces.encode(table(spark, sf_dir, "documents"), model)
    return coded.withColumn("decoded_sha256", F.sha2(pieces.decoded(F.col("ids"), model), 256))


@query("op13_decontamination", r"""
    with words as (select *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
                   from (select 'd' as kind, doc_id as id, text from documents union all select 'i', item_id, text from benchmark)),
    strings as (select distinct id, least(len(w), 10) as m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as s
                from (select id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as i from words where kind = 'i' and len(w) > 0)),
    lengths as (select distinct m from strings),
    d as (select row_number() over () as r, id, w from words where kind = 'd'),
    grams as (select r, m, i, array_to_string(w[i : i + m - 1], ' ') as s
              from (select r, w, m, unnest(generate_series(1, len(w) - m + 1)) as i from d, lengths)),
    found as (select g.r, g.m, g.i, t.id as item from grams g join strings t on g.m = t.m and g.s = t.s),
    hit as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + m - 1)) as p from (select distinct r, m, i from found)) group by r),
    items as (select r, count(*) as n_items, string_agg(item::varchar, ',' order by item::varchar) as ids from (select distinct r, item from found) group by r)
    select id as doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
        sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
    from d left join hit using (r) left join items using (r)""")
def op13(spark, sf_dir):
    return decontaminate.report(decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op11_lexical_search", r"""
    with words as (select r, id, kind, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term
                   from (select 'd' as kind, doc_id as id, text, row_number() over () as r from documents
                         union all select 'i', item_id, text, 0 from benchmark)),
    tfs as (select r, id as doc_id, term, count(*) as tf from words where kind = 'd' group by all),
    docs as (select r, sum(tf)::bigint as n from tfs group by r),
    totals as (select count(*) as big_n, sum(n)::bigint as l from docs),
    ms as (select r, 50 + (50 * n * big_n) // l as m from docs, totals),
    w as (select term, floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1)))::bigint as w from tfs, totals group by term),
    asked as (select distinct id as item_id, term from words where kind = 'i'),
    scores as (select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
               from asked join tfs using (term) join w using (term) join ms using (r) group by item_id, r, doc_id),
    ranked as (select *, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank from scores where score > 0)
    select item_id, rank, doc_id, score from ranked where rank <= 50""")
def op11(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_conversation_repair")
def op12(spark, sf_dir):
    return repair.repaired(table(spark, sf_dir, "conversations"))

"""Registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm import decontaminate, divergence, fingerprint, html_template, langid, lm_score, merkle, ngram_join, packing, quality, sharding, urlfilter, warc
from tickerlake.llm.common import scratch_path, table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.score(table(spark, sf_dir, "documents"), good)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.annotate_language(docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


# Rules of the contract: (rule, verdict).
URL_RULES = "values ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow') as t(rule, verdict)"


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label): the number in a url's path is the document that it shows; a poor or toxic document blocks its url."""
    _, path = urlfilter.host_and_path(F.col("url"))
    shown = pages.select("url", F.regexp_extract(path, "/([0-9]{1,18})", 1).alias("n")).where("n != ''")
    poor = labels.select(F.col("doc_id").cast("string").alias("n"), F.expr("int(quality = 0 or toxic = 1)").alias("label"))
    return shown.join(poor, "n").select("url", "label")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.sql(f"select * from {URL_RULES}")
    labelled = labelled_urls(pages, table(spark, sf_dir, "labels"))
    return urlfilter.judge(pages, rules, labelled).select("page_id", "host", "path", "rule", "verdict")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).drop("map_version")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(spark, path, with_payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.annotate_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprint.compare_edits(docs, fingerprint.corpus_ranks(docs))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select("doc_id", "source", merkle.leaf(*fields, F.col("text")).alias("leaf"),
                         F.when(tampered, merkle.leaf(*fields, F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered_leaf"))
    proofs = merkle.manifest(leaves, "source", "doc_id")
    folded = merkle.fold(F.col("path"), F.coalesce("tampered_leaf", "leaf"))
    return (proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_lm_score": op2_lm_score,
    "op3_language": op3_language,
    "op4_html_text": op4_html_text,
    "op5_decontaminate": op5_decontaminate,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_sharding": op8_sharding,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_fingerprint": op11_fingerprint,
    "op12_merkle": op12_merkle,
    "op13_divergence": op13_divergence,
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP5_SQL = f"""
with item as (
    select cast(item_id as varchar) as item_id, {_WORDS} as w from benchmark where item_id is not null
), win as (
    select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as gram
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item where len(w) > 0)
), doc as (
    select row_number() over () as r, doc_id, {_WORDS} as w from documents
), gram as (
    select r, i, n, array_to_string(w[i:i + n - 1], ' ') as gram
    from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, (select distinct n from win) where len(w) >= n)
), occ as (
    select g.r, g.i, g.n, v.item_id from gram g join win v on g.n = v.n and g.gram = v.gram
), hit as (
    select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from occ) group by r
), items as (
    select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct r, item_id from occ) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit using (r) left join items using (r)
"""

# CRC-32 byte by byte over its table, which the reflected polynomial gives.
OP12_SQL = """
with recursive crc(i, k, c) as (
    select range, 0, range from range(256)
    union all
    select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc where k < 8
), crc_table as (
    select list(c order by i) as t from crc where k = 8
), doc as (
    select row_number() over () as r, doc_id, source, lang, n_chars, text from documents
), tampered as (
    select r, xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) % 2 = 0 as yes
    from doc, crc_table
), field as (
    select r, doc_id, source, coalesce(yes, false) as yes, text,
        concat(coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-'),
            coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
            coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-')) as head
    from doc left join tampered using (r)
), leaf as (
    select r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as h,
        sha256(head || coalesce(strlen(if(yes, replace(text, chr(10), ''), text)) || ':' || if(yes, replace(text, chr(10), ''), text), '-')) as shown
    from field
), node as (
    select source, 0 as level, row_number() over (partition by source order by doc_id nulls first, h) - 1 as i, h, count(*) over (partition by source) as n
    from leaf
    union all
    select source, level, i, h, count(*) over (partition by source) from (
        select source, level + 1 as level, i // 3 as i, sha256(string_agg(h, '' order by i)) as h
        from node where n > 1 group by source, level, i // 3)
), subroot as (
    select source, h, row_number() over (order by source nulls first) - 1 as i from node where n = 1
), top as (
    select 0 as level, i, h, count(*) over () as n from subroot
    union all
    select level, i, h, count(*) over () from (
        select level + 1 as level, i // 3 as i, sha256(string_agg(h, '' order by i)) as h from top where n > 1 group by level, i // 3)
), spot as (
    select r, doc_id, source, h, shown, row_number() over (partition by source order by doc_id nulls first, h) - 1 as i from leaf
), step as (
    select p.r, n.level as step, coalesce(string_agg(n.h, '' order by n.i) filter (n.i < p.i // (3 ** n.level)::bigint), '') as l,
        coalesce(string_agg(n.h, '' order by n.i) filter (n.i > p.i // (3 ** n.level)::bigint), '') as r2
    from spot p join node n on n.source is not distinct from p.source and n.n > 1 and n.i // 3 = p.i // (3 ** (n.level + 1))::bigint
    group by p.r, n.level
    union all
    select p.r, 1000 + t.level, coalesce(string_agg(t.h, '' order by t.i) filter (t.i < s.i // (3 ** t.level)::bigint), ''),
        coalesce(string_agg(t.h, '' order by t.i) filter (t.i > s.i // (3 ** t.level)::bigint), '')
    from spot p join subroot s on s.source is not distinct from p.source join top t on t.n > 1 and t.i // 3 = s.i // (3 ** (t.level + 1))::bigint
    group by p.r, t.level
), path as (
    select r, list({'l': l, 'r': r2} order by step) as steps, sha256(string_agg(l || r2, '' order by step)) as proof_sha256 from step group by r
), folded as (
    select p.doc_id, p.h as leaf, s.h as subroot, (select h from top where n = 1) as root, coalesce(proof_sha256, sha256('')) as proof_sha256,
        list_reduce(list_prepend({'l': p.shown, 'r': ''}, coalesce(steps, [])), lambda a, x: {'l': sha256(x.l || a.l || x.r), 'r': ''}).l as folded_root
    from spot p join subroot s on s.source is not distinct from p.source left join path using (r)
)
select *, folded_root = root as verified from folded
"""

OP13_SQL = r"""
with doc as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
), term as (
    select lang, source, r, unnest(w) as term from doc
), kept as (
    select lang, term, count(*) as n from term group by lang, term having count(distinct r) >= 10
), lang_total as (
    select lang, count(*) as v, sum(n) as total from kept group by lang
), found as (
    select lang, source, term, count(*) as n from term semi join kept using (lang, term) group by lang, source, term
), grp as (
    select lang, source, coalesce(sum(n), 0) as total from (select distinct lang, source from doc) left join found using (lang, source) group by lang, source
), p as (
    select lang, source, k.term, coalesce(f.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(f.n, 0) + 2)) // (g.total + 2 * t.v)::hugeint as p,
        1 + (1000000000::hugeint * (k.n + 2)) // (t.total + 2 * t.v)::hugeint as q
    from grp g join lang_total t using (lang) join kept k using (lang) left join found f using (lang, source, term)
), pair as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), part as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from grp a join grp b on a.lang = b.lang and a.source <> b.source
    left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source
    union all
    select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from p where n > 0 and p > q
)
select lang, source, part, item, cast(value as bigint) as value,
    cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from part qualify part = 'pair' or rank <= 10
"""

ORACLE: dict[str, str] = {"op5_decontaminate": OP5_SQL, "op12_merkle": OP12_SQL, "op13_divergence": OP13_SQL}

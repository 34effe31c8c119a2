"""Queries of this subpackage for ``__spark_entry__.py``, each over its whole table, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremor.llm import bpe, chat, decontaminate, line_dedup, near_dedup, ngram_join, quality, repeats, rules, toxicity, url_filter, whitening
from tremor.llm.common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.parse(table(spark, sf_dir, "conversations"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


#: The vocabulary that the queries encode with; its file stays where the tokenizer package has it.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_quality_classifier, op3_suffix_dedup, op4_toxicity, op5_chat_format, op6_ngram_jaccard_join, op7_line_dedup, op8_decontamination, op9_quality_rules, op10_byte_bpe,
        op11_minhash_near_dedup, op12_embedding_whitening,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = rf"""
with docs as (select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (select cast(item_id as varchar) as item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
starts as (select item_id, w, least(10, len(w)) as m, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from items where len(w) > 0),
windows as (select distinct item_id, m, array_to_string(w[i : i + m - 1], ' ') as win from starts),
lengths as (select distinct m from windows),
places as (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from docs, lengths where len(w) >= m),
found as (select p.doc_id, p.i, p.m, v.item_id from (select doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') as win from places) p join windows v on v.m = p.m and v.win = p.win),
hit as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(i, i + m)) as x from found) group by doc_id),
who as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from found group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit, cast(coalesce(o.n_items, 0) as bigint) as n_items,
  sha256(coalesce(o.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from docs d left join hit h using (doc_id) left join who o using (doc_id)
"""


def _components_sql(percent: int, more: str = "") -> str:
    """n_shingles and component_id of documents whose sets of 4-word shingles link at ``percent``."""
    return rf"""
with recursive docs as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
places as (select doc_id, w, least(4, len(w)) as m, unnest(range(1, len(w) - least(4, len(w)) + 2)) as i from docs where len(w) > 0),
grams as (select distinct doc_id, array_to_string(w[i : i + m - 1], ' ') as g from places),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  where 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= {percent} * (x.n + y.n - count(*))
),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least_ids as (select a, min(b) as b from reach group by a)
select d.doc_id, cast(coalesce(s.n, 0) as bigint) as n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) as component_id{more}
from docs d left join sizes s using (doc_id) left join least_ids l on l.a = d.doc_id
"""


OP6_SQL = _components_sql(85)
OP11_SQL = _components_sql(80, ", d.doc_id = least(d.doc_id, coalesce(l.b, d.doc_id)) as kept")

OP3_SQL = """
with docs as (select doc_id, coalesce(text, '') as text, hex(encode(coalesce(text, ''))) as h, cast(octet_length(encode(coalesce(text, ''))) as bigint) as n from documents),
blocks as (select doc_id, n, 400 * b as base, substr(h, 800 * b + 1, 1198) as part from (select doc_id, n, h, unnest(range(0, (n + 200) // 400)) as b from docs where n >= 200)),
starts as (select doc_id, base + o as s, md5(substr(part, 2 * o + 1, 400)) as win from (select *, unnest(range(0, least(400, n - 199 - base))) as o from blocks)),
counted as (select doc_id, s, count(*) over (partition by win) as c from starts),
steps as (select doc_id, s, case when s - lag(s) over (partition by doc_id order by s) <= 200 then 0 else 1 end as new from counted where c > 1),
numbered as (select doc_id, s, sum(new) over (partition by doc_id order by s) as k from steps),
spans as (select doc_id, k, min(s) as lo, max(s) + 200 as hi from numbered group by doc_id, k),
pieces as (
  select doc_id, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as a, lo as b from spans
  union all select s.doc_id, max(s.hi), max(d.n) from spans s join docs d on d.doc_id = s.doc_id group by s.doc_id
),
kept as (select p.doc_id, string_agg(substr(d.h, 2 * p.a + 1, 2 * (p.b - p.a)), '' order by p.a) as h from pieces p join docs d on d.doc_id = p.doc_id group by p.doc_id),
lost as (select doc_id, sum(hi - lo) as n_removed, count(*) as n_spans from spans group by doc_id)
select d.doc_id, d.n as n_bytes, cast(coalesce(l.n_removed, 0) as bigint) as n_removed, cast(coalesce(l.n_spans, 0) as bigint) as n_spans, sha256(coalesce(unhex(k.h), encode(d.text))) as kept_sha256
from docs d left join lost l using (doc_id) left join kept k using (doc_id)
"""

SQL: dict[str, str] = {"op3_suffix_dedup": OP3_SQL, "op6_ngram_jaccard_join": OP6_SQL, "op8_decontamination": OP8_SQL, "op11_minhash_near_dedup": OP11_SQL}

"""Registered queries of this folder: each applies its operator to the whole intended table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import crc_mod, saved
from tallyspark.llm.urlfilter import oracle_sql as url_oracle


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of remainder 1 (crc32 mod 3) are held out."""
    from tallyspark.llm.toxicity import toxicity
    held = crc_mod("doc_id", 3) == 1
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ~held, held)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces with their places in sequences of 1024 tokens."""
    from tallyspark.llm.packing import pack
    return pack(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, truncated totals and quantiles for every encoded length of documents taken as context limit."""
    from tallyspark.llm.tokens import context_limits, histogram
    return context_limits(saved(histogram(_table(spark, sf_dir, "documents"))))  # read twice, encoded once


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    from tallyspark.llm.neardup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows of remainder 1 (crc32 mod 3) are held out."""
    from tallyspark.llm.langid import language_id
    held = crc_mod("doc_id", 3) == 1
    return language_id(_table(spark, sf_dir, "documents"), ~held, held)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they contain."""
    from tallyspark.llm.decontam import contaminated
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    from tallyspark.llm.urlfilter import url_filter
    return url_filter(_table(spark, sf_dir, "pages"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree and add-one unigram log10 probability of every document; rows of remainder 2 (crc32 mod 7) are held out."""
    from tallyspark.llm.ctw import score
    return score(_table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from tallyspark.llm.htmltext import main_text
    return main_text(_table(spark, sf_dir, "pages"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    from tallyspark.llm.topk import top_k
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    from tallyspark.llm.convtrie import trie_report, turn_lists, with_shared_heads
    c = F.col("conv_id")
    lists = turn_lists(_table(spark, sf_dir, "conversations"))
    return trie_report(with_shared_heads(lists, c - c % 100, crc_mod("conv_id", 6), 5))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal periodic word runs of every document, one in ten made periodic by its id's checksum."""
    from tallyspark.llm.repeats import repetitions, report
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return report(repetitions(_table(spark, sf_dir, "documents"), checksum))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of remainder 0 (crc32 mod 5) are held out."""
    from tallyspark.llm.quality import quality
    held = crc_mod("doc_id", 5) == 0
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ~held, held)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_counts": op3_token_counts,
    "op4_url_filters": op4_url_filters,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_html_extraction": op9_html_extraction,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_quality_classifier": op13_quality_classifier,
}

SQL: dict[str, str] = {
    "op11_conversation_trie": """
with crc as (select [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)
                     for n in range(256)] as tab),
t as (select cast(conv_id as bigint) as c, cast(turn as bigint) as turn, coalesce(role, '') as r, coalesce(text, '') as x
      from conversations where conv_id is not null),
own as (select c, list({'r': r, 'x': x} order by turn nulls first, sha256(concat(length(r), ':', r, x))[1:32]) as s from t group by c),
h as (select c, s, cast(xor(list_reduce(list_prepend(cast(4294967295 as bigint), [cast(ord(b) as bigint) for b in string_split(cast(c as varchar), '')]),
                                        lambda a, b: xor(a >> 8, cast(tab[cast(xor(a, b) & 255 as int) + 1] as bigint))), 4294967295) % 6 as int) as k
      from own, crc),
conv as (select h.c, list_concat(coalesce(o.s[1:h.k], []), h.s[h.k + 1:]) as s from h left join own o on o.c = h.c - h.c % 100),
pre as (select c, s, unnest(range(len(s) + 1)) as d from conv),
node as (select s[1:d] as p, d, count(*) as n, min(c) as m,
                sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where len(s) = d), '')) as e
         from pre group by s[1:d], d),
kid as (select p[1:d - 1] as p, count(*) as k from node where d > 0 group by 1),
full_node as (select node.p, d, n, m, e, coalesce(k, 0) as k,
                     case when d = 0 then 0 else (n - 1) * length(node.p[d].x) end as own_saved from node left join kid on kid.p = node.p),
below as (select p[1:a] as p, a as d, sum(case when k = 0 then 1 else 0 end) as leaves, sum(own_saved) as saved
          from (select *, unnest(range(d + 1)) as a from full_node) group by 1, 2)
select f.m as conv_id, cast(f.d as bigint) as depth, up.m as parent_conv_id, cast(f.n as bigint) as n_convs, cast(f.k as bigint) as n_children,
       cast(below.leaves as bigint) as n_leaves, cast(below.saved as bigint) as saved_tokens, f.e as ends_sha256
from full_node f join below on below.d = f.d and below.p = f.p
left join node up on up.d = f.d - 1 and up.p = f.p[1:f.d - 1]""",
    "op4_url_filters": url_oracle(),
    "op10_exact_top_k": """
with e as (select cast(vec_id as bigint) as vec_id, [floor(256.0 * cast(x as double)) for x in embedding] as v
           from embeddings where vec_id is not null and embedding is not null and len(embedding) > 0
           and len([x for x in embedding if x is not null and isfinite(cast(x as double))]) = len(embedding)),
s as (select q.vec_id as query_id, c.vec_id as vec_id,
             cast(list_dot_product(q.v, c.v) as bigint) as score
      from e q join e c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5""",
}

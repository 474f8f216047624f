"""The registered queries of this folder: one for each operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Ids of the vocabulary in byte_bpe_50k.json.
VOCABULARY = 50_257


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ctw import score_documents

    return score_documents(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).withColumn("similarity", F.round("similarity", 6))


#: Every window of every item's size that shares a shingle with the item; documents of fewer words are one window.
OP2_SQL = r"""
with iw as (select item_id, w, len(w) as n, least(len(w), 5) as k from (
      select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from benchmark) where len(w) > 0),
dw as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
i5 as (select item_id, n, k, unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as s from iw),
ic as (select item_id, n, k, s, count(*) as c from i5 group by all),
dp as (select doc_id, w, k, unnest(range(0, len(w) - k + 1)) as p from dw cross join (select distinct k from iw) where len(w) >= k),
d5 as (select doc_id, k, p, array_to_string(w[p + 1:p + k], ' ') as s from dp),
pairs as (select distinct doc_id, item_id, n, k from d5 join ic using (k, s)),
sized as (select doc_id, item_id, n, k, n - k + 1 as m, len(w) - k + 1 as total, least(n - k + 1, len(w) - k + 1) as wide from pairs join dw using (doc_id)),
starts as (select *, unnest(range(0, total - wide + 1)) as start from sized where total * 5 >= m * 4),
wc as (select t.doc_id, t.item_id, t.n, t.k, t.m, t.wide, t.start, d5.s, count(*) as c from starts t join d5 on d5.doc_id = t.doc_id and d5.k = t.k and d5.p between t.start and t.start + t.wide - 1 group by all),
ov as (select wc.doc_id, wc.item_id, wc.k, wc.m, wc.wide, wc.start, sum(least(wc.c, ic.c)) as o from wc join ic on ic.item_id = wc.item_id and ic.n = wc.n and ic.s = wc.s group by all),
ok as (select *, cast(o as double) / (m + wide - o) as similarity from ov where 9 * o >= 4 * (m + wide))
select doc_id, item_id, cast(arg_min(start, (-similarity, start)) as int) as start, cast(arg_min(wide + k - 1, (-similarity, start)) as int) as n_words, round(max(similarity), 6) as similarity
from ok group by doc_id, item_id
"""


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_file import token_file

    return token_file(documents(spark, sf_dir), tokenizer_path(), VOCABULARY)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


OP8_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c as (select vec_id, unnest(q) as x, unnest(range(len(q))) as i from v),
s as (select a.vec_id as query_id, b.vec_id, cast(sum(a.x * b.x) as bigint) as score from c a join c b on a.i = b.i and a.vec_id <> b.vec_id
      where a.vec_id % 50 = 0 group by all)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(documents(spark, sf_dir)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import vector_codes

    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _floor_mean(total: str, count: str) -> str:
    """floor(total / count) of whole numbers in SQL, where // cuts towards zero."""
    return f"(({total}) - ((({total}) % {count}) + {count}) % {count}) // {count}"


def _op11_sql(rounds: int = 6) -> str:
    """Components as rows (vec_id, part, position); each round a table of assignments and one of entries."""
    kept = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
    steps = [
        f"v as materialized (select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as q from embeddings where {kept})",
        "c as materialized (select vec_id, p, k, q[p * w + k + 1] as x from (select *, len(q) // 8 as w, unnest(range(8)) as p from v) t, lateral (select unnest(range(w)) as k) u)",
        "b0 as materialized (select p, cast(e as bigint) as e, k, x from c join (select vec_id, row_number() over (order by vec_id) - 1 as e from v qualify row_number() over (order by vec_id) <= 16) s using (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(f"d{r} as materialized (select c.vec_id, c.p, b.e, sum((c.x - b.x) * (c.x - b.x)) as d from c join b{r} b on c.p = b.p and c.k = b.k group by all)")
        steps.append(f"a{r} as materialized (select vec_id, p, arg_min(e, (d, e)) as e, min(d) as d from d{r} group by all)")
        if r < rounds:
            new = f"select p, e, k, {_floor_mean('sum(x)', 'count(*)')} as x from a{r} join c using (vec_id, p) group by all"
            steps.append(f"b{r + 1} as materialized (select b.p, b.e, b.k, cast(coalesce(n.x, b.x) as bigint) as x from b{r} b left join ({new}) n on n.p = b.p and n.e = b.e and n.k = b.k)")
    final = f"""
f as materialized (select vec_id, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error from a{rounds} group by all),
l as (select label, cast(sum(error) as bigint) as label_error from f join v using (vec_id) group by all),
h as (select sha256(string_agg(cast(x as varchar), ',' order by p, e, k)) as codebooks_sha256 from b{rounds})
select f.vec_id, code, error, label_error, codebooks_sha256 from f join v using (vec_id) join l on l.label is not distinct from v.label cross join h"""
    return "with " + ",\n".join(steps) + "," + final


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import clusters

    return clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _op12_sql(rounds: int = 10) -> str:
    kept = "len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
    steps = [
        f"v as materialized (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q from embeddings where {kept})",
        "c as materialized (select vec_id, unnest(range(64)) as k, unnest(q) as x from v)",
        "s as materialized (select vec_id, row_number() over (order by sha256('3:' || vec_id)) - 1 as e from v qualify row_number() over (order by sha256('3:' || vec_id)) <= 8)",
        "b0 as materialized (select e, k, x from c join s using (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(f"d{r} as materialized (select c.vec_id, b.e, sum((c.x - b.x) * (c.x - b.x)) as d from c join b{r} b on c.k = b.k group by all)")
        steps.append(f"a{r} as materialized (select vec_id, arg_min(e, (d, e)) as e, min(d) as d from d{r} group by all)")
        if r < rounds:
            new = f"select e, k, {_floor_mean('sum(x)', 'count(*)')} as x from a{r} join c using (vec_id) group by all"
            steps.append(f"b{r + 1} as materialized (select b.e, b.k, cast(coalesce(n.x, b.x) as bigint) as x from b{r} b left join ({new}) n on n.e = b.e and n.k = b.k)")
    final = f"""
h as (select e, sha256(string_agg(cast(x as varchar), ',' order by k)) as centroid_sha256 from b{rounds} group by all)
select vec_id, cast(a.e as int) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by a.e) as bigint) as cluster_inertia,
       cast(sum(d) over () as bigint) as inertia, centroid_sha256 from a{rounds} a join h on h.e = a.e"""
    return "with " + ",\n".join(steps) + "," + final


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .piece_model import digests

    return digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_context_tree_weighting, op2_decontamination, op3_token_file, op4_quality, op5_language, op6_toxicity, op7_licenses, op8_top_k, op9_mixing, op10_simhash_near_dedup, op11_vector_codes, op12_centroids, op13_pieces, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op8_top_k": OP8_SQL, "op11_vector_codes": _op11_sql(), "op12_centroids": _op12_sql()}

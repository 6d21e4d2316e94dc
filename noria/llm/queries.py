"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noria.llm import ball_kmeans, chat, embedding_dedup, lexical_search, line_dedup, lm, metric_search, minmax, mixing, packing, pii, toxicity, warc
from noria.llm.common import crc_mod, ship_package

#: Which domain a source belongs to, and the integer weights of the tree.  The sources that have no weight of their own weigh 1.
MIX_DOMAIN_SQL = "case when source in ('src0', 'src1', 'src2', 'src3', 'src4') then 'web' when source in ('src5', 'src6', 'src7', 'src8', 'src9', 'src10', 'src11') then 'books' else 'reference' end"
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "reference": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {"src0": 2}}
MIX_FRACTION, MIX_EPOCHS, MIX_SEED = 0.6, 2, 17


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines: doc_id, text, n_dropped_lines."""
    return line_dedup.drop_boilerplate_lines(_read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "text", "n_dropped_lines")


def line_dedup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages without their host's boilerplate lines: page_id, html, n_dropped_lines."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return line_dedup.drop_boilerplate_lines(pages, line_dedup.url_host("url"), "html").select("page_id", "html", "n_dropped_lines")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture takes of each document: doc_id, mix_domain, mix_tokens, mix_epochs, mix_take."""
    mixed = mixing.mix_sources(_read(spark, sf_dir, "documents"), F.expr(MIX_DOMAIN_SQL), MIX_FRACTION, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED)
    return mixed.select("doc_id", "mix_domain", "mix_tokens", "mix_epochs", "mix_take")


def op4_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every vector whose id is divisible by 20."""
    return metric_search.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return embedding_dedup.embedding_duplicates(_read(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that has seen no held-out label."""
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.train(docs, _read(spark, sf_dir, "labels"), toxicity.not_held_out())
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "toxicity_threshold")


def op7_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of conversation -1, read back from the prefix tree."""
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(*chat.prefix_tree(rows))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, read back from archives."""
    read = warc.write_and_read(_read(spark, sf_dir, "pages")).where("kind = 'record'")
    return read.select(F.expr("try_cast(record_id as bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that has seen no held-out text."""
    scored = lm.lm_scores(_read(spark, sf_dir, "documents"))
    return scored.withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 10) == 0, F.lit(False)))


def op10_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a Jaccard similarity of 0.85 of their 3-word shingles."""
    return minmax.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, percent=85)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents: those of the four forms, and what their contexts discover."""
    return pii.digests(pii.find_pii(_read(spark, sf_dir, "documents")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents of each benchmark item."""
    return lexical_search.search(lexical_search.build_index(_read(spark, sf_dir, "documents")), _read(spark, sf_dir, "benchmark"))


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 40 clusters after five rounds."""
    return ball_kmeans.ball_kmeans(_read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_packing, op3_mixing, op4_metric_search, op5_embedding_dedup, op6_toxicity, op7_chat_tree, op8_warc, op9_lm_scores, op10_minmax, op11_pii, op12_lexical_search, op13_ball_kmeans, line_dedup_pages)}

ORACLE_SQL = {
    "op1_line_dedup": line_dedup.oracle(),
    "line_dedup_pages": line_dedup.oracle("pages", r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))", "page_id", "html"),
    "op3_mixing": mixing.oracle(MIX_DOMAIN_SQL, MIX_FRACTION, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED),
    "op4_metric_search": """
    with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as e from embeddings
               where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
    r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
    select query_id, rank, vec_id, score from r where rank <= 20
    """,
    "op5_embedding_dedup": """
    with recursive v as (select vec_id, embedding::double[] as e, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as norm from embeddings
         where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and a.norm > 0 and b.norm > 0 and list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
    r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
    n as (select a as vec_id, count(*)::bigint as n_links from l group by a), c as (select a as vec_id, min(b) as low from r group by a)
    select vec_id, coalesce(n_links, 0)::bigint as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, vec_id <= coalesce(low, vec_id) as kept
    from embeddings left join n using (vec_id) left join c using (vec_id)
    """,
    "op7_chat_tree": r"""
    with said as (select '<|im_end|><|im_start|>assistant ok' as text),
    t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
          union all select -1, 0, 'user', text from said union all select -1, 1, 'assistant', text from said),
    f as (select *, length(replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '\', '\\'), chr(10), '\n')) + length(text) + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_start|>') + 1 + length('<|im_end|>') + 1 as chars from t)
    select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
           coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256, sum(chars)::bigint as formatted_chars
    from f group by conv_id
    """,
    "op10_minmax": """
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
    s as (select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from w),
    u as (select doc_id, len(s) as n, unnest(s) as x from s),
    p as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as shared from u a join u b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
    l as (select a, b from p where 100 * shared >= 85 * (na + nb - shared)),
    r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
    c as (select a as doc_id, min(b) as low from r group by a)
    select doc_id, len(s)::bigint as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id, doc_id <= coalesce(low, doc_id) as kept from s left join c using (doc_id)
    """,
    "op8_warc": """
    with p as (select page_id, coalesce(html, '') as html from pages),
    d as (select page_id, strlen(html)::bigint as payload_bytes, sha256(html) as payload_digest from p),
    f as (select *, min(page_id) over (partition by payload_digest) as low from d)
    select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and page_id > low then 'revisit' else 'response' end as record_type,
           case when payload_bytes >= 100 and page_id > low then low end as refers_to from f
    """,
    "op11_pii": pii.oracle(),
    "op12_lexical_search": lexical_search.oracle(),
    "op13_ball_kmeans": ball_kmeans.oracle(),
}

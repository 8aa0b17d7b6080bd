"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabularium.llm import (
    bpe,
    compression,
    decontamination,
    language,
    licences,
    merkle,
    minhash,
    mixing,
    personal,
    resampling,
    sentences,
    topk,
    toxicity,
)

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(build):
    LLM_QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


@_query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and their text again, as digests."""
    tokenizer = bpe.read_tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return (
        _table(spark, sf_dir, "documents", "doc_id", "text")
        .select("doc_id", bpe.encode_decode(F.col("text"), tokenizer).alias("coded"))
        .select(
            "doc_id",
            F.expr("octet_length(coded.ids) div 4").alias("n_tokens"),
            F.sha2("coded.ids", 256).alias("ids_sha256"),
            F.sha2(F.col("coded.text").cast("binary"), 256).alias("decoded_sha256"),
        )
    )


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of benchmark items."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    items = _table(spark, sf_dir, "benchmark", "item_id", "text")
    return (
        decontamination.find_passages(docs, items)
        .select(
            "doc_id",
            "hits.n_words",
            "hits.n_hit",
            F.size("hits.items").cast("long").alias("n_items"),
            F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


@_query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    trees = language.learn(docs.where(F.coalesce(_fold(F.col("doc_id"), 4), F.lit(0)) != 2))
    return docs.select(
        "doc_id",
        F.coalesce(_fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        language.predict(F.col("text"), trees).alias("found"),
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


#: From which score on a document counts as toxic.
TOXIC = 0.3


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of three of four."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", F.col("toxic").alias("label"))
    machine = toxicity.learn(docs, labels.where(_fold(F.col("doc_id"), 4) != 2))
    return docs.select(
        "doc_id",
        F.coalesce(_fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        toxicity.score(F.col("text"), machine).alias("score"),
    ).withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


@_query
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors of highest inner product with every fiftieth one."""
    vectors = topk.scaled(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


LLM_ORACLES["op8_topk"] = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where embedding is not null and len(embedding) > 0
      and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from whole q join whole c on c.vec_id <> q.vec_id
    where q.vec_id % 50 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
    from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@_query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), percent=85)


@_query
def op9_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of every document that repeat a passage met before, and where it was met."""
    marked, _ = sentences.mark_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return marked.select(
        "doc_id",
        F.col("left.cut.n_sentences").alias("n_sentences"),
        F.col("left.cut.n_removed").alias("n_removed"),
        (F.col("left.cut.n_removed") > 0).alias("repeats"),
        F.coalesce("left.origins", F.array().cast("array<long>")).alias("repeats_of"),
        F.sha2(F.col("left.cut.text").cast("binary"), 256).alias("text_sha256"),
    )


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline``."""
    return corpus_pipeline.run(spark, sf_dir)


def _worn(records: DataFrame) -> DataFrame:
    """A replica that has suffered: some records lost, some with their last byte overwritten."""
    mark = F.substring(F.md5(F.col("record_id").cast("string").cast("binary")), 1, 2)
    worn = F.concat(F.expr("substring(record, 1, length(record) - 1)"), F.lit("?"))
    whole = F.when(mark == "7f", worn).otherwise(F.col("record"))
    return records.withColumn("record", F.when(F.coalesce(mark, F.lit("")) != "3c", whole))


@_query
def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage in a second copy of the archive of all pages."""
    records = merkle.warc_records(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return merkle.audit(records, _worn(records))


LLM_ORACLES["op2_merkle"] = """
with records as (
    select 'pages-' || (page_id // 1000) || '.warc' as file, page_id as record_id,
        'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
        || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
        || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10)
        || 'Content-Length: ' || octet_length(encode(coalesce(html, '')))
        || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
        || chr(13) || chr(10) || chr(13) || chr(10) as record
    from pages
), placed as (
    select *, octet_length(encode(record)) as length, substr(md5(cast(record_id as varchar)), 1, 2) as mark,
        coalesce(sum(octet_length(encode(record))) over (
            partition by file order by record_id rows between unbounded preceding and 1 preceding), 0) as place
    from records
)
select file, cast(place as bigint) as "offset", cast(length as bigint) as length, record_id,
    case mark when '3c' then 'missing' else 'corrupt' end as status,
    sha256(record) as hash_a,
    case mark when '7f' then sha256(substr(record, 1, length(record) - 1) || '?') end as hash_b
from placed where mark in ('3c', '7f')
"""


@_query
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of all documents that name their licence."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = licences.find_licences(docs, licences.learn(docs))
    return found.where("confirmed").select("doc_id", "paragraph", "line", "family")


LLM_ORACLES["op3_licences"] = """
with lines as (
    select doc_id, unnest(string_split(text, chr(10))) as line,
        cast(generate_subscripts(string_split(text, chr(10)), 1) - 1 as integer) as paragraph
    from documents
)
select doc_id, paragraph, line, case
    when contains(line, 'MIT License') then 'MIT'
    when contains(line, 'Apache License') then 'Apache-2.0'
    when contains(line, 'GNU General Public License') then 'GPL-3.0'
    else 'CC-BY-NC-4.0' end as family
from lines
where regexp_matches(line, 'MIT License|Apache License|GNU General Public License|CC BY-NC 4')
"""


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned from six of seven."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(_fold(F.col("doc_id"), 7) == 2, F.lit(False))
    scored = mixing.score(docs.withColumn("learn", ~held_out))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth of all documents that is drawn towards the benchmark, in order."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    drawn = resampling.resample(docs, _table(spark, sf_dir, "benchmark", "text"), percent=10, least=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 by its rule, over the bytes of each distinct word; A-Z is lowered letter by letter, as other letters stay.
LLM_ORACLES["op12_resampling"] = r"""
with bytes as (
    select list(list_reduce(range(8), lambda c, i: case when (c & 1) = 1
        then xor(3988292384, c >> 1) else c >> 1 end, cast(b as bigint)) order by b) as crcs
    from range(256) t(b)
), texts as (
    select 's' as side, doc_id, text from documents union all select 't', null, text from benchmark
), lists as (
    select side, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from texts
), features as (
    select side, doc_id, unnest(words) as word from lists
), distinct_words as (
    select distinct word, hex(encode(word)) as h from features
), buckets as (
    select word, xor(list_reduce(list_transform(range(length(h) // 2), lambda i:
            16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
            + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1),
        lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8), cast(4294967295 as bigint)), 4294967295) % 10000 as bucket
    from distinct_words, bytes
), counted as (
    select bucket, count(*) filter (side = 's') as s, count(*) filter (side = 't') as t
    from features join buckets using (word) group by bucket
), gains as (
    select bucket, cast(floor(1000 * ln(cast((t + 1) * ((select sum(s) from counted) + 10000) as double)
        / cast((s + 1) * ((select sum(t) from counted) + 10000) as double))) as bigint) as gain
    from counted
), weights as (
    select doc_id, count(*) as n, cast(floor(cast(sum(gain) as double) / count(*)) as bigint) as weight
    from features join buckets using (word) join gains using (bucket) where side = 's' group by doc_id
), scored as (
    select doc_id, cast(len(words) as bigint) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((
            cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5) / 4294967296))) as bigint) as score
    from lists left join weights using (doc_id) where side = 's'
), ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as place from scored where n_features >= 20
)
select doc_id, n_features, weight, score,
    case when place <= (select count(*) from ranked) * 10 // 100 then place end as rank
from scored left join ranked using (doc_id)
"""


@_query
def op11_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte codes of all vectors, with their errors."""
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return compression.compress(vectors, parts=4, entries=256, rounds=4, scale=1024)


def _compression_sql(rounds: int = 4) -> str:
    """Every part against every entry of its codebook; products of these numbers are exact as doubles."""
    width = "(select len(v) // 4 from whole limit 1)"
    steps = [
        """whole as materialized (
    select vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
    from embeddings
    where embedding is not null
      and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
)""",
        f"""parts as materialized (
    select vec_id, label, part, v[part * {width} + 1 : (part + 1) * {width}] as p
    from whole, range(4) t(part)
)""",
        """book0 as materialized (
    select part, p as entry, row_number() over (partition by part order by vec_id) - 1 as k
    from parts where vec_id in (select vec_id from whole order by vec_id limit 256)
)""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} as materialized (
    select vec_id, label, part, any_value(p) as p, min(256 * cast(list_dot_product(p, p)
        - 2 * list_dot_product(p, entry) + list_dot_product(entry, entry) as bigint) + k) as best
    from parts join book{r} using (part) group by vec_id, label, part
)"""
        )
        if r < rounds:
            steps.append(
                f"""moved{r} as (
    select part, k, list(mean order by place) as entry from (
        select part, best % 256 as k, place, floor(sum(x) / count(*)) as mean
        from (select part, best, unnest(p) as x, generate_subscripts(p, 1) as place from near{r})
        group by all)
    group by part, k
), book{r + 1} as materialized (
    select part, k, coalesce(m.entry, b.entry) as entry
    from book{r} b left join moved{r} m using (part, k)
)"""
            )
    return (
        "with "
        + ", ".join(steps)
        + f""", codes as (
    select vec_id, label, string_agg(right('0' || lower(to_hex(best % 256)), 2), '' order by part) as code,
        cast(sum(best // 256) as bigint) as error
    from near{rounds} group by vec_id, label
), books as (
    select sha256(string_agg(array_to_string(list_transform(entry, lambda x: cast(x as bigint)), ','), ','
        order by part, k)) as codebooks_sha256
    from book{rounds}
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from codes, books
"""
    )


LLM_ORACLES["op11_compression"] = _compression_sql()


@_query
def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: plain forms, and what the trained field adds."""
    model = personal.learn(personal.labelled_lines(spark))
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", personal.find(F.col("text"), model).alias("found")).select(
        "doc_id",
        *(F.col(f"found.n_{kind}").alias(f"n_{kind}") for kind in personal.KINDS),
        F.sha2(F.col("found.plain").cast("binary"), 256).alias("base_sha256"),
        F.col("found.spans").alias("spans"),
    )

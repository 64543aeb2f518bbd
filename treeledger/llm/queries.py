"""The dealt operators as queries over the given tables: ``opN_<name> -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.llm import (
    alignment,
    ann,
    bpe,
    html_text,
    language_model,
    mixing,
    near_dedup,
    pii,
    quality,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from treeledger.llm.common import remainder_of_id, table
from treeledger.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under the name of its function."""
    QUERIES[build.__name__] = build
    return build


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_column(docs, bpe.byte_vocabulary(), decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of every document."""
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as an archive, read it back, and tell each record's payload, digest and kind."""
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.records(table(spark, sf_dir, "pages")), path)
    read = warc.read_archive(spark, path)
    header = F.col("header")
    number = lambda name: F.regexp_extract(warc.field(header, name), "([0-9-]+)>", 1).try_cast("long")
    return read.select(
        number("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        warc.sha1_base32(F.col("payload")).alias("payload_digest"),
        warc.field(header, "WARC-Type").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
    )


ORACLES["op8_warc"] = """
with p as (select page_id, encode(coalesce(html, '')) as body, sha1(encode(coalesce(html, ''))) as h from pages),
r as (select *, max(page_id) over (partition by h) as last from p)
select page_id, octet_length(body)::bigint as payload_bytes,
  array_to_string([array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i, 5))::bigint >> (15 - 5 * j)) & 31)::int, 1)
    for j in range(4)], '') for i in range(8)], '') as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type,
  case when page_id = last then null else last end as refers_to
from r"""


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain limits and robust outliers over all documents."""
    return quality.judged(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        (remainder_of_id("doc_id", toxicity.HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in place of personal data, and how many values of each kind were replaced."""
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are similar to 80 percent."""
    return near_dedup.classes(table(spark, sf_dir, "documents"), width=4, percent=80)


@query
def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and smoothed scores of all texts under a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder_of_id("doc_id", 7) == 2
    model = language_model.train(docs.where(~held_out).select("text"))
    scores = language_model.scored(docs.withColumn("held_out", held_out), model)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document under the three rules for tokens that cross a boundary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, bpe.byte_vocabulary())
    return counted.select("doc_id", F.inline("sections"))


@query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


ORACLES["op6_near_dedup"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 4 then [array_to_string(w, ' ')]
    else [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] end) as s from w),
n as (select doc_id, len(s)::bigint as n, s from s),
e as (select doc_id, n, unnest(s) as x from n),
pairs as (select a.doc_id as a, b.doc_id as b from e a join e b on a.x = b.x and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links as (select a, b from pairs union all select b, a from pairs),
reach as (select doc_id, doc_id as r from n union select reach.doc_id, links.b from reach join links on reach.r = links.a)
select n.doc_id, n.n as n_shingles, min(r) as component_id, n.doc_id = min(r) as kept
from n join reach on reach.doc_id = n.doc_id group by n.doc_id, n.n"""


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of every frequent word of all documents, with their most frequent form and root."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the byte-level and the piece tokenizer over every document, with corpus-wide pair counts."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = alignment.alignment(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by block rules over the whole html."""
    return html_text.main_text(table(spark, sf_dir, "pages"))

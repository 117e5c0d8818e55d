"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apiary.llm import (
    alignment,
    bpe,
    collocations,
    exact_dedup,
    jaccard_join,
    licenses,
    main_text,
    mixing,
    neighbours,
    quality,
    sharding,
    substring_dedup,
    token_counts,
)
from apiary.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest id of each stays."""
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
    return found.select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("_sha")).alias("text_sha256")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.Mix(table(spark, sf_dir, "documents")).per_document()


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded."""
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.default_path())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the windows that a smaller id has."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight contiguous shards of nearly equal bytes."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every text."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), bpe.default_path())


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("_id") % 50 == 0, k=5)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles overlap by 0.9 or more."""
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id"
    )


def op10_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document: three-word shingles overlap by 0.9 or more."""
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "class_id", "n_links"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 collocations of two to five words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.train(pages))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers aligned over every text, with corpus-wide counts of linked id pairs."""
    return alignment.link_counts(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_exact_dedup,
        op3_mixing,
        op4_bpe,
        op5_substring_dedup,
        op6_sharding,
        op7_token_counts,
        op8_license_scan,
        op9_nearest,
        op10_jaccard_join,
        op10_jaccard_links,
        op11_collocations,
        op12_main_text,
        op13_alignment,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op2_exact_dedup": f"""
        with t as (select doc_id, sha256({_LOWER}) as h from documents)
        select doc_id, max(doc_id) over (partition by h) as keep_id,
               count(*) over (partition by h) as group_size,
               doc_id = max(doc_id) over (partition by h) as kept, h as text_sha256
        from t""",
    "op5_substring_dedup": """
        with w as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents
        ), s as (
            select doc_id, unnest(range(1, len(words) - 48)) as i from w where len(words) >= 50
        ), h as (
            select s.doc_id, s.i, list_slice(w.words, s.i, s.i + 49) as seq from s join w using (doc_id)
        ), lowest as (
            select seq, min(doc_id) as lo from h group by seq
        ), gone as (
            select distinct h.doc_id, unnest(range(h.i, h.i + 50)) as i
            from h join lowest using (seq) where lowest.lo < h.doc_id
        ), each as (
            select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from w
        ), kept as (
            select each.doc_id, string_agg(each.word, ' ' order by each.i) as text, count(*) as n
            from each anti join gone on each.doc_id = gone.doc_id and each.i = gone.i group by each.doc_id
        )
        select w.doc_id, len(w.words)::bigint as n_words, len(w.words) - coalesce(kept.n, 0) as n_removed,
               sha256(coalesce(kept.text, '')) as kept_sha256
        from w left join kept using (doc_id)""",
    "op10_jaccard_join": f"""
        with recursive w as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as words from documents
        ), s as (
            select doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) as i from w where len(words) > 0
        ), sets as materialized (
            select distinct doc_id, hash(list_slice(words, i, i + 2)) as g from s
        ), n as materialized (select doc_id, count(*) as n from sets group by doc_id),
        pairs as (
            select a.doc_id as a, b.doc_id as b, count(*) as c
            from sets a join sets b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
        ), links as materialized (
            select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b
            where 100 * c >= 90 * (x.n + y.n - c)
        ), reach as (
            select doc_id, doc_id as r from w
            union
            select reach.doc_id, links.b from reach join links on links.a = reach.r
        )
        select w.doc_id, coalesce(n.n, 0) as n_shingles, min(reach.r) as component_id
        from w join reach using (doc_id) left join n using (doc_id) group by w.doc_id, n.n""",
    "op10_jaccard_links": f"""
        with w as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as words from documents
        ), s as (
            select doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) as i from w where len(words) > 0
        ), sets as materialized (
            select distinct doc_id, hash(list_slice(words, i, i + 2)) as g from s
        ), n as materialized (select doc_id, count(*) as n from sets group by doc_id),
        pairs as (
            select a.doc_id as a, b.doc_id as b, count(*) as c
            from sets a join sets b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
        ), links as (
            select x.doc_id, count(*) as n_links, min(y.doc_id) filter (where c = x.n and c = y.n) as copy
            from pairs join n x on x.doc_id = a join n y on y.doc_id = b
            where 100 * c >= 90 * (x.n + y.n - c) group by 1
        )
        select w.doc_id, least(w.doc_id, coalesce(links.copy, w.doc_id)) as class_id, coalesce(n_links, 0) as n_links
        from w left join links using (doc_id)""",
    "op11_collocations": f"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents
        ), w as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces
        ), n as (
            select lang, sum(len(words))::bigint as n from w group by lang
        ), spots as (
            select lang, words, unnest(range(1, len(words) + 1)) as i from w
        ), f as materialized (
            select lang, k::bigint as k, array_to_string(list_slice(words, i, i + k - 1), ' ') as phrase, count(*) as f
            from spots join (select unnest(range(1, 6)) as k) on i + k - 1 <= len(words) group by all having count(*) >= 100
        ), candidates as materialized (
            select lang, k, phrase, string_split(phrase, ' ') as words, f as a from f where k >= 2
        ), inside as (
            select c.lang, array_to_string(list_slice(words, i, i + m - 1), ' ') as phrase, max(a) as longer
            from candidates c, (select unnest(range(1, 6)) as i), (select unnest(range(2, 5)) as m)
            where m < k and i + m - 1 <= k group by all
        ), cuts as (
            select c.lang, c.phrase, a, j, array_to_string(list_slice(words, 1, j), ' ') as head,
                   array_to_string(list_slice(words, j + 1, k), ' ') as tail
            from candidates c left join inside using (lang, phrase), (select unnest(range(1, 5)) as j)
            where j < k and (longer is null or 100 * longer < 100 * a)
        ), scored as (
            select cuts.lang, cuts.phrase, a, j, h.f as l, t.f as r, n,
                   ((1000::hugeint * a * n) // (h.f::hugeint * t.f))::bigint as score
            from cuts join f h on h.lang = cuts.lang and h.phrase = head
                 join f t on t.lang = cuts.lang and t.phrase = tail join n on n.lang = cuts.lang
        ), best as (
            select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1
        )
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
        from best qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000""",
}

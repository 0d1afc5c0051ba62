"""Registered queries of the corpus operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm import (
    bpe,
    divergence,
    exact_dedup,
    importable,
    licenses,
    neighbours,
    ngram_join,
    packing,
    periodic_runs,
    piece_bpe,
    pii,
    substring_dedup,
    token_files,
    toxicity,
)
from starlane.session import fresh_path

PII_KEY = "surrogates of the test corpus"  # a secret in real use

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find_passages(_table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = pii.replace(_table(spark, sf_dir, "documents"), PII_KEY)
    return new.select("row.doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def _tails(docs: DataFrame) -> DataFrame:
    """Every tenth document, by a check sum of its id, repeats a stretch of itself to its end."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("_words"), F.floor(F.col("_sum") / 10)
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    place = F.sequence(F.lit(0), n - 1)
    tail = F.transform(place, lambda i: F.get("_words", F.when(i < start, i).otherwise(start + (i - start) % period)))
    chosen = (F.col("_sum") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return (
        docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_sum"))
        .withColumn("_words", F.when(chosen, words))
        .select("doc_id", F.when(F.col("_words").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_tails(_table(spark, sf_dir, "documents")))

    def better(a: Column, b: Column) -> Column:
        """The run of more periods; runs come by start and period, and the earlier one stays."""
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", F.aggregate("runs", none, better)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_bpe.encode(_table(spark, sf_dir, "documents"), path, decoded=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_neighbours": op4_neighbours,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_token_files": op9_token_files,
    "op10_license_scan": op10_license_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_divergence": op12_source_divergence,
    "op13_sentencepiece": op13_sentencepiece,
}

EMPTY_LINES = r"( ?\n)( ?\n)+"


def _license_sql() -> str:
    """The licence scan over the same templates, each segment against each."""
    templates = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.TEMPLATES.items())

    def pairs(words: str) -> str:
        return f"list_distinct([{words}[i] || ' ' || {words}[i + 1] for i in range(1, len({words}))])"

    def words(text: str) -> str:
        return f"[w for w in string_split(translate({text}, chr(10), ' '), ' ') if w <> '']"

    def plain(text: str) -> str:
        return rf"regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"

    return f"""
        with docs as (
            select doc_id, {plain("text")} as norm from documents where text is not null
        ), segments as (
            select doc_id, 'line' as kind, unnest(range(len(parts))) as number, unnest(parts) as part
            from (select doc_id, string_split(norm, chr(10)) as parts from docs)
            union all
            select * from (
                select doc_id, 'paragraph', unnest(range(len(parts))), unnest(parts) as part
                from (select doc_id, string_split_regex(norm, '{EMPTY_LINES}') as parts from docs)
            ) where contains(part, chr(10))
            union all
            select doc_id, 'document', 0, norm from docs where regexp_matches(norm, '{EMPTY_LINES}')
        ), found as (
            select doc_id, kind, number, {pairs("words")} as mine
            from (select doc_id, kind, number, {words("part")} as words from segments)
        ), templates as (
            select license, {pairs("words")} as theirs
            from (select license, {words(plain("text"))} as words from (values {templates}) as t(license, text))
        ), scored as (
            select doc_id, kind, number, license, len(list_intersect(mine, theirs)) as shared,
                   2.0::double * len(list_intersect(mine, theirs)) / (len(mine) + len(theirs)) as dice
            from found, templates where len(mine) > 0
        )
        select doc_id, kind, cast(number as integer) as number, license, cast(shared as integer) as shared, dice
        from scored where dice >= {licenses.THRESHOLD}
        qualify row_number() over (partition by doc_id, kind, number order by dice desc, license) = 1
    """


ORACLE: dict[str, str] = {
    "op12_source_divergence": """
        with texts as materialized (
            select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
            from documents
        ), uses as (
            select row, lang, source, unnest(terms) as term from texts
        ), kept as (
            select lang, term, count(*) as lang_count from uses group by lang, term having count(distinct row) >= 30
        ), langs as (
            select lang, count(term) as v, coalesce(sum(lang_count), 0) as n
            from (select distinct lang from texts) left join kept using (lang) group by lang
        ), groups as (
            select distinct lang, source from texts
        ), counted as (
            select lang, source, term, count(*) as c from uses semi join kept using (lang, term) group by all
        ), totals as (
            select lang, source, coalesce(sum(c), 0) as n, any_value(v) as v
            from groups join langs l using (lang) left join counted using (lang, source) group by lang, source
        ), shares as (
            select t.lang, t.source, k.term, coalesce(c, 0) as c, lang_count,
                   1 + (1000000000::hugeint * (coalesce(c, 0) + 5)) // (t.n + 5 * t.v) as p
            from totals t join kept k on k.lang = t.lang
            left join counted d on d.lang = t.lang and d.source = t.source and d.term = k.term
        ), pairs as (
            select x.lang, x.source, 'pair' as part, y.source as item, sum(abs(x.p - y.p)) as value
            from shares x join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source
            group by all
            union all
            select x.lang, x.source, 'pair', y.source, 0
            from groups x join groups y on x.lang = y.lang and x.source <> y.source join langs l on l.lang = x.lang where l.v = 0
        ), more as (
            select s.lang, source, 'term' as part, term as item,
                   p - (1 + (1000000000::hugeint * (lang_count + 5)) // (l.n + 5 * l.v)) as value
            from shares s join langs l on l.lang = s.lang where c > 0
        ), ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
            from (select * from pairs union all select * from more where value > 0)
        )
        select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
        from ranked where part = 'pair' or rank <= 50
    """,
    "op11_periodic_runs": """
        with summed as materialized (
            select doc_id, row_number() over () as row,
                   [w for w in string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if w <> ''] as words,
                   xor(list_reduce(
                       list_concat([4294967295::bigint], [ascii(c)::bigint for c in string_split(cast(doc_id as varchar), '')]),
                       lambda c, b: list_reduce(
                           list_concat([xor(c, b)], [0::bigint for i in range(8)]),
                           lambda d, i: xor(d >> 1, 3988292384::bigint * (d & 1))
                       )
                   ), 4294967295::bigint) as h
            from documents
        ), placed as (
            select *, len(words) as n, (h // 10) % len(words) as a
            from summed where len(words) > 0
        ), spread as (
            select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from placed
        ), texts as (
            select doc_id, row, n, case when h % 10 = 0
                then [words[1 + (case when i < a then i else a + (i - a) % p end)] for i in range(n)] else words end as words
            from spread
        ), grams as (
            -- Words q apart are equal along 16 places or more of a run.
            select row, i, array_to_string(words[i + 1:i + 16], ' ') as gram
            from (select row, words, unnest(range(n - 15)) as i from texts where n >= 24)
        ), equal_grams as (
            select x.row, x.i, y.i - x.i as q
            from grams x join grams y on x.row = y.row and x.gram = y.gram and x.i < y.i
        ), stretches as (
            select row, min(i) as start, max(i) + 16 + q - min(i) as length, q
            from (select *, i - row_number() over (partition by row, q order by i) as island from equal_grams)
            group by row, q, island
        ), runs as (
            -- A stretch that has a period has its multiples too.
            select row, start, length, min(q) as period
            from stretches where length >= greatest(24, 3 * q) group by row, start, length
        ), listed as (
            select row, count(*) as n_runs,
                   arg_max({'s': start, 'l': length, 'p': period}, {'e': length::double / period, 's': -start, 'p': -period}) as best,
                   string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
            from runs group by row
        ), dropped as (
            select distinct row, unnest(range(start + period, start + length)) as i from runs
        ), gone as (
            select row, list(i) as places from dropped group by row
        ), kept as (
            select t.row, array_to_string([t.words[i + 1] for i in range(t.n) if not list_contains(coalesce(g.places, []), i)], ' ') as collapsed
            from texts t left join gone g on g.row = t.row
        )
        select s.doc_id, coalesce(l.n_runs, 0) as n_runs, best['s'] as start, best['l'] as length, best['p'] as period,
               1000 * best['l'] // best['p'] as exponent_milli,
               sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
        from summed s left join listed l on l.row = s.row left join kept k on k.row = s.row
    """,
    "op10_license_scan": _license_sql(),
    "op1_ngram_jaccard_join": """
        with recursive texts as (
            select doc_id, [w for w in string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x20\\x09-\\x0D]+') if w <> ''] as words
            from documents
        ), sets as (
            select distinct doc_id, unnest(case
                when len(words) = 0 then []
                when len(words) < 5 then [array_to_string(words, ' ')]
                else [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)]
            end) as shingle
            from texts
        ), sizes as (
            select doc_id, count(*) as n from sets group by doc_id
        ), shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as overlap
            from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id
        ), links as (
            select a, b from shared
            join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * overlap >= 75 * (x.n + y.n - overlap)
        ), reached as (
            select doc_id as a, doc_id as b from documents
            union
            select r.a, l.b from reached r join links l on r.b = l.a
        )
        select t.doc_id, coalesce(s.n, 0) as n_shingles, (select min(b) from reached where a = t.doc_id) as component_id
        from texts t left join sizes s on s.doc_id = t.doc_id
    """,
    "op2_exact_dedup": """
        select doc_id,
               max(doc_id) over same as keep_id,
               count(*) over same as group_size,
               doc_id is not distinct from max(doc_id) over same as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents
        window same as (partition by coalesce(text, ''))
    """,
}

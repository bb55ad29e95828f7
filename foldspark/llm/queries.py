"""The registered queries of this folder: one per operator, over its whole table, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldspark.llm import (
    blocknames,
    bpe,
    cotrain,
    forest,
    html,
    packing,
    pii,
    repair,
    rules,
    sharding,
    toxicity,
    variants,
    whitening,
)
from foldspark.llm.shared import prepare, shared_folder, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query(
    "op8_block_naming",
    r"""
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS len,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
         w AS (SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
                      first_value(doc_id) OVER (PARTITION BY body ORDER BY len DESC, doc_id) AS keep_id FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM w
    """,
)
def op8_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    """Exact duplicates of all documents."""
    return blocknames.exact_duplicates(_table(spark, folder, "documents"))


@_query(
    "op9_host_rules",
    r"""
    WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    grams AS (SELECT doc_id, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS gram
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
    doubled AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams) WHERE c > 1),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM doubled) GROUP BY 1),
    line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
    same AS (SELECT doc_id, count(*) - 1 AS extra FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
    lines AS (SELECT doc_id, sum(extra)::BIGINT AS n FROM same GROUP BY doc_id),
    m AS (SELECT w.doc_id, w.source, len(words)::BIGINT AS n_words,
                 length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
          FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
    s AS (SELECT *, base_failed OR 100 * n_symbols > 5 * word_chars OR n_dup_lines > 3 AS strict_failed FROM b),
    h AS (SELECT source, count(*)::DOUBLE AS n, sum(strict_failed::INT)::DOUBLE AS f FROM s GROUP BY source),
    t AS (SELECT count(*)::DOUBLE AS h, sum(n) AS n, sum(f) / sum(n) AS mean, sum(f * f / n) AS ff, sum(n * n) AS nn FROM h),
    v AS (SELECT mean, CASE WHEN h > 1 AND mean > 0 AND mean < 1
                 THEN (ff - n * mean * mean - (h - 1) * mean * (1 - mean)) / (n - nn / n) END AS spread FROM t),
    p AS (SELECT mean, CASE WHEN spread > 0 THEN greatest(mean * (1 - mean) / spread - 1, 0) END AS strength FROM v),
    verdict AS (SELECT source, CASE WHEN strength IS NULL THEN mean ELSE (f + mean * strength) / (n + strength) END > 0.3 AS bad_host
                FROM h, p)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, strict_failed, bad_host,
           NOT base_failed AND NOT (bad_host AND strict_failed) AS kept
    FROM s JOIN verdict ON s.source IS NOT DISTINCT FROM verdict.source
    """,
)
def op9_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of all documents, their base rules, and the verdict with their hosts."""
    found = rules.host_rules(_table(spark, folder, "documents"), columns=["doc_id"], write_once=True)
    return found.select(
        "doc_id", *rules.MEASURES, "base_failed", "strict_failed", "bad_host", "kept"
    )


@_query("op10_shortest_pack_first")
def op10_shortest_pack_first(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1,024 ids."""
    packed = packing.pack(_table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), 0)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query("op7_lsh_forest")
def op7_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates of all documents: sets of 3-word shingles, similarity 0.85."""
    found = forest.near_duplicates(_table(spark, folder, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_query("op4_rank_array_bpe")
def op4_rank_array_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by merge ranks and decoded again; digests of both."""
    coded = bpe.encode_and_decode(_table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@_query("op5_grammar_files")
def op5_grammar_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids written as grammar-compressed shards and read back."""
    files = f"{shared_folder(spark)}/grammar-{uuid.uuid4().hex}"
    vocabulary = tokenizer_path("word_bpe_49k.json")
    repair.write(_table(spark, folder, "documents"), files, vocabulary, end_id=1)
    return repair.read(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query("op6_composite_density")
def op6_composite_density(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html.extract(_table(spark, folder, "pages"))


#: Key of the pseudonyms in the registered queries; a real run takes a secret one.
PII_KEY = "corpus"


@_query("op1_feistel_pseudonyms")
def op1_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with personal values replaced by format-preserving pseudonyms."""
    return pii.pseudonymise(_table(spark, folder, "documents"), PII_KEY)


@_query("op3_counterfactual_toxicity")
def op3_counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored for toxicity; labels are learned from four fifths of the ids."""
    docs = _table(spark, folder, "documents")
    model = toxicity.train(docs, _table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@_query("op2_cotrained_quality")
def op2_cotrained_quality(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored for quality by the co-trained text and metadata views."""
    docs = _table(spark, folder, "documents")
    return cotrain.score(docs, cotrain.train(docs, _table(spark, folder, "labels")))


def _crc32_table() -> str:
    """The 256 remainders of CRC-32 as a SQL list, by their rule."""
    rest = list(range(256))
    for _ in range(8):
        rest = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in rest]
    return f"[{', '.join(map(str, rest))}]::BIGINT[]"


def _crc32_sql(blob: str) -> str:
    """CRC-32 of a blob: DuckDB has no such function."""
    octets = f"[('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex({blob}), '..')]"
    step = f"xor(c >> 8, ({_crc32_table()})[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295)"


@_query(
    "op11_proportional_interleaving",
    f"""
    WITH d AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
                      {_crc32_sql("encode(coalesce(text, ''))")} AS text_crc32,
                      substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS lot FROM documents),
         r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY lot, doc_id NULLS FIRST, size, text_crc32) - 1 AS rank,
                      count(*) OVER (PARTITION BY source) AS n FROM d),
         p AS (SELECT *, row_number() OVER (ORDER BY (2 * rank + 1)::DOUBLE / (2 * n)::DOUBLE, lot,
                                                     doc_id NULLS FIRST, size, text_crc32) - 1 AS position,
                      count(*) OVER () AS total FROM r),
         s AS (SELECT *, position * 40 // total AS shard FROM p)
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
           (position - (shard * total + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM s
    """,
)
def op11_proportional_interleaving(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of the mixture of the whole."""
    found = sharding.interleave(_table(spark, folder, "documents"), shards=40)
    return found.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@_query("op12_spectrum_slicing")
def op12_spectrum_slicing(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings projected on their eight leading components, with unit variances."""
    vectors = _table(spark, folder, "embeddings")
    fitted = whitening.fit(vectors, components=8)
    error = whitening.identity_error(vectors, fitted)
    return whitening.transform(vectors, fitted).select(
        "vec_id",
        "component",
        F.lit(fitted.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )


@_query(
    "op13_letter_count_blocks",
    f"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
        FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2),
    lots AS (SELECT run, c, {_crc32_sql("encode(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS lot FROM runs),
    noisy AS (SELECT CASE WHEN lot % 97 = 0 THEN substr(run, 1, lot % length(run)) || substr(run, lot % length(run) + 2)
                     ELSE run END AS word, c FROM lots),
    words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
    cuts AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
             FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS MATERIALIZED (
        SELECT DISTINCT * FROM (
            SELECT a.word, b.word AS other FROM cuts a JOIN cuts b USING (rest, i) WHERE a.word <> b.word
            UNION ALL SELECT cuts.word, w.word FROM cuts JOIN words w ON w.word = cuts.rest
            UNION ALL SELECT w.word, cuts.word FROM cuts JOIN words w ON w.word = cuts.rest)),
    best AS (SELECT near.word, count(*) AS n_near, max(o.n) AS top,
                    min(CASE WHEN o.n = m.top THEN o.word END) AS form
             FROM near JOIN words o ON o.word = near.other
             JOIN (SELECT near.word, max(n) AS top FROM near JOIN words x ON x.word = near.other GROUP BY 1) m ON m.word = near.word
             GROUP BY near.word),
    forms AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 2 * w.n THEN form END AS form,
               CASE WHEN top >= 2 * w.n THEN top END AS form_n
        FROM words w LEFT JOIN best ON best.word = w.word),
    chain AS (SELECT word, word AS at FROM forms
              UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL),
    roots AS (SELECT chain.word, chain.at AS root FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NULL)
    SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN roots ON roots.word = forms.word
    """,
)
def op13_letter_count_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """All words of all documents with their near words and roots."""
    found = variants.variants(_table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")

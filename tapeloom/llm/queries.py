"""Registered queries of the subpackage, each over its whole table, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import (
    ann,
    chat_format,
    decontamination,
    html_extraction,
    lm_scoring,
    minhash_dedup,
    mixing,
    prefix_trie,
    set_join,
    sharding,
    spelling_variants,
    substring_dedup,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(folds)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backoff automaton scores of all documents."""
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by a model of the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    scored = toxicity.score_texts(docs, toxicity.learn(spark, docs, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_extraction.main_texts(spark, table(spark, sf_dir, "pages"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return ann.search(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, count=20)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of 50 words or more which other documents repeat, if only nearly."""
    found = substring_dedup.repeated_passages(spark, table(spark, sf_dir, "documents"))
    return found.filter("repeated_words > 0")


# A conversation whose texts hold the template's own control strings.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted turns."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    parts = chat_format.text_part(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return chat_format.read_back(chat_format.format_turns(turns.union(probe).withColumn("parts", parts)))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: two-word shingles, similarity 0.8."""
    docs = table(spark, sf_dir, "documents")
    return minhash_dedup.near_duplicates(spark, docs, shingle_words=2, percent=80).drop("row")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in a mix of sources by weight, with the shard and the place in it of each copy."""
    plan = mixing.placed_in_order(spark, mixing.mix_plan(spark, table(spark, sf_dir, "documents")))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "placements")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the items, also with exchanged numbers, names or units."""
    marked = decontamination.mark_leaks(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return marked.filter("leaked").select("doc_id", "items", "matched_windows", "reparameterised")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes over all documents."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "text_crc32", F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    )
    return sharding.shard_documents(docs, shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each with the first turns of the first one of its twenty."""
    turns = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    donor = F.col("conv_id") - F.col("conv_id") % 20
    given = prefix_trie.rebuilt(turns, donor, fold("conv_id", 4), most=3)
    return prefix_trie.prefix_trie(spark, given)


def op12_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of three-word n-grams reach a similarity of 0.9."""
    return set_join.similar_sets(spark, table(spark, sf_dir, "documents"), shingle_words=3, percent=90)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the words one edit away and the frequent form they vary."""
    return spelling_variants.spelling_variants(spark, table(spark, sf_dir, "documents"))


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_toxicity": op2_toxicity,
    "op3_html_extraction": op3_html_extraction,
    "op4_ann": op4_ann,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_mixing": op8_mixing,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_set_join": op12_set_join,
    "op13_spelling_variants": op13_spelling_variants,
}

# Turns as the template writes them: the role and the text are escaped, 13 more characters frame them.
_OP6 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *, length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
        + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + 14 AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM sized GROUP BY conv_id
"""

# All pairs of documents that share a shingle, and what links reach.
_OP7 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
        WHEN len(w) = 1 THEN w ELSE [] END) AS shingle
    FROM words
), sizes AS (
    SELECT doc_id, count(shingle) AS n_shingles FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n >= 80 * (x.n_shingles + y.n_shingles - n)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS root FROM sizes
    UNION
    SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.doc_id WHERE r.root < l.b
)
SELECT doc_id, n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n_shingles
"""

# CRC-32 bit by bit over the digits of the id; every prefix of every conversation as its turns' digests.
_OP11 = r"""
WITH turns AS (
    SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS key,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({'key': key, 'words': words} ORDER BY turn NULLS FIRST, key) AS said FROM turns GROUP BY conv_id
), folds AS (
    SELECT conv_id, said, xor(list_reduce(list_concat([4294967295::BIGINT],
        list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda sum, byte: list_reduce(list_concat([xor(sum, byte)], range(8)),
            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h
    FROM own
), rebuilt AS (
    SELECT f.conv_id, list_concat(coalesce(d.said[1:h], []), f.said[h + 1:]) AS said
    FROM folds f LEFT JOIN own d ON d.conv_id = f.conv_id - f.conv_id % 20
), prefixes AS (
    SELECT conv_id, len(said) = depth AS ends, depth, array_to_string(list_transform(said[1:depth], lambda t: t.key), ',') AS path,
        CASE WHEN depth > 0 THEN said[depth].words ELSE 0 END AS words
    FROM (SELECT *, unnest(range(len(said) + 1)) AS depth FROM rebuilt)
), members AS (
    SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node FROM prefixes
), linked AS (
    SELECT m.*, p.node AS parent FROM members m LEFT JOIN members p ON p.conv_id = m.conv_id AND p.depth = m.depth - 1
), nodes AS (
    SELECT node, depth, any_value(parent) AS parent, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM linked GROUP BY node, depth
), children AS (
    SELECT parent AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), described AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node, depth)
), below AS (
    SELECT m.node, m.depth, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
    FROM described n JOIN members m ON m.conv_id = n.node AND m.depth <= n.depth GROUP BY ALL
)
SELECT node AS conv_id, depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM described JOIN below USING (node, depth)
"""

# As above, with three-word shingles and a similarity of 0.9.
_OP12 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 2 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
    FROM words
), sizes AS (
    SELECT doc_id, count(shingle) AS n_shingles FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n >= 90 * (x.n_shingles + y.n_shingles - n)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS root FROM sizes
    UNION
    SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.doc_id WHERE r.root < l.b
)
SELECT doc_id, n_shingles, min(root) AS component_id FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n_shingles
"""

ORACLES: dict[str, str] = {"op6_chat_format": _OP6, "op7_minhash_dedup": _OP7, "op11_prefix_trie": _OP11, "op12_set_join": _OP12}

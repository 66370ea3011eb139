"""The registered queries of this package, and the SQL they are checked against where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embedding_dedup,
    exact_dedup,
    filter_audit,
    fingerprints,
    jaccard_join,
    merkle_manifest,
    packing,
    personal_data,
    quality,
    sentencepiece_codec,
    substring_dedup,
    token_counts,
    token_store,
)
from .common import documents, id_and_text, new_folder, table

PIECES = "piece_bpe_32k.model"


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-store")
    token_store.write(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_store.directory(token_store.read(spark, folder))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir), n=4, percent=85)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.spans_of(documents(spark, sf_dir)))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(PIECES), limit=4096)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(documents(spark, sf_dir), public_tokenizers.path(PIECES))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(documents(spark, sf_dir), words, capacity=4096, end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # three batches, of which the later two meet an index that holds the earlier ones
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "digest-index"), buckets=16)
    found = exact_dedup.in_batches(documents(spark, sf_dir), index, batches=3)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir), width=35)
    return kept.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    trees = quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(id_and_text(docs), trees)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    shown = F.when(chosen, merkle_manifest.lowered(F.col("text").cast("string")))
    return merkle_manifest.verification(merkle_manifest.manifest(documents(spark, sf_dir), shown))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = filter_audit.text_conditions()
    failing = filter_audit.failing_sets(documents(spark, sf_dir), conditions, repeats="E")
    counts = filter_audit.counts_by_set(failing, table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts, "".join(conditions) + "E")


OP7_SQL = """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, {_WORDS.format(_LOWER)} AS words FROM documents
    ), s AS (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
            ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
        FROM w
    ), one AS (
        SELECT doc_id, unnest(shingles) AS shingle FROM s
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
    ), links AS (
        SELECT a, b FROM shared JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.shingles) + len(y.shingles) - n)
    ), edges AS (
        SELECT a, b FROM links UNION SELECT b, a FROM links
    ), reach AS (
        SELECT doc_id AS node, doc_id AS low FROM documents
        UNION SELECT edges.b, reach.low FROM reach JOIN edges ON edges.a = reach.node WHERE reach.low < edges.b
    )
    SELECT s.doc_id, len(s.shingles) AS n_shingles, min(reach.low) AS component_id FROM s JOIN reach ON reach.node = s.doc_id GROUP BY s.doc_id, n_shingles
"""

OP8_SQL = f"""
    WITH w AS (
        SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents
    ), places AS (
        SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w
    ), one AS (
        SELECT doc_id, i, words[i] AS word, CASE WHEN i + 34 <= len(words) THEN sha256(array_to_string(words[i:i + 34], ' ')) END AS passage FROM places
    ), counted AS (
        SELECT *, passage IS NOT NULL AND count(*) OVER (PARTITION BY passage) > 1 AS again FROM one
    ), covered AS (
        SELECT doc_id, i, word, max(again::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted
    ), kept AS (
        SELECT doc_id, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS text FROM covered GROUP BY doc_id
    )
    SELECT w.doc_id, len(w.words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

OP9_SQL = """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    ), fit AS (
        SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), usable AS (
        SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM fit WHERE list_dot_product(e, e) > 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
        WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
    ), reach AS (
        SELECT vec_id AS node, vec_id AS low FROM embeddings
        UNION SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.node WHERE reach.low < links.b
    ), roots AS (
        SELECT node, min(low) AS component_id FROM reach GROUP BY node
    ), counted AS (
        SELECT a, count(*) AS n_links FROM links GROUP BY a
    )
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN roots ON node = vec_id LEFT JOIN counted ON a = vec_id
"""


def _op12_sql(levels: int = 6, fan_out: int = 16) -> str:
    """Trees of up to fan_out^levels leaves a source, and as many sources, level by level."""
    parts = [
        # crc32 of the id's decimal digits, a bit at a time
        """
        WITH crc AS (
            SELECT *, xor(list_reduce(
                list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT),
                lambda c, b: list_reduce(range(0, 8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
                4294967295::BIGINT), 4294967295::BIGINT) % 5 = 0 AS chosen
            FROM (SELECT * FROM documents)
        ), texts AS (
            SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
                concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                text, CASE WHEN chosen THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown
            FROM crc
        ), s0 AS (
            SELECT doc_id, source, i, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
                   sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS claimed, count(*) OVER (PARTITION BY source) AS n
            FROM texts
        )"""
    ]

    def climb(prefix: str, keys: str) -> None:
        for k in range(levels):
            width, by = fan_out**k, ", ".join([*keys.split(), "n"])
            parts.append(f"""
        , {prefix}g{k} AS (SELECT {by}, i // {fan_out} AS i, list(h ORDER BY i) AS hs FROM {prefix}{k} GROUP BY {by}, i // {fan_out})
        , {prefix}{k + 1} AS (SELECT {by}, i, CASE WHEN n <= {width} THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {prefix}g{k})""")

    climb("s", "source")
    parts.append(f"""
        , t0 AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM s{levels})""")
    climb("t", "")
    # a step: the run of a node's level, its place there, and whether the tree has that level at all
    parts.append("""
        , f0 AS (SELECT s0.doc_id, s0.source, s0.i, s0.n, s0.h AS leaf, t0.h AS subroot, t0.i AS ti, t0.n AS tn, s0.claimed AS folded, '' AS proof
                 FROM s0 JOIN t0 ON s0.source IS NOT DISTINCT FROM t0.source)""")
    for step in range(2 * levels):
        k, top = step % levels, step >= levels
        place, size, runs = ("f.ti", "f.tn", f"tg{k}") if top else ("f.i", "f.n", f"sg{k}")
        same = "" if top else "g.source IS NOT DISTINCT FROM f.source AND "
        width = fan_out**k
        at = f"(({place} // {width}) % {fan_out})"
        before, after = f"array_to_string(g.hs[1:{at}], '')", f"array_to_string(g.hs[{at} + 2:], '')"
        parts.append(f"""
        , f{step + 1} AS (
            SELECT f.* EXCLUDE (folded, proof), CASE WHEN {size} <= {width} THEN folded ELSE sha256({before} || folded || {after}) END AS folded,
                   CASE WHEN {size} <= {width} THEN proof ELSE proof || {before} || {after} END AS proof
            FROM f{step} f JOIN {runs} g ON {same}g.i = {place} // {width * fan_out})""")
    parts.append(f"""
        SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
        FROM f{2 * levels} JOIN t{levels} t ON true""")
    return "".join(parts)


OP13_SQL = """
    WITH texts AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
        FROM documents
    ), marks AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
    ), failing AS (
        SELECT part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
            + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
            + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS failing,
            coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
        FROM texts t LEFT JOIN marks m ON m.doc_id = t.doc_id
    ), counts AS (
        SELECT part, failing, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL
    ), letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
    ), orders AS (
        SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
    ), steps AS (
        SELECT filter_order, step::INT AS step, bits[step] AS bit, list_sum(bits[1:step - 1])::INT AS state
        FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
    ), each_step AS (
        SELECT part, filter_order, step, bit,
            sum(n) FILTER (failing & (coalesce(state, 0) | bit) = 0) AS kept,
            sum(n) FILTER (failing & coalesce(state, 0) = 0 AND failing & bit > 0) AS removed,
            sum(n) FILTER (failing & coalesce(state, 0) > 0 AND failing & bit > 0) AS redundant,
            sum(n) FILTER (failing = bit) AS unique_fails,
            sum(good) FILTER (failing & coalesce(state, 0) = 0 AND failing & bit > 0) AS good_lost,
            sum(toxic) FILTER (failing & coalesce(state, 0) = 0 AND failing & bit > 0) AS toxic_lost
        FROM counts, steps GROUP BY ALL
    )
    SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
        coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
        coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
    FROM each_step
"""

QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_personal_data": op3_personal_data,
    "op4_token_counts": op4_token_counts,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_quality": op10_quality,
    "op11_fingerprints": op11_fingerprints,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {
    "op2_jaccard_join": OP2_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_embedding_dedup": OP9_SQL,
    "op12_merkle_manifest": _op12_sql(),
    "op13_filter_audit": OP13_SQL,
}

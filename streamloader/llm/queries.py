"""One query per operator: whole tables in, the digest columns of its contract out."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamloader.llm import (
    adaptive_rules,
    bucket_shuffle,
    disclosure,
    hmm_scoring,
    merkle_manifest,
    nnls_packing,
    nnpu_toxicity,
    ppm_language,
    pq_neardup,
    rule_ensemble,
    segment_tree_bpe,
    simhash_bktree,
    spelling_variants,
)
from streamloader.llm.common import cut, discard, scratch_path, table


def op1_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nnls_packing.pack(table(spark, sf_dir, "documents"))


def op2_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "scanned")
    found = disclosure.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",), path=path)
    return disclosure.digest(found, path)


def op3_bucket_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shuffled")
    shuffled = bucket_shuffle.shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    body = F.coalesce(F.col("record.text").cast("binary"), F.lit(b""))
    written = shuffled.select(
        "bucket",
        "place",
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    digest = cut(written)
    discard(spark, path)
    return bucket_shuffle.place_in_shards(digest).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_rules.judge(table(spark, sf_dir, "documents")).drop("lang", "source", "n_lines")


def op5_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "encoded")
    scored = cut(hmm_scoring.score(table(spark, sf_dir, "documents"), path=path))
    discard(spark, path)
    return scored


def op6_pq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bktree.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "kept")


def op8_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_tree_bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.predict(table(spark, sf_dir, "documents"))


def op10_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nnpu_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle_manifest.manifest(table(spark, sf_dir, "documents"))
    proof = F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256")
    digests = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")]
    return proved.select("doc_id", *digests, proof, "verified")


def op12_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nnls_packing": op1_nnls_packing,
    "op2_disclosure": op2_disclosure,
    "op3_bucket_shuffle": op3_bucket_shuffle,
    "op4_adaptive_rules": op4_adaptive_rules,
    "op5_hmm_scoring": op5_hmm_scoring,
    "op6_pq_neardup": op6_pq_neardup,
    "op7_simhash_bktree": op7_simhash_bktree,
    "op8_segment_tree_bpe": op8_segment_tree_bpe,
    "op9_ppm_language": op9_ppm_language,
    "op10_nnpu_toxicity": op10_nnpu_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_rule_ensemble": op12_rule_ensemble,
    "op13_spelling_variants": op13_spelling_variants,
}

_SIGNAL_SQL = """
      SELECT rid, lang, source, 'word_length' AS signal, word_chars / n_words + {offset} AS v FROM base WHERE n_words > 0
      UNION ALL SELECT rid, lang, source, 'symbols', n_symbols / n_words + {offset} FROM base WHERE n_words > 0
      UNION ALL SELECT rid, lang, source, 'dup_lines', n_dup_lines / n_lines + {offset} FROM base WHERE n_lines > 0
      UNION ALL SELECT rid, lang, source, 'repeats', n_repeat_words / n_words + {offset} FROM base WHERE n_words > 0
""".format(offset=adaptive_rules.OFFSET)

_FENCES_SQL = """
      SELECT {keys} signal, max(total) AS total,
             min(CASE WHEN upto * 4 >= total THEN bin END) AS q1, min(CASE WHEN upto * 4 >= total * 3 THEN bin END) AS q3
      FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} signal ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {keys} signal) AS total
            FROM (SELECT {keys} signal, bin, count(*) AS n FROM bins GROUP BY ALL))
      GROUP BY ALL
"""

_REACH_SQL = f"greatest((q3 - q1) * {adaptive_rules.FENCE}, ceil({adaptive_rules.SLACK!r} / ln({adaptive_rules.GAMMA})))"

# crc32 by its table of 256 entries, which SQL builds from the polynomial; {bytes} are numbers from 0 to 255.
_CRC_TABLE_SQL = """
    crc_table AS (SELECT list(list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t
                  FROM range(256) r(i))"""
_CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes}),"
    " lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::INT + 1])), 4294967295::UBIGINT)"
)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _levels_sql(name: str, nodes: str) -> str:
    """A table of all levels of trees of three: (tree, level, pos, width, h), each level from the one below."""
    return f"""{name} AS (
        SELECT * FROM {nodes}
        UNION ALL
        SELECT tree, level + 1, pos // 3, (width + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE width > 1 GROUP BY ALL)"""


_FIELDS_SQL = " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))

# A leaf climbs its source's tree, then the tree over the sources; `side` tells the two.
_MERKLE_SQL = f"""
    WITH RECURSIVE {_CRC_TABLE_SQL.strip()},
    d AS (SELECT doc_id, source, text, sha256({_FIELDS_SQL} || {_field_sql("text")}) AS leaf,
            sha256({_FIELDS_SQL} || {_field_sql("replace(text, chr(10), '')")}) AS broken,
            coalesce({_CRC_SQL.format(bytes="list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)")} % 2 = 0, false) AS hit
          FROM documents, crc_table),
    sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
                FROM (SELECT DISTINCT source FROM documents)),
    placed AS (SELECT d.*, tree, trees, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                 count(*) OVER (PARTITION BY tree) AS width
               FROM d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source),
    first_level AS (SELECT tree, 0::BIGINT AS level, pos, width, leaf AS h FROM placed),
    {_levels_sql("low", "first_level")},
    subroots AS (SELECT -1::BIGINT AS tree, 0::BIGINT AS level, tree AS pos, (SELECT count(*) FROM sources) AS width, h FROM low WHERE width = 1),
    {_levels_sql("high", "subroots")},
    nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
    climb AS (
        SELECT doc_id, leaf, tree AS own, tree, 0::BIGINT AS level, pos, width, trees,
               CASE WHEN hit THEN broken ELSE leaf END AS f, '' AS proof FROM placed
        UNION ALL
        SELECT doc_id, leaf, own,
               CASE WHEN width = 1 THEN -1 ELSE tree END, CASE WHEN width = 1 THEN 0 ELSE level + 1 END,
               CASE WHEN width = 1 THEN tree ELSE pos // 3 END, CASE WHEN width = 1 THEN trees ELSE (width + 2) // 3 END, trees,
               CASE WHEN width = 1 THEN f ELSE sha256(coalesce(before, '') || f || coalesce(after, '')) END,
               proof || CASE WHEN width = 1 THEN '' ELSE coalesce(before, '') || coalesce(after, '') END
        FROM (SELECT c.doc_id, c.leaf, c.own, c.tree, c.level, c.pos, c.width, c.trees, c.f, c.proof,
                string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < c.pos) AS before,
                string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > c.pos) AS after
              FROM climb c JOIN nodes n ON n.tree = c.tree AND n.level = c.level AND n.pos // 3 = c.pos // 3
              WHERE c.width > 1 OR c.tree >= 0 GROUP BY ALL))
    SELECT c.doc_id, c.leaf, s.h AS subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.f AS folded_root, c.f = r.h AS verified
    FROM climb c JOIN subroots s ON s.pos = c.own, (SELECT h FROM high WHERE width = 1) r
    WHERE c.tree = -1 AND c.width = 1
"""

# Words with one letter replaced are equal without the letter in that place; a longer word is equal without one of its letters.
_VARIANTS_SQL = f"""
    WITH RECURSIVE {_CRC_TABLE_SQL.strip()},
    runs AS (SELECT doc_id, run, count(*) AS n
             FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
             GROUP BY ALL),
    named AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS code FROM runs),
    hashed AS (SELECT run, n,
                 {_CRC_SQL.format(bytes="list_transform(range(0, length(code) // 2), lambda i: ('0x' || substr(code, (2 * i + 1)::INT, 2))::UBIGINT)")} AS h
               FROM named, crc_table),
    words AS (SELECT word, sum(n)::BIGINT AS n
              FROM (SELECT n, CASE WHEN h % {spelling_variants.DAMAGED} = 0
                                   THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
              WHERE length(word) >= {spelling_variants.LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {spelling_variants.LEAST_COUNT}),
    less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
             FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
    cut AS (SELECT DISTINCT l.word AS long, l.n AS long_n, w.word AS short, w.n AS short_n FROM less l JOIN words w ON l.rest = w.word),
    near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
             UNION ALL SELECT long, short, short_n FROM cut
             UNION ALL SELECT short, long, long_n FROM cut),
    best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
    judged AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN near_n >= {spelling_variants.FACTOR} * w.n THEN near END AS form, CASE WHEN near_n >= {spelling_variants.FACTOR} * w.n THEN near_n END AS form_n
               FROM words w LEFT JOIN best USING (word)),
    chain AS (SELECT word, word AS at, form AS next FROM judged
              UNION ALL SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON j.word = c.next)
    SELECT word, form, c.at AS root, n, n_near, form_n FROM judged JOIN chain c USING (word) WHERE c.next IS NULL
"""

# The other operators cannot be said in SQL; they are tested against brute force (tests/llm).
ORACLES: dict[str, str] = {
    "op4_adaptive_rules": f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS body FROM documents),
    w AS (SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
            list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    windows AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS g
                FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
    twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
    covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rid),
    base AS (SELECT rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
               length(array_to_string(words, ''))::BIGINT AS word_chars,
               length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
             FROM w LEFT JOIN covered USING (rid)),
    bins AS (SELECT rid, lang, source, signal, ceil(ln(v) / {math.log(adaptive_rules.GAMMA)!r})::INT AS bin FROM ({_SIGNAL_SQL})),
    own AS ({_FENCES_SQL.format(keys="lang, source,")}),
    whole AS ({_FENCES_SQL.format(keys="")}),
    fences AS (SELECT own.lang, own.source, signal,
                 CASE WHEN own.total >= {adaptive_rules.LEAST_ROWS} THEN own.low ELSE a.low END AS low,
                 CASE WHEN own.total >= {adaptive_rules.LEAST_ROWS} THEN own.high ELSE a.high END AS high
               FROM (SELECT *, q1 - {_REACH_SQL} AS low, q3 + {_REACH_SQL} AS high FROM own) own
               JOIN (SELECT *, q1 - {_REACH_SQL} AS low, q3 + {_REACH_SQL} AS high FROM whole) a USING (signal)),
    odd AS (SELECT DISTINCT b.rid FROM bins b JOIN fences f
            ON b.signal = f.signal AND b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
            WHERE b.bin > f.high OR (b.signal = 'word_length' AND b.bin < f.low))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
           NOT failed AND rid NOT IN (SELECT rid FROM odd) AS kept
    FROM (SELECT *, n_words < {adaptive_rules.MIN_WORDS} OR 100 * n_repeat_words > {adaptive_rules.MAX_REPEAT_PERCENT} * n_words AS failed FROM base)
    """,
    "op11_merkle_manifest": _MERKLE_SQL,
    "op13_spelling_variants": _VARIANTS_SQL,
}

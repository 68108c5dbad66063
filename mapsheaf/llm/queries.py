"""The operators as queries over the driver's tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.llm import bpe, decontaminate, langid, lattice, secrets, sharding
from mapsheaf.llm.collocations import collocations
from mapsheaf.llm.common import table
from mapsheaf.llm.embeddings import embedding_groups
from mapsheaf.llm.exact_spans import remove_repeated_bytes
from mapsheaf.llm.licenses import find_licenses, summary
from mapsheaf.llm.simhash import simhash_groups
from mapsheaf.llm.substrings import remove_repeats
from mapsheaf.llm.tries import prefix_trie

Run = Callable[[SparkSession, str], DataFrame]

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
UNIGRAM_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.pack(table(spark, sf_dir, "documents"), shards=8)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeated_bytes(table(spark, sf_dir, "documents"), length=100)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, start = lattice.vocabulary(UNIGRAM_MODEL)
    return lattice.score(table(spark, sf_dir, "documents"), pieces, start, folds=10, held_out=0)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), folds=3, held_out=1)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(
        table(spark, sf_dir, "documents"), bpe.load_ranks(BPE_RANKS), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(find_licenses(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Run] = {
    "op1_sharding": op1_sharding,
    "op2_secret_scan": op2_secret_scan,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_lm_score": op4_lm_score,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_license_scan": op13_license_scan,
}

SQL: dict[str, str] = {
    "op3_suffix_dedup": r"""
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS e FROM documents),
        place AS (SELECT doc_id, e, unnest(range(0, octet_length(e))) AS p FROM d),
        part AS (SELECT doc_id, p, hex(e[p + 1:p + 1]) AS byte,
                        CASE WHEN p + 100 <= octet_length(e) THEN md5_number(e[p + 1:p + 100]) END AS s FROM place),
        first AS (SELECT s, min((doc_id::HUGEINT << 40) + p) AS least FROM part WHERE s IS NOT NULL GROUP BY s),
        again AS (SELECT doc_id, p, byte, coalesce((doc_id::HUGEINT << 40) + p > least, false) AS again
                  FROM part LEFT JOIN first USING (s)),
        covered AS (SELECT doc_id, p, byte, sum(again::INT) OVER (
                        PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) > 0 AS gone FROM again),
        run AS (SELECT *, lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM covered),
        kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND NOT before) AS n_spans,
                        string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS k FROM run GROUP BY doc_id)
        SELECT doc_id, octet_length(e)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op7_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        usable AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
                   AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
        link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
                 ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
                 WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        counted AS (SELECT a, count(*) AS n FROM link GROUP BY a),
        least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
               least(vec_id, coalesce(b, vec_id)) = vec_id AS kept
        FROM v LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id""",
    "op8_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM documents),
        i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM benchmark),
        dt AS (SELECT doc_id, len(t) AS n, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS p FROM d),
        it AS (SELECT item_id, len(t) AS n, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS p FROM i WHERE len(t) >= 13),
        hit AS (SELECT doc_id, item_id, dt.p, dt.p - it.p AS diagonal,
                       least(dt.n, dt.p - it.p + it.n) - greatest(0, dt.p - it.p) AS aligned FROM dt JOIN it USING (w)),
        run AS (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY p
                              RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS inside,
                       count(*) OVER (PARTITION BY doc_id, item_id, diagonal) AS matched FROM hit),
        best AS (SELECT doc_id, item_id, max(row(matched, aligned, -greatest(0, diagonal))) AS b FROM run
                 WHERE inside >= 11 AND aligned >= 13 GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, b[1]::BIGINT AS matched, b[2]::BIGINT AS aligned, -b[3]::BIGINT AS doc_start FROM best""",
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)),
        first AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM win JOIN first USING (s) WHERE least < doc_id),
        word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS c
                 FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(c, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_prefix_trie": r"""
        WITH turns AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST,
                           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
                       FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        crc AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
                    lambda x, n: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) AS t(i)),
        digits AS (SELECT conv_id, 1 AS at, conv_id::VARCHAR AS d FROM turns),
        tab AS (SELECT list(v ORDER BY i) AS t FROM crc),
        hashed AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT,
                       list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
                       lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 9 AS h FROM turns, tab),
        rebuilt AS (SELECT c.conv_id AS c, coalesce(b.own[1:h], []) || coalesce(c.own[h + 1:], []) AS seq
                    FROM turns c JOIN hashed USING (conv_id) LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5),
        pre AS (SELECT c, d, seq[1:d] AS node, len(seq) AS n, CASE WHEN d > 0 THEN strlen(seq[d].t) ELSE 0 END AS size
                FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
        node AS (SELECT d, node, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                        bool_or(n > d) AS inner_node, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c)
                            FILTER (n = d), '')) AS ends_sha256 FROM pre GROUP BY d, node),
        up AS (SELECT a.d, a.conv_id, p.conv_id AS parent, a.node FROM node a JOIN node p ON p.d = a.d - 1 AND p.node = a.node[1:a.d - 1]),
        kids AS (SELECT d - 1 AS d, parent AS conv_id, count(*) AS n FROM up GROUP BY ALL),
        below AS (SELECT anc.d, anc.conv_id, count(*) FILTER (NOT x.inner_node) AS leaves,
                         sum((x.n_convs - 1) * x.size)::BIGINT AS saved
                  FROM node x JOIN pre ON pre.c = x.conv_id AND pre.d <= x.d
                  JOIN node anc ON anc.d = pre.d AND anc.node = pre.node GROUP BY ALL)
        SELECT a.conv_id, a.d AS depth, up.parent AS parent_conv_id, a.n_convs, coalesce(kids.n, 0) AS n_children,
               leaves AS n_leaves, saved AS saved_tokens, a.ends_sha256
        FROM node a JOIN below ON below.d = a.d AND below.conv_id = a.conv_id
        LEFT JOIN up ON up.d = a.d AND up.conv_id = a.conv_id LEFT JOIN kids ON kids.d = a.d AND kids.conv_id = a.conv_id""",
    "op12_collocations": r"""
        WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        split AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
        total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
        gram AS (SELECT lang, w[i:i + k - 1] AS words, count(*) AS f
                 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split), range(1, 6) AS size(k)
                 WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
        cut AS (SELECT g.lang, g.words, g.f AS a, k, x.f AS l, y.f AS r, n,
                       ((1000::HUGEINT * g.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
                FROM (SELECT *, unnest(range(1, len(words))) AS k FROM gram) g
                JOIN gram x ON x.lang = g.lang AND x.words = g.words[1:k]
                JOIN gram y ON y.lang = g.lang AND y.words = g.words[k + 1:]
                JOIN total ON total.lang = g.lang),
        best AS (SELECT lang, words, min(row(score, k, a, l, r, n)) AS c FROM cut GROUP BY ALL),
        inside AS (SELECT lang, words[i:i + k - 1] AS words, max(f) AS longer
                   FROM (SELECT *, unnest(range(1, len(words))) AS i FROM gram), range(2, 5) AS size(k)
                   WHERE k < len(words) AND i + k - 1 <= len(words) GROUP BY ALL),
        kept AS (SELECT lang, array_to_string(words, ' ') AS phrase, c[3] AS a, c[4] AS l, c[5] AS r, c[6] AS n, c[1] AS score
                 FROM best LEFT JOIN inside USING (lang, words) WHERE longer IS NULL OR 100 * longer < 100 * c[3])
        SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (
            PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000""",
}

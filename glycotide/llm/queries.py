"""The registered queries of this subpackage and their SQL, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glycotide.llm import exact_dedup, hamming_topk, line_dedup, packing, piece_sampling, prefix_trie, quality, repeated_spans, setsketch, token_planes, toxicity, vector_codes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sum_of_squares_packing")
def op1(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


@query(
    "op6_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op6(spark, sf_dir):
    import uuid

    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), f"digest_index_{uuid.uuid4().hex}")


@query("op9_token_bit_planes")
def op9(spark, sf_dir):
    return token_planes.token_files_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query("op10_suffix_interval_dedup")
def op10(spark, sf_dir):
    return repeated_spans.remove_repeated(table(spark, sf_dir, "documents"), length=400, kept=True)


@query("op8_setsketch_near_dedup")
def op8(spark, sf_dir):
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), 75, 100, k=5)


@query(
    "op7_warc_shards",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
         d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
         k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keep FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND keep <> page_id THEN keep END AS refers_to
    FROM k
    """,
)
def op7(spark, sf_dir):
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


@query(
    "op5_line_dedup",
    r"""
    WITH l AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no
      FROM documents),
    s AS (SELECT doc_id, line_no, list_distinct(regexp_extract_all(line, '[^ \t\x0B\f\r]+')) AS words FROM l),
    n AS (SELECT doc_id, line_no, list_sort(words) AS words, len(words) AS size FROM s WHERE len(words) > 0),
    u AS (SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, line_no) AS copy, row_number() OVER (ORDER BY doc_id, line_no) AS id FROM n),
    f AS (SELECT * FROM u WHERE copy = 1),
    t AS (SELECT id, size, unnest(words) AS word FROM f),
    p AS (SELECT b.id FROM t a JOIN t b ON a.word = b.word AND a.id < b.id AND 10 * a.size >= 9 * b.size AND 10 * b.size >= 9 * a.size
          GROUP BY b.id, a.id, a.size, b.size HAVING 10 * count(*) >= 9 * (a.size + b.size - count(*))),
    r AS (SELECT doc_id, line_no FROM u WHERE copy > 1 OR id IN (SELECT id FROM p)),
    g AS (SELECT doc_id, count(*) AS n_removed, string_agg(line_no, ',' ORDER BY line_no) AS removed FROM r GROUP BY doc_id)
    SELECT d.doc_id, len(string_split(coalesce(d.text, ''), chr(10))) AS n_lines, coalesce(g.n_removed, 0) AS n_removed, g.removed
    FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
    """,
)
def op5(spark, sf_dir):
    return line_dedup.line_counts(table(spark, sf_dir, "documents"), 9, 10)


@query(
    "op4_hamming_top_k",
    """
    WITH b AS (SELECT vec_id, unnest(embedding) > 0 AS bit, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT * FROM b WHERE i <= 64),
    d AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbour_id, sum(CASE WHEN q.bit <> v.bit THEN 1 ELSE 0 END) AS distance
          FROM c q JOIN c v ON q.i = v.i AND q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
    r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank, neighbour_id, distance FROM d)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, CAST(distance AS INTEGER) AS distance FROM r WHERE rank <= 10
    """,
)
def op4(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return hamming_topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=10, dims=64)


@query("op3_ordinal_quality")
def op3(spark, sf_dir):
    return quality.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_sampled_pieces")
def op2(spark, sf_dir):
    return piece_sampling.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), seed=1)


def lloyd_sql(parts: int = 4, width: int = 16, rounds: int = 4) -> str:
    """The rounds one after the other; whole numbers below 2^53 are exact as doubles."""
    steps = [
        f"""v AS MATERIALIZED (
              SELECT vec_id, label, [floor(1024 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
              WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0 AND len(embedding) > 0),
            y AS MATERIALIZED (SELECT vec_id, p, x[{width} * p + 1 : {width} * p + {width}] AS y FROM v, range({parts}) r(p)),
            c0 AS MATERIALIZED (SELECT p, CAST(r - 1 AS INTEGER) AS e, y AS c FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS r FROM y) WHERE r <= 256)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
              SELECT y.vec_id, y.p, min(struct_pack(d := CAST(list_inner_product(y, y) + list_inner_product(c, c) - 2 * list_inner_product(y, c) AS BIGINT), e := e)) AS best
              FROM y JOIN c{i} ON y.p = c{i}.p GROUP BY ALL)"""
        )
        if i < rounds:
            means = ", ".join(f"floor(sum(y[{j}]) / count(*))" for j in range(1, width + 1))
            steps.append(
                f"""m{i} AS (SELECT y.p, best.e AS e, [{means}] AS c FROM a{i} JOIN y ON a{i}.vec_id = y.vec_id AND a{i}.p = y.p GROUP BY y.p, best.e),
                c{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (p, e))"""
            )
    return f"""
    WITH {", ".join(steps)},
    f AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
    b AS (SELECT sha256(string_agg(array_to_string([CAST(i AS BIGINT) FOR i IN c], ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f JOIN v USING (vec_id), b
    """


@query("op11_vector_codes", lloyd_sql())
def op11(spark, sf_dir):
    return vector_codes.codes(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)


@query("op12_factorization_toxicity")
def op12(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op13_prefix_trie",
    """
    WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
               FROM conversations WHERE conv_id IS NOT NULL),
    b AS (SELECT conv_id, list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')], lambda s, x:
            list_reduce([xor(s, x)] || CAST(range(8) AS BIGINT[]), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS state
          FROM (SELECT DISTINCT conv_id FROM t)),
    k AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(state, 4294967295) % 6 AS h FROM b),
    n AS (SELECT k.*, least(h, (SELECT count(*) FROM t WHERE t.conv_id = k.base)) AS taken FROM k),
    r AS (SELECT n.conv_id, t.pos, role, text FROM n JOIN t ON t.conv_id = n.base AND t.pos < n.h
          UNION ALL SELECT n.conv_id, t.pos - h + taken, role, text FROM n JOIN t ON t.conv_id = n.conv_id AND t.pos >= n.h),
    m AS (SELECT conv_id, 0 AS depth, [] AS path, 0 AS chars FROM k
          UNION ALL SELECT conv_id, pos + 1, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos), length(text) FROM r),
    d AS (SELECT conv_id, max(depth) AS ends FROM m GROUP BY conv_id),
    o AS MATERIALIZED (SELECT m.*, ends = depth AS ends_here, min(conv_id) OVER (PARTITION BY depth, path) AS node FROM m JOIN d USING (conv_id)),
    g AS (SELECT node, depth, count(*) AS n_convs, any_value(chars) * (count(*) - 1) AS saved,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends_here), '')) AS ends_sha256
          FROM o GROUP BY node, depth),
    e AS (SELECT g.*, o.node AS parent FROM g LEFT JOIN o ON o.conv_id = g.node AND o.depth = g.depth - 1),
    c AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM e GROUP BY parent, e.depth),
    u AS (SELECT o.node, o.depth, sum(e.saved) AS saved_tokens, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves
          FROM e LEFT JOIN c ON c.parent = e.node AND c.depth = e.depth JOIN o ON o.conv_id = e.node AND o.depth <= e.depth GROUP BY o.node, o.depth)
    SELECT e.node AS conv_id, CAST(e.depth AS BIGINT) AS depth, e.parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM e JOIN u ON u.node = e.node AND u.depth = e.depth LEFT JOIN c ON c.parent = e.node AND c.depth = e.depth
    """,
)
def op13(spark, sf_dir):
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations"), 100, 6))


@query("pipeline")
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)

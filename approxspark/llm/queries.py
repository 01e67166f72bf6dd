"""Registered queries of the training-data operators, and DuckDB SQL where SQL expresses one."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from ..sources.tables import table
from . import chat, embedding_dedup, exact_dedup, grammar, language_id, lexical_search, license_scan, lm_scoring, merkle, minhash_dedup, mixing, packing, secret_scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return deco


@register(
    "op2_mixing",
    """
    WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
                      md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
    r AS (SELECT *, row_number() OVER (ORDER BY 2 * source_size / weight, source NULLS LAST) AS i FROM w),
    l AS (SELECT a.i, (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - coalesce((SELECT sum(2 * b.source_size) FROM r b WHERE b.i < a.i), 0))
                 / (SELECT sum(b.weight) FROM r b WHERE b.i >= a.i) AS level, a.source_size, a.weight FROM r a),
    f AS (SELECT level FROM l WHERE 2 * source_size >= level * weight ORDER BY i LIMIT 1),
    t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT level FROM f) * weight) AS target FROM w),
    c AS (SELECT d.doc_id, d.size, t.source_size, t.target,
                 CAST(floor(t.target) AS BIGINT) // greatest(t.source_size, 1) AS passes, CAST(floor(t.target) AS BIGINT) % greatest(t.source_size, 1) AS rest,
                 CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, size * passes + greatest(0, least(size, rest - before)) AS taken FROM c
    """,
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register(
    "op4_exact_dedup",
    """
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
    k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
    """,
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@register(
    "op1_minhash_dedup",
    """
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
    n AS (SELECT doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_shingles FROM s),
    x AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s),
    l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
    SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c ON doc_id = a
    """,
)
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@register("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.identify(docs, model).withColumn("held_out", language_id.held_out())


@register("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.held_out(mod=10, rest=0)
    scores = lm_scoring.score(table(spark, sf_dir, "documents"), train=~held_out)
    return scores.withColumn("held_out", held_out)


@register("op10_token_ids")
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, _ = grammar.write(table(spark, sf_dir, "documents"))
    return grammar.read(blocks).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@register(
    "op9_embedding_dedup",
    """
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
    n AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a)
    SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
    """,
)
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@register(
    "op7_chat_formatting",
    """
    WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos, {'r': role, 't': text} AS u,
                      '<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS said FROM conversations),
    c AS (SELECT conv_id, list(u ORDER BY pos) AS l, string_agg(said, '' ORDER BY pos) AS chat FROM t GROUP BY conv_id),
    k AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, l, any_value(chat) AS chat FROM c GROUP BY l)
    SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns, n_copies, chat FROM k
    WHERE NOT EXISTS (SELECT 1 FROM k b WHERE b.l[1] = k.l[1] AND len(b.l) > len(k.l) AND b.l[1:len(k.l)] = k.l)
    """,
)
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


_TEMPLATES = ", ".join(f"({i}, '{lic}', '{text}')" for i, (lic, text) in enumerate(license_scan.TEMPLATES))


@register(
    "op6_license_scan",
    f"""
    WITH d AS (SELECT doc_id, coalesce(source, 'unknown') AS s, coalesce(lang, 'unknown') AS l, coalesce(text, '') AS t FROM documents),
    n AS (SELECT count(*) AS n FROM d),
    tw AS (SELECT i, license, w, count(*) AS c FROM (SELECT i, license, unnest(regexp_split_to_array(lower(txt), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM (VALUES {_TEMPLATES}) AS v(i, license, txt)) WHERE w <> '' GROUP BY ALL),
    df AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(t), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM d) WHERE w IN (SELECT w FROM tw)) GROUP BY w),
    idf AS (SELECT DISTINCT w, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM tw LEFT JOIN df USING (w), n),
    tv AS (SELECT i, license, w, x / sqrt(sum(x * x) OVER (PARTITION BY i)) AS x FROM (SELECT i, license, w, (1 + ln(c)) * idf AS x FROM tw JOIN idf USING (w))),
    seg AS (SELECT doc_id, 0 AS k, t FROM d UNION ALL
            SELECT doc_id, 1, unnest(string_split(regexp_replace(t, '([.!?;])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))) FROM d),
    num AS (SELECT row_number() OVER () AS g, doc_id, k, regexp_split_to_array(lower(t), '[^\\p{{L}}\\p{{N}}]+') AS w FROM (SELECT DISTINCT * FROM seg)),
    sw AS (SELECT g, doc_id, k, w, (1 + ln(count(*))) * coalesce(any_value(idf), ln(1 + any_value(n)) + 1) AS y FROM (SELECT g, doc_id, k, unnest(w) AS w FROM num) LEFT JOIN idf USING (w), n WHERE w <> '' GROUP BY g, doc_id, k, w),
    nm AS (SELECT g, sqrt(sum(y * y)) AS norm FROM sw GROUP BY g),
    hit AS (SELECT doc_id, k, license, round(sum(x * y) / any_value(norm), 6) AS score FROM sw JOIN tv USING (w) JOIN nm USING (g) GROUP BY g, doc_id, k, i, license HAVING round(sum(x * y) / any_value(norm), 6) >= 0.7),
    own AS (SELECT doc_id, license, score, CASE WHEN k = 0 THEN 'file' ELSE 'header' END AS origin FROM hit QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, k, license DESC) = 1),
    dir AS (SELECT s || '/' || l AS dir, license, score FROM own JOIN d USING (doc_id) WHERE origin = 'file' QUALIFY row_number() OVER (PARTITION BY s, l ORDER BY score DESC, license DESC) = 1)
    SELECT doc_id, s || '/' || l || '/' || doc_id AS path, coalesce(own.license, dir.license) AS license, coalesce(own.score, dir.score) AS score,
           coalesce(own.origin, CASE WHEN dir.dir IS NOT NULL THEN 'inherited' END) AS origin, CASE WHEN own.doc_id IS NULL THEN dir.dir END AS from_dir
    FROM d LEFT JOIN own USING (doc_id) LEFT JOIN dir ON dir.dir = s || '/' || l
    """,
)
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table has no paths: a document is the file source/lang/doc_id
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.coalesce(F.col("doc_id").cast("string"), F.lit("unknown")))
    return license_scan.scan(table(spark, sf_dir, "documents"), path=path)


_TAMPERED = "CASE WHEN list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))) & 1 = 1 THEN replace(text, chr(10), '') ELSE text END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


@register(
    "op11_merkle_manifest",
    f"""
    WITH RECURSIVE d AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql("t")} AS changed FROM (SELECT *, {_TAMPERED} AS t FROM documents)),
    k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
    t AS (SELECT source, 0 AS lvl, pos, n, leaf AS h FROM k
          UNION ALL SELECT source, lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY source, lvl, pos // 3),
    s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
    u AS (SELECT 0 AS lvl, pos, n, subroot AS h FROM s
          UNION ALL SELECT lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 3),
    tn AS (SELECT source, lvl, pos, coalesce(string_agg(h, '') OVER (PARTITION BY source, lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                  coalesce(string_agg(h, '') OVER (PARTITION BY source, lvl, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM t WHERE n > 1),
    un AS (SELECT lvl, pos, coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                  coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM u WHERE n > 1),
    st AS (SELECT k.doc_id, tn.lvl AS step, l, r FROM k JOIN tn ON k.source IS NOT DISTINCT FROM tn.source AND tn.pos = k.pos // CAST(pow(3, tn.lvl) AS BIGINT)
           UNION ALL SELECT k.doc_id, 1000 + un.lvl, l, r FROM k JOIN s ON k.source IS NOT DISTINCT FROM s.source JOIN un ON un.pos = s.pos // CAST(pow(3, un.lvl) AS BIGINT)),
    w AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256, list({{'l': l, 'r': r}} ORDER BY step) AS p FROM st GROUP BY doc_id)
    SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM (SELECT k.doc_id, leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, proof_sha256,
                 list_reduce(list_prepend({{'l': changed, 'r': ''}}, coalesce(p, [])), lambda a, b: {{'l': sha256(b.l || a.l || b.r), 'r': ''}}).l AS folded_root
          FROM k JOIN s ON k.source IS NOT DISTINCT FROM s.source LEFT JOIN w USING (doc_id))
    """,
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.audit(table(spark, sf_dir, "documents"), {"text": merkle.without("text", "\n", even)})


_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@register(
    "op12_lexical_search",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, {_LOWER}), '{_TERM}') AS w FROM documents),
    n AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
    c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
    q AS (SELECT DISTINCT i, item_id, t FROM (SELECT i, item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '{_TERM}')) AS t FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark))),
    p AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
    f AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM p GROUP BY t), c),
    g AS (SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))) AS x FROM p JOIN f USING (t) JOIN n USING (r), c),
    s AS (SELECT i, item_id, r, doc_id, CAST(sum(x) AS BIGINT) AS score FROM q JOIN g USING (t) JOIN n USING (r) GROUP BY i, item_id, r, doc_id HAVING sum(x) > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s) WHERE rank <= 50
    """,
)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _spans_sql(place: int, rule: secret_scan.Rule) -> str:
    p = rule.pattern.replace("'", "''")
    part = f"regexp_extract_all(t, '{p}', {rule.group})"
    return f"""SELECT doc_id, {place} AS place, '{rule.name}' AS kind, stop - len(m) AS start, stop FROM (
        SELECT doc_id, unnest(m) AS m, unnest(v) AS v, unnest(list_transform(m, lambda x, i: list_sum(list_transform(g[:i], lambda y: len(y))) + list_sum(list_transform(m[:i], lambda y: len(y))))) AS stop
        FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g, {part} AS v FROM d)) WHERE len(v) >= {rule.least}"""


@register(
    "op13_secret_scan",
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    s AS ({" UNION ALL ".join(_spans_sql(i, r) for i, r in enumerate(secret_scan.RULES))}),
    k AS (SELECT doc_id, kind, place, CAST(start AS BIGINT) AS start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM s),
    a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(span, ',' ORDER BY start, place) FILTER (place < {len(secret_scan.BASE)}) AS base, string_agg(span, ',' ORDER BY start, place) AS spans FROM k GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN a USING (doc_id)
    """,
)
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    number = lambda rule: F.size(F.filter("spans", lambda s: s["rule"] == rule)).cast("long").alias(f"n_{rule}")
    base = F.filter("spans", lambda s: s["rule"].isin([r.name for r in secret_scan.BASE]))
    return found.select("doc_id", *[number(r.name) for r in secret_scan.BASE], F.sha2(secret_scan.digest(base), 256).alias("base_sha256"), secret_scan.digest(F.col("spans")).alias("spans"))

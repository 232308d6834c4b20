"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.cross_polytope import link_vectors
from sluice.llm.html_text import code_points, extract_main_text
from sluice.llm.merkle import FIELDS, fold, leaf_digest, merkle_manifest, proof_digest
from sluice.llm.mixing import systematic_mix, word_count
from sluice.llm.near_duplicates import find_groups
from sluice.llm.packing import pack_documents
from sluice.llm.periodic_runs import collapse_runs
from sluice.llm.pii import KINDS, find_pii, span_text
from sluice.llm.quality_rules import vote_quality
from sluice.llm.repeats import remove_repeats
from sluice.llm.rule_ensemble import score_quality
from sluice.llm.shards import balanced_shards, byte_size
from sluice.llm.token_matrix import token_matrix
from sluice.queries.common import table

QUERIES = {}
SQL = {}


def _query(name):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query("op1_harmonic_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


@_query("op3_systematic_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return systematic_mix(rows).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@_query("op5_token_matrix")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_matrix(table(spark, sf_dir, "documents"), vocabulary_path())


@_query("op6_byte_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", byte_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"))
    # Equal texts lie together in this order, so a group of copies is in one shard unless a cut falls into it.
    placed = balanced_shards(rows, 8, [F.col("digest"), F.col("doc_id")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@_query("op8_pii_votes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True)
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


@_query("op9_quality_votes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = vote_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True)
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col("stats")[s].alias(s) for s in shown], "base_failed", "kept", "posterior")


@_query("op2_rule_ensemble")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@_query("op4_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = find_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


@_query("op7_cross_polytope")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


@_query("op10_text_density")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", code_points(F.col("text")))


def planted_period(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document with a periodic tail, as the query asks for it; a document without id stays as it is."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def _most_repeated(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first by start, then period, as they are sorted."""
    def longer(best: Column, r: Column) -> Column:
        more = best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
        return F.when(more, r).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), longer)


@_query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(table(spark, sf_dir, "documents"), rewrite=planted_period)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", _most_repeated(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@_query("op12_repeat_groups")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", (F.col("n_kept") + lost).alias("n_bytes"), lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@_query("op13_merkle_manifest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = [F.col(f) if f != "n_chars" else F.col(f).cast("decimal(20,0)") + 1 for f in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proofs = merkle_manifest(docs, carried={"tampered": F.when(chosen, leaf_digest(tampered))})
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root")
    shown = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded)
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Order by digest and id, running sums of bytes, cuts at eighths of the whole. The CRC-32 runs over the bytes with a table made
#: from its polynomial.
SQL["op6_byte_shards"] = """WITH crc_table AS (SELECT list(list_reduce(list_concat([i], range(1, 9)),
    lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
sized AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size FROM documents),
ordered AS (SELECT *, sum(size) OVER w - size AS before, sum(size) OVER () AS total, row_number() OVER w AS place
  FROM sized WINDOW w AS (ORDER BY md5(text), doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
placed AS (SELECT *, ((2 * before + size) * 8) // (2 * total) AS shard FROM ordered)
SELECT doc_id, size::BIGINT AS size, xor(list_reduce(list_concat([4294967295], list_transform(
    regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295)::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
  (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed, crc_table"""

#: All pairs that share a shingle, then whatever links reach.
SQL["op4_jaccard_join"] = r"""WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.r < b.r GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON x = nx.r JOIN n ny ON y = ny.r WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT r, r FROM w UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM w LEFT JOIN n ON n.r = w.r JOIN reach ON reach.x = w.r JOIN w o ON o.r = reach.y GROUP BY w.r, w.doc_id"""

#: All pairs.
SQL["op7_cross_polytope"] = """WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT r, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v WHERE e IS NOT NULL AND len(e) = (SELECT max(len(e)) FROM v)
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (SELECT a.r AS x, b.r AS y FROM good a, good b WHERE a.r <> b.r AND a.size > 0 AND b.size > 0
    AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reach(x, y) AS (SELECT r, r FROM v UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.x = v.r)::BIGINT AS n_links, min(o.vec_id) AS component_id,
  coalesce(v.vec_id = min(o.vec_id), false) AS kept
FROM v JOIN reach ON reach.x = v.r JOIN v o ON o.r = reach.y GROUP BY v.r, v.vec_id"""

#: Levels by recursion, for each language and then over the languages; the proof is folded as a list.
SQL["op13_merkle_manifest"] = """WITH RECURSIVE crc_table AS (SELECT list(list_reduce(list_concat([i], range(1, 9)),
    lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
f AS (SELECT row_number() OVER () AS r, doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
  coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars, coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') AS more,
  coalesce(strlen(text) || ':' || text, '-') AS body,
  doc_id IS NOT NULL AND xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'),
    lambda x: ('0x' || x)::BIGINT)), lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) % 7 = 0 AS tampered FROM documents, crc_table),
leaf AS (SELECT r, doc_id, lang, sha256(head || chars || body) AS leaf, CASE WHEN tampered THEN sha256(head || more || body) ELSE sha256(head || chars || body) END AS changed FROM f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY lang) AS n FROM leaf),
tree(lang, level, k, h, n) AS (SELECT lang, 0, k, leaf, n FROM ranked
  UNION ALL SELECT lang, level + 1, k // 2, sha256(string_agg(h, '' ORDER BY k)), (min(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, level, k // 2),
sub AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS k, count(*) OVER () AS n FROM tree WHERE n = 1),
crown(level, k, h, n) AS (SELECT 0, k, h, n FROM sub
  UNION ALL SELECT level + 1, k // 2, sha256(string_agg(h, '' ORDER BY k)), (min(n) + 1) // 2 FROM crown WHERE n > 1 GROUP BY level, k // 2),
top AS (SELECT h AS root FROM crown WHERE n = 1),
steps AS (SELECT x.r, t.level, CASE WHEN (x.k >> t.level) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') AS s
  FROM ranked x JOIN (SELECT DISTINCT lang, level FROM tree WHERE n > 1) t ON t.lang IS NOT DISTINCT FROM x.lang
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM x.lang AND s.level = t.level AND s.k = xor(x.k >> t.level, 1)
  UNION ALL SELECT x.r, 1000 + t.level, CASE WHEN (sub.k >> t.level) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '')
  FROM ranked x JOIN sub ON sub.lang IS NOT DISTINCT FROM x.lang JOIN (SELECT DISTINCT level FROM crown WHERE n > 1) t ON true
  LEFT JOIN crown s ON s.level = t.level AND s.k = xor(sub.k >> t.level, 1)),
proof AS (SELECT r, list(s ORDER BY level) AS p FROM steps GROUP BY r),
done AS (SELECT x.doc_id, x.leaf, sub.h AS subroot, top.root, coalesce(p, []) AS p, x.changed FROM ranked x JOIN sub ON sub.lang IS NOT DISTINCT FROM x.lang CROSS JOIN top LEFT JOIN proof USING (r)),
shown AS (SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(p, lambda s: s[2:]), ''), '')) AS proof_sha256,
  list_reduce(list_concat([changed], p), lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root FROM done)
SELECT *, folded_root = root AS verified FROM shown"""

#: All strings of 400 bytes as hex digits, cut from blocks of 500 starts; what they cover is cut out.
SQL["op12_repeat_groups"] = """WITH b AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT r, k, substr(h, 2 * k + 1, 1798) AS h FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399, 500)) AS k FROM b)),
p AS (SELECT r, k, h, unnest(range(0, len(h) // 2 - 399)) AS p FROM part),
w AS (SELECT r, k + p AS p, md5(substr(h, 2 * p + 1, 800)) AS d FROM p),
hit AS (SELECT r, p FROM w WHERE d IN (SELECT d FROM w GROUP BY d HAVING count(*) > 1)),
edge AS (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 400 THEN 0 ELSE 1 END AS opens FROM hit),
island AS (SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS k FROM edge),
span AS (SELECT r, min(p) AS a, max(p) + 400 AS z FROM island GROUP BY r, k),
gap AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM span),
cut AS (SELECT r, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(z) AS z, sum(z - a) AS lost, count(*) AS n
  FROM gap JOIN b USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(lost, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * z + 1), h))) AS kept_sha256 FROM b LEFT JOIN cut USING (r)"""

"""Projections, scalar functions, blocks and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.blocks import block_markdown, concat_content, filter_blocks
from sluice.functions.chars import char_entropy, char_freq
from sluice.functions.scalar import basename, flatten_struct, from_json_col, safe_div, to_json_col
from sluice.operators.filters import length_filter, md5_dedup, space_ratio
from sluice.operators.literals import LITERAL_OPERATORS
from sluice.operators.models import gated
from sluice.operators.rows import fan_out, run_partitions, run_rows
from sluice.plans.registry import apply_operators, get_operator
from sluice.session import spread
from sluice.queries.common import BODY_SQL, CONTENT_SQL, RECORDS_SQL, as_blocks, r6, r6_sql, table

QUERIES, SQL = {}, {}

CUSTOMER_COLS = "c_custkey, c_name, c_mktsegment"


def _literal_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        customers = table(spark, sf_dir, "customer").select(*CUSTOMER_COLS.split(", "))
        return customers.transform(get_operator(name))

    return run


for _name, _value in LITERAL_OPERATORS.items():
    if _name == "op_stream_1":
        continue  # registered with the streaming queries
    QUERIES[f"set_{_name}"] = _literal_query(_name)
    _sql_value = f"'{_value}'" if isinstance(_value, str) else f"{_value}::BIGINT"
    SQL[f"set_{_name}"] = f"SELECT {CUSTOMER_COLS}, {_sql_value} AS {_name} FROM customer"


def op_chain(spark, sf_dir):
    chain = [{"name": n, "params": {}} for n in ("op1", "op2", "op3", "op4")]
    return apply_operators(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), chain)


QUERIES["op_chain"] = op_chain
SQL["op_chain"] = """SELECT o_orderkey, o_orderstatus, 'processed' AS op1, 100::BIGINT AS op2,
  'processed' AS op3, 100::BIGINT AS op4 FROM orders"""


def block_markdown_query(spark, sf_dir):
    records = as_blocks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    bodies = block_markdown(records).select("doc_id", F.posexplode("bodies").alias("pos", "body"))
    return bodies.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "body")


QUERIES["block_markdown"] = block_markdown_query
SQL["block_markdown"] = f"""WITH {RECORDS_SQL}, numbered AS (
  SELECT doc_id, unnest(content_list) AS b, unnest(range(len(content_list))) AS pos FROM records)
SELECT doc_id, pos, {BODY_SQL} AS body FROM numbered"""


def concat_content_query(spark, sf_dir):
    records = as_blocks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return concat_content(records).select("doc_id", "content")


QUERIES["concat_content"] = concat_content_query
SQL["concat_content"] = f"WITH {CONTENT_SQL} SELECT doc_id, content FROM contents"


def _kind_counts(kind):
    def run(spark, sf_dir):
        records = as_blocks(table(spark, sf_dir, "documents").select("doc_id", "text"))
        kept = filter_blocks(records, "content_list", kind)
        types = F.array_join(F.transform("content_list", lambda b: b["type"]), ",")
        chars = F.aggregate("content_list", F.lit(0).cast("bigint"), lambda acc, b: acc + F.length(b["text"]))
        return kept.select("doc_id", F.size("content_list").cast("bigint").alias("n_blocks"), types.alias("types"),
                           chars.alias("n_chars"))

    return run


def _kind_sql(excluded: str) -> str:
    return f"""WITH {RECORDS_SQL}, kept AS (
  SELECT doc_id, list_filter(content_list, lambda b: b.type NOT IN ({excluded})) AS bs FROM records)
SELECT doc_id, len(bs)::BIGINT AS n_blocks, array_to_string(list_transform(bs, lambda b: b.type), ',') AS types,
  coalesce(list_sum(list_transform(bs, lambda b: length(b.text))), 0)::BIGINT AS n_chars FROM kept"""


QUERIES["filter_blocks_text"] = _kind_counts("text")
SQL["filter_blocks_text"] = _kind_sql("'image', 'audio', 'video', 'hr'")
QUERIES["filter_blocks_nlp"] = _kind_counts("nlp")
SQL["filter_blocks_nlp"] = _kind_sql("'image', 'audio', 'video', 'hr', 'code', 'equation'")


def entropy_sql(source: str, key: str, text: str) -> str:
    """CTE body: entropy per row of ``source`` by exploding and counting its characters."""
    return f"""SELECT {key}, coalesce(-sum((c / n) * log2(c / n)), 0.0) + 0.0 AS entropy FROM (
    SELECT {key}, n, ch, count(*)::DOUBLE AS c FROM (
      SELECT {key}, length({text})::DOUBLE AS n, unnest(string_split({text}, '')) AS ch FROM {source})
    WHERE n > 0 GROUP BY ALL) GROUP BY {key}"""


def char_entropy_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return char_entropy(docs, "text").select("doc_id", r6(F.col("entropy")).alias("entropy"))


QUERIES["char_entropy"] = char_entropy_query
SQL["char_entropy"] = f"""WITH e AS ({entropy_sql('documents', 'doc_id', 'text')})
SELECT doc_id, {r6_sql('coalesce(entropy, 0.0)')} AS entropy FROM documents LEFT JOIN e USING (doc_id)"""


def char_freq_query(spark, sf_dir):
    return char_freq(table(spark, sf_dir, "documents"), ["doc_id"], "text")


QUERIES["char_freq"] = char_freq_query
SQL["char_freq"] = """SELECT doc_id, ch, count(*)::BIGINT AS n FROM (
  SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents WHERE text <> '') GROUP BY ALL"""


def safe_div_query(spark, sf_dir):
    a, b = F.col("o_custkey") % 3 - 1, F.col("o_orderkey") % 2
    divided = table(spark, sf_dir, "orders").select("o_orderkey", safe_div(a, b).alias("q"))
    infinite = F.col("q") == float("inf")
    return divided.select(
        "o_orderkey", F.isnan("q").alias("is_nan"), infinite.alias("is_inf"),
        F.when(~F.isnan("q") & ~infinite, F.col("q")).alias("quotient"),
    )


QUERIES["safe_div"] = safe_div_query
SQL["safe_div"] = """WITH x AS (SELECT o_orderkey, o_custkey % 3 - 1 AS a, o_orderkey % 2 AS b FROM orders)
SELECT o_orderkey, a = 0 AND b = 0 AS is_nan, a <> 0 AND b = 0 AS is_inf,
  CASE WHEN b <> 0 THEN a::DOUBLE / b END AS quotient FROM x"""


def clean_prob_gate_query(spark, sf_dir):
    """Whole texts pass the gate; language codes have two characters and one bit each, so they do not."""
    docs = table(spark, sf_dir, "documents")
    values = docs.select("doc_id", F.stack(F.lit(2), F.lit("lang"), "lang", F.lit("text"), "text").alias("field", "value"))
    scored = char_entropy(values, "value")
    prob = gated(F.col("entropy"), F.col("entropy") / 10)
    return scored.select("doc_id", "field", r6(prob).alias("clean_prob"))


QUERIES["clean_prob_gate"] = clean_prob_gate_query
SQL["clean_prob_gate"] = f"""WITH s AS (SELECT doc_id || 'lang' AS id, doc_id, 'lang' AS field, lang AS value FROM documents
  UNION ALL SELECT doc_id || 'text', doc_id, 'text', text FROM documents),
e AS ({entropy_sql('s', 'id', 'value')})
SELECT doc_id, field, {r6_sql('CASE WHEN coalesce(entropy, 0.0) <= 1 THEN 0.0 ELSE entropy / 10 END')} AS clean_prob
FROM s LEFT JOIN e USING (id)"""


def flatten_features_query(spark, sf_dir):
    size = F.struct(F.col("n_chars").alias("chars"), F.length("text").cast("bigint").alias("length"))
    nested = table(spark, sf_dir, "documents").select(
        "doc_id", F.struct(F.col("lang").alias("lang"), size.alias("size")).alias("features")
    )
    return flatten_struct(nested, "features", sep="_")


QUERIES["flatten_features"] = flatten_features_query
SQL["flatten_features"] = """SELECT doc_id, lang, n_chars AS size_chars, length(text)::BIGINT AS size_length
FROM documents"""


def json_decode_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return from_json_col(events, "props", "k bigint", "p").select("event_id", "event_type", F.col("p.k").alias("k"))


QUERIES["json_decode"] = json_decode_query
SQL["json_decode"] = """SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""


def json_encode_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return to_json_col(docs, ["doc_id", "lang", "source", "text", "n_chars"]).select("doc_id", "value")


QUERIES["json_encode"] = json_encode_query
SQL["json_encode"] = """SELECT doc_id, CAST(to_json(struct_pack(doc_id := doc_id, lang := lang, source := source,
  "text" := text, n_chars := n_chars)) AS VARCHAR) AS value FROM documents"""


def ref_basename_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", basename(F.col("url")).alias("name"))


QUERIES["ref_basename"] = ref_basename_query
SQL["ref_basename"] = "SELECT page_id, url, string_split(url, '/')[-1] AS name FROM pages"


def length_filter_query(spark, sf_dir):
    return length_filter(table(spark, sf_dir, "documents"), "text", 1000).select("doc_id", "n_chars", "text")


QUERIES["length_filter"] = length_filter_query
SQL["length_filter"] = "SELECT doc_id, n_chars, text FROM documents WHERE length(text) >= 1000"


def space_ratio_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    strict = space_ratio(docs, "text", 0.1).withColumn("max_ratio", F.lit(0.1))
    loose = space_ratio(docs, "text", 0.16).withColumn("max_ratio", F.lit(0.16))
    return strict.unionByName(loose).select("doc_id", "lang", "max_ratio")


QUERIES["space_ratio"] = space_ratio_query
SQL["space_ratio"] = """WITH s AS (SELECT doc_id, lang, length(text) AS n,
  length(text) - length(replace(text, ' ', '')) AS blanks FROM documents)
SELECT doc_id, lang, m::DOUBLE AS max_ratio FROM s, (VALUES (0.1::DOUBLE), (0.16::DOUBLE)) v(m)
WHERE n > 0 AND blanks::DOUBLE / n <= m"""


def md5_dedup_query(spark, sf_dir):
    return md5_dedup(table(spark, sf_dir, "documents"), "text", "doc_id")


QUERIES["md5_dedup"] = md5_dedup_query
SQL["md5_dedup"] = """SELECT doc_id, text, lang, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1"""


def _reciprocal(record: dict) -> dict:
    return {"o_orderkey": record["o_orderkey"], "share": 12 / (record["o_custkey"] % 5)}


def drop_failed_rows_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dropped = run_rows(orders, _reciprocal, "o_orderkey bigint, share double", on_error="drop")
    kept = run_rows(orders, _reciprocal, "o_orderkey bigint, share double", on_error="quarantine")
    return dropped.withColumn("_error", F.lit(None).cast("string")).unionByName(
        kept.filter(F.col("_error").isNotNull()).drop("_error_msg")
    )


QUERIES["drop_failed_rows"] = drop_failed_rows_query
SQL["drop_failed_rows"] = """SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN 12::DOUBLE / (o_custkey % 5) END
  AS share, CASE WHEN o_custkey % 5 = 0 THEN 'ZeroDivisionError' END AS _error FROM orders"""


def _tag(record: dict, suffix: str) -> dict:
    return {"c_custkey": record["c_custkey"], "tag": record["c_mktsegment"].lower() + suffix}


def row_udf_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return run_rows(customers, _tag, "c_custkey bigint, tag string", init=lambda: "-x")


QUERIES["row_udf"] = row_udf_query
SQL["row_udf"] = "SELECT c_custkey, lower(c_mktsegment) || '-x' AS tag FROM customer"


def _lines(records):
    for record in records:
        for number, line in enumerate(record["text"].split("\n")):
            if line:
                yield {"conv_id": record["conv_id"], "turn": record["turn"], "line_no": number, "line": line}


def iter_udf_query(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return run_partitions(turns, _lines, "conv_id bigint, turn bigint, line_no bigint, line string")


QUERIES["iter_udf"] = iter_udf_query
SQL["iter_udf"] = """SELECT conv_id, turn, line_no, line FROM (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS line_no FROM conversations) WHERE line <> ''"""


def _parts(text):
    """Sentences of a text with their place; null and empty texts have none."""
    for number, part in enumerate((text or "").split(". ")):
        if part:
            yield number, part


def iter_fan_out(spark, sf_dir):
    """Documents with their sentences, from none to many; documents without any stay. Every fifth text is null or empty."""
    number = F.col("doc_id")
    text = F.when(number % 10 == 0, None).when(number % 5 == 0, "").otherwise(F.col("text")).alias("text")
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", text))
    parts = fan_out(rows, _parts, ["text"], "place bigint, part string", keep_empty=True)
    return parts.select("doc_id", "lang", "place", "part")


QUERIES["iter_fan_out"] = iter_fan_out
SQL["iter_fan_out"] = """WITH d AS (SELECT doc_id, lang, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN '' ELSE text END AS text FROM documents),
p AS (SELECT * FROM (SELECT doc_id, unnest(string_split(text, '. ')) AS part, unnest(range(len(string_split(text, '. ')))) AS place FROM d) WHERE part <> '')
SELECT doc_id, lang, place, part FROM d LEFT JOIN p USING (doc_id)"""


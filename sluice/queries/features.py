"""Text-quality features, the model score and model jobs."""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.features import EXTRA_FEATURES, FEATURE_GROUPS, STOP_WORDS, quality_features
from sluice.operators.documents import extract_documents
from sluice.operators.models import (
    DEFAULT_WEIGHTS, batch_predict, clean_model, logistic, model_weights, train_clean_model,
)
from sluice.operators.tree_models import load_model, model_score, save_model, train_tree_model, tree_score, tree_spec
from sluice.plans.registry import apply_operators
from sluice.queries.common import CONTENT_SQL, as_blocks, r6, r6_sql, table
from sluice.queries.scalars import entropy_sql
from sluice.session import materialize, scratch_path, spread

QUERIES, SQL = {}, {}

INTEGER_FEATURES = {
    "lines_num", "words_num", "content_word_len", "num_len", "space_len", "max_continue_space_num", "punc_len",
    "emoji_len", "special_char_len", "punc_end_sentence_num", "stop_word_num", "html_semi_entity_count",
    "content_len", "ellipsis_line_num",
}


def _shown(names):
    return [F.col(n) if n in INTEGER_FEATURES else r6(F.col(n)).alias(n) for n in names]


def _frac(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a})::DOUBLE / ({b}) END"


def _left(pattern: str) -> str:
    """Characters of t that match a pattern."""
    return f"(n - length(regexp_replace(t, '{pattern}', '', 'g')))"


def _joined(items: str) -> str:
    return f"coalesce(length(array_to_string({items}, '')), 0)"


def _stop_sql(lang: bool) -> str:
    stripped = r"regexp_replace(lower(x), '^\p{P}+|\p{P}+$', '', 'g')"
    if not lang:
        words = sorted({w for ws in STOP_WORDS.values() for w in ws})
        listed = ", ".join(f"'{w}'" for w in words)
        return f"len(list_filter(w, lambda x: {stripped} IN ({listed})))"
    cases = " ".join(
        f"WHEN '{code}' THEN len(list_filter(w, lambda x: {stripped} IN ({', '.join(repr(w) for w in words)})))"
        for code, words in STOP_WORDS.items()
    )
    return f"CASE lang {cases} ELSE 0 END"


def _dup_share(k: int) -> str:
    return f"coalesce(d{k}.v, 0.0)"


def _feature_sql(lang: bool = False) -> dict[str, str]:
    lines = "len(lines)"
    sentences = "list_filter(list_transform(regexp_split_to_array(t, '[.!?。！？]+'), lambda s: trim(s, ws)), " \
                "lambda s: s <> '')"
    entity = "&(#[0-9]+|#x[0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
    ellipsis = "len(list_filter(lines, lambda l: ends_with(l, '...') OR ends_with(l, '…')))"
    bullets = r"len(list_filter(lines, lambda l: regexp_matches(l, '^[ \t]*([-*•·]|[0-9]+[.)])[ \t]')))"
    scripts = "len(list_filter(lines, lambda l: regexp_matches(l, '[Jj]ava[Ss]cript')))"
    longest = "coalesce(list_max(list_transform(regexp_extract_all(t, ' +'), lambda s: length(s))), 0)"
    codes = "list_transform(ch, lambda c: unicode(c))"
    steps = "list_transform(list_zip(cp[1:len(cp)-1], cp[2:len(cp)]), lambda p: abs(p[1] - p[2]))"
    return {
        "lines_num": lines, "words_num": "len(w)", "average_words_per_line": _frac("len(w)", lines),
        "word_compression": _frac(_joined("list_distinct(w)"), "wc"),
        "unique_words_frac": _frac("len(list_distinct(w))", "len(w)"),
        "content_word_len": _left(r"\p{L}"), "content_word_frac": _frac(_left(r"\p{L}"), "n"),
        "num_len": _left(r"\p{Nd}"), "num_frac": _frac(_left(r"\p{Nd}"), "n"),
        "space_len": _left(r"[ \t]"), "space_frac": _frac(_left(r"[ \t]"), "n"),
        "enter_frac": _frac("len(lines) - 1", "n"), "max_continue_space_num": longest,
        "punc_len": _left(r"\p{P}"), "punc_frac": _frac(_left(r"\p{P}"), "n"),
        "emoji_len": _left(r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"),
        "emoji_frac": _frac(_left(r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"), "n"),
        "special_char_len": _left(r"\p{S}"), "special_char_frac": _frac(_left(r"\p{S}"), "n"),
        "punc_end_sentence_num": _left("[.!?。！？]"),
        "punc_end_sentence_mean_len": _frac(_joined(sentences), f"len({sentences})"),
        "stop_word_num": _stop_sql(lang), "stop_word_frac": _frac(_stop_sql(lang), "len(w)"),
        "ellipsis_line_frac": _frac(ellipsis, lines), "bulletpoint_line_frac": _frac(bullets, lines),
        "html_semi_entity_count": f"len(regexp_extract_all(t, '{entity}'))",
        "html_semi_entity_frac": _frac(_left(entity), "n"),
        "url_char_frac": _frac(_left(r"https?://[^ \t\n\r\f]+"), "n"),
        "dup_top_2gram": "coalesce(t2.v, 0.0)", "dup_top_3gram": "coalesce(t3.v, 0.0)",
        "dup_top_4gram": "coalesce(t4.v, 0.0)",
        **{f"dup_{k}gram": _dup_share(k) for k in (5, 6, 7, 8, 9, 10)},
        "entropy": "coalesce(entropy, 0.0)",
        "std_dev_unicode_value": f"CASE WHEN n = 0 THEN 0.0 ELSE list_aggregate({codes}, 'stddev_pop') END",
        "mean_diff_unicode_value": f"CASE WHEN n < 2 THEN 0.0 ELSE list_avg({steps}) END",
        "content_len": "n", "ellipsis_line_num": ellipsis, "js_line_frac": _frac(scripts, lines),
    }


def _top_cte(k: int) -> str:
    return f"""t{k} AS (SELECT id, c * s / wc AS v FROM (
    SELECT id, wc, count(*)::DOUBLE AS c, length(g) - {k - 1} AS s FROM g{k} GROUP BY id, wc, g)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY c DESC, s DESC) = 1)"""


def _gram_cte(k: int) -> str:
    return f"""g{k} AS (SELECT id, wc, array_to_string(w[i:i + {k - 1}], ' ') AS g FROM (
    SELECT id, wc, w, unnest(range(1, len(w) - {k - 2})) AS i FROM base))"""


def feature_query_sql(source: str, names: list[str], key: str, text: str, lang: str = "NULL", ctes: str = "") -> str:
    """SQL for some features of a table; only the helper tables they need are included."""
    exprs = _feature_sql(lang != "NULL")
    parts = [ctes] if ctes else []
    parts.append(f"""base AS (SELECT *, coalesce(length(array_to_string(w, '')), 0) AS wc,
    list_transform(ch, lambda c: unicode(c)) AS cp FROM (
    SELECT {key} AS id, {text} AS t, {lang} AS lang, length({text}) AS n, string_split({text}, '') AS ch,
      string_split({text}, chr(10)) AS lines, ' ' || chr(9) || chr(10) || chr(13) || chr(12) AS ws,
      list_filter(regexp_split_to_array({text}, '[ \\t\\n\\r\\f]+'), lambda x: x <> '') AS w FROM {source}))""")
    joins = ""
    for k in (2, 3, 4):
        if f"dup_top_{k}gram" in names:
            parts += [_gram_cte(k), _top_cte(k)]
            joins += f" LEFT JOIN t{k} USING (id)"
    for k in (5, 6, 7, 8, 9, 10):
        if f"dup_{k}gram" in names:
            parts += [_gram_cte(k), f"d{k} AS (SELECT id, 1 - count(DISTINCT g)::DOUBLE / count(*) AS v FROM g{k} GROUP BY id)"]
            joins += f" LEFT JOIN d{k} USING (id)"
    if "entropy" in names:
        parts.append(f"ent AS ({entropy_sql('base', 'id', 't')})")
        joins += " LEFT JOIN ent USING (id)"
    shown = [f"({exprs[n]})::BIGINT AS {n}" if n in INTEGER_FEATURES else f"{r6_sql(exprs[n])} AS {n}" for n in names]
    return f"WITH {', '.join(parts)}\nSELECT id AS {key}, {', '.join(shown)}\nFROM base{joins}"


def _group_query(group: str, source: str, key: str, text: str):
    names = list(FEATURE_GROUPS[group])
    lang = "lang" if group == "sentences" else None

    def run(spark, sf_dir):
        cols = [key, text] + ([lang] if lang else [])
        rows = quality_features(spread(table(spark, sf_dir, source).select(*cols)), text, lang_col=lang, features=names)
        return rows.select(key, *_shown(names))

    QUERIES[f"feat_{group}"] = run
    SQL[f"feat_{group}"] = feature_query_sql(source, names, key, text, lang or "NULL")


for _group in FEATURE_GROUPS:
    if _group == "markup":
        _group_query(_group, "pages", "page_id", "html")
    else:
        _group_query(_group, "documents", "doc_id", "text")


def feat_optional_query(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality_features(docs, "text", features=EXTRA_FEATURES).select("doc_id", *_shown(EXTRA_FEATURES))


QUERIES["feat_optional"] = feat_optional_query
SQL["feat_optional"] = feature_query_sql("documents", list(EXTRA_FEATURES), "doc_id", "text")


def clean_model_demo_query(spark, sf_dir):
    records = as_blocks(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return clean_model(records).select("doc_id", r6(F.col("clean_prob")).alias("clean_prob"))


def clean_prob_sql(source: str = "contents", text: str = "content", ctes: str = CONTENT_SQL) -> str:
    exprs = _feature_sql()
    terms = [str(DEFAULT_WEIGHTS["intercept"])]
    terms += [f"({exprs[n]}) * {w}::DOUBLE" for n, w in DEFAULT_WEIGHTS.items() if n != "intercept"]
    score = f"CASE WHEN coalesce(entropy, 0.0) <= 1 THEN 0.0 ELSE 1 / (1 + exp(-({' + '.join(terms)}))) END"
    names = [n for n in DEFAULT_WEIGHTS if n != "intercept"]
    sql = feature_query_sql(source, names, "doc_id", text, ctes=ctes)
    head, tail = sql.rsplit("\nSELECT ", 1)
    return f"{head}\nSELECT id AS doc_id, {r6_sql(score)} AS clean_prob\n{tail[tail.rindex('FROM base'):]}"


QUERIES["clean_model_demo"] = clean_model_demo_query
SQL["clean_model_demo"] = clean_prob_sql()


TRAINED = ("unique_words_frac", "punc_frac")
REGULARISATION = 0.001
NEWTON_STEPS = 30


def train_clean_model_query(spark, sf_dir):
    """Fit two weights and the intercept on the labelled documents only, then score all documents in one pass."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter("quality IS NOT NULL")
    labelled = quality_features(docs.join(labels, "doc_id"), "text", features=TRAINED).drop("text")
    model = train_clean_model(labelled, "quality", TRAINED, max_iter=1000, reg=REGULARISATION, standardize=False, tol=1e-15)
    score = logistic(model_weights(model))
    scored = quality_features(spread(docs), "text", features=TRAINED)
    return scored.select("doc_id", (F.floor(score * F.lit(1e4) + F.lit(0.5)) / F.lit(1e4)).alias("clean_prob"))


def _newton_sql() -> str:
    """Newton steps for the regularised mean log loss: gradient, Hessian and the solution of a 3 x 3 system by cofactors."""
    exprs = _feature_sql()
    head, _ = feature_query_sql("documents", list(TRAINED), "doc_id", "text").rsplit("\nSELECT ", 1)
    ridge = f"{REGULARISATION}::DOUBLE"
    return f"""{head.replace("WITH base", "WITH RECURSIVE base", 1)},
f AS (SELECT id, ({exprs[TRAINED[0]]})::DOUBLE AS x, ({exprs[TRAINED[1]]})::DOUBLE AS z FROM base),
t AS (SELECT x, z, quality::DOUBLE AS y FROM f JOIN labels ON labels.doc_id = f.id WHERE quality IS NOT NULL),
newton(i, a, b, c) AS (
  SELECT 0, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE
  UNION ALL
  SELECT i + 1, a - (m00 * g0 + m01 * g1 + m02 * g2) / det, b - (m01 * g0 + m11 * g1 + m12 * g2) / det,
    c - (m02 * g0 + m12 * g1 + m22 * g2) / det
  FROM (SELECT *, h11 * h22 - h12 * h12 AS m00, h02 * h12 - h01 * h22 AS m01, h01 * h12 - h02 * h11 AS m02,
      h00 * h22 - h02 * h02 AS m11, h01 * h02 - h00 * h12 AS m12, h00 * h11 - h01 * h01 AS m22,
      h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det
    FROM (SELECT i, a, b, c, avg(p - y) AS g0, avg((p - y) * x) + {ridge} * b AS g1, avg((p - y) * z) + {ridge} * c AS g2,
        avg(p * (1 - p)) AS h00, avg(p * (1 - p) * x) AS h01, avg(p * (1 - p) * z) AS h02,
        avg(p * (1 - p) * x * x) + {ridge} AS h11, avg(p * (1 - p) * x * z) AS h12, avg(p * (1 - p) * z * z) + {ridge} AS h22
      FROM (SELECT i, a, b, c, x, z, y, 1 / (1 + exp(-(a + b * x + c * z))) AS p FROM newton, t WHERE i < {NEWTON_STEPS})
      GROUP BY i, a, b, c)))
SELECT id AS doc_id, floor(1e4 / (1 + exp(-(a + b * x + c * z))) + 0.5::DOUBLE) / 1e4 AS clean_prob
FROM f, newton WHERE i = {NEWTON_STEPS}"""


QUERIES["train_clean_model"] = train_clean_model_query
SQL["train_clean_model"] = _newton_sql()

TREE_FEATURES = ("lines_num", "words_num", "unique_words_frac", "stop_word_frac", "punc_frac", "num_frac", "special_char_frac", "entropy", "dup_top_2gram", "dup_10gram")


def train_tree_model_query(spark, sf_dir):
    """Boosted trees fitted on four of five labelled documents, compiled, stored and loaded in a new session.

    The compiled score of every document equals that of the fitted model, the stored model scores alike, also as an operator of a chain,
    and nine of ten documents kept out are on the right side.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    features = materialize(quality_features(docs, "text", features=list(TREE_FEATURES)), "tree-features")
    labelled = features.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    assembler, model = train_tree_model(labelled.filter(F.col("doc_id") % 5 != 0), cols=TREE_FEATURES, trees=8, depth=3)
    spec = tree_spec(assembler, model)
    path = scratch_path(spark, "tree-model")
    save_model(spark, spec, path)
    loaded = load_model(spark.newSession(), path)
    scored = model.transform(assembler.transform(features)).select(
        "doc_id", vector_to_array("__probability")[1].alias("fitted"), tree_score(spec).alias("native"), model_score(loaded).alias("stored"))
    chain = apply_operators(docs, [{"name": "stored_model", "params": {"model_path": path, "text_col": "text", "out": "chained"}}])
    both = scored.join(chain.select("doc_id", "chained"), "doc_id").join(labelled.select("doc_id", "quality", "entropy"), "doc_id", "left")
    kept_out = (F.col("doc_id") % 5 == 0) & F.col("quality").isNotNull()
    right = F.avg(F.when(kept_out, ((F.col("native") >= 0.5).cast("int") == F.col("quality")).cast("double")))
    share = materialize(both.agg(right.alias("right")), "tree-share")
    gate = F.when(F.col("entropy") <= 1.0, 0.0).otherwise(F.col("native"))
    return both.join(F.broadcast(share)).select(
        "doc_id", (F.abs(F.col("fitted") - F.col("native")) < 1e-9).alias("same"), (F.col("native") == F.col("stored")).alias("same_stored"),
        (F.col("entropy").isNull() | (F.abs(F.col("chained") - gate) < 1e-9)).alias("same_chained"), (F.col("right") >= 0.9).alias("accurate"))


QUERIES["train_tree_model"] = train_tree_model_query
SQL["train_tree_model"] = "SELECT doc_id, true AS same, true AS same_stored, true AS same_chained, true AS accurate FROM documents"


VECTOR_SIZE = 64
# The weights of the linear test model, by rule.
LINEAR_WEIGHTS = [((i * 37) % 19 - 9) / 10 for i in range(VECTOR_SIZE)]


def make_linear_model():
    weights = np.array(LINEAR_WEIGHTS)

    def predict(vectors: np.ndarray) -> np.ndarray:
        return vectors.astype("float64") @ weights

    return predict


def model_operator_query(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    scored = batch_predict(vectors, ["embedding"], make_linear_model, T.DoubleType(), "score",
                           input_tensor_shapes=[[VECTOR_SIZE]])
    return scored.select("vec_id", "label", r6(F.col("score")).alias("score"))


QUERIES["model_operator"] = model_operator_query
SQL["model_operator"] = f"""SELECT vec_id, label, {r6_sql(
    'list_sum(list_transform(list_zip(embedding, [' + ', '.join(f'{w}::DOUBLE' for w in LINEAR_WEIGHTS) +
    ']), lambda p: p[1]::DOUBLE * p[2]))')} AS score FROM embeddings"""


def extract_paragraphs(raw: bytes) -> list[dict]:
    """Test extractor: headings and paragraphs as text blocks, list items as one list block each."""
    html = raw.decode("utf-8")
    kinds = {"h1": "text", "p": "text", "li": "list"}
    return [{"type": kinds[tag], "text": body} for tag, body in re.findall(r"<(h1|p|li)>([^<]*)", html)]


def extract_documents_query(spark, sf_dir):
    """Every eleventh page has no bytes, so the error columns are exercised."""
    pages = table(spark, sf_dir, "pages")
    content = F.when(F.col("page_id") % 11 != 0, F.col("html").cast("binary"))
    extracted = extract_documents(pages.select("page_id", content.alias("content")), extract_paragraphs)
    joined = F.array_join(F.transform("content_list", lambda b: F.concat_ws(":", b["type"], b["text"])), "|")
    return extracted.select("page_id", F.size("content_list").cast("bigint").alias("n_blocks"),
                            joined.alias("blocks"), "_error", "_error_msg")


QUERIES["extract_documents"] = extract_documents_query
SQL["extract_documents"] = """WITH found AS (SELECT page_id, CASE WHEN page_id % 11 <> 0 THEN
    list_transform(regexp_extract_all(html, '<(h1|p|li)>[^<]*'), lambda m:
      CASE WHEN starts_with(m, '<li>') THEN 'list:' ELSE 'text:' END || regexp_replace(m, '^<(h1|p|li)>', '')) END AS bs
  FROM pages)
SELECT page_id, len(bs)::BIGINT AS n_blocks, array_to_string(bs, '|') AS blocks,
  CASE WHEN bs IS NULL THEN 'read_error' END AS _error, CASE WHEN bs IS NULL THEN 'no bytes' END AS _error_msg
FROM found"""

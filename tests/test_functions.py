"""Scalars, blocks, characters and features against plain Python and the edge fixtures."""

import json
import math
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.blocks import CONTENT_LIST_SCHEMA, block_markdown, concat_content, filter_blocks
from sluice.functions.chars import char_entropy, char_freq
from sluice.functions.features import (
    EXTRA_FEATURES, FEATURE_GROUPS, FEATURES, STOP_WORDS, quality_features,
)
from sluice.functions.scalar import basename, flatten_struct, from_json_col, normalize_path, safe_div, to_json_col

TEXT = st.text(
    alphabet=st.one_of(st.sampled_from("ab \n\t.!?…-•&;😀é1。the"), st.characters(blacklist_categories=("Cs",),
                                                                               blacklist_characters="\x00")),
    max_size=60,
)
RELAXED = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def entropy(text):
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def test_safe_div_table(spark):
    rows = [(0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (1.0, 4.0), (None, 0.0), (1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(safe_div(F.col("a"), F.col("b"))).collect()]
    assert math.isnan(got[0]) and got[1:] == [math.inf, math.inf, 0.25, None, None]


@RELAXED
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=20))
def test_safe_div_property(spark, pairs):
    df = spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<a:int,b:int>")
    got = df.select(safe_div(F.col("p.a"), F.col("p.b")), "i").orderBy("i").collect()
    for (a, b), (value, _) in zip(pairs, got):
        want = (math.nan if a == 0 else math.inf) if b == 0 else a / b
        assert value == want or (math.isnan(want) and math.isnan(value))


def test_paths(spark):
    df = spark.createDataFrame([("file:///a/b.jsonl",), ("s3://x/y",), ("s3n://x/y",), ("http://h/p",)], "p string")
    got = [tuple(r) for r in df.select(normalize_path(F.col("p")), basename(F.col("p"))).collect()]
    assert got == [("file:/a/b.jsonl", "b.jsonl"), ("s3a://x/y", "y"), ("s3a://x/y", "y"), ("http://h/p", "p")]


def test_flatten_struct(spark):
    df = spark.createDataFrame([(1, ((2, "x"), 3.0))], "id int, f struct<a:struct<b:int,c:string>,d:double>")
    assert flatten_struct(df, "f").columns == ["id", "a.b", "a.c", "d"]
    assert tuple(flatten_struct(df, "f").first()) == (1, 2, "x", 3.0)
    with pytest.raises(TypeError):
        flatten_struct(df, "id")


def test_json_round_trip(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    coded = to_json_col(df, ["a", "b"])
    assert [json.loads(r.value) for r in coded.collect()] == [{"a": 1, "b": None}, {"a": 2, "b": "x"}]
    decoded = from_json_col(coded.select("value"), "value", "a bigint, b string").select("value.*")
    assert decoded.collect() == df.collect()


BLOCK_RECORDS = [
    ("e1", []),
    ("e2", None),
    ("e3", [("text", "", "a"), ("image", "x", None), ("text", "b", "c")]),
    ("e4", [("text", "", ""), ("text", None, "z")]),
    ("e5", [("mystery", None, "kept")]),
    ("e6", [(None, None, "kept")]),
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(BLOCK_RECORDS, f"track_id string, content_list {CONTENT_LIST_SCHEMA}")


def test_concat_content_edges(records):
    got = {r.track_id: r.content for r in concat_content(records).collect()}
    assert got == {"e1": "", "e2": None, "e3": "a\n\nb", "e4": "\n\nz", "e5": "kept", "e6": "kept"}


def test_blocks_without_markdown_field(spark):
    df = spark.createDataFrame([([("text", "a"), ("hr", "-")],)], "content_list array<struct<type:string,text:string>>")
    assert concat_content(df).first().content == "a"
    assert block_markdown(df).first().bodies == ["a", "-"]


def test_filter_blocks_kinds(spark):
    kinds = ["text", "quote", "list", "code", "table", "image", "audio", "video", "hr", "equation", "mystery"]
    df = spark.createDataFrame([([(k, None, k) for k in kinds],)], f"content_list {CONTENT_LIST_SCHEMA}")
    kept = {kind: [b.type for b in filter_blocks(df, kind=kind).first().content_list] for kind in ("text", "nlp")}
    assert kept["text"] == ["text", "quote", "list", "code", "table", "equation", "mystery"]
    assert kept["nlp"] == ["text", "quote", "list", "table", "mystery"]
    with pytest.raises(ValueError):
        filter_blocks(df, kind="other")


def test_entropy_edges(spark):
    rows = [("",), ("aaaa",), ("abab",), ("abc",), ("a😀b",), (None,), ("aaabbb",)]
    got = [r.entropy for r in char_entropy(spark.createDataFrame(rows, "text string")).collect()]
    assert got[0] == 0.0 and got[1] == 0.0 and got[2] == 1.0 and got[6] == 1.0 and got[5] is None
    assert round(got[3], 6) == 1.584963 and round(got[4], 6) == 1.584963


@RELAXED
@given(st.lists(TEXT, min_size=1, max_size=10))
def test_entropy_and_frequencies_property(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.entropy for r in char_entropy(df).collect()}
    assert all(abs(got[i] - entropy(t)) < 1e-9 for i, t in enumerate(texts))
    counts = {}
    for r in char_freq(df, ["doc_id"]).collect():
        counts.setdefault(r.doc_id, {})[r.ch] = r.n
    assert counts == {i: dict(Counter(t)) for i, t in enumerate(texts) if t}


def test_long_runs_do_not_overflow(spark):
    df = spark.createDataFrame([("x" * 500_000 + "y" * 500_000,)], "text string")
    assert char_entropy(df).first().entropy == 1.0


def test_feature_names():
    assert len(FEATURES) == 34 and len(EXTRA_FEATURES) == 9
    assert len(set(FEATURES + EXTRA_FEATURES)) == 43
    assert set(FEATURE_GROUPS) == {"lines_words", "chars", "sentences", "markup", "repetition", "unicode"}


SPACE = " \t\n\r\f"


def _words(text):
    return [w for w in re.split(f"[{SPACE}]+", text) if w]


def _grams(words, k):
    return [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]


def _top(words, k):
    counts = Counter(_grams(words, k))
    if not counts:
        return 0.0
    best = max((c, len(g) - (k - 1)) for g, c in counts.items())
    return best[0] * best[1] / sum(map(len, words))


def _dup(words, k):
    grams = _grams(words, k)
    return 1 - len(set(grams)) / len(grams) if grams else 0.0


def brute_features(text):
    """Features that plain Python states in a line each; the regex classes are compared with DuckDB instead."""
    div = lambda a, b: a / b if b else 0.0
    words, lines, n = _words(text), text.split("\n"), len(text)
    sentences = [s.strip(SPACE) for s in re.split("[.!?。！？]+", text)]
    sentences = [s for s in sentences if s]
    codes = [ord(c) for c in text]
    mean = div(sum(codes), n)
    entities = [m.group(0) for m in re.finditer(r"&(#[0-9]+|#x[0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", text)]
    return {
        "lines_num": len(lines), "words_num": len(words), "average_words_per_line": len(words) / len(lines),
        "word_compression": div(sum(map(len, set(words))), sum(map(len, words))),
        "unique_words_frac": div(len(set(words)), len(words)),
        "space_len": sum(c in " \t" for c in text), "space_frac": div(sum(c in " \t" for c in text), n),
        "enter_frac": div(text.count("\n"), n),
        "max_continue_space_num": max(map(len, re.findall(" +", text)), default=0),
        "punc_end_sentence_num": sum(c in ".!?。！？" for c in text),
        "punc_end_sentence_mean_len": div(sum(map(len, sentences)), len(sentences)),
        "ellipsis_line_frac": sum(x.endswith(("...", "…")) for x in lines) / len(lines),
        "bulletpoint_line_frac": sum(bool(re.match(r"[ \t]*([-*•·]|[0-9]+[.)])[ \t]", x)) for x in lines) / len(lines),
        "html_semi_entity_count": len(entities), "html_semi_entity_frac": div(sum(map(len, entities)), n),
        "url_char_frac": div(sum(map(len, re.findall(r"https?://[^ \t\n\r\f]+", text))), n),
        "dup_top_2gram": _top(words, 2), "dup_top_4gram": _top(words, 4), "dup_10gram": _dup(words, 10),
        "entropy": entropy(text),
        "std_dev_unicode_value": math.sqrt(div(sum((c - mean) ** 2 for c in codes), n)),
        "mean_diff_unicode_value": div(sum(abs(a - b) for a, b in zip(codes, codes[1:])), n - 1 if n > 1 else 0),
        "content_len": n, "dup_top_3gram": _top(words, 3), "dup_5gram": _dup(words, 5), "dup_9gram": _dup(words, 9),
        "ellipsis_line_num": sum(x.endswith(("...", "…")) for x in lines),
        "js_line_frac": sum(bool(re.search("[Jj]ava[Ss]cript", x)) for x in lines) / len(lines),
    }


SAMPLES = [
    "", " ", "\n", "a", "a b a b a b a b a b a b a b a b", "one two\n\n- item…\n1. next ...\n......\n enable JavaScript",
    "x&amp;y &#12; &#xAF; &nope https://a.b/c?d=e f", "a.b. c! ?!。", "😀 ok 😀 ok\r\n\ttab   three",
    "\n- a\n-b\n 12) c\n* d\u2028- e", "é" * 50 + " " + "ß" * 3,
]


def check_against_brute_force(spark, texts):
    df = quality_features(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), extra=True)
    rows = {r.i: r.asDict() for r in df.collect()}
    for i, text in enumerate(texts):
        for name, want in brute_features(text).items():
            assert abs(rows[i][name] - want) < 1e-7 * max(1, abs(want)), (text, name, rows[i][name], want)


def test_features_on_samples(spark):
    check_against_brute_force(spark, SAMPLES)


@settings(RELAXED, max_examples=8)
@given(st.lists(TEXT, min_size=1, max_size=10))
def test_features_property(spark, texts):
    check_against_brute_force(spark, texts)


def test_character_classes(spark):
    df = spark.createDataFrame([("Ab1٣ +€,.!-😀☀ß",)], "text string")
    row = quality_features(df).first()
    assert (row.content_word_len, row.num_len, row.punc_len, row.emoji_len, row.special_char_len) == (3, 2, 4, 2, 4)


def test_stop_words(spark):
    df = spark.createDataFrame([("The cat, (and) the dog's THE. und", "en"), ("Der Hund und the", "de"), ("the", "xx")],
                               "text string, lang string")
    assert [r.stop_word_num for r in quality_features(df, lang_col="lang").collect()] == [4, 2, 0]
    assert quality_features(df.limit(1)).first().stop_word_num == 5
    assert set(STOP_WORDS) == {"en", "fr", "de", "es"}


def test_null_text_gives_null_features(spark):
    df = spark.createDataFrame([(1, None)], "i int, text string")
    row = quality_features(df, prefix="q_", extra=True).first().asDict()
    assert row.pop("i") == 1 and row.pop("text") is None
    assert set(row.values()) == {None} and len(row) == 43


def test_chosen_features(spark):
    df = spark.createDataFrame([("a b", 1)], "text string, lines_num int")
    got = quality_features(df, prefix="q_", features=["words_num", "dup_9gram"])
    assert got.columns == ["text", "lines_num", "q_words_num", "q_dup_9gram"] and got.first().q_words_num == 2
    with pytest.raises(KeyError, match="nope"):
        quality_features(df, features=["nope"])


def test_unused_features_are_pruned(spark):
    df = quality_features(spark.createDataFrame([("a b",)], "text string")).select("lines_num")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and "sentences" not in plan


@pytest.mark.parametrize("chunk_chars, dense_cells", [(1, 0), (40, 10), (10**6, 10**6)])
def test_kernels_do_not_depend_on_chunks(monkeypatch, chunk_chars, dense_cells):
    """Any cut of a batch, and both ways to count characters, give the same statistics."""
    import numpy as np
    import pyarrow as pa

    from sluice.functions import kernels

    monkeypatch.setattr(kernels, "CHUNK_CHARS", chunk_chars)
    monkeypatch.setattr(kernels, "DENSE_CELLS", dense_cells)
    texts = SAMPLES + ["漢字 かな 交じり 文 漢字 かな", "", "x y x y x y x"]
    chunks = list(kernels._chunks(pa.array([*texts, None])))
    assert [t for chunk in chunks for t in chunk] == [*texts, ""]
    chars = [kernels.char_table(c) for c in chunks]
    words = [kernels.word_table(c, (2, 10)) for c in chunks]
    for i, text in enumerate(texts):
        want = brute_features(text)
        for table, name, feature in ((chars, "entropy", "entropy"), (chars, "mean_diff", "mean_diff_unicode_value"),
                                     (words, "words", "words_num"), (words, "top_2", "dup_top_2gram"), (words, "dup_10", "dup_10gram")):
            assert abs(np.concatenate([t[name] for t in table])[i] - want[feature]) < 1e-9, (text, name)
    assert list(kernels._chunks(pa.array([], pa.string()))) == []


def test_kernels_leave_no_arrays_behind():
    """What a chunk needs is freed when it is done, without the garbage collector: else workers grow with their rows."""
    import gc
    import tracemalloc

    from sluice.functions import kernels

    chunk = [" ".join(f"w{(i * j) % 997}" for i in range(300)) for j in range(1, 60)]
    kernels.word_table(chunk, (2, 4, 10)), kernels.char_table(chunk)
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        for _ in range(10):
            kernels.word_table(chunk, (2, 4, 10)), kernels.word_table(chunk), kernels.char_table(chunk)
        left = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
        gc.enable()
    assert left < 500_000  # the arrays of one chunk take 2 MB


def test_a_batch_is_not_turned_into_strings_at_once():
    """Only the texts of a chunk are Python strings, so a worker holds a batch once."""
    import tracemalloc

    import pyarrow as pa

    from sluice.functions import kernels

    texts = pa.array(["0123456789" * 100] * 8_000)
    tracemalloc.start()
    try:
        assert sum(len(chunk) for chunk in kernels._chunks(texts)) == 8_000
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 3 * kernels.CHUNK_CHARS

"""The text-quality features.

Lines, sentences, stop words and markup are native SQL expressions; statistics over every character, word or n-gram come
from the Arrow kernels. All of it is row-local, needs no shuffle and runs on streams as well. Shared intermediates are columns of
an earlier projection, and only those that the wanted features need are built.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.kernels import CHAR_FIELDS, char_stats_udf, word_stats_udf

# Stop words per language.
STOP_WORDS = {
    "en": "a an and are as at be but by for from has have he in is it its not of on or she that the their they "
    "this to was we were which will with you".split(),
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas "
    "pour que qui sa se ses son sur un une vous".split(),
    "de": "als am an auch auf aus bei das dass dem den der des die ein eine einem einen er es für ich im in ist "
    "mit nicht noch oder sich sie sind so und von war wie wir zu zum".split(),
    "es": "al como con de del el ella en es esta este ha la las le lo los más me no nos o para pero por que se "
    "si sin su sus un una y ya".split(),
}

# The patterns behind the counts, as SQL literals.
SPACE = r"r'[ \t\n\r\f]+'"
SPACE_CHARS = r"' \t\n\r\u000C'"
EDGE_PUNCTUATION = r"r'(?<![^ \t\n\r\f])\p{P}+|\p{P}+(?![^ \t\n\r\f])'"
SENTENCE_END = "'[.!?。！？]'"
SENTENCE_CUT = "'[.!?。！？]+'"
ENTITY = "'&(#[0-9]+|#x[0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);'"
URL = r"r'https?://[^ \t\n\r\f]+'"
BULLET_LINE = r"r'(?md)^[ \t]*([-*•·]|[0-9]+[.)])[ \t]'"
ELLIPSIS_LINE = r"r'(?md)(\.\.\.|…)$'"
SCRIPT_LINE = "'(?md)^.*[Jj]ava[Ss]cript.*$'"

# The feature names, grouped by what their computation shares.
FEATURE_GROUPS = {
    "lines_words": (
        "lines_num", "words_num", "average_words_per_line", "word_compression", "unique_words_frac",
        "content_word_len", "content_word_frac",
    ),
    "chars": (
        "num_len", "num_frac", "space_len", "space_frac", "enter_frac", "max_continue_space_num", "punc_len",
        "punc_frac", "emoji_len", "emoji_frac", "special_char_len", "special_char_frac",
    ),
    "sentences": (
        "punc_end_sentence_num", "punc_end_sentence_mean_len", "stop_word_num", "stop_word_frac",
        "ellipsis_line_frac", "bulletpoint_line_frac",
    ),
    "markup": ("html_semi_entity_count", "html_semi_entity_frac", "url_char_frac"),
    "repetition": ("dup_top_2gram", "dup_top_4gram", "dup_10gram"),
    "unicode": ("entropy", "std_dev_unicode_value", "mean_diff_unicode_value"),
}
FEATURES = tuple(name for group in FEATURE_GROUPS.values() for name in group)
EXTRA_FEATURES = (
    "content_len", "ellipsis_line_num", "js_line_frac", "dup_top_3gram", "dup_5gram", "dup_6gram", "dup_7gram",
    "dup_8gram", "dup_9gram",
)


def _ratio(a: str, b: str) -> str:
    """``a / b`` with x/0 = 0."""
    return f"if({b} = 0, 0D, double({a}) / {b})"


def _length(pieces: str) -> str:
    return f"length(array_join({pieces}, ''))"


def _count(pattern: str) -> str:
    return f"regexp_count(__text, {pattern})"


def _matches(pattern: str) -> str:
    return f"regexp_extract_all(__text, {pattern}, 0)"


def _stop_words(by_language: bool) -> str:
    def hits(words) -> str:
        listed = ", ".join(f"'{w}'" for w in words)
        return f"size(filter(split(__stripped, {SPACE}), w -> w IN ({listed})))"

    if not by_language:
        return hits(sorted({w for words in STOP_WORDS.values() for w in words}))
    cases = " ".join(f"WHEN '{code}' THEN {hits(words)}" for code, words in STOP_WORDS.items())
    return f"CASE __lang {cases} ELSE 0 END"


def _stages(by_language: bool) -> list[dict[str, str]]:
    """Intermediate columns; each projection may use those before it."""
    return [
        {
            "__n": "length(__text)",
            "__stripped": f"regexp_replace(lower(__text), {EDGE_PUNCTUATION}, '')",
            "__sentences": f"filter(transform(split(__text, {SENTENCE_CUT}), s -> btrim(s, {SPACE_CHARS})), s -> s != '')",
            "__entities": _matches(ENTITY),
            "__lines": r"length(__text) - length(replace(__text, '\n', '')) + 1",
        },
        {"__stops": _stop_words(by_language)},
    ]


def _definitions() -> dict[str, str]:
    return {
        "lines_num": "bigint(__lines)",
        "words_num": "__words.words",
        "average_words_per_line": _ratio("__words.words", "__lines"),
        "word_compression": _ratio("__words.unique_word_chars", "__words.word_chars"),
        "unique_words_frac": _ratio("__words.unique_words", "__words.words"),
        "content_word_len": "__chars.letters",
        "content_word_frac": _ratio("__chars.letters", "__n"),
        "num_len": "__chars.digits",
        "num_frac": _ratio("__chars.digits", "__n"),
        "space_len": "__chars.blanks",
        "space_frac": _ratio("__chars.blanks", "__n"),
        "enter_frac": _ratio("(__lines - 1)", "__n"),
        "max_continue_space_num": f"bigint(coalesce(array_max(transform({_matches("' +'")}, s -> length(s))), 0))",
        "punc_len": "__chars.puncts",
        "punc_frac": _ratio("__chars.puncts", "__n"),
        "emoji_len": "__chars.emojis",
        "emoji_frac": _ratio("__chars.emojis", "__n"),
        "special_char_len": "__chars.symbols",
        "special_char_frac": _ratio("__chars.symbols", "__n"),
        "punc_end_sentence_num": f"bigint({_count(SENTENCE_END)})",
        "punc_end_sentence_mean_len": _ratio(_length("__sentences"), "size(__sentences)"),
        "stop_word_num": "bigint(__stops)",
        "stop_word_frac": _ratio("__stops", "__words.words"),
        "ellipsis_line_frac": _ratio(_count(ELLIPSIS_LINE), "__lines"),
        "bulletpoint_line_frac": _ratio(_count(BULLET_LINE), "__lines"),
        "html_semi_entity_count": "bigint(size(__entities))",
        "html_semi_entity_frac": _ratio(_length("__entities"), "__n"),
        "url_char_frac": _ratio(_length(_matches(URL)), "__n"),
        "entropy": "__chars.entropy",
        "std_dev_unicode_value": "__chars.std_dev",
        "mean_diff_unicode_value": "__chars.mean_diff",
        "content_len": "bigint(__n)",
        "ellipsis_line_num": f"bigint({_count(ELLIPSIS_LINE)})",
        "js_line_frac": _ratio(_count(SCRIPT_LINE), "__lines"),
        **{f"dup_top_{k}gram": f"__words.top_{k}" for k in (2, 3, 4)},
        **{f"dup_{k}gram": f"__words.dup_{k}" for k in (5, 6, 7, 8, 9, 10)},
    }


def quality_features(
    df: DataFrame,
    text_col: str = "text",
    prefix: str = "",
    lang_col: str | None = None,
    extra: bool = False,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Add quality features of ``text_col`` as columns named ``prefix + feature``.

    Without ``features``, all of ``FEATURES`` are added, and with ``extra`` the optional ones as well. ``lang_col`` picks
    the stop words of one language; without it the words of all languages count. NULL text gives NULL features.
    """
    wanted = list(features) if features is not None else list(FEATURES + EXTRA_FEATURES if extra else FEATURES)
    definitions, stages = _definitions(), _stages(lang_col is not None)
    unknown = [name for name in wanted if name not in definitions]
    if unknown:
        raise KeyError(f"unknown features: {unknown}")

    used = " ".join(definitions[name] for name in wanted)
    for stage in reversed(stages):
        used += " " + " ".join(sql for name, sql in stage.items() if re.search(rf"{name}\b", used))
    chars = [name for name in CHAR_FIELDS if f"__chars.{name}" in used]
    sizes = sorted({int(k) for k in re.findall(r"__words\.(?:dup|top)_(\d+)", used)})

    original = [F.col(f"`{c}`") for c in df.columns]
    lang = [F.col(f"`{lang_col}`").alias("__lang")] if lang_col else []
    staged = df.select(*original, F.col(f"`{text_col}`").alias("__text"), *lang)
    kernels = {}
    if chars:
        kernels["__chars"] = char_stats_udf(chars)(F.col("__text"))
    if "__words." in used:
        kernels["__words"] = word_stats_udf(sizes)(F.col("__text"))
    staged = staged.withColumns(kernels) if kernels else staged
    for stage in stages:
        needed = {name: F.expr(sql) for name, sql in stage.items() if re.search(rf"{name}\b", used)}
        staged = staged.withColumns(needed) if needed else staged
    named = [F.expr(f"if(__text IS NULL, NULL, {definitions[n]})").alias(prefix + n) for n in wanted]
    return staged.select(*original, *named)

"""Character, word and n-gram statistics of a batch of texts, as numpy kernels behind Arrow UDFs.

Higher-order functions evaluate their lambdas one element at a time and outside generated code; for statistics over
every character, word or n-gram that costs about ten times as much as these kernels (figures in the README). A kernel works
on whole batches, never on single texts, and sees only the text column.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 18
DENSE_CELLS = 1 << 22

CHAR_FIELDS = {
    "entropy": pa.float64(), "std_dev": pa.float64(), "mean_diff": pa.float64(), "letters": pa.int64(),
    "digits": pa.int64(), "blanks": pa.int64(), "puncts": pa.int64(), "emojis": pa.int64(), "symbols": pa.int64(),
}
WORD_FIELDS = ("words", "unique_words", "word_chars", "unique_word_chars")
TOP_SIZES = (2, 3, 4)
# Code point ranges counted as emoji.
EMOJI_RANGES = ((0x1F300, 0x1FAFF), (0x2600, 0x27BF))


def _chunks(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in order, cut so that a chunk holds about ``CHUNK_CHARS`` characters; NULL counts as empty.

    Only the texts of one chunk are Python strings at a time, whatever the size of the batch.
    """
    ends = np.cumsum(pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = 1 + int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_CHARS))
        yield [text or "" for text in texts.slice(at, end - at).to_pylist()]
        at = end


def _share(total: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """``total / parts`` with x/0 = 0."""
    return np.divide(total, parts, out=np.zeros(len(parts)), where=parts > 0)


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of each text, and row and code point of each character."""
    n = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    return n, np.repeat(np.arange(len(n)), n), codes


def _histogram(rows: np.ndarray, codes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code point and count of each distinct character of each row."""
    present = np.zeros(codes.max(initial=0) + 1, dtype=bool)
    present[codes] = True
    alphabet = np.flatnonzero(present)
    rank = np.zeros(len(present), dtype=np.int64)
    rank[alphabet] = np.arange(len(alphabet))
    cells = rows * len(alphabet) + rank[codes]
    if n_rows * len(alphabet) <= DENSE_CELLS:
        counts = np.bincount(cells)
        cells = np.flatnonzero(counts)
        counts = counts[cells]
    else:
        cells, counts = np.unique(cells, return_counts=True)
    return cells // len(alphabet), alphabet[cells % len(alphabet)], counts


def _classes(codes: np.ndarray) -> dict[str, np.ndarray]:
    """Which of the code points belong to each character class."""
    alphabet, place = np.unique(codes, return_inverse=True)
    category = np.array([unicodedata.category(chr(c)) for c in alphabet], dtype="U2")[place]
    major = category.astype("U1")
    return {
        "letters": major == "L", "digits": category == "Nd", "blanks": (codes == 32) | (codes == 9),
        "puncts": major == "P", "symbols": major == "S",
        "emojis": np.logical_or.reduce([(codes >= low) & (codes <= high) for low, high in EMOJI_RANGES]),
    }


def char_table(texts: list[str], names: Iterable[str] = tuple(CHAR_FIELDS)) -> dict[str, np.ndarray]:
    """The named character statistics of each text."""
    n, rows, codes = _code_points(texts)

    def per_row(row: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=weight, minlength=len(n))

    row, code, count = _histogram(rows, codes, len(n))
    table, classes = {}, None
    for name in names:
        if name == "entropy":
            p = count / n[row]
            table[name] = per_row(row, -p * np.log2(p))
        elif name == "std_dev":
            mean = _share(per_row(row, code * count), n)
            table[name] = np.sqrt(_share(per_row(row, count * (code - mean[row]) ** 2), n))
        elif name == "mean_diff":
            inside = rows[1:] == rows[:-1]
            table[name] = _share(per_row(rows[1:][inside], np.abs(np.diff(codes))[inside]), n - 1)
        else:
            classes = classes or _classes(code)
            table[name] = per_row(row, count * classes[name]).astype(np.int64)
    return table


def char_counts(texts: list[str]) -> pa.Array:
    """The distinct characters of each text with their counts, in character order."""
    n, rows, codes = _code_points(texts)
    row, code, count = _histogram(rows, codes, len(n))
    alphabet, place = np.unique(code, return_inverse=True)
    chars = pa.array([chr(c) for c in alphabet], pa.string()).take(pa.array(place))
    entries = pa.StructArray.from_arrays([chars, pa.array(count, pa.int64())], names=["ch", "n"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n)))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word number and length of each word, cut at blanks, tabs, line and page breaks; equal words have equal numbers."""
    spaced = [t.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\f", " ") for t in texts]
    pieces = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
    row, word = pc.list_parent_indices(pieces).to_numpy().astype(np.int64), pc.list_flatten(pieces)
    coded = word.dictionary_encode()
    number = coded.indices.to_numpy()
    length = pc.utf8_length(coded.dictionary).to_numpy()[number].astype(np.int64)
    kept = length > 0
    return row[kept], number[kept].astype(np.int64), length[kept]


def _number(pairs: np.ndarray) -> np.ndarray:
    """Dense numbers for 64-bit keys, equal for equal keys."""
    return pd.factorize(pairs)[0].astype(np.int64)


def _grams(k: int, row: np.ndarray, word: np.ndarray, vocabulary: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Numbers of the ``k`` words from each position on; those of different texts never agree. ``known`` keeps them by ``k``.

    A function of its own: a closure that calls itself is a cycle, and would hold every array of a chunk until the garbage collector runs.
    """
    if k not in known:
        size = max(len(row) - k + 1, 0)
        if k == 2:
            left, right = row[:size] * vocabulary + word[:size], word[1:1 + size]
        else:
            half = 1 << ((k - 1).bit_length() - 1)
            left = _grams(half, row, word, vocabulary, known)[:size]
            right = (_grams(k - half, row, word, vocabulary, known) if k - half > 1 else word)[half:half + size]
        known[k] = _number(left * (right.max(initial=0) + 1) + right)
    return known[k]


def word_table(texts: list[str], sizes: Iterable[int] = ()) -> dict[str, np.ndarray]:
    """The ``WORD_FIELDS`` of each text and, per n-gram size, the share of repeated n-grams (``dup_k``) and, for the
    ``TOP_SIZES``, of characters under the most frequent one (``top_k``)."""
    row, word, length = _words(texts)
    n_rows = len(texts)
    vocabulary = word.max(initial=0) + 1
    ends = np.concatenate([[0], np.cumsum(length)])
    chars = np.bincount(row, weights=length, minlength=n_rows)
    first = np.unique(row * vocabulary + word, return_index=True)[1]
    table = {
        "words": np.bincount(row, minlength=n_rows),
        "unique_words": np.bincount(row[first], minlength=n_rows),
        "word_chars": chars.astype(np.int64),
        "unique_word_chars": np.bincount(row[first], weights=length[first], minlength=n_rows).astype(np.int64),
    }
    known: dict[int, np.ndarray] = {}
    for k in sizes:
        gram = _grams(k, row, word, vocabulary, known)
        start = np.flatnonzero(row[:len(gram)] == row[k - 1:k - 1 + len(gram)])
        gram, owner = gram[start], row[start]
        count = np.bincount(gram)
        row_of = np.zeros(len(count), dtype=np.int64)
        row_of[gram] = owner
        distinct = np.bincount(row_of[count > 0], minlength=n_rows)
        total = np.bincount(owner, minlength=n_rows)
        table[f"dup_{k}"] = _share(total - distinct, total)
        if k in TOP_SIZES:
            size = np.zeros(len(count), dtype=np.int64)
            size[gram] = ends[start + k] - ends[start]
            # Count first, then length; a gram is shorter than 2 ** 32.
            best = np.zeros(n_rows, dtype=np.int64)
            np.maximum.at(best, row_of, (count << 32) + size)
            table[f"top_{k}"] = _share((best >> 32) * (best & 0xFFFFFFFF), chars)
    return table


def _struct_udf(kernel: Callable[[list[str]], dict[str, np.ndarray]], fields: dict[str, pa.DataType]):
    """Arrow UDF from texts to a struct of the kernel's statistics."""
    schema = ", ".join(f"{name} {'double' if kind == pa.float64() else 'bigint'}" for name, kind in fields.items())

    def stats(texts: pa.Array) -> pa.Array:
        tables = [kernel(chunk) for chunk in _chunks(texts)]
        columns = [pa.array(np.concatenate([t[name] for t in tables]) if tables else [], kind) for name, kind in fields.items()]
        return pa.StructArray.from_arrays(columns, names=list(fields))

    return F.arrow_udf(stats, schema)


def char_stats_udf(names: Iterable[str] = tuple(CHAR_FIELDS)):
    """Arrow UDF: text to a struct of some ``CHAR_FIELDS``."""
    names = tuple(names)
    return _struct_udf(lambda texts: char_table(texts, names), {name: CHAR_FIELDS[name] for name in names})


def word_stats_udf(sizes: Iterable[int] = ()):
    """Arrow UDF: text to a struct of the ``WORD_FIELDS``, of ``dup_k`` and, for the smallest sizes, ``top_k``."""
    sizes = tuple(sizes)
    shares = [f"dup_{k}" for k in sizes] + [f"top_{k}" for k in sizes if k in TOP_SIZES]
    fields = {**dict.fromkeys(WORD_FIELDS, pa.int64()), **dict.fromkeys(shares, pa.float64())}
    return _struct_udf(lambda texts: word_table(texts, sizes), fields)


def char_counts_udf():
    """Arrow UDF: text to an array of its distinct characters with their counts."""
    kind = pa.list_(pa.struct([("ch", pa.string()), ("n", pa.int64())]))

    def counts(texts: pa.Array) -> pa.Array:
        chunks = [char_counts(chunk) for chunk in _chunks(texts)]
        return pa.concat_arrays(chunks) if chunks else pa.array([], kind)

    return F.arrow_udf(counts, "array<struct<ch:string,n:bigint>>")

"""Runs of repeated words: maximal stretches of a text that are periodic, and the text with each run cut to its first period.

A run's period is a Lyndon word under an order of the words or under the reverse order: the longest Lyndon word that starts there
(the runs theorem). Both Lyndon arrays come from the first phase of a suffix sorter that works by groups (Baier): suffixes are
grouped by their first word, groups are taken from the greatest to the smallest, and each member of a group hands the group's
context to the nearest suffix on its left that is in a smaller group; the receivers leave their group for a new one right above
it. When a group is taken, its context is the longest Lyndon prefix of its members. No suffix array is needed. Equal neighbouring Lyndon
words are then extended to both sides by longest common extensions over the whole text.

The sorter runs where a run can be. Inside a run of period q each word sequence of up to 8 words occurs again at most q words
earlier, so a run leaves a stretch of starts whose previous occurrence is near, of a length that follows from q; for each power of
two this is tested over whole batches with numpy. Most texts have no such stretch, and then have no run. The test only ever lets too
much pass: hashes that collide make distances smaller.

Row-local, no shuffle. Memory follows CHUNK words or the longest text, whichever is more. Results for odd input: null and empty texts
have no words and no runs; equal rows have equal results; columns beyond the two named are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 400_000  # words looked at together
GRAM = 8  # longest word sequence of the test
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Words = list[bytes]


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there; the end of the sequence is smaller than any symbol."""
    values = sorted(set(symbols))
    number = {v: g for g, v in enumerate(values)}
    group = [number[s] for s in symbols]
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(values)
    below = list(range(-1, len(values) - 1))
    above = list(range(1, len(values) + 1))
    lengths = [0] * len(symbols)
    near = list(range(len(symbols) + 1))  # place + 1 to the nearest place + 1 at or before it whose group is not taken yet; 0 is none
    g = len(values) - 1
    while g >= 0:
        taken = [i for i in members[g] if group[i] == g]
        length = context[g]
        for i in taken:
            lengths[i] = length
            near[i + 1] = i
        times: dict[int, int] = {}
        for i in taken:
            while near[i] != i:
                near[i] = near[near[i]]
                i = near[i]
            if i:
                times[i - 1] = times.get(i - 1, 0) + 1
        by_times: dict[int, list[int]] = {}
        for j, k in times.items():
            by_times.setdefault(k, []).append(j)
        for k in sorted(by_times, reverse=True):
            split: dict[int, int] = {}
            for j in by_times[k]:
                old = group[j]
                new = split.get(old)
                if new is None:
                    new = split[old] = len(context)
                    context.append(context[old] + k * length)
                    members.append([])
                    over = above[old]
                    below.append(old)
                    above.append(over)
                    above[old] = new
                    if over < len(below):
                        below[over] = new
                members[new].append(j)
                group[j] = new
        g = below[g]
    return lengths


def _extension(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words agree from places ``a`` < ``b`` on, to the right (step 1) or to the left of them (step -1)."""
    agreed, width = 0, 64
    while True:
        if step > 0:
            room = min(width, len(ids) - b - agreed)
            same = ids[a + agreed:a + agreed + room] == ids[b + agreed:b + agreed + room]
        else:
            room = min(width, a - agreed)
            same = (ids[a - agreed - room:a - agreed] == ids[b - agreed - room:b - agreed])[::-1]
        if room <= 0:
            return agreed
        if not same.all():
            return agreed + int(same.argmin())
        agreed += room
        width *= 2


def runs_in(ids: np.ndarray, begin: int, end: int, min_length: int, exponent: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs whose Lyndon words lie in ``ids[begin:end]``, at their full extent in ``ids``."""
    found: set[tuple[int, int, int]] = set()
    part = ids[begin:end]
    symbols = part.tolist()
    top = max(symbols)
    for ordered in (symbols, [top - s for s in symbols]):
        q = np.array(lyndon_lengths(ordered), np.int64)
        at = np.flatnonzero(np.arange(len(q)) + 2 * q <= len(q))
        p = q[at]
        # Two neighbouring roots of one run: equal lengths, and equal first and last words before whole ones are compared.
        alike = (q[np.minimum(at + p, len(q) - 1)] == p) & (part[at] == part[np.minimum(at + p, len(q) - 1)])
        at, p = at[alike], p[alike]
        alike = part[at + p - 1] == part[at + 2 * p - 1]
        reach: dict[int, int] = {}  # by period: where its last run ended
        for i, period in zip((at[alike] + begin).tolist(), p[alike].tolist()):
            if i + 2 * period <= reach.get(period, 0):
                continue
            stop = i + period + _extension(ids, i, i + period, 1)
            if stop < i + 2 * period:
                continue
            start = i - _extension(ids, i, i + period, -1)
            reach[period] = stop
            if stop - start >= max(min_length, exponent * period):
                found.add((start, stop - start, period))
    return found


def _distances(hashes: np.ndarray) -> np.ndarray:
    """Steps back to the previous equal hash; a very large number where there is none."""
    bits = np.uint64(max(len(hashes) - 1, 1).bit_length())
    keys = np.sort((hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64))
    place = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    same = keys[1:] >> bits == keys[:-1] >> bits
    out = np.full(len(hashes), np.iinfo(np.int64).max, np.int64)
    out[place[1:][same]] = place[1:][same] - place[:-1][same]
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def possible_stretches(hashes: np.ndarray, bounds: np.ndarray, min_length: int, exponent: int) -> list[tuple[int, int]]:
    """Merged ranges of places outside of which no run has its words. ``bounds`` are the starts of the texts, and the end."""
    total = len(hashes)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    grams = {1: _mixed(hashes + _mixed(text.astype(np.uint64) + np.uint64(1)))}
    longest = int(np.diff(bounds).max(initial=0))
    found, width, near, scale = [], 0, np.zeros(0, np.int64), 1
    while exponent * scale <= longest:  # periods from scale to 2 * scale - 1
        if min(scale, GRAM) != width:
            width = min(scale, GRAM)
            if width not in grams:
                half = grams[width // 2]
                grams[width] = _mixed(half[:-(width // 2)] * np.uint64(3) + half[width // 2:]) if len(half) > width // 2 else half[:0]
            near = _distances(grams[width]) if len(grams[width]) else near[:0]
        hits = np.flatnonzero(near < 2 * scale)
        if len(hits):
            least = max(min_length if scale == 1 else 0, exponent * scale) - scale - width + 1
            breaks = np.flatnonzero(np.diff(hits) > 1)
            first, last = hits[np.r_[0, breaks + 1]], hits[np.r_[breaks, len(hits) - 1]]
            long = last - first + 1 >= least
            for a, b in zip(first[long].tolist(), last[long].tolist()):
                own = int(text[a])
                found.append((max(a - 2 * scale + 1, int(bounds[own])), min(b + width + 1, int(bounds[int(text[min(b, total - 1)]) + 1]))))
        scale *= 2
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def runs_of_texts(texts: list[Words], min_length: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period."""
    bounds = np.cumsum([0, *map(len, texts)])
    hashes = np.fromiter((hash(w) for words in texts for w in words), np.int64, int(bounds[-1])).view(np.uint64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    by_text: dict[int, set] = {}
    ids: dict[int, np.ndarray] = {}
    for a, b in possible_stretches(hashes, bounds, min_length, exponent):
        k = int(np.searchsorted(bounds, a, side="right")) - 1
        if k not in ids:  # words themselves from here on, not their hashes
            number: dict[bytes, int] = {}
            ids[k] = np.array([number.setdefault(w, len(number)) for w in texts[k]], np.int64)
        start = int(bounds[k])
        by_text.setdefault(k, set()).update(runs_in(ids[k], a - start, b - start, min_length, exponent))
    for k, runs in by_text.items():
        out[k] = sorted(runs, key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: Words, runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _batches(batch: pa.RecordBatch, rewrite: Callable[[object, Words], Words] | None) -> Iterator[tuple[int, list[Words]]]:
    """Neighbouring rows of about CHUNK words."""
    first, held, words = 0, [], 0
    keys = batch.column(0).to_pylist() if rewrite else None
    for i in range(batch.num_rows):
        text = batch.column(1)[i]
        own = text.as_buffer().to_pybytes().split() if text.is_valid else []
        held.append(rewrite(keys[i], own) if rewrite else own)
        words += len(own)
        if words >= CHUNK:
            yield first, held
            first, held, words = i + 1, [], 0
    if held:
        yield first, held


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, exponent: int = 4,
    rewrite: Callable[[object, Words], Words] | None = None,
) -> DataFrame:
    """Per row: the id, ``n_words``, ``runs`` (start, length, period; in words) and ``collapsed``, the text without repeated periods.

    Words are what stands between ASCII white space. A run is a maximal stretch with smallest period p and a length of at least
    ``min_length`` and ``exponent`` * p (3 at least). ``rewrite`` may change the words of a row, given its id, before.
    """
    if exponent < 3:
        raise ValueError("runs of less than three periods are not looked for")
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    id_type = rows.schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _batches(batch, rewrite):
                found = runs_of_texts(texts, min_length, exponent)
                sizes = np.cumsum([0, *map(len, found)])
                flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
                runs = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(flat[:, c]) for c in range(3)], fields=list(_RUN)))
                shown = pa.array([collapsed(w, r) for w, r in zip(texts, found)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array([len(w) for w in texts], pa.int64()), runs, shown],
                    names=[id_col, "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, n_words bigint, runs {RUNS}, collapsed string")

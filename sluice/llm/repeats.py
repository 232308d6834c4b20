"""Repeated byte strings of a corpus: maximal repeat groups from a common-prefix interval tree, and texts without what is repeated.

**Which strings meet.** For every start p of a string of ``length`` bytes, the place x in a window behind p with the smallest hash of
eight bytes is its anchor; equal strings have equal anchors. Neighbouring starts share an anchor, so a text is a few *pieces*, each
the bytes of all strings of one anchor, and two strings can only be equal if the bytes at their anchors are. Pieces travel as hashes
first: an anchor that no other piece has ends here, and pieces that are equal as a whole are one string with a count. What is left,
different pieces around equal anchors, is sorted.

**The tree.** A task takes whole groups of pieces and builds an enhanced suffix array of them: ranks by doubling, then the longest common
prefix of neighbours. A stack scan over stretches of common prefixes of ``length`` bytes and more yields the intervals of the
prefix tree. An interval whose members all have the same byte on their left is no maximal repeat, since the repeat is longer to the left;
the others are, and every member is an occurrence, not just the neighbours in the array. A member is given once, with the deepest
maximal repeat that holds it, and every group names the group around it, so the output is linear and all occurrences of a group are its
own and those of the groups inside it. Pieces end ``length`` bytes behind their last start, so a longer repeat is a chain of overlapping
groups.

**Bounds.** A group of more than LIMIT different pieces (a common passage between ever different neighbours) is not sorted in one task:
its pieces are cut into parts that have nearly all bytes in common and are grouped anew, and what is still too large then is compared
string by string, by 128-bit hashes. Copies of whole texts take part once. Nothing is dropped, capped or
broadcast; the driver sees no row. A task holds CHUNK bytes of pieces or one group, or one text.

Equality of pieces and of texts is that of their 128-bit hashes. Results for odd input: null texts are empty; a text shorter than
``length`` loses nothing; equal texts of at least ``length`` bytes lose all; repeated rows are equal texts; bytes are
cut where the repeat ends, also inside a character, so ``kept`` is binary; an empty table gives no rows; columns beyond the two named are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import materialize

GRAM = 8
BASE = 4  # bytes of the first ranks
PLACE_BITS = 21  # two ranks and a place are one number of 64 bits
LIMIT = 2048  # pieces of a group that one task sorts
CHUNK = 400_000  # bytes sorted together, if groups are smaller
REMEMBERED = 200_000  # texts that a task knows again

PIECE = "key binary, lo int, size int, anchor bigint, piece binary"
COVER = "anchor bigint, piece binary, start int, stop int, repeat bigint, around bigint"
_PIECE = pa.schema([("key", pa.binary()), ("lo", pa.int32()), ("size", pa.int32()), ("anchor", pa.int64()), ("piece", pa.binary())])
_STRING = pa.schema([("anchor", pa.int64()), ("piece", pa.binary()), ("hot", pa.bool_()), ("content", pa.binary())])
_COVER = pa.schema([("anchor", pa.int64()), ("piece", pa.binary()), ("start", pa.int32()), ("stop", pa.int32()), ("repeat", pa.int64()),
                    ("around", pa.int64())])


def window_of(length: int) -> int:
    """Places that an anchor is chosen from: the greatest power of two up to two thirds of the length."""
    if length < 16:
        raise ValueError("strings of less than 16 bytes are not looked for")
    return 1 << ((length * 2 // 3).bit_length() - 1)


def _grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number that sorts like them."""
    out = np.zeros(max(len(data) - GRAM + 1, 0), np.uint64)
    for k in range(GRAM):
        out = (out << np.uint64(8)) | data[k:len(out) + k]
    return out


def pieces_of(text: bytes, length: int) -> list[tuple[int, int, int]]:
    """(first start, last start, anchor place) of the pieces of a text, in order."""
    starts = len(text) - length + 1
    if starts <= 0:
        return []
    window = window_of(length)
    value = _grams(np.frombuffer(text, np.uint8))
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    least = (value >> np.uint64(32) << np.uint64(32)) | np.arange(len(value), dtype=np.uint64)  # of equal hashes the first place
    width = 1
    while width < window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    place = (least[:starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], starts] - 1
    return list(zip(first.tolist(), last.tolist(), place[first].tolist()))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _cut(length: int):
    core = length - window_of(length) + 1  # bytes from the anchor on that all strings of a piece hold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                text = text.as_buffer().to_pybytes()
                rows += [(key, lo, hi - lo + length, _signed(xxhash.xxh3_64_intdigest(text[x:x + core])), xxhash.xxh3_128_digest(text[lo:hi + length]))
                         for lo, hi, x in pieces_of(text, length)]
                if len(rows) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE.types)], schema=_PIECE)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE.types)], schema=_PIECE)

    return run


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted pieces of each text."""
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
            text = text.as_buffer().to_pybytes()
            for w in wanted:
                rows.append((w["anchor"], w["piece"], w["hot"], text[w["lo"]:w["lo"] + w["size"]]))
                held += w["size"]
            if held > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _STRING.types)], schema=_STRING)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _STRING.types)], schema=_STRING)


def _numbered(keys: np.ndarray, bits: int, changed: np.ndarray | None = None) -> np.ndarray:
    """Ranks by the upper bits of sorted keys, whose lower ``bits`` are places. Equal upper bits are one rank, but not where ``changed``."""
    place = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    upper = keys >> np.uint64(bits)
    new = np.r_[False, upper[1:] != upper[:-1]]
    if changed is not None:
        new[1:] |= changed[place[1:]]
    out = np.empty(len(keys), np.uint64)
    out[place] = np.cumsum(new)
    return out


class SuffixArray:
    """Suffixes of several strings, those of at least ``length`` bytes in order, with the common prefix of neighbours.

    Places are ranked by their first BASE bytes, then by twice as many, up to a power of two below ``length``. A rank, the rank behind it
    and the place are one number of 64 bits, so that a round is one sort of numbers. Only suffixes that are long enough are put into their
    full order.
    """

    def __init__(self, strings: list[bytes], length: int) -> None:
        sizes = np.array([len(s) for s in strings], np.int64)
        begin = np.cumsum(np.r_[0, sizes[:-1] + BASE])
        self.data = np.frombuffer(b"".join(s + b"\0" * BASE for s in strings) + b"\0" * BASE, np.uint8)
        total = len(self.data) - BASE
        if total >= 1 << PLACE_BITS:
            raise ValueError("too many bytes for one suffix array")
        self.left_in = np.repeat(begin + sizes, sizes + BASE) - np.arange(total)  # bytes to the end of the string
        self.owner = np.repeat(np.arange(len(strings)), sizes + BASE)
        self.begin = begin
        grams = np.zeros(total, np.uint64)
        for k in range(BASE):
            grams = grams << np.uint64(8) | self.data[k:total + k]
        short = self.left_in < BASE  # places in order by their bytes that compare equal to no other
        place = np.arange(total, dtype=np.uint64)
        keys = np.sort((grams << np.uint64(1) | short) << np.uint64(PLACE_BITS) | place)
        rank = _numbered(keys, PLACE_BITS, short)
        self.levels = [(BASE, rank)]
        width = BASE
        while 2 * width <= length:
            rank = self._paired(rank, rank, width, place)
            width *= 2
            self.levels.append((width, rank))
        starts = np.flatnonzero(self.left_in >= length)
        order = rank[starts]
        for reach in range(width, int(sizes.max(initial=0)) + 1, width):  # the order of long suffixes, block by block
            after = rank[np.minimum(starts + reach, total - 1)]
            keys = np.sort(order << np.uint64(2 * PLACE_BITS) | after << np.uint64(PLACE_BITS) | np.arange(len(starts), dtype=np.uint64))
            order = _numbered(keys, PLACE_BITS)
        by_order = np.argsort(order, kind="stable")
        self.suffixes = starts[by_order]
        self.common = self._common(self.suffixes[:-1], self.suffixes[1:], length)

    @staticmethod
    def _paired(rank: np.ndarray, after: np.ndarray, width: int, place: np.ndarray) -> np.ndarray:
        keys = rank << np.uint64(2 * PLACE_BITS) | place
        keys[:-width] |= after[width:] << np.uint64(PLACE_BITS)
        keys.sort()
        return _numbered(keys, PLACE_BITS)

    def _common(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Common prefix of places; 0 instead of less than ``length``."""
        out = np.zeros(len(a), np.int64)
        pairs = np.arange(len(a))
        for _, rank in self.levels[-1:]:  # what differs early is left out early
            pairs = pairs[rank[a] == rank[b]]
        a, b, agreed = a[pairs], b[pairs], np.zeros(len(pairs), np.int64)
        last = len(self.owner) - 1
        width, rank = self.levels[-1]
        for _ in range(int(self.left_in.max(initial=0)) // width):
            agreed += width * (rank[np.minimum(a + agreed, last)] == rank[np.minimum(b + agreed, last)])
        for width, rank in reversed(self.levels[:-1]):
            agreed += width * (rank[np.minimum(a + agreed, last)] == rank[np.minimum(b + agreed, last)])
        for _ in range(BASE - 1):
            i, j = np.minimum(a + agreed, last), np.minimum(b + agreed, last)
            agreed += (self.left_in[i] > 0) & (self.left_in[j] > 0) & (self.data[i] == self.data[j])
        out[pairs] = np.where(agreed >= length, agreed, 0)
        return out


DIVERSE = -1


def interval_tree(common: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """The deepest maximal repeat of each member of a stretch of suffixes: (depth, first member, depth of the maximal repeat around it).

    ``common`` are the common prefixes of neighbours, all above 0; ``left`` the bytes on the left, DIVERSE where there is none. Nodes are
    closed by a stack scan from left to right; a node is a maximal repeat unless its members have one byte on the left. The root of the
    stretch always counts: the caller leaves out stretches with one byte on the left.
    """
    # A node: depth, first member, byte on the left, own members, nodes inside.
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(left)
    stack: list[list] = []

    def take(node: list, byte: int) -> None:
        node[2] = byte if node[2] is None or node[2] == byte else DIVERSE

    for i in range(1, len(left) + 1):
        height = common[i - 1] if i < len(left) else 0
        member, held, first = i - 1, False, i - 1
        if stack and stack[-1][0] >= height:
            stack[-1][3].append(member)
            take(stack[-1], left[member])
            held = True
        inner = None
        while stack and stack[-1][0] > height:
            inner = stack.pop()
            first = inner[1]
            if stack and stack[-1][0] >= height:
                stack[-1][4].append(inner)
                take(stack[-1], inner[2])
                inner_kept = True
            else:
                inner_kept = False
        if height == 0:
            break
        if not stack or stack[-1][0] < height:
            node = [height, first, None, [], []]
            if inner is not None and not inner_kept:
                node[4].append(inner)
                take(node, inner[2])
            stack.append(node)
        if not held:
            stack[-1][3].append(member)
            take(stack[-1], left[member])
    todo = [(inner, (inner[0], inner[1]), 0)] if inner is not None else []
    while todo:
        node, (depth, first), around = todo.pop()
        if node[2] == DIVERSE and node[0] > depth:
            depth, first, around = node[0], node[1], depth
        for m in node[3]:
            out[m] = (depth, first, around)
        todo += [(child, (depth, first), around) for child in node[4]]
    return out


def covers_of(strings: list[bytes], length: int) -> list[tuple[int, int, int, int, int | None]]:
    """(string, start, stop, repeat, repeat around it) of the maximal repeats of different strings; repeats are named by their bytes."""
    array = SuffixArray(strings, length)
    places, common = array.suffixes, array.common
    offset = places - array.begin[array.owner[places]]
    left = np.where(offset > 0, array.data[places - 1].astype(np.int64), DIVERSE)
    linked = np.r_[False, common > 0, False]
    opens, closes = np.flatnonzero(~linked[:-1] & linked[1:]), np.flatnonzero(linked[:-1] & ~linked[1:])
    out = []
    if not len(opens):
        return out
    # A stretch goes from the place before its first link to that of its last; one byte on the left of all: part of a longer repeat.
    bounds = np.c_[opens, closes + 1].ravel()
    padded = np.r_[left, DIVERSE]
    low, high = np.minimum.reduceat(padded, bounds)[::2], np.maximum.reduceat(padded, bounds)[::2]
    for a, b in zip(opens[(low != high) | (low == DIVERSE)].tolist(), closes[(low != high) | (low == DIVERSE)].tolist()):
        members = places[a:b + 1].tolist()
        names: dict[tuple[int, int], int] = {}

        def name(first: int, depth: int) -> int:
            if (first, depth) not in names:
                p = members[first]
                names[first, depth] = _signed(xxhash.xxh3_64_intdigest(array.data[p:p + depth].tobytes()))
            return names[first, depth]

        for k, (depth, first, around) in enumerate(interval_tree(common[a:b].tolist(), left[a:b + 1].tolist())):
            p = members[k]
            start = int(offset[a + k])
            out.append((int(array.owner[p]), start, start + depth, name(first, depth), name(first, around) if around else None))
    return out


def _sorted_groups(length: int, chunk: int):
    """Pieces that come sorted by anchor, several groups at a time."""
    def flush(keys: list, contents: list[bytes]) -> pa.RecordBatch | None:
        rows = [(*keys[s], *rest) for s, *rest in covers_of(contents, length)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _COVER.types)], schema=_COVER) if rows else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, contents, held, known = [], [], 0, set()
        for batch in batches:
            for anchor, piece, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if keys and anchor != keys[-1][0]:
                    known.clear()
                    if held >= chunk:
                        if (made := flush(keys, contents)) is not None:
                            yield made
                        keys, contents, held = [], [], 0
                if piece not in known:  # a text that is in the table twice under one id gives its pieces twice
                    known.add(piece)
                    keys.append((anchor, piece))
                    contents.append(content)
                    held += len(content) + BASE
        if keys and (made := flush(keys, contents)) is not None:
            yield made

    return run


PART = 32  # starts of a part
PART_ROWS = "of_anchor bigint, of_piece binary, shift int, anchor bigint, piece binary, content binary"
_PART = pa.schema([("of_anchor", pa.int64()), ("of_piece", pa.binary()), ("shift", pa.int32()), ("anchor", pa.int64()), ("piece", pa.binary()),
                   ("content", pa.binary())])


def parts_of(content: bytes, length: int, width: int = PART) -> list[tuple[int, int, bytes]]:
    """(first start, last start, common bytes) of the parts of a piece: starts by their distance to the anchor, ``width`` at a time."""
    ((_, last, anchor),) = pieces_of(content, length)
    out = []
    for j in range((anchor - last) // width, anchor // width + 1):
        first, final = max(0, anchor - width * (j + 1) + 1), min(last, anchor - width * j)
        out.append((first, final, content[anchor - width * j:anchor - width * (j + 1) + 1 + length]))
    return out


def _cut_parts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for anchor, piece, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for first, final, common in parts_of(content, length, min(PART, length // 2)):
                    part = content[first:final + length]
                    rows.append((anchor, piece, first, _signed(xxhash.xxh3_64_intdigest(common)), xxhash.xxh3_128_digest(part), part))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PART.types)], schema=_PART)

    return run


_WINDOW = pa.schema([("string", pa.binary()), ("anchor", pa.int64()), ("piece", pa.binary()), ("start", pa.int32())])


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                anchor, piece, content = (batch.column(i)[row].as_py() for i in range(3))
                n = len(content) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(content[i:i + length]) for i in range(n)], pa.binary()), pa.array([anchor] * n, pa.int64()),
                     pa.array([piece] * n, pa.binary()), pa.array(range(n), pa.int32())], schema=_WINDOW)

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", F.unhex(F.md5("text")).alias("key"))


def _covered(texts: DataFrame, length: int, limit: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The pieces whose anchor is in two different texts or places, and what repeats in them: both written tables."""
    # A chunk and the largest group are numbered together.
    limit = min(limit, ((1 << PLACE_BITS) - chunk) // (length + window_of(length) + BASE))
    long = texts.where(F.octet_length("text") >= length)
    cut = materialize(long.select("key", "text").mapInArrow(_cut(length), PIECE), "repeats-cut")
    # Tables that are joined to one with hot keys are written before: only a join of plain exchanges is split at hot keys.
    twice = materialize(cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor"), "repeats-twice")
    # Dealt out anew before copies go, or the join would have to keep an anchor's rows together.
    pieces = materialize(cut.join(twice, "anchor").select(*cut.columns).repartition("key", "lo").distinct(), "repeats-pieces")
    # One text and place stands for all equal pieces.
    place = F.struct("key", "lo", "size")
    strings = pieces.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("at"))
    strings = materialize(strings, "repeats-strings")
    groups = strings.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.sum("times").alias("all"))
    strings = materialize(strings.join(materialize(groups.where("all > 1").drop("all"), "repeats-groups"), "anchor"), "repeats-strings")
    equal = strings.where("times > 1").select(
        "anchor", "piece", F.lit(0).alias("start"), F.col("at.size").alias("stop"), F.xxhash64("piece").alias("repeat"),
        F.lit(None).cast("bigint").alias("around"))
    wanted = strings.where("different > 1").groupBy(F.col("at.key").alias("key")).agg(F.collect_list(F.struct(
        "anchor", "piece", (F.col("different") > limit).alias("hot"), "at.lo", "at.size")).alias("wanted"))
    one_each = long.groupBy("key").agg(F.min("id").alias("one"))  # of equal texts the one with the smallest id
    wanted = wanted.join(one_each, "key").withColumnRenamed("key", "of")
    named = long.join(wanted, (F.col("key") == F.col("of")) & F.col("id").eqNullSafe(F.col("one")))
    contents = named.select("text", "wanted").mapInArrow(_contents, "anchor bigint, piece binary, hot boolean, content binary")
    if strings.where(F.col("different") > limit).isEmpty():
        return pieces, materialize(equal.unionByName(_in_order(contents, length, chunk)), "repeats-covered")
    contents = materialize(contents, "repeats-contents")  # two readers
    covered = equal.unionByName(_in_order(contents.where("not hot"), length, chunk)).unionByName(
        _parted(contents.where("hot").drop("hot"), length, limit, chunk))
    return pieces, materialize(covered, "repeats-covered")


def _in_order(contents: DataFrame, length: int, chunk: int) -> DataFrame:
    ordered = contents.select("anchor", "piece", "content").repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(_sorted_groups(length, chunk), COVER)


def _parted(contents: DataFrame, length: int, limit: int, chunk: int) -> DataFrame:
    """Covers of pieces whose groups are too large for a task: each is cut into parts of PART starts.

    The strings of a part have all but PART - 1 bytes in common, so groups of equal common bytes are far smaller than those of an anchor.
    Those that are still too large (many strings that differ in a few bytes only) are compared by the hashes of their strings.
    """
    parts = materialize(contents.mapInArrow(_cut_parts(length), PART_ROWS).distinct(), "repeats-parts")
    strings = parts.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("of_anchor", "of_piece")).alias("of"))
    strings = materialize(strings, "repeats-part-strings")
    groups = strings.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.sum("times").alias("all")).where("all > 1")
    strings = strings.join(materialize(groups.drop("all"), "repeats-part-groups"), "anchor")
    named = parts.join(strings, ["anchor", "piece"]).where((F.col("of_anchor") == F.col("of.of_anchor")) & (F.col("of_piece") == F.col("of.of_piece")))
    # The same part can stand twice in one piece's row only under another place, so one row is left of each string.
    named = materialize(named.select("anchor", "piece", "times", "different", "content").dropDuplicates(["anchor", "piece"]), "repeats-part-contents")
    equal = named.where("times > 1").select(
        "anchor", "piece", F.lit(0).alias("start"), F.octet_length("content").alias("stop"), F.xxhash64("piece").alias("repeat"),
        F.lit(None).cast("bigint").alias("around"))
    several = named.where("different > 1").withColumn("hot", F.col("different") > limit)
    windows = materialize(several.where("hot").select("anchor", "piece", "content").mapInArrow(
        _windows(length), "string binary, anchor bigint, piece binary, start int"), "repeats-windows")
    again = materialize(windows.groupBy("string").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("string"), "repeats-again")
    by_hash = windows.join(again, "string").select(
        "anchor", "piece", "start", (F.col("start") + length).alias("stop"), F.xxhash64("string").alias("repeat"), F.lit(None).cast("bigint").alias("around"))
    covers = materialize(equal.unionByName(_in_order(several.where("not hot"), length, chunk)).unionByName(by_hash), "repeats-part-covers")
    places = parts.select("anchor", "piece", "of_anchor", "of_piece", "shift")
    return places.join(covers, ["anchor", "piece"]).select(
        F.col("of_anchor").alias("anchor"), F.col("of_piece").alias("piece"), (F.col("shift") + F.col("start")).alias("start"),
        (F.col("shift") + F.col("stop")).alias("stop"), "repeat", "around")


def maximal_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, limit: int = LIMIT, chunk: int = CHUNK
) -> DataFrame:
    """Occurrences of maximal repeat groups: ``repeat``, ``around`` (the group that it lies in, or null), the id, ``start`` and ``size``.

    Of equal texts, each row is an occurrence.
    """
    texts = _texts(docs, id_col, text_col)
    pieces, covered = _covered(texts, length, limit, chunk)
    found = pieces.join(covered, ["anchor", "piece"]).select(
        "key", "repeat", "around", (F.col("lo") + F.col("start")).alias("start"), (F.col("stop") - F.col("start")).alias("size"))
    return texts.select(F.col("id").alias(id_col), "key").join(found, "key").drop("key").distinct()


def _removed(id_type, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for text, covers in zip(batch.column(1), batch.column(2).to_pylist()):
                text = text.as_buffer().to_pybytes()
                merged: list[list[int]] = []
                for a, b in sorted((c["lo"] + s["start"], c["lo"] + s["stop"]) for c in covers or [] for s in c["spans"]):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                edges = [0, *(e for m in merged for e in m), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else text)
                spans.append([{"start": a, "stop": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in kept], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                 pa.array(kept, pa.binary())], names=[id_col, "n_kept", "removed", "kept"])

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, limit: int = LIMIT, chunk: int = CHUNK
) -> DataFrame:
    """Per row: the id, ``n_kept``, the ``removed`` spans (start, stop; in bytes, sorted, apart from each other) and the ``kept`` bytes.

    Removed is every byte of a string of ``length`` bytes that also starts elsewhere, in the same text or another row.
    """
    texts = _texts(docs, id_col, text_col)
    pieces, covered = _covered(texts, length, limit, chunk)
    spans = materialize(covered.groupBy("anchor", "piece").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "repeats-spans")
    parts = pieces.join(spans, ["anchor", "piece"]).select("key", "lo", "spans")
    size = F.octet_length("text")
    copies = texts.where(size >= length).groupBy("key", size.alias("size")).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    whole = copies.select("key", F.lit(0).alias("lo"), F.array(F.struct(F.lit(0).alias("start"), F.col("size").alias("stop"))).alias("spans"))
    found = materialize(parts.unionByName(whole).groupBy("key").agg(F.collect_list(F.struct("lo", "spans")).alias("covers")), "repeats-texts")
    both = texts.join(found, "key", "left").select(F.col("id").alias(id_col), "text", "covers")
    id_type = both.schema[0].dataType
    return both.mapInArrow(_removed(id_type, id_col), f"`{id_col}` {id_type.simpleString()}, n_kept bigint, "
                           "removed array<struct<start: int, stop: int>>, kept binary")

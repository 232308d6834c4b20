"""Exact join of documents whose shingle sets have a Jaccard similarity of 0.8 or more, by pivots and the triangle inequality.

The Jaccard distance d(x, y) = 1 - |x & y| / |x | y| is a metric, and documents link when d <= 0.2. Almost all documents have
nothing in common, so pivots that are documents would leave nearly all others at distance 1 from all of them. The pivots of the
first level are therefore sets of shingles, and regions nest:

1. **Windows.** All shingles have one global order: by how often they occur (a table of fixed size counted over the whole
   corpus), then by hash. Let P be the first k = floor(|x| / 5) + 1 shingles of x. As a pivot, P has d(x, P) = 1 - k / |x|, and
   any y without a shingle of P has d(y, P) = 1. So d(x, y) >= k / |x| > 0.2 by the triangle inequality: every document that
   links with x lies in the region of one of the k pivots, and x is replicated to these k regions only. The region of a shingle
   has all documents with this shingle in their P. Regions with a single set are empty of pairs and go.
2. **Pivots.** In each region one document, the best connected one, is the pivot. Every document meets the most promising of its
   pivots; those within 0.2 are linked, and links make components. Documents of one component need not be compared further, since
   links inside a component change nothing.
3. **Recursion.** What is left of a region are strays, all its documents outside its largest component. They are joined again,
   region by region of these components and in blocks, with every document there that the triangle inequality leaves: those with
   the same pivot p only where |d(x, p) - d(y, p)| <= 0.2, and all only where the symmetric difference, bounded from below by
   that of the sets folded into a few hundred counters, is at most (|x| + |y|) / 9. First each stray meets its few closest, then,
   if still in another component, all that remain.

Distances come from the whole sets; no pair that could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import bounded
from sluice.llm.components import connected
from sluice.llm.shingles import mix, shingle_sets
from sluice.session import arrow_batches, materialize

_BITS = 20
_CELLS = 1 << _BITS  # counters of the table of shingle counts: 4 MB
_BLOOM = 1 << 25  # bits of the filter of sets that are compared: 4 MB
_SLICE = 1 << 20  # bytes of text shingled at a time
_BATCH = 500  # texts, or sets, that cross to Python together
_FOLD_BITS = 9  # counters of a folded set: 512 bytes
_BLOCK = 512  # strays, and others, that meet in one task
_HUB = 4096  # documents that meet one pivot in one task
_CLOSEST = 4  # partners that a stray meets first

_ROWS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int32()), ("c", pa.int64()), ("c2", pa.int64()),
                   ("folded", pa.binary()), ("block", pa.int32()), ("cells", pa.binary())])
ROWS = "doc_id long, text_key long, n int, c long, c2 long, folded binary, block int, cells binary"


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The batch in slices of a few MB of text, with the shingle sets of each."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _SLICE, side="right")))
        part = batch.slice(at, end - at)
        yield part, shingle_sets(part.column(column))
        at = end


def _class(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set: equal sets agree."""
    import xxhash

    raw = xxhash.xxh3_128_intdigest(own.tobytes())
    return (raw & (2**64 - 1)) - 2**63, (raw >> 64) - 2**63


def _folded(own: np.ndarray) -> bytes:
    """How many shingles fall on each counter, at most 255. Two sets differ in at least as many shingles as these counts do."""
    places = ((own >> np.uint64(32)) & np.uint64((1 << _FOLD_BITS) - 1)).astype(np.int64)
    return np.minimum(np.bincount(places, minlength=1 << _FOLD_BITS), 255).astype(np.uint8).tobytes()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text_key, size and class of the set), and at the end the partition's share of the table of counts."""
    counts = np.zeros(_CELLS, np.uint32)
    for batch in batches:
        for part, sets in _parts(batch, 2):
            flat = np.concatenate([np.zeros(0, np.uint64), *sets])
            counts += np.bincount((flat >> np.uint64(64 - _BITS)).astype(np.int64), minlength=_CELLS).astype(np.uint32)
            classes = [_class(s) if len(s) else (None, None) for s in sets]
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([
                part.column(0).cast(pa.int64()), part.column(1).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                pa.array([c for c, _ in classes], pa.int64()), pa.array([c for _, c in classes], pa.int64()),
                pa.array([_folded(s) if len(s) else None for s in sets], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_ROWS)
    for block, cells in bounded.blocks_of(counts):
        yield pa.RecordBatch.from_pydict({"doc_id": [None], "text_key": [None], "n": [None], "c": [None], "c2": [None], "folded": [None],
                                          "block": [block], "cells": [cells]}, schema=_ROWS)


def _window(own: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The first floor(n / 5) + 1 shingles in the global order: by level, then by hash."""
    level = levels[(own >> np.uint64(64 - _BITS)).astype(np.int64)].astype(np.uint64)
    order = np.argsort((level << np.uint64(58)) | (own >> np.uint64(6)), kind="stable")
    return own[order[:len(own) // 5 + 1]]


def _windows(levels) -> "callable":
    schema = pa.schema([("s", pa.int64()), ("c", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = levels.value, set()
        for batch in batches:
            for _, sets in _parts(batch, 0):
                shingles, classes, sizes = [np.zeros(0, np.uint64)], [], []
                for own in sets:
                    if not len(own):
                        continue
                    c = _class(own)
                    if c in seen:  # copies need one place in a region; forgetting them costs rows, not results
                        continue
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(c)
                    window = _window(own, table)
                    shingles.append(window)
                    classes.append(np.full(len(window), c[0], np.int64))
                    sizes.append(np.full(len(window), len(own), np.int32))
                if classes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.concatenate(classes)),
                                                      pa.array(np.concatenate(sizes))], schema=schema)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (s, c): one row for each set in a region that has two sets or more. Holds a batch and one row."""
    carry, shown = None, True
    for batch in batches:
        s, c, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(s):
            continue
        if carry is not None:
            s, c, n = (np.concatenate([[x], y]) for x, y in zip(carry, (s, c, n)))
        fresh = np.ones(len(s), bool)
        fresh[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
        s, c, n = s[fresh], c[fresh], n[fresh]
        paired = np.zeros(len(s), bool)
        paired[1:] = s[1:] == s[:-1]
        follows = paired[-1] or (shown and carry is not None and len(s) == 1)
        paired[:-1] |= s[:-1] == s[1:]
        emit = paired.copy()
        if carry is not None and shown:
            emit[0] = False
        carry, shown = (s[-1], c[-1], n[-1]), bool(follows)
        if emit.any():
            yield pa.RecordBatch.from_arrays([pa.array(s[emit].astype(np.int64)), pa.array(c[emit].astype(np.int64)),
                                              pa.array(n[emit].astype(np.int32))], names=["s", "c", "n"])


def _bloom_bits(c: np.ndarray, doc_id: np.ndarray) -> list[np.ndarray]:
    key = c.view(np.uint64) ^ mix(doc_id.view(np.uint64), 11)
    return [(mix(key, seed) >> np.uint64(64 - 25)).astype(np.int64) for seed in (1, 2, 3)]


def _bloom_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(_BLOOM, bool)
    for batch in batches:
        c, doc_id = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        for places in _bloom_bits(c, doc_id):
            bits[places] = True
    found = bounded.blocks_of(np.packbits(bits))
    if found:
        yield pa.RecordBatch.from_pydict({"block": [b for b, _ in found], "cells": [x for _, x in found]}, schema=bounded.ARROW)


_KEPT_BYTES = 5  # of the eight of a hash: the chance that a pair is judged wrongly is below 1e-6 even at 20,000 words


def _sets(bloom) -> "callable":
    """(c, n, the set as sorted 40-bit values) of the documents that the filter lets pass."""
    schema = pa.schema([("c", pa.int64()), ("n", pa.int32()), ("own", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = bloom.value
        for batch in batches:
            for part, sets in _parts(batch, 1):
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                c = np.array([_class(s)[0] if len(s) else 0 for s in sets], np.int64)
                passed = np.logical_and.reduce([packed[p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1 for p in _bloom_bits(c, ids)])
                rows = [i for i in np.flatnonzero(passed).tolist() if len(sets[i])]
                if rows:
                    cut = [np.ascontiguousarray(sets[i].byteswap().view(np.uint8).reshape(-1, 8)[:, :_KEPT_BYTES]).tobytes() for i in rows]
                    yield pa.RecordBatch.from_arrays([pa.array(c[rows]), pa.array([len(sets[i]) for i in rows], pa.int32()),
                                                      pa.array(cut, pa.binary())], schema=schema)

    return run


def _numbers(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // _KEPT_BYTES, 8), np.uint8)
    wide[:, 8 - _KEPT_BYTES:] = np.frombuffer(raw, np.uint8).reshape(-1, _KEPT_BYTES)
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hub, salt and ``other`` (the hub itself first) to (a, b, common). Holds a batch and one set."""
    key, hub = None, np.zeros(0, np.uint64)
    for batch in batches:
        hubs, salts = batch.column("hub").to_pylist(), batch.column("salt").to_pylist()
        others, members = batch.column("other").to_pylist(), batch.column("c").to_pylist()
        a, b, common = [], [], []
        for at, salt, other, c, own in zip(hubs, salts, others, members, batch.column("own")):
            own = _numbers(own.as_buffer())
            if not other:
                key, hub = (at, salt), own
            elif key == (at, salt):
                both = np.concatenate([hub, own])
                both.sort(kind="stable")
                a.append(at)
                b.append(c)
                common.append(int(np.count_nonzero(both[1:] == both[:-1])))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(common, pa.int32())],
                                             names=["a", "b", "common"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1).astype(np.int16)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least symmetric difference of each pair of rows of folded sets."""
    return np.abs(x - y).sum(axis=-1, dtype=np.int32)


def _pairs_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both folded sets to the pairs that may link, with the bound on their difference."""
    for batch in batches:
        n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        apart = _apart(_matrix(batch.column("folded_a")), _matrix(batch.column("folded_b"))) if batch.num_rows else n
        kept = pa.array(9 * apart <= n)
        names = ["a", "n_a", "b", "n_b"]
        out = [batch.column(c).filter(kept) for c in names] + [pa.array(apart.astype(np.int32)).filter(kept)]
        yield pa.RecordBatch.from_arrays(out, names=[*names, "apart"])


def _meet(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """One block of strays and one of a region's documents: the pairs of different components that may link."""
    col = {k: rows.column(k).to_numpy() for k in ("c", "n", "root", "p", "d", "stray", "left")}
    folded = _matrix(rows.column("folded"))
    left, right = np.flatnonzero(col["left"]), np.flatnonzero(~col["left"])
    if not len(left) or not len(right):
        return
    for z in left.tolist():
        n = col["n"][z] + col["n"][right]
        fits = (col["root"][right] != col["root"][z]) & (~col["stray"][right] | (col["c"][z] < col["c"][right]))
        fits &= 100 * np.minimum(col["n"][right], col["n"][z]).astype(np.int64) >= 80 * np.maximum(col["n"][right], col["n"][z]).astype(np.int64)
        fits &= (col["p"][right] != col["p"][z]) | (np.abs(col["d"][right] - col["d"][z]) <= 0.2 + 1e-9)
        near = right[fits]
        if not len(near):
            continue
        apart = _apart(folded[near], folded[z])
        kept = 9 * apart <= n[fits]
        near, apart = near[kept], apart[kept]
        if not len(near):
            continue
        c, m = col["c"][near], col["n"][near]
        first = c < col["c"][z]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.where(first, c, col["c"][z])), pa.array(np.where(first, m, col["n"][z]).astype(np.int32)),
            pa.array(np.where(first, col["c"][z], c)), pa.array(np.where(first, col["n"][z], m).astype(np.int32)),
            pa.array(apart.astype(np.int32)), pa.array(np.full(len(c), col["c"][z]))], names=["a", "n_a", "b", "n_b", "apart", "z"])


def _meet_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by region and block pair. Holds a batch and the rows of one block pair."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        keys = np.stack([rows.column(k).to_numpy() for k in ("main", "i", "j")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1 if rows.num_rows else []
        at = 0
        for cut in cuts:
            yield from _meet(rows.slice(at, int(cut) - at))
            at = int(cut)
        held = rows.slice(at)
    if held is not None and held.num_rows:
        yield from _meet(held)


def _close_sizes(x: Column, y: Column) -> Column:
    """Only sets of which the smaller has 80 % of the larger can link."""
    return F.lit(100).cast("long") * F.least(x, y) >= F.lit(80).cast("long") * F.greatest(x, y)


def _hub_first(pairs: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs turned so that ``a`` is the end with more partners."""
    other = hubs.withColumnsRenamed({"a": "b", "count": "count_b"})
    counted = pairs.join(hubs, "a", "left").join(other, "b", "left")
    turn = F.coalesce("count_b", F.lit(0)) > F.coalesce("count", F.lit(0))
    return counted.select(F.when(turn, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turn, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
                          F.when(turn, F.col("a")).otherwise(F.col("b")).alias("b"), F.when(turn, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"))


def find_groups(docs: DataFrame, text_key: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) to one row per row: doc_id, text_key, n (distinct shingles), node (of its component), component_id.

    ``component_id`` is the smallest doc_id that links reach from the row's document, its own included; null ids are passed over.
    Copies of one set are one node. Null and empty texts have no shingles and link with nothing, not even with each other; their
    component is their own id. Repeated rows link with each other. An empty table gives an empty result. ``text_key`` is a hash
    of id and text when asked for, else null.
    """
    spark = docs.sparkSession
    key = F.xxhash64("doc_id", "text") if text_key else F.lit(None).cast("long")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("text_key"), "text")
    with arrow_batches(spark, _BATCH):
        described = materialize(read.mapInArrow(_describe, ROWS), "jaccard-rows")
    rows = described.where("block is null").drop("block", "cells")
    counts = bounded.merged(described.where("block is not null"), "uint32", _CELLS, "add")
    levels = spark.sparkContext.broadcast(np.frexp(counts.astype(np.float64))[1].astype(np.uint8))
    classes = rows.where("c is not null").groupBy("c", "c2", "n").agg(F.min("doc_id").alias("first"))

    windows = docs.select("text").mapInArrow(_windows(levels), "s long, c long, n int")
    regions = windows.repartition("s").sortWithinPartitions("s", "c").mapInArrow(_shared, "s long, c long, n int")
    with arrow_batches(spark, _BATCH):
        regions = materialize(regions, "jaccard-regions")
    levels.destroy()

    # Many shingles have the same documents: one region of each kind is enough. Documents without a neighbour of a fitting size go.
    kinds = regions.groupBy("s").agg(F.count("*").alias("m"), F.bit_xor("c").alias("x"), F.bit_xor(F.xxhash64("c")).alias("y"))
    single = kinds.groupBy("m", "x", "y").agg(F.min("s").alias("s")).select("s")
    weight = regions.groupBy("c").agg(F.count("*").alias("weight"))
    by_size = Window.partitionBy("s").orderBy("n", "c")
    near = (F.coalesce(F.lit(100).cast("long") * F.lag("n").over(by_size) >= F.lit(80).cast("long") * F.col("n"), F.lit(False))
            | F.coalesce(F.lit(100).cast("long") * F.col("n") >= F.lit(80).cast("long") * F.lead("n").over(by_size), F.lit(False)))
    members = materialize(regions.join(single, "s").withColumn("near", near).where("near").drop("near").join(weight, "c"), "jaccard-members")
    met = members.select("c").distinct()
    folded = materialize(rows.join(met, "c", "left_semi").groupBy("c").agg(F.min("folded").alias("folded")), "jaccard-folded")

    def fetched(wanted: DataFrame, label: str) -> DataFrame:
        """The sets of these classes, from the documents that stand for them."""
        named = wanted.join(classes, "c").select("c", "first")
        bits = bounded.merged(named.mapInArrow(_bloom_blocks, bounded.SCHEMA), "uint8", _BLOOM // 8, "or")
        bloom = spark.sparkContext.broadcast(bits)
        with arrow_batches(spark, _BATCH):
            found = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sets(bloom), "c long, n int, own binary"), label)
        bloom.destroy()
        return found

    def measured(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
        """Pairs (a, n_a, b, n_b) to their exact distance. The sets of b travel to a, a hub with many in parts."""
        parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / _HUB).cast("int").alias("parts"))
        salted = pairs.join(parts, "a").select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), "parts").cast("int").alias("salt"),
                                               F.col("b").alias("c"), F.lit(True).alias("other"))
        hubs = parts.select(F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
                            F.col("a").alias("c"), F.lit(False).alias("other"))
        order = ["hub", "salt", "other"]
        placed = salted.union(hubs).join(sets.select("c", "own"), "c").repartition("hub", "salt").sortWithinPartitions(*order)
        common = placed.select(*order, "c", "own").mapInArrow(_common, "a long, b long, common int").distinct()
        union = F.col("n_a") + F.col("n_b") - F.col("common")
        judged = common.join(pairs, ["a", "b"]).select(
            "a", "b", (F.lit(100).cast("long") * F.col("common") >= F.lit(80).cast("long") * union).alias("link"), (F.lit(1.0) - F.col("common") / union).alias("d"))
        with arrow_batches(spark, _BATCH):
            return materialize(judged, label)

    # Second level: every member of a region against the best connected one that may be near, for each the most promising.
    best = F.max(F.struct("weight", "c", "n")).alias("best")
    pivots = members.groupBy("s").agg(best).select("s", F.col("best.c").alias("p"), F.col("best.n").alias("n_p"))
    smaller = F.col("c") < F.col("p")
    star = members.join(pivots, "s").where("c <> p").where(_close_sizes(F.col("n"), F.col("n_p"))).select(
        F.least("c", "p").alias("a"), F.when(smaller, F.col("n")).otherwise(F.col("n_p")).alias("n_a"),
        F.greatest("c", "p").alias("b"), F.when(smaller, F.col("n_p")).otherwise(F.col("n")).alias("n_b")).distinct()
    star = (star.join(folded.select(F.col("c").alias("a"), F.col("folded").alias("folded_a")), "a")
            .join(folded.select(F.col("c").alias("b"), F.col("folded").alias("folded_b")), "b")
            .select("a", "n_a", "b", "n_b", "folded_a", "folded_b").mapInArrow(_pairs_apart, "a long, n_a int, b long, n_b int, apart int"))
    star = materialize(star, "jaccard-star")
    is_pivot = pivots.select("p").distinct()
    ends = (star.select("*", F.col("a").alias("c"), F.col("b").alias("p")).union(star.select("*", F.col("b").alias("c"), F.col("a").alias("p")))
            .join(is_pivot, "p", "left_semi"))
    first_pairs = ends.groupBy("c").agg(F.min(F.struct(F.col("apart") / (F.col("n_a") + F.col("n_b")), "a", "n_a", "b", "n_b")).alias("k"))
    first_pairs = first_pairs.select("k.a", "k.n_a", "k.b", "k.n_b").distinct()
    hubs = ends.groupBy("p").count().select(F.col("p").alias("a"), "count")  # the end with more partners is the hub
    first_pairs = _hub_first(first_pairs, hubs)
    sets = fetched(first_pairs.select(F.col("a").alias("c")).union(first_pairs.select("b")).distinct(), "jaccard-sets")
    first = measured(first_pairs, sets, "jaccard-first")
    links = first.where("link").select("a", "b")
    roots = connected(links, "jaccard-second")

    # Third level: strays of each region, gathered by the largest component they meet there.
    named = members.select("s", "c", "n").join(roots, members["c"] == roots["node"], "left").select(
        "s", "c", "n", F.coalesce("root", "c").alias("root"))
    crowds = named.groupBy("s", "root").agg(F.count("*").alias("size"))
    mains = crowds.groupBy("s").agg(F.max(F.struct("size", "root"))["root"].alias("main"), F.count("*").alias("components")).where("components > 1")
    distance = first.select(F.col("a").alias("p"), F.col("b").alias("c"), "d").union(first.select("b", "a", "d"))
    own_pivot = distance.join(is_pivot, "p", "left_semi").groupBy("c").agg(F.min(F.struct("p", "d")).alias("k")).select("c", "k.p", "k.d")
    met = (named.join(mains.select("s", "main"), "s").select("main", "c", "n", "root").distinct()
           .join(own_pivot, "c", "left").join(folded, "c")
           .select("main", "c", "n", "root", F.coalesce("p", "c").alias("p"), F.coalesce("d", F.lit(0.0)).alias("d"), "folded",
                   (F.col("root") != F.col("main")).alias("stray")))
    met = materialize(met, "jaccard-strays")
    sizes = met.groupBy("main").agg(F.ceil(F.count_if("stray") / _BLOCK).cast("int").alias("strays"), F.ceil(F.count("*") / _BLOCK).cast("int").alias("all"))
    sized = met.join(sizes, "main")
    own = lambda parts: F.pmod(F.xxhash64("c"), parts).cast("int")
    to = lambda parts, name: F.explode(F.sequence(F.lit(0), F.col(parts) - 1)).alias(name)
    shown = ["main", "c", "n", "root", "p", "d", "folded", "stray"]
    lefts = sized.where("stray").select(*shown, own(F.col("strays")).alias("i"), to("all", "j")).withColumn("left", F.lit(True))
    rights = sized.select(*shown, to("strays", "i"), own(F.col("all")).alias("j")).withColumn("left", F.lit(False))
    blocks = lefts.unionByName(rights).repartition("main", "i", "j").sortWithinPartitions("main", "i", "j")
    across = materialize(blocks.mapInArrow(_meet_blocks, "a long, n_a int, b long, n_b int, apart int, z long"), "jaccard-across")

    known = first.select("a", "b").union(first.select("b", "a"))
    open_pairs = across.join(known, ["a", "b"], "left_anti")
    if not open_pairs.isEmpty():
        more = fetched(open_pairs.select(F.col("a").alias("c")).union(open_pairs.select("b")).distinct()
                       .join(sets.select("c").distinct(), "c", "left_anti"), "jaccard-more-sets")
        sets = sets.union(more)
        rank = F.row_number().over(Window.partitionBy("z").orderBy(F.col("apart") / (F.col("n_a") + F.col("n_b")), "a", "b"))
        closest = open_pairs.withColumn("rank", rank).where(F.col("rank") <= _CLOSEST).select("a", "n_a", "b", "n_b").distinct()
        second = measured(closest, sets, "jaccard-third")
        links = links.union(second.where("link").select("a", "b"))
        roots = connected(links, "jaccard-fourth")
        left, right = (roots.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}")) for k in ("a", "b"))
        apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
        rest = (open_pairs.select("a", "n_a", "b", "n_b").distinct().join(second.select("a", "b"), ["a", "b"], "left_anti")
                .join(left, "a", "left").join(right, "b", "left").where(apart).select("a", "n_a", "b", "n_b"))
        last = measured(rest, sets, "jaccard-fifth").where("link").select("a", "b")
        if not last.isEmpty():
            roots = connected(links.union(last), "jaccard-last")

    named = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    final = named.join(smallest, "root").select("c", "c2", "n", F.col("root").alias("node"), "component")
    joined = rows.join(final, ["c", "c2", "n"], "left")
    return joined.select("doc_id", "text_key", "n", "node", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The documents with one of each group: the one with the smallest doc_id. ``docs`` has ``doc_id`` and ``text``.

    Documents without shingles stay, each of them. Of rows that repeat id and text one stays. A null id comes after all others.
    """
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("text_key"))
    groups = materialize(find_groups(docs.select("doc_id", "text"), text_key=True), "jaccard-groups")
    chosen = groups.where("n > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))["text_key"].alias("text_key"))
    empty = groups.where("n = 0").select("text_key").distinct()
    kept = chosen.select("text_key", F.lit(False).alias("all")).union(empty.select("text_key", F.lit(True)))
    once = F.row_number().over(Window.partitionBy("text_key").orderBy(F.xxhash64("doc")))
    return keyed.join(kept, "text_key").withColumn("once", once).where("all or once = 1").select("doc.*")

"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets and verified pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import connected
from sluice.session import materialize

THRESHOLD = 0.9
TABLES = 8
HASHES = 3  # hashes that are joined to one bucket
PROBES = 8  # buckets in which a vector looks, its own included
BLOCK = 1024  # a bucket with more classes is compared in blocks of this size
SEED = 7


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their width is a power of two."""
    n, width, half = len(x), x.shape[1], 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def hash_codes(vectors: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Buckets of unit vectors: (rows, tables, probes), the home bucket first, then by the loss of taking a neighbouring vertex.

    A rotation is three rounds of random signs and a Hadamard transform; the hash is the closest vertex of the cross-polytope,
    that is the largest coordinate in absolute value with its sign.
    """
    rows, dim = vectors.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((rows, width))
    padded[:, :dim] = vectors
    signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (tables, hashes, 3, width))
    choices = min(3, width)
    out = np.zeros((rows, tables, probes), np.int64)
    for t in range(tables):
        codes = np.zeros((rows, 1), np.int64)
        losses = np.zeros((rows, 1))
        for h in range(hashes):
            rotated = padded
            for step in range(3):
                rotated = _hadamard(rotated * signs[t, h, step])
            size = np.abs(rotated)
            best = np.argsort(-size, axis=1, kind="stable")[:, :choices]
            value = np.take_along_axis(rotated, best, axis=1)
            vertex = 2 * best + (value < 0)
            loss = np.abs(value[:, :1]) - np.abs(value)
            codes = (codes[:, :, None] * (2 * width) + vertex[:, None, :]).reshape(rows, -1)
            losses = (losses[:, :, None] + loss[:, None, :]).reshape(rows, -1)
        order = np.argsort(losses, axis=1, kind="stable")[:, :probes]
        taken = np.take_along_axis(codes, order, axis=1)
        out[:, t, :taken.shape[1]] = taken
        out[:, t, taken.shape[1]:] = taken[:, :1]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, n, unit vector) to (cid, n, vector, buckets) for vectors that have a direction."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            raw = _matrix(part.column(2))
            norm = np.linalg.norm(raw, axis=1)
            unit = raw / norm[:, None]
            codes = hash_codes(unit, TABLES, HASHES, PROBES).reshape(len(unit), -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array([u.tobytes() for u in unit], pa.binary()),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(list(codes), pa.list_(pa.int32()))],
                names=["cid", "n", "unit", "codes", "buckets"])


def _smallest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest member that links reach, for members 0 to size - 1 and links a, b."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _pairs_within(sizes: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same group, for groups that lie one after the other, about ``limit`` pairs at a time."""
    later = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(sizes.sum())  # rows of the group after this one
    upto = np.cumsum(later)
    at = 0
    while at < len(later):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + limit, side="right")))
        a = np.repeat(np.arange(at, end), later[at:end])
        first = np.repeat(upto[at:end] - later[at:end], later[at:end])
        yield a, a + 1 + (np.arange(len(a)) + (upto[at - 1] if at else 0) - first)
        at = end


def _compare_groups(rows: pa.Table) -> pa.RecordBatch | None:
    """Whole buckets, or pairs of blocks of large ones: links of each vector that no other bucket counts, and a spanning forest."""
    col = {name: rows.column(name).to_numpy() for name in ("cid", "n", "t", "bucket", "i", "j", "own", "home")}
    unit = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(rows.num_rows, -1)
    codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.int32).reshape(rows.num_rows, TABLES, PROBES)
    keys = np.stack([col[k] for k in ("t", "bucket", "i", "j")])
    starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
    links = np.zeros(rows.num_rows, np.int64)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in _pairs_within(np.diff(np.append(starts, rows.num_rows)), 50_000):
        fits = (col["home"][a] | col["home"][b]) & ((col["i"][a] == col["j"][a]) | (col["own"][a] != col["own"][b]))
        a, b = a[fits], b[fits]
        near = np.einsum("ij,ij->i", unit[a], unit[b]) >= THRESHOLD
        a, b = a[near], b[near]
        a, b = np.where(col["cid"][a] < col["cid"][b], a, b), np.where(col["cid"][a] < col["cid"][b], b, a)
        # A pair may meet again: in this table, in the home bucket of either; or in an earlier table.
        own_of_a = (codes[b, col["t"][a], :] == codes[a, col["t"][a], :1]).any(axis=1)
        counted = own_of_a & ~col["home"][a]
        for t in range(TABLES):
            met = (codes[a, t, :] == codes[b, t, :1]).any(axis=1) | (codes[b, t, :] == codes[a, t, :1]).any(axis=1)
            counted |= met & (t < col["t"][a])
        a, b = a[~counted], b[~counted]
        np.add.at(links, a, col["n"][b])
        np.add.at(links, b, col["n"][a])
        ends.append((a, b))
    a, b = (np.concatenate([e[k] for e in ends]) if ends else np.zeros(0, np.int64) for k in (0, 1))
    if not len(a):
        return None
    cid, place = np.unique(col["cid"], return_inverse=True)
    total = np.bincount(place, links, len(cid)).astype(np.int64)
    root = _smallest(place[a], place[b], len(cid))
    shown = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(cid[shown]), pa.array(total[shown]), pa.array(cid[root[shown]])], names=["cid", "links", "root"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and block pair. Holds a batch and the rows of one group, which are at most a few blocks."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not rows.num_rows:
            continue
        keys = [rows.column(k).to_numpy() for k in ("t", "bucket", "i", "j")]
        last = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = rows.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        held = rows.slice(cut)
        if cut and (found := _compare_groups(rows.slice(0, cut))) is not None:
            yield found
    if held is not None and held.num_rows and (found := _compare_groups(held)) is not None:
        yield found


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``.

    Two vectors link when their cosine, in double precision, is THRESHOLD or more; candidates are pairs of which one looks in the
    other's bucket in some table, and every candidate is verified. Equal vectors are one class. Buckets with more than BLOCK
    classes are split into blocks that meet pairwise in tasks of their own. Tasks return sums of links and spanning forests, no
    pairs; a pair that several tables find is counted in the first.

    ``n_links`` counts other vectors linked directly, ``component_id`` is the smallest id that links reach, and ``kept`` tells
    whether that is the vector's own. Vectors that are null, zero or empty, hold null or non-finite components, or differ in
    length from the longest, link with nothing and are their own component. Repeated rows link like any equal vectors; null ids
    are passed over in the minimum, and a component of null ids has a null id. An empty table gives an empty result.
    """
    v = F.col("v")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    valid = v.isNotNull() & (F.size(v) == dim) & (dim > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    keyed = rows.select("id", "v", F.when(F.coalesce(valid, F.lit(False)), F.xxhash64("v")).alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"))
    grouped = keyed.where("k1 is not null").groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    hashed = materialize(classes.select("cid", "n", "v").mapInArrow(
        _hashed, "cid long, n long, unit binary, codes binary, buckets array<int>"), "vector-codes")

    at = F.explode(F.sequence(F.lit(0), F.lit(TABLES * PROBES - 1))).alias("at")
    looks = hashed.select("cid", "buckets", at).select(
        "cid", F.floor(F.col("at") / PROBES).cast("int").alias("t"), F.get("buckets", F.col("at")).alias("bucket"),
        (F.col("at") % PROBES == 0).alias("home"))
    sizes = looks.groupBy("t", "bucket").agg(F.count("*").alias("m"), F.max("home").alias("any")).where("m > 1 and any")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    placed = looks.join(sizes, ["t", "bucket"]).withColumn("blocks", blocks).withColumn("own", own)
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("cid", "t", "bucket", "home", "own", met).select(
        "cid", "t", "bucket", "home", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    keys = ["t", "bucket", "i", "j"]
    filled = pairs.join(hashed.drop("buckets"), "cid").repartition(*keys).sortWithinPartitions(*keys, "cid")
    found = materialize(filled.mapInArrow(_compare, "cid long, links long, root long"), "vector-links")

    roots = connected(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "vector")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (classes.select("k1", "k2", "cid", "n", "first").join(counts, "cid", "left")
             .join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    final = named.join(smallest, "root").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component")
    known = F.col("k1").isNotNull()
    return (keyed.select("id", "k1", "k2").join(final, ["k1", "k2"], "left")
            .withColumn("component_id", F.when(known, F.col("component")).otherwise(F.col("id")))
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")))

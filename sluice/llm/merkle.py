"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree over the groups, and a proof for every row.

Leaves of a group are ranked by an order column. Every node carries the interval of leaf ranks that it covers. Levels are cut into
bands of BAND; the nodes at the foot of a band fall into buckets of 2 ** BAND neighbours, so a bucket covers one interval of ranks
and its subtree is built by one task. Upwards, a band hands one node per bucket to the next band. Downwards, a bucket meets the
ancestors whose interval contains its own by a join on the bucket, and a node's sibling is what its interval lacks of its
parent's: the interval difference, on the left or on the right of it. So a row crosses the network twice as a digest and a
rank, whatever the height of the tree, and a group that holds most rows is as many buckets as its size asks for.

Results for odd input: a null field is ``-`` in the leaf, an empty one ``0:``; rows without an order value come first; rows with equal
order values stand in the order of their leaves, so repeated rows are neighbours and each of them keeps a row and a proof of its own; a
group of one row has its leaf as subroot, and a single group has its subroot as root; an empty table gives no rows. Null is a group
like others. Columns beyond the named ones are not read, so their names cannot clash.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.runs import before, ordered_runs
from sluice.session import materialize

BAND = 10  # levels that a task builds at once, from 1,024 neighbours
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "grp bigint, at bigint, lo bigint, hi bigint, n bigint, digest string"
_PROOF = "array<struct<left: boolean, digest: string>>"
_STEP = pa.struct([("left", pa.bool_()), ("digest", pa.string())])


def encoded(value: Column) -> Column:
    """A field as it enters a leaf: its length in UTF-8 bytes, a colon and the value, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def _node(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def _height(n: int) -> int:
    return max(n - 1, 0).bit_length()


def _subtree(lo: list[int], hi: list[int], digests: list[str], levels: int) -> list[tuple[list[int], list[int], list[str]]]:
    """The levels above neighbouring nodes, the given ones first; a node is the interval of its children and their digest."""
    tree = [(lo, hi, digests)]
    for _ in range(levels):
        lo, hi, digests = tree[-1]
        pairs = range(0, len(lo), 2)
        tree.append((lo[::2], [hi[min(i + 1, len(hi) - 1)] for i in pairs], [_node(digests[i:i + 2]) for i in pairs]))
    return tree


def _siblings(tree: list[tuple[list[int], list[int], list[str]]]) -> list[list[tuple[bool, str | None]]]:
    """For each node below the top of a subtree: whether its sibling is on the left, and the sibling's digest (None without one)."""
    out = []
    for (lo, hi, digests), (parent_lo, parent_hi, _) in zip(tree, tree[1:]):
        level = []
        for i in range(len(lo)):
            if lo[i] > parent_lo[i // 2]:
                level.append((True, digests[i - 1]))
            elif hi[i] < parent_hi[i // 2]:
                level.append((False, digests[i + 1]))
            else:
                level.append((False, None))
        out.append(level)
    return out


def _levels(n: int, band: int, width: int) -> int:
    return min(width, max(_height(n) - width * band, 0))


def _columns(nodes: pa.Table, *names: str) -> list[list]:
    return [nodes.column(c).to_pylist() for c in names]


def _up(band: int, width: int):
    def build(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("at")
        grp, at, lo, hi, n, digests = _columns(nodes, "grp", "at", "lo", "hi", "n", "digest")
        top = _subtree(lo, hi, digests, _levels(n[0], band, width))[-1]
        return pa.table({"grp": grp[:1], "at": [at[0] >> width], "lo": top[0], "hi": top[1], "n": n[:1], "digest": top[2]})

    return build


def _down(band: int, width: int):
    def attach(nodes: pa.Table, above: pa.Table) -> pa.Table:
        """The proof of a node: its siblings in this band, then the proof of the ancestor that covers the bucket."""
        nodes = nodes.sort_by("at")
        grp, at, lo, hi, n, digests = _columns(nodes, "grp", "at", "lo", "hi", "n", "digest")
        kept = _columns(nodes, "grp", "at", "digest")
        (upper,), (subroot,), (root,) = _columns(above, "proof", "subroot", "root")
        if not above["lo"][0].as_py() <= lo[0] < hi[-1] <= above["hi"][0].as_py():
            raise ValueError("a bucket met a node that does not cover it")
        levels = _siblings(_subtree(lo, hi, digests, _levels(n[0], band, width)))
        tail = [(s["left"], s["digest"]) for s in upper]
        steps = [s for i in range(len(at)) for s in [*(level[i >> k] for k, level in enumerate(levels)), *tail]]
        each = len(levels) + len(tail)
        flat = pa.StructArray.from_arrays([pa.array([s[0] for s in steps], pa.bool_()), pa.array([s[1] for s in steps], pa.string())],
                                          fields=list(_STEP))
        proof = pa.ListArray.from_arrays(pa.array(range(0, each * len(at) + 1, each) if each else [0] * (len(at) + 1), pa.int32()), flat)
        rows = {"grp": pa.array(kept[0], pa.int64()), "at": pa.array(kept[1], pa.int64()), "lo": pa.array(lo, pa.int64()),
                "hi": pa.array(hi, pa.int64()), "digest": pa.array(kept[2], pa.string()), "proof": proof,
                "subroot": pa.array([subroot] * len(at), pa.string()), "root": pa.array([root] * len(at), pa.string())}
        return pa.table({**rows, **({"row": nodes["row"].combine_chunks()} if "row" in nodes.column_names else {})})

    return attach


def _bucket(width: int) -> Column:
    return F.shiftright("at", width).alias("bucket")


def grow(nodes: DataFrame, largest: int, width: int = BAND) -> list[DataFrame]:
    """The nodes at the foot of every band, the given ones first, and last the root of each group.

    ``nodes`` are (grp, at, lo, hi, n, digest): node ``at`` of a group of ``n`` leaves. ``largest`` is the greatest ``n``.
    """
    feet = [nodes]
    for band in range(max(1, -(-_height(largest) // width))):
        up = feet[-1].select("grp", "at", "lo", "hi", "n", "digest").groupBy("grp", _bucket(width)).applyInArrow(_up(band, width), _NODE)
        feet.append(materialize(up, "merkle-band"))
    return feet


def descend(feet: list[DataFrame], tops: DataFrame, width: int = BAND) -> DataFrame:
    """Proofs of the nodes that a tree was grown from. ``tops`` has the proof of each group's root: (grp, at, lo, hi, proof, subroot, root)."""
    proofs = tops
    for band in range(len(feet) - 2, -1, -1):
        row = feet[band].schema["row"].dataType.simpleString() if "row" in feet[band].columns else ""
        schema = f"grp bigint, at bigint, lo bigint, hi bigint, digest string, proof {_PROOF}, subroot string, root string"
        nodes, above = feet[band].groupBy("grp", _bucket(width)), proofs.groupBy("grp", F.col("at").alias("bucket"))
        proofs = nodes.cogroup(above).applyInArrow(_down(band, width), schema + (f", row {row}" if row else ""))
        if band:
            proofs = materialize(proofs, "merkle-proofs")
    return proofs


def ranked_leaves(rows: DataFrame, group: str, order: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Rows (group, order, leaf, ...) as leaves of their group's tree, the groups (grp, value, n), and the greatest sizes.

    Ranks come from rows in global order and the sizes of its runs; groups are numbered by their value, null first.
    """
    runs = ordered_runs(rows, [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col("leaf")], "merkle-order")
    pieces = runs.groupBy("run", F.col(group).alias("value")).agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("first"))
    named = ordered_runs(pieces.groupBy("value").agg(F.sum("size").alias("n")), [F.col("value").asc_nulls_first()], "merkle-groups")
    starts = named.groupBy("run").agg(F.count(F.lit(1)).alias("size"))  # a row per run of the groups
    starts = starts.select("run", before(F.col("size"), [], ["run"]).alias("start"))
    groups = named.join(starts, "run").select((F.col("start") + F.col("row")).alias("grp"), F.col("value").alias("name"), "n")
    groups = materialize(groups, "merkle-groups")
    placed = pieces.join(groups, F.col("value").eqNullSafe(F.col("name"))).select(
        "run", "value", "grp", "n", (before(F.col("size"), ["grp"], ["run"]) - F.col("first")).alias("shift"))
    leaves = runs.withColumnRenamed("run", "in_run").join(
        placed, (F.col("in_run") == F.col("run")) & F.col(group).eqNullSafe(F.col("value")))
    at = (F.col("shift") + F.col("row")).alias("at")
    kept = F.struct(*[F.col(c) for c in rows.columns if c not in ("leaf", group)]).alias("row")
    leaves = leaves.select("grp", at, at.alias("lo"), (at + 1).alias("hi"), "n", F.col("leaf").alias("digest"), kept)
    count, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    return leaves, groups, count, largest or 0


def merkle_manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", carried: dict[str, Column] | None = None
) -> DataFrame:
    """Per row: the order column, ``leaf``, ``rank`` in its group, ``proof``, ``subroot`` and ``root``, and the ``carried`` columns.

    ``proof`` has one entry per level from the leaf to the root: the digest of the sibling, null where the node has none, and whether it
    is on the left; :func:`fold` goes from a leaf to the root with it.
    """
    extra = carried or {}
    narrow = docs.select(F.col(group).alias("grouped"), F.col(order).alias("ordered"), leaf_digest([F.col(f) for f in fields]).alias("leaf"),
                         F.struct(F.lit(True).alias("__"), *[c.alias(name) for name, c in extra.items()]).alias("extra"))
    leaves, groups, n_groups, largest = ranked_leaves(materialize(narrow, "merkle-leaves"), "grouped", "ordered")
    feet = grow(leaves, largest)
    subroots = feet[-1].select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("at"), F.col("grp").alias("lo"),
                               (F.col("grp") + 1).alias("hi"), F.lit(n_groups).cast("bigint").alias("n"), "digest")
    crown = grow(subroots, n_groups)
    none = F.array().cast(_PROOF).alias("proof")
    root = crown[-1].select("grp", F.lit(0).cast("bigint").alias("at"), "lo", "hi", none, F.lit(None).cast("string").alias("subroot"),
                            F.col("digest").alias("root"))
    above = descend(crown, root).select(F.col("at").alias("grp"), "proof", F.col("digest").alias("subroot"), "root")
    tops = groups.join(above, "grp").select("grp", F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("lo"),
                                            F.col("n").alias("hi"), "proof", "subroot", "root")
    proofs = descend(feet, materialize(tops, "merkle-tops"))
    return proofs.select(F.col("row.ordered").alias(order), F.col("digest").alias("leaf"), F.col("at").alias("rank"), "proof", "subroot", "root",
                         *[F.col(f"row.extra.{name}").alias(name) for name in extra])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    def up(node: Column, step: Column) -> Column:
        joined = F.when(step["digest"].isNull(), node).when(step["left"], F.concat(step["digest"], node)).otherwise(F.concat(node, step["digest"]))
        return F.sha2(joined.cast("binary"), 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's siblings from the leaf's level to the root's."""
    found = F.filter(F.transform(proof, lambda s: s["digest"]), lambda d: d.isNotNull())
    return F.sha2(F.array_join(found, "").cast("binary"), 256)

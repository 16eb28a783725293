"""Merkle manifest of a dataset: one digest for each record, group and dataset, and proofs.

Records are leaves, in order within their group; ``fanout`` consecutive nodes become their
hash until one is left, and the groups' roots likewise become the dataset's.  A level is a
slot pivot: conditional aggregates over a parent's children spread these into ``fanout``
columns.  All columns together hash to the parent; without a node's own they are its siblings.

Levels are built in rounds.  A round deals the nodes once, by blocks of about 256 consecutive
ones, and climbs all levels of a block in the same tasks; its block roots, 256 times fewer,
are the next round's nodes.  Places within a group come from a range sort over all groups
(:mod:`ranks`), so neither a block nor a task grows with a group.  Texts are read once, by the
scan that hashes them, and are never shuffled.

Nulls: a null field is hashed as ``-``; a null group is a group of its own and comes first,
null ids come first in their group.  Rows with equal ids are ordered by their digests; equal
rows are leaves of their own, each with its proof.  Empty and very long texts are hashed as
they are.  An empty table has no rows, and no root.  Columns beside the named ones do not take
part, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.llm.ranks import ranked
from quoteloom.shared import Landing

# Nodes of a block, about: all of its levels are climbed in one task.
BLOCK = 256

NONE = "CAST('' AS BINARY)"


def record_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 (hex) over all fields: ``-`` for a null, else UTF-8 byte count, colon, value."""
    texts = [f.cast("string") for f in fields]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.sha2(F.concat(*parts), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _node(digests: Column) -> Column:
    """Hash of concatenated digests, which are hashed as hex text."""
    return F.unhex(F.sha2(_hex(digests), 256))


def siblings_digest(proof: Column) -> Column:
    """SHA-256 (hex) of all siblings in a proof, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda s: _hex(F.concat(s["before"], s["after"])))), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root (hex) that a leaf (hex) has with the siblings of ``proof``."""
    return F.aggregate(
        proof,
        leaf,
        lambda own, s: F.sha2(F.concat(_hex(s["before"]), own, _hex(s["after"])), 256),
    )


def _climb_blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` with the root of their block in ``root`` and the way up to it in ``proof``.

    Stops below the block's top where the whole group has one node left.
    """
    nodes = nodes.withColumns(
        {
            "_block": F.expr(f"pos div {fanout**levels}"),
            "root": F.col("digest"),
            "proof": F.expr("CAST(array() AS array<struct<before:binary,after:binary>>)"),
        }
    ).repartition("group", "_block")
    for level in range(levels):
        below = fanout**level
        slot = F.expr(f"pos div {below} % {fanout}")
        parent = Window.partitionBy("group", "_block", F.expr(f"pos div {below * fanout}"))
        names = [f"_slot{j}" for j in range(fanout)]
        nodes = nodes.withColumns(
            {c: F.max(F.when(slot == j, F.col("root"))).over(parent) for j, c in enumerate(names)}
        )
        children = [F.coalesce(F.col(c), F.expr(NONE)) for c in names]
        others = [
            F.concat(*[F.when(own, c).otherwise(F.expr(NONE)) for own, c in zip(side, children)]).alias(name)
            for name, side in (
                ("before", [slot > j for j in range(fanout)]),
                ("after", [slot < j for j in range(fanout)]),
            )
        ]
        several = F.col("size") > below
        nodes = nodes.withColumns(
            {
                "proof": F.when(several, F.concat("proof", F.array(F.struct(*others)))).otherwise(F.col("proof")),
                "root": F.when(several, _node(F.concat(*children))).otherwise(F.col("root")),
            }
        ).drop(*names)
    return nodes.drop("_block")


def climb(nodes: DataFrame, fanout: int, landing: Landing, block: int = BLOCK) -> DataFrame:
    """``nodes`` (group, pos, size, digest and others) with their group's ``root`` and ``proof``."""
    levels = max(1, int(math.log(block, fanout) + 1e-9))
    width = fanout**levels
    risen = landing.land(_climb_blocks(nodes, fanout, levels), "merkle")
    if (risen.agg(F.max("size")).first()[0] or 0) <= width:
        return risen
    tops = risen.where(F.col("pos") % width == 0).select(
        "group",
        F.expr(f"pos div {width}").alias("pos"),
        F.expr(f"(size + {width - 1}) div {width}").alias("size"),
        F.col("root").alias("digest"),
    )
    above = climb(tops, fanout, landing, block).select(
        "group",
        F.col("pos").alias("_block"),
        F.col("root").alias("_root"),
        F.col("proof").alias("_proof"),
    )
    return (
        risen.withColumn("_block", F.expr(f"pos div {width}"))
        .join(above, ["group", "_block"])
        .withColumns({"proof": F.concat("proof", "_proof"), "root": F.col("_root")})
        .drop("_block", "_root", "_proof")
    )


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    *,
    id: str = "doc_id",
    group: str = "lang",
    fanout: int = 2,
    extra: Mapping[str, Column] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """For each row: id, leaf, subroot (of its group), root (of the dataset) and proof.

    ``columns`` are hashed, in that order.  ``proof`` has for each level, from the leaf up to
    the root, the digests of the siblings before and after: :func:`fold` recomputes the root
    with them, and :func:`siblings_digest` makes one digest of them.  Digests are hex texts,
    those inside ``proof`` are bytes.  ``extra`` columns are computed where the records are read.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    named = F.col(f"`{group}`").cast("string")
    extra = dict(extra or {})
    landing = Landing(docs.sparkSession)
    leaves = docs.select(
        F.col(f"`{id}`").alias("_id"),
        # no null, and in the order of bytes: the null group is the empty text
        F.coalesce(F.concat(F.lit("="), named), F.lit("")).alias("group"),
        F.unhex(record_digest([F.col(f"`{c}`") for c in columns])).alias("digest"),
        F.monotonically_increasing_id().alias("_salt"),
        *[c.alias(f"_extra_{name}") for name, c in extra.items()],
    )
    # hashed once: the range sort below looks at its input twice
    hashed = Landing(docs.sparkSession)
    leaves = hashed.land(leaves, "leaves")
    ordered = Landing(docs.sparkSession)
    placed = ranked(leaves, "group", ["_id", "digest", "_salt"], ordered)
    hashed.clear()
    leaves = climb(placed.drop("_salt"), fanout, landing, block)
    subroots = leaves.where("pos = 0").select(F.col("group").alias("_group"), F.col("root").alias("digest"))
    whole = ranked(subroots.withColumn("group", F.lit("")), "group", ["_group"], ordered)
    roots = climb(whole, fanout, landing, block).select(
        F.col("_group").alias("group"),
        F.col("root").alias("_root"),
        F.col("proof").alias("_proof"),
    )
    ordered.clear()
    return leaves.join(roots, "group").select(
        F.col("_id").alias(id),
        _hex(F.col("digest")).alias("leaf"),
        _hex(F.col("root")).alias("subroot"),
        _hex(F.col("_root")).alias("root"),
        F.concat("proof", "_proof").alias("proof"),
        *[F.col(f"_extra_{name}").alias(name) for name in extra],
    )

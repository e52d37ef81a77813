"""Merkle manifest of a dataset: a leaf per row, a tree per group of rows, a tree over the groups, a proof per row.

Leaves are numbered within their group and dealt into *parts* of ``FANOUT ** HEIGHT`` consecutive ones, so a part is
the whole subtree under one node. Nodes above the parts come from a butterfly exchange (``butterfly``): in round r the
eight parts whose numbers differ in their r-th digit (base 8) only swap the roots they know. Each hashes the ancestor
for itself, which repeats work of its partners, and keeps what it got as the next level of its upper proof. After the
last round every part knows the root and its whole way up; nothing is sent down the tree again. A round is one shuffle
of a row per part. The last block of a round may lack partners; its parts stand in for the missing ones.

The roots of the groups are leaves of one more such tree. Whatever the sizes, a task holds a part and its way up.

* null in a field is ``-`` in the leaf; a null group is a group of its own, the first one
* rows with equal keys: in the order of their leaves; equal rows have equal leaves, so any order gives the same rows
* empty texts are fields of no bytes; very long texts are hashed by Spark where they lie and never shuffled
* an empty table gives an empty result; further columns of the input are ignored
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.session import pin

FANOUT = 8
HEIGHT = 4  # levels inside a part: 4,096 leaves
RANGE_ROWS = 500_000  # leaves of a task while they are numbered
WAY = "array<struct<at:int,others:array<string>>>"  # per level: place in the run, the run's other nodes


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else the number of its bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _hash(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def _levels(nodes: list[str], most: int | None) -> list[list[str]]:
    """The nodes and the levels above them: ``most`` levels, or up to a single node."""
    out = [nodes]
    while len(out) <= most if most is not None else len(out[-1]) > 1:
        out.append([_hash(out[-1][i : i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def _way(levels: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    """From the node ``at`` of the lowest level up to the highest: place in its run and the run's others."""
    out = []
    for nodes in levels[:-1]:
        run = nodes[at - at % FANOUT : at - at % FANOUT + FANOUT]
        out.append((at % FANOUT, run[: at % FANOUT] + run[at % FANOUT + 1 :]))
        at //= FANOUT
    return out


def fold(leaf: str, way: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and the others on its way up give."""
    for at, others in way:
        leaf = _hash([*others[:at], leaf, *others[at:]])
    return leaf


def placed(leaves: DataFrame, order: Sequence[str], height: int = HEIGHT) -> DataFrame:
    """Number the rows of each ``g`` by ``order``: adds ``pos``, ``part`` and ``parts``, their number in the group.

    ``leaves`` must be a stored table. Rows are range-partitioned, whatever the size of a group, and the counts per
    range and group are added up.
    """
    rows = leaves.withColumn("_tie", F.monotonically_increasing_id())  # rows repeated often can be cut apart
    ranges = max(1, -(-leaves.count() // RANGE_ROWS))
    ranged = pin(rows.repartitionByRange(ranges, "g", *order, "_tie").withColumn("_range", F.spark_partition_id()), "leaves-ranged")
    counts = ranged.groupBy("g", "_range").agg(F.count("*").alias("n"))
    one = Window.partitionBy("g").orderBy("_range")
    before = F.coalesce(F.sum("n").over(one.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = counts.select("g", "_range", before.alias("_before"), F.sum("n").over(Window.partitionBy("g")).alias("_all"))
    rank = F.row_number().over(Window.partitionBy("g", "_range").orderBy(*order, "_tie"))
    size = FANOUT**height
    numbered = ranged.withColumn("_rank", rank).join(sums, ["g", "_range"])
    pos = F.col("_before") + F.col("_rank") - 1
    return pin(
        numbered.select(
            *leaves.columns, pos.alias("pos"), F.floor(pos / size).cast("long").alias("part"),
            F.ceil(F.col("_all") / size).cast("long").alias("parts"),
        ),
        "leaves",
    )


def butterfly(parts: DataFrame) -> DataFrame:
    """Parts ``(g, part, parts, node, height)`` with their upper proofs: adds ``way`` and makes ``node`` the group's root.

    Each round is a shuffle by (group, higher digits, lower digits) of one row per part; what meets there is at most
    ``FANOUT`` rows. Groups with fewer parts have their root already and only wait.
    """
    state = pin(parts.withColumn("way", F.from_json(F.lit("[]"), WAY)), "parts")
    most = state.agg(F.max("parts")).first()[0] or 0
    span = 1  # parts below a node that is swapped in this round
    while span < most:
        state = pin(_swap(state, span), "parts")
        span *= FANOUT
    return state


def _swap(state: DataFrame, span: int) -> DataFrame:
    part, parts = F.col("part"), F.col("parts")
    block = F.floor(part / span).cast("long")
    active = state.where(parts > span).withColumns({
        "_high": F.floor(part / (span * FANOUT)).cast("long"), "_low": part % span, "_digit": (block % FANOUT).cast("int"),
    })
    # the last block may hold fewer than ``span`` parts; they share the calls that its missing ones would get
    last = F.floor((parts - 1) / span).cast("long")
    short = parts - last * span
    lone = active.where((block == last) & (short < span) & (last % FANOUT > 0))
    calls = F.floor((F.lit(span - 1) - F.col("_low")) / short).cast("long")  # further lower digits of this part
    thousand = F.explode(F.sequence(F.lit(0), F.floor(calls / 1000))).alias("_k")
    step = F.explode(F.sequence(F.col("_k") * 1000, F.least(F.col("_k") * 1000 + 999, calls))).alias("_k")
    also = lone.select("*", short.alias("_short"), calls.alias("_calls")).where("_calls > 0")
    also = also.select("*", thousand).select(*[c for c in also.columns], step).where("_k > 0")
    sent = active.select("g", "_high", "_low", "_digit", "node", F.struct("part", "parts", "height", "way").alias("own"))
    stand_in = also.select(
        "g", "_high", (F.col("_low") + F.col("_k") * F.col("_short")).alias("_low"), "_digit", "node",
        F.lit(None).cast(sent.schema["own"].dataType).alias("own"),
    )
    met = sent.unionByName(stand_in).groupBy("g", "_high", "_low").agg(
        F.sort_array(F.collect_list(F.struct("_digit", "node", "own"))).alias("run")  # at most FANOUT entries
    )
    nodes = met.select(
        "g", F.sha2(F.array_join(F.col("run.node"), ""), 256).alias("node"), F.col("run.node").alias("_nodes"),
        F.posexplode("run").alias("_at", "_own"),
    ).where("_own.own IS NOT NULL")
    others = F.filter("_nodes", lambda x, i: i != F.col("_at"))
    level = F.array(F.struct(F.col("_at").alias("at"), others.alias("others")))
    swapped = nodes.select(
        "g", "node", *[F.col(f"_own.own.{c}").alias(c) for c in ("part", "parts", "height")],
        F.concat(F.col("_own.own.way"), level.cast(WAY)).alias("way"),
    )
    return state.where(parts <= span).unionByName(swapped.select(*state.columns))


def tops(leaves: DataFrame, height: int) -> DataFrame:
    """The node over each part, ``height`` levels up; the only part of a group ends in a single node."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        parts = group.column("parts")[0].as_py()
        top = _levels(group.column("leaf").to_pylist(), height if parts > 1 else None)[-1][0]
        return pa.table({
            "g": group.column("g").slice(0, 1), "part": group.column("part").slice(0, 1),
            "parts": group.column("parts").slice(0, 1), "node": pa.array([top]), "height": pa.array([height], pa.int32()),
        })

    rows = leaves.select("g", "part", "parts", "pos", "leaf")
    return rows.groupBy("g", "part").applyInArrow(run, "g string, part long, parts long, node string, height int")


def ways(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """``(id, way, root)`` of each leaf, from the upper proofs of its part."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        row = right.select(["node", "way", "parts", "height"]).to_pylist()[0]
        levels = _levels(left.column("leaf").to_pylist(), row["height"] if row["parts"] > 1 else None)
        upper = [(x["at"], x["others"]) for x in row["way"]]
        found = [[{"at": a, "others": o} for a, o in _way(levels, i) + upper] for i in range(len(left))]
        kind = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))
        return pa.table({"id": left.column("id"), "way": pa.array(found, kind), "root": pa.array([row["node"]] * len(left))})

    rows = leaves.select("g", "part", "pos", "id", "leaf").groupBy("g", "part")
    return rows.cogroup(above.groupBy("g", "part")).applyInArrow(run, f"id string, way {WAY}, root string")


def checked(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """Digests of the whole ways, and the root that the tampered leaf gives with the original others.

    ``above`` has a row per part: its upper proof within the group (``way``), the group's way to the ``root``
    (``rest``). A part's lower levels are hashed again here, which costs less than storing a way per leaf.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        row = right.select(["node", "way", "parts", "height", "rest", "root"]).to_pylist()[0]
        levels = _levels(left.column("leaf").to_pylist(), row["height"] if row["parts"] > 1 else None)
        upper = [(x["at"], x["others"]) for x in row["way"] + row["rest"]]
        proof, folded = [], []
        for i, leaf in enumerate(left.column("tampered").to_pylist()):
            way = _way(levels, i) + upper
            proof.append(_hash([x for _, others in way for x in others]))
            folded.append(fold(leaf, way))
        same = {n: pa.array([row[n]] * len(left), pa.string()) for n in ("node", "root")}
        return pa.table({"id": left.column("id"), "g": left.column("g"), "leaf": left.column("leaf"),
                         "subroot": same["node"], "root": same["root"], "proof_sha256": pa.array(proof),
                         "folded_root": pa.array(folded)})

    schema = f"id {leaves.schema['id'].dataType.simpleString()}, g string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    rows = leaves.select("g", "part", "pos", "id", "leaf", "tampered").groupBy("g", "part")
    return rows.cogroup(above.groupBy("g", "part")).applyInArrow(run, schema)


def manifest(rows: DataFrame, key: str, group: str, fields: Sequence[Column], tampered: Sequence[Column] | None = None,
             height: int = HEIGHT) -> DataFrame:
    """One row per row: ``key``, ``group`` as text, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf is the digest of ``fields``. Groups are trees of their leaves by ``key``; their roots, by group, are the
    leaves of the last tree. ``tampered`` are the fields as an untrusted copy has them: ``folded_root`` is what that
    copy's leaf and the proof give, and the row is verified if it equals the root.
    """
    leaf = digest(fields)
    named = F.when(F.col(group).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    stored = pin(
        rows.select(
            F.col(key).alias("id"), named.alias("g"), leaf.alias("leaf"),
            (leaf if tampered is None else digest(tampered)).alias("tampered"),
        ),
        "leaf-digests",
    )
    leaves = placed(stored, ["id", "leaf"], height)
    climbed = butterfly(tops(leaves, height))
    roots = climbed.where("part = 0").select(F.lit("").alias("g"), F.col("g").alias("id"), F.col("node").alias("leaf"))
    over = placed(pin(roots, "subroots"), ["id"], height)
    rest = ways(over, butterfly(tops(over, height))).select(F.col("id").alias("g"), F.col("way").alias("rest"), "root")
    found = checked(leaves, climbed.join(pin(rest, "ways"), "g"))
    return found.select(
        F.col("id").alias(key), F.when(F.col("g") != "0", F.expr("substring(g, 2)")).alias(group), "leaf", "subroot",
        "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )

"""A Merkle tree over the rows of a dataset, with a proof for each row.

The children of a node become columns of one row by conditional aggregates ("slot pivot"): all columns together hash to
the parent, all but a child's own column are its siblings. One pivot spreads `fanout ** rise` nodes, so that one shuffle
climbs `rise` levels; the levels between are expressions over the columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.common import positions, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(parts: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the parts put together; null parts count as nothing."""
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)


def field(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, colon and value, so that no two rows spell the same bytes."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(row: dict[str, Column]) -> Column:
    return digest([field(row[c]) for c in FIELDS])


def _pivot(nodes: DataFrame, fanout: int, rise: int) -> DataFrame:
    """One row for every `fanout ** rise` nodes of a group: `top`, their common ancestor, and `children`.

    nodes: g, pos, group_size, h and payload (a struct, not null). Children hold slot, payload and path: on each level
    the siblings to the left and to the right of the child's own column. A group with fewer nodes than columns climbs
    only to its root.
    """
    width = fanout**rise
    slot = F.col("pos") % width
    wide = nodes.groupBy("g", F.expr(f"pos div {width}").alias("block")).agg(
        F.max("group_size").alias("group_size"), *[F.max(F.when(slot == j, F.struct("h", "payload"))).alias(f"s{j}") for j in range(width)]
    )
    wide = wide.select("g", "block", "group_size", *[f"s{j}" for j in range(width)], *[F.col(f"s{j}")["h"].alias(f"n0_{j}") for j in range(width)])
    for level in range(1, rise + 1):
        below = [[F.col(f"n{level - 1}_{k * fanout + i}") for i in range(fanout)] for k in range(fanout ** (rise - level))]
        wide = wide.select("*", *[F.when(run[0].isNotNull(), digest(run)).alias(f"n{level}_{k}") for k, run in enumerate(below)])
    levels = sum((F.when(F.col("group_size") > fanout**i, 1).otherwise(0) for i in range(rise)), F.lit(0))

    def path(j: int) -> Column:
        steps = []
        for level in range(rise):
            own = j // fanout**level
            first = own - own % fanout
            side = lambda span, level=level: F.concat(F.lit(""), *[F.coalesce(F.col(f"n{level}_{i}"), F.lit("")) for i in span])
            steps.append(F.struct(side(range(first, own)).alias("left"), side(range(own + 1, first + fanout)).alias("right")))
        return F.slice(F.array(*steps), F.lit(1), F.col("levels"))

    wide = wide.withColumn("levels", levels)
    top = F.coalesce(*[F.when(F.col("levels") == level, F.col(f"n{level}_0")) for level in range(rise + 1)])
    children = F.array(*[F.struct(F.lit(j).cast("long").alias("slot"), F.col(f"s{j}")["payload"].alias("payload"), path(j).alias("path")) for j in range(width)])
    return wide.select("g", "block", "group_size", top.alias("top"), F.filter(children, lambda x: x["payload"].isNotNull()).alias("children"))


def climb(nodes: DataFrame, fanout: int = 2, rise: int = 4) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (g, root) of all groups and the pivots on the way, lowest first, each a stored table."""
    width, pivots = fanout**rise, []
    most = nodes.agg(F.max("group_size")).first()[0] or 0
    while True:
        pivots.append(stored(_pivot(nodes, fanout, rise), "pivot"))
        if most <= width:
            return pivots[-1].select("g", F.col("top").alias("root")), pivots
        most = -(-most // width)
        up = F.ceil(F.col("group_size") / width).cast("long")
        nodes = pivots[-1].select("g", F.col("block").alias("pos"), up.alias("group_size"), F.col("top").alias("h"), F.struct("block").alias("payload"))


def descend(starts: DataFrame, pivots: list[DataFrame], fanout: int = 2, rise: int = 4) -> DataFrame:
    """Rows (g, payload, path and the other columns of `starts`) of the lowest nodes.

    starts: g, path (what follows above the group's root) and columns to hand down, one row a group.
    """
    width = fanout**rise
    carried = [c for c in starts.columns if c not in ("g", "path")]
    above = starts.withColumn("pos", F.lit(0).cast("long"))
    for number, pivot in reversed(list(enumerate(pivots))):
        rows = pivot.join(above.withColumnsRenamed({"g": "g_", "pos": "pos_"}), (F.col("g") == F.col("g_")) & (F.col("block") == F.col("pos_")))
        rows = rows.select("g", "block", *carried, F.col("path").alias("rest"), F.inline("children"))
        above = rows.select(
            "g", (F.col("block") * width + F.col("slot")).alias("pos"), F.concat("path", "rest").alias("path"), *carried,
            *(["payload"] if number == 0 else []),
        )
    return above.drop("pos")


def manifest(docs: DataFrame, changed: Column, fanout: int = 2, rise: int = 4) -> DataFrame:
    """Leaf, subroot of its language, root and proof of each row, and whether a changed row is found out.

    changed: what stands in n_chars when the row is read again; where it is not the stored value, the fold of the proof
    misses the root.

    Cases: null fields hash as `-`, null is a language of its own, before the others; null ids come before other ids;
    rows with one id follow the order of their leaves, equal rows are leaves of their own; empty and long texts hash as
    they are; other columns are left out; an empty table gives no row. One row a language has an empty lower proof.
    """
    row = {c: F.col(c) for c in FIELDS}
    rows = stored(docs.select(
        F.col("doc_id"), F.col("lang"), leaf_of(row).alias("h"),
        F.when(~changed.eqNullSafe(F.col("n_chars")), leaf_of(row | {"n_chars": changed})).alias("changed"),
    ), "leaves")
    placed = positions(rows, ["lang"], [F.col("doc_id").asc_nulls_first(), F.col("h")])
    langs = positions(placed.filter("pos = 0").select("lang"), [], [F.col("lang").asc_nulls_first()], "g").drop("group_size")
    langs = stored(langs, "langs")
    nodes = placed.join(langs.withColumnRenamed("lang", "lang_"), F.col("lang").eqNullSafe(F.col("lang_"))).select(
        "g", "pos", "group_size", "h", F.struct("doc_id", "h", "changed").alias("payload")
    )
    subroots, low = climb(nodes, fanout, rise)
    tops = stored(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.col("root").alias("h")), "subroots")
    count = tops.count()
    root, high = climb(tops.select("g", "pos", F.lit(count).cast("long").alias("group_size"), "h", F.struct("pos", "h").alias("payload")), fanout, rise)
    starts = descend(root.select("g", F.array().cast(PATH).alias("path"), "root"), high, fanout, rise).select(
        F.col("payload")["pos"].alias("g"), "path", F.col("payload")["h"].alias("subroot"), "root"
    )
    proved = descend(starts, low, fanout, rise)
    return proved.select(
        F.col("payload")["doc_id"].alias("doc_id"), F.col("payload")["h"].alias("leaf"), F.col("payload")["changed"].alias("changed"), "subroot", "root", "path"
    )


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)

"""Line dedup by spread over sites: boilerplate lines that many sites carry are removed but for their first place.

Only DataFrame functions run here. Each line hash gets a HyperLogLog sketch of the sites it was seen on; sketches merge
in the aggregation (partial sketches before the shuffle). Lines whose estimate is clearly at or over the threshold, or
clearly under it, are settled; those near it get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.common import plain_lower, stored

#: Blanks that are not one plain space already.
BLANKS = r"[ \t\x0B\f\r]{2,}|[\t\x0B\f\r]"


def normal_lines(text: Column) -> Column:
    """The lines of a text: A-Z in lower case, runs of blanks as one space, none at the ends."""
    return F.split(F.regexp_replace(plain_lower(text), BLANKS, " "), "\n")


def line_table(docs: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source", least_chars: int = 10) -> DataFrame:
    """Rows (doc, twin, site, at, h1, h2): each line of at least `least_chars` normal characters; its digest has 128 bits.

    `twin` is a hash of the text that keeps apart rows of one id with different texts. Null texts have no lines.
    """
    rows = docs.select(
        F.col(doc).alias("doc"), F.xxhash64(text).alias("twin"), F.col(site).cast("string").alias("site"),
        F.posexplode(normal_lines(F.col(text))).alias("at", "line"),
    )
    rows = rows.withColumn("line", F.trim("line")).filter(F.length("line") >= least_chars)
    return rows.select("doc", "twin", "site", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def spread_lines(lines: DataFrame, sites: int, sketch_bits: int = 10) -> DataFrame:
    """Digests of lines on at least `sites` distinct sites, with the first place (doc, twin, at) of each.

    Null sites count as no site. A sketch of 2^bits cells has a relative error of 1.04 / sqrt(2^bits); the exact
    count is taken within five such errors of the threshold (and one site at least).
    """
    seen = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(sketch_bits))).alias("about"),
        F.min(F.struct("doc", "twin", "at")).alias("first"), F.count(F.lit(1)).alias("places"),
    ).filter(F.col("places") >= sites)
    margin = max(1.0, 5 * 1.04 / 2 ** (sketch_bits / 2) * sites)
    sure = seen.filter(F.col("about") > sites + margin).select("h1", "h2", "first")
    near = seen.filter(F.col("about").between(sites - margin, sites + margin)).select("h1", "h2", "first")
    counted = (
        lines.join(near, ["h1", "h2"]).select("h1", "h2", "site", "first").distinct()
        .groupBy("h1", "h2").agg(F.count("site").alias("n"), F.first("first").alias("first")).filter(F.col("n") >= sites)
    )
    return sure.union(counted.select("h1", "h2", "first"))


def dedup_lines(
    docs: DataFrame, sites: int = 8, doc: str = "doc_id", text: str = "text", site: str = "source", least_chars: int = 10,
) -> DataFrame:
    """The rows of `docs` with `text` cleaned, and `n_lines`, `n_removed` added (columns of those names are replaced).

    A line on at least `sites` distinct sites stays at its first place (lowest id, then line number) and is removed
    elsewhere with its line break. Short lines always stay. Null text stays null with 0 lines; empty text has one
    line. Repeated rows (same id and text) count as one document and get the same result. An empty table gives none.
    """
    lines = stored(line_table(docs, doc, text, site, least_chars), "lines")
    wide = spread_lines(lines, sites)
    place = F.struct("doc", "twin", "at")
    gone = (
        lines.join(wide, ["h1", "h2"]).filter(place != F.col("first"))
        .groupBy(F.col("doc").alias("__doc"), F.col("twin").alias("__twin")).agg(F.collect_set("at").alias("__gone"))
    )
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keyed = docs.select(*kept, F.xxhash64(text).alias("__key"))
    joined = keyed.join(gone, F.col(doc).eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__twin")), "left")
    cut = F.split(F.col(text), "\n")
    stay = F.transform(F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col("__gone")), lambda i: F.get(cut, i))
    clean = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(stay, "\n"))
    return joined.select(
        *[clean.alias(c) if c == text else F.col(c) for c in kept],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(cut)).cast("long").alias("n_lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("n_removed"),
    )

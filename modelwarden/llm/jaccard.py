"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself.

Rows are classes of equal shingle sets, columns are shingles. A link (J >= 0.8) needs an overlap of at least 0.8 of the
larger set, so it shows in the first part of both rows once columns are put in one order (known frequent ones last, then
by hash): rows of n entries keep n - ceil(0.8 n) + k of them, and linked rows share k of those. The kept entries are
dealt to blocks of columns; blocks add up overlap counts, pairs under the size-derived bounds are dropped, and what is left
is multiplied in full, from the texts. Groups are linked through one leader a column first; only pairs of rows that
are still apart are then counted, so a group of near copies does not cost its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.common import components, grouped, lowered, released, slices, span_hashes, spread, stored, utf8, word_bounds

#: Words are runs of anything but blanks.
INK = np.array([c not in (9, 10, 11, 12, 13, 32) for c in range(256)])


def shingle_sets(column: pa.Array, width: int = 5, most_bytes: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingle hashes of each row; shorter texts have their word list as the one shingle.

    Rows are taken in runs of about `most_bytes`, as the word arrays of a run need some 30 times its bytes.
    """
    runs = [_shingles(part.column("text"), width) for part in slices(iter([pa.RecordBatch.from_arrays([column], ["text"])]), "text", most_bytes)]
    sizes = [np.diff(offsets) for _, offsets in runs]
    return (
        np.concatenate([np.zeros(0, np.uint64), *(codes for codes, _ in runs)]),
        np.concatenate([np.zeros(1, np.int64), *sizes]).cumsum(),
    )


def _shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = utf8(column)
    rows, starts, ends = word_bounds(raw, offsets, INK)
    words = span_hashes(lowered(raw), starts, ends - starts)
    count = np.bincount(rows, minlength=len(column))
    first = np.cumsum(count) - count
    found_rows, found = [], []
    for n in range(1, width + 1):
        if n == width:
            heads = np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :]) if len(rows) >= n else np.zeros(0, np.int64)
        else:
            heads = first[count == n]
        code = np.full(len(heads), n, np.uint64)
        for k in range(n):
            code = spread(code ^ words[heads + k], 31 + k)
        found_rows.append(rows[heads])
        found.append(code)
    rows, codes = np.concatenate(found_rows), np.concatenate(found)
    order = np.argsort(codes, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    rows, codes = rows[order], codes[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])
    rows, codes = rows[fresh], codes[fresh]
    return codes, np.searchsorted(rows, np.arange(len(column) + 1))


def needed(size: np.ndarray) -> np.ndarray:
    """Least overlap of a row of this size with any row it links to: ceil(0.8 * size)."""
    return -(-4 * size // 5)


def shared(size: np.ndarray) -> np.ndarray:
    """Kept entries that a row of this size shares with any row it links to."""
    return np.minimum(2 + size // 20, needed(size))


def set_ids(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit id of each row's set, from two sums of mixed hashes and the size."""
    def total(seed: int) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread(codes, seed), dtype=np.uint64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    return spread(spread(total(41), 43) ^ total(42) ^ np.diff(offsets).astype(np.uint64), 44).view(np.int64)


def _profile(docs: DataFrame, least: int = 2) -> DataFrame:
    """Rows of kind 0 (doc, twin, size, id) for documents, of kind 1 (code, count) for shingles frequent within a slice."""
    schema = "kind int, doc long, twin long, size long, id long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16_000_000):
            codes, sizes, ids = [], [], []
            for part in slices(iter([batch]), "text"):
                c, o = shingle_sets(part.column("text"))
                codes.append(c)
                sizes.append(np.diff(o))
                ids.append(set_ids(c, o))
            codes, sizes, ids = (np.concatenate(x) for x in (codes, sizes, ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(ids), np.int32)), batch.column("doc"), batch.column("twin"), pa.array(sizes.astype(np.int64)), pa.array(ids)],
                ["kind", "doc", "twin", "size", "id"],
            )
            once = np.zeros(len(ids), bool)
            once[np.unique(ids, return_index=True)[1]] = True
            known, count = np.unique(codes[np.repeat(once, sizes)], return_counts=True)
            often = count >= least
            none = pa.nulls(int(often.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(int(often.sum()), np.int32)), none, none, pa.array(count[often].astype(np.int64)), pa.array(known[often].view(np.int64))],
                ["kind", "doc", "twin", "size", "id"],
            )

    return docs.mapInArrow(released(run), schema)


PACKED = "block int, codes binary, ids binary, sizes binary"


def _pack(block: np.ndarray, codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(block, kind="stable")
    block, codes, ids, sizes = block[order], codes[order], ids[order], sizes[order]
    found, first = np.unique(block, return_index=True)
    ends = [*first[1:], len(block)]
    cut = lambda x: [x[a:b].tobytes() for a, b in zip(first, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(found.astype(np.int32)), *(pa.array(cut(x), pa.binary()) for x in (codes, ids, sizes.astype(np.int32)))], ["block", "codes", "ids", "sizes"]
    )


def _entries(docs: DataFrame, frequent: np.ndarray, counts: np.ndarray, blocks: int, most: int) -> DataFrame:
    """Kept entries of each row, packed by block of columns. Columns of more than `most` rows are split by row id."""
    order = np.argsort(frequent)
    known = docs.sparkSession.sparkContext.broadcast((frequent[order], counts[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, count = known.value
        for batch in slices(batches, "text"):
            codes, offsets = shingle_sets(batch.column("text"))
            sizes, ids = np.diff(offsets), set_ids(codes, offsets)
            once = np.zeros(len(ids), bool)
            once[np.unique(ids, return_index=True)[1]] = True
            rows = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(often, codes), max(len(often) - 1, 0))
            late = often[at] == codes if len(often) else np.zeros(len(codes), bool)
            # Hashes are in order within a row: the frequent ones move behind the others.
            order = np.argsort(rows * 2 + late, kind="stable")
            codes, at, late = codes[order], at[order], late[order]
            place = np.arange(len(rows)) - offsets[:-1][rows]
            keep = np.flatnonzero((place < (sizes - needed(sizes) + shared(sizes))[rows]) & once[rows])
            codes, rows, at, late = codes[keep], rows[keep], at[keep], late[keep]
            block = (spread(codes, 51) % np.uint64(blocks)).astype(np.int64)
            if len(often):
                parts = np.where(late, -(-count[at] // most), 1)
                block = np.where(parts > 1, blocks + (spread(codes, 52) ^ spread(ids[rows].view(np.uint64) % np.maximum(parts, 1).astype(np.uint64), 53)).astype(np.int64) % (1 << 20), block)
            yield _pack(block, codes, ids[rows], sizes[rows])

    return docs.mapInArrow(released(run), PACKED)


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(codes)))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The size bound: the smaller set has at least 0.8 of the larger one."""
    return 5 * np.minimum(a, b) >= 4 * np.maximum(a, b)


def _columns(packed: DataFrame) -> DataFrame:
    """Entries of columns that two rows or more share: rows (code, id, size, lead, lead_size)."""

    def run(table: pa.Table) -> pa.Table:
        joined = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        codes, ids, sizes = joined("codes", np.int64), joined("ids", np.int64), joined("sizes", np.int32)
        order = np.lexsort((ids, codes))
        codes, ids, sizes = codes[order], ids[order], sizes[order]
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (ids[1:] != ids[:-1])
        codes, ids, sizes = codes[fresh], ids[fresh], sizes[fresh]
        first, length = _runs(codes)
        lead = np.repeat(first, length)
        wide = np.repeat(length > 1, length)
        return pa.table({"code": codes[wide], "id": ids[wide], "size": sizes[wide].astype(np.int64), "lead": ids[lead][wide], "lead_size": sizes[lead][wide].astype(np.int64)})

    return packed.groupBy("block").applyInArrow(grouped(run), "code long, id long, size long, lead long, lead_size long")


def _counted(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose counts over all blocks meet the bounds of both sizes."""
    total = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.first("a_size").alias("a_size"), F.first("b_size").alias("b_size"))
    least = lambda c: F.least(F.lit(2) + F.floor(F.col(c) / 20), F.ceil(F.col(c) * 4 / 5))
    return total.filter(F.col("n") >= F.least(least("a_size"), least("b_size"))).select("a", "b")


def _mixed(columns: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries (code, id, size, component, rows) of the columns whose rows are in more than one component."""
    rows = columns.select("code", "id", "size").join(labels.select(F.col("node").alias("id"), "component"), "id", "left")
    rows = rows.select("code", "id", "size", F.coalesce("component", "id").alias("component"))
    mixed = rows.groupBy("code").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("rows"))
    return stored(rows.join(mixed.filter("low <> high").select("code", "rows"), "code"), "mixed")


def _apart(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b, n, sizes) of rows that share columns, pass the size bound and are in different components."""
    met = mixed.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(4096)))

    def run(table: pa.Table) -> pa.Table:
        get = lambda c: table[c].to_numpy()
        order = np.lexsort((get("id"), get("size"), get("code")))
        codes, ids, sizes, group = (get(c)[order] for c in ("code", "id", "size", "component"))
        first, length = _runs(codes)
        out = []
        for start, count in zip(first.tolist(), length.tolist()):
            rest = slice(start, start + count)
            i_, z, g = ids[rest], sizes[rest], group[rest]
            # Sizes are in order: row i meets rows after it up to 1.25 times its size.
            stop = np.searchsorted(z, z * 5 // 4, side="right")
            for i in range(count - 1):
                j = slice(i + 1, int(stop[i]))
                ok = g[j] != g[i]
                if ok.any():
                    other = i_[j][ok]
                    out.append((np.minimum(other, i_[i]), np.maximum(other, i_[i]), np.where(other < i_[i], z[j][ok], z[i]), np.where(other < i_[i], z[i], z[j][ok])))
        if not out:
            return pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "n", "a_size", "b_size")})
        a, b, a_size, b_size = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((b, a))
        a, b, a_size, b_size = a[order], b[order], a_size[order], b_size[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        n = np.diff(np.append(np.flatnonzero(new), len(a)))
        return pa.table({"a": a[new], "b": b[new], "n": n, "a_size": a_size[new], "b_size": b_size[new]})

    return met.groupBy("block").applyInArrow(grouped(run), "a long, b long, n long, a_size long, b_size long")


def _product(mixed: DataFrame, classes: DataFrame, docs: DataFrame, chunk: int) -> DataFrame:
    """Spanning edges (a, b) of the links among the rows of each large column, by the full product of its rows.

    A column's rows are dealt to chunks by id; chunks meet in pairs of tasks. A task multiplies the incidence of its rows
    block by block of shingles, adds the counts up and keeps what meets the bound; it gives edges, not pairs.
    """
    texts = _texts(mixed.select("id").distinct(), classes, docs)
    parts = F.ceil(F.col("rows") / chunk).cast("int")
    met = mixed.withColumn("own", F.pmod(F.xxhash64("id"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    met = met.select("code", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "id").join(texts, "id")

    def run(table: pa.Table) -> pa.Table:
        ids, column = table["id"].to_numpy(), table["text"].combine_chunks()
        codes, offsets = shingle_sets(pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column)
        sizes = np.diff(offsets)
        rows = np.repeat(np.arange(len(ids)), sizes)
        _, at, count = np.unique(codes, return_inverse=True, return_counts=True)
        place = np.cumsum(count > 1) - 1
        rows, at = rows[count[at] > 1], place[at[count[at] > 1]]
        total, order = np.zeros((len(ids), len(ids)), np.float32), np.argsort(at, kind="stable")
        rows, at = rows[order], at[order]
        for start in range(0, int(at[-1]) + 1 if len(at) else 0, 1024):
            a, b = np.searchsorted(at, [start, start + 1024])
            block = np.zeros((len(ids), 1024), np.float32)
            block[rows[a:b], at[a:b] - start] = 1
            total += block @ block.T
        label, linked = np.arange(len(ids)), []
        for i in range(len(ids)):
            j = i + 1 + np.flatnonzero(180 * total[i, i + 1 :].astype(np.int64) >= 80 * (sizes[i] + sizes[i + 1 :]))
            linked.append(np.append(j, i))
        moved = True
        while moved:
            moved = False
            for j in linked:
                if len(j) > 1 and (label[j] != label[j].min()).any():
                    label[j], moved = label[j].min(), True
        other = np.flatnonzero(label != np.arange(len(ids)))
        return pa.table({"a": ids[label[other]], "b": ids[other]})

    return met.groupBy("code", "x", "y").applyInArrow(grouped(run), "a long, b long")


def _texts(asked: DataFrame, classes: DataFrame, docs: DataFrame, small: int = 500_000) -> DataFrame:
    """Rows (id, text) for the asked class ids, from one document a class.

    The asked documents are broadcast up to `small` of them (24 bytes each), else joined by a shuffle.
    """
    asked = stored(asked.join(classes, "id").select("id", "rep_doc", "rep_twin"), "asked")
    few = F.broadcast(asked) if asked.count() <= small else asked
    texts = docs.join(few, F.col("doc").eqNullSafe(F.col("rep_doc")) & (F.col("twin") == F.col("rep_twin"))).select("id", "text")
    return stored(texts.dropDuplicates(["id"]), "texts")


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: full product of the two rows, from the texts of one document a class."""
    pairs = stored(pairs, "pairs")
    texts = _texts(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), classes, docs)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "a_text", 1_000_000):
            a, a_off = shingle_sets(batch.column("a_text"))
            b, b_off = shingle_sets(batch.column("b_text"))
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = a[a_off[i] : a_off[i + 1]], b[b_off[i] : b_off[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 100 * both >= 80 * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(linked)) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "a_text", "b_text").mapInArrow(released(run), "a long, b long")


def similar_groups(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", order_bound: int = 500_000, block_rows: int = 1_000_000, most: int = 200_000,
    large: int = 48, chunk: int = 1000,
) -> DataFrame:
    """One row per row of `docs`: (doc, twin, n_shingles, component_id, component), component_id being the smallest linked doc.

    `component` tells groups apart whose smallest doc is the same or null; it is null for texts without words.

    Texts link when they share 80 of 100 distinct five-word shingles (shorter texts: their whole word list).
    Null and wordless texts have no shingles and link with nothing. Rows of one id count by their text (`twin` is its hash);
    null ids are never a component's name unless it has no other. An empty table gives no rows.

    `order_bound` bounds the list of frequent shingles that is broadcast; it orders columns and does not change the result.
    `block_rows` sets the size of a block, `most` the entries of one column that a task may hold. Columns of more than
    `large` rows that are still apart are multiplied in place, `chunk` rows against `chunk` rows.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(text).alias("twin"), F.col(text).alias("text"))
    profile = stored(_profile(rows), "profile")
    found = profile.filter("kind = 0").select("doc", "twin", "size", "id")
    often = (
        profile.filter("kind = 1").groupBy("id").agg(F.sum("size").alias("n")).filter("n >= 8")
        .orderBy(F.desc("n"), "id").limit(order_bound).toArrow()
    )
    total = found.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = max(16, int(total * 0.26 / block_rows) + 1)
    classes = found.filter("size > 0").groupBy("id").agg(F.min(F.struct(F.col("doc").isNull().alias("no"), "doc", "twin")).alias("rep"))
    classes = stored(classes.select("id", F.col("rep.doc").alias("rep_doc"), F.col("rep.twin").alias("rep_twin")), "classes")
    packed = _entries(rows.select("text"), often["id"].to_numpy().view(np.uint64), often["n"].to_numpy(), blocks, most).repartition(blocks, "block")
    columns = stored(_columns(packed), "columns")

    size_ok = F.least("size", "lead_size") * 5 >= F.greatest("size", "lead_size") * 4
    star = columns.filter((F.col("id") != F.col("lead")) & size_ok).groupBy(F.col("lead").alias("a"), F.col("id").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.first("lead_size").alias("a_size"), F.first("size").alias("b_size")
    )
    leads = columns.select("code", F.col("lead").alias("id"), F.col("lead_size").alias("size")).distinct()
    heads = leads.groupBy("code").agg(F.min(F.struct("id", "size")).alias("m"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    joined = leads.join(heads, "code").filter("id <> m.id").select(F.col("m.id").alias("a"), F.col("id").alias("b")).distinct()
    first = stored(_links(_counted(star).union(joined).distinct(), classes, rows), "links")
    labels = stored(components(first), "labels")
    mixed = _mixed(columns, labels)
    second = _links(_counted(_apart(mixed.filter(F.col("rows") <= large))), classes, rows)
    third = _product(mixed.filter(F.col("rows") > large), classes, rows, chunk)
    labels = stored(components(first.union(second).union(third)), "labels")

    named = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    lowest = named.groupBy("component").agg(F.min("rep_doc").alias("component_id"))
    named = named.join(lowest, "component").select("id", "component_id", "component")
    out = found.join(named.withColumnRenamed("id", "c"), (F.col("id") == F.col("c")) & (F.col("size") > 0), "left")
    return out.select("doc", "twin", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"), "component")


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without the near copies: of each component the rows of component_id and of null ids stay (rows without words all stay).

    `one_of_each` leaves a single row.
    """
    groups = similar_groups(docs, doc, text)
    gone = groups.filter((F.col("n_shingles") > 0) & (F.col("doc") != F.col("component_id"))).select(F.col("doc").alias("__d"), F.col("twin").alias("__w")).distinct()
    keyed = docs.withColumn("__twin", F.xxhash64(text))
    return keyed.join(gone, F.col(doc).eqNullSafe(F.col("__d")) & (F.col("__twin") == F.col("__w")), "left_anti").drop("__twin")


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with a single row of each component (rows without words all stay).

    It is the one with the smallest id, then the smallest text hash; null ids come last. Of rows that are equal in both
    the smallest in all columns stays. Repeats are combined in each task before the shuffle.
    """
    groups = stored(similar_groups(docs, doc, text).filter("n_shingles > 0").groupBy("component", "doc", "twin").agg(F.count(F.lit(1)).alias("n")), "groups")
    place = F.struct(F.col("doc").isNull().alias("no"), "doc", "twin")
    best = groups.groupBy("component").agg(F.min(place).alias("best"))
    marks = groups.join(best, "component").select(F.col("doc").alias("__d"), F.col("twin").alias("__w"), (~place.eqNullSafe(F.col("best"))).alias("__gone"), (F.col("n") > 1).alias("__many"))
    marks = stored(marks.filter("__gone or __many"), "marks")
    same = F.col(doc).cast("long").eqNullSafe(F.col("__d")) & (F.col("__twin") == F.col("__w"))
    keyed = docs.withColumn("__twin", F.xxhash64(text))
    many = keyed.join(marks.filter("not __gone"), same).groupBy("__d", "__w").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return keyed.join(marks, same, "left_anti").drop("__twin").unionByName(many)

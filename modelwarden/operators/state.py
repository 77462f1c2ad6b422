"""As-of state of slowly-changing tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_of_day, as_of_end
from ..functions.predicates import required, truth
from ..sources.contract import apply_contract
from .ordered import spread_attach

ORDER_COLUMNS = ("start_dt", "ctl_datechange", "ctl_loading")


def _desc(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def _not_deleted() -> Column:
    return F.coalesce(F.upper(F.trim(F.col("ctl_action").cast("string"))) != "D", F.lit(True))


def drop_deleted(df: DataFrame) -> DataFrame:
    return df.filter(_not_deleted()) if "ctl_action" in df.columns else df


def take_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, newest first; ``order`` has to be total for a repeatable result.

    The rank filter reaches below the shuffle as a per-task limit, so a key with very many rows
    sends at most one of them from each task.
    """
    w = Window.partitionBy(*keys).orderBy(*_desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def valid_at(df: DataFrame, as_of: str, start: str = "start_dt", end: str | None = "end_dt") -> DataFrame:
    """Rows whose interval holds the as-of day; both bounds count, open ends are NULL or far."""
    if start.endswith("_dttm"):
        point, kind = as_of_end(as_of), "timestamp"
    else:
        point, kind = as_of_day(as_of), "date"
    cond = F.coalesce(F.col(start).cast(kind) <= point, F.lit(True))
    if end is not None and end in df.columns:
        cond = cond & F.coalesce(F.col(end).cast(kind) >= point, F.lit(True))
    return df.filter(cond)


def current_slice(df: DataFrame, keys: Sequence[str], as_of: str, tombstone: str = "after",
                  order: Sequence[str | Column] | None = None) -> DataFrame:
    """Newest valid row per key.

    ``tombstone="after"`` hides an entity whose newest row is a deletion; ``"before"`` drops
    deletion rows first, so the previous state shows again.
    """
    if tombstone not in ("after", "before"):
        raise ValueError("tombstone: after or before")
    live = valid_at(df, as_of)
    if tombstone == "before":
        live = drop_deleted(live)
    order = order or [c for c in ORDER_COLUMNS if c in df.columns]
    newest = take_latest(live, keys, order)
    return drop_deleted(newest) if tombstone == "after" else newest


BLOCK_BITS = 15         # rows of a block are marked in a bitmap of 2 ** 15 bits, the size that bitmap_construct_agg makes


def kept_slice(df: DataFrame, keys: Sequence[str], as_of: str, columns: Sequence[str], hold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``columns`` of :func:`current_slice`, without sorting or shuffling them; ``hold`` has to write what it is given.

    Valid rows are written once with their number. Only keys, order and number are ranked; the newest rows are marked in
    bitmaps, one bit per row, and found by their number. Rows that tie in keys and order go by their number.
    """
    order = [c for c in ORDER_COLUMNS if c in df.columns]
    action = [c for c in ("ctl_action",) if c in df.columns]
    needed = list(dict.fromkeys([*keys, *order, *action, *columns]))
    rows = hold(valid_at(df, as_of).select(*needed, F.monotonically_increasing_id().alias("_row")))
    newest = take_latest(rows.select(*dict.fromkeys([*keys, *order, "_row"])), keys, [*order, F.col("_row").asc()])
    spot = f"(_row & {(1 << BLOCK_BITS) - 1})"
    block = F.expr(f"shiftright(_row, {BLOCK_BITS})").alias("_block")
    marks = hold(newest.groupBy(block).agg(F.bitmap_construct_agg(F.expr(spot)).alias("_marks")))
    byte = f"cast(conv(hex(substring(_marks, cast({spot} div 8 as int) + 1, 1)), 16, 10) as int)"
    found = rows.select("*", block).join(F.broadcast(marks), "_block").filter(F.expr(f"(shiftright({byte}, cast(_row & 7 as int)) & 1) = 1"))
    return drop_deleted(found).select(*columns)


def current_rows(df: DataFrame, keys: Sequence[str], as_of: str) -> DataFrame:
    """Newest row per key where open intervals rank above closed ones."""
    end = F.col("end_dt").cast("timestamp")
    is_open = F.coalesce((end >= as_of_end(as_of)) | (F.year(end) >= 9999), F.lit(True))
    order = [F.when(is_open, 1).otherwise(0).desc()]
    order += _desc([c for c in ("ctl_datechange", "start_dt", "end_dt", "ctl_loading") if c in df.columns])
    return drop_deleted(take_latest(df, keys, order))


def _state_rows(df: DataFrame, keys: Sequence[str], fields: Sequence[str], as_of: str, current: bool, start: str, end: str,
                where: Column | None) -> tuple[DataFrame, list[str], list[str], list[str]]:
    """Rows valid at the as-of day with only what a state needs; payload, order and action columns."""
    df = apply_contract(df, [*keys, *fields, start])
    if where is not None:
        df = df.filter(where)
    payload = list(dict.fromkeys([*keys, *fields]))
    order = [c for c in (start, "ctl_datechange", "ctl_loading") if c in df.columns]
    action = [c for c in ("ctl_action",) if c in df.columns and c not in payload]
    rows = valid_at(df.filter(F.col(start).isNotNull()), as_of, start, end if current else None)
    rows = rows.select(*dict.fromkeys([*payload, *order, *action]))
    return rows.withColumns({c: F.col(c).cast("string") for c in payload if c.endswith("_sid")}), payload, order, action


def newest_states(df: DataFrame, keys: Sequence[str], fields: Sequence[str], as_of: str, current: bool = True,
                  start: str = "start_dt", end: str = "end_dt", where: Column | None = None) -> DataFrame:
    """One row per key: the newest payload, and ``ambiguous`` where newest rows differ.

    A "maximum with ties", combined in each task before the one shuffle: the largest order key with the
    payload of the largest digest, and the largest order key with the smallest digest. Two digests mean two states.
    """
    rows, payload, order, action = _state_rows(df, keys, fields, as_of, current, start, end, where)
    rank = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]  # NULL is the smallest part of a struct
    state = F.struct(*[F.col(c) for c in [*payload, *action]])
    mark = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in [*payload, *action]])
    marked = rows.select(F.struct(*rank).alias("_rank"), mark.alias("_mark"), state.alias("_state"))
    by = [F.col("_state")[k].alias(f"_k{i}") for i, k in enumerate(keys)]
    top = marked.groupBy(*by).agg(
        F.max_by(F.struct("_state", "_mark"), F.struct("_rank", "_mark")).alias("_top"),
        F.max_by("_mark", F.struct(F.col("_rank"), (-F.col("_mark").cast("decimal(20,0)")).alias("m"))).alias("_least"))
    return top.select(*[F.col("_top")["_state"][c].alias(c) for c in [*payload, *action]], (F.col("_top")["_mark"] != F.col("_least")).alias("ambiguous"))


def state_candidates(df: DataFrame, keys: Sequence[str], fields: Sequence[str], as_of: str,
                     current: bool = True, start: str = "start_dt", end: str = "end_dt",
                     where: Column | None = None) -> DataFrame:
    """Distinct payloads among the newest rows of each key; more than one means ambiguity.

    The rank limit cuts rows in each task before the shuffle; only newest rows are made distinct.
    """
    rows, payload, order, action = _state_rows(df, keys, fields, as_of, current, start, end, where)
    w = Window.partitionBy(*keys).orderBy(*_desc(order))
    newest = rows.withColumn("_rk", F.dense_rank().over(w)).filter("_rk = 1")
    return newest.select(*payload, *action).distinct()


def ambiguous_keys(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lazy report: keys with more than one newest payload."""
    return candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("states")).filter("states > 1")


def state_of(candidates: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Drop the entities whose newest state is a deletion."""
    return drop_deleted(candidates).select(*payload)


def read_state(df: DataFrame, keys: Sequence[str], fields: Sequence[str], as_of: str,
               current: bool = True, nullable_keys: Sequence[str] = (), check: bool = True,
               start: str = "start_dt", end: str = "end_dt", where: Column | None = None) -> DataFrame:
    """As-of state per key. ``current=False`` keeps the last state of closed events.

    With ``check`` an empty mandatory key or an ambiguous newest state stops the job that reads the
    result; the test is part of the same aggregate. Without it, all newest states of a key are kept.
    """
    payload = list(dict.fromkeys([*keys, *fields]))
    if not check:
        return state_of(state_candidates(df, keys, fields, as_of, current, start, end, where), payload)
    newest = newest_states(df, keys, fields, as_of, current, start, end, where)
    shown = F.to_json(F.struct(*[F.col(k) for k in keys]))
    empty = F.lit(False)
    for k in keys:
        if k not in nullable_keys:
            empty = empty | ~required(k)
    stop = lambda text: F.raise_error(F.concat(F.lit(text), shown)).cast("boolean")
    sound = F.when(empty, stop(f"empty mandatory key among {list(keys)}: ")).when(F.col("ambiguous"), stop("ambiguous newest state: ")).otherwise(True)
    return state_of(newest.filter(sound), payload)


def latest_by_priority(df: DataFrame, key: str, dates: Sequence[str], tie: str) -> DataFrame:
    """Newest row by the first known of several dates, then by id text."""
    moment = F.coalesce(*[F.col(d) for d in dates])
    return take_latest(df, [key], [moment.desc_nulls_last(), F.col(tie).cast("string").desc()])


def join_latest(left: DataFrame, right: DataFrame, on: str, order: Sequence[str | Column],
                fields: Sequence[str]) -> DataFrame:
    """Left join to the newest right row. Ranking comes first, so nothing fans out."""
    newest = take_latest(right.filter(F.col(on).isNotNull()), [on], order)
    return left.join(newest.select(on, *fields), on, "left")


def _tied_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.dense_rank().over(w)).filter("_rk = 1").drop("_rk")


def version_problems(versions: DataFrame, as_of: str, mode: str = "latest_created") -> DataFrame:
    """Rows that make "the newest version" undefined: no model, no date, a future date, a tie."""
    v = _in_production(versions) if mode == "latest_production" else versions
    created = F.col("model_ver_crtn_dttm")
    row_level = (
        F.when(F.col("model_sid").isNull(), "NO_MODEL")
        .when(created.isNull(), "NO_DATE")
        .when(created > as_of_end(as_of), "FUTURE_DATE")
    )
    bad = v.select("model_sid", "model_ver_sid", row_level.alias("problem")).filter("problem is not null")
    top = _tied_top(v.filter(created.isNotNull() & F.col("model_sid").isNotNull()), ["model_sid"], [created.desc()])
    tied = ambiguous_keys(top, ["model_sid"]).select(
        "model_sid", F.lit(None).cast("string").alias("model_ver_sid"), F.lit("TIED_DATE").alias("problem")
    )
    return bad.unionByName(tied)


def _in_production(versions: DataFrame) -> DataFrame:
    return versions.filter(truth("model_ver_prom_expl_flag"))


def select_versions(versions: DataFrame, as_of: str, mode: str, closed: str, check: bool = True) -> DataFrame:
    """The audited versions.

    ``latest_created`` and ``latest_production`` take the newest version of each model,
    ``current_all`` takes all. A closed newest version is left out, not replaced by an older one.
    """
    if mode not in ("latest_created", "current_all", "latest_production"):
        raise ValueError(f"unknown version mode {mode!r}")
    if mode == "current_all":
        return versions.filter(~F.upper(F.coalesce("model_ver_stts_name", F.lit(""))).rlike(closed))
    if check and version_problems(versions, as_of, mode).take(1):
        raise ValueError(f"{mode}: undated, future or tied versions; choose current_all")
    open_status = ~F.upper(F.coalesce("model_ver_stts_name", F.lit(""))).rlike(closed)
    if mode == "latest_production":
        pool = _in_production(versions.filter(open_status))
        return _tied_top(pool, ["model_sid"], [F.col("model_ver_crtn_dttm").desc()])
    return _tied_top(versions, ["model_sid"], [F.col("model_ver_crtn_dttm").desc()]).filter(open_status)


def latest_with_certainty(df: DataFrame, key: str, moment: str, dated: Column, name: str) -> DataFrame:
    """Flag the newest row, or NULL where undated rows or ties leave the order open.

    Moments with their rows are one aggregate with map-side combine; what is newest, how often it is tied
    and how many rows are undated follow from these. A hot key is neither sorted nor joined back in one task.
    """
    top = F.when(dated, F.col(moment))
    known = df.filter(F.col(key).isNotNull())
    moments = known.groupBy(key, top.alias("_top")).agg(F.count(F.lit(1)).alias("_n"))
    facts = moments.groupBy(key).agg(
        F.sum(F.when(F.col("_top").isNull(), F.col("_n")).otherwise(0)).alias("_undated"), F.max("_top").alias("_max"),
        F.max_by("_n", "_top").alias("_ties"), F.sum("_n").alias("_rows"))
    certain = (F.col("_undated") == 0) & (F.col("_ties") == 1)
    is_top = F.coalesce(dated & (F.col(moment) == F.col("_max")), F.lit(False))
    return spread_attach(known, facts, [key], "inner", rows="_rows").withColumn(name, F.when(certain, is_top)).drop("_undated", "_max", "_ties")


def pick_active(rows: DataFrame, key: str, flag: str, dates: Sequence[str]) -> DataFrame:
    """The newest in-production rows by several dates; full ties are kept for the caller."""
    return _tied_top(rows.filter(truth(flag)), [key], _desc(dates))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if duplicate_keys(df, keys).take(1):
        raise ValueError(f"duplicate key {list(keys)}")
    return df


def latest_display(df: DataFrame, keys: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Newest by whichever technical columns exist; without any, the smallest row per key."""
    order = [c for c in ("end_dt", "ctl_datechange", "start_dt", "ctl_loading") if c in df.columns]
    rest = [F.col(c).asc_nulls_last() for c in (tie or sorted(set(df.columns) - set(keys) - set(order)))]
    return take_latest(df, keys, [*_desc(order), *rest])

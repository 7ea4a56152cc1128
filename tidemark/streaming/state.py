"""Jobs that keep a small state per key in the state store.

The state of a user or order is a row of a table, and a few thousand tables hold them all, because a call of
Python for each key costs far more than the work on it.  The cost of a batch follows its rows and the tables that
it touches.  A restarted batch runs on the states of the batch before it, so its rows come out the same, and a sink
that publishes a batch once makes the whole exact.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .jobs import BatchSink, allocate_sink

# executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LANE, _ORDER, _NULLS = "_lane", "_order", "_nulls"


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def _whole(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.IntegralType)]


def _dense(df: DataFrame, columns: list[str]) -> DataFrame:
    """Whole numbers with 0 for a missing one and ``_nulls``, whose bits say which those are: pandas would turn a
    column with a missing number to floats, which do not hold ids above 2^53."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate(columns)]
    nulls = F.aggregate(F.array(*bits), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    zeros = {c: F.coalesce(c, F.lit(0).cast(df.schema[c].dataType)) for c in columns}
    return df.withColumn(_NULLS, nulls).withColumns(zeros)


def _sparse(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as they were before ``_dense``."""
    there = {c: F.col(_NULLS).bitwiseAND(F.lit(1 << k)) == 0 for k, c in enumerate(columns)}
    return df.withColumns({c: F.when(is_there, F.col(c)) for c, is_there in there.items()}).drop(_NULLS)


# ---- first order ------------------------------------------------------------------------------------


def _deal(lanes: int):
    """Lane 0 for the first order of every user in an Arrow batch, one of ``lanes`` more for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [("user_id", "ascending"), ("create_time", "ascending"), ("id", "ascending")]
            order = pc.sort_indices(pa.Table.from_batches([b]), sort_keys=keys).to_numpy()
            users = pc.dictionary_encode(b["user_id"], null_encoding="encode").indices.to_numpy()[order]
            first = np.ones(len(order), bool)
            first[1:] = users[1:] != users[:-1]
            lane = np.empty(len(order), np.int32)
            lane[order] = np.where(first, 0, 1 + np.arange(len(order)) % lanes)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lane)], [*b.schema.names, _LANE])

    return run


#: Groups of users that share a state table; a checkpoint is bound to it.  One more is for orders without a user.
USER_GROUPS = 4096
_USERS = "_users"


def _flag(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """"1" on the earliest order of every user of the group who is not in its table, "0" on all others."""
    extra = [_LANE, _USERS]
    if key[1]:
        for rows in frames:
            yield rows.drop(columns=extra).assign(if_first_order="0")
        return
    # one row per user and Arrow batch of this micro-batch
    rows = pd.concat(list(frames)).drop(columns=extra).sort_values(["create_time", "id"]).reset_index(drop=True)
    users, firsts = state.get if state.exists else ([], [])
    if key[0] < 0:  # no user; their orders count as those of one
        fresh = (rows.index == 0) & (not firsts)
    else:
        fresh = ~rows["user_id"].duplicated().to_numpy() & ~rows["user_id"].isin(users).to_numpy()
    if fresh.any():
        new = rows.loc[fresh]
        names = [None] if key[0] < 0 else new["user_id"].tolist()
        state.update(([*users, *names], [*firsts, *new["id"].tolist()]))
    yield rows.assign(if_first_order=np.where(fresh, "1", "0"))


def flag_first_orders(orders: DataFrame, lanes: int = 16, groups: int = USER_GROUPS) -> DataFrame:
    """orders (id, user_id, create_time, ...) as a stream with ``if_first_order``.

    The state of a user is the id of the first order, a row of the table of the user's group (a hash).  Only
    rows that may be a user's first meet it: the earliest per user of every Arrow batch.  All others are dealt
    over lanes x lanes keys without a state, so a user with very many orders does not fill one task.  Ties on
    create_time go to the smaller id; orders without a user count as those of one.
    """
    dealt = orders.mapInArrow(_deal(lanes), _with(orders.schema, _LANE, T.IntegerType()))
    mine = F.xxhash64("user_id")
    group = F.pmod(mine, F.when(F.col(_LANE) == 0, groups).otherwise(lanes)).cast("int")
    group = F.when(F.col("user_id").isNull(), F.lit(-1)).otherwise(group)
    kind, whole = orders.schema["user_id"].dataType.simpleString(), _whole(orders.schema)
    flagged = _dense(dealt.withColumn(_USERS, group), whole).groupBy(_USERS, _LANE).applyInPandasWithState(
        _flag,
        _with(_with(orders.schema, _NULLS, T.LongType()), "if_first_order", T.StringType()),
        f"users array<{kind}>, first_order_ids array<bigint>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return _sparse(flagged, whole)


# ---- allocation ---------------------------------------------------------------------------------------

#: Groups that share a state table.  A prime, so that ids with a common step spread over all of them; a
#: checkpoint is bound to it.
ORDER_GROUPS = 4093
_EXACT = 2.0**62


def _parts(detail: np.ndarray, original: np.ndarray, final: np.ndarray) -> np.ndarray:
    """final * detail / original, half a cent up; 0 for a zero total."""
    some = original != 0
    below = np.where(some, original, 1)
    large = some & (2.0 * np.abs(final.astype(float)) * np.abs(detail) + np.abs(original) >= _EXACT)
    with np.errstate(over="ignore"):
        parts = np.where(some, (2 * final * detail + below) // (2 * below), 0)
    for i in np.flatnonzero(large):
        f, d, o = int(final[i]), int(detail[i]), int(original[i])
        parts[i] = (2 * f * d + o) // (2 * o)
    return parts


def _before(values: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Sums of the values in front of each one, inside its group."""
    total = np.cumsum(values) - values
    return total - total[starts][group]


def share_out(
    rows: pd.DataFrame, held: np.ndarray, ttl: int, whole: list[str]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shares, which are known, new table) of lines sorted by order and then in line order.

    ``held`` is the table of the group, sorted by order: order, the sums of detail and given, the lines and
    the newest time of what came before.  Amounts are cents; the rest of an unknown amount is unknown.
    ``whole`` names the columns that ``_dense`` has filled.
    """
    ids = rows["order_id"].to_numpy().astype(np.int64)
    times = rows["detail_time"].to_numpy().astype("datetime64[ms]").astype(np.int64)
    amounts, nulls = ("detail_cents", "original_cents", "final_cents"), rows[_NULLS].to_numpy()
    detail, original, final = (rows[c].to_numpy().astype(np.int64) for c in amounts)
    d_there, o_there, f_there = (nulls & (1 << whole.index(c)) == 0 for c in amounts)
    orders, starts, group = np.unique(ids, return_index=True, return_inverse=True)
    known = d_there & o_there
    part = np.where(known & f_there, _parts(detail, original, final), 0)

    # what the orders carry; a line that comes later than ttl after the last one starts anew
    at = np.searchsorted(held[:, 0], orders)
    old = np.zeros((len(orders), 5), np.int64)
    old[:, 4] = np.iinfo(np.int64).min
    hit = at < len(held)
    hit[hit] = held[at[hit], 0] == orders[hit]
    old[hit] = held[at[hit]]
    first, last = np.minimum.reduceat(times, starts), np.maximum.reduceat(times, starts)
    anew = hit & (first > old[:, 4] + ttl)
    old[anew, 1:4] = 0

    before = _before(detail, starts, group) + old[group, 1]
    given = _before(part, starts, group) + old[group, 2]
    lines = np.arange(len(ids)) - starts[group] + old[group, 3]
    takes_rest = known & (before + detail == original) & ((detail > 0) | (lines == 0))
    shares = np.where(takes_rest, final - given, part)

    sums = [np.add.reduceat(detail, starts), np.add.reduceat(part, starts), np.bincount(group)]
    fresh = np.column_stack([orders, *[old[:, k + 1] + s for k, s in enumerate(sums)], np.maximum(old[:, 4], last)])
    others = held[~np.isin(held[:, 0], orders)]
    table = np.concatenate([others, fresh])
    return shares, f_there | ~takes_rest, table[np.argsort(table[:, 0])]


def allocate(
    wide: DataFrame, line_order: list[str], ttl_seconds: int = 600, groups: int = ORDER_GROUPS,
    table: str | None = None, emit: BatchSink | None = None, batch_id: int = 0, late: str = "0 seconds",
) -> DataFrame | None:
    """Paid amounts spread over order lines that arrive in any number of batches: adds ``share_cents``.

    With the path ``table`` and a sink ``emit`` for the shares, ``wide`` is a micro-batch that may be large, as
    ``jobs.join_order_streams`` hands it on; the states are rows of a keyed table there (``jobs.allocate_sink``) and
    ``late`` is the delay of the watermark.  Without them:

    ``wide`` is a stream with order_id, detail_cents, original_cents, final_cents and detail_time, which
    carries the watermark.  The lines of a batch count in ``line_order`` after those of earlier batches.
    The state of an order (sums and the newest time, 40 bytes) is dropped when the watermark is ``ttl_seconds``
    past it; a line that comes later than that starts anew.  Orders with the same remainder of their id by
    ``groups`` (the key of the state, called order_id too) share a table.  One group holds the lines of its orders
    in one micro-batch, which the source's limit on a batch bounds, and the states of those that are alive.
    """
    if table is not None:
        allocate_sink(table, emit, line_order, f"{ttl_seconds} seconds", late=late)(wide, batch_id)
        return None
    ttl, whole = ttl_seconds * 1000, [c for c in _whole(wide.schema) if c != "order_id"]

    def keep(state: GroupState, table: np.ndarray) -> None:
        if len(table):
            state.update((table.tobytes(),))
            state.setTimeoutTimestamp(max(int(table[:, 4].min()) + ttl, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = np.frombuffer(state.get[0], np.int64).reshape(-1, 5) if state.exists else np.zeros((0, 5), np.int64)
        alive = held[:, 4] + ttl >= state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            keep(state, held[alive])
            return
        parts = list(frames)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        rows = rows.drop(columns="order_id").rename(columns={_ORDER: "order_id"})
        rows = rows.sort_values(["order_id", *line_order])
        shares, known, table = share_out(rows, held, ttl, whole)
        gone = held[~alive & ~np.isin(held[:, 0], rows["order_id"].to_numpy()), 0]
        keep(state, table[~np.isin(table[:, 0], gone)])
        yield rows.assign(share_cents=pd.arrays.IntegerArray(shares, ~known))

    dealt = wide.withColumnRenamed("order_id", _ORDER).withColumn("order_id", F.pmod(_ORDER, F.lit(groups)))
    shares = _dense(dealt, whole).groupBy("order_id").applyInPandasWithState(
        run,
        _with(_with(wide.schema, _NULLS, T.LongType()), "share_cents", T.LongType()),
        "orders binary",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return _sparse(shares, whole)

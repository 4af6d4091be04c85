"""Sequential operators over very long series, without whole-series tasks.

A naive ``Window.partitionBy(key).orderBy(time)`` sends every row of a
series to one task.  If one device (key) holds a third of all rows, that
task holds a third of the job.  This module splits every series into
fixed-size row *blocks* and moves only small summaries between them:

1. :func:`with_position` gives each row its exact 0-based position in its
   series.  Rows are range-partitioned by key and order with sampled,
   balanced bounds and numbered inside their sorted partition; only the
   first series of a partition can continue an earlier one, so one number
   per partition completes the positions.
2. :func:`with_block` assigns ``block = pos div B`` and copies the last
   ``halo`` rows of every block into the next one, so frame-based window
   functions (lag, rolling std, …) can run per ``(key, block)``.
3. :func:`attach_series_agg` computes per-series aggregates with a plain
   ``groupBy`` (partial aggregation, hot-key safe) and brings them to the
   rows through a *block table* (one row per block), joined on
   ``(key, block)`` — the same partitioning the block windows use.
4. :func:`ewm_blocked` evaluates the recursive exponentially weighted mean
   exactly: each block reduces to an affine map ``y -> A*y + C``, the maps
   are composed in a tree of blocks, blocks of blocks, and so on, and each
   block is then replayed from its incoming state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import materialize

POS = "_pos"
BLK = "_blk"
HALO = "_halo"
CUT = "_cut"
DEFAULT_BLOCK = 8192
#: Rows up to which a task takes a series whole.
WHOLE = 1 << 16

_UNITS_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
             "week": 7 * 86_400_000_000}


def interval_us(spec) -> int:
    """'5 minutes' / '1 hour' / int microseconds -> microseconds."""
    if isinstance(spec, (int, np.integer)):
        return int(spec)
    n, unit = str(spec).strip().split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _UNITS_US[unit])


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def join_on(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on same-named columns, keeping one copy of each."""
    cols = list(cols)
    r = right
    for c in cols:
        r = r.withColumnRenamed(c, f"__r_{c}")
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r[f"__r_{c}"])
        cond = e if cond is None else cond & e
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{c}" for c in cols])


def _row_hash(df: DataFrame, skip: Sequence[str]) -> Column:
    """Hash of the columns not in ``skip``: orders rows that tie on them."""
    rest = [c for c, t in df.dtypes if c not in skip and "map<" not in t and "variant" not in t]
    return F.xxhash64(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0).cast("long")


class _Runs:
    """Where the values of some columns change, over a stream of batches."""

    def __init__(self, names: Sequence[str]):
        self.names, self.last = list(names), None

    def starts(self, batch: pa.RecordBatch) -> np.ndarray:
        """Whether each row of a batch with rows differs from the row before
        it, nulls being equal to nulls."""
        cols = [batch.column(n) for n in self.names]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= ~_equal(c.slice(1), c.slice(0, len(c) - 1))
        new[0] = self.last is None or self.last != repr([c[0].as_py() for c in cols])
        self.last = repr([c[len(c) - 1].as_py() for c in cols])
        return new


def whole_runs(batches, names: Sequence[str]):
    """Batches cut where the values of some columns change, so that no run
    of equal values is divided, with the marks where runs start.  Holds a
    batch and a run at most."""
    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0], np.concatenate(marks)

    runs, held, marks = _Runs(names), [], []
    for b in batches:
        if not b.num_rows:
            continue
        new = runs.starts(b)
        cut = int(np.flatnonzero(new)[-1]) if new.any() else None
        if cut:
            held.append(b.slice(0, cut))
            marks.append(new[:cut])
        if cut is not None and held:
            yield joined()
            held, marks = [], []
        held.append(b.slice(cut or 0))
        marks.append(new[cut or 0:])
    if held:
        yield joined()


def _equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    if pa.types.is_nested(a.type):
        return np.array([repr(x) == repr(y) for x, y in zip(a.to_pylist(), b.to_pylist())], bool)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return same.to_numpy(zero_copy_only=False)


def _number(keys: Sequence[str]):
    """Numbers the rows of every run of equal ``keys`` within a partition."""
    def run(batches):
        runs, count = _Runs(keys), 0
        for b in batches:
            if not b.num_rows:
                continue
            at = np.arange(b.num_rows)
            first = np.maximum.accumulate(np.where(runs.starts(b), at, -1))
            local = np.where(first >= 0, at - first, count + at)
            count = int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local, pa.int64())], [*b.schema.names, "_loc"])
    return run


def with_position(df: DataFrame, keys, order, *, name: str = POS, descending: bool = False, cut: str | None = None) -> DataFrame:
    """Add the exact 0-based row position within each series.

    ``order`` lists the ordering columns; rows that tie on all of them are
    ordered by a hash of the whole row.  Rows are range-partitioned by
    ``(keys, order, hash)``: the bounds come from a sample of the rows, so a
    series of any size, with any bursts, equal or null times, is cut into
    partitions of about equal row counts.  The sorted partitions are numbered
    series by series and written once (a checkpoint).  Only the first series
    of a partition can have begun in an earlier one; the rows it has there
    follow from the first and last series of every partition, one row each
    on the driver, and are added by a broadcast of one number per partition.
    Null orders come first (last when ``descending``).

    ``cut`` names a flag that is false where all rows of a series lie, in
    order, in one partition of the result and are ``WHOLE`` at most: such
    series need not be dealt again.  Where no series is longer, the few that
    lie across a bound of two partitions are brought together, and it is
    false for all.
    """
    keys, order = as_list(keys), as_list(order)
    o = [F.col(c) for c in order] + [_row_hash(df, [*keys, *order])]
    o = [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in o]
    by = [*[F.col(k).asc_nulls_first() for k in keys], *o]
    # the id holds the partition number in its upper bits, the row number in the lower 33
    d = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id())
    d = materialize(d.mapInArrow(_number(keys), T.StructType([*d.schema.fields, T.StructField("_loc", T.LongType())])))
    part, key = F.shiftright("_row", 33).cast("int"), F.struct(F.lit(0), *keys)
    begun = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("_loc")      # the row where the series starts in its partition
    ends = d.groupBy(part.alias("_part")).agg(F.min_by(key, "_row").alias("first"), F.max_by(key, "_row").alias("last"),
                                              (F.max_by("_loc", "_row") + 1).alias("n"), F.max(begun).alias("begun"),
                                              (F.max(F.when(begun == 0, F.col("_loc"))) + 1).alias("head"),
                                              (F.max("_loc") >= WHOLE).alias("long")).collect()
    ends = sorted(ends, key=lambda e: e["_part"])
    carry, before, n, longest = [], None, 0, 0
    for e, then in zip(ends, [*ends[1:], None]):
        first, last = repr(e["first"]), repr(e["last"])
        held = n if before == first else 0
        goes_on = then is not None and repr(then["first"]) == last
        if held or cut and (goes_on or e["long"]):
            carry.append((e["_part"], held, e["begun"] if goes_on else None, e["long"]))
        before, n = last, e["n"] + (held if first == last else 0)
        longest = max(longest, n, held + e["head"], WHOLE + 1 if e["long"] else 0)
    pos, flag = F.col("_loc"), F.lit(False)
    if carry:
        # at most a row per partition
        c = F.broadcast(df.sparkSession.createDataFrame(carry, "_part int, _carry long, _carry_on long, _carry_all boolean"))
        d = d.withColumn("_part", part).join(c, "_part", "left").drop("_part")
        pos = pos + F.when(begun == 0, F.coalesce("_carry", F.lit(0))).otherwise(F.lit(0))
        flag = F.coalesce(((begun == 0) & (F.col("_carry") > 0)) | (begun == F.col("_carry_on")) | F.col("_carry_all"), F.lit(False))
    d = d.withColumns({name: pos, **({cut: flag} if cut else {})}).drop("_row", "_loc", "_carry", "_carry_on", "_carry_all")
    if cut and carry and longest <= WHOLE:
        rest = d.filter(cut)
        rest = materialize((rest.repartition(*keys) if keys else rest.coalesce(1)).sortWithinPartitions(*keys, name))
        d = d.filter(~F.col(cut)).unionByName(rest).withColumn(cut, F.lit(False))
    return d


def rank_values(df: DataFrame, keys, value: str) -> DataFrame:
    """(keys, value, ``_rank``): the non-null values with their 0-based rank
    per series, by one range shuffle."""
    keys = as_list(keys)
    return with_position(df.select(*keys, value).filter(F.col(value).isNotNull()), keys, [value], name="_rank")


def percentiles_at(ranked: DataFrame, keys, value: str, qs: Sequence[float], names: Sequence[str],
                   *, n: str | None = None) -> DataFrame:
    """Percentiles of values that carry their ``_rank`` (a range of ranks per
    series, such as all values or those within two bounds), with linear
    interpolation between the two ranks around ``q * (n - 1)``; ``n`` names a
    column for the number of values."""
    keys = as_list(keys)
    size = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_rank").alias("_base"))
    at = [F.lit(float(q)) * (F.col("_n") - 1) for q in qs]
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(a), F.ceil(a)) for a in at])))
    need = size.select(*keys, "_n", "_base", F.explode(F.transform(wanted, lambda r: r + F.col("_base"))).alias("_rank"))
    got = join_on(need, ranked, [*keys, "_rank"])
    rank = F.col("_rank") - F.col("_base")
    g = got.groupBy(*keys).agg(*[
        F.max(F.when(rank == end(a), F.col(value))).alias(f"_{side}{i}")
        for i, a in enumerate(at) for side, end in (("lo", F.floor), ("hi", F.ceil))], F.max("_n").alias("_n"))
    out = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (a - F.floor(a))).cast("double").alias(x)
           for i, (a, x) in enumerate(zip(at, names))]
    return g.select(*keys, *out, *([F.col("_n").alias(n)] if n else []))


def percentiles_by_rank(df: DataFrame, keys, value: str, qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact percentiles per series with linear interpolation, one row per
    series (``keys`` empty: one row).  They are picked from the rows' ranks,
    so no task holds the values of a series.  Nulls are ignored; a series of
    nulls has no row, an empty table without keys gives one row of nulls.
    """
    return percentiles_at(rank_values(df, keys, value), keys, value, qs, names)


def with_block(df: DataFrame, halo: int = 0, block: int = DEFAULT_BLOCK, pos: str = POS) -> DataFrame:
    """Add ``_blk`` (= pos div block) and ``_halo``; with ``halo > 0`` the
    last ``halo`` rows of each block are duplicated into the next block with
    ``_halo = true``.  ``block`` is raised to 4*halo to bound duplication."""
    block = effective_block(block, halo)
    p = F.col(pos)
    if halo <= 0:
        return df.withColumn(BLK, F.floor(p / block)).withColumn(HALO, F.lit(False))
    shift = F.explode(F.when(p % block >= block - halo, F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0))))
    d = df.withColumn("_sh", shift)
    return (d.withColumn(BLK, F.floor(p / block) + F.col("_sh"))
             .withColumn(HALO, F.col("_sh") == 1).drop("_sh"))


def effective_block(block: int, halo: int) -> int:
    return max(int(block), 4 * int(halo), 1)


def block_window(keys) -> Window:
    return Window.partitionBy(*as_list(keys), BLK).orderBy(POS)


def block_arrays(d: DataFrame, keys, cols: Sequence[str], halo: int, *, block: int = DEFAULT_BLOCK) -> DataFrame:
    """One row (keys, ``_blk``, ``first``, ``own``, cols as arrays) per block
    of ``d`` (which carries ``_pos``): the values of the block in order after
    up to ``halo`` values of the rows before it.  ``first`` is the position
    of the first element and ``own`` the index of the block's first own one.
    One exchange, by block; no task holds more than a block and its halo."""
    keys, cols = as_list(keys), list(cols)
    b = with_block(d.select(*keys, POS, *cols), halo, block)
    g = b.groupBy(*keys, BLK).agg(F.sort_array(F.collect_list(F.struct(POS, *cols))).alias("_r"),
                                  F.count_if(HALO).alias("_halo_n"))
    g = g.filter(F.size("_r") > F.col("_halo_n"))
    return g.select(*keys, BLK, F.col("_r")[0][POS].alias("first"), F.col("_halo_n").cast("int").alias("own"),
                    *[F.col(f"_r.{c}").alias(c) for c in cols])


def rolling_std_rows(x: pa.Array, start: np.ndarray, wanted: np.ndarray, window: int, shift: int) -> pa.Array:
    """Sample standard deviation of the ``window`` values of a run that end
    ``shift`` rows back, for the ``wanted`` rows; null unless all of them are
    there and not null.

    A Spark frame that slides is summed anew for every row, value by value;
    here the frames of a batch are rows of an array.  Deviations are taken
    from the first value of a frame, then from their mean."""
    rows, value = np.arange(len(x)), x.to_numpy(zero_copy_only=False)
    known = np.concatenate([[0], np.cumsum(x.is_valid().to_numpy(zero_copy_only=False))])
    lo = rows - (shift + window - 1)
    ok = wanted & (window > 1) & (lo >= np.maximum.accumulate(np.where(start, rows, 0)))
    ok &= known[np.where(ok, lo + window, 0)] - known[np.where(ok, lo, 0)] == window
    res, need = np.zeros(len(x)), np.flatnonzero(ok)
    size = max(1, (1 << 17) // window)
    with np.errstate(invalid="ignore", over="ignore"):
        for at in (need[i:i + size] for i in range(0, len(need), size)):
            f = np.lib.stride_tricks.sliding_window_view(value, window)[lo[at]]
            f -= f[:, :1].copy()
            f -= f.mean(axis=1, keepdims=True)
            res[at] = np.sqrt(np.einsum("ij,ij->i", f, f) / (window - 1))
    return pa.array(res, pa.float64(), mask=~ok)


def rolling_std_runs(keys, col: str, window: int, shift: int):
    """Replaces ``col`` of whole blocks by :func:`rolling_std_rows`."""
    def run(batches):
        for b, start in whole_runs(batches, [*keys, BLK]):
            own = ~b.column(HALO).to_numpy(zero_copy_only=False)
            yield b.set_column(b.schema.get_field_index(col), col, rolling_std_rows(b.column(col), start, own, window, shift))
    return run


def series_windowed(df: DataFrame, keys, order, halo: int,
                    build: Callable[[Window], dict], *, block: int = DEFAULT_BLOCK,
                    keep_pos: bool = False, stats: dict | None = None, runs: Callable | None = None) -> DataFrame:
    """Evaluate frame-based window columns per series, block by block.

    ``build(w)`` returns ``{name: Column}`` using window ``w`` (ordered by
    position).  Frames may reach at most ``halo`` rows back.  ``stats``
    (``{name: aggregate Column}``) are per-series aggregates made available
    as columns before ``build`` runs.  ``runs`` then maps Arrow batches with
    whole blocks one after another, in order and with their halos.
    """
    keys = as_list(keys)
    d0 = df if POS in df.columns else with_position(df, keys, order)
    d = with_block(d0, halo, block)
    if stats:
        # aggregate the positioned rows (read from the checkpoint), not the raw input
        d = attach_series_agg(d, d0, keys, stats, block=effective_block(block, halo))
    if runs:
        d = d.repartition(*keys, BLK)
    d = d.withColumns(build(block_window(keys)))
    if runs:
        d = d.sortWithinPartitions(*keys, BLK, POS).mapInArrow(runs, d.schema)
    d = d.filter(~F.col(HALO)).drop(HALO, BLK)
    return d if keep_pos else d.drop(POS)


def attach_series_agg(blocked: DataFrame, source: DataFrame, keys, aggs: dict,
                      *, block: int) -> DataFrame:
    """Join per-series aggregates of ``source`` to ``blocked`` rows.

    The aggregate is a ``groupBy(keys)`` (partial aggregation absorbs hot
    keys).  It is expanded into one row per block and joined on
    ``(keys, _blk)``, so a hot series is spread over its blocks instead of
    landing in a single join task.
    """
    keys = as_list(keys)
    stats = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_all"),
                                      *[c.alias(n) for n, c in aggs.items()])
    last_blk = F.floor((F.col("_n_all") - 1) / block) + 1  # +1: halo-only tail block
    bt = stats.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), last_blk.cast("long"))).alias(BLK),
                      *aggs.keys())
    return join_on(blocked, bt, [*keys, BLK])


# --------------------------------------------------------------------------
# exact recursive EWM (pandas ``ewm(span, adjust=False)`` semantics)
# --------------------------------------------------------------------------

def _ewm_params(span: float):
    alpha = 2.0 / (float(span) + 1.0)
    return alpha, 1.0 - alpha


def _gap_cap(beta: float) -> int:
    """Rows after which ``beta**g`` underflows to 0 (the old mean is gone)."""
    if beta <= 0:
        return 1
    return int(np.ceil(760.0 / -np.log(beta))) + 1 if beta < 1 else 1 << 30


def _ewm_runs(pos: np.ndarray, x: np.ndarray, start: np.ndarray, alpha: float, cap: int) -> np.ndarray:
    """pandas ``ewm(alpha, adjust=False)`` of every run of rows (``start``
    marks their first rows), where rows between two positions are missing."""
    if not len(x):
        return np.empty(0)
    step = np.where(start[1:], 1, np.minimum(np.diff(pos), cap))        # beyond the cap the old weight is exactly 0
    at = np.concatenate([[0], np.cumsum(step)])
    arr, run = x, np.cumsum(start)
    if at[-1] + 1 > len(x):
        arr = np.full(int(at[-1]) + 1, np.nan)
        arr[at] = x
        run = np.repeat(run, np.append(step, 1))
    if run[0] == run[-1]:
        return pd.Series(arr).ewm(alpha=alpha, adjust=False).mean().to_numpy()[at]
    return pd.Series(arr).groupby(run).ewm(alpha=alpha, adjust=False).mean().to_numpy()[at]


def _ewm_run(first_pos: int, first_val: float, pos: np.ndarray, x: np.ndarray, alpha: float,
             cap: int) -> np.ndarray:
    """:func:`_ewm_runs` of one run that begins with a virtual observation
    ``first_val`` at ``first_pos``; the means at ``pos``."""
    return _ewm_runs(np.append(first_pos, pos), np.append(first_val, x), np.arange(len(x) + 1) == 0, alpha, cap)[1:]


#: Children of a node in the tree of block maps.
FAN = 256
_MAP = "struct<fp:bigint,fv:double,lp:bigint,a:double,c:double>"
_STATE = "struct<y:double,p:bigint>"


def _map_rows(keys, x: str, alpha: float, beta: float, cap: int):
    """One map per run of rows of a (series, block) in a sorted partition:
    first/last observation and the affine map of the observations after the
    first one (``y_end = A * y_first + C``).  At most a batch and a block are
    held; the maps of their runs are computed together."""
    names, m = [*keys, BLK], ["fp", "fv", "lp", "a", "c"]

    def run(batches):
        for b, start in whole_runs(batches, names):
            pos = b.column(POS).to_numpy(zero_copy_only=False)
            val = b.column(x).cast(pa.float64()).to_numpy(zero_copy_only=False)
            first, of = np.flatnonzero(start), np.cumsum(start) - 1
            obs = np.flatnonzero(~np.isnan(val))
            p, v, of = pos[obs], val[obs], of[obs]
            head = np.append(True, of[1:] != of[:-1])[:len(of)]
            i, has = np.flatnonzero(head), of[head]         # of runs with observations
            j = np.append(i[1:], len(of))[:len(i)] - 1
            w = np.power(beta, np.minimum(np.diff(p, prepend=0), cap).clip(0).astype(float))
            maps = [np.zeros(len(first), np.int64), np.zeros(len(first)), np.zeros(len(first), np.int64), np.ones(len(first)), np.zeros(len(first))]
            if len(i):
                factors = np.multiply.reduceat(np.where(head, 1.0, w / (w + alpha)), i)
                ends = _ewm_runs(p, np.where(head, 0.0, v), head, alpha, cap)[j]
                for out, got in zip(maps, (p[i], v[i], p[j], factors, ends)):
                    out[has] = got
            none = np.ones(len(first), bool)
            none[has] = False
            maps = [pa.array(c, mask=none if n in ("fp", "fv", "lp") else None) for n, c in zip(m, maps)]
            yield pa.RecordBatch.from_arrays([*[b.column(n).take(pa.array(first)) for n in names], pa.array(pos[first], pa.int64()),
                                              pa.StructArray.from_arrays(maps, m)], [*names, "_at", "m"])
    return run


def _meet(last: Column, then: Column, beta: float, alpha: float, cap: int) -> tuple[Column, Column]:
    """Weights of the old mean and of the next observation where they meet."""
    w = F.pow(F.lit(beta), F.least(then - last, F.lit(cap)).cast("double"))
    return w / (w + alpha), F.lit(alpha) / (w + alpha)


def _ewm_tree(maps: DataFrame, keys, alpha: float, beta: float, cap: int, fan: int) -> DataFrame:
    """(keys, block, _Y, _pnn): the mean entering every block and the position
    of the last observation before it, null where there is none.

    The maps of ``fan`` neighbours compose into one map of their parent, level
    by level until every series has one node; then the entering states go
    down the same tree.  No group holds more than ``fan`` rows.
    """
    def then(l: Column, r: Column) -> Column:
        old, new = _meet(l["lp"], r["fp"], beta, alpha, cap)
        both = F.struct(l["fp"].alias("fp"), l["fv"].alias("fv"), r["lp"].alias("lp"), (r["a"] * old * l["a"]).alias("a"),
                        (r["a"] * (old * l["c"] + new * r["fv"]) + r["c"]).alias("c"))
        return F.when(l["fp"].isNull(), r).when(r["fp"].isNull(), l).otherwise(both).cast(_MAP)

    def after(s: Column, m: Column) -> Column:
        old, new = _meet(s["p"], m["fp"], beta, alpha, cap)
        first = F.struct((m["a"] * m["fv"] + m["c"]).alias("y"), m["lp"].alias("p"))
        more = F.struct((m["a"] * (old * s["y"] + new * m["fv"]) + m["c"]).alias("y"), m["lp"].alias("p"))
        return F.when(m["fp"].isNull(), s).when(s["p"].isNull(), first).otherwise(more).cast(_STATE)

    nothing = F.struct(F.lit(None).alias("fp"), F.lit(None).alias("fv"), F.lit(None).alias("lp"), F.lit(1.0).alias("a"),
                       F.lit(0.0).alias("c")).cast(_MAP)
    unknown = F.struct(F.lit(None).alias("y"), F.lit(None).alias("p")).cast(_STATE)

    def joined(d: DataFrame, at: str, node: Column) -> DataFrame:
        g = d.groupBy(*keys, node.alias("_node")).agg(F.sort_array(F.collect_list(F.struct(at, "m"))).alias("ms"))
        return g.select(*keys, "_node", F.aggregate("ms", nothing, lambda acc, x: then(acc, x["m"])).alias("m"))

    levels = [materialize(joined(maps, "_at", F.col(BLK)))]
    top = levels[0].agg(F.max("_node")).first()[0] or 0
    parent = F.floor(F.col("_node") / fan)
    while top > 0:
        levels.append(materialize(joined(levels[-1], "_node", parent)))
        top //= fan
    state = levels[-1].select(*keys, "_node", unknown.alias("s"))
    for level in levels[-2::-1]:
        g = level.groupBy(*keys, parent.alias("_parent")).agg(F.sort_array(F.collect_list(F.struct("_node", "m"))).alias("ms"))
        g = join_on(g, state.withColumnRenamed("_node", "_parent"), [*keys, "_parent"])
        row = "array<struct<node:bigint,s:struct<y:double,p:bigint>>>"
        start = F.struct(F.col("s").alias("s"), F.array().cast(row).alias("out"))
        steps = F.aggregate("ms", start, lambda acc, x: F.struct(
            after(acc["s"], x["m"]).alias("s"),
            F.array_append(acc["out"], F.struct(x["_node"].alias("node"), acc["s"].alias("s"))).cast(row).alias("out")))
        state = g.select(*keys, F.explode(steps["out"]).alias("o")).select(*keys, F.col("o.node").alias("_node"), F.col("o.s").alias("s"))
    return state.select(*keys, F.col("_node").alias(BLK), F.col("s.y").alias("_Y"), F.col("s.p").alias("_pnn"))


def ewm_entering(d: DataFrame, keys, x: str, span: float, *, block: int = DEFAULT_BLOCK, fan: int = FAN) -> DataFrame:
    """(keys, ``_blk``, ``_Y``, ``_pnn``): the mean that enters a block and
    the position of the last observation before it, for the blocks that have
    one (not the first of a series).  ``d`` is as in :func:`ewm_blocked`."""
    keys = as_list(keys)
    alpha, beta = _ewm_params(span)
    cap = _gap_cap(beta)
    kinds = T.StructType([*[d.schema[k] for k in keys], *T.StructType.fromDDL(f"{BLK} long, _at long, m {_MAP}").fields])
    rows = d.select(*keys, F.floor(F.col(POS) / block).alias(BLK), POS, x).sortWithinPartitions(*keys, POS)
    maps = rows.mapInArrow(_map_rows(keys, x, alpha, beta, cap), kinds)
    return _ewm_tree(maps, keys, alpha, beta, cap, fan).filter("_pnn IS NOT NULL")


def ewm_and_std(d: DataFrame, keys, x: str, window: int, shift: int, ema: str, std: str | None, *,
                block: int = DEFAULT_BLOCK, fan: int = FAN, build: Callable[[Window], dict] | None = None,
                far: tuple[float, float] | None = None) -> DataFrame:
    """Exponentially weighted mean (span ``window``) of the values of ``x``
    ``shift`` rows back as ``ema`` and, unless ``std`` is None, the sample
    deviation of the ``window`` values that end there as ``std``; ``d`` is as
    in :func:`ewm_blocked`.  ``build`` adds window columns that reach no
    farther back.

    The mean at a row is that of the rows moved ``shift`` positions on, so the
    states that enter blocks come from ``d`` itself.  Blocks with their halos
    and, as a row before them, their states are dealt once; one pass does
    the rest.  Where ``d`` tells (``_cut``) that all rows of a series are in
    one partition, they are one block and stay there.  ``far`` (``k`` and a
    floor of deviations as a share of the value) leaves out rows that lie well
    within ``k`` deviations."""
    keys = as_list(keys)
    whole = None
    if CUT in d.columns:
        if not build:
            whole = d.filter(~F.col(CUT)).drop(CUT).withColumns({BLK: F.lit(0).cast("long"), HALO: F.lit(False), "_Y": F.lit(None).cast("double"),
                                                                 "_pnn": F.lit(None).cast("long")})
            d = d.filter(CUT)
        d = d.drop(CUT)
    halo = shift + window - 1
    block = effective_block(block, halo)
    alpha, beta = _ewm_params(window)
    cap = _gap_cap(beta)
    moved = d.select(*keys, (F.col(POS) + shift).alias(POS), x)
    b = with_block(d, halo, block).withColumns({"_Y": F.lit(None).cast("double"), "_pnn": F.lit(None).cast("long")})
    if (moved.agg(F.max(POS)).first()[0] or 0) >= block:        # otherwise no block has one before it
        carry = ewm_entering(moved, keys, x, window, block=block, fan=fan)
        carry = carry.withColumns({POS: F.lit(-1).cast("long"), HALO: F.lit(False)})
        b = b.unionByName(carry, allowMissingColumns=True)
    b = b.repartition(*keys, BLK)
    if build:
        b = b.withColumns(build(block_window(keys)))
    fields = [f for f in b.schema.fields if f.name not in (BLK, HALO, "_Y", "_pnn")]
    known = {f.name: f for f in d.schema.fields}        # rows of states are left out again, and with them nulls
    names = [f.name for f in fields]
    kinds = T.StructType([*[known.get(f.name, f) for f in fields], T.StructField(ema, T.DoubleType()),
                          *([T.StructField(std, T.DoubleType())] if std else [])])

    def run(batches):
        for b, start in whole_runs(batches, [*keys, BLK]):
            n, rows = b.num_rows, np.arange(b.num_rows)
            val = b.column(x).cast(pa.float64())
            state = b.column("_pnn").is_valid().to_numpy(zero_copy_only=False)
            own = ~b.column(HALO).to_numpy(zero_copy_only=False) & ~state
            first = np.maximum.accumulate(np.where(start, rows, 0))
            back, v = rows - shift, val.to_numpy(zero_copy_only=False)
            # a state is the first row of its run: its value is none of the series
            seen = back >= first + state[first]
            v = np.where(state, b.column("_Y").to_numpy(zero_copy_only=False), np.where(seen, v[np.maximum(back, 0)], np.nan))
            pos = np.where(state, b.column("_pnn").to_numpy(zero_copy_only=False), b.column(POS).to_numpy(zero_copy_only=False))
            use = np.flatnonzero(own | state)
            mean = np.full(n, np.nan)
            mean[use] = _ewm_runs(pos[use].astype(np.int64), v[use], np.append(True, np.diff(first[use]) > 0)[:len(use)], alpha, cap)
            cols = [*[b.column(c) for c in names], pa.array(mean, pa.float64(), from_pandas=True)]
            if std:
                dev = rolling_std_rows(val, start, own, window, shift)
                cols.append(dev)
                if far:
                    this = val.to_numpy(zero_copy_only=False)
                    floor = far[1] * np.abs(this)
                    spread = np.where(dev.is_null().to_numpy(zero_copy_only=False), floor, np.maximum(dev.to_numpy(zero_copy_only=False), floor))
                    with np.errstate(invalid="ignore"):
                        own &= ~(np.abs(this - mean) < far[0] * spread * (1 - 1e-9))
            yield pa.RecordBatch.from_arrays(cols, kinds.names).filter(pa.array(own))

    got = b.sortWithinPartitions(*keys, BLK, POS).mapInArrow(run, kinds)
    return got if whole is None else got.unionByName(whole.mapInArrow(run, kinds))


def ewm_blocked(d: DataFrame, keys, x: str, span: float, out: str, *,
                block: int = DEFAULT_BLOCK, fan: int = FAN) -> DataFrame:
    """Exponentially weighted mean of ``x`` in position order.

    ``d`` must carry ``_pos``, and its partitions must not share rows of a
    block except at a cut (as the results of :func:`with_position` and of
    windows per block do).  Matches pandas ``ewm(span, adjust=False)`` with
    ``ignore_na=False``: a gap of ``g`` rows weights the old mean by
    ``(1-a)^g``, null rows repeat the last mean, leading nulls stay null.

    Three passes: (1) every block reduces to its first/last observation and
    an affine map, without a shuffle; (2) the maps go up and the entering
    states down a tree over the block table (:func:`_ewm_tree`); (3) every
    block replays ``pandas.ewm`` from its entering state, which comes as a row
    at the position of the last observation before the block: the rows are
    dealt by block once and not joined, and the first block of a series, with
    nothing before it, needs no such row.
    """
    keys = as_list(keys)
    alpha, beta = _ewm_params(span)
    cap = _gap_cap(beta)
    carry = ewm_entering(d, keys, x, span, block=block, fan=fan).select(*keys, BLK, F.col("_pnn").alias(POS), "_Y")
    d = d.withColumn(BLK, F.floor(F.col(POS) / block))
    names = [f.name for f in d.schema.fields if f.name not in (BLK, out)]
    kinds = T.StructType([*[d.schema[n] for n in names], T.StructField(out, T.DoubleType())])

    def replay(batches):
        for b, start in whole_runs(batches, [*keys, BLK]):
            state = b.column("_Y")
            own = state.is_null()
            val = np.where(own.to_numpy(zero_copy_only=False), b.column(x).cast(pa.float64()).to_numpy(zero_copy_only=False),
                           state.to_numpy(zero_copy_only=False))
            res = _ewm_runs(b.column(POS).to_numpy(zero_copy_only=False), val, start, alpha, cap)
            got = pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(res, pa.float64(), from_pandas=True)], [*names, out])
            yield got.filter(own)

    dealt = d.withColumn("_Y", F.lit(None).cast("double")).unionByName(carry, allowMissingColumns=True).repartition(*keys, BLK)
    return dealt.sortWithinPartitions(*keys, BLK, POS).mapInArrow(replay, kinds)


def fill_blocked(d: DataFrame, keys, cols: Sequence[str], before: Sequence[str] = (), after: Sequence[str] = (),
                 *, block: int = DEFAULT_BLOCK, fan: int = 4096) -> DataFrame:
    """Last non-null value of ``cols`` at or before each row, as ``before``,
    and the next one at or after it, as ``after`` (``d`` carries ``_pos``;
    either list may be empty).

    Inside a block a running window does the work; the value entering a
    block from either side comes from the block table (first and last
    non-null of every block), and what enters ``fan`` blocks from a table of
    those, so no task holds more than one block, or ``fan`` rows of the block
    table, of a series.
    """
    keys, cols = as_list(keys), list(cols)
    d = d.withColumn(BLK, F.floor(F.col(POS) / block))
    some = [F.when(F.col(c).isNotNull(), F.col(POS)) for c in cols]
    bt = d.groupBy(*keys, BLK).agg(*[F.max_by(F.col(c), p).alias(f"_l{i}") for i, (c, p) in enumerate(zip(cols, some))],
                                   *[F.min_by(F.col(c), p).alias(f"_f{i}") for i, (c, p) in enumerate(zip(cols, some))])
    bt = bt.withColumn("_top", F.floor(F.col(BLK) / fan))

    def entering(t: DataFrame, within: list, at: str, first: str, last: str) -> dict:
        """Values that enter the rows of ``t`` from either side."""
        w = Window.partitionBy(*within).orderBy(at)
        past, future = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
        return ({f"{last}{i}": F.last(f"_l{i}", ignorenulls=True).over(past) for i, _ in enumerate(before)}
                | {f"{first}{i}": F.first(f"_f{i}", ignorenulls=True).over(future) for i, _ in enumerate(after)})

    known = lambda c: F.when(F.col(c).isNotNull(), F.col(BLK))
    top = bt.groupBy(*keys, "_top").agg(*[F.max_by(f"_l{i}", known(f"_l{i}")).alias(f"_l{i}") for i, _ in enumerate(cols)],
                                        *[F.min_by(f"_f{i}", known(f"_f{i}")).alias(f"_f{i}") for i, _ in enumerate(cols)])
    far = entering(top, keys, "_top", "_g", "_h")
    top = top.select(*keys, "_top", *[c.alias(n) for n, c in far.items()])
    near = entering(bt, [*keys, "_top"], BLK, "_d", "_c")
    bt = join_on(bt.withColumns(near), top, [*keys, "_top"])
    bt = bt.select(*keys, BLK, *[F.coalesce(f"_c{i}", f"_h{i}").alias(f"_c{i}") for i, _ in enumerate(before)],
                   *[F.coalesce(f"_d{i}", f"_g{i}").alias(f"_d{i}") for i, _ in enumerate(after)])
    d = join_on(d, bt, [*keys, BLK])
    w = Window.partitionBy(*keys, BLK).orderBy(POS)
    past, future = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    new = {o: F.coalesce(F.last(c, ignorenulls=True).over(past), F.col(f"_c{i}")) for i, (c, o) in enumerate(zip(cols, before))}
    new |= {o: F.coalesce(F.first(c, ignorenulls=True).over(future), F.col(f"_d{i}")) for i, (c, o) in enumerate(zip(cols, after))}
    return d.withColumns(new).drop(BLK, *[f"_c{i}" for i, _ in enumerate(before)], *[f"_d{i}" for i, _ in enumerate(after)])


def ffill_blocked(d: DataFrame, keys, cols: Sequence[str], outs: Sequence[str] | None = None,
                  *, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Last non-null value at or before each row (``d`` carries ``_pos``)."""
    return fill_blocked(d, keys, cols, before=list(outs or cols), block=block)

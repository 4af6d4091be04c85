"""Gaussian kernel density novelty detector, without pairwise joins.

Density of a point ``x`` under training values ``x_i`` (bandwidth ``h``)::

    f(x) = 1 / (n h sqrt(2 pi)) * sum_i exp(-((x - x_i) / h)^2 / 2)

Evaluating that for every training point is quadratic per series and a
self join would emit every pair.  Instead values are put on a grid of
*boxes* one bandwidth wide (a fast Gauss transform).  With ``c`` a box
centre, ``t = x/h - c`` and ``s_i = x_i/h - c``::

    exp(-(t - s_i)^2 / 2) = exp(-t^2/2) * sum_k t^k / k! * s_i^k exp(-s_i^2/2)

so a box needs only the moments ``N_k = sum_i s_i^k exp(-s_i^2/2)`` of the
sources within ``cutoff`` bandwidths.  Sources add moments to their own box
only, a map-side combined aggregate of one row per (series, box, task).  The
moments of a box are then translated to the centres of its neighbours: with
``s = u + d``, ``d`` the distance of the centres,

    (u + d)^k exp(-(u + d)^2/2) = exp(-d^2/2) exp(-u^2/2) * (u + d)^k * sum_j (-d u)^j / j!

is a fixed matrix per ``d`` times the box's own moments.  Boxes meet their
neighbours in *strips* of adjacent boxes of a series: a box is sent to its
strip, and to the next one when that is within reach, and each strip sums
the translated moments of those of its boxes that hold a point to be judged.
A point joins exactly one box row and evaluates a Horner polynomial.

Moments take the room of ``terms`` values, so where boxes hold about one value
each, sending them costs many times what the values do.  The detector
therefore sends only rows: series of up to ``WHOLE`` rows are dealt whole, and
one pass finds their bounds, boxes and densities.  Longer ones go through
strips, and none is held by one task.

Errors: a kernel term beyond ``cutoff`` bandwidths, which is left out, is
below ``exp(-cutoff^2/2)`` (3e-18 for 9); with ``K = terms`` the remainder of
the series is below ``exp(-K/2) (K/4)^(K/2) / K!`` per source (2e-20 for 24).
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import directional_flag
from tidewatch.operators import sequence
from tidewatch.operators.sequence import CUT, POS, as_list, join_on, percentiles_at, rank_values, whole_runs, with_position
from tidewatch.operators.stats import attach_by_key, series_percentiles
from tidewatch.session import materialize

TERMS = 24
CUTOFF = 9.0
TIE_TOLERANCE = 1e-9
#: Boxes of a strip.
STRIP = 256
_BATCH = 256


def _box(z: Column) -> Column:
    return F.floor(z).cast("long")


def translation(d: float, terms: int) -> np.ndarray:
    """Matrix that turns the moments about a box centre into those about a
    centre at distance ``-d``."""
    m = np.zeros((terms, terms))
    for k in range(terms):
        for j in range(terms):
            m[k, j] = sum(math.comb(k, i) * d ** (k - i) * (-d) ** (j - i) / math.factorial(j - i)
                          for i in range(min(j, k) + 1))
    return m * math.exp(-d * d / 2)


class _Strips:
    """Moments of the boxes of some strips (rows of a batch, sorted by strip
    and box, with moments in the rows of sources and nulls in others)."""

    def __init__(self, batch: pa.RecordBatch, starts: np.ndarray, terms: int, reach: int):
        self.reach, self.width = reach, STRIP + 2 * reach
        self.matrices = _matrices(terms, reach)
        names = [f"_m{k}" for k in range(terms)]
        self.strip = batch.column("_strip").fill_null(0).to_numpy()
        self.group = np.cumsum(starts)
        source = batch.column("_m0").is_valid().to_numpy(zero_copy_only=False)
        self.others = np.flatnonzero(~source)
        rows = np.flatnonzero(source)
        box = batch.column("_box").fill_null(0).to_numpy()
        self.codes = self.code(rows, box[rows])
        order = np.argsort(self.codes, kind="stable")
        self.codes = self.codes[order]
        self.own = np.stack([batch.column(n).to_numpy(zero_copy_only=False)[rows[order]] for n in names], axis=1)

    def code(self, rows: np.ndarray, box: np.ndarray) -> np.ndarray:
        """One number per (strip, box); those of a strip and its surroundings are adjacent."""
        return self.group[rows] * self.width + (box - self.strip[rows] * STRIP) + self.reach

    def around(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Moments about the centres of boxes, and which have any source."""
        return _summed(self.codes, self.own, codes, self.matrices, self.reach)


def _summed(codes: np.ndarray, own: np.ndarray, wanted: np.ndarray, matrices: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Moments about the centres of the ``wanted`` boxes, from the ``own``
    ones of the boxes with sorted ``codes``, and which have any source."""
    total, met = np.zeros((len(wanted), own.shape[1])), np.zeros(len(wanted), bool)
    if len(codes):
        for o in range(-reach, reach + 1):
            at = np.minimum(np.searchsorted(codes, wanted + o), len(codes) - 1)
            ok = codes[at] == wanted + o
            total[ok] += own[at[ok]] @ matrices[reach - o]
            met |= ok
    return total, met


@functools.cache
def _matrices(terms: int, reach: int) -> np.ndarray:
    return np.stack([translation(float(-o), terms).T for o in range(-reach, reach + 1)])


def _lend(keys, terms: int, reach: int):
    """Summed moments of the boxes without moments of their own, a row each."""
    def run(batches):
        for b, starts in whole_runs(batches, [*keys, "_strip"]):
            s = _Strips(b, starts, terms, reach)
            total, met = s.around(s.code(s.others, b.column("_box").to_numpy(zero_copy_only=False)[s.others].astype(np.int64)))
            at = pa.array(s.others[met])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k).take(at) for k in keys], b.column("_box").take(at), *[pa.array(c) for c in total[met].T]],
                [*keys, "_box", *[f"_m{k}" for k in range(terms)]])
    return run


def _draw(keys, h: float, points: int, terms: int, reach: int):
    """The points of a curve that lie in a strip, with their density."""
    def run(batches):
        for b, starts in whole_runs(batches, [*keys, "_strip"]):
            s = _Strips(b, starts, terms, reach)
            lo, hi, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_lo", "_hi", "_ntrain"))
            void = b.column("_strip").is_null().to_numpy(zero_copy_only=False)
            for i in range(0, len(s.others), _BATCH):
                rows = s.others[i:i + _BATCH]
                with np.errstate(invalid="ignore"):
                    x = lo[rows, None] + np.arange(points) * ((hi[rows] - lo[rows]) / (points - 1))[:, None]
                x[:, -1] = hi[rows]
                z = x / h
                box = np.floor(np.nan_to_num(z, nan=0.0)).astype(np.int64)
                at, col = np.nonzero(void[rows, None] | (box // STRIP == s.strip[rows, None]))
                x, z, box, rows = x[at, col], z[at, col], box[at, col], rows[at]
                codes, of = np.unique(s.code(rows, box), return_inverse=True)
                m, met = s.around(codes)
                t = z - (box + 0.5)
                acc = m[of, terms - 1]
                for k in range(terms - 2, -1, -1):
                    acc = m[of, k] + (t / (k + 1)) * acc
                with np.errstate(invalid="ignore", divide="ignore"):
                    dens = np.exp(-0.5 * t * t) * acc / (n[rows] * (h * math.sqrt(2 * math.pi)))
                dens = np.where(met[of], dens, 0.0)
                where = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k).take(where) for k in keys], pa.array(col, pa.int32()),
                     pa.array(x, mask=void[rows]), pa.array(dens, mask=void[rows])], [*keys, "i", "x", "density"])
    return run


def _own_moments(d: DataFrame, keys, terms: int, reach: int) -> DataFrame:
    """Moments of the boxes of ``d`` (keys, ``_z``, ``_box``), a row per
    strip that they are in reach of."""
    u = F.col("_z") - (F.col("_box") + 0.5)
    d = d.select(*keys, "_box", u.alias("_u"), F.exp(-0.5 * u * u).alias("_g"))
    # powers, not running products: those nest, and make code too long to be compiled
    own = d.groupBy(*keys, "_box").agg(*[F.sum(F.col("_g") * F.pow("_u", F.lit(k))).alias(f"_m{k}") for k in range(terms)])
    return own.withColumn("_strip", F.explode(F.sequence(_strip(F.col("_box") - reach), _strip(F.col("_box") + reach))))


def _strip(box: Column) -> Column:
    return F.floor(box / F.lit(STRIP)).cast("long")


def _boxed(d: DataFrame, keys, value: str, h: float) -> DataFrame:
    z = F.col(value) / F.lit(float(h))
    return d.select(*keys, z.alias("_z")).filter(F.col("_z").isNotNull()).withColumn("_box", _box(F.col("_z")))


def _by_strip(own: DataFrame, others: DataFrame, keys) -> DataFrame:
    d = own.unionByName(others, allowMissingColumns=True)
    return d.repartition(*keys, "_strip").sortWithinPartitions(*keys, "_strip")


def box_moments(train: DataFrame, keys, value: str, bandwidth: float, *, points: DataFrame | None = None,
                cutoff: float = CUTOFF, terms: int = TERMS) -> DataFrame:
    """(keys, _box, _m0.._m{terms - 1}): kernel moments of the training
    values around the centre of every box that holds a value of ``points``
    (default: a training value) and is within reach of one."""
    keys, reach = as_list(keys), math.ceil(cutoff + 0.5)
    own = _own_moments(_boxed(train, keys, value, bandwidth), keys, terms, reach)
    wanted = _boxed(train if points is None else points, keys, value, bandwidth).select(*keys, "_box").distinct()
    both = _by_strip(own, wanted.withColumn("_strip", _strip(F.col("_box"))), keys)
    return both.mapInArrow(_lend(keys, terms, reach), T.StructType(
        [*[both.schema[k] for k in keys], both.schema["_box"], *[both.schema[f"_m{k}"] for k in range(terms)]]))


def _horner(t: Column, terms: int) -> Column:
    acc = F.col(f"_m{terms - 1}")
    for k in range(terms - 2, -1, -1):
        acc = F.col(f"_m{k}") + (t / (k + 1)) * acc
    return acc


def _quantile(x: np.ndarray, start: np.ndarray, n: np.ndarray, q: float) -> np.ndarray:
    """Quantile of every run of sorted values, with linear interpolation;
    ``start`` and ``n`` tell where runs start and what they hold."""
    res, has = np.full(len(n), np.nan), n > 0
    at, first = q * (n[has] - 1), start[has]
    lo, hi = (x[first + end(at).astype(np.int64)] for end in (np.floor, np.ceil))
    res[has] = lo + (hi - lo) * (at - np.floor(at))
    return res


def _box_codes(of: np.ndarray, box: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """One number per distinct (series, box), in order, and the index of it
    for every row.  Boxes within reach of each other differ by as much as
    their numbers; wider gaps are closed, so numbers stay small."""
    order = np.lexsort((box, of))
    o, b = of[order], box[order]
    new = np.append(True, (o[1:] != o[:-1]) | (b[1:] != b[:-1]))[:len(o)]
    o, b = o[new], b[new]
    step = np.where(o[1:] != o[:-1], 2 * reach + 2, np.minimum(b[1:] - b[:-1], 2 * reach + 2))
    index = np.empty(len(order), np.int64)
    index[order] = np.cumsum(new) - 1
    return np.cumsum(np.append(0, step)[:len(o)]).astype(np.int64), index


def _judge(keys, value: str, h: float, keep: float, bound: float, quantile: float, direction: str, only: bool,
           terms: int, reach: int, names):
    """The new rows of whole series, with the bounds of the trimmed training
    values (``lower``, ``upper``, ``_ntrain``), the ``threshold`` of their
    densities, and the moments about the centre of the row's own box
    (``_m0`` ..; null without a source) with its distance from it (``_t``);
    ``only`` those beyond the bounds."""
    def run(batches):
        for b, starts in whole_runs(batches, keys):
            x = b.column(value)
            x = (x if pa.types.is_floating(x.type) or pa.types.is_integer(x.type) else x.cast(pa.float64())).to_numpy(zero_copy_only=False)
            of, (train, new) = np.cumsum(starts) - 1, (b.column(c).to_numpy(zero_copy_only=False) for c in ("_is_train", "_is_new"))
            with np.errstate(invalid="ignore", over="ignore", divide="ignore"):
                order = np.flatnonzero(train)
                order = order[np.lexsort((x[order], of[order]))]
                v, s = x[order], of[order]
                size = lambda: (lambda n: (np.cumsum(n) - n, n))(np.bincount(s, minlength=of[-1] + 1))  # noqa: B023,E731
                if keep < 100:
                    lo = (100 - keep) / 2 / 100
                    lo, hi = (_quantile(v, *size(), q) for q in (lo, 1 - lo))
                    kept = (v >= lo[s]) & ~(v > hi[s])
                    v, s = v[kept], s[kept]
                start, n = size()
                lower, upper = (_quantile(v, start, n, q) for q in (1 - bound, bound))
                rows = np.flatnonzero(new & (n[of] > 0))
                z = np.concatenate([v, x[rows]]).astype(np.float64) / h
                box = np.floor(z)
                t = z - (box + 0.5)
                codes, index = _box_codes(np.concatenate([s, of[rows]]), box, reach)
                power = np.empty((len(v), terms))
                power[:, 0] = np.exp(-0.5 * t[:len(v)] * t[:len(v)])
                for k in range(1, terms):
                    power[:, k] = power[:, k - 1] * t[:len(v)]
                own = np.flatnonzero(np.append(True, np.diff(index[:len(v)]) != 0)[:len(v)])
                total, met = _summed(codes[index[own]], np.add.reduceat(power, own, axis=0) if len(own) else power, codes,
                                     _matrices(terms, reach), reach)
                acc = total[index[:len(v)], terms - 1]
                for k in range(terms - 2, -1, -1):
                    acc = total[index[:len(v)], k] + (t[:len(v)] / (k + 1)) * acc
                dens = np.exp(-0.5 * t[:len(v)] * t[:len(v)]) * acc / (n[s] * (h * math.sqrt(2 * math.pi)))
                threshold = _quantile(dens[np.lexsort((dens, s))], start, n, quantile)
                index, t = index[len(v):], t[len(v):]
                if only:
                    beyond = np.zeros(len(rows), bool)
                    if direction in ("low", "lower", "both"):
                        beyond |= ~(x[rows] >= lower[of[rows]])
                    if direction in ("high", "upper", "both"):
                        beyond |= x[rows] > upper[of[rows]]
                    rows, index, t = rows[beyond], index[beyond], t[beyond]
            if len(rows):
                series, none = of[rows], ~met[index]
                yield pa.RecordBatch.from_arrays(
                    [*b.take(pa.array(rows)).columns, *[pa.array(c[series]) for c in (lower, upper, n.astype(np.int64), threshold)],
                     pa.array(t), *[pa.array(total[index, k], mask=none) for k in range(terms)]], names)
    return run


def kde_density(points: DataFrame, train: DataFrame, keys, value: str, bandwidth: float = 0.5,
                out: str = "density", *, n_col: str | None = None, moments: DataFrame | str | None = None,
                cutoff: float = CUTOFF, terms: int = TERMS) -> DataFrame:
    """Add the Gaussian KDE density of ``value`` in ``points`` under the
    training values of the same series.  Points of series without training
    data, or further than ``cutoff`` bandwidths from it, get 0.  ``moments``
    of ``train`` (of ``terms`` terms) may be passed when they are known;
    ``"carried"``: the points have those of their box (``_m0`` .., null
    without a source) and their distance from its centre (``_t``)."""
    keys = as_list(keys)
    h = float(bandwidth)
    carried = isinstance(moments, str)
    mom = box_moments(train, keys, value, h, points=points, cutoff=cutoff, terms=terms) if moments is None else moments
    if n_col is None:
        n = train.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_ntrain"))
        points = attach_by_key(points, n, keys)
        n_col = "_ntrain"
    p = points
    if not carried:
        z = F.col(value) / F.lit(h)
        p = points.withColumn("_box", _box(z)).withColumn("_t", z - (F.col("_box") + 0.5))
        # a row of moments is many times as wide as the planner's estimate of it: never broadcast
        p = join_on(p, mom.hint("merge"), [*keys, "_box"], "left")
    norm = F.col(n_col) * F.lit(h * math.sqrt(2 * math.pi))
    dens = F.exp(-0.5 * F.col("_t") * F.col("_t")) * _horner(F.col("_t"), terms) / norm
    p = p.withColumn(out, F.when(F.col(value).isNotNull(), F.coalesce(dens, F.lit(0.0))))
    drop = ["_box", "_t", *[f"_m{k}" for k in range(terms)]]
    if n_col == "_ntrain":
        drop.append("_ntrain")
    return p.drop(*drop)


def kde_detect(df: DataFrame, keys, time: str, value: str, *, tiebreak=(), bandwidth: float = 0.5,
               train="all", new="all", filter_percentile: float = 100, threshold_percentile: float = 99,
               direction: str = "low", density_quantile: float = 0.01, exclude_new: bool = False,
               tie_tolerance: float = TIE_TOLERANCE, only_anomalies: bool = True, cutoff: float = CUTOFF,
               terms: int = TERMS) -> DataFrame:
    """KDE novelty / outlier detector per series.

    ``train``: ``"all"`` or ``("head", h)`` = all but the last ``h`` rows.
    ``new``: ``"all"`` or ``("tail", h)`` = the last ``h`` rows.
    Training values are trimmed to the central ``filter_percentile`` %;
    a point is flagged when its density is below the ``density_quantile``
    (fixed 1 %) of training densities **and** it lies strictly beyond the
    ``threshold_percentile`` bound(s) of the trimmed training values.
    Rows with a null value are ignored.  Series whose rows are all in one
    partition, as ``_cut`` of :func:`with_position` tells, stay there.

    Densities within ``tie_tolerance`` (relative) of the threshold count as
    ties and are not flagged: an isolated point's density is exactly the
    self-kernel ``1/(n h sqrt(2 pi))``, which is also the usual threshold,
    so a bare ``<`` would be decided by rounding noise.
    """
    keys = as_list(keys)
    d = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    tails = [x[1] for x in (train, new) if isinstance(x, tuple)]
    placed = CUT in d.columns
    if tails:
        d = d.drop(POS, CUT) if placed else d
        d, placed = with_position(d, keys, [time, *as_list(tiebreak)], descending=True, name="_rpos", cut=CUT), True
    elif placed:
        d = d.drop(POS)

    def marked(d: DataFrame) -> DataFrame:
        is_train = F.lit(True) if train == "all" else F.col("_rpos") >= int(train[1])
        is_new = F.lit(True) if new == "all" else F.col("_rpos") < int(new[1])
        d = d.withColumn("_is_train", is_train).withColumn("_is_new", is_new)
        return d.withColumn("_is_train", F.col("_is_train") & ~F.col("_is_new")) if exclude_new else d

    beyond = directional_flag(value, "lower", "upper", direction)

    def whole(d: DataFrame) -> DataFrame:
        """Densities of series whose rows follow each other in a partition."""
        d = marked(d)
        more = T.StructType.fromDDL("lower double, upper double, _ntrain long, threshold double, _t double")
        kinds = T.StructType([*d.schema, *more, *[T.StructField(f"_m{k}", T.DoubleType()) for k in range(terms)]])
        run = _judge(keys, value, float(bandwidth), filter_percentile, threshold_percentile / 100, float(density_quantile), direction,
                     only_anomalies, terms, math.ceil(cutoff + 0.5), kinds.names)
        nw = d.mapInArrow(run, kinds)
        if only_anomalies:
            nw = nw.filter(beyond)
        return kde_density(nw, d, keys, value, bandwidth, "density", n_col="_ntrain", moments="carried", terms=terms)

    def spread(d: DataFrame) -> DataFrame:
        """Densities of series of any length: no task holds one."""
        d = marked(d)
        # the training values are ranked once: for the trim and, past it, for the bounds
        t = rank_values(d.filter("_is_train").select(*keys, value), keys, value)
        if filter_percentile < 100:
            lo = (100 - filter_percentile) / 2 / 100
            b = percentiles_at(t, keys, value, [lo, 1 - lo], ["_flo", "_fhi"])
            t = attach_by_key(t, b, keys).filter(F.col(value).between(F.col("_flo"), F.col("_fhi"))).drop("_flo", "_fhi")
            t = materialize(t)
        thr_p = threshold_percentile / 100
        moments = materialize(box_moments(t, keys, value, bandwidth, points=d, cutoff=cutoff, terms=terms))
        st = materialize(percentiles_at(t, keys, value, [1 - thr_p, thr_p], ["lower", "upper"], n="_ntrain"))
        tr = kde_density(attach_by_key(t.select(*keys, value), st.select(*keys, "_ntrain"), keys), t, keys, value, bandwidth,
                         "_dens", n_col="_ntrain", moments=moments, terms=terms)
        thr = series_percentiles(tr, keys, "_dens", [float(density_quantile)], ["threshold"])
        st = attach_by_key(st, thr, keys)
        nw = attach_by_key(d.filter("_is_new"), st, keys)
        if only_anomalies:
            # beyond the bounds lie few rows: only they need a density
            nw = nw.filter(beyond)
        return kde_density(nw, t, keys, value, bandwidth, "density", n_col="_ntrain", moments=moments, terms=terms)

    def dealt(d: DataFrame) -> DataFrame:
        return whole(d.repartition(*keys).sortWithinPartitions(*keys))

    stay = d.filter(~F.col(CUT)).drop(CUT) if placed else None
    d = d.filter(CUT).drop(CUT) if placed else d
    long = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > sequence.WHOLE).select(*keys) if keys else None
    if keys and long.isEmpty():
        nw = dealt(d)
    elif keys:
        long = materialize(long)
        nw = spread(materialize(join_on(d, long, keys, "left_semi"))).unionByName(dealt(join_on(d, long, keys, "left_anti")))
    else:
        nw = spread(d)
    nw = nw.unionByName(whole(stay)) if placed else nw
    below = F.col("density") < F.col("threshold") * F.lit(1.0 - tie_tolerance)
    nw = nw.withColumn("is_outlier", F.coalesce(below & beyond, F.lit(False)))
    nw = nw.drop("_is_train", "_is_new", "_ntrain", *(["_rpos"] if tails else []))
    return nw.filter("is_outlier") if only_anomalies else nw


def kde_curve(train: DataFrame, keys, value: str, bandwidth: float = 0.5, points: int = 1000,
              pad: float = 1.0, cutoff: float = CUTOFF, terms: int = TERMS) -> DataFrame:
    """Density on an even grid from ``min - pad`` to ``max + pad`` per
    series (``points`` values, last one exactly ``max + pad``).  The points
    are made in the strip they lie in: only moments are shuffled."""
    keys = as_list(keys)
    rng = train.groupBy(*keys).agg((F.min(value) - pad).cast("double").alias("_lo"),
                                   (F.max(value) + pad).cast("double").alias("_hi"), F.count(value).alias("_ntrain"))
    h, reach = float(bandwidth), math.ceil(cutoff + 0.5)
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    at = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: _strip(_box(
        F.when(i == points - 1, F.col("_hi")).otherwise(F.col("_lo") + i * step) / F.lit(h))))
    rng = rng.withColumn("_strip", F.explode(F.array_distinct(at)))
    both = _by_strip(_own_moments(_boxed(train, keys, value, h), keys, terms, reach), rng, keys)
    return both.mapInArrow(_draw(keys, h, points, terms, reach), T.StructType(
        [*[both.schema[k] for k in keys], *T.StructType.fromDDL("i int, x double, density double").fields]))

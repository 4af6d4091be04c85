"""Reconstruction model over fixed-length slices.

A linear autoencoder's optimum is the principal subspace, so the model is
PCA on (globally scaled) slice vectors: score = L2 norm of the residual
after projecting the centred slice on the top ``k`` components; a slice is
anomalous when its score is strictly above the training threshold
(``threshold_percentile`` of training scores).

Training is a single distributed aggregation of *sufficient statistics*
``n, sum(x), sum(x x^T)`` (size d x d, d = slice length, independent of
the data volume).  Only that small matrix reaches the driver, where it is
eigen-decomposed.  Because the statistics add up, :meth:`update` (warm
start on new data) equals a fit on the union of old and new slices.
Statistics and scores are matrix products over Arrow batches, so slices of
hundreds of values cost no more plan than short ones.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.sequence import as_list, join_on, percentiles_by_rank
from tidewatch.session import materialize


def slices_to_vectors(sliced: DataFrame, keys, time: str, value: str, *, tiebreak=(),
                      slice_col: str = "slice_start", id_col: str = "series_id",
                      length: int | None = None, out: str = "x") -> DataFrame:
    """One row per slice with its values as a time-ordered array.  Each
    group is one slice (bounded by the slice length).  With ``length``,
    slices of any other length are dropped."""
    keys, tb = as_list(keys), as_list(tiebreak)
    g = sliced.groupBy(*keys, slice_col, id_col).agg(
        F.array_sort(F.collect_list(F.struct(time, *tb, value))).alias("_s"))
    g = g.select(*keys, slice_col, id_col, F.transform("_s", lambda s: s[value]).alias(out))
    return g.filter(F.size(out) == length) if length else g


@dataclass
class ReconstructionModel:
    d: int
    k: int
    scaler: str | None = "standard"
    scale_center: float = 0.0
    scale_div: float = 1.0
    n: int = 0
    sums: list = field(default_factory=list)
    gram: list = field(default_factory=list)
    mean: list = field(default_factory=list)
    components: list = field(default_factory=list)
    threshold: float | None = None
    threshold_percentile: float = 99.0
    version: int | None = None
    learned_batch: int | None = None        # micro-batch that a stream last learned from

    # -- fitting ----------------------------------------------------------
    @staticmethod
    def scaler_params(df: DataFrame, col: str, scaler) -> tuple[float, float]:
        """Global scaling ``(x - center) / div`` over every value of every
        slice: ``standard``, ``minmax``, ``robust`` (median and quartiles, by
        rank), or an object with ``affine(values) -> (center, div)``, given
        the values as a DataFrame with one column ``v``."""
        if scaler is None:
            return 0.0, 1.0
        v = df.select(F.explode(col).alias("v"))
        if hasattr(scaler, "affine"):
            center, div = scaler.affine(v)
            return float(center), float(div) or 1.0
        if scaler == "robust":
            lo, mid, hi = percentiles_by_rank(v, [], "v", [0.25, 0.5, 0.75], ["lo", "mid", "hi"]).first()
            return float(mid), float(hi - lo) or 1.0
        if scaler == "standard":
            r = v.agg(F.avg("v"), F.stddev_pop("v")).first()
            sd = r[1] if r[1] else 1.0
            return float(r[0]), float(sd)
        if scaler == "minmax":
            r = v.agg(F.min("v"), F.max("v")).first()
            rng = (r[1] - r[0]) or 1.0
            return float(r[0]), float(rng)
        raise ValueError(f"unknown scaler {scaler!r}")

    def _matrix(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(usable, scaled): which slices have ``d`` values, none missing,
        and those as a matrix."""
        flat = column.flatten().cast(pa.float64())
        size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ok = size == self.d
        x = flat.to_numpy(zero_copy_only=False)[np.repeat(ok, size)].reshape(-1, self.d)
        whole = ~np.isnan(x).any(axis=1)
        ok[ok] = whole
        return ok, (x[whole] - self.scale_center) / self.scale_div

    def _stats(self, df: DataFrame, col: str):
        """``n, sum(x), sum(x x^T)``: one matrix product per batch, one row
        per partition, summed over ever fewer partitions to a single row."""
        d = self.d

        def product(batches):
            n, s, g = 0, np.zeros(d), np.zeros((d, d))
            for b in batches:
                _, x = self._matrix(b.column(0))
                n, s, g = n + len(x), s + x.sum(axis=0), g + x.T @ x
            yield row(n, s, g)

        def add(batches):
            n, s, g = 0, np.zeros(d), np.zeros((d, d))
            for b in batches:
                for i in range(b.num_rows):
                    n += b.column(0)[i].as_py()
                    s += b.column(1)[i].values.to_numpy()
                    g += b.column(2)[i].values.to_numpy().reshape(d, d)
            yield row(n, s, g)

        def row(n, s, g):
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([s], pa.list_(pa.float64())),
                                               pa.array([g.ravel()], pa.list_(pa.float64()))], names=["n", "s", "g"])

        kind = "n long, s array<double>, g array<double>"
        rows = df.select(F.col(col).cast("array<double>").alias("x")).mapInArrow(product, kind)
        for parts in (64, 1):
            rows = rows.repartition(parts).mapInArrow(add, kind)
        r = rows.first()
        return r["n"], np.array(r["s"]), np.array(r["g"]).reshape(d, d)

    def _solve(self):
        s, g = np.array(self.sums), np.array(self.gram)
        mu = s / self.n
        cov = g / self.n - np.outer(mu, mu)
        w, v = np.linalg.eigh((cov + cov.T) / 2)
        order = np.argsort(w)[::-1][: self.k]
        comps = v[:, order].T
        # deterministic sign: largest-magnitude entry positive
        for i in range(comps.shape[0]):
            j = int(np.argmax(np.abs(comps[i])))
            if comps[i, j] < 0:
                comps[i] = -comps[i]
        self.mean = [float(a) for a in mu]
        self.components = [[float(a) for a in row] for row in comps]

    @classmethod
    def fit(cls, df: DataFrame, col: str = "x", *, k: int = 4, scaler="standard",
            threshold_percentile: float = 99.0) -> "ReconstructionModel":
        """Fit on the slices of ``col``; their length is that of the longest
        one, shorter ones and ones with a missing value take no part."""
        df = df.select(col)
        df = materialize(df)  # four passes below read it
        d = df.agg(F.max(F.size(col))).first()[0]
        if not d or d < 0:
            raise ValueError("no slices to fit on")
        c, s = cls.scaler_params(df.filter(F.size(col) == d), col, scaler)
        name = scaler if scaler is None or isinstance(scaler, str) else type(scaler).__name__
        m = cls(d=d, k=min(k, d), scaler=name, scale_center=c, scale_div=s,
                threshold_percentile=threshold_percentile)
        m.n, sums, gram = m._stats(df, col)
        if not m.n:
            raise ValueError("no slice without missing values")
        m.sums, m.gram = sums.tolist(), gram.tolist()
        m._solve()
        m.threshold = m._threshold(df, col)
        return m

    def update(self, df: DataFrame, col: str = "x") -> "ReconstructionModel":
        """Warm start: add the statistics of new slices (scaled with the
        stored scaler) and re-derive components; threshold from the new
        slices.  Equal to a fit on old + new slices with this scaler."""
        n, s, g = self._stats(df, col)
        m = ReconstructionModel(**{**asdict(self), "n": self.n + n,
                                   "sums": (np.array(self.sums) + s).tolist(),
                                   "gram": (np.array(self.gram) + g).tolist(), "version": None})
        m._solve()
        m.threshold = m._threshold(df, col)
        return m

    # -- scoring ----------------------------------------------------------
    def _with_score(self, df: DataFrame, col: str, out: str = "score") -> DataFrame:
        """Residual norm after projecting the centred, scaled slice on the
        components, a batch of slices at a time; null for a slice of another
        length or with a missing value."""
        mean, comps = np.array(self.mean), np.array(self.components).reshape(-1, self.d)
        df = df.drop(out)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

        def score(batches):
            for b in batches:
                ok, x = self._matrix(b.column(b.num_columns - 1))
                x = x - mean
                got = np.full(b.num_rows, np.nan)
                got[ok] = np.linalg.norm(x - (x @ comps.T) @ comps, axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.float64(), mask=~ok)],
                                                 names=[*b.schema.names[:-1], out])

        return df.withColumn("_slice", F.col(col).cast("array<double>")).mapInArrow(score, f"{kinds}, `{out}` double")

    def _threshold(self, df: DataFrame, col: str) -> float:
        q = self.threshold_percentile / 100
        # written first: ranking reads the scores twice
        scored = materialize(self._with_score(df.select(col), col, "s").select("s"))
        return float(percentiles_by_rank(scored, [], "s", [q], ["threshold"]).first()[0])

    def score(self, df: DataFrame, col: str = "x") -> DataFrame:
        """Adds ``score, threshold, is_anomaly`` (strict ``>``)."""
        return (self._with_score(df, col)
                  .withColumn("threshold", F.lit(float(self.threshold)))
                  .withColumn("is_anomaly", F.coalesce(F.col("score") > F.col("threshold"), F.lit(False))))

    # -- persistence ------------------------------------------------------
    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, s: str) -> "ReconstructionModel":
        return cls(**json.loads(s))

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON text file under ``path`` (any Hadoop file system)."""
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1) \
             .write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ReconstructionModel":
        return cls.from_json(spark.read.text(path).first()[0])


# -- versioned models -------------------------------------------------------

def model_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions of ``root`` that were written completely, in order."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(top)]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n[8:]) for n in names if n.startswith("version=") and fs.exists(path(f"{root}/{n}/_SUCCESS")))


def save_model_version(spark: SparkSession, model: ReconstructionModel, root: str) -> ReconstructionModel:
    """Write the model as the next version under ``root`` (earlier versions
    stay) and return it with its number."""
    versions = model_versions(spark, root)
    m = replace(model, version=(versions[-1] if versions else 0) + 1)
    m.save(spark, f"{root}/version={m.version}")
    return m


def load_model_version(spark: SparkSession, root: str, version: int | str = "latest") -> ReconstructionModel:
    versions = model_versions(spark, root)
    n = versions[-1] if version == "latest" and versions else version
    if n not in versions:
        raise ValueError(f"no model version {version!r} under {root}")
    return ReconstructionModel.load(spark, f"{root}/version={n}")


# -- training runs ----------------------------------------------------------

def split_slices(slices: DataFrame, keys, fraction: float = 0.2, *, seed: str = "split",
                 flag: str = "is_validation") -> DataFrame:
    """Mark about ``fraction`` of the series for validation, by a hash of
    their keys: all slices of a series are on one side, so overlapping
    slices never stand on both, and the split is the same in every run."""
    text = F.concat_ws("\x1f", F.lit(seed), *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in as_list(keys)])
    draw = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return slices.withColumn(flag, draw < F.lit(float(fraction)))


def fit_and_score(model, train: DataFrame, new: DataFrame) -> DataFrame:
    """A user's own model in place of the reconstruction model: any object
    with ``fit(df)``, which may return the fitted object, and
    ``transform(df) -> DataFrame``."""
    fitted = model.fit(train)
    return (model if fitted is None else fitted).transform(new)


def train_and_log(df: DataFrame, keys, time: str, value: str, root: str, *, length: int = 200, shift: int = 1,
                  tiebreak=(), k: int = 4, scaler="standard", threshold_percentile: float = 99.0,
                  bins: int = 30, run_id: str = "") -> tuple[ReconstructionModel, DataFrame]:
    """Slice, fit, save the next version under ``root`` and append one row
    to the run log ``root/runs``: parameters, threshold, summary of the
    training scores and their histogram.  Returns (model, scored slices)."""
    from tidewatch.operators.report import score_histogram, score_summary
    from tidewatch.operators.reshape import slice_vectors
    spark = df.sparkSession
    x = materialize(slice_vectors(df, keys, time, value, length, shift, tiebreak=tiebreak))
    model = ReconstructionModel.fit(x, "x", k=k, scaler=scaler, threshold_percentile=threshold_percentile)
    model = save_model_version(spark, model, root)
    scored = materialize(model.score(x))
    params = {"length": length, "shift": shift, "k": model.k, "scaler": scaler,
              "threshold_percentile": threshold_percentile}
    scores = scored.select("score").filter("score IS NOT NULL")
    histogram = score_histogram(scores, bins).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("bins"))
    summary = score_summary(scores, threshold_percentile).drop("threshold")
    run = summary.join(histogram).select(
        F.lit(run_id).alias("run_id"), F.lit(model.version).alias("version"), F.current_timestamp().alias("logged_at"),
        F.lit(json.dumps(params, sort_keys=True)).alias("params"), F.lit(float(model.threshold)).alias("threshold"),
        "n", "n_anomalies", "mean", "std", F.to_json("bins").alias("histogram"))
    run.write.mode("append").parquet(f"{root}/runs")
    return model, scored


# -- a model per segment or entity ------------------------------------------

class KeyedModels:
    """Reconstruction models of the groups of ``by``, as one table: a row per
    key with ``n, center, scale, mean, components, threshold``.

    The sums ``n, sum(x), sum(x x^T)`` of scaled slices are added per key in
    every task and again over tasks, so a key with a third of the slices
    costs one d x d matrix per task; no group of slices meets in one place.
    Keys without two slices, or whose values never vary, have no model, and
    their slices no score.
    """

    def __init__(self, table: DataFrame, by, d: int, k: int):
        self.table, self.by, self.d, self.k = table, as_list(by), d, k

    @classmethod
    def sums(cls, df: DataFrame, by, col: str = "x", *, scaler="standard") -> tuple[DataFrame, int]:
        """(keys, center, scale, n, sums, gram (by rows)) and the length of
        the slices (that of the longest; others take no part)."""
        by = as_list(by)
        d = df.agg(F.max(F.size(col))).first()[0]
        if not d or d < 0:
            raise ValueError("no slices to fit on")
        x = df.select(*by, F.col(col).cast("array<double>").alias("_x"))
        x = x.filter((F.size("_x") == d) & F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v)))
        v = x.select(*by, F.explode("_x").alias("_v")).groupBy(*by)
        if scaler == "standard":
            s = v.agg(F.avg("_v").alias("center"), F.stddev_pop("_v").alias("scale"))
        elif scaler == "minmax":
            s = v.agg(F.min("_v").alias("center"), (F.max("_v") - F.min("_v")).alias("scale"))
        elif scaler is None:
            s = v.agg(F.lit(0.0).alias("center"), F.lit(1.0).alias("scale"))
        else:
            raise ValueError(f"unknown scaler {scaler!r}")
        s = s.withColumn("scale", F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0)))
        x = join_on(x, materialize(s), by)
        most = max(1, (1 << 23) // (d * d))         # matrices that a task holds
        kinds = T.StructType([*[x.schema[k] for k in by], *T.StructType.fromDDL(
            "center double, scale double, _s array<double>").fields])

        def add(batches):
            held: dict = {}
            for b in batches:
                if not b.num_rows:
                    continue
                center, scale = (b.column(c).to_numpy() for c in ("center", "scale"))
                m = b.column("_x").flatten().to_numpy().reshape(-1, d)
                m = (m - center[:, None]) / scale[:, None]
                keys = [repr(t) for t in zip(*[b.column(k).to_pylist() for k in by])]
                groups: dict = {}
                for i, key in enumerate(keys):
                    groups.setdefault(key, []).append(i)
                for key, at in groups.items():
                    g = m[at]
                    if key not in held:
                        if len(held) >= most:
                            yield rows(held, b.schema)
                            held = {}
                        held[key] = [b.slice(at[0], 1).select([*by, "center", "scale"]), 0, np.zeros(d), np.zeros((d, d))]
                    h = held[key]
                    h[1], h[2], h[3] = h[1] + len(g), h[2] + g.sum(axis=0), h[3] + g.T @ g
                schema = b.schema
            if held:
                yield rows(held, schema)

        def rows(held, schema):
            head = pa.Table.from_batches([h[0] for h in held.values()]).combine_chunks().to_batches()[0]
            sums = [[float(n), *s, *g.ravel()] for _, n, s, g in held.values()]
            return pa.RecordBatch.from_arrays([*head.columns, pa.array(sums, pa.list_(pa.float64()))], [*head.schema.names, "_s"])

        part = x.mapInArrow(add, kinds).select(*by, "center", "scale", F.posexplode("_s").alias("_i", "_v"))
        part = part.groupBy(*by, "center", "scale", "_i").agg(F.sum("_v").alias("_v"))
        whole = part.groupBy(*by, "center", "scale").agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_s"))
        s = F.col("_s._v")
        return whole.select(*by, "center", "scale", s[0].cast("long").alias("n"), F.slice(s, 2, d).alias("sums"),
                            F.slice(s, 2 + d, d * d).alias("gram")), d

    @classmethod
    def fit(cls, df: DataFrame, by, col: str = "x", *, k: int = 4, scaler="standard",
            threshold_percentile: float = 99.0) -> "KeyedModels":
        """Fit a model per key; the threshold is that percentile of the
        key's own training scores."""
        df = materialize(df)
        by = as_list(by)
        sums, d = cls.sums(df, by, col, scaler=scaler)
        k = min(k, d)
        kinds = T.StructType([*[sums.schema[c] for c in by], *T.StructType.fromDDL(
            "n long, center double, scale double, mean array<double>, components array<double>").fields])

        def solve(frames):
            for pdf in frames:
                out = []
                for r in pdf.to_dict("records"):
                    m = ReconstructionModel(d=d, k=k, n=int(r["n"]), sums=list(r["sums"]), gram=np.reshape(r["gram"], (d, d)).tolist())
                    m._solve()
                    out.append({**{c: r[c] for c in [*by, "n", "center", "scale"]}, "mean": m.mean,
                                "components": np.ravel(m.components).tolist()})
                yield pd.DataFrame(out, columns=kinds.names)

        varies = F.exists("gram", lambda g: g != 0)
        models = cls(materialize(sums.filter((F.col("n") > 1) & varies).mapInPandas(solve, kinds)), by, d, k)
        scored = materialize(models._with_score(df.select(*by, col), col).filter("score IS NOT NULL").select(*by, "score"))
        bound = percentiles_by_rank(scored, by, "score", [threshold_percentile / 100], ["threshold"])
        models.table = materialize(join_on(models.table, bound, by))
        return models

    def _with_score(self, df: DataFrame, col: str) -> DataFrame:
        d, k = self.d, self.k
        df = df.drop("score", "threshold", "is_anomaly")
        names = df.columns
        extra = [c for c in self.table.columns if c not in self.by]
        table = self.table.select(*self.by, *[F.col(c).alias(f"_k_{c}") for c in extra])
        j = join_on(df.withColumn("_slice", F.col(col).cast("array<double>")), table, self.by, "left")
        more = ["threshold"] if "threshold" in extra else []
        kinds = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in more], T.StructField("score", T.DoubleType())])

        def score(batches):
            for whole in batches:
                for i in range(0, whole.num_rows, 1024):
                    b = whole.slice(i, 1024)
                    size = b.column("_slice").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    ok = (size == d) & b.column("_k_n").is_valid().to_numpy(zero_copy_only=False)
                    flat = b.column("_slice").flatten().to_numpy(zero_copy_only=False).astype(float)
                    x = flat[np.repeat(ok, size)].reshape(-1, d)
                    some = b.filter(pa.array(ok))
                    col_of = lambda c, w: some.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, *w)
                    got = np.full(b.num_rows, np.nan)
                    if len(x):
                        x = (x - some.column("_k_center").to_numpy()[:, None]) / some.column("_k_scale").to_numpy()[:, None]
                        x = x - col_of("_k_mean", (d,))
                        comps = col_of("_k_components", (k, d))
                        part = np.matmul(np.matmul(comps, x[:, :, None]).transpose(0, 2, 1), comps)[:, 0]
                        got[ok] = np.linalg.norm(x - part, axis=1)
                    yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], *[b.column(f"_k_{c}") for c in more],
                                                      pa.array(got, pa.float64(), from_pandas=True)], [*names, *more, "score"])
        return j.mapInArrow(score, kinds)

    def score(self, df: DataFrame, col: str = "x") -> DataFrame:
        """Adds ``threshold, score, is_anomaly`` (strict ``>``) under the
        model of each slice's key; nulls where there is none."""
        return self._with_score(df, col).withColumn("is_anomaly", F.coalesce(F.col("score") > F.col("threshold"), F.lit(False)))

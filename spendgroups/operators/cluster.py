"""Scaling, K-means and the elbow sweep."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.clustering import KMeans as RowKMeans
from pyspark.mllib.clustering import KMeansModel as Centres
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgroups.operators.columns import split_rejects
from spendgroups.operators.quality import table_overview
from spendgroups.schema import (
    ASSEMBLED,
    CLUSTER,
    FEATURES,
    INCOME,
    K_DEFAULT,
    K_MAX,
    K_MIN,
    NUMERIC,
    SCALED,
    SCORE,
    SEED,
)
from spendgroups.session import new_folder, remove_folder

# Fits of a sweep that run at the same time.
AT_ONCE = 4
# Different rows among which starts are chosen.
START_ROWS = 1000


@dataclass
class GroupModel:
    """A fitted pipeline and what was measured while fitting it.

    ``groups`` holds one record per group, ordered by group id. Spark's own
    cluster ids depend on how the data were partitioned; a group id is the rank
    of the cluster centre by income, then score.
    """

    pipeline: PipelineModel
    k: int
    cost: float | None = None
    n_rows: int | None = None
    domain: list[dict] = field(default_factory=list)
    scaling: list[dict] = field(default_factory=list)
    groups: list[dict] = field(default_factory=list)

    @classmethod
    def restored(cls, pipeline: PipelineModel, record: Mapping) -> GroupModel:
        """From a loaded pipeline and its record, which may lack our own fields."""
        facts = {
            name: record.get(name)
            for name in ("cost", "n_rows", "domain", "scaling", "groups")
            if record.get(name) is not None
        }
        return cls(pipeline, record["k"], **facts)

    def centres(self) -> list[tuple[float, ...]]:
        """Cluster centres in the units of the table, by Spark's cluster id."""
        scaler: StandardScalerModel = self.pipeline.stages[-2]
        kmeans: KMeansModel = self.pipeline.stages[-1]
        return [
            tuple(float(c * s + m) for c, s, m in zip(centre, scaler.std, scaler.mean))
            for centre in kmeans.clusterCenters()
        ]

    def group_ids(self) -> list[int]:
        """Group id of each of Spark's cluster ids."""
        places = [tuple(round(x, 6) for x in centre) for centre in self.centres()]
        order = sorted(range(len(places)), key=places.__getitem__)
        return [order.index(i) for i in range(len(order))]

    def training_domain(self) -> dict[str, tuple[float, float]]:
        """Range of each column in the training table."""
        return {d["column"]: (d["lo"], d["hi"]) for d in self.domain}


def _checked_k(k: int) -> int:
    if not K_MIN <= k <= K_MAX:
        raise ValueError(f"k must be from {K_MIN} to {K_MAX}, not {k}")
    return k


def scaling_stages(cols: Sequence[str] = FEATURES) -> list:
    return [
        VectorAssembler(inputCols=list(cols), outputCol=ASSEMBLED),
        StandardScaler(
            inputCol=ASSEMBLED, outputCol=SCALED, withMean=True, withStd=True
        ),
    ]


def kmeans_stage(k: int, seed: int = SEED) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=SCALED, predictionCol=CLUSTER)


def grouping_stages(k: int = K_DEFAULT, seed: int = SEED) -> Pipeline:
    """Assemble, standardise, cluster, as one estimator over plain rows."""
    return Pipeline(stages=[*scaling_stages(), kmeans_stage(_checked_k(k), seed)])


class Training:
    """A table made ready for one or more fits, on all its rows.

    The numbers are read from the source once and written to the shared folder, where
    they are measured, scaled and fitted. ``release`` removes them; models do not need
    them any more.
    """

    def __init__(self, df: DataFrame):
        ok, _ = split_rejects(df)
        extra = [c for c in NUMERIC if c in df.columns and c not in FEATURES]
        self.spark = df.sparkSession
        self.folder = new_folder(self.spark, "training")
        ok.select(*extra, *[F.col(c).cast("double").alias(c) for c in FEATURES]).write.parquet(
            self.folder
        )
        rows = self.spark.read.parquet(self.folder)
        facts = table_overview(rows, [*extra, *FEATURES]).first()
        self.n_rows = facts["n_rows"]
        if self.n_rows == 0:
            self.release()
            raise ValueError("no row has both an income and a score")
        self.domain = [
            {"column": d["column"], "lo": d["min"], "hi": d["max"]} for d in facts["described"]
        ]
        self.scaling = Pipeline(stages=scaling_stages()).fit(rows)
        self.rows = self.scaling.transform(rows.select(*FEATURES))

    def release(self) -> None:
        remove_folder(self.spark, self.folder)

    def kmeans(self, k: int, seed: int = SEED) -> KMeansModel:
        return kmeans_stage(_checked_k(k), seed).fit(self.rows)

    def starts(self, k: int, seed: int = SEED) -> list[list[float]]:
        """Scaled start centres that the rows and the seed alone decide.

        Of the different pairs of features, those with the smallest hashes are a sample of
        ``START_ROWS``; each start is the one of them farthest from the starts before it.
        """
        pairs = self.rows.select(*FEATURES).distinct()
        lot = F.xxhash64(*FEATURES, F.lit(seed))
        chosen = pairs.orderBy(lot, *FEATURES).limit(START_ROWS).collect()
        scaler = self.scaling.stages[-1]
        scaled = [
            [(x - m) / s if s else 0.0 for x, m, s in zip(row, scaler.mean, scaler.std)]
            for row in chosen
        ]
        starts, far = scaled[:1], [float("inf")] * len(scaled)
        while len(starts) < min(k, len(scaled)):
            last = starts[-1]
            # Rounded, as the last digits of the scaling depend on the order of its sums.
            gaps = [round(sum((a - b) ** 2 for a, b in zip(p, last)), 9) for p in scaled]
            far = [min(a, b) for a, b in zip(far, gaps)]
            starts.append(scaled[max(range(len(scaled)), key=far.__getitem__)])
        return starts

    def kmeans_from_rows(self, k: int, seed: int = SEED) -> tuple[KMeansModel, float]:
        """A fit from ``starts``, by the library's K-means, and its cost.

        Spark takes given starts only for vectors of rows, so the two numbers of each row
        go through Python once; the iterations do not. With fewer than ``k`` different rows
        there are fewer centres.
        """
        starts = self.starts(_checked_k(k), seed)
        z = self.rows.select(vector_to_array(SCALED).alias("z"))
        vectors = z.rdd.map(lambda row: Vectors.dense(row["z"])).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        try:
            stage = kmeans_stage(k, seed)
            fitted = RowKMeans.train(
                vectors,
                len(starts),
                maxIterations=stage.getMaxIter(),
                epsilon=stage.getTol(),
                initialModel=Centres(starts),
            )
            cost = float(fitted.computeCost(vectors))
        finally:
            vectors.unpersist()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        held = jvm.java.util.ArrayList()
        for centre in fitted.clusterCenters:
            numbers = gateway.new_array(jvm.double, len(centre))
            for i, x in enumerate(centre):
                numbers[i] = float(x)
            held.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(numbers))
        inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(held)
        model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(stage.uid, inner))
        return stage._copyValues(model), cost

    def sweep(
        self, ks: Iterable[int], seed: int = SEED, at_once: int = AT_ONCE
    ) -> dict[int, KMeansModel]:
        """A fit for each K, some of them at the same time: a fit is a row of short jobs, and
        most of the cluster is idle between them. The scaled rows are kept, in memory or on
        disk, till the last. A fit does not depend on the others."""
        ks = [_checked_k(k) for k in ks]
        rows, self.rows = self.rows, self.rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.rows.count()
            with ThreadPool(max(1, min(at_once, len(ks)))) as pool:
                fit = inheritable_thread_target(self.spark)(lambda k: self.kmeans(k, seed))
                return dict(zip(ks, pool.map(fit, ks, chunksize=1)))
        finally:
            self.rows.unpersist()
            self.rows = rows

    def fit(
        self, k: int = K_DEFAULT, seed: int = SEED, start_from_rows: bool = False
    ) -> GroupModel:
        if start_from_rows:
            kmeans, cost = self.kmeans_from_rows(k, seed)
        else:
            kmeans = self.kmeans(k, seed)
            cost = float(kmeans.summary.trainingCost)
        model = GroupModel(
            PipelineModel([*self.scaling.stages, kmeans]),
            k,
            cost=cost,
            n_rows=self.n_rows,
            domain=self.domain,
        )
        scaler = self.scaling.stages[-1]
        model.scaling = [
            {"column": c, "mean": float(m), "sd": float(s)}
            for c, m, s in zip(FEATURES, scaler.mean, scaler.std)
        ]
        # At most k rows reach the driver.
        means = (
            kmeans.transform(self.rows)
            .groupBy(CLUSTER)
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.avg(INCOME).alias("mean_income"),
                F.avg(SCORE).alias("mean_score"),
            )
            .collect()
        )
        ids = model.group_ids()
        model.groups = sorted(
            ({"group_id": ids[row[CLUSTER]], **row.asDict()} for row in means),
            key=lambda group: group["group_id"],
        )
        return model


def fit_groups(
    df: DataFrame, k: int = K_DEFAULT, seed: int = SEED, start_from_rows: bool = False
) -> GroupModel:
    """Fit on all rows that have both features.

    Spark's own start depends on how the rows are partitioned; ``start_from_rows`` begins
    at rows chosen by a hash of their values and the seed instead.
    """
    _checked_k(k)
    training = Training(df)
    try:
        return training.fit(k, seed, start_from_rows)
    finally:
        training.release()


def assign_groups(df: DataFrame, model: GroupModel) -> DataFrame:
    """Add ``prediction``, Spark's cluster id, and ``group_id``, the stable one.

    Rows without both features must have been split off before.
    """
    ids = F.array(*[F.lit(i) for i in model.group_ids()])
    return model.pipeline.transform(df).withColumn("group_id", ids[F.col(CLUSTER)])


def elbow_sweep(
    df: DataFrame, ks: Iterable[int] = range(K_MIN, K_MAX + 1), seed: int = SEED
) -> DataFrame:
    """Cost of a fit for each K: ``(k, cost)``.

    Scaling does not depend on K and is done once.
    """
    ks = [_checked_k(k) for k in ks]
    training = Training(df)
    try:
        fits = training.sweep(ks, seed)
    finally:
        training.release()
    costs = [(k, float(fit.summary.trainingCost)) for k, fit in fits.items()]
    return df.sparkSession.createDataFrame(costs, "k int, cost double")


def squared_distance(cols: Sequence[str | Column], centre: Sequence[float]) -> Column:
    parts = [
        F.pow((F.col(c) if isinstance(c, str) else c) - F.lit(float(x)), 2)
        for c, x in zip(cols, centre)
    ]
    return sum(parts[1:], parts[0])


def nearest_centre(
    cols: Sequence[str | Column], centres: Sequence[Sequence[float]]
) -> Column:
    """Struct ``(distance, id)`` of the nearest given centre, as an expression.

    The lower id wins a tie.
    """
    return F.array_min(
        F.array(
            *[
                F.struct(
                    squared_distance(cols, centre).alias("distance"), F.lit(i).alias("id")
                )
                for i, centre in enumerate(centres)
            ]
        )
    )

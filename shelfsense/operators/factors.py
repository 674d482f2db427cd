"""ALS matrix factorisation: fit, predict, save, load, and parameter curves."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfsense.functions.hashing import key_fraction
from shelfsense.operators.accuracy import squared_error
from shelfsense.operators.half_steps import LaidOut
from shelfsense.operators.sampling import split_by_weights
from shelfsense.sources.session import delete, fresh_path, shared_folder

# Parameter sets of the study.
TRAIN_FRACTIONS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
REGULARISATIONS = (1.0, 0.1, 0.01, 0.001)
TUTORIAL_RANKS = (4, 8, 12)

RATINGS_PER_SQUARED_BLOCK = 5_000
MAX_BLOCKS = 12
CHECKPOINT_EVERY = 3


@dataclass(frozen=True)
class AlsSettings:
    """Production values; the prototype uses rank 16 and 20 iterations, the results study 12 and 10."""

    rank: int = 20
    max_iter: int = 30
    reg: float = 0.1
    nonnegative: bool = True
    seed: int = 5
    blocks: int = 0  # 0: by the number of ratings, MAX_BLOCKS at most, see blocks_for


def blocks_for(n_ratings: int) -> int:
    """User and item blocks for so many ratings.

    ALS draws its starting factors per block, so the number is part of the model: it follows from the data and is never
    read from the session. Every block of one side sends to every block of the other, so blocks grow with the
    root of the ratings: 11 for 600,000, 447 for a thousand million.
    """
    return max(1, round((n_ratings / RATINGS_PER_SQUARED_BLOCK) ** 0.5))


def fit(triples: DataFrame | LaidOut, settings: AlsSettings = AlsSettings()) -> ALSModel:
    """Explicit-feedback ALS on ``(user_id, item_id, rating)``; ids must fit 32 bits.

    The iterations run as half steps over ratings laid out in the shared folder (``half_steps``), so they shuffle nothing and a
    task's memory does not grow with its ratings. Ratings that are laid out already serve many fits; one that differs from an earlier
    fit of them in being longer goes on from it. Where the shared folder is no path of the file system, Spark's ALS
    iterates itself, with the same blocks. The model returned reads its factors from the shared folder.
    """
    laid = triples if isinstance(triples, LaidOut) else LaidOut(triples)
    spark = laid.spark
    shared_folder(spark)
    blocks = settings.blocks or min(blocks_for(laid.n), MAX_BLOCKS)
    als = ALS(
        rank=settings.rank,
        maxIter=settings.max_iter,
        regParam=settings.reg,
        nonnegative=settings.nonnegative,
        seed=settings.seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=CHECKPOINT_EVERY,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        coldStartStrategy="drop",
    )
    path = fresh_path(spark, "als-factors")
    if laid.folder is not None and settings.reg > 0 and settings.max_iter > 0:
        fitted = laid.fit(als)
        save(fitted, path)
    else:
        fitted = None
        save(als.fit(laid.triples.select("user_id", "item_id", F.col("rating").cast("float").alias("rating"))), path)
        spark.sparkContext._jvm.System.gc()  # the cleaner acts on what the driver's JVM has collected
    if laid is not triples:
        laid.drop()
    model = load(path)
    model.factors_at, model.files = path, fitted and fitted.files
    return model


def discard(model: ALSModel) -> None:
    """Delete the factor tables that ``fit`` has written, after the last use of the model."""
    delete(model.userFactors.sparkSession, model.factors_at)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction``; pairs with a user or item not seen in training are left out."""
    return model.transform(pairs)


def save(model: ALSModel, path: str) -> None:
    """Save a model, replacing one already there."""
    model.write().overwrite().save(path)


def load(path: str) -> ALSModel:
    return ALSModel.load(path).setColdStartStrategy("drop")


def train_and_test(
    triples: DataFrame, test_fraction: float = 0.2, settings: AlsSettings = AlsSettings()
) -> tuple[ALSModel, DataFrame, DataFrame]:
    """Hash split, fit on the rest: the model, the test rows, and the test rows with predictions."""
    parts = split_by_weights(triples, ["user_id", "item_id"], [1 - test_fraction, test_fraction])
    model = fit(parts.where("part = 0"), settings)
    test = parts.where("part = 1").drop("part")
    return model, test, predict(model, test)


def parameter_curves(
    triples: DataFrame,
    settings: Iterable[AlsSettings],
    train_fractions: Sequence[float] = TRAIN_FRACTIONS,
    parallel_fits: int = 4,
) -> DataFrame:
    """Train and test RMSE for every setting at every train fraction.

    The fractions are nested cuts of one hash column over one table, which is laid out once for all fits. A few fits run side
    by side; a fit that differs from a shorter one in its length goes on from it.
    """
    spark = triples.sparkSession
    runs = list(product(settings, train_fractions))
    table = triples.withColumn("_at", key_fraction(["user_id", "item_id"])).persist(StorageLevel.MEMORY_AND_DISK)
    laid = LaidOut(table, "_at")
    if laid.folder is not None:
        table.unpersist()
    cuts = {fraction: laid.below(fraction) for fraction in train_fractions}

    def one(run: tuple[AlsSettings, float]) -> tuple:
        chosen, fraction = run
        model = fit(cuts[fraction], chosen)
        _, train_rmse, _, test_rmse = errors(model, cuts[fraction], table)
        discard(model)
        return chosen.reg, chosen.rank, chosen.max_iter, fraction, train_rmse, test_rmse

    with ThreadPool(parallel_fits) as pool:
        chains = pool.map(lambda chain: [(runs.index(run), one(run)) for run in chain], chained(runs), chunksize=1)
    laid.drop()
    table.unpersist()
    rows = [row for _, row in sorted(chain for found in chains for chain in found)]
    return spark.createDataFrame(
        rows, "reg double, rank int, max_iter int, train_fraction double, train_rmse double, test_rmse double"
    )


def chained(runs: Sequence[tuple[AlsSettings, float]]) -> list[list[tuple[AlsSettings, float]]]:
    """Runs that differ in the number of iterations only, shorter ones first: each goes on from the one before it."""
    chains: dict[tuple, list] = {}
    for chosen, fraction in runs:
        chains.setdefault((replace(chosen, max_iter=0), fraction), []).append((chosen, fraction))
    return [sorted(chain, key=lambda run: run[0].max_iter) for chain in chains.values()]


def errors(model: ALSModel, train: LaidOut, table: DataFrame) -> tuple[int, float | None, int, float | None]:
    """Predicted ratings and their RMSE, of those trained on and of all others in ``table``; only these numbers come to the driver."""
    if model.files is not None:
        return train.errors(model.files, model.rank)
    seen = F.col("_at") < float(train.cut[1:])
    sides = predict(model, table).groupBy(seen.alias("train")).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(squared_error("rating", "prediction"))).alias("rmse")
    )
    found = {row["train"]: (row["n"], row["rmse"]) for row in sides.collect()}  # two rows
    return *found.get(True, (0, None)), *found.get(False, (0, None))


def learning_curve(
    triples: DataFrame,
    settings: AlsSettings = AlsSettings(rank=16, max_iter=20),
    train_fractions: Sequence[float] = TRAIN_FRACTIONS,
) -> DataFrame:
    return parameter_curves(triples, [settings], train_fractions)


def regularisation_scan(
    triples: DataFrame,
    regularisations: Sequence[float] = REGULARISATIONS,
    settings: AlsSettings = AlsSettings(rank=16, max_iter=20),
    train_fractions: Sequence[float] = TRAIN_FRACTIONS,
) -> DataFrame:
    return parameter_curves(triples, [replace(settings, reg=r) for r in regularisations], train_fractions)


def grid_search(
    triples: DataFrame,
    regularisations: Sequence[float],
    ranks: Sequence[int],
    iterations: Sequence[int],
    train_fractions: Sequence[float] = TRAIN_FRACTIONS,
) -> DataFrame:
    cells = [AlsSettings(rank=k, max_iter=i, reg=r) for r, k, i in product(regularisations, ranks, iterations)]
    return parameter_curves(triples, cells, train_fractions)


def lowest_errors(curves: DataFrame, k: int = 6, error: str = "test_rmse", ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` parameter sets with the smallest error at the largest train fraction."""
    # a curve has a few rows per parameter set, so one task can rank them all, and the curves run once
    newest = F.dense_rank().over(Window.orderBy(F.desc("train_fraction")))
    return curves.withColumn("_newest", newest).where("_newest = 1").drop("_newest").orderBy(error, *ties).limit(k)


def rank_search(
    triples: DataFrame,
    ranks: Sequence[int] = TUTORIAL_RANKS,
    settings: AlsSettings = AlsSettings(max_iter=10, nonnegative=False),
    weights: Sequence[float] = (6, 2, 2),
) -> DataFrame:
    """Pick the rank with the least validation error; the winner alone meets the test rows."""
    spark = triples.sparkSession
    parts = split_by_weights(triples, ["user_id", "item_id"], weights).persist(StorageLevel.MEMORY_AND_DISK)

    def error(model: ALSModel, part: int) -> float:
        pairs = predict(model, parts.where(F.col("part") == part))
        return pairs.agg(F.sqrt(F.avg(squared_error("rating", "prediction")))).first()[0]

    models = {rank: fit(parts.where("part = 0"), replace(settings, rank=rank)) for rank in ranks}
    validation = {rank: error(model, 1) for rank, model in models.items()}
    best = min(ranks, key=lambda rank: (validation[rank], rank))
    rows = [(r, validation[r], error(models[r], 2) if r == best else None) for r in ranks]
    for model in models.values():
        discard(model)
    parts.unpersist()
    return spark.createDataFrame(rows, "rank int, validation_rmse double, test_rmse double")

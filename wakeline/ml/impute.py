"""Ship dimensions by regression on the other dimensions.

Ships repeat: a table of any size has few distinct (length, breadth, draught) combinations. The
model is fitted on these with their row counts as weights, which is the same weighted problem as
fitting on all rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.scalar import half_even
from wakeline.operators.evaluate import r_squared
from wakeline.operators.scan import group_percentiles
from wakeline.session import stored

# Target, features, decimals (None keeps the prediction), in the order of the fills.
DIMENSIONS = (
    ("Length", ("Breadth", "Draught"), 0),
    ("Breadth", ("Length", "Draught"), 0),
    ("Draught", ("Length", "Breadth"), None),
)
# Boosting rounds, learning rate and smallest leaf of the regression.
ROUNDS, RATE, LEAF_ROWS = 100, 0.1, 20
LOW_R2 = 0.5


def fill_by_regression(
    df: DataFrame, target: str, features: Sequence[str], decimals: int | None = None, rounds: int = ROUNDS, depth: int = 5, seed: int = 42
) -> tuple[DataFrame, float | None]:
    """Predict the missing values of ``target``; known values stay. Returns the table and R² on the known rows.

    Nothing to fill, or nothing known to learn from, leaves the table as it is (R² ``None``).
    """
    for c in (target, *features):
        if c not in df.columns:
            raise ValueError(f"Column '{c}' not found in dataframe")
    combos = stored(df.groupBy(target, *features).agg(F.count("*").alias("_rows")), "combos")
    known = combos.filter(F.col(target).isNotNull())
    sizes = combos.agg(F.count(F.when(F.col(target).isNull(), 1)).alias("gaps"), F.sum(F.when(F.col(target).isNotNull(), F.col("_rows"))).alias("rows")).first()
    if not sizes["gaps"] or not sizes["rows"]:
        return df, None

    # One number per feature: its median over the known rows.
    cells = known.select("_rows", F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])))
    medians = {r["feature"]: r["m"] for r in group_percentiles(cells, ["feature"], "value", [0.5], ["m"], weight="_rows").collect()}

    def with_inputs(frame: DataFrame) -> DataFrame:
        # Trees here take no nulls: the median stands in, and a flag tells the two apart.
        filled = {f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(float(medians.get(c, 0.0)))) for c in features}
        flags = {f"_gap_{c}": F.col(c).isNull().cast("double") for c in features}
        assembler = VectorAssembler(inputCols=[*filled, *flags], outputCol="_features")
        return assembler.transform(frame.withColumns({**filled, **flags})).drop(*filled, *flags)

    training = with_inputs(known).withColumns({"_label": F.col(target).cast("double"), "_weight": F.col("_rows").cast("double")})
    model = GBTRegressor(
        featuresCol="_features", labelCol="_label", weightCol="_weight", predictionCol="_prediction",
        maxIter=rounds, stepSize=RATE, maxDepth=depth, minInstancesPerNode=1,
        minWeightFractionPerNode=min(0.49, LEAF_ROWS / sizes["rows"]), seed=seed, checkpointInterval=-1,
    ).fit(training)

    r2 = r_squared(model.transform(training), "_label", "_prediction", weight="_weight").first()["r2"]
    if r2 < LOW_R2:
        warnings.warn(f"Low R2 score ({r2:.3f}) for '{target}' - predictions may be unreliable")
    prediction = F.col("_prediction") if decimals is None else half_even(F.col("_prediction"), decimals)
    predicted = model.transform(with_inputs(df)).withColumn(target, F.coalesce(F.col(target).cast("double"), prediction))
    return predicted.drop("_features", "_prediction"), r2


def fill_dimensions(df: DataFrame, dimensions=DIMENSIONS, **options) -> tuple[DataFrame, dict[str, float | None]]:
    """All dimensions in order, each using the ones filled before."""
    df = stored(df, "dimensions")
    scores = {}
    for target, features, decimals in dimensions:
        df, scores[target] = fill_by_regression(df, target, features, decimals, **options)
    return df, scores


def imputer(**options):
    """``fill_dimensions`` as a step of the cleaning plan."""
    return lambda df: fill_dimensions(df, **options)[0]

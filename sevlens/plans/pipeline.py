"""The feature pipeline (F1-F10, H13) as one persistable MLlib ``Pipeline``.

Stages: engineered features -> constant fill -> booleans to int -> median
imputation -> string indexing -> one-hot -> non-finite cleaning -> vector
assembly -> standardisation.  Everything that changes values is *inside* the
pipeline, so a saved ``PipelineModel`` scores new data (batch or stream)
exactly as it transformed the training data; it is fitted on the training split
only.

The three small Transformers are plain projections (JVM expressions, no Python
UDF); their params are JSON-serialisable so ``DefaultParamsWritable`` persists
them and ``PipelineModel.load`` re-creates them from this importable module.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import ImputerModel, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.functions.features import finite_or_zero, incident_feature_columns
from sevlens.operators.windows import select_ranks

# Fixed values of the reference pipeline (column names are our clean aliases).
IMPUTE_COLUMNS = ("Temperature_F", "Wind_Chill_F", "Humidity_Pct", "Pressure_in", "Visibility_mi",
                  "Wind_Speed_mph", "Precipitation_in", "Distance_mi", "Duration_Min")
CATEGORY_FILL = {"Weather_Condition": "Unknown", "Wind_Direction": "Calm", "Sunrise_Sunset": "Day",
                 "Civil_Twilight": "Day", "Timezone": "US/Eastern", "Region": "Unknown",
                 "Climate_Zone": "Unknown"}
INDEX_COLUMNS = ("Wind_Direction", "Weather_Condition", "Sunrise_Sunset", "Timezone", "Region",
                 "Climate_Zone")
ONE_HOT_COLUMNS = ("Sunrise_Sunset", "Timezone", "Region", "Climate_Zone")
BOOL_COLUMNS = ("Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway",
                "Roundabout", "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop")
ENGINEERED_COLUMNS = ("Hour", "DayOfWeek", "Month", "Is_Peak_Hour", "Is_Weekend", "Temp_Risk",
                      "Low_Visibility", "Distance_Bucket", "Is_Night", "Infra_Risk_Score")


class IncidentFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """H1-H12 in one projection; column names are params."""

    startCol = Param(Params._dummy(), "startCol", "start timestamp", TypeConverters.toString)
    endCol = Param(Params._dummy(), "endCol", "end timestamp", TypeConverters.toString)
    temperatureCol = Param(Params._dummy(), "temperatureCol", "temperature", TypeConverters.toString)
    visibilityCol = Param(Params._dummy(), "visibilityCol", "visibility", TypeConverters.toString)
    distanceCol = Param(Params._dummy(), "distanceCol", "distance", TypeConverters.toString)
    daylightCol = Param(Params._dummy(), "daylightCol", "day / night", TypeConverters.toString)

    @keyword_only
    def __init__(self, startCol="Start_Time", endCol="End_Time", temperatureCol="Temperature_F",
                 visibilityCol="Visibility_mi", distanceCol="Distance_mi", daylightCol="Sunrise_Sunset"):
        super().__init__()
        self._setDefault(startCol="Start_Time", endCol="End_Time", temperatureCol="Temperature_F",
                         visibilityCol="Visibility_mi", distanceCol="Distance_mi",
                         daylightCol="Sunrise_Sunset")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return df.withColumns(incident_feature_columns(
            start=g(self.startCol), end=g(self.endCol), temperature=g(self.temperatureCol),
            visibility=g(self.visibilityCol), distance=g(self.distanceCol), daylight=g(self.daylightCol)))


class ConstantFill(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """fill nulls per column with constants (one ``fillna`` projection)."""

    values = Param(Params._dummy(), "values", "JSON object column -> fill value", TypeConverters.toString)

    @keyword_only
    def __init__(self, values: str | None = None):
        super().__init__()
        self._setDefault(values=json.dumps(CATEGORY_FILL))
        kwargs = dict(self._input_kwargs)
        if isinstance(kwargs.get("values"), Mapping):
            kwargs["values"] = json.dumps(dict(kwargs["values"]))
        self._set(**kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fill = {k: v for k, v in json.loads(self.getOrDefault(self.values)).items() if k in df.columns}
        return df.fillna(fill)


class CastColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cast a list of columns (booleans -> int by default)."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to cast", TypeConverters.toListString)
    dataType = Param(Params._dummy(), "dataType", "target type", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols: Sequence[str] = (), dataType: str = "int"):
        super().__init__()
        self._setDefault(inputCols=[], dataType="int")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        t = self.getOrDefault(self.dataType)
        return df.withColumns({c: F.col(c).cast(t) for c in self.getOrDefault(self.inputCols)})


class CleanNumeric(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """null / NaN / +-Inf -> 0.0 on scalar columns before assembly.

    Cleaning before the assembler keeps one bad value from turning a whole
    standardised column into NaN, and it is a codegen'd expression rather than
    a Python UDF over vectors.
    """

    inputCols = Param(Params._dummy(), "inputCols", "columns to clean", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols: Sequence[str] = ()):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: finite_or_zero(c) for c in self.getOrDefault(self.inputCols)})


def clean_vector(df: DataFrame, col: str) -> DataFrame:
    """Vector variant of F9: NaN / +-Inf slots -> 0.0, a null vector stays null."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    arr = F.transform(vector_to_array(col), lambda x: F.when(F.abs(x) < F.lit(float("inf")), x)
                      .otherwise(F.lit(0.0)))
    return df.withColumn(col, F.when(F.col(col).isNull(), F.lit(None)).otherwise(array_to_vector(arr)))


def feature_columns() -> list[str]:
    """Assembler inputs in slot order (0-8 imputed numerics, one-hots, indices, flags, engineered)."""
    return ([f"{c}_imp" for c in IMPUTE_COLUMNS] + [f"{c}_ohe" for c in ONE_HOT_COLUMNS]
            + ["Wind_Direction_idx", "Weather_Condition_idx"] + list(BOOL_COLUMNS)
            + list(ENGINEERED_COLUMNS))


class MedianImputer(Estimator, HasInputCols, HasOutputCols):
    """Median imputation with exact medians (rank ceil(n / 2)) selected by running counts.

    The fitted model is Spark's own ``ImputerModel``, so it saves, loads and transforms as
    one; null and NaN are both missing.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), outputCols: Sequence[str] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ImputerModel:
        cols = list(self.getInputCols())
        stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
                                                for c in cols])).alias("x")).select("x.*")
        medians = {r["column"]: r["value"] for r in select_ranks(stacked, ["column"], "value", [0.5]).collect()}   # a number for each column
        missing = [c for c in cols if c not in medians]
        if missing:
            raise ValueError(f"no value to take a median of in {missing}")
        jvm = df.sparkSession.sparkContext._jvm
        names = ImputerModel._new_java_array(cols, jvm.java.lang.String)
        values = ImputerModel._new_java_array([medians[c] for c in cols], jvm.double)
        model = ImputerModel(ImputerModel._new_java_obj("org.apache.spark.ml.feature.ImputerModel", self.uid, names, values))
        model._set(inputCols=cols, outputCols=list(self.getOutputCols()), strategy="median")
        model._transfer_params_to_java()
        return model


def median_imputer(cols: Sequence[str] = IMPUTE_COLUMNS) -> MedianImputer:
    """median imputation to ``<c>_imp``."""
    return MedianImputer(inputCols=list(cols), outputCols=[f"{c}_imp" for c in cols])


def string_indexers(cols: Sequence[str] = INDEX_COLUMNS) -> StringIndexer:
    """one multi-column indexer (all label tables from a single pass), most
    frequent value first, ties alphabetical; unseen / null -> the extra index n."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols],
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def one_hot(cols: Sequence[str] = ONE_HOT_COLUMNS) -> OneHotEncoder:
    """one-hot of indexed columns; with 'keep' indexing the dropped slot is the unseen one."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols],
                         dropLast=True)


def assembler(cols: Sequence[str] | None = None, out: str = "raw_features") -> VectorAssembler:
    """vector assembly; 'keep' turns a remaining null into NaN instead of failing."""
    return VectorAssembler(inputCols=list(cols or feature_columns()), outputCol=out, handleInvalid="keep")


def scaler(inp: str = "raw_features", out: str = "features") -> StandardScaler:
    """standardise (mean and sample std; a zero-variance slot becomes 0.0)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def build_pipeline(with_features: bool = True, scale: bool = True) -> Pipeline:
    """the full preprocessing pipeline (fit on the training split only)."""
    stages: list = [IncidentFeatures()] if with_features else []
    stages += [ConstantFill(), CastColumns(inputCols=list(BOOL_COLUMNS), dataType="int"),
               median_imputer(), string_indexers(), one_hot(),
               CleanNumeric(inputCols=[c for c in feature_columns() if not c.endswith("_ohe")]),
               assembler()]
    if scale:
        stages.append(scaler())
    return Pipeline(stages=stages)


def slot_names(df: DataFrame, col: str = "raw_features") -> list[str]:
    """names of the vector slots from the assembler's ``ml_attr`` metadata.

    The scaler output carries only a size, so read the assembler column.
    """
    attrs = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = {a["idx"]: a.get("name", f"slot_{a['idx']}") for group in attrs.values() for a in group}
    size = df.schema[col].metadata.get("ml_attr", {}).get("num_attrs", len(slots))
    return [slots.get(i, f"slot_{i}") for i in range(size)]


def save_model(model, path: str) -> None:
    """Persist (overwrite) any MLlib model or pipeline model."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_model(path: str, model_class=PipelineModel):
    """Load a saved model of the given MLlib class (a pipeline model by default)."""
    return model_class.load(path)

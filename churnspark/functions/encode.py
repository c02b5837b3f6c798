"""Encoding, scaling and assembly (E1-E9) as Spark ML stages.

Fitted statistics are stored as ML Params, so a fitted ``PipelineModel``
saves and loads with the standard ML writers.  Every fit is one distributed
aggregate (exact medians via prefix counts; means and population standard
deviations via ``avg`` / ``stddev_pop``; category lists via ``collect_set``
on low-cardinality columns); every transform is column expressions.
"""

from __future__ import annotations

import json
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators.prefix import exact_quantiles, long_form


class _Cols(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    pass


# ---------------------------------------------------------------- E1
class ExactMedianImputerModel(Model, _Cols):
    medians = Param(Params._dummy(), "medians", "learned medians", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, medians=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, med = self.getInputCols(), self.getOrDefault(self.medians)
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(cols, med)})


class ExactMedianImputer(Estimator, _Cols):
    """Median imputation with the exact (interpolated) median; the stock
    ``Imputer`` uses an approximate quantile."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ExactMedianImputerModel:
        cols = self.getInputCols()
        lf = long_form(df, cols).where(F.col("value").isNotNull())
        rows = {r["column"]: r["median"] for r in
                exact_quantiles(lf, ["column"], "value", [0.5], ["median"]).collect()}
        return ExactMedianImputerModel(inputCols=cols, medians=[float(rows[c]) for c in cols])


# ---------------------------------------------------------------- E2, E4, E6
class Log1p(Transformer, _Cols):
    """log1p in place."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumns({c: F.log1p(F.col(c)) for c in self.getInputCols()})


class YesNoEncoder(Transformer, _Cols):
    """No -> 0, Yes -> 1, anything else -> -1 (as double)."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumns({c: F.when(F.col(c) == "No", 0.0).when(F.col(c) == "Yes", 1.0)
                               .otherwise(-1.0) for c in self.getInputCols()})


class CastDouble(Transformer, _Cols):
    """Pass-through flags, as double."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumns({c: F.col(c).cast("double") for c in self.getInputCols()})


# ---------------------------------------------------------------- E3
class PopStandardScalerModel(Model, _Cols):
    means = Param(Params._dummy(), "means", "learned means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "learned population stds", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        cols = self.getInputCols()
        mu, sd = self.getOrDefault(self.means), self.getOrDefault(self.stds)
        return df.withColumns({c: (F.col(c) - m) / (s if s != 0 else 1.0) for c, m, s in zip(cols, mu, sd)})


class PopStandardScaler(Estimator, _Cols):
    """Mean 0 and *population* standard deviation 1 (zero std -> /1);
    the stock ``StandardScaler`` divides by the sample deviation."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        r = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        return PopStandardScalerModel(inputCols=cols, means=[float(r[f"m{i}"]) for i in range(len(cols))],
                                      stds=[float(r[f"s{i}"] or 0.0) for i in range(len(cols))])


# ---------------------------------------------------------------- E5
class OneHotDropFirstModel(Model, _Cols):
    categories = Param(Params._dummy(), "categories", "json: column -> sorted categories",
                       TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, categories=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def cats(self) -> dict:
        return json.loads(self.getOrDefault(self.categories))

    def outputCols(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.cats().items() for v in vs[1:]]

    def _transform(self, df):
        out = {}
        for c, vs in self.cats().items():
            for v in vs[1:]:      # first sorted category dropped; unknown -> all zeros
                # marked, so that the assembler takes no column that merely has such a name
                out[f"{c}_{v}"] = F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)).alias(f"{c}_{v}", metadata={"onehot": c})
        return df.drop(*[c for c in out if c in df.columns]).select("*", *out.values())


class OneHotDropFirst(Estimator, _Cols):
    """E5: one-hot with the first *sorted* category dropped (the stock
    ``OneHotEncoder`` drops the last); unknown values encode to all zeros.

    Columns with more than ``maxCategories`` values are refused: as many
    columns would be made of them, and the driver never sees more values."""

    maxCategories = Param(Params._dummy(), "maxCategories", "values of a column, at most", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, maxCategories=1000):
        super().__init__()
        self._setDefault(maxCategories=1000)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        lf = long_form(df, cols, value_type="string").where(F.col("value").isNotNull())
        most = self.getOrDefault(self.maxCategories)
        got: dict[str, list] = {}
        for r in lf.distinct().limit(most * len(cols) + 1).collect():  # one value more than all columns may have
            got.setdefault(r["column"], []).append(r["value"])
        wide = [c for c, v in got.items() if len(v) > most]
        if wide:
            raise ValueError(f"more than {most} categories in {wide}")
        got = {c: sorted(v, key=lambda x: x.encode()) for c, v in got.items()}
        return OneHotDropFirstModel(inputCols=cols, categories=json.dumps({c: got.get(c, []) for c in cols}))


# ---------------------------------------------------------------- E7
class NamedAssembler(Estimator, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Assemble, in a fixed order, the numeric, binary, one-hot (whatever the
    one-hot stage produced) and pass-through columns into one vector."""

    groups = Param(Params._dummy(), "groups", "json: list of column-name lists or one-hot columns",
                   TypeConverters.toString)

    @keyword_only
    def __init__(self, groups=None, outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = []
        for g in json.loads(self.getOrDefault(self.groups)):
            if isinstance(g, str):       # what the one-hot stage made of column g
                cols += sorted(f.name for f in df.schema.fields if f.metadata.get("onehot") == g)
            else:
                cols += g
        return VectorAssembler(inputCols=cols, outputCol=self.getOutputCol(), handleInvalid="error")


def build_preprocessor(num=S.NUM_PIPE, binary=S.BINARY_PIPE, onehot=S.ONEHOT_PIPE,
                       passthrough=S.PASS_PIPE, output: str = "features") -> Pipeline:
    """Impute -> log1p -> standardize numerics; Yes/No ordinal; one-hot
    drop-first; pass-through flags; assemble (30 wide on the customer table)."""
    groups = [list(num), list(binary), *onehot, list(passthrough)]
    return Pipeline(stages=[
        ExactMedianImputer(inputCols=list(num)), Log1p(inputCols=list(num)),
        PopStandardScaler(inputCols=list(num)), YesNoEncoder(inputCols=list(binary)),
        OneHotDropFirst(inputCols=list(onehot)), CastDouble(inputCols=list(passthrough)),
        NamedAssembler(groups=json.dumps(groups), outputCol=output)])


def feature_names(model) -> list[str]:
    """Names of the assembled vector, in order."""
    return list(model.stages[-1].getInputCols())


# ---------------------------------------------------------------- E8, E9
def check_vectors(*dfs: DataFrame, col: str = "features", width: int = S.N_FEATURES) -> DataFrame:
    """Per input: rows, rows with NaN/null entries, rows of the wrong width."""
    out = None
    for i, df in enumerate(dfs):
        a = vector_to_array(F.col(col))
        r = df.agg(F.lit(i).alias("input"), F.count(F.lit(1)).cast("bigint").alias("rows"),
                   F.count_if(F.exists(a, lambda x: F.isnan(x) | x.isNull())).cast("bigint").alias("bad_values"),
                   F.count_if(F.size(a) != width).cast("bigint").alias("bad_width"))
        out = r if out is None else out.unionByName(r)
    return out


def to_dense(df: DataFrame, col: str = "features", out: str = "features_arr",
             dtype: str = "float64") -> DataFrame:
    """Vector (sparse or dense) -> array<double|float>."""
    return df.withColumn(out, vector_to_array(F.col(col), dtype))

"""Missing values by declared policy, and codes for categories; what is learnt comes from the training part only."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

MARGIN = 1.0
MISSING = "MISSING"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing everywhere in this library, so it becomes null."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})


def sentinels(train: DataFrame, columns: list[str], margin: float = MARGIN) -> DataFrame:
    """One row with each column's sentinel: below its smallest value by its range and a margin.

    A constant column goes below its value by the margin; a column without values has -margin.
    """
    low, high = (lambda c: F.min(c).cast("double")), (lambda c: F.max(c).cast("double"))
    return train.agg(*(F.coalesce(low(c) - (high(c) - low(c)) - margin, F.lit(-margin)).alias(c) for c in columns))


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers to 0 and texts to MISSING."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(c, F.lit(MISSING) if kinds[c] == "string" else F.lit(0)) for c in columns})


def fill_forward(df: DataFrame, columns: list[str], keys: list[str], order: list[str], limit: int) -> DataFrame:
    """The last value of the limit rows before, counted in rows."""
    over = W.partitionBy(*keys).orderBy(*order).rowsBetween(-limit, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(over) for c in columns})


def mark_dropped(df: DataFrame, columns: list[str], name: str = "drop_row") -> DataFrame:
    """Rows stay; the mark says that one of the columns is null."""
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return df.withColumn(name, test)


def fill_sentinel(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items()})


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n_rows, nulls of each column, rows with all and with none of the columns, in one pass."""
    have = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in columns), F.count(F.when(have == len(columns), 1)).alias("n_full"), F.count(F.when(have == 0, 1)).alias("n_empty"))


def fill_note(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column: nulls before and after a policy, and how many it filled."""
    names = ", ".join(f"'{c}', null_{c}" for c in columns)
    a = null_profile(before, columns).selectExpr(f"stack({len(columns)}, {names}) as (column, nulls_before)")
    b = null_profile(after, columns).selectExpr(f"stack({len(columns)}, {names}) as (column, nulls_after)")
    return a.join(b, "column").withColumn("filled", F.col("nulls_before") - F.col("nulls_after"))


def category_codes(train: DataFrame, column: str) -> DataFrame:
    """(column, code): the sorted non-null values of the training part, from 0."""
    return train.select(column).where(F.col(column).isNotNull()).distinct().select(column, (F.row_number().over(W.orderBy(column)) - 1).alias("code"))


def encode(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """df with column_code; values that the codes don't have, and nulls, are -1."""
    return df.join(codes, column, "left").withColumn(f"{column}_code", F.coalesce("code", F.lit(-1))).drop("code")


class _Prepares(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """What a Preparer and the model fitted by it share: numbers and categories to prepare."""

    categories = Param(Params._dummy(), "categories", "columns of texts that become codes", TypeConverters.toListString)
    margin = Param(Params._dummy(), "margin", "how far below a column's range its sentinel lies", TypeConverters.toFloat)

    def __init__(self, numbers: list[str] = [], categories: list[str] = [], margin: float = MARGIN):  # noqa: B006
        super().__init__()
        self._set(inputCols=list(numbers), categories=list(categories), margin=margin)

    @property
    def features(self) -> list[str]:
        """The columns that a learner reads: numbers, and category_code of each category."""
        return [*self.getOrDefault(self.inputCols), *(f"{c}_code" for c in self.getOrDefault(self.categories))]


class Preparer(Estimator, _Prepares):
    """Learns sentinels and category codes from a training part, as a stage of a pipeline."""

    def _fit(self, dataset: DataFrame) -> PreparerModel:
        numbers, categories = self.getOrDefault(self.inputCols), self.getOrDefault(self.categories)
        found = sentinels(dataset, numbers, self.getOrDefault(self.margin)).first().asDict() if numbers else {}
        model = PreparerModel(numbers, categories, self.getOrDefault(self.margin))
        model.fitted = {"sentinels": found, "codes": {c: [r[0] for r in category_codes(dataset, c).orderBy("code").select(F.col(c).cast("string")).collect()] for c in categories}}
        return model


class PreparerModel(Model, _Prepares):
    """Sentinels and codes as they were learnt; saved with a pipeline and replayed wherever it is loaded.

    A category's values come to the driver, so they must be few, as a learner's categories are. A
    model without a column's codes refuses it rather than inventing some.
    """

    fitted: dict = {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, columns = dataset, set(dataset.columns)
        for c in self.getOrDefault(self.categories):
            if c not in self.fitted.get("codes", {}):
                raise ValueError(f"no codes were learnt for {c}")
            code = F.array_position(F.array(*map(F.lit, self.fitted["codes"][c])).cast("array<string>"), F.col(c).cast("string")) - 1
            out = out.withColumn(f"{c}_code", F.coalesce(code, F.lit(-1)).cast("int"))
        lost = [c for c in self.getOrDefault(self.inputCols) if c not in columns]
        if lost:
            raise ValueError(f"columns are missing: {', '.join(lost)}")
        return fill_sentinel(out, self.fitted.get("sentinels", {}))

    def write(self) -> MLWriter:
        return _PreparerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _PreparerReader()


class _PreparerWriter(MLWriter):
    """Params, and the fitted record, as one JSON object in the model's metadata folder, on whatever storage Spark reads."""

    def __init__(self, model: PreparerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"fitted": self.model.fitted})


class _PreparerReader(MLReader):
    def load(self, path: str) -> PreparerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = PreparerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.fitted = metadata["fitted"]
        return model


def flag_text(column: Column) -> Column:
    """A boolean as True or False, nulls kept."""
    return F.initcap(column.cast("string"))

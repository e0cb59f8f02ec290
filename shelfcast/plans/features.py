"""Feature engineering as a Spark ML estimator.

``FeatureEngineer.fit`` learns the three category vocabularies and the
distance fill value from the training frame; ``FeatureEngineerModel`` is a
projection of native column expressions (no UDF; one join for each long vocabulary), so scoring stays in
whole-stage codegen and the fitted model is saved with the pipeline.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import calendar as cal
from shelfcast.operators.clean import ZERO_FILLED, state_holiday_label
from shelfcast.operators.quantiles import exact_median, exact_quantiles

MAX_LABELS = 2_000_000  # a longer vocabulary is refused: the fitted model holds it
LITERAL_LABELS = 256    # a longer one is joined as a table, not held in the plan
CATEGORICAL = ["store_type", "assortment", "state_holiday"]
DROPPED = ["date", "promo_interval", "competition_open_since_month", "competition_open_since_year",
           "promo2_since_week", "promo2_since_year"]
FEATURES = ["store", "day_of_week", "open", "promo", "state_holiday", "school_holiday", "store_type",
            "assortment", "competition_distance", "promo2", "year", "month", "day", "week_of_year",
            "quarter", "is_weekend", "is_month_start", "is_month_mid", "is_month_end", "is_year_start",
            "is_year_end", "days_to_christmas", "days_after_new_year", "days_to_easter", "promo2_active",
            "competition_open_months"]


def fill_defaults(df: DataFrame, distance_fill: Column) -> DataFrame:
    cols = {
        "competition_distance": F.coalesce(F.col("competition_distance").cast("double"), distance_fill),
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_FILLED},
        "promo_interval": F.coalesce(F.col("promo_interval"), F.lit("")),
        "open": F.coalesce(F.col("open"), F.lit(1)),
        "state_holiday": state_holiday_label("state_holiday"),
        "store_type": F.coalesce(F.col("store_type").cast("string"), F.lit("nan")),
        "assortment": F.coalesce(F.col("assortment").cast("string"), F.lit("nan")),
    }
    return df.withColumns(cols)


def label_code(c: str, labels: list[str]) -> Column:
    """Position of the value in the sorted vocabulary (0-based); an unseen value fails the job."""
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(c)).cast("int") - 1
    return F.when(pos >= 0, pos).otherwise(
        F.raise_error(F.concat(F.lit(f"unseen label in {c}: "), F.col(c).cast("string"))).cast("int"))


def with_label_codes(df: DataFrame, vocab: dict[str, list[str]]) -> DataFrame:
    """Each column of ``vocab`` replaced by its code. A short vocabulary is a literal array in the plan, a long one a
    table joined by value (broadcast or shuffled, as its size asks for). An unseen value fails the job."""
    out = df.withColumns({c: label_code(c, labels) for c, labels in vocab.items() if len(labels) <= LITERAL_LABELS})
    for c, labels in vocab.items():
        if len(labels) > LITERAL_LABELS:
            table = pd.DataFrame({c: pd.Series(labels, dtype="string"), "_code": np.arange(len(labels), dtype=np.int32)})
            codes = df.sparkSession.createDataFrame(table, f"`{c}` string, _code int")
            unseen = F.raise_error(F.concat(F.lit(f"unseen label in {c}: "), F.col(c))).cast("int")
            out = out.join(codes, c, "left").withColumn(c, F.coalesce("_code", unseen)).select(df.columns)
    return out


def engineer(df: DataFrame, vocab: dict[str, list[str]], distance_fill: float | Column,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """fill -> date features -> encode -> promo2 flag -> competition months -> drop.

    ``keep`` names source columns to carry through (e.g. ``date`` as a row key).
    """
    fill = distance_fill if isinstance(distance_fill, Column) else F.lit(float(distance_fill))
    out = fill_defaults(df, fill)
    out = out.withColumns(cal.date_feature_columns("date"))
    out = with_label_codes(out, {c: vocab[c] for c in CATEGORICAL})
    out = out.withColumn("promo2_active", cal.promo2_active("promo2", "promo_interval", "month"))
    out = out.withColumn("competition_open_months",
                         cal.competition_open_months("year", "month", "competition_open_since_year",
                                                     "competition_open_since_month"))
    return out.drop(*[c for c in DROPPED if c in out.columns and c not in keep])


class _FEParams(Params):
    vocabulary = Param(Params._dummy(), "vocabulary", "JSON map column -> sorted labels",
                       typeConverter=TypeConverters.toString)
    distanceFill = Param(Params._dummy(), "distanceFill", "fill value for competition_distance",
                         typeConverter=TypeConverters.toFloat)
    keepColumns = Param(Params._dummy(), "keepColumns", "source columns carried through unchanged",
                        typeConverter=TypeConverters.toListString)


class FeatureEngineerModel(Model, _FEParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, vocabulary: str = "{}", distanceFill: float = 0.0, keepColumns: list | None = None):
        super().__init__()
        self._setDefault(keepColumns=[])
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def vocab(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault(self.vocabulary))

    def _transform(self, df: DataFrame) -> DataFrame:
        return engineer(df, self.vocab(), self.getOrDefault(self.distanceFill),
                        tuple(self.getOrDefault(self.keepColumns)))


class FeatureEngineer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns category vocabularies (sorted, like a label encoder) and the distance median.

    The reference recomputes the median on each scored batch; here it is fitted
    once, so a row's score does not depend on the batch it arrives in.
    """

    keepColumns = Param(Params._dummy(), "keepColumns", "source columns carried through unchanged",
                        typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, keepColumns: list | None = None):
        super().__init__()
        self._setDefault(keepColumns=[])
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> FeatureEngineerModel:
        filled = fill_defaults(df, F.lit(None).cast("double"))
        cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in CATEGORICAL])
        rows = filled.select(F.explode(cells).alias("x")).select("x.*").distinct() \
            .limit(len(CATEGORICAL) * MAX_LABELS + 1).collect()
        vocab = {c: sorted(r["v"] for r in rows if r["c"] == c) for c in CATEGORICAL}
        for c, labels in vocab.items():
            if len(labels) > MAX_LABELS:
                raise ValueError(f"{c} has more than {MAX_LABELS} labels: not a category")
        # one (value, count) pair per distinct distance, at most one per store
        pairs = df.groupBy("competition_distance").agg(F.count(F.lit(1)).alias("_n"))
        med = exact_median(pairs, "competition_distance", weight="_n").first()[0]
        if med is None:
            raise ValueError("competition_distance has no value in the training rows: no fill can be learned")
        return FeatureEngineerModel(vocabulary=json.dumps(vocab), distanceFill=float(med),
                                    keepColumns=list(self.getOrDefault(self.keepColumns)))


class _ImputerParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to fill", typeConverter=TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "filled columns", typeConverter=TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "JSON map column -> median", typeConverter=TypeConverters.toString)


class MedianImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols: list | None = None, outputCols: list | None = None, medians: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        med = json.loads(self.getOrDefault(self.medians))
        pairs = zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols))
        return df.withColumns({o: F.coalesce(_value(c), F.lit(med[c])) for c, o in pairs})


class MedianImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """P4 in a pipeline: nulls and NaN become the column's exact median over the training rows.

    All medians come from one pass (``exact_quantiles``); a column without values is an error."""

    @keyword_only
    def __init__(self, inputCols: list | None = None, outputCols: list | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        cols = self.getOrDefault(self.inputCols)
        return MedianImputerModel(inputCols=cols, outputCols=self.getOrDefault(self.outputCols),
                                  medians=json.dumps(column_medians(df.select(*[_value(c).alias(c) for c in cols]), cols)))


def _value(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def column_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact medians of several columns in one pass (one number per column reaches the driver)."""
    found = {r["column"]: r["quantile"] for r in exact_quantiles(df, cols).collect()}
    empty = [c for c in cols if found.get(c) is None]
    if empty:
        raise ValueError(f"columns without any value have no median: {empty}")
    return found


def label_encode(train: DataFrame, df: DataFrame) -> DataFrame:
    """P3 on its own: codes learnt on ``train`` applied to ``df``."""
    model = FeatureEngineer().fit(train)
    vocab = model.vocab()
    filled = fill_defaults(df, F.lit(0.0))
    coded = with_label_codes(filled.select("store", "date", *CATEGORICAL), vocab)
    return coded.select("store", "date", *[F.col(c).alias(f"{c}_code") for c in CATEGORICAL])


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact column medians (distributed, one pass) used to fill nulls."""
    med = column_medians(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c])) for c in cols})


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: (x - mean) / population std; zero variance maps to 0 (as sklearn)."""
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])
    out = {}
    for c in cols:
        m = stats.select(f"m_{c}").scalar()
        s = stats.select(f"s_{c}").scalar()
        out[c] = F.coalesce(F.try_divide(F.col(c).cast("double") - m, F.when(s != 0, s)), F.lit(0.0))
    return df.withColumns(out)

"""Feature preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    MinMaxScaler,
    MinMaxScalerModel,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame


def resolve_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The table's spelling of each name, ignoring case; a name that is not there is an error."""
    spelling = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in spelling]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return [spelling[n.lower()] for n in names]


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    """Collect columns into a vector; ``handle_invalid`` is error, skip or keep (NaN)."""
    inputs = resolve_columns(df, columns)
    assembler = VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid=handle_invalid)
    return assembler.transform(df.drop(output))


def minmax_scale(
    df: DataFrame, column: str = "features", output: str = "scaled_features"
) -> tuple[DataFrame, MinMaxScalerModel]:
    """Scale each feature to [0, 1]; returns the table and the fitted scaler."""
    model = MinMaxScaler(inputCol=column, outputCol=output).fit(df)
    return model.transform(df), model


def standard_scale(
    df: DataFrame, column: str = "features", output: str = "scaled_features", with_mean: bool = False
) -> tuple[DataFrame, StandardScalerModel]:
    """Divide each feature by its standard deviation; the mean stays unless asked for."""
    model = StandardScaler(inputCol=column, outputCol=output, withMean=with_mean, withStd=True).fit(df)
    return model.transform(df), model


def index_categories(df: DataFrame, columns: Sequence[str], suffix: str = "_indexed") -> Pipeline:
    """Codes by falling frequency; missing and unseen values share one further code."""
    names = resolve_columns(df, columns)
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=names, outputCols=[n + suffix for n in names], handleInvalid="keep"
            )
        ]
    )


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Codes in alphabetical order."""
    names = resolve_columns(df, columns)
    indexer = StringIndexer(
        inputCols=names, outputCols=[n + suffix for n in names], stringOrderType="alphabetAsc",
        handleInvalid="error",
    )
    return indexer.fit(df).transform(df)

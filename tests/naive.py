"""The same features the long way: one filter, one group-by and one left join per feature.

Used as the yardstick for results (tests) and for time (bench).
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spineloom.recipe import Aggregation, Encoding, definitions

SQL_NAME = {"sum": "sum", "mean": "avg", "count": "count", "stddev": "stddev_samp", "min": "min", "max": "max"}


def clean(df: DataFrame, rules) -> DataFrame:
    for rule in rules:
        if rule.column not in df.columns:
            continue
        if rule.add_indicator:
            df = df.withColumn(f"{rule.column}_was_null", F.expr(f"int(`{rule.column}` is null)"))
        if rule.strategy == "drop":
            df = df.where(f"`{rule.column}` is not null")
        else:
            value = rule.fill_value
            if rule.strategy == "median_impute":
                (value,) = df.approxQuantile(rule.column, [0.5], 0.0)
            df = df.na.fill({rule.column: value})
    return df


def latest(df: DataFrame, key: str, date: str, column: str) -> DataFrame:
    newest_first = Window.partitionBy(key).orderBy(F.desc_nulls_last(date), F.desc(column))
    named = df.where(F.col(column).isNotNull()).withColumn("nth", F.row_number().over(newest_first))
    return df.select(key).distinct().join(named.where("nth = 1").select(key, column), key, "left")


def one_feature(df: DataFrame, feature, key: str, date: str, run_date: str) -> DataFrame:
    def window(days):
        return df if days is None else df.where(f"`{date}` >= date_sub(date'{run_date}', {days})")

    column = feature.source_column
    if isinstance(feature, Aggregation):
        value = F.expr(f"{SQL_NAME[feature.function]}(`{column}`)")
        return window(feature.window_days).groupBy(key).agg(value.alias(feature.name))
    if isinstance(feature, Encoding):
        entities = latest(df, key, date, column)
        if feature.method == "frequency":
            total = df.count()
            shares = df.groupBy(column).agg((F.count("*") / total).alias(feature.name))
            return entities.join(shares, column, "left").select(key, feature.name)
        indexer = StringIndexer(inputCol=column, outputCol=feature.name, handleInvalid="keep")
        return indexer.fit(df).transform(entities).select(key, feature.name)
    if feature.feature_type == "days_diff":
        return df.groupBy(key).agg(F.expr(f"datediff(date'{run_date}', max(`{date}`))").alias(feature.name))
    if feature.feature_type == "rolling_mean":
        return window(feature.window_days or 7).groupBy(key).agg(F.expr(f"avg(`{column}`)").alias(feature.name))
    days = feature.window_days or 30
    points = window(days).selectExpr(
        f"`{key}`",
        f"double(datediff(`{date}`, date_sub(date'{run_date}', {days}))) as x",
        f"double(`{column}`) as y",
    )
    sums = points.groupBy(key).agg(
        F.expr("count(*) as n"),
        F.expr("sum(x) as sx"),
        F.expr("sum(y) as sy"),
        F.expr("sum(x * y) as sxy"),
        F.expr("sum(x * x) as sxx"),
    )
    slope = "case when n * sxx - sx * sx != 0 then (n * sxy - sx * sy) / (n * sxx - sx * sx) else 0.0D end"
    return sums.selectExpr(f"`{key}`", f"{slope} as `{feature.name}`")


def naive_features(df: DataFrame, specs, key: str, date: str, run_date: str) -> DataFrame:
    result = df.select(key).distinct()
    for recipe in definitions(specs, key):
        cleaned = clean(df, recipe.null_handlers)
        for feature in recipe.features:
            result = result.join(one_feature(cleaned, feature, key, date, run_date), key, "left")
    return result

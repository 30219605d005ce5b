"""Crop statistics: cleaning, pivot, revenue and the best crop of a county-year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldseason.functions.columns import named
from fieldseason.functions.crops import CROP_NAMES, normalise_crop, parse_statistic
from fieldseason.schemas import STATISTICS


def clean_crops(raw: DataFrame) -> DataFrame:
    """Rows that name state, county, commodity and statistic, with number and year parsed."""
    kept = raw.dropna(subset=["state", "countyFips", "commodity", "statisticCat"])
    return kept.withColumns({
        "parsedValue": F.expr(parse_statistic("value")),
        "year": F.expr("try_cast(year as int)"),
    })


def crop_records(raw: DataFrame) -> DataFrame:
    """One row per year, county and crop with a column per statistic.

    Repeated statistics, which the key does not rule out, resolve to the largest.
    """
    return (
        clean_crops(raw)
        .groupBy(
            "year", F.col("state").alias("stateCode"), "countyFips",
            F.col("commodity").alias("cropName"),
        )
        .agg(*named(**{
            column: f"max(case when statisticCat = '{name}' then parsedValue end)"
            for name, column in STATISTICS.items()
        }))
    )


def crop_breakdown(records: DataFrame, column: str) -> DataFrame:
    return records.groupBy(column).agg(F.count("*").alias("count")).orderBy(column)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """``df`` itself, or an error when it has no row. Reads until the first row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def crop_profitability(records: DataFrame) -> DataFrame:
    """Revenue per acre, null while yield or price is unknown."""
    return records.selectExpr(
        "year", "countyFips", "stateCode",
        f"{normalise_crop('cropName')} as crop",
        "yieldBuAcre * priceUsdBu as revenueUsdAcre",
        "yieldBuAcre", "priceUsdBu",
    )


def optimal_mix(profitability: DataFrame, annual: DataFrame | None = None) -> DataFrame:
    """Crop with the highest revenue per county-year, beside its season summary.

    No scoring formula is published for this table. Here a crop's score is its share
    of the county-year's known revenue per acre; ties go to the alphabetically first
    crop, and a county-year without any revenue has neither scores nor a crop.
    ``annual`` is a season table with ``year``, ``countyFips`` and ``stateCode``, one row
    for each; a second row for a county-year fails at run time (see ``gold.county_seasons``).
    """
    keys = ["year", "countyFips", "stateCode"]
    top = f"greatest({', '.join(CROP_NAMES)})"
    total = " + ".join(f"coalesce({crop}, 0D)" for crop in CROP_NAMES)
    best = " ".join(f"when {crop} = {top} then '{crop}'" for crop in CROP_NAMES)
    scores = zip(CROP_NAMES, ("cornScore", "soybeanScore", "wheatScore"), strict=True)
    mix = (
        profitability.filter("crop is not null")
        .groupBy(*keys)
        .agg(*named(**{
            crop: f"max(case when crop = '{crop}' then revenueUsdAcre end)" for crop in CROP_NAMES
        }))
        .selectExpr(
            *keys,
            f"case {best} end as recommendedCrop",
            *[
                f"case when {top} is not null then"
                f" try_divide(coalesce({crop}, 0D), {total}) end as {score}"
                for crop, score in scores
            ],
            f"{top} as topCropRevenue",
        )
    )
    if annual is None:
        return mix
    # A window leaves the wide rows as they are; a grouping would compare and copy them whole.
    counted = annual.withColumn("_rows", F.count("*").over(Window.partitionBy(*keys)))
    several = F.raise_error(F.concat_ws(" ", F.lit("several season rows for"), *keys))
    single = F.when(F.col("_rows") == 1, F.struct(*annual.columns)).otherwise(several)
    summary = counted.select(*keys, single.alias("weatherSummary"))
    return mix.join(summary, keys, "left")

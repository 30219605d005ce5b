"""Row shapes of the stored tables."""

from pyspark.sql import types as T

from fieldseason.functions.calendar import PHASES

# The five daily elements of the observation source.
ELEMENTS = ("TMAX", "TMIN", "PRCP", "SNOW", "SNWD")
TEMPERATURES = ("TMAX", "TMIN")

# Statistic categories of the crop source and their wide columns.
STATISTICS = {
    "YIELD": "yieldBuAcre",
    "PRICE RECEIVED": "priceUsdBu",
    "AREA HARVESTED": "areaHarvested",
}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

OBSERVATIONS = _struct(stationId=_S, date=_S, dataType=_S, value=_D, attributes=_S)

CROP_STATISTICS = _struct(
    year=_S, state=_S, countyName=_S, countyFips=_S,
    commodity=_S, statisticCat=_S, unit=_S, value=_S,
)

STATIONS = _struct(id=_S, name=_S, latitude=_D, longitude=_D, minDate=_S, maxDate=_S)

DAILY = _struct(
    stationId=_S, date=T.DateType(),
    tempMaxF=_D, tempMinF=_D, tempAvgF=_D, precipIn=_D, snowIn=_D, snowDepthIn=_D,
    qualityFlag=_S, tempSource=_S, tempStationId=_S, tempStationName=_S,
    month=_I, season=_S, **{w.key: _B for w in PHASES},
)

_L = T.LongType()

#: Readings of a date counted by value; season totals of a part of the year (see ``gold.segment_totals``).
COUNTS = _struct(date=_S, element=_S, reading=_D, n=_L)

SEGMENT_TOTALS = _struct(
    stationId=_S, year=_I, segment=_I, gdd=_L, gddParts=_L, precip=_L, precipParts=_L, snow=_L, snowParts=_L,
    temp=_L, tempParts=_L, frostFree=_L, heat=_L, tempDays=_L, days=_I,
)

#: Updates of stored layers: ``ready`` once written aside, ``done`` once in place.
JOURNAL = _struct(update=_S, state=_S)

CROP_RECORDS = _struct(
    year=_I, stateCode=_S, countyFips=_S, cropName=_S,
    yieldBuAcre=_D, priceUsdBu=_D, areaHarvested=_D,
)

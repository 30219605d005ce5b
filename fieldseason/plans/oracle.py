"""DuckDB texts that state each registered query's result from the same tables."""

from __future__ import annotations

from fieldseason.operators.gold import METRICS, wide_column
from fieldseason.functions.calendar import PHASES, WINDOWS
from fieldseason.plans import queries as q
from fieldseason.sources import fixtures

_ELEMENTS = ("TMAX", "TMIN", "PRCP", "SNOW", "SNWD")


def _element(name: str) -> str:
    return f"max(case when dataType = '{name}' then value end)"


def _half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half away from zero, in units of the last digit."""
    return (
        f"(case when ({num} < 0) <> ({den} < 0) then -1 else 1 end"
        f" * ((2 * abs({num}) * {10**digits} + abs({den})) // nullif(2 * abs({den}), 0)))"
    )


def _decimal(num: str, den: str, digits: int) -> str:
    return f"cast({_half_up(num, den, digits)} as double) / {float(10**digits)}"


def _text_round(value: str, digits: int) -> str:
    """Half up on the shortest decimal text of a double, as text."""
    return f"cast(cast(cast({value} as varchar) as decimal(30, {digits})) as varchar)"


def _to_fixed(value: str, digits: int) -> str:
    step = 2 ** (digits + 1)
    tie = f"abs({value}) * {step} % 2 = 1"
    return (
        f"printf('%.{digits}f', case when {tie} then {value} + sign({value}) / {10 ** (digits + 1)}.0"
        f" else {value} end)"
    )


_SUSPECT = "coalesce(trim(split_part(attributes, ',', 2)) <> '', false)"
_LEAP = "(year % 4 = 0 and year % 100 <> 0) or year % 400 = 0"
_EXPECTED = f"case when year is null then null when {_LEAP} then 366 else 365 end"
_YEAR = "try_cast(substring(date, 1, 4) as integer)"


def _covered(days: str) -> str:
    return (
        f"round({days} * 100.0 / expectedDays, 1) as coveragePct,"
        f" case when {days} < expectedDays * 0.5 then 'SPARSE'"
        f" when {days} < expectedDays * 0.9 then 'INCOMPLETE' else 'OK' end as coverageStatus"
    )


def _extreme() -> str:
    parts = []
    for element, low, high in q.LIMITS:
        outside = " or ".join(
            ([f"value < {low}"] if low is not None else []) + [f"value > {high}"]
        )
        parts.append(f"(dataType = '{element}' and ({outside}))")
    return " or ".join(parts)


_PHASE_SQL = {
    "cornPlanting": "(m = 4 and d >= 20) or (m = 5 and d <= 15)",
    "cornGrowing": "m between 5 and 9",
    "cornHarvest": "m in (9, 10)",
    "soybeanPlanting": "m = 5 or (m = 6 and d <= 10)",
    "soybeanGrowing": "m between 5 and 10",
    "soybeanHarvest": "(m = 9 and d >= 20) or m = 10",
    "wheatPlanting": "(m = 9 and d >= 20) or m = 10",
    "wheatGrowing": "(m = 9 and d >= 20) or m >= 10 or m <= 6",
    "wheatHarvest": "m = 6 or (m = 7 and d <= 10)",
}
_SEASON_SQL = """case when (m = 3 and d >= 20) or m in (4, 5) or (m = 6 and d <= 20) then 'Spring'
    when (m = 6 and d >= 21) or m in (7, 8) or (m = 9 and d <= 22) then 'Summer'
    when (m = 9 and d >= 23) or m in (10, 11) or (m = 12 and d <= 20) then 'Autumn'
    else 'Winter' end"""
_PHASES = ", ".join(f"({rule}) as {key}" for key, rule in _PHASE_SQL.items())

_DAILY_COLUMNS = (
    "stationId, date, tempMaxF, tempMinF, tempAvgF, precipIn, snowIn, snowDepthIn, qualityFlag,"
    " tempSource, tempStationId, tempStationName, month, season, " + ", ".join(_PHASE_SQL)
)


def _pool(where: str = "true") -> str:
    return f"""select date,
      quantile_disc(case when dataType = 'TMAX' and {where} then value end, 0.5) as poolTMAX,
      quantile_disc(case when dataType = 'TMIN' and {where} then value end, 0.5) as poolTMIN
    from obs group by date"""


def _supp(station: str) -> str:
    return f"""select date, {_element('TMAX')} as suppTMAX, {_element('TMIN')} as suppTMIN
    from obs where stationId = '{station}' group by date"""


_QUALITY = f"""select stationId, date, max({_SUSPECT}) as anySuspect, count(value) as presentCount,
      case when count(value) = 0 then 'MISSING' when max({_SUSPECT}) then 'SUSPECT' else 'OK' end
        as qualityFlag
    from obs group by stationId, date"""
_WIDE = "select stationId, date, " + ", ".join(
    f"{_element(e)} as {e}" for e in _ELEMENTS
) + " from obs group by stationId, date"

_FILLED = """select w.*, q.qualityFlag, p.poolTMAX, p.poolTMIN, s.suppTMAX, s.suppTMIN,
      coalesce(TMAX, poolTMAX, suppTMAX) as maxC, coalesce(TMIN, poolTMIN, suppTMIN) as minC
    from wide w join quality q on w.stationId = q.stationId and w.date = q.date
    left join pool p on w.date = p.date left join supp s on w.date = s.date"""


def _sourced(supplemental: str, supplemental_name: str) -> str:
    return f"""select f.*,
      case when TMAX is not null and TMIN is not null then 'anchor'
           when poolTMAX is not null and poolTMIN is not null then 'pool'
           when suppTMAX is not null and suppTMIN is not null then 'supplemental'
           else 'mixed' end as tempSource,
      case when TMAX is not null then stationId when poolTMAX is not null then 'pool_median'
           when suppTMAX is not null then {supplemental} end as tempStationId,
      case when TMAX is not null then replace(stationId, 'GHCND:ST', 'Station ')
           when poolTMAX is not null then 'Pool Median'
           when suppTMAX is not null then {supplemental_name} end as tempStationName
    from filled f"""


_DAILY_ALL = f"""select {_DAILY_COLUMNS} from (
      select stationId, cast(date as date) as date,
        maxC * 9.0 / 5.0 + 32.0 as tempMaxF, minC * 9.0 / 5.0 + 32.0 as tempMinF,
        (maxC + minC) / 2.0 * 9.0 / 5.0 + 32.0 as tempAvgF,
        PRCP / 25.4 as precipIn, SNOW / 25.4 as snowIn, SNWD / 25.4 as snowDepthIn,
        qualityFlag, tempSource, tempStationId, tempStationName,
        cast(m as integer) as month, {_SEASON_SQL} as season, {_PHASES}
      from (select *, month(cast(date as date)) as m, day(cast(date as date)) as d from sourced)
    )"""

_GDD = "greatest(0.0, (least(tempMaxF, 86.0) + greatest(tempMinF, 50.0)) / 2.0 - 50.0)"


def _qualified(source: str) -> str:
    return f"""select * from {source} where qualityFlag <> 'SUSPECT'
      and tempMaxF is not null and tempMinF is not null"""


_WINDOW_ROWS = ", ".join(f"('{w.key}', {w.first}, {w.last})" for w in WINDOWS)


def _sum(value: str) -> str:
    return f"coalesce(sum(cast({value} as decimal(24, 12))), 0)"


_TOTALS = f"""select y.stationId, y.year, w.win,
      {_sum(f'case when tempMaxF is not null then {_GDD} end')} as g, {_sum('coalesce(precipIn, 0)')} as p, {_sum('coalesce(snowIn, 0)')} as s,
      {_sum('tempAvgF')} as t, count(tempAvgF) as tn,
      count(case when tempMinF > 32.0 then 1 end) as ff,
      count(case when tempMaxF > 95.0 then 1 end) as hs
    from (select distinct stationId, year(date) as year from qualified) y
    cross join (values {_WINDOW_ROWS}) w(win, f, l)
    left join qualified d on d.stationId = y.stationId and year(d.date) = y.year and
      case when f <= l then month(d.date) * 100 + day(d.date) between f and l
           else month(d.date) * 100 + day(d.date) >= f or month(d.date) * 100 + day(d.date) <= l end
    group by y.stationId, y.year, w.win"""
_CENTS = """select *, cast(round(p, 2) * 100 as bigint) as pc from totals"""
_MEANS = """select *, sum(pc) over (partition by stationId, win) as ps,
      count(*) over (partition by stationId, win) as pn from cents"""
_LONG = f"""select stationId, cast(year as integer) as year, win as "window",
      cast(round(g, 1) as double) as gdd, cast(pc as double) / 100.0 as precipIn,
      cast(ff as integer) as frostFreeDays, cast(hs as integer) as heatStressDays,
      coalesce({_decimal('cast(t * 1000000 as hugeint)', 'cast(tn * 1000000 as hugeint)', 1)}, 0.0) as avgTempF,
      cast(round(s, 2) as double) as snowIn,
      {_decimal('(pn * pc - ps)', 'ps', 4)} as droughtIndex
    from means"""
_GOLD_COLUMNS = ", ".join(
    f"""max(case when "window" = '{w.key}' then {m} end) as {wide_column(w.key, m)}"""
    for w in WINDOWS
    for m in METRICS
)
_GOLD = f"""select stationId, year, '001' as countyFips, 'NE' as stateCode, {_GOLD_COLUMNS}
    from long group by stationId, year"""

_VALIDATION_BODY = """count(*) as totalRows,
      count(case when tempAvgF is null then 1 end) as nullTempRows,
      count(case when tempSource = 'anchor' then 1 end) as srcAnchor,
      count(case when tempSource = 'pool' then 1 end) as srcPool,
      count(case when tempSource = 'supplemental' then 1 end) as srcSupplemental,
      count(case when qualityFlag = 'OK' then 1 end) as qfOk,
      count(case when qualityFlag = 'SUSPECT' then 1 end) as qfSuspect,
      count(case when qualityFlag = 'MISSING' then 1 end) as qfMissing,
      count(case when tempMaxF < tempMinF then 1 end) as outInversion,
      count(case when tempMaxF > 115.0 then 1 end) as outTempMaxHigh,
      count(case when tempMinF < -40.0 then 1 end) as outTempMinLow,
      count(case when precipIn > 6.0 then 1 end) as outPrecipHigh"""


def _validation(keys: str, source: str) -> str:
    return f"""select *, {_covered('totalRows')} from (
      select {keys}, cast({_EXPECTED} as integer) as expectedDays, {_VALIDATION_BODY}
      from (select *, cast(year(date) as integer) as year from {source}) group by {keys})"""


_REPORT = f"""select c.*, coalesce(i.inversions, 0) as inversions,
      coalesce(e.extremeVals, 0) as extremeVals
    from coverage c
    left join inversions i on c.stationId = i.stationId and c.year = i.year
    left join extremes e on c.stationId = e.stationId and c.year = e.year"""

_NEWER = f"""select stationId, date, dataType, value * 2 as value, attributes from base
    where date >= '{q.NEW_FROM}'"""
_OLD = f"select * from base where date <= '{q.OLD_UNTIL}'"
_SAME_KEY = "a.stationId = b.stationId and a.date = b.date and a.dataType = b.dataType"


def _single(rows: str) -> str:
    """One row per key: the largest value that is known."""
    return f"""(select stationId, date, dataType, value, attributes from (select *, row_number() over (
        partition by stationId, date, dataType order by value desc nulls last, attributes desc nulls last) as rn
      from {rows}) where rn = 1)"""


def _kept(old: str, new: str) -> str:
    """Stored rows, and of the new ones what is no reading for a reading."""
    return f"""select * from {old} union all select a.* from {_single(new)} a
      where not exists (select 1 from {old} b where {_SAME_KEY})
        or (a.value is not null and not exists (select 1 from {old} b where {_SAME_KEY} and b.value is not null))"""


def _replaced(old: str, new: str) -> str:
    """New readings for stored rows; new nulls only where nothing is stored."""
    return f"""select * from {old} a where not exists (
        select 1 from {new} b where {_SAME_KEY} and b.value is not null)
      union all select a.* from {_single(new)} a where a.value is not null
        or not exists (select 1 from {old} b where {_SAME_KEY})"""


_PARTS = {
    "obs": fixtures.OBS.format(lineitem="lineitem"),
    "crops": fixtures.CROPS.format(orders="orders"),
    "stations": fixtures.STATIONS.format(supplier="supplier"),
    "quality": _QUALITY,
    "wide": _WIDE,
    "pool": _pool(),
    "supp": _supp(fixtures.SUPPLEMENTAL),
    "filled": _FILLED,
    "sourced": _sourced(f"'{fixtures.SUPPLEMENTAL}'", f"'{fixtures.SUPPLEMENTAL_NAME}'"),
    "daily_all": _DAILY_ALL,
    "daily": f"select * from daily_all where stationId = '{fixtures.ANCHOR}'",
    "qualified": _qualified("daily"),
    "totals": _TOTALS,
    "cents": _CENTS,
    "means": _MEANS,
    "long": _LONG,
    "gold_all": _GOLD,
    "gold": "select * exclude (stationId) from gold_all",
    "validation": _validation("year", "daily"),
    "coverage": f"""select *, {_covered('activeDays')} from (
      select stationId, year, count(distinct date) as activeDays,
        cast({_EXPECTED} as integer) as expectedDays
      from (select *, {_YEAR} as year from obs) group by stationId, year)""",
    "inversions": f"""select stationId, {_YEAR} as year, count(*) as inversions
      from wide where TMAX < TMIN group by all""",
    "extremes": f"""select stationId, {_YEAR} as year, count(*) as extremeVals
      from obs where value is not null and ({_extreme()}) group by all""",
    "report": _REPORT,
    "records": """select try_cast(year as integer) as year, state as stateCode, countyFips,
        commodity as cropName,
        max(case when statisticCat = 'YIELD' then v end) as yieldBuAcre,
        max(case when statisticCat = 'PRICE RECEIVED' then v end) as priceUsdBu,
        max(case when statisticCat = 'AREA HARVESTED' then v end) as areaHarvested
      from (select *, try_cast(replace(trim(value), ',', '') as double) as v from crops
            where state is not null and countyFips is not null and commodity is not null
              and statisticCat is not null)
      group by all""",
    "profit": """select year, countyFips, stateCode,
        case cropName when 'CORN' then 'Corn' when 'SOYBEANS' then 'Soybeans'
          when 'WHEAT' then 'Wheat' end as crop,
        yieldBuAcre * priceUsdBu as revenueUsdAcre, yieldBuAcre, priceUsdBu from records""",
}
_SILVER = ("obs", "quality", "wide", "pool", "supp", "filled", "sourced", "daily_all")
_ANCHOR = (*_SILVER, "daily")
_SEASON = ("qualified", "totals", "cents", "means", "long")
_ALL_SEASON = ("qualified_all", *_SEASON[1:])
_REPORTED = ("obs", "wide", "coverage", "inversions", "extremes", "report")


def _sql(body: str, parts, **replaced: str) -> str:
    texts = {**_PARTS, **replaced}
    return "with " + ",\n".join(f"{name} as ({texts[name]})" for name in parts) + "\n" + body


def _anchor(body: str, **replaced: str) -> str:
    return _sql(body, _ANCHOR, **replaced)


def _all_stations(body: str) -> str:
    return _sql(body, _SILVER)


def _season(body: str, **replaced: str) -> str:
    return _sql(body, (*_ANCHOR, *_SEASON), **replaced)


def _season_all(body: str) -> str:
    return _sql(body, (*_SILVER, *_SEASON), qualified=_qualified("daily_all"))


def _gold(body: str, parts=(), **replaced: str) -> str:
    return _sql(body, (*parts, *_ANCHOR, *_SEASON, "gold_all", "gold"), **replaced)


def _updated(body: str, obs: str) -> str:
    """A statement about all stations over the observations after an update."""
    return _sql(
        body, ("base", "old", "newer", *_SILVER, *_SEASON),
        base=_PARTS["obs"], old=_OLD, newer=_NEWER, obs=obs, qualified=_qualified("daily_all"))


_MIX = """from (
                 select year, countyFips, stateCode, max(revenueUsdAcre) as top,
                   max(crop) filter (where rn = 1 and revenueUsdAcre is not null) as recommendedCrop
                 from (select *, row_number() over (partition by year, countyFips, stateCode
                         order by revenueUsdAcre desc nulls last, crop) as rn from profit)
                 group by year, countyFips, stateCode) m"""
_PROFILE = """select stationId, date, dataType, value, attributes, count(*) as n from {}
    group by stationId, date, dataType, value, attributes"""
_COUNTS = """select count(*) as rowsBefore, count(*) filter (where {0}) as rowsDeleted,
    count(*) filter (where not ({0})) as rowsRemaining from obs"""
_UPSERTED = """select stationId, date, dataType, value, count(*) as n from ({})
    group by stationId, date, dataType, value"""
_UNREAD = """select stationId, date, dataType,
    case when substring(date, 10, 1) <> '{1}' then value end as value, attributes from {0}"""
_UNPIVOTED = " union all ".join(
    f"""select stationId, date, '{e}' as dataType, {e} as value, cast(null as varchar) as attributes from wide"""
    for e in _ELEMENTS
)
# Days of which a response that holds no summary was landed as well.
_BAD_DAY = "substring(date, 9, 2) in ('05', '06', '07')"
_FLAGS = """, case when tempMaxF is not null and tempMinF is not null then {} end as dailyGdd,
    case when tempMinF > 32.0 then 1 else 0 end as frostFreeFlag,
    case when tempMaxF > 95.0 then 1 else 0 end as heatStressFlag""".format(_GDD)
_TAG = """case when coalesce(droughtIndex, 0) < -0.2 or heatStressDays > 20 then 'Stress'
    when coalesce(droughtIndex, 0) < 0 or heatStressDays > 10 then 'Watch' else 'Normal' end"""
_STATION_CUT = f"""select * from obs where stationId <> 'GHCND:ST2'
    union all select * from obs where stationId = 'GHCND:ST2' and date <= '{q.CUTOFF}'"""


def _gaps(marked: str) -> str:
    return f"""select stationId, year, cast(greatest(s, make_date(year, 1, 1)) as varchar) as rangeStart,
        cast(least(e, make_date(year, 12, 31)) as varchar) as rangeEnd
      from (select stationId, s, e, cast(unnest(range(year(s), year(e) + 1)) as integer) as year
            from (select stationId, cast(maxDate as date) as s, date '{q.TODAY}' as e from ({marked}))
            where s <= e)"""


def _slice(where: str) -> str:
    return f"""select date, tempAvgF, precipIn, snowIn{_FLAGS} from daily
      where qualityFlag <> 'SUSPECT' and year(date) between {q.FIRST_YEAR} and {q.LAST_YEAR}
        and ({where})"""


def _table(window: str) -> str:
    return f"""select stationId, year, {_to_fixed('gdd', 0)} as gdd,
        {_to_fixed('precipIn', 1)} as precipIn, {_to_fixed('avgTempF', 1)} as avgTempF,
        {_to_fixed('snowIn', 1)} as snowIn, frostFreeDays, heatStressDays,
        case when droughtIndex >= 0 then '+' else '' end
          || coalesce({_to_fixed('droughtIndex', 3)}, '—') as droughtIndex,
        {_TAG} as condition
      from long where "window" = '{window}'"""


def _latest(daily: str, keys: str) -> str:
    return f"""select {keys}, date, tempAvgF,
        coalesce({_text_round('tempAvgF', 1)} || '°F', '--') as temperature,
        coalesce(strftime(date, '%A, %b %-d, %Y'), '--') as day
      from {daily} where tempAvgF is not null
      qualify row_number() over (partition by stationId order by date desc) = 1"""


def _number(column: str) -> str:
    """A double as the JSON writer of the JVM prints it; small values get an exponent."""
    small = f"abs({column}) < 0.001 and {column} <> 0"
    return (
        f"case when {column} is null then 'null' when {small}"
        f" then printf('%.1fE-4', {column} * 10000) else cast({column} as varchar) end"
    )


def _json_object(fields: list[tuple[str, str]]) -> str:
    cells = [f"""'"{name}":' || {text}""" for name, text in fields]
    return "'{' || " + " || ',' || ".join(cells) + " || '}'"


_INTEGER_METRICS = ("frostFreeDays", "heatStressDays")
_ANNUAL_JSON = _json_object(
    [("year", "cast(year as varchar)")]
    + [
        (
            wide_column(w.key, m),
            f"cast({wide_column(w.key, m)} as varchar)"
            if m in _INTEGER_METRICS
            else _number(wide_column(w.key, m)),
        )
        for w in WINDOWS
        for m in METRICS
    ]
)
_DAILY_JSON = _json_object(
    [("date", """'"' || cast(date as varchar) || '"'""")]
    + [(c, f"coalesce(cast({c} as varchar), 'null')") for c in ("tempAvgF", "precipIn", "snowIn", "dailyGdd")]
    + [(c, f"cast({c} as varchar)") for c in ("frostFreeFlag", "heatStressFlag", "month")]
    + [(w.key, f"cast(coalesce({w.key}, false) as varchar)") for w in PHASES]
)
_MELTED = " union all ".join(
    f"""select year, '{w.key}' as "window", '{m}' as metric,
      cast({wide_column(w.key, m)} as double) as value from gold"""
    for w in WINDOWS
    for m in METRICS
)


def texts() -> dict[str, str]:
    found = _texts()
    # Stations listed twice change nothing.
    found["inventory_repeated_stations"] = found["station_inventory"]
    found["gap_ranges_repeated_stations"] = found["gap_ranges_by_station"]
    return found


def _texts() -> dict[str, str]:
    obs = ("obs",)
    supp = fixtures.SUPPLEMENTAL
    anchor = f"stationId = '{fixtures.ANCHOR}'"
    others = f"stationId not in ('{fixtures.ANCHOR}', '{supp}')"
    station_ids = "select id as stationId from stations"
    return {
        # sources and tables
        "stored_table": _sql(_PROFILE.format("obs"), obs),
        "overwrite_station": _sql(_PROFILE.format(f"({_STATION_CUT})"), obs),
        "overwrite_station_by_year": _sql(_PROFILE.format(f"({_STATION_CUT})"), obs),
        "clustered_station": _sql(
            f"""select {_YEAR} as year, dataType, count(value) as readings, min(date) as firstDate, max(date) as lastDate
                from obs where stationId = '{supp}' group by all""",
            obs,
        ),
        "duplicate_keys_bucketed": _sql(
            """select stationId, date, dataType, count(*) as n from obs
               group by stationId, date, dataType having count(*) > 1""",
            obs,
        ),
        "upsert_bucketed": _sql(
            _UPSERTED.format(_replaced("old", "newer")), ("base", "old", "newer"),
            base=_PARTS["obs"], old=_OLD, newer=_NEWER,
        ),
        "append_absent": _sql(
            _PROFILE.format(f"({_kept('old', 'newer')})"),
            ("base", "old", "newer"), base=_PARTS["obs"], old=_OLD, newer=_NEWER,
        ),
        "replace_station": _sql(_PROFILE.format(f"({_STATION_CUT})"), obs),
        "read_or_seed": _sql(_PROFILE.format("obs"), obs),
        "daily_json_unpivot": _sql(
            _UNPIVOTED,
            ("obs", "wide"),
        ),
        "daily_json_with_errors": _sql(
            f"""select l.*, (select count(*) + count(*) filter (where {_BAD_DAY}) from wide) as responses,
                 (select count(*) filter (where {_BAD_DAY}) from wide) as rejected
               from ({_UNPIVOTED}) l""",
            ("obs", "wide"),
        ),
        "daily_json_quarantine": _sql(
            """select case when substring(date, 9, 2) = '05' then 'no field of a summary' else 'no JSON' end as reason,
                 count(*) as rejected,
                 count(distinct case when substring(date, 9, 2) = '07' then 'cut' else date end) as texts,
                 (select count(*) from wide) as accepted
               from wide where substring(date, 9, 2) in ('05', '06', '07') group by all""",
            ("obs", "wide"),
        ),
        "landed_stream": _sql(
            _PROFILE.format(f"({_kept('old', 'newer')})"), ("obs", "wide", "newer", "old"),
            newer=_UNPIVOTED,
            old=f"""select stationId, date, dataType,
                case when substring(date, 10, 1) <> '3' then value end as value, attributes
              from newer where date <= '{q.OLD_UNTIL}'""",
        ),
        "crop_json": _sql(
            """select case when commodity <> 'WHEAT' then year else '' end as year,
                 * exclude (year) from crops""",
            ("crops",),
        ),
        "station_json": """select s_name as id, 'Station ' || cast(s_suppkey as varchar) as name,
            cast(s_nationkey + 30.5 as double) as latitude, s_acctbal as longitude,
            '1995-01-01' as minDate, '2001-12-31' as maxDate
          from supplier where s_acctbal >= 0""",
        "csv_report": _sql("select cast(columns(*) as varchar) from report", _REPORTED),
        "preview": _all_stations("select * from daily_all order by date, stationId limit 100"),
        "sample_table": _sql(
            """select *, (select count(*) from quality) as tableRows from quality
               order by date, stationId limit 20""",
            ("obs", "quality"),
        ),
        "export_annual": _gold(f"select year, {_ANNUAL_JSON} as json from gold"),
        "export_daily": _anchor(
            f"""select stationId, date, {_DAILY_JSON} as json from (select *{_FLAGS} from daily
               where qualityFlag <> 'SUSPECT' and year(date) >= {q.FIRST_YEAR})"""
        ),
        "silver_without_supplemental": _anchor(
            "select * from daily",
            supp=_supp("none"), sourced=_sourced("cast(null as varchar)", "cast(null as varchar)"),
        ),
        # incremental logic, deletes and quality checks
        "high_water_mark": _sql("select max(date) as maxDate from obs", obs),
        "high_water_mark_by_station": _sql(
            "select stationId, max(date) as maxDate from obs group by stationId", obs
        ),
        "gap_ranges": _sql(
            _gaps("select id as stationId, (select max(date) from obs) as maxDate from stations"),
            ("obs", "stations"),
        ),
        "gap_ranges_by_station": _sql(
            _gaps("select stationId, max(date) as maxDate from obs group by stationId"),
            ("obs", "stations"),
        ),
        "year_ranges": _sql(
            f"""select stationId, cast(y as integer) as year, y || '-01-01' as rangeStart,
                 y || '-12-31' as rangeEnd from ({station_ids}), range(1995, 2002) r(y)""",
            ("stations",),
        ),
        **{
            f"upsert_{mode}": _sql(
                _UPSERTED.format(rows), ("base", "old", "newer"),
                base=_PARTS["obs"], old=_OLD, newer=_NEWER,
            )
            for mode, rows in {
                "replace": _replaced("old", "newer"),
                "keep": _kept("old", "newer"),
                "append": "select * from old union all select * from newer",
            }.items()
        },
        "upsert_late_reading": _sql(
            _UPSERTED.format(_kept("late", "obs")), ("obs", "late"), late=_UNREAD.format("obs", 3),
        ),
        "upsert_null_new": _sql(
            _UPSERTED.format(_replaced("obs", "late")), ("obs", "late"), late=_UNREAD.format("obs", 4),
        ),
        "upsert_repeated_new": _sql(
            _UPSERTED.format(_kept("old", "again")), ("base", "old", "newer", "again"),
            base=_PARTS["obs"], old=_OLD, newer=_NEWER,
            again="select * from newer union all select * replace (value / 4 as value) from newer",
        ),
        "delete_month": _sql(
            _PROFILE.format(f"(select * from obs where date not like '{q.DELETED_MONTH}%')"), obs
        ),
        "delete_month_counts": _sql(
            _COUNTS.format(f"date like '{q.DELETED_MONTH}%'"), obs
        ),
        "trim_after": _sql(_PROFILE.format(f"(select * from obs where date <= '{q.CUTOFF}')"), obs),
        "trim_after_counts": _sql(_COUNTS.format(f"date > '{q.CUTOFF}'"), obs),
        "value_counts_wide": _sql(
            "select stationId, substring(date, 1, 4) as year, "
            + ", ".join(
                f"count(case when dataType = '{e}' then value end) as {e}" for e in _ELEMENTS
            )
            + " from obs group by all",
            obs,
        ),
        "coverage": _sql("select * from coverage", ("obs", "coverage")),
        "temp_inversions": _sql("select * from inversions", ("obs", "wide", "inversions")),
        "duplicate_keys": _sql(
            """select stationId, date, dataType, count(*) as n from obs
               group by stationId, date, dataType having count(*) > 1""",
            obs,
        ),
        "duplicate_count": _sql(
            """select count(*) as duplicateKeys from (select 1 from obs
               group by stationId, date, dataType having count(*) > 1)""",
            obs,
        ),
        "extreme_values": _sql("select * from extremes", ("obs", "extremes")),
        "bronze_report": _sql("select * from report", _REPORTED),
        "bronze_issues": _sql(
            """select stationId, year, concat_ws('; ',
                 case when coverageStatus <> 'OK' then
                   'coverage=' || cast(coveragePct as varchar) || '% [' || coverageStatus || ']' end,
                 case when inversions > 0 then inversions || ' TMAX<TMIN inversions' end,
                 case when extremeVals > 0 then extremeVals || ' extreme outlier values' end) as issues
               from report where coverageStatus <> 'OK' or inversions > 0 or extremeVals > 0""",
            _REPORTED,
        ),
        "issue_count": _sql(
            """select count(*) as issueCount from report
               where coverageStatus <> 'OK' or inversions > 0 or extremeVals > 0""",
            _REPORTED,
        ),
        "station_inventory": _sql(
            f"""select s.id, s.name, s.latitude, s.longitude, cast(y as integer) as year,
                 coalesce(n, 0) as rowCount,
                 cast(coalesce(sum(n) over (partition by s.id), 0) as bigint) as stationTotal
               from stations s cross join range(1995, 2003) r(y)
               left join (select stationId, {_YEAR} as year, count(distinct date) as n
                          from obs group by all) c on c.stationId = s.id and c.year = y""",
            ("obs", "stations"),
        ),
        # daily table
        "flag_suspect": _sql(
            f"""select stationId, date, dataType, attributes, {_SUSPECT} as suspect, count(*) as n
                from obs group by all""",
            obs,
        ),
        "day_quality": _sql("select * from quality", ("obs", "quality")),
        "pivot_elements": _sql("select * from wide", ("obs", "wide")),
        "pivot_supplemental": _sql("select * from supp", ("obs", "supp")),
        "has_station": _sql(
            f"""select '{supp}' as stationId, count(*) > 0 as present from obs where stationId = '{supp}'
                union all select 'none', count(*) > 0 from obs where stationId = 'none'""",
            obs,
        ),
        "pool_medians": _sql("select * from pool", ("obs", "pool")),
        "pool_medians_excluding": _sql("select * from pool", ("obs", "pool"), pool=_pool(others)),
        "fill_temperature": _anchor(
            f"select stationId, date, maxC, minC, PRCP, SNOW, SNWD from filled where {anchor}"
        ),
        "temp_provenance": _anchor(
            f"""select stationId, date, maxC, minC, tempSource, tempStationId, tempStationName
                from sourced where {anchor}""",
            pool=_pool(others),
        ),
        "classify_days": _sql(
            f"""select date, cast(m as integer) as month, {_SEASON_SQL} as season, {_PHASES}
                from (select distinct cast(date as date) as date, month(cast(date as date)) as m,
                        day(cast(date as date)) as d from obs)""",
            obs,
        ),
        "to_us_units": _anchor(
            f"""select stationId, date, maxC * 9.0 / 5.0 + 32.0 as tempMaxF,
                  minC * 9.0 / 5.0 + 32.0 as tempMinF,
                  (maxC + minC) / 2.0 * 9.0 / 5.0 + 32.0 as tempAvgF, PRCP / 25.4 as precipIn,
                  SNOW / 25.4 as snowIn, SNWD / 25.4 as snowDepthIn
                from filled where {anchor}"""
        ),
        "silver_weather": _anchor("select * from daily"),
        "silver_all_stations": _all_stations("select * from daily_all"),
        "silver_repeated_stations": _all_stations("select * from daily_all"),
        "rows_per_year": _anchor(
            """select cast(year(date) as integer) as year, count(*) as rowCount
               from daily group by all"""
        ),
        "season_rows_per_year": _gold("select year, count(*) as rowCount from gold group by year"),
        "silver_validation": _sql("select * from validation", (*_ANCHOR, "validation")),
        "silver_validation_all_stations": _all_stations(
            f"select * from ({_validation('stationId, year', 'daily_all')})"
        ),
        "validation_totals": _sql(
            "select "
            + ", ".join(
                f"cast(sum({c}) as bigint) as {c}"
                for c in ("totalRows", "nullTempRows", "qfSuspect", "qfMissing", "outInversion",
                          "outTempMaxHigh", "outTempMinLow", "outPrecipHigh")
            )
            + " from validation",
            (*_ANCHOR, "validation"),
        ),
        "validation_alerts": _sql(
            f"""select year, concat_ws('; ',
                 case when coverageStatus <> 'OK' then totalRows || '/' || expectedDays || ' days ('
                   || cast(coveragePct as varchar) || '%) [' || coverageStatus || ']' end,
                 case when nullTempRows > 0 then nullTempRows || '/' || totalRows
                   || ' rows with null tempAvgF ('
                   || {_text_round('(nullTempRows * 100.0 / totalRows)', 1)} || '%)' end) as alerts
               from validation where coverageStatus <> 'OK' or nullTempRows > 0""",
            (*_ANCHOR, "validation"),
        ),
        "expected_days_by_year": _sql(
            f"""select year, cast({_EXPECTED} as integer) as expectedDays
                from (select distinct {_YEAR} as year from obs)""",
            obs,
        ),
        # crops
        "clean_crops": _sql(
            """select try_cast(year as integer) as year, state, countyFips, commodity, statisticCat,
                 value, try_cast(replace(trim(value), ',', '') as double) as parsedValue,
                 count(*) as n
               from crops where countyFips is not null group by all""",
            ("crops",),
        ),
        "crop_records": _sql("select * from records", ("crops", "records")),
        "crop_breakdown_by_crop": _sql(
            "select cropName, count(*) as count from records group by cropName", ("crops", "records")
        ),
        "crop_breakdown_by_year": _sql(
            "select year, count(*) as count from records group by year", ("crops", "records")
        ),
        "normalised_crops": _sql(
            """select name, count(*) as n,
                 case upper(trim(name)) when 'CORN' then 'Corn' when 'SOYBEANS' then 'Soybeans'
                   when 'SOYBEAN' then 'Soybeans' when 'WHEAT' then 'Wheat' end as crop
               from (select commodity as name from crops
                     union all select ' ' || lower(commodity) from crops
                     union all select regexp_replace(commodity, 'S$', '') from crops
                     union all select commodity || 'X' from crops)
               group by name""",
            ("crops",),
        ),
        "require_rows": _sql("select count(*) as n from records", ("crops", "records")),
        "crop_profitability": _sql("select * from profit", ("crops", "records", "profit")),
        "optimal_mix": _gold(
            """select m.year, m.countyFips, m.stateCode, recommendedCrop,
                 case when top is not null and total <> 0 then coalesce(c, 0) / total end as cornScore,
                 case when top is not null and total <> 0 then coalesce(s, 0) / total end as soybeanScore,
                 case when top is not null and total <> 0 then coalesce(w, 0) / total end as wheatScore,
                 top as topCropRevenue,
                 g.growingDegreeDays, g.totalPrecipIn, g.wheatGrowingDroughtIndex
               from (
                 select year, countyFips, stateCode,
                   max(revenueUsdAcre) filter (where crop = 'Corn') as c,
                   max(revenueUsdAcre) filter (where crop = 'Soybeans') as s,
                   max(revenueUsdAcre) filter (where crop = 'Wheat') as w,
                   max(revenueUsdAcre) as top, coalesce(c, 0) + coalesce(s, 0) + coalesce(w, 0) as total,
                   max(crop) filter (where rn = 1 and revenueUsdAcre is not null) as recommendedCrop
                 from (select *, row_number() over (partition by year, countyFips, stateCode
                         order by revenueUsdAcre desc nulls last, crop) as rn from profit)
                 group by year, countyFips, stateCode) m
               left join gold g on g.year = m.year and g.countyFips = m.countyFips
                 and g.stateCode = m.stateCode""",
            ("crops", "records", "profit"),
        ),
        "optimal_mix_all_counties": _sql(
            f"""select m.year, m.countyFips, m.stateCode, recommendedCrop, top as topCropRevenue,
                 g.stationId, g.growingDegreeDays, g.totalPrecipIn, g.julAvgTempF
               {_MIX}
               left join (select * exclude (countyFips, stateCode), c.countyFips, c.stateCode,
                   row_number() over (partition by year, c.countyFips, c.stateCode order by stationId) as rn
                 from gold_all join counties c using (stationId)) g
                 on g.year = m.year and g.countyFips = m.countyFips and g.stateCode = m.stateCode and g.rn = 1""",
            ("crops", "records", "profit", "counties", *_SILVER, *_SEASON, "gold_all"),
            qualified=_qualified("daily_all"), counties=fixtures.COUNTIES.format(supplier="supplier"),
        ),
        # season table
        "temp_availability": _anchor(
            f"""select year, totalDays, tempDays,
                  {_text_round('(tempDays * 100.0 / totalDays)', 0)} || '%' as pct,
                  case when tempDays = 0 then 'NO TEMPERATURE DATA' else '' end as warning
                from (select cast(year(date) as integer) as year, count(*) as totalDays,
                        count(case when tempMaxF is not null and tempMinF is not null then 1 end)
                          as tempDays
                      from daily group by all)"""
        ),
        "qualified_days": _sql("select * from qualified", (*_ANCHOR, "qualified")),
        "growing_degrees": _all_stations(
            f"""select stationId, date,
                  case when tempMaxF is not null and tempMinF is not null then {_GDD} end as gdd
                from daily_all"""
        ),
        "season_long": _season("select * from long"),
        "season_long_all_stations": _season_all("select * from long"),
        "drought_index": _sql(
            f"""select stationId, year, amount, {_decimal('(n * amount - total)', 'total', 4)}
                  as droughtIndex
                from (select *, sum(amount) over (partition by stationId) as total,
                        count(*) over (partition by stationId) as n
                      from (select stationId, {_YEAR} as year,
                              cast(sum(cast(round(value * 100) as bigint)) as bigint) as amount
                            from obs where dataType = 'PRCP' group by all))""",
            obs,
        ),
        "season_weather": _gold("select * from gold"),
        "season_weather_all_stations": _sql(
            "select * from gold_all", (*_SILVER, *_SEASON, "gold_all"),
            qualified=_qualified("daily_all"),
        ),
        # slices and statistics
        "latest_reading": _anchor(_latest("daily", "stationId")),
        "latest_reading_by_station": _all_stations(_latest("daily_all", "stationId")),
        "daily_drilldown": _anchor(
            f"""select *{_FLAGS} from daily
                where qualityFlag <> 'SUSPECT' and year(date) >= {q.FIRST_YEAR}"""
        ),
        "drop_empty_years": _gold(
            """select year, frostFreeDays, growingDegreeDays, totalPrecipIn from gold
               where frostFreeDays > 0 or growingDegreeDays > 0 or totalPrecipIn > 0""",
            ("base",),
            base=_PARTS["obs"],
            obs="""select stationId, date, dataType, value,
                case when date between '1998-03-15' and '1998-12-05' then ',X,S' else attributes end as attributes
              from base""",
        ),
        "melt_metrics": _gold(_MELTED),
        "slice_daily_all": _anchor(_slice("true")),
        "slice_daily_month": _anchor(_slice("month = 7")),
        "slice_daily_phase": _anchor(_slice("wheatGrowing")),
        "slice_annual": _gold(
            f"""select year, growingDegreeDays, totalPrecipIn, julAvgTempF, cornGrowingSnowIn
                from gold where year between {q.FIRST_YEAR} and {q.LAST_YEAR}"""
        ),
        "choose_grain": _anchor(
            f"""select cast(a as integer) as firstYear, cast(b as integer) as lastYear,
                  case when b - a <= 4 and exists
                    (select 1 from daily where qualityFlag <> 'SUSPECT' and year(date) between a and b)
                    then 'daily' else 'annual' end as grain
                from (values ({q.FIRST_YEAR}, {q.LAST_YEAR}), (1995, 2001), (2010, 2012)) r(a, b)"""
        ),
        "summary_stats": _gold(
            f"""select "window", metric, {_rounded('avg(value)')} as avgValue, min(value) as minValue,
                  max(value) as maxValue, {_rounded('stddev_pop(value)')} as stddevValue
                from ({_MELTED}) group by "window", metric"""
        ),
        "summary_stats_daily": _all_stations(
            f"""select stationId, metric, {_rounded('avg(value)')} as avgValue, min(value) as minValue,
                  max(value) as maxValue, {_rounded('stddev_pop(value)')} as stddevValue
                from (
                  select stationId, unnest(['gdd', 'precipIn', 'frostFreeDays', 'heatStressDays', 'avgTempF', 'snowIn'])
                      as metric,
                    unnest([dailyGdd, precipIn, cast(frostFreeFlag as double), cast(heatStressFlag as double),
                            tempAvgF, snowIn]) as value
                  from (select *{_FLAGS} from daily_all where qualityFlag <> 'SUSPECT'
                          and year(date) between {q.FIRST_YEAR} and {q.LAST_YEAR}))
                where value is not null group by stationId, metric"""
        ),
        "condition_tags": _season_all(
            f"""select stationId, year, "window", droughtIndex, heatStressDays, {_TAG} as condition
                from long"""
        ),
        "season_table": _season_all(_table("all")),
        "season_table_phase": _season(_table("soybeanHarvest")),
        # compositions
        "refresh": _gold(
            "select * from gold", ("base", "old", "newer"),
            base=_PARTS["obs"], old=_OLD, newer=_NEWER,
            obs=_replaced("old", "newer"),
        ),
        "refresh_stored": _gold(
            "select * from gold", ("base", "old", "newer"),
            base=_PARTS["obs"], old=_OLD, newer=_NEWER, obs=_replaced("old", "newer"),
        ),
        "refresh_stored_keep": _gold(
            "select * from gold", ("base", "old", "newer"),
            base=_PARTS["obs"], old=_OLD, newer=_NEWER, obs=_kept("old", "newer"),
        ),
        "refresh_propagated": _updated(_GOLD, _replaced("old", "newer")),
        "refresh_propagated_keep": _updated(_GOLD, _kept("old", "newer")),
        "silver_propagated": _updated("select * from daily_all", _replaced("old", "newer")),
        "pool_medians_merged": _updated(
            "select * from pool where poolTMAX is not null or poolTMIN is not null", _replaced("old", "newer")),
        "temperature_counts_merged": _sql(
            """select date, dataType as element, value as reading, count(*) as n
               from (select * from base where date < '{0}' union all select * from newer)
               where value is not null and dataType in ('TMAX', 'TMIN') group by all""".format(q.NEW_FROM),
            ("base", "newer"), base=_PARTS["obs"], newer=_NEWER,
        ),
        "rebuild": _gold(
            "select * from gold", ("base",), base=_PARTS["obs"],
            obs=f"select * from base where date <= '{q.CUTOFF}'",
        ),
        "gold_from_stored_silver": _gold("select * from gold"),
    }


def _rounded(value: str) -> str:
    return f"cast(cast(cast({value} as varchar) as decimal(30, 6)) as double)"

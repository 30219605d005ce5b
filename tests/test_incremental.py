"""Stored layers after updates against layers made anew, and what an update reads and writes."""

import pathlib
import random
import re

import pytest

from fieldseason.operators import gold, silver
from fieldseason.operators.bronze import upsert
from fieldseason.plans import incremental
from fieldseason.schemas import OBSERVATIONS
from fieldseason.sources import tables

STATIONS = ("A", "B", "C", "S")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def seed(spark):
    rng = random.Random(11)
    out = []
    for month in range(1, 7):
        for day in (1, 2, 15, 28):
            for station in STATIONS:
                for element in ("TMAX", "TMIN", "PRCP"):
                    if rng.random() < 0.75:
                        value = rng.choice([None, float(rng.randrange(-5, 35))])
                        out.append((station, f"2001-{month:02d}-{day:02d}", element, value, rng.choice([None, ",X,S", ",,S"])))
    return out


@pytest.fixture
def store(tmp_path):
    return incremental.Store(str(tmp_path / "store"), "S", "Supplemental", ("S",))


def check(spark, store, obs, stations=None):
    """Every layer equals the one made from all observations."""
    assert rows(store.read(spark, "bronze").select(*OBSERVATIONS.names)) == rows(obs)
    fallback = silver.fallback_temperatures(obs, "S", ("S",))
    daily = silver.silver_weather(obs, supplemental="S", supplemental_name="Supplemental", fallback=fallback, stations=stations)
    assert rows(incremental.daily(spark, store)) == rows(daily)
    medians = silver.pool_medians(obs, ("S",)).filter("poolTMAX is not null or poolTMIN is not null")
    assert rows(incremental.pool_medians(spark, store)) == rows(medians)
    assert rows(incremental.season_long(spark, store)) == rows(gold.season_long(gold.qualified_days(daily)))


@pytest.mark.parametrize("on_conflict", ["replace", "keep", "append"])
def test_random_updates_equal_a_rebuild(spark, obs, store, seed, on_conflict):
    rng = random.Random(5)
    before = obs(*seed)
    incremental.create(spark, store, before)
    for turn in range(2):
        new = obs(*[
            (rng.choice([*STATIONS, "NEW"]), f"2001-0{rng.choice([2, 5])}-{rng.choice(['01', 15, 20])}",
             rng.choice(["TMAX", "TMIN", "PRCP", "SNOW"]), rng.choice([None, 12.5, 40.0, -3.0]), rng.choice([None, ",X,S"]))
            for _ in range(15)])
        new = tables.materialize(new, "new")
        written = incremental.apply_update(spark, store, new, on_conflict)
        before = tables.materialize(upsert(before, new, on_conflict=on_conflict), "all")
        assert set(written["silver"]) <= {"2001-02", "2001-05", None}
        check(spark, store, before)


def test_a_day_reads_and_writes_its_month_alone(spark, obs, store, seed):
    """The other months' files are made unreadable for the update's time: nothing may open them."""
    incremental.create(spark, store, obs(*seed))
    root, kept = pathlib.Path(store.root), {}
    for layer in ("bronze", "counts", "silver", "totals"):
        for file in (root / layer).glob("yearMonth=*/*.parquet"):
            if "2001-03" not in str(file):
                kept[file] = file.read_bytes()
                file.write_bytes(b"no parquet")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    new = obs(("A", "2001-03-15", "TMAX", 33.0, None))
    written = incremental.apply_update(spark, store, new)
    assert written == {layer: ["2001-03"] for layer in ("bronze", "counts", "silver", "totals")}
    for file, content in kept.items():
        assert file.read_bytes() == b"no parquet"
        file.write_bytes(content)
    check(spark, store, upsert(obs(*seed), new))


def test_partition_filters_reach_the_scan(spark, obs, store, seed):
    incremental.create(spark, store, obs(*seed))
    for layer in ("bronze", "counts", "silver", "totals"):
        plan = plan_of(store.read(spark, layer, [("2001-03",)]))
        assert re.search(r"PartitionFilters: \[.*yearMonth.*2001-03", plan)
    files = incremental.pool_medians(spark, store).inputFiles()
    assert files and all("/counts/" in f for f in files)


def test_a_pool_that_stays_the_same_touches_no_other_station(spark, obs, store):
    days = [(s, "2001-03-15", e, v, None) for s, v in (("A", 1.0), ("B", 2.0), ("C", 3.0)) for e in ("TMAX", "TMIN")]
    days += [("D", "2001-03-15", "PRCP", 4.0, None)]
    incremental.create(spark, store, obs(*days))
    counts = store.read(spark, "counts").select("date", "element", "reading", "n")

    def dates(*new):
        _, changes = incremental.changed_rows(store, spark, obs(*new), "replace")
        delta = changes.filter("value is not null").selectExpr("date", "dataType as element", "value as reading", "n")
        return [r["date"] for r in incremental.changed_dates(store, counts, silver.merged_counts(counts, delta), changes).collect()]

    assert dates(("C", "2001-03-15", "TMAX", 9.0, None)) == []  # the median stays 2
    assert dates(("B", "2001-03-15", "TMAX", 9.0, None)) == ["2001-03-15"]
    assert dates(("C", "2001-03-16", "TMIN", 9.0, None)) == ["2001-03-16"]
    assert dates(("S", "2001-03-17", "TMIN", 9.0, None)) == ["2001-03-17"]  # not pooled, but a fallback
    assert dates(("A", "2001-03-15", "PRCP", 9.0, None)) == []


def test_nothing_new_and_repeated_updates(spark, obs, store, seed):
    before = obs(*seed)
    incremental.create(spark, store, before)
    new = obs(("A", "2001-03-15", "TMAX", 33.0, None), ("A", "2001-03-15", "TMAX", 35.0, None))
    incremental.apply_update(spark, store, new)
    assert incremental.apply_update(spark, store, new)["silver"] == []  # all is there
    assert incremental.apply_update(spark, store, obs().filter("false"))["bronze"] == []
    check(spark, store, upsert(before, new))


def test_an_interrupted_update_is_completed(spark, obs, store, seed, monkeypatch):
    before = obs(*seed)
    incremental.create(spark, store, before)
    new = obs(("A", "2001-03-15", "TMAX", 33.0, None), ("B", "2001-05-01", "TMIN", -20.0, ",X,S"))
    put, done = tables.overwrite_partitions, []

    def fails(df, path, partition_by):
        if len(done) == 2:
            raise OSError("executor lost")
        done.append(path)
        put(df, path, partition_by)

    monkeypatch.setattr(incremental, "overwrite_partitions", fails)
    with pytest.raises(OSError):
        incremental.apply_update(spark, store, new)
    monkeypatch.setattr(incremental, "overwrite_partitions", put)
    assert len(incremental.recover(spark, store)) == 1 and incremental.recover(spark, store) == []
    check(spark, store, upsert(before, new))


def test_unparsable_dates_null_keys_and_a_last_qualified_day(spark, obs, store):
    odd = [("A", "2001-03-15", "TMAX", 20.0, None), ("A", "2001-03-15", "TMIN", 10.0, None), ("A", "not a day", "TMAX", 1.0, None),
           ("A", None, "TMAX", 1.0, None), (None, "2001-03-15", "TMAX", 1.0, None), ("B", "2001-04-31", "TMIN", 2.0, None)]
    incremental.create(spark, store, obs(*odd))
    check(spark, store, obs(*odd))
    # The month's only qualified day becomes suspect: its totals go.
    new = obs(("A", "2001-03-15", "TMIN", 11.0, ",X,S"), ("A", "also none", "TMIN", 3.0, None), ("A", "not a day", "TMAX", 2.0, None))
    incremental.apply_update(spark, store, new)
    check(spark, store, upsert(obs(*odd), new))
    assert incremental.season_long(spark, store).filter("stationId = 'A' and year = 2001").isEmpty()


def test_names_of_stations(spark, obs, store, seed):
    names = spark.createDataFrame([(s, f"Station {s}") for s in STATIONS], "id string, name string")
    before = obs(*seed)
    incremental.create(spark, store, before, names)
    new = obs(("A", "2001-03-15", "TMAX", 33.0, None))
    incremental.apply_update(spark, store, new, stations=names)
    check(spark, store, upsert(before, new), names)


# --- pruned rewrites and layouts ------------------------------------------------


def test_a_rewrite_reads_the_partitions_that_new_rows_touch(spark, obs, tmp_path):
    data = obs(*[(s, f"{y}-03-0{d}", "TMAX", float(d), None) for s in ("A", "B", "C") for y in (1999, 2000, 2001) for d in range(1, 5)],
               (None, None, "TMAX", 1.0, None), ("", "no day", "TMIN", 2.0, None))
    new = obs(("A", "2000-03-02", "TMAX", 50.0, None), (None, "2000-03-09", "TMAX", 5.0, None))
    for by, expected in ((["stationId"], ["stationId", "A", "isnull"]), (["year"], ["year", "2000"]),
                         (["year", "stationId"], ["year", "2000", "stationId"])):
        path = str(tmp_path / "-".join(by))
        tables.write_layer(data, path, by)
        touched = tables.touched_rows(new, path, by)
        filters = re.search(r"PartitionFilters: \[(.*?)\],? Push", plan_of(touched), re.S).group(1)
        assert all(x in filters for x in expected)
        tables.upsert_stored(new, path, "replace", by)
        stored = tables.read_partitioned(spark, path, OBSERVATIONS, by).select(*OBSERVATIONS.names)
        same = lambda df: rows(df.fillna("", ["stationId"]))  # noqa: E731 - a folder stores the empty text as null
        assert same(stored) == same(upsert(data, new))
        tables.upsert_stored(new.filter("stationId is not null"), path, "replace", by)  # again: nothing changes
        assert same(tables.read_partitioned(spark, path, OBSERVATIONS, by).select(*OBSERVATIONS.names)) == same(upsert(data, new))


@pytest.mark.parametrize("by", [["stationId"], ["year"], ["yearMonth"]])
def test_a_station_is_replaced_in_its_partitions(spark, obs, tmp_path, by):
    data = obs(*[(s, f"{y}-03-01", "TMAX", 1.0, None) for s in ("A", "B") for y in (1999, 2000, 2001)], ("B", "2005-01-01", "TMAX", 1.0, None))
    path = tmp_path / "table"
    tables.write_layer(data, str(path), by)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    tables.overwrite_station(obs(("A", "2000-03-01", "TMIN", 7.0, None)), str(path), "A", by)
    found = tables.read_partitioned(spark, str(path), OBSERVATIONS, by).select("stationId", "date", "dataType", "value")
    assert sorted(map(tuple, found.collect())) == sorted(
        [("B", f"{y}-03-01", "TMAX", 1.0) for y in (1999, 2000, 2001)] + [("B", "2005-01-01", "TMAX", 1.0), ("A", "2000-03-01", "TMIN", 7.0)])
    kept = [f for f, t in before.items() if f.exists() and f.stat().st_mtime_ns == t]
    assert kept and all("A" not in f.parent.name for f in kept)

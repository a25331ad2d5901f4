import csv
import os

import pytest

from flightmarts.operators.clean import clean, deduplicate
from flightmarts.schema import FLIGHT_COLUMNS, SOURCE_COLUMNS
from flightmarts.sources.raw import read_raw

HEADER = [src for src, _, _ in SOURCE_COLUMNS]


def raw_row(**over):
    base = {
        "FlightDate": "2024-01-10", "Reporting_Airline": "AA", "Flight_Number_Reporting_Airline": "100",
        "Tail_Number": "N1", "Origin": "JFK", "OriginCityName": "New York, NY", "OriginState": "NY",
        "Dest": "LAX", "DestCityName": "Los Angeles, CA", "DestState": "CA", "Distance": "2475.00",
        "CRSDepTime": "0800", "DepTime": "0805", "DepDelay": "5.00", "DepDel15": "0.00",
        "TaxiOut": "10.00", "TaxiIn": "5.00", "CRSArrTime": "1100", "ArrTime": "1105",
        "ArrDelay": "5.00", "ArrDel15": "0.00", "CRSElapsedTime": "360.00",
        "ActualElapsedTime": "360.00", "AirTime": "345.00", "Cancelled": "0.00",
        "CancellationCode": "", "Diverted": "0.00", "CarrierDelay": "", "WeatherDelay": "",
        "NASDelay": "", "SecurityDelay": "", "LateAircraftDelay": "", "Year": "2024", "Month": "1",
        "Extra": "ignored",
    }
    base.update(over)
    return base


def write_csv(path, rows, header=HEADER + ["Extra"]):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, fieldnames=header, extrasaction="ignore")
        w.writeheader()
        for r in rows:
            w.writerow(r)


def test_clean_edge_rows(spark, tmp):
    rows = [
        raw_row(),                                                   # kept
        raw_row(),                                                   # exact duplicate
        raw_row(Flight_Number_Reporting_Airline="200", Tail_Number="N9"),
        raw_row(Flight_Number_Reporting_Airline="200", Tail_Number="N2"),  # key dup, smaller payload wins
        raw_row(Flight_Number_Reporting_Airline="300", Origin=""),   # missing key -> dropped
        raw_row(Flight_Number_Reporting_Airline="400", DepDel15="2.00", ArrDel15=""),
    ]
    write_csv(f"{tmp}/raw/ontime_2024_01.csv", rows)
    out = clean(read_raw(spark, f"{tmp}/raw/*.csv"))
    assert out.columns == FLIGHT_COLUMNS
    got = {r["flight_number"]: r for r in out.collect()}
    assert sorted(got) == ["100", "200", "400"]
    assert got["200"]["tail_number"] == "N2"
    assert got["400"]["dep_delayed_15"] is False      # 2.00 is not 1.00
    assert got["400"]["arr_delayed_15"] is None       # empty flag is unknown, not false
    assert got["100"]["cancellation_code"] is None    # empty CSV value reads as NULL
    assert got["100"]["year"] == 2024 and got["100"]["month"] == 1


def test_dedup_is_repeatable(spark):
    from tests.conftest import make_legs

    legs = make_legs(spark, [
        {"flight_number": "7", "tail_number": t, "dep_delay_min": d}
        for t, d in [("N5", 1.0), ("N3", None), ("N3", 2.0), ("N4", 0.0)]
    ])
    for _ in range(3):
        rows = deduplicate(legs.repartition(3)).collect()
        assert len(rows) == 1
        assert (rows[0]["tail_number"], rows[0]["dep_delay_min"]) == ("N3", None)  # NULLs first


def test_non_numeric_delay_fails(spark, tmp):
    write_csv(f"{tmp}/bad/ontime.csv", [raw_row(DepDelay="abc")])
    with pytest.raises(Exception):
        clean(read_raw(spark, f"{tmp}/bad/*.csv")).collect()


def test_missing_source_column_fails_at_analysis(spark, tmp):
    header = [h for h in HEADER if h != "TaxiIn"]
    write_csv(f"{tmp}/miss/ontime.csv", [raw_row()], header=header)
    with pytest.raises(Exception, match="TaxiIn"):
        clean(read_raw(spark, f"{tmp}/miss/*.csv"))


def test_gzip_is_read(spark, tmp):
    import gzip
    import shutil

    write_csv(f"{tmp}/gz/x.csv", [raw_row(), raw_row(Flight_Number_Reporting_Airline="2")])
    os.makedirs(f"{tmp}/gz2")
    with open(f"{tmp}/gz/x.csv", "rb") as src, gzip.open(f"{tmp}/gz2/ontime_2024_01.csv.gz", "wb") as dst:
        shutil.copyfileobj(src, dst)
    assert clean(read_raw(spark, f"{tmp}/gz2/*.csv.gz")).count() == 2


def test_column_pruning_reaches_csv_scan(spark, tmp):
    write_csv(f"{tmp}/p/ontime.csv", [raw_row()])
    df = clean(read_raw(spark, f"{tmp}/p/*.csv")).select("carrier_code")
    plan = df._jdf.queryExecution().executedPlan().toString()
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "Reporting_Airline" in read_schema and "Extra" not in read_schema and "TaxiIn" not in read_schema


def test_trailing_comma_files_are_read(spark, tmp):
    # the source files end every line with a comma (an empty last column)
    os.makedirs(f"{tmp}/trail")
    rows = [raw_row(), raw_row(Flight_Number_Reporting_Airline="2")]
    with open(f"{tmp}/trail/ontime.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER + ["Extra", ""])
        for r in rows:
            w.writerow([r[h] for h in HEADER + ["Extra"]] + [""])
    out = clean(read_raw(spark, f"{tmp}/trail/*.csv"))
    assert sorted(r["flight_number"] for r in out.collect()) == ["100", "2"]


def test_files_with_other_headers_are_read_under_their_own(spark, tmp):
    os.makedirs(f"{tmp}/drift")
    layouts = [HEADER, HEADER[:5] + ["Added"] + HEADER[5:], list(reversed(HEADER))]
    for i, names in enumerate(layouts):
        row = raw_row(Flight_Number_Reporting_Airline=str(i), Extra="e")
        with open(f"{tmp}/drift/ontime_{i}.csv", "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(names)
            w.writerow([row.get(h, "added") for h in names])
    open(f"{tmp}/drift/ontime_9.csv", "w").close()  # no header, no rows
    out = clean(read_raw(spark, f"{tmp}/drift/*.csv")).orderBy("flight_number").collect()
    assert [r["flight_number"] for r in out] == ["0", "1", "2"]
    assert len({tuple(v for k, v in r.asDict().items() if k != "flight_number") for r in out}) == 1
    with open(f"{tmp}/drift/ontime_5.csv", "w", newline="") as f:
        csv.writer(f).writerow([h for h in HEADER if h != "Origin"])
    with pytest.raises(Exception, match="Origin"):
        read_raw(spark, f"{tmp}/drift/*.csv")

import os

from flightmarts.sources.raw import month_raw_path
from flightmarts.sources.seeds import CARRIER_SCHEMA, CARRIERS, carriers, literal_frame, read_seed


def test_seed_csv_with_explicit_types(spark, tmp):
    path = os.path.join(tmp, "carriers.csv")
    with open(path, "w") as f:
        f.write("carrier_code,carrier_name\n")
        for code, name in CARRIERS:
            f.write(f"{code},{name}\n")
    df = read_seed(spark, path, CARRIER_SCHEMA)
    assert sorted(df.collect()) == sorted(carriers(spark).collect())
    assert df.count() == 20


def test_literal_frame(spark):
    small = literal_frame(spark, [("A", "x"), ("B", "y")], CARRIER_SCHEMA)
    assert small.count() == 2 and literal_frame(spark, [], CARRIER_SCHEMA).count() == 0
    plan = carriers(spark)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in plan  # fixed-size seed


def test_month_raw_path():
    assert month_raw_path("s3a://b/raw/flights", 2024, 3) == "s3a://b/raw/flights/2024/ontime_2024_03.csv.gz"
    assert month_raw_path("data/raw/", 2015, 11, compressed=False) == "data/raw/2015/ontime_2015_11.csv"


def _write(path, lines, gz=False):
    import gzip

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with (gzip.open if gz else open)(path, "wt", newline="") as f:
        f.write("".join(line + "\n" for line in lines))


def test_headers_of_many_files_take_one_job(spark, tmp):
    from flightmarts.schema import SOURCE_COLUMNS
    from flightmarts.sources.raw import read_raw

    names = [src for src, _, _ in SOURCE_COLUMNS]
    quoted = [f'"{n}"' for n in names]
    row = lambda i: [f'"City {i}, ST"' if n.endswith("CityName") else f"v{i}" for n in names]
    moved = names[5:] + ["Extra, one"] + names[:5]
    for i in range(30):
        if i % 2:
            _write(f"{tmp}/raw/f{i}.csv", [",".join(quoted), ",".join(row(i))])
        else:
            cells = row(i)
            _write(f"{tmp}/raw/f{i}.csv.gz", [",".join(f'"{n}"' for n in moved), ",".join(cells[5:] + ["x"] + cells[:5])], gz=True)
    _write(f"{tmp}/raw/empty.csv", [])
    tracker = spark.sparkContext.statusTracker()

    def jobs_of(paths):
        group = f"headers-{len(paths)}-{os.path.basename(tmp)}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            out = read_raw(spark, paths)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, len(tracker.getJobIdsForGroup(group))

    few, jobs_few = jobs_of([f"{tmp}/raw/f{i}.csv" + ".gz" * (i % 2 == 0) for i in range(3)])
    every, jobs_every = jobs_of([f"{tmp}/raw/*"])
    assert jobs_every == jobs_few <= 3 and few.count() == 3
    got = {r["FlightDate"]: r for r in every.collect()}
    assert len(got) == 30
    for i in range(30):
        assert got[f"v{i}"]["OriginCityName"] == f"City {i}, ST" and got[f"v{i}"]["Month"] == f"v{i}"


def test_raw_files_without_rows(spark, tmp):
    from flightmarts.schema import SOURCE_COLUMNS
    from flightmarts.sources.raw import read_raw

    header = ",".join(src for src, _, _ in SOURCE_COLUMNS)
    _write(f"{tmp}/raw/a.csv", [header])
    _write(f"{tmp}/raw/b.csv", [])
    assert read_raw(spark, f"{tmp}/raw/*.csv").count() == 0

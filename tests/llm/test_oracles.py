"""The registered queries that have SQL, against DuckDB: the smallest tables, and awkward rows."""

import math

import duckdb
import pytest
from fixtures import documents, rows

from flightmarts.llm import license_scan, queries
from tests.conftest import SF_SMALL

TABLES = ("documents", "benchmark")


def by_sql(sf_dir, name, columns, tables=TABLES):
    db = duckdb.connect()
    for t in tables:
        db.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet{'/*.parquet' if sf_dir != SF_SMALL else ''}')")
    return db.execute(f"select {', '.join(columns)} from ({queries.ORACLES[name]})").fetchall()


def plain(rows):
    return sorted(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows if r[0] is not None)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert plain(rows(got)) == plain(by_sql(SF_SMALL, name, got.columns)) and got.count() > 0


def test_license_scan_equals_sql_on_changed_notices(spark, tmp_path):
    texts = [None, "", "mit", "cc by nc", "cc by nc cc BY, nc", "cc by " * 5_000 + "nc", "Under the MİT license under the mit license"]
    for i, (notice, _) in enumerate((*license_scan.PHRASES, *license_scan.NOTICES)):
        w = notice.split()
        third = len(w) // 3 + 1
        texts += [
            " ".join(["x"] * i + w), " ".join(w[:third] + ["very"] + w[third:]), " ".join(w[: 2 * third]), " ".join(w[third:] + w),
            " ".join(w[:third] + ["far"] * (license_scan.MERGE + i % 3) + w[third:]), ", ".join(x.upper() for x in w + w[::-1] + w),
        ]
    path = f"{tmp_path}/documents.parquet"
    documents(spark, texts, [(3, "cc by nc"), (5, "cc by nc"), (9, None)]).write.parquet(path)
    got = queries.op9_license_scan(spark, str(tmp_path))
    found = plain(rows(got))
    want = plain(by_sql(str(tmp_path), "op9_license_scan", got.columns, ["documents"]))
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted(found, key=key) == sorted(want, key=key)
    assert {label for _, label in license_scan.NOTICES} <= {x for r in found for x in r[6].split(",")}
    assert any(0.6 <= r[7] < 1 for r in found)

from __future__ import annotations

from datetime import datetime

import pytest

from fernlink.sources import tables


def test_csv_by_name_with_its_order(spark, tmp_path):
    for name, lines in (("b.csv", ["x,Supplier_missing,n", "1,Two,4.0"]), ("a.csv", ["Supplier_missing,n,y", '"One, ""the"" first',  'line",1,z', ",,", "Last,x,"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    one = tables.read_csv(spark, str(tmp_path / "a.csv"), "n long, Supplier_missing string", "ord")
    assert [tuple(r) for r in one.orderBy("ord").collect()] == [(1, 'One, "the" first\nline', 0), (None, None, 1), (None, "Last", 2)]
    (tmp_path / "b.csv").write_text("Supplier_missing,n,y\nTwo,4.0,\nThree,5,\n")
    both = tables.read_csv(spark, str(tmp_path), "n long, Supplier_missing string", "ord").orderBy("ord").collect()
    assert [(r.n, r.ord) for r in both] == [(1, 0), (None, 1), (None, 2), (4, 3), (5, 4)]
    with pytest.raises(ValueError, match="missing columns: Brand"):
        tables.read_csv(spark, str(tmp_path / "a.csv"), "Brand string")


def test_results_by_time(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a,b"), (2, None)], "index long, name string")
    first, second = (tables.timestamped(str(tmp_path), "matching_", datetime(2026, 1, d)) for d in (1, 2))
    assert first.endswith("/matching_20260101_000000")
    tables.write(rows.limit(1), first, "csv")
    tables.write(rows, second, "csv")
    (tmp_path / "zzz").mkdir()
    assert tables.latest(spark, str(tmp_path), "matching_").endswith("matching_20260102_000000")
    got = tables.read_csv(spark, tables.latest(spark, str(tmp_path), "matching_"), "name string, index long")
    assert sorted(tuple(r) for r in got.select("index", "name").collect()) == [(1, "a,b"), (2, None)]
    with pytest.raises(FileNotFoundError):
        tables.latest(spark, str(tmp_path), "none")


def test_parquet_and_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "index long, name string")
    tables.write(rows, str(tmp_path / "p"))
    assert sorted(tuple(r) for r in tables.read_parquet(spark, str(tmp_path / "p")).collect()) == sorted(tuple(r) for r in tables.written(rows, "t").collect())


def test_workbook_needs_a_reader(spark, tmp_path):
    with pytest.raises((ImportError, FileNotFoundError)):
        tables.read_excel(spark, str(tmp_path / "x.xlsx"), "a string")

"""Crawl planning, resumed loads and repeated rejects, by the command line and the jobs."""

import datetime as dt
import json
import os

import pytest

from parcelflow.plans import cli, jobs

DAY = dt.date(2025, 8, 12)
TS = dt.datetime(2025, 8, 12, 10)


def page(*rows):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<table><tbody id='table-item-tbody'>{body}</tbody></table>"


def listing_pages(spark, rows):
    """rows: (district, html)."""
    return spark.createDataFrame([(i, "臺北市", d, 1, 1, h) for i, (d, h) in enumerate(rows)],
                                 "page_id long, city_name string, district_name string, batch_id int, page int, html string")


def plan(spark, root, capsys):
    def options(sel, *names):
        return f"<select id='{sel}'>" + "".join(f"<option>{n}</option>" for n in names) + "</select>"
    inputs = {"city": spark.createDataFrame([(options("p_city", "縣市", "臺北市"),)], "html string"),
              "town": spark.createDataFrame([("臺北市", options("p_town", "請選擇", "大安區", "信義區"))],
                                            "city string, html string"),
              "lines": spark.createDataFrame([("臺北市", "大安區", "查詢結果 : 15 筆"), ("臺北市", "信義區", None)],
                                             "city_name string, district_name string, text string")}
    for name, df in inputs.items():
        df.write.mode("overwrite").parquet(os.path.join(root, "in", name))
    where = [x for o, n in (("--city-page", "city"), ("--town-pages", "town"), ("--result-lines", "lines"))
             for x in (o, os.path.join(root, "in", n))]
    assert cli.main(["plan-crawl", "--root", root, "--stage-date", str(DAY), *where]) == 0
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_plan_load_and_resume(spark, root, capsys):
    first = plan(spark, root, capsys)
    assert (first["districts"], first["pending"]) == (2, 2)
    assert first["batches"] == spark.read.parquet(os.path.join(root, "crawl_plan")).count() > 0
    jobs.load_listings(spark, root, listing_pages(spark, [("大安區", page(["A"] * 19))]), DAY, TS)
    assert plan(spark, root, capsys) == {"districts": 2, "pending": 1, "batches": 0}
    # A resumed load reads the pending district only; the done one keeps its row.
    both = listing_pages(spark, [("大安區", page(["X"] * 19, ["X"] * 19)), ("信義區", page(["B"] * 19))])
    jobs.load_listings(spark, root, both, DAY, TS, resume=True)
    got = spark.read.parquet(os.path.join(root, "stage")).select("district_name", "address").collect()
    assert sorted(map(tuple, got)) == [("信義區", "B"), ("大安區", "A")]


def test_integrate_without_a_check_list_fails(spark, root):
    with pytest.raises(ValueError, match="check list"):
        jobs.integrate_job(spark, root, DAY)
    assert spark.read.parquet(os.path.join(root, "error_log")).count() == 1


def test_rejects_do_not_double(spark, root, capsys):
    plan(spark, root, capsys)
    pages = listing_pages(spark, [("大安區", page(["A"] * 19, ["short"])), ("信義區", page(["short"], ["short"]))])
    for hour in (10, 11):
        assert jobs.load_listings(spark, root, pages, DAY, TS.replace(hour=hour))["rejects"] == 3
    other = listing_pages(spark, [("中山區", page(["short"]))])
    jobs.load_listings(spark, root, other, DAY, TS)
    rejects = spark.read.parquet(os.path.join(root, "rejects"))
    assert rejects.count() == 4
    assert {r.stage_date for r in rejects.collect()} == {DAY}

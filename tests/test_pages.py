import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ticketlake.sources import pages as P


def land(tmp_path, sizes, indent=None, skip=(), limit=3):
    for i, size in enumerate(sizes):
        if i in skip:
            continue
        folder = tmp_path / f"offset={i * limit}"
        folder.mkdir()
        items = [{"sys_id": f"{i}-{n}", "o": {"value": "x"}} for n in range(size)]
        (folder / "page.json").write_text(json.dumps({"result": items}, indent=indent))
    return str(tmp_path)


@pytest.mark.parametrize("sizes", [[3, 3, 2], [3, 3, 0], [3, 2, 0], [0]])
def test_complete_resources(spark, tmp_path, sizes):
    path = land(tmp_path, sizes)
    records = P.paged_scan(spark, path, limit=3)
    assert records.count() == sum(sizes)
    assert records.columns == ["offset", "position", "record"]


@pytest.mark.parametrize("sizes,skip", [([3, 3, 2], (1,)), ([3, 2, 3, 0], ()), ([3, 3], ()), ([2, 2, 0], ())])
def test_missing_or_cut_pages_are_an_error(spark, tmp_path, sizes, skip):
    with pytest.raises(P.MissingPages):
        P.paged_scan(spark, land(tmp_path, sizes, skip=skip), limit=3)


def test_coverage_is_gathered_while_the_records_are_read(spark, tmp_path):
    for name, skip in (("whole", ()), ("cut", (1,))):
        folder, seen = tmp_path / name, Observation()
        folder.mkdir()
        records = P.paged_scan(spark, land(folder, [3, 3, 2], skip=skip), limit=3, coverage=seen)
        records.write.format("noop").mode("overwrite").save()
        if skip:
            with pytest.raises(P.MissingPages):
                P.assert_complete(seen.get, limit=3)
        else:
            P.assert_complete(seen.get, limit=3)
            assert seen.get["records"] == 8


def test_broken_page_is_an_error(spark, tmp_path):
    path = land(tmp_path, [3, 1])
    (tmp_path / "offset=3" / "page.json").write_text('{"result": [{"sys_id": "cut')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        P.paged_scan(spark, path, limit=3).collect()


def test_indented_pages(spark, tmp_path):
    path = land(tmp_path, [3, 1], indent=2)
    assert P.paged_scan(spark, path, limit=3, multi_line=True).count() == 4


def test_single_page_is_whole(spark, tmp_path):
    path = land(tmp_path, [5], limit=10)
    assert P.single_page_scan(spark, path).count() == 5


def test_a_page_there_twice_does_not_make_up_for_a_lost_one(spark, tmp_path):
    path = land(tmp_path, [3, 3, 3, 2], skip=(2,))
    (tmp_path / "offset=3" / "again.json").write_text((tmp_path / "offset=3" / "page.json").read_text())
    with pytest.raises(P.MissingPages):
        P.paged_scan(spark, path, limit=3)


def test_power_sums_are_no_proof(spark):
    """Pages 0, 4, 5 lost and 1, 2, 6 there twice: same number, sum and sum of squares."""
    pages = [1, 1, 2, 2, 3, 6, 6]
    df = spark.createDataFrame([(3 * p, ["r"] * (2 if p == 6 else 3)) for p in pages], "offset LONG, result ARRAY<STRING>")
    with pytest.raises(P.MissingPages):
        P.assert_complete(P.page_coverage(df, 3).first().asDict(), 3)


def test_an_empty_resource_can_be_landed(spark, tmp_path):
    path = str(tmp_path / "pages")
    P.land_pages(spark.createDataFrame([], "offset LONG, record STRING"), path)
    assert P.paged_scan(spark, path).count() == 0


def test_landing_adds_the_empty_last_page(spark, tmp_path):
    path = str(tmp_path / "pages")
    records = spark.range(25).select(
        (F.floor(F.col("id") / P.PAGE_LIMIT) * P.PAGE_LIMIT).cast("long").alias("offset"), F.to_json(F.struct("id")).alias("record")
    )
    P.land_pages(records, path)
    assert P.page_coverage(P.read_pages(spark, path)).first()["pages"] == 2
    assert P.paged_scan(spark, path).count() == 25

"""Releases built as they are announced."""

import json
import os

import pytest
from pyspark.sql import functions as F

from mapsheaf.streaming import releases


@pytest.fixture
def place(spark, tmp_path):
    """A folder with three releases, and a function that announces some of their themes."""
    rows = [(r, t, n) for r in ("2024-08", "2024-09", "2024-10") for t in ("base", "places") for n in range(3)]
    spark.createDataFrame(rows, "release string, theme string, n int").write.partitionBy(
        "release", "theme").parquet(f"{tmp_path}/data")
    os.mkdir(f"{tmp_path}/announced")

    def announce(name, *themes):
        with open(f"{tmp_path}/announced/{name}.json", "w") as file:
            for release, theme in themes:
                file.write(json.dumps({"release": release, "theme": theme, "path": f"release={release}/theme={theme}"}) + "\n")

    def run(build=lambda rows: rows.withColumn("m", F.col("n") * 2), batch_files=10):
        return releases.build_releases(
            spark, f"{tmp_path}/announced", f"{tmp_path}/data", f"{tmp_path}/out", f"{tmp_path}/checkpoint", build, batch_files)

    return f"{tmp_path}/out", announce, run


def files(out):
    return {os.path.join(folder, name) for folder, _, names in os.walk(out) for name in names}


def held(spark, out):
    return sorted((r.release, r.theme, r.m) for r in releases.built_tables(spark, out).collect())


def expected(*themes):
    return sorted((release, theme, 2 * n) for release, theme in themes for n in range(3))


def test_each_release_is_built_once(spark, place):
    out, announce, run = place
    first = [("2024-08", "base"), ("2024-08", "places"), ("2024-09", "base")]
    announce("a", *first, ("2024-08", "weather"))
    assert run() == 1
    assert held(spark, out) == expected(*first)
    before = files(out)
    assert run() == 0 and files(out) == before
    # A theme that is announced again stays; the new theme of a known release joins it.
    announce("b", ("2024-09", "base"), ("2024-09", "places"))
    announce("c", ("2024-10", "base"))
    assert run(batch_files=1) == 2
    assert before <= files(out)
    assert held(spark, out) == expected(*first, ("2024-09", "places"), ("2024-10", "base"))
    assert {(r.release, r.latest) for r in releases.built(spark, out).collect()} == {
        ("2024-08", False), ("2024-09", False), ("2024-10", True)}


@pytest.mark.parametrize("after", [False, True])
def test_a_run_broken_around_its_record_leaves_one_copy(spark, place, monkeypatch, after):
    out, announce, run = place
    announce("a", ("2024-08", "base"), ("2024-09", "base"))
    record = releases._record

    def broken(*given):
        if after:
            record(*given)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(releases, "_record", broken)
        with pytest.raises(Exception, match="lost"):
            run()
    if not after:
        assert releases.built_tables(spark, out) is None
    assert run() == 1
    assert held(spark, out) == expected(("2024-08", "base"), ("2024-09", "base"))
    assert run() == 0

"""Tile tables in versions, and extracts of many views through a manifest."""

import os

import pytest
from pyspark.sql import functions as F

from mapsheaf.operators.tiling import tile_assign
from mapsheaf.operators.views import view_extract
from mapsheaf.sources import catalog, release, versions

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"
FEATURE = f"type string, id string, name string, bbox {BOX}"


def assign(rows):
    return tile_assign(rows, 0, 6).select("type", "id", "name", "z", "x", "y")


def features(spark, *rows):
    return spark.createDataFrame([(t, i, n, (x, x, y, y)) for t, i, n, x, y in rows], FEATURE)


def listing(out):
    return {os.path.join(folder, name) for folder, _, names in os.walk(out) for name in names if name.endswith(".parquet")}


def stored(spark, out):
    return sorted((tuple(r) for r in versions.read_tiles(spark, out, "base").select(
        "type", "id", "name", "z", "x", "y").collect()), key=repr)


def full(rows):
    return sorted((tuple(r) for r in assign(rows).collect()), key=repr)


OLD = [("land", "a", "A", -100.0, 40.0), ("land", "b", "B", 100.0, 40.0), ("land", "c", "C", 100.0, -40.0),
       ("land", None, "N", 10.0, 10.0), ("water", "a", "W", -100.0, -40.0)]


def test_update_equals_a_full_build_and_leaves_other_files(spark, tmp_path):
    out = str(tmp_path / "tiles")
    old = features(spark, *OLD)
    assert versions.read_tiles(spark, out, "base") is None
    assert versions.build_tiles(spark, out, "base", old, assign, depth=2) == 0
    before = listing(out)
    # One is renamed, one goes, one comes; the one without id loses a copy's worth of nothing.
    new = features(spark, ("land", "a", "A2", -100.0, 40.0), OLD[1], OLD[3], OLD[4], ("land", "d", "D", -101.0, 41.0))
    assert versions.update_tiles(spark, out, "base", old, new, assign) == 1
    assert stored(spark, out) == full(new)
    after = listing(out)
    assert before <= after
    written = {path.split("block=")[1].split("/")[0] for path in after - before if "block=" in path}
    # The blocks of a, d (west, north) and of c (gone: nothing is written there), and the coarse one.
    assert written == {"coarse", "0-1"}
    assert versions.update_tiles(spark, out, "base", new, new, assign) == 1
    assert listing(out) == after


def test_features_are_compared_as_bags(spark):
    twice = [("land", "a", "A", 1.0, 1.0)] * 2
    old = features(spark, *twice, ("land", None, "N", 1.0, 1.0), ("land", "n", None, 1.0, 1.0), (None, "z", "Z", 1.0, 1.0))
    new = features(spark, twice[0], ("land", None, "M", 1.0, 1.0), ("land", "n", None, 1.0, 1.0), (None, "z", "Z", 1.0, 1.0))
    assert {(r.type, r.id) for r in versions.changed_features(old, new).collect()} == {("land", "a"), ("land", None)}
    assert versions.changed_features(old, old).count() == 0
    with pytest.raises(ValueError):
        versions.changed_features(old, new.drop("name"))


def test_a_broken_update_is_not_seen_and_can_be_repeated(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "tiles")
    old = features(spark, *OLD)
    versions.build_tiles(spark, out, "base", old, assign, depth=1)
    new = features(spark, *OLD[:2])

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_switch", lost)
        with pytest.raises(RuntimeError):
            versions.update_tiles(spark, out, "base", old, new, assign)
    assert versions.current_version(spark, out, "base") == 0
    assert stored(spark, out) == full(old)
    assert versions.update_tiles(spark, out, "base", old, new, assign) == 1
    assert stored(spark, out) == full(new)


def test_a_theme_may_become_empty(spark, tmp_path):
    out = str(tmp_path / "tiles")
    old = features(spark, *OLD)
    versions.build_tiles(spark, out, "base", old, assign)
    assert versions.update_tiles(spark, out, "base", old, old.limit(0), assign) == 1
    assert versions.current_version(spark, out, "base") == 1
    assert versions.read_tiles(spark, out, "base") is None
    assert versions.update_tiles(spark, out, "base", old.limit(0), old, assign) == 2
    assert stored(spark, out) == full(old)


@pytest.fixture
def root(spark, tmp_path):
    """A release whose files hold ten degrees of longitude each."""
    rows = spark.range(3600).select(
        F.when(F.col("id") % 3 == 0, "water").otherwise("land").alias("type"), F.col("id").cast("string").alias("id"),
        F.floor(F.col("id") / 100).alias("strip"), F.struct(
            (F.col("id") / 10 - 180).alias("xmin"), (F.col("id") / 10 - 179.95).alias("xmax"),
            (F.col("id") % 100 - 50.0).alias("ymin"), (F.col("id") % 100 - 49.5).alias("ymax")).alias("bbox"))
    rows.repartitionByRange(36, "strip").drop("strip").write.partitionBy("type").parquet(f"{tmp_path}/r/theme=base")
    return f"{tmp_path}/r"


VIEWS = [(1, (-175.0, -172.0, -60.0, 60.0)), (2, (-174.0, -171.0, -10.0, 10.0)), (3, (175.0, -178.0, -60.0, 60.0)),
         (4, (0.0, 5.0, 70.0, 80.0)), (5, None), (6, (29.9, 29.9, -50.0, -50.0))]


@pytest.mark.parametrize("listed", [1000, 0])
def test_extracts_of_views_read_the_files_their_manifest_names(spark, root, listed):
    rows = release.scan_release(spark, root)
    views = spark.createDataFrame(VIEWS, f"view_id int, box {BOX}")
    choices = spark.createDataFrame([(n, ["land"] if n == 2 else ["land", "water"]) for n in range(1, 7)], "view_id int, types array<string>")
    manifest = catalog.file_manifest(rows, root)
    for chosen in (None, choices):
        found = catalog.extract_views(spark, manifest, root, views, chosen, listed_files=listed)
        pairs = sorted((r.view_id, r.id) for r in found.select("view_id", "id").collect())
        whole = view_extract(rows, views, chosen)
        assert pairs == sorted((r.view_id, r.id) for r in whole.select("view_id", "id").collect()) and pairs
        if listed:
            wanted = catalog.view_files(manifest, views, chosen).select("rel_path").distinct().collect()
            assert {"/".join(f.split("/")[-3:]) for f in found.inputFiles() if "/theme=" in f} == {r.rel_path for r in wanted}
            assert 0 < len(wanted) < 20


def test_views_without_files(spark, root):
    manifest = catalog.file_manifest(release.scan_release(spark, root), root)
    assert catalog.extract_views(spark, manifest, root, spark.createDataFrame(VIEWS[3:5], f"view_id int, box {BOX}")) is None


def test_files_with_features_across_180_degrees(spark, tmp_path):
    rows = spark.createDataFrame(
        [("land", "fiji", (179.0, -179.0, -18.0, -17.0)), ("land", "home", (10.0, 11.0, -18.0, -17.0))], f"type string, id string, bbox {BOX}")
    rows.coalesce(1).write.partitionBy("type").parquet(f"{tmp_path}/r/theme=base")
    whole = release.scan_release(spark, f"{tmp_path}/r")
    views = spark.createDataFrame([(1, (179.2, 179.4, -20.0, 0.0)), (2, (-179.4, -179.2, -20.0, 0.0)), (3, (50.0, 60.0, -20.0, 0.0))], f"view_id int, box {BOX}")
    found = catalog.extract_views(spark, catalog.file_manifest(whole, f"{tmp_path}/r"), f"{tmp_path}/r", views)
    assert sorted((r.view_id, r.id) for r in found.collect()) == [(1, "fiji"), (2, "fiji")]


def test_arranged_tiles_are_written_and_kept_without_a_shuffle(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "tiles")

    def placed(rows):
        return tile_assign(rows, 0, 6, by_place=2).select("type", "id", "name", "z", "x", "y")

    plans, write = [], versions.write_in_order
    monkeypatch.setattr(versions, "write_in_order", lambda df, *rest: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *rest)))
    old = features(spark, *OLD)
    new = features(spark, ("land", "a", "A2", -100.0, 40.0), OLD[1], OLD[3], OLD[4], ("land", "d", "D", -101.0, 41.0))
    assert versions.build_tiles(spark, out, "base", old, placed, 2, arranged=True) == 0
    assert versions.update_tiles(spark, out, "base", old, new, placed, arranged=True) == 1
    assert stored(spark, out) == full(new)
    # Features are dealt out once, before they have tiles, and stored tiles stay where they are.
    assert [plan.count("Repartition") for plan in plans] == [1, 1]

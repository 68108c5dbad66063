import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mapsheaf.functions.curve import hilbert
from mapsheaf.sources import catalog, footers, release

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"


def along(size, x, y):
    """Textbook walk along the curve."""
    d, s = 0, size // 2
    while s:
        rx, ry = int(x & s > 0), int(y & s > 0)
        d += s * s * ((3 * rx) ^ ry)
        if not ry:
            if rx:
                x, y = size - 1 - x, size - 1 - y
            x, y = y, x
        s //= 2
    return d


def test_hilbert_visits_neighbours(spark):
    cells = spark.range(16).crossJoin(spark.range(16).toDF("y")).toDF("x", "y")
    rows = cells.select("x", "y", hilbert((F.col("x") + 0.5) / 16, (F.col("y") + 0.5) / 16, 4).alias("d")).collect()
    assert {(r.x, r.y): r.d for r in rows} == {(r.x, r.y): along(16, r.x, r.y) for r in rows}
    walk = [(r.x, r.y) for r in sorted(rows, key=lambda r: r.d)]
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(walk, walk[1:], strict=False))
    odd = spark.createDataFrame([(-3.0, 0.5), (7.0, 7.0), (None, 0.5), (float("nan"), 0.5)], "x double, y double")
    assert [r.d for r in odd.select(hilbert(F.col("x"), F.col("y"), 4).alias("d")).collect()] == [
        along(16, 0, 8), along(16, 15, 15), None, None]


def box(x, y, size=0.01):
    return x, x + size, y, y + size


def groups(root):
    """Box of every row group below a folder, from the footers."""
    found = []
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(f"{folder}/{name}").metadata
                at = {meta.schema.column(n).path: n for n in range(meta.num_columns)}
                for g in range(meta.num_row_groups):
                    side = {s: meta.row_group(g).column(at[f"bbox.{s}"]).statistics for s in ("xmin", "xmax", "ymin", "ymax")}
                    found.append((side["xmin"].min, side["xmax"].max, side["ymin"].min, side["ymax"].max))
    return found


def test_clustered_row_groups_are_compact(spark, tmp_path):
    rng = random.Random(3)
    rows = [("place", f"p{n}", box(rng.uniform(-180, 179), rng.uniform(-85, 84))) for n in range(60_000)]
    frame = spark.createDataFrame(rows, f"type string, id string, bbox {BOX}")
    frame.repartition(4).write.partitionBy("type").parquet(f"{tmp_path}/in/theme=places")
    release.clip_release(spark, f"{tmp_path}/in", f"{tmp_path}/out", "places", cluster=True, row_group_bytes=16 << 10)
    # By whole degrees, latitude first.
    cell = ["type", F.floor("bbox.ymin"), F.floor("bbox.xmin"), "id"]
    frame.repartitionByRange(*cell).sortWithinPartitions(*cell).write.option("parquet.block.size", 16 << 10).partitionBy(
        "type").parquet(f"{tmp_path}/degrees")
    curve, degrees = groups(f"{tmp_path}/out"), groups(f"{tmp_path}/degrees")
    assert len(curve) > 100 and 0.7 < len(curve) / len(degrees) < 1.4

    def met(found):
        return sum(w <= x + 10 and e >= x and s <= y + 10 and n >= y for x, y in boxes for w, e, s, n in found)

    boxes = [(rng.uniform(-170, 160), rng.uniform(-75, 65)) for _ in range(10)]
    assert met(curve) * 2 <= met(degrees)
    assert release.scan_release(spark, f"{tmp_path}/out").count() == 60_000


@pytest.fixture
def root(spark, tmp_path):
    rows = [("land", "a", (-3.0, 4.0, 1.0, 2.0)), ("land", "b", (9.0, 9.5, -7.0, 8.0)), ("water", "c", (0.0, 0.0, 0.0, 0.0)),
            ("water", "d", None)]
    frame = spark.createDataFrame(rows, f"type string, id string, bbox {BOX}")
    frame.repartition(3, "id").write.partitionBy("type").parquet(f"{tmp_path}/r/theme=base")
    frame.limit(1).withColumn("type", F.lit("place")).write.partitionBy("type").parquet(f"{tmp_path}/r/theme=places")
    return f"{tmp_path}/r"


def listed(manifest):
    return sorted(tuple(r) for r in manifest.collect())


def test_footers_give_the_scanned_manifest(spark, root):
    manifest = footers.footer_manifest(spark, root)
    assert listed(manifest) == listed(catalog.file_manifest(release.scan_release(spark, root), root))
    found = footers.file_footers(spark, root)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.replace("*.parquet", "").lower().split("location")[0] and "path#" in plan
    assert "content" not in plan and all(r.known for r in found.collect())


def test_files_without_statistics_are_scanned(spark, root):
    folder = f"{root}/theme=base/type=land"
    name = next(n for n in sorted(os.listdir(folder)) if n.endswith(".parquet"))
    rows = pq.read_table(f"{folder}/{name}")
    pq.write_table(rows, f"{folder}/{name}", write_statistics=False)
    for crc in [n for n in os.listdir(folder) if n.endswith(".crc")]:
        os.remove(f"{folder}/{crc}")
    spark.catalog.refreshByPath(root)
    assert footers.file_footers(spark, root).where("not known").count() == 1
    assert listed(footers.footer_manifest(spark, root)) == listed(
        catalog.file_manifest(release.scan_release(spark, root), root))


def test_unreadable_paths_are_not_known(tmp_path):
    (tmp_path / "x.parquet").write_bytes(b"PAR1")
    assert [footers._read(p)["known"] for p in (f"file:{tmp_path}/x.parquet", "viewfs://store/x.parquet", f"file:{tmp_path}/no")] == [
        False, False, False]


def test_rows_go_to_folders_in_their_order_and_unsorted(spark, tmp_path):
    from mapsheaf.session import write_in_order

    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    frame = spark.range(1000, numPartitions=2).selectExpr("id % 3 AS folder", "1000 - id AS n")
    write_in_order(frame, str(tmp_path / "out"), "folder")
    assert spark.conf.get(name) == before
    for folder in range(3):
        files = sorted((tmp_path / "out" / f"folder={folder}").glob("*.parquet"))
        held = [r.n for file in files for r in spark.read.parquet(str(file)).collect()]
        assert held == [1000 - i for i in range(1000) if i % 3 == folder]

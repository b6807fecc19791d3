import pytest
from pyspark.sql import functions as F

from platewise.functions.naming import decoded_log_displacement, decoded_log_stress, target_name
from platewise.functions.numeric import clip
from platewise.models.regress import feature_nulls
from platewise.operators import quality
from platewise.operators.clean import clean, latest_per_key
from platewise.operators.integrity import make_manifest, manifest_lines, parse_manifest_lines, reconcile_checksums
from platewise.operators.requests import accepted, parse_cases, rejected, validate_requests
from platewise.operators.runs import latest_version
from platewise.operators.split import assert_split, check_ratios, split_hash, split_random, split_table
from platewise.plans.etl import run_etl, validate_folder
from platewise.session import object_store_conf
from platewise.sinks.tables import write_dated_chunks, write_metrics, write_warehouse
from platewise.sources.files import dataset_fingerprint, file_checksums
from platewise.sources.lake import scan_metrics, scan_prefer_parquet, scan_raw, scan_table, union_sources

NO_HOLE = {"geometry_type": "without_hole", "hole_radius_ratio": None}
MOVING = {"geometry_type": "with_hole_moving", "hole_cx_ratio": 0.5, "hole_cy_ratio": 0.5}


@pytest.mark.parametrize(
    "rule, change",
    [
        ("length_m", {"length_m": 0.0}),
        ("length_m", {"length_m": None}),
        ("height_m", {"height_m": -0.1}),
        ("young_modulus_pa", {"young_modulus_pa": 0.0}),
        ("poisson_ratio", {"poisson_ratio": 0.5}),
        ("poisson_ratio", {"poisson_ratio": 0.0}),
        ("traction_pa", {"traction_pa": -1.0}),
        ("mesh_nx", {"mesh_nx": 7}),
        ("mesh_ny", {"mesh_ny": 3}),
        ("max_displacement_m", {"max_displacement_m": -1e-9}),
        ("max_von_mises_pa", {"max_von_mises_pa": None}),
        ("material_category_blank", {"material_category": "  "}),
        ("dimension_category_blank", {"dimension_category": ""}),
        ("hole_radius_range", {"hole_radius_ratio": 0.5}),
        ("hole_cx_range", MOVING | {"hole_cx_ratio": 1.0}),
        ("hole_cy_range", MOVING | {"hole_cy_ratio": 0.0}),
        ("geometry_type_known", {"geometry_type": "round"}),
        ("with_hole_radius", {"hole_radius_ratio": None}),
        ("with_hole_center", {"hole_cx_ratio": 0.5}),
        ("without_hole_columns", NO_HOLE | {"hole_cy_ratio": 0.5}),
        ("moving_radius", MOVING | {"hole_radius_ratio": None}),
        ("moving_center", MOVING | {"hole_cy_ratio": None}),
    ],
)
def test_each_rule(plate_rows, rule, change):
    df = plate_rows(change, {}, NO_HOLE, MOVING)
    broken = {r["rule"]: r["n_violations"] for r in quality.rule_violations(df).filter("n_violations > 0").collect()}
    assert broken == {rule: 1}
    with pytest.raises(ValueError, match=rule):
        quality.assert_rules(df)
    assert quality.rows_with_violations(df).first()["broken_rules"] == [rule]


def test_clean_order_and_nulls(plate_rows):
    df = plate_rows(
        {"simulation_id": "a", "timestamp": "2026-01-01T00:00:00"},
        {"simulation_id": "a", "timestamp": "2026-01-02T00:00:00", "max_displacement_m": None},
        {"simulation_id": "b", "timestamp": "not a time"},
        {"simulation_id": "c", "max_von_mises_pa": float("nan")},
        {"simulation_id": None},
        {"simulation_id": None},
    )
    got = clean(df).collect()
    # a: its newest copy is incomplete; c: NaN counts as missing; the null id is one key.
    assert sorted(str(r["simulation_id"])[:8] for r in got) == sorted(["None", "3e23e816"])
    assert [r["timestamp"] for r in got if r["simulation_id"]] == [None]


def test_dedup_does_not_depend_on_partitions(spark, plate_rows):
    df = plate_rows(*[{"simulation_id": f"k{i % 3}", "traction_pa": 1e6 + i} for i in range(60)])
    a = sorted(map(tuple, latest_per_key(df.repartition(1)).collect()))
    b = sorted(map(tuple, latest_per_key(df.repartition(7)).collect()))
    assert a == b and [r[8] for r in a] == [1e6 + 57, 1e6 + 58, 1e6 + 59]


def test_empty_table(plate_rows):
    empty = plate_rows({}).filter("false")
    assert clean(empty).count() == 0
    assert quality.required_audit(empty).first().asDict() == {"n_rows": 0, "n_null_rows": 0, "n_duplicate_rows": 0}


def test_etl_and_folder(spark, plate_rows, tmp_path):
    raw = f"{tmp_path}/raw"
    plate_rows({"simulation_id": "a"}, {"simulation_id": "b"}).write.parquet(f"{raw}/one/date=2026-01-01")
    plate_rows({"simulation_id": "a"}).drop("hole_cx_ratio").write.parquet(f"{raw}/two/date=2026-01-02")
    counts = run_etl(spark, raw, f"{tmp_path}/wh", raw)
    assert counts["rows_read"] == 3 and counts["rows_written"] == 2 and counts["n_duplicates"] == 0
    assert len(spark.read.parquet(f"{tmp_path}/wh").columns) == 21
    assert validate_folder(spark, f"{tmp_path}/wh").first()["n_rows"] == 2
    dated = scan_raw(spark, raw, raw, partitioned=True)
    assert dated.filter("date = '2026-01-02'").count() == 1
    with pytest.raises(ValueError, match="duplicate"):
        validate_folder(spark, raw)


def test_warehouse_assertions(plate_rows):
    with pytest.raises(ValueError, match="duplicate"):
        quality.assert_warehouse(plate_rows({"simulation_id": "a"}, {"simulation_id": "a"}))
    with pytest.raises(ValueError, match="length_m"):
        quality.assert_warehouse(plate_rows({"length_m": None}))


def test_sources(spark, plate_rows, tmp_path):
    df = plate_rows({}, NO_HOLE)
    df.write.option("header", "true").csv(f"{tmp_path}/c")
    assert scan_prefer_parquet(spark, f"{tmp_path}/c").filter("length_m = 1.0").count() == 2
    df.limit(1).write.parquet(f"{tmp_path}/c/p")
    assert scan_prefer_parquet(spark, f"{tmp_path}/c").count() == 1
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        scan_prefer_parquet(spark, f"{tmp_path}/empty")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_table(spark, f"{tmp_path}/nowhere")
    both = union_sources(df, df.drop("geometry_type"))
    assert both.count() == 4 and both.filter("geometry_type IS NULL").count() == 2


def test_chunked_writer(spark, plate_rows, tmp_path):
    df = plate_rows(*[{} for _ in range(11)]).withColumn("timestamp", F.to_timestamp("timestamp")).coalesce(1)
    path = write_dated_chunks(df, f"{tmp_path}/d", chunk_rows=5)
    assert len(list((tmp_path / "d" / "date=2026-02-10").glob("*.parquet"))) == 3
    assert spark.read.parquet(path).count() == 11
    with pytest.raises(ValueError):
        write_dated_chunks(df, path, chunk_rows=0)


def test_metric_files(spark, tmp_path):
    names = ["r2_log", "rmse_log", "mae_log", "r2_orig", "rmse_orig", "mape"]
    schema = "target string, split string, " + ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame(
        [("a", "test", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0), ("a", "val", 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)], schema
    )
    csv, json = write_metrics(df, f"{tmp_path}/m")
    for fmt, path in (("csv", csv), ("json", json)):
        assert scan_metrics(spark, path, fmt, "val").select(*df.columns).collect() == df.filter("split = 'val'").collect()
    (tmp_path / "one.json").write_text('{\n "a": {"val": {"r2_log": 2.0}}\n}')
    assert scan_metrics(spark, f"{tmp_path}/one.json", "json", multiline=True).first()["r2_log"] == 2.0


def test_requests(spark, plate_rows):
    text = spark.createDataFrame(
        [
            (1, '{"geometry_type": "with_hole", "length_m": 0.2, "height_m": 0.05, "young_modulus_pa": 2.1e11, "poisson_ratio": 0.3, "traction_pa": 5e7, "material_category": " steel ", "dimension_category": "small", "hole_radius_ratio": 0.2}'),
            (2, "no json"),
        ],
        "id int, json string",
    )
    checked = validate_requests(parse_cases(text))
    good = accepted(checked).first()
    assert (good["id"], good["mesh_nx"], good["mesh_ny"], good["material_category"]) == (1, 120, 24, "steel")
    assert rejected(checked).count() == 1
    cases = {
        "geometry_type": {"geometry_type": "round"},
        "radius_required": {"hole_radius_ratio": None},
        "center_required": MOVING | {"hole_cx_ratio": None},
        "radius_forbidden": {"geometry_type": "without_hole"},
        "traction_pa": {"traction_pa": -1.0},
        "hole_cx_ratio": MOVING | {"hole_cx_ratio": 1.0},
        "mesh_ny": {"mesh_ny": 3},
    }
    got = validate_requests(plate_rows(*cases.values())).collect()
    assert [r["reasons"] for r in got] == [[name] for name in cases]


def test_names(spark):
    df = spark.createDataFrame([("a" * 64, 7, 4.75e7, 5.43e-6), ("b", 123456, 0.0, 1.0), ("c", 1, None, 1.0)], "id string, i int, v double, d double")
    named = df.select(target_name(F.col("id"), F.col("i"), F.col("v"), F.col("d")).alias("n"))
    names = [r["n"] for r in named.collect()]
    assert names == ["a" * 16 + "_00007_V76767_D67348", "b_123456", "c_00001"]
    back = named.select(decoded_log_stress(F.col("n")), decoded_log_displacement(F.col("n"))).collect()
    assert back[0][0] == 7.6767 and back[0][1] == pytest.approx(-5.2652) and back[1][0] is None


def test_checksums(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello")
    (tmp_path / "b.txt").write_text("world")
    sums = file_checksums(spark, str(tmp_path)).select(F.col("name").alias("path"), "sha256")
    assert sums.filter("path = 'a.txt'").first()["sha256"] == "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    wanted = spark.createDataFrame([("a.txt",), ("b.txt",), ("c.txt",)], "path string")
    manifest = make_manifest(wanted, sums)
    stored = parse_manifest_lines(manifest_lines(manifest)).collect()
    assert len(stored) == 3
    before = spark.createDataFrame(stored)
    first = dataset_fingerprint(sums).first()["fingerprint"]
    assert dataset_fingerprint(sums.orderBy(F.desc("path")).repartition(3)).first()["fingerprint"] == first
    (tmp_path / "a.txt").write_text("changed")
    now = file_checksums(spark, str(tmp_path), "a.txt").select(F.col("name").alias("path"), "sha256")
    status = {r["path"]: r["status"] for r in reconcile_checksums(before, now).collect()}
    assert status == {"a.txt": "CHECKSUM_MISMATCH", "b.txt": "MISSING", "c.txt": "SKIP"}
    assert dataset_fingerprint(now).first()["fingerprint"] != first
    assert dataset_fingerprint(now.filter("false")).first()["n_files"] == 0


def test_a_lookup_of_an_id_skips_row_groups(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("simulation_id"), "id")
    path = write_warehouse(rows.repartition(4), str(tmp_path / "w"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan that ran can be read
    try:
        scanned = []
        for value in ("7", "absent"):
            found = spark.read.parquet(path).where(F.col("simulation_id") == F.sha2(F.lit(value), 256))
            n = len(found.collect())
            leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
            scanned.append((n, leaves.head().metrics().apply("numOutputRows").value()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    (one, read_one), (none, read_none) = scanned
    assert (one, none) == (1, 0) and read_none == 0 and 0 < read_one <= 10_000  # groups that cannot hold the id are not read


def test_split_rules(spark):
    for bad in ((0.0, 0.1), (1.0, 0.0), (0.8, 0.2), (0.5, -0.1)):
        with pytest.raises(ValueError):
            check_ratios(*bad)
    ids = spark.range(2000).select(F.concat(F.lit("s-"), "id").alias("simulation_id"))
    with pytest.raises(ValueError):
        split_table(ids, "other")
    with pytest.raises(ValueError):
        split_hash(ids.withColumnRenamed("simulation_id", "x"))
    one, two = split_hash(ids).collect(), split_hash(ids.repartition(5)).orderBy("simulation_id").collect()
    assert sorted(one) == sorted(two)
    sizes = assert_split(split_random(ids))
    assert sizes == {"train": 1400, "val": 300, "test": 300}
    assert split_random(ids, seed=1).exceptAll(split_random(ids, seed=2)).count() > 0
    with pytest.raises(ValueError, match="at least 3"):
        assert_split(split_random(ids.limit(2)))
    with pytest.raises(Exception, match="null id"):
        split_hash(spark.createDataFrame([(None,)], "simulation_id string")).collect()


def test_latest_version(spark):
    df = spark.createDataFrame([("m", "v20260101_000000"), ("m", "v20260301_000000"), ("n", "v1")], "name string, version string")
    got = {r["name"]: (r["latest_version"], r["n_versions"]) for r in latest_version(df).collect()}
    assert got == {"m": ("v20260301_000000", 2), "n": ("v1", 1)}


def test_object_store_conf():
    conf = object_store_conf("http://store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_source_from_path(spark):
    from platewise.sources.lake import source_of_path

    paths = ["s3a://raw-plates/one/date=2026-01-01/p.parquet", "file:/data/raw/two/p.parquet", "file:/lake/three/p.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(source_of_path(F.col("p"))).collect()] == ["one", "two", ""]
    assert [r[0] for r in df.select(source_of_path(F.col("p"), "file:/lake")).collect()] == ["", "", "three"]


NAN = float("nan")
FLOATS = ["length_m", "height_m", "young_modulus_pa", "poisson_ratio", "traction_pa", "max_displacement_m", "max_von_mises_pa"]


@pytest.mark.parametrize("column", FLOATS)
def test_nan_breaks_each_rule_like_null(plate_rows, column):
    df = plate_rows({column: NAN}, {})
    broken = {r["rule"] for r in quality.rule_violations(df).filter("n_violations > 0").collect()}
    assert broken == {column}
    assert quality.required_audit(df).first()["n_null_rows"] == 1
    assert quality.warehouse_quality(df).first()[f"null_{column}"] == 1
    with pytest.raises(ValueError):
        quality.validate_table(df)


def test_nan_in_requests_features_and_clip(spark, plate_rows):
    for column in FLOATS[:5]:
        assert column in validate_requests(plate_rows({column: NAN})).first()["reasons"]
    assert "radius_required" in validate_requests(plate_rows({"hole_radius_ratio": NAN})).first()["reasons"]
    df = spark.createDataFrame([(NAN, 1.0), (None, NAN), (2.0, 3.0)], "a double, b double")
    assert feature_nulls(df, ["a", "b"]).first()["n_null"] == 3
    kept = [r[0] for r in df.select(clip(F.col("a"), 0.0, 1.0)).collect()]
    assert kept[0] != kept[0] and kept[1:] == [None, 1.0]


def test_nan_is_null_after_reading(spark, plate_rows, tmp_path):
    plate_rows({"height_m": NAN}).write.parquet(f"{tmp_path}/raw/a/x")
    assert scan_raw(spark, f"{tmp_path}/raw").first()["height_m"] is None
    assert scan_prefer_parquet(spark, f"{tmp_path}/raw").first()["height_m"] is None


def test_names_are_decoded_without_folder_and_extension(spark):
    names = ["a/b_1/case_00001_V65000_D73617.png", "case_00001_V65000_D73617", r"c:\x\case_00001_V65000_D73617.npy", "case_00001.png"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [tuple(r) for r in df.select(decoded_log_stress(F.col("n")), decoded_log_displacement(F.col("n"))).collect()]
    assert got[0] == got[1] == got[2] and got[0][0] == 6.5 and got[3] == (None, None)

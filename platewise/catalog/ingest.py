"""Sources, cleaning, quality, warehouse reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from platewise.catalog.base import (
    DEDUP,
    FILLED,
    PLATE_COLUMNS,
    PLATES,
    SIGNAL,
    WAREHOUSE,
    plates,
    query,
    stamp,
    stored_plates,
    table,
    warehouse,
)
from platewise.constants import CRITICAL_COLUMNS, REQUIRED_COLUMNS
from platewise.functions.naming import date_partition
from platewise.operators import clean as c
from platewise.operators import eda, geometry, quality, requests
from platewise.operators.features import prepare_holes
from platewise.operators.integrity import make_manifest, reconcile_checksums
from platewise.plans.etl import run_etl, validate_folder
from platewise.plans.feature_store import feature_list, features_with_split
from platewise.session import new_path
from platewise.sinks import tables as sinks
from platewise.sources import lake
from platewise.sources.files import dataset_fingerprint, file_checksums, file_inventory

_COUNTS = "count(*) AS n, count(hole_radius_ratio) AS n_radius, count(geometry_type) AS n_geometry, min(traction_pa) AS min_traction, max(traction_pa) AS max_traction"


def _counts():
    return [
        F.count("*").alias("n"),
        F.count("hole_radius_ratio").alias("n_radius"),
        F.count("geometry_type").alias("n_geometry"),
        F.min("traction_pa").alias("min_traction"),
        F.max("traction_pa").alias("max_traction"),
    ]


def raw_lake(spark, sf):
    """The plates as a raw lake: one folder per source, each with only the columns that source has."""
    root = new_path(spark, "raw")
    rows = plates(spark, sf)
    hole = ["hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio", "geometry_type"]
    lacks = {
        "sim_v1": ["hole_cx_ratio", "hole_cy_ratio", "geometry_type"],
        "sim_v1_wide": ["hole_cx_ratio", "hole_cy_ratio", "geometry_type"],
        "sim_v1_without_hole": hole[:3],
        "sim_v2_moving_hole": [],
    }
    for source, absent in lacks.items():
        part = rows.filter(F.col("source") == source).drop("source", *absent)
        sinks.write_dated_chunks(part, f"{root}/{source}", date=date_partition(F.trunc("timestamp", "year")))
    return root


@query("scan_raw", f"WITH {PLATES} SELECT source, {_COUNTS} FROM plates GROUP BY source")
def scan_raw(spark, sf):
    root = raw_lake(spark, sf)
    return lake.scan_raw(spark, root, root).groupBy("source").agg(*_counts())


@query("tag_source", f"WITH {PLATES} SELECT source, count(*) AS n FROM plates GROUP BY source")
def tag_source(spark, sf):
    root = raw_lake(spark, sf)
    tagged = spark.read.option("recursiveFileLookup", "true").parquet(root)
    return tagged.select(lake.source_of_path(F.col("_metadata.file_path"), root).alias("source")).groupBy("source").agg(
        F.count("*").alias("n")
    )


@query("scan_prefer_parquet", f"WITH {PLATES} SELECT {_COUNTS} FROM plates")
def scan_prefer_parquet(spark, sf):
    root = raw_lake(spark, sf)
    sinks.write_csv(plates(spark, sf).select("simulation_id").limit(1), f"{root}/legacy")
    return lake.scan_prefer_parquet(spark, root).agg(*_counts())


@query(
    "union_sources",
    f"WITH {PLATES} SELECT simulation_id, source, geometry_type, hole_radius_ratio, hole_cx_ratio FROM plates",
)
def union_sources(spark, sf):
    rows = plates(spark, sf)
    plain = rows.filter("source = 'sim_v1_without_hole'").drop("hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio")
    holes = rows.filter("source IN ('sim_v1', 'sim_v1_wide')").drop("geometry_type", "hole_cx_ratio", "hole_cy_ratio")
    moving = rows.filter("source = 'sim_v2_moving_hole'")
    return lake.union_sources(moving, holes, plain).select(
        "simulation_id", "source", "geometry_type", "hole_radius_ratio", "hole_cx_ratio"
    )


@query("scan_warehouse", f"{WAREHOUSE} SELECT simulation_id, source, max_von_mises_pa FROM clean WHERE traction_pa > 15e5")
def scan_warehouse(spark, sf):
    return warehouse(spark, sf).filter("traction_pa > 15e5").select("simulation_id", "source", "max_von_mises_pa")


@query("etl_clean", f"{WAREHOUSE} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, * EXCLUDE (ts) FROM clean")
def etl_clean(spark, sf):
    return c.clean(stored_plates(spark, sf)).withColumn("ts", stamp("timestamp")).drop("timestamp")


@query("etl_roundtrip", f"{WAREHOUSE} SELECT source, count(*) AS n, min(traction_pa) AS lo, max(traction_pa) AS hi FROM clean GROUP BY source")
def etl_roundtrip(spark, sf):
    root, path = raw_lake(spark, sf), new_path(spark, "warehouse")
    run_etl(spark, root, path, root)
    return spark.read.parquet(path).groupBy("source").agg(
        F.count("*").alias("n"), F.min("traction_pa").alias("lo"), F.max("traction_pa").alias("hi")
    )


@query(
    "write_partitioned",
    f"WITH {PLATES} SELECT strftime(date_trunc('month', ts), '%Y-%m-%d') AS date, count(*) AS n, max(traction_pa) AS hi FROM plates GROUP BY 1",
)
def write_partitioned(spark, sf):
    # Test dates span years, so plates are filed under the first day of their month.
    rows = plates(spark, sf)
    path = sinks.write_dated_chunks(rows, new_path(spark, "dated"), date_partition(F.trunc("timestamp", "month")))
    back = spark.read.option("basePath", path).schema(rows.schema.add("date", "string")).parquet(path)
    return back.groupBy("date").agg(F.count("*").alias("n"), F.max("traction_pa").alias("hi"))


@query("file_inventory")
def inventory(spark, sf):
    root = raw_lake(spark, sf)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(root)
    return file_inventory(rows, root)


@query("file_checksums")
def checksums(spark, sf):
    return file_checksums(spark, sf, "*.parquet").select("name", "n_bytes", "sha256")


# Documents play the files: one digest per text, a manifest taken before some texts change or vanish.
@query(
    "dataset_fingerprint",
    "WITH d AS (SELECT sha256(text) AS h FROM documents WHERE text IS NOT NULL) SELECT sha256("
    + " || '|' || ".join(f"CAST(CAST(coalesce(sum(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)), 0) AS BIGINT) AS VARCHAR)" for i in range(8))
    + " || '|' || count(*)) AS fingerprint, count(*) AS n_files FROM d",
)
def fingerprint(spark, sf):
    texts = table(spark, sf, "documents").where("text IS NOT NULL")
    return dataset_fingerprint(texts.select(F.sha2("text", 256).alias("sha256")))


@query("files_fingerprint")
def files_fingerprint(spark, sf):
    """The same over the bytes of files."""
    return dataset_fingerprint(file_checksums(spark, sf, "*.parquet"))


_DOCS = """now AS (SELECT doc_id, sha256(text || CASE WHEN doc_id % 7 = 0 THEN '!' ELSE '' END) AS actual FROM documents WHERE doc_id % 11 <> 0),
  manifest AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'MISSING' ELSE sha256(text) END AS expected FROM documents)"""


@query(
    "checksum_reconcile",
    f"""WITH {_DOCS} SELECT m.doc_id AS path, m.expected, n.actual, CASE WHEN m.expected = 'MISSING' THEN 'SKIP'
    WHEN n.actual IS NULL THEN 'MISSING' WHEN n.actual <> m.expected THEN 'CHECKSUM_MISMATCH' ELSE 'OK' END AS status
    FROM manifest m LEFT JOIN now n USING (doc_id)""",
)
def checksum_reconcile(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), "text")
    before = docs.filter("path % 13 <> 0").select("path", F.sha2("text", 256).alias("sha256"))
    manifest = make_manifest(docs, before)
    changed = F.concat("text", F.when(F.col("path") % 7 == 0, "!").otherwise(""))
    now = docs.filter("path % 11 <> 0").select("path", F.sha2(changed, 256).alias("sha256"))
    return reconcile_checksums(manifest, now)


# --- cleaning -------------------------------------------------------------------------------------
@query(
    "cast_timestamp",
    "SELECT l_orderkey, l_linenumber, strftime(CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END, '%Y-%m-%d %H:%M:%S') AS ts FROM lineitem",
)
def cast_timestamp(spark, sf):
    text = F.when(F.col("l_linenumber") == 3, F.lit("no time")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("timestamp"))
    return c.cast_timestamp(rows).select("l_orderkey", "l_linenumber", stamp("timestamp").alias("ts"))


@query("drop_null_critical", f"WITH {PLATES} SELECT simulation_id, source, max_displacement_m FROM plates WHERE max_displacement_m IS NOT NULL")
def drop_null_critical(spark, sf):
    return c.drop_null_critical(plates(spark, sf)).select("simulation_id", "source", "max_displacement_m")


@query("dedup_latest", f"WITH {PLATES}, {DEDUP} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, * EXCLUDE (ts, rn) FROM dedup")
def dedup_latest(spark, sf):
    return c.latest_per_key(stored_plates(spark, sf)).withColumn("ts", stamp("timestamp")).drop("timestamp")


@query(
    "upsert_latest",
    f"""WITH {PLATES}, both_tables AS (SELECT simulation_id, ts, max_von_mises_pa FROM plates WHERE source <> 'sim_v2_moving_hole'
    UNION ALL SELECT simulation_id, ts + INTERVAL 1 DAY, max_von_mises_pa * 2e0 FROM plates WHERE source <> 'sim_v1')
    SELECT simulation_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, max_von_mises_pa FROM (SELECT *, row_number() OVER (PARTITION BY simulation_id
    ORDER BY ts DESC NULLS LAST, max_von_mises_pa DESC NULLS LAST) AS rn FROM both_tables) WHERE rn = 1""",
)
def upsert_latest(spark, sf):
    rows = plates(spark, sf)
    target = rows.filter("source <> 'sim_v2_moving_hole'").select("simulation_id", "timestamp", "max_von_mises_pa")
    changes = rows.filter("source <> 'sim_v1'").select(
        "simulation_id",
        (F.col("timestamp") + F.expr("INTERVAL 1 DAY")).alias("timestamp"),
        (F.col("max_von_mises_pa") * 2.0).alias("max_von_mises_pa"),
    )
    return c.upsert_latest(target, changes).withColumn("ts", stamp("timestamp")).drop("timestamp")


@query("pseudonymize", f"WITH {PLATES} SELECT sha256(simulation_id) AS simulation_id, length(sha256(simulation_id)) AS id_length FROM plates")
def pseudonymize(spark, sf):
    return c.pseudonymize(plates(spark, sf).select("simulation_id")).withColumn("id_length", F.length("simulation_id"))


@query(
    "pseudonym_check",
    f"""{WAREHOUSE} SELECT sum(CASE WHEN simulation_id = 'sim-1-1' THEN 1 ELSE 0 END)::bigint AS n_plain,
    sum(CASE WHEN simulation_id = sha256('sim-1-1') THEN 1 ELSE 0 END)::bigint AS n_hashed FROM clean""",
)
def pseudonym_check(spark, sf):
    wh = warehouse(spark, sf).select("simulation_id")
    plain, hashed = F.lit("sim-1-1"), F.sha2(F.lit("sim-1-1"), 256)
    # Hashed ids lie in the range of every row group; the writer's bloom filters tell which groups cannot have the two.
    hits = wh.filter((F.col("simulation_id") == plain) | (F.col("simulation_id") == hashed))
    return hits.agg(
        F.count_if(F.col("simulation_id") == plain).alias("n_plain"), F.count_if(F.col("simulation_id") == hashed).alias("n_hashed")
    )


@query(
    "coerce_optional",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END AS hole_radius_ratio,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END AS hole_cx_ratio, CAST(NULL AS DOUBLE) AS hole_cy_ratio,
    l_returnflag AS geometry_type FROM lineitem""",
)
def coerce_optional(spark, sf):
    bad = lambda n, text, col_: F.when(F.col("l_linenumber") == n, F.lit(text)).otherwise(F.col(col_).cast("string"))
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        bad(1, "n/a", "l_discount").alias("hole_radius_ratio"),
        bad(2, "NaN", "l_tax").alias("hole_cx_ratio"),
        F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("geometry_type"),
    )
    return c.coerce_optional(rows)


# --- geometry ---------------------------------------------------------------------------------------
@query("drop_ambiguous", f"WITH {PLATES}, {SIGNAL} SELECT simulation_id, source, geometry_type, hole_radius_ratio FROM signal")
def drop_ambiguous(spark, sf):
    return geometry.resolve_ambiguous(plates(spark, sf)).select("simulation_id", "source", "geometry_type", "hole_radius_ratio")


@query(
    "keep_ambiguous",
    f"""WITH {PLATES} SELECT simulation_id, source, CASE WHEN geometry_type IS NULL AND hole_radius_ratio IS NULL AND hole_cx_ratio IS NULL
    THEN 'without_hole' ELSE geometry_type END AS geometry_type FROM plates""",
)
def keep_ambiguous(spark, sf):
    return geometry.resolve_ambiguous(plates(spark, sf), keep=True).select("simulation_id", "source", "geometry_type")


@query("infer_geometry", f"WITH {PLATES}, {SIGNAL}, {FILLED} SELECT simulation_id, geometry_type FROM filled")
def infer_geometry(spark, sf):
    rows = c.coerce_optional(geometry.resolve_ambiguous(plates(spark, sf)))
    return geometry.infer_geometry(rows).select("simulation_id", "geometry_type")


@query("hole_flags", f"WITH {PLATES}, {SIGNAL}, {FILLED} SELECT simulation_id, has_hole, has_moving_hole FROM filled")
def hole_flags(spark, sf):
    return prepare_holes(geometry.resolve_ambiguous(plates(spark, sf))).select("simulation_id", "has_hole", "has_moving_hole")


@query(
    "fill_hole_defaults",
    f"WITH {PLATES}, {SIGNAL}, {FILLED} SELECT simulation_id, hole_radius_ratio, hole_cx_ratio, hole_cy_ratio FROM filled",
)
def fill_hole_defaults(spark, sf):
    rows = prepare_holes(geometry.resolve_ambiguous(plates(spark, sf)))
    return rows.select("simulation_id", "hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio")


_INSIDE = """(hole_radius_ratio * least(length_m, height_m) > 0 AND hole_radius_ratio * least(length_m, height_m) < 0.5e0 * least(length_m, height_m)
  AND hole_radius_ratio * least(length_m, height_m) < hole_cx_ratio * length_m
  AND hole_cx_ratio * length_m < length_m - hole_radius_ratio * least(length_m, height_m)
  AND hole_radius_ratio * least(length_m, height_m) < hole_cy_ratio * height_m
  AND hole_cy_ratio * height_m < height_m - hole_radius_ratio * least(length_m, height_m))"""


@query("hole_inside_plate", f"WITH {PLATES} SELECT simulation_id, hole_radius_ratio, hole_cx_ratio, hole_cy_ratio FROM plates WHERE {_INSIDE}")
def hole_inside_plate(spark, sf):
    return geometry.hole_inside_plate(plates(spark, sf)).select("simulation_id", "hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio")


# --- quality ----------------------------------------------------------------------------------------
_RULES = {
    "length_m": "length_m > 0",
    "height_m": "height_m > 0",
    "young_modulus_pa": "young_modulus_pa > 0",
    "poisson_ratio": "poisson_ratio > 0 AND poisson_ratio < 0.5e0",
    "traction_pa": "traction_pa >= 0",
    "mesh_nx": "mesh_nx >= 8",
    "mesh_ny": "mesh_ny >= 4",
    "max_displacement_m": "coalesce(max_displacement_m >= 0, false)",
    "max_von_mises_pa": "max_von_mises_pa >= 0",
    "material_category_blank": "trim(material_category) <> ''",
    "dimension_category_blank": "trim(dimension_category) <> ''",
    "hole_radius_range": "hole_radius_ratio IS NULL OR (hole_radius_ratio > 0 AND hole_radius_ratio < 0.5e0)",
    "hole_cx_range": "hole_cx_ratio IS NULL OR (hole_cx_ratio > 0 AND hole_cx_ratio < 1)",
    "hole_cy_range": "hole_cy_ratio IS NULL OR (hole_cy_ratio > 0 AND hole_cy_ratio < 1)",
    "geometry_type_known": "geometry_type IS NULL OR geometry_type IN ('', 'with_hole', 'without_hole', 'with_hole_moving')",
    "with_hole_radius": "NOT coalesce(geometry_type = 'with_hole' AND hole_radius_ratio IS NULL, false)",
    "with_hole_center": "NOT coalesce(geometry_type = 'with_hole' AND (hole_cx_ratio IS NOT NULL OR hole_cy_ratio IS NOT NULL), false)",
    "without_hole_columns": "NOT coalesce(geometry_type = 'without_hole' AND (hole_radius_ratio IS NOT NULL OR hole_cx_ratio IS NOT NULL OR hole_cy_ratio IS NOT NULL), false)",
    "moving_radius": "NOT coalesce(geometry_type = 'with_hole_moving' AND hole_radius_ratio IS NULL, false)",
    "moving_center": "NOT coalesce(geometry_type = 'with_hole_moving' AND (hole_cx_ratio IS NULL OR hole_cy_ratio IS NULL), false)",
}


# Plates of which some break each rule; the same expressions run in Spark and in the checking SQL.
_BROKEN = {
    "length_m": "CASE WHEN height_m > 0.55e0 THEN 0e0 - length_m ELSE length_m END",
    "height_m": "CASE WHEN length_m > 2.1e0 THEN 0e0 ELSE height_m END",
    "young_modulus_pa": "CASE WHEN poisson_ratio > 0.345e0 THEN NULL ELSE young_modulus_pa END",
    "poisson_ratio": "CASE WHEN length_m < 0.6e0 THEN 0.5e0 ELSE poisson_ratio END",
    "traction_pa": "CASE WHEN height_m < 0.12e0 THEN -1e0 ELSE traction_pa END",
    "mesh_nx": "CASE WHEN length_m > 1.9e0 THEN 7 ELSE mesh_nx END",
    "mesh_ny": "CASE WHEN length_m > 2e0 THEN 3 ELSE mesh_ny END",
    "max_displacement_m": "CASE WHEN height_m > 0.5e0 THEN -1e0 ELSE max_displacement_m END",
    "max_von_mises_pa": "CASE WHEN length_m < 0.7e0 THEN NULL ELSE max_von_mises_pa END",
    "material_category": "CASE WHEN length_m > 1.5e0 AND height_m > 0.4e0 THEN '  ' ELSE material_category END",
    "dimension_category": "CASE WHEN height_m < 0.2e0 AND length_m > 1e0 THEN '' ELSE dimension_category END",
    "geometry_type": "CASE WHEN geometry_type IS NULL AND length_m > 1e0 THEN 'with_hole' WHEN length_m < 0.65e0 THEN 'square' ELSE geometry_type END",
    "hole_radius_ratio": "CASE WHEN height_m > 0.45e0 THEN 0.5e0 WHEN height_m < 0.15e0 THEN NULL ELSE hole_radius_ratio END",
    "hole_cx_ratio": "CASE WHEN length_m > 1.2e0 AND geometry_type IS NULL THEN 1e0 WHEN height_m > 0.52e0 THEN NULL ELSE hole_cx_ratio END",
    "hole_cy_ratio": "CASE WHEN geometry_type = 'without_hole' AND length_m > 1.8e0 THEN -0.1e0 ELSE hole_cy_ratio END",
}


@query(
    "quality_rules",
    f"WITH {PLATES}, broken AS (SELECT * REPLACE ({', '.join(f'{e} AS {n}' for n, e in _BROKEN.items())}) FROM plates) " + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, sum(CASE WHEN {ok} THEN 0 ELSE 1 END)::bigint AS n_violations FROM broken" for n, ok in _RULES.items()
    ),
)
def quality_rules(spark, sf):
    """Violations of every rule among plates of which some break it."""
    return quality.rule_violations(plates(spark, sf).withColumns({n: F.expr(e) for n, e in _BROKEN.items()}))


_required = " OR ".join(f"{'ts' if x == 'timestamp' else x} IS NULL" for x in REQUIRED_COLUMNS)


@query(
    "quality_required",
    f"""WITH {PLATES} SELECT count(*) AS n_rows, sum(CASE WHEN {_required} THEN 1 ELSE 0 END)::bigint AS n_null_rows,
    count(*) - count(DISTINCT simulation_id) AS n_duplicate_rows FROM plates""",
)
def quality_required(spark, sf):
    return quality.required_audit(plates(spark, sf))


@query(
    "dup_audit",
    f"""WITH {PLATES} SELECT count(*) AS n_rows, count(DISTINCT simulation_id) AS n_distinct,
    count(*) - count(DISTINCT simulation_id) AS n_duplicates FROM plates""",
)
def dup_audit(spark, sf):
    return quality.duplicate_audit(plates(spark, sf))


@query(
    "null_counts",
    f"WITH {PLATES} " + " UNION ALL ".join(f"SELECT '{x}' AS column, (count(*) - count({x}))::bigint AS n_null FROM plates" for x in CRITICAL_COLUMNS),
)
def null_counts(spark, sf):
    return quality.null_counts(plates(spark, sf))


@query(
    "warehouse_quality",
    f"{WAREHOUSE} SELECT count(*) AS n_rows, count(*) - count(DISTINCT simulation_id) AS n_duplicates, "
    + ", ".join(f"count(*) - count({x}) AS null_{x}" for x in CRITICAL_COLUMNS)
    + " FROM clean",
)
def warehouse_quality(spark, sf):
    return quality.warehouse_quality(warehouse(spark, sf))


@query(
    "validation_summary",
    f"""WITH {PLATES} SELECT count(*) AS n_rows, count(DISTINCT source) AS n_files,
    (SELECT string_agg(g, ',' ORDER BY g) FROM (SELECT DISTINCT geometry_type AS g FROM plates WHERE trim(geometry_type) <> '')) AS geometry_types,
    max(max_von_mises_pa) AS max_vm, max(max_displacement_m) AS max_disp FROM plates""",
)
def validation_summary(spark, sf):
    # Sources play the files here; over a folder the file path is counted.
    return quality.validation_summary(plates(spark, sf), F.col("source"))


@query(
    "validate_folder",
    f"{WAREHOUSE} SELECT count(*) AS n_rows, max(max_von_mises_pa) AS max_vm, max(max_displacement_m) AS max_disp FROM clean",
)
def folder_validation(spark, sf):
    path = sinks.write_warehouse(c.clean(plates(spark, sf)), new_path(spark, "folder"))
    return validate_folder(spark, path).select("n_rows", "max_vm", "max_disp")


@query("distinct_geometry", f"WITH {PLATES} SELECT DISTINCT trim(geometry_type) AS geometry_type FROM plates WHERE trim(geometry_type) <> ''")
def distinct_geometry(spark, sf):
    return quality.distinct_geometry(plates(spark, sf))


# --- requests: plates sent as JSON, with some fields broken ------------------------------------------
def _request_rows(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .selectExpr("l_orderkey", "l_linenumber", "l_partkey % 10 AS k", *[f"{e} AS {n}" for n, e in PLATE_COLUMNS.items() if n != "ts"])
        .withColumns(
            {
                "poisson_ratio": F.when(F.col("k") == 1, 0.5).otherwise(F.col("poisson_ratio")),
                "material_category": F.when(F.col("k") == 2, "  ").otherwise(F.col("material_category")),
                "hole_radius_ratio": F.when(F.col("k") == 3, 0.6).otherwise(F.col("hole_radius_ratio")),
                "mesh_nx": F.when(F.col("k") == 4, F.lit(None).cast("int")).when(F.col("k") == 5, 7).otherwise(F.col("mesh_nx")),
                "length_m": F.when(F.col("k") == 6, -1.0).otherwise(F.col("length_m")),
            }
        )
    )


_REQUESTS = f"""requests AS (SELECT l_orderkey, l_linenumber, l_partkey % 10 AS k, {', '.join(f'{e} AS {n}' for n, e in PLATE_COLUMNS.items() if n != 'ts')} FROM lineitem),
  broken AS (SELECT * REPLACE (CASE WHEN k = 1 THEN 0.5e0 ELSE poisson_ratio END AS poisson_ratio,
    CASE WHEN k = 2 THEN '  ' ELSE material_category END AS material_category,
    CASE WHEN k = 3 THEN 0.6e0 ELSE hole_radius_ratio END AS hole_radius_ratio,
    CASE WHEN k = 4 THEN NULL WHEN k = 5 THEN 7 ELSE mesh_nx END AS mesh_nx,
    CASE WHEN k = 6 THEN -1e0 ELSE length_m END AS length_m) FROM requests)"""
_FIELDS = [
    "geometry_type", "length_m", "height_m", "young_modulus_pa", "poisson_ratio", "traction_pa", "material_category",
    "dimension_category", "hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio", "mesh_nx", "mesh_ny",
]


@query("parse_cases", f"WITH {_REQUESTS} SELECT l_orderkey, l_linenumber, {', '.join(_FIELDS)} FROM broken")
def parse_cases(spark, sf):
    rows = _request_rows(spark, sf).select("l_orderkey", "l_linenumber", F.to_json(F.struct(*_FIELDS)).alias("json"))
    return requests.parse_cases(rows)


@query(
    "validate_requests",
    f"""WITH {_REQUESTS} SELECT l_orderkey, l_linenumber, concat_ws(',',
    CASE WHEN geometry_type IS NULL THEN 'geometry_type' END, CASE WHEN length_m <= 0 THEN 'length_m' END,
    CASE WHEN poisson_ratio >= 0.5e0 THEN 'poisson_ratio' END, CASE WHEN trim(material_category) = '' THEN 'material_category' END,
    CASE WHEN hole_radius_ratio >= 0.5e0 THEN 'hole_radius_ratio' END, CASE WHEN mesh_nx < 8 THEN 'mesh_nx' END,
    CASE WHEN geometry_type IN ('with_hole', 'with_hole_moving') AND hole_radius_ratio IS NULL THEN 'radius_required' END,
    CASE WHEN geometry_type = 'with_hole_moving' AND (hole_cx_ratio IS NULL OR hole_cy_ratio IS NULL) THEN 'center_required' END,
    CASE WHEN geometry_type = 'without_hole' AND hole_radius_ratio IS NOT NULL THEN 'radius_forbidden' END) AS reasons FROM broken""",
)
def validate_requests(spark, sf):
    checked = requests.validate_requests(_request_rows(spark, sf))
    return checked.select("l_orderkey", "l_linenumber", F.array_join("reasons", ",").alias("reasons"))


# --- warehouse reports --------------------------------------------------------------------------------
@query("rows_by_source", f"{WAREHOUSE} SELECT source, count(*) AS n FROM clean GROUP BY source")
def rows_by_source(spark, sf):
    return eda.rows_by_source(warehouse(spark, sf))


@query(
    "source_stats",
    f"""{WAREHOUSE}, grouped AS (SELECT source, count(*) AS n, avg(max_von_mises_pa) AS vm, max(max_von_mises_pa) AS top, avg(max_displacement_m) AS d
    FROM clean GROUP BY source) SELECT source, n AS n_simulations, round(vm, 2) AS mean_von_mises_pa, round(top, 2) AS max_von_mises_pa,
    round(d, 8) AS mean_displacement_m FROM grouped""",
)
def source_stats(spark, sf):
    lake.register_view(warehouse(spark, sf), "warehouse")
    return eda.group_report(spark.table("warehouse"), eda.STRESS_AND_DISPLACEMENT, "n_simulations")


@query(
    "source_dispersion",
    f"""{WAREHOUSE}, listed AS (SELECT source, list(max_von_mises_pa) AS vm FROM clean GROUP BY source)
    SELECT source, round(list_min(vm), 2) AS min_von_mises_pa, round(list_max(vm), 2) AS max_von_mises_pa,
    round(list_aggregate(vm, 'stddev_samp'), 2) AS std_von_mises_pa FROM listed""",
)
def source_dispersion(spark, sf):
    return eda.group_report(warehouse(spark, sf), eda.STRESS_RANGE, "std_von_mises_pa")


@query(
    "source_stats_eda",
    f"""{WAREHOUSE} SELECT DISTINCT source, count(*) OVER g AS n_simulations, round(avg(max_von_mises_pa) OVER g, 2) AS mean_von_mises_pa,
    round(stddev_samp(max_von_mises_pa) OVER g, 2) AS std_von_mises_pa, round(avg(max_displacement_m) OVER g, 8) AS mean_displacement_m
    FROM clean WINDOW g AS (PARTITION BY source)""",
)
def source_stats_eda(spark, sf):
    return eda.group_report(warehouse(spark, sf), eda.STRESS_SPREAD, "mean_von_mises_pa")

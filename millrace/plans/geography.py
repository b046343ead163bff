"""Queries on work places: classification, rollups at three grains, region filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import places as P
from millrace.plans.catalog_base import Catalog
from millrace.session import table

CATALOG = Catalog()
query = CATALOG.query

_ALIASES = "(SELECT DISTINCT region_code, level_name, province_code, lower(unnest(list_concat([name_zh, name_en], coalesce(aliases, [])))) AS nm FROM regions)"
_VALUES = r"(SELECT DISTINCT rec_id, id, trim(unnest(regexp_split_to_array(trim(x), '\s*[;；、|\n/]\s*'))) AS t FROM (SELECT rec_id, id, unnest(list_append(coalesce(work_locations_raw, []), location)) AS x FROM jobs) WHERE x IS NOT NULL)"
_HITS = rf"""(SELECT t, region_code, level_name, province_code FROM (SELECT DISTINCT t FROM {_VALUES} WHERE t <> '') JOIN {_ALIASES} a
  ON CASE WHEN regexp_matches(nm, '[a-z]') THEN contains(' ' || trim(regexp_replace(lower(t), '[^a-z]+', ' ', 'g')) || ' ', ' ' || trim(regexp_replace(nm, '[^a-z]+', ' ', 'g')) || ' ') ELSE contains(lower(t), nm) END)"""
_CLASSES = f"""(WITH h AS (SELECT DISTINCT * FROM {_HITS}), pv AS (SELECT t, list(DISTINCT region_code) AS ps FROM h WHERE level_name = 'province' GROUP BY t),
  ct AS (SELECT h.t, list(DISTINCT h.region_code) AS cs, list(DISTINCT h.province_code) AS cp FROM h LEFT JOIN pv ON pv.t = h.t WHERE level_name = 'city' AND (pv.ps IS NULL OR list_contains(pv.ps, h.province_code)) GROUP BY h.t),
  w AS (SELECT t, list(DISTINCT region_code) FILTER (level_name = 'remote') AS rs, list(DISTINCT region_code) FILTER (level_name = 'nation') AS ns FROM h GROUP BY t)
  SELECT w.t, CASE WHEN pv.ps IS NULL AND len(ct.cp) > 1 THEN 'ambiguous' ELSE 'named' END AS status,
    CASE WHEN pv.ps IS NULL AND len(ct.cp) > 1 THEN [] WHEN pv.ps IS NOT NULL OR ct.cs IS NOT NULL THEN list_concat(coalesce(ct.cs, []), list_filter(coalesce(pv.ps, []), lambda p: NOT list_contains(coalesce(ct.cp, []), p))) ELSE coalesce(w.rs, w.ns) END AS codes
  FROM w LEFT JOIN pv ON pv.t = w.t LEFT JOIN ct ON ct.t = w.t)"""
_PLACES = f"""(WITH f AS (SELECT DISTINCT v.rec_id, v.id, r.region_code, r.level_name, r.province_code FROM {_VALUES} v JOIN (SELECT t, unnest(codes) AS region_code FROM {_CLASSES}) c ON c.t = v.t JOIN regions r ON r.region_code = c.region_code)
  SELECT * FROM f a WHERE CASE a.level_name WHEN 'province' THEN NOT EXISTS (SELECT 1 FROM f b WHERE b.rec_id = a.rec_id AND b.level_name = 'city' AND b.province_code = a.region_code)
    WHEN 'nation' THEN NOT EXISTS (SELECT 1 FROM f b WHERE b.rec_id = a.rec_id AND b.level_name IN ('city', 'province')) ELSE true END)"""


def _typed(jobs):
    return P.values_of(F.coalesce("work_locations_raw", F.array().cast("array<string>")), F.array("location"))


def record_places(spark, d):
    jobs = table(spark, d, "jobs").select("rec_id", "work_locations_raw", "location")
    return P.places_of(jobs, "rec_id", _typed(jobs), table(spark, d, "regions"))


@query(f"SELECT v.t AS value, coalesce(c.status, 'unknown') AS status, coalesce(array_to_string(list_sort(c.codes), ','), '') AS codes FROM (SELECT DISTINCT t FROM {_VALUES} WHERE t <> '') v LEFT JOIN {_CLASSES} c ON c.t = v.t")
def classified_values(spark, d):
    """Every distinct value typed for a place, and the places it names."""
    jobs = table(spark, d, "jobs")
    values = jobs.select(F.explode(_typed(jobs)).alias("value")).distinct()
    got = values.withColumn("c", P.classify(F.col("value"), P.names_of(table(spark, d, "regions"))))
    return got.select("value", "c.status", F.array_join("c.codes", ",").alias("codes"))


@query(f"SELECT rec_id, region_code, level_name FROM {_PLACES}")
def job_places(spark, d):
    return record_places(spark, d).select("rec_id", "region_code", "level_name")


@query(f"""WITH p AS (SELECT DISTINCT id, region_code, level_name, province_code FROM {_PLACES}), prov AS (SELECT province_code AS code, count(DISTINCT id) AS n FROM p WHERE level_name IN ('province', 'city') GROUP BY 1),
  own AS (SELECT region_code AS code, count(DISTINCT id) AS n FROM p GROUP BY 1)
  SELECT r.region_code, r.level_name, CASE WHEN r.level_name = 'province' THEN coalesce(prov.n, 0) ELSE coalesce(own.n, 0) END AS jobs, CASE WHEN r.level_name = 'province' THEN coalesce(own.n, 0) END AS province_only FROM regions r
  LEFT JOIN prov ON prov.code = r.region_code AND r.level_name = 'province' LEFT JOIN own ON own.code = r.region_code""")
def region_rollup(spark, d):
    """Postings per place at three grains: province (one with several places counts once), province alone, city; places without any count 0."""
    ids = table(spark, d, "jobs").select("rec_id", "id")
    found = record_places(spark, d).join(ids, "rec_id").select("id", "region_code", "level_name", "province_code").distinct()
    own = found.groupBy("region_code").agg(F.countDistinct("id").alias("own"))
    province = found.filter("level_name IN ('province', 'city')").groupBy(F.col("province_code").alias("region_code")).agg(F.countDistinct("id").alias("all"))
    rows = table(spark, d, "regions").select("region_code", "level_name").join(own, "region_code", "left").join(province, "region_code", "left")
    is_province, zero = F.col("level_name") == "province", F.lit(0)
    return rows.select("region_code", "level_name", F.when(is_province, F.coalesce("all", zero)).otherwise(F.coalesce("own", zero)).alias("jobs"), F.when(is_province, F.coalesce("own", zero)).alias("province_only"))


@query(f"SELECT DISTINCT j.rec_id, j.id, j.title FROM jobs j JOIN {_PLACES} p ON p.rec_id = j.rec_id WHERE p.province_code = '670000' AND p.region_code = '670100'")
def jobs_in_city(spark, d):
    """Records with one place that matches both codes, exactly."""
    here = record_places(spark, d).filter("province_code = '670000' AND region_code = '670100'").select("rec_id")
    return table(spark, d, "jobs").select("rec_id", "id", "title").join(here, "rec_id", "left_semi")


@query(f"""WITH s AS (SELECT DISTINCT j.source_id, p.region_code, p.level_name, p.province_code FROM jobs j JOIN {_PLACES} p ON p.rec_id = j.rec_id)
  SELECT id, source_key, lifecycle FROM sources WHERE lifecycle = 'approved' AND id IN (SELECT source_id FROM s WHERE level_name = 'nation' OR province_code = '670000')""")
def sources_in_province(spark, d):
    """Approved sources that serve a province; those that serve the whole country serve each."""
    serves = record_places(spark, d).filter("level_name = 'nation' OR province_code = '670000'").select("rec_id")
    ids = table(spark, d, "jobs").select("rec_id", F.col("source_id").alias("id")).join(serves, "rec_id", "left_semi").select("id").distinct()
    return table(spark, d, "sources").filter("lifecycle = 'approved'").select("id", "source_key", "lifecycle").join(F.broadcast(ids), "id", "left_semi")


@query("""SELECT province_code, name_zh AS province_name, (SELECT count(*) FROM regions c WHERE c.level_name = 'city' AND c.province_code = p.province_code) AS cities,
  coalesce((SELECT array_to_string(list(c.label ORDER BY c.region_code), ',') FROM regions c WHERE c.level_name = 'city' AND c.province_code = p.province_code), '') AS labels FROM regions p WHERE level_name = 'province'""")
def region_list(spark, d):
    """The dimension, a row per province with its cities."""
    regions = table(spark, d, "regions")
    cities = regions.filter("level_name = 'city'").groupBy("province_code").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("region_code", "label"))).alias("c"))
    rows = regions.filter("level_name = 'province'").select("province_code", F.col("name_zh").alias("province_name")).join(F.broadcast(cities), "province_code", "left")
    return rows.select("province_code", "province_name", F.coalesce("n", F.lit(0)).alias("cities"), F.coalesce(F.array_join(F.transform("c", lambda x: x["label"]), ","), F.lit("")).alias("labels"))


@query("""WITH t AS (SELECT DISTINCT query_id, regexp_replace(regexp_replace(query_text, '\\s*(招聘|校园招聘|岗位|jobs).*$', ''), '(省|市)$', '') AS k FROM discovery_hits), r AS (SELECT DISTINCT region_code, regexp_replace(unnest([name_zh, name_en]), '(省|市)$', '') AS k FROM regions)
  SELECT r.region_code, count(DISTINCT t.query_id) AS tasks FROM r LEFT JOIN t ON t.k = r.k GROUP BY 1""")
def tasks_per_region(spark, d):
    """Query tasks by the place they ask for, joined on the name without its suffix."""
    bare = lambda c: F.regexp_replace(c, "(省|市)$", "")
    tasks = table(spark, d, "discovery_hits").select("query_id", bare(F.regexp_replace("query_text", r"\s*(招聘|校园招聘|岗位|jobs).*$", "")).alias("k")).distinct()
    keys = table(spark, d, "regions").select("region_code", F.explode(F.array("name_zh", "name_en")).alias("n")).select("region_code", bare(F.col("n")).alias("k")).distinct()
    return keys.join(tasks, "k", "left").groupBy("region_code").agg(F.countDistinct("query_id").alias("tasks"))

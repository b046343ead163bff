"""Work places named in a text, by a dimension of places with their names; all built-in expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import let

#: What separates several places in one value.
SEPARATORS = r"\s*[;；、|\n/]\s*"
_LATIN = "[a-z]"


def _words(text: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), "[^a-z]+", " ")), F.lit(" "))


def names_of(regions: DataFrame, most: int = 20_000) -> Column:
    """The names of all places as one constant, ``array<struct<code, level, province, name, latin>>``; its size is checked."""
    name = F.explode(F.transform(F.concat(F.array("name_zh", "name_en"), F.coalesce("aliases", F.array().cast("array<string>"))), F.lower))
    rows = regions.select(F.col("region_code").alias("code"), F.col("level_name").alias("level"), F.col("province_code").alias("province"), name.alias("name")).filter("name <> ''").distinct()
    latin = F.col("name").rlike(_LATIN)
    found = rows.withColumn("latin", latin).withColumn("name", F.when(latin, _words(F.col("name"))).otherwise(F.col("name"))).orderBy("code", "name").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} place names")
    return F.from_json(F.lit(json.dumps([r.asDict() for r in found], ensure_ascii=False)), "array<struct<code:string,level:string,province:string,name:string,latin:boolean>>")


def classify(text: Column, names: Column) -> Column:
    """``struct<status, codes, candidates>`` of one value.

    A Latin name needs word boundaries, another may stand anywhere.  Named
    provinces limit the cities that count; cities of several provinces without
    any province named are only ``candidates``.  A province is told by its city
    where one is named.  Without either, remote work or the whole country may be
    meant; ``status`` is ``named``, ``ambiguous`` or ``unknown``.
    """

    def by_hits(hits: Column) -> Column:
        level = lambda name: F.filter(hits, lambda h: h["level"] == name)
        of = lambda rows, field: F.array_sort(F.array_distinct(F.transform(rows, lambda h: h[field])))
        parts = F.struct(of(level("province"), "code").alias("provinces"), level("city").alias("cities"), of(level("remote"), "code").alias("remote"), of(level("nation"), "code").alias("nation"))

        def decide(p: Column) -> Column:
            cities = F.filter(p["cities"], lambda c: (F.size(p["provinces"]) == 0) | F.array_contains(p["provinces"], c["province"]))

            def fold(x: Column) -> Column:
                ambiguous = (F.size(p["provinces"]) == 0) & (F.size(x["of"]) > 1)
                named = F.array_sort(F.concat(x["codes"], F.array_except(p["provinces"], x["of"])))
                wide = F.when(F.size(p["remote"]) > 0, p["remote"]).otherwise(p["nation"])
                none = F.array().cast("array<string>")
                codes = F.when(ambiguous, none).when(F.size(named) > 0, named).otherwise(wide)
                status = F.when(ambiguous, "ambiguous").when(F.size(codes) > 0, "named").otherwise("unknown")
                return F.struct(status.alias("status"), codes.alias("codes"), F.when(ambiguous, x["codes"]).otherwise(none).alias("candidates"))

            return let(F.struct(of(cities, "code").alias("codes"), of(cities, "province").alias("of")), fold)

        return let(parts, decide)

    plain = F.lower(F.coalesce(text, F.lit("")))
    return let(F.struct(plain.alias("p"), _words(plain).alias("w")), lambda t: let(F.filter(names, lambda n: F.when(n["latin"], F.contains(t["w"], n["name"])).otherwise(F.contains(t["p"], n["name"]))), by_hits))


def values_of(*columns: Column) -> Column:
    """All values of several fields (texts or arrays of texts), cut at the separators, blanks aside."""
    cut = lambda v: F.filter(F.split(F.trim(v), SEPARATORS), lambda x: x != "")
    return F.flatten(F.concat(*[F.transform(F.filter(c, lambda v: v.isNotNull()), cut) for c in columns]))


def places_of(rows: DataFrame, key: str, values: Column, regions: DataFrame) -> DataFrame:
    """``key, region_code, level_name, province_code``: the places a row names, the finest ones.

    Every distinct value is classified once.  A province goes when one of its
    cities is named by another value, the whole country when anything finer is.
    """
    names = names_of(regions)
    typed = rows.select(F.col(key), F.explode(F.array_distinct(values)).alias("_v"))
    known = typed.select("_v").distinct().select("_v", F.explode(classify(F.col("_v"), names)["codes"]).alias("region_code"))
    dim = F.broadcast(regions.select("region_code", "level_name", "province_code"))
    found = typed.join(known, "_v").select(key, "region_code").distinct().join(dim, "region_code")
    per_row = found.groupBy(key).agg(
        F.collect_set(F.when(F.col("level_name") == "city", F.col("province_code"))).alias("_with_city"),
        F.bool_or(F.col("level_name").isin("city", "province")).alias("_finer"),
        F.collect_list(F.struct("region_code", "level_name", "province_code")).alias("_places"),
    )
    kept = F.filter("_places", lambda p: F.when(p["level_name"] == "province", ~F.array_contains("_with_city", p["region_code"])).when(p["level_name"] == "nation", ~F.col("_finer")).otherwise(True))
    return per_row.select(key, F.inline(kept))

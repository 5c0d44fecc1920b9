"""The regional tables the whole way: source files written, read, cleaned, stored, read back.

Spark writes the sources from the test tables, in their own headers and encodings, and each
table is built from those files into a partitioned table. Files and tables lie in the
scratch folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.operators import count_matrix
from comarca.plans import fixed, reports, run
from comarca.queries import shapes
from comarca.queries.registry import query
from comarca.queries.table_queries import LIBRARY_ATTRIBUTES
from comarca.sources import scratch_path, source_tag, write_delimited


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name) + "/"


def _written(
    spark: SparkSession, sources: Mapping[str, DataFrame], encoding: str = "ISO-8859-1"
) -> str:
    """Write delimited sources under their file names; the folder they are in."""
    location = _folder(spark, "sources")
    for file, source in sources.items():
        write_delimited(source, location + file, encoding=encoding)
    return location


def _venue_files(spark: SparkSession, sf_dir: str) -> str:
    sources = shapes.venue_sources(spark, sf_dir)
    return _written(spark, {file: sources[source_tag(file)] for file in fixed.VENUE_FILES})


@query(shapes.CLEAN_VENUES)
def stored_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _folder(spark, "tables")
    run.build_venues(spark, _venue_files(spark, sf_dir), fixed.VENUE_FILES, target)
    return run.stored_table(spark, target, "garitos")


@query(shapes.CLEAN_VENUES)
def stored_venues_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the bars in two files of one name."""
    sources = shapes.venue_sources(spark, sf_dir)
    bars = sources.pop(fixed.BARS)
    recent = F.xxhash64("Nombre") % 2 == 0
    files = {
        "2020/bares.csv": bars.where(~recent),
        "2021/bares.csv": bars.where(recent),
        **{f"2021/{kind}.csv": source for kind, source in sources.items()},
    }
    target = _folder(spark, "tables")
    run.build_venues(spark, _written(spark, files), list(files), target)
    return run.stored_table(spark, target, "garitos")


@query(shapes.POSTAL_CODES)
def stored_postal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    venues = run.gather_venues(spark, _venue_files(spark, sf_dir), fixed.VENUE_FILES)
    return run.build_postal_codes(spark, venues, _folder(spark, "tables"))


@query(f"""
    SELECT city, count(*) FILTER (WHERE garito_kind = 'cafeterias') AS cafes,
           count(*) FILTER (WHERE garito_kind = 'bares') AS bars,
           count(*) FILTER (WHERE garito_kind = 'restaurantes') AS restaurants,
           count(address) AS total
    FROM ({shapes.CLEAN_VENUES}) WHERE county = 'burgos'
    GROUP BY city ORDER BY total DESC, city LIMIT 30
""")
def stored_cities_by_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report on the stored table, which reads the folders of one county only."""
    return reports.cities_by_venues(stored_venues(spark, sf_dir))


@query(shapes.CLEAN_SOCIAL)
def stored_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {
        fixed.ASSOCIATION_FILE: shapes.associations(spark, sf_dir),
        fixed.SPORTS_CLUB_FILE: shapes.sports_clubs(spark, sf_dir),
    }
    target = _folder(spark, "tables")
    run.build_social(spark, _written(spark, sources), *sources, target)
    return run.stored_table(spark, target, "social")


@query(shapes.CLEAN_CULTURAL)
def stored_cultural(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents are written many to a file and read element by element."""
    location, target = _folder(spark, "sources"), _folder(spark, "tables")
    for kind, documents in shapes.cultural_sources(spark, sf_dir).items():
        documents.select("document").write.json(f"{location}{kind}.json")
    run.build_cultural(spark, location, fixed.CULTURAL_FILES, target)
    return run.stored_table(spark, target, "cultural")


# Every library's document has three elements; the last two are an empty one and one with an attribute.
@query(f"""
    SELECT * EXCLUDE (library) REPLACE (
        3 * (SELECT count(*) FROM part WHERE p_partkey < library) + library_id AS library_id)
    FROM ({LIBRARY_ATTRIBUTES})
""")
def stored_library_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long view of documents of many lines each, read and numbered element by element."""
    location = _folder(spark, "sources")
    libraries = shapes.cultural_sources(spark, sf_dir)[fixed.LIBRARIES].orderBy("key")
    text = F.to_json(F.struct("document"), {"pretty": "true"})
    libraries.select(text).write.text(location + "libraries.json")
    long = run.library_attributes(spark, location, "libraries.json")
    return long.withColumnRenamed("LocalidadPadre", "parent")


@query(shapes.POPULATION)
def stored_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {fixed.POPULATION_FILE: shapes.population_source(spark, sf_dir)}
    target = _folder(spark, "tables")
    run.build_population(spark, _written(spark, sources, "UTF-8"), fixed.POPULATION_FILE, target)
    return run.stored_table(spark, target, "population")


@query(f"""
    SELECT county, count(*) AS codes, count(*) FILTER (WHERE city = 'Peñón 3') AS in_city
    FROM ({shapes.POSTAL_CODES}) GROUP BY county
""")
def stored_postal_codes_by_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = stored_postal_codes(spark, sf_dir)
    return count_matrix(codes, ["county"], "city", {"in_city": "Peñón 3"}, total="codes")

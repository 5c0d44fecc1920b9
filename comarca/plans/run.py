"""Build all stored tables from the source files, each source read once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from comarca.operators import audit
from comarca.plans import checks, fixed, reports, tables
from comarca.sources import read_elements, read_partitioned, read_versioned, scratch_path


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared scratch folder and read it back.

    Steps that use the table more than once then read columns from parquet instead of
    parsing the sources again, and a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gather_venues(spark: SparkSession, location: str, files: Sequence[str]) -> DataFrame:
    """The venue files as one staged table."""
    return staged(spark, tables.load_venues(spark, location, files), "venues")


def build_postal_codes(
    spark: SparkSession, venues: DataFrame, target: str, versioned: bool = False
) -> DataFrame:
    """The postal codes found in gathered venues, stored below ``target`` and read back."""
    tables.store_postal_codes(tables.postal_codes(venues), target, versioned)
    return stored_table(spark, target, "postal_codes", versioned)


def build_venues(
    spark: SparkSession, location: str, files: Sequence[str], target: str, versioned: bool = False
) -> dict[str, DataFrame]:
    """Venue files to ``postal_codes/`` and ``garitos/`` below ``target``.

    Returned, as by the other builds, are the checks of the table before its cleanup.
    """
    venues = gather_venues(spark, location, files)
    known = build_postal_codes(spark, venues, target, versioned)
    cleaned = tables.clean_venues(venues, known)
    tables.store_by_county_and_postal_code(cleaned, target + "garitos/", versioned)
    filled = stored_table(spark, target, "garitos", versioned)
    return {
        "Venues as gathered: nulls": checks.key_nulls(venues, "garitos"),
        "Venues: rows by step": audit([("gathered", venues), ("filled", filled)]),
    }


def build_social(
    spark: SparkSession, location: str, associations: str, sports_clubs: str, target: str,
    versioned: bool = False,
) -> dict[str, DataFrame]:
    gathered = tables.load_social(spark, location, associations, sports_clubs)
    social = staged(spark, gathered, "social")
    trace = tables.social_trace(social)
    trace = trace.over(staged(spark, trace.df, "social-trace"))
    tables.store_by_county_and_postal_code(trace.table(), target + "social/", versioned)
    return {
        "Social entries as gathered: nulls": checks.key_nulls(social, "social"),
        "Social entries as gathered: repeated keys": reports.repeated_social(social),
        "Social entries as gathered: voided": reports.voided_social(social),
        "Social entries: rows by step": trace.audit(),
    }


def build_cultural(
    spark: SparkSession, location: str, files: Sequence[str], target: str, versioned: bool = False
) -> dict[str, DataFrame]:
    cultural = staged(spark, tables.load_cultural(spark, location, files), "cultural")
    cleaned = tables.clean_cultural(cultural)
    tables.store_by_county_and_postal_code(cleaned, target + "cultural/", versioned)
    return {
        "Institutions as gathered: nulls": checks.key_nulls(cultural, "cultural"),
        "Institutions as gathered: repeated keys": reports.repeated_cultural(cultural),
        "Institutions as gathered: repeated keys and addresses": reports.repeated_cultural(
            cultural, with_address=True
        ),
        "Institutions: rows by step": tables.cultural_trace(cultural).audit(),
    }


def build_population(
    spark: SparkSession, location: str, file: str, target: str, versioned: bool = False
) -> None:
    people = tables.load_population(spark, location, file)
    tables.store_by_county(people, target + "population/", versioned)


def library_attributes(spark: SparkSession, location: str, file: str) -> DataFrame:
    """Every attribute of every library, from its file, read by many tasks.

    Libraries are numbered from 0 as they stand in the file.
    """
    return tables.element_attributes(read_elements(spark, location + file, "library_id"))


def build_region(
    spark: SparkSession, location: str, target: str, versioned: bool = False
) -> dict[str, DataFrame]:
    """All five tables from the files of one folder, under their usual names.

    Returned are the checks before cleanup, by title; nothing of them runs until one is
    looked at. With ``versioned`` each table gets a new version, and readers of the one before are
    not disturbed, whether the rebuild ends well or not; read it with ``versioned`` too.
    """
    found = {
        **build_venues(spark, location, fixed.VENUE_FILES, target, versioned),
        **build_social(
            spark, location, fixed.ASSOCIATION_FILE, fixed.SPORTS_CLUB_FILE, target, versioned
        ),
        **build_cultural(spark, location, fixed.CULTURAL_FILES, target, versioned),
    }
    build_population(spark, location, fixed.POPULATION_FILE, target, versioned)
    libraries = library_attributes(spark, location, f"{fixed.LIBRARIES}.json")
    return {**found, "Attributes of libraries": libraries}


def stored_table(
    spark: SparkSession, target: str, name: str, versioned: bool = False
) -> DataFrame:
    """One of the stored tables by folder name, with its documented schema."""
    schemas = {
        "garitos": fixed.VENUE_SCHEMA,
        "social": fixed.SOCIAL_SCHEMA,
        "cultural": fixed.CULTURAL_SCHEMA,
        "postal_codes": fixed.POSTAL_CODE_SCHEMA,
        "population": fixed.POPULATION_SCHEMA,
    }
    read = read_versioned if versioned else read_partitioned
    return read(spark, f"{target}{name}/", schemas[name])


def region_checks(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """Null and duplicate checks of the stored tables, by name."""
    found = {}
    for name in checks.REQUIRED:
        found[f"{name}: nulls"] = checks.key_nulls(stored_table(spark, target, name), name)
    for name in checks.UNIQUE:
        dupes = checks.key_dupes(stored_table(spark, target, name), name)
        found[f"{name}: repeated keys"] = dupes.limit(15)
    return found


def region_reports(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """All reports on the stored tables, by title. Nothing runs until one is looked at."""
    venues = stored_table(spark, target, "garitos")
    codes = stored_table(spark, target, "postal_codes")
    social = stored_table(spark, target, "social")
    cultural = stored_table(spark, target, "cultural")
    people = stored_table(spark, target, "population")
    return {
        "Venues sharing name, city and kind": reports.venue_groups(venues),
        "Most repeated venue names": reports.venue_names(venues),
        "Most repeated restaurant names": reports.venue_names(venues, fixed.RESTAURANTS, 15),
        "Counties by cafes": reports.counties_by_venues(venues),
        "Cities of a county by venues": reports.cities_by_venues(venues),
        "Cities with one postal code": reports.cities_with_one_postal_code(codes).limit(5),
        "Venue profile": reports.table_profile(venues),
        "Postal code profile": reports.table_profile(codes),
        "Counties of the social table": reports.counties(social),
        "Sports of a county by clubs": reports.sports_by_associations(social),
        "Cities by museums and libraries": reports.cities_by_cultural(cultural),
        "Museums of a city": reports.museums_in_city(cultural),
        "Museums by theme": reports.museums_by_theme(cultural),
        "Most populated cities": reports.most_populated(people),
        "Venues per 100,000 people": reports.highest_venue_rates(people, venues),
        "Venues per 100,000 people, 5000 people and more": reports.highest_venue_rates(
            people, venues, minimum_population=5000, k=30
        ),
    }

"""The five regional tables: from source files, or from DataFrames in the sources' shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.functions import code_to_label, leading_int, repair_text, strip_code, to_int
from comarca.operators import (
    Traced,
    attributes_long,
    attributes_wide,
    bucket_sums,
    canonicalise,
    dedup,
    derive_dimension,
    drop_sentinel,
    fill_from_lookup,
    unique_lookup,
)
from comarca.plans import fixed
from comarca.plans.checks import UNIQUE
from comarca.sources import (
    ATTRIBUTE_PATH,
    SLOTS,
    ingest_tagged,
    read_delimited,
    read_elements,
    source_tag,
    write_partitioned,
    write_versioned,
)


def _columns(headers: Mapping[str, str]) -> dict[str, Column]:
    """Output column -> source column. The county is a key, so it is lower-cased."""
    found = {name: F.col(f"`{header}`") for name, header in headers.items()}
    return {**found, "county": F.lower(found["county"])}


# Sources by kind; as pairs where several sources are of one kind.
Sources = Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]]


def _pairs(sources: Sources) -> Sequence[tuple[str, DataFrame]]:
    return list(sources.items()) if isinstance(sources, Mapping) else sources


# Venues ------------------------------------------------------------------------------


def venues(sources: Sources) -> DataFrame:
    """One table of all venues; ``sources`` maps kind to source, or lists such pairs."""
    parts = [(source, _columns(fixed.VENUE_COLUMNS), kind) for kind, source in _pairs(sources)]
    return ingest_tagged(parts, "garito_kind")


def load_venues(spark: SparkSession, location: str, files: Sequence[str]) -> DataFrame:
    """Venues from delimited files; the kind is the file's stem, which several files may share."""
    return venues([(source_tag(name), read_delimited(spark, location + name)) for name in files])


def postal_codes(venue_table: DataFrame) -> DataFrame:
    """The (county, city, postal code) combinations found in the venues."""
    return derive_dimension(venue_table, ["county", "city", "postal_code"], ["postal_code"])


def clean_venues(
    venue_table: DataFrame,
    postal_code_table: DataFrame | None = None,
    keys: Sequence[str] = ("city",),
) -> DataFrame:
    """Fill missing postal codes where the city has exactly one.

    The lookup is by city name alone unless ``keys`` says otherwise. Pass the stored postal
    codes when there are any, to save deriving them once more.
    """
    known = postal_codes(venue_table) if postal_code_table is None else postal_code_table
    lookup = unique_lookup(known, keys, "postal_code")
    return fill_from_lookup(venue_table, lookup, keys, "postal_code")


# Social ------------------------------------------------------------------------------


def social(associations: DataFrame, sports_clubs: DataFrame) -> DataFrame:
    """Associations and sports clubs as one table."""
    association_columns = {
        **_columns(fixed.ASSOCIATION_COLUMNS),
        "sports": F.lit(fixed.NO_SPORTS),
    }
    club_columns = _columns(fixed.SPORTS_CLUB_COLUMNS)
    return ingest_tagged(
        [
            (associations, association_columns, fixed.ASSOCIATION),
            (sports_clubs, club_columns, fixed.SPORTS_CLUB),
        ],
        "social_kind",
    )


def load_social(
    spark: SparkSession, location: str, associations: str, sports_clubs: str
) -> DataFrame:
    return social(
        read_delimited(spark, location + associations),
        read_delimited(spark, location + sports_clubs),
    )


def clean_counties(df: DataFrame) -> DataFrame:
    """Correct the two known misspellings and drop rows outside the nine counties."""
    return canonicalise(df, "county", fixed.COUNTY_FIXES, fixed.VALID_COUNTIES)


def social_trace(social_table: DataFrame, canonicalise_first: bool = False) -> Traced:
    """The same cleanup with its row counts, from one pass and one dedup."""
    kept = Traced.start(social_table, "gathered").without("without voided", "name", [fixed.VOIDED])
    if canonicalise_first:
        placed = kept.canonical("in a county", "county", fixed.COUNTY_FIXES, fixed.VALID_COUNTIES)
        return placed.single("one per key", UNIQUE["social"])
    single = kept.single("one per key", UNIQUE["social"])
    return single.canonical("in a county", "county", fixed.COUNTY_FIXES, fixed.VALID_COUNTIES)


def clean_social(social_table: DataFrame, canonicalise_first: bool = False) -> DataFrame:
    """Remove voided entries, keep one row per key, then clean the counties.

    In this order two spellings of a county keep a row each. ``canonicalise_first`` cleans
    the counties before the duplicates are looked for.
    """
    kept = drop_sentinel(social_table, "name", [fixed.VOIDED])
    if canonicalise_first:
        return dedup(clean_counties(kept), UNIQUE["social"])
    return clean_counties(dedup(kept, UNIQUE["social"]))


# Cultural ----------------------------------------------------------------------------


def cultural(sources: Sources) -> DataFrame:
    """One table of all cultural institutions; ``sources`` maps kind to its elements.

    Elements are rows with a list ``attributes``.
    """
    columns = {out: F.col(f"`{name}`") for out, name in fixed.CULTURAL_COLUMNS.items()}
    parts = [
        (
            attributes_wide(elements, "attributes", fixed.CULTURAL_ATTRIBUTES, SLOTS),
            columns,
            kind,
        )
        for kind, elements in _pairs(sources)
    ]
    return ingest_tagged(parts, "cultural_kind")


def load_cultural(spark: SparkSession, location: str, files: Sequence[str]) -> DataFrame:
    """Cultural institutions from JSON documents; the kind is the file's stem, which several may share."""
    return cultural([(source_tag(name), read_elements(spark, location + name)) for name in files])


def cultural_trace(cultural_table: DataFrame) -> Traced:
    """The cleanup of the cultural table with its row counts, from one pass."""
    gathered = Traced.start(cultural_table, "gathered")
    return gathered.canonical("in a county", "county", fixed.COUNTY_FIXES, fixed.VALID_COUNTIES)


def clean_cultural(cultural_table: DataFrame) -> DataFrame:
    """Clean the counties. Equal names are kept: they are branches at different addresses."""
    return clean_counties(cultural_table)


def cultural_attributes(
    documents: DataFrame, id_columns: Sequence[str] = (), position: str = "library_id"
) -> DataFrame:
    """Every attribute of every element with all its value slots, one row each."""
    return attributes_long(documents, ATTRIBUTE_PATH, id_columns, SLOTS, position)


def element_attributes(elements: DataFrame, position: str = "library_id") -> DataFrame:
    """The same for elements read on their own and counted, by as many tasks as ``read_elements`` has."""
    exploded = elements.select(position, F.explode("attributes").alias("attribute"))
    fields = [F.col(f"attribute.{field}").alias(field) for field in ("name", *SLOTS)]
    return exploded.select(position, *fields)


# Population --------------------------------------------------------------------------


def population(raw: DataFrame) -> DataFrame:
    """People per county and city in age ranges, from one row per city, sex and age.

    Keeps the region's municipalities (by code prefix), both sexes together, single ages.
    The prefix is looked up once per row: text files have no statistics to push it to.
    """
    municipality = F.col(fixed.MUNICIPALITY)
    code = F.substring(municipality, 1, 2)
    people = raw.where(
        (F.col(fixed.SEX) == fixed.BOTH_SEXES)
        & (F.col(f"`{fixed.AGE}`") != fixed.ALL_AGES)
        & code.isin(list(fixed.COUNTY_OF_CODE))
    ).select(
        code_to_label(code, fixed.COUNTY_OF_CODE).alias("county"),
        repair_text(strip_code(municipality)).alias("city"),
        leading_int(f"`{fixed.AGE}`").alias("age"),
        to_int(fixed.PEOPLE, data_type="long").alias("population"),
    )
    return bucket_sums(
        people,
        ["county", "city"],
        "age",
        "population",
        fixed.AGE_BUCKETS,
        fixed.TOTAL_POPULATION,
    )


def load_population(
    spark: SparkSession, location: str, file: str, encoding: str = "UTF-8"
) -> DataFrame:
    """Population from its delimited file. A file in another encoding lacks the expected
    headers and is refused by the analyzer."""
    return population(read_delimited(spark, location + file, encoding=encoding))


# Stored tables -----------------------------------------------------------------------


def store_by_county(df: DataFrame, path: str, versioned: bool = False) -> None:
    _store(df, path, ["county"], versioned)


def store_by_county_and_postal_code(df: DataFrame, path: str, versioned: bool = False) -> None:
    _store(df, path, ["county", "postal_code"], versioned)


def store_postal_codes(df: DataFrame, location: str, versioned: bool = False) -> None:
    store_by_county(df, location + "postal_codes/", versioned)


def _store(df: DataFrame, path: str, keys: Sequence[str], versioned: bool) -> None:
    """Replace a stored table, or with ``versioned`` add a version that readers are switched to."""
    (write_versioned if versioned else write_partitioned)(df, path, keys)

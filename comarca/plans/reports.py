"""Rankings, listings and rates over the regional tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.functions import contains_any
from comarca.operators import (
    count_by,
    count_matrix,
    distinct_values,
    explode_delimited,
    profile,
    rate_per,
    top_k,
    unique_lookup,
)
from comarca.plans import fixed
from comarca.plans.checks import key_dupes

VENUE_KEY = ["name", "county", "city", "garito_kind"]


def venue_groups(venues: DataFrame, k: int = 10) -> DataFrame:
    """Venues sharing name, place and kind, largest group first."""
    return top_k(count_by(venues, VENUE_KEY, "name"), "total", k, VENUE_KEY)


def venue_names(venues: DataFrame, kind: str | None = None, k: int = 30) -> DataFrame:
    """Most repeated names, of all venues or of one kind; counts venues with an address."""
    chosen = venues if kind is None else venues.where(F.col("garito_kind") == kind)
    return top_k(count_by(chosen, ["name"], "address"), "total", k, ["name"])


def counties_by_venues(venues: DataFrame, kind: str = fixed.CAFES, k: int = 10) -> DataFrame:
    """Counties by number of venues of a kind that have an address."""
    chosen = venues.where(F.col("garito_kind") == kind)
    return top_k(count_by(chosen, ["county"], "address"), "total", k, ["county"])


def venues_per_city(venues: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Venues per city, one count per kind; the total counts those with an address."""
    return count_matrix(venues, keys, "garito_kind", fixed.VENUE_KINDS, "address")


def cities_by_venues(venues: DataFrame, county: str = fixed.REPORT_COUNTY, k: int = 30) -> DataFrame:
    """Cities of one county by venues."""
    chosen = venues.where(F.col("county") == county)
    return top_k(venues_per_city(chosen), "total", k, ["city"])


def repeated_social(social: DataFrame, k: int = 15) -> DataFrame:
    return key_dupes(social, "social").limit(k)


def voided_social(social: DataFrame) -> DataFrame:
    return social.where(F.col("name") == fixed.VOIDED)


def counties(df: DataFrame) -> DataFrame:
    return distinct_values(df, "county")


def sports_by_associations(
    social: DataFrame, county: str = fixed.REPORT_COUNTY, k: int = 20, drop_empty: bool = False
) -> DataFrame:
    """Sports of one county by number of clubs listing them.

    The empty token after a trailing separator and the placeholder of associations count as
    sports unless ``drop_empty`` removes the former.
    """
    listed = social.where(F.col("county") == county).select("sports")
    tokens = explode_delimited(listed, "sports", fixed.SPORTS_SEPARATOR, drop_empty)
    counted = count_by(tokens, ["sports"], "sports", "sport_associations")
    return top_k(counted, "sport_associations", k, ["sports"])


def repeated_cultural(cultural: DataFrame, with_address: bool = False, k: int = 15) -> DataFrame:
    return key_dupes(cultural, "cultural", ("address",) if with_address else ()).limit(k)


def cities_by_cultural(cultural: DataFrame, k: int = 30) -> DataFrame:
    """Cities by museums and libraries; the total counts those with an address."""
    counted = count_matrix(
        cultural, ["county", "city"], "cultural_kind", fixed.CULTURAL_KINDS, "address"
    )
    return top_k(counted, "total", k, ["county", "city"])


def museums(cultural: DataFrame) -> DataFrame:
    return cultural.where(F.col("cultural_kind").contains(fixed.MUSEUM_WORD))


def museums_in_city(cultural: DataFrame, city: str = fixed.REPORT_CITY, k: int = 5) -> DataFrame:
    chosen = museums(cultural).where(F.col("city") == city).select("name", "address")
    return top_k(chosen, "name", k, ["address"], descending=False)


def museums_by_theme(
    cultural: DataFrame, words: Sequence[str] = tuple(fixed.WINE_AND_CHEESE), k: int = 15
) -> DataFrame:
    """Museums whose name holds one of the words, by county and city."""
    chosen = museums(cultural).where(contains_any("name", words))
    columns = ["county", "city", "name", "address"]
    return top_k(chosen.select(*columns), "county", k, columns[1:], descending=False)


def repeated_cities(population: DataFrame, k: int = 15) -> DataFrame:
    return key_dupes(population, "population").limit(k)


def most_populated(population: DataFrame, k: int = 12) -> DataFrame:
    """Largest cities first; the county only settles ties."""
    ranked = population.select("city", fixed.TOTAL_POPULATION, "county")
    return top_k(ranked, fixed.TOTAL_POPULATION, k, ["city", "county"]).drop("county")


def venue_rates(
    population: DataFrame,
    venues: DataFrame,
    minimum_population: int | None = None,
    keys: Sequence[str] = ("city",),
) -> DataFrame:
    """Venues per 100,000 people by city, for cities with at least one venue with an address.

    Matched by city name alone unless ``keys`` says otherwise: namesakes in two counties
    share their venues. The population has a row per city and county, so no city is hot.
    """
    totals = venues_per_city(venues, keys).where(F.col("total") >= 1).select(*keys, "total")
    people = population.select("county", "city", fixed.TOTAL_POPULATION)
    rates = rate_per(
        people, totals, keys, "total", fixed.TOTAL_POPULATION, minimum=minimum_population, salts=1
    )
    return rates.select("county", "city", fixed.TOTAL_POPULATION, "total", "ratio")


def highest_venue_rates(
    population: DataFrame,
    venues: DataFrame,
    minimum_population: int | None = None,
    k: int = 10,
) -> DataFrame:
    rates = venue_rates(population, venues, minimum_population)
    return top_k(rates, "ratio", k, ["county", "city"])


def cities_with_one_postal_code(postal_codes: DataFrame) -> DataFrame:
    return unique_lookup(postal_codes, ["city"], "postal_code")


def table_profile(df: DataFrame) -> DataFrame:
    return profile(df)

"""The reports, over the regional tables made from the test tables.

Reports on venues run on the filled table, stored in the scratch folder as the build of the
region stores it; so calling such a query runs the jobs that store it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from comarca.plans import reports
from comarca.plans.run import staged
from comarca.queries import shapes
from comarca.queries.registry import profile_sql, query
from comarca.queries.table_queries import (
    cultural_clean,
    cultural_table,
    population_table,
    postal_codes_table,
    social_clean,
    social_table,
    venues_clean,
    venues_table,
)

_THEME = "(name LIKE '%Vino%' OR name LIKE '%vino%' OR name LIKE '%ueso%')"
_CITY = "Peñón 3"


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, venues_clean(spark, sf_dir), "filled")


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, population_table(spark, sf_dir), "people")


@query(f"""
    SELECT name, county, city, garito_kind, count(name) AS total FROM ({shapes.VENUES})
    GROUP BY ALL ORDER BY total DESC, name, county, city, garito_kind LIMIT 10
""")
def report_venue_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.venue_groups(venues_table(spark, sf_dir))


@query(f"""
    SELECT name, count(address) AS total FROM ({shapes.CLEAN_VENUES})
    GROUP BY name ORDER BY total DESC, name LIMIT 30
""")
def report_venue_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.venue_names(_filled(spark, sf_dir))


@query(f"""
    SELECT name, count(address) AS total FROM ({shapes.CLEAN_VENUES})
    WHERE garito_kind = 'restaurantes' GROUP BY name ORDER BY total DESC, name LIMIT 15
""")
def report_restaurant_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.venue_names(_filled(spark, sf_dir), "restaurantes", 15)


@query(f"""
    SELECT county, count(address) AS total FROM ({shapes.CLEAN_VENUES})
    WHERE garito_kind = 'cafeterias' GROUP BY county ORDER BY total DESC, county LIMIT 10
""")
def report_counties_by_cafes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counties_by_venues(_filled(spark, sf_dir))


@query(f"""
    SELECT city, count(*) FILTER (WHERE garito_kind = 'cafeterias') AS cafes,
           count(*) FILTER (WHERE garito_kind = 'bares') AS bars,
           count(*) FILTER (WHERE garito_kind = 'restaurantes') AS restaurants,
           count(address) AS total
    FROM ({shapes.CLEAN_VENUES}) WHERE county = 'burgos'
    GROUP BY city ORDER BY total DESC, city LIMIT 30
""")
def report_cities_by_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cities_by_venues(_filled(spark, sf_dir))


@query(f"""
    SELECT name, county, city, social_kind, count(*) AS "count" FROM ({shapes.SOCIAL})
    GROUP BY ALL HAVING count(*) > 1
    ORDER BY "count" DESC, name, county NULLS FIRST, city, social_kind LIMIT 15
""")
def report_repeated_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.repeated_social(social_table(spark, sf_dir))


@query(f"SELECT * FROM ({shapes.SOCIAL}) WHERE name = 'ANULADO'")
def report_voided_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.voided_social(social_table(spark, sf_dir))


@query(f"SELECT DISTINCT county FROM ({shapes.CLEAN_SOCIAL})")
def report_social_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counties(social_clean(spark, sf_dir))


@query(f"""
    SELECT sports, count(sports) AS sport_associations FROM (
        SELECT unnest(string_split(sports, '|')) AS sports FROM ({shapes.CLEAN_SOCIAL})
        WHERE county = 'burgos'
    ) GROUP BY sports ORDER BY sport_associations DESC, sports LIMIT 20
""")
def report_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sports_by_associations(social_clean(spark, sf_dir))


@query(f"""
    SELECT name, county, city, cultural_kind, count(*) AS "count" FROM ({shapes.CULTURAL})
    GROUP BY ALL HAVING count(*) > 1
    ORDER BY "count" DESC, name, county NULLS FIRST, city, cultural_kind LIMIT 15
""")
def report_repeated_cultural(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.repeated_cultural(cultural_table(spark, sf_dir))


@query(f"""
    SELECT name, county, city, cultural_kind, address, count(*) AS "count"
    FROM ({shapes.CULTURAL}) GROUP BY ALL HAVING count(*) > 1
    ORDER BY "count" DESC, name, county NULLS FIRST, city, cultural_kind, address NULLS FIRST LIMIT 15
""")
def report_repeated_cultural_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.repeated_cultural(cultural_table(spark, sf_dir), with_address=True)


@query(f"""
    SELECT county, city, count(*) FILTER (WHERE cultural_kind LIKE '%Museos%') AS museums,
           count(*) FILTER (WHERE cultural_kind LIKE '%Bibliotecas%') AS libraries,
           count(address) AS total
    FROM ({shapes.CLEAN_CULTURAL}) GROUP BY county, city ORDER BY total DESC, county, city LIMIT 30
""")
def report_cities_by_cultural(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cities_by_cultural(cultural_clean(spark, sf_dir))


@query(f"""
    SELECT name, address FROM ({shapes.CLEAN_CULTURAL})
    WHERE city = '{_CITY}' AND cultural_kind LIKE '%Museo%'
    ORDER BY name, address NULLS FIRST LIMIT 5
""")
def report_museums_in_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.museums_in_city(cultural_clean(spark, sf_dir), _CITY)


@query(f"""
    SELECT county, city, name, address FROM ({shapes.CLEAN_CULTURAL})
    WHERE cultural_kind LIKE '%Museo%' AND {_THEME}
    ORDER BY county, city, name, address NULLS FIRST LIMIT 15
""")
def report_museums_by_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.museums_by_theme(cultural_clean(spark, sf_dir))


@query(f"""
    SELECT city, count(*) AS "count" FROM ({shapes.POPULATION}) GROUP BY city
    HAVING count(*) > 1 ORDER BY "count" DESC, city LIMIT 15
""")
def report_repeated_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.repeated_cities(population_table(spark, sf_dir))


@query(f"""
    SELECT city, total_population FROM (
        SELECT * FROM ({shapes.POPULATION}) ORDER BY total_population DESC, city, county LIMIT 12)
""")
def report_most_populated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.most_populated(population_table(spark, sf_dir))


def _rates_sql(condition: str = "") -> str:
    return f"""
        SELECT p.county, p.city, p.total_population, v.total,
               CAST(v.total * 100000 AS DOUBLE) / p.total_population AS ratio
        FROM ({shapes.POPULATION}) p
        JOIN (SELECT city, count(address) AS total FROM ({shapes.CLEAN_VENUES}) GROUP BY city
              HAVING count(address) >= 1) v ON p.city = v.city
        {condition}
        ORDER BY ratio DESC, p.county, p.city LIMIT 10
    """


# A city of the test data has more people than a city of the region, but for the small ones.
_MINIMUM = 1_000_000


@query(_rates_sql())
def report_venue_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.highest_venue_rates(_people(spark, sf_dir), _filled(spark, sf_dir))


@query(_rates_sql(f"WHERE p.total_population >= {_MINIMUM}"))
def report_venue_rates_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark, sf_dir)
    return reports.highest_venue_rates(people, _filled(spark, sf_dir), _MINIMUM)


@query(shapes.ONE_POSTAL_CODE)
def report_one_postal_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cities_with_one_postal_code(postal_codes_table(spark, sf_dir))


def _same(columns: list[str]) -> dict[str, str]:
    return {name: name for name in columns}


@query(
    profile_sql(
        f"({shapes.CLEAN_VENUES})",
        _same(["name", "address", "county", "city", "postal_code", "garito_kind"]),
    )
)
def report_venue_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_profile(_filled(spark, sf_dir))


@query(profile_sql(f"({shapes.POSTAL_CODES})", _same(["county", "city", "postal_code"])))
def report_postal_code_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_profile(staged(spark, postal_codes_table(spark, sf_dir), "codes"))

"""The five regional tables and their cleanups, over the test tables in the sources' shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.operators import explode_elements
from comarca.plans import fixed, tables
from comarca.plans.checks import REQUIRED, key_dupes, key_nulls
from comarca.plans.run import staged
from comarca.queries import shapes
from comarca.queries.registry import query
from comarca.sources import ATTRIBUTE_PATH


def _null_counts_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(*) - count({name}) AS null_count FROM ({source})"""
        for name in columns
    )


@query(shapes.VENUES)
def venues_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.venues(shapes.venue_sources(spark, sf_dir))


@query(shapes.POSTAL_CODES)
def postal_codes_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.postal_codes(venues_table(spark, sf_dir))


@query(shapes.CLEAN_VENUES)
def venues_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gathered once into the scratch folder; the lookup and the repair read it from there."""
    return tables.clean_venues(staged(spark, venues_table(spark, sf_dir), "venues"))


@query(_null_counts_sql(shapes.VENUES, REQUIRED["garitos"]))
def venues_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_nulls(venues_table(spark, sf_dir), "garitos")


@query(shapes.SOCIAL)
def social_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.social(shapes.associations(spark, sf_dir), shapes.sports_clubs(spark, sf_dir))


@query(shapes.CLEAN_SOCIAL)
def social_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_social(social_table(spark, sf_dir))


@query(shapes.CLEAN_SOCIAL_FIRST)
def social_clean_counties_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_social(social_table(spark, sf_dir), canonicalise_first=True)


@query(_null_counts_sql(shapes.SOCIAL, REQUIRED["social"]))
def social_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_nulls(social_table(spark, sf_dir), "social")


@query(f"""
    SELECT 'gathered' AS step, count(*) AS rows FROM ({shapes.SOCIAL})
    UNION ALL SELECT 'without voided', count(*) FROM ({shapes.UNVOIDED})
    UNION ALL SELECT 'one per key', count(*) FROM ({shapes.SINGLE_SOCIAL})
    UNION ALL SELECT 'in a county', count(*) FROM ({shapes.CLEAN_SOCIAL})
""")
def social_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the gathered table, with one dedup for all counts."""
    return tables.social_trace(social_table(spark, sf_dir)).audit()


@query(shapes.CULTURAL)
def cultural_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = shapes.cultural_sources(spark, sf_dir)
    return tables.cultural(
        {kind: explode_elements(source, ATTRIBUTE_PATH) for kind, source in documents.items()}
    )


@query(shapes.CLEAN_CULTURAL)
def cultural_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_cultural(cultural_table(spark, sf_dir))


@query(_null_counts_sql(shapes.CULTURAL, REQUIRED["cultural"]))
def cultural_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_nulls(cultural_table(spark, sf_dir), "cultural")


@query(f"""
    SELECT 'gathered' AS step, count(*) AS rows FROM ({shapes.CULTURAL})
    UNION ALL SELECT 'in a county', count(*) FROM ({shapes.CLEAN_CULTURAL})
""")
def cultural_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.cultural_trace(cultural_table(spark, sf_dir)).audit()


def _library_attribute_sql() -> str:
    """Per attribute: name, slot that holds the value, value; element 0 but for the last."""
    listed = [
        ("Identificador", "valor", "CAST(p_partkey AS VARCHAR)"),
        ("NombreOrganismo", "string", "'Biblioteca ' || p_name"),
        ("Descripcion_es", "valor", "NULL"),
        ("Calle", "string", "CASE WHEN p_type <> 'PROMO' THEN p_type END"),
        ("CodigoPostal", "string", shapes.sql_code(shapes.BRAND)),
        ("Telefono", "valor", "'[]'"),
        ("Localidad_NombreLocalidad", "parent", shapes.sql_city(shapes.BRAND)),
        ("Directorio Superior", "valor", shapes.sql_pick(shapes.SPELLINGS, shapes.BRAND)),
        ("Directorio Superior", "text", "'Ñora'"),
        ("Descripcion_es", "valor", "NULL"),
    ]
    selects = []
    for i, (name, slot, value) in enumerate(listed):
        element = 2 if i == len(listed) - 1 else 0
        slots = ", ".join(
            f"CAST({value if other == slot else 'NULL'} AS VARCHAR) AS {other}"
            for other in ("valor", "parent", "string", "text")
        )
        selects.append(
            f"SELECT p_partkey AS library, {element} AS library_id, '{name}' AS name, {slots}"
            " FROM part"
        )
    return " UNION ALL ".join(selects)


LIBRARY_ATTRIBUTES = _library_attribute_sql()


@query(LIBRARY_ATTRIBUTES)
def library_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All attributes of all library elements; the element without any gives no row."""
    libraries = shapes.cultural_sources(spark, sf_dir)[fixed.LIBRARIES]
    long = tables.cultural_attributes(libraries.withColumnRenamed("key", "library"), ["library"])
    return long.withColumnRenamed("LocalidadPadre", "parent")


@query(shapes.POPULATION)
def population_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.population(shapes.population_source(spark, sf_dir))


@query(_null_counts_sql(shapes.POPULATION, REQUIRED["population"]))
def population_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_nulls(population_table(spark, sf_dir), "population")


@query(f"""
    SELECT city, count(*) AS "count" FROM ({shapes.POPULATION}) GROUP BY city HAVING count(*) > 1
""")
def population_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_dupes(population_table(spark, sf_dir), "population")


@query(f"""
    SELECT county, count(*) AS cities, CAST(sum(total_population) AS BIGINT) AS people
    FROM ({shapes.POPULATION}) GROUP BY county
""")
def population_by_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = population_table(spark, sf_dir)
    return people.groupBy("county").agg(
        F.count(F.lit(1)).alias("cities"), F.sum(fixed.TOTAL_POPULATION).alias("people")
    )

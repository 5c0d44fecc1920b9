"""The test tables in the shape of the regional sources, in Spark and in SQL.

Every nation or brand number stands for a place: one of nine counties, a city whose name
repeats in another county for five of the 25, and a postal code. The SQL gives the rows
each source should end up as, without going through the source's layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.plans import fixed
from comarca.queries.registry import table
from comarca.sources import SLOTS

SPELLINGS = [
    "Ávila", "Burgos", "León", "Palencia", "Salamanca", "Segovia", "Soria", "Valladolid", "Zamora",
]
CODES = list(fixed.COUNTY_OF_CODE)

# Counties as the associations spell them: no accents, one outside the region.
ASSOCIATION_SPELLINGS = [
    "AVILA", "BURGOS", "LEON", "PALENCIA", "SALAMANCA", "SEGOVIA", "SORIA", "VALLADOLID",
    "ZAMORA", "MADRID",
]
# The same counties with their accents, as every other association spells them.
ACCENTED_SPELLINGS = ["Ávila", "BURGOS", "León", *ASSOCIATION_SPELLINGS[3:]]

# Counties as the museums spell them; nation 24 has none.
MUSEUM_SPELLINGS = [
    "AVILA", "Burgos", "LEON", "Palencia", "MADRID", "Segovia", "Soria", "León", "Zamora",
]

# Places with few people at any scale.
SMALL_PLACES = [5, 8, 17]


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _pick(values: list[str], place: Column) -> Column:
    items = F.array(*[F.lit(value) for value in values])
    return F.get(items, (place % len(values)).cast("int"))


def county(place: Column) -> Column:
    return _pick(SPELLINGS, place)


def city(place: Column) -> Column:
    return F.concat(F.lit("Peñón "), _text(place % 20))


def code(place: Column) -> Column:
    return F.concat(_pick(CODES, place), F.lpad(_text(place), 3, "0"))


def sql_pick(values: list[str], place: str) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"([{listed}])[CAST(({place}) % {len(values)} + 1 AS INTEGER)]"


def sql_county(place: str) -> str:
    return f"lower({sql_pick(SPELLINGS, place)})"


def sql_city(place: str) -> str:
    return f"('Peñón ' || CAST(({place}) % 20 AS VARCHAR))"


def sql_code(place: str) -> str:
    return f"({sql_pick(CODES, place)} || lpad(CAST({place} AS VARCHAR), 3, '0'))"


# Venues: parts as bars, customers as restaurants, suppliers as cafés -------------------


def venue_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def source(df: DataFrame, name: Column, address: Column, place: Column, postal: Column):
        return df.select(
            name.alias("Nombre"),
            address.alias("Dirección"),
            postal.alias("C.Postal"),
            county(place).alias("Provincia"),
            city(place).alias("Municipio"),
        )

    part = table(spark, sf_dir, "part")
    brand = F.substring("p_brand", 7, 2).cast("int") - 1
    bars = source(
        part,
        F.upper("p_name"),
        F.when(F.col("p_type") != "PROMO", F.concat_ws(" ", "p_type", _text("p_size"))),
        brand,
        F.when(F.col("p_size") > 5, code(brand)),
    )
    customer = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    restaurants = source(
        customer,
        F.concat(F.lit("CASA "), "c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")),
        nation,
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
        .when((nation >= 12) & (F.col("c_mktsegment") == "MACHINERY"), code(nation + 100))
        .otherwise(code(nation)),
    )
    supplier = table(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey")
    cafes = source(
        supplier, F.col("s_name"), F.concat(F.lit("PLAZA "), "s_name"), nation, code(nation)
    )
    return {fixed.BARS: bars, fixed.RESTAURANTS: restaurants, fixed.CAFES: cafes}


# The place of a part, in SQL.
BRAND = "(CAST(substr(p_brand, 7, 2) AS INTEGER) - 1)"

VENUES = f"""
    SELECT DISTINCT upper(p_name) AS name,
           CASE WHEN p_type <> 'PROMO' THEN p_type || ' ' || CAST(p_size AS VARCHAR) END AS address,
           {sql_county(BRAND)} AS county, {sql_city(BRAND)} AS city,
           CASE WHEN p_size > 5 THEN {sql_code(BRAND)} END AS postal_code,
           'bares' AS garito_kind
    FROM part
    UNION ALL
    SELECT DISTINCT 'CASA ' || c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_name END,
           {sql_county('c_nationkey')}, {sql_city('c_nationkey')},
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                WHEN c_nationkey >= 12 AND c_mktsegment = 'MACHINERY'
                THEN {sql_code('c_nationkey + 100')} ELSE {sql_code('c_nationkey')} END,
           'restaurantes'
    FROM customer
    UNION ALL
    SELECT DISTINCT s_name, 'PLAZA ' || s_name, {sql_county('s_nationkey')},
           {sql_city('s_nationkey')}, {sql_code('s_nationkey')}, 'cafeterias'
    FROM supplier
"""

POSTAL_CODES = f"""
    SELECT DISTINCT county, city, postal_code FROM ({VENUES}) WHERE postal_code IS NOT NULL
"""

ONE_POSTAL_CODE = f"""
    SELECT city, max(postal_code) AS postal_code FROM ({POSTAL_CODES})
    GROUP BY city HAVING count(*) = 1
"""

CLEAN_VENUES = f"""
    SELECT v.name, v.address, v.county, v.city,
           coalesce(v.postal_code, u.postal_code) AS postal_code, v.garito_kind
    FROM ({VENUES}) v LEFT JOIN ({ONE_POSTAL_CODE}) u ON v.city = u.city
"""


# Social: customers as associations, orders as sports clubs -----------------------------


def associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    voided = F.col("c_acctbal") < 0
    return table(spark, sf_dir, "customer").select(
        F.when(voided, F.lit(fixed.VOIDED))
        .otherwise(F.concat(F.lit("PEÑA "), "c_mktsegment"))
        .alias("Asociación"),
        F.col("c_name").alias("Domicilio"),
        F.upper(city(nation)).alias("Municipio"),
        F.when((nation != 24) & (F.col("c_custkey") % 2 == 0), _pick(ACCENTED_SPELLINGS, nation))
        .when(nation != 24, _pick(ASSOCIATION_SPELLINGS, nation))
        .alias("Provincia"),
        code(nation).alias("C_Postal"),
    )


def sports_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.col("o_custkey") % 25
    sports = F.concat("o_orderpriority", F.lit("|"), "o_orderstatus", F.lit("|"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CLUB "), _text("o_custkey")).alias("Nombre"),
        F.concat(F.lit("C/ "), _text(F.year("o_orderdate"))).alias("Domicilio"),
        county(place).alias("Provincia"),
        city(place).alias("Localidad"),
        code(place).alias("C.Postal"),
        F.when(F.col("o_totalprice") > 20000, sports).alias("Deportes"),
    )


_CUSTKEY = "(o_custkey % 25)"

SOCIAL = f"""
    SELECT DISTINCT CASE WHEN c_acctbal < 0 THEN 'ANULADO' ELSE 'PEÑA ' || c_mktsegment END AS name,
           c_name AS address,
           CASE WHEN c_nationkey = 24 THEN NULL
                WHEN c_custkey % 2 = 0 THEN lower({sql_pick(ACCENTED_SPELLINGS, 'c_nationkey')})
                ELSE lower({sql_pick(ASSOCIATION_SPELLINGS, 'c_nationkey')}) END AS county,
           upper({sql_city('c_nationkey')}) AS city, {sql_code('c_nationkey')} AS postal_code,
           'N/A' AS sports, 'association' AS social_kind
    FROM customer
    UNION ALL
    SELECT DISTINCT 'CLUB ' || CAST(o_custkey AS VARCHAR), 'C/ ' || CAST(year(o_orderdate) AS VARCHAR),
           {sql_county(_CUSTKEY)}, {sql_city(_CUSTKEY)}, {sql_code(_CUSTKEY)},
           CASE WHEN o_totalprice > 20000
                THEN o_orderpriority || '|' || o_orderstatus || '|' END,
           'sports_club'
    FROM orders
"""


def _sql_clean_counties(source: str) -> str:
    listed = ", ".join(f"'{name}'" for name in fixed.VALID_COUNTIES)
    return f"""
        SELECT * REPLACE (
            CASE lower(county) WHEN 'avila' THEN 'ávila' WHEN 'leon' THEN 'león'
                 ELSE lower(county) END AS county)
        FROM ({source})
        WHERE CASE lower(county) WHEN 'avila' THEN 'ávila' WHEN 'leon' THEN 'león'
                   ELSE lower(county) END IN ({listed})
    """


def _sql_single_social(source: str) -> str:
    return f"""
        SELECT * FROM ({source})
        QUALIFY row_number() OVER (
            PARTITION BY name, county, city, social_kind
            ORDER BY address NULLS FIRST, postal_code NULLS FIRST, sports NULLS FIRST) = 1
    """


UNVOIDED = f"SELECT * FROM ({SOCIAL}) WHERE name <> 'ANULADO'"
SINGLE_SOCIAL = _sql_single_social(UNVOIDED)
CLEAN_SOCIAL = _sql_clean_counties(SINGLE_SOCIAL)
CLEAN_SOCIAL_FIRST = _sql_single_social(_sql_clean_counties(UNVOIDED))


# Cultural: parts as libraries, customers as museums ------------------------------------


def _attribute(name: str, slot: str, value: Column) -> Column:
    nothing = F.lit(None).cast("string")
    slots = [(value if other == slot else nothing).alias(other) for other in SLOTS]
    return F.struct(F.lit(name).alias("name"), *slots)


def _cultural_document(
    df: DataFrame, key: str, name: Column, address: Column, place: Column, postal: Column,
    placed: Column,
) -> DataFrame:
    """One document per row, with an empty element besides the institution."""
    attributes = F.array(
        _attribute("Identificador", "valor", _text(key)),
        _attribute("NombreOrganismo", "string", name),
        _attribute("Descripcion_es", "valor", F.lit(None).cast("string")),
        _attribute("Calle", "string", address),
        _attribute("CodigoPostal", "string", postal),
        _attribute("Telefono", "valor", F.lit("[]")),
        _attribute("Localidad_NombreLocalidad", "LocalidadPadre", city(place)),
        _attribute("Directorio Superior", "valor", placed),
        _attribute("Directorio Superior", "text", F.when(placed.isNotNull(), F.lit("Ñora"))),
    )

    def element(listed: Column) -> Column:
        return F.struct(F.struct(listed.alias("attribute")).alias("element"))

    empty = F.slice(attributes, 1, 0)
    unlisted = F.slice(attributes, 3, 1)
    elements = F.array(element(attributes), element(empty), element(unlisted))
    document = F.struct(F.lit("2021").alias("date"), elements.alias("list"))
    return df.select(document.alias("document"), F.col(key).alias("key"))


def cultural_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    brand = F.substring("p_brand", 7, 2).cast("int") - 1
    libraries = _cultural_document(
        table(spark, sf_dir, "part"),
        "p_partkey",
        F.concat(F.lit("Biblioteca "), "p_name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")),
        brand,
        code(brand),
        county(brand),
    )
    nation, custkey = F.col("c_nationkey"), F.col("c_custkey")
    themes = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("del Vino")).when(
        F.col("c_mktsegment") == "FURNITURE", F.lit("del queso")
    )
    museums = _cultural_document(
        table(spark, sf_dir, "customer"),
        "c_custkey",
        F.concat(F.lit("Museo "), F.coalesce(themes, F.lower("c_mktsegment"))),
        F.when((F.col("c_acctbal") >= 0) & (custkey % 2 == 0), F.col("c_name"))
        .when(F.col("c_acctbal") >= 0, F.lit("Plaza Mayor")),
        nation,
        F.when(custkey % 3 == 0, code(nation + 100)).otherwise(code(nation)),
        F.when(nation != 24, _pick(MUSEUM_SPELLINGS, nation)),
    )
    return {fixed.LIBRARIES: libraries, fixed.MUSEUMS: museums}


CULTURAL = f"""
    SELECT DISTINCT 'Biblioteca ' || p_name AS name, CASE WHEN p_type <> 'PROMO' THEN p_type END AS address,
           {sql_pick(SPELLINGS, BRAND)} AS county, {sql_city(BRAND)} AS city,
           {sql_code(BRAND)} AS postal_code, '{fixed.LIBRARIES}' AS cultural_kind
    FROM part
    UNION ALL
    SELECT DISTINCT 'Museo ' || CASE c_mktsegment WHEN 'BUILDING' THEN 'del Vino'
                WHEN 'FURNITURE' THEN 'del queso' ELSE lower(c_mktsegment) END,
           CASE WHEN c_acctbal >= 0 AND c_custkey % 2 = 0 THEN c_name
                WHEN c_acctbal >= 0 THEN 'Plaza Mayor' END,
           CASE WHEN c_nationkey <> 24 THEN {sql_pick(MUSEUM_SPELLINGS, 'c_nationkey')} END,
           {sql_city('c_nationkey')},
           CASE WHEN c_custkey % 3 = 0 THEN {sql_code('c_nationkey + 100')}
                ELSE {sql_code('c_nationkey')} END,
           '{fixed.MUSEUMS}'
    FROM customer
"""
CLEAN_CULTURAL = _sql_clean_counties(CULTURAL)


# Population: order lines as one row per municipality, sex and age -----------------------


def _dotted(number: Column) -> Column:
    """A whole number with thousands dots."""
    below = F.lpad(_text(number % 1000), 3, "0")
    millions = F.replace(F.format_number(number, 0), F.lit(","), F.lit("."))
    return (
        F.when(number < 1000, _text(number))
        .when(number < 1_000_000, F.concat(_text(F.floor(number / 1000)), F.lit("."), below))
        .otherwise(millions)
    )


def population_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places 0 to 24 by supplier; 24 lies outside the region and every other name is garbled."""
    place = F.col("l_suppkey") % 25
    clean = [
        f"{'28' if n == 24 else CODES[n % 9]}{n:03d}  Peñón {n % 20}" for n in range(25)
    ]
    garbled = [name.encode("utf-8").decode("iso-8859-1") for name in clean]
    years = (F.col("l_quantity") * 2).cast("int")
    few = F.col("l_linenumber").cast("long")
    people = _dotted(F.when(place.isin(SMALL_PLACES), few).otherwise(F.floor("l_extendedprice")))
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", _pick(garbled, place))
        .otherwise(_pick(clean, place))
        .alias(fixed.MUNICIPALITY),
        F.when(F.col("l_returnflag") == "A", F.lit("Ambos sexos"))
        .when(F.col("l_returnflag") == "N", F.lit("Hombres"))
        .otherwise(F.lit("Mujeres"))
        .alias(fixed.SEX),
        F.when(F.col("l_tax") == 0, F.lit("Total"))
        .when(years >= 100, F.lit("100 y más"))
        .otherwise(F.concat(_text(years), F.lit(" años")))
        .alias(fixed.AGE),
        F.when(F.col("l_discount") == 0, F.lit("..")).otherwise(people).alias(fixed.PEOPLE),
    )


_SUPPLIER = "(l_suppkey % 25)"


def _sql_age_sum(condition: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN people ELSE 0 END) AS BIGINT) AS {name}"


POPULATION = f"""
    SELECT county, city,
           {_sql_age_sum('age < 16', 'pop_under15')},
           {_sql_age_sum('age BETWEEN 16 AND 30', 'pop_16to30')},
           {_sql_age_sum('age BETWEEN 31 AND 45', 'pop_31to45')},
           {_sql_age_sum('age BETWEEN 46 AND 65', 'pop_46to65')},
           {_sql_age_sum('age BETWEEN 66 AND 80', 'pop_66to80')},
           {_sql_age_sum('age >= 81', 'pop_over80')},
           CAST(sum(people) AS BIGINT) AS total_population
    FROM (
        SELECT {sql_county(_SUPPLIER)} AS county, {sql_city(_SUPPLIER)} AS city,
               CAST(l_quantity * 2 AS INTEGER) AS age,
               CASE WHEN l_discount = 0 THEN 0
                    WHEN {_SUPPLIER} IN ({', '.join(map(str, SMALL_PLACES))}) THEN l_linenumber
                    ELSE CAST(floor(l_extendedprice) AS INTEGER) END AS people
        FROM lineitem
        WHERE l_suppkey % 25 <> 24 AND l_returnflag = 'A' AND l_tax <> 0
    )
    GROUP BY county, city
"""

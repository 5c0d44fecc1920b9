"""Fixed values of the regional domain: codes, labels, headers and kinds the files use."""

# Province code -> county, as the population file writes its municipalities.
COUNTY_OF_CODE = {
    "05": "ávila",
    "09": "burgos",
    "24": "león",
    "34": "palencia",
    "37": "salamanca",
    "40": "segovia",
    "42": "soria",
    "47": "valladolid",
    "49": "zamora",
}

VALID_COUNTIES = list(COUNTY_OF_CODE.values())

# Unaccented spellings found in the sources.
COUNTY_FIXES = {"avila": "ávila", "leon": "león"}

# Names of the source files.
VENUE_FILES = ["bares.csv", "restaurantes.csv", "cafeterias.csv"]
ASSOCIATION_FILE = "AsociacionesJCyL.csv"
SPORTS_CLUB_FILE = "Clubes deportivos.csv"
CULTURAL_FILES = [
    "Directorio de Bibliotecas de Castilla y León.json",
    "Directorio de Museos de Castilla y León.json",
]
POPULATION_FILE = "Cities population per gender age.csv"

# Source header per output column.
VENUE_COLUMNS = {
    "name": "Nombre",
    "address": "Dirección",
    "county": "Provincia",
    "city": "Municipio",
    "postal_code": "C.Postal",
}
ASSOCIATION_COLUMNS = {
    "name": "Asociación",
    "address": "Domicilio",
    "county": "Provincia",
    "city": "Municipio",
    "postal_code": "C_Postal",
}
SPORTS_CLUB_COLUMNS = {
    "name": "Nombre",
    "address": "Domicilio",
    "county": "Provincia",
    "city": "Localidad",
    "postal_code": "C.Postal",
    "sports": "Deportes",
}

# Venue kinds, named after their source files.
BARS = "bares"
RESTAURANTS = "restaurantes"
CAFES = "cafeterias"
VENUE_KINDS = {"cafes": CAFES, "bars": BARS, "restaurants": RESTAURANTS}

# Social kinds, the name of a voided entry, and the sports of an association.
ASSOCIATION = "association"
SPORTS_CLUB = "sports_club"
VOIDED = "ANULADO"
NO_SPORTS = "N/A"
SPORTS_SEPARATOR = "|"

# Cultural kinds, named after their source files.
MUSEUMS = "Directorio de Museos de Castilla y León"
LIBRARIES = "Directorio de Bibliotecas de Castilla y León"
CULTURAL_KINDS = {"museums": MUSEUMS, "libraries": LIBRARIES}
MUSEUM_WORD = "Museo"
WINE_AND_CHEESE = ["Vino", "vino", "ueso"]

# Attributes of a cultural element: those kept, and the output column of five of them.
CULTURAL_ATTRIBUTES = [
    "Identificador",
    "NombreOrganismo",
    "Calle",
    "CodigoPostal",
    "Localidad_NombreLocalidad",
    "Directorio Superior",
]
CULTURAL_COLUMNS = {
    "name": "NombreOrganismo",
    "address": "Calle",
    "county": "Directorio Superior",
    "city": "Localidad_NombreLocalidad",
    "postal_code": "CodigoPostal",
}

# The county and the city the reports look at unless told otherwise.
REPORT_COUNTY = "burgos"
REPORT_CITY = "Aranda de Duero"

# Population file: headers and the values that mark both sexes and all ages.
MUNICIPALITY = "Municipios"
SEX = "Sexo"
AGE = "Edad (año a año)"
PEOPLE = "Total"
BOTH_SEXES = "Ambos sexos"
ALL_AGES = "Total"

# Inclusive age ranges. The first is named after 15 and includes it.
AGE_BUCKETS = {
    "pop_under15": (None, 15),
    "pop_16to30": (16, 30),
    "pop_31to45": (31, 45),
    "pop_46to65": (46, 65),
    "pop_66to80": (66, 80),
    "pop_over80": (81, None),
}
TOTAL_POPULATION = "total_population"

# Schemas of the stored tables.
VENUE_SCHEMA = (
    "name string, address string, county string, city string, postal_code string,"
    " garito_kind string"
)
SOCIAL_SCHEMA = (
    "name string, address string, county string, city string, postal_code string,"
    " sports string, social_kind string"
)
CULTURAL_SCHEMA = (
    "name string, address string, county string, city string, postal_code string,"
    " cultural_kind string"
)
POSTAL_CODE_SCHEMA = "county string, city string, postal_code string"
POPULATION_SCHEMA = (
    "county string, city string, pop_under15 long, pop_16to30 long, pop_31to45 long,"
    " pop_46to65 long, pop_66to80 long, pop_over80 long, total_population long"
)

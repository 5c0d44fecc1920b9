"""Source files to stored tables to reports, on invented files in the sources' layout."""

import json

import pytest

from comarca.operators import audit, find_dupes, has_no_nulls
from comarca.plans import fixed, reports, run, tables
from comarca.sources import read_delimited, read_documents
from helpers import plan, rows


def line(values):
    return ";".join('"' + v.replace('"', '""') + '"' for v in values) + ";"


def venue_row(kind, name, address, code, county, city):
    lead = {"bares": ["47/1", ""], "cafeterias": ["1", "Cafetería", "1ª"]}
    first = lead.get(kind, ["1", "Restaurante", "2ª", ""])
    return line([*first, name, address, code, county, city, city.upper(), "", "", ""])


VENUE_HEADERS = {
    "bares": "N.Registro Especialidades",
    "cafeterias": "N.Registro Tipo Categoría",
    "restaurantes": "N.Registro Tipo Categoría Especialidades",
}
VENUE_TAIL = ["Nombre", "Dirección", "C.Postal", "Provincia", "Municipio", "Localidad"]
VENUE_TAIL += ["Teléfono 1", "Email", "web"]

VENUES = {
    "bares": [
        ("EL SOL", "C/ MAYOR 1", "05001", "Ávila", "Arenal"),
        ("EL SOL", "C/ MAYOR 1", "05001", "Ávila", "Arenal"),
        ("LA LUNA", "C/ MENOR 2", "", "Ávila", "Arenal"),
        ("EL SOL", "PLAZA 3", "05001", "Ávila", "Arenal"),
        ("BAR RÍO", "", "09002", "Burgos", "Ribera"),
        ("BAR DOS", "C/ 4", "", "Burgos", "Ribera"),
        ("BAR TRES", "C/ 5", "09003", "Burgos", "Ribera"),
        ("BAR \"Q\"", "C/ 6", "49-254", "Zamora", "Villa"),
        ("BAR VILLA", "C/ 7", "37001", "Salamanca", "Villa"),
        ("BAR NADA", "C/ 8", "", "Soria", "Lejana"),
    ],
    "cafeterias": [
        ("EL SOL", "C/ MAYOR 1", "05001", "Ávila", "Arenal"),
        ("CAFÉ UNO", "C/ 9", "09002", "Burgos", "Ribera"),
        ("CAFÉ DOS", "C/ 10", "", "Zamora", "Villa"),
    ],
    "restaurantes": [
        ("CASA ÑU", "C/ 11", "09002", "Burgos", "Ribera"),
        ("CASA ÑU", "C/ 12", "24001", "León", "Otra"),
    ],
}

ASSOCIATIONS = [
    "Num_Asoc;Ambito;Asociación;Domicilio;Municipio;Provincia;C_Postal;Web;Fines;"
    "Fines_Específicos;F_Registro",
    "1;LOCAL;PEÑA UNO;C/ 1;ARENAL;AVILA;05001;;;;1/1/65",
    "2;LOCAL;PEÑA UNO;C/ 2;ARENAL;Ávila;05001;;;;1/1/65",
    "3;LOCAL;PEÑA DOS;C/ 3;RIBERA;BURGOS;09002;;;;",
    "4;LOCAL;PEÑA DOS;C/ 2;RIBERA;BURGOS;09002;;;;",
    "5;LOCAL;PEÑA TRES;C/ 4;CAPITAL;MADRID;28001;;;;",
    "6;LOCAL;PEÑA CUATRO;C/ 5;CAPITAL;;28001;;;;",
    "7;LOCAL;ANULADO;;RIBERA;BURGOS;;;;;",
    "8;LOCAL;PEÑA CINCO;C/ 6;OTRA;LEON;;;;;",
    "9;LOCAL;;C/ 7;OTRA;LEON;;;;;",
]

CLUB_HEADER = ["Nº registro", "Nombre", "Domicilio", "Provincia", "Localidad", "C.Postal"]
CLUB_HEADER += ["Teléfono", "Fax", "Email", "Web", "F.Fundación", "F.Inscripción", "Deportes"]
AT, FU = "AT1#ATLETISMO - PISTA#", "FU1#FÚTBOL - FÚTBOL#"
CLUBS = [
    ('CLUB "LA FLECHA"', "C/ 1", "Burgos", "RIBERA", "09002", f"{AT}|{FU}|"),
    ("CLUB DOS", "C/ 2", "Burgos", "RIBERA", "09002", f"{FU}|"),
    ("CLUB DOS", "C/ 3", "Burgos", "RIBERA", "09003", f"{AT}|"),
    ("CLUB TRES", "C/ 4", "Burgos", "RIBERA", "", ""),
    ("ANULADO", "", "Soria", "LEJANA", "", ""),
    ("CLUB CUATRO", "C/ 5", "Soria", "LEJANA", "42001", f"{AT}|"),
]


def attribute(name, **slots):
    return {"name": name, **slots}


def institution(key, name, address, code, city, county, **extra):
    found = [
        attribute("Identificador", valor=key),
        attribute("NombreOrganismo", string=name),
        attribute("Descripcion_es"),
        attribute("Telefono", valor=[{"string": "1"}]),
        attribute("Fax", valor=[]),
        attribute("Localidad_NombreLocalidad", LocalidadPadre=city),
        attribute("Directorio Superior", valor=county),
    ]
    if address:
        found.append(attribute("Calle", string=address))
    if code:
        found.append(attribute("CodigoPostal", string=code))
    return {"element": {"attribute": found + extra.get("more", [])}}


MUSEUM_ELEMENTS = [
    institution("1", "Museo del Vino", "C/ 1", "09002", "Aranda de Duero", "Burgos"),
    institution("2", "Museo del Queso", "C/ 2", "09002", "Aranda de Duero", "Burgos"),
    institution("3", "Museo del Pan", None, "47001", "Mayorga", "Valladolid"),
    institution("4", "Sala de vinos", "C/ 4", None, "Arenal", "avila"),
    institution("5", "Museo Ajeno", "C/ 5", "28001", "Capital", "Madrid"),
    {"element": {"attribute": None}},
    {"element": {"attribute": [attribute("Descripcion_es", string="suelta")]}},
    institution("6", "Museo Doble", "C/ 9", "24001", "Otra", "León",
                more=[attribute("Calle", string="C/ 8"), attribute("NombreOrganismo")]),
]
# No library has a postal code: the attribute is missing from the whole file.
LIBRARY_ELEMENTS = [
    institution("7", "Biblioteca", "C/ 1", None, "Ribera", "Burgos"),
    institution("8", "Biblioteca", "C/ 2", None, "Ribera", "Burgos"),
    institution("9", "Biblioteca", "C/ 2", None, "Ribera", "Burgos"),
    institution("10", "Biblioteca Otra", "C/ 3", None, "Otra", "LEON"),
]

BOTH = "Ambos sexos"
EDGES = ["15 años", "16 años", "30 años", "31 años", "45 años", "46 años"]
EDGES += ["65 años", "66 años", "80 años", "81 años", "100 y más"]
POPULATION = [
    ("TOTAL NACIONAL", BOTH, "Total", "46.815.916"),
    ("TOTAL NACIONAL", BOTH, "0 años", "480.267"),
    ("05001  Arenal", BOTH, "Total", "9.999"),
    ("05001  Arenal", BOTH, "0 años", "1.204"),
    ("05001  Arenal", BOTH, "1 año", ".."),
    ("05001  Arenal", BOTH, "2 años", ""),
    ("05001  Arenal", "Hombres", "0 años", "700"),
    ("05001  Arenal", "Mujeres", "0 años", "504"),
    *[("09002  Ribera", BOTH, age, "1") for age in EDGES],
    ("49001  Villa", BOTH, "20 años", "6.000"),
    ("37001  Villa", BOTH, "20 años", "4.000"),
    ("24001  Ñandú Álava Éxito", BOTH, "20 años", "50"),
    ("44990  Lugarejo", BOTH, "4 años", "77"),
    ("42001  Vacía", BOTH, "4 años", ".."),
]


@pytest.fixture(scope="module")
def location(tmp_path_factory):
    folder = tmp_path_factory.mktemp("input")
    for kind, entries in VENUES.items():
        header = line([*VENUE_HEADERS[kind].split(" "), *VENUE_TAIL])
        text = "\n".join([header, *[venue_row(kind, *entry) for entry in entries]]) + "\n"
        (folder / f"{kind}.csv").write_bytes(text.encode("iso-8859-1"))
    text = "\n".join(ASSOCIATIONS) + "\n"
    (folder / fixed.ASSOCIATION_FILE).write_bytes(text.encode("iso-8859-1"))
    clubs = [
        line(["CYA/1", name, address, county, city, code, "", "", "", "", "", "", sports])
        for name, address, county, city, code, sports in CLUBS
    ]
    text = "\n".join([line(CLUB_HEADER), *clubs]) + "\n"
    (folder / fixed.SPORTS_CLUB_FILE).write_bytes(text.encode("iso-8859-1"))
    for kind, elements in {fixed.MUSEUMS: MUSEUM_ELEMENTS, fixed.LIBRARIES: LIBRARY_ELEMENTS}.items():
        document = {"document": {"date": "2021-03-26", "list": elements}}
        text = json.dumps(document, ensure_ascii=False, indent=1)
        (folder / f"{kind}.json").write_text(text, encoding="utf-8")
    text = "\n".join(["Municipios;Sexo;Edad (año a año);Total", *map(";".join, POPULATION)]) + "\n"
    (folder / fixed.POPULATION_FILE).write_text(text, encoding="utf-8")
    garbled = text.replace("24001  Ñandú Álava Éxito", "24001  Ñandú Álava Éxito".encode().decode("latin-1"))
    (folder / "population garbled.csv").write_text(garbled, encoding="utf-8")
    return f"{folder}/"


@pytest.fixture(scope="module")
def target(spark, location, tmp_path_factory):
    """All tables, built and stored once."""
    folder = f"{tmp_path_factory.mktemp('tables')}/"
    run.build_region(spark, location, folder)
    return folder


def test_checks_before_the_cleanup(spark, location, tmp_path):
    found = run.build_region(spark, location, f"{tmp_path}/")
    steps = found["Social entries: rows by step"].collect()
    assert [tuple(r) for r in steps] == [
        ("gathered", 15), ("without voided", 12), ("one per key", 10), ("in a county", 8)
    ]
    assert rows(found["Institutions: rows by step"]) == [("gathered", 9), ("in a county", 8)]
    assert rows(found["Venues: rows by step"]) == [("filled", 14), ("gathered", 14)]
    assert found["Social entries as gathered: voided"].count() == 2
    assert found["Social entries as gathered: repeated keys"].count() == 2
    assert dict(rows(found["Venues as gathered: nulls"]))["postal_code"] > 0
    libraries = found["Attributes of libraries"]
    assert (libraries.count(), libraries.select("library_id").distinct().count()) == (32, 4)


@pytest.fixture
def stored(spark, target):
    return lambda name: run.stored_table(spark, target, name)


# Venues


def test_stored_schemas(stored):
    for name, schema in {
        "garitos": fixed.VENUE_SCHEMA,
        "social": fixed.SOCIAL_SCHEMA,
        "cultural": fixed.CULTURAL_SCHEMA,
        "postal_codes": fixed.POSTAL_CODE_SCHEMA,
        "population": fixed.POPULATION_SCHEMA,
    }.items():
        expected = [
            tuple(field.strip().split(" ")) for field in schema.replace("long", "bigint").split(",")
        ]
        assert stored(name).dtypes == expected


def test_venues_are_gathered_and_repaired(spark, location, stored):
    gathered = tables.load_venues(spark, location, fixed.VENUE_FILES)
    repaired = stored("garitos")
    before, after = rows(gathered), rows(repaired)
    assert len(before) == len(after) == 14
    assert ("EL SOL", "C/ MAYOR 1", "ávila", "Arenal", "05001", "bares") in before
    assert ("EL SOL", "C/ MAYOR 1", "ávila", "Arenal", "05001", "cafeterias") in before
    assert ("BAR RÍO", None, "burgos", "Ribera", "09002", "bares") in before
    assert set(after) - set(before) == {
        ("LA LUNA", "C/ MENOR 2", "ávila", "Arenal", "05001", "bares")
    }
    assert not has_no_nulls(gathered, ["postal_code"])
    assert has_no_nulls(gathered, ["name", "county", "city", "garito_kind"])


def test_keys_of_the_repair_can_include_the_county(spark, location):
    gathered = tables.load_venues(spark, location, ["bares.csv", "cafeterias.csv"])
    by_city = tables.clean_venues(gathered)
    by_county = tables.clean_venues(gathered, keys=["county", "city"])
    assert by_city.where("name = 'CAFÉ DOS' and postal_code is null").count() == 1
    filled = rows(by_county.where("name = 'CAFÉ DOS'"))
    assert filled == [("CAFÉ DOS", "C/ 10", "zamora", "Villa", "49-254", "cafeterias")]


def test_postal_codes(stored):
    assert rows(stored("postal_codes")) == [
        ("burgos", "Ribera", "09002"),
        ("burgos", "Ribera", "09003"),
        ("león", "Otra", "24001"),
        ("salamanca", "Villa", "37001"),
        ("zamora", "Villa", "49-254"),
        ("ávila", "Arenal", "05001"),
    ]
    found = reports.cities_with_one_postal_code(stored("postal_codes"))
    assert rows(found) == [("Arenal", "05001"), ("Otra", "24001")]


def test_venue_reports(stored):
    venues = stored("garitos")
    groups = [tuple(r) for r in reports.venue_groups(venues, 2).collect()]
    assert groups == [
        ("EL SOL", "ávila", "Arenal", "bares", 2),
        ('BAR "Q"', "zamora", "Villa", "bares", 1),
    ]
    assert [tuple(r) for r in reports.venue_names(venues, k=2).collect()] == [
        ("EL SOL", 3),
        ("CASA ÑU", 2),
    ]
    assert reports.venue_names(venues).where("name = 'BAR RÍO'").first().total == 0
    assert rows(reports.venue_names(venues, "restaurantes")) == [("CASA ÑU", 2)]
    assert [tuple(r) for r in reports.counties_by_venues(venues).collect()] == [
        ("burgos", 1),
        ("zamora", 1),
        ("ávila", 1),
    ]
    assert rows(reports.cities_by_venues(venues)) == [("Ribera", 1, 3, 1, 4)]
    profiled = {r["column"]: r for r in reports.table_profile(venues).collect()}
    assert tuple(profiled["name"])[1:] == (14, 11, "EL SOL", 3)
    assert (profiled["postal_code"]["count"], profiled["postal_code"]["top"]) == (11, "05001")


# Social


def test_social_cleanup(spark, location, stored):
    gathered = tables.load_social(spark, location, fixed.ASSOCIATION_FILE, fixed.SPORTS_CLUB_FILE)
    assert gathered.count() == 15
    assert rows(reports.voided_social(gathered).select("social_kind")) == [
        ("association",),
        ("sports_club",),
    ]
    assert [tuple(r) for r in reports.repeated_social(gathered).collect()] == [
        ("CLUB DOS", "burgos", "RIBERA", "sports_club", 2),
        ("PEÑA DOS", "burgos", "RIBERA", "association", 2),
    ]
    columns = ["name", "county", "address", "postal_code"]
    assert rows(stored("social").select(columns)) == [
        ('CLUB "LA FLECHA"', "burgos", "C/ 1", "09002"),
        ("CLUB CUATRO", "soria", "C/ 5", "42001"),
        ("CLUB DOS", "burgos", "C/ 2", "09002"),
        ("CLUB TRES", "burgos", "C/ 4", None),
        ("PEÑA CINCO", "león", "C/ 6", None),
        ("PEÑA DOS", "burgos", "C/ 2", "09002"),
        ("PEÑA UNO", "ávila", "C/ 1", "05001"),
        ("PEÑA UNO", "ávila", "C/ 2", "05001"),
    ]
    assert rows(audit([("a", gathered), ("b", stored("social"))])) == [("a", 15), ("b", 8)]


def test_counties_first_merges_the_spellings(spark, location):
    gathered = tables.load_social(spark, location, fixed.ASSOCIATION_FILE, fixed.SPORTS_CLUB_FILE)
    cleaned = tables.clean_social(gathered, canonicalise_first=True)
    assert rows(cleaned.where("name = 'PEÑA UNO'").select("address")) == [("C/ 1",)]


def test_social_reports(stored):
    social = stored("social")
    assert rows(reports.counties(social)) == [("burgos",), ("león",), ("soria",), ("ávila",)]
    assert [tuple(r) for r in reports.sports_by_associations(social).collect()] == [
        ("", 2),
        (FU, 2),
        (AT, 1),
        ("N/A", 1),
    ]
    without_empty = reports.sports_by_associations(social, drop_empty=True)
    assert [r.sports for r in without_empty.collect()] == [FU, AT, "N/A"]


# Cultural


def test_cultural(spark, location, stored):
    gathered = tables.load_cultural(spark, location, fixed.CULTURAL_FILES)
    libraries = gathered.where(gathered.cultural_kind == fixed.LIBRARIES).drop("cultural_kind")
    assert rows(libraries) == [
        ("Biblioteca", "C/ 1", "Burgos", "Ribera", None),
        ("Biblioteca", "C/ 2", "Burgos", "Ribera", None),
        ("Biblioteca Otra", "C/ 3", "LEON", "Otra", None),
    ]
    museums = gathered.where(gathered.cultural_kind == fixed.MUSEUMS).drop("cultural_kind")
    assert rows(museums) == [
        ("Museo Ajeno", "C/ 5", "Madrid", "Capital", "28001"),
        ("Museo Doble", "C/ 8", "León", "Otra", "24001"),
        ("Museo del Pan", None, "Valladolid", "Mayorga", "47001"),
        ("Museo del Queso", "C/ 2", "Burgos", "Aranda de Duero", "09002"),
        ("Museo del Vino", "C/ 1", "Burgos", "Aranda de Duero", "09002"),
        ("Sala de vinos", "C/ 4", "avila", "Arenal", None),
    ]
    kept = rows(stored("cultural").select("name", "county"))
    assert ("Museo Ajeno", "madrid") not in kept
    assert ("Sala de vinos", "ávila") in kept
    assert len(kept) == 8


def test_cultural_reports(stored):
    cultural = stored("cultural")
    assert [tuple(r) for r in reports.cities_by_cultural(cultural, 2).collect()] == [
        ("burgos", "Aranda de Duero", 2, 0, 2),
        ("burgos", "Ribera", 0, 2, 2),
    ]
    assert [tuple(r) for r in reports.museums_in_city(cultural).collect()] == [
        ("Museo del Queso", "C/ 2"),
        ("Museo del Vino", "C/ 1"),
    ]
    assert [r.name for r in reports.museums_by_theme(cultural).collect()] == [
        "Museo del Queso",
        "Museo del Vino",
        "Sala de vinos",
    ]
    assert [r["count"] for r in reports.repeated_cultural(cultural).collect()] == [2]
    assert reports.repeated_cultural(cultural, with_address=True).count() == 0


def test_library_attributes(spark, location):
    documents = read_documents(spark, f"{location}{fixed.LIBRARIES}.json")
    long = tables.cultural_attributes(documents)
    assert long.columns == ["library_id", "name", "valor", "LocalidadPadre", "string", "text"]
    assert long.count() == 32
    (phone,) = rows(long.where("library_id = 0 and name = 'Telefono'"))
    assert json.loads(phone[2]) == [{"string": "1"}]
    assert phone[3:] == (None, None, None)


# Population


def test_population(stored):
    assert rows(stored("population")) == [
        ("burgos", "Ribera", 1, 2, 2, 2, 2, 2, 11),
        ("león", "Ñandú Álava Éxito", 0, 50, 0, 0, 0, 0, 50),
        ("salamanca", "Villa", 0, 4000, 0, 0, 0, 0, 4000),
        ("soria", "Vacía", 0, 0, 0, 0, 0, 0, 0),
        ("zamora", "Villa", 0, 6000, 0, 0, 0, 0, 6000),
        ("ávila", "Arenal", 1204, 0, 0, 0, 0, 0, 1204),
    ]


def test_population_names_garbled_in_the_file_are_repaired(spark, location):
    repaired = tables.load_population(spark, location, "population garbled.csv")
    plain = tables.load_population(spark, location, fixed.POPULATION_FILE)
    assert rows(repaired) == rows(plain)


def test_population_in_the_wrong_encoding_is_refused(spark, location):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        tables.load_population(spark, location, fixed.POPULATION_FILE, encoding="ISO-8859-1")


def test_population_checks_and_reports(stored):
    population = stored("population")
    assert has_no_nulls(population, population.columns)
    assert [tuple(r) for r in reports.repeated_cities(population).collect()] == [("Villa", 2)]
    assert rows(find_dupes(population, ["county", "city"])) == []
    assert [tuple(r) for r in reports.most_populated(population, 3).collect()] == [
        ("Villa", 6000),
        ("Villa", 4000),
        ("Arenal", 1204),
    ]


def test_venue_rates(stored):
    population, venues = stored("population"), stored("garitos")
    ranked = [tuple(r) for r in reports.highest_venue_rates(population, venues).collect()]
    assert ranked == [
        ("burgos", "Ribera", 11, 4, 4 * 100000 / 11),
        ("ávila", "Arenal", 1204, 4, 4 * 100000 / 1204),
        ("salamanca", "Villa", 4000, 3, 75.0),
        ("zamora", "Villa", 6000, 3, 50.0),
    ]
    large = reports.highest_venue_rates(population, venues, minimum_population=5000)
    assert rows(large) == [("zamora", "Villa", 6000, 3, 50.0)]
    by_county = reports.venue_rates(population, venues, keys=["county", "city"])
    assert rows(by_county.where("city = 'Villa'")) == [
        ("salamanca", "Villa", 4000, 1, 25.0),
        ("zamora", "Villa", 6000, 2, 2 * 100000 / 6000),
    ]


def test_sources_are_read_as_text(spark, location):
    clubs = read_delimited(spark, location + fixed.SPORTS_CLUB_FILE)
    assert set(dict(clubs.drop("_c13").dtypes).values()) == {"string"}
    assert clubs.where("`C.Postal` like '09%'").count() == 3


def test_all_checks_and_reports_run(spark, target):
    checked = run.region_checks(spark, target)
    assert rows(checked["social: nulls"]) == [
        ("city", 0),
        ("county", 0),
        ("name", 0),
        ("social_kind", 0),
    ]
    assert [r.city for r in checked["population: repeated keys"].collect()] == ["Villa"]
    shown = run.region_reports(spark, target)
    sizes = {title: df.count() for title, df in shown.items()}
    assert all(sizes.values()), sizes
    plans = " ".join(plan(df) for df in shown.values())
    assert "PartitionFilters: [isnotnull(county" in plans


# Versions


def test_a_versioned_region_equals_the_plain_one(spark, location, target, tmp_path):
    folder = f"{tmp_path}/"
    run.build_region(spark, location, folder, versioned=True)
    for name in ("garitos", "social", "cultural", "postal_codes", "population"):
        plain = run.stored_table(spark, target, name)
        assert rows(run.stored_table(spark, folder, name, versioned=True)) == rows(plain)

"""Whole loads from small hand-made extracts."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from caremart.plans.dims import with_unknown_member
from caremart.plans.facts import FactOptions
from caremart.plans.load import Warehouse, load_forecast, load_warehouse
from caremart.plans.settings import LoadSettings
from caremart.plans.standardise import STRICT
from caremart.session import materialise
from caremart.sources import (
    FileKind,
    JdbcSplit,
    begin_load,
    detect_delimiter,
    empty_warehouse,
    file_kinds,
    jdbc_options,
    latest_run,
    number_rows,
    open_snapshot,
    ranges_of,
    read_delimited,
    read_extracts,
    rejected_rows,
    stage_source,
    write_run,
)
from caremart.sources.tables import ALERT_TABLE, FORECAST_TABLE, WAREHOUSE_TABLES

SETTINGS = LoadSettings(run_date=dt.date(2026, 6, 1), zone_sante="Centre")

PATIENTS = """ID_Patient; Nom_Complet ;Sexe;Age;Poids;Taille;Statut_Nutritionnel;Antecedents_Medicaux;Commune;Quartier
P1;jean-paul d'arc; m;34;75 kg;1,75 m;Normal;Aucun;Kenya;Luapula
P2;ÉLISE mbuyi;F;;60;1.6;;Asthme;Kenya;Luapula
 P1 ;double;F;99;1;1;x;y;Kenya;Centre
;sans numéro;F;5.9;NA;;;;;Centre
P3;karl;M;abc;;;;;Kamalondo;Njanja
"""
VISITS = """ID_Patient,Date_Arrivee,Niveau_Urgence,Motif_Consultation,Decision_Medicale,Service,Temps_Attente_Tri,Temps_Attente_Orientation
P1,31/05/2026 08:55,2,Fièvre,Hospitalisation,Pédiatrie,12.9,
P9,2026-05-30,5,"Toux, sèche",Retour,pédiatrie ,,7
P2,garbage,1,Fièvre,Retour,Pédiatrie,1,1
,05/31/2026,,Chute,,Chirurgie,3,4
P3,2028-01-01,3,fièvre,RETOUR,Inconnu,3,4
"""
CONSULTATIONS = """ID_Patient,Date_Consultation,Pathologie,Medecin,Specialite_Medecin,Grade_Medecin,Annee_Experience,Duree_Consultation
P1,2026-01-02,Paludisme,Dr A,Pédiatrie,Chef,10,
P2,illisible,GRIPPE,Dr B,,,,22.5
P1,2020-05-05,Inconnue,dr a,Pédiatrie,Interne,3,5
"""
STAYS = """ID_Patient,Date_Admission,Service_Affectation,Pathologie_Principale,Issue_Sortie,Numero_Lit,Type_Chambre,Type_Admission,Origine_Admission,Duree_Sejour
P1,2026-01-01,Pédiatrie,paludisme,Guérison,L1,,Urgence,Domicile,3
P2,02/01/2026,Chirurgie,Grippe,Transfert,L2,Isolement,Urgence,Transfert,
P3,2026-01-03, PÉDIATRIE,Choléra,guérison,L1,Standard,Programmée,Domicile,2.5
P1,2030-01-01,Chirurgie,Grippe,Guérison,L2,Isolement,Urgence,Domicile,1
"""
BIRTHS = """ID_Patient,Date_Accouchement,Type_Accouchement,Age_Gestationnel,Nb_Grossesses,Antecedents_Obstetricaux,Poids_Nouveau_Ne,Taille_Naissance,Score_Apgar,Statut_Bebe,Complication_Type
P2,2026-02-02,Césarienne,39,2,Aucun suivi,3200,50,9,Sain,Aucune
P2,jamais,Normal,39,3,Aucun suivi,32000,50.5,8,Sain,
P1,2026-02-04,césarienne ,40,1,,3200.0,50,9,Critique,Hémorragie
"""
FILES = {
    "registre_patients_unique.csv": (PATIENTS, "latin-1"),
    "source_urgences.csv": (VISITS, "utf-8"),
    "source_consultations.csv": (CONSULTATIONS, "utf-8"),
    "source_hospitalisations.csv": (STAYS, "latin-1"),
    "source_maternite.csv": (BIRTHS, "utf-8"),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("extracts")
    for name, (text, encoding) in FILES.items():
        (path / name).write_bytes(text.encode(encoding))
    return str(path)


@pytest.fixture(scope="module")
def loaded(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    rows = load_warehouse(spark, folder, root, SETTINGS)
    return Warehouse(spark, root), rows


def column(df, order, *names):
    return [tuple(r) if len(names) > 1 else r[0] for r in df.orderBy(order).select(*names).collect()]


def test_delimiters():
    assert [detect_delimiter(h) for h in ("a;b;c", "a,b", '"x;y;z",b', "a\tb", "a|b|c", "alone")] == [
        ";", ",", ",", "\t", "|", ","]


def test_scan_finds_delimiter_encoding_names_and_missing_values(spark, folder):
    patients = read_delimited(spark, f"{folder}/registre_patients_unique.csv")
    assert patients.columns[:3] == ["ID_Patient", "Nom_Complet", "Sexe"]
    rows = patients.collect()
    assert [r.Nom_Complet for r in rows][1] == "ÉLISE mbuyi"
    assert rows[3].ID_Patient is None and rows[3].Poids is None
    quoted = read_delimited(spark, f"{folder}/source_urgences.csv").collect()
    assert quoted[1].Motif_Consultation == "Toux, sèche"


def test_missing_file_fails_when_planned(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_delimited(spark, f"{folder}/nowhere.csv")


def test_each_file_has_its_own_encoding_and_line_breaks_stay_in_fields(spark, tmp_path):
    (tmp_path / "a b.csv").write_bytes("id,txt,z\n1,Élise,x\n".encode())
    (tmp_path / "b.csv").write_bytes("id,txt,z\n2,Élise,x\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes('id,txt,z\n3,"line one\nline ""two"", end",x\n4,short\n'.encode())
    assert {k: len(v) for k, v in file_kinds(spark, str(tmp_path)).items()} == {
        FileKind("UTF-8", False): 1, FileKind("ISO-8859-1", False): 1, FileKind("UTF-8", True): 1}
    rows = {tuple(r) for r in read_delimited(spark, str(tmp_path)).collect()}
    assert rows == {("1", "Élise", "x"), ("2", "Élise", "x"), ("3", 'line one\nline "two", end', "x"), ("4", "short", None)}


def test_rows_with_too_many_fields_are_rejected_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,txt,z\n1,a,b\n2,"c,d",y\n3,c,y,EXTRA\n4,"e,f"\n5,"g,h",y,,LAST\n6,i,j\n')
    stored = materialise(read_delimited(spark, str(tmp_path), with_origin=True), "wide")
    assert [r.ligne for r in rejected_rows(stored).orderBy("ligne").collect()] == ["3,c,y,EXTRA", '5,"g,h",y,,LAST']
    kept = number_rows(stored, "wide").orderBy("src_row").collect()
    assert [(r.id, r.txt, r.z, r.src_row) for r in kept] == [
        ("1", "a", "b", 0), ("2", "c,d", "y", 1), ("4", "e,f", None, 3), ("6", "i", "j", 5)]
    assert read_delimited(spark, str(tmp_path)).count() == 4


def test_files_with_another_header_are_not_read_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,txt\n1,a\n")
    (tmp_path / "b.csv").write_text("txt,id\nb,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path)).collect()


def test_rows_are_numbered_in_file_order_over_uneven_files(spark, tmp_path):
    n = 0
    for part, size in enumerate((5, 3000, 1, 700)):
        lines = [f"v{n + i}" for i in range(size)]
        (tmp_path / f"part-{part}.csv").write_text("a;b\n" + "".join(f"{x};{'z' * 20}\n" for x in lines))
        n += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        staged = stage_source(read_delimited(spark, str(tmp_path), with_origin=True), "uneven")
        assert staged.count() == n
        assert staged.where(F.concat(F.lit("v"), F.col("src_row")) != F.col("a")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_row_counts(loaded):
    _, rows = loaded
    assert rows["dim_temps"] == 1096
    assert {t: rows[t] for t in rows if t.startswith("faits_")} == {
        "faits_accueil": 3, "faits_consultation": 3, "faits_hospitalisation": 3, "faits_maternite": 3}
    assert {t: n for t, n in rows.items() if t.startswith("rejets")} == {
        "rejets_dates/urgence": 1, "rejets_dates/consultation": 1, "rejets_dates/hospitalisation": 0,
        "rejets_dates/maternite": 1}
    assert set(WAREHOUSE_TABLES) - set(rows) == {"dim_transport"}


def test_patient_dimension(loaded):
    warehouse, _ = loaded
    patients = warehouse.table("dim_patient")
    assert column(patients, "patient_sk", "patient_sk", "sexe", "age", "tranche_age", "poids", "taille") == [
        (1, "M", 34, "31-60 ans", 75.0, 1.0), (2, "F", 0, "Inconnu", 60.0, 1.6), (3, "F", 5, "0-5 ans", None, None),
        (4, "M", 0, "Inconnu", None, None)]
    assert column(patients, "patient_sk", "statut_nutritionnel") == ["Normal", "Normal", "Normal", "Normal"]


def test_vocabularies(loaded):
    warehouse, _ = loaded
    assert column(warehouse.table("dim_pathologie"), "pathologie_sk", "code_cim10", "libelle") == [
        ("UNK", "Pathologie inconnue"), ("CIM001", "Paludisme"), ("CIM002", "GRIPPE"), ("CIM003", "Inconnue"),
        ("CIM004", "paludisme"), ("CIM005", "Grippe"), ("CIM006", "Choléra")]
    assert column(warehouse.table("dim_service"), "service_sk", "id_service", "nom_service") == [
        ("SRV-DEF", "Service par défaut"), ("SRV001", "Pédiatrie"), ("SRV002", "Chirurgie"), ("SRV003", " PÉDIATRIE")]
    assert column(warehouse.table("dim_lit"), "lit_sk", "numero_lit", "numero_chambre", "type_chambre", "service_sk") == [
        ("L1", "CH-001", "Standard", 4), ("L2", "CH-002", "Isolement", 3), ("L1", "CH-003", "Standard", 1)]
    assert column(warehouse.table("dim_geographie"), "geographie_sk", "id_localisation", "quartier", "ville", "zone_sante") == [
        ("0", "Luapula", "Lubumbashi", "Centre"), ("2", "Centre", "Lubumbashi", "Centre"),
        ("4", "Njanja", "Lubumbashi", "Centre")]
    assert column(warehouse.table("dim_grossesse"), "grossesse_sk", "code_grossesse", "age_gestationnel") == [
        ("G-000", 39), ("G-001", 39)]


def test_visit_facts(loaded):
    warehouse, _ = loaded
    facts = warehouse.table("faits_accueil")
    names = ["id_fait", "temps_sk", "patient_sk", "service_sk", "gravite_sk", "motif_sk", "decision_sk",
             "temps_attente_tri", "temps_attente_orientation"]
    # The second service keeps its trailing blank and the level and decision of the fourth row are missing.
    assert column(facts, "id_fait", *names) == [
        (1, 20260531, 1, 4, 2, 4, 2, 12, 0), (2, 20260530, 1, 1, 4, 2, 4, 0, 7), (4, 20260531, 1, 3, 1, 3, 1, 3, 4)]


def test_consultation_facts(loaded):
    warehouse, _ = loaded
    names = ["id_fait", "temps_sk", "patient_sk", "service_sk", "pathologie_sk", "medecin_sk", "duree_consultation",
             "nb_medicaments"]
    assert column(warehouse.table("faits_consultation"), "id_fait", *names) == [
        (1, 20260102, 1, 4, 5, 4, 15.0, 0), (2, 20250101, 2, 1, 6, 3, 22.5, 0), (3, 1, 1, 4, 4, 4, 5.0, 0)]


def test_stay_facts(loaded):
    warehouse, _ = loaded
    names = ["id_fait", "temps_sk", "patient_sk", "service_sk", "pathologie_sk", "lit_sk", "admission_sk", "issue_sk",
             "duree_sejour", "annee"]
    assert column(warehouse.table("faits_hospitalisation"), "id_fait", *names) == [
        (1, 20260101, 1, 4, 5, 3, 2, 4, 3.0, 2026), (2, 20260102, 2, 3, 6, 2, 2, 3, 0.0, 2026),
        (3, 20260103, 4, 1, 7, 3, 3, 4, 2.5, 2026)]


def test_birth_facts(loaded):
    warehouse, _ = loaded
    names = ["id_fait", "temps_sk", "patient_sk", "accouchement_sk", "grossesse_sk", "bebe_sk", "complication_sk",
             "nb_cesariennes", "nb_complications", "poids_naissance"]
    assert column(warehouse.table("faits_maternite"), "id_fait", *names) == [
        (1, 20260202, 2, 3, 2, 3, 1, 1, 0, 3200.0), (2, 20250101, 2, 2, 2, 2, 1, 0, 1, 0.0),
        (3, 20260204, 1, 3, 1, 3, 2, 0, 1, 3200.0)]


def test_facts_are_the_same_when_no_dimension_fits_a_broadcast(spark, folder, loaded, monkeypatch):
    from caremart.operators import lookup
    from caremart.plans.facts import build_facts
    from caremart.plans.standardise import standardise

    warehouse, rows = loaded
    monkeypatch.setattr(lookup, "fits_broadcast", lambda dim: False)
    dims = {table: warehouse.table(table) for table in rows if table.startswith("dim_")}
    facts = build_facts(standardise(read_extracts(spark, folder)), dims, FactOptions(settings=SETTINGS))
    for table, fact in facts.items():
        stored = warehouse.table(table).drop("annee").select(*fact.columns)
        assert fact.count() == stored.count() and fact.exceptAll(stored).isEmpty()


def test_strict_load_drops_unresolved_rows(spark, folder, tmp_path):
    rows = load_warehouse(spark, folder, str(tmp_path), SETTINGS, mode=STRICT)
    assert {t: rows[t] for t in rows if t.startswith("faits_")} == {
        "faits_accueil": 1, "faits_consultation": 1, "faits_hospitalisation": 3, "faits_maternite": 2}
    warehouse = Warehouse(spark, str(tmp_path))
    assert column(warehouse.table("faits_maternite"), "id_fait", "id_fait", "id_accouchement", "poids_naissance") == [
        (1, 1, 3200.0), (3, 2, 3200.0)]
    assert column(warehouse.table("faits_hospitalisation"), "id_fait", "lit_sk") == [1, 1, 1]


def test_second_load_gives_the_same_tables(spark, folder, loaded, tmp_path):
    warehouse, rows = loaded
    again = load_warehouse(spark, folder, str(tmp_path), SETTINGS)
    assert again == rows
    for table in ("dim_patient", "dim_service", "dim_nouveaune", "faits_accueil", "faits_maternite"):
        other = Warehouse(spark, str(tmp_path)).table(table)
        assert other.exceptAll(warehouse.table(table)).isEmpty()


def test_absent_optional_columns(spark, folder, tmp_path):
    sources = read_extracts(spark, folder)
    sources["urgence"] = sources["urgence"].drop("Service", "Decision_Medicale", "Motif_Consultation")
    sources["hospitalisation"] = sources["hospitalisation"].drop("Issue_Sortie", "Numero_Lit", "Type_Chambre")
    sources["maternite"] = sources["maternite"].drop("Complication_Type")
    from caremart.plans.load import load_sources

    rows = load_sources(spark, sources, str(tmp_path), SETTINGS, options=FactOptions(unknown_key=-1))
    assert {"dim_motif", "dim_lit", "dim_complication", "dim_transport"}.isdisjoint(rows)
    assert rows["dim_decision"] == rows["dim_issue"] == 1
    warehouse = Warehouse(spark, str(tmp_path))
    assert column(warehouse.table("faits_accueil"), "id_fait", "service_sk", "decision_sk", "motif_sk", "patient_sk") == [
        (-1, -1, -1, 1), (-1, -1, -1, -1), (-1, -1, -1, -1)]
    assert column(warehouse.table("faits_hospitalisation"), "id_fait", "lit_sk", "issue_sk") == [(-1, -1)] * 3
    assert column(warehouse.table("faits_maternite"), "id_fait", "nb_complications") == [0, 0, 0]


def test_unknown_member(loaded):
    warehouse, _ = loaded
    extended = with_unknown_member(warehouse.table("dim_service"), "service_sk")
    blank = extended.where("service_sk = -1").first()
    assert blank.nom_service is None and extended.count() == warehouse.table("dim_service").count() + 1


def test_forecast_of_a_warehouse(spark, tmp_path):
    root = str(tmp_path)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    stays = [(int(d.strftime("%Y%m%d")), sk, 1) for d in days for sk in (2, 3) for _ in range(8 if sk == 2 else 2)]
    services = [(2, "Plein", 10), (3, "Calme", 10), (4, "Fermé", 0)]
    write_run({
        "faits_hospitalisation": spark.createDataFrame(stays, "temps_sk int, service_sk int, nb_lits_occupes int"),
        "dim_temps": spark.createDataFrame([(int(d.strftime("%Y%m%d")), d) for d in days], "temps_sk int, date_complete date"),
        "dim_service": spark.createDataFrame(services, "service_sk int, nom_service string, capacite_lits int"),
    }, root, "1")

    assert load_forecast(spark, root, "2024-02-10") == {FORECAST_TABLE: 60, ALERT_TABLE: 0}
    assert load_forecast(spark, root, "2024-02-11", how="sum") == {FORECAST_TABLE: 60, ALERT_TABLE: 30}
    rows = latest_run(spark, f"{root}/previsions", FORECAST_TABLE).where("service_sk = 2").orderBy("horizon_jours").collect()
    assert rows[0].date_prevision == dt.date(2024, 2, 10)
    assert [round(r.occupation_predite, 3) for r in rows] == [80.0] * 30
    alarms = latest_run(spark, f"{root}/previsions", ALERT_TABLE).collect()
    assert {(r.service_sk, r.type_alerte, r.resolu) for r in alarms} == {(2, "Avertissement", 0)}


def test_unfinished_run_stays_invisible(spark, tmp_path):
    root = str(tmp_path)
    first, second = spark.range(1), spark.range(2)
    write_run({"a": first}, root, "1")
    begin_load(spark, root, "2").write(second, "a")
    assert latest_run(spark, root, "a").count() == 1
    write_run({"a": second}, root, "3")
    assert latest_run(spark, root, "a").count() == 2


def test_emptying_skips_what_is_absent(spark, tmp_path):
    root = str(tmp_path)
    write_run({"dim_motif": spark.range(3), "other": spark.range(2)}, root, "1")
    skipped = empty_warehouse(spark, root, run_id="2")
    assert set(skipped) == set(WAREHOUSE_TABLES) - {"dim_motif"}
    emptied = open_snapshot(spark, root)
    assert emptied.table("dim_motif").count() == 0 and emptied.table("other").count() == 2
    assert open_snapshot(spark, root, "1").table("dim_motif").count() == 3


def test_connector_options():
    options = jdbc_options("jdbc:sqlserver://host;databaseName=dw", "dim_temps", batch_rows=500, user="u")
    assert options == {"url": "jdbc:sqlserver://host;databaseName=dw", "dbtable": "dim_temps", "batchsize": "500",
                       "numPartitions": "8", "user": "u"}
    split = jdbc_options("jdbc:x", "faits_accueil", connections=4, split=JdbcSplit("temps_sk", 20240101, 20261231))
    assert {k: split[k] for k in ("numPartitions", "partitionColumn", "lowerBound", "upperBound")} == {
        "numPartitions": "4", "partitionColumn": "temps_sk", "lowerBound": "20240101", "upperBound": "20261231"}


def test_ranges_cover_every_value_once(spark):
    values = [None, "a", "it's", "m", "z", "zz"]
    df = spark.createDataFrame([(v,) for v in values], "k string")
    parts = ranges_of("k", ["it's", "z"])
    assert len(parts) == 3 and [df.where(c).count() for c in parts] == [2, 2, 2]
    assert ranges_of("k", []) == ["1 = 1"] and ranges_of("d", [dt.date(2024, 1, 1)]) == ["d < '2024-01-01' OR d IS NULL", "d >= '2024-01-01'"]


def test_a_load_that_fails_leaves_the_old_run_readable(spark, folder, tmp_path, monkeypatch):
    """The third fact fails: dimensions and two facts are written by then, and none of them is seen."""
    from caremart.plans import facts

    root = str(tmp_path)
    load_warehouse(spark, folder, root, SETTINGS, run_id="1")

    def fails(*_):
        raise RuntimeError("no stays today")

    monkeypatch.setitem(facts.FACTS, "faits_hospitalisation", (fails, "hospitalisation"))
    later = LoadSettings(run_date=dt.date(2026, 7, 1), zone_sante="Nord")
    with pytest.raises(RuntimeError, match="no stays today"):
        load_warehouse(spark, folder, root, later, run_id="2")
    warehouse = Warehouse(spark, root)
    assert warehouse.snapshot.run_id == "1"
    assert {r[0] for r in warehouse.table("dim_geographie", "zone_sante").distinct().collect()} == {"Centre"}
    assert warehouse.table("faits_hospitalisation").count() == 3
    monkeypatch.undo()
    load_warehouse(spark, folder, root, later, run_id="2")
    assert {r[0] for r in Warehouse(spark, root).table("dim_geographie", "zone_sante").distinct().collect()} == {"Nord"}
    assert warehouse.table("dim_geographie").where("zone_sante = 'Centre'").count() == 3, "an open run does not change"


def test_an_empty_fact_is_readable(spark, folder, tmp_path):
    sources = read_extracts(spark, folder)
    sources["urgence"] = sources["urgence"].where("false")
    from caremart.plans.load import load_sources

    load_sources(spark, sources, str(tmp_path), SETTINGS, only=["faits_accueil"])
    assert Warehouse(spark, str(tmp_path)).table("faits_accueil", "id_fait", "annee").collect() == []


NEW_VISITS = """ID_Patient,Date_Arrivee,Niveau_Urgence,Motif_Consultation,Decision_Medicale,Service,Temps_Attente_Tri,Temps_Attente_Orientation
P7,2026-06-02,4,Chute,Transfert,Pédiatrie,1,2
P1,2026-06-03,2,Brûlure,Retour,Chirurgie,3,4
"""


def _more_visits(folder, tmp_path):
    for name, (text, encoding) in FILES.items():
        more = {"source_urgences.csv": NEW_VISITS, "registre_patients_unique.csv": PATIENTS.replace("jean-paul d'arc; m;34", "jean-paul d'arc; m;35") + "P7;neuf;M;7;;;;;Kenya;Luapula\n"}
        (tmp_path / name).write_bytes(more.get(name, text).encode(encoding))
    return str(tmp_path)


def test_appending_adds_members_and_facts_once(spark, folder, tmp_path):
    root, more = str(tmp_path / "dw"), _more_visits(folder, tmp_path)
    load_warehouse(spark, folder, root, SETTINGS, run_id="1", extract="may")
    first = Warehouse(spark, root)
    rows = load_warehouse(spark, more, root, SETTINGS, run_id="2", extract="june", append=True)
    assert rows["dim_patient"] == 1 and rows["faits_accueil"] == 2 and rows["dim_temps"] == 0
    second = Warehouse(spark, root)
    load_warehouse(spark, more, root, SETTINGS, run_id="3", extract="june", append=True)
    third = Warehouse(spark, root)
    for table in WAREHOUSE_TABLES:
        if table in second.snapshot.parts:
            a, b = second.table(table), third.table(table)
            assert a.count() == b.count() and a.exceptAll(b).isEmpty(), table
            assert first.table(table).exceptAll(a).isEmpty(), f"{table} lost rows"
    names = ["id_fait", "temps_sk", "patient_sk", "gravite_sk", "motif_sk", "decision_sk"]
    assert column(third.table("faits_accueil"), "id_fait", *names)[3:] == [(5, 20260602, 5, 5, 3, 5), (6, 20260603, 1, 2, 5, 4)]
    motifs = column(third.table("dim_motif"), "motif_sk", "code_motif", "libelle_motif")
    assert motifs[-1] == ("M005", "Brûlure")
    assert third.table("faits_maternite").count() == 6 and third.table("faits_maternite").select("id_fait").distinct().count() == 6


def test_versions_follow_the_date_of_the_event(spark, folder, tmp_path):
    root, more = str(tmp_path / "dw"), _more_visits(folder, tmp_path)
    load_warehouse(spark, folder, root, SETTINGS, run_id="1", versions=True)
    later = LoadSettings(run_date=dt.date(2026, 6, 3), zone_sante="Centre")
    load_warehouse(spark, more, root, later, run_id="2", versions=True)
    once = Warehouse(spark, root)
    load_warehouse(spark, more, root, later, run_id="3", versions=True)
    again = Warehouse(spark, root)
    for table in ("dim_patient", "dim_medecin", "dim_lit", "faits_accueil", "faits_consultation"):
        assert once.table(table).count() == again.table(table).count() and once.table(table).exceptAll(again.table(table)).isEmpty(), table
    patients = column(again.table("dim_patient"), "patient_sk", "patient_sk", "age", "date_fin_validite", "est_actif", "version_ligne")
    assert patients[0] == (1, 34, dt.date(2026, 6, 3), False, 1)
    new = {(r.age, r.version_ligne): r.patient_sk for r in again.table("dim_patient").where("patient_sk > 4").collect()}
    assert set(new) == {(35, 2), (7, 1)}
    # P1 was seen on the day its new version opened; its consultation was before.
    visits = {r.temps_sk: r.patient_sk for r in again.table("faits_accueil").collect()}
    assert visits == {20260602: new[7, 1], 20260603: new[35, 2]}
    assert {r.id_fait: r.patient_sk for r in again.table("faits_consultation").collect()} == {1: 1, 2: 2, 3: 1}


def test_numbering_rows_does_not_move_the_source(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n" + "".join(f"v{i};x\n" for i in range(500)))
    plan = stage_source(read_delimited(spark, str(tmp_path), with_origin=True), "still")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_dates_are_parsed_once_for_value_and_reject(spark):
    from caremart.plans.standardise import parsed_events

    events = spark.createDataFrame([("P1", "2026-05-31")], "ID_Patient string, Date_Admission string")
    plan = parsed_events(events, "hospitalisation")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(array(lower(regexp_replace(") == 1


def test_a_listed_run_is_refused(spark, tmp_path):
    root = str(tmp_path / "runs")
    write_run({"t": spark.range(3)}, root, "a")
    with pytest.raises(ValueError, match="run a is complete"):
        write_run({"t": spark.range(9)}, root, "a")
    assert latest_run(spark, root, "t").count() == 3


def test_scratch_tables_hold_times_as_whole_numbers(spark, tmp_path):
    from pyarrow import dataset, parquet

    setting = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(setting)
    times = spark.sql("SELECT TIMESTAMP '2026-05-31 08:55:10.25' AS t UNION ALL SELECT NULL UNION ALL SELECT TIMESTAMP '0001-01-01 00:00:00'")
    stored = materialise(times, "times")
    (folder,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in stored.inputFiles()}
    files = dataset.dataset(folder, format="parquet").files
    assert {parquet.ParquetFile(f).schema.column(0).physical_type for f in files} == {"INT64"}
    text = F.col("t").cast("string")
    assert sorted(stored.select(text).collect(), key=str) == sorted(times.select(text).collect(), key=str)
    assert spark.conf.get(setting) == before


def test_identifiers_are_stored_for_rejects_alone(spark):
    from caremart.plans.standardise import parsed_events, rejected_dates, rejects_identified

    events = spark.createDataFrame(
        [(1, "P1", "2026-05-31"), (2, "P2", "one day"), (3, None, "some day"), (4, "P4", None)], "src_row long, ID_Patient string, Date_Admission string")
    parsed = parsed_events(events, "hospitalisation")
    kept = rejects_identified(parsed)
    assert {r.src_row: r.ID_Patient for r in kept.collect()} == {1: None, 2: "P2", 3: None, 4: None}
    assert sorted(rejected_dates(kept, "hospitalisation").collect()) == sorted(rejected_dates(parsed, "hospitalisation").collect())
    assert kept.where("ID_Patient_Anonyme IS NOT NULL").count() == 3


def _visit_sources(spark):
    """The sources that the visit facts read, in rows of their own: three readable dates, an unreadable one, one missing, one outside the years."""
    visits = [
        (0, "P1", "2025-05-31", "2", "fever", "Home", "Ward", "3.7", "4"), (1, "P9", "01/06/2025 08:55", None, None, None, " ward", None, None),
        (2, "P1", "one day", "2", "fever", "Home", "Ward", "1", "1"), (3, "P1", None, "2", "fever", "Home", "Ward", "1", "1"),
        (4, "P1", "2019-01-01", "2", "fever", "Home", "Ward", "1", "1"), (5, "P2", "Jan 2, 2026", "3", "Fever ", "Stay", "Ward", "5", "6")]
    texts = lambda names: ", ".join(f"{n} string" for n in names.split())
    patient = "ID_Patient Nom_Complet Sexe Age Poids Taille Statut_Nutritionnel Antecedents_Medicaux Commune Quartier"
    visit = "ID_Patient Date_Arrivee Niveau_Urgence Motif_Consultation Decision_Medicale Service Temps_Attente_Tri Temps_Attente_Orientation"
    return {
        "patient": spark.createDataFrame([(0, "P1", *[None] * 9), (1, "P2", *[None] * 9)], f"src_row long, {texts(patient)}"),
        "urgence": spark.createDataFrame(visits, f"src_row long, {texts(visit)}"),
        "consultation": spark.createDataFrame([], f"src_row long, {texts('ID_Patient')}"),
        "hospitalisation": spark.createDataFrame([(0, "Ward")], "src_row long, Service_Affectation string"),
        "maternite": spark.createDataFrame([], f"src_row long, {texts('ID_Patient')}"),
    }


_VISIT_KEYS = ("id_fait", "temps_sk", "patient_sk", "service_sk", "gravite_sk", "motif_sk", "decision_sk", "temps_attente_tri")


@pytest.mark.parametrize("query, columns, want", [
    ("fact_visits_unknown_member", _VISIT_KEYS, [(1, 20250531, 1, 2, 2, 2, 2, 3), (2, 20250601, -1, 2, -1, -1, -1, 0), (6, 20260102, 2, 2, 3, 2, 3, 5)]),
    ("mart_kpis", ("annee", "mois", "service_sk", "arrivees", "attente_tri_moyenne"), [(2025, 5, 2, 1, 3.0), (2025, 6, 1, 1, 0.0), (2026, 1, 2, 1, 5.0)]),
    ("fact_partition_pruning", ("temps_sk", "nb_arrivees", "patient_sk", "annee"), [(20250531, 1, 1, 2025), (20250601, 1, 1, 2025)]),
    ("fact_visits_lenient", _VISIT_KEYS, [(1, 20250531, 1, 2, 2, 2, 2, 3), (2, 20250601, 1, 1, 1, 1, 1, 0), (6, 20260102, 2, 2, 3, 1, 3, 5)]),
])
def test_the_filter_on_a_visits_date_does_not_copy_its_reading(spark, monkeypatch, query, columns, want):
    from types import SimpleNamespace

    from caremart.registry import queries

    plans = {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialise(df, label)

    monkeypatch.setattr(queries, "materialise", seen)
    found = queries.REGISTRY[query].run(SimpleNamespace(spark=spark, sources=lambda: _visit_sources(spark)))
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == want
    # The mask of the date is made in one place; each copy of its reading would make it again.
    assert plans["typed-urgence"].count("translate(") == 1


def test_the_search_for_rejects_does_not_copy_the_reading_of_a_date(spark):
    from caremart.plans.standardise import date_rejects

    found = date_rejects(_visit_sources(spark)["urgence"], "urgence")
    assert sorted(tuple(r) for r in found.collect()) == [("urgence", 2, "P1", "one day"), ("urgence", 4, "P1", "2019-01-01")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1

"""File sources: five dialects, resolution, delimiter sniffing, XLSX,
bronze copy (A1-A6, B1-B8, U1, T16, T21)."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from billstar.config import resolve_source_key
from billstar.operators.standardize import build_silver
from billstar.sources import files
from billstar.sources.xlsx import read_rows
from producers.workbook import write_workbook
from tests.conftest import write_text

RUN_TS = dt.datetime(2025, 6, 1)

SRC1 = ("NumPatient,NomPatient,PrenomPatient,CodeEtablissement,NomEtablissement,ServiceMedical,"
        "DateFacture,Montant,StatutPaiement,MontantPaye,DatePaiement,NombreLignes\n"
        "00123,Dupont,Jean,ETAB001,Clinique ETAB001,URGENCES,05/01/2025,100.50,PAYE,100.50,25/01/2025,3\n"
        "P2,Martin,Anne,ETAB001,Clinique ETAB001,CHIRURGIE,25/11/2025,abc,IMPAYE,0,,x\n"
        "P3,Durand,Paul,ETAB001,Clinique ETAB001,,31/02/2025,10,IMPAYE,0,,3.7\n")
SRC2 = ("PatientID;LastName;FirstName;FacilityCode;FacilityName;Department;BillingDate;InvoiceAmount;"
        "PaymentStatus;PaidAmount;PaymentDate;LineItems\n"
        "Q1;Smith;Ann;ETAB002;Clinique ETAB002;PEDIATRIE;2025-02-01;200;PARTIEL;120;2025-02-10;2\n")
SRC3 = ("ID_Pat\tNom\tPrenom\tEtab_Code\tEtab_Nom\tServ\tDt_Fact\tMt_Fact\tStatut\tMt_Paye\tDt_Paye\tNb_Lignes\n"
        "R1\tLeroy\tLuc\tETAB003\tClinique ETAB003\tRADIOLOGIE\t2025-03-01\t300\tPAYE\t300\t2025-03-05\t1\n")
SRC5 = ("billed_amt,received_amt,medical_dept,billing_timestamp,received_date,payment_state,ref_patient,"
        "family_name,given_name,clinic_ref,clinic_label,line_count\n"
        "500,0,MATERNITE,2025-04-01 10:00:00,,EN_COURS,S1,Petit,Zoe,ETAB005,Clinique ETAB005,4\n"
        "400,400,MATERNITE,2025-04-02 10:00:00,2025-04-01 08:00:00,PAYE,S2,Roux,Max,ETAB005,Clinique ETAB005,1\n")


def make_inputs(d):
    write_text(os.path.join(d, "etablissement1_facturation.csv"), SRC1)
    write_text(os.path.join(d, "etablissement2_billing.csv"), SRC2)
    write_text(os.path.join(d, "etablissement3_data.csv"), SRC3)
    write_text(os.path.join(d, "etablissement5_records.csv"), SRC5)
    header = ["ID_Patient", "NomFamille", "Prenom", "Hospital_ID", "Hospital_Name", "Service", "Invoice_Date",
              "Total_Amount", "Status", "Amount_Paid", "Payment_Date", "Item_Count"]
    rows = [["T1", "Blanc", "Eva", "ETAB004", "Clinique ETAB004", "CARDIOLOGIE", dt.datetime(2025, 5, 1, 9, 30),
             "700.25", "PARTIEL", "300", dt.datetime(2025, 5, 3, 9, 30), "6"]]
    data = write_workbook(header, rows, {"Invoice_Date", "Payment_Date"}, {"Total_Amount", "Amount_Paid",
                                                                           "Item_Count"})
    with open(os.path.join(d, "etablissement4_invoices.xlsx"), "wb") as f:
        f.write(data)


def silver_rows(spark, d):
    s = build_silver(spark, files.manifest(spark, d), RUN_TS)
    return {r["patient_id"]: r for r in s.collect()}


def test_five_dialects_standardise(spark, workdir):
    make_inputs(workdir)
    rows = silver_rows(spark, workdir)
    assert len(rows) == 8
    r = rows["00123"]                       # leading zeros kept (T21)
    assert r["date_facturation"] == dt.datetime(2025, 1, 5)      # French day-first (T1)
    assert r["date_paiement"] == dt.datetime(2025, 1, 25)
    assert str(r["montant_impaye"]) == "0.00" and r["delai_paiement_jours"] == 20
    assert r["nombre_lignes"] == 3 and r["source_file"] == "etablissement1_facturation.csv"
    assert rows["P2"]["montant_facture"] is None and rows["P2"]["nombre_lignes"] == 1
    assert rows["P2"]["date_facturation"] == dt.datetime(2025, 11, 25)
    assert rows["P3"]["date_facturation"] is None and rows["P3"]["nombre_lignes"] == 3
    assert rows["P3"]["service"] is None
    assert rows["Q1"]["delai_paiement_jours"] == 9 and str(rows["Q1"]["montant_impaye"]) == "80.00"
    assert rows["R1"]["etablissement_nom"] == "Clinique ETAB003"
    t1 = rows["T1"]                          # spreadsheet: date cells, numbers
    assert t1["date_facturation"] == dt.datetime(2025, 5, 1, 9, 30)
    assert str(t1["montant_impaye"]) == "400.25" and t1["nombre_lignes"] == 6
    assert rows["S2"]["delai_paiement_jours"] == -2      # 26 h before billing (T2)
    assert rows["S1"]["date_facturation"] == dt.datetime(2025, 4, 1, 10)


def test_resolution_and_unknown():
    assert resolve_source_key("/a/b/ETABLISSEMENT2_billing.csv") == "etablissement2"
    with pytest.raises(ValueError):
        resolve_source_key("other.csv")


def test_unknown_file_raises_in_spark(spark, workdir):
    write_text(os.path.join(workdir, "other.csv"), "a,b\n1,2\n")
    with pytest.raises(Exception):
        build_silver(spark, files.manifest(spark, workdir), RUN_TS).collect()


def test_delimiter_choice():
    assert files.choose_delimiter("a;b;c", {"a", "b"}) == ";"
    assert files.choose_delimiter("a\tb", {"a", "b"}) == "\t"
    assert files.choose_delimiter("a,b", {"a", "b"}) == ","


def test_xlsx_roundtrip_sparse_cells():
    data = write_workbook(["A", "B", "C"], [["x", None, "2"], [None, "y", None]], set(), {"C"})
    header, rows = read_rows(data)
    rows = list(rows)
    assert header == ["A", "B", "C"]
    assert rows[0][0] == "x" and rows[0][2] == "2"
    assert rows[1][1] == "y"


def test_bronze_copy_is_verbatim(spark, workdir):
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    make_inputs(src)
    bronze = os.path.join(workdir, "bronze")
    man = files.ingest_bronze(spark, src, bronze, "20250601").collect()
    assert len(man) == 5
    for r in man:
        a = open(r.path.replace("file:", ""), "rb").read()
        b = open(r.bronze_path.replace("file:", ""), "rb").read()
        assert a == b
    again = build_silver(spark, files.bronze_files(spark, bronze, "20250601"), RUN_TS)
    assert again.count() == 8


def test_xlsx_column_refs_multi_letter_and_cached():
    from billstar.sources.xlsx import col_index
    from producers.workbook import col_letters
    for i in (0, 25, 26, 27, 51, 52, 701, 702, 16383):
        ref = f"{col_letters(i)}{i + 7}"
        assert col_index(ref) == i
        assert col_index(ref) == i          # second lookup served by the cache
    assert [col_index(r) for r in ("A1", "Z9", "AA10", "AB3")] == [0, 25, 26, 27]


def test_a_workbook_larger_than_the_memory_it_is_read_in(workdir):
    """30 MB of shared strings and 100,000 rows within a few MB."""
    import tracemalloc
    import zipfile

    from billstar.sources import fs

    n, path = 100_000, os.path.join(workdir, "large.xlsx")
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/sharedStrings.xml", "w") as f:
            f.write(f"<sst {main}>".encode())
            for i in range(n):
                f.write(f"<si><t>{i:0300d}</t></si>".encode())
            f.write(b"</sst>")
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'<worksheet {main}><sheetData><row><c t="inlineStr"><is><t>h</t></is></c></row>'.encode())
            for i in range(n):
                f.write(f'<row><c t="s"><v>{(i * 7) % n if i % 2 else n - 1 - i}</v></c></row>'.encode())
            f.write(b"</sheetData></worksheet>")
    tracemalloc.start()
    with fs.open_seekable(path) as book:
        header, rows = read_rows(book)
        assert header == ["h"]
        for i, row in enumerate(rows):
            if i < 5_000 or i % 1_000 == 0:
                assert int(row[0]) == ((i * 7) % n if i % 2 else n - 1 - i)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert i == n - 1 and peak < 16 << 20

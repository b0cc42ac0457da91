"""Source specifications and run options.

A source is recognised from its file name, renamed to the canonical
(French) column contract and parsed with the date formats it writes.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

# Canonical silver columns (order of the data contract).
CANONICAL = (
    "patient_id",
    "patient_nom",
    "patient_prenom",
    "etablissement_id",
    "etablissement_nom",
    "service",
    "date_facturation",
    "montant_facture",
    "statut_paiement",
    "montant_paye",
    "date_paiement",
    "nombre_lignes",
)

# ---------------------------------------------------------------------------
# Per-source column maps (source column -> canonical column).
# They must equal the producers' layouts, so they are stated as data.
# ---------------------------------------------------------------------------
COLUMN_MAPS: dict[str, dict[str, str]] = {
    "etablissement1": {
        "NumPatient": "patient_id",
        "NomPatient": "patient_nom",
        "PrenomPatient": "patient_prenom",
        "CodeEtablissement": "etablissement_id",
        "NomEtablissement": "etablissement_nom",
        "ServiceMedical": "service",
        "DateFacture": "date_facturation",
        "Montant": "montant_facture",
        "StatutPaiement": "statut_paiement",
        "MontantPaye": "montant_paye",
        "DatePaiement": "date_paiement",
        "NombreLignes": "nombre_lignes",
    },
    "etablissement2": {
        "PatientID": "patient_id",
        "LastName": "patient_nom",
        "FirstName": "patient_prenom",
        "FacilityCode": "etablissement_id",
        "FacilityName": "etablissement_nom",
        "Department": "service",
        "BillingDate": "date_facturation",
        "InvoiceAmount": "montant_facture",
        "PaymentStatus": "statut_paiement",
        "PaidAmount": "montant_paye",
        "PaymentDate": "date_paiement",
        "LineItems": "nombre_lignes",
    },
    "etablissement3": {
        "ID_Pat": "patient_id",
        "Nom": "patient_nom",
        "Prenom": "patient_prenom",
        "Etab_Code": "etablissement_id",
        "Etab_Nom": "etablissement_nom",
        "Serv": "service",
        "Dt_Fact": "date_facturation",
        "Mt_Fact": "montant_facture",
        "Statut": "statut_paiement",
        "Mt_Paye": "montant_paye",
        "Dt_Paye": "date_paiement",
        "Nb_Lignes": "nombre_lignes",
    },
    "etablissement4": {
        "ID_Patient": "patient_id",
        "NomFamille": "patient_nom",
        "Prenom": "patient_prenom",
        "Hospital_ID": "etablissement_id",
        "Hospital_Name": "etablissement_nom",
        "Service": "service",
        "Invoice_Date": "date_facturation",
        "Total_Amount": "montant_facture",
        "Status": "statut_paiement",
        "Amount_Paid": "montant_paye",
        "Payment_Date": "date_paiement",
        "Item_Count": "nombre_lignes",
    },
    "etablissement5": {
        "ref_patient": "patient_id",
        "family_name": "patient_nom",
        "given_name": "patient_prenom",
        "clinic_ref": "etablissement_id",
        "clinic_label": "etablissement_nom",
        "medical_dept": "service",
        "billing_timestamp": "date_facturation",
        "billed_amt": "montant_facture",
        "payment_state": "statut_paiement",
        "received_amt": "montant_paye",
        "received_date": "date_paiement",
        "line_count": "nombre_lignes",
    },
}

# Column order written by source 5 (differs from the map order).
SOURCE5_ORDER = (
    "billed_amt",
    "received_amt",
    "medical_dept",
    "billing_timestamp",
    "received_date",
    "payment_state",
    "ref_patient",
    "family_name",
    "given_name",
    "clinic_ref",
    "clinic_label",
    "line_count",
)

# How each producer writes its file
# (file name, format, delimiter, Spark date pattern; None = native cells).
DIALECTS: dict[str, tuple[str, str, str | None, str | None]] = {
    "etablissement1": ("etablissement1_facturation.csv", "csv", ",", "dd/MM/yyyy"),
    "etablissement2": ("etablissement2_billing.csv", "csv", ";", "yyyy-MM-dd"),
    "etablissement3": ("etablissement3_data.csv", "csv", "\t", "yyyy-MM-dd"),
    "etablissement4": ("etablissement4_invoices.xlsx", "xlsx", None, None),
    "etablissement5": ("etablissement5_records.csv", "csv", ",", "yyyy-MM-dd HH:mm:ss"),
}

# Date patterns each source writes (Spark datetime patterns),
# tried in order; the ISO forms are accepted everywhere as a fallback.
ISO_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")
DATE_FORMATS: dict[str, tuple[str, ...]] = {
    "etablissement1": ("d/M/yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm") + ISO_FORMATS,
    "etablissement2": ISO_FORMATS,
    "etablissement3": ISO_FORMATS,
    "etablissement4": ISO_FORMATS,
    "etablissement5": ISO_FORMATS,
}

# Delimiters the header sniffer may pick, in preference order.
DELIMITERS = (",", ";", "\t", "|")

# Tokens a CSV reader treats as missing (pandas' default list).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# VARCHAR limits of the staging contract.
STAGING_LENGTHS = {
    "patient_id": 50,
    "patient_nom": 100,
    "patient_prenom": 100,
    "etablissement_id": 50,
    "etablissement_nom": 200,
    "service": 100,
    "statut_paiement": 50,
    "source_file": 255,
}


@dataclass(frozen=True)
class SourceSpec:
    """How one producer's files are recognised and read."""

    key: str
    column_map: dict[str, str]
    date_formats: tuple[str, ...]
    file_format: str = "csv"  # "csv" or "xlsx"

    @property
    def date_source_columns(self) -> tuple[str, ...]:
        return tuple(s for s, c in self.column_map.items() if c in ("date_facturation", "date_paiement"))


def source_specs() -> list[SourceSpec]:
    return [SourceSpec(k, m, DATE_FORMATS[k]) for k, m in COLUMN_MAPS.items()]


def resolve_source_key(file_name: str) -> str:
    """File stem -> source key. No digit may follow the key, so that
    ``etablissement10`` is not taken for ``etablissement1``."""
    stem = file_name.rsplit("/", 1)[-1].rsplit(".", 1)[0].lower()
    hits = [k for k in COLUMN_MAPS if re.search(re.escape(k) + r"(?![0-9])", stem)]
    if not hits:
        raise ValueError(f"no source matches file {file_name!r}")
    return max(hits, key=len)


@dataclass(frozen=True)
class RunOptions:
    """Every time-dependent operator takes ``as_of`` explicitly; there is
    no default date (``RunOptions.today()`` for a nightly run)."""

    as_of: dt.date
    run_ts: dt.datetime | None = None
    strict: bool = True
    overdue_days: int = 30
    important_days: int = 60
    priority_amount: float = 5000.0
    iforest_trees: int = 100
    iforest_psi: int = 256
    contamination: float = 0.05
    seed: int = 42
    min_rows_for_scoring: int = 10
    #: How often a load is tried while other writers commit in between.
    commit_attempts: int = 3

    @classmethod
    def today(cls, **options) -> RunOptions:
        return cls(as_of=dt.datetime.now(dt.timezone.utc).date(), **options)

    @property
    def timestamp(self) -> dt.datetime:
        return self.run_ts or dt.datetime.combine(self.as_of, dt.time())

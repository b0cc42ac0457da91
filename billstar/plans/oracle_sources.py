"""Oracle SQL for the source/standardiser queries."""

from __future__ import annotations

from billstar.config import DIALECTS
from billstar.plans.oracle import ORACLE, q

STD = """patient_id, patient_nom, patient_prenom, etablissement_id, etablissement_nom, service,
       date_facturation, CAST(montant_facture AS DOUBLE) AS montant_facture, statut_paiement,
       CAST(montant_paye AS DOUBLE) AS montant_paye, date_paiement, nombre_lignes,
       CAST(montant_impaye AS DOUBLE) AS montant_impaye, delai_paiement_jours"""

SILVER_STD = q(f"SELECT {STD} FROM silver")
for _k in ("src_csv_comma", "src_csv_semicolon", "src_csv_tab", "src_xlsx", "src_csv_reordered",
           "std_end_to_end", "src_bronze_roundtrip", "snk_silver_roundtrip"):
    ORACLE[_k] = SILVER_STD

ORACLE["std_rename"] = q("""
SELECT patient_id, patient_nom, patient_prenom, etablissement_id, etablissement_nom, service, statut_paiement
FROM silver""")
ORACLE["std_dates"] = q("SELECT patient_id, date_facturation, date_paiement FROM silver")
ORACLE["std_amounts"] = q("""
SELECT patient_id, CAST(montant_facture AS DOUBLE) AS montant_facture, CAST(montant_paye AS DOUBLE) AS montant_paye
FROM silver""")
ORACLE["std_lines"] = q("SELECT patient_id, nombre_lignes FROM silver")
ORACLE["scan_silver"] = q("""
SELECT patient_id, CAST(montant_impaye AS DOUBLE) AS montant_impaye, delai_paiement_jours
FROM silver WHERE montant_impaye > 0""")

REGION = """silver_r AS (
  SELECT s.*, 'etablissement' || CAST(n.n_regionkey + 1 AS VARCHAR) AS source_key,
         CAST(n.n_regionkey AS INTEGER) AS region_key
  FROM silver s JOIN nation n ON s.etablissement_id = CAST(n.n_nationkey AS VARCHAR)
)"""


def qr(body: str) -> str:
    return q("").rstrip() + ",\n" + REGION + "\n" + body


_stems = " ".join(f"WHEN '{k}' THEN '{v[0].rsplit('.', 1)[0]}'" for k, v in sorted(DIALECTS.items()))
_fmts = " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in sorted(DIALECTS.items()))

ORACLE["set_union_sources"] = qr("""
SELECT source_key, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(date_paiement) AS BIGINT) AS n_paid_dates
FROM silver_r GROUP BY source_key""")
ORACLE["cnt_by_source_file"] = qr(f"""
SELECT CASE source_key {_stems} END AS source_stem, CAST(count(*) AS BIGINT) AS n_rows
FROM silver_r GROUP BY 1""")
ORACLE["src_provenance"] = qr("""
SELECT patient_id, CAST(montant_facture AS DOUBLE) AS montant_facture, source_key FROM silver_r""")
ORACLE["src_resolve"] = qr(f"""
SELECT DISTINCT source_key, CASE source_key {_fmts} END AS fmt FROM silver_r""")
ORACLE["src_manifest"] = qr(f"""
SELECT CASE source_key {_fmts} END AS fmt, CAST(count(DISTINCT source_key) AS BIGINT) AS n_sources,
       TRUE AS has_bytes
FROM silver_r GROUP BY 1""")
ORACLE["src_csv_quoted"] = q(f"SELECT {STD} FROM " + """(SELECT * REPLACE (
    CASE staging_id % 5 WHEN 1 THEN 'Du "' || patient_nom || '"'
         WHEN 2 THEN patient_nom || ', dit' || chr(10) || '"' || patient_prenom || '"'
         WHEN 3 THEN patient_nom || '; ' || patient_prenom ELSE patient_nom END AS patient_nom,
    CASE WHEN staging_id % 7 = 1 THEN '"' || service || '"' ELSE service END AS service) FROM silver)""")
ORACLE["src_csv_malformed"] = q("""
SELECT patient_id, CASE WHEN staging_id % 6 IN (1, 2) THEN 'field_count' END AS reject_reason FROM silver""")

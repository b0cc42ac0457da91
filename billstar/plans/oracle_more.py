"""Oracle SQL for the queries of :mod:`billstar.plans.catalog_more`."""

from __future__ import annotations

from billstar.plans.oracle import AS_OF, ORACLE, RUN_TS, SILVER, TWO_BATCH, dims_sql, fact_sql, q

# Stated here, not imported, so that the statements stay independent.
STAGING_LENGTHS = {
    "patient_id": 50, "patient_nom": 100, "patient_prenom": 100, "etablissement_id": 50, "etablissement_nom": 200,
    "service": 100, "statut_paiement": 50, "source_file": 255,
}

REPORT = f"""
report AS (
  SELECT CAST(sum(n) AS BIGINT) AS total_rows,
         CAST(sum(m_pid) AS BIGINT) AS missing_patient_id,
         CAST(sum(m_amt) AS BIGINT) AS missing_montant_facture,
         CAST(sum(m_date) AS BIGINT) AS missing_date_facturation,
         CAST(sum(m_etab) AS BIGINT) AS missing_etablissement_id,
         CAST(sum(neg) AS BIGINT) AS negative_amounts,
         CAST(sum(fut) AS BIGINT) AS future_dates,
         CAST(sum(n - 1) AS BIGINT) AS duplicates,
         CAST(sum(inc_amt) AS BIGINT) AS incoherent_amounts,
         CAST(sum(inc_dates) AS BIGINT) AS incoherent_dates
  FROM (
    SELECT count(*) AS n,
           count(*) FILTER (WHERE patient_id IS NULL) AS m_pid,
           count(*) FILTER (WHERE montant_facture IS NULL) AS m_amt,
           count(*) FILTER (WHERE date_facturation IS NULL) AS m_date,
           count(*) FILTER (WHERE etablissement_id IS NULL) AS m_etab,
           count(*) FILTER (WHERE montant_facture < 0) AS neg,
           count(*) FILTER (WHERE date_facturation > TIMESTAMP '{RUN_TS}') AS fut,
           count(*) FILTER (WHERE montant_paye > montant_facture) AS inc_amt,
           count(*) FILTER (WHERE date_paiement IS NOT NULL AND date_paiement < date_facturation) AS inc_dates
    FROM silver GROUP BY patient_id, date_facturation, montant_facture
  ) g
)"""


def qr(body: str) -> str:
    return q("").rstrip() + "," + REPORT + "\n" + body


ORACLE["qc_report"] = qr("SELECT * FROM report")
ORACLE["qc_report_long"] = qr("""
SELECT check_name, value FROM report
UNPIVOT (value FOR check_name IN (total_rows, missing_patient_id, missing_montant_facture,
         missing_date_facturation, missing_etablissement_id, negative_amounts, future_dates,
         duplicates, incoherent_amounts, incoherent_dates))""")
ORACLE["qc_missing"] = qr("""
SELECT missing_patient_id, missing_montant_facture, missing_date_facturation, missing_etablissement_id FROM report""")
for _col, _key in (("negative_amounts", "qc_negative"), ("future_dates", "qc_future"),
                   ("duplicates", "qc_duplicates"), ("incoherent_amounts", "qc_incoherent_amounts"),
                   ("incoherent_dates", "qc_incoherent_dates")):
    ORACLE[_key] = qr(f"SELECT total_rows, {_col} FROM report")
ORACLE["qc_gate"] = qr("""
SELECT total_rows,
       (missing_patient_id > 0 OR missing_montant_facture > 0 OR negative_amounts > 0) AS critical,
       CASE WHEN (missing_patient_id > 0 OR missing_montant_facture > 0 OR negative_amounts > 0)
            THEN 'FAIL' ELSE 'PASS' END AS verdict
FROM report""")


def _violations(rules: list[tuple[str, str]], table: str, key: str) -> str:
    parts = [f"SELECT '{name}' AS rule, {key} FROM {table} WHERE coalesce({cond}, FALSE)" for name, cond in rules]
    return "\nUNION ALL\n".join(parts)


NOT_NULL = [(f"not_null_{c}", f"{c} IS NULL") for c in
            ("patient_id", "etablissement_id", "date_facturation", "montant_facture")]
AMOUNTS = [("check_montant_facture_positive", "montant_facture < 0"),
           ("check_montant_paye_positive", "montant_paye < 0")]
DATES = [("check_dates_coherentes", "date_paiement IS NOT NULL AND date_paiement < date_facturation")]
LENGTHS = [(f"length_{c}", f"length({c}) > {n}") for c, n in STAGING_LENGTHS.items()]
FACT_NOT_NULL = [(f"not_null_{c}", f"{c} IS NULL") for c in
                 ("patient_key", "etablissement_key", "date_key", "montant_facture", "montant_paye", "montant_impaye")]
BALANCE = [("check_coherence_montants", "montant_impaye <> montant_facture - montant_paye")]

ORACLE["chk_not_null"] = q(_violations(NOT_NULL, "silver", "staging_id"))
ORACLE["chk_amounts"] = q(_violations(AMOUNTS, "silver", "staging_id"))
ORACLE["chk_dates"] = q(_violations(DATES, "silver", "staging_id"))
ORACLE["chk_lengths"] = q(_violations(LENGTHS, "silver", "staging_id"))
ORACLE["chk_row_rules"] = q(_violations(NOT_NULL + AMOUNTS + DATES + LENGTHS, "silver", "staging_id"))
ORACLE["chk_balance"] = q(_violations(FACT_NOT_NULL + AMOUNTS + BALANCE, "fact", "fact_id"))


def _dups(table: str, key: str, name: str) -> str:
    return (f"SELECT '{name}' AS table_name, '{key}' AS key_column, CAST({key} AS VARCHAR) AS key_value, "
            f"CAST(count(*) AS BIGINT) AS occurrences FROM {table} GROUP BY {key} HAVING count(*) > 1")


ORACLE["chk_unique"] = q("\nUNION ALL\n".join([
    _dups("dim_patient", "patient_id_naturel", "dim_patient"),
    _dups("dim_patient", "patient_key", "dim_patient"),
    _dups("dim_etab", "etablissement_id_naturel", "dim_etablissement"),
    _dups("dim_date", "date_complete", "dim_date"),
    _dups("dim_service", "service_code", "dim_service"),
    _dups("fact", "fact_id", "fact_facturation"),
]))

ORACLE["chk_fk_orphans"] = TWO_BATCH + """,
ff AS (SELECT * FROM fact_a UNION ALL SELECT * FROM fact_b)
SELECT 'fk_fact_patient_key' AS constraint_name, fact_id, patient_key AS missing_key FROM ff f
WHERE NOT EXISTS (SELECT 1 FROM dim_patient_a d WHERE d.patient_key = f.patient_key)
UNION ALL
SELECT 'fk_fact_etablissement_key', fact_id, etablissement_key FROM ff f
WHERE NOT EXISTS (SELECT 1 FROM dim_etab_a d WHERE d.etablissement_key = f.etablissement_key)
UNION ALL
SELECT 'fk_fact_date_key', fact_id, date_key FROM ff f
WHERE NOT EXISTS (SELECT 1 FROM dim_date_a d WHERE d.date_key = f.date_key)
UNION ALL
SELECT 'fk_fact_service_key', fact_id, service_key FROM ff f
WHERE service_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_service_a d WHERE d.service_key = f.service_key)"""

# ------------------------------------------------------------------ anomaly
FEATURES = """
feat AS (
  SELECT fact_id, CAST(montant_impaye AS DOUBLE) AS montant_impaye,
         CAST(coalesce(delai_paiement_jours, 0) AS DOUBLE) AS delai_paiement_jours,
         CAST(coalesce(nombre_lignes, 0) AS DOUBLE) AS nombre_lignes
  FROM fact WHERE montant_impaye > 0
),
stats AS (
  SELECT avg(montant_impaye) AS mean_montant_impaye,
         CASE WHEN coalesce(stddev_pop(montant_impaye), 0) = 0 THEN 1.0 ELSE stddev_pop(montant_impaye) END AS std_montant_impaye,
         avg(delai_paiement_jours) AS mean_delai_paiement_jours,
         CASE WHEN coalesce(stddev_pop(delai_paiement_jours), 0) = 0 THEN 1.0 ELSE stddev_pop(delai_paiement_jours) END AS std_delai_paiement_jours,
         avg(nombre_lignes) AS mean_nombre_lignes,
         CASE WHEN coalesce(stddev_pop(nombre_lignes), 0) = 0 THEN 1.0 ELSE stddev_pop(nombre_lignes) END AS std_nombre_lignes
  FROM feat
)"""


def qf(body: str) -> str:
    return q("").rstrip() + "," + FEATURES + "\n" + body


ORACLE["ml_features"] = qf("SELECT * FROM feat")
ORACLE["scan_unpaid_features"] = q("""
SELECT fact_id, CAST(montant_impaye AS DOUBLE) AS montant_impaye, delai_paiement_jours, nombre_lignes
FROM fact WHERE montant_impaye > 0""")
ORACLE["ml_scaler_stats"] = qf("""
SELECT round(mean_montant_impaye, 6) AS mean_montant_impaye, round(std_montant_impaye, 6) AS std_montant_impaye,
       round(mean_delai_paiement_jours, 6) AS mean_delai_paiement_jours,
       round(std_delai_paiement_jours, 6) AS std_delai_paiement_jours,
       round(mean_nombre_lignes, 6) AS mean_nombre_lignes, round(std_nombre_lignes, 6) AS std_nombre_lignes
FROM stats""")
ORACLE["ml_scaled"] = qf("""
SELECT f.fact_id,
       round((f.montant_impaye - s.mean_montant_impaye) / s.std_montant_impaye, 6) AS z_montant_impaye,
       round((f.delai_paiement_jours - s.mean_delai_paiement_jours) / s.std_delai_paiement_jours, 6) AS z_delai_paiement_jours,
       round((f.nombre_lignes - s.mean_nombre_lignes) / s.std_nombre_lignes, 6) AS z_nombre_lignes
FROM feat f, stats s""")

# ------------------------------------------------------------ runs, stream
ORACLE["run_batch_warehouse"] = ORACLE["view_ca_mensuel"]
ORACLE["run_nightly"] = ORACLE["view_ca_mensuel"]
ORACLE["run_nightly_mart"] = q(f"""
SELECT p.nom AS patient_nom, e.nom_etablissement, s.service_nom, CAST(f.montant_impaye AS DOUBLE) AS montant_impaye,
       CAST(DATE '{AS_OF}' - d.date_complete AS INTEGER) AS delai_jours, d.date_complete AS date_facturation
FROM (SELECT * FROM fact WHERE montant_impaye > 0) f
JOIN (SELECT * FROM dim_date WHERE DATE '{AS_OF}' - date_complete > 30) d USING (date_key)
JOIN dim_patient p USING (patient_key) JOIN dim_etab e USING (etablissement_key)
LEFT JOIN dim_service s USING (service_key)""")
ORACLE["run_batch_replay"] = q("""
SELECT CAST(2 * (SELECT count(*) FROM stg) AS BIGINT) AS staging_rows,
       CAST((SELECT count(*) FROM fact) AS BIGINT) AS fact_rows,
       CAST(0 AS BIGINT) AS second_insert, TRUE AS replay_skipped""")
ORACLE["stream_incremental"] = q("""
SELECT p.patient_id_naturel, e.nom_etablissement, d.date_complete AS date_facturation, s.service_nom,
       CAST(f.montant_facture AS DOUBLE) AS montant_facture, CAST(f.montant_paye AS DOUBLE) AS montant_paye,
       CAST(f.montant_impaye AS DOUBLE) AS montant_impaye, f.delai_paiement_jours, f.nombre_lignes,
       f.statut_paiement
FROM fact f
JOIN dim_patient p ON f.patient_key = p.patient_key
JOIN dim_etab e ON f.etablissement_key = e.etablissement_key
JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_service s ON f.service_key = s.service_key""")


# ------------------------------------------------------------- spoiled rows
_CLEAN, _STG = SILVER.replace("\nsilver AS (", "\nclean AS (", 1).split("\nstg AS (", 1)
SPOILED = _CLEAN + f"""
wrong AS (
  SELECT * REPLACE (
    CASE WHEN staging_id % 23 <> 4 THEN patient_id END AS patient_id,
    CASE WHEN staging_id % 17 = 7 THEN repeat(patient_nom, 12) ELSE patient_nom END AS patient_nom,
    CASE WHEN staging_id % 19 <> 2 THEN service END AS service,
    CASE WHEN staging_id % 11 = 3 THEN NULL
         WHEN staging_id % 31 = 8 THEN TIMESTAMP '{AS_OF}' + INTERVAL 100 DAY ELSE date_facturation END AS date_facturation,
    CAST(CASE WHEN staging_id % 13 = 5 THEN -montant_facture ELSE montant_facture END AS DECIMAL(12,2)) AS montant_facture,
    CAST(CASE WHEN staging_id % 29 = 6 THEN montant_facture * 2 ELSE montant_paye END AS DECIMAL(12,2)) AS montant_paye,
    CAST(CASE WHEN staging_id % 41 = 10 THEN montant_impaye + 1
              ELSE (CASE WHEN staging_id % 13 = 5 THEN -montant_facture ELSE montant_facture END)
                 - (CASE WHEN staging_id % 29 = 6 THEN montant_facture * 2 ELSE montant_paye END)
         END AS DECIMAL(12,2)) AS montant_impaye)
  FROM clean
),
silver AS (
  SELECT * FROM wrong UNION ALL SELECT * REPLACE (-staging_id AS staging_id) FROM wrong WHERE staging_id % 37 = 9
),
stg AS (""" + _STG
BAD = "WITH" + SPOILED + "," + dims_sql("stg") + "," + fact_sql("stg")


def bad(body: str) -> str:
    return BAD + "\n" + body


ORACLE["bad_qc_report"] = BAD + "," + REPORT + "\nSELECT * FROM report"
ORACLE["bad_qc_duplicates"] = BAD + "," + REPORT + "\nSELECT total_rows, duplicates FROM report"
ORACLE["bad_qc_gate"] = BAD + "," + REPORT + """
SELECT total_rows, missing_patient_id > 0 OR missing_montant_facture > 0 OR negative_amounts > 0 AS critical,
       CASE WHEN missing_patient_id > 0 OR missing_montant_facture > 0 OR negative_amounts > 0
            THEN 'FAIL' ELSE 'PASS' END AS verdict
FROM report"""
ORACLE["bad_flt_null_date"] = bad("SELECT staging_id, date_facturation FROM silver WHERE date_facturation IS NOT NULL")
ORACLE["bad_flt_rejects"] = bad("""
SELECT staging_id, CASE WHEN date_facturation IS NULL THEN 'date_facturation_null'
                        ELSE 'date_paiement_avant_facturation' END AS reject_reason
FROM silver WHERE date_facturation IS NULL OR date_paiement < date_facturation""")
ORACLE["bad_chk_not_null"] = bad(_violations(NOT_NULL, "silver", "staging_id"))
ORACLE["bad_chk_amounts"] = bad(_violations(AMOUNTS, "silver", "staging_id"))
ORACLE["bad_chk_lengths"] = bad(_violations(LENGTHS, "silver", "staging_id"))
ORACLE["bad_chk_row_rules"] = bad(_violations(NOT_NULL + AMOUNTS + DATES + LENGTHS, "silver", "staging_id"))
ORACLE["bad_dim_patient"] = bad("SELECT patient_key, patient_id_naturel, nom, prenom FROM dim_patient")
ORACLE["bad_fact_key_lookup"] = bad(
    "SELECT staging_id, patient_key, etablissement_key, date_key, service_key FROM fact_keys")
ORACLE["bad_chk_balance"] = bad(_violations(FACT_NOT_NULL + AMOUNTS + BALANCE, "fact", "fact_id"))
ORACLE["bad_std_lenient"] = q("""
SELECT staging_id,
       CASE WHEN staging_id % 8 NOT IN (1, 2, 3, 4) THEN date_facturation END AS date_facturation,
       CASE WHEN staging_id % 7 NOT IN (1, 2, 4, 5) THEN CAST(montant_facture AS DOUBLE) END AS montant_facture,
       CAST(CASE staging_id % 6 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN -2 ELSE nombre_lignes END AS INTEGER)
         AS nombre_lignes
FROM silver""")
ORACLE["bad_chk_unique"] = bad(
    _dups("stg", "service", "staging_facturation") + " AND service IS NOT NULL\nUNION ALL\n"
    + _dups("stg", "staging_id", "staging_facturation"))

# ------------------------------------------------------- rule-based labels
RULED = FEATURES + """,
scored AS (
  SELECT fact_id, round(-greatest(
           abs((f.montant_impaye - s.mean_montant_impaye) / s.std_montant_impaye),
           abs((f.delai_paiement_jours - s.mean_delai_paiement_jours) / s.std_delai_paiement_jours),
           abs((f.nombre_lignes - s.mean_nombre_lignes) / s.std_nombre_lignes)), 6) AS score
  FROM feat f, stats s
),
cut AS (SELECT quantile_cont(score, 0.05) AS thr FROM scored),
labels AS (
  SELECT fact_id, CASE WHEN score < thr THEN -1 ELSE 1 END AS anomaly_score, round(score - thr, 6) AS anomaly_decision
  FROM scored, cut
),
lfact AS (SELECT f.* EXCLUDE (anomaly_score), l.anomaly_score, l.anomaly_decision FROM fact f LEFT JOIN labels l USING (fact_id))"""


def ruled(body: str) -> str:
    return q("").rstrip() + "," + RULED + "\n" + body


def _on_labels(sql: str) -> str:
    """A statement over the fact, reading the labelled fact instead."""
    head, body = sql[:len(q(""))], sql[len(q("")):]
    return head.rstrip() + "," + RULED + "\n" + body.replace("FROM fact f", "FROM lfact f")


ORACLE["rule_threshold"] = ruled("""
SELECT round((SELECT thr FROM cut), 6) AS threshold, count(*) AS n_scored, count(*) FILTER (anomaly_score = -1) AS n_below
FROM labels""")
ORACLE["rule_quantile_feature"] = ruled("""
SELECT round(quantile_cont(montant_impaye, 0.05), 6) AS q05_montant_impaye,
       round(quantile_cont(delai_paiement_jours, 0.05), 6) AS q05_delai_paiement_jours,
       round(quantile_cont(nombre_lignes, 0.05), 6) AS q05_nombre_lignes, count(*) AS n
FROM feat""")
ORACLE["rule_labels"] = ruled("SELECT * FROM labels")
ORACLE["rule_anomaly_rate"] = ruled("""
SELECT count(*) AS n_scored, count(*) FILTER (anomaly_score = -1) AS n_anomalies,
       round(count(*) FILTER (anomaly_score = -1) * 100.0 / count(*), 1) AS anomaly_pct
FROM labels""")
ORACLE["rule_apply_scores"] = ruled("""
SELECT fact_id, CAST(montant_impaye AS DOUBLE) AS montant_impaye, anomaly_score, anomaly_decision FROM lfact""")
ORACLE["rule_mart_relance"] = _on_labels(ORACLE["mart_relance"])
ORACLE["rule_relance_urgent"] = _on_labels(ORACLE["mart_relance"]).replace(") m\nORDER", ") m WHERE priorite = 'URGENT'\nORDER")
ORACLE["rule_stats_etablissement"] = _on_labels(ORACLE["view_stats_etablissement"])
ORACLE["rule_anomaly_clients"] = ruled("""
SELECT p.nom, p.prenom, CAST(f.montant_impaye AS DOUBLE) AS montant_impaye, f.anomaly_score, f.anomaly_decision,
       d.date_complete AS date_facturation, e.nom_etablissement
FROM (SELECT * FROM lfact WHERE anomaly_decision < -0.1 ORDER BY anomaly_decision, fact_id LIMIT 20) f
JOIN dim_patient p USING (patient_key) JOIN dim_etab e USING (etablissement_key) JOIN dim_date d USING (date_key)""")
ORACLE["rule_anomaly_count"] = ruled("SELECT count(*) FILTER (anomaly_score = -1) AS nb_anomalies FROM lfact")
ORACLE["rule_bandes_anomalie"] = ruled("""
SELECT CASE WHEN anomaly_decision < -0.2 THEN 'Anomalie forte' WHEN anomaly_decision < -0.1 THEN 'Anomalie modérée'
            WHEN anomaly_decision < 0 THEN 'Anomalie faible' ELSE 'Normal' END AS categorie_anomalie,
       count(*) AS nb_factures, round(CAST(avg(montant_impaye) AS DOUBLE), 4) AS montant_impaye_moyen
FROM lfact WHERE montant_impaye > 0 GROUP BY ALL""")
ORACLE["rule_features_top"] = ruled("""
SELECT fact_id, CAST(montant_impaye AS DOUBLE) AS montant_impaye, delai_paiement_jours,
       CAST(montant_facture AS DOUBLE) AS montant_facture, anomaly_score, anomaly_decision,
       CASE WHEN anomaly_decision < -0.1 THEN 'ANOMALIE' ELSE 'NORMAL' END AS statut
FROM lfact WHERE montant_impaye > 0 ORDER BY anomaly_decision NULLS LAST, fact_id LIMIT 50""")

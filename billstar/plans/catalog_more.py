"""Further registered queries (quality, constraints, sources, anomaly, streaming)."""

from __future__ import annotations

from billstar.functions.parse import lenient_count, lenient_decimal, lenient_timestamp
from billstar.operators import constraints as K
from billstar.operators import quality
from billstar.operators.dimensions import build_dims
from billstar.operators.fact import build_fact, lookup_keys
from billstar.operators.loading import drop_null_billing_date, split_rejects, to_staging
from billstar.plans.catalog import present, query
from billstar.plans.model import from_driver_tables, two_batches
from billstar.sources.driver_tables import spoiled_silver


# ------------------------------------------------------------------ quality
def _report(spark, sf):
    m = from_driver_tables(spark, sf)
    return quality.quality_report(m.silver, m.opts.timestamp)


@query("qc_report")
def q_qc_report(spark, sf):
    return _report(spark, sf)


@query("qc_report_long")
def q_qc_report_long(spark, sf):
    return quality.report_long(_report(spark, sf))


@query("qc_missing")
def q_qc_missing(spark, sf):
    m = from_driver_tables(spark, sf)
    names = [f"missing_{c}" for c in quality.CRITICAL_FIELDS]
    return quality.counters(m.silver, m.opts.timestamp, names).select(*names)


@query("qc_duplicates")
def q_qc_duplicates(spark, sf):
    return quality.duplicates(from_driver_tables(spark, sf).silver)


for _name in ("negative_amounts", "future_dates", "incoherent_amounts", "incoherent_dates"):
    _key = {"negative_amounts": "qc_negative", "future_dates": "qc_future"}.get(_name, f"qc_{_name}")

    def _make(col):
        def fn(spark, sf):
            m = from_driver_tables(spark, sf)
            return quality.counters(m.silver, m.opts.timestamp, [col])
        return fn

    query(_key)(_make(_name))


@query("qc_gate")
def q_qc_gate(spark, sf):
    return quality.gate(_report(spark, sf)).select("total_rows", "critical", "verdict")


# -------------------------------------------------------------- constraints
@query("chk_not_null")
def q_chk_not_null(spark, sf):
    m = from_driver_tables(spark, sf)
    return K.violations(m.silver, K.not_null_rules(K.STAGING_NOT_NULL), "staging_id")


@query("chk_amounts")
def q_chk_amounts(spark, sf):
    m = from_driver_tables(spark, sf)
    return K.violations(m.silver, K.amount_rules(), "staging_id")


@query("chk_dates")
def q_chk_dates(spark, sf):
    m = from_driver_tables(spark, sf)
    return K.violations(m.silver, K.date_rules(), "staging_id")


@query("chk_lengths")
def q_chk_lengths(spark, sf):
    m = from_driver_tables(spark, sf)
    return K.violations(m.silver, K.length_rules(), "staging_id")


@query("chk_row_rules")
def q_chk_row_rules(spark, sf):
    m = from_driver_tables(spark, sf)
    rules = {**K.not_null_rules(K.STAGING_NOT_NULL), **K.amount_rules(), **K.date_rules(), **K.length_rules()}
    return K.violations(m.silver, rules, "staging_id")


@query("chk_balance")
def q_chk_balance(spark, sf):
    m = from_driver_tables(spark, sf)
    rules = {**K.not_null_rules(K.FACT_NOT_NULL), **K.amount_rules(), **K.balance_rules()}
    return K.violations(m.fact, rules, "fact_id")


@query("chk_unique")
def q_chk_unique(spark, sf):
    m = from_driver_tables(spark, sf)
    d = m.dims
    parts = [K.duplicate_keys(d.patient, "patient_id_naturel", "dim_patient"),
             K.duplicate_keys(d.patient, "patient_key", "dim_patient"),
             K.duplicate_keys(d.etablissement, "etablissement_id_naturel", "dim_etablissement"),
             K.duplicate_keys(d.date, "date_complete", "dim_date"),
             K.duplicate_keys(d.service, "service_code", "dim_service"),
             K.duplicate_keys(m.fact, "fact_id", "fact_facturation")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("chk_fk_orphans")
def q_chk_fk_orphans(spark, sf):
    tb = two_batches(from_driver_tables(spark, sf))
    fact = tb.fact_a.unionByName(tb.new_fact_b)
    return K.fk_orphans(fact, tb.dims_a)


# ------------------------------------------------- the same on spoiled rows
def _spoiled(spark, sf):
    """(silver, valid, rejects, staging, fact) over the spoiled rows."""
    m = from_driver_tables(spark, sf)
    silver = spoiled_silver(m.silver, m.opts.as_of)
    valid, rejects = split_rejects(silver)
    staging = to_staging(valid)
    dims, _ = build_dims(staging, m.opts.timestamp)
    return m, silver, valid, rejects, staging, dims


@query("bad_qc_report")
def q_bad_qc_report(spark, sf):
    m, silver, *_ = _spoiled(spark, sf)
    return quality.quality_report(silver, m.opts.timestamp)


@query("bad_qc_gate")
def q_bad_qc_gate(spark, sf):
    m, silver, *_ = _spoiled(spark, sf)
    return quality.gate(quality.quality_report(silver, m.opts.timestamp)).select("total_rows", "critical", "verdict")


@query("bad_qc_duplicates")
def q_bad_qc_duplicates(spark, sf):
    return quality.duplicates(_spoiled(spark, sf)[1])


@query("bad_flt_null_date")
def q_bad_flt_null_date(spark, sf):
    return drop_null_billing_date(_spoiled(spark, sf)[1]).select("staging_id", "date_facturation")


@query("bad_flt_rejects")
def q_bad_flt_rejects(spark, sf):
    return _spoiled(spark, sf)[3].select("staging_id", "reject_reason")


@query("bad_chk_row_rules")
def q_bad_chk_row_rules(spark, sf):
    rules = {**K.not_null_rules(K.STAGING_NOT_NULL), **K.amount_rules(), **K.date_rules(), **K.length_rules()}
    return K.violations(_spoiled(spark, sf)[1], rules, "staging_id")


for _name, _rules in (("not_null", lambda: K.not_null_rules(K.STAGING_NOT_NULL)), ("amounts", K.amount_rules),
                      ("lengths", K.length_rules)):
    def _bad(rules):
        def fn(spark, sf):
            return K.violations(_spoiled(spark, sf)[1], rules(), "staging_id")
        return fn

    query(f"bad_chk_{_name}")(_bad(_rules))


@query("bad_dim_patient")
def q_bad_dim_patient(spark, sf):
    return _spoiled(spark, sf)[5].patient.select("patient_key", "patient_id_naturel", "nom", "prenom")


@query("bad_fact_key_lookup")
def q_bad_fact_key_lookup(spark, sf):
    *_, staging, dims = _spoiled(spark, sf)
    return lookup_keys(staging, dims).select(
        "staging_id", "patient_key", "etablissement_key", "date_key", "service_key")


@query("bad_chk_balance")
def q_bad_chk_balance(spark, sf):
    m, *_, staging, dims = _spoiled(spark, sf)
    return K.violations(build_fact(staging, dims, m.opts.timestamp), K.fact_rules(), "fact_id")


@query("bad_std_lenient")
def q_bad_std_lenient(spark, sf):
    """Lenient parsing (B3-B5) of raw fields that are spoiled by remainder."""
    raw = from_driver_tables(spark, sf).silver.selectExpr(
        "staging_id",
        """CASE staging_id % 8 WHEN 1 THEN '31/02/2001' WHEN 2 THEN 'n/a' WHEN 3 THEN '' WHEN 4 THEN '2001-99-99'
           WHEN 5 THEN concat('  ', date_format(date_facturation, 'dd/MM/yyyy'), ' ')
           ELSE date_format(date_facturation, 'dd/MM/yyyy') END AS d""",
        """CASE staging_id % 7 WHEN 1 THEN 'abc' WHEN 2 THEN '' WHEN 3 THEN concat(' ', montant_facture, ' ')
           WHEN 4 THEN '99999999999999' WHEN 5 THEN 'NaN' ELSE cast(montant_facture AS STRING) END AS a""",
        """CASE staging_id % 6 WHEN 1 THEN concat(nombre_lignes, '.7') WHEN 2 THEN 'x' WHEN 3 THEN ''
           WHEN 4 THEN '-2' ELSE cast(nombre_lignes AS STRING) END AS n""")
    return present(raw.select(
        "staging_id", lenient_timestamp("d", ("dd/MM/yyyy",)).alias("date_facturation"),
        lenient_decimal("a").alias("montant_facture"), lenient_count("n").alias("nombre_lignes")))


@query("bad_chk_unique")
def q_bad_chk_unique(spark, sf):
    """UNIQUE over the natural keys of the staging rows, which repeat."""
    staging = _spoiled(spark, sf)[4]
    return K.duplicate_keys(staging, "service", "staging_facturation").where("key_value is not null").unionByName(
        K.duplicate_keys(staging, "staging_id", "staging_facturation"))

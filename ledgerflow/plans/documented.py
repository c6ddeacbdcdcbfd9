"""Shapes described by the reference documentation but not by its SQL (P1-P7;
P8 lives with the sync history).  Columns that depend on the ERP version are
chosen at plan time from the columns present (capability detection)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_double, credit_positive, debit_positive, only_if, root
from ..registry import register


@register("party_directory", """
SELECT cbmarq AS watermark_sync, ct_num AS code_tiers, ct_intitule AS nom_tiers,
    CASE ct_type WHEN 0 THEN 'client' ELSE 'fournisseur' END AS type_tiers,
    ct_adresse AS adresse, CAST(NULL AS VARCHAR) AS complement, ct_codepostal AS code_postal, ct_ville AS ville,
    ct_pays AS pays, ct_telephone AS telephone, ct_email AS email, ct_siret AS siret,
    CAST(ct_sommeil AS INTEGER) AS en_sommeil, CAST(n_catcompta AS INTEGER) AS cat_comptable,
    CASE WHEN ct_type = 0 THEN CAST(ct_encours AS DOUBLE) END AS encours_autorise
FROM f_comptet WHERE ct_type IN (0, 1)
""")
def party_directory(t, as_of: str) -> DataFrame:
    """Clients (type 0) and suppliers (type 1) master data."""
    ct = t.f_comptet.filter(F.col("ct_type").isin(0, 1))
    return ct.select(
        F.col("cbmarq").alias("watermark_sync"), F.col("ct_num").alias("code_tiers"),
        F.col("ct_intitule").alias("nom_tiers"),
        F.when(F.col("ct_type") == 0, "client").otherwise("fournisseur").alias("type_tiers"),
        F.col("ct_adresse").alias("adresse"), F.lit(None).cast("string").alias("complement"),
        F.col("ct_codepostal").alias("code_postal"), F.col("ct_ville").alias("ville"), F.col("ct_pays").alias("pays"),
        F.col("ct_telephone").alias("telephone"), F.col("ct_email").alias("email"), F.col("ct_siret").alias("siret"),
        F.col("ct_sommeil").cast("int").alias("en_sommeil"), F.col("n_catcompta").cast("int").alias("cat_comptable"),
        F.when(F.col("ct_type") == 0, as_double("ct_encours")).alias("encours_autorise"))


@register("account_month_balance", """
SELECT max(ec.cbmarq) AS watermark_sync, ec.cg_num AS compte, cg.cg_intitule AS intitule_compte,
    CAST(year(ec.ec_date) AS INTEGER) AS annee, CAST(month(ec.ec_date) AS INTEGER) AS mois,
    CAST(SUM(CASE WHEN ec.ec_sens = 0 THEN ec.ec_montant ELSE -ec.ec_montant END) AS DOUBLE) AS solde_net,
    CAST(SUM(CASE WHEN ec.ec_sens = 0 THEN ec.ec_montant ELSE 0 END) AS DOUBLE) AS total_debit,
    CAST(SUM(CASE WHEN ec.ec_sens = 1 THEN ec.ec_montant ELSE 0 END) AS DOUBLE) AS total_credit,
    COUNT(*) AS nb_ecritures
FROM f_ecriturec ec LEFT JOIN f_compteg cg ON ec.cg_num = cg.cg_num
GROUP BY ec.cg_num, cg.cg_intitule, year(ec.ec_date), month(ec.ec_date)
""")
def account_month_balance(t, as_of: str) -> DataFrame:
    """Balance per account and month (aggregated before the label join)."""
    ec = t.f_ecriturec
    m, s = F.col("ec_montant"), F.col("ec_sens")
    agg = ec.groupBy("cg_num", F.year("ec_date").alias("annee"), F.month("ec_date").alias("mois")).agg(
        F.max("cbmarq").alias("watermark_sync"), F.sum(debit_positive(m, s)).alias("solde_net"),
        F.sum(only_if(s == 0, m)).alias("total_debit"), F.sum(only_if(s == 1, m)).alias("total_credit"),
        F.count(F.lit(1)).alias("nb_ecritures"))
    agg = agg.join(t.f_compteg.select("cg_num", "cg_intitule"), "cg_num", "left")
    return agg.select("watermark_sync", F.col("cg_num").alias("compte"), F.col("cg_intitule").alias("intitule_compte"),
                      "annee", "mois", as_double("solde_net").alias("solde_net"),
                      as_double("total_debit").alias("total_debit"), as_double("total_credit").alias("total_credit"),
                      "nb_ecritures")


@register("payroll_ledger", """
SELECT ec.cbmarq AS watermark_sync, ec.cg_num AS compte, cg.cg_intitule AS intitule, ec.ec_date AS date_ecriture,
    ec.ec_intitule AS libelle, CAST(ec.ec_montant AS DOUBLE) AS montant, CAST(ec.ec_sens AS INTEGER) AS sens,
    CAST(year(ec.ec_date) AS INTEGER) AS annee, CAST(month(ec.ec_date) AS INTEGER) AS mois
FROM f_ecriturec ec LEFT JOIN f_compteg cg ON ec.cg_num = cg.cg_num
WHERE ec.cg_num LIKE '64%'
""")
def payroll_ledger(t, as_of: str) -> DataFrame:
    """Ledger entries on payroll accounts (root 64)."""
    ec = t.f_ecriturec.filter(F.col("cg_num").startswith("64"))
    df = ec.join(t.f_compteg.select("cg_num", "cg_intitule"), "cg_num", "left")
    return df.select(F.col("cbmarq").alias("watermark_sync"), F.col("cg_num").alias("compte"),
                     F.col("cg_intitule").alias("intitule"), F.col("ec_date").alias("date_ecriture"),
                     F.col("ec_intitule").alias("libelle"), as_double("ec_montant").alias("montant"),
                     F.col("ec_sens").cast("int").alias("sens"), F.year("ec_date").alias("annee"),
                     F.month("ec_date").alias("mois"))


@register("kpi_documented", """
WITH l AS (
    SELECT
        SUM(CASE WHEN left(cg_num, 2) = '70' AND year(ec_date) = 2001 AND ec_date <= DATE '2001-07-15'
                 THEN CASE WHEN ec_sens = 1 THEN ec_montant ELSE -ec_montant END END) AS ca_annee,
        SUM(CASE WHEN left(cg_num, 2) = '70' AND year(ec_date) = 2001 AND month(ec_date) = 7 AND ec_date <= DATE '2001-07-15'
                 THEN CASE WHEN ec_sens = 1 THEN ec_montant ELSE -ec_montant END END) AS ca_mois,
        SUM(CASE WHEN left(cg_num, 1) = '6' AND year(ec_date) = 2001 AND ec_date <= DATE '2001-07-15'
                 THEN CASE WHEN ec_sens = 0 THEN ec_montant ELSE -ec_montant END END) AS charges_annee,
        SUM(CASE WHEN left(cg_num, 2) = '12' THEN CASE WHEN ec_sens = 1 THEN ec_montant ELSE -ec_montant END END)
            AS resultat_annee,
        SUM(CASE WHEN left(cg_num, 1) = '5' THEN CASE WHEN ec_sens = 0 THEN ec_montant ELSE -ec_montant END END)
            AS tresorerie_solde
    FROM f_ecriturec
),
p AS (SELECT SUM(CASE WHEN ct_type = 0 AND ct_sommeil = 0 THEN 1 ELSE 0 END) AS nc,
             SUM(CASE WHEN ct_type = 1 AND ct_sommeil = 0 THEN 1 ELSE 0 END) AS nf FROM f_comptet)
SELECT 0 AS watermark_sync, 2001 AS annee_courante, 7 AS mois_courant,
    CAST(ca_annee AS DOUBLE) AS ca_annee, CAST(ca_mois AS DOUBLE) AS ca_mois,
    CAST(charges_annee AS DOUBLE) AS charges_annee, CAST(resultat_annee AS DOUBLE) AS resultat_annee,
    CAST(tresorerie_solde AS DOUBLE) AS tresorerie_solde,
    CAST((SELECT nc FROM p) AS BIGINT) AS nb_clients_actifs, CAST((SELECT nf FROM p) AS BIGINT) AS nb_fournisseurs_actifs
FROM l
""")
def kpi_documented(t, as_of: str) -> DataFrame:
    """One-row KPI page (year-to-date revenue and charges, result on
    roots 12, treasury, active parties).  One scan per source table."""
    ec = t.f_ecriturec
    m, s, d = F.col("ec_montant"), F.col("ec_sens"), F.col("ec_date")
    asof = F.lit(as_of).cast("date")
    ytd = (F.year(d) == F.year(asof)) & (d <= asof)
    r2, r1 = root("cg_num", 2), root("cg_num", 1)
    led = ec.agg(
        F.sum(F.when((r2 == "70") & ytd, credit_positive(m, s))).alias("ca_annee"),
        F.sum(F.when((r2 == "70") & ytd & (F.month(d) == F.month(asof)), credit_positive(m, s))).alias("ca_mois"),
        F.sum(F.when((r1 == "6") & ytd, debit_positive(m, s))).alias("charges_annee"),
        F.sum(F.when(r2 == "12", credit_positive(m, s))).alias("resultat_annee"),
        F.sum(F.when(r1 == "5", debit_positive(m, s))).alias("tresorerie_solde"))
    ct = t.f_comptet
    active = F.col("ct_sommeil") == 0
    nc = ct.select(F.sum(F.when((F.col("ct_type") == 0) & active, 1).otherwise(0)).cast("long")).scalar()
    nf = ct.select(F.sum(F.when((F.col("ct_type") == 1) & active, 1).otherwise(0)).cast("long")).scalar()
    return led.select(F.lit(0).alias("watermark_sync"), F.year(asof).alias("annee_courante"),
                      F.month(asof).alias("mois_courant"),
                      *[as_double(c).alias(c) for c in ("ca_annee", "ca_mois", "charges_annee", "resultat_annee",
                                                        "tresorerie_solde")],
                      nc.alias("nb_clients_actifs"), nf.alias("nb_fournisseurs_actifs"))


@register("document_list", """
SELECT de.cbmarq AS watermark_sync, de.do_piece AS num_document, CAST(de.do_type AS INTEGER) AS type_doc,
    de.do_date AS date_document, de.do_datelivr AS date_livraison, de.do_tiers AS code_tiers,
    ct.ct_intitule AS nom_tiers, CAST(de.do_totalht AS DOUBLE) AS montant_ht, CAST(de.do_totalttc AS DOUBLE) AS montant_ttc,
    CAST(de.do_totaltva AS DOUBLE) AS montant_tva, CAST(de.do_statut AS INTEGER) AS statut, de.do_ref AS ref_client,
    CAST(year(de.do_date) AS INTEGER) AS annee, CAST(month(de.do_date) AS INTEGER) AS mois
FROM f_docentete de LEFT JOIN f_comptet ct ON de.do_tiers = ct.ct_num
WHERE de.do_type IN (1, 2, 3, 6, 7)
""")
def document_list(t, as_of: str) -> DataFrame:
    """P5: commercial documents of types 1, 2, 3, 6, 7; the delivery date
    only where the ERP version has the column."""
    de = t.f_docentete.filter(F.col("do_type").isin(1, 2, 3, 6, 7))
    livr = F.col("do_datelivr") if "do_datelivr" in de.columns else F.lit(None).cast("date")
    df = de.join(t.f_comptet.select(F.col("ct_num").alias("do_tiers"), "ct_intitule"), "do_tiers", "left")
    return df.select(F.col("cbmarq").alias("watermark_sync"), F.col("do_piece").alias("num_document"),
                     F.col("do_type").cast("int").alias("type_doc"), F.col("do_date").alias("date_document"),
                     livr.alias("date_livraison"), F.col("do_tiers").alias("code_tiers"),
                     F.col("ct_intitule").alias("nom_tiers"), as_double("do_totalht").alias("montant_ht"),
                     as_double("do_totalttc").alias("montant_ttc"), as_double("do_totaltva").alias("montant_tva"),
                     F.col("do_statut").cast("int").alias("statut"), F.col("do_ref").alias("ref_client"),
                     F.year("do_date").alias("annee"), F.month("do_date").alias("mois"))


def stock_value_columns(stock: DataFrame):
    """Capability choice: stock amount column (v21+), else quantity x unit
    cost on the stock row (v15-v17), else NULL."""
    q = F.col("as_qtesto")
    if "as_montsto" in stock.columns:
        return as_double("as_montsto"), F.when(q != 0, as_double("as_montsto") / as_double(q))
    if "as_prixach" in stock.columns:
        return as_double(q * F.col("as_prixach")), as_double("as_prixach")
    return F.lit(None).cast("double"), F.lit(None).cast("double")


@register("stock_valuation", """
SELECT s.cbmarq AS watermark_sync, s.ar_ref AS ref_article, a.ar_design AS designation, a.fa_codefamille AS famille,
    s.de_no AS depot, CAST(s.as_qtesto AS DOUBLE) AS qte_stock, CAST(s.as_montsto AS DOUBLE) AS valeur_stock,
    CASE WHEN s.as_qtesto <> 0 THEN CAST(s.as_montsto AS DOUBLE) / CAST(s.as_qtesto AS DOUBLE) END AS pmp,
    CAST(s.as_qteres AS DOUBLE) AS qte_reservee, CAST(s.as_qtecom AS DOUBLE) AS qte_commandee
FROM f_artstock s LEFT JOIN f_article a ON s.ar_ref = a.ar_ref
""")
def stock_valuation(t, as_of: str) -> DataFrame:
    """Stock rows valued according to the columns available."""
    s = t.f_artstock
    valeur, pmp = stock_value_columns(s)
    df = s.join(t.f_article.select("ar_ref", "ar_design", "fa_codefamille"), "ar_ref", "left")
    return df.select(F.col("cbmarq").alias("watermark_sync"), F.col("ar_ref").alias("ref_article"),
                     F.col("ar_design").alias("designation"), F.col("fa_codefamille").alias("famille"),
                     F.col("de_no").alias("depot"), as_double("as_qtesto").alias("qte_stock"),
                     valeur.alias("valeur_stock"), pmp.alias("pmp"), as_double("as_qteres").alias("qte_reservee"),
                     as_double("as_qtecom").alias("qte_commandee"))


@register("asset_list", """
SELECT cbmarq AS watermark_sync, im_code AS ref_immo, im_intitule AS designation, fa_codefamille AS famille,
    CAST(im_valacq AS DOUBLE) AS valeur_acquisition, im_dateacq AS date_acquisition,
    im_dateserv AS date_mise_en_service, CAST(im_nbannee01 * 12 + im_nbmois01 AS INTEGER) AS duree_amort_mois,
    CAST(im_valacq - im_doteco AS DOUBLE) AS vnc, CAST(im_doteco AS DOUBLE) AS cumul_amortissements,
    CAST(im_etat AS INTEGER) AS etat
FROM f_immobilisation
""")
def asset_list(t, as_of: str) -> DataFrame:
    """Fixed assets; acquisition value from IM_ValAcq (v21+), else
    IM_ValOrigine (v15-v17), else NULL."""
    im = t.f_immobilisation
    if "im_valacq" in im.columns:
        va = F.col("im_valacq")
    elif "im_valorigine" in im.columns:
        va = F.col("im_valorigine")
    else:
        va = F.lit(None).cast("decimal(13,2)")
    return im.select(F.col("cbmarq").alias("watermark_sync"), F.col("im_code").alias("ref_immo"),
                     F.col("im_intitule").alias("designation"), F.col("fa_codefamille").alias("famille"),
                     as_double(va).alias("valeur_acquisition"), F.col("im_dateacq").alias("date_acquisition"),
                     F.col("im_dateserv").alias("date_mise_en_service"),
                     (F.col("im_nbannee01") * 12 + F.col("im_nbmois01")).cast("int").alias("duree_amort_mois"),
                     as_double(va - F.col("im_doteco")).alias("vnc"), as_double("im_doteco").alias("cumul_amortissements"),
                     F.col("im_etat").cast("int").alias("etat"))

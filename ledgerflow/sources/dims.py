"""Reference dimensions: account-root mapping (D1) and day calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import us_week

# Fixed values (must equal the reference's classification of the French chart
# of accounts): compte_debut, compte_fin, type_classe, categorie_bi,
# sous_categorie, kpi_tags.  The id is the 1-based position in this list.
ACCOUNT_MAPPING = [
    ("10", "109999", "CAPITAUX", "CAPITAL", "Capital social", "equity,structure_financiere"),
    ("11", "119999", "CAPITAUX", "RESERVES", "Reserves", "equity"),
    ("12", "129999", "CAPITAUX", "RESULTAT", "Resultat exercice", "resultat"),
    ("13", "139999", "CAPITAUX", "SUBVENTIONS_INVEST", "Subventions investissement", "financement"),
    ("14", "149999", "CAPITAUX", "PROVISIONS_REGLEMENTEES", "Provisions reglementees", "provisions"),
    ("16", "169999", "CAPITAUX", "EMPRUNTS", "Emprunts et dettes financieres", "endettement,tresorerie"),
    ("20", "209999", "IMMOBILISATIONS", "IMMOBILISATIONS_INCORP", "Immobilisations incorporelles", "investissement"),
    ("21", "219999", "IMMOBILISATIONS", "IMMOBILISATIONS_CORP", "Immobilisations corporelles", "investissement"),
    ("22", "229999", "IMMOBILISATIONS", "IMMOBILISATIONS_MISE_EN_CONCESSION", "Immobilisations concession",
     "investissement"),
    ("23", "239999", "IMMOBILISATIONS", "IMMOBILISATIONS_EN_COURS", "Immobilisations en cours", "investissement"),
    ("27", "279999", "IMMOBILISATIONS", "IMMOBILISATIONS_FINANCIERES", "Immobilisations financieres", "placement"),
    ("28", "289999", "IMMOBILISATIONS", "AMORTISSEMENTS", "Amortissements immobilisations", "amortissement,actifs"),
    ("29", "299999", "IMMOBILISATIONS", "DEPRECIATIONS_IMMO", "Depreciations immobilisations", "provisions"),
    ("31", "319999", "STOCKS", "STOCK_MP", "Stocks matieres premieres", "stock"),
    ("32", "329999", "STOCKS", "STOCK_AUTRES_APPRO", "Stocks autres approvisionnements", "stock"),
    ("33", "339999", "STOCKS", "STOCK_ENCOURS", "Stocks en cours production", "production"),
    ("34", "349999", "STOCKS", "STOCK_PRODUITS_INTER", "Stocks produits intermediaires", "production"),
    ("35", "359999", "STOCKS", "STOCK_PRODUITS_FINIS", "Stocks produits finis", "stock"),
    ("37", "379999", "STOCKS", "STOCK_MARCHANDISES", "Stocks marchandises", "stock"),
    ("39", "399999", "STOCKS", "DEPRECIATION_STOCK", "Depreciation stocks", "provisions"),
    ("40", "409999", "COMPTES_TIERS", "FOURNISSEURS", "Dettes fournisseurs", "dettes"),
    ("41", "419999", "COMPTES_TIERS", "CLIENTS", "Creances clients", "recouvrement,ca"),
    ("42", "429999", "COMPTES_TIERS", "PERSONNEL", "Dettes personnel", "rh,paie"),
    ("43", "439999", "COMPTES_TIERS", "ORGANISMES_SOCIAUX", "Charges sociales", "rh"),
    ("44", "449999", "COMPTES_TIERS", "ETAT_IMPOTS", "Etat et impots", "fiscalite"),
    ("45", "459999", "COMPTES_TIERS", "GROUPE_ASSOCIES", "Groupe et associes", "holding"),
    ("46", "469999", "COMPTES_TIERS", "DEBITEURS_CREDITEURS", "Debiteurs crediteurs divers", "divers"),
    ("48", "489999", "COMPTES_TIERS", "COMPTES_REGULARISATION", "Comptes regularisation", "comptabilite"),
    ("49", "499999", "COMPTES_TIERS", "DEPRECIATION_TIERS", "Depreciation comptes tiers", "risque"),
    ("50", "509999", "TRESORERIE", "VALEURS_MOBILIERE", "Valeurs mobilieres placement", "placement"),
    ("51", "519999", "TRESORERIE", "BANQUES", "Banques", "tresorerie"),
    ("53", "539999", "TRESORERIE", "CAISSE", "Caisse", "tresorerie"),
    ("58", "589999", "TRESORERIE", "VIREMENTS_INTERNES", "Virements internes", "tresorerie"),
    ("60", "609999", "CHARGES", "ACHATS", "Achats marchandises et matieres", "marge,stock"),
    ("61", "619999", "CHARGES", "SERVICES_EXTERNES", "Services exterieurs", "charges"),
    ("62", "629999", "CHARGES", "AUTRES_SERVICES_EXTERNES", "Autres services exterieurs", "charges"),
    ("63", "639999", "CHARGES", "IMPOTS_TAXES", "Impots et taxes", "fiscalite"),
    ("64", "649999", "CHARGES", "CHARGES_PERSONNEL", "Charges personnel", "masse_salariale,rh"),
    ("65", "659999", "CHARGES", "AUTRES_CHARGES", "Autres charges gestion", "charges"),
    ("66", "669999", "CHARGES", "CHARGES_FINANCIERES", "Charges financieres", "finance,endettement"),
    ("67", "679999", "CHARGES", "CHARGES_EXCEPTIONNELLES", "Charges exceptionnelles", "risque"),
    ("68", "689999", "CHARGES", "DOTATIONS_AMORT", "Dotations amortissements", "investissement"),
    ("69", "699999", "CHARGES", "IMPOT_BENEFICE", "Impots sur benefices", "fiscalite"),
    ("70", "709999", "PRODUITS", "CHIFFRE_AFFAIRES", "Ventes produits services", "ca,revenus"),
    ("71", "719999", "PRODUITS", "PRODUCTION_STOCKEE", "Production stockee", "production"),
    ("72", "729999", "PRODUITS", "PRODUCTION_IMMOBILISEE", "Production immobilisee", "immobilisation"),
    ("74", "749999", "PRODUITS", "SUBVENTIONS_EXPLOIT", "Subventions exploitation", "financement"),
    ("75", "759999", "PRODUITS", "AUTRES_PRODUITS", "Autres produits gestion", "revenus"),
    ("76", "769999", "PRODUITS", "PRODUITS_FINANCIERS", "Produits financiers", "placement"),
    ("77", "779999", "PRODUITS", "PRODUITS_EXCEPTIONNELS", "Produits exceptionnels", "risque"),
    ("78", "789999", "PRODUITS", "REPRISES_PROVISIONS", "Reprises amortissements provisions", "provisions"),
    ("79", "799999", "PRODUITS", "TRANSFERT_CHARGES", "Transfert de charges", "comptabilite"),
]

MAPPING_COLUMNS = ["id", "compte_debut", "compte_fin", "type_classe", "categorie_bi", "sous_categorie", "kpi_tags"]
CALENDAR_COLUMNS = ["dt_jour", "annee", "semestre", "trimestre", "mois", "libelle_mois", "annee_mois", "semaine",
                    "annee_semaine", "libelle_semaine", "jour_mois", "jour_annee", "jour_semaine",
                    "libelle_jour_semaine", "est_weekend"]

# Production bounds of the calendar.
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2035-12-31"


def account_mapping(spark: SparkSession) -> DataFrame:
    """52 account roots with their BI classification (a literal frame)."""
    rows = [(i + 1, *r) for i, r in enumerate(ACCOUNT_MAPPING)]
    schema = ("id int, compte_debut string, compte_fin string, type_classe string, categorie_bi string, "
              "sous_categorie string, kpi_tags string")
    return spark.createDataFrame(rows, schema)


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day between ``start`` and ``end`` inclusive.

    Days come from ``spark.range`` (distributed), not from a driver list.
    Week numbers follow the US convention of the reference (week 1 holds
    1 January, weeks start on Sunday), weekdays count Sunday as 1.
    """
    n_days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    d = F.col("dt_jour")
    week = us_week(d)
    wk2 = F.lpad(week.cast("string"), 2, "0")
    return (spark.range(n_days)
            .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("dt_jour"))
            .select(
                d,
                F.year(d).alias("annee"),
                F.when(F.month(d) <= 6, 1).otherwise(2).alias("semestre"),
                F.quarter(d).alias("trimestre"),
                F.month(d).alias("mois"),
                F.date_format(d, "MMMM").alias("libelle_mois"),
                F.date_format(d, "yyyy-MM").alias("annee_mois"),
                week.alias("semaine"),
                F.concat(F.year(d).cast("string"), F.lit("-S"), wk2).alias("annee_semaine"),
                F.concat(F.lit("S"), wk2).alias("libelle_semaine"),
                F.dayofmonth(d).alias("jour_mois"),
                F.dayofyear(d).alias("jour_annee"),
                F.dayofweek(d).alias("jour_semaine"),
                F.date_format(d, "EEEE").alias("libelle_jour_semaine"),
                F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("est_weekend"),
            ))

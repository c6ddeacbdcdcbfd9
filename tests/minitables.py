"""Hand-made ERP tables, one edge per row (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from ledgerflow.sources import dims

LEDGER_SCHEMA = ("ec_no long, ec_piece string, ec_date date, cg_num string, ct_num string, jo_num string, "
                 "ec_intitule string, ec_montant decimal(13,2), ec_sens short, ec_lettrage string, "
                 "ec_refpiece string, ec_echeance date, cbcreateur string, cbcreation timestamp_ntz, "
                 "cbmodification timestamp_ntz, cbmarq long")
PARTY_SCHEMA = ("ct_num string, ct_intitule string, ct_type short, ct_adresse string, ct_codepostal string, "
                "ct_ville string, ct_pays string, ct_telephone string, ct_email string, ct_siret string, "
                "ct_sommeil short, ct_classement string, n_catcompta short, ct_encours decimal(13,2), cbmarq long, "
                "cbmodification timestamp_ntz")


def ts(d: dt.date, h: int | None):
    return None if h is None else dt.datetime(d.year, d.month, d.day, h, 0)


def ledger_row(no, date, cg, ct, amount, sens=0, lettrage=None, hour=10, piece=None, jo="VT"):
    d = dt.date.fromisoformat(date)
    return (no, piece or f"P{no}", d, cg, ct, jo, f"line {no}", D(amount), sens, lettrage, None, d, "U0",
            ts(d, hour), ts(d, None if hour is None else hour + 1), no)


class MiniTables:
    """Same attributes as ErpTables, built from literal rows."""

    def __init__(self, spark, ledger=None, parties=None, **frames):
        self.spark = spark
        self.stored_dir = None
        self.f_ecriturec = spark.createDataFrame(ledger or [], LEDGER_SCHEMA)
        self.f_comptet = spark.createDataFrame(parties or [], PARTY_SCHEMA)
        self.f_compteg = spark.createDataFrame(
            [("411000", "Clients", 0, 1, None), ("701000", "Ventes", 0, 2, None), ("512000", "Banque", 0, 3, None),
             ("401000", "Fournisseurs", 0, 4, None), ("601000", "Achats", 0, 5, None)],
            "cg_num string, cg_intitule string, cg_type short, cbmarq long, cbmodification timestamp_ntz")
        self.f_journaux = spark.createDataFrame(
            [("VT", "Ventes", 1, 1, None)],
            "jo_num string, jo_intitule string, jo_type short, cbmarq long, cbmodification timestamp_ntz")
        self.mapping = dims.account_mapping(spark)
        self.calendar = dims.calendar(spark, "2000-01-01", "2001-12-31")
        for k, v in frames.items():
            setattr(self, k, v)


def party(ct_num, name, ct_type=0):
    return (ct_num, name, ct_type, None, None, None, "FRANCE", None, None, None, 0, None, None, D("0.00"),
            1, None)

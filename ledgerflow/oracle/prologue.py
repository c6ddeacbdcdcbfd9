"""The test adapter of FIXTURES.md written as SQL CTEs for the DuckDB oracle.

Mirrors ``ledgerflow.sources.adapter`` and ``ledgerflow.sources.dims``
rule by rule; every oracle query is this prologue plus its own CTEs.
"""

from __future__ import annotations

from ..sources import adapter as A
from ..sources import dims

AS_OF = A.AS_OF


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    out = []
    for r in rows:
        vals = []
        for v in r:
            vals.append(_q(v) if isinstance(v, str) else ("NULL" if v is None else str(v)))
        out.append("(" + ", ".join(vals) + ")")
    return ",\n        ".join(out)


def _list(values) -> str:
    return "[" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values) + "]"


MAPPING_ROWS = [(i + 1, *r) for i, r in enumerate(dims.ACCOUNT_MAPPING)]

PROLOGUE = f"""
WITH
_li AS (
    SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_suppkey AS sk,
           l.l_quantity, l.l_extendedprice, l.l_shipdate, l.l_returnflag AS rf, l.l_linestatus AS ls,
           o.o_custkey AS ck, o.o_orderdate,
           row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
                              ORDER BY l.l_shipdate, l.l_extendedprice) - 1 AS dup,
           CAST(l.l_extendedprice AS DECIMAL(13,2)) AS ht,
           CAST(o.o_orderdate AS DATE) AS od,
           CAST(l.l_shipdate AS DATE) AS sd
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
_legs0 AS (
    SELECT *, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS leg FROM _li
),
_legs AS (
    SELECT *,
        CASE WHEN leg IN (0, 1, 2, 8) THEN od WHEN leg IN (3, 4, 5, 6) THEN sd
             WHEN leg = 7 THEN CAST(sd + INTERVAL 30 DAY AS DATE) END AS ec_date
    FROM _legs0
    WHERE leg IN (0, 1, 2, 4, 5) OR (leg = 3 AND rf = 'R') OR (leg = 6 AND ls = 'F')
       OR (leg = 7 AND rf = 'A') OR (leg = 8 AND pk % 211 = 0)
),
_ledger AS (
    SELECT
        CAST(((((ok * 8 + ln) * 100000 + pk) * 10000 + sk) * 4 + dup) * 16 + leg AS BIGINT) AS ec_no,
        concat({_list(A.LEG_PREFIXES)}[leg + 1], CAST(ok AS VARCHAR)) AS ec_piece,
        ec_date,
        CASE WHEN leg IN (0, 8) THEN CASE WHEN pk % 10 = 0 THEN '411100' ELSE '411000' END
             WHEN leg = 1 THEN CASE WHEN pk % 97 = 0 THEN '190000'
                                    ELSE {_list(["701000", "701100", "706000", "707000", "708500"])}[pk % 5 + 1] END
             WHEN leg = 2 THEN '445710'
             WHEN leg = 3 THEN {_list(["512000", "512100", "530000"])}[sk % 3 + 1]
             WHEN leg = 4 THEN {_list(["600000", "601000", "611000", "622600"])}[sk % 4 + 1]
             WHEN leg = 5 THEN CASE WHEN sk % 10 = 0 THEN '451000' ELSE '401000' END
             WHEN leg = 6 THEN {_list(["641000", "645000", "661000", "681000"])}[ln % 4 + 1]
             WHEN leg = 7 THEN '512000' END AS cg_num,
        CASE WHEN leg IN (0, 1, 3, 8) THEN concat('C', CAST(ck AS VARCHAR))
             WHEN leg IN (4, 5, 7) THEN concat('S', CAST(sk AS VARCHAR)) END AS ct_num,
        {_list(A.LEG_JOURNALS)}[leg + 1] AS jo_num,
        {_list(A.LEG_LABELS)}[leg + 1] AS ec_intitule,
        CASE WHEN leg = 6 AND pk % 89 = 0 THEN CAST(0.50 AS DECIMAL(13,2))
             WHEN leg = 6 AND pk % 53 = 0 THEN CAST(1000.00 AS DECIMAL(13,2))
             ELSE CAST(ht * CAST(CASE WHEN leg IN (0, 3, 8) THEN 1.20 WHEN leg = 1 THEN 1.00 WHEN leg = 2 THEN 0.20
                                      WHEN leg = 4 THEN 0.60 WHEN leg IN (5, 7) THEN 0.72 ELSE 0.05 END
                                 AS DECIMAL(3,2)) AS DECIMAL(13,2)) END AS ec_montant,
        CAST(CASE WHEN leg IN (0, 3, 4, 6, 8) THEN 0 ELSE 1 END AS SMALLINT) AS ec_sens,
        CASE WHEN (leg IN (0, 3) AND rf = 'R') OR (leg IN (5, 7) AND rf = 'A') THEN 'LT'
             WHEN ln = 7 THEN '' END AS ec_lettrage,
        CAST(NULL AS VARCHAR) AS ec_refpiece,
        CAST(ec_date + INTERVAL 30 DAY AS DATE) AS ec_echeance,
        concat('U', CAST(sk % 5 AS VARCHAR)) AS cbcreateur,
        CAST(ec_date AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(ok % 24 AS INTEGER) AS cbcreation,
        CAST(ec_date AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(ok % 24 + pk % 3 AS INTEGER) AS cbmodification,
        leg, ck, l_quantity
    FROM _legs
),
f_ecriturec AS (
    SELECT ec_no, ec_piece, ec_date, cg_num, ct_num, jo_num, ec_intitule, ec_montant, ec_sens, ec_lettrage,
           ec_refpiece, ec_echeance, cbcreateur, cbcreation, cbmodification, ec_no AS cbmarq
    FROM _ledger
),
_ea0 AS (
    SELECT g.*, n.n_regionkey, unnest([1, 2]) AS plan
    FROM _ledger g
    LEFT JOIN (SELECT c.c_custkey, na.n_regionkey FROM customer c JOIN nation na ON c.c_nationkey = na.n_nationkey) n
           ON g.ck = n.c_custkey
    WHERE g.leg IN (1, 4, 6)
),
f_ecriturea AS (
    SELECT CAST(ec_no * 2 + (plan - 1) AS BIGINT) AS ea_no, ec_no,
           CAST(plan AS SMALLINT) AS ea_ligne, CAST(plan AS SMALLINT) AS n_analytique,
           CASE WHEN plan = 1 THEN {_list(A.PLAN1_CODES)}[ck % 4 + 1]
                ELSE concat('2R', CAST(n_regionkey AS VARCHAR)) END AS ca_num,
           ec_montant AS ea_montant, CAST(l_quantity AS DECIMAL(13,3)) AS ea_quantite,
           CAST(ec_no * 2 + (plan - 1) AS BIGINT) AS cbmarq, cbmodification
    FROM _ea0
    WHERE plan = 1 OR leg = 1
),
f_comptet AS (
    SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS ct_num, c_name AS ct_intitule, CAST(0 AS SMALLINT) AS ct_type,
           CAST(NULL AS VARCHAR) AS ct_adresse, CAST(NULL AS VARCHAR) AS ct_codepostal, CAST(NULL AS VARCHAR) AS ct_ville,
           n.n_name AS ct_pays, CAST(NULL AS VARCHAR) AS ct_telephone, CAST(NULL AS VARCHAR) AS ct_email,
           CAST(NULL AS VARCHAR) AS ct_siret,
           CAST(CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS ct_sommeil,
           c_mktsegment AS ct_classement, CAST(NULL AS SMALLINT) AS n_catcompta,
           CAST(c_acctbal AS DECIMAL(13,2)) AS ct_encours, CAST(c_custkey + 1 AS BIGINT) AS cbmarq,
           TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    UNION ALL
    SELECT concat('S', CAST(s_suppkey AS VARCHAR)), s_name, CAST(1 AS SMALLINT),
           NULL, NULL, NULL, n.n_name, NULL, NULL, NULL, CAST(0 AS SMALLINT), NULL, NULL,
           CAST(s_acctbal AS DECIMAL(13,2)), CAST(s_suppkey + 1000000001 AS BIGINT), TIMESTAMP '{A.MASTER_TS}'
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
f_journaux AS (
    SELECT jo_num, jo_intitule, CAST(jo_type AS SMALLINT) AS jo_type, CAST(cbmarq AS BIGINT) AS cbmarq,
           TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM (VALUES
        {_values([(j, t, ty, i + 1) for i, (j, t, ty) in enumerate(A.JOURNALS)])}
    ) v(jo_num, jo_intitule, jo_type, cbmarq)
),
f_compteg AS (
    SELECT cg_num, cg_intitule, CAST(0 AS SMALLINT) AS cg_type, CAST(cbmarq AS BIGINT) AS cbmarq,
           TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM (VALUES
        {_values([(n, t, i + 1) for i, (n, t) in enumerate(A.ACCOUNTS)])}
    ) v(cg_num, cg_intitule, cbmarq)
),
f_depot AS (
    SELECT CAST(de_no AS INTEGER) AS de_no, de_intitule, CAST(cbmarq AS BIGINT) AS cbmarq
    FROM (VALUES {_values([(n, t, n + 1) for n, t in A.DEPOTS])}) v(de_no, de_intitule, cbmarq)
),
f_comptea AS (
    SELECT ca_num, CAST(n_analytique AS SMALLINT) AS n_analytique, ca_intitule, CAST(cbmarq AS BIGINT) AS cbmarq,
           TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM (VALUES
        {_values([(c, p, t, i + 1) for i, (c, p, t) in enumerate(A.ANALYTIC)])}
    ) v(ca_num, n_analytique, ca_intitule, cbmarq)
),
f_famille AS (
    SELECT fa_codefamille, concat('Famille ', fa_codefamille) AS fa_intitule, CAST(1 AS BIGINT) AS cbmarq,
           TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM (SELECT DISTINCT p_brand AS fa_codefamille FROM part)
),
f_article AS (
    SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS ar_ref, p_name AS ar_design, p_brand AS fa_codefamille,
           CAST(p_retailprice AS DECIMAL(13,2)) AS ar_prixven,
           CASE WHEN p_size = 1 THEN CAST(0.00 AS DECIMAL(13,2))
                ELSE CAST(CAST(p_retailprice AS DECIMAL(13,2)) * CAST(0.55 AS DECIMAL(2,2)) AS DECIMAL(13,2)) END
               AS ar_prixach,
           CASE WHEN p_size = 1 THEN NULL ELSE CAST(1.8182 AS DECIMAL(7,4)) END AS ar_coef,
           'U' AS ar_uniteven, CAST(1 AS SMALLINT) AS ar_suivistock,
           CAST(CASE WHEN p_size = 50 THEN 1 WHEN p_size = 49 THEN NULL ELSE 0 END AS SMALLINT) AS ar_sommeil,
           CAST(p_partkey + 1 AS BIGINT) AS cbmarq, TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM part
),
_stock AS (
    SELECT l_partkey AS pk, CAST(l_suppkey % 3 AS INTEGER) AS de_no,
           SUM(CASE WHEN l_returnflag IN ('N', 'R') THEN l_quantity ELSE 0.0 END)
             - SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0.0 END) AS qtesto,
           SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity ELSE 0.0 END) AS qteres,
           SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0.0 END) AS qtecom
    FROM lineitem WHERE l_partkey % 40 <> 0
    GROUP BY 1, 2
),
f_artstock AS (
    SELECT concat('P', CAST(s.pk AS VARCHAR)) AS ar_ref, s.de_no,
           CAST(s.qtesto AS DECIMAL(13,3)) AS as_qtesto,
           CAST(50.000 AS DECIMAL(13,3)) AS as_qtemini, CAST(150.000 AS DECIMAL(13,3)) AS as_qtemaxi,
           CAST(CAST(5 AS DECIMAL(1,0)) * CAST(s.qtesto AS DECIMAL(13,3)) * a.ar_prixach AS DECIMAL(13,2)) AS as_montsto,
           CAST(s.qteres AS DECIMAL(13,3)) AS as_qteres, CAST(s.qtecom AS DECIMAL(13,3)) AS as_qtecom,
           CAST(s.pk * 4 + s.de_no AS BIGINT) AS cbmarq, TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM _stock s LEFT JOIN f_article a ON concat('P', CAST(s.pk AS VARCHAR)) = a.ar_ref
),
f_docentete AS (
    SELECT concat('D', CAST(o_orderkey AS VARCHAR)) AS do_piece,
           CAST({_list(A.DOC_TYPES)}[o_orderkey % 10 + 1] AS SMALLINT) AS do_type,
           CAST(o_orderdate AS DATE) AS do_date,
           CASE WHEN {_list(A.DOC_TYPES)}[o_orderkey % 10 + 1] >= 10
                THEN concat('S', CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR))
                ELSE concat('C', CAST(o_custkey AS VARCHAR)) END AS do_tiers,
           CAST(CAST(CAST(round(o_totalprice, 2) AS DECIMAL(13,2)) * CAST(0.83 AS DECIMAL(2,2)) AS DECIMAL(13,2))
                AS DECIMAL(13,2)) AS do_totalht,
           CAST(round(o_totalprice, 2) AS DECIMAL(13,2)) AS do_totalttc,
           CAST(CAST(round(o_totalprice, 2) AS DECIMAL(13,2))
                - CAST(CAST(round(o_totalprice, 2) AS DECIMAL(13,2)) * CAST(0.83 AS DECIMAL(2,2)) AS DECIMAL(13,2))
                AS DECIMAL(13,2)) AS do_totaltva,
           CAST(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS SMALLINT) AS do_statut,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL
                ELSE CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY * CAST(o_custkey % 30 AS INTEGER) AS DATE) END
               AS do_datelivr,
           CAST(NULL AS VARCHAR) AS do_ref, CAST(NULL AS VARCHAR) AS cbcreateur,
           CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS cbcreation,
           CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER)
               AS cbmodification,
           CAST(o_orderkey + 1 AS BIGINT) AS cbmarq
    FROM orders
),
f_familleimmo AS (
    SELECT concat('F', CAST(r_regionkey AS VARCHAR)) AS fa_codefamille, concat('Immobilisations ', r_name) AS fa_intitule,
           CAST(r_regionkey + 1 AS BIGINT) AS cbmarq
    FROM region
),
_immo AS (
    SELECT s.*, n.n_regionkey,
           CASE WHEN s_suppkey % 25 = 0 THEN CAST(0.00 AS DECIMAL(13,2))
                ELSE CAST(abs(s_acctbal) AS DECIMAL(13,2)) END AS valacq,
           CAST(CASE WHEN s_suppkey % 17 = 0 THEN 0 ELSE [3, 5, 10][s_suppkey % 3 + 1] END AS SMALLINT) AS years,
           CAST(DATE '1997-01-01' + INTERVAL 1 DAY * CAST((s_suppkey * 37) % 1500 AS INTEGER) AS DATE) AS acq
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
f_immobilisation AS (
    SELECT concat('I', CAST(s_suppkey AS VARCHAR)) AS im_code, concat('Equipement ', s_name) AS im_intitule,
           CAST(NULL AS VARCHAR) AS im_complement, concat('F', CAST(n_regionkey AS VARCHAR)) AS fa_codefamille,
           concat('S', CAST(s_suppkey AS VARCHAR)) AS ct_num, '218300' AS cg_num,
           acq AS im_dateacq, CAST(acq + INTERVAL 15 DAY AS DATE) AS im_dateserv,
           valacq AS im_valacq,
           CAST(valacq * CAST(0.4 AS DECIMAL(1,1)) AS DECIMAL(13,2)) AS im_doteco,
           CAST(valacq * CAST(0.4 AS DECIMAL(1,1)) AS DECIMAL(13,2)) AS im_dotfiscal,
           CAST(s_suppkey % 4 AS SMALLINT) AS im_modeamort01, years AS im_nbannee01,
           CAST(s_suppkey % 12 AS SMALLINT) AS im_nbmois01, CAST(s_suppkey % 4 AS SMALLINT) AS im_etat,
           CAST(1.000 AS DECIMAL(13,3)) AS im_quantite, CAST(NULL AS VARCHAR) AS im_observation,
           CAST(s_suppkey + 1 AS BIGINT) AS cbmarq, TIMESTAMP '{A.MASTER_TS}' AS cbmodification
    FROM _immo
),
f_immoamort AS (
    SELECT concat('I', CAST(s_suppkey AS VARCHAR)) AS im_code, CAST(y AS SMALLINT) AS ia_annee,
           CAST(0 AS SMALLINT) AS ia_typeamo,
           CASE WHEN years = 3 THEN CAST(33.3333 AS DECIMAL(7,4)) WHEN years = 5 THEN CAST(20.0000 AS DECIMAL(7,4))
                WHEN years = 10 THEN CAST(10.0000 AS DECIMAL(7,4)) ELSE CAST(0.0000 AS DECIMAL(7,4)) END AS ia_taux,
           CAST(s_suppkey * 10 + y - 1999 AS BIGINT) AS cbmarq
    FROM (SELECT *, unnest([1999, 2000, 2001]) AS y FROM _immo WHERE s_suppkey % 2 = 0)
),
mapping AS (
    SELECT * FROM (VALUES
        {_values(MAPPING_ROWS)}
    ) v(id, compte_debut, compte_fin, type_classe, categorie_bi, sous_categorie, kpi_tags)
),
calendar AS (
    SELECT
        d AS dt_jour,
        CAST(year(d) AS INTEGER) AS annee,
        CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre,
        CAST(quarter(d) AS INTEGER) AS trimestre,
        CAST(month(d) AS INTEGER) AS mois,
        strftime(d, '%B') AS libelle_mois,
        strftime(d, '%Y-%m') AS annee_mois,
        CAST(floor((dayofyear(d) + dayofweek(date_trunc('year', d)) + 1 - 2) / 7) + 1 AS INTEGER) AS semaine,
        concat(CAST(year(d) AS VARCHAR), '-S',
               lpad(CAST(CAST(floor((dayofyear(d) + dayofweek(date_trunc('year', d)) + 1 - 2) / 7) + 1 AS INTEGER)
                    AS VARCHAR), 2, '0')) AS annee_semaine,
        concat('S', lpad(CAST(CAST(floor((dayofyear(d) + dayofweek(date_trunc('year', d)) + 1 - 2) / 7) + 1
                    AS INTEGER) AS VARCHAR), 2, '0')) AS libelle_semaine,
        CAST(day(d) AS INTEGER) AS jour_mois,
        CAST(dayofyear(d) AS INTEGER) AS jour_annee,
        CAST(dayofweek(d) + 1 AS INTEGER) AS jour_semaine,
        strftime(d, '%A') AS libelle_jour_semaine,
        CASE WHEN dayofweek(d) + 1 IN (1, 7) THEN 1 ELSE 0 END AS est_weekend
    FROM (SELECT CAST(unnest(generate_series(DATE '{A.TEST_CAL_START}', DATE '{A.TEST_CAL_END}', INTERVAL 1 DAY))
                 AS DATE) AS d)
),
-- every ledger row with what the oracles measure: both signs, the account's
-- roots, its mapping row, age at the reference date, year and month
led AS (
    SELECT e.*, e.ec_montant * (2 * (e.ec_sens = 0)::INT - 1) AS db, e.ec_montant * (2 * (e.ec_sens = 1)::INT - 1) AS cr,
           e.cg_num[1:1] AS r1, e.cg_num[1:2] AS r2, e.cg_num[1:3] AS r3, DATE '{A.AS_OF}' - e.ec_date AS age,
           year(e.ec_date)::INT AS y, month(e.ec_date)::INT AS mo, trim(coalesce(e.ec_lettrage, '')) = '' AS open_item,
           m AS map_row
    FROM f_ecriturec e LEFT JOIN mapping m ON TRY_CAST(e.cg_num[1:2] AS INT) = TRY_CAST(m.compte_debut AS INT)
),
party AS (SELECT ct_num, ct_intitule AS party_name, f_comptet AS ct FROM f_comptet)"""


def with_prologue(sql: str) -> str:
    """Prefix a query with the adapter CTEs (merging a leading WITH)."""
    body = sql.strip().rstrip(";")
    if body[:4].upper() == "WITH":
        return PROLOGUE + ",\n" + body[4:]
    return PROLOGUE + "\n" + body


def rnd(expr: str, n: int = 2) -> str:
    """ROUND(x, n) in the oracle with decimal half-up semantics on the
    shortest decimal form of a double (what Spark's round does)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"

"""Driver test tables (TPC-H-like parquet) -> ERP tables of the ledger model.

The ERP tables are derived lazily as DataFrames; nothing is collected.  The
rules are the ones written down in FIXTURES.md section 3 and are mirrored in
SQL by ``ledgerflow.oracle.prologue`` so both engines see the same input.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dims


def dec(v: str, p: int = 13, s: int = 2) -> Column:
    return F.lit(Decimal(v)).cast(f"decimal({p},{s})")


def pick(idx: Column, values: list) -> Column:
    """values[idx] for a small literal list (0-based)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def by_leg(leg: Column, mapping: dict, default=None) -> Column:
    expr = None
    for legs, value in mapping.items():
        legs = legs if isinstance(legs, tuple) else (legs,)
        v = value if isinstance(value, Column) else F.lit(value)
        cond = leg.isin(*legs)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


# Fixed values of the test adapter (FIXTURES.md 3.1 / 3.2).
JOURNALS = [
    ("JV", "Registre ventes", 1), ("JB", "Registre comptes bancaires", 2), ("JA", "Registre fournisseurs", 0), ("JD", "Registre divers", 3),
]
# account numbers the leg rules use; the label is made from the number
ACCOUNT_NUMBERS = ["401000", "411000", "411100", "445710", "451000", "512000", "512100", "530000", "600000", "601000", "611000",
                   "622600", "641000", "645000", "661000", "681000", "701000", "701100", "706000", "707000", "708500"]
ACCOUNTS = [(n, f"Compte {n[:3]}.{n[3:]}") for n in ACCOUNT_NUMBERS]
DEPOTS = [(0, "Site A"), (1, "Site B")]
PLAN1_CODES = ["1NORD", "1SUD", "1EST", "1OUEST"]
# one code stands under both plans on purpose
ANALYTIC = ([(c, 1, f"Zone {c[1:].lower()}") for c in PLAN1_CODES] + [(f"2R{i}", 2, f"Region {i}") for i in range(5)]
            + [(PLAN1_CODES[0], 2, "Zone nord (second plan)")])
DOC_TYPES = [0, 1, 3, 5, 6, 7, 11, 13, 16, 20]
# accounts of every leg
LEG_ACCOUNTS = {0: ["411000", "411100"], 1: ["701000", "701100", "706000", "707000", "708500", "190000"], 2: ["445710"],
                3: ["512000", "512100", "530000"], 4: ["600000", "601000", "611000", "622600"], 5: ["401000", "451000"],
                6: ["641000", "645000", "661000", "681000"], 7: ["512000"], 8: ["411000", "411100"]}
LEG_LABELS = ["Piece client", "Produit", "Taxe", "Paiement recu", "Approvisionnement",
              "Piece fournisseur", "Frais", "Paiement emis", "Piece client bis"]
LEG_JOURNALS = ["JV", "JV", "JV", "JB", "JA", "JA", "JD", "JB", "JV"]
LEG_PREFIXES = ["PV", "PV", "PV", "PB", "PA", "PA", "PD", "PB", "PV"]
MASTER_TS = "2001-06-30 00:00:00"


class erp_table:
    """Like cached_property, but returns the stored copy of the table when
    the tables were materialised (``ErpTables.materialize``)."""

    def __init__(self, fn):
        self.fn = fn
        self.name = fn.__name__
        self.__doc__ = fn.__doc__

    def __get__(self, obj, owner=None):
        if obj is None:
            return self
        cache = obj.__dict__.setdefault("_frames", {})
        if self.name not in cache:
            if obj.stored_dir:
                cache[self.name] = obj.spark.read.parquet(f"{obj.stored_dir}/{self.name}")
            else:
                cache[self.name] = self.fn(obj)
        return cache[self.name]


ERP_TABLES = ["f_ecriturec", "f_ecriturea", "f_comptet", "f_journaux", "f_compteg", "f_depot", "f_comptea",
              "f_famille", "f_article", "f_artstock", "f_docentete", "f_familleimmo", "f_immobilisation",
              "f_immoamort"]


class DriverTables:
    """Lazy access to the driver's parquet files in one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


#: Place of a ledger row: its party (a filler without one) and a slice that follows from its piece.
PARTY_PLACE = ("__party", "__slice")
PARTY_SLICES = 16


def placed_by_party(ledger: DataFrame) -> DataFrame:
    """``ledger`` with its ``PARTY_PLACE``; equal pieces of a party have one place."""
    around = F.concat(F.lit("\x00"), F.pmod(F.xxhash64("ec_no"), F.lit(4096)).cast("string"))
    piece = F.coalesce(F.col("ec_piece"), F.col("ec_no").cast("string"))
    return ledger.withColumns({"__party": F.coalesce(F.col("ct_num"), around),
                               "__slice": F.pmod(F.xxhash64(piece), F.lit(PARTY_SLICES)).cast("int")})


# Entry numbers.  The formula of FIXTURES.md needs more than 64 bits from about order 18 million on.  Entries whose number
# by it does not fit are numbered by order, line's place in its order and leg; such a number has 9 to 13 in its last
# four bits, where the formula's have the leg (0 to 8), so that it is none of those.
#: First order whose entries all have such a number, with parts that are not negative.
FIRST_WIDE_ORDER = -(-2**59 // (8 * 100_000 * 10_000 * 4))
#: Lines of one order that can be told apart there.
WIDE_LINES = 1 << 24


def wide_line_number(ok: Column, ln: Column, pk: Column, sk: Column, place: Column) -> Column:
    """What ``entry_number`` adds a leg to, by the line's ``place`` in its order; twice that is in 64 bits for orders below 2^33."""
    told = F.when(place < WIDE_LINES, place).otherwise(F.raise_error(F.lit("an order has too many lines")))
    return F.when(ln.isNotNull() & pk.isNotNull() & sk.isNotNull(), (ok.cast("long") * WIDE_LINES + told) * 32 + 9)


def line_number(ok: Column, ln: Column, pk: Column, sk: Column, dup: Column, wide: Column) -> Column:
    """16 times the line's number by the formula, or ``wide`` if that is beyond 64 bits."""
    own = F.try_multiply(ok.cast("long"), F.lit(8))
    for part, factor in ((ln, 100000), (pk, 10000), (sk, 4), (dup, 16)):
        own = F.try_multiply(F.try_add(own, part.cast("long")), F.lit(factor))
    # known to be beyond without the attempt, which costs an exception a row
    surely = (ok >= FIRST_WIDE_ORDER) & (ln >= 0) & (pk >= 0) & (sk >= 0)
    return F.when(surely, wide).otherwise(F.coalesce(own, wide))


def entry_number(line: Column, leg: Column) -> Column:
    beyond = line.bitwiseAND(F.lit(15)) != 0
    return line + leg + F.when(beyond & (leg >= 5), 11).otherwise(0)


#: Place of a ledger row by its piece: the order that the piece is made from, or the piece itself.
PIECE_PLACE = "__piece_place"


def placed_by_piece(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn(PIECE_PLACE, F.col("ec_piece"))


class ErpTables:
    """The ERP tables of the model, derived from the driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored_dir: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stored_dir = stored_dir
        self.src = DriverTables(spark, sf_dir)
        self._of_class: dict[str, DataFrame] = {}

    def materialize(self, path: str) -> "ErpTables":
        """Write every ERP table once as Parquet under ``path`` and return
        tables reading those files (what a production source looks like).
        The ledger is clustered by account inside its files so that account
        prefix filters can skip row groups."""
        for name in ERP_TABLES:
            df = getattr(self, name)
            if name == "f_ecriturec":
                df = df.sortWithinPartitions("cg_num", "ec_date")
            df.write.mode("overwrite").option("maxRecordsPerFile", 500_000).parquet(f"{path}/{name}")
        return ErpTables(self.spark, self.sf_dir, stored_dir=path)

    # ------------------------------------------------------------------ ledger
    @erp_table
    def f_ecriturec(self) -> DataFrame:
        return self._ledger_legs().select(*LEDGER_COLUMNS)

    @cached_property
    def ledger_by_party(self) -> DataFrame:
        """The rows of ``f_ecriturec`` with their place (``PARTY_PLACE``): rows of one party and piece lie in one
        partition, a party's pieces in ``PARTY_SLICES`` ones.  A row without a party lies anywhere.

        A derived ledger is dealt out while it still has a row per order line, a stored one by its own columns."""
        if self.stored_dir:
            return placed_by_party(self.f_ecriturec)
        lines = self._ledger_lines()
        customers, suppliers = F.array(*[F.lit(i) for i in (0, 1, 2, 3, 6, 8)]), F.array(*[F.lit(i) for i in (4, 5, 7)])
        sides = lines.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        place = F.when(F.col("side") == 0, F.concat(F.lit("C"), F.col("ck").cast("string"))).otherwise(
            F.concat(F.lit("S"), F.col("sk").cast("string")))
        around = F.concat(F.lit("\x00"), F.pmod(F.xxhash64("ok", "ln", "pk"), F.lit(4096)).cast("string"))
        dealt = sides.withColumns({"__party": F.coalesce(place, around), "__slice": F.pmod(F.xxhash64("ok"), F.lit(PARTY_SLICES)).cast("int")})
        dealt = dealt.repartition(*PARTY_PLACE)
        legs = dealt.withColumn("leg", F.explode(F.when(F.col("side") == 0, customers).otherwise(suppliers)))
        return self._leg_rows(legs, PARTY_PLACE).select(*LEDGER_COLUMNS, *PARTY_PLACE)

    @cached_property
    def ledger_by_piece(self) -> DataFrame:
        """The rows of ``f_ecriturec`` with ``PIECE_PLACE``.  A derived piece is its journal's prefix and its order, by which
        lines and orders were joined: its entries lie together already."""
        if self.stored_dir:
            return placed_by_piece(self.f_ecriturec)
        return self._ledger_legs(("ok",)).select(*LEDGER_COLUMNS, F.col("ok").alias(PIECE_PLACE))

    def ledger_by_cursor(self, parts: int) -> DataFrame:
        """The rows of ``f_ecriturec`` in ``parts`` ranges of their number, nearly in order inside each.

        A derived ledger is dealt out and sorted while it still has a row per order line: the numbers of a line's entries
        are side by side, and lie between two multiples of 32 that no other number's block crosses."""
        if self.stored_dir:
            return self.f_ecriturec.repartitionByRange(parts, "cbmarq").sortWithinPartitions("cbmarq")
        lines = self._ledger_lines().repartitionByRange(parts, F.shiftright("line_no", 5)).sortWithinPartitions("line_no")
        legs = lines.withColumn("leg", F.explode(F.array(*[F.lit(i) for i in range(9)])))
        return self._leg_rows(legs).select(*LEDGER_COLUMNS)

    def ledger_with(self, prefix: str) -> DataFrame:
        """Rows of ``f_ecriturec``, at least all those of accounts that begin with ``prefix``: of a derived ledger only
        legs that can have one are made.  Kept by prefix, so that building a view again reads no file footers."""
        if self.stored_dir:
            return self.f_ecriturec
        if prefix in self._of_class:
            return self._of_class[prefix]
        legs = tuple(leg for leg, accounts in LEG_ACCOUNTS.items() if any(a.startswith(prefix) for a in accounts))
        self._of_class[prefix] = self._ledger_legs(legs=legs).select(*LEDGER_COLUMNS)
        return self._of_class[prefix]

    def _ledger_legs(self, keep: tuple[str, ...] = (), legs: tuple[int, ...] = tuple(range(9))) -> DataFrame:
        lines = self._ledger_lines()
        each = F.explode(F.array(*[F.lit(i) for i in legs]).cast("array<int>"))
        return self._leg_rows(lines.withColumn("leg", each), keep, legs)

    def _ledger_lines(self, per_customer: DataFrame | None = None) -> DataFrame:
        """Order lines with their order, one row each; ``per_customer`` has columns to add by ``ck`` (unique there)."""
        li = self.src.lineitem.select(
            F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
            F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
            "l_quantity", "l_extendedprice", "l_shipdate",
            F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"))
        od = self.src.orders.select(F.col("o_orderkey").alias("ok"),
                                    F.col("o_custkey").alias("ck"), "o_orderdate")
        if per_customer is not None:
            od = od.join(per_customer, "ck", "left")
        # Inner join on the order key; the window below is clustered by a
        # superset of the join key, so it reuses the join's partitioning.
        from pyspark.sql import Window
        w = Window.partitionBy("ok", "ln", "pk", "sk").orderBy("l_shipdate", "l_extendedprice")
        in_order = Window.partitionBy("ok").orderBy("ln", "pk", "sk", "l_shipdate", "l_extendedprice")
        parts = [F.col(c) for c in ("ok", "ln", "pk", "sk")]
        return (li.join(od, "ok")
                .withColumn("dup", F.row_number().over(w) - 1)
                .withColumn("wide_no", wide_line_number(*parts, F.row_number().over(in_order) - 1))
                .withColumn("line_no", line_number(*parts, F.col("dup"), F.col("wide_no")))
                .withColumn("ht", F.col("l_extendedprice").cast("decimal(13,2)"))
                .withColumn("od", F.col("o_orderdate").cast("date"))
                .withColumn("sd", F.col("l_shipdate").cast("date")))

    def _leg_rows(self, lines: DataFrame, keep: tuple[str, ...] = (), made: tuple[int, ...] = tuple(range(9))) -> DataFrame:
        """Ledger rows of lines with a ``leg`` each, one of ``made``; legs that a line does not have are left out."""
        leg = F.col("leg")

        def by_leg_made(mapping: dict) -> Column:
            """``by_leg`` without the cases of other legs (a short expression is compiled, a long one interpreted)."""
            wanted = {legs: v for legs, v in mapping.items() if set(legs if isinstance(legs, tuple) else (legs,)) & set(made)}
            return by_leg(leg, wanted or mapping)

        ok, ln, pk, sk, ck = (F.col(c) for c in ("ok", "ln", "pk", "sk", "ck"))
        rf, ls = F.col("rf"), F.col("ls")
        emitted = (leg.isin(0, 1, 2, 4, 5) | ((leg == 3) & (rf == "R")) | ((leg == 6) & (ls == "F"))
                   | ((leg == 7) & (rf == "A")) | ((leg == 8) & (pk % 211 == 0)))
        legs = lines.filter(emitted)
        a = LEG_ACCOUNTS
        cg = by_leg_made({
            (0, 8): F.when(pk % 10 == 0, a[0][1]).otherwise(a[0][0]),
            1: F.when(pk % 97 == 0, a[1][5]).otherwise(pick(pk % 5, a[1][:5])),
            2: a[2][0],
            3: pick(sk % 3, a[3]),
            4: pick(sk % 4, a[4]),
            5: F.when(sk % 10 == 0, a[5][1]).otherwise(a[5][0]),
            6: pick(ln % 4, a[6]),
            7: a[7][0],
        })
        factor = by_leg_made({(0, 3, 8): dec("1.20", 3, 2), 1: dec("1.00", 3, 2), 2: dec("0.20", 3, 2),
                              4: dec("0.60", 3, 2), (5, 7): dec("0.72", 3, 2), 6: dec("0.05", 3, 2)})
        amount = (F.col("ht") * factor).cast("decimal(13,2)")
        if 6 in made:
            amount = (F.when((leg == 6) & (pk % 89 == 0), dec("0.50"))
                      .when((leg == 6) & (pk % 53 == 0), dec("1000.00")).otherwise(amount))
        ec_date = by_leg_made({(0, 1, 2, 8): F.col("od"), (3, 4, 5, 6): F.col("sd"),
                               7: F.date_add(F.col("sd"), 30)})
        cust = F.concat(F.lit("C"), ck.cast("string"))
        supp = F.concat(F.lit("S"), sk.cast("string"))
        ct_num = by_leg_made({(0, 1, 3, 8): cust, (4, 5, 7): supp})
        jo = pick(leg, LEG_JOURNALS)
        prefix = pick(leg, LEG_PREFIXES)
        sens = F.when(leg.isin(0, 3, 4, 6, 8), F.lit(0)).otherwise(F.lit(1)).cast("short")
        lettrage = (F.when((leg.isin(0, 3) & (rf == "R")) | (leg.isin(5, 7) & (rf == "A")), F.lit("LT"))
                    .when(ln == 7, F.lit("")))
        ec_no = entry_number(F.col("line_no"), leg).cast("long")
        hours = (ok % 24).cast("int")
        out = legs.select(
            ec_no.alias("ec_no"),
            F.concat(prefix, ok.cast("string")).alias("ec_piece"),
            ec_date.alias("ec_date"),
            cg.alias("cg_num"),
            ct_num.alias("ct_num"),
            jo.alias("jo_num"),
            pick(leg, LEG_LABELS).alias("ec_intitule"),
            amount.alias("ec_montant"),
            sens.alias("ec_sens"),
            lettrage.alias("ec_lettrage"),
            F.lit(None).cast("string").alias("ec_refpiece"),
            F.date_add(ec_date, 30).alias("ec_echeance"),
            F.concat(F.lit("U"), (sk % 5).cast("string")).alias("cbcreateur"),
            ec_date.alias("_d"),
            hours.alias("_h"), (pk % 3).cast("int").alias("_p3"),
            # adapter extras used by the analytic table
            "leg", "ck", "l_quantity", *keep,
        )
        out = (out.withColumn("cbcreation", F.expr("timestampadd(HOUR, _h, cast(_d as timestamp_ntz))"))
               .withColumn("cbmodification", F.expr("timestampadd(HOUR, _h + _p3, cast(_d as timestamp_ntz))"))
               .withColumn("cbmarq", F.col("ec_no")))
        return out

    # --------------------------------------------------------------- analytic
    @erp_table
    def f_ecriturea(self) -> DataFrame:
        cust = self.src.customer.select(F.col("c_custkey").alias("ck"), "c_nationkey")
        nat = self.src.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        # regions meet the orders, which are fewer than their ledger rows: a list per customer, so
        # that an order stays one row while lines are numbered
        regions = cust.join(nat, "c_nationkey").groupBy("ck").agg(F.collect_list(F.struct("n_regionkey")).alias("regions"))
        lines = self._ledger_lines(regions)
        legs = self._leg_rows(lines.withColumn("leg", F.explode(F.array(*[F.lit(i) for i in (1, 4, 6)]))), ("regions", "wide_no"))
        with_region = legs.withColumn("__region", F.explode_outer("regions")).withColumn("n_regionkey", F.col("__region.n_regionkey"))
        plans = F.explode(F.array(F.lit(1), F.lit(2)))
        rows = (with_region.withColumn("plan", plans)
                .filter((F.col("plan") == 1) | (F.col("leg") == 1)))
        ca_num = F.when(F.col("plan") == 1, pick(F.col("ck") % 4, PLAN1_CODES)).otherwise(
            F.concat(F.lit("2R"), F.col("n_regionkey").cast("string")))
        # twice a number by the formula is beyond 64 bits from half as many orders on
        entry = F.when(F.col("ec_no") < 1 << 62, F.col("ec_no")).otherwise(entry_number(F.col("wide_no"), F.col("leg")))
        cbmarq = (entry * 2 + (F.col("plan") - 1)).cast("long")
        return rows.select(
            cbmarq.alias("ea_no"),
            F.col("ec_no"),
            F.col("plan").cast("short").alias("ea_ligne"),
            F.col("plan").cast("short").alias("n_analytique"),
            ca_num.alias("ca_num"),
            F.col("ec_montant").alias("ea_montant"),
            F.col("l_quantity").cast("decimal(13,3)").alias("ea_quantite"),
            cbmarq.alias("cbmarq"),
            F.col("cbmodification"),
        )

    # ---------------------------------------------------------------- parties
    @erp_table
    def f_comptet(self) -> DataFrame:
        nat = self.src.nation.select("n_nationkey", "n_name")
        c = self.src.customer.join(nat, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        clients = c.select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ct_num"),
            F.col("c_name").alias("ct_intitule"),
            F.lit(0).cast("short").alias("ct_type"),
            F.col("n_name").alias("ct_pays"),
            F.col("c_mktsegment").alias("ct_classement"),
            F.when(F.col("c_custkey") % 20 == 0, 1).otherwise(0).cast("short").alias("ct_sommeil"),
            F.col("c_acctbal").cast("decimal(13,2)").alias("ct_encours"),
            (F.col("c_custkey") + 1).cast("long").alias("cbmarq"),
        )
        s = self.src.supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        suppliers = s.select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ct_num"),
            F.col("s_name").alias("ct_intitule"),
            F.lit(1).cast("short").alias("ct_type"),
            F.col("n_name").alias("ct_pays"),
            F.lit(None).cast("string").alias("ct_classement"),
            F.lit(0).cast("short").alias("ct_sommeil"),
            F.col("s_acctbal").cast("decimal(13,2)").alias("ct_encours"),
            (F.col("s_suppkey") + 1000000001).cast("long").alias("cbmarq"),
        )
        parties = clients.unionByName(suppliers)
        return parties.select(
            "ct_num", "ct_intitule", "ct_type",
            F.lit(None).cast("string").alias("ct_adresse"),
            F.lit(None).cast("string").alias("ct_codepostal"),
            F.lit(None).cast("string").alias("ct_ville"),
            "ct_pays",
            F.lit(None).cast("string").alias("ct_telephone"),
            F.lit(None).cast("string").alias("ct_email"),
            F.lit(None).cast("string").alias("ct_siret"),
            "ct_sommeil", "ct_classement",
            F.lit(None).cast("short").alias("n_catcompta"),
            "ct_encours", "cbmarq",
            F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification"),
        )

    # ------------------------------------------------------- literal tables
    @erp_table
    def f_journaux(self) -> DataFrame:
        rows = [(j, t, ty, i + 1) for i, (j, t, ty) in enumerate(JOURNALS)]
        return (self.spark.createDataFrame(rows, "jo_num string, jo_intitule string, jo_type int, cbmarq long")
                .select("jo_num", "jo_intitule", F.col("jo_type").cast("short").alias("jo_type"), "cbmarq",
                        F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification")))

    @erp_table
    def f_compteg(self) -> DataFrame:
        rows = [(n, t, i + 1) for i, (n, t) in enumerate(ACCOUNTS)]
        return (self.spark.createDataFrame(rows, "cg_num string, cg_intitule string, cbmarq long")
                .select("cg_num", "cg_intitule", F.lit(0).cast("short").alias("cg_type"), "cbmarq",
                        F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification")))

    @erp_table
    def f_depot(self) -> DataFrame:
        rows = [(n, t, n + 1) for n, t in DEPOTS]
        return self.spark.createDataFrame(rows, "de_no int, de_intitule string, cbmarq long")

    @erp_table
    def f_comptea(self) -> DataFrame:
        rows = [(c, p, t, i + 1) for i, (c, p, t) in enumerate(ANALYTIC)]
        return (self.spark.createDataFrame(rows, "ca_num string, n_analytique int, ca_intitule string, cbmarq long")
                .select("ca_num", F.col("n_analytique").cast("short").alias("n_analytique"),
                        "ca_intitule", "cbmarq",
                        F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification")))

    # ------------------------------------------------------------ articles
    @erp_table
    def f_famille(self) -> DataFrame:
        return (self.src.part.select(F.col("p_brand").alias("fa_codefamille")).distinct()
                .select("fa_codefamille",
                        F.concat(F.lit("Famille "), F.col("fa_codefamille")).alias("fa_intitule"),
                        F.lit(1).cast("long").alias("cbmarq"),
                        F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification")))

    @erp_table
    def f_article(self) -> DataFrame:
        p = self.src.part
        prixven = F.col("p_retailprice").cast("decimal(13,2)")
        prixach = F.when(F.col("p_size") == 1, dec("0.00")).otherwise(
            (prixven * dec("0.55", 2, 2)).cast("decimal(13,2)"))
        return p.select(
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ar_ref"),
            F.col("p_name").alias("ar_design"),
            F.col("p_brand").alias("fa_codefamille"),
            prixven.alias("ar_prixven"),
            prixach.alias("ar_prixach"),
            F.when(F.col("p_size") == 1, F.lit(None)).otherwise(dec("1.8182", 7, 4)).cast("decimal(7,4)")
            .alias("ar_coef"),
            F.lit("U").alias("ar_uniteven"),
            F.lit(1).cast("short").alias("ar_suivistock"),
            F.when(F.col("p_size") == 50, F.lit(1)).when(F.col("p_size") == 49, F.lit(None))
            .otherwise(F.lit(0)).cast("short").alias("ar_sommeil"),
            (F.col("p_partkey") + 1).cast("long").alias("cbmarq"),
            F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification"),
        )

    @erp_table
    def f_artstock(self) -> DataFrame:
        li = self.src.lineitem.filter(F.col("l_partkey") % 40 != 0)
        q = F.col("l_quantity")
        rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
        g = li.groupBy(F.col("l_partkey").alias("pk"), (F.col("l_suppkey") % 3).cast("int").alias("de_no")).agg(
            (F.sum(F.when(rf.isin("N", "R"), q).otherwise(0.0))
             - F.sum(F.when(rf == "A", q).otherwise(0.0))).alias("qtesto"),
            F.sum(F.when((rf == "R") & (ls == "O"), q).otherwise(0.0)).alias("qteres"),
            F.sum(F.when(ls == "O", q).otherwise(0.0)).alias("qtecom"))
        art = self.f_article.select(F.col("ar_ref"), "ar_prixach")
        g = g.withColumn("ar_ref", F.concat(F.lit("P"), F.col("pk").cast("string"))).join(art, "ar_ref", "left")
        qtesto = F.col("qtesto").cast("decimal(13,3)")
        return g.select(
            "ar_ref", "de_no",
            qtesto.alias("as_qtesto"),
            dec("50.000", 13, 3).alias("as_qtemini"),
            dec("150.000", 13, 3).alias("as_qtemaxi"),
            (dec("5", 1, 0) * qtesto * F.col("ar_prixach")).cast("decimal(13,2)").alias("as_montsto"),
            F.col("qteres").cast("decimal(13,3)").alias("as_qteres"),
            F.col("qtecom").cast("decimal(13,3)").alias("as_qtecom"),
            (F.col("pk") * 4 + F.col("de_no")).cast("long").alias("cbmarq"),
            F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification"),
        )

    # ------------------------------------------------------------ documents
    @erp_table
    def f_docentete(self) -> DataFrame:
        o = self.src.orders
        n_sup = self.src.supplier.select(F.count(F.lit(1))).scalar()
        okey = F.col("o_orderkey")
        dtype = pick(okey % 10, DOC_TYPES).cast("short")
        ttc = F.round(F.col("o_totalprice"), 2).cast("decimal(13,2)")
        ht = (ttc * dec("0.83", 2, 2)).cast("decimal(13,2)")
        do_date = F.col("o_orderdate").cast("date")
        tiers = F.when(dtype >= 10, F.concat(F.lit("S"), (F.col("o_custkey") % n_sup).cast("string"))) \
            .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
        return o.select(
            F.concat(F.lit("D"), okey.cast("string")).alias("do_piece"),
            dtype.alias("do_type"),
            do_date.alias("do_date"),
            tiers.alias("do_tiers"),
            ht.alias("do_totalht"),
            ttc.alias("do_totalttc"),
            (ttc - ht).cast("decimal(13,2)").alias("do_totaltva"),
            F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 1)
            .otherwise(2).cast("short").alias("do_statut"),
            F.when(okey % 7 == 0, F.lit(None)).otherwise(
                F.date_add(do_date, (F.col("o_custkey") % 30).cast("int"))).alias("do_datelivr"),
            F.lit(None).cast("string").alias("do_ref"),
            F.lit(None).cast("string").alias("cbcreateur"),
            do_date.cast("timestamp_ntz").alias("cbcreation"),
            F.expr("timestampadd(HOUR, cast(o_orderkey % 24 as int), cast(cast(o_orderdate as date) as timestamp_ntz))")
            .alias("cbmodification"),
            (okey + 1).cast("long").alias("cbmarq"),
        )

    # --------------------------------------------------------------- assets
    @erp_table
    def f_familleimmo(self) -> DataFrame:
        return self.src.region.select(
            F.concat(F.lit("F"), F.col("r_regionkey").cast("string")).alias("fa_codefamille"),
            F.concat(F.lit("Immobilisations "), F.col("r_name")).alias("fa_intitule"),
            (F.col("r_regionkey") + 1).cast("long").alias("cbmarq"))

    @erp_table
    def f_immobilisation(self) -> DataFrame:
        nat = self.src.nation.select("n_nationkey", "n_regionkey")
        s = self.src.supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        k = F.col("s_suppkey")
        valacq = F.when(k % 25 == 0, dec("0.00")).otherwise(F.abs(F.col("s_acctbal")).cast("decimal(13,2)"))
        doteco = (valacq * dec("0.4", 1, 1)).cast("decimal(13,2)")
        years = F.when(k % 17 == 0, 0).otherwise(pick(k % 3, [3, 5, 10])).cast("short")
        acq = F.date_add(F.lit("1997-01-01").cast("date"), ((k * 37) % 1500).cast("int"))
        return s.select(
            F.concat(F.lit("I"), k.cast("string")).alias("im_code"),
            F.concat(F.lit("Equipement "), F.col("s_name")).alias("im_intitule"),
            F.lit(None).cast("string").alias("im_complement"),
            F.concat(F.lit("F"), F.col("n_regionkey").cast("string")).alias("fa_codefamille"),
            F.concat(F.lit("S"), k.cast("string")).alias("ct_num"),
            F.lit("218300").alias("cg_num"),
            acq.alias("im_dateacq"),
            F.date_add(acq, 15).alias("im_dateserv"),
            valacq.alias("im_valacq"),
            doteco.alias("im_doteco"),
            doteco.alias("im_dotfiscal"),
            (k % 4).cast("short").alias("im_modeamort01"),
            years.alias("im_nbannee01"),
            (k % 12).cast("short").alias("im_nbmois01"),
            (k % 4).cast("short").alias("im_etat"),
            dec("1.000", 13, 3).alias("im_quantite"),
            F.lit(None).cast("string").alias("im_observation"),
            (k + 1).cast("long").alias("cbmarq"),
            F.lit(MASTER_TS).cast("timestamp_ntz").alias("cbmodification"),
        )

    @erp_table
    def f_immoamort(self) -> DataFrame:
        s = self.src.supplier.filter(F.col("s_suppkey") % 2 == 0)
        k = F.col("s_suppkey")
        years = F.when(k % 17 == 0, 0).otherwise(pick(k % 3, [3, 5, 10]))
        taux = (F.when(years == 3, dec("33.3333", 7, 4)).when(years == 5, dec("20.0000", 7, 4))
                .when(years == 10, dec("10.0000", 7, 4)).otherwise(dec("0.0000", 7, 4)))
        return (s.withColumn("ia_annee", F.explode(F.array(F.lit(1999), F.lit(2000), F.lit(2001))))
                .select(F.concat(F.lit("I"), k.cast("string")).alias("im_code"),
                        F.col("ia_annee").cast("short").alias("ia_annee"),
                        F.lit(0).cast("short").alias("ia_typeamo"),
                        taux.alias("ia_taux"),
                        (k * 10 + F.col("ia_annee") - 1999).cast("long").alias("cbmarq")))

    # ----------------------------------------------------------- dimensions
    @cached_property
    def mapping(self) -> DataFrame:
        return dims.account_mapping(self.spark)

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.calendar(self.spark, TEST_CAL_START, TEST_CAL_END)


LEDGER_COLUMNS = ["ec_no", "ec_piece", "ec_date", "cg_num", "ct_num", "jo_num", "ec_intitule", "ec_montant",
                  "ec_sens", "ec_lettrage", "ec_refpiece", "ec_echeance", "cbcreateur", "cbcreation",
                  "cbmodification", "cbmarq"]

# Calendar bounds and "as of" date used with the driver tables.
TEST_CAL_START = "1995-01-01"
TEST_CAL_END = "2002-12-31"
AS_OF = "2001-07-15"

"""Amounts and grades in sentences that are written from orders and parts."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import money
from lodestone.sources.tables import scan

#: How an order's price {a} (and its customer's number {b}) is told.
FORMS = [
    "The contract has a ceiling of USD {a}.", "It was obligated at least EUR {a} thousand.", "Gross proceeds of ${a} and net proceeds of US${b} million.", "Gross proceeds were not USD {a}.", "USD {a} is expected under the option.", "USD {a} was paid.",
    "The ceiling and an option of no more than CHF {a}.", "Option value of GBP {a} in {b} lots.", "Net proceeds converted to CHF {a}.", "| ceiling | USD {a} |", "An obligation of USD -{a} against a shelf of £{b}.", "Net proceeds of nearly INR {a}.", "Contract ID: X-7 with a ceiling of USD {a}.", "A ceiling between USD {b} and USD {a}.",
]
_list = ", ".join("'" + s.replace("'", "''") + "'" for s in FORMS)


@query("e08_amounts", """WITH o AS (SELECT o_orderkey, o_orderkey % 14 AS f, round(o_totalprice)::BIGINT AS a, o_custkey AS b FROM orders),
    r AS (SELECT *, CASE f WHEN 3 THEN 'amount_assertion_not_established' WHEN 4 THEN 'amount_realization_scope_unsupported' WHEN 5 THEN 'amount_role_ambiguous_or_missing' WHEN 7 THEN 'amount_unconsumed_numeric_scope' WHEN 8 THEN 'amount_derived_value_unsupported' WHEN 9 THEN 'amount_table_scope_unsupported' WHEN 11 THEN 'amount_operator_unsupported' WHEN 13 THEN 'amount_range_grammar_unsupported' END AS reason FROM o)
    SELECT o_orderkey, reason, CASE f WHEN 0 THEN 'ceiling USD = ' || a WHEN 1 THEN 'obligation EUR >= ' || (a * 1000) WHEN 2 THEN 'gross_proceeds ? = ' || a || '; net_proceeds USD = ' || (b * 1000000) WHEN 6 THEN 'option CHF <= ' || a WHEN 10 THEN 'obligation USD = -' || a || '; financing_authority ? = ' || b WHEN 12 THEN 'ceiling USD = ' || a END AS said FROM r""")
def e08(spark, d):
    """Every order's sentence: its amounts with role, currency and operator, or why none is given."""
    text = F.get(F.array(*map(F.lit, FORMS)), (F.col("o_orderkey") % len(FORMS)).cast("int"))
    text = F.replace(F.replace(text, F.lit("{a}"), F.format_number(F.round("o_totalprice"), 0)), F.lit("{b}"), F.col("o_custkey").cast("string"))
    x = money.amounts(F.col("text"))
    said = F.array_join(F.transform("x.atoms", lambda a: F.concat_ws(" ", a["role"], F.coalesce(a["currency"], F.lit("?")), a["operator"], a["value"].cast("decimal(38,0)").cast("string"))), "; ")
    return scan(spark, d, "orders").select("o_orderkey", text.alias("text")).withColumn("x", x).select("o_orderkey", "x.reason", F.when(F.col("x.atoms").isNotNull(), said).alias("said"))


@query("k14_grades", """WITH p AS (SELECT p_partkey, p_size AS w, round(p_retailprice / 100, 1) AS g, p_partkey % 4 AS f FROM part)
    SELECT p_partkey, n::INTEGER AS n, x.value, x.unit FROM (SELECT p_partkey, unnest(range(0, len(xs))) AS n, unnest(xs) AS x FROM (SELECT p_partkey, list_filter([{'value': w::DOUBLE, 'unit': 'm@'}, CASE f WHEN 0 THEN {'value': g::DOUBLE, 'unit': 'g/tau'} WHEN 1 THEN {'value': g::DOUBLE, 'unit': 'g/tag'} WHEN 3 THEN {'value': g::DOUBLE, 'unit': '%u3o8'} END, {'value': (w + 1)::DOUBLE, 'unit': 'metresof'}], lambda y: y IS NOT NULL) AS xs FROM p))""")
def k14(spark, d):
    """Holes told from parts: widths, and grades of the metals that count (copper doesn't)."""
    grade = F.format_number(F.round(F.col("p_retailprice") / 100, 1), 1)
    metal = F.get(F.array(*map(F.lit, (" g/t Au", "g/t Ag", " g/t Cu", "% U3O8"))), (F.col("p_partkey") % 4).cast("int"))
    text = F.concat(F.lit("Hole A-7 cut "), F.col("p_size").cast("string"), F.lit("m @ "), grade, metal, F.lit(", then "), (F.col("p_size") + 1).cast("string"), F.lit(" metres of ore."))
    return scan(spark, d, "part").select("p_partkey", F.posexplode(money.grades(text)).alias("n", "g")).select("p_partkey", "n", "g.*")

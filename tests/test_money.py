"""Amounts with roles, every refusal, and grades."""

from decimal import Decimal

from pyspark.sql import functions as F

from lodestone.functions import money

CASES = [
    ("A ceiling of US$1.5 million.", [("ceiling", "USD", "=", "1500000")]), ("Obligated: at least EUR 2,500 and an option of up to $3 thousand.", [("obligation", "EUR", ">=", "2500"), ("option", None, "<=", "3000")]), ("A shelf of no more than £7, plus gross proceeds of about CHF 8", [("financing_authority", None, "<=", "7"), ("gross_proceeds", "CHF", "approximate", "8")]),
    ("An obligation of USD -4.25", [("obligation", "USD", "=", "-4.25")]), ("Contract id: A-99/1 has a maximum contract value of INR 5", [("ceiling", "INR", "=", "5")]), ("USD 5 is the net proceeds", [("net_proceeds", "USD", "=", "5")]), ("Nothing of 5 here", []), ("x" * 6001 + " USD 5", "amount_sentence_limit"), ("| ceiling | USD 5 |", "amount_table_scope_unsupported"),
    ("The ceiling isn't USD 5", "amount_assertion_not_established"), ("A planned ceiling of USD 5", "amount_realization_scope_unsupported"), ("A ceiling equivalent to USD 5", "amount_derived_value_unsupported"), ("A ceiling exceeding USD 5", "amount_qualifier_or_association_unsupported"), ("A ceiling in USD", "amount_token_or_count_unsupported"), ("Ceiling of " + "; ".join(["USD 1"] * 9), "amount_token_or_count_unsupported"),
    ("A ceiling of USD 5 or EUR some", "amount_currency_or_scale_unsupported"), ("A ceiling of USD 2000000000 billion", "amount_value_unsupported"), ("A ceiling between USD 5 and USD 6", "amount_range_grammar_unsupported"), ("It paid $5 million.", "amount_role_ambiguous_or_missing"), ("Ceiling and option: gross proceeds or net proceeds of USD 5", "amount_role_ambiguous_or_missing"),
    ("A ceiling of USD -5", "amount_negative_role_unsupported"), ("A ceiling of over USD 5", "amount_operator_unsupported"), ("A ceiling of USD 5 in 2024", "amount_unconsumed_numeric_scope"),
]


def test_amounts(spark):
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "k int, t string")
    got = {r.k: r.x for r in rows.select("k", money.amounts(F.col("t")).alias("x")).collect()}
    for k, (text, wanted) in enumerate(CASES):
        x = got[k]
        if isinstance(wanted, str):
            assert (x.reason, x.atoms) == (wanted, None), text
        else:
            assert x.reason is None and [(a.role, a.currency, a.operator, a.value) for a in x.atoms] == [(*w[:3], Decimal(w[3])) for w in wanted], (text, x)


def test_grades(spark):
    texts = ["1.5% U3O8, 2 g/t au and 3.0g/t Ag; 4 g/t Cu", "6m @ 7.5 g/t Au over 8 metres of ore, 9 meters grading", "-1 g/t Au 1,5 g/t Au x2 g/t Au 3.1.2 g/t Au", "", None]
    got = [[(g.value, g.unit) for g in r.g] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(money.grades(F.col("t")).alias("g")).collect()]
    assert got == [[(1.5, "%u3o8"), (2.0, "g/tau"), (3.0, "g/tag")], [(6.0, "m@"), (7.5, "g/tau"), (8.0, "metresof"), (9.0, "metersgrading")], [], [], []]


def test_each_part_of_a_sentence_is_worked_out_once(spark):
    """The rules were nested in each other, so that each was searched hundreds of times a sentence."""
    plan = spark.createDataFrame([("A ceiling of USD 5",)], "t string").select(money.amounts(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gross") < 10 and len(plan) < 60_000
    assert spark.createDataFrame([(None,)], "t string").select(money.amounts(F.col("t")).alias("x")).collect()[0].x.asDict() == {"reason": None, "atoms": None}

"""Amounts of money in a sentence, each with its role, or one reason to give none; and grades of ore.  Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.grammar import found, part, word

# Currencies (a bare $ or £ names none), roles, operators and words that forbid a reading; ? marks an optional letter.
CODES = ("USD", "EUR", "GBP", "CAD", "AUD", "JPY", "CHF", "CNY", "INR")
ROLES = {
    "ceiling": ("ceiling", "maximum value", "maximum contract value"), "option": ("options?",), "obligation": ("obligated", "obligation", "deobligation"), "financing_authority": ("financing authority", "ATM", "at[- ]the[- ]market", "shelf"), "gross_proceeds": ("gross proceeds",), "net_proceeds": ("net proceeds",),
}
OPERATORS = {"<": ("less than", "<"), ">": ("more than", ">"), "<=": ("at most", "up to", "no more than", "<=", "≤"), ">=": ("at least", "no less than", ">=", "≥"), "approximate": ("approximately", "about", "roughly", "≈", "~")}
CONNECTORS = ("including", "plus", "against", "and")
DENIED = ("not", "no", "never", "neither", "without", "denied", "denies", "revoked", "rescinded", "terminated", "cancelled", "canceled", "withdrawn", "retracted", "incorrect", "superseded")
UNREALISED = ("expected", "projected", "planned", "potential", "to be obligated", "to be received", "to be raised", "to be paid", "to be exercised")
DERIVED = ("converted", "conversion", "equivalent", "exchange rate", "annualized", "annualised", "sum of")
QUALIFIED = ("estimated", "estimate", "exceeding", "exceeds", "approximately between", "minus", "negative", "excluding", "inclusive of", "totaling", "totalling", "respectively")
VAGUE = ("nearly", "almost", "around", "over", "under", "upwards of", "in excess of")
SCALES = {"thousand": 3, "million": 6, "billion": 9}
CUE = rf"\b(?:{'|'.join(CODES)})\b|US\$|[$€£]"
MONEY = rf"(?<!\w)(US\$|(?:{'|'.join(CODES)})\b|[$€£])\s*([+-]?(?:\d{{1,3}}(?:,\d{{3}})+|\d+)(?:\.\d+)?)(?:\s*({'|'.join(SCALES)}))?(?!\w|[.,]\d)"
NAMED = r"\b(?:contract|financing)\s+id\s*:\s*[A-Za-z0-9][A-Za-z0-9_./-]*"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), F.lit(0))


def _held(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once a row: a plain column is worked out again wherever it is named."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def amounts(text: Column) -> Column:
    """struct of reason and atoms (role, currency, operator, value).

    A sentence is cut at connectors into clauses; an amount takes the one role that its clause names (where the sentence has one
    amount only, that any of it names).  Ranges aren't read.  Any reason takes all atoms of the sentence.
    """
    return _held(text, _amounts)


def _amounts(text: Column) -> Column:
    spaced = lambda forms: tuple(f.replace(" ", r"\s+") for f in forms)
    group = lambda x, g: F.regexp_extract(x, f"(?i){MONEY}", g)
    clauses = F.filter(F.split(text, rf"(?i);|,?\s*\b(?:{'|'.join(CONNECTORS)})\b"), lambda c: found(c, CUE))
    roles = lambda c: F.array_compact(F.array(*[F.when(found(c, word(spaced(forms))), F.lit(k)) for k, forms in ROLES.items()]))
    # The longer forms first: "no more than" ends in "more than".
    ends = sorted(((("" if f[0] in "<>≤≥≈~" else r"\b") + f.replace(" ", r"\s+"), k) for k, forms in OPERATORS.items() for f in forms), key=lambda x: -len(x[0].removeprefix(r"\b").replace(r"\s+", " ")))
    scales = [F.lit(k) for k in SCALES]

    def atom(x: Column) -> Column:
        """Of a clause (its money, what is before it, the roles it names or takes)."""
        hit, before = F.get(x["money"], F.lit(0)), x["before"]
        sign, scale = F.upper(group(hit, 1)), F.lower(group(hit, 3))
        currency = F.when(sign == "US$", "USD").when(sign == "€", "EUR").when(~sign.isin("$", "£"), sign)
        number = F.regexp_replace(group(hit, 2), ",", "").try_cast("decimal(38,12)")
        times = F.coalesce(*[F.when(scale == k, F.lit(10**n)) for k, n in zip(scales, SCALES.values(), strict=True)], F.lit(1)).cast("decimal(10,0)")
        some = found(before, part(tuple(f for f, _ in ends)) + r"\s*$")
        operator = F.when(some, F.coalesce(*[F.when(found(before, f + r"\s*$"), F.lit(k)) for f, k in ends])).otherwise(F.lit("="))
        return F.struct(F.when((F.size(x["roles"]) == 1) & (F.size(x["money"]) == 1), x["roles"][0]).alias("role"), currency.alias("currency"), operator.alias("operator"), (number * times).cast("decimal(38,6)").alias("value"), found(before, word(spaced(VAGUE)) + r"\s*$").alias("vague"))

    def atoms(single: Column) -> Column:
        own = lambda c: _held(roles(c), lambda r: F.when(single & (F.size(r) == 0), roles(text)).otherwise(r))
        return F.transform(clauses, lambda c: _held(F.struct(_all(c, MONEY).alias("money"), F.regexp_extract(c, f"(?i)^(.*?){MONEY}", 1).alias("before"), own(c).alias("roles")), atom))

    def judged(money: Column) -> Column:
        early = (
            F.when(F.char_length(text) > 6000, "amount_sentence_limit").when(found(text, r"[|\t\n]|<[^>]+>"), "amount_table_scope_unsupported")
            .when(found(F.regexp_replace(text, r"(?i)\bno\s+(?:more|less)\s+than\b", ""), word(DENIED) + r"|n['’]t\b"), "amount_assertion_not_established").when(found(text, word(spaced(UNREALISED))), "amount_realization_scope_unsupported")
            .when(found(text, word(spaced(DERIVED))), "amount_derived_value_unsupported").when(found(text, word(spaced(QUALIFIED))), "amount_qualifier_or_association_unsupported").when((F.size(money) == 0) | (F.size(money) > 8), "amount_token_or_count_unsupported")
            .when(F.size(money) != F.size(_all(text, CUE)), "amount_currency_or_scale_unsupported")
        )
        return _held(early, lambda r: F.when(r.isNotNull(), refused(r)).otherwise(_held(atoms(F.size(money) == 1), whole)))

    def whole(atoms: Column) -> Column:
        some = lambda test: F.exists(atoms, test)
        rest = F.regexp_replace(F.regexp_replace(text, f"(?i){NAMED}", " "), f"(?i){MONEY}", " ")
        late = (
            F.when(some(lambda a: a["value"].isNull() | (F.abs(a["value"]) > 10**18)), "amount_value_unsupported").when(found(text, r"\bbetween\b"), "amount_range_grammar_unsupported")
            .when(some(lambda a: a["role"].isNull()), "amount_role_ambiguous_or_missing").when(some(lambda a: (a["value"] < 0) & (a["role"] != "obligation")), "amount_negative_role_unsupported").when(some(lambda a: a["vague"]), "amount_operator_unsupported")
            .when(found(rest, r"\d"), "amount_unconsumed_numeric_scope")
        )
        plain = F.transform(atoms, lambda a: a.dropFields("vague"))
        return _held(late, lambda r: F.struct(r.alias("reason"), F.when(r.isNull(), plain).alias("atoms")))

    kind = "array<struct<role:string,currency:string,operator:string,value:decimal(38,6)>>"
    refused = lambda r: F.struct(r.alias("reason"), F.lit(None).cast(kind).alias("atoms"))
    # A sentence without money has no amounts, and no text neither these nor a reason.
    none = F.struct(F.lit(None).cast("string").alias("reason"), F.when(text.isNotNull(), F.array().cast(kind)).alias("atoms"))
    return F.when(found(text, CUE), _held(_all(text, MONEY), judged)).otherwise(none)


#: Forms of a grade or width: a number and its unit, with the metal where one is asked for.
GRADE = rf"(?<![\w.,+\-−])(\d+(?:\.\d*)?)(?![0-9.,])\s*({part(('%\\s*U3O8', 'g/t\\s*(?:Au|Ag)', 'm\\s*@', '(?:metres?|meters?)\\s*(?:of|@|grading)'))})"


def grades(text: Column) -> Column:
    """array of (value, unit): numbers of per cent U3O8, grams a ton of Au or Ag, and metres of or at something."""
    hits = _all(text, GRADE)
    unit = lambda x: F.lower(F.regexp_replace(F.regexp_extract(x, f"(?i){GRADE}", 2), r"\s+", ""))
    return F.coalesce(F.transform(hits, lambda x: F.struct(F.regexp_extract(x, f"(?i){GRADE}", 1).cast("double").alias("value"), unit(x).alias("unit"))), F.array().cast("array<struct<value:double,unit:string>>"))

"""Quality rules as data: reject, correct or flag.

A rule names a column, a check and a severity. The checks of a table share the forms of its values (trimmed
text, parsed date, amount), which one projection makes before they are evaluated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tandem.functions.amounts import clean_amount, money
from tandem.functions.dates import is_iso, normal_date, parse_date
from tandem.functions.text import clean_email, clean_text, is_postcode, stripped_phone
from tandem.operators.dedup import folded

REJECT, CORRECT, FLAG = "reject", "correct", "flag"


class Rule(NamedTuple):
    column: str
    check: str
    severity: str
    arg: Any = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.check}"


#: Form of a value -> how it is made. Each form a table's rules need is made once per row.
FORMS: dict[str, Callable[[Column], Column]] = {
    "text": clean_text, "date": parse_date, "amount": clean_amount, "email": clean_email, "phone": stripped_phone,
}


def _form(form: str, column: str) -> Column:
    return F.col(f"_{form}_{column}")


class Check(NamedTuple):
    """The forms a check reads, and the condition, never null, under which the rule is broken."""

    forms: tuple[str, ...]
    broken: Callable[[str, Any], Column]


def _off_form(column: str, form: str) -> Column:
    """Filled, and not written like its normal form."""
    text = _form("text", column)
    return text.isNotNull() & ~text.eqNullSafe(_form(form, column))


CHECKS: dict[str, Check] = {
    "empty": Check(("text",), lambda c, _: _form("text", c).isNull()),
    "bad_date": Check(("date",), lambda c, _: _form("date", c).isNull()),
    "bad_amount": Check(
        ("amount",), lambda c, _: F.coalesce((_form("amount", c) < 0) | money(_form("amount", c)).isNull(), F.lit(True))
    ),
    "not_a_number": Check(("amount",), lambda c, _: _form("amount", c).isNull()),
    "other_word": Check(("text",), lambda c, words: ~F.coalesce(_form("text", c).isin(*words), F.lit(False))),
    "bad_postcode": Check(("text",), lambda c, _: ~F.coalesce(is_postcode(_form("text", c)), F.lit(False))),
    "ends_before": Check(
        ("date",), lambda c, start: F.coalesce(_form("date", c) < _form("date", start), F.lit(False))
    ),
    "bad_email": Check(("text", "email"), lambda c, _: _form("text", c).isNotNull() & _form("email", c).isNull()),
    "misspelt_email": Check((), lambda c, _: F.coalesce(F.contains(F.col(c), F.lit("_at_")), F.lit(False))),
    "date_form": Check(
        ("text", "date"), lambda c, _: _form("date", c).isNotNull() & ~F.coalesce(is_iso(_form("text", c)), F.lit(False))
    ),
    "phone_form": Check(("text", "phone"), lambda c, _: _off_form(c, "phone")),
}

#: Check -> corrected value, for the rules of severity "correct".
FIXES: dict[str, Callable[[Column, Any, str | None], Column]] = {
    "empty": lambda v, _, placeholder: F.coalesce(clean_text(v), F.lit(placeholder).cast("string")),
    "misspelt_email": lambda v, *_: F.replace(v, F.lit("_at_"), F.lit("@")),
    "date_form": lambda v, with_time, _: normal_date(v, with_time),
    "phone_form": lambda v, *_: stripped_phone(v),
}


def _beside(df: DataFrame, made: Column, kept: Sequence[str] = ("*",)) -> DataFrame:
    """The fields of the struct ``made`` as columns beside those of ``df`` that are kept, each made once per row.

    They come out of ``inline``, so that what reads them reads the values. From a plain projection their expressions
    would be copied to every place that reads them, also before it where a filter does, and all steps compiled
    as one method, which beyond 8,000 bytes the JVM only interprets.
    """
    return df.select("*", made.alias("_made")).select(*kept, F.inline(F.array("_made"))).drop("_made")


def _needed_forms(rules: Sequence[Rule]) -> dict[str, Column]:
    needed = {}
    for r in rules:
        columns = [r.column, r.arg] if r.check == "ends_before" else [r.column]
        needed |= {f"_{form}_{c}": FORMS[form](F.col(c)) for form in CHECKS[r.check].forms for c in columns}
    return needed


def add_forms(df: DataFrame, rules: Sequence[Rule], made: Sequence[Rule] = ()) -> DataFrame:
    """``df`` plus the forms of its columns that the rules read, in one projection; it has those of the rules ``made``."""
    there = _needed_forms(made)
    needed = {name: value for name, value in _needed_forms(rules).items() if name not in there}
    if not needed:
        return df
    forms = F.struct(*(value.alias(name) for name, value in needed.items()))
    return _beside(df, forms)


def breaks(rules: Sequence[Rule], *severities: str) -> Column:
    """Whether a row with its forms breaks any rule of the severities."""
    checks = [CHECKS[r.check].broken(r.column, r.arg) for r in rules if r.severity in severities]
    return reduce(or_, checks, F.lit(False))


def check_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` plus the names of the rules each row breaks: the text columns reject, correct and flag.

    Names are joined by commas; a row that breaks none has empty text. The rules that reject are judged first: a filter on
    their verdict is moved before the forms that only the other rules read.
    """

    def broken(severity: str) -> Column:
        mine = [r for r in rules if r.severity == severity]
        names = F.concat_ws(",", *(F.when(CHECKS[r.check].broken(r.column, r.arg), F.lit(r.name)) for r in mine))
        return names.alias(severity)

    rejecting = [r for r in rules if r.severity == REJECT]
    judged = _beside(add_forms(df, rejecting), F.struct(broken(REJECT)))
    return _beside(add_forms(judged, rules, rejecting), F.struct(broken(CORRECT), broken(FLAG)), [*df.columns, REJECT])


def split_rejected(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows); the rejected ones keep the names of the rules they break."""
    return checked.filter(F.col(REJECT) == ""), checked.filter(F.col(REJECT) != "")


def correct_rows(valid: DataFrame, rules: Sequence[Rule], placeholder: str | None = None) -> DataFrame:
    """Repaired values for the rules of severity "correct"; the lists of rule names stay for tracing.

    A repair never takes a value away: an address that stays wrong is kept under its flag, a foreign number loses only
    its separators.

    Several rules on one column are applied in their order: the empty rule last puts the placeholder.
    """
    fixed: dict[str, Column] = {}
    for r in sorted((r for r in rules if r.severity == CORRECT), key=lambda r: r.check == "empty"):
        fixed[r.column] = FIXES[r.check](fixed.get(r.column, F.col(r.column)), r.arg, placeholder)
    return valid.select(*(fixed[c].alias(c) if c in fixed else F.col(c) for c in valid.columns))


def quality_report(
    df: DataFrame, table: str, key: str, rules: Sequence[Rule], order_by: Sequence[str] = ()
) -> DataFrame:
    """One row: rows, anomalies and rate before, rows rejected, anomalies and rate after.

    "Before" counts the rows that break any rule or share their key with another row. Rejected are the
    repeats of a key and the rows that break a rule of severity "reject". "After" counts accepted rows that
    keep a flag, since corrections have been made by then.
    """
    # Rules are evaluated once a row, and one aggregate by key finds both the counts and the first row's verdicts.
    verdicts = {
        "_any": breaks(rules, REJECT, CORRECT, FLAG),
        "_refused": breaks(rules, REJECT),
        "_flagged": ~breaks(rules, REJECT) & breaks(rules, FLAG),
    }
    order = [*order_by, *(c for c in df.columns if c not in order_by)]
    judged = add_forms(df, rules).select(
        folded(df, key, ignore_case=True).alias("_key"),
        F.struct(*order, verdicts["_refused"].alias("_refused"), verdicts["_flagged"].alias("_flagged")).alias("_row"),
        verdicts["_any"].alias("_any"),
    )
    per_key = judged.groupBy("_key").agg(
        F.count("*").alias("n"), F.count_if("_any").alias("broken"), F.min("_row").alias("_first")
    )
    before = F.when(F.col("n") > 1, F.col("n")).otherwise(F.col("broken"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"),
        F.coalesce(F.sum(before), F.lit(0)).alias("before"),
        F.struct(
            F.count_if("_first._refused").alias("refused"), F.count_if("_first._flagged").alias("flagged")
        ).alias("first"),
    )

    def rate(n: Column) -> Column:
        share = n.cast("decimal(18,0)") * 100 / F.nullif(F.col("total"), F.lit(0)).cast("decimal(18,0)")
        return F.round(share, 2).cast("double")

    after = F.col("first.flagged")
    return counts.select(
        F.lit(table).alias("table"),
        F.col("total").alias("nb_lignes_total"),
        F.col("before").alias("nb_anomalies_avant"),
        rate(F.col("before")).alias("taux_anomalies_avant"),
        (F.col("first.refused") + F.col("repeats")).alias("nb_lignes_rejetees"),
        after.alias("nb_anomalies_apres"),
        rate(after).alias("taux_anomalies_apres"),
    )


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per broken rule, all counted in one pass."""
    counts = add_forms(df, rules).agg(
        *(F.count_if(CHECKS[r.check].broken(r.column, r.arg)).alias(r.name) for r in rules)
    )
    return counts.unpivot([], [F.col(f"`{r.name}`") for r in rules], "rule", "nb").filter(F.col("nb") > 0)


def incoherent_rows(df: DataFrame, status: str, date: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose status is not an allowed word or whose date is not a date: two swapped columns show here."""
    word_ok = F.upper(F.trim(F.col(status))).isin(*allowed)
    shape = F.translate(F.trim(F.col(date)), "123456789", "000000000")
    date_ok = shape.isin("0000-00-00", "0000-00-00 00:00:00")
    return df.filter(~F.coalesce(word_ok & date_ok, F.lit(False)))


# --- Fixed values: the written rules of the eight source tables --------------------------------------
SOURCE_RULES: dict[str, tuple[str, list[Rule]]] = {
    "AB_CLIENT": (
        "ab_client_id",
        [
            Rule("ab_nom", "empty", REJECT),
            Rule("ab_prenom", "empty", REJECT),
            Rule("ab_date_naissance", "bad_date", REJECT),
            Rule("ab_date_naissance", "date_form", CORRECT, False),
            Rule("ab_email", "empty", CORRECT),
            Rule("ab_email", "misspelt_email", CORRECT),
            Rule("ab_email", "bad_email", FLAG),
            Rule("ab_telephone", "empty", CORRECT),
            Rule("ab_telephone", "phone_form", CORRECT),
            Rule("ab_adresse", "empty", CORRECT),
            Rule("ab_code_postal", "bad_postcode", FLAG),
            Rule("ab_num_fiscal", "empty", REJECT),
            Rule("ab_date_creation", "bad_date", REJECT),
            Rule("ab_date_creation", "date_form", CORRECT, True),
            Rule("ab_statut_client", "other_word", FLAG, ["ACTIF", "INACTIF", "SUSPENDU"]),
        ],
    ),
    "AB_CONTRAT": (
        "ab_policy_number",
        [
            Rule("ab_client_id", "empty", REJECT),
            Rule("ab_type_assurance", "empty", REJECT),
            Rule("ab_date_debut", "bad_date", REJECT),
            Rule("ab_date_debut", "date_form", CORRECT, False),
            Rule("ab_date_fin", "bad_date", REJECT),
            Rule("ab_date_fin", "date_form", CORRECT, False),
            Rule("ab_date_fin", "ends_before", FLAG, "ab_date_debut"),
            Rule("ab_prime_annuelle", "bad_amount", REJECT),
            Rule("ab_statut_contrat", "other_word", FLAG, ["ACTIF", "RESILIE", "SUSPENDU"]),
            Rule("ab_agence_id", "empty", CORRECT),
        ],
    ),
    "AB_SINISTRE": (
        "ab_claim_id",
        [
            Rule("ab_policy_number", "empty", REJECT),
            Rule("ab_date_sinistre", "bad_date", REJECT),
            Rule("ab_date_sinistre", "date_form", CORRECT, True),
            Rule("ab_montant_estime", "bad_amount", REJECT),
            Rule("ab_statut_sinistre", "other_word", FLAG, ["DECLARE", "EN_COURS", "CLOTURE", "REJETE"]),
            Rule("ab_description", "empty", CORRECT),
        ],
    ),
    "AB_PAIEMENT": (
        "ab_payment_id",
        [
            Rule("ab_policy_number", "empty", REJECT),
            Rule("ab_date_paiement", "bad_date", REJECT),
            Rule("ab_date_paiement", "date_form", CORRECT, False),
            Rule("ab_montant", "bad_amount", REJECT),
            Rule("ab_mode_paiement", "empty", CORRECT),
        ],
    ),
    "AP_USERS": (
        "ap_user_id",
        [
            Rule("ap_full_name", "empty", REJECT),
            Rule("ap_birth_date", "bad_date", REJECT),
            Rule("ap_birth_date", "date_form", CORRECT, False),
            Rule("ap_mail_address", "empty", CORRECT),
            Rule("ap_mail_address", "misspelt_email", CORRECT),
            Rule("ap_phone_number", "empty", CORRECT),
            Rule("ap_phone_number", "phone_form", CORRECT),
            Rule("ap_street_address", "empty", CORRECT),
            Rule("ap_zip_code", "bad_postcode", FLAG),
            Rule("ap_created_at", "bad_date", REJECT),
            Rule("ap_created_at", "date_form", CORRECT, True),
            Rule("ap_customer_status", "other_word", FLAG, ["ACTIVE", "INACTIVE", "SUSPENDED"]),
            Rule("ap_loyalty_score", "not_a_number", FLAG),
        ],
    ),
    "AP_CONTRACTS": (
        "ap_contract_ref",
        [
            Rule("ap_user_id", "empty", REJECT),
            Rule("ap_product_code", "empty", REJECT),
            Rule("ap_start_date", "bad_date", REJECT),
            Rule("ap_start_date", "date_form", CORRECT, True),
            Rule("ap_end_date", "bad_date", REJECT),
            Rule("ap_end_date", "date_form", CORRECT, True),
            Rule("ap_end_date", "ends_before", FLAG, "ap_start_date"),
            Rule("ap_monthly_premium", "bad_amount", REJECT),
            Rule("ap_contract_state", "other_word", FLAG, ["ACTIVE", "TERMINATED", "SUSPENDED"]),
            Rule("ap_broker_code", "empty", CORRECT),
        ],
    ),
    "AP_CLAIMS": (
        "ap_sinistre_num",
        [
            Rule("ap_contract_ref", "empty", REJECT),
            Rule("ap_incident_date", "bad_date", REJECT),
            Rule("ap_incident_date", "date_form", CORRECT, False),
            Rule("ap_estimated_amount", "bad_amount", REJECT),
            Rule("ap_claim_status", "other_word", FLAG, ["REPORTED", "IN_PROGRESS", "CLOSED", "REJECTED"]),
            Rule("ap_claim_comment", "empty", CORRECT),
            Rule("ap_fraud_score", "not_a_number", FLAG),
        ],
    ),
    "AP_PAYMENTS": (
        "ap_payment_ref",
        [
            Rule("ap_contract_ref", "empty", REJECT),
            Rule("ap_payment_datetime", "bad_date", REJECT),
            Rule("ap_payment_datetime", "date_form", CORRECT, True),
            Rule("ap_amount_paid", "bad_amount", REJECT),
            Rule("ap_payment_channel", "empty", CORRECT),
            Rule("ap_transaction_status", "other_word", FLAG, ["SUCCESS", "PENDING", "FAILED"]),
        ],
    ),
}

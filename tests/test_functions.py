"""Column functions on literal values."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tandem import catalog
from tandem.functions import amounts, dates, messages, text
from tandem.functions.vocab import translate_channels, translate_statuses, translate_words
from tandem.operators.clean import blank_to_null, clean_table, features_as_double, zero_when_null


def apply(table, fn, *values, kind="string"):
    df = table(f"i int, v {kind}", *enumerate(values))
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_text_is_trimmed_at_every_control_character_and_blank_is_null(table):
    assert apply(table, text.clean_text, "  Marie  ", "\t Lucie\r\n", "", "   ", "\x00\x1f", None, "a b") == [
        "Marie", "Lucie", None, None, None, None, "a b",
    ]


@pytest.mark.parametrize(
    "value, expected",
    [
        (" Lucie.Marie@VOILA.fr ", "lucie.marie@voila.fr"),
        ("lucie_at_voila.fr", "lucie@voila.fr"),
        ("a_at_b_at_c.fr", "a@b@c.fr"),
        ("sans.arobase", None),
        ("sans@point", None),
        ("  ", None),
        (None, None),
    ],
)
def test_email(table, value, expected):
    assert apply(table, text.clean_email, value) == [expected]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("+33 (0)6 95 02 81 40", "06 95 02 81 40"),
        ("+33(0)695028140", "06 95 02 81 40"),
        ("+33 4 30 23 51 16", "04 30 23 51 16"),
        ("0033 695028140", "06 95 02 81 40"),
        ("02.61.17.76.25", "02 61 17 76 25"),
        ("0261177625", "02 61 17 76 25"),
        ("12345", None),
        ("9261177625", None),
        ("02611776251", None),
        ("", None),
        (None, None),
    ],
)
def test_phone(table, value, expected):
    assert apply(table, text.normal_phone, value) == [expected]


def _phone_by_hand(value: str) -> str | None:
    value = value.strip("".join(map(chr, range(33))))
    if value.startswith("+33"):
        rest = re.sub(r"^\s*\(0\)", "", value[3:])
        value = "0" + rest
    elif value.startswith("0033"):
        value = "0" + value[4:]
    digits = "".join(c for c in value if c in "0123456789")
    if len(digits) != 10 or digits[0] != "0":
        return None
    return " ".join(digits[i : i + 2] for i in range(0, 10, 2))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.builds(
            lambda head, body: head + body,
            st.sampled_from(["", "+33", "+33 (0)", "+33  (0)", "0033", "0", " 0", "+34"]),
            st.text("0123456789 .-()", min_size=7, max_size=13),
        ),
        min_size=40,
        max_size=40,
    )
)
def test_phone_agrees_with_a_plain_reading_of_the_rule(table, values):
    assert apply(table, text.normal_phone, *values) == [_phone_by_hand(v) for v in values]


@pytest.mark.parametrize(
    "value, day, moment",
    [
        ("1973-01-27", "1973-01-27", "1973-01-27 00:00:00"),
        ("06/10/1943", "1943-10-06", "1943-10-06 00:00:00"),
        (" 2024-01-05 13:05:01\n", "2024-01-05", "2024-01-05 13:05:01"),
        ("31/02/1980", None, None),
        ("2023-02-29", None, None),
        ("2024-02-29", "2024-02-29", "2024-02-29 00:00:00"),
        ("2024-01-05 25:00:00", None, None),
        ("2024-1-5", None, None),
        ("2024-01-5 ", None, None),
        ("2024-01-05 13:05:1 ", None, None),
        ("2024-01-05 13:05", None, None),
        ("2024-01", None, None),
        ("2024", None, None),
        (" 06/10/1943\t", "1943-10-06", "1943-10-06 00:00:00"),
        ("aaaa-bb-cc", None, None),
        ("1/10/19430", None, None),
        ("2024-01-05T13:05:01", None, None),
        ("inconnue", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_dates(table, value, day, moment):
    assert apply(table, dates.normal_date, value) == [day]
    assert apply(table, lambda c: dates.normal_date(c, with_time=True), value) == [moment]


def test_time_of_day_survives_a_session_zone_with_a_clock_change(spark, table):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert apply(table, lambda c: dates.normal_date(c, True), "2024-03-31 02:30:00") == ["2024-03-31 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_days_between_may_be_negative_or_null_and_bad_text_is_no_error(table):
    df = table(
        "a string, b string",
        ("2024-01-01", "2024-01-11"), ("2024-01-11 10:00:00", "2024-01-01 23:00:00"), ("2024-01-01", None),
        ("", "2024-01-01"), ("bad", "2024-01-01"),
    )
    got = [r[0] for r in df.select(dates.days_between(F.col("a"), F.col("b"))).collect()]
    assert got == [10, -10, None, None, None]


def test_amounts(table):
    assert apply(table, amounts.clean_amount, " 12.5 ", "abc", "", None, "-3") == [12.5, None, None, None, -3.0]


def test_sum_of_money_is_exact(table):
    df = table("v double", *[(0.1,)] * 10, (150.73,))
    assert df.agg(amounts.total_money(F.col("v"))).first()[0] == 151.73


@pytest.mark.parametrize(
    "yearly, monthly, strict, lax",
    [(1200.0, None, 1200.0, 1200.0), (None, 100.0, 1200.0, 1200.0), (0.0, 100.0, 1200.0, 0.0), (None, None, None, None)],
)
def test_yearly_premium(table, yearly, monthly, strict, lax):
    df = table("y double, m double", (yearly, monthly))
    y, m = F.col("y"), F.col("m")
    got = df.select(amounts.yearly_premium(y, m), amounts.yearly_premium(y, m, zero_is_missing=False)).first()
    assert tuple(got) == (strict, lax)


def test_premiums_fill_each_other(table):
    df = table("y double, m double", (1808.77, None), (None, 154.8), (2365.38, None), (None, None))
    y, m = F.col("y"), F.col("m")
    got = df.select(amounts.yearly_from(y, m), amounts.monthly_from(y, m)).collect()
    assert [tuple(r) for r in got] == [(1808.77, 150.73), (1857.6, 154.8), (2365.38, 197.12), (None, None)]


def test_product_family(table):
    df = table(
        "t string, c string",
        ("AUTO", "X_Y"), (None, "AUTO_BASIC"), (None, "ASSIST_PREMIUM"), ("ASSIST", None), (None, "VIE"), (None, None),
    )
    got = [r[0] for r in df.select(amounts.product_family(F.col("t"), F.col("c"))).collect()]
    assert got == ["AUTO", "AUTO", "ASSISTANCE", "ASSISTANCE", "VIE", None]


def test_label_starts_at_the_threshold(table):
    assert apply(table, amounts.suspect_label, "70", "69", "69.99", "95", None, "haut") == [1, 0, 0, 1, 0, 0]


def test_percent_rounds_ties_to_even(table):
    assert apply(table, amounts.whole_percent, 0.9, 0.875, 0.025, 0.125, None, kind="double") == [90, 88, 2, 12, None]


STATUS_CASES = [
    ("statut_client", ["ACTIVE", "INACTIVE", "SUSPENDED", "ACTIF", None, "AUTRE"],
     ["ACTIF", "INACTIF", "SUSPENDU", "ACTIF", None, "AUTRE"]),
    ("statut_contrat", ["ACTIVE", "TERMINATED", "SUSPENDED"], ["ACTIF", "RESILIE", "SUSPENDU"]),
    ("statut_sinistre", ["REPORTED", "IN_PROGRESS", "CLOSED", "REJECTED"], ["DECLARE", "EN_COURS", "CLOTURE", "REJETE"]),
    ("statut_transaction", ["SUCCESS", "PENDING", "FAILED"], ["REUSSI", "EN_ATTENTE", "ECHOUE"]),
]


@pytest.mark.parametrize("name, given_words, expected", STATUS_CASES)
def test_status_words(table, name, given_words, expected):
    df = translate_statuses(table(f"id int, {name} string", *enumerate(given_words)))
    assert [r[name] for r in df.orderBy("id").collect()] == expected


def test_table_without_status_passes_through(table):
    assert rows(translate_statuses(table("id int, nom string", (1, "ACTIVE")))) == [(1, "ACTIVE")]


def test_words_in_any_case(table):
    words = catalog.STATUS_WORDS["statut_client"]
    trimmed = apply(table, lambda c: translate_words(c, words, "trimmed"), " active ", "suspendu", " Lead ", " ", None)
    assert trimmed == ["ACTIF", "SUSPENDU", "Lead", None, None]
    upper = apply(table, lambda c: translate_words(c, catalog.STATUS_WORDS["statut_contrat"], "upper"),
                  " terminated", "Archived", None)
    assert upper == ["RESILIE", "ARCHIVED", None]
    with pytest.raises(ValueError):
        translate_words(F.lit("a"), words, "other")


def test_channels(table):
    df = translate_channels(table("i int, mode_paiement string", (1, "CARD"), (2, "DIRECT_DEBIT"), (3, "CHEQUE")))
    assert [r[1] for r in df.orderBy("i").collect()] == ["CARTE", "PRELEVEMENT", "CHEQUE"]


def test_blank_to_null_leaves_numbers_alone(table):
    df = table("id int, nom string, age int, montant double", (1, "  Marie ", 30, 1.5), (2, "  ", None, None))
    assert rows(blank_to_null(df)) == [(1, "Marie", 30, 1.5), (2, None, None, None)]


def test_clean_table_refuses_unknown_columns(table):
    with pytest.raises(ValueError, match="other"):
        clean_table(table("id int", (1,)), {"other": text.clean_text})


def test_filling_text_with_zero_is_refused(table):
    df = table("a string, b long", (None, None))
    assert rows(zero_when_null(df, ["b"])) == [(None, 0)]
    with pytest.raises(ValueError, match="a"):
        zero_when_null(df, ["a", "b"])


def test_features_become_doubles(table):
    df = table("sinistre_id string, a string, b double", ("1", "12", None), ("2", "x", 3.0))
    assert rows(features_as_double(df, ["a", "b"])) == [("1", 12.0, 0.0), ("2", 0.0, 3.0)]


def test_message_round_trip_with_quotes_and_line_breaks(table):
    df = table(
        "paiement_id string, contrat_id string, date_paiement string, montant double, mode_paiement string,"
        " statut_transaction string",
        ("1", 'a"b\\c', "x\r\ny", 150.73, None, "é"),
    )
    sent = messages.to_message(df, "paiement_id")
    assert sent.first()["key"] == "1"
    back = messages.good_messages(messages.from_message(sent, catalog.SCHEMAS["paiements"]))
    assert rows(back) == rows(df)


def test_missing_numbers_can_be_sent_as_zero(table):
    df = table("contrat_id string, prime_annuelle double, prime_mensuelle double", ("c", None, 3.0))
    assert messages.to_message(df, "contrat_id").first()["value"] == (
        '{"contrat_id":"c","prime_annuelle":null,"prime_mensuelle":3.0}'
    )
    assert messages.to_message(df, "contrat_id", ("prime_annuelle",)).first()["value"] == (
        '{"contrat_id":"c","prime_annuelle":0.0,"prime_mensuelle":3.0}'
    )


def test_malformed_messages_are_kept_apart(table):
    schema = catalog.SCHEMAS["contrats"]
    df = table(
        "value string",
        ('{"contrat_id":"c1","prime_mensuelle":3}',), ('{"contrat_id":"c2","prime_mensuelle":,}',),
        ('{"contrat_id":"c3","prime_mensuelle":"beaucoup"}',), ("",), (None,),
    )
    parsed = messages.from_message(df, schema)
    assert [r["contrat_id"] for r in messages.good_messages(parsed).collect()] == ["c1"]
    assert rows(messages.bad_messages(parsed)) == [
        ("",), ("",), ('{"contrat_id":"c2","prime_mensuelle":,}',),
        ('{"contrat_id":"c3","prime_mensuelle":"beaucoup"}',),
    ]

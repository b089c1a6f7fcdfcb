"""Cleaning functions and classification rules on single values."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from closeworks.functions import dates, rules, text
from closeworks.functions import fixed_values as V
from tests.helpers import apply, day


def test_squeeze_trims_and_reduces_blanks(spark):
    assert apply(spark, text.squeeze, ["  Hello  ", " How   are you? ", None]) == ["Hello", "How are you?", None]


def test_brazilian_money(spark):
    written = ["R$ 1.234,56", "10,5", "-3.000", "-", "123.45", "1.2.3", "", None, "nan", "1.000.000", "12.34"]
    parsed = [1234.56, 10.5, -3000.0, 0.0, 123.45, 0.0, 0.0, 0.0, 0.0, 1000000.0, 12.34]
    assert apply(spark, text.parse_brl, written) == parsed


def test_format_brl(spark):
    assert apply(spark, text.format_brl, [1029.2123, None, -2921.23, 0.0], "double") == [
        "1.029,21", None, "-2.921,23", "0,00"
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=st.lists(st.integers(-10**11, 10**11), min_size=1, max_size=50))
def test_money_survives_a_round_trip(spark, cents):
    values = [c / 100 for c in cents]
    assert apply(spark, lambda c: text.parse_brl(text.format_brl(c)), values, "double") == values


def test_ids(spark):
    assert apply(spark, text.coerce_id, ["12_x000D_", " 7 ", "3.0", "x", "", None]) == [12, 7, 3, None, None, None]


def test_tax_ids(spark):
    assert apply(spark, text.normalize_tax_id, ["123.456.789-01", "5", "", None, "12345678901234"]) == [
        "12345678901", "00000000005", None, None, "12345678901234"
    ]
    assert apply(spark, text.mask_tax_id, ["12345678901", "5", None]) == ["123.456.789-01", "5", None]
    assert apply(spark, text.tax_id_number, ["000.000.123-45", "1/2", "x"]) == [12345, 12, None]
    # A large id in a floating-point column loses no digits once it is cast.
    assert apply(spark, lambda c: text.normalize_tax_id(c.cast("bigint")), [12345678901.0], "double") == ["12345678901"]


def test_registration_and_branch(spark):
    assert apply(spark, text.normalize_registration, ["1 23", "123456789", None]) == ["00000123", "123456789", None]
    assert apply(spark, lambda c: text.branch_code(c, F.lit("XX1234YY")), ["", None, "9"]) == ["1234", "1234", "9"]


def test_small_text_functions(spark):
    assert apply(spark, text.null_tokens, ["nan", "NaT", "", "a", None]) == [None, None, None, "a", None]
    assert apply(spark, lambda c: text.strip_suffix(c, " PARA"), ["VENDEDOR PARA", "PARA", None]) == ["VENDEDOR", "PARA", None]
    assert apply(spark, lambda c: text.strip_prefix(c, V.TASK_PREFIX), [V.TASK_PREFIX + "X", "X"]) == ["X", "X"]
    assert apply(spark, lambda c: text.contains_word(c, "faturar"), ["Não FATURAR", "x", None]) == [True, False, False]
    assert apply(spark, text.text_flag, ["a", "", None]) == [1, 0, 0]
    assert apply(spark, lambda c: text.first_filled(c, F.lit("z")), ["a", "", None]) == ["a", "z", "z"]
    assert apply(spark, text.strip_accents, ["AÇÃO é ü", None]) == ["ACAO e u", None]
    assert apply(spark, lambda c: text.replace_values(c, {"DESLIGADO-R": "DESLIGADO"}), ["Desligado-r", "ativo"]) == [
        "DESLIGADO", "ATIVO"
    ]


def test_mixed_dates_month_first(spark):
    written = ["25/11/1991", None, "6/5/22", "12/31/20", "22/032022", "22/03//2022", "12/5/2022", "6/15/22", "1/02/22/9", "5/12/1997"]
    expected = ["1991-11-25", None, "2022-06-05", "2020-12-31", None, None, "2022-05-12", "2022-06-15", "2022-01-02", "1997-12-05"]
    assert apply(spark, dates.parse_mixed_date, written) == [day(e) for e in expected]


def test_short_dates_in_both_orders(spark):
    written = ["25/11/1991", "6/5/22", "31/12/97", "12/31/20", "22/03//2022"]
    assert apply(spark, lambda c: dates.parse_short_date(c, "dmy"), written) == [
        day("1991-11-25"), day("2022-05-06"), day("1997-12-31"), None, None
    ]
    assert apply(spark, dates.parse_short_date, written) == [day("1991-11-25"), day("2022-06-05"), None, day("2020-12-31"), None]


def test_two_digit_years_turn_at_the_pivot(spark):
    assert apply(spark, lambda c: dates.parse_short_date(c, pivot_year=2030), ["1/1/30", "1/1/31"]) == [
        day("2030-01-01"), day("1931-01-01")
    ]


def test_coerced_dates(spark):
    written = ["05/06/2024", "2024-06-05", "2024-06-05 10:00:00", "5.6.2024", "05-06-2024", "x", "31/02/2024", None]
    assert apply(spark, dates.coerce_date, written) == [day("2024-06-05")] * 5 + [None, None, None]
    assert apply(spark, lambda c: dates.coerce_date(c, dayfirst=False), ["05/06/2024"]) == [day("2024-05-06")]


def test_months_count_only_when_complete(spark):
    df = spark.createDataFrame(
        [(1, day("2020-01-31"), day("2020-02-29")), (2, day("2020-01-15"), day("2020-03-15")), (3, day("2020-03-15"), day("2020-01-16"))],
        "id int, a date, b date",
    )
    found = {r[0]: (r[1], r[2]) for r in df.select(
        "id", dates.whole_months(F.col("a"), F.col("b")), dates.days_between(F.col("a"), F.col("b"))
    ).collect()}
    assert found == {1: (0, 29), 2: (2, 60), 3: (-1, -59)}


def test_claim_period_and_vintage(spark):
    df = spark.createDataFrame(
        [
            (1, day("2020-06-15"), day("2010-01-01"), day("2020-05-31")),
            (2, day("2020-06-15"), day("2019-01-01"), None),
            (3, None, day("2019-01-01"), day("2020-01-31")),
            (4, day("2020-06-15"), None, None),
        ],
        "id int, filing date, hire date, dismissal date",
    )
    start = dates.claim_start(F.col("filing"), F.col("hire"))
    end = dates.claim_end(F.col("filing"), F.col("dismissal"))
    tenure = dates.whole_months(F.col("hire"), F.col("dismissal"))
    found = {r[0]: tuple(r)[1:] for r in df.select(
        "id", dates.claim_label(start, end), dates.claim_vintage(F.col("dismissal"), tenure)
    ).collect()}
    assert found == {
        1: ("07-2015 a 05-2020", "2015"),
        2: ("01-2019 a 06-2020", "Sem info"),
        3: ("01-2019 a 01-2020", "2020"),
        4: (None, "Sem info"),
    }


@pytest.mark.parametrize(
    "bins, edges",
    [
        (V.STOCK_MONTH_BINS, {6: "até 6 meses", 7: "7 - 12 meses", 24: "19 - 24 meses", 25: "+24 meses"}),
        (V.CASE_DAY_BINS, {360: "até 1 ano", 361: "1 - 3 anos", 3241: "+9 anos"}),
        (V.CLUSTER_MONTH_BINS, {-5: "ATÉ 1 ANO", 12: "ATÉ 1 ANO", 13: "1 - 2 ANOS", 84: "6 - 7 ANOS", 85: "+7 ANOS"}),
        (V.SETTLEMENT_BRACKETS, {1: None, 2: "Até R$ 50 mil", 50000: "Até R$ 50 mil", 500001: "Acima R$ 500 mil"}),
        (V.VOLUME_BANDS, {0: None, 10: "ATÉ 10 PERÍCIAS", 11: "ENTRE 11 E 30 PERÍCIAS", 51: "ACIMA DE 50 PERÍCIAS"}),
    ],
)
def test_bins_are_open_below_and_closed_above(spark, bins, edges):
    assert apply(spark, lambda c: rules.bin_label(c, bins), list(edges), "int") == list(edges.values())


def test_phase_groups(spark):
    spellings = ["RECURSAL TST", "EXECUÇÃO DEFIN", "", "N/A", "CONHECIMENTO", None, " RECURSAL "]
    assert apply(spark, rules.group_phase, spellings) == [
        "RECURSAL_TST", "EXECUÇÃO", "DEMAIS", "DEMAIS", "CONHECIMENTO", None, " RECURSAL "
    ]
    assert apply(spark, lambda c: rules.group_phase(c, V.CLOSING_PHASES), spellings)[:2] == ["RECURSAL", "EXECUÇÃO DEFIN"]
    assert apply(spark, lambda c: rules.group_phase(c, null_label="DEMAIS"), spellings)[-2:] == ["DEMAIS", "RECURSAL_TRT"]


def test_closing_reason_needs_a_closed_case(spark):
    df = spark.createDataFrame(
        [(1, 1, 2.0, 0.0), (2, 1, 1.0, 1.5), (3, 1, 1.0, 0.0), (4, 0, 9.0, 9.0), (5, 1, None, 0.0)],
        "id int, closed int, a double, b double",
    )
    reason = rules.closing_reason(F.col("closed"), F.col("a"), [F.col("b"), F.lit(0.0)])
    found = {r[0]: r[1] for r in df.select("id", reason).collect()}
    assert found == {1: "ACORDO", 2: "CONDENACAO", 3: "SEM ONUS", 4: None, 5: None}


def test_nature_priorities_differ_between_book_and_model(spark):
    df = spark.createDataFrame([(1, "TERCEIRO SOLVENTE", "DEFESA")], "id int, nature string, strategic string")
    inputs = (F.lit(0.0), F.col("nature"), F.lit(None), F.lit(None), F.col("strategic"))
    both = df.select(rules.case_nature(*inputs), rules.case_nature(*inputs, defence_first=True)).first()
    assert tuple(both) == ("TERCEIRO SOLVENTE", "DEFESA")


def test_reporting_groups(spark):
    df = spark.createDataFrame(
        [(1, "ADM E LOG", "SUPPLY"), (2, "ADM E LOG", "RH"), (3, "ADM E LOG", None), (4, "", "RH"), (5, "CFO", None), (6, None, None)],
        "id int, vp string, d string",
    )
    group = rules.reporting_group(F.col("vp"), F.col("d"), [("ADM E LOG", ["SUPPLY"], "LOGISTICA", "ADMINISTRATIVO")])
    found = {r[0]: r[1] for r in df.select("id", group).collect()}
    assert found == {1: "LOGISTICA", 2: "ADMINISTRATIVO", 3: "ADM E LOG", 4: "OUTROS", 5: "CFO", 6: None}


def test_late_penalty(spark):
    cases = [
        (1, V.LATE_STATUS, 100.0, 0.1, 90.0),
        (2, V.LATE_STATUS, 100.0, 25.0, 75.0),
        (3, V.LATE_STATUS, 100.0, None, 100.0),
        (4, V.LATE_STATUS, 0.0, 0.5, 0.0),
        (5, V.LATE_STATUS, -5.0, 0.5, -5.0),
        (6, V.ON_TIME_STATUS, 100.0, 0.1, 100.0),
        (7, None, 100.0, 0.1, 100.0),
        (8, V.LATE_STATUS, None, 0.1, None),
        (9, V.LATE_STATUS, 100.0, 1.0, 99.0),
    ]
    df = spark.createDataFrame([c[:4] for c in cases], "id int, status string, value double, discount double")
    found = {r[0]: r[1] for r in df.select("id", rules.late_penalty(F.col("status"), F.col("value"), F.col("discount"))).collect()}
    assert found == {c[0]: c[4] for c in cases}


def test_carried_status(spark):
    write_off = "ATIVO" + V.WRITE_OFF_SUFFIX
    cases = [
        (1, None, "BAIXADO", None, 5.0, "BAIXADO"),
        (2, "ATIVO", "REATIVADO", None, 5.0, "REATIVADO"),
        (3, "ENCERRADO", "ATIVO", None, 0.0, "ENCERRADO"),
        (4, "ATIVO", "ATIVO", None, 0.0, write_off),
        (5, "ATIVO", "ATIVO", V.SETTLEMENT_MOTIVE, 0.0, V.SETTLEMENT_MOTIVE),
        (6, None, write_off, None, 0.0, write_off),
        (7, None, None, None, None, None),
        (8, None, "ATIVO", None, None, "ATIVO"),
    ]
    df = spark.createDataFrame([c[:5] for c in cases], "id int, s string, p string, m string, v double")
    status = rules.carried_status(F.col("s"), F.col("p"), F.col("m"), F.col("v"))
    assert {r[0]: r[1] for r in df.select("id", status).collect()} == {c[0]: c[5] for c in cases}


def test_transition_codes_cover_every_case(spark):
    cases = [
        (1, "A", None, 0, None),
        (2, "A", "A", 1, None),
        (3, "B", "A", 2, "A - B"),
        (4, "ENCERRADO", "A", 3, "A - ENCERRADO"),
        (5, "ENCERRADO", "ENCERRADO", 1, None),
        (6, None, "A", 4, None),
        (7, None, None, 4, None),
        (8, "A", "ENCERRADO", 2, "ENCERRADO - A"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "id int, now string, before string")
    found = df.select("id", rules.transition_code(F.col("now"), F.col("before")), rules.transition_label(F.col("now"), F.col("before")))
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == {c[0]: (c[3], c[4]) for c in cases}


def test_other_rules(spark):
    assert apply(spark, rules.strategy, ["ACOR", " DEFESA", "OUTRA", None]) == ["ACORDO", "DEFESA", "OUTRA", None]
    assert apply(spark, lambda c: rules.strategy_label(c, "SEM ESTRATEGIA"), ["VACINA", "DEFESA", "X", None]) == [
        "ACORDO", "DEFESA", "SEM ESTRATEGIA", "SEM ESTRATEGIA"
    ]
    assert apply(spark, rules.billable, ["Faturar", "não faturar", "x", None]) == ["FATURADO", "NÃO FATURADO", None, None]
    assert apply(spark, rules.document_flag, [V.DOCUMENT_ANALYSES[3], "x", None]) == ["SIM", "NÃO", "NÃO"]
    assert apply(spark, rules.title_synonym, ["CAIXA 130", "VENDEDOR INTERNO", "PINTOR"]) == ["BALCÃO 130", "VENDEDOR", "PINTOR"]
    assert apply(spark, rules.listed_title, ["CAIXA", "PINTOR", None]) == ["CAIXA", "OUTROS", "OUTROS"]
    assert apply(spark, rules.contract_kind, [90, 91, None], "int") == ["Contrato Experiência", "Contrato Normal", "Contrato Normal"]
    assert apply(spark, rules.title_kind, ["Jovem aprendiz", "x", None]) == ["Aprendiz", "Demais Cargos", "Demais Cargos"]
    cut = lambda c: rules.new_or_legacy(c.cast("date"))
    assert apply(spark, cut, ["2020-01-01", "2019-12-31", None]) == ["NOVO", "LEGADO", "LEGADO"]


def test_word_lists_do_not_overlap():
    subtypes = [s for values in V.PAYMENT_CLASSES.values() for s in values]
    assert len(subtypes) == len(set(subtypes))
    for groups in (V.CLOSING_PHASES, V.BOOK_PHASES, V.TITLE_SYNONYMS, V.STRATEGIES):
        values = [s for group in groups.values() for s in group]
        assert len(values) == len(set(values))
